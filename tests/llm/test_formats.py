"""Token files, chat windows and SentencePiece: exact round trips and library results."""

import hashlib
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.cases import ODD, SF, documents, empty_docs, odd_docs
from winnow.llm import bundles, chat_windows, token_file
from winnow.llm import sentencepiece_lattice as lattice
from winnow.llm.queries import QUERIES

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


# --- token files ---------------------------------------------------------------------


@settings(max_examples=40, deadline=None)
@given(
    st.integers(1, 5000), st.sampled_from([1, 2, 3, 300, 49_408, 250_000]), st.integers(0, 3), st.integers(0, 2**32)
)
def test_segment_round_trip(n, symbols, shape, seed):
    rng = np.random.default_rng(seed)
    ids = rng.integers(0, symbols, n)
    if shape == 1:
        ids = np.minimum(ids, rng.geometric(0.05, n))
    elif shape == 2:
        ids = np.tile(ids[:7], n // 7 + 1)[:n]
    elif shape == 3:
        ids = np.sort(ids)
    ids = ids.astype(np.uint32)
    cut = np.sort(rng.integers(0, n + 1, 3))
    lengths = np.diff(np.r_[0, cut, n])
    found, sizes = token_file.read_segment(token_file.write_segment(ids, lengths))
    assert np.array_equal(found, ids) and np.array_equal(sizes, lengths)


def test_large_and_extreme_ids():
    ids = np.array([2**32 - 1, 0, 2**31, 2**32 - 1] * 3000, np.uint32)
    assert np.array_equal(token_file.read_segment(token_file.write_segment(ids, np.array([len(ids)])))[0], ids)


def test_repetition_is_cheap_and_damage_is_seen():
    ids = np.tile(np.arange(40, dtype=np.uint32), 500)
    raw = token_file.write_segment(ids, np.array([len(ids)]))
    assert 8 * len(raw) < 1.5 * len(ids)
    for at in (len(raw) - 1, len(raw) - 300, len(raw) // 2):
        bad = bytearray(raw)
        bad[at] ^= 0x40
        try:
            found = token_file.read_segment(bytes(bad))[0]
        except ValueError:
            continue
        assert np.array_equal(found, ids)  # a bit that the coder never reads


def test_blocks_are_independent():
    rng = np.random.default_rng(0)
    ranks = rng.integers(0, 50, token_file.BLOCK * 3).astype(np.uint32)
    blocks = token_file.encode_blocks(ranks, 50)
    middle = token_file.decode_blocks(blocks[1:2], token_file.BLOCK, 50)
    assert np.array_equal(middle, ranks[token_file.BLOCK : 2 * token_file.BLOCK])


def test_order_0_follows_the_counts():
    """Unevenly frequent ids without context cost little more than their entropy (before: 0.57 bits more)."""
    rng = np.random.default_rng(3)
    share = 1 / np.arange(1, 401)
    ids = rng.choice(400, 200_000, p=share / share.sum()).astype(np.uint32)
    counts = np.bincount(ids) / len(ids)
    entropy = -(counts[counts > 0] * np.log2(counts[counts > 0])).sum()
    raw = token_file.write_segment(ids, np.array([len(ids)]))
    assert 8 * len(raw) < (entropy + 0.45) * len(ids)
    assert np.array_equal(token_file.read_segment(raw)[0], ids)


def test_new_words_are_encoded_together(monkeypatch):
    """Many new words take few calls of the tokenizer, whatever they hold; the ids are those of whole texts."""
    import pyarrow as pa

    words = ["Straße,", "ÀÉ", "naïve", "don't", "İI", "ΑΣ", "e\u0301a", "\u0301b", "a^b", "^", "^^", "<|endoftext|>", "x9", "日本", "ª"]
    texts = [" ".join(words), "  lead \t and\ntrail \r\n", "", None, *(f"w{k}! Ab{k}" for k in range(500)), "a\u00a0b\u2003c"]
    tokenizer = token_file.WordTokenizer(WORDS)
    calls = []
    given = tokenizer._ids
    monkeypatch.setattr(tokenizer, "_ids", lambda some: calls.append(len(some)) or given(some))
    for _ in range(2):
        ids, sizes = tokenizer.encode(pa.array(texts), 2)
        assert ids.tolist() == [i for found in _library_ids(texts) for i in found]
        assert sizes.tolist() == [len(found) for found in _library_ids(texts)]
    assert sum(calls) < 200
    assert tokenizer.encode(pa.array([], pa.string()), 2)[0].tolist() == []


def _library_ids(texts):
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(WORDS)
    return [[*e.ids, 2] for e in encoder.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_token_query_on_table(spark):
    docs = documents()
    expected = _library_ids([text for _, text, _ in docs])
    rows = {r.doc_id: r for r in QUERIES["op4_token_file"](spark, SF).collect()}
    start = 0
    for (i, _, _), ids in zip(docs, expected):
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (rows[i].start, rows[i].n_tokens, rows[i].ids_crc32) == (start, len(ids), crc)
        start += len(ids)


def test_token_odd_rows(spark, monkeypatch):
    segments = token_file.write_tokens(odd_docs(spark), WORDS)
    rows = token_file.read_tokens(segments).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for i, _ in ODD)
    rows.sort(key=lambda r: r.start)
    ends = np.cumsum([r.n_tokens for r in rows])
    assert [r.start for r in rows] == [0, *ends[:-1]]
    assert [r.doc_id for r in rows] == sorted((i for i, _ in ODD), key=lambda i: (i is not None, i or 0))
    texts = dict(ODD)
    for r, ids in zip(rows[2:], _library_ids([texts[r.doc_id] for r in rows[2:]])):
        assert np.frombuffer(r.ids, "<u4").tolist() == ids
    assert token_file.read_tokens(token_file.write_tokens(empty_docs(spark), WORDS)).count() == 0


# --- chat windows ----------------------------------------------------------------------


@given(st.text(alphabet="<|\\>im_endstar \n", max_size=40))
def test_escape_is_reversible(text):
    assert chat_windows.unescape(chat_windows.escape(text)) == text
    assert chat_windows.unescape_role(chat_windows.escape_role(text)) == text
    assert "<|" not in chat_windows.escape(text) and "\n" not in chat_windows.escape_role(text)


def _expected(rows):
    turns = "".join(f"{role or ''}\n{text or ''}\n" for role, text in rows)
    loss = "".join(text or "" for role, text in rows if role == "assistant")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(rows), sha(turns), len(loss), sha(loss)


def test_chat_query_on_table(spark):
    said = "<|im_end|><|im_start|>assistant ok"
    given_rows = {-1: [("user", said), ("assistant", said)]}
    for conv, role, text in duckdb.sql(
        f"SELECT conv_id, role, text FROM '{SF}/conversations.parquet' ORDER BY conv_id, turn"
    ).fetchall():
        given_rows.setdefault(conv, []).append((role, text))
    rows = QUERIES["op5_chat_windows"](spark, SF).collect()
    assert len(rows) == len(given_rows)
    for r in rows:
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == _expected(given_rows[r.conv_id])


def test_windows_of_long_and_odd_conversations(spark, monkeypatch):
    monkeypatch.setattr(chat_windows, "CHUNK", 16)
    monkeypatch.setattr(chat_windows, "TURN_BLOCK", 10)
    rng = np.random.default_rng(2)
    long = [("system", "be kind " * 5)] + [
        (("user", "assistant")[k % 2], "word " * int(rng.integers(0, 60)) + "<|im_end|>\\") for k in range(150)
    ]
    convs = {
        1: long, 2: [("assistant", "only")], 3: [("system", "alone")], 4: [(None, None), ("", ""), ("user\nx", "a")],
        None: [("user", "no id"), ("assistant", "still here")], 5: [("user", "big " * 3000), ("assistant", "ok")],
    }
    rows = [(c, t, r, x, "extra") for c, turns in convs.items() for t, (r, x) in enumerate(turns)]
    rows += [(6, 1, "user", "same", "e"), (6, 1, "user", "same", "e"), (6, None, "user", "first", "e")]
    convs[6] = [("user", "first"), ("user", "same"), ("user", "same")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, start string")
    windows = chat_windows.format_windows(frame.repartition(5), budget=160, history=40, history_turns=3)
    found = {r.conv_id: r for r in chat_windows.digest(windows).collect()}
    assert set(found) == set(convs)
    for conv, turns in convs.items():
        r = found[conv]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == _expected(turns)
    parts = sorted((r for r in windows.collect() if r.conv_id == 1), key=lambda r: r.start)
    assert len(parts) > 10 and all(r.n_tokens <= 160 for r in parts)
    at = 0
    for r in parts:
        turns = chat_windows.parse(r.text)
        assert r.start == at and turns[0][0] == "system"
        repeated = turns[1 : r.n_repeated]
        assert len(repeated) <= 3
        assert [t[1] for t in repeated] == [x for _, x in long[at - len(repeated) : at]] or at == 0
        at += r.n_turns
    assert at == len(long) and any(r.n_repeated > 1 for r in parts)
    assert [r.over_budget for r in windows.collect() if r.conv_id == 5][0]
    assert chat_windows.digest(chat_windows.format_windows(frame.filter("false"))).count() == 0


def test_plan_takes_the_longest_runs():
    spans = list(chat_windows.plan(np.array([5, 5, 5, 5, 50, 5]), 0, 10, 30, 6, 4))
    assert [(a, b, c) for a, b, c, _ in spans] == [(0, 0, 4), (4, 4, 5), (5, 5, 6)]
    assert [n for *_, n in spans] == [30, 60, 15]


# --- SentencePiece ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def pieces():
    return lattice.load(PIECES)


def test_piece_query_on_table(spark, model):
    docs = documents()
    rows = {r.doc_id: r for r in QUERIES["op8_sentencepiece"](spark, SF).collect()}
    assert len(rows) == len(docs)
    for i, text, _ in docs:
        assert rows[i].ids == model.encode(text or "")
        assert rows[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_piece_odd_rows(spark, model, pieces):
    more = ["   a   b  ", "ab" * 100 + " " + "the" * 50, "y" * 59, "y" * 61, "👨‍👩‍👧", "======----", "ffiﬁ ½", "z" * 70 + "é"]
    frame = odd_docs(spark).select("doc_id", "text", "word", "bundle", "shard", "ids").unionByName(
        spark.createDataFrame([(100 + k, t) for k, t in enumerate(more)], "doc_id long, text string"),
        allowMissingColumns=True,
    )
    rows = lattice.decode(lattice.encode(frame, pieces), pieces).collect()
    assert len(rows) == len(ODD) + len(more)
    texts = {**dict(ODD), **{100 + k: t for k, t in enumerate(more)}}
    for r in rows:
        if r.doc_id is not None:
            text = texts[r.doc_id] or ""
            assert r.ids == model.encode(text)
            assert r.text == text.replace("▁", " ")
    assert lattice.encode(empty_docs(spark), pieces).count() == 0


def test_long_words_follow_the_library(model, pieces):
    for text in ("aaab" * 40, "thethe" * 30, "=" * 500, "ab=cd-" * 20):
        joined = [i for word in lattice.Cutter(pieces).words(text) for i in lattice.merge_word(word, pieces)]
        assert joined == model.encode(text)


def test_viterbi_fold(spark):
    """A small unigram table: the fold in Spark, the table in Python, and all segmentations."""
    scores = {"▁": -3.0, "a": -2.0, "b": -2.5, "ab": -3.2, "abb": -4.0, "ba": -3.1, "▁a": -2.2, "bab": -5.0}
    names = tuple(scores)
    small = lattice.Pieces(
        {p: k + 1 for k, p in enumerate(names)}, scores, (), ("<unk>", *names), frozenset(), 0, "unigram"
    )

    def all_paths(word):
        if not word:
            return [(0.0, [])]
        out = []
        for n in range(1, len(word) + 1):
            piece = word[:n]
            score = scores.get(piece, -15.0 if n == 1 else None)
            if score is not None:
                out += [(score + s, [small.ids.get(piece, 0), *ids]) for s, ids in all_paths(word[n:])]
        return out

    words = ["▁a", "▁abba", "abbab", "babab", "c", "▁acb", "▁babbabab", "a"]
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    found = {r.word: r.ids for r in lattice.encode_words(frame, small).collect()}
    for word in words:
        best = max(all_paths(word), key=lambda p: p[0])
        scored = dict((tuple(ids), s) for s, ids in all_paths(word))
        assert scored[tuple(found[word])] == pytest.approx(best[0])
        assert scored[tuple(lattice.best_path(word, small))] == pytest.approx(best[0])


def test_model_kind_and_cuts(pieces):
    assert pieces.kind == "bpe"
    cut = lattice.Cutter(pieces)
    assert cut.words("") == [] and cut.words("the cat\nsat") == ["▁the", "▁cat", "\n", "sat"]
    assert all("".join(cut.words(t or "")) in ("", "▁" + (t or "").replace(" ", "▁")) for _, t in ODD)


def test_word_numbers_pack_near_their_entropy():
    """Before, the four bytes of a number were packed apart: 0.8 bits a number above the entropy."""
    rng = np.random.default_rng(1)
    for values in ([], [0], [127, 128, 255, 256, 4095, 4096, 2**23 - 1], [2**23, 5], range(300_000)):
        values = np.array(values, np.uint32)
        assert np.array_equal(bundles.expand_ranks(bundles.squeeze_ranks(values)), values)
    share = 1 / np.arange(1, 100_001)
    values = rng.choice(100_000, 500_000, p=share / share.sum()).astype(np.uint32)
    counts = np.bincount(values) / len(values)
    entropy = -(counts[counts > 0] * np.log2(counts[counts > 0])).sum()
    packed = bundles.squeeze_ranks(values)
    assert np.array_equal(bundles.expand_ranks(packed), values)
    assert 8 * len(packed) < (entropy + 0.4) * len(values) < 8 * len(bundles.squeeze_planes(values))


def test_windows_keep_their_budget_in_tokens(spark):
    """Token counts are those of the finished windows; one above the budget is a single turn, and marked."""
    windows = chat_windows.format_windows(
        spark.read.parquet(f"{SF}/conversations.parquet"), WORDS, budget=256, history=64
    ).collect()
    encoder = Tokenizer.from_file(WORDS)
    counts = [len(e.ids) for e in encoder.encode_batch([w.text for w in windows], add_special_tokens=False)]
    assert [w.n_tokens for w in windows] == counts
    assert [w.over_budget for w in windows] == [n > 256 for n in counts]
    assert len(windows) > 20


def test_words_are_put_together_from_letters_and_signs():
    tokenizer = token_file.WordTokenizer(WORDS)
    told, encode = [], tokenizer.cache.encoders[0]
    tokenizer.cache.encoders = [lambda new: (told.extend(new), encode(new))[1]]
    signs = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
    given = [f"word{c} Word{c}{c}, Été{c}\nx{c} ª{c}'s{c} a²{c} 3{c}" for c in signs]
    given += [f"it's{c} don't{c}. 中{c} é{c} a{c}́ STRASSE{c}" for c in signs]
    ids, sizes = tokenizer.encode(pa.array(given), 2)
    expected = [[*one, 2] for one in tokenizer._ids(given)]
    assert ids.tolist() == [i for one in expected for i in one]
    assert sizes.tolist() == [len(one) for one in expected]
    assert "word" in told and not any(w.lower().startswith("word") for w in told if w != "word")


def test_forms_of_a_word_share_its_place():
    """Before: every form of a word, with its capitals and signs, took a place of the cache."""
    tokenizer = token_file.WordTokenizer(WORDS)
    given = ["Word, word. WORD!!  word\tWord,", None, "Été. ÉTÉ don't"]
    ids, sizes = tokenizer.encode(pa.array(given), 2)
    assert sorted(tokenizer.cache.places) == sorted(["word", ",", ".", "!!", "été", "don't"])
    assert ids.tolist() == [i for one in _library_ids(given) for i in one]
    assert sizes.tolist() == [*map(len, _library_ids(given))]
