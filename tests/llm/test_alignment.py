"""Cross-tokenizer alignment, packing and the divergence audit against brute force."""

import hashlib
import struct
from bisect import bisect_right
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.cases import ODD, documents, empty_docs, odd_docs
from tokenizers import Tokenizer

from winnow.llm import chunk_tokens, divergence, packing
from winnow.llm import token_alignment as ta

BYTES, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
STRANGE = [
    "  two  blanks   three", "\nline\n\n\nlines \n", "tab\tand \t tab", " ", "\n", "a\r\nb\r", "x \n\ny",
    "<|endoftext|> in <s>text</s> <0x41> <unk>", "▁ lower block ▁▁x", "é 🙂🙂 日本語　全角",
    "\x1c\x1d a \x85 b", "it's we'll 12 345 6-7 ...", "nul \x00 here", "﻿mark​ z", "a" * 3000,
    "word " * 2000, "trailing blank ", "  ", "\t\tx", "a \nb", "a\n b", "᠎ ᠎a",
]


def texts():
    return [(k, t) for k, t in enumerate(STRANGE)] + [(100, None), (100, ""), (None, "x y"), (None, None)] + ODD


def aligned(rows):
    """Result rows of the alignment, from both libraries on whole texts, byte by byte."""
    tokenizer = Tokenizer.from_file(BYTES)
    tokenizer.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    byte_of = chunk_tokens.byte_level_alphabet()
    found, links, corpus = [], [], Counter()
    for i, text in rows:
        a = tokenizer.encode(" " + text, add_special_tokens=False).ids if text else []
        b = model.encode(text) if text else []
        raw_a = [bytes(byte_of[c] for c in tokenizer.id_to_token(x)) for x in a]
        raw_b = [
            bytes([int(model.id_to_piece(x)[3:5], 16)]) if model.is_byte(x)
            else model.id_to_piece(x).replace("▁", " ").encode() for x in b
        ]
        full = (" " + text).encode() if text else b""
        if b"".join(raw_a) != full or b"".join(raw_b) != full:
            a, b, raw_a, raw_b = [], [], [], []
        ends_a, ends_b = np.cumsum([*map(len, raw_a)]).tolist(), np.cumsum([*map(len, raw_b)]).tolist()
        place = [k for k, r in enumerate(raw_b) for _ in r]
        mine, start = [], 0
        for x, end in zip(a, ends_a, strict=True):
            mine += [(x, b[k]) for k in dict.fromkeys(place[start:end])]
            start = end
        groups, last = [], 0
        for cut in sorted(set(ends_a) & set(ends_b)):
            side = [
                ",".join(str(x) for x in ids[bisect_right(ends, last) : bisect_right(ends, cut)])
                for ids, ends in ((a, ends_a), (b, ends_b))
            ]
            groups.append("|".join(side))
            last = cut
        corpus.update(mine)
        links.append(mine)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        found.append((i, len(a), len(b), len(groups), digest))
    best = defaultdict(int)
    for (_, y), n in corpus.items():
        best[y] = max(best[y], n)
    return [
        (i, na, nb, ng, len(m), sum(corpus[p] == best[p[1]] for p in m), sum(corpus[p] for p in m), digest)
        for (i, na, nb, ng, digest), m in zip(found, links, strict=True)
    ]


def key(row):
    return tuple((value is not None, value) for value in row)


def frame(spark, rows, partitions):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)


def test_chunks_keep_the_text_and_the_ids():
    tokenizer = Tokenizer.from_file(BYTES)
    cache = chunk_tokens.byte_cache(BYTES)
    given = [t or "" for _, t in texts()] + [t for _, t, _ in documents()[:50] if t]
    assert all("".join(chunk_tokens.chunks(t)) == t for t in given)
    (ids,), (size,), _ = cache.encode(given)
    wanted = [tokenizer.encode(t, add_special_tokens=False).ids for t in given]
    assert size.tolist() == [*map(len, wanted)]
    assert ids.tolist() == [i for one in wanted for i in one]


def test_chunk_cache_stays_bounded(monkeypatch):
    monkeypatch.setattr(chunk_tokens, "MOST_CHUNKS", 10)
    cache = chunk_tokens.ChunkCache([lambda new: chunk_tokens.in_a_row([[len(c)] for c in new])])
    for k in range(50):
        (ids,), (size,), _ = cache.encode([f"a{k} b{k} c{k} often often", ""])
        assert size.tolist() == [5, 0]
        assert len(cache.places) <= 15
        assert ids.tolist() == [len(f"a{k}"), *[len(f" a{k}")] * 2, 6, 6]
    assert " often" in cache.places


@pytest.mark.parametrize("lanes", [1, 3, 4096])
def test_gallop_equals_binary_search(lanes):
    rng = np.random.default_rng(lanes)
    for n, m, top in ((0, 5, 9), (1, 1, 3), (50, 50, 100), (30, 4000, 5000), (500, 40_000, 10**6)):
        short, long = (np.unique(rng.integers(1, top, k)) for k in (n, m))
        assert ta.gallop(short, long, lanes).tolist() == np.searchsorted(long, short).tolist()


@pytest.mark.parametrize("partitions", [1, 5])
def test_alignment_equals_brute_force(spark, partitions):
    rows = texts() + [(i, t) for i, t, _ in documents()[:60]]
    found = ta.align(frame(spark, rows, partitions), BYTES, PIECES, digest=True).collect()
    assert sorted(map(tuple, found), key=key) == sorted(aligned(rows), key=key)


def test_alignment_of_odd_and_empty_tables(spark):
    found = ta.align(odd_docs(spark), BYTES, PIECES, digest=True).collect()
    assert sorted(map(tuple, found), key=key) == sorted(aligned(ODD), key=key)
    assert ta.align(empty_docs(spark), BYTES, PIECES).collect() == []


def test_groups_of_a_known_text(spark):
    row = ta.align(frame(spark, [(1, "ab")], 1), BYTES, PIECES).first()
    tokenizer, model = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a, b = tokenizer.encode(" ab").ids, model.encode("ab")
    assert (len(a), len(b)) == (1, 1)
    assert row.groups == f"{a[0]}|{b[0]}"
    assert (row.n_groups, row.n_links, row.n_best, row.count_sum) == (1, 1, 1, 1)


def check_packed(sequences, rows, length):
    tokenizer = Tokenizer.from_file(BYTES)
    sequences = sorted(sequences, key=lambda r: r.sequence_id)
    assert [s.sequence_id for s in sequences] == list(range(len(sequences)))
    line, pieces = [], defaultdict(list)
    for s in sequences:
        ids = list(struct.unpack(f"<{s.n}I", s.ids))
        assert s.n == length or s is sequences[-1]
        at = 0
        for p in s.pieces:
            assert p.offset == at and p.length > 0
            pieces[p.doc].append((p.start, ids[at : at + p.length], p.doc_tokens))
            at += p.length
        assert at == s.n
        line += ids
    wanted = defaultdict(list)
    for i, text in rows:
        wanted[i].append([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0])
    assert len(line) == sum(len(x) for one in wanted.values() for x in one)
    assert set(pieces) == set(wanted)
    for i, docs in wanted.items():
        whole, left = [], sorted(pieces[i], key=lambda p: (p[2], p[0]))
        for size in sorted({len(d) for d in docs}):
            some = [p for p in left if p[2] == size]
            copies = sum(p[0] == 0 for p in some)
            assert copies == sum(len(d) == size for d in docs)
            assert sum(len(p[1]) for p in some) == copies * size
            if copies == 1:
                whole.append([x for _, ids, _ in some for x in ids])
        assert all(w in docs for w in whole)


@pytest.mark.parametrize(("partitions", "length"), [(1, 1024), (6, 64), (3, 7)])
def test_packing_round_trip(spark, partitions, length):
    rows = texts() + [(1000 + i, t) for i, t, _ in documents()[:40]]
    found = packing.pack(frame(spark, rows, partitions), BYTES, length=length).collect()
    check_packed(found, rows, length)


def test_packing_of_odd_and_empty_tables(spark):
    check_packed(packing.pack(odd_docs(spark), BYTES, length=100).collect(), ODD, 100)
    assert packing.pack(empty_docs(spark), BYTES).collect() == []


def test_bundles_are_cut_at_every_place():
    import pyarrow as pa

    rng = np.random.default_rng(7)
    for base in (0, 1, 9, 10, 11, 25):
        sizes = rng.integers(1, 30, 8)
        ids = rng.integers(0, 50_000, sizes.sum()).astype(np.uint32)
        rows = packing.cut_bundle(base, pa.array(range(8)), sizes, ids, 10).to_pylist()
        assert b"".join(r["ids"] for r in rows) == ids.tobytes()
        places = [10 * r["sequence_id"] + r["at"] for r in rows]
        assert places == [base, *range(-(-(base + 1) // 10) * 10, base + len(ids), 10)]
        assert sum(p["length"] for r in rows for p in r["pieces"]) == len(ids)
        for r in rows:
            assert r["n"] == len(r["ids"]) // 4 == sum(p["length"] for p in r["pieces"])
            for p in r["pieces"]:
                first = 4 * (sizes[: p["doc"]].sum() + p["start"])
                at = 4 * (p["offset"] - r["at"])
                assert r["ids"][at : at + 4 * p["length"]] == ids.tobytes()[first : first + 4 * p["length"]]


WORDS = ["alpha", "beta", "gamma", "delta", "été", "ÉTÉ", "日本", "x y"]


def audit_rows(seed, sources, docs):
    rng = np.random.default_rng(seed)
    rows = [
        (
            int(k), " ".join(rng.choice(WORDS, rng.integers(0, 60))) + "\nAlpha-BETA 12 [x] \x7f",
            rng.choice(["en", "de", "en"]), rng.choice(sources, p=None),
        )
        for k in range(docs)
    ]
    return [(i, t, str(lang), str(source)) for i, t, lang, source in rows] + [
        (1, "only here", "en", "lone"), (1, "only here", "en", "lone"), (2, None, None, None), (3, "", "", "s"),
        (4, "word", None, ""), (None, "word word", "", None), (5, "word " * 3000, "xx", "s0"), (6, "12 34", "en", "bare"),
    ]


@pytest.mark.parametrize("partitions", [1, 7])
def test_audit_equals_sql(spark, partitions, monkeypatch):
    monkeypatch.setattr(divergence, "COMBINATIONS", 50)
    monkeypatch.setattr(divergence, "HELD_TERMS", 20)
    rows = audit_rows(partitions, [f"s{k}" for k in range(9)], 80)
    given = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    given = given.selectExpr("*", "1 AS term", "2 AS n", "3 AS p", "4 AS row", "5 AS zero").repartition(partitions)
    found = sorted(map(tuple, divergence.audit(given).collect()))
    with duckdb.connect() as base:
        base.register("documents", given.toPandas())
        wanted = sorted(base.execute(divergence.ORACLE_SQL).fetchall())
    assert found == wanted
    assert {row[2] for row in found} == {"pair", "term"}


def test_audit_of_empty_tables_and_top(spark):
    given = spark.createDataFrame([], "text string, lang string, source string")
    assert divergence.audit(given).collect() == []
    rows = [(f"t{k % 7}{'abcdefg'[k % 7]} " * (k % 5 + 1), "en", f"s{k % 3}") for k in range(60)]
    given = spark.createDataFrame(rows, "text string, lang string, source string")
    few = divergence.audit(given, top=2).filter("part = 'term'").collect()
    assert {r["rank"] for r in few} <= {1, 2}


def test_tree_counts_every_pair_of_entries():
    rng = np.random.default_rng(5)
    rows = sorted({
        (int(lang), tuple(sorted({int(s): int(rng.integers(1, 4)) for s in rng.integers(0, 6, 4)}.items())))
        for lang in rng.integers(0, 2, 200)
    })
    many = rng.integers(1, 10**9, len(rows))
    zero = {s: 3 + s for s in range(12)}
    p = lambda s, c: 1000 * c**3 + 7 * s + 10**6 * c
    wanted = defaultdict(int)
    f = lambda x, y: (x - y) ** 2 // y
    entries, ends = [], []
    for (lang, row), m in zip(rows, many.tolist(), strict=True):
        path = [(2 * s + lang, c) for s, c in row]
        for s, c in path:
            for r, d in path:
                if s != r:
                    a, b, a0, b0 = p(s, c), p(r, d), zero[s], zero[r]
                    wanted[s, r] += m * (f(a, b) - f(a, b0) - f(a0, b) + f(a0, b0))
        entries += path
        ends.append(len(entries))
    source, counts = (np.array(x, np.int64) for x in zip(*entries, strict=True))
    shares = np.array([p(s, c) for s, c in entries], np.int64)
    zeros = np.array([zero[s] for s, _ in entries], np.int64)
    got = defaultdict(int)
    for own, other, sums in divergence.tree_corrections(
        np.array(ends), many, np.array([lang for lang, _ in rows]), source, shares, zeros
    ):
        for s, r, value in zip(own.tolist(), other.tolist(), sums, strict=True):
            got[s, r] += value
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in wanted.items() if v}


def test_only_new_parts_of_chunks_are_encoded():
    told = []

    def encode(new):
        told.extend(new)
        return chunk_tokens.in_a_row([[len(c), ord(c[-1])] for c in new])

    cache = chunk_tokens.ChunkCache([encode], parts=chunk_tokens.Endings(["<|end|>"]))
    (ids,), (sizes,), _ = cache.encode(["one two, two. two", "two, it's%", "3, --"])
    assert sorted(told) == sorted(["one", " two", ",", ".", "two", " it's%", "3,", " --"])
    assert sizes.tolist() == [12, 6, 4]
    assert ids.tolist() == [3, 101, 4, 111, 1, 44, 4, 111, 1, 46, 4, 111, 3, 111, 1, 44, 6, 37, 2, 44, 3, 45]
    assert not chunk_tokens.Endings(["x}"]).fits and not chunk_tokens.Endings(["--"]).fits


def test_byte_ids_of_letters_and_signs():
    cache = chunk_tokens.byte_cache(BYTES)
    assert cache.parts is not None
    signs = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
    given = [f"word{c} Word{c}{c}, été{c}\nx{c} ª{c}'s{c} a²{c} 3{c}" for c in signs]
    given += [f"it's{c} don't{c}. 中{c} é{c} a{c}́ <|endoftext|>{c}" for c in signs]
    plain = chunk_tokens.ByteLevel(BYTES, True)
    for text in given:
        assert cache.encode([text])[0][0].tolist() == plain._ids([text])[0]


class Counted(chunk_tokens._Places):
    looks = 0

    def __getitem__(self, chunk):
        self.looks += 1
        return super().__getitem__(chunk)


def test_distinct_chunks_are_looked_up_once():
    """Before: one look-up for every chunk of every text."""
    cache = chunk_tokens.byte_cache(BYTES)
    places, cache.places = cache.places, Counted()
    cache.places.update(places)
    given = ["again and again, again.\nand " * 200] * 5
    try:
        (ids,), _, _ = cache.encode(given)
        assert cache.places.looks < 20
    finally:
        chunk_tokens._HELD.pop(("bytes", BYTES))
    assert ids.tolist() == Tokenizer.from_file(BYTES).encode(given[0], add_special_tokens=False).ids * 5


def test_letters_go_to_the_merges_alone(monkeypatch):
    """Before: the whole tokenizer, with its rule for pre-tokens, saw every new chunk."""
    encoder = chunk_tokens.ByteLevel(BYTES, True)
    told, given = [], encoder._ids
    monkeypatch.setattr(encoder, "_ids", lambda some: told.extend(some) or given(some))
    new = [" the", "Stra\u00dfe", " \u00c9t\u00e9\u00aa", "wordy", " it's", "\nand", "\u4e2d", " x9", " ", "--"]
    ids, size = encoder(new)
    assert not any(word in text for text in told for word in ("the", "Stra", "t\u00e9", "wordy"))
    wanted = given(new)
    assert size.tolist() == [*map(len, wanted)] and ids.tolist() == [i for one in wanted for i in one]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=" \t\n\x0b\x1c\rAZaz9'_,!\u00c9\u00e9\u00d7\u00f7\u00aa\u00b5\u00df\u00a0\u2003\u4e2d\u0301\U0001f600", max_size=30))), st.integers(0, 3))
def test_cuts_on_bytes_are_those_of_the_rules(texts, skip):
    import re

    letters = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
    ending = re.compile(f"( ?[{letters}]+)([_,!]*)")
    odd = re.compile("[\x0b\x1c\r\u00a0\u2003]")
    array = pa.array(["xx", *texts], pa.string()).slice(1)[skip:]
    for words in (False, True):
        for lower in (False, words):
            for parts in (None, chunk_tokens.Endings([], lower)):
                wanted = []
                for text in texts[skip:]:
                    text = text or ""
                    if words:
                        cut = re.findall("[^ \t\n\x0b\x0c\r]+", text)
                    else:
                        cut = [text] if odd.search(text) else re.findall("[ \t\n]*[^ \t\n]+|[ \t\n]+", text)
                    found = [ending.fullmatch(c) if parts else None for c in cut]
                    wanted.append([p for c, m in zip(cut, found) for p in (((m[1].lower() if lower else m[1]), m[2]) if m else (c,)) if p])
                flat, counts = chunk_tokens.cut_texts(array, parts, words)
                assert flat.to_pylist() == [p for one in wanted for p in one]
                assert counts.tolist() == [*map(len, wanted)]
