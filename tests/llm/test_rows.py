"""Quality rules, secrets and the two classifiers: row by row, on odd rows, and held-out accuracy."""

import hashlib
import math
import re
import time
from collections import Counter

import duckdb
import numpy as np
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.cases import ODD, SF, documents, empty_docs, odd_docs
from winnow.llm import compression_quality, language_id, quality_rules, secret_scan
from winnow.llm.common import fold, fold_of
from winnow.llm.queries import QUERIES

WORD = r"[^\x20\x09-\x0D]+"


def plain_measures(text):
    text = text or ""
    words = re.findall(WORD, text)
    lines, dup = set(), 0
    for line in text.split("\n"):
        if re.search(WORD, line):
            dup += line in lines
            lines.add(line)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside), failed)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "c", "#x", "\n", " ", "\t"]), max_size=60).map(" ".join))
def test_quality_measures(text):
    found = quality_rules.measure(text)
    assert (*found[:5], found[8]) == plain_measures(text)


def test_quality_query_on_table(spark):
    texts = {i: t for i, t, _ in documents()}
    rows = QUERIES["op9_quality_rules"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        given_row = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert given_row == plain_measures(texts[r.doc_id])
        assert not (r.kept and r.base_failed)


def test_quality_coverage_without_hash_luck(monkeypatch):
    """With useless hashes the exact comparison alone must give the same measures."""
    text = "a b c d e f g a b c d e f g h i j k"
    right = quality_rules.measure(text)
    monkeypatch.setattr(quality_rules, "mixed", lambda x: np.zeros(len(x), np.uint64))
    assert quality_rules.measure(text) == right


def test_quality_long_repeats_fail():
    assert not quality_rules.measure("one two three four five six\n" * 30)[9]
    assert quality_rules.measure(" ".join(f"w{i}" for i in range(50)))[9]
    assert not quality_rules.measure(" ".join(f"w{i}##" for i in range(50)))[9]


def plain_verdict(text):
    """Rules that fail beyond the base rule, counted window by window."""
    words, failed = re.findall(WORD, text), set()
    chars = sum(map(len, words))
    for n, limit in {**quality_rules.TOP_LIMITS, **quality_rules.COVERAGE_LIMITS}.items():
        windows = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        count = Counter(windows)
        chosen = {w for w, k in count.items() if k > 1}
        if n < 5:  # dictionaries keep the order of first appearance, and so does max
            chosen &= {max(count, key=count.get)} if count else set()
        inside = {i + k for i, w in enumerate(windows) if w in chosen for k in range(n)}
        if inside and sum(len(words[i]) for i in inside) / chars > limit:
            failed.add(f"top_{n}" if n < 5 else f"repeat_{n}")
    return failed


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", "bb", "ccc", "d", "e", "f", "g"]), max_size=80).map(" ".join))
def test_quality_verdict(text):
    found = set(quality_rules.measure(text)[10].split(",")) - {"", "lines", "symbols"}
    assert found == plain_verdict(text)


def test_quality_limits_bind():
    """Texts that pass the base rule and have few symbols, but repeat too much."""
    texts = duckdb.sql("SELECT text FROM '/root/testdata/sf0.1/documents.parquet'").fetchall()
    alone = 0
    for (text,) in texts:
        row = quality_rules.measure(text)
        if not row[8] and row[10] and "symbols" not in row[10]:
            assert not row[9] and set(row[10].split(",")) - {"lines"} == plain_verdict(text)
            alone += 1
    assert alone > 20


@pytest.mark.parametrize("text", ["\u00b2\u00bd\u2460\u2167", "12 _ !", "\U0001f642", "", None])
def test_texts_without_a_letter_have_no_language(text):
    assert not language_id.has_letter(text)
    assert language_id.has_letter((text or "") + "\u00b2x") and language_id.has_letter("\U00010400")


def test_long_texts_are_scored_like_short_ones(monkeypatch):
    weights = np.random.default_rng(3).normal(size=(language_id.BUCKETS, 3))
    model = language_id.Model(("a", "b", "c"), weights, np.zeros(3), 1.0)
    text = "some words \u00e9\u00e8, and more  of them " * 40
    whole = model.predictor()(text)
    monkeypatch.setattr(language_id, "_SLICE", 50)
    lang, score = model.predictor()(text)
    assert lang == whole[0] and abs(score - whole[1]) < 1e-9


def test_code_is_no_secret():
    for text in ('SECRET_KEY = os.environ["X"] or 1', "secret_key = load(1)", "password = config.db.password"):
        assert secret_scan.named_spans(text) == []
    assert secret_scan.named_spans('x = "hunter2hunter2"\nadmin_passphrase = x')


def test_one_line_of_json_is_read_in_linear_time():
    def seconds(n):
        text = "{" + ", ".join(f'"key{i}": {i}, "db_password": "pw{i}{i}xQz9"' for i in range(n)) + "}"
        start = time.process_time()
        assert len(secret_scan.named_spans(text)) >= n - 1
        return time.process_time() - start

    seconds(2000)
    assert seconds(40_000) < 12 * max(0.05, seconds(10_000))


def plain_base_spans(text):
    text = text or ""
    spans = []
    assign = re.compile(secret_scan.ASSIGN.pattern, re.I | re.A)
    for kind, pattern, least, group in (
        ("assign", assign, 6, 2), ("access", re.compile("AKIA[A-Z0-9]+"), 20, 0), ("hex", re.compile("[0-9a-f]+"), 24, 0),
    ):
        spans += [(*m.span(), kind) for m in pattern.finditer(text) if len(m[group]) >= least]
    order = ("assign", "access", "hex")
    return sorted(spans, key=lambda s: (s[0], order.index(s[2])))


@settings(max_examples=150, deadline=None)
@given(
    st.lists(
        st.sampled_from(
            ["password", "PassWD", "token", "api_key", "Secret", "=", ":", " ", '"', "'", "abcdef123", "0f" * 12,
             "AKIA", "AKIA" + "Z" * 16, "\n", "é", "x"]
        ), max_size=25,
    ).map("".join)
)
def test_base_spans(text):
    assert [s for s in secret_scan.scan(text) if s[2] != "named"] == plain_base_spans(text)


def test_secret_query_on_table(spark):
    texts = {i: t for i, t, _ in documents()}
    for r in QUERIES["op10_secret_scan"](spark, SF).collect():
        spans = plain_base_spans(texts[r.doc_id])
        joined = ",".join(f"{k}:{s}:{e}" for s, e, k in spans)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(
            sum(k == kind for _, _, k in spans) for kind in ("assign", "access", "hex")
        )


@pytest.mark.parametrize(
    "text, found",
    [
        ('db_pass = "S3cr3t-Value-91"', ["S3cr3t-Value-91"]),
        ('base = "Zx81kq-77Qp"\nclient_credential = base\n', ["Zx81kq-77Qp"]),
        ("part = 'qW3r'\npassphrase = part + '8uT5x1'", ["qW3r", "8uT5x1"]),
        ('{"privateKey": "mF9s81LLq0Zt"}', ["mF9s81LLq0Zt"]),
        ("signing_key: Kd83jS9q2LmX", ["Kd83jS9q2LmX"]),
        ("auth['bearer'] = 'p0Lq81mZx4tR'", ["p0Lq81mZx4tR"]),
        ("credential: str = 'x9Qm2Kp4Lz7'", ["x9Qm2Kp4Lz7"]),
        ('title = "A long harmless value 123"', []),
        ('credential = "changeme"', []),
        ("credentials_path = 'Conf1g/ABC123'", []),
        ("We said: the key to it all = trust", []),
        ("if passphrase == 'x9Qm2Kp4Lz7': pass", []),
        ("credential = ${VAULT_VALUE_9}", []),
        ("monkey = 'x9Qm2Kp4Lz7'", []),
        ("access_token = None", []),
        ("auth_token = get_x", []),
        ("api_key: none", []),
        ("auth_credential = '${VAULT_VALUE_9}'", []),
        ("auth_credential = 'nine blue horses run'", ["nine blue horses run"]),
        ('#define DB_PASS "S3cr3t-Value-91"', ["S3cr3t-Value-91"]),
        ("# define SIGNING_KEY Kd83jS9q2LmX", ["Kd83jS9q2LmX"]),
        ('<add key="private.key" value="mF9s81LLq0Zt"/>', ["mF9s81LLq0Zt"]),
        ("<property value='mF9s81LLq0Zt' name='db.credential'>", ["mF9s81LLq0Zt"]),
        ("<dbCredential> p0Lq81mZx4tR </dbCredential>", ["p0Lq81mZx4tR"]),
        ("<api-key>where to find it</api-key>", []),
        ('<p name="intro" value="mF9s81LLq0Zt">', []),
        ("<passphrase><b>p0Lq81mZx4tR</b></passphrase>", []),
        ('client.setPassphrase("qW3r8uT5x1")', ["qW3r8uT5x1"]),
        ("conf.set('auth.bearer', 'p0Lq81mZx4tR')", ["p0Lq81mZx4tR"]),
        ("conf.set('auth.bearer', p0Lq81mZx4tR)", []),
        ("setName('p0Lq81mZx4tR')", []),
        ("x = 'Zx81kq-77Qp'\nclient.set_credential('' + x)", ["Zx81kq-77Qp"]),
        ('passphrase = "qW3r" "8uT5x1"', ["qW3r", "8uT5x1"]),
        ('passphrase = "qW3r" \\\n  "8uT5x1";', ["qW3r", "8uT5x1"]),
        ('passphrase: "qW3r8uT5x1"\n  "note": "Zx81kq-77Qp"', ["qW3r8uT5x1"]),
        ("client_credential = base\nbase = 'Zx81kq-77Qp'", ["Zx81kq-77Qp"]),
        ("client_credential = a\na = b + 'x9'\nb = 'Zx81kq-77Qp'", ["x9", "Zx81kq-77Qp"]),
        ("client_credential = a\na = b\nb = a", []),
    ],
)
def test_named_literals(text, found):
    spans = [s for s in secret_scan.scan(text) if s[2] == "named"]
    assert [text[s:e] for s, e, _ in spans] == found


def test_constants_of_many_literals_and_doubled_constants():
    pieces = [f"aB{k}xY" for k in range(40)]
    many = "b = " + " + ".join(f'"{p}"' for p in pieces) + "\nc = b\nd = c\nsigning_credential = d\n"
    assert [many[s:e] for s, e, _ in secret_scan.scan(many)] == pieces
    doubled = "x = 'qW3r8u'\n" + "x = x + x\n" * 3000 + "passphrase = x\n"
    assert [doubled[s:e] for s, e, _ in secret_scan.scan(doubled)] == ["qW3r8u"]
    short = "x = 'a1b'\ncredential = x + x + x\n"
    assert [short[s:e] for s, e, _ in secret_scan.scan(short)] == ["a1b"]
    grown = "private_key = 'aB1'\n" + "private_key = private_key + 'x9Yz'\n" * 20_000
    assert len(secret_scan.scan(grown)) == 20_001


@settings(max_examples=150, deadline=None)
@given(st.data())
def test_propagation_equals_expansion(data):
    """Names bound once, in any order of lines: spans equal those of plain recursive expansion."""
    n = data.draw(st.integers(1, 8))
    parts = [
        data.draw(st.lists(st.sampled_from(range(-1, k)), min_size=1, max_size=4)) for k in range(n)
    ]  # part -1 is a literal of its own, k the name of a lower number
    secret = data.draw(st.lists(st.booleans(), min_size=n, max_size=n))
    names = [f"{'credential' if secret[k] else 'value'}_{chr(97 + k)}" for k in range(n)]
    text, spans = "", {}
    for k in data.draw(st.permutations(range(n))):
        text += f"{names[k]} = "
        for i, part in enumerate(parts[k]):
            text += " + " if i else ""
            if part < 0:
                value = f"q{k}W{i}-Lm9xT{k}{i}pZ"
                spans[k, i] = (len(text) + 1, len(text) + 1 + len(value))
                text += f"'{value}'"
            else:
                text += names[part]
        text += "\n"

    def expanded(k):
        return {
            span
            for i, part in enumerate(parts[k])
            for span in ([spans[k, i]] if part < 0 else expanded(part))
        }

    wanted = set().union(*(expanded(k) for k in range(n) if secret[k]))
    assert secret_scan.named_spans(text) == sorted(wanted)


def test_precision_and_recall_on_generated_sources():
    """Every syntax with every name and value: secrets under telling names, none elsewhere."""
    syntaxes = (
        "{n} = '{v}'", 'const {n} = "{v}";', '{{"{n}": "{v}"}}', "{n}: {v}", "export {n}={v}", '#define {n} "{v}"',
        '<add key="{n}" value="{v}"/>', "<{n}>{v}</{n}>", 'conf.put("{n}", "{v}");', "self.{n}: str = '{v}'",
        "{n} = tmp\ntmp = '{v}'", "tmp = '{v}'\nobj['{n}'] = tmp", '{n} = "" \\\n    "{v}"',
    )
    telling = ("db_credential", "clientPassphrase", "signing_key", "AUTH_BEARER", "privateKey", "admin_pwd")
    plain = ("title", "public_key", "color_code", "credential_path", "monkey", "version", "auth_url")
    rng = np.random.default_rng(11)
    letters = np.array(list("abcdefghijkmnopqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789-"))
    hits = wrong = secrets = 0
    for names, is_secret in ((telling, True), (plain, False)):
        for syntax in syntaxes:
            for name in names:
                for length in (10, 16, 28):
                    value = "k" + "".join(rng.choice(letters, length)) + "7Q"
                    text = f"one line\n{syntax.format(n=name, v=value)}\nlast line\n"
                    found = [text[s:e] for s, e in secret_scan.named_spans(text)]
                    secrets += is_secret
                    hits += is_secret and value in found
                    wrong += len([f for f in found if not is_secret or f != value])
    print("secrets", secrets, "found", hits, "wrong", wrong)
    assert hits >= 0.95 * secrets and wrong <= 0.02 * secrets


def test_sums_score_like_the_text(monkeypatch):
    values = ["x9Qm2Kp4Lz7", " lead", "trail ", "  ", "xxx", "XXXX", "***", "your_", "<a", "b>", "${", "}", "é1", "in side"]
    rng = np.random.default_rng(3)
    monkeypatch.setattr(secret_scan, "_LONG", 0)
    for _ in range(500):
        parts = [values[k] for k in rng.integers(0, len(values), rng.integers(2, 6))]
        whole = secret_scan._together([secret_scan._Value([False, 0, 1], p, True) for p in parts])
        if len("".join(parts)) >= 18:
            assert whole.text is None
            assert whole.score == pytest.approx(secret_scan.literal_score("".join(parts)))


def test_redaction():
    text = 'a password = "hunter2hunter2" b AKIA' + "A" * 16 + " c"
    assert secret_scan.redact(text, secret_scan.scan(text)) == 'a [secret]" b [secret] c'
    assert secret_scan.redact("clean", []) == "clean"
    assert secret_scan.redact(None, []) is None


def test_odd_rows(spark):
    for make in (quality_rules.quality_rules, secret_scan.scan_secrets):
        rows = make(odd_docs(spark)).collect()
        assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for i, _ in ODD)
        assert make(empty_docs(spark)).count() == 0
    again = {r.doc_id: r for r in secret_scan.redact_secrets(odd_docs(spark)).collect()}
    assert again[7].text == "word" and again[4].text is None and "[secret]" in again[15].text
    assert secret_scan.redact_secrets(odd_docs(spark)).columns == odd_docs(spark).columns


def test_language_accuracy_and_odd_rows(spark):
    langs = {i: lang for i, _, lang in documents()}
    rows = QUERIES["op3_language_id"](spark, SF).collect()
    assert len(rows) == len(langs)
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in langs if fold_of(i, 4) == 2}
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.9 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.fit(docs, fold("doc_id", 4) != 2)
    odd = language_id.identify(odd_docs(spark), model).collect()
    assert len(odd) == len(ODD)
    found = {r.doc_id: r.lang_pred for r in odd if r.doc_id is not None}
    assert all(found[i] == "und" for i in (4, 5, 6, 9)) and found[7] != "und"
    assert language_id.identify(empty_docs(spark), model).count() == 0
    nothing = language_id.fit(docs.filter("false"), fold("doc_id", 4) != 2)
    assert {r.lang_pred for r in language_id.identify(odd_docs(spark), nothing).collect()} == {"und"}


def test_language_weights_are_sparse():
    rng = np.random.default_rng(0)
    rows = [(np.sort(rng.choice(500, 40, replace=False)) + 500 * (k % 2), np.ones(40), k % 2) for k in range(60)]
    weights, _ = language_id.train(rows, 2)
    used = np.abs(weights[:1000]).sum(axis=1)
    assert (used == 0).any() and not weights[1000:].any()
    logits = np.array([values @ weights[at] for at, values, _ in rows])
    assert (logits.argmax(axis=1) == [kind for *_, kind in rows]).all()


def test_temperature():
    rng = np.random.default_rng(1)
    truth = rng.normal(size=(4000, 3))
    p = np.exp(truth) / np.exp(truth).sum(axis=1, keepdims=True)
    kinds = np.array([rng.choice(3, p=q) for q in p])
    assert 1.7 < language_id.fit_temperature(truth * 2, kinds) < 2.3


def test_quality_classifier(spark):
    """Held-out labels of a larger table; odd rows, no labels, one class only."""
    sf = "/root/testdata/sf0.01"
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{sf}/labels.parquet'").fetchall())
    rows = QUERIES["op2_compression_quality"](spark, sf).collect()
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    right = sum(r.predicted == labels[r.doc_id] for r in held)
    assert right >= 0.9 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    table = spark.read.parquet(f"{SF}/labels.parquet")
    model = compression_quality.fit(docs, table, fold("doc_id", 4) != 2)
    odd = compression_quality.score(odd_docs(spark), model).collect()
    assert len(odd) == len(ODD) and all(r.score is not None for r in odd)
    assert compression_quality.score(empty_docs(spark), model).count() == 0
    none = compression_quality.fit(docs, table.filter("false"), fold("doc_id", 4) != 2)
    assert {r.score for r in compression_quality.score(docs, none).collect()} == {0.5}
    one = compression_quality.fit(docs, table.filter("quality = 1"), fold("doc_id", 4) != 2)
    assert min(r.score for r in compression_quality.score(docs, one).collect()) > 0.9


def plain_language(text, model):
    """Language and score from n-grams counted one by one, with 32-bit products in Python integers."""
    if not any(c.isalpha() for c in text or ""):
        return "und", 0.0
    line = " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "
    x, mask = [ord(c) for c in line], 0xFFFFFFFF
    found = []
    for i in range(len(x) - 1):
        two = (x[i] * 0x9E3779B1 + x[i + 1] * 0x85EBCA77) & mask
        found.append(two >> 16)
        if i + 2 < len(x):
            three = ((two ^ (two >> 15)) * 0xC2B2AE3D + x[i + 2] * 0x27D4EB2F) & mask
            found.append(three >> 16)
    z = []
    for k in range(len(model.languages)):
        total = sum(float(model.weights[bucket, k]) for bucket in found)
        z.append((total * language_id.SCALE / len(found) + model.bias[k]) / model.temperature)
    p = [math.exp(v - max(z)) for v in z]
    best = p.index(max(p))
    return model.languages[best], p[best] / sum(p)


def test_language_scores_equal_plain_logits(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.fit(docs, fold("doc_id", 4) != 2)
    texts = {r.doc_id: r.text for r in docs.unionByName(odd_docs(spark), True).collect() if r.doc_id is not None}
    few = [i for i in sorted(texts) if len(texts[i] or "") < 4000][:60]
    given_rows = spark.createDataFrame([(i, texts[i]) for i in few], "doc_id long, text string")
    rows = language_id.identify(given_rows, model).collect()
    assert len(rows) == len(few)
    for r in rows:
        lang, score = plain_language(texts[r.doc_id], model)
        assert r.lang_pred == lang and r.score == pytest.approx(score, abs=1e-4)


def test_models_of_repeated_ids_and_other_partitions(spark):
    """Rows that come twice change neither sample nor model; so does no other order of rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    learn = fold("doc_id", 4) != 2
    mixed = docs.unionAll(docs).repartition(7)
    one = compression_quality.fit(docs, labels, learn)
    two = compression_quality.fit(mixed, labels.unionAll(labels).repartition(3), learn)
    assert (one.good, one.bad) == (two.good, two.bad) and one.weights == pytest.approx(two.weights)
    first = language_id.fit(docs, learn, sample_rows=10)
    again = language_id.fit(docs.repartition(5), learn, sample_rows=10)
    assert first.languages == again.languages and np.allclose(first.weights, again.weights)
    # Every id twice: the inverse document frequencies differ a little, the sample has half its ids or all.
    repeated = language_id.fit(mixed, learn)
    assert repeated.languages == language_id.fit(docs, learn).languages


def plain_difference(text, model):
    raw, total = (text or "").encode(), 0
    for at in range(0, len(raw), model.window):
        sizes = []
        for dictionary in (model.bad, model.good):
            packer = zstandard.ZstdCompressor(
                level=model.level, dict_data=zstandard.ZstdCompressionDict(dictionary),
                write_content_size=False, write_dict_id=False,
            )
            sizes.append(len(packer.compress(raw[at : at + model.window])))
        total += sizes[0] - sizes[1]
    return total / (len(raw) + 1)


def test_quality_scores_equal_plain_sizes(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = compression_quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"), fold("doc_id", 4) != 2)
    texts = {i: t for i, t, _ in documents()}
    a, b = model.weights
    for r in compression_quality.score(docs, model).collect():
        difference = plain_difference(texts[r.doc_id], model)
        assert r.difference == pytest.approx(difference, abs=0.002)
        assert r.score == pytest.approx(1 / (1 + math.exp(-(a * r.difference + b))))
        assert r.predicted == (r.score >= 0.7)


def test_quality_fit_on_all_windows_agrees(spark):
    """The bound on windows per sampled text moves few verdicts."""
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{name}.parquet") for name in ("documents", "labels"))
    learn = fold("doc_id", 4) != 2
    verdicts = [
        {r.doc_id: r.predicted for r in compression_quality.score(docs, model).select("doc_id", "predicted").collect()}
        for model in (
            compression_quality.fit(docs, labels, learn),
            compression_quality.fit(docs, labels, learn, windows_per_text=1 << 30),
        )
    ]
    same = sum(verdicts[0][i] == verdicts[1][i] for i in verdicts[0])
    print("equal verdicts", same, "of", len(verdicts[0]))
    assert same >= 0.95 * len(verdicts[0])
