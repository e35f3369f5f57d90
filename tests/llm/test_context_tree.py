"""Context-tree weighting against its recursive definition, and the unigram base against counts."""

import math
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.cases import ODD, SF, documents, empty_docs, odd_docs
from winnow.llm import context_tree
from winnow.llm.common import fold_of
from winnow.llm.queries import QUERIES

D = context_tree.DEPTH


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def stream(text):
    return b"\xff" * D + b" ".join(tokens(text)[:-1]) + b"\xff"


class Tree:
    """Counts per (decision node, context), weighted by the textbook recursion."""

    def __init__(self, texts):
        self.n = defaultdict(lambda: [0, 0])
        self.children = defaultdict(set)
        for text in texts:
            for context, node, bit in self.decisions(text):
                for d in range(D + 1):
                    self.n[node, context[:d]][bit] += 1
                    if d:
                        self.children[node, context[: d - 1]].add(context[:d])
        self.memo = {}

    @staticmethod
    def decisions(text):
        raw = stream(text)
        for i in range(D, len(raw)):
            node = 1
            for k in range(8):
                bit = raw[i] >> (7 - k) & 1
                yield bytes(reversed(raw[i - D : i])), node, bit
                node = node << 1 | bit

    def estimate(self, node, context):
        a, b = self.n.get((node, context), (0, 0))
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weighted(self, node, context):
        key = node, context
        if key not in self.memo:
            own = self.estimate(node, context)
            if len(context) < D:
                below = sum(self.weighted(node, c) for c in self.children.get(key, ()))
                own = math.log(0.5) + own + math.log1p(math.exp(below - own)) if below <= own else (
                    math.log(0.5) + below + math.log1p(math.exp(own - below))
                )
            self.memo[key] = own
        return self.memo[key]

    def chance(self, node, context, bit, d=0):
        counts = self.n.get((node, context[:d]), (0, 0))
        own = (counts[bit] + 0.5) / (sum(counts) + 1)
        if d == D:
            return own
        weight = math.exp(math.log(0.5) + self.estimate(node, context[:d]) - self.weighted(node, context[:d]))
        return weight * own + (1 - weight) * self.chance(node, context, bit, d + 1)

    def score(self, text):
        return sum(math.log10(self.chance(n, c, b)) for c, n, b in self.decisions(text))


TEXTS = ["abra cadabra", "Abra abra cad", "the cat sat on the mat", "", None, "é ß", "the  dog\nsat", "abra cadabra"]


def test_scores_equal_the_recursion(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(3)
    found = {r.doc_id: r for r in context_tree.score_texts(docs, F.col("doc_id") % 3 != 1).collect()}
    tree = Tree([t for i, t in enumerate(TEXTS) if i % 3 != 1])
    for i, text in enumerate(TEXTS):
        assert found[i].score == pytest.approx(tree.score(text), rel=1e-5)
        assert found[i].n_bytes == len(stream(text)) - D


def test_next_bytes_sum_to_one():
    tree = Tree(["abab abba", "baab"])
    context = bytes(reversed(b"\xff\xff" + b"abab"[-3:]))[:D]
    total = 0.0
    for byte in range(256):
        p, node = 1.0, 1
        for k in range(8):
            bit = byte >> (7 - k) & 1
            p *= tree.chance(node, context, bit)
            node = node << 1 | bit
        total += p
    assert total == pytest.approx(1.0)


def test_base_on_table(spark):
    rows = {r.doc_id: r for r in QUERIES["op1_context_tree"](spark, SF).collect()}
    docs = documents()
    counts = Counter(t for i, text, _ in docs if fold_of(i, 7) != 2 for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    assert len(rows) == len(docs)
    for i, text, _ in docs:
        r, own = rows[i], tokens(text)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (fold_of(i, 7) == 2, len(own), n)
        assert r.n_known == sum(counts[t] > 0 for t in own)
        assert r.base_score == pytest.approx(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own))
        assert r.score < 0


def test_odd_rows(spark):
    rows = context_tree.score_texts(odd_docs(spark), F.col("doc_id") < 9).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for i, _ in ODD)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert by[1][0].score == by[1][1].score == by[2][0].score == pytest.approx(by[3][0].score)
    assert {by[i][0].n_tokens for i in (4, 5, 6)} == {1} and by[12][0].n_tokens == 8001
    assert context_tree.score_texts(empty_docs(spark), F.col("doc_id") < 9).count() == 0
    unlearned = context_tree.score_texts(odd_docs(spark), F.lit(None).cast("boolean")).collect()
    assert {r.n_known for r in unlearned} == {0} and {r.train_tokens for r in unlearned} == {0}


def test_small_bundles_give_the_same(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    whole = {r.doc_id: r for r in context_tree.score_texts(docs, F.col("doc_id") % 2 == 0).collect()}
    split = context_tree.score_texts(docs.repartition(11), F.col("doc_id") % 2 == 0).collect()
    for r in split:
        assert r.base_score == pytest.approx(whole[r.doc_id].base_score)
        assert r.score == pytest.approx(whole[r.doc_id].score, rel=1e-6)


def test_windows_of_a_bundle_in_pieces(monkeypatch):
    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(97, 107, rng.integers(0, 60), np.uint8)) for _ in range(400)]
    learned = [bool(k % 3) for k in range(len(texts))]
    code, starts = context_tree.windows(texts)
    own = np.repeat(learned, np.diff(np.r_[starts, len(code)]))
    expected = Counter(dict.fromkeys(code.tolist(), 0))
    expected.update(code[own].tolist())
    for size in (1, 100, 1 << 20):
        monkeypatch.setattr(context_tree, "PIECE_BYTES", size)
        parts = list(context_tree.pieces_of(texts))
        assert [k for part in parts for k in range(part.start, part.stop)] == list(range(len(texts)))
        found, n = context_tree._window_counts(texts, learned)
        assert list(zip(found.tolist(), n.tolist())) == sorted(expected.items())


def test_a_bundle_takes_little_memory():
    texts = [b"some words that come again " * 40] * 4000  # 4.3 MB
    tracemalloc.start()
    try:
        context_tree._window_counts(texts, [True] * len(texts))
        assert tracemalloc.get_traced_memory()[1] < 100e6  # 143 MB with all windows at a time
    finally:
        tracemalloc.stop()
