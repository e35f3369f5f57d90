"""Benchmark decontamination: SimHash windows of item size, multi-index Hamming blocks, exact check.

* Words are cut at Unicode white space, in items and documents alike, lower-cased and stripped of outer punctuation.  A window's fingerprint is the 64-bit
  majority vote of its words' XXH64 hashes, from running counts per bit.
* Windows have four fifths of the sizes of the items, rounded down to a geometric series, and start at
  every ``STRIDE``-th word of a text.  Every item is indexed at all offsets, so that a passage meets
  two aligned windows or more wherever it starts, a cut one too.  A window lies in one text:
  what is found in a text depends on it alone, not on its neighbours or the partitioning.
* Multi-index: of the four 16-bit blocks of two fingerprints within ``RADIUS`` (7) bits, one differs in
  at most one bit.  Each block table lists every fingerprint under its value and the 16
  neighbours of it, so a look-up finds *all* fingerprints within the radius.
* Every candidate is checked on the words: weighted Jaccard similarity (multiplicities as weights) of
  five-word shingles between the item and the passage, best of a few shifts, at least 0.8.  The
  passage has as many words as the item, fewer where the text begins or ends inside it.

The benchmark is measured first and cut into slices of bounded size; each slice is broadcast in
turn, so the index never outgrows a task.  Work is row-local: a passage that many documents share
costs each of them the same.  NULL and empty texts hold nothing, and NULL and empty items are in no
text; an item shorter than five words is one shingle, found where its words stand in a row; repeated
items are reported under each of their ids.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm.common import map_texts, unused

RADIUS = 7
STRIDE = 4
SHINGLE = 5
SIMILARITY = 0.8
SLICE_ITEMS, SLICE_CHARS = 20_000, 4 << 20
_CHUNK = 1 << 16  # words at once
_EDGES = ".,;:!?\"'()[]{}<>«»“”‘’…-–—*_`|/\\#$%&"


def words_of(text: str | None) -> list[str]:
    """The raw words of an item or a document: whatever Unicode white space keeps apart."""
    return (text or "").split()


def normal(word: str) -> str:
    return word.casefold().strip(_EDGES)


def shingles(words: Sequence, n: int = SHINGLE) -> Counter:
    return Counter(zip(*(words[k:] for k in range(n))))


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard similarity of two multisets."""
    common = sum((a & b).values())
    union = sum(a.values()) + sum(b.values()) - common
    return common / union if union else 0.0


def _hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode("utf-8", "replace"), 7)


def _stride(n: int) -> int:
    return 1 if n < 12 else STRIDE


def _window(n: int) -> int:
    """Window size for items of ``n`` words: the next lower value of a geometric series.

    An item of less than nine words must be met whole; a longer one leaves room for two aligned windows.
    """
    if n < 9:
        return n
    room, size = min(n - 2 * _stride(n) + 1, n * 4 // 5), 1
    while (up := max(size + 1, size * 4 // 3)) <= room:
        size = up
    return size


def _running(hashes: np.ndarray, most: int) -> np.ndarray:
    """Set bits before every word, per bit.

    For windows below 256 words, eight one-byte counters share a 64-bit number.  The totals overflow
    from byte to byte, but the difference over a window is the sum inside it, which fits.
    """
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    if most < 256:
        out = np.zeros((len(hashes) + 1, 8), np.uint64)
        np.cumsum(bits.view(np.uint64), axis=0, out=out[1:])
    else:
        out = np.zeros((len(hashes) + 1, 64), np.uint32)
        np.cumsum(bits, axis=0, dtype=np.uint32, out=out[1:])
    return out


def _prints(running: np.ndarray, size: int, stride: int) -> np.ndarray:
    """Fingerprints of the windows of ``size`` words at every ``stride``-th start."""
    if len(running) <= size:
        return np.zeros(0, np.uint64)
    counts = running[size::stride] - running[: len(running) - size : stride]
    if counts.dtype == np.uint64:
        counts = counts.view(np.uint8)
    return np.packbits((counts > size // 2).ravel(), bitorder="little").view(np.uint64)


class _Blocks:
    """Multi-index over fingerprints: four tables by 16-bit block, with one-bit neighbours."""

    def __init__(self, prints: np.ndarray):
        self.prints = prints
        blocks = prints.view(np.uint16).reshape(-1, 4).astype(np.int64)
        near = np.r_[0, 1 << np.arange(16)]
        self.tables = []
        for k in range(4):
            key = (blocks[:, k, None] ^ near).ravel()
            order = np.argsort(key, kind="stable")
            bounds = np.searchsorted(key[order], np.arange(65537))
            self.tables.append((np.diff(bounds) > 0, bounds, (order // len(near)).astype(np.int32)))

    def search(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pairs (query, entry) within the radius."""
        blocks = queries.view(np.uint16).reshape(-1, 4)
        found = []
        for k, (some, bounds, entries) in enumerate(self.tables):
            at = np.flatnonzero(some[blocks[:, k]])
            if not len(at):
                continue
            value = blocks[at, k].astype(np.int64)
            count = bounds[value + 1] - bounds[value]
            place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            entry = entries[np.repeat(bounds[value], count) + place]
            query = np.repeat(at, count)
            near = np.bitwise_count(queries[query] ^ self.prints[entry]) <= RADIUS
            found.append(query[near] * len(self.prints) + entry[near])
        if not found:
            none = np.zeros(0, np.int64)
            return none, none
        return np.divmod(np.unique(np.concatenate(found)), len(self.prints))


class Index:
    """Windows of a slice of the benchmark."""

    def __init__(self, items: list[tuple[object, str]]):
        self.ids, self.words = [], []
        for item, text in items:
            words = [normal(word) for word in words_of(text)]
            if words:
                self.ids.append(item)
                self.words.append(words)
        self.grams = [shingles(words, min(SHINGLE, len(words))) for words in self.words]
        entries: dict[tuple[int, int], list] = {}
        for k, words in enumerate(self.words):
            size, stride = _window(len(words)), _stride(len(words))
            hashes = np.array([_hash(word) for word in words], np.uint64)
            prints = _prints(_running(hashes, len(hashes) + 1), size, 1)
            entries.setdefault((size, stride), []).extend((p, k, offset) for offset, p in enumerate(prints))
        self.classes = []
        for (size, stride), rows in sorted(entries.items()):
            prints, items_at, offsets = zip(*rows, strict=True)
            self.classes.append(
                (size, stride, _Blocks(np.array(prints, np.uint64)), np.array(items_at), np.array(offsets))
            )
        self.longest = max((size for size, *_ in self.classes), default=0)

    def candidates(self, hashes: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> set[tuple[int, int, int]]:
        """Triples (text, start of the passage, item) over a run of words.

        ``begins`` and ``ends`` are those of the texts; all begin at multiples of ``STRIDE``.
        """
        found: set[tuple[int, int, int]] = set()
        for at in range(0, len(hashes), _CHUNK):
            # A chunk overlaps the next one by the longest window.
            chunk = np.ascontiguousarray(hashes[at : at + _CHUNK + self.longest])
            running = _running(chunk, self.longest + 1)
            for size, stride, blocks, items, offsets in self.classes:
                query, entry = blocks.search(_prints(running, size, stride))
                window = query * stride + at
                text = np.searchsorted(begins, window, side="right") - 1
                inside = window + size <= ends[text]
                text, start, item = text[inside], (window - offsets[entry])[inside], items[entry[inside]]
                found.update(zip(text.tolist(), start.tolist(), item.tolist(), strict=True))
        return found

    def check(self, words: Sequence[str], start: int, item: int) -> tuple[float, int]:
        """Best similarity of the item to the passage near ``start``, and where it starts."""
        best = (0.0, start)
        size = len(self.words[item])
        for shift in (0, 1, -1, 2, -2):
            at = max(0, start + shift)
            passage = words[at : max(0, start + shift + size)]
            found = similarity(shingles(passage, min(SHINGLE, size)), self.grams[item])
            if found > best[0]:
                best = (found, at)
            # A passage that fits at another shift shares shingles at this one.
            if found == 1.0 or found < 0.2:
                break
        return best


class _Vocabulary(dict):
    """Raw word to number; normal forms and hashes by number."""

    def __init__(self):
        super().__init__()
        self.normal, self.hashes = [], []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.normal.append(normal(word))
        self.hashes.append(_hash(self.normal[-1]))
        return number


def _searcher(index: Index, threshold: float, most_words: int = 150_000):
    vocabulary = _Vocabulary()
    table = np.zeros(0, np.uint64)

    def search(texts: list[str | None]) -> list[list[dict]]:
        nonlocal table
        if len(vocabulary) > most_words:
            table = np.zeros(0, np.uint64)
            vocabulary.clear()
            vocabulary.normal.clear()
            vocabulary.hashes.clear()
        numbers, begins, ends = [], [], []
        look = vocabulary.__getitem__
        for text in texts:
            begins.append(len(numbers))
            numbers.extend(map(look, words_of(text)))
            ends.append(len(numbers))
            # Texts are kept apart by words that no window sees.
            numbers.extend([look("")] * (STRIDE - len(numbers) % STRIDE))
        found: list[dict[int, tuple[float, int]]] = [{} for _ in texts]
        if numbers and index.classes:
            numbers = np.array(numbers, np.int64)
            table = np.r_[table, np.array(vocabulary.hashes[len(table) :], np.uint64)]
            for row, start, item in sorted(index.candidates(table[numbers], np.array(begins), np.array(ends))):
                first = begins[row]
                low = max(first, start - 2)
                words = [vocabulary.normal[n] for n in numbers[low : min(ends[row], start + len(index.words[item]) + 2)]]
                score, at = index.check(words, start - low, item)
                if score >= threshold and score > found[row].get(item, (0.0, 0))[0]:
                    found[row][item] = (score, at + low - first)
        return [
            [
                {"item": index.ids[k], "similarity": s, "start": at, "n_words": len(index.words[k])}
                for k, (s, at) in sorted(one.items())
            ]
            for one in found
        ]

    return search


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "item_id", item_text: str = "text",
    text_col: str = "text", threshold: float = SIMILARITY, out: str = "leaks",
) -> DataFrame:
    """``docs`` with all its columns and ``out``: the benchmark passages that each text holds.

    ``out`` is an array of ``item``, ``similarity``, ``start`` (in words) and ``n_words``.  A column
    of ``docs`` that is already called ``out`` is replaced.
    """
    items = benchmark.select(F.col(id_col).alias("item"), F.col(item_text).cast("string").alias("text"))
    rows, chars = items.agg(F.count(F.lit(1)), F.sum(F.length("text"))).first()
    slices = max(1, -(-rows // SLICE_ITEMS), -(-(chars or 0) // SLICE_CHARS))
    id_type = items.schema["item"].dataType.simpleString()
    kept = [name for name in docs.columns if name != out]
    kind = f"array<struct<item: {id_type}, similarity: double, start: long, n_words: long>>"
    spark = docs.sparkSession
    result, parts = docs.select(*kept), []
    for k in range(slices):
        part = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(slices)) == k)
        # Bounded: about SLICE_ITEMS items and SLICE_CHARS characters.
        held = spark.sparkContext.broadcast([tuple(row) for row in part.orderBy("item", "text").collect()])

        def setup(held=held):
            search = _searcher(Index(held.value), threshold)
            return lambda texts: [[x for at in range(0, len(texts), 256) for x in search(texts[at : at + 256])]]

        parts.append(unused(f"_leaks_{k}", result.columns))
        result = map_texts(result, setup, f"`{parts[-1]}` {kind}", result.columns, text_col)
    return result.select(*kept, F.concat(*parts).alias(out))
