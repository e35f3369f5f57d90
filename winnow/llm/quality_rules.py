"""Quality rules: repetition coverage from rolling hashes of several n-gram lengths.

Words are maximal runs of characters other than blank and U+0009 to U+000D.  Each text gets
small word numbers (equal words, equal numbers); rolling polynomial hashes of 2 to 10 numbers
are sorted to find windows that occur twice, and equal hashes are compared number by number, so
no hash collision changes a result.  Of 2 to 4 words the most frequent window counts (the earliest of
equally frequent ones), of 5 to 10 words all windows that occur twice or more: the share of the
word characters that they cover, first occurrences included.  A window that occurs twice holds 5
words that occur twice: texts without repeated 5-word windows skip the longer lengths.

NULL and empty texts have no words and fail the base rule.  Work per text is
O(n log n) in its words; nothing is shared between rows, so skew has no effect.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.sql import DataFrame

from winnow.llm.common import SPACES, map_texts, mixed, runs

SYMBOLS = "#*$%&|<>"
# --- fixed values: largest shares of Rae et al., Scaling Language Models (2021), table A1 ----
TOP_LIMITS = {2: 0.20, 3: 0.18, 4: 0.16}
COVERAGE_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
# ----------------------------------------------------------------------------------------------
LINE_LIMIT = 0.30  # largest share of characters in lines that repeat an earlier line
SYMBOL_LIMIT = 0.10  # most symbols per word
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20  # the base rule

FIELDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "repeat_share double, top_share double, dup_line_share double, base_failed boolean, kept boolean, reasons string"
)


def _repeats(numbers: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the n-word windows that occur twice or more, and of those not first."""
    order = np.argsort(hashes, kind="stable")
    same = hashes[order[1:]] == hashes[order[:-1]]
    if not same.any():
        none = np.zeros(0, np.int64)
        return none, none
    left, right = order[:-1][same], order[1:][same]
    equal = np.ones(len(left), bool)
    for k in range(n):
        equal &= numbers[left + k] == numbers[right + k]
    if not equal.all():  # a hash collision: compare the windows themselves
        windows = np.lib.stride_tricks.sliding_window_view(numbers, n)
        _, first, inverse, count = np.unique(
            windows, axis=0, return_index=True, return_inverse=True, return_counts=True
        )
        inverse = inverse.reshape(-1)
        twice = np.flatnonzero(count[inverse] > 1)
        return twice, np.setdiff1d(twice, first)
    return np.union1d(left, right), np.unique(right)


def _top(numbers: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """Starts of the n-word window that occurs most often, the earliest such; none if all occur once."""
    order = np.argsort(hashes, kind="stable")
    heads = runs(hashes[order])
    count = np.diff(np.r_[heads, len(order)])
    best = np.flatnonzero(count == count.max())
    if count[best[0]] < 2:
        return np.zeros(0, np.int64)
    run = best[np.argmin(order[heads[best]])]  # stable: the head of a run is its earliest window
    starts = order[heads[run] : heads[run] + count[run]]
    windows = np.lib.stride_tricks.sliding_window_view(numbers, n)
    if (windows[starts] == windows[starts[0]]).all():
        return starts
    _, first, inverse, count = np.unique(  # a hash collision: compare the windows themselves
        windows, axis=0, return_index=True, return_inverse=True, return_counts=True
    )
    best = np.flatnonzero(count == count.max())
    gram = best[np.argmin(first[best])]
    return np.flatnonzero(inverse.reshape(-1) == gram) if count[gram] > 1 else np.zeros(0, np.int64)


def _covered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which of ``size`` words lie in an n-word window that begins at one of ``starts``."""
    steps = np.zeros(size + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + n, -1)
    return np.cumsum(steps[:-1]) > 0


def measure(text: str | None, limits: Mapping[int, float] = COVERAGE_LIMITS) -> tuple:
    """All measures of one text, in the order of ``FIELDS``."""
    text = text or ""
    for space in SPACES[1:]:
        plain = text.replace(space, " ") if space == "\t" else plain.replace(space, " ")
    words = [word for word in plain.split(" ") if word]
    n_words = len(words)
    word_chars = len(text) - plain.count(" ")
    n_symbols = sum(text.count(symbol) for symbol in SYMBOLS)

    seen: set[str] = set()
    n_dup_lines = dup_chars = line_chars = 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            line_chars += len(line)
            if line in seen:
                n_dup_lines += 1
                dup_chars += len(line)
            else:
                seen.add(line)

    n_repeat_words, worst, top, failed = 0, 0.0, 0.0, []
    if n_words > 2:
        ids: dict[str, int] = {}
        numbers = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n_words)
        lengths = np.fromiter(map(len, words), np.int64, n_words)
        rolling = spread = mixed(numbers + 1)
        prime = np.uint64(0x9E3779B97F4A7C15)
        for n in range(2, max([5, *limits]) + 1):
            # Windows of n words can only repeat where n words do.
            if n_words < n + 1 or n_words - len(ids) < n:
                break
            rolling = rolling[:-1] * prime + spread[n - 1 :]
            if n < 5:
                share = float(lengths[_covered(_top(numbers, rolling, n), n, n_words)].sum() / word_chars)
                top = max(top, share)
                if share > TOP_LIMITS[n]:
                    failed.append(f"top_{n}")
                continue
            twice, _ = _repeats(numbers, rolling, n)
            covered = _covered(twice, n, n_words)
            if n == 5:
                n_repeat_words = int(covered.sum())
            if not len(twice):
                break
            if n in limits:
                share = float(lengths[covered].sum() / word_chars)
                worst = max(worst, share)
                if share > limits[n]:
                    failed.append(f"repeat_{n}")
    line_share = dup_chars / max(1, line_chars)
    if line_share > LINE_LIMIT:
        failed.append("lines")
    if n_symbols > SYMBOL_LIMIT * n_words:
        failed.append("symbols")
    base_failed = n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words
    kept = not base_failed and not failed
    return (
        n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
        worst, top, line_share, base_failed, kept, ",".join(failed),
    )


def quality_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    limits: Mapping[int, float] = COVERAGE_LIMITS,
) -> DataFrame:
    """One row per row of ``docs``: its id, its measures and the verdict ``kept``.

    ``repeat_share`` is the largest share over the longer windows, ``top_share`` that of the most frequent
    shorter ones; ``reasons`` names the rules
    of the method that failed, apart from the base rule.
    """
    limits = dict(limits)

    def setup():
        def work(texts):
            rows = [measure(text, limits) for text in texts]
            return list(zip(*rows, strict=True)) if rows else [[]] * len(FIELDS.split(","))

        return work

    return map_texts(docs, setup, FIELDS, [id_col], text_col)
