"""Token-ID / binary output: an adaptive context-mixing range coder over token ids.

File format.  A file is a table of segments in ascending order of ``(part, seq)``; each segment is
one byte string that stands on its own:

    magic "WTOK", version, u32 lengths of the four fields below, then
    lengths   zstd of the number of ids per document, u32 each
    alphabet  zstd of the distinct ids of the segment, most frequent first, u32 each
    shares    zstd of the share of each of them in order 0, u32 each, a power of two in all
    lanes     u32 bytes and u32 crc32 per block, then the coded blocks, one after the other

Ids are cut into blocks of ``BLOCK``.  Every block resets what it has learned, carries the crc32 of
its ids (as little-endian u32) and can be decoded alone.

An id is coded from a mixture of three distributions: order 2 gives the id that last followed the same two ids
in this block, order 1 the id that last followed the same one id, and order 0 every id by its share in the
segment.  The weights adapt after every id by the part that each distribution had in it (an EM step of a 32nd,
with a small share handed back); there are two sets, for orders 1 and 2 that agree and that differ.  The
proposed ids have intervals of their own, as long as the sum over all orders that give them; what is left goes
to order 0.  The range has 64 bits and puts out 32 at a time.  All statistics are whole numbers, so both
directions agree on any machine.

All blocks of a segment advance together, one id per step, as numpy arrays; the work per id is a
fixed number of array operations in either direction.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm.chunk_tokens import (
    ChunkCache, Endings, Letters, added_in_letters, cut_texts, held, in_a_row, interleave,
)
from winnow.llm.common import prefix_sums, store

MAGIC = b"WTOK\x02"
BLOCK = 2048
SEGMENT_IDS = BLOCK * 2048
MOST_SYMBOLS = (1 << 18) - 1  # of a segment
END_ID = 2
MARK, JOINED_WORDS = "^", 20_000
MOST_WORDS = 1_500_000  # in the cache of a worker, some 180 bytes each
_S1, _S2 = 10, 11  # bits of the order-1 and order-2 tables of one block
_U = np.uint64
_LOW32 = _U((1 << 32) - 1)
_FIVE_LESS, _TEN_LESS = (_U((0xFFFFFFFF >> k) << 32 | 0xFFFFFFFF >> k) for k in (5, 10))
_ONE = 1 << 16  # the whole of a chance
_LEAST = 32  # what order 0 has of the interval at least


def _total_bits(symbols: int) -> int:
    return 18 if symbols <= 1 << 16 else 20


def shares_of(counts: np.ndarray) -> np.ndarray:
    """Shares of the symbols in order 0, by their counts: at least 1 each, a power of two in all."""
    counts = counts.astype(np.int64)
    total = 1 << _total_bits(len(counts))
    shares = 1 + counts * (total - len(counts)) // counts.sum()
    shares[0] += total - shares.sum()
    return shares


class _Mixer:
    """Statistics of all blocks of a segment, one column per block.

    ``shares`` gives the shares of the symbols in order 0, or a number of symbols of equal shares.
    """

    def __init__(self, lanes: int, shares: int | np.ndarray):
        if isinstance(shares, int):
            shares = shares_of(np.ones(max(1, shares), np.int64))
        self.bits = _U(_total_bits(len(shares)))
        self.kind = kind = np.uint16 if len(shares) <= 1 << 16 else np.uint32  # of ids, as the work follows their width
        self.share = shares.astype(_U)
        # Where a symbol begins in order 0, above its share.
        self.places = (np.cumsum(self.share) - self.share) << _U(32) | self.share
        self.chance = (self.share << _U(16)) >> self.bits
        self.follow1 = np.full(lanes << _S1, 0, kind)  # unlike zeros, in large pages where the system has them
        self.follow2 = np.full(lanes << _S2, 0, kind)
        self.base1 = np.arange(lanes, dtype=np.int64) << _S1
        self.base2 = np.arange(lanes, dtype=np.int64) << _S2
        # Weights of orders 2 and 1, 32 bits each, where they differ and where they agree; order 0 has the rest.
        self.weights = np.full(2 * lanes, 4096 << 32 | 4096, _U)
        self.weights[lanes:] = 16384 << 32 | 16384
        self.lane = np.arange(lanes, dtype=np.int64)
        self.lanes = lanes
        self.hash1 = np.zeros(lanes, np.int64)
        self.hash2 = np.zeros(lanes, np.int64)

    def predict(self, n: int, coming: np.ndarray | None = None):
        """Ids proposed by orders 2 and 1 and what they have of the interval, for the first ``n`` blocks.

        ``coming`` are the ids to be coded, where they are known: they are noted while the places are at hand.
        """
        self.at1 = ((self.hash1[:n] >> 4) & ((1 << _S1) - 1)) + self.base1[:n]
        self.at2 = (((self.hash1[:n] + self.hash2[:n]) >> 4) & ((1 << _S2) - 1)) + self.base2[:n]
        self.c2 = c2 = self.follow2.take(self.at2)
        self.c1 = c1 = self.follow1.take(self.at1)
        if coming is not None:
            self.note(coming)
        same = c1 == c2
        self.state = self.lane[:n] + same * self.lanes
        self.pack = self.weights.take(self.state)
        self.w2, self.w1 = self.pack >> _U(32), self.pack & _LOW32
        w0 = _U(_ONE) - self.w2 - self.w1
        # What an id has is the sum over all orders that can give it.
        agreed = self.w1 * same
        self.mix2 = np.minimum(self.w2 + agreed + (w0 * self.chance.take(c2) >> _U(16)), _U(_ONE - 2 * _LEAST))
        alone = (self.w1 + (w0 * self.chance.take(c1) >> _U(16))) * ~same
        self.mix1 = np.minimum(alone, _U(_ONE - _LEAST) - self.mix2)
        return c2, c1, self.mix2, self.mix1

    def note(self, rank: np.ndarray) -> None:
        self.follow1[self.at1] = rank
        self.follow2[self.at2] = rank

    def update(self, n: int, rank: np.ndarray, is2: np.ndarray) -> None:
        """Learn the coded ids (of ``kind``) but for ``note``; ``is2`` marks those that order 2 proposed."""
        # The weights go a 32nd of the way to the part that each order had in what came (EM step for a
        # mixture), and hand back a little.  They stay below 64,048, and their sum below 65,000.
        pack = self.pack - ((self.pack >> _U(5)) & _FIVE_LESS)
        hit = np.flatnonzero(is2 | (rank == self.c1))
        if len(hit):
            w2, w1, second = self.w2[hit], self.w1[hit], is2[hit]
            mixed = np.maximum(_pick(second, self.mix2[hit], self.mix1[hit]), _U(1))  # 0 in damaged blocks only
            first = rank[hit] == self.c1[hit]
            gain1 = np.minimum((w1 * first << _U(11)) // mixed, _U(_ONE >> 5))
            pack[hit] += ((w2 * second << _U(11)) // mixed << _U(32)) + gain1
        pack -= (pack >> _U(10)) & _TEN_LESS
        pack += _U(16 << 32 | 16)
        self.weights[self.state] = pack
        # The id before the last one counts with another factor.
        self.hash2[:n] = self.hash1[:n] * 7
        np.multiply(rank, 40503, out=self.hash1[:n], dtype=np.int64)


def _pick(where: np.ndarray, yes: np.ndarray, no: np.ndarray) -> np.ndarray:
    """``np.where`` without branches, for whole numbers of one kind."""
    return no ^ ((no ^ yes) & -where.astype(no.dtype))


def _active(sizes: np.ndarray, step: int) -> int:
    """Blocks that still have an id at ``step``; only the last block may be short."""
    return len(sizes) if step < sizes[-1] else len(sizes) - 1


def _turned(rows: np.ndarray) -> np.ndarray:
    """The transposed array, made some columns at a time, so that whole cache lines are read and written."""
    out = np.empty(rows.shape[::-1], rows.dtype)
    for at in range(0, rows.shape[1], 32):
        for k in range(0, rows.shape[0], 256):
            out[at : at + 32, k : k + 256] = rows[k : k + 256, at : at + 32].T
    return out


def _grid(values: np.ndarray, lanes: int) -> np.ndarray:
    out = np.zeros(lanes * BLOCK, values.dtype)
    out[: len(values)] = values
    return _turned(out.reshape(lanes, BLOCK))


def encode_blocks(ranks: np.ndarray, symbols: int | np.ndarray) -> list[bytes]:
    """Code ranks in blocks of ``BLOCK``, one byte string per block.

    ``symbols`` is the number of symbols, above all ranks, or the shares of the symbols in order 0.
    """
    lanes = -(-len(ranks) // BLOCK)
    if not lanes:
        return []
    sizes = np.minimum(BLOCK, len(ranks) - np.arange(lanes) * BLOCK)
    mixer = _Mixer(lanes, symbols)
    grid = _grid(ranks.astype(mixer.kind), lanes)
    low, span = np.zeros(lanes, _U), np.full(lanes, (1 << 64) - 1, _U)
    out = np.zeros(lanes * (BLOCK + 2), np.uint32)  # at most 32 bits per id
    used = np.arange(lanes, dtype=np.int64) * (BLOCK + 2)
    for step in range(int(sizes.max())):
        n = _active(sizes, step)
        rank = grid[step, :n]
        c2, c1, p2, p1 = mixer.predict(n, rank)
        is2 = rank == c2
        is1 = (rank == c1) & ~is2
        unit = span[:n] >> _U(16)
        a, b = unit * p2, unit * p1
        both = a + b
        part = (span[:n] - both) >> mixer.bits
        place = mixer.places.take(rank)
        start = _pick(is2 | is1, a * is1, both + part * (place >> _U(32)))
        size = _pick(is2 | is1, _pick(is2, a, b), part * (place & _LOW32))
        low[:n] += start
        span[:n] = size
        mixer.update(n, rank, is2)
        short = np.flatnonzero(size <= _LOW32)
        if len(short):
            at, reach, place = low[short], size[short], used[short]
            out[place] = at >> _U(32)
            used[short] = place + 1
            low[short], span[short] = at << _U(32), _inside(at, reach) << _U(32)
    for shift in (32, 0):
        out[used] = low >> _U(shift) & _LOW32
        used += 1
    used -= np.arange(lanes) * (BLOCK + 2)
    big = out.astype(">u4").reshape(lanes, BLOCK + 2)
    return [big[k, : used[k]].tobytes() for k in range(lanes)]


def _inside(low: np.ndarray, span: np.ndarray) -> np.ndarray:
    """Spans of at most 32 bits, cut where the upper half of a number in them would change."""
    left = (_U(1) << _U(32)) - (low & _LOW32)
    return np.minimum(span, left)


def decode_blocks(blocks: list[bytes], total: int, symbols: int | np.ndarray) -> np.ndarray:
    """The ranks of ``encode_blocks``, given their number and the same ``symbols``."""
    lanes = len(blocks)
    if not lanes:
        return np.zeros(0, np.uint32)
    sizes = np.minimum(BLOCK, total - np.arange(lanes) * BLOCK)
    most = max(map(len, blocks)) // 4 + 2
    words = np.zeros((lanes, most), np.uint32)
    for k, block in enumerate(blocks):
        words[k, : len(block) // 4] = np.frombuffer(block, ">u4", len(block) // 4)
    words = words.ravel()
    first = np.arange(lanes, dtype=np.int64) * most
    code = words[first].astype(_U) << _U(32) | words[first + 1]
    used, last = first + 2, first + most - 1
    low, span = np.zeros(lanes, _U), np.full(lanes, (1 << 64) - 1, _U)
    mixer = _Mixer(lanes, symbols)
    top = _U((1 << int(mixer.bits)) - 1)
    held_by = np.repeat(np.arange(len(mixer.share), dtype=mixer.kind), mixer.share.astype(np.int64))
    grid = np.zeros((BLOCK, lanes), mixer.kind)
    for step in range(int(sizes.max())):
        n = _active(sizes, step)
        c2, c1, p2, p1 = mixer.predict(n)
        offset = code[:n] - low[:n]
        unit = span[:n] >> _U(16)
        a, b = unit * p2, unit * p1
        both = a + b
        is2, near = offset < a, offset < both
        part = (span[:n] - both) >> mixer.bits
        slot = np.minimum((offset - both) // part, top)
        rank = held_by.take(slot.view(np.int64))
        place = mixer.places.take(rank)
        start = _pick(near, a * ~is2, both + part * (place >> _U(32)))
        size = _pick(near, _pick(is2, a, b), part * (place & _LOW32))
        rank = _pick(near, _pick(is2, c2, c1), rank)
        low[:n] += start
        span[:n] = size
        grid[step, :n] = rank
        mixer.note(rank)
        mixer.update(n, rank, is2)
        short = np.flatnonzero(size <= _LOW32)
        if len(short):
            at, reach, place = low[short], size[short], used[short]
            code[short] = code[short] << _U(32) | words[place]
            used[short] = np.minimum(place + 1, last[short])
            low[short], span[short] = at << _U(32), _inside(at, reach) << _U(32)
    return _turned(grid).reshape(-1)[:total].astype(np.uint32)


def write_segment(ids: np.ndarray, lengths: np.ndarray) -> bytes:
    """One segment from the ids of whole documents and their numbers of ids."""
    if len(ids) and ids.max() < 1 << 22:
        counts = np.bincount(ids)
        alphabet = np.flatnonzero(counts)
        place = np.zeros(len(counts), np.uint32)
        place[alphabet] = np.arange(len(alphabet))
        inverse, counts = place[ids], counts[alphabet]
    else:
        alphabet, inverse, counts = np.unique(ids, return_inverse=True, return_counts=True)
    order = np.argsort(-counts, kind="stable")
    if len(order) > MOST_SYMBOLS:
        raise ValueError(f"a segment holds at most {MOST_SYMBOLS} distinct ids")
    rank_of = np.empty(len(order), np.uint32)
    rank_of[order] = np.arange(len(order))
    shares = shares_of(counts[order]) if len(order) else np.zeros(0, np.int64)
    blocks = encode_blocks(rank_of[inverse], shares)
    squeeze = zstandard.ZstdCompressor(level=3).compress
    fields = [
        squeeze(lengths.astype("<u4").tobytes()),
        squeeze(alphabet[order].astype("<u4").tobytes()),
        squeeze(shares.astype("<u4").tobytes()),
        b"".join(
            struct.pack("<II", len(block), zlib.crc32(ids[k * BLOCK : (k + 1) * BLOCK].astype("<u4").tobytes()))
            for k, block in enumerate(blocks)
        ),
    ]
    head = MAGIC + struct.pack("<4I", *map(len, fields))
    return head + b"".join(fields) + b"".join(blocks)


def read_segment(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Ids and numbers of ids per document; raises ``ValueError`` if a block is damaged."""
    if raw[: len(MAGIC)] != MAGIC:
        raise ValueError("not a token segment")
    at = len(MAGIC) + 16
    fields = []
    for size in struct.unpack("<4I", raw[len(MAGIC) : at]):
        fields.append(raw[at : at + size])
        at += size
    expand = zstandard.ZstdDecompressor().decompress
    lengths = np.frombuffer(expand(fields[0]), "<u4").astype(np.int64)
    alphabet, shares = (np.frombuffer(expand(field), "<u4") for field in fields[1:3])
    sums, blocks = [], []
    for size, crc in struct.iter_unpack("<II", fields[3]):
        sums.append(crc)
        blocks.append(raw[at : at + size])
        at += size
    try:
        ids = alphabet[decode_blocks(blocks, int(lengths.sum()), shares)]
    except (IndexError, ZeroDivisionError) as error:
        raise ValueError("damaged block") from error
    for k, crc in enumerate(sums):
        if zlib.crc32(ids[k * BLOCK : (k + 1) * BLOCK].tobytes()) != crc:
            raise ValueError(f"checksum of block {k} differs")
    return ids, lengths


class WordTokenizer:
    """Ids of whole texts from a tokenizer that never joins across white space.

    Each distinct word is encoded once.  That equals encoding the whole text: the tokenizer drops
    white space and treats the pieces between it on their own.  New words of Latin letters go to the model of
    the tokenizer, which does its merges; others are encoded many at a time, as one text with a mark
    between two words, and cut at the id of the mark.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        mark = self._ids([MARK])[0]
        self.mark = mark[0] if len(mark) == 1 else None
        # Words of Latin letters need no more than the merges, if the rest of the tokenizer lower-cases them only.
        letters = "".join(chr(c) for c in range(0x100) if chr(c).isalpha())
        probes = ["The", letters, letters[::-1], "whednd", "STRASSE", "Straße", "x", "É", "DonT", "ill", "ÈÉêai"]
        self.letters = Letters(self.tokenizer, lower=True)
        added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        if added_in_letters(added) or not self.letters.agrees(self._ids, probes):
            self.letters = None
        # Letters and the signs behind them are split, so words that recur in other cases, or with other signs
        # behind them, are put together from what is known.
        cut = Endings(added, lower=True)
        ends = ["The,", "word.", "Et\u00e9;--", "X%%%", "a_", "It\"", "DON$$$", "h**", "S!?", letters + ")", "\u00c9)"]
        pieces = [cut_texts(pa.array([w]), cut, words=True)[0].to_pylist() for w in ends]
        fits = self.letters and cut.fits and all(sum(self._ids(p), []) == self._ids([w])[0] for p, w in zip(pieces, ends))
        self.cache = ChunkCache([self._encode], most=MOST_WORDS, parts=cut if fits else None, words=True)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        plain = np.array([self.letters and self.letters.is_plain(word) for word in words], bool)
        one = self.letters(list(compress(words, plain))) if plain.any() else in_a_row([])
        return interleave(plain, one, self._mixed(list(compress(words, ~plain))))

    def _mixed(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if not words:
            return in_a_row([])
        parts = [self._together(words[at : at + JOINED_WORDS]) for at in range(0, len(words), JOINED_WORDS)]
        return np.concatenate([ids for ids, _ in parts]), np.concatenate([sizes for _, sizes in parts])

    def _together(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        joint = f" {MARK} ".join(words)
        if self.mark is not None and joint.count(MARK) == len(words) - 1:  # else a word holds the mark
            ids = np.array(self._ids([joint])[0], np.uint32)
            at = np.flatnonzero(ids == self.mark)
            if len(at) == len(words) - 1:
                return np.delete(ids, at), np.diff(np.r_[-1, at, len(ids)]) - 1
        if len(words) > 64:
            half = len(words) // 2
            first, second = self._together(words[:half]), self._together(words[half:])
            return np.concatenate([first[0], second[0]]), np.concatenate([first[1], second[1]])
        return in_a_row(self._ids(words))

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each closed by ``end_id``, and ids per text; NULL is empty."""
        (ids,), (sizes,), _ = self.cache.encode(texts)
        return np.insert(ids, np.cumsum(sizes), np.uint32(end_id)), sizes + 1


def write_tokens(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
    end_id: int = END_ID, name: str = "tokens",
) -> DataFrame:
    """Write the segments of all texts in ascending id order; returns the stored table.

    NULL texts are empty.  Rows that share an id stay in the order of a hash of their text, and a
    NULL id comes first.  Columns: ``part``, ``seq``, ``inside`` (ids of earlier segments of the part), ``ids``
    (the row ids), ``n`` (tokens) and ``segment``.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    ordered = (
        docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
        .withColumn("_tie", F.xxhash64("_text"))
        .repartitionByRange("_id", "_tie")
        .sortWithinPartitions("_id", "_tie")
    )

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = held(("words", tokenizer_path), lambda: WordTokenizer(tokenizer_path))
        part, seq = TaskContext.get().partitionId(), 0
        keys, ids, lengths, size, inside = [], [], [], 0, 0

        def segment():
            nonlocal keys, ids, lengths, size, seq, inside
            body = write_segment(np.concatenate(ids), np.concatenate(lengths))
            row = pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int64()), pa.array([seq], pa.int64()),
                    pa.array([inside], pa.int64()),
                    pa.array([[k for chunk in keys for k in chunk.to_pylist()]], pa.list_(keys[0].type)),
                    pa.array([size], pa.int64()), pa.array([body], pa.binary()),
                ],
                ["part", "seq", "inside", "ids", "n", "segment"],
            )
            keys, ids, lengths, size, seq, inside = [], [], [], 0, seq + 1, inside + size
            return row

        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                piece = batch.slice(at, 4096)
                found, counts = tokenizer.encode(piece.column(1), end_id)
                keys.append(piece.column(0))
                ids.append(found)
                lengths.append(counts)
                size += len(found)
                if size >= SEGMENT_IDS:
                    yield segment()
        if size:
            yield segment()

    return store(
        ordered.mapInArrow(
            segments, f"part long, seq long, inside long, ids array<{id_type}>, n long, segment binary"
        ),
        name,
    )


def read_tokens(segments: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per document: id, ``start``, ``n_tokens`` and ``ids`` (binary, little-endian u32)."""
    id_type = segments.schema["ids"].dataType.elementType.simpleString()
    # A segment knows its place in its part, so one short row per part is all that is summed and joined.
    totals = segments.groupBy("part").agg(F.sum("n").alias("total"))
    bases = store(prefix_sums(totals, "part", "total", "before"), "bases")

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                ids, lengths = read_segment(batch.column(1)[k].as_py())
                ends = np.cumsum(lengths)
                raw = ids.astype("<u4").tobytes()
                keys = batch.column(0)[k].values
                for at in range(0, len(lengths), 4096):
                    some = slice(at, at + 4096)
                    pieces = [
                        raw[4 * (e - n) : 4 * e] for e, n in zip(ends[some].tolist(), lengths[some].tolist())
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [
                            keys[some], pa.array(ends[some] - lengths[some] + batch.column(2)[k].as_py()),
                            pa.array(lengths[some]), pa.array(pieces, pa.binary()),
                        ],
                        [id_col, "start", "n_tokens", "ids"],
                    )

    return (
        segments.join(bases.select("part", "before"), "part")
        .select("ids", "segment", (F.col("before") + F.col("inside")).alias("base"))
        .mapInArrow(documents, f"`{id_col}` {id_type}, start long, n_tokens long, ids binary")
    )
