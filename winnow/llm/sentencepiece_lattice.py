"""SentencePiece encoding and decoding as a relational lattice.

* Words: a text becomes characters with blanks written as U+2581 and one in front.  It is cut between
  two characters that no piece holds side by side; no piece can span such a cut, so words are
  independent and each distinct word is encoded once (see ``bundles``).
* Lattice: substrings of every word, up to the longest piece, are exploded and equi-joined to the
  piece table; the edges of a word are grouped.
* Fold: Spark's higher-order ``aggregate`` walks the edges of a word.  A unigram model takes the best
  path (Viterbi): position by position, the best score over the edges that end there.  A BPE model
  is not a best-path model: its ids follow from merges by piece rank.  There the fold keeps the cuts
  of a word as a bit mask and in each step joins the two neighbours of the best-ranked edge (leftmost on ties).
* A word above ``LATTICE_CHARS`` characters is encoded by the same rules in Python with a heap or a
  table, exactly.
* Characters without a piece become their UTF-8 bytes (byte pieces), or the unknown id.

Only models that keep texts as they are (identity normalisation, blanks escaped, one blank in
front) are accepted.  The piece table is a vocabulary file: its size is checked and it is joined by
broadcast below ``BROADCAST_PIECES`` pieces, else by shuffle.  NULL and empty texts have no ids.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winnow.llm import bundles as bd
from winnow.llm.common import forget, map_texts, store

BLANK = "▁"
LATTICE_CHARS = 60  # cuts of a word fit a 64-bit mask
BROADCAST_PIECES = 1_000_000
_CHUNK = re.compile(" +[^ ]*")
BYTE_PIECE, UNKNOWN = "<0x{:02X}>", 0


@dataclass(frozen=True)
class Pieces:
    """The normal pieces of a model, its byte pieces, and how paths are chosen."""

    ids: dict[str, int]
    scores: dict[str, float]
    bytes_at: tuple[int, ...]  # id of each byte, or empty
    names: tuple[str, ...]  # by id
    control: frozenset[int]
    unknown: int = UNKNOWN
    kind: str = "bpe"

    @property
    def longest(self) -> int:
        return max(map(len, self.ids), default=1)


def load(path: str) -> Pieces:
    """Read a SentencePiece model file with the public library."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    probe = "ﬁ Å  y\n"
    if model.decode(model.encode(probe)) != probe or not model.encode("a", out_type=str)[0].startswith(BLANK):
        raise ValueError("only models that keep texts as they are can be used")
    size = model.get_piece_size()
    names = tuple(model.id_to_piece(i) for i in range(size))
    normal = [
        i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
    ]
    by_byte = {names[i]: i for i in range(size) if model.is_byte(i)}
    return Pieces(
        {names[i]: i for i in normal},
        {names[i]: model.get_score(i) for i in normal},
        tuple(by_byte[BYTE_PIECE.format(b)] for b in range(256)) if len(by_byte) == 256 else (),
        names,
        frozenset(i for i in range(size) if model.is_control(i)),
        model.unk_id(),
        # Scores of a BPE model are its merge ranks: whole numbers from zero down.
        "bpe" if all(float(model.get_score(i)).is_integer() for i in normal[:1000]) else "unigram",
    )


# --- words ------------------------------------------------------------------------


class Cutter:
    """Cuts texts where no piece holds the two characters side by side."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces.ids
        pairs = {pair for piece in pieces.ids for pair in zip(piece, piece[1:])}
        letters = sorted({c for pair in pairs for c in pair})
        self.number = np.zeros(0x110000, np.uint16)
        self.number[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.joined = np.zeros((len(letters) + 1, len(letters) + 1), bool)
        for a, b in pairs:
            self.joined[self.number[ord(a)], self.number[ord(b)]] = True

    def in_two_steps(self):
        """Split texts at blanks first, then cut the distinct chunks: most chunks recur."""
        if any(a != BLANK and b == BLANK for piece in self.pieces for a, b in zip(piece, piece[1:])):
            return (lambda text: [text]), self._cut_each

        def split(text: str) -> list[str]:
            if "  " not in text and text[0] != " ":
                return text.split(" ")
            # A run of blanks belongs to the characters behind it; its first blank is implied.
            return [chunk[1:] for chunk in _CHUNK.findall(" " + text)]

        return split, self._cut_chunks

    def _cut_each(self, chunks: list[str]) -> tuple[list[str], np.ndarray]:
        cut = [self.words(chunk) if chunk else [BLANK] for chunk in chunks]
        return [w for words in cut for w in words], np.fromiter(map(len, cut), np.int64, len(cut))

    def _cut_chunks(self, chunks: list[str]) -> tuple[list[str], np.ndarray]:
        plain = np.fromiter((bool(c) and c[0] not in (" ", BLANK) for c in chunks), bool, len(chunks))
        odd, sizes = self._cut_each([c for c, p in zip(chunks, plain) if not p])
        words = self.words(" ".join([c for c, p in zip(chunks, plain) if p])) if plain.any() else []
        # Every chunk begins with the blank before it, and no other word does.
        first = np.fromiter((w[0] == BLANK for w in words), bool, len(words))
        starts = np.flatnonzero(first)
        counts = np.empty(len(chunks), np.int64)
        counts[plain], counts[~plain] = np.diff(np.r_[starts, len(words)]), sizes
        place = np.empty(len(chunks), np.int64)
        place[plain], place[~plain] = starts, len(words) + np.cumsum(sizes) - sizes
        words += odd
        return [words[i] for i in bd.ranges(place, counts)], counts

    def words(self, text: str) -> list[str]:
        if not text:
            return []
        text = BLANK + text.replace(" ", BLANK)
        kinds = self.number[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
        cuts = np.flatnonzero(~self.joined[kinds[:-1], kinds[1:]]) + 1
        edges = [0, *cuts.tolist(), len(text)]
        return [text[a:b] for a, b in zip(edges, edges[1:])]


# --- folds in plain Python: long words, and the yardstick of the tests --------------


def _char_ids(char: str, pieces: Pieces) -> list[int]:
    if char in pieces.ids:
        return [pieces.ids[char]]
    if pieces.bytes_at:
        return [pieces.bytes_at[b] for b in char.encode("utf-8", "replace")]
    return [pieces.unknown]


def merge_word(word: str, pieces: Pieces) -> list[int]:
    """BPE: join the best-ranked neighbours, leftmost on ties, until none has a piece."""
    start, end = list(range(len(word))), list(range(1, len(word) + 1))
    left, right = list(range(-1, len(word) - 1)), list(range(1, len(word) + 1))
    alive = [True] * len(word)
    heap: list[tuple[float, int, int, int]] = []

    def offer(a: int) -> None:
        b = right[a]
        if b < len(word):
            score = pieces.scores.get(word[start[a] : end[b]])
            if score is not None:
                heapq.heappush(heap, (-score, start[a], end[b], a))

    for k in range(len(word)):
        offer(k)
    while heap:
        _, s, e, a = heapq.heappop(heap)
        b = right[a] if alive[a] else len(word)
        if b >= len(word) or start[a] != s or end[b] != e:
            continue
        end[a], right[a], alive[b] = e, right[b], False
        if right[a] < len(word):
            left[right[a]] = a
        offer(a)
        if left[a] >= 0:
            offer(left[a])
    out: list[int] = []
    k = 0
    while k < len(word):
        piece = word[start[k] : end[k]]
        out += [pieces.ids[piece]] if piece in pieces.ids else _char_ids(piece, pieces)
        k = right[k]
    return out


def best_path(word: str, pieces: Pieces) -> list[int]:
    """Unigram: the path of best total score; a character without a piece costs ten below the least."""
    worst = min(pieces.scores.values(), default=0.0) - 10.0
    best: list[tuple[float, int]] = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        choices = []
        for start in range(max(0, end - pieces.longest), end):
            score = pieces.scores.get(word[start:end])
            if score is None and start == end - 1:
                score = worst
            if score is not None:
                choices.append((best[start][0] + score, start))
        best.append(max(choices))
    spans, end = [], len(word)
    while end:
        spans.append((best[end][1], end))
        end = best[end][1]
    out: list[int] = []
    for start, end in reversed(spans):
        piece = word[start:end]
        out += [pieces.ids[piece]] if piece in pieces.ids else _char_ids(piece, pieces)
    return out


def encode_word(word: str, pieces: Pieces) -> list[int]:
    return (merge_word if pieces.kind == "bpe" else best_path)(word, pieces)


# --- the lattice ----------------------------------------------------------------------


def _piece_table(spark: SparkSession, pieces: Pieces) -> DataFrame:
    costs = sorted({-score for score in pieces.scores.values()})
    rank = {cost: k for k, cost in enumerate(costs)}
    rows = [(piece, i, float(s), rank[-s]) for piece, i in pieces.ids.items() for s in (pieces.scores[piece],)]
    # The empty piece matches every word once, so a word without any piece keeps its row.
    table = spark.createDataFrame([*rows, ("", -1, 0.0, 0)], "piece string, id int, score double, rank long")
    return F.broadcast(table) if len(rows) <= BROADCAST_PIECES else table


def lattice(words: DataFrame, pieces: Pieces) -> DataFrame:
    """``word`` and ``edges`` from ``number, word``: the pieces in a word, least cost first, then by start.

    An edge is a struct of cost, s, e and id; for BPE models one number, with the rank of the cost
    above 6 bits each of s and e and 21 bits of the id, which is grouped and sorted faster.
    """
    spark = words.sparkSession
    start = F.when(F.col("s") == 0, 0).otherwise(F.col("s") + 1)
    substrings = (
        words.select("number", "word", F.explode(F.sequence(F.lit(0), F.length("word") - 1)).alias("s"))
        .select(
            "number", "word", "s",
            F.explode(
                F.sequence(start, F.least(F.col("s") + pieces.longest, F.length("word")))
            ).alias("e"),
        )
        .withColumn("piece", F.substring("word", F.col("s") + 1, F.col("e") - F.col("s")))
    )
    if pieces.kind == "bpe":
        edge = F.when(
            F.col("id") >= 0,
            F.expr("shiftleft(rank, 33) | shiftleft(CAST(s AS BIGINT), 27) | shiftleft(CAST(e AS BIGINT), 21) | id"),
        )
    else:
        edge = F.when(F.col("id") >= 0, F.struct((-F.col("score")).alias("cost"), "s", "e", "id"))
    return (
        substrings.join(_piece_table(spark, pieces), "piece")
        .groupBy("number")
        .agg(F.first("word").alias("word"), F.sort_array(F.collect_list(edge)).alias("edges"))
        .drop("number")
    )


# Folds, in SQL, where lambdas read best.  ``edges`` is sorted by cost, then start.  A value that a
# lambda needs more than once is bound by ``transform(array(value), name -> ...)[0]``: a column would
# be copied into the lambda and computed for every element.
# Merges: an edge is ready when both ends are cuts and exactly one cut lies between them.  An end that
# is gone never comes back, and an edge without a cut inside is never needed again, so the open
# edges shrink with every step.
_MERGES = """
transform(array(aggregate(
  sequence(1, n),
  named_struct(
    'mask', shiftleft(1L, n + 1) - 1L,
    'open', transform(filter(edges, x -> (shiftright(x, 21) & 63) - (shiftright(x, 27) & 63) > 1),
      x -> named_struct(
        'ends', shiftleft(1L, CAST(shiftright(x, 27) & 63 AS INT)) | shiftleft(1L, CAST(shiftright(x, 21) & 63 AS INT)),
        'span', shiftleft(2L, CAST(shiftright(x, 21) & 63 AS INT)) - shiftleft(1L, CAST(shiftright(x, 27) & 63 AS INT))))),
  (state, step) -> if(size(state.open) = 0, state, transform(transform(
      array(filter(state.open, x -> bit_count(state.mask & x.span) = 3)),
      ready -> if(size(ready) = 0, -1L, state.mask & ~ready[0].span | ready[0].ends)),
    joined -> if(joined = -1L,
      named_struct('mask', state.mask, 'open', slice(state.open, 1, 0)),
      named_struct('mask', joined, 'open', filter(state.open,
        x -> joined & x.ends = x.ends AND bit_count(joined & x.span) > 2))))[0]),
  state -> state.mask)),
mask -> filter(sequence(0, n), i -> shiftrightunsigned(mask, i) & 1L = 1L))[0]
"""
_VITERBI = """
transform(array(aggregate(
  sequence(1, n),
  array(named_struct('score', 0D, 'start', 0)),
  (best, i) -> concat(best, array(array_max(concat(
    transform(filter(edges, x -> x.e = i), x -> named_struct('score', best[x.s].score - x.cost, 'start', x.s)),
    if(exists(edges, x -> x.e = i AND x.s = i - 1), array(),
       array(named_struct('score', best[i - 1].score + {worst}, 'start', i - 1))))))))),
best -> aggregate(
  sequence(1, n), array(n),
  (cuts, i) -> if(cuts[0] = 0, cuts, concat(array(best[cuts[0]].start), cuts))))[0]
"""
_IDS = """
transform(array({cuts}), cuts -> flatten(transform(
  sequence(1, size(cuts) - 1),
  i -> coalesce(
    {found},
    {single}))))[0]
"""
_FOUND = "get(transform(filter(edges, x -> x.s = cuts[i - 1] AND x.e = cuts[i]), x -> array(x.id)), 0)"
_FOUND_PACKED = """
get(transform(filter(edges, x -> shiftright(x, 21) & 4095 = cuts[i - 1] * 64 + cuts[i]),
              x -> array(CAST(x & 2097151 AS INT))), 0)
"""
_BYTES = """
transform(
  array(hex(encode(substring(word, cuts[i - 1] + 1, 1), 'UTF-8'))),
  raw -> transform(sequence(1, length(raw), 2),
    at -> element_at({table}, cast(conv(substring(raw, at, 2), 16, 10) AS int) + 1)))[0]
"""


def encode_words(words: DataFrame, pieces: Pieces, partitions: int | None = None) -> DataFrame:
    """``word`` and ``ids`` for each distinct, non-empty word of column ``word``."""
    short = words.filter(F.length("word") <= LATTICE_CHARS)
    # A word's edges are grouped by its number.  All steps share that partitioning, so the words are
    # shuffled once; small partitions keep what the grouping sorts small.
    numbered = short.withColumn("number", F.monotonically_increasing_id())
    dealt = numbered.repartition(partitions, "number") if partitions else numbered.repartition("number")
    with_edges = lattice(dealt, pieces).withColumn("n", F.length("word"))
    if pieces.kind == "bpe":
        cuts, found = _MERGES, _FOUND_PACKED
    else:
        found = _FOUND
        cuts = _VITERBI.format(worst=f"{min(pieces.scores.values(), default=0.0) - 10.0!r}D")
    single = (
        _BYTES.format(table=f"array({', '.join(map(str, pieces.bytes_at))})")
        if pieces.bytes_at
        else f"array({pieces.unknown})"
    )
    folded = with_edges.select("word", F.expr(_IDS.format(cuts=cuts, found=found, single=single)).alias("ids"))

    def setup():
        return lambda batch: [[encode_word(word, pieces) for word in batch]]

    long = words.filter(F.length("word") > LATTICE_CHARS)
    return folded.unionByName(map_texts(long, setup, "ids array<int>", ["word"], "word"))


# --- texts ----------------------------------------------------------------------------


def encode(
    docs: DataFrame, pieces: Pieces, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False
) -> DataFrame:
    """One row per row of ``docs``: its id and ``ids`` (array of int).

    With ``decoded`` also ``text``, decoded from the ids in the same task.
    """
    spark = docs.sparkSession
    shards = bd.shard_count(docs, F.octet_length(F.col(text_col).cast("string")))
    bundles, packs, _, packs_at = bd.number_words(
        docs, lambda: Cutter(pieces).in_two_steps(), shards, id_col, text_col, "words"
    )

    def merged(rows: pa.Table) -> pa.Table:
        words: set[bytes] = set()
        for raw in rows.column("keys").to_pylist():
            words.update(bd.words_of(raw))
        words.discard(b"")
        return pa.table({"word": pa.array(sorted(words), pa.binary()).cast(pa.string())})

    words = store(
        packs.select("shard", "keys").groupBy("shard").applyInArrow(merged, "word string"), "distinct"
    )
    encoded = store(encode_words(words, pieces, 5 * shards), "encoded")

    def answer(asked: pa.Table, found: pa.Table) -> pa.Table:
        place = {w.encode(): k for k, w in enumerate(found.column("word").to_pylist())}
        ids = found.column("ids").combine_chunks()
        flat, edges = ids.flatten().to_numpy(), ids.offsets.to_numpy()
        first, size = edges[:-1] - edges[0], np.diff(edges)
        data = []
        for raw in asked.column("keys").to_pylist():
            at = np.fromiter(map(place.__getitem__, bd.words_of(raw)), np.int64)
            numbers = [[len(at)], size[at], flat[bd.ranges(first[at], size[at])]]
            data.append(bd.squeeze_planes(np.concatenate(numbers)))
        answered = asked.select(["shard", "bundle"]).append_column("keys", asked.column("data"))
        return answered.append_column("data", pa.array(data, pa.binary()))

    answers = store(
        packs.groupBy("shard")
        .cogroup(
            encoded.select(bd.word_shard(F.col("word"), shards).alias("shard"), "word", "ids").groupBy("shard")
        )
        .applyInArrow(answer, "shard int, bundle long, keys binary, data binary"),
        "answers",
    )
    forget(spark, packs_at, words.stored_at, encoded.stored_at)
    id_type = bundles.schema["ids"].dataType.elementType.simpleString()

    def spelled(bundle: pa.Table, found: pa.Table) -> pa.Table:
        none = np.zeros(0, np.int64)
        places, sizes, flats = [none], [none], [np.zeros(0, np.int32)]
        for keys, data in zip(*(found.column(c).to_pylist() for c in ("keys", "data")), strict=True):
            numbers = bd.expand_planes(data).astype(np.int64)
            places.append(np.cumsum(bd.expand_numbers(keys, np.uint32), dtype=np.int64))
            sizes.append(numbers[1 : numbers[0] + 1])
            flats.append(numbers[numbers[0] + 1 :].astype(np.int32))
        place, sizes, flat = (np.concatenate(x) for x in (places, sizes, flats))
        size, first = np.empty(len(place), np.int64), np.empty(len(place), np.int64)
        size[place], first[place] = sizes, np.cumsum(sizes) - sizes
        counts = bd.expand_numbers(bundle.column("keys")[0].as_py(), np.uint32).astype(np.int64)
        at = bd.expand_ranks(bundle.column("data")[0].as_py())
        ids = flat[bd.ranges(first[at], size[at])]
        ends = np.r_[0, np.cumsum(size[at])][np.r_[0, np.cumsum(counts)]]
        columns = {
            "id": bundle.column("ids").combine_chunks().flatten(),
            "ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())),
        }
        if decoded:
            spell = speller(pieces)
            columns["text"] = pa.array((spell(ids[a:b]) for a, b in zip(ends, ends[1:])), pa.string())
        return pa.table(columns)

    result = (
        bundles.groupBy("bundle").cogroup(answers.groupBy("bundle"))
        .applyInArrow(spelled, f"id {id_type}, ids array<int>" + ", text string" * decoded)
    )
    return result.withColumnRenamed("id", id_col)


def speller(pieces: Pieces):
    """A function from an array of ids to the text they spell.

    Byte pieces are joined and read as UTF-8, control pieces vanish, and the blank in front goes.
    """
    raw = [name.replace(BLANK, " ").encode() for name in pieces.names]
    for i in pieces.control:
        raw[i] = b""
    raw[pieces.unknown] = " \u2047 ".encode()
    for byte, i in enumerate(pieces.bytes_at):
        raw[i] = bytes([byte])
    return lambda ids: b"".join(map(raw.__getitem__, ids.tolist())).decode("utf-8", "replace").removeprefix(" ")


def decode(encoded: DataFrame, pieces: Pieces, ids_col: str = "ids", out: str = "text") -> DataFrame:
    """All columns of ``encoded`` and ``out``, the text that its ids spell; NULL ids spell nothing."""
    kept = [name for name in encoded.columns if name != out]
    schema = encoded.select(*kept).schema.add(out, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spell = speller(pieces)
        for batch in batches:
            column = batch.column(kept.index(ids_col))
            found = (column[k].values for k in range(batch.num_rows))
            texts = ["" if ids is None else spell(ids.to_numpy()) for ids in found]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*kept, out])

    return encoded.select(*kept).mapInArrow(run, schema)
