"""Web-archive scan: ``read_warc``, or ``spark.read.format("warc").load(path)``.

Without an index one task reads an archive file, as where a record starts inside a gzip file is
known only to whoever has read all before it.  With an index, a table of offsets at which records start
(``archive_index`` makes it in one header pass, ``read_cdx`` takes it from CDX files), a file is read in
ranges of about ``split_bytes``, one task each.  The ranges cover every byte of a file whatever the index
lists, so an index that does not fit is an error and loses nothing.  Rows are the same either way.
Above ``LEAST_TASKS`` files or ranges, a task reads several small ones, up to about ``TASK_BYTES``.

``ord`` is ``struct<file, member, record>``: the place of the file in the list, of the gzip member in the
file, and of the record in the member, so it is unique and sorts in reading order.

Damaged or truncated files raise an error.  With ``errors="quarantine"`` a damaged stretch gives one row
that has ``_error``, ``ord`` and ``archive`` only, and reading goes on at the next place that reads as a
record.  Bodies that are cut, unreadable or in an unknown encoding are marked in ``body_error``.

Options of the format: ``headerOnly`` (no body column, bodies are passed over), ``responsesOnly``
(default true), ``errors``.  Paths may hold ``*``, ``?`` and ``[]`` in any part; several are separated by
line breaks.
"""

from __future__ import annotations

from collections.abc import Iterator
from fnmatch import fnmatchcase
from itertools import islice

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from winnow.sources.warc_records import file_system, records

BATCH_BYTES = 4 << 20
# Files and ranges share tasks where there are more of them than so many, up to so many bytes a task.
LEAST_TASKS, TASK_BYTES = 256, 16 << 20

HEADER_FIELDS = (
    "ord struct<file: bigint, member: bigint, record: bigint>, archive string, statusline string, target_uri string, warc_type string, "
    "payload_digest string, block_digest string, content_length string, "
    "http_headers array<struct<name: string, value: string>>, "
    "rec_headers array<struct<name: string, value: string>>"
)
BODY_FIELDS = ", content binary, body_error string"
ERROR_FIELD = ", _error string"
SPLIT_BYTES = 128 << 20
INDEX_FIELDS = "path string, offset bigint, length bigint, record bigint, target_uri string"


def fields(header_only: bool, errors: str) -> str:
    if errors not in ("raise", "quarantine"):
        raise ValueError(f"unknown treatment of errors: {errors}")
    return HEADER_FIELDS + ("" if header_only else BODY_FIELDS) + (ERROR_FIELD if errors != "raise" else "")


class Piece(InputPartition):
    def __init__(self, files: list[tuple[str, int]]):
        self.files = files  # paths and their numbers


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return fields(_flag(self.options, "headerOnly", False), _option(self.options, "errors", "raise"))

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(schema, dict(self.options))


class WarcReader(DataSourceReader):
    def __init__(self, schema, options):
        self.header_only = _flag(options, "headerOnly", False)
        self.responses_only = _flag(options, "responsesOnly", True)
        self.errors = _option(options, "errors", "raise")
        self.paths = [path for path in _option(options, "path", "").split("\n") if path]

    def partitions(self):
        return [Piece(files) for files in _shared_tasks(list(_archives(self.paths)))]

    def read(self, piece) -> Iterator:
        schema = _arrow_schema(self.header_only, self.errors)
        for path, number in piece.files:
            found = records(path, self.header_only, quarantine=self.errors == "quarantine")
            yield from _batches(found, number, self.responses_only, schema)


def _shared_tasks(archives: list[tuple[str, int]]) -> Iterator[list[tuple[str, int]]]:
    """Numbered paths of the files each task reads: one file, or several small ones that follow each other."""
    share = min(TASK_BYTES, sum(size for _, size in archives) // LEAST_TASKS)
    files, held = [], 0
    for number, (path, size) in enumerate(archives):
        if files and (held + size > share or len(archives) <= LEAST_TASKS):
            yield files
            files, held = [], 0
        files.append((path, number))
        held += size
    if files:
        yield files


def _task_number(pieces: int, total: int) -> int:
    """Number of tasks that read so many files or ranges of so many bytes in all."""
    return max(1, min(pieces, max(LEAST_TASKS, total // TASK_BYTES)))


def _batches(found: Iterator[dict], number: int, responses_only: bool, schema: pa.Schema) -> Iterator:
    rows, held = [], 0
    for row in found:
        place = {"file": number, "member": row.pop("member"), "record": row.pop("record")}
        if responses_only and row.get("_error") is None and row["warc_type"] != "response":
            continue
        row["ord"] = place
        rows.append(row)
        held += len(row.get("content") or b"") + 1024
        if held >= BATCH_BYTES:
            yield pa.RecordBatch.from_pylist(rows, schema)
            rows, held = [], 0
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema)


def _arrow_schema(header_only, errors):
    pairs = pa.list_(pa.struct({"name": pa.string(), "value": pa.string()}))
    texts = [
        "archive", "statusline", "target_uri", "warc_type", "payload_digest", "block_digest",
        "content_length",
    ]
    place = pa.struct([(name, pa.int64()) for name in ("file", "member", "record")])
    found = [("ord", place)] + [(name, pa.string()) for name in texts]
    found += [("http_headers", pairs), ("rec_headers", pairs)]
    if not header_only:
        found += [("content", pa.binary()), ("body_error", pa.string())]
    if errors != "raise":
        found.append(("_error", pa.string()))
    return pa.schema(found)


def _option(options, name, default):
    lowered = {key.lower(): value for key, value in options.items()}
    return lowered.get(name.lower(), default)


def _flag(options, name, default):
    return str(_option(options, name, default)).lower() == "true"


def _archives(paths):
    """Paths and sizes of archive files in the order given; folders and patterns list theirs by name."""
    for given in paths:
        system, inner = file_system(given)
        given, inner = given.rstrip("/"), inner.rstrip("/")
        if any(sign in inner for sign in "*?["):
            found = sorted(_matching(system, inner))
            if not found:
                raise FileNotFoundError(given)
            yield from ((given.removesuffix(inner) + path, size) for path, size in found)
            continue
        info = system.get_file_info(inner or "/")
        if info.type == fs.FileType.Directory:
            found = system.get_file_info(fs.FileSelector(inner))
            for item in sorted(found, key=lambda f: f.path):
                if item.path.endswith((".warc.gz", ".warc")):
                    yield given + item.path[len(inner) :], item.size
        elif info.type == fs.FileType.File:
            yield given, info.size
        else:
            raise FileNotFoundError(given)


def _matching(system, pattern):
    """Paths and sizes of the files whose path matches a pattern part by part."""
    parts = pattern.split("/")
    fixed = next(k for k, part in enumerate(parts) if any(sign in part for sign in "*?["))
    folders = ["/".join(parts[:fixed])]
    for depth, part in enumerate(parts[fixed:], fixed):
        found = [
            f for folder in folders
            for f in system.get_file_info(fs.FileSelector(folder or "/", allow_not_found=True))
            if fnmatchcase(f.path.rpartition("/")[2], part)
        ]
        if depth == len(parts) - 1:
            return [(f.path, f.size) for f in found if f.is_file]
        folders = [f.path for f in found if f.type == fs.FileType.Directory]


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)


def read_warc(
    spark: SparkSession,
    paths: str | list[str],
    header_only: bool = False,
    responses_only: bool = True,
    errors: str = "raise",
    index: DataFrame | None = None,
    split_bytes: int = SPLIT_BYTES,
) -> DataFrame:
    """Archive records as rows; ``paths`` are files or folders on any file system."""
    if index is not None:
        return _read_ranges(spark, paths, header_only, responses_only, errors, index, split_bytes)
    register(spark)
    joined = paths if isinstance(paths, str) else "\n".join(paths)
    return (
        spark.read.format("warc")
        .option("headerOnly", header_only)
        .option("responsesOnly", responses_only)
        .option("errors", errors)
        .load(joined)
    )


def _files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``path, file, size`` of all archives, in the order in which a scan numbers them."""
    given = paths.split("\n") if isinstance(paths, str) else paths
    found = enumerate(_archives([p for p in given if p]))
    listed = [(path, number, size) for number, (path, size) in found]
    return spark.createDataFrame(listed, "path string, file bigint, size bigint")


def _spread(pieces: DataFrame, size) -> DataFrame:
    """Files or ranges dealt to the tasks that read them."""
    number, total = pieces.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return pieces.repartition(_task_number(number, total))


def archive_index(spark: SparkSession, paths: str | list[str], errors: str = "raise") -> DataFrame:
    """``path, offset, length, record, target_uri`` of every place where a scan may begin.

    One row per gzip member that begins with a record, or per record of a plain file; ``record`` is the
    number of that record in its member or plain file, ``target_uri`` its own.  A file is read once, by one
    task: write the result to a table.  With ``errors="quarantine"`` damaged stretches have no row.
    """
    files = _files(spark, paths).select("path", "size").distinct()
    schema = pa.schema(
        [("path", pa.string())] + [(n, pa.int64()) for n in ("offset", "length", "record")] + [("target_uri", pa.string())]
    )

    def starts(path: str, size: int) -> Iterator[tuple]:
        before = None
        for row in records(path, header_only=True, quarantine=errors == "quarantine"):
            if row.get("offset") is None:
                continue
            if before:
                yield (path, before[0], row["offset"] - before[0], *before[1:])
            before = (row["offset"], row["record"], row["target_uri"])
        if before:
            yield (path, before[0], size - before[0], *before[1:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for given in batch.to_pylist():
                found = starts(given["path"], given["size"])
                while some := list(islice(found, 8192)):
                    columns = [pa.array(c, f.type) for c, f in zip(zip(*some, strict=True), schema, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return _spread(files, F.col("size")).mapInArrow(run, INDEX_FIELDS)


def read_cdx(spark: SparkSession, cdx: str | list[str], archives: str | list[str]) -> DataFrame:
    """An index of gzip archives from CDX lines (9 or 11 fields) or CDXJ lines (JSON behind two fields).

    File names are matched by their last part, which must be unique among the archives.
    """
    files = _files(spark, archives).select("path", F.regexp_extract("path", "[^/]*$", 0).alias("name")).distinct()
    twice = files.groupBy("name").count().filter("count > 1").first()
    if twice:
        raise ValueError(f"two archives are called {twice.name}")
    fields = F.split(F.col("value"), " ")
    named = F.from_json(
        F.regexp_extract("value", r"\{.*\}", 0), "filename string, offset string, length string, url string"
    )
    is_json = F.contains("value", F.lit("{"))
    lines = (
        spark.read.text(cdx)
        .filter(~F.startswith("value", F.lit(" ")) & (F.col("value") != ""))
        .select(
            F.when(is_json, named["filename"]).otherwise(F.try_element_at(fields, F.lit(-1))).alias("name"),
            F.when(is_json, named["offset"]).otherwise(F.try_element_at(fields, F.lit(-2))).alias("offset"),
            F.when(is_json, named["length"])
            .when(F.size(fields) >= 11, F.try_element_at(fields, F.lit(-3))).alias("length"),
            F.when(is_json, named["url"]).otherwise(F.get(fields, 2)).alias("target_uri"),
        )
    )
    last = F.regexp_extract("name", "[^/]*$", 0)
    return lines.withColumn("name", last).join(files, "name").filter(F.col("name").endswith(".gz")).select(
        "path", F.col("offset").cast("bigint").alias("offset"), F.col("length").cast("bigint").alias("length"),
        F.lit(0).cast("bigint").alias("record"), "target_uri",
    )


def archive_ranges(files: DataFrame, index: DataFrame, split_bytes: int) -> DataFrame:
    """``path, file, start, stop, record``: consecutive ranges of every file that begin at indexed offsets."""
    starts = files.join(index.select("path", "offset", "record").distinct(), "path").filter("offset < size")
    first = files.select("*", F.lit(0).cast("bigint").alias("offset"), F.lit(0).cast("bigint").alias("record"))
    split = F.floor(F.col("offset") / split_bytes)
    begun = (
        starts.unionByName(first)
        .groupBy("path", "file", "size", split.alias("split"))
        .agg(F.min(F.struct("offset", "record")).alias("at"))
    )
    # One row per range: a file has few of them.
    after = Window.partitionBy("file").orderBy("split")
    return begun.select(
        "path", "file", F.col("at.offset").alias("start"),
        F.coalesce(F.lead("at.offset").over(after), F.col("size")).alias("stop"),
        F.col("at.record").alias("record"),
    )


def _read_ranges(spark, paths, header_only, responses_only, errors, index, split_bytes) -> DataFrame:
    ranges = archive_ranges(_files(spark, paths), index, split_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _arrow_schema(header_only, errors)
        for batch in batches:
            for r in batch.to_pylist():
                found = records(
                    r["path"], header_only, r["start"], r["stop"], r["record"], errors == "quarantine"
                )
                yield from _batches(found, r["file"], responses_only, schema)

    # The ranges are a table of offsets, a row per ``split_bytes``.
    return _spread(ranges, F.col("stop") - F.col("start")).mapInArrow(run, fields(header_only, errors))


def archive_metadata(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Seven header columns of every record; records without HTTP headers have no status line."""
    return read_warc(spark, paths, header_only=True, responses_only=False).select(
        "archive", "statusline", "target_uri", "warc_type", "payload_digest", "block_digest",
        "content_length",
    )


def record_headers(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """HTTP and record headers of the responses, one ``array<struct<name,value>>`` each."""
    return read_warc(spark, paths, header_only=True).select("ord", "http_headers", "rec_headers")
