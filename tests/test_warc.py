"""Archive scan on hand-written bytes: members, bodies, odd records, splits, merge."""

import gzip
import json
import zlib

import pytest

from winnow.operators.captures import captures, merge_captures, stack_headers
from winnow.sinks.files import write_files
from winnow.sources.warc import LEAST_TASKS, archive_index, archive_metadata, read_cdx, read_warc
from winnow.sources.warc_records import decoded_body, records


def record(kind, uri, block, extra=""):
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\n"
    if uri:
        head += f"WARC-Target-URI: {uri}\r\n"
    head += f"{extra}Content-Length: {len(block)}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


def response(uri, body, status="200 OK", headers="", extra=""):
    block = f"HTTP/1.1 {status}\r\n{headers}\r\n".encode() + body
    return record("response", uri, block, extra)


CHUNKED = b"4\r\nWiki\r\n5;x=1\r\npedia\r\n0\r\n\r\n"
ONE = [
    record("warcinfo", None, b"software: x\r\n"),
    record("request", "http://a/", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n"),
    response("http://a/", b"first", extra="WARC-Payload-Digest: sha1:AA\r\n"),
    response("http://c/", CHUNKED, headers="Transfer-Encoding: chunked\r\n"),
    response("http://g/", gzip.compress(b"zipped"), headers="Content-Encoding: gzip\r\n"),
    response("http://d/", zlib.compress(b"flat"), headers="Content-Encoding: deflate\r\n"),
    response("http://m/", b"odd", status="broken line"),
    response("http://h/", b"\r\n\r\nbody\r\nWARC/1.0\r\n", headers="Set-Cookie: 1\r\nSet-Cookie: 2\r\nA: b\r\n"),
]
TWO = [response("http://a/", b"second"), response("http://n/", b"new", status="404 Not Found")]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("warcs")
    (path / "1.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in ONE))
    (path / "2.warc").write_bytes(b"".join(TWO))
    (path / "notes.txt").write_text("no archive")
    return path


def test_responses_and_bodies(spark, folder):
    rows = captures(read_warc(spark, str(folder))).orderBy("ord").collect()
    assert [(r.target_uri, r.status, bytes(r.content)) for r in rows] == [
        ("http://a/", 200, b"first"),
        ("http://c/", 200, b"Wikipedia"),
        ("http://g/", 200, b"zipped"),
        ("http://d/", 200, b"flat"),
        ("http://m/", None, b"odd"),
        ("http://h/", 200, b"\r\n\r\nbody\r\nWARC/1.0\r\n"),
        ("http://a/", 200, b"second"),
        ("http://n/", 404, b"new"),
    ]
    assert rows[0].content_length == len(b"HTTP/1.1 200 OK\r\n\r\nfirst")


def test_metadata_lists_every_record(spark, folder):
    rows = archive_metadata(spark, str(folder)).collect()
    assert sorted({r.archive for r in rows}) == ["1.warc.gz", "2.warc"]
    kinds = [r.warc_type for r in rows]
    assert (kinds.count("warcinfo"), kinds.count("request"), kinds.count("response")) == (1, 1, 8)
    info = next(r for r in rows if r.warc_type == "warcinfo")
    assert info.statusline is None and info.target_uri is None
    assert next(r for r in rows if r.payload_digest).payload_digest == "sha1:AA"


def test_header_only_has_no_body_column(spark, folder):
    frame = read_warc(spark, str(folder), header_only=True)
    assert "content" not in frame.columns and frame.count() == 8
    cookie = frame.where("target_uri = 'http://h/'")
    stacked = cookie.select(stack_headers(cookie.http_headers).alias("h")).collect()[0].h
    assert stacked == {"Set-Cookie": ["1", "2"], "A": ["b"]}


def test_merge_keeps_the_first_capture_in_list_order(spark, folder):
    one, two = str(folder / "1.warc.gz"), str(folder / "2.warc")

    def merged(paths):
        rows = merge_captures(read_warc(spark, paths)).collect()
        assert len(rows) == 7
        return {r.target_uri: bytes(r.content) for r in rows}["http://a/"]

    assert merged([one, two]) == b"first"
    assert merged([two, one]) == b"second"


def _bodies():
    import random

    rng = random.Random(5)
    bodies = [rng.randbytes(rng.randint(0, 900)) for _ in range(60)]
    # an archive inside an archive: its members look like records
    bodies[30] = gzip.compress(response("http://inner/", b"x" * 50))
    return bodies


def _packed(bodies, per_member):
    records = [response(f"http://r/{i}", body) for i, body in enumerate(bodies)]
    return b"".join(
        gzip.compress(b"".join(records[i : i + per_member])) for i in range(0, len(records), per_member)
    )


@pytest.mark.parametrize("per_member", [1, 7, 60])
def test_members_of_any_size(spark, tmp_path, per_member):
    bodies = _bodies()
    path = tmp_path / "big.warc.gz"
    path.write_bytes(_packed(bodies, per_member))
    rows = read_warc(spark, str(path)).orderBy("ord").collect()
    assert [(r.target_uri, bytes(r.content)) for r in rows] == [
        (f"http://r/{i}", body) for i, body in enumerate(bodies)
    ]
    assert len({r.ord for r in rows}) == len(rows)
    assert merge_captures(read_warc(spark, [str(path), str(path)])).count() == len(rows)
    assert read_warc(spark, str(path), header_only=True).count() == len(rows)


@pytest.mark.parametrize("per_member", [1, 60])
@pytest.mark.parametrize("damage", ["padding", "cut", "flip", "junk"])
@pytest.mark.parametrize("header_only", [False, True])
def test_damage_is_an_error(spark, tmp_path, per_member, damage, header_only):
    raw = bytearray(_packed(_bodies(), per_member))
    if damage == "padding":
        raw += b"\0" * 100
    elif damage == "cut":
        del raw[-200:]
    elif damage == "flip":
        raw[len(raw) // 2 : len(raw) // 2 + 8] = b"\xff" * 8
    else:
        raw += gzip.compress(b"no record\r\n")
    path = tmp_path / "bad.warc.gz"
    path.write_bytes(raw)
    with pytest.raises(Exception, match="bad.warc.gz"):
        read_warc(spark, str(path), header_only=header_only).collect()


def test_lengths_are_checked(spark, tmp_path):
    whole = response("http://a/", b"body of a page")
    for name, raw in {
        "short.warc": whole[:-10],
        "none.warc": whole.replace(b"Content-Length", b"Content-Size"),
        "odd.warc": whole.replace(b"Content-Length: ", b"Content-Length: x"),
    }.items():
        (tmp_path / name).write_bytes(raw)
        with pytest.raises(Exception, match=name):
            read_warc(spark, str(tmp_path / name)).collect()


def test_patterns_and_commas(spark, tmp_path):
    folder = tmp_path / "a,b"
    folder.mkdir()
    for k in (2, 1, 3):
        (folder / f"{k}.warc.gz").write_bytes(gzip.compress(response(f"http://{k}/", b"x")))
    (folder / "other.txt.gz").write_bytes(gzip.compress(b"no archive"))
    rows = read_warc(spark, str(folder / "[12].warc*")).orderBy("ord").collect()
    assert [r.target_uri for r in rows] == ["http://1/", "http://2/"]
    assert read_warc(spark, str(folder)).count() == 3
    with pytest.raises(Exception, match="nothing"):
        read_warc(spark, str(folder / "nothing*")).count()


def test_bodies_of_several_members(spark, tmp_path):
    body = gzip.compress(b"one ") + gzip.compress(b"two")
    path = tmp_path / "m.warc"
    path.write_bytes(response("http://m/", body, headers="Content-Encoding: gzip\r\n"))
    assert bytes(read_warc(spark, str(path)).collect()[0].content) == b"one two"


def test_missing_path_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="nowhere"):
        read_warc(spark, str(tmp_path / "nowhere.warc.gz")).count()


def _same_rows(spark, paths, split_bytes, **options):
    index = archive_index(spark, paths)
    whole = read_warc(spark, paths, **options)
    split = read_warc(spark, paths, index=index, split_bytes=split_bytes, **options)
    assert split.columns == whole.columns
    rows = sorted(map(repr, whole.collect()))
    assert sorted(map(repr, split.collect())) == rows
    return rows, split.rdd.getNumPartitions()


@pytest.mark.parametrize("split_bytes", [1, 3000, 1 << 30])
@pytest.mark.parametrize("per_member", [0, 1, 7])
@pytest.mark.parametrize("header_only", [False, True])
def test_ranges_give_the_rows_of_the_whole_scan(spark, tmp_path, split_bytes, per_member, header_only):
    bodies = _bodies()
    raw = _packed(bodies, per_member) if per_member else b"".join(
        response(f"http://r/{i}", body) for i, body in enumerate(bodies)
    )
    path = tmp_path / ("big.warc.gz" if per_member else "big.warc")
    path.write_bytes(raw)
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in ONE))
    paths = [str(path), str(tmp_path / "a.warc.gz"), str(path)]
    rows, parts = _same_rows(spark, paths, split_bytes, header_only=header_only, responses_only=False)
    assert len(rows) == 2 * len(bodies) + len(ONE)
    assert parts > 20 if split_bytes == 1 else parts == 3 if split_bytes == 1 << 30 else parts > 3


def test_no_range_begins_inside_a_record(spark, tmp_path):
    """A stream cut into members anywhere: only members that begin with a record are indexed."""
    stream = b"".join(response(f"http://r/{i}", b"x" * (37 * i)) for i in range(40))
    cuts = [0, 500, 501, 2000, 5000, 5000 + stream[5000:].index(b"WARC/1.0"), 20_000, len(stream)]
    raw = b"".join(gzip.compress(stream[a:b]) for a, b in zip(cuts, cuts[1:], strict=False))
    (tmp_path / "s.warc.gz").write_bytes(raw)
    rows, parts = _same_rows(spark, str(tmp_path), 1)
    assert len(rows) == 40 and parts == archive_index(spark, str(tmp_path)).count() == 2


def test_an_index_that_does_not_fit_is_an_error(spark, tmp_path):
    path = tmp_path / "r.warc.gz"
    path.write_bytes(_packed(_bodies(), 1))
    index = archive_index(spark, str(path))
    wrong = index.withColumn("offset", index["offset"] + 3)
    with pytest.raises(Exception, match="r.warc.gz"):
        read_warc(spark, str(path), index=wrong, split_bytes=4000).collect()
    other = index.selectExpr("concat(path, 'x') AS path", "offset", "record")  # an index of other files: one range per file
    assert read_warc(spark, str(path), index=other, split_bytes=10).count() == len(_bodies())


def test_index_lists_offsets_and_lengths(spark, folder):
    path = str(folder / "1.warc.gz")
    rows = archive_index(spark, path).orderBy("offset").collect()
    assert [r.offset for r in rows] == [sum(len(gzip.compress(x)) for x in ONE[:k]) for k in range(len(ONE))]
    assert [r.length for r in rows] == [len(gzip.compress(x)) for x in ONE]
    plain = archive_index(spark, str(folder / "2.warc")).orderBy("offset").collect()
    assert [(r.offset, r.length, r.record, r.target_uri) for r in plain] == [
        (0, len(TWO[0]), 0, "http://a/"), (len(TWO[0]), len(TWO[1]), 1, "http://n/"),
    ]
    assert archive_index(spark, []).count() == 0


def test_cdx_lines_are_an_index(spark, tmp_path):
    path = tmp_path / "r.warc.gz"
    path.write_bytes(_packed(_bodies(), 1))
    rows = archive_index(spark, str(path)).collect()
    lines = [" CDX N b a m s k r M S V g"]
    lines += [f"k 2020 {r.target_uri} text/html 200 A - - {r.length} {r.offset} some/r.warc.gz" for r in rows[::2]]
    lines += [f"k 2020 {r.target_uri} text/html 200 A - {r.offset} r.warc.gz" for r in rows[1:9:2]]
    lines += [
        "k 2020 " + json.dumps({"url": r.target_uri, "filename": "x/r.warc.gz", "offset": str(r.offset), "length": "9"})
        for r in rows[9::2]
    ]
    lines += ["", "k 2020 u t 200 A - 0 other.warc.gz"]
    (tmp_path / "index.cdx").write_text("\n".join(lines))
    index = read_cdx(spark, str(tmp_path / "index.cdx"), str(path))
    assert {(r.offset, r.target_uri) for r in index.collect()} == {(r.offset, r.target_uri) for r in rows}
    split = read_warc(spark, str(path), index=index, split_bytes=1)
    assert split.rdd.getNumPartitions() == len(rows)
    assert sorted(split.collect()) == sorted(read_warc(spark, str(path)).collect())


@pytest.mark.parametrize("split_bytes", [None, 1, 4000])
@pytest.mark.parametrize("per_member", [0, 1, 7])
def test_damage_becomes_rows(spark, tmp_path, per_member, split_bytes):
    bodies = _bodies()
    records_ = [response(f"http://r/{i}", body) for i, body in enumerate(bodies)]
    if per_member:
        members = [gzip.compress(b"".join(records_[i : i + per_member])) for i in range(0, 60, per_member)]
    else:
        members = list(records_)
    whole = b"".join(members)
    path = tmp_path / ("d.warc.gz" if per_member else "d.warc")
    path.write_bytes(whole)
    index = archive_index(spark, str(path)).collect() if split_bytes else None
    bad = {3, 4, 8}
    for k in bad:
        if per_member:
            members[k] = members[k][:-12] + b"\xff" * 6 + members[k][-6:]
        else:
            members[k] = members[k].replace(b"Content-Length: ", b"Content-Length? ")
    path.write_bytes(b"".join(members) + (b"" if split_bytes else b"\0" * 40))
    options = {}
    if split_bytes:
        frame = spark.createDataFrame(index, "path string, offset long, length long, record long, target_uri string")
        options = {"index": frame, "split_bytes": split_bytes}
    rows = read_warc(spark, str(path), errors="quarantine", **options).collect()
    good = {r.target_uri: bytes(r.content) for r in rows if r._error is None}
    step = per_member or 1
    lost = {i for k in bad for i in range(k * step, min(60, (k + 1) * step))}
    # Records of a damaged member that were whole before the damage may be kept, all others must be.
    assert {f"http://r/{i}" for i in range(60) if i not in lost} <= set(good)
    assert all(good[u] == bodies[int(u[9:])] for u in good)
    # The padding behind a damaged last member belongs to the same stretch.
    padded = split_bytes is None and len(members) - 1 not in bad
    assert len(rows) - len(good) == len(bad) + padded
    assert all(r.archive == path.name and "passed over" in r._error for r in rows if r._error)
    assert len({r.ord for r in rows}) == len(rows)
    with pytest.raises(Exception, match="d.warc"):
        read_warc(spark, str(path), **options).collect()


def test_quarantine_of_a_sound_archive_changes_nothing(spark, folder):
    rows = read_warc(spark, str(folder), errors="quarantine").drop("_error").collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, read_warc(spark, str(folder)).collect()))
    with pytest.raises(Exception, match="unknown treatment"):
        read_warc(spark, str(folder), errors="skip").count()


def test_damage_anywhere_ends(tmp_path):
    """Whatever bytes are changed, reading ends and gives only rows of the archive or errors."""
    import random

    rng = random.Random(9)
    raw = _packed(_bodies(), 3)
    for k in range(60):
        broken = bytearray(raw)
        for _ in range(rng.randint(1, 6)):
            at = rng.randrange(len(broken))
            broken[at : at + rng.randint(0, 40)] = rng.randbytes(rng.randint(0, 40))
        path = tmp_path / f"{k}.warc.gz"
        path.write_bytes(broken)
        rows = list(records(str(path), False, quarantine=True))
        assert all(r.get("_error") or r["warc_type"] for r in rows)
        assert len(rows) > 10


def test_bodies_say_what_is_wrong():
    gz, long = gzip.compress(b"text" * 500), b"x" * 300
    as_ = lambda name, value: [{"name": name, "value": value}]
    packed, sliced = "Content-Encoding", as_("Transfer-Encoding", "chunked")
    assert decoded_body(gz, as_(packed, "gzip")) == (b"text" * 500, None)
    assert decoded_body(gz[:-2], as_(packed, "gzip")) == (b"text" * 500, "cut gzip")
    assert decoded_body(b"plain", as_(packed, "gzip")) == (b"plain", "not gzip")
    assert decoded_body(b"", as_(packed, "gzip")) == (b"", None)
    assert decoded_body(b"\x0b", as_(packed, "br")) == (b"\x0b", "unknown encoding: br")
    assert decoded_body(zlib.compress(long)[:-5], as_(packed, "Deflate"))[1] == "cut deflate"
    assert decoded_body(b"x", as_(packed, "identity")) == (b"x", None)
    assert decoded_body(CHUNKED, sliced) == (b"Wikipedia", None)
    assert decoded_body(CHUNKED[:-5], sliced) == (b"Wikipedia", "cut chunks")
    assert decoded_body(CHUNKED[:7], sliced) == (b"Wiki", "cut chunks")
    assert decoded_body(b"12c\r\n" + long[:100], sliced) == (long[:100], "cut chunks")
    assert decoded_body(b"no chunks", sliced) == (b"no chunks", "not chunked")


def test_truncated_records_are_marked(spark, tmp_path):
    (tmp_path / "t.warc").write_bytes(response("http://t/", b"half", extra="WARC-Truncated: length\r\n"))
    row = read_warc(spark, str(tmp_path)).first()
    assert (bytes(row.content), row.body_error) == (b"half", "truncated: length")


def test_patterns_in_any_part(spark, tmp_path):
    for day in ("d1", "d2", "e1"):
        (tmp_path / day / "warc").mkdir(parents=True)
        (tmp_path / day / "warc" / "x.warc.gz").write_bytes(gzip.compress(response(f"http://{day}/", b"x")))
    rows = read_warc(spark, str(tmp_path / "d*" / "warc" / "*.gz")).orderBy("ord").collect()
    assert [r.target_uri for r in rows] == ["http://d1/", "http://d2/"]
    with pytest.raises(Exception, match="f\\*"):
        read_warc(spark, str(tmp_path / "f*" / "warc" / "*.gz")).count()


def test_many_small_files_share_tasks(spark, tmp_path):
    """The number of tasks follows the bytes, not the files or ranges; every file keeps its number."""
    for i in range(600):
        (tmp_path / f"{i:03d}.warc").write_bytes(response(f"http://s/{i}", b"x" * (i % 7)))
    scan = read_warc(spark, str(tmp_path))
    index = archive_index(spark, str(tmp_path))
    split = read_warc(spark, str(tmp_path), index=index, split_bytes=1)
    assert LEAST_TASKS <= scan.rdd.getNumPartitions() < 400
    assert index.rdd.getNumPartitions() == split.rdd.getNumPartitions() == LEAST_TASKS
    for rows in (scan, split):
        found = rows.select("ord.file", "target_uri", "content").collect()
        assert sorted((r.file, r.target_uri, len(r.content)) for r in found) == [
            (i, f"http://s/{i}", i % 7) for i in range(600)
        ]


def test_files_are_written_where_they_are_made(spark, tmp_path):
    def make(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield f"{row['id']}.bin", b"%d" % row["id"]

    write_files(spark.range(9), str(tmp_path / "made"), make)
    assert {p.name: p.read_bytes() for p in (tmp_path / "made").iterdir()} == {f"{i}.bin": b"%d" % i for i in range(9)}


def test_archives_are_written_piece_by_piece(spark, tmp_path):
    """A body may come in pieces, and a task meets its rows in batches bounded by bytes."""

    def make(batches):
        for number, batch in enumerate(batches):
            yield f"{number}.warc", (b"%d," % batch.num_rows for _ in range(2))

    write_files(spark.range(0, 40, 1, 1).selectExpr("repeat('x', 1 << 20) AS body"), str(tmp_path / "pieces"), make)
    written = [p.read_text().split(",")[:2] for p in (tmp_path / "pieces").glob("*.warc")]
    assert sum(int(first) for first, _ in written) == 40 and all(a == b for a, b in written)
    assert max(int(first) for first, _ in written) <= 10
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) in (None, str(2**31 - 1), "2147483647b")
