"""Reading the records of one archive file: gzip members, headers and HTTP bodies."""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

from pyarrow import fs

CHUNK = 1 << 20
MEMBER_START = b"\x1f\x8b\x08"
FIRST_LINE = b"WARC/"


def file_system(path: str):
    """``(file system, inner path)``; plain paths are local or shared mounts."""
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


class ByteFeed:
    """Byte stream of an archive from ``start`` to ``stop``, gzip members unpacked one by one.

    ``member_at`` is the file offset of the member the newest bytes came from, 0 in plain files.
    ``taken`` counts the unpacked bytes handed out; ``starts`` holds for recent members their place in
    that count and their offset.
    """

    def __init__(self, handle, start: int, packed: bool, stop: int | None = None):
        self.handle, self.packed, self.start = handle, packed, start
        self.buffer, self.raw = bytearray(), b""
        self.raw_at, self.member_at = start, start if packed else 0
        self.stop, self.taken = stop, 0
        self.starts: deque[tuple[int, int]] = deque(maxlen=64)
        self.inflater = None
        handle.seek(start)

    def fill(self) -> bool:
        """Add bytes to the buffer; False at the end of the file or range."""
        if not self.raw:
            most = CHUNK if self.stop is None else min(CHUNK, self.stop - self.raw_at)
            self.raw = self.handle.read(most) if most > 0 else b""
            if not self.raw:
                if self.inflater is not None:
                    raise ValueError("the file ends inside a gzip member")
                return False
        if not self.packed:
            self.buffer += self.raw
            rest = b""
        else:
            if self.inflater is None:
                self.inflater = zlib.decompressobj(zlib.MAX_WBITS | 16)
                self.member_at = self.raw_at
                self.starts.append((self.taken + len(self.buffer), self.raw_at))
            self.buffer += self.inflater.decompress(self.raw, 4 * CHUNK)
            rest = self.inflater.unconsumed_tail
            if self.inflater.eof:
                rest = self.inflater.unused_data
                self.inflater = None
        self.raw_at += len(self.raw) - len(rest)
        self.raw = rest
        return True

    def start_between(self, least: int, most: int) -> int | None:
        """File offset at which a reader finds the same records from place ``most`` on: that of a member
        that begins at ``least`` or later, or of the place itself in a plain file."""
        if not self.packed:
            return self.start + most
        return next((offset for at, offset in self.starts if least <= at <= most), None)

    def take(self, count: int) -> bytes:
        while len(self.buffer) < count and self.fill():
            pass
        taken = bytes(self.buffer[:count])
        del self.buffer[:count]
        self.taken += len(taken)
        return taken

    def skip(self, count: int) -> None:
        """Drop bytes without keeping them."""
        while count > len(self.buffer):
            count -= len(self.buffer)
            self.taken += len(self.buffer)
            self.buffer.clear()
            if not self.fill():
                raise ValueError("the record ends inside its block")
        del self.buffer[:count]
        self.taken += count

    def line(self) -> bytes | None:
        """Next line with its line end; None at the end of the file."""
        at = seen = 0
        while (at := self.buffer.find(b"\n", seen)) < 0:
            seen = len(self.buffer)
            if not self.fill():
                return None
        return self.take(at + 1)


def records(
    path: str, header_only: bool, start: int = 0, stop: int | None = None, first: int = 0,
    quarantine: bool = False,
) -> Iterator[dict]:
    """Records of one file that begin from ``start`` to ``stop``, the first of them with number ``first``.

    ``start`` is an offset that an earlier pass gave as ``offset``; None there means that no reader may
    begin at this record.  Damage and missing bytes raise an error, or with ``quarantine`` give a row with
    ``_error``; reading then goes on at the next place that reads as a record.
    """
    system, inner = file_system(path)
    archive = inner.rstrip("/").rsplit("/", 1)[-1]
    with system.open_input_file(inner) as handle:
        packed = handle.read(2) == MEMBER_START[:2]
        inside, member = first - 1, None
        while start is not None:
            feed, end, at, held = ByteFeed(handle, start, packed, stop), 0, 0, None
            try:
                while True:
                    at = feed.taken
                    first_line = _at_record(feed)
                    if held:
                        yield held
                    if first_line is None:
                        return
                    at = feed.taken - len(first_line)
                    own = feed.member_at
                    inside = inside + 1 if own == member or not packed else 0
                    member = own
                    offset = feed.start_between(end, at)
                    held = None
                    row = {"member": own, "record": inside, "offset": offset}
                    row |= _record(feed, archive, header_only)
                    end = feed.taken
                    # The check sum of a member stands behind its last record, so rows wait for what follows.
                    held = row
            except (zlib.error, ValueError) as error:
                said = f"{archive}, behind byte {feed.member_at or feed.start + at}: {error}"
                if not quarantine:
                    raise ValueError(said) from error
                # Nothing vouches for a row of a member whose check sum was not reached.
                if held and not (packed and held["member"] == feed.member_at and feed.inflater):
                    yield held
                begun = feed.member_at if packed else feed.start + at
                start = _next_start(handle, begun + 1, stop, packed)
                there = stop if start is None else start
                passed = f"bytes from {begun} to {'the end' if there is None else there} passed over"
                if packed:
                    inside = 0 if begun != member else inside + 1
                    member = begun
                # In plain files, where rows have member 0, such a row has the offset of the damage there.
                yield {"member": begun, "record": inside, "archive": archive, "_error": f"{said}; {passed}"}


def _next_start(handle, after: int, stop: int | None, packed: bool) -> int | None:
    """First offset from ``after`` on where a record can begin; None if there is none before ``stop``."""
    wanted = MEMBER_START if packed else b"\n" + FIRST_LINE
    at, held = after, b""
    handle.seek(after)
    while True:
        most = CHUNK if stop is None else min(CHUNK, stop - at - len(held))
        read = handle.read(most) if most > 0 else b""
        held += read
        place = held.find(wanted)
        while place >= 0:
            if not packed:
                return at + place + 1
            if _opens_record(handle, at + place, stop):
                return at + place
            place = held.find(wanted, place + 1)
        if not read:
            return None
        kept = len(wanted) - 1
        at, held = at + len(held) - len(held[-kept:]), held[-kept:]
        handle.seek(at + len(held))


def _opens_record(handle, offset: int, stop: int | None) -> bool:
    """Does a gzip member at ``offset`` unpack to the first line of a record?"""
    handle.seek(offset)
    raw = handle.read(4096 if stop is None else min(4096, stop - offset))
    try:
        return zlib.decompressobj(zlib.MAX_WBITS | 16).decompress(raw, 64).lstrip().startswith(FIRST_LINE)
    except zlib.error:
        return False


def _at_record(feed: ByteFeed) -> bytes | None:
    """Step behind the first line of the next record and return it; blank lines may stand before it."""
    while (line := feed.line()) is not None:
        if line.startswith(FIRST_LINE):
            return line
        if line.strip():
            raise ValueError("bytes between records")
    if feed.buffer.strip():
        raise ValueError("bytes behind the last record")
    return None


def _pairs(lines: list[bytes]) -> list[dict]:
    pairs: list[dict] = []
    for raw in lines:
        text = raw.decode("utf-8", "replace").rstrip("\r\n")
        if text[:1] in (" ", "\t") and pairs:
            pairs[-1]["value"] += " " + text.strip()
        elif ":" in text:
            name, value = text.split(":", 1)
            pairs.append({"name": name.strip(), "value": value.strip()})
    return pairs


def _value(pairs: list[dict], name: str) -> str | None:
    return next((p["value"] for p in pairs if p["name"].lower() == name.lower()), None)


def _record(feed: ByteFeed, archive: str, header_only: bool) -> dict:
    lines = []
    while (line := feed.line()) is not None and line.strip():
        lines.append(line)
    if line is None:
        raise ValueError("the record ends inside its header")
    rec = _pairs(lines)
    kind = _value(rec, "WARC-Type")
    declared = _value(rec, "Content-Length") or ""
    if not declared.isascii() or not declared.isdigit():
        raise ValueError(f"record without a length: {declared!r}")
    left = int(declared)
    has_http = kind in ("response", "request", "revisit") and left > 0
    head = _http_head(feed, left) if has_http else b""
    left -= len(head)
    if header_only:
        body = b""
        feed.skip(left)
    else:
        body = feed.take(left)
        if len(body) < left:
            raise ValueError("the record ends inside its block")
    statusline, http = None, None
    if has_http:
        first, *others = head.splitlines() or [b""]
        statusline = first.decode("utf-8", "replace").partition(" ")[2].strip()
        http = _pairs(others)
    row = {
        "archive": archive,
        "statusline": statusline,
        "target_uri": _value(rec, "WARC-Target-URI"),
        "warc_type": kind,
        "payload_digest": _value(rec, "WARC-Payload-Digest"),
        "block_digest": _value(rec, "WARC-Block-Digest"),
        "content_length": declared,
        "http_headers": http,
        "rec_headers": rec,
    }
    if not header_only:
        row["content"], row["body_error"] = decoded_body(body, http or [])
        if (cut := _value(rec, "WARC-Truncated")) and row["body_error"] is None:
            row["body_error"] = f"truncated: {cut}"
    return row


def _http_head(feed: ByteFeed, most: int) -> bytes:
    """The block up to its first empty line, at most ``most`` bytes."""
    seen = 0
    while True:
        ends = [
            at + len(gap)
            for gap in (b"\r\n\r\n", b"\n\n")
            if 0 <= (at := feed.buffer.find(gap, max(0, seen - 3), most))
        ]
        if ends and min(ends) <= most:
            return feed.take(min(ends))
        seen = len(feed.buffer)
        if seen >= most:
            return feed.take(most)
        if not feed.fill():
            raise ValueError("the record ends inside its block")


def decoded_body(body: bytes, http: list[dict]) -> tuple[bytes, str | None]:
    """Body without its transfer and content encoding, and what is wrong with it (None: nothing).

    A cut body gives what can be read of it, an unreadable one stays as it is.
    """
    wrong = None
    if (_value(http, "Transfer-Encoding") or "").lower() == "chunked":
        body, wrong = _unchunked(body)
    packing = (_value(http, "Content-Encoding") or "").strip().lower()
    if packing in ("", "identity"):
        return body, wrong
    kinds = {"gzip": (31,), "x-gzip": (31,), "deflate": (15, -15)}.get(packing)
    if kinds is None:
        return body, wrong or f"unknown encoding: {packing}"
    if not body:
        return body, wrong
    for bits in kinds:
        try:
            out, whole = _inflated(body, bits)
        except zlib.error:
            continue
        return out, wrong or (None if whole else f"cut {packing}")
    return body, wrong or f"not {packing}"


def _inflated(body: bytes, bits: int) -> tuple[bytes, bool]:
    """All members of a packed body, and whether the last one is whole; what follows is no part of it."""
    out, whole = [], True
    while body:
        inflater = zlib.decompressobj(bits)
        out.append(inflater.decompress(body) + inflater.flush())
        whole = inflater.eof
        body = inflater.unused_data
        if not body.startswith(MEMBER_START):
            break
    return b"".join(out), whole


def _unchunked(body: bytes) -> tuple[bytes, str | None]:
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            return (b"".join(out), "cut chunks") if out or not body else (body, "not chunked")
        try:
            size = int(body[at:end].split(b";")[0], 16)
        except ValueError:
            return (b"".join(out), "cut chunks") if out else (body, "not chunked")
        if size == 0:
            return b"".join(out), None
        out.append(body[end + 2 : end + 2 + size])
        at = end + 2 + size + 2
        if at > len(body):
            return b"".join(out), "cut chunks"
