"""URL expressions.  Every function takes and returns a Column and stays in the JVM."""

from __future__ import annotations

from urllib.parse import uses_params

from pyspark.sql import Column
from pyspark.sql import functions as F

from winnow.functions.common import bind, strip_space

# --- fixed values: patterns and word lists that decide results ---------------
URL_PARTS = r"(?s)\A(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?\z"
ARCHIVE_MARK = "archive.org"
SNAPSHOT_HOST = "web.archive.org"
PORT = r":\p{Nd}{1,5}/"
IMAGE_SIZE = r"(?iu)/s\p{Nd}{1,4}/"
IMAGE_EXTENSION = r"(?iu)\.(jpe?g|png|gif|bmp|webp|avif)"
IGNORED_LINKS = [
    "www.amazon",
    "amzn.to",
    "amzn.com",
    "ravelry.com",
    "greatamigurumi.blogspot",
    "mailto:",
    "drive.google.com",
    "youtube.com",
    "facebook.com",
]
IGNORED_EXTENSIONS = [".pdf"]
NOT_A_CANDIDATE = r"(?iu)^(?:javascript|mailto):.+|share"
# ------------------------------------------------------------------------------


def _prepared(url: Column) -> Column:
    # Leading control characters and embedded tabs / line ends are no part of a URL.
    return F.regexp_replace(url, r"^[\x00-\x20]+|[\t\r\n]", "")


def url_part(url: Column, group: int) -> Column:
    """Group 1 scheme, 2 host with port, 3 path, 4 query, 5 fragment ('' if absent)."""
    return F.regexp_extract(_prepared(url), URL_PARTS, group)


def url_path(url: Column) -> Column:
    """Path without the ``;params`` of its last segment, where the scheme knows params."""

    def path(clean: Column) -> Column:
        inner = F.regexp_extract(clean, URL_PARTS, 3)
        with_params = F.lower(F.regexp_extract(clean, URL_PARTS, 1)).isin(uses_params)
        cut = F.contains(inner, F.lit(";")) & with_params
        return F.when(cut, F.regexp_replace(inner, r";[^/]*\z", "")).otherwise(inner)

    return path(_prepared(url))


def url_host(url: Column) -> Column:
    return url_part(url, 2)


def original_url(url: Column, strip_port: bool = True) -> Column:
    """Address a snapshot URL was taken from; '' when it embeds none, other URLs unchanged."""
    embedded = F.regexp_extract(url, r"(?s)/(http.*)\z", 1)
    if strip_port:
        embedded = F.regexp_replace(embedded, PORT, "/")
    return F.when(F.contains(url, F.lit(ARCHIVE_MARK)), embedded).otherwise(url)


def full_size_image(url: Column) -> Column:
    """Ask the blog image host for the unscaled picture (``/s320/`` becomes ``/s0/``)."""
    return F.regexp_replace(url, IMAGE_SIZE, "/s0/")


def fix_scheme(url: Column) -> Column:
    """Repair ``//x``, ``://x`` and ``hhttp...``."""
    return (
        F.when(F.startswith(url, F.lit("//")), F.concat(F.lit("http:"), url))
        .when(F.startswith(url, F.lit("://")), F.concat(F.lit("http"), url))
        .otherwise(F.regexp_replace(url, "^hhttp", "http"))
    )


def fix_image_url(url: Column, resize_archived: bool = False) -> Column:
    """Repair the scheme, then ask for full size unless the image is an archived one."""
    fixed = fix_scheme(url)
    if resize_archived:
        return full_size_image(fixed)
    return F.when(F.contains(fixed, F.lit(ARCHIVE_MARK)), fixed).otherwise(full_size_image(fixed))


def file_name(url: Column) -> Column:
    """Decoded last path segment with spaces as ``_``; broken escapes are kept as they are."""
    last = F.regexp_extract(url_path(url), r"([^/]*)\z", 1)
    escaped = F.regexp_replace(last, r"%(?![0-9A-Fa-f]{2})", "%25")
    return F.replace(F.url_decode(escaped), F.lit(" "), F.lit("_"))


def path_slug(url: Column) -> Column:
    """Path as one directory name: ``/2021/05/bear.html`` becomes ``2021-05-bear``."""
    inner = F.regexp_replace(url_path(url), r"^/+|/+\z", "")
    return F.replace(F.replace(inner, F.lit("/"), F.lit("-")), F.lit(".html"), F.lit(""))


def canonical_url(url: Column) -> Column:
    """``scheme://host/path`` without query and fragment."""
    return F.concat(F.lower(url_part(url, 1)), F.lit("://"), url_part(url, 2), url_part(url, 3))


def is_image_url(url: Column) -> Column:
    return F.rlike(url_path(url), F.lit(IMAGE_EXTENSION))


def is_wanted_link(
    url: Column,
    ignored: list[str] | None = None,
    ignored_extensions: list[str] | None = None,
) -> Column:
    """False for links to hosts, schemes or files that never hold page text."""
    ignored = IGNORED_LINKS if ignored is None else ignored
    ignored_extensions = IGNORED_EXTENSIONS if ignored_extensions is None else ignored_extensions
    lowered = F.lower(url)
    wanted = ~is_image_url(lowered)
    if ignored:
        wanted &= ~F.rlike(lowered, F.lit("|".join(r"\Q" + part + r"\E" for part in ignored)))
    for ending in ignored_extensions:
        wanted &= ~F.endswith(lowered, F.lit(ending))
    return wanted


def is_link_candidate(tag: Column, url: Column, keep_images: bool = True) -> Column:
    """Anchors (and images), without script, mail and share links."""
    tags = ["a", "img"] if keep_images else ["a"]
    return tag.isin(tags) & ~F.rlike(url, F.lit(NOT_A_CANDIDATE))


def is_snapshot(url: Column) -> Column:
    return F.contains(url, F.lit(SNAPSHOT_HOST))


def snapshot_stamp(day: Column) -> Column:
    """Date as the 14-digit stamp of midnight."""
    return F.concat(F.date_format(day, "yyyyMMdd"), F.lit("000000"))


def stamp_seconds(stamp: Column) -> Column:
    """14-digit UTC stamp as epoch seconds in any session zone, NULL when malformed."""
    hours, minutes, seconds = (
        F.substring(stamp, start, 2).try_cast("int") for start in (9, 11, 13)
    )
    days = F.unix_date(F.try_to_date(F.substring(stamp, 1, 8), "yyyyMMdd")).cast("bigint")
    whole = F.rlike(stamp, F.lit(r"\A[0-9]{14}\z"))
    return F.when(
        whole & (hours < 24) & (minutes < 60) & (seconds < 60),
        days * 86_400 + hours * 3_600 + minutes * 60 + seconds,
    )


def post_day(text: Column) -> Column:
    """``May 5, 2021`` as a date, NULL when malformed."""
    return F.try_to_date(text, "MMM d, yyyy")


def image_fallback(url: Column, ok: Column) -> Column:
    """Second address to try for an image whose archived copy failed, else NULL."""
    return F.when(
        ~F.coalesce(ok, F.lit(False)) & F.contains(url, F.lit(ARCHIVE_MARK)),
        F.regexp_extract(url, r"(?s)/(http.*)\z", 1),
    )


def absolute_url(base: Column, link: Column) -> Column:
    """Resolve ``link`` against ``base`` by the RFC 3986 rules."""
    return bind(base_parts(base), lambda parts: resolve(parts, link))


def base_parts(base: Column) -> Column:
    """The parts of a page URL its links need, computed once per page."""

    def parts(url: Column) -> Column:
        scheme, path = F.regexp_extract(url, URL_PARTS, 1), F.regexp_extract(url, URL_PARTS, 3)
        host = F.concat(F.lit("//"), F.regexp_extract(url, URL_PARTS, 2))
        folder = F.regexp_replace(path, r"[^/]*\z", "")
        return F.struct(
            url.alias("url"),
            scheme.alias("scheme"),
            F.concat(
                scheme, F.lit(":"), F.when(F.contains(url, F.lit("//")), host).otherwise("")
            ).alias("root"),
            path.alias("path"),
            F.when(folder == "", "/").otherwise(folder).alias("folder"),
            F.regexp_extract(url, r"(\?[^#]*)", 1).alias("query"),
        )

    return bind(_prepared(base), parts)


def resolve(base: Column, link: Column) -> Column:
    """Absolute form of a link on the page with these ``base_parts``."""
    return bind(_prepared(strip_space(link)), lambda ref: _resolved(base, ref))


def _resolved(base: Column, ref: Column) -> Column:
    root = base["root"]
    ref_path = F.regexp_extract(ref, URL_PARTS, 3)
    tail = F.substring(ref, F.length(ref_path) + 1, F.length(ref))
    path = F.when(F.startswith(ref, F.lit("/")), ref_path).otherwise(
        F.regexp_replace(F.concat(base["folder"], ref_path), "/{2,}", "/")
    )
    dotted = F.rlike(path, F.lit(r"(?:^|/)\.\.?(?:/|\z)"))
    return (
        F.when(ref == "", base["url"])
        .when(
            F.rlike(ref, F.lit(r"^[A-Za-z][A-Za-z0-9+.\-]*:")) | (base["scheme"] == ""), ref
        )
        .when(F.startswith(ref, F.lit("//")), F.concat(base["scheme"], F.lit(":"), ref))
        .when(F.startswith(ref, F.lit("#")), F.concat(root, base["path"], base["query"], ref))
        .when(F.startswith(ref, F.lit("?")), F.concat(root, base["path"], ref))
        .when(F.startswith(ref, F.lit("/")) & ~F.contains(ref, F.lit("/.")), F.concat(root, ref))
        .otherwise(F.concat(root, F.when(dotted, _fold_dots(path)).otherwise(path), tail))
    )


def _fold_dots(path: Column) -> Column:
    def step(kept: Column, segment: Column) -> Column:
        parent = F.when(F.size(kept) > 1, F.slice(kept, 1, F.size(kept) - 1)).otherwise(kept)
        return (
            F.when(segment == "..", parent)
            .when(segment == ".", kept)
            .otherwise(F.concat(kept, F.array(segment)))
        )

    kept = F.aggregate(F.split(path, "/"), F.array().cast("array<string>"), step)
    joined = F.array_join(kept, "/")
    ending = F.when(F.rlike(path, F.lit(r"/\.\.?\z")), "/").otherwise("")
    return F.concat(joined, ending)
