"""HTML expressions over raw page text, all in the JVM and within one row.

Pages are cut with plain patterns instead of a DOM, so extraction fuses with the scan
and needs no shuffle.  Rules that do need a tree are in ``functions.markup``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from winnow.functions.common import bind, strip_space, unescape_entities
from winnow.functions.urls import absolute_url, base_parts, is_link_candidate, resolve

# --- fixed values: page patterns ----------------------------------------------
UNSEEN_PARTS = (
    r"script\b.*?(?:</script[^>]*>|\z)|style\b.*?(?:</style[^>]*>|\z)|!--.*?(?:-->|\z)"
)
UNSEEN = rf"(?is)<(?:{UNSEEN_PARTS})"
UNSEEN_OR_TITLE = rf"(?is)<(?:{UNSEEN_PARTS}|title\b.*?</title[^>]*>)"
FIRST_TITLE = (
    rf"(?is)\A(?:[^<]++|<(?:{UNSEEN_PARTS})|<(?!title\b))*+(<title\b[^>]*>(.*?)</title[^>]*>)"
)
# The inside of a tag: ">" ends it unless it stands in a quoted value.  A tag begins with a letter,
# "/", "!" or "?" behind "<"; any other "<" is text.
INSIDE = r"(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+"
# A tag that is never closed takes the rest of the page, so that nothing is read twice.
CLOSE = r"(?:>|\z)"
TAG = rf"<[A-Za-z/!?]{INSIDE}{CLOSE}"
BEFORE_BODY = rf"(?is)\A.*?<body\b{INSIDE}>"
BASE = rf"(?is)<base(?=[\s/>]){INSIDE}{CLOSE}"
# A link ends where it is closed, where the next one begins, or with the page; tags inside it are read whole,
# so that neither mark counts in their attribute values.
ANCHOR_START = rf"<a(?=[\s/>]){INSIDE}{CLOSE}"
ANCHOR_END = rf"</a(?=[\s/>])[^>]*+{CLOSE}"
ANCHOR = (
    rf"(?is){ANCHOR_START}(?:[^<]++|<(?!/?a[\s/>])(?:[A-Za-z/!?]{INSIDE}{CLOSE})?+)*+(?:{ANCHOR_END})?+"
)
ANCHOR_ENDS = rf"(?is)^{ANCHOR_START}|{ANCHOR_END}\z"
IMAGE = rf"(?is)<img\s{INSIDE}{CLOSE}"
LINKED = rf"(?is)<(?:a|img)\s{INSIDE}{CLOSE}"
VALUE = r"(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)"
ATTRIBUTE = r"[^\s\"'<>/=]+(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?"
BLOCK_TAG = (
    r"(?i)<(?:/?(?:address|article|aside|blockquote|body|dd|div|dl|dt|fieldset|figcaption|figure"
    r"|footer|form|h[1-6]|header|hr|html|li|main|nav|ol|p|pre|section|table|tbody|td|tfoot|th"
    rf"|thead|tr|ul)(?:\s{INSIDE})?/?>|br\s*/?>\s*<br\s*/?>)"
)


def attribute_pattern(names: str) -> str:
    """The value of the first attribute of a closed start tag with one of ``names``, quotes included, as group 1.

    Attributes are read from the left, so a name inside another one's value is no attribute.
    """
    others = rf"(?!(?:{names})[\s/>=])[^\s/>][^\s/>=]*+(?:\s*+=\s*+{VALUE}?+)?+"
    return rf"(?is)^<[a-z][^\s/>]*+(?:[\s/]++|{others})*+(?:{names})\s*+=\s*+({VALUE})(?={INSIDE}>)"


HREF = attribute_pattern("href")
LINK_VALUE = attribute_pattern("href|src")
# ------------------------------------------------------------------------------


def visible(html: Column) -> Column:
    """Page without scripts, style sheets and comments."""
    return F.regexp_replace(html, UNSEEN, "")


def title_text(html: Column) -> Column:
    """Text of the first title element, '' when there is none."""
    return strip_space(unescape_entities(F.regexp_extract(html, FIRST_TITLE, 2)))


def page_body(html: Column) -> Column:
    """What follows the start of the body element, late text included; else the whole page."""
    return F.regexp_replace(html, BEFORE_BODY, "")


def _joined_nodes(html: Column) -> Column:
    spaced = html
    for blank in ("&nbsp;", "&#160;", "&#xa0;", "&#xA0;"):
        spaced = F.replace(spaced, F.lit(blank), F.lit("\u00a0"))
    nodes = F.transform(F.split(spaced, TAG), strip_space)
    return unescape_entities(F.array_join(F.filter(nodes, lambda node: node != ""), " "))


def fast_text(html: Column, title_in_body: bool = True) -> Column:
    """Text nodes of the body joined by blanks, after ``<title>...</title>`` if there is one."""
    if not title_in_body:
        return _joined_nodes(bind(visible(html), page_body))
    head = F.when(
        F.regexp_extract(html, FIRST_TITLE, 1) != "",
        F.concat(F.lit("<title>"), title_text(html), F.lit("</title>")),
    ).otherwise("")
    seen = F.regexp_replace(html, UNSEEN_OR_TITLE, "")
    return F.concat(head, _joined_nodes(bind(seen, page_body)))


def plain_text(html: Column) -> Column:
    """All text nodes of the page, title included, joined by blanks."""
    return _joined_nodes(visible(html))


def _unquoted(value: Column) -> Column:
    return unescape_entities(F.regexp_replace(value, r"^[\"']|[\"']\z", ""))


def attributes(tag: Column) -> Column:
    """Attributes of one tag as a map; the first of repeated names counts."""
    inner = F.regexp_replace(tag, r"^<[^\s/>]+|/?>\z", "")
    pairs = F.transform(
        F.regexp_extract_all(inner, F.lit(ATTRIBUTE), F.lit(0)),
        lambda text: F.struct(
            F.lower(F.regexp_extract(text, r"^([^\s=]+)", 1)).alias("name"),
            _unquoted(F.regexp_extract(text, r"(?s)^[^=]*=\s*(.*)\z", 1)).alias("value"),
        ),
    )
    return bind(
        pairs,
        lambda found: F.map_from_entries(
            F.filter(found, lambda p, i: F.array_position(found["name"], p["name"]) == i + 1)
        ),
    )


def page_base(html: Column, page_url: Column) -> Column:
    """What the links of a page are relative to: its URL, or its base element."""

    def parts(given: Column) -> Column:
        return F.when(given != "", absolute_url(page_url, given)).otherwise(page_url)

    tag = F.regexp_extract(html, BASE, 0)
    href = F.when(F.contains(F.lower(html), F.lit("<base")), strip_space(_unquoted(F.regexp_extract(tag, HREF, 1))))
    return base_parts(bind(F.coalesce(href, F.lit("")), parts))


def images(seen: Column, base: Column | None = None) -> Column:
    """One attribute map per ``<img>`` of a visible page; ``src`` made absolute given its base."""
    tags = F.filter(F.regexp_extract_all(seen, F.lit(IMAGE), F.lit(0)), lambda tag: F.endswith(tag, F.lit(">")))
    maps = F.transform(tags, attributes)
    if base is None:
        return maps

    def resolved(parts: Column) -> Column:
        return F.transform(
            maps,
            lambda attrs: F.transform_values(
                attrs,
                lambda name, value: F.when(name == "src", resolve(parts, value)).otherwise(value),
            ),
        )

    return bind(base, resolved)


def anchors(seen: Column, base: Column) -> Column:
    """``array<struct<link, pos, spaced, text>>`` of the anchors that carry an href.

    ``spaced`` joins the text nodes by blanks, ``text`` joins them directly.
    """

    def read(parts: Column, element: Column, pos: Column) -> Column:
        # Nothing between two tags is no text node.
        nodes = F.filter(F.split(F.regexp_replace(element, ANCHOR_ENDS, ""), TAG), lambda t: t != "")
        return F.struct(
            resolve(parts, _unquoted(F.regexp_extract(element, HREF, 1))).alias("link"),
            pos.alias("pos"),
            strip_space(unescape_entities(F.array_join(nodes, " "))).alias("spaced"),
            strip_space(unescape_entities(F.array_join(nodes, ""))).alias("text"),
        )

    found = F.filter(
        F.regexp_extract_all(seen, F.lit(ANCHOR), F.lit(0)),
        lambda element: F.rlike(element, F.lit(HREF)),
    )
    return bind(
        base, lambda parts: F.transform(found, lambda element, pos: read(parts, element, pos))
    )


def first_links(anchor_list: Column) -> Column:
    """First anchor of every wanted link, in page order: ``array<struct<link, link_text>>``."""
    wanted = F.transform(
        F.filter(anchor_list, lambda a: is_link_candidate(F.lit("a"), a["link"], False)),
        lambda a: F.struct(a["link"].alias("link"), a["pos"].alias("pos"), a["text"].alias("text")),
    )
    firsts = bind(
        F.array_sort(wanted),
        lambda rows: F.filter(
            rows, lambda row, i: (i == 0) | (F.get(rows, i - 1)["link"] != row["link"])
        ),
    )
    by_place = F.array_sort(
        F.transform(
            firsts,
            lambda row: F.struct(
                row["pos"].alias("pos"), row["link"].alias("link"), row["text"].alias("text")
            ),
        )
    )
    return F.transform(
        by_place,
        lambda row: F.struct(row["link"].alias("link"), row["text"].alias("link_text")),
    )


def described_links(anchor_list: Column) -> Column:
    """Web links of a page with all their different texts: ``array<struct<link, desc>>``.

    Sorted copies of the list bring equal links together, so the cost grows with
    n log n of the anchors on the page, never with all pairs of them.
    """
    web = F.transform(
        F.filter(anchor_list, lambda a: F.startswith(a["link"], F.lit("http"))),
        lambda a: F.struct(a["link"].alias("link"), a["spaced"].alias("t"), a["pos"].alias("pos")),
    )
    texts = bind(
        F.array_sort(web),
        lambda rows: F.filter(
            rows,
            lambda row, i: (i == 0)
            | (F.get(rows, i - 1)["link"] != row["link"])
            | (F.get(rows, i - 1)["t"] != row["t"]),
        ),
    )
    ordered = F.array_sort(
        F.transform(
            texts,
            lambda row: F.struct(row["link"].alias("link"), row["pos"].alias("pos"), row["t"].alias("t")),
        )
    )

    def groups(rows: Column) -> Column:
        numbered = F.transform(
            rows, lambda row, i: F.struct(i.alias("at"), row["link"].alias("link"))
        )
        starts = F.filter(
            numbered,
            lambda n: (n["at"] == 0) | (F.get(rows, n["at"] - 1)["link"] != n["link"]),
        )
        return bind(starts, lambda heads: F.transform(heads, lambda h, k: group(rows, heads, h, k)))

    def group(rows: Column, heads: Column, head: Column, k: Column) -> Column:
        end = F.coalesce(F.get(heads, k + 1)["at"], F.size(rows))
        members = F.slice(rows, head["at"] + 1, end - head["at"])
        return F.struct(
            F.get(rows, head["at"])["pos"].alias("pos"),
            head["link"].alias("link"),
            F.array_join(F.filter(members["t"], lambda t: t != ""), "|").alias("desc"),
        )

    return F.transform(
        F.array_sort(bind(ordered, groups)),
        lambda g: F.struct(g["link"].alias("link"), g["desc"].alias("desc")),
    )


def linked_elements(seen: Column, base: Column) -> Column:
    """``array<struct<tag, link>>`` of anchors and images in page order."""
    found = F.filter(
        F.regexp_extract_all(seen, F.lit(LINKED), F.lit(0)),
        lambda element: F.rlike(element, F.lit(LINK_VALUE)),
    )

    def read(parts: Column, element: Column) -> Column:
        return F.struct(
            F.lower(F.regexp_extract(element, r"^<([A-Za-z]+)", 1)).alias("tag"),
            resolve(parts, _unquoted(F.regexp_extract(element, LINK_VALUE, 1))).alias("link"),
        )

    return bind(base, lambda parts: F.transform(found, lambda element: read(parts, element)))


def _words(markup: Column) -> Column:
    return F.regexp_count(F.regexp_replace(markup, TAG, " "), F.lit(r"\S++"))


def _linked_words(markup: Column) -> Column:
    linked = F.array_join(F.regexp_extract_all(markup, F.lit(ANCHOR), F.lit(0)), " ")
    return F.when(F.contains(F.lower(markup), F.lit("<a")), _words(linked)).otherwise(0)


def main_content(html: Column) -> Column:
    """Article blocks of a page as ``<p>`` elements, '' when none qualifies.

    Shallow text features (Kohlschuetter, Fankhauser, Nejdl: Boilerplate Detection using
    Shallow Text Features, WSDM 2010): a block counts by its own and its neighbours' word
    number and link density.
    """
    body = bind(F.regexp_replace(html, UNSEEN_OR_TITLE, ""), page_body)
    blocks = F.filter(
        F.transform(
            F.split(body, BLOCK_TAG),
            lambda markup: F.struct(
                strip_space(markup).alias("markup"),
                _words(markup).alias("n"),
                _linked_words(markup).alias("linked"),
            ),
        ),
        lambda block: block["n"] > 0,
    )

    def is_content(rows: Column, row: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get(rows, i - 1))
        after = F.get(rows, i + 1)
        before_words = F.coalesce(before["n"], F.lit(0))
        after_words = F.coalesce(after["n"], F.lit(0))
        # density <= 1/3 and <= 5/9, in whole numbers
        own_ok = row["linked"] * 3 <= row["n"]
        before_ok = F.coalesce(before["linked"] * 9 <= before["n"] * 5, F.lit(True))
        return own_ok & F.when(
            before_ok, (row["n"] > 16) | (after_words > 15) | (before_words > 4)
        ).otherwise((row["n"] > 40) | (after_words > 17))

    kept = bind(
        blocks, lambda rows: F.filter(rows, lambda row, i: is_content(rows, row, i))
    )
    return F.array_join(
        F.transform(kept, lambda row: F.concat(F.lit("<p>"), row["markup"], F.lit("</p>"))), ""
    )


def simplified_page(html: Column) -> Column:
    """Main content under its title, '' when the page is NULL."""
    return F.coalesce(
        F.concat(
            F.lit("<h1><strong>"), title_text(html), F.lit("</strong></h1>"), main_content(html)
        ),
        F.lit(""),
    )
