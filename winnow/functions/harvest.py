"""Posts of a blog listing page, as an Arrow column function."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from winnow.functions.markup import Tree
from winnow.schemas import POST

# --- fixed values: class names of the blog layout, replaceable by parameters ---
LAYOUT = {
    "posts": "blog-posts",
    "post": "post",
    "date": "date-header",
    "title": "post-title",
    "body": "post-body",
    "footer": "post-footer",
    "labels": "post-labels",
    "separator": "separator",
    "older": "Older Posts",
}
# ------------------------------------------------------------------------------

HARVESTED = T.StructType(
    [
        T.StructField(
            "posts",
            T.ArrayType(
                T.StructType([T.StructField("post", POST), T.StructField("error", T.StringType())])
            ),
        ),
        T.StructField("next_page", T.StringType()),
    ]
)

_STRINGS = pa.list_(pa.string())
_ITEM = pa.struct(
    {
        "img_link": pa.string(),
        "img_attrs": pa.map_(pa.string(), pa.string()),
        "text_link": pa.string(),
        "text_desc": pa.string(),
    }
)
_POST = pa.struct(
    {
        "post_date": pa.string(),
        "header": pa.struct({"title_text": pa.string(), "title_link": pa.string()}),
        "body": pa.struct(
            {
                "parsed": pa.list_(_ITEM),
                "raw_links": _STRINGS,
                "raw_images": _STRINGS,
                "raw_text": pa.string(),
            }
        ),
        "footer": pa.list_(pa.struct({"tag": pa.string(), "taglink": pa.string()})),
    }
)
_HARVESTED = pa.struct(
    {"posts": pa.list_(pa.struct({"post": _POST, "error": pa.string()})), "next_page": pa.string()}
)


def _has_class(node, name):
    return name in node.attrs.get("class", "").split()


class _Listing(Tree):
    """Tree that knows the slice of ``elements`` below each element."""

    def __init__(self, page):
        super().__init__(page)
        self.start = {id(e): i for i, e in enumerate(self.elements)}
        self.end = {id(e): i + 1 for i, e in enumerate(self.elements)}
        for e in reversed(self.elements):
            above = id(e.parent)
            self.end[above] = max(self.end.get(above, 0), self.end[id(e)])

    def below(self, top, test):
        inside = self.elements[self.start[id(top)] + 1 : self.end[id(top)]]
        return [e for e in inside if e.fate is None and test(e)]


def _text(node, joint=""):
    return joint.join(node.strings())


def _local_text(anchor):
    """Anchor text with the text right before and after it."""
    kids = list(anchor.live_parent().live_kids())
    at = next(i for i, kid in enumerate(kids) if kid is anchor)
    before, after = [], []
    i = at - 1
    while i >= 0 and isinstance(kids[i], str):
        before.append(kids[i])
        i -= 1
    i = at + 1
    while i < len(kids) and isinstance(kids[i], str):
        after.append(kids[i])
        i += 1
    whole = "".join(before) + _text(anchor, " ") + "".join(after)
    return whole.replace("\n", "").replace("\xa0", "")


def _read_body(tree, body, layout):
    for node in tree.below(
        body, lambda e: e.name == "div" and _has_class(e, layout["separator"])
    ):
        node.fate = "unwrap"
    inside = tree.below(body, lambda e: e.name in ("a", "img"))
    links = [e for e in inside if e.name == "a"]
    pictures = [e for e in inside if e.name == "img"]
    later = [e for e in tree.elements[tree.start[id(body)] :] if e.name == "a"]
    holders = {id(a): None for a in links}
    for picture in pictures:
        above = picture.parent
        while above is not None:
            if id(above) in holders and holders[id(above)] is None:
                holders[id(above)] = picture
            above = above.parent
    parsed = []
    for i, anchor in enumerate(later):
        picture = holders.get(id(anchor))
        if picture is not None:
            worded = next(a for a in later[i + 1 :] if a.lone_string())
            parsed.append(
                {
                    "img_link": anchor.attrs["href"],
                    "img_attrs": list(picture.attrs.items()),
                    "text_link": worded.attrs["href"],
                    "text_desc": _local_text(worded),
                }
            )
    return {
        "parsed": parsed,
        "raw_links": list(dict.fromkeys(a.attrs.get("href", "") for a in links)),
        "raw_images": list(dict.fromkeys(p.attrs.get("src", "") for p in pictures)),
        "raw_text": _text(body, " "),
    }


def _read_post(tree, post, layout):
    start = tree.start[id(post)]
    date = next(e for e in tree.elements[start - 1 :: -1] if _has_class(e, layout["date"]))
    titles = tree.below(
        post, lambda e: e.name == "a" and _has_class(e.parent, layout["title"])
    )
    body = tree.below(post, lambda e: _has_class(e, layout["body"]))[0]
    footer = tree.below(post, lambda e: _has_class(e, layout["footer"]))[0]
    tags = tree.below(
        footer, lambda e: e.name == "a" and _has_class(e.parent, layout["labels"])
    )
    return {
        "post_date": _text(date),
        "header": {
            "title_text": _text(titles[0]) if titles else "",
            "title_link": titles[0].attrs["href"] if titles else "",
        },
        "body": _read_body(tree, body, layout),
        "footer": [{"tag": _text(t), "taglink": t.attrs["href"]} for t in tags],
    }


def read_listing(page, layout):
    """``{posts: [{post, error}], next_page}`` of one listing page."""
    tree = _Listing(page or "")
    found = [
        e
        for top in tree.elements
        if top.name == "div" and _has_class(top, layout["posts"])
        for e in tree.below(top, lambda e: e.name == "div" and _has_class(e, layout["post"]))
    ]
    older = [e for e in tree.elements if e.name == "a" and e.lone_string() == layout["older"]]
    rows = []
    for post in found:
        try:
            rows.append({"post": _read_post(tree, post, layout), "error": None})
        except (IndexError, KeyError, StopIteration) as failure:
            rows.append({"post": None, "error": type(failure).__name__})
    return {"posts": rows, "next_page": older[0].attrs.get("href") if older else None}


def harvest_posts(pages: DataFrame, layout: dict[str, str] | None = None) -> DataFrame:
    """Listing pages ``(page_idx, url, html)`` as nested post pages.

    Posts that lack a required part stand in ``failed`` (their place and the reason); they
    count in ``num_posts`` but not in ``page_data``.
    """
    names = {**LAYOUT, **(layout or {})}

    @F.arrow_udf(HARVESTED)
    def listing(htmls: pa.Array) -> pa.Array:
        return pa.array([read_listing(page, names) for page in htmls.to_pylist()], _HARVESTED)

    read = pages.withColumn("_read", listing("html"))
    rows = F.col("_read.posts")
    return read.select(
        "page_idx",
        "url",
        F.transform(
            F.filter(rows, lambda row: row["error"].isNull()), lambda row: row["post"]
        ).alias("page_data"),
        F.size(rows).alias("num_posts"),
        F.col("_read.next_page").alias("next_page"),
        F.filter(
            F.transform(
                rows, lambda row, i: F.struct(i.alias("post_idx"), row["error"].alias("error"))
            ),
            lambda row: row["error"].isNotNull(),
        ).alias("failed"),
    )
