"""Text expressions: clean-up, titles, term counts, languages, export names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from winnow.functions.common import bind, nfkc, not_ascii, strip_space

# --- fixed values: patterns and word lists that decide results ---------------
TERMS = (
    r"(?:\b|\d+)(sts?|ch|sl[ -]?st|inc|dec|sc|h?dc|rep|row|rnd|round)(?:\b|\d+)"
    r"|single crochet|magic ring"
)
# Every hit of TERMS begins with one of these; tested first, it spares most positions.
TERMS_START = r"(?=[\dcdhimrs])"
LANGUAGES = [
    "English", "Russian", "Spanish", "French", "German", "Japanese", "Turkish", "Persian",
    "Portuguese", "Italian", "Chinese", "Dutch", "Vietnamese", "Polish", "Arabic", "Korean",
    "Czech", "Indonesian", "Ukrainian", "Greek", "Hebrew", "Thai", "Swedish", "Romanian",
    "Hungarian", "Danish", "Finnish", "Slovak", "Bulgarian", "Serbian", "Norwegian", "Croatian",
    "Lithuanian", "Slovenian", "Norwegian", "Catalan", "Estonian", "Latvian", "Hindi",
]
MARKUP_TITLE = r"(?d)<title>(.+)</title>"
MARKDOWN_TITLE = r"(?d)^# [*]{2}(.+)[*]{2}"
# ------------------------------------------------------------------------------


def clean_post_text(text: Column) -> Column:
    """Strip, squeeze blanks, drop blanks around line ends, write line ends as ``\\n``."""
    squeezed = F.regexp_replace(strip_space(text), " {2,}", " ")
    tight = F.regexp_replace(squeezed, " ?\n ?", "\n")
    return F.replace(tight, F.lit("\n"), F.lit("\\n"))


def clean_page_text(text: Column) -> Column:
    """Strip, normalise to NFKC, and keep one empty line where there were more."""

    def spaced(value: Column) -> Column:
        lines = F.regexp_replace(value, r"\n[ \n]*\n *+", "\n\n")
        # Blanks before the first line end; the look-behind starts a run only once.
        lines = F.regexp_replace(lines, r" (?<!  ) *+\n\n", "\n\n")
        return F.when(F.rlike(value, F.lit(r"\n *\n")), lines).otherwise(value)

    return bind(nfkc(strip_space(text)), spaced)


def term_count(text: Column, pattern: str = TERMS) -> Column:
    """Non-overlapping hits, ignoring case, with Unicode word boundaries and digits."""
    start = TERMS_START if pattern == TERMS else ""
    # The ASCII matcher gives the same count on ASCII text and is the cheaper one.
    unicode_hits = F.regexp_count(text, F.lit(f"(?imuU){start}(?:{pattern})"))
    ascii_hits = F.regexp_count(text, F.lit(f"(?im){start}(?:{pattern})"))
    return F.when(not_ascii(text), unicode_hits).otherwise(ascii_hits)


def page_title(text: Column, mode: str) -> Column:
    """Title as the text extraction of ``mode`` left it; '' where there is none."""
    if mode == "markdown":
        return F.regexp_extract(text, MARKDOWN_TITLE, 1)
    if mode in ("fast", "reduce"):
        return F.regexp_extract(text, MARKUP_TITLE, 1)
    if mode == "remove":
        return F.lit("")
    raise ValueError(f"unknown mode: {mode}")


def languages(text: Column, tags: Column, names: list[str] | None = None) -> Column:
    """Language names found in the text (any case, inside words too), then among the tags."""
    names = list(dict.fromkeys(LANGUAGES if names is None else names))
    nothing = F.array().cast("array<string>")
    known = F.array(*[F.lit(name) for name in names])

    def found(value: Column) -> Column:
        # Plain searches tell which names can occur at all; the pattern holds only those.
        # The long s folds to s for the pattern, but not for lower().
        def possible(lowered: Column) -> Column:
            unsure = F.contains(lowered, F.lit("\u017f"))
            return F.filter(known, lambda name: unsure | F.contains(lowered, F.lower(name)))

        def hits(present: Column) -> Column:
            pattern = F.concat(F.lit("(?iu)("), F.array_join(present, "|"), F.lit(")"))
            return F.when(
                F.size(present) > 0, F.regexp_extract_all(value, pattern, F.lit(1))
            ).otherwise(nothing)

        return bind(bind(F.lower(value), possible), hits)

    in_tags = F.coalesce(F.array_intersect(tags, known), nothing)
    in_text = F.coalesce(bind(text, found), nothing)
    return F.array_distinct(F.transform(F.concat(in_text, in_tags), F.initcap))


def export_name(terms: Column, length: Column, title: Column, extension: str) -> Column:
    """``<terms>_<length>_<first four title words>.<extension>``."""
    plain = F.trim(F.regexp_replace(title, "[^a-zA-Z0-9 ]", ""))
    words = F.array_join(F.slice(F.split(plain, " +"), 1, 4), "_")
    return F.concat(
        terms.cast("string"), F.lit("_"), length.cast("string"), F.lit("_"), words,
        F.lit("." + extension),
    )


def post_id(number: Column) -> Column:
    """Running number with at least five digits; longer numbers keep all of theirs."""
    return F.format_string("%05d", number)
