"""Small Column helpers shared by the expression modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: Unicode white space and the four information separators ----
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# ------------------------------------------------------------------------------


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it many times in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip_space(text: Column) -> Column:
    """Drop white space of any kind at both ends (plain ``trim`` only drops blanks)."""
    return F.btrim(text, F.lit(SPACE_CHARS))


def not_ascii(text: Column) -> Column:
    return F.octet_length(text) != F.length(text)


def unescape_entities(text: Column) -> Column:
    """Decode HTML character references inside the JVM; text without ``&`` is left alone."""

    def decoded(value: Column) -> Column:
        plain = F.java_method(
            F.lit("org.apache.commons.text.StringEscapeUtils"),
            F.lit("unescapeHtml4"),
            F.replace(value, F.lit("&apos;"), F.lit("'")),
        )
        # Text whose only references are &amp; (most of them) needs no decoder.
        others = F.contains(F.replace(value, F.lit("&amp;"), F.lit("")), F.lit("&"))
        return F.when(others, plain).otherwise(F.replace(value, F.lit("&amp;"), F.lit("&")))

    return bind(text, decoded)


def nfkc(text: Column) -> Column:
    """Unicode compatibility form inside the JVM; pure ASCII text is left alone."""

    def composed(value: Column) -> Column:
        whole = F.java_method(
            F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), value, F.lit(True)
        )
        return F.when(not_ascii(value), whole).otherwise(value)

    return bind(text, composed)
