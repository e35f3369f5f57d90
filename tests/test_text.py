"""Text expressions on non-ASCII terms, ligatures, line ends and language names."""

import re
import unicodedata

from pyspark.sql import functions as F

from winnow.functions import text as tx
from winnow.functions.common import strip_space, unescape_entities

SAMPLES = [
    "sc 3sc sc3 SC. single crochet, Magic Ring; rnd٣ ٣sc esc sct st sts sl-st sl st slst",
    "hdc dc ch1ch2 rep row rows round inc. dec_ dec-é ésc scé ſc",
    "1sc2sc3 row\nrow\tch, ch",
    "",
    "no hits here but echo",
    "ROW " * 50,
]


def test_term_count_equals_unicode_matching(evaluate):
    pattern = re.compile(tx.TERMS, re.I | re.M)
    expected = [len(pattern.findall(s)) for s in SAMPLES]
    assert evaluate(tx.term_count, SAMPLES) == expected


def test_term_pattern_is_a_parameter(evaluate):
    assert evaluate(lambda c: tx.term_count(c, r"\bknit\b"), ["knit KNIT knitted"]) == [2]


def test_strip_covers_all_white_space(evaluate):
    texts = ["  \x1c a b \x85　", "x", " \n ", ""]
    assert evaluate(strip_space, texts) == [t.strip() for t in texts]


def clean_page_rule(text):
    text = unicodedata.normalize("NFKC", text.strip())
    return re.sub(r"(?:[ ]*\n[ ]*){2,}", "\n\n", text)


def clean_post_rule(text):
    text = re.sub(r" {2,}", " ", text.strip())
    return re.sub(r" ?\n ?", "\n", text).replace("\n", "\\n")


TEXTS = [
    " a  \n  \n b\nc ", "ﬁne ①\n\n\n\nx", "a \n b", "a   \n\n", "\t a\n \n \n b   c", "a\\nb \n c",
    "a \n  x\n y  \n\n z",
]


def test_clean_up_rules(evaluate):
    assert evaluate(tx.clean_page_text, TEXTS) == [clean_page_rule(t) for t in TEXTS]
    assert evaluate(tx.clean_post_text, TEXTS) == [clean_post_rule(t) for t in TEXTS]


def test_long_runs_stay_cheap(evaluate):
    texts = [" " * 200_000 + "x" + " " * 200_000 + "y", "x" + "\n" * 200_000 + "y"]
    assert evaluate(tx.clean_page_text, texts) == [clean_page_rule(t) for t in texts]


def test_entities_are_decoded_once(evaluate):
    texts = ["&amp;lt; &amp; &lt;b&gt; &eacute;&#33;&hellip;&apos;", "&amp;amp;", "a & b", "none"]
    expected = ["&lt; & <b> é!…'", "&amp;", "a & b", "none"]
    assert evaluate(unescape_entities, texts) == expected


def test_languages(spark):
    rows = [
        ("Frenchy and GERMAN, french", ["korean", "Thai", "German", "Thai"]),
        (None, ["Hindi", "x"]),
        ("nothing", None),
        ("Danish then english then Daniſh", []),
    ]
    frame = spark.createDataFrame(rows, "t string, tags array<string>")
    found = [r.l for r in frame.select(tx.languages(F.col("t"), F.col("tags")).alias("l")).collect()]
    assert found[:3] == [["French", "German", "Thai"], ["Hindi"], []]
    assert found[3][:2] == ["Danish", "English"]


def test_titles(evaluate):
    fast = lambda c: tx.page_title(c, "fast")
    assert evaluate(fast, ["<title>a</title>b</title> c", "none", "<title>a\nb</title>"]) == [
        "a</title>b", "", "",
    ]
    marked = lambda c: tx.page_title(c, "markdown")
    assert evaluate(marked, ["# **A** x\ny", "x\n# **A**", "# **A** **B**"]) == ["A", "", "A** **B"]


def test_post_id_grows_beyond_five_digits(spark):
    rows = spark.createDataFrame([(7,), (123456,)], "n long").select(
        tx.post_id(F.col("n")).alias("p")
    )
    assert sorted(r.p for r in rows.collect()) == ["00007", "123456"]


def test_export_name(evaluate):
    name = lambda c: tx.export_name(F.lit(3), F.lit(9), c, "md")
    assert evaluate(name, ["  A bear,  (free) pattern by me", "é"]) == [
        "3_9_A_bear_free_pattern.md", "3_9_.md",
    ]
