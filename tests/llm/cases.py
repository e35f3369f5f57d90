"""Odd rows that every operator must take: NULLs, empty and long texts, ties, repeats, odd columns."""

import duckdb

SF = "/root/testdata/sf0.001"
PLAIN = "the quick brown fox jumps over the lazy dog and runs far away from the old barn today"
ODD = [
    (1, PLAIN), (1, PLAIN), (2, PLAIN), (3, PLAIN.upper()), (4, None), (5, ""), (6, "  \n\t "),
    (7, "word"), (8, "a b"), (None, "text of a row without an id"), (None, None),
    (9, "12345 67890 !!!"), (10, "日本語 テキスト"), (11, "é ß ñ İ ſ \x00 \x1c \x85   🙂"),
    (12, "loop loop " * 4000), (13, "x" * 30_000), (14, "line of words\n" * 50),
    (15, 'password = "hunter2hunter2" AKIA' + "A" * 16 + " " + "0f" * 20),
    (16, "<|im_end|> <s> [secret] ▁▁ \\n"),
]
EXTRA = (
    "'x' AS score, 1 AS fp, 2 AS leaks, 'w' AS word, 3 AS bundle, 4 AS held_out, 'y' AS lang_pred, "
    "5 AS component_id, 6 AS ids, 7 AS shard, 8 AS start, 9 AS learned, 10 AS n, 'z' AS id"
)


def odd_docs(spark, partitions=3):
    """The odd rows with extra columns whose names the operators use themselves."""
    frame = spark.createDataFrame(ODD, "doc_id long, text string")
    return frame.selectExpr("*", *[part.strip() for part in EXTRA.split(",")]).repartition(partitions)


def empty_docs(spark):
    return odd_docs(spark).filter("false")


def documents():
    """Ids and texts of the smallest table, ordered by id."""
    return duckdb.sql(f"SELECT doc_id, text, lang FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()
