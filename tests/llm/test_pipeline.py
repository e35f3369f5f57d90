"""The pipeline: every stage on its own input against plain Python."""

import hashlib
import os
import re

import duckdb
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from tests.llm.cases import SF, documents, odd_docs
from tests.llm.test_dedup import plain_components, plain_leaks, plain_print
from winnow.llm import secret_scan
from winnow.llm.common import store, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark):
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = [(100_001, None), (100_002, "123 456"), (100_003, documents()[0][1])]
    docs = docs.unionByName(
        spark.createDataFrame(extra, "doc_id long, text string"), allowMissingColumns=True
    )
    before = {r.doc_id: r for r in docs.collect()}
    for k, (name, stage) in enumerate(pipeline.STAGES):
        result = store(stage(spark, docs, SF), name)
        rows = {r.doc_id: r for r in result.collect()}
        if k < 4:
            assert result.columns == COLUMNS
        if name == "language_id":
            assert set(before) - set(rows) == {100_001, 100_002}
            assert rows[100_003].lang == before[documents()[0][0]].lang
        elif name == "simhash_dedup":
            ids = sorted(before)
            parent = plain_components([plain_print(before[i].text) for i in ids])
            assert set(rows) == {i for n, i in enumerate(ids) if parent[n] == n}
        elif name == "decontaminate":
            gone = set(before) - set(rows)
            some = sorted(before)[::5]
            assert all(plain_leaks(before[i].text, items) for i in gone)
            assert not [i for i in some if i in rows and plain_leaks(before[i].text, items)]
        elif name == "secret_scan":
            assert set(rows) == set(before)
            for i, r in rows.items():
                spans = secret_scan.scan(before[i].text)
                assert r.text == secret_scan.redact(before[i].text, spans)
                assert r.n_chars == len(r.text)
                assert not re.search("AKIA[A-Z0-9]{16}", r.text)
        else:
            model = sentencepiece.SentencePieceProcessor(
                model_file=public_tokenizers.path("piece_bpe_32k.model")
            )
            assert set(rows) == set(before)
            for i, r in rows.items():
                assert r.ids == model.encode(before[i].text)
                assert r.decoded_sha256 == hashlib.sha256(before[i].text.encode()).hexdigest()
        docs, before = result, rows


def test_run(spark):
    with written() as made:
        rows = pipeline.run(spark, SF).collect()
    assert rows and len({r.doc_id for r in rows}) == len(rows)
    # Of the stages but the last, only what the last one reads is still there.
    names = {name for name, _ in pipeline.STAGES[:-1]}
    stages = [path for path in made if os.path.basename(path).rpartition("-")[0] in names]
    assert len(stages) == 4 and [os.path.exists(path) for path in stages] == [False] * 3 + [True]
    own = made[: made.index(stages[-1])]
    assert len(own) > 3 and not any(os.path.exists(path) for path in own)


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("false")
    for name, stage in pipeline.STAGES:
        docs = store(stage(spark, docs, SF), name)
        assert docs.count() == 0


def test_without_languages(spark):
    docs = spark.createDataFrame(
        [(1, "a text"), (2, "12"), (3, None)], "doc_id long, text string"
    ).withColumns({"lang": F.lit(None).cast("string"), "source": F.lit("s"), "n_chars": F.lit(1)})
    kept = pipeline.identify_language(spark, docs, SF)
    assert [r.doc_id for r in kept.collect()] == [1]


def test_odd_rows_and_names_of_temporary_columns(spark):
    """Every stage keeps the columns it is given, those called like its own temporary ones too."""
    names = ["_text", "_lang", "_score", "_leaks", "_leaks_0", "_redacted", "_text_hash", "_ROW"]
    docs = odd_docs(spark).withColumns(
        {"lang": F.lit("en"), "source": F.lit(None).cast("string"), "n_chars": F.length("text")}
        | {name: F.concat(F.lit(name), F.coalesce("doc_id", F.lit(-1))) for name in names}
    )
    for name, stage in pipeline.STAGES:
        given = docs.columns
        docs = store(stage(spark, docs, SF), name)
        rows = docs.collect()
        if name == "sentencepiece":
            break
        assert docs.columns == given
        assert all(r[n] == f"{n}{-1 if r.doc_id is None else r.doc_id}" for r in rows for n in names)
        ids = sorted(r.doc_id or 0 for r in rows)
        if name == "language_id":
            assert not {4, 5, 6, 9} & set(ids) and {1, 2, 3, 7, 10, 16} <= set(ids)
        if name == "simhash_dedup":
            assert ids.count(1) == 1 and not {2, 3} & set(ids)
        if name == "secret_scan":
            assert next(r.text for r in rows if r.doc_id == 15) != odd_docs(spark).filter("doc_id = 15").first().text
    assert rows
