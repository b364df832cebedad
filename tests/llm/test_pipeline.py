import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"


def test_every_operator_has_its_query():
    names = {n.split("_")[0] for n in contract.queries() if n.startswith("op")}
    assert names == {f"op{k}" for k in range(1, 14)} and "pipeline" in contract.queries()


def test_stages_keep_the_columns_and_clean_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    left, columns = {}, docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER).cache()
        left[name] = docs.count()
        assert name == "pieces" or docs.columns == columns
    assert left["language"] >= 0.95 * spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert docs.where("NOT round_trip").count() == 0
    assert corpus_pipeline.run(spark, FOLDER).count() == left["pieces"]


CLASHING = {"score": 7.5, "size": -1, "weight": "w", "u": "x", "copy": 3, "copies": -2, "target": "t", "source_size": "s", "n_lines": 9,
            "n_gone": 8, "lang_pred": "keepme", "p_rest": "p", "m_key": 5, "a b.c": "dots"}
ROWS = [
    (1, "the cat sat on the mat and the dog ran off\nthe end of it", "en", "a"), (2, "the cat sat on the mat and the dog ran off", "en", "a"),
    (3, None, None, None), (4, "", "en", "b"), (5, "12 34 !!", None, "b"), (None, "the last of all the words in that place", "en", None),
    (6, "le chat est sur la table et le chien est dans la maison", "fr", "b"), (7, "\n \n", "fr", "b"),
    (8, "the cat sat on the mat and the dog ran off\nthe end of it", "en", "a"), (8, "the cat sat on the mat and the dog ran off\nthe end of it", "en", "a"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def odd_documents(make, rows):
    docs = make([(*r, len(r[1] or "")) for r in rows], SCHEMA)
    return docs.withColumns({name: F.lit(value) for name, value in CLASHING.items()})


@pytest.mark.parametrize("name", ["language", "lines", "near_duplicates", "mix"])
def test_stages_leave_foreign_columns_alone_and_take_odd_rows(spark, make, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = odd_documents(make, ROWS)
    left = stage(spark, docs, FOLDER)
    assert left.dtypes == docs.dtypes
    rows = left.collect()
    assert rows and all(r[c] == value for r in rows for c, value in CLASHING.items())
    kept = sorted((r["doc_id"] for r in rows), key=str)
    if name == "language":
        assert {r["lang"] for r in rows} == {"en", "fr"} and not {3, 4, 5, 7} & set(kept) and kept.count(8) == 2
    if name == "lines":
        assert kept == [1, 5, 6, None]
    if name == "near_duplicates":
        assert kept.count(8) == 0 and {1, 3, 4, 6, 7, None} <= set(kept)
    if name == "mix":
        assert all(kept.count(k) <= 4 for k in kept) and not {3, 4, 7} & set(kept)
    assert stage(spark, odd_documents(make, []), FOLDER).count() == 0
