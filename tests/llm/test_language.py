import random
import zlib

import pytest
from pyspark.sql import functions as F

from docweave.llm import language as L
from docweave.llm.queries import op10_language_id

SYLLABLES = {"aa": ["ka", "to", "mi"], "bb": ["str", "ung", "sch"], "cc": ["eau", "oux", "ée"]}


def make(rng, lang, words):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(6)
    rows = [(i, make(rng, lang, rng.randint(5, 60)), lang) for i in range(300) for lang in [rng.choice(list(SYLLABLES))]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_learned_languages_are_told_apart(spark, docs):
    model = L.learn(docs.filter(~L.held_out("doc_id")))
    got = L.identify(docs.filter(L.held_out("doc_id")), model).collect()
    assert got and sum(r.lang == r.lang_pred for r in got) >= 0.95 * len(got)
    assert all(0 <= r.score <= 1 for r in got)
    # Unseen words are told by their n-grams; seen words by themselves.
    new = spark.createDataFrame([("schungungungstr",), ("KATOMIKATOMIKA",)], "text string")
    assert [r.lang_pred for r in L.identify(new, model).collect()] == ["bb", "aa"]
    assert "ka" in model.rows and model.evidence("ka") == [model.rows["ka"]]
    assert len(model.evidence("zzka")) >= 1


def test_defined_cases(spark, docs):
    model = L.learn(docs)
    rows = [(1, None), (2, ""), (3, "123 ... 4"), (4, "ka " * 50_000), (4, "ka"), (None, "str")]
    frame = spark.createDataFrame([(i, t, "x", 5) for i, t in rows], "doc_id long, text string, score string, lang_pred int")
    got = [(r.lang_pred, r.score > 0) for r in L.identify(frame, model).collect()]
    assert got == [("und", False)] * 3 + [("aa", True), ("aa", True), ("bb", True)]
    assert L.identify(frame.limit(0), model).count() == 0
    none = L.learn(docs.limit(0))
    assert {r.lang_pred for r in L.identify(frame, none).collect()} == {"und"}
    nulls = L.learn(docs.withColumn("lang", F.lit(None).cast("string")))
    assert nulls.languages == []


def test_bounds_hold(docs):
    model = L.learn(docs, rows_per_language=5, max_languages=2, max_entries=60)
    assert len(model.languages) == 2 and len(model.rows) <= 60


def test_held_out_rule(spark):
    got = spark.range(200).select("id", L.held_out("id").alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in got)


def test_query_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    got = op10_language_id(spark, folder).join(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang"), "doc_id")
    right, total = got.filter("held_out AND lang IS NOT NULL").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert total > 100 and right >= 0.98
