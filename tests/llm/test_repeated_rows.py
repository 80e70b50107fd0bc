"""Repeated rows: the language sample and the blob ledger count them once."""

from pyspark.sql import functions as F

from inspecta.llm import language_id, secret_scan
from inspecta.session import scratch_dir
from tests.conftest import SF_SMOKE


def test_language_sample_counts_repeated_rows_once(spark):
    docs = spark.read.parquet(f"{SF_SMOKE}/documents.parquet")
    plain = language_id.fit(docs, fit_rows=20)
    one = language_id.learnable(docs, "doc_id", "text", "lang").orderBy("doc_id").limit(1).select("doc_id").first()[0]
    copies = docs.where(F.col("doc_id") == one).withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(999)))).drop("k")
    again = language_id.fit(docs.unionByName(copies), fit_rows=20)
    assert again.langs == plain.langs                     # as many centroids of each language
    held = docs.where("lang is not null")
    a, b = ({r.doc_id: r.lang_pred for r in language_id.predict(held, m).collect()} for m in (plain, again))
    assert sum(a[k] == b[k] for k in a) >= 0.95 * len(a)
    rows = language_id.learnable(docs.unionByName(copies), "doc_id", "text", "lang")
    some = language_id.first_by_hash(rows.select("doc_id", "lang").distinct(), "lang", "doc_id", 5)
    assert some.count() == some.distinct().count() and max(r["count"] for r in some.groupBy("lang").count().collect()) <= 5


def test_doubled_ledger_rows_count_once(spark):
    path = scratch_dir(spark, "ledger")
    docs = spark.createDataFrame([(1, "password = hunter22"), (2, "nothing"), (3, "password = hunter22"), (4, None)], "doc_id long, text string")
    first = secret_scan.digest_rows(secret_scan.find_secrets(spark, docs, path)).orderBy("doc_id").collect()
    rows = spark.read.schema(secret_scan.LEDGER).parquet(path)
    spark.createDataFrame(rows.collect(), secret_scan.LEDGER).write.mode("append").parquet(path)
    assert spark.read.parquet(path).count() == 6
    assert secret_scan.read_ledger(spark, path).count() == 3
    assert secret_scan.digest_rows(secret_scan.find_secrets(spark, docs, path)).orderBy("doc_id").collect() == first
    assert [r.n_assign for r in first] == [1, 0, 1, 0]


def test_only_texts_that_may_match_are_moved(spark):
    docs = spark.createDataFrame([(1, "password = hunter22"), (2, "nothing " * 9)], "blob string, text string")
    path = scratch_dir(spark, "ledger")
    got = {r.blob: len(r.spans) for r in secret_scan.update_ledger(spark, docs.withColumn("blob", secret_scan.blob_of(F.col("text"))), path).collect()}
    assert sorted(got.values()) == [0, 1]
