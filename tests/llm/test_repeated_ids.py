"""A doc_id on many rows counts once where classifiers are fitted."""

from __future__ import annotations

from pyspark.sql import functions as F

from candleforge.llm import quality_rules, toxicity


def test_training_rows_are_bounded_by_ids(spark):
    other = spark.range(1, 20).select("id", F.concat(F.lit("text "), "id").alias("text"))
    equal = spark.range(1_000).select(F.lit(0).cast("long").alias("id"), F.lit("again").alias("text"))
    mixed = spark.range(1_000).select(F.lit(0).cast("long").alias("id"), F.concat(F.lit("t"), "id").alias("text"))
    labels = spark.range(20).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("toxic"))
    for repeated in (equal, equal.unionByName(mixed)):
        docs = other.unionByName(repeated).withColumnRenamed("id", "doc_id")
        assert toxicity.training_rows(docs, labels).count() == 20


def test_forest_is_grown_on_bounded_rows(spark, monkeypatch):
    texts = spark.range(1_100).select(
        F.greatest(F.col("id") - 1_000, F.lit(0)).alias("doc_id"),
        F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(60)), lambda n: n * (F.col("id") % 90 + 3))).alias("text"),
    )
    labels = spark.range(100).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    seen = []
    shares = quality_rules.shares
    monkeypatch.setattr(quality_rules, "shares", lambda table: seen.append(len(table["n_words"])) or shares(table))
    stats = quality_rules.statistics(texts).persist()
    quality_rules.fit(stats, labels)
    assert seen[0] == 100
