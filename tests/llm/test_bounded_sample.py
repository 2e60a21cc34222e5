"""The rows that classifiers are fitted on: no label is lost, none has more than its share."""

from __future__ import annotations

from pyspark.sql import functions as F

from candleforge.llm.common import bounded_sample


def test_every_label_of_many_is_sampled(spark):
    small = spark.range(3_000).select("id", F.concat(F.lit("tag"), "id").alias("lang"))
    large = spark.range(10_000, 30_000).select("id", F.lit("en").alias("lang"))
    null = spark.range(50_000, 50_010).select("id", F.lit(None).cast("string").alias("lang"))
    rows = small.unionByName(large).unionByName(null).withColumnRenamed("id", "doc_id")
    found = bounded_sample(rows, "lang", 1_000)
    assert found.columns == rows.columns
    sizes = {r["lang"]: r["count"] for r in found.groupBy("lang").count().collect()}
    assert len(sizes) == 3_001 and None not in sizes
    assert all(n == 1 for lang, n in sizes.items() if lang != "en")
    assert 850 <= sizes["en"] <= 1_010
