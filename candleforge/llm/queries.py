"""The registered queries of these operators, over whole tables of the test data."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candleforge import session
from candleforge.llm import (
    chat,
    decontaminate,
    divergence,
    importance,
    jaccard_join,
    language,
    merge_replay,
    quality_rules,
    secret_scan,
    simhash,
    token_files,
    toxicity,
    transducer,
)
from candleforge.llm.common import fold, table

TOKEN_LIMIT = 1024


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    first = ["doc_id", *quality_rules.COUNTS[:5], "base_failed", "kept", "anomaly"]
    return found.select(*first)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_files.round_trip(table(spark, sf_dir, "documents"), path)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").filter(fold("doc_id", 3) != 1)
    lexicon = toxicity.learn(docs, labels)
    scored = toxicity.scored(docs.select("doc_id", "text"), lexicon, "score")
    return scored.select(
        "doc_id",
        (fold("doc_id", 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs, secret_scan.cuts(docs))

    def shown(spans):
        texts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.array_join(texts, ",")

    base = F.filter("secrets", lambda s: s["kind"] != "random")
    kinds = F.col("secrets.kind")
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}")
        for kind in ("assign", "access", "hex")
    ]
    digest = F.sha2(shown(base), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, shown(F.col("secrets")).alias("spans"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = language.profiles(docs.filter(fold("doc_id", 5) != 0))
    found = language.identify(docs.select("doc_id", "text"), profiles)
    held_out = (fold("doc_id", 5) == 0).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", "score")


def op6_merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = merge_replay.encode(docs, path, public_tokenizers.PATTERN)
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.overlaps(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
        "longest_words",
    )


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-7).alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    extra = extra.select(*[F.col(f.name).cast(f.dataType) for f in given.schema])
    parsed = chat.parse(chat.render(given.unionByName(extra)))
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join("loss_texts", "")
    return parsed.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "valid_order",
    )


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = transducer.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))
    over = (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit")
    return found.select("doc_id", "n_bytes", "n_tokens", over)


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.join(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = importance.resample(docs, target)
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def _prepared(build):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(session.prepare(spark), sf_dir)

    return run


QUERIES = {
    build.__name__: _prepared(build)
    for build in (
        op1_quality_rules,
        op2_token_files,
        op3_toxicity,
        op4_secret_scan,
        op5_language,
        op6_merge_replay,
        op7_decontamination,
        op8_chat_format,
        op9_simhash,
        op10_token_counts,
        op11_divergence,
        op12_jaccard_join,
        op13_importance,
    )
}
