"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickframe.llm import audit, chat, decontaminate, fingerprint, hyperminhash, jaccard, langid, licenses, lm, oracles, packing, secrets, sharding, spelling


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(_documents(spark, sf_dir))


def _remainder(n: int):
    """crc32 of the id as text modulo n (a null id: of the empty text)."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % n


def op2_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(_documents(spark, sf_dir), words=3, percent=90)


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_documents(spark, sf_dir))


def op5_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    model = lm.train(docs.filter(_remainder(5) != 1))
    return lm.score(docs, model).withColumn("held_out", _remainder(5) == 1)


def op6_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    held_out = _remainder(4) == 2
    model = langid.train(docs.filter(~held_out))
    return langid.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "entropy", "rejected")


def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    out = sharding.shard(_documents(spark, sf_dir).withColumn("text_crc32", crc), shards=40)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_documents(spark, sf_dir))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir)).drop("ids")


def op10_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = chat.preference_pairs(spark.read.parquet(f"{sf_dir}/conversations.parquet"))

    def written(mask: str):
        return F.concat_ws(",", F.transform(mask, lambda m: F.concat_ws(":", m["start"], m["end"]))).alias(mask)

    return chat.format_pairs(pairs).select("pair_id", "prompt_turns", "prompt", "chosen", "rejected", written("chosen_mask"), written("rejected_mask"))


def op11_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_duplicates(_documents(spark, sf_dir), words=4, percent=80)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(spark, f"{sf_dir}/documents.parquet", spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_documents(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op")}


def oracle_sql() -> dict[str, str]:
    """Where SQL can express a query; tests hold the others against brute force."""
    return {"op11_hyperminhash": oracles.OP11, "op3_jaccard": oracles.OP3, "op10_preferences": oracles.OP10, "op12_filter_audit": oracles.OP12}
