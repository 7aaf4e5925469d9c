"""The registered queries of this package and their SQL, over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlens.llm import (chat, divergence, factorisation, hyperplanes, kneser_ney, lattice, line_dedup, mixing, partenum,
                           resampling, suffix_automaton, suffix_dedup, warc)
from urbanlens.llm.common import in_bucket, prepare, table
from urbanlens.llm.oracle import ORACLE_SQL

LABEL_FOLDS, LABEL_HELD = 4, 2
SCORE_FOLDS, SCORE_HELD = 5, 1
LANG_FOLDS, LANG_HELD = 5, 0


def _row(*names: str) -> list:
    return [F.col("row").getField(n).alias(n) for n in names]


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mixing.mix(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op2_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    held = in_bucket("doc_id", SCORE_FOLDS, SCORE_HELD)
    out = lattice.score_documents(table(spark, sf_dir, "documents"), ~held, keep=["doc_id"])
    return out.select(*_row("doc_id"), in_bucket("row.doc_id", SCORE_FOLDS, SCORE_HELD).alias("held_out"),
                      "n_tokens", "n_known", "train_tokens", "base_score", "score", "lattice_score")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    out = line_dedup.dedup_lines(docs, keep=["doc_id"])
    return out.select(*_row("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def quality_machine(spark: SparkSession, docs: DataFrame, sf_dir: str) -> factorisation.Machine | None:
    labels = table(spark, sf_dir, "labels").where(~in_bucket("doc_id", LABEL_FOLDS, LABEL_HELD))
    return factorisation.fit(docs, labels)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    out = factorisation.score(docs, quality_machine(spark, docs, sf_dir), keep=["doc_id"])
    return out.select(*_row("doc_id"), in_bucket("row.doc_id", LABEL_FOLDS, LABEL_HELD).alias("held_out"), "score",
                      (F.col("score") >= factorisation.THRESHOLD).cast("int").alias("predicted"))


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    out = partenum.similar_groups(table(spark, sf_dir, "documents"), size=4, part=85, of=100)
    return out.select(*_row("doc_id"), "n_shingles", F.col("component").alias("component_id"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    out = suffix_automaton.scan_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"),
                                          keep=["doc_id"])
    return out.select(*_row("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    records = chat.records_of(table(spark, sf_dir, "conversations"))
    control = "<|im_end|><|im_start|>assistant ok"
    # One more conversation, in another layout, whose texts hold control strings.
    more = spark.range(1).select(F.lit(-1).cast(records.schema["key"].dataType).alias("key"), F.to_json(F.struct(
        F.lit(control).alias("prompt"), F.lit(control).alias("response"))).alias("record"))
    out, other = (chat.format_records(r).select(F.col("row.key").alias("conv_id"), "mapping", "segments", "formatted")
                  for r in (records, more))
    out = out.unionByName(other)
    out = out.select("conv_id", "mapping", "formatted", chat.read_back(F.col("formatted")).alias("turns"),
                     chat.loss_text(F.col("segments")).alias("loss"))
    written = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(written, 256).alias("turns_sha256"),
                      F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                      F.length("formatted").cast("long").alias("formatted_chars"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    out = warc.archive(table(spark, sf_dir, "pages"))
    return out.select(F.col("id").alias("page_id"), F.col("n").alias("payload_bytes"),
                      F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), "refers_to")


def op10_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    out = hyperplanes.near_duplicates(table(spark, sf_dir, "embeddings"))
    return out.select(*_row("vec_id"), "n_links", F.col("component").alias("component_id"),
                      (F.col("row.vec_id") == F.col("component")).alias("kept"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    models = kneser_ney.fit(docs.where(~in_bucket("doc_id", LANG_FOLDS, LANG_HELD)))
    out = kneser_ney.identify(docs, models, keep=["doc_id"])
    return out.select(*_row("doc_id"), in_bucket("row.doc_id", LANG_FOLDS, LANG_HELD).alias("held_out"),
                      "lang_pred", "score", "cross_entropy", "rejected")


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    out = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return out.select(*_row("doc_id"), "n_features", "weight", "score", "rank")


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    out = suffix_dedup.dedup_passages(table(spark, sf_dir, "documents"), keep="none", columns=["doc_id"])
    return out.select(*_row("doc_id"), "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_lattice": op2_lattice,
    "op3_line_dedup": op3_line_dedup,
    "op4_quality": op4_quality,
    "op5_jaccard": op5_jaccard,
    "op6_decontamination": op6_decontamination,
    "op7_chat": op7_chat,
    "op8_warc": op8_warc,
    "op10_embeddings": op10_embeddings,
    "op9_language": op9_language,
    "op11_divergence": op11_divergence,
    "op12_resampling": op12_resampling,
    "op13_suffix_dedup": op13_suffix_dedup,
}

__all__ = ["ORACLE_SQL", "QUERIES"]
