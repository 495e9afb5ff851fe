"""The registered queries of this package: every operator over its whole table, and the same in SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.llm import additive, anchors, decontamination, jaccard, language, lines, middle, packing, quality, quotes, repair, sharding, suffixes, texts
from docflow.session import write_once


def op1_best_fit_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.best_fit_shards(texts.documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op2_segment_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_classes(texts.documents(spark, sf_dir))


def op3_hierarchical_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts.documents(spark, sf_dir).withColumn("held_out", language.held_out(F.col("doc_id")))
    model = language.fit(docs.filter("not held_out"), "text", "lang")
    found = language.identify(docs.select("doc_id", "held_out", "text"), model)
    return found.select("doc_id", "held_out", F.col("language.prediction").alias("lang_pred"), "language.score")


def op4_suffix_array_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_matches(
        texts.documents(spark, sf_dir).select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    )
    c = F.col("contamination")
    return found.select(
        "doc_id", c["n_words"].alias("n_words"), c["n_hit"].alias("n_hit"), F.size(c["items"]).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", c["items"]), 256).alias("items_sha256"), (c["n_hit"] > 0).alias("contaminated"),
    )


def op5_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = packing.pack(texts.documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
        "segment", "loss_tokens",
    )


def op6_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quotes.linked(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return found.select(
        F.col("conv").alias("conv_id"), "turn", "role", "parent_turn", "root_turn", "depth", "position", "n_quoted", "n_linked",
        F.sha2("body", 256).alias("body_sha256"),
    )


def op7_heavy_light_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_groups(texts.documents(spark, sf_dir))


def op8_suffix_family_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = suffixes.earlier_spans(texts.documents(spark, sf_dir))
    return spans.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op9_line_first_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.clean_lines(texts.documents(spark, sf_dir).select("doc_id", "text"))
    q = F.col("quality")
    return judged.select(
        "doc_id", *(q[c].alias(c) for c in (
            "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_failed_lines", "kept_chars",
            "base_failed", "kept",
        )), F.sha2(q["clean_text"], 256).alias("clean_sha256"),
    )


def op10_fixed_block_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = anchors.repeated_spans(texts.documents(spark, sf_dir))
    return spans.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"), F.size("spans").cast("long").alias("n_spans"))


def op11_additive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts.documents(spark, sf_dir).select("doc_id", additive.held_out(F.col("doc_id")).alias("held_out"), F.xxhash64("text").alias("same"), "text")
    seen = write_once(additive.describe(docs).drop("text"), "described")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    model = additive.fit(seen.filter("not held_out").join(labels, "doc_id"), "described", "quality", "same")
    scored = additive.score(seen, model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op12_seekable_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = write_once(middle.framed(texts.documents(spark, sf_dir).select("doc_id", "text")), "frames")
    m = F.col("middle")
    return middle.fill_in_middle(stored, middle.draws(F.col("doc_id"))).select(
        "doc_id", m["n"].alias("n"), m["form"].alias("form"), m["prefix_chars"].alias("prefix_chars"), m["middle_chars"].alias("middle_chars"),
        middle.digest(m["output"]).alias("output_sha256"), middle.digest(middle.restored(m["output"], m["form"])).alias("restored_sha256"),
    )


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    rows = repair.damaged(given)
    done = write_once(repair.repairs(rows), "repairs")
    kept = write_once(repair.digests(repair.repaired(rows, done)), "digests")
    a, b, c = given.select("conv_id").distinct().alias("a"), done.alias("b"), kept.alias("c")
    all_of = a.join(b, F.col("conv_id").eqNullSafe(F.col("b.conv")), "left").join(c, F.col("conv_id").eqNullSafe(F.col("c.conv")), "left")
    counts = [F.coalesce(f"b.{x}", F.lit(0)).cast("long").alias(x) for x in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return all_of.select(
        "conv_id", *counts, F.coalesce("b.audit", F.lit("")).alias("audit"), F.coalesce("c.sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    )


QUERIES = {
    "op10_fixed_block_anchors": op10_fixed_block_anchors,
    "op11_additive_quality": op11_additive_quality,
    "op12_seekable_fill_in_middle": op12_seekable_fill_in_middle,
    "op13_conversation_repair": op13_conversation_repair,
    "op1_best_fit_sharding": op1_best_fit_sharding,
    "op2_segment_line_dedup": op2_segment_line_dedup,
    "op3_hierarchical_language_id": op3_hierarchical_language_id,
    "op4_suffix_array_decontamination": op4_suffix_array_decontamination,
    "op5_vector_packing": op5_vector_packing,
    "op6_quotation_linking": op6_quotation_linking,
    "op7_heavy_light_jaccard": op7_heavy_light_jaccard,
    "op8_suffix_family_dedup": op8_suffix_family_dedup,
    "op9_line_first_quality": op9_line_first_quality,
}
