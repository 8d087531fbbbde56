"""The registered queries of this package: (spark, folder of the tables) to a DataFrame."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from streamweir.llm import chat, decontaminate, licenses, lm, mixing, phrases, pieces, quality, sharding, simhash, spelling, tokens, warc
from streamweir.llm.tables import Workspace


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    stored = Workspace(spark, "chat").keep(chat.formatted(given.union(more)))
    back = stored.select(
        "conv_id", F.length("formatted").cast("long").alias("formatted_chars"),
        chat.turns_of(F.col("formatted")).alias("turns"), chat.loss_text(F.col("formatted"), F.col("loss")).alias("loss"),
    )
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
    )


def op2_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    corpus = tokens.written(docs, lambda: tokens.word_encoder(path, "<u2"), "<u2", end_id=2)
    copy = F.row_number().over(Window.partitionBy("doc_id").orderBy("doc_id")) - 1
    keys = docs.select("doc_id", copy.alias("copy")).select("doc_id", tokens.key_hash(F.col("doc_id"), F.col("copy")).alias("key_hash"))
    rows = corpus.read(corpus.located(keys), "<u4")
    return rows.select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), F.col("n").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.licensed(docs, keep_text=False).select("doc_id", "license.*")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    rows = docs.select("doc_id", size.alias("size"), F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"), F.xxhash64("text").alias("key"))
    placed = sharding.sharded(rows, F.col("size"), key=F.col("key"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.leaks(docs, table(spark, sf_dir, "benchmark")).drop("row_key")


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lm.scored(table(spark, sf_dir, "documents").select("doc_id", "text"))
    per_word = F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words"))
    return rows.select(
        "doc_id", "n_words", "backed_off", F.round("log_score", 4).alias("log_score"), F.round(F.exp(-per_word), 4).alias("perplexity"),
    )


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mix = F.col("mix")
    return mixing.mixed(docs, keep_text=False).select("doc_id", *[mix[c].alias(c) for c in ("size", "source_size", "target", "taken")])


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "warc")
    captures = warc.archived(table(spark, sf_dir, "pages").select("page_id", "url", "html"), work)
    index = work.keep(warc.merged(captures))
    records = warc.read_back(index, work, with_payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.judged(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)
    m = F.col("measures")
    return rows.select(
        "doc_id", *[m[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")],
        F.col("verdict.kept").alias("kept"), F.round("verdict.probability", 6).alias("probability"),
    )


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.simhash_components(docs)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents").select("text", "lang"))


def op13_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = pieces.encoded(table(spark, sf_dir, "documents").select("doc_id", "text"), path, keep_text=False, decode=True)
    return rows.select(
        "doc_id", F.floor(F.octet_length("ids") / 4).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_chat_formatting": op1_chat_formatting,
    "op2_token_output": op2_token_output,
    "op3_license_scan": op3_license_scan,
    "op4_sharding": op4_sharding,
    "op5_decontamination": op5_decontamination,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_mixing": op7_mixing,
    "op8_warc": op8_warc,
    "op9_quality_rules": op9_quality_rules,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_collocations": op12_collocations,
    "op13_piece_encoding": op13_piece_encoding,
}
