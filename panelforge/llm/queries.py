"""The queries of this subpackage, one for each operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle
from .common import table, written


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_rules import quality_rules

    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text")).select(*names)


def op1_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_model import fit_quality, quality_scores

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_scores(docs, fit_quality(docs, table(spark, sf_dir, "labels")))


def op2_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import interleaved_shards

    text = F.coalesce(F.col("text"), F.lit(""))
    size, crc = (F.octet_length(text) + 1).cast("long"), F.crc32(text.cast("binary"))
    found = interleaved_shards(table(spark, sf_dir, "documents"))
    return found.select("doc_id", size.alias("size"), crc.alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat import rotated

    spans = F.array_join(F.transform("spans", lambda x: F.concat_ws("-", x["start"].cast("string"), x["end"].cast("string"))), ",")
    return rotated(table(spark, sf_dir, "conversations")).withColumn("spans", spans)


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near_duplicates import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op5_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pseudo_likelihood import trained_and_scored

    return trained_and_scored(table(spark, sf_dir, "documents"))


def op6_byte_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .byte_tokens import encoded

    return encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op7_audio_prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recordings are the vectors of embeddings, played as notes inside the task; no sound is kept."""
    from .audio_prints import fingerprints, played, recording_classes, sound_of

    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    prints = fingerprints(vectors, "vec_id", "embedding", lambda vector: sound_of(played(vector)))
    return recording_classes(prints).withColumnRenamed("media_id", "vec_id")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import calibrated, fit_toxicity, toxicity_logits, toxicity_scores

    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    model = fit_toxicity(docs, labels)
    logits = written(toxicity_logits(docs, model))
    return toxicity_scores(logits, calibrated(model, logits, labels))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .packing import packed

    return packed(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_prefix_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .prefix_tokens import encoded

    return encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lexical_search import ranked_search

    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .collocations import collocations

    return collocations(table(spark, sf_dir, "documents"))


QUERIES = {"op7_audio_prints": op7_audio_prints, "op3_perspectives": op3_perspectives, "op5_pseudo_likelihood": op5_pseudo_likelihood, "op6_byte_tokens": op6_byte_tokens, "op2_interleaved_shards": op2_interleaved_shards, "op10_packing": op10_packing, "op1_quality_model": op1_quality_model, "op4_near_duplicates": op4_near_duplicates, "op8_toxicity": op8_toxicity, "op9_quality_rules": op9_quality_rules, "op11_prefix_tokens": op11_prefix_tokens, "op12_lexical_search": op12_lexical_search, "op13_collocations": op13_collocations}
ORACLE_SQL = {"op3_perspectives": oracle.CHAT, "op2_interleaved_shards": oracle.SHARDING, "op4_near_duplicates": oracle.NEAR_DUPLICATES, "op9_quality_rules": oracle.QUALITY_RULES, "op12_lexical_search": oracle.LEXICAL_SEARCH, "op13_collocations": oracle.COLLOCATIONS}
