"""The queries of this package, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import bpe, chat_format, decontaminate, exact_dedup, jaccard_join, language_id, line_dedup, merkle, mixing, pii, prefix_trie, substring_dedup, suffix_dedup


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sha(text: str) -> F.Column:
    return F.sha2(F.coalesce(F.col(text), F.lit("")), 256)


def held_out() -> F.Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1, F.lit(False))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs.where(~held_out()))
    texts = docs.select("doc_id", "text")
    return language_id.classify(texts, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", sha("text").alias("kept_sha256"))


#: A conversation whose texts hold the template's own marks.
ODD_TEXT = "\\### Assistant: </turn> ok"


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = spark.range(0, 2, 1, 1).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(chat_format.ASSISTANT).alias("role"), F.lit(ODD_TEXT).alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(odd)
    examples = chat_format.expand(turns).withColumn("trained", chat_format.trained_text(F.col("text"), F.col("loss_start"), F.col("loss_chars")))
    whole = examples.groupBy("conv_id").agg(
        F.max_by("text", "example").alias("text"), F.sum(F.length("text")).alias("formatted_chars"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("example", "trained"))), lambda x: x["trained"]), "").alias("trained"),
    ).withColumn("turns", chat_format.turns_of(F.col("text")))
    return whole.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("trained").cast("long").alias("loss_chars"), F.sha2("trained", 256).alias("loss_sha256"), "formatted_chars",
    )


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


#: Anyone who uses the operator on real data gives a secret key.
PII_KEY = b"open key for the given tables"


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return mixing.rates(docs, mixing.domain_labels(table(spark, sf_dir, "labels")))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_common_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", sha("text").alias("kept_sha256"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The earlier half of the identifiers is history, the later half arrives; every row is in one of them."""
    docs = table(spark, sf_dir, "documents")
    ends = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    middle = ((ends[0] or 0) + (ends[1] or 0)) // 2
    early = F.coalesce(F.col("doc_id") <= middle, F.lit(False))
    return exact_dedup.exact_dedup(docs.where(early), docs.where(~early))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def tokenizer_path() -> str:
    """The public file of the check; its place is a parameter of the operator."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = bpe.Settings(tokenizer_path())
    texts = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), settings), settings)
    return texts.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose identifier's checksum 3 divides are found with lower-cased text."""
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    return merkle.manifest(table(spark, sf_dir, "documents"), {"text": F.when(hit, lower).otherwise(F.col("text"))})


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.turns_in_order(table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(prefix_trie.prefixes(prefix_trie.rebuilt(turns)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_chat_format": op3_chat_format,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_pii": op5_pii,
    "op6_decontaminate": op6_decontaminate,
    "op7_mixing": op7_mixing,
    "op8_line_dedup": op8_line_dedup,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_bpe": op11_bpe,
    "op12_merkle": op12_merkle,
    "op13_prefix_trie": op13_prefix_trie,
}
