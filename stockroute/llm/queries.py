"""The registered queries: each operator over its whole table, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (ann, bpe, fill_middle, html_extract, lexical, licenses, mixing, near_dedup, pii, quality, secret_scan,
               substring_dedup, url_filter)

#: The rules that the URL query is to judge by.
URL_RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]
RANKS = "byte_bpe_50k.tiktoken"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's url."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.url_filter(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal-data spans of every document."""
    found = table(spark, sf_dir, "documents").select("doc_id", pii.find_pii(F.col("text")).alias("found"))
    count = lambda kind: F.size(F.filter("found.base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(kind) for kind in pii.BASE],
                        F.sha2(secret_scan.as_text(F.col("found.base")), 256).alias("base_sha256"),
                        secret_scan.as_text(F.col("found.spans")).alias("spans"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", html_extract.extract_text(F.col("html")).alias("text"))
    return pages.withColumn("n_chars", F.length("text").cast("long"))


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document, on 2-word shingles."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """Digests of every document's token ids and of the bytes they decode to."""
    ranks = bpe.rank_file(spark, path or public_tokenizers.path(RANKS))
    ids = bpe.encode(F.col("text"), ranks, public_tokenizers.PATTERN)
    coded = table(spark, sf_dir, "documents").select("doc_id", ids.alias("ids"))
    coded = coded.withColumn("decoded", bpe.decode(F.col("ids"), ranks, public_tokenizers.PATTERN))
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document, and its words in common lines (which a
    filter removes). Near copies do not make their own lines common."""
    rated = quality.quality_rules(table(spark, sf_dir, "documents"), near_copies=True, most_docs=quality.MOST_DOCS,
                                  corpus_share=quality.CORPUS_SHARE)
    return rated.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                        F.col("common_words").cast("long").alias("n_common_words"))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times every document is taken, in words."""
    sized = near_dedup.stored(table(spark, sf_dir, "documents").select(
        "doc_id", "source", mixing.word_count(F.col("text")).alias("size")), "sizes")
    return mixing.mix_sources(sized, size_col="size").select("doc_id", "size", "source_size", "target", "taken")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document."""
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(secret_scan.as_text(F.col("base")), 256).alias("base_sha256"),
                        secret_scan.as_text(F.col("spans")).alias("spans"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without word runs that start earlier elsewhere."""
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and accepted templates of every document. The score says how
    strong the evidence is: 1 for a template's whole wording, 0.5 for a phrase alone."""
    found = table(spark, sf_dir, "documents").select("doc_id", licenses.scan_licenses(F.col("text")).alias("x")).select("doc_id", "x.*")
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    score = F.when(F.size("found") > 0, 1.0).when(F.size("base") > 0, 0.5).otherwise(0.0)
    return found.select("doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
                        F.array_min("base.place").alias("first_word"), F.array_max("base.place").alias("last_word"),
                        joined(F.col("base.label")).alias("base_labels"),
                        joined(F.concat("base.label", "found.label")).alias("labels"), score.alias("score"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-middle form of every document."""
    made = fill_middle.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = lambda text: F.sha2(F.encode(text, "UTF-8"), 256)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"),
                       digest(fill_middle.restore(F.col("output"), F.col("form"))).alias("restored_sha256"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for each benchmark item."""
    return lexical.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_pii": op2_pii,
    "op3_html_text": op3_html_text,
    "op4_minhash_dedup": op4_minhash_dedup,
    "op5_nearest": op5_nearest,
    "op6_bpe": op6_bpe,
    "op7_quality_rules": op7_quality_rules,
    "op8_source_mix": op8_source_mix,
    "op9_secret_scan": op9_secret_scan,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_license_scan": op11_license_scan,
    "op12_fill_middle": op12_fill_middle,
    "op13_ranked_search": op13_ranked_search,
}
