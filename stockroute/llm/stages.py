"""Stages of the corpus pipeline, each ``(spark, docs, sf_dir) -> DataFrame``.

Every stage reads all that its predecessor kept; all but the last return the
columns that they were given. A repeated or null doc_id is carried along; rows
are only dropped by the quality stage (rejected documents), the near-duplicate
stage (all but one of a group) and the mix (documents it takes no time).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, mixing, near_dedup as dedup, pii, quality as rules

RANKS = "byte_bpe_50k.tiktoken"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the others lose the common lines of their host and
    of the corpus, and n_chars follows the text. Near copies are the next stage's business, so they
    do not make their lines common here."""
    found = rules.quality_rules(docs, near_copies=True, most_docs=rules.MOST_DOCS, corpus_share=rules.CORPUS_SHARE).where("kept")
    text = rules.strip_lines(F.col("text"), F.col("common_lines"))
    return found.withColumn("text", text).select(*_with_length(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (5-word shingles at
    similarity 0.8): the one with the smallest doc_id, and one row if rows repeat
    it. Rows that share a doc_id but not the text are documents of their own.
    Documents without an id stay."""
    # A document is a doc_id with a text, under a hash of both.
    own = F.xxhash64("doc_id", *rules.fingerprint(F.coalesce("text", F.lit(""))))
    rows = docs.withColumn("__own", F.when(F.col("doc_id").isNotNull(), own))
    found = dedup.near_duplicates(rows, width=5, percent=80, id_col="__own").where("doc_id is not null")
    found = found.select(F.col("doc_id").alias("__own"), "component_id").distinct()
    first = (rows.select("__own", "doc_id").distinct().join(found, "__own")
             .groupBy("component_id").agg(F.min(F.struct("doc_id", "__own")).alias("first")))
    alone = (rows.join(first.select(F.col("first.__own").alias("__own")), "__own", "left_semi")
             .groupBy("__own").agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*"))
    return alone.unionByName(docs.where("doc_id is null"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind. A null text stays null, an empty one empty;
    texts are read whole. Rows are independent, so repeated rows agree; columns keep
    their names and order."""
    return docs.withColumn("text", pii.redact(F.col("text"))).select(*_with_length(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them (0 to 3 times). Null and
    empty texts have no words and are not taken; a null source is a source of its own;
    repeated rows count each. The columns are those given, but ``__copy`` and the
    operator's own (``mixing.mix_sources``) must not be among them."""
    taken = mixing.mix_sources(docs).where("copies > 0")
    return taken.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*docs.columns)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of a training table: doc_id, source, lang, n_tokens, token_ids
    (little-endian 32-bit) and whether the ids decode to the text's bytes. Null and
    empty texts have no tokens; texts are encoded whole, whatever their length; other
    columns are left out."""
    ranks = bpe.rank_file(spark, public_tokenizers.path(RANKS))
    ids = bpe.encode(F.col("text"), ranks, public_tokenizers.PATTERN)
    coded = docs.select("doc_id", "source", "lang", "text", ids.alias("token_ids"))
    same = bpe.decode(F.col("token_ids"), ranks, public_tokenizers.PATTERN) == F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return coded.select("doc_id", "source", "lang", (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
                        "token_ids", same.alias("round_trip"))


def _with_length(docs: DataFrame) -> list:
    """The columns of ``docs``, with n_chars recomputed from the text if present."""
    return [F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns]
