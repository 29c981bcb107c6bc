"""Ranked lexical search by presence-mask grouping.

Documents become one row each with the items' terms that they hold (a forward
index in the shared folder). For each batch of it and each item, a bit is set per
term and document; documents with the same mask of present terms form a group,
whose score is at most the sum of its terms' largest parts in that batch. Groups
are scored in order of that bound until no later one can reach the item's k-th
best so far. Tasks return their best k an item, which are merged in two steps.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .near_dedup import stored

# --- fixed values of the score ---
SCALE, SLOPE, LENGTH_PERCENT, TF_UNIT, M_UNIT = 1_000_000_000, 1000, 75, 1000, 8
# --- end of fixed values ---

#: Items are broadcast in blocks whose texts have at most so many bytes (or that
#: hold a single item); there are as many blocks as that takes.
BLOCK_BYTES = 8_000_000
#: Documents scored at once, and parts of an item's merge.
AT_ONCE, MERGE_PARTS = 64, 32

#: Bytes that are no part of a term become blanks, A-Z become a-z.
_FOLD = bytes((c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32) for c in range(256))
_INDEX = "id long, n long, terms array<int>, tfs array<int>"


def terms_of(text: str) -> list[bytes]:
    """Lower-cased (A-Z) maximal runs of digits, letters and characters beyond ASCII."""
    return text.encode().translate(_FOLD).split()


@dataclass
class Block:
    """A bounded block of items: its terms' numbers, and per item the numbers of
    its distinct terms with their repeats."""
    vocabulary: dict[bytes, int]
    items: list[tuple[np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, texts: list[str]) -> "Block":
        vocabulary: dict[bytes, int] = {}
        items = []
        for text in texts:
            counts = Counter(terms_of(text))
            ids = [vocabulary.setdefault(t, len(vocabulary)) for t in counts]
            items.append((np.array(ids, dtype=np.int64), np.array(list(counts.values()), dtype=np.int64)))
        return cls(vocabulary, items)


def forward_index(docs: DataFrame, vocabulary, text_col: str, id_col: str) -> DataFrame:
    """(id, n, terms, tfs) of every row with a term; ``terms`` are the numbers of
    those in the broadcast vocabulary, ascending."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            ids, ns, terms, tfs = [], [], [], []
            for id_, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                words = terms_of(text.as_py() or "")
                if words:
                    held = sorted((known[w], c) for w, c in Counter(words).items() if w in known)
                    ids.append(id_)
                    ns.append(len(words))
                    terms.append([t for t, _ in held])
                    tfs.append([c for _, c in held])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(ns, pa.int64()),
                 pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int32()))], ["id", "n", "terms", "tfs"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return stored(rows.mapInArrow(run, _INDEX), "forward-index")


def totals(index: DataFrame) -> tuple[int, int]:
    """Number of documents with a term, and of all their terms."""
    row = index.agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    return row["docs"], row["terms"]


def document_counts(index: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each of the ``size`` terms; summed in every task first,
    so at most one row a term and task is shuffled and one a term collected."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size, dtype=np.int64)
        for batch in batches:
            held += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=size)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(held[some])], ["term", "held"])

    out = np.zeros(size, dtype=np.int64)
    if size:
        for row in index.select("terms").mapInArrow(run, "term int, held long").groupBy("term").agg(F.sum("held").alias("df")).collect():
            out[row["term"]] = row["df"]
    return out


def weights(df: np.ndarray, docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * int(x) + 1))) for x in df], dtype=np.int64)


def length_parts(n: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """A document's m, exact also where its products pass 64 bits."""
    if not len(n):
        return n
    wide = LENGTH_PERCENT * int(n.max()) * docs >= 1 << 63
    part = (LENGTH_PERCENT * n.astype(object) * docs // terms if wide else LENGTH_PERCENT * n * docs // terms)
    return 100 - LENGTH_PERCENT + part.astype(np.int64)


class Best:
    """An item's best k (score, id) so far; equal scores by ascending id, nulls last."""

    def __init__(self, k: int):
        self.k = k
        self.score = np.zeros(0, dtype=np.int64)
        self.id = np.zeros(0, dtype=np.int64)
        self.null = np.zeros(0, dtype=bool)

    def floor(self) -> int:
        """The k-th best score (0 with fewer): lower ones are of no use."""
        return int(self.score[-1]) if len(self.score) == self.k else 0

    def add(self, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        use = score >= max(1, self.floor())
        if not use.any():
            return
        score, ids, null = (np.concatenate(x) for x in
                            ((self.score, score[use]), (self.id, ids[use]), (self.null, null[use])))
        order = np.lexsort((ids, null, -score))[:self.k]
        self.score, self.id, self.null = score[order], ids[order], null[order]


class Postings:
    """One batch of the forward index, by document and by term."""

    def __init__(self, batch: pa.RecordBatch, docs: int, terms: int):
        self.ids = batch.column("id").fill_null(0).to_numpy(zero_copy_only=False)
        self.null = batch.column("id").is_null().to_numpy(zero_copy_only=False)
        held = batch.column("terms")
        self.bounds = np.concatenate(([0], np.cumsum(held.value_lengths().to_numpy(zero_copy_only=False)))).astype(np.int64)
        self.term = held.flatten().to_numpy().astype(np.int64)
        tf = batch.column("tfs").flatten().to_numpy().astype(np.int64)
        m = length_parts(batch.column("n").to_numpy(), docs, terms)
        doc = np.repeat(np.arange(len(self.ids)), np.diff(self.bounds))
        self.part = SCALE * tf // (TF_UNIT * tf + M_UNIT * m[doc])
        order = np.argsort(self.term, kind="stable")
        self.present, first = np.unique(self.term[order], return_index=True)
        self.first = np.append(first, len(order))
        self.doc = doc[order]  # of each posting, by term
        self.most = np.maximum.reduceat(self.part[order], first) if len(order) else self.part

    def masks(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Masks (documents x 64-bit words) of the terms present, and each term's
        largest part in the batch (0 if absent)."""
        mask = np.zeros((len(self.ids), len(terms) // 64 + 1), dtype=np.uint64)
        most = np.zeros(len(terms), dtype=np.int64)
        at = np.searchsorted(self.present, terms)
        for j, (term, k) in enumerate(zip(terms, at)):
            if k < len(self.present) and self.present[k] == term:
                mask[self.doc[self.first[k]:self.first[k + 1]], j >> 6] |= np.uint64(1 << (j & 63))
                most[j] = self.most[k]
        return mask, most

    def scores(self, docs: np.ndarray, gain: np.ndarray) -> np.ndarray:
        """Scores of some documents, ``gain`` being each term's weight for the item."""
        size = self.bounds[docs + 1] - self.bounds[docs]
        ends = np.cumsum(size)
        at = np.arange(ends[-1]) + np.repeat(self.bounds[docs] - ends + size, size)
        total = np.concatenate(([0], np.cumsum(gain[self.term[at]] * self.part[at])))
        return total[ends] - total[ends - size]


def groups(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct masks but the empty one; documents in the order of their mask, and
    each mask's first and last place in that order."""
    some = np.flatnonzero(mask.any(axis=1))
    order = some[np.lexsort(mask[some].T)]
    run = mask[order]
    new = np.ones(len(run), dtype=bool)
    new[1:] = (run[1:] != run[:-1]).any(axis=1)
    first = np.flatnonzero(new)
    return run[first], order, first, np.append(first[1:], len(order))


def search(postings: Postings, terms: np.ndarray, value: np.ndarray, gain: np.ndarray, best: Best) -> int:
    """Adds an item's documents of the batch to ``best``; ``value`` is the weight of
    each of its terms times its repeats. Returns the number of documents scored."""
    mask, most = postings.masks(terms)
    kinds, order, first, last = groups(mask)
    if not len(kinds):
        return 0
    bits = np.unpackbits(kinds.astype("<u8").view(np.uint8), axis=1, bitorder="little")[:, :len(terms)]
    bound = bits.astype(np.int64) @ (value * most)
    gain[terms] = value
    by_bound = np.argsort(-bound, kind="stable")
    size = (last - first)[by_bound]
    done, scored = 0, 0
    while done < len(by_bound) and bound[by_bound[done]] >= max(1, best.floor()):
        # Whole groups, about AT_ONCE documents; a large group goes through in steps.
        upto = max(done + 1, int(np.searchsorted(np.cumsum(size[done:]), AT_ONCE, "right")) + done)
        docs = np.concatenate([order[first[g]:last[g]] for g in by_bound[done:upto]])
        for i in range(0, len(docs), 1 << 14):
            some = docs[i:i + (1 << 14)]
            best.add(postings.scores(some, gain), postings.ids[some], postings.null[some])
        scored += len(docs)
        done = upto
    gain[terms] = 0
    return scored


def best_of_index(index: DataFrame, items, df: np.ndarray, docs: int, terms: int, k: int) -> DataFrame:
    """(item, score, id): every task's best k documents for each item of the block."""
    weight = index.sparkSession.sparkContext.broadcast(weights(df, docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, wanted = weight.value, items.value
        gain, best = np.zeros(len(w), dtype=np.int64), [Best(k) for _ in wanted]
        for batch in batches:
            postings = Postings(batch, docs, terms)
            for (ids, repeats), found in zip(wanted, best):
                search(postings, ids, w[ids] * repeats, gain, found)
        item = np.repeat(np.arange(len(best)), [len(b.score) for b in best])
        every = lambda name: np.concatenate([getattr(b, name) for b in best] or [np.zeros(0, dtype=np.int64)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(item.astype(np.int32)), pa.array(every("score")),
             pa.array(every("id"), mask=every("null").astype(bool))], ["item", "score", "id"])

    return index.mapInArrow(run, "item int, score long, id long")


def merged(rows: DataFrame, k: int) -> DataFrame:
    """The best k rows of each item, with their rank; parts of an item first."""
    order = [F.desc("score"), F.asc_nulls_last("id")]
    part = F.pmod(F.xxhash64("id", "score"), F.lit(MERGE_PARTS))
    rows = rows.withColumn("part", part)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))).where(F.col("rank") <= k)
    return (rows.drop("rank", "part")
            .withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k))


def item_blocks(items: DataFrame, block_bytes: int) -> tuple[DataFrame, int]:
    """The items with a block number, and how many blocks: each holds at most
    ``block_bytes`` of texts or a single item."""
    size = F.octet_length("text") + 16
    total = items.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(2 * total / block_bytes))
    while True:
        dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
        over = dealt.groupBy("block").agg(F.sum(size).alias("bytes"), F.count("*").alias("n")).where(
            (F.col("bytes") > block_bytes) & (F.col("n") > 1))
        if over.isEmpty():
            return dealt, blocks
        blocks *= 2


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, text_col: str = "text", id_col: str = "doc_id",
                   item_text_col: str = "text", item_id_col: str = "item_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): every item's ``k`` documents of highest score
    above 0, best first, equal scores by ascending id (null last).

    A term's weight is ``floor(1000 * ln((2N + 2) / (2 df + 1)))``; a document's score
    is the sum over the item's terms, with repeats, of the weight times
    ``1e9 tf div (1000 tf + 8 m)``, m being ``25 + 75 n N div L``.

    Null and empty texts, and texts without a term, neither count nor match, on
    either side. Every row of ``docs`` is a document, so repeated rows are ranked side
    by side; exactly repeated items are answered once, items that share an id with
    other texts one by one. Ids are read as long. Texts are read whole. Other columns
    are not read; tables may be empty.

    All documents are read once for each block of items; what is broadcast is one
    block's terms, bounded by ``block_bytes`` or one item's text.
    """
    spark: SparkSession = docs.sparkSession
    wanted = items.select(F.col(item_id_col).alias("item_id"), F.col(item_text_col).alias("text")).where(
        F.length("text") > 0).distinct()
    wanted, blocks = item_blocks(wanted, block_bytes)
    path = scratch_path(spark, "ranked")
    id_type = items.schema[item_id_col].dataType.simpleString()
    for block in range(blocks):
        # Bounded: one block's items.
        rows = wanted.where(F.col("block") == block).select("item_id", "text").collect()
        if block and not rows:
            continue
        made = Block.of([r["text"] for r in rows])
        index = forward_index(docs, spark.sparkContext.broadcast(made.vocabulary), text_col, id_col)
        n_docs, n_terms = totals(index)
        df = document_counts(index, len(made.vocabulary))
        best = merged(best_of_index(index, spark.sparkContext.broadcast(made.items), df, n_docs, n_terms, k), k)
        named = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], f"item int, item_id {id_type}")
        (best.join(F.broadcast(named), "item")  # one block's item ids
         .select("item_id", "rank", F.col("id").alias("doc_id"), "score").write.mode("append").parquet(path))
    return spark.read.schema(f"item_id {id_type}, rank int, doc_id long, score long").parquet(path)
