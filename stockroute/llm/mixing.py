"""Mixing sources to target weights by subset-sum budget fitting.

Per source, documents are counted by exact length; whole passes cover the
target's multiple of the source, and the remaining budget is met by choosing a
number of documents of each length: proportional shares first, then a bounded
knapsack over what is left. Which documents of a length go is decided by a
seeded hash.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.sequence import row_number
from .near_dedup import stored
from .words import GAP

#: Hash cells that the documents of one source and length are spread over.
CELLS = 1024
#: Documents that the proportional choice gives back to the knapsack.
PUT_BACK = 32


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.size(F.array_remove(F.split(text, GAP), "")), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: Sequence[float], cap: float) -> DataFrame:
    """``sources`` (source, source_size) with ``target``: all words shared by
    weight (sources in code point order, null last, weights repeating), none above
    ``cap`` times its size, the excess reshared by weight among the others. Only
    two sums a round reach the driver."""
    placed = row_number(sources.withColumn("__last", F.col("source").isNull()), ["__last", "source"], output="place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    sources = stored(placed.select("source", "source_size", weight.alias("weight")), "sources")
    most = cap * F.col("source_size")
    share = 0.0
    while True:
        free = F.col("weight") * F.lit(share) <= most
        total, capped, open_weight = sources.agg(
            F.sum("source_size"), F.sum(F.when(~free, most)), F.sum(F.when(free, F.col("weight")))).first()
        new = ((total or 0) - (capped or 0)) / open_weight if open_weight else share
        if new <= share:
            return sources.withColumn("target", F.least(F.col("weight") * F.lit(share), most)).drop("weight")
        share = new


def fit_counts(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length (ascending) to take so that their words
    come as near to ``budget`` as the knapsack finds (0 <= taken <= count)."""
    total = int((lengths * counts).sum())
    if budget <= 0 or total == 0:
        return np.zeros(len(lengths), dtype=np.int64)
    if budget >= total:
        return counts.copy()
    share = counts * (budget / total)
    take = np.floor(share).astype(np.int64)
    rest = budget - int((take * lengths).sum())
    for i in np.argsort(take - share, kind="stable"):  # largest fractions first
        if 0 < lengths[i] <= rest and take[i] < counts[i]:
            take[i] += 1
            rest -= int(lengths[i])
    if rest <= 0:
        return take
    # A few short documents are put back, so that the knapsack has a choice.
    for i in np.flatnonzero((lengths > 0) & (take > 0))[:PUT_BACK]:
        take[i] -= 1
        rest += int(lengths[i])
    # Bounded knapsack over the remaining budget: bit s of `reach` says that s
    # words can be added; counts are split into powers of two.
    left = [(int(lengths[i]), int(counts[i] - take[i]), i) for i in range(len(lengths)) if lengths[i] > 0 and take[i] < counts[i]]
    room = rest + min(x[0] for x in left)
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length, many, i in sorted(left):
        if length > room:
            break
        size = 1
        many = min(many, room // length)
        while many > 0 and not reach >> rest & 1:
            size = min(size, many)
            steps.append((reach, length * size, size, i))
            reach |= reach << (length * size) & mask
            many -= size
            size *= 2
        if reach >> rest & 1:
            break
    goal = min((s for d in range(room + 1) for s in (rest - d, rest + d) if 0 <= s <= room and reach >> s & 1),
               key=lambda s: abs(s - rest), default=0) if not reach >> rest & 1 else rest
    for before, words, many, i in reversed(steps):
        if not before >> goal & 1:
            take[i] += many
            goal -= words
    return take


def _fit(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("size", ignore_index=True)
    group["take"] = fit_counts(group["size"].to_numpy(np.int64), group["n"].to_numpy(np.int64), int(group["budget"].iloc[0]))
    return group[["source", "size", "take"]]


def mix_sources(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), cap: int = 3, seed: int = 17,
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                size_col: str | None = None) -> DataFrame:
    """``docs`` with size, source_size, target, copies (times the mix takes the
    document, at most ``cap``) and taken (``copies * size``); input columns of
    these names are replaced, all others and all rows stay. ``size_col`` names a
    column that has the sizes already.

    Null texts and sources: size 0, and a source of its own that comes last.
    Repeated rows are separate documents of equal rank, so any of them may be
    taken. A source without words has target 0 and takes nothing. An empty table
    gives an empty result. The choice depends on ``seed``, ids and sources only,
    so reruns agree.

    Shuffles: counts by (source, size, hash cell), partially aggregated, so a
    source with a third of all rows is counted in every map task; the knapsack
    sees one row per source and length (at most the root of twice the source's
    words); the documents meet their cell's number in one join on (source,
    length, cell), whose groups are a 1024th of a length's documents.
    """
    size = F.col(size_col).cast("long") if size_col else word_count(F.col(text_col))
    order = F.xxhash64(F.lit(seed), F.col(id_col), F.col(source_col))
    rows = (docs.withColumn("__size", size).drop("size", "source_size", "target", "copies", "taken")
            .withColumn("__order", order).withColumn("__cell", F.pmod(F.col("__order"), F.lit(CELLS)).cast("int"))
            .withColumnRenamed("__size", "size"))
    cells = stored(rows.groupBy(F.col(source_col).alias("source"), "size", F.col("__cell").alias("cell"))
                   .agg(F.count("*").alias("n")), "cells")
    hist = cells.groupBy("source", "size").agg(F.sum("n").alias("n"))
    sources = targets(hist.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, cap)
    passes = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(cap))).otherwise(0)
    sources = stored(sources.withColumn("passes", passes.cast("long"))
                     .withColumn("budget", F.floor(F.col("target") - F.col("passes") * F.col("source_size") + 0.5).cast("long")),
                     "targets")
    budgets = sources.select(F.col("source").alias("s"), "budget")
    same = F.col("source").eqNullSafe(F.col("s"))
    takes = (hist.join(budgets, same).select("source", "size", "n", "budget").groupBy("source")
             .applyInPandas(_fit, "source string, size long, take long"))
    before = F.sum("n").over(Window.partitionBy("source", "size").orderBy("cell")) - F.col("n")
    takes = takes.select(F.col("source").alias("s"), F.col("size").alias("z"), "take")
    plan = (cells.withColumn("before", before)
            .join(takes, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")))
            .select("source", "size", "cell", F.greatest(F.lit(0), F.least("n", F.col("take") - F.col("before"))).alias("extra")))
    plan = plan.join(sources.withColumnRenamed("source", "s"), same).select(
        F.col("source").alias("__s"), F.col("size").alias("__z"), F.col("cell").alias("__c"),
        F.col("extra").alias("__extra"), F.col("passes").alias("__passes"), "source_size", "target")
    met = rows.join(plan, F.col(source_col).eqNullSafe(F.col("__s")) & (F.col("size") == F.col("__z"))
                    & (F.col("__cell") == F.col("__c")))
    rank = F.row_number().over(Window.partitionBy("__s", "__z", "__c").orderBy("__order", F.col(id_col)))
    copies = F.col("__passes") + F.when(rank <= F.col("__extra"), 1).otherwise(0)
    return (met.withColumn("copies", F.least(copies, F.lit(cap)).cast("int"))
            .withColumn("taken", F.col("copies") * F.col("size"))
            .drop("__order", "__cell", "__s", "__z", "__c", "__extra", "__passes"))
