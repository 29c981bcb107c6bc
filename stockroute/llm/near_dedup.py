"""Near-duplicate documents by MinHash with tensored banding.

Two small collections of minhash bands are computed per document; the key of
table ``(i, j)`` joins band ``i`` of the first with band ``j`` of the second, so
``2 * BANDS * WIDTH`` minhashes serve ``BANDS ** 2`` tables of ``2 * WIDTH``
minhashes each (about the square root of the independent tables' work).
Candidates are verified on the full shingle sets.

Shape of the job: exact copies collapse to one representative of a set first;
table keys are counted with partial aggregation; a bucket is never expanded to
its pairs. Each document is verified against a few bucket pivots and components
are formed. Where a bucket still holds several components, its outsiders are
tested against all members of its main component in cells of bounded size (only
links leave a cell), then against each other, until nothing is left; so every
link that joins two components inside a bucket is found. Intermediate results
are tables in the shared folder; only counts reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .words import mix, window_hashes, word_hashes

#: Minhashes in a band, bands in each of the two collections. A pair at
#: similarity 0.8 shares a table with probability (1 - (1 - 0.8**3)**11)**2 = 0.999.
WIDTH, BANDS = 3, 11
#: Pivots of other buckets that a document meets first, and outsiders of a bucket
#: that meet as pairs (more of them meet in cells).
FIRST, FEW = 4, 32
#: Members and outsiders of a component in one cell of a block test.
CELL_MEMBERS, CELL_OUTSIDERS = 512, 256
_SEEDS = mix(np.arange(1, 4 * WIDTH * BANDS + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
_MASKS, _FACTORS = _SEEDS[::2], _SEEDS[1::2] | np.uint64(1)
_ROWS = 4096


def shingle_set(hashes: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes; a shorter text is one shingle of all its
    words, an empty one has none."""
    n = len(hashes)
    return np.unique(window_hashes(hashes, min(width, n))) if n else hashes


def minhash_bands(shingles: np.ndarray) -> np.ndarray:
    """``2 * BANDS`` hashes, each of ``WIDTH`` minhashes of a non-empty set."""
    least = np.full(len(_MASKS), np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(shingles), _ROWS):
        block = (shingles[i:i + _ROWS, None] ^ _MASKS) * _FACTORS
        np.minimum(least, block.min(axis=0), out=least)
    bands = least.reshape(2 * BANDS, WIDTH)
    out = np.zeros(2 * BANDS, dtype=np.uint64)
    for j in range(WIDTH):
        out = mix(out ^ bands[:, j])
    return out


def _sets(column: pa.Array, width: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Slices of a text column: the first row's number and the rows' shingle sets."""
    for first, last, bounds, hashes in word_hashes(column, lower=True):
        yield first, [shingle_set(hashes[bounds[i]:bounds[i + 1]], width) for i in range(last - first)]


def _print(shingles: np.ndarray) -> tuple[int, int]:
    """A 128-bit fingerprint of a set."""
    with np.errstate(over="ignore"):
        pair = (mix(shingles).sum(dtype=np.uint64), mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
    return tuple(int(np.int64(x.astype(np.int64))) for x in pair)


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n_shingles, lo, hi, bands) per row of (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, low, high, bands = [], [], [], []
            for _, sets in _sets(batch.column("text"), width):
                for s in sets:
                    lo, hi = _print(s)
                    sizes.append(len(s))
                    low.append(lo)
                    high.append(hi)
                    bands.append(minhash_bands(s).astype(np.int64) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(low, pa.int64()),
                 pa.array(high, pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "lo", "hi", "bands"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, lo long, hi long, bands array<long>")


def shingles_of(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, lo, shingles) per row of (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, sets in _sets(batch.column("text"), width):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, len(sets)),
                     pa.array([_print(s)[0] for s in sets], pa.int64()),
                     pa.array([s.astype(np.int64) for s in sets], pa.list_(pa.int64()))],
                    ["doc_id", "lo", "shingles"])

    return docs.mapInArrow(run, "doc_id long, lo long, shingles array<long>")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage starts there."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable over ``links`` (x, y).

    Smallest-label propagation with pointer jumping; every round is a stored
    table, and only the number of changed labels reaches the driver.
    """
    both = stored(links.select("x", "y").union(links.select(F.col("y").alias("x"), F.col("x").alias("y")))
                  .distinct(), "edges")
    labels = stored(both.groupBy(F.col("x").alias("id")).agg(F.min("y").alias("m"))
                    .select("id", F.least("id", "m").alias("component")), "labels")
    while True:
        near = (both.join(labels.select(F.col("id").alias("y"), "component"), "y")
                .groupBy(F.col("x").alias("id")).agg(F.min("component").alias("m")))
        moved = labels.join(near, "id").select("id", F.least("component", "m").alias("via"), F.col("component").alias("old"))
        jump = labels.select(F.col("id").alias("via"), F.col("component").alias("far"))
        new = stored(moved.join(jump, "via").select("id", F.least("via", "far").alias("component"), "old"), "labels")
        changed = new.where("component <> old").limit(1).count()
        labels = new.select("id", "component")
        if not changed:
            return labels


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) whose full sets are similar enough."""
    left = sets.select(F.col("doc_id").alias("x"), F.col("shingles").alias("a"))
    right = sets.select(F.col("doc_id").alias("y"), F.col("shingles").alias("b"))
    common = F.size(F.array_intersect("a", "b")).cast("long")
    union = F.size("a") + F.size("b") - common
    return pairs.join(left, "x").join(right, "y").where(100 * common >= percent * union).select("x", "y")


def _ordered(x: Column, y: Column) -> list[Column]:
    return [F.least(x, y).alias("x"), F.greatest(x, y).alias("y")]


def _table_keys(reps: DataFrame) -> DataFrame:
    """(key, id): one row per document and table."""
    first, second = F.slice("bands", 1, BANDS), F.slice("bands", BANDS + 1, BANDS)
    keys = F.flatten(F.transform(first, lambda a, i: F.transform(
        second, lambda b, j: F.xxhash64(a, b, i * BANDS + j))))
    return reps.select(F.explode(keys).alias("key"), "id")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Words are maximal runs without blanks, A-Z lower-cased; a document's set has
    its distinct ``width``-word shingles, or its whole word sequence if shorter.
    Two documents are linked if ``100 * intersection >= percent * union``;
    component_id is the smallest doc_id reachable, kept is doc_id = component_id.

    Null or wordless texts have an empty set and are linked with nothing. Rows
    with a null id are linked with nothing and stay (component_id null, kept
    true). Repeated rows have one id, so they share component_id and kept; rows
    that share an id but not the text count as one document with both sets'
    links. An empty table gives an empty result. Other columns are not read.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed = stored(signatures(plain, width), "signatures")
    reps = stored(signed.where("n_shingles > 0 and doc_id is not null").groupBy("lo", "hi", "n_shingles")
                  .agg(F.min(F.struct(F.col("doc_id").alias("id"), "bands")).alias("r"))
                  .select("r.id", "lo", "hi", "n_shingles", "r.bands"), "representatives")
    labels = _linked(spark, plain, reps, width, percent)
    tops = (reps.select("lo", "hi", "n_shingles", "id").join(labels, "id", "left")
            .select("lo", "hi", "n_shingles", F.coalesce("component", "id").alias("top")))
    return (signed.select("doc_id", "n_shingles", "lo", "hi")
            .join(tops, ["lo", "hi", "n_shingles"], "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("top", "doc_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def _linked(spark: SparkSession, plain: DataFrame, reps: DataFrame, width: int, percent: int) -> DataFrame:
    """(id, component) of the representatives that have a link."""
    keys = _table_keys(reps.select("id", "bands"))
    shared = keys.groupBy("key").agg(F.min("id").alias("pivot"), F.count("*").alias("n")).where("n > 1")
    members = stored(keys.join(shared, "key").select("key", "id", "pivot", "n"), "members")
    near = members.select("id").distinct()
    chosen = reps.select(F.col("id").alias("doc_id"), "lo").join(near, F.col("doc_id") == F.col("id"), "left_semi")
    sets = stored(shingles_of(plain.join(chosen.select("doc_id"), "doc_id", "left_semi"), width)
                  .join(chosen, ["doc_id", "lo"], "left_semi").dropDuplicates(["doc_id", "lo"])
                  .select("doc_id", "shingles"), "sets")

    # Each document against the smallest pivot of its buckets and a few others.
    slot = F.pmod(F.xxhash64("key"), F.lit(FIRST))
    first = (members.groupBy("id", slot.alias("slot")).agg(F.min(F.struct(F.xxhash64("key"), "pivot")).alias("one"), F.min("pivot").alias("least")))
    first = first.groupBy("id").agg(F.collect_set("one.pivot").alias("some"), F.min("least").alias("least"))
    first = first.select("id", F.explode(F.array_union("some", F.array("least"))).alias("p")).where("p <> id")
    links = stored(_links(first.select(*_ordered(F.col("p"), F.col("id"))).distinct(), sets, percent), "links")
    labels = components(links)
    members = members.select("key", "id")
    tested = None
    while True:
        placed = sets.join(labels, F.col("doc_id") == F.col("id"), "left").select(
            F.col("doc_id").alias("id"), F.coalesce("component", "doc_id").alias("c"), "shingles")
        # Buckets whose members belong to several components.
        rows = members.join(labels, "id", "left").select("key", "id", F.coalesce("component", "id").alias("c"))
        split = rows.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi")
        live = stored(rows.join(split.select("key"), "key", "left_semi"), "live")
        members = live.select("key", "id")
        main = (live.groupBy("key", "c").agg(F.count("*").alias("k")).groupBy("key")
                .agg(F.max(F.struct("k", "c")).alias("top")).select("key", F.col("top.c").alias("main")))
        odd = stored(live.join(main, "key").where("c <> main"), "odd")
        # First every outsider of a bucket against the bucket's main component, whole.
        sizes = placed.groupBy(F.col("c").alias("main")).agg(F.count("*").alias("size"))
        tests = odd.select(F.col("id").alias("o"), "main").distinct().join(sizes, "main")
        if tested is not None:
            tests = tests.join(tested, ["o", "main", "size"], "left_anti")
        tests = stored(tests.select("o", "main", "size"), "tests")
        if tests.limit(1).count():
            members_of = placed.join(tests.select(F.col("main").alias("c")).distinct(), "c", "left_semi").select(
                "c", "id", F.col("c").alias("group"), "shingles")
            asked = tests.join(placed.select(F.col("id").alias("o"), F.col("c").alias("group"), "shingles"), "o")
            found = stored(_block_links(members_of, asked, percent), "links")
            tested = tests.select("o", "main", "size") if tested is None else tested.union(tests.select("o", "main", "size"))
            if found.limit(1).count():
                links = links.union(found)
                labels = components(links)
            continue
        # Then, where that is done, the outsiders of a bucket against each other:
        # pairs where they are few, cells of bounded size where they are many.
        several = odd.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("n")).where("lo < hi")
        left = stored(odd.join(several.select("key", "n"), "key"), "outsiders")
        few = left.where(F.col("n") <= FEW)
        pairs = (few.select("key", "id", "c").join(few.select("key", F.col("id").alias("p"), F.col("c").alias("pc")), "key")
                 .where("p < id and pc <> c").select(F.col("p").alias("x"), F.col("id").alias("y")).distinct())
        many = left.where(F.col("n") > FEW).join(sets, F.col("doc_id") == F.col("id"))
        many = many.select(F.col("key").alias("bucket"), "id", F.col("c").alias("group"), "shingles", "n")
        blocks = _block_links(many.select(F.col("bucket").alias("c"), "id", "group", "shingles"),
                              many.select(F.col("bucket").alias("main"), F.col("id").alias("o"), "group", "shingles", F.col("n").alias("size")),
                              percent)
        found = stored(_links(pairs, sets, percent).union(blocks), "links")
        return components(links.union(found)) if found.limit(1).count() else labels


def _block_links(members: DataFrame, outsiders: DataFrame, percent: int) -> DataFrame:
    """Links (x, y) between members (c, id, group, shingles) and outsiders (main,
    o, group, shingles, size) with main = c that belong to different groups: one
    for each outsider, cell and group that it is linked to. Both sides are dealt
    in cells of bounded size (``size`` counts the members); no pair is ever a
    row."""
    counts = outsiders.groupBy("main").agg(F.max("size").alias("size"), F.count("*").alias("n")).select(
        "main", F.ceil(F.col("size") / CELL_MEMBERS).cast("int").alias("m_cells"),
        F.ceil(F.col("n") / CELL_OUTSIDERS).cast("int").alias("o_cells"))
    counts = stored(counts, "cells")
    cell = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = members.join(counts.select(F.col("main").alias("c"), "m_cells", "o_cells"), "c").select(
        F.col("c").alias("to"), cell("id", "m_cells").alias("a"), every("o_cells").alias("b"),
        F.col("id").alias("member"), F.col("group").alias("in"), F.col("shingles").alias("members"))
    right = outsiders.drop("size").join(counts.select(F.col("main"), "m_cells", "o_cells"), "main").select(
        F.col("main").alias("of"), every("m_cells").alias("x"), cell("o", "o_cells").alias("y"),
        F.col("o").alias("outsider"), F.col("group").alias("from"), F.col("shingles").alias("own"))
    return left.groupBy("to", "a", "b").cogroup(right.groupBy("of", "x", "y")).applyInArrow(
        lambda m, o: _cell_links(m, o, percent), "x long, y long").distinct()


def _cell_links(members: pa.Table, outsiders: pa.Table, percent: int) -> pa.Table:
    x, y = [], []
    if len(members) and len(outsiders):
        ids, groups = members.column("member").to_numpy(), members.column("in").to_numpy()
        column = members.column("members").combine_chunks()
        flat = column.flatten().to_numpy().view(np.uint64)
        starts = np.asarray(column.offsets)[:-1] - column.offsets[0].as_py()
        sizes = np.diff(np.asarray(column.offsets))
        for o, group, own in zip(outsiders.column("outsider").to_pylist(), outsiders.column("from").to_pylist(), outsiders.column("own")):
            own = own.values.to_numpy().view(np.uint64)  # ascending, as all sets
            at = np.minimum(np.searchsorted(own, flat), len(own) - 1)
            common = np.add.reduceat(own[at] == flat, starts, dtype=np.int64)
            near = np.flatnonzero((100 * common >= percent * (sizes + len(own) - common)) & (groups != group))
            for k in np.unique(groups[near], return_index=True)[1]:
                other = int(ids[near[k]])
                x.append(min(o, other))
                y.append(max(o, other))
    return pa.table({"x": pa.array(x, pa.int64()), "y": pa.array(y, pa.int64())})
