"""CSV files whose cells hold line breaks, read in many tasks.

``multiLine`` makes a file one split. Here a file is read by lines, in as many
splits as its bytes give (if it is plain or bzip2), and the lines are joined to records
afterwards. What a line does to the quoting is a function of the state before it
(outside or inside a quoted cell) with two possible results, so it is one of four: keep,
swap, set to outside, set to inside. The functions are composed by sums and last values:
over the lines of a split where it is read, then over the splits of a file, which gives
the state in which every split begins. Knowing it, a second read cuts each split into
records as its lines pass by: lines are neither shuffled nor sorted. Spark's own CSV
parser then reads the records.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import WindowSpec

from ..session import scratch_path
from .csv import BOM, FILE_COLUMN, read_csv

_SPLIT = "_split"
_OPEN = ',"'
_CLOSED = ',"[^"]*"[^,]*'


def _ends_inside(cells: Column) -> Column:
    """Whether cells, each after a comma and without doubled quotes, end in a quoted
    one: one opens at a cell's start and is not closed. A quote elsewhere in an
    unquoted cell means nothing."""
    return F.contains(F.regexp_replace(cells, _CLOSED, ","), F.lit(_OPEN)).cast("int")


def line_effect(line: Column) -> tuple[Column, Column]:
    """The state after a line (1: inside a quoted cell) that begins outside, inside.
    Only lines in which a cell may open are searched by patterns."""
    single = F.replace(line, F.lit('""'), F.lit(""))  # a doubled quote changes no state
    cells = F.concat(F.lit(","), single)
    opens = F.contains(cells, F.lit(_OPEN))
    return (F.when(opens, _ends_inside(cells)).otherwise(0),
            F.when(opens, _ends_inside(F.concat(F.lit(_OPEN), single)))
            .when(F.contains(single, F.lit('"')), 0).otherwise(1))


def _composed(window: WindowSpec, before: str) -> Column:
    """The state after each row of ``window``: columns ``swaps`` (0 or 1) and ``sets`` (the
    state it is set to, or null) are the rows' functions, the column ``before`` has the
    state in which the window begins."""
    swapped = F.sum("swaps").over(window)
    # A set state counts back to what it was before the swaps up to it.
    since = F.last(F.col("sets_from"), ignorenulls=True).over(window)
    return F.pmod(F.coalesce(since, F.col(before)) + swapped, F.lit(2)).cast("int")


def _with_origin(df: DataFrame, window: WindowSpec) -> DataFrame:
    return df.withColumn("sets_from", F.when(F.col("sets").isNotNull(), F.pmod(F.col("sets") + F.sum("swaps").over(window), F.lit(2))))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, line) of every line, in the order of a split; a line belongs to
    the split that its first byte is in."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias(FILE_COLUMN), F.col("_metadata.file_block_start").alias(_SPLIT),
        F.col("value").alias("line"))


def _functions(df: DataFrame) -> DataFrame:
    """Columns ``_o`` and ``_i`` (the states after a row that begins outside, inside) as
    ``swaps`` and ``sets``."""
    return (df.withColumn("swaps", ((F.col("_o") == 1) & (F.col("_i") == 0)).cast("int"))
            .withColumn("sets", F.when(F.col("_o") == F.col("_i"), F.col("_o"))).drop("_o", "_i"))


def _upto(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def states_after(outside: np.ndarray, inside: np.ndarray, before: int) -> np.ndarray:
    """The state after each of a run of lines that begins in ``before``."""
    swaps = np.cumsum((outside == 1) & (inside == 0))
    at = np.maximum.accumulate(np.where(outside == inside, np.arange(len(outside)), -1))
    return np.where(at < 0, before + swaps, outside[at] + swaps - swaps[at]) & 1


class _Cutter:
    """Cuts the lines of one split, given in runs, into records. ``head`` is the rest of
    an earlier split's record (if the split begins inside one); what is open after
    the last line is its ``tail``."""

    def __init__(self, before: int):
        self.state, self.head, self.begun, self.open, self.cut = before, None, False, [], 0

    def add(self, lines: pa.Array, outside: np.ndarray, inside: np.ndarray, keep: bool = True) -> list[pa.Array]:
        """The records that end in this run (if ``keep``; they are counted anyway)."""
        after = states_after(outside, inside, self.state)
        starts = np.flatnonzero(np.append(self.state, after[:-1]) == 0)
        self.state = int(after[-1])
        found = []
        going = int(starts[0]) if len(starts) else len(lines)
        if going:
            self.open.append(_joined(lines, [0, going])[0].as_py())
            if len(starts) or not self.state:
                text, self.open = b"\n".join(self.open), []
                if self.begun:
                    found.append(pa.array([text], pa.binary()))
                    self.cut += 1
                else:
                    self.head = text
        whole = [*starts, len(lines)] if not self.state else list(starts)
        if len(whole) > 1:
            self.cut += len(whole) - 1
            if keep:
                found.append(_joined(lines, whole))
        if len(starts) and self.state:
            self.open, self.begun = [_joined(lines, [starts[-1], len(lines)])[0].as_py()], True
        return found

    def ends(self) -> tuple[bytes | None, bytes | None]:
        """(head, tail)."""
        left = b"\n".join(self.open) if self.open else None
        return (self.head, left) if self.begun else (left if self.head is None else self.head, None)


def _joined(lines: pa.Array, bounds: list[int]) -> pa.Array:
    """The lines from each bound to the next as one text."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), lines), b"\n")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """((file, split), rows) of consecutive rows of one split."""
    for batch in batches:
        if batch.num_rows:
            file, split = batch.column(FILE_COLUMN), batch.column(_SPLIT).to_numpy()
            other = pc.not_equal(file[1:], file[:-1]).to_numpy(zero_copy_only=False) | (split[1:] != split[:-1])
            bounds = [0, *(np.flatnonzero(other) + 1), batch.num_rows]
            for a, b in zip(bounds, bounds[1:]):
                yield (file[a].as_py(), int(split[a])), batch.slice(a, b - a)


def _effects(rows: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    return rows.column("line"), rows.column("_o").to_numpy(), rows.column("_i").to_numpy()


_ENDS = f"{FILE_COLUMN} string, {_SPLIT} long, assumed int, after int, head binary, tail binary, first boolean"


def _split_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each split, begun outside and inside a cell: the state after it and its pieces
    of records that cross splits. ``first`` tells that the tail begins its file."""
    key, both = None, ()

    def rows() -> pa.RecordBatch:
        out = [(*key, s, c.state, *c.ends(), key[1] == 0 and c.cut == 0) for s, c in enumerate(both)]
        types = (pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)],
                                          [FILE_COLUMN, _SPLIT, "assumed", "after", "head", "tail", "first"])

    for at, run in _runs(batches):
        if at != key:
            if key is not None:
                yield rows()
            key, both = at, (_Cutter(0), _Cutter(1))
        for c in both:
            c.add(*_effects(run), keep=False)
    if key is not None:
        yield rows()


def _whole_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records that lie in one split."""
    key, cutter = None, None
    for at, run in _runs(batches):
        if at != key:
            key, cutter = at, _Cutter(run.column("before")[0].as_py())
        cut = cutter.cut
        for texts in cutter.add(*_effects(run)):
            first = np.zeros(len(texts), dtype=bool)
            first[0] = key[1] == 0 and cut == 0
            cut += len(texts)
            yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(key[0], pa.string()), len(texts)), pa.array(first), texts],
                                             [FILE_COLUMN, "first", "text"])


def split_states(ends: DataFrame) -> DataFrame:
    """(file, split, before): the state in which each split begins, from the rows of
    ``_split_ends``. A window over a file sees one row a split."""
    whole = ends.groupBy(FILE_COLUMN, _SPLIT).agg(F.max(F.when(F.col("assumed") == 0, F.col("after"))).alias("_o"),
                                                  F.max(F.when(F.col("assumed") == 1, F.col("after"))).alias("_i"))
    whole = _functions(whole.withColumn("outside", F.lit(0)))
    in_file = Window.partitionBy(FILE_COLUMN).orderBy(_SPLIT)
    upto = _upto(in_file)
    after = _with_origin(whole, upto).withColumn("after", _composed(upto, "outside"))
    return after.select(FILE_COLUMN, _SPLIT, F.lag("after", 1, 0).over(in_file).alias("before"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """(_file, first, record): every record of the files as text, without its line end;
    ``first`` tells each file's first record. The files are read twice. The first read,
    when this is called, stores two rows a split in the shared folder: its states, and
    its pieces of records that cross splits, which are put together from there. The
    second one cuts the other records out of the lines where they are read, so no
    task holds more than a split's largest records. Empty lines between records are
    left out. Encoding is UTF-8."""
    outside, inside = line_effect(F.col("line"))
    lines = _lines(spark, path).select(FILE_COLUMN, _SPLIT, F.col("line").cast("binary").alias("line"),
                                       outside.alias("_o"), inside.alias("_i"))
    stored = scratch_path(spark, "split-ends")
    lines.mapInArrow(_split_ends, _ENDS).write.parquet(stored)
    ends = spark.read.schema(_ENDS).parquet(stored)
    states = split_states(ends)
    # Splits are the same in both reads unless the session's parallelism changed meanwhile.
    moved = F.raise_error(F.concat(F.lit("splits changed between two reads of "), F.col(FILE_COLUMN))).cast("int")
    begun = lines.join(F.broadcast(states), [FILE_COLUMN, _SPLIT], "left").withColumn("before", F.coalesce("before", moved))
    whole = begun.mapInArrow(_whole_records, f"{FILE_COLUMN} string, first boolean, text binary")

    ends = ends.join(states, [FILE_COLUMN, _SPLIT]).where("assumed = before")
    pieces = ends.where("head is not null").select(FILE_COLUMN, _SPLIT, F.lit(False).alias("begins"), F.lit(False).alias("first"), F.col("head").alias("text"))
    pieces = pieces.union(ends.where("tail is not null").select(FILE_COLUMN, _SPLIT, F.lit(True), "first", "tail"))
    ordered = Window.partitionBy(FILE_COLUMN).orderBy(_SPLIT, "begins")
    record = F.last(F.when(F.col("begins"), F.col(_SPLIT)), ignorenulls=True).over(ordered)
    crossing = (pieces.withColumn("text", F.col("text").cast("string")).withColumn("_record", record).groupBy(FILE_COLUMN, "_record")
                .agg(F.sort_array(F.collect_list(F.struct(_SPLIT, "text"))).alias("parts"), F.max("first").alias("first")))
    crossing = crossing.select(FILE_COLUMN, "first", F.array_join(F.transform("parts", lambda x: x["text"]), "\n").alias("text"))
    found = whole.withColumn("text", F.col("text").cast("string")).unionByName(crossing)
    record = F.regexp_replace("text", r"\r\z", "")
    return (found.select(FILE_COLUMN, "first", record.alias("record"))
            .where(F.col("first") | (F.col("record") != "")))


def read_csv_split(spark: SparkSession, path: str, *, with_file: bool = False) -> DataFrame:
    """As :func:`csv.read_csv` with ``multi_line``, in as many tasks as the files have
    splits: all columns as strings, header names without byte-order marks, columns
    from the first file's header; a file with another header raises. Header cells
    with line breaks are not supported. Cells are quoted by ``"``, doubled inside."""
    names = read_csv(spark, path).columns
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
    ddl = ", ".join(f"c{i} string" for i in range(len(names)))
    found = records(spark, path).withColumn("cells", F.from_csv("record", ddl, {"escape": '"', "multiLine": "true"}))
    header = F.transform(F.array(*[F.col(f"cells.{f.name}") for f in schema]), lambda x: F.ltrim(x, F.lit(BOM)))
    same = F.coalesce(header == F.array(*[F.lit(n) for n in names]), F.lit(False))
    other = F.raise_error(F.concat(F.lit("another header in "), F.col(FILE_COLUMN))).cast("boolean")
    rows = found.where(F.when(~F.col("first"), True).when(same, False).otherwise(other))
    return rows.select(*[F.col(f"cells.c{i}").alias(n) for i, n in enumerate(names)], *([FILE_COLUMN] if with_file else []))
