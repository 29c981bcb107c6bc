"""CSV extracts -> typed raw tables.

Reading is header-driven but never infers types: every column is read as
text, matched to the column map by header (leading byte-order marks
removed), and cast once to the target type. Inference would cost a full extra
pass over the files and gives different types for different files (SURVEY
§1.3). ``multiLine`` is an option because it makes each file one split; keep
it off for large single files whose fields carry no line breaks (with line breaks,
``csv_split`` reads them in many tasks). A directory
whose files have other headers or another column order is read under each file's
own header by ``read_csv_mixed``; rows that do not type can go to a table of their
own (``label_rows``) instead of ending the job or becoming null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import (AUDIT_COLUMNS, ORDER_HEADERS, ORDERS_REQUIRED, ORDERS_SCHEMA,
                       STOCK_HEADERS, STOCK_REQUIRED, STOCK_SCHEMA)
from .sized import sized

GOOD, BAD = "GOOD", "BAD"
BOM = "\ufeff"


#: Column with the path of the file that a row came from.
FILE_COLUMN = "_file"
CORRUPT = "_corrupt"


def _reader(spark: SparkSession, multi_line: bool, encoding: str) -> DataFrameReader:
    return (spark.read
            .option("header", "true")
            .option("encoding", encoding)
            .option("multiLine", "true" if multi_line else "false")
            .option("escape", '"'))


def read_csv(spark: SparkSession, path: str, *, multi_line: bool = False,
             encoding: str = "UTF-8", with_file: bool = False) -> DataFrame:
    """All columns as strings, header names with every leading BOM removed.
    Columns come from the first file's header; a file with other headers or
    another column order raises. ``multi_line`` (for fields with line breaks)
    makes each file one split; ``with_file`` adds ``FILE_COLUMN``."""
    df = (_reader(spark, multi_line, encoding)
          .option("inferSchema", "false")
          .option("enforceSchema", "false")
          .csv(path))
    named = [F.col(f"`{c}`").alias(c.lstrip(BOM)) for c in df.columns]
    return df.select(*named, *([F.col("_metadata.file_path").alias(FILE_COLUMN)] if with_file else []))


def header_index(spark: SparkSession, path: str, encoding: str = "UTF-8") -> tuple[DataFrame, int]:
    """(_file, names): every file's header cells without byte-order marks; and the
    number of cells of the widest. The header is the first line of the split that
    begins at the file's first byte, so a file gives one row after a partial
    aggregation; headers with line breaks inside are not supported."""
    lines = spark.read.option("encoding", encoding).text(path).where("_metadata.file_block_start = 0").select(
        F.col("_metadata.file_path").alias(FILE_COLUMN), "value", F.monotonically_increasing_id().alias("at"))
    first = lines.groupBy(FILE_COLUMN).agg(F.min_by("value", "at").alias("line"))
    width = first.agg(F.max(F.size(F.split("line", ",")))).first()[0] or 1  # quoted commas only make it wider
    cells = F.from_csv("line", _cells(width).simpleString()[len("struct<"):-1].replace(":", " "), {"escape": '"'})
    names = F.transform(F.array(*[cells[f"c{i}"] for i in range(width)]), lambda x: F.ltrim(x, F.lit(BOM)))
    return first.select(FILE_COLUMN, names.alias("names")), width


def _cells(width: int) -> T.StructType:
    return T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)])


def read_csv_mixed(spark: SparkSession, path: str, header_map: dict[str, str], required=(), *,
                   multi_line: bool = False, encoding: str = "UTF-8") -> DataFrame:
    """The mapped columns as text, ``FILE_COLUMN`` and ``CORRUPT``, each file read
    under its own header: columns may come in any order, and one that a file lacks
    is null there. ``CORRUPT`` tells what is wrong with a record as a whole: it has
    more cells than its header, or its file lacks a required column; else null.

    The files are scanned once for headers (their first blocks) and once for rows.
    The index has one row a file and is broadcast if its measured size allows."""
    names, width = header_index(spark, path, encoding)
    place = lambda header: (F.array_position("names", F.lit(header)) - 1).cast("int")
    # Of a header that stands twice, the first counts; -1 (absent) reads as null.
    index = names.select(F.col(FILE_COLUMN).alias("_index_file"), F.size(F.array_compact("names")).alias("cells"),
                         F.array(*[place(h) for h in header_map]).alias("places"),
                         F.array_compact(F.array(*[F.when(~F.coalesce(F.array_contains("names", h), F.lit(False)), F.lit(c))
                                                   for h, c in header_map.items() if c in required])).alias("absent"))
    # One cell more than the widest header shows records that have too many.
    rows = (_reader(spark, multi_line, encoding).option("enforceSchema", "true").schema(_cells(width + 1)).csv(path)
            .select(F.array(*[F.col(f"c{i}") for i in range(width + 1)]).alias("got"),
                    F.col("_metadata.file_path").alias(FILE_COLUMN)))
    rows = rows.join(sized(index), F.col(FILE_COLUMN) == F.col("_index_file"))
    beyond = F.array_compact(F.slice("got", F.col("cells") + 1, F.lit(width + 1)))
    corrupt = (F.when(F.size("absent") > 0, F.concat(F.lit("no column "), F.array_join("absent", ", ")))
               .when(F.size(beyond) > 0, F.concat(F.lit("beyond the header: "), F.array_join(beyond, ","))))
    return rows.select(*[F.get("got", F.get("places", F.lit(i))).alias(c) for i, c in enumerate(header_map.values())],
                       FILE_COLUMN, corrupt.alias(CORRUPT))


def label_rows(df: DataFrame, schema: T.StructType, required=()) -> DataFrame:
    """Text columns typed by ``schema``, with faults (column, text) of the cells that
    hold text but do not type, and of ``CORRUPT`` if the frame has it, record (the
    row's cells as JSON; null for good rows) and row_status (GOOD or BAD). Absent
    optional columns are typed nulls, an absent required one raises. One pass, no
    shuffle; no row is lost: read = GOOD + BAD."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"input lacks required columns {missing}")
    fault = lambda name, text: F.struct(F.lit(name).alias("column"), text.alias("text"))
    typed, faults = [], []
    for f in schema.fields:
        if f.name not in df.columns:
            typed.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        value = F.col(f.name).try_cast(f.dataType)
        typed.append(value.alias(f.name))
        if not isinstance(f.dataType, T.StringType):
            faults.append(F.when(F.col(f.name).isNotNull() & value.isNull(), fault(f.name, F.col(f.name))))
    if CORRUPT in df.columns:
        faults.append(F.when(F.col(CORRUPT).isNotNull(), fault(CORRUPT, F.col(CORRUPT))))
    found = F.array_compact(F.array(*faults)) if faults else F.array().cast("array<struct<column:string,text:string>>")
    cells = F.to_json(F.struct(*[F.col(f.name) for f in schema.fields if f.name in df.columns]))
    kept = [FILE_COLUMN] if FILE_COLUMN in df.columns else []
    return (df.select(*typed, *kept, found.alias("faults"), cells.alias("record"))
            .withColumn("row_status", F.when(F.size("faults") > 0, BAD).otherwise(GOOD))
            .withColumn("record", F.when(F.col("row_status") == BAD, F.col("record"))))


def rename_columns(df: DataFrame, header_map: dict[str, str]) -> DataFrame:
    """Mapped headers -> column names, in map order; unmapped columns dropped,
    mapped columns absent from the file skipped."""
    return df.select(*[F.col(f"`{src}`").alias(dst) for src, dst in header_map.items()
                       if src in df.columns])


def apply_schema(df: DataFrame, schema: T.StructType, required=(), *,
                 strict: bool = True) -> DataFrame:
    """Cast to ``schema`` in its column order. Absent optional columns become
    typed nulls; an absent required column raises. ``strict`` casts fail the
    job on malformed numbers or dates (as the reference does); otherwise they
    become null."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"input lacks required columns {missing}")
    cols = []
    for f in schema.fields:
        if f.name not in df.columns:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif df.schema[f.name].dataType == f.dataType:
            cols.append(F.col(f.name))
        else:
            c = F.col(f.name)
            cols.append((c.cast(f.dataType) if strict else c.try_cast(f.dataType)).alias(f.name))
    return df.select(*cols)


def with_audit(df: DataFrame, run_ts: str, source: str) -> DataFrame:
    return df.withColumns({AUDIT_COLUMNS[0]: F.lit(run_ts), AUDIT_COLUMNS[1]: F.lit(source)})


def typed_orders(raw: DataFrame, *, strict: bool = True) -> DataFrame:
    """Header-named text columns -> the 21 typed order columns."""
    return apply_schema(rename_columns(raw, ORDER_HEADERS), ORDERS_SCHEMA, ORDERS_REQUIRED,
                        strict=strict)


def typed_stock(raw: DataFrame, *, strict: bool = True) -> DataFrame:
    """Header-named text columns -> the 9 typed stock columns."""
    return apply_schema(rename_columns(raw, STOCK_HEADERS), STOCK_SCHEMA, STOCK_REQUIRED,
                        strict=strict)


def ingest_labelled(spark: SparkSession, path: str, run_ts: str, header_map: dict[str, str], schema: T.StructType,
                    required=(), *, source: str | None = None, multi_line: bool = False) -> DataFrame:
    """A directory of extracts, each file under its own header, as labelled rows
    (:func:`label_rows`) with audit columns; the source is each row's own file
    unless one is named."""
    rows = label_rows(read_csv_mixed(spark, path, header_map, required, multi_line=multi_line), schema, required)
    return rows.withColumns({AUDIT_COLUMNS[0]: F.lit(run_ts),
                             AUDIT_COLUMNS[1]: F.lit(source) if source else F.col(FILE_COLUMN)}).drop(FILE_COLUMN)


def ingest_orders(spark: SparkSession, path: str, run_ts: str, *, source: str | None = None,
                  strict: bool = True, multi_line: bool = False, read=None) -> DataFrame:
    """CSV order extract -> raw order table (typed, plus audit columns). ``read``, if
    given, reads the extract in place of ``read_csv``."""
    raw = read(spark, path) if read else read_csv(spark, path, multi_line=multi_line)
    return with_audit(typed_orders(raw, strict=strict),
                      run_ts, source or path)


def ingest_stock(spark: SparkSession, path: str, run_ts: str, *, source: str | None = None,
                 strict: bool = True, multi_line: bool = False, read=None) -> DataFrame:
    """CSV stock extract -> raw stock table (typed, plus audit columns); ``read`` as for
    orders."""
    raw = read(spark, path) if read else read_csv(spark, path, multi_line=multi_line)
    return with_audit(typed_stock(raw, strict=strict),
                      run_ts, source or path)


def write_csv(df: DataFrame, path: str, header_map: dict[str, str], *, compression: str = "none") -> None:
    """Write ``df`` as an extract with export headers (used to build test
    extracts from tables). Spaces are written as they are. Of the codecs, only
    bzip2 files can still be read in byte ranges."""
    inverse = {v: k for k, v in header_map.items()}
    (df.select(*[F.col(c).cast("string").alias(inverse.get(c, c)) for c in df.columns])
     .write.mode("overwrite")
     .option("header", "true")
     .option("escape", '"')
     .option("ignoreLeadingWhiteSpace", "false")
     .option("ignoreTrailingWhiteSpace", "false")
     .option("compression", compression)
     .csv(path))
