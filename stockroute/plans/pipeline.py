"""The batch pipeline: raw extracts -> validated lines and stock -> allocation
and the three data products.

Every stage writes its tables and the next stage reads them back, so each
job's lineage starts at stored files: a lost executor recomputes at most one
stage, and the products are derived from the stored allocation table instead
of recomputing the join for every output (the reference recomputes it for
each of its writes and counts).

    python -m stockroute.plans.pipeline --orders <csv dir> --stock <csv dir> \
        --root <shared folder> [--run-ts 2024-06-30T00:00:00]
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import allocate as al
from ..operators import enrich, output, products, rule_tables, stock, summary, ticket_ids, validate
from ..rules import DEFAULT_RULES, Rules
from ..schemas import (AUDIT_COLUMNS, CASE_2, EXCEPTION, ORDER_HEADERS, ORDERS_REQUIRED, ORDERS_SCHEMA, STOCK_HEADERS,
                       STOCK_REQUIRED, STOCK_SCHEMA, VALID)
from ..session import build_session
from ..sources import csv as csv_source
from ..sources.csv_split import read_csv_split
from ..sources.tables import part_path, read_table, table_exists, table_format, write_split, write_table

#: Tables that one write makes, as partitions by status.
VALIDATED = "validated_orders"
BY_STATUS = {"valid_orders": VALID, "exceptions": EXCEPTION}
#: Raw tables and their quarantine, by one write each where it is asked for.
RAW = {
    "sales_orders_raw": (ORDER_HEADERS, ORDERS_SCHEMA, ORDERS_REQUIRED),
    "stock_availability_raw": (STOCK_HEADERS, STOCK_SCHEMA, STOCK_REQUIRED),
}
TICKET_REGISTER = "order_validation_ticket_register"
REJECTED = ("record", "faults", *AUDIT_COLUMNS)


def rejected_name(raw: str) -> str:
    return raw.removesuffix("_raw") + "_rejected"


def _observed(df: DataFrame, name: str, **counts) -> tuple[DataFrame, Observation]:
    """``df`` with row counts gathered while it is written (no extra pass)."""
    obs = Observation(name)
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.count_if(cond).alias(k) for k, cond in counts.items()]
    return df.observe(obs, *aggs), obs


@dataclass
class Layout:
    """Where tables live: databases in the session catalog, or folders under
    ``root`` (a shared location such as the cluster's checkpoint folder)."""
    root: str | None = None
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    fmt: str | None = None
    #: Raw rows that do not type go to ``*_rejected`` tables.
    quarantine: bool = False
    #: Tickets keep their ids over runs, by the table ``TICKET_REGISTER``.
    carry_tickets: bool = False

    def _place(self, layer: str) -> dict:
        db = getattr(self, layer)
        return {"root": f"{self.root.rstrip('/')}/{db}", "fmt": self.fmt} if self.root else {"database": db}

    def write(self, df: DataFrame, layer: str, name: str, *, append: bool = False) -> str:
        return write_table(df, name, append=append, **{"fmt": self.fmt, **self._place(layer)})

    def exists(self, spark: SparkSession, layer: str, name: str) -> bool:
        place = self._place(layer)
        return table_exists(spark, name, database=place.get("database"), root=place.get("root"))

    def write_by_status(self, df: DataFrame, layer: str) -> tuple[dict[str, str], dict[str, int]]:
        """Valid lines and exceptions by one write; their places and row counts."""
        return write_split(df, "validation_status", BY_STATUS, VALIDATED, **{"fmt": self.fmt, **self._place(layer)})

    def write_raw(self, df: DataFrame, name: str) -> tuple[dict[str, str], dict[str, int]]:
        """Typed rows and rejected ones by one write; their places and row counts."""
        columns = {name: tuple(c for c in df.columns if c not in ("faults", "record", "row_status")), rejected_name(name): REJECTED}
        return write_split(df, "row_status", {name: csv_source.GOOD, rejected_name(name): csv_source.BAD}, name + "_read",
                           columns=columns, **{"fmt": self.fmt, **self._place("bronze")})

    def _part(self, name: str) -> tuple[str, str, list[str] | None] | None:
        """Table, value and columns of the partition that ``name`` is kept as."""
        if name in BY_STATUS:
            return VALIDATED, BY_STATUS[name], None
        if self.quarantine:
            for raw, (_, schema, _) in RAW.items():
                if name == raw:
                    return raw + "_read", csv_source.GOOD, [*schema.names, *AUDIT_COLUMNS]
                if name == rejected_name(raw):
                    return raw + "_read", csv_source.BAD, list(REJECTED)
        return None

    def read(self, spark: SparkSession, layer: str, name: str) -> DataFrame:
        part = self._part(name) if self.root and table_format(spark, self.fmt) != "delta" else None
        if not part:
            return read_table(spark, name, **self._place(layer))
        stem, value, columns = part
        df = spark.read.format(table_format(spark, self.fmt)).load(part_path(self._place(layer)["root"], stem, value))
        return df.select(*columns) if columns else df


@dataclass
class RunResult:
    tables: dict[str, str] = field(default_factory=dict)
    metrics: dict[str, int] = field(default_factory=dict)


def run_ts_now() -> str:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat()


def bronze(spark: SparkSession, layout: Layout, orders_path: str, stock_path: str, run_ts: str,
           *, strict: bool = True, multi_line: bool = False, split_multi_line: bool = False, result: RunResult) -> None:
    if layout.quarantine and split_multi_line:
        raise ValueError("rejected rows are not told apart in files read by splits")
    if layout.quarantine:
        for (name, spec), path in zip(RAW.items(), (orders_path, stock_path)):
            rows = csv_source.ingest_labelled(spark, path, run_ts, *spec, source=path, multi_line=multi_line)
            tables, counts = layout.write_raw(rows, name)
            result.tables.update(tables)
            result.metrics.update(counts)
        return
    read = read_csv_split if split_multi_line else None
    for name, df in (
            ("sales_orders_raw", csv_source.ingest_orders(spark, orders_path, run_ts,
                                                          strict=strict, multi_line=multi_line, read=read)),
            ("stock_availability_raw", csv_source.ingest_stock(spark, stock_path, run_ts,
                                                               strict=strict,
                                                               multi_line=multi_line, read=read))):
        df, obs = _observed(df, name)
        result.tables[name] = layout.write(df, "bronze", name)
        result.metrics[name] = obs.get["rows"]


def silver(spark: SparkSession, layout: Layout, run_ts: str, rules: Rules, *,
           ignore_blocked_closed: bool = False, frames: rule_tables.Frames | None = None, result: RunResult) -> None:
    orders = layout.read(spark, "bronze", "sales_orders_raw")
    clean = validate.prepare_orders(orders, ignore_blocked_closed=ignore_blocked_closed)
    tables, counts = layout.write_by_status(validate.label_orders(clean, run_ts), "silver")
    result.tables.update(tables)
    result.metrics.update(counts)
    raw_stock = layout.read(spark, "bronze", "stock_availability_raw")
    made = rule_tables.stock_filtered(raw_stock, run_ts, frames) if frames else stock.stock_filtered(raw_stock, run_ts, rules)
    prof, obs = _observed(made, "stock_filtered")
    result.tables["stock_filtered"] = layout.write(prof, "silver", "stock_filtered")
    result.metrics["stock_filtered"] = obs.get["rows"]


def carried_tickets(spark: SparkSession, layout: Layout, final: DataFrame, run_ts: str,
                    partitions: int | None = None) -> DataFrame:
    """The run's tickets under ids from the register, to which its new lines are
    appended first: a run that is repeated finds them there and gives the same ids."""
    lines = products.ticket_candidates(final)
    if not layout.exists(spark, "gold", TICKET_REGISTER):
        layout.write(ticket_ids.empty_register(spark), "gold", TICKET_REGISTER)
    fresh = ticket_ids.new_entries(lines, layout.read(spark, "gold", TICKET_REGISTER), partitions)
    layout.write(fresh, "gold", TICKET_REGISTER, append=True)
    known = ticket_ids.numbered(lines, layout.read(spark, "gold", TICKET_REGISTER))
    return products.ticket_rows(known, F.col(ticket_ids.NUMBER), run_ts)


def gold(spark: SparkSession, layout: Layout, run_ts: str, rules: Rules, *,
         ticket_partitions: int | None = None, frames: rule_tables.Frames | None = None, result: RunResult) -> None:
    valid = layout.read(spark, "silver", "valid_orders")
    stock_table = layout.read(spark, "silver", "stock_filtered")
    if frames:
        joined = rule_tables.join_stock(rule_tables.enrich_orders(valid, frames, rules), stock_table)
        actions = rule_tables.allocate_with_actions(joined, run_ts, frames, rules)
    else:
        actions = output.allocate_with_actions(al.join_stock(enrich.enrich_orders(valid, rules), stock_table), run_ts, rules)
    allocation = output.allocation_output(actions, layout.read(spark, "silver", "exceptions"), run_ts)
    case2 = F.col("case_number") == CASE_2
    out, obs = _observed(allocation, "allocation_output",
                         feasibility=case2, tickets=case2 & F.col("requires_auth"))
    result.tables["allocation_output"] = layout.write(out, "gold", "allocation_output")
    got = obs.get
    # Each product's row count follows from the allocation table.
    result.metrics.update({
        "allocation_output": got["rows"],
        "allocation_feasibility_output": got["feasibility"],
        "order_validation_ticket_pega": got["tickets"],
        "allocation_execution_delivery_output": got["rows"]})

    final = layout.read(spark, "gold", "allocation_output")
    result.tables["allocation_feasibility_output"] = layout.write(
        products.feasibility(final, rules.locations), "gold", "allocation_feasibility_output")
    tickets = (carried_tickets(spark, layout, final, run_ts, ticket_partitions) if layout.carry_tickets
               else products.tickets(final, run_ts, ticket_partitions))
    result.tables["order_validation_ticket_pega"] = layout.write(tickets, "gold", "order_validation_ticket_pega")
    result.tables["allocation_execution_delivery_output"] = layout.write(
        products.execution_delivery(final, run_ts), "gold",
        "allocation_execution_delivery_output")


def collect_metrics(spark: SparkSession, layout: Layout) -> dict[str, int]:
    """Row counts of every stored table (Parquet counts come from footers)."""
    names = {"bronze": ("sales_orders_raw", "stock_availability_raw"),
             "silver": ("valid_orders", "exceptions", "stock_filtered"),
             "gold": ("allocation_output", "allocation_feasibility_output",
                      "order_validation_ticket_pega", "allocation_execution_delivery_output")}
    return {n: layout.read(spark, layer, n).count() for layer, ns in names.items() for n in ns}


def summaries(spark: SparkSession, layout: Layout, rules: Rules = DEFAULT_RULES) -> dict[str, DataFrame]:
    """The five summary reports, from stored tables; ``rules`` are the run's (a
    line counts once in its customer group, however many plants it met)."""
    final = layout.read(spark, "gold", "allocation_output")
    valid = final.where(F.col("validation_status") == VALID)
    enriched = enrich.enrich_orders(layout.read(spark, "silver", "valid_orders"), rules)
    return {
        "location_count": summary.location_count_summary(
            layout.read(spark, "silver", "stock_filtered")),
        "exceptions": summary.exception_summary(layout.read(spark, "silver", "exceptions")),
        "customer_group": summary.customer_group_summary(enriched),
        "case": summary.case_summary(valid),
        "dashboard": summary.dashboard_summary(final),
    }


def run(spark: SparkSession, orders_path: str, stock_path: str, layout: Layout, *,
        run_ts: str | None = None, rules: Rules = DEFAULT_RULES, strict: bool = True,
        multi_line: bool = False, split_multi_line: bool = False, ignore_blocked_closed: bool = False,
        ticket_partitions: int | None = None, frames: rule_tables.Frames | None = None) -> RunResult:
    """All three stages; row counts of every table are observed during the
    writes (``collect_metrics`` recounts stored tables on demand). With ``frames``
    the rules are read from these tables, over any locations; of ``rules`` only the
    default group and start location count then."""
    ts = run_ts or run_ts_now()
    result = RunResult()
    bronze(spark, layout, orders_path, stock_path, ts, strict=strict, multi_line=multi_line,
           split_multi_line=split_multi_line, result=result)
    silver(spark, layout, ts, rules, ignore_blocked_closed=ignore_blocked_closed, frames=frames, result=result)
    gold(spark, layout, ts, rules, ticket_partitions=ticket_partitions, frames=frames, result=result)
    return result


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    ap.add_argument("--orders", required=True)
    ap.add_argument("--stock", required=True)
    ap.add_argument("--root", help="shared folder for the tables (default: session catalog)")
    ap.add_argument("--format", default=None)
    ap.add_argument("--run-ts", default=None)
    ap.add_argument("--multiline", action="store_true",
                    help="fields may hold line breaks (one split per file)")
    ap.add_argument("--multiline-split", action="store_true",
                    help="fields may hold line breaks (files read in many splits, without --quarantine)")
    ap.add_argument("--lenient", action="store_true", help="malformed numbers/dates -> null")
    ap.add_argument("--quarantine", action="store_true",
                    help="each file under its own header; rows that do not type -> *_rejected tables")
    ap.add_argument("--carry-ticket-ids", action="store_true",
                    help="tickets keep their ids over runs; new ones start after the largest given out")
    ap.add_argument("--ignore-blocked-closed", action="store_true")
    ap.add_argument("--bronze-db", default="bronze")
    ap.add_argument("--silver-db", default="silver")
    ap.add_argument("--gold-db", default="gold")
    ap.add_argument("--summaries", action="store_true",
                    help="also print the five summary reports (a few rows each)")
    args = ap.parse_args(argv)
    spark = build_session(app_name="stockroute-pipeline")
    layout = Layout(root=args.root, fmt=args.format, bronze=args.bronze_db,
                    silver=args.silver_db, gold=args.gold_db, quarantine=args.quarantine,
                    carry_tickets=args.carry_ticket_ids)
    res = run(spark, args.orders, args.stock, layout, run_ts=args.run_ts,
              strict=not args.lenient, multi_line=args.multiline, split_multi_line=args.multiline_split,
              ignore_blocked_closed=args.ignore_blocked_closed)
    report = {"tables": res.tables, "metrics": res.metrics}
    if args.summaries:
        # Grouped counts: one row per status value, so bounded by the rules.
        report["summaries"] = {k: [r.asDict() for r in df.collect()]
                               for k, df in summaries(spark, layout).items()}
    print(json.dumps(report, ensure_ascii=False, default=str))


if __name__ == "__main__":
    main()
