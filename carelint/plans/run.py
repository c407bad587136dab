"""Running checks and storing what they found.

Layout under one output folder: ``results`` (a partition per run, check and version),
``commits`` (which versions of a check's rows hold), ``runs`` and ``check_log`` (append-only status
events; the current state is the latest event), ``shared`` (answers that a run's checks share).  A version is
written to a folder of its own and holds once its commit is, so a crash at any point leaves the
rows of before; re-running a check of a run gives the same rows, and a lost executor only repeats
tasks.

A version holds the rows of one run, check and target table (or of all tables), and no writer reads or rewrites
another's rows: what holds is decided when the store is read.  So writers for different tables never
lose each other's rows, in whatever order they commit.  Commits are ordered by a number, one more than
any that the writer has seen, not by clocks.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext
from dataclasses import dataclass, replace
from decimal import Decimal

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelint.context import Context, ten_year_lookback
from carelint.operators import CHECKS
from carelint.operators.shared import SharedScans
from carelint.plans import registry as reg

RESULTS = (
    "run_id string, check_id string, check_name string, row_num decimal(10,2), edc_table string, source_table string, "
    "code_type string, metric string, value_num decimal(38,10), value_str string, threshold_num decimal(38,10), "
    "exception_flag boolean, details string, created_at timestamp_ntz"
)
RUNS = (
    "run_id string, db_param string, schema_name string, mode string, selector string, part string, target_table string, "
    "prev_db_param string, prev_schema_name string, start_date string, end_date string, started_at timestamp_ntz, "
    "ended_at timestamp_ntz, status string, error_message string"
)
CHECK_LOG = (
    "run_id string, check_id string, check_name string, row_num decimal(10,2), proc_name string, status string, "
    "started_at timestamp_ntz, ended_at timestamp_ntz, error_message string"
)
EVENT = ", event_at timestamp_ntz, event_no bigint"
COMMITS = "run_id string, row_num decimal(10,2), version string, target string, seq bigint"
#: Checks whose rows can't be told apart by the table they were asked for: a run for one table
#: replaces all rows that a run for all tables has left.
NOT_SPLIT = frozenset({"1.14", "1.15", "2.01", "2.07", "2.09", "3.01", "3.02", "3.04", "3.05", "3.06", "4.03"})


def number_text(value: Column) -> Column:
    """A number as text: whole numbers without a decimal point."""
    whole = (value == F.floor(value)) & (F.abs(value) < F.lit(1e15))
    return F.when(whole, value.cast("bigint").cast("string")).otherwise(value.cast("string"))


def result_rows(rows: DataFrame, run_id: str, check_id: str, check_name: str, row_num: str, edc_table: str | None) -> DataFrame:
    """A check's rows in the stored shape."""
    return rows.select(
        F.lit(run_id).alias("run_id"), F.lit(check_id).alias("check_id"), F.lit(check_name).alias("check_name"),
        F.lit(row_num).cast("decimal(10,2)").alias("row_num"), F.coalesce("edc_table", F.lit(edc_table).cast("string")).alias("edc_table"),
        "source_table", "code_type", "metric", F.col("value_num").try_cast("decimal(38,10)").alias("value_num"),
        F.coalesce("value_str", number_text(F.col("value_num"))).alias("value_str"),
        F.col("threshold_num").try_cast("decimal(38,10)").alias("threshold_num"), "exception_flag", "details",
        F.current_timestamp().cast("timestamp_ntz").alias("created_at"))


@dataclass(frozen=True)
class Store:
    """The output folder, on any file system Spark can reach."""

    spark: SparkSession
    path: str

    def _partition(self, run_id: str, row_num: str) -> str:
        return f"{self.path}/results/run_id={run_id}/row_num={row_num}"

    def _read(self, name: str, schema: str, partition: tuple[str, ...] = ()) -> DataFrame:
        """A stored table under today's schema; columns that older files lack are null."""
        full = T._parse_datatype_string(schema)
        try:
            return self.spark.read.schema(full).parquet(f"{self.path}/{name}").select(*full.names)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], full)

    def _held(self) -> DataFrame:
        """The versions that hold: of each run, check and target the last one, unless a later one is for all tables.

        ``newer`` lists the tables that versions later than the one for all tables are about.  Of two
        commits with one number neither had seen the other: the greater version holds for one target,
        and that of a table beside the one for all.
        """
        key = ["run_id", "row_num"]
        commits = self._read("commits", COMMITS + EVENT).withColumn("seq", F.coalesce("seq", F.lit(0)))
        # Commits of older stores have no number; their clocks decide among them.
        last = commits.groupBy(*key, "target").agg(F.max_by(F.struct("version", "seq"), F.struct("seq", F.when(F.col("seq") == 0, F.col("event_at")), "version")).alias("x"))
        last = last.select(*key, "target", "x.version", "x.seq")
        whole = last.where("target is null").select(*key, F.col("seq").alias("whole_seq"))
        live = last.join(whole, key, "left").where("target is null or whole_seq is null or seq >= whole_seq")
        newer = live.where("target is not null").groupBy(*key).agg(F.collect_set("target").alias("newer"))
        return live.join(newer, key, "left").select(*key, "version", "target", "newer")

    def results(self) -> DataFrame:
        """The rows that hold.  Of a version for all tables those about a table with a newer version of its own
        go, or all of them if the check's rows aren't split by table."""
        rows = self._read("results", RESULTS + ", version string")
        about = F.coalesce(F.array_contains("newer", F.upper("source_table")) | ((F.col("source_table") == "ALL") & F.array_contains("newer", F.upper("edc_table"))), F.lit(False))
        whole = F.col("row_num").isin(*[Decimal(n) for n in sorted(NOT_SPLIT)])
        stays = F.col("target").isNotNull() | F.col("newer").isNull() | ~(about | whole)
        return rows.join(self._held(), ["run_id", "row_num", "version"]).where(stays).select(*T._parse_datatype_string(RESULTS).names)

    def write_results(self, rows: DataFrame, run_id: str, row_num: str, target: str | None = None) -> None:
        """Replace the check's rows of the run: those of the target table, or of all tables.

        The rows are written whatever other writers do, and hold once their commit is there.
        """
        version = str(uuid.uuid4())
        # Rebalancing writes few files for few rows and keeps big results spread out.
        rows.drop("run_id", "row_num").hint("rebalance").write.parquet(f"{self._partition(run_id, row_num)}/version={version}")
        seen = self._read("commits", COMMITS).where((F.col("run_id") == run_id) & (F.col("row_num") == F.lit(row_num).cast("decimal(10,2)"))).agg(F.max("seq")).first()[0]
        self._append("commits", COMMITS, [(run_id, Decimal(row_num), version, target, (seen or 0) + 1, _now(), 0)])

    def _append(self, name: str, schema: str, values: list[tuple]) -> None:
        # A folder of its own per append: concurrent checks (and drivers) never share a commit.
        self.spark.createDataFrame(values, schema + EVENT).coalesce(1).write.parquet(f"{self.path}/{name}/batch={uuid.uuid4()}")

    def _latest(self, name: str, schema: str, *key: str) -> DataFrame:
        events = self._read(name, schema + EVENT)
        fields = [f.name for f in T._parse_datatype_string(schema).fields]
        last = F.max_by(F.struct(*fields), F.struct("event_at", "event_no")).alias("last")
        return events.groupBy(*key).agg(last).select("last.*")

    def runs(self) -> DataFrame:
        return self._latest("runs", RUNS, "run_id")

    def check_log(self) -> DataFrame:
        return self._latest("check_log", CHECK_LOG, "run_id", "check_id")


def _shared_scans(ctx: Context, store: Store, run_id: str, todo: list) -> SharedScans | None:
    """The answers that the checks share, or None if they can't be had."""
    shared = SharedScans(ctx.spark, f"{store.path}/shared/run_id={run_id}/{uuid.uuid4()}")
    for c, check in todo:
        try:
            shared.record(c.PROC_NAME, lambda check=check: check(ctx))
        except Exception:  # the check itself will tell; it has no part in the scan
            shared.forget(c.PROC_NAME)
    try:
        shared.scan()
    except Exception:
        return None
    return shared


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def run_checks(
    ctx: Context, out: str, *, mode: str = "ALL", selector: str | None = None, part: str = "all", max_parallel: int = 10,
    registry_rows: DataFrame | None = None, checks: Mapping[str, Callable[[Context], DataFrame]] | None = None,
    run_id: str | None = None, names: Mapping[str, str] | None = None, lookback: bool = False, share: bool = True,
) -> str:
    """Run the selected checks, keep going when one fails, and store results and status.

    New checks are added by passing their functions in ``checks`` and rows for them in
    ``registry_rows``.  Checks run as concurrent Spark jobs; where the session's scheduler mode is
    FAIR, each has a pool of its own.  With ``lookback`` the date window starts ten years before the
    anchor day, unless the context has a start of its own.  With ``share`` the counts and id sets that
    several checks ask for come from one scan of each table (``operators/shared.py``); where that
    scan fails, every check scans by itself, so that only those fail which can't be answered.
    """
    if lookback and ctx.start is None:
        ctx = replace(ctx, start=ten_year_lookback(ctx.as_of))
    spark, store = ctx.spark, Store(ctx.spark, out.rstrip("/"))
    run_id = run_id or str(uuid.uuid4())
    functions = {f.__name__: f for f in CHECKS.values()} | dict(checks or {})
    chosen = reg.select_checks(registry_rows if registry_rows is not None else reg.registry(spark), mode, selector, part).collect()
    names = names or {}
    started = _now()

    def run_event(no: int, status: str, ended: dt.datetime | None = None) -> None:
        text = [d.isoformat() if d else None for d in (ctx.start, ctx.end)]
        store._append("runs", RUNS, [(
            run_id, names.get("db"), names.get("schema"), (mode or "ALL").upper(), selector, (part or "all").lower(), ctx.target,
            names.get("prev_db"), names.get("prev_schema"), *text, started, ended, status, None, _now(), no)])

    run_event(0, "RUNNING")
    first, todo = [], []
    for c in chosen:
        name = (c.PROC_NAME or "").strip()
        now = _now()
        row = (run_id, c.CHECK_ID, c.CHECK_NAME, c.CHECK_NUM, c.PROC_NAME)
        if not name:
            first.append((*row, "SKIPPED", now, now, "PROC_NAME is empty", now, 0))
        elif name not in functions:
            first.append((*row, "FAILED", now, now, f"Unknown PROC_NAME: {name}", now, 0))
        else:
            first.append((*row, "PENDING", None, None, None, now, 0))
            todo.append((c, functions[name]))
    if first:
        store._append("check_log", CHECK_LOG, first)
    failed = sum(r[5] == "FAILED" for r in first)
    shared = _shared_scans(ctx, store, run_id, todo) if share and len(todo) > 1 else None

    def one(item) -> bool:
        c, check = item
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", c.CHECK_NAME)
        row, begun = (run_id, c.CHECK_ID, c.CHECK_NAME, c.CHECK_NUM, c.PROC_NAME), _now()
        store._append("check_log", CHECK_LOG, [(*row, "RUNNING", begun, None, None, _now(), 1)])
        try:
            number = str(c.CHECK_NUM)
            with shared.serving(c.PROC_NAME) if shared else nullcontext():
                found = check(ctx)
            rows = result_rows(found, run_id, c.CHECK_ID, c.CHECK_NAME, number, c.EDC_TABLE)
            store.write_results(rows, run_id, number, ctx.target)
            end = ("SUCCEEDED", begun, _now(), None)
        except Exception as e:  # one failing check must not stop the run
            end = ("FAILED", begun, _now(), str(e))
        store._append("check_log", CHECK_LOG, [(*row, *end, _now(), 2)])
        return end[0] == "SUCCEEDED"

    with ThreadPoolExecutor(max_workers=max(1, int(max_parallel or 10))) as pool:
        failed += sum(not ok for ok in pool.map(one, todo))
    run_event(1, "PARTIAL" if failed else "SUCCEEDED", _now())
    return run_id
