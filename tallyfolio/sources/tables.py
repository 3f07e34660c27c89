"""Core tables as partitioned parquet folders.

Each table lies under ``{root}/{name}``. Tables with rows per account are partitioned by their date
column, so that a date filter anywhere above the scan prunes folders; short series are partitioned
by a ``period`` column holding the first day of the year.

A merge reads and rewrites only the partitions its batch touches. They are written as a new generation of
folders beside the live ones and become live in one step (``published``), for all tables of a transaction
together. A lost executor only repeats its tasks, a lost driver leaves folders that nobody reads, and two
merges of one partition can't both win: the later one computes anew.
"""

from __future__ import annotations

import datetime as dt
import threading
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import partial
from string import Formatter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfolio.operators.filters import between_dates
from tallyfolio.operators.merge import key_violations, upsert_fill, upsert_ignore, upsert_or_drop, upsert_update
from tallyfolio.schemas import CORE_TABLES, CoreTable
from tallyfolio.sources.published import GENERATION, Conflict, Published, State

PERIOD = "period"

# What latest rows are derived from: a change on a day makes those of that day and after it stale.
LATEST_SOURCES = {"positions": "holdings", "trades": "holdings", "delta_nav": "accounts", "calendar": "accounts"}
LATEST_KEPT = 10


def conform(df: DataFrame, table: str, extra: Sequence[str] = ()) -> DataFrame:
    """``df`` in a core table's columns, order and types; columns it lacks are NULL. ``extra`` follow."""
    present = set(df.columns)
    return df.select(
        [
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in CORE_TABLES[table].schema.fields
        ]
        + list(extra)
    )


class Warehouse:
    """The core tables under one root.

    ``grain`` (``month`` or ``year``) widens the partitions of the daily tables, for histories too
    small to fill a folder a day.
    """

    def __init__(self, spark: SparkSession, root: str, grain: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.grain = grain
        self.published = Published(spark, self.root)

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _stage_path(self, table: str) -> str:
        """A folder per batch, so that loads of one table at a time don't read each other's."""
        return f"{self.root}/_stage/{table}/{uuid.uuid4().hex}"

    def _grain(self, spec: CoreTable) -> str:
        return self.grain if self.grain and spec.grain == "day" else spec.grain

    def _partition(self, spec: CoreTable) -> str:
        return spec.date if self._grain(spec) == "day" else PERIOD

    def _with_partition(self, df: DataFrame, spec: CoreTable) -> DataFrame:
        grain = self._grain(spec)
        return df if grain == "day" else df.withColumn(PERIOD, F.trunc(spec.date, grain))

    def _scan(self, spec: CoreTable, live: Mapping[str, str]) -> DataFrame:
        """The rows of the given live partitions, with the partition column."""
        partition = self._partition(spec)
        stored = spec.schema
        if partition == PERIOD:
            stored = T.StructType([*spec.schema.fields, T.StructField(PERIOD, T.DateType())])
        path = self.path(spec.name)
        live = {value: generation for value, generation in live.items() if generation}  # "" is a partition without rows
        if not live:
            return self.spark.createDataFrame([], stored)
        folders = [f"{path}/{GENERATION}={generation}/{partition}={value}" for value, generation in sorted(live.items())]
        whole = T.StructType([*stored.fields, T.StructField(GENERATION, T.StringType())])
        return self.spark.read.schema(whole).option("basePath", path).parquet(*folders).drop(GENERATION)

    def read(
        self, table: str, start: dt.date | None = None, end: dt.date | None = None, state: State | None = None
    ) -> DataFrame:
        """The table's rows in a closed date range, or all; an absent table is empty. ``state`` is what
        ``published.state()`` gave, for several reads of the same step."""
        spec = CORE_TABLES[table]
        live = self.published.live(state or self.published.state(), table)
        first, last = (None if d is None else str(_period(d, self._grain(spec))) for d in (start, end))
        inside = {v: g for v, g in live.items() if (first is None or v >= first) and (last is None or v <= last)}
        stored = self._scan(spec, inside)
        if self._partition(spec) == PERIOD:
            # a date filter does not reach the folders by itself, as they are named by their period
            if first is not None:
                stored = stored.filter(F.col(PERIOD) >= F.lit(first).cast("date"))
            if last is not None:
                stored = stored.filter(F.col(PERIOD) <= F.lit(last).cast("date"))
        return between_dates(stored.select(*spec.columns), spec.date, start, end)

    # --- Latest rows: derived tables, a folder per day they are of ---

    def _files(self, path: str):
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop

    def _latest_days(self, name: str) -> list[dt.date]:
        """Days of complete latest rows, ascending: one listing, whatever they hold."""
        store, root = self._files(f"{self.root}/_latest/{name}")
        if not store.exists(root):
            return []
        names = [status.getPath().getName() for status in store.listStatus(root)]
        days = sorted(dt.date.fromisoformat(name.removeprefix("day=")) for name in names if name.startswith("day="))
        return [d for d in days if store.exists(self._files(f"{root}/day={d}/_SUCCESS")[1])]

    def latest(self, name: str, before: dt.date) -> tuple[dt.date, DataFrame] | None:
        """The newest latest rows of a day before ``before``, with their day."""
        days = [d for d in self._latest_days(name) if d < before]
        if not days:
            return None
        return days[-1], self.spark.read.parquet(f"{self.root}/_latest/{name}/day={days[-1]}")

    def keep_latest(self, name: str, day: dt.date, rows: DataFrame) -> None:
        """Store latest rows of ``day``. They may be computed from an earlier day's, never their own.
        Of the older ones all but ``LATEST_KEPT`` go; a range before those reads history."""
        rows.write.mode("overwrite").parquet(f"{self.root}/_latest/{name}/day={day}")
        for old in self._latest_days(name)[:-LATEST_KEPT]:
            self.drop_stage(f"{self.root}/_latest/{name}/day={old}")

    def _forget_latest(self, table: str, day: dt.date) -> None:
        """Drop the latest rows that a change of ``table`` on ``day`` could make wrong."""
        store, root = self._files(f"{self.root}/_latest")
        if table not in LATEST_SOURCES or not store.exists(root):
            return
        for status in store.listStatus(root):
            name = status.getPath().getName()
            if name.startswith(LATEST_SOURCES[table]):
                for stale in self._latest_days(name):
                    if stale >= day:
                        self.drop_stage(f"{root}/{name}/day={stale}")

    def sql(self, query: str, args: dict | None = None) -> DataFrame:
        """A query over the core tables, written ``{name}`` in it; ``:name`` parameters in ``args``. All tables are
        as of one step. A condition on a table's own date reads the folders it can be true in only."""
        names = {name for _, name, _, _ in Formatter().parse(query) if name}
        state = self.published.state()
        return self.spark.sql(query, args=args, **{name: self._by_date(name, state) for name in names})

    def _by_date(self, table: str, state: State) -> DataFrame:
        """The table for queries whose bounds are not known yet.

        A folder of a period is not named by its dates. So its rows meet the days of the live periods, at most
        some hundred a year: a condition on the date holds for the day as well, and from the days left Spark
        knows the periods to read when it runs (dynamic partition pruning)."""
        spec = CORE_TABLES[table]
        live = self.published.live(state, table)
        rows = self._scan(spec, live)
        if self._partition(spec) != PERIOD or not any(live.values()):
            return rows.select(*spec.columns)
        begun = self.spark.createDataFrame([(dt.date.fromisoformat(v),) for v in live if live[v]], "__period date")
        span = F.expr("INTERVAL 1 YEAR" if self._grain(spec) == "year" else "INTERVAL 1 MONTH")
        last = F.date_sub((F.col("__period") + span).cast("date"), 1)
        days = begun.select("__period", F.explode(F.sequence("__period", last)).alias("__day"))
        same = (F.col(PERIOD) == F.col("__period")) & (F.col(spec.date) == F.col("__day"))
        return rows.join(F.broadcast(days), same).select(*spec.columns)

    def stage(self, table: str, batch: DataFrame, extra: Sequence[str] = ()) -> tuple[DataFrame, str]:
        """Write a batch beside the core tables, in a folder of its own, and read it back.

        The merge looks at the batch three times (its partitions, its keys, its rows); from here
        those are column-pruned parquet reads and the report files are parsed once. ``extra`` columns
        go along, to choose between repeated keys.
        """
        spec = CORE_TABLES[table]
        path = self._stage_path(table)
        rows = self._with_partition(conform(batch, table, extra), spec)
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path), path

    def keep(self, rows: DataFrame) -> tuple[DataFrame, str]:
        """Rows written beside the core tables and read back; drop their folder when done."""
        path = self._stage_path("rows")
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path), path

    def drop_stage(self, path: str) -> None:
        """Delete the folder of a batch."""
        store, folder = self._files(path)
        store.delete(folder, True)

    def transaction(self) -> Transaction:
        """Merges of one ``with`` block, published in one step at its end."""
        return Transaction(self)

    def merge(
        self,
        table: str,
        batch: DataFrame,
        mode: str = "update",
        on_duplicate: str = "error",
        order: Sequence[str] = (),
        transaction: Transaction | None = None,
    ) -> None:
        """Merge a batch by primary key.

        ``mode``: ``update`` replaces rows with the batch's keys, ``ignore`` keeps them, ``fill``
        keeps them but fills their NULLs, ``repair`` replaces them or, where ``gone`` is true, drops them. A key twice in an ``update`` batch is an error, or with
        ``on_duplicate="latest"`` its last row by ``order`` counts. Loads may run side by side; one that finds a
        partition changed since it began is computed again. With ``transaction`` nothing is seen before its end.
        """
        if transaction is None:
            with self.transaction() as transaction:
                transaction.add(table, batch, mode, on_duplicate, order)
        else:
            transaction.add(table, batch, mode, on_duplicate, order)

    def key_violations(self, table: str, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
        """Keys of the stored rows that are repeated or NULL: none, unless files were put there by hand."""
        return key_violations(self.read(table, start, end), CORE_TABLES[table].key)

    def vacuum(self, keep_steps: int = 10, older_than: float = 86_400.0) -> list[str]:
        """Drop folders that no recent step uses, see ``Published.vacuum``."""
        return self.published.vacuum(CORE_TABLES, keep_steps, older_than)


@dataclass
class _Merge:
    """One batch of a transaction: where it is staged, what it touches, and the generation it wrote."""

    table: str
    operator: Callable[[DataFrame, DataFrame, Sequence[str]], DataFrame]
    staged: DataFrame
    path: str
    touched: dict[str, dt.date]
    base: State | None = None
    generation: str | None = None


class Transaction:
    """Merges that become visible together. Batches may be added from several threads; a table once."""

    def __init__(self, warehouse: Warehouse, attempts: int = 5):
        self.warehouse = warehouse
        self.attempts = attempts
        self.merges: dict[str, _Merge] = {}
        self.lock = threading.Lock()
        self.base = warehouse.published.state()

    def __enter__(self) -> Transaction:
        return self

    def add(self, table: str, batch: DataFrame, mode: str, on_duplicate: str, order: Sequence[str]) -> None:
        house, spec = self.warehouse, CORE_TABLES[table]
        operator = {"update": upsert_update, "ignore": upsert_ignore, "fill": upsert_fill, "repair": upsert_or_drop}[mode]
        if mode == "repair":
            order = ["gone"]
        if mode == "update":
            operator = partial(operator, on_duplicate=on_duplicate, order=order)
        with self.lock:
            if table in self.merges:
                raise ValueError(f"{table} twice in a transaction")
            self.merges[table] = None
        staged, path = house.stage(table, batch, [c for c in order if c not in spec.columns])
        found = _Merge(table, operator, staged, path, {})
        self.merges[table] = found
        # One value per partition touched: bounded by the days of history, not by the rows.
        days = staged.groupBy(house._partition(spec)).agg(F.min(spec.date).alias("first")).collect()
        if any(row["first"] is None for row in days):
            raise ValueError(f"null {spec.date} in a batch for {table}")
        found.touched = {str(row[0]): row["first"] for row in days}
        self._write(found, self.base)

    def _write(self, merge: _Merge, base: State) -> None:
        """Write the touched partitions, as they are after ``base`` with the batch, as a new generation."""
        house, spec = self.warehouse, CORE_TABLES[merge.table]
        self._discard(merge)
        merge.base = base
        if not merge.touched:
            return
        partition = house._partition(spec)
        merge.generation = uuid.uuid4().hex[:16]
        live = house.published.live(base, merge.table)
        columns = [c for c in merge.staged.columns if c in spec.columns or c == partition]
        core = house._scan(spec, {v: g for v, g in live.items() if v in merge.touched}).select(*columns)
        rows = merge.operator(core, merge.staged, spec.key)
        # a folder of its own, as two jobs can't write to one; a large partition is split over several tasks
        path = f"{house.path(merge.table)}/{GENERATION}={merge.generation}"
        rows.hint("rebalance", F.col(partition)).write.partitionBy(partition).parquet(path)

    def _changes(self, merge: _Merge) -> dict[str, str]:
        """The touched partitions and their generation; a repair may have left one without rows, hence without folder."""
        names = self.warehouse.published.folder.names(f"{merge.table}/{GENERATION}={merge.generation}")
        written = {name.partition("=")[2] for name in names}
        return {value: merge.generation if value in written else "" for value in merge.touched}

    def _discard(self, merge: _Merge) -> None:
        """Drop a generation that was not published."""
        if merge.generation:
            self.warehouse.published.folder.delete(f"{merge.table}/{GENERATION}={merge.generation}")
            merge.generation = None

    def __exit__(self, kind, error, trace) -> None:
        merges = [m for m in self.merges.values() if m]
        try:
            if kind is None:
                self._publish([m for m in merges if m.touched])
        except Exception:
            kind = Exception
            raise
        finally:
            for merge in merges:
                self.warehouse.drop_stage(merge.path)
                if kind is not None and issubclass(kind, Exception):
                    self._discard(merge)

    def _publish(self, merges: list[_Merge]) -> None:
        for attempt in range(self.attempts):
            for merge in merges:
                self.warehouse._forget_latest(merge.table, min(merge.touched.values()))
            try:
                if merges:
                    changes = {m.table: self._changes(m) for m in merges}
                    self.warehouse.published.publish(self.base, changes)
                break
            except Conflict:
                if attempt + 1 == self.attempts:
                    raise
                self.base = self.warehouse.published.state()
                for merge in merges:
                    self._write(merge, self.base)
        for merge in merges:  # what a reader of the step before may have stored meanwhile
            self.warehouse._forget_latest(merge.table, min(merge.touched.values()))


def _period(day: dt.date, grain: str) -> dt.date:
    """The first day of the day's month or year, or the day."""
    return day if grain == "day" else day.replace(day=1) if grain == "month" else day.replace(month=1, day=1)
