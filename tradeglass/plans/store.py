"""Stored tables on a shared file system, as plain parquet.

Large tables are partitioned by day (or hour) and written by dynamic partition overwrite: only touched
partitions are rewritten.  Small tables are written whole as numbered versions; a version counts once
its ``_SUCCESS`` marker exists, so a failed write leaves the previous one in force.  Tables in buckets are written
by bucket, and a small table of versions tells where each bucket lies.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructType

from tradeglass.functions.buckets import bucket_of
from tradeglass.functions.dates import at
from tradeglass.operators.upsert import first_per_key, merge_rows, unique_trades
from tradeglass.schemas import conform, schema_of
from tradeglass.session import cut_lineage

PARTITIONED = {
    "trades": "trade_date date",
    "market_panes": "trade_date date",
    "market_closes": "trade_date date",
    "asset_closes": "trade_date date",
    "markets_daily": "stat_date date",
    "assets_daily": "stat_date date",
    "assets_hourly": "stat_time timestamp",
    "fee_withdrawals": "id_range bigint",
}
# Tables partitioned by ranges of a number, and how many numbers a range holds.
RANGES = {"fee_withdrawals": ("transfer_id", 1 << 20)}
# More ranges than that are not listed in a filter: their bounds are.
LISTED_RANGES = 1_000
# Columns whose hash tells the bucket, and the number of buckets.
BUCKETED = {"orderbook": (("base_asset_id", "quote_asset_id"), 64)}
# Order within the files of a table, so that ranges of it skip row groups.
SORTED = {"trades": "trade_id", "fee_withdrawals": "transfer_id"}
# How long a version that was replaced stays for its readers: longer than any job lasts.
VERSION_AGE = timedelta(hours=24)


# What changed about a stored trade when it is priced again.
REPRICED = ("volume", "usd_price")


@dataclass(frozen=True)
class Touched:
    """An entry of the ledger of touched days; ``kept`` once panes and closes hold what the trades hold."""

    entry: str
    days: list[date]
    kept: bool


@dataclass(frozen=True)
class Merged:
    """What a merge of trades touched: its rows (one per id), their days and time range, the days that had to
    be rewritten, and the entry in the ledger of touched days (None if nothing changed)."""

    rows: DataFrame
    days: list[date]
    rewritten: list[date]
    first: datetime
    last: datetime
    entry: str | None = None


class Store:
    """``rows_per_file`` bounds the files of partitioned tables; by default their size follows from
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes``."""

    def __init__(self, spark: SparkSession, root: str, *, rows_per_file: int = 0, version_age: timedelta = VERSION_AGE):
        self.spark = spark
        self.root = root.rstrip("/")
        self.rows_per_file = rows_per_file
        self.version_age = version_age

    # --- files ------------------------------------------------------------------------------------

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _files(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _children(self, *parts: str) -> list[str]:
        path, files = self._path(*parts), self._files()
        if not files.exists(path):
            return []
        return [status.getPath().getName() for status in files.listStatus(path)]

    def _versions(self, table: str) -> list[int]:
        """Complete versions, oldest first."""
        numbers = sorted(int(n[2:]) for n in self._children(table) if n.startswith("v="))
        files = self._files()
        return [n for n in numbers if files.exists(self._path(table, f"v={n}", "_SUCCESS"))]

    # --- reads ------------------------------------------------------------------------------------

    def _partition_column(self, table: str) -> str | None:
        return PARTITIONED[table].split()[0] if table in PARTITIONED else None

    def read(self, table: str, *, before: int | None = None, schema_like: str | None = None) -> DataFrame:
        """The table; empty when never written.  ``before`` picks the newest version below a number."""
        if table in BUCKETED:
            return self.read_buckets(table).drop("bucket")
        schema = schema_of(schema_like or table)
        column = self._partition_column(table)
        if column is not None and column not in schema.fieldNames():
            schema = StructType([*schema, *StructType.fromDDL(PARTITIONED[table])])
        if table in PARTITIONED:
            path = f"{self.root}/{table}"
            written = bool(self._children(table))
        else:
            numbers = [n for n in self._versions(table) if before is None or n < before]
            path = f"{self.root}/{table}/v={numbers[-1]}" if numbers else ""
            written = bool(numbers)
        if not written:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path).select(*schema.fieldNames())

    # --- tables in buckets ------------------------------------------------------------------------

    def buckets_of(self, table: str, rows: DataFrame) -> list[int]:
        """The buckets that some keys fall into: at most as many as the table has."""
        keys, count = BUCKETED[table]
        return sorted(row[0] for row in rows.select(bucket_of(count, *map(F.col, keys))).distinct().collect())

    def _located(self, table: str, number: int | None = None) -> dict[int, int]:
        """The version that holds each bucket, now or as of a version."""
        versions = self._versions(f"{table}_buckets")
        if not versions:
            return {}
        path = f"{self.root}/{table}_buckets/v={versions[-1] if number is None else number}"
        return {row.bucket: row.version for row in self.spark.read.schema(schema_of(f"{table}_buckets")).parquet(path).collect()}

    def read_buckets(self, table: str, buckets: list[int] | None = None) -> DataFrame:
        """The table and its column ``bucket``, a folder level: some buckets, or all of them."""
        located = {b: v for b, v in self._located(table).items() if buckets is None or b in buckets}
        schema = schema_of(table).add("bucket", IntegerType())
        if not located:
            return self.spark.createDataFrame([], schema)
        base = f"{self.root}/{table}"
        paths = [f"{base}/v={version}/bucket={bucket}" for bucket, version in sorted(located.items())]
        return self.spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.fieldNames())

    def replace_buckets(self, table: str, rows: DataFrame, buckets: list[int]) -> None:
        """Exchange some buckets for ``rows``, which fall into no other; the rest of the table is not touched.  A
        reader sees the table before the change or after it, as the versions change at once."""
        keys, count = BUCKETED[table]
        versions, located = self._versions(f"{table}_buckets"), self._located(table)
        number = versions[-1] + 1 if versions else 0
        placed = conform(rows, table).withColumn("bucket", bucket_of(count, *map(F.col, keys)))
        # A large market is many files.
        path = f"{self.root}/{table}/v={number}"
        placed.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
        written = [int(name.split("=")[1]) for name in self._children(table, f"v={number}") if name.startswith("bucket=")]
        now = {b: v for b, v in located.items() if b not in buckets} | {b: number for b in written}
        manifest = self.spark.createDataFrame(sorted(now.items()), schema_of(f"{table}_buckets")).coalesce(1)
        self.replace(f"{table}_buckets", manifest, version=number)
        self._expire_buckets(table)

    def _expire_buckets(self, table: str) -> None:
        """Delete what no kept version refers to: of data older than the oldest one, all it does not name."""
        oldest = self._versions(f"{table}_buckets")[0]
        old = [int(name[2:]) for name in self._children(table) if name.startswith("v=") and int(name[2:]) < oldest]
        if not old:
            return
        held = set(self._located(table, oldest).items())
        for number in old:
            names = [name for name in self._children(table, f"v={number}") if name.startswith("bucket=")]
            gone = [name for name in names if (int(name.split("=")[1]), number) not in held]
            for name in gone if len(gone) < len(names) else [""]:
                self._files().delete(self._path(table, f"v={number}", *filter(None, [name])), True)

    # --- writes -----------------------------------------------------------------------------------

    def replace(self, table: str, rows: DataFrame, *, version: int | None = None) -> None:
        """Write a small table as a new version (or as ``version``, so that a rerun writes the same one)."""
        versions = self._versions(table)
        number = version if version is not None else (versions[-1] + 1 if versions else 0)
        rows.write.mode("overwrite").parquet(f"{self.root}/{table}/v={number}")
        self._expire(table, [n for n in versions if n < number])

    def _expire(self, table: str, versions: list[int]) -> None:
        """Delete versions whose successor is older than the age kept; the last one before always stays."""
        files = self._files()
        kept_since = datetime.now().timestamp() - self.version_age.total_seconds()
        for old, following in zip(versions, versions[1:]):
            written = files.getFileStatus(self._path(table, f"v={following}", "_SUCCESS")).getModificationTime() / 1000
            if written < kept_since:
                files.delete(self._path(table, f"v={old}"), True)

    def overwrite_partitions(self, table: str, rows: DataFrame) -> None:
        """Exchange every partition that ``rows`` touch.

        Rows are rebalanced on the partition column, so a large day becomes many files written in
        parallel and a small one a single file.
        """
        column = self._partition_column(table)
        (
            self._laid_out(table, rows)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("maxRecordsPerFile", self.rows_per_file)
            .partitionBy(column)
            .parquet(f"{self.root}/{table}")
        )

    def exchange(self, table: str, rows: DataFrame) -> None:
        """Exchange the partitions that ``rows`` touch, where they are made of what those partitions hold.  The
        rows are written aside first, so a driver that is lost while the old partition goes and the new one
        comes loses nothing: ``recover`` ends the exchange."""
        name = uuid.uuid4().hex
        self._laid_out(table, rows).write.parquet(f"{self.root}/_pending/{table}/{name}")
        self._end_exchange(table, name)

    def _end_exchange(self, table: str, name: str) -> None:
        schema = self.read(table).schema
        self.overwrite_partitions(table, self.spark.read.schema(schema).parquet(f"{self.root}/_pending/{table}/{name}"))
        self._files().delete(self._path("_pending", table, name), True)

    def recover(self, table: str) -> None:
        """End the exchanges that a lost driver left; rows that were not written aside completely are dropped,
        as nothing was exchanged for them yet."""
        for name in self._children("_pending", table):
            if self._files().exists(self._path("_pending", table, name, "_SUCCESS")):
                self._end_exchange(table, name)
            else:
                self._files().delete(self._path("_pending", table, name), True)

    def _laid_out(self, table: str, rows: DataFrame) -> DataFrame:
        column = self._partition_column(table)
        balanced = rows.hint("rebalance", column)
        return balanced.sortWithinPartitions(column, SORTED[table]) if table in SORTED else balanced

    def replace_partition(self, table: str, rows: DataFrame, value: date | datetime) -> None:
        """Exchange one partition; no rows remove it."""
        rows = cut_lineage(rows)
        if rows.isEmpty():
            self.drop_partitions(table, lambda found: found == value)
        else:
            self.overwrite_partitions(table, rows)

    def exchange_all(self, table: str, rows: DataFrame, values: list[date]) -> None:
        """Exchange several partitions with rows made of what they hold; those without rows go."""
        rows = cut_lineage(rows)
        left = {row[0] for row in rows.select(self._partition_column(table)).distinct().collect()}
        self.exchange(table, rows)
        self.drop_partitions(table, lambda found: found in values and found not in left)

    def partitions(self, table: str) -> dict[date | datetime | int, str]:
        """Partition values present, with their folder names."""
        column = self._partition_column(table)
        parse = {"timestamp": datetime.fromisoformat, "date": date.fromisoformat, "bigint": int}[PARTITIONED[table].split()[1]]
        names = [name for name in self._children(table) if name.startswith(f"{column}=")]
        return {parse(name.split("=", 1)[1].replace("%3A", ":")): name for name in names}

    def drop_partitions(self, table: str, unwanted: Callable[[date | datetime], bool]) -> None:
        """Delete the partitions whose value ``unwanted`` accepts; no data is read."""
        for value, name in self.partitions(table).items():
            if unwanted(value):
                self._files().delete(self._path(table, name), True)

    def unseen(self, table: str, rows: DataFrame, required: list[str], order: list[str]) -> DataFrame:
        """Rows with an id that is not stored: of several the first, with all ``required`` columns.  Ids are looked for
        only in the ranges that the rows fall into, and there in row groups between the least and greatest."""
        key, span = RANGES[table]
        names = schema_of(table).fieldNames()
        first = first_per_key(rows, names, key, required, order).withColumn("id_range", F.expr(f"{key} div {span}"))
        first = cut_lineage(first)
        bounds = first.agg(F.min(key), F.max(key), F.min("id_range"), F.max("id_range")).first()
        if bounds[0] is None:
            return first
        listed = [row[0] for row in first.select("id_range").distinct().limit(LISTED_RANGES + 1).collect()]
        near = F.col("id_range").isin(listed) if len(listed) <= LISTED_RANGES else F.col("id_range").between(*bounds[2:])
        stored = self.read(table).filter(near & F.col(key).between(*bounds[:2]))
        return first.join(stored.select("id_range", key), ["id_range", key], "left_anti").select(*first.columns)

    def append_new(self, table: str, rows: DataFrame, required: list[str], order: list[str]) -> None:
        """Append rows with an unseen id.  A rerun finds its own rows stored."""
        new = self._laid_out(table, self.unseen(table, rows, required, order))
        appended = new.write.mode("append").option("maxRecordsPerFile", self.rows_per_file)
        appended.partitionBy("id_range").parquet(f"{self.root}/{table}")

    def compact_ranges(self, table: str, files: int = 32) -> list[int]:
        """Write ranges of more than so many files anew, ordered by id; returns them."""
        found = self.partitions(table)
        many = sorted(v for v, name in found.items() if sum(f.endswith(".parquet") for f in self._children(table, name)) > files)
        if many:
            self.exchange(table, self.read(table).filter(F.col("id_range").isin(many)))
        return many

    def merge_trades(self, batch: DataFrame, *, reprice: bool = False) -> Merged | None:
        """Merge a (checkpointed) batch of trades by id; None for an empty one.

        New ids are appended as new files.  Ids stored already are looked for only in days whose id span
        the batch meets, and there only in row groups of its range.  An unchanged event is left alone (its
        volume too, unless ``reprice``); for a changed one its day, old and new, is rewritten.  A rerun
        finds its own rows unchanged.
        """
        stored = self.read("trades")
        dated = batch.withColumn("trade_date", F.to_date("timestamp"))
        absent = {name: F.lit(None).cast("double") for name in ("usd_price",) if name not in dated.columns}
        dated = dated.withColumns(absent).select(*stored.columns)
        single = unique_trades(dated)
        bounds = [F.min("trade_id").alias("low"), F.max("trade_id").alias("high")]
        per_day = single.groupBy("trade_date").agg(*bounds, F.min("timestamp").alias("first"), F.max("timestamp").alias("last"))
        spans = per_day.collect()
        if not spans:
            return None
        low, high = min(span.low for span in spans), max(span.high for span in spans)
        days = {span.trade_date for span in spans}

        # Spans first: too wide a span does no harm if the write below fails.
        known = self.read("trade_days")
        near = [day.trade_date for day in known.filter((F.col("low") <= high) & (F.col("high") >= low)).collect()]
        widened = known.unionByName(per_day.select("trade_date", "low", "high")).groupBy("trade_date")
        self.replace("trade_days", widened.agg(F.min("low").alias("low"), F.max("high").alias("high")))

        candidates = stored.filter(F.col("trade_date").isin(near) & F.col("trade_id").between(low, high))
        existing = cut_lineage(candidates.join(single.select("trade_id"), "trade_id", "left_semi"))
        fresh, rewritten, added = single, set(), days
        if not existing.isEmpty():
            fresh = single.join(existing.select("trade_id"), "trade_id", "left_anti")
            added = {row.trade_date for row in fresh.select("trade_date").distinct().collect()}
            changed = self._changed(existing, single, reprice)
            rewritten = {day for move in changed.select("old_date", "trade_date").distinct().collect() for day in move}
        # The ledger first: a driver that is lost from here on leaves a note of what to take anew.
        entry = self.mark_days(added | rewritten)
        if rewritten:
            self._replace_changed(stored, changed, single, rewritten)
        if added:
            appended = self._laid_out("trades", fresh).write.mode("append").option("maxRecordsPerFile", self.rows_per_file)
            appended.partitionBy("trade_date").parquet(f"{self.root}/trades")
        return Merged(
            entry=entry,
            rows=single,
            days=sorted(days | rewritten),
            rewritten=sorted(rewritten),
            first=min(span.first for span in spans),
            last=max(span.last for span in spans),
        )

    def _changed(self, existing: DataFrame, single: DataFrame, reprice: bool) -> DataFrame:
        """Stored trades that differ from the batch, with their day before and after."""
        compared = [name for name in existing.columns if reprice or name not in REPRICED]
        old = existing.select("trade_id", F.col("trade_date").alias("old_date"), F.struct(*compared).alias("old"))
        new = single.select("trade_id", "trade_date", F.struct(*compared).alias("new"))
        differing = old.join(new, "trade_id").filter(~F.col("old").eqNullSafe(F.col("new")))
        return cut_lineage(differing.select("trade_id", "old_date", "trade_date"))

    def _replace_changed(self, stored: DataFrame, changed: DataFrame, single: DataFrame, days: set[date]) -> None:
        """Rewrite the days of the changed trades."""
        current = stored.filter(F.col("trade_date").isin(days))
        replaced = single.join(changed.select("trade_id"), "trade_id", "left_semi")
        self.exchange_all("trades", merge_rows(current, replaced, ["trade_id"], {}), sorted(days))

    def compact_trades(self, day: date) -> None:
        """Write the files of a finished day anew: few, large, ordered by id."""
        rows = self.read("trades").filter(F.col("trade_date") == F.lit(day))
        self.exchange("trades", rows)

    # --- ledger of touched days -------------------------------------------------------------------

    def mark_days(self, days: set[date], *, kept: bool = False) -> str | None:
        """Note that trades of these days change, before they do.  An entry is a folder of empty files named by
        day, so a half-written one names days that did not change yet, which does no harm."""
        if not days:
            return None
        entry = uuid.uuid4().hex
        for day in sorted(days):
            self._files().create(self._path("touched_days", entry, day.isoformat())).close()
        if kept:
            self.mark_kept(entry)
        return entry

    def mark_kept(self, entry: str | None) -> None:
        """Note that panes and closes of an entry's days are up to date."""
        if entry is not None:
            self._files().create(self._path("touched_days", entry, "_KEPT")).close()

    def touched_days(self) -> list[Touched]:
        """The entries of the ledger, by what they name: days, a few even after weeks."""
        found = []
        for entry in self._children("touched_days"):
            names = self._children("touched_days", entry)
            days = sorted(date.fromisoformat(name) for name in names if not name.startswith(("_", ".")))
            found.append(Touched(entry, days, "_KEPT" in names))
        return found

    def forget(self, touched: list[Touched]) -> None:
        """Delete entries whose days were taken anew; those made meanwhile stay."""
        for one in touched:
            self._files().delete(self._path("touched_days", one.entry), True)

    # --- retention --------------------------------------------------------------------------------

    def clean_trades(self, today: date, days: int) -> None:
        """Drop whole days before the cut; of the cut day only trades at its very first moment go."""
        cut = today - timedelta(days=days)
        self.drop_partitions("trades", lambda day: day < cut)
        midnight = at(datetime(cut.year, cut.month, cut.day))
        cut_day = self.read("trades").filter(F.col("trade_date") == F.lit(cut))
        if not cut_day.filter(F.col("timestamp") <= midnight).isEmpty():
            kept = cut_day.filter(F.col("timestamp") > midnight)
            if kept.isEmpty():
                self.drop_partitions("trades", lambda day: day == cut)
            else:
                self.exchange("trades", kept)

    def clean_hourly(self, as_of: datetime, days: int) -> None:
        cut = as_of - timedelta(days=days)
        self.drop_partitions("assets_hourly", lambda moment: moment <= cut)
        snapshots = self.read("exchange_hourly")
        if not snapshots.filter(F.col("stat_time") <= at(cut)).isEmpty():
            self.replace("exchange_hourly", snapshots.filter(F.col("stat_time") > at(cut)))
