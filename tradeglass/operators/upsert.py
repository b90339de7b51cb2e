"""Keyed merge with a rule per column."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Rows of either side that one task merges, about.
TASK_ROWS = 50_000

# A rule gets the stored and the incoming value and returns the one kept for an existing row.
Rule = Callable[[Column, Column], Column]


def replace(old: Column, new: Column) -> Column:
    """The new value, null included."""
    return new


def keep_new(old: Column, new: Column) -> Column:
    """The new value unless it is null."""
    return F.coalesce(new, old)


def keep_old(old: Column, new: Column) -> Column:
    """The old value unless it is null."""
    return F.coalesce(old, new)


def frozen(old: Column, new: Column) -> Column:
    """The old value, even if null."""
    return old


def last_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the last by ``order``.  An aggregate: copies of a hot key collapse map-side."""
    others = [name for name in rows.columns if name not in keys]
    place = F.struct(*order) if len(order) > 1 else F.col(order[0])
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*others), place).alias("_row"))
    return last.select(*[F.col(n) if n in keys else F.col(f"_row.{n}").alias(n) for n in rows.columns])


def unique_trades(trades: DataFrame) -> DataFrame:
    """One row per trade id, the last by timestamp.  Repeated ids are rare, so they are looked for in the
    id column alone; whole rows are gathered only for those."""
    repeated = trades.groupBy("trade_id").agg(F.count(F.lit(1)).alias("n"))
    repeated = repeated.filter(F.col("n") > 1).select("trade_id")
    if repeated.isEmpty():
        return trades
    copies = trades.join(repeated, "trade_id", "left_semi")
    last = last_per_key(copies, ["trade_id"], ["timestamp", "price", "quantity"])
    return trades.join(repeated, "trade_id", "left_anti").select(*trades.columns).unionByName(last)


def merge_rows(
    target: DataFrame, source: DataFrame, keys: Sequence[str], rules: Mapping[str, Rule]
) -> DataFrame:
    """``target`` with the rows of ``source`` merged in.  Keys must be unique on both sides.

    A row only in ``source`` is inserted as it is; for a row on both sides each column follows its rule
    (default: ``replace``).
    """
    others = [name for name in target.columns if name not in keys]
    stored = target.select(*keys, F.struct(*others).alias("_old"))
    incoming = source.select(*keys, F.struct(*others).alias("_new"))
    return _kept(stored.join(incoming, list(keys), "full_outer"), target.columns, keys, rules)


def merge_few(target: DataFrame, source: DataFrame, keys: Sequence[str], rules: Mapping[str, Rule]) -> DataFrame:
    """The same by grouping instead of joining: for a few rows whose key may be a literal, which a join
    would compare pair by pair."""
    others = [name for name in target.columns if name not in keys]
    stored = target.select(*keys, F.struct(*others).alias("_old"), F.lit(None).alias("_new"))
    incoming = source.select(*keys, F.lit(None).alias("_old"), F.struct(*others).alias("_new"))
    sides = stored.unionByName(incoming).groupBy(*keys).agg(F.max("_old").alias("_old"), F.max("_new").alias("_new"))
    return _kept(sides, target.columns, keys, rules)


def _kept(sides: DataFrame, columns: Sequence[str], keys: Sequence[str], rules: Mapping[str, Rule]) -> DataFrame:
    def kept(name: str) -> Column:
        old, new = F.col(f"_old.{name}"), F.col(f"_new.{name}")
        both = rules.get(name, replace)(old, new)
        inserted, untouched = F.col("_old").isNull(), F.col("_new").isNull()
        return F.when(inserted, new).when(untouched, old).otherwise(both).alias(name)

    return sides.select(*[F.col(name) if name in keys else kept(name) for name in columns])


ASSET_RULES: dict[str, Rule] = {
    name: keep_new
    for name in ("price", "tvl", "balance", "fees", "fees_value", "new_fees", "new_fees_value")
}
MARKET_RULES: dict[str, Rule] = {"price": keep_new}


def upsert_trades(target: DataFrame, source: DataFrame) -> DataFrame:
    """Every column replaced by trade id; of several source rows of one id the last by timestamp counts.

    Both sides are spread by the number of their rows: a shuffle packs trades so well that partitions of a common
    size in bytes are many times that in a task."""
    rows = source.select(*target.columns)
    parts = -(-max(target.count(), rows.count()) // TASK_ROWS)
    if parts > 1:
        target, rows = target.repartition(parts, "trade_id"), rows.repartition(parts, "trade_id")
    return merge_rows(target, unique_trades(rows), ["trade_id"], {})


def upsert_assets(target: DataFrame, source: DataFrame) -> DataFrame:
    """Symbol, name and state replaced; figures only by values that are not null."""
    return merge_rows(target, source, ["asset_id"], ASSET_RULES)


def upsert_markets(target: DataFrame, source: DataFrame) -> DataFrame:
    return merge_rows(target, source, ["base_asset_id", "quote_asset_id"], MARKET_RULES)


def first_per_key(
    source: DataFrame, columns: Sequence[str], key: str, required: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The first row by ``order`` per key, among those whose ``required`` columns are present and not empty."""
    usable = source
    for name in required:
        usable = usable.filter(F.col(name).isNotNull() & (F.length(F.col(name).cast("string")) > 0))
    others = [name for name in columns if name != key]
    first = usable.groupBy(key).agg(F.min_by(F.struct(*others), F.struct(*order)).alias("_row"))
    return first.select(key, "_row.*").select(*columns)


def insert_new(
    target: DataFrame, source: DataFrame, key: str, required: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Rows of ``source`` to append: ``required`` columns present and not empty, key not stored yet, the
    first row by ``order`` per key."""
    rows = first_per_key(source, target.columns, key, required, order)
    return rows.join(target.select(key), key, "left_anti").select(*target.columns)


def upsert_metadata(metadata: DataFrame, rows: DataFrame) -> DataFrame:
    return merge_rows(metadata, rows, ["data_name"], {})
