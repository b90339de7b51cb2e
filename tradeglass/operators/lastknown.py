"""Last known value per key, safe for keys that hold a large share of all rows.

A window over a whole key would sort that key in one task.  Here a busy key is split by time: each slice gets
the value its predecessors left behind as an opening row, and the window runs within (key, slice).  Each
busy key has slices as fine as it needs; a second that is still too full is cut by trade id.  Other keys
stay whole.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tradeglass.session import cut_lineage

SLICES = ("day", "hour", "minute", "second")
# Parts that a second is cut into where it holds too many rows of one key.
_PARTS = 1_000


@dataclass(frozen=True)
class Slices:
    """``units``: the time unit of each busy key; ``cuts``: the ids that cut its overfull seconds."""

    units: DataFrame
    cuts: DataFrame


def choose_slices(rows: DataFrame, keys: Sequence[str], ts: str, by: str, rows_per_slice: int) -> Slices | None:
    """For each key with more than ``rows_per_slice`` rows the coarsest time unit in which it does not exceed
    that; None if all keys fit whole.  ``by`` orders the rows of a second.

    Rows are counted per key first; those of busy keys per minute, rolled up to hours and days.  All are
    partial aggregations of two narrow columns.
    """
    keys = list(keys)
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    busy = cut_lineage(counted.filter(F.col("n") > rows_per_slice).select(*keys))
    if busy.isEmpty():
        return None
    rows = rows.select(*keys, F.col(ts).alias("ts"), F.col(by).alias("by")).join(busy, keys, "left_semi")
    counts = rows.groupBy(*keys, F.date_trunc("minute", "ts").alias("slice")).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("minute", F.col("n"))
    peaks = ["minute"]
    for unit in ("hour", "day"):
        counts = counts.groupBy(*keys, F.date_trunc(unit, "slice").alias("slice")).agg(
            F.sum("n").alias("n"), *[F.max(b).alias(b) for b in peaks]
        ).withColumn(unit, F.col("n"))
        peaks.append(unit)
    peak = counts.groupBy(*keys).agg(*[F.max(b).alias(b) for b in peaks])
    fitting = [F.when(F.col(unit) <= rows_per_slice, F.lit(unit)) for unit in ("day", "hour", "minute")]
    units = cut_lineage(peak.select(*keys, F.coalesce(*fitting, F.lit("second")).alias("_unit")))
    finest = rows.join(units.filter(F.col("_unit") == "second").select(*keys), keys, "left_semi")
    at = [i / _PARTS for i in range(1, _PARTS)]
    cuts = (
        finest.groupBy(*keys, F.date_trunc("second", "ts").alias("_second"))
        .agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("by", at, 10 * _PARTS).alias("_cuts"))
        .filter(F.col("n") > rows_per_slice)
        .select(*keys, "_second", F.array_distinct("_cuts").alias("_cuts"))
    )
    return Slices(units, cut_lineage(cuts))


def _sliced(rows: DataFrame, keys: list[str], order: list[str], slices: Slices | str) -> DataFrame:
    """Add ``_slice`` (moment, part); a key that is not busy has one slice."""
    if isinstance(slices, str):
        return rows.withColumn("_slice", F.struct(F.date_trunc(slices, order[0]).alias("moment"), F.lit(0).alias("part")))
    second = F.date_trunc("second", order[0])
    cut = rows.join(slices.units, keys, "left").withColumn("_second", second).join(slices.cuts, [*keys, "_second"], "left")
    whole = F.lit("1970-01-01 00:00:00").cast("timestamp")
    moment = F.coalesce(F.expr(f"date_trunc(_unit, `{order[0]}`)"), whole)
    part = F.coalesce(F.size(F.filter("_cuts", lambda at: at <= F.col(order[1]))), F.lit(0))
    return cut.withColumn("_slice", F.struct(moment.alias("moment"), part.alias("part"))).drop("_unit", "_cuts", "_second")


def _openings(rows: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Per (key, slice): the last value of all earlier slices.  A window here sees one row per slice of a
    day, or one per day of a key."""
    at = F.when(F.col(value).isNotNull(), F.struct(*order))
    closes = rows.groupBy(*keys, "_slice").agg(F.max_by(value, at).alias("_close"))
    before = (Window.unboundedPreceding, -1)

    def carried(over: list[str], by: str) -> Column:
        window = Window.partitionBy(*over).orderBy(by).rowsBetween(*before)
        return F.last("_close", ignorenulls=True).over(window)

    closes = closes.withColumn("_day", F.to_date("_slice.moment"))
    within = closes.select(*keys, "_day", "_slice", carried([*keys, "_day"], "_slice").alias("_within"))
    left = F.when(F.col("_close").isNotNull(), F.col("_slice"))
    days = closes.groupBy(*keys, "_day").agg(F.max_by("_close", left).alias("_close"))
    days = days.select(*keys, "_day", carried(keys, "_day").alias("_from_days"))
    return within.join(days, [*keys, "_day"]).select(
        *keys, "_slice", F.coalesce("_within", "_from_days").alias("_open")
    )


def last_known(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    into: str,
    *,
    slices: Slices | str | None,
    inclusive: bool = True,
) -> DataFrame:
    """Add ``into``: the last non-null ``value`` of the same key at or (not ``inclusive``) before each row.

    ``order`` starts with the timestamp and the id; ``keys`` must not be null.  ``slices`` may be one time unit
    for all keys; None leaves keys whole.
    """
    keys, order = list(keys), list(order)
    end = 0 if inclusive else -1

    def last_in(partition: list[str], by: list[str]) -> Column:
        window = Window.partitionBy(*partition).orderBy(*by).rowsBetween(Window.unboundedPreceding, end)
        return F.last(value, ignorenulls=True).over(window)

    if slices is None:
        return rows.withColumn(into, last_in(keys, order))
    sliced = _sliced(rows, keys, order, slices)
    openings = _openings(sliced, keys, order, value).filter(F.col("_open").isNotNull())
    opening_rows = openings.select(*keys, "_slice", F.col("_open").alias(value), F.lit(0).alias("_kind"))
    both = sliced.withColumn("_kind", F.lit(1)).unionByName(opening_rows, allowMissingColumns=True)
    carried = both.withColumn(into, last_in([*keys, "_slice"], ["_kind", *order]))
    return carried.filter(F.col("_kind") == 1).drop("_kind", "_slice")


def latest_before(rows: DataFrame, keys: Sequence[str], by: str, cut: Column, columns: Sequence[str]) -> DataFrame:
    """Per key the row with the greatest ``by`` not after ``cut``, in one pass of partial aggregates."""
    newest = F.max_by(F.struct(*columns), by)
    return rows.filter(F.col(by) <= cut).groupBy(*keys).agg(F.max(by).alias(by), newest.alias("_row")).select(
        *keys, by, *[F.col(f"_row.{name}").alias(name) for name in columns]
    )


def one(row: DataFrame) -> Column:
    """A one-row DataFrame as a struct column (a scalar subquery; null for no row)."""
    return row.select(F.struct(*row.columns)).scalar()


def latest_row(rows: DataFrame, by: str) -> DataFrame:
    """The row with the greatest ``by``; no rows for no input."""
    newest = rows.agg(F.max_by(F.struct(*rows.columns), by).alias("row"))
    return newest.filter("row is not null").select("row.*")
