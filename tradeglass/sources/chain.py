"""Wallet balances, scalar metrics and fee transfers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tradeglass.schemas import PRICE

CURSOR_BLOCK = "fees.after_id:block_num"
CURSOR_EVENT = "fees.after_id:event_idx"


def wallet_balances(balances: DataFrame, assets: DataFrame, wallet: str) -> DataFrame:
    """Latest raw balance per listed asset in ``wallet``; null where the wallet holds no account."""
    latest = (
        balances.filter(F.col("wallet") == wallet)
        .groupBy("asset_id")
        .agg(F.max_by("balance_raw", "observed_at").alias("balance_raw"))
    )
    return assets.select("asset_id").join(latest, "asset_id", "left")


def latest_metrics(envelopes: DataFrame) -> DataFrame:
    """Newest count of each metric among the answers with code 0."""
    answered = envelopes.filter(F.col("code") == 0)
    newest = F.max(F.struct("observed_at", F.col("data.count").alias("count")))
    return answered.groupBy("metric").agg(newest.alias("d")).select(
        "metric", F.col("d.observed_at").alias("observed_at"), F.col("d.count").alias("value")
    )


def latest_scalars(scalars: DataFrame) -> DataFrame:
    """Newest raw amount of each chain scalar (staked total, issuance)."""
    return scalars.groupBy("metric").agg(F.max_by("value_raw", "observed_at").alias("value_raw"))


def role_count(payloads: DataFrame, role: str = "nominator") -> DataFrame:
    """Count of the first entry with ``role``; null when there is none, the list is null or the code is not 0."""
    first = F.get(F.filter("data", lambda entry: entry.role == role), F.lit(0))["count"]
    return payloads.withColumn("stakers", F.when(F.col("code") == 0, first)).drop("code", "data")


def transfers(pages: DataFrame) -> DataFrame:
    """Rows of the answered transfer pages."""
    row = F.col("row")
    return pages.filter(F.col("code") == 0).select(F.explode("data.transfers").alias("row")).select(
        row.transfer_id.alias("transfer_id"),
        row.asset_symbol.alias("asset_symbol"),
        row.amount.try_cast(PRICE).alias("amount"),
        row.block_num.alias("block_num"),
        row.event_idx.alias("event_idx"),
    )


def transfers_after(rows: DataFrame, block: int, event: int, page_rows: int | None = None) -> DataFrame:
    """Transfers strictly after the cursor; with ``page_rows`` only the next page in cursor order.

    The block bound is repeated on its own so that it reaches the scan.
    """
    block_num, event_idx = F.col("block_num"), F.col("event_idx")
    after = rows.filter((block_num >= block) & ((block_num > block) | (event_idx > event)))
    return after if page_rows is None else after.orderBy("block_num", "event_idx").limit(page_rows)


def cursor_rows(processed: DataFrame) -> DataFrame:
    """Cursor after ``processed`` as metadata rows; no rows when nothing was processed."""
    last = processed.agg(F.max(F.struct("block_num", "event_idx")).alias("last")).filter("last is not null")
    entries = F.create_map(
        F.lit(CURSOR_BLOCK), F.col("last.block_num").cast("string"),
        F.lit(CURSOR_EVENT), F.col("last.event_idx").cast("string"),
    )
    return last.select(F.explode(entries).alias("data_name", "data_value"))


def cursor_value(metadata: DataFrame) -> tuple[int, int]:
    """Stored cursor, (0, 0) when never set.  Two rows at most."""
    stored = metadata.filter(F.col("data_name").isin(CURSOR_BLOCK, CURSOR_EVENT)).collect()
    values = {row.data_name: int(row.data_value) for row in stored}
    return values.get(CURSOR_BLOCK, 0), values.get(CURSOR_EVENT, 0)
