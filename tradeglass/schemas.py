"""Target table schemas and input schemas, as Spark DDL."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

PRICE = "decimal(20,10)"
VOLUME = "decimal(18,6)"
FEES = "decimal(18,9)"
USD = "decimal(12,2)"
USD_TOTAL = "decimal(18,2)"
BALANCE = "decimal(16,4)"

# --- inputs ---------------------------------------------------------------------------------------

# Numbers arrive as text (``t`` and ``stid`` as text or number), ``t`` is epoch milliseconds, ``m`` is "BASE-QUOTE".
TRADE_EVENT = (
    "type string, m string, p string, q string, vq string, t string, stid string, trade_id string, "
    "m_id string, t_id string, m_cid string, t_cid string, m_side string, t_side string"
)
ASSET_LISTING = "items array<struct<symbol:string,name:string,asset_id:string>>"
MARKET_LISTING = "items array<struct<market:string>>"
ORDERBOOK_PAGE = (
    "market string, snapshot_id bigint, page int, "
    "items array<struct<p:string,q:string,s:string,stid:string>>"
)
WALLET_BALANCE = "wallet string, asset_id string, balance_raw decimal(24,0), observed_at timestamp"
METRIC_ENVELOPE = "metric string, observed_at timestamp, code int, data struct<count:bigint>"
ROLE_COUNTS = "observed_at timestamp, code int, data array<struct<role:string,count:bigint>>"
TRANSFER_PAGE = (
    "code int, data struct<transfers:array<struct<transfer_id:bigint,asset_symbol:string,"
    "amount:string,block_num:bigint,event_idx:bigint>>>"
)
CHAIN_SCALAR = "metric string, observed_at timestamp, value_raw decimal(24,0)"

# --- tables ---------------------------------------------------------------------------------------

TRADE_IDS = "m_id string, t_id string, m_cid string, t_cid string, m_side string, t_side string, trade_oid string"

_EXCHANGE_MEASURES = {
    "tvl": USD,
    "volume": VOLUME,
    "users": "bigint",
    "new_users": "bigint",
    "trades": "bigint",
    "total_staked": "bigint",
    "staked_tvl": USD,
    "total_holders": "bigint",
    "total_stakers": "bigint",
    "treasury_balance": "bigint",
    "treasury_tvl": USD,
    "total_issuance": "bigint",
    "total_fees": USD,
    "new_total_fees": USD,
}
EXCHANGE_MEASURES = tuple(_EXCHANGE_MEASURES)

_ASSET_MEASURES = {
    "tvl": USD,
    "price": PRICE,
    "balance": BALANCE,
    "fees": FEES,
    "fees_value": USD,
    "new_fees": FEES,
    "new_fees_value": USD,
}
ASSET_MEASURES = tuple(_ASSET_MEASURES)


def _columns(measures: dict[str, str], prefix: str = "") -> str:
    return ", ".join(f"{prefix}{name} {kind}" for name, kind in measures.items())


TABLES = {
    "assets": f"asset_id string, symbol string, name string, is_active boolean, {_columns(_ASSET_MEASURES)}",
    "markets": f"base_asset_id string, quote_asset_id string, is_active boolean, price {PRICE}",
    "trades": (
        "trade_id bigint, base_asset_id string, quote_asset_id string, "
        f"price {PRICE}, quantity {PRICE}, volume_quote {PRICE}, volume {VOLUME}, "
        # usd_price: the price of the base asset that the trade made.
        f"timestamp timestamp, {TRADE_IDS}, usd_price double"
    ),
    "exchange_daily": f"stat_date date, {_columns(_EXCHANGE_MEASURES)}",
    "exchange_hourly": f"stat_time timestamp, {_columns(_EXCHANGE_MEASURES)}",
    "exchange_24h": f"{_columns(_EXCHANGE_MEASURES)}, {_columns(_EXCHANGE_MEASURES, 'previous_')}",
    "exchange_alltime": f"volume {USD_TOTAL}, trades bigint, total_fees {USD_TOTAL}",
    "markets_daily": (
        "stat_date date, base_asset_id string, quote_asset_id string, "
        f"volume {VOLUME}, volume_quote {PRICE}, volume_base {PRICE}, trades bigint"
    ),
    "markets_24h": (
        "base_asset_id string, quote_asset_id string, "
        f"volume {VOLUME}, volume_quote {PRICE}, volume_base {PRICE}, trades bigint, "
        f"previous_volume {VOLUME}, previous_volume_quote {PRICE}, previous_volume_base {PRICE}, "
        f"previous_trades bigint, price_low {PRICE}, price_high {PRICE}, price_24h {PRICE}"
    ),
    "assets_daily": f"stat_date date, asset_id string, volume {VOLUME}, trades bigint, {_columns(_ASSET_MEASURES)}",
    "assets_hourly": f"stat_time timestamp, asset_id string, {_columns(_ASSET_MEASURES)}",
    "assets_24h": (
        f"asset_id string, volume {VOLUME}, trades bigint, {_columns(_ASSET_MEASURES)}, "
        f"previous_volume {VOLUME}, previous_trades bigint, {_columns(_ASSET_MEASURES, 'previous_')}"
    ),
    "orderbook": (
        "base_asset_id string, quote_asset_id string, "
        f"price {PRICE}, side string, stid string, quantity {PRICE}"
    ),
    # Which version holds each bucket of the book.
    "orderbook_buckets": "bucket int, version bigint",
    "orderbook_lastupdate": "last_update timestamp",
    "fee_withdrawals": f"transfer_id bigint, asset_symbol string, amount {PRICE}",
    # When each market was listed, and keys of the stored tables that no asset has.
    "market_history": "base_asset_id string, quote_asset_id string, valid_from timestamp, valid_to timestamp",
    "orphans": "table_name string, column_name string, asset_id string, row_count bigint",
    "metadata": "data_name string, data_value string",
    # Kept along with the trades, so that no job reads them all: the span of each day, activity per
    # minute, the last trade of each market and the last price of each asset per day.
    "trade_days": "trade_date date, low bigint, high bigint",
    "market_panes": (
        f"timestamp timestamp, base_asset_id string, quote_asset_id string, trades bigint, volume {VOLUME}, "
        f"volume_quote {PRICE}, volume_base {PRICE}, price_low {PRICE}, price_high {PRICE}, "
        f"close_id bigint, close_price {PRICE}"
    ),
    "market_closes": f"base_asset_id string, quote_asset_id string, close_id bigint, close_price {PRICE}",
    "asset_closes": "asset_id string, usd_price double, timestamp timestamp, trade_id bigint",
    # Price state of a trade stream, and the prices that repricing left behind.
    "repriced_assets": "asset_id string, usd_price double, timestamp timestamp, trade_id bigint",
    "asset_prices": "asset_id string, usd_price double, timestamp timestamp, trade_id bigint",
}


def schema_of(table: str) -> StructType:
    return StructType.fromDDL(TABLES[table])


def conform(df: DataFrame, table: str, *extra: str) -> DataFrame:
    """Project onto the target schema of ``table`` (and keep ``extra`` columns), casting each column."""
    fields = schema_of(table).fields
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields], *extra)
