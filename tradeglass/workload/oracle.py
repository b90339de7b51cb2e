"""Equivalent SQL for the queries, written for another engine.

``VIEWS`` restate the inputs; a query's SQL lists the views it needs and they become a WITH clause.
"""

from __future__ import annotations

import re

AS_OF = "TIMESTAMP '2024-01-30 12:00:00'"
TODAY = "DATE '2024-01-30'"


def code(column: str) -> str:
    return f"'A' || lpad(cast({column} % 12 AS varchar), 2, '0')"


def rounded(double: str, kind: str) -> str:
    """Double to decimal by its shortest decimal text, half up."""
    return f"cast(cast({double} AS varchar) AS {kind})"


VIEWS: dict[str, str] = {
    "src": f"""
        SELECT event_id AS trade_id, user_id, event_type, base_asset_id,
               CASE WHEN event_type = 'error' THEN '456'
                    WHEN event_type = 'purchase' AND base_asset_id <> 'A00' THEN 'A00'
                    WHEN event_type = 'signup' AND base_asset_id NOT IN ('A00', 'A01') THEN 'A01'
                    ELSE 'USDT' END AS quote_asset_id,
               cast(p AS decimal(20,10)) AS price, cast(k AS decimal(20,10)) AS quantity,
               cast(p * cast(k AS decimal(4,0)) AS decimal(20,10)) AS volume_quote,
               date_trunc('second', ts + INTERVAL 500 MILLISECOND) AS timestamp
        FROM (SELECT *, {code('user_id')} AS base_asset_id,
                     cast((cast(value AS decimal(12,2)) + 0.01) * 0.01 AS decimal(14,4)) AS p,
                     cast(json_extract(props, '$.k') AS int) + 1 AS k
              FROM events)""",
    "market_list": """
        SELECT DISTINCT base_asset_id, quote_asset_id FROM src WHERE quote_asset_id <> '456'
        UNION ALL SELECT 'A98', 'USDT'""",
    "admitted": "SELECT * FROM src WHERE quote_asset_id <> '456'",
    # Prices level by level; trade ids grow with time, so they order the trades.
    "ticks0": "SELECT trade_id, cast(price AS double) AS usd FROM admitted WHERE base_asset_id = 'A00'",
    "ticks1": """
        SELECT trade_id, cast(price AS double) * CASE WHEN quote_asset_id = 'USDT' THEN 1 ELSE q END AS usd
        FROM (SELECT t.*, k.usd AS q FROM admitted t ASOF LEFT JOIN ticks0 k ON t.trade_id > k.trade_id
              WHERE t.base_asset_id = 'A01')
        WHERE quote_asset_id = 'USDT' OR q IS NOT NULL""",
    "quoted": """
        SELECT t.*, CASE t.quote_asset_id WHEN 'A00' THEN a.usd WHEN 'A01' THEN b.usd END AS q
        FROM admitted t ASOF LEFT JOIN ticks0 a ON t.trade_id > a.trade_id
                        ASOF LEFT JOIN ticks1 b ON t.trade_id > b.trade_id""",
    "priced": f"""
        SELECT trade_id, user_id, event_type, base_asset_id, quote_asset_id, price, quantity, volume_quote,
               CASE WHEN quote_asset_id = 'USDT' THEN cast(volume_quote AS decimal(18,6))
                    ELSE {rounded('cast(volume_quote AS double) * q', 'decimal(18,6)')} END AS volume,
               CASE WHEN quote_asset_id = 'USDT' THEN cast(price AS double)
                    ELSE cast(price AS double) * q END AS usd,
               timestamp
        FROM quoted""",
    "asset_list": """
        SELECT asset_id, coalesce('SYM' || cast(p_partkey % 10 AS varchar), asset_id) AS symbol,
               coalesce(p_name, asset_id) AS name
        FROM (SELECT base_asset_id AS asset_id FROM src UNION SELECT quote_asset_id FROM src UNION SELECT 'A98')
        LEFT JOIN part ON p_partkey = try_cast(substr(asset_id, 2) AS bigint)
        WHERE asset_id <> '456'""",
    "asset_price": f"""
        SELECT a.*, CASE WHEN asset_id = 'USDT' THEN cast(1 AS decimal(20,10))
                         ELSE {rounded('l.usd', 'decimal(20,10)')} END AS price
        FROM asset_list a LEFT JOIN
             (SELECT base_asset_id, arg_max(usd, trade_id) AS usd FROM priced WHERE usd IS NOT NULL GROUP BY 1) l
             ON l.base_asset_id = a.asset_id""",
    "pool": f"""
        SELECT {code('c_custkey')} AS asset_id,
               cast(sum(cast(c_acctbal AS decimal(18,2)) * 1000000000) AS decimal(24,0)) AS raw
        FROM customer GROUP BY 1""",
    "held": f"""
        SELECT {code('s_suppkey')} AS asset_id,
               cast(sum(cast(s_acctbal AS decimal(18,2)) * 1000000000) AS decimal(24,0)) AS raw
        FROM supplier GROUP BY 1""",
    "treasury": """
        SELECT cast(sum(cast(o_totalprice AS decimal(18,2)) * 1000000000) AS decimal(24,0)) AS raw FROM orders""",
    # Whole units of both wallets have five decimals, so flooring at six changes nothing.
    "state": """
        SELECT asset_id, symbol, name, price, balance, tvl, fees, cast(fees * price AS decimal(12,2)) AS fees_value,
               new_fees, cast(new_fees * price AS decimal(12,2)) AS new_fees_value
        FROM (SELECT a.asset_id, symbol, name, price,
                     cast(p.raw / 10000000 * 0.00001 AS decimal(18,6)) AS bal,
                     cast(cast(p.raw // 10000000 AS decimal(13,0)) * 0.00001 AS decimal(16,4)) AS balance,
                     cast(cast(cast(p.raw // 10000000 AS decimal(13,0)) * 0.00001 AS decimal(18,6)) * price
                          AS decimal(12,2)) AS tvl,
                     cast(cast(h.raw // 10000000 AS decimal(13,0)) * 0.00001 AS decimal(18,9)) AS fees,
                     cast(cast(h.raw // 10000000 AS decimal(13,0)) * 0.000001 AS decimal(18,9)) AS new_fees
              FROM asset_price a LEFT JOIN pool p ON p.asset_id = a.asset_id
                                 LEFT JOIN held h ON h.asset_id = a.asset_id)""",
    "transfers": """
        SELECT o_orderkey AS transfer_id, 'SYM' || cast(o_custkey % 12 AS varchar) AS asset_symbol,
               cast(cast(o_totalprice AS decimal(18,2)) * 0.000001 AS decimal(20,10)) AS amount,
               o_orderkey // 10 AS block_num, o_orderkey % 10 AS event_idx, o_orderstatus, o_orderpriority
        FROM orders WHERE o_orderstatus <> 'P'""",
    # Per level its last line in the first snapshot and in the second.
    "book_lines": """
        SELECT base_asset_id, 'USDT' AS quote_asset_id, price, side,
               max(line) FILTER (WHERE line.number <= 5) AS old, max(line) FILTER (WHERE line.number >= 3) AS new
        FROM (SELECT 'S' || cast(l_suppkey % 40 AS varchar) AS base_asset_id,
                     cast(cast(cast(round(l_extendedprice * 100) AS bigint) // cast(l_quantity AS bigint)
                          AS decimal(18,0)) * 0.01 AS decimal(20,10)) AS price,
                     CASE WHEN l_linestatus = 'O' THEN 'Ask' ELSE 'Bid' END AS side,
                     {'number': l_linenumber, 'quantity': cast(cast(l_quantity AS decimal(12,2)) AS decimal(20,10)),
                      'stid': cast(l_orderkey * 10 + l_linenumber AS varchar)} AS line
              FROM lineitem)
        GROUP BY 1, 2, 3, 4""",
    "listing": """
        SELECT asset_id, symbol, name, CASE WHEN asset_id = '0' THEN cast(1 AS decimal(20,10)) END AS price
        FROM (SELECT cast(p_partkey AS varchar) AS asset_id, p_brand AS symbol, p_name AS name FROM part
              UNION ALL SELECT 'X' || cast(p_partkey AS varchar), p_type, p_name || ' alt' FROM part)
        WHERE asset_id NOT IN ('101112', '123', '188197390862117588552302061289480388608', '456', '789')""",
}


def _asset_history(period: str) -> str:
    return f"""
        SELECT period, asset_id, volume, trades, price, balance,
               cast(bal * price AS decimal(12,2)) AS tvl, fees, cast(fees * price AS decimal(12,2)) AS fees_value,
               new_fees, cast(new_fees * price AS decimal(12,2)) AS new_fees_value
        FROM (SELECT period, g.asset_id, volume, trades, price,
                     cast(cast(p.raw // 10000000 AS decimal(13,0)) * 0.00001 AS decimal(18,6)) AS bal,
                     cast(cast(p.raw // 10000000 AS decimal(13,0)) * 0.00001 AS decimal(16,4)) AS balance,
                     cast(sum(sold) OVER (PARTITION BY g.asset_id ORDER BY period) * 0.001 AS decimal(18,9)) AS fees,
                     cast(sold * 0.001 AS decimal(18,9)) AS new_fees
              FROM (SELECT {period} AS period, base_asset_id AS asset_id, cast(sum(quantity) AS decimal(20,0)) AS sold,
                           {rounded('arg_max(usd, trade_id) FILTER (WHERE usd IS NOT NULL)', 'decimal(20,10)')} AS price,
                           cast(sum(volume) AS decimal(18,6)) AS volume, count(*) AS trades
                    FROM priced GROUP BY 1, 2) g
              LEFT JOIN pool p ON p.asset_id = g.asset_id)"""


def _exchange_history(period: str, assets: str) -> str:
    return f"""
        SELECT period, cast(tvl AS decimal(12,2)) AS tvl, volume, cast(sum(new_users) OVER o AS bigint) AS users,
               new_users, trades, total_staked, staked_tvl, total_holders, total_stakers, treasury_balance,
               treasury_tvl, cast(sum(trades) OVER o AS bigint) AS total_issuance,
               cast(total_fees AS decimal(12,2)) AS total_fees, cast(new_total_fees AS decimal(12,2)) AS new_total_fees
        FROM (SELECT {period} AS period, cast(sum(volume) AS decimal(18,6)) AS volume, count(*) AS trades,
                     cast(sum(quantity) AS bigint) AS total_staked, cast(sum(volume_quote) AS decimal(12,2)) AS staked_tvl,
                     count(*) FILTER (WHERE quote_asset_id <> 'USDT') AS total_stakers,
                     cast(max(quantity) AS bigint) AS treasury_balance, cast(max(price) AS decimal(12,2)) AS treasury_tvl,
                     count(DISTINCT base_asset_id) AS total_holders
              FROM priced GROUP BY 1)
        LEFT JOIN (SELECT period, count(*) AS new_users
                   FROM (SELECT user_id, min({period}) AS period FROM priced GROUP BY 1) GROUP BY 1) USING (period)
        LEFT JOIN (SELECT period, sum(tvl) AS tvl, sum(fees_value) AS total_fees, sum(new_fees_value) AS new_total_fees
                   FROM {assets} GROUP BY 1) USING (period)
        WINDOW o AS (ORDER BY period)"""


_DAY = "cast(timestamp AS date)"
_HOUR = "(date_trunc('hour', timestamp) + INTERVAL 1 HOUR)"
MEASURES = [
    "tvl", "volume", "users", "new_users", "trades", "total_staked", "staked_tvl", "total_holders", "total_stakers",
    "treasury_balance", "treasury_tvl", "total_issuance", "total_fees", "new_total_fees",
]
KINDS = {
    **dict.fromkeys(MEASURES, "bigint"),
    **dict.fromkeys(["tvl", "staked_tvl", "treasury_tvl", "total_fees", "new_total_fees"], "decimal(12,2)"),
    "volume": "decimal(18,6)",
}
ASSET_KINDS = {
    "tvl": "decimal(12,2)", "price": "decimal(20,10)", "balance": "decimal(16,4)", "fees": "decimal(18,9)",
    "fees_value": "decimal(12,2)", "new_fees": "decimal(18,9)", "new_fees_value": "decimal(12,2)",
}
VIEWS |= {
    "assets_by_day": _asset_history(_DAY),
    "assets_by_hour": _asset_history(_HOUR),
    "by_day": _exchange_history(_DAY, "assets_by_day"),
    "by_hour": _exchange_history(_HOUR, "assets_by_hour"),
}
VIEWS["ex_daily"] = f"""
        SELECT period AS stat_date, {', '.join(
            f"CASE WHEN period < {TODAY} THEN {m} END AS {m}" if m in ('volume', 'trades') else m for m in MEASURES)}
        FROM by_day"""

# Current and previous 24 hours.
_CUR = f"timestamp > {AS_OF} - INTERVAL 24 HOUR AND timestamp <= {AS_OF}"
_PREV = f"timestamp < {AS_OF} - INTERVAL 24 HOUR AND timestamp > {AS_OF} - INTERVAL 48 HOUR"


def _window_sums(condition: str, extra: str = "") -> str:
    return f"""
        SELECT base_asset_id, quote_asset_id, count(*) AS trades, sum(volume) AS volume,
               sum(volume_quote) AS volume_quote, sum(quantity) AS volume_base {extra}
        FROM priced WHERE {condition} GROUP BY 1, 2"""


VIEWS |= {
    "cur": _window_sums(_CUR, ", min(price) AS price_low, max(price) AS price_high"),
    "prev": _window_sums(_PREV),
}


def _legs(condition: str) -> str:
    return f"""
        SELECT asset_id, count(*) AS trades, sum(volume) AS volume
        FROM (SELECT base_asset_id AS asset_id, volume, timestamp FROM priced
              UNION ALL SELECT quote_asset_id, volume, timestamp FROM priced)
        WHERE {condition} GROUP BY 1"""


_TODAY_ONLY = f"cast(timestamp AS date) = {TODAY}"
VIEWS |= {
    "leg_cur": _legs(_CUR),
    "leg_prev": _legs(_PREV),
    "leg_day": _legs(_TODAY_ONLY),
    "idle_today": f"""
        SELECT * FROM state a WHERE NOT EXISTS (
            SELECT * FROM priced t WHERE {_TODAY_ONLY} AND t.base_asset_id = a.asset_id)
          AND NOT EXISTS (SELECT * FROM priced t WHERE {_TODAY_ONLY} AND t.quote_asset_id = a.asset_id)""",
    "hour_before": f"""
        SELECT h.* FROM assets_by_hour h
        JOIN (SELECT asset_id, max(period) AS period FROM assets_by_hour
              WHERE period <= {AS_OF} - INTERVAL 1 DAY GROUP BY 1) m
          ON m.asset_id = h.asset_id AND m.period = h.period""",
    "day_rows": f"""
        SELECT {TODAY} AS stat_date, asset_id, cast(sum(volume) AS decimal(18,6)) AS volume,
               cast(sum(trades) AS bigint) AS trades, {', '.join(f'any_value({c}) AS {c}' for c in ASSET_KINDS)}
        FROM (SELECT l.asset_id, l.volume, l.trades, {', '.join(ASSET_KINDS)} FROM leg_day l LEFT JOIN state s ON s.asset_id = l.asset_id
              UNION ALL SELECT asset_id, 0, 0, {', '.join(ASSET_KINDS)} FROM idle_today)
        GROUP BY asset_id""",
}


def _as(columns: dict[str, str], wrap: str = "{}") -> str:
    return ", ".join(f"cast({wrap.format(name)} AS {kind}) AS {name}" for name, kind in columns.items())


_FIGURES = {"trades": ("count(*)", "bigint"), "volume": ("sum(volume)", "decimal(18,6)"),
            "volume_quote": ("sum(volume_quote)", "decimal(20,10)"), "volume_base": ("sum(quantity)", "decimal(20,10)")}
# One pass over the trades with a condition for each figure.
_MARKETS_24H = f"""
    SELECT base_asset_id, quote_asset_id,
           {', '.join(
               f"cast(coalesce({figure} FILTER (WHERE {when}), 0) AS {kind}) AS {prefix}{name}"
               for prefix, when in (('', _CUR), ('previous_', _PREV)) for name, (figure, kind) in _FIGURES.items())},
           min(price) FILTER (WHERE {_CUR}) AS price_low, max(price) FILTER (WHERE {_CUR}) AS price_high,
           cast(coalesce(arg_max(price, trade_id) FILTER (WHERE timestamp <= {AS_OF} - INTERVAL 1 DAY), 0)
                AS decimal(20,10)) AS price_24h
    FROM market_list LEFT JOIN priced USING (base_asset_id, quote_asset_id)
    WHERE base_asset_id IN (SELECT asset_id FROM asset_list) AND quote_asset_id IN (SELECT asset_id FROM asset_list)
    GROUP BY 1, 2"""

_TRADES = "trade_id, base_asset_id, quote_asset_id, price, quantity, volume_quote, volume, timestamp"

_NEW_DAY_CARRIED = [m for m in MEASURES if m not in ("volume", "trades")]

SQL: dict[str, str] = {
    "src_trades": """
        SELECT trade_id, base_asset_id || '-' || quote_asset_id AS market, base_asset_id, quote_asset_id, price, quantity,
               volume_quote, timestamp, 'M' || trade_id AS m_id, 'T' || trade_id AS t_id, 'MC' || user_id AS m_cid,
               'TC' || user_id AS t_cid, CASE WHEN event_type IN ('purchase', 'view') THEN 'Ask' ELSE 'Bid' END AS m_side,
               CASE WHEN event_type IN ('purchase', 'view') THEN 'Bid' ELSE 'Ask' END AS t_side, 'O' || trade_id AS trade_oid
        FROM src""",
    "asset_listing": "SELECT * FROM listing",
    "market_listing": """
        SELECT DISTINCT base_asset_id || '-' || quote_asset_id AS market, base_asset_id, quote_asset_id
        FROM (SELECT cast(l_partkey AS varchar) AS base_asset_id, cast(l_suppkey * 25 AS varchar) AS quote_asset_id FROM lineitem)
        WHERE base_asset_id IN (SELECT asset_id FROM listing) AND quote_asset_id IN (SELECT asset_id FROM listing)""",
    "market_split": """
        SELECT l_partkey || '-' || l_suppkey * 25 AS market, cast(l_partkey AS varchar) AS base_asset_id,
               cast(l_suppkey * 25 AS varchar) AS quote_asset_id FROM lineitem""",
    "orderbook_snapshot": """
        SELECT base_asset_id, quote_asset_id, price, side, new.stid AS stid, new.quantity AS quantity
        FROM book_lines WHERE new IS NOT NULL""",
    "orderbook_failed_pages": """
        SELECT base_asset_id, quote_asset_id, price, side, taken.stid AS stid, taken.quantity AS quantity
        FROM (SELECT *, CASE WHEN base_asset_id IN ('S5', 'S6') THEN old ELSE new END AS taken FROM book_lines)
        WHERE taken IS NOT NULL""",
    "wallet_balances": """
        SELECT 'pool' AS wallet, a.asset_id, raw AS balance_raw FROM asset_list a LEFT JOIN pool p ON p.asset_id = a.asset_id
        UNION ALL SELECT 'fees', a.asset_id, raw FROM asset_list a LEFT JOIN held h ON h.asset_id = a.asset_id
        UNION ALL SELECT 'treasury', asset_id, CASE WHEN asset_id = 'A00' THEN (SELECT raw FROM treasury) END FROM asset_list""",
    "metric_latest": """
        SELECT o_orderpriority AS metric, max(o_orderdate) AS observed_at, arg_max(o_custkey, (o_orderdate, o_custkey)) AS value
        FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1""",
    "stakers_by_role": """
        SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL WHEN c_mktsegment = 'BUILDING' THEN c_custkey
                               WHEN c_mktsegment = 'MACHINERY' THEN c_nationkey + c_custkey END AS stakers FROM customer""",
    "transfers_after_cursor": """
        SELECT transfer_id, asset_symbol, amount, block_num, event_idx FROM transfers
        WHERE block_num > 0 OR (block_num = 0 AND event_idx > 4)""",
    "transfers_next_page": """
        SELECT transfer_id, asset_symbol, amount, block_num, event_idx FROM transfers
        WHERE block_num > 20 OR (block_num = 20 AND event_idx > 4) ORDER BY block_num, event_idx LIMIT 100""",
    "cursor_advance": """
        SELECT 'fees.after_id:block_num' AS data_name, cast(arg_max(block_num, (block_num, event_idx)) AS varchar) AS data_value
        FROM transfers UNION ALL
        SELECT 'fees.after_id:event_idx', cast(arg_max(event_idx, (block_num, event_idx)) AS varchar) FROM transfers""",
    "book_scan": """
        SELECT base_asset_id, quote_asset_id, price, side FROM book_lines WHERE old IS NOT NULL AND base_asset_id = 'S7'""",
    "asset_price_scan": "SELECT asset_id, price FROM asset_price",
    "bulk_sink": f"SELECT cast(timestamp AS date) AS trade_date, {_TRADES} FROM priced",
    "admitted_trades": f"SELECT {_TRADES.replace(' volume,', '')} FROM admitted",
    "window_boundary": f"""
        SELECT trade_id, timestamp,
               CASE WHEN timestamp > edge AND timestamp <= edge + INTERVAL 24 HOUR THEN 'current'
                    WHEN timestamp < edge AND timestamp > edge - INTERVAL 24 HOUR THEN 'previous' END AS in_window
        FROM admitted, (SELECT max(timestamp) AS edge FROM admitted WHERE timestamp <= {AS_OF})""",
    "price_changes": """
        SELECT trade_id, base_asset_id, quote_asset_id, timestamp, price, previous_price
        FROM (SELECT *, lag(price) OVER (PARTITION BY base_asset_id, quote_asset_id ORDER BY timestamp, trade_id) AS previous_price
              FROM admitted) WHERE previous_price IS NULL OR previous_price <> price""",
    "price_carry_forward": """
        SELECT base_asset_id AS asset_id, timestamp, trade_id, own AS price,
               last_value(own IGNORE NULLS) OVER (PARTITION BY base_asset_id ORDER BY timestamp, trade_id
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS carried_price
        FROM (SELECT *, CASE WHEN event_type IN ('purchase', 'signup') THEN price END AS own FROM src)""",
    "asof_latest_before": "SELECT asset_id, period AS stat_time, price, tvl, fees FROM hour_before",
    "idle_assets": "SELECT asset_id, symbol FROM idle_today",
    "idle_markets": """
        SELECT base_asset_id, quote_asset_id FROM market_list m WHERE NOT EXISTS (
            SELECT * FROM priced t WHERE t.base_asset_id = m.base_asset_id AND t.quote_asset_id = m.quote_asset_id)""",
    "orphan_keys": f"""
        SELECT table_name, column_name, asset_id, count(*) AS row_count
        FROM (SELECT table_name, unnest(['base_asset_id', 'quote_asset_id']) AS column_name,
                     unnest([base_asset_id, quote_asset_id]) AS asset_id
              FROM (SELECT 'trades' AS table_name, base_asset_id, quote_asset_id FROM src
                    UNION ALL SELECT 'markets', base_asset_id, quote_asset_id
                    FROM (SELECT base_asset_id, quote_asset_id FROM src UNION SELECT base_asset_id, quote_asset_id FROM market_list)
                    UNION ALL SELECT 'markets_daily', base_asset_id, quote_asset_id
                    FROM (SELECT DISTINCT cast(timestamp AS date), base_asset_id, quote_asset_id FROM src)
                    UNION ALL SELECT 'markets_24h', base_asset_id, quote_asset_id
                    FROM (SELECT DISTINCT base_asset_id, quote_asset_id FROM src WHERE timestamp > {AS_OF} - INTERVAL 1 DAY)))
        WHERE asset_id NOT IN (SELECT asset_id FROM asset_list) GROUP BY 1, 2, 3""",
    "markets_daily": f"""
        SELECT {TODAY} AS stat_date, base_asset_id, quote_asset_id, cast(sum(volume) AS decimal(18,6)) AS volume,
               cast(sum(volume_quote) AS decimal(20,10)) AS volume_quote, cast(sum(quantity) AS decimal(20,10)) AS volume_base,
               count(*) AS trades
        FROM priced WHERE {_TODAY_ONLY} GROUP BY 2, 3
        UNION ALL
        SELECT {TODAY}, base_asset_id, quote_asset_id, 0, 0, 0, 0 FROM market_list m WHERE NOT EXISTS (
            SELECT * FROM priced t WHERE t.base_asset_id = m.base_asset_id AND t.quote_asset_id = m.quote_asset_id)""",
    "assets_daily": "SELECT * FROM day_rows",
    "assets_daily_compat": f"""
        SELECT {TODAY} AS stat_date, asset_id, cast(sum(volume) AS decimal(18,6)) AS volume,
               cast(sum(trades) AS bigint) AS trades, cast(sum(tvl) AS decimal(12,2)) AS tvl,
               {', '.join(f'any_value({c}) AS {c}' for c in ASSET_KINDS if c != 'tvl')}
        FROM (SELECT l.*, {', '.join(ASSET_KINDS)} FROM
                (SELECT base_asset_id AS asset_id, sum(volume) AS volume, count(*) AS trades FROM priced
                 WHERE {_TODAY_ONLY} GROUP BY 1
                 UNION SELECT quote_asset_id, sum(volume), count(*) FROM priced WHERE {_TODAY_ONLY} GROUP BY 1) l
              LEFT JOIN state s ON s.asset_id = l.asset_id
              UNION SELECT asset_id, 0, 0, {', '.join(ASSET_KINDS)} FROM idle_today)
        GROUP BY asset_id""",
    "markets_24h": _MARKETS_24H,
    "markets_24h_from_closes": _MARKETS_24H,
    "assets_24h": f"""
        SELECT a.asset_id, cast(coalesce(c.volume, 0) AS decimal(18,6)) AS volume, cast(coalesce(c.trades, 0) AS bigint) AS trades,
               {', '.join(f"a.{n}" if n == 'balance' else f"cast(coalesce(a.{n}, 0) AS {k}) AS {n}" for n, k in ASSET_KINDS.items())},
               cast(coalesce(p.volume, 0) AS decimal(18,6)) AS previous_volume,
               cast(coalesce(p.trades, 0) AS bigint) AS previous_trades,
               {', '.join(f"cast(coalesce(h.{n}, 0) AS {k}) AS previous_{n}" for n, k in ASSET_KINDS.items())}
        FROM state a LEFT JOIN leg_cur c ON c.asset_id = a.asset_id LEFT JOIN leg_prev p ON p.asset_id = a.asset_id
                     LEFT JOIN hour_before h ON h.asset_id = a.asset_id""",
    "exchange_24h": f"""
        SELECT {', '.join(
            [f"cast(coalesce(d.{m}, 0) AS {KINDS[m]}) AS {m}, cast(coalesce(h1.{m}, 0) AS {KINDS[m]}) AS previous_{m}"
             for m in MEASURES if m not in ('volume', 'trades', 'new_users')])},
               coalesce(d.users, 0) - coalesce(h1.users, 0) AS new_users,
               coalesce(h1.users, 0) - coalesce(h2.users, 0) AS previous_new_users,
               (SELECT count(*) FROM priced WHERE {_CUR}) AS trades, (SELECT count(*) FROM priced WHERE {_PREV}) AS previous_trades,
               cast(coalesce((SELECT sum(volume) FROM priced WHERE {_CUR}), 0) AS decimal(18,6)) AS volume,
               cast(coalesce((SELECT sum(volume) FROM priced WHERE {_PREV}), 0) AS decimal(18,6)) AS previous_volume
        FROM (SELECT * FROM ex_daily ORDER BY stat_date DESC LIMIT 1) d
        LEFT JOIN (SELECT * FROM by_hour WHERE period <= {AS_OF} - INTERVAL 1 DAY ORDER BY period DESC LIMIT 1) h1 ON true
        LEFT JOIN (SELECT * FROM by_hour WHERE period <= {AS_OF} - INTERVAL 2 DAY ORDER BY period DESC LIMIT 1) h2 ON true""",
    "exchange_daily_close": f"""
        SELECT stat_date, {', '.join(m for m in MEASURES if m not in ('volume', 'trades'))},
               CASE WHEN stat_date = {TODAY} THEN (SELECT cast(sum(volume) AS decimal(18,6)) FROM priced WHERE {_TODAY_ONLY})
                    ELSE volume END AS volume,
               CASE WHEN stat_date = {TODAY} THEN (SELECT count(*) FROM priced WHERE {_TODAY_ONLY}) ELSE trades END AS trades
        FROM ex_daily""",
    "exchange_daily_measures": f"""
        SELECT stat_date, {', '.join(m for m in MEASURES if m not in ('tvl', 'total_fees', 'new_total_fees', 'users', 'total_stakers'))},
               CASE WHEN t THEN cast((SELECT sum(tvl) FROM state) AS decimal(12,2)) ELSE tvl END AS tvl,
               CASE WHEN t THEN cast((SELECT sum(fees_value) FROM state) AS decimal(12,2)) ELSE total_fees END AS total_fees,
               CASE WHEN t THEN cast((SELECT sum(new_fees_value) FROM state) AS decimal(12,2)) ELSE new_total_fees END AS new_total_fees,
               CASE WHEN t THEN (SELECT count(DISTINCT user_id) FROM events) ELSE users END AS users,
               CASE WHEN t THEN (SELECT count(*) FROM events) ELSE total_stakers END AS total_stakers
        FROM (SELECT *, stat_date = {TODAY} AS t FROM ex_daily)""",
    "exchange_alltime": """
        SELECT cast(sum(volume) AS decimal(18,2)) AS volume, cast(sum(trades) AS bigint) AS trades,
               cast((SELECT total_fees FROM ex_daily ORDER BY stat_date DESC LIMIT 1) AS decimal(18,2)) AS total_fees
        FROM ex_daily""",
    "latest_day": f"""
        SELECT stat_date, users FROM ex_daily WHERE stat_date <= {TODAY} - INTERVAL 1 DAY ORDER BY stat_date DESC LIMIT 1""",
    "new_day_rollforward": f"""
        SELECT stat_date, {', '.join(
            f"CASE WHEN stat_date = {TODAY} THEN coalesce({m}, (SELECT arg_max_null({m}, stat_date) FROM ex_daily WHERE stat_date < {TODAY})) ELSE {m} END AS {m}"
            if m not in ('volume', 'trades') else m for m in MEASURES)}
        FROM ex_daily
        UNION ALL
        SELECT {TODAY} + 1, {', '.join(
            'NULL' if m in ('volume', 'trades', 'total_fees', 'new_total_fees')
            else f"coalesce({m}, (SELECT arg_max_null({m}, stat_date) FROM ex_daily WHERE stat_date < {TODAY}))" for m in MEASURES)}
        FROM ex_daily WHERE stat_date = {TODAY}""",
    "assets_hourly": f"SELECT {AS_OF} AS stat_time, asset_id, {', '.join(ASSET_KINDS)} FROM state",
    "exchange_hourly": f"""
        SELECT {AS_OF} AS stat_time, {', '.join(MEASURES)} FROM ex_daily ORDER BY stat_date DESC LIMIT 1""",
    "day_replace": f"""
        SELECT period AS stat_date, asset_id, volume, trades, {', '.join(ASSET_KINDS)} FROM assets_by_day WHERE period <> {TODAY}
        UNION ALL SELECT stat_date, asset_id, volume, trades, {', '.join(ASSET_KINDS)} FROM day_rows""",
    "retained_trades": """
        SELECT trade_id, timestamp FROM priced
        WHERE NOT timestamp <= cast(DATE '2024-03-15' - INTERVAL 60 DAY AS timestamp)""",
    "retained_hourly": f"""
        SELECT period AS stat_time, asset_id, price FROM assets_by_hour WHERE NOT period <= {AS_OF} - INTERVAL 7 DAY""",
    "priced_trades": f"SELECT {_TRADES} FROM priced",
    "market_last_price": """
        SELECT base_asset_id, quote_asset_id, arg_max(price, trade_id) AS price FROM admitted GROUP BY 1, 2""",
    "asset_last_price": f"""
        SELECT base_asset_id AS asset_id, {rounded('arg_max(usd, trade_id)', 'decimal(20,10)')} AS price,
               arg_max(timestamp, trade_id) AS timestamp, max(trade_id) AS trade_id
        FROM priced WHERE usd IS NOT NULL GROUP BY 1""",
    "asset_tvl": "SELECT asset_id, balance, tvl FROM state",
    "fee_withdrawals_by_asset": """
        SELECT asset_symbol, asset_id, cast(sum(amount) AS decimal(20,10)) AS amount
        FROM transfers JOIN asset_list ON symbol = asset_symbol GROUP BY 1, 2""",
    "asset_fees": f"""
        SELECT asset_id, fees, cast(fees * price AS decimal(12,2)) AS fees_value, new_fees,
               cast(new_fees * price AS decimal(12,2)) AS new_fees_value
        FROM (SELECT *, cast(CASE WHEN fees - previous < 0 THEN 0 ELSE fees - previous END AS decimal(18,9)) AS new_fees
              FROM (SELECT s.asset_id, s.price, cast(s.fees + coalesce(w.amount, 0) AS decimal(18,9)) AS fees, p.fees AS previous
                    FROM state s
                    LEFT JOIN (SELECT asset_id, sum(amount) AS amount FROM transfers JOIN asset_list ON symbol = asset_symbol
                               GROUP BY 1) w ON w.asset_id = s.asset_id
                    LEFT JOIN (SELECT asset_id, arg_max(fees, period) AS fees FROM assets_by_day
                               WHERE period <= {TODAY} - INTERVAL 1 DAY GROUP BY 1) p ON p.asset_id = s.asset_id))""",
    "fee_deltas": """
        SELECT period AS stat_date, asset_id, fees,
               cast(CASE WHEN before IS NULL THEN NULL ELSE greatest(0, fees - before) END AS decimal(18,9)) AS new_fees
        FROM (SELECT *, lag(fees) OVER (PARTITION BY asset_id ORDER BY period) AS before FROM assets_by_day)""",
    "user_deltas": """
        SELECT stat_date, users, users - lag(users) OVER (ORDER BY stat_date) AS new_users FROM ex_daily""",
    # Amounts have six decimals at least, so cents are taken by whole division.
    "treasury_metrics": """
        SELECT cast(round(cast(staked // 10000000000 AS decimal(18,0)) * 0.01) AS bigint) AS total_staked,
               cast(cast(staked / 10000000000 AS double) * 0.01 * price AS decimal(12,2)) AS staked_tvl,
               cast(round(cast(raw // 10000000000 AS decimal(18,0)) * 0.01) AS bigint) AS treasury_balance,
               cast(cast(raw / 10000000000 AS double) * 0.01 * price AS decimal(12,2)) AS treasury_tvl,
               cast(round(cast(issuance // 10000000000 AS decimal(18,0)) * 0.01) AS bigint) AS total_issuance
        FROM (SELECT cast(sum(cast(l_quantity AS decimal(18,2))) * 100000000 AS decimal(24,0)) AS staked,
                     cast(sum(cast(l_extendedprice AS decimal(18,2))) * 100000000 AS decimal(24,0)) AS issuance FROM lineitem),
             treasury, (SELECT price FROM asset_price WHERE asset_id = 'A00')""",
    "scaled_amounts": """
        SELECT c_custkey, cast((raw - ((raw % 1000000) + 1000000) % 1000000) / 1000000 * 0.000001 AS decimal(19,6)) AS balance,
               cast(floor(raw / 10000000000.0) * 0.01 AS decimal(15,2)) AS readable
        FROM (SELECT c_custkey, cast(cast(c_acctbal AS decimal(12,2)) * 100 AS bigint) * 12345678 + c_custkey AS raw FROM customer)""",
    "upsert_trades": f"""
        SELECT {_TRADES.replace('quantity,', "CASE WHEN n THEN cast(quantity + 1 AS decimal(20,10)) ELSE quantity END AS quantity,")
                .replace('volume, timestamp', "CASE WHEN NOT n THEN volume END AS volume, CASE WHEN n THEN timestamp + INTERVAL 1 SECOND ELSE timestamp END AS timestamp")}
        FROM (SELECT *, event_type IN ('purchase', 'signup') AS n FROM priced)""",
    "upsert_assets_nullsafe": """
        SELECT coalesce(s.id, t.id) AS asset_id, CASE WHEN s.id IS NULL THEN t.symbol ELSE 'LINE' END AS symbol,
               CASE WHEN s.id IS NULL THEN t.name WHEN odd THEN 'odd' ELSE 'even' END AS name, true AS is_active,
               cast(coalesce(CASE WHEN odd THEN top END, t.price) AS decimal(20,10)) AS price,
               cast(total AS decimal(12,2)) AS tvl,
               cast(coalesce(CASE WHEN NOT odd THEN n END, t.balance) AS decimal(16,4)) AS balance,
               cast(NULL AS decimal(18,9)) AS fees, cast(NULL AS decimal(12,2)) AS fees_value,
               cast(NULL AS decimal(18,9)) AS new_fees, cast(NULL AS decimal(12,2)) AS new_fees_value
        FROM (SELECT cast(p_partkey AS varchar) AS id, p_brand AS symbol, p_name AS name,
                     cast(p_retailprice AS decimal(18,2)) AS price, p_size AS balance FROM part) t
        FULL JOIN (SELECT cast(l_partkey AS varchar) AS id, cast(max(l_extendedprice) AS decimal(18,2)) AS top,
                          cast(sum(l_quantity) AS decimal(18,2)) AS total, count(*) AS n, count(*) % 2 = 1 AS odd
                   FROM lineitem GROUP BY 1) s ON s.id = t.id""",
    "upsert_markets": """
        SELECT m.base_asset_id, m.quote_asset_id, true AS is_active, l.price FROM market_list m
        LEFT JOIN (SELECT base_asset_id, quote_asset_id, arg_max(price, trade_id) AS price FROM admitted GROUP BY 1, 2) l
          ON l.base_asset_id = m.base_asset_id AND l.quote_asset_id = m.quote_asset_id""",
    "insert_ignore_transfers": """
        SELECT transfer_id, asset_symbol, amount FROM transfers
        WHERE o_orderstatus = 'F' OR o_orderpriority NOT IN ('5-LOW', '2-HIGH')""",
    "orderbook_diff": """
        SELECT base_asset_id, quote_asset_id, price, side, coalesce(old.stid, new.stid) AS stid,
               old.quantity AS old_quantity, new.quantity AS quantity,
               CASE WHEN old IS NULL THEN 'insert' WHEN new IS NULL THEN 'delete'
                    WHEN old.quantity = new.quantity THEN 'same' ELSE 'update' END AS change
        FROM book_lines""",
    "orderbook_apply": """
        SELECT base_asset_id, quote_asset_id, price, side, coalesce(old.stid, new.stid) AS stid, new.quantity AS quantity
        FROM book_lines WHERE new IS NOT NULL""",
    "stream_priced_trades": f"SELECT {_TRADES} FROM priced",
    "stream_daily_windows": """
        SELECT date_trunc('day', timestamp) AS window_start, date_trunc('day', timestamp) + INTERVAL 1 DAY AS window_end,
               base_asset_id, quote_asset_id, count(*) AS trades, cast(sum(volume) AS decimal(18,6)) AS volume,
               cast(sum(volume_quote) AS decimal(20,10)) AS volume_quote, cast(sum(quantity) AS decimal(20,10)) AS volume_base
        FROM priced GROUP BY 1, 2, 3, 4
        HAVING date_trunc('day', timestamp) + INTERVAL 1 DAY <= (SELECT max(timestamp) FROM priced) - INTERVAL 1 HOUR""",
    "stream_sliding_24h": """
        SELECT window_end - INTERVAL 24 HOUR AS window_start, window_end, base_asset_id, quote_asset_id,
               cast(sum(trades) AS bigint) AS trades, cast(sum(volume) AS decimal(18,6)) AS volume,
               cast(sum(volume_quote) AS decimal(20,10)) AS volume_quote, cast(sum(volume_base) AS decimal(20,10)) AS volume_base
        FROM (SELECT date_trunc('hour', timestamp) + (1 + i) * INTERVAL 1 HOUR AS window_end, base_asset_id, quote_asset_id,
                     count(*) AS trades, sum(volume) AS volume, sum(volume_quote) AS volume_quote, sum(quantity) AS volume_base
              FROM priced, (SELECT unnest(range(24)) AS i) GROUP BY 1, 2, 3)
        GROUP BY 2, 3, 4
        HAVING window_end <= (SELECT max(timestamp) FROM priced) - INTERVAL 1 HOUR""",
}
SQL |= {
    "late_markets_daily": """
        SELECT cast(timestamp AS date) AS stat_date, base_asset_id, quote_asset_id, cast(sum(volume) AS decimal(18,6)) AS volume,
               cast(sum(volume_quote) AS decimal(20,10)) AS volume_quote, cast(sum(quantity) AS decimal(20,10)) AS volume_base,
               count(*) AS trades
        FROM priced GROUP BY 1, 2, 3
        UNION ALL
        SELECT period, base_asset_id, quote_asset_id, 0, 0, 0, 0 FROM by_day, market_list m WHERE NOT EXISTS (
            SELECT * FROM priced t WHERE t.base_asset_id = m.base_asset_id AND t.quote_asset_id = m.quote_asset_id)""",
    # What a day recorded besides its trades stays.
    "late_assets_daily": f"""
        SELECT period AS stat_date, s.asset_id, CASE WHEN l.asset_id IS NULL THEN 0 ELSE l.volume END AS volume,
               coalesce(l.trades, 0) AS trades, {', '.join(ASSET_KINDS)}
        FROM (SELECT period FROM by_day) CROSS JOIN state s LEFT JOIN
             (SELECT day, asset_id, cast(sum(volume) AS decimal(18,6)) AS volume, count(*) AS trades
              FROM (SELECT cast(timestamp AS date) AS day, unnest([base_asset_id, quote_asset_id]) AS asset_id, volume FROM priced)
              GROUP BY 1, 2) l ON l.day = period AND l.asset_id = s.asset_id""",
    "late_exchange_daily": f"SELECT period AS stat_date, {', '.join(MEASURES)} FROM by_day",
    "late_alltime": """
        SELECT cast(sum(volume) AS decimal(18,2)) AS volume, cast(sum(trades) AS bigint) AS trades FROM by_day""",
    "stream_late_trades": SQL["stream_priced_trades"],
}
SQL["orderbook_few_markets"] = """
        SELECT base_asset_id, quote_asset_id, price, side, taken.stid AS stid, taken.quantity AS quantity
        FROM (SELECT *, CASE WHEN base_asset_id NOT IN ('S5', 'S7') THEN old
                             WHEN new IS NOT NULL AND old IS NOT NULL
                             THEN {'number': new.number, 'quantity': new.quantity, 'stid': old.stid} ELSE new END AS taken
              FROM book_lines)
        WHERE taken IS NOT NULL"""
SQL |= {
    "orphan_keys_stored": f"""
        SELECT table_name, column_name, asset_id, count(*) AS row_count
        FROM (SELECT table_name, unnest(['base_asset_id', 'quote_asset_id']) AS column_name,
                     unnest([base_asset_id, quote_asset_id]) AS asset_id
              FROM (SELECT 'trades' AS table_name, base_asset_id, quote_asset_id FROM priced
                    UNION ALL SELECT 'markets', base_asset_id, quote_asset_id FROM market_list
                    UNION ALL SELECT 'markets_daily', base_asset_id, quote_asset_id FROM ({SQL['late_markets_daily']})
                    UNION ALL SELECT 'markets_24h', base_asset_id, quote_asset_id FROM market_list))
        WHERE asset_id IN ('A07', 'A98') GROUP BY 1, 2, 3""",
    "market_history": """
        SELECT base_asset_id, quote_asset_id, min(taken) AS valid_from, arg_max_null(following, taken) AS valid_to
        FROM (SELECT *, number - row_number() OVER (PARTITION BY base_asset_id, quote_asset_id ORDER BY number) AS run
              FROM (SELECT DISTINCT base_asset_id, quote_asset_id, date_trunc('day', timestamp) AS day FROM admitted WHERE trade_id % 2 = 0)
              JOIN (SELECT cast(day AS timestamp) AS taken, row_number() OVER (ORDER BY day) AS number,
                           cast(lead(day) OVER (ORDER BY day) AS timestamp) AS following
                    FROM (SELECT DISTINCT date_trunc('day', timestamp) AS day FROM admitted)) ON taken = day)
        GROUP BY base_asset_id, quote_asset_id, run""",
    "replayed_trades": f"""
        SELECT {_TRADES.replace(' volume,', '')} FROM admitted t WHERE EXISTS (
            SELECT * FROM admitted l WHERE l.trade_id % 2 = 0 AND l.base_asset_id = t.base_asset_id
              AND l.quote_asset_id = t.quote_asset_id AND cast(l.timestamp AS date) = cast(t.timestamp AS date))""",
}
SQL["insert_ignore_ranges"] = SQL["insert_ignore_transfers"]
SQL["markets_24h_from_panes"] = _MARKETS_24H
SQL["merge_trades"] = SQL["upsert_trades"]
SQL["stream_repriced_trades"] = SQL["stream_priced_trades"]
SQL["markets_daily_from_panes"] = SQL["markets_daily"]
SQL["orderbook_job"] = f"""
        SELECT *, {AS_OF} + INTERVAL 2 MINUTE AS last_update FROM ({SQL['orderbook_apply']})"""


def _with(sql: str) -> str:
    """Prefix ``sql`` with the views it names, in order of dependency."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for word in set(re.findall(r"[a-z_0-9]+", text)):
            if word in VIEWS and word not in needed:
                needed.add(word)
                visit(VIEWS[word])

    visit(sql)
    views = ", ".join(f"{name} AS ({text})" for name, text in VIEWS.items() if name in needed)
    return f"WITH {views} {sql}" if views else sql


ORACLE = {name: " ".join(_with(sql).split()) for name, sql in SQL.items()}
