"""USD pricing of trades.

In (timestamp, trade_id) order: a trade quoted in a stable asset has its quote volume as USD volume and
sets the price of its base asset; any other trade takes the last USD price of its quote asset, if there
is one, for its volume and for the new price of its base; without one the volume stays null and the
price of the base is unchanged.

Only few assets are used as quotes, and only their price history is needed.  So their ticks are settled
first, from the narrow columns of the few trades that have such an asset as base: level by level of the
asset graph (a market is an edge base -> quote), because a tick needs the ticks of its quote asset.
Assets on a cycle, and those above one, cannot be levelled; their ticks are resolved by pointer
doubling.  Then all trades are priced in one pass, and each is shuffled once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tradeglass.config import ExchangeConfig
from tradeglass.operators.lastknown import Slices, choose_slices, last_known
from tradeglass.schemas import PRICE, VOLUME
from tradeglass.session import cut_lineage

ORDER = ["timestamp", "trade_id"]
_FIRST_ID = -(2**63)


def quote_levels(pairs: list[tuple[str, str]], stable: tuple[str, ...]) -> tuple[dict[str, int], set[str]]:
    """Level of each asset whose prices can be settled in order, and the assets that cannot.

    Stable assets count as settled.  An asset is one level above the highest asset it is quoted in; an
    asset that is never a base has level 1 (only a previous price can make it known).
    """
    quotes: dict[str, set[str]] = {}
    for base, quote in pairs:
        quotes.setdefault(base, set())
        quotes.setdefault(quote, set())
        if quote not in stable:
            quotes[base].add(quote)
    level: dict[str, int] = {}
    open_assets = set(quotes)
    while True:
        ready = {asset for asset in open_assets if all(q in level for q in quotes[asset])}
        if not ready:
            return level, open_assets
        level.update({asset: 1 + max((level[q] for q in quotes[asset]), default=0) for asset in ready})
        open_assets -= ready


def _quote_graph(
    trades: DataFrame, stable: tuple[str, ...], ticks: DataFrame | None
) -> tuple[set[str], list[tuple[str, str]], int]:
    """Assets used as quotes, the markets between two of them, and the most trades that one of them has on
    both sides (and known ticks).  The driver sees these few assets and markets only, however many others there are."""
    markets = cut_lineage(trades.groupBy("base_asset_id", "quote_asset_id").agg(F.count(F.lit(1)).alias("n")))
    used = markets.filter(~F.col("quote_asset_id").isin(*stable)).select(F.col("quote_asset_id").alias("asset")).distinct()
    quotes = {row.asset for row in used.collect()}
    inner = markets.join(used.withColumnRenamed("asset", "base_asset_id"), "base_asset_id", "left_semi")
    inner = inner.join(used.withColumnRenamed("asset", "quote_asset_id"), "quote_asset_id", "left_semi")
    sides = markets.select(F.explode(F.array_distinct(F.array("base_asset_id", "quote_asset_id"))).alias("asset"), "n")
    if ticks is not None:
        sides = sides.unionByName(ticks.groupBy("asset").agg(F.count(F.lit(1)).alias("n")))
    load = sides.join(used, "asset", "left_semi").groupBy("asset").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0]
    return quotes, [(r.base_asset_id, r.quote_asset_id) for r in inner.collect()], load or 0


TICK = ["asset", *ORDER, "usd_price"]


def seed_ticks(seeds: DataFrame, *, placed: bool = False) -> DataFrame:
    """Previous prices as ticks before every trade; ``placed``: at the trade that made them, where one did."""
    start, first = F.lit("0001-01-01 00:00:00").cast("timestamp"), F.lit(_FIRST_ID).cast("bigint")
    return seeds.filter(F.col("usd_price").isNotNull()).select(
        F.col("asset_id").alias("asset"),
        (F.coalesce("timestamp", start) if placed else start).alias("timestamp"),
        (F.coalesce("trade_id", first) if placed else first).alias("trade_id"),
        F.col("usd_price").cast("double").alias("usd_price"),
    )


def _as_of_quote(probes: DataFrame, ticks: DataFrame, value: str, into: str, slices: Slices | str | None) -> DataFrame:
    """Add the last ``value`` among earlier ticks of each probe's quote asset.

    Probes and ticks go through one shuffle together; of a probe and a tick at the same place (a market
    of an asset against itself) the probe comes first.
    """
    rows = probes.withColumns({"asset": F.col("quote_asset_id"), "_tick": F.lit(0)}).unionByName(
        ticks.withColumn("_tick", F.lit(1)), allowMissingColumns=True
    )
    found = last_known(rows, ["asset"], [*ORDER, "_tick"], value, into, slices=slices)
    return found.filter(F.col("_tick") == 0).drop("asset", "_tick", value)


def price_trades(
    trades: DataFrame,
    config: ExchangeConfig,
    *,
    seeds: DataFrame | None = None,
    ticks: DataFrame | None = None,
    slices: Slices | str | None = "auto",
) -> DataFrame:
    """Add ``volume`` (USD) and ``usd_price`` (price of the base asset this trade set, null if none).

    ``seeds`` are previous prices (asset_id, usd_price), ``ticks`` prices made by other trades (asset, timestamp,
    trade_id, usd_price).  ``slices`` overrides the choice of time slices.
    """
    stable = config.stable_assets
    trades = trades.drop("volume", "usd_price")
    quoted_stable = F.col("quote_asset_id").isin(*stable)
    direct = trades.filter(quoted_stable).withColumns(
        {"volume": F.col("volume_quote").cast(VOLUME), "usd_price": F.col("price").cast("double")}
    )
    rest = trades.filter(~quoted_stable)

    quotes, inner, load = _quote_graph(trades, stable, ticks)
    if not quotes:
        return direct
    if slices == "auto":
        slices = _slices_for(trades, config, quotes, ticks) if load > config.rows_per_slice else None
    given = [part for part in (None if seeds is None else seed_ticks(seeds), ticks) if part is not None]
    history = _quote_ticks(direct, rest, inner, quotes, stable, given, slices)
    priced = _as_of_quote(rest, history, "usd_price", "_quote_usd", slices)
    quote_usd = F.col("_quote_usd")
    priced = priced.withColumns(
        {
            "volume": (F.col("volume_quote").cast("double") * quote_usd).cast(VOLUME),
            "usd_price": F.col("price").cast("double") * quote_usd,
        }
    )
    return direct.unionByName(priced.drop("_quote_usd"))


def _quote_ticks(
    direct: DataFrame,
    rest: DataFrame,
    inner: list[tuple[str, str]],
    quotes: set[str],
    stable: tuple[str, ...],
    given: list[DataFrame],
    slices: Slices | str | None,
) -> DataFrame:
    """All prices of the assets used as quotes, given ones included."""
    base = F.col("base_asset_id").alias("asset")
    known = direct.select(base, *ORDER, "usd_price").filter(F.col("asset").isin(*quotes))
    needed = rest.select("base_asset_id", "quote_asset_id", *ORDER, F.col("price").cast("double").alias("own"))
    needed = needed.filter(F.col("base_asset_id").isin(*quotes))
    settled = [known, *[part.select(*TICK).filter(F.col("asset").isin(*quotes)) for part in given]]
    level, looped = quote_levels(inner, stable)
    # Only the trades of markets between two quote assets make ticks that need other ticks.
    for step in sorted({level[q] for _, q in inner if q in level}):
        assets = sorted({q for _, q in inner if level.get(q) == step})
        probes = needed.filter(F.col("quote_asset_id").isin(*assets))
        history = _union(settled).filter(F.col("asset").isin(*assets))
        found = _as_of_quote(probes, history, "usd_price", "_quote_usd", slices)
        made = found.filter(F.col("_quote_usd").isNotNull()).select(
            base, *ORDER, (F.col("own") * F.col("_quote_usd")).alias("usd_price")
        )
        settled.append(cut_lineage(made))
    if any(q in looped for _, q in inner):
        members = sorted({q for _, q in inner if q in looped})
        probes = needed.filter(F.col("quote_asset_id").isin(*members))
        history = _union(settled).filter(F.col("asset").isin(*members))
        settled.append(_chained_ticks(probes, history, slices))
    return _union(settled)


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda left, right: left.unionByName(right), parts)


def _slices_for(trades: DataFrame, config: ExchangeConfig, quotes: set[str], ticks: DataFrame | None) -> Slices | None:
    """Slices in which each busy quote asset, counting its trades on both sides and known ticks, fits."""
    legs = trades.select(F.explode(F.array("base_asset_id", "quote_asset_id")).alias("asset"), *ORDER)
    if ticks is not None:
        legs = legs.unionByName(ticks.select("asset", *ORDER))
    return choose_slices(legs.filter(F.col("asset").isin(*quotes)), ["asset"], *ORDER, config.rows_per_slice)


# --- assets that cannot be levelled ---------------------------------------------------------------


def _place(prefix: str = "") -> Column:
    return F.struct(*[F.col(prefix + name).alias(name) for name in ORDER])


def _known_from(chained: DataFrame, base_ticks: DataFrame) -> DataFrame:
    """Per asset the place of its first price.  An asset becomes known by its first trade after its quote
    asset is known, so places are relaxed until they stay the same; one row per asset."""
    known = cut_lineage(base_ticks.groupBy("asset").agg(F.min(_place()).alias("place")))
    while True:
        reached = (
            chained.join(known.select(F.col("asset").alias("quote_asset_id"), F.col("place").alias("_from")), "quote_asset_id")
            .filter(_place() > F.col("_from"))
            .groupBy(F.col("base_asset_id").alias("asset"))
            .agg(F.min(_place()).alias("place"))
        )
        closer = cut_lineage(known.unionByName(reached).groupBy("asset").agg(F.min("place").alias("place")))
        if closer.join(known, ["asset", "place"], "left_anti").isEmpty():
            return known
        known = closer


def _chained_ticks(chained: DataFrame, base_ticks: DataFrame, slices: Slices | str | None) -> DataFrame:
    """Ticks made by trades (base, quote, place, own price) whose quote prices depend on each other.

    Each trade points at the tick that set its quote price.  Pointers are doubled: a trade multiplies in
    what its target has gathered and takes over the target's pointer, so a chain of n ticks ends after
    log2(n) rounds, each one a join on the unique trade id.  Every round is checkpointed.
    """
    base_ticks = cut_lineage(base_ticks.select(*TICK))
    chained = cut_lineage(chained)
    known = _known_from(chained, base_ticks)
    start = known.select(F.col("asset").alias("quote_asset_id"), F.col("place").alias("_from"))
    # Trades after their quote asset became known; all of them make a tick.
    reached = chained.join(start, "quote_asset_id").filter(_place() > F.col("_from")).drop("_from")

    # A tick is either a known price or (no price yet) a reference to the trade that makes it.
    unpriced = reached.select(F.col("base_asset_id").alias("asset"), *ORDER, F.lit(None).cast("double").alias("usd_price"))
    ticks = base_ticks.unionByName(unpriced).withColumn("target", F.struct("trade_id", "usd_price"))
    linked = _as_of_quote(reached, ticks.drop("usd_price"), "target", "_at", slices)
    # The quote price is gathered * (price made by trade `via`), or just gathered once `via` is null.
    nodes = cut_lineage(
        linked.select(
            F.col("base_asset_id").alias("asset"),
            *ORDER,
            "own",
            F.coalesce("_at.usd_price", F.lit(1.0)).alias("gathered"),
            F.when(F.col("_at.usd_price").isNull(), F.col("_at.trade_id")).alias("via"),
        )
    )
    done = [nodes.filter(F.col("via").isNull())]
    pending = nodes.filter(F.col("via").isNotNull())
    while not pending.isEmpty():
        targets = nodes.select(
            F.col("trade_id").alias("via"), (F.col("own") * F.col("gathered")).alias("_made"), F.col("via").alias("_next")
        )
        stepped = cut_lineage(
            pending.join(targets, "via").select(
                "asset", *ORDER, "own", (F.col("gathered") * F.col("_made")).alias("gathered"), F.col("_next").alias("via")
            )
        )
        done.append(stepped.filter(F.col("via").isNull()))
        pending = stepped.filter(F.col("via").isNotNull())
        nodes = _union(done).unionByName(pending)
    return _union(done).select("asset", *ORDER, (F.col("own") * F.col("gathered")).alias("usd_price"))


# --- late trades ----------------------------------------------------------------------------------


def quote_markets(pairs: DataFrame, stable: tuple[str, ...]) -> tuple[set[str], list[tuple[str, str]]]:
    """Assets used as quotes (stable ones not), and the markets between two of them, of distinct pairs."""
    quotes = {r[0] for r in pairs.filter(~F.col("quote_asset_id").isin(*stable)).select("quote_asset_id").distinct().collect()}
    inner = pairs.filter(F.col("base_asset_id").isin(*quotes) & F.col("quote_asset_id").isin(*quotes))
    return quotes, [(r.base_asset_id, r.quote_asset_id) for r in inner.select("base_asset_id", "quote_asset_id").collect()]


def dependents(assets: set[str], inner: list[tuple[str, str]]) -> set[str]:
    """The assets, and all whose prices follow from theirs over markets between quote assets."""
    found, todo = set(assets), list(assets)
    while todo:
        quote = todo.pop()
        reached = {base for base, q in inner if q == quote} - found
        found |= reached
        todo.extend(reached)
    return found


def late_trades(priced: DataFrame, newest: DataFrame) -> DataFrame:
    """Trades before the newest price (asset_id, usd_price, timestamp, trade_id) of one of their assets."""
    pair = ["base_asset_id", "quote_asset_id"]
    made = newest.filter(F.col("timestamp").isNotNull()).select("asset_id", _place().alias("_newest"))
    legs = priced.select("trade_id", *pair, "timestamp", F.explode(F.array(*pair)).alias("asset_id"))
    behind = legs.join(made, "asset_id").filter(_place() < F.col("_newest"))
    return behind.select("trade_id", *pair, "timestamp").distinct()


def reprice_day(
    stored: DataFrame, late: DataFrame, changed: set[str], quotes: set[str], config: ExchangeConfig, seeds: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Price again what changes on one day, given its stored trades, which of them came late (by id), the quote assets
    whose prices may change and the prices before the day.

    Returns the trades priced again, and the last tick of each changed asset that day as (asset, old, new) structs
    of place and price; the old one as if no trade had come late.
    """
    follows = F.col("quote_asset_id").isin(*changed)
    behind = late.select("trade_id", F.lit(True).alias("_late"))
    # Only trades that take part: quoted in a changed asset, or late; of the others the ticks of quote assets.
    near = stored.filter(follows | F.col("base_asset_id").isin(*quotes))
    rest = stored.filter(~(follows | F.col("base_asset_id").isin(*quotes))).join(behind, "trade_id")
    rows = cut_lineage(near.join(behind, "trade_id", "left").unionByName(rest))
    taken = follows | F.col("_late").isNotNull()
    is_tick = F.col("usd_price").isNotNull() & F.col("base_asset_id").isin(*quotes)
    base = F.col("base_asset_id").alias("asset")
    ticks = rows.filter(~taken & is_tick).select(base, *ORDER, "usd_price")
    priced = cut_lineage(price_trades(rows.filter(taken).drop("_late"), config, seeds=seeds, ticks=ticks))
    tick = F.struct(*ORDER, "usd_price")
    old = rows.filter(is_tick & F.col("_late").isNull()).select(base, tick.alias("old"), F.lit(None).cast(
        "struct<timestamp:timestamp,trade_id:bigint,usd_price:double>").alias("new"))
    new = ticks.unionByName(priced.filter(is_tick).select(base, *ORDER, "usd_price"))
    both = old.unionByName(new.select("asset", tick.alias("new")), allowMissingColumns=True)
    last = both.filter(F.col("asset").isin(*changed)).groupBy("asset").agg(F.max("old").alias("old"), F.max("new").alias("new"))
    return priced, last


# --- what prices tell -----------------------------------------------------------------------------


def market_last_price(trades: DataFrame) -> DataFrame:
    """Last trade price of each market, as traded."""
    return trades.groupBy("base_asset_id", "quote_asset_id").agg(
        F.max_by("price", F.struct(*ORDER)).cast(PRICE).alias("price")
    )


def asset_last_price(priced: DataFrame, seeds: DataFrame | None = None) -> DataFrame:
    """Last USD price of each asset, unrounded, with the trade that set it.

    ``seeds`` (asset_id, usd_price, timestamp, trade_id) fills in for assets without a new price.
    """
    at = F.max(F.struct(*ORDER, "usd_price")).alias("d")
    new = (
        priced.filter(F.col("usd_price").isNotNull())
        .groupBy(F.col("base_asset_id").alias("asset_id"))
        .agg(at)
        .select("asset_id", "d.usd_price", "d.timestamp", "d.trade_id")
    )
    if seeds is None:
        return new
    kept = seeds.join(new, "asset_id", "left_anti").select(*new.columns)
    return new.unionByName(kept)


def price_changes(trades: DataFrame, config: ExchangeConfig, *, slices: Slices | str | None = "auto") -> DataFrame:
    """Trades that changed the price of their market (the first one included)."""
    keys = ["base_asset_id", "quote_asset_id"]
    rows = trades.select("trade_id", *keys, "timestamp", "price")
    if slices == "auto":
        slices = choose_slices(rows, keys, *ORDER, config.rows_per_slice)
    seen = last_known(rows, keys, ORDER, "price", "previous_price", slices=slices, inclusive=False)
    return seen.filter(~F.col("price").eqNullSafe(F.col("previous_price")))


def price_carry_forward(
    refreshes: DataFrame, config: ExchangeConfig, *, slices: Slices | str | None = "auto"
) -> DataFrame:
    """Price in force at each refresh (asset_id, timestamp, trade_id, price): a refresh without a price
    keeps the last one."""
    if slices == "auto":
        slices = choose_slices(refreshes, ["asset_id"], *ORDER, config.rows_per_slice)
    return last_known(refreshes, ["asset_id"], ORDER, "price", "carried_price", slices=slices)


def keep_prices(listed: DataFrame, previous: DataFrame) -> DataFrame:
    """Listed assets with the price in force; the pinned one only where none is known yet."""
    old = previous.select("asset_id", F.col("price").alias("_old"))
    return listed.join(old, "asset_id", "left").withColumn("price", F.coalesce("_old", "price")).drop("_old")
