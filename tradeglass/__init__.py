"""Exchange analytics on Spark: priced trades, rolling and daily roll-ups, order book, fees, value locked.

Every operator is a function from DataFrames (and an explicit ``as_of`` where time matters) to a
DataFrame.  Only ``plans.store`` and ``plans.jobs`` write.
"""

from tradeglass.config import ExchangeConfig

__all__ = ["ExchangeConfig"]
