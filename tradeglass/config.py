"""Settings of one exchange."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

# Listed test assets that never take part in any figure.
BLOCKED_ASSETS = ("101112", "123", "188197390862117588552302061289480388608", "456", "789")
# Fixed value: the dollar-pegged asset whose quoted trades give USD prices directly.
STABLE_ASSETS = ("3496813586714279103986568049643838918",)


@dataclass(frozen=True)
class ExchangeConfig:
    """Identifiers and limits; the asset and wallet names are specific to a deployment."""

    native_asset: str
    pool_wallet: str = "pool"
    fee_wallet: str = "fees"
    treasury_wallet: str = "treasury"
    blocked_assets: tuple[str, ...] = BLOCKED_ASSETS
    stable_assets: tuple[str, ...] = STABLE_ASSETS
    stable_price: Decimal = Decimal("1.00")
    trade_retention_days: int = 60
    hourly_retention_days: int = 7
    # Rows of a page of transfers; None takes everything that was landed.
    transfer_page_rows: int | None = None
    # Rows one window group may hold before its key is split by time.
    rows_per_slice: int = 1_000_000
