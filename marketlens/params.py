"""Every window, threshold and symbol an operator depends on, in one place."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class RiskParams:
    # fixed values: symbols that stand for the market and for implied volatility
    market: str = "^GSPC"
    vix: str = "^VIX"
    index_prefix: str = "^"

    # fixed values: windows, counted in rows of the ticker's own series
    window: int = 30
    lead: int = 5
    compounding: int = 5
    trading_days: int = 252

    # fixed values: implied-volatility levels
    quiet_below: float = 15.0
    stress_above: float = 25.0
    panic_at: float = 20.0

    # fixed values: Value-at-Risk
    confidence: float = 0.95
    lookback: int = 252
    draws: int = 10_000
    seed: int = 42

    # fixed values: upkeep and quality gate
    retention_days: int = 1095
    beta_limit: float = 4.0
    stale_after_hours: int = 48

    # Rolling figures divide by the full window even while it is still filling.
    # Set this to null every row that has seen fewer usable rows.
    min_periods: int | None = None

    # Present VaR as a positive loss instead of a signed return.
    loss_magnitude: bool = False

    def __post_init__(self) -> None:
        if self.window < 2 or self.lead < 1 or self.compounding < 1:
            raise ValueError("window must be at least 2 rows, lead and compounding at least 1")
        if not 0.0 < self.confidence < 1.0:
            raise ValueError("confidence must lie strictly between 0 and 1")
        if self.lookback < 1 or self.draws < 1:
            raise ValueError("lookback and draws must be positive")
