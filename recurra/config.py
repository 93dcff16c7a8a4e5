"""Run parameters for the recurring-revenue pipeline.

Everything the source SQL hard-codes (exchange rates, grace period, price-rise
rules, the label written into the rollforward, "today") is a field here so a
run is reproducible and testable.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values. These must equal the source system's values for identical
# results; they are stated here plainly and in their original order.
# ---------------------------------------------------------------------------

# Currency code (upper-cased, trimmed) -> USD rate. Any other code, or a
# missing code, converts at 1.
FX_TO_USD: dict[str, float] = {
    "USD": 1.0,
    "AUD": 0.68095,
    "NZD": 0.63136,
    "CAD": 0.7549,
    "GBP": 1.2727,
    "EUR": 1.10363,
    "DKK": 0.14801,
    "SGD": 0.75388,
    "FJD": 0.45310,
    "UAH": 0.02604,
    "AED": 0.27220,
    "SAR": 0.26120,
    "ZAR": 0.05455,
    "AOA": 0.00120,
    "MXN": 0.05893,
    "TRY": 0.03370,
    "MYR": 0.21751,
    "HRK": 0.14650,
}

# Term bucket by whole-day span of the billing period (inclusive bounds).
TERM_MONTHLY_MAX_DAYS = 31  # 0..31 -> "Monthly"
TERM_YEARLY_MAX_DAYS = 370  # 32..370 -> "Yearly", above -> "Three Year"

# Batch generation: term length -> months added to the order date.
BATCH_TERM_MONTHS: dict[str, int] = {"YEARLY": 12, "MONTHLY": 1, "THREE YEAR": 36}

# Price-rise ladder: override company stage factors of the stage-3 price,
# fixed training prices, and the tolerance added to the paid amount.
OVERRIDE_STAGE1_FACTOR = 0.45
OVERRIDE_STAGE2_FACTOR = 0.70
TRAINING_MULTI_USER_PRICE = 149
TRAINING_MULTI_USER_CURRENCIES = ("AUD", "USD")
TRAINING_SINGLE_USER_PRICE = 99
TRAINING_SINGLE_USER_CURRENCIES = ("USD",)
RENEWAL_TOLERANCE = 5

# Product for orders whose type id has no product mapping.
UNMAPPED_PRODUCT = "Addon"
# Slice tag of the whole-business run.
ALL_SLICE = "All"


@dataclass(frozen=True)
class PriceRules:
    """Legacy-licence price-rise parameters (company- and product-specific)."""

    override_company_ids: tuple[str, ...] = ()
    stage1_factor: float = OVERRIDE_STAGE1_FACTOR
    stage2_factor: float = OVERRIDE_STAGE2_FACTOR
    training_product: str | None = None  # compared case-insensitively
    training_multi_price: float = TRAINING_MULTI_USER_PRICE
    training_multi_currencies: tuple[str, ...] = TRAINING_MULTI_USER_CURRENCIES
    training_single_price: float = TRAINING_SINGLE_USER_PRICE
    training_single_currencies: tuple[str, ...] = TRAINING_SINGLE_USER_CURRENCIES
    tolerance: int = RENEWAL_TOLERANCE
    legacy_products: tuple[str, ...] = ()


@dataclass(frozen=True)
class Config:
    fx: dict[str, float] = field(default_factory=lambda: dict(FX_TO_USD))
    # Days an order's end may be stretched towards the customer's next start.
    grace_days: int = 0
    # Stands in for current_date() so a run is reproducible.
    as_of: dt.date = field(default_factory=dt.date.today)
    # Time zone the batch generation's event times are recorded in.
    source_tz: str = "UTC"
    # Value of the rollforward's `source` column.
    source_label: str = "Adjusted"
    price_rules: PriceRules = field(default_factory=PriceRules)
    # Batch generation: product type id -> product name (others -> Addon).
    batch_product_map: dict[str, str] = field(default_factory=dict)
    # Batch generation: also drop charges linked to a refund. The source's
    # filter is a no-op (its subquery tests the outer row), so this is off.
    strict: bool = False
    # Cut lineage at the stage boundaries (staged transactions, sliced
    # orders, rollforward) with reliable checkpoints in the shared
    # `spark.checkpoint.dir`; each is read by several later stages.
    materialize: bool = True
    # A customer with more orders than this in a slice has them dealt to
    # several tasks of the join with its facts.
    hot_orders: int = 500_000
