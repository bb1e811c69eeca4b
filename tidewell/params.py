"""Operator parameters.

Fixed values that must equal the source system's for identical results are
kept together below, in their natural order, under the FIXED VALUES banner.
Everything else is a frozen dataclass passed to the operators.
"""
from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the reference behaviour; do not edit)
# ---------------------------------------------------------------------------

# Stock codes that are not products (postage, fees, adjustments, samples ...).
NON_PRODUCT_STOCK_CODES = (
    "POST", "DOT", "M", "m", "D", "S", "B", "BANK CHARGES", "ADJUST",
    "AMAZONFEE", "PADS", "CRUK", "GIFT", "TEST001", "TEST002",
)

# Cleaning rule names in their fixed application order.
CLEANING_STEPS = (
    "cancellations_c_invoices",
    "non_product_stock_code",
    "invalid_quantity_or_price",
    "missing_customer_id",
    "duplicate_line_items",
    "standardize_types",
)

# Channel table: name, base probability, log-mean and log-sigma of acquisition cost.
CHANNELS = (
    ("paid_search", 0.35, 4.74, 0.35),
    ("paid_social", 0.25, 4.43, 0.35),
    ("email", 0.25, 3.38, 0.30),
    ("display", 0.15, 4.93, 0.40),
)
HIGH_VALUE_SHIFT = {"paid_search": 0.10, "email": -0.05, "display": -0.05}
HIGH_VALUE_PERCENTILE = 75
CAMPAIGN_EXPOSURE_RATE = 0.5

# Segment name -> recommended action, and the default for any other name.
SEGMENT_ACTIONS = {
    "Champions": "VIP early access, no discount needed.",
    "Loyal Customers": "Cross-sell bundles, loyalty tier nudge.",
    "Potential Loyalists": "Second-purchase incentive within 30 days.",
    "At Risk": "Win-back email plus a moderate discount.",
    "Hibernating": "Low-cost reactivation only — cap spend per contact.",
}
DEFAULT_SEGMENT_ACTION = "Monitor and re-evaluate next cycle."

# Propensity feature columns, in model order.
FEATURE_COLUMNS = (
    "recency_days", "frequency", "monetary", "avg_order_value", "product_diversity",
    "avg_days_between_orders", "single_buyer", "spend_trend_slope", "tenure_days", "is_uk",
)

GLOBAL_SEED = 42
# ---------------------------------------------------------------------------


CLEANING_RATIONALE = {
    "cancellations_c_invoices": "Invoice numbers starting with C record cancellations, not sales.",
    "non_product_stock_code": "Postage, fees, discounts and adjustments are not product purchases.",
    "invalid_quantity_or_price": "A sale needs a positive quantity and a positive unit price.",
    "missing_customer_id": "Rows without a customer cannot enter customer-level features.",
    "duplicate_line_items": "Repeated export rows with the same line key are counted once.",
    "standardize_types": "Types conformed: id as text, UTC time, revenue derived, country trimmed.",
}

DEDUP_KEY = ("invoice", "stock_code", "invoice_date", "customer_id", "quantity", "unit_price")


def ts(s: str) -> dt.datetime:
    """Midnight (UTC wall clock) of a YYYY-MM-DD date."""
    return dt.datetime.strptime(s, "%Y-%m-%d")


@dataclass(frozen=True)
class Cutoffs:
    t_train: dt.datetime = field(default_factory=lambda: ts("2000-06-30"))
    t_test: dt.datetime = field(default_factory=lambda: ts("2000-09-30"))
    t_full: dt.datetime = field(default_factory=lambda: ts("2000-09-30"))
    window_days: int = 90

    def distinct(self) -> list[dt.datetime]:
        return sorted({self.t_train, self.t_test, self.t_full})


@dataclass(frozen=True)
class FeatureParams:
    home_country: str = "NATION_0"
    trend_months: int = 6  # months back from the as_of month; the spine has trend_months+1 points


@dataclass(frozen=True)
class AttributionParams:
    seed: int = GLOBAL_SEED
    channels: tuple = CHANNELS
    high_value_shift: tuple = tuple(HIGH_VALUE_SHIFT.items())
    high_value_percentile: float = HIGH_VALUE_PERCENTILE
    exposure_rate: float = CAMPAIGN_EXPOSURE_RATE

    def names(self) -> list[str]:
        return [c[0] for c in self.channels]

    def cumulative(self, high_value: bool) -> list[float]:
        base = [c[1] for c in self.channels]
        total = sum(base)
        probs = [b / total for b in base]
        if high_value:
            shift = dict(self.high_value_shift)
            probs = [max(p + shift.get(c[0], 0.0), 0.0) for p, c in zip(probs, self.channels)]
            total = sum(probs)
            probs = [p / total for p in probs]
        out, acc = [], 0.0
        for p in probs:
            acc += p
            out.append(acc)
        return out


@dataclass(frozen=True)
class SegmentationParams:
    k_min: int = 2
    k_max: int = 10
    chosen_k: int | None = 5
    restarts: int = 10
    seed: int = GLOBAL_SEED
    max_iter: int = 300
    tol: float = 1e-4
    recency_winsor_pct: float = 99.0
    reseed_runs: int = 20
    subsample_runs: int = 50
    subsample_frac: float = 0.8
    ari_threshold: float = 0.85


@dataclass(frozen=True)
class PropensityParams:
    seed: int = GLOBAL_SEED
    logistic_max_iter: int = 1000
    gbm_max_iter: int = 300
    gbm_learning_rate: float = 0.08
    gbm_max_depth: int = 6
    gbm_validation_fraction: float = 0.15
    gbm_patience: int = 10  # rounds without a lower held-out loss before boosting ends
    gbm_tol: float = 1e-7   # what counts as lower
    gbm_min_instances: int = 20
    calibration_folds: int = 5
    permutation_repeats: int = 15


@dataclass(frozen=True)
class MetricsParams:
    gross_margin: float = 0.55
    ltv_horizon_months: int = 12
    max_months: int = 6


@dataclass(frozen=True)
class BudgetParams:
    total_budget: float = 50000.0
    min_share: float = 0.05
    max_share: float = 0.70
    hill_shape: float = 1.3
    step: float = 100.0
    resamples: int = 200
    seed: int = GLOBAL_SEED
    curve_points: int = 60
