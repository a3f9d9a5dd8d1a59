"""Column contracts, thresholds and run settings."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# --- Fixed values: column names and constants of the feature contract --------
ID_COLUMN = "externalcustomerkey"
DATE_COLUMNS = ("as_of_date", "first_order_date", "last_order_date")
LEAKAGE_COLUMNS = (
    "discount_abs_lifetime_eur",
    "discount_rate_lifetime",
    "share_of_orders_with_discount",
    "share_of_items_discounted",
    "avg_discount_per_order",
    "max_discount_single_order",
)
DROPPED_COLUMNS = ("gender", "shops_included", "registration_flag")
WINDOW_TOKENS = ("_15d", "_30d", "_3m", "_6m", "_12m")
TARGET_COLUMN = "y_discount_sensitive"
TARGET_SOURCES = ("share_of_orders_with_discount", "discount_abs_lifetime_eur")
SEGMENT_LABELS = ("full_price", "conditional", "discount_driven")
COUNTRY_COLUMN = "country"
OTHER_COUNTRY = "OTHER"
ZERO_FILLED_COLUMN = "avg_discount_per_order"
LOOKBACK_YEARS = 5
# -----------------------------------------------------------------------------

# The feature table, in output order.
FEATURE_SCHEMA = """
    externalcustomerkey bigint,
    as_of_date date,
    shops_included bigint,
    first_order_date date,
    last_order_date date,
    days_since_last_order int,
    orders_lifetime bigint,
    orders_15d bigint,
    orders_30d bigint,
    orders_3m bigint,
    orders_6m bigint,
    orders_12m bigint,
    revenue_net_lifetime_eur double,
    revenue_net_15d_eur double,
    revenue_net_30d_eur double,
    revenue_net_6m_eur double,
    revenue_net_12m_eur double,
    aov_net_lifetime_eur double,
    aov_net_12m_eur double,
    aov_net_6m_eur double,
    items_qty_lifetime bigint,
    items_qty_6m bigint,
    items_qty_12m bigint,
    avg_items_per_order_lifetime double,
    avg_items_per_order_12m double,
    avg_items_per_order_6m double,
    discount_abs_lifetime_eur double,
    discount_rate_lifetime double,
    share_of_orders_with_discount double,
    share_of_items_discounted double,
    avg_discount_per_order double,
    max_discount_single_order double,
    avg_unit_price_lifetime_eur double,
    min_unit_price_lifetime_eur double,
    max_unit_price_lifetime_eur double,
    refund_orders_lifetime bigint,
    refund_orders_12m bigint,
    refund_orders_6m bigint,
    refund_orders_3m bigint,
    refund_rate_lifetime double,
    refund_rate_12m double,
    refund_rate_6m double,
    refund_rate_3m double,
    account_age_days int,
    registration_flag smallint,
    country string,
    gender string
"""

# (column, Spark type) pairs of the feature table.
FEATURE_FIELDS = tuple(
    tuple(line.strip().rstrip(",").split(" ")) for line in FEATURE_SCHEMA.strip().splitlines()
)


@dataclass(frozen=True)
class BoostConfig:
    """Settings of the boosted-tree classifier.

    ``max_depth`` stands in for a leaf limit (a tree of depth d has at most 2**d
    leaves). There is no L1/L2 leaf penalty in MLlib. Every boosting round is a
    chain of Spark jobs, so rounds are fewer and steps longer than a
    single-machine booster would use; both are arguments.
    """

    max_iter: int = 50
    step_size: float = 0.1
    max_depth: int = 8
    min_instances_per_node: int = 50
    feature_fraction: float = 0.6
    subsampling_rate: float = 0.6
    early_stopping_rounds: int = 10
    max_bins: int = 64


@dataclass(frozen=True)
class LeafwiseConfig:
    """Settings of the leaf-wise booster; the defaults are the production ones."""

    rounds: int = 10_000
    patience: int = 300
    learning_rate: float = 0.02
    leaves: int = 256
    min_rows: int = 50
    min_hessian: float = 1e-3
    feature_fraction: float = 0.6
    row_fraction: float = 0.6
    l1: float = 0.1
    l2: float = 0.1
    max_bins: int = 256
    block: int = 10  # rounds between two stored states

    def __post_init__(self) -> None:
        whole = (self.rounds, self.patience, self.min_rows, self.block)
        shares = (self.feature_fraction, self.row_fraction, self.learning_rate)
        if min(whole) < 1 or self.leaves < 2 or not all(0 < s <= 1 for s in shares):
            raise ValueError("rounds, leaves and shares must be positive, shares at most 1")
        if min(self.l1, self.l2, self.min_hessian) < 0:
            raise ValueError("penalties must not be negative")


@dataclass(frozen=True)
class RunConfig:
    """Everything a caller can override in one run."""

    country_min_share: float = 0.01
    test_size: float = 0.2
    seed: int = 42
    t1: float = 0.2
    t2: float = 0.5
    drop_policy: str = "always"
    split_mode: str = "exact"
    boosting: BoostConfig | LeafwiseConfig = field(default_factory=BoostConfig)

    def __post_init__(self) -> None:
        if not 0 < self.country_min_share <= 1:
            raise ValueError("country_min_share must lie in (0, 1]")
        if not 0 < self.test_size < 1:
            raise ValueError("test_size must lie in (0, 1)")
        if not 0 < self.t1 < self.t2 < 1:
            raise ValueError("thresholds must increase strictly: 0 < t1 < t2 < 1")
        if self.drop_policy not in ("always", "if_constant"):
            raise ValueError(f"unknown drop_policy: {self.drop_policy}")
        if self.split_mode not in ("exact", "approx"):
            raise ValueError(f"unknown split_mode: {self.split_mode}")

    def with_changes(self, **changes) -> RunConfig:
        return replace(self, **changes)


def preset(name: str) -> RunConfig:
    """``current`` or the older ``legacy`` settings."""
    if name == "current":
        return RunConfig()
    if name == "legacy":
        return RunConfig(
            t2=0.6,
            drop_policy="if_constant",
            boosting=BoostConfig(
                max_iter=300,
                step_size=0.05,
                max_depth=6,
                min_instances_per_node=200,
                feature_fraction=0.8,
                subsampling_rate=0.8,
                early_stopping_rounds=30,
            ),
        )
    raise ValueError(f"unknown preset: {name}")
