"""Dates, shares and column lists. Everything else takes a ``Settings``."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

# The three behaviours that are counted, and the predicted categories.
KINDS = ("view", "cart", "purchase")
PUBLISHED_CATEGORIES = (
    "electronics",
    "appliances",
    "computers",
    "furniture",
    "apparel",
    "auto",
    "construction",
    "kids",
)

USER_KEY = "user_id"
CATEGORY = "category_l1"
PAIR_KEY = (USER_KEY, CATEGORY)
PRIOR = "cat_purchase_rate"
DEDUP_KEY = ("event_time", "user_id", "event_type", "product_id", "user_session")


@dataclass(frozen=True)
class Settings:
    """One prediction problem: look-back windows, label window, splits and model sizes.

    ``windows`` lists (suffix, inclusive start). The first is the whole history before the cutoff
    (start ``None``); it also names the user-level, brand and price columns. The last is the
    shortest; ratios are taken over the first and the last.
    Fixed values: the default dates, shares, ratio, folds and model sizes.
    """

    cutoff: datetime = datetime(2019, 11, 1)
    target_end: datetime = datetime(2019, 11, 6)
    windows: tuple[tuple[str, datetime | None], ...] = (
        ("30d", None),
        ("14d", datetime(2019, 10, 18)),
        ("7d", datetime(2019, 10, 25)),
    )
    categories: tuple[str, ...] = PUBLISHED_CATEGORIES
    seed: int = 42
    train_share: float = 0.8
    validation_share: float = 0.2
    calibration_share: float = 0.5
    non_purchaser_ratio: int = 3
    folds: int = 5
    search_trials: int = 20
    max_trees: int = 2000
    experiment_trees: int = 200
    bagged_trees: int = 100
    # Rounds without a better held-out loss after which boosting stops.
    patience: int = 50
    # Models fitted at the same time: each is a chain of short jobs that alone leaves a cluster
    # idle between them. Every running fit caches its rows.
    parallel_fits: int = 4
    # A user set of at most this many rows (16 MB of longs) may be broadcast.
    broadcast_rows: int = 2_000_000

    @property
    def full(self) -> str:
        return self.windows[0][0]

    @property
    def count_columns(self) -> list[str]:
        return [f"{kind}s_{suffix}" for suffix, _ in self.windows for kind in KINDS]

    @property
    def recency_columns(self) -> list[str]:
        return [f"days_since_{kind}" for kind in KINDS]

    @property
    def user_columns(self) -> list[str]:
        names = [f"total_{kind}s" for kind in KINDS]
        names += ["active_days", "category_breadth", "session_count"]
        return [f"{name}_{self.full}" for name in names]

    @property
    def ratio_columns(self) -> list[str]:
        return [f"cart_view_ratio_{suffix}" for suffix in self.ratio_windows]

    @property
    def ratio_windows(self) -> list[str]:
        return [self.windows[0][0], self.windows[-1][0]]

    @property
    def price_columns(self) -> list[str]:
        return [f"avg_price_{kind}ed_{self.full}" for kind in KINDS[:2]]

    @property
    def brand_column(self) -> str:
        return f"brand_count_{self.full}"

    @property
    def stored_features(self) -> list[str]:
        """The features kept in the matrix; the category prior is added when training."""
        return [name for name in self.numeric_features if name != PRIOR]

    @property
    def numeric_features(self) -> list[str]:
        return [
            *self.count_columns,
            *self.recency_columns,
            *self.user_columns,
            PRIOR,
            *self.ratio_columns,
            self.brand_column,
            *self.price_columns,
        ]
