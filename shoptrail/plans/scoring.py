"""Scoring tables of feature rows: the request contract as a batch job."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail.config import CATEGORY, PRIOR, Settings
from shoptrail.functions.columns import cart_view_ratio
from shoptrail.operators.boosting import BoostedTrees
from shoptrail.operators.learning import attach_prior, score_rows


def accepted(requests: DataFrame, cfg: Settings) -> DataFrame:
    return requests.filter(_known(cfg))


def rejected(requests: DataFrame, cfg: Settings) -> DataFrame:
    """Requests with an unknown or missing category, with the reason."""
    reason = F.concat(F.lit("unknown category: "), F.coalesce(F.col(CATEGORY), F.lit("(none)")))
    return requests.filter(~_known(cfg)).withColumn("reason", reason)


def _known(cfg: Settings):
    return F.coalesce(F.col(CATEGORY).isin(list(cfg.categories)), F.lit(False))


def request_features(
    requests: DataFrame, prior: DataFrame, cfg: Settings, null_ratio_when_empty: bool = False
) -> DataFrame:
    """Accepted requests with defaults, prior and ratios.

    Numbers that cannot be read become null. Absent counts are 0, and a request without events
    gets the ratio 0.0; with ``null_ratio_when_empty`` the ratio of an empty window is null, as
    in the training matrix. The prior is taken with six decimals.
    """
    rows = accepted(requests, cfg)
    given = set(rows.columns)
    numeric = [c for c in cfg.stored_features if c not in cfg.ratio_columns]
    number = {c: F.col(c).try_cast("double") if c in given else F.lit(None).cast("double") for c in numeric}
    rows = rows.withColumns(number).fillna(0.0, cfg.count_columns)
    ratios = {}
    for suffix in cfg.ratio_windows:
        carts, views, buys = (F.col(f"{k}s_{suffix}") for k in ("cart", "view", "purchase"))
        ratio = cart_view_ratio(carts, views)
        ratios[f"cart_view_ratio_{suffix}"] = (
            F.when(carts + views + buys > 0, ratio) if null_ratio_when_empty else ratio
        )
    rounded = prior.withColumn(PRIOR, F.round(PRIOR, 6))
    return attach_prior(rows.withColumns(ratios), rounded)


def score_requests(
    model: PipelineModel | BoostedTrees, requests: DataFrame, prior: DataFrame, cfg: Settings, null_ratio_when_empty: bool = False
) -> DataFrame:
    """record_id, category, score with six decimals; one row per accepted request, unordered."""
    features = request_features(requests, prior, cfg, null_ratio_when_empty)
    scored = score_rows(model, features, cfg, "propensity_score")
    return scored.withColumn("propensity_score", F.round("propensity_score", 6))


def score_batch(
    model: PipelineModel | BoostedTrees, requests: DataFrame, prior: DataFrame, cfg: Settings, null_ratio_when_empty: bool = False
) -> DataFrame:
    """The response table, best score first. Equal scores keep the order of the requests, taken
    from ``request_no`` (added from the input order where absent).
    """
    if "request_no" not in requests.columns:
        requests = requests.withColumn("request_no", F.monotonically_increasing_id())
    scored = score_requests(model, requests, prior, cfg, null_ratio_when_empty)
    ordered = scored.orderBy(F.desc("propensity_score"), F.asc("request_no"))
    return ordered.select("record_id", CATEGORY, "propensity_score")
