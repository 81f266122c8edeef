"""The scoring contract on an unbounded table of requests.

Each request is scored on its own, so the transformation is stateless and has no shuffle; a
response is not sorted, as an unbounded table has no last row.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from shoptrail.config import Settings
from shoptrail.operators.boosting import BoostedTrees
from shoptrail.plans.scoring import score_requests
from shoptrail.schemas import request_schema


def request_stream(spark: SparkSession, folder: str, cfg: Settings) -> DataFrame:
    """JSON request files as they land in ``folder``."""
    return spark.readStream.schema(request_schema(cfg)).json(folder)


def score_stream(model: PipelineModel | BoostedTrees, requests: DataFrame, prior: DataFrame, cfg: Settings) -> DataFrame:
    scored = score_requests(model, requests, prior, cfg)
    return scored.select("record_id", "category_l1", "propensity_score")


def write_scores(scored: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Score what has arrived so far and stop; ``checkpoint`` is a folder that executors share."""
    writer = scored.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start(path)
