"""All registered queries (importing the query modules registers them)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rostrum.plans import (  # noqa: F401  (importing registers the queries)
    analysis_queries,
    corpus_queries,
    model_queries,
    search_queries,
    text_queries,
)
from rostrum.plans.registry import ORACLES, QUERIES


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_queries.top_keywords_per_year(spark, sf_dir)


def queries() -> dict:
    return dict(QUERIES)


def oracles() -> dict:
    return {k: v for k, v in ORACLES.items() if k in QUERIES}
