"""Fitted corpora over the fixture views, shared by the registered queries of
one session (fitting once per session and test-data folder)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from rostrum.operators import keywords as kw
from rostrum.operators import tfidf
from rostrum.session import ensure_checkpoint_dir, stored
from rostrum.sources import fixtures as fx
from rostrum.sources import io
from rostrum.sources.layout import spread

_MEMO: dict[tuple, object] = {}


def _memo(key: tuple, build):
    if key not in _MEMO:
        _MEMO[key] = build()
    return _MEMO[key]


def stems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stem dictionary of the fixture corpus."""
    return _memo(("stems", spark.sparkContext.applicationId, sf_dir), lambda: fx.stem_table(spark, sf_dir).persist())


def speech_model(spark: SparkSession, sf_dir: str) -> tfidf.TfidfModel:
    """Speech-level TF-IDF over the ``merged_speeches`` stand-in."""
    return _memo(
        ("speech", spark.sparkContext.applicationId, sf_dir),
        lambda: tfidf.fit(spread(fx.merged_speeches(spark, sf_dir)), stopwords=fx.FIX_STOPWORDS,
                          stems=stems(spark, sf_dir)),
    )


def search_index(spark: SparkSession, sf_dir: str) -> io.SearchIndex:
    """The speech model stored as a search index and reloaded."""

    def build():
        path = scratch(spark, "search-index")
        io.save_index(speech_model(spark, sf_dir), path)
        return io.load_index(spark, path)

    return _memo(("index", spark.sparkContext.applicationId, sf_dir), build)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def member_model(spark: SparkSession, sf_dir: str) -> tfidf.TfidfModel:
    """Member-level TF-IDF (one document per member) over the 80-member view."""
    return _memo(
        ("member", spark.sparkContext.applicationId, sf_dir),
        lambda: tfidf.fit_groups(
            spread(fx.merged_speeches(spark, sf_dir, member="source_lang")),
            stopwords=fx.FIX_STOPWORDS,
            stems=stems(spark, sf_dir),
        ),
    )


def keyword_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-10 keywords of every speech with member, party and date (D9 + E1), stored:
    trends read them several times."""

    def build():
        per_doc = kw.keywords_per_doc(speech_model(spark, sf_dir).weights, fx.FIX_BLOCKLIST)
        return stored(kw.attach_metadata(per_doc, fx.merged_speeches(spark, sf_dir)), "keyword-rows")

    return _memo(("keywords", spark.sparkContext.applicationId, sf_dir), build)
