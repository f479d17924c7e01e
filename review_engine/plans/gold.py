"""The facts behind a mart: built on demand, and only of the kinds the mart shows.

A stored gold layer is what the batch runs write (``review_engine.jobs``, ``plans/batch.py``); the
same marts read it. A mart over the tables as they are plans no measure it does not show.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from review_engine.operators import governance as g, storytelling as st
from review_engine.plans import opinion, quality


def governance(spark: SparkSession, folder: str, *kinds: str) -> DataFrame:
    """Quality facts of these kinds; of all kinds if none is named."""
    return quality.report(spark, folder, kinds or g.KINDS)


def storytelling(spark: SparkSession, folder: str, *kinds: str) -> DataFrame:
    """Opinion facts of these kinds; of all kinds if none is named."""
    return opinion.report(spark, folder, kinds or st.KINDS)
