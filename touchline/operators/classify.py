"""Predicates and classifiers over prepared / attributed hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import classify_referrer, referrer_class
from ..options import INTERNAL_SUFFIXES

ATTRIBUTED = "attributed"
UNATTRIBUTED = "unattributed"
NO_REVENUE = "no_revenue"
NEGATIVE = "negative"


def search_hits(prepared: DataFrame) -> DataFrame:
    """Hits whose own referrer is a search engine with a keyword."""
    return prepared.filter(F.col("touch").isNotNull())


def purchase_hits(prepared: DataFrame) -> DataFrame:
    """Hits carrying the purchase event (P5)."""
    return prepared.filter(F.col("is_purchase"))


def outcome() -> Column:
    """Purchase outcome (P7): attributed / unattributed / no_revenue / negative.

    NULL for hits that are not purchases.  A negative hit is never credited.
    """
    rev = F.col("revenue")
    return (
        F.when(~F.col("is_purchase"), F.lit(None).cast("string"))
        .when((rev > 0) & F.col("live_touch").isNotNull(), F.lit(ATTRIBUTED))
        .when(rev > 0, F.lit(UNATTRIBUTED))
        .when(rev == 0, F.lit(NO_REVENUE))
        .otherwise(F.lit(NEGATIVE))
    )


def with_outcome(attributed: DataFrame) -> DataFrame:
    return attributed.withColumn("outcome", outcome())


def attributed_purchases(attributed: DataFrame) -> DataFrame:
    """Purchases with revenue > 0 and a live touch."""
    return attributed.filter(
        F.col("is_purchase") & (F.col("revenue") > 0) & F.col("live_touch").isNotNull()
    )


def with_referrer_class(prepared: DataFrame, internal_suffixes=INTERNAL_SUFFIXES) -> DataFrame:
    """Referrer class of each hit."""
    if "ref_host" in prepared.columns:
        cls = classify_referrer("referrer", "touch", "ref_host", "ref_malformed", internal_suffixes)
    else:
        cls = referrer_class("referrer", "touch", internal_suffixes)
    return prepared.withColumn("referrer_class", cls)
