"""Feedback that sets bounds and weights: the whole precision curve, calibration, experiments with two settings."""

import dataclasses

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..config import DEFAULT
from ..functions import risk
from ..session import materialised
from . import detection

SLICES = 32   # ranges of scores that running sums are made in


def curve(analyses: DataFrame, reviews: DataFrame, slices: int = SLICES) -> DataFrame:
    """Flagged, confirmed and missed messages, precision and recall, for every score taken as the bound.

    Scores are dealt out by range; running sums are made within a range and shifted by the totals of
    the higher ranges, of which there are ``slices``.  ``reviews`` has (email_id, confirmed).
    """
    judged = analyses.select("email_id", "risk_value").join(reviews.select("email_id", "confirmed"), "email_id")
    per_score = judged.groupBy("risk_value").agg(F.count("*").alias("n"), F.count_if(F.col("confirmed")).alias("hits"))
    ranged = materialised(per_score.repartitionByRange(slices, F.col("risk_value").desc()).withColumn(
        "slice", F.spark_partition_id()), "score-ranges")
    higher = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("slice").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))
    shift = totals.select("slice", F.coalesce(F.sum("n").over(higher), F.lit(0)).alias("n0"),
                          F.coalesce(F.sum("hits").over(higher), F.lit(0)).alias("hits0"))
    all_hits = totals.agg(F.coalesce(F.sum("hits"), F.lit(0))).first()[0]
    within = Window.partitionBy("slice").orderBy(F.col("risk_value").desc()).rowsBetween(Window.unboundedPreceding, 0)
    # At most ``slices`` rows are broadcast.
    summed = ranged.join(F.broadcast(shift), "slice").select(
        F.col("risk_value").alias("bound"), (F.sum("n").over(within) + F.col("n0")).alias("flagged"),
        (F.sum("hits").over(within) + F.col("hits0")).alias("confirmed"))
    return summed.withColumns({
        "missed": F.lit(all_hits) - F.col("confirmed"), "precision": F.col("confirmed") / F.col("flagged"),
        "recall": F.when(F.lit(all_hits) > 0, F.col("confirmed") / F.lit(all_hits))})


def calibrated(analyses: DataFrame, reviews: DataFrame) -> DataFrame:
    """Analyses with ``probability``: the share of confirmed messages that a score stands for, never falling with it.

    Spark's isotonic regression pools neighbours that break the order; one row per distinct score goes in.
    """
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import IsotonicRegression
    judged = analyses.select("email_id", "risk_value").join(reviews.select("email_id", "confirmed"), "email_id")
    shares = judged.groupBy("risk_value").agg(F.avg(F.col("confirmed").cast("double")).alias("label"),
                                              F.count("*").cast("double").alias("weight"))
    of_score = VectorAssembler(inputCols=["risk_value"], outputCol="_score", handleInvalid="skip")
    model = IsotonicRegression(featuresCol="_score", weightCol="weight", predictionCol="probability").fit(of_score.transform(shares))
    return model.transform(of_score.transform(analyses)).drop("_score")


def arm_of(column="email_id", share: float = 0.5):
    """``b`` for that share of all ids, in thousandths, ``a`` for the others; the same at every run."""
    place = F.conv(F.substring(F.md5(F.col(column).cast("binary")), 1, 8), 16, 10).cast("long") % 1000
    return F.when(place < round(share * 1000), "b").otherwise("a")


def experiment(emails: DataFrame, users: DataFrame | None, weights: dict, config=DEFAULT, share=0.5) -> DataFrame:
    """One row per message with its arm; arm ``b`` is scored with other ``weights``.

    The rules run once, whatever the arm: only the fold of their hits differs.
    """
    other = dataclasses.replace(config, weights=weights)
    rows = detection.rule_columns(emails, users, config).withColumn("arm", arm_of(share=share))
    value = F.when(F.col("arm") == "b", detection.score(other)).otherwise(detection.score(config))
    return rows.withColumn("risk_value", value).select(
        "email_id", "tenant_id", "arm", "risk_value", risk.risk_level("risk_value").alias("risk_level"))


def compared(rows: DataFrame, levels=V.ALERT_LEVELS) -> DataFrame:
    """Messages, alerts and their share by arm, and ``z`` of the two-proportion test of b against a (NULL: no answer)."""
    flagged = F.col("risk_level").isin(*levels)
    count = lambda arm, hit=F.lit(True): F.count_if((F.col("arm") == arm) & hit)
    both = rows.agg(count("a").alias("n_a"), count("a", flagged).alias("hits_a"),
                    count("b").alias("n_b"), count("b", flagged).alias("hits_b"))
    share = lambda arm: F.try_divide(F.col(f"hits_{arm}"), F.col(f"n_{arm}"))
    pooled = F.try_divide(F.col("hits_a") + F.col("hits_b"), F.col("n_a") + F.col("n_b"))
    spread = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1.0), "n_a") + F.try_divide(F.lit(1.0), "n_b")))
    return both.select("*", share("a").alias("share_a"), share("b").alias("share_b")).withColumn(
        "z", F.try_divide(F.col("share_b") - F.col("share_a"), spread))
