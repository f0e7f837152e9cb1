"""How good a score is: threshold sweep, area under the curve, calibration, latency, verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Scores from 0 to 1 fall into so many bins; running sums are within a bin, and over the bins.
BINS = 1 << 16


def auc(df: DataFrame, score: str, positive: str) -> DataFrame:
    """(n_pos, n_neg, auc): the share of pairs in order, half of the ties; null if a class is empty.

    Scores are counted first. The negatives below a score are those of lower bins (a sum over BINS rows) and those
    below it in its bin (a sum within the bin), so no task sees all scores."""
    g = df.groupBy(score).agg(F.count_if(F.col(positive)).alias("pos"), F.count_if(~F.col(positive)).alias("neg"))
    g = g.withColumn("bin", F.least(F.floor(F.greatest(F.col(score), F.lit(0.0)) * BINS), F.lit(BINS - 1)))
    inside = F.sum("neg").over(Window.partitionBy("bin").orderBy(score).rowsBetween(Window.unboundedPreceding, -1))
    bins = g.groupBy("bin").agg(F.sum("neg").alias("bin_neg"))
    lower = F.sum("bin_neg").over(Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1))
    both = g.withColumn("inside", F.coalesce(inside, F.lit(0))).join(F.broadcast(bins.select("bin", F.coalesce(lower, F.lit(0)).alias("lower"))), "bin")
    sums = both.agg(F.coalesce(F.sum("pos"), F.lit(0)).alias("n_pos"), F.coalesce(F.sum("neg"), F.lit(0)).alias("n_neg"), F.sum(F.col("pos") * (F.col("lower") + F.col("inside") + F.col("neg") * 0.5)).alias("wins"))
    return sums.select("n_pos", "n_neg", F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0), F.col("wins") / (F.col("n_pos") * F.col("n_neg"))).alias("auc"))


def sweep(df: DataFrame, score: str, positive: str, steps: int = 20) -> DataFrame:
    """(cut, tp, fp, fn, tn, accuracy) for cuts at 1 / steps to 1 - 1 / steps. Scores are first counted by the number
    of cuts they reach, so rows are never multiplied by cuts."""
    reach = F.least(F.floor(F.col(score) * steps), F.lit(steps - 1))
    g = df.groupBy(reach.alias("r")).agg(F.count_if(F.col(positive)).alias("pos"), F.count_if(~F.col(positive)).alias("neg"))
    cuts = df.sparkSession.range(1, steps).select((F.col("id")).alias("step"))
    x = cuts.join(F.broadcast(g)).groupBy("step").agg(
        F.sum(F.when(F.col("r") >= F.col("step"), F.col("pos")).otherwise(0)).alias("tp"), F.sum(F.when(F.col("r") >= F.col("step"), F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(F.col("r") < F.col("step"), F.col("pos")).otherwise(0)).alias("fn"), F.sum(F.when(F.col("r") < F.col("step"), F.col("neg")).otherwise(0)).alias("tn"))
    return x.select((F.col("step") / steps).alias("cut"), "tp", "fp", "fn", "tn", ((F.col("tp") + F.col("tn")) / (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn"))).alias("accuracy"))


def calibration(df: DataFrame, score: str, positive: str, bins: int = 5) -> DataFrame:
    """(bin, n, mean_score, share, gap): the top bin is closed. The expected calibration error is sum(n * gap) / sum(n)."""
    b = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    g = df.groupBy(b.alias("bin")).agg(F.count("*").alias("n"), F.avg(score).alias("mean_score"), F.avg(F.col(positive).cast("double")).alias("share"))
    return g.withColumn("gap", F.abs(F.col("mean_score") - F.col("share")))


def latency(df: DataFrame, by: list[str], value: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count(value).alias("n"), F.expr(f"percentile({value}, 0.5)").alias("median"), F.min(value).alias("low"), F.max(value).alias("high"), F.avg(value).alias("mean"))


def picks(df: DataFrame, truth: str, found: str) -> DataFrame:
    """(right, wrong, missed, precision, recall) of values found against the true ones."""
    right = F.count_if(F.col(found).isNotNull() & (F.col(found) == F.col(truth)))
    wrong = F.count_if(F.col(found).isNotNull() & ~F.coalesce(F.col(found) == F.col(truth), F.lit(False)))
    missed = F.count_if(F.col(truth).isNotNull() & ~F.coalesce(F.col(found) == F.col(truth), F.lit(False)))
    g = df.agg(right.alias("right"), wrong.alias("wrong"), missed.alias("missed"))
    return g.select("*", F.try_divide(F.col("right").cast("double"), (F.col("right") + F.col("wrong")).cast("double")).alias("precision"), F.try_divide(F.col("right").cast("double"), (F.col("right") + F.col("missed")).cast("double")).alias("recall"))


def verdict(*, has_candidate: Column, portal: Column, available: Column, asked: Column, publish: Column, confident: Column, choice: Column, same: Column, confidence: Column) -> Column:
    """What is made of a value after a model was asked about it; the order of the cases is the rule."""
    unsure = confidence < 0.25
    return (
        F.when(~has_candidate, "absent").when(portal, "heuristic").when(~available, "not_validated").when(~asked | choice.isNull(), "not_validated")
        .when((publish <= 0.30) & confident, "undecided").when(choice == "none_of_these", "disputed")
        .when(same, F.when(unsure, "undecided").otherwise("verified")).otherwise(F.when(unsure, "undecided").otherwise("disputed"))
    )
