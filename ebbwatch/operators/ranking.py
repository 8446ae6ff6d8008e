"""Ranks of scores over all rows, ties included, and the curves that come from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbwatch.functions.running import running_totals


def score_counts(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """(score, n, n_pos, n_neg) for each distinct score; a hot score is one row. Rows without score or label are left out."""
    rows = scored.select(F.col(score).cast("double").alias("score"), (F.col(label) == 1).alias("positive")).dropna()
    # 0.0 and -0.0 are one score.
    rows = rows.withColumn("score", F.col("score") + F.lit(0.0))
    return rows.groupBy("score").agg(
        F.count("*").alias("n"), F.count_if("positive").alias("n_pos"), F.count_if(~F.col("positive")).alias("n_neg")
    )


def score_ranks(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """(score, n, n_pos, n_neg, below, pos_below, neg_below, mid_rank): distinct scores with what lies below them.

    ``mid_rank`` is the rank, from 1, that rows of this score share.
    """
    counts = score_counts(scored, score, label)
    ranked = running_totals(counts, [F.col("score")], {"pos_below": F.col("n_pos"), "neg_below": F.col("n_neg")})
    below = F.col("pos_below") + F.col("neg_below")
    return ranked.select(
        "score", "n", "n_pos", "n_neg", below.alias("below"), "pos_below", "neg_below", (below + (F.col("n") + 1) / 2).alias("mid_rank")
    )


def auc_ranked(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """(auc, n_pos, n_neg): the share of pairs of a positive and a negative row that the score orders rightly, ties half.

    That is the area under the ROC curve. Null if one of the classes has no rows.
    """
    ranks = score_ranks(scored, score, label)
    # Twice the number of well-ordered pairs, exactly.
    whole = lambda c: F.col(c).cast("decimal(19,0)")
    ordered = F.sum(whole("n_pos") * (2 * whole("neg_below") + whole("n_neg"))).cast("double")
    sums = ranks.agg(ordered.alias("ordered"), F.coalesce(F.sum("n_pos"), F.lit(0)).alias("n_pos"), F.coalesce(F.sum("n_neg"), F.lit(0)).alias("n_neg"))
    pairs = F.col("n_pos").cast("double") * F.col("n_neg") * 2
    return sums.select(F.when(pairs > 0, F.col("ordered") / pairs).alias("auc"), "n_pos", "n_neg")


def roc_curve(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """(score, tpr, fpr, precision): one point per distinct score, if that score and those above it are called positive."""
    ranks = score_ranks(scored, score, label)
    totals = ranks.agg(F.sum("n_pos").alias("all_pos"), F.sum("n_neg").alias("all_neg"))
    caught, alarms = F.col("all_pos") - F.col("pos_below"), F.col("all_neg") - F.col("neg_below")
    ratio = lambda part, whole: F.when(whole > 0, part / whole)
    return ranks.crossJoin(F.broadcast(totals)).select(  # one row
        "score", ratio(caught, F.col("all_pos")).alias("tpr"), ratio(alarms, F.col("all_neg")).alias("fpr"), (caught / (caught + alarms)).alias("precision")
    )
