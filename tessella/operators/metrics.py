"""Evaluation and search statistics."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ndcg(rows: DataFrame, k: int = 10) -> DataFrame:
    """(qid, ndcg) from (qid, score, relevance): linear gain, tied scores share their mean discount, groups of two at least."""
    group = Window.partitionBy("qid")
    placed = rows.withColumn("pos", F.row_number().over(group.orderBy(F.desc("score")))).withColumn("ideal_pos", F.row_number().over(group.orderBy(F.desc("relevance")))).withColumn("n", F.count(F.lit(1)).over(group))

    def discount(pos: str):
        return F.when(F.col(pos) <= k, 1 / (F.log(F.col(pos) + 1.0) / F.log(F.lit(2.0)))).otherwise(0.0)

    shared = placed.withColumn("share", F.avg(discount("pos")).over(Window.partitionBy("qid", "score")))
    sums = shared.where("n >= 2").groupBy("qid").agg(F.sum(F.col("relevance") * F.col("share")).alias("dcg"), F.sum(F.col("relevance") * discount("ideal_pos")).alias("best"))
    return sums.select("qid", F.round(F.when(F.col("best") > 0, F.col("dcg") / F.col("best")).otherwise(0.0), 6).alias("ndcg"))


def generation_stats(trials: DataFrame, population: int) -> DataFrame:
    """Per generation best, mean, worst and population deviation of score; trials without a score don't count."""
    at = F.floor(F.col("trial") / population).cast("long")
    return trials.where("score IS NOT NULL").groupBy(at.alias("generation")).agg(F.max("score").alias("best_score"), F.round(F.avg("score"), 6).alias("mean_score"), F.min("score").alias("worst_score"), F.round(F.stddev_pop("score"), 6).alias("std_score"))


def undominated(points: np.ndarray) -> np.ndarray:
    """Which of distinct points no other one dominates, more being better. In descending order of the sums a point can only be
    dominated by one before it."""
    order = np.argsort(-points.sum(axis=1), kind="stable")
    front = np.zeros((0, points.shape[1]))
    keep = np.zeros(len(points), bool)
    for k in order.tolist():
        p = points[k]
        if not ((front >= p).all(axis=1) & (front > p).any(axis=1)).any():
            front = np.vstack([front, p])
            keep[k] = True
    return keep


def pareto_front(rows: DataFrame, metrics: Sequence[str], fan: int = 8) -> DataFrame:
    """Rows no other row dominates (at least as good in all, better in one; more is better). Rows with a null metric go.

    Distinct points are reduced to the fronts of their partitions, those to the fronts of `fan` of them together, down to one: what a
    task holds is a few fronts, never all points."""
    schema = ", ".join(f"{m} double" for m in metrics)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        front = np.zeros((0, len(metrics)))
        for batch in batches:
            front = np.vstack([front, np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)])
            front = front[undominated(front)]
        yield pa.RecordBatch.from_arrays([pa.array(front[:, k]) for k in range(len(metrics))], names=list(metrics))

    points = rows.select(*[F.col(m).cast("double").alias(m) for m in metrics]).na.drop().distinct()
    left = points.mapInArrow(local, schema)
    n = points.rdd.getNumPartitions() if points.sparkSession.conf.get("spark.sql.adaptive.enabled") != "true" else int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while n > 1:
        n = -(-n // fan)
        left = left.repartition(n).mapInArrow(local, schema)
    front = left.select(*[F.col(m).alias(f"_{m}") for m in metrics])
    same = F.lit(True)
    for m in metrics:
        same = same & (F.col(m).cast("double") == F.col(f"_{m}"))
    return rows.join(front, same, "left_semi")


def best_trial(rows: DataFrame, score: str, order: str) -> DataFrame:
    """The greatest score, the first trial on ties."""
    return rows.orderBy(F.desc(score), order).limit(1)


def quantiles(rows: DataFrame, group: str, value: str, shares: Sequence[float], bins: int = 1024) -> DataFrame:
    """(group, q0, q1, ...) interpolated between ranks, as a sorted list would give them, without holding a group anywhere.

    Values are counted in equal bins of their group's range, counts say which bins hold the asked ranks, and only distinct values of
    those bins, with their counts, are ranked."""
    given = rows.select(F.col(group).alias("g"), F.col(value).cast("double").alias("v")).where("v IS NOT NULL AND NOT isnan(v)")
    span = given.groupBy("g").agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count(F.lit(1)).alias("n"))
    near = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    bin_of = F.when(F.col("high") > F.col("low"), F.least(F.lit(bins - 1), F.floor((F.col("v") - F.col("low")) / (F.col("high") - F.col("low")) * bins))).otherwise(F.lit(0)).cast("int")
    placed = given.join(span.withColumnRenamed("g", "g2"), near("g", "g2")).select("g", "v", "n", bin_of.alias("bin"))
    counted = placed.groupBy("g", "bin").agg(F.count(F.lit(1)).alias("m"), F.first("n").alias("n"))
    order = Window.partitionBy("g").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    based = counted.withColumn("base", F.coalesce(F.sum("m").over(order), F.lit(0)))
    at = lambda s: F.lit(float(s)) * (F.col("n") - 1)
    ranks = F.array(*[F.floor(at(s)).cast("long") for s in shares], *[F.ceil(at(s)).cast("long") for s in shares])
    asked = based.where(F.exists(ranks, lambda r: (r >= F.col("base")) & (r < F.col("base") + F.col("m")))).select(F.col("g").alias("g2"), F.col("bin").alias("bin2"), "base")
    values = placed.join(asked, near("g", "g2") & (F.col("bin") == F.col("bin2"))).groupBy("g", "bin", "v").agg(F.count(F.lit(1)).alias("m"), F.first("n").alias("n"), F.first("base").alias("base"))
    inside = Window.partitionBy("g", "bin").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = values.withColumn("from", F.col("base") + F.coalesce(F.sum("m").over(inside), F.lit(0)))
    holds = lambda r: (F.col("from") <= r) & (r < F.col("from") + F.col("m"))
    ends = [(F.max(F.when(holds(F.floor(at(s)).cast("long")), F.col("v"))), F.max(F.when(holds(F.ceil(at(s)).cast("long")), F.col("v")))) for s in shares]
    made = ranked.groupBy("g").agg(F.first("n").alias("n"), *[x.alias(f"{side}{k}") for k, pair in enumerate(ends) for side, x in zip(("l", "h"), pair, strict=True)])
    part = lambda s: at(s) - F.floor(at(s))
    return made.select(F.col("g").alias(group), *[(F.col(f"l{k}") + (F.col(f"h{k}") - F.col(f"l{k}")) * part(s)).alias(f"q{k}") for k, s in enumerate(shares)])


def iqr_filter(rows: DataFrame, group: str, value: str, reach: float = 1.5) -> DataFrame:
    """Rows within [q1 - reach * iqr, q3 + reach * iqr] of their group, by interpolated quartiles."""
    marks = quantiles(rows, group, value, (0.25, 0.75)).select(F.col(group).alias("_g"), F.col("q0").alias("q1"), F.col("q1").alias("q3"))
    width = F.col("q3") - F.col("q1")
    return rows.join(marks, F.col(group).eqNullSafe(F.col("_g"))).drop("_g").where((F.col(value) >= F.col("q1") - reach * width) & (F.col(value) <= F.col("q3") + reach * width))


def correlations(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, r) for all pairs, in one aggregation."""
    pairs = [(a, b) for a in columns for b in columns]
    wide = rows.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    cells = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.round(F.col(f"`{a}|{b}`"), 6).alias("r")) for a, b in pairs])
    return wide.select(F.explode(cells).alias("c")).select("c.*")


def latency(rows: DataFrame, group: str, value: str) -> DataFrame:
    """Mean and interpolated 95th percentile."""
    means = rows.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(value), 6).alias("mean_value"))
    marks = quantiles(rows, group, value, (0.95,)).select(F.col(group).alias("_g"), F.round("q0", 6).alias("p95_value"))
    return means.join(marks, F.col(group).eqNullSafe(F.col("_g")), "left").drop("_g")


def faithfulness(rows: DataFrame) -> DataFrame:
    """(qid, faithfulness) from sentence probabilities of being unsupported; a query without sentences gets 1."""
    return rows.groupBy("qid").agg(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - F.coalesce(F.avg("p_unsupported"), F.lit(0.0)))).alias("faithfulness"))


def hit_rate(hits: int, misses: int) -> float:
    """In per cent, 0 before the first question."""
    return hits / (hits + misses + 1e-9) * 100


def generation_metrics(trials: DataFrame, population: int, metrics: Sequence[str]) -> DataFrame:
    """(generation from 1, metric, mean, deviation of the population, best) of trials that have all metrics."""
    whole = trials.na.drop(subset=list(metrics)).select((F.floor(F.col("trial") / population) + 1).cast("long").alias("generation"), F.explode(F.create_map(*[x for m in metrics for x in (F.lit(m), F.col(m).cast("double"))])).alias("metric", "x"))
    return whole.groupBy("generation", "metric").agg(F.round(F.avg("x"), 6).alias("mean_value"), F.round(F.stddev_pop("x"), 6).alias("std_value"), F.max("x").alias("best_value"))


def boxes(trials: DataFrame, group: str, score: str) -> DataFrame:
    """(group, n, q1, median, q3, low, high) of scores; order them by L09."""
    ends = trials.where(F.col(score).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.min(score).alias("low"), F.max(score).alias("high"))
    marks = quantiles(trials, group, score, (0.25, 0.5, 0.75)).select(F.col(group).alias("_g"), F.round("q0", 6).alias("q1"), F.round("q1", 6).alias("median"), F.round("q2", 6).alias("q3"))
    return ends.join(marks, F.col(group).eqNullSafe(F.col("_g"))).drop("_g")


def by_median(box: DataFrame, group: str) -> DataFrame:
    """Boxes with their place by falling median; equal medians go by name. There are few groups."""
    return box.withColumn("place", F.row_number().over(Window.orderBy(F.desc("median"), group)))


def convergence(stats: DataFrame) -> DataFrame:
    """Generation statistics with the best score so far, and whether the generation raised it."""
    before = F.max("best_score").over(Window.orderBy("generation").rowsBetween(Window.unboundedPreceding, -1))
    return stats.withColumn("best_so_far", F.greatest("best_score", F.coalesce(before, F.col("best_score")))).withColumn("raised", before.isNull() | (F.col("best_score") > before))


def trial_history(trials: DataFrame, population: int, weighted: Column) -> DataFrame:
    """Trials that have all three metrics as a table of fixed-precision text, generations counted from 1."""
    text = lambda c, n: F.format_string(f"%.{n}f", c)
    whole = trials.na.drop(subset=["cr", "faith", "ar"])
    shown = [text(F.col(a), 4).alias(b) for a, b in (("cr", "CR"), ("faith", "Faith"), ("ar", "AR"))]
    return whole.select("trial", (F.floor(F.col("trial") / population) + 1).cast("long").alias("gen"), *shown, text(weighted, 4).alias("W-Score"), "bm25_k", "vec_k", "rrf_k", "rerank_k", text(F.col("threshold"), 4).alias("thresh"), F.col("final_k").alias("fk"), text(F.col("alpha"), 2).alias("alpha"), "mode", text(F.col("adaptive"), 3).alias("adapt_thresh"))


def search_report(trials: DataFrame, score: str, baseline: float) -> DataFrame:
    """One row: the number of trials, best, mean and baseline score, and the gain over the baseline in per cent."""
    made = trials.where(F.col(score).isNotNull()).agg(F.count(F.lit(1)).alias("n_trials"), F.max(score).alias("best_score"), F.round(F.avg(score), 6).alias("mean_score"))
    return made.select("*", F.lit(float(baseline)).alias("baseline_score"), F.round((F.col("best_score") / baseline - 1) * 100, 4).alias("gain_percent"))


def best_so_far(rows: DataFrame, order: str, score: str) -> DataFrame:
    """Rows with the greatest score before them, and whether theirs is strictly greater. One run has few evaluations."""
    before = F.max(score).over(Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("best_before", before).withColumn("improved", before.isNull() | (F.col(score) > before))


def label_counts(pairs: DataFrame) -> DataFrame:
    """(positives, negatives)."""
    return pairs.agg(F.count_if(F.col("label") == 1).alias("positives"), F.count_if(F.col("label") != 1).alias("negatives"))
