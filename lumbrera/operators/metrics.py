"""Evaluation of rankings against graded judgements and sets of relevant documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ndcg(judged: DataFrame, k: int = 10, group: str | list[str] = "query_id") -> DataFrame:
    """(group, ndcg) of judged (group, rank from 1, rel): the ideal is the same list in descending order; 0 where it is 0."""
    keys = [group] if isinstance(group, str) else group
    w = Window.partitionBy(*keys).orderBy(F.desc("rel"), "rank")
    gain = lambda pos: F.when(F.col(pos) <= k, F.col("rel") / F.log2(F.col(pos) + 1)).otherwise(0.0)
    rows = judged.withColumn("_i", F.row_number().over(w))
    sums = rows.groupBy(*keys).agg(F.sum(gain("rank")).alias("d"), F.sum(gain("_i")).alias("i"))
    return sums.select(*keys, F.coalesce(F.try_divide("d", F.nullif("i", F.lit(0.0))), F.lit(0.0)).alias("ndcg"))


def f1_at(results: DataFrame, relevant: DataFrame, k: int = 3, group: str | list[str] = "query_id", doc: str = "doc_id") -> DataFrame:
    """(group, f1): precision over k, recall over the smaller of k and the relevant documents; groups of `relevant` only."""
    keys = [group] if isinstance(group, str) else group
    rel = relevant.select(*keys, doc).distinct()
    hits = results.filter(F.col("rank") <= k).select(*keys, doc).distinct().join(rel, [*keys, doc], "left_semi").groupBy(*keys).agg(F.count("*").alias("h"))
    sums = rel.groupBy(*keys).agg(F.count("*").alias("n")).join(hits, keys, "left")
    p, r = F.coalesce("h", F.lit(0)) / k, F.coalesce("h", F.lit(0)) / F.least(F.lit(k), F.col("n"))
    return sums.select(*keys, F.coalesce(F.try_divide(2 * p * r, F.nullif(p + r, F.lit(0.0))), F.lit(0.0)).alias("f1"))


def means(table: DataFrame, *metrics: str) -> DataFrame:
    return table.agg(*[F.avg(m).alias(m) for m in metrics])


def worst(table: DataFrame, metric: str, n: int, tie: str = "query_id") -> DataFrame:
    """A report: the n rows of the lowest metric."""
    return table.orderBy(metric, tie).limit(n)


def histogram(table: DataFrame, metric: str, low: float, high: float, bins: int = 10) -> DataFrame:
    """(bin from 1, n) of equal bins, the last closed on the right."""
    return table.filter(F.col(metric).between(low, high)).groupBy(F.least(F.width_bucket(metric, F.lit(low), F.lit(high), F.lit(bins)), F.lit(bins)).cast("int").alias("bin")).agg(F.count("*").alias("n"))
