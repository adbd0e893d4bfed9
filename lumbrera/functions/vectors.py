"""Column functions over ARRAY<FLOAT> vectors, computed in DOUBLE."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, p: s + p)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def unit(v: Column) -> Column:
    """v at length 1; null for an all-zero vector."""
    n = norm(v)
    return F.when(n > 0, F.transform(v, lambda x: x.cast("double") / n))


def mean_pool(rows: DataFrame, key: str, vector: str, weight: str | None = None, floor: float = 1e-9) -> DataFrame:
    """(key, vector): element-wise mean of a group's vectors, weighted, the weight sum at least `floor`."""
    w = F.col(weight) if weight else F.lit(1.0)
    long = rows.filter(F.col(vector).isNotNull()).select(key, w.cast("double").alias("_w"), F.posexplode(vector).alias("_p", "_x"))
    means = long.groupBy(key, "_p").agg((F.sum(F.col("_x").cast("double") * F.col("_w")) / F.greatest(F.sum("_w"), F.lit(floor))).alias("_m"))
    ordered = means.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_p", "_m"))).alias("_a"))
    return ordered.select(key, F.transform("_a", lambda s: s["_m"]).alias(vector))
