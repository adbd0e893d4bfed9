"""One ranking from several scores of unlike scale: robust rank aggregation.

Within a group (corrida_id, query_id) every score gives its candidates normalised ranks r = rank / n in (0, 1], ties sharing
their mean rank, n being the candidates of the group; where a candidate lacks the score, r = 1. The m ranks of an item are sorted; the k-th smallest of m uniform
ranks is at most r with probability P(Beta(k, m - k + 1) <= r); the smallest of the m probabilities times m is the item's
significance, and the items are ordered by it.

Defined results: a null or NaN score counts as the last rank (r = 1), so an item without any score comes last. Infinite scores rank as the extremes. Copies count once; several differing rows of one candidate are merged to the best
value of each score. Equal significances (not clipped at 1) are ordered by the mean normalised rank, then by chunk_id.
"""

from __future__ import annotations

from math import comb

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumbrera.session import written

GROUP = ("corrida_id", "query_id")
#: Scores and whether more is better.
SCORES = {"coseno": True, "bm25": True, "evidencia_grafo": True, "reordenador": True, "distancia": False}
#: Groups of more candidates are ranked bin by bin, so that no task holds one of them whole.
LARGE = 100_000


def _at_most(k: int, m: int, r: Column) -> Column:
    """P(Beta(k, m - k + 1) <= r), a binomial tail."""
    terms = [F.lit(float(comb(m, j))) * F.pow(r, F.lit(j)) * F.pow(1 - r, F.lit(m - j)) for j in range(k, m + 1)]
    return sum(terms[1:], terms[0])


def significance(ranks: Column, m: int) -> Column:
    """Corrected minimum of the order-statistic probabilities of an array of m normalised ranks; not clipped at 1."""
    r = F.array_sort(ranks)
    return F.least(*[_at_most(k, m, F.get(r, F.lit(k - 1))) for k in range(1, m + 1)]) * m if m > 1 else F.get(r, F.lit(0))


def _small(rows: DataFrame, group: tuple[str, ...], scores: dict[str, bool]) -> DataFrame:
    """Normalised ranks by windows over whole groups: one exchange, a sort for each score."""
    out = rows
    for s, more in scores.items():
        key = F.desc_nulls_last(s) if more else F.asc_nulls_last(s)
        w = Window.partitionBy(*group)
        ties = F.count(s).over(w.partitionBy(*group, s))
        out = out.withColumn(f"_r_{s}", F.when(F.col(s).isNotNull(), (F.rank().over(w.orderBy(key)) + (ties - 1) / 2) / F.count("*").over(w)))
    return out


def _large(rows: DataFrame, group: tuple[str, ...], item: str, scores: dict[str, bool], per_bin: int) -> DataFrame:
    """The same ranks for groups of any size: values are counted, cut into bins at approximate quantiles, ranked within a bin and shifted by the counts of the better bins."""
    long = rows.select(*group, item, F.explode(F.array(*[F.struct(F.lit(s).alias("s"), (F.col(s) if not more else -F.col(s)).cast("double").alias("v")) for s, more in scores.items()])).alias("x")).select(*group, item, "x.s", "x.v").filter("v is not null")
    keys = (*group, "s")
    values = long.groupBy(*keys, "v").agg(F.count("*").alias("c"))
    steps = F.array(*[F.lit(k / 256) for k in range(1, 256)])
    cuts = long.groupBy(*keys).agg(F.percentile_approx("v", steps, 4096).alias("cuts"))
    binned = values.join(cuts, list(keys)).withColumn("b", F.size(F.filter("cuts", lambda c: c < F.col("v")))).drop("cuts")
    totals = binned.groupBy(*keys, "b").agg(F.sum("c").alias("n_b"))
    w = Window.partitionBy(*keys)
    totals = totals.withColumn("before", F.sum("n_b").over(w.orderBy("b")) - F.col("n_b"))
    at = binned.join(totals, [*keys, "b"]).join(rows.groupBy(*group).agg(F.count("*").alias("n")), list(group))
    inside = F.sum("c").over(Window.partitionBy(*keys, "b").orderBy("v")) - F.col("c")
    at = at.withColumn("r", (F.col("before") + inside + (F.col("c") + 1) / 2) / F.col("n")).select(*keys, "v", "r")
    wide = long.join(at, [*keys, "v"]).groupBy(*group, item).agg(*[F.max(F.when(F.col("s") == s, F.col("r"))).alias(f"_r_{s}") for s in scores])
    return rows.join(wide, [*group, item], "left")


def robust_rank(rows: DataFrame, group: tuple[str, ...] = GROUP, item: str = "chunk_id", scores: dict[str, bool] = SCORES, large: int = LARGE) -> DataFrame:
    """group, item, significancia, rango_medio. Rows of one item in a group are merged first; rows with a null group or item are kept as their own keys only if the item is not null."""
    best = [(F.max if more else F.min)(F.nanvl(F.col(s).cast("double"), F.lit(None).cast("double"))).alias(s) for s, more in scores.items()]
    rows = rows.filter(F.col(item).isNotNull()).groupBy(*[F.coalesce(F.col(g), F.lit("")).alias(g) for g in group], item).agg(*best)
    rows = written(rows)
    big = written(rows.groupBy(*group).agg(F.count("*").alias("_n")).filter(F.col("_n") > large).drop("_n"))
    if big.isEmpty():
        ranked = _small(rows, group, scores)
    else:
        ranked = _small(rows.join(big, list(group), "left_anti"), group, scores).unionByName(_large(rows.join(big, list(group), "left_semi"), group, item, scores, large))
    ranks = F.array(*[F.coalesce(f"_r_{s}", F.lit(1.0)) for s in scores])
    mean = F.aggregate(ranks, F.lit(0.0), lambda a, x: a + x) / len(scores)
    return ranked.select(*group, item, significance(ranks, len(scores)).alias("significancia"), mean.alias("rango_medio"))


def first_of_ranking(rows: DataFrame, k: int = 10, group: tuple[str, ...] = GROUP, item: str = "chunk_id", scores: dict[str, bool] = SCORES) -> DataFrame:
    """group, item and puesto of the first k; the limit is applied before the exchange, so a hot group sends k rows a task."""
    w = Window.partitionBy(*group).orderBy(F.round("significancia", 9), F.round("rango_medio", 9), item)
    return robust_rank(rows, group, item, scores).withColumn("puesto", F.row_number().over(w)).filter(F.col("puesto") <= k)
