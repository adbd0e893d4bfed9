"""Mixing sources to target shares of the total tokens by balanced sampling (cube method).

A source with own tokens t and target tokens g is used f = min(g / t, max_repeticiones) times. Every record is taken
floor(f) times; for the rest each has inclusion probability f - floor(f) and the cube method draws a sample that keeps the
source's totals of tokens and of documents: the vector of probabilities moves at random through the null space of the two
balancing constraints until at most two records of a block are fractional. Blocks of a source are sampled side by side; what
they leave fractional goes on to the next level, blocks of remainders, until one block a source is left, whose last two
records are rounded so that the token total is missed least.

Defined results: null and empty texts have 0 tokens and can be drawn. Documents without source or of a source without target
count in the total but are never drawn. A source without tokens gets nothing and cannot reach a target above 0.
"""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbrera.llm.bpe import VOCABULARY, ship_vocabulary, token_count
from lumbrera.session import written

#: Records a block; bounds what one task holds of any source.
BLOCK = 2000


def flight(pi: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Moves pi, keeping the sums of pi and of pi * size, until at most two entries are fractional."""
    p = pi.astype(float).copy()
    eps = 1e-9
    draws = iter(rng.random(len(p) + 8))
    active: list[int] = []
    for k in range(len(p)):
        if eps < p[k] < 1 - eps:
            active.append(k)
        while len(active) == 3:
            a, b, c = active
            u = (size[b] - size[c], size[c] - size[a], size[a] - size[b])
            if not any(u):
                u = (1.0, -1.0, 0.0)
            up = min((1 - p[i]) / x if x > 0 else -p[i] / x for i, x in zip(active, u, strict=True) if x)
            down = min(p[i] / x if x > 0 else (p[i] - 1) / x for i, x in zip(active, u, strict=True) if x)
            step = up if next(draws, 0.5) * (up + down) < down else -down
            for i, x in zip(active, u, strict=True):
                p[i] += step * x
                if p[i] <= eps or p[i] >= 1 - eps:
                    p[i] = round(p[i])
            active = [i for i in active if eps < p[i] < 1 - eps]
    return p


def landing(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Rounds the last fractional entries so that the token total, then the number of records, is missed least."""
    open_ = np.flatnonzero((p > 0) & (p < 1))
    best = min(itertools.product((0.0, 1.0), repeat=len(open_)), key=lambda s: (abs(np.dot(np.array(s) - p[open_], size[open_])), abs(sum(s) - p[open_].sum()), s))
    p = p.copy()
    p[open_] = best
    return p


def _block(last: bool, seed: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_id", kind="stable").reset_index(drop=True)
        rng = np.random.default_rng(zlib.crc32(f"{seed}|{pdf.source[0]}|{pdf.bloque[0]}|{pdf.nivel[0]}".encode()))
        size = pdf.tokens.to_numpy(float)
        # Large records are settled first, so that those left for the landing are small.
        order = np.lexsort((rng.random(len(pdf)), -size))
        p = np.empty(len(pdf))
        p[order] = flight(pdf.pi.to_numpy()[order], size[order], rng)
        return pdf.assign(pi=landing(p, size) if last else p)

    return run


def draw_mix(docs: DataFrame, profile: DataFrame, path: str = VOCABULARY, seed: int = 7, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(drawn, report): drawn has (doc_id, source, tokens, copias) of the records drawn; report one row per source of the profile."""
    ship_vocabulary(docs.sparkSession, path)
    sized = written(docs.select("doc_id", "source", token_count(F.col("text"), path).alias("tokens")))
    own = sized.groupBy("source").agg(F.sum("tokens").cast("long").alias("tokens_propios"), F.count("*").alias("documentos"))
    own = written(own)
    total = own.agg(F.coalesce(F.sum("tokens_propios"), F.lit(0)).alias("t")).first()["t"]
    profile = profile.groupBy("source").agg(F.max("peso_objetivo").alias("peso_objetivo"), F.max("max_repeticiones").alias("max_repeticiones"))
    plan = profile.join(own, "source", "left").withColumns({"tokens_total": F.lit(total).cast("long"), "tokens_propios": F.coalesce("tokens_propios", F.lit(0)), "documentos": F.coalesce("documentos", F.lit(0))})
    plan = plan.withColumn("tokens_objetivo", F.col("peso_objetivo") * F.col("tokens_total")).withColumn("alcanza", F.col("tokens_objetivo") <= F.col("max_repeticiones") * F.col("tokens_propios"))
    plan = plan.withColumn("veces", F.coalesce(F.least(F.try_divide("tokens_objetivo", F.nullif("tokens_propios", F.lit(0))), F.col("max_repeticiones").cast("double")), F.lit(0.0)))
    plan = written(plan)
    n_blocks = F.greatest(F.lit(1), F.ceil(F.col("documentos") / block)).cast("long")
    rows = sized.join(plan.select("source", "veces", n_blocks.alias("bloques")), "source")
    rows = written(rows.withColumn("fijo", F.floor("veces").cast("int")).withColumn("pi", F.col("veces") - F.floor("veces")).withColumn("bloque", F.pmod(F.xxhash64("doc_id"), "bloques")))
    levels, most = [], plan.agg(F.max(n_blocks)).first()[0] or 1
    left, level = rows.select("doc_id", "source", "tokens", "pi", "bloque", F.lit(0).alias("nivel")), 0
    while True:
        last = most == 1
        done = written(left.groupBy("source", "bloque").applyInPandas(_block(last, seed), left.schema))
        if last:
            levels.append(done)
            break
        levels.append(done.filter(F.col("pi").isin(0.0, 1.0)))
        # Each block leaves two records at most, so block / 2 blocks of remainders fill one block of the next level.
        left, level, most = done.filter(~F.col("pi").isin(0.0, 1.0)).withColumn("bloque", F.expr(f"bloque div {block // 2}")).withColumn("nivel", F.lit(level + 1)), level + 1, -(-most // (block // 2))
    sampled = levels[0]
    for x in levels[1:]:
        sampled = sampled.unionByName(x)
    drawn = rows.select("doc_id", "source", "tokens", "fijo").join(sampled.select("doc_id", F.col("pi").cast("int").alias("mas")), "doc_id")
    drawn = written(drawn.select("doc_id", "source", "tokens", (F.col("fijo") + F.col("mas")).alias("copias")).filter("copias > 0"))
    got = drawn.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copias")).cast("long").alias("tokens_mezcla"), F.sum("copias").cast("long").alias("registros_mezcla"), F.max("copias").alias("copias_max"))
    mixed = drawn.agg(F.coalesce(F.sum(F.col("tokens") * F.col("copias")), F.lit(0)).alias("t")).first()["t"]
    report = plan.join(got, "source", "left").fillna(0, ["tokens_mezcla", "registros_mezcla", "copias_max"]).withColumn("tokens_mezcla_total", F.lit(mixed).cast("long"))
    report = report.withColumn("cuota_real", F.coalesce(F.try_divide("tokens_mezcla", "tokens_mezcla_total"), F.lit(0.0)))
    # What the draw misses of the tokens it could reach: less than the size of a record, if the sampling keeps its totals.
    report = report.withColumn("desvio", F.col("tokens_mezcla") - F.least(F.col("tokens_objetivo"), F.col("max_repeticiones") * F.col("tokens_propios")))
    return drawn, report.withColumn("cuota_del_total", F.coalesce(F.try_divide("tokens_mezcla", "tokens_total"), F.lit(0.0)))


def unreachable(docs: DataFrame, profile: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(source) of the profile whose records, used as often as allowed, hold fewer tokens than the target."""
    return draw_mix(docs, profile, path)[1].filter(~F.col("alcanza")).select("source")
