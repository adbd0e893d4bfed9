"""Most similar vectors by cosine: partitions, score-aware (anisotropic) four-bit codes, table scans and exact reranking.

Index: spherical k-means partitions and a product codebook of 16 centres for every two dimensions are fitted on a bounded
sample; every vector is encoded. Codes minimise |e|^2 + (eta - 1) (e.x)^2, e being the residual and x the unit vector: the
residual parallel to x, which shifts the scores that matter, costs eta times as much.
Cells of partitions come in where the partitions alone would grow with the data.
Search: a query adds up table entries by code for all vectors of a block. As q.x = c implies that the scanned score is at
least c - c |e_par| - sqrt(1 - c^2) |e_perp|, the vectors that can reach the wanted cosine are known without loss; they are
scored exactly. The only loss is in partitions that are not probed.

Defined results: null vectors, vectors with a null, NaN or infinite entry, of another length than most, and all-zero ones are
neither found nor neighbours. Copies count once. Vectors equal up to scale (to five decimals) are one class: the search runs
over classes, members come in by vec_id. Equal cosines are ordered by vec_id. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumbrera.session import written

#: Vectors on which the index is fitted, about: SAMPLE, or PER_CENTRE for each centre if that is more; at most twice as many.
SAMPLE, PER_CENTRE = 10_000, 50
#: Centres of the first level at most; 4096 of 64 floats are 1 MB. Where they are not enough, every partition is cut into cells
#: of about CELL vectors by a second level of centres of the residuals, which all partitions share.
PARTITIONS, CELL = 4096, 16_384
#: Cells whose table of block numbers may be broadcast.
FEW = 100_000
#: Rows of a block of vectors and of a block of queries in one task.
BLOCK = 8192
CENTRES = 16
#: Share of the score from which on errors matter most; sets the weight eta of the parallel residual.
THRESHOLD = 0.2


@dataclass
class Index:
    centres: np.ndarray  # (partitions, d)
    fine: np.ndarray  # (cells of a partition, d), of the residuals
    codebook: np.ndarray  # (d / 2, 16, 2)
    eta: float


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        a = np.argmax(x @ c.T, axis=1)
        s = np.zeros_like(c)
        np.add.at(s, a, x)
        n = np.linalg.norm(s, axis=1, keepdims=True)
        c = np.where(n > 0, s / np.maximum(n, 1e-12), c)
    return c.astype(np.float32)


def _plain_kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        a = _nearest_of(x, c)
        n = np.bincount(a, minlength=k)[:, None]
        s = np.zeros_like(c)
        np.add.at(s, a, x)
        c = np.where(n > 0, s / np.maximum(n, 1), c)
    return c.astype(np.float32)


def _nearest_of(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.argmax(x @ c.T - 0.5 * (c * c).sum(1), axis=1) if len(c) > 1 else np.zeros(len(x), np.int64)


def cells_of(x: np.ndarray, index: Index) -> np.ndarray:
    """Number of the cell of each unit vector: its partition and, within it, the nearest centre of its residual."""
    a = np.argmax(x @ index.centres.T, 1)
    return a * len(index.fine) + _nearest_of(x - index.centres[a], index.fine)


def probed_cells(q: np.ndarray, index: Index, probes: int) -> np.ndarray:
    """(queries, cells): of the nearest `probes` partitions the cells nearest to each query, half of them and four at least."""
    s = q @ index.centres.T
    m, f = min(probes, s.shape[1]), len(index.fine)
    top = np.argpartition(-s, m - 1, axis=1)[:, :m]
    if f == 1:
        return top
    # Distance of q to c + r for centre c and residual centre r, without what all cells of a query share.
    near = np.take_along_axis(s, top, 1)[:, :, None] + (q @ index.fine.T - 0.5 * (index.fine**2).sum(1))[:, None, :] - (index.centres @ index.fine.T)[top]
    near = near.reshape(len(q), m * f)
    keep = min(m * f, max(4, m * f // 2))
    best = np.argpartition(-near, keep - 1, axis=1)[:, :keep]
    return np.take_along_axis(top, best // f, 1) * f + best % f


def _assign(x: np.ndarray, codebook: np.ndarray, eta: float, rounds: int = 3) -> np.ndarray:
    """Codes by coordinate descent on the anisotropic loss; x are unit vectors."""
    n, d = x.shape
    parts = x.reshape(n, d // 2, 2)
    cost = ((parts[:, :, None, :] - codebook[None]) ** 2).sum(-1)
    par = np.einsum("nmd,nmkd->nmk", parts, parts[:, :, None, :] - codebook[None])  # share of e.x of each centre
    codes = cost.argmin(-1)
    rows = np.arange(n)
    total = np.take_along_axis(par, codes[:, :, None], 2)[:, :, 0].sum(1)
    for _ in range(rounds):
        for m in range(d // 2):
            rest = total - par[rows, m, codes[:, m]]
            best = (cost[:, m] + (eta - 1) * (rest[:, None] + par[:, m]) ** 2).argmin(1)
            total = rest + par[rows, m, best]
            codes[:, m] = best
    return codes


def fit(x: np.ndarray, partitions: int, seed: int = 5, rounds: int = 4, cells: int = 1) -> Index:
    """Index from a sample of unit vectors."""
    rng = np.random.default_rng(seed)
    d = x.shape[1]
    eta = max(1.0, (d - 1) * THRESHOLD**2 / (1 - THRESHOLD**2))
    centres = _kmeans(x, min(partitions, len(x)), rng)
    fine = _plain_kmeans(x - centres[np.argmax(x @ centres.T, 1)], min(cells, len(x)), rng) if cells > 1 else np.zeros((1, d), np.float32)
    # The product codes are of a few parameters: a part of a large sample is enough for them.
    x = x[: 2 * SAMPLE]
    parts = x.reshape(len(x), d // 2, 2)
    pick = rng.choice(len(x), CENTRES, replace=len(x) < CENTRES)
    book = parts[pick].transpose(1, 0, 2).copy()
    for step in range(rounds + 4):
        codes = _assign(x, book, eta if step >= 4 else 1.0, rounds=2 if step >= 4 else 0)
        chosen = np.stack([book[m, codes[:, m]] for m in range(d // 2)], 1)
        share = np.einsum("nmd,nmd->nm", parts, parts - chosen)
        total = share.sum(1)
        weight = eta - 1 if step >= 4 else 0.0
        for m in range(d // 2):
            p = parts[:, m]
            # Normal equations of a centre: sum (I + w p p') c = sum p + w p (p.p + the other places' share).
            rest = total - share[:, m]
            left = np.eye(2)[None] + weight * p[:, :, None] * p[:, None, :]
            right = p + weight * p * ((p * p).sum(1) + rest)[:, None]
            for k in range(CENTRES):
                own = codes[:, m] == k
                if own.any():
                    book[m, k] = np.linalg.solve(left[own].sum(0), right[own].sum(0))
    return Index(centres, fine, book.astype(np.float32), eta)


def encode(x: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cell, packed codes (two in a byte), parallel and perpendicular residual of unit vectors."""
    out = []
    for s in range(0, len(x), 4096):
        b = x[s : s + 4096]
        codes = _assign(b, index.codebook, index.eta)
        e = b - np.concatenate([index.codebook[m, codes[:, m]] for m in range(codes.shape[1])], 1)
        par = (e * b).sum(1)
        perp = np.sqrt(np.maximum((e * e).sum(1) - par * par, 0))
        out.append((cells_of(b, index), (codes[:, 0::2] << 4 | codes[:, 1::2]).astype(np.uint8), np.abs(par), perp))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def tables(q: np.ndarray, codebook: np.ndarray) -> np.ndarray:
    """(bytes, 256, queries): score of both codes in a byte for every query."""
    t = np.einsum("qmd,mkd->mkq", q.reshape(len(q), -1, 2), codebook)
    return (t[0::2, :, None, :] + t[1::2, None, :, :]).reshape(len(t) // 2, 256, len(q)).astype(np.float32)


def scan(lut: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """(vectors, queries): sums of table entries."""
    acc = lut[0].take(codes[:, 0], axis=0)
    for m in range(1, len(lut)):
        acc += lut[m].take(codes[:, m], axis=0)
    return acc


def search_block(q: np.ndarray, x: np.ndarray, codes: np.ndarray, par: np.ndarray, perp: np.ndarray, codebook: np.ndarray, k: int, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vector, cosine) of every pair that can be among a query's k best of this block and reaches `least`."""
    found = []
    step = max(1, min(256, 4_000_000 // max(1, len(x))))
    for s in range(0, len(q), step):
        qs = q[s : s + step]
        approx = scan(tables(qs, codebook), codes)
        floor = np.full(len(qs), least, np.float32)
        if k < len(x) and least < 0.5:
            top = np.argpartition(-approx, k, axis=0)[:k]
            exact = np.einsum("kqd,qd->kq", x[top], qs)
            floor = np.maximum(floor, exact.min(0) - 1e-6)
        reach = floor[None] * (1 - par[:, None]) - np.sqrt(np.maximum(1 - floor**2, 0))[None] * perp[:, None]
        xi, qi = np.nonzero(approx >= np.where(floor[None] >= 0, reach, -1e9) - 1e-5)
        cos = np.concatenate([np.einsum("nd,nd->n", x[xi[a : a + 200_000]], qs[qi[a : a + 200_000]]) for a in range(0, len(xi), 200_000)]) if len(xi) else np.zeros(0, np.float32)
        ok = cos >= floor[qi] - 1e-6
        found.append((qi[ok] + s, xi[ok], cos[ok]))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))


def unit_vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, unidad BINARY of float32, clase BINARY): usable vectors at unit length, one row a key; clase is a digest of the rounded vector."""
    rows = rows.filter(F.col(key).isNotNull() & F.col(vector).isNotNull()).groupBy(F.col(key).alias("vec_id")).agg(F.min(F.col(vector)).alias("v"))
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    length = sizes[0]["n"] if sizes else 0

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keep = [v is not None and len(v) == length and length > 0 for v in pdf.v]
            pdf = pdf[keep]
            if not len(pdf):
                continue
            x = np.stack(pdf.v.to_numpy()).astype(np.float64)
            n = np.linalg.norm(x, axis=1)
            ok = np.isfinite(n) & (n > 0)
            x = (x[ok] / n[ok, None]).astype(np.float32)
            x = np.pad(x, ((0, 0), (0, -length % 4)))
            near = np.round(x * 1e5).astype(np.int32)
            yield pd.DataFrame({"vec_id": pdf.vec_id.to_numpy()[ok], "unidad": [r.tobytes() for r in x], "clase": [blake2b(r.tobytes(), digest_size=16).digest() for r in near]})

    return rows.mapInPandas(run, "vec_id bigint, unidad binary, clase binary")


def _matrix(s: pd.Series, kind: type = np.float32) -> np.ndarray:
    return np.frombuffer(b"".join(s), kind).reshape(len(s), -1)


_SCHEMA = "q_id bigint, vec_id bigint, coseno float"


def _search(block_k: int, least: float, codebook: np.ndarray):
    def run(db: pd.DataFrame, qs: pd.DataFrame) -> pd.DataFrame:
        if not len(db) or not len(qs):
            return pd.DataFrame({"q_id": [], "vec_id": [], "coseno": []}).astype({"q_id": "int64", "vec_id": "int64", "coseno": "float32"})
        q, x = _matrix(qs.unidad), _matrix(db.unidad)
        # A query finds itself, so one more is kept.
        qi, xi, cos = search_block(q, x, _matrix(db.codigo, np.uint8), db.par.to_numpy(), db.perp.to_numpy(), codebook, block_k + 1, least)
        out = pd.DataFrame({"q_id": qs.vec_id.to_numpy()[qi], "vec_id": db.vec_id.to_numpy()[xi], "coseno": cos})
        out = out[out.q_id != out.vec_id].sort_values(["q_id", "coseno", "vec_id"], ascending=[True, False, True])
        return out[out.groupby("q_id").cumcount() < block_k]

    return run


def nearest(base: DataFrame, queries: DataFrame, k: int, probes: int | None, least: float = -1.0, seed: int = 5) -> DataFrame:
    """(q_id, vec_id, coseno): the k nearest of `base` for each of `queries`, both (vec_id, unidad), itself excepted.

    probes: partitions searched for a query; None searches all rows, in blocks. Blocks of vectors meet blocks of queries of the
    same partition; a hot partition is cut into blocks by hash, so a task holds at most BLOCK rows of either (on average).
    """
    n = base.count()
    if not n:
        return base.sparkSession.createDataFrame([], _SCHEMA)
    partitions = 1 if probes is None else max(1, min(PARTITIONS, int(n**0.5)))
    cells = 1 if probes is None or partitions < PARTITIONS else -(-n // (partitions * CELL))
    size = max(SAMPLE, PER_CENTRE * max(partitions, min(cells, PARTITIONS)))
    # Rows whose hash is 0 modulo n / size: about that many of them, so that no partition sends more than its share to the driver.
    sample = base.select("unidad").filter(F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(max(1, n // size))) == 0)
    sample = _matrix(sample.toPandas().unidad.sort_values())
    if not len(sample):
        sample = _matrix(base.select("unidad").limit(1).toPandas().unidad)
    sample = sample[np.random.default_rng(seed).permutation(len(sample))]
    index = fit(sample, partitions, seed, cells=cells)

    def encoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                p, codes, par, perp = encode(_matrix(pdf.unidad), index)
                yield pd.DataFrame({"vec_id": pdf.vec_id, "unidad": pdf.unidad, "parte": p.astype(np.int32), "codigo": [c.tobytes() for c in codes], "par": par, "perp": perp})

    def probed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                top = probed_cells(_matrix(pdf.unidad), index, probes or 1)
                yield pd.DataFrame({"vec_id": pdf.vec_id.repeat(top.shape[1]), "unidad": pdf.unidad.repeat(top.shape[1]), "parte": top.ravel().astype(np.int32)})

    db = written(base.select("vec_id", "unidad").mapInPandas(encoded, "vec_id bigint, unidad binary, parte int, codigo binary, par float, perp float"))
    qs = written(queries.select("vec_id", "unidad").mapInPandas(probed, "vec_id bigint, unidad binary, parte int"))
    # One row a cell; broadcast if they are few.
    blocks = db.groupBy("parte").agg(F.ceil(F.count("*") / BLOCK).alias("bd")).join(qs.groupBy("parte").agg(F.ceil(F.count("*") / BLOCK).alias("bq")), "parte")
    blocks = written(blocks)
    blocks = F.broadcast(blocks) if partitions * cells <= FEW else blocks
    spread = lambda own, other: (F.pmod(F.xxhash64("vec_id"), own).alias(own + "_"), F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other + "_"))
    db = db.join(blocks, "parte").select("parte", "vec_id", "unidad", "codigo", "par", "perp", *spread("bd", "bq"))
    qs = qs.join(blocks, "parte").select("parte", "vec_id", "unidad", *spread("bq", "bd"))
    keys = ["parte", "bd_", "bq_"]
    hits = db.groupBy(*keys).cogroup(qs.groupBy(*keys)).applyInPandas(_search(k, least, index.codebook), _SCHEMA)
    w = Window.partitionBy("q_id").orderBy(F.desc("coseno"), "vec_id")
    return hits.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k).drop("_r")


def top_neighbours(rows: DataFrame, k: int = 5, every: int = 100) -> DataFrame:
    """(vec_id, vecino, coseno, puesto): the k most similar rows of every row whose id is divisible by `every`, against all rows."""
    units = written(unit_vectors(rows))
    near = nearest(units, units.filter(F.col("vec_id") % every == 0), k, None)
    w = Window.partitionBy("q_id").orderBy(F.desc("coseno"), "vec_id")
    return near.select(F.col("q_id").alias("vec_id"), F.col("vec_id").alias("vecino"), F.col("coseno").cast("double").alias("coseno"), F.row_number().over(w).alias("puesto"))


def similar_pairs(rows: DataFrame, least: float = 0.9, k: int = 5, probes: int = 4) -> DataFrame:
    """(vec_a, vec_b), vec_a < vec_b: pairs of cosine `least` or more of which one is among the other's k most similar.

    Classes of equal vectors are searched by one representative. In a class each member's nearest are its first members by
    vec_id; members of a class of k or fewer also look for the rest among the members of the nearest other classes. A class
    of any size thus gives k pairs a member.
    """
    units = written(unit_vectors(rows))
    w = Window.partitionBy("clase").orderBy("vec_id")
    # The first k members of each class: the limit is applied before the exchange, so a hot class is no hot task.
    heads = written(units.select("clase", "vec_id").withColumn("n", F.row_number().over(w)).filter(F.col("n") <= k + 1))
    reps = units.join(heads.filter("n = 1").select("vec_id"), "vec_id", "left_semi")
    reps = written(reps)
    sizes = heads.groupBy("clase").agg(F.min("vec_id").alias("rep"), F.count("*").alias("m"))
    inside = units.select("clase", "vec_id").join(heads.filter(F.col("n") <= k).select("clase", F.col("vec_id").alias("otro")), "clase").filter("vec_id <> otro").select(F.col("vec_id").alias("a"), F.col("otro").alias("b"))
    # Only classes of k or fewer members look elsewhere; all of their members are heads.
    seek = sizes.filter(F.col("m") <= k)
    near = nearest(reps, reps.join(seek.select(F.col("rep").alias("vec_id")), "vec_id", "left_semi"), k, probes, least)
    members = heads.join(sizes, "clase").select("rep", "vec_id", "n", "m")
    wide = near.join(members.select(F.col("rep").alias("vec_id"), F.col("vec_id").alias("otro"), F.col("n")).filter(F.col("n") <= k), "vec_id").select(F.col("q_id").alias("rep"), "coseno", "otro")
    order = Window.partitionBy("rep").orderBy(F.desc("coseno"), "otro")
    wide = wide.withColumn("r", F.row_number().over(order)).join(seek.select("rep", "m"), "rep").filter(F.col("r") <= k + 1 - F.col("m"))
    outside = wide.join(members.select("rep", "vec_id"), "rep").select(F.col("vec_id").alias("a"), F.col("otro").alias("b"))
    pairs = inside.unionByName(outside)
    return pairs.select(F.least("a", "b").alias("vec_a"), F.greatest("a", "b").alias("vec_b")).distinct()
