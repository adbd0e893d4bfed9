"""Exact search by inner product, rank fusion, document pooling and passages."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumbrera import plugins
from lumbrera.functions.sentences import split_sentences
from lumbrera.functions.vectors import dot
from lumbrera.operators.chunking import packed

#: Constant of reciprocal rank fusion and depths of the rankings (fixed values).
RRF_K = 60
TOP_K, POOL_K = 30, 150
TOP_DOCS, TOP_PASSAGES, PASSAGE_WORDS = 3, 10, 250
#: Queries that go along with a scan as one matrix; the size of the blocks of more of them.
QUERY_BLOCK = 2048
DECIMALS = 6


def ranked(df: DataFrame, group: str | list[str], order: list[Column], k: int, out: str = "rank") -> DataFrame:
    """The first k of each group; the limit is also applied before the exchange (WindowGroupLimit)."""
    w = Window.partitionBy(*([group] if isinstance(group, str) else group)).orderBy(*order)
    return df.withColumn(out, F.row_number().over(w)).filter(F.col(out) <= k)


def _best(part: pd.DataFrame, ids: np.ndarray, q: np.ndarray, k: int | None, decimals: int) -> pd.DataFrame:
    """Scores of rows (id, vector) against the queries; of each query those that reach its k-th best here."""
    scores = np.round(np.stack(part["vector"].to_numpy()).astype(np.float64) @ q.T, decimals)
    n = len(part)
    bi, qi = np.nonzero(scores >= (np.partition(scores, n - k, axis=0)[n - k] if k is not None and n > k else -np.inf))
    return pd.DataFrame({"query_id": ids[qi], "id": part["id"].to_numpy()[bi], "score": scores[bi, qi]})


def _block_scores(queries: DataFrame, base: DataFrame, k: int | None, decimals: int, block: int, schema: str) -> DataFrame:
    """Scores by blocks: queries are cut by hash into blocks of about `block` rows, base into larger ones, and every pair of blocks is one task."""
    sides = {}
    # Rows of base are wider spread: every query goes to all blocks of base.
    for name, df, key, size in (("q", queries, "query_id", block), ("b", base, "id", 8 * block)):
        n = max(1, -(-df.count() // size))
        sides[name] = (df.withColumn(f"_{name}", F.pmod(F.xxhash64(key), F.lit(n)).cast("int")), n)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q, b = sides["q"][0].withColumn("_b", every(sides["b"][1])), sides["b"][0].withColumn("_q", every(sides["q"][1]))

    def multiply(qs: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
        if not len(qs) or not len(part):
            return pd.DataFrame({"query_id": qs["query_id"][:0], "id": part["id"][:0], "score": np.zeros(0)})
        return _best(part, qs["query_id"].to_numpy(), np.stack(qs["vector"].to_numpy()).astype(np.float64), k, decimals)

    return q.groupBy("_q", "_b").cogroup(b.groupBy("_q", "_b")).applyInPandas(multiply, schema)


def exact_topk(queries: DataFrame, base: DataFrame, k: int, decimals: int = DECIMALS, block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, id, score, rank): the k largest inner products of every query (query_id, vector) with base (id, vector).

    Up to `block` queries are one matrix that goes along with a single scan of base, without an exchange of it; more of them meet
    base block by block, none through the driver. Every task hands on k rows a query and batch. Ties: score rounded to
    `decimals` descending, then id. Null vectors take no part.
    """
    queries = queries.filter(F.col("vector").isNotNull()).select("query_id", "vector")
    base = base.filter(F.col("vector").isNotNull()).select("id", "vector")
    key, own = queries.schema["query_id"].dataType.simpleString(), base.schema["id"].dataType.simpleString()
    schema = f"query_id {key}, id {own}, score double"
    few = queries.limit(block + 1).collect()
    if not few:
        found = base.sparkSession.createDataFrame([], schema)
    elif len(few) > block:
        found = _block_scores(queries, base, k, decimals, block, schema)
    else:
        ids = np.empty(len(few), dtype=object)
        ids[:] = [r["query_id"] for r in few]
        q = np.array([r["vector"] for r in few], np.float64)

        def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for s in range(0, len(pdf), 4096):
                    yield _best(pdf.iloc[s : s + 4096], ids, q, k, decimals)

        found = base.mapInPandas(scan, schema)
    return ranked(found, "query_id", [F.desc("score"), F.asc("id")], k)


def topk_by_expression(queries: DataFrame, base: DataFrame, k: int, decimals: int = DECIMALS) -> DataFrame:
    """The same result by built-in expressions only, for few queries: their number is checked before they are broadcast."""
    if queries.limit(QUERY_BLOCK + 1).count() > QUERY_BLOCK:
        return exact_topk(queries, base, k, decimals)
    pairs = base.filter("vector is not null").select("id", "vector").crossJoin(F.broadcast(queries.filter("vector is not null").select("query_id", F.col("vector").alias("_q"))))
    scored = pairs.select("query_id", "id", F.round(dot(F.col("_q"), F.col("vector")), decimals).alias("score"))
    return ranked(scored, "query_id", [F.desc("score"), F.asc("id")], k)


def reciprocal_rank_fusion(first: DataFrame, second: DataFrame, group: list[str], item: str, k0: int = RRF_K) -> DataFrame:
    """group, item, rank_a, rank_b, score of the items of either ranking (group, item, rank); ties by the first ranking, then item."""
    a = first.select(*group, item, F.col("rank").alias("rank_a"))
    b = second.select(*group, item, F.col("rank").alias("rank_b"))
    both = a.join(b, [*group, item], "full_outer")
    part = lambda c: F.coalesce(F.lit(1.0) / (F.lit(k0) + F.col(c)), F.lit(0.0))
    w = Window.partitionBy(*group).orderBy(F.desc("score"), F.asc_nulls_last("rank_a"), item)
    return both.withColumn("score", part("rank_a") + part("rank_b")).withColumn("rank", F.row_number().over(w))


def pooled_documents(hits: DataFrame, group: str | list[str] = "query_id", doc: str = "doc_id", top: int = TOP_DOCS, floor: float | None = None) -> DataFrame:
    """Documents by their best hit, the earlier one first among equals; floor is the value scores start from, if any."""
    keys = [group] if isinstance(group, str) else group
    best = F.max("score") if floor is None else F.greatest(F.max("score"), F.lit(floor))
    return ranked(hits.groupBy(*keys, doc).agg(best.alias("score"), F.min("rank").alias("_first")), keys, [F.desc("score"), F.asc("_first")], top).drop("_first")


def passages_of(text: str | None, language: str | None = "es", limit: int = PASSAGE_WORDS) -> list[str]:
    """A text within the limit of words untouched; a longer one packed by sentences, a sentence above the limit by words; nothing is repeated."""
    if text is None or len(text.split()) <= limit:
        return [] if text is None else [text]
    out: list[str] = []
    # Sentences above the limit stand between runs of others; neither is packed together with the other.
    for oversized, run in groupby(split_sentences(text, language), key=lambda s: len(s.split()) > limit):
        for units in ([s.split() for s in run] if oversized else [list(run)]):
            out += [" ".join(units[a:b]) for a, b in packed([len(u.split()) for u in units], limit, 0)]
    return out


def passages(text: Column, language: Column, limit: int = PASSAGE_WORDS) -> Column:
    @F.pandas_udf("array<string>")
    def cut(t: pd.Series, lang: pd.Series) -> pd.Series:
        return pd.Series([passages_of(a, b, limit) for a, b in zip(t, lang, strict=True)])

    return cut(text, language)


def first_passages(hits: DataFrame, group: str | list[str] = "query_id", top: int = TOP_PASSAGES, limit: int = PASSAGE_WORDS) -> DataFrame:
    """group, chunk_id, doc_id, text, rank of the first passages of ranked hits (texto, idioma, rank). Hits beyond `top` cannot reach the result, so they are dropped before the split; it runs on top rows a group."""
    keys = [group] if isinstance(group, str) else group
    pieces = hits.filter(F.col("rank") <= top).select(*keys, "chunk_id", "doc_id", F.col("rank").alias("_hit"), F.posexplode(passages(F.col("texto"), F.col("idioma"), limit)).alias("_n", "text"))
    return ranked(pieces, keys, [F.asc("_hit"), F.asc("_n")], top).drop("_hit", "_n")


def reranked(hits: DataFrame, queries: DataFrame, top: int, name: str = "default") -> DataFrame:
    """The first hits again, by the rerank plug-in's score of (query text, hit text)."""
    pairs = hits.join(queries.select("query_id", F.col("text").alias("_q")), "query_id")
    scored = pairs.drop("rank").withColumn("final", plugins.apply("rerank", "double", "_q", "texto", name=name)).drop("_q")
    return ranked(scored, "query_id", [F.desc("final"), F.asc("chunk_id")], top)


def encoded(df: DataFrame, text: str, out: str = "vector", name: str = "default") -> DataFrame:
    return df.withColumn(out, plugins.apply("encoder", "array<float>", text, name=name))


def similarity_matrix(rows: DataFrame, key: str, vector: str, block: int = 1000) -> DataFrame:
    """(a, b, score) of all pairs of vectors. Up to `block` vectors by expressions; more of them pair by pair of blocks, as all pairs are what is asked for."""
    if rows.limit(block + 1).count() > block:
        kind = rows.schema[key].dataType.simpleString()
        sides = [rows.filter(F.col(vector).isNotNull()).select(F.col(key).alias(k), F.col(vector).alias("vector")) for k in ("query_id", "id")]
        found = _block_scores(*sides, None, 15, block, f"query_id {kind}, id {kind}, score double")
        return found.select(F.col("query_id").alias("a"), F.col("id").alias("b"), "score")
    a = rows.filter(F.col(vector).isNotNull()).select(F.col(key).alias("a"), F.col(vector).alias("_a"))
    b = rows.filter(F.col(vector).isNotNull()).select(F.col(key).alias("b"), F.col(vector).alias("_b"))
    return a.crossJoin(F.broadcast(b)).select("a", "b", dot(F.col("_a"), F.col("_b")).alias("score"))


def projected(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, x, y): the first two principal components; signs are arbitrary."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    v = rows.filter(F.col(vector).isNotNull()).select(key, array_to_vector(F.transform(vector, lambda x: x.cast("double"))).alias("_v"))
    xy = PCA(k=2, inputCol="_v", outputCol="_p").fit(v).transform(v).withColumn("_p", vector_to_array("_p"))
    return xy.select(key, F.get("_p", F.lit(0)).alias("x"), F.get("_p", F.lit(1)).alias("y"))


def document_against_chunks(doc_scores: DataFrame, chunk_scores: DataFrame) -> DataFrame:
    """(query_id, doc_id, doc_score, best_chunk, gain): whether a document's own vector or its best chunk is nearer to a query."""
    best = chunk_scores.groupBy("query_id", "doc_id").agg(F.max("score").alias("best_chunk"))
    return doc_scores.select("query_id", "doc_id", F.col("score").alias("doc_score")).join(best, ["query_id", "doc_id"]).withColumn("gain", F.col("best_chunk") - F.col("doc_score"))


def lexical_scores(queries: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """(query_id, id, score, rank) by cosine of tf-idf weights of words; queries (query_id, text), docs (id, text).

    Only words of the queries are weighted in the join; the norms of all documents come from one aggregation. A word that stands
    in a third of the documents is a hot join key: the query side is broadcast after its size was checked, so no key is shuffled.
    """
    words = lambda c: F.filter(F.split(F.lower(c), r"(?U)[^\p{L}\p{N}]+"), lambda w: F.length(w) > 1)
    tf = docs.select("id", F.explode(words(F.col("text"))).alias("w")).groupBy("id", "w").agg(F.count("*").alias("tf"))
    n = docs.agg(F.count("*").alias("n"))
    df = tf.groupBy("w").agg(F.count("*").alias("df")).crossJoin(F.broadcast(n)).select("w", F.log(F.col("n") / F.col("df")).alias("idf"))
    weights = tf.join(df, "w").select("id", "w", (F.col("tf") * F.col("idf")).alias("x"))
    norms = weights.groupBy("id").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    q = queries.select("query_id", F.explode(words(F.col("text"))).alias("w")).groupBy("query_id", "w").agg(F.count("*").alias("tf")).join(df, "w").select("query_id", "w", (F.col("tf") * F.col("idf")).alias("y"))
    if queries.limit(10_001).count() <= 10_000:
        q = F.broadcast(q)
    qn = q.groupBy("query_id").agg(F.sqrt(F.sum(F.col("y") * F.col("y"))).alias("qnorm"))
    dots = weights.join(q, "w").groupBy("query_id", "id").agg(F.sum(F.col("x") * F.col("y")).alias("d"))
    scored = dots.join(norms, "id").join(F.broadcast(qn) if queries.limit(10_001).count() <= 10_000 else qn, "query_id")
    scored = scored.select("query_id", "id", F.round(F.coalesce(F.try_divide("d", F.col("norm") * F.col("qnorm")), F.lit(0.0)), DECIMALS).alias("score"))
    return ranked(scored, "query_id", [F.desc("score"), F.asc("id")], k)
