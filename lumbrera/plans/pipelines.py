"""End-to-end plans: ingestion, chunking, graph, answering a query bank, ablation, evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbrera.functions.text import clean_text, language_vote
from lumbrera.operators import chunking, graph, ingest, metrics, search
from lumbrera.operators.extraction import extract_registry
from lumbrera.session import written
from lumbrera.sources.files import write_jsonl


def clean_all(docs: DataFrame, text: str = "texto") -> DataFrame:
    """doc_id, texto cleaned and idioma by vote, in one projection."""
    return docs.select("doc_id", clean_text(F.col(text)).alias("texto")).withColumn("idioma", language_vote(F.col("texto")))


def corpus_and_chunks(registry: DataFrame, texts: DataFrame, official: DataFrame, max_tokens: int = chunking.MAX_TOKENS) -> tuple[DataFrame, DataFrame]:
    cleaned = written(clean_all(texts))
    corpus = written(ingest.build_corpus(registry, cleaned, cleaned, official)[0])
    return corpus, chunking.chunk_corpus(corpus, max_tokens)


def index_chunks(chunks: DataFrame, encoder: str = "default") -> DataFrame:
    """chunks with vec_id in the order of their documents and places, and their vectors."""
    return search.encoded(ingest.row_numbers(chunks, ["doc_id", "posicion"], "vec_id"), "texto", "embedding", encoder)


def fused(pool: DataFrame, counts: DataFrame) -> DataFrame:
    """hits of a pool (query_id, chunk_id, score, rank): the first 30 fused with the graph's first 30 where the graph knows any chunk of the query, as they are otherwise."""
    base = pool.filter(F.col("rank") <= search.TOP_K).select("query_id", "chunk_id", "score", "rank")
    ranked_pool = counts.join(pool.select("query_id", "chunk_id", F.col("rank").alias("_pool")), ["query_id", "chunk_id"], "left")
    by_graph = search.ranked(ranked_pool, "query_id", [F.desc("conteo"), F.asc_nulls_last("_pool"), F.asc("chunk_id")], graph.TOP_CANDIDATES)
    both = search.reciprocal_rank_fusion(base, by_graph, ["query_id"], "chunk_id").select("query_id", "chunk_id", "score", "rank", F.lit("rrf").alias("score_kind"))
    known = counts.select("query_id").distinct()
    return both.join(known, "query_id", "left_semi").unionByName(base.withColumn("score_kind", F.lit("cosine")).join(known, "query_id", "left_anti"))


def answers(queries: DataFrame, pool: DataFrame, chunks: DataFrame, edges: DataFrame | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(hits, documents, passages) of all queries at once; pool (query_id, chunk_id, score, rank) is POOL_K deep. Without edges the pool's order stands."""
    pool = written(pool)
    if edges is None:
        hits = pool.filter(F.col("rank") <= search.TOP_K).select("query_id", "chunk_id", "score", "rank", F.lit("cosine").alias("score_kind"))
    else:
        hits = fused(pool, graph.evidence(graph.query_entities(queries), edges, pool))
    hits = written(hits.join(chunks.select("chunk_id", "doc_id", "texto", "idioma"), "chunk_id"))
    return hits, search.pooled_documents(hits), search.first_passages(hits)


def results(documents: DataFrame, passages: DataFrame) -> DataFrame:
    """query_id, documents, fragments: one nested row a query."""
    d = documents.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "doc_id"))).alias("documents"))
    p = passages.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "chunk_id", "doc_id", "text"))).alias("fragments"))
    p = p.select("query_id", F.transform("fragments", lambda x: F.struct(x["chunk_id"].alias("chunk_id"), x["doc_id"].alias("doc_id"), x["text"].alias("text"), x["rank"].alias("rank"))).alias("fragments"))
    return d.join(p, "query_id", "full_outer")


def run_bank(queries: DataFrame, pool: DataFrame, chunks: DataFrame, edges: DataFrame | None, path: str) -> DataFrame:
    """Answers the bank and writes one JSON line a query, by ascending query_id; returns what was written."""
    _, docs, pieces = answers(queries, pool, chunks, edges)
    rows = written(results(docs, pieces))
    write_jsonl(rows.repartitionByRange("query_id").sortWithinPartitions("query_id"), path)
    return rows


def extract_all(registry: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(texts, errors) of registry rows and file contents; the pass over the files is written once."""
    done = written(extract_registry(registry, files))
    return done.filter("error is null").select("doc_id", "path", "texto"), done.filter("error is not null").select("doc_id", "path", "error")


def ablation(queries: DataFrame, pool: DataFrame, chunks: DataFrame, edges: DataFrame) -> DataFrame:
    """query_id, con_grafo, sin_grafo, cambia: the documents of each query with and without the graph."""
    pool = written(pool)
    of = lambda e, name: answers(queries, pool, chunks, e)[1].groupBy("query_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "doc_id"))), lambda x: x["doc_id"]).alias(name))
    return of(edges, "con_grafo").join(of(None, "sin_grafo"), "query_id", "full_outer").withColumn("cambia", ~F.col("con_grafo").eqNullSafe(F.col("sin_grafo")))


def evaluation(judged: DataFrame, documents: DataFrame, relevant: DataFrame) -> DataFrame:
    """query_id, ndcg, f1."""
    return metrics.ndcg(judged).join(metrics.f1_at(documents, relevant), "query_id")
