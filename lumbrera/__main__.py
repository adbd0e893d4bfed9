"""python -m lumbrera COMMAND ...: the steps of the pipeline from files to answers, each reading and writing tables."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lumbrera.operators import chunking, graph, ingest, search
from lumbrera.plans import pipelines
from lumbrera.session import ship
from lumbrera.sources import files


def inventory(spark: SparkSession, a: argparse.Namespace) -> None:
    ingest.registry(files.inventory(spark, a.source)).write.mode("overwrite").parquet(a.out)


def extract(spark: SparkSession, a: argparse.Namespace) -> None:
    texts, errors = pipelines.extract_all(spark.read.parquet(a.registry), files.read_files(spark, a.source))
    texts.write.mode("overwrite").parquet(a.out)
    files.write_csv(errors, f"{a.out}-errors")


def clean(spark: SparkSession, a: argparse.Namespace) -> None:
    pipelines.clean_all(spark.read.parquet(a.source)).write.mode("overwrite").parquet(a.out)


def chunk(spark: SparkSession, a: argparse.Namespace) -> None:
    files.write_jsonl(chunking.chunk_corpus(files.read_jsonl(spark, a.source, files.CORPUS), a.max_tokens), a.out)


def index(spark: SparkSession, a: argparse.Namespace) -> None:
    chunks = files.read_jsonl(spark, a.source, files.CHUNK, a.limit)
    files.write_vectors(pipelines.index_chunks(chunks).select("vec_id", "chunk_id", "embedding"), a.out)


def build_graph(spark: SparkSession, a: argparse.Namespace) -> None:
    chunks = ingest.row_numbers(files.read_jsonl(spark, a.source, files.CHUNK), ["doc_id", "posicion"])
    nodes, edges = graph.build_graph(chunks, stride=a.every, cap=a.limit)
    files.write_graph(nodes, edges, a.out)
    files.write_graphml(nodes, edges, f"{a.out}/graphml")


def answer(spark: SparkSession, a: argparse.Namespace) -> None:
    chunks = files.read_jsonl(spark, a.chunks, files.CHUNK)
    bank = files.read_query_bank(spark, a.source)
    base = files.read_vectors(spark, a.index).select(F.col("chunk_id").alias("id"), F.col("embedding").alias("vector"))
    pool = search.exact_topk(search.encoded(bank, "text").select("query_id", "vector"), base, search.POOL_K).withColumnRenamed("id", "chunk_id")
    pipelines.run_bank(bank, pool, chunks, files.read_graph(spark, a.graph)[1] if a.graph else None, a.out)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lumbrera", description=__doc__)
    commands = p.add_subparsers(dest="command", required=True)
    for name, f, extra in (
        ("inventory", inventory, ()), ("extract", extract, ("registry",)), ("clean", clean, ()), ("chunk", chunk, ()), ("index", index, ()), ("graph", build_graph, ()), ("answer", answer, ("chunks", "index")),
    ):
        c = commands.add_parser(name)
        c.add_argument("source")
        c.add_argument("out")
        for x in extra:
            c.add_argument(f"--{x}", required=True)
        c.set_defaults(run=f)
        if name == "chunk":
            c.add_argument("--max-tokens", type=int, default=chunking.MAX_TOKENS)
        if name in ("index", "graph"):
            c.add_argument("--limit", type=int, default=None if name == "index" else graph.SAMPLE_CAP)
        if name == "graph":
            c.add_argument("--every", type=int, default=graph.STRIDE)
        if name == "answer":
            c.add_argument("--graph")
    return p


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"lumbrera {args.command}").getOrCreate()
    ship(spark)
    args.run(spark, args)


if __name__ == "__main__":
    main()
