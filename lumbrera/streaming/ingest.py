"""Continuous ingestion, beyond the batch pipeline: new corpus documents are cleaned, chunked and appended as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lumbrera.functions.text import clean_text
from lumbrera.operators.chunking import chunk_corpus


def corpus_stream(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def chunk_stream(stream: DataFrame, out: str, checkpoint: str, max_tokens: int = 450) -> StreamingQuery:
    """Stateless: each batch is cleaned and chunked; the Parquet sink commits a batch once, also when it is run again."""
    cleaned = stream.withColumn("texto_completo", clean_text(F.col("texto_completo")))
    return chunk_corpus(cleaned, max_tokens).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def arrivals(stream: DataFrame, time: str, late: str = "1 day", width: str = "1 hour", by: str = "fuente") -> DataFrame:
    """Documents by window of arrival and key; later than the watermark is dropped by the stream, not by the batch plans."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width), by).agg(F.count("*").alias("documentos"))
