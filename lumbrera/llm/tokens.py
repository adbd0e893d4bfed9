"""Token budget: how many tokens of a public tokenizer each chunk holds, and totals by source, language, phenomenon and format.

Copies (rows equal in every column) count once. Null, empty and blank texts hold 0 tokens of budget-relevant text: null and
empty have 0 tokens, white space has the tokens of its white space. An empty table gives empty results. Columns beyond the
named ones only tell copies from other rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbrera.llm.bpe import VOCABULARY, piece_counts, split_pieces
from lumbrera.session import written


#: A piece is hot from this share of all occurrences on, so at most 1 / HOT pieces are: a bounded table to broadcast.
HOT = 1e-5


def counted_rows(rows: DataFrame, text: str, keep: list[str], path: str = VOCABULARY, out: str = "n_tokens") -> DataFrame:
    """The distinct rows of a table: keep columns and the number of tokens of `text`.

    A row is known by two hashes over all of its columns, so copies fall together without the texts being shuffled; what all
    copies of a row add up to is divided by their number. All distinct pieces go through the merge rounds; their counts come
    back to the hot pieces by a broadcast (see HOT) and to the others by a join on the piece, aggregated per row before.
    """
    names = sorted(rows.columns)
    key = F.struct(F.xxhash64(*names).alias("a"), F.xxhash64(F.lit("lumbrera"), *reversed(names)).alias("b"))
    blank = ~F.coalesce(F.col(text).rlike(r"(?U)\S"), F.lit(False))
    keyed = written(rows.select(key.alias("_fila"), F.struct(*keep, blank.alias("en_blanco")).alias("_f"), split_pieces(F.col(text)).alias("_piezas")))
    occ = keyed.select("_fila", F.explode("_piezas").alias("pieza"))
    times = written(occ.groupBy("pieza").agg(F.count("*").alias("n")))
    total = times.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    counts = written(piece_counts(times, path).join(times, "pieza"))
    hot = counts.filter(F.col("n") >= HOT * total).select("pieza", "n_tokens")
    occ = occ.join(F.broadcast(hot), "pieza", "left")
    # One row for the hot pieces of a text, one for each of its other pieces.
    occ = occ.groupBy("_fila", F.when(F.col("n_tokens").isNull(), F.col("pieza")).alias("pieza")).agg(F.count("*").alias("n"), F.sum("n_tokens").alias("t"))
    occ = written(occ)
    cold = occ.filter(F.col("pieza").isNotNull()).join(counts.filter(F.col("n") < HOT * total).select("pieza", "n_tokens"), "pieza").select("_fila", (F.col("n") * F.col("n_tokens")).alias("t"))
    total = cold.unionByName(occ.filter(F.col("pieza").isNull()).select("_fila", "t")).groupBy("_fila").agg(F.sum("t").alias("_total"))
    once = keyed.groupBy("_fila").agg(F.count("*").alias("_copias"), F.first("_f").alias("_f"))
    return once.join(total, "_fila", "left").select("_f.*", F.coalesce((F.col("_total") / F.col("_copias")).cast("int"), F.lit(0)).alias(out))


def token_budget(chunks: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """fuente, idioma, fenomeno, formato as labelled, with chunks, tokens counted, tokens declared and chunks whose declared number is doubtful."""
    by = ["fuente", "idioma", "fenomeno", "formato"]
    return counted_rows(chunks, "texto", [*by, "num_tokens"], path).groupBy(*by).agg(
        F.count("*").alias("chunks"), F.sum("n_tokens").alias("tokens"), F.sum(F.greatest("num_tokens", F.lit(0))).alias("tokens_declarados"), F.count_if(doubtful()).alias("chunks_dudosos")
    )


def doubtful() -> Column:
    """Non-blank texto whose num_tokens is null, not above 0, or more than twice or less than half of n_tokens."""
    n, told = F.col("n_tokens").cast("long"), F.col("num_tokens").cast("long")
    return ~F.col("en_blanco") & (told.isNull() | (told <= 0) | (told > 2 * n) | (2 * told < n))


def doubtful_chunks(chunks: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(chunk_id) of the chunks with a doubtful num_tokens."""
    return counted_rows(chunks, "texto", ["chunk_id", "num_tokens"], path).filter(doubtful()).select("chunk_id").distinct()
