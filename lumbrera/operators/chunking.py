"""Chunks under a character budget, cut at sentences or rows."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbrera import plugins
from lumbrera.functions.sentences import split_sentences
from lumbrera.functions.text import CHARS_PER_TOKEN, chunk_id

#: Formats whose texts are rows, kept whole and not repeated (fixed values).
ROW_FORMATS = ("csv", "xlsx", "pbf")
MAX_TOKENS = 450


def wrapped(unit: str, limit: int) -> Iterator[str]:
    """A unit within the limit as it is; a longer one by words, and a word longer than the limit by characters.

    A word takes its length and one; a unit without a space is cut by characters.
    """
    limit = max(1, limit)
    if len(unit) <= limit:
        yield unit
        return
    start = at = 0  # the words from start to at are not yet given out
    for word in unit.split(" "):
        end = at + len(word)
        if len(word) + 1 > limit:
            if at > start:
                yield unit[start : at - 1]
            yield from (word[k : k + limit] for k in range(0, len(word), limit)) if len(word) > limit else (word,)
            start = end + 1
        elif end + 1 - start > limit and at > start:
            yield unit[start : at - 1]
            start = at
        at = end + 1
    if at > start:
        yield unit[start : at - 1]


def packed(sizes: list[int], budget: float, overlap: int) -> Iterator[tuple[int, int]]:
    """Ranges of units filled greedily up to the budget; each range begins `overlap` units before the end of the one before."""
    start = total = 0
    for k, n in enumerate(sizes):
        if k > start and total + n > budget:
            yield start, k
            start = max(k - overlap, start) if overlap else k
            total = sum(sizes[start:k])
        total += n
    if sizes:
        yield start, len(sizes)


def chunk_texts(text: str | None, language: str | None, rows: bool, max_tokens: int = MAX_TOKENS, overlap: int = 1) -> list[str]:
    units = [u.strip() for u in (text or "").split("\n\n") if u.strip()] if rows else split_sentences(text, language)
    budget = max_tokens * CHARS_PER_TOKEN
    units = [p for u in units for p in wrapped(u, int(budget * 0.5))]
    joiner = "\n\n" if rows else " "
    return [joiner.join(units[a:b]) for a, b in packed([len(u) for u in units], budget, 0 if rows else overlap)]


def chunk_corpus(corpus: DataFrame, max_tokens: int = MAX_TOKENS, overlap: int = 1, tokens: str = "default") -> DataFrame:
    """Chunks of a corpus (doc_id, fuente, formato, fenomeno, idioma, texto_completo) with position, id and number of tokens. One narrow pass."""

    # Marked as not deterministic, so that the filter that goes with the explode does not make it run twice.
    @F.pandas_udf("array<string>")
    def cut(text: pd.Series, language: pd.Series, rows: pd.Series) -> pd.Series:
        return pd.Series([chunk_texts(t, lang, bool(r), max_tokens, overlap) for t, lang, r in zip(text, language, rows, strict=True)])

    rows = F.coalesce(F.col("formato").isin(*ROW_FORMATS), F.lit(False))
    keep = ["doc_id", "fuente", "formato", "fenomeno", F.coalesce("idioma", F.lit("es")).alias("idioma")]
    out = corpus.select(*keep, F.posexplode(cut.asNondeterministic()("texto_completo", "idioma", rows)).alias("posicion", "texto"))
    return out.select("doc_id", chunk_id(F.col("doc_id"), F.col("posicion")).alias("chunk_id"), "fuente", "formato", "fenomeno", "posicion", plugins.apply("tokens", "int", "texto", name=tokens).alias("num_tokens"), "texto", "idioma")


def token_budget_chunks(text: str | None, budget: int, overlap: int, count: Callable[[str], int]) -> list[str]:
    """Chunks of sentences (pieces after . ! or ? and white space) by a token count; what is repeated is counted again as one text."""
    units = [u for u in re.split(r"(?<=[.!?])\s+", (text or "").strip()) if u]
    out: list[str] = []
    start = total = 0
    for k, unit in enumerate(units):
        n = count(unit)
        if k > start and total + n > budget:
            out.append(" ".join(units[start:k]))
            start = max(k - overlap, start) if overlap else k
            total = count(" ".join(units[start:k])) if start < k else 0
        total += n
    return [*out, " ".join(units[start:])] if units else []


def chunk_by_tokens(docs: DataFrame, key: str = "doc_id", text: str = "text", budget: int = 40, overlap: int = 1, tokens: str = "default") -> DataFrame:
    """(key, posicion, texto): token_budget_chunks of every text with the count of a `tokens` plug-in. One narrow pass."""
    make = plugins.factory("tokens", tokens)

    @F.pandas_udf("array<string>")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        call = make()
        for s in batches:
            yield pd.Series([token_budget_chunks(t, budget, overlap, lambda x: call([x])[0]) for t in s])

    return docs.select(key, F.posexplode(cut.asNondeterministic()(text)).alias("posicion", "texto"))
