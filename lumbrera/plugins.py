"""Extension points for models and decoders whose libraries are not part of this engine.

Each kind has a default that needs only the standard library and numpy. A plug-in is a zero-argument factory returning a function
on lists; the factory runs once in each Python worker, when its first batch arrives, and nothing is fetched at run time.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from lumbrera.sources import decoders

Batch = Callable[[list], list]
_FACTORIES: dict[tuple[str, str], Callable[[], Batch]] = {}
KINDS = ("encoder", "entities", "tokens", "rerank", "ocr", "pdf", "osm", "tile", "language", "sentences", "token_vectors")


def register(kind: str, name: str, factory: Callable[[], Batch]) -> None:
    if kind not in KINDS:
        raise ValueError(f"unknown kind {kind}; there are {', '.join(KINDS)}")
    _FACTORIES[kind, name] = factory


def factory(kind: str, name: str = "default") -> Callable[[], Batch]:
    try:
        return _FACTORIES[kind, name]
    except KeyError:
        raise LookupError(f"no {kind} named {name} is registered") from None


def apply(kind: str, returns: str, *columns: Column | str, name: str = "default") -> Column:
    """A plug-in over one or more columns; null inputs give null without reaching it."""
    make = factory(kind, name)

    @F.pandas_udf(returns)
    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        call = make()
        for parts in batches:
            rows = list(zip(*parts, strict=True))
            full = [k for k, r in enumerate(rows) if all(x is not None for x in r)]
            got = call([rows[k] if len(parts) > 1 else rows[k][0] for k in full])
            out: list[Any] = [None] * len(rows)
            for k, v in zip(full, got, strict=True):
                out[k] = v
            yield pd.Series(out, dtype=object)

    @F.pandas_udf(returns)
    def run_one(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        call = make()
        for s in batches:
            full = [k for k, x in enumerate(s) if x is not None]
            out: list[Any] = [None] * len(s)
            for k, v in zip(full, call([s.iloc[k] for k in full]), strict=True):
                out[k] = v
            yield pd.Series(out, dtype=object)

    # Marked as not deterministic, so that a filter on the result or an explode of it does not make a model run twice.
    return (run_one if len(columns) == 1 else run).asNondeterministic()(*columns)


def attempt(kind: str, returns: str, *columns: Column | str, name: str = "default") -> Column:
    """STRUCT<value, error> of a plug-in over one or more columns: where it raises, the row gets the message and the others their values."""
    make, several = factory(kind, name), len(columns) > 1

    @F.pandas_udf(f"struct<value:{returns},error:string>")
    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        call = make()

        def one(r: Any) -> tuple[Any, str | None]:
            try:
                return call([r])[0], None
            except Exception as e:  # noqa: BLE001 - whatever a plug-in raises is the row's error
                return None, str(e) or type(e).__name__

        for parts in batches:
            rows = list(zip(*parts, strict=True))
            full = [k for k, r in enumerate(rows) if all(x is not None for x in r)]
            given = [rows[k] if several else rows[k][0] for k in full]
            try:
                got = [(v, None) for v in call(given)] if given else []
            except Exception:  # noqa: BLE001 - row by row, to find which one it is
                got = [one(r) for r in given]
            out: list[tuple[Any, str | None]] = [(None, None)] * len(rows)
            for k, v in zip(full, got, strict=True):
                out[k] = v
            yield pd.DataFrame({"value": pd.Series([v for v, _ in out], dtype=object), "error": pd.Series([e for _, e in out], dtype=object)})

    # A single column would come as a series by itself; an empty literal beside it keeps one form for both.
    return run.asNondeterministic()(*columns, *([F.lit("")] if len(columns) == 1 else ()))


_WORD = re.compile(r"[^\W_]+")
#: Dimensions of the default encoder.
DIMENSIONS = 256


@lru_cache(maxsize=100_000)
def _slot(word: str) -> tuple[int, float]:
    h = int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
    return h % DIMENSIONS, 1.0 if h >> 63 else -1.0


def _hashing_encoder() -> Batch:
    """Signed feature hashing of words at unit length; an empty text is the zero vector."""

    def encode(texts: list[str]) -> list[list[float]]:
        out = np.zeros((len(texts), DIMENSIONS), np.float32)
        for row, t in zip(out, texts, strict=True):
            for w in _WORD.findall(t.lower()):
                k, s = _slot(w)
                row[k] += s
        n = np.linalg.norm(out, axis=1, keepdims=True)
        return list(np.divide(out, n, out=out, where=n > 0))

    return encode


_SPAN = re.compile(r"[A-ZÀ-ÖØ-Þ][\w'’-]+(?: (?:(?:de|del|do|da|of|the|la|los) )?[A-ZÀ-ÖØ-Þ][\w'’-]+)*")


def _capitalised_entities() -> Batch:
    """Runs of capitalised words as MISC, all-capital ones as ORG; offsets in code points."""

    def find(texts: list[str]) -> list[list[dict]]:
        return [[{"texto": m.group(), "tipo": "ORG" if m.group().isupper() else "MISC", "start": m.start(), "end": m.end()} for m in _SPAN.finditer(t) if len(m.group()) > 1] for t in texts]

    return find


def _token_vectors() -> Batch:
    """Vector of a word in its sentence: (sentence, word) pairs to the hashed word, leaned towards the words around its first occurrence; null where it does not occur."""
    encode = _hashing_encoder()

    def vectors(pairs: list[tuple[str, str]]) -> list[Any]:
        out: list[Any] = []
        for sentence, word in pairs:
            words = _WORD.findall(sentence.lower())
            if word.lower() not in words:
                out.append(None)
                continue
            k = words.index(word.lower())
            own, near = encode([words[k], " ".join(words[max(0, k - 3) : k] + words[k + 1 : k + 4])])
            v = own + np.float32(0.5) * near
            out.append(v / max(float(np.linalg.norm(v)), 1e-12))
        return out

    return vectors


def _estimated_tokens() -> Batch:
    return lambda texts: [math.ceil(len(t) / 3.7) for t in texts]


def _overlap_rerank() -> Batch:
    """Share of the query's words that the passage holds."""

    def score(pairs: list[tuple[str, str]]) -> list[float]:
        sets = [(set(_WORD.findall(q.lower())), set(_WORD.findall(p.lower()))) for q, p in pairs]
        return [len(q & p) / len(q) if q else 0.0 for q, p in sets]

    return score


def _nothing() -> Batch:
    """Backend without a library: an empty text, as for an unreadable file."""
    return lambda items: ["" for _ in items]


def _each(decode: Callable[[bytes], Any]) -> Callable[[], Batch]:
    return lambda: lambda items: [decode(bytes(b)) for b in items]


register("encoder", "default", _hashing_encoder)
register("entities", "default", _capitalised_entities)
register("tokens", "default", _estimated_tokens)
register("rerank", "default", _overlap_rerank)
register("ocr", "default", _nothing)
register("pdf", "default", _each(decoders.pdf_text))
register("osm", "default", _each(decoders.osm_elements))
register("tile", "default", _each(decoders.tile_elements))
register("token_vectors", "default", _token_vectors)
