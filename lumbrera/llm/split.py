"""Cutting texts above a token limit into pieces at natural boundaries, consecutive pieces sharing a number of tokens.

A text becomes its class string, one letter a token: what boundary follows that token. One regular expression of bounded
quantifiers, alternatives ordered by the strength of the boundary, consumes the class string body by body; every piece then
looks back `solape` tokens for its overlap. Cuts and offsets are SQL array expressions; Python tokenises and takes the pieces.

Defined results: null and empty texts, and texts within the limit, give one piece (null stays null). A missing source, a null
limit or one below 1 means no limit; every limit from 1 on holds. A null or negative overlap is 0; as a piece holds at least one
token of its own, one that is not below the limit is the limit less one. The overlap starts at a character: where the wanted
token starts inside one, it starts at the next that does not. The smallest piece are the tokens up to the next end of a
character (a character, or a space with one); one of more tokens than the limit is a piece by itself, the only kind above it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbrera.llm.bpe import VOCABULARY, load_merges, ship_vocabulary, shipped, spans, worker_encoder
from lumbrera.session import written

#: Strongest boundary first: after a blank line, a line, a sentence, a clause, a word, a character; x is inside a character.
STRENGTHS = "PLSCWcx"
_ENDS, _CLAUSE, _CLOSE = (np.array([ord(c) for c in s], np.uint32) for s in (".!?…。！？؟।", ",;:—–、，；：،؛", "\"'”’»)]」』"))
_SPACELESS = np.array([ord(c) for c in "。！？、，；：」』"], np.uint32)
#: Groups whose limits may be broadcast.
FEW = 10_000
_PIECE = T.StructType([T.StructField("inicio", T.IntegerType()), T.StructField("fin", T.IntegerType()), T.StructField("n_tokens", T.IntegerType()), T.StructField("pieza", T.StringType())])
_CLASSES = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("clases", T.StringType()), T.StructField("fines", T.ArrayType(T.IntegerType()))])


def _is_space(cp: np.ndarray) -> np.ndarray:
    return np.isin(cp, np.array([9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000], np.uint32))


def boundary_classes(text: str, ids: np.ndarray, sizes: np.ndarray) -> tuple[str, np.ndarray]:
    """Class letter and end offset (code points) of every token."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    head = (raw & 0xC0) != 0x80
    chars = np.r_[0, np.cumsum(head)]
    ends = np.cumsum(sizes[ids])
    whole = np.r_[head, True][ends]
    at = chars[ends]
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(cp)
    space, line = _is_space(cp), np.isin(cp, np.array([10, 13, 0x2028, 0x2029], np.uint32))
    before, after_space = at - 1, np.r_[space, True][at]
    cls = np.full(len(ids), ord("c"), np.uint8)
    cls[after_space | space[before]] = ord("W")
    # The last character that is not a closing mark decides whether a sentence or a clause ends here.
    closing = np.isin(cp, _CLOSE)
    last = np.maximum.accumulate(np.where(~closing, np.arange(n), 0))[before]
    free = after_space | np.isin(cp[last], _SPACELESS)
    cls[free & np.isin(cp[last], _CLAUSE)] = ord("C")
    cls[free & np.isin(cp[last], _ENDS)] = ord("S")
    next_line = np.r_[line, False][at]
    ended = line[before] & ~next_line
    cls[ended] = ord("L")
    text_at = np.maximum.accumulate(np.where(~space, np.arange(n), -1))[before]
    breaks = np.r_[0, np.cumsum(line)]
    cls[ended & (breaks[at] - breaks[text_at + 1] >= 2)] = ord("P")
    cls[~whole] = ord("x")
    return cls.tobytes().decode("ascii"), at.astype(np.int32)


def _classes(text: Column, limit: Column, path: str) -> Column:
    @F.pandas_udf(_CLASSES)
    def classes(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        enc, m = worker_encoder(path), load_merges(shipped(path))
        sizes = np.zeros(max(int(m.byte_ids.max()), int(m.joined.max())) + 1, np.int64)
        sizes[m.byte_ids] = 1
        sizes[m.joined] = [len(t) for t in m.tokens]
        for texts, limits in batches:
            rows = []
            texts, limits = list(texts), limits.to_numpy()
            for part in spans(texts):
                own, most = texts[part], limits[part]
                counts = enc.counts(own)
                big = [k for k, n in enumerate(counts) if most[k] is not None and most[k] == most[k] and n > most[k]]
                found = dict(zip(big, enc([own[k] for k in big]), strict=True))
                rows += [(n, *(boundary_classes(own[k], found[k], sizes) if k in found else (None, None))) for k, n in enumerate(counts)]
            yield pd.DataFrame(rows, columns=["n", "clases", "fines"]).astype({"n": "int32"})

    return classes(text, limit)


def _pieces(text: Column, start: Column, stop: Column, path: str) -> Column:
    """The stretches of a text from `start` to `stop` (arrays of offsets) with their numbers of tokens; a text is cut where it stands, in one go."""

    @F.pandas_udf(T.ArrayType(_PIECE))
    def pieces(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        enc = worker_encoder(path)
        for texts, starts, stops in batches:
            own = [[t[a:z] for a, z in zip(x, y, strict=True)] for t, x, y in zip(texts, starts, stops, strict=True)]
            flat = [p for o in own for p in o]
            counts = iter([n for part in spans(flat) for n in enc.counts(flat[part])])
            yield pd.Series([[{"inicio": int(a), "fin": int(z), "n_tokens": next(counts), "pieza": p} for a, z, p in zip(x, y, o, strict=True)] for x, y, o in zip(starts, stops, own, strict=True)])

    # Marked as not deterministic, so that the explode does not make it run twice.
    return pieces.asNondeterministic()(text, start, stop)


def _pattern(limit: Column, body: Column) -> Column:
    """Bodies of at most `limit` tokens for the first piece and `body` for the others, strongest boundary in their last half first."""

    def alternatives(n: Column) -> Column:
        most, less, half = n.cast("string"), (n - 1).cast("string"), F.floor(n / 2).cast("string")
        strong = [F.concat(F.lit(".{"), half, F.lit(","), less, F.lit("}" + c)) for c in "PLSC"]
        weak = [F.concat(F.lit(".{0,"), less, F.lit("}" + c)) for c in ("[PLSCW]", "c")]
        # A character of more tokens than fit is taken whole.
        return F.concat_ws("|", F.concat(F.lit(".{1,"), most, F.lit(r"}\z")), *strong, *weak, F.lit("x*[^x]"))

    return F.concat(F.lit(r"\A(?:"), alternatives(limit), F.lit(")|(?:"), alternatives(body), F.lit(")"))


def split_oversized(docs: DataFrame, limits: DataFrame, key: str = "doc_id", text: str = "text", group: str = "source", path: str = VOCABULARY) -> DataFrame:
    """(key, parte, partes, inicio, fin, n_tokens, pieza): the pieces of every text; inicio and fin are offsets in code points.

    limits: (group, max_tokens, solape_tokens), one row a group, of any number.
    A text cut inside a pre-split piece can have more tokens when the piece is tokenised by itself. After the cut all pieces
    are therefore counted again; documents with a piece above the limit are cut anew with a limit lower by the excess.
    """
    ship_vocabulary(docs.sparkSession, path)
    limits = limits.groupBy(group).agg(F.min("max_tokens").alias("_max"), F.max("solape_tokens").alias("_sol"))
    # Limits of a checked number are sent to the texts; more of them are joined by a shuffle, whose hot groups AQE splits.
    limits = F.broadcast(limits) if limits.limit(FEW + 1).count() <= FEW else limits
    most = F.when(F.col("_max") >= 1, F.col("_max"))
    docs = docs.select(F.col(key).alias("_k"), F.col(text).alias("_t"), F.col(group).alias(group)).join(limits, group, "left").select("_k", "_t", most.alias("_max"), F.least(F.greatest(F.coalesce("_sol", F.lit(0)), F.lit(0)), most - 1).cast("int").alias("_sol"))
    sized = written(docs.withColumn("_c", _classes(F.col("_t"), F.col("_max"), path)))
    whole = sized.filter(F.col("_c.clases").isNull()).select(
        F.col("_k").alias(key), F.lit(0).alias("parte"), F.lit(1).alias("partes"), F.lit(0).alias("inicio"), F.coalesce(F.length("_t"), F.lit(0)).alias("fin"), F.col("_c.n").alias("n_tokens"), F.col("_t").alias("pieza")
    )
    todo = sized.filter(F.col("_c.clases").isNotNull()).select("_k", "_t", "_max", "_sol", "_c.clases", "_c.fines", F.col("_max").alias("_now"))
    parts = [whole]
    while True:
        sol = F.least(F.col("_sol"), F.col("_now") - 1)
        bodies = F.regexp_extract_all("clases", _pattern(F.col("_now"), F.col("_now") - sol), F.lit(0))
        stops = F.expr("aggregate(_b, array(0), (a, x) -> array_append(a, element_at(a, -1) + length(x)))")
        cut = todo.withColumn("_b", bodies).select("_k", "_t", "_max", "_now", "fines", sol.alias("_o"), stops.alias("_e"))
        # The end of a token inside a character is given as that of the character, so any token can start an overlap.
        start = F.expr("transform(slice(_e, 1, size(_e) - 1), x -> if(x <= _o, 0, get(fines, x - _o - 1)))")
        cut = cut.select("_k", "_max", "_now", _pieces(F.col("_t"), start, F.expr("transform(slice(_e, 2, size(_e) - 1), x -> get(fines, x - 1))"), path).alias("_p"))
        cut = written(cut.select("_k", "_max", "_now", F.size("_p").alias("partes"), F.posexplode("_p").alias("parte", "_x")).select("_k", "_max", "_now", "partes", "parte", "_x.*"))
        # At a limit of one the bodies are single tokens or characters: nothing is left to cut.
        over = cut.filter((F.col("n_tokens") > F.col("_max")) & (F.col("_now") > 1)).groupBy("_k").agg(F.max(F.col("n_tokens") - F.col("_max")).alias("_mas"))
        over = written(over)
        parts.append(cut.join(over, "_k", "left_anti").select(F.col("_k").alias(key), "parte", "partes", "inicio", "fin", "n_tokens", "pieza"))
        if over.isEmpty():
            break
        todo = written(todo.join(over, "_k").withColumn("_now", F.greatest(F.lit(1), F.col("_now") - F.col("_mas"))).drop("_mas"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def oversized(docs: DataFrame, limits: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(doc_id) of the documents that had to be cut."""
    return split_oversized(docs, limits, path=path).filter((F.col("partes") > 1) & (F.col("parte") == 0)).select("doc_id")
