"""Byte-level BPE of a public tokenizer: encoding in batched numpy merge rounds, and counts by relational merge rounds.

Encoder (`encode`): the pre-split words of a batch of texts lie in one flat symbol array. Each round finds the ranks of all
adjacent pairs by binary search over the sorted pair keys, takes the lowest rank of every word and joins all its occurrences
at once; words without a known pair leave the array. A word is cut beforehand wherever two neighbouring bytes stand together
in no token, so that long runs without spaces need few rounds.

Counter (`piece_counts`): the distinct pre-split pieces of the corpus are kept as symbol arrays in a table, cut at the same
places; in each round the adjacent pairs are joined with the table of merge ranks and every array applies its lowest one,
until none has a pair.

Defined results: null and empty texts have no tokens (an empty list, count 0); strings that look like special tokens are
ordinary text; every code point is encoded, white space included.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbrera.session import cut, written

#: Where the public vocabulary files lie; a parameter of every operator here.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: Pre-split pattern that belongs to the vocabulary (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A symbol s is stored as the code point SHIFT + s in the symbol arrays of the counter; above the surrogates and below the last.
SHIFT = 0x10000
_SPLIT = regex.compile(PATTERN)
_NONE = np.int64(1) << 40
#: Strings and characters kept encoded by a Python worker, about.
CACHE_WORDS, CACHE_CHARACTERS = 100_000, 4_000_000


class Merges:
    """The merge table of a vocabulary: sorted pair keys with rank and joined id, the id of every byte, and which bytes may join."""

    def __init__(self, byte_ids: np.ndarray, left: np.ndarray, right: np.ndarray, joined: np.ndarray, tokens: list[bytes]):
        self.byte_ids = byte_ids.astype(np.int32)
        self.left, self.right, self.joined = left, right, joined
        keys = left.astype(np.int64) << 20 | right
        order = np.argsort(keys)
        self.keys, self.ranks, self.ids = keys[order], order.astype(np.int64), joined[order].astype(np.int32)
        self.together = np.zeros((256, 256), bool)
        for t in tokens:
            b = np.frombuffer(t, np.uint8)
            self.together[b[:-1], b[1:]] = True
        self.tokens = tokens


def _printable_bytes() -> dict[str, int]:
    """The public byte alphabet of byte-level vocabularies: printable bytes stand for themselves, the rest follow from U+0100."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def ship_vocabulary(spark: SparkSession, path: str) -> None:
    """Sends the vocabulary file to the executors, so that only the driver needs it at `path`; a file sent before is not sent again."""
    spark.sparkContext.addFile(path)


def shipped(path: str) -> str:
    """Where a worker finds a vocabulary file: the one sent to it, or else the path itself."""
    try:
        own = SparkFiles.get(os.path.basename(path))
    except Exception:  # noqa: BLE001 - outside of a task and without a session there are no sent files
        return path
    return own if os.path.exists(own) else path


@lru_cache(maxsize=4)
def load_merges(path: str = VOCABULARY) -> Merges:
    """Merge table of a byte-level BPE file in the `tokenizers` JSON format."""
    model = json.load(open(path, encoding="utf-8"))["model"]
    vocab, of = model["vocab"], _printable_bytes()
    byte_ids = np.zeros(256, np.int32)
    for ch, b in of.items():
        byte_ids[b] = vocab[ch]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    left, right, joined = (np.array(x, np.int64) for x in zip(*((vocab[a], vocab[b], vocab[a + b]) for a, b in pairs), strict=True))
    return Merges(byte_ids, left, right, joined, [bytes(of[c] for c in a + b) for a, b in pairs])


def merge_rounds(words: list[bytes], m: Merges) -> list[np.ndarray]:
    """Ids of each word, all words together in rounds."""
    if not words:
        return []
    size = np.array([len(w) for w in words])
    raw = np.frombuffer(b"".join(words), np.uint8)
    word = np.repeat(np.arange(len(words)), size)
    flat = m.byte_ids[raw]
    # A segment ends where its word ends or where no token holds both bytes.
    ends = np.ones(len(raw), bool)
    ends[:-1] = (word[1:] != word[:-1]) | ~m.together[raw[:-1], raw[1:]]
    part = np.concatenate([[0], np.cumsum(ends)[:-1]])
    where = np.arange(len(raw))  # the place of a symbol's first byte keeps the order
    done_at, done_id = [], []
    while len(flat):
        rank = np.full(len(flat), _NONE)
        same = np.flatnonzero(part[:-1] == part[1:])
        key = flat[same].astype(np.int64) << 20 | flat[same + 1]
        at = np.minimum(np.searchsorted(m.keys, key), len(m.keys) - 1)
        hit = m.keys[at] == key
        rank[same[hit]] = m.ranks[at[hit]]
        starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        least = np.minimum.reduceat(rank, starts)
        of = np.repeat(least, np.diff(np.r_[starts, len(flat)]))
        live = of < _NONE
        if not live.all():
            done_at.append(where[~live])
            done_id.append(flat[~live])
            if not live.any():
                break
            flat, part, where, rank, of = flat[live], part[live], where[live], rank[live], of[live]
        pick = np.flatnonzero(rank == of)
        # Of a run of overlapping occurrences (equal symbols) every second one is joined, from the left.
        new = np.r_[True, np.diff(pick) > 1]
        first = pick[np.flatnonzero(new)][np.cumsum(new) - 1]
        pick = pick[(pick - first) % 2 == 0]
        key = flat[pick].astype(np.int64) << 20 | flat[pick + 1]
        flat[pick] = m.ids[np.searchsorted(m.keys, key)]
        keep = np.ones(len(flat), bool)
        keep[pick + 1] = False
        flat, part, where = flat[keep], part[keep], where[keep]
    at, ids = np.concatenate(done_at), np.concatenate(done_id)
    order = np.argsort(at, kind="stable")
    ids, counts = ids[order], np.bincount(word[at], minlength=len(words))
    return np.split(ids, np.cumsum(counts)[:-1])


class Encoder:
    """Encodes batches of texts; keeps the ids of pieces and of the strings between single spaces it has met, up to CACHE_WORDS and CACHE_CHARACTERS.

    No piece goes on over a space that stands alone, so what lies between two of them is split and merged once; a text with
    other white space beside a space is split as a whole.
    """

    def __init__(self, m: Merges):
        self.m = m
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, np.ndarray] = {}
        # Strings at the start of a text and after a space: their ids and number of ids; strings that cannot stand alone.
        self.ids: tuple[dict[str, np.ndarray], dict[str, np.ndarray]] = ({}, {})
        self.sizes: tuple[dict[str, int], dict[str, int]] = ({}, {})
        self.odd: set[str] = set()
        self.held = 0

    def _learn(self, pieces: list[list[str]]) -> list[np.ndarray]:
        new = list(set().union(*pieces) - self.known.keys())
        self.known.update(zip(new, merge_rounds([w.encode("utf-8", "surrogatepass") for w in new], self.m), strict=True))
        return [np.concatenate([self.known[w] for w in p]) if len(p) > 1 else self.known[p[0]] for p in pieces]

    def _read(self, texts: list[str | None]) -> tuple[list[tuple[bool, list[str]]], dict[int, np.ndarray]]:
        """Whether each text starts with a space, and its strings between single spaces, all of them known; and the ids of the texts that are not made of such."""
        if len(self.ids[1]) > CACHE_WORDS or self.held > CACHE_CHARACTERS:
            self._forget()
        split = [(False, []) if not t else (True, t[1:].split(" ")) if t[0] == " " else (False, t.split(" ")) for t in texts]
        new = ({s[0] for spaced, s in split if s and not spaced} - self.ids[0].keys() - self.odd, set().union(*(s if spaced else s[1:] for spaced, s in split)) - self.ids[1].keys() - self.odd)
        for lead, strings, ids, sizes in zip(("", " "), new, self.ids, self.sizes, strict=True):
            good = [c for c in strings if c and not c[0].isspace() and not c[-1].isspace()]
            self.odd |= strings.difference(good)
            self.held += sum(map(len, strings))
            found = dict(zip(good, self._learn([_SPLIT.findall(lead + c) for c in good]), strict=True))
            ids.update(found)
            sizes.update((c, len(x)) for c, x in found.items())
        whole = [k for k, (_, s) in enumerate(split) if not self.odd.isdisjoint(s)]
        return split, dict(zip(whole, self._learn([_SPLIT.findall(texts[k]) for k in whole]), strict=True))

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        split, whole = self._read(texts)
        first, after = self.ids

        def joined(spaced: bool, s: list[str]) -> np.ndarray:
            return np.concatenate([*([] if spaced else [first[s[0]]]), *map(after.__getitem__, s if spaced else s[1:])]) if s else np.zeros(0, np.int32)

        return [whole[k] if k in whole else joined(*x) for k, x in enumerate(split)]

    def counts(self, texts: list[str | None]) -> list[int]:
        split, whole = self._read(texts)
        first, after = self.sizes
        return [len(whole[k]) if k in whole else 0 if not s else sum(map(after.__getitem__, s)) if spaced else first[s[0]] + sum(map(after.__getitem__, s[1:])) for k, (spaced, s) in enumerate(split)]


def spans(texts: list[str], most: int = 1_000_000) -> Iterator[slice]:
    """Slices of a batch that hold about `most` characters, so that long texts do not pile up in one array."""
    start = total = 0
    for k, t in enumerate(texts):
        total += len(t or "")
        if total >= most:
            yield slice(start, k + 1)
            start, total = k + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


@lru_cache(maxsize=2)
def worker_encoder(path: str) -> Encoder:
    """One encoder a Python worker, kept between batches and tasks."""
    return Encoder(load_merges(shipped(path)))


def encode(df: DataFrame, text: str, out: str = "ids", path: str = VOCABULARY, keep: tuple[str, ...] = ()) -> DataFrame:
    """keep columns of df and the ids of `text` as ARRAY<INT>. Narrow: no shuffle; texts pass once to Python in Arrow batches."""
    ship_vocabulary(df.sparkSession, path)

    @F.pandas_udf(T.ArrayType(T.IntegerType(), False))
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = worker_encoder(path)
        for s in batches:
            texts = list(s)
            yield pd.Series([x for part in spans(texts) for x in enc(texts[part])], dtype=object)

    return df.select(*keep, ids(F.col(text)).alias(out))


def token_count(text: Column, path: str = VOCABULARY) -> Column:
    """Number of tokens of a text column, 0 for null; ship_vocabulary() sends the file to the executors."""

    @F.pandas_udf(T.IntegerType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = worker_encoder(path)
        for s in batches:
            texts = list(s)
            yield pd.Series([n for part in spans(texts) for n in enc.counts(texts[part])], dtype="int32")

    return count(text)


# --- counting by relational merge rounds ---------------------------------------------------------------------------------


def split_pieces(text: Column) -> Column:
    """The pre-split pieces of a text column, in the JVM; null and empty texts have none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("(?U)" + PATTERN), F.lit(0))


def merge_table(spark: SparkSession, m: Merges) -> DataFrame:
    """(par, rango, une): pair of symbols, its rank and the joined symbol. As many rows as the vocabulary has merges: a fixed size, so it may be broadcast."""
    pdf = pd.DataFrame({"par": [chr(SHIFT + int(a)) + chr(SHIFT + int(b)) for a, b in zip(m.left, m.right, strict=True)], "rango": np.arange(len(m.left), dtype="int32"), "une": [chr(SHIFT + int(j)) for j in m.joined]})
    return spark.createDataFrame(pdf, "par string, rango int, une string")


def symbol_segments(piece: Column, path: str) -> Column:
    """A piece as arrays of byte symbols, cut wherever two neighbouring bytes stand together in no token: no merge crosses a cut."""

    @F.pandas_udf(T.ArrayType(T.StringType(), False))
    def segments(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = load_merges(shipped(path))
        symbol = np.array([chr(SHIFT + int(i)) for i in m.byte_ids])
        for s in batches:
            out = []
            for t in s:
                raw = np.frombuffer(t.encode("utf-8", "surrogatepass"), np.uint8)
                cuts = np.flatnonzero(~m.together[raw[:-1], raw[1:]]) + 1
                out.append(["".join(x) for x in np.split(symbol[raw], cuts)])
            yield pd.Series(out)

    return segments.asNondeterministic()(piece)


def _round(state: DataFrame, merges: DataFrame) -> DataFrame:
    """One round: the adjacent pairs of every array are joined with the merge ranks, and the lowest one found is applied wherever it stands."""
    n = F.length("s")
    pairs = F.array_distinct(F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.substring("s", i, F.lit(2))))
    rows = state.select("tramo", "s", F.explode_outer(F.when(F.col("vivo") & (n > 1), pairs)).alias("par"))
    best = rows.join(merges, "par", "left").groupBy("tramo", "s").agg(F.min(F.when(F.col("rango").isNotNull(), F.struct("rango", "par", "une"))).alias("b"))
    return best.select("tramo", F.coalesce(F.replace(F.col("s"), F.col("b.par"), F.col("b.une")), F.col("s")).alias("s"), F.col("b").isNotNull().alias("vivo"))


def piece_counts(pieces: DataFrame, path: str = VOCABULARY, rounds_per_cut: int = 8) -> DataFrame:
    """(pieza, n_tokens) of the distinct non-empty strings `pieza`, by rounds of joins with the merge ranks.

    The state holds the distinct segments of the pieces, partitioned by segment once; explode, broadcast join and aggregation
    keep that partitioning, so a round has no exchange and no join back. Every `rounds_per_cut` rounds it is checkpointed and
    finished segments leave it. The number of rounds is bounded by the bytes of the longest segment.
    """
    spark = pieces.sparkSession
    ship_vocabulary(spark, path)
    merges = F.broadcast(merge_table(spark, load_merges(path)))
    own = written(pieces.select("pieza").filter(F.length("pieza") > 0).distinct().select("pieza", symbol_segments(F.col("pieza"), path).alias("_s")))
    own = own.select("pieza", F.explode("_s").alias("tramo"))
    state = own.select("tramo").distinct().select("tramo", F.col("tramo").alias("s"), F.lit(True).alias("vivo"))
    done = []
    while True:
        for _ in range(rounds_per_cut):
            state = _round(state, merges)
        step = cut(state)
        done.append(step.filter(~F.col("vivo")).select("tramo", F.length("s").alias("n")))
        state = step.filter("vivo")
        if state.isEmpty():
            break
    sizes = done[0]
    for d in done[1:]:
        sizes = sizes.unionByName(d)
    return own.join(sizes, "tramo").groupBy("pieza").agg(F.sum("n").cast("int").alias("n_tokens"))


__all__ = ["Encoder", "Merges", "encode", "load_merges", "merge_rounds", "merge_table", "piece_counts", "ship_vocabulary", "shipped", "spans", "split_pieces", "symbol_segments", "token_count"]
