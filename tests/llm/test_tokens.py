import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lumbrera.llm import bpe, split, tokens

TEXTS = [None, "", " ", "\n\n \t", "<|endoftext|> hola", "aaaaaaaaaaaaaaaaaaaa", "El año 2024, ¿qué? 😀😀", "数字伦理委员会 的" * 40, "สถานีติดตามดาวเทียม" * 9, "x" * 3000, "a b​c é", "It's we'll I'd", "word " * 5000]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(bpe.VOCABULARY)
    t.encode_special_tokens = True
    return lambda texts: [e.ids for e in t.encode_batch(list(texts), add_special_tokens=False)]


def test_encoder_is_that_of_the_library(library):
    texts = [t or "" for t in TEXTS]
    assert [list(map(int, x)) for x in bpe.Encoder(bpe.load_merges())(texts)] == library(texts)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=5))
def test_encoder_on_any_text(library, texts):
    assert [list(map(int, x)) for x in bpe.Encoder(bpe.load_merges())(texts)] == library(texts)


def test_cache_overflow(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 3)
    enc = bpe.Encoder(bpe.load_merges())
    for t in (["uno dos tres"], ["cuatro cinco seis siete"], ["uno dos"]):
        assert [list(map(int, x)) for x in enc(t)] == library(t)


def test_encode_column(spark, library):
    df = spark.createDataFrame([(k, t, "extra") for k, t in enumerate(TEXTS)], "doc_id bigint, text string, ids string")
    got = {r.doc_id: r.ids for r in bpe.encode(df, "text", keep=("doc_id",)).collect()}
    assert [got[k] for k in range(len(TEXTS))] == library(t or "" for t in TEXTS)
    assert bpe.encode(df.limit(0), "text", keep=("doc_id",)).count() == 0


def test_relational_counts(spark, library):
    df = spark.createDataFrame([(k, t, 1, 2) for k, t in enumerate(TEXTS)] + [(0, None, 1, 2)], "k int, texto string, n_tokens int, _fila int")
    got = {r.k: r.n_tokens for r in tokens.counted_rows(df, "texto", ["k"]).collect()}
    assert [got[k] for k in range(len(TEXTS))] == [len(x) for x in library(t or "" for t in TEXTS)]
    assert tokens.counted_rows(df.limit(0), "texto", ["k"]).count() == 0


CHUNK = "chunk_id string, fuente string, idioma string, fenomeno int, formato string, num_tokens int, texto string"


def test_doubtful_and_totals(spark, library):
    text = "Una frase corta con varias palabras distintas."
    n = len(library([text])[0])
    rows = [(f"c{k}", "f", "es", 1, "pdf", v, text) for k, v in enumerate([None, 0, -1, n, 2 * n, 2 * n + 1, (n + 1) // 2, n // 2 - 1])]
    rows += [rows[3], ("b", None, None, None, None, None, "  "), ("z", None, None, None, None, 5, None)]
    df = spark.createDataFrame(rows, CHUNK)
    assert sorted(r.chunk_id for r in tokens.doubtful_chunks(df).collect()) == ["c0", "c1", "c2", "c5", "c7"]
    totals = {r.fuente: r for r in tokens.token_budget(df).collect()}
    assert (totals["f"].chunks, totals["f"].tokens, totals["f"].chunks_dudosos) == (8, 8 * n, 5) and totals[None].chunks == 2
    assert tokens.token_budget(df.limit(0)).count() == 0


def test_split_limits_overlaps_and_wholeness(spark, library):
    rng = random.Random(4)
    prose = " ".join(rng.choice(["La red de radares midió", "El consejo publicó\n", "datos,", "fin.", "¿Qué?\n\n"]) for _ in range(400))
    docs = [("a", prose, "s"), ("b", "y" * 4000, "s"), ("c", "汉字" * 500, "s"), ("d", "corto", "s"), ("e", None, "s"), ("f", prose, None), ("g", prose, "sin"), ("h", "", "s"), ("i", "😀" * 300, "raro")]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id string, text string, source string, parte int")
    limits = spark.createDataFrame([("s", 64, 8), ("s", 64, 8), ("sin", None, None), ("raro", 12, 50)], "source string, max_tokens int, solape_tokens int")
    got = split.split_oversized(df, limits).toPandas()
    assert set(got.doc_id) == set("abcdefghi")
    most = {"s": 64, "raro": 12}
    for key, text, source in docs:
        own = got[got.doc_id == key].sort_values("parte")
        assert list(own.parte) == list(range(len(own))) and (own.partes == len(own)).all()
        big = source in most and len(library([text or ""])[0]) > most[source]
        assert (len(own) > 1) == big
        if big:
            at = 0
            for r in own.itertuples():
                assert r.inicio <= at < r.fin and text[r.inicio : r.fin] == r.pieza
                assert len(library([r.pieza])[0]) == r.n_tokens <= most[source]
                assert r.parte == 0 or r.inicio < at or key == "i"
                at = r.fin
            assert at == len(text)
    a = got[got.doc_id == "a"].sort_values("parte")
    assert (a.pieza.str.rstrip(" ").str[-1].isin(list("\n.?,")))[:-1].mean() > 0.9
    assert sorted(r.doc_id for r in split.oversized(df, limits).collect()) == ["a", "b", "c", "i"]
    assert split.split_oversized(df.limit(0), limits).count() == 0 and split.oversized(df, limits.limit(0)).count() == 0


def test_every_limit_from_one_on(spark, library):
    texts = {"p": "Uno dos, tres. Cuatro\n\ncinco seis siete ocho nueve diez once doce.", "e": "😀 汉字😀x", "l": "antidisestablishmentarianismo" * 3}
    rows = [(f"{k}{n}-{o}", t, f"s{n}-{o}") for k, t in texts.items() for n in range(1, 9) for o in (0, 3, 50)]
    df = spark.createDataFrame(rows, "doc_id string, text string, source string")
    limits = spark.createDataFrame([(f"s{n}-{o}", n, o) for n in range(1, 9) for o in (0, 3, 50)] + [("s0", 0, 0)], "source string, max_tokens int, solape_tokens int")
    got = split.split_oversized(df, limits).toPandas()
    for key, text, source in rows:
        most, share = map(int, source[1:].split("-"))
        own = got[got.doc_id == key].sort_values("parte")
        at = 0
        for r in own.itertuples():
            # Whole and in order; only a character (with a space before it) that has more tokens by itself is above the limit.
            assert r.inicio <= at < r.fin and text[r.inicio : r.fin] == r.pieza
            assert r.n_tokens == len(library([r.pieza])[0]) and (r.n_tokens <= most or len(r.pieza.strip()) == 1), (key, r)
            assert r.parte == 0 or share == 0 or most == 1 or r.inicio < at or len(library([text[at - 1 : r.fin]])[0]) > 2, (key, r)
            at = r.fin
        assert at == len(text) and (own.partes == len(own)).all()
    over = {r.doc_id for r in split.oversized(df, limits).collect()}
    assert over == {k for k, t, s in rows if len(library([t])[0]) > int(s[1:].split("-")[0])}


def test_counts_column(spark, library):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    assert [r.n for r in df.select(bpe.token_count(F.col("t")).alias("n")).collect()] == [len(x) for x in library(t or "" for t in TEXTS)]
