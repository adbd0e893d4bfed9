import time

import pytest
from pyspark.sql import functions as F

from lumbrera.functions import html, jsontext, sentences, text, vectors
from lumbrera.operators import chunking

CLEANED = [
    ("PÁGINA 3 DE 9 texto", "texto"), ("pag 4 y página 5.", "pag 4 y ."), ("a\r\n17\r\nb", "a\r\n\nb"), ("\u00a0x ", "x"), ("e\u0301l", "él"), ("Enero 2018 fin", "fin"), ("en mayo 1999, no", "en , no"),
    ("ver www.a.b/c y https://x.y z", "ver y z"), ("\x01\x02 a\t\tb", "a b"), ("1\n\n\n\n2 palabras", "2 palabras"), ("٣٤\ntexto", "texto"), ("", ""), ("   ", ""), ("a\n \n \n\nb", "a\n \n \n\nb"), ("fin\n\n\n\n\notro", "fin\n\notro"),
]


def test_clean_text(spark):
    got = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(CLEANED)], "k int, t string").select("k", text.clean_text(F.col("t")).alias("c")).collect()
    assert {r.k: r.c for r in got} == {k: want for k, (_, want) in enumerate(CLEANED)}


def test_null_texts(spark):
    df = spark.createDataFrame([(None,)], "t string")
    r = df.select(text.clean_text(F.col("t")).alias("c"), text.language_vote(F.col("t")).alias("l"), text.word_count(F.col("t")).alias("w"), text.token_estimate(F.col("t")).alias("n"), text.phenomenon_number(F.col("t")).alias("f")).first()
    assert (r.c, r.l, r.w, r.n, r.f) == (None, "es", 0, 0, 0)


def test_language_vote(spark):
    rows = [("El consejo de la cuenca y las familias por el camino", "es"), ("The council of the basin and the families were with them", "en"), ("O conselho da bacia e as famílias não são mais do que uma", "pt"), ("corto", "es")]
    got = spark.createDataFrame(rows, "t string, want string").select("want", text.language_vote(F.col("t")).alias("l")).collect()
    assert all(r.want == r.l for r in got)


def test_paths_and_ids(spark):
    df = spark.createDataFrame([("data/raw/F2_espacio/a.pdf", 7), ("data\\raw\\f3_x\\b", 1234), ("otro", 0), ("F99999999999_x", 1)], "p string, n int")
    got = df.select(text.phenomenon_number(F.col("p")).alias("f"), text.path_key(F.col("p")).alias("k"), text.chunk_id(F.lit("D"), F.col("n")).alias("c")).collect()
    assert [tuple(r) for r in got] == [(2, "F2_espacio/a.pdf", "D-chunk-007"), (3, "f3_x/b", "D-chunk-1234"), (0, "otro", "D-chunk-000"), (0, "F99999999999_x", "D-chunk-001")]


@pytest.mark.parametrize(
    "parts, lang",
    [
        (["La Sra. Quiroga midió 2.75 metros.", "Después cerró el pozo."], "es"),
        (["La misión a EE.UU. duró poco.", "Volvieron en abril."], "es"),
        (["O Dr. Abreu abriu a represa.", "Choveu às 9h."], "pt"),
        (["Dr. Holm and Col. Reyes met.", "They left the U.K. in May."], "en"),
        (["R. M. Ibarra firmó el acta.", "Nadie se opuso."], "es"),
        (["El caudal subió... aunque menos que antes.", "Nueva lectura…", "Otra más."], "es"),
        (["¿Quién midió?", "¡Nadie!", "«Así fue.»", "Fin"], "es"),
        (["El Sr. Vela salió.", "Volvió."], "fr"),
        (["sin punto ni mayúscula"], "es"),
        ([], "es"),
    ],
)
def test_sentences(parts, lang):
    assert sentences.split_sentences(" ".join(parts), lang) == parts
    assert sentences.split_sentences(" \n " + "\n ".join(parts) + " ", lang) == parts


def test_no_sentences():
    assert sentences.split_sentences(None, None) == [] == sentences.split_sentences(" \n ")


def test_sentences_of_a_long_text_are_read_once():
    began = time.perf_counter()
    assert len(sentences.split_sentences("Una frase. " * 400_000)) == 400_000 and len(sentences.split_sentences("a." * 2_000_000 + " B")) == 1
    assert time.perf_counter() - began < 20


def test_html_nesting_and_fallback():
    assert html.html_text("<nav>x</nav><ul><li>a <p>b</p></li></ul><p>c<p>d") == "a b\n\nb\n\nc d\n\nd"
    assert html.html_text("<div>a<br>b<script>var x</script><!-- c --></div>") == "a\nb"
    assert html.html_text("</p></div>") == ""
    assert html.html_text("<article><nav><p>no</p></nav><h2>sí</h2></article>") == "sí"


def test_json():
    long = "x" * 200
    assert jsontext.json_text('[{"title": "A", "text": ["p", "", "q"]}, {"cuerpo": "B"}, 7]') == "A\n\np\nq\n\nB\n\n7"
    assert jsontext.json_text('{"metadata": {"page_title": "T"}}') == "T"
    assert jsontext.json_text('{"content": {"s": "%s", "corto": "%s"}}' % (long, long[1:])) == "s\n" + long
    assert jsontext.json_text('{"a": {"b": 0, "c": [1, {"d": false}], "e": null, "f": ""}}') == "a.b: 0\na.c.d: False"


def test_malformed_json_is_an_error(spark):
    r = spark.createDataFrame([("{",), (None,)], "j string").select(jsontext.from_json_text(F.col("j")).alias("x")).select("x.*").collect()
    assert r[0].error and r[0].texto is None and r[1].error is None


def test_wrap_keeps_words_and_limits():
    unit = " ".join(f"w{k}" for k in range(400)) + " " + "y" * 95 + " z"
    parts = list(chunking.wrapped(unit, 40))
    assert all(len(p) <= 40 for p in parts)
    assert "".join(parts).replace(" ", "") == unit.replace(" ", "")
    assert list(chunking.wrapped("abc", 3)) == ["abc"] and list(chunking.wrapped("abcdef", 4)) == ["abcd", "ef"]


def test_chunks_overlap_and_keep_rows():
    prose = " ".join(f"Esta es la frase número {k} del texto." for k in range(60))
    parts = chunking.chunk_texts(prose, "es", False, 40, 1)
    assert len(parts) > 1
    for a, b in zip(parts, parts[1:]):
        assert sentences.split_sentences(a)[-1] == sentences.split_sentences(b)[0]
    rows = "\n\n".join(f"id: {k}, v: x" for k in range(100))
    cut = chunking.chunk_texts(rows, "es", True, 40)
    assert "\n\n".join(cut) == rows
    assert chunking.chunk_texts("", "es", False) == [] == chunking.chunk_texts(None, None, True)


def test_chunk_corpus_schema_and_nulls(spark):
    df = spark.createDataFrame([("D1", "f", "txt", 1, None, "Una frase. Otra frase."), ("D2", None, None, None, "en", None), ("D3", "f", "csv", 0, "es", "a: 1\n\nb: 2")], "doc_id string, fuente string, formato string, fenomeno int, idioma string, texto_completo string")
    got = {r.chunk_id: r for r in chunking.chunk_corpus(df).collect()}
    assert set(got) == {"D1-chunk-000", "D3-chunk-000"}
    assert got["D1-chunk-000"].idioma == "es" and got["D3-chunk-000"].fenomeno == 0 and got["D3-chunk-000"].num_tokens == 3
    assert chunking.chunk_corpus(df.limit(0)).count() == 0


def test_token_budget_chunks():
    t = " ".join(f"Frase {k} corta." for k in range(10))
    assert all(len(c.split()) <= 9 for c in chunking.token_budget_chunks(t, 9, 1, lambda s: len(s.split())))


def test_vectors(spark):
    df = spark.createDataFrame([("a", [3.0, 4.0], 1.0), ("a", [1.0, 0.0], 3.0), ("b", [0.0, 0.0], 0.0), ("b", None, 1.0)], "k string, v array<float>, w double")
    assert [r.n for r in df.filter("v is not null").select(vectors.norm(F.col("v")).alias("n")).collect()] == [5.0, 1.0, 0.0]
    assert {r.k: r.v for r in vectors.mean_pool(df, "k", "v", "w").collect()} == {"a": [1.5, 1.0], "b": [0.0, 0.0]}
    assert df.filter("k = 'b' and v is not null").select(vectors.unit(F.col("v")).alias("u")).first().u is None
