import math

import pytest
from pyspark.sql import functions as F

from lumbrera import plugins
from lumbrera.operators import graph, ingest, metrics, search
from lumbrera.plans import pipelines
from lumbrera.sources import files


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_row_numbers_over_partitions(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("x")).repartition(7)
    got = ingest.row_numbers(df, ["x"]).collect()
    assert sorted((r.ord, r.x) for r in got) == [(k, k) for k in range(1000)]


def test_dispatch_status_and_rerun(spark):
    df = spark.createDataFrame(
        [("D1", "a\\tiles\\x.pbf", "PBF", "t"), ("D2", "a/x.pbf", "pbf", "  "), ("D3", "a.zip", "zip", "t"), ("D4", None, "html", "t"), ("D5", "a", None, "t"), ("D6", "a.html", "html", None)],
        "doc_id string, path string, formato string, texto string",
    )
    assert [r[0] for r in df.orderBy("doc_id").select(ingest.extractor(F.col("formato"), F.col("path"))).collect()] == ["tile", "osm", None, "html", None, "html"]
    ok, bad = ingest.extracted_and_failed(ingest.extraction_status(df))
    assert rows(ok, "doc_id") == [("D1",)]
    assert dict(rows(bad, "doc_id", "error")) == {"D2": "empty text", "D3": "no extractor for zip", "D4": "invalid row", "D5": "no extractor for null", "D6": "empty text"}
    assert ingest.to_run_again(df, bad).count() == 5


def test_corpus(spark):
    reg = spark.createDataFrame([("1", "data/raw/F1_a/x.pdf", "pdf"), ("2", "data\\raw\\F2_b\\y.pdf", "pdf"), ("3", "data/raw/F9_c/z", "txt"), ("4", "data/raw/F1_a/w", None), ("5", "data/raw/F3_q/v", "txt")], "doc_id string, fuente string, formato string")
    texts = spark.createDataFrame([(str(k), "t" if k != 5 else "  ") for k in range(1, 6)], "doc_id string, texto string")
    lang = spark.createDataFrame([("1", "es")], "doc_id string, idioma string")
    index = spark.createDataFrame([("F1_a\\", "x.pdf", "viejo", 1), ("F1_a", "x.pdf", "OF1", 2)], "carpeta string, nombre string, doc_id string, ord int")
    corpus, out = ingest.build_corpus(reg, texts, lang, files.official_ids(index))
    assert rows(corpus, "doc_id", "fenomeno", "idioma") == [("OF1", 1, "es")]
    assert rows(out, "doc_id") == [("2",)]


def test_reuse_vectors(spark):
    new = spark.createDataFrame([("c1", "f", 0, "t"), ("c2", "f", 1, "t"), ("c3", None, None, "t")], "chunk_id string, fuente string, posicion int, texto string")
    old = spark.createDataFrame([("f", 0, "t", [1.0], 1), ("f", 0, "t", [2.0], 2)], "fuente string, posicion int, texto string, embedding array<float>, vec_id bigint")
    got, rest = ingest.reuse_vectors(new, old)
    assert [tuple(r.embedding) for r in got.collect()] == [(2.0,)] and rows(rest, "chunk_id") == [("c2",), ("c3",)]
    with pytest.raises(Exception, match="text differs at f 0"):
        ingest.reuse_vectors(new.withColumn("texto", F.lit("otro")), old)[0].collect()


def test_search_variants_agree_with_ties_and_nulls(spark):
    base = spark.createDataFrame([(k, [float(k % 5), 1.0]) for k in range(40)] + [(99, None)], "id bigint, vector array<float>")
    q = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0]), ("n", None)], "query_id string, vector array<float>")
    a, b, c = (rows(f(q, base, 7), "query_id", "rank", "id", "score") for f in (search.exact_topk, search.topk_by_expression, lambda *x: search.exact_topk(*x, block=1)))
    assert a == b == c and len(a) == 14
    assert [x[2] for x in a if x[0] == "b"] == list(range(7))
    assert search.exact_topk(q.limit(0), base, 3).count() == 0 and search.exact_topk(q, base.limit(0), 3).count() == 0


def test_fusion_ties_and_bounds(spark):
    s = "q string, c string, rank int"
    a = spark.createDataFrame([("q1", "x", 1), ("q1", "y", 2)], s)
    b = spark.createDataFrame([("q1", "z", 1), ("q1", "y", 2), ("q2", "w", 1)], s)
    got = search.reciprocal_rank_fusion(a, b, ["q"], "c").collect()
    assert [(r.q, r.c) for r in sorted(got, key=lambda r: (r.q, r["rank"]))] == [("q1", "y"), ("q1", "x"), ("q1", "z"), ("q2", "w")]
    assert all(0 < r.score <= 2 / 61 for r in got)


def test_pooling(spark):
    h = spark.createDataFrame([("q", "A", -0.2, 2), ("q", "B", -0.2, 1), ("q", "A", -0.5, 3), ("q", "C", -0.9, 4), ("q", "D", -1.0, 5)], "query_id string, doc_id string, score double, rank int")
    assert rows(search.pooled_documents(h), "rank", "doc_id", "score") == [(1, "B", -0.2), (2, "A", -0.2), (3, "C", -0.9)]
    assert rows(search.pooled_documents(h, floor=0.0), "rank", "doc_id", "score") == [(1, "B", 0.0), (2, "A", 0.0), (3, "C", 0.0)]


def test_passages(spark):
    words = lambda n: " ".join(f"p{k}" for k in range(n))
    assert search.passages_of(words(250)) == [words(250)]
    assert [len(p.split()) for p in search.passages_of(words(600))] == [250, 250, 100]
    two = "A" + words(150) + ". B" + words(150) + "."
    assert [p[0] for p in search.passages_of(two)] == ["A", "B"]
    assert search.passages_of(None) == []
    hits = spark.createDataFrame([("q", f"c{k}", "d", two, "es", k) for k in range(1, 9)] + [("r", "c1", "d", "corto", None, 1)], "query_id string, chunk_id string, doc_id string, texto string, idioma string, rank int")
    got = search.first_passages(hits).collect()
    assert [r.chunk_id for r in sorted((r for r in got if r.query_id == "q"), key=lambda r: r["rank"])] == [c for k in range(1, 6) for c in (f"c{k}", f"c{k}")]
    assert sum(r.query_id == "r" for r in got) == 1


def test_graph(spark):
    text = "Ana Ruiz visitó a OTAN con Luis Vega. Brasil cerró. OTAN habló con Ana Ruiz."
    chunks = spark.createDataFrame([(0, "D", "c1", 1, text, "es"), (32, "D", "c2", 2, "OTAN", "es"), (33, "D", "c3", 2, None, "es")], "ord bigint, doc_id string, chunk_id string, fenomeno int, texto string, idioma string")
    nodes, edges = graph.build_graph(chunks)
    assert rows(edges, "src", "dst", "relacion") == [("ana ruiz", "otan", "visitó a"), ("otan", "ana ruiz", "habló con"), ("otan", "luis vega", "con")]
    assert rows(nodes, "id", "tipo") == [("ana ruiz", "MISC"), ("luis vega", "MISC"), ("otan", "ORG")]
    assert rows(graph.stride_sample(chunks), "ord") == [(0,), (32,)]
    assert rows(graph.degree(edges), "id", "grado") == [("ana ruiz", 2), ("luis vega", 1), ("otan", 3)]


def test_evidence_counts_edges_inside_twice(spark):
    edges = spark.createDataFrame([("a", "b", "k1"), ("b", "c", "k1"), ("c", "d", "k2"), ("d", "e", "k3")], "src string, dst string, chunk_id string")
    seeds = spark.createDataFrame([("q", "a")], "query_id string, id string")
    # a and its neighbour b are relevant: a-b counts twice, b-c once.
    assert rows(graph.evidence(seeds, edges), "chunk_id", "conteo") == [("k1", 3)]
    allowed = spark.createDataFrame([("q", "k2")], "query_id string, chunk_id string")
    assert graph.evidence(seeds, edges, allowed).count() == 0


def test_query_entities_leave_out_generic_nouns(spark):
    q = spark.createDataFrame([("q1", "Qué hizo el Estado con OTAN"), ("q2", None)], "query_id string, text string")
    assert rows(graph.query_entities(q), "query_id", "id") == [("q1", "otan"), ("q1", "qué")]


def test_metrics(spark):
    rel = {"a": [3, 2, 1], "b": [1, 2, 3], "z": [0, 0, 0]}
    j = spark.createDataFrame([(q, k + 1, r) for q, rs in rel.items() for k, r in enumerate(rs)], "query_id string, rank int, rel int")
    got = dict(rows(metrics.ndcg(j, 3), "query_id", "ndcg"))
    d = sum(r / math.log2(k + 2) for k, r in enumerate([1, 2, 3])) / sum(r / math.log2(k + 2) for k, r in enumerate([3, 2, 1]))
    assert got["a"] == pytest.approx(1) and got["b"] == pytest.approx(d) and got["z"] == 0
    res = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 3, "w"), ("b", 1, "x")], "query_id string, rank int, doc_id string")
    want = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "w"), ("b", "x"), ("b", "m"), ("b", "n"), ("c", "x")], "query_id string, doc_id string")
    f1 = dict(rows(metrics.f1_at(res, want), "query_id", "f1"))
    assert f1["a"] == pytest.approx(1) and f1["b"] == pytest.approx(1 / 3) and f1["c"] == 0
    h = metrics.histogram(spark.createDataFrame([(0.0,), (0.05,), (1.0,), (None,)], "m double"), "m", 0.0, 1.0)
    assert rows(h, "bin", "n") == [(1, 2), (10, 1)]


def test_answers_fall_back_without_graph_hits(spark):
    q = spark.createDataFrame([("q1", "OTAN"), ("q2", "nada")], "query_id string, text string")
    chunks = spark.createDataFrame([(f"c{k}", f"d{k % 2}", f"texto {k}", "es") for k in range(4)], "chunk_id string, doc_id string, texto string, idioma string")
    pool = spark.createDataFrame([(x, f"c{k}", 1.0 - k / 10, k + 1) for x in ("q1", "q2") for k in range(4)], "query_id string, chunk_id string, score double, rank int")
    edges = spark.createDataFrame([("otan", "x", "c3")], "src string, dst string, chunk_id string")
    hits, docs, pieces = pipelines.answers(q, pool, chunks, edges)
    kind = {r.query_id: r.score_kind for r in hits.collect()}
    assert kind == {"q1": "rrf", "q2": "cosine"}
    first = {r.query_id: r.chunk_id for r in hits.filter("rank = 1").collect()}
    assert first == {"q1": "c3", "q2": "c0"}
    r = {x.query_id: x for x in pipelines.results(docs, pieces).collect()}
    assert [f["rank"] for f in r["q1"].fragments] == [1, 2, 3, 4] and len(r["q2"].documents) == 2
    changed = {x.query_id: x.cambia for x in pipelines.ablation(q, pool, chunks, edges).collect()}
    assert changed == {"q1": True, "q2": False}


def test_plugins():
    with pytest.raises(LookupError):
        plugins.factory("encoder", "none")
    with pytest.raises(ValueError):
        plugins.register("nothing", "x", lambda: None)


def test_default_encoder_and_rerank(spark):
    df = spark.createDataFrame([("a b",), ("b a",), ("",), (None,)], "t string")
    v = [r.vector for r in search.encoded(df, "t").collect()]
    assert v[0] == v[1] and sum(x * x for x in v[0]) == pytest.approx(1, abs=1e-3) and not any(v[2]) and v[3] is None
    hits = spark.createDataFrame([("q", "c1", "nada", 1), ("q", "c2", "mina sin licencia", 2)], "query_id string, chunk_id string, texto string, rank int")
    q = spark.createDataFrame([("q", "licencia mina")], "query_id string, text string")
    assert search.reranked(hits, q, 1).first().chunk_id == "c2"


def test_projection_and_matrix(spark):
    df = spark.createDataFrame([(k, [float(k), 2.0 * k, 0.0]) for k in range(4)], "k int, v array<float>")
    assert search.projected(df, "k", "v").count() == 4
    whole, blocks = (rows(search.similarity_matrix(df, "k", "v", n), "a", "b", "score") for n in (1000, 3))
    assert whole == blocks and len(whole) == 16
