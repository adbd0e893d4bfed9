import itertools
import os
from math import comb

import numpy as np
import pytest

from lumbrera.llm import knn, mix, rank

SCORES = "corrida_id string, query_id string, chunk_id string, coseno double, bm25 double, evidencia_grafo int, reordenador double, distancia double, significancia int"


def brute(rows, k=10):
    groups = {}
    for r in set(rows):
        groups.setdefault(r[:2], []).append(r)
    out = set()
    for g, items in groups.items():
        ranked = []
        for it in items:
            rs = []
            for s in range(5):
                v, sign = it[3 + s], -1 if s == 4 else 1
                if v is None or v != v:
                    rs.append(1.0)
                    continue
                vals = [x[3 + s] * sign for x in items if x[3 + s] is not None and x[3 + s] == x[3 + s]]
                rs.append((1 + sum(x > v * sign for x in vals) + (sum(x == v * sign for x in vals) - 1) / 2) / len(items))
            rs.sort()
            p = 5 * min(sum(comb(5, j) * r**j * (1 - r) ** (5 - j) for j in range(i, 6)) for i, r in enumerate(rs, 1))
            ranked.append((round(p, 9), round(sum(rs) / 5, 9), it[2]))
        out |= {(*g, x[2]) for x in sorted(ranked)[:k]}
    return out


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    out = []
    for q in range(3):
        for c in range(40):
            v = [float(x) if rng.random() > 0.1 else None for x in (rng.random(), rng.lognormal(3, 2), 0, rng.normal(), rng.random())]
            v[2] = int(rng.integers(0, 4)) if rng.random() > 0.1 else None
            out.append(("r", f"q{q}", f"c{c}", *v, 1))
    return [*out, *out[:9], ("r", "q9", "solo", None, None, None, None, None, 1), ("r", "q8", "nan", float("nan"), float("inf"), 1, 0.0, None, 1)]


def test_robust_rank_is_brute_force(spark, rows):
    df = spark.createDataFrame(rows, SCORES)
    got = {tuple(r) for r in rank.first_of_ranking(df).select("corrida_id", "query_id", "chunk_id").collect()}
    assert got == brute(rows)


def test_large_groups_rank_alike(spark, rows):
    df = spark.createDataFrame(rows, SCORES)
    a, b = (rank.robust_rank(df, large=n).orderBy("query_id", "chunk_id").collect() for n in (10**6, 5))
    assert [(r.query_id, r.chunk_id) for r in a] == [(r.query_id, r.chunk_id) for r in b]
    assert np.allclose([r.significancia for r in a], [r.significancia for r in b])


def test_rank_edges(spark):
    df = spark.createDataFrame([(None, None, "c", 1.0, None, None, None, None, 0), (None, None, None, 1.0, None, None, None, None, 0)], SCORES)
    assert [r.chunk_id for r in rank.first_of_ranking(df).collect()] == ["c"]
    assert rank.first_of_ranking(df.limit(0)).count() == 0


def test_flight_keeps_totals():
    rng = np.random.default_rng(0)
    size = rng.integers(1, 500, 400).astype(float)
    pi = np.full(400, 0.37)
    p = mix.flight(pi, size, rng)
    assert ((p > 1e-9) & (p < 1 - 1e-9)).sum() <= 2
    assert p.sum() == pytest.approx(pi.sum()) and p @ size == pytest.approx(pi @ size)
    done = mix.landing(p, size)
    assert set(done) <= {0.0, 1.0} and abs(done @ size - pi @ size) <= size.max()
    assert set(mix.landing(mix.flight(np.array([0.5, 0.5, 0.5]), np.array([2.0, 2.0, 2.0]), rng), np.ones(3))) <= {0.0, 1.0}


def test_flight_is_unbiased():
    rng = np.random.default_rng(1)
    size = np.array([1.0, 2.0, 3.0, 4.0, 5.0, 6.0])
    mean = np.mean([mix.flight(np.full(6, 0.5), size, rng) for _ in range(3000)], axis=0)
    assert np.allclose(mean, 0.5, atol=0.05)


PROFILE = "source string, peso_objetivo double, max_repeticiones int"


def test_mix(spark):
    docs = [(k, "palabra " * (1 + k % 7), "grande") for k in range(900)] + [(10_000 + k, "una dos tres", "chica") for k in range(20)] + [(20_000, "x", None), (20_001, None, "grande"), (20_002, "y", "ajena")]
    df = spark.createDataFrame([(*d, 0, 0) for d in docs], "doc_id bigint, text string, source string, pi int, bloque int")
    profile = spark.createDataFrame([("grande", 0.6, 2), ("chica", 0.3, 3), ("vacía", 0.1, 2)], PROFILE)
    drawn, report = mix.draw_mix(df, profile, block=50)
    rep = {r.source: r for r in report.collect()}
    assert {s for s, r in rep.items() if not r.alcanza} == {"chica", "vacía"} == {r.source for r in mix.unreachable(df, profile).collect()}
    assert rep["grande"].tokens_mezcla == pytest.approx(rep["grande"].tokens_objetivo, rel=0.01)
    got = drawn.collect()
    assert len({r.doc_id for r in got}) == len(got) and all(r.copias <= (2 if r.source == "grande" else 3) for r in got)
    assert rep["chica"].tokens_mezcla == 3 * rep["chica"].tokens_propios and rep["vacía"].tokens_mezcla == 0
    assert sum(r.cuota_real for r in rep.values()) == pytest.approx(1)
    assert {r.source: r.tokens_mezcla for r in mix.draw_mix(df, profile, block=50)[1].collect()} == {s: r.tokens_mezcla for s, r in rep.items()}


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_shares_and_repetitions_of_the_tables(spark):
    docs, profile = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "perfil_fuentes"))
    drawn, report = mix.draw_mix(docs, profile)
    drawn, report = drawn.toPandas(), report.toPandas().set_index("source")
    assert drawn.doc_id.is_unique and (drawn.copias >= 1).all()
    for source, r in report.iterrows():
        own = drawn[drawn.source == source]
        assert (own.copias <= r.max_repeticiones).all() and (own.tokens * own.copias).sum() == r.tokens_mezcla
        assert abs(r.desvio) <= (own.tokens.max() if len(own) else 0), source
        # What cannot reach its share is used in full.
        assert r.alcanza or r.tokens_mezcla == r.max_repeticiones * r.tokens_propios
        # The number of records is kept as the number of tokens is.
        assert not r.tokens_propios or abs(r.registros_mezcla - r.documentos * r.veces) <= 2
    assert report.cuota_real.sum() == pytest.approx(1) and 0 < (~report.alcanza).sum() < len(report)


def test_mix_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string, source string")
    profile = spark.createDataFrame([("a", 1.0, 1)], PROFILE)
    drawn, report = mix.draw_mix(df, profile)
    assert drawn.count() == 0 and report.first().tokens_mezcla == 0
    assert mix.draw_mix(df, profile.limit(0))[1].count() == 0


def vectors(n=1500, d=16, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)).astype(np.float32)
    x[300:500] = x[:200] + rng.normal(scale=0.1, size=(200, d))
    x[500:560] = x[7]  # a hot group of copies
    x[560:563] = 3 * x[8]
    x[563] = 0
    return x


def frame(spark, x, extra=()):
    rows = [(k, v.tolist(), "z") for k, v in enumerate(x)]
    return spark.createDataFrame(rows + [(k, v, "z") for k, v in extra], "vec_id bigint, embedding array<float>, v string")


def pairs_of(x, least, k):
    n = np.linalg.norm(x, axis=1)
    ids = np.flatnonzero(n > 0)
    u = x[ids] / n[ids, None]
    s = np.round(u.astype(np.float64) @ u.T, 5)
    np.fill_diagonal(s, -2)
    out = set()
    for i, row in enumerate(s):
        for j in np.lexsort((ids, -row))[:k]:
            if row[j] >= least:
                out.add((min(ids[i], ids[j]), max(ids[i], ids[j])))
    return out


def test_similar_pairs_are_those_of_brute_force(spark):
    x = vectors()
    bad = [(2000, None), (2001, [1.0]), (2002, [float("nan")] * 16), (2003, [None] * 16), (0, x[0].tolist())]
    got = {tuple(r) for r in knn.similar_pairs(frame(spark, x, bad)).collect()}
    want = pairs_of(x, 0.9, 5)
    assert got <= want | {p for p in got if 500 <= max(p) < 563} and len(got & want) >= 0.99 * len(want)


def test_cells_keep_recall(spark, monkeypatch):
    # As with more vectors than partitions can hold: few partitions, each cut into cells.
    monkeypatch.setattr(knn, "PARTITIONS", 6)
    monkeypatch.setattr(knn, "CELL", 40)
    x = vectors()
    got = {tuple(r) for r in knn.similar_pairs(frame(spark, x)).collect()}
    want = pairs_of(x, 0.9, 5)
    assert len(got & want) >= 0.95 * len(want)
    u = x[np.linalg.norm(x, axis=1) > 0]
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    index = knn.fit(u, 6, cells=7)
    cells = knn.cells_of(u, index)
    assert len(index.fine) == 7 and len(set(cells.tolist())) > 20 and cells.max() < 42
    probed = knn.probed_cells(u, index, 4)
    assert probed.shape == (len(u), 14) and (probed == cells[:, None]).any(1).mean() > 0.95


def test_all_partitions_lose_nothing(spark):
    x = vectors(600, 12, 3)[:480]
    got = knn.top_neighbours(frame(spark, x), 5, 10).collect()
    u = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float64)
    s = u @ u.T
    np.fill_diagonal(s, -2)
    hit = [r.coseno >= np.sort(s[r.vec_id])[-5] - 1e-5 for r in got]
    assert len(got) == 48 * 5 and all(hit)


def test_knn_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert knn.similar_pairs(empty).count() == 0 and knn.top_neighbours(empty).count() == 0
    one = spark.createDataFrame([(100, [1.0, 2.0])], "vec_id bigint, embedding array<float>")
    assert knn.similar_pairs(one).count() == 0


def test_anisotropic_codes_have_less_parallel_error():
    x = vectors(1200, 64, 5)[:250]
    x = np.concatenate([x, vectors(1200, 64, 6)[600:]])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    index = knn.fit(x, 4)
    codes = knn._assign(x, index.codebook, index.eta)
    plain = knn._assign(x, index.codebook, 1.0, 0)
    par = lambda c: np.abs(((x - np.concatenate([index.codebook[m, c[:, m]] for m in range(c.shape[1])], 1)) * x).sum(1)).mean()
    assert par(codes) < par(plain)
    _, packed, p, q = knn.encode(x, index)
    scores = knn.scan(knn.tables(x[:3], index.codebook), packed)
    true = x @ x[:3].T
    bound = true * (1 - p[:, None]) - np.sqrt(1 - np.minimum(true**2, 1)) * q[:, None]
    assert (scores >= bound - 1e-4)[true >= 0].all()


def test_beta_tail():
    for k, m in itertools.product(range(1, 6), [5]):
        x = 0.3
        assert sum(comb(m, j) * x**j * (1 - x) ** (m - j) for j in range(k, m + 1)) == pytest.approx(1 - sum(comb(m, j) * x**j * (1 - x) ** (m - j) for j in range(k)))
