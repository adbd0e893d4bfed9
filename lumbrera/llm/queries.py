"""Registered queries of the llm operators over the driver's tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lumbrera.llm import bpe, knn, language, mix, pages, rank, scans, sentences, split, tokens
from lumbrera.session import table

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "p1_found": lambda s, d: rank.first_of_ranking(table(s, d, "puntajes")).select("corrida_id", "query_id", "chunk_id"),
        "p2_found": lambda s, d: pages.boilerplate_lines(table(s, d, "extraidos")),
        "p2_cuerpo": lambda s, d: pages.main_text(table(s, d, "extraidos")),
        "p3_found": lambda s, d: scans.noisy_lines(table(s, d, "extraidos")),
        "p3_parrafos": lambda s, d: scans.repaired_paragraphs(table(s, d, "extraidos")),
        "p4_found": lambda s, d: knn.similar_pairs(table(s, d, "vectores")),
        "p4_vecinos": lambda s, d: knn.top_neighbours(table(s, d, "vectores")),
        "p5_found": lambda s, d: language.mislabelled_paragraphs(table(s, d, "corpus_limpio")),
        "p5_tramos": lambda s, d: language.language_segments(table(s, d, "corpus_limpio")),
        "p6_found": lambda s, d: sentences.sentence_offsets(table(s, d, "corpus_limpio")),
        "p6_oraciones": lambda s, d: sentences.sentences(table(s, d, "corpus_limpio")),
        "p7_found": lambda s, d: tokens.doubtful_chunks(table(s, d, "chunks")),
        "p7_totales": lambda s, d: tokens.token_budget(table(s, d, "chunks")),
        "p8_ids": lambda s, d: bpe.encode(table(s, d, "documents"), "text", keep=("doc_id",)),
        "p9_found": lambda s, d: mix.unreachable(table(s, d, "documents"), table(s, d, "perfil_fuentes")),
        "p9_cuotas": lambda s, d: mix.draw_mix(table(s, d, "documents"), table(s, d, "perfil_fuentes"))[1],
        "p9_registros": lambda s, d: mix.draw_mix(table(s, d, "documents"), table(s, d, "perfil_fuentes"))[0],
        "p10_found": lambda s, d: split.oversized(table(s, d, "documents"), table(s, d, "perfil_fuentes")),
        "p10_piezas": lambda s, d: split.split_oversized(table(s, d, "documents"), table(s, d, "perfil_fuentes")),
    }


_RANKED = ", ".join(
    f"CASE WHEN {c} IS NULL THEN 1.0 ELSE (rank() OVER (PARTITION BY corrida_id, query_id ORDER BY {c} {o} NULLS LAST) + (count({c}) OVER (PARTITION BY corrida_id, query_id, {c}) - 1) / 2) / count(*) OVER (PARTITION BY corrida_id, query_id) END AS r{k}"
    for k, (c, o) in enumerate((("coseno", "DESC"), ("bm25", "DESC"), ("evidencia_grafo", "DESC"), ("reordenador", "DESC"), ("distancia", "ASC")))
)
_TAILS = ", ".join("(" + " + ".join(f"{(1, 5, 10, 10, 5, 1)[j]} * r[{k}] ** {j} * (1 - r[{k}]) ** {5 - j}" for j in range(k, 6)) + ")" for k in range(1, 6))


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": f"""WITH s AS (SELECT DISTINCT * FROM puntajes), a AS (SELECT corrida_id, query_id, chunk_id, {_RANKED} FROM s), b AS (SELECT corrida_id, query_id, chunk_id, list_sort([r0, r1, r2, r3, r4]::DOUBLE[]) AS r, (r0 + r1 + r2 + r3 + r4) / 5 AS m FROM a),
c AS (SELECT corrida_id, query_id, chunk_id, m, round(5 * least({_TAILS}), 9) AS p FROM b)
SELECT corrida_id, query_id, chunk_id FROM (SELECT *, row_number() OVER (PARTITION BY corrida_id, query_id ORDER BY p, round(m, 9), chunk_id) AS puesto FROM c) WHERE puesto <= 10""",
        "p4_found": """WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM (SELECT DISTINCT vec_id, embedding FROM vectores WHERE embedding IS NOT NULL)), u AS (SELECT vec_id, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS e FROM v WHERE list_dot_product(e, e) > 0),
n AS (SELECT a.vec_id AS a, b.vec_id AS b, list_dot_product(a.e, b.e) AS c FROM u a JOIN u b ON a.vec_id <> b.vec_id), t AS (SELECT a, b FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY round(c, 5) DESC, b) AS r FROM n) WHERE r <= 5 AND c >= 0.9)
SELECT DISTINCT least(a, b) AS vec_a, greatest(a, b) AS vec_b FROM t""",
    }
