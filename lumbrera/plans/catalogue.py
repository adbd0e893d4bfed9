"""Registered queries over the driver's tables, each with the SQL that states the same result where SQL can."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumbrera.functions import text as tx
from lumbrera.functions.sentences import ABBREVIATIONS
from lumbrera.functions import vectors as vx
from lumbrera.functions.jsontext import flat_text
from lumbrera.operators import chunking, extraction, graph, ingest, metrics, search
from lumbrera.plans import pipelines
from lumbrera.session import shared_dir, table, written
from lumbrera.sources import files

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# --- SQL of the composites ---------------------------------------------------------------------------------------------------

_SPACES = "\\s\\x{000b}\\x{001c}-\\x{001f}\\x{0085}\\x{00a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"
_CLOSING = "[\"'”’»)\\]]*"


def _trimmed(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '^[{_SPACES}]+', ''), '[{_SPACES}]+$', '')"


def _words_of(c: str) -> str:
    return f"list_filter(regexp_split_to_array({c}, '[{_SPACES}]+'), lambda w: w <> '')"


def _sentences_sql(source: str, out: str, key: str, text: str, language: str) -> str:
    """CTEs that end in `out` (key, n, s): the sentences of `source`, each text cut after every end mark and joined again where the rules say that none ends."""
    quoted = lambda of: "[" + ", ".join(f"'{w}'" for w in sorted(of)) + "]"
    known = " ".join(f"WHEN '{lang}' THEN list_contains({quoted(words)}, rtrim(w, '.'))" for lang, words in ABBREVIATIONS.items() if lang != "es")
    marks = _CLOSING.replace("'", "''")
    return f"""{out}_p AS (SELECT {key}, {language} AS lang, unnest(p) AS p, generate_subscripts(p, 1) AS i FROM (SELECT {key}, {language}, string_split(regexp_replace({text}, '([.!?…]+{marks})([{_SPACES}])', '\\1' || chr(30) || '\\2', 'g'), chr(30)) AS p FROM {source} WHERE {text} IS NOT NULL)),
{out}_w AS (SELECT *, lower(regexp_extract(p, '([^{_SPACES}(«“"¿¡]*?)([.!?…]+){marks}$', 1)) AS w, regexp_extract(p, '([^{_SPACES}(«“"¿¡]*?)([.!?…]+){marks}$', 2) AS d, regexp_matches(regexp_extract(lead(p) OVER o, '^[{_SPACES}]*(.)', 1), '^[\\p{{Ll}}ªº]$') AS low FROM {out}_p WINDOW o AS (PARTITION BY {key} ORDER BY i)),
{out}_c AS (SELECT *, CASE WHEN d = '.' THEN low OR (CASE lang {known} ELSE list_contains({quoted(ABBREVIATIONS["es"])}, rtrim(w, '.')) END) OR regexp_full_match(w, '[\\p{{L}}\\p{{Nl}}\\p{{No}}]') OR regexp_full_match(w, '(?:\\p{{L}}{{1,2}}\\.)+\\p{{L}}{{1,2}}')
  WHEN regexp_full_match(d, '[.…]+') THEN low ELSE false END AS goes_on FROM {out}_w),
{out}_g AS (SELECT *, sum(CASE WHEN coalesce(prev, true) THEN 0 ELSE 1 END) OVER (PARTITION BY {key} ORDER BY i) AS g FROM (SELECT *, lag(goes_on) OVER (PARTITION BY {key} ORDER BY i) AS prev FROM {out}_c)),
{out} AS (SELECT {key}, row_number() OVER (PARTITION BY {key} ORDER BY g) AS n, s FROM (SELECT {key}, g, {_trimmed("string_agg(p, '' ORDER BY i)")} AS s FROM {out}_g GROUP BY {key}, g) WHERE s <> '')"""


_LIMIT, _BUDGET = int(chunking.MAX_TOKENS * tx.CHARS_PER_TOKEN * 0.5), chunking.MAX_TOKENS * tx.CHARS_PER_TOKEN
_CHUNKED = f"""RECURSIVE c AS (SELECT row_number() OVER () AS r, *, coalesce(formato IN ('csv', 'xlsx', 'pbf'), false) AS tabla FROM (SELECT DISTINCT * FROM corpus_limpio)), prosa AS (SELECT r, texto_completo AS t, coalesce(idioma, 'es') AS lang FROM c WHERE NOT tabla),
{_sentences_sql("prosa", "fr", "r", "t", "lang")},
filas AS (SELECT r, i AS n, s FROM (SELECT r, {_trimmed("unnest(p)")} AS s, generate_subscripts(p, 1) AS i FROM (SELECT r, string_split(texto_completo, chr(10) || chr(10)) AS p FROM c WHERE tabla)) WHERE s <> ''),
u AS (SELECT r, n, s FROM fr UNION ALL SELECT r, n, s FROM filas), lw AS (SELECT r, n, unnest(string_split(s, ' ')) AS w, generate_subscripts(string_split(s, ' '), 1) AS k FROM u WHERE length(s) > {_LIMIT}),
wr AS (SELECT r, n, k, w, 0 AS g, length(w) + 1 AS total FROM lw WHERE k = 1 UNION ALL SELECT lw.r, lw.n, lw.k, lw.w, CASE WHEN wr.total + length(lw.w) + 1 > {_LIMIT} THEN wr.g + 1 ELSE wr.g END, CASE WHEN wr.total + length(lw.w) + 1 > {_LIMIT} THEN length(lw.w) + 1 ELSE wr.total + length(lw.w) + 1 END FROM wr JOIN lw ON lw.r = wr.r AND lw.n = wr.n AND lw.k = wr.k + 1),
wp AS (SELECT r, n, g, string_agg(w, ' ' ORDER BY k) AS s FROM wr GROUP BY r, n, g), pz AS (SELECT r, n, 0 AS g, 0 AS h, s FROM u WHERE length(s) <= {_LIMIT} UNION ALL SELECT r, n, g, h, substr(s, (h * {_LIMIT} + 1)::BIGINT, {_LIMIT}) FROM (SELECT *, unnest(range(0, (length(s) + {_LIMIT - 1}) // {_LIMIT})) AS h FROM wp)),
pk AS (SELECT r, row_number() OVER (PARTITION BY r ORDER BY n, g, h) AS k, s, length(s) AS z FROM pz),
em AS (SELECT r, k, s, z, 0 AS g, z::DOUBLE AS total FROM pk WHERE k = 1 UNION ALL SELECT pk.r, pk.k, pk.s, pk.z, CASE WHEN em.total + pk.z > {_BUDGET} THEN em.g + 1 ELSE em.g END, CASE WHEN em.total + pk.z > {_BUDGET} THEN (CASE WHEN c.tabla THEN 0 ELSE em.z END) + pk.z ELSE em.total + pk.z END FROM em JOIN pk ON pk.r = em.r AND pk.k = em.k + 1 JOIN c ON c.r = em.r),
mi AS (SELECT r, g, k, s FROM em UNION ALL SELECT r, g + 1, k, s FROM (SELECT em.*, max(g) OVER (PARTITION BY r) AS last, max(k) OVER (PARTITION BY r, g) AS mk, c.tabla FROM em JOIN c USING (r)) WHERE k = mk AND g < last AND NOT tabla),
tr AS (SELECT r, g, CASE WHEN c.tabla THEN string_agg(s, chr(10) || chr(10) ORDER BY k) ELSE string_agg(s, ' ' ORDER BY k) END AS texto FROM mi JOIN c USING (r) GROUP BY r, g, c.tabla)"""

_FINDER = "[A-ZÀ-ÖØ-Þ][\\p{L}\\p{N}_''’-]+(?: (?:(?:de|del|do|da|of|the|la|los) )?[A-ZÀ-ÖØ-Þ][\\p{L}\\p{N}_''’-]+)*"
_TRIPLES = f"""ch AS (SELECT row_number() OVER (ORDER BY doc_id, posicion, chunk_id) - 1 AS ord, * FROM (SELECT DISTINCT * FROM chunks WHERE texto IS NOT NULL)), cl AS (SELECT ord, texto, coalesce(idioma, 'es') AS lang FROM ch),
{_sentences_sql("cl", "gs", "ord", "texto", "lang")},
ge AS (SELECT ord, n AS sn, regexp_extract_all(s, '{_FINDER}') AS e, regexp_split_to_array(s, '{_FINDER}') AS b FROM gs),
gp AS (SELECT ord, sn, i AS en, e[i] AS a, e[i + 1] AS z, {_words_of("trim(b[i + 1], ' ,.;:()-' || chr(10) || chr(34) || chr(39))")} AS w FROM (SELECT *, unnest(range(1, len(e))) AS i FROM ge WHERE len(e) >= 2)),
tri AS (SELECT ord, sn, en, lower(a) AS src, lower(z) AS dst, CASE WHEN len(w) BETWEEN 1 AND {graph.RELATION_WORDS} THEN lower(array_to_string(w, ' ')) ELSE '{graph.GENERIC_RELATION}' END AS relacion, a, z FROM gp WHERE lower(a) <> lower(z)),
edges AS (SELECT src, dst, relacion, doc_id, chunk_id, fenomeno FROM tri JOIN ch USING (ord))"""


def _passages_sql(source: str, key: str, text: str, language: str) -> str:
    """CTEs that end in pas (key, n, text): the passages of `source`."""
    n = search.PASSAGE_WORDS
    return f"""{_sentences_sql(source, "ps", key, text, language)},
pw AS (SELECT {key}, n AS k, s, {_words_of("s")} AS w FROM ps), pq AS (SELECT {key}, k, s, w, len(w) AS z, len(w) > {n} AS largo FROM pw),
pg AS (SELECT {key}, k, s, w, largo, 0 AS g, z AS total FROM pq WHERE k = 1 UNION ALL SELECT q.{key}, q.k, q.s, q.w, q.largo, CASE WHEN q.largo OR p.largo OR p.total + q.z > {n} THEN p.g + 1 ELSE p.g END, CASE WHEN q.largo OR p.largo OR p.total + q.z > {n} THEN q.z ELSE p.total + q.z END FROM pg p JOIN pq q ON q.{key} = p.{key} AND q.k = p.k + 1),
pl AS (SELECT {key}, 0 AS g, 0 AS h, {text} AS text FROM {source} WHERE {text} IS NOT NULL AND len({_words_of(text)}) <= {n} UNION ALL SELECT {key}, g, 0, string_agg(s, ' ' ORDER BY k) FROM pg WHERE NOT largo AND {key} IN (SELECT {key} FROM {source} WHERE len({_words_of(text)}) > {n}) GROUP BY {key}, g
  UNION ALL SELECT {key}, g, h, array_to_string(w[h * {n} + 1 : h * {n} + {n}], ' ') FROM (SELECT *, unnest(range(0, (len(w) + {n - 1}) // {n})) AS h FROM pg WHERE largo)),
pas AS (SELECT {key}, row_number() OVER (PARTITION BY {key} ORDER BY g, h) AS n, text FROM pl)"""


# --- inputs shared by several queries ----------------------------------------------------------------------------------------


def _units(spark: SparkSession, d: str) -> DataFrame:
    """Usable vectors of vectores at unit length, one row a vec_id."""
    v = table(spark, d, "vectores").filter("embedding is not null").dropDuplicates(["vec_id"])
    return v.select("vec_id", "chunk_id", vx.unit(F.col("embedding")).alias("v")).filter("v is not null")


_UNITS = """units AS (SELECT vec_id, chunk_id, list_transform(e, lambda x: x / n) AS v FROM
  (SELECT vec_id, chunk_id, e, sqrt(list_dot_product(e, e)) AS n FROM (SELECT DISTINCT vec_id, chunk_id, embedding::DOUBLE[] AS e FROM vectores WHERE embedding IS NOT NULL)) WHERE n > 0)"""
_TOPK = """hits AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM
  (SELECT q.vec_id AS query_id, b.vec_id AS id, b.label AS doc_id, round(list_dot_product(q.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS score FROM embeddings q, embeddings b WHERE q.vec_id % 100 = 0) QUALIFY rank <= 30)"""


def _label_hits(spark: SparkSession, d: str) -> DataFrame:
    """The 30 nearest of embeddings for every query (ids divisible by 100), label being the document."""
    e = table(spark, d, "embeddings")
    hits = search.exact_topk(e.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector")), e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector")), 30)
    return hits.join(e.select(F.col("vec_id").alias("id"), F.col("label").alias("doc_id")), "id")


def _corpus(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "corpus_limpio").dropDuplicates()


def _chunks(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "chunks").dropDuplicates()


def _scores(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "puntajes").dropDuplicates()


def _ranking(scores: DataFrame, score: str) -> DataFrame:
    return search.ranked(scores.filter(F.col(score).isNotNull()), ["corrida_id", "query_id"], [F.desc(score), F.asc("chunk_id")], search.TOP_K).select("corrida_id", "query_id", "chunk_id", F.col(score).alias("score"), "rank")


_SCORES = "s AS (SELECT DISTINCT * FROM puntajes)"
_RANK = "SELECT corrida_id, query_id, chunk_id, {0} AS score, row_number() OVER (PARTITION BY corrida_id, query_id ORDER BY {0} DESC, chunk_id) AS rank FROM s WHERE {0} IS NOT NULL QUALIFY rank <= 30"
_FUSED = f"""{_SCORES}, a AS ({_RANK.format("coseno")}), b AS ({_RANK.format("evidencia_grafo")}),
f AS (SELECT coalesce(a.corrida_id, b.corrida_id) AS corrida_id, coalesce(a.query_id, b.query_id) AS query_id, coalesce(a.chunk_id, b.chunk_id) AS chunk_id, a.rank AS rank_a, b.rank AS rank_b,
  coalesce(1.0::DOUBLE / (60 + a.rank), 0) + coalesce(1.0::DOUBLE / (60 + b.rank), 0) AS score FROM a FULL JOIN b ON a.corrida_id = b.corrida_id AND a.query_id = b.query_id AND a.chunk_id = b.chunk_id),
fused AS (SELECT *, row_number() OVER (PARTITION BY corrida_id, query_id ORDER BY score DESC, rank_a NULLS LAST, chunk_id) AS rank FROM f)"""


def _fused(spark: SparkSession, d: str) -> DataFrame:
    s = _scores(spark, d)
    return search.reciprocal_rank_fusion(_ranking(s, "coseno"), _ranking(s, "evidencia_grafo"), ["corrida_id", "query_id"], "chunk_id")


# --- sources, projections, routing -------------------------------------------------------------------------------------------


@query("SELECT fenomeno, extension, count(*) AS archivos FROM (SELECT DISTINCT * FROM registro) WHERE fenomeno IS NOT NULL AND extension IS NOT NULL GROUP BY ALL")
def inventory_counts(spark: SparkSession, d: str) -> DataFrame:
    return ingest.extension_counts(table(spark, d, "registro").dropDuplicates())


@query("""SELECT path, printf('DOC-%04d', (row_number() OVER (ORDER BY path) - 1)::BIGINT) AS doc_id, replace(extension, '.', '') AS formato, replace(path, '\\', '/') AS fuente
FROM (SELECT path, min(extension) AS extension FROM registro GROUP BY path)""")
def registry_ids(spark: SparkSession, d: str) -> DataFrame:
    paths = table(spark, d, "registro").groupBy("path").agg(F.min("extension").alias("extension"), F.min("size_kb").alias("size_kb"), F.min("fenomeno").alias("fenomeno"))
    return ingest.registry(paths).select("path", "doc_id", "formato", "fuente")


@query("""SELECT doc_id, fuente, coalesce(try_cast(nullif(regexp_extract(fuente, '[Ff](\\d{1,9})_', 1), '') AS INT), 0) AS numero,
CASE WHEN starts_with(replace(fuente, '\\', '/'), 'data/raw/') THEN substr(replace(fuente, '\\', '/'), 10) ELSE replace(fuente, '\\', '/') END AS ruta FROM (SELECT DISTINCT doc_id, fuente FROM corpus_limpio)""")
def phenomenon_number(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "corpus_limpio").select("doc_id", "fuente").distinct()
    return docs.select("doc_id", "fuente", tx.phenomenon_number(F.col("fuente")).alias("numero"), tx.path_key(F.col("fuente")).alias("ruta"))


@query("""SELECT path, CASE lower(formato) WHEN 'html' THEN 'html' WHEN 'htm' THEN 'html' WHEN 'pdf' THEN 'pdf' WHEN 'csv' THEN 'tabular' WHEN 'xlsx' THEN 'tabular' WHEN 'png' THEN 'image' WHEN 'jpg' THEN 'image'
WHEN 'jpeg' THEN 'image' WHEN 'avif' THEN 'image' WHEN 'txt' THEN 'text' WHEN 'json' THEN 'json' WHEN 'pbf' THEN CASE WHEN contains(replace(path, '\\', '/'), '/tiles/') THEN 'tile' ELSE 'osm' END END AS extractor
FROM (SELECT DISTINCT path, formato FROM registro)""")
def format_dispatch(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "registro").select("path", "formato").distinct().select("path", ingest.extractor(F.col("formato"), F.col("path")).alias("extractor"))


_STATUS = """e AS (SELECT DISTINCT doc_id, fuente, formato, texto FROM extraidos),
st AS (SELECT *, CASE WHEN fuente IS NULL THEN 'invalid row' WHEN coalesce(lower(formato), '') NOT IN ('html','htm','pdf','csv','xlsx','png','jpg','jpeg','avif','txt','json','pbf') THEN 'no extractor for ' || coalesce(formato, 'null')
  WHEN NOT coalesce(regexp_matches(texto, '[^\\s\\x{00a0}]'), false) THEN 'empty text' END AS error FROM e)"""


def _status(spark: SparkSession, d: str) -> DataFrame:
    return ingest.extraction_status(table(spark, d, "extraidos").select("doc_id", F.col("fuente").alias("path"), "formato", "texto").distinct())


@query(f"WITH {_STATUS} SELECT coalesce(error, 'ok') AS estado, count(*) AS documentos FROM st GROUP BY ALL")
def extraction_outcome(spark: SparkSession, d: str) -> DataFrame:
    return _status(spark, d).groupBy(F.coalesce("error", F.lit("ok")).alias("estado")).agg(F.count("*").alias("documentos"))


@query(f"WITH {_STATUS} SELECT doc_id, path, formato FROM (SELECT DISTINCT doc_id, path, formato FROM registro) r WHERE doc_id IN (SELECT doc_id FROM st WHERE error IS NOT NULL)")
def rerun_failed(spark: SparkSession, d: str) -> DataFrame:
    failed = ingest.extracted_and_failed(_status(spark, d))[1]
    return ingest.to_run_again(table(spark, d, "registro").select("doc_id", "path", "formato").distinct(), failed)


_REG = "reg AS (SELECT doc_id, min(fuente) AS fuente, min(formato) AS formato FROM registro GROUP BY doc_id)"
_LANG = "lang AS (SELECT doc_id, min(idioma) AS idioma, min(texto_completo) AS texto FROM corpus_limpio GROUP BY doc_id)"
_OFF = "off AS (SELECT CASE WHEN starts_with(replace(fuente, '\\', '/'), 'data/raw/') THEN substr(replace(fuente, '\\', '/'), 10) ELSE replace(fuente, '\\', '/') END AS ruta, min('OF-' || doc_id) AS doc_oficial FROM reg WHERE formato <> 'json' GROUP BY 1)"
_CAND = """cand AS (SELECT reg.*, lang.idioma, lang.texto, coalesce(try_cast(nullif(regexp_extract(reg.fuente, '[Ff](\\d{1,9})_', 1), '') AS INT), 0) AS fenomeno,
  CASE WHEN starts_with(replace(reg.fuente, '\\', '/'), 'data/raw/') THEN substr(replace(reg.fuente, '\\', '/'), 10) ELSE replace(reg.fuente, '\\', '/') END AS ruta FROM reg JOIN lang USING (doc_id)
  WHERE reg.formato IS NOT NULL AND regexp_matches(lang.texto, '[^\\s\\x{00a0}]'))"""


def _assembled(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    reg = table(spark, d, "registro").groupBy("doc_id").agg(F.min("fuente").alias("fuente"), F.min("formato").alias("formato"))
    docs = table(spark, d, "corpus_limpio").groupBy("doc_id").agg(F.min("idioma").alias("idioma"), F.min("texto_completo").alias("texto"))
    official = reg.filter("formato <> 'json'").groupBy(tx.path_key(F.col("fuente")).alias("ruta")).agg(F.min(F.concat(F.lit("OF-"), "doc_id")).alias("doc_oficial"))
    return ingest.build_corpus(reg, docs, docs, official)


@query(f"WITH {_REG}, {_LANG}, {_OFF}, {_CAND} SELECT doc_oficial AS doc_id, fuente, formato, fenomeno, idioma, length(texto) AS largo FROM cand JOIN off USING (ruta) WHERE fenomeno BETWEEN 1 AND 3")
def corpus_filter(spark: SparkSession, d: str) -> DataFrame:
    return _assembled(spark, d)[0].select("doc_id", "fuente", "formato", "fenomeno", "idioma", F.length("texto_completo").alias("largo"))


@query(f"WITH {_REG}, {_LANG}, {_OFF}, {_CAND} SELECT doc_id, fuente FROM cand WHERE fenomeno BETWEEN 1 AND 3 AND ruta NOT IN (SELECT ruta FROM off)")
def excluded_documents(spark: SparkSession, d: str) -> DataFrame:
    return _assembled(spark, d)[1]


@query("""SELECT c_custkey, array_to_string(list_filter([CASE WHEN c_custkey IS NOT NULL THEN 'c_custkey: ' || c_custkey END, CASE WHEN trim(c_name) <> '' THEN 'c_name: ' || c_name END,
CASE WHEN c_nationkey IS NOT NULL THEN 'c_nationkey: ' || c_nationkey END, CASE WHEN trim(c_mktsegment) <> '' THEN 'c_mktsegment: ' || c_mktsegment END], lambda x: x IS NOT NULL), ', ') AS texto FROM customer""")
def tabular_rows(spark: SparkSession, d: str) -> DataFrame:
    names = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
    return table(spark, d, "customer").select("c_custkey", tx.row_text(names).alias("texto"))


@query("SELECT event_id, 'k: ' || json_extract_string(props, '$.k') AS texto FROM events")
def json_flatten(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", flat_text(F.col("props")).alias("texto"))


@query("SELECT query_id, regexp_replace(trim(text), '\\s+', ' ', 'g') AS text FROM consultas")
def query_bank(spark: SparkSession, d: str) -> DataFrame:
    """The bank as one text with a preamble and wrapped lines, parsed again."""
    q = table(spark, d, "consultas").agg(F.array_sort(F.collect_list(F.struct("query_id", "text"))).alias("q"))
    lines = F.transform("q", lambda x: F.concat(x["query_id"], F.lit("  "), F.regexp_replace(x["text"], " ", "\n")))
    return files.query_bank(q.select(F.concat(F.lit("Banco de consultas\n\n"), F.array_join(lines, "\n\n")).alias("value")))


def _folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/f-{uuid.uuid4().hex}"


@query("SELECT doc_id, idioma, texto_completo AS texto FROM (SELECT DISTINCT doc_id, idioma, texto_completo FROM corpus_limpio)")
def jsonl_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """JSON lines, gzipped, written and read again."""
    path = _folder(spark)
    docs = table(spark, d, "corpus_limpio").select("doc_id", "idioma", F.col("texto_completo").alias("texto")).distinct()
    docs.write.option("ignoreNullFields", "false").option("compression", "gzip").json(path)
    return files.read_jsonl(spark, path, "doc_id string, idioma string, texto string")


@query("SELECT DISTINCT doc_id, path, replace(formato, ' ', '') AS error FROM registro WHERE formato IS NOT NULL")
def csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """An error table as CSV, written and read again."""
    path = _folder(spark)
    files.write_csv(table(spark, d, "registro").filter("formato is not null").select("doc_id", "path", F.replace("formato", F.lit(" "), F.lit("")).alias("error")).distinct(), path)
    return files.read_csv(spark, path, files.ERRORS)


@query("SELECT vec_id, chunk_id, len(embedding) AS dimensiones, round(list_sum(embedding::DOUBLE[]), 4) AS suma FROM (SELECT DISTINCT vec_id, chunk_id, embedding FROM vectores WHERE embedding IS NOT NULL)")
def vector_index(spark: SparkSession, d: str) -> DataFrame:
    """The vectors as an index, written and read again."""
    path = _folder(spark)
    files.write_vectors(table(spark, d, "vectores").filter("embedding is not null").dropDuplicates(["vec_id"]).select("vec_id", "chunk_id", "embedding"), path)
    return files.read_vectors(spark, path).select("vec_id", "chunk_id", F.size("embedding").alias("dimensiones"), F.round(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x), 4).alias("suma"))


@query(f"WITH {_TRIPLES} SELECT * FROM edges")
def graphml_edges(spark: SparkSession, d: str) -> DataFrame:
    """The relations as GraphML, written and read again."""
    path = _folder(spark)
    nodes, edges = _graph(spark, d)
    files.write_graphml(written(nodes), written(edges), path)
    return files.read_graphml(spark, path)[1]


_MIXED = """m AS (SELECT doc_id, t, (ascii(substr(md5(doc_id), 1, 1)) + ascii(substr(md5(doc_id), 2, 1))) % 7 AS k FROM (SELECT doc_id, min(regexp_replace(texto, '[<>&"\\\\\\s]+', ' ', 'g')) AS t FROM extraidos WHERE texto IS NOT NULL GROUP BY doc_id))"""


def _mixed(spark: SparkSession, d: str) -> DataFrame:
    """Files (doc_id, path, formato, content) of seven kinds made of the texts: page, JSON, CSV, plain, a PDF that is a page, a broken JSON, an unknown format."""
    docs = table(spark, d, "extraidos").filter("texto is not null").groupBy("doc_id").agg(F.min(F.regexp_replace("texto", r'[<>&"\\\s]+', " ")).alias("t"))
    h = F.md5("doc_id")
    k = (F.ascii(F.substring(h, 1, 1)) + F.ascii(F.substring(h, 2, 1))) % 7
    page = F.concat(F.lit("<html><nav>menu</nav><p>"), "t", F.lit("</p><script>x</script></html>"))
    body = F.when(k.isin(0, 4), page).when(k == 1, F.concat(F.lit('{"text": "'), "t", F.lit('"}'))).when(k == 2, F.concat(F.lit('a,b\n1,"'), "t", F.lit('"\n'))).when(k == 5, F.concat(F.lit('{"text": "'), "t")).otherwise(F.col("t"))
    formato = F.element_at(F.array(*map(F.lit, ("html", "JSON", "csv", "txt", "pdf", "json", "zip"))), k + 1)
    return docs.select("doc_id", F.concat(F.lit("data/raw/"), "doc_id").alias("path"), formato.alias("formato"), F.encode(body, "UTF-8").alias("content"))


@query(f"""WITH {_MIXED}, b AS (SELECT *, regexp_matches(t, '[^{_SPACES}]') AS lleno, {_trimmed("t")} AS s FROM m)
SELECT doc_id, CASE WHEN NOT lleno AND k IN (0, 1, 3, 4) OR k IN (5, 6) THEN NULL WHEN k = 2 THEN 'a: 1' || CASE WHEN lleno THEN ', b: ' || t ELSE '' END ELSE s END AS texto,
CASE WHEN k = 6 THEN 'no extractor for zip' WHEN k = 5 THEN 'malformed' WHEN NOT lleno AND k IN (0, 1, 3, 4) THEN 'empty text' END AS error FROM b""")
def extraction_run(spark: SparkSession, d: str) -> DataFrame:
    """Mixed files through the extraction run: texts, and errors where there are none."""
    out = extraction.extract(_mixed(spark, d))
    return out.select("doc_id", "texto", F.when(F.col("error").rlike("delimiter|terminat"), "malformed").otherwise(F.col("error")).alias("error"))


@query("SELECT doc_id, path FROM (SELECT doc_id, path, row_number() OVER (ORDER BY md5('42:' || path), path) AS n FROM (SELECT DISTINCT doc_id, path FROM registro)) WHERE n <= 20")
def seeded_sample(spark: SparkSession, d: str) -> DataFrame:
    """Twenty rows of the registry by a seeded hash."""
    return ingest.seeded_sample(table(spark, d, "registro").select("doc_id", "path").distinct(), "path", 20)


# --- text --------------------------------------------------------------------------------------------------------------------

_MONTHS = "|".join(tx.MONTHS)


_STEPS = "t"
for _pattern, _new in (("[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]", "''"), ("(?i)\\b(?:página|pág|page)\\s+\\d+(?:\\s+(?:de|of)\\s+\\d+)?\\b", "''"), ("(?m)^\\s*\\d+\\s*$", "''"), ("https?://\\S+|www\\.\\S+", "''"), (f"(?i)\\b(?:{_MONTHS})\\s+\\d{{4}}\\b", "''"), ("[ \\t]+", "' '"), ("\\n{3,}", "chr(10) || chr(10)")):
    _STEPS = f"regexp_replace({_STEPS}, '{_pattern}', {_new}, 'g')"


@query(f"""WITH t AS (SELECT doc_id, nfc_normalize(texto) AS t FROM (SELECT DISTINCT doc_id, 'Página 4 de 30' || chr(10) || '  17  ' || chr(10) || texto_completo || chr(10) || 'enero 2018 https://orbita.example/a' AS texto FROM corpus_limpio WHERE texto_completo IS NOT NULL))
SELECT doc_id, {_trimmed(_STEPS)} AS texto FROM t""")
def clean_text(spark: SparkSession, d: str) -> DataFrame:
    """Cleaning of every text with a page mark, a lone number, a month stamp and a link added."""
    docs = table(spark, d, "corpus_limpio").filter("texto_completo is not null").select("doc_id", F.concat(F.lit("Página 4 de 30\n  17  \n"), "texto_completo", F.lit("\nenero 2018 https://orbita.example/a")).alias("t")).distinct()
    return docs.select("doc_id", tx.clean_text(F.col("t")).alias("texto"))


_STRIPPED = "regexp_replace(regexp_replace(text, '^[\\s\\x{0085}\\x{00a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+', ''), '[\\s\\x{0085}\\x{00a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+$', '')"
_WS = "[\\s\\x{000b}\\x{0085}\\x{00a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+"


@query(f"SELECT doc_id, unnest(list_filter(string_split(regexp_replace(regexp_replace(regexp_replace(text, '^{_WS}', ''), '{_WS}$', ''), '([.!?]){_WS}', '\\1' || chr(30), 'g'), chr(30)), lambda s: s <> '')) AS oracion FROM documents WHERE text IS NOT NULL")
def regex_sentences(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.explode(tx.regex_sentences(F.col("text"))).alias("oracion"))


@query(f"SELECT doc_id, coalesce(len(list_filter(regexp_split_to_array(text, '{_WS}'), lambda w: w <> '')), 0)::INT AS palabras, coalesce(ceil(length(text) / 3.7::DOUBLE)::INT, 0) AS tokens FROM documents")
def word_count(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", tx.word_count(F.col("text")).alias("palabras"), tx.token_estimate(F.col("text")).alias("tokens"))


@query("SELECT doc_id, posicion, printf('%s-chunk-%03d', doc_id, posicion) AS chunk_id FROM (SELECT DISTINCT doc_id, posicion FROM chunks)")
def chunk_ids(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "chunks").select("doc_id", "posicion").distinct().select("doc_id", "posicion", tx.chunk_id(F.col("doc_id"), F.col("posicion")).alias("chunk_id"))


@query("SELECT idioma, CASE lower(idioma) WHEN 'en' THEN 'en' WHEN 'english' THEN 'en' WHEN 'pt' THEN 'pt' WHEN 'portuguese' THEN 'pt' ELSE 'es' END AS codigo, count(*) AS n FROM (SELECT DISTINCT * FROM corpus_limpio) GROUP BY ALL")
def lang_normalise(spark: SparkSession, d: str) -> DataFrame:
    return _corpus(spark, d).groupBy("idioma", tx.supported_language(F.col("idioma")).alias("codigo")).agg(F.count("*").alias("n"))


_CLEANED = f"""WITH t AS (SELECT doc_id, nfc_normalize(texto) AS t FROM (SELECT DISTINCT doc_id, texto FROM extraidos)),
c AS (SELECT doc_id, {_trimmed(_STEPS)} AS texto FROM t), w AS (SELECT *, regexp_split_to_array(lower(substr(texto, 1, 1000)), '[^\\p{{L}}]+') AS w FROM c),
v AS (SELECT doc_id, texto, {", ".join(f"len(list_filter(w, lambda x: x IN ({', '.join(repr(x) for x in words)}))) AS {lang}" for lang, words in tx.VOTE_WORDS.items())} FROM w)
SELECT doc_id, texto, CASE WHEN texto IS NULL OR length(texto) < 20 THEN 'es' WHEN es >= en AND es >= pt THEN 'es' WHEN en >= pt THEN 'en' ELSE 'pt' END AS idioma FROM v"""


@query(_CLEANED)
def clean_and_detect(spark: SparkSession, d: str) -> DataFrame:
    return pipelines.clean_all(table(spark, d, "extraidos").select("doc_id", "texto").distinct())


@query(f"WITH {_CHUNKED} SELECT doc_id, printf('%s-chunk-%03d', doc_id, g::BIGINT) AS chunk_id, fuente, formato, fenomeno, g::INT AS posicion, ceil(length(texto) / 3.7::DOUBLE)::INT AS num_tokens, texto, coalesce(idioma, 'es') AS idioma FROM tr JOIN c USING (r)")
def chunk_corpus(spark: SparkSession, d: str) -> DataFrame:
    return chunking.chunk_corpus(_corpus(spark, d))


# --- vectors and search ------------------------------------------------------------------------------------------------------


@query(f"""WITH {_UNITS} SELECT query_id, id, score, rank FROM (SELECT query_id, id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id)::INT AS rank FROM
(SELECT q.vec_id AS query_id, b.vec_id AS id, round(list_dot_product(q.v, b.v), 6) AS score FROM units q, units b WHERE q.vec_id % 100 = 0)) WHERE rank <= 10""")
def vector_topk(spark: SparkSession, d: str) -> DataFrame:
    """The 10 nearest chunks of every vector whose id is divisible by 100, exactly."""
    u = written(_units(spark, d))
    return search.exact_topk(u.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("v").alias("vector")), u.select(F.col("vec_id").alias("id"), F.col("v").alias("vector")), 10)


@query(f"WITH {_TOPK} SELECT query_id, doc_id, score, rank FROM (SELECT query_id, doc_id, s AS score, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, f)::INT AS rank FROM (SELECT query_id, doc_id, max(score) AS s, min(rank) AS f FROM hits GROUP BY ALL)) WHERE rank <= 3")
def doc_maxpool(spark: SparkSession, d: str) -> DataFrame:
    return search.pooled_documents(_label_hits(spark, d))


@query(f"WITH {_TOPK} SELECT query_id, doc_id, score, rank FROM (SELECT query_id, doc_id, s AS score, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, f)::INT AS rank FROM (SELECT query_id, doc_id, greatest(max(score) - 0.5, 0) AS s, min(rank) AS f FROM hits GROUP BY ALL)) WHERE rank <= 3")
def doc_maxpool_clamped(spark: SparkSession, d: str) -> DataFrame:
    """Scores lowered by 0.5, so that the floor of 0 shows."""
    return search.pooled_documents(_label_hits(spark, d).withColumn("score", F.col("score") - 0.5), floor=0.0)


@query("SELECT vec_id, round(sqrt(list_dot_product(e, e)), 6) AS norma FROM (SELECT DISTINCT vec_id, embedding::DOUBLE[] AS e FROM vectores WHERE embedding IS NOT NULL)")
def l2_norms(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "vectores").filter("embedding is not null").dropDuplicates(["vec_id"]).select("vec_id", F.round(vx.norm(F.col("embedding")), 6).alias("norma"))


_MEANS = "m AS (SELECT label, p, avg(x) AS x FROM (SELECT label, unnest(embedding::DOUBLE[]) AS x, generate_subscripts(embedding, 1) AS p FROM embeddings) GROUP BY ALL)"


@query(f"WITH {_MEANS} SELECT label, p::INT AS posicion, round(x, 6) AS media FROM m")
def mean_pooling(spark: SparkSession, d: str) -> DataFrame:
    pooled = vx.mean_pool(table(spark, d, "embeddings"), "label", "embedding")
    return pooled.select("label", F.posexplode("embedding").alias("p", "x")).select("label", (F.col("p") + 1).alias("posicion"), F.round("x", 6).alias("media"))


@query(f"WITH {_MEANS}, v AS (SELECT label, list(x ORDER BY p) AS v FROM m GROUP BY label) SELECT a.label AS a, b.label AS b, round(list_dot_product(a.v, b.v), 6) AS score FROM v a, v b")
def similarity_matrix(spark: SparkSession, d: str) -> DataFrame:
    """All pairs of the labels' mean vectors, ten by ten."""
    return search.similarity_matrix(vx.mean_pool(table(spark, d, "embeddings"), "label", "embedding"), "label", "embedding").withColumn("score", F.round("score", 6))


@query(f"""WITH {_MEANS}, v AS (SELECT label, list(x ORDER BY p) AS v FROM m GROUP BY label)
SELECT query_id, id, score, rank FROM (SELECT query_id, id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id)::INT AS rank FROM (SELECT v.label AS query_id, e.vec_id AS id, round(list_dot_product(v.v, e.embedding::DOUBLE[]), 6) AS score FROM v, embeddings e)) WHERE rank <= 10""")
def hyde_search(spark: SparkSession, d: str) -> DataFrame:
    """Search by a substitute: the mean vector of each label in place of a query's own."""
    e = table(spark, d, "embeddings")
    q = vx.mean_pool(e, "label", "embedding").select(F.col("label").alias("query_id"), F.col("embedding").alias("vector"))
    return search.exact_topk(q, e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector")), 10)


@query(f"WITH {_UNITS}, o AS (SELECT DISTINCT fuente, posicion, texto FROM (SELECT DISTINCT doc_id, chunk_id, fuente, posicion, texto FROM chunks) JOIN units USING (chunk_id)) SELECT count(*) FILTER (o.fuente IS NOT NULL) AS reutilizados, count(*) FILTER (o.fuente IS NULL) AS sin_vector FROM (SELECT DISTINCT chunk_id, fuente, posicion, texto FROM chunks) c LEFT JOIN o ON c.fuente = o.fuente AND c.posicion = o.posicion")
def reuse_vectors(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "chunks").select("chunk_id", "fuente", "posicion", "texto").distinct()
    old = c.join(_units(spark, d).select("chunk_id", "vec_id", F.col("v").alias("embedding")), "chunk_id").drop("chunk_id")
    reused, rest = ingest.reuse_vectors(c, old)
    both = reused.select(F.lit(1).alias("r"), F.size("embedding").alias("n")).unionByName(rest.select(F.lit(0).alias("r"), F.lit(0).alias("n")))
    return both.agg(F.count_if((F.col("r") == 1) & (F.col("n") > 0)).alias("reutilizados"), F.count_if(F.col("r") == 0).alias("sin_vector"))


@query(f"WITH {_FUSED} SELECT corrida_id, query_id, chunk_id, rank_a::INT AS rank_a, rank_b::INT AS rank_b, round(score, 9) AS score, rank::INT AS rank FROM fused")
def rrf_fusion(spark: SparkSession, d: str) -> DataFrame:
    return _fused(spark, d).withColumn("score", F.round("score", 9))


@query(f"WITH {_FUSED}, c AS (SELECT DISTINCT chunk_id, doc_id FROM chunks) SELECT corrida_id, query_id, doc_id, round(s, 9) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY corrida_id, query_id ORDER BY s DESC, f)::INT AS rank FROM (SELECT corrida_id, query_id, doc_id, max(score) AS s, min(rank) AS f FROM fused JOIN c USING (chunk_id) GROUP BY ALL)) WHERE rank <= 3")
def fused_documents(spark: SparkSession, d: str) -> DataFrame:
    hits = _fused(spark, d).join(table(spark, d, "chunks").select("chunk_id", "doc_id").distinct(), "chunk_id")
    return search.pooled_documents(hits, ["corrida_id", "query_id"]).withColumn("score", F.round("score", 9))


@query(f"""WITH RECURSIVE {_FUSED}, hit AS (SELECT row_number() OVER () AS r, corrida_id, query_id, chunk_id, doc_id, rank, texto, coalesce(idioma, 'es') AS lang FROM fused JOIN (SELECT DISTINCT * FROM chunks) USING (chunk_id) WHERE rank <= 10),
{_passages_sql("hit", "r", "texto", "lang")} SELECT corrida_id, query_id, chunk_id, doc_id, text, rank FROM (SELECT corrida_id, query_id, chunk_id, doc_id, text, row_number() OVER (PARTITION BY corrida_id, query_id ORDER BY rank, n)::INT AS rank FROM hit JOIN pas USING (r)) WHERE rank <= 10""")
def passages_top10(spark: SparkSession, d: str) -> DataFrame:
    """The first ten passages of every query and run, by the fused ranking."""
    hits = _fused(spark, d).join(_chunks(spark, d).select("chunk_id", "doc_id", "texto", "idioma"), "chunk_id")
    return search.first_passages(hits, ["corrida_id", "query_id"])


_LEX = """w AS (SELECT id, unnest(list_filter(regexp_split_to_array(lower(t), '[^\\p{L}\\p{N}]+'), lambda x: length(x) > 1)) AS w FROM (SELECT DISTINCT chunk_id AS id, texto AS t FROM chunks WHERE texto IS NOT NULL)),
tf AS (SELECT id, w, count(*) AS tf FROM w GROUP BY ALL), n AS (SELECT count(*) AS n FROM (SELECT DISTINCT chunk_id, texto FROM chunks WHERE texto IS NOT NULL)),
df AS (SELECT w, ln(any_value(n)::DOUBLE / count(*)) AS idf FROM tf, n GROUP BY w), x AS (SELECT id, w, tf * idf AS x FROM tf JOIN df USING (w)), nx AS (SELECT id, sqrt(sum(x * x)) AS n FROM x GROUP BY id),
qw AS (SELECT query_id, unnest(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: length(x) > 1)) AS w FROM consultas), y AS (SELECT query_id, w, count(*) * any_value(idf) AS y FROM qw JOIN df USING (w) GROUP BY ALL), ny AS (SELECT query_id, sqrt(sum(y * y)) AS n FROM y GROUP BY query_id),
sc AS (SELECT query_id, id, round(coalesce(sum(x * y) / nullif(any_value(nx.n) * any_value(ny.n), 0), 0), 6) AS score FROM x JOIN y USING (w) JOIN nx USING (id) JOIN ny USING (query_id) GROUP BY ALL)"""


def _lexical(spark: SparkSession, d: str, k: int) -> DataFrame:
    c = table(spark, d, "chunks").filter("texto is not null").select(F.col("chunk_id").alias("id"), F.col("texto").alias("text")).distinct()
    return search.lexical_scores(table(spark, d, "consultas"), c, k)


@query(f"WITH {_LEX} SELECT query_id, id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id)::INT AS rank FROM sc) WHERE rank <= 30")
def lexical_retrieval(spark: SparkSession, d: str) -> DataFrame:
    return _lexical(spark, d, search.TOP_K)


# --- graph -------------------------------------------------------------------------------------------------------------------


def _numbered(spark: SparkSession, d: str) -> DataFrame:
    return ingest.row_numbers(_chunks(spark, d).filter("texto is not null"), ["doc_id", "posicion", "chunk_id"])


@query("SELECT ord, chunk_id FROM (SELECT row_number() OVER (ORDER BY doc_id, posicion, chunk_id) - 1 AS ord, chunk_id FROM (SELECT DISTINCT * FROM chunks WHERE texto IS NOT NULL)) WHERE ord % 32 = 0 AND ord < 32 * 6000")
def stride_sample(spark: SparkSession, d: str) -> DataFrame:
    return graph.stride_sample(_numbered(spark, d)).select("ord", "chunk_id")


def _graph(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return graph.build_graph(_numbered(spark, d), stride=None)


@query(f"WITH {_TRIPLES} SELECT src, dst, count(*) AS n, count(DISTINCT chunk_id) AS chunks FROM edges GROUP BY ALL")
def graph_edges(spark: SparkSession, d: str) -> DataFrame:
    return _graph(spark, d)[1].groupBy("src", "dst").agg(F.count("*").alias("n"), F.countDistinct("chunk_id").alias("chunks"))


@query(f"WITH {_TRIPLES} SELECT id, count(*) AS grado FROM (SELECT unnest([src, dst]) AS id FROM edges) GROUP BY id")
def entity_degree(spark: SparkSession, d: str) -> DataFrame:
    return graph.degree(_graph(spark, d)[1])


@query(f"""WITH {_TRIPLES}, seeds AS (SELECT * FROM (SELECT query_id, lower(unnest(regexp_extract_all(text, '{_FINDER}'))) AS id FROM consultas) WHERE length(id) > 1 AND id NOT IN ({", ".join(f"'{w}'" for w in graph.GENERIC)})), r AS (SELECT * FROM seeds
  UNION SELECT query_id, dst FROM seeds JOIN edges ON id = src UNION SELECT query_id, src FROM seeds JOIN edges ON id = dst)
SELECT query_id, chunk_id, count(*) AS conteo FROM r JOIN (SELECT src AS id, chunk_id FROM edges UNION ALL SELECT dst, chunk_id FROM edges) USING (id) GROUP BY ALL""")
def graph_evidence(spark: SparkSession, d: str) -> DataFrame:
    """Edges at the entities of each query and their neighbours, by chunk."""
    return graph.evidence(graph.query_entities(table(spark, d, "consultas")), written(_graph(spark, d)[1]))


@query(f"""WITH {_TRIPLES}, ends AS (SELECT src AS id, a AS label, [ord, sn, en, 0] AS pos FROM tri UNION ALL SELECT dst, z, [ord, sn, en, 1] FROM tri)
SELECT id, label, CASE WHEN upper(label) = label AND lower(label) <> label THEN 'ORG' ELSE 'MISC' END AS tipo FROM (SELECT id, arg_min(label, pos) AS label FROM ends GROUP BY id)""")
def graph_nodes(spark: SparkSession, d: str) -> DataFrame:
    return _graph(spark, d)[0]


@query(f"WITH {_TRIPLES} SELECT * FROM edges")
def graph_relations(spark: SparkSession, d: str) -> DataFrame:
    return _graph(spark, d)[1]


def _pool(spark: SparkSession, d: str) -> DataFrame:
    return written(_lexical(spark, d, search.POOL_K).withColumnRenamed("id", "chunk_id"))


_HITS = f"""RECURSIVE {_LEX}, pool AS (SELECT query_id, id AS chunk_id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id)::INT AS rank FROM sc) WHERE rank <= {search.POOL_K}), base AS (SELECT * FROM pool WHERE rank <= {search.TOP_K}), {_TRIPLES},
seeds AS (SELECT DISTINCT query_id, lower(e) AS id FROM (SELECT query_id, unnest(regexp_extract_all(text, '{_FINDER}')) AS e FROM consultas) WHERE length(e) > 1 AND lower(e) NOT IN ({", ".join(f"'{w}'" for w in graph.GENERIC)})),
near AS (SELECT * FROM seeds UNION SELECT query_id, dst FROM seeds JOIN edges ON id = src UNION SELECT query_id, src FROM seeds JOIN edges ON id = dst),
counts AS (SELECT query_id, chunk_id, count(*) AS conteo FROM near JOIN (SELECT src AS id, chunk_id FROM edges UNION ALL SELECT dst, chunk_id FROM edges) USING (id) JOIN (SELECT DISTINCT query_id, chunk_id FROM pool) USING (query_id, chunk_id) GROUP BY ALL),
byg AS (SELECT query_id, chunk_id, rank FROM (SELECT query_id, chunk_id, row_number() OVER (PARTITION BY query_id ORDER BY conteo DESC, p.rank NULLS LAST, chunk_id) AS rank FROM counts LEFT JOIN pool p USING (query_id, chunk_id)) WHERE rank <= {graph.TOP_CANDIDATES}),
ff AS (SELECT coalesce(a.query_id, b.query_id) AS query_id, coalesce(a.chunk_id, b.chunk_id) AS chunk_id, a.rank AS ra, coalesce(1.0::DOUBLE / (60 + a.rank), 0) + coalesce(1.0::DOUBLE / (60 + b.rank), 0) AS score FROM base a FULL JOIN byg b ON a.query_id = b.query_id AND a.chunk_id = b.chunk_id),
fz AS (SELECT query_id, chunk_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, ra NULLS LAST, chunk_id) AS rank FROM ff WHERE query_id IN (SELECT query_id FROM counts) UNION ALL SELECT query_id, chunk_id, score, rank FROM base WHERE query_id NOT IN (SELECT query_id FROM counts)),
dc AS (SELECT chunk_id, doc_id, texto, coalesce(idioma, 'es') AS lang FROM (SELECT DISTINCT * FROM chunks))"""


def _documents_sql(hits: str, out: str) -> str:
    return f"{out} AS (SELECT query_id, doc_id, rank FROM (SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, f) AS rank FROM (SELECT query_id, doc_id, max(score) AS s, min(rank) AS f FROM {hits} JOIN dc USING (chunk_id) GROUP BY ALL)) WHERE rank <= {search.TOP_DOCS})"


@query(f"""WITH {_HITS}, {_documents_sql("fz", "docs")}, hit AS (SELECT row_number() OVER () AS r, * FROM fz JOIN dc USING (chunk_id) WHERE rank <= {search.TOP_PASSAGES}), {_passages_sql("hit", "r", "texto", "lang")},
frag AS (SELECT query_id, chunk_id, doc_id, text, row_number() OVER (PARTITION BY query_id ORDER BY rank, n) AS rank FROM hit JOIN pas USING (r))
SELECT query_id, 'documento' AS tipo, rank::INT AS rank, doc_id, NULL::VARCHAR AS chunk_id, NULL::VARCHAR AS text FROM docs UNION ALL SELECT query_id, 'fragmento', rank::INT, doc_id, chunk_id, text FROM frag WHERE rank <= {search.TOP_PASSAGES}""")
def answers(spark: SparkSession, d: str) -> DataFrame:
    """The query bank answered with the graph: documents and passages of each query, a row each."""
    _, docs, pieces = pipelines.answers(table(spark, d, "consultas"), _pool(spark, d), _chunks(spark, d), written(_graph(spark, d)[1]))
    null = F.lit(None).cast("string")
    out = docs.select("query_id", F.lit("documento").alias("tipo"), "rank", "doc_id", null.alias("chunk_id"), null.alias("text"))
    return out.unionByName(pieces.select("query_id", F.lit("fragmento").alias("tipo"), "rank", "doc_id", "chunk_id", "text"))


_LISTED = "(SELECT query_id, string_agg(doc_id, ',' ORDER BY rank) AS docs FROM {0} GROUP BY query_id)"


@query(f"""WITH {_HITS}, {_documents_sql("fz", "con")}, {_documents_sql("base", "sin")} SELECT coalesce(a.query_id, b.query_id) AS query_id, a.docs AS con_grafo, b.docs AS sin_grafo, a.docs IS DISTINCT FROM b.docs AS cambia FROM {_LISTED.format("con")} a FULL JOIN {_LISTED.format("sin")} b ON a.query_id = b.query_id""")
def ablation_changed(spark: SparkSession, d: str) -> DataFrame:
    out = pipelines.ablation(table(spark, d, "consultas"), _pool(spark, d), _chunks(spark, d), written(_graph(spark, d)[1]))
    return out.select("query_id", F.array_join("con_grafo", ",").alias("con_grafo"), F.array_join("sin_grafo", ",").alias("sin_grafo"), "cambia")


# --- evaluation --------------------------------------------------------------------------------------------------------------

_JUDGED = f"""{_SCORES}, j AS (SELECT corrida_id, query_id, chunk_id, rank, least(3, floor(coalesce(bm25, 0) / 10))::INT AS rel FROM (SELECT *, row_number() OVER (PARTITION BY corrida_id, query_id ORDER BY coseno DESC NULLS LAST, chunk_id) AS rank FROM s) WHERE rank <= 10),
nd AS (SELECT corrida_id, query_id, coalesce(sum(rel / log2(rank + 1)) / nullif(sum(rel / log2(i + 1)), 0), 0) AS ndcg FROM (SELECT *, row_number() OVER (PARTITION BY corrida_id, query_id ORDER BY rel DESC, rank) AS i FROM j) GROUP BY ALL)"""


def _judged(spark: SparkSession, d: str) -> DataFrame:
    """Rankings by coseno, bm25 standing in for graded judgements."""
    top = search.ranked(_scores(spark, d), ["corrida_id", "query_id"], [F.desc_nulls_last("coseno"), F.asc("chunk_id")], 10)
    return top.select("corrida_id", "query_id", "chunk_id", "rank", F.least(F.lit(3), F.floor(F.coalesce("bm25", F.lit(0.0)) / 10)).cast("int").alias("rel"))


def _ndcg(spark: SparkSession, d: str) -> DataFrame:
    return metrics.ndcg(_judged(spark, d), 10, ["corrida_id", "query_id"])


@query(f"WITH {_JUDGED} SELECT corrida_id, query_id, round(ndcg, 6) AS ndcg FROM nd")
def ndcg_at_10(spark: SparkSession, d: str) -> DataFrame:
    return _ndcg(spark, d).withColumn("ndcg", F.round("ndcg", 6))


@query(f"""WITH {_JUDGED}, rel AS (SELECT DISTINCT corrida_id, query_id, chunk_id FROM j WHERE rel >= 2), n AS (SELECT corrida_id, query_id, count(*) AS n FROM rel GROUP BY ALL),
h AS (SELECT corrida_id, query_id, count(*) AS h FROM j JOIN rel USING (corrida_id, query_id, chunk_id) WHERE rank <= 3 GROUP BY ALL)
SELECT corrida_id, query_id, round(coalesce(2 * p * r / nullif(p + r, 0), 0), 6) AS f1 FROM (SELECT corrida_id, query_id, coalesce(h, 0) / 3 AS p, coalesce(h, 0) / least(3, n) AS r FROM n LEFT JOIN h USING (corrida_id, query_id))""")
def f1_at_3(spark: SparkSession, d: str) -> DataFrame:
    j = _judged(spark, d)
    return metrics.f1_at(j, j.filter("rel >= 2"), 3, ["corrida_id", "query_id"], "chunk_id").withColumn("f1", F.round("f1", 6))


@query(f"WITH {_JUDGED} SELECT corrida_id, round(avg(ndcg), 6) AS ndcg, count(*) AS consultas FROM nd GROUP BY ALL")
def eval_summary(spark: SparkSession, d: str) -> DataFrame:
    return _ndcg(spark, d).groupBy("corrida_id").agg(F.round(F.avg("ndcg"), 6).alias("ndcg"), F.count("*").alias("consultas"))


@query(f"WITH {_JUDGED} SELECT corrida_id, query_id, ndcg FROM (SELECT corrida_id, query_id, round(ndcg, 6) AS ndcg, corrida_id || query_id AS k FROM nd ORDER BY 3, 4 LIMIT 6)")
def worst_queries(spark: SparkSession, d: str) -> DataFrame:
    table_ = _ndcg(spark, d).withColumn("ndcg", F.round("ndcg", 6)).withColumn("k", F.concat("corrida_id", "query_id"))
    return metrics.worst(table_, "ndcg", 6, "k").drop("k")


@query(f"WITH {_JUDGED} SELECT least(floor(round(ndcg, 6) * 10)::INT + 1, 10) AS bin, count(*) AS n FROM nd GROUP BY ALL")
def metric_histogram(spark: SparkSession, d: str) -> DataFrame:
    return metrics.histogram(_ndcg(spark, d).withColumn("ndcg", F.round("ndcg", 6)), "ndcg", 0.0, 1.0)


@query("SELECT count(DISTINCT doc_id) AS documentos, count(DISTINCT chunk_id) AS chunks, count(DISTINCT fuente) AS fuentes FROM chunks")
def corpus_counters(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "chunks").agg(F.countDistinct("doc_id").alias("documentos"), F.countDistinct("chunk_id").alias("chunks"), F.countDistinct("fuente").alias("fuentes"))
