"""Entity graph of chunks: triples of neighbouring entities, nodes, evidence of the graph for a query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumbrera import plugins
from lumbrera.functions.sentences import sentences
from lumbrera.functions.text import entity_key, strip

#: Nouns too general to anchor a query (fixed values).
GENERIC = (
    "estado gobierno país pais nación nacion región region área area comunidad población poblacion territorio gobiernos "
    "state government country nation community population territory "
    "governo nação nacao comunidade população populacao território"
).split()
GENERIC_RELATION, RELATION_WORDS = "se_menciona_junto_a", 6
STRIDE, SAMPLE_CAP = 32, 6000
TOP_CANDIDATES = 30


def stride_sample(chunks: DataFrame, ord: str = "ord", stride: int = STRIDE, cap: int | None = SAMPLE_CAP) -> DataFrame:
    """Every stride-th row by its number, at most `cap`: a sampling operator; both conditions are one predicate on the number."""
    c = F.col(ord)
    return chunks.filter((c % stride == 0) & ((c < stride * cap) if cap else F.lit(True)))


def with_entities(chunks: DataFrame, text: str = "texto", name: str = "default") -> DataFrame:
    return chunks.withColumn("entidades", plugins.apply("entities", "array<struct<texto:string,tipo:string,start:int,end:int>>", text, name=name))


def sentence_spans(chunks: DataFrame, text: str = "texto", language: str = "idioma") -> DataFrame:
    """chunks with tramos: ARRAY<STRUCT<inicio, fin>> of their sentences, each searched behind the one before."""
    fold = f"aggregate(_s, named_struct('c', 0, 'o', cast(array() as array<struct<inicio:int,fin:int>>)), (a, s) -> if(locate(s, {text}, a.c + 1) = 0, a, named_struct('c', locate(s, {text}, a.c + 1) - 1 + length(s), 'o', array_append(a.o, named_struct('inicio', locate(s, {text}, a.c + 1) - 1, 'fin', locate(s, {text}, a.c + 1) - 1 + length(s))))), a -> a.o)"
    return chunks.withColumn("_s", sentences(F.col(text), F.col(language))).withColumn("tramos", F.expr(fold)).drop("_s")


def relation_phrase(text: Column, a_end: Column, b_start: Column) -> Column:
    """Small-letter words between two entities, if one to six; the general relation otherwise."""
    between = F.btrim(F.substring(text, a_end + 1, F.greatest(b_start - a_end, F.lit(0))), F.lit(" ,.;:()-\n\"'"))
    words = F.filter(F.split(between, r"(?U)\s+"), lambda w: w != "")
    return F.when(F.size(words).between(1, RELATION_WORDS), F.lower(F.array_join(words, " "))).otherwise(GENERIC_RELATION)


def triples(chunks: DataFrame, ord: str = "ord") -> DataFrame:
    """Neighbouring entities of a sentence: src, dst, relacion with labels, types and keys of chunks (texto, idioma, entidades)."""
    rows = sentence_spans(chunks.filter(F.size("entidades") >= 2))
    # Entities and sentences of one chunk meet inside its row; there is no join over ranges.
    rows = rows.select(ord, "doc_id", "chunk_id", "fenomeno", "texto", F.posexplode("tramos").alias("_sn", "_t"), "entidades")
    inside = F.filter("entidades", lambda e: (e["start"] >= F.col("_t.inicio")) & (e["end"] <= F.col("_t.fin")))
    rows = rows.select(ord, "doc_id", "chunk_id", "fenomeno", "texto", "_sn", F.posexplode(F.array_sort(F.transform(inside, lambda e, i: F.struct(e["start"].alias("start"), i.alias("i"), e["end"].alias("end"), e["texto"].alias("texto"), e["tipo"].alias("tipo"))))).alias("_en", "e"))
    w = Window.partitionBy("chunk_id", "_sn").orderBy("_en")
    pairs = rows.withColumn("z", F.lead("e").over(w)).filter("z is not null")
    return pairs.select(ord, "doc_id", "chunk_id", "fenomeno", "_sn", "_en", entity_key(F.col("e.texto")).alias("src"), entity_key(F.col("z.texto")).alias("dst"), relation_phrase(F.col("texto"), F.col("e.end"), F.col("z.start")).alias("relacion"), F.col("e.texto").alias("src_label"), F.col("e.tipo").alias("src_tipo"), F.col("z.texto").alias("dst_label"), F.col("z.tipo").alias("dst_tipo"))


def edges_of(found: DataFrame) -> DataFrame:
    """Directed multigraph edges; blank and equal ends are left out."""
    return found.filter((F.col("src") != "") & (F.col("dst") != "") & (F.col("src") != F.col("dst"))).select("src", "dst", "relacion", "doc_id", "chunk_id", "fenomeno")


def nodes_of(found: DataFrame, ord: str = "ord") -> DataFrame:
    """(id, label, tipo): label and type as first seen."""
    found = found.filter((F.col("src") != "") & (F.col("dst") != "") & (F.col("src") != F.col("dst")))
    at = lambda side: F.struct(F.col(ord), F.col("_sn"), F.col("_en"), F.lit(side))
    ends = found.select(F.col("src").alias("id"), strip(F.col("src_label")).alias("label"), F.col("src_tipo").alias("tipo"), at(0).alias("_at"))
    ends = ends.unionByName(found.select(F.col("dst").alias("id"), strip(F.col("dst_label")).alias("label"), F.col("dst_tipo").alias("tipo"), at(1).alias("_at")))
    return ends.groupBy("id").agg(F.min_by(F.struct("label", "tipo"), "_at").alias("f")).select("id", "f.label", "f.tipo")


def build_graph(chunks: DataFrame, ord: str = "ord", stride: int | None = STRIDE, cap: int | None = SAMPLE_CAP, name: str = "default") -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of chunks, by default of a stride sample of them."""
    rows = stride_sample(chunks, ord, stride, cap) if stride else chunks
    found = triples(with_entities(rows, name=name), ord)
    return nodes_of(found, ord), edges_of(found)


def query_entities(queries: DataFrame, name: str = "default") -> DataFrame:
    """(query_id, id): keys of a query's entities of two or more characters that are not generic."""
    found = queries.withColumn("_e", plugins.apply("entities", "array<struct<texto:string,tipo:string,start:int,end:int>>", "text", name=name))
    keys = found.select("query_id", F.explode("_e").alias("e")).select("query_id", entity_key(F.col("e.texto")).alias("id"))
    return keys.filter((F.length("id") > 1) & ~F.col("id").isin(*GENERIC)).distinct()


def neighbourhood(seeds: DataFrame, edges: DataFrame) -> DataFrame:
    """(query_id, id): seeds and their first-order neighbours, either direction."""
    links = edges.select("src", "dst").distinct()
    out = seeds.join(links, seeds.id == links.src).select("query_id", F.col("dst").alias("id"))
    into = seeds.join(links, seeds.id == links.dst).select("query_id", F.col("src").alias("id"))
    return seeds.unionByName(out).unionByName(into).distinct()


def evidence(seeds: DataFrame, edges: DataFrame, allowed: DataFrame | None = None) -> DataFrame:
    """(query_id, chunk_id, conteo): edges at relevant nodes by chunk, an edge with both ends relevant twice; allowed (query_id, chunk_id) limits the chunks."""
    near = neighbourhood(seeds, edges)
    # Counting the ends of edges by node and chunk first keeps a node of high degree from multiplying rows in the join.
    ends = edges.select(F.col("src").alias("id"), "chunk_id").unionAll(edges.select(F.col("dst").alias("id"), "chunk_id")).filter("chunk_id <> ''").groupBy("id", "chunk_id").agg(F.count("*").alias("n"))
    hits = near.join(ends, "id")
    if allowed is not None:
        hits = hits.join(allowed.select("query_id", "chunk_id").distinct(), ["query_id", "chunk_id"], "left_semi")
    return hits.groupBy("query_id", "chunk_id").agg(F.sum("n").alias("conteo"))


def degree(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("src", "dst")).alias("id")).groupBy("id").agg(F.count("*").alias("grado"))
