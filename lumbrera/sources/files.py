"""Sources and sinks: directory inventories, text, HTML, JSON, tables, PDF, images, map data, query banks, vectors and graphs."""

from __future__ import annotations

import gzip
import zlib
from xml.sax.saxutils import escape, quoteattr

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumbrera import plugins
from lumbrera.functions.html import from_html
from lumbrera.functions.jsontext import from_json_text
from lumbrera.functions.text import collapse_spaces, not_blank, row_text, slashes, strip
from lumbrera.sources import decoders

ERRORS = "doc_id string, path string, error string"
CHUNK = "doc_id string, chunk_id string, fuente string, formato string, fenomeno int, posicion int, num_tokens int, texto string, idioma string"
CORPUS = "doc_id string, fuente string, formato string, fenomeno int, idioma string, texto_completo string"


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """path, extension, size_kb, fenomeno of the files below root. The content column is not selected, so no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length")
    relative = F.regexp_replace("path", r"^.*?" + _quoted(root.rstrip("/")) + "/", "")
    name = F.element_at(F.split("path", "/"), -1)
    files = files.filter(name != ".DS_Store")
    extension = F.lower(F.regexp_extract(name, r"(?<=.)(\.[^.]+)$", 1))
    folder = F.nullif(F.regexp_extract(relative, r"^([^/]+)/", 1), F.lit(""))
    return files.select("path", extension.alias("extension"), F.bround(F.col("length") / 1024, 1).alias("size_kb"), folder.alias("fenomeno"))


def _quoted(s: str) -> str:
    return "\\Q" + s.removeprefix("file://") + "\\E"


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema, mode="DROPMALFORMED", escape='"', multiLine=True)


def languages_or_unknown(spark: SparkSession, path: str | None, docs: DataFrame) -> DataFrame:
    """doc_id and idioma of a languages file; "unknown" for every document where there is none."""
    return read_csv(spark, path, "doc_id string, idioma string") if path else docs.select("doc_id", F.lit("unknown").alias("idioma"))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True, escape='"')


def read_jsonl(spark: SparkSession, path: str, schema: str, limit: int | None = None) -> DataFrame:
    """JSON lines, plain or .gz; blank lines are skipped. limit takes the first raw lines, blank ones counted, in the order of files and of their lines."""
    if limit is None:
        return spark.read.schema(schema).json(path)
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_f"), F.monotonically_increasing_id().alias("_n"))
    # Ids grow along a file within a partition, and the partitions of a file in its order: a top-k, no global sort.
    lines = lines.orderBy("_f", "_n").limit(limit).filter(not_blank(F.col("value")))
    return lines.select(F.from_json("value", schema).alias("_j")).select("_j.*")


def write_jsonl(df: DataFrame, path: str) -> None:
    """UTF-8 lines, not escaped to ASCII; null fields are written."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def decoded(content: Column) -> Column:
    """UTF-8 text of bytes, malformed bytes dropped."""

    @F.pandas_udf("string")
    def decode(s: pd.Series) -> pd.Series:
        return s.map(lambda b: None if b is None else bytes(b).decode("utf-8", "ignore"))

    return decode(content)


def read_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """path and content of files, for the extractors below."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path).select("path", "content")


def text_of(content: Column) -> Column:
    return strip(decoded(content))


def html_of(content: Column) -> Column:
    return from_html(decoded(content))


def json_of(content: Column) -> Column:
    return from_json_text(decoded(content))


def table_text(df: DataFrame) -> DataFrame:
    """(texto) one row as "col: val, col: val" each; rows without a value are dropped."""
    return df.select(row_text(df.columns).alias("texto")).filter(F.col("texto") != "")


def document_of_rows(rows: DataFrame, key: str, order: str, text: str = "texto") -> DataFrame:
    """Rows of a table as one document each key, separated by blank lines."""
    return rows.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda r: r[text]), "\n\n").alias(text))


def pdf_of(content: Column) -> Column:
    """STRUCT<texto, error> of PDF bytes: the header decides; HTML named .pdf is read as HTML, anything else is an error."""
    head = F.lower(F.regexp_replace(F.decode(F.substring(content, 1, 2048), "ISO-8859-1"), r"^\s+", ""))
    is_pdf, is_html = F.startswith(head, F.lit("%pdf")), F.contains(head, F.lit("<!doctype html")) | F.contains(head, F.lit("<html"))
    pdf = plugins.attempt("pdf", "string", F.when(is_pdf, content))
    web = html_of(F.when(~is_pdf & is_html, content))
    return F.struct(F.when(is_pdf, pdf["value"]).when(is_html, web).alias("texto"), F.when(content.isNotNull() & ~is_pdf & ~is_html, F.lit("neither a PDF nor HTML")).otherwise(pdf["error"]).alias("error"))


def image_text(content: Column) -> Column:
    """Text of an image by the ocr plug-in; "" where it fails."""
    return F.coalesce(plugins.attempt("ocr", "string", content)["value"], F.lit(""))


def gunzipped(content: Column) -> Column:
    """Bytes without their gzip wrapping, if any; null where it is damaged."""

    @F.pandas_udf("binary")
    def inflate(s: pd.Series) -> pd.Series:
        def one(b: bytes | None) -> bytes | None:
            try:
                return b if b is None or bytes(b[:2]) != b"\x1f\x8b" else gzip.decompress(bytes(b))
            except (OSError, EOFError, zlib.error):
                return None

        return s.map(one)

    return inflate(content)


ELEMENTS = "array<struct<tipo:string,id:bigint,tags:map<string,string>>>"


def elements_text(elements: list[dict], kind: str) -> str:
    """Elements with tags as "kind: ..., key: value" by blank lines; for kind tipo each (tipo, id) once."""
    once = {(e["tipo"], e["id"]): e for e in reversed(elements)} if kind == "tipo" else dict(enumerate(elements))
    order = reversed(once.values()) if kind == "tipo" else once.values()
    return "\n\n".join(", ".join([f"{kind}: {e['tipo']}", *(f"{k}: {v}" for k, v in e["tags"].items())]) for e in order if e["tags"])


def element_text(elements: DataFrame, kind: str = "tipo") -> DataFrame:
    """(path, texto) of map elements (path, tipo, id, tags): each (path, tipo, id) once, those without tags dropped."""
    pairs = F.array_join(F.transform(F.map_entries("tags"), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), ", ")
    once = elements.dropDuplicates(["path", "tipo", "id"]) if kind == "tipo" else elements
    return once.filter(F.size("tags") > 0).select("path", F.concat(F.lit(f"{kind}: "), F.col("tipo"), F.lit(", "), pairs).alias("texto"))


def _elements(files: DataFrame, kind: str, content: Column) -> DataFrame:
    return files.select("path", F.explode(plugins.attempt(kind, ELEMENTS, content)["value"]).alias("e")).select("path", "e.*")


def osm_text(files: DataFrame) -> DataFrame:
    """Elements of map files; a damaged file gives none here (the extraction run gives its error)."""
    return element_text(_elements(files, "osm", F.col("content")))


def tile_text(files: DataFrame) -> DataFrame:
    """Features of vector tiles, gunzipped where needed; tipo holds the layer."""
    return element_text(_elements(files, "tile", gunzipped(F.col("content"))), "capa")


def read_xlsx(spark: SparkSession, path: str) -> DataFrame:
    """(path, fila, celdas MAP<STRING, STRING>) of the rows of XLSX files, one file a row of the read; null cells left out."""

    @F.pandas_udf("array<map<string,string>>")
    def rows(s: pd.Series) -> pd.Series:
        def one(b: bytes) -> list[dict] | None:
            try:
                df = decoders.xlsx_frame(bytes(b))
            except Exception:  # noqa: BLE001 - a damaged workbook has no rows
                return None
            return [{str(c): str(v) for c, v in zip(df.columns, r, strict=True) if v is not None and v == v} for r in df.itertuples(index=False, name=None)]

        return s.map(one)

    return read_files(spark, path, "*.xlsx").select("path", F.posexplode(rows.asNondeterministic()("content")).alias("fila", "celdas"))


def official_index(rows: DataFrame, folder: str = "Carpeta", name: str = "Nombre estandarizado", key: str = "DOC_ID") -> DataFrame:
    """(carpeta, nombre, doc_id, ord) of an inventory sheet read by read_xlsx, for official_ids."""
    cell = lambda c: F.try_element_at("celdas", F.lit(c))
    return rows.select(cell(folder).alias("carpeta"), cell(name).alias("nombre"), cell(key).alias("doc_id"), F.col("fila").alias("ord"))


def official_ids(index: DataFrame, order: str = "ord") -> DataFrame:
    """(ruta, doc_oficial) of an inventory sheet exported with carpeta, nombre, doc_id; the last row of a path wins."""
    ruta = F.concat_ws("/", slashes(F.regexp_replace("carpeta", r"[/\\]+$", "")), "nombre")
    return index.withColumn("ruta", ruta).groupBy("ruta").agg(F.max_by("doc_id", order).alias("doc_oficial"))


def query_bank(texts: DataFrame, text: str = "value") -> DataFrame:
    """(query_id, text) of a bank in which each query starts a line with q and three digits; what precedes the first is dropped, the last of equal ids wins."""
    found = F.regexp_extract_all(F.col(text), F.lit(r"(?ms)^(q\d{3}\s.*?)(?=^q\d{3}\s|\z)"), F.lit(1))
    rows = texts.select(F.posexplode(found).alias("_n", "_q"))
    rows = rows.select("_n", F.substring("_q", 1, 4).alias("query_id"), collapse_spaces(F.expr("substring(_q, 5)")).alias("text"))
    return rows.groupBy("query_id").agg(F.max_by("text", "_n").alias("text"))


def read_query_bank(spark: SparkSession, path: str) -> DataFrame:
    return query_bank(spark.read.text(path, wholetext=True))


def write_vectors(vectors: DataFrame, path: str, buckets: int | None = None) -> None:
    """vec_id, chunk_id, embedding as Parquet: an index without positions, since every vector carries its keys."""
    (vectors.repartition(buckets, "vec_id") if buckets else vectors).write.mode("overwrite").parquet(path)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """(vec_id, chunk_id, embedding) of an index written by write_vectors."""
    return spark.read.schema("vec_id bigint, chunk_id string, embedding array<float>").parquet(path)


def write_texts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "texto") -> None:
    """Extracted texts as one Parquet table partitioned by format where there is one, in place of a file each document."""
    keep = [c for c in (key, text, "formato") if c in docs.columns]
    out = docs.select(*keep).write.mode("overwrite")
    (out.partitionBy("formato") if "formato" in keep else out).parquet(path)


def missing_artefacts(spark: SparkSession, root: str, names: tuple[str, ...]) -> list[str]:
    """Names below root that do not exist; a check only, nothing is fetched."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    paths = {n: jvm.org.apache.hadoop.fs.Path(f"{root}/{n}") for n in names}
    return [n for n, p in paths.items() if not p.getFileSystem(conf).exists(p)]


def write_graph(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    edges.write.mode("overwrite").parquet(f"{path}/edges")


def read_graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}/nodes"), spark.read.parquet(f"{path}/edges")


def graphml(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(value) lines of a GraphML document, in order of (parte, value): written with write.text after a sort, never gathered."""
    esc = lambda c: F.replace(F.replace(F.replace(F.coalesce(c.cast("string"), F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit('"'), F.lit("&quot;"))
    data = lambda cols: F.concat(*[F.concat(F.lit(f"<data key={quoteattr(c)}>"), esc(F.col(c)), F.lit("</data>")) for c in cols])
    spark = nodes.sparkSession
    keys = "".join(f'<key id={quoteattr(c)} for="{kind}" attr.name="{escape(c)}" attr.type="string"/>' for kind, cols in (("node", ("label", "tipo")), ("edge", ("relacion", "doc_id", "chunk_id", "fenomeno"))) for c in cols)
    head = spark.createDataFrame([(0, f'<?xml version="1.0" encoding="UTF-8"?><graphml xmlns="http://graphml.graphdrawing.org/xmlns">{keys}<graph edgedefault="directed">'), (3, "</graph></graphml>")], "parte int, value string")
    node = nodes.select(F.lit(1).alias("parte"), F.concat(F.lit('<node id="'), esc(F.col("id")), F.lit('">'), data(("label", "tipo")), F.lit("</node>")).alias("value"))
    edge = edges.select(F.lit(2).alias("parte"), F.concat(F.lit('<edge source="'), esc(F.col("src")), F.lit('" target="'), esc(F.col("dst")), F.lit('">'), data(("relacion", "doc_id", "chunk_id", "fenomeno")), F.lit("</edge>")).alias("value"))
    return head.unionByName(node).unionByName(edge)


def write_graphml(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """One GraphML document as text parts that follow each other in the order of their names."""
    graphml(nodes, edges).repartitionByRange("parte").sortWithinPartitions("parte").select("value").write.mode("overwrite").text(path)


def read_graphml(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of GraphML whose nodes and edges stand each on a line of its own, as write_graphml puts them; the lines of a document may lie in any number of files.

    Keys are known by their attr.name where the head declares it. Elements are read line by line, so no document is held whole.
    """
    lines = spark.read.text(path)
    heads = lines.filter(F.col("value").contains("<key ")).select(F.explode(F.regexp_extract_all("value", F.lit("(<key [^>]*>)"), F.lit(1))).alias("k"))
    names = {r["id"]: r["n"] for r in heads.select(F.regexp_extract("k", r'\bid="([^"]*)"', 1).alias("id"), F.regexp_extract("k", r'attr\.name="([^"]*)"', 1).alias("n")).distinct().limit(1000).collect()}
    plain = lambda c: F.replace(F.replace(F.replace(F.replace(c, F.lit("&quot;"), F.lit('"')), F.lit("&lt;"), F.lit("<")), F.lit("&gt;"), F.lit(">")), F.lit("&amp;"), F.lit("&"))
    attribute = lambda a: plain(F.regexp_extract("value", rf'^\s*<\w+[^>]*\b{a}="([^"]*)"', 1))

    def data(name: str) -> Column:
        ids = [i for i, n in names.items() if n == name] or [name]
        got = [F.regexp_extract("value", rf'<data key="{i}">([^<]*)</data>', 1) for i in ids]
        return plain(F.coalesce(*[F.nullif(g, F.lit("")) for g in got], F.lit("")))

    nodes = lines.filter(F.ltrim("value").startswith("<node ")).select(attribute("id").alias("id"), data("label").alias("label"), data("tipo").alias("tipo"))
    edges = lines.filter(F.ltrim("value").startswith("<edge ")).select(attribute("source").alias("src"), attribute("target").alias("dst"), data("relacion").alias("relacion"), data("doc_id").alias("doc_id"), data("chunk_id").alias("chunk_id"), data("fenomeno").try_cast("int").alias("fenomeno"))
    return nodes, edges


def last_rows(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.desc(order))
    return df.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def non_blank(df: DataFrame, text: str = "texto") -> DataFrame:
    return df.filter(not_blank(F.col(text)))
