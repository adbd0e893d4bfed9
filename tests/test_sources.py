import gzip

from pyspark.sql import functions as F

from lumbrera import plugins
from lumbrera.operators import ingest
from lumbrera.sources import files
from lumbrera.streaming import ingest as stream


def test_inventory_and_registry(spark, tmp_path):
    (tmp_path / "F1_a").mkdir()
    (tmp_path / "F1_a" / "Uno.HTML").write_text("x" * 2048)
    (tmp_path / "F1_a" / ".DS_Store").write_text("x")
    (tmp_path / "dos").write_text("y")
    inv = files.inventory(spark, str(tmp_path))
    got = {r.path.rsplit("/", 1)[1]: r for r in inv.collect()}
    assert set(got) == {"Uno.HTML", "dos"}
    assert (got["Uno.HTML"].extension, got["Uno.HTML"].size_kb, got["Uno.HTML"].fenomeno) == (".html", 2.0, "F1_a")
    assert (got["dos"].extension, got["dos"].fenomeno) == ("", None)
    assert sorted(r.doc_id for r in ingest.registry(inv).collect()) == ["DOC-0000", "DOC-0001"]
    assert [(r.fenomeno, r.archivos) for r in ingest.extension_counts(inv).collect()] == [("F1_a", 1)]


def test_jsonl_and_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("D", 'ñ "x", y\nz', None)], "doc_id string, path string, error string")
    files.write_jsonl(df, f"{tmp_path}/j")
    assert "ñ" in "".join(p.read_text() for p in (tmp_path / "j").glob("*.json"))
    assert files.read_jsonl(spark, f"{tmp_path}/j", files.ERRORS).collect() == df.collect()
    files.write_csv(df.fillna(""), f"{tmp_path}/c")
    assert files.read_csv(spark, f"{tmp_path}/c", files.ERRORS).first().path == 'ñ "x", y\nz'
    (tmp_path / "g.json.gz").write_bytes(gzip.compress(b'{"doc_id": "A"}\n\n{"doc_id": "B"}\n'))
    assert [r.doc_id for r in files.read_jsonl(spark, f"{tmp_path}/g.json.gz", files.ERRORS, 2).collect()] == ["A"]
    assert [r.idioma for r in files.languages_or_unknown(spark, None, df).collect()] == ["unknown"]


def test_extractors(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b" ab\xff c\n")
    (tmp_path / "b.pdf").write_bytes(b"  <!DOCTYPE html><p>hola</p>")
    (tmp_path / "c.pdf").write_bytes(b"nada")
    (tmp_path / "d.pdf").write_bytes(b"%PDF-1.4")
    rows = {r.path.rsplit("/", 1)[1]: r for r in files.read_files(spark, str(tmp_path)).select("path", files.text_of(F.col("content")).alias("t"), files.pdf_of(F.col("content")).alias("p"), files.image_text(F.col("content")).alias("i")).collect()}
    assert rows["a.txt"].t == "ab c"
    assert rows["b.pdf"].p.texto == "hola" and rows["c.pdf"].p.error and rows["d.pdf"].p.texto == "" and rows["d.pdf"].i == ""


def test_tables(spark):
    df = spark.createDataFrame([(1, "a", None), (None, " ", None), (2, "b", 1.5)], "n int, s string, x double")
    assert [r.texto for r in files.table_text(df).collect()] == ["n: 1, s: a", "n: 2, s: b, x: 1.5"]
    t = spark.createDataFrame([("D", 2, "b"), ("D", 1, "a")], "doc_id string, o int, texto string")
    assert files.document_of_rows(t, "doc_id", "o").first().texto == "a\n\nb"


def test_map_elements(spark):
    plugins.register("osm", "two", lambda: lambda items: [[{"tipo": "nodo", "id": 1, "tags": {"k": "v"}}, {"tipo": "nodo", "id": 1, "tags": {"k": "v"}}, {"tipo": "via", "id": 1, "tags": {}}] for _ in items])
    df = spark.createDataFrame([("p", bytearray(b"x"))], "path string, content binary")
    found = df.select("path", F.explode(plugins.apply("osm", files.ELEMENTS, "content", name="two")).alias("e")).select("path", "e.*")
    assert [r.texto for r in files.element_text(found).collect()] == ["tipo: nodo, k: v"]
    assert files.osm_text(df).count() == 0 and files.tile_text(df).count() == 0
    assert bytes(df.select(files.gunzipped(F.lit(bytearray(gzip.compress(b"z")))).alias("g")).first().g) == b"z"


def test_query_bank(spark):
    text = "Preámbulo q999 x\nq001 uno\n  dos q002 tres\n\nq003\tcuatro\nq001 último\n"
    got = {r.query_id: r.text for r in files.query_bank(spark.createDataFrame([(text,)], "value string")).collect()}
    assert got == {"q001": "último", "q003": "cuatro"}
    assert files.query_bank(spark.createDataFrame([(None,)], "value string")).count() == 0


def test_graph_files_and_artefacts(spark, tmp_path):
    nodes = spark.createDataFrame([("a&", 'A "x"', "ORG")], "id string, label string, tipo string")
    edges = spark.createDataFrame([("a&", "b", "r", "D", "c", 1)], "src string, dst string, relacion string, doc_id string, chunk_id string, fenomeno int")
    files.write_graph(nodes, edges, f"{tmp_path}/g")
    assert files.read_graph(spark, f"{tmp_path}/g")[1].collect() == edges.collect()
    xml = "".join(r.value for r in files.graphml(nodes, edges).orderBy("parte").collect())
    import xml.etree.ElementTree as ET

    assert len(list(ET.fromstring(xml).iter("{http://graphml.graphdrawing.org/xmlns}edge"))) == 1
    assert files.missing_artefacts(spark, f"file://{tmp_path}", ("g", "h")) == ["h"]
    files.write_vectors(spark.createDataFrame([(1, "c", [1.0])], "vec_id bigint, chunk_id string, embedding array<float>"), f"{tmp_path}/v", 2)
    files.write_texts(spark.createDataFrame([("D", "t", "pdf")], "doc_id string, texto string, formato string"), f"{tmp_path}/t")
    assert spark.read.parquet(f"{tmp_path}/v").count() == 1 and spark.read.parquet(f"{tmp_path}/t").first().formato == "pdf"


def test_stream_chunks_once(spark, tmp_path):
    schema = "doc_id string, fuente string, formato string, fenomeno int, idioma string, texto_completo string"
    spark.createDataFrame([("D", "f", "txt", 1, "es", "Una frase. Otra.")], schema).write.parquet(f"{tmp_path}/in")
    for _ in range(2):
        q = stream.chunk_stream(stream.corpus_stream(spark, f"{tmp_path}/in", schema), f"{tmp_path}/out", f"{tmp_path}/cp")
        q.awaitTermination(60)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 1
