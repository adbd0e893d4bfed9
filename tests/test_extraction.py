import gzip
import io
import struct
import zipfile
import zlib

from pyspark.sql import functions as F

from lumbrera import __main__ as cli
from lumbrera import plugins
from lumbrera.operators import chunking, extraction, ingest
from lumbrera.plans import pipelines
from lumbrera.sources import decoders, files


def varint(n):
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def field(number, value):
    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    return varint(number << 3 | 2) + varint(len(value)) + value


def packed(*ns):
    return b"".join(map(varint, ns))


def tile():
    values = [field(1, b"R\xc3\xado"), varint(2 << 3 | 5) + struct.pack("<f", 2.5), varint(3 << 3 | 1) + struct.pack("<d", 0.1), field(6, 3), field(7, 1)]
    layer = field(15, 2) + field(1, b"agua") + field(2, field(1, 7) + field(2, packed(0, 0, 1, 1, 2, 2, 3, 3, 4, 4))) + field(2, field(1, 8))
    return field(3, layer + b"".join(field(3, k) for k in (b"nombre", b"ancho", b"largo", b"nivel", b"hondo")) + b"".join(field(4, v) for v in values))


def osm():
    table = b"".join(field(1, s) for s in (b"", b"name", b"Paso", b"highway", b"path"))
    dense = field(1, packed(2, 4, 2)) + field(10, packed(1, 2, 0, 0, 3, 4, 0))
    way = field(1, 9) + field(2, packed(1)) + field(3, packed(2))
    relation = field(1, 9) + field(2, packed(3)) + field(3, packed(4))
    block = field(1, table) + field(2, field(2, dense)) + field(2, field(3, way) + field(3, way)) + field(2, field(4, relation))
    out = b""
    for kind, raw in ((b"OSMHeader", b""), (b"OSMData", block)):
        blob = field(2, len(raw)) + field(3, zlib.compress(raw))
        head = field(1, kind) + field(3, len(blob))
        out += struct.pack(">I", len(head)) + head + blob
    return out


def workbook():
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="a" sheetId="1" r:id="rId7"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="rId7" Target="worksheets/hoja.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {main}><si><t>Carpeta</t></si><si><t>Nombre estandarizado</t></si><si><t>DOC_ID</t></si><si><r><t>F1_</t></r><r><t>a</t></r></si></sst>")
        z.writestr("xl/styles.xml", f'<styleSheet {main}><numFmts><numFmt numFmtId="170" formatCode="yyyy-mm"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="170"/></cellXfs></styleSheet>')
        z.writestr(
            "xl/worksheets/hoja.xml",
            f'<worksheet {main}><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c><c r="C1" t="s"><v>2</v></c><c r="D1" t="inlineStr"><is><t>n</t></is></c><c r="E1" t="str"><v>fecha</v></c></row>'
            '<row><c r="A2" t="s"><v>3</v></c><c r="B2" t="str"><v>x.pdf</v></c><c r="C2" t="str"><v>OF1</v></c><c r="D2"><v>3</v></c><c r="E2" s="1"><v>36526</v></c></row><row><c r="B3" t="str"><v> </v></c></row>'
            '<row><c r="B4" t="str"><v>y</v></c><c r="D4"><v>5</v></c></row></sheetData></worksheet>',
        )
    return out.getvalue()


def pdf():
    content = zlib.compress(b"BT /F1 12 Tf 72 700 Td (Uno \\(dos\\)) Tj 0 -14 Td [(tr) -20 (es) -300 (cuatro)] TJ ET")
    return b"%PDF-1.4\n1 0 obj <</Length 5 /Filter /FlateDecode /R <</A 1>>>>\nstream\n" + content + b"\nendstream\nendobj\n2 0 obj <<>> stream\nBT <f1> Tj ET\nendstream"


def test_decoders():
    assert files.elements_text(decoders.tile_elements(tile()), "capa") == "capa: agua, nombre: Río, ancho: 2.5, largo: 0.1, nivel: -2, hondo: True"
    assert decoders.tile_elements(gzip.compress(tile())) == decoders.tile_elements(tile())
    assert decoders.tile_elements(gzip.compress(tile())[:-20]) == [] == decoders.tile_elements(tile()[:-3])
    assert files.elements_text(decoders.osm_elements(osm()), "tipo") == "tipo: nodo, name: Paso\n\ntipo: nodo, highway: path\n\ntipo: via, name: Paso\n\ntipo: relacion, highway: path"
    assert [e["id"] for e in decoders.osm_elements(osm())] == [1, 3, 4, 9, 9, 9]
    assert decoders.xlsx_text(workbook()) == "Carpeta: F1_a, Nombre estandarizado: x.pdf, DOC_ID: OF1, n: 3.0, fecha: 2000-01-01 00:00:00\n\nNombre estandarizado: y, n: 5.0"
    assert decoders.csv_text("a,b\n1,x\n2, \n3,z,sobra\n,\n".encode()) == "a: 1.0, b: x\n\na: 2.0"
    assert decoders.pdf_text(pdf()) == "Uno (dos)\ntres cuatro\n\nñ"


def test_files_give_texts_or_error_rows(spark, tmp_path):
    content = {
        "a.html": b"<p>hola</p>", "b.json": b'{"title": "T"}', "c.csv": b"a\n1\n", "d.xlsx": workbook(), "e.pdf": pdf(), "f.pdf": b"<html><p>web</p>", "g.txt": b" t\xff ", "m/tiles/1/h.pbf": gzip.compress(tile()), "i.pbf": osm(),
        "j.pbf": osm()[:-9], "k.json": b"{", "l.xlsx": b"PKrota", "n.pdf": b"nada", "o.png": b"x", "p.zip": b"x", "m/tiles/1/q.pbf": gzip.compress(tile())[:-30],
    }
    for name, b in content.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b)
    registry = ingest.registry(files.inventory(spark, str(tmp_path)))
    more = spark.createDataFrame([("N1", "no/existe.txt", "txt"), ("N2", " ", "txt"), ("N3", "x", None)], "doc_id string, path string, formato string")
    texts, errors = pipelines.extract_all(registry.select("doc_id", "path", "formato").unionByName(more), files.read_files(spark, str(tmp_path)))
    short = lambda p: p.rsplit("/", 1)[-1]
    got, bad = {short(r.path): r.texto for r in texts.collect()}, {short(r.path): r.error for r in errors.collect()}
    assert set(got) == {"a.html", "b.json", "c.csv", "d.xlsx", "e.pdf", "f.pdf", "g.txt", "h.pbf", "i.pbf"}
    assert (got["a.html"], got["f.pdf"], got["g.txt"], got["c.csv"]) == ("hola", "web", "t", "a: 1")
    assert set(bad) == {"j.pbf", "k.json", "l.xlsx", "n.pdf", "o.png", "p.zip", "q.pbf", "existe.txt", " ", "x"}
    assert (bad["n.pdf"], bad["o.png"], bad["p.zip"], bad["q.pbf"], bad["existe.txt"], bad[" "], bad["x"]) == ("neither a PDF nor HTML", "empty text", "no extractor for zip", "empty text", "file not found", "invalid row", "no extractor for null")
    assert extraction.extract(spark.createDataFrame([], "doc_id string, path string, formato string, content binary")).count() == 0


def test_a_raising_plugin_is_an_error_of_its_row(spark):
    def make():
        def call(items):
            return [1 // len(x) for x in items]

        return call

    plugins.register("tokens", "raising", make)
    got = spark.createDataFrame([("a",), ("",), (None,), ("bb",)], "t string").select(plugins.attempt("tokens", "int", "t", name="raising").alias("x")).select("x.*").collect()
    assert [r.value for r in got] == [1, None, None, 0] and "zero" in got[1].error and got[0].error is got[2].error is None


def test_damaged_tiles_and_tables(spark, tmp_path):
    df = spark.createDataFrame([("p", bytearray(gzip.compress(tile()))), ("q", bytearray(gzip.compress(tile())[:-9])), ("r", bytearray(b"zz")), ("s", None)], "path string, content binary")
    assert [r.texto for r in files.tile_text(df).collect()] == ["capa: agua, nombre: Río, ancho: 2.5, largo: 0.1, nivel: -2, hondo: True"]
    assert files.osm_text(df).count() == 0
    (tmp_path / "i.xlsx").write_bytes(workbook())
    (tmp_path / "j.xlsx").write_bytes(b"PK")
    index = files.official_ids(files.official_index(files.read_xlsx(spark, str(tmp_path))))
    assert {(r.ruta, r.doc_oficial) for r in index.collect() if r.doc_oficial} == {("F1_a/x.pdf", "OF1")}


def test_graphml_and_vectors_round_trip(spark, tmp_path):
    nodes = spark.createDataFrame([("a&<", 'A "x"', "ORG"), ("b", "B", None)], "id string, label string, tipo string")
    edges = spark.createDataFrame([("a&<", "b", "r > s", "D", "c", 1), ("b", "a&<", "q", "D", "c", None)], "src string, dst string, relacion string, doc_id string, chunk_id string, fenomeno int")
    files.write_graphml(nodes, edges, f"{tmp_path}/g")
    n, e = files.read_graphml(spark, f"{tmp_path}/g")
    assert sorted(map(tuple, n.collect())) == [("a&<", 'A "x"', "ORG"), ("b", "B", "")]
    assert sorted(map(tuple, e.collect()), key=str) == sorted(map(tuple, edges.collect()), key=str)
    v = spark.createDataFrame([(1, "c", [1.0])], "vec_id bigint, chunk_id string, embedding array<float>")
    files.write_vectors(v, f"{tmp_path}/v")
    assert files.read_vectors(spark, f"{tmp_path}/v").collect() == v.collect()


def test_limit_counts_raw_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"doc_id": "1"}\n\n{"doc_id": "2"}\n{"doc_id": "3"}\n')
    (tmp_path / "b.json").write_text('{"doc_id": "4"}\n')
    assert [[r.doc_id for r in files.read_jsonl(spark, str(tmp_path), "doc_id string", n).collect()] for n in (0, 2, 3, 9)] == [[], ["1"], ["1", "2"], ["1", "2", "3", "4"]]


def test_seeded_sample(spark):
    df = spark.range(500).withColumn("k", F.concat(F.lit("d"), "id"))
    one, two = ({r.k for r in ingest.seeded_sample(x, "k", 20).collect()} for x in (df, df.repartition(7)))
    assert one == two and len(one) == 20 and one != {r.k for r in ingest.seeded_sample(df, "k", 20, 1).collect()}


def test_token_budget_counts_the_overlap_again(spark):
    text = "Aa bb. Cc dd! Ee ff? Gg hh."
    assert chunking.token_budget_chunks(text, 4, 1, lambda s: len(s.split())) == ["Aa bb. Cc dd!", "Cc dd! Ee ff?", "Ee ff? Gg hh."]
    assert chunking.token_budget_chunks(text, 1, 0, lambda s: 5) == ["Aa bb.", "Cc dd!", "Ee ff?", "Gg hh."] and chunking.token_budget_chunks(None, 5, 1, len) == []
    got = chunking.chunk_by_tokens(spark.createDataFrame([("d", text), ("e", None), ("f", " ")], "doc_id string, text string"), budget=4, overlap=1).collect()
    assert [(r.doc_id, r.posicion, r.texto) for r in got] == [("d", 0, "Aa bb. Cc dd!"), ("d", 1, "Cc dd! Ee ff?"), ("d", 2, "Ee ff? Gg hh.")]


def test_token_vectors(spark):
    df = spark.createDataFrame([("el banco del río", "banco"), ("el banco central", "Banco"), ("nada", "banco")], "s string, w string")
    v = [r.v for r in df.select(plugins.apply("token_vectors", "array<float>", "s", "w").alias("v")).collect()]
    near = sum(a * b for a, b in zip(v[0], v[1]))
    assert v[2] is None and 0.5 < near < 0.999


def test_steps_by_command(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.html").write_text("<p>OTAN visitó BRASIL ayer. Llovió.</p>")
    run = lambda *a: cli.main([*a])
    run("inventory", f"{tmp_path}/in", f"{tmp_path}/reg")
    run("extract", f"{tmp_path}/in", f"{tmp_path}/txt", "--registry", f"{tmp_path}/reg")
    run("clean", f"{tmp_path}/txt", f"{tmp_path}/clean")
    files.write_jsonl(spark.read.parquet(f"{tmp_path}/clean").select("doc_id", F.lit("f").alias("fuente"), F.lit("html").alias("formato"), F.lit(1).alias("fenomeno"), "idioma", F.col("texto").alias("texto_completo")), f"{tmp_path}/corpus")
    run("chunk", f"{tmp_path}/corpus", f"{tmp_path}/chunks")
    run("index", f"{tmp_path}/chunks", f"{tmp_path}/index")
    run("graph", f"{tmp_path}/chunks", f"{tmp_path}/graph", "--every", "1")
    (tmp_path / "bank.txt").write_text("q002 BRASIL\nq001 OTAN\n")
    run("answer", f"{tmp_path}/bank.txt", f"{tmp_path}/out", "--chunks", f"{tmp_path}/chunks", "--index", f"{tmp_path}/index", "--graph", f"{tmp_path}/graph")
    lines = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("*.json"))).splitlines()
    assert [line[13:17] for line in lines] == ["q001", "q002"] and "OTAN visitó BRASIL ayer." in lines[0]
