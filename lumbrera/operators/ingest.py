"""Registry, extraction routing with an error output, corpus assembly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumbrera.functions.text import not_blank, path_key, phenomenon_number, slashes
from lumbrera.session import written

#: Formats that have an extractor, and which (fixed values).
EXTRACTORS = {"html": "html", "htm": "html", "pdf": "pdf", "csv": "tabular", "xlsx": "tabular", "png": "image", "jpg": "image", "jpeg": "image", "avif": "image", "txt": "text", "json": "json"}


def extractor(formato: Column, path: Column) -> Column:
    """Name of the extractor of a file; pbf below /tiles/ are vector tiles, others map data; null without one."""
    pairs = F.create_map(*[F.lit(x) for kv in EXTRACTORS.items() for x in kv])
    f = F.lower(formato)
    pbf = F.when(F.contains(slashes(path), F.lit("/tiles/")), "tile").otherwise("osm")
    return F.when(f == "pbf", pbf).otherwise(F.try_element_at(pairs, f))


def row_numbers(df: DataFrame, order: list[str], out: str = "ord") -> DataFrame:
    """Consecutive numbers from 0 in a global order, without one task holding all rows: range partitions are numbered in themselves and shifted by the sizes of those before (one row a partition)."""
    ranged = written(df.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()))
    sizes = ranged.groupBy("_p").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_b", F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).drop("_n")
    w = Window.partitionBy("_p").orderBy(*order)
    return ranged.join(F.broadcast(before), "_p").withColumn(out, F.row_number().over(w) - 1 + F.col("_b")).drop("_p", "_b")


def registry(inventory: DataFrame) -> DataFrame:
    """inventory with doc_id by rank of path, formato without its dot and fuente with slashes."""
    numbered = row_numbers(inventory, ["path"])
    return numbered.select("path", "extension", "size_kb", "fenomeno", F.format_string("DOC-%04d", "ord").alias("doc_id"), F.replace("extension", F.lit("."), F.lit("")).alias("formato"), slashes(F.col("path")).alias("fuente"))


def extraction_status(rows: DataFrame, path: str = "path", formato: str = "formato", text: str = "texto", error: str | None = None) -> DataFrame:
    """rows with error: null where a text came out, otherwise why not."""
    own = F.col(error) if error else F.lit(None).cast("string")
    reason = F.when(F.col(path).isNull(), "invalid row").when(extractor(F.col(formato), F.col(path)).isNull(), F.concat(F.lit("no extractor for "), F.coalesce(F.col(formato), F.lit("null"))))
    reason = F.coalesce(reason, own, F.when(~not_blank(F.col(text)), F.lit("empty text")))
    return rows.drop("error").withColumn("error", reason)


def extracted_and_failed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both outputs of one pass: rows with a text, and (doc_id, path, error); the pass is written once."""
    done = written(rows)
    return done.filter("error is null").drop("error"), done.filter("error is not null").select("doc_id", "path", "error")


def to_run_again(registry_rows: DataFrame, errors: DataFrame) -> DataFrame:
    return registry_rows.join(errors.select("doc_id"), "doc_id", "left_semi")


def build_corpus(registry_rows: DataFrame, texts: DataFrame, languages: DataFrame, official: DataFrame, prefix: str = "data/raw/") -> tuple[DataFrame, DataFrame]:
    """(corpus, excluded): documents with a format, a non-blank text, phenomenon 1 to 3 and an official id; excluded lack the id only.

    texts (doc_id, texto), languages (doc_id, idioma), official (ruta, doc_oficial); a missing language stays null.
    """
    rows = registry_rows.filter(F.col("formato").isNotNull()).withColumn("fenomeno", phenomenon_number(F.col("fuente"))).filter(F.col("fenomeno").between(1, 3))
    rows = rows.join(texts.filter(not_blank(F.col("texto"))).select("doc_id", "texto"), "doc_id").join(languages.select("doc_id", "idioma"), "doc_id", "left").withColumn("ruta", path_key(F.col("fuente"), prefix))
    corpus = rows.join(official, "ruta").select(F.col("doc_oficial").alias("doc_id"), "fuente", "formato", "fenomeno", "idioma", F.col("texto").alias("texto_completo"))
    return corpus, rows.join(official, "ruta", "left_anti").select("doc_id", "fuente")


def seeded_sample(rows: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows by the order of a hash of key and seed: a sampling operator, the same rows whatever the partitions; a top-k, no full sort."""
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    return rows.orderBy(order, key).limit(n)


def extension_counts(inventory: DataFrame) -> DataFrame:
    """Files by fenomeno and extension; files without either are not counted."""
    return inventory.filter("fenomeno is not null and extension is not null").groupBy("fenomeno", "extension").agg(F.count("*").alias("archivos"))


def reuse_vectors(chunks: DataFrame, old: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(reused, unmatched): vectors of old (fuente, posicion, texto, embedding, vec_id) for chunks of the same place; a differing text raises. The last vec_id of equal places wins."""
    last = old.groupBy("fuente", "posicion").agg(F.max_by(F.struct("texto", "embedding"), "vec_id").alias("o"))
    joined = chunks.join(last, ["fuente", "posicion"], "left")
    same = F.when(F.col("o.texto").eqNullSafe(F.col("texto")), F.col("o.embedding")).otherwise(F.raise_error(F.concat(F.lit("text differs at "), F.coalesce("fuente", F.lit("null")), F.lit(" "), F.col("posicion").cast("string"))))
    reused = joined.filter("o is not null").withColumn("embedding", same).drop("o")
    return reused, joined.filter("o is null").drop("o")
