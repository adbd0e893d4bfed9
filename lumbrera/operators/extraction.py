"""The extraction run: files are read, dispatched by format to their extractor, and give a text or an error row each."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbrera import plugins
from lumbrera.functions.html import html_text
from lumbrera.functions.jsontext import json_text
from lumbrera.functions.text import slashes
from lumbrera.operators.ingest import extractor
from lumbrera.sources import decoders
from lumbrera.sources.files import elements_text

Extract = Callable[[bytes], str]


def _decoded(b: bytes) -> str:
    return b.decode("utf-8", "ignore")


def pdf_or_page(content: bytes, pdf: Extract) -> str:
    """The header decides: HTML named .pdf is read as HTML, anything but a PDF is an error."""
    head = content[:2048].lstrip()
    if head.startswith(b"%PDF"):
        return pdf(content)
    if b"<html" in head.lower() or b"<!doctype html" in head.lower():
        return html_text(_decoded(content))
    raise ValueError("neither a PDF nor HTML")


def _extractors(names: dict[str, str]) -> dict[str, Extract]:
    """One extractor a kind; plug-ins by the names given for their kinds are loaded when a file first needs them."""
    loaded: dict[str, Callable] = {}

    def plugin(kind: str) -> Callable[[bytes], object]:
        def call(b: bytes) -> object:
            if kind not in loaded:
                loaded[kind] = plugins.factory(kind, names.get(kind, "default"))()
            return loaded[kind]([b])[0]

        return call

    def tabular(b: bytes) -> str:
        return decoders.xlsx_text(b) if b[:2] == b"PK" else decoders.csv_text(b)

    return {
        "html": lambda b: html_text(_decoded(b)),
        "json": lambda b: json_text(_decoded(b)),
        "text": lambda b: _decoded(b).strip(),
        "tabular": tabular,
        "pdf": lambda b: pdf_or_page(b, plugin("pdf")),
        "image": plugin("ocr"),
        "osm": lambda b: elements_text(plugin("osm")(b), "tipo"),
        "tile": lambda b: elements_text(plugin("tile")(b), "capa"),
    }


def extract(files: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """(doc_id, path, texto, error) of files (doc_id, path, formato, content): one of texto and error is set in every row.

    A file that cannot be read is an error of its row, never of the task. One narrow pass; formats meet in a batch.
    names: plug-ins by kind (pdf, ocr, osm, tile), the default ones otherwise.
    """
    names = names or {}

    @F.pandas_udf("struct<texto:string,error:string>")
    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        by = _extractors(names)
        for kinds, formats, contents in batches:
            rows = []
            for kind, formato, content in zip(kinds, formats, contents, strict=True):
                if kind is None:
                    rows.append((None, f"no extractor for {formato if formato is not None else 'null'}"))
                elif content is None:
                    rows.append((None, "file not found"))
                else:
                    try:
                        text = by[kind](bytes(content))
                        rows.append((text, None) if text and text.strip() else (None, "empty text"))
                    except Exception as e:  # noqa: BLE001 - whatever a decoder raises is the row's error
                        rows.append((None, str(e) or type(e).__name__))
            yield pd.DataFrame(rows, columns=["texto", "error"])

    kind = extractor(F.col("formato"), F.col("path"))
    out = files.select("doc_id", "path", run.asNondeterministic()(kind, F.col("formato"), F.col("content")).alias("_r"))
    invalid = F.coalesce(F.trim("path"), F.lit("")) == ""
    return out.select("doc_id", "path", F.when(~invalid, F.col("_r.texto")).alias("texto"), F.when(invalid, "invalid row").otherwise(F.col("_r.error")).alias("error"))


def extract_registry(registry: DataFrame, files: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """extract() of registry rows (doc_id, path, formato) whose bytes are those of files (path, content); separators and the scheme of a path do not count."""
    key = lambda c: F.regexp_replace(slashes(F.col(c)), r"^file:/+", "/")
    joined = registry.select("doc_id", "path", "formato", key("path").alias("_k")).join(files.select(key("path").alias("_k"), "content"), "_k", "left")
    return extract(joined.drop("_k"), names)
