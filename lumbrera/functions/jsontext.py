"""Text of JSON documents: known content fields in a fixed order, else all scalars as "path: value" lines."""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Content fields in the order in which they are read (fixed values).
CONTENT_FIELDS = "title titulo título body_text body_paragraphs content contenido text texto summary resumen description descripcion descripción cuerpo".split()
#: Title fields of a metadata object, the first that is set counts (fixed values).
TITLE_FIELDS = ("title", "report_title", "page_title")
#: Sections below this length are menus (fixed value).
SECTION_LENGTH = 200


def value_text(v: Any) -> str:
    """Strings as they are, other scalars as Python writes them, lists by lines, objects by their long sections."""
    match v:
        case str():
            return v
        case bool() | int() | float():
            return str(v)
        case list():
            return "\n".join(filter(None, (value_text(x) for x in v if x)))
        case dict():
            named = ((k, value_text(x).strip()) for k, x in v.items())
            return "\n\n".join(f"{k}\n{t}" for k, t in named if len(t) >= SECTION_LENGTH)
        case _:
            return ""


def flat_lines(v: Any, path: str = "") -> Iterator[str]:
    """Scalars of objects as "a.b: value"; null, "" and [] are left out, as are scalars that stand in a list themselves."""
    if isinstance(v, list):
        for x in v:
            if isinstance(x, dict | list):
                yield from flat_lines(x, path)
    elif isinstance(v, dict):
        for k, x in v.items():
            if isinstance(x, dict | list):
                yield from flat_lines(x, f"{path}{k}.")
            elif x is not None and x != "":
                yield f"{path}{k}: {x}"


def object_text(v: Any) -> str:
    """The metadata title and the content fields of an object, by blank lines; a scalar as itself."""
    if not isinstance(v, dict):
        return "" if v in (None, "", []) else str(v)
    meta = v.get("metadata")
    title = next((meta[k] for k in TITLE_FIELDS if meta.get(k)), None) if isinstance(meta, dict) else None
    fields = (value_text(v[k]).strip() for k in CONTENT_FIELDS if k in v)
    return "\n\n".join(filter(None, [str(title) if title else "", *fields]))


def json_text(raw: str) -> str:
    """Raises ValueError on malformed JSON."""
    v = json.loads(raw)
    text = "\n\n".join(filter(None, map(object_text, v))) if isinstance(v, list) else object_text(v)
    return text if text.strip() else "\n".join(flat_lines(v))


def from_json_text(raw: Column) -> Column:
    """STRUCT<texto, error> of a column of JSON documents."""

    @F.pandas_udf("struct<texto:string,error:string>")
    def parse(s: pd.Series) -> pd.DataFrame:
        def one(t: str | None) -> tuple[str | None, str | None]:
            try:
                return (None, None) if t is None else (json_text(t), None)
            except (ValueError, RecursionError) as e:
                return None, str(e)

        return pd.DataFrame([one(t) for t in s], columns=["texto", "error"])

    return parse(raw)


def flat_text(raw: Column) -> Column:
    """All scalars of a JSON column as lines; null where it is malformed."""

    @F.pandas_udf("string")
    def flat(s: pd.Series) -> pd.Series:
        def one(t: str | None) -> str | None:
            try:
                return None if t is None else "\n".join(flat_lines(json.loads(t)))
            except ValueError:
                return None

        return s.map(one)

    return flat(raw)
