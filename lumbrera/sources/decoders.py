"""Decoders of file formats from bytes to text or elements, with the standard library and pandas only.

Each takes the bytes of one file. A damaged file raises ValueError (or what the standard library raises); tiles, whose servers
return broken ones routinely, give no features instead. The callers turn what is raised into an error of the row.
"""

from __future__ import annotations

import gzip
import io
import re
import struct
import zipfile
import zlib
from collections.abc import Iterator
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pandas as pd

# --- tables --------------------------------------------------------------------------------------------------------------------


def frame_text(df: pd.DataFrame) -> str:
    """Rows as "col: val, col: val", by blank lines; missing and blank cells and empty rows are left out. A cell is written by its column's type."""
    columns = [(str(c), df[c].isna().to_numpy(), df[c].tolist()) for c in df.columns]
    rows = (", ".join(f"{c}: {v[k]}" for c, none, v in columns if not none[k] and str(v[k]).strip()) for k in range(len(df)))
    return "\n\n".join(r for r in rows if r)


def csv_text(content: bytes) -> str:
    """UTF-8 CSV with a header; rows of too many cells are skipped."""
    return frame_text(pd.read_csv(io.BytesIO(content), encoding="utf-8", on_bad_lines="skip")) if content.strip() else ""


_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
#: Number formats that show dates (fixed values of the format's specification).
_DATE_FORMATS = frozenset((*range(14, 23), *range(45, 48)))


def _column(reference: str) -> int:
    n = 0
    for ch in reference:
        if not ch.isalpha():
            break
        n = n * 26 + ord(ch.upper()) - 64
    return n - 1


def xlsx_frame(content: bytes, sheet: int = 0) -> pd.DataFrame:
    """A sheet of an XLSX workbook, its first row as the header."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        tree = lambda name: ElementTree.fromstring(z.read(name))
        names = set(z.namelist())
        shared = ["".join(t.text or "" for t in si.iter(f"{_MAIN}t")) for si in tree("xl/sharedStrings.xml").iter(f"{_MAIN}si")] if "xl/sharedStrings.xml" in names else []
        dated: list[bool] = []
        if "xl/styles.xml" in names:
            styles = tree("xl/styles.xml")
            own = {int(f.get("numFmtId")): bool(re.search(r"[ymdhs]", re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", f.get("formatCode", "")), re.I)) for f in styles.iter(f"{_MAIN}numFmt")}
            cells = styles.find(f"{_MAIN}cellXfs")
            dated = [own.get(k := int(x.get("numFmtId", 0)), k in _DATE_FORMATS) for x in (cells if cells is not None else ())]
        book = tree("xl/workbook.xml")
        relations = {r.get("Id"): r.get("Target") for r in tree("xl/_rels/workbook.xml.rels")}
        target = relations[list(book.iter(f"{_MAIN}sheet"))[sheet].get(_RELATION)]
        properties = book.find(f"{_MAIN}workbookPr")
        origin = datetime(1904, 1, 1) if properties is not None and properties.get("date1904") in ("1", "true") else datetime(1899, 12, 30)
        rows: list[dict[int, object]] = []
        for row in tree(target.lstrip("/") if target.startswith("/") else f"xl/{target}").iter(f"{_MAIN}row"):
            line: dict[int, object] = {}
            for c in row.iter(f"{_MAIN}c"):
                at, kind, v = _column(c.get("r", "")) if c.get("r") else len(line), c.get("t", "n"), c.find(f"{_MAIN}v")
                if kind == "inlineStr":
                    line[at] = "".join(t.text or "" for t in c.iter(f"{_MAIN}t"))
                elif v is not None and v.text is not None:
                    if kind == "s":
                        line[at] = shared[int(v.text)]
                    elif kind == "b":
                        line[at] = v.text == "1"
                    elif kind == "n":
                        x = float(v.text)
                        style = int(c.get("s", 0))
                        line[at] = origin + timedelta(days=x) if style < len(dated) and dated[style] else int(x) if x.is_integer() and not re.search(r"[.eE]", v.text) else x
                    elif kind != "e":
                        line[at] = v.text
            rows.append(line)
    if not rows:
        return pd.DataFrame()
    width = max((max(r) + 1 for r in rows if r), default=0)
    names_ = [str(rows[0].get(k, f"Unnamed: {k}")) for k in range(width)]
    return pd.DataFrame({n if names_.index(n) == k else f"{n}.{names_[:k].count(n)}": [r.get(k) for r in rows[1:]] for k, n in enumerate(names_)})


def xlsx_text(content: bytes) -> str:
    return frame_text(xlsx_frame(content))


# --- protocol buffers ------------------------------------------------------------------------------------------------------------


def _varint(b: memoryview, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        if at >= len(b) or shift > 63:
            raise ValueError("truncated message")
        x = b[at]
        n |= (x & 0x7F) << shift
        at += 1
        if x < 0x80:
            return n, at
        shift += 7


def fields(b: memoryview) -> Iterator[tuple[int, int | memoryview]]:
    """(number, value) of the fields of a message: integers, or the bytes of the others."""
    at = 0
    while at < len(b):
        key, at = _varint(b, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(b, at)
            yield key >> 3, value
            continue
        if kind == 2:
            size, at = _varint(b, at)
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
        else:
            raise ValueError("unknown wire type")
        if at + size > len(b):
            raise ValueError("truncated message")
        yield key >> 3, b[at : at + size]
        at += size


def _packed(v: int | memoryview) -> Iterator[int]:
    if isinstance(v, int):
        yield v
        return
    at = 0
    while at < len(v):
        n, at = _varint(v, at)
        yield n


def _signed(n: int) -> int:
    return (n >> 1) ^ -(n & 1)


def _plain(n: int) -> int:
    return n - (1 << 64) if n >> 63 else n


def _tile_value(b: memoryview) -> object:
    for number, v in fields(b):
        match number:
            case 1:
                return bytes(v).decode("utf-8", "replace")
            case 2:
                return struct.unpack("<f", v)[0]
            case 3:
                return struct.unpack("<d", v)[0]
            case 4:
                return _plain(v)
            case 5:
                return v
            case 6:
                return _signed(v)
            case 7:
                return bool(v)
    return None


def tile_elements(content: bytes) -> list[dict]:
    """Features of a vector tile with their attributes; tipo is the layer. Gunzipped where needed; a damaged tile has none."""
    try:
        raw = memoryview(gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content)
        out = []
        for number, layer in fields(raw):
            if number != 3:
                continue
            name, features, keys, values = "", [], [], []
            for n, v in fields(layer):
                if n == 1:
                    name = bytes(v).decode("utf-8", "replace")
                elif n == 2:
                    features.append(v)
                elif n == 3:
                    keys.append(bytes(v).decode("utf-8", "replace"))
                elif n == 4:
                    values.append(_tile_value(v))
            for f in features:
                own, tags = 0, []
                for n, v in fields(f):
                    if n == 1:
                        own = v
                    elif n == 2:
                        tags += _packed(v)
                out.append({"tipo": name, "id": own, "tags": {keys[k]: str(values[x]) for k, x in zip(tags[::2], tags[1::2], strict=False)}})
        return out
    except (ValueError, IndexError, OSError, EOFError, zlib.error, TypeError):
        return []


def _blocks(content: bytes) -> Iterator[memoryview]:
    """Data blocks of an OSM file."""
    b, at = memoryview(content), 0
    while at < len(b):
        if at + 4 > len(b):
            raise ValueError("truncated file")
        size = struct.unpack(">I", b[at : at + 4])[0]
        head = dict(fields(b[at + 4 : at + 4 + size]))
        at += 4 + size
        blob = dict(fields(b[at : at + head[3]]))
        at += head[3]
        if bytes(head[1]) == b"OSMData":
            if 1 not in blob and 3 not in blob:
                raise ValueError("unknown compression")
            yield blob[1] if 1 in blob else memoryview(zlib.decompress(blob[3]))


#: Element kinds by their number in a group (fixed values of the format, and the words for them).
_KINDS = {1: "nodo", 3: "via", 4: "relacion"}


def osm_elements(content: bytes) -> list[dict]:
    """Nodes, ways and relations of an OSM file with their tags."""
    out = []
    for block in _blocks(content):
        table: list[str] = []
        groups = []
        for n, v in fields(block):
            if n == 1:
                table = [bytes(s).decode("utf-8", "replace") for k, s in fields(v) if k == 1]
            elif n == 2:
                groups.append(v)
        for group in groups:
            for n, v in fields(group):
                if n in _KINDS:
                    own, keys, vals = 0, [], []
                    for k, x in fields(v):
                        if k == 1:
                            own = _signed(x) if n == 1 else _plain(x)
                        elif k == 2:
                            keys += _packed(x)
                        elif k == 3:
                            vals += _packed(x)
                    out.append({"tipo": _KINDS[n], "id": own, "tags": {table[a]: table[z] for a, z in zip(keys, vals, strict=True)}})
                elif n == 2:
                    ids, pairs = [], []
                    for k, x in fields(v):
                        if k == 1:
                            ids += map(_signed, _packed(x))
                        elif k == 10:
                            pairs += _packed(x)
                    own, at = 0, 0
                    for step in ids:
                        own += step
                        tags = {}
                        while at < len(pairs) and pairs[at]:
                            tags[table[pairs[at]]] = table[pairs[at + 1]]
                            at += 2
                        at += 1
                        out.append({"tipo": "nodo", "id": own, "tags": tags})
    return out


# --- PDF -----------------------------------------------------------------------------------------------------------------------

_STREAM = re.compile(rb"<<((?:[^<>]|<<[^<>]*>>|<[^<>]*>)*)>>\s*stream\r?\n(.*?)\r?\n?endstream", re.S)
_OPERAND = re.compile(rb"\((?:[^()\\]|\\.|\((?:[^()\\]|\\.)*\))*\)|<[0-9A-Fa-f\s]*>|\[|\]|[-+]?\d*\.?\d+|/?[A-Za-z'\"*]+[\d*]*", re.S)
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}
_ESCAPE = re.compile(rb"\\([0-7]{1,3}|\r?\n|.)", re.S)


def _pdf_string(token: bytes) -> str:
    if token[:1] == b"<":
        digits = re.sub(rb"\s", b"", token[1:-1])
        raw = bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
    else:
        raw = _ESCAPE.sub(lambda m: bytes([int(m[1], 8) & 255]) if m[1][:1].isdigit() else b"" if m[1][-1:] == b"\n" else _ESCAPES.get(m[1], m[1]), token[1:-1])
    return raw.decode("utf-16-be", "replace") if raw[:2] == b"\xfe\xff" else raw.decode("cp1252", "replace")


def pdf_text(content: bytes) -> str:
    """Text of the content streams of a PDF in file order, plain or deflated, of fonts with a Latin encoding.

    Fonts with encodings of their own, encrypted files and scanned pages need a library: register it as the `pdf` plug-in.
    """
    pages = []
    for m in _STREAM.finditer(content):
        data = m[2]
        if b"FlateDecode" in m[1]:
            try:
                data = zlib.decompressobj().decompress(data)
            except zlib.error:
                continue
        elif b"Filter" in m[1]:
            continue
        if b"BT" not in data:
            continue
        out: list[str] = []
        operands: list[bytes] = []
        for t in _OPERAND.finditer(data):
            token = t.group()
            if token[:1] in b"(<[]/+-.0123456789":
                operands.append(token)
                continue
            if token in (b"Tj", b"TJ", b"'", b'"'):
                if token in (b"'", b'"'):
                    out.append("\n")
                for o in operands:
                    if o[:1] in b"(<":
                        out.append(_pdf_string(o))
                    elif token == b"TJ" and o[:1] not in b"[]/" and float(o) < -200:
                        out.append(" ")
            elif token in (b"T*", b"ET") or token in (b"Td", b"TD") and len(operands) >= 2 and operands[-1] not in (b"0", b"0.0"):
                out.append("\n")
            elif token in (b"Td", b"TD"):
                out.append(" ")
            operands = []
        text = "\n".join(filter(None, (re.sub(r"[ \t]+", " ", x).strip() for x in "".join(out).split("\n"))))
        if text:
            pages.append(text)
    return "\n\n".join(pages)
