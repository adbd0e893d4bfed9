"""Noise of scanned pages: words broken across lines, misread characters, running heads and page numbers; and the repaired text.

Per document, digits are masked and letters reduced to strokes to find lines that repeat as heads or feet; the wrapping shows
which lines were put between the lines of a paragraph. Over the corpus, words are grouped by the skeleton of strokes that
confusable glyphs share (rn and m, cl and d, 1 and l, @ and a ...); in each group a form far rarer than the most frequent one
is a misreading of it if it holds a foreign sign, or if the frequent form is at home among its neighbours; of several frequent
forms the likeliest is taken (frequency against letters that differ). Windows over the lines reflow the text into paragraphs.

Defined results: null, empty and blank texts have no lines. A text is taken for scanned if its lines are wrapped to a width,
whatever formato says, or if formato is an image format. Documents delivered again (same texto) count once.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumbrera.llm.labels import format_name
from lumbrera.session import written

IMAGES = ("png", "jpg", "tif", "bmp", "gif", "webp")
#: Strokes of confusable glyphs; every glyph is spelled out, so that equal strings of strokes may be misread for each other. Glyphs
#: that one sign can stand for share a stroke, so every word has one skeleton (fixed values).
STROKES = {
    **dict.fromkeys("ec", "c"), **dict.fromkeys("lr1|iI", "i"), **dict.fromkeys("o0ó6b8", "o"), **dict.fromkeys("nuh", "ii"), "m": "iii", "d": "ci", "w": "vv", "@": "a", "†": "t",
    **dict.fromkeys("áé", "á"), **dict.fromkeys("íf", "f"), **dict.fromkeys("çqg9", "q"), **dict.fromkeys("sã5", "s"),
}
#: A form is suspect if the most frequent form of its skeleton is this much more frequent; with a foreign sign in it the lower factor does.
RATIO, RATIO_SIGN = 12, 2
#: Foreign signs in a word.
SIGN = r"[@†|\\]|\p{L}\d|\d\p{L}"
#: From this factor on the neighbours need not agree; words of two letters are only suspect from it on, and then they must.
RATIO_ALONE = 60
#: Log-likelihood a differing letter costs.
EDIT = 2.4
#: Share of a suspect form's occurrences whose neighbours the frequent form must be known with.
CONTEXT = 0.5
HYPHENS = "-‐¬­"
#: Widths of the wrapping of a scan without an image format, widest width of an image that is wrapped at all, and the share of the line pairs that must fill it.
NARROW, WIDE, WIDE_IMAGE, FILLED = 30, 120, 200, 0.6
#: Longest page number in characters, and longest head in words.
FOLIO, HEAD_WORDS = 16, 14
_TOKEN = regex.compile(r"(?:[^\W_]+|[@†|]|\\/)+")
_RUN = regex.compile(r"[^\W_]+")
#: What makes a line more than words between white space and marks.
_ODD = re.compile(r"[@†|\\\d]|[./][^\W_]")
_JOINTS = re.compile("[-‐¬­]")
_LETTER = regex.compile(r"\p{L}")
_MEASURE = regex.compile(r"\d+(?:h\d*|º|ª|km|kg|m|s)")
_N = r"(?:[\dOolIS|]{1,4}|[ivxlIVXL]{1,6})"
_FOLIO = regex.compile(rf"(?i:(?:p[áa]g(?:ina|\.)?|page|p\.|folha|fls?\.|folio|hoja|s\.)\s*)?[-–—\[(·•|~*]*\s*{_N}\s*(?:(?:/|de|of|sur|\|)\s*{_N}\s*)?[-–—\])·•|~*.]*", regex.V0)
_HEAD = regex.compile(rf"(?:[-–—\[(|]?\s*{_N}\s*[-–—\])|]?(?:\s{{2,}}|\s+[|·•–—-]\s+))?(.*?)(?:(?:\s{{2,}}|\s+[|·•–—-]\s+)[-–—\[(|]?\s*{_N}\s*[-–—\])|]?)?")
_APART = regex.compile(r"\s[|·•–—-]\s")
_CLAUSES = regex.compile(r"[,;]|\.\s")
_ENDS = tuple(".,;:!?…»”\"'’)")


_TABLE = str.maketrans(STROKES)


def skeleton(word: str) -> str:
    """Strokes of a word in small letters."""
    return word.replace("\\/", "v").translate(_TABLE)


def _key(text: str) -> str:
    return skeleton(regex.sub(r"\s+", " ", regex.sub(r"\d+", "#", text)).strip().casefold())


def _roman_or_number(t: str) -> bool:
    return bool(regex.search(r"\d", t)) or bool(regex.fullmatch(r"\W*[ivxl]{1,6}\W*|\W*[IVXL]{1,6}\W*", t)) or bool(regex.fullmatch(r"(?i)(?:p[áa]g\w*\.?|page)\s*[\dOolI|]{1,4}\W*", t))


def read_lines(text: str, image: bool) -> list[dict]:
    """Lines of a scanned text with a first verdict each; an empty list if the text is not scanned.

    clase: c running head, d perhaps one (its key decides, over the corpus), f page number, b body, v blank.
    """
    lines = text.split("\n")
    full = [k for k, s in enumerate(lines) if s.strip()]
    first = {k: lines[k].split()[0] for k in full}
    pairs = [(a, b) for a, b in zip(full, full[1:], strict=False) if b == a + 1]
    # The width of the wrapping; heads and titles may be longer, so it is not the longest line.
    sizes = sorted(len(lines[k].rstrip()) for k in ([a for a, _ in pairs] or full))
    width = sizes[int(0.9 * (len(sizes) - 1))] if len(sizes) >= 10 else max(len(lines[k].rstrip()) for k in full)
    fills = lambda a, b: len(lines[a].rstrip()) + 1 + len(first[b]) >= width - 1 or lines[a].rstrip()[-1:] in HYPHENS
    wrapped = sum(fills(a, b) for a, b in pairs)
    if not image and (width > WIDE or sizes[-1] > 1.4 * width or width < NARROW or wrapped < 2 or wrapped < FILLED * len(pairs)):
        return []
    if image and width > WIDE_IMAGE and not pairs:
        width = 10**6
    folio = {k for k in full if len(lines[k].strip()) <= FOLIO and _FOLIO.fullmatch(lines[k].strip()) and _roman_or_number(lines[k].strip())}
    for k in list(folio):
        t = lines[k].strip()
        # The rest of a paragraph can be a number with a full stop: the line before runs on and leaves no room for it.
        if regex.fullmatch(r"\d+[.,]?|[ivxlIVXL]+\.?", t) and k - 1 in first and k - 1 not in folio and not (k + 1 in first) and not lines[k - 1].rstrip().endswith(_ENDS[:1]) and fills(k - 1, k) and t.endswith("."):
            folio.discard(k)
    start = full[0]
    text_of, numbered, key = {}, {}, {}
    for k in full:
        t = lines[k].strip()
        # A number stands apart from a head by two spaces or a sign.
        m = _HEAD.fullmatch(t) if "  " in t or _APART.search(t) else None
        inner = (m.group(1) if m else t).strip()
        if k == start or inner and inner[0].isupper() and inner[-1] not in _ENDS and inner[-1] not in HYPHENS and len(inner.split()) <= HEAD_WORDS:
            text_of[k], key[k] = inner, _key(inner)
            numbered[k] = bool(m) and inner != t and bool(regex.search(r"\d|\b[ivxl]+\b", t.replace(inner, "", 1)))
    alone = lambda k: k - 1 not in first and k + 1 not in first
    # A head is no sentence; one with a comma has to be the title of the document or carry a number.
    titles = {k for k, t in text_of.items() if k not in folio and len(key[k]) >= 4 and t[0].isupper() and (numbered[k] or key[k] == key[start] or not _CLAUSES.search(t))}
    open_ = Counter(key[k] for k in titles if not alone(k) or numbered[k])
    # Lines of a paragraph fill the width; of a repeated line some occurrence must not.
    loose = {key[k] for k in titles if numbered[k] or not alone(k) and (k + 1 not in first or k + 1 in folio or k - 1 in folio or not fills(k, k + 1))}
    out = []
    for k, s in enumerate(lines):
        if k not in first:
            clase = "v"
        elif k in folio:
            clase = "f"
        elif k == start or k not in titles:
            clase = "b"
        elif numbered[k] or key[k] == key[start] or (open_[key[k]] >= 2 and key[k] in loose and not alone(k)):
            clase = "c"
        else:
            short = k + 1 in first and k + 1 not in folio and not fills(k, k + 1)
            beside = k - 1 in folio or k + 1 in folio
            runs_on = k - 1 in first and k + 1 in first and lines[k + 1].lstrip()[:1].islower() and not lines[k - 1].rstrip().endswith((".", "!", "?", "…"))
            clase = "c" if short and runs_on and (beside or not fills(k, k + 1)) else "d" if short or beside or (k == full[-1] and not alone(k)) else "b"
        out.append({"linea": k, "texto": s, "clase": clase, "clave": key.get(k, "")})
    return out


def tokens_of(line: str) -> list[tuple[int, int, str]]:
    """(start, end, word in small letters) of the words of a line; parts of addresses and file names are left out."""
    if not _ODD.search(line):
        return [(*m.span(), w.lower()) for m in _RUN.finditer(line) if (w := m.group()).isalpha() or _LETTER.search(w)]
    out, n = [], len(line)
    for m in _TOKEN.finditer(line):
        a, b = m.span()
        w = m.group()
        if not w.isalpha() and (not (_LETTER.search(w) or regex.search(r"[@†|\\]", w)) or _MEASURE.fullmatch(w)):
            continue
        if b + 1 < n and line[b] in "./@" and line[b + 1].isalnum() or a >= 2 and line[a - 1] in "./@" and line[a - 2].isalnum():
            continue
        out.append((a, b, w.lower()))
    return out


def _once(docs: DataFrame, key: str = "doc_id", text: str = "texto", formato: str = "formato") -> DataFrame:
    """(key, _t, _i): every text with a letter or sign once (known by its hash), and whether its format is an image; the only shuffle of texts."""
    docs = docs.select(F.col(key).alias(key), F.col(text).alias("_t"), F.coalesce(format_name(F.col(formato)).isin(*IMAGES), F.lit(False)).alias("_i")).filter(F.col("_t").rlike(r"(?U)\S"))
    return docs.groupBy(key, F.xxhash64("_t").alias("_x")).agg(F.first("_t").alias("_t"), F.max("_i").alias("_i")).drop("_x")


def scanned_lines(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, linea, texto, tipo) of texts as _once gives them: the lines of scanned texts; tipo is cabecera, folio, cuerpo or vacia."""

    kind = docs.schema[key].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [read_lines(t, bool(i)) for t, i in zip(batch.column("_t").to_pylist(), batch.column("_i").to_pylist(), strict=True)]
            rows = [r for own in found for r in own]
            keys = batch.column(key).take(pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found])))
            yield pa.RecordBatch.from_arrays([keys, *(pa.array([r[c] for r in rows], t) for c, t in (("linea", pa.int32()), ("texto", pa.string()), ("clase", pa.string()), ("clave", pa.string())))], [key, "linea", "texto", "clase", "clave"])

    rows = written(docs.select(key, "_t", "_i").mapInArrow(read, f"`{key}` {kind}, linea int, texto string, clase string, clave string"))
    # A line that may be a head is one if another document has its text more often as a head than in the body: keys are compared over the corpus.
    sure = rows.filter("clase in ('c', 'b')").groupBy("clave").agg(F.count_if(F.col("clase") == "c").alias("c"), F.count_if(F.col("clase") == "b").alias("b")).filter("c > b").select("clave", F.lit(True).alias("_sure"))
    rows = rows.filter("clase <> 'd'").withColumn("_sure", F.lit(None).cast("boolean")).unionByName(rows.filter("clase = 'd'").join(sure, "clave", "left").select(*rows.columns, "_sure"))
    tipo = F.when(F.col("clase") == "v", "vacia").when(F.col("clase") == "f", "folio").when((F.col("clase") == "c") | F.coalesce("_sure", F.lit(False)), "cabecera").otherwise("cuerpo")
    return rows.select(key, "linea", "texto", tipo.alias("tipo"))


def _line_words(here: list[str], after: list[str | None], before: list[str | None]) -> Iterator[tuple[int, int, int, int, str, str | None, str | None, str | None]]:
    """(index of the line, place, start, end, word, roto, word before, word after) of the words of lines given with the lines after and before them."""
    known: dict[str | None, list] = {None: []}

    def tokens(s: str | None) -> list[tuple[int, int, str]]:
        if s not in known:
            known[s] = tokens_of(s)
        return known[s]

    for i, (s, n, p) in enumerate(zip(here, after, before, strict=True)):
        toks = tokens(s)
        if not toks:
            continue
        open_, goes_on = _broken(s, n), _broken(p, s) and s.lstrip()[:1] == s[toks[0][0] : toks[0][0] + 1]
        start, stop = int(goes_on), len(toks) - int(open_)
        if goes_on and stop:
            yield (i, 0, *toks[0], "b", None, None)
        above, below = tokens(p), tokens(n)
        above, below = above[:-1] if goes_on else above, below[1:] if open_ else below
        last = above[-1][2] if above else None
        for k in range(start, stop):
            yield (i, k, *toks[k], None, last, toks[k + 1][2] if k + 1 < stop else below[0][2] if below else None)
            last = toks[k][2]
        if open_:
            head = tokens_of(n.lstrip())
            a, b, w = toks[-1]
            yield (i, len(toks) - 1, a, b, w + "-" + (head[0][2] if head and head[0][0] == 0 else ""), "a", None, None)


def _body_words(lines: DataFrame, key: str) -> DataFrame:
    """Words of the body lines with the words before and after (a, z); a word broken over two lines is one row of its first line (roto a: with the rest joined) and one of the second (roto b), and no neighbour. arriba is the body line above."""
    w = Window.partitionBy(key).orderBy("linea")
    body = lines.filter("tipo = 'cuerpo'").select(key, "linea", F.lag("linea").over(w).alias("arriba"), "texto", F.lead("texto").over(w).alias("sigue"), F.lag("texto").over(w).alias("previa"))
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.string())

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, *columns = list(zip(*_line_words(*(batch.column(c).to_pylist() for c in ("texto", "sigue", "previa"))), strict=True)) or [()] * 8
            own = [batch.column(c).take(pa.array(at, pa.int32())) for c in (key, "linea", "arriba")]
            yield pa.RecordBatch.from_arrays([*own, *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], [key, "linea", "arriba", "k", "ini", "fin", "w", "roto", "a", "z"])

    return body.mapInArrow(words, f"`{key}` {lines.schema[key].dataType.simpleString()}, linea int, arriba int, k int, ini int, fin int, w string, roto string, a string, z string")


def _broken(line: str | None, after: str | None) -> bool:
    """Whether a line ends in the first part of a word and the next begins with a small letter (or a sign read for one)."""
    if not line or not after:
        return False
    t = line.rstrip()
    return len(t) >= 2 and t[-1] in HYPHENS and (t[-2].isalnum() or t[-2] in "@†|/") and bool(regex.match(r"[\p{Ll}@†|\\\d]", after.lstrip()))


def _skeleton(word: Column | str) -> Column:
    """skeleton() in the JVM."""
    out = F.replace(F.col(word) if isinstance(word, str) else word, F.lit("\\/"), F.lit("v"))
    one = "".join(c for c, t in STROKES.items() if len(t) == 1)
    # Glyphs of several strokes first: their strokes are not glyphs to be read again.
    for glyphs, strokes in ((c, t) for c, t in STROKES.items() if len(t) > 1):
        out = F.replace(out, F.lit(glyphs), F.lit(strokes.upper()))
    return F.lower(F.translate(out, one, "".join(STROKES[c] for c in one)))


def _likely(n: Column, form: Column, seen: Column) -> Column:
    """How likely a frequent form is what was misread (noisy channel): its frequency, and a factor for every letter that differs."""
    return F.log(n) - EDIT * F.levenshtein(form, seen)


def lexicon(docs: DataFrame) -> DataFrame:
    """(w, n): words and words with hyphens inside a line, in small letters, counted over all documents; a batch hands on each word once."""

    def one(t: str) -> Iterator[str]:
        for line in t.split("\n"):
            if not _JOINTS.search(line) and not _ODD.search(line):
                yield from (w for w in map(str.lower, _RUN.findall(line)) if w.isalpha() or _LETTER.search(w))
                continue
            toks = tokens_of(line)
            stop = len(line.rstrip())
            yield from (x for a, b, x in toks if not (b == stop - 1 and line[b] in HYPHENS))
            if "-" in line or "‐" in line:
                yield from (line[a:d].lower() for (a, b, _), (c, d, _) in zip(toks, toks[1:], strict=False) if c == b + 1 and line[b] in "-‐")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter[str] = Counter()
            for t in batch.column("_t").to_pylist():
                counts.update(one(t))
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["w", "n"])

    return docs.select("_t").mapInArrow(words, "w string, n bigint").groupBy("w").agg(F.sum("n").alias("n"))


def misread_forms(words: DataFrame, counts: DataFrame) -> DataFrame:
    """(w, forma): forms taken for misreadings and the form they stand for; words (w, and where known its neighbours a and z).

    Every form is compared with all those of its skeleton that are at least RATIO_SIGN times as frequent; the context is checked by joins on bigrams.
    """
    forms = counts.filter(~F.col("w").contains("-")).withColumn("sk", _skeleton("w"))
    # All forms of a skeleton that can be right; the ratio is a condition of the join, so only pairs it admits come out.
    best = forms.filter((F.length("w") >= 2) & (F.col("n") >= RATIO_SIGN)).select("sk", F.struct("n", F.col("w").alias("c")).alias("b"))

    pairs = forms.join(best, "sk").filter((F.col("w") != F.col("b.c")) & (F.col("b.n") >= RATIO_SIGN * F.col("n"))).select("w", "n", F.col("b.n").alias("cn"), F.col("b.c").alias("c")).distinct()
    sign = F.col("w").rlike(SIGN)
    # Forms that differ in accents only are spellings, not misreadings.
    plain = lambda c: F.translate(c, "áéíóúàèìòùâêîôûãõäëïöüç", "aeiouaeiouaeiouaoaeiouc")
    pairs = pairs.filter((plain(F.col("w")) != plain(F.col("c"))) & (F.length("c") >= 2))
    pairs = pairs.filter(F.when(sign, F.col("cn") >= RATIO_SIGN * F.col("n")).otherwise(F.col("cn") >= F.when(F.length("c") >= 3, RATIO).otherwise(RATIO_ALONE) * F.col("n"))).withColumn("sign", sign)
    pairs = pairs.groupBy("w", "n", "sign").agg(F.max(F.struct(_likely(F.col("cn"), F.col("c"), F.col("w")).alias("l"), "cn", "c")).alias("b"))
    pairs = written(pairs.select("w", "n", "sign", "b.cn", "b.c"))
    # Only the neighbours of suspects and of the forms they may stand for are looked at.
    near = words.select("w", *(F.col(c) if c in words.columns else F.lit(None).cast("string").alias(c) for c in ("a", "z")))
    near = written(near.join(pairs.select(F.explode(F.array("w", "c")).alias("w")).distinct(), "w", "left_semi"))
    left, right = (near.filter(F.col(c).isNotNull()).groupBy(c, "w").agg(F.count("*").alias("m")) for c in ("a", "z"))
    doubt = near.join(pairs.filter(~F.col("sign")).select("w", "c"), "w")
    at_home = doubt.join(left.select("a", F.col("w").alias("c"), F.col("m").alias("ma")), ["a", "c"], "left").join(right.select("z", F.col("w").alias("c"), F.col("m").alias("mz")), ["z", "c"], "left")
    known = at_home.groupBy("w").agg(F.avg(F.when(F.col("ma").isNotNull() | F.col("mz").isNotNull(), 1.0).otherwise(0.0)).alias("share"))
    return pairs.join(known, "w", "left").filter(F.col("sign") | (F.col("share") >= CONTEXT) | ((F.length("c") >= 3) & (F.col("cn") >= RATIO_ALONE * F.col("n")))).select("w", F.col("c").alias("forma"))


def scan_words(docs: DataFrame, lines: DataFrame, key: str = "doc_id") -> DataFrame:
    """Words of the body lines that are misread or broken, with what is wrong: forma (the right form of a misread word), union (whether a broken word loses its hyphen)."""
    counts = written(lexicon(docs))
    words = written(_body_words(lines, key))
    # Broken words: the joined form and the compound are looked up by skeleton, so that misread parts do not hide them.
    broken = words.filter("roto = 'a'").select(key, "linea", "k", F.split("w", "-").alias("x")).select(key, "linea", "k", F.element_at("x", 1).alias("w1"), F.element_at("x", 2).alias("w2"))
    by_sk = counts.withColumn("sk", _skeleton(F.regexp_replace("w", "‐", "-"))).select("sk", "n", F.col("w").alias("c"))
    joined = broken.select("w1", "w2").distinct().withColumn("_s", F.concat("w1", "w2"))
    # Of the forms of its skeleton the likeliest is taken.
    met = joined.withColumn("sk", _skeleton("_s")).join(by_sk, "sk").groupBy("w1", "w2").agg(F.max("n").alias("nj"), F.max(F.when(F.col("c") != F.col("_s"), F.struct(_likely(F.col("n"), F.col("c"), F.col("_s")).alias("l"), "n", "c"))).alias("b"))
    apart = joined.withColumn("sk", _skeleton(F.concat_ws("-", "w1", "w2"))).join(by_sk, "sk").groupBy("w1", "w2").agg(F.max("n").alias("nc"))
    broken = broken.join(met, ["w1", "w2"], "left").join(apart, ["w1", "w2"], "left")
    broken = broken.join(counts.select(F.col("w").alias("_j"), F.col("n").alias("nx")), F.concat("w1", "w2") == F.col("_j"), "left")
    for part in ("w1", "w2"):
        broken = broken.join(counts.select(F.col("w").alias(part), F.col("n").alias(f"n_{part}")), part, "left")
    nj, nc = F.coalesce("nj", F.lit(0)), F.coalesce("nc", F.lit(0))
    # Never met in one piece: a compound if both parts are words of their own.
    whole = F.when(nj + nc > 0, nj >= nc).otherwise(~((F.coalesce("n_w1", F.lit(0)) >= 5) & (F.coalesce("n_w2", F.lit(0)) >= 5)))
    # The word as it stands, unless it is itself far rarer than a form it may be a misreading of; with a foreign sign in it the lower factor does.
    ratio = F.when(F.col("_j").rlike(SIGN), RATIO_SIGN).otherwise(RATIO)
    stands = F.col("nx").isNotNull() & (F.col("nx") * ratio > F.coalesce("b.n", F.lit(0)))
    form = F.when(stands, F.col("_j")).otherwise(F.col("b.c"))
    broken = broken.select(key, "linea", "k", whole.alias("union"), F.when(whole, form).alias("junta"), "w1", "w2")
    wrong = misread_forms(words.filter("roto is null").select("w", "a", "z"), counts)
    plain = words.filter("roto is null").join(wrong, "w", "left")
    number = F.col("w").rlike(r"^(?=.*\d)(?=.*[lo|sbzi])[\dlo|sbzi]+$") | F.col("w").isin("ll", "lo0", "l1", "1l")
    plain = plain.select(key, "linea", "k", "ini", "fin", "w", "roto", F.coalesce("forma", F.when(number, F.translate("w", "lo|sbzi", "1015821"))).alias("forma"), F.lit(None).cast("boolean").alias("union"), F.lit(None).cast("string").alias("junta")).filter("forma is not null")
    first = words.filter("roto = 'a'").select(key, "linea", "k", "ini", "fin", "roto").join(broken, [key, "linea", "k"])
    first = first.select(key, "linea", "k", "ini", "fin", F.col("w1").alias("w"), "roto", F.when(~F.startswith(F.col("junta"), F.col("w1")), F.col("junta")).alias("forma"), "union", "junta")
    # The second part belongs to the broken word of the body line above.
    joined = broken.select(key, F.col("linea").alias("arriba"), "junta")
    rest = words.filter("roto = 'b'").select(key, "linea", "arriba", "k", "ini", "fin", "w", "roto").join(joined, [key, "arriba"], "left")
    rest = rest.select(key, "linea", "k", "ini", "fin", "w", "roto", F.when(~F.endswith(F.col("junta"), F.col("w")), F.col("junta")).alias("forma"), F.lit(None).cast("boolean").alias("union"), "junta")
    return plain.unionByName(first).unionByName(rest)


def noisy_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, linea, tipo): cabecera and folio lines, and body lines with a word to join (guion) or a misread character (caracter)."""
    docs = written(_once(docs))
    lines = written(scanned_lines(docs))
    words = written(scan_words(docs, lines))
    put = lambda df, t: df.select("doc_id", "linea", F.lit(t).alias("tipo"))
    out = lines.filter(F.col("tipo").isin("cabecera", "folio")).select("doc_id", "linea", "tipo")
    return out.unionByName(put(words.filter("roto = 'a' and union"), "guion")).unionByName(put(words.filter("forma is not null"), "caracter")).distinct()


def repaired_paragraphs(docs: DataFrame) -> DataFrame:
    """(doc_id, parrafo, texto): continuous paragraphs of scanned texts. Heads and page numbers are dropped; a paragraph goes on over them unless a blank line follows a finished sentence."""
    docs = written(_once(docs))
    lines = written(scanned_lines(docs))
    words = scan_words(docs, lines)
    fixes = words.filter("forma is not null or union is not null").groupBy("doc_id", "linea").agg(F.array_sort(F.collect_list(F.struct("ini", "fin", "w", "roto", "forma", "union", "junta"))).alias("cambios"))

    @F.pandas_udf("string")
    def mend(texts: pd.Series, changes: pd.Series) -> pd.Series:
        def one(t: str, c) -> str:
            if c is None:
                return t
            for x in reversed(list(c)):
                a, b, f = x["ini"], x["fin"], x["forma"]
                if x["roto"] == "a":
                    tail = t[b:].strip()
                    part = f[: len(x["w"])] if f and x["junta"] else t[a:b]
                    t = t[:a] + part + ("\u0001" if x["union"] else tail[:1] + "\u0001")
                elif f is not None and x["roto"] is None:
                    f = f.upper() if t[a:b].isupper() and b - a > 1 else f.capitalize() if t[a].isupper() else f
                    t = t[:a] + f + t[b:]
                elif f is not None:
                    t = t[:a] + f[len(f) - min(len(f), b - a) :] + t[b:]
            return t

        return pd.Series([one(t, c) for t, c in zip(texts, changes, strict=True)])

    w = Window.partitionBy("doc_id").orderBy("linea")
    lines = lines.withColumn("_q", F.sum(F.col("tipo").isin("cabecera", "folio").cast("int")).over(w))
    body = lines.filter("tipo in ('cuerpo', 'vacia')").join(fixes, ["doc_id", "linea"], "left").withColumn("s", F.regexp_replace(mend("texto", "cambios"), r"(?U)^\s+|\s+$", ""))
    body = body.withColumn("_full", F.col("s") != "")
    body = body.withColumn("_blank", ~F.coalesce(F.lag("_full").over(w), F.lit(False))).filter("_full").withColumn("_prev", F.lag("s").over(w)).withColumn("_break", F.col("_q") > F.lag("_q").over(w))
    # A blank line ends a paragraph unless it comes of a page break and the open sentence before goes on in small letters.
    starts = F.col("_prev").isNull() | (F.col("_blank") & ~(F.col("_break") & (~F.col("_prev").rlike(r"[.!?…:»”\")]$")) & F.col("s").rlike(r"^\p{Ll}")))
    body = body.withColumn("parrafo", F.sum(F.when(starts, 1).otherwise(0)).over(w).cast("int") - 1)
    joined = body.groupBy("doc_id", "parrafo").agg(F.array_sort(F.collect_list(F.struct("linea", "s"))).alias("l"))
    return joined.select("doc_id", "parrafo", F.regexp_replace(F.array_join(F.transform("l", lambda x: x["s"]), " "), "\u0001 ?", "").alias("texto"))

