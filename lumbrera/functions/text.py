"""Column functions over text. All run in the JVM except NFC, which Spark has no built-in for."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Months whose "month year" stamps are dropped (fixed values).
MONTHS = "january february march april may june july august september october november december enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre".split()
#: Characters a token has on average; only a budget estimate (fixed value).
CHARS_PER_TOKEN = 3.7
#: Function words of the default language vote (fixed values).
VOTE_WORDS = {
    "es": "el la los las de que y en un una por con para su al del se lo como más pero es son".split(),
    "en": "the of and to in is was for that with on by at from were it be are this which".split(),
    "pt": "o os as do da dos das em um uma não por mais na no nas nos ao pela pelo com são".split(),
}


def strip(c: Column) -> Column:
    """Both ends without white space of any kind (trim() knows only U+0020)."""
    return F.regexp_replace(c, r"(?U)\A\s+|\s+\z", "")


def not_blank(c: Column) -> Column:
    return F.coalesce(c.rlike(r"(?U)\S"), F.lit(False))


def collapse_spaces(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def nfc(c: Column) -> Column:
    @F.pandas_udf("string")
    def compose(s: pd.Series) -> pd.Series:
        return s.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFC", t))

    return compose(c)


def clean_text(c: Column, compose: bool = True) -> Column:
    """Extracted text without control characters, page marks, lone numbers, links and month stamps; null stays null."""
    steps = (
        ("[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]", ""),
        (r"(?iuU)\b(?:página|pág|page)\s+\d+(?:\s+(?:de|of)\s+\d+)?\b", ""),
        (r"(?mdU)^\s*\d+\s*$", ""),
        (r"(?U)https?://\S+|www\.\S+", ""),
        (rf"(?iuU)\b(?:{'|'.join(MONTHS)})\s+\d{{4}}\b", ""),
        ("[ \\t]+", " "),
        ("\\n{3,}", "\n\n"),
    )
    out = nfc(c) if compose else c
    for pattern, new in steps:
        out = F.regexp_replace(out, pattern, new)
    return strip(out)


def language_vote(c: Column) -> Column:
    """es, en or pt by the function words of the first thousand characters; short or null texts and ties go to the earlier of the three."""
    head = F.substring(c, 1, 1000)
    words = F.split(F.lower(head), r"(?U)[^\p{L}]+")
    votes = lambda own: F.size(F.filter(words, lambda w: w.isin(own)))
    score = {lang: votes(own) for lang, own in VOTE_WORDS.items()}
    top = F.greatest(*score.values())
    return F.when(c.isNull() | (F.length(strip(c)) < 20), "es").when(score["es"] == top, "es").when(score["en"] == top, "en").otherwise("pt")


def supported_language(c: Column) -> Column:
    """Language names and codes as es, en or pt; anything else is es."""
    low = F.lower(c)
    return F.when(low.isin("en", "english"), "en").when(low.isin("pt", "portuguese"), "pt").otherwise("es")


def regex_sentences(c: Column) -> Column:
    """Pieces of a text after . ! or ? and white space; blank pieces dropped."""
    return F.filter(F.split(strip(c), r"(?U)(?<=[.!?])\s+"), lambda s: s != "")


def word_count(c: Column) -> Column:
    return F.coalesce(F.size(F.filter(F.split(c, r"(?U)\s+"), lambda w: w != "")), F.lit(0))


def token_estimate(c: Column) -> Column:
    return F.coalesce(F.ceil(F.length(c) / F.lit(CHARS_PER_TOKEN)).cast("int"), F.lit(0))


def chunk_id(doc: Column, position: Column) -> Column:
    """doc-chunk-007; grows past 999."""
    return F.format_string("%s-chunk-%03d", doc, position)


def slashes(c: Column) -> Column:
    return F.replace(c, F.lit("\\"), F.lit("/"))


def phenomenon_number(path: Column) -> Column:
    """Number after the first F of a path part like F2_space; 0 without one."""
    return F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(path, r"[Ff](\d{1,9})_", 1), F.lit("")), F.lit("999999999")).cast("int"), F.lit(0))


def path_key(path: Column, prefix: str = "data/raw/") -> Column:
    p = slashes(path)
    return F.when(F.startswith(p, F.lit(prefix)), F.substring(p, len(prefix) + 1, 100_000)).otherwise(p)


def entity_key(c: Column) -> Column:
    return F.lower(strip(c))


def row_text(names: list[str]) -> Column:
    """Cells of a row as "name: value, name: value"; null and blank cells are left out."""
    cells = [F.when(not_blank(F.col(n).cast("string")), F.concat(F.lit(f"{n}: "), F.col(n).cast("string"))) for n in names]
    return F.concat_ws(", ", *cells)
