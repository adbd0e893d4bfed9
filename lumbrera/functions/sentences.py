"""Rule-based sentence splitter for es, en and pt: abbreviations, initials, decimals and ellipses do not end a sentence."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Abbreviations a name or number follows (fixed values).
ABBREVIATIONS = {
    "es": frozenset("sr sra srta dr dra ing lic gral cnel prof art núm pág págs cap fig vol ej etc av depto p".split()),
    "en": frozenset("mr mrs ms dr prof gen col lt sgt rev hon st no vol fig sec ch jr sr inc ltd vs p pp e.g i.e".split()),
    "pt": frozenset("sr sra dr dra eng prof gen cel art núm pág cap fig vol ex av p".split()),
}
_END = re.compile(r"[.!?…]+[\"'”’»)\]]*(?=\s)")
_NEXT = re.compile(r"\s*(\S)")
_LETTER = re.compile(r"[^\W\d_]")
_DOTTED = re.compile(r"(?:[^\W\d_]{1,2}\.)+[^\W\d_]{1,2}")
_BEFORE = frozenset("(«“\"¿¡")


def _word_before(text: str, at: int) -> str:
    """What stands between `at` and the white space or opening mark before it; no letter belongs to two ends, so a text is read once."""
    k = at
    while k and not (text[k - 1] in _BEFORE or text[k - 1].isspace()):
        k -= 1
    return text[k:at]


def split_sentences(text: str | None, language: str | None = "es") -> list[str]:
    """Sentences, trimmed, none blank; a language without rules uses those of es. Time in proportion to the text."""
    if not text or not text.strip():
        return []
    known = ABBREVIATIONS.get(language or "es", ABBREVIATIONS["es"])
    cuts = [0]
    for m in _END.finditer(text):
        after = _NEXT.match(text, m.end())
        if not after:
            break
        dots = m.group().rstrip("\"'”’»)]")
        goes_on = after[1].islower()
        if dots == ".":
            word = _word_before(text, m.start()).lower()
            if goes_on or word.rstrip(".") in known or _LETTER.fullmatch(word) or _DOTTED.fullmatch(word):
                continue
        elif goes_on and set(dots) <= {".", "…"}:
            continue
        cuts.append(m.end())
    return [s for a, b in zip(cuts, [*cuts[1:], len(text)], strict=True) if (s := text[a:b].strip())]


def sentences(text: Column, language: Column) -> Column:
    @F.pandas_udf("array<string>")
    def split(t: pd.Series, lang: pd.Series) -> pd.Series:
        return pd.Series([split_sentences(a, b) for a, b in zip(t, lang, strict=True)])

    return split(text, language)
