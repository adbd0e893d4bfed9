"""Normal forms of dirty labels: formats and language names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Other names of the two-letter codes in results (fixed values: ISO 639-2 codes and the languages' own and common names).
LANGUAGE_NAMES = {
    "es": "spa esp spanish español espanol castellano espanhol espagnol",
    "en": "eng ing english inglés ingles inglês anglais",
    "pt": "por portuguese português portugues portugués portugais",
    "fr": "fra fre french français francais francés frances francês",
    "zh": "zho chi cmn chinese 中文 汉语 漢語 chino chinês chinois mandarin",
    "ja": "jpn jp japanese 日本語 japonés japones japonês japonais",
    "ar": "ara arabic العربية عربي árabe arabe",
    "hi": "hin hindi हिन्दी हिंदी",
    "th": "tha thai ไทย ภาษาไทย tailandés tailandês thaï",
}
LANGUAGES = tuple(LANGUAGE_NAMES)


def language_code(label: Column) -> Column:
    """Two-letter code a label stands for; null where it is missing, stands for "unknown" or names none of LANGUAGES (see `names_other`)."""
    s = F.lower(F.regexp_replace(label, r"(?U)^\s+|\s+$", ""))
    base = F.regexp_replace(s, r"[-_].*$", "")
    pairs = [F.lit(x) for code, names in LANGUAGE_NAMES.items() for n in (code, *names.split()) for x in (n, code)]
    known = F.create_map(*pairs)
    return F.coalesce(F.try_element_at(known, s), F.try_element_at(known, base))


def format_name(label: Column) -> Column:
    """Lower-case format without dots and white space; htm is html, jpeg jpg, tiff tif; blank is null."""
    s = F.regexp_replace(F.lower(label), r"(?U)^[\s.]+|\s+$", "")
    s = F.when(s == "htm", "html").when(s == "jpeg", "jpg").when(s == "tiff", "tif").otherwise(s)
    return F.nullif(s, F.lit(""))
