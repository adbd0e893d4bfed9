"""Language of documents and of the stretches of mixed documents, whatever the label says.

The script of a word narrows its candidate languages (kana, Han, Arabic, Devanagari, Thai, Latin). Words of the Latin script
have a score in each candidate: how often paragraphs of a bounded sample that fixed lists of function words label clearly hold
the word, and its three-letter strings and accents where the word is rare (the documents' own labels are not used, and a
paragraph without clear function words teaches nothing). A Viterbi path over all words of a document, with a penalty for a
switch of language that is smaller between paragraphs, labels every word; a paragraph has the language of most of its words,
equal neighbours form a stretch. The confidence comes of the margin over the runner-up, calibrated on held-out paragraphs
whose function words are taken away.

Defined results: null, empty and blank texts, and texts without a letter, have no language (a null one for the document).
Paragraphs are split at "\\n\\n" and counted from 0, blank ones included; blank ones get no row; one without letters takes the
language around it. Copies count once: they are dropped from the small results, so that no text is shuffled.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbrera.llm.bpe import spans
from lumbrera.llm.labels import LANGUAGES, language_code

#: Function words that label the sample (fixed values).
FUNCTION_WORDS = {
    "es": "el los las y del al un una que en con por para su se lo como más pero sus ya sin sobre también hasta hay desde durante según tras ante mientras es son fue fueron cuando donde esta este muy entre no o",
    "en": "the of and to is was for that with on by at from were it be are this which had has an not but their its while after under when where these those than into over between or",
    "pt": "o os as e em um uma do da dos das não com na nas ao aos pela pelo sua seu são ou quando já também foi até isso entre depois sem mesmo segundo enquanto após mais que para por onde muito",
    "fr": "le les des du et en un une que qui dans pour pas sur au aux avec est son sa ses ce cette par plus ne ou mais sont il elle leur été selon après tandis où sans entre être",
}
LATIN = tuple(FUNCTION_WORDS)
#: Letters and the languages that write them (fixed values).
WRITTEN_IN = {**dict.fromkeys("ãõ", "pt"), "ñ": "es", **dict.fromkeys("áíóú", "es pt"), "é": "es pt fr", **dict.fromkeys("âêô", "pt fr"), "à": "pt fr", **dict.fromkeys("èùîûïëœ", "fr"), "ç": "pt fr", "ü": "es fr"}
#: Spellings and the languages they are usual in, as against the others of LATIN (fixed values).
SPELLINGS = tuple(
    (regex.compile(rx), of.split())
    for rx, of in (
        (r"ci[óo]n(?:es)?$|ñ|^ll|ll[aeo]s?$|dad(?:es)?$|[aeiou]j[ao]s?$", "es"),
        (r"^[^áéíóúâêô]*[^aeiouáéíóúâêôf](?:a|e|i|o|u)[cpdnlsg]i[oa]s?$|[^aeiouáéíóúâêô][aio]ri[oa]s?$|^[^áéíóúâêô]*[aei]vel$|[aeo]blem?ente$", "es"),
        (r"ç[ãõ]|[ãõ][oe]s?$|nh[aeo]|lh[aeo]|[aeo]ix[ao]|[áí]vel$|[íá]veis$|[áéíóúâêô][^aeiou]{1,2}i[oa]s?$|ss[ãa]o$|ou$|ei[rt][ao]s?$", "pt"),
        (r"th|wh|ck|gh|sh|w$|ct$|ing$|ness$|ly$|[bcdfgklmnprstvz]ed$|ee|oo", "en"),
        (r"tions?$", "en fr"),
        (r"eau|eux$|[eé]es?$|ée|oi[rst]|œ|qu['’]|aux$|ieu", "fr"),
    )
)
#: Common words of tables, dates and places, with which rows that hold no function word can be told (fixed values).
COMMON = {
    "es": "año años mes día fecha nombre tipo total lugar nivel municipio departamento provincia región país ciudad valor dato datos registro nota caso casos bajo medio alto población número código área estado índice fuente título autor enero febrero mayo julio",
    "en": "year month day date name type total place level district county state region country city value data record note case cases low medium high population number code area status index source title author january february may july",
    "pt": "ano anos mês dia data nome tipo total lugar nível município departamento província região país cidade valor dado dados registro nota caso casos baixo médio alto população número código área estado índice fonte título autor janeiro fevereiro maio julho",
    "fr": "an année mois jour date nom type total lieu niveau commune département province région pays ville valeur donnée données registre note cas bas moyen haut population numéro code zone état indice source titre auteur janvier février mai juillet",
}
#: Texts whose paragraphs teach, about (at most twice as many), how many paragraphs of a text at most, and the longest that does.
SAMPLE, PARAGRAPHS, PARAGRAPH = 2_000, 50, 5_000
#: Clear function words: by how many those of a language exceed those of any other.
CLEAR = 2
SWITCH_WORD, SWITCH_PARAGRAPH = 12.0, 3.0
#: Lowest score of a word in a language; occurrences that speak against nothing yet.
FLOOR, DOUBT = -4.0, 0.5
_WORD = regex.compile(r"[\p{Hiragana}\p{Katakana}ー]+|\p{Han}+|[\p{Thai}]+|[\p{Arabic}\p{M}]+|[\p{Devanagari}\p{M}]+|[\p{Latin}\p{M}]+|[^\W\d_]+")
_LATIN = regex.compile(r"\p{Latin}")
_SCRIPTS = tuple(
    (regex.compile(rx), tuple(of.get(c, -8.0) for c in LANGUAGES))
    for rx, of in ((r"[\p{Hiragana}\p{Katakana}]", {"ja": 0.0}), (r"\p{Han}", {"zh": 0.0, "ja": -0.7}), (r"\p{Arabic}", {"ar": 0.0}), (r"\p{Devanagari}", {"hi": 0.0}), (r"\p{Thai}", {"th": 0.0}))
)
_ENDS = tuple(".!?…»”\"।؟。")
_LEAD = " «“\"'(¿¡—–-[{"
#: Strings between white space that a worker keeps, and the longest of them.
KEPT, KEPT_LENGTH = 400_000, 40
#: Strings whose scores are held at a time, about; paragraphs stay whole.
BLOCK = 100_000
_N = len(LANGUAGES)
# LATIN stands first in LANGUAGES.
_OTHERS = (1.1 * FLOOR,) * (_N - len(LATIN))
_AS_NAME = (0.0,) * len(LATIN) + (-0.5,) * (_N - len(LATIN))


def _relative(counts: list[dict[str, int]], keys: list[str], floor: float, doubt: float) -> dict[str, tuple[float, ...]]:
    """Log of how often a key is met in a language against what the language it is most frequent in lets expect.

    A language of which little was seen is held to what it lets expect, so unlike sizes of the languages' samples tilt nothing.
    """
    totals = [max(1, sum(c.values())) for c in counts]
    out = {}
    for k in keys:
        n = [c.get(k, 0) for c in counts]
        top = max(x / t for x, t in zip(n, totals, strict=True))
        logs = [math.log((x + doubt) / (t * top + doubt)) for x, t in zip(n, totals, strict=True)]
        out[k] = tuple(max(x - max(logs), floor) for x in logs)
    return out


@dataclass
class Model:
    """Scores of Latin-script words and of three-letter strings, in the order of LATIN, and the slope and offset of the confidence."""

    words: dict[str, tuple[float, ...]]
    grams: dict[str, tuple[float, ...]]
    slope: float = 2.0
    offset: float = 0.0
    own: dict[str, tuple[float, ...]] = field(default_factory=dict)

    def spelling(self, word: str) -> list[float]:
        w = f"<{word}>"
        parts = [p for k in range(len(w) - 2) if (p := self.grams.get(w[k : k + 3]))]
        sums = [0.5 * sum(p[c] for p in parts) for c in range(len(LATIN))] if parts else [0.0] * len(LATIN)
        sums = [max(x - max(sums), -1.5) for x in sums]
        for of in [*(WRITTEN_IN[ch] for ch in set(word) if ch in WRITTEN_IN), *(of for rx, of in SPELLINGS if rx.search(word))]:
            sums = [x if c in of else x - 1.5 for x, c in zip(sums, LATIN, strict=True)]
        return [max(x - max(sums), -3.0) for x in sums]

    def score(self, word: str) -> tuple[float, ...]:
        got = self.words.get(word)
        spelt = self.spelling(word)
        sums = spelt if got is None else [x + 0.3 * y for x, y in zip(got, spelt, strict=True)]
        return tuple(max(x - max(sums), FLOOR) - (0.3 if got is None else 0.0) for x in sums)


def _like_names(toks: list[str]) -> list[bool]:
    """Whether each of the strings between white space is like a name: a capital inside a sentence, or a short word between two such."""
    caps = [t.lstrip(_LEAD)[:1].isupper() for t in toks]
    name = [c and (k > 0 and not toks[k - 1].endswith(_ENDS) or len(t) > 1 and t.isupper()) for k, (c, t) in enumerate(zip(caps, toks, strict=True))]
    for k in range(1, len(toks) - 1):
        if len(toks[k]) <= 3 and toks[k].isalpha() and toks[k].islower() and caps[k - 1] and caps[k + 1] and toks[k - 1][-1:].isalpha():
            name[k] = True
    return name


def _latin_words(paragraph: str) -> list[str]:
    """Words of the Latin script in small letters, those like names left out."""
    toks = paragraph.split()
    return [w for t, n in zip(toks, _like_names(toks), strict=True) if not n for w in _WORD.findall(t.lower()) if "a" <= w[0] <= "ɏ"]


def _labelled_templates(texts: list[str]) -> list[tuple[tuple[str, ...], int]]:
    """(words, language) of the paragraphs that function words label clearly; paragraphs of equal words (rows of one table but for numbers and names) count once."""
    lists = [frozenset(w.split()) for w in FUNCTION_WORDS.values()]
    seen = {tuple(_latin_words(p)) for t in texts for p in (t or "").split("\n\n") if p.strip() and len(p) <= PARAGRAPH}
    out = []
    for words in sorted(seen):
        hits = [sum(w in own for w in words) for own in lists]
        top, second = sorted(hits, reverse=True)[:2]
        if top - second >= CLEAR:
            out.append((words, hits.index(top)))
    return out


def _model(rows: list[tuple[tuple[str, ...], int]]) -> Model:
    counts, types = ([Counter() for _ in LATIN] for _ in range(2))
    for words, c in rows:
        counts[c].update(words)
    for c, k in enumerate(counts):
        for w in k:
            t = f"<{w}>"
            types[c].update({t[i : i + 3] for i in range(len(t) - 2)})
    words = _relative(counts, sorted(set().union(*counts)), FLOOR, DOUBT)
    # The fixed words are known, however little of a language the sample holds; what was seen of them adds to that, but does not
    # make a language's own word a foreign one.
    fixed = {c: frozenset(f"{FUNCTION_WORDS[c]} {COMMON[c]}".split()) for c in LATIN}
    for w in frozenset().union(*fixed.values()):
        sums = [x + (0.0 if w in fixed[c] else -2.0) for c, x in zip(LATIN, words.get(w, (0.0,) * len(LATIN)), strict=True)]
        words[w] = tuple(max(x - max(sums), -0.5 if w in fixed[c] else FLOOR) for c, x in zip(LATIN, sums, strict=True))
    return Model(words, _relative(types, sorted(set().union(*types)), -3.0, 2.0))


def learn_words(texts: list[str]) -> Model:
    """Model learned from the paragraphs of a sample; one in five of them is held out to calibrate the confidence."""
    rows = _labelled_templates(texts)
    held = [r for r in rows if crc32(" ".join(r[0]).encode("utf-8", "surrogatepass")) % 5 == 0]
    part = _model([r for r in rows if crc32(" ".join(r[0]).encode("utf-8", "surrogatepass")) % 5])
    known = {w for s in FUNCTION_WORDS.values() for w in s.split()}
    margins, right = [], []
    for words, c in held:
        rest = [w for w in words if w not in known]
        # Short stretches without the words that gave the label: where mistakes are made.
        for size in (1, 3, 9):
            for k in range(0, len(rest) - size + 1, 9):
                total = [sum(x) for x in zip(*(part.score(w) for w in rest[k : k + size]), strict=True)]
                best = max(range(len(LATIN)), key=total.__getitem__)
                margins.append((total[best] - max(x for j, x in enumerate(total) if j != best)) / math.sqrt(size))
                right.append(best == c)
    model = _model(rows)
    model.slope, model.offset = _calibrated(np.array(margins), np.array(right, float))
    return model


def _calibrated(margin: np.ndarray, right: np.ndarray, rounds: int = 30) -> tuple[float, float]:
    """Slope and offset of a logistic curve of being right over the margin (smoothed targets, Newton steps)."""
    if len(right) < 50:
        return 2.0, 0.0
    good, bad = right.sum(), len(right) - right.sum()
    y = np.where(right > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    x = np.stack([margin, np.ones_like(margin)], 1)
    w = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (y - p) - 1e-3 * w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return float(max(w[0], 0.05)), float(w[1])


class Labeller:
    """Labels batches of texts; keeps what it knows of the strings between white space."""

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.ids: dict[str, int] = {}
        self.rows: list[tuple[float, ...]] = []  # scores of a string, then those of it as a name, the number of words, marks
        self.table = np.zeros((0, 2 * _N + 2))

    def _scores(self, word: str, name: bool) -> tuple[float, ...]:
        if not _LATIN.match(word):
            for rx, of in _SCRIPTS:
                if rx.match(word):
                    return of
        return _AS_NAME if name else (*self.model.score(word), *_OTHERS)

    def _id(self, token: str) -> int:
        at = self.ids.get(token)
        return self._add(token) if at is None else at

    def _add(self, token: str) -> int:
        words = _WORD.findall(token)
        sums = [[sum(x) for x in zip(*(self._scores(w.lower(), name) for w in words))] if len(words) > 1 else self._scores(words[0].lower(), name) if words else (0.0,) * _N for name in (False, True)]  # noqa: B905
        bare = token.lstrip(_LEAD)
        marks = (bare[:1].isupper()) + 2 * token.endswith(_ENDS) + 4 * (len(token) > 1 and token.isupper()) + 8 * (len(token) <= 3 and token.isalpha() and token.islower()) + 16 * token[-1].isalpha()
        self.rows.append((*sums[0], *sums[1], len(words), marks))
        at = len(self.rows) - 1
        if len(token) <= KEPT_LENGTH:
            self.ids[token] = at
        return at

    def paragraphs(self, text: str | None) -> list[tuple[int, int, int, str, float]]:
        return self.batch([text])[0]

    def batch(self, texts: list[str | None]) -> list[list[tuple[int, int, int, str, float]]]:
        """(paragraph, offset, length, language, confidence) of each non-blank paragraph of each text."""
        if len(self.rows) > KEPT:
            self._forget()
        ids, lengths, spans = [], [], []
        for t in texts:
            own, at = [], 0
            for k, p in enumerate((t or "").split("\n\n")):
                toks = p.split()
                if toks:
                    own.append((k, at, len(p)))
                    got = list(map(self.ids.get, toks))
                    if None in got:
                        got = [self._id(x) if i is None else i for x, i in zip(toks, got, strict=True)]
                    ids += got
                    lengths.append(len(toks))
                at += len(p) + 2
            spans.append(own)
        if not ids:
            return [[] for _ in texts]
        if len(self.table) < len(self.rows):
            self.table = np.concatenate([self.table, np.array(self.rows[len(self.table) :])])
        ids, lengths = np.array(ids), np.array(lengths)
        starts = np.r_[0, np.cumsum(lengths)[:-1]]
        marks = self.table[:, -1].astype(np.int64)[ids]
        first = np.zeros(len(ids), bool)
        first[starts] = True
        cap, ends = marks & 1 > 0, marks & 2 > 0
        before = np.r_[True, ends[:-1]] | first
        name = cap & (~before | (marks & 4 > 0))
        inner = ~first & ~np.r_[first[1:], True]
        name |= inner & (marks & 8 > 0) & np.r_[False, cap[:-1]] & np.r_[cap[1:], False] & np.r_[False, (marks & 16 > 0)[:-1]]
        values = lambda at: np.where(name[at][:, None], self.table[ids[at], _N : 2 * _N], self.table[ids[at], :_N])
        words = np.add.reduceat(self.table[ids, -2], starts)
        total, gain = np.empty((len(lengths), _N)), np.empty(len(lengths))
        lo = 0
        while lo < len(lengths):
            hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + BLOCK)))
            part = slice(starts[lo], starts[hi - 1] + lengths[hi - 1])
            total[lo:hi], gain[lo:hi] = self._sums(values(part), lengths[lo:hi], first[part])
            lo = hi
        best = total.argmax(1)
        split = gain > SWITCH_PARAGRAPH
        out, at = [], 0
        slope, offset = self.model.slope, self.model.offset
        second = np.partition(total, -2, axis=1)[:, -2]
        for own in spans:
            n = len(own)
            b, t = best[at : at + n], total[at : at + n]
            w = words[at : at + n]
            if not w.any():
                out.append([])
            else:
                full = np.flatnonzero(w)
                if (few := split[at : at + n]).any():
                    # Words one by one where a switch may pay, the other paragraphs in one step each.
                    cut = [slice(starts[at + k], starts[at + k] + lengths[at + k]) for k in range(n)]
                    steps = np.concatenate([values(c) if x else t[k : k + 1] for k, (c, x) in enumerate(zip(cut, few, strict=True))])
                    weight = np.concatenate([self.table[ids[c], -2] if x else w[k : k + 1] for k, (c, x) in enumerate(zip(cut, few, strict=True))])
                    lang = self._word_path(steps, weight, np.where(few, lengths[at : at + n], 1))
                elif (b[full] == b[full[0]]).all():
                    lang = b
                else:
                    lang = self._paragraph_path(t, w)
                rows, last = [], None
                lead = int(lang[full[0]])
                for k, (number, offset_, length) in enumerate(own):
                    if w[k]:
                        c = int(lang[k])
                        rival = second[at + k] if c == b[k] else t[k].max()
                        z = slope * (t[k, c] - rival) / math.sqrt(w[k]) + offset
                        last = (LANGUAGES[c], 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
                    else:
                        last = (last[0] if last else LANGUAGES[lead], 0.5)
                    rows.append((number, offset_, length, *last))
                out.append(rows)
            at += n
        return out

    @staticmethod
    def _sums(v: np.ndarray, lengths: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each paragraph the sums of its words' scores, and whether a stretch inside it could be worth a switch: the best sum of consecutive words of any other language over the paragraph's.

        Up to SWITCH_PARAGRAPH no path over the words can beat one that keeps to the paragraph.
        """
        starts = np.r_[0, np.cumsum(lengths)[:-1]]
        total = np.add.reduceat(v, starts, axis=0)
        par = np.repeat(np.arange(len(lengths)), lengths)
        over = np.cumsum(v - v[np.arange(len(v)), total.argmax(1)[par]][:, None], axis=0)
        over -= np.r_[np.zeros((1, _N)), over][starts][par]
        # Every paragraph lies lower than the one before, so the running minimum starts anew in each.
        shift = ((1.0 + 2 * np.abs(over).max()) * par)[:, None]
        low = np.minimum.accumulate(np.r_[np.zeros((1, _N)), over[:-1]] * ~first[:, None] - shift, axis=0) + shift
        return total, np.maximum.reduceat((over - low).max(1), starts)

    @staticmethod
    def _paragraph_path(total: np.ndarray, words: np.ndarray) -> list[int]:
        """Viterbi path over paragraphs of one language each."""
        score, back, open_ = [0.0] * _N, [], False
        for row, n in zip(total.tolist(), words, strict=True):
            top = max(score)
            switched = top - (SWITCH_PARAGRAPH if open_ else 0.0)
            back.append((score.index(top), [x >= switched for x in score]))
            score = [(x if x >= switched else switched) + y for x, y in zip(score, row, strict=True)]
            open_ = open_ or n > 0
        state, path = score.index(max(score)), []
        for jump, stay in reversed(back):
            path.append(state)
            if not stay[state]:
                state = jump
        return path[::-1]

    @staticmethod
    def _word_path(v: np.ndarray, n: np.ndarray, lengths: np.ndarray) -> list[int]:
        """Viterbi path over words; of each paragraph the language of most of its words."""
        # Languages that no word of the text fits best are left out.
        live = np.flatnonzero((v >= v.max(1, keepdims=True)).any(0)).tolist()
        rows = v[:, live].tolist()
        first = set(np.cumsum(lengths)[:-1].tolist())
        score, back, penalty = [0.0] * len(live), [], 0.0
        for k, row in enumerate(rows):
            if k in first:
                penalty = min(penalty, SWITCH_PARAGRAPH)
            top = max(score)
            switched = top - penalty
            back.append((score.index(top), [x >= switched for x in score]))
            score = [(x if x >= switched else switched) + y for x, y in zip(score, row)]  # noqa: B905
            if n[k]:
                penalty = SWITCH_WORD
        state, path = score.index(max(score)), []
        for jump, stay in reversed(back):
            path.append(state)
            if not stay[state]:
                state = jump
        path.reverse()
        out, at = [], 0
        for size in lengths.tolist():
            votes = Counter()
            for s, x in zip(path[at : at + size], n[at : at + size].tolist(), strict=True):
                votes[s] += x
            out.append(live[max(votes, key=lambda s: (votes[s], -s))])
            at += size
        return out


def _labelled(docs: DataFrame, key: str, text: str, label: str) -> DataFrame:
    docs = docs.select(F.col(key).alias(key), F.col(text).alias("_t"), F.col(label).alias("_l"))
    texts = docs.select("_t").filter(F.col("_t").rlike(r"(?U)\S"))
    # Texts whose hash is 0 modulo n / SAMPLE, each once: about SAMPLE of them, however many copies one has; paragraphs of a
    # bounded length, so what comes to the driver is bounded in bytes too.
    some = texts.filter(F.pmod(F.xxhash64("_t"), F.lit(max(1, texts.count() // SAMPLE))) == 0).distinct()
    some = some.select(F.filter(F.split("_t", "\n\n"), lambda p: F.length(p) <= PARAGRAPH).alias("p")).select(F.explode(F.slice("p", 1, PARAGRAPHS)).alias("p")).distinct()
    model = learn_words(sorted(r["p"] for r in some.toLocalIterator()))

    def label_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(model)
        for batch in batches:
            texts = batch.column("_t").to_pylist()
            found = [r for part in spans(texts, 500_000) for r in labeller.batch(texts[part])]
            flat = list(zip(*(x for r in found for x in r), strict=True)) or [()] * 5
            columns = [pa.array(c, t) for c, t in zip(flat, (pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.float64()), strict=True)]
            offsets = pa.array(np.r_[0, np.cumsum([len(r) for r in found], dtype=np.int64)], pa.int32())
            rows = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(columns, ["parrafo", "inicio", "largo", "idioma", "confianza"]))
            yield pa.RecordBatch.from_arrays([batch.column(key), batch.column("_l"), rows], [key, "_l", "_p"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.mapInArrow(label_all, f"`{key}` {kind}, _l string, _p array<struct<parrafo:int,inicio:int,largo:int,idioma:string,confianza:double>>")


def paragraph_languages(docs: DataFrame, key: str = "doc_id", text: str = "texto_completo", label: str = "idioma") -> DataFrame:
    """(key, parrafo, idioma, confianza, etiqueta): language of every paragraph and the code its document's label stands for."""
    rows = _labelled(docs, key, text, label).select(key, language_code(F.col("_l")).alias("etiqueta"), F.explode("_p").alias("p"))
    return rows.select(key, "p.parrafo", "p.idioma", "p.confianza", "etiqueta").distinct()


def language_segments(docs: DataFrame, key: str = "doc_id", text: str = "texto_completo", label: str = "idioma") -> DataFrame:
    """(key, tramo, idioma, confianza, inicio, fin, idioma_documento, confianza_documento): stretches of one language in order; the document has the language of most of its characters."""
    rows = _labelled(docs, key, text, label).filter(F.size("_p") > 0)
    # A fold over a document's own paragraphs joins equal neighbours; it needs no window or shuffle.
    zero = "cast(array() as array<struct<idioma:string,inicio:int,fin:int,peso:double>>)"
    joined = f"""aggregate(_p, {zero}, (a, p) -> if(size(a) > 0 and element_at(a, -1).idioma = p.idioma,
        concat(slice(a, 1, size(a) - 1), array(named_struct('idioma', p.idioma, 'inicio', element_at(a, -1).inicio, 'fin', p.inicio + p.largo, 'peso', element_at(a, -1).peso + p.confianza * p.largo))),
        concat(a, array(named_struct('idioma', p.idioma, 'inicio', p.inicio, 'fin', p.inicio + p.largo, 'peso', p.confianza * p.largo)))))"""
    share = "aggregate(filter(_p, p -> p.idioma = l), 0, (n, p) -> n + p.largo)"
    best = f"array_max(transform(array_distinct(transform(_p, p -> p.idioma)), l -> named_struct('n', {share}, 'idioma', l)))"
    trust = "aggregate(filter(_p, p -> p.idioma = _d.idioma), cast(0 as double), (n, p) -> n + p.confianza * p.largo) / aggregate(_p, 0, (n, p) -> n + p.largo)"
    rows = rows.select(key, "_p", F.expr(joined).alias("_s"), F.expr(best).alias("_d")).withColumn("_c", F.expr(trust))
    rows = rows.select(key, F.col("_d.idioma").alias("idioma_documento"), F.col("_c").alias("confianza_documento"), F.posexplode("_s").alias("tramo", "s"))
    out = rows.select(key, "tramo", "s.idioma", F.least(F.lit(1.0), F.expr("s.peso / greatest(s.fin - s.inicio, 1)")).alias("confianza"), "s.inicio", "s.fin", "idioma_documento", "confianza_documento")
    return out.distinct()


def mislabelled_paragraphs(docs: DataFrame) -> DataFrame:
    """(doc_id, parrafo, idioma): paragraphs in a language that their document's label does not name."""
    return paragraph_languages(docs).filter(F.col("etiqueta").isNull() | (F.col("etiqueta") != F.col("idioma"))).select("doc_id", "parrafo", "idioma").distinct()
