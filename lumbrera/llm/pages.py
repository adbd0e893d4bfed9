"""Main body of web pages by minimum-cut labelling of their lines.

Every line has a cost for being called body and one for being called boilerplate: the log-odds of a line classifier over
features of no language (length, end mark, separators, capitals, digits, place in the page, neighbours, share of all documents
that hold the same line), and the evidence of phrases sites use around articles in some languages. The classifier is a logistic
regression fitted on a bounded sample of pages whose lines these phrases and plain sentences label, so it also judges pages of
languages without phrases. The costs are the capacities from source and to sink; edges between neighbouring lines, and between
lines beside an insertion, carry smoothness by likeness of form. The minimum cut, found by maximum flow, separates the body
from the rest.

Defined results: null, empty and blank texts have no lines; scanned texts are not pages; a text with hardly any line of a site
is not a page, and all of it is body. A page without any body sentence is boilerplate throughout. Documents delivered again
count once. Lines are split at "\\n" and counted from 0, blank ones included; only non-blank lines are listed.
"""

from __future__ import annotations

import math
import re
from collections import deque
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbrera.llm.labels import format_name
from lumbrera.llm.scans import IMAGES, read_lines
from lumbrera.session import written

#: A line counts as frequent from this share of the documents on; as the shares of all lines add up to the mean number of
#: lines of a document, there are at most a thousand times that many frequent lines: a bounded table to broadcast.
FREQUENT = 0.001
LEAST_DOCS = 3
#: Texts on which the line classifier is fitted, about (at most twice as many), and the longest of them.
SAMPLE, LONGEST = 2_000, 50_000
#: Weight of the classifier's log-odds of short lines around the article beside the phrases' evidence, on pages where phrases are met; elsewhere it is 1.
BESIDE = 0.1

_I = regex.IGNORECASE
#: What sites put around articles, as whole short lines (fixed values).
_CUE = regex.compile(
    r"""^\W*(?:
    (?:skip|jump)\ to|saltar\ al|ir\ al\ contenido|pular\ para|aller\ au\ contenu|
    (?:ver\ )?men[uú]$|home$|inicio$|in[ií]cio$|accueil$|contact(?:o|us|\ us)?$|contato$|about(?:\ us)?$|qui[eé]nes\ somos$|quem\ somos$|qui\ sommes|news$|noticias$|not[ií]cias$|actualit[eé]s$|
    press$|prensa$|imprensa$|careers$|calendar$|agenda$|projects$|proyectos$|projetos$|library$|biblioteca$|search$|buscar$|rechercher$|data$|datos$|dados$|reports$|relat[oó]rios$|informes$|publications$|publicaciones$|publica[cç][oõ]es$|
    multimedia$|convocatorias$|observatorio$|transparen\w+$|sign\ (?:in|up)|log\ ?(?:in|out)|iniciar\ sesi[oó]n|entrar$|registr\w+$|cerrar\ sesi[oó]n|se\ connecter|mapa\ d[eo]l?\ si?ti?[oe]|site\ ?map|plan\ du\ site|
    you\ are\ here|usted\ est[aá]\ aqu[ií]|voc[eê]\ est[aá]\ aqui|vous\ [eê]tes\ ici|
    share|compart|partager|follow\ us|s[ií]ga|siga-?nos|suivez|send\ by\ e-?mail|enviar\ p[oe]r|envoyer\ par|copy\ link|print$|imprimir$|listen\ to|escuchar\ este|ou[cç]a\ |[eé]couter|
    read\ (?:next|also|more)|lea\ tambi[eé]n|leia\ tamb[eé]m|lire\ aussi|[aà]\ lire|most\ (?:read|viewed|popular)|lo\ m[aá]s\ (?:le[ií]do|visto)|mais\ lidas|les\ plus\ lus|related|art[ií]culos\ relacionados|artigos\ relacionados|articles\ li[eé]s|
    you\ may\ also|te\ puede\ interesar|voc[eê]\ tamb[eé]m\ pode|vous\ aimerez|latest\ (?:posts|news)|[uú]ltimas\ (?:entradas|noticias|not[ií]cias)|derniers\ articles|
    advertis|publici|sponsored|contenido\ patrocinado|conte[uú]do\ patrocinado|contenu\ sponsoris|story\ continues|contin[uú]a\ despu[eé]s|continua\ depois|
    leave\ a\ (?:reply|comment)|deje?\ un\ comentario|deixe\ um\ coment|laissez?\ un|\d*\ ?comment|\d*\ ?comentario|\d*\ ?coment[aá]rio|comments\ are|comentarios\ cerrados|load\ more|cargar\ m[aá]s|carregar\ mais|
    subscribe|suscr[ií]b|assine|abonnez|create\ a\ free|reg[ií]strese|crie\ (?:uma|sua)|get\ alerts|reciba|receba|recevez|enter\ your|ingrese\ su|digite\ o|saisissez|
    accept|aceptar|aceitar|accepter|manage\ your|gestione\ sus|gerencie|cookies?\b|usamos\ cookies|
    terms\ of|privacy|aviso\ legal|privacidad|termos\ de|mentions\ l[eé]gales|back\ to\ top|volver\ arriba|voltar\ ao|haut\ de\ page|(?:previous|next)(?:\ page)?$|(?:p[aá]gina\ )?(?:anterior|siguiente|pr[oó]xima)$|
    ©|copyright|all\ rights\ reserved|todos\ los\ derechos\ res|todos\ os\ direitos\ res|tous\ droits\ r|prohibida\ la|proibida\ a|no\ part\ of\ this|toute\ reproduction|site\ by|sitio\ desarrollado|site\ desenvolvido|site\ r[eé]alis|powered\ by
    )""",
    _I | regex.X,
)
#: Reserved rights, reproduction, and addresses with a telephone (fixed values).
_IMPRINT = regex.compile(r"©|\ball rights reserved|derechos reservados\.?$|direitos reservados\.?$|droits r[ée]serv|\b(?:tel|phone|tfno|t[ée]l)\b[ .:]*[\d +()-]{5,}$|sin autorizaci[oó]n de|sem autoriza[cç][aã]o d|without leave from|site may be copied|^\s*©", _I)
#: Sentences a site says about itself and to its reader (fixed values).
_NOTICE = regex.compile(r"\bcookies?\b|\btrackers?\b|\btracking\b|rastreador|tecnolog[ií]as? de (?:seguimiento|rastreamento)|ferramentas? de rastreamento|herramientas de (?:seguimiento|rastreo)|\bprivacy\b|privacidad|(?:files|archivos|arquivos|fichiers)\b.{0,40}\b(?:device|equipo|navegador|aparelho|dispositivo|appareil)|usage data|datos de uso|dados de uso|donn[ée]es d.usage|prefer[eê]nc|preferences|traceurs|newsletter|bolet[ií]n semanal|boletim semanal", _I)
_ADDRESS = regex.compile(r"\b(?:we|our|us|you|your|you agree)\b|\b(?:su|sus|usted|nuestr[oa]s?|tu|tus|nos|usamos|valoramos|guardamos|acepta|desactive)\b|\b(?:seu|sua|seus|suas|voc[eê]|noss[oa]s?)\b|\b(?:votre|vos|nous|vous|notre)\b|\b(?:est[ea]|nuestra|nossa|this|our) (?:sitio|site|portal|p[aá]gina|website|plataforma|platform)\b|\b(?:the|la|a) (?:\S+ ){0,4}(?:platform|plataforma|website|portal)\b", _I)
_SELF = regex.compile(r"^(?:the |la |el |o |a |le )?(?:plataforma |portal |platform |sitio |site |p[aá]gina )?(?:de )?(?:\p{Lu}\S+ ){1,4}(?:platform |portal |site )?(?:uses|use|usa|stores|relies|shares|guarda|emplea|emprega|comparte|compartilha|recuerda|lembra|utiliza|recurre|recorre|keeps|collects)\b")
_ENDS = regex.compile(r"[.!?…。！？।؟][\"'”’»)\]]*$")
_SEPARATED = re.compile(r"\S\s+[|·•»›>/]\s+\S|\S\s{2,}\S")
_DATED = regex.compile(r"^\W*\d{1,2}[./-]\d{1,2}(?:[./-]\d{2,4})?\s*[·|–—:-]\s*\S")
_PAGER = regex.compile(r"^\W*(?:\d{1,3}\W+){2,}(?:\.{2,}|…)?\W*\d*\W*$|^[«<‹].{0,40}[»>›]$")
_RELATED = regex.compile(r"^\W*(?:read (?:next|also|more)|lea tambi|leia tamb|lire aussi|most (?:read|viewed|popular)|lo m[aá]s|mais lidas|les plus|related|art[ií]culos rel|artigos rel|you may also|te puede|voc[eê] tamb[eé]m pode|vous aimerez|latest|[uú]ltimas|derniers)", _I)
#: Entries of menus, for menus without separators (fixed values).
_MENU = regex.compile(r"\b(?:home|inicio|in[ií]cio|accueil|contacto?|contato|contact us|about us|about|qui[eé]nes somos|quem somos|news|noticias|not[ií]cias|press|prensa|imprensa|careers|calendar|agenda|projects|proyectos|projetos|library|biblioteca|search|buscar|data|datos|dados|reports|relat[oó]rios|informes|publications|publicaciones|publica[cç][oõ]es|multimedia|convocatorias|observatorio|observat[oó]rio|transparencia|transpar[eê]ncia|sign in|log in|iniciar sesi[oó]n|entrar|mapa del sitio|mapa do site|site map|menu|men[uú]|blog|servicios|servi[cç]os|services|ayuda|ajuda|help)\b", _I)
_SHARE = regex.compile(r"^\W*(?:share|compart|partager|follow us|s[ií]ga|siga-?nos|suivez|send by e-?mail|enviar p[oe]r|envoyer par|copy link|print$|imprimir$|listen to|escuchar este|ou[cç]a |[eé]couter|advertis|publici|sponsored|contenido patroc|conte[uú]do patroc|contenu spons)", _I)
_SPACE, _DIGITS, _INK = re.compile(r"[^\S\n]"), re.compile(r"\d+"), re.compile(r"\w")
_WIDE = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}]")
_SPLIT = re.compile(r"\s[|·•»›>/]\s|\s{2,}")
_SMALL = re.compile(r"\b(?:en|in|em|à|de|del|do|da|of)\b")
_CAPITAL = regex.compile(r"^\W*[\p{Lu}\p{Lo}\d]")


def mask(line: str) -> str:
    """A line with its digits masked and its white space collapsed, to be counted over documents."""
    return " ".join(_DIGITS.sub("0", line).split()).casefold()


def line_key(line: str) -> int:
    """Signed 64-bit digest of a masked line."""
    return int.from_bytes(blake2b(mask(line).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def minimum_cut(source: list[float], sink: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """For each node whether it is on the source's side of a minimum cut. source and sink: capacities from and to the terminals; edges carry both ways.

    Maximum flow by shortest augmenting levels (blocking flows); what both terminals share of a node is sent straight through.
    """
    n = len(source)
    s, t = n, n + 1
    to, cap, out = [], [], [[] for _ in range(n + 2)]

    def add(a: int, b: int, c: float, back: float) -> None:
        out[a].append(len(to))
        to.append(b)
        cap.append(c)
        out[b].append(len(to))
        to.append(a)
        cap.append(back)

    for k in range(n):
        d = source[k] - sink[k]
        if d > 0:
            add(s, k, d, 0.0)
        elif d < 0:
            add(k, t, -d, 0.0)
    for a, b, w in edges:
        add(a, b, w, w)
    eps = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = deque([s])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if cap[e] > eps and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[t] < 0:
            return [level[k] >= 0 for k in range(n)]
        at = [0] * (n + 2)
        path: list[int] = []
        a = s
        while True:
            if a == t:
                push = min(cap[e] for e in path)
                cut = 0
                for k, e in enumerate(path):
                    cap[e] -= push
                    cap[e ^ 1] += push
                    if cap[e] <= eps and not cut:
                        cut = k + 1
                path = path[: cut - 1]
                a = to[path[-1]] if path else s
                continue
            while at[a] < len(out[a]):
                e = out[a][at[a]]
                if cap[e] > eps and level[to[e]] == level[a] + 1:
                    break
                at[a] += 1
            else:
                if a == s:
                    break
                level[a] = -1
                e = path.pop()
                a = to[e ^ 1]
                continue
            path.append(e)
            a = to[e]


def _flat(line: str) -> str:
    t = line.strip()
    return t if t.isascii() and "\t" not in t else _SPACE.sub(" ", t)


def line_costs(line: str, share: float) -> tuple[float, str]:
    """line_evidence, kept for the short lines that pages repeat."""
    return _kept_evidence(line, share) if len(line) <= 80 else line_evidence(line, share)


def line_evidence(line: str, share: float) -> tuple[float, str]:
    """Evidence of the phrases and the plain form for boilerplate (negative: for body) and the form of a line: p sentence(s), n notice, w widget or navigation, s short."""
    t = _flat(line)
    words = len(t.split())
    wide = 0 if t.isascii() else len(_WIDE.findall(t))
    ended = bool(_ENDS.search(t, max(0, len(t) - 12)))
    sentence = ended and (words >= 6 or wide >= 12)
    if _PAGER.match(t) or _DATED.match(t):
        return 7.0, "w"
    if words <= 22 and _IMPRINT.search(t):
        return 8.0, "w"
    if sentence:
        if words <= 30 and _NOTICE.search(t):
            own = bool(_ADDRESS.search(t)) or bool(_SELF.search(t))
            if own or (share >= 0.01 and words <= 14):
                return 7.0, "n"
            return -3.0, "p"
        if words <= 9 and _CUE.search(t):
            return 5.0, "n"
        return (-6.0 if words >= 12 or wide >= 25 else -3.5), "p"
    if words <= 16 and _CUE.search(t):
        return 7.0, "w"
    if not ended and _SEPARATED.search(t):
        parts = [p for p in _SPLIT.split(t) if p.strip()]
        if len(parts) >= 2 and all(len(p.split()) <= 4 for p in parts):
            return 6.0, "w"
    if words > 25 or wide > 40:
        return -2.0, "p"
    if not ended and not _INK.search(_MENU.sub("", t)):
        return 6.0, "w"
    frequent = min(1.5, 0.5 * max(0.0, share / 0.01)) if words <= 8 else 0.0
    # Rows of capitalised words without any small function word are menus.
    if words >= 3 and share >= 0.005 and sum(w[:1].isupper() for w in t.split()) >= 0.6 * words and not _SMALL.search(t):
        return 4.0, "w"
    if words <= 3 and share >= 0.1:
        return 4.0, "w"
    return frequent, "s"


_kept_evidence = lru_cache(50_000)(line_evidence)


def line_features(lines: list[str], shares: list[float]) -> np.ndarray:
    """Features of no language of the non-blank lines of a page, one row a line."""
    n = len(lines)
    rows = []
    for t in map(_flat, lines):
        words = t.split()
        wide = 0 if t.isascii() else len(_WIDE.findall(t))
        # A line of a script without spaces has a word in about two letters.
        size = len(words) + wide / 2
        ended = float(bool(_ENDS.search(t, max(0, len(t) - 12))))
        rows.append((math.log1p(size), float(size <= 3), ended, ended * float(size >= 6), sum(map(str.isdigit, t)) / len(t), float(bool(_SEPARATED.search(t))), sum(w[:1].isupper() for w in words) / len(words)))
    own = np.array(rows).reshape(n, 7)
    share = np.log1p(1000 * np.array(shares))
    size, ended = own[:, 0], own[:, 2]
    place = np.arange(n)
    side = lambda x: (np.r_[0.0, x[:-1]], np.r_[x[1:], 0.0])
    return np.column_stack([np.ones(n), own, share, share * own[:, 1], np.maximum(0, 1 - place / 8), np.maximum(0, 1 - (n - 1 - place) / 8), *side(size), *side(ended), *side(share)])


#: Number of features.
WIDTH = 18


def fit_lines(x: np.ndarray, boilerplate: np.ndarray, rounds: int = 25, ridge: float = 1.0) -> np.ndarray:
    """Weights of a logistic regression (Newton steps, ridge penalty), either class weighing the same."""
    w = np.zeros(x.shape[1])
    y = boilerplate.astype(float)
    if not 0 < y.sum() < len(y):
        return w
    weight = np.where(y > 0, 0.5 * len(y) / y.sum(), 0.5 * len(y) / (len(y) - y.sum()))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (weight * (y - p)) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w


def learn_lines(texts: list[str], shares: dict[int, float]) -> np.ndarray:
    """Classifier fitted on the lines that phrases or plain sentences label clearly; pages of which no phrase is met teach nothing."""
    xs, ys = [np.zeros((0, WIDTH))], [np.zeros(0, bool)]
    for t in texts:
        lines = [s for s in t.split("\n") if s.strip()]
        own = [shares.get(line_key(s), 0.0) for s in lines]
        cost = np.array([line_costs(s, h)[0] for s, h in zip(lines, own, strict=True)])
        if (cost >= 5.0).sum() >= 2:
            sure = (cost >= 5.0) | (cost <= -3.0)
            xs.append(line_features(lines, own)[sure])
            ys.append(cost[sure] > 0)
    return fit_lines(np.concatenate(xs), np.concatenate(ys))


def is_scan(text: str, image: bool, shares: dict[int, float]) -> bool:
    """Whether a text is a scan rather than a page: wrapped to a width, or an image without several lines of a site."""
    if read_lines(text, False):
        return True
    return image and sum(line_costs(s, shares.get(line_key(s), 0.0))[0] >= 5.0 for s in text.split("\n") if s.strip() and not _PAGER.search(s)) < 3


def label_lines(text: str, shares: dict[int, float], html: bool, weights: np.ndarray | None = None) -> list[tuple[int, bool]]:
    """(line, whether it is body) for the non-blank lines of a page; an empty list if the text is no web page."""
    lines = [(k, s) for k, s in enumerate(text.split("\n")) if s.strip()]
    n = len(lines)
    # A share counts for short lines only; longer ones need not be looked up.
    share = [shares.get(line_key(s), 0.0) if len(s) <= 400 and s.count(" ") <= 40 else 0.0 for _, s in lines]
    seen = [line_costs(s, h) for (_, s), h in zip(lines, share, strict=True)]
    score, form = [x for x, _ in seen], [f for _, f in seen]
    beside = [0.0] * n
    if weights is not None and n:
        odds = np.clip(line_features([s for _, s in lines], share) @ weights, -4.0, 4.0)
        known = sum(x >= 4.0 for x in score) >= 2
        for k, z in enumerate(odds.tolist()):
            if not known and abs(score[k]) < 3.0:
                # Without phrases the classifier alone tells a line of the site from others, among those that recur on other pages.
                score[k] += z if share[k] else min(z, 1.0)
                form[k] = "w" if z >= 2.0 and share[k] and form[k] == "s" else form[k]
            elif form[k] == "p" and score[k] > -3.0 and not share[k]:
                # A long line without an end mark, as in scripts without one.
                score[k] += min(0.0, z)
            elif form[k] == "s":
                beside[k] = BESIDE * max(-1.0, min(1.0, z))
    body = [k for k in range(n) if form[k] == "p" and score[k] <= -3.0]
    site = sum(x >= 4.0 for x, _ in seen)
    # What the classifier alone takes for lines of a site must also stand where a site puts them: behind the last sentence too.
    told = [k for k in range(n) if score[k] >= 2.0 and form[k] == "w"]
    if site < (1 if html else 2) and (len(told) < 3 or sum(k > max(body, default=-1) for k in told) < 2):
        return []
    edges = []
    text_of = [_flat(s) for _, s in lines]
    # Short lines below a bare heading of links, up to the next sentence or widget, belong to it.
    linked: dict[int, int] = {}
    for k in range(n):
        if form[k] == "w" and _RELATED.match(text_of[k]) and ":" not in text_of[k] and len(text_of[k].split()) <= 6:
            j = k + 1
            while j < n and (form[j] == "s" or _DATED.match(text_of[j])):
                linked[j] = k
                j += 1
    # The title: the first of the short lines before the first sentence, insertions for sharing aside.
    title, lead = None, []
    k = body[0] - 1 if body else -1
    while k >= 0 and (form[k] == "s" and k not in linked or _SHARE.match(text_of[k])):
        if form[k] == "s":
            lead.append(k)
        k -= 1
    if lead:
        title = lead[-1]
    elif k >= 0 and k in linked and form[k] == "s":
        title = k
        del linked[k]
    for k in lead:
        score[k] -= 1.5
    if title is not None and _CAPITAL.match(text_of[title]):
        score[title] -= 2.0
    edges += [(k, j, 3.0) for j, k in linked.items()]
    for k in range(n - 1):
        a, b = form[k], form[k + 1]
        if k + 1 == title or k == title and b in "wn":
            w = 0.3
        elif k in linked and k + 1 in linked:
            w = 2.0
        elif a == b == "p":
            w = 2.5
        elif a == b == "s":
            w = 2.0
        elif {a, b} == {"p", "s"}:
            w = 0.5 if k in linked or k + 1 in linked else 2.0
        elif "w" in (a, b) or "n" in (a, b):
            w = 0.7
        else:
            w = 1.0
        edges.append((k, k + 1, w))
    # Near in the document: the lines on both sides of an insertion.
    for k in range(n - 2):
        if form[k + 1] in "wn" and form[k] in "ps" and form[k + 2] in "ps" and k not in linked and k + 2 not in linked:
            edges.append((k, k + 2, 1.5 if "p" in (form[k], form[k + 2]) else 0.7))
    # Past the last and before the first sentence short lines lean to the site; without any sentence there is no article, and
    # every line leans to it more than anything else can hold.
    first, last = (body[0], body[-1]) if body else (n, -1)
    for k in range(n):
        if not body:
            score[k] = max(score[k], 0.0) + 8.0
        elif form[k] == "s" and k != title and k not in lead:
            score[k] += 1.2 + beside[k] if k < first or k > last else 0.0
            if k in linked:
                score[k] += 1.0
    side = minimum_cut([max(0.0, -x) for x in score], [max(0.0, x) for x in score], edges)
    return [(k, s) for (k, _), s in zip(lines, side, strict=True)]


def _texts(docs: DataFrame, key: str, text: str, formato: str) -> DataFrame:
    f = format_name(F.col(formato))
    return docs.select(F.col(key).alias(key), F.col(text).alias("_t"), F.coalesce(f.isin(*IMAGES), F.lit(False)).alias("_i"), F.coalesce(f == "html", F.lit(False)).alias("_h")).filter(F.col("_t").rlike(r"(?U)\S"))


def frequent_lines(docs: DataFrame, key: str, text: str) -> dict[int, float]:
    """Share of the documents that hold each frequent line, by line_key; counted over all documents, the result bounded as FREQUENT says.

    Texts delivered again are dropped by their hash: what is shuffled are eight bytes a line.
    """

    @F.pandas_udf("array<bigint>")
    def keys(s: pd.Series) -> pd.Series:
        return s.map(lambda t: sorted({line_key(x) for x in t.split("\n") if x.strip()}))

    once = written(docs.select(F.col(key), F.xxhash64(text).alias("_x"), keys(text).alias("_m")).groupBy(key, "_x").agg(F.first("_m").alias("_m")))
    n = once.count()
    counts = once.select(F.explode("_m").alias("m")).groupBy("m").agg(F.count("*").alias("n")).filter(F.col("n") >= max(LEAST_DOCS, FREQUENT * n))
    return {r["m"]: r["n"] / n for r in counts.toLocalIterator()}


def _labelled(docs: DataFrame, key: str, text: str, formato: str) -> DataFrame:
    """key, _t and _l, the labels of the non-blank lines, for every row that is a page; no shuffle."""
    docs = _texts(docs, key, text, formato)
    shares = frequent_lines(docs, key, "_t")
    # Texts whose hash is 0 modulo n / SAMPLE, each once, up to a length: a sample of bounded size.
    some = docs.filter((F.pmod(F.xxhash64("_t", F.lit(3)), F.lit(max(1, docs.count() // SAMPLE))) == 0) & (F.length("_t") <= LONGEST)).select("_t").distinct()
    weights = learn_lines(sorted(r["_t"] for r in some.toLocalIterator()), shares)

    @F.pandas_udf("array<struct<linea:int,cuerpo:boolean>>")
    def labels(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, images, htmls in batches:
            out = []
            for t, i, h in zip(texts, images, htmls, strict=True):
                rows = [] if is_scan(t, bool(i), shares) else label_lines(t, shares, bool(h), weights)
                out.append([{"linea": k, "cuerpo": b} for k, b in rows])
            yield pd.Series(out)

    # Marked as not deterministic, so that the filter does not make it run twice.
    return docs.select(key, "_t", labels.asNondeterministic()("_t", "_i", "_h").alias("_l")).filter(F.size("_l") > 0)


def page_lines(docs: DataFrame, key: str = "doc_id", text: str = "texto", formato: str = "formato") -> DataFrame:
    """(key, linea, cuerpo): the non-blank lines of web pages and whether they are body."""
    return _labelled(docs, key, text, formato).select(key, F.explode("_l").alias("l")).select(key, "l.linea", "l.cuerpo").distinct()


def boilerplate_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, linea): non-blank lines of web pages that are not body."""
    return page_lines(docs).filter(~F.col("cuerpo")).select("doc_id", "linea")


def main_text(docs: DataFrame, key: str = "doc_id", text: str = "texto", formato: str = "formato") -> DataFrame:
    """(key, texto_principal): the body lines of every web page in order, joined by line breaks; an empty text for a page without an article."""
    lines = F.transform(F.filter("_l", lambda x: x["cuerpo"]), lambda x: F.get(F.split("_t", "\n"), x["linea"]))
    return _labelled(docs, key, text, formato).select(key, F.array_join(lines, "\n").alias("texto_principal")).distinct()
