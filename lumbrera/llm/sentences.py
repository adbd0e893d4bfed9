"""Sentences of documents in any of nine languages, whatever the label says.

Spaced scripts, and the scripts with full stops of their own: the marks that can end a sentence form a lattice of gaps, each
with a cost for cutting and one for not cutting (abbreviations, initials, numbers, the next word's case, quotations); the
cheapest path through the gaps gives the sentences. Scripts without full stops (Thai): the words around every space come from
the cheapest path through a lattice of dictionary words; final particles before and opening words after the space, learned
from how paragraphs of the corpus open and supplemented by a fixed list, decide whether it ends a sentence. Where neither
stands, it does if the runs on both sides can be clauses (a known predicate, or a long stretch of unknown letters).

Defined results: null, empty and blank texts have no sentences. A blank line always ends a sentence; a line break does only
before a list mark. A row of a csv, xlsx or pbf document is one sentence. Offsets are code points, opening marks included.
Copies count once; a text of any length is treated as a whole, paragraph by paragraph.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbrera.llm.labels import format_name

ROW_FORMATS = ("csv", "xlsx", "pbf")
_BLANK = re.compile(r"\n[^\S\n]*(?:\n[^\S\n]*)+")
#: Titles and forms of address: a name follows (fixed values).
TITLES = frozenset(
    "sr sra sres sras srta dr dra dres prof profa profª ing eng gral gen col cnel lt tte cap capt cpt cmdte sgt sgto cabo adm alm mr mrs ms mx m mm mme mlle me mgr mons lic arq rev fr st sta sto ste san d dña hon pres gov sen rep pdte min vda v exc exmo ilmo emmo mtro mtra cía cia".split()
)
#: Words that point to a number or go on after their full stop (fixed values).
REFERENCES = frozenset(
    "art arts núm num nº nro no nos nr n p pp pág pag págs pags cap caps chap ch fig figs sec secc sect § vol vols ed eds t tab tabl tbl párr par inc lit env aprox approx ca c circ anexo apdo aptdo tel tfno ref reg exp res dec ord min máx mín av avda calle cl km hab ej ex ex. vs cf cfr vid v.gr viz pl".split()
)
#: Abbreviations that go on before a small letter or a number but can also end a sentence (fixed values).
OPEN_ENDED = frozenset("etc al inc ltd ltda corp co s.a s.l s.r.l s.a.s a.m p.m a.c d.c u.s u.k ee.uu ue jr sr bros dept depto dpto univ est ff ss ib ibid id gob gob.".split())
#: Never the end: what they introduce follows (fixed values).
CONNECTING = frozenset("p.ej p.ex e.g i.e par.ex v.g ej ex".split())
_MARK = regex.compile(r"(?:\.{2,}|[.!?…‽。．！？｡؟۔।॥]+)[!?.…！？。]*")
_CLOSERS = "\"'”’»)]」』）】›"
_OPENERS = "¿¡«“\"'‘(「『（【‹[—–-"
_CJK_END = frozenset("。．！？｡")
_HARD = frozenset("।॥۔")
_LIST = regex.compile(r"\n[^\S\n]*(?=(?:\d{1,3}[.)]|[-•*·–—‣▪]|[a-z]\))[^\S\n]+\S)")
_LIST_HEAD = regex.compile(r"[^\S\n]*(?:\d{1,3}[.)]|[-•*·‣▪]|[a-zA-Z]\))")
_WORD = regex.compile(r"[\p{L}\p{M}\p{N}ªº°§’'.·-]*$")
_GLUED = regex.compile(r"(?:\p{Ll}{3}|\p{Lu}{4}|\d{2})\.(\p{Lu}\p{L}*)$")
_INK = re.compile(r"\S")
_FIRST = regex.compile(rf"[^{regex.escape(_OPENERS)}\s]")
_DOTTED = regex.compile(r"(?:\p{L}{1,2}\.)+\p{L}{1,2}")
_QUOTE_MARK = re.compile('[«»“”「」『』„"]')
_QUOTES = {"«": "»", "“": "”", "「": "」", "『": "』", "„": "”"}
_SPACELESS = regex.compile(r"[\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]")
_CJK = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}]")
_LATINISH = regex.compile(r"[\p{Latin}\p{Cyrillic}\p{Greek}\p{Armenian}]")


def _quote_spans(s: str) -> list[tuple[int, int]]:
    """Balanced quotations (start of the opening mark, end after the closing one); marks that are never closed are ignored."""
    spans, open_at, straight = [], [], -1
    waiting = dict.fromkeys(_QUOTES.values(), 0)
    for m in _QUOTE_MARK.finditer(s):
        c, i = m.group(), m.start()
        if c in _QUOTES:
            open_at.append((c, i))
            waiting[_QUOTES[c]] += 1
        elif waiting.get(c):
            while True:
                o, at = open_at.pop()
                waiting[_QUOTES[o]] -= 1
                if _QUOTES[o] == c:
                    break
            if not open_at:
                spans.append((at, i + 1))
        elif c == '"':
            if straight < 0:
                if i + 1 < len(s) and not s[i + 1].isspace():
                    straight = i
            else:
                spans.append((straight, i + 1))
                straight = -1
    return sorted(spans)


def _list_head(s: str, start: int, end: int) -> bool:
    """Whether s[start:end] is a list mark, white space after it aside."""
    m = _LIST_HEAD.match(s, start, end)
    return bool(m) and _INK.search(s, m.end(), end) is None


def _cost(s: str, start: int, end: int, after: int, at: int, quotes: list[tuple[int, int]], opened: int, line: int) -> float:
    """Cost of cutting minus cost of not cutting after the mark s[start:end] whose closing marks reach to `after`; below 0 it ends a sentence.

    at: the first place with ink from `after` on; quotes: those around `start`; line: where its line starts.
    """
    if at >= len(s):
        return -9.0
    nxt, gap = s[at], at - after
    for a, b in quotes:
        if after < b:
            return 9.0  # inside a quotation
        if end < b <= after and (a == opened or _list_head(s, opened, a)):
            # The quotation opens the sentence: a clause that names its speaker may follow.
            if nxt.islower() or nxt in ",，、،—–-;；:":
                return 9.0
            if (_CJK.match(nxt) and not gap) or (gap == 0 and not nxt.isupper() and nxt not in _OPENERS):
                return 4.0
    if nxt in ",;:，；：、،%)" or (nxt in "»”’\"" and not gap):
        return 9.0
    mark, closers = s[start:end], s[end:after]
    if any(c in _CJK_END or c in _HARD for c in mark):
        return -4.0
    m = _FIRST.search(s, at)
    first = m.group() if m else " "
    # The marks that may stand alone come after a word; no listed one is nearly as long.
    word = _WORD.search(s, max(0, start - 24), start).group()
    if mark == "." and gap and not closers and first.isupper() and len(word) > 8 and word.isalpha():
        return -3.0
    glued = _GLUED.search(word)
    before = (glued.group(1) if glued else word).lstrip("(«“\"'¿¡-")
    low = before.lower().strip(".-'’")
    if "'" in low or "’" in low:
        low = regex.split(r"['’]", low)[-1]
    ellipsis = len(mark) > 1 and set(mark) == {"."} or mark[0] == "…"
    strong = any(c in "!?‽؟" for c in mark)
    cased = bool(_LATINISH.match(first))
    if ellipsis:
        return 4.0 if first.islower() else (-2.0 if gap else 2.0)
    if strong:
        if first.islower():
            return 4.0
        return -3.0 if gap or closers or not cased or first.isupper() else 2.0
    # A single full stop.
    if gap == 0:
        if closers:
            return -1.0 if first.isupper() or not cased and not first.isdigit() else 4.0
        # A missing space: a whole word, a capital and a small letter.
        whole = len(low) >= 3 and "." not in low and (low.isalpha() or low.isdigit()) or before.isupper() and len(before) >= 3 or s[start - 1 : start] in "%)»”"
        follows = nxt in "¿¡«“—" or (nxt.isupper() and at + 1 < len(s) and (s[at + 1].islower() or s[at + 1] in " '’"))
        return -1.5 if whole and follows and low not in TITLES and low not in REFERENCES else 6.0
    if first.islower():
        return 6.0
    digit = first.isdigit()
    if _LIST_HEAD.fullmatch(s, opened, end) or before.isdigit() and len(before) <= 3 and _LIST_HEAD.fullmatch(s, line, end):
        return 9.0  # a list number is part of its item
    if not cased and not digit and not before.isascii() and len(regex.sub(r"\p{M}", "", low)) <= 2 and not low.isdigit() and not _CJK.search(low):
        return 5.0  # abbreviated titles of scripts without case
    if low in CONNECTING:
        return 5.0
    if low in TITLES and not digit and low != "sr":
        return 5.0
    if low in TITLES and first.isupper() and before[:1].isupper():
        return 5.0
    if low in REFERENCES and (digit or before[:1].islower() and len(low) <= 4 and low not in ("no", "nos", "par", "res", "min")):
        return 5.0
    if len(before) == 1 and before.isalpha() and before.isupper() and not digit:
        return 3.0  # an initial
    if low in OPEN_ENDED or _DOTTED.fullmatch(before):
        return -1.0
    return -3.0


def _ink(s: str, at: int) -> int:
    m = _INK.search(s, at)
    return m.start() if m else len(s)


def _spaced(s: str) -> list[int]:
    """Starts of the sentences of a paragraph with terminators; the paragraph is read once, whatever its length."""
    quotes = _quote_spans(s)
    lists = [(m.start(), m.end()) for m in _LIST.finditer(s)]
    lines = [-1, *(m.start() for m in re.finditer("\n", s))]
    first = _ink(s, 0)
    if first == len(s):
        return []
    todo = sorted([(m.start(), 0, m.end()) for m in _MARK.finditer(s)] + [(end - 1, 1, end) for _, end in lists if end > first])
    # Cheapest path: the states are the places where the current sentence may have opened; as a gap's cost depends on the
    # opening only through quotations and list numbers, the best path into each opening is kept, as a chain of places.
    paths: dict[int, tuple[float, tuple]] = {first: (0.0, (first, None))}
    live: list[tuple[int, int]] = []
    quote = line = 0
    for start, kind, end in todo:
        while quote < len(quotes) and quotes[quote][0] < start:
            live.append(quotes[quote])
            quote += 1
        if live:
            live = [q for q in live if q[1] > start]
        if kind:
            cost, chain = min(paths.values(), key=lambda p: p[0])
            at = _ink(s, start)
            paths = {at: (cost, (at, chain) if chain[0] != at else chain)}
            continue
        while line + 1 < len(lines) and lines[line + 1] < start:
            line += 1
        after = end
        while after < len(s) and s[after] in _CLOSERS and (s[after] not in "\"'" or s[after] == '"' and any(after + 1 == b for _, b in live) or s[after] == "'" and (after + 1 == len(s) or s[after + 1].isspace())):
            after += 1
        at = _ink(s, after)
        moved: dict[int, tuple[float, tuple]] = {}
        shared = None
        for opened, (cost, chain) in paths.items():
            # Without a quotation around, only an opening so near that a list mark can lie between makes a difference.
            if opened >= end:
                c = 9.0
            elif live or end - opened <= 8:
                c = _cost(s, start, end, after, at, live, opened, lines[line] + 1)
            else:
                if shared is None:
                    shared = _cost(s, start, end, after, at, live, opened, lines[line] + 1)
                c = shared
            options = [(opened, cost + max(0.0, -c), chain)]
            if c < 9.0 and at < len(s):
                options.append((at, cost + max(0.0, c), (at, chain)))
            for o, k, p in options:
                if o not in moved or k < moved[o][0]:
                    moved[o] = (k, p)
        # Only the paths near the best matter for what follows.
        least = min(k for k, _ in moved.values())
        paths = moved if len(moved) == 1 else {o: v for o, v in sorted(moved.items(), key=lambda kv: kv[1][0])[:4] if v[0] <= least + 9}
    chain, out = min(paths.values(), key=lambda p: p[0])[1], []
    while chain:
        out.append(chain[0])
        chain = chain[1]
    return out[::-1]


# --- scripts without full stops -------------------------------------------------------------------------------------------

#: Thai words for the lattice (fixed values): words that open a sentence, final particles, units and words that go on.
THAI_OPENING = (
    "นอกจากนี้ อย่างไรก็ตาม ดังนั้น ในทางกลับกัน ขณะเดียวกัน ในขณะเดียวกัน แต่ ต่อมา จากนั้น หลังจากนั้น อย่างไรก็ดี ทั้งนี้ อีกทั้ง เมื่อ หาก ถ้า แม้ว่า เนื่องจาก สำหรับ ตามที่ ไม่มี จะ ผม ฉัน เรา เขา เธอ พวกเขา มัน นี่ นั่น ใคร ทำไม อะไร "
).split()
THAI_FINAL = "ครับ ค่ะ คะ นะ แล้ว เลย ด้วย อยู่ กัน ไหม หรือไม่ มั้ย เถอะ จ้ะ จ๊ะ สิ ล่ะ".split()
THAI_UNITS = "เปอร์เซ็นต์ ร้อยละ อำเภอ เดือน ปี วัน ชั่วโมง นาที บาท ล้าน แสน หมื่น พัน ร้อย คน ครั้ง แห่ง หมู่บ้าน ตำบล จังหวัด ประเทศ กิโลเมตร เมตร กิโลกรัม ตัน ราย ชิ้น ดวง ลำ คัน หน้า ข้อ ฉบับ เท่า องศา หน่วย เครื่อง ตัว".split()
THAI_GOING_ON = "และ หรือ ที่ ซึ่ง อัน โดย เพราะ ว่า เป็น ถึง จาก ใน ของ กับ แก่ ต่อ เพื่อ ตาม ด้วย จน ขณะที่ แม้ หลัง ก่อน ระหว่าง ประมาณ เพิ่มขึ้น ลดลง กล่าว ได้แก่ เช่น คือ รวม พร้อม ทั้ง".split()
#: Final particles that close a sentence whatever follows; the other ones can also stand inside it (fixed values).
THAI_CLOSING = frozenset("ครับ ค่ะ คะ นะ ไหม มั้ย เถอะ จ้ะ จ๊ะ ล่ะ".split())
#: Predicates: a stretch of text that holds one can be a clause (fixed values).
THAI_PREDICATES = (
    "เป็น คือ มี ไม่มี ไม่ ได้ ให้ ไป มา ทำ ทำงาน ทำให้ กิน ดื่ม นอน ตื่น เดิน วิ่ง นั่ง ยืน พูด บอก ถาม ตอบ ฟัง ดู เห็น พบ เจอ รู้ รู้จัก คิด เชื่อ เข้าใจ จำ ลืม รัก ชอบ เกลียด กลัว อยาก ต้อง ต้องการ ควร อาจ สามารถ เคย กำลัง จะ ถูก "
    "เรียก เรียน สอน อ่าน เขียน ซื้อ ขาย จ่าย รับ ส่ง ใช้ เปิด ปิด เริ่ม หยุด จบ สิ้นสุด เกิด เกิดขึ้น ตาย หาย หา ช่วย ช่วยเหลือ สร้าง ผลิต พัฒนา ปรับปรุง แก้ไข เปลี่ยน เปลี่ยนแปลง เพิ่ม เพิ่มขึ้น ลด ลดลง ขึ้น ลง เข้า ออก กลับ ถึง อยู่ อาศัย "
    "วิเคราะห์ ทบทวน บันทึก เผยแพร่ ระงับ ประกาศ รายงาน กล่าว ระบุ เปิดเผย ยืนยัน ปฏิเสธ เสนอ อนุมัติ ตัดสินใจ ประชุม ศึกษา สำรวจ ติดตาม ตรวจ ตรวจสอบ วัด คำนวณ คาด คาดว่า ขาด ชนะ แพ้ ป้องกัน รักษา ประกอบ ตั้ง จัด จัดตั้ง ร่วม สนับสนุน "
    "เดินทาง ย้าย ตก ฝนตก ไหล ร้อน หนาว ดี สวย ใหญ่ เล็ก สูง ต่ำ มาก น้อย แพง ถูกต้อง สำคัญ ยาก ง่าย เร็ว ช้า หมด พอ เหลือ"
).split()
#: Other common words, most of all those that end or begin like a word of the lists above (fixed values).
THAI_COMMON = (
    "คณะ ชนะ ขณะ ลักษณะ สถานะ ฐานะ ภาวะ อิสระ ธุระ สาธารณะ โดยเฉพาะ ผ้าไหม ไหมพรม ป้องกัน ประกัน ประกันภัย สำคัญ แบ่งปัน กันยายน กันชน กลางวัน ทุกวัน วันนี้ เมื่อวาน พรุ่งนี้ ตอนนี้ ตอนเช้า เช้า เย็น กลางคืน ปีนี้ ปีหน้า สัปดาห์ นาทีนี้ "
    "ที่นี่ ที่นั่น ที่ดิน ที่ทำงาน ที่อยู่ ที่ประชุม ที่สุด หน้าที่ เจ้าหน้าที่ พื้นที่ แผนที่ สถานที่ ทันที เต็มที่ คนที่ อย่าง ต่าง อื่น ทุก บาง หลาย แต่ละ เพียง เท่านั้น มากมาย ประชากร ชุมชน ครอบครัว เด็ก ผู้ชาย ผู้หญิง ผู้ใหญ่ เพื่อน พ่อ แม่ พี่ น้อง ลูก ครู นักเรียน หมอ "
    "บ้าน เมือง ถนน ตลาด โรงเรียน โรงพยาบาล วัด ร้าน ร้านอาหาร น้ำ น้ำท่วม ฝน ลม ไฟ ดิน ป่า ป่าไม้ ภูเขา แม่น้ำ ทะเล ชายฝั่ง อากาศ อาหาร ข้าว ปลา หมู ไก่ วัว นก หมา แมว ช้าง ผัก ผลไม้ กล้วย ส้ม มะม่วง รถ รถไฟ เรือ เครื่องบิน โทรศัพท์ คอมพิวเตอร์ "
    "ข้อมูล งบประมาณ แผน แบบจำลอง บัญชี ภาพ จรวด ดาวเทียม วงโคจร เรดาร์ การ ความ งาน เงิน ราคา เศรษฐกิจ การเมือง กฎหมาย สังคม วัฒนธรรม การศึกษา สุขภาพ สิ่งแวดล้อม เทคโนโลยี วิทยาศาสตร์ ปัญหา คำถาม คำตอบ ผล ผลลัพธ์ เหตุ เหตุผล เรื่อง เวลา โลก ไทย ภาษา หนังสือ ข่าว ชื่อ "
    "กรุงเทพ เชียงใหม่ ภาคเหนือ ภาคใต้ สีแดง สีเขียว สีขาว สีดำ ครั้งแรก ตัวเอง ตัวอย่าง หน้าต่าง ข้อเสนอ ประเทศไทย โดยรวม รวมถึง พร้อมกัน ทั้งหมด ทั้งสอง เพราะฉะนั้น จนถึง ต่อไป ต่อเนื่อง ถึงแม้ หลังคา ก่อนหน้า ของขวัญ ในหลวง อันตราย อันดับ ว่าง จากไป"
).split()
_CUES = {w: "s" for w in THAI_OPENING} | {w: "g" for w in THAI_GOING_ON} | {w: "u" for w in THAI_UNITS} | {w: "f" for w in THAI_FINAL if w not in THAI_GOING_ON}
_THAI = {w: "w" for w in THAI_COMMON} | {w: "v" for w in THAI_PREDICATES} | _CUES
_LONGEST = max(map(len, _THAI))
_PREDICATES, _FINALS = frozenset(THAI_PREDICATES), frozenset(THAI_FINAL)
#: Characters of a stretch no dictionary word covers from which on it can hold a predicate, so can be a clause.
UNKNOWN_CLAUSE = 12
#: Characters of a learned opening, and the share of the documents with it after a space that it must open paragraphs in.
HEAD, OPENS = 6, 0.4
_RUN = regex.compile(r"[\p{L}\p{M}]+")
_COUNTED = regex.compile(r"([\p{L}\p{M}]+)\s*[\d.,]+\s*[\p{L}\p{M}]+$")
_NUMBER = regex.compile(r"[\d.,]*$")
_GOES_ON = regex.compile(r"[\p{M}ะาำๆ]")


def word_lattice(s: str, dictionary: dict[str, str] = _THAI, longest: int = _LONGEST) -> list[str]:
    """Words of the cheapest path through the lattice of dictionary words; characters no word covers join up to unknown words."""
    best = [(0.0, -1, False)] + [(1e9, -1, False)] * len(s)
    for i in range(len(s)):
        cost, _, known = best[i]
        if cost + 1.2 < best[i + 1][0]:
            best[i + 1] = (cost + 1.2, i, False)
        for j in range(i + 2, min(len(s), i + longest) + 1):
            if s[i:j] in dictionary and not (j < len(s) and _GOES_ON.match(s[j])) and cost + 1.5 < best[j][0]:
                best[j] = (cost + 1.5, i, True)
    words, j = [], len(s)
    while j > 0:
        _, i, known = best[j]
        if not known and words and words[-1][1] is False:
            words[-1] = (s[i:j] + words[-1][0], False)
        else:
            words.append((s[i:j], known))
        j = i
    return [w for w, _ in reversed(words)]


@lru_cache(8192)
def _run_cues(run: str) -> tuple[str | None, str | None, str | None, bool]:
    """Cues of a run of letters: kind of its first word, its first particle if it holds nothing else, the particle it ends in, whether it can be a clause."""
    words = word_lattice(run)
    last = words[-1] if words[-1] in _FINALS else None
    # A syllable of two letters after letters no word covers is rather the end of a longer word.
    if last and len(last) < 3 and len(words) > 1 and words[-2] not in _THAI:
        last = None
    # After การ and ความ a predicate is a noun.
    clause = any(w in _PREDICATES and (k == 0 or words[k - 1] not in ("การ", "ความ")) or w not in _THAI and len(w) >= UNKNOWN_CLAUSE for k, w in enumerate(words))
    return _THAI.get(words[0]), words[0] if all(w in _FINALS for w in words) else None, last, clause


def _is_spaceless(c: str) -> bool:
    return bool(_SPACELESS.match(c))


def _spaceless(s: str, openings: frozenset[str]) -> list[int]:
    """Starts of the sentences of a paragraph in a script without full stops: every space between words is a gap to classify.

    A gap is a cut before an opening word and after a closing particle, none before a particle or a word that goes on; without
    any of these it is one if what stands on both sides can be a clause.
    """
    cuts = set(_spaced(s))
    depth = _quote_spans(s)
    runs = {m.end(): m.group() for m in _RUN.finditer(s)}
    reach = quote = line = 0
    for m in re.finditer(r"\s+", s):
        a, b = m.span()
        while quote < len(depth) and depth[quote][0] < a:
            reach = max(reach, depth[quote][1])
            quote += 1
        start, line = line, b if "\n" in m.group() else line
        if a == 0 or b == len(s) or b < reach:
            continue
        left, right = s[a - 1], s[b]
        if not _is_spaceless(right):
            continue  # numbers, Latin names and marks belong to their clause
        if _LIST_HEAD.fullmatch(s, start, a):
            continue
        run = _RUN.match(s, b).group()
        kind, particle, _, clause = _run_cues(run)
        if particle and _is_spaceless(left):
            continue  # particles belong to the clause before them
        final, before = _run_cues(runs[a])[2:] if _is_spaceless(left) and a in runs else (None, True)
        # After what a number counts the clause is what stands before the number.
        if not before and _run_cues(runs[a])[0] == "u" and (counted := _COUNTED.search(s, 0 if a < 80 else a - 80, a)):
            before = _run_cues(counted[1])[3]
        if run[:HEAD] in openings:
            kind = "s"
        if kind == "s" or final in THAI_CLOSING:
            cuts.add(b)
        elif kind in ("g", "u"):
            continue
        elif _is_spaceless(left):
            if final or before and clause:
                cuts.add(b)
        elif left in "%)”»\"ๆฯ" or left.isdigit() and clause and _measures(s, runs, a):
            cuts.add(b)
    return sorted(cuts)


def _measures(s: str, runs: dict[int, str], end: int) -> bool:
    """Whether the number that ends at `end` is a value (after a word like "to", "from" or "about"): it ends its clause unless what it counts follows."""
    at = _NUMBER.search(s, max(0, end - 40), end).start()
    while at and s[at - 1].isspace():
        at -= 1
    return at in runs and _THAI.get(word_lattice(runs[at])[-1]) == "g"


def sentence_starts(text: str | None, rows: bool = False, openings: frozenset[str] = frozenset()) -> list[int]:
    """Offsets of the first characters of the sentences of a text."""
    if not text or not text.strip():
        return []
    out, at = [], 0
    for stop, nxt in [*((m.start(), m.end()) for m in _BLANK.finditer(text)), (len(text), len(text))]:
        p = text[at:stop]
        lead = len(p) - len(p.lstrip())
        if lead < len(p):
            if rows:
                out.append(at + lead)
            else:
                own = _spaceless(p, openings) if _SPACELESS.search(p) else _spaced(p)
                out.extend(at + k for k in own)
        at = nxt
    return out


def openings_of(docs: DataFrame, key: str, text: str) -> frozenset[str]:
    """Openings of Thai paragraphs: their first HEAD characters, if the documents with a paragraph (longer than a heading) they open are at least OPENS of those in which they follow a space inside one.

    Counted over all documents with partial aggregation; a share, so more documents of the same kind change nothing. What comes
    back are all such heads that also follow a space, at most one a form of HEAD characters; the others could decide no gap.
    """
    paragraphs = docs.filter(F.col(text).rlike(r"\p{IsThai}")).select(key, F.explode(F.split(F.col(text), r"\n\s*\n")).alias("p")).filter(F.length("p") > 60)
    thai = rf"(\p{{IsThai}}{{{HEAD}}})"
    first = F.transform(F.array_except(F.array(F.regexp_extract("p", rf"^\s*{thai}", 1)), F.array(F.lit(""))), lambda h: F.struct(h.alias("h"), F.lit(True).alias("opens")))
    inside = F.transform(F.array_distinct(F.regexp_extract_all("p", F.lit(rf"(?<=\S)\s+{thai}"), F.lit(1))), lambda h: F.struct(h.alias("h"), F.lit(False).alias("opens")))
    heads = paragraphs.select(key, F.explode(F.concat(first, inside)).alias("x")).select(key, "x.h", "x.opens").distinct()
    counts = heads.groupBy("h").agg(F.count_if("opens").alias("a"), F.count_if(~F.col("opens")).alias("z"))
    return frozenset(r["h"] for r in counts.filter((F.col("z") > 0) & (F.col("a") >= OPENS * F.col("z"))).select("h").toLocalIterator())


def _cut(docs: DataFrame, key: str, text: str, formato: str | None) -> DataFrame:
    """key, _t and _s, the starts of its sentences, for every row with a text; no shuffle."""
    rows = F.coalesce(format_name(F.col(formato)).isin(*ROW_FORMATS), F.lit(False)) if formato else F.lit(False)
    docs = docs.select(F.col(key).alias(key), F.col(text).alias("_t"), rows.alias("_rows")).filter(F.col("_t").rlike(r"(?U)\S"))
    openings = openings_of(docs, key, "_t")

    @F.pandas_udf("array<int>")
    def starts(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, table in batches:
            yield pd.Series([sentence_starts(t, bool(r), openings) for t, r in zip(texts, table, strict=True)])

    # Marked as not deterministic, so that the filter that goes with an explode does not make it run twice.
    return docs.select(key, "_t", starts.asNondeterministic()("_t", "_rows").alias("_s"))


def sentences(docs: DataFrame, key: str = "doc_id", text: str = "texto_completo", formato: str | None = "formato") -> DataFrame:
    """(key, orden, inicio, oracion): the sentences of every document in order."""
    cut = _cut(docs, key, text, formato)
    ends = F.concat(F.slice("_s", 2, F.greatest(F.size("_s"), F.lit(1))), F.array(F.length("_t")))
    cut = cut.select(key, "_t", F.posexplode(F.arrays_zip(F.col("_s").alias("a"), ends.alias("z"))).alias("orden", "x"))
    oracion = F.regexp_replace(F.substring(F.col("_t"), F.col("x.a") + 1, F.col("x.z") - F.col("x.a")), r"(?U)\s+$", "")
    return cut.select(key, "orden", F.col("x.a").alias("inicio"), oracion.alias("oracion")).distinct()


def sentence_offsets(docs: DataFrame) -> DataFrame:
    """(doc_id, inicio)."""
    return _cut(docs, "doc_id", "texto_completo", "formato").select("doc_id", F.explode("_s").alias("inicio")).distinct()
