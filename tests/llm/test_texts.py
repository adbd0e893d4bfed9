import itertools
import random

import pytest

from lumbrera.llm import language, pages, scans, sentences


# --- sentences ---------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "text, want",
    [
        ("El Sr. Abreu midió 2.75 metros. Después cerró el pozo.", 2),
        ("La delegación viajó a EE.UU. Mientras tanto, llovió.", 2),
        ("En EE.UU. se observó algo. Fin.", 2),
        ("R. M. Ibarra firmó el acta. Nadie se opuso.", 2),
        ("La cifra creció... pero bajó. Fin.", 2),
        ("Hubo 3 casos (véase la tabla 3.2) en Isla Corvina… Otra frase.", 2),
        ("«Hay que esperar. No tenemos datos», dijo la Dra. Ruiz. Otra.", 2),
        ("El Gral. Vega afirmó: «Los datos ya llegaron.» La red cayó.", 2),
        ('"We have to wait. There is no new data," said Dr. Holm.', 1),
        ("—No habrá prórroga —respondió Vega—, aunque llovió. Otra.", 2),
        ("“我们必须等待。目前没有新数据。”负责人这样说。轨道监测中心发布了计划。", 2),
        ("「待つしかない。新しいデータはない。」と担当者は述べた。次の文。", 2),
        ("資料report.v72.pdfによれば、発表したという。次。", 2),
        ("“हमें रुकना होगा। नए आँकड़े नहीं हैं”, निदेशक ने कहा। डॉ. वरेणकर ने कहा।", 2),
        ("قال د. سالمين إنه قارن. لم يتوقع أحد ما حدث! ارتفع من 77.16 إلى 68.45 في عام 2024.", 3),
        ("ดัชนีเพิ่มจาก 38.3 เป็น 85.42 สภาชุมชนทบทวนข้อมูลใน 87 อำเภอ นอกจากนี้คณะกรรมการระงับแผน", 3),
        ("1. Primero.\n2. Segundo sin punto\n3. Tercero.", 3),
        ("Nota técnica 16: la calibración\n\nMientras tanto, el Ing. Ruiz\nrevisó el plan. Véase la pág. 9 del art. 12.", 3),
        ("funds.The council met. See www.orbita.example/data.html for report.v17.pdf now.", 3),
        ("La Cía. Lumbre S.A. entregó cables, etc. El equipo volvió a las 9 a.m. en Lima.", 2),
        ("¿Qué ocurre? ¡Nada! ¿¡Cómo!? Bien.", 4),
        ("Env. 75 cas (voir tabl. 3.2) à Lima… M. Ruiz a dit non ! Que faire ?", 3),
        ("", 0),
        ("  \n\n ", 0),
    ],
)
def test_sentences(text, want):
    at = sentences.sentence_starts(text)
    assert len(at) == want, [text[a:b] for a, b in zip(at, [*at[1:], len(text)])]
    assert all(not text[a].isspace() for a in at)


@pytest.mark.parametrize(
    "parts",
    [
        ("เขาไปตลาดแล้ว ครับ ", "ผมกลับบ้าน"),  # a particle after a space belongs to the clause before
        ("ครูสอนภาษาไทยนะคะ ", "และนักเรียนอ่านหนังสือ"),  # a closing particle decides over a word that goes on
        ("ฉันซื้อ แมว หมา นก",),  # spaces of a list
        ("เขาได้ชนะ การประชุม",),  # -นะ is no particle there
        ("นักเรียนอ่านหนังสือ ", "ครูเขียนคำถาม"),
        ("ดัชนีเพิ่มขึ้น 25.63 เปอร์เซ็นต์ ", "ศูนย์เฝ้าระวังวงโคจรวิเคราะห์ข้อมูล"),
    ],
)
def test_thai_words_on_both_sides_of_a_space(parts):
    text = "".join(parts)
    at = sentences.sentence_starts(text)
    assert [text[a:b] for a, b in zip(at, [*at[1:], len(text)])] == list(parts)


def test_rows_are_sentences():
    t = "id: 1, v: 3.5. X\n\nid: 2, v: Y. Z"
    assert sentences.sentence_starts(t, rows=True) == [0, t.index("id: 2")]


def test_long_texts_and_unclosed_marks():
    long = "«Sin cierre. " + "Frase número uno. " * 3000
    assert len(sentences.sentence_starts(long)) == 3001
    assert sentences.sentence_starts("a" * 100_000) == [0]


def test_sentences_table(spark):
    schema = "doc_id string, formato string, texto_completo string, inicio int"
    df = spark.createDataFrame([("a", " CSV", "x: 1. Y\n\nx: 2", 0), ("b", None, "Uno. Dos.", 0), ("b", None, "Uno. Dos.", 0), ("c", "pdf", None, 0), ("d", "pdf", " ", 0)], schema)
    assert sorted(tuple(r) for r in sentences.sentence_offsets(df).collect()) == [("a", 0), ("a", 9), ("b", 0), ("b", 5)]
    assert [r.oracion for r in sentences.sentences(df).filter("doc_id = 'b'").orderBy("orden").collect()] == ["Uno.", "Dos."]
    assert sentences.sentences(df.limit(0)).count() == 0


def test_learned_openings_are_shares(spark):
    fill = "นักเรียนอ่านหนังสือ " * 4
    one = [(f"{fill}\n\nพยากรณ์นี้{fill}พยากรณ์นั้น{fill}และโครงข่าย{fill}\n\nบท",), (f"{fill}และโครงข่าย{fill}",), (f"{fill}และโครงข่าย{fill}\n\nและโครงข่าย{fill}",)]
    frames = [spark.createDataFrame([(f"{k}-{j}", t) for k in range(n) for j, (t,) in enumerate(one)], "doc_id string, t string") for n in (1, 30)]
    got = [sentences.openings_of(df, "doc_id", "t") for df in frames]
    # The size of the table decides nothing; a head that mostly follows a space inside paragraphs is none, however often it opens one.
    assert got[0] == got[1]
    assert "พยากรณ์"[:6] in got[0] and "และโครงข่าย"[:6] not in got[0]
    # More than 500 openings.
    thai = "กขคงจฉชซ"
    many = ["".join(thai[(k >> s) & 7] for s in (0, 3, 6, 9)) + "ดต" for k in range(600)]
    df = spark.createDataFrame([(h, f"{h}{fill}{h}{fill}") for h in many for _ in range(2)], "doc_id string, t string")
    assert set(many) <= sentences.openings_of(df, "doc_id", "t")


# --- languages ---------------------------------------------------------------------------------------------------------------

PROSE = {
    "es": "El consejo de la cuenca revisó los datos con las familias porque llovía mucho en la costa y se cerró el paso.",
    "en": "The council of the basin reviewed the data with the families because it was raining on the coast and the road was closed.",
    "pt": "O conselho da bacia revisou os dados com as famílias porque chovia muito na costa e não havia mais passagem.",
    "fr": "Le conseil du bassin a revu les données avec les familles parce que la pluie tombait sur la côte et que la route était fermée.",
    "zh": "流域委员会与居民一起审查了数据。",
    "ja": "流域の評議会は住民とともにデータを検討した。",
    "ar": "راجع مجلس الحوض البيانات مع العائلات.",
    "hi": "ग्राम परिषद ने परिवारों के साथ आँकड़ों को जाँचा।",
    "th": "สภาชุมชนทบทวนข้อมูลกับครอบครัว",
}
CORPUS = "doc_id string, idioma string, texto_completo string, parrafo int"


def test_paragraph_languages(spark):
    rng = random.Random(1)
    rows, truth = [], {}
    for k in range(60):
        langs = [rng.choice(list(PROSE)) for _ in range(4)]
        rows.append((f"d{k}", rng.choice(["ES", "eng", "pt-BR", "und", None, "de"]), "\n\n".join(PROSE[x] for x in langs), 9))
        truth[f"d{k}"] = langs
    rows += [("n", "es", None, 9), ("v", "es", "  ", 9), ("d0", *rows[0][1:])]
    df = spark.createDataFrame(rows, CORPUS)
    got = language.paragraph_languages(df).collect()
    assert len(got) == 240 and sum(truth[r.doc_id][r.parrafo] == r.idioma for r in got) >= 238
    assert all(0 <= r.confianza <= 1 for r in got)
    codes = {"ES": "es", "eng": "en", "pt-BR": "pt"}
    labels = {r[0]: codes.get(r[1]) for r in rows}
    wrong = {(r.doc_id, r.parrafo) for r in language.mislabelled_paragraphs(df).collect()}
    assert wrong == {(r.doc_id, r.parrafo) for r in got if labels[r.doc_id] != r.idioma}
    seg = language.language_segments(df).filter("doc_id = 'd1'").orderBy("tramo").collect()
    assert [s.idioma for s in seg] == [k for k, _ in itertools.groupby(r.idioma for r in sorted((r for r in got if r.doc_id == "d1"), key=lambda r: r.parrafo))]
    assert language.paragraph_languages(df.limit(0)).count() == 0


def test_blank_and_letterless_paragraphs():
    lab = language.Labeller(language.learn_words(list(PROSE.values())))
    got = lab.paragraphs(f"{PROSE['es']}\n\n\n\n123 45\n\n{PROSE['ar']}")
    assert [(k, x) for k, _, _, x, _ in got] == [(0, "es"), (2, "es"), (3, "ar")]
    assert lab.paragraphs("12 34") == [] == lab.paragraphs(None)


def _tables(rng, n):
    """Documents of prose in one language and of table rows in three, which no function word tells."""
    names = ["Alto Mirabal", "Puerto Almagre", "San Orlando del Mar", "Nova Aldeira", "Port Halloway"]
    parts = {"es": ("El consejo de la cuenca", "las familias de la costa", "revisó los datos con"), "en": ("The council of the basin", "the families on the coast", "reviewed the data with"), "pt": ("O conselho da bacia", "as famílias da costa", "revisou os dados com"), "fr": ("Le conseil du bassin", "les familles de la côte", "a revu les données avec")}
    rows = {"es": ("municipio", "nivel", ("bajo", "medio", "alto"), "casos"), "pt": ("município", "nível", ("baixo", "médio", "alto"), "casos"), "en": ("district", "level", ("low", "medium", "high"), "cases")}
    out = []
    for k in range(n):
        if k % 3:
            lang = rng.choice(["es", "es", "es", "en", "pt", "fr"])
            a, b, c = parts[lang]
            out.append((lang, "\n\n".join(" ".join(rng.sample([a, f"{c} {b}", b, f"{a} {c}"], 3)) + f" {rng.randint(1, 99)}." for _ in range(3))))
        else:
            lang = rng.choice(["es", "es", "pt", "en"])
            m, v, levels, cases = rows[lang]
            out.append((lang, "\n\n".join(f"id: {j}, {m}: {rng.choice(names)}, {v}: {rng.choice(levels)}, {cases}: {rng.randint(0, 999)}" for j in range(4))))
    return out


def test_samples_of_any_size_give_the_same_labels():
    rng = random.Random(11)
    docs = _tables(rng, 600)
    labels = []
    for k in range(10):
        lab = language.Labeller(language.learn_words([t for _, t in rng.sample(docs, 30 + 50 * k)]))
        labels.append([x[3] for r in lab.batch([t for _, t in docs]) for x in r])
    truth = [lang for lang, t in docs for _ in t.split("\n\n")]
    same = sum(len(set(x)) == 1 for x in zip(*labels)) / len(truth)
    assert same >= 0.999 and sum(a == b for a, b in zip(labels[0], truth)) / len(truth) >= 0.999


def test_paragraph_steps_are_the_path_over_words():
    rng = random.Random(5)
    model = language.learn_words([t for _, t in _tables(rng, 300)])
    lab = language.Labeller(model)
    words = "el la de que the of and o os não le les du con with pour dados datos data 数据 のデータ بيانات Lima 7 -".split()
    texts = ["\n\n".join(" ".join(rng.choice(words) for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(1, 5))) for _ in range(400)]
    whole = lab._word_path
    for t, got in zip(texts, lab.batch(texts)):
        spans = [p.split() for p in t.split("\n\n")]
        ids = [lab.ids[x] for s in spans for x in s]
        if not got or any(p[4] == 0.5 for p in got):
            continue
        names = [n for s in spans for n in language._like_names(s)]
        v = language.np.array([lab.rows[i][9:18] if n else lab.rows[i][:9] for i, n in zip(ids, names)])
        path = whole(v, language.np.array([lab.rows[i][18] for i in ids]), language.np.array([len(s) for s in spans]))
        assert [language.LANGUAGES[c] for c in path] == [x[3] for x in got], t


def test_blocks_of_paragraphs_change_nothing(monkeypatch):
    docs = [t for _, t in _tables(random.Random(8), 200)]
    lab = language.Labeller(language.learn_words(docs))
    whole = lab.batch([*docs, None, " ", "\n\n".join(docs)])
    monkeypatch.setattr(language, "BLOCK", 7)
    assert lab.batch([*docs, None, " ", "\n\n".join(docs)]) == whole


def test_confidence_of_held_out_pieces():
    model = language.learn_words([t for _, t in _tables(random.Random(3), 600)])
    assert model.slope > 0
    lab = language.Labeller(model)
    sure, doubtful = (lab.paragraphs(t)[0][4] for t in ("El consejo de la cuenca revisó los datos con las familias.", "Plan total"))
    assert sure > 0.95 > doubtful
    margin = language.np.array([0.0, 0.1, 0.2, 2.0, 3.0, 4.0] * 50)
    slope, offset = language._calibrated(margin, language.np.array([0.0, 1, 0, 1, 1, 1] * 50))
    assert slope > 0 and 1 / (1 + 2.718281828 ** -(3 * slope + offset)) > 0.9 > 1 / (1 + 2.718281828**-offset)


# --- pages -------------------------------------------------------------------------------------------------------------------


def brute_cut(source, sink, edges):
    return min(sum(sink[k] if m[k] else source[k] for k in range(len(m))) + sum(w for a, b, w in edges if m[a] != m[b]) for m in itertools.product((False, True), repeat=len(source)))


def test_minimum_cut():
    rng = random.Random(3)
    for _ in range(200):
        n = rng.randint(1, 8)
        s, t = ([rng.choice([0, 0, 1.5, 3, 5]) for _ in range(n)] for _ in range(2))
        edges = [(a, b, rng.choice([0.3, 1, 2.5])) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.5]
        m = pages.minimum_cut(s, t, edges)
        cost = sum(t[k] if m[k] else s[k] for k in range(n)) + sum(w for a, b, w in edges if m[a] != m[b])
        assert cost == pytest.approx(brute_cut(s, t, edges))


BODY = ["La red de radares revisó los enlaces de telemetría tras nueve meses de trabajo de campo en la costa.", "Metodología", "Los sensores", "Los drones", "El comité revisó la política de cookies de los portales públicos y pidió reglas más claras para las redes.", "El consejo publicó después un mapa de las veredas en riesgo con apoyo de las familias de la cuenca."]
SITE = ["Saltar al contenido", "Inicio | Contacto | Noticias", "Este sitio utiliza cookies para mejorar su experiencia."]
END = ["Lo más leído", "Informe sobre la minería", "Nota técnica 3: los drones", "Suscríbase a nuestro boletín semanal", "© 2024 Trama Rural. Todos los derechos reservados."]


def test_pages(spark):
    whole = [*SITE, "Informe sobre los enlaces", "Compartir", BODY[0], *BODY[1:4], "Publicidad", *BODY[4:], *END]
    rows = [("a", "html", "\n\n".join(whole), 1), ("b", None, "\n".join(SITE + END), 1), ("c", "json", "\n\n".join(BODY), 1), ("d", "html", None, 1), ("e", "html", " ", 1), ("a", "html", "\n\n".join(whole), 1)]
    df = spark.createDataFrame(rows, "doc_id string, formato string, texto string, linea int")
    got = {(r.doc_id, r.linea) for r in pages.boilerplate_lines(df).collect()}
    keep = {"Informe sobre los enlaces", *BODY}
    want = {("a", 2 * k) for k, s in enumerate(whole) if s not in keep} | {("b", k) for k in range(len(SITE + END))}
    assert got == want
    text = {r.doc_id: r.texto_principal for r in pages.main_text(df).collect()}
    assert text == {"a": "\n".join(s for s in whole if s in keep), "b": ""}
    assert pages.boilerplate_lines(df.limit(0)).count() == 0


def test_long_page():
    t = "\n".join(SITE + BODY * 800 + END)
    got = pages.label_lines(t, {}, True)
    assert sum(b for _, b in got) == len(BODY) * 800


def test_long_menu_rows_are_counted(spark):
    menu = " ".join(["Hidrometeorología", "Telecomunicaciones", "Aeronavegabilidad", "Sismorresistencia", "Biodiversidad"] * 3)
    assert len(menu) > 200 and len(menu.split()) <= 25
    df = spark.createDataFrame([(f"d{k}", f"{menu}\n{BODY[0]} {k}") for k in range(4)], "doc_id string, t string")
    share = pages.frequent_lines(df, "doc_id", "t").get(pages.line_key(menu), 0.0)
    assert share == 1.0 and pages.line_costs(menu, share) == (4.0, "w")


# --- scans -------------------------------------------------------------------------------------------------------------------


def test_confusable_glyphs_share_a_skeleton():
    for a, b in (("campo", "carnpo"), ("respaldó", "respalcló"), ("minería", "mincría"), ("evasión", "evasi6n"), ("telemetría", "telernetría"), ("observación", "obser\\/ación"), ("sobre", "so6re"), ("misión", "misióri"), ("propulsão", "propuls5o")):
        assert scans.skeleton(a) == scans.skeleton(b)
    assert scans.skeleton("paso") != scans.skeleton("peso") != scans.skeleton("pero")


def scan(lines, width=60):
    out, cur = [], ""
    for w in " ".join(lines).split():
        if len(cur) + 1 + len(w) > width:
            out.append(cur)
            cur = w
        else:
            cur = f"{cur} {w}".strip()
    return [*out, cur]


@pytest.fixture(scope="module")
def scanned():
    rng = random.Random(7)
    words = "la red de radares revisó los enlaces de telemetría tras nueve meses de trabajo de campo mientras el consejo publicó un mapa de veredas con apoyo de las familias".split()
    clean = [" ".join(rng.choice(words) for _ in range(200)) + "." for _ in range(30)]
    body = scan([clean[0]])
    body[3] = body[3].replace("e", "c", 1) if "e" in body[3] else body[3]
    lines = ["Informe sobre los radares", "", *body[:6], "- 4 -", "INFORME SOBRE LOS RADARES", *body[6:12], "- 5 -", "Informe sobre los radares   6", *body[12:]]
    return clean, lines


def test_scan_lines_and_repair(spark, scanned):
    clean, lines = scanned
    target = next(k for k, s in enumerate(lines) if k > 12 and s.split()[-1] in ("radares", "telemetría", "familias", "trabajo") and lines[k + 1][:1].islower())
    word = lines[target].split()[-1]
    lines = list(lines)
    lines[target] = lines[target][: -len(word)] + word[:4] + "-"
    lines[target + 1] = word[4:] + " " + lines[target + 1]
    rows = [("s", "png", "\n".join(lines), 1)] + [(f"l{k}", "txt", t, 1) for k, t in enumerate(clean)] + [("n", "png", None, 1), ("v", "tif", "", 1), ("s", "png", "\n".join(lines), 1)]
    df = spark.createDataFrame(rows, "doc_id string, formato string, texto string, w int")
    got = {(r.linea, r.tipo) for r in scans.noisy_lines(df).collect() if r.doc_id == "s"}
    heads = {k for k, s in enumerate(lines) if k and "informe sobre los radares" in s.lower()}
    assert {k for k, t in got if t == "cabecera"} == heads
    assert {k for k, t in got if t == "folio"} == {k for k, s in enumerate(lines) if s.startswith("- ")}
    assert {k for k, t in got if t == "guion"} == {target}
    assert {k for k, t in got if t == "caracter"} == {5}
    assert not [r for r in scans.noisy_lines(df).collect() if r.doc_id != "s"]
    text = {r.parrafo: r.texto for r in scans.repaired_paragraphs(df).collect() if r.doc_id == "s"}
    assert text == {0: "Informe sobre los radares", 1: clean[0]}
    assert scans.noisy_lines(df.limit(0)).count() == 0 and scans.repaired_paragraphs(df.limit(0)).count() == 0


def test_compounds_keep_their_hyphen(spark):
    rows = [(f"d{k}", "txt", "El enfoque costo-beneficio y el plan político-militar con telemetría y observación", 0) for k in range(10)]
    lines = ["La oficina comparó los datos de la cuenca con un enfoque costo-", "beneficio y la red de radares publicó los enlaces de tele-", "metría en nueve municipios de la costa por encargo del grupo", "de trabajo que los había pedido."]
    df = spark.createDataFrame([*rows, ("s", "tif", "\n".join(lines), 0)], "doc_id string, formato string, texto string, x int")
    assert {(r.linea, r.tipo) for r in scans.noisy_lines(df).collect()} == {(1, "guion")}
    assert "costo-beneficio" in scans.repaired_paragraphs(df).first().texto and "telemetría" in scans.repaired_paragraphs(df).first().texto


def test_right_form_behind_many_of_its_skeleton(spark):
    seen, right = "n1", "ni"
    others = [w for w in ("m", "ul", "hl", "ur", "hr", "iii", "lii", "rll") if scans.skeleton(w) == scans.skeleton(seen)]
    assert len(others) >= 6 and scans.skeleton(right) == scans.skeleton(seen)
    counts = spark.createDataFrame([(w, 1000 + k) for k, w in enumerate(others)] + [(right, 100), (seen, 1)], "w string, n bigint")
    words = spark.createDataFrame([("d", 0, 0, seen)], "doc_id string, linea int, k int, w string")
    assert [tuple(r) for r in scans.misread_forms(words, counts).collect()] == [(seen, right)]


def test_every_reading_of_a_broken_word(spark):
    rows = [(f"d{k}", "txt", "La evasión fiscal y la propulsão del satélite", 0) for k in range(10)]
    lines = ["La oficina comparó los datos de la cuenca con los de la eva-", "si6n fiscal y la red de radares publicó un mapa de la propul-", "s5o en nueve municipios de la costa por encargo de un grupo", "de trabajo que los había pedido."]
    df = spark.createDataFrame([*rows, ("s", "tif", "\n".join(lines), 0)], "doc_id string, formato string, texto string, x int")
    assert {(r.linea, r.tipo) for r in scans.noisy_lines(df).collect()} == {(0, "guion"), (1, "guion"), (1, "caracter"), (2, "caracter")}
    text = scans.repaired_paragraphs(df).first().texto
    assert "evasión" in text and "propulsão" in text


def test_skeletons_of_columns(spark):
    words = ["telernetría", "ob8er\\/ación", "5o6re", "awd|m@", "çq9g", "nuhml1", "55666", ""]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    assert [r.s for r in df.select(scans._skeleton("w").alias("s")).collect()] == [scans.skeleton(w) for w in words]
    # One skeleton however many doubtful signs a word holds.
    assert scans.skeleton("a" + "56" * 40) == "a" + "so" * 40


def test_both_sides_of_the_limits_of_a_scan():
    def lines(width, head="", folio=""):
        words = ("la red de radares midió los enlaces y el consejo publicó un mapa " * 40).split()
        out, cur = [], ""
        for w in words:
            if len(cur) + 1 + len(w) > width:
                out.append(cur)
                cur = w
            else:
                cur = f"{cur} {w}".strip()
        return "\n".join(["Informe anual", *out[:4], *([folio] if folio else []), *([head] if head else []), *out[4:8], *([head] if head else []), *out[8:]])

    assert scans.read_lines(lines(scans.WIDE - 5), False) and not scans.read_lines(lines(scans.WIDE + 25), False)
    assert scans.read_lines(lines(scans.NARROW + 5), False) and not scans.read_lines(lines(scans.NARROW - 8), False)
    assert scans.read_lines(lines(scans.WIDE + 25), True)
    of = lambda t, kind: [r["texto"] for r in scans.read_lines(t, True) if r["clase"] == kind]
    assert of(lines(60, folio="Página 12 de 34"), "f") == ["Página 12 de 34"] and not of(lines(60, folio="Página 1234 de 3456"), "f")
    short, long = (" ".join(["Boletín", *["x"] * n]) for n in (scans.HEAD_WORDS - 1, scans.HEAD_WORDS))
    assert of(lines(60, head=short), "c") == [short] * 2 and not of(lines(60, head=long), "c")


def test_labels(spark):
    from pyspark.sql import functions as F

    from lumbrera.llm.labels import format_name, language_code

    df = spark.createDataFrame([(" Español ", ".HTML"), ("es_PE", "htm"), ("EN-us", "JPEG "), ("nan", ""), (None, None), ("und", "tiff")], "l string, f string")
    assert [tuple(r) for r in df.select(language_code(F.col("l")), format_name(F.col("f"))).collect()] == [("es", "html"), ("es", "html"), ("en", "jpg"), (None, None), (None, None), (None, "tif")]


# --- pages in languages without phrases ----------------------------------------------------------------------------------------

FOREIGN = {
    "zh": (["首页", "关于本台", "资料下载", "图片库", "联系方式"], ["雷达网络经过九个月的实地工作之后审查了沿海地区的遥测链路，并公布了结果。", "理事会随后在各流域家庭的支持下发布了风险村庄的地图，并要求增加经费。"], "遥测链路的校准报告", ["隐私说明", "网站地图", "版权归本台所有", "返回顶部"]),
    "ar": (["الرئيسية", "من نحن", "الوثائق", "المكتبة", "اتصل بنا"], ["راجعت شبكة الرادار روابط القياس عن بعد على الساحل بعد تسعة أشهر من العمل الميداني ونشرت النتائج.", "نشر المجلس بعد ذلك خريطة القرى المعرضة للخطر بدعم من عائلات الحوض وطلب مزيدا من الموارد."], "تقرير عن معايرة روابط القياس", ["سياسة الخصوصية", "خريطة الموقع", "جميع الحقوق محفوظة", "أعلى الصفحة"]),
    "hi": (["मुख्य पृष्ठ", "हमारे बारे में", "दस्तावेज़", "पुस्तकालय", "संपर्क"], ["रडार नेटवर्क ने नौ महीनों के क्षेत्रीय काम के बाद तट पर टेलीमेट्री लिंक की जाँच की और परिणाम प्रकाशित किए।", "परिषद ने बाद में परिवारों के समर्थन से जोखिम वाले गाँवों का मानचित्र प्रकाशित किया और धन माँगा।"], "टेलीमेट्री लिंक की रिपोर्ट", ["गोपनीयता नीति", "साइट का नक्शा", "सर्वाधिकार सुरक्षित", "ऊपर जाएँ"]),
    "ja": (["ホーム", "当台について", "資料", "図書室", "お問い合わせ"], ["レーダー網は九か月の現地調査ののち沿岸の遠隔測定回線を検討し、その結果を公表した。", "評議会はその後、流域の住民の協力を得て危険な村の地図を公表し、予算の増額を求めた。"], "遠隔測定回線の校正に関する報告", ["個人情報の扱い", "サイト案内", "無断転載を禁じます", "ページの先頭へ"]),
    "th": (["หน้าแรก", "เกี่ยวกับเรา", "เอกสาร", "ห้องสมุด", "ติดต่อ"], ["เครือข่ายเรดาร์ทบทวนการเชื่อมต่อโทรมาตรบนชายฝั่งหลังจากทำงานภาคสนามเก้าเดือนและเผยแพร่ผลการศึกษาต่อสาธารณชนทั้งหมด", "สภาเผยแพร่แผนที่หมู่บ้านเสี่ยงภัยในเวลาต่อมาโดยได้รับการสนับสนุนจากครอบครัวในลุ่มน้ำและขอเงินเพิ่มจากรัฐบาลกลาง"], "รายงานการสอบเทียบการเชื่อมต่อ", ["นโยบายความเป็นส่วนตัว", "แผนผังเว็บไซต์", "สงวนลิขสิทธิ์", "กลับขึ้นบน"]),
}


@pytest.mark.parametrize("lang", sorted(FOREIGN))
def test_pages_of_languages_without_phrases(spark, lang):
    rng = random.Random(2)
    rows, want, clean = [], set(), set()
    for k in range(60):
        body = [f"{s} {k}." for s in BODY[:1] + BODY[4:]]
        rows.append((f"e{k}", "html", "\n".join([*SITE, f"Informe {k} sobre la red", *body, *END[3:]])))
    menu, sentences_, title, foot = FOREIGN[lang]
    for k in range(20):
        top, end = rng.sample(menu, 4), rng.sample(foot, 3)
        # No two articles are alike: letters of the sentences themselves make the difference.
        own = lambda: "".join(rng.sample([c for c in sentences_[0] if c.isalpha()], 6))
        body = [f"{title} {own()}", *[f"{s[:-1]} {own()}{s[-1]}" for s in sentences_ * 2]]
        lines = [*top, *body, *end]
        rows.append((f"x{k}", "html", "\n".join(lines)))
        want |= {(f"x{k}", j) for j, s in enumerate(lines) if s in top or s in end}
        rows.append((f"c{k}", "txt", "\n".join(body)))
        clean.add(f"c{k}")
    df = spark.createDataFrame(rows, "doc_id string, formato string, texto string")
    got = {(r.doc_id, r.linea) for r in pages.boilerplate_lines(df).collect() if r.doc_id[0] != "e"}
    assert len(got & want) >= 0.95 * len(want) and len(got & want) >= 0.95 * len(got)
    assert not {d for d, _ in got} & clean


def test_the_cut_decides_on_pages_without_sentences():
    got = pages.label_lines("\n".join(SITE + END), {}, True)
    assert len(got) == len(SITE + END) and not any(b for _, b in got)


def test_line_classifier_separates_by_form():
    rng = random.Random(6)
    texts = ["\n".join([*SITE, f"Informe {k} sobre la red", *rng.sample(BODY, 4), *END]) for k in range(40)]
    shares = {pages.line_key(s): 0.9 for s in SITE + END}
    w = pages.learn_lines(texts, shares)
    lines = [*SITE[1:2], BODY[0], "© 2024"]
    odds = pages.line_features(lines, [0.9, 0.0, 0.9]) @ w
    assert odds[0] > 0 > odds[1] and odds[2] > 0
    assert (pages.learn_lines([], {}) == 0).all() and (pages.learn_lines(["una línea"], {}) == 0).all()
