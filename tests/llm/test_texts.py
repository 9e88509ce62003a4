import random
import re
import unicodedata
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from textloom.llm import areas, body, language, pieces, repeated, scans, sentences, shape
from textloom.llm.common import language_of, paragraphs


def table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab .!\n\t。é́中", max_size=300), st.integers(1, 40), st.integers(0, 39))
def test_split_text(text, limit, overlap):
    if overlap >= limit:
        with pytest.raises(ValueError):
            pieces.split_text(text, limit, overlap)
        return
    cut = pieces.split_text(text, limit, overlap)
    assert cut[0][0] == 0 and cut[-1][1] == len(text) and all(b - a <= limit for a, b, _ in cut)
    places = set(pieces.boundaries(text)[0])
    for (a, b, kind), (c, _, _) in zip(cut, cut[1:]):
        assert c == b - overlap
        assert (kind == "duro") == (b not in places)
        if kind == "duro":  # nowhere to cut between the former end and the reach
            former = max([0, *(e for _, e, _ in cut if e < b)])
            assert not [p for p in places if former < p <= a + limit]


def test_repeated_lines(spark, sf):
    docs = table(spark, sf, "mini_corpus")
    rows = {r.doc_id: r for r in docs.collect()}
    norm = lambda s: re.sub(r"/+$", "", re.sub(r"^(\./)+", "", re.sub(r"[\\/]+", "/", s.strip().lower())))
    where, lines, size = defaultdict(set), [], defaultdict(set)
    for r in rows.values():
        if r.fuente:
            size[norm(r.fuente)].add(r.doc_id)
            for k, x in enumerate((r.texto or "").split("\n"), 1):
                if r.texto and sum(c.isalpha() for c in x) >= 4:
                    key = norm(r.fuente), " ".join(re.sub(r"\d+", "#", unicodedata.normalize("NFKC", x).casefold()).split())
                    where[key].add(r.doc_id)
                    lines.append((key, r.doc_id, k))
    want = {(d, k) for key, d, k in lines if len(where[key]) >= 4 and len(where[key]) >= 0.14 * len(size[key[0]])}
    assert {tuple(r) for r in repeated.repeated_lines(docs).collect()} == want and want
    clean = {r.doc_id: r for r in repeated.without_repeated(docs).collect()}
    gone = defaultdict(int)
    for d, _ in want:
        gone[d] += 1
    assert all(clean[d].quitadas >= n for d, n in gone.items())


def test_lines_of_clusters(spark):
    words = "aviso legal del portal regional de datos abiertos sobre el uso de los textos".split()
    line = " ".join(words)
    other = lambda k: " ".join([*words[:9], f"x{'abcdefghij'[k % 10]}{'abcdefghij'[k // 10]}", *words[10:]])
    # under 0.8 like the first, but of its clusters
    far = next(x for x in map(other, range(100)) if (repeated.sketch([line]) == repeated.sketch([x])).all())
    clean = lambda rows: {r.doc_id: r.quitadas for r in repeated.without_repeated(spark.createDataFrame(rows, "doc_id string, fuente string, texto string")).collect()}
    assert clean([(f"a{k}", "F1/x", line) for k in range(6)] + [(f"b{k}", "F1/x", far) for k in range(4)]) == {f"{c}{k}": 1 for c, n in (("a", 6), ("b", 4)) for k in range(n)}
    # two documents with two lines of a cluster each are two documents
    two = [(f"c{k}", "F1/y", f"{line}\n{far}") for k in range(2)]
    assert clean(two) == {"c0": 0, "c1": 0}
    # equal but for dates and names, in either letter case; lines of a document of its own stay
    names = ["Ana Ríos", "Luis del Mar", "Eva Núñez", "Iris Soto", "Omar Paz"]
    notice = [(f"d{k}", "F2/z", f"Texto propio número {'abcde'[k]}\nUna nota preparada para este portal por {n} y publicada el {k + 1} de marzo de 20{k + 10}") for k, n in enumerate(names)]
    assert clean(notice) == {f"d{k}": 1 for k in range(5)}
    # rows of a table are no notices, though alike but for names
    table = [(f"e{k}", "F3/z", "\n".join(f"lugar de la zona norte medida por el equipo de {n} {x}" for x in names)) for k, n in enumerate(names)]
    assert clean(table) == {f"e{k}": 0 for k in range(5)}


def test_sketch_is_alike_in_any_batch():
    a = ["una línea corta", "el aviso legal de la página de la casa", "x", "otra línea que no se parece a las demás en nada"]
    alone = [repeated.sketch([x])[:, 0].tolist() for x in a]
    assert repeated.sketch(a).T.tolist() == alone
    # the minimum over shingles stays if a word is put before the line, unless the new shingle is the least
    assert sum(int(repeated.sketch([f"{w} {a[3]}"])[0, 0]) == alone[3][0] for w in ("uno", "dos", "tres", "cuatro", "cinco")) >= 3


def test_recall_of_alike_lines():
    """Of random pairs of lines at least 0.8 alike, over nine in ten share a cluster."""
    rng = random.Random(5)
    vocabulary = [f"{a}{b}{c}" for a in "bcdlm" for b in "aeiou" for c in ("ro", "sta", "nte", "les")]
    found = total = 0
    while total < 400:
        words = [rng.choice(vocabulary) for _ in range(rng.randint(8, 60))]
        near = [*words]
        for _ in range(rng.randint(1, 3)):
            near[rng.choice([0, 1, len(near) - 1, rng.randrange(len(near))])] = rng.choice(vocabulary)
        a, b = " ".join(words), " ".join(near)
        if a != b and repeated.alike(a, b):
            total += 1
            x = repeated.sketch([a, b])
            found += bool((x[:, 0] == x[:, 1]).any())
    assert found >= 0.9 * total


def test_structures():
    p = shape.Profiles({"es": "de la el en y los con que".split(), "en": "the of and in to a is".split()})
    cases = {
        "prosa": "El barco salió del puerto. Nadie supo por qué no volvió aquella noche.\n\n- la luz\n- la ventana\n\nLos vecinos esperaron en la orilla hasta el día siguiente. Entonces lo vieron.",
        "lista": "• Barco de vela\n• Puerto viejo de la ciudad\nContacto: oficina del puerto\n• Luz de la ventana\n• Orilla",
        "tabla": "Norte\t12\tabierto\nSur\t7\tcerrado\nEste\t19\tabierto",
        "basura": "casa casa casa casa casa casa casa casa casa casa casa casa casa casa casa casa",
    }
    for want, text in cases.items():
        assert p.classify(text) == want, want
    assert shape.divergence(shape._norm(shape.np.array([1.0, 0])), shape._norm(shape.np.array([0, 1.0]))) == pytest.approx(1)


def test_share_of_common_words(spark):
    rows = [("a", "txt", "es", "El río y el valle"), ("b", "TXT", "spa", "zarpa zarpa 12"), ("c", "txt", "es_CO", "zarpa roja"), ("c", "txt", "es_CO", "zarpa roja"), ("d", "txt", "zh", "河的水"), ("e", "txt", "zh", "山的石"), ("f", "pdf", None, None)]
    df = spark.createDataFrame(rows, "doc_id string, formato string, idioma string, texto string")
    got = {r.doc_id: (r.idioma, r.comunes) for r in shape.common_shares(df, shape.common_words(df)).collect()}
    # zarpa stands in two documents; 12 is a word, but no common one; roja stands in one document, though in two rows
    assert got == {"a": ("es", 0.6), "b": ("es", 0.666667), "c": ("es", 0.5), "d": ("zh", 0.333333), "e": ("zh", 0.333333), "f": (None, 0.0)}


def test_profiles_of_prose_are_of_all_documents(spark):
    words = [f"{a}{b}" for a in "bdfglmnprst" for b in "aeiou"]
    texts = ["El río creció. " + " ".join(w for j, w in enumerate(words) if k % (j + 2) == 0) + f" {'Nadie lo vio. ' * (5 + k % 9)}" for k in range(3300)]
    texts[7] += "sube " * 150_000
    rows = [(f"d{k}", " TXT", "ES" if k % 2 else "spa", t) for k, t in enumerate(texts)]
    rows += [*rows[:50], ("p", "pdf", "es", "zarpa " * 50), ("e", "txt", "en", "The river rose. " * 9), ("s", "txt", "es", "corto"), ("n", "txt", None, texts[0])]
    p = shape.learn_profiles(spark.createDataFrame(rows, "doc_id string, formato string, idioma string, texto string"))
    count = Counter(w for t in [*texts, "corto"] for w in {w.lower() for w in shape.WORD.findall(t)} if len(w) <= 5)
    top = sorted(count, key=lambda w: (-count[w], w))[: shape.TOP_WORDS]
    assert list(p.by_language["es"])[: shape.TOP_WORDS] == top
    assert p.names.count("prosa") == sum(s == "prosa" for s, _ in shape.SAMPLES) + 1  # one text is too few for a profile
    want = shape.np.mean([shape.describe(t, p.functions) for t in texts], axis=0)
    assert p.profiles[-1] == pytest.approx(want, abs=1e-8)
    assert p.zipf["es"] == pytest.approx(shape.np.mean([shape._norm(shape._on_functions(t, p.by_language["es"])) for t in texts], axis=0), abs=1e-8)


@pytest.fixture(scope="module")
def splitter(spark):
    rows = table(spark, "/root/testdata/sf0.01", "mini_corpus").filter("lower(formato) = 'txt' and texto is not null").select("texto").collect()
    return sentences.train([r.texto for r in rows])


@pytest.mark.parametrize(
    "text, want",
    [
        ("El Dr. Undarte habló ante la comisión. Según el acta, nadie votó.", ["El Dr. Undarte habló ante la comisión.", "Según el acta, nadie votó."]),
        ("Creció un 40.42 % en el año. El art. 4 y el núm. 22 siguen.", ["Creció un 40.42 % en el año.", "El art. 4 y el núm. 22 siguen."]),
        ("Vio mapas, antenas, etc. El comité aprobó el plan.", ["Vio mapas, antenas, etc.", "El comité aprobó el plan."]),
        ("«El plan sigue. No hay marcha atrás», advirtió la Sra. Quistral. El comité calló.", ["«El plan sigue. No hay marcha atrás», advirtió la Sra. Quistral.", "El comité calló."]),
        ('According to him, "it is done." The panel agreed.', ['According to him, "it is done."', "The panel agreed."]),
        ("报告人问：“谁来看管？”随后会场沉默。没有人预见到！", ["报告人问：“谁来看管？”随后会场沉默。", "没有人预见到！"]),
        ("ตามบันทึกรายงานเบื้องต้นสนับสนุนแผน จำนวนเพิ่มขึ้นเป็น 14.27 เปอร์เซ็นต์ในปีนี้", ["ตามบันทึกรายงานเบื้องต้นสนับสนุนแผน", "จำนวนเพิ่มขึ้นเป็น 14.27 เปอร์เซ็นต์ในปีนี้"]),
        ("Un título solo\n\nUna línea\nque sigue. Fin", ["Un título solo", "Una línea\nque sigue.", "Fin"]),
        ("La Dra. H. Undarte va a la p. 89 del anexo.\r\n\r\nOtra.", ["La Dra. H. Undarte va a la p. 89 del anexo.", "Otra."]),
        ("यह काफ़ी है। प्रो. सोमकर ने कहा।", ["यह काफ़ी है।", "प्रो. सोमकर ने कहा।"]),
    ],
)
def test_sentence_ends(splitter, text, want):
    assert [text[a:b] for a, b in sentences.split_sentences(text, splitter)] == want


def test_tables_of_contents_are_lists():
    p = shape.Profiles({"es": "de la el en y los con que".split()})
    text = "\n".join(f"{'El puente de la villa' if k % 2 else 'Molino viejo'} {'.' * (6 + 3 * k)} {k * 3}" for k in range(1, 9))
    assert p.classify(text) == "lista" and p.classify("Índice del puente\n" + text) == "lista"


def test_candidates_of_every_script_are_classified():
    model = sentences.train(["El río creció. Nadie lo vio. «No hay luz. Nadie vino», dijo el alcalde. El puente cayó."] * 30 + ["船在天亮之前离开了港口。没有人知道它为什么没有回来。邻居们等着它。"] * 9 + ["ผู้คนรอคอย ไม่มีใครรู้ มี 3 คน"] * 9)
    assert {"Kquote", "Kwide", "Kspace"} <= set(model.weights)
    cut = lambda t: [t[a:b] for a, b in sentences.split_sentences(t, model)]
    assert cut("Ella habló: «No hay luz. Nadie vino», dijo. Fin del acto.") == ["Ella habló: «No hay luz. Nadie vino», dijo.", "Fin del acto."]
    assert cut("我来了。你走了。") == ["我来了。", "你走了。"] and cut("ผู้คนรอคอย ไม่มีใครรู้ มี 3 คน") == ["ผู้คนรอคอย", "ไม่มีใครรู้", "มี 3 คน"]


def test_sentences_are_learned_from_all_documents(spark):
    texts = [f"El río creció en el tramo {k}. Nadie lo vio. Zalba {'calló' if k % 3 else 'habló'}. El Bq. Undarte llegó." + " La villa dormía." * (k % 4) for k in range(2700)]
    texts[5] = "La orilla del valle estaba vacía. Quizá volvió la barca. " * 15_000
    texts += [f"船在天亮之前离开了港口{k}。没有人知道。" for k in range(3)]
    rows = [(f"d{k}", "Txt ", t) for k, t in enumerate(texts)]
    df = spark.createDataFrame([*rows, *rows[:400], ("p", "pdf", "Orzal vino. Orzal fue."), ("n", "txt", None), ("b", "txt", " ")], "doc_id string, formato string, texto string")
    got, want = sentences.learn(df), sentences.train(texts)
    assert got.dotted.get("bq") == 1.0 and got.starts.get("Quizá") == 1.0 and got.starts.get("Orzal") is None
    assert len(got.starts.hashes) == len(want.starts.hashes) and got.starts.levels == want.starts.levels and got.dotted.hashes == want.dotted.hashes
    assert got.weights == want.weights and "Kwide" in got.weights


def test_a_title_after_a_mark_that_is_no_full_stop_begins_a_sentence():
    model = sentences.train(["La nuit tombait sur le port. M. Rivera ferma la porte. Personne ne bougea ! M. Salas attendit. Le p. 4 et le no. 5 parlent de H. B. Mora."] * 20)
    assert [t for t in ("Que dit la loi ?", "Rien !") for a, b in sentences.split_sentences(f"{t} M. Mora se leva.", model)[:1] if b == len(t)] == ["Que dit la loi ?", "Rien !"]


def test_rates_keep_the_side_of_every_threshold():
    p = sentences.np.array([k / n for n in (1, 3, 7, 20, 50, 100, 400) for k in range(n + 1)])
    hashes = sentences.np.array([sentences._hash(f"w{k}") for k in range(len(p))], sentences.np.uint64)
    rates = sentences.Rates(hashes, p)
    for k, x in enumerate(p):
        y = rates.get(f"w{k}")
        assert sentences._bucket(y) == sentences._bucket(x) and (y < 0.02) == (x < 0.02)
        assert all((y > t) == (x > t) for t in (0.25, 0.75, 0.9, 0.95))
    assert rates.get("none") is None and rates.get("none", 1) == 1


def test_paragraphs_and_labels():
    assert paragraphs("a\n\n  b \n c\n \n") == [(1, 0, 1), (2, 5, 10)] and paragraphs(" \n") == []
    got = [language_of(x) for x in ("ES", "es_CO", "spa", "por", "und", "", None, "n/a", "??", "zh-CN", "xx")]
    assert got == ["es", "es", "es", "pt", None, None, None, None, None, "zh", None]


def test_language_model_on_seeds_and_held_out(spark):
    rows = table(spark, "/root/testdata/sf0.01", "mini_corpus").filter("lower(formato) in ('txt', 'html') and length(texto) > 200").select("doc_id", "idioma", "texto").dropDuplicates(["doc_id"]).orderBy("doc_id").collect()
    known = [(language_of(r.idioma), r.texto) for r in rows if language_of(r.idioma)]
    model = language.train([(x, t) for k, (x, t) in enumerate(known) if k % 4])
    p, seen = model.predict([t for k, (x, t) in enumerate(known) if k % 4 == 0])
    names = [model.name(a, s)[0] for a, s in zip(p, seen)]
    labels = [x for k, (x, t) in enumerate(known) if k % 4 == 0]
    # about a tenth of the labels are wrong
    assert sum(a == b for a, b in zip(names, labels)) >= 0.85 * len(labels)
    texts = ["Der alte Hafen war im Winter leer und die Boote lagen am Ufer.", "El port vell era buit a l'hivern i les barques eren a la riba.", "Старая гавань зимой была пуста.", "旧港口在冬天是空的。", "12 34 %"]
    q, s = model.predict(texts)
    assert [model.name(a, b)[0] for a, b in zip(q, s)] == ["de", "ca", "ru", "zh", "und"]


def test_page_body(spark):
    rows = table(spark, "/root/testdata/sf0.01", "mini_corpus").filter("lower(formato) = 'html' and texto is not null").select("texto").collect()
    model = body.train([r.texto for r in rows])
    page = "Datos abiertos | Publicaciones | Buscar | Prensa\nLa mesa técnica 2001 — el plan de acción\nEl comité asesor orienta la mesa técnica con recursos limitados.\nAnuncio\nLa hoja de ruta / el balance anual\nEl balance anual describe la hoja de ruta según las entrevistas.\n• El plan ante la falta de datos\nNoticias relacionadas:\n1. El tipo de cambio / la hoja de ruta\nLa captura de carbono: el comité asesor, 2012\n© 2020 Portal. Reproducción permitida solo con autorización escrita."
    assert [k for k, yes, _ in body.content_lines(page, model) if yes] == [2, 3, 5, 6, 7]
    assert body.content_lines("", model) == [] and all(0 <= p <= 1 for _, _, p in body.content_lines(page, model))


def test_lines_of_pages_are_counted_over_all_documents(spark, monkeypatch):
    notice, long = "Portal de datos del valle", "Una línea larga del sitio " * 8
    rows = [(f"d{k}", "HTML", f"Título {chr(97 + k % 26) * (k + 1)}\n{notice if k % 10 == 0 else 'x'}\n{long if k % 50 == 0 else ''}") for k in range(400)]
    df = spark.createDataFrame([*rows, *rows[:11]], "doc_id string, formato string, texto string")
    often = body.learn(df, most=20).often
    assert often[body.key(notice)] == 40 and often[body.key(long)] == 8 and often[body.key("x")] == 360
    monkeypatch.setattr(body, "PER", 100)  # a rate, whatever the size of the corpus
    often = body.learn(df, most=20).often
    assert often[body.key(notice)] == 10 and often[body.key(long)] == 2
    assert body.train([t for _, _, t in rows]).often == often


NEIGHBOURS = {  # of a script that another language of the corpus is written in
    "uk": ["Човен вийшов із гавані ще до світанку, і ніхто не знав, чому він не повернувся.", "Сусіди чекали його зі свічкою у вікні, як розповідають бабусі цього села.", "Інженери кажуть, що міст через річку збудують наступного року, якщо громада знайде гроші.", "Влітку діти їздять до бабусі, де є великий сад і тиха річка з теплою водою.", "Ця їжа дуже смачна, але її ціна щороку зростає, тому люди купують менше.", "Український уряд оголосив, що нова залізниця з'єднає два великі міста країни."],
    "fa": ["قایق پیش از سپیده‌دم از بندر بیرون رفت و هیچ‌کس نمی‌دانست چرا برنگشت.", "همسایه‌ها با چراغی در پنجره منتظر او بودند، چنان‌که مادربزرگ‌های روستا می‌گویند.", "مهندسان می‌گویند پل روی رودخانه سال آینده ساخته می‌شود، اگر شهرداری پول پیدا کند.", "بچه‌ها تابستان به خانهٔ مادربزرگ می‌روند که باغ بزرگ و رودی آرام دارد.", "این غذا بسیار خوشمزه است، ولی بهای آن هر سال گران‌تر می‌شود و مردم کمتر می‌خرند.", "دولت اعلام کرد که راه‌آهن تازه دو شهر بزرگ کشور را به هم پیوند می‌دهد."],
    "mr": ["होडी पहाटेपूर्वी बंदरातून निघाली आणि ती परत का आली नाही हे कोणालाच कळले नाही.", "शेजारी खिडकीत दिवा लावून तिची वाट पाहत होते, असे गावातील आजी सांगतात.", "अभियंते म्हणतात की नदीवरचा पूल पुढच्या वर्षी बांधला जाईल, जर नगरपालिकेला पैसे मिळाले.", "उन्हाळ्यात मुले आजीकडे जातात, जिथे मोठी बाग आणि शांत नदी आहे.", "हे जेवण खूप चवदार आहे, पण त्याची किंमत दरवर्षी वाढते म्हणून लोक कमी विकत घेतात.", "सरकारने जाहीर केले की नवीन रेल्वे देशातील दोन मोठ्या शहरांना जोडेल."],
}


@pytest.fixture(scope="module")
def labelled(spark):
    return language.examples_of(language.sample(table(spark, "/root/testdata/sf0.01", "mini_corpus")))


def test_languages_that_training_has_not_seen(labelled):
    model = language.train(labelled)
    for lang, texts in NEIGHBOURS.items():
        assert lang not in model.languages
        for t in texts:
            main, conf, _ = language.decide(model, [(t, "txt")])[0]
            assert main == "und", (lang, main, conf, t)


def test_languages_of_one_script(labelled):
    """Trained with right labels, none is taken for the other language of its script."""
    more = [(lang, t) for lang, texts in NEIGHBOURS.items() for t in texts[:4] for _ in range(3)]
    model = language.train(labelled + more)
    for lang, texts in NEIGHBOURS.items():
        assert lang in model.languages
        for t in texts:
            main, _, _ = language.decide(model, [(t, "txt")])[0]
            assert main in (lang, "und") and (t in texts[4:] or main == lang), (lang, main, t)


LEX = scans.Lexicon({w: 100 for w in "el río volvió a crecer en la primavera y los pueblos del valle esperaron noche título largo fin texto puente viejo".split()})


def test_scan_classes():
    text = "Título largo del valle\n\nEl río vol-\nvió a crecer en la prirnavera y los\n12    Título l@rgo del valle\npueblos del valle esperaron franco-\nalemán en la noche.\n\n- 13 -\nREVISTA DEL VALLE\nEl pu3nte viejo.\niv"
    got = {x.number: x.classes for x in scans.analyse(text, "F1/revista_del_valle", LEX) if x.classes}
    assert got == {3: {"guion"}, 4: {"ocr"}, 5: {"encabezado"}, 9: {"pagina"}, 10: {"encabezado"}, 11: {"ocr"}, 12: {"pagina"}}
    whole = scans.paragraphs_of(scans.analyse(text, "F1/revista_del_valle", LEX))
    assert whole[0] == "Título largo del valle" and whole[1].startswith("El río volvió a crecer en la primavera y los pueblos del valle esperaron")


@pytest.mark.parametrize("line", ["3", "- 3 -", "p. 12", "Página 1 de 4", "Page 2 of 9", "3/8", "[14]", "xii", "p. 2S", "    9", "Seite 1 von 2", "Pagina 3", "— 7 —"])
def test_page_numbers(line):
    assert scans.is_page_number(line)


@pytest.mark.parametrize("line", ["55,1 %", "(1998).", "El año 1998", "12.5", "casa", "Lista 3", "", "A1 B2", "2001."])
def test_no_page_numbers(line):
    assert not scans.is_page_number(line)


def repaired(line, words=None):
    lines = scans.analyse("Título\n" + line, None, words or LEX)
    return " ".join(scans.paragraphs_of(lines)).removeprefix("Título "), lines[1].classes


def test_decoding_of_splits_and_merges():
    assert repaired("En elpuente del río volvió a crecer") == ("En el puente del río volvió a crecer", {"ocr"})
    assert repaired("el puen te viejo") == ("el puente viejo", {"ocr"})
    assert repaired("en la prirnavera, Rl93 y Vebo") == ("en la primavera, Rl93 y Vebo", {"ocr"})
    assert repaired("l'esperar0n en-la-prirnavera") == ("l'esperaron en-la-primavera", {"ocr"})
    assert scans.analyse("", None, LEX)[0].classes == set()


def test_words_of_any_length_and_unknown_surroundings():
    long = "hexametilentetraminoclorhidratomonohidratado" * 2
    words = scans.Lexicon({**LEX.counts, long: 9, "pueblos": 90})
    assert repaired(long.replace("o", "0", 1), words) == (long, {"ocr"})
    # a page whose words aren't known still gives what is plainly misread
    assert repaired("Zubiak herriko pueb1os etxeak mendian gora doaz", words) == ("Zubiak herriko pueblos etxeak mendian gora doaz", {"ocr"})


def test_headers_without_page_numbers():
    text = "Título largo del valle\n\nEl río volvió a crecer en la\nTÍTULO LARGO DEL VALLE\nprimavera y los pueblos.\n\nTítulo largo del valle\n\nFin del texto."
    got = {x.number: x.classes for x in scans.analyse(text, None, LEX) if x.classes}
    assert got == {4: {"encabezado"}}  # the other, between sentences, may be a heading


def test_a_lexicon_that_is_too_large_for_every_task(spark, sf):
    docs = table(spark, sf, "mini_corpus")
    rows = lambda x: {tuple(r) for r in x.collect()}
    want = rows(scans.noisy_lines(docs))
    assert want and rows(scans.noisy_lines(docs, lexicon_bytes=0, block_bytes=5_000)) == want
    assert rows(scans.repaired(docs, lexicon_bytes=0, block_bytes=20_000)) == rows(scans.repaired(docs))
    before, after = (sum(x) for x in zip(*(r[2:4] for r in rows(scans.measured(docs)))))
    assert after < before


def test_sieve(spark):
    words = spark.createDataFrame([("puente", 3), ("río", 4)], "palabra string, n long")
    s = scans.sieve(words)
    assert all(w[:k] in s for w in ("puente", "río") for k in range(1, len(w) + 1))


def test_areas_held_out(spark):
    sf = "/root/testdata/sf0.01"
    rows = table(spark, sf, "area_ejemplos").collect()
    names = sorted({r.area for r in rows})
    texts = [r.text for r in table(spark, sf, "documents").filter("length(text) > 60").orderBy("doc_id").limit(700).collect()]
    model = areas.train([(r.area, r.texto) for r in rows if r.ejemplo_id % 6], texts, names)
    right = total = 0
    for r in rows:
        if r.ejemplo_id % 6 == 0:
            hit = model.about([s for p in areas.sections(r.texto) for s in p])
            right += hit[:, names.index(r.area)].sum()
            total += len(hit)
    assert right >= 0.85 * total


def test_headers_of_source_and_title():
    title, source = scans.canon("Título largo del valle"), scans.canon("Revista Del Valle")
    for line in ("TÍTULO LARGO DEL VALLE", "12    Título l@rgo del valle", "Revista Del Valle · Título largo del valle", "Título lar…", "REVISTA DEL VALLE    7"):
        assert scans.header_kind(line, title, source) == "encabezado", line
    for line in ("Título largo del mar", "El título largo del valle fue otro en aquel año", "", "Revista"):
        assert scans.header_kind(line, title, source) is None, line
    assert scans.is_page_number("- lS -") and not scans.is_page_number("Sol") and not scans.is_page_number("lO")


def test_words_parted_and_misread_at_once():
    text = "Título largo\n\nEl río en la pri rnavera y los pueblos del valleesper@ron en\nla pri ma vera y los pue-\nb los del va lle esperaron la no-\nche.\nPri ma-\nvera\n\n1"
    lines = scans.analyse(text, None, LEX)
    assert {x.number: x.classes for x in lines if x.classes} == {3: {"ocr"}, 4: {"ocr", "guion"}, 5: {"ocr", "guion"}, 7: {"ocr", "guion"}, 10: {"pagina"}}
    assert " ".join(scans.paragraphs_of(lines)[1:]) == "El río en la primavera y los pueblos del valle esperaron en la primavera y los pueblos del valle esperaron la noche. Primavera"


def test_words_parted_and_run_together():
    text = "Título largo\n\nEl río volvió a cre cer en la prima\nvera y los pueblos del valleesperaron en la noche.\n\n1"
    lines = scans.analyse(text, None, LEX)
    assert {x.number: x.classes for x in lines if x.classes} == {3: {"ocr"}, 4: {"ocr"}, 6: {"pagina"}}
    assert scans.paragraphs_of(lines)[1] == "El río volvió a crecer en la primavera y los pueblos del valle esperaron en la noche."
