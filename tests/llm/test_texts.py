import random

import numpy as np
import pytest

from quillspark.llm import bilstm, languages, page_body, personal_data, scanned_text

# --- languages ---------------------------------------------------------------------------------------

EN = "The quick brown fox jumps over the lazy dog and runs through the fields. "
DE = "Der schnelle braune Fuchs springt über den faulen Hund und läuft durch die Felder. "
SAMPLES = [("en", EN), ("en", "This is what the people of the town have said about it."), ("de", DE), ("de", "Das ist, was die Leute in der Stadt darüber gesagt haben.")]


def chunk_frame(spark, rows):
    return spark.createDataFrame(rows, "id string, domain string, lang string, text string, ocr_confidence double, score string")


def test_languages(spark):
    rows = [
        ("a", "x.example", "en-US", EN, None), ("b", "x.example", "xx", EN, None), ("c", "x.example", "DEU", EN + "\n" + DE, None), ("d", "x.example", "en", DE, None), ("e", "x.example", None, None, None),
        ("f", "x.example", "en", " \n", None), ("g", "x.example", None, "Short", None), ("h", None, "de", DE.replace("den ", "den\n"), 0.5), (None, "x.example", "en", EN, None), ("a", "x.example", "en-US", EN, None),
    ]
    frame = chunk_frame(spark, [(*r, "clash") for r in rows])
    found = languages.languages(frame, spark.createDataFrame(SAMPLES, "lang string, text string"))
    got = {r.id: r for r in found.collect()}
    assert len(got) == 8 and found.count() == 8
    assert {i: got[i].main for i in "abdefgh"} == {"a": "en", "b": "en", "d": "de", "e": None, "f": None, "g": None, "h": "de"}
    assert all(0 < r.language_confidence <= 1 for r in got.values())
    assert sorted((r.id, r.lang) for r in languages.wrongly_labelled(found).collect()) == [("b", "en"), ("c", "de"), ("c", "en"), ("d", "de")]
    assert [(r.part, r.lang) for r in languages.segments(found).where("id = 'c'").orderBy("part").collect()] == [(0, "en"), (1, "de")]
    assert languages.languages(frame.limit(0), spark.createDataFrame(SAMPLES, "lang string, text string")).count() == 0
    with pytest.raises(ValueError):
        languages.languages(frame, spark.createDataFrame([], "lang string, text string"))


def test_sentences_without_lead_are_decided_by_the_other_evidence(spark):
    names = "Zork Blin Tavo Kreb Molu Sart Pilo Dran Vesk Humo Trel Gask Nolu Berd."
    rows = [(f"e{i}", "x.example", "en", EN, None, "") for i in range(30)] + [(f"d{i}", "y.example", "de", DE, None, "") for i in range(30)]
    rows += [("a", "x.example", None, names, None, ""), ("b", "y.example", "en", names + "\n" + EN * 2, None, ""), ("c", "y.example", None, names, None, "")]
    got = {r.id: r for r in languages.languages(chunk_frame(spark, rows), spark.createDataFrame(SAMPLES, "lang string, text string")).collect()}
    assert (got["a"].main, got["c"].main, got["b"].main) == ("en", "de", "en") and got["a"].whole == ["en"]


def test_accuracy_on_held_out_samples(spark, data):
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{data}/lang_samples.parquet").collect()]
    random.Random(1).shuffle(rows)
    model = languages.Likelihoods(rows[:200])
    scores = model.texts([t for _, t in rows[200:]])
    assert np.mean([model.languages[s.argmax()] == lang for s, (lang, _) in zip(scores, rows[200:])]) > 0.98


# --- personal data -----------------------------------------------------------------------------------

def gazetteer(*words, never=()):
    seen, persons = np.zeros(personal_data.BUCKETS), np.zeros(personal_data.BUCKETS)
    for i in range(2000):
        seen[personal_data._bucket(f"thing{i}", personal_data.BUCKETS)] += 9
    for w in words:
        at = personal_data._bucket(w, personal_data.BUCKETS)
        seen[at], persons[at] = seen[at] + 30, persons[at] + 25
    for w in never:
        seen[personal_data._bucket(w, personal_data.BUCKETS)] += 30
    return personal_data.Gazetteer(persons, seen)


FIRST, LAST = gazetteer("petra", "jonas", "maike", "rémy", never=("zigapi", "bridge")), gazetteer(never=("bridge", "mount"))
SAID = [
    ("Contact: Petra Q. Wenstham <petra.w@mail.zo.example>", {("person_name", "Petra Q. Wenstham"), ("email", "petra.w@mail.zo.example")}),
    ("As Dr. Jonas Farsby noted, it was not ready.", {("person_name", "Jonas Farsby")}),
    ("Maike zu Tolstinger, wohnhaft Tolikostr. 11a, 87763 Dodofurt, Tel. +49 (0)30 23125-479", {("person_name", "Maike zu Tolstinger"), ("address", "Tolikostr. 11a, 87763 Dodofurt"), ("phone", "+49 (0)30 23125-479")}),
    ("Passport or national id 960-55-8366 was recorded at the desk.", {("id_number", "960-55-8366")}),
    ("Part no. 497-22-5250 fits the Zigapi Bridge Mount.", set()), ("Run tide@97.86.1 with @tide as decorator.", set()), ("Sensor X41 reported 17371737 pulses.", set()),
    ("Please call (711) 555-0102 ext. 65 if it stays offline.", {("phone", "(711) 555-0102 ext. 65")}), ("Send the form to 173 Munu Ave., Bodumouth 59164 soon.", {("address", "173 Munu Ave., Bodumouth 59164")}),
    ("Rémy Neau, qui habite 332 avenue du Solnefo, 71284 Ven", {("person_name", "Rémy Neau"), ("address", "332 avenue du Solnefo, 71284 Ven")}), ("write to desk (at) zo (dot) test", {("email", "desk (at) zo (dot) test")}), ("", set()),
]


def test_spans_of_personal_data():
    finder = personal_data.Finder(FIRST, LAST)
    model = personal_data.Classifier(finder, [t for t, _ in SAID] * 20)
    for text, expected in SAID:
        assert {(k, text[a:b]) for a, b, k in model.found(finder, text)} == expected, text


def test_words_around_find_names_that_no_gazetteer_has():
    # the classifier learns the wording from names it knows and finds others in it; wordings of things stay out
    finder = personal_data.Finder(FIRST, gazetteer(never=("plan", "labs")))
    known = [f"Contact: {a} Far{b} <far{b}@mail.zo.example>\nThe parcel for {a} Far{b} goes to the desk." for a in ("Petra", "Jonas", "Maike") for b in ("sby", "wick", "mann", "eau")]
    things = [f"Der Plan von Zo{b} misst das Gerät, und die Wartung {b.title()}abo Labs bleibt." for b in ("gi", "fe", "ta", "ru", "mi", "po", "la", "ke", "su", "no")]
    model = personal_data.Classifier(finder, (known + things) * 3)
    text = "The parcel for Tovi Belmar goes to the desk. Der Plan von Zobu misst das Gerät, und die Wartung Tagabo Labs bleibt."
    assert {text[a:b] for a, b, _ in model.found(finder, text)} == {"Tovi Belmar"}


def test_gazetteers_count_all_texts(spark):
    rows = [("Contact: Inga Solbrek and more\nNext line",)] * 6 + [("It is kept by the Zorba Press of Tolme",)] * 40 + [(None,), ("",)]
    first, last = personal_data.gazetteers(spark.createDataFrame(rows, "text string"))
    assert first("inga") > 1 > first("zorba") and last("solbrek") > 1 and last("press") < 0
    assert personal_data.gazetteers(spark.createDataFrame([], "text string"))[0]("inga") == 0


def test_estimated_reliabilities_find_the_truth():
    rng = np.random.default_rng(2)
    truth = rng.random(2000) < 0.4
    votes = np.stack([np.where(rng.random(2000) < a, np.where(truth, 1, -1), np.where(truth, -1, 1)) for a in (0.95, 0.9, 0.6)], axis=1)
    assert ((personal_data.estimate(votes) > 0.5) == truth).mean() > 0.93


def test_redaction(spark):
    rows = [(f"c{i}", t, "x", True) for i, (t, _) in enumerate(SAID * 5)] + [("n", None, "x", None), (None, "Contact: Petra Roe <a@b.example>", "x", None), ("c0", SAID[0][0], "x", True)]
    rows += [(f"m{i}", "By Petra Wenstham\nVon Maike Tol\nBy Jonas Farsby\nPar Rémy Neau", "x", None) for i in range(3)]
    kinds = spark.createDataFrame([("email", "[MAIL]"), ("person_name", "[WHO]")], "kind string, placeholder string")
    marked = personal_data.personal_data(spark.createDataFrame(rows, "id string, text string, spans string, pii boolean"), kinds)
    got = {r.id: r for r in personal_data.redacted(marked).collect()}
    assert got["c0"].text == "Contact: [WHO] <[MAIL]>" and got["c0"].pii_types == ["email", "person_name"] and got["n"].text is None and not got["n"].pii and None not in got
    first = SAID[0][0]
    assert {(r.kind, r.char_start) for r in personal_data.found_data(marked).where("id = 'c0'").collect()} == {("person_name", first.index("Petra")), ("email", first.index("petra."))}
    assert personal_data.personal_data(spark.createDataFrame([], "id string, text string"), kinds).count() == 0


# --- pages -------------------------------------------------------------------------------------------


def test_gradients_of_the_recurrent_labeller():
    rng = np.random.default_rng(3)
    model = bilstm.BiLstm(20, 3, 4, 5)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    x, mask = rng.standard_normal((4, 2, 7)), np.array([[1, 1], [1, 1], [1, 0], [1, 0]], bool)
    weight = rng.standard_normal((4, 2, 5))
    for d in "fb":
        kept, grads = [], {}
        model._run(x, mask, d, kept)
        dx = model._back(x, kept, weight, d, grads)
        loss = lambda: float((model._run(x, mask, d).astype(np.float64) * weight * mask[:, :, None]).sum())  # noqa: B023, E731
        for array, grad in ((model.p["w" + d], grads["w" + d]), (x, dx)):
            at = tuple(rng.integers(0, n) for n in array.shape) if array is not x else (1, 0, 2)
            old = array[at]
            array[at] = old + 1e-2
            up = loss()
            array[at] = old - 1e-2
            down = loss()
            array[at] = old
            assert abs((up - down) / 2e-2 - grad[at]) < 2e-2 * max(1, abs(grad[at]))


def page(i, rng):
    name = f"Zu{'kelmonrita'[i % 7 :]}{'abcdefgh'[i % 8]}o"
    body = [f"# How {name} treats the plan", f"The long plan of {name} covers what the board has asked for in section {i}.", f"In most wards the plan needs {name} before the run number {i} begins at all.", f"* {name} and the budget"]
    top = rng.sample(["Menu", "Skip to the text", f"Acme uses cookies to count visits {i}", "By Hugo Gimham", "Last updated 3 May 2020"], 3)
    return "\n".join([*top, "", *body, "Read next: The lease in Norpatel", "© 2024 Acme."]), {*range(3), 8, 9}


def test_page_body(spark):
    rng = random.Random(4)
    pages = [page(i, rng) for i in range(120)]
    rows = [(f"p{i}", "www.acme.example", "html", t, "clash") for i, (t, _) in enumerate(pages)]
    rows += [("n", "acme.example", "html", None, ""), ("e", None, "html", "", ""), ("b", None, "html", "\n \n", ""), ("t", "acme.example", "pdf", "Menu", ""), (None, "acme.example", "html", "Menu", ""), rows[0]]
    frame = spark.createDataFrame(rows, "id string, domain string, format string, text string, line_no string")
    got = {}
    for r in page_body.boilerplate_lines(frame).collect():
        got.setdefault(r.id, set()).add(r.line_no)
    assert np.mean([got.get(f"p{i}") == e for i, (_, e) in enumerate(pages)]) > 0.9 and not {"n", "e", "b", "t", None} & set(got)
    body = {r.id: r.text for r in page_body.main_body(frame).collect()}
    assert body["e"] == "" and "cookies" not in body["p0"] and "covers what" in body["p0"] and "t" not in body
    assert page_body.boilerplate_lines(frame.limit(0)).count() == 0


def test_common_words_are_of_all_pages_not_of_the_sample(spark, monkeypatch):
    seen = []
    real = page_body.Page.__init__
    monkeypatch.setattr(page_body.Page, "__init__", lambda self, text, domain, common: (seen.append(common), real(self, text, domain, common))[1])
    rows = [(f"p{i}", f"www.site{i % 5}.example", "html", f"Partilhe\nThe page {i} is long enough.") for i in range(40)]
    page_body.furniture(spark.createDataFrame(rows, "id string, domain string, format string, text string"), sample=4)
    assert seen and all({"partilhe", "page"} <= common for common in seen)


# --- scans -------------------------------------------------------------------------------------------


def brute_near(words, read, most):
    """All printed words that become ``read``, by trying readings at every place."""

    def becomes(a):
        level = {(a, 0)}
        for _ in range(most):
            level |= {(x[:i] + r + x[i + len(p) :], i + len(r)) for x, low in level for p, r in scanned_text.READINGS for i in range(low, len(x)) if x.startswith(p, i)}
        return {x for x, _ in level}

    return {w for w in words if read in becomes(w)}


def test_trie_finds_all_candidates():
    rng = random.Random(5)
    words = {"".join(rng.choice("mrnclhdeiw") for _ in range(rng.randint(3, 7))) for _ in range(300)}
    trie = scanned_text.Trie((w, 1) for w in words)
    for read in ["".join(rng.choice("mrnclhdeiw1b") for _ in range(rng.randint(3, 7))) for _ in range(60)] + [w.replace("rn", "m").replace("e", "c", 1) for w in list(words)[:60]]:
        assert {w for w, _ in trie.near(read, 2)} == brute_near(words, read, 2)


def test_candidates_come_from_all_tries_an_automaton_reaches(spark):
    rng = random.Random(7)
    words = sorted({"".join(rng.choice("mrnclhdeiwb") for _ in range(rng.randint(1, 7))) for _ in range(300)})
    reads = sorted({w.replace("rn", "m").replace("e", "c", 1).replace("d", "cl", 1) for w in words} | {"x" * 5000, "cl", "ri", "1"})
    found = scanned_text.candidates(spark.createDataFrame([(r,) for r in reads], "word string"), spark.createDataFrame([(w, 1) for w in words], "word string, n bigint")).collect()
    got = {r.word: {n["word"] for n in r.near} for r in found}
    assert all(got.get(r, set()) == brute_near(words, r, 2) for r in reads if len(r) < 100)


def test_a_long_document_is_judged_as_one(spark):
    # a header that comes back only after a hundred chunks, and a spelling the document has often
    clean = "the calibration sheet restores the table and the water sample covers it again."
    rows = [(f"c{i}", f"d{i}", f"{'ab'[i % 2]}.example", clean, None) for i in range(12)]
    plain = "The water sample covers\nit again and the table restores it."
    rows += [(f"s{i}", "long", "a.example", ("Zork Report of Tavo\n" if i in (0, 150) else "") + plain, 0.7) for i in range(200)]
    frame = spark.createDataFrame(rows, "id string, doc_id string, domain string, text string, ocr_confidence double")
    for per_block in (400, 7):
        lines = {(r.id, r.line_no, r.kind) for r in scanned_text.faulty_lines(scanned_text.repaired(frame, per_block=per_block)).collect()}
        assert lines == {("s0", 0, "header"), ("s150", 0, "header")}


def test_readings_between():
    assert scanned_text.readings_between("modern", "rnodern") == 1 and scanned_text.readings_between("limit", "hmit") == 1 and scanned_text.readings_between("same", "same") == 0
    assert scanned_text.readings_between("table", "chair") is None and scanned_text.readings_between("tablet", "tab1e+") == 2


def test_repair(spark):
    clean = "The calibration sheet restores the modern well-known table of the harbour. It covers the water sample."
    scan = "Nalibeku — No. 15\nThe cal1bration sheet restores the rnodern well-\nknown table of the har-\n\n- 12 -\n\nNalibeku — No. 16\nbour. It covers tbe\nwater sample."
    rows = [(f"c{i}", f"d{i}", f"{'ab'[i % 2]}.example", clean, None, 0) for i in range(12)]
    rows += [("s", "x", "a.example", scan, 0.7, 0), ("s", "x", "a.example", scan, 0.7, 0), ("n", "x", "a.example", None, 0.7, 1), ("b", "x", "a.example", " \n", 0.7, None), (None, "x", "a.example", scan, 0.7, 2), ("o", None, None, "One line.", 0.9, None)]
    frame = spark.createDataFrame([(*r, "clash") for r in rows], "id string, doc_id string, domain string, text string, ocr_confidence double, chunk_index int, word string")
    mended = scanned_text.repaired(frame)
    got = {r.id: r for r in mended.collect()}
    assert set(got) == {"s", "o"} and got["o"].text == "One line." and got["s"].text == clean
    lines = {(r.line_no, r.kind) for r in scanned_text.faulty_lines(mended).where("id = 's'").collect()}
    assert lines == {(0, "header"), (1, "misread"), (2, "hyphen"), (4, "page_number"), (6, "header"), (7, "misread")}
    assert scanned_text.repaired(frame.limit(0)).count() == 0
