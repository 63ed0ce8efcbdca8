import difflib
import random

import numpy as np
from pyspark.sql import functions as F

from lakebind.llm import mojibake as M
from lakebind.llm import scans as S
from lakebind.llm.boosting import Boosted
from lakebind.llm.stuffing import blocks, stuffed_share

SENTENCES = [
    "The regional survey of Corvewick assembled immediately between March and April.", "Visitors first see the seasonal wetland, then the sanctuary of the institute.",
    "Nobody at the archive could explain why the workshop described the inventory so slowly.", "Prices at the municipal harbour rose from ten to twelve per unit.",
    "Two photographs taken in summer show a sudden exhibit beside the old transcript.", "The auditor verified every remote checklist before the provisional permit was due.",
    "Readers should compare the official glossary with the coastal catalogue kept by the council.", "Minutes from September mention a handwritten itinerary but no questionnaire.",
]


def prose(dice, n=8):
    return " ".join(dice.choices(SENTENCES, k=n))


def test_boosting_learns():
    dice = np.random.default_rng(0)
    x = dice.random((2000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    model = Boosted().fit(x[:1500], y[:1500])
    assert ((model.probability(x[1500:]) > 0.5) == y[1500:]).mean() > 0.95
    assert len(model.probability(x[:0])) == 0


def test_stuffing(spark):
    dice = random.Random(1)
    rows = [(k, prose(dice, dice.randint(3, 10)), "en", "x") for k in range(300)]
    spam = {1000: "\n".join(dice.choices(["Cheap Toaster", "cheap toaster", "CHEAP TOASTERS", "cheap sofa"], k=60)), 1001: " ".join(f"#sofa{dice.choice(['Best', 'Sale', 'New'])}" for _ in range(60)), 1002: "\n".join(f"https://shop{dice.randint(1, 9)}.example/buy-sofa/{dice.randint(1, 99)}" for _ in range(30))}
    rows += [(k, t, "EN", "x") for k, t in spam.items()]
    rows += [(2000, prose(dice, 12) + "\nTags: sofa, sofa, lamp", "en", "x"), (2001, None, "en", "x"), (2002, "", "en", "x"), (2003, " \n", None, "x"), (2004, "ok", None, "x"), (None, "text", "en", "x"), (2005, prose(dice, 2000), "en", "x")]
    rows += rows[:5]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, share string")
    shares = {r["doc_id"]: r["share"] for r in stuffed_share(frame, "doc_id", "text", "lang").collect()}
    assert {k for k, s in shares.items() if s > 0.5} == set(spam)
    assert not {2001, 2002, 2003, None} & set(shares) and {2004, 2005} <= set(shares)
    assert stuffed_share(frame.limit(0), "doc_id", "text", "lang").count() == 0
    assert "".join(b for _, b in blocks(rows[-1][1])) == rows[-1][1]


CLEAN = ["Après l'été le théâtre a été complété à cause du précis léger.", "Người dân cần chỉ số đầy đủ trước tháng sáu năm nay.", "Die Straße wurde für die Bücherei über Nacht geprüft.", "El año español señaló más montañas únicas.", "La “façade” coûte 12 € — déjà reçu."]


def test_wrong_encodings_round_trip(spark):
    rows = [("text", f"c{k}", f"f{k % 3}", CLEAN[k % 5], 1) for k in range(200)]
    broken = {}
    for k in range(60):
        page = ("cp1252", "latin-1", "cp1250", "cp437", "mac_roman")[k % 5]
        text = CLEAN[(k // 5) % 5]
        try:
            broken[f"b{k}"] = (text.encode("utf-8").decode(page), text)
        except UnicodeDecodeError:
            continue
    broken["double"] = (CLEAN[0].encode().decode("latin-1").encode().decode("latin-1"), CLEAN[0])
    rows += [("text", i, f"f{len(i) % 3}", t, 1) for i, (t, _) in broken.items()]
    rows += [("text", "lost", None, "F�rderung", 1), ("text", "control", "f0", "a \x93quoted\x94 word", 1), ("text", "tree", "f0", "a/\n│   ├── b.txt\n└── c", 1), ("text", "sign", "f0", "√2 ≈ 1.414, Γ = 0.1 Ω, NGÃ BA", 1), ("text", None, "f0", "Ã©", 1), ("text", "none", "f0", None, 1), ("text", "empty", "f0", "", 1)]
    rows += rows[200:205]
    frame = spark.createDataFrame(rows, "record_kind string, record_id string, source string, text string, wrong int")
    out = {r["record_id"]: r for r in M.repair_encoding(frame, "record_kind", "record_id", "source", "text").collect()}
    wrong = {i for i, r in out.items() if r["wrong"]}
    assert wrong == {i for i, (t, clean) in broken.items() if t != clean} | {"lost", "control"}
    right = sum(out[i]["restored"] == clean for i, (_, clean) in broken.items() if i in out)
    assert right >= 0.9 * len(broken)
    assert M.repair_encoding(frame.limit(0), "record_kind", "record_id", "source", "text").count() == 0


def _sources(languages, dice, n=260):
    """Sentences of made clauses in several languages, as a source has them."""
    return [" ".join(dice.choices(languages, k=4)) for _ in range(n)]


FRENCH = (
    "Après l’été, señor Müller", "le théâtre a été complété", "à cause du précis léger", "la façade coûte déjà cher", "l’élève préfère même la forêt", "où le maître était né", "ce château âgé s’est arrêté", "le récit fut très général",
    "die Straße wurde geprüft", "für die Bücherei über Nacht", "schöne Türen wären größer", "el año español señaló más", "también mejoró el índice histórico", "una montaña única según él",
)
TONED = ("người dân cần chỉ số đầy đủ", "trước tháng sáu năm nay", "bảng điểm được lưu ở thư viện", "phần còn lại là dự án đặc biệt", "khoản vay chính thức bị từ chối", "bến cảng ổn định với kho hàng", "đoàn tàu hiếm gặp trong khi", "nhà kính điện tử đã đóng cửa")


def _swapped(spark, pages, languages, share=0.25):
    """(found, restored, clean found, clean) of a corpus in which each source has texts with one swap of pages."""
    dice = random.Random(5)
    rows, truth = [], {}
    for name, swap in pages.items():
        for k, text in enumerate(_sources(languages, dice)):
            shown = swap(text) if k < share * 260 else text
            rows.append(("text", f"{name}{k}", name, shown))
            if shown != text:
                truth[f"{name}{k}"] = text
    frame = spark.createDataFrame(rows, "kind string, id string, source string, text string")
    out = {r["id"]: r for r in M.repair_encoding(frame, "kind", "id", "source", "text").where("wrong").collect()}
    by = {}
    for name in pages:
        own = {i: t for i, t in truth.items() if i.rstrip("0123456789") == name}
        same = [difflib.SequenceMatcher(None, out[i]["restored"], t, False).ratio() for i, t in own.items() if i in out]
        by[name] = (len(own), sum(i in out for i in own), sum(same) / max(1, len(own)))
    return by, len(set(out) - set(truth))


def test_swaps_of_other_pages_are_learned(spark):
    """UTF-8 read as pages of one and of two bytes, and pages of single bytes read as others."""
    read = lambda raw, page: raw.decode(page, "replace")
    pages = {
        "greek": lambda t: read(t.encode(), "cp1253"), "dos": lambda t: read(t.encode("cp1252"), "cp437"), "mac": lambda t: read(t.encode("cp1252"), "mac_roman"), "cyrillic": lambda t: read(t.encode("cp1252"), "cp1251"),
        "western": lambda t: read(t.encode("mac_roman"), "cp1252"), "gbk": lambda t: read(t.replace("’", "").encode(), "gbk"), "japanese": lambda t: read(t.replace("’", "").encode(), "cp932"),
    }
    by, wrongly = _swapped(spark, pages, FRENCH)
    assert all(found >= 0.9 * n for n, found, _ in by.values()) and wrongly <= 0.02 * 7 * 260
    assert all(by[name][2] >= 0.9 for name in ("greek", "dos", "mac", "cyrillic", "western"))


def test_an_invented_page_is_learned_from_bigrams(spark):
    """Bytes shown by characters that no page of Python's has there."""
    shown = "".join(chr(c) for c in range(0x10A0, 0x10A0 + 128))
    swap = lambda t: "".join(chr(b) if b < 128 else shown[b - 128] for b in t.encode())
    by, wrongly = _swapped(spark, {"invented": swap}, FRENCH + TONED, 0.5)
    n, found, same = by["invented"]
    assert found == n and same >= 0.9 and wrongly == 0


def test_ciphers_joined_by_source_give_the_same(spark):
    rows = [("text", f"c{k}", f"f{k % 3}", CLEAN[k % 5]) for k in range(200)] + [("text", f"b{k}", f"f{k % 3}", CLEAN[k % 5].encode().decode("latin-1")) for k in range(60)]
    frame = spark.createDataFrame(rows, "k string, i string, s string, t string")
    sent, joined = (sorted(map(tuple, M.repair_encoding(frame, "k", "i", "s", "t", sent).collect())) for sent in (M.SENT, 0))
    assert sent == joined and len(sent) >= 48


def scanned(dice, text):
    words, lines, now = text.split(), [], ""
    for w in words:
        if len(now) + len(w) > 55 and now:
            if len(w) > 7 and dice.random() < 0.6:
                lines.append(f"{now} {w[:4]}-")
                now = w[4:]
                continue
            lines.append(now)
            now = w
        else:
            now = f"{now} {w}".strip()
    lines.append(now)
    out = []
    for k, line in enumerate(lines):
        if k % 5 == 0:
            out.append(f"Harbour Report 1984    p. {40 + k // 5}")
        out.append(line)
    return "\n".join(out)


def test_scans(spark):
    dice = random.Random(4)
    rows = [("text", f"clean{k}", prose(dice), "z") for k in range(250)]
    rows += [("text", f"wrapped{k}", prose(dice).replace(". ", ".\n"), "z") for k in range(20)]
    rows += [("text", f"data{k}", "\n".join(_other_data(dice)), "z") for k in range(10)]
    pages = {f"scan{k}": prose(dice, 9) for k in range(25)}
    rows += [("text", i, scanned(dice, t), "z") for i, t in pages.items()]
    rows += [("text", "misread", SENTENCES[0].replace("survey", "5urvey").replace("immediately", "imrnediately"), "z"), ("text", None, "x", "z"), ("text", "null", None, "z"), ("text", "blank", " \n ", "z"), ("text", "long", prose(dice, 1500), "z")]
    rows += rows[-30:]
    frame = spark.createDataFrame(rows, "record_kind string, record_id string, text string, repaired string")
    out = {r["record_id"]: r for r in S.repair_scans(frame, "record_kind", "record_id", "text").collect()}
    found = set(out)
    assert set(pages) <= found and "misread" in found
    assert len([i for i in found if i.startswith(("clean", "data", "wrapped", "long"))]) <= 2
    assert out["misread"]["repaired"] == SENTENCES[0]
    right = sum(out[i]["repaired"].split() == t.split() for i, t in pages.items())
    assert right >= 20
    assert S.repair_scans(frame.limit(0), "record_kind", "record_id", "text").count() == 0


def _other_page(dice):
    """(lines, places of furniture) of a page set by other rules than the learner's: columns, footers, other heads."""
    text = prose(dice, dice.randint(6, 14))
    width = dice.choice([38, 60, 84])
    lines, now = [], ""
    for w in text.split():
        if len(now) + len(w) + 1 > width:
            lines.append(now)
            now = w
        else:
            now = f"{now} {w}".strip()
    lines.append(now)
    head = dice.choice(["THE COASTAL REVIEW", "Annual account of the wetlands", "Harbour Board / Volume IV"])
    foot = dice.choice(["[{}]", "{}", "page {}", "~ {} ~", "-{}-"])
    out, marked, number = [], [], dice.randint(2, 250)
    for k in range(0, len(lines), 6):
        marked.append(len(out))
        out.append(head)
        out += lines[k : k + 6]
        if k + 6 < len(lines):
            marked.append(len(out))
            out.append(foot.format(number))
            number += 1
    return out, marked if len(marked) > 2 else []


def _other_data(dice):
    """Lines that are no page: timetables, recipes, scores, shopping lists."""
    kind = dice.randrange(4)
    if kind == 0:
        return ["Ferry times", *(f"{h:02d}:{dice.choice(['05', '20', '45'])} quay {dice.choice('ABC')}" for h in range(6, dice.randint(9, 18)))]
    if kind == 1:
        return ["Soup", "carrots", str(dice.randint(1, 9)), "onions", str(dice.randint(1, 9)), "Stir for ten minutes.", "salt", str(dice.randint(10, 90))]
    if kind == 2:
        return [f"{dice.choice(['home', 'away'])} {dice.randint(0, 9)} - {dice.randint(0, 9)}" for _ in range(dice.randint(5, 15))]
    return ["- milk", "- rope", "", "pre-", "or post-season repairs", *(f"#{dice.randint(100, 999)} bolt M{dice.randint(3, 12)}" for _ in range(dice.randint(3, 9)))]


def test_pages_and_data_made_by_other_rules():
    dice = random.Random(9)
    vocabulary = {w.strip(".,").lower(): 50 for s in SENTENCES for w in s.split()} | {"north-facing": 9, "long-term": 20}
    furniture, breaks = S.learn_lines(SENTENCES, vocabulary, 400, [_other_data(dice) for _ in range(0)], pages=900)
    hits = wrong = total = 0
    for _ in range(120):
        lines, marked = _other_page(dice) if dice.random() < 0.6 else (_other_data(dice), [])
        p = furniture.probability(S.line_features([lines])) > 0.5
        total += len(marked)
        hits += sum(p[marked]) if marked else 0
        wrong += sum(bool(p[k]) and bool(lines[k].strip()) for k in range(len(lines)) if k not in marked)
    assert hits >= 0.85 * total and wrong <= 0.1 * total
    assert S.line_features([]).shape == (0, S.N_LINE)
    alone, both = S.line_features([lines]), S.line_features([lines, ["a", "", "12"], []])
    assert np.allclose(alone, both[: len(lines)])


def test_real_words_in_lists_are_joined_to_the_same_corrections(spark):
    """The corrections that are not sent to the tasks but joined give the same texts."""
    dice = random.Random(4)
    rows = [("text", f"clean{k}", prose(dice)) for k in range(250)] + [("text", "misread", SENTENCES[0].replace("survey", "5urvey"))]
    frame = spark.createDataFrame(rows, "kind string, id string, text string")
    sent, joined = (sorted(map(tuple, S.repair_scans(frame, "kind", "id", "text", n).collect())) for n in (S.SENT, 0))
    assert sent == joined and sent[0][-1] == SENTENCES[0]


def test_misread_words_do_not_depend_on_the_size_of_the_corpus(spark):
    counts = {w.strip(".,").lower(): 127 for s in SENTENCES for w in s.split()}
    misread = {"5urvey": "survey", "imrnediately": "immediately", "wefland": "wetland", "cxplain": "explain"}
    counts |= dict.fromkeys(misread, 2)

    def fixes(times):
        table = {w: n * times for w, n in counts.items()}
        words = spark.createDataFrame(list(table.items()), "word string, df bigint")
        return {r["word"]: r["fix"] for r in S.misread_words(words, {w: n for w, n in table.items() if n >= S.RATIO}).collect()}

    small, large = fixes(1), fixes(10)
    assert small == large
    assert misread.items() <= large.items()
