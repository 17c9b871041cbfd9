"""Repair of scanned pages on files whose damage is known."""

import random

import pytest

from folioloom.llm import scan as S
from folioloom.llm.perceptron import Perceptron

WORDS = "pressure furnace schedule regional external channel settlement magnetic foundation temperature concentration measurement baseline instrument procedure catchment inspection reservoir detector sediment calibration moisture turbine harbour component solution invoice survey platform estimate".split()
NOISE = [("o", "0"), ("l", "1"), ("s", "5"), ("m", "rn"), ("e", "c"), ("d", "cl"), ("i", "!")]


def make_file(doc, rng, pages=12):
    """Rows and truth: header and number on each page, body lines with broken, compound and misread words."""
    rows, truth = [], set()
    words = []
    while len(words) < pages * 100:
        words.append("cross-section" if rng.random() < 0.08 else rng.choice(WORDS))
    at = 0
    carry = ""
    for page in range(pages):
        rows.append((doc, page, 0, "text", f"THE {doc.upper()} REPORT", 30.0))
        truth.add((doc, page, 0, "furniture"))
        for k in range(1, 11):
            line, y = [carry] if carry else [], 60.0 + 16 * k
            carry = ""
            bad = rng.random() < 0.06
            for n in range(8):
                w = words[at]
                at += 1
                if bad and n == 4:
                    for a, b in rng.sample(NOISE, len(NOISE)):
                        if a in w[1:]:
                            i = w.index(a, 1)
                            w = w[:i] + b + w[i + 1 :]
                            truth.add((doc, page, k, "misread"))
                            break
                if n == 7 and not (page == pages - 1 and k == 10):
                    if w == "cross-section":
                        w, carry = "cross-", "section"
                    elif len(w) > 8:
                        w, carry = w[:4] + "-", w[4:]
                        truth.add((doc, page, k, "hyphen"))
                line.append(w)
            rows.append((doc, page, k, "text", " ".join(line), y))
        rows.append((doc, page, 11, "inline_equation", "x _ 1", 300.0))
        rows.append((doc, page, 12, "text", str(page + 5), 765.0))
        truth.add((doc, page, 12, "furniture"))
    return rows, truth


SCHEMA = "doc_id string, page_idx int, span_id int, type string, content string, bbox struct<x0:double,y0:double,x1:double,y1:double>, stretch string"


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(5)
    rows, truth = [], set()
    for i in range(25):
        r, t = make_file(f"file{chr(97 + i)}", rng)
        rows += r
        truth |= t
    rows = [(d, p, s, k, c, (50.0, y + 10, 500.0, y) if s % 5 else (50.0, y, 500.0, y + 10), "clash") for d, p, s, k, c, y in rows]
    rows += rows[:200]  # delivered twice
    rows += [("filea", 0, 99, "text", None, None, "clash"), ("filea", 0, 98, "text", "  ", None, "clash"), (None, 0, 1, "text", "x", None, "clash"), ("filea", None, 1, "text", "x", None, "clash")]
    df = spark.createDataFrame(rows, SCHEMA)
    return df, truth, S.repaired_lines(df).cache()


def found(lines, kind):
    return {(r.doc_id, r.page_idx, r.span_id, kind) for r in lines.where(kind).collect()}


@pytest.mark.parametrize(("kind", "least"), [("furniture", 0.99), ("hyphen", 0.97), ("misread", 0.9)])
def test_found(corpus, kind, least):
    _, truth, lines = corpus
    want, got = {t for t in truth if t[3] == kind}, found(lines, kind)
    assert len(want & got) >= least * len(want) and len(got - want) <= 0.03 * len(got)


def test_furniture_that_ends_like_a_sentence(spark):
    rng = random.Random(6)
    rows, truth = [], set()
    for i in range(12):
        r, t = make_file(f"file{chr(97 + i)}", rng)
        # headers of a society's proceedings, numbers with a full stop, body lines that close sentences
        rows += [(d, p, s, k, f"{c}, Vol. {i + 2}." if s == 0 else f"{c}." if s == 12 or s in (3, 7, 10) and c[-1] != "-" else c, y) for d, p, s, k, c, y in r]
        truth |= {x for x in t if x[3] == "furniture"}
    df = spark.createDataFrame([(d, p, s, k, c, (50.0, y, 500.0, y + 10), "") for d, p, s, k, c, y in rows], SCHEMA)
    got = found(S.repaired_lines(df), "furniture")
    assert len(truth & got) >= 0.99 * len(truth) and len(got - truth) <= 0.01 * len(got)


def test_each_line_once_and_paragraphs_whole(corpus):
    df, _, lines = corpus
    assert lines.count() == df.where("type = 'text' AND content rlike '[^ ]' AND doc_id IS NOT NULL AND page_idx IS NOT NULL").dropDuplicates(["doc_id", "page_idx", "span_id"]).count()
    text = S.paragraphs(lines).where("doc_id = 'filea'").collect()
    whole = " ".join(r.text for r in sorted(text, key=lambda r: (r.page_idx, r.span_id)))
    assert "REPORT" not in whole and sum(r.n_lines for r in text) == 120
    for r in lines.where("doc_id = 'filea' AND hyphen").collect():
        assert not r.repaired.endswith("-") and r.repaired.split()[-1] in whole


def test_neighbours_over_stretches(spark):
    rows = [("d", p, s, f"l{p}.{s}") for p in range(0, 200, 3) for s in range(2)]
    body = spark.createDataFrame(rows, "doc_id string, page_idx int, span_id int, content string")
    got = sorted(map(tuple, S.with_neighbours(body).select("page_idx", "span_id", "content", "next", "before").collect()))
    names = [r[3] for r in rows]
    assert [(g[2], g[3], g[4]) for g in got] == list(zip(names, [*names[1:], None], [None, *names[:-1]], strict=True))


def repaired(spark, rows):
    kinds = ["text" if len(r) < 6 else r[5] for r in rows]
    return spark.createDataFrame([(*r[:3], k, r[3], r[3], False, r[4], False) for r, k in zip(rows, kinds, strict=True)], "doc_id string, page_idx int, span_id int, type string, content string, repaired string, furniture boolean, hyphen boolean, misread boolean")


def test_paragraphs_over_stretches(spark):
    full = "a line of running text that goes on and on over the page"
    rows = [("d", p, s, full, False) for p in range(0, 3 * S.STRETCH, 3) for s in range(3)]
    rows += [("d", 3 * S.STRETCH, 0, "closed here.", False), ("d", 3 * S.STRETCH, 1, full + ".", False)]
    rows += [("e", S.STRETCH - 1, 0, f"{full} opera", True), ("e", 2 * S.STRETCH, 0, "tors recorded by hand, as all of the lines of this page do", False), ("e", 2 * S.STRETCH, 1, "the end.", False)]
    rows += [("g", S.STRETCH - 1, 0, full, False), ("g", S.STRETCH - 1, 1, "the end.", False), ("g", S.STRETCH, 0, full, False)]
    # a heading opens a stretch
    rows += [("h", S.STRETCH - 1, 0, full + ".", False), ("h", S.STRETCH, 0, "Chapter 2", False), ("h", S.STRETCH, 1, full, False)]
    got = sorted(map(tuple, S.paragraphs(repaired(spark, rows)).collect()))
    n = len(rows) - 11
    assert got == [
        ("d", 0, 0, n + 1, " ".join([full] * n) + " closed here."),
        ("d", 3 * S.STRETCH, 1, 1, full + "."),
        ("e", S.STRETCH - 1, 0, 3, f"{full} operators recorded by hand, as all of the lines of this page do the end."),
        ("g", S.STRETCH - 1, 0, 2, f"{full} the end."),
        ("g", S.STRETCH, 0, 1, full),
        ("h", S.STRETCH - 1, 0, 1, full + "."),
        ("h", S.STRETCH, 0, 1, "Chapter 2"),
        ("h", S.STRETCH, 1, 1, full),
    ]


def test_formulas_stay_among_the_lines(spark, corpus):
    df, _, lines = corpus
    own = S.other_lines(df)
    assert own.count() == 25 * 12 and own.where("furniture OR hyphen OR misread OR content <> repaired").isEmpty()
    text = S.paragraphs(lines.unionByName(own)).where("doc_id = 'filea'").collect()
    assert sum(r.n_lines for r in text) == 132 and sum(r.text.count("x _ 1") for r in text) == 12
    full = "a line of running text that goes on and on over the page"
    e = "T _ { 2 } = 5"
    rows = [("d", 0, 0, f"{full} opera", True), ("d", 0, 1, e, False, "inline_equation"), ("d", 0, 2, e, False, None), ("d", 0, 3, f"tors {full}", False)]
    rows += [("d", 0, 4, e, False, "inline_equation"), ("d", 0, 5, "the end.", False), ("d", 0, 6, "y" * 300, False, "inline_equation"), ("d", 0, 7, full, False)]
    # formulas around the border of stretches, and alone on their pages
    rows += [("e", S.STRETCH - 1, 0, f"{full} opera", True), ("e", S.STRETCH - 1, 1, e, False, "inline_equation"), ("e", S.STRETCH, 0, e, False, "inline_equation"), ("e", 2 * S.STRETCH, 0, e, False, "inline_equation"), ("e", 3 * S.STRETCH, 0, f"tors {full}", False)]
    rows += [("f", 0, 0, e, False, "inline_equation"), ("f", S.STRETCH, 0, full, False)]
    got = sorted(map(tuple, S.paragraphs(repaired(spark, rows)).collect()))
    assert got == [
        ("d", 0, 0, 7, f"{full} operators {e} {e} {full} {e} the end. {'y' * 300}"),
        ("d", 0, 7, 1, full),
        ("e", S.STRETCH - 1, 0, 5, f"{full} operators {e} {e} {e} {full}"),
        ("f", 0, 0, 2, f"{e} {full}"),
    ]


def test_alignment():
    assert S._align("surnmary", "summary") == ["=", "=", "m", "", "=", "=", "=", "="]
    assert S._align("fiow", "flow") == ["=", "l", "=", "="]
    assert S._align("abc", "xyz") is None


def test_perceptron_learns():
    data = [([f"a{i % 2}", f"b{i % 3}"], "yes" if i % 2 else "no", ("yes", "no")) for i in range(60)]
    model = Perceptron.fit(data)
    assert all((model.margin(f) > 0) == (y == "yes") for f, y, _ in data)


def test_empty(spark):
    assert S.repaired_lines(spark.createDataFrame([], SCHEMA)).count() == 0
