"""Damage made on purpose must be found and undone; sound text must stay."""

import pytest

from folioloom.llm import mojibake as M
from folioloom.llm import queries as Q

SENTENCES = [
    "Das größere Gefälle übersteigt die äußere Fläche während der Prüfung.",
    "La température élevée améliore le barème mesuré près de la sortie.",
    "It’s known that the sensor – see § 12 – drifts by ±67 µm.",
    "El cálculo óptico determina la señal pequeña según el método añadido.",
    "Устойчивое решение заменяет увеличенный расчёт между двумя опытами.",
    "内部的水库限制了公共的涂层，如果供应商同意。平均的报告影响了修正后的记录。",
    "• The first item\n• Der zweite Punkt\n[3] A. Name, Field Eng. 12, 83–96.",
    "“Quoted text,” the inspector’s note says — 36 °C.",
    "A plain English sentence about the harbour.",
]


@pytest.fixture(scope="module")
def repair():
    # every sentence in texts of its own, so that its neighbours are usual
    return M.Repair(M.fit([f"{s} {k}" for k in range(30) for s in SENTENCES]))


def wrong(text, meant, shown):
    return bytes(text, meant).decode(shown, "strict")


@pytest.mark.parametrize(
    ("sentence", "meant", "shown"),
    [
        (0, "utf-8", "latin-1"),
        (1, "utf-8", "latin-1"),
        (2, "utf-8", "latin-1"),
        (0, "utf-8", "mac_roman"),
        (1, "utf-8", "cp437"),
        (3, "utf-8", "cp850"),
        (4, "utf-8", "latin-1"),
        (5, "utf-8", "latin-1"),
        (5, "gb2312", "latin-1"),
        (4, "koi8_r", "cp1251"),
        (4, "cp1251", "latin-1"),
        (0, "mac_roman", "cp1252"),
        (1, "cp850", "latin-1"),
        (2, "cp1252", "latin-1"),
        (3, "cp1252", "mac_roman"),
    ],
)
def test_restores(repair, sentence, meant, shown):
    text = SENTENCES[sentence]
    bad = wrong(text, meant, shown)
    assert bad != text
    got = repair(bad)
    assert got.damaged and got.text == text
    # only the damaged part of a text changes
    mixed = repair(f"{text} {bad}")
    assert mixed.damaged and mixed.text == f"{text} {text}"


LATIN = [s for s in SENTENCES if any("\xc0" <= c <= "\u017f" for c in s)]


@pytest.mark.parametrize("shown", ["latin-1", "cp1252", "mac_roman", "cp437", "cp850", "iso8859_15", "cp1250", "cp1251"])
@pytest.mark.parametrize("sentence", SENTENCES)
def test_utf8_is_certain(repair, sentence, shown):
    """Whatever the model thinks usual: one damaged word is found and restored, in every encoding that has all its bytes."""
    for word in sentence.split():
        if word.isascii() or not any(c.isalpha() for c in word):
            continue
        try:
            bad = word.encode().decode(shown)
        except UnicodeDecodeError:
            continue
        if len(word) == 1 or any("а" <= c.lower() <= "я" for c in word) and shown == "mac_roman":
            continue
        got = repair(f"the {bad} end")
        twins = shown in ("iso8859_15", "cp1250")  # some of their signs have another place in cp1252
        assert got.damaged and (got.text == f"the {word} end" or twins), (bad, got)


@pytest.mark.parametrize("sentence", LATIN)
def test_latin_read_as_chinese(repair, sentence):
    got = repair(sentence.encode().decode("gbk", "replace"))
    assert got.damaged and sum(a != b for a, b in zip(got.text, sentence, strict=False)) <= 3 + abs(len(got.text) - len(sentence))
    pinyin = "La valeur élevée à côté, même ici"
    bad = pinyin.replace("ô", "ê").encode("gb2312").decode("latin-1")
    assert repair(bad).text == pinyin.replace("ô", "ê")


@pytest.mark.parametrize(("text", "codec"), [("內部的水庫限制了公共的塗層", "big5"), ("この装置は水の流れを制御するために使われる", "shift_jis"), ("内部的水库限制了公共的涂层", "gb18030")])
def test_east_asian_sets(repair, text, codec):
    bad = text.encode(codec).decode("cp1252", "replace").replace("\ufffd", "")
    if len(bad) == len(text.encode(codec)):
        got = repair(bad)
        assert got.damaged and got.text == text
    assert not repair(text).damaged


@pytest.mark.parametrize("text", ["CAFÉ” ouvert", "un CAFÉ’S nom", "« À »", "├─ a\n│ ├┤ b", "“École” – École", "—été—", "Müller–Åberg", "точка Г–Д", "Рёбра", "класс «В»", "¡Águila! ¿Él?", "¡Éxito! 40 °C", "été”— dit-il"])
def test_what_could_be_sound_is_not_certain(text):
    assert M._certain(text) is None


def test_fit_by_executors(spark):
    texts = [f"{s} {k}" for k in range(30) for s in SENTENCES] + [wrong(SENTENCES[0], "utf-8", "latin-1")] * 2
    local = M.fit(texts)
    frame = M.fit_frame(spark.createDataFrame([(t,) for t in [*texts, None]], "text string"))
    assert (frame.texts, frame.single, frame.pair) == (local.texts, local.single, local.pair)
    assert M.fit_frame(spark.createDataFrame([], "text string")).texts == 0


def test_model_rests_on_all_texts(spark, tmp_path):
    # 500 of 2000 documents hold one sign, long ones another; half of 4000 blocks hold a third
    long = "þ " + "a longer text " * 2000
    documents = [(k, f"number {k} {'œuvre' if k % 4 == 0 else ''} {long if k % 250 == 1 else ''}", "en") for k in range(2000)]
    blocks = [(k, f"block {k} {'§' if k % 2 else ''}", "text") for k in range(4000)]
    spark.createDataFrame(documents, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(blocks, "block_id long, content string, type string").write.parquet(f"{tmp_path}/blocks.parquet")
    model = Q._encoding_model(spark, str(tmp_path)).value
    # scaled to 500 documents of a label and 3000 blocks
    assert model.texts == 3500 and (model.single["œ"], model.single["þ"], model.single["§"]) == (125, 2, 1500) and model.pair["œu"] == 125


def test_twice_damaged(repair):
    text = SENTENCES[0]
    twice = wrong(wrong(text, "utf-8", "latin-1"), "utf-8", "latin-1")
    assert repair(twice).text == text


def test_utf8_read_as_gbk(repair):
    text = SENTENCES[5]
    bad = text.encode().decode("gbk", "replace")
    got = repair(bad)
    assert got.damaged and "供应商同意" in got.text


@pytest.mark.parametrize("text", [*SENTENCES, None, "", "ascii only", "(NAÇÃO, £50)", "“Â”", "Émile–Zürn", "Pêche", "Ørsvåg ½ ¾", "ÜBERSICHT", "РАСЧЁТ", "Ｗｉｄｅ", "ＳＣＯＰＥ", "Sсope"])
def test_sound_text_stays(repair, text):
    got = repair(text)
    assert got.text == text and not got.damaged


def test_lost_characters(repair):
    got = repair("La temp�rature �lev�e")
    assert got.damaged and got.kinds == ("lost",) and got.text.count("�") == 3
    assert repair("a \x85 b").damaged


def test_frames(spark, repair):
    bad = wrong(SENTENCES[0], "utf-8", "latin-1")
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, bad, "x"), (3, bad, "x"), (4, (SENTENCES[0] + " ") * 2000 + bad, "x")], "block_id long, content string, restored string")
    model = spark.sparkContext.broadcast(repair.model)
    out = sorted(((r.block_id, r.restored, r.damaged) for r in M.repaired(df, model, ["block_id"]).collect()), key=lambda r: r[0])
    assert out[0] == (1, None, False) and out[1] == (2, "", False)
    assert out[2] == out[3] == (3, SENTENCES[0], True) and out[4][1] == (SENTENCES[0] + " ") * 2000 + SENTENCES[0]
    assert M.repaired(df.limit(0), model, ["block_id"]).count() == 0


def test_many_texts_at_once(repair, monkeypatch):
    """As one by one, in any company; sound texts cost no look at their words."""
    damaged = [wrong(SENTENCES[k], "utf-8", shown) for k, shown in ((0, "latin-1"), (1, "cp437"), (4, "cp1251"), (5, "latin-1"))] + [wrong(SENTENCES[0], "mac_roman", "cp1252"), wrong(SENTENCES[4], "koi8_r", "cp1251")]
    odd = [None, "", " ", "\n", "plain", "lost �", "\x85", "a b", "Kelvin İ", "x\ud800", "龘龘", "\U0001d4b3 é", "Ã©"]
    texts = [t for pair in zip(damaged * 9, SENTENCES * 6, strict=True) for t in pair] + odd
    assert repair.all(texts) == [repair(t) for t in texts]
    assert repair.all([]) == []
    monkeypatch.setattr(M.Repair, "_suspect", None)
    assert not any(r.damaged for r in repair.all(SENTENCES))


def test_screen_of_certain_spans(repair):
    """Texts that can't hold a certain span aren't looked at alone; what was read before isn't read again."""
    spans = ["¡¤ ", "¨¡", "Ã©", "â€™", "вЂ™", "‚Äô", "ð\x9f\x98\x80", "‚Ä‚Ä‚Ä‚Ä", "é’é’", "Größe „é“", "aéèb", "éÃ", "Ã", "x\ud800", ""]
    texts = [*spans, *(f"{a} {b}{a}" for a in spans for b in spans), *SENTENCES, *(wrong(SENTENCES[0], "utf-8", c) for c in ("cp1252", "mac_roman", "cp437", "cp850"))]
    may = [bool(M._TWO.search(t) and M._gate().search(t)) for t in texts]
    found = M._Line(texts).certain().tolist()
    assert all(f for f, m in zip(found, may, strict=True) if m) and sum(found) <= sum(may) + 20 and not found[spans.index("aéèb")]
    bad = wrong(SENTENCES[4], "koi8_r", "cp1251")
    fresh = M.Repair(repair.model)
    first = fresh(bad)
    assert first.damaged
    fresh._readings = fresh._read = None  # words and runs are remembered
    assert fresh(bad) == first


def test_tally_in_arrays():
    """Counts in arrays are those of the plain count, whatever the number of texts and signs."""
    texts = ["", "\n", "İ K", "　", "x\ud800", "\U0001d4b3", *(f"{s} {k} {chr(0x4E00 + 3 * k)}" for k in range(300) for s in SENTENCES)]
    tally = M._Tally()
    for text in texts:
        tally.add(2, text)
    n, single, pair = M._tally(texts)
    assert {key: k for _, key, k in tally.rows()} == {"": n, **single, **pair}


def test_blanks_in_arrays():
    """Blanks of any kind and number count as one, also at the ends and between texts; an empty text has its two."""
    texts = ["  a \t b\n\n", "", " \u3000\n ", "x", "\u00a0é\x85\x1c ü \u2003", "a", "\u200b \u200b"]
    for part in (texts, texts[::-1], texts[1:3], texts[:1]):
        tally = M._Tally()
        for text in part:
            tally.add(0, text)
        n, single, pair = M._tally(part)
        assert {key: k for _, key, k in tally.rows()} == {"": n, **single, **pair}
