"""Languages of held-out documents and of mixed texts."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioloom.llm import language as L
from folioloom.llm import queries as Q
from folioloom.llm.labels import LANGUAGES, normal_label


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("length(trim(text)) > 80").withColumn("label", normal_label(F.col("lang")))
    return [(r.doc_id, r.label, r.text) for r in df.where("doc_id % 4 = 0").select("doc_id", "label", "text").collect()]


@pytest.fixture(scope="module")
def judge(docs):
    return L.Judge(L.fit([(label or "other", text) for i, label, text in docs if i % 8 == 0]))


def test_held_out_documents(docs, judge):
    held = [(label, text) for i, label, text in docs if i % 8 == 4 and label]
    right = sum(LANGUAGES[int(np.argmax(judge.shares(text)[0]))] == label for label, text in held)
    # labels themselves are wrong here and there
    assert len(held) > 500 and right / len(held) > 0.97


def test_bloom_slices_hold_what_was_put_in():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 2**63, 60_000, dtype=np.uint64))
    masks = rng.integers(1, 128, len(keys)).astype(np.uint8)
    f = L.Filters.of(keys, masks)
    assert ((f.masks(keys) & masks) == masks).all()
    others = rng.integers(0, 2**63, 200_000, dtype=np.uint64)
    hits = np.unpackbits(f.masks(others)[:, None], axis=1, bitorder="little")[:, : len(LANGUAGES)].mean(axis=0)
    assert np.allclose(hits, f.chance, rtol=0.25, atol=2e-4)


def test_filters_rest_on_all_documents(spark, tmp_path):
    en, de = "The nominal pressure confirms the external settlement number", "Der regionale Bericht begrenzt den Vertrag Nummer"
    # n-grams of "zyxw" stand in every hundredth document, and so do those of "qjv", in texts of any length
    documents = [(k, f"{en if k % 2 else de} {k} {'zyxw' if k % 100 == 1 else ''} {'qjv ' * 6000 if k % 100 == 3 else ''}", "en" if k % 2 else "de") for k in range(2400)]
    spark.createDataFrame(documents, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    texts = Q.training_texts(spark.read.parquet(f"{tmp_path}/documents.parquet"))
    filters = L.fit_frame(texts)
    assert (filters.masks(L.grams("zyxw")[0]) == 1).all() and (filters.masks(L.grams("qjv")[0]) == 1).all()
    # below PER_LABEL texts a label: as fitted by the driver
    few = texts.where("length(text) < 900").limit(600)
    here = L.fit([(r.label, r.text) for r in few.collect()])
    assert (L.fit_frame(few).slices == here.slices).all()
    assert not L.fit_frame(texts.limit(0)).slices.any()


def test_mixed_text_is_cut_at_sentences(judge):
    de = "Der regionale Bericht begrenzt den kürzeren Vertrag ohne weitere Behandlung."
    en = "The nominal pressure confirms the external settlement over several decades."
    ru = "Средненная проба ограничивает водный договор у выхода канала."
    text = f"{de} {de} 12. {en}\n{ru}"
    segments = judge.segments(text)
    assert [(s.lang, s.sentences) for s in segments] == [("de", 2), ("en", 1), ("ru", 1)]
    assert segments[0].start == 0 and segments[-1].end == len(text)
    assert all(a.end == b.start for a, b in zip(segments, segments[1:], strict=False))
    assert all(0 < s.confidence <= 1 for s in segments)
    code = "e461b1f7f8d690c76681af3898c859ed380a16b039746207163fcaf9e8de47f15de6308b80e5d8bd4b4940c133f7ba2c."
    assert sum(s.sentences for s in judge.segments(code)) == 0
    assert judge.segments(None) == judge.segments("") == judge.segments(" 12 + 7 = 19 ") == []


def test_labels(spark):
    rows = [("EN",), (" de-AT ",), ("zh_CN",), ("ch_server",), ("east_slavic",), ("German",), ("latin",), ("",), (None,), ("auto",)]
    got = [r[0] for r in spark.createDataFrame(rows, "l string").select(normal_label(F.col("l"))).collect()]
    assert got == ["en", "de", "ch", "ch", "ru", "de", None, None, None, None]
    tasks = spark.createDataFrame(
        [(1, ["a", "b"], ["de", None]), (2, ["c", "d"], ["fr"]), (3, ["e"], None), (4, ["f"], []), (5, ["a"], ["und"]), (6, ["c"], ["it"]), (6, ["c"], ["it"]), (7, None, ["en"]), (8, [None], ["en"])],
        "submit_order long, file_names array<string>, lang_list array<string>",
    )
    assert {r.doc_id: r.label for r in L.file_labels(tasks).collect()} == {"a": "de", "b": None, "c": "it", "d": "fr", "e": None, "f": None}


def test_frames(spark, judge):
    en = "The nominal pressure confirms the external settlement over several decades."
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, en, "x"), (3, en, "x"), (4, (en + " ") * 3000, "x")], "block_id long, content string, lang string")
    filters = spark.sparkContext.broadcast(judge.filters)
    out = sorted((r.block_id, r.lang, r.sentences) for r in L.segment_texts(df, filters, ["block_id"]).collect())
    assert out == [(3, "en", 1), (3, "en", 1), (4, "en", 3000)]
    assert L.segment_texts(df.limit(0), filters, ["block_id"]).count() == 0


def test_blocks_of_every_type(spark, tmp_path):
    en = "The nominal pressure confirms the external settlement over several decades."
    de = "Der regionale Bericht begrenzt den kürzeren Vertrag ohne weitere Behandlung."
    fr = "Dans la plupart des cas, le barème moyen contrôle le rapport annuel du réservoir."
    blocks = [(1, "a", "title", de[:-1]), (2, "a", "list", f"- {de}\n- {de}"), (3, "a", "ref_text", f"[1] Name, A.: {en} " * 9), (4, "a", "code", "# keep values above the limit and return them\n" * 20), (5, "b", "table_caption", fr), (6, "c", "ref_text", en), (7, "d", "page_number", "12"), (8, "d", "text", None), (9, "e", None, de)]
    spark.createDataFrame(blocks, "block_id long, doc_id string, type string, content string").write.parquet(f"{tmp_path}/blocks.parquet")
    spark.createDataFrame([(1, list("abcde"), ["en", "en", None, "it", None])], "submit_order long, file_names array<string>, lang_list array<string>").write.parquet(f"{tmp_path}/tasks.parquet")
    (tmp_path / "documents.parquet").symlink_to("/root/testdata/sf0.01/documents.parquet")
    assert {(r.block_id, r.lang) for r in Q.p3_segments(spark, str(tmp_path)).collect()} == {(1, "de"), (2, "de"), (3, "en"), (4, "en"), (5, "fr"), (6, "en"), (9, "de")}
    files = {r.doc_id: (r.detected, r.lang) for r in Q.p3_files(spark, str(tmp_path)).collect()}
    assert files == {"a": ("de", "de"), "b": ("fr", "fr"), "c": ("en", "en"), "d": (None, "it"), "e": ("de", "de")}
    assert Q.p3_found(spark, str(tmp_path)).collect() == []


def test_many_texts_at_once(judge, docs, monkeypatch):
    """N-grams of joined texts are those of each, in parts of any size."""
    texts = ["", "a", "\U00020000 中文字\n\nx", "12", *(t for _, _, t in docs[:60])]
    labels = [k % 8 - 1 for k in range(len(texts))]
    counts = Counter(k for t in texts for k in set(L.grams(t)[0].tolist()))
    keys, n = L._texts_with(texts)
    assert dict(zip(keys.tolist(), n.tolist(), strict=True)) == counts
    whole, segments = judge.relabelled(labels, texts), judge.segments_of(texts)
    for label, text, found in zip(labels, texts, whole, strict=True):
        shares, n = judge.shares(text)
        last, best = np.sort(shares)[-2:]
        assert found == (label if n < L.LEAST_GRAMS else int(shares.argmax()) if best - last >= L.LEAST_LEAD else -1)
    monkeypatch.setattr("folioloom.llm.arrow.PORTION", 1500)
    assert judge.relabelled(labels, texts) == whole and judge.segments_of(texts) == segments
    assert judge.relabelled([], []) == judge.segments_of([]) == []


def test_wrong_labels_move(spark, docs):
    """The second fit moves mislabelled documents and counts the others once."""
    rows = [(("en" if k % 9 == 0 else "other" if k % 11 == 0 else label) or "other", text) for k, (_, label, text) in enumerate(docs[:600])]
    here = L.fit(rows)
    assert (L.fit_frame(spark.createDataFrame(rows, "label string, text string")).slices == here.slices).all()
    known = [LANGUAGES.index(label) if label in LANGUAGES else -1 for label, _ in rows]
    assert sum(a != b for a, b in zip(known, L.Judge(here).relabelled(known, [t for _, t in rows]), strict=True)) > 50


def test_sentence_ends_and_lookups(judge):
    cuts = {'He said "x."\n\nNext… 3.14 is': [12, 14, 19], "内部。」公共！！": [4, 8], "a.b ": [], "\n": [1]}
    for text, ends in cuts.items():
        assert [m.end() for m in L._END.finditer(text)] == ends, text
    assert L._whole("One two three.) ") and not L._whole("One two three. ) ") and not L._whole("One two three")
    keys = L.grams("Der regionale Bericht " * 4000)[0]
    assert (judge.filters.masks(keys) == np.bitwise_and.reduce(judge.filters.slices[L._slots(keys)], axis=0)).all()


def test_words_are_looked_up_once(judge, docs, monkeypatch):
    """Words that come again cost no look at their n-grams, and what is remembered is bounded; shares are those of all n-grams."""
    looked: list[int] = []
    masks = L.Filters.masks
    monkeypatch.setattr(L.Filters, "masks", lambda self, keys: looked.append(len(keys)) or masks(self, keys))
    fresh = L.Judge(judge.filters)
    text = "Der regionale Bericht begrenzt den Vertrag. 内部的水库限制了公共的涂层。 Dans la plupart des cas.\n" * 3
    found = fresh.segments_of([text] * 50)
    assert found[0] and all(f == found[0] for f in found)
    assert 0 < sum(looked) <= len(L.grams(text)[0])
    monkeypatch.setattr(L, "WORDS", 20)
    texts = ["", "12 3", "\U00020000 x", "e\u0301 K", *(t for _, _, t in docs[:30])]
    for part in (texts[:4], texts[4:20], texts):
        shares, sizes = fresh._shares_by("\n".join(part), np.cumsum([len(t) + 1 for t in part]))
        for t, own, n in zip(part, shares, sizes, strict=True):
            expected = judge.shares(t)
            assert n == expected[1] and (own == expected[0]).all()
    letters = L._letters_in(texts, [[L.Segment(0, len(t) // 2, "", 0, 0), L.Segment(len(t) // 2, len(t), "", 0, 0)] for t in texts])
    assert [sum(n) for n in letters] == [sum(map(str.isalpha, t)) for t in texts]
