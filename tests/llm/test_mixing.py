"""Mixing: exact raking of sources, caps, and draws that follow the weights."""

import numpy as np
import pytest

from folioloom.llm import mixing as M


def test_rake_meets_sources_and_caps():
    rng = np.random.default_rng(2)
    tokens = rng.integers(1, 5000, 200).astype(float)
    source, lang, topic = rng.integers(0, 4, 200), rng.integers(0, 5, 200), rng.integers(0, 6, 200)
    share, cap = np.array([0.4, 0.3, 0.2, 0.1]), np.array([1, 2, 3, 5])
    r = M.rake(tokens, source, [lang, topic], share, cap)
    got = np.bincount(source, r.weight * tokens)
    assert np.allclose(got / got.sum(), share, atol=1e-6) and (r.weight <= cap[source] + 1e-9).all()
    # the size is the largest: one source is used up
    has = np.bincount(source, tokens)
    assert np.isclose(r.size, (cap * has / share).min())


def test_rake_meets_all_marginals_where_it_can():
    # plenty of text: languages and topics keep their natural shares within every source
    tokens = np.full(24, 1000.0)
    source, lang = np.repeat([0, 1], 12), np.tile([0, 1, 2], 8)
    tokens[lang == 0] = 3000
    tokens[(source == 1) & (lang == 1)] = 9000
    r = M.rake(tokens, source, [lang], np.array([0.9, 0.1]), np.array([500, 1]))
    natural = np.bincount(lang, tokens) / tokens.sum()
    got = np.bincount(lang, r.weight * tokens)
    assert np.allclose(got / got.sum(), natural, atol=1e-4)


def test_missing_source():
    r = M.rake(np.array([100.0, 300.0]), np.array([0, 1]), [np.array([0, 0])], np.array([0.5, 0.4, 0.1]), np.array([1, 1, 1]))
    assert np.isclose(r.size, 200) and np.allclose(r.weight * [100, 300], [100, 80])
    assert M.rake(np.zeros(0), np.zeros(0, int), [np.zeros(0, int)], np.array([1.0]), np.array([1])).size == 0


SCHEMA = "doc_id long, source string, lang string, topic string, n_tokens long, copies string"


def test_frames(spark):
    rng = np.random.default_rng(4)
    rows = [(i, ["a", "b", "c", None, "z"][int(rng.choice(5, p=[0.6, 0.2, 0.05, 0.1, 0.05]))], ["en", "de"][i % 2], ["x", "y", "other"][i % 3], int(rng.integers(0, 400)), "clash") for i in range(6000)]
    counted = spark.createDataFrame(rows, SCHEMA)
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.15, 4), ("none", 0.05, 3), ("z", None, 2)], "source string, target_share double, max_repeats int")
    mixed = M.mix(counted, targets).cache()
    caps = {"a": 1, "b": 2, "c": 4}
    got = mixed.collect()
    assert len({r.doc_id for r in got}) == len(got) and all(1 <= r.copies <= caps[r.source] for r in got)
    report = {r.source: r for r in M.shares(mixed, counted, targets).collect()}
    for s, want in (("a", 0.5), ("b", 0.3), ("c", 0.15)):
        # within half a document of the target
        total = sum(r.mixed_tokens for r in report.values())
        assert abs(report[s].mixed_tokens - want / 0.95 * total) <= 2 * 400
        assert report[s].actual_share == pytest.approx(want / 0.95, abs=400 / total)
    assert report["none"].mixed_tokens == 0 and report["none"].actual_share == 0 and report["z"].documents == 0
    assert sorted(map(tuple, got)) == sorted(map(tuple, M.mix(counted.repartition(7), targets).collect()))
    assert M.mix(counted.limit(0), targets).count() == 0 == M.mix(counted, targets.limit(0)).count()


def cells(spark, rng, n_topics):
    rows = []
    for s, mean in (("a", 3000), ("b", 900), ("c", 100)):
        for lang in ("de", "en", "fr"):
            rows += [(s, lang, f"t{k}", int(rng.integers(1, mean))) for k in range(n_topics) if rng.random() < 0.8]
    return rows, spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")


def test_executors_fit_what_the_driver_fits(spark):
    rows, df = cells(spark, np.random.default_rng(8), 12)
    goals = {"a": (0.5, 1), "b": (0.3, 2), "c": (0.1, 3), "none": (0.1, 2)}
    names, at = sorted(goals), lambda k: np.unique([r[k] for r in rows], return_inverse=True)[1]
    want = M.rake(np.array([float(r[3]) for r in rows]), np.array([names.index(r[0]) for r in rows]), [at(1), at(2)], np.array([goals[s][0] for s in names]), np.array([goals[s][1] for s in names]), 4).weight
    got = {(r.source, r.lang, r.topic): r.weight for r in M.rake_frame(df, goals, 4).collect()}
    assert all(got[r[:3]] == pytest.approx(w, rel=1e-4) for r, w in zip(rows, want, strict=True))
    assert M.rake_frame(df.limit(0), goals).count() == 0


def test_rare_topics_keep_their_share():
    # a topic of 1e-5 of all tokens, all of it in a source that gives less than its natural share
    tokens, source, topic = np.array([1e6, 1e6, 20.0, 1e6]), np.array([0, 0, 0, 1]), np.array([0, 1, 2, 0])
    r = M.rake(tokens, source, [topic], np.array([0.5, 0.5]), np.array([2, 1]))
    got = np.bincount(topic, r.weight * tokens)
    assert got[2] / got.sum() == pytest.approx(20 / tokens.sum(), rel=0.01)


def test_shares_by_executors(spark, monkeypatch):
    monkeypatch.setattr(M, "ROUNDS", 3)
    rng = np.random.default_rng(4)
    rows = [(i, "ab"[int(rng.integers(0, 2))], "en", f"t{i % 40}", int(rng.integers(1, 50)), "") for i in range(800)]
    counted = spark.createDataFrame(rows, SCHEMA)
    targets = spark.createDataFrame([("a", 0.8, 1), ("b", 0.2, 2)], "source string, target_share double, max_repeats int")
    mixed = M.mix(counted, targets, most_cells=10)
    report = {r.source: r for r in M.shares(mixed, counted, targets).collect()}
    total = sum(r.mixed_tokens for r in report.values())
    assert abs(report["a"].mixed_tokens - 0.8 * total) <= 50 and report["a"].mixed_tokens == pytest.approx(sum(r[4] for r in rows if r[1] == "a"), abs=50)
