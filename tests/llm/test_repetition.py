"""Repetition within a document against its definition."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st

from folioloom.llm import queries as Q
from folioloom.llm import repetition as R


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "Ab,", "12", "-", "c3", "水", "位水位", "表x", "é", "\n\n"]), max_size=120))
def test_share_equals_definition(words):
    text = " ".join(words)
    n, again = R.measure(text)
    assert math.isclose(again / n if n else 0.0, R.brute_share(text), abs_tol=1e-12)


def test_known_shares():
    eight = "one two three four five six seven eight"
    assert R.measure(eight) == (32, 0)
    assert R.measure(f"{eight}. {eight.upper()} 17!") == (64, 32)
    assert R.measure(f"{eight} x one two three four five six seven y") == (61, 0)
    han = "修正后的水库在低压环境中不经进"
    assert R.measure(han + "。" + han) == (30, 15)
    assert R.measure(han[:14] + "，x " + han[:14])[1] == 0
    assert R.measure(None) == R.measure("") == R.measure(" 12 -- ") == (0, 0)


def test_bound_is_exact():
    # no failure in n trials: the bound solves (1 - p) ** n = error
    assert math.isclose(R.upper_bound(0, 300, 0.05), 1 - 0.05 ** (1 / 300), rel_tol=1e-6)
    assert R.upper_bound(5, 5, 0.05) == 1.0
    assert math.isclose(R.upper_bound(3, 100, 0.025), 0.0852, abs_tol=5e-4)


def test_calibration(spark):
    rows = [("en", i / 1000, False) for i in range(400)] + [("en", 0.9, True)] * 50 + [("de", 0.1, False)] * 20
    df = spark.createDataFrame(rows, "stratum string, score double, label boolean")
    got = {r[0]: r[1:] for r in R.calibrate(df, ["en", "de", "fr"], rate=0.02)}
    assert got["en"][0] == 0.4 and got["en"][2] == 0 and got["en"][3] <= 0.02
    # too few of their own: the cutoff of all
    assert got["de"] == got["fr"] and got["de"][0] == 0.4 and got["de"][1] == 420
    assert {r[1] for r in R.calibrate(df.where("stratum = 'de'"), ["en", "de"])} == {math.inf}


WORDS = ["w" + "abcdefghij"[k % 10] * (k % 7 + 1) + "klmnopqrst"[k // 10 % 10] + "uvwxyz"[k // 100 % 6] for k in range(600)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([*WORDS, "水位水", "表x", "é"]), max_size=200), st.floats(0, 0.999))
def test_planted_share_is_the_true_one(words, luck):
    made = R.plant(" ".join(words), luck)
    if made:
        assert math.isclose(R.brute_share(made[0]), made[1], abs_tol=1e-9) and made[1] < 0.75


def test_calibrated_on_planted_texts(spark):
    rows = [(k, " ".join(WORDS[(k * 7 + i * (k % 5 + 1)) % 600] for i in range(120)), "en" if k % 2 else "de") for k in range(3000)]
    holdout = R.planted(spark.createDataFrame(rows, "doc_id long, text string, stratum string"), "doc_id")
    found = R.calibrate(holdout, ["de", "en", "fr"])
    assert [r[0] for r in found] == ["de", "en", "fr"]
    # a lower cutoff rejects texts known to be sound, a higher one isn't the smallest
    assert all(r[1] == R.LIMIT and r[4] <= 0.02 for r in found)


def test_cutoffs_rest_on_all_documents(spark, tmp_path):
    rows = [(k, " ".join(WORDS[(k * 7 + i * (k % 5 + 1)) % 600] for i in range(60)), "en" if k % 4 else "de") for k in range(3200)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    sound = {r.stratum: r["count"] for r in R.planted(documents.withColumnRenamed("lang", "stratum"), "doc_id").where("NOT label").groupBy("stratum").count().collect()}
    got = {r.stratum: r.sound for r in Q.p10_cutoffs(spark, str(tmp_path)).collect()}
    assert sound["en"] > 1000 and {s: got[s] for s in sound} == sound


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([*"abcdefgh"]), max_size=150) | st.lists(st.sampled_from([*"水位表压"]), max_size=150))
def test_windows_by_comparison_and_by_hash(parts):
    assert R._again(parts) == R._again_by_hash(parts)


def test_frames(spark):
    text = "alpha beta gamma delta epsilon zeta eta theta. " * 2
    df = spark.createDataFrame([(1, None, "c"), (2, "", "c"), (3, text, "c"), (3, text, "c"), (4, "x " * 200_000, "c")], "doc_id long, text string, letters string")
    out = sorted(map(tuple, R.shares(df, ["doc_id"]).collect()))
    assert out[0] == (1, 0, 0, 0.0) and out[1] == (2, 0, 0, 0.0) and out[2] == out[3] and out[2][3] == 0.5 and out[4][3] > 0.99
    assert R.shares(df.limit(0), ["doc_id"]).count() == 0
