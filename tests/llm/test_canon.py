"""The consistent form: what becomes equal, what stays different, and that splicing changes nothing else."""

import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folioloom.llm import canon as K


@pytest.mark.parametrize(
    ("written", "form"),
    [
        ("Ｍｅｔｈｏｄｓ", "Methods"),
        ("\U0001d681\U0001d68e\U0001d69c", "Res"),
        ("Résumé", "Résumé"),
        ("Long‑term", "Long-term"),
        ("it’s", "it's"),
        ("Co­st​ o﻿ver⁠view᠎", "Cost overview"),
        ("a b c　d", "a b c d"),
        ("ﬁnal oﬃce Ⅳ", "final office IV"),
        ("⽅法 ⻋辆", "方法 车辆"),
        ("Sсοpe", "Scope"),
        ("Donnе́es", "Données"),
        ("Cостав", "Состав"),
        ("高程 А3 表", "高程 A3 表"),
        ("Coefficient а for", "Coefficient a for"),
    ],
)
def test_becomes_equal(written, form):
    assert K.canonical(written) == form and K.canonical(form) == form


@pytest.mark.parametrize("text", ["m²", "H₂O", "½", "№ 5 ©", "Coefficient α", "Größe", "состав оса", "расчёт", "– и —", "a  b", "👩‍🔬 ok", "می‌خواهم", "", "plain"])
def test_stays(text):
    assert K.canonical(text) == unicodedata.normalize("NFC", text)


def test_keys():
    assert K.key(" Long–term\toutlook ") == "Long-term outlook"
    assert K.key("ЅСОРЕ") == "SCOPE" and K.canonical("ЅСОРЕ") == "ЅСОРЕ"
    assert len({K.key(x) for x in ("Pêche", "Péché", "Peche", "Scope", "SCOPE", "m2", "m²")}) == 7


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab é́̈ñ한각\nÅ가.,"), max_size=60))
def test_splicing_equals_normalising_the_whole(text):
    assert K.canonical(text) == unicodedata.normalize("NFC", text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_twice_is_once(text):
    once = K.canonical(text)
    assert K.canonical(once) == once


def test_frames(spark):
    blocks = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "Ｓcope", "x"), (3, "Ｓcope", "x"), (4, "Scope", "x"), (5, " ", "x"), (6, "Sсope" * 50_000, "x")], "block_id long, content string, key string")
    terms = spark.createDataFrame([(5, "Scope", "en"), (6, "SCOPE", "en"), (7, "Scope", "de"), (8, None, None)], "term_id int, term string, lang string")
    assert sorted(map(tuple, K.same_reading(blocks, terms).collect())) == [(3, 5), (3, 7)]
    got = sorted((r.block_id, r.canonical, r.changed) for r in K.canonical_texts(blocks.where("block_id < 6"), ["block_id"]).collect() if r.canonical is not None)
    assert got == [(2, "", False), (3, "Scope", True), (3, "Scope", True), (4, "Scope", False), (5, " ", False)]
    assert K.same_reading(blocks.limit(0), terms).count() == 0 == K.same_reading(blocks, terms.limit(0)).count()


def test_look_alikes_of_rarer_scripts():
    assert K.canonical("mеthοd Sсοpe ρlan ꓢcope Ꮯost хⲟr Ꭺnnex օpen") == "method Scope plan Scope Cost xor Annex open"
    # signs and words of their own script stay
    for text in ("ρ = 3 and α < ι", "ꓢꓚꓳꓑꓰ", "ᎠᎢ", "Coefficient α for channels"):
        assert K.canonical(text) == text
    assert K.key("ꓢꓚꓳꓑꓰ") == "SCOPE" and K.key("Coefficient α") != K.key("Coefficient a")
