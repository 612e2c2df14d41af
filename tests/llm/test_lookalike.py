from collections import Counter

import pytest

from cadenza.llm.lookalike import convert, look_alike_classes, look_alike_pairs, plain_form, suspects, unify, unify_local

SCHEMA = "row_id bigint, text string, base string, form string, token string, rid int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "b", "f", "t", 1) for r in rows], SCHEMA)


def test_plain_form():
    assert plain_form("ｔｈｅ　Ｃａｔ！") == "the Cat!"
    assert plain_form("café ​ze\xadro x\tz\ny") == "café zero x z\ny"
    assert plain_form("") == ""


@pytest.mark.parametrize(("text", "want"), [
    ("the саt sаt", "the cat sat"), ("кот и кoт", "кот и кот"), ("Мы сор", "Мы сор"), ("οver the hill", "over the hill"), ("а cat", "a cat"), ("Α cat", "A cat"), ("ёлка", "ёлка"), ("Вuсkеtlеѕѕ", "Вuсkеtlеѕѕ"),
    ("он c ней", "он с ней"), ("λόγος", "λόγος"), ("αO bond, the αx value, νCO band", "αO bond, the αx value, νCO band"), ("ΔH and ΔS", "ΔH and ΔS"), ("un сhа̂teаu", "un château"),
])
def test_unify_local(text, want):
    vocabulary = {"a", "the", "cat", "sat", "over", "с", "кот", "château"}
    assert unify_local(text, vocabulary) == want


def test_convert_and_suspects():
    assert convert("ё", "LATIN") == "ë"
    assert convert("ж", "LATIN") is None
    assert convert("cop", "CYRILLIC") == "сор"
    assert suspects("plain") == []
    assert suspects("мама мыла раму") == []


def test_unify_rows(spark):
    rows = [(1, "the cat"), (2, "the саt"), (3, None), (4, ""), (5, "   "), (6, "кот"), (2, "the саt"), (7, "x" * 50_000 + "é"), (8, "a mаt"), (12, "a mat"), (9, "сор is here"), (10, "cop")]
    got = unify(frame(spark, rows), {"text": "out"}).select("row_id", "out", "base", "rid").collect()
    assert Counter(r["row_id"] for r in got) == Counter(r[0] for r in rows)
    by = {r["row_id"]: r["out"] for r in got}
    assert by == {1: "the cat", 2: "the cat", 3: None, 4: "", 5: "   ", 6: "кот", 7: "x" * 50_000 + "é", 8: "a mat", 12: "a mat", 9: "cop is here", 10: "cop"}
    assert {r["base"] for r in got} == {"b"}
    assert unify(frame(spark, []), {"text": "text"}).count() == 0


def test_pairs(spark):
    rows = [(1, "the cat"), (2, "the саt"), (3, "the сat"), (4, "The cat"), (5, None), (6, " "), (7, " "), (8, "the cat"), (9, "the cat!"), (10, "thé cat"), (11, "the cat")]
    want = {(1, 2), (1, 3), (2, 3), (2, 8), (3, 8), (1, 11), (2, 11), (3, 11), (8, 11)}
    for salt in (1, 20_000):
        got = [tuple(r) for r in look_alike_pairs(frame(spark, rows), "row_id", "text", salt_rows=salt).collect()]
        assert len(got) == len(set(got))
        assert set(got) == want


def test_accents_on_look_alikes_and_two_damaged_copies(spark):
    rows = [(1, "un château"), (2, "un сhа̂teаu"), (3, "a mіllwheel"), (4, "a mіllwhееl"), (5, "the αO bond"), (6, "the aO bond"), (7, "a lоnely"), (8, "ΔH and ΔS")]
    got = {r["row_id"]: r["out"] for r in unify(frame(spark, rows), {"text": "out"}).collect()}
    assert got[2] == "un château" and got[3] == got[4] == "a millwheel"
    assert got[5] == "the aO bond"  # the word is there in Latin letters, so it is a look-alike
    assert got[7] == "a lоnely" and got[8] == "ΔH and ΔS"
    assert sorted(map(tuple, look_alike_pairs(frame(spark, rows), "row_id", "text").collect())) == [(1, 2), (3, 4), (5, 6)]


def test_classes(spark):
    rows = [(1, "the cat"), (2, "the саt"), (3, "The cat"), (4, None), (5, " "), (6, "the cat"), (7, "dog"), (None, "the cat")]
    got = sorted(map(tuple, look_alike_classes(frame(spark, rows), "row_id", "text").collect()))
    assert got == [(1, 1, 2, 3), (2, 1, 2, 3), (6, 1, 2, 3)]
    assert look_alike_classes(frame(spark, []), "row_id", "text").count() == 0
