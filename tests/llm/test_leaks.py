import random

import pytest

from cadenza.llm.leaks import Matcher, find_leaks, myers, piece_words, word_list

SCHEMA = "doc_id bigint, text string, id int, item int, run_words int"
ITEMS = "item_id bigint, text string, id int"


def semi_global(p, t):
    row = [0] * (len(t) + 1)
    for i, x in enumerate(p, 1):
        new = [i]
        for j, y in enumerate(t, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_myers():
    rng = random.Random(1)
    for _ in range(500):
        p = [rng.choice("abc") for _ in range(rng.randint(0, 12))]
        t = [rng.choice("abc") for _ in range(rng.randint(0, 16))]
        assert myers(p, t, 99) == semi_global(p, t)
        want = semi_global(p, t)
        assert myers(p, t, 2) == (want if want <= 2 else None)


def test_matcher_by_brute_force():
    rng = random.Random(2)
    for errors in (0, 1):
        for _ in range(60):
            items = [(i, [rng.choice("abcdefgh") for _ in range(rng.randint(8, 20))]) for i in range(3)]
            doc = [rng.choice("abcdefgh") for _ in range(30)]
            w = items[0][1]
            a = rng.randint(0, len(w) - 8)
            passage = w[a : a + 8]
            if rng.random() < 0.5:
                passage[rng.randint(0, 7)] = "z"
            doc[10:10] = passage
            got = Matcher(items, 8, errors).find(doc)
            for k, (_, v) in enumerate(items):
                exact = any(v[x : x + 8] == doc[y : y + 8] for x in range(len(v) - 7) for y in range(len(doc) - 7))
                near = any(semi_global(v[x : x + 8], doc) <= errors for x in range(len(v) - 7))
                assert (k in got and got[k][0] >= 8) == exact
                assert (k in got) == near


def test_documents(spark):
    w = [f"w{i}" for i in range(30)]
    items = spark.createDataFrame([(1, " ".join(w), 0), (2, "short one", 0), (3, None, 0), (None, " ".join(w), 0), (1, " ".join(w), 0)], ITEMS)
    docs = [(1, "x " + ", ".join(w[3:15]).upper() + "! y"), (2, " ".join(w[3:14])), (3, None), (4, ""), (5, " ".join([*w[3:9], "zz", *w[9:16]])), (6, " ".join(w[:12]).replace("w1 ", "ｗ1​ ")), (None, " ".join(w)), (1, " ".join(w)), (7, "q " * 60_000 + " ".join(w))]
    df = spark.createDataFrame([(*d, 1, 2, 3) for d in docs], SCHEMA)
    for chars in (10, 10_000):
        got = {(r["doc_id"], r["item_id"]): (r["run_words"], r["edits"]) for r in find_leaks(df, items, shard_chars=chars).collect()}
        assert {k for k, v in got.items() if v[0] >= 12} == {(1, 1), (6, 1), (7, 1)}
        assert got[(1, 1)] == (30, 0)
        assert got[(2, 1)][1] == got[(5, 1)][1] == 1
    assert find_leaks(df.limit(0), items).count() == 0
    assert find_leaks(df, items.limit(0)).count() == 0
    with pytest.raises(ValueError):
        find_leaks(df, items, min_words=1, max_errors=1)
    assert piece_words(12, 0) == 6 and word_list("Ａb, cаt", {"cat"}) == ["ab", "cat"]


def test_damaged_items_by_the_documents_words(spark):
    w = "while the river flows under every bridge near some little town today".split()
    item = " ".join(w).replace("river", "rіver")
    items = spark.createDataFrame([(1, item, 0)], ITEMS)
    docs = [(1, " ".join(w)), (2, " ".join(w).replace("town", "tоwn")), (3, "nothing")]
    got = find_leaks(spark.createDataFrame([(*d, 1, 2, 3) for d in docs], SCHEMA), items, max_errors=0).collect()
    assert {r["doc_id"] for r in got} == {1, 2}
