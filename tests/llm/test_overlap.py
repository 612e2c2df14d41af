import hashlib
import random

from cadenza.llm.overlap import copy_pairs, cross_split_copies, cut, distance, edits_allowed, longest_partner, merged_length, near_texts, overlap_report, word_counts

SCHEMA = "row_id bigint, text string, split string, speaker string, key string, n int"


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_parts():
    rng = random.Random(1)
    for _ in range(500):
        a = [rng.choice("abc") for _ in range(rng.randint(1, 12))]
        b = [rng.choice("abc") for _ in range(rng.randint(1, 12))]
        where = {}
        for i, x in enumerate(a):
            where[x] = where.get(x, 0) | (1 << i)
        d = levenshtein(a, b)
        assert distance(where, len(a), b, 99) == d
        assert distance(where, len(a), b, 2) == (d if d <= 2 else None)
    assert edits_allowed(10, 0.2) == 2 and longest_partner(8, 0.2) == 10
    assert cut(8, 0.2) == [(0, 2), (2, 5), (5, 8)]
    assert merged_length([(0, 3), (2, 5), (7, 8)]) == 6


def test_pairs_by_brute_force(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(12)]
    texts = [[rng.choice(words) for _ in range(rng.randint(8, 26))] for _ in range(12)]
    rows = []
    for i in range(260):
        t = list(rng.choice(texts))
        for _ in range(rng.choice([0, 0, 1, 2, 4, 6])):
            k = rng.randrange(len(t))
            t[k : k + 1] = rng.choice([[], ["zz"], [t[k], "yy"]])
            t = t or ["q"]
        rows.append((i, ", ".join(t).title() if i % 3 else " ".join(t), rng.choice(["train", "test", "validation"]), rng.choice(["a", None])))
    listed = {r[0]: r[1].lower().replace(",", "").split() for r in rows}
    side = {r[0]: r[2] for r in rows}
    want = set()
    for i in listed:
        for j in listed:
            if side[i] == "train" != side[j] and min(len(listed[i]), len(listed[j])) >= 8:
                if levenshtein(listed[i], listed[j]) <= edits_allowed(max(len(listed[i]), len(listed[j])), 0.2):
                    want.add((min(i, j), max(i, j)))
    rows += [(900, None, "train", "a"), (901, "", "test", "a"), (None, rows[0][1], "train", "a"), (902, "w1 w2", "train", "a"), (903, rows[0][1], None, "a"), (904, rows[0][1], "odd", "a")]
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], SCHEMA)
    links, members = cross_split_copies(df, keep=["speaker"])
    got = [tuple(r) for r in copy_pairs(links, members, salt_rows=3).collect()]
    assert len(got) == len(set(got))
    assert set(got) == want
    report = overlap_report(links, members, "speaker").collect()
    assert sum(r["pairs"] for r in report) == len(want)
    assert sum(r["leaked_rows"] for r in report) == len({e for p in want for e in p if side[e] != "train"})
    links, members = cross_split_copies(df.limit(0))
    assert copy_pairs(links, members).count() == 0


def test_parts_of_large_buckets_give_the_same(spark):
    rng = random.Random(3)
    base = [[f"w{rng.randrange(15)}" for _ in range(rng.randint(8, 14))] for _ in range(10)]
    texts = set()
    for _ in range(120):
        t = list(rng.choice(base))
        t[rng.randrange(len(t))] = rng.choice(["a", "b", "w1"])
        texts.add(" ".join(t))
    rows = [(hashlib.md5(t.encode()).hexdigest(), t, len(t.split())) for t in sorted(texts)]
    both = [(k, False, x, n) for k, x, n in rows[::3]] + [(k, True, x, n) for k, x, n in rows[1::2]]
    df = spark.createDataFrame(both, "key string, is_train boolean, text string, n int")
    one, many = ({tuple(r) for r in near_texts(df, word_counts(df), **k).collect()} for k in ({}, {"shard_words": 40, "block_chars": 300}))
    assert one == many
    assert word_counts(df).sum() == sum(x[3] for x in both)
    listed = {k: x.split() for k, x, _ in rows}
    want = {(b[0], a[0]) for a in rows[::3] for b in rows[1::2] if levenshtein(listed[a[0]], listed[b[0]]) <= edits_allowed(max(a[2], b[2]), 0.2)}
    assert {x[:2] for x in one} == want
