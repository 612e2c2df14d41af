import random
from itertools import product

import numpy as np
import pytest

from cadenza.llm.packing import best_fit_decreasing, byte_cuts, lower_bound, pack_documents, packing_report

SCHEMA = "doc_id bigint, text string, container string, piece string, size int, id int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c", "p", 1, 2) for r in rows], SCHEMA)


def optimum(sizes, capacity):
    for n in range(1, len(sizes) + 1):
        for where in product(range(n), repeat=len(sizes)):
            if max(np.bincount(where, weights=sizes)) <= capacity:
                return n
    return 0


def test_bound_and_packing():
    rng = random.Random(1)
    for _ in range(60):
        sizes = [rng.randint(1, 10) for _ in range(rng.randint(1, 6))]
        best = optimum(sizes, 10)
        bins = best_fit_decreasing(np.array(sizes), 10)
        assert lower_bound(np.array(sizes), 10) <= best <= bins.max() + 1
        assert max(np.bincount(bins, weights=sizes)) <= 10
    assert lower_bound(np.array([6, 6, 6]), 10) == 3
    assert lower_bound(np.array([], dtype=int), 10) == 0


@pytest.mark.parametrize("part", [7, 50_000])
def test_documents(spark, part):
    rng = random.Random(part)
    alphabet = "abcé漢😀 "
    rows = [(i, "".join(rng.choice(alphabet) for _ in range(rng.choice([1, 5, 30, 63, 64, 200])))) for i in range(80)]
    rows += [(100, None), (101, ""), (102, " \t"), (None, "x"), (103, "a" * 63), (104, "a" * 64), (105, "é" * 500), (103, "a" * 63)]
    got = pack_documents(frame(spark, rows), capacity=64, partition_items=part).collect()
    report = packing_report(pack_documents(frame(spark, rows), capacity=64, partition_items=part), 64).collect()[0]
    assert report["containers"] == len({r["container"] for r in got}) >= report["bound"] and report["gap"] == report["containers"] - report["bound"]
    assert report["items"] == len(got) and report["tokens"] == sum(r["n_tokens"] for r in got)
    used, by = {}, {}
    for r in got:
        used[r["container"]] = used.get(r["container"], 0) + r["n_tokens"]
        by.setdefault(r["doc_id"], []).append(r)
    assert max(used.values()) <= 64
    texts = {i: t for i, t in rows if i is not None and t and t.strip()}
    assert set(by) == set(texts)
    for i, t in texts.items():
        raw = t.encode()
        pieces = sorted(by[i], key=lambda r: r["piece"])
        if i == 103:
            assert [r["n_tokens"] for r in pieces] == [64, 64]
            continue
        assert "".join(raw[r["byte_at"] : r["byte_at"] + r["byte_length"]].decode() for r in pieces) == t
        assert sum(r["n_tokens"] for r in pieces) == len(raw) + 1
        assert (len(pieces) > 1) == (len(raw) + 1 > 64)


def test_empty(spark):
    assert pack_documents(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        pack_documents(frame(spark, []), capacity=4)


def test_cuts_are_as_few_as_can_be():
    assert byte_cuts(b"a" * 63, 64) == [] and byte_cuts(b"a" * 64, 64) == [64] and byte_cuts(b"a" * 128, 64) == [64, 128]
    rng = random.Random(4)
    for _ in range(200):
        text = "".join(rng.choice("aé漢😀") for _ in range(rng.randint(0, 60)))
        raw = text.encode()
        cuts = byte_cuts(raw, 16)
        marks = [0, *cuts, len(raw)]
        pieces = [raw[a:b] for a, b in zip(marks, marks[1:])]
        assert "".join(p.decode() for p in pieces) == text and max(map(len, pieces)) <= 16 and len(pieces[-1]) < 16
        borders = [0]
        for c in text:
            borders.append(borders[-1] + len(c.encode()))
        fewest = {0: 0}
        for b in borders[1:]:
            fewest[b] = min(fewest[a] + 1 for a in borders if a in fewest and 0 < b - a <= 16)
        last = min(fewest[a] + 1 for a in borders if a in fewest and len(raw) - a < 16)
        assert len(pieces) == last


def test_uncertified_partitions_exchange(spark):
    sizes = [34, 34, 34, 32, 32, 32, 21, 21, 21, 20, 20, 20] * 4
    df = frame(spark, [(i, "x" * (s - 1)) for i, s in enumerate(sizes)])
    got = pack_documents(df, capacity=64, partition_items=5)
    report = packing_report(got, 64).collect()[0]
    whole = packing_report(pack_documents(df, capacity=64), 64).collect()[0]
    assert report["items"] == len(sizes) and whole["containers"] <= report["containers"] <= whole["containers"] + 6
    assert report["bound"] == whole["bound"]
