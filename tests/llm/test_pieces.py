import random

import numpy as np
import pytest

from cadenza.llm.pieces import pack_chapter, split_recordings

SCHEMA = "utt_id string, pos int, text string, start_time double, end_time double, key string, piece int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", 1) for r in rows], SCHEMA)


def test_pack_keeps_the_limit_and_cuts_in_pauses():
    rng = random.Random(1)
    for _ in range(200):
        s, e, t = [], [], 0
        for _ in range(rng.randint(1, 60)):
            t += rng.choice([0, 0, 20, 300, 1500])
            d = rng.choice([100, 400, 900])
            s.append(t)
            e.append(t + d)
            t += d
        cuts = pack_chapter(np.array(s), np.array(e), s[0], e[-1], 5000)
        marks = [s[0], *cuts, e[-1]]
        assert all(0 < b - a <= 5000 for a, b in zip(marks, marks[1:], strict=False)) or marks == [s[0], e[-1]]
        for c in cuts:  # no stretch is longer than the limit without a pause, so no word is cut
            assert not any(a < c < b for a, b in zip(s, e, strict=True))


def test_pack_without_pauses():
    assert pack_chapter(np.array([0]), np.array([10_000]), 0, 10_000, 4000) == [3333, 6666]
    s = np.arange(0, 10_000, 500)
    assert all(c % 500 == 0 for c in pack_chapter(s, s + 700, 0, 10_200, 4000))
    assert pack_chapter(np.array([], dtype=int), np.array([], dtype=int), 0, 10, 20) == []


@pytest.mark.parametrize("chapter", [30_000, 60_000, 600_000])
def test_recordings_by_brute_force(spark, chapter):
    rng = random.Random(chapter)
    rows = []
    for u in range(4):
        t = rng.randint(-2000, 4000)
        for i in range(rng.choice([3, 40, 400])):
            t += rng.choice([0, 10, 200, 700, 2500])
            d = rng.choice([100, 300, 800, 8000 if i % 50 == 7 else 100])
            rows.append((f"u{u}", i, rng.choice(["w", " x ", "", None, "yé"]), t / 1000, (t + d) / 1000))
            t += rng.choice([d, d // 2])
    rows += rows[:10] + [(None, 1, "n", 0.0, 1.0), ("u0", 1, "n", None, 1.0), ("u1", 1, "n", 5.0, 5.0), ("u1", 1, "n", 5.0, 4.0), ("z", 0, "only", float("nan"), 2.0)]
    got = split_recordings(frame(spark, rows), chapter_ms=chapter).collect()
    ok = {}
    for k, p, t, a, b in rows:
        if k and a is not None and b is not None and a == a and round(b * 1000) > round(a * 1000):
            ok.setdefault(k, set()).add((round(a * 1000), round(b * 1000), p, (t or "").strip()))
    assert {r["utt_id"] for r in got} == set(ok)
    for k, items in ok.items():
        mine = sorted((r for r in got if r["utt_id"] == k), key=lambda r: r["end_ms"])
        lo, hi = min(i[0] for i in items), max(i[1] for i in items)
        assert mine[0]["start_ms"] == lo and mine[-1]["end_ms"] == hi
        assert {r["oversized"] for r in mine} == {hi - lo > 30_000}
        for r in mine:
            assert r["end_ms"] - r["start_ms"] <= 30_000
            said = " ".join(t for a, _, _, t in sorted(items) if r["start_ms"] <= a < r["end_ms"] and t)
            assert r["text"] == said
        for a, b in zip(mine, mine[1:], strict=False):
            assert a["end_ms"] - b["start_ms"] == 2000 or b["start_ms"] == lo


def test_empty_and_bad_parameters(spark):
    assert split_recordings(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        split_recordings(frame(spark, []), limit_s=1.0, overlap_s=2.0)
