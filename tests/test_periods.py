import random

import pytest

from cadenza.operators.periods import continuous_periods, silences

SCHEMA = "utt_id string, start_time double, end_time double, text string, key string, block int"


def brute(rows):
    out = []
    for u in {r[0] for r in rows if r[0] is not None}:
        ok = [(round(a * 1000), round(b * 1000)) for k, a, b in ((r[0], r[1], r[2]) for r in rows) if k == u and a is not None and b is not None and a == a and b == b and abs(b) < 1e9]
        ok = sorted(x for x in ok if x[1] > x[0])
        periods = []
        for a, b in ok:
            if periods and a <= periods[-1][1]:
                periods[-1][1] = max(periods[-1][1], b)
            else:
                periods.append([a, b])
        out += [(u, a, b) for a, b in periods]
    return sorted(out)


@pytest.mark.parametrize("block", [700, 5000, 300_000])
def test_periods_by_brute_force(spark, block):
    rng = random.Random(block)
    rows = []
    for i in range(300):
        a = rng.randint(-3000, 30_000) / 1000
        rows.append((f"u{i % 3}", a, a + rng.choice([0.0, -1.0, 0.25, 0.5, 3.0, 0.001]), "x", "k", 1))
    rows += [(None, 0.0, 1.0, "x", "k", 1), ("u0", None, 1.0, None, None, None), ("u1", float("nan"), 2.0, "", "", 0), ("u1", 1.0, float("inf"), "", "", 0)] + rows[:20]
    df = spark.createDataFrame(rows, SCHEMA)
    got = continuous_periods(df, block_ms=block).collect()
    assert sorted((r["utt_id"], r["start_ms"], r["end_ms"]) for r in got) == brute(rows)
    by = {(r["utt_id"], r["start_ms"]): r for r in got}
    for r in got:
        if r["next_start_ms"] is not None:
            assert r["gap_ms"] == r["next_start_ms"] - r["end_ms"] > 0
            assert (r["utt_id"], r["next_start_ms"]) in by
    want = sorted((r["utt_id"], r["end_ms"], r["next_start_ms"]) for r in got if r["gap_ms"] and r["gap_ms"] >= 1000)
    assert sorted(map(tuple, silences(df, block_ms=block).collect())) == want


def test_touching_and_empty(spark):
    df = spark.createDataFrame([("u", 0.0, 1.0, "", "", 0), ("u", 1.0, 2.0, "", "", 0), ("u", 3.0, 4.0, "", "", 0)], SCHEMA)
    assert sorted((r["start_ms"], r["end_ms"]) for r in continuous_periods(df).collect()) == [(0, 2000), (3000, 4000)]
    assert [tuple(r) for r in silences(df).collect()] == [("u", 2000, 3000)]
    assert continuous_periods(spark.createDataFrame([], SCHEMA)).count() == 0
