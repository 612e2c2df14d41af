import itertools
import random

import pytest

from cadenza.llm.groups import assign_splits, connected, flow_split, min_cost_flow, mixed_groups, related_groups, row_costs

SCHEMA = "row_id bigint, speaker string, id string, split string, group_id int, node string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)


def test_related_by_brute_force(spark):
    rng = random.Random(1)
    rows = []
    for i in range(120):
        s = rng.choice([None, "", " ", f"sp{rng.randint(0, 25)}", f"SP{rng.randint(0, 25)} "])
        rows.append((i, s, rng.choice([None, f"sp{rng.randint(0, 25)}_{rng.randint(0, 40)}", f"x{i}_{i}"]), rng.choice(["train", "test", None])))
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for r, s, i, _ in rows:
        s = (s or "").strip().lower() or (i.lower().split("_")[0] if i else None)
        for k in (("s", s) if s else None, ("i", i.lower()) if i else None):
            if k:
                a, b = find(("r", r)), find(k)
                if a != b:
                    parent[a] = b
    groups = {}
    for r, *_ in rows:
        groups.setdefault(find(("r", r)), []).append(r)
    want = {r: min(g) for g in groups.values() for r in g}
    df = frame(spark, rows)
    assert {r["row_id"]: r["group_id"] for r in related_groups(df).collect()} == want
    split = {r[0]: r[3] for r in rows}
    bad = sorted((r, min(g)) for g in groups.values() if len({split[r] for r in g}) > 1 for r in g)
    assert sorted(map(tuple, mixed_groups(df).collect())) == bad


def test_look_alike_speakers_and_repeats(spark):
    rows = [(1, "anna", "a_1", "train"), (2, "аnnа", "b_1", "test"), (2, "аnnа", "b_1", "test"), (3, None, "anna_9", "train"), (None, "anna", "q_1", "train"), (4, None, None, "train")]
    got = sorted(map(tuple, related_groups(frame(spark, rows)).collect()))
    assert got == [(1, 1), (2, 1), (2, 1), (3, 1), (4, 4)]
    assert related_groups(frame(spark, [])).count() == 0


def test_long_chain(spark):
    edges = spark.createDataFrame([(f"n{i:03d}", f"n{i + 1:03d}") for i in range(60)], "a string, b string")
    assert {r["root"] for r in connected(edges).collect()} == {"n000"}


def test_flow_is_cheapest():
    rng = random.Random(2)
    for _ in range(60):
        k = rng.choice([2, 3])
        bundles = [(1, tuple(rng.randint(0, 2) for _ in range(k + 1)), rng.randint(0, 4)) for _ in range(3)]
        supply = [n for _, _, n in bundles]
        costs = row_costs(bundles, ["a", "b", "c"][:k])
        total = sum(supply)
        cuts = sorted(rng.randint(0, total) for _ in range(k - 1))
        want = [float(y - x) for x, y in zip([0, *cuts], [*cuts, total])]
        f = min_cost_flow(supply, costs, want, 0.9)

        def price(x):
            return sum(x[i][s] * costs[i][s] for i in range(3) for s in range(k)) + sum(0.9 * max(0, sum(r[s] for r in x) - want[s]) for s in range(k))

        ways = [[c for c in itertools.product(range(n + 1), repeat=k) if sum(c) == n] for n in supply]
        best = min(price(x) for x in itertools.product(*ways))
        assert all(sum(row) == pytest.approx(n) for row, n in zip(f, supply))
        assert price(f) == pytest.approx(best)


def test_rounding_keeps_components():
    names = {"train": 0.8, "test": 0.1, "validation": 0.1}  # profiles in the order test, train, validation, others
    bundles = [(7, (0, 7, 0, 0), 3), (5, (5, 0, 0, 0), 4), (5, (2, 3, 0, 0), 2), (1, (0, 0, 0, 1), 30)]
    put = flow_split(bundles, names)
    assert all(sum(row) == n for row, (_, _, n) in zip(put, bundles))
    have = [sum(row[s] * b[0] for row, b in zip(put, bundles)) for s in range(3)]
    assert abs(have[1] - 0.8 * 81) <= 5 and put[0] == [0, 3, 0]
    # a component mixed of both labels costs less in train, where most of its rows are, than a pure one of test
    assert put[2][1] == 2


def test_many_bundles_are_quick():
    rng = random.Random(5)
    bundles = sorted({(a + b + c + d, (a, b, c, d), rng.randint(1, 9)) for a, b, c, d in ((rng.randint(0, 9), rng.randint(0, 30), rng.randint(0, 9), rng.randint(0, 3)) for _ in range(6000)) if a + b + c + d})
    put = flow_split(bundles, {"train": 0.8, "test": 0.1, "validation": 0.1})
    rows = sum(s * n for s, _, n in bundles)
    have = [sum(row[s] * b[0] for row, b in zip(put, bundles)) for s in range(3)]
    assert sum(have) == rows and abs(have[1] - 0.8 * rows) < 50 and abs(have[0] - 0.1 * rows) < 50


def test_assigned_splits(spark):
    rng = random.Random(3)
    rows = [(i, f"s{rng.randint(0, 60)}", f"u_{i}", rng.choice(["train", "test", "validation", "odd", None])) for i in range(900)]
    targets = spark.createDataFrame([("train", 0.8), ("test", 0.1), ("validation", 0.1), (None, 0.5), ("none", 0.0)], "split string, share double")
    got = assign_splits(frame(spark, rows), targets).collect()
    assert sorted(r["row_id"] for r in got) == list(range(900))
    assert len({(r["group_id"], r["new_split"]) for r in got}) == len({r["group_id"] for r in got})
    share = sum(r["new_split"] == "train" for r in got) / 900
    assert abs(share - 0.8) < 0.02
    assert assign_splits(frame(spark, []), targets).count() == 0
    with pytest.raises(ValueError):
        assign_splits(frame(spark, rows), targets.filter("share > 2"))
