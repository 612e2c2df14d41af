from cadenza.operators.skew import fits, hot_keys, join_hot, join_lookup


def test_join_with_hot_keys(spark):
    left = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(300)] + [(999, None)], "rid int, key string")
    right = spark.createDataFrame([("hot", 1), ("k0", 2), ("k3", 3), ("other", 4)], "key string, salts int")  # a column of that name stays
    assert hot_keys(left, ["key"]) is None
    assert [tuple(r) for r in hot_keys(left, ["key"], rows=50).collect()] == [("hot", 4)]
    for how in ("inner", "left"):
        want = sorted(map(str, left.join(right, ["key"], how).collect()))
        assert sorted(map(str, join_hot(left, right, ["key"], left.rid, how, rows=50).collect())) == want
        assert sorted(map(str, join_hot(left, right, ["key"], left.rid, how).collect())) == want
    assert join_hot(left.limit(0), right, ["key"], left.rid).count() == 0


def test_lookup_by_size(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "rid int, key string")
    right = spark.createDataFrame([("a", "x" * 1000, [1, 2])], "key string, v string, w array<int>")
    assert fits(right) and not fits(right, 500) and fits(right.limit(0), 0)
    for limit in (0, 10_000):
        assert sorted((r.rid, r.w) for r in join_lookup(left, right, ["key"], left.rid, "left", limit).collect()) == [(1, [1, 2]), (2, None), (3, None)]
