"""Splits that keep related records together (problem 5).

Rows tied by a speaker or an id are one component. Each row has exactly one speaker key, so components are built
over speaker keys alone: an id shared by several speakers links them, and an id of one speaker links nothing. That
keeps stars of a hot speaker out of the graph; labels spread over the few links by minimum and by jumping pointers.
The split of each component comes from a min-cost flow: components of the same size and label profile (how many rows
have which label now) are one bundle. A unit of flow is a row; in a split it costs the share of its component's rows that
have another label now, and rows beyond what a split wants cost for their deviation. Flow is rounded to whole components,
and members of a bundle take their splits in hash order.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..operators.skew import join_hot, join_lookup
from ..runtime import materialize
from .lookalike import unify

_STRIP = r"^\s+|\s+$"


def _key(column: str) -> F.Column:
    """Case and outer white space aside; an empty key counts as missing."""
    k = F.lower(F.regexp_replace(column, _STRIP, ""))
    return F.when(k != "", k)


def _consistent(rows: DataFrame) -> DataFrame:
    """``rows`` with the columns ``s`` and ``i`` in the consistent form: only distinct values that aren't ASCII are unified, once
    for both columns, and what changes is looked up."""
    each = rows.select(F.explode(F.array("s", "i")).alias("v")).filter("v is not null")
    plain = F.octet_length("v") == F.char_length("v")
    words = each.filter(plain).select(F.explode(F.split(F.lower("v"), "[^a-z0-9]+")).alias("word")).filter("word <> ''")
    forms = unify(materialize(each.filter(~plain).distinct()), {"v": "form"}, vocabulary=words)
    changed = materialize(forms.filter("form <> v"))
    for c in ("s", "i"):
        found = changed.select(F.col("v").alias(c), F.col("form").alias("__form"))
        rows = join_lookup(rows, found, [c], F.col("rid"), "left").withColumn(c, F.translate(F.coalesce("__form", c), "\t\x0b\x0c", "   ")).drop("__form")
    return rows


def connected(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for links ``(a, b)``: the smallest node of each component. Minimum label of the neighbours and a
    pointer jump per round, each round written to the shared folder, until no label changes."""
    both = materialize(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct())
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root")))
    while True:
        near = both.join(labels, both.b == labels.node).groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        stepped = labels.join(near, "node").select("node", F.least("root", "near").alias("step"), F.col("root").alias("was"))
        jump = labels.select(F.col("node").alias("step"), F.col("root").alias("far"))
        after = materialize(stepped.join(jump, "step", "left").select("node", F.least(F.col("step"), F.coalesce("far", "step")).alias("root"), "was"))
        changed = after.filter("root <> was").limit(1).count()
        labels = after.select("node", "root")
        if not changed:
            return labels


def related_groups(df: DataFrame, row_id: str = "row_id", speaker: str = "speaker", record_id: str = "id", keep: list[str] | None = None) -> DataFrame:
    """``(row_id, group_id, *keep)``: rows with the same speaker or the same id are in one group, also through further
    rows; ``group_id`` is the smallest ``row_id`` of the group.

    Speakers and ids compare in the consistent form, without regard to case and outer white space. A null or blank
    speaker is the part of the id before its first ``_``; a row with neither speaker nor id is a group of its own.
    A row without ``row_id`` can't be named and is left out; repeated rows come out as often as they come in.
    """
    keep = keep or []
    rows = df.select(F.col(row_id).alias("rid"), F.col(speaker).cast("string").alias("s"), F.col(record_id).cast("string").alias("i"), *[F.col(c).alias(f"keep_{c}") for c in keep])
    rows = _consistent(rows.filter("rid is not null"))
    ident = _key("i")
    rows = rows.select(
        "rid",
        F.coalesce(F.concat(F.lit("s:"), F.coalesce(_key("s"), F.substring_index(ident, "_", 1))), F.concat(F.lit("r:"), F.col("rid").cast("string"))).alias("node"),
        ident.alias("ident"),
        *[f"keep_{c}" for c in keep],
    )
    rows = materialize(rows)
    pairs = rows.filter("ident is not null").groupBy("ident", "node").agg(F.count(F.lit(1)).alias("n"))
    least = pairs.groupBy("ident").agg(F.min("node").alias("a"), F.max("node").alias("z")).filter("a <> z").select("ident", "a")
    links = pairs.join(least, "ident").filter("node <> a").select("a", F.col("node").alias("b"))
    roots = connected(links)
    nodes = rows.groupBy("node").agg(F.min("rid").alias("first"))
    nodes = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    group = nodes.groupBy("root").agg(F.min("first").alias("group_id"))
    named = materialize(nodes.join(group, "root").select("node", "group_id"))
    return join_hot(rows, named, ["node"], F.col("rid")).select(F.col("rid").alias(row_id), "group_id", *[F.col(f"keep_{c}").alias(c) for c in keep])


def mixed_groups(df: DataFrame, row_id: str = "row_id", speaker: str = "speaker", record_id: str = "id", split: str = "split") -> DataFrame:
    """``(row_id, group_id)`` of the groups whose present split isn't the same for all rows (a null one is a value)."""
    g = materialize(related_groups(df, row_id, speaker, record_id, [split]))
    text = F.coalesce(F.col(split).cast("string"), F.lit("\x00"))
    bad = g.groupBy("group_id").agg(F.min(text).alias("lo"), F.max(text).alias("hi")).filter("lo <> hi").select("group_id")
    return join_hot(g, materialize(bad), ["group_id"], F.col(row_id)).select(row_id, "group_id")


Bundle = tuple[int, tuple[int, ...], int]


def row_costs(bundles: list[Bundle], names: list[str]) -> list[list[float]]:
    """What a row of each bundle ``(size, profile, count)`` costs in each split: the share of the component's rows that have
    another label now. A profile has a number for each split and one for all other labels, which are free to go anywhere."""
    out = []
    for _, profile, _ in bundles:
        total = sum(profile) or 1
        out.append([(total - profile[-1] - profile[k]) / total for k in range(len(names))])
    return out


def min_cost_flow(supply: list[int], costs: list[list[float]], want: list[float], deviation: float) -> list[list[float]]:
    """Rows of each bundle for each split at the least total cost, ``deviation`` being the cost of a row beyond what a split
    wants. All rows start where they cost least; then successive shortest paths over the splits move rows from those
    above what they want to those below, along the cheapest moves there are, until a path costs more than it saves."""
    k = len(want)
    flow = [[0.0] * k for _ in supply]
    have = [0.0] * k
    moves: dict[tuple[int, int], list[tuple[float, int]]] = {(a, b): [] for a in range(k) for b in range(k) if a != b}

    def add(i: int, a: int) -> None:
        for b in range(k):
            if b != a:
                heapq.heappush(moves[a, b], (costs[i][b] - costs[i][a], i))

    for i, rows in enumerate(supply):
        a = min(range(k), key=lambda s: (costs[i][s], -want[s], s))
        flow[i][a] = float(rows)
        have[a] += rows
        add(i, a)

    def cheapest(a: int, b: int) -> tuple[float, int] | None:
        heap = moves[a, b]
        while heap and flow[heap[0][1]][a] <= 1e-6:
            heapq.heappop(heap)
        return heap[0] if heap else None

    while True:
        over, under = [s for s in range(k) if have[s] > want[s] + 1e-6], {s for s in range(k) if have[s] < want[s] - 1e-6}
        best: tuple[float, list[int]] | None = None
        for source in over:
            dist, by = {source: 0.0}, {}
            for _ in range(k):  # Bellman-Ford over the splits, which are few
                for a, b in moves:
                    if a in dist and (m := cheapest(a, b)) and dist[a] + m[0] < dist.get(b, float("inf")) - 1e-9:
                        dist[b], by[b] = dist[a] + m[0], a
            for sink in under & set(dist):
                path = [sink]
                while path[-1] != source:
                    path.append(by[path[-1]])
                if best is None or dist[sink] < best[0] - 1e-12:
                    best = (dist[sink], path[::-1])
        if best is None or best[0] >= deviation:
            return flow
        path = best[1]
        steps = [(a, b, cheapest(a, b)[1]) for a, b in zip(path, path[1:], strict=False)]
        push = min(have[path[0]] - want[path[0]], want[path[-1]] - have[path[-1]], *(flow[i][a] for a, _, i in steps))
        for a, b, i in steps:
            flow[i][a] -= push
            flow[i][b] += push
            add(i, b)
        have[path[0]] -= push
        have[path[-1]] += push


def flow_split(bundles: list[Bundle], shares: dict[str, float], deviation: float = 4.0) -> list[list[int]]:
    """Components of each bundle ``(size, profile, count)`` for each split in the order of names: the min-cost flow of rows,
    rounded to whole components, the largest first, then moves of components between two splits as long as one lowers the
    total cost."""
    names = sorted(shares)
    k = len(names)
    total = sum(size * n for size, _, n in bundles)
    scale = sum(shares.values())
    want = [total * shares[s] / scale for s in names]
    costs = row_costs(bundles, names)
    flow = min_cost_flow([size * n for size, _, n in bundles], costs, want, deviation)
    put = [[0] * k for _ in bundles]
    have = [0.0] * k
    owed = [sum(f[s] for f in flow) for s in range(k)]
    for i in sorted(range(len(bundles)), key=lambda i: (-bundles[i][0], bundles[i][1])):
        size, _, n = bundles[i]
        whole = [int((flow[i][s] + 1e-6) // size) for s in range(k)]
        for _ in range(n - sum(whole)):
            s = max(range(k), key=lambda s: (flow[i][s] - whole[s] * size, owed[s] - have[s], -s))
            whole[s] += 1
        put[i] = whole
        for s in range(k):
            have[s] += whole[s] * size
    gap = lambda s, h: deviation * abs(h - want[s])

    def best_move() -> tuple | None:
        best = None
        for a in range(k):
            for b in range(k):
                if a == b:
                    continue
                for i, (size, _, _) in enumerate(bundles):
                    if not put[i][a]:
                        continue
                    n = max(1, min(put[i][a], int(min(have[a] - want[a], want[b] - have[b]) // size)))
                    gain = gap(a, have[a]) + gap(b, have[b]) - gap(a, have[a] - size * n) - gap(b, have[b] + size * n) - size * n * (costs[i][b] - costs[i][a])
                    if gain > 1e-6 and (best is None or (gain, size) > (best[0], bundles[best[3]][0])):
                        best = (gain, a, b, i, n)
        return best

    while (m := best_move()) is not None:
        _, a, b, i, n = m
        put[i][a] -= n
        put[i][b] += n
        have[a] -= bundles[i][0] * n
        have[b] += bundles[i][0] * n
    return put


#: Profiles of larger components are told in sixteenths of their rows.
EXACT_PROFILE = 64


def assign_splits(df: DataFrame, targets: DataFrame, row_id: str = "row_id", speaker: str = "speaker", record_id: str = "id", split: str = "split", deviation: float = 4.0) -> DataFrame:
    """``(row_id, group_id, new_split)`` for every row, whole groups together, close to the shares in ``targets``
    (``split``, ``share``; null or non-positive shares don't count).

    Only the bundles' counts reach the driver: one per size and label profile that is there. Components of N rows have
    fewer than sqrt(2N) different sizes; up to 64 rows their profiles are exact, beyond in sixteenths, so a size has less
    than a thousand of them with three splits, and all have no more than there are components of different make. Ranks within
    a bundle come from counts by hash bucket, so no task holds a whole bundle. No usable target is an error; an empty table
    gives an empty result.
    """
    shares = {r["split"]: float(r["share"]) for r in targets.filter("share > 0 and split is not null").groupBy("split").agg(F.max("share").alias("share")).collect()}
    if not shares:
        raise ValueError("targets has no split with a positive share")
    names = sorted(shares)
    g = materialize(related_groups(df, row_id, speaker, record_id, [split]))
    size = F.count(F.lit(1))
    label = F.col(split).cast("string")
    held = [F.count(F.when(label == s, 1)) for s in names]
    parts = g.groupBy("group_id").agg(size.alias("size"), F.array(*held).alias("held"))
    rest = F.col("size") - F.aggregate("held", F.lit(0).cast("bigint"), lambda a, x: a + x)
    told = F.transform(F.concat("held", F.array(rest)), lambda x: F.when(F.col("size") <= EXACT_PROFILE, x).otherwise(F.round(x * 16 / F.col("size"))).cast("bigint"))
    parts = materialize(parts.select("group_id", "size", F.array_join(told.cast("array<string>"), ",").alias("profile")))
    counted = [(r["size"], r["profile"], r["n"]) for r in parts.groupBy("size", "profile").agg(size.alias("n")).collect()]
    if not counted:
        return g.select(row_id, "group_id", F.lit(None).cast("string").alias("new_split")).limit(0)
    put = flow_split([(s, tuple(int(x) for x in p.split(",")), n) for s, p, n in counted], shares, deviation)
    runs = []
    for (s, p, _), row in zip(counted, put, strict=True):
        at = 0
        for name, n in zip(names, row, strict=True):
            if n:
                runs.append((s, p, name, at, at + n))
                at += n
    ranges = materialize(df.sparkSession.createDataFrame(pd.DataFrame(runs, columns=["size", "profile", "new_split", "lo", "hi"]), "size bigint, profile string, new_split string, lo bigint, hi bigint"))
    buckets = max(64, sum(n for _, _, n in counted) // 50_000)
    by = ["size", "profile"]
    hashed = parts.withColumn("h", F.xxhash64("group_id")).withColumn("bucket", F.pmod("h", F.lit(buckets)))
    counts = hashed.groupBy(*by, "bucket").agg(size.alias("n"))
    before = counts.select(*by, "bucket", F.coalesce(F.sum("n").over(W.partitionBy(*by).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    ranked = hashed.join(before, [*by, "bucket"]).withColumn("rank", F.col("base") + F.row_number().over(W.partitionBy(*by, "bucket").orderBy("h", "group_id")) - 1)
    chosen = materialize(join_lookup(ranked, ranges, by, F.col("group_id")).filter("rank >= lo and rank < hi").select("group_id", "new_split"))
    return join_hot(g, chosen, ["group_id"], F.col(row_id)).select(row_id, "group_id", "new_split")
