"""Edit scripts with a fixed choice among equally short ones."""

from __future__ import annotations


def edit_script(source: list[str], target: list[str]) -> list[tuple[str, int, int]]:
    """``(operation, source index, target index)`` in ascending order. Common ends are left aside; going back from the
    end, a deletion is taken where one is on a shortest path, else an insertion where its rest is shorter than the
    diagonal's, else the diagonal."""
    head = 0
    while head < min(len(source), len(target)) and source[head] == target[head]:
        head += 1
    tail = 0
    while tail < min(len(source), len(target)) - head and source[-1 - tail] == target[-1 - tail]:
        tail += 1
    a, b = source[head : len(source) - tail], target[head : len(target) - tail]
    d = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(d[i - 1][j] + 1, row[j - 1] + 1, d[i - 1][j - 1] + (x != y)))
        d.append(row)
    ops = []
    i, j = len(a), len(b)
    while i or j:
        if i and d[i][j] == d[i - 1][j] + 1:
            i -= 1
            ops.append(("delete", head + i, head + j))
        elif j and (not i or d[i][j - 1] < d[i - 1][j - 1]):
            j -= 1
            ops.append(("insert", head + i, head + j))
        else:
            i, j = i - 1, j - 1
            if a[i] != b[j]:
                ops.append(("replace", head + i, head + j))
    return ops[::-1]
