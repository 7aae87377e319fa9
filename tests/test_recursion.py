"""Recursion by doubling against a walk."""

import random

import pytest

from quarry.operators import recursion


def walked(seeds, edges):
    depth, front = {s: 0 for s in seeds if s is not None}, [s for s in seeds if s is not None]
    while front:
        front = [y for x in front for a, y in edges if a == x and y is not None and y not in depth and not depth.update({y: depth[x] + 1})]
    return depth


@pytest.mark.parametrize("method", ["doubling", "steps"])
def test_reachable_graph(spark, method):
    r = random.Random(4)
    edges = [(r.randrange(60), r.randrange(60)) for _ in range(90)] + [(None, 1), (1, None), (3, 3), (7, 8), (8, 7), (7, 8)]
    seeds = [1, 7, 7, 99, None]
    got = recursion.reachable(spark.createDataFrame([(s,) for s in seeds], "node long"), spark.createDataFrame(edges, "src long, dst long"), method=method)
    assert {x["node"]: x["depth"] for x in got.collect()} == walked(seeds, edges)


def test_chain_of_2000_levels_in_11_rounds(spark, monkeypatch):
    written = []
    keep = recursion.written_table
    monkeypatch.setattr(recursion, "written_table", lambda df, name: written.append(name) or keep(df, name))
    chain = spark.range(2000).selectExpr("id as src", "id + 1 as dst")
    got = {r["node"]: r["depth"] for r in recursion.reachable(spark.range(1).toDF("node"), chain).collect()}
    assert got == {i: i for i in range(2001)}
    assert written.count("merged") <= 13
    written.clear()
    out = recursion.roots(spark.range(2000).selectExpr("id as node", "id - 1 as parent")).collect()
    assert all((r["root"], r["depth"]) == (0, r["node"]) for r in out) and len(out) == 2000
    assert written.count("pointers") <= 13


def test_roots_of_a_forest_with_cycles(spark):
    r = random.Random(5)
    parent = {i: r.randrange(i) if i % 7 else None for i in range(200)} | {300: 301, 301: 302, 302: 300, 303: 302, 304: 304, 305: 999}

    def up(i):
        depth, seen = 0, set()
        while parent[i] in parent:
            if i in seen:
                return None, None
            seen.add(i)
            i, depth = parent[i], depth + 1
        return i, depth
    got = recursion.roots(spark.createDataFrame(list(parent.items()), "node long, parent long"))
    assert {x["node"]: (x["root"], x["depth"]) for x in got.collect()} == {i: up(i) for i in parent}
    assert recursion.roots(spark.createDataFrame([], "node long, parent long")).count() == 0
