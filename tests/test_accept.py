"""The coupled accept loop against a walk over the items."""

import random

import pytest

from quarry.operators.accept import accept_capped

ITEMS = "id long, value string, class string"


def walk(items, edges, quotas):
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    taken, count, out = {}, {}, {}
    for i, value, kind in sorted(items):
        if count.get(kind, 0) >= quotas.get(kind, 0):
            out[i] = ("full", None)
            continue
        hits = [taken[v] for v in near.get(value, set()) | {value} if value is not None and v in taken]
        if hits:
            out[i] = ("similar", min(hits))
            continue
        out[i] = ("accepted", None)
        count[kind] = count.get(kind, 0) + 1
        if value is not None:
            taken[value] = i
    return out


@pytest.mark.parametrize("seed", range(3))
def test_against_a_walk(spark, seed):
    r = random.Random(seed)
    values = [f"v{i}" for i in range(40)]
    items = [(i, r.choice([*values, "hot", "hot", None]), r.choice(["x", "y", "z", "w", None])) for i in range(300)]
    edges = [(r.choice(values), r.choice(values)) for _ in range(45)] + [("hot", "v1")]
    quotas = {"x": 12, "y": 3, "z": 400, "q": 5}
    df, links = spark.createDataFrame(items, ITEMS), spark.createDataFrame(edges, "a string, b string")
    got = {x["id"]: (x["outcome"], x["similar_to"]) for x in accept_capped(df, links, quotas).collect()}
    assert got == walk(items, edges, quotas)
    assert len({o for o, _ in got.values()}) == 3


def test_the_two_orders_differ(spark):
    """2 is refused as full, so it does not reject 3, of another class; dedupe before quota would."""
    items = [(1, "a", "x"), (2, "b", "x"), (3, "b", "y"), (4, "c", "y"), (5, "c", "y"), (6, "d", "y")]
    got = {r["id"]: r["outcome"] for r in accept_capped(spark.createDataFrame(items, ITEMS), spark.createDataFrame([], "a string, b string"), {"x": 1, "y": 3}).collect()}
    assert got == {1: "accepted", 2: "full", 3: "accepted", 4: "accepted", 5: "similar", 6: "accepted"}


def test_nothing_asked(spark):
    none = spark.createDataFrame([], "a string, b string")
    items = spark.createDataFrame([(1, "a", "x")], ITEMS)
    assert [tuple(r) for r in accept_capped(items, none, {}).collect()] == [(1, "full", None)]
    assert accept_capped(items.where("false"), none, {"x": 1}).count() == 0
