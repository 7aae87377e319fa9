"""Several exact percentiles from one scan equal a direct computation."""

import math
import random

from quarry.operators.relational import exact_percentiles


def _cont(vals, p):
    v = sorted(vals)
    h = 1 + p * (len(v) - 1)
    lo, hi = v[math.floor(h) - 1], v[math.ceil(h) - 1]
    return lo + (h - math.floor(h)) * (hi - lo)


def _disc(vals, p):
    v = sorted(vals)
    return v[max(math.ceil(p * len(v)), 1) - 1]


def test_multi_percentiles_match_direct(spark):
    rng = random.Random(11)
    data = [("hot" if i % 3 else rng.choice(["a", "b"]), None if i % 17 == 0 else float(rng.randint(0, 40)))
            for i in range(900)]
    df = spark.createDataFrame(data, "g string, v double")
    specs = [(0.5, "cont", "med"), (0.9, "cont", "p90c"), (0.9, "disc", "p90d"), (0.1, "disc", "p10d")]
    got = {r["g"]: r for r in exact_percentiles(df, "g", "v", specs).collect()}
    for g in {x for x, _ in data}:
        vals = [v for x, v in data if x == g and v is not None]
        assert math.isclose(got[g]["med"], _cont(vals, 0.5))
        assert math.isclose(got[g]["p90c"], _cont(vals, 0.9))
        assert got[g]["p90d"] == _disc(vals, 0.9)
        assert got[g]["p10d"] == _disc(vals, 0.1)
