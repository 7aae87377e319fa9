"""Accept-as-you-go with quotas (inventory M5 with M6).

Items are offered in order. One is *accepted* when its class still has room and no
item accepted before it is similar. The two rules are coupled: an item refused
because its class is full does not reject later ones, and one rejected as similar
takes no room. So neither dedupe-then-quota nor quota-then-dedupe gives the result.

The sequential result is computed in rounds over all undecided items:

* similar to an accepted earlier item: *rejected*;
* no undecided earlier item is similar, and fewer than the quota of its class come
  before it among accepted and undecided items: *accepted*;
* its class has its quota of accepted items: refused as *full*.

The first undecided item of all is always decided, and usually long runs are. Similarity
is given between *values*: the items of one value are similar to each other, and values
joined by an edge are. Each round sends, per value, only its first accepted and first
undecided item over the edges, so copies of one value never meet in pairs, and ranks at
most the quota per class and task (top-N with a partial limit).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.windows import top_n_per_group
from quarry.session import written_table


def _first(state: DataFrame, what: str) -> DataFrame:
    return state.where(F.col("s") == what).groupBy("value").agg(F.min("id").alias("first"))


def _nearest(state: DataFrame, edges: DataFrame, what: str, name: str) -> DataFrame:
    """Per value, the first item in state ``what`` that is similar: of the value itself or of a neighbour."""
    own = _first(state, what)
    over = own.join(edges, own["value"] == edges["x"]).select(F.col("y").alias("value"), "first")
    return own.unionByName(over).groupBy(F.col("value").alias(f"_{name}")).agg(F.min("first").alias(name))


def accept_capped(items: DataFrame, edges: DataFrame, quotas: Mapping[object, int], id_col: str = "id",
                  value_col: str = "value", class_col: str = "class") -> DataFrame:
    """``id, outcome, similar_to`` of every item: ``accepted``, ``similar`` (with the
    first accepted item before it that is) or ``full`` (its class had its quota).

    ``items``: unique ``id`` (the order of offering), ``value``, ``class``; ``edges``:
    similar values as columns ``a``, ``b``, in any direction. A class without a quota
    takes nothing. NULL value: similar to nothing. NULL class: takes nothing.
    The quota is asked
    first: an item that comes when its class is full is ``full``, similar or not.
    """
    rows = items.select(F.col(id_col).alias("id"), F.col(value_col).alias("value"), F.col(class_col).alias("class"))
    room = F.lit(0)
    for name, n in quotas.items():  # one entry a class, bounded by the caller's mapping
        room = F.when(F.col("class") == F.lit(name), F.lit(int(n))).otherwise(room)
    most = max([int(n) for n in quotas.values()], default=0)
    both = edges.select(F.col("a").alias("x"), F.col("b").alias("y")).union(edges.select("b", "a")).where("x <> y").distinct()
    both = written_table(both, "edges")
    state = written_table(rows.withColumn("room", room).withColumn("s", F.when(F.col("room") > 0, "?").otherwise("no")), "state")
    while not state.where("s = '?'").isEmpty():
        accepted, undecided = _nearest(state, both, "accepted", "acc"), _nearest(state, both, "?", "und")
        near = (state.join(accepted, F.col("value").eqNullSafe(F.col("_acc")), "left").join(undecided, F.col("value").eqNullSafe(F.col("_und")), "left")
                .withColumn("similar", F.col("value").isNotNull() & F.coalesce(F.col("acc") < F.col("id"), F.lit(False)))
                .withColumn("free", F.col("value").isNull() | F.coalesce(F.col("und") >= F.col("id"), F.lit(True))))
        near = written_table(near.withColumn("s", F.when((F.col("s") == "?") & F.col("similar"), "no").otherwise(F.col("s")))
                             .select("id", "value", "class", "room", "s", "free"), "near")
        # the items that have room whatever becomes of the undecided ones before them
        front = top_n_per_group(near.where("s <> 'no'").select("id", "class", "room", "s", "free"), "class", [F.col("id")], most,
                                kind="row_number", rank_col="rank").where("rank <= room")
        front = written_table(front.select("id", "class", "s", "free"), "front")
        goes = front.where("s = '?' and free").select(F.col("id").alias("_id"))
        taken = front.where("s = 'accepted' or free").groupBy(F.col("class").alias("_class")).agg(F.count(F.lit(1)).alias("taken"))
        now = near.join(goes, F.col("id") == F.col("_id"), "left").join(taken, F.col("class").eqNullSafe(F.col("_class")), "left")
        full = F.coalesce(F.col("taken") >= F.col("room"), F.lit(False))
        s = F.when(F.col("s") != "?", F.col("s")).when(F.col("_id").isNotNull(), "accepted").when(full, "no").otherwise("?")
        state = written_table(now.select("id", "value", "class", "room", s.alias("s")), "state")

    last = (state.where("s = 'accepted'").groupBy(F.col("class").alias("_class"), "room").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("last"))
            .where("n >= room").select("_class", "last"))
    by = _nearest(state, both, "accepted", "acc")
    out = (state.join(last, F.col("class").eqNullSafe(F.col("_class")), "left").join(by, F.col("value").eqNullSafe(F.col("_acc")), "left"))
    is_full = (F.col("room") == 0) | F.coalesce(F.col("id") > F.col("last"), F.lit(False))
    outcome = F.when(F.col("s") == "accepted", "accepted").when(is_full, "full").otherwise("similar")
    return out.select(F.col("id").alias(id_col), outcome.alias("outcome"), F.when(outcome == "similar", F.col("acc")).alias("similar_to"))
