"""Snapshot and batch-lifecycle operators (inventory M1-M5, M7-M11).

The reference keeps a corpus manifest: one entry per item with a content
digest, a first-seen date carried between builds, a version that moves only
when the entry list changes, ids assigned after the current maximum, per-class
quotas, reproducible samples, tag inventories, reject ledgers and an
all-or-nothing publish. Here each is a DataFrame job; writes go to folders
under the session's reliable checkpoint directory or a caller-given path.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.joins import reconcile
from quarry.operators.scan import MAX_BLOCKS, ordered_scan
from quarry.operators.windows import top_n_per_group


def _list(x: str | Sequence[str] | None) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


# --------------------------------------------------------------------- M1-M3 manifest

def content_digest(cols: Sequence[str]) -> Column:
    """SHA-256 of the content: one text column as is, several as their JSON
    object (stable field order)."""
    if len(cols) == 1:
        return F.sha2(F.col(cols[0]).cast("string"), 256)
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in cols])), 256)


def manifest(df: DataFrame, id_col: str, content_cols: Sequence[str],
             attrs: Sequence[str] = (), defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Content-hash manifest (M1): ``id``, ``sha256``, attributes; missing
    attributes take their defaults (M10)."""
    defaults = dict(defaults or {})
    out = [F.col(id_col).alias("id"), content_digest(content_cols).alias("sha256")]
    for a in attrs:
        c = F.col(a)
        out.append((F.coalesce(c, F.lit(defaults[a])) if a in defaults else c).alias(a))
    return df.select(*out)


def carry_first_seen(current: DataFrame, previous: DataFrame | None, run_date: str,
                     id_col: str = "id", added: str = "added_at") -> DataFrame:
    """First-seen date carried forward (M2): an id keeps the date of the
    previous snapshot, a new id gets ``run_date``. One left join on the id."""
    run = F.lit(run_date).cast("date")
    if previous is None:
        return current.withColumn(added, run)
    prev = previous.select(F.col(id_col).alias("_pid"), F.col(added).alias("_padded"))
    j = current.join(prev, F.col(id_col) == F.col("_pid"), "left")
    return j.withColumn(added, F.coalesce(F.col("_padded"), run)).drop("_pid", "_padded")


def next_version(previous: DataFrame, current: DataFrame, prev_version: int | Column,
                 id_col: str = "id", compare: Sequence[str] | None = None) -> DataFrame:
    """Change detection (M3): whole entries are compared (``compare`` narrows
    that to some columns); reconcile the two snapshots on the id and bump
    the version only when something was added, removed or changed. One row:
    ``version``, ``changed``, ``n_added``, ``n_removed``, ``n_changed``."""
    if compare is None:
        compare = [c for c in current.columns if c != id_col and c in previous.columns]
    r = reconcile(previous, current, id_col, list(compare))
    s = r.agg(F.count_if(F.col("status") == "added").alias("n_added"),
              F.count_if(F.col("status") == "removed").alias("n_removed"),
              F.count_if(F.col("status") == "changed").alias("n_changed"))
    changed = (F.col("n_added") + F.col("n_removed") + F.col("n_changed")) > 0
    pv = prev_version if isinstance(prev_version, Column) else F.lit(prev_version)
    return s.select((pv + changed.cast("int")).cast("bigint").alias("version"), changed.alias("changed"),
                    "n_added", "n_removed", "n_changed")


# --------------------------------------------------------------------- M4 ids

def assign_ids(new_rows: DataFrame, existing_max: Column, order: Sequence[str],
               id_col: str = "new_id", n_blocks: int | None = MAX_BLOCKS) -> DataFrame:
    """Sequential ids after the current maximum (M4): ``existing_max +
    row_number()`` in ``order``; from 1 where nothing exists yet. The global row number comes from the blocked
    ordered scan, so a large append is numbered by many tasks, not one."""
    numbered = ordered_scan(new_rows, None, list(order), n_blocks=n_blocks, row_number="_rn")
    return numbered.withColumn(id_col, (F.coalesce(existing_max, F.lit(0)) + F.col("_rn")).cast("bigint")).drop("_rn")


# --------------------------------------------------------------------- M5, M7 quotas and samples

def quota(df: DataFrame, class_col: str | Sequence[str], order: Sequence[Column], n: int,
          pos: str = "pos") -> DataFrame:
    """First ``n`` rows per class in arrival order (M5): ``row_number() <= n``
    as a bounded top-N (:func:`quarry.operators.windows.top_n_per_group`), so
    each task ships at most ``n`` rows per class however large the class is."""
    return top_n_per_group(df, class_col, order, n, kind="row_number", rank_col=pos)


def sample_without_replacement(df: DataFrame, id_col: str, n: int, seed: int,
                               used: DataFrame | None = None, where: Column | None = None,
                               order_col: str = "draw") -> DataFrame:
    """Reproducible sample of up to ``n`` rows (M7): drop already-used ids
    (anti join), optional class filter, then the ``n`` smallest
    ``md5(seed || id)``: a top-k (TakeOrderedAndProject), capped at what is
    available. Unlike an unseeded draw, the same seed gives the same sample."""
    pool = df if where is None else df.where(where)
    if used is not None:
        pool = pool.join(used.select(F.col(id_col)), id_col, "left_anti")
    keyed = pool.withColumn(order_col, F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string"))))
    return keyed.orderBy(F.col(order_col), F.col(id_col)).limit(n)


# --------------------------------------------------------------------- M8, M9 tags and ledger

def tag_inventory(df: DataFrame, tags: Column, n: int = 6) -> DataFrame:
    """Tag normalisation (first ``n`` members, lower-cased) and inventory:
    ``tag``, ``n_items``."""
    norm = F.transform(F.slice(tags, 1, n), lambda t: F.lower(F.trim(t)))
    return df.select(F.explode(F.array_distinct(norm)).alias("tag")).groupBy("tag") \
        .agg(F.count(F.lit(1)).alias("n_items"))


def ledger(screened: DataFrame, reason: str = "reason", by: Sequence[str] = ()) -> DataFrame:
    """Accept / reject ledger (M9, S7): counts per outcome and reason."""
    outcome = F.when(F.col(reason).isNull(), "accepted").otherwise("rejected")
    return screened.groupBy(outcome.alias("outcome"), F.col(reason).alias("reason"), *by) \
        .agg(F.count(F.lit(1)).alias("n"))


# --------------------------------------------------------------------- M11, S5, S6 writes

def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the reliable checkpoint directory (shared storage
    on a cluster; the session sets it)."""
    from quarry.session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/quarry-{name}-{uuid.uuid4().hex}"


def _rename(spark: SparkSession, src: str, dst: str) -> bool:
    """Atomic directory rename through the Hadoop FileSystem of the path."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    src_p, dst_p = jvm.org.apache.hadoop.fs.Path(src), jvm.org.apache.hadoop.fs.Path(dst)
    fs = src_p.getFileSystem(conf)
    parent = dst_p.getParent()
    if parent is not None:
        fs.mkdirs(parent)
    return bool(fs.rename(src_p, dst_p))


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def _replace(spark: SparkSession, staging: str, final: str) -> None:
    """Put ``staging`` in the place of ``final``; the folder that was there stays beside it under a dated name.

    A rename onto a folder that exists would move the new one *into* it. If the
    second rename fails, the old folder goes back and the call raises.
    """
    aside = f"{final.rstrip('/')}.before-{uuid.uuid4().hex}"
    had = _exists(spark, final)
    if had and not _rename(spark, final, aside):
        raise RuntimeError(f"{final} could not be moved aside")
    if not _rename(spark, staging, final) or _exists(spark, staging):
        if had:
            _rename(spark, aside, final)
        raise RuntimeError(f"{staging} could not be promoted to {final}")


def publish_if_clean(df: DataFrame, final_path: str,
                     checks: Mapping[str, Callable[[DataFrame], DataFrame]],
                     staging_path: str | None = None, fmt: str = "parquet") -> DataFrame:
    """All-or-nothing publish (M11): write to a staging folder, run every
    check on the *staged* data (each returns a findings DataFrame), promote
    by renaming the folder only when all are empty (a snapshot already there is
    moved aside first and kept). Returns one row per check
    with its finding count and the overall ``promoted`` flag; a failed gate
    leaves ``final_path`` untouched."""
    spark = df.sparkSession
    staging = staging_path or scratch_path(spark, "staging")
    df.write.mode("errorifexists").format(fmt).save(staging)
    staged = spark.read.format(fmt).load(staging)
    counts = [(name, check(staged).count()) for name, check in checks.items()]
    clean = all(n == 0 for _, n in counts)
    if clean:
        _replace(spark, staging, final_path)
    return spark.createDataFrame([(name, int(n), clean) for name, n in counts],
                                 "check string, findings long, promoted boolean")


def write_if_changed(current: DataFrame, previous_path: str | None, out_root: str, prev_version: int,
                     id_col: str = "id", compare: Sequence[str] | None = None) -> DataFrame:
    """Conditional snapshot sink (S6): compare with the previous snapshot
    (M3) and write ``out_root/v=<version>`` only when the entries changed.
    Returns the version row with ``written``."""
    spark = current.sparkSession
    if previous_path is None:
        prev = current.limit(0)
    else:
        prev = spark.read.parquet(previous_path)
    v = next_version(prev, current, prev_version, id_col, compare)
    row = v.first()
    written = False
    if row["changed"]:
        current.write.mode("errorifexists").parquet(f"{out_root.rstrip('/')}/v={row['version']}")
        written = True
    return v.withColumn("written", F.lit(written))
