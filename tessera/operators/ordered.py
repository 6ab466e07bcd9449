"""Skew-safe ordered scans: exact per-group ranks and running sums without
``Window.partitionBy(key)``.

A window partitioned by a key sends every row of that key to one task; if
one key holds a third of the rows, that task holds a third of the data.
Here the frame is instead range-partitioned on ``(keys..., order...)``
(Spark samples the composite sort key, so a hot key is spread over many
balanced partitions), sorted within partitions and checkpointed so the
partition layout is fixed. Then:

* a small summary - one row per (key, partition) - gets, by a window over
  at most ``#partitions`` rows per key, the number of rows and the running
  sums that precede each partition;
* each row's group rank is ``offset + position within the partition``;
* running sums are a window over ``(key, partition)`` (bounded by one
  partition's size) plus the carried-in sums; the window and the join-back
  of the carries use the same non-null surrogate key columns, so the big
  side is hash-shuffled once;
* what looks back a bounded number of rows (lags, rolling means) or to the
  last row of a kind (as-of matches) is a native window function over
  ``(key, partition)``: the rows just before a partition are carried into it
  as *ghosts*, copies that the window sees and that are dropped afterwards.
  A partition takes ``halo`` ghosts at most, so nothing but a few rows a
  partition is moved beside the window's own shuffle.
"""

from __future__ import annotations

from typing import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tessera.session import checkpoint_dir

__all__ = ["sorted_frame", "with_rank", "null_safe_join", "join_stats", "quantiles"]

_POS_MASK = (1 << 33) - 1


def _cols(cs) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def sorted_frame(df: DataFrame, keys: Sequence[str], order: Sequence, partitions: int | None = None, without: Sequence[str] = ()) -> DataFrame:
    """Range-partition and sort on (keys, order); tag each row with its
    partition id ``_pid`` and position ``_pos``; checkpoint (reliable, to the
    cluster's checkpoint folder) so later branches see one fixed layout, with
    all columns but those of ``without``."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    sort_cols = _cols(keys) + _cols(order)
    # Without an explicit count AQE may merge adjacent (still contiguous) ranges
    # to the advisory partition size: no tiny tasks on small inputs, byte-sized
    # partitions on large ones.
    ranged = df.repartitionByRange(partitions, *sort_cols) if partitions else df.repartitionByRange(*sort_cols)
    s = (ranged.sortWithinPartitions(*sort_cols)
         .withColumn("_pid", F.spark_partition_id())
         .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_POS_MASK))).drop(*without))
    return s.checkpoint(eager=True)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner",
                   extra: Sequence[str] = ()) -> DataFrame:
    """Join on ``keys`` treating NULL = NULL as a match (group keys may be
    null), plus plain equality on ``extra`` columns. Right-side copies of the
    join columns are dropped."""
    ren = {c: f"_rk{i}" for i, c in enumerate(list(keys) + list(extra))}
    r = right.select(*[F.col(c).alias(ren[c]) if c in ren else F.col(c) for c in right.columns])
    cond = [left[c].eqNullSafe(r[ren[c]]) for c in keys] + [left[c] == r[ren[c]] for c in extra]
    out = left.join(r, cond, how)
    return out.drop(*ren.values())


#: rows of a per-group table up to which it is sent to the rows rather than these to it
SMALL = 100_000


def join_stats(df: DataFrame, stats: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Joins per-group numbers back to the rows of their groups (null keys
    match). The table of groups is computed once and counted: a small one is
    broadcast, so that the rows stay where they are and few or uneven groups
    make no hot task; a large one is joined by shuffle, where groups are many."""
    checkpoint_dir(df.sparkSession)
    stats = stats.checkpoint()
    return null_safe_join(df, F.broadcast(stats) if stats.count() <= SMALL else stats, keys, how)


def _with_ghosts(s: DataFrame, halo: int, of: str | None) -> DataFrame:
    """``s`` (a sorted frame) and, flagged ``_ghost``, the ``halo`` rows before
    each partition (with ``of``, the last row before it in which that column
    is true), placed ahead of its first row. Which rows these are follows
    from one number a partition, which is all the driver sees."""
    wanted = F.max(F.when(F.col(of), F.col("_pos"))) if of else F.max("_pos")
    last = {r["_pid"]: r["p"] for r in s.groupBy("_pid").agg(wanted.alias("p")).collect()}
    carried, tail = [], []                       # tail: (partition, first position, rows) that hold the last ``halo`` rows so far
    for pid in sorted(last):
        carried += [(src, start, pid) for src, start, _ in tail]
        if last[pid] is None:
            continue
        n = 1 if of else last[pid] + 1
        tail = [(pid, max(last[pid] + 1 - halo, 0), min(n, halo))] if n >= halo else tail + [(pid, 0, n)]
        while sum(x[2] for x in tail) > halo:
            src, start, rows = tail[0]
            drop = min(sum(x[2] for x in tail) - halo, rows)
            tail = ([(src, start + drop, rows - drop)] if rows > drop else []) + tail[1:]
    spark = s.sparkSession
    to = spark.createDataFrame(carried, "_src int, _start bigint, _to int")       # at most ``halo`` rows a partition
    ghosts = s.join(F.broadcast(to), (F.col("_pid") == F.col("_src")) & (F.col("_pos") >= F.col("_start")))
    if of:
        ghosts = ghosts.where(F.col("_pos") == F.col("_start"))
    place = F.col("_pos") - (F.col("_to") - F.col("_src")).cast("bigint") * F.lit(_POS_MASK + 1)
    ghosts = ghosts.select(*[F.col("_to").alias("_pid") if c == "_pid" else place.alias("_pos") if c == "_pos" else F.col(f"`{c}`") for c in s.columns])
    return s.withColumn("_ghost", F.lit(False)).unionByName(ghosts.withColumn("_ghost", F.lit(True)))


def with_rank(df: DataFrame, keys: Sequence[str], order: Sequence, sums: Sequence[str] = (),
              partitions: int | None = None, materialize: bool = False, totals: bool = False, rank: bool = True,
              local: Mapping[str, Callable[[WindowSpec], Column]] | None = None, halo: int = 0, halo_of: str | None = None,
              without: Sequence[str] = (), reread: bool = False) -> DataFrame:
    """Add ``_rank`` (0-based position in the group order), ``_n`` (group
    size) and, for each column ``c`` in ``sums``, ``_cum_<c>`` (inclusive
    running sum, nulls skipped) and ``_cnt_<c>`` (inclusive running count of
    non-null values). ``order`` must make the order total (add a unique
    tiebreak) for results to be deterministic. ``materialize`` checkpoints
    the ranked result, for callers that join it with itself; ``totals`` adds
    the group's sum ``_tot_<c>``.

    ``local`` adds native window functions of the group order that look back
    at most ``halo`` rows, or with ``halo_of`` to the last row in which that
    boolean column is true; ``rank=False`` leaves ``_rank`` and ``_n`` out
    (only without ``sums``). Columns ``without`` serve the order alone.
    ``reread`` (only without ``keys``) counts the partitions once, for callers
    that read the result again and again."""
    keys = list(keys)
    s = sorted_frame(df, keys, order, partitions, without)
    # Non-null surrogate keys (value-or-default, is-null flag): plain equality on
    # them equals null-safe equality on the keys, and the local window and the
    # join-back can then share ONE hash partitioning of the big side.
    nn = []
    for i, k in enumerate(keys):
        dtype = s.schema[k].dataType
        s = (s.withColumn(f"_kv{i}", F.coalesce(F.col(k), _default(dtype)))
             .withColumn(f"_kz{i}", F.col(k).isNull()))
        nn += [f"_kv{i}", f"_kz{i}"]
    out = _with_ghosts(s, halo, halo_of) if halo else s
    w = Window.partitionBy(*nn, "_pid").orderBy("_pos")
    if sums:
        upto = w.rowsBetween(Window.unboundedPreceding, 0)
        for c in sums:
            own = F.when(~F.col("_ghost"), F.col(c)) if halo else F.col(c)
            out = (out.withColumn(f"_lcum_{c}", F.coalesce(F.sum(own).over(upto), F.lit(0)))
                   .withColumn(f"_lcnt_{c}", F.count(own).over(upto)))
    for name, make in (local or {}).items():
        out = out.withColumn(name, make(w))
    if halo:
        out = out.where(~F.col("_ghost")).drop("_ghost")
    if not rank and not sums:
        return out.drop("_pos", "_pid", *nn)
    aggs = [F.count(F.lit(1)).alias("_c"), F.min("_pos").alias("_p0")]
    for c in sums:
        aggs += [F.sum(c).alias(f"_s_{c}"), F.count(c).alias(f"_k_{c}")]
    summ = s.groupBy(*nn, "_pid").agg(*aggs)
    wk = Window.partitionBy(*nn) if nn else Window.partitionBy(F.lit(0))
    prev = wk.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    cols = [*nn, "_pid", "_p0",
            F.coalesce(F.sum("_c").over(prev), F.lit(0)).alias("_off"),
            F.sum("_c").over(wk).alias("_n")]
    for c in sums:
        cols += [F.coalesce(F.sum(f"_s_{c}").over(prev), F.lit(0)).alias(f"_cs_{c}"),
                 F.coalesce(F.sum(f"_k_{c}").over(prev), F.lit(0)).alias(f"_ck_{c}")]
        if totals:
            cols.append(F.sum(f"_s_{c}").over(wk).alias(f"_tot_{c}"))
    summ = summ.select(*cols)
    # Without keys the summary is one row a partition: the rows stay where they are.
    if reread and not nn:
        summ = df.sparkSession.createDataFrame(summ.toArrow(), summ.schema)
    out = out.join(summ if nn else F.broadcast(summ), [*nn, "_pid"])
    out = out.withColumn("_rank", F.col("_off") + F.col("_pos") - F.col("_p0"))
    for c in sums:
        out = (out.withColumn(f"_cum_{c}", F.col(f"_lcum_{c}") + F.col(f"_cs_{c}"))
               .withColumn(f"_cnt_{c}", F.col(f"_lcnt_{c}") + F.col(f"_ck_{c}")))
    out = out.drop(*[f"_cs_{c}" for c in sums], *[f"_ck_{c}" for c in sums],
                   *[f"_lcum_{c}" for c in sums], *[f"_lcnt_{c}" for c in sums])
    out = out.drop("_off", "_p0", "_pos", "_pid", *nn)
    return out.checkpoint() if materialize else out


def _default(dtype):
    """A value of the key's type to stand in for NULL (paired with an is-null flag)."""
    t = dtype.simpleString()
    if t == "string":
        return F.lit("")
    if t == "boolean":
        return F.lit(False)
    if t == "date":
        return F.lit("1970-01-01").cast("date")
    if t.startswith("timestamp"):
        return F.lit("1970-01-01 00:00:00").cast(t)
    return F.lit(0).cast(dtype)


def quantiles(df: DataFrame, col: str, probs: Sequence[float], keys: Sequence[str] = (),
              names: Sequence[str] | None = None, partitions: int | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles (pandas ``quantile`` / SQL
    ``percentile_cont``) per group, with no group held in one task: the
    non-null values are counted (map-side combined, so a value that holds
    most rows is one row afterwards), the distinct values are ranked with
    running counts, and those whose run of places covers floor/ceil of
    ``p*(n-1)`` are kept and interpolated. One row per group with one column
    per p."""
    keys = list(keys)
    names = list(names or [f"q{int(round(p * 100))}" for p in probs])
    x = df.select(*keys, F.col(col).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    x = x.groupBy(*keys, "_x").agg(F.count(F.lit(1)).alias("_w"))
    r = with_rank(x, keys, [F.col("_x")], sums=["_w"], partitions=partitions, totals=True)
    covers = lambda at: (F.col("_cum__w") - F.col("_w") <= at) & (at < F.col("_cum__w"))
    want, aggs = F.lit(False), []
    for p, name in zip(probs, names):
        h = (F.col("_tot__w") - 1) * F.lit(float(p))
        lo, hi = covers(F.floor(h)), covers(F.ceil(h))
        want = want | lo | hi
        vlo, vhi = F.max(F.when(lo, F.col("_x"))), F.max(F.when(hi, F.col("_x")))
        aggs.append((vlo + (vhi - vlo) * F.first(h - F.floor(h))).alias(name))
    return r.where(want).groupBy(*keys).agg(*aggs)
