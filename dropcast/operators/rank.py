"""Skew-safe ordering operators: ranks, exact percentiles, running sums, splits, folds, CDF.

Three exact paths, none of which sends a data row to a single task:

* Grouped ranks: rows are range-partitioned on (group, order
  keys) - a hot group spans many partitions - sorted inside each partition and
  checkpointed to the shared checkpoint folder (fixing partition ids and
  positions). A small per-(partition, group) table gives each segment's offset;
  the rank is that offset plus the position inside the partition.
* Percentiles, global and grouped: exact selection by histogram refinement -
  a few map-side-combined aggregations of bucket counts, no sort at all.
* Value-count tables (multi-column medians, CDF): counts
  per (group, distinct value) first, then range-partitioned running sums.

Splits and folds rank only the (time, id) keys and filter the original rows
against the keys found at the boundary ranks.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .joins import DEFAULT_BROADCAST_MAX_ROWS, broadcast_ok

_PID, _MID = "_dc_pid", "_dc_mid"


def _num_partitions(df: DataFrame, num_partitions: int | None) -> int | None:
    """Explicit range-partition count, or None: then the session's shuffle partition
    count applies and AQE may coalesce small outputs (size it for the data, as for any
    shuffle: partitions of a few hundred MB at the target scale)."""
    return int(num_partitions) if num_partitions else None


def _range_sorted_checkpoint(df: DataFrame, keys: list, n_parts: int | None) -> DataFrame:
    """Range-partition and sort by ``keys``, checkpoint to the shared folder, tag partition id/position.

    The narrow input is computed twice (range-bound sampling, then the write)
    rather than kept on local disks. Partition ids are read from the
    checkpoint, so they are the final (post-coalescing) ones.
    """
    parted = df.repartitionByRange(n_parts, *keys) if n_parts else df.repartitionByRange(*keys)
    ck = parted.sortWithinPartitions(*keys).checkpoint(eager=True)
    return ck.withColumns({_PID: F.spark_partition_id(), _MID: F.monotonically_increasing_id()})


def ranked(
    df: DataFrame,
    order_cols: list,
    group_cols: list[str] | tuple = (),
    rank_col: str = "rn",
    size_col: str | None = "group_n",
    num_partitions: int | None = None,
    max_broadcast_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
    count_col: str | None = None,
) -> DataFrame:
    """Add a 1-based ``rank_col`` (row number) within ``group_cols`` ordered by ``order_cols``.

    Order columns should end with a unique key so ranks are deterministic.
    ``size_col`` receives the group size (non-NULL ``count_col`` values when
    given: order that column NULLS LAST so its values rank 1..size). NULL
    group keys form one group.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    group_cols = list(group_cols)
    keys = group_cols + list(order_cols)
    n_parts = _num_partitions(df, num_partitions)
    ck = _range_sorted_checkpoint(df, keys, n_parts)

    seg = ck.groupBy(_PID, *group_cols).agg(
        F.min(_MID).alias("_first"), F.count(F.lit(1)).alias("_cnt"),
        (F.count(count_col) if count_col else F.count(F.lit(1))).alias("_nn"))
    gw = Window.partitionBy(*group_cols) if group_cols else Window.partitionBy(F.lit(0))
    seg = seg.withColumns(
        {
            "_before": F.coalesce(
                F.sum("_cnt").over(gw.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ),
            "_gn": F.sum("_nn").over(gw),
        }
    )
    seg = seg.select(F.col(_PID).alias("_s_pid"), *[F.col(g).alias(f"_s_{i}") for i, g in enumerate(group_cols)],
                     "_first", "_before", "_gn")
    # seg has at most (#groups + #partitions) rows: with no groups the bound is
    # the partition count; otherwise it is counted before broadcasting.
    if group_cols:
        # materialise the segment table once (its size observed while writing)
        obs = Observation("segment_rows")
        seg = seg.observe(obs, F.count(F.lit(1)).alias("n")).checkpoint(eager=True)
        n_seg = int(obs.get["n"])
        seg_side = F.broadcast(seg) if broadcast_ok(n_seg, seg.schema, max_broadcast_rows) else seg
    else:
        seg_side = F.broadcast(seg)
    cond = [F.col(_PID) == F.col("_s_pid")] + [F.col(g).eqNullSafe(F.col(f"_s_{i}")) for i, g in enumerate(group_cols)]
    joined = ck.join(seg_side, reduce(lambda a, b: a & b, cond), "inner")
    extra = [(F.col(_MID) - F.col("_first") + 1 + F.col("_before")).alias(rank_col)]
    if size_col:
        extra.append(F.col("_gn").alias(size_col))
    return joined.select(*[F.col(c) for c in df.columns], *extra)


def running_sums(
    df: DataFrame,
    order_cols: list,
    sum_cols: list[str],
    group_cols: list[str] | tuple = (),
    suffix: str = "_cum",
    num_partitions: int | None = None,
    max_broadcast_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
    total_suffix: str | None = None,
) -> DataFrame:
    """Inclusive running sums of ``sum_cols`` within groups in ``order_cols`` order
    (plus group totals as ``{col}{total_suffix}`` when ``total_suffix`` is given).

    Same layout as ``ranked``: range partitions (a hot group spans many),
    per-partition running sums (a window over one partition's segment), plus
    the totals of the group's earlier partitions from a small segment table.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    group_cols = list(group_cols)
    keys = group_cols + list(order_cols)
    n_parts = _num_partitions(df, num_partitions)
    ck = _range_sorted_checkpoint(df, keys, n_parts)
    local_w = Window.partitionBy(_PID, *group_cols).orderBy(_MID).rowsBetween(Window.unboundedPreceding, 0)
    loc = ck.withColumns({f"_l_{c}": F.sum(c).over(local_w) for c in sum_cols})
    seg = ck.groupBy(_PID, *group_cols).agg(*[F.sum(c).alias(f"_t_{c}") for c in sum_cols])
    gw = Window.partitionBy(*group_cols) if group_cols else Window.partitionBy(F.lit(0))
    prev = gw.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    seg = seg.select(F.col(_PID).alias("_s_pid"), *[F.col(g).alias(f"_s_{i}") for i, g in enumerate(group_cols)],
                     *[F.coalesce(F.sum(f"_t_{c}").over(prev), F.lit(0)).alias(f"_b_{c}") for c in sum_cols],
                     *[F.sum(f"_t_{c}").over(gw).alias(f"_g_{c}") for c in sum_cols])
    if group_cols:
        seg_side = F.broadcast(seg) if broadcast_ok(seg.count(), seg.schema, max_broadcast_rows) else seg
    else:
        seg_side = F.broadcast(seg)
    cond = [F.col(_PID) == F.col("_s_pid")] + [F.col(g).eqNullSafe(F.col(f"_s_{i}")) for i, g in enumerate(group_cols)]
    joined = loc.join(seg_side, reduce(lambda a, b: a & b, cond), "inner")
    totals = [F.col(f"_g_{c}").alias(f"{c}{total_suffix}") for c in sum_cols] if total_suffix else []
    return joined.select(*[F.col(c) for c in df.columns],
                         *[(F.col(f"_l_{c}") + F.col(f"_b_{c}")).alias(f"{c}{suffix}") for c in sum_cols], *totals)


# Exact selection for ungrouped percentiles (no full sort): bucket counts per round
# and the size of a slice small enough to order directly.
REFINE_BUCKETS = 4096
REFINE_FINAL_ROWS = 10_000
REFINE_MAX_ROUNDS = 12


def _kth_values(base: DataFrame, value_col: str, ranks: list[int], lo: float, hi: float) -> dict[int, float] | None:
    """Exact k-th smallest non-NULL values (1-based ranks) by histogram refinement; None if the rounds don't suffice.

    Each round is one aggregation of (interval, bucket) counts with min/max per
    bucket, over the distinct value intervals that still contain a target rank;
    buckets are contiguous value ranges, so a target's interval shrinks to one
    bucket's [min, max] and the values below it are counted exactly. A bucket
    holding a single repeated value resolves at once (hot values); intervals
    with at most REFINE_FINAL_ROWS values are read together in one job and
    ordered directly.
    """
    v = F.col(value_col)
    state = {k: (lo, hi, 0) for k in ranks}  # interval [lo, hi] and #values below lo
    done: dict[int, float] = {}

    def tagged(intervals):
        """(value, interval index) for every row inside one of the intervals."""
        entries = [F.when((v >= F.lit(a)) & (v <= F.lit(b)), F.lit(i)) for i, (a, b) in enumerate(intervals)]
        return base.select(value_col, F.explode(F.array_compact(F.array(*entries))).alias("t"))

    for _ in range(REFINE_MAX_ROUNDS):
        for k, (a, b, _) in state.items():
            if k not in done and a == b:
                done[k] = a
        open_ = [k for k in state if k not in done]
        if not open_:
            break
        intervals = sorted({state[k][:2] for k in open_})
        index = {iv: i for i, iv in enumerate(intervals)}
        width = F.element_at(F.array(*[F.lit(float(b) - float(a)) for a, b in intervals]), F.col("t") + 1)
        start = F.element_at(F.array(*[F.lit(float(a)) for a, _ in intervals]), F.col("t") + 1)
        bucket = F.least(F.floor((v - start) / width * REFINE_BUCKETS), F.lit(REFINE_BUCKETS - 1)).cast("long")
        # at most len(intervals) * REFINE_BUCKETS rows come back
        hist = tagged(intervals).withColumn("b", bucket).groupBy("t", "b").agg(
            F.count(F.lit(1)).alias("c"), F.min(value_col).alias("mn"), F.max(value_col).alias("mx")).collect()
        by_t: dict[int, list] = {}
        for r in hist:
            by_t.setdefault(int(r["t"]), []).append((int(r["b"]), int(r["c"]), r["mn"], r["mx"]))
        for t in by_t:
            by_t[t].sort()
        finals = set()
        for k in open_:
            a, b, below = state[k]
            need, acc = k - below, 0
            for _, c, mn, mx in by_t.get(index[(a, b)], []):
                if acc + c >= need:
                    state[k] = (mn, mx, below + acc)
                    if mn == mx:
                        done[k] = mn
                    elif c <= REFINE_FINAL_ROWS:
                        finals.add(k)
                    break
                acc += c
        if finals:
            fin_iv = sorted({state[k][:2] for k in finals})
            rows = tagged(fin_iv).collect()  # at most len(fin_iv) * REFINE_FINAL_ROWS rows
            vals: dict[int, list] = {}
            for r in rows:
                vals.setdefault(int(r["t"]), []).append(r[value_col])
            for k in finals:
                a, b, below = state[k]
                done[k] = sorted(vals[fin_iv.index((a, b))])[k - below - 1]
    missing = [k for k in ranks if k not in done]
    return None if missing else done


def _global_percentiles(df: DataFrame, value_col: str, probs: list[float], names: list[str],
                        carry: list[str], extra_aggs: dict) -> DataFrame:
    """Ungrouped exact percentiles plus extra aggregates, without sorting the data."""
    spark = df.sparkSession
    keep = [c for c in carry if c != value_col]
    base = df.select(value_col, *dict.fromkeys(keep)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        v = F.col(value_col)
        first = base.agg(F.count(v).alias("_n"), F.min(v).alias("_lo"), F.max(v).alias("_hi"),
                         *[e.alias(n) for n, e in extra_aggs.items()])
        row = first.first()
        n = int(row["_n"])
        values: dict[int, float] = {}
        finite = n == 0 or all(isinstance(x, (int, float)) and math.isfinite(float(x)) for x in (row["_lo"], row["_hi"]))
        if not finite:  # infinities or NaN: bucket widths are undefined, rank instead
            return None
        if n > 0:
            ranks = set()
            for p in probs:
                h = (n - 1) * float(p) + 1
                ranks.update({math.floor(h), math.ceil(h)})
            values = _kth_values(base, value_col, sorted(ranks), row["_lo"], row["_hi"])
            if values is None:  # values of very many magnitudes: buckets of equal width don't part them
                return None
    finally:
        base.unpersist()
    pct = []
    for p in probs:
        if n == 0:
            pct.append(None)
            continue
        h = (n - 1) * float(p) + 1
        a, b = values[math.floor(h)], values[math.ceil(h)]
        pct.append(float(a + (h - math.floor(h)) * (b - a)))
    from pyspark.sql import types as T

    extra_fields = [f for f in first.schema.fields if f.name in extra_aggs]
    schema = T.StructType(extra_fields + [T.StructField(nm, T.DoubleType()) for nm in names])
    return spark.createDataFrame([tuple(row[f.name] for f in extra_fields) + tuple(pct)], schema)


# Groups of up to so many values are ordered as one list; larger ones are refined by buckets of equal width first.
GROUP_BUCKETS = 256


def _inside(base: DataFrame, value_col: str, intervals: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, _a, _b, value) of the rows that lie in an interval (keys, _a, _b) of their group."""
    side = intervals.select(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)], "_a", "_b").distinct()
    side = F.broadcast(side) if broadcast_ok(side.count(), side.schema) else side
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_g{i}")) for i, k in enumerate(keys)])
    return base.select(*keys, value_col).join(side, same & F.col(value_col).between(F.col("_a"), F.col("_b"))).select(*keys, "_a", "_b", value_col)


def _grouped_percentiles(base: DataFrame, value_col: str, probs: list[float], keys: list[str], names: list[str],
                         extra_aggs: dict) -> DataFrame | None:
    """Exact percentiles of every group by refinement, without sorting the rows; None where buckets can't part them.

    All groups are refined at once: a table of (group, rank, interval) names where each wanted rank lies, and one
    map-side-combined count per (interval, bucket) narrows all intervals to one bucket's [min, max]. A bucket with a
    single repeated value is an answer; an interval of at most REFINE_FINAL_ROWS values is ordered as one list.
    """
    ensure_checkpoint_dir(base.sparkSession)
    base = base.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        v, wide = F.col(value_col), F.col("_hi").cast("double")
        groups = base.groupBy(*keys).agg(F.count(v).alias("_n"), F.min(v).alias("_lo"), F.max(v).alias("_hi"),
                                         *[e.alias(n) for n, e in extra_aggs.items()]).checkpoint(eager=True)
        infinite = F.isnan(wide) | (F.abs(wide) == float("inf")) | (F.abs(F.col("_lo").cast("double")) == float("inf"))
        if not groups.filter(infinite).isEmpty():
            return None
        place = [(F.col("_n") - 1) * float(p) + 1 for p in probs]
        ranks = F.array_distinct(F.array(*[f(h).cast("long") for h in place for f in (F.floor, F.ceil)]))
        wanted = groups.filter("_n > 0").select(*keys, F.explode(ranks).alias("_k"), F.col("_lo").alias("_a"), F.col("_hi").alias("_b"),
                                                F.lit(0).cast("long").alias("_below"), F.col("_n").alias("_in"))
        narrow = (F.col("_a") == F.col("_b")) | (F.col("_in") <= REFINE_FINAL_ROWS)
        for _ in range(REFINE_MAX_ROUNDS):
            open_ = wanted.filter(~narrow)
            if open_.isEmpty():
                break
            part = (v.cast("double") - F.col("_a")) / (F.col("_b").cast("double") - F.col("_a")) * GROUP_BUCKETS
            counts = _inside(base, value_col, open_, keys).groupBy(
                *keys, "_a", "_b", F.least(F.floor(part), F.lit(GROUP_BUCKETS - 1)).alias("_bucket")).agg(
                F.count(F.lit(1)).alias("_c"), F.min(v).alias("_min"), F.max(v).alias("_max"))
            upto = Window.partitionBy(*keys, "_a", "_b").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)  # at most GROUP_BUCKETS rows
            counts = counts.withColumn("_upto", F.sum("_c").over(upto)).select(
                *[F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)], F.col("_a").alias("_x"), F.col("_b").alias("_y"), "_c", "_min", "_max", "_upto")
            same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_g{i}")) for i, k in enumerate(keys)])
            there = (F.col("_a") == F.col("_x")) & (F.col("_b") == F.col("_y")) & (F.col("_k") - F.col("_below")).between(F.col("_upto") - F.col("_c") + 1, F.col("_upto"))
            moved = open_.join(counts, same & there).select(*keys, "_k", F.col("_min").alias("_a"), F.col("_max").alias("_b"),
                                                            (F.col("_below") + F.col("_upto") - F.col("_c")).alias("_below"), F.col("_c").alias("_in"))
            wanted = wanted.filter(narrow).unionByName(moved).checkpoint(eager=True)
        else:
            if not wanted.filter(~narrow).isEmpty():
                return None
        some = wanted.filter("_a < _b")
        lists = _inside(base, value_col, some, keys).groupBy(*keys, "_a", "_b").agg(F.sort_array(F.collect_list(value_col)).alias("_values"))
        lists = lists.select(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)], F.col("_a").alias("_x"), F.col("_b").alias("_y"), "_values")
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_g{i}")) for i, k in enumerate(keys)])
        listed = some.join(lists, same & (F.col("_a") == F.col("_x")) & (F.col("_b") == F.col("_y"))).select(
            *keys, "_k", F.element_at("_values", (F.col("_k") - F.col("_below")).cast("int")).alias("_v"))
        found = wanted.filter("_a = _b").select(*keys, "_k", F.col("_a").alias("_v")).unionByName(listed)
        found = found.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_k", "_v"))).alias("_at"))
        found = found.select(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)], "_at").checkpoint(eager=True)  # a row per group
    finally:
        base.unpersist()
    low, high = ([F.try_element_at("_at", f(h).cast("long")) for h in place] for f in (F.floor, F.ceil))
    return groups.join(found, same, "left").select(
        *keys, *extra_aggs, *[(a + (h - F.floor(h)) * (b - a)).alias(n) for a, b, h, n in zip(low, high, place, names)])


def exact_percentiles(
    df: DataFrame,
    value_col: str,
    probs: list[float],
    group_cols: list[str] | tuple = (),
    names: list[str] | None = None,
    num_partitions: int | None = None,
    carry: list[str] | tuple = (),
    extra_aggs: dict | None = None,
) -> DataFrame:
    """Linear-interpolated percentiles per group (NULL values ignored).

    Position h = (n-1)*p + 1, result = v[floor h] + (h - floor h)(v[ceil h] - v[floor h]).
    Returns one row per group with one column per probability, plus any
    ``extra_aggs`` (name -> aggregate over ``value_col`` and the ``carry``
    columns). Values are counted per (group, value) first, with map-side
    combine, so a value that very many rows share is one row of what is ranked.
    Continuous values are better served by ``grouped_percentiles``.
    """
    group_cols = list(group_cols)
    names = names or [f"p{int(round(p * 100))}" for p in probs]
    if not group_cols:
        # one global answer: exact selection by refinement, no sort of the data
        out = _global_percentiles(df, value_col, probs, names, list(carry), dict(extra_aggs or {}))
        if out is not None:
            return out
    extra = dict(extra_aggs or {})
    keys = group_cols or ["_all"]
    base = df if group_cols else df.withColumn("_all", F.lit(0))
    counts = base.groupBy(*keys, value_col).agg(F.count(F.lit(1)).alias("_cnt"))
    pct = weighted_percentiles(counts, value_col, "_cnt", probs, keys, names, num_partitions)
    pct = pct.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *names)
    moments = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), *[e.alias(n) for n, e in extra.items()])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    return moments.join(pct, same, "left").select(*group_cols, *extra.keys(), *names)


def grouped_percentiles(df: DataFrame, value_col: str, probs: list[float], group_cols: list[str], names: list[str] | None = None,
                        carry: list[str] | tuple = (), extra_aggs: dict | None = None) -> DataFrame:
    """``exact_percentiles`` per group without ranking: values are selected by refinement of bucket counts. Only
    infinite values, and values of too many magnitudes for the rounds, are counted and ranked as there."""
    names = names or [f"p{int(round(p * 100))}" for p in probs]
    narrow = df.select(*dict.fromkeys([*group_cols, value_col, *carry]))
    out = _grouped_percentiles(narrow, value_col, probs, list(group_cols), names, dict(extra_aggs or {}))
    return out if out is not None else exact_percentiles(df, value_col, probs, group_cols, names, carry=carry, extra_aggs=extra_aggs)


def weighted_percentiles(counts: DataFrame, value_col: str, weight_col: str, probs: list[float],
                         group_cols: list[str] | tuple = (), names: list[str] | None = None,
                         num_partitions: int | None = None) -> DataFrame:
    """Exact linear-interpolated percentiles from a (group, value, count) table.

    Running counts give each distinct value the 1-based positions
    (cum - count, cum]; the values holding positions floor(h) and ceil(h)
    are picked per group. Same result as ranking the expanded rows.
    """
    group_cols = list(group_cols)
    names = names or [f"p{int(round(p * 100))}" for p in probs]
    # cut first: a filter on a computed value would be pushed below the projection that computes it
    ensure_checkpoint_dir(counts.sparkSession)
    vc = counts.checkpoint(eager=True).filter(F.col(value_col).isNotNull())
    c = running_sums(vc, [value_col], [weight_col], group_cols, suffix="_cum", num_partitions=num_partitions,
                     total_suffix="_tot")
    cum, w, n = F.col(f"{weight_col}_cum"), F.col(weight_col), F.col(f"{weight_col}_tot")
    aggs = []
    for i, p in enumerate(probs):
        h = (n - 1) * float(p) + 1
        lo, hi = F.floor(h), F.ceil(h)
        aggs += [F.max(F.when((cum - w < lo) & (lo <= cum), F.col(value_col))).alias(f"_lo{i}"),
                 F.max(F.when((cum - w < hi) & (hi <= cum), F.col(value_col))).alias(f"_hi{i}"),
                 F.max(h - F.floor(h)).alias(f"_fr{i}")]
    g = c.groupBy(*group_cols).agg(*aggs)
    return g.select(*group_cols, *[(F.col(f"_lo{i}") + F.col(f"_fr{i}") * (F.col(f"_hi{i}") - F.col(f"_lo{i}"))).alias(names[i])
                                   for i in range(len(probs))])


def column_percentiles(df: DataFrame, cols: list[str], probs: list[float], names: list[str] | None = None,
                       group_cols: list[str] | tuple = ()) -> DataFrame:
    """Percentiles of several numeric columns in one pass (long form: column, p...).

    Values are first counted per (column, value) - a map-side-combined
    aggregation, so discrete features (flags, hours, encodings) shrink to a
    handful of rows - and percentiles come from the weighted running counts.
    """
    group_cols = list(group_cols)
    stacked = df.select(
        *group_cols,
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols])).alias("_kv"),
    ).select(*group_cols, "_kv.column", "_kv.value")
    counts = stacked.filter(F.col("value").isNotNull()).groupBy(*group_cols, "column", "value").agg(
        F.count(F.lit(1)).alias("_cnt"))
    return weighted_percentiles(counts, "value", "_cnt", probs, group_cols + ["column"], names)


def global_rank(df: DataFrame, order_cols: list, rank_col: str = "rn", size_col: str = "n_total") -> DataFrame:
    return ranked(df, order_cols, (), rank_col, size_col)


class RankCutoffs:
    """Row count and the (time, id) keys found at chosen 1-based ranks of a total order.

    Only the two key columns are ranked (and checkpointed); the split itself is a
    comparison against these few keys, applied to the original frame - no join
    back and no full-width checkpoint, however wide or large the table.
    """

    def __init__(self, df: DataFrame, order_cols: list[str]):
        self.order_cols = list(order_cols)
        narrow = df.select(*self.order_cols)
        self._r = global_rank(narrow, [F.col(c).asc_nulls_last() for c in self.order_cols], "_rn", "_n")
        row = self._r.agg(F.max("_n").alias("n")).first()
        self.n = int(row["n"] or 0)
        self._keys: dict[int, tuple] = {}

    def fetch(self, ranks) -> None:
        """Read the keys at ``ranks`` (one small job; at most len(ranks) rows reach the driver)."""
        want = sorted({int(k) for k in ranks if 1 <= int(k) <= self.n} - set(self._keys))
        if want:
            for row in self._r.filter(F.col("_rn").isin(want)).collect():
                self._keys[int(row["_rn"])] = tuple(row[c] for c in self.order_cols)

    def at_or_before(self, rank: int):
        """Column: the row's rank in the order is <= ``rank`` (all rows above n, none below 1)."""
        if rank <= 0:
            return F.lit(False)
        if rank >= self.n:
            return F.lit(True)
        self.fetch([rank])
        return _tuple_le(self.order_cols, self._keys[rank])


def _tuple_le(cols: list[str], key: tuple):
    """(c1, c2, ...) <= key in ascending NULLS LAST order, as a column expression."""
    c, v = F.col(cols[0]), key[0]
    if v is None:  # key sorts last on this column: everything non-NULL is smaller
        head_lt, head_eq = c.isNotNull(), c.isNull()
    else:
        head_lt, head_eq = c < F.lit(v), c == F.lit(v)
    if len(cols) == 1:
        return F.coalesce(head_lt | head_eq, F.lit(False))
    return F.coalesce(head_lt | (head_eq & _tuple_le(cols[1:], key[1:])), F.lit(False))


def time_split(df: DataFrame, test_size: float = 0.2, time_col: str = "order_timestamp",
               id_col: str = "order_id") -> DataFrame:
    """Adds ``is_train``: the first floor(n*(1-test_size)) rows in (time, id) order."""
    cut = RankCutoffs(df, [time_col, id_col])
    split_idx = math.floor(cut.n * (1.0 - float(test_size)))
    return df.withColumn("is_train", cut.at_or_before(split_idx))


def time_series_folds(df: DataFrame, n_splits: int = 5, time_col: str = "order_timestamp",
                      id_col: str = "order_id") -> DataFrame:
    """Expanding-window folds: (rows..., fold, is_val) for every row used by a fold.

    s = n // (k+1); fold i trains on ranks <= n - (k-i)s and validates the next s.
    """
    k = int(n_splits)
    cut = RankCutoffs(df, [time_col, id_col])
    s = cut.n // (k + 1)
    starts = [cut.n - (k - i) * s for i in range(k)]
    cut.fetch(starts + [st + s for st in starts])
    # one scan: every row is paired with each fold, kept where it is inside that fold
    fold = F.col("fold")
    in_fold = is_val = None
    for i, st in enumerate(starts):
        in_fold = (F.when(fold == i, cut.at_or_before(st + s)) if in_fold is None
                   else in_fold.when(fold == i, cut.at_or_before(st + s)))
        is_val = (F.when(fold == i, ~cut.at_or_before(st)) if is_val is None
                  else is_val.when(fold == i, ~cut.at_or_before(st)))
    out = df.withColumn("fold", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(k - 1).cast("long"))))
    return out.filter(in_fold).withColumn("is_val", is_val)


def error_cdf(df: DataFrame, value_col: str = "abs_error", id_col: str | None = None) -> DataFrame:
    """Cumulative % of rows with value <= v, one row per distinct value (equal values share a step).

    Counts per distinct value first (map-side combined; checkpointed before the
    NULL filter so no predicate on a computed value is pushed into the scan),
    then range-partitioned running sums of the counts. ``id_col`` is accepted for
    compatibility and not needed.
    """
    obs = Observation("cdf_counts")
    counts = df.groupBy(value_col).agg(F.count(F.lit(1)).alias("_c"))
    ck = counts.observe(obs, F.sum(F.when(F.col(value_col).isNotNull(), F.col("_c"))).alias("n")).checkpoint(eager=True)
    n = int(obs.get["n"] or 0)
    vc = ck.filter(F.col(value_col).isNotNull())
    c = running_sums(vc, [value_col], ["_c"], suffix="_cum")
    return c.select(value_col, (F.col("_c_cum") / F.lit(float(n)) * 100.0).alias("cdf_pct"))


def percentile_names(ps: list[int]) -> list[str]:
    return [f"p{p}" for p in ps]


__all__ = [
    "ranked", "exact_percentiles", "column_percentiles", "global_rank", "time_split",
    "time_series_folds", "error_cdf", "percentile_names", "running_sums", "weighted_percentiles",
]
