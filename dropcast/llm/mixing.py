"""Mixing sources to target weights by Pfair scheduling, in DataFrame and SQL functions only.

Every source's rows are cut into blocks. In the ideal mixture all sources run side by side: at the point v source s,
of the share w(s) of all weights, has run w(s) v blocks, or all it has; T(v) is the sum over the sources. The k-th
block of a source has the release time floor(T(k / w)) and the deadline ceil(T((k + 1) / w)), over the whole run and
for the exact weights, nothing is rounded. One slot after the other takes, among the released blocks, the one with
the earliest deadline (ties: smaller source). The ideal shares of any moment add up to one, so every block runs inside
its window: after any slot a source has run less than one block more or less than in the ideal mixture, in which a
source that runs out leaves its share to the others in proportion to their weights.

Slots are dealt in chunks of ``CHUNK_SLOTS``, each by one SQL expression over one row; the sources' current blocks are
handed from chunk to chunk. A slot costs one look at each source. Blocks get their slot by a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, grouped_rank

FRAME_SLOTS = 1000
BLOCK_ROWS = 16
CHUNK_SLOTS = 1 << 16  # slots of one job, which hands the sources' states to the next one
GROUP_SLOTS = 256  # slots appended to one array; the arrays of a chunk are joined at its end
TINY = 1e-6  # ideal times are sums of doubles: so near to a whole slot they count as whole
SLOT = "struct<s:int,k:bigint,release:bigint,deadline:bigint>"


def target_quotas(counts: DataFrame, weights: dict[str | None, float] | None, temperature: float, block_rows: int) -> DataFrame:
    """One row with ``sources``, an array of (source, share, n_blocks) in the order of the sources; the shares add up to 1.

    Weights: as given (a source that is not named gets the smallest given weight), else rows ** temperature.
    """
    if weights is None:
        w = F.pow(F.col("n_rows").cast("double"), F.lit(temperature))
    else:
        pairs = [F.when(F.col("source").eqNullSafe(F.lit(s)), F.lit(float(w))) for s, w in weights.items()]
        w = F.coalesce(*pairs, F.lit(float(min(weights.values()))))
    entry = F.struct(F.coalesce("source", F.lit("")).alias("order"), F.col("source").isNotNull().alias("named"), "source",
                     w.alias("w"), F.ceil(F.col("n_rows") / block_rows).alias("n_blocks"))
    every = counts.agg(F.array_sort(F.collect_list(entry)).alias("given")).withColumn(
        "all", F.aggregate("given", F.lit(0.0), lambda a, x: a + x["w"]))
    return every.select(F.transform("given", lambda x: F.struct(
        x["source"].alias("source"), (x["w"] / F.col("all")).alias("share"), x["n_blocks"].alias("n_blocks"))).alias("sources"))


def _current(s: Column, k: Column, begin: Column) -> Column:
    """(k, release, deadline, end) of block k of the source ``s``; ``begin`` and ``end`` are the ideal times of its
    bounds. The deadline is null after the last block."""
    end = F.aggregate("sources", F.lit(0.0), lambda a, x: a + F.least(x["share"] * (k + 1) / s["share"], x["n_blocks"].cast("double")))
    return F.transform(F.array(F.when(k < s["n_blocks"], end)), lambda e: F.struct(
        k.alias("k"), F.floor(begin + TINY).alias("release"), F.ceil(e - TINY).alias("deadline"), e.alias("end")))[0]


def _begin() -> Column:
    return F.transform("sources", lambda s: _current(s, F.lit(0).cast("long"), F.lit(0.0)))


def _schedule(first: int, n: int) -> Column:
    """(current, slots) after the slots first to first + n - 1, from the column ``current``; slots: array of SLOT."""
    def slot(state: Column, t: Column) -> Column:
        # no released block only where rounded times leave a gap: then the earliest deadline of all
        best = F.array_min(F.transform(state["current"], lambda c, i: F.when(
            c["deadline"].isNotNull(), F.struct((c["release"] > t).alias("early"), c["deadline"].alias("deadline"), i.alias("i")))))

        def taken(i: Column) -> Column:
            own = F.get(state["current"], i)
            after = F.transform(state["current"], lambda c, j: F.when(
                j == i, _current(F.get("sources", i), c["k"] + 1, c["end"])).otherwise(c))
            one = F.struct(i.alias("s"), own["k"].alias("k"), own["release"].alias("release"), own["deadline"].alias("deadline"))
            return F.struct(after.alias("current"), F.concat(state["slots"], F.array(one)).alias("slots"))

        return F.transform(F.array(best["i"]), taken)[0]

    def group(state: Column, t: Column) -> Column:
        start = F.struct(state["current"].alias("current"), F.array().cast(f"array<{SLOT}>").alias("slots"))
        last = F.least(t + GROUP_SLOTS - 1, F.lit(first + n - 1).cast("long"))
        done = F.aggregate(F.sequence(t, last), start, slot)
        return F.transform(F.array(done), lambda d: F.struct(
            d["current"].alias("current"), F.concat(state["slots"], F.array(d["slots"])).alias("slots")))[0]

    begin = F.struct(F.col("current").alias("current"), F.array().cast(f"array<array<{SLOT}>>").alias("slots"))
    starts = F.sequence(F.lit(first).cast("long"), F.lit(first + n - 1).cast("long"), F.lit(GROUP_SLOTS).cast("long"))
    return F.aggregate(starts, begin, group, lambda x: F.struct(x["current"].alias("current"), F.flatten(x["slots"]).alias("slots")))


def schedule(quotas: DataFrame, chunk_slots: int | None = None) -> DataFrame | None:
    """(source, share, block, slot, release, deadline) of every block, None if there is none. ``quotas``: see ``target_quotas``."""
    total = quotas.select(F.aggregate("sources", F.lit(0).cast("long"), lambda a, x: a + x["n_blocks"])).first()[0]
    state, plan, chunk_slots = quotas.withColumn("current", _begin()), None, chunk_slots or CHUNK_SLOTS
    for first in range(0, total, chunk_slots):
        step = state.select("sources", _schedule(first, min(chunk_slots, total - first)).alias("x"))
        state = cut(step.select("sources", "x.current", "x.slots"), "mix-slots")
        slots = state.select("sources", F.posexplode("slots").alias("at", "b")).select(
            F.get("sources", F.col("b.s")).alias("s"), (F.col("at") + F.lit(first).cast("long")).alias("slot"), "b")
        slots = slots.select("s.source", "s.share", F.col("b.k").alias("block"), "slot", "b.release", "b.deadline")
        plan = slots if plan is None else plan.union(slots)
    return plan


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, temperature: float = 0.5,
        frame_slots: int = FRAME_SLOTS, block_rows: int = BLOCK_ROWS, id_col: str = "doc_id", source_col: str = "source",
        carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, source, carried columns, quota, block, release, deadline, slot, row_in_block, position) of every row.

    ``position`` orders the mixture: slot x block_rows + row in block (gaps only after a source's last, partial
    block). ``release`` and ``deadline`` are the block's window in slots of the whole mixture. ``quota`` is the
    source's exact target in ``frame_slots`` slots. A null source is a
    source; null and repeated ids are kept; other columns are ignored; an empty table gives an empty result. Rows
    of a source are taken in hash order; rows with equal ids are interchangeable. Any number of sources is
    possible. No rows are dropped or repeated: a source that runs out leaves its share to the others.
    """
    if weights is not None and (not weights or min(weights.values()) <= 0):
        raise ValueError("weights must be positive")
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.xxhash64(F.col(id_col)).alias("h"),
                       *(F.col(c).alias(f"c{k}") for k, c in enumerate(carry)))
    rows = rows if carry else cut(rows, "mix-rows")
    counts = rows.groupBy("source").agg(F.count("*").alias("n_rows")).withColumn("source", F.col("source").cast("string"))
    plan = schedule(cut(target_quotas(counts, weights, temperature, block_rows), "mix-shares"))
    if plan is None:
        plan = docs.sparkSession.createDataFrame([], "source string, share double, block long, slot long, release long, deadline long")
    ranked = grouped_rank(rows.withColumn("source", F.col("source").cast("string")), "source", ["h", "id"], "rank")
    blocks = ranked.withColumn("_block", F.floor(F.col("rank") / block_rows)).withColumn("row_in_block", F.col("rank") % block_rows)
    placed = blocks.join(plan.withColumnRenamed("source", "_p"), blocks["source"].eqNullSafe(F.col("_p")) & (F.col("_block") == F.col("block")))
    return placed.select(F.col("id").alias(id_col), F.col("source").alias(source_col),
                         *(F.col(f"c{k}").alias(c) for k, c in enumerate(carry)), (F.col("share") * frame_slots).alias("quota"),
                         "block", "release", "deadline", "slot", "row_in_block",
                         (F.col("slot") * block_rows + F.col("row_in_block")).alias("position"))
