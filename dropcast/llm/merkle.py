"""Merkle manifest of a table, with the proof of every row found by pointer jumping.

A row's leaf is the digest of its fields. The leaves of a source, in the order of their ids, are hashed in runs of
``ARITY`` consecutive nodes, level by level, until one node is left: the source's subroot. The subroots, in the order
of the sources, are the leaves of a second tree of the same kind, whose last node is the root.

Every node holds a segment, the siblings on its way to an ancestor: at first to its parent. A round joins the table of
nodes with itself, node to ancestor, so that the distance doubles and the segments are concatenated. A node on level l
is asked for by nodes 2**r levels below it only, so that after round r the levels that 2**r divides are left, and the
table shrinks as the segments grow. When the distance exceeds the height, every leaf's segment reaches the root.

Defined results: a null field counts as ``-``, a null or empty text is a leaf like any other, null sources are a source
of their own (the first), null ids come first within their source, rows that share an id stand in the order of their
digests, and equal rows are leaves of their own (they are interchangeable). An empty table has no rows and no root.
Only the fields named are read: other columns, whatever their names, do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rank import ranked
from .common import cut

ARITY = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BROADCAST_BYTES = 16 << 20
_POWERS = [ARITY ** k for k in range(39)]
_SOURCES = ""  # name of the tree over the sources; those of the sources start with "-" (null) or "="


def leaf_digest(*values: Column) -> Column:
    """Digest of a row: every value as the number of its UTF-8 bytes, a colon and the value; ``-`` for null."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts)), 256)


def fold(start: Column, proof: Column) -> Column:
    """Root that follows from a leaf's digest and its proof."""
    return F.aggregate(proof, start, lambda digest, run: F.sha2(F.concat(_hex(run["before"]), digest, _hex(run["after"])), 256))


def proof_digest(proof: Column) -> Column:
    """Digest of all siblings of a proof, level by level, left to right."""
    return F.sha2(F.concat_ws("", F.transform(proof, lambda run: F.concat(_hex(run["before"]), _hex(run["after"])))), 256)


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _height(n: Column) -> Column:
    """Levels above n nodes: the least h with ARITY**h >= n."""
    return F.size(F.filter(F.array(*(F.lit(p).cast("long") for p in _POWERS)), lambda p: p < n))


def _tree(nodes: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame, int]:
    """Levels of the trees over nodes(tree, pos, height, digest, row), grown all at once.

    Returns, for each level k, the written runs(tree, up, height, members, digest) of its nodes, digest being that of
    the parent; the tops(tree, digest, row); and the greatest height. A level has a third of the nodes of the one below.
    """
    level, runs = nodes, []
    tallest = nodes.agg(F.max("height")).first()[0] or 0
    tops = nodes.where("height = 0").select("tree", "digest", "row")
    for k in range(tallest):
        members = F.sort_array(F.collect_list(F.struct("pos", "digest", "row")))
        grouped = (level.where(F.col("height") > k).withColumn("up", F.floor(F.col("pos") / ARITY))
                   .groupBy("tree", "height", "up").agg(members.alias("members")))  # at most ARITY members
        text = F.concat_ws("", F.transform("members", lambda m: _hex(m["digest"])))
        runs.append(cut(grouped.withColumn("digest", F.unhex(F.sha2(text, 256))), f"{name}-{k}"))
        level = runs[-1].select("tree", F.col("up").alias("pos"), "height", "digest", F.lit(None).cast(nodes.schema["row"].dataType).alias("row"))
        tops = tops.unionByName(level.where(F.col("height") == k + 1).drop("pos", "height"))
    return runs, tops, tallest


def _siblings(runs: DataFrame) -> DataFrame:
    """Members of written runs: (tree, height, up, pos, digest, row, segment to the parent)."""
    def joined(part: Column) -> Column:
        return F.unhex(F.concat_ws("", F.transform(part, lambda m: F.hex(m["digest"]))))

    at = runs.select("tree", "height", "up", "members", F.posexplode("members").alias("k", "m"))
    before = joined(F.slice("members", F.lit(1), F.col("k")))
    after = joined(F.slice("members", F.col("k") + 2, F.lit(ARITY)))
    return at.select("tree", "height", "up", "m.pos", "m.digest", "m.row",
                     F.array(F.struct(before.alias("before"), after.alias("after"))).alias("segment"))


def _node(tree: Column, level: Column, pos: Column) -> Column:
    return F.struct(tree.alias("tree"), level.cast("int").alias("level"), pos.cast("long").alias("pos"))


def _top(tree: Column) -> Column:
    """The subroot of a source, as a node (level -1, place 0)."""
    return _node(tree, F.lit(-1), F.lit(0))


def _jump(nodes: DataFrame, above: DataFrame, reach: int) -> DataFrame:
    """``nodes`` with their ancestors replaced by the ancestors' ancestors, ``reach`` levels further up."""
    width = 160 * reach + 120  # bytes of a node and the siblings on ``reach`` levels
    step = above.select(F.col("node").alias("via"), F.col("ancestor").alias("next"), F.col("segment").alias("rest"), F.col("subroot").alias("passed"))
    step = F.broadcast(step) if above.count() * width <= BROADCAST_BYTES else step
    kept = [c for c in nodes.columns if c not in ("ancestor", "segment", "subroot")]
    return nodes.join(step, F.col("ancestor") == F.col("via"), "left").select(
        *kept, F.coalesce("next", "ancestor").alias("ancestor"),
        F.when(F.col("rest").isNull(), F.col("segment")).otherwise(F.concat("segment", "rest")).alias("segment"),
        F.coalesce("subroot", "passed").alias("subroot"))


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", source_col: str = "source",
             **checked: Column) -> DataFrame:
    """(id, source, leaf, further digests, subroot, root, proof) of every row of ``docs``.

    ``proof`` is an array of (before, after), one entry for each level from the leaf to the root: the joined binary
    digests of the siblings left and right of the node on the way. ``checked`` are further columns by name, expressions
    over ``docs`` that are carried along: a digest of what is found in a copy of the row, to be folded with its proof.
    """
    spark = docs.sparkSession
    source = F.col(source_col).cast("string")
    rows = docs.select(F.coalesce(F.concat(F.lit("="), source), F.lit("-")).alias("tree"), F.col(id_col).alias("id"),
                       F.unhex(leaf_digest(*(F.col(f) for f in fields))).alias("digest"),
                       F.struct(F.col(id_col).alias("id"), *(c.alias(name) for name, c in checked.items())).alias("row"),
                       F.monotonically_increasing_id().alias("nth"))  # spreads equal rows over the ranges
    placed = ranked(rows, ["id", "digest", "nth"], ["tree"], rank_col="place", size_col="n").select(
        "tree", (F.col("place") - 1).alias("pos"), _height(F.col("n")).alias("height"), "digest", "row")
    runs, tops, tallest = _tree(placed, "merkle")
    sources = cut(ranked(tops, ["tree"], rank_col="place", size_col="n").select(
        F.lit(_SOURCES).alias("tree"), (F.col("place") - 1).alias("pos"), _height(F.col("n")).alias("height"), "digest", F.col("tree").alias("row")), "merkle-subroots")
    upper, last, higher = _tree(sources, "merkle-sources")
    root = last.select("digest").first()

    # the upper tree: its leaves are known as subroots, its last node is the root and has no ancestor
    nodes = _no_nodes(spark)
    for k, level in enumerate(upper):
        of = _siblings(level)
        nodes = nodes.unionByName(of.select(
            _top(F.col("row")).alias("node") if k == 0 else _node(F.col("tree"), F.lit(k), F.col("pos")).alias("node"),
            _node(F.col("tree"), F.lit(k + 1), F.col("up")).alias("ancestor"), "segment",
            (F.col("digest") if k == 0 else F.lit(None).cast("binary")).alias("subroot")))
    parent = [F.when(F.col("height") == k + 1, _top(F.col("tree"))).otherwise(_node(F.col("tree"), F.lit(k + 1), F.col("up"))) for k in range(tallest)]
    for k, level in enumerate(runs[1:], 1):
        nodes = nodes.unionByName(_siblings(level).select(_node(F.col("tree"), F.lit(k), F.col("pos")).alias("node"), parent[k].alias("ancestor"),
                                                          "segment", F.lit(None).cast("binary").alias("subroot")))
    nothing = F.array().cast("array<struct<before: binary, after: binary>>")
    columns = ["tree", F.col("digest").alias("leaf"), "row"]
    leaves = placed.where("height = 0").select(*columns, _top(F.col("tree")).alias("ancestor"), nothing.alias("segment"))
    if runs:
        leaves = leaves.unionByName(_siblings(runs[0]).select(*columns, parent[0].alias("ancestor"), "segment"))
    leaves = leaves.withColumn("subroot", F.lit(None).cast("binary"))

    reach = 1
    nodes = cut(nodes, "merkle-jump")
    while True:  # ancestors are ``reach`` levels up, or the root
        leaves = _jump(leaves, nodes, reach)
        if 2 * reach > tallest + higher:
            break
        level = F.col("node.level")
        needed = (F.col("node.tree") == _SOURCES) | (level < 0) | (level % (2 * reach) == 0)
        nodes = cut(_jump(nodes.where(needed), nodes, reach), "merkle-jump")
        reach *= 2

    digest = F.lit(bytes(root[0]) if root else None).cast("binary")
    return leaves.select(F.col("row.id").alias(id_col), F.when(F.col("tree") != "-", F.substring("tree", 2, 1 << 30)).alias(source_col),
                         _hex(F.col("leaf")).alias("leaf"), *(F.col(f"row.{name}") for name in checked),
                         _hex(F.coalesce("subroot", digest)).alias("subroot"), _hex(digest).alias("root"), F.col("segment").alias("proof"))


def _no_nodes(spark: SparkSession) -> DataFrame:
    node = "struct<tree: string, level: int, pos: bigint>"
    return spark.createDataFrame([], f"node {node}, ancestor {node}, segment array<struct<before: binary, after: binary>>, subroot binary")


def without_newlines(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", text_col: str = "text") -> Column:
    """Leaf digest of a row as a copy holds it that lost the text's line feeds, in the rows whose id as decimal text has
    an even crc32; all other rows (null ids too) are unchanged."""
    lost = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 2 == 0, F.lit(False))
    text = F.when(lost, F.replace(F.col(text_col), F.lit("\n"), F.lit(""))).otherwise(F.col(text_col))
    return leaf_digest(*(text if f == text_col else F.col(f) for f in fields))


def verify_copy(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified): the manifest of ``docs``, checked against
    the copy of ``without_newlines``; folded_root follows from the copy's leaf and the manifest's proof."""
    found = manifest(docs, copy=F.unhex(without_newlines(docs)))
    return found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"),
                        fold(_hex(F.col("copy")), F.col("proof")).alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
