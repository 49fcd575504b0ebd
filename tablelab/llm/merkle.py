"""Merkle manifest of a table: a tree per group, a root over the groups, a proof per row.

Every row is a leaf, the digest of its fields.  Leaves of a group stand in order; every
``FAN`` consecutive nodes become one node, until one is left, the group's subroot.  The
subroots, in the order of their groups, become the root in the same way.

Leaves are numbered within their group by a range sort: partitions count their rows,
and the counts' running sums are the offsets, so no group is ordered by one task.  Then
blocks of ``FAN ** BLOCK_LEVELS`` consecutive nodes are windows.  Within a block, level by
level, lag and lead at fixed offsets supply the siblings; they are masked by the slot a
node has in its run and by the length of the run, and rows of first children hash the
parents.  All levels of a block share one shuffle and one sort.  The blocks' tops are
the nodes of the next tier, a table ``FAN ** BLOCK_LEVELS`` times smaller, and so on.
Proofs of a tier are joined with those of the tier above by block.

Only digests and numbers are shuffled, never texts.  Tiers are written to the shared
folder, which cuts lineage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablelab.llm.common import col, settled

FAN = 8
BLOCK_LEVELS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """SHA-256 of texts or binary data, one after another: 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[p.cast("binary") for p in parts]), 256))


def node(*children: Column) -> Column:
    """The digest of nodes: of their lower-case hexadecimal text."""
    return digest(F.lower(F.hex(F.concat(*children))))


def encoded(value: Column) -> Column:
    """``-`` for null, else the value's bytes in UTF-8, counted: ``count:value``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(fields: Sequence[Column]) -> Column:
    return digest(*[encoded(f) for f in fields])


def lower_ascii(value: Column) -> Column:
    """A-Z lower-cased, all else kept."""
    return F.translate(value, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def text(binary: Column) -> Column:
    """A digest as lower-case hexadecimal text."""
    return F.lower(F.hex(binary))


def numbered(nodes: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``nodes`` with ``pos``, each row's number within its group ``g``, and ``n``, the group's size.

    Rows are sorted by range over group and order, so a large group lies in many partitions."""
    keys = ["g", *order]
    ranged = nodes.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = settled(ranged.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), name)
    w = Window.partitionBy("g").orderBy("part")
    # A row per group and partition: the group's first place there and what lies before.
    starts = settled(
        placed.groupBy("g", "part")
        .agg(F.min("at").alias("first"), F.count("*").alias("rows"))
        .withColumn("before", F.sum("rows").over(w) - F.col("rows"))
        .withColumn("n", F.sum("rows").over(Window.partitionBy("g")))
        .drop("rows"),
        f"{name}-starts",
    )
    joined = placed.join(starts, ["g", "part"])
    return joined.withColumn("pos", F.col("at") - F.col("first") + F.col("before")).drop("part", "at", "first", "before")


def _levels(nodes: DataFrame) -> DataFrame:
    """``(g, pos, n, h, ...)`` with the block, ``path`` through the block's levels and ``top``, the block's node.

    ``path`` has a struct(l, r) for each level that exists: the nodes left and right of
    the row's own ancestor in its run.  ``top`` is set on a block's first row only.
    """
    size = FAN**BLOCK_LEVELS
    nodes = nodes.withColumn("block", F.floor(F.col("pos") / size).cast("long"))
    w = Window.partitionBy("g", "block").orderBy("pos")
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    nodes, empty = nodes.withColumn("top", F.col("h")), F.lit(b"")
    for level in range(BLOCK_LEVELS):
        step = FAN**level
        # Nodes of this level stand on the rows of their first leaf: ``step`` rows apart.
        count = F.ceil(F.col("n") / step).cast("long")
        place = F.floor(F.col("pos") / step).cast("long")
        slot, run = place % FAN, F.least(F.lit(FAN), count - (place - place % FAN))
        stands = (F.col("pos") % step == 0) & (count > 1)
        left = [F.when(slot >= k, F.lag("top", k * step).over(w)).otherwise(empty) for k in range(FAN - 1, 0, -1)]
        right = [F.when(slot + k < run, F.lead("top", k * step).over(w)).otherwise(empty) for k in range(1, FAN)]
        nodes = nodes.withColumns({"l": F.when(stands, F.concat(*left)), "r": F.when(stands, F.concat(*right))})
        parent = F.when(count == 1, F.col("top")).when(stands & (slot == 0), node(F.col("top"), F.col("r")))
        # The siblings of a node are those of all rows below it.
        below = F.struct(F.last("l", True).over(so_far).alias("l"), F.last("r", True).over(so_far).alias("r"))
        step_of = F.when(count > 1, F.struct("l", "r") if level == 0 else below)
        nodes = nodes.withColumns({f"p{level}": step_of, "top": parent}).drop("l", "r")
    path = F.filter(F.array(*[F.col(f"p{level}") for level in range(BLOCK_LEVELS)]), lambda p: p.isNotNull())
    return nodes.withColumn("path", path).drop(*[f"p{level}" for level in range(BLOCK_LEVELS)])


def tree(nodes: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """The tops, ``(g, h)``, a row per group; and ``nodes`` with ``path`` from each to its group's ``top``."""
    size = FAN**BLOCK_LEVELS
    spark, tiers = nodes.sparkSession, []
    most = nodes.agg(F.max("n")).first()[0] or 0
    while True:
        tiers.append(_levels(nodes))
        tops = tiers[-1].where(F.col("top").isNotNull() & (F.col("pos") % size == 0))
        tops = settled(
            tops.select("g", F.col("block").alias("pos"), F.ceil(F.col("n") / size).cast("long").alias("n"), F.col("top").alias("h")),
            f"{name}-tier-{len(tiers)}",
        )
        most = -(-most // size)
        if most <= 1:
            break
        nodes = tops
    # A group's last top, and from there down the rest of each block's path.
    above = tops.select("g", F.col("pos").alias("block"), F.col("h").alias("last"), F.array().cast("array<struct<l:binary,r:binary>>").alias("rest"))
    for k, tier in reversed(list(enumerate(tiers))):
        joined = tier.drop("top").join(above, ["g", "block"]).withColumn("path", F.concat("path", "rest")).drop("rest", "block")
        joined = joined.withColumnRenamed("last", "top")
        if k:
            above = settled(
                joined.select("g", F.col("pos").alias("block"), F.col("top").alias("last"), F.col("path").alias("rest")),
                f"{name}-paths-{k}",
            )
    return tops.select("g", "h"), joined


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, leaf, lambda acc, p: node(p["l"], acc, p["r"]))


def proof(path: Column) -> Column:
    """The digest of all siblings on a path, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda p: text(F.concat(p["l"], p["r"]))), ""))


def manifest(
    df: DataFrame,
    id_col: str = "doc_id",
    group_col: str = "lang",
    fields: Sequence[str] = FIELDS,
    altered: dict[str, Column] | None = None,
    where: Column | None = None,
) -> DataFrame:
    """``(id, group, leaf, subroot, root, path, seen_leaf)`` for each row of ``df``; digests are 32 bytes.

    ``seen_leaf`` is the leaf of the row as ``altered`` shows it (column name to expression)
    where ``where`` holds, else the leaf itself: what a reader checks against the manifest.

    A null field counts as ``-``, apart from the empty text ``0:``.  The null group is a
    group, first in order; groups go by the bytes of their names.  Within a group rows go
    by id (null first, whole numbers), then by leaf, so repeated rows stand side by side
    and the tree doesn't depend on the order of the input.  An empty table gives no rows.
    Other columns of ``df`` are neither digested nor returned, and may have any names.
    """
    altered = altered or {}
    leaf = leaf_of([col(f) for f in fields])
    seen = leaf_of([altered.get(f, col(f)) for f in fields]) if altered else F.lit(None).cast("binary")
    if where is not None:
        seen = F.when(where, seen)
    # The null group sorts before the empty name, and no join key is null.
    group = F.coalesce(F.concat(F.lit("="), col(group_col).cast("string")), F.lit(""))
    leaves = settled(df.select(col(id_col).cast("long").alias("id"), group.alias("g"), leaf.alias("h"), seen.alias("seen")), "leaves")
    subroots, rows = tree(numbered(leaves, ["id", "h"], "leaves-in-order"), "groups")
    subroots = subroots.select(F.col("g").alias("group"), F.lit("").alias("g"), "h")
    _, crown = tree(numbered(subroots, ["group"], "subroots-in-order"), "crown")
    crown = settled(crown.select(F.col("group").alias("g"), F.col("top").alias("root"), F.col("path").alias("rest")), "crown")
    joined = rows.join(crown, "g")
    return joined.select(
        "id", F.when(F.col("g") != "", F.substring("g", 2, 1 << 30)).alias("group"), F.col("h").alias("leaf"),
        F.col("top").alias("subroot"), "root", F.concat("path", "rest").alias("path"), F.coalesce("seen", "h").alias("seen_leaf"),
    )


def verify(rows: DataFrame) -> DataFrame:
    """Rows of ``manifest`` with digests as text: the proof, the root that what was seen folds to, and whether it is the root."""
    back = folded(F.col("seen_leaf"), F.col("path"))
    return rows.withColumns({"folded_root": back, "proof_sha256": proof(F.col("path"))}).select(
        "id", "group", *[text(F.col(c)).alias(c) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")],
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
