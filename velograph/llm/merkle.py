"""Merkle manifest of a table by sibling-shift self-joins (operator 11).

Each row is a leaf, the digest of its fields. The leaves of a group, in the given
order, are numbered; every ``fanout`` consecutive nodes are a run and become their
parent, level by level, until one node, the group's root, is left. The group
roots, in group order, are the leaves of one more tree, whose root covers all.

A level is one table (group, index, digest). It is equijoined with itself on
(group, index of a sibling): the index XOR 1 for two children, otherwise that of the slot
1, 2, .. places on, modulo ``fanout``, in the same run. Every node has its siblings'
digests then, and rows of slot zero emit the parents. Going down again, each node's
path is its own siblings followed by its parent's path, an equijoin on (group, index).
Nodes shrink by ``fanout`` a level, so all levels together cost about as much as the
first; keys are unique, so a large group is no hot key. Every level is a written table.

H is the lower-case hex sha256 of its inputs concatenated, digests as hex text; a
field enters as ``-`` if null, else its UTF-8 byte count, ``:`` and its text.

Defined results: the null group is one of its own and comes first, others follow by
UTF-8 bytes; null order values come first. Rows equal in group, order and leaf stand
side by side, each a leaf of its own. A lone leaf is its group's root, a lone group's
root the root; an empty table has no rows. Names of input columns cannot clash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from velograph.llm.scratch import Scratch
from velograph.operators.windows import numbered

FANOUT = 3
STEP = "array<struct<left:binary,right:binary>>"


def _nothing() -> Column:
    return F.lit(bytearray())


def hexed(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def leaf(fields: list[Column]) -> Column:
    """Hex digest of a row's fields."""
    parts = []
    for field in fields:
        text = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def fold(start: Column, path: Column) -> Column:
    """The root that a (hex) leaf and the siblings of its path give."""
    return F.aggregate(path, start, lambda acc, step: F.sha2(F.concat(hexed(step["left"]), acc, hexed(step["right"])), 256))


def proof(path: Column) -> Column:
    """H of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: hexed(F.concat(step["left"], step["right"]))), ""), 256)


def with_siblings(nodes: DataFrame, fanout: int) -> DataFrame:
    """``nodes`` (g, idx, n, digest, ..) of groups with more than one, with the digests of
    their run's other nodes to the ``left`` and ``right``."""
    slot = F.col("idx") % fanout
    out = nodes.where("n > 1")
    for shift in range(1, fanout):
        sibling = F.col("idx").bitwiseXOR(F.lit(1)) if fanout == 2 else F.col("idx") - slot + (slot + shift) % fanout
        other = nodes.select(F.col("g").alias("other_g"), F.col("idx").alias("other_idx"), F.col("digest").alias(f"digest_{shift}"))
        out = out.join(other, (F.col("g") == F.col("other_g")) & (sibling == F.col("other_idx")), "left").drop("other_g", "other_idx")
    found = [f"digest_{shift}" for shift in range(1, fanout)]
    at = [F.coalesce(F.get(F.array(*found), (F.pmod(F.lit(j) - slot, F.lit(fanout)) - 1).cast("int")), _nothing()) for j in range(fanout)]
    left = F.concat(*(F.when(slot > j, at[j]).otherwise(_nothing()) for j in range(fanout)))
    right = F.concat(*(F.when(slot < j, at[j]).otherwise(_nothing()) for j in range(fanout)))
    return out.withColumns({"left": left, "right": right}).drop(*found)


def parents(level: DataFrame, fanout: int) -> DataFrame:
    """Slot zero of each run as its parent."""
    run = F.concat("digest", "right")
    return level.where((F.col("idx") % fanout == 0) & (F.col("n") > 1)).select(
        "g", F.floor(F.col("idx") / fanout).alias("idx"), F.ceil(F.col("n") / fanout).alias("n"), F.unhex(F.sha2(hexed(run), 256)).alias("digest"))


def climb(scratch: Scratch, leaves: DataFrame, fanout: int, name: str) -> list[DataFrame]:
    """All levels of a forest from its leaves (g, idx, n, digest, ..) up: tables with
    ``left`` and ``right``, null for the single node of a group."""
    nodes, levels = scratch.write(leaves, f"{name}-nodes-0"), []
    most = nodes.agg(F.max("n").alias("n")).first().n or 0
    while True:
        single = nodes.where("n = 1").withColumns({"left": F.lit(None).cast("binary"), "right": F.lit(None).cast("binary")})
        level = with_siblings(nodes, fanout).unionByName(single) if most > 1 else single
        levels.append(scratch.write(level, f"{name}-level-{len(levels)}"))
        if most <= 1:
            return levels
        most = -(-most // fanout)
        nodes = levels[-1].transform(parents, fanout)


def roots(levels: list[DataFrame]) -> DataFrame:
    """(g, digest) of every group."""
    return reduce(DataFrame.unionByName, (level.where("n = 1").select("g", "digest") for level in levels))


def descend(scratch: Scratch, levels: list[DataFrame], above: DataFrame | None, fanout: int, name: str, *carry: str) -> DataFrame:
    """(g, idx, digest, path, subroot, root, ..carry) of the leaves. ``above`` has, for
    each group, the path and root over its own root (g, path, root); without it, that
    root is the root."""
    down = None
    for k in reversed(range(len(levels))):
        extra = carry if k == 0 else ()
        top = levels[k].where("n = 1")
        if above is None:
            top = top.select("g", "idx", "digest", F.array().cast(STEP).alias("path"), F.col("digest").alias("subroot"), F.col("digest").alias("root"), *extra)
        else:
            over = above.select(F.col("g").alias("over_g"), "path", "root")
            top = (top.join(over, F.col("g") == F.col("over_g"))
                   .select("g", "idx", "digest", "path", F.col("digest").alias("subroot"), "root", *extra))
        if down is None:
            out = top
        else:
            over = down.select(F.col("g").alias("over_g"), F.col("idx").alias("over_idx"), F.col("path").alias("over_path"), "subroot", "root")
            own = F.array(F.struct("left", "right")).cast(STEP)
            out = (levels[k].where("n > 1").join(over, (F.col("g") == F.col("over_g")) & (F.floor(F.col("idx") / fanout) == F.col("over_idx")))
                   .select("g", "idx", "digest", F.concat(own, "over_path").alias("path"), "subroot", "root", *extra).unionByName(top))
        down = out if k == 0 else scratch.write(out, f"{name}-paths-{k}")
    return down


def manifest(rows: DataFrame, group: Column, order: list[Column], fields: list[Column], carry: dict[str, Column] | None = None,
             fanout: int = FANOUT) -> DataFrame:
    """One row per row of ``rows``: the ``carry`` columns, ``leaf``, ``subroot`` and ``root``
    (hex) and ``path``: a struct per level with the digests of the siblings to the
    ``left`` and ``right``, from the leaf's level to the top."""
    if fanout < 2:
        raise ValueError("fanout must be at least 2")
    scratch = Scratch(rows.sparkSession, "merkle")
    carry = carry or {}
    kept, by = [f"carry_{i}" for i in range(len(carry))], [f"order_{i}" for i in range(len(order))]
    # a prefix keeps the null group apart and first
    groups = F.coalesce(F.concat(F.lit("1"), group.cast("string")), F.lit("0"))
    leaves = scratch.write(rows.select(
        groups.alias("group"), *(o.alias(b) for o, b in zip(order, by, strict=True)), F.unhex(leaf(fields)).alias("digest"),
        *(c.alias(k) for c, k in zip(carry.values(), kept, strict=True))), "leaves")
    # the written table's row number spreads rows that are equal in all else
    leaves = leaves.withColumn("row", F.monotonically_increasing_id())
    placed = numbered(leaves, ["group", *by, "digest", "row"]).drop("row", *by)
    spans = scratch.write(placed.groupBy("group").agg(F.min("position").alias("first"), F.count("*").alias("n")), "groups")
    spans = scratch.write(numbered(spans, ["group"]).withColumn("g", F.col("position") - 1).drop("position"), "group-numbers")
    placed = placed.join(spans, "group").select("g", (F.col("position") - F.col("first")).alias("idx"), "n", "digest", *kept)
    levels = climb(scratch, placed, fanout, "rows")
    n_groups = spans.count()
    tops = roots(levels).select(F.lit(0).cast("bigint").alias("g"), F.col("g").alias("idx"), F.lit(n_groups).cast("bigint").alias("n"), "digest")
    over = descend(scratch, climb(scratch, tops, fanout, "groups"), None, fanout, "groups")
    over = scratch.write(over.select(F.col("idx").alias("g"), "path", "root"), "group-paths")
    out = descend(scratch, levels, over, fanout, "rows", *kept)
    return out.select(*kept, hexed(F.col("digest")).alias("leaf"), hexed(F.col("subroot")).alias("subroot"), hexed(F.col("root")).alias("root"), "path").toDF(
        *carry, "leaf", "subroot", "root", "path")
