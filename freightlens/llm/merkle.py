"""A Merkle manifest of a table: leaves, roots and a proof for every row, by rolling nested structs up.

Rows get their rank in their group from a range partitioning and counts per partition. A rank is written in base three;
its digits are grouped away one after the other inside blocks of 81 consecutive nodes, and every grouping nests the child
structs, so a block ends as one row that holds its whole subtree. The roots of the blocks are the nodes of the next tier.
On the way down a tier's blocks meet the paths above them in one grouping by block; transforms walk the nested structs and
an explode emits a path for every node. No group holds more than 81 nodes, whatever share of the rows one group has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freightlens.llm.common import stage

ARITY, DIGITS = 3, 4
BLOCK = ARITY**DIGITS


def digest(*fields: Column) -> Column:
    """Lowercase hex SHA-256 of the fields one after the other: `-` for null, else UTF-8 byte count, `:`, value."""
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(f.cast("string")).cast("string"), F.lit(":"), f.cast("string")), F.lit("-")) for f in fields)), 256)


def ranked(nodes: DataFrame, order: list[str], name: str) -> DataFrame:
    """nodes with `rank`, from 0 in the order of its tree, and `n`, the number of the tree's nodes.

    Partitions are ranges of (tree, order), so a tree of any size is spread; the table is written with each row's place,
    and one small row per tree and partition tells how many nodes come before.
    """
    placed = stage(nodes.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order).withColumn("at", F.monotonically_increasing_id()), name)
    placed = placed.withColumn("part", F.shiftright("at", 33))
    parts = placed.groupBy("tree", "part").agg(F.min("at").alias("start"), F.count(F.lit(1)).alias("size"))
    whole = Window.partitionBy("tree")
    before = F.coalesce(F.sum("size").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("tree", "part", (before - F.col("start")).alias("shift"), F.sum("size").over(whole).alias("n"))
    return placed.join(parts, ["tree", "part"]).withColumn("rank", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def _levels(first: int) -> list[Column]:
    """For each of a tier's levels above level `first`: is there more than one node below it?"""
    return [F.col("n") > F.lit(ARITY ** (first + j)).cast("decimal(38,0)") for j in range(DIGITS)]


def rolled(nodes: DataFrame, first: int, name: str) -> DataFrame:
    """One row per block of 81 nodes (tree, n, rank, digest, item): the block's root and its nested children."""
    digits = [f"d{j}" for j in range(DIGITS)]
    t = nodes.select(
        "tree", "n", F.expr(f"rank div {BLOCK}").alias("block"), "digest", F.col("item").alias("inner"),
        *(F.expr(f"cast(rank div {ARITY**j} % {ARITY} as int)").alias(d) for j, d in enumerate(digits)),
    ).repartition("tree", "block")
    for j, more in enumerate(_levels(first)):
        t = t.groupBy("tree", "n", "block", *digits[j + 1 :]).agg(F.sort_array(F.collect_list(F.struct(F.col(digits[j]).alias("d"), "digest", "inner"))).alias("kids"))
        joined = F.sha2(F.array_join(F.transform("kids", lambda k: k["digest"]), ""), 256)
        t = t.withColumn("digest", F.when(more, joined).otherwise(F.col("kids")[0]["digest"])).withColumnRenamed("kids", "inner")
    return stage(t.select("tree", "n", "block", "digest", F.col("inner").alias("kids")), name)


def _step(kids: Column, place: Column) -> Column:
    def side(keep):
        return F.array_join(F.transform(F.filter(kids, lambda k: keep(k["d"])), lambda k: k["digest"]), "")

    return F.struct(side(lambda d: d < place).alias("before"), side(lambda d: d > place).alias("after"))


def _nodes(kids: Column, walked: Column, steps: list[Column], digits: int) -> Column:
    """An array of (rank in the block, digest, item, steps from the node to the block's root)."""

    def visit(kid):
        at = walked * ARITY + kid["d"]
        here = [_step(kids, kid["d"]), *steps]
        if digits == 1:
            return F.struct(at.alias("at"), kid["digest"].alias("digest"), kid["inner"].alias("item"), F.array(*here).alias("steps"))
        return _nodes(kid["inner"], at, here, digits - 1)

    seen = F.transform(kids, visit)
    return seen if digits == 1 else F.flatten(seen)


def paths_down(blocks: DataFrame, above: DataFrame, first: int) -> DataFrame:
    """(tree, rank, digest, item, path, top) of the nodes below a tier's blocks; above: (tree, block, path, top) of each block."""
    kids, path, top = (t.schema[c].dataType for t, c in ((blocks, "kids"), (above, "path"), (above, "top")))
    both = blocks.select("tree", "block", "n", "kids", F.lit(None).cast(path).alias("path"), F.lit(None).cast(top).alias("top"))
    both = both.union(above.select("tree", "block", F.lit(None).cast("long").alias("n"), F.lit(None).cast(kids).alias("kids"), "path", "top"))
    met = both.groupBy("tree", "block").agg(*(F.first(c, ignorenulls=True).alias(c) for c in ("n", "kids", "path", "top")))
    depth = sum((more.cast("int") for more in _levels(first)[1:]), _levels(first)[0].cast("int"))
    node = F.explode(_nodes(F.col("kids"), F.lit(0), [], DIGITS))
    out = met.select("tree", "block", "path", "top", depth.alias("depth"), node.alias("node"))
    return out.select(
        "tree", (F.col("block") * BLOCK + F.col("node.at")).alias("rank"), "node.digest", "node.item",
        F.concat(F.slice("node.steps", 1, F.col("depth")), "path").alias("path"), "top",
    )


def forest(nodes: DataFrame, name: str) -> list[DataFrame]:
    """The tiers of blocks above the nodes (tree, rank, n, digest, item), lowest first; each tree ends as one block."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    tiers: list[DataFrame] = []
    while not tiers or BLOCK ** len(tiers) < most:
        tiers.append(rolled(nodes, DIGITS * len(tiers), f"{name}-tier"))
        nodes = tiers[-1].select("tree", "n", F.col("block").alias("rank"), "digest", F.lit(None).cast("string").alias("item"))
    return tiers


PATH = "array<struct<before:string,after:string>>"


def merkle_manifest(rows: DataFrame, key: str = "doc_id", group: str = "source", fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), shown: dict[str, Column] | None = None) -> DataFrame:
    """Per row: the key, `leaf`, `shown`, `subroot`, `root` and `path`, the siblings before and after the row's node at each level.

    A leaf is the digest of the fields. Per group (null is a group, the first) leaves ascend by key, nulls first, then by
    leaf, so repeated rows have a defined place; every three consecutive nodes become the digest of their hex digests until
    one remains, the subroot. Subroots in bytewise order of their group give the root in the same way. `shown` is the leaf
    of the row with the given columns in place of its own, or null where it is the same. Further columns are not read. An
    empty table gives no rows; null fields have their own mark in a leaf, so they differ from empty ones.
    """
    leaf = digest(*(F.col(f) for f in fields))
    seen = digest(*((shown or {}).get(f, F.col(f)) for f in fields))
    leaves = rows.select(
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("tree"), F.col(key).alias("key"), leaf.alias("digest"),
        (seen if shown else F.lit(None).cast("string")).alias("shown"),
    ).withColumn("shown", F.nullif("shown", "digest"))
    leaves = ranked(stage(leaves, "merkle-leaves"), ["key", "digest"], "merkle-ranked")
    tiers = forest(leaves.select("tree", "rank", "n", "digest", F.struct("key", "shown").alias("item")), "merkle")

    tops = tiers[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    tops = ranked(tops, ["name"], "merkle-tops").select("tree", "rank", "n", "digest", F.col("name").alias("item"))
    upper = forest(tops, "merkle-top")
    at = upper[-1].select("tree", "block", F.lit(None).cast(PATH).alias("path"), F.struct(F.lit("").alias("subroot"), F.col("digest").alias("root")).alias("top"))
    at = at.withColumn("path", F.array().cast(PATH))
    for k in reversed(range(len(upper))):
        at = paths_down(upper[k], at, DIGITS * k).withColumnRenamed("rank", "block")
    at = at.select(F.col("item").alias("tree"), F.lit(0).cast("long").alias("block"), "path", F.struct(F.col("digest").alias("subroot"), F.col("top.root").alias("root")).alias("top"))
    for k in reversed(range(len(tiers))):
        at = paths_down(tiers[k], at, DIGITS * k).withColumnRenamed("rank", "block")
    return at.select(F.col("item.key").alias(key), F.col("digest").alias("leaf"), F.col("item.shown").alias("shown"), "top.subroot", "top.root", "path")


def folded(path: Column, leaf: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(F.concat(step["before"], node, step["after"]), 256))


def proof_digest(path: Column) -> Column:
    """The digest of all siblings on the way, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), ""), 256)
