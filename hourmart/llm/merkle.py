"""Merkle manifest of a dataset: one tree a group, one tree over the groups' roots, a proof a row."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourmart.llm.common import Scratch, global_rank, tuned

#: Nodes of one run, and characters of a digest.
FANOUT, WIDTH = 16, 64
#: Nodes of an aligned block: two levels of runs.
BLOCK = FANOUT * FANOUT


def field(column: Column) -> Column:
    """``-`` for null, else the value's UTF-8 bytes after their number and a colon."""
    value = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(columns: Iterable[Column]) -> Column:
    """Hex SHA-256 of the fields of a row."""
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def path_digest(path: Column) -> Column:
    """Hex SHA-256 of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def _parents(level: Column) -> Column:
    """The level above one that is a string of digests."""
    last = F.floor((F.length(level) - 1) / (WIDTH * FANOUT)).cast("int")
    runs = F.sequence(F.lit(0), last)
    start = WIDTH * FANOUT
    return F.array_join(
        F.transform(runs, lambda k: F.sha2(F.substr(level, k * start + 1, F.lit(start)), 256)), ""
    )


def _siblings(level: Column, place: Column) -> Column:
    """What flanks the digest at ``place`` in its run of the level."""
    inside = F.pmod(place, F.lit(FANOUT))
    left = F.substr(level, (place - inside) * WIDTH + 1, inside * WIDTH)
    right = F.substr(level, (place + 1) * WIDTH + 1, (FANOUT - 1 - inside) * WIDTH)
    return F.struct(left.alias("left"), right.alias("right"))


def _segments(place: Column) -> Column:
    """Siblings of a node inside its block, for as many levels as the block has."""
    above = F.floor(place / FANOUT).cast("int")
    both = F.array(_siblings(F.col("level0"), place), _siblings(F.col("level1"), above))
    return F.slice(both, 1, F.col("steps"))


def _blocks(nodes: DataFrame) -> DataFrame:
    """Blocks of (tree, pos, n, node, row): their levels as strings and the digest on top.

    ``n`` is the number of nodes that the tree has at this height.  A tree of one
    node has no level above, one of a single run has one, others fill two.
    """
    pos = F.pmod("pos", F.lit(BLOCK)).cast("int").alias("place")
    grouped = (
        nodes.select("tree", F.floor(F.col("pos") / BLOCK).alias("block"), "n", F.struct(pos, "node", "row").alias("m"))
        .groupBy("tree", "block")
        .agg(F.first("n").alias("n"), F.array_sort(F.collect_list("m")).alias("members"))
    )
    steps = F.when(F.col("n") == 1, 0).when(F.col("n") <= FANOUT, 1).otherwise(2)
    strung = grouped.select(
        "tree", "block", "n", "members", steps.alias("steps"), F.array_join("members.node", "").alias("level0")
    )
    first = strung.withColumn("level1", F.when(F.col("steps") >= 1, _parents(F.col("level0"))))
    second = first.withColumn("level2", F.when(F.col("steps") >= 2, _parents(F.col("level1"))))
    return second.withColumn("top", F.coalesce("level2", "level1", "level0")).drop("level2")


def _climb(nodes: DataFrame, most: int, scratch: Scratch, name: str) -> list[DataFrame]:
    """Stored blocks of every height, until each tree is down to one block."""
    heights = []
    while True:
        blocks = scratch.store(_blocks(nodes), f"{name}{len(heights)}")
        heights.append(blocks)
        most = -(-most // BLOCK)
        if most <= 1:
            return heights
        nodes = blocks.select(
            "tree",
            F.col("block").alias("pos"),
            F.ceil(F.col("n") / BLOCK).alias("n"),
            F.col("top").alias("node"),
            F.lit(None).cast("string").alias("row"),
        )


def _descend(heights: list[DataFrame], above: DataFrame) -> DataFrame:
    """Paths of the lowest height's members from ``above``: (tree, path, context) of each tree's top."""
    paths = above.select("tree", F.lit(0).cast("long").alias("pos"), "path", "context")
    for blocks in reversed(heights):
        parents = paths.select("tree", F.col("pos").alias("block"), F.col("path").alias("above"), "context")
        member = F.explode("members").alias("m")
        joined = blocks.join(parents, ["tree", "block"])
        opened = joined.select("tree", "block", "steps", "level0", "level1", "above", "context", member)
        paths = opened.select(
            "tree",
            (F.col("block") * BLOCK + F.col("m.place")).alias("pos"),
            F.concat(_segments(F.col("m.place")), "above").alias("path"),
            "context",
            F.col("m.node").alias("node"),
            F.col("m.row").alias("row"),
        )
    return paths


@dataclass(frozen=True)
class Manifest:
    """A dataset's root (None without rows), its groups' roots and the stored levels."""

    root: str | None
    #: (tree, group, rows, subroot)
    groups: DataFrame
    _heights: list[DataFrame]
    _tops: list[DataFrame]

    def proofs(self) -> DataFrame:
        """Every row's carried columns, ``leaf``, ``subroot``, ``root`` and ``path``.

        ``path`` lists the siblings level by level as (left, right) strings of digests.
        """
        spark = self.groups.sparkSession
        start = spark.createDataFrame([(0,)], "tree long").select(
            "tree",
            F.array().cast("array<struct<left:string,right:string>>").alias("path"),
            F.lit(None).cast("string").alias("context"),
        )
        roots = _descend(self._tops, start)
        # The group's root travels down with the path: no join meets a hot group.
        above = roots.select(F.col("pos").alias("tree"), "path", F.col("node").alias("context"))
        found = _descend(self._heights, above)
        return found.select(
            "row.*",
            F.col("node").alias("leaf"),
            F.col("context").alias("subroot"),
            F.lit(self.root).cast("string").alias("root"),
            "path",
        )


def build_manifest(
    docs: DataFrame,
    columns: Iterable[str],
    id_col: str = "doc_id",
    group_col: str = "source",
    carry: dict[str, Column] | None = None,
) -> Manifest:
    """Digest every row and build the trees.

    A row's leaf is the digest of ``columns``.  In each group the leaves ascend by
    identifier, nulls first, equal identifiers by leaf; every 16 consecutive nodes of
    a level become one above until one node, the group's root, remains.  The groups'
    roots, ordered by group (null first, bytewise), make the dataset's root in the
    same way.  ``carry`` names further columns that proofs return (the identifier, if
    None); other columns of ``docs`` are not read, so no name can clash.

    Positions come from a range sort and the numbers of rows in earlier ranges, so a
    group of any size is spread over tasks, rows that are equal in everything
    included.  256 consecutive nodes meet in one row, as a string of digests; parents
    are hashes of its fixed-width substrings.  A height has a 256th of the rows of the
    one below.

    A null group is a group; repeated rows are leaves of their own; a group of one row
    has its leaf as root; an empty table has no root and gives no rows.
    """
    spark = tuned(docs.sparkSession)
    scratch = Scratch(spark, "merkle")
    kept = {id_col: docs[f"`{id_col}`"]} if carry is None else carry
    leaves = scratch.store(
        docs.select(
            docs[f"`{group_col}`"].alias("group"),
            docs[f"`{id_col}`"].alias("id"),
            leaf_digest(docs[f"`{c}`"] for c in columns).alias("node"),
            F.struct(*[column.alias(name) for name, column in kept.items()]).alias("row"),
            F.monotonically_increasing_id().alias("uid"),
        ),
        "leaves",
    )
    order = ["group", "id", "node", "uid"]
    placed = scratch.store(
        leaves.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().alias("at"),
            "group",
            "node",
            "row",
        ),
        "placed",
    )
    scratch.drop("leaves")

    # One row for each group of a range: where it starts there, and how many rows it has before.
    ranges = scratch.store(
        placed.groupBy("part", "group").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")), "ranges"
    )
    sizes = ranges.groupBy("group").agg(F.sum("n").alias("n"))
    ranked = global_rank(sizes, [F.col("group").asc_nulls_first()], scratch, "groups")
    trees = scratch.store(ranked.select(F.col("rank").cast("long").alias("tree"), "group", "n"), "trees")
    number, most = trees.agg(F.count(F.lit(1)), F.coalesce(F.max("n"), F.lit(0))).first()

    before = Window.partitionBy("group").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = ranges.select("part", "group", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    starts = earlier.join(trees, earlier["group"].eqNullSafe(trees["group"])).select(
        F.col("part").alias("of"), "tree", earlier["group"].alias("of_group"), "first", "earlier", "n"
    )
    nodes = placed.join(starts, (F.col("part") == F.col("of")) & F.col("group").eqNullSafe(F.col("of_group"))).select(
        "tree", (F.col("earlier") + F.col("at") - F.col("first")).alias("pos"), "n", "node", "row"
    )
    heights = _climb(nodes, most, scratch, "rows")
    scratch.drop("placed", "ranges")

    subroots = scratch.store(
        heights[-1].select("tree", F.col("top").alias("subroot")).join(trees, "tree"), "subroots"
    ).select("tree", "group", F.col("n").alias("rows"), "subroot")
    tops = _climb(
        subroots.select(
            F.lit(0).cast("long").alias("tree"),
            F.col("tree").alias("pos"),
            F.lit(number).cast("long").alias("n"),
            F.col("subroot").alias("node"),
            F.lit(None).cast("string").alias("row"),
        ),
        number,
        scratch,
        "groups",
    )
    top = tops[-1].select("top").first()
    return Manifest(top[0] if top else None, subroots, heights, tops)
