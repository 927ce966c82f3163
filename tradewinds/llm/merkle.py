"""A Merkle manifest of a table: one root, and for every row the siblings that prove it.

A row's leaf is the digest of its columns. Per group (language) the leaves, in the order of their ids, are
the lowest nodes of a tree; every `FANOUT` consecutive nodes become one node above, until one is left: the
group's subroot. The subroots, in the order of their groups, make the upper tree, whose top is the root.

- *Numbers.* A node's place in its tree comes from ranges: rows are range partitioned by (group, id, leaf)
  and sorted there, written once, and a range's count per group tells where the next one begins. No window
  spans a group, so a group may hold any share of the rows.
- *Up: the slot pivot.* `FANOUT` conditional aggregates spread the children of a parent into slot columns.
  The columns laid end to end are hashed into the parent; each level is a written table an eighth as long
  as the one below.
- *Down.* From the root to the leaves each pivoted row hands every child the path of its parent with one
  step more: the slot columns before its own and those after it. Only the last of these joins is as long as
  the table (an eighth of its rows), and the leaves come out of their parent's slots without a join.

Everything is JVM-side; only the number of nodes of the largest group comes to the driver.

Defined cases: null columns are `-` in a leaf; a null group is a group, the first; null ids come first in
their group; rows that repeat an id are leaves each, in the order of their digests; a group of one row has
this leaf as subroot, and a single group's subroot is the root; empty and very long texts are values as any;
other columns of the caller's table are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewinds.llm.frames import stage

FANOUT = 8
#: Rows of a range; there are at least as many ranges as shuffle partitions.
RANGE_ROWS = 1_000_000
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PATH = "array<struct<before:string,after:string>>"


def leaf(*columns: Column) -> Column:
    """Digest of a row: for each column `-` if null, else its UTF-8 byte count, `:` and its value."""
    texts = [c.cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def without_capitals(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, _UPPER, _LOWER)


def _ranked(rows: DataFrame, *order: str) -> DataFrame:
    """`rows` (a written table with `tree`) with `idx`, a row's place in its tree by `order`, and `n`, the tree's rows."""
    spark = rows.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // RANGE_ROWS))
    placed = stage(
        rows.repartitionByRange(ranges, "tree", *order).sortWithinPartitions("tree", *order)
        .withColumn("at", F.monotonically_increasing_id()),
        "ranked",
    )
    # The id that Spark gives a row holds its partition in the bits above the 33 of its place there.
    placed = placed.withColumn("range", F.shiftright("at", 33))
    counts = placed.groupBy("tree", "range").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    tree = Window.partitionBy("tree")
    counts = counts.select(
        "tree", "range", (F.sum("rows").over(tree.orderBy("range")) - F.col("rows") - F.col("first")).alias("shift"),
        F.sum("rows").over(tree).alias("n"),
    )
    return placed.join(counts, ["tree", "range"]).withColumn("idx", F.col("at") + F.col("shift")).drop("at", "range", "shift")


def _slots() -> list[Column]:
    return [F.coalesce(F.col(f"slot{k}.hash"), F.lit("")) for k in range(FANOUT)]


def _pivot(nodes: DataFrame) -> DataFrame:
    """Parents of the nodes (tree, idx, n, value): their children in slot columns, and their own hash."""
    own = F.pmod("idx", F.lit(FANOUT))
    parents = nodes.groupBy("tree", F.floor(F.col("idx") / FANOUT).alias("idx")).agg(
        F.ceil(F.max("n") / FANOUT).alias("n"),
        *[F.max(F.when(own == k, F.col("value"))).alias(f"slot{k}") for k in range(FANOUT)],
    )
    return parents.withColumn("hash", F.sha2(F.concat(*_slots()), 256))


def _climb(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The pivoted parents of every level, and the tops (tree, level, hash) of all trees.

    `nodes` has tree, idx, n and value, a struct that begins with `hash`.
    """
    largest = nodes.agg(F.max("n")).first()[0] or 0
    levels, tops = [], nodes.where("n = 1").select("tree", F.lit(0).alias("level"), "value.hash")
    while largest > 1:
        levels.append(stage(_pivot(nodes.where("n > 1")), "level"))
        parents = levels[-1]
        tops = tops.union(parents.where("n = 1").select("tree", F.lit(len(levels)).alias("level"), "hash"))
        nodes = parents.select("tree", "idx", "n", F.struct("hash").alias("value"))
        largest = -(-largest // FANOUT)
    return levels, tops


def _descend(levels: list[DataFrame], tops: DataFrame, *carried: str) -> DataFrame | None:
    """The lowest nodes (tree, value, path, carried columns) of all trees of more than one node.

    `tops` has tree, level, path and the carried columns.
    """
    columns = ("tree", "idx", "path", *carried)
    slots, found = _slots(), None
    for level in reversed(range(len(levels))):
        parents = tops.where(F.col("level") == level + 1).withColumn("idx", F.lit(0).cast("bigint")).select(*columns)
        if found is not None:
            parents = parents.union(found.select(*columns))
        children = F.array(*[
            F.struct(
                F.lit(k).alias("slot"), F.col(f"slot{k}").alias("value"),
                F.concat(F.lit(""), *slots[:k]).alias("before"), F.concat(F.lit(""), *slots[k + 1:]).alias("after"),
            )
            for k in range(FANOUT)
        ])
        step = F.array(F.struct("child.before", "child.after")).cast(_PATH)
        found = (
            levels[level].join(parents, ["tree", "idx"])
            .withColumn("child", F.explode(F.filter(children, lambda c: c["value"].isNotNull())))
            .select(
                "tree", (F.col("idx") * FANOUT + F.col("child.slot")).alias("idx"), "child.value",
                F.concat(step, F.col("path")).alias("path"), *carried,
            )
        )
    return found


def manifest(docs: DataFrame, other: Column | None = None) -> DataFrame:
    """doc_id, leaf, other, subroot, root and path for every row.

    `path` holds, from the leaf to the root, the hashes of the nodes before and after the own one in each
    run. `other` (an expression over `docs`, null by default) is carried along.
    """
    none = F.lit(None).cast("string")
    leaves = stage(docs.select(
        # A null group comes before all others.
        F.coalesce(F.concat(F.lit("."), F.col("lang").cast("string")), F.lit("")).alias("tree"),
        F.col("doc_id").cast("bigint").alias("doc_id"), leaf(*map(F.col, COLUMNS)).alias("hash"),
        (none if other is None else other).alias("other"),
    ), "leaves")
    nodes = _ranked(leaves, "doc_id", "hash").select("tree", "idx", "n", F.struct("hash", "doc_id", "other").alias("value"))
    levels, tops = _climb(nodes)

    # The tree of subroots: its rows are few, but go the same way.
    subroots = stage(tops.withColumnsRenamed({"tree": "lang", "hash": "subroot"}).withColumn("tree", F.lit("")), "subroots")
    upper = _ranked(subroots, "lang").select("tree", "idx", "n", F.struct(F.col("subroot").alias("hash"), "lang", "level").alias("value"))
    upper_levels, root = _climb(upper)
    no_steps = F.array().cast(_PATH)
    top = root.select("tree", "level", no_steps.alias("path"), F.col("hash").alias("root"))
    alone = upper.where("n = 1").select("value", no_steps.alias("path"), F.col("value.hash").alias("root"))
    below = _descend(upper_levels, top, "root")
    placed = alone if below is None else alone.union(below.select("value", "path", "root"))
    tops = stage(placed.select(
        F.col("value.lang").alias("tree"), "value.level", "path", F.col("value.hash").alias("subroot"), "root",
    ), "tops")

    columns = ("value", "path", "subroot", "root")
    lone = nodes.where("n = 1").join(tops.where("level = 0"), "tree").select(*columns)
    rest = _descend(levels, tops, "subroot", "root")
    rows = lone if rest is None else lone.union(rest.select(*columns))
    return rows.select("value.doc_id", F.col("value.hash").alias("leaf"), "value.other", "subroot", "root", "path")


def folded(leaf_hash: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path lead to."""
    return F.aggregate(path, leaf_hash, lambda h, step: F.sha2(F.concat(step["before"], h, step["after"]), 256))


def siblings(path: Column) -> Column:
    """All siblings on a path, level by level and left to right, laid end to end."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), "")


def audit(docs: DataFrame, tampered: Column, text: Column) -> DataFrame:
    """Check every row against the manifest of `docs`, as if `text` stood in the rows where `tampered` holds."""
    changed = [text if c == "text" else F.col(c) for c in COLUMNS]
    found = manifest(docs, F.when(tampered, leaf(*changed)))
    back = folded(F.coalesce("other", "leaf"), F.col("path"))
    return (
        found.withColumn("folded_root", back)
        .select(
            "doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"), "folded_root",
            (F.col("folded_root") == F.col("root")).alias("verified"),
        )
    )
