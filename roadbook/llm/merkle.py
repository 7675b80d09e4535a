"""Merkle trees over a dataset: a manifest with one inclusion proof per row.

Rows are leaves. Within a group, ``fanout`` consecutive nodes become the digest of their concatenation until one is
left; the groups' last nodes, in the order of their groups, are the leaves of the tree above. A level is a pivot:
conditional aggregates spread the children of a parent into one column per slot. Concatenating these columns gives
the parent's digest, and leaving out a child's own column gives its siblings.

Nodes are numbered by a range-partitioned sort and per-partition counts, so a group of any size is sorted by many
tasks. Several levels are taken per shuffle: rows are dealt by blocks of at most ``BLOCK`` consecutive nodes, and the
levels within a block need no further exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from roadbook.llm.frames import drop, id_key, written

#: Most nodes of a block, whose members are at hand in one group of the aggregates.
BLOCK = 256

_STEPS = "array<struct<before:string,after:string>>"
_MEMBERS = f"array<struct<row:bigint,path:{_STEPS}>>"


def sized(column: Column) -> Column:
    """A value as it enters a leaf: UTF-8 length, colon, value; a null is a dash."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*columns: Column) -> Column:
    return F.sha2(F.concat(*columns), 256)


def _numbered(nodes: DataFrame, order: list[str]) -> tuple[DataFrame, list[str]]:
    """``nodes`` (with ``grp``) and their place ``pos`` in their group by ``order``, and ``n``, the group's size.

    Only counts per sorted partition and group are brought together by group. Nodes equal in every column of the order
    are told apart by where they are stored.
    """
    spark = nodes.sparkSession
    told = nodes.withColumn("__row", F.monotonically_increasing_id())
    kept, kept_path = written(told, "merkle-nodes")
    ranged = kept.repartitionByRange("grp", *order, "__row").sortWithinPartitions("grp", *order, "__row")
    placed = ranged.withColumn("__at", F.monotonically_increasing_id()).drop("__row")
    rows, rows_path = written(
        placed.withColumns({"__part": F.shiftright("__at", 33), "__at": F.col("__at").bitwiseAND((1 << 33) - 1)}),
        "merkle-sorted",
    )
    drop(spark, kept_path)
    group = Window.partitionBy("grp")
    spans = rows.groupBy("__part", "grp").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__rows")).select(
        "__part", "grp",
        (F.coalesce(F.sum("__rows").over(group.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
         - F.col("__first")).alias("__shift"),
        F.sum("__rows").over(group).alias("n"),
    )
    found = rows.join(spans, ["__part", "grp"]).withColumn("pos", F.col("__at") + F.col("__shift"))
    return found.drop("__part", "__at", "__shift"), [rows_path]


def _level(nodes: DataFrame, fanout: int) -> DataFrame:
    """The parents of all nodes, each with all leaves below it; the node of a group that has just one stays as it is.

    ``c0``, ``c1``, .. are the slots of a parent. A member's path grows by the slots before and after its own.
    """
    slots = range(fanout)
    spread = nodes.groupBy("grp", "block", F.expr(f"pos div {fanout}").alias("pos")).agg(
        F.expr("first(n)").alias("n"),
        *[F.expr(f"first(if(pos % {fanout} = {s}, struct(digest, members), null), true)").alias(f"c{s}") for s in slots],
    )
    held = [f"coalesce(c{s}.digest, '')" for s in slots]
    grown = []
    for s in slots:
        before, after = ", ".join(["''", *held[:s]]), ", ".join(["''", *held[s + 1 :]])
        step = f"struct(concat({before}) AS before, concat({after}) AS after)"
        one = f"transform(c{s}.members, m -> struct(m.row AS row, concat(m.path, array({step})) AS path))"
        grown.append(f"coalesce({one}, cast(array() AS {_MEMBERS}))")
    return spread.selectExpr(
        "grp", "block", "pos", f"(n + {fanout - 1}) div {fanout} AS n",
        f"if(n <= 1, c0.digest, sha2(concat({', '.join(held)}), 256)) AS digest",
        f"if(n <= 1, c0.members, concat({', '.join(grown)})) AS members",
    )


def _tree(nodes: DataFrame, order: list[str], fanout: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """Nodes with ``path``, the siblings before and after each from the bottom up; and ``grp``, ``digest`` of the roots."""
    spark = nodes.sparkSession
    height, per_step = 1, 1
    while fanout ** (per_step + 1) <= BLOCK:
        per_step += 1
    leaves, paths = _numbered(nodes, order)
    leaves, path = written(leaves, "merkle-leaves")
    for old in paths:
        drop(spark, old)
    below, steps, roots = leaves.select("grp", "pos", "n", "digest"), [], None
    widest = leaves.agg(F.max("n")).first()[0] or 0
    while True:
        width = fanout**per_step
        level = below.select(
            "grp", "pos", "n", "digest", F.expr(f"pos div {width}").alias("block"),
            F.array(F.struct(F.col("pos").alias("row"), F.array().cast(_STEPS).alias("path"))).alias("members"),
        ).repartition("grp", "block")
        for _ in range(per_step):
            level = _level(level, fanout)
        done, _ = written(level, f"merkle-step{height}")
        steps.append(done)
        below, height = done.select("grp", "pos", "n", "digest"), height + 1
        widest = -(-widest // width)
        if widest <= 1:
            roots = below.select("grp", "digest")
            break
    # from the top down: the path of a block's node goes behind the paths of the block's members
    above = None
    for done in reversed(steps):
        inner = done.select("grp", F.col("pos").alias("block"), F.explode("members").alias("m")).select(
            "grp", "block", F.col("m.row").alias("pos"), F.col("m.path").alias("path")
        )
        if above is not None:
            inner = inner.join(above, ["grp", "block"]).withColumn("path", F.concat("path", "path_above")).drop("path_above")
        above = inner.select("grp", F.col("pos").alias("block"), F.col("path").alias("path_above"))
    found = above.select("grp", F.col("block").alias("pos"), F.col("path_above").alias("path"))
    return leaves.join(found, ["grp", "pos"]), roots, [path]


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, start, lambda d, step: F.sha2(F.concat(step["before"], d, step["after"]), 256))


def proof(path: Column) -> Column:
    """Digest of all siblings, level by level, from left to right."""
    joined = F.transform(path, lambda step: F.concat(step["before"], step["after"]))
    return F.sha2(F.array_join(joined, ""), 256)


def manifest(
    docs: DataFrame, id_column: str = "doc_id", group_column: str = "lang", fields: list[str] | None = None,
    changed: dict[str, Column] | None = None, fanout: int = 2,
) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``leaf``, ``subroot`` of its group, ``root``, ``path``, ``other_leaf``.

    A leaf is the digest of ``fields``, each by :func:`sized`. Leaves ascend by id within a group (nulls first; equal
    ids by leaf), groups by name (null first, then bytewise). ``path`` holds the siblings before and after the row's
    node for each level up to the root. ``other_leaf`` is the leaf with the values of ``changed`` instead. Repeated rows
    are leaves of their own; a group of one row has its leaf as subroot; a table without rows gives no rows. Nulls and
    empty texts are told apart. Columns beyond ``fields`` do not matter, whatever their names.
    """
    if fanout < 2:
        raise ValueError("a parent needs two slots at least")
    fields = fields or ["doc_id", "source", "lang", "n_chars", "text"]
    changed = changed or {}
    values = [F.col(f"`{f}`") for f in fields]
    named = docs.select(
        F.col(f"`{id_column}`").alias("id"), id_key(F.col(f"`{group_column}`")).alias("grp"),
        digest(*map(sized, values)).alias("digest"),
        digest(*[sized(changed.get(f, F.col(f"`{f}`"))) for f in fields]).alias("other_leaf"),
    )
    leaves, roots, _ = _tree(named, ["id", "digest"], fanout)
    # the groups' roots are the leaves of one more tree
    tops = roots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "digest")
    above, top, _ = _tree(tops, ["name"], fanout)
    held, _ = written(
        above.join(top.select("grp", F.col("digest").alias("root")), "grp").select(
            F.col("name").alias("grp"), F.col("digest").alias("subroot"), "root", F.col("path").alias("path_above")
        ),
        "merkle-groups",
    )
    return leaves.join(held, "grp").select(
        "id", F.col("digest").alias("leaf"), "subroot", "root", F.concat("path", "path_above").alias("path"), "other_leaf"
    )
