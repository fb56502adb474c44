"""Merkle manifest of a dataset: a tree per group of rows, a tree over the
groups' roots, and a recursive query that climbs from every leaf to the root.

Building goes upwards level by level; a level is one grouped aggregation over
the digests below it (an eighth as many rows each time), and a node is kept as
the row (node, parent, place in the parent, digests of its children).  The
recursive query starts with one row per leaf.  A step joins the rows with the
nodes they point at, appends the siblings, folds the row's own (possibly
tampered) digest with them, and follows the link to the parent.  A leaf's
appended siblings, in order of the steps, are its proof.

Every climb ends at the same root.  Leaves therefore belong to chunks of
``CHUNK`` neighbours, nodes above a chunk's top are stored once per chunk below
them, and the join's key is (chunk, node): no key meets more than ``CHUNK``
leaves.  Numbers in the order of (group, id) come from a range partitioning
and the rows before each partition, so no task orders a whole group.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parley.llm.common import let, written

WIDTH = 8
CHUNK_LEVELS = 4
CHUNK = WIDTH**CHUNK_LEVELS
# Largest number of groups that is broadcast (about 60 bytes each).
BROADCAST_GROUPS = 200_000
LEVELS = 64  # more than any tree has: 8^21 leaves are 2^63
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(text: Column) -> Column:
    """The SHA-256 digest of a text as 32 bytes."""
    return F.unhex(F.sha2(text, 256))


def lower_hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def counted_value(value: Column) -> Column:
    """``-`` for NULL, else the UTF-8 bytes of the value, ``:`` and the value."""
    return F.coalesce(let(value.cast("string"), lambda v: F.concat(F.octet_length(v).cast("string"), F.lit(":"), v)), F.lit("-"))


def leaf_digest(values: Sequence[Column]) -> Column:
    return sha(F.concat(*[counted_value(v) for v in values]))


def lower_ascii(text: Column) -> Column:
    """The text with A-Z in lower case and all else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` with their number from 0 in a total order, as ``name``.

    Ranges of the order are partitions; the rows of the earlier ones are added
    by a broadcast of one count per partition.
    """
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # The generated id is the partition in the high bits, the row's number in
    # the low 33.
    placed = written(ordered.withColumn("__at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("__at", 33).alias("__part")
    counts = placed.groupBy(part).agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    before = counts.select("__part", F.coalesce(before, F.lit(0)).alias("__before"))
    inside = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.withColumn("__part", part)
        .join(F.broadcast(before), "__part")
        .withColumn(name, (F.col("__before") + inside).cast("bigint"))
        .drop("__part", "__before", "__at")
    )


def tree_nodes(items: DataFrame) -> tuple[DataFrame | None, DataFrame]:
    """The trees over items (tree, leaves, pos, digest), ``leaves`` of them per
    tree, numbered by ``pos`` from 0.

    Returns the inner nodes (tree, leaves, level from 1, width: nodes of that
    level, pos, children: their digests in a row, digest), None if there are
    none, and the roots (tree, leaves, digest).
    """
    level, levels = 0, []
    current = items.select("tree", "leaves", F.col("leaves").alias("width"), "pos", "digest")
    roots = current.where("width = 1").select("tree", "leaves", "digest")
    while True:
        current = current.where("width > 1")
        level += 1
        run = F.shiftright("pos", 3).alias("run")
        above = F.shiftright(F.col("width") + WIDTH - 1, 3).alias("above")
        children = F.transform(F.array_sort(F.collect_list(F.struct("pos", "digest"))), lambda c: lower_hex(c["digest"]))
        nodes = current.groupBy("tree", "leaves", above, run).agg(F.array_join(children, "").alias("text"))
        nodes = nodes.select(
            "tree", "leaves", F.lit(level).alias("level"), F.col("above").alias("width"), F.col("run").alias("pos"),
            F.unhex("text").alias("children"), sha(F.col("text")).alias("digest"),
        )
        nodes = written(nodes, "level")
        if not nodes.limit(1).count():
            break
        levels.append(nodes)
        roots = roots.unionByName(nodes.where("width = 1").select("tree", "leaves", "digest"))
        current = nodes.select("tree", "leaves", "width", "pos", "digest")
    all_nodes = None
    for nodes in levels:
        all_nodes = nodes if all_nodes is None else all_nodes.unionByName(nodes)
    return all_nodes, roots


def span(level: Column) -> Column:
    """Leaves below a full node of a level."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), (3 * level).cast("int"))


def node_id(first: Column, level: Column, top: bool) -> Column:
    """A node's number, from its first leaf and its level; negative in the
    tree over the groups."""
    number = first * LEVELS + level
    return (-number - 1 if top else number).cast("bigint")


def parent_id(tree: Column, pos: Column, level: Column, top: bool) -> Column:
    up = level + 1
    first = F.shiftright(pos, 3) * span(up)
    return node_id(first if top else tree + first, up, top)


def with_links(nodes: DataFrame, groups: DataFrame, many_groups: bool, level: Column) -> DataFrame:
    """Nodes or leaves of the groups' trees with ``parent`` and ``place``; the
    root of a group's tree goes on to the tree over the groups."""
    tree, pos, width = F.col("tree"), F.col("pos"), F.col("width")
    inner = nodes.where("width > 1").withColumn("parent", parent_id(tree, pos, level, False)).withColumn("place", pos % WIDTH)
    group = groups.select("tree", "group_pos")
    roots = nodes.where(width == 1).join(group, "tree")
    none = F.lit(None).cast("bigint")
    onward = parent_id(F.lit(0), F.col("group_pos"), F.lit(0), True) if many_groups else none
    roots = roots.withColumn("parent", onward).withColumn("place", F.col("group_pos") % WIDTH).drop("group_pos")
    return inner.unionByName(roots)


def per_chunk(nodes: DataFrame | None, top: DataFrame | None, groups: DataFrame) -> DataFrame | None:
    """All nodes by (chunk, node): those above a chunk's top once for every
    chunk below them."""
    out = None
    columns = ["chunk", "node", "parent", "place", "children"]
    if nodes is not None:
        level, tree = F.col("level"), F.col("tree")
        first = F.col("pos") * span(level)
        last = F.least(first + span(level), F.col("leaves")) - 1
        start = first - first % CHUNK
        node = node_id(tree + first, level, False)
        linked = nodes.withColumn("node", node)
        low = linked.where(level <= CHUNK_LEVELS).withColumn("chunk", tree + start)
        high = linked.where(level > CHUNK_LEVELS).withColumn("chunk", F.explode(F.sequence(tree + first, tree + last, F.lit(CHUNK))))
        out = low.select(columns).unionByName(high.select(columns))
    if top is not None:
        level, pos = F.col("level"), F.col("pos")
        first = pos * span(level)
        last = F.least(first + span(level), F.col("leaves")) - 1
        none = F.lit(None).cast("bigint")
        linked = top.select(
            node_id(first, level, True).alias("node"),
            F.when(F.col("width") > 1, parent_id(F.lit(0), pos, level, True)).otherwise(none).alias("parent"),
            (pos % WIDTH).alias("place"),
            "children",
            F.explode(F.sequence(first, last)).alias("group_pos"),
        )
        bases = groups.select("group_pos", "tree", "group_leaves")
        chunks = F.explode(F.sequence(F.col("tree"), F.col("tree") + F.col("group_leaves") - 1, F.lit(CHUNK)))
        linked = linked.join(bases, "group_pos").withColumn("chunk", chunks).select(columns)
        out = linked if out is None else out.unionByName(linked)
    return out


@contextmanager
def unlimited_recursion(spark: SparkSession) -> Iterator[None]:
    """Recursive queries that run inside may give out any number of rows;
    their depth is that of the tree."""
    limits = {"spark.sql.cteRecursionRowLimit": "-1", "spark.sql.cteRecursionLevelLimit": str(2 * LEVELS)}
    before = {key: spark.conf.get(key, None) for key in limits}
    for key, limit in limits.items():
        spark.conf.set(key, limit)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


# One row per leaf and step; the join is a shuffle join at every size, as the
# nodes grow with the table.
CLIMB = """
WITH RECURSIVE climb(at, chunk, node, place, folded, step, siblings) AS (
  SELECT at, chunk, parent, place, folded, 0, CAST('' AS BINARY) FROM {leaves}
  UNION ALL
  SELECT /*+ SHUFFLE_HASH(n) */ c.at, c.chunk, n.parent, n.place,
    unhex(sha2(lower(hex(concat(
      substring(n.children, 1, 32 * c.place), c.folded, substring(n.children, 32 * c.place + 33)))), 256)),
    c.step + 1,
    concat(substring(n.children, 1, 32 * c.place), substring(n.children, 32 * c.place + 33))
  FROM climb c JOIN {nodes} n ON c.chunk = n.chunk AND c.node = n.node
)
SELECT at, step, siblings, folded FROM climb
"""


def climbed(leaves: DataFrame, nodes: DataFrame) -> DataFrame:
    """(at, step, siblings, folded) of every step of every leaf."""
    spark = leaves.sparkSession
    anchor = leaves.select("at", "chunk", "parent", F.col("place").cast("int").alias("place"), "folded")
    stored = nodes.withColumn("place", F.col("place").cast("int"))
    with unlimited_recursion(spark):
        return written(spark.sql(CLIMB, leaves=anchor, nodes=stored), "climb")


def merkle_manifest(
    docs: DataFrame,
    id_col: str = "doc_id",
    group_col: str = "lang",
    fields: Sequence[str] = FIELDS,
    tampered_field: str = "text",
) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified) per row.

    A leaf is the digest of the row's ``fields``.  Within a group, leaves
    ascend by id (NULL first; equal ids by their leaf digest), and runs of 8
    nodes become their digest until one is left, the subroot.  Subroots in
    order of the group (NULL first) give the root in the same way.  Rows whose
    id's CRC-32 divides by 3 are folded from a tampered copy: ``tampered_field``
    with A-Z in lower case.

    NULL and empty values have digests of their own; rows with a NULL id are
    not tampered with; repeated rows are leaves of their own; a single row is
    its own root, with the empty proof; an empty table gives an empty result;
    other columns play no part.
    """
    plain = leaf_digest([F.col(c) for c in fields])
    changed = leaf_digest([lower_ascii(F.col(c)) if c == tampered_field else F.col(c) for c in fields])
    is_tampered = F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 0, F.lit(False))
    digests = docs.select(
        F.col(id_col).alias("id"),
        F.col(group_col).alias("group"),
        plain.alias("digest"),
        # The text is hashed again only where it changes.
        F.when(is_tampered, changed).alias("tampered"),
        F.monotonically_increasing_id().alias("row"),
    )
    digests = written(digests, "digests")
    order = [F.col("group").asc_nulls_first(), F.col("id").asc_nulls_first(), F.col("digest").asc(), F.col("row").asc()]
    leaves = numbered(digests, order, "at").drop("row")
    groups = leaves.groupBy("group").agg(F.min("at").alias("tree"), F.count(F.lit(1)).alias("group_leaves"))
    groups = written(numbered(groups, [F.col("tree").asc()], "group_pos"), "groups")
    n_groups = groups.count()

    def with_group(rows: DataFrame, columns: DataFrame) -> DataFrame:
        columns = columns.withColumnRenamed("group", "__group")
        columns = F.broadcast(columns) if n_groups <= BROADCAST_GROUPS else columns
        return rows.join(columns, F.col("group").eqNullSafe(F.col("__group"))).drop("__group")

    leaves = written(with_group(leaves, groups.select("group", "tree", "group_leaves")), "leaves")
    pos = F.col("at") - F.col("tree")
    items = leaves.select("tree", F.col("group_leaves").alias("leaves"), pos.alias("pos"), "digest")
    nodes, roots = tree_nodes(items)
    subroots = written(roots.join(groups.select("tree", "group", "group_pos"), "tree").select("group", "group_pos", "digest"), "subroots")
    top_items = subroots.select(
        F.lit(0).cast("bigint").alias("tree"), F.lit(n_groups).cast("bigint").alias("leaves"),
        F.col("group_pos").alias("pos"), "digest",
    )
    top, root = tree_nodes(top_items)
    root_row = root.select(lower_hex(F.col("digest")).alias("root")).first()
    root_text = F.lit(root_row["root"] if root_row else None).cast("string")

    starts = leaves.select(
        "at", "tree", pos.alias("pos"), F.col("group_leaves").alias("width"),
        (F.col("at") - pos % CHUNK).alias("chunk"), F.coalesce("tampered", "digest").alias("folded"),
    )
    starts = with_links(starts, groups, n_groups > 1, F.lit(0))
    if nodes is not None:
        nodes = with_links(nodes, groups, n_groups > 1, F.col("level"))
    stored = per_chunk(nodes, top, groups)
    if stored is None:  # at most one leaf
        steps = starts.select("at", F.lit(0).alias("step"), F.lit(b"").alias("siblings"), "folded")
    else:
        steps = climbed(starts, written(stored, "nodes"))

    in_order = F.array_sort(F.collect_list(F.struct("step", "siblings")))
    proof = F.array_join(F.transform(in_order, lambda s: lower_hex(s["siblings"])), "")
    proofs = steps.groupBy("at").agg(F.sha2(proof, 256).alias("proof_sha256"), F.max_by("folded", "step").alias("end"))
    out = with_group(leaves.select("at", "id", "group", "digest"), subroots.select("group", F.col("digest").alias("subroot")))
    out = out.join(proofs, "at").select("*", lower_hex(F.col("end")).alias("folded_root"))
    return out.select(
        F.col("id").alias(id_col),
        lower_hex(F.col("digest")).alias("leaf"),
        lower_hex(F.col("subroot")).alias("subroot"),
        root_text.alias("root"),
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == root_text).alias("verified"),
    )
