"""Sharding by a hierarchical weighted hash tree (DataFrame functions only).

A tree has regions, racks and shards with weights; an inner node weighs what
its shards weigh together.  A key descends from the root: on every level each
child draws ``-ln(u) / weight`` with ``u`` hashed from (key, path of the
child) and the least draw wins, so a child wins with a probability in
proportion to its weight.  When a weight changes, only the draws of the nodes
above it change: keys move into or out of those subtrees, and never between
two subtrees whose weights stay.  A shard that opens a subtree of its own
therefore takes keys only into itself.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import bucket_offsets, written

# region -> rack -> shard number -> weight
Tree = Mapping[str, Mapping[str, Mapping[int, float]]]


def default_tree(shards: int = 16, regions: int = 2, racks: int = 2) -> dict[str, dict[str, dict[int, float]]]:
    """``shards`` equal shards dealt over regions and racks."""
    tree: dict[str, dict[str, dict[int, float]]] = {}
    for s in range(shards):
        region, rack = f"region{s % regions}", f"rack{s // regions % racks}"
        tree.setdefault(region, {}).setdefault(rack, {})[s] = 1.0
    return tree


def with_new_region(tree: Tree, shard: int, weight: float = 1.0) -> dict[str, dict[str, dict[int, float]]]:
    """The tree with one more shard, in a region and rack of its own."""
    grown = {r: {k: dict(s) for k, s in racks.items()} for r, racks in tree.items()}
    grown[f"region-of-{shard}"] = {"rack0": {shard: weight}}
    return grown


def _weight(node) -> float:
    return float(node) if not isinstance(node, Mapping) else sum(_weight(c) for c in node.values())


def draw(key: Column, path: str, weight: float, seed: int) -> Column:
    """Exponential draw of one child; the hash's upper 53 bits give u in (0, 1)."""
    h = F.xxhash64(key, F.lit(f"{seed}/{path}"))
    u = (F.shiftrightunsigned(h, 11).cast("double") + 0.5) * (2.0**-53)
    return -F.ln(u) / F.lit(weight)


def _descend(key: Column, node, path: str, seed: int) -> Column:
    if not isinstance(node, Mapping):
        return F.lit(int(path.rsplit("/", 1)[1]))
    children = [(str(name), child) for name, child in node.items() if _weight(child) > 0]
    if len(children) == 1:
        name, child = children[0]
        return _descend(key, child, f"{path}/{name}", seed)
    draws = [draw(key, f"{path}/{name}", _weight(child), seed) for name, child in children]
    least = F.array_min(F.array(*[F.struct(d.alias("d"), F.lit(i).alias("i")) for i, d in enumerate(draws)]))["i"]
    # The winner's number is bound once, then the chosen child descends.
    return F.element_at(F.transform(F.array(least), lambda p: _pick(p, key, children, path, seed)), 1)


def _pick(p: Column, key: Column, children, path: str, seed: int) -> Column:
    out = F.lit(None).cast("int")
    for i, (name, child) in reversed(list(enumerate(children))):
        out = F.when(p == i, _descend(key, child, f"{path}/{name}", seed)).otherwise(out)
    return out


def shard_of(key: Column, tree: Tree, seed: int = 7) -> Column:
    """Shard number of a key (INT) by descent through ``tree``."""
    if _weight(tree) <= 0:
        raise ValueError("the tree has no shard with a positive weight")
    return _descend(key, tree, "", seed)


def slot_bucket(order: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*order, F.lit("slot")), F.lit(buckets)).cast("int")


def with_slots(rows: DataFrame, group: str, order: list[str], buckets: int = 1024) -> DataFrame:
    """``rows`` with ``slot``: gapless from 0 within each group.

    Rows are numbered within (group, hash bucket) and moved up by the rows of
    the earlier buckets, so a large group is spread over many tasks.  Buckets
    and the order within them come from ``order``, which should tell any two
    rows apart, such as by a written row number: many equal rows would share a
    bucket.
    The offsets table has at most groups x ``buckets`` rows.  ``group`` is never
    NULL.
    """
    rows = rows.withColumn("__bucket", slot_bucket(order, buckets))
    offsets = bucket_offsets(
        rows.groupBy(group, "__bucket").agg(F.count(F.lit(1)).alias("__n")), group, "__bucket", "__n"
    ).select(F.col(group).alias("__g"), F.col("__bucket").alias("__b"), "rows_before")
    within = F.row_number().over(Window.partitionBy(group, "__bucket").orderBy(*order))
    numbered = rows.withColumn("__in", within)
    joined = numbered.join(offsets, (numbered[group] == offsets["__g"]) & (numbered["__bucket"] == offsets["__b"]))
    return joined.withColumn("slot", (F.col("rows_before") + F.col("__in") - 1).cast("bigint")).drop(
        "__bucket", "__in", "__g", "__b", "rows_before"
    )


def shard_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 16, seed: int = 7
) -> DataFrame:
    """Shard every document by the law ``key``.

    Returns id, size (UTF-8 bytes + 1), text_crc32, law, shard, slot (gapless
    within the shard) and grown_shard (with one more shard, in a region of its
    own).  NULL text counts as empty; NULL ids form one key; repeated rows get
    slots of their own; an empty table gives an empty result.  Only digests
    are shuffled, never texts.
    """
    tree = default_tree(shards)
    grown = with_new_region(tree, shards)
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_col), F.lit(""))
    digests = docs.select(
        F.col(id_col),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        key.alias("__key"),
    ).select(
        id_col,
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        shard_of(F.col("__key"), tree, seed).alias("shard"),
        shard_of(F.col("__key"), grown, seed).alias("grown_shard"),
        F.monotonically_increasing_id().alias("__row"),
    )
    # Repeated rows are dealt apart by their written row number.
    rows = with_slots(written(digests, "shards"), "shard", [id_col, "__row"])
    return rows.select(id_col, "size", "text_crc32", "law", "shard", "slot", "grown_shard")
