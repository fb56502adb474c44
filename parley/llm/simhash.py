"""Near-duplicates by SimHash fingerprints, found through pigeonhole blocks.

A fingerprint of 64 bits is cut into ``blocks`` blocks.  Two fingerprints that
differ in at most ``distance`` bits differ in at most ``distance`` blocks, so
they agree in some ``blocks - distance`` blocks.  Every choice of that many
blocks is a table keyed by their bits; each fingerprint is a row in every
table, and the rows that meet in a table are compared in full (Hamming
distance).  With the 20 tables of 6 blocks and 3 bits a key has 31 to 33 bits,
so fingerprints seldom meet by chance.

Only distinct fingerprints are joined, and rows alone with their key are left
out before the join.  A key with many fingerprints (never copies: those are
one fingerprint) is dealt over tasks: each of its parts meets all of the key.
A pair counts in the first table only in which it meets.  The components of
the links then go back to the documents; fingerprints that very many documents
hold come by broadcast, so no task gets all of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import drop_kept, hand_back_memory, small_batches, written
from parley.llm.ngram_join import connected_roots
from parley.llm.tokens import text_slices

SHINGLE = 3
SEED = 42
BITS = 64
DISTANCE = 3
BLOCKS = 6
SLICE = 4_000_000  # bytes of text per step of a task
STEP = 65_536  # shingles whose bits are added up at once
# Fingerprints of one key that one task compares with all of the key.
PART_ROWS = 512
# Documents from which a fingerprint's component comes by broadcast: at most
# rows / HOT_COPIES fingerprints have as many.
HOT_COPIES = 100_000


def fingerprint(text: bytes) -> int:
    """The SimHash of a text: bit b is 1 when it is set in more than half of
    the hashes of the shingles, repeats included; 0 for a text without words."""
    from xxhash import xxh64_digest

    # bytes.lower and bytes.split know ASCII letters and white space only.
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(SHINGLE, len(words))
    first, last = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(first), STEP):
        part = zip(first[at : at + STEP], last[at : at + STEP], strict=True)
        digests = b"".join([xxh64_digest(joined[a:b], SEED) for a, b in part])
        bits = np.unpackbits(np.frombuffer(digests, np.uint8)).reshape(-1, BITS)
        counts += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * counts > len(first)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp) per document: the fingerprint's 64 bits as a signed BIGINT."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        for whole in batches:
            for batch in text_slices(whole, size=SLICE):
                texts = pc.fill_null(batch.column(1), "").cast(pa.large_binary())
                fps = [fingerprint(t.as_py()) for t in texts]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], names=["id", "fp"])
        hand_back_memory()

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {id_type}, fp long")


def block_masks(blocks: int = BLOCKS) -> list[int]:
    """The bits of each block, as unsigned masks of nearly equal width."""
    edges = [i * BITS // blocks for i in range(blocks + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]


def signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def table_masks(distance: int = DISTANCE, blocks: int = BLOCKS) -> list[int]:
    """A mask per choice of ``blocks - distance`` blocks (signed)."""
    if not 0 <= distance < blocks <= BITS:
        raise ValueError(f"{blocks} blocks cannot find pairs at {distance} bits")
    return [signed(sum(choice)) for choice in combinations(block_masks(blocks), blocks - distance)]


def first_table(x: Column, masks: list[int]) -> Column:
    """The first table in which two fingerprints with XOR ``x`` agree."""
    out = F.lit(None).cast("int")
    for i in reversed(range(len(masks))):
        out = F.when(x.bitwiseAND(F.lit(masks[i])) == 0, F.lit(i)).otherwise(out)
    return out


def close_pairs(
    distinct: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, part_rows: int = PART_ROWS
) -> DataFrame:
    """(a, b), a < b: all pairs of the distinct BIGINT fingerprints ``fp`` that
    differ in at most ``distance`` bits, each pair once."""
    masks = table_masks(distance, blocks)
    keys = F.array(*[
        F.struct(F.lit(i).alias("table"), F.col("fp").bitwiseAND(F.lit(mask)).alias("key")) for i, mask in enumerate(masks)
    ])
    placed = distinct.select("fp", F.explode(keys).alias("k")).select("fp", "k.table", "k.key")
    # Count and rows come by one shuffle; what meets nothing ends here.
    several = F.count(F.lit(1)).over(Window.partitionBy("table", "key"))
    met = written(placed.withColumn("rows", several).where("rows > 1"), "met")
    parts = F.ceil(F.col("rows") / F.lit(part_rows)).cast("int")
    left = met.select("table", "key", F.col("fp").alias("a"), F.pmod(F.xxhash64("fp"), parts).cast("int").alias("part"))
    right = met.select(
        "table", "key", F.col("fp").alias("b"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("part")
    )
    xor = F.col("a").bitwiseXOR(F.col("b"))
    near = (F.col("a") < F.col("b")) & (F.bit_count(xor) <= distance)
    pairs = left.join(right, ["table", "key", "part"]).where(near)
    return pairs.where(first_table(xor, masks) == F.col("table")).select("a", "b")


def simhash_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    distance: int = DISTANCE,
    blocks: int = BLOCKS,
    hot_copies: int = HOT_COPIES,
) -> DataFrame:
    """(id, fingerprint, component_id, class_id, n_links) per document.

    ``fingerprint`` is 16 lowercase hex digits; documents link when their
    fingerprints differ in at most ``distance`` bits.  ``component_id`` is the
    smallest id reachable over links, ``class_id`` the smallest id with the
    same fingerprint, ``n_links`` the number of other documents (rows) linked
    with this one.

    NULL, empty and blank texts have the fingerprint 0 and link like any
    other.  NULL ids take part in links, but are a smallest id only where all
    ids are NULL; repeated rows each count and are given out; an empty table
    gives an empty result; other columns play no part.
    """
    with small_batches(docs.sparkSession):
        rows = written(fingerprints(docs, id_col, text_col), "fingerprints")
    distinct = rows.groupBy("fp").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("copies"))
    distinct = written(distinct, "distinct")
    links = written(close_pairs(distinct.select("fp"), distance, blocks), "close")
    roots = written(connected_roots(links), "roots")

    # Neighbours' copies, for the number of links of each document.
    copies = distinct.select(F.col("fp").alias("b"), "copies")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = both.join(copies, "b").groupBy(F.col("a").alias("fp")).agg(F.sum("copies").alias("others"))

    grouped = distinct.join(roots.withColumnRenamed("class", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = grouped.groupBy("root").agg(F.min("class_id").alias("component_id"))
    grouped = grouped.join(least, "root").join(others, "fp", "left")
    n_links = F.col("copies") - 1 + F.coalesce("others", F.lit(0))
    grouped = written(grouped.select("fp", "class_id", "component_id", n_links.alias("n_links"), "copies"), "grouped")

    # A fingerprint that very many documents hold is no key of a shuffle.
    is_hot = F.col("copies") >= hot_copies
    hot = grouped.where(is_hot).drop("copies")
    found = ["class_id", "component_id", "n_links"]
    by_broadcast = rows.join(F.broadcast(hot), "fp").select("id", "fp", *found)
    rest = rows.join(F.broadcast(hot.select("fp")), "fp", "left_anti")
    by_shuffle = rest.join(grouped.where(~is_hot).drop("copies"), "fp").select("id", "fp", *found)
    return by_broadcast.unionByName(by_shuffle).select(
        F.col("id").alias(id_col),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
        "class_id",
        "n_links",
    )
