"""Exact Jaccard join of documents on word n-grams: connected components by a
prefix-filter join, the links inside them by a blocked sparse matrix product.

The incidence matrix has a row per distinct set of n-grams (documents with
equal sets are one class) and a column per n-gram.  It is cut into column
blocks by the n-gram's hash.  A pair of rows can only reach the threshold when
its overlap count does, so size-derived bounds discard work before the
overlaps are counted:

* a column with one row adds to no overlap: each block drops such columns and
  hands the others back to the rows, with the column's number of rows;
* a row whose shared columns are fewer than 4/5 of its size has no partner;
* with the columns in order of rarity, two partners share a column among the
  first ``shared - ceil(4/5 size) + 1`` shared columns of each (prefix bound),
  and the columns left behind a common one must still reach the overlap that
  the two sizes ask for (positional bound).

The column blocks only find the columns that rows share; the pairs of the
prefix-filter join are verified one by one, in full.  Components come first: a
column with many rows links its rows in stars, then deals them a few partners
each, and in the end all remaining pairs of different components are counted.
So every link lies inside a component, and the links are then counted there:
the overlaps of all its pairs of rows are added up over blocks of columns in
products of row chunks.  No column, bucket or list has a cap, and no link
between different texts is lost.

Columns held by very many documents are found by mergeable heavy-hitter
counters on all documents.  They skip the column blocks, as their number of
rows needs no count to be "many"; so no block grows with a frequent passage.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.llm.common import drop_kept, hand_back_memory, small_batches, written, written_in_buckets
from parley.llm.tokens import text_slices

N_GRAM = 5
# Odd multipliers of the n-gram hash (fixed, arbitrary).
MULTIPLIERS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64
)
HEAVY_COUNTERS = 4096
# A column counts as frequent from this share of the documents and this many.
FREQUENT_SHARE, FREQUENT_ROWS = 0.002, 1000
# Entries of a column block, which one task takes in so many steps: the fewer
# blocks, the more entries a row sends to each behind one class id.
BLOCK_ENTRIES, BLOCK_STEPS = 4_800_000, 4
SLICE = 4_000_000  # bytes of text per step of a task
# Edges that a task connects at once (16 bytes each).
STAR_EDGES = 1_000_000
# Partners dealt to a row of a column in the first round after the stars; eight
# times as many in each round after it.
FIRST_PARTNERS = 8
# Rows and entries of a chunk of a large component, and columns of a block of
# its products.
PRODUCT_ROWS, PRODUCT_ENTRIES, PRODUCT_COLUMNS = 256, 1_000_000, 4096
# Largest number of ids that is broadcast (8 bytes each).
BROADCAST_IDS = 1_000_000
FREQUENT = 65_535  # stands for the number of rows of a frequent column


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(32))


def n_gram_sets(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct 64-bit n-gram hashes of each text: of words lower-cased
    in A-Z; of the whole sequence when it is shorter than an n-gram; none
    without words."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    counts = np.diff(split.offsets.to_numpy())
    flat = split.flatten()
    full = pc.not_equal(flat, "")
    if not pc.all(full, min_count=0).as_py():
        keep = full.to_numpy(zero_copy_only=False)
        doc = np.repeat(np.arange(len(counts)), counts)[keep]
        counts, flat = np.bincount(doc, minlength=len(counts)), flat.filter(full)
    coded = flat.dictionary_encode()
    names = np.array(coded.dictionary.to_pylist(), dtype=object)
    h = (pd.util.hash_array(names, categorize=False) if len(names) else np.zeros(0, np.uint64))[coded.indices.to_numpy()]
    sums = np.zeros(max(len(h) - N_GRAM + 1, 0), np.uint64)
    for k in range(N_GRAM):
        sums += h[k : len(h) - N_GRAM + 1 + k] * MULTIPLIERS[k] if len(sums) else sums
    grams = mixed(sums)
    out, at = [], 0
    for n in counts.tolist():
        if n >= N_GRAM:
            out.append(np.unique(grams[at : at + n - N_GRAM + 1]))
        elif n:
            out.append(mixed((h[at : at + n] * MULTIPLIERS[:n]).sum(keepdims=True) + np.uint64(n)))
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out


def class_of(grams: np.ndarray) -> int:
    """64 bits of a cryptographic hash of the set."""
    return int.from_bytes(hashlib.blake2b(grams.tobytes(), digest_size=8).digest(), "little", signed=True)


def thinned(keys: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """At most ``k`` heavy-hitter counters: all are lowered by the (k+1)-th."""
    if len(keys) > k:
        counts = counts - np.partition(counts, -(k + 1))[-(k + 1)]
        keys, counts = keys[counts > 0], counts[counts > 0]
    return keys, counts


def row_classes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (kind 0: id, class, size of the set) and heavy-hitter counters
    (kind 1: column, count) of all documents, in one pass."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    fields = T.StructType([
        T.StructField("kind", T.IntegerType()), T.StructField("id", rows.schema["id"].dataType),
        T.StructField("key", T.LongType()), T.StructField("n", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        keys, counts, id_type = np.zeros(0, np.uint64), np.zeros(0, np.int64), pa.int64()
        for whole in batches:
            for batch in text_slices(whole, size=SLICE):
                id_type = batch.column(0).type
                sets = n_gram_sets(batch.column(1))
                classes = [class_of(s) if len(s) else None for s in sets]
                sizes = [len(s) for s in sets]
                kinds = pa.array([0] * len(sets), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [kinds, batch.column(0), pa.array(classes, pa.int64()), pa.array(sizes, pa.int64())], names=fields.names
                )
                k, c = np.unique(np.concatenate([keys, *sets]), return_counts=True)
                c[np.searchsorted(k, keys)] += counts - 1
                keys, counts = thinned(k, c, HEAVY_COUNTERS)
        hand_back_memory()
        if len(keys):
            yield pa.RecordBatch.from_arrays(
                [pa.array([1] * len(keys), pa.int32()), pa.nulls(len(keys), id_type),
                 pa.array(keys.view(np.int64)), pa.array(counts)], names=fields.names,
            )

    return rows.mapInArrow(run, fields)


def pack_rows(classes: np.ndarray, counts: np.ndarray, *entries: np.ndarray) -> bytes:
    """Rows (class, number of entries, at most 255) and their entries as one
    blob."""
    head = np.array([len(classes), len(entries[0]), *[e.dtype.itemsize for e in entries]], "<i8")
    return b"".join([head.tobytes(), classes.astype("<i8").tobytes(), counts.astype("<u1").tobytes(),
                     *[e.tobytes() for e in entries]])


def unpack_rows(blobs: list[bytes]) -> list[np.ndarray]:
    """[class, first entry column, second entry column] of all entries of some
    blobs, in the widths they were packed with."""
    out: list[list[np.ndarray]] = [[], [], []]
    for blob in blobs:
        rows, entries, *widths = np.frombuffer(blob, "<i8", 4).tolist()
        at = 32
        classes = np.frombuffer(blob, "<i8", rows, at)
        counts = np.frombuffer(blob, "<u1", rows, at + 8 * rows)
        at += 9 * rows
        out[0].append(np.repeat(classes, counts))
        for i, width in enumerate(widths):
            out[1 + i].append(np.frombuffer(blob, f"<u{width}", entries, at))
            at += width * entries
    empty = [np.zeros(0, np.int64)]
    return [np.concatenate(x or empty) for x in out]


def grouped_blobs(part: np.ndarray, row: np.ndarray, classes: np.ndarray, *entries: np.ndarray):
    """(part, blob) for entries in order of part, then row."""
    edges = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(part)], strict=True):
        if a == b:
            continue
        runs = np.concatenate([[0], np.flatnonzero(np.diff(row[a:b])) + 1])
        held = np.diff(np.concatenate([runs, [b - a]]))
        # A row with more entries than a head counts has several heads.
        starts = a + np.flatnonzero((np.arange(b - a) - np.repeat(runs, held)) % 255 == 0)
        counts = np.diff(np.concatenate([starts, [b]]))
        yield int(part[a]), pack_rows(classes[row[starts]], counts, *[e[a:b] for e in entries])


def blob_batch(parts: list[tuple[int, bytes]], name: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([p for p, _ in parts], pa.int32()), pa.array([b for _, b in parts], pa.binary())], names=[name, "data"]
    )


def shared_columns(docs: DataFrame, id_col: str, text_col: str, frequent: np.ndarray, bits: int) -> DataFrame:
    """(class, n, shared): the rows that can have a partner, with the columns
    they share with other rows, rarest first.

    ``bits`` of the hash number the column blocks, 40 more tell the columns of
    a block apart.  Frequent columns go round the blocks.
    """
    blocks = 1 << bits
    rows = docs.select(F.col(id_col), F.col(text_col))

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole, size=SLICE):
                distinct = {class_of(s): s for s in n_gram_sets(batch.column(1)) if len(s)}
                if not distinct:
                    continue
                classes = np.fromiter(distinct, np.int64, len(distinct))
                sizes = np.array([len(s) for s in distinct.values()], np.int64)
                grams = np.concatenate(list(distinct.values()))
                row = np.repeat(np.arange(len(sizes)), sizes)
                at = np.minimum(np.searchsorted(frequent, grams), max(len(frequent) - 1, 0))
                often = frequent[at] == grams if len(frequent) else np.zeros(len(grams), bool)
                parts: list[tuple[int, bytes]] = []
                rare, rare_row = grams[~often], row[~often]
                block = (rare >> np.uint64(64 - bits)).astype(np.int32) if bits else np.zeros(len(rare), np.int32)
                low = (rare >> np.uint64(max(0, 24 - bits))) & np.uint64((1 << 40) - 1)
                order = np.argsort(block, kind="stable")
                low = low[order]
                parts += grouped_blobs(block[order], rare_row[order], classes,
                                       (low & np.uint64(0xFFFFFFFF)).astype("<u4"), (low >> np.uint64(32)).astype("<u1"))
                # Frequent columns go to the rows' part at once, and with them
                # each row's size, marked by a column count of 0.
                column = np.concatenate([at[often] * (blocks + 1) + blocks, sizes])
                count = np.concatenate([np.full(int(often.sum()), FREQUENT, "<u2"), np.zeros(len(sizes), "<u2")])
                to = np.concatenate([row[often], np.arange(len(sizes))])
                owner = ((classes.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(classes), np.int64))
                part = owner[to] + blocks
                order = np.lexsort((to, part))
                parts += grouped_blobs(part[order], to[order], classes, column[order].astype("<u4" if column.max() < 1 << 32 else "<u8"),
                                       count[order])
                yield blob_batch(parts, "block")
        hand_back_memory()

    def multiply(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        blobs = table.column("data").to_pylist()
        if block >= blocks:  # frequent columns: on to the rows' part
            return pa.table({"part": pa.array([block - blocks] * len(blobs), pa.int32()), "data": pa.array(blobs, pa.binary())})
        every, low, high = unpack_rows(blobs)
        del blobs
        parts: list[tuple[int, bytes]] = []
        columns = 0
        step = high.astype(np.uint16) * BLOCK_STEPS >> 8
        for i in range(BLOCK_STEPS):
            mine = step == i
            key = low[mine].astype(np.uint64) | (high[mine].astype(np.uint64) << np.uint64(32))
            classes = every[mine]
            order = np.lexsort((classes, key))
            key, classes = key[order], classes[order]
            fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (classes[1:] != classes[:-1])])[: len(key)]
            key, classes = key[fresh], classes[fresh]
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[: len(key)])
            held = np.diff(np.concatenate([starts, [len(key)]]))
            several = np.repeat(held >= 2, held)
            column = ((np.repeat(np.cumsum(held >= 2) - 1, held) + columns) * (blocks + 1) + block)[several]
            columns += int((held >= 2).sum())
            count = np.minimum(np.repeat(held, held), FREQUENT - 1)[several]
            classes = classes[several]
            order = np.argsort(classes.view(np.uint64), kind="stable")
            classes, column, count = classes[order], column[order], count[order]
            kind = "<u4" if not len(column) or column.max() < 1 << 32 else "<u8"
            starts = np.flatnonzero(np.concatenate([[True], classes[1:] != classes[:-1]])[: len(classes)])
            row = np.repeat(np.arange(len(starts)), np.diff(np.concatenate([starts, [len(classes)]])))
            part = (classes.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(classes), np.int64)
            parts += grouped_blobs(part, row, classes[starts], column.astype(kind), count.astype("<u2"))
            del key, classes, order, column, count, row, part, several, held, mine, fresh, starts
        out = pa.Table.from_batches([blob_batch(parts, "part")])
        del every, low, high, step, parts
        hand_back_memory()
        return out

    def collect_rows(table: pa.Table) -> pa.Table:
        classes, column, count = unpack_rows(table.column("data").to_pylist())
        order = np.lexsort((column, count, classes))
        classes, column, count = classes[order], column[order].astype(np.int64), count[order]
        fresh = np.concatenate([[True], (classes[1:] != classes[:-1]) | (column[1:] != column[:-1]) | (count[1:] != count[:-1])])
        fresh = fresh[: len(classes)]
        classes, column, count = classes[fresh], column[fresh], count[fresh].astype(np.float64)
        # Each row's size comes first, then its columns.
        first = np.flatnonzero(count == 0)
        sizes = column[first]
        held = np.diff(np.concatenate([first, [len(classes)]])) - 1
        able = (held > 0) & (5 * held >= 4 * sizes)
        keep = np.repeat(able, held + 1) & (count > 0)
        ids, sizes, held, column, count = classes[first][able], sizes[able], held[able], column[keep], count[keep]
        offsets = np.concatenate([[0], np.cumsum(held)])
        # Rows whose columns many others have lie in the middle of their group.
        centre = (np.add.reduceat(count, offsets[:-1]) if len(held) else count) / np.maximum(sizes, 1)
        shared = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), pa.array(column, pa.int64()))
        out = pa.table({"class": pa.array(ids, pa.int64()), "n": pa.array(sizes, pa.int64()),
                        "centre": pa.array(centre, pa.float64()), "shared": shared.cast(pa.list_(pa.int64()))})
        del classes, sizes, column, count, order, fresh, keep
        hand_back_memory()
        return out

    blobs = rows.mapInArrow(entries, "block int, data binary")
    products = blobs.groupBy("block").applyInArrow(multiply, "part int, data binary")
    return products.groupBy("part").applyInArrow(collect_rows, "class long, n long, centre double, shared array<long>")


def needed(a: Column, b: Column) -> Column:
    """9 * overlap must reach this for a Jaccard similarity of 0.8."""
    return 4 * (a + b)


def with_roots(prefix: DataFrame, roots: DataFrame | None = None) -> DataFrame:
    """Prefix rows with their component (at first each class is its own) and
    their column's number of rows, of the columns that hold rows of several
    components."""
    if roots is None:
        marked = prefix.withColumn("root", F.col("class"))
    else:
        marked = prefix.join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))
    columns = marked.groupBy("column").agg(
        F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("many")
    )
    return marked.join(columns.where("lo <> hi").select("column", "many"), "column")


def star_pairs(prefix: DataFrame, orders: list[Column]) -> DataFrame:
    """Some pairs of each column, linear in its rows.

    In each of the given orders (alike in all columns, so that most pairs
    recur and count once) a row is paired with the row before it and with the
    first row of its part of the column, and the parts' first rows likewise.
    Pairs inside one component are left out.
    """
    cols = F.struct("class", "n", "left", "root")

    def pairs(rows: DataFrame) -> DataFrame:
        other = F.explode(F.array_distinct(F.array("hub", "before"))).alias("o")
        met = rows.where("before IS NOT NULL").select("class", "n", "left", "root", other)
        able = 9 * F.least("left", "o.left") >= needed(F.col("n"), F.col("o.n"))
        return met.where((F.col("root") != F.col("o.root")) & able).select(
            F.least("class", "o.class").alias("a"), F.greatest("class", "o.class").alias("b")
        )

    # All orders by one exchange of the parts and one of their first rows.
    inner = prefix.withColumn("salt", F.pmod(F.xxhash64("class"), F.lit(64)))
    for i, order in enumerate(orders):
        w = Window.partitionBy("column", "salt").orderBy(order, "class")
        inner = inner.withColumn(f"hub{i}", F.first(cols).over(w)).withColumn(f"before{i}", F.lag(cols).over(w))
    met = [F.struct(F.lit(i).alias("by"), order.cast("double").alias("at"), F.col(f"hub{i}").alias("hub"),
                    F.col(f"before{i}").alias("before")) for i, order in enumerate(orders)]
    inner = inner.select("column", "class", "n", "left", "root", F.inline(F.array(*met)))
    w = Window.partitionBy("column", "by").orderBy("at", "class")
    firsts = inner.where("before IS NULL").withColumn("hub", F.first(cols).over(w)).withColumn("before", F.lag(cols).over(w))
    return pairs(inner).unionByName(pairs(firsts)).distinct()


def open_pairs(marked: DataFrame, partners: int | None = None, seed: int = 0) -> DataFrame:
    """Pairs of a common column that lie in different components so far and
    whose sizes and positions allow the overlap: all of them, or those of
    about ``partners`` rows that each row of a column is dealt with.

    Rows meet by (column, class of size), partners' sizes lying within 4/5.
    """
    marked = marked.withColumn("sized", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.25))).cast("int"))
    marked = marked.withColumn("deal", F.lit(0).cast("bigint"))
    if partners:
        # Parts by powers of two, so that a pair met in one column is met in
        # the others as well.
        parts = F.pow(2.0, F.greatest(F.lit(0.0), F.ceil(F.log2(F.col("many") / F.lit(partners))).cast("double")))
        marked = marked.withColumn("deal", F.pmod(F.xxhash64("class", F.lit(seed)), parts.cast("bigint")))
    carried = ("class", "n", "left", "root")
    small = marked.select("column", "sized", "deal", *[F.col(c).alias(f"x_{c}") for c in carried])
    # Logarithms round: the class below is met as well.
    large = marked.withColumn("sized", F.explode(F.array(F.col("sized") - 2, F.col("sized") - 1, F.col("sized")))).select(
        "column", "sized", "deal", *[F.col(c).alias(f"y_{c}") for c in carried]
    )
    able = (
        (F.col("x_root") != F.col("y_root"))
        & ((F.col("x_n") < F.col("y_n")) | ((F.col("x_n") == F.col("y_n")) & (F.col("x_class") < F.col("y_class"))))
        & (9 * F.least("x_left", "y_left") >= needed(F.col("x_n"), F.col("y_n")))
    )
    joined = small.join(large, ["column", "sized", "deal"]).where(able)
    return joined.select(
        F.least("x_class", "y_class").alias("a"), F.greatest("x_class", "y_class").alias("b")
    ).distinct()


def linked_pairs(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs whose full overlap count reaches the threshold."""
    left = rows.select(F.col("class").alias("a"), F.col("n").alias("a_n"), F.col("shared").alias("a_shared"))
    right = rows.select(F.col("class").alias("b"), F.col("n").alias("b_n"), F.col("shared").alias("b_shared"))
    overlap = F.size(F.array_intersect("a_shared", "b_shared"))
    return (
        pairs.join(left, "a").join(right, "b")
        .where(9 * overlap >= needed(F.col("a_n"), F.col("b_n")))
        .select("a", "b")
    )


def stars(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, member) for all ends but the least of each component of some
    edges."""
    ids, at = np.unique(np.concatenate([low, high]), return_inverse=True)
    x, y = at[: len(low)], at[len(low) :]
    root = np.arange(len(ids))
    while len(x):
        least = np.minimum(root[x], root[y])
        hooked = root.copy()
        np.minimum.at(hooked, root[x], least)
        np.minimum.at(hooked, root[y], least)
        while not np.array_equal(hooked, hooked[hooked]):
            hooked = hooked[hooked]
        root = hooked[root]
        apart = root[x] != root[y]
        x, y = x[apart], y[apart]
    member = root != np.arange(len(ids))
    return ids[root[member]], ids[member]


def starred(edges: DataFrame) -> DataFrame:
    """Edges that connect the same, as stars of each task's edges: a higher
    end comes once for so many edges of a task, however many it had."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def star() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(x) for x in stars(*[c.to_numpy() for c in table.columns])], names=["a", "b"]
            )

        for batch in batches:
            held.append(batch)
            if sum(x.num_rows for x in held) >= STAR_EDGES:
                yield star()
        if held:
            yield star()
        hand_back_memory()

    return edges.mapInArrow(run, "a long, b long")


def connected_roots(links: DataFrame) -> DataFrame:
    """(class, root) for every class with a link; root is the smallest class
    of its component.  Alternating star steps: a lower end gives its edges to
    its least neighbour below, then a higher end gives what it has below to
    the least of that.  The second step needs one exchange, where no key has
    more edges than there were stars.  It ends when no class has two lower
    ends, or a lower end and higher ones.  Each round is written, as its plan
    names its edges twice."""

    def small_stars(edges: DataFrame) -> DataFrame:
        least = F.min("a").over(Window.partitionBy("b"))
        return starred(edges).withColumn("m", least).select(
            F.col("m").alias("a"), F.when(F.col("a") == F.col("m"), F.col("b")).otherwise(F.col("a")).alias("b")
        )

    edges = written(small_stars(links.select("a", "b")), "links")
    while True:
        ends = edges.select(F.col("b").alias("v"), F.col("a").alias("below"), F.lit(False).alias("above")).unionByName(
            edges.select(F.col("a").alias("v"), F.lit(None).cast("bigint").alias("below"), F.lit(True).alias("above"))
        )
        ends = ends.groupBy("v").agg(F.min("below").alias("lo"), F.max("below").alias("hi"), F.max("above").alias("above"))
        if not ends.where((F.col("lo") != F.col("hi")) | (F.col("lo").isNotNull() & F.col("above"))).count():
            break
        least = edges.groupBy(F.col("b").alias("u")).agg(F.min("a").alias("m"))
        lower = edges.join(least, F.col("a") == F.col("u"), "left").select(F.coalesce("m", "a").alias("a"), "b")
        edges = written(small_stars(lower), "stars")
    pairs = edges.select(F.col("b").alias("class"), F.col("a").alias("root"))
    return pairs.unionByName(edges.select(F.col("a").alias("class"), F.col("a").alias("root"))).groupBy("class").agg(
        F.min("root").alias("root")
    )


def merged_roots(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Roots after some more links: the components are merged, not the rows."""
    ends = links
    for end in ("a", "b"):
        ends = ends.join(roots, ends[end] == roots["class"], "left").withColumn(end, F.coalesce("root", end)).select("a", "b")
    ends = ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b")
    merged = written(connected_roots(ends), "merged").select(F.col("class").alias("old"), F.col("root").alias("new"))
    moved = roots.join(merged, F.col("root") == F.col("old"), "left").select("class", F.coalesce("new", "root").alias("root"))
    fresh = merged.join(roots, F.col("old") == F.col("class"), "left_anti").select(
        F.col("old").alias("class"), F.col("new").alias("root")
    )
    return written(moved.unionByName(fresh), "roots")


def link_sums(left: tuple[np.ndarray, ...], right: tuple[np.ndarray, ...] | None = None) -> list[np.ndarray]:
    """For rows (size, copies, number of columns, their columns one after the
    other) the copies they are linked with: of each other, or of the rows on
    the right and the other way round.  Overlaps are added up over blocks of
    columns, each a product of two incidence matrices."""
    sides = [left] if right is None else [left, right]
    rows = [np.repeat(np.arange(len(held)), held) for _, _, held, _ in sides]
    names = [np.unique(side[3]) for side in sides]
    common = names[0] if right is None else np.intersect1d(*names, assume_unique=True)
    entries = []
    for row, (_, _, _, columns) in zip(rows, sides, strict=True):
        at = np.searchsorted(common, columns)
        known = at < len(common)
        known[known] = common[at[known]] == columns[known]
        order = np.argsort(at[known], kind="stable")
        entries.append((at[known][order], row[known][order]))
    overlap = np.zeros((len(sides[0][0]), len(sides[-1][0])), np.int64)
    for first in range(0, len(common), PRODUCT_COLUMNS):
        parts = []
        for (at, row), (sizes, *_) in zip(entries, sides, strict=True):
            a, b = np.searchsorted(at, [first, first + PRODUCT_COLUMNS])
            part = np.zeros((len(sizes), min(PRODUCT_COLUMNS, len(common) - first)), np.float32)
            part[row[a:b], at[a:b] - first] = 1
            parts.append(part)
        overlap += (parts[0] @ parts[-1].T).astype(np.int64)
    linked = 9 * overlap >= 4 * (sides[0][0][:, None] + sides[-1][0][None, :])
    if right is None:
        np.fill_diagonal(linked, False)
        return [linked @ left[1]]
    return [linked @ right[1], linked.T @ left[1]]


def link_counts(able: DataFrame, roots: DataFrame, copies: DataFrame) -> DataFrame:
    """(class, links): for every class with a link the documents of all other
    classes that it is linked with.

    No pair of different components reaches the threshold, so the pairs to
    count are those inside the components: all of them, however they came to
    be one component.  Small components share tasks; a large one is cut into
    chunks of rows of like size, with a task for each two chunks whose sizes
    allow a link.  Tasks give out sums by row, so no table grows with the
    pairs.
    """
    sized = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.25))).cast("bigint")
    members = able.select("class", "n", F.size("shared").alias("m"), sized.alias("sized"))
    members = written(members.join(roots, "class").join(copies, "class"), "members")
    by_size = members.groupBy("root", "sized").agg(F.count(F.lit(1)).alias("rows"), F.sum("m").alias("entries"))
    parts = F.ceil(F.greatest(F.col("rows") / PRODUCT_ROWS, F.col("entries") / PRODUCT_ENTRIES)).cast("bigint")
    per_root = by_size.groupBy("root").agg(
        F.sum("rows").alias("rows"), F.sum("entries").alias("entries"),
        F.map_from_entries(F.collect_list(F.struct("sized", parts.alias("parts")))).alias("parts"),
    )
    is_large = (F.col("rows") > PRODUCT_ROWS) | (F.col("entries") > PRODUCT_ENTRIES)
    per_root = written(per_root, "component-sizes")
    small = per_root.where(~is_large).agg(F.sum("rows"), F.sum("entries")).first()
    bins = int(np.ceil(max((small[0] or 0) / (8 * PRODUCT_ROWS), (small[1] or 0) / PRODUCT_ENTRIES, 1)))
    large = per_root.where(is_large).select("root", "parts")
    large = F.broadcast(large) if large.count() <= BROADCAST_IDS else large

    chunk = lambda size, part: size * F.lit(1 << 32) + part
    here = F.element_at("parts", F.col("sized"))
    own = F.coalesce(chunk(F.col("sized"), F.pmod(F.xxhash64("class"), here)), F.lit(-1))
    # Logarithms round: two classes of size off are met as well.
    near = F.filter(F.sequence(F.col("sized") - 2, F.col("sized") + 2), lambda s: F.map_contains_key("parts", s))
    met = F.flatten(
        F.transform(
            near, lambda s: F.transform(F.sequence(F.lit(0).cast("bigint"), F.element_at("parts", s) - 1), lambda j: chunk(s, j))
        )
    )
    met = F.when(F.col("parts").isNull(), F.array(F.lit(-1).cast("bigint"))).otherwise(met)
    home = F.when(F.col("parts").isNull(), F.pmod(F.xxhash64("root"), F.lit(bins))).otherwise(F.col("root"))
    dealt = (
        members.join(large, "root", "left")
        .select("class", "root", "copies", home.alias("home"), own.alias("own"), F.explode(met).alias("other"))
        .select("class", "root", "copies", "home", "own",
                F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"))
        .join(able.select("class", "n", "shared"), "class")
    )

    def product(table: pa.Table) -> pa.Table:
        of = lambda name: table.column(name).to_numpy()
        classes, root, own, x, y = of("class"), of("root"), of("own"), of("x")[0], of("y")[0]
        sizes, copies = of("n"), of("copies")
        shared = table.column("shared").combine_chunks()
        held = pc.list_value_length(shared).to_numpy(zero_copy_only=False).astype(np.int64)
        columns, ends = shared.flatten().to_numpy(), np.cumsum(held)

        def rows_at(at: np.ndarray) -> tuple[np.ndarray, ...]:
            lists = [columns[ends[i] - held[i] : ends[i]] for i in at.tolist()]
            return sizes[at], copies[at], held[at], np.concatenate(lists or [columns[:0]])

        links = np.zeros(len(classes), np.int64)
        if x != y:
            sides = [np.flatnonzero(own == x), np.flatnonzero(own == y)]
            if len(sides[0]) and len(sides[1]):
                links[sides[0]], links[sides[1]] = link_sums(rows_at(sides[0]), rows_at(sides[1]))
        else:
            order = np.argsort(root, kind="stable")
            for at in np.split(order, np.flatnonzero(np.diff(root[order])) + 1):
                links[at] = link_sums(rows_at(at))[0]
        out = pa.table({"class": pa.array(classes[links > 0]), "links": pa.array(links[links > 0])})
        del shared, columns
        hand_back_memory()
        return out

    products = dealt.groupBy("home", "x", "y").applyInArrow(product, "class long, links long")
    return written(products.groupBy("class").agg(F.sum("links").alias("links")), "link-counts")


def joined_documents(docs: DataFrame, id_col: str, text_col: str, links: bool) -> DataFrame:
    """(id, n_shingles, class_id, component_id) per document, with n_links if
    they are asked for."""
    with small_batches(docs.sparkSession):
        counted = written(row_classes(docs, id_col, text_col), "classes")
    rows = counted.where("kind = 0").select("id", F.col("key").alias("class"), "n")
    total = rows.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("entries")).first()
    often = max(FREQUENT_ROWS, FREQUENT_SHARE * total["docs"])
    # Their counts sum to at most the entries, so there are at most
    # entries / often columns: a bound by the mean size of a document.
    heavy = counted.where("kind = 1").groupBy("key").agg(F.sum("n").alias("c")).where(F.col("c") >= often).select("key")
    frequent = np.sort(np.array([r["key"] for r in heavy.collect()], np.int64).view(np.uint64))
    bits = max(0, int(np.ceil(np.log2(max((total["entries"] or 0) / BLOCK_ENTRIES, 1)))))

    with small_batches(docs.sparkSession):
        buckets = max(1 << bits, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        able, drop_able = written_in_buckets(
            shared_columns(docs, id_col, text_col, frequent, max(bits, 5)), "rows", "class", buckets
        )
    need = F.ceil(F.col("n") * 4 / 5).cast("int")
    first = F.slice("shared", F.lit(1), F.size("shared") - need + 1)
    prefix = able.select("class", "n", "centre", F.size("shared").alias("m"), F.posexplode(first).alias("at", "column")).select(
        "class", "n", "centre", "column", (F.col("m") - F.col("at")).alias("left")
    )
    prefix = written(prefix, "prefix")
    # Stars first, around the rows in the middle of their groups and by size;
    # then rows with a few and with more partners dealt to them; at last all
    # pairs that are left between components.
    stars = star_pairs(written(with_roots(prefix), "star-columns"), [-F.col("centre"), F.col("n")])
    roots = written(connected_roots(written(linked_pairs(stars, able), "star-links")), "star-roots")
    marked = written(with_roots(prefix, roots), "open-columns")
    partners: int | None = FIRST_PARTNERS
    while partners:
        # No dealing where it is not much less than meeting all rows.
        many = marked.agg(F.max("many")).first()[0] or 0
        partners = partners if 4 * partners < many else None
        found = written(linked_pairs(open_pairs(marked, partners, partners or 0), able), "open-links")
        if found.limit(1).count():
            roots = merged_roots(roots, found)
            if partners:
                marked = written(with_roots(marked.drop("root", "many"), roots), "open-columns")
        partners = partners and 8 * partners

    # Everything that reads the buckets is written when link_counts returns.
    classes = rows.where("n > 0").groupBy("class").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("copies"))
    classes = written(classes, "copies")
    grouped = classes.join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))
    found = [F.col("copies") - 1]
    if links:
        grouped = grouped.join(link_counts(able, roots, classes.select("class", "copies")), "class", "left")
        found = [F.col("copies") - 1 + F.coalesce("links", F.lit(0))]
    drop_able()
    least = grouped.groupBy("root").agg(F.min("class_id").alias("component_id"))
    grouped = grouped.join(least, "root").select("class", "class_id", "component_id", found[0].alias("n_links"))
    joined = rows.where("n > 0").join(grouped, "class").select("id", "n", "class_id", "component_id", "n_links")
    alone = rows.where("n = 0").select(
        "id", "n", F.col("id").alias("class_id"), F.col("id").alias("component_id"), F.lit(0).cast("bigint").alias("n_links")
    )
    out = joined.unionByName(alone).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "class_id", "component_id", "n_links"
    )
    return out if links else out.drop("n_links")


def jaccard_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, class_id, component_id, n_links) per document: the
    similarity join of the documents with each other.

    Two documents are linked when 100 * intersection >= 80 * union of their
    sets of 5-word n-grams.  class_id is the smallest id of the documents with
    an equal set, component_id the smallest id reachable over links, n_links
    the number of other documents (rows) linked with this one: its copies and
    all documents of every class linked with its own, each pair counted in
    full.

    NULL, empty and blank texts have no n-grams and are linked with nothing
    (class and component are their own id); NULL ids take part in links but
    are no smallest id unless all ids are NULL; repeated rows and copies are
    one class; an empty table gives an empty result.
    """
    return joined_documents(docs, id_col, text_col, links=True)


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) of ``jaccard_links`` for those who ask
    for components only: pairs inside one component are not counted."""
    return joined_documents(docs, id_col, text_col, links=False).select(id_col, "n_shingles", "component_id")


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, with all its columns: the row with the least
    id (NULL last), among rows with that id the one with the least row key.

    Rows are told apart by a key that is written with them once, so NULL,
    repeated and reused ids take no other row along.  Rows without n-grams are
    components of their own and all stay.  The keys to leave out are broadcast
    behind a check of their number; beyond it the join shuffles.
    """
    keyed = written(docs.withColumn("__row", F.monotonically_increasing_id()), "keyed")
    components = written(jaccard_components(keyed, "__row", text_col).select("__row", "component_id"), "components")
    ids = keyed.select("__row", F.col(id_col).alias("__id"))
    first = F.min(F.struct(F.col("__id").isNull().alias("none"), "__id", "__row"))
    stay = components.join(ids, "__row").groupBy("component_id").agg(first.alias("first")).select(F.col("first.__row").alias("__row"))
    out = written(components.select("__row").join(stay, "__row", "left_anti"), "left-out")
    out = F.broadcast(out) if out.count() <= BROADCAST_IDS else out
    return keyed.join(out, "__row", "left_anti").drop("__row")
