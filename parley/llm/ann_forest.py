"""Approximate nearest neighbours by largest inner product: a forest of
random-projection trees searched through one shared priority queue, then exact
scores of the leaf candidates.

Vectors get one more component, sqrt(M^2 - |x|^2), and queries a zero, so that
the largest inner product is the smallest angle.  Trees are built on a bounded
sample; every vector is put into its leaf of every tree.  A query descends all
trees at once: the queue holds the unvisited branches of all trees by the sum
of squared distances to the hyperplanes crossed, and the nearest branch is
taken next until enough leaves are found.

Leaves next to each other in a tree form a block.  The vectors of a block and
the queries that probe any of its leaves meet in one task and are scored by a
matrix product; leaves a query does not probe are masked.  Blocks with many
vectors or queries are split.

A query's leaves are taken in waves, each several times as many as the one
before.  The worst of the best scores found so far is the floor of the next
wave: a vector below it cannot be among the nearest and does not leave its
task.  So a wave returns about as many vectors of a query as its growth lets
in, not the best of every block.

Of equal vectors only the k + 1 smallest ids
can be among a query's k nearest, so other copies are left out before the
index is built, and equal queries are searched once.
"""

from __future__ import annotations

import bisect
import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.llm.common import bounded_rows, written

BLOCK_LEAVES = 16
WAVE_GROWTH = 8  # times as many leaves from wave to wave, about


@dataclass
class Tree:
    """Node i splits by ``x @ normals[i] < thresholds[i]`` into left[i] and
    right[i]; a leaf has left[i] = -1 and its number in right[i]."""

    normals: np.ndarray
    thresholds: np.ndarray
    left: np.ndarray
    right: np.ndarray

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        while True:
            inner = np.flatnonzero(self.left[node] >= 0)
            if not len(inner):
                return self.right[node]
            at = node[inner]
            below = (x[inner] * self.normals[at]).sum(1) < self.thresholds[at]
            node[inner] = np.where(below, self.left[at], self.right[at])


@dataclass
class Forest:
    trees: list[Tree]
    radius: float
    leaves: int

    def lift(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        rest = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.radius**2 - (x**2).sum(1), 0.0))
        return np.concatenate([x, rest[:, None]], axis=1)

    def probes(self, q: np.ndarray, wanted: int, sizes: list[np.ndarray], rows: int) -> list[tuple[int, int]]:
        """(tree, leaf) of at least ``wanted`` nearest leaves that together
        hold at least ``rows`` vectors (all leaves, if there are not as many)."""
        projected = [(t.normals @ q - t.thresholds).tolist() for t in self.trees]
        queue = [(0.0, t, 0) for t in range(len(self.trees))]
        out, held = [], 0
        while queue and (len(out) < wanted or held < rows):
            far, t, node = heapq.heappop(queue)
            margins = projected[t]
            left, right = self.left_lists[t], self.right_lists[t]
            while left[node] >= 0:
                margin = margins[node]
                near, other = (left[node], right[node]) if margin < 0 else (right[node], left[node])
                heapq.heappush(queue, (far + margin * margin, t, other))
                node = near
            out.append((t, right[node]))
            held += int(sizes[t][right[node]])
        return out

    def prepare(self) -> None:
        self.left_lists = [t.left.tolist() for t in self.trees]
        self.right_lists = [t.right.tolist() for t in self.trees]


def grow_tree(x: np.ndarray, leaf_rows: float, rng: np.random.Generator) -> Tree:
    """A tree whose splits are medians along the difference of two sample
    points; a node of at most ``leaf_rows`` points (or of equal ones) is a
    leaf."""
    normals, thresholds, left, right = [], [], [], []
    leaves = 0
    stack = [(np.arange(len(x)), -1, False)]
    while stack:
        rows, parent, is_right = stack.pop()
        me = len(left)
        if parent >= 0:
            (right if is_right else left)[parent] = me
        normal, threshold, below = np.zeros(x.shape[1]), 0.0, None
        if len(rows) > leaf_rows:
            for _ in range(4):
                a, b = x[rng.choice(rows, 2, replace=False)]
                normal = a - b if (a != b).any() else rng.normal(size=x.shape[1])
                normal = normal / np.linalg.norm(normal)
                projected = x[rows] @ normal
                threshold = float(np.median(projected))
                below = projected < threshold
                if below.any() and not below.all():
                    break
                below = None
        normals.append(normal)
        thresholds.append(threshold)
        if below is None:
            left.append(-1)
            right.append(leaves)
            leaves += 1
        else:
            left.append(0)
            right.append(0)
            stack.append((rows[~below], me, True))
            stack.append((rows[below], me, False))
    return Tree(np.array(normals), np.array(thresholds), np.array(left), np.array(right))


def build_forest(sample: np.ndarray, total: int, radius: float, trees: int, leaf_size: int, seed: int) -> Forest:
    """Trees with leaves of about ``leaf_size`` of the ``total`` vectors, but
    at least 8 sample points."""
    forest = Forest([], radius, 0)
    lifted = forest.lift(sample)
    leaf_rows = max(8.0, leaf_size * len(sample) / max(total, 1))
    forest.trees = [grow_tree(lifted, leaf_rows, np.random.default_rng([seed, t])) for t in range(trees)]
    forest.leaves = sum(int((t.left < 0).sum()) for t in forest.trees)
    forest.prepare()
    return forest


def probe_count(leaves: int) -> int:
    """Leaves a query probes; grows more slowly than the number of leaves."""
    return math.ceil(1.5 * leaves**0.75)


def wave_ends(wanted: int) -> list[int]:
    """Leaves a query has probed after each wave, in steps that grow alike."""
    waves = max(1, round(math.log(max(wanted, 1), WAVE_GROWTH)))
    return [math.ceil(wanted ** ((w + 1) / waves) - 1e-9) for w in range(waves)]


def usable_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) without NULL ids, NULL, zero or empty vectors and vectors with
    NULL or non-finite components."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(
        F.col(id_col).isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0)
    ).select(F.col(id_col).alias("id"), v.alias("v"))


def smallest_ids(rows: DataFrame, keep: int) -> DataFrame:
    """The ``keep`` smallest ids of each group of equal vectors; a hot group is
    thinned out by parts first."""
    salted = Window.partitionBy("h1", "h2", F.pmod(F.xxhash64("id"), F.lit(64))).orderBy("id")
    whole = Window.partitionBy("h1", "h2").orderBy("id")
    out = rows
    for window in (salted, whole):
        out = out.withColumn("__r", F.row_number().over(window)).where(F.col("__r") <= keep).drop("__r")
    return out


def vectors_of(column: pa.Array) -> np.ndarray:
    """Row matrix of a column of equally long lists."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def best_of_block(
    v: np.ndarray, ids: np.ndarray, leaf: np.ndarray, q: np.ndarray, bits: np.ndarray, floor: np.ndarray, k: int
):
    """For each query the ``k`` best (score desc, id asc) of the leaves whose
    bits are set, none below the query's floor: (query row, vector row, score).

    The matrix product chooses (with a margin for its rounding); scores are
    then computed component by component in one fixed order.
    """
    scores = q @ v.T
    probed = ((bits[:, None] >> np.arange(BLOCK_LEAVES)[None, :]) & 1).astype(bool)
    scores[~probed[:, leaf]] = -np.inf
    slack = 1e-9 * (np.linalg.norm(q, axis=1) * (np.linalg.norm(v, axis=1).max() if len(v) else 0.0))
    at = max(0, scores.shape[1] - k)
    least = np.maximum(np.partition(scores, at, axis=1)[:, at], floor) - slack
    rows, columns = np.nonzero((scores >= least[:, None]) & np.isfinite(scores))
    exact = (q[rows] * v[columns]).sum(1)
    high = exact >= floor[rows]
    rows, columns, exact = rows[high], columns[high], exact[high]
    order = np.lexsort((ids[columns], -exact, rows))
    rows, columns, exact = rows[order], columns[order], exact[order]
    rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
    good = rank < k
    return rows[good], columns[good], exact[good]


def nearest_neighbours(
    vectors: DataFrame,
    queries: Column | None = None,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 20,
    trees: int = 4,
    leaf_size: int = 256,
    sample_rows: int = 16_384,
    seed: int = 11,
    block_rows: int = 8192,
    block_queries: int = 1024,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each row for
    which ``queries`` (a condition on ``id_col``; default: divisible by 20) holds.

    Candidates are all usable rows but those of the query's own id.  Unusable
    vectors and vectors of another length than the most frequent one take no
    part; ties go to the smaller id; repeated rows (same id) count once; with
    at most ``k`` candidates all are returned; an empty table gives an empty
    result.
    """
    spark = vectors.sparkSession
    queries = F.col("id") % 20 == 0 if queries is None else queries
    result = "query_id long, rank int, vec_id long, score double"
    usable = usable_vectors(vectors, id_col, vector_col)
    lengths = usable.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], result)
    dim = lengths[0]["d"]
    # Vectors travel as they are stored; products are in double precision.
    stored = "<f4" if isinstance(vectors.schema[vector_col].dataType.elementType, T.FloatType) else "<f8"
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x))
    base = written(
        usable.where(F.size("v") == dim)
        .select("id", "v", norm.alias("norm"), F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2"))
        .dropDuplicates(["id", "h1", "h2"]),
        "vectors",
    )
    index_rows = written(smallest_ids(base.select("id", "v", "h1", "h2"), k + 1).select("id", "v"), "index-rows")
    totals = base.agg(F.max("norm").alias("radius")).first()
    total = index_rows.count()
    sample = bounded_rows(index_rows, index_rows, "id", sample_rows, "forest").select("id", "v").collect()
    sample = sorted(sample, key=lambda r: (r["id"], r["v"]))[: 2 * sample_rows]
    forest = build_forest(np.array([r["v"] for r in sample], float), total, totals["radius"], trees, leaf_size, seed)

    # Index: every vector in its leaf of every tree.
    cell = T.StructType([
        T.StructField("block", T.IntegerType()), T.StructField("leaf", T.IntegerType()),
        T.StructField("id", T.LongType()), T.StructField("v", T.BinaryType()),
    ])
    stride = 1 << 20  # blocks of one tree are numbered apart from the next's

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = vectors_of(batch.column(1))
            lifted = forest.lift(x)
            raw = pa.array([r.tobytes() for r in x.astype(stored)], pa.binary())
            for t, tree in enumerate(forest.trees):
                leaf = tree.leaf_of(lifted)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(t * stride + leaf // BLOCK_LEAVES, pa.int32()), pa.array(leaf % BLOCK_LEAVES, pa.int32()),
                     batch.column(0).cast(pa.int64()), raw], names=cell.names,
                )

    index = written(index_rows.mapInArrow(place, cell), "index")
    counted = index.groupBy("block", "leaf").agg(F.count(F.lit(1)).alias("n")).collect()  # one row per leaf
    sizes = [np.zeros(int((t.left < 0).sum()) + BLOCK_LEAVES, np.int64) for t in forest.trees]
    for r in counted:
        sizes[r["block"] // stride][r["block"] % stride * BLOCK_LEAVES + r["leaf"]] = r["n"]

    # Probes: one row per distinct query vector, wave and block.
    wanted = probe_count(forest.leaves)
    ends = wave_ends(wanted)
    probe = "q1 long, q2 long, wave int, block int, bits int, q binary"

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = vectors_of(batch.column(2))
            rows: list[int] = []
            waves: list[int] = []
            blocks: list[int] = []
            bits: list[int] = []
            for i, lifted in enumerate(forest.lift(q, query=True)):
                masks: dict[tuple[int, int], int] = {}
                for at, (t, leaf) in enumerate(forest.probes(lifted, wanted, sizes, 2 * (k + 1))):
                    wave = min(bisect.bisect_right(ends, at), len(ends) - 1)
                    key = wave, t * stride + leaf // BLOCK_LEAVES
                    masks[key] = masks.get(key, 0) | 1 << leaf % BLOCK_LEAVES
                rows += [i] * len(masks)
                waves += [wave for wave, _ in masks]
                blocks += [block for _, block in masks]
                bits += masks.values()
            which = pa.array(rows, pa.int64())
            raw = pa.array([r.tobytes() for r in q.astype(stored)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(which), batch.column(1).take(which), pa.array(waves, pa.int32()),
                 pa.array(blocks, pa.int32()), pa.array(bits, pa.int32()), raw.take(which)],
                names=["q1", "q2", "wave", "block", "bits", "q"],
            )

    asked = base.where(queries)
    distinct = asked.groupBy("h1", "h2").agg(F.first("v").alias("v"))
    probes = written(distinct.mapInArrow(search, probe), "probes")

    def score(v: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if v.empty or q.empty:
            return pd.DataFrame({"q1": [], "q2": [], "id": [], "score": []})
        vs, qs = (np.frombuffer(b"".join(x), stored).astype(np.float64).reshape(len(x), -1) for x in (v["v"], q["q"]))
        ids = v["id"].to_numpy()
        bits, floor = q["bits"].to_numpy().astype(np.int64), q["floor"].to_numpy()
        rows, columns, scores = best_of_block(vs, ids, v["leaf"].to_numpy(), qs, bits, floor, k + 1)
        return pd.DataFrame(
            {"q1": q["q1"].to_numpy()[rows], "q2": q["q2"].to_numpy()[rows], "id": ids[columns], "score": scores}
        )

    vector_parts = index.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("vn"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    keys = ["block", "vp", "qp"]
    order = Window.partitionBy("q1", "q2").orderBy(F.desc("score"), "id")
    best = None
    for wave in range(len(ends)):
        now = probes.where(F.col("wave") == wave)
        if best is None:
            now = now.withColumn("floor", F.lit(float("-inf")))
        else:
            floors = best.groupBy("q1", "q2").agg(F.when(F.count(F.lit(1)) > k, F.min("score")).alias("floor"))
            now = now.join(floors, ["q1", "q2"], "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
        # Blocks are split when they hold many vectors or many queries.
        query_parts = now.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / block_queries).cast("int").alias("qn"))
        # At most one row per block of the forest.
        parts = F.broadcast(written(vector_parts.join(query_parts, "block"), "block-parts"))
        left = (
            index.join(parts, "block")
            .withColumn("vp", F.pmod(F.xxhash64("id"), F.col("vn")).cast("int"))
            .withColumn("qp", every("qn"))
            .select(*keys, "leaf", "id", "v")
        )
        right = (
            now.join(parts, "block")
            .withColumn("qp", F.pmod(F.xxhash64("q1", "q2"), F.col("qn")).cast("int"))
            .withColumn("vp", every("vn"))
            .select(*keys, "q1", "q2", "bits", "floor", "q")
        )
        scored = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(score, "q1 long, q2 long, id long, score double")
        found = scored if best is None else best.unionByName(scored)
        found = found.groupBy("q1", "q2", "id").agg(F.max("score").alias("score"))
        best = written(found.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1).drop("r"), "best")

    joined = asked.select(F.col("id").alias("query_id"), "h1", "h2").join(
        best, (F.col("h1") == F.col("q1")) & (F.col("h2") == F.col("q2")) & (F.col("id") != F.col("query_id"))
    )
    rank = F.row_number().over(Window.partitionBy("query_id", "h1", "h2").orderBy(F.desc("score"), "id"))
    return (
        joined.withColumn("rank", rank)
        .where(F.col("rank") <= k)
        .select(F.col("query_id").cast("bigint"), "rank", F.col("id").cast("bigint").alias("vec_id"), "score")
    )
