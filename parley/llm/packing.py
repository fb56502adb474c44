"""Best-fit packing of documents into fixed-length token sequences.

Documents longer than a sequence are cut; what remains is bin packing with at
most ``capacity`` different lengths.  Bin completion with branch and bound
works on the histogram of lengths (at most ``capacity`` counts, whatever the
number of documents): take the largest remaining length, enumerate the
undominated fillings of the room beside it, least waste first, and repeat a
filling as often as the counts allow.  A branch is left when its waste exceeds
what a packing better than the incumbent may waste; the first incumbent is the
best-fit packing.  The resulting plan is a small table of runs; documents get
their rank among those of equal length with distributed window functions and
find their place by a join with the plan.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.llm.common import hand_back_memory, small_batches, written
from parley.llm.sharding import with_slots
from parley.llm.tokens import default_tokenizer, text_slices, worker_encoder

Filling = tuple[tuple[int, int], ...]  # (length, how many), longest first
Run = tuple[Filling, int]  # a filling of a whole sequence, how many sequences


def best_fit_filling(counts: dict[int, int], lengths: list[int], room: int) -> Filling:
    """The greedy filling: again and again the longest piece that fits."""
    out = []
    for length in lengths:
        if length <= room and counts[length]:
            k = min(counts[length], room // length)
            out.append((length, k))
            room -= k * length
            if not room:
                break
    return tuple(out)


def undominated_fillings(
    counts: dict[int, int], lengths: list[int], room: int, keep: int, nodes: int
) -> list[tuple[int, Filling]]:
    """Up to ``keep`` fillings of ``room`` as (waste, filling), least waste
    first; the greedy one is always among them.

    A filling is dominated, and left out, when one of its pieces could be
    exchanged for a longer unused piece within the waste.  The search visits at
    most ``nodes`` partial fillings and ends at the first without waste.
    """
    greedy = best_fit_filling(counts, lengths, room)
    found = {greedy: room - sum(length * k for length, k in greedy)}
    if not found[greedy]:
        return [(0, greedy)]
    usable = [length for length in lengths if length <= room and counts[length]]
    left = nodes

    def dominated(filling: dict[int, int], waste: int) -> bool:
        for length in filling:
            i = usable.index(length)
            while i and usable[i - 1] - length <= waste:
                i -= 1
                if counts[usable[i]] > filling.get(usable[i], 0):
                    return True
        return False

    def extend(i: int, gap: int, chosen: dict[int, int]) -> bool:
        nonlocal left
        left -= 1
        if gap == 0 or i == len(usable) or gap < usable[-1]:
            if not dominated(chosen, gap):
                found[tuple(sorted(chosen.items(), reverse=True))] = gap
            return gap == 0
        for j in range(i, len(usable)):
            length = usable[j]
            if left <= 0:
                return False
            for k in range(min(counts[length], gap // length), 0, -1):
                if extend(j + 1, gap - k * length, {**chosen, length: k}):
                    return True
                if left <= 0:
                    return False
        return False

    extend(0, room, {})
    return sorted(((w, f) for f, w in found.items()), key=lambda x: (x[0], tuple((-a, -b) for a, b in x[1])))[:keep]


# Budgets of the search: fillings tried per bin, partial fillings visited per
# bin, bins completed in all.
KEEP, NODES, BRANCHES = 3, 400, 6000


def complete_bins(
    histogram: dict[int, int], capacity: int, keep: int = KEEP, nodes: int = NODES, branches: int = BRANCHES
) -> list[Run]:
    """The packing that ``search_bins`` finds."""
    return search_bins(histogram, capacity, keep, nodes, branches)[0]


def search_bins(
    histogram: dict[int, int], capacity: int, keep: int = KEEP, nodes: int = NODES, branches: int = BRANCHES
) -> tuple[list[Run], str]:
    """A packing of the histogram (length -> count) in few sequences, and how
    the search ended: "bound" when the lower bound is met, which proves that
    no packing takes fewer sequences; "searched" when all branches that the
    other budgets allow were followed; "budget" when ``branches`` ran out.

    ``keep`` and ``nodes`` bound the fillings of each bin, ``branches`` the
    bins completed; a filling is repeated as often as the counts allow.  So
    only "bound" is a proof.  The best packing so far (at first the best-fit
    one) is the result.  Every piece of the histogram is packed.
    """
    total = sum(length * n for length, n in histogram.items())
    bound = -(-total // capacity)

    def step(counts: dict[int, int], lengths: list[int], filling: Filling) -> tuple[dict[int, int], list[int], int]:
        times = min(counts[length] // k for length, k in filling)
        counts = dict(counts)
        for length, k in filling:
            counts[length] -= k * times
        return counts, [length for length in lengths if counts[length]], times

    def with_largest(counts, lengths, filling: Filling) -> Filling:
        return ((lengths[0], 1), *filling) if not filling or filling[0][0] != lengths[0] else (
            (lengths[0], filling[0][1] + 1), *filling[1:])

    def room_counts(counts, lengths):
        return {**counts, lengths[0]: counts[lengths[0]] - 1}

    start = dict(histogram)
    order = sorted((length for length, n in start.items() if n), reverse=True)

    # Incumbent: best fit.
    best: list[Run] = []
    counts, lengths, used = start, order, 0
    while lengths:
        filling = with_largest(counts, lengths, best_fit_filling(room_counts(counts, lengths), lengths, capacity - lengths[0]))
        counts, lengths, times = step(counts, lengths, filling)
        best.append((filling, times))
        used += times
    best_used = used

    # Depth first.  The counts of the partial packing are kept once: a stack
    # entry has the run that led to it, which is undone when the entry is left,
    # so the driver's memory grows with the fillings and not with a histogram
    # for each level.
    def options(counts, lengths):
        return iter(undominated_fillings(room_counts(counts, lengths), lengths, capacity - lengths[0], keep, nodes))

    counts = dict(start)
    stack = [(0, 0, options(counts, order))] if order else []
    runs: list[Run] = []

    def undo() -> None:
        filling, times = runs.pop()
        for length, k in filling:
            counts[length] += k * times

    while stack and best_used > bound and branches > 0:
        used, wasted, untried = stack[-1]
        waste, filling = next(untried, (0, None))
        if filling is None:
            stack.pop()
            if runs:
                undo()
            continue
        branches -= 1
        lengths = [length for length in order if counts[length]]
        filling = with_largest(counts, lengths, filling)
        times = min(counts[length] // k for length, k in filling)
        runs.append((filling, times))
        for length, k in filling:
            counts[length] -= k * times
        remaining = [length for length in lengths if counts[length]]
        if remaining and wasted + waste * times <= (best_used - 1) * capacity - total:
            stack.append((used + times, wasted + waste * times, options(counts, remaining)))
            continue
        if not remaining and used + times < best_used:
            best, best_used = list(runs), used + times
        undo()
    return best, "bound" if best_used <= bound else "budget" if stack else "searched"


def plan_rows(runs: list[Run]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, pieces per sequence, first sequence,
    offset) for each length of each run."""
    rows, used, sequence = [], {}, 0
    for filling, times in runs:
        offset = 0
        for length, k in filling:
            first = used.get(length, 0)
            used[length] = first + k * times
            rows.append((length, first, used[length], k, sequence, offset))
            offset += k * length
        sequence += times
    return rows


def token_pieces(docs: DataFrame, id_col: str, text_col: str, capacity: int, tokenizer: str, end_id: int) -> DataFrame:
    """(id, piece, start, length, ids_crc32) for each piece of each document."""
    rows = docs.select(F.col(id_col), F.col(text_col))
    fields = T.StructType([
        T.StructField(id_col, rows.schema[0].dataType),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer)
        for whole in batches:
            for batch in text_slices(whole):
                ids, offsets = encoder.encode(batch.column(1), end_id)
                ids = np.ascontiguousarray(ids, "<u4")
                sizes = np.diff(offsets)
                pieces = -(-sizes // capacity)
                doc = np.repeat(np.arange(len(sizes)), pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(capacity, sizes[doc] - start)
                at = offsets[doc] + start
                crc = [zlib.crc32(ids[a : a + n]) for a, n in zip(at.tolist(), length.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=fields.names,
                )
                del ids, offsets, crc
            hand_back_memory()

    return rows.mapInArrow(cut, fields)


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 2048,
    tokenizer: str | None = None,
    end_id: int = 0,
    keep: int = KEEP,
    nodes: int = NODES,
    branches: int = BRANCHES,
) -> DataFrame:
    """Every document's pieces with their place in a packed sequence.

    Returns id, piece, start, length, ids_crc32, sequence_id, offset.  NULL and
    empty texts are the end id alone; NULL ids and repeated rows are packed as
    documents of their own; an empty table gives an empty result; very long
    texts become many pieces.  ``keep``, ``nodes`` and ``branches`` are the
    budgets of ``search_bins``.  The histogram (at most ``capacity`` rows) is
    all that the driver sees.
    """
    spark = docs.sparkSession
    with small_batches(spark):
        pieces = token_pieces(docs, id_col, text_col, capacity, tokenizer or default_tokenizer(), end_id)
        # The row number tells copies apart, which else share a slot bucket.
        pieces = written(pieces.withColumn("__row", F.monotonically_increasing_id()), "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = plan_rows(complete_bins(histogram, capacity, keep, nodes, branches))
    # At most one run per exhausted length and 63 lengths per sequence.
    plan = spark.createDataFrame(rows, "p_length long, first long, end long, k long, base long, at long")
    ranked = with_slots(pieces, "length", [id_col, "__row"])
    place = F.col("slot") - F.col("first")
    return ranked.join(
        F.broadcast(plan),
        (F.col("length") == F.col("p_length")) & (F.col("slot") >= F.col("first")) & (F.col("slot") < F.col("end")),
    ).select(
        id_col,
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("base") + F.floor(place / F.col("k"))).cast("bigint").alias("sequence_id"),
        (F.col("at") + F.pmod(place, F.col("k")) * F.col("length")).cast("bigint").alias("offset"),
    )
