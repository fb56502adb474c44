"""Mixing sources to target weights (DataFrame functions only).

Capped water-filling: every source asks for its weight's share of the budget
and stops at ``max_epochs`` times its own size; what the full sources leave is
shared again by weight until none is above its cap.  The result of that
repetition is ``target = min(cap, level * weight)`` with the one level that
spends the budget, found with running sums over the sources in order of
cap / weight.

Each source is then taken ``target / size`` times: the whole part as whole
repetitions of all its documents, the fraction as one more repetition of a
seeded sample of whole documents.  The sample takes documents in order of a
seeded hash as long as their middle lies below the fraction's words, so a
source comes within half a document of its target.  A document is in or out by
comparison with one place in that order, which is found per source.  Of equal
rows at that place as many are in as fit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import word_count, written
from parley.llm.sharding import with_slots

# Largest number of sources whose targets are broadcast (about 100 bytes each).
BROADCAST_SOURCES = 100_000
# Hash range of one bucket of the seeded order: 2**60 / 2**44 = 65,536 buckets.
HASH_BITS, BUCKET_BITS = 60, 44


def seeded_hash(seed: int, *columns: Column) -> Column:
    """60 bits of MD5 as BIGINT, from the seed and the columns' texts (NULL as
    the empty text)."""
    parts = [F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("")) for c in columns]]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts).cast("binary")), 1, 15), 16, 10).cast("bigint")


def water_fill(sources: DataFrame, budget: float, max_epochs: float) -> DataFrame:
    """``target`` for each row of ``sources`` (source, weight, source_size).

    The budget is ``budget`` times the sizes of all sources.  Sources are few
    next to the documents; the running sums are over sources only.
    """
    ratio = F.col("cap") / F.col("weight")
    s = sources.withColumn("cap", F.col("source_size") * F.lit(float(max_epochs))).withColumn("ratio", ratio)
    everything = Window.partitionBy().orderBy("ratio", "weight", "rank")
    total = everything.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = everything.rowsBetween(Window.unboundedPreceding, -1)
    nothing = F.lit(0.0)
    s = s.withColumn(
        "level_here",
        (F.sum("source_size").over(total) * F.lit(float(budget)) - F.coalesce(F.sum("cap").over(before), nothing))
        / (F.sum("weight").over(total) - F.coalesce(F.sum("weight").over(before), nothing)),
    )
    fits = F.when(F.col("level_here") <= F.col("ratio"), F.col("level_here"))
    s = s.withColumn("level", F.first(fits, ignorenulls=True).over(total))
    return s.withColumn(
        "target", F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap")))
    ).drop("cap", "ratio", "level_here", "level")


def source_targets(
    sized: DataFrame, weights: tuple[float, ...], budget: float, max_epochs: float
) -> DataFrame:
    """One row per source: source, rank, source_size, target, repeats (whole
    repetitions) and rest (words of the fractional one).  Weights are dealt to
    the sources in code-point order, NULL last, and repeat."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.partitionBy().orderBy(F.col("source").asc_nulls_last()))
    listed = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sums.withColumn("rank", rank).withColumn(
        "weight", F.element_at(listed, (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    )
    filled = water_fill(ranked, budget, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
    return filled.withColumn("repeats", whole).select(
        "source", "rank", "source_size", "target", "repeats", (F.col("target") - F.col("repeats") * F.col("source_size")).alias("rest")
    )


def source_cuts(sized: DataFrame, weights: tuple[float, ...], budget: float, max_epochs: float) -> DataFrame:
    """One row per source: ts (source), rank, source_size, target, repeats, rest
    and where its fractional repetition ends: documents of a bucket below
    ``cut_bucket`` are in, in that bucket those before ``last``, and of the
    ``last_peers`` equal rows at ``last`` any ``last_fit``.

    A hot source is never gathered: its documents are summed per hash bucket,
    and only the bucket in which the repetition ends is put in order, with
    equal rows counted first.
    """
    targets = written(source_targets(sized, weights, budget, max_epochs), "mix-targets")
    t = targets.select(F.col("source").alias("ts"), "rank", "source_size", "target", "repeats", "rest")
    per_bucket = sized.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    cut = (
        per_bucket.withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0).cast("bigint")))
        .join(small_side(t), F.col("source").eqNullSafe(F.col("ts")))
        .where((F.col("rest") > 0) & (F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("words")))
        .groupBy("source", "rest")
        .agg(F.min(F.struct("bucket", "before")).alias("c"))
        .select(F.col("source").alias("cs"), "rest", F.col("c.bucket").alias("cut_bucket"), F.col("c.before").alias("cut_before"))
    )
    cut = written(cut, "mix-cuts")
    peers = (
        sized.join(small_side(cut), F.col("source").eqNullSafe(F.col("cs")) & (F.col("bucket") == F.col("cut_bucket")))
        .groupBy("source", "rest", "cut_before", "h", "id", "size")
        .agg(F.count(F.lit(1)).alias("peers"))
    )
    running = Window.partitionBy("source").orderBy("h", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("cut_before") + F.coalesce(F.sum(F.col("size") * F.col("peers")).over(running), F.lit(0).cast("bigint"))
    last = (
        peers.withColumn("before", before)
        .withColumn("fit", fitting())
        .where("fit > 0")
        .groupBy(F.col("source").alias("ls"))
        .agg(F.max(F.struct("h", "id", "size", "fit", "peers")).alias("l"))
        .select(
            "ls",
            F.struct("l.h", "l.id", "l.size").alias("last"),
            F.col("l.fit").alias("last_fit"),
            F.col("l.peers").alias("last_peers"),
        )
    )
    return written(
        t.join(cut.drop("rest", "cut_before"), F.col("ts").eqNullSafe(F.col("cs")), "left")
        .join(last, F.col("ts").eqNullSafe(F.col("ls")), "left")
        .drop("cs", "ls"),
        "mix-sources",
    )


def fitting() -> Column:
    """How many of ``peers`` rows of ``size`` words have their middle within
    ``rest`` words, if ``before`` words come first."""
    room = F.floor((2 * (F.col("rest") - F.col("before")) + F.col("size")) / (2 * F.greatest(F.col("size"), F.lit(1))))
    some = F.least(F.col("peers"), F.greatest(room, F.lit(0)))
    return F.when(F.col("size") > 0, some).when(F.col("before") <= F.col("rest"), F.col("peers")).otherwise(0).cast("bigint")


def small_side(df: DataFrame) -> DataFrame:
    """A broadcast of a per-source table behind a check of its size; with more
    sources the join shuffles."""
    return F.broadcast(df) if df.count() <= BROADCAST_SOURCES else df


def sized_documents(docs: DataFrame, id_col: str, text_col: str, seed: int) -> list[Column]:
    """Columns id, size, h and bucket of a document."""
    size = word_count(F.col(text_col))
    # The text counts, so only equal texts of one id are peers.
    h = seeded_hash(seed, F.col(id_col), size, F.md5(F.coalesce(F.col(text_col), F.lit(""))))
    return [F.col(id_col).alias("id"), size.alias("size"), h.alias("h"), F.shiftright(h, BUCKET_BITS).alias("bucket")]


def with_copies(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """``rows`` (with source, id, size, h, bucket) with their source's columns
    and ``copies``, the repetitions that the mix takes.

    Equal rows at the end of a source's fractional repetition, of which some
    but not all fit, are written once and numbered in parts of a hash of their
    row number, so that exactly as many are in as fit, however many there are.
    """
    place = F.struct("h", "id", "size")
    in_cut = (F.col("bucket") == F.col("cut_bucket")) & F.col("last").isNotNull()
    below = F.col("cut_bucket").isNull() | (F.col("bucket") < F.col("cut_bucket"))
    extra = F.when((F.col("rest") > 0) & (below | F.coalesce(in_cut & (place <= F.col("last")), F.lit(False))), 1).otherwise(0)
    joined = rows.join(small_side(cuts), F.col("source").eqNullSafe(F.col("ts")))
    decided = joined.withColumn("copies", (F.col("repeats") + extra).cast("bigint"))
    if cuts.where("last_fit < last_peers").isEmpty():
        return decided
    shared = F.coalesce(in_cut & (place == F.col("last")) & (F.col("last_fit") < F.col("last_peers")), F.lit(False))
    dealt = written(joined.where(shared).withColumn("row", F.monotonically_increasing_id()), "mix-shared")
    fits = F.when(F.col("slot") < F.col("last_fit"), 1).otherwise(0)
    some = with_slots(dealt, "rank", ["row"]).withColumn("copies", (F.col("repeats") + fits).cast("bigint"))
    return decided.where(~shared).unionByName(some.drop("row", "slot"))


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = (3.0, 1.0, 2.0),
    budget: float = 1.5,
    max_epochs: float = 2.0,
    seed: int = 17,
) -> DataFrame:
    """How often the mix takes each document.

    Returns one row per input row: id, source, size (words), source_size,
    target (of its source), copies and taken (= copies * size).  NULL text has
    size 0; a NULL source is a source of its own; repeated rows are documents
    of their own, of which some may be taken once more than the others; an empty table gives an empty result.
    """
    sized = written(
        docs.select(F.col(source_col).alias("source"), *sized_documents(docs, id_col, text_col, seed)), "mix-sizes"
    )
    cuts = source_cuts(sized, weights, budget, max_epochs)
    return with_copies(sized, cuts).select(
        F.col("id").alias(id_col),
        F.col("source").alias(source_col),
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def mixed_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = (3.0, 1.0, 2.0),
    budget: float = 1.5,
    max_epochs: float = 2.0,
    seed: int = 17,
) -> DataFrame:
    """The documents of the mix, whole and with all their columns, as often as
    it takes them.  The sizes are counted in a first pass; in the second each
    document is decided on by itself, so texts are not shuffled."""
    sized = written(
        docs.select(F.col(source_col).alias("source"), *sized_documents(docs, id_col, text_col, seed)), "mix-sizes"
    )
    cuts = source_cuts(sized, weights, budget, max_epochs)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.col(source_col).alias("source"),
        *sized_documents(docs, id_col, text_col, seed),
    )
    again = with_copies(rows, cuts).where("copies > 0").select("doc", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    return again.select("doc.*")
