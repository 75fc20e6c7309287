"""Mixing sources to target weights by a low-discrepancy schedule.

Sources share a multiple of all words by weight, but none gets more than twice its own words.
The documents of a source are shuffled by a hash and laid end to end; the stream is cut into
blocks of equal words; the last block of a pass may be part-filled. A source needs the slots of its
whole passes and of the blocks up to its target. Slot ``2 j`` of the mix is the ``j``-th point of the
golden ratio sequence, mapped through the cumulative needs to a source; slots are ranked within
their source, and rank ``r`` takes block ``r`` of the stream, which is gone through twice at most. A
source's slots end with the word that fills its target; ranks for which it met no point get odd
slots, spread over the mix. So each source gives its target, rounded down to words.

Defined results: a null text has no words; the null source is a source and comes last; documents
without words are never taken; rows with equal ids stay apart, since each has its own place in
the stream; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from llm.common import table, written

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
LIMIT = 2.0
#: Words of a block.
BLOCK = 64
#: More points than slots are needed, so that few sources miss some of theirs.
SPARE = 0.125
SEED = 17

_POINT_BITS = 42  # of the sequence's points, and so of the number of slots
_HALF_BITS = _POINT_BITS // 2
_GOLDEN = int((5**0.5 - 1) / 2 * 2**_POINT_BITS) | 1
_CHUNK_BITS = 16  # slots which are ranked together
_BUCKET_ROWS = 1_000  # documents which are laid end to end together

WORD = r"[^\x20\x09-\x0D]+"


def with_sizes(documents: DataFrame) -> DataFrame:
    """``doc_id, source, size``."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return documents.select("doc_id", "source", size.alias("size"))


def targets(sized: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """Per source ``sid`` (its rank), ``source_size``, ``rows``, ``target``.

    With cap ``c`` and weight ``w`` a target is ``min(c, level * w)``; sorted by ``c / w`` the
    level is the largest of ``(total - caps before) / (weights from here)``.
    """
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    ranked = per_source.withColumn("sid", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("sid") % len(weights) + 1)
    capped = ranked.withColumn("weight", weight).withColumn("cap", limit * F.col("source_size"))
    before = W.orderBy(F.col("cap") / F.col("weight"), "sid").rowsBetween(W.unboundedPreceding, -1)
    every = W.orderBy(F.lit(0)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    left = share * F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    free = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = F.max("level").over(every)
    return (
        capped.withColumn("level", left / free)
        .withColumn("target", F.least("cap", level * F.col("weight")))
        .select("source", "sid", "source_size", "rows", "target")
    )


def point(slot: Column) -> Column:
    """The slot's point of the golden ratio sequence, a fraction of ``2 ** 42``, in whole numbers."""
    low = (1 << _HALF_BITS) - 1
    upper = (F.shiftright(slot, _HALF_BITS) * F.lit(_GOLDEN)).bitwiseAND(low)
    lower = slot.bitwiseAND(low) * F.lit(_GOLDEN)
    return (F.shiftleft(upper, _HALF_BITS) + lower.bitwiseAND((1 << _POINT_BITS) - 1)).bitwiseAND((1 << _POINT_BITS) - 1)


def blocks_of(words: Column, block: int) -> Column:
    return F.floor((words + (block - 1)) / block).cast("long")


def slots_needed(size: Column, cut: Column, block: int) -> Column:
    """Blocks of whole passes through ``size`` words, and of the last pass up to ``cut`` words in all."""
    passes = F.floor(cut / F.greatest(size, F.lit(1)))
    return passes * blocks_of(size, block) + blocks_of(cut - passes * size, block)


def schedule(sources: DataFrame, block: int = BLOCK, spare: float = SPARE) -> DataFrame:
    """``slot, sid, rank, block, words``: what each slot takes, in the order of the mix.

    Each source owns a range of points. Ranges are laid on a grid of about as many cells as
    there are sources, so a slot finds its source by an equi join on the cell. Slots are ranked
    within chunks of slots, and chunks by their counts, so no task ranks a whole source. The ranks
    a source lacks after that are numbered over all sources and laid at equal distances.
    """
    spark = sources.sparkSession
    size, cut = F.col("source_size"), F.floor("target").cast("long")
    sources = sources.withColumn("needed", slots_needed(size, cut, block)).filter("needed > 0")
    n_sources, total = sources.agg(F.count("*"), F.sum("needed")).first()
    n_slots = int((total or 0) * (1 + spare)) + 1 if n_sources else 0
    cells = 1 << (2 * max(n_sources, 1) - 1).bit_length()
    cell_bits = _POINT_BITS - (cells.bit_length() - 1)

    upto = W.orderBy("sid").rowsBetween(W.unboundedPreceding, 0)
    scale = float(1 << _POINT_BITS) / (total or 1)
    high = F.round(F.sum("needed").over(upto) * scale).cast("long")
    ranges = (
        sources.withColumn("high", high)
        .withColumn("low", F.lag("high", 1, 0).over(W.orderBy("sid")))
        .filter("high > low")
        .withColumn("cell", F.explode(F.sequence(F.shiftright("low", cell_bits), F.shiftright(F.col("high") - 1, cell_bits))))
        .select("sid", "source_size", "target", "needed", "low", "high", "cell")
    )
    slots = (
        spark.range(n_slots)
        .select(F.col("id").alias("slot"), point(F.col("id")).alias("point"))
        .withColumn("cell", F.shiftright("point", cell_bits))
        .join(ranges, "cell")
        .filter("point >= low AND point < high")
        .withColumn("chunk", F.shiftright("slot", _CHUNK_BITS))
        .select("slot", "sid", "source_size", "target", "needed", "chunk")
    )
    counted = slots.groupBy("sid", "chunk").count()
    earlier = W.partitionBy("sid").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    offsets = counted.select("sid", "chunk", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("offset"))
    within = F.row_number().over(W.partitionBy("sid", "chunk").orderBy("slot")) - 1
    met = (
        slots.join(offsets, ["sid", "chunk"])
        .withColumn("rank", F.col("offset") + within)
        .filter("rank < needed")
        .select((F.col("slot") * 2).alias("slot"), "sid", "rank", "source_size", "target")
    )
    short = (
        sources.join(counted.groupBy("sid").agg(F.sum("count").alias("had")), "sid", "left")
        .withColumn("had", F.coalesce("had", F.lit(0)))
        .filter("had < needed")
        .withColumn("missing", F.col("needed") - F.col("had"))
    )
    every = W.orderBy(F.lit(0)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    lacking = (
        short.withColumn("before", F.sum("missing").over(upto) - F.col("missing"))
        .withColumn("all", F.sum("missing").over(every))
        .withColumn("rank", F.explode(F.sequence(F.col("had"), F.col("needed") - 1)))
        .withColumn("nth", F.col("before") + F.col("rank") - F.col("had"))
        .withColumn("slot", F.floor(F.col("nth") * F.lit(float(n_slots)) / F.col("all")).cast("long") * 2 + 1)
        .select("slot", "sid", "rank", "source_size", "target")
    )
    place = F.col("rank") % blocks_of(size, block)
    start = F.floor(F.col("rank") / blocks_of(size, block)) * size + place * block
    words = F.least(F.lit(block), size - place * block, cut - start)
    return met.unionByName(lacking).select("slot", "sid", "rank", place.alias("block"), words.cast("long").alias("words"))


def streams(sized: DataFrame, sources: DataFrame, seed: int = SEED, bucket_rows: int = _BUCKET_ROWS) -> DataFrame:
    """Documents with words, and ``start``: their place in the shuffled stream of their source.

    A source is cut into buckets by the leading bits of the hash, as many as its rows ask for;
    rows are added up within buckets, and buckets by their totals.
    """
    buckets = F.ceil(F.col("rows") / bucket_rows)
    keyed = (
        sized.filter("size > 0").alias("d")
        .join(sources.select("source", "sid", "source_size", "target", "rows").alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
        .withColumn("key", F.xxhash64("doc_id", F.lit(seed)))
        .withColumn("bucket", F.floor((F.shiftrightunsigned("key", 24) / float(1 << 40)) * buckets).cast("long"))
        .select("doc_id", "size", "sid", "source_size", "target", "key", "bucket")
    )
    totals = keyed.groupBy("sid", "bucket").agg(F.sum("size").alias("words"))
    earlier = W.partitionBy("sid").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select("sid", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset"))
    before = W.partitionBy("sid", "bucket").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    return (
        keyed.join(offsets, ["sid", "bucket"])
        .withColumn("start", F.col("offset") + F.coalesce(F.sum("size").over(before), F.lit(0)))
        .select("doc_id", "size", "sid", "source_size", "target", "start")
    )


def mix(placed: DataFrame, slots: DataFrame, block: int = BLOCK) -> DataFrame:
    """The mix: ``slot``, and the words ``[from_word, to_word)`` of the document ``doc_id`` taken
    there; a slot has a row for each document in its block. ``placed`` rows are kept apart by
    ``sid, start``."""
    end = F.col("start") + F.col("size")
    first, last = F.floor(F.col("start") / block), F.floor((end - 1) / block)
    parts = placed.withColumn("block", F.explode(F.sequence(first, last)))
    low = F.greatest("start", F.col("block") * block)
    high = F.least(end, F.col("block") * block + F.col("words"))
    return (
        parts.join(slots.select("slot", "sid", "block", "words"), ["sid", "block"])
        .withColumn("from_word", low - F.col("start"))
        .withColumn("to_word", high - F.col("start"))
        .filter("to_word > from_word")
        .select("slot", "sid", "start", "doc_id", "from_word", "to_word")
    )


def mixed(documents: DataFrame, block: int = BLOCK) -> DataFrame:
    """Every document with its size, its source's size and target, and the words taken of it."""
    sized = written(with_sizes(documents), "sizes")
    sources = written(targets(sized), "sources")
    placed = streams(sized, sources)
    taken = (
        mix(placed, schedule(sources, block), block)
        .groupBy("sid", "start")
        .agg(F.sum(F.col("to_word") - F.col("from_word")).alias("taken"))
    )
    with_words = placed.join(taken, ["sid", "start"], "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")
    )
    without = (
        sized.filter("size = 0").alias("d")
        .join(sources.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
        .select("doc_id", "size", "source_size", "target", F.lit(0).cast("long").alias("taken"))
    )
    return with_words.unionByName(without)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query: the mix of all documents."""
    return mixed(table(spark, sf_dir, "documents"))
