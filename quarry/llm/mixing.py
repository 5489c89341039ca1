"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a fixed shuffled order (by a seeded
MD5 of the identifier, or of the content of a row without one; then by content), the whole queue up to ``max_repeats`` times over. A
document's virtual finish time is the cumulative number of its source's words,
itself included, divided by the source's weight. All copies are range-sorted by
finish time and taken until the total budget is used up. A queue that runs out
leaves its share to the others by weight, so what each source gets is its water
level: min(weight * t, max_repeats * size), with the t at which they sum to the
budget.

The running sums need no task that holds a whole source. A source is cut by its
shuffle hash into about the square root of its row count of ranges; sums of the
ranges are accumulated per source and sums of the rows within each range, so a
source of n rows is handled in pieces of about sqrt(n). A range that an often
repeated identifier fills is cut further, by ranges of the content hash, and where equal
rows fill such a range, by a hash of their locators. Every cut is a range of one and the
same order (shuffle hash, content, locator), so where cuts are made changes no sum; and as
only rows that are equal in every column are ordered by locator, the mix has the
same rows however the table is written or partitioned. The global order is one
range shuffle; only one sum per range partition is accumulated over all.

Only DataFrame and SQL functions. Defined cases: null text has size 0; a null
source is a source of its own, ranked last; documents of size 0 are never
needed to reach a target and count as taken 0 times; rows that repeat are
separate documents, any of which may be the one that is taken. An empty
table, or no words at all, gives nothing taken. Extra columns tell rows apart that have
one identifier or none, and are not used otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.llm.common import FILE, ROW, content_hash, fresh, located, quoted, text_of, word_count
from quarry.operators.staging import broadcast_if_small, stage

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MAX_REPEATS = 2
SEED = "mix-1:"
CROWDED = 8  # times its even share of rows, beyond which a range is cut further; changes no result

_RUNNING = (W.unboundedPreceding, W.currentRow)
_BEFORE = (W.unboundedPreceding, -1)


def _shuffle_key(key: Column, content: Column) -> Column:
    """Rows without an identifier are spread by their content."""
    return F.md5(F.concat(F.lit(SEED), F.coalesce(key.cast("string"), F.concat(F.lit(":"), content.cast("string")))).cast("binary"))


def _range_of(hashed: Column, ranges: Column) -> Column:
    """Which of so many equal ranges of all longs a hash lies in."""
    return F.floor((hashed.cast("double") / F.lit(2.0 ** 64) + 0.5) * ranges).cast("long")


def _cut(rows: DataFrame, within: list[str], cuts: str, name: str) -> DataFrame:
    """``rows`` with a column ``cuts``: into how many ranges the rows of its ``within`` are to be
    cut, null where they are no crowd (evenly spread identifiers never are)."""
    crowd = (rows.groupBy(*within).agg(F.count(F.lit(1)).alias("n"), F.first("docs").alias("of"))
             .where(F.col("n") > CROWDED * F.ceil(F.sqrt("of")))
             .select(*within, F.ceil(F.col("n") / F.sqrt("of")).alias(cuts)))
    return rows.join(broadcast_if_small(stage(crowd, name)), within, "left")


def source_table(sized: DataFrame, weights: Sequence[float], max_repeats: int, share: float) -> DataFrame:
    """Per source: words, rows, weight by rank (repeating), and target by water filling.

    One row per source; ranks and the water level need them in one order, so this
    table (not the documents) passes one window."""
    per = sized.groupBy("source").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("docs"))
    ranked = per.withColumn("rank", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    cap = (F.lit(max_repeats) * F.col("words")).cast("double")
    w = ranked.withColumns({"weight": weight, "cap": cap, "level": cap / weight})
    # Sources in the order in which they fill up: with those before full, the level at
    # which the budget is reached is (budget - their caps) / weight of the rest.
    by = W.orderBy("level", "rank")
    everything = W.partitionBy()
    w = w.withColumns({
        "full": F.coalesce(F.sum("cap").over(by.rowsBetween(*_BEFORE)), F.lit(0.0)),
        "open": F.sum("weight").over(by.rowsBetween(W.currentRow, W.unboundedFollowing)),
        "budget": F.sum("words").over(everything) * share})
    w = w.withColumn("at", (F.col("budget") - F.col("full")) / F.col("open"))
    reached = F.when(F.col("at") <= F.col("level"), F.struct("level", "rank", "at"))
    w = w.withColumn("water", F.min(reached).over(everything)["at"])
    target = F.least(F.col("cap"), F.coalesce(F.col("water"), F.lit(float("inf"))) * F.col("weight"))
    return w.select("source", "rank", "words", "docs", "weight", target.alias("target"),
                    F.floor(F.col("budget")).cast("long").alias("budget"))


def mix(df: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source",
        weights: Sequence[float] = WEIGHTS, share: float = SHARE,
        max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Per input row: locator, ``key``, size, source_size, target, copies (0 to ``max_repeats``)."""
    src = df if FILE in df.columns else located(df, "mix-input")
    content = content_hash(src, [c for c in src.columns if c not in (FILE, ROW)])
    sized = src.select(
        F.col(FILE), F.col(ROW), src[quoted(key)].alias("key"), src[quoted(source)].cast("string").alias("source"),
        word_count(text_of(src, text)).alias("size"), content.alias("content"))
    sized = stage(sized.withColumns({"shuffle": _shuffle_key(F.col("key"), F.col("content")),
                                     "place": F.xxhash64(FILE, ROW)}), "mix-sized").df
    sources = broadcast_if_small(stage(source_table(sized, weights, max_repeats, share), "mix-sources"))
    rows = sized.join(sources, sized.source.eqNullSafe(sources.source)).drop(sources.source)

    pieces = F.ceil(F.sqrt(F.col("docs"))).cast("long")
    piece = F.floor(F.conv(F.substring("shuffle", 1, 8), 16, 10).cast("double") / F.lit(2.0 ** 32) * pieces).cast("long")
    rows = rows.withColumn("piece", piece)
    rows = _cut(rows, ["rank", "piece"], "cuts", "mix-crowded")
    rows = rows.withColumns({"of_shuffle": F.when(F.col("cuts").isNotNull(), F.col("shuffle")).otherwise(""),
                             "part": F.coalesce(_range_of(F.col("content"), F.col("cuts")), F.lit(0))})
    rows = _cut(rows, ["rank", "piece", "of_shuffle", "part"], "equal_cuts", "mix-equal")
    rows = rows.withColumns({"of_content": F.when(F.col("equal_cuts").isNotNull(), F.col("content")).otherwise(0),
                             "cut": F.coalesce(_range_of(F.col("place"), F.col("equal_cuts")), F.lit(0))})
    cell = ["piece", "of_shuffle", "part", "of_content", "cut"]
    sums = rows.groupBy("rank", *cell).agg(F.sum("size").alias("piece_words"))
    before = sums.select("rank", *cell, F.coalesce(
        F.sum("piece_words").over(W.partitionBy("rank").orderBy(*cell).rowsBetween(*_BEFORE)),
        F.lit(0)).alias("before"))
    inner = W.partitionBy("rank", *cell).orderBy("shuffle", "content", "place", FILE, ROW).rowsBetween(*_RUNNING)
    once = (rows.withColumn("within", F.sum("size").over(inner)).join(before, ["rank", *cell])
            .withColumn("sum", F.col("before") + F.col("within")))

    # Copies that can be taken at all: a finish time beyond the fullest source's is never reached.
    copies = once.where("size > 0").select(
        FILE, ROW, "rank", "size", "shuffle", "content", "budget",
        F.explode(F.transform(F.sequence(F.lit(0), F.lit(max_repeats - 1)),
                              lambda e: (F.col("sum") + e * F.col("words")) / F.col("weight"))).alias("finish"))
    order = ["finish", "rank", "shuffle", "content", FILE, ROW]
    queue = copies.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    queue = stage(queue, "mix-queue").df
    parts = queue.groupBy("part").agg(F.sum("size").alias("part_words"))
    offsets = parts.select("part", F.coalesce(
        F.sum("part_words").over(W.orderBy("part").rowsBetween(*_BEFORE)), F.lit(0)).alias("offset"))
    at = F.col("offset") + F.sum("size").over(W.partitionBy("part").orderBy(*order).rowsBetween(*_RUNNING))
    taken = (queue.join(F.broadcast(offsets), "part").withColumn("at", at).where("at <= budget")
             .groupBy(FILE, ROW).agg(F.count(F.lit(1)).cast("int").alias("copies")))
    return (once.join(taken, [FILE, ROW], "left").select(
        FILE, ROW, F.col("key").alias(key), "size", F.col("words").alias("source_size"), "target",
        F.coalesce("copies", F.lit(0)).alias("copies")))


def mixed_rows(df: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source",
               weights: Sequence[float] = WEIGHTS, share: float = SHARE,
               max_repeats: int = MAX_REPEATS) -> DataFrame:
    """The mix itself: rows of ``df``, each as often as it is taken, with all its columns."""
    src = located(df, "mix-input")
    plan = mix(src, text, key, source, weights, share, max_repeats).where("copies > 0")
    copies = fresh(df, "copies")
    plan = broadcast_if_small(stage(plan.select(FILE, ROW, F.col("copies").alias(copies)), "mix-plan"))
    return (src.join(plan, [FILE, ROW])
            .select(*[src[quoted(c)] for c in df.columns], F.explode(F.sequence(F.lit(1), F.col(copies))).alias(fresh(df, "copy")))
            .drop(fresh(df, "copy")))
