"""Mixing sources to target weights, with DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Weights dealt to the sources in code point order, again and again.
WEIGHTS = (5, 2, 1)
#: All targets together, and the most that one source takes, as multiples of the sizes.
SHARE, MOST = 1.5, 2.0
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """Targets of sources from (source, source_size), one row per source.

    The sources are ordered by code point, null last, and get the weights in turn. A target is
    level x weight, but at most `most` x the source's size: the level at which all targets
    together are `share` x all sizes is where handing an excess on by weight ends. Sources reach
    their limit in the order of limit / weight, so the level follows from running sums in that order.
    The windows run over one row per source, never over documents.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source"))) - 1
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (turn % len(weights) + 1).cast("int"))
    limit = F.col("source_size") * F.lit(float(most))
    filling = Window.orderBy("_full_at", "_turn")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    ordered = (
        sizes.withColumn("_turn", turn)
        .withColumn("_weight", weight)
        .withColumn("_limit", limit)
        .withColumn("_full_at", F.col("_limit") / F.col("_weight"))
        .withColumn("_rest", F.sum("source_size").over(whole) * F.lit(float(share))
                    - F.coalesce(F.sum("_limit").over(before), F.lit(0.0)))
        .withColumn("_open", F.sum("_weight").over(whole) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0)))
        .withColumn("_level", F.col("_rest") / F.col("_open"))
    )
    # The first source, in the order in which they fill up, that the level doesn't fill.
    level = F.min(F.when(F.col("_level") <= F.col("_full_at"), F.struct("_full_at", "_turn", "_level"))).over(whole)
    return ordered.withColumn("_at", level["_level"]).select(
        "source", "source_size",
        F.when(F.col("_at").isNull(), F.col("_limit"))
        .otherwise(F.least("_limit", F.col("_weight") * F.col("_at"))).alias("target"),
    )


def with_copies(docs: DataFrame, columns: list[str], seed: int = 42, **mix: object) -> DataFrame:
    """`columns` of documents and size, source_size, target and copies of each.

    A document is emitted floor(target / source_size) times, and once more if the hash of the
    seed and its doc_id falls below the fraction, so that reruns and repeated rows of an id agree. A null or
    empty text has size 0 and a source without words the rate 0. Sizes are summed per task before the
    shuffle, and only one row per source goes to each task, so a hot source costs nothing more.
    """
    sized = docs.select(*columns, word_count(F.col("text")).alias("_size"), F.col("source").alias("_of"), F.col("doc_id").alias("_id"))
    sizes = docs.groupBy("source").agg(F.sum(word_count(F.col("text"))).alias("source_size"))
    targets = source_targets(sizes, **mix).withColumnRenamed("source", "_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    # The first 52 bits of a digest: another engine draws the same copies.
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit(""))))
    draw = F.conv(F.left(digest, F.lit(13)), 16, 10).cast("long") / F.lit(float(1 << 52))
    return (
        sized.join(targets, F.col("_of").eqNullSafe(F.col("_source")))
        .withColumn("_rate", rate)
        .select(
            *columns,
            F.col("_size").alias("size"), "source_size", "target",
            (F.floor("_rate") + (draw < F.col("_rate") - F.floor("_rate")).cast("long")).alias("copies"),
        )
    )


def mixed(docs: DataFrame, seed: int = 42, **mix: object) -> DataFrame:
    """The documents of the mix: each row as often as it is taken, with its own columns only.

    Rows with a null or empty text, and those of a source without words, have size 0 and the rate of their source; repeated
    rows are drawn alike. No rows: no rows.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    taken = with_copies(docs.select("doc_id", "source", "text", row), ["_row"], seed, **mix)
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_copy")
    return taken.filter("copies > 0").select("_row", times).select("_row.*")
