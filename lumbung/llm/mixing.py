"""Mixing sources to target weights by repetition rates.

Words are summed per source. A source's target divided by its size is its
repetition rate. A document is emitted floor(rate) times, and once more if a
number drawn from a hash of its id is below the fraction of the rate. So the
decision about a document needs nothing but its id and its source's rate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumbung.llm.tables import checkpointed, named, whole_rows

# Weights of the sources in order of their names, repeating.
WEIGHTS = (3, 1, 2)
SHARE = 1.5  # of all words
MOST_REPEATS = 2  # a target stops at so many times its source's size
SEED = "mixing-1"
# Above so many sources their rates are joined instead of broadcast.
MOST_BROADCAST_SOURCES = 10_000
WHITE_SPACE = r"[ \t-\r]+"


def words(text: str | Column) -> Column:
    """Number of words between ASCII white space; none in a null text."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.size(F.array_remove(F.split(text, WHITE_SPACE), "")), F.lit(0)).cast("long")


def draw(doc_id: str, text: str) -> Column:
    """A number from 0 to 1 out of 52 bits of a hash: of the id, or of the text where there is no id."""
    key = F.concat_ws(":", F.lit(SEED), F.coalesce(F.col(doc_id).cast("string"), F.md5(F.col(text))))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / float(1 << 52)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """source, source_size, target, rate out of rows (source, size).

    The wanted share of all words is dealt by weight. Sources are looked at in the order in which they would
    reach their limit as more is dealt: one that does stops there, and the rest is dealt among those after it.
    The windows run over one row per source, not over documents.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(by_name)
    every = Window.partitionBy()
    weighed = per_source.withColumn("place", place).select(
        "source",
        "source_size",
        "place",
        F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1)).alias("weight"),
        (F.col("source_size") * MOST_REPEATS).alias("most"),
    )
    before = Window.orderBy(F.col("most") / F.col("weight"), "place").rowsBetween(Window.unboundedPreceding, -1)
    wanted = F.sum("source_size").over(every) * SHARE
    weight = F.sum("weight").over(every)
    ordered = weighed.select(
        "*",
        wanted.alias("wanted"),
        weight.alias("all_weights"),
        F.coalesce(F.sum("most").over(before), F.lit(0)).alias("most_before"),
        F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("weight_before"),
    ).withColumn(
        "full",
        F.col("weight") * (F.col("wanted") - F.col("most_before")) / (F.col("all_weights") - F.col("weight_before"))
        >= F.col("most"),
    )
    full_most = F.sum(F.when(F.col("full"), F.col("most")).otherwise(0)).over(every)
    full_weight = F.sum(F.when(F.col("full"), F.col("weight")).otherwise(0)).over(every)
    rest = F.col("weight") * (F.col("wanted") - full_most) / F.nullif(F.col("all_weights") - full_weight, F.lit(0))
    target = F.when(F.col("full"), F.col("most").cast("double")).otherwise(rest)
    rated = ordered.select("source", "source_size", target.alias("target"))
    return rated.withColumn("rate", F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0)))


def with_rates(rows: DataFrame, rates: DataFrame) -> DataFrame:
    """Join rates by source, null included. Broadcast only if their number has been checked."""
    if rates.count() <= MOST_BROADCAST_SOURCES:
        rates = F.broadcast(rates)
    return rows.join(rates.withColumnRenamed("source", "rated"), F.col("source").eqNullSafe(F.col("rated"))).drop("rated")


def copies() -> Column:
    """How often a row with ``rate`` and ``u`` is emitted."""
    whole = F.floor("rate")
    return (whole + F.when(F.col("u") < F.col("rate") - whole, 1).otherwise(0)).cast("int")


def sources_and_sizes(docs: DataFrame) -> DataFrame:
    return docs.select(
        named("doc_id").cast("long").alias("doc_id"),
        named("source").cast("string").alias("source"),
        words(named("text").cast("string")).alias("size"),
        F.when(named("doc_id").isNull(), F.coalesce(named("text").cast("string"), F.lit(""))).alias("no_id"),
    ).select("doc_id", "source", "size", draw("doc_id", "no_id").alias("u"))


def mixed(docs: DataFrame) -> DataFrame:
    """One row per document: its size, its source's size and target, how often and how many words the mix takes.

    A null text has size 0, a null source is a source of its own, rows without an id are drawn by their text.
    Rows with the same id are taken equally often. Without any words all targets are 0.
    """
    rows = checkpointed(sources_and_sizes(docs))
    rates = checkpointed(targets(rows))
    return (
        with_rates(rows, rates)
        .withColumn("copies", copies())
        .select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")
    )


def emitted(docs: DataFrame) -> DataFrame:
    """The mix itself: whole rows, each as often as it is taken.

    Rows without a source are a source of their own, rows without an id are drawn by their text. Null, empty and
    very long texts are emitted as they are; repeated rows are taken equally often. No rows, no rows.
    """
    rates = checkpointed(targets(sources_and_sizes(docs)))
    source = F.col("row").getField("source").cast("string")
    rows = whole_rows(docs).select("row", source.alias("source"), draw("doc_id", "text").alias("u"))
    taken = with_rates(rows, rates).withColumn("copies", copies()).filter("copies > 0")
    return taken.withColumn("n", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
