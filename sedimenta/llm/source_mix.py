"""Mixing sources to target weights by weighted fair queueing.

Sources in code point order (null last) weigh `weights`, repeating, and share as many words as
all documents have. A target stops at `epochs` times its source's size; the excess goes to the
others by weight, until none is above: with sources sorted by size for their weight, the ones
that stop are a prefix, found by running sums over one row a source.

Each source's documents, shuffled by a digest of their id, are queued; document number k of
pass e has the virtual finish time (e * size of source + words up to and with k) / target. All
are ranged by that time and taken until the next would exceed the total. A document is taken
whole, `epochs` times at most, and reruns agree.

Running sums over a source do not need its rows in one task: rows are cut into small ranges of
their digest, and ranges into blocks of as many ranges. Sums run over the rows of a range, the
ranges of a block and the blocks of a source, so that a source of n documents has windows of
RANGE_ROWS rows, RANGE_ROWS ranges and n / RANGE_ROWS^2 blocks. The global order is ranged by
finish time likewise: the block in which the budget ends is found first, then the range in it,
and only that range is sorted by rows.

Nulls: a null or empty text has size 0 and is never taken; a null source is a source, the last
one; a null id is shuffled as an empty one. Rows with equal id, source and size are taken
together. Empty tables give empty results; other columns, whatever their names, are carried along
or ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm.scratch import Scratch

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
EPOCHS = 3
RANGE_ROWS = 1024


def with_size(documents: DataFrame, text_col: str = "text", to: str = "size") -> DataFrame:
    return documents.withColumn(to, F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)).cast("long"), F.lit(0)))


def source_targets(units: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """(source, rank, n_units, source_size, target), from units (source, words)."""
    totals = units.groupBy("source").agg(
        F.sum("words").alias("source_size"), F.count(F.when(F.col("words") > 0, 1)).alias("n_units")
    )
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(1))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    fill = Window.orderBy((F.col("source_size") / F.col("weight")), "rank")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    onwards = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    exact = "decimal(38,0)"
    share = (
        totals.withColumn("rank", F.row_number().over(by_name))
        .withColumn("weight", weight.cast("long"))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("most", F.col("source_size") * epochs)
        .withColumn("left", F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0)))
        .withColumn("others", F.sum("weight").over(onwards))
        .withColumn(
            "stops", F.col("most").cast(exact) * F.col("others") <= F.col("weight").cast(exact) * F.col("left")
        )
    )
    free = F.sum(F.when(~F.col("stops"), F.col("weight"))).over(everything)
    spent = F.coalesce(F.sum(F.when(F.col("stops"), F.col("most"))).over(everything), F.lit(0))
    target = F.when(F.col("stops"), F.col("most").cast("double")).otherwise(
        (F.col("weight") * (F.col("total") - spent)).cast("double") / free.cast("double")
    )
    return share.withColumn("target", target).select("source", "rank", "n_units", "source_size", "target")


def _before_ranges(sums: DataFrame) -> DataFrame:
    """(rank, range, before) of (rank, range, words): the words of the source's ranges before."""
    earlier = lambda part, by: F.coalesce(
        F.sum("words").over(Window.partitionBy(*part).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    placed = sums.withColumn("block", F.floor(F.col("range") / F.lit(RANGE_ROWS)))
    blocks = placed.groupBy("rank", "block").agg(F.sum("words").alias("words"))
    blocks = blocks.select("rank", "block", earlier(["rank"], "block").alias("blocks_before"))
    within = placed.withColumn("ranges_before", earlier(["rank", "block"], "range"))
    return within.join(blocks, ["rank", "block"]).select(
        "rank", "range", (F.col("blocks_before") + F.col("ranges_before")).alias("before")
    )


def _end_of(sums: DataFrame, by: str, before: int, budget: int) -> tuple[int, int] | None:
    """The first `by` up to and with which the words exceed the budget, and the words before it."""
    running = sums.withColumn("upto", F.sum("words").over(Window.orderBy(by)) + F.lit(before))
    end = running.where(F.col("upto") > budget).orderBy(by).select(by, (F.col("upto") - F.col("words")).alias("spent")).first()
    return None if end is None else (end[by], end["spent"])


def mix_sources(
    documents: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    epochs: int = EPOCHS,
    seed: str = "",
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, source, size, copies, source_size, target, taken): one row for each id, source
    and size that occur, `copies` times; `taken` words are taken of each copy."""
    scratch = Scratch(documents.sparkSession, "mix")
    sized = with_size(documents.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.col(text_col).alias("text")))
    units = sized.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("copies"))
    units = scratch.keep(units.withColumn("words", F.col("size") * F.col("copies")), "units")
    targets = scratch.keep(source_targets(units, weights, epochs), "targets")
    summary = targets.agg(F.sum("source_size").alias("total"), F.sum("n_units").alias("units")).first()
    budget, n_units = summary["total"] or 0, summary["units"] or 0

    digest = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    placed = units.withColumnRenamed("source", "__source").join(
        targets, F.col("__source").eqNullSafe(F.col("source"))
    ).drop("__source")
    queued = placed.where("words > 0").withColumn("digest", digest).withColumn(
        "range",
        F.floor(
            F.conv(F.substring("digest", 1, 8), 16, 10).cast("long")
            * F.ceil(F.col("n_units") / F.lit(RANGE_ROWS))
            / F.lit(1 << 32)
        ),
    )
    sums = queued.groupBy("rank", "range").agg(F.sum("words").alias("words"))
    sums = _before_ranges(sums).select(F.col("rank").alias("__rank"), F.col("range").alias("__range"), "before")
    in_range = Window.partitionBy("rank", "range").orderBy("digest", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    within = queued.withColumn("upto", F.sum("words").over(in_range))
    summed = within.join(sums, (F.col("rank") == F.col("__rank")) & (F.col("range") == F.col("__range"))).drop("__rank", "__range")
    ranges = max(64, -(-n_units // RANGE_ROWS))
    time = lambda e: (F.lit(e) * F.col("source_size") + F.col("before") + F.col("upto")).cast("double") / F.col("target")
    times = scratch.keep(
        summed.withColumn("times", F.array(*(time(e) for e in range(epochs))))
        .withColumn("bins", F.transform("times", lambda t: F.floor(t * F.lit(ranges)).cast("long")))
        .drop("before", "upto", "range"),
        "times",
    )
    # The range of finish times in which the budget ends, and what is left of it there.
    totals = times.select("words", F.explode("bins").alias("bin")).groupBy("bin").agg(F.sum("words").alias("words"))
    totals = scratch.keep(totals.withColumn("block", F.floor(F.col("bin") / F.lit(RANGE_ROWS))), "totals")
    last, spent = 1 << 62, budget
    block = _end_of(totals.groupBy("block").agg(F.sum("words").alias("words")), "block", 0, budget)
    if block is not None:
        inside = totals.where(F.col("block") == block[0]).select("bin", "words")
        last, spent = _end_of(inside, "bin", block[1], budget)

    key = ["rank", "doc_id", "size"]
    edge = times.select(*key, "digest", "words", F.posexplode("times").alias("pass", "time")).where(
        F.floor(F.col("time") * F.lit(ranges)).cast("long") == last
    )
    order = Window.orderBy("time", "rank", "digest", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    some = edge.withColumn("upto", F.sum("words").over(order) + F.lit(spent)).where(F.col("upto") <= budget)
    some = some.groupBy(*key).agg(F.count(F.lit(1)).alias("more"))
    some = some.select(F.col("rank").alias("__rank"), F.col("doc_id").alias("__doc"), F.col("size").alias("__size"), "more")
    whole = F.size(F.filter("bins", lambda b: b < last))
    chosen = times.join(
        some,
        (F.col("rank") == F.col("__rank")) & F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("size") == F.col("__size")),
        "left",
    ).withColumn("passes", whole + F.coalesce("more", F.lit(0)))
    columns = ["doc_id", "source", "size", "copies", "source_size", "target"]
    taken = chosen.select(*columns, (F.col("passes") * F.col("size")).cast("long").alias("taken"))
    return taken.union(placed.where("words = 0").select(*columns, F.lit(0).cast("long").alias("taken")))


def mix_report(mixed: DataFrame) -> DataFrame:
    """One row a document."""
    return mixed.select(
        "doc_id", "size", "source_size", "target", "taken", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("__copy")
    ).drop("__copy")


def take_mix(documents: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **settings) -> DataFrame:
    """The documents of the mix, all columns, each as often as it is taken."""
    mixed = mix_sources(documents, id_col=id_col, source_col=source_col, text_col=text_col, **settings).where("taken > 0")
    wanted = mixed.select(
        F.struct("doc_id", "source", "size", F.expr("cast(taken div size as int)").alias("times")).alias("wanted")
    )
    own = with_size(documents.select(F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("own")), f"own.`{text_col}`")
    matches = (
        F.col(f"own.`{id_col}`").eqNullSafe(F.col("wanted.doc_id"))
        & F.col(f"own.`{source_col}`").eqNullSafe(F.col("wanted.source"))
        & (F.col("size") == F.col("wanted.size"))
    )
    taken = own.join(wanted, matches).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("wanted.times"))))
    return taken.select("own.*")
