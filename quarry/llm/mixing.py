"""Mixing sources to target weights by entropy balancing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.llm.common import without
from quarry.session import materialize

OUTPUT = ("size", "source_size", "target", "rate", "copies", "taken")


def _sizes(text: str):
    """Number of words [^\\x20\\x09-\\x0D]+; a null text has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_ranks(sources: DataFrame, source: str) -> DataFrame:
    """Adds ``rank``: 0 for the first source by code point, null last; ranges are numbered apart, so
    that no task holds all sources."""
    ranged = materialize(
        sources.repartitionByRange(F.col(source).asc_nulls_last()).withColumn("__part", F.spark_partition_id())
        .withColumn("__in", F.row_number().over(Window.partitionBy("__part").orderBy(F.col(source).asc_nulls_last()))),
        "source-ranks")
    before = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = before.withColumn("__before", F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).drop("__n")
    return (ranged.join(before, "__part")
            .withColumn("rank", F.col("__before") + F.col("__in") - 1).drop("__part", "__in", "__before"))


def capped_targets(sources: DataFrame, total: float, cap: float) -> DataFrame:
    """Adds ``target``: shares of ``total`` by ``weight``, none above ``cap`` times its ``source_size``;
    what a capped source cannot take is shared again by weight until none is above."""
    capped = F.lit(False)
    limit = F.col("source_size") * F.lit(float(cap))
    while True:
        row = sources.select(
            F.sum(F.when(capped, limit).otherwise(0.0)).alias("held"),
            F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))).alias("weight"),
            F.sum(capped.cast("int")).alias("n")).first()
        share = max(0.0, total - (row.held or 0.0)) / row.weight if row.weight else 0.0
        now = capped | (F.col("weight") * F.lit(share) > limit)
        found = sources.select(F.sum(now.cast("int"))).first()[0] or 0
        if found == (row.n or 0):
            return sources.withColumn("target", F.when(capped, limit).otherwise(F.col("weight") * F.lit(share)))
        # The share only grows from round to round, so a source once above its limit stays there.
        capped = F.col("weight") * F.lit(share) > limit


def balance(cells: DataFrame, margins: dict[str, DataFrame], tolerance: float = 1e-10, rounds: int = 60) -> DataFrame:
    """Entropy balancing: ``cells`` (size, and a column for each margin) with their ``rate``.

    Among all rates that give each margin's tokens their target, these are nearest to 1 in relative
    entropy, taken over tokens: rate = exp(sum of the duals of the cell's margins).  The dual
    sum(size * rate) - sum(dual * target) is convex.  A Newton step for one margin needs its gradient
    (tokens - target) and its Hessian, which is diagonal (tokens), so each step is one distributed sum
    by that margin; several margins take turns.  ``margins``: name -> table (name, target).  Iteration
    ends when every margin's tokens are within ``tolerance`` of their targets, or after ``rounds``.
    A target of 0 gives rate 0.
    """
    cells = cells.withColumn("rate", F.lit(1.0))
    for k in range(rounds):
        worst = 0.0
        for name, targets in margins.items():
            wanted = targets.select(F.col(name).alias("__m"), F.col("target").alias("__t"))
            tokens = cells.groupBy(F.col(name).alias("__n")).agg(F.sum(F.col("size") * F.col("rate")).alias("__tokens"))
            gap = F.col("__t") / F.col("__tokens") - 1
            # exp'(dual) = tokens: the Newton step (target - tokens) / tokens, at most 1 up or down.
            steps = tokens.join(wanted, F.col("__n").eqNullSafe(F.col("__m"))).select(
                "__n", F.when(F.col("__t") > 0, F.exp(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), gap)))).otherwise(0.0).alias("__by"),
                F.when((F.col("__t") > 0) & (F.col("__tokens") > 0), F.abs(gap)).otherwise(0.0).alias("__gap"))
            stepped = materialize(cells.join(steps, F.col(name).eqNullSafe(F.col("__n"))), f"newton-{k}")
            worst = max(worst, stepped.agg(F.max("__gap")).first()[0] or 0.0)
            cells = stepped.withColumn("rate", F.coalesce(F.col("rate") * F.col("__by"), F.lit(0.0))).drop("__n", "__by", "__gap")
        if worst <= tolerance:
            break
    return cells


def rounded_copies(docs: DataFrame, key: str, source: str, most: int, block_rows: int = 4096) -> DataFrame:
    """Adds ``copies``: ``rate`` rounded up or down, so that tokens come near each source's target.

    Documents of a source are dealt by hash into blocks of about ``block_rows``; in a block, ordered by
    size, running sums of the rates are rounded, so the error of a block is less than its longest
    document and blocks' errors even out.  A hot source is so many blocks, not one group.  Rates
    within 1e-9 of a whole number count as whole.  Reruns agree: hashes depend on the row alone.
    """
    spread = F.xxhash64(key, "__hash")
    whole = F.floor(F.col("rate") + 1e-9)
    block = F.pmod(spread, F.greatest(F.lit(1).cast("long"), F.expr(f"__source_rows div {block_rows}")))
    docs = docs.withColumn("__block", block).withColumn("__part", F.greatest(F.lit(0.0), F.col("rate") - whole))
    docs = docs.withColumn("__part", F.when(F.col("__part") < 2e-9, 0.0).otherwise(F.col("__part")))
    start = F.pmod(F.xxhash64(source, "__block"), F.lit(1 << 20)) / float(1 << 20)
    order = Window.partitionBy(source, "__block").orderBy(F.col("size").desc(), F.col(key), "__hash")
    upto = F.sum("__part").over(order.rowsBetween(Window.unboundedPreceding, 0))
    docs = docs.withColumn("__upto", upto + start)
    up = F.floor("__upto") - F.floor(F.col("__upto") - F.col("__part"))
    up = F.when(F.col("__part") > 0, F.least(F.greatest(up, F.lit(0)), F.lit(1))).otherwise(0)
    return docs.withColumn("copies", F.least(whole + up, F.lit(most)).cast("long")).drop("__block", "__part", "__upto")


def mix_sources(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source",
                weights: tuple[float, ...] = (5.0, 2.0, 1.0), budget: float = 1.5, cap: int = 2) -> DataFrame:
    """``docs`` (without its text) with size, source_size, target, rate, copies and taken.

    Sources in code point order, null last, weigh ``weights``, repeating.  They share ``budget`` times
    all words; a target stops at ``cap`` times its source's words.  Entropy balancing over (source)
    cells gives the documents' rates, which are rounded into at most ``cap`` copies; taken is size
    times copies.  A null or empty text has size 0 and takes 0 words; a source without words has
    target 0; a null source is a source.  Rows with repeated or null keys are rows of their own.  Input
    columns named like the output columns, in any letter case, are replaced.  An empty table gives an empty one.
    """
    kept = [F.col(f"`{c}`") for c in without(docs, *OUTPUT, text).columns]
    rows = materialize(docs.select(*kept, _sizes(text).alias("size"),
                                   F.xxhash64(text).alias("__hash")), "sizes")
    sums = rows.groupBy(source).agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("__source_rows"))
    ranked = source_ranks(sums, source)
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = materialize(ranked.withColumn("weight", F.get(cycle, F.pmod("rank", F.lit(len(weights))).cast("int"))), "sources")
    total = float(ranked.agg(F.sum("source_size")).first()[0] or 0)
    # The list of sources is a written table with a row for each source; everything below stays distributed.
    targets = materialize(capped_targets(ranked, budget * total, cap), "targets")
    cells = targets.select(source, F.col("source_size").alias("size"))
    rates = balance(cells, {source: targets.select(source, "target")})
    rates = targets.join(rates.select(F.col(source).alias("__s"), F.col("rate")), F.col(source).eqNullSafe(F.col("__s")), "left")
    rates = rates.select(F.col(source).alias("__s"), "source_size", "__source_rows", "target",
                         F.least(F.coalesce("rate", F.lit(0.0)), F.lit(float(cap))).alias("rate"))
    mixed = rows.join(rates, F.col(source).eqNullSafe(F.col("__s"))).drop("__s")
    mixed = rounded_copies(mixed, key, source, cap)
    return mixed.withColumn("taken", F.col("size") * F.col("copies")).drop("__hash", "__source_rows")
