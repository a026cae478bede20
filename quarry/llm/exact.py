"""Exact dedup by two passes over a Bloom filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import checked_broadcast, without
from quarry.operators.keyfilter import key_filter
from quarry.session import materialize

#: Bits of one filter row, fixed by bitmap_construct_agg.
BUCKET_BITS = 32768
#: Tasks over which a group of copies is dealt.
SALTS = 16
OUTPUT = ("keep_id", "group_size", "kept", "text_sha256")


def text_digest(text: str) -> Column:
    """SHA-256 of a text with every run of white space as one space; null counts as empty."""
    return F.sha2(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+", " "), 256)


def exact_dedup(docs: DataFrame, text: str = "text", key: str = "doc_id", cells_per_row: int = 16,
                probes: int = 2, broadcast_bytes: int = 64 << 20) -> DataFrame:
    """``docs`` without its text, with keep_id, group_size, kept and text_sha256.

    Texts are read once: rows are written with their digest in place of the text, and no exchange ever
    holds a text.  First pass: every digest marks ``probes`` cells, and cells that two rows or more marked
    become the bits of a Bloom filter.  Second pass: a row of which one cell is not set has a text of its
    own and passes straight through; only the others shuffle and are grouped by digest.  The filter has
    ``cells_per_row / 8`` bytes a row, so its size is known before it is built: it is broadcast up to
    ``broadcast_bytes`` and joined by its bucket beyond them, where rows without text meet it.

    Null text counts as empty; empty texts form one group.  Of equal texts the smallest key stays, a
    null key last; of rows that also repeat the key, one stays.  Columns of the input named like the
    four output columns, in any letter case, are replaced, all others but the text pass through.  Texts
    of any length become 32 bytes.  An empty table gives an empty one.
    """
    columns = [F.col(f"`{c}`") for c in without(docs, *OUTPUT, text).columns]
    hashed = docs.select(*columns, text_digest(text).alias("text_sha256"), F.monotonically_increasing_id().alias("__row"))
    hashed = materialize(hashed.withColumn("text_sha256", F.unhex("text_sha256")), "digests")
    buckets = max(1, -(-hashed.count() * cells_per_row // BUCKET_BITS))
    cells = [F.pmod(F.xxhash64("text_sha256", F.lit(i)), F.lit(buckets * BUCKET_BITS)) for i in range(probes)]

    bits = materialize(
        hashed.select(F.explode(F.array(*cells)).alias("cell"))
        .groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        .groupBy(F.expr(f"cell div {BUCKET_BITS}").alias("bucket"))
        .agg(F.expr(f"bitmap_construct_agg(cell % {BUCKET_BITS})").alias("bits")), "bloom")
    small = buckets * BUCKET_BITS // 8 <= broadcast_bytes

    probed, maybe = hashed, F.lit(True)
    for i, cell in enumerate(cells):
        side = bits.select(F.col("bucket").alias(f"__b{i}"), F.col("bits").alias(f"__bits{i}"))
        probed = (probed.withColumn(f"__c{i}", cell)
                  .join(F.broadcast(side) if small else side, F.expr(f"__c{i} div {BUCKET_BITS} = __b{i}"), "left"))
        byte = f"cast(conv(hex(substring(__bits{i}, cast(__c{i} % {BUCKET_BITS} div 8 as int) + 1, 1)), 16, 10) as int)"
        # The bitmap is read at once, so that it is in no row that shuffles again.
        maybe = maybe & F.col(f"__set{i}")
        probed = probed.withColumn(f"__set{i}", F.expr(f"coalesce(getbit({byte}, cast(__c{i} % 8 as int)) = 1, false)")).drop(f"__b{i}", f"__bits{i}", f"__c{i}")
    probed = probed.withColumn("__maybe", maybe).drop(*[f"__set{i}" for i in range(probes)])

    repeats = materialize(probed.filter("__maybe").drop("__maybe"), "repeats")
    order = F.struct(F.col(f"`{key}`").isNull().alias("none"), F.col(f"`{key}`").alias("id"), F.col("__row").alias("row"))
    groups = materialize(repeats.groupBy("text_sha256").agg(F.min(order).alias("__first"), F.count(F.lit(1)).alias("group_size")), "groups")
    # A group's copies are dealt over SALTS tasks, each with the group's row, so no task gets a large group.
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt")
    salted = repeats.withColumn("__salt", F.pmod("__row", F.lit(SALTS)).cast("int"))
    digest = F.lower(F.hex("text_sha256")).alias("text_sha256")
    grouped = salted.join(groups.select("*", salts), ["text_sha256", "__salt"]).select(
        *columns, F.col("__first.id").alias("keep_id"), "group_size",
        (F.col("__row") == F.col("__first.row")).alias("kept"), digest)
    single = probed.filter(~F.col("__maybe")).select(
        *columns, F.col(f"`{key}`").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), digest)
    return single.unionByName(grouped)


def without_copies(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, texts included, that ``exact_dedup`` keeps.

    Rows that go are told by key and digest.  A Bloom filter of these, of bounded size, is tested on the
    rows in place: what it excludes stays without a shuffle, the rest is compared with the list.  Of
    rows that repeat key and text any one stays.
    """
    told = exact_dedup(docs.select(F.col(f"`{key}`").alias("__id"), F.col(f"`{text}`").alias("__text")), "__text", "__id")
    # A row's name: key and digest; of several rows with one name all but one go.
    name = lambda k, digest: F.sha2(F.concat_ws("|", k.isNull().cast("string"), F.coalesce(k.cast("string"), F.lit("")), digest), 256)
    named = told.select(name(F.col("__id"), F.col("text_sha256")).alias("__name"), "kept")
    gone = materialize(named.groupBy("__name").agg(F.max("kept").alias("__one"), F.count_if(~F.col("kept")).alias("n")).filter("n > 0").drop("n"), "copies")
    rows = docs.withColumn("__name", name(F.col(f"`{key}`"), text_digest(text)))
    maybe = key_filter(gone, "__name")(F.col("__name"))
    near = rows.filter(maybe).join(checked_broadcast(gone, 72), "__name", "left")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    kept = rows.filter(~maybe).select(*columns).unionByName(near.filter("__one IS NULL").select(*columns))
    if not gone.filter("__one").limit(1).count():
        return kept
    return kept.unionByName(near.filter("__one").dropDuplicates(["__name"]).select(*columns))
