"""Mixing sources to target shares by a low-discrepancy schedule of equal-token blocks.

Every source is laid out as one line of tokens, its documents in the order of a hash, and cut into
blocks whose sizes differ by one token at most.  A schedule of slots says which source gives its
next block: slot n has the van der Corput point of n (its bits reversed), and the points are mapped
through the cumulative slot quotas of the sources.  With 2**bits slots every point occurs once, so a
source gets exactly its quota, and any stretch of the schedule holds it in nearly its share.  The
r-th slot of a source takes block r modulo its blocks; a source that is short repeats in epochs.

All of it is built-in SQL functions.  No window spans a source: running totals go by chunks of the
hash order (or of the schedule) and then within a chunk, so a source of a third of all rows is dealt
like the rest.  Only the table of sources itself, one row each, is ordered in one task.

Results for odd input: a null or empty text has size 0 and gives nothing; a null source is a source
of its own, the last; rows that agree in doc_id, source and text are laid out one after another;
rows without a doc_id are told apart by their texts; no rows give no rows.  Columns other than
doc_id, text and source are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .components import written
from .exchange import partitions_of

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_TOKENS = 1024
#: Slots that each source has at least, where its words allow: a quota is then right to 0.1 %.
LEAST_SLOTS = 512
CHUNK_ROWS = 1 << 16
COPIES_AT_ONCE = 4096


def laid_out(documents: DataFrame) -> DataFrame:
    """(source, doc_id, key, size, copies): distinct documents, their size in words, how often they occur."""
    text = F.col("text").cast("string")
    identity = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.md5(text), F.lit("")))
    rows = documents.select(
        F.col("source").cast("string").alias("source"),
        "doc_id",
        F.md5(identity).alias("key"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
    )
    return rows.groupBy("source", "doc_id", "key", "size").agg(F.count("*").alias("copies"))


def source_targets(
    layout: DataFrame,
    weights: Sequence[int] = (1, 2, 3),
    most: int = 3,
    block_tokens: int = BLOCK_TOKENS,
    least_slots: int = LEAST_SLOTS,
) -> DataFrame:
    """One row a source: its size, target, number of blocks and quota of slots.

    Sources in code-point order, null last, take the weights in turn.  Targets add up to the size of
    everything; none is above `most` times its source.  In the order of the weight at which a source
    meets that limit, those before the first source that keeps below it are at their limit, and what
    they leave is shared by weight, which is where sharing the excess again and again ends.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    sizes = layout.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    turn = (F.col("source_id") - 1) % len(weights) + 1
    sources = sizes.select("*", F.row_number().over(by_name).cast("bigint").alias("source_id")).select(
        "*",
        F.element_at(F.array(*(F.lit(w).cast("bigint") for w in weights)), turn.cast("int")).alias("weight"),
        (F.col("source_size") * most).alias("limit"),
    )
    everything = Window.partitionBy()
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), "source_id")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_limit.rowsBetween(0, Window.unboundedFollowing)
    sources = sources.select(
        "*",
        F.row_number().over(by_limit).alias("place"),
        (
            (F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0)))
            / F.sum("weight").over(onward)
        ).alias("level"),
    )
    free = F.col("limit") >= F.col("level") * F.col("weight")
    first_free = F.min(F.when(free, F.struct("place", "level"))).over(everything)
    sources = sources.withColumn("first_free", first_free).withColumn(
        "target",
        F.when(F.col("place") < F.col("first_free.place"), F.col("limit").cast("double")).otherwise(
            F.least(F.col("limit").cast("double"), F.col("first_free.level") * F.col("weight"))
        ),
    )
    wanted = F.ceil(F.try_divide(F.col("source_size") * float(least_slots), F.col("target")))
    blocks = F.greatest(F.ceil(F.col("source_size") / block_tokens), F.least(F.col("source_size"), F.coalesce(wanted, F.lit(0))))
    quota = F.floor(F.coalesce(F.try_divide(F.col("target") * F.col("blocks"), F.col("source_size")), F.lit(0.0)) + 0.5)
    sources = sources.withColumn("blocks", blocks.cast("bigint")).withColumn(
        "slots", F.least(quota, F.col("blocks") * most).cast("bigint")
    )
    earlier = Window.orderBy("source_id").rowsBetween(Window.unboundedPreceding, -1)
    return sources.select(
        "source_id",
        "source",
        "source_size",
        "target",
        "blocks",
        "slots",
        F.coalesce(F.sum("slots").over(earlier), F.lit(0)).cast("bigint").alias("first_point"),
    )


def schedule(spark: SparkSession, sources: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(slot, source_id, block, epoch) for every slot; a slot whose point no source owns is left out."""
    total, n_sources = sources.agg(F.coalesce(F.sum("slots"), F.lit(0)), F.count("*")).first()
    bits = max(1, (int(total) - 1).bit_length())
    point = F.conv(F.reverse(F.lpad(F.bin("slot"), bits, "0")), 2, 10).cast("bigint")
    slots = spark.range(1 << bits).select(F.col("id").alias("slot"), point.alias("point"))
    width = max(0, bits - (4 * n_sources).bit_length())
    last_point = F.col("first_point") + F.col("slots")
    cells = sources.where("slots > 0").select(
        "source_id",
        "first_point",
        last_point.alias("last_point"),
        F.explode(F.sequence(F.shiftright("first_point", width), F.shiftright(last_point - 1, width))).alias("cell"),
    )
    owned = (F.shiftright("point", width) == F.col("cell")) & (F.col("point") >= F.col("first_point")) & (F.col("point") < F.col("last_point"))
    dealt = written(slots.join(cells, owned).select("slot", "source_id"), "mix-slots")
    chunks = max(partitions_of(spark), (1 << bits) // chunk_rows)
    shift = max(0, bits - (chunks - 1).bit_length())
    ranked = _running(dealt.withColumn("chunk", F.shiftright("slot", shift)), F.lit(1).cast("bigint"), "slot")
    numbered = ranked.join(sources.select("source_id", "blocks"), "source_id")
    return numbered.select(
        "slot",
        "source_id",
        (F.col("before") % F.col("blocks")).alias("block"),
        F.expr("before div blocks").alias("epoch"),
    )


def _running(rows: DataFrame, amount: Column, *order: str) -> DataFrame:
    """A column `before`: the amounts of a source's earlier rows, by `chunk` and then by `order`."""
    earlier = Window.partitionBy("source_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("source_id", "chunk").agg(F.sum(amount).alias("amount"))
    offsets = sums.select("source_id", "chunk", F.coalesce(F.sum("amount").over(earlier), F.lit(0)).alias("offset"))
    within = Window.partitionBy("source_id", "chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = rows.withColumn("inside", F.coalesce(F.sum(amount).over(within), F.lit(0)))
    return inside.join(offsets, ["source_id", "chunk"]).withColumn("before", F.col("offset") + F.col("inside"))


def pieces(spark: SparkSession, layout: DataFrame, sources: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(source_id, block, doc_id, key, copy, size, length): what of each document lies in each block.

    A document of size 0 has one row without a block.
    """
    chunks = max(partitions_of(spark), layout.count() // chunk_rows)
    place = F.conv(F.substring("key", 1, 8), 16, 10).cast("bigint")
    ids = sources.select("source_id", F.col("source").alias("name"), "source_size", "blocks")
    rows = layout.join(ids, F.col("source").eqNullSafe(F.col("name")))
    rows = rows.withColumn("chunk", F.shiftright(place * chunks, 32))
    rows = _running(rows, F.col("size") * F.col("copies"), "key", "doc_id")
    some = F.expr(f"explode(sequence(0L, (copies - 1) div {COPIES_AT_ONCE}))")
    one = F.expr(f"explode(sequence({COPIES_AT_ONCE} * some, least(copies, {COPIES_AT_ONCE} * (some + 1)) - 1))")
    rows = rows.withColumn("some", some).withColumn("copy", one)
    rows = rows.withColumn("start", F.expr("before + copy * size")).withColumn("end", F.expr("start + size"))
    # The first `longer` blocks have a token more than the others, so that block ends need no product.
    rows = rows.withColumn("longer", F.expr("source_size % greatest(blocks, 1)"))
    rows = rows.withColumn("base", F.expr("source_size div greatest(blocks, 1)"))
    block = "if({0} < longer * (base + 1), {0} div (base + 1), longer + ({0} - longer * (base + 1)) div base)"
    spans = F.expr(f"if(size > 0, sequence({block.format('start')}, {block.format('(end - 1)')}), null)")
    rows = rows.select("source_id", "doc_id", "key", "copy", "size", "start", "end", "longer", "base", F.explode_outer(spans).alias("block"))
    low = "block * base + least(block, longer)"
    length = F.expr(f"least(end, {low} + base + if(block < longer, 1, 0)) - greatest(start, {low})")
    return rows.select("source_id", "block", "doc_id", "key", "copy", "size", length.cast("bigint").alias("length"))


def mixed(
    documents: DataFrame,
    weights: Sequence[int] = (1, 2, 3),
    most: int = 3,
    block_tokens: int = BLOCK_TOKENS,
    least_slots: int = LEAST_SLOTS,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sources, schedule, pieces); the mix is the schedule joined to the pieces by source and block."""
    spark = documents.sparkSession
    layout = written(laid_out(documents), "mix-layout")
    sources = written(source_targets(layout, weights, most, block_tokens, least_slots), "mix-sources")
    return sources, schedule(spark, sources), pieces(spark, layout, sources)


def taken_words(documents: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, size, source_size, target, and the words that the mix takes of it, repeats counted."""
    sources, slots, parts = mixed(documents, **options)
    repeats = slots.groupBy("source_id", "block").agg(F.count("*").alias("repeats"))
    met = parts.join(repeats, ["source_id", "block"], "left")
    taken = F.sum(F.coalesce(F.col("length") * F.col("repeats"), F.lit(0))).alias("taken")
    rows = met.groupBy("source_id", "doc_id", "key", "copy", "size").agg(taken)
    return rows.join(sources, "source_id").select("doc_id", "size", "source_size", "target", "taken")
