"""Sharding by proportional stratified interleaving (DataFrame functions only).

Rows are shuffled with a seed inside each source, ranked, and given the
fractional rank (r + phase) / n of their source.  The phase, a seeded hash of the
source in [0, 1), spreads sources of equal size, a long tail of single rows
above all, over the whole range instead of stacking them on one number.  Sorting
all rows by that rank interleaves the sources in proportion, and cutting the
sorted sequence into equal runs gives shards that each match the mixture.

The law of the shards is ``rows``: with N rows and S shards the shard of the
row at place p is floor(p * S / N), so counts differ by one at most.

Defined results: a null source is a stratum of its own; a null text has size 1
and the CRC of the empty text; repeated rows are rows like any other; an empty
table gives no rows; other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventrollup.llm.common import partition_starts, read_input, store, with_position

SHARDS = 16
SEED = "interleave-1"


def assign_shards(docs: DataFrame, shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """docs(doc_id, text, source) -> doc_id, source, size, text_crc32, shard, slot.

    Text is read once; the two global orders move only the slim rows.  A hot
    source spans as many range partitions as its rows need: ranks inside a
    source come from partition-local row numbers plus per-(source, partition)
    counts, never from a window over a whole source.
    """
    body = F.coalesce(F.col("text"), F.lit(""))
    slim = store(docs.select(
        "doc_id", "source",
        (F.octet_length(body).cast("bigint") + 1).alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        # Null is its own stratum, apart from the empty name.
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("stratum"),
        F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string")).cast("binary")).alias("lot"),
    ), "shard-slim")
    draw = F.substring(F.md5(F.concat(F.lit(f"{seed}/"), "stratum").cast("binary")), 1, 8)
    phase = F.conv(draw, 16, 10).cast("bigint") / F.lit(float(1 << 32))

    order = ["stratum", "lot", "doc_id", "text_crc32", "size"]
    dealt = slim.repartitionByRange(*order).sortWithinPartitions(*order) \
        .withColumn("__id", F.monotonically_increasing_id())
    dealt = store(dealt.withColumn("__part", F.shiftright("__id", 33).cast("int"))
                  .withColumn("__idx", F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))).drop("__id"),
                  "shard-ranked")
    # Global place in the (stratum, lot) order, less the stratum's first place.
    starts = F.broadcast(partition_starts(dealt.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))))
    placed = dealt.join(starts, "__part").withColumn("place", F.col("__start") + F.col("__idx")) \
        .drop("__idx", "__start")
    runs = placed.groupBy("stratum", "__part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    totals = runs.groupBy("stratum").agg(F.min("first").alias("first"), F.sum("n").alias("n"))
    # Keyed by (stratum, partition): a hot source is spread over its partitions.
    keyed = runs.select("stratum", "__part").join(totals, "stratum")
    ranked = placed.join(keyed, ["stratum", "__part"]) \
        .withColumn("fraction", (F.col("place") - F.col("first") + phase) / F.col("n")) \
        .drop("place", "first", "n", "__part")
    placed = with_position(ranked, ["fraction", "stratum", "lot", "doc_id", "text_crc32", "size"],
                           "shard-placed")
    total = slim.count()
    s, n, p = F.lit(shards).cast("bigint"), F.lit(total).cast("bigint"), F.col("position")
    shard = F.expr(f"position * {shards}L div {max(total, 1)}L")
    return placed.withColumn("shard", shard.cast("int")) \
        .withColumn("slot", p - F.expr(f"(shard * {total}L + {shards - 1}L) div {shards}L")) \
        .select("doc_id", "source", "size", "text_crc32", "shard", "slot")


def write_shards(docs: DataFrame, assigned: DataFrame, path: str) -> None:
    """Write the documents as one folder per shard, each file in slot order.

    The document is one struct column ``document``, so none of its columns can
    clash with the folder's ``shard`` or the ``slot``.  ``doc_id`` must identify a
    row here; the join is a plain shuffle join.
    """
    keys = assigned.select("doc_id", "shard", "slot")
    body = docs.select(F.col("doc_id").alias("id"), F.struct("*").alias("document"))
    body = body.join(keys, F.col("id") == F.col("doc_id")).select("shard", "slot", "document")
    body.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot") \
        .write.partitionBy("shard").parquet(path)


def op1_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_input(spark, sf_dir, "documents", "doc_id", "text", "source")
    out = assign_shards(docs)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "source")
