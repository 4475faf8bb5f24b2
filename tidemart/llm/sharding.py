"""Sharding by extendible hashing.

A directory is indexed by the first bits of a document's hash. It starts with one bucket; a
bucket whose texts exceed the byte limit splits on its next bit, and only such a bucket does, until
every bucket fits. Since a bucket splits exactly when it is too large, a document's bucket is the
shortest prefix of its hash whose documents fit, which one aggregation per level finds: levels
are counted on sums of bytes per long prefix, not on documents, and documents are looked at
again only in buckets that are still too large after that many bits.

Rows whose hashes are equal (repeated doc_ids) cannot be told apart by bits of that hash: they are
written out, and the place of each row in the written files gives further bits. A single document
beyond the limit has a bucket of its own, marked ``oversized``.

Defined results. Null text: 0 bytes. Null doc_id: hashed as the text 'null'. Empty table: no rows.
All columns are
carried into the shards' files, inside one struct, so that no name can clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import stored
from tidemart.session import scratch_dir

#: Bits looked at in one pass over the documents; a pass sums into at most 2^16 prefixes per bucket.
PASS_BITS = 16
HASH_BITS = 128
SHARD_BYTES = 32 << 20


def hash_bits(key: Column) -> Column:
    """128 bits of md5 as text of zeros and ones."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("null")))
    halves = [F.lpad(F.conv(F.substring(digest, i, 8), 16, 2), 32, "0") for i in (1, 9, 17, 25)]
    return F.concat(*halves)


def split_buckets(rows: DataFrame, start: int, limit: int, bits: int) -> DataFrame:
    """Directory entries below buckets that are too large: ``rows(bits, bucket, n_bytes)`` to
    ``prefix, depth, bucket_bytes, n_docs`` of every bucket that fits, and of those at the last
    bit whether they fit or not (``fits``)."""
    long = rows.groupBy(F.substring("bits", 1, start + bits).alias("long")).agg(
        F.sum("n_bytes").alias("n_bytes"), F.count(F.lit(1)).alias("n_docs"))
    levels = F.explode(F.sequence(F.lit(start), F.lit(start + bits))).alias("depth")
    sums = (
        long.select("*", levels)
        .groupBy(F.expr("substring(long, 1, depth)").alias("prefix"), "depth")
        .agg(F.sum("n_bytes").alias("bucket_bytes"), F.sum("n_docs").alias("n_docs"))
    )
    parents = sums.where(F.col("bucket_bytes") > limit).select("prefix", F.col("depth").alias("above"))
    # A bucket exists if its parent had to split: the parent is in the list of those too large.
    fits = F.col("bucket_bytes") <= limit
    live = sums.where(fits | (F.col("depth") == start + bits)).withColumn("fits", fits)
    root = live.where(F.col("depth") == start)
    below = live.where(F.col("depth") > start).join(
        parents.withColumnRenamed("prefix", "parent"),
        (F.expr("substring(prefix, 1, depth - 1)") == F.col("parent")) & (F.col("depth") - 1 == F.col("above")),
        "left_semi",
    )
    return root.unionByName(below)


def assign(docs: DataFrame, limit: int = SHARD_BYTES, pass_bits: int = PASS_BITS) -> DataFrame:
    """Every row of ``docs`` as the struct ``doc`` with ``shard`` (the bucket's bits, 'root' if
    nothing had to split), ``depth``, ``n_bytes``, ``shard_bytes`` and ``oversized``."""
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        hash_bits(F.col("doc_id")).alias("bits"),
    )
    done, start, of_rows = [], 0, False
    while True:
        buckets = stored(split_buckets(rows, start, limit, pass_bits), "directory")
        last = of_rows and start + pass_bits >= 2 * HASH_BITS
        alone = F.col("fits") | (F.col("n_docs") == 1) | F.lit(last)
        done.append(_look_up(rows, buckets.where(alone), start + pass_bits, start))
        large = buckets.where(~alone).select(F.col("prefix").alias("long"))
        if large.isEmpty():
            break
        rows = rows.withColumn("long", F.substring("bits", 1, start + pass_bits)).join(large, "long", "left_semi").drop("long")
        start += pass_bits
        if start >= HASH_BITS and not of_rows:
            rows, of_rows = _numbered(rows), True
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _look_up(rows: DataFrame, buckets: DataFrame, bits: int, start: int) -> DataFrame:
    """Each row's bucket, found by its first ``bits`` bits in the directory written out for
    all prefixes in use. In the first pass these are at most 2^PASS_BITS rows of some bytes, which
    are broadcast, so that the texts are not shuffled for it."""
    long = F.substring("bits", 1, bits)
    levels = F.explode(F.sequence(F.lit(start), F.lit(bits))).alias("depth")
    directory = (
        rows.select(long.alias("long")).distinct().select("long", levels)
        .withColumn("prefix", F.expr("substring(long, 1, depth)"))
        .join(buckets, ["prefix", "depth"])
    )
    if bits <= PASS_BITS:
        directory = F.broadcast(directory)
    return rows.withColumn("long", long).join(directory, "long").select(
        "doc", F.when(F.col("depth") == 0, "root").otherwise(F.col("prefix")).alias("shard"), "depth",
        "n_bytes", F.col("bucket_bytes").alias("shard_bytes"), (~F.col("fits")).alias("oversized"),
    )


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows with equal hashes get further bits from their place in written files."""
    spark, path = rows.sparkSession, scratch_dir(rows.sparkSession, "equal-hashes")
    rows.write.parquet(path)
    place = F.concat_ws("/", F.col("_metadata.file_name"), F.col("_metadata.row_index").cast("string"))
    again = spark.read.schema(rows.schema).parquet(path)
    return again.select("doc", "n_bytes", F.concat("bits", hash_bits(place)).alias("bits"))


def write_shards(docs: DataFrame, path: str, limit: int = SHARD_BYTES, pass_bits: int = PASS_BITS) -> None:
    """Write ``docs`` as one folder per shard; a shard may have several files."""
    assign(docs, limit, pass_bits).hint("rebalance", F.col("shard")).write.partitionBy("shard").parquet(path)


SHARD_COLUMNS = "n_bytes long, depth int, shard_bytes long, oversized boolean, shard string"


def read_shards(spark: SparkSession, path: str, columns: str = "doc_id long") -> DataFrame:
    """The given document columns of every row, with its shard."""
    return spark.read.schema(f"doc struct<{columns.replace(' ', ': ')}>, {SHARD_COLUMNS}").parquet(path).select(
        "doc.*", "shard", "depth", "n_bytes", "shard_bytes", "oversized")


def sharded(docs: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """Write the shards below the shared folder and return each document's place, read from them."""
    path = scratch_dir(docs.sparkSession, "shards")
    write_shards(docs, path, limit)
    return read_shards(docs.sparkSession, path)
