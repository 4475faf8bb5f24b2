"""Data checks and evaluation tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_counts(layers: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per named table."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_cnt")).select(F.lit(name).alias("layer"), "row_cnt")
             for name, df in layers.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def require_rows(df: DataFrame, name: str) -> DataFrame:
    """The table's name and number of rows; the job fails when there are none."""
    n = F.col("row_cnt")
    checked = F.when(n > 0, n).otherwise(F.raise_error(F.lit(f"{name} has no rows")).cast("long"))
    return df.agg(F.count(F.lit(1)).alias("row_cnt")).select(
        F.lit(name).alias("layer"), checked.alias("row_cnt")
    )


#: Buckets that two tables are compared by.
BUCKETS = 1024

_PARTS = ("high_1", "low_1", "high_2", "low_2")


def digests(df: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The multiset of rows as at most ``buckets`` rows, whatever the order and layout of ``df``:
    (bucket, n, and the sum of two 64-bit hashes of every row, in parts of 32 bits that do not
    overflow). Rows are reduced where they are read; only these sums are shuffled."""
    one, two = _row_hash(df, 1), _row_hash(df, 2)
    low = F.lit(0xFFFFFFFF)
    parts = (F.shiftright("_h1", 32), F.col("_h1").bitwiseAND(low), F.shiftright("_h2", 32), F.col("_h2").bitwiseAND(low))
    hashed = df.select(one.alias("_h1"), two.alias("_h2"))
    return hashed.groupBy(F.pmod("_h1", F.lit(buckets)).cast("int").alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(part).alias(name) for part, name in zip(parts, _PARTS, strict=True)])


def _row_hash(df: DataFrame, salt: int) -> Column:
    """A hash of a row; that a value is missing counts, and where."""
    return F.xxhash64(F.lit(salt), *[x for c in df.columns for x in (F.isnull(F.col(f"`{c}`")), F.col(f"`{c}`"))])


def _alike(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both with the columns of ``a``, matched by name, in types that hold the values of both."""
    fields = a.limit(0).unionByName(b.limit(0)).schema.fields
    return tuple(df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in fields]) for df in (a, b))


def _compared(a: DataFrame, b: DataFrame) -> DataFrame:
    """(bucket, left_rows, right_rows, same) of two tables."""
    x, y = digests(a).alias("x"), digests(b).alias("y")
    same = F.lit(True)
    for c in ("n", *_PARTS):
        same = same & F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}"))
    return x.join(y, "bucket", "full").select(
        "bucket", F.coalesce("x.n", F.lit(0)).alias("left_rows"), F.coalesce("y.n", F.lit(0)).alias("right_rows"), same.alias("same"))


def row_differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows whose number of occurrences differs; ``surplus`` is positive where ``a`` has more.

    Columns are matched by name. Buckets of rows are compared by their digests first; only rows of
    buckets that differ are moved. One grouping of both sides together, so that copies of a row
    combine before the shuffle.
    """
    a, b = _alike(a, b)
    differ = [r.bucket for r in _compared(a, b).where("NOT same").collect()]  # at most BUCKETS numbers
    left, right = (df.where(F.pmod(_row_hash(df, 1), F.lit(BUCKETS)).isin(differ)) for df in (a, b))
    signed = left.withColumn("_n", F.lit(1)).unionByName(right.withColumn("_n", F.lit(-1)))
    return signed.groupBy(*[f"`{c}`" for c in a.columns]).agg(F.sum("_n").alias("surplus")).where("surplus <> 0")


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: sizes of two results, whether the counts agree and whether the rows do.

    Equal counts say nothing about the rows; ``rows_match`` compares them as a multiset, by digests of
    128 bits, so that no row of either side is moved. ``row_differences`` names the rows.
    """
    sizes = _compared(*_alike(a, b)).agg(
        F.coalesce(F.sum("left_rows"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum("right_rows"), F.lit(0)).alias("right_rows"),
        F.coalesce(F.bool_and("same"), F.lit(True)).alias("rows_match"),
    )
    return sizes.select("left_rows", "right_rows", (F.col("left_rows") == F.col("right_rows")).alias("count_match"), "rows_match")


def eval_summary(log: DataFrame) -> DataFrame:
    """Question-benchmark log -> per method: successes, matches, mean latency and tokens."""
    return log.groupBy("paradigm").agg(
        F.count(F.lit(1)).alias("questions"),
        F.count_if("exec_ok").alias("exec_ok_cnt"),
        F.count_if("row_match").alias("row_match_cnt"),
        F.round(F.avg("latency_ms"), 4).alias("avg_latency_ms"),
        F.round(F.avg("tokens"), 4).alias("avg_tokens"),
    )
