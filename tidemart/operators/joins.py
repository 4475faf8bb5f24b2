"""Joins of a large fact with dimensions, safe against size and against hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Largest dimension that is sent to every executor, in bytes of its files. Decoded rows
# take several times that, which is why the figure is far below Spark's own 8 GB limit.
BROADCAST_FILE_BYTES = 20 * 1024 * 1024

# A key is hot when it holds at least this share of the rows, so there can be at most
# 1 / HOT_SHARE hot keys whatever the size of the data.
HOT_SHARE = 0.005

# Number of partitions a hot key is spread over.
SALTS = 64


def source_bytes(df: DataFrame) -> int:
    """Bytes of all files and relations that ``df`` reads, from Catalyst's statistics.

    The estimate for a whole plan multiplies the sizes of joined tables; a dimension that
    looks up names in smaller tables is no larger than its inputs together.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def is_small(df: DataFrame, limit: int | None = None) -> bool:
    return source_bytes(df) <= (BROADCAST_FILE_BYTES if limit is None else limit)


def attach(
    fact: DataFrame,
    dim: DataFrame,
    key: str | Sequence[str],
    how: str = "left",
    limit: int | None = None,
) -> DataFrame:
    """Join ``dim`` (unique on ``key``) to ``fact``; ``how`` is ``left`` or ``inner``.

    A dimension within the size limit is broadcast, and the fact is not moved at all. A
    larger one takes ``spread_join``.
    """
    if is_small(dim, limit):
        return fact.join(F.broadcast(dim), key, how)
    return spread_join(fact, dim, key, how)


def spread_join(
    fact: DataFrame, dim: DataFrame, key: str | Sequence[str], how: str = "left", hint: str = "merge"
) -> DataFrame:
    """Shuffle join that does not leave a hot key (or a NULL key) to one task.

    Adaptive execution splits an oversized partition of the fact by its map outputs, even
    when a single key fills it, and needs no look at the data beforehand. In a session
    that has it switched off, hot keys are counted and salted instead.
    """
    conf = fact.sparkSession.conf
    adaptive = all(
        conf.get(name).lower() == "true"
        for name in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")
    )
    if adaptive:
        return fact.join(dim.hint(hint), key, how)
    return salted_join(fact, dim, key, how, hint=hint)


def hot_keys(df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE) -> DataFrame:
    """Keys (NULL included) that hold at least ``share`` of the rows: at most 1/share rows."""
    counted = df.groupBy(*keys).count()
    total = df.groupBy().agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("count") >= total.scalar() * F.lit(share)).select(*keys)


def salted_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str | Sequence[str],
    how: str = "left",
    share: float = HOT_SHARE,
    salts: int = SALTS,
    hint: str | None = None,
) -> DataFrame:
    """Shuffle join in which every hot key is split over ``salts`` partitions.

    The rows of ``dim`` for hot keys are copied once per salt; all other rows travel once.
    The salt is a hash of the fact row, so a task that runs again puts its rows in the
    same place. Only the hot keys, whose number is bounded by ``1 / share``, are broadcast.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be left or inner, not {how!r}")
    keys = [key] if isinstance(key, str) else list(key)
    hot = hot_keys(fact, keys, share)
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in fact.columns]), F.lit(salts)).cast("int")
    salted_fact = _flag_hot(fact, hot, keys).withColumn(
        "_salt", F.when(F.col("_hot"), spread).otherwise(0)
    ).drop("_hot")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted_dim = _flag_hot(dim, hot, keys).withColumn("_salt", F.explode(copies)).drop("_hot")
    if hint:
        salted_dim = salted_dim.hint(hint)
    return salted_fact.join(salted_dim, [*keys, "_salt"], how).drop("_salt")


def _flag_hot(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds ``_hot``; NULL keys count as equal, so a hot NULL is found too."""
    marks = hot.select(*[F.col(k).alias(f"_h_{k}") for k in keys], F.lit(True).alias("_hot"))
    same: Column = F.lit(True)
    for k in keys:
        same = same & df[k].eqNullSafe(marks[f"_h_{k}"])
    flagged = df.join(F.broadcast(marks), same, "left")
    return flagged.drop(*[f"_h_{k}" for k in keys]).withColumn("_hot", F.coalesce("_hot", F.lit(False)))


def enrich(
    fact: DataFrame,
    dims: Sequence[tuple[DataFrame, str]],
    how: str = "left",
    limit: int | None = None,
) -> DataFrame:
    """``attach`` several dimensions, each given with its key."""
    for dim, key in dims:
        fact = attach(fact, dim, key, how, limit)
    return fact


def compare_by_key(
    left: DataFrame, right: DataFrame, keys: Sequence[str], value: str, names: tuple[str, str]
) -> DataFrame:
    """Full outer comparison of two keyed results.

    Keys come from whichever side has them; ``diff`` is right minus left, where a side
    without the key counts as zero.
    """
    a, b = names
    lhs = left.select(*keys, F.col(value).alias(a))
    rhs = right.select(*keys, F.col(value).alias(b))
    zero = F.lit(0)
    return lhs.join(rhs, list(keys), "full_outer").withColumn(
        "diff", F.coalesce(b, zero) - F.coalesce(a, zero)
    )
