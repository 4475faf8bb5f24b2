"""Tables with versions, as relations below a folder.

Three tables make up a history: ``rows`` (all rows ever added, partitioned by ``_added_v``, the version
that added them, and numbered by ``_row_n`` within it), ``deletes`` (``_added_v`` and ``_row_n`` of deleted rows,
partitioned by ``_deleted_v``) and ``changes`` (a row per change: the version it made, its parent, operation
and columns). A version holds the rows that it or an ancestor added, less those that it or an ancestor
deleted; a rollback only moves the head, and what is done next has that version as its parent.

A change writes its rows or deletes first and its line in ``changes`` last: what has no line there does
not exist, and is written over by the next change. Any session opens the history by its folder. What is
stored are rows and ids, not conditions: a delete by ``rand()`` or by a day in the session's zone
reads the same ever after. One writer at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.sources import formats

CHANGES = "seq long, version long, parent long, op string, columns array<string>, fields string, adds boolean, deletes boolean, source string, batch long"
DELETES = "_added_v long, _row_n long, _deleted_v long"
ROLLBACK = "rollback"


@dataclass(frozen=True)
class History:
    """A history as it was when it was opened or changed last; ``changes`` are its lines, of a few
    numbers and names each."""

    spark: SparkSession
    folder: str
    changes: tuple[Row, ...]

    @property
    def head(self) -> int:
        return self.changes[-1].version

    @property
    def rows(self) -> DataFrame:
        """All rows ever added, with ``_added_v`` and ``_row_n``."""
        schema = T.StructType([*_fields(self), T.StructField("_row_n", T.LongType()), T.StructField("_added_v", T.LongType())])
        there = [line.version for line in self.changes if line.adds]
        return self.spark.read.schema(schema).parquet(f"{self.folder}/rows").where(F.col("_added_v").isin(there))

    @property
    def deletes(self) -> DataFrame:
        """All deletes: (_added_v, _row_n, _deleted_v)."""
        there = [line.version for line in self.changes if line.deletes]
        if not there:
            return self.spark.createDataFrame([], DELETES)
        return self.spark.read.schema(DELETES).parquet(f"{self.folder}/deletes").where(F.col("_deleted_v").isin(there))


def begin(df: DataFrame, folder: str) -> History:
    """A history whose version 1 holds ``df``."""
    h = History(df.sparkSession, folder, ())
    _add_rows(df, folder, 1)
    return _commit(h, 1, None, "append", df.columns, df.schema, adds=True)


def open_history(spark: SparkSession, folder: str) -> History:
    """A history that this or another session has stored."""
    lines = spark.read.schema(CHANGES).parquet(f"{folder}/changes").collect()
    return History(spark, folder, tuple(sorted(lines, key=lambda line: line.seq)))


def append(h: History, df: DataFrame, source: str | None = None, batch: int | None = None) -> History:
    """Add rows. A column that the history lacks must be added first. ``source`` and ``batch`` say
    which micro-batch of which stream this is."""
    types = {f.name: f.dataType for f in _fields(h)}
    unknown = [c for c in df.columns if c not in _columns(h, h.head)]
    if unknown:
        raise ValueError(f"columns not in the table: {unknown}")
    version = _next(h)
    _add_rows(df.select(*[F.col(c).cast(types[c]) for c in df.columns]), h.folder, version)
    return _commit(h, version, h.head, "append", adds=True, source=source, batch=batch)


def append_batch(folder: str, source: str):
    """For ``foreachBatch``: every micro-batch of a stream becomes one version of the history at
    ``folder``. A batch that is run again, before or after its line was written, adds no second
    version; a batch without rows adds none."""

    def add(batch: DataFrame, batch_id: int) -> None:
        h = open_history(batch.sparkSession, folder)
        known = any(line.source == source and line.batch == batch_id for line in h.changes)
        if not known and not batch.isEmpty():
            append(h, batch, source, batch_id)

    return add


def add_column(h: History, name: str, type_name: str) -> History:
    """A new nullable column. Rows there are read NULL."""
    if name in _columns(h, h.head):
        raise ValueError(f"column {name} exists")
    fields = _fields(h)
    if name not in [f.name for f in fields]:
        fields = [*fields, T.StructField(name, T._parse_datatype_string(type_name))]
    return _commit(h, _next(h), h.head, "add_column", [*_columns(h, h.head), name], T.StructType(fields))


def delete_where(h: History, condition: str) -> History:
    """Delete the rows for which the SQL condition is true; NULL is not true."""
    version = _next(h)
    _add_deletes(_live(h, h.head).where(F.expr(condition)), h.folder, version)
    return _commit(h, version, h.head, "delete", deletes=True)


def delete_by_rewrite(h: History, condition: str) -> History:
    """The same rows go, but every batch that holds one is added again without them: readers
    of later versions find whole batches deleted."""
    version = _next(h)
    live = _live(h, h.head)
    hit = [r._added_v for r in live.where(F.expr(condition)).select("_added_v").distinct().collect()]  # at most all versions
    batches = live.where(F.col("_added_v").isin(hit))
    _add_rows(batches.where(~F.coalesce(F.expr(condition), F.lit(False))).select(*_columns(h, h.head)), h.folder, version)
    _add_deletes(batches, h.folder, version)
    return _commit(h, version, h.head, "overwrite", adds=True, deletes=True)


def rollback_to(h: History, version: int) -> History:
    """Make an earlier version the head. Later versions stay readable by number."""
    return _commit(h, version, None, ROLLBACK, _columns(h, version))


def read_as_of(h: History, version: int | None = None) -> DataFrame:
    """Rows and columns of a version; of the head by default."""
    at = h.head if version is None else version
    return _live(h, at).select(*_columns(h, at))


def log(h: History) -> DataFrame:
    """All versions with their numbers of added and deleted rows."""
    lines = [(line.version, line.parent, line.op) for line in h.changes if line.op != ROLLBACK]
    versions = h.spark.createDataFrame(lines, "version long, parent long, op string")
    added = h.rows.groupBy(F.col("_added_v").alias("version")).agg(F.count(F.lit(1)).alias("added"))
    deleted = h.deletes.groupBy(F.col("_deleted_v").alias("version")).agg(F.count(F.lit(1)).alias("deleted"))
    zero = F.lit(0).cast("long")
    return versions.join(added, "version", "left").join(deleted, "version", "left").select(
        "version", "parent", "op", F.coalesce("added", zero).alias("added"), F.coalesce("deleted", zero).alias("deleted"),
        (F.col("version") == h.head).alias("is_current"))


def version_diff(h: History, old: int, new: int) -> DataFrame:
    """Row counts of two versions and their difference."""
    sizes = read_as_of(h, old).select(F.lit(1).alias("o"), F.lit(0).alias("n")).union(
        read_as_of(h, new).select(F.lit(0).alias("o"), F.lit(1).alias("n"))
    ).agg(F.coalesce(F.sum("o"), F.lit(0)).alias("old_rows"), F.coalesce(F.sum("n"), F.lit(0)).alias("new_rows"))
    return sizes.withColumn("diff", F.col("new_rows") - F.col("old_rows"))


def _line(h: History, version: int) -> Row:
    for line in h.changes:
        if line.version == version and line.op != ROLLBACK:
            return line
    raise ValueError(f"no version {version}")


def _columns(h: History, version: int) -> list[str]:
    return _line(h, version).columns


def _fields(h: History) -> list[T.StructField]:
    """All columns that any version has had."""
    return T.StructType.fromDDL(h.changes[-1].fields).fields


def _next(h: History) -> int:
    return max(line.version for line in h.changes) + 1


def _live(h: History, version: int) -> DataFrame:
    """The version's rows with their ids: its batches, less the ids deleted on its line. Files of other
    versions are not read, and where nothing was deleted nothing is joined."""
    line, at = [], _line(h, version)
    while at is not None:
        line.append(at)
        at = _line(h, at.parent) if at.parent is not None else None
    rows = h.rows.where(F.col("_added_v").isin([at.version for at in line if at.adds]))
    deleted = [at.version for at in line if at.deletes]
    if not deleted:
        return rows
    gone = h.deletes.where(F.col("_deleted_v").isin(deleted)).select("_added_v", "_row_n")
    return rows.join(gone, ["_added_v", "_row_n"], "left_anti")


def _add_rows(df: DataFrame, folder: str, version: int) -> None:
    df.withColumn("_row_n", F.monotonically_increasing_id()).write.mode("overwrite").parquet(f"{folder}/rows/_added_v={version}")


def _add_deletes(rows: DataFrame, folder: str, version: int) -> None:
    rows.select("_added_v", "_row_n").write.mode("overwrite").parquet(f"{folder}/deletes/_deleted_v={version}")


def _commit(
    h: History, version: int, parent: int | None, op: str, columns: list[str] | None = None, schema: T.StructType | None = None,
    adds: bool = False, deletes: bool = False, source: str | None = None, batch: int | None = None,
) -> History:
    """Write the line that makes a change exist."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) if schema else h.changes[-1].fields
    seq = h.changes[-1].seq + 1 if h.changes else 0
    line = Row(*T.StructType.fromDDL(CHANGES).names)(
        seq, version, parent, op, columns or _columns(h, h.head), fields, adds, deletes, source, batch)
    formats.append_line(h.spark, [tuple(line)], CHANGES, f"{h.folder}/changes")
    return History(h.spark, h.folder, (*h.changes, line))
