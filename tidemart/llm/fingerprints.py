"""Document fingerprints by Order MinHash, in DataFrame functions alone.

A text's k-mers are runs of two words, numbered by occurrence, so that a repeated k-mer counts as
often as it stands there. Each of m permutations selects the l smallest, keeps them in the order of
the text and hashes the tuple. Two texts agree in an entry if the same k-mers are smallest in
the same order, so the share of equal entries falls with the edit distance, not only with the
difference of the sets.

A k-mer is a number: 39 bits of hash, then 24 of its position (later positions count as the last).
Sorted, equal k-mers stand together, and their occurrence numbers follow by doubling: with the
number known up to 2^p, one look 2^p places back gives it up to 2^(p+1).

Defined results. Null or blank text: no k-mers, every entry the hash of the empty tuple. Fewer words
than k: the whole sequence is one k-mer; fewer k-mers than l: shorter tuples. Null doc_id: after all
others. Repeated rows: each is a document; ties in doc_id are ordered by a hash of the text. A single document is
its own next. Empty table: no rows. Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemart.llm.common import stored

K = 2
TUPLE = 2
ENTRIES = 64
POSITION_BITS = 24
HASH_MASK = (1 << 39) - 1
POSITION_MASK = (1 << POSITION_BITS) - 1
#: Leading bits by which k-mers are parted, step by step, before the permutations look at them.
LEADING = (2, 4)


def permutation(n: int) -> int:
    """Bits of the hash that permutation ``n`` turns round. The hashes are random, so what is then
    smallest is a random k-mer, another one for every pattern of bits."""
    return ((n + 1) * 0x9E3779B97F4A7C15 >> 16) & HASH_MASK


def with_fingerprint(df: DataFrame, text: str, out: str, k: int = K, size: int = TUPLE, entries: int = ENTRIES) -> DataFrame:
    """``df`` with the fingerprint of column ``text``: an array of ``entries`` hashes."""
    at = POSITION_BITS
    kept = df.columns
    words = F.expr(f"filter(split(coalesce({text}, ''), '\\\\s+'), w -> w <> '')")
    df = df.withColumn("__w", words)
    parts = ", ".join(f"get(__w, i + {j})" for j in range(k))
    df = df.withColumn("__k", F.expr(
        f"CASE WHEN size(__w) = 0 THEN CAST(array() AS ARRAY<BIGINT>) ELSE sort_array(transform(sequence(0, greatest(size(__w) - {k}, 0)), "
        f"i -> shiftleft(xxhash64({parts}) & {HASH_MASK}L, {at}) | CAST(least(i, {POSITION_MASK}) AS BIGINT))) END"
    ))
    df = df.withColumn("__r0", F.expr(
        f"transform(__k, (x, j) -> CASE WHEN j > 0 AND shiftright(get(__k, j - 1), {at}) = shiftright(x, {at}) THEN 1 ELSE 0 END)"))
    df = df.withColumn("__v", F.expr(
        f"transform(array({_occurrences(0, '__r0')}), r -> transform(__k, (x, j) -> "
        f"shiftleft(xxhash64(shiftright(x, {at}), get(r, j)) & {HASH_MASK}L, {at}) | (x & {POSITION_MASK}L)))[0]"))
    # Below this bound eight k-mers are expected; if there are fewer than needed, all are sorted.
    df = df.withColumn("__bound", F.expr(f"CAST({(1 << 63) - 1}L DIV greatest(size(__v), 1) AS BIGINT)").cast("long"))
    df = df.withColumn("__bound", F.expr(f"CASE WHEN size(__v) <= {4 * size + 8} THEN {(1 << 63) - 1}L ELSE __bound * {4 * size} END"))
    # A k-mer below the bound then begins with the permutation's own leading bits, unless the bound is
    # above all of those: only k-mers that begin so are looked at for it.
    above, known = "__v", 0
    for bits in LEADING:
        for g in range(1 << bits):
            of = above if not known else f"{above}{g >> bits - known}"
            df = df.withColumn(f"__g{bits}_{g}", F.expr(
                f"CASE WHEN __bound <= {1 << 63 - bits}L THEN filter({of}, x -> shiftright(x, {63 - bits}) = {g}) ELSE {of} END"))
        above, known = f"__g{bits}_", bits
    tuples = []
    for n in range(entries):
        near = f"filter({above}{permutation(n) >> 39 - known}, x -> (x ^ {permutation(n) << at}L) < __bound)"
        least = f"slice(sort_array(transform(CASE WHEN size(c) >= {size} THEN c ELSE __v END, x -> x ^ {permutation(n) << at}L)), 1, {size})"
        # The smallest, turned to (position, hash) and so into text order.
        tuples.append(
            f"transform(array({near}), c -> xxhash64(transform(sort_array(transform({least}, "
            f"x -> shiftleft(x & {POSITION_MASK}L, 39) | shiftright(x, {at}))), x -> x & {HASH_MASK}L)))[0]")
    return df.select(*kept, F.expr(f"array({', '.join(tuples)})").alias(out))


def _occurrences(p: int, known: str) -> str:
    """SQL for the occurrence numbers (from 0) of sorted k-mers, where ``known`` has them up to 2^p;
    goes on only as far as the text needs."""
    if p == POSITION_BITS:
        return known
    step = f"transform({known}, (x, j) -> CASE WHEN x = {1 << p} THEN x + get({known}, j - {1 << p}) ELSE x END)"
    return (
        f"CASE WHEN coalesce(array_max({known}), 0) < {1 << p} THEN {known} "
        f"ELSE transform(array({step}), r{p + 1} -> {_occurrences(p + 1, f'r{p + 1}')})[0] END"
    )


def likeness(a: str, b: str, entries: int = ENTRIES):
    """Share of equal entries of two fingerprint columns."""
    return F.expr(f"size(filter(sequence(0, {entries - 1}), i -> get({a}, i) = get({b}, i))) / CAST({entries} AS DOUBLE)")


def as_text(column: str):
    return F.expr(f"array_join(transform({column}, x -> lower(lpad(hex(x), 16, '0'))), '')")


def next_keys(rows: DataFrame) -> DataFrame:
    """(key, n, n_chars, next_key) of every distinct (doc_id, text) in ``rows(key, doc_id, text)``: how many
    rows it has, and the one that follows it in descending order of doc_id, after the last the first.

    Only keys and ids are put in order, in ranges that hold about equally many whatever the ids are; a
    range's last key takes the first of the next range, and only those meet in one task.
    """
    keys = rows.groupBy("key").agg(
        F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n"), F.min(F.char_length("text")).cast("long").alias("n_chars"))
    order = [F.desc_nulls_last("doc_id"), F.asc("key")]
    ranges = keys.repartitionByRange(*order).withColumn("block", F.spark_partition_id())
    ranges = stored(ranges, "fingerprint-order")  # a range's number is a fact from here on
    inside = W.partitionBy("block").orderBy(*order)
    led = ranges.withColumn("next_key", F.lead("key").over(inside))
    firsts = ranges.groupBy("block").agg(F.min_by("key", F.struct(
        F.isnull("doc_id"), -F.coalesce(F.col("doc_id"), F.lit(0)).cast("decimal(20,0)"), "key")).alias("first"))
    by_block = W.orderBy("block")  # one row a range
    turn = F.coalesce(F.lead("first").over(by_block), F.first("first").over(by_block.rowsBetween(W.unboundedPreceding, 0)))
    following = firsts.select("block", turn.alias("beyond"))
    return led.join(F.broadcast(following), "block").select("key", "n", "n_chars", F.coalesce("next_key", "beyond").alias("next_key"))


def with_next(rows: DataFrame) -> DataFrame:
    """``rows(doc_id, text, print)`` with ``next_text`` (as many of the next row's first characters as a third of the
    text has) and ``next_print``. Texts are moved once, to where both lookups by key read them."""
    key = F.xxhash64(F.isnull("doc_id"), F.coalesce("doc_id", F.lit(0)), "text")
    links = next_keys(rows.select(key.alias("key"), "doc_id", "text"))
    base = rows.select(key.alias("key"), "doc_id", "text", "print").repartition("key")
    # Ordered by doc_id, which a key has one of: both readers then need every column, and share one shuffle.
    numbered = base.withColumn("copy", F.row_number().over(W.partitionBy("key").orderBy("doc_id")))
    found = numbered.where("copy = 1").select(F.col("key").alias("next_key"), F.col("text").alias("t"), F.col("print").alias("next_print"))
    answers = links.join(found, "next_key").select(
        "key", "n", F.expr("substring(t, 1, CAST(n_chars DIV 3 AS INT))").alias("beginning"), "next_print")
    # Rows that are alike follow each other; only the last of them meets another text.
    last = F.col("copy") == F.col("n")
    third = F.expr("substring(text, 1, CAST(char_length(text) DIV 3 AS INT))")
    return numbered.join(answers, "key").select(
        "doc_id", "text", "print", F.when(last, F.col("beginning")).otherwise(third).alias("next_text"),
        F.when(last, F.col("next_print")).otherwise(F.col("print")).alias("next_print"))


def edited_likeness(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint and that of its edited text (the last third replaced by the
    next document's first characters), with the likenesses to the edited and to the next text."""
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(with_fingerprint(rows, "text", "print"))
    rows = rows.withColumn("n_chars", F.char_length("text").cast("long"))
    rows = rows.withColumn("edited", F.expr(
        "concat(substring(text, 1, CAST(n_chars - n_chars DIV 3 AS INT)), next_text)"))
    rows = with_fingerprint(rows.select("doc_id", "n_chars", "edited", "print", "next_print"), "edited", "edited_print")
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_text("print").alias("fingerprint"),
        as_text("edited_print").alias("edited_fingerprint"), likeness("print", "edited_print").alias("near_edited"),
        likeness("print", "next_print").alias("near_next"),
    )
