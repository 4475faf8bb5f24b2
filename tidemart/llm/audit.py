"""What filters do to each other: every order of five filters over all documents.

Which filters a document fails is a mask of five bits, so a part of the corpus (its documents of
one language) has at most 32 cells (mask, documents, good ones, toxic ones). Only cells meet the
orders: for each cell ``transform`` goes over the array of all 120 orders, ``aggregate`` folds the five steps
of an order with the state (still there, steps so far), and the cell becomes 600 structs weighted by its
documents. The cells of a part are then summed element by element.

The order array is a constant of the plan, as every task needs it; nothing is joined to it. Copies are
counted by text hash, language, labels and mask first, so that a text with very many copies is a
few rows when its smallest doc_id is looked for.

Defined results: a null text is an empty one, a null language the empty string; an empty table has no
parts and gives no rows. Repeated rows are documents of their own; rows that share the smallest doc_id of
a text are all first. A row without doc_id has no labels, is no copy and makes none. A document with
several label rows is good (toxic) if one of them says 1. Texts are read whole. Columns other than
doc_id, text and lang (doc_id, quality and toxic of labels) are not looked at.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"

#: All orders of the filters, as texts and as one array of arrays of bit numbers.
ORDERS = tuple("".join(p) for p in permutations(FILTERS))
_ORDER_NAMES = f"array({', '.join(repr(o) for o in ORDERS)})"
_ORDER_ARRAY = f"array({', '.join('array(' + ', '.join(str(FILTERS.index(f)) for f in o) + ')' for o in ORDERS)})"

COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
_STEP = "struct<bit: int, " + ", ".join(f"{c}: bigint" for c in COUNTS) + ">"

#: Steps of one cell over all orders. ``there``: no filter before has removed the cell.
_CELL_STEPS = f"""
flatten(transform({_ORDER_ARRAY}, filter_order -> aggregate(
  filter_order,
  named_struct('there', true, 'steps', cast(array() as array<{_STEP}>)),
  (state, f) -> named_struct(
    'there', state.there AND getbit(mask, f) = 0,
    'steps', concat(state.steps, array(named_struct(
      'bit', f,
      'kept', if(state.there AND getbit(mask, f) = 0, n, 0L),
      'removed', if(state.there AND getbit(mask, f) = 1, n, 0L),
      'redundant', if(NOT state.there AND getbit(mask, f) = 1, n, 0L),
      'unique_fails', if(mask = shiftleft(1, f), n, 0L),
      'good_lost', if(state.there AND getbit(mask, f) = 1, good, 0L),
      'toxic_lost', if(state.there AND getbit(mask, f) = 1, toxic, 0L))))),
  state -> state.steps)))"""

#: The cells of a part, added element by element.
_SUMS = f"""
aggregate(cells, transform(slice(cells, 1, 1)[0], s -> named_struct('bit', s.bit, {', '.join(f"'{c}', 0L" for c in COUNTS)})),
  (sums, cell) -> zip_with(sums, cell, (a, b) -> named_struct(
    'bit', a.bit, {', '.join(f"'{c}', a.{c} + b.{c}" for c in COUNTS)})))"""

_SHAPLEY = f"transform(sequence(0, {len(FILTERS) - 1}), f -> aggregate(sums, 0L, (total, s) -> total + if(s.bit = f, s.removed, 0L)))"


def masks(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask, digest): filters A to D that each document fails, and its text's hash."""
    plain = docs.select(F.col("doc_id"), F.coalesce("lang", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    split = plain.select("*", words.alias("words"))
    counted = split.select(
        "doc_id", "part", "text", F.size("words").cast("long").alias("n"), F.size(F.array_distinct("words")).cast("long").alias("d"),
        F.length("text").cast("long").alias("chars"),
        (F.length("text") - F.length(F.regexp_replace("text", "[A-Z]+", ""))).cast("long").alias("capitals"))
    fails = (F.col("n") < 100, 100 * F.col("d") < 80 * F.col("n"), 100 * F.col("capitals") > 10 * F.col("chars"),
             F.col("text").rlike(r"[#$%&*|]"))
    mask = sum((F.when(f, 1 << bit).otherwise(0) for bit, f in enumerate(fails)), F.lit(0))
    return counted.select("doc_id", "part", mask.cast("int").alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest"))


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents by part and filters failed, E among them."""
    one = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)))
    marks = labels.groupBy("doc_id").agg(one("quality").alias("good"), one("toxic").alias("toxic")).where("doc_id IS NOT NULL")
    d, m = masks(docs).alias("d"), marks.alias("m")
    marked = d.join(m, F.col("d.doc_id") == F.col("m.doc_id"), "left").select(
        "d.*", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))
    kind = ["digest", "part", "mask", "good", "toxic"]
    rows = marked.groupBy(*kind, "doc_id").agg(F.count(F.lit(1)).alias("n"))
    known = F.col("doc_id").isNotNull()
    groups = rows.groupBy(*kind).agg(
        F.sum("n").alias("n"), F.sum(F.when(known, F.col("n")).otherwise(0)).alias("known"),
        F.min(F.when(known, F.struct("doc_id", "n"))).alias("first"))
    first = F.col("first.doc_id") == F.min("first.doc_id").over(Window.partitionBy("digest"))
    copies = F.col("known") - F.when(first, F.col("first.n")).otherwise(0)
    both = groups.select("part", "mask", "good", "toxic", "n", copies.alias("copies")).select(
        "part", "good", "toxic", F.explode(F.array(
            F.struct(F.col("mask"), (F.col("n") - F.col("copies")).alias("n")),
            F.struct(F.col("mask").bitwiseOR(1 << FILTERS.index("E")).alias("mask"), F.col("copies").alias("n")))).alias("cell"))
    count = lambda flag: F.sum(F.when(F.col(flag), F.col("cell.n")).otherwise(0))
    return both.where("cell.n > 0").groupBy("part", F.col("cell.mask").alias("mask")).agg(
        F.sum("cell.n").alias("n"), count("good").alias("good"), count("toxic").alias("toxic"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order and step: what its filter does there. ``shapley`` is what the filter
    removes over all orders together."""
    steps = cells(docs, labels).select("part", F.expr(_CELL_STEPS).alias("steps"))
    sums = steps.groupBy("part").agg(F.collect_list("steps").alias("cells")).select("part", F.expr(_SUMS).alias("sums"))
    folded = sums.select("part", "sums", F.expr(_SHAPLEY).alias("shapley"))
    each = folded.select("part", "shapley", F.posexplode("sums").alias("at", "s"))
    width = len(FILTERS)
    return each.select(
        "part", F.expr(f"{_ORDER_NAMES}[at div {width}]").alias("filter_order"), (F.col("at") % width + 1).cast("int").alias("step"),
        *[F.col(f"s.{c}").alias(c) for c in COUNTS], F.col("shapley")[F.col("s.bit")].alias("shapley"))
