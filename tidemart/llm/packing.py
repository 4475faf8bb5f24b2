"""Packing documents into as few sequences as possible.

The lengths' histogram (at most one entry per length up to the capacity, whatever the data) is
all the driver sees. Over it a configuration linear program is solved: a configuration is a
multiset of lengths that fits one sequence, its variable says how many sequences use it, and
every length has to be covered. Multiplicative weights price the lengths (a length weighs less
the better it is covered), a knapsack dynamic program finds the best configuration at these
prices, and the solution is rounded down; what rounding leaves goes best fit, longest first, into
open or new sequences, again on the histogram. Pieces then take their places by their rank among the pieces of their length.

Defined results. Null text: empty, so the end id alone. Null doc_id: kept. Repeated rows: each is
a document. Empty table: no rows. Further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemart.llm.common import stored, width
from tidemart.llm.encoding import encoder

CAPACITY = 2048
END_ID = 0
#: Rounds of multiplicative weights; more rounds leave less to the rounding.
ROUNDS = 200
#: Share of what a length still lacks that one round may cover.
STEP = 0.5
#: Shares of the program's solution that are tried.
SCALES = (1, 0.75, 0.5, 0.25, 0.125, 0)
#: How fast a covered length loses weight.
LEARNING_RATE = 2.0

Pattern = tuple[tuple[int, int], ...]  # (length, copies), longest first


def best_configuration(lengths: np.ndarray, values: np.ndarray, capacity: int) -> list[int]:
    """Knapsack by dynamic programming: the set of entries of highest value that fits. A length that
    may come up more than once has several entries."""
    best = np.zeros(capacity + 1)
    taken = np.zeros((len(lengths), capacity + 1), bool)
    for i, (length, value) in enumerate(zip(lengths.tolist(), values.tolist(), strict=True)):
        with_it = best[: capacity + 1 - length] + value
        better = with_it > best[length:]
        taken[i, length:] = better
        np.copyto(best[length:], with_it, where=better)
    found, room = [], capacity
    for i in range(len(lengths) - 1, -1, -1):
        if taken[i, room]:
            found.append(i)
            room -= int(lengths[i])
    return found


def multiples(most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries and copies that make every number of copies up to ``most`` of each length: 1, 2, 4 and
    so on, then what is left."""
    entries, copies, size = [], [], 1
    left = most.copy()
    while left.any():
        at = np.flatnonzero(left)
        take = np.minimum(left[at], size)
        entries.append(at)
        copies.append(take)
        left[at] -= take
        size *= 2
    return (np.concatenate(entries), np.concatenate(copies)) if entries else (np.zeros(0, np.int64),) * 2


def configuration_program(counts: dict[int, int], capacity: int, rounds: int = ROUNDS) -> dict[Pattern, float]:
    """Approximate solution of the configuration linear program: sequences per configuration,
    never covering a length more than it asks for.

    The weights start between two bounds on a length's share of a sequence (its tokens, and one
    over how often it fits) and fall with the length's coverage."""
    lengths = np.array(sorted(counts))
    wanted = np.array([counts[int(x)] for x in lengths], float)
    start = (lengths / capacity + 1 / (capacity // lengths)) / 2
    covered = np.zeros(len(lengths))
    use: dict[Pattern, float] = {}
    for _ in range(rounds):
        left = wanted - covered
        entries, copies = multiples(np.minimum(left, capacity // lengths).astype(np.int64))
        if not len(entries):
            break
        price = start * np.exp(-LEARNING_RATE * covered / wanted)
        chosen: Counter = Counter()
        for i in best_configuration(lengths[entries] * copies, price[entries] * copies, capacity):
            chosen[int(entries[i])] += int(copies[i])
        room = min(left[i] / n for i, n in chosen.items())
        step = max(1.0, STEP * room)
        pattern = tuple(sorted(((int(lengths[i]), n) for i, n in chosen.items()), reverse=True))
        use[pattern] = use.get(pattern, 0.0) + step
        for i, n in chosen.items():
            covered[i] += step * n
    return use


def best_fit(counts: dict[int, int], capacity: int, begun: dict[Pattern, int] | None = None) -> dict[Pattern, int]:
    """Best fit, longest first, over a histogram: equal sequences are handled as one group, so
    the work depends on the number of lengths, not of pieces. ``begun``: sequences to go on with."""
    by_room: dict[int, Counter] = {}
    rooms = np.zeros(capacity + 1, np.int64)  # groups that have this room left
    for pattern, k in (begun or {}).items():
        room = capacity - sum(length * copies for length, copies in pattern)
        by_room.setdefault(room, Counter())[pattern] += k
        rooms[room] = len(by_room[room])
    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n > 0:
            open_ = np.flatnonzero(rooms[length:])
            if not len(open_):
                each = capacity // length  # new sequences, each as full of this length as it gets
                for copies in (each, n % each):
                    k = n // each if copies == each else 1
                    if copies and k:
                        by_room.setdefault(capacity - copies * length, Counter())[((length, copies),)] += k
                        n -= k * copies
                        rooms[capacity - copies * length] = len(by_room[capacity - copies * length])
                    if n <= 0:
                        break
                continue
            room = int(open_[0]) + length
            group = by_room[room]
            pattern, have = next(iter(group.items()))
            copies = min(room // length, n)
            k = min(have, n // copies)
            group[pattern] -= k
            if not group[pattern]:
                del group[pattern]
            rooms[room] = len(group)
            after = by_room.setdefault(room - copies * length, Counter())
            after[(*pattern, (length, copies))] += k
            rooms[room - copies * length] = len(after)
            n -= k * copies
    out: Counter = Counter()
    for group in by_room.values():
        out.update(group)
    return dict(out)


def plan_sequences(counts: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> dict[Pattern, int]:
    """Whole numbers of sequences per configuration that hold every piece exactly once. The
    program's solution is rounded down at several scales; the one that ends with the fewest
    sequences is kept."""
    solution = configuration_program(counts, capacity, rounds)
    plans = []
    for scale in SCALES:
        rest, plan = Counter(counts), {}
        for pattern, n in solution.items():
            k = int(n * scale + 1e-9)
            if k:
                plan[pattern] = k
                rest.subtract({length: k * copies for length, copies in pattern})
        plans.append(best_fit({x: n for x, n in rest.items() if n > 0}, capacity, plan))
    return min(plans, key=lambda p: sum(p.values()))


def slots(plan: dict[Pattern, int]) -> pd.DataFrame:
    """One row per configuration and length: the ranks it takes and where they lie. Their number
    follows from the lengths and rounds, not from the data's size."""
    rows, taken, sequence = [], Counter(), 0
    for pattern, n in plan.items():
        offset = 0
        for length, copies in pattern:
            rows.append((length, taken[length], copies, sequence, offset))
            taken[length] += copies * n
            offset += copies * length
        sequence += n
    return pd.DataFrame(rows, columns=["length", "first", "copies", "sequence", "offset"])


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Encode whole texts and cut those beyond the capacity: doc_id, piece, start, length,
    ids_crc32 and, on demand, the ids (little-endian unsigned 32-bit)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(tokenizer, joined=False), np.array([end_id], "<u4")
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.concatenate([enc.encode([text.as_py()])[0], end])
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    raw = ids[start : start + capacity].tobytes()
                    rows.append((doc_id, piece, start, len(raw) // 4, zlib.crc32(raw), raw if with_ids else None))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "ids"],
            )

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
    out = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, schema)
    return out if with_ids else out.drop("ids")


def ranked(rows: DataFrame) -> DataFrame:
    """Number the pieces of each length from 0. A length that a third of all pieces have is
    numbered in many groups at once: by hash within the length, then the groups' sizes are added."""
    groups = width(rows.sparkSession)
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))
    sizes = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("size"))
    before = F.sum("size").over(W.partitionBy("length").orderBy("salt").rowsBetween(W.unboundedPreceding, -1))
    sizes = sizes.select("length", "salt", F.coalesce(before, F.lit(0)).alias("before"))
    within = F.row_number().over(W.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32"))
    return (
        salted.withColumn("within", within)
        .join(sizes, ["length", "salt"])
        .withColumn("rank", F.col("before") + F.col("within") - 1)
        .drop("salt", "within", "before")
    )


def place(rows: DataFrame, plan: dict[Pattern, int]) -> DataFrame:
    """Give every ranked piece its sequence and its offset there."""
    table = slots(plan).sort_values(["length", "first"])
    base, names = 1 << 44, [c for c in rows.columns if c != "rank"]
    keys = table["length"].to_numpy(np.int64) * base + table["first"].to_numpy(np.int64)
    take = {c: table[c].to_numpy(np.int64) for c in ("first", "copies", "sequence", "offset")}

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            i = np.searchsorted(keys, length * base + rank, side="right") - 1
            nth = rank - take["first"][i]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names]
                + [pa.array(take["sequence"][i] + nth // take["copies"][i]),
                   pa.array(take["offset"][i] + nth % take["copies"][i] * length)],
                [*names, "sequence_id", "offset"],
            )

    kinds = dict(rows.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in names) + ", sequence_id long, offset long"
    return rows.mapInArrow(settle, schema)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pack all documents: one row per piece with its sequence and offset."""
    rows = stored(pieces(docs, tokenizer, capacity, end_id, with_ids), "pieces")
    histogram = rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # a row per length up to the capacity
    return place(ranked(rows), plan_sequences({r.length: r.n for r in histogram}, capacity))
