"""Near duplicates by SimHash fingerprints that differ in few bits.

Two fingerprints that differ in at most 3 bits differ in at most 3 of their 8 bytes, so they share
at least 5 positional bytes. Any 5 of 8 positions hold 3 within one half, so a pair that
reaches this minimum meets in at least one posting list of the inverted index, whose keys are
the bytes at 3 positions of one half (8 keys per fingerprint). Within a list the shared positional
bytes of each pair are tallied, pairs below the minimum are dropped and the rest verified bit by
bit. Postings hold distinct fingerprints, not documents: copies cost one entry.

A list is settled inside its task. One of up to 32 fingerprints gives its verified links; a
longer one only a spanning forest of them, which keeps the connected components without all the
pairs of a dense group. A list of more than 4,096 is dealt again by all
combinations of 5 positions, where only 3 bytes are left to differ: at most 2^24 fingerprints, found
by flipping every admissible set of bits and looking the result up, so a list of n costs n, not n².

Defined results. Null or word-free text: fingerprint zero, linked like any other. Null doc_id:
fingerprinted and linked; as a component's smallest id only if it has no other. Repeated rows stay.
Empty table: no rows. Further columns are ignored.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import stored
from tidemart.llm.components import components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
#: Fingerprints that one task compares pair by pair.
LIST_ROWS = 4096
#: Lists up to this length are compared many at a time.
SMALL_LIST = 32
_BREAK = re.compile(r"[\x20\x09-\x0D]+")
_ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def _words(text: str) -> list[str]:
    return [w for w in _BREAK.split(text.translate(_ASCII_LOWER)) if w]


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """A bit is 1 if it is set in over half the shingles' hashes."""
    words = _words(text or "")
    if not words:
        return 0
    if len(words) < shingle:
        grams = [" ".join(words)]
    else:
        grams = map(" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    hashes = np.array([xxhash.xxh64_intdigest(g, SEED) for g in grams], "<u8")
    ones = np.zeros(64, np.int64)
    for a in range(0, len(hashes), 1 << 14):
        ones += np.unpackbits(hashes[a : a + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and the fingerprint as a signed 64-bit integer."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], "<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints)], ["doc_id", "print"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(make, "doc_id long, print long")


def _keys(positions: list[tuple[int, ...]]):
    """Array of the index keys of a fingerprint: which positions, and their bytes."""
    out = []
    for n, chosen in enumerate(positions):
        mask = sum(0xFF << (8 * p) for p in chosen)
        signed = mask - (1 << 64) if mask >= 1 << 63 else mask
        out.append(F.struct(F.lit(n).alias("positions"), F.col("print").bitwiseAND(F.lit(signed)).alias("bytes")))
    return F.explode(F.array(*out)).alias("key")


def _halves() -> list[tuple[int, ...]]:
    return [c for half in ((0, 1, 2, 3), (4, 5, 6, 7)) for c in itertools.combinations(half, 3)]


def _tally(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Positional bytes that two fingerprints share."""
    return ((a ^ b)[..., None] >> (8 * np.arange(8, dtype=np.uint64)) & np.uint64(0xFF) == 0).sum(-1)


def _links_by_pairs(prints: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """For every fingerprint each earlier one it links to that no chain joins yet: a spanning
    forest of the list."""
    root = np.arange(len(prints))
    left, right = [], []
    for i in range(1, len(prints)):
        near = np.flatnonzero(np.bitwise_count(prints[:i] ^ prints[i]) <= max_bits + 8)
        near = near[_tally(prints[near], prints[i]) >= 8 - max_bits]
        near = near[np.bitwise_count(prints[near] ^ prints[i]) <= max_bits]
        if not len(near):
            continue
        roots, at = np.unique(root[near], return_index=True)
        left.append(np.full(len(at), prints[i]))
        right.append(prints[near[at]])
        if len(roots) > 1:
            root[np.isin(root, roots)] = roots[0]
        root[i] = roots[0]
    none = np.zeros(0, np.uint64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def _links_by_flips(prints: np.ndarray, free: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links between fingerprints that differ in the free bits only, by looking every admissible
    change up. One link per fingerprint and change, at most a fixed number each."""
    prints = np.sort(prints)
    for n in range(1, max_bits + 1):
        for bits in itertools.combinations(free.tolist(), n):
            flipped = prints ^ np.uint64(sum(1 << b for b in bits))
            at = np.searchsorted(prints, flipped)
            at[at == len(prints)] = 0
            hit = (prints[at] == flipped) & (flipped < prints)
            if hit.any():
                yield prints[hit], flipped[hit]


def _short_lists(prints: np.ndarray, groups: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links within many lists at once: each fingerprint against the next, the one after, ..."""
    for step in range(1, len(prints)):
        i = np.flatnonzero(groups[step:] == groups[:-step])
        if not len(i):
            break
        a, b = prints[i], prints[i + step]
        near = _tally(a, b) >= 8 - max_bits
        a, b = a[near], b[near]
        near = np.bitwise_count(a ^ b) <= max_bits
        if near.any():
            yield a[near], b[near]


def _settle(max_bits: int, positions: list[tuple[int, ...]], limit: int, last: bool):
    """Over a partition sorted by list: links (src, dst) of each list. A list longer than ``limit``
    goes out as it is (dst null) or, at the last level, is settled by look-ups."""

    def finish(batch: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        new = np.flatnonzero(np.any(batch[1:, :2] != batch[:-1, :2], axis=1)) + 1
        starts = np.concatenate([[0], new])
        sizes = np.diff(np.append(starts, len(batch)))
        group = np.repeat(np.arange(len(starts)), sizes)
        prints = batch[:, 2].view(np.uint64)
        small = np.repeat((sizes > 1) & (sizes <= SMALL_LIST), sizes)
        yield from _short_lists(prints[small], group[small], max_bits)
        for g in np.flatnonzero((sizes > SMALL_LIST) & (sizes <= limit)):
            yield _links_by_pairs(prints[starts[g] : starts[g] + sizes[g]], max_bits)
        for g in np.flatnonzero(sizes > limit):
            free = np.array([b for b in range(64) if b // 8 not in positions[int(batch[starts[g], 0])]])
            yield from _links_by_flips(prints[starts[g] : starts[g] + sizes[g]], free, max_bits)

    def rows(src: np.ndarray, dst: np.ndarray | None) -> pa.RecordBatch:
        other = pa.nulls(len(src), pa.int64()) if dst is None else pa.array(dst.view(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(src.view(np.int64)), other], ["src", "dst"])

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry, long = np.zeros((0, 3), np.int64), None
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                columns = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)]
                carry = np.ascontiguousarray(np.concatenate([carry, np.stack(columns, axis=1)]))
            if not len(carry):
                continue
            if long is not None:  # the list that is going out already
                own = np.all(carry[:, :2] == long, axis=1)
                if own.any():
                    yield rows(carry[own, 2], None)
                    carry = carry[~own]
                if not len(carry):
                    continue
                long = None
            end = len(carry)
            if batch is not None:  # the last list may go on in the next batch
                differs = np.flatnonzero(np.any(carry[:, :2] != carry[-1, :2], axis=1))
                end = int(differs[-1]) + 1 if len(differs) else 0
            done, carry = np.ascontiguousarray(carry[:end]), np.ascontiguousarray(carry[end:])
            if not last and len(done):
                _, at, sizes = np.unique(done[:, :2], axis=0, return_inverse=True, return_counts=True)
                over = sizes[at.reshape(-1)] > limit
                if over.any():
                    yield rows(np.ascontiguousarray(done[over, 2]), None)
                    done = np.ascontiguousarray(done[~over])
            if len(done):
                for src, dst in finish(done):
                    yield rows(src, dst)
            if not last and len(carry) > limit:
                long = carry[0, :2].copy()
                yield rows(np.ascontiguousarray(carry[:, 2]), None)
                carry = carry[:0]

    return settle


def _lists(prints: DataFrame, positions: list[tuple[int, ...]], settle) -> DataFrame:
    """Deal fingerprints to the posting lists of the index and settle each list."""
    keyed = prints.select("print", _keys(positions)).select("key.positions", "key.bytes", "print")
    dealt = keyed.repartition("positions", "bytes").sortWithinPartitions("positions", "bytes", "print")
    return dealt.mapInArrow(settle, "src long, dst long")


def links(prints: DataFrame, max_bits: int = MAX_BITS, list_rows: int = LIST_ROWS) -> DataFrame:
    """Links between distinct fingerprints ``prints(print)`` that keep every connected component."""
    if max_bits > 3:
        raise ValueError("the byte index guarantees five shared bytes for at most 3 differing bits")
    first = stored(_lists(prints, _halves(), _settle(max_bits, _halves(), list_rows, last=False)), "simhash-lists")
    found = first.where("dst IS NOT NULL")
    rest = first.where("dst IS NULL").select(F.col("src").alias("print")).distinct()
    if not rest.isEmpty():
        fives = list(itertools.combinations(range(8), 8 - max_bits))
        found = found.unionByName(_lists(rest, fives, _settle(max_bits, fives, list_rows, last=True)))
    return found.distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """Every document with its fingerprint (16 hex digits) and its component's smallest doc_id."""
    rows = stored(fingerprints(docs, shingle), "fingerprints")
    classes = rows.groupBy("print").agg(F.min("doc_id").alias("first"))
    edges = stored(links(classes.select("print"), max_bits), "simhash-links")
    joined = components(edges)  # node, root: only fingerprints that have links
    rooted = classes.join(joined, classes["print"] == joined["node"], "left")
    rooted = rooted.select("print", "first", F.coalesce("root", "print").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = rooted.join(smallest, "root").select("print", "component_id")
    return rows.join(labels, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
