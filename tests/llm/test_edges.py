"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tidemart.llm import (
    contamination, fingerprints, language, licenses, packing, sharding, simhash, substrings, toxicity, wavelet,
)

BYTE, WORD = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "bits string, shard string, print long, text_key string, term string, `dotted.name` int, w string, cut_id int, start int"
)
PASSAGE = " ".join(f"passage{i}" for i in range(60))
ROWS = [
    (1, "The quick brown fox. Released under the MIT License.", "en", "a"),
    (2, None, "en", None),
    (3, "", None, "a"),
    (4, " \n\t ", "fr", "a"),
    (5, "one", "en", "a"),
    (6, "one", "en", "a"),
    (6, "one", "en", "a"),
    (7, "word " * 30_000 + "end", "en", "a"),
    (8, "x" * 60_000, "en", "a"),
    (9, "a\x00b <|endoftext|>   ümlaut ẞ 漢字 🙂 \x1c end", None, "a"),
    (10, "before " + PASSAGE + " after", "en", "a"),
    (11, "other " + PASSAGE + " tail", "en", "a"),
    (None, "null id " + PASSAGE, "en", "a"),
    (-5, "negative id", None, None),
    (None, None, None, None),
    (12, "!!! ??? 123", "en", "a"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, None, "0", "s", 1, "k", "t", 2, "w", 3, 4) for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(
        [(1, PASSAGE), (2, None), (3, ""), (4, "negative id"), (None, "quick brown"), (4, "negative id")], "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (5, 1, 1), (6, 0, None), (99, 1, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")


def pairs(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def ids(docs):
    return sorted((r.doc_id for r in docs.select("doc_id").collect()), key=repr)


def test_every_operator_takes_an_empty_table(spark, nothing, items, labels):
    assert licenses.licenses(nothing, licenses.templates(spark)).count() == 0
    assert substrings.passages(nothing).count() == 0
    assert substrings.cut(nothing, substrings.passages(nothing)).count() == 0
    assert sharding.assign(nothing).count() == 0
    assert wavelet.token_index(nothing, BYTE).count() == 0
    assert simhash.near_duplicates(nothing).count() == 0
    assert fingerprints.edited_likeness(nothing).count() == 0
    assert language.identify(nothing).count() == 0
    assert language.keep_identified(nothing).count() == 0
    assert contamination.contamination(nothing, items).count() == 0
    assert contamination.clean(nothing, items).count() == 0
    assert packing.pack(nothing, WORD).count() == 0
    assert toxicity.toxicity(nothing, labels).count() == 0


def test_empty_side_tables(spark, docs, items, labels):
    assert licenses.licenses(docs, licenses.templates(spark).limit(0)).count() == 0
    got = contamination.contamination(docs, items.limit(0))
    assert got.where("contaminated").count() == 0 and ids(got) == ids(docs)
    assert {r.score for r in toxicity.toxicity(docs, labels.limit(0)).collect()} == {0.0}


def test_licenses(spark, docs):
    assert pairs(licenses.licenses(docs, licenses.templates(spark)), "doc_id", "license", "n_notices") == [(1, "MIT", 1)]


def test_passages(docs):
    got = pairs(substrings.passages(docs), "doc_id", "start", "end", "source_id")
    assert (11, 1, 61, 10) in got and {r[0] for r in got} <= {11}
    left = {r.doc_id: r.text for r in substrings.cut(docs, substrings.passages(docs)).collect() if r.doc_id}
    assert left[11].split() == ["other", "tail"] and left[10].split()[0] == "before" and len(left) == 13
    assert substrings.cut(docs, substrings.passages(docs)).columns == docs.columns


def test_a_document_that_is_one_passage_goes(spark):
    docs = spark.createDataFrame([(1, PASSAGE), (2, PASSAGE), (3, PASSAGE + " and more")], "doc_id long, text string")
    left = pairs(substrings.cut(docs, substrings.passages(docs)), "doc_id", "text")
    assert [(i, t.strip()) for i, t in left] == [(1, PASSAGE), (3, "and more")]


def test_shards(docs):
    got = sharding.assign(docs, limit=70_000).collect()
    assert len(got) == len(ROWS)
    sizes = {}
    for r in got:
        assert r.n_bytes == len((r.doc.text or "").encode())
        sizes[r.shard] = sizes.get(r.shard, 0) + r.n_bytes
    for r in got:
        assert sizes[r.shard] == r.shard_bytes and (r.shard_bytes <= 70_000) != r.oversized
    assert {r.doc.doc_id for r in got if r.oversized} == {7}
    assert any(r.shard != "root" for r in got)


def test_equal_hashes_split_by_place(spark):
    docs = spark.createDataFrame([(1, "x" * 10)] * 20, "doc_id long, text string")
    got = sharding.assign(docs, limit=40).collect()
    assert len(got) == 20 and all(r.shard_bytes <= 40 and not r.oversized for r in got)


def test_wavelet_shards(docs):
    tokenizer = Tokenizer.from_file(BYTE)
    got = wavelet.token_index(docs, BYTE).orderBy("start").collect()
    texts = sorted(((r[0], r[1]) for r in ROWS), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start = 0
    for r, (doc_id, text) in zip(got, texts, strict=True):
        own = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc_id, start, len(own), zlib.crc32(own.tobytes()))
        start += len(own)


def test_simhash(docs):
    got = {(r.doc_id, r.component_id): r.fingerprint for r in simhash.near_duplicates(docs).collect()}
    assert got[6, 5] == got[5, 5]
    assert {k for k, v in got.items() if v == "0" * 16} == {(2, 2), (3, 2), (4, 2), (None, 2)}
    assert simhash.near_duplicates(docs).count() == len(ROWS)


def test_fingerprints(docs):
    got = fingerprints.edited_likeness(docs).collect()
    assert ids(fingerprints.edited_likeness(docs)) == ids(docs)
    same = {r.fingerprint for r in got if r.doc_id in (5, 6)}
    assert len(same) == 1
    assert {r.n_chars for r in got if r.doc_id in (2, 3)} == {0}
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    alone = fingerprints.edited_likeness(docs.where("doc_id = 1")).first()
    assert alone.near_next == 1.0


def test_language(docs):
    got = language.identify(docs).collect()
    assert len(got) == len(ROWS)
    assert {r.lang_pred for r in got if r.doc_id in (2, 3, 4, 12)} == {"und"}
    assert all(r.rejected for r in got if r.lang_pred == "und")
    kept = language.keep_identified(docs)
    assert kept.columns == docs.columns and 2 not in ids(kept) and 10 in ids(kept)


def test_nothing_to_learn_from(docs):
    got = language.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in got} == {"und"}


def test_contamination(docs, items):
    got = {r.doc_id: r for r in contamination.contamination(docs, items).collect()}
    assert contamination.contamination(docs, items).count() == len(ROWS)
    assert (got[10].n_hit, got[10].n_items, got[-5].n_hit, got[-5].n_items, got[1].n_hit) == (60, 1, 2, 1, 2)
    assert got[2].n_words == 0 and not got[2].contaminated and got[7].n_words == 30_001
    kept = contamination.clean(docs, items)
    assert kept.columns == docs.columns and set(ids(kept)) == {2, 3, 4, 5, 6, 7, 8, 9, 12, None}
    assert ids(kept).count(6) == 2 and ids(kept).count(None) == 1


def test_proximity(spark):
    docs = spark.createDataFrame([
        (1, "zero one two three four five six seven eight nine ten"), (2, "ten nine extra eight seven six five four three two one"),
        (3, "one far " + "away " * 40 + "two three four five six seven eight nine ten"), (4, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id long, text string")
    found = contamination.windows(items)
    index = contamination.build_index(docs, found.select(F.explode("words").alias("term")))
    near = {r.doc_id for r in contamination.proximity_hits(docs, index, found).collect()}
    exact = {r.doc_id for r in contamination.exact_hits(docs, index, found).collect()}
    assert exact == {1} and {1, 2} <= near and 3 not in {r.doc_id for r in contamination.proximity_hits(
        docs, index, found, share=1.0).collect()}


def test_packing(docs):
    rows = packing.pack(docs, WORD).collect()
    tokenizer = Tokenizer.from_file(WORD)
    want = []
    for r in ROWS:
        own = np.array([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 0], "<u4")
        want += [(r[0], n, a, len(own[a : a + 2048]), zlib.crc32(own[a : a + 2048].tobytes())) for n, a in enumerate(range(0, len(own), 2048))]
    key = lambda r: repr(r)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=key) == sorted(want, key=key)
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048


def test_toxicity(docs, labels):
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)


def test_pipeline_stages_take_odd_rows(spark, sf_dir, docs, nothing):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).columns == docs.columns
        assert stage(spark, nothing, sf_dir).count() == 0
    assert corpus_pipeline.pack_sequences(spark, nothing, sf_dir).count() == 0
    left = ids(corpus_pipeline.drop_near_duplicates(spark, docs, sf_dir))
    # 3, 4 and 6 are copies of 2 and 5; rows without an id stay, both of them.
    assert left == sorted([1, 2, 5, 7, 8, 9, 10, 11, -5, 12, None, None], key=repr)
