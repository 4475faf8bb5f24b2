"""Operators against brute-force versions, round trips and held-out accuracy."""

import glob
import hashlib
import itertools
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tidemart.llm import (
    components, encoding, fingerprints, language, licenses, packing, sharding, simhash, substrings, toxicity, wavelet,
)
from tidemart.llm.queries import QUERIES, SHARDING_SQL

BYTE, WORD = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


# Tokens

AWKWARD = [
    "a  b", "a   b", " b", "b ", "a\n\nb", "a \nb", "a\n b", "a \n\n b", "x<|endoftext|>y z", "a\n \nb", "don't's, x.y,z!? 'll",
    "\x1ca\x1cb", "é́ a b c", "a\x00b c", "", "\n", "\n\na", "3.14, 2,000", "word., \"q\".", "q\x01 w \x01", "\t a", "ﬃ½²³.",
    "a\r\nb", "x\n", " \n ", "ÀÉ ß ſ İ", "漢字 かな", "🙂 🙂🙂", " x y", "a.b.c!",
]


@pytest.mark.parametrize("path, joined", [(BYTE, True), (WORD, False)])
def test_memoised_ids_are_the_tokenizers(texts, path, joined):
    enc, tokenizer = encoding.Encoder(path, joined), Tokenizer.from_file(path)
    for text in [*AWKWARD, *texts.values()]:
        assert enc.encode([text])[0].tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids, text


def test_a_full_memo_starts_afresh(texts, monkeypatch):
    monkeypatch.setattr(encoding, "MEMO_CHUNKS", 50)
    enc, tokenizer = encoding.Encoder(BYTE, True), Tokenizer.from_file(BYTE)
    for text in list(texts.values())[:20]:
        assert enc.encode([text])[0].tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids


def test_wavelet_query_round_trip(spark, sf_dir, texts):
    tokenizer, start = Tokenizer.from_file(BYTE), 0
    for r in QUERIES["op4_wavelet_shards"](spark, sf_dir).orderBy("doc_id").collect():
        own = np.array([*tokenizer.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 2], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(own), zlib.crc32(own.tobytes()))
        start += len(own)


def test_wavelet_matrix():
    rng = np.random.default_rng(1)
    for n, bits in ((0, 4), (1, 1), (5000, 6), (3000, 17)):
        ids = rng.integers(0, 1 << bits, n)
        m = wavelet.WaveletMatrix.build(ids, bits)
        assert (m.decode() == ids).all()
        if n:
            at = rng.integers(0, n, 50)
            assert (m.access(at) == ids[at]).all()
        for token in {*ids[:5].tolist(), 0, (1 << bits) - 1, 1 << bits}:
            where = np.flatnonzero(ids == token)
            assert m.select(token).tolist() == where.tolist()
            a, b = n // 4, n // 2
            assert m.count(token, a, b) == ((where >= a) & (where < b)).sum()
            assert m.select(token, a, b).tolist() == [i for i in where if a <= i < b]


def test_token_occurrences(spark, docs, texts, tmp_path):
    path = str(tmp_path / "shards")
    wavelet.write_shards(docs, BYTE, path, shard_tokens=5000)
    tokenizer = Tokenizer.from_file(BYTE)
    want = {(t, i, p) for i, text in texts.items() for p, t in enumerate(tokenizer.encode(text, add_special_tokens=False).ids) if t in (13, 262)}
    got = {tuple(r) for r in wavelet.occurrences(spark, path, [13, 262]).collect()}
    assert got == want


# Packing


def test_packing_is_valid_and_close_to_the_bound():
    rng = np.random.default_rng(2)
    for lengths in (rng.integers(1, 2049, 3000), np.full(500, 2048), np.array([1]), rng.integers(700, 1100, 400)):
        counts = Counter(lengths.tolist())
        plan = packing.plan_sequences(dict(counts))
        held = Counter()
        for pattern, n in plan.items():
            assert n > 0 and sum(x * k for x, k in pattern) <= 2048
            for x, k in pattern:
                held[x] += k * n
        assert held == counts
        bound = max(-(-int(lengths.sum()) // 2048), int((lengths > 1024).sum()))
        assert sum(plan.values()) <= max(sum(packing.best_fit(dict(counts), 2048).values()), bound) * 1.01 + 1


@pytest.mark.parametrize("counts", [{1: 100_000}, {100: 100_000}, {3: 50_000, 7: 40_000}, {1: 70_000, 5: 20_000, 90: 9_000, 1000: 10}])
def test_short_lengths_are_packed_tight(counts):
    plan, held = packing.plan_sequences(dict(counts)), Counter()
    for pattern, n in plan.items():
        assert n > 0 and sum(x * k for x, k in pattern) <= 2048
        for x, k in pattern:
            held[x] += k * n
    assert held == counts
    if len(counts) == 1:
        (x, n), = counts.items()
        assert sum(plan.values()) == -(-n // (2048 // x))
    assert sum(plan.values()) <= -(-sum(x * n for x, n in counts.items()) // 2048) * (1.03 if 100 in counts else 1.005) + 1


def test_knapsack_matches_brute_force():
    rng = random.Random(3)
    for _ in range(30):
        lengths, values = [rng.randint(1, 20) for _ in range(8)], [rng.random() for _ in range(8)]
        chosen = packing.best_configuration(np.array(lengths), np.array(values), 30)
        best = max(sum(values[i] for i in s) for n in range(9) for s in itertools.combinations(range(8), n) if sum(lengths[i] for i in s) <= 30)
        assert sum(lengths[i] for i in chosen) <= 30 and abs(sum(values[i] for i in chosen) - best) < 1e-9


# Sharding


def test_small_shards_match_sql(docs, duck):
    got = {(r.doc_id, r.shard, r.depth, r.shard_bytes) for r in sharding.assign(docs, limit=40_000, pass_bits=3).select(
        "doc.doc_id", "shard", "depth", "shard_bytes").collect()}
    sql = SHARDING_SQL.replace(str(sharding.SHARD_BYTES), "40000")
    want = set(duck.execute(f"SELECT doc_id, shard, depth, shard_bytes FROM ({sql})").fetchall())
    assert got == want and len({r[1] for r in got}) > 5


# SimHash


def _fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    ones = Counter(b for g in grams for b in range(64) if xxhash.xxh64_intdigest(g, 42) >> b & 1)
    return sum(1 << b for b in range(64) if ones[b] * 2 > len(grams))


def _roots(prints, bits=3):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, p in enumerate(prints):
        for j in range(i):
            if (p ^ prints[j]).bit_count() <= bits:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(prints))]


def test_simhash_components(spark, sf_dir, texts):
    ids = sorted(texts)
    prints = [_fingerprint(texts[i]) for i in ids]
    want = {(i, f"{p:016x}", ids[r]) for i, p, r in zip(ids, prints, _roots(prints), strict=True)}
    assert {tuple(r) for r in QUERIES["op5_simhash_components"](spark, sf_dir).select("doc_id", "fingerprint", "component_id").collect()} == want


@pytest.mark.parametrize("limit", [4, 40, 4096])
def test_dense_lists_keep_every_component(spark, limit):
    rng = random.Random(limit)
    centre = rng.getrandbits(64)
    prints = {centre}
    while len(prints) < 120:
        p = rng.choice(sorted(prints)) if rng.random() < 0.9 else rng.getrandbits(64)
        for _ in range(rng.randint(1, 4)):
            p ^= 1 << rng.randrange(64)
        prints.add(p)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    edges = simhash.links(spark.createDataFrame([(p,) for p in signed], "print long"), list_rows=limit)
    got = {r.node: r.root for r in components.components(edges).collect()}
    groups, want = defaultdict(set), defaultdict(set)
    for p, r in zip(signed, _roots(prints), strict=True):
        groups[got.get(p, p)].add(p)
        want[r].add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 50)] + [(7, 7), (300, 200)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 0 for i in range(50)}, 200: 200, 300: 200}


# Order MinHash


def _long(x):
    return x - (1 << 64) if x >> 63 else x


def _hash(*values):
    h = 42
    for v in values:
        raw = v.encode() if isinstance(v, str) else (v % (1 << 64)).to_bytes(8, "little") if abs(v) >= 1 << 31 or isinstance(v, Long) else (
            v % (1 << 32)).to_bytes(4, "little")
        h = xxhash.xxh64_intdigest(raw, h)
    return _long(h)


class Long(int):
    """Hashed as eight bytes."""


def _order_minhash(text):
    mask = fingerprints.HASH_MASK
    words = re.split(r"\s+", text)
    words = [w for w in words if w]
    grams = [tuple(words[i : i + 2]) for i in range(max(len(words) - 1, 1))] if words else []
    seen, numbered = Counter(), []
    for at, g in enumerate(grams):
        numbered.append((_hash(Long(_hash(*g) & mask), seen[_hash(*g) & mask]) & mask, at))
        seen[_hash(*g) & mask] += 1
    out = []
    for n in range(fingerprints.ENTRIES):
        least = sorted((h ^ fingerprints.permutation(n), at) for h, at in numbered)[: fingerprints.TUPLE]
        h = 42
        for v, _ in sorted(least, key=lambda x: x[1]):
            h = xxhash.xxh64_intdigest(v.to_bytes(8, "little"), h)
        out.append(h)
    return out


def test_order_minhash(spark, sf_dir, texts):
    got = {r.doc_id: r for r in QUERIES["op6_order_minhash"](spark, sf_dir).collect()}
    ids = sorted(texts, reverse=True)
    assert set(got) == set(ids)
    for n, i in enumerate(ids):
        text, after = texts[i], texts[ids[(n + 1) % len(ids)]]
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        a, b, c = _order_minhash(text), _order_minhash(edited), _order_minhash(after)
        share = lambda x, y: sum(p == q for p, q in zip(x, y, strict=True)) / len(x)
        r = got[i]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == "".join(f"{x:016x}" for x in a) and r.edited_fingerprint == "".join(f"{x:016x}" for x in b)
        assert abs(r.near_edited - share(a, b)) < 1e-9 and abs(r.near_next - share(a, c)) < 1e-9
    rows = got.values()
    assert sum(r.near_edited for r in rows) > 10 * sum(r.near_next for r in rows)


def test_every_edited_text_is_nearer_than_a_stranger(spark):
    rng = random.Random(11)
    rows = [(i, " ".join(f"w{rng.randrange(50_000)}" for _ in range(300))) for i in range(400)]
    got = fingerprints.edited_likeness(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 400 and all(r.near_edited > r.near_next for r in got)


@pytest.mark.parametrize("ids", [
    [-(2**63), 0, 2**63 - 1], [*range(300), 10**15], [random.Random(n).randrange(-(2**63), 2**63) for n in range(400)], [7, None, 3]])
def test_next_documents_whatever_the_ids(spark, ids):
    rows = [(i, f"text {n} of {len(ids)} " + "more words " * (n % 5)) for n, i in enumerate(ids)]
    got = {r.doc_id: r for r in fingerprints.edited_likeness(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    assert len(got) == len(rows)
    for (i, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        third = len(text) // 3
        assert got[i].edited_sha256 == hashlib.sha256((text[: len(text) - third] + after[:third]).encode()).hexdigest()


def test_ids_are_put_in_order_in_even_ranges(spark):
    """One id far off, and a third of all rows without an id."""
    ids = [*range(20_000), 10**15] + [None] * 10_000
    rows = spark.createDataFrame([(n, i, "t") for n, i in enumerate(ids)], "key long, doc_id long, text string").repartition(16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # which would join small ranges
    try:
        links = fingerprints.next_keys(rows).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    following = {r.key: r.next_key for r in links}
    assert len(following) == len(ids) and set(following.values()) == set(following)
    at = 20_000  # the id far off comes first, then 19999 down to 0, then those without an id
    for want in [*range(19_999, -1, -1)]:
        at = following[at]
        assert at == want
    blocks = spark.read.parquet(max(glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/fingerprint-order-*"), key=os.path.getmtime))
    sizes = [r["count"] for r in blocks.groupBy("block").count().collect()]
    assert len(sizes) > 1 and max(sizes) <= 2 * sum(sizes) / len(sizes)


def test_copies_follow_each_other(spark):
    rows = [(5, "same text here")] * 4 + [(5, "other text here"), (1, "last one")]
    got = fingerprints.edited_likeness(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    own = hashlib.sha256(b"same text same").hexdigest()
    assert len(got) == 6 and sum(r.edited_sha256 == own for r in got) == 3
    assert sum(r.near_next == 1.0 for r in got) == 3


@pytest.mark.parametrize("n", [1, 511, 512, 513, 5000])
def test_select_unpacks_single_blocks(monkeypatch, n):
    rng = np.random.default_rng(n)
    ids = rng.choice([3, 3, 3, 7, 100, 65_000], n).astype("<u4")
    matrix, unpack = wavelet.WaveletMatrix.build(ids, 16), np.unpackbits

    def blocks_only(a, *args, **kw):
        assert a.ndim == 2 and a.shape[1] == wavelet.BLOCK // 8, "a whole plane was unpacked"
        return unpack(a, *args, **kw)

    monkeypatch.setattr(np, "unpackbits", blocks_only)
    for token in (3, 7, 100, 65_000, 8, 70_000):
        assert matrix.select(token).tolist() == np.flatnonzero(ids == token).tolist()
        assert matrix.select(token, n // 3, n // 2).tolist() == [i for i in range(n // 3, n // 2) if ids[i] == token]


def test_space_runs_are_seen():
    rng = random.Random(2)
    for _ in range(5000):
        text = "".join(rng.choice("ab \n\t\x00\x1c\u2003\x85") for _ in range(rng.randrange(6)))
        assert encoding._has_space_run(text) == (encoding.SPACE_RUN.search(text) is not None), repr(text)


def test_repeated_kmers_are_numbered(spark):
    rows = [(1, "a b " * 40), (2, "a b " * 41), (3, "b a " * 40), (4, " ".join(f"w{i * i % 977}" for i in range(3000)))]
    df = fingerprints.with_fingerprint(spark.createDataFrame(rows, "doc_id long, text string"), "text", "print")
    for r in df.collect():
        assert [_long(x) for x in _order_minhash(r.text)] == r.print


# Licenses


def test_no_short_notice_is_missed(spark):
    """A notice whose one shingle is small under no band's permutation: windows alone miss a twentieth."""
    notice = "n3279 released under my license"
    rows = [(i, f"a{i} b{i} c{i} d{i} e{i} f{i} {notice} g{i} h{i} i{i} j{i} k{i} l{i}") for i in range(500)]
    notices = spark.createDataFrame([(0, "own", notice)], "template_id int, license string, text string")
    assert licenses.licenses(spark.createDataFrame(rows, "doc_id long, text string"), notices).count() == 500


# Language and toxicity


def test_language_of_held_out_documents(spark, sf_dir, docs):
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = QUERIES["op7_language_identification"](spark, sf_dir).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert sum(r.rejected for r in rows) <= 0.01 * len(rows)


def test_language_model_ignores_held_out_rows(docs):
    swapped = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, "xx").otherwise(F.col("lang")))
    assert "xx" not in language.fit(swapped).languages


def test_disguises_are_seen_through(docs):
    table = toxicity.character_counts(docs.select(F.concat_ws(" ", "text", F.lit("worthless idiot moron stupid " * 3)).alias("text")))
    find = toxicity.Extractor(table)
    for disguise, word in (("1d10t", "idiot"), ("m0r0n!", "moron"), ("$tupid", "stupid"), ("stuuuupid", "stupid"), ("i d i o t", "idiot"),
                           ("s-t-u-p-i-d", "stupid"), ("w0rthle55", "worthless")):
        assert toxicity.features(word)[0] in find.of(f"the {disguise} is"), disguise


def test_gram_hashes_agree():
    text = "<<<word>"
    codes = np.array([ord(c) for c in text], np.uint32)
    for n in range(1, 6):
        assert toxicity.grams(codes, n).tolist() == [toxicity.gram(text[i : i + n]) for i in range(len(text) - n + 1)]


def test_viterbi_takes_the_best_path():
    model = toxicity.CharacterModel(toxicity.count_grams(Counter({"cool": 50, "cot": 3, "col": 1})))
    token = "c0ol"

    def cost(word, extra):
        context, total = "<<<<", extra
        for c in word + ">":
            total -= model.log_chance(context, c)
            context = (context + c)[-4:]
        return total

    every = []
    for path in itertools.product(*toxicity.lattice(token, False)):
        every.append((cost("".join(t for t, _ in path), sum(c for _, c in path)), "".join(t for t, _ in path)))
    assert toxicity.decode(token, model) == [min(every)[1]]


# Passages


def _covered(rows):
    out = defaultdict(set)
    for r in rows:
        out[r.doc_id].update(range(r.start, r.end))
    return out


def test_every_long_repeated_run_is_found(spark, sf_dir, texts):
    size, first, need = 45, {}, defaultdict(list)
    words = {i: [w.strip(substrings._STRIP).lower() or w for w in t.split()] for i, t in texts.items()}
    for i in sorted(words):
        for at in range(len(words[i]) - size + 1):
            run = tuple(words[i][at : at + size])
            if first.setdefault(run, i) != i:
                need[i].append(at)
    rows = QUERIES["op2_shared_passages"](spark, sf_dir).collect()
    covered = _covered(rows)
    assert need and all(set(range(at, at + size)) <= covered[i] for i, starts in need.items() for at in starts)
    for r in rows:
        a, b = words[r.doc_id][r.start : r.end], words[r.source_id][r.source_start : r.source_end]
        assert r.doc_id > r.source_id and substrings.lcs(np.array(a), np.array(b)) >= 0.8 * max(len(a), len(b)) and len(a) >= 45


def test_edited_passages_are_found(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(5000)]
    fill = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage = fill(80)
    rows = [(0, " ".join([*fill(100), *passage, *fill(50)]))]
    for i in range(1, 30):
        edited = list(passage)
        for at in rng.sample(range(5, 75), 3):
            edited[at : at + 1] = [[], ["new"], [edited[at], "extra"]][rng.randrange(3)]
        rows.append((i, " ".join([*fill(rng.randint(0, 200)), *edited, *fill(rng.randint(0, 200))])))
    rows += [(i, " ".join(fill(300))) for i in range(30, 60)]
    found = substrings.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in found} == set(range(1, 30))
    assert all(55 <= r.end - r.start <= 95 for r in found)


def test_heavily_edited_passages_are_found(spark):
    """150 pairs of which 15 to 18 of 100 words differ; none may be missed."""
    rng, rows = random.Random(9), []
    fill = lambda n: [f"w{rng.randrange(50_000)}" for _ in range(n)]
    for i in range(150):
        passage = fill(50 + 5 * (i % 3))
        edited = list(passage)
        for at in rng.sample(range(2, len(passage) - 2), len(passage) * (15 + i % 4) // 100):
            edited[at] = f"new{at}"
        rows += [(2 * i, " ".join([*fill(40), *passage, *fill(40)])), (2 * i + 1, " ".join([*fill(40), *edited, *fill(40)]))]
    found = substrings.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.source_id) for r in found} == {(2 * i + 1, 2 * i) for i in range(150)}


@pytest.mark.parametrize("tasks", [1, 3, 11])
def test_a_passage_of_frequent_lines_is_found(spark, tasks):
    """Two lines of 30 words, each with other first and previous holders than the passage of both."""
    vocabulary, rng = [f"w{i}" for i in range(5000)], random.Random(8)
    fill = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    one, two = fill(30), fill(30)
    held = {0: two, 1: one, 2: one + two, 3: one, 4: two, 10: one + two}
    rows = [(i, " ".join([*fill(60), *held.get(i, []), *fill(60)])) for i in range(11)]
    found = substrings.passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(tasks, "doc_id")).collect()
    assert {(r.doc_id, r.source_id) for r in found} == {(10, 2)}
    assert set(range(60, 120)) <= _covered(found)[10]


def test_chain_takes_the_best_order():
    rng = random.Random(6)
    for _ in range(50):
        segments = []
        for _ in range(6):
            x, y, n = rng.randrange(60), rng.randrange(60), rng.randint(1, 12)
            segments.append((x, x + n, y, y + n))

        def score(path):
            total = sum(x1 - x0 + substrings.K - 1 for x0, x1, _, _ in path)
            for a, b in itertools.pairwise(path):
                if b[0] < a[1] or b[2] < a[3] or b[0] - a[1] > substrings.MAX_GAP or b[2] - a[3] > substrings.MAX_GAP:
                    return -1
                total -= substrings.GAP_COST * (b[0] - a[1] + b[2] - a[3])
            return total

        best = max(score(p) for n in range(1, 7) for p in itertools.permutations(segments, n))
        assert abs(score(substrings.chain(segments)[0]) - best) < 1e-9


# Pipeline


def test_pipeline_stages(spark, sf_dir, texts, duck):
    """run() against the stages done one by one without Spark, as far as they allow it."""
    docs, names = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf_dir)
        assert after.columns == docs.columns
        names.append((name, {r.doc_id: r.text for r in after.select("doc_id", "text").collect()}))
        docs = after
    kept = dict(names)
    assert kept["language_id"] == texts
    ids = sorted(texts)
    prints = [_fingerprint(texts[i]) for i in ids]
    assert kept["simhash_dedup"] == {ids[r]: texts[ids[r]] for r in set(_roots(prints))}
    before = spark.read.parquet(f"{sf_dir}/documents.parquet").where(F.col("doc_id").isin(list(kept["simhash_dedup"])))
    cut = _covered(substrings.passages(before).collect())
    left = {i: [w for at, w in enumerate(t.split()) if at not in cut[i]] for i, t in kept["simhash_dedup"].items()}
    assert any(cut.values()) and {i: t.split() for i, t in kept["substring_dedup"].items()} == {
        i: words for i, words in left.items() if words or not cut[i]}
    windows = duck.execute("SELECT text FROM benchmark").fetchall()
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t))
    marks = {" ".join(w[i : i + 10]) for (t,) in windows for w in [split(t)] for i in range(max(len(w) - 9, 1)) if w}
    dirty = {i for i, t in kept["substring_dedup"].items() if any(f" {m} " in f" {' '.join(split(t))} " for m in marks)}
    assert dirty and set(kept["decontamination"]) == set(kept["substring_dedup"]) - dirty
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    tokenizer, want = Tokenizer.from_file(WORD), set()
    for i, text in kept["decontamination"].items():
        own = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], "<u4")
        want |= {(i, n, a, len(own[a : a + 2048]), zlib.crc32(own[a : a + 2048].tobytes())) for n, a in enumerate(range(0, len(own), 2048))}
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows} == want
