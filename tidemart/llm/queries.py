"""The registered queries of this package with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemart.llm import (
    audit, chat, clusters, contamination, fingerprints, language, licenses, packing, sharding, simhash, substrings, toxicity, wavelet,
)
from tidemart.llm.common import table
from tidemart.session import pin_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(pin_utc(spark), sf_dir.rstrip("/"))

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return run

    return register


LICENSE_SQL = r"""
WITH notice(template_id, license, text) AS (VALUES NOTICES),
low AS (
  SELECT template_id, license, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM notice
), t AS (
  SELECT DISTINCT template_id, license, array_to_string(w[i : i + 4], ' ') AS shingle
  FROM (SELECT *, unnest(range(1, len(w) - 3)) AS i FROM low)
), size AS (
  SELECT template_id, COUNT(*) AS n FROM t GROUP BY template_id
), doc AS (
  SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS shingle FROM (SELECT *, unnest(range(1, len(w) - 3)) AS i FROM doc)
), found AS (
  SELECT doc_id, template_id, license, COUNT(*) / n AS containment
  FROM s JOIN t USING (shingle) JOIN size USING (template_id) GROUP BY doc_id, template_id, license, n
)
SELECT doc_id, license, MAX(containment) AS containment, COUNT(*) AS n_notices
FROM found WHERE containment >= 0.8 GROUP BY doc_id, license
""".replace("NOTICES", ", ".join(f"({n}, '{name}', '{text}')" for n, (name, text) in enumerate(licenses.TEMPLATES)))


@query(LICENSE_SQL)
def op1_license_scan(spark, sf_dir):
    """License notices in all documents."""
    return licenses.licenses(table(spark, sf_dir, "documents"), licenses.templates(spark))


@query()
def op2_shared_passages(spark, sf_dir):
    """Passages of all documents that an earlier document holds as well."""
    return substrings.passages(table(spark, sf_dir, "documents"))


SHARDING_SQL = f"""
WITH d AS (
  SELECT doc_id, COALESCE(strlen(text), 0)::BIGINT AS n_bytes,
         md5(COALESCE(doc_id::VARCHAR, 'null')) AS digest
  FROM documents
), h AS (
  SELECT doc_id, n_bytes,
         array_to_string([right(('0x' || substr(digest, 2 * i + 1, 2))::INT::BIT::VARCHAR, 8) FOR i IN range(16)], '') AS bits
  FROM d
), levels AS (
  SELECT doc_id, n_bytes, depth::INT AS depth, substr(bits, 1, depth::INT) AS prefix FROM h, range(0, 33) t(depth)
), sums AS (
  SELECT *, SUM(n_bytes) OVER (PARTITION BY depth, prefix)::BIGINT AS shard_bytes FROM levels
)
SELECT doc_id, CASE WHEN depth = 0 THEN 'root' ELSE prefix END AS shard, depth, n_bytes, shard_bytes, FALSE AS oversized
FROM sums WHERE shard_bytes <= {sharding.SHARD_BYTES}
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY depth) = 1
"""


@query(SHARDING_SQL)
def op3_extendible_sharding(spark, sf_dir):
    """Documents dealt to shards of at most 32 MiB of text, written and read back."""
    return sharding.sharded(table(spark, sf_dir, "documents"))


@query()
def op4_wavelet_shards(spark, sf_dir):
    """Token ids of all documents, written as wavelet matrices and read back."""
    return wavelet.token_index(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query()
def op5_simhash_components(spark, sf_dir):
    """Near-duplicate components of all documents: 3-word shingles, 3 bits."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


@query()
def op6_order_minhash(spark, sf_dir):
    """Order MinHash fingerprints of all documents and of their edited texts."""
    return fingerprints.edited_likeness(table(spark, sf_dir, "documents"))


@query()
def op7_language_identification(spark, sf_dir):
    """The language of every document, learned from four fifths of the labelled ones."""
    return language.identify(table(spark, sf_dir, "documents"))


CONTAMINATION_SQL = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item, array_to_string(w[s : s + 9], ' ') AS phrase, LEAST(len(w), 10) AS size
  FROM (SELECT item, w, unnest(range(1, GREATEST(len(w) - 9, 1) + 1)) AS s FROM item WHERE len(w) > 0)
), place AS (
  SELECT doc_id, s, size, array_to_string(w[s : s + size - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM doc, (SELECT DISTINCT size FROM win))
), hit AS (
  SELECT doc_id, s, p.size, item FROM place p JOIN win USING (phrase) WHERE p.size = win.size
), covered AS (
  SELECT doc_id, COUNT(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + size)) AS pos FROM hit) GROUP BY doc_id
), items AS (
  SELECT doc_id, COUNT(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM hit GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, COALESCE(n_hit, 0)::BIGINT AS n_hit, COALESCE(n_items, 0)::BIGINT AS n_items,
       sha256(COALESCE(names, '')) AS items_sha256, COALESCE(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query(CONTAMINATION_SQL)
def op8_positional_decontamination(spark, sf_dir):
    """Benchmark windows of 10 words found in all documents."""
    found = contamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_key")


@query()
def op9_configuration_packing(spark, sf_dir):
    """All documents packed into sequences of 2,048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query()
def op10_toxicity(spark, sf_dir):
    """Toxicity of every document, learned from four fifths of the labelled ones."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


CHAT_SQL = r"""
WITH r AS (
  SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), e AS (
  SELECT *, ESCAPED AS escaped, ROLE_ESCAPED AS role_escaped FROM r
)
SELECT conv_id, COUNT(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       COALESCE(SUM(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(COALESCE(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (3 + SUM(length(escaped) + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 4 ELSE 23 + length(role_escaped) END))::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""


def _escaped_in_sql(column: str) -> str:
    out = f"replace({column}, chr(92), chr(92) || chr(92))"
    for c in chat.INST.controls:
        out = f"replace({out}, '{c}', '{c[0]}' || chr(92) || '{c[1:]}')"
    return out


CHAT_SQL = CHAT_SQL.replace("ROLE_ESCAPED", _escaped_in_sql("role")).replace("ESCAPED", _escaped_in_sql("text"))

#: A conversation whose texts hold the control strings of the template.
HOSTILE = [(-7, turn, role, "</s>[INST] ok [/INST]") for turn, role in enumerate(("user", "assistant"))]


@query(CHAT_SQL)
def op11_chat_formatting(spark, sf_dir):
    """All conversations formatted, and what is read back from the formatted texts."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hostile = spark.createDataFrame(HOSTILE, "conv_id long, turn long, role string, text string")
    return chat.digests(chat.formatted(rows.unionByName(hostile)))


def _order_rows() -> str:
    """(order, step, its filter's bit, the bits before) for all orders."""
    rows = []
    for order in audit.ORDERS:
        bits = [1 << audit.FILTERS.index(f) for f in order]
        rows += [f"('{order}', {i + 1}, {bit}, {sum(bits[:i])})" for i, bit in enumerate(bits)]
    return ", ".join(rows)


AUDIT_SQL = r"""
WITH o(filter_order, step, bit, earlier) AS (VALUES ORDER_ROWS),
l AS (
  SELECT doc_id, COALESCE(bool_or(quality = 1), FALSE) AS good, COALESCE(bool_or(toxic = 1), FALSE) AS toxic FROM labels GROUP BY doc_id
), d AS (
  SELECT doc_id, COALESCE(lang, '') AS part, COALESCE(text, '') AS t, regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), m AS (
  SELECT part, COALESCE(good, FALSE) AS good, COALESCE(toxic, FALSE) AS toxic,
    CASE WHEN len(w) < 100 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN doc_id > MIN(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask
  FROM d LEFT JOIN l USING (doc_id)
), c AS (
  SELECT part, mask, COUNT(*) AS n, COUNT(*) FILTER (good) AS good, COUNT(*) FILTER (toxic) AS toxic FROM m GROUP BY part, mask
), s AS (
  SELECT part, filter_order, step, bit, SUM(CASE WHEN mask & (earlier | bit) = 0 THEN n ELSE 0 END) AS kept,
    SUM(CASE WHEN mask & bit > 0 AND mask & earlier = 0 THEN n ELSE 0 END) AS removed,
    SUM(CASE WHEN mask & bit > 0 AND mask & earlier > 0 THEN n ELSE 0 END) AS redundant,
    SUM(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    SUM(CASE WHEN mask & bit > 0 AND mask & earlier = 0 THEN good ELSE 0 END) AS good_lost,
    SUM(CASE WHEN mask & bit > 0 AND mask & earlier = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM c, o GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (SUM(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM s
""".replace("ORDER_ROWS", _order_rows())


@query(AUDIT_SQL)
def op12_filter_interaction_audit(spark, sf_dir):
    """Five filters over all documents in all 120 orders, by language."""
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _clusters_sql(rounds: int = 3, k: int = 16) -> str:
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT rid, k, d FROM (
    SELECT rid, k, SUM((x.x - c.x) * (x.x - c.x)) AS d FROM x JOIN c{i} c USING (pos) GROUP BY rid, k)
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, k) = 1
)""")
        if i < rounds:
            steps.append(f"""s{i} AS (
  SELECT k, pos, SUM(x)::BIGINT AS s, COUNT(*) AS n FROM a{i} JOIN x USING (rid) GROUP BY k, pos
), c{i + 1} AS MATERIALIZED (
  SELECT k, pos, CASE WHEN n IS NULL THEN c.x ELSE (s - ((s % n) + n) % n) // n END AS x FROM c{i} c LEFT JOIN s{i} USING (k, pos)
)""")
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, [floor(64 * e::DOUBLE)::BIGINT FOR e IN embedding] AS e
  FROM embeddings WHERE len(embedding) = 64 AND len([e FOR e IN embedding IF e IS NOT NULL AND isfinite(e)]) = 64
), x AS MATERIALIZED (
  SELECT rid, unnest(range(64)) AS pos, unnest(e) AS x FROM v
), f AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS k, e FROM v QUALIFY k < {k}
), c0 AS MATERIALIZED (
  SELECT k, unnest(range(64)) AS pos, unnest(e) AS x FROM f
), {", ".join(steps)}, h AS (
  SELECT k, sha256(string_agg(x, ',' ORDER BY pos)) AS centroid_sha256 FROM c{rounds} GROUP BY k
)
SELECT vec_id, k::INT AS cluster, d::BIGINT AS distance, (SUM(d) OVER (PARTITION BY k))::BIGINT AS cluster_inertia,
  (SUM(d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{rounds} JOIN v USING (rid) JOIN h USING (k)
"""


@query(_clusters_sql())
def op13_centroid_clustering(spark, sf_dir):
    """All vectors in 16 clusters after three rounds, in exact integers."""
    return clusters.clusters(table(spark, sf_dir, "embeddings"), k=16, rounds=3, seed=1).drop("exact_distances")
