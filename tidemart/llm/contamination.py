"""Benchmark decontamination with a positional inverted index, in DataFrame functions alone.

``build_index`` stores the postings (term, document, position) of every word of the corpus that
any benchmark item uses. A benchmark window (10 consecutive words; a shorter item is one window)
is searched from its rarest terms: their posting lists are adjusted by the terms' offsets and
intersected, which leaves few places, and these are compared with the window word by word.
``exact_hits`` returns the phrase matches, ``proximity_hits`` also places where most of a window's
words stand near its rarest one, in any order and with other words between.

Defined results. Null or word-free text: no words, not contaminated. Null item text: no windows.
Null item_id: counted under the text 'null'. Equal items: each is counted. Repeated rows: each gets
the same result; rows that share a doc_id are told apart by their texts. Empty tables: no rows, or
no hits. Further columns are ignored by ``contamination`` and kept by ``clean``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemart.llm.common import ascii_lower, named, stored

WINDOW = 10
#: Posting lists that are intersected before places are compared word by word.
LISTS = 2
#: A benchmark-side table is broadcast up to this many rows (about 30 MB); beyond, it is shuffled.
BROADCAST_ROWS = 100_000
#: Proximity: words by which terms may be displaced, and the share of a window that has to be there.
SLOP = 5
NEAR_SHARE = 0.8


def words(text: Column) -> Column:
    """Lower-cased (A-Z) runs of ASCII letters, digits and all other characters beyond ASCII."""
    parts = F.split(ascii_lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.filter(parts, lambda w: w != "")


def windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """The windows of all items: item, phrase (the words, space-joined) and words."""
    split = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), words(F.col("text")).alias("w"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    cut = split.where(F.size("w") > 0).select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i, size))).alias("words"))
    return cut.select("item", F.array_join("words", " ").alias("phrase"), "words").distinct()


def _small(df: DataFrame) -> DataFrame:
    """Broadcast ``df`` if its counted rows allow it."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and a hash of the text, which tells rows of one doc_id apart."""
    return docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"))


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Stored postings of the given terms: term, doc_id, text_key, position (from 0). Under the
    empty term every document has one posting, whose position is its number of words."""
    listed = keyed(docs).select("doc_id", "text_key", F.posexplode(F.concat(words(F.col("text")), F.array(F.lit("")))).alias("position", "term"))
    wanted = terms.select("term").unionByName(terms.sparkSession.range(1).select(F.lit("").alias("term"))).distinct()
    return stored(listed.join(_small(wanted), "term").select("term", "doc_id", "text_key", "position"), "postings")


def rarest_terms(found: DataFrame, index: DataFrame, lists: int = LISTS) -> DataFrame:
    """For each phrase its rarest terms by their number of postings: phrase, words, term, offset,
    rank. Phrases with a term that the corpus lacks are dropped."""
    frequency = _small(stored(index.groupBy("term").agg(F.count(F.lit(1)).alias("n")), "frequencies"))
    phrases = found.select("phrase", "words").distinct()
    terms = phrases.select("phrase", "words", F.posexplode("words").alias("offset", "term"))
    counted = terms.join(frequency, "term", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    by_phrase = W.partitionBy("phrase")  # at most a window's words
    ranked = counted.withColumn("least", F.min("n").over(by_phrase)).withColumn(
        "rank", F.row_number().over(by_phrase.orderBy("n", "offset")))
    return ranked.where((F.col("least") > 0) & (F.col("rank") <= lists)).select("phrase", "words", "term", "offset", "rank")


def candidates(index: DataFrame, rare: DataFrame) -> DataFrame:
    """Places where the offset-adjusted lists of a phrase's rarest terms meet: phrase, words,
    doc_id, text_key, start (from 0)."""
    need = rare.select("phrase", "term", "offset", F.least(F.size("words"), F.lit(LISTS)).alias("lists"))
    postings = index.join(_small(stored(need, "rarest-terms")), "term").select(
        "phrase", "lists", "doc_id", "text_key", (F.col("position") - F.col("offset")).alias("start"))
    met = postings.where("start >= 0").groupBy("phrase", "doc_id", "text_key", "start").agg(
        F.count(F.lit(1)).alias("n"), F.first("lists").alias("lists"))
    return met.where("n >= lists").select("phrase", "doc_id", "text_key", "start")


def _with_texts(docs: DataFrame, places: DataFrame) -> DataFrame:
    """The places of each document, gathered (at most its words times the windows that share a
    rarest term there), beside its words."""
    per_doc = places.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("start", "phrase")).alias("places"))
    texts = keyed(docs).alias("t")
    same = F.col("t.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("t.text_key") == F.col("p.text_key"))
    return texts.join(per_doc.alias("p"), same).select("t.doc_id", "t.text_key", words(F.col("t.text")).alias("w"), "p.places").dropDuplicates(
        ["doc_id", "text_key"])


def exact_hits(docs: DataFrame, index: DataFrame, found: DataFrame) -> DataFrame:
    """Documents with windows that occur in them: doc_id, text_key, hits (start, length, phrase)."""
    places = candidates(index, rarest_terms(found, index))
    checked = _with_texts(docs, places).select("doc_id", "text_key", F.expr(
        "filter(places, p -> array_join(slice(w, p.start + 1, size(split(p.phrase, ' '))), ' ') = p.phrase)").alias("places"))
    return checked.where(F.size("places") > 0).select("doc_id", "text_key", F.expr(
        "transform(places, p -> named_struct('start', p.start, 'length', size(split(p.phrase, ' ')), 'phrase', p.phrase))").alias("hits"))


def proximity_hits(docs: DataFrame, index: DataFrame, found: DataFrame, slop: int = SLOP, share: float = NEAR_SHARE) -> DataFrame:
    """Places where a window's words stand together in any order: doc_id, position of the window's
    rarest term, phrase, n_found. ``share`` of the window's distinct words have to be within its
    length and ``slop`` words of that term, before or behind."""
    rare = rarest_terms(found, index, lists=1)
    places = index.join(_small(stored(rare, "rarest-term")), "term").select("phrase", "doc_id", "text_key", F.col("position").alias("start"))
    near = (
        "transform(places, p -> named_struct('position', p.start, 'phrase', p.phrase, "
        "'n_terms', size(array_distinct(split(p.phrase, ' '))), 'n_found', size(array_intersect(split(p.phrase, ' '), "
        f"slice(w, greatest(p.start - size(split(p.phrase, ' ')) - {slop}, 0) + 1, 2 * (size(split(p.phrase, ' ')) + {slop}) + 1)))))"
    )
    checked = _with_texts(docs, places).select("doc_id", F.explode(F.expr(near)).alias("p")).select("doc_id", "p.*")
    return checked.where(F.col("n_found") >= F.ceil(F.col("n_terms") * share)).select("doc_id", "position", "phrase", "n_found")


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """Every document with its words, hit words, items found and their digest."""
    found = stored(windows(items, size), "windows")
    index = build_index(docs, found.select(F.explode("words").alias("term")))
    hits = stored(exact_hits(docs, index, found), "hits")
    # Words covered by at least one window: in order of start, what reaches beyond all before.
    covered = F.expr(
        "aggregate(array_sort(transform(hits, h -> named_struct('start', h.start, 'length', h.length))), "
        "named_struct('n', 0L, 'end', 0L), (acc, h) -> named_struct("
        "'n', acc.n + greatest(0L, h.start + h.length - greatest(acc.end, CAST(h.start AS BIGINT))), "
        "'end', greatest(acc.end, CAST(h.start + h.length AS BIGINT)))).n"
    )
    names = hits.select("doc_id", "text_key", F.explode("hits.phrase").alias("phrase")).distinct().join(
        found.select("phrase", "item"), "phrase")
    per_doc = names.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set("item")).alias("items"))
    marked = hits.select("doc_id", "text_key", covered.alias("n_hit")).alias("h").join(
        per_doc.alias("i"), _same("h", "i"), "left").select("h.*", "i.items")
    return (
        index.where("term = ''").alias("d").join(marked.alias("m"), _same("d", "m"), "left")
        .select(
            "d.doc_id", F.col("d.position").cast("long").alias("n_words"), F.coalesce("m.n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce(F.size("m.items"), F.lit(0)).cast("long").alias("n_items"),
            F.sha2(F.coalesce(F.array_join("m.items", ","), F.lit("")), 256).alias("items_sha256"),
            (F.coalesce("m.n_hit", F.lit(0)) > 0).alias("contaminated"), F.col("d.text_key"),
        )
    )


def _same(a: str, b: str) -> Column:
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.text_key") == F.col(f"{b}.text_key"))


def clean(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` in which no window of any item occurs, all columns as they are."""
    found = stored(windows(items, size), "windows")
    index = build_index(docs, found.select(F.explode("words").alias("term")))
    hits = exact_hits(docs, index, found).select("doc_id", "text_key")
    same = F.col("d.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.xxhash64(F.coalesce("d.text", F.lit(""))) == F.col("h.text_key"))
    return docs.alias("d").join(hits.alias("h"), same, "left_anti").select(named(docs, "d"))
