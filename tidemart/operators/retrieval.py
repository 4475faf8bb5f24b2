"""Keyword retrieval: for each question the text sections that share most of its words.

Sections are indexed once. Their ids follow their size (number of distinct words), largest first, so
that posting lists, kept in order of ids, are in order of impact: a section cannot share more words
than it has. A list is stored in blocks of consecutive ids with the size of the block's
largest section, which bounds what any section in it can share.

A question is answered in three steps, all of them joins and aggregations over all questions:

1. *Threshold.* Each word's first few sections (the largest that hold it) are tallied. The k-th best
   tally is a number of shared words that k sections are known to reach.
2. *Candidates.* A section that reaches the threshold t holds at least one of any n - t + 1 of the
   question's n words, so only the lists of its n - t + 1 rarest words are read, and of them only
   blocks whose largest section has t words or more. Frequent words only add to what others found.
3. *Scores.* The candidates in a block are intersected with the same block of each of the question's
   lists, which counts the shared words without a look at any text; best k kept, equals by text.

Nothing is estimated: sections that are not read cannot be among the best k.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.operators.joins import attach, is_small
from tidemart.session import scratch_dir

#: Consecutive section ids whose low bits differ are a block: 4,096 of them at most.
BLOCK_BITS = 12

#: Largest sections per word that are tallied for the threshold.
CHAMPIONS = 32

#: Sections kept in the order of equals, for questions that share no word with k sections.
DEEPEST = 100


@dataclass(frozen=True)
class SectionIndex:
    texts: DataFrame  # lid, doc_id, section_no, section
    sections: DataFrame  # sid, lid, n_words: the ids in the order of sizes
    postings: DataFrame  # word, block, largest, sids
    words: DataFrame  # word, df, champions
    last: DataFrame  # place, sid: the first sections among equals


def split_sections(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Whole texts cut at second-level headings: (doc_id, section_no, section)."""
    return docs.select(F.col(doc_id).alias("doc_id"), F.posexplode(F.split(text, "\n## ")).alias("section_no", "section"))


def distinct_words(text: str) -> Column:
    """Runs of letters, digits and underscores in lower case, each once; none in a null text."""
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    return F.array_distinct(words)


def build_index(sections: DataFrame, folder: str) -> SectionIndex:
    """Store the index of ``sections`` (as from ``split_sections``) below ``folder``.

    Texts are written once and never moved: what is sorted and grouped are ids and words. The words
    of a section are held as one text, which takes less room than an array of them.
    """
    spark = sections.sparkSession
    listed = distinct_words("section")
    taken = sections.select(F.monotonically_increasing_id().alias("lid"), "doc_id", "section_no", "section", F.array_join(listed, " ").alias("words"))
    # Stored before it is sorted: a sort looks at its input twice, and texts are to be taken apart once.
    _write(taken, f"{folder}/texts")
    words = F.when(F.col("words") != "", F.split("words", " ")).otherwise(F.array().cast("array<string>"))
    texts = spark.read.schema(taken.schema).parquet(f"{folder}/texts")
    ordered = texts.select("lid", "doc_id", "section_no", "words", F.size(words).alias("n_words")).orderBy(F.desc("n_words"), "doc_id", "section_no")
    # Numbers grow with the partition and within it, hence along the order; once stored they are facts.
    _write(ordered.select(F.monotonically_increasing_id().alias("sid"), "lid", "n_words", "words"), f"{folder}/sections")
    stored = spark.read.parquet(f"{folder}/sections")
    holds = stored.select(F.explode(words).alias("word"), F.shiftright("sid", BLOCK_BITS).alias("block"), "sid", "n_words")
    blocks = holds.groupBy("word", "block").agg(
        F.max("n_words").alias("largest"), F.sort_array(F.collect_list("sid")).alias("sids"))
    _write(blocks.sortWithinPartitions("word", "block"), f"{folder}/postings")
    lists = spark.read.parquet(f"{folder}/postings").groupBy("word").agg(
        F.sum(F.size("sids")).alias("df"), F.min(F.struct("block", F.slice("sids", 1, CHAMPIONS).alias("sids"))).alias("first"))
    _write(lists.select("word", "df", F.col("first.sids").alias("champions")), f"{folder}/words")
    last = texts.orderBy(*_equals()).limit(DEEPEST).select("lid", "section", "doc_id", "section_no")
    last = stored.select("sid", "lid").join(F.broadcast(last), "lid")  # DEEPEST rows
    place = F.row_number().over(Window.orderBy(*_equals()))
    _write(last.select(place.alias("place"), "sid"), f"{folder}/last")
    return open_index(spark, folder)


def _write(df: DataFrame, path: str) -> None:
    df.write.option("compression", "zstd").parquet(path)


def open_index(spark: SparkSession, folder: str) -> SectionIndex:
    return SectionIndex(*(spark.read.parquet(f"{folder}/{t}") for t in ("texts", "sections", "postings", "words", "last")))


def _equals() -> list[Column]:
    """Order among sections that share equally many words."""
    return [F.desc("section"), F.asc("doc_id"), F.asc("section_no")]


def topk_by_overlap(questions: DataFrame, sections: DataFrame, k: int = 3) -> DataFrame:
    """``topk`` over sections that have no index yet."""
    return topk(questions, build_index(sections, scratch_dir(sections.sparkSession, "sections")), k)


def topk(questions: DataFrame, index: SectionIndex, k: int = 3) -> DataFrame:
    """The ``k`` best sections per question by number of distinct shared words.

    Ties go to the section whose text sorts last, then to the lowest document and section. Every
    section is a candidate, those without a common word included. ``questions`` has (question_id,
    question); a null question has no words.
    """
    if k > DEEPEST:
        raise ValueError(f"at most {DEEPEST} sections per question")
    asked = questions.select("question_id", distinct_words("question").alias("words"))
    fill = [r.sid for r in index.last.orderBy("place").limit(k).collect()]
    always = asked.select("question_id", F.explode(F.array(*map(F.lit, fill)).cast("array<bigint>")).alias("sid"))
    pairs = candidates(asked, index, k).unionByName(always)
    counted = shared_words(asked, pairs, index).unionByName(always.withColumn("n", F.lit(0)))
    scored = counted.groupBy("question_id", "sid").agg(F.sum("n").cast("int").alias("overlap"))
    per_question = Window.partitionBy("question_id")
    ahead = scored.withColumn("_rank", F.rank().over(per_question.orderBy(F.desc("overlap")))).where(F.col("_rank") <= k)
    # Stored, so that its size is known: a few answers are sent to the texts and not the texts to them.
    spark = ahead.sparkSession
    best = scratch_dir(spark, "answers")
    ahead.write.parquet(best)
    answers = attach(index.sections.select("sid", "lid"), spark.read.schema(ahead.schema).parquet(best), "sid", "inner")
    located = scratch_dir(spark, "located")
    answers.write.parquet(located)
    texts = attach(index.texts.select("lid", "doc_id", "section_no", "section"), spark.read.schema(answers.schema).parquet(located), "lid", "inner")
    place = F.row_number().over(per_question.orderBy(F.desc("overlap"), *_equals()))
    return texts.withColumn("rnk", place).where(F.col("rnk") <= k).select(
        "question_id", "rnk", "doc_id", "section_no", "overlap", "section")


def shared_words(asked: DataFrame, pairs: DataFrame, index: SectionIndex) -> DataFrame:
    """(question_id, sid, n) with n = 1 for every word that a pair shares."""
    blocks = pairs.groupBy("question_id", F.shiftright("sid", BLOCK_BITS).alias("block")).agg(F.collect_set("sid").alias("wanted"))
    b, q = blocks.alias("b"), asked.alias("q")
    words = b.join(q, F.col("b.question_id").eqNullSafe(F.col("q.question_id"))).select(
        "b.question_id", "block", "wanted", F.explode("words").alias("word"))
    # Only the lists of words that are asked for are moved, however few those are.
    said = asked.select(F.explode("words").alias("word")).distinct()
    lists = attach(index.postings, said, "word", "inner") if is_small(asked) else index.postings
    held = words.join(lists, ["word", "block"])
    return held.select("question_id", F.explode(F.array_intersect("wanted", "sids")).alias("sid"), F.lit(1).alias("n"))


def candidates(asked: DataFrame, index: SectionIndex, k: int) -> DataFrame:
    """(question_id, sid) of every section that shares a word and can be among a question's best
    ``k``; a pair may come several times. ``asked`` has (question_id, words)."""
    # A few questions (by the size of their source) go to the index, which then stays where it is.
    send = F.broadcast if is_small(asked) else lambda df: df
    known = index.words.join(send(asked.select("question_id", F.explode("words").alias("word"))), "word")
    tally = known.select("question_id", F.explode("champions").alias("sid")).groupBy("question_id", "sid").agg(F.count(F.lit(1)).alias("n"))
    best = Window.partitionBy("question_id").orderBy(F.desc("n"))
    reached = tally.withColumn("_place", F.row_number().over(best)).where(F.col("_place") <= k)
    threshold = reached.groupBy("question_id").agg(F.when(F.count(F.lit(1)) == k, F.min("n")).otherwise(1).cast("int").alias("t"))
    lists = known.groupBy("question_id").agg(F.sort_array(F.collect_list(F.struct("df", "word"))).alias("lists"))
    l, t = lists.alias("l"), threshold.alias("t")
    rare = l.join(t, F.col("l.question_id").eqNullSafe(F.col("t.question_id"))).select(
        "l.question_id", "t.t", F.explode(F.slice("lists", F.lit(1), F.size("lists") - F.col("t") + 1)).alias("list"))
    read = index.postings.join(send(rare.select("question_id", "t", F.col("list.word").alias("word"))), "word").where("largest >= t")
    return read.select("question_id", F.explode("sids").alias("sid"))
