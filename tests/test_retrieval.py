"""Keyword retrieval against brute force (M13)."""

import random
import re

import pytest
from helpers import final_plan, plan_of
from pyspark.sql import functions as F

from tidemart.catalog import QUERIES
from tidemart.operators import retrieval


def brute_force(questions, sections, k):
    words = lambda t: set(re.findall(r"\w+", t.lower()))
    out = []
    for qid, q in questions:
        ranked = sorted(((len(words(q or "") & words(s)), s, -d, -n) for d, n, s in sections), reverse=True)[:k]
        out += [(qid, i + 1, -d, -n, o, s) for i, (o, s, d, n) in enumerate(ranked)]
    return sorted(out)


def run(spark, questions, docs, k=3):
    q = spark.createDataFrame(questions, "question_id long, question string")
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    return sorted(map(tuple, retrieval.topk_by_overlap(q, retrieval.split_sections(d), k).collect()))


def test_equal_overlap_falls_back_to_text_order(spark):
    docs = [(1, "b shared\n## a shared\n## c shared"), (2, "nothing")]
    got = run(spark, [(1, "Shared?")], docs)
    assert [(r[2], r[3], r[5]) for r in got] == [(1, 2, "c shared"), (1, 0, "b shared"), (1, 1, "a shared")]


def test_sections_without_a_common_word_rank_last(spark):
    got = run(spark, [(1, "alpha"), (2, "")], [(1, "alpha"), (2, "zeta"), (3, "beta")])
    assert [(r[0], r[1], r[2], r[4]) for r in got] == [
        (1, 1, 1, 1), (1, 2, 2, 0), (1, 3, 3, 0), (2, 1, 2, 0), (2, 2, 3, 0), (2, 3, 1, 0)]


def texts(seed, vocabulary, weights=None):
    rnd = random.Random(seed)
    text = lambda n: " ".join(rnd.choices(vocabulary, weights, k=n))
    questions = [(i, text(rnd.randrange(0, 9))) for i in range(25)] + [(90, None), (91, ""), (92, "unknown only")]
    docs = [(i, "\n## ".join(text(rnd.randrange(0, 9 + 40 * (i % 7 == 0))) for _ in range(rnd.randrange(1, 4)))) for i in range(80)]
    docs += [(i + 100, t) for i, t in docs[:30]]
    return questions, docs


FEW = "alpha beta gamma Delta épée 数据 gmv_7d x1 the of".split()
MANY = [f"w{i}" for i in range(400)]


@pytest.mark.parametrize("k", [1, 3, 10])
@pytest.mark.parametrize("vocabulary, weights", [(FEW, None), (MANY, [1 / (i + 1) for i in range(400)])])
def test_whole_texts_equal_brute_force(spark, monkeypatch, k, vocabulary, weights):
    monkeypatch.setattr(retrieval, "BLOCK_BITS", 3)  # many blocks a list, few champions a word
    monkeypatch.setattr(retrieval, "CHAMPIONS", 2)
    questions, docs = texts(k, vocabulary, weights)
    sections = [(d, n, s) for d, t in docs for n, s in enumerate(t.split("\n## "))]
    assert run(spark, questions, docs, k) == brute_force(questions, sections, k)


def test_fewer_sections_than_asked_for_and_none(spark):
    assert len(run(spark, [(1, "a"), (2, "b")], [(1, "a"), (2, None)])) == 2
    q = spark.createDataFrame([(1, "a")], "question_id long, question string")
    none = spark.createDataFrame([], "doc_id long, text string")
    assert retrieval.topk_by_overlap(q, retrieval.split_sections(none)).count() == 0
    assert retrieval.topk_by_overlap(q.limit(0), retrieval.split_sections(none)).count() == 0
    with pytest.raises(ValueError):
        retrieval.topk_by_overlap(q, retrieval.split_sections(none), 101)


def test_lists_are_in_order_of_impact_and_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(retrieval, "BLOCK_BITS", 4)
    _, docs = texts(3, MANY)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    index = retrieval.build_index(retrieval.split_sections(d), str(tmp_path))
    sizes = {r.sid: r.n_words for r in index.sections.collect()}
    order = [sizes[i] for i in sorted(sizes)]
    assert order == sorted(order, reverse=True)
    for r in index.postings.collect():
        assert len(r.sids) <= 16 and r.largest == max(sizes[i] for i in r.sids) and r.sids == sorted(r.sids)
    again = retrieval.open_index(spark, str(tmp_path))
    assert again.postings.count() == index.postings.count()


def test_blocks_that_cannot_matter_are_not_read(spark, tmp_path, monkeypatch):
    """One long section holds every word; thousands of short ones hold a frequent one."""
    monkeypatch.setattr(retrieval, "BLOCK_BITS", 6)
    rows = [(i, " ".join(f"rare{j}" for j in range(30)) + " common") for i in range(3)] + [(i, "common x") for i in range(3, 3000)]
    index = retrieval.build_index(retrieval.split_sections(spark.createDataFrame(rows, "doc_id long, text string")), str(tmp_path))
    asked = spark.createDataFrame([(1, ["common", *[f"rare{j}" for j in range(30)]])], "question_id long, words array<string>")
    assert retrieval.candidates(asked, index, 3).distinct().count() == 3
    short = spark.createDataFrame([(1, ["common"])], "question_id long, words array<string>")
    assert retrieval.candidates(short, index, 3).distinct().count() == 3000  # all of them tie


def test_no_python_and_no_pairing(spark, sf_dir):
    text = plan_of(QUERIES["keyword_topk_retrieval"](spark, sf_dir))
    assert not re.search("MapIn|EvalPython|CartesianProduct|BroadcastNestedLoop", text)
    assert "documents.parquet" not in text


def test_many_questions_in_one_job(spark, sf_dir):
    """Thousands of questions; each finds the section it was cut from."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("length(text) BETWEEN 200 AND 5000").select("doc_id", "text")
    sections = retrieval.split_sections(docs)
    asked = sections.withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(59)))).select(
        F.xxhash64("doc_id", "section_no", "n").alias("question_id"), F.substring("section", 1, 300).alias("question"))
    found = retrieval.topk_by_overlap(asked, sections, 1)
    q = asked.withColumn("size", F.size(retrieval.distinct_words("question")))
    assert asked.count() > 5_000
    lost = q.join(found, "question_id", "left").where("overlap IS NULL OR overlap < size - 1")
    assert lost.count() == 0
    assert "MapIn" not in final_plan(found.limit(1))
