"""The section index moves and repeats words and ids, never texts."""

import random
from pathlib import Path

from pyspark.sql import functions as F

from tidemart.operators import retrieval


def stored_bytes(folder):
    return sum(p.stat().st_size for p in Path(folder).rglob("*.parquet"))


def test_texts_are_stored_once(spark, tmp_path):
    rnd = random.Random(1)
    noise = lambda n: "".join(chr(rnd.randrange(0x2500, 0x2600)) for _ in range(n))  # noqa: E731 - no word in it
    rows = [(i, f"word{i} common {noise(4000)}\n## {noise(50)}") for i in range(150)] + [(200, None), (201, "")]
    sections = retrieval.split_sections(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    index = retrieval.build_index(sections, str(tmp_path))
    texts = stored_bytes(tmp_path / "texts")
    assert texts > 500_000
    assert sum(stored_bytes(tmp_path / t) for t in ("sections", "postings", "words", "last")) < texts / 10
    assert index.texts.count() == index.sections.count() == 301
    assert sorted((r.n_words, r.n) for r in index.sections.groupBy("n_words").agg(F.count("*").alias("n")).collect()) == [(0, 151), (2, 150)]
    asked = spark.createDataFrame([(1, "Word7?"), (2, None)], "question_id long, question string")
    got = retrieval.topk(asked, index, 1).orderBy("question_id").collect()
    assert (got[0].doc_id, got[0].section_no, got[0].overlap, got[0].section) == (7, 0, 1, rows[7][1].split("\n## ")[0])
    assert got[1].overlap == 0 and got[1].section == max(s for _, t in rows if t is not None for s in t.split("\n## "))


def test_lists_of_other_words_are_not_moved(spark, tmp_path):
    rows = [(i, f"asked other{i}") for i in range(50)]
    index = retrieval.build_index(retrieval.split_sections(spark.createDataFrame(rows, "doc_id long, text string")), str(tmp_path))
    asked = spark.createDataFrame([(1, ["asked", "unknown"]), (2, [])], "question_id long, words array<string>")
    pairs = spark.sql("SELECT 1L AS question_id, explode(sequence(0L, 1000L)) AS sid").join(index.sections.select("sid"), "sid")
    counted = retrieval.shared_words(asked, pairs, index)
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [word" in plan
    assert counted.count() == pairs.count() > 0
