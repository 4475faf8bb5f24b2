"""License scans: texts that share no shingle with a template are left out early, others never."""

import random

from pyspark.sql import functions as F

from tidemart.llm import licenses

DOCS = "doc_id long, text string"


def noisy(seed):
    """Texts of templates with words lost, among other words; and texts of other words alone."""
    rnd = random.Random(seed)
    other = [f"w{i}" for i in range(50)]
    rows = [(None, None), (0, ""), (0, "of any")]
    for i in range(120):
        words = [w for w in rnd.choice(licenses.TEMPLATES)[1].split() if rnd.random() > 0.02 * (i % 4)]
        rows.append((i % 100, " ".join(rnd.choices(other, k=rnd.randrange(30)) + words * (i % 3 > 0) + rnd.choices(other, k=9))))
    return rows


def test_only_texts_with_a_shingle_of_a_template_are_looked_at(spark):
    known = spark.sql("SELECT array(1L, 2L, 3L) AS th UNION ALL SELECT array(3L, 7L)")
    hashed = spark.createDataFrame([(1, [9, 7]), (2, [8, 9]), (3, []), (4, [1]), (4, [1])], "doc_id long, h array<long>")
    assert sorted(r.doc_id for r in licenses.sharing(hashed, known).collect()) == [1, 4, 4]
    assert licenses.sharing(hashed, known.limit(0)).count() == 0


def test_results_are_those_of_looking_at_every_text(spark, monkeypatch):
    docs, notices = spark.createDataFrame(noisy(5), DOCS), licenses.templates(spark)
    early = licenses.find_licenses(docs, notices)
    assert "arrays_overlap" in early._jdf.queryExecution().toString()
    found = sorted(map(tuple, early.select(F.coalesce("doc_id", F.lit(-1)), "text_key", "template_id", "containment").collect()))
    monkeypatch.setattr(licenses, "PROBED_ROWS", 0)
    every = licenses.find_licenses(docs, notices)
    assert "arrays_overlap" not in every._jdf.queryExecution().toString()
    assert found == sorted(map(tuple, every.select(F.coalesce("doc_id", F.lit(-1)), "text_key", "template_id", "containment").collect()))
    assert len(found) > 40
