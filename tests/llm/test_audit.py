"""The filter audit against a plain recomputation on odd rows."""

import re
from itertools import permutations

import pytest

from tidemart.llm import audit

GOOD = " ".join(f"word{i}" for i in range(120))
LONG = " ".join(f"w{i}" for i in range(40_000))
ROWS = [
    (1, GOOD, "en"), (2, GOOD, "en"), (2, GOOD, "en"), (1, GOOD, "fr"), (3, None, None), (4, "", "en"), (5, " \t\x0b\n", ""),
    (6, GOOD + " $", "en"), (7, GOOD.upper(), "fr"), (8, "same " * 150, "fr"), (9, LONG, "en"), (None, GOOD, "en"), (None, None, None),
    (10, "a\xa0b " * 60, "de"), (11, "a\x1cb \x85 c", "de"), (12, "ÀÉ" * 300, "de"), (13, "ab|", "en"), (14, "same " * 150, "en"),
    (-9_000_000_000_000_000_000, GOOD + " $", "en"), (15, GOOD.upper() + " %", "fr"), (16, "🙂" * 10 + "A", None),
]
LABELS = [(1, 1, 0), (1, 0, 1), (2, 1, None), (3, None, 1), (6, 1, 1), (None, 1, 1), (99, 1, 1), (9, 0, 0), (13, 1, 1)]


def plain(rows, labels):
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    docs = []
    for i, t, lang in rows:
        t, words = t or "", re.findall(r"[^\x20\x09-\x0D]+", t or "")
        fails = {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), "D": bool(re.search(r"[#$%&*|]", t)),
            "E": i is not None and i > first[t]}
        marked = [q for q in labels if q[0] == i and i is not None]
        docs.append((lang or "", {f for f in fails if fails[f]}, any(q[1] == 1 for q in marked), any(q[2] == 1 for q in marked)))
    out = {}
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            for step, f in enumerate(order):
                before = set(order[:step])
                gone = [d for d in own if f in d[1] and not d[1] & before]
                total[f] += len(gone)
                out[part, order, step + 1] = [
                    sum(not d[1] & (before | {f}) for d in own), len(gone), sum(f in d[1] and bool(d[1] & before) for d in own),
                    sum(d[1] == {f} for d in own), sum(d[2] for d in gone), sum(d[3] for d in gone)]
        for order in map("".join, permutations("ABCDE")):
            for step, f in enumerate(order):
                out[part, order, step + 1].append(total[f])
    return out


def tables(spark, rows, labels):
    docs = spark.createDataFrame([(*r, 1, "d", 2) for r in rows], "doc_id long, text string, lang string, mask int, digest string, n int")
    return docs, spark.createDataFrame([(*r, "x") for r in labels], "doc_id long, quality int, toxic int, part string")


@pytest.mark.parametrize("labels", [LABELS, []])
def test_every_count(spark, labels):
    got = audit.audit(*tables(spark, ROWS, labels)).collect()
    assert {(r.part, r.filter_order, r.step): list(r[3:]) for r in got} == plain(ROWS, labels)
    assert len(got) == 600 * 4


def test_an_empty_table_has_no_parts(spark):
    docs, labels = tables(spark, ROWS, LABELS)
    assert audit.audit(docs.limit(0), labels).count() == 0


def test_many_copies_of_one_text(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'x', concat('t', id)) AS text", "if(id % 2 = 0, 'en', 'fr') AS lang")
    got = audit.audit(docs, tables(spark, [], LABELS)[1]).where("filter_order = 'EABCD' AND step = 1").collect()
    copies = [i for i in range(0, 20_000, 3) if i > 0]
    assert {r.part: r.removed for r in got} == {"en": sum(i % 2 == 0 for i in copies), "fr": sum(i % 2 for i in copies)}
