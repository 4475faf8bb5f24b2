"""Every registered query against its oracle SQL on the same tables."""

import pytest

from tests.helpers import bag
from tidemart.catalog import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    got = df.collect()
    cur = duck.execute(ORACLES[name])
    columns = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert len(got) == len(want)
    a, b = bag(df.columns, got), bag(columns, want)
    assert a == b, (list((a - b).items())[:3], list((b - a).items())[:3])


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", ["late_rows", "late_corrected_pv"])
def test_late_queries_have_late_rows(duck, name):
    rows = f"SELECT COUNT(*) FROM ({ORACLES[name]})" + (" WHERE late_pv > 0" if name == "late_corrected_pv" else "")
    assert duck.execute(rows).fetchone()[0] > 0
