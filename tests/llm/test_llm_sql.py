"""The queries of this package against their SQL."""

import pytest

from tests.helpers import bag
from tidemart.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    cur = duck.execute(ORACLES[name])
    columns = [d[0] for d in cur.description]
    got, want = df.collect(), cur.fetchall()
    assert sorted(df.columns) == sorted(columns) and len(got) == len(want) > 0
    assert bag(df.columns, got) == bag(columns, want)


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
