import pytest

from plumbline.llm.queries import ORACLES, QUERIES


def plain(value):
    return f"{value:.9f}" if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, sf_dir, name):
    oracle = duck.execute(ORACLES[name])
    columns = [column[0] for column in oracle.description]
    theirs = sorted(tuple(map(plain, row)) for row in oracle.fetchall())
    df = QUERIES[name](spark, sf_dir)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(tuple(map(plain, row)) for row in df.select(*columns).collect()) == theirs
