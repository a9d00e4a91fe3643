"""Every query with an oracle gives the oracle's rows."""

import datetime
import decimal
import os

import duckdb
import pytest

from noticeworks import catalogue

SF = "/root/testdata/sf0.001"


def canonical(rows, columns, order):
    def one(v):
        if isinstance(v, float):
            return f"{v:.9g}"
        if isinstance(v, datetime.datetime):
            return v.replace(tzinfo=None).isoformat()
        if isinstance(v, decimal.Decimal):
            return str(v)
        return v

    at = [columns.index(c) for c in order]
    return sorted((tuple(one(r[i]) for i in at) for r in rows), key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in os.listdir(SF):
        c.execute(f"CREATE VIEW {t.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{t}'")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = catalogue.queries()[name](spark, SF)
    order = sorted(df.columns)
    answer = duck.execute(catalogue.oracle_sql()[name])
    columns = [d[0] for d in answer.description]
    assert sorted(columns) == order
    assert canonical([tuple(r) for r in df.collect()], df.columns, order) == canonical(answer.fetchall(), columns, order)


def test_every_query_has_an_oracle():
    assert set(catalogue.queries()) == set(catalogue.oracle_sql())
