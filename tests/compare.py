"""A Spark query against DuckDB's SQL on the same tables."""

import decimal


def plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    return v


def assert_same(spark, duck, query, sql, folder):
    df = query(spark, folder)
    relation = duck.sql(sql)
    names = sorted(df.columns)
    assert names == sorted(relation.columns)
    at = [relation.columns.index(n) for n in names]
    ours = sorted(repr([plain(r[n]) for n in names]) for r in df.collect())
    theirs = sorted(repr([plain(r[i]) for i in at]) for r in relation.fetchall())
    assert ours == theirs
