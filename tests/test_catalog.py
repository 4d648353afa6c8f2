"""Every query of the catalogue runs, and agrees with its SQL where it has one."""

import math
import os

import duckdb
import pytest

from marlspan.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return c


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    return f"{v:.5f}" if isinstance(v, float) else str(v)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(columns), sorted(tuple(cell(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", catalog.QUERIES)
def test_query(spark, db, name):
    df = catalog.QUERIES[name](spark, SF)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    if name in catalog.ORACLES:
        cursor = db.cursor()
        cursor.execute(catalog.ORACLES[name])
        names = [d[0] for d in cursor.description]
        assert got == canonical(names, cursor.fetchall())
    else:
        assert got[1]
