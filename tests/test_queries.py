import os

import duckdb
import pytest

import __spark_entry__ as contract
from feedback_lens.catalog import coverage

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "embeddings")
CHECKED = ("segments_of_ten", "block_reviews", "zipped_reviews", "merged_collocations", "prepared_reviews",
           "coherence_by_windows", "topics_side_by_side", "similarity_report",
           "shop_job_counts", "shop_job_reviews", "lsa_residuals", "skipped_models")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


def plain(rows, names):
    order = sorted(names)
    where = [names.index(n) for n in order]
    return sorted([tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in where) for r in rows], key=repr)


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_its_sql(spark, name):
    df = contract.queries()[name](spark, SF)
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    found = con.execute(contract.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(names)
    assert plain(df.collect(), df.columns) == plain(found.fetchall(), names)


def test_inventory_is_covered():
    covered = {i for ids in coverage().values() for i in ids.split()}
    wanted = [f"{p}{i}" for p, n in (("S", 9), ("X", 10), ("N", 10), ("P", 9), ("J", 10), ("A", 9), ("W", 4), ("O", 2),
                                     ("U", 3), ("R", 1), ("E", 21), ("M", 15), ("H", 10), ("C", 5)) for i in range(1, n + 1)]
    assert [i for i in wanted if i not in covered] == []
