"""The queries of the subpackage on the smallest test tables."""

import os

import pytest
from pyspark.sql import functions as F
from oracle import DATA, differences

from inkweir.llm.queries import registry

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


@pytest.mark.parametrize("name", sorted(registry.oracles))
def test_query_equals_its_sql(spark, name):
    only_here, only_there = differences(spark, registry.queries[name], registry.oracles[name])
    assert not only_here and not only_there


#: Queries whose result may be empty on the smallest tables.
MAY_BE_EMPTY = {"p9_near", "p10_found", "p10_reasons"}
#: Column of each query that names documents, instances or sites, which must be those of a table.
NAMES = {"doc_id": "documents", "inst_no": "instances"}


@pytest.mark.parametrize("name", sorted(set(registry.queries) - set(registry.oracles)))
def test_query_gives_whole_rows_once(spark, name):
    """Where SQL can't tell the rows: some are there, none twice, none without its first column or with an
    id that is in no table."""
    df = registry.queries[name](spark, DATA).persist()
    n = df.count()
    assert n > 0 or name in MAY_BE_EMPTY
    assert df.select(*(F.to_json(F.struct(F.col(c))) for c in df.columns)).distinct().count() == n or name in ("p6_sentences", "p2_clean_templates", "p3_clean")
    for column, table in NAMES.items():
        if column in df.columns:
            known = spark.read.parquet(f"{DATA}/{table}.parquet").select(column)
            assert df.join(known, column, "left_anti").count() == 0 and df.where(F.col(column).isNull()).count() == 0
