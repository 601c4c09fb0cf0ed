from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import differences
from tidewell.plans.oracle import SQL
from tidewell.plans.queries import QUERIES


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, con, small, name):
    problem, *_ = differences(spark, con, name, small)
    assert problem is None, problem


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())
    assert set(QUERIES) <= set(queries()) and set(SQL) <= set(oracle_sql())
    assert set(QUERIES) - set(SQL) == {"model_score_agreement"}


def test_entry(spark):
    assert entry(spark).count() == 3683


def test_records_of_files_read_by_one_task_are_shared_out(spark, tmp_path):
    """Raw records are made and parsed by as many tasks as there are cores, and none is lost or changed."""
    from tidewell.plans.queries import mixed_raw
    from tidewell.sources import star

    rows = {
        "nation": ("n_nationkey bigint, n_name string", [(0, "OAK LAND")]),
        "customer": ("c_custkey bigint, c_name string, c_nationkey bigint, c_mktsegment string, c_acctbal double",
                     [(i, f"name {i}", 0, "seg", i - 20.0) for i in range(40)] + [(7, "name 7", 0, "seg", -13.0)]),
        "part": ("p_partkey bigint, p_name string, p_type string, p_retailprice double, p_size int, p_brand string",
                 [(i, f"part {i}", "type", 1.5 * i, i, "b") for i in range(40)] + [(None, "none", "type", 1.0, 1, "b")]),
        "events": ("event_id bigint, ts timestamp, props string", [(i, None, f'{{"a": {i}}}') for i in range(40)] + [(None, None, None)]),
        "documents": ("doc_id bigint, text string, source string", [(i, f"text {i}", "s") for i in range(40)] + [(3, "text 3", "s"), (None, None, None)]),
    }
    for name, (schema, values) in rows.items():
        spark.createDataFrame(values, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    for make, held in ((star.raw_customers, 82), (star.raw_services, 82), (mixed_raw, 83)):
        raw = make(spark, str(tmp_path))
        assert raw.rdd.getNumPartitions() >= cores and raw.count() == held
