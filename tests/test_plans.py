"""Plan checks: the physical plans the catalogue produces must stay the ones
we want at scale."""

import pytest

from conftest import SF_SMALL
from recsmith.catalog import QUERIES


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def qs():
    return dict(QUERIES)


def test_no_cartesian_and_no_python_in_any_query(spark, qs):
    for name, fn in qs.items():
        p = plan(fn(spark, SF_SMALL))
        assert "CartesianProduct" not in p, name
        assert "BroadcastNestedLoopJoin" not in p, name
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_code_tables_are_broadcast(spark, qs):
    p = plan(qs["star_lookup"](spark, SF_SMALL))
    assert p.count("BroadcastHashJoin") >= 2


def test_row_numbers_do_not_use_a_single_partition(spark, qs):
    """The data is never gathered into one task; the only single-partition
    exchange allowed is over the per-range-partition counts (one row per
    partition) that become the broadcast offsets."""
    for name in ("sort_one", "report_row_no", "header_report", "customer_report"):
        lines = plan(qs[name](spark, SF_SMALL)).splitlines()
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                assert "HashAggregate(keys=[_pid" in lines[i + 1], (name, line)


def test_filters_and_columns_reach_the_scan(spark, qs):
    df = qs["scan_pruned"](spark, SF_SMALL)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_returnflag:string>" in p


def test_first_per_key_combines_map_side(spark, qs):
    p = plan(qs["first_per_key"](spark, SF_SMALL))
    assert "Window" not in p
    assert "partial_min" in p


def test_owners_never_aggregates_the_join_output(spark, qs):
    """The owner dedup runs on the two join inputs; nothing above the join
    (whose output fans out) is an aggregate."""
    lines = plan(qs["owners"](spark, SF_SMALL)).splitlines()
    first_join = next(i for i, line in enumerate(lines) if "Join" in line)
    assert not any("Aggregate" in line for line in lines[:first_join]), lines[:first_join]


def test_latest_generation_prunes_folders(spark, tmp_path):
    from recsmith.sources.readers import latest_generation

    for g in (1, 2, 10):
        spark.range(g).write.parquet(f"{tmp_path}/g/generation={g}")
    df = latest_generation(spark.read.parquet(f"{tmp_path}/g"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "generation" in plan and " = 10)" in plan.split("PartitionFilters")[1].split("]")[0]
    assert plan.count("FileScan") == 1 and df.count() == 10


def test_match_merge_is_lazy_and_shuffles_once(spark):
    from recsmith.operators.joins import match_merge

    left = spark.range(50).selectExpr("id % 7 as k", "id as a")
    right = spark.range(30).selectExpr("id % 5 as k", "id as b")
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup())
    before = jobs()
    out = match_merge(left, right, "k", ["a"], ["b"], skew_safe=False)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert jobs() == before
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    # Left to itself it looks for hot keys in a sample first; the plan is the same without any.
    looked = match_merge(left, right, "k", ["a"], ["b"])._jdf.queryExecution().executedPlan().toString()
    assert jobs() > before and looked.count("Exchange hashpartitioning") == 1 and "Join" not in looked


def test_checkpoint_folder_is_required_on_a_cluster():
    from types import SimpleNamespace

    import pytest

    from recsmith.session import checkpoint_dir

    conf = SimpleNamespace(get=lambda *a: None)
    sc = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="yarn")
    with pytest.raises(ValueError):
        checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=conf))


def test_bucketed_masters_join_without_a_shuffle(spark, qs):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(qs["master_tables"](spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert p.count("SortMergeJoin") == 2 and "Exchange" not in p


def test_party_layouts_share_one_computation(spark, qs):
    p = plan(qs["parties_accounts"](spark, SF_SMALL))
    assert "Join" not in p and p.count("FileScan") == 2
