"""Physical plans of the registered queries."""

import pytest

from fieldlake.operators import enrich
from fieldlake.operators.quality import gate, keep_category
from fieldlake.plans.sensors import run_stress_test
from fieldlake.sinks.writers import _by_day
from fieldlake.sources.tables import read_table
from workload import QUERIES
from workload.views import sensors, table

# The only queries with Arrow kernels; everything else stays in the JVM.
WITH_PYTHON = {
    "leave_one_out_importance",
    "linear_attribution",
    "text_embedding_topk",
    "vector_topk_batch",
    "vector_self_topk",
    "soil_files_round_trip",
    "ivf_pruned",
    "ivf_recall",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_joins_and_no_unexpected_python(spark, sf_dir, plan_of, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    if name not in WITH_PYTHON:
        assert not any(kind in plan for kind in ("ArrowEvalPython", "MapInPandas", "MapInArrow"))


def test_scans_read_the_needed_columns_only(spark, sf_dir, plan_of):
    plan = plan_of(QUERIES["linear_fit_by_group"](spark, sf_dir))
    assert "ReadSchema: struct<l_quantity:double,l_extendedprice:double,l_returnflag:string>" in plan


def test_filters_reach_the_scan(spark, sf_dir, plan_of):
    plan = plan_of(keep_category(table(spark, sf_dir, "events"), "event_type", "click").select("value"))
    assert "EqualTo(event_type,click)" in plan and "ReadSchema: struct<event_type:string,value:double>" in plan


def test_means_combine_before_the_shuffle(spark, sf_dir, plan_of):
    plan = plan_of(QUERIES["sensor_gate_by_field"](spark, sf_dir))
    assert "partial_avg" in plan and plan.count("hashpartitioning") == 1


def test_load_lets_aqe_split_large_days(spark, sf_dir, plan_of):
    plan = plan_of(_by_day(gate(sensors(spark, sf_dir)), "timestamp", "day", ["field_id"]))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


def test_catalog_table_source(spark):
    spark.range(3).write.mode("overwrite").saveAsTable("three_rows")
    assert read_table(spark, "three_rows").count() == 3


def test_generated_stress_test(spark):
    rows = {r["metric"]: r for r in run_stress_test(spark, 200).collect()}
    assert set(rows) == {"avg_moisture", "avg_temperature", "avg_ph"}
    assert rows["avg_temperature"]["delta"] == pytest.approx(4.0)
    assert rows["avg_moisture"]["drought"] == pytest.approx(rows["avg_moisture"]["baseline"] / 2)
    assert rows["avg_ph"]["delta"] == 0.0


def test_integration_reads_its_tables_seldom(spark, sf_dir, monkeypatch, plan_of):
    read = []
    plans = lambda df: read.append(plan_of(df).count("lineitem.parquet]"))
    kept = enrich.materialise
    monkeypatch.setattr(enrich, "materialise", lambda df, name: plans(df) or kept(df, name))
    plans(QUERIES["integrate_full"](spark, sf_dir))
    assert read == [1, 1]  # the sums per year, and the rows
