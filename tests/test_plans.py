"""What the physical plans must not lose."""
from __future__ import annotations

import re
from pathlib import Path

import pytest

from pitf.catalog import registered
from pitf.operators import features as ft
from pitf.operators import labels as lb
from pitf.operators import sweep as sw
from pitf.sources import sample_tables as st
from pitf.sources.sample_tables import CUTOFF, WINDOW

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="sample tables not present")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_transactions_are_aggregated_in_one_shuffle(spark):
    text = plan(ft.transaction_profile(st.transactions(spark, SF), CUTOFF, WINDOW))
    assert len(re.findall(r"\bExchange\b", text)) == 1 and "partial_stddev_samp" in text
    assert "LessThan(o_orderdate" in text.split("PushedFilters")[1]


def test_transaction_state_has_a_fixed_width(spark):
    text = plan(ft.transaction_profile(st.transactions(spark, SF), CUTOFF, WINDOW))
    assert "HashAggregate" in text and "ObjectHashAggregate" not in text and "SortAggregate" not in text


def test_labels_read_two_columns(spark):
    text = plan(lb.build_labels(st.transactions(spark, SF), CUTOFF, WINDOW))
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp>" in text
    assert len(re.findall(r"\bExchange\b", text)) == 1


def test_snapshot_filters_reach_the_scans(spark):
    raw = st.raw_tables(spark, SF)
    text = plan(ft.feature_snapshot(raw["customers"], raw["enrollments"], raw["transactions"], raw["crm"], CUTOFF))
    assert "LessThan(l_shipdate" in text and "LessThan(o_orderdate" in text


@pytest.mark.parametrize("name", ["feature_table", "label_sweep", "cutoff_feasibility", "adaptive_cutoff",
                                  "labels_relative", "gate_decisions", "registry_promoted", "score_drift",
                                  "feature_drift", "candidate_metrics", "monthly_activity_profile"])
def test_no_pairwise_joins(spark, name):
    text = plan(registered.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_top_row_per_key_is_cut_before_the_shuffle(spark):
    text = plan(registered.queries()["registry_latest"](spark, SF))
    assert "WindowGroupLimit" in text


def test_sweep_orders_steps_not_events(spark):
    tx = st.transactions(spark, SF)
    text = plan(sw.customer_steps(tx, sw.candidate_cutoffs(tx)))
    window = text.index("Window [")
    assert "HashAggregate" in text[window:] and "partial_count" in text[window:]


def test_feasibility_sweeps_stored_steps(spark):
    text = plan(registered.queries()["cutoff_feasibility"](spark, SF))
    assert "o_orderdate" not in text and "previous_step" in text
