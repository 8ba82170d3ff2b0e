from __future__ import annotations

import pytest
from conftest import TRANSACTIONS, tx_frame

from pitf.operators.labels import build_labels

CUTOFF = "2024-02-29"  # the window of 90 days ends on 2024-05-29


def churn(spark, rows, **kwargs):
    labels = build_labels(tx_frame(spark, rows), CUTOFF, 90, **kwargs)
    return {r["customer_id"]: r["churn"] for r in labels.collect()}


@pytest.mark.parametrize(("days", "expected"), [
    (["2024-02-28 23:59:59"], 1),
    (["2024-02-28 23:59:59", "2024-02-29"], 0),
    (["2024-02-29"], None),
    (["2023-12-31 06:30:00", "2024-05-28 23:59:59"], 0),
    (["2023-12-31 06:30:00", "2024-05-29"], 1),
    (["2019-08-08", "2024-02-03", "2024-03-17", "2024-09-09"], 0),
    (["2024-04-04", "2024-05-05", "2024-06-06"], None),
])
def test_absolute_label(spark, days, expected):
    assert churn(spark, [(1, d) for d in days]).get(1) == expected


def test_min_prior_transactions(spark):
    rows = [(c, f"2024-02-{d:02d}") for c in (21, 34, 55) for d in range(26, 26 + c % 4)] + [(21, "2024-03-02")]
    assert set(churn(spark, rows, min_prior_txns=2)) == {34, 55}


def active(customer, n):
    return [(customer, "2024-01-20")] + [(customer, f"2024-03-{d:02d}") for d in range(1, n + 1)]


def test_relative_label_equals_absolute_when_many_are_silent(spark):
    rows = [r for c in range(1, 11) for r in active(c, c - 1)]
    assert churn(spark, rows, inactive_percentile=0.10) == churn(spark, rows)


def test_relative_label_counts_the_least_active(spark):
    rows = [r for c in range(1, 11) for r in active(c, c)]
    assert sum(churn(spark, rows).values()) == 0
    relative = churn(spark, rows, inactive_percentile=0.25)
    assert {c for c, flag in relative.items() if flag} == {1, 2, 3}


def test_no_transactions_gives_no_labels(spark):
    nothing = spark.createDataFrame([], TRANSACTIONS)
    assert build_labels(nothing, CUTOFF, 90, inactive_percentile=0.1).collect() == []


def test_missing_dates_are_ignored(spark):
    rows = spark.createDataFrame([(1, 1, 1.0, 1.0, None, 1)], TRANSACTIONS)
    assert build_labels(rows, CUTOFF, 90).collect() == []
