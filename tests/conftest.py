from __future__ import annotations

import sys
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pitf.session import prepare  # noqa: E402

CUSTOMERS = "customer_id INT, gender STRING, date_of_birth TIMESTAMP, signup_date TIMESTAMP"
ENROLLMENTS = "product_id INT, customer_id INT, product_type STRING, enrollment_date TIMESTAMP, `limit` DOUBLE"
TRANSACTIONS = ("product_id INT, customer_id INT, transaction_amount DOUBLE, closing_balance DOUBLE, "
                "transaction_date TIMESTAMP, transaction_id BIGINT")
CRM = "interaction_id BIGINT, customer_id INT, interaction_type STRING, interaction_date TIMESTAMP"


def ts(text: str) -> datetime:
    """UTC instant, whatever the zone of the test process."""
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def tx_frame(spark, rows):
    """(customer, day[, amount, balance, id]) rows as a transactions frame."""
    full = []
    for i, row in enumerate(rows, 1):
        customer, day, amount, balance, tid = (*row, *(50.0, 50.0, i)[len(row) - 2:])
        full.append((1, customer, amount, balance, ts(day), tid))
    return spark.createDataFrame(full, TRANSACTIONS)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (SparkSession.builder.master("local[4]").appName("tests")
               .config("spark.sql.shuffle.partitions", "3")
               .config("spark.ui.enabled", "false")
               .config("spark.driver.memory", "4g")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()
