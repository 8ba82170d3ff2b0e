"""Shared pieces of the query catalogue: the oracle's table mapping and rounding.

Every query maps a name to (Spark callable, oracle SQL or None). The SQL is
written the direct way (self joins, one pass per window), independent of how
the Spark side computes the same thing.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitf.operators.features import DAYS_PER_YEAR, FEATURE_COLUMNS
from pitf.sources.sample_tables import CUTOFF, EVENT_SHIFT_DAYS, WINDOW

TABLES = {
    "customers": """SELECT c_custkey AS customer_id,
        CASE c_custkey % 4 WHEN 0 THEN 'Female' WHEN 2 THEN 'FEMALE' ELSE 'Male' END AS gender,
        CASE WHEN c_custkey % 50 <> 0
             THEN CAST(DATE '1940-01-01' + CAST(c_custkey * 37 % 14000 AS INTEGER) AS TIMESTAMP) END AS date_of_birth,
        CAST(DATE '1994-01-01' + CAST(c_custkey * 13 % 1800 AS INTEGER) AS TIMESTAMP) AS signup_date
        FROM customer""",
    "transactions": """SELECT o_custkey AS customer_id, o_totalprice AS transaction_amount,
        o_totalprice AS closing_balance, o_orderdate AS transaction_date, o_orderkey AS transaction_id FROM orders""",
    "enrollments": """SELECT l_partkey AS product_id, o_custkey AS customer_id,
        CASE p_type WHEN 'STANDARD' THEN 'Savings' WHEN 'PROMO' THEN 'Credit Card' ELSE p_type END AS product_type,
        l_shipdate AS enrollment_date, l_extendedprice AS credit_limit
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "crm": f"""SELECT event_id AS interaction_id, user_id AS customer_id,
        CASE event_type WHEN 'click' THEN 'Chat' WHEN 'view' THEN 'Email' WHEN 'error' THEN 'Call'
             ELSE event_type END AS interaction_type,
        ts - INTERVAL {EVENT_SHIFT_DAYS} DAY AS interaction_date FROM events""",
}

MONEY = {"total_credit_limit": 2, "txn_amount_sum": 2, "closing_balance_last": 2}
# Means of cent amounts often end in an exact 5 where rounding would hang on the
# order of addition; a shift far below the last digit shown decides such ties.
MEANS = {"txn_amount_mean", "avg_amount", "avg_closing_balance"}
MEAN_PLACES, TIE_SHIFT = 4, 1.3e-7


def mean_sql(expression: str, name: str) -> str:
    return f"round(CAST({expression} AS DOUBLE) + {TIE_SHIFT}, {MEAN_PLACES}) AS {name}"


def with_ctes(body: str, **ctes: str) -> str:
    """``body`` behind the table mapping and further named subqueries, in order."""
    parts = [f"{name} AS ({text})" for name, text in {**TABLES, **ctes}.items()]
    return "WITH " + ",\n".join(parts) + "\n" + body


def ts_literal(day: str) -> str:
    return f"TIMESTAMP '{day} 00:00:00'"


def days_sql(cut: str, ts: str) -> str:
    return f"CAST(floor((epoch({cut}) - epoch({ts})) / 86400) AS BIGINT)"


def feature_ctes(cut: str, suffix: str = "") -> dict[str, str]:
    """Subqueries ending in ``features{suffix}``: each part its own scan and join."""
    s = suffix

    def days(ts: str) -> str:
        return days_sql(cut, ts)

    zero = {c: f"coalesce({c}, 0)" for c in FEATURE_COLUMNS}
    recency = ("days_since_first_enrollment", "last_txn_recency_days", "first_txn_age_days", "crm_recency_days")
    zero |= {c: f"greatest(coalesce({c}, greatest(coalesce(tenure, 0), 0)), 0)" for c in recency}
    zero["tenure_days"] = "greatest(coalesce(tenure, 0), 0)"
    zero["age_years"] = (f"coalesce(age_days, (SELECT quantile_disc(age_days, 0.5) FROM demo{s}), 0) "
                         f"/ CAST({DAYS_PER_YEAR} AS DOUBLE)")
    columns = ", ".join(
        mean_sql(zero[c], c) if c in MEANS else f"round(CAST({zero[c]} AS DOUBLE), {MONEY.get(c, 6)}) AS {c}"
        for c in FEATURE_COLUMNS)
    return {
        f"demo{s}": f"""SELECT customer_id, {days('signup_date')} AS tenure, {days('date_of_birth')} AS age_days,
            CASE WHEN lower(gender) = 'female' THEN 1 ELSE 0 END AS is_female FROM customers""",
        f"enr{s}": f"""SELECT customer_id, count(DISTINCT product_id) AS num_products,
            max(CASE WHEN product_type = 'Savings' THEN 1 ELSE 0 END) AS has_savings,
            max(CASE WHEN product_type = 'Credit Card' THEN 1 ELSE 0 END) AS has_credit_card,
            sum(credit_limit) AS total_credit_limit,
            {days('min(enrollment_date)')} AS days_since_first_enrollment
            FROM enrollments WHERE enrollment_date < {cut} GROUP BY customer_id""",
        f"tx{s}": f"""SELECT customer_id, count(*) AS txn_count, sum(transaction_amount) AS txn_amount_sum,
            avg(transaction_amount) AS txn_amount_mean, stddev_samp(transaction_amount) AS txn_amount_std,
            {days('max(transaction_date)')} AS last_txn_recency_days,
            {days('min(transaction_date)')} AS first_txn_age_days,
            count(DISTINCT strftime(transaction_date, '%Y-%m')) AS active_months
            FROM transactions WHERE transaction_date < {cut} GROUP BY customer_id""",
        f"last_row{s}": f"""SELECT customer_id, closing_balance AS closing_balance_last FROM (
            SELECT customer_id, closing_balance, row_number() OVER (
                PARTITION BY customer_id ORDER BY transaction_date DESC, transaction_id DESC) AS rn
            FROM transactions WHERE transaction_date < {cut}) WHERE rn = 1""",
        f"c30{s}": f"""SELECT customer_id, count(*) AS txn_count_30d FROM transactions
            WHERE transaction_date < {cut} AND transaction_date >= {cut} - INTERVAL 30 DAY GROUP BY customer_id""",
        f"c90{s}": f"""SELECT customer_id, count(*) AS txn_count_90d FROM transactions
            WHERE transaction_date < {cut} AND transaction_date >= {cut} - INTERVAL 90 DAY GROUP BY customer_id""",
        f"cr{s}": f"""SELECT customer_id, count(*) AS crm_count,
            sum(CASE WHEN interaction_type = 'Chat' THEN 1 ELSE 0 END) AS crm_count_chat,
            sum(CASE WHEN interaction_type = 'Email' THEN 1 ELSE 0 END) AS crm_count_email,
            sum(CASE WHEN interaction_type = 'Call' THEN 1 ELSE 0 END) AS crm_count_call,
            {days('max(interaction_date)')} AS crm_recency_days
            FROM crm WHERE interaction_date < {cut} GROUP BY customer_id""",
        f"cr90{s}": f"""SELECT customer_id, count(*) AS crm_count_90d FROM crm
            WHERE interaction_date < {cut} AND interaction_date >= {cut} - INTERVAL 90 DAY GROUP BY customer_id""",
        f"features{s}": f"""SELECT customer_id, {columns} FROM demo{s}
            LEFT JOIN enr{s} USING (customer_id) LEFT JOIN tx{s} USING (customer_id)
            LEFT JOIN last_row{s} USING (customer_id) LEFT JOIN c30{s} USING (customer_id)
            LEFT JOIN c90{s} USING (customer_id) LEFT JOIN cr{s} USING (customer_id)
            LEFT JOIN cr90{s} USING (customer_id)""",
    }


def label_ctes(cut: str, window: int, min_prior: int = 1, churn: str = "forward_txns = 0") -> dict[str, str]:
    """Subqueries ending in ``labels``: eligible customers left-joined to forward counts."""
    return {
        "eligible": f"""SELECT customer_id, count(*) AS prior_txns FROM transactions
            WHERE transaction_date < {cut} GROUP BY customer_id HAVING count(*) >= {min_prior}""",
        "forward": f"""SELECT customer_id, count(*) AS forward_txns FROM transactions
            WHERE transaction_date >= {cut} AND transaction_date < {cut} + INTERVAL {window} DAY
            GROUP BY customer_id""",
        "population": """SELECT customer_id, prior_txns, coalesce(forward_txns, 0) AS forward_txns
            FROM eligible LEFT JOIN forward USING (customer_id)""",
        "labels": f"SELECT customer_id, CASE WHEN {churn} THEN 1 ELSE 0 END AS churn FROM population",
    }


DEFAULT_CUT = ts_literal(CUTOFF)
FEATURES = feature_ctes(DEFAULT_CUT)
LABELS = label_ctes(DEFAULT_CUT, WINDOW)
# A score every engine computes to the same bits: recency against one year.
RECENCY_SCORE = "last_txn_recency_days / (last_txn_recency_days + 365.0::DOUBLE)"
SCORED = {"scored": f"""SELECT customer_id, churn, {RECENCY_SCORE} AS churn_score
    FROM labels JOIN features USING (customer_id)"""}


def recency_score():
    days = F.col("last_txn_recency_days")
    return days / (days + F.lit(365.0))


def rounded(df: DataFrame, places: int = 6, money: dict[str, int] | None = None) -> DataFrame:
    """Round every double column, so sums taken in another order compare equal."""
    money = money or {}

    def shown(name: str, kind: str) -> Column:
        if kind != "double":
            return F.col(name)
        if name in MEANS:
            return F.round(F.col(name) + F.lit(TIE_SHIFT), MEAN_PLACES).alias(name)
        return F.round(name, money.get(name, places)).alias(name)

    return df.select(*[shown(c, t) for c, t in df.dtypes])


def as_text(df: DataFrame, *names: str) -> DataFrame:
    """Dates as ISO text."""
    return df.withColumns({n: F.date_format(n, "yyyy-MM-dd") for n in names})


def as_bigint(df: DataFrame) -> DataFrame:
    """Integer columns widened to BIGINT."""
    return df.select(*[F.col(c).cast("bigint").alias(c) if t == "int" else F.col(c) for c, t in df.dtypes])
