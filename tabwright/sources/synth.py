"""Synthetic customers: every draw is a function of (seed, column, id).

The same seed gives the same table for any partitioning. Draws are expressions,
so generation scales out with the id table and needs no shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions.scalar import clip, uniform

# Distributions of the synthetic customer table.
GENDERS = [("M", 0.45), ("F", 0.45), ("Other", 0.1)]
COUNTRIES = [("US", 0.4), ("CA", 0.2), ("UK", 0.15), ("DE", 0.1), ("FR", 0.1), ("AU", 0.05)]
PLANS = [("Basic", 0.6), ("Premium", 0.3), ("Enterprise", 0.1)]
REASONS = [("Price", 0.3), ("Features", 0.25), ("Support", 0.2), ("Competitor", 0.15), ("Other", 0.1)]
REVENUE = {"Basic": (29.0, 5.0), "Premium": (79.0, 10.0), "Enterprise": (199.0, 25.0)}
AGE = (35.0, 12.0, 18, 80)
DURATION = (180.0, 1, 1095)
USAGE_SCALE = (180.0, 0.5, 2.0)
LOGINS, FEATURE_USES, SESSION_MINUTES, PAGE_VIEWS = 15.0, 8.0, 25.0, 50.0
TICKETS, RESOLUTION_DAYS, FAILURES = 0.5, 3.0, 0.2
PAYMENT_GAP = (15.0, 1, 90)
EMAIL_OPENS, EMAIL_CLICKS, POST_CONTACTS = 3.0, 1.0, 0.5
BASE_RISK = 0.15
RISKS = {"tickets": (2, 0.3), "failures": (1, 0.4), "logins": (5, 0.25), "tenure": (30, 0.2)}
BILLING = (0.8, 1.2)
OFFER_ACCEPTED = 0.3
CHURN_START, CHURN_DAYS = "2024-01-01", 29
MISSING = {
    "age": 0.02,
    "gender": 0.01,
    "location_country": 0.01,
    "session_duration_avg": 0.05,
    "support_tickets_avg_resolution_days": 0.1,
}


def normal(mean, sd, u1: Column, u2: Column) -> Column:
    """Box-Muller draw from two uniforms."""
    return mean + sd * F.sqrt(-2.0 * F.ln(1.0 - u1)) * F.cos(F.lit(6.283185307179586) * u2)


def exponential(scale, u: Column) -> Column:
    return -scale * F.ln(1.0 - u)


def choice(options: list[tuple[str, float]], u: Column) -> Column:
    """Weighted pick by cumulative thresholds."""
    out, acc = None, 0.0
    for name, w in options[:-1]:
        acc = round(acc + w, 12)
        out = F.when(u < acc, name) if out is None else out.when(u < acc, name)
    return out.otherwise(options[-1][0])


def poisson_top(rate: float) -> int:
    return int(rate + 12 * rate**0.5 + 20)


def poisson_cdf(rate: float, top: int | None = None) -> list[float]:
    """P(N <= k) for k below ``top``."""
    pmf = math.exp(-rate)
    out = [pmf]
    for k in range(1, top or poisson_top(rate)):
        pmf *= rate / k
        out.append(out[-1] + pmf)
    return out


def poisson(cdf: Column, u: Column) -> Column:
    """Inverse distribution function: how many entries of ``cdf`` are at most u.

    The outer lambda binds u, so that it is drawn once and not per entry.
    """
    return F.transform(F.array(u), lambda x: F.size(F.filter(cdf, lambda c: c <= x)))[0].cast("bigint")


def rate_table(spark: SparkSession, rates: dict[str, float]) -> DataFrame:
    """Distribution functions per subscription length; the usage factor depends on it only.

    A fixed number of rows: the lengths between the two ends of the usage factor.
    """
    days, lo, hi = USAGE_SCALE
    rows = [
        (d, *[poisson_cdf(r * (d / days), poisson_top(r * hi)) for r in rates.values()])
        for d in range(int(days * lo), int(days * hi) + 1)
    ]
    return spark.createDataFrame(rows, "_days bigint, " + ", ".join(f"{n} array<double>" for n in rates))


def customers_for(ids: DataFrame, id_col: str, seed: int = 42, missing: bool = True) -> DataFrame:
    """Synthetic attributes for every id of a table; ``id_col`` is a 1-based number."""

    def u(draw: str) -> Column:
        return uniform(seed, draw, "_id")

    def two(draw: str):
        return u(draw + "1"), u(draw + "2")

    df = ids.select(F.col(id_col).cast("bigint").alias("_id"))
    df = df.select(
        "_id",
        F.format_string("CUST_%06d", F.col("_id")).alias("customer_id"),
        clip(normal(*AGE[:2], *two("age")).cast("bigint"), *AGE[2:]).alias("age"),
        choice(GENDERS, u("gender")).alias("gender"),
        choice(COUNTRIES, u("country")).alias("location_country"),
        choice(PLANS, u("plan")).alias("subscription_type"),
        clip(exponential(DURATION[0], u("duration")).cast("bigint"), *DURATION[1:]).alias("subscription_duration_days"),
    )
    mean = sd = None
    for name, (m, s) in REVENUE.items():
        is_plan = F.col("subscription_type") == name
        mean = F.when(is_plan, m) if mean is None else mean.when(is_plan, m)
        sd = F.when(is_plan, s) if sd is None else sd.when(is_plan, s)
    df = df.select(
        "*",
        clip(normal(mean, sd, *two("revenue")), 0.0).alias("monthly_revenue"),
        clip(F.col("subscription_duration_days") / USAGE_SCALE[0], *USAGE_SCALE[1:]).alias("_use"),
    )
    use = F.col("_use")
    days, lo, hi = USAGE_SCALE
    rates = rate_table(ids.sparkSession, {"_logins": LOGINS, "_uses": FEATURE_USES, "_pages": PAGE_VIEWS})
    df = df.withColumn("_days", clip("subscription_duration_days", int(days * lo), int(days * hi)).cast("bigint"))
    df = df.join(F.broadcast(rates), "_days")  # a few hundred rows, whatever the data

    def fixed(rate: float, draw: str) -> Column:
        return poisson(F.lit(poisson_cdf(rate)), u(draw))

    df = df.select(
        "*",
        poisson(F.col("_logins"), u("logins")).alias("login_frequency"),
        poisson(F.col("_uses"), u("uses")).alias("feature_usage_count"),
        exponential(SESSION_MINUTES * use, u("session")).alias("session_duration_avg"),
        poisson(F.col("_pages"), u("pages")).alias("page_views_total"),
        fixed(TICKETS, "tickets").alias("support_tickets_count"),
        fixed(FAILURES, "failures").alias("payment_failures_count"),
        clip(exponential(PAYMENT_GAP[0], u("gap")).cast("bigint"), *PAYMENT_GAP[1:]).alias("days_since_last_payment"),
        fixed(EMAIL_OPENS, "opens").alias("email_opens_count"),
        fixed(EMAIL_CLICKS, "clicks").alias("email_clicks_count"),
    )
    signs = {
        "tickets": F.col("support_tickets_count") > RISKS["tickets"][0],
        "failures": F.col("payment_failures_count") > RISKS["failures"][0],
        "logins": F.col("login_frequency") < RISKS["logins"][0],
        "tenure": F.col("subscription_duration_days") < RISKS["tenure"][0],
    }
    risk = F.lit(BASE_RISK)
    for name, sign in signs.items():
        risk = risk + F.when(sign, RISKS[name][1]).otherwise(0.0)
    df = df.select("*", (u("churn") < clip(risk, 0.0, 1.0)).alias("_churned"))
    left = F.col("_churned")
    day = F.floor(u("day") * CHURN_DAYS).cast("int") + 1
    df = df.select(
        "_id", "customer_id", "age", "gender", "location_country", "subscription_type", "subscription_duration_days",
        "monthly_revenue", "login_frequency", "feature_usage_count", "session_duration_avg", "page_views_total",
        "support_tickets_count",
        F.when(F.col("support_tickets_count") > 0, exponential(RESOLUTION_DAYS, u("resolution"))).otherwise(0.0)
        .alias("support_tickets_avg_resolution_days"),
        "payment_failures_count", "days_since_last_payment", "email_opens_count", "email_clicks_count",
        left.cast("double").alias("churn_probability"),
        F.when(left, F.date_add(F.lit(CHURN_START).cast("date"), day).cast("timestamp_ntz")).alias("churn_date"),
        F.when(left, choice(REASONS, u("reason"))).alias("cancellation_reason"),
        F.when(left, F.col("monthly_revenue") * (BILLING[0] + (BILLING[1] - BILLING[0]) * u("billing"))).alias("final_billing_amount"),
        F.when(left, u("offer") < OFFER_ACCEPTED).alias("retention_offer_accepted"),
        F.when(left, fixed(POST_CONTACTS, "contacts")).otherwise(0)
        .alias("post_churn_support_contacts"),
    )
    if missing:
        df = df.withColumns({c: F.when(u("missing-" + c) >= rate, F.col(c)) for c, rate in MISSING.items()})
    return df.drop("_id")


def generate(spark: SparkSession, n: int = 500, seed: int = 42, missing: bool = True) -> DataFrame:
    """``n`` synthetic customers, ids from 1."""
    return customers_for(spark.range(1, n + 1), "id", seed, missing)


def save_sample(spark: SparkSession, path: str, n: int = 500, seed: int = 42, fmt: str = "csv", missing: bool = True) -> tuple[int, float]:
    """Write ``n`` synthetic customers as headed CSV or as Parquet; ``(rows, churn rate)`` of what was written."""
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"unknown format: {fmt}")
    df = generate(spark, n, seed, missing)
    out = df.write.mode("overwrite")
    if fmt == "csv":
        out.option("header", True).option("escape", '"').csv(path)
        back = spark.read.schema(df.schema).option("header", True).option("escape", '"').csv(path)
    else:
        out.parquet(path)
        back = spark.read.schema(df.schema).parquet(path)
    rows, rate = back.agg(F.count(F.lit(1)), F.avg("churn_probability")).first()
    return rows, rate
