"""Star schema and marts.

Join strategy: the latest rate is a global aggregate, so it is at most one
row by construction; it is attached as a scalar subquery (J2), evaluated
once and inlined as a value, instead of a cross join.  Dimension joins in
`star_view` carry no hint: dim_account grows with the number of accounts,
and dim_date / dim_rule are small but data-derived, so the choice is left to
AQE, which broadcasts a side only after measuring it below
`spark.sql.adaptive.autoBroadcastJoinThreshold` and otherwise keeps the
sort-merge join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.calendar import calendar_columns, date_key, text_key
from vigil.functions.money import exact_avg, exact_ratio, pct
from vigil.functions.rules import describe_rule


def dim_account(stg: DataFrame) -> DataFrame:
    """A3: per origin account: flag count, amount stats, time span, commonest rule.

    Rows are first folded to one per account and rule by plain hash aggregates, so a
    hot account is reduced map-side; an account then has as many rows as rules.
    Of equally common rules the first by name counts.
    """
    amt, rule = F.col("amount"), F.col("rule_name")
    per_rule = stg.groupBy("origin_account", "rule_name").agg(
        F.count(F.lit(1)).alias("_n"), F.count(amt).alias("_amounts"), F.sum(amt).alias("_sum"),
        F.max(amt).alias("_max"), F.min("event_time").alias("_first"), F.max("event_time").alias("_last"))
    commonest = F.when(rule.isNotNull(), F.struct(-F.col("_n"), rule))  # rows without a rule are passed over
    total = F.sum("_sum").cast("decimal(28,2)")
    return (per_rule.groupBy("origin_account").agg(
        F.sum("_n").alias("total_flags"),
        total.alias("total_flagged_amount"),
        exact_ratio(total, F.sum("_amounts"), 6, 2).alias("avg_flagged_amount"),
        F.max("_max").alias("max_single_flagged_amount"),
        F.min("_first").alias("first_seen_at"),
        F.max("_last").alias("last_seen_at"),
        F.min_by(rule, commonest).alias("most_common_rule"),
        F.count(rule).alias("distinct_rules_triggered"),
    ).select(
        text_key(F.col("origin_account")).alias("account_key"),
        F.col("origin_account").alias("account_id"),
        "total_flags", "total_flagged_amount",
        "avg_flagged_amount", "max_single_flagged_amount", "first_seen_at", "last_seen_at",
        "most_common_rule", "distinct_rules_triggered",
    ))


def dim_date(stg: DataFrame, pad_names: bool = False) -> DataFrame:
    """A4: one row per distinct event date with calendar attributes."""
    d = stg.select(F.col("event_date").alias("calendar_date")).distinct()
    return d.select(*calendar_columns(F.col("calendar_date"), pad_names))


def dim_rule(stg: DataFrame) -> DataFrame:
    """A5: distinct non-null rule names with md5 key and description."""
    r = stg.where(F.col("rule_name").isNotNull()).select("rule_name").distinct()
    return r.select(text_key(F.col("rule_name")).alias("rule_key"), "rule_name",
                    describe_rule(F.col("rule_name")).alias("rule_description"))


def latest_rate(rates: DataFrame) -> DataFrame:
    """The newest rate as a 0- or 1-row frame (no rates -> no row, N9)."""
    newest = [F.col(c) for c in ("rate_date", "loaded_at", "usd_lkr_rate") if c in rates.columns]
    return (rates.where(F.col("rate_date").isNotNull())
            .agg(F.max_by("usd_lkr_rate", F.struct(*newest)).alias("usd_lkr_rate"),
                      F.max("rate_date").alias("rate_date"),
                      F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") > 0).drop("_n"))


def _latest_rate_value(rates: DataFrame):
    """The newest rate as a scalar subquery over a struct, so "no rate row"
    (null struct) stays distinct from a row whose rate is null.  Filtering on
    the struct keeps N9: no rates -> no rows, as the reference's cross join."""
    latest = latest_rate(rates).select(F.struct("usd_lkr_rate").alias("r")).scalar()
    return latest, latest.getField("usd_lkr_rate")


def fact_fraud_events(stg: DataFrame, rates: DataFrame) -> DataFrame:
    """One row per flagged event with keys, degenerate dims, LKR amount.

    The rate is the newest overall (N10), a single aggregate value (J2).
    """
    latest, rate = _latest_rate_value(rates)
    return stg.where(latest.isNotNull()).select(
        "transaction_id",
        date_key(F.col("event_date")).alias("date_key"),
        text_key(F.col("origin_account")).alias("account_key"),
        text_key(F.col("rule_name")).alias("rule_key"),
        "tx_type", "rule_name", "origin_account", "dest_account",
        F.col("amount").alias("amount_usd"),
        F.round(F.col("amount") * rate, 2).cast("decimal(28,2)").alias("amount_lkr"),
        "tx_count_5m", "total_amount_5m", "max_amount_5m", "geo_impossible",
        "event_time", "event_date", "detected_at",
    )


def mart_loan_risk(stg_loans: DataFrame, rates: DataFrame) -> DataFrame:
    """Loans by grade and intent with default rate and rounded averages.

    Aggregated first, then given the single latest rate (a scalar subquery;
    no rates -> no rows, N9).  Averages are exact sums divided once (no
    double rounding).
    """
    n = F.count(F.lit(1))
    g = stg_loans.groupBy("loan_grade", "loan_intent").agg(
        n.alias("total_loans"),
        F.sum("loan_status").alias("total_defaults"),
        F.sum("loan_amnt").cast("decimal(24,2)").alias("_amt_sum"),
        F.count("loan_amnt").alias("_amt_n"),
        exact_avg("loan_amnt", 2, 2, out_precision=18).alias("avg_loan_amnt_usd"),
        exact_avg("loan_int_rate", 3, 3, out_precision=10).alias("avg_interest_rate"),
        exact_avg("person_income", 2, 2, out_precision=18).alias("avg_person_income"),
    )
    latest, rate = _latest_rate_value(rates)
    lkr = exact_ratio(F.col("_amt_sum") * rate, F.col("_amt_n"), 2, 6, 18)
    return (g.where(latest.isNotNull()).select(
        "loan_grade", "loan_intent", "total_loans",
        F.col("total_defaults").cast("bigint").alias("total_defaults"),
        pct(F.col("total_defaults"), F.col("total_loans")).alias("default_rate_pct"),
        "avg_loan_amnt_usd",
        lkr.alias("avg_loan_amnt_lkr"),
        "avg_interest_rate", "avg_person_income", rate.alias("usd_lkr_rate"),
    ).orderBy("loan_grade", "loan_intent"))


def star_view(fact: DataFrame, d_date: DataFrame, d_account: DataFrame, d_rule: DataFrame,
              hot_rows: int | None = None) -> DataFrame:
    """Fact left-joined to its three dimensions for BI queries.

    dim_date has one row per calendar day (a proven bound) and is broadcast;
    dim_rule is left to AQE; dim_account grows with accounts and is joined
    with salting on accounts whose flag count (known from the dimension)
    makes them hot, so one account's events are spread over several tasks.
    """
    from vigil.operators.joins import HOT_ROWS, salted_left_join
    acct = d_account.select("account_key", "total_flags", "most_common_rule", "distinct_rules_triggered")
    v = fact.join(F.broadcast(d_date.drop("full_date")), "date_key", "left")
    v = salted_left_join(v, acct, "account_key", F.col("total_flags"), hot_rows or HOT_ROWS)
    return v.join(d_rule.select("rule_key", "rule_description"), "rule_key", "left")


def amount_lkr_asof(stg: DataFrame, rates: DataFrame) -> DataFrame:
    """J5 (intent): convert with the rate of the event's day, else the newest earlier one.

    Exact as-of join as an equi-join on the month, built from the rates alone.  A month with
    rates is one row that holds them (31 at most) and is broadcast; events of other months, and of days before the
    first rate of theirs, take the last rate of the newest earlier month from a ladder of one entry
    per month with rates (a scalar subquery).  Nothing is expanded over the days between two rates, so a
    rate far in the future costs one row.  Both are bounded by the months that have rates, not
    by the data; the events are read once and never shuffled for this join.
    """
    known = rates.where(F.col("rate_date").isNotNull() & F.col("usd_lkr_rate").isNotNull())
    # one rate a date: of several the one loaded last, then the larger
    newer = [F.col(c) for c in ("loaded_at", "usd_lkr_rate") if c in known.columns]
    known = known.groupBy("rate_date").agg(F.max_by("usd_lkr_rate", F.struct(*newer)).alias("usd_lkr_rate"))

    def month(d: str):
        return F.year(d) * 12 + F.month(d)

    months = known.groupBy(month("rate_date").alias("_month")).agg(
        F.collect_list(F.struct(F.col("rate_date").alias("d"), F.col("usd_lkr_rate").alias("rate"))).alias("_rates"))
    ladder = months.agg(F.collect_list(F.struct(F.col("_month").alias("m"), F.array_max("_rates").getField("rate").alias("rate")))).scalar()
    rows = stg.withColumns({"_event_month": month("event_date"), "_ladder": ladder}).join(
        F.broadcast(months), F.col("_event_month") == F.col("_month"), "left")
    today = F.array_max(F.filter("_rates", lambda r: r.getField("d") <= F.col("event_date"))).getField("rate")
    before = F.array_max(F.filter("_ladder", lambda r: r.getField("m") < F.col("_event_month"))).getField("rate")
    return (rows.withColumn("rate_asof", F.coalesce(today, before)).drop("_event_month", "_ladder", "_month", "_rates")
            .withColumn("amount_lkr_asof", F.round(F.col("amount") * F.col("rate_asof"), 2)
                        .cast("decimal(28,2)")))
