"""Fraud rules as Column expressions.

A rule is a name plus a function from a `RuleContext` (the columns a rule may
read) to a boolean Column.  `RuleSet.first_match` is the reference's
"first rule in priority order wins" engine written as one `coalesce` of
`when`s, so scoring stays inside whole-stage code generation instead of a
row-at-a-time Python UDF.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------
LARGE_AMOUNT_THRESHOLD = 500_000.0      # amount >= this is "large_amount"
RAPID_FIRE_COUNT_THRESHOLD = 3          # per-account count >= this is "rapid_fire"
ODD_HOURS = (0, 1, 2, 3, 4)             # UTC hours flagged as "odd_hour"
GEO_LABEL = "geo_impossible"            # anomaly label that sets geo_flag = 1
DEFAULT_HOUR = 12                       # hour used when event_time is null
RULE_ORDER = ("geo_impossible", "large_amount", "rapid_fire", "odd_hour")
RULE_DESCRIPTIONS = {
    "rapid_fire": "Multiple transactions from the same account within 5 minutes",
    "large_amount": "Single transaction amount exceeds the account historical average by 10x",
    "odd_hour": "Transaction occurred between midnight and 5am local time",
    "geo_impossible": "Two consecutive transactions from geographically impossible locations",
}
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class RuleContext:
    """Names of the columns rules read; override when a frame differs."""
    amount: str = "amount"
    count: str = "tx_count_5m"
    event_time: str = "event_time"
    geo_flag: str = "geo_flag"
    history_sum: str = "prior_amount_sum"
    history_count: str = "prior_count"
    prev_location: str = "prev_location"
    prev_time: str = "prev_event_time"
    location: str = "location"


@dataclass(frozen=True)
class Rule:
    name: str
    condition: Callable[[RuleContext], Column]


def amount_at_least(threshold: float) -> Callable[[RuleContext], Column]:
    # Null amount counts as 0 (never large).  NaN >= t is TRUE in Spark but
    # FALSE in Python, so NaN is excluded explicitly.
    def cond(c: RuleContext) -> Column:
        a = F.col(c.amount)
        return F.coalesce(a >= F.lit(threshold), F.lit(False)) & ~F.coalesce(F.isnan(a), F.lit(False))
    return cond


def count_at_least(threshold: int) -> Callable[[RuleContext], Column]:
    def cond(c: RuleContext) -> Column:
        return F.coalesce(F.col(c.count), F.lit(0)) >= F.lit(threshold)
    return cond


def hour_in(hours: tuple[int, ...]) -> Callable[[RuleContext], Column]:
    # hour() follows the session time zone, which vigil pins to UTC.
    def cond(c: RuleContext) -> Column:
        return F.coalesce(F.hour(F.col(c.event_time)), F.lit(DEFAULT_HOUR)).isin(*hours)
    return cond


def flag_set() -> Callable[[RuleContext], Column]:
    def cond(c: RuleContext) -> Column:
        return F.coalesce(F.col(c.geo_flag), F.lit(0)) == F.lit(1)
    return cond


def amount_over_history(multiple: float = 10.0) -> Callable[[RuleContext], Column]:
    """Intent R5: amount > multiple x mean of the account's earlier amounts.

    Written as `amount * n > multiple * sum` so no division happens and the
    comparison stays exact for decimal amounts; no history -> no flag.
    """
    def cond(c: RuleContext) -> Column:
        # a NaN amount is never large (NaN > x is true in Spark, false in Python)
        n, a = F.col(c.history_count), F.col(c.amount)
        return F.coalesce((n > 0) & (a * n > F.lit(multiple) * F.col(c.history_sum))
                          & ~F.isnan(a.cast("double")), F.lit(False))
    return cond


def travel_within(seconds: int) -> Callable[[RuleContext], Column]:
    """Intent R6: previous event of the account <= `seconds` earlier, other location."""
    def cond(c: RuleContext) -> Column:
        gap = F.col(c.event_time).cast("double") - F.col(c.prev_time).cast("double")
        return F.coalesce((gap <= seconds) & (F.col(c.location) != F.col(c.prev_location)),
                          F.lit(False))
    return cond


@dataclass(frozen=True)
class RuleSet:
    """Ordered rules; earlier rules win."""
    rules: tuple[Rule, ...]
    context: RuleContext = field(default_factory=RuleContext)

    @property
    def names(self) -> list[str]:
        return [r.name for r in self.rules]

    def first_match(self) -> Column:
        """Name of the first rule that fires, else null."""
        return F.coalesce(*[F.when(r.condition(self.context), F.lit(r.name)) for r in self.rules],
                          F.lit(None).cast("string"))

    def all_matches(self) -> Column:
        """Every rule that fires, in priority order (empty array if none)."""
        arr = F.array(*[F.when(r.condition(self.context), F.lit(r.name)) for r in self.rules])
        return F.filter(arr, lambda x: x.isNotNull())

    def with_context(self, **kw) -> "RuleSet":
        fields = {**self.context.__dict__, **kw}
        return RuleSet(self.rules, RuleContext(**fields))


def default_rules(large_amount: float = LARGE_AMOUNT_THRESHOLD,
                  rapid_fire: int = RAPID_FIRE_COUNT_THRESHOLD,
                  odd_hours: tuple[int, ...] = ODD_HOURS) -> RuleSet:
    """The four coded rules, in the reference's priority order."""
    by_name = {
        "geo_impossible": Rule("geo_impossible", flag_set()),
        "large_amount": Rule("large_amount", amount_at_least(large_amount)),
        "rapid_fire": Rule("rapid_fire", count_at_least(rapid_fire)),
        "odd_hour": Rule("odd_hour", hour_in(odd_hours)),
    }
    return RuleSet(tuple(by_name[n] for n in RULE_ORDER))


def intent_rules(multiple: float = 10.0, travel_seconds: int = 60) -> RuleSet:
    """R5 + R6: the behaviour the prose describes, ahead of the coded rules."""
    base = default_rules()
    extra = (Rule("relative_amount", amount_over_history(multiple)),
             Rule("impossible_travel", travel_within(travel_seconds)))
    return RuleSet(extra + base.rules)


def geo_flag(anomaly_type: Column) -> Column:
    """1 when the label says geo_impossible, 0 otherwise, null when no label."""
    return (anomaly_type == F.lit(GEO_LABEL)).cast("int")


def describe_rule(rule_name: Column) -> Column:
    """A5: known description, else title-cased name ('new_rule' -> 'New Rule')."""
    expr = F.initcap(F.regexp_replace(rule_name, "_", " "))
    for name, text in RULE_DESCRIPTIONS.items():
        expr = F.when(rule_name == F.lit(name), F.lit(text)).otherwise(expr)
    return expr
