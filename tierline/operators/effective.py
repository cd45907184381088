"""Rules that are in force from one day until another.

A rule holds for a key from its first day on and until, but not on, its last;
an open end is null. A fact takes the rule that was in force for its key on its
day. Time is cut into periods, a rule is repeated into the periods it covers,
and a fact is in one period only, so the join is on equal keys and periods with
the days as a further condition: a hash or sort-merge join, broadcast if the
rules are small, split by adaptive execution if facts of one key are many.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierline.functions import fixed_values as fv
from tierline.functions.casts import flag, to_day, to_int
from tierline.functions.survey import SurveyRules
from tierline.operators.shape import quoted

# Days of a period. Rules of years are repeated a few times, and rules of days stay few within one.
PERIOD_DAYS = 366


def checked(rules: DataFrame, key: str, since: str, until: str) -> DataFrame:
    """The rules, which fail where two of one key overlap, or one ends before it starts.

    Looks at the rules only: one window over each key's.
    """
    first, last = F.col(quoted(since)), F.col(quoted(until))
    place = Window.partitionBy(quoted(key)).orderBy(first.asc_nulls_first())
    before = place.rowsBetween(Window.unboundedPreceding, -1)
    # An open end before another rule overlaps with it, as does a second open start.
    open_before = F.coalesce(F.max(last.isNull()).over(before), F.lit(False))
    overlaps = open_before | (F.max(last).over(before) > first) | (first.isNull() & (F.row_number().over(place) > 1))
    message = F.concat(F.lit(f"rules of {key} "), F.coalesce(F.col(quoted(key)).cast("string"), F.lit("null")), F.lit(" overlap"))
    backward = F.concat(F.lit(f"a rule of {key} "), F.coalesce(F.col(quoted(key)).cast("string"), F.lit("null")), F.lit(" ends before it starts"))
    verdict = F.when(last <= first, F.raise_error(backward)).when(overlaps, F.raise_error(message))
    # Kept in the day, so that the check cannot be optimised away.
    return rules.withColumn(since, F.when(verdict.cast("string").isNotNull(), F.lit(None)).otherwise(first))


def _period(day: Column, days: int) -> Column:
    return F.floor(F.unix_date(day.cast("date")) / days).cast("int")


def in_force(
    facts: DataFrame,
    rules: DataFrame,
    on: str,
    day: Column,
    columns: Mapping[str, str],
    key: str = "key",
    since: str = "valid_from",
    until: str = "valid_to",
    period_days: int = PERIOD_DAYS,
) -> DataFrame:
    """Facts with the columns (output name -> rule column) of the rule in force; null where none is.

    ``day`` is an expression over facts; it and the ends of rules are dates. Facts with a null key or
    day meet no rule and stay; rules with a null key meet no fact. Rules of one key may not overlap. The first and
    last day of the facts, which bound open ends, come from one aggregation over that column. A column of the facts
    that has one of the output names is replaced.
    """
    dated = facts.withColumn("_rule_day", day.cast("date"))
    reach = dated.agg(F.min("_rule_day").alias("first"), F.max("_rule_day").alias("last")).first()
    own = checked(rules.filter(F.col(quoted(key)).isNotNull()), key, since, until).select(
        F.col(quoted(key)).alias("_rule_key"),
        F.col(quoted(since)).cast("date").alias("_rule_since"),
        F.col(quoted(until)).cast("date").alias("_rule_until"),
        *[F.col(quoted(source)).alias(f"_rule_{name}") for name, source in columns.items()],
    )
    # Only the part of a rule that facts can fall into is repeated.
    start = F.greatest(F.col("_rule_since"), F.lit(reach.first).cast("date"))
    end = F.least(F.date_sub("_rule_until", 1), F.lit(reach.last).cast("date"))
    covered = F.sequence(_period(start, period_days), _period(end, period_days))
    spread = own.filter(start <= end).withColumn("_rule_period", F.explode(covered))
    same = (
        (F.col(quoted(on)) == F.col("_rule_key"))
        & (_period(F.col("_rule_day"), period_days) == F.col("_rule_period"))
        & (F.col("_rule_since").isNull() | (F.col("_rule_since") <= F.col("_rule_day")))
        & (F.col("_rule_until").isNull() | (F.col("_rule_day") < F.col("_rule_until")))
    )
    named = [F.col(f"_rule_{name}").alias(name) for name in columns]
    kept = [F.col(quoted(c)) for c in facts.columns if c not in columns]
    return dated.join(spread, same, "left").select(*kept, *named)


SURVEY_RULES = "county int, valid_from date, valid_to date, managed int, partner string"


def survey_rules(spark: SparkSession, rules: SurveyRules = SurveyRules()) -> DataFrame:
    """Who looks after which county, from when to when, as the survey's dated rules have it."""
    rows = [(fv.MANAGED_COUNTY, None, None, 1, fv.MANAGED_PARTNER), (fv.HANDED_OVER_COUNTY, None, rules.handover, 1, fv.MANAGED_PARTNER)]
    rows += [(code, None, None, 0, name) for name, codes in fv.OTHER_PARTNERS.items() for code in codes]
    text = spark.createDataFrame(rows, SURVEY_RULES.replace(" date", " string"))
    return text.withColumns({c: F.col(c).cast("date") for c in ("valid_from", "valid_to")})


def by_survey_rules(clean: DataFrame, rules: DataFrame) -> DataFrame:
    """Cleaned surveys with ``managed_county``, by the date as entered, and ``ip``, by the corrected one, from a rule table."""
    coded = clean.withColumn("_county", to_int(F.col("basic_info_county")))
    managed = in_force(coded, rules, "_county", to_day(F.col("basic_info_date")), {"managed_county": "managed"}, key="county")
    placed = in_force(managed, rules, "_county", F.to_date("manual_date"), {"ip": "partner"}, key="county")
    return placed.withColumn("managed_county", flag(F.col("managed_county") == 1)).drop("_county")
