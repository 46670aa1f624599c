"""Threshold rules compiled to column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daypanel.constants import HIGH_CODE_FROM, MODERATE_CODES, RISK_BANDS, RISK_RULES, WEATHER_CODES, Rule


def breach(rule: Rule, null_is_risk: bool = False) -> Column:
    """True when the rule fires. Unknown never fires unless ``null_is_risk`` reads it as 0."""
    value = F.col(rule.column)
    if null_is_risk:
        value = F.coalesce(value, F.lit(0))
    fired = value < rule.threshold if rule.below else value > rule.threshold
    return F.coalesce(fired, F.lit(False))


def any_breach(df: DataFrame, rules: Sequence[Rule] = RISK_RULES, null_is_risk: bool = False) -> Column:
    tests = [breach(r, null_is_risk) for r in rules if r.column in df.columns]
    return reduce(or_, tests, F.lit(False)).cast("int")


def label_risk_days(
    df: DataFrame, rules: Sequence[Rule] = RISK_RULES, output: str = "is_risk_day", null_is_risk: bool = False
) -> DataFrame:
    return df.withColumn(output, any_breach(df, rules, null_is_risk))


def add_rule_flags(df: DataFrame, rules: Sequence[Rule] = RISK_RULES) -> DataFrame:
    """One 0/1 column per rule that has a flag name; an absent measure gives 0."""
    return df.withColumns(
        {
            r.flag: (breach(r).cast("int") if r.column in df.columns else F.lit(0))
            for r in rules
            if r.flag
        }
    )


def risk_breakdown(
    df: DataFrame, keys: Sequence[str], rules: Sequence[Rule] = RISK_RULES, null_is_risk: bool = False
) -> DataFrame:
    """Which rule fired on which row, and whether any did."""
    parts = [
        (breach(r, null_is_risk).cast("int") if r.column in df.columns else F.lit(0)).alias(f"{r.column}_breach")
        for r in rules
    ]
    return df.select(*keys, *parts, any_breach(df, rules, null_is_risk).alias("any_risk"))


def code_text(code: Column) -> Column:
    lookup = F.create_map(*[F.lit(x) for pair in WEATHER_CODES.items() for x in pair])
    return F.coalesce(F.try_element_at(lookup, code), F.lit("Unknown"))


def code_risk(code: Column) -> Column:
    return F.when(code >= HIGH_CODE_FROM, "HIGH").when(code.isin(MODERATE_CODES), "MOD").otherwise("")


def _band(probability: Column, position: int) -> Column:
    chain = None
    for band in RISK_BANDS[:-1]:
        test = probability < band[0]
        chain = F.when(test, band[position]) if chain is None else chain.when(test, band[position])
    return chain.otherwise(RISK_BANDS[-1][position])


def risk_band(probability: Column) -> Column:
    """Label of the band; an edge belongs to the higher band."""
    return _band(probability, 1)


def risk_action(probability: Column) -> Column:
    return _band(probability, 2)


def source_label(source: Column) -> Column:
    text = F.lower(F.coalesce(source, F.lit("")))
    return (
        F.when(text.contains("climatology"), "climatology")
        .when(text.contains("short") | text.contains("forecast"), "ML forecast")
        .when(text != "", source)
        .otherwise("model")
    )


def sea_source_label(source: Column) -> Column:
    text = F.lower(F.coalesce(source, F.lit("")))
    return (
        F.when(text.contains("marine"), "marine forecast")
        .when(text.contains("climatology"), "wave climatology")
        .when(text != "", source)
        .otherwise("not available")
    )


# Words that the display text capitalises or replaces.
DISPLAY_WORDS = [
    ("wind", "Wind"),
    ("gusts?", "Gusts"),
    ("precipitation", "Precipitation"),
    ("rain", "Rain"),
    ("visibility", "Visibility"),
    ("wave", "Waves"),
    ("offshore", "Offshore"),
]


def condition_text(reason: Column) -> Column:
    """Display form of a reason: blanks for underscores, capitalised words, single blanks."""
    text = F.replace(reason, F.lit("_"), F.lit(" "))
    for pattern, word in DISPLAY_WORDS:
        text = F.regexp_replace(text, f"(?i){pattern}", word)
    text = F.trim(F.regexp_replace(text, r"\s+", " "))
    blank = F.coalesce(F.trim(reason), F.lit("")) == ""
    return F.when(blank, F.lit("No major risk condition")).otherwise(text)
