"""Category columns: three vocabularies, availability classes, labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lotwise.functions.values import labelled, lookup
from lotwise.schemas import (AVAILABILITY, AVAILABILITY_OTHERWISE, HYBRID_LABELS, LOT, MODEL_ALIASES,
                             MODEL_VOCABULARY, ONLINE_CATEGORIES, TRAINING_CATEGORIES, WEATHER_CODES,
                             WEEKEND_DAYS)


def _categorised(df: DataFrame, rules: dict) -> DataFrame:
    return df.withColumns({name: F.expr(labelled(*rule)) for name, rule in rules.items()})


def categories_training(df: DataFrame) -> DataFrame:
    """Day type, time period, temperature and precipitation in the training vocabulary."""
    return _categorised(df, TRAINING_CATEGORIES)


def categories_online(df: DataFrame) -> DataFrame:
    """The same four columns in the online vocabulary."""
    return _categorised(df, ONLINE_CATEGORIES)


def categories_to_model(df: DataFrame) -> DataFrame:
    """Labels in the model vocabulary; a label outside it becomes the first one of its list."""
    def known(name: str, allowed: list[str]) -> Column:
        label = F.trim(F.col(name))
        if name in MODEL_ALIASES:
            label = F.coalesce(lookup(MODEL_ALIASES[name], label), label)
        return F.when(label.isin(allowed), label).otherwise(F.lit(allowed[0]))
    return df.withColumns({name: known(name, allowed) for name, allowed in MODEL_VOCABULARY.items()
                           if name in df.columns})


def availability(probability: Column) -> tuple[Column, Column]:
    category = color = None
    for limit, label, hue in AVAILABILITY:
        at_least = probability >= limit
        category = F.when(at_least, label) if category is None else category.when(at_least, label)
        color = F.when(at_least, hue) if color is None else color.when(at_least, hue)
    return category.otherwise(AVAILABILITY_OTHERWISE[0]), color.otherwise(AVAILABILITY_OTHERWISE[1])


def availability_category(df: DataFrame, probability: str = "probability") -> DataFrame:
    """Class and colour of a share of free spaces between 0 and 1."""
    category, color = availability(F.col(probability))
    return df.withColumns({"availability_category": category, "availability_color": color})


def weather_code_description(weather: DataFrame) -> DataFrame:
    """Text of the WMO code, a fixed table held as a literal map; others are ``Unknown``."""
    return weather.withColumn(
        "weather_description", F.coalesce(lookup(WEATHER_CODES, F.col("weather_code")), F.lit("Unknown")))


def weekday_labels(df: DataFrame) -> DataFrame:
    """Weekday or weekend, and the weekday's name with its place in a Monday-first week."""
    day = F.col("day_of_week")
    monday_first = F.pmod(day + 6, F.lit(7)) + 1
    names = F.array(*[F.lit(n) for n in (
        "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")])
    return df.withColumns({
        "weekday_type": F.when(day.isin(*WEEKEND_DAYS), "Weekend").otherwise("Weekday"),
        "weekday_label": F.element_at(names, monday_first),
        "weekday_order": monday_first,
    })


def model_display_name(df: DataFrame, labels: dict[int, str] | None = None) -> DataFrame:
    """A hybrid model shows its lot's label, any other model its own name."""
    labels = HYBRID_LABELS if labels is None else labels
    fallback = F.concat(F.lit("Hybrid Model (Lot "), F.col(LOT).cast("string"), F.lit(")"))
    shown = F.coalesce(lookup(labels, F.col(LOT)), fallback) if labels else fallback
    hybrid = F.lower("model_name").contains("hybrid")
    return df.withColumn("model_display", F.when(hybrid, shown).otherwise(F.col("model_name")))
