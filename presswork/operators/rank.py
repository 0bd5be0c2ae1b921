"""A score of five weighted factors, built from rule tables given as parameters."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.functions.text import split_tags, strip


@dataclass(frozen=True)
class RankRules:
    """Fixed values of the score: weights, thresholds and terms. All can be replaced."""

    category_weight: dict[str, int] = field(
        default_factory=lambda: {
            "order wins": 3, "bidding activity": 3, "mergers & acquisitions": 2, "partnerships & alliances": 2,
            "project execution": 2, "financial": 1, "stock market": 1,
        }
    )
    #: Unit terms with their places and bonus; the first group whose unit fits decides.
    places: tuple = (
        (("international t&d",), ((("middle east", "uae", "saudi", "qatar", "bahrain", "oman", "kuwait"), 2), (("africa", "americas", "saarc"), 1))),
        (("india t&d", "transportation", "civil", "renewables"), ((("india",), 2),)),
        (("oil & gas", "oil and gas"), ((("india", "middle east"), 2),)),
    )
    #: Ascending thresholds of the value steps, by category.
    value_steps: dict[str, tuple[int, int, int]] = field(
        default_factory=lambda: {
            "order wins": (100, 500, 1000), "bidding activity": (100, 500, 1000), "project execution": (100, 500, 1000),
            "financial": (500, 2000, 5000), "mergers & acquisitions": (50, 200, 500), "partnerships & alliances": (50, 200, 500),
        }
    )
    category_factor: int = 50
    tier_factor: int = 10
    place_factor: int = 5
    value_factor: int = 5
    last_tier: int = 3
    default_relevance: int = 70


RULES = RankRules()


def category_points(category: Column, rules: RankRules = RULES) -> Column:
    """Weight of the category (case ignored) times its factor; unknown and null weigh nothing."""
    weight = F.lit(0)
    for name, value in rules.category_weight.items():
        weight = F.when(F.lower(category) == name, value).otherwise(weight)
    return weight * rules.category_factor


def place_points(unit: Column, place: Column, rules: RankRules = RULES) -> Column:
    """Bonus of the place for the unit. The first group of units that fits decides, even with no bonus."""
    unit, place = F.lower(F.coalesce(unit, F.lit(""))), F.lower(F.coalesce(place, F.lit("")))

    def any_in(text: Column, terms: tuple[str, ...]) -> Column:
        found = F.lit(False)
        for term in terms:
            found = found | F.contains(text, F.lit(term))
        return found

    bonus = F.lit(0)
    for units, steps in reversed(rules.places):
        own = F.lit(0)
        for terms, points in reversed(steps):
            own = F.when(any_in(place, terms), points).otherwise(own)
        bonus = F.when(any_in(unit, units), own).otherwise(bonus)
    return bonus * rules.place_factor


def value_points(category: Column, value: Column, rules: RankRules = RULES) -> Column:
    """Step of a positive value for its category; null, NaN, non-positive values and other categories give nothing."""
    step = F.lit(0)
    for name, (low, middle, high) in rules.value_steps.items():
        own = F.when(value >= high, 4).when(value >= middle, 3).when(value >= low, 2).otherwise(1)
        step = F.when(F.lower(category) == name, own).otherwise(step)
    return F.when(value.isNotNull() & ~F.isnan(value) & (value > 0), step).otherwise(0) * rules.value_factor


def best_known(tiers: DataFrame) -> DataFrame:
    """``name``, ``tier``: the last tier of each official name."""
    return tiers.filter(F.col("competitor").isNotNull()).groupBy(strip(F.col("competitor")).alias("name")).agg(F.max("tier").alias("tier"))


def best_tier(articles: DataFrame, row_id: str, tags: str, tiers: DataFrame, rules: RankRules = RULES) -> DataFrame:
    """``row_id``, ``competitor_tier``: the smallest tier among the tagged names, the last tier at most.

    ``tiers`` has ``competitor`` and ``tier`` (bounded; Spark broadcasts it if
    it is small). Names are stripped; unknown names and null tiers count as last.
    """
    known = best_known(tiers)
    named = articles.select(row_id, F.explode(split_tags(F.col(tags))).alias("name")).filter("name <> '-'")
    found = named.join(known, "name").groupBy(row_id).agg(F.min("tier").alias("tier"))
    return articles.select(row_id).join(found, row_id, "left").select(
        row_id, F.least(F.lit(rules.last_tier), F.coalesce("tier", F.lit(rules.last_tier))).alias("competitor_tier")
    )


def rank_score(articles: DataFrame, row_id: str, tiers: DataFrame, rules: RankRules = RULES) -> DataFrame:
    """The five factors and their sum for each row (``relevance_score``, ``category_tag``, ``competitor_tagging``,
    ``sbu_tagging``, ``geography``, ``contract_value_inr_crore``)."""
    scored = articles.join(best_tier(articles, row_id, "competitor_tagging", tiers, rules).withColumnRenamed("competitor_tier", "_tier"), row_id)
    points = points_of(rules)
    typed = scored.select(row_id, F.col("_tier").cast("bigint").alias("competitor_tier"), *[c.alias(n) for n, c in points.items()])
    return typed.withColumn("rank_score", sum_of([F.col(n) for n in points]))


def points_of(rules: RankRules = RULES, tier: str = "_tier") -> dict[str, Column]:
    """The five factors by name, from the columns that ``rank_score`` reads and the column ``tier``."""
    points = {
        "category_points": category_points(F.col("category_tag"), rules),
        "relevance_points": F.coalesce(F.col("relevance_score"), F.lit(rules.default_relevance)),
        "competitor_points": (rules.last_tier + 1 - F.col(tier)) * rules.tier_factor,
        "geography_points": place_points(F.col("sbu_tagging"), F.col("geography"), rules),
        "value_points": value_points(F.col("category_tag"), F.col("contract_value_inr_crore"), rules),
    }
    return {n: c.cast("bigint") for n, c in points.items()}


def sum_of(points: list[Column]) -> Column:
    total = F.lit(0).cast("bigint")
    for factor in points:
        total = total + factor
    return total
