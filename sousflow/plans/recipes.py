"""Nutrition totals per recipe."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sousflow.functions.text import clean_upper, int_from_unit_text, prefix_before, strip_quotes
from sousflow.operators.nested import flatten

# The recipes of the original nutrition report.
REFERENCE_RECIPES = [
    "birthday cookie",
    "a perfect sugar cookie",
    "honey oatmeal raisin cookies",
    "frosted lemon cookies",
    "snickerdoodles cinnamon cookies",
]


def recipe_ingredients(recipe: DataFrame, names: Sequence[str]) -> DataFrame:
    """recipe_id, recipe_name, index, ingredient (quotes removed, trimmed, upper case)."""
    chosen = recipe.where(F.col("recipe_name").isin(list(names))).select("recipe_id", "recipe_name", "ingredients")
    flat = flatten(chosen, "ingredients", value_col="_value", index_col="index", keep=["recipe_id", "recipe_name"])
    return flat.select("recipe_id", "recipe_name", "index", clean_upper(strip_quotes("_value")).alias("ingredient"))


def ingredient_nutrition(nutrition: DataFrame, numeric: bool = False) -> DataFrame:
    """Nutrition per ingredient key (the name before the first comma, upper case).

    ``total_fat`` keeps the text maximum ('9g' > '10g'), as the report does; names
    without a comma all share the key ''. ``numeric`` takes the largest number instead.
    """
    fat = int_from_unit_text("total_fat") if numeric else F.col("total_fat")
    return (nutrition.select(clean_upper(prefix_before("ingredient_name")).alias("ingredient_name"),
                             "calories", fat.alias("total_fat"))
                     .groupBy("ingredient_name")
                     .agg(F.max("calories").alias("calories"), F.max("total_fat").alias("total_fat")))


def recipe_nutrition(recipe: DataFrame, nutrition: DataFrame,
                     names: Sequence[str] = REFERENCE_RECIPES, numeric: bool = False) -> DataFrame:
    """Total calories and grams of fat per named recipe; NULL when nothing matched.

    ``numeric`` compares fat as a number, not as text, where an ingredient has several rows.
    """
    items = recipe_ingredients(recipe, names)
    facts = ingredient_nutrition(nutrition, numeric)
    per_item = items.join(facts, items.ingredient == facts.ingredient_name, "left").select(
        "recipe_name", "calories", "total_fat")
    return (per_item.groupBy("recipe_name")
                    .agg(F.sum("calories").alias("total_calories"),
                         F.sum("total_fat" if numeric else int_from_unit_text("total_fat")).alias("total_fat"))
                    .orderBy(F.col("recipe_name").asc_nulls_last()))
