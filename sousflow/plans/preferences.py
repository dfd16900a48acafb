"""Top food preferences per customer and a recipe suggestion for the first one."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sousflow.functions.text import clean_lower
from sousflow.operators.nested import flatten
from sousflow.operators.topn import pivot_ranks

MISSING_TAG = "<NA>"  # fixed value: how the tag table spells a missing property


def survey_tags(customer_survey: DataFrame, recipe_tags: DataFrame) -> DataFrame:
    """Every survey row with its tag text (raw and cleaned); unknown tags give NULL."""
    return (customer_survey.select("customer_id", "tag_id")
                           .join(recipe_tags.select("tag_id", "tag_property"), "tag_id", "left")
                           .select("customer_id", "tag_property",
                                   clean_lower("tag_property").alias("tag_property_cleaned")))


def top_preferences(eligible: DataFrame, customer_survey: DataFrame, recipe_tags: DataFrame,
                    n: int = 3, distinct_tags: bool = False) -> DataFrame:
    """Customers with at least one known preference and their first ``n`` (alphabetical).

    Same result as RANK() over a customer's joined rows ordered by tag, then a pivot
    of ranks 1..n: equal tags share a rank, so a repeated first tag leaves the
    second column NULL. The rank of a tag only depends on how many joined rows hold
    smaller tags, so it is computed from (customer, tag) counts, a partial aggregate:
    a customer with a third of all survey rows never reaches one task as raw rows.
    ``distinct_tags`` ranks each different tag of a customer once, so no column stays
    empty while the customer has more tags.
    """
    people = eligible.select("customer_id", "first_name", "last_name", "email")
    tags = (survey_tags(customer_survey, recipe_tags).where(F.col("tag_property") != MISSING_TAG)
            .select("customer_id", F.col("tag_property_cleaned").alias("tag")))
    # every people row of a customer repeats all of the customer's tag rows
    groups = people.groupBy(*people.columns).agg(F.count(F.lit(1)).alias("_people"))
    copies = groups.groupBy("customer_id").agg(F.lit(1).cast("long").alias("_copies") if distinct_tags else F.sum("_people").alias("_copies"))
    counts = tags.groupBy("customer_id", "tag").agg(F.lit(1).cast("long").alias("_rows") if distinct_tags else F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(Window.partitionBy("customer_id").orderBy("tag")
                                 .rowsBetween(Window.unboundedPreceding, -1))
    ranked = (counts.join(copies, "customer_id", "inner")
                    .withColumn("food_preference", F.coalesce(before, F.lit(0)) * F.col("_copies") + 1)
                    .where(F.col("food_preference") <= n))
    out_cols = [f"food_preference_{i}" for i in range(1, n + 1)]
    pivoted = pivot_ranks(ranked, ["customer_id"], "food_preference", "tag", out_cols)
    return groups.join(pivoted, "customer_id", "inner").select(
        "customer_id", "first_name", "last_name", "email", *out_cols)


def recipe_by_tag(recipe: DataFrame) -> DataFrame:
    """Cleaned tag -> name of the recipe with the largest id carrying that tag (recipe ids are unique).

    One small aggregate over the recipes, so adaptive execution sees its size and broadcasts it.
    """
    tags = flatten(recipe.select("recipe_id", "recipe_name", "tag_list"), "tag_list", value_col="_tag")
    return (tags.groupBy(clean_lower("_tag").alias("recipe_tag_cleaned"))
                .agg(F.max_by("recipe_name", "recipe_id").alias("recipe_name")))


def recipe_suggestion(preferences: DataFrame, recipe: DataFrame) -> DataFrame:
    """Top preferences plus one recipe matching preference 1, ordered by email."""
    index = recipe_by_tag(recipe)
    return (preferences.join(index, preferences.food_preference_1 == index.recipe_tag_cleaned, "left")
                       .orderBy(F.col("email").asc_nulls_last()))
