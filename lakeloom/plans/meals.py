"""Meals: base, staging and common tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.columns import blank_to_null, surrogate_key
from lakeloom.operators.dims import dimension, key_bridge
from lakeloom.operators.permute import ordered_selections

INGREDIENTS = [f"str_ingredient{i}" for i in range(1, 21)]


def base_meal_category_country(country_table: DataFrame, category_table: DataFrame) -> DataFrame:
    categories = category_table.select("id_meal", "source_category")
    return country_table.join(categories, "id_meal", "left").select(
        F.col("str_meal").alias("meal_name"),
        F.col("id_meal").alias("meal_id"),
        F.col("source_country").alias("country_name"),
        surrogate_key("source_country", "source_category").alias("meal_country_category_sk"),
        F.col("source_category").alias("category_name"),
    )


def base_meal_consumption(consumption: DataFrame) -> DataFrame:
    return consumption.select(
        F.col("id_meal").alias("meal_id"),
        F.col("str_meal").alias("meal_name"),
        F.col("str_category").alias("category_name"),
        F.col("str_area").alias("country_name"),
        F.col("str_instructions").alias("instructions"),
        F.col("str_meal_thumb").alias("meal_image_url"),
        F.col("str_youtube").alias("meal_youtube_url"),
        *[blank_to_null(c).alias(c) for c in INGREDIENTS],
        F.col("str_source").alias("meal_url"),
    )


def base_meal_ingredient_table(ingredient_table: DataFrame) -> DataFrame:
    return ingredient_table.select(
        F.col("str_meal").alias("meal_name"),
        F.col("id_meal").alias("meal_id"),
        F.col("source_ingredient").alias("ingredient_name"),
    )


def base_meal_ingredients(ingredients: DataFrame) -> DataFrame:
    return ingredients.select(
        F.col("id_ingredient").cast("int").alias("ingredient_id"),
        F.col("str_ingredient").alias("ingredient_name"),
    )


def staging_meal_category_lookup(category_country: DataFrame) -> DataFrame:
    return category_country.select(
        "meal_name",
        "meal_id",
        "category_name",
        "meal_country_category_sk",
        "country_name",
        surrogate_key("country_name").alias("meal_country_sk"),
    )


def staging_meal_consumption(consumption: DataFrame, category_lookup: DataFrame) -> DataFrame:
    keys = category_lookup.select("meal_id", "meal_country_category_sk")
    return consumption.join(keys, "meal_id", "left").select(
        "meal_id",
        "meal_name",
        "category_name",
        "country_name",
        "meal_country_category_sk",
        "instructions",
        "meal_image_url",
        "meal_youtube_url",
        *INGREDIENTS,
        "meal_url",
    )


def staging_meal_ingredients_lookup(meal_ingredients: DataFrame, ingredient_ids: DataFrame) -> DataFrame:
    """Ingredients of meals with the id that goes by their name."""
    return meal_ingredients.join(ingredient_ids, "ingredient_name", "left").select(
        "meal_name", "meal_id", "ingredient_name", "ingredient_id"
    )


def dim_meal_category(category_lookup: DataFrame) -> DataFrame:
    return dimension(category_lookup, "category_name", "country_name", "meal_country_category_sk")


def dim_meal_country(category_lookup: DataFrame) -> DataFrame:
    return dimension(category_lookup, "country_name", "meal_country_sk")


def dim_meal_ingredient_jointable(ingredients_lookup: DataFrame) -> DataFrame:
    return key_bridge(ingredients_lookup, "meal_id")


def dim_meal_ingredient_hierarchy(ingredients_lookup: DataFrame) -> DataFrame:
    """Every ordered selection of up to four ingredients of a meal, told apart by their id.

    An ingredient without an id takes part only as a first one, followed by nulls.
    """
    levels = ["ingredient1", "ingredient2", "ingredient3", "ingredient4"]
    item = F.when(
        F.col("ingredient_id").isNotNull(), F.struct("ingredient_id", "ingredient_name")
    )
    rows = ingredients_lookup.select("meal_id", "ingredient_name", item.alias("item"))
    chosen = ordered_selections(rows, "meal_id", "item", ["i1", "i2", "i3", "i4"], attrs=["ingredient_name"])
    return chosen.select(
        "meal_id",
        F.col("ingredient_name").alias(levels[0]),
        *[F.col(f"i{n}.ingredient_name").alias(levels[n - 1]) for n in (2, 3, 4)],
    )


def fact_meal_consumption(staged: DataFrame) -> DataFrame:
    return staged.select(
        "meal_id",
        "meal_name",
        "category_name",
        "country_name",
        "meal_country_category_sk",
        "instructions",
        "meal_image_url",
        "meal_youtube_url",
        *INGREDIENTS,
        "meal_url",
    )
