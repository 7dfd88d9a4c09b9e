"""Drinks: base, staging and common tables. Each function takes the tables it reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.columns import surrogate_key, utc_date_of_local_text
from lakeloom.operators.dims import dimension, key_bridge
from lakeloom.operators.history import current_rows, snapshot
from lakeloom.operators.permute import ordered_selections

INGREDIENTS = [f"str_ingredient{i}" for i in range(1, 9)]


def base_beverages(beverages_table: DataFrame, alcoholic_table: DataFrame) -> DataFrame:
    kinds = alcoholic_table.select("idDrink", "source_alcohol_type")
    return beverages_table.join(kinds, "idDrink", "left").select(
        F.col("strDrink").alias("beverage_name"),
        F.col("idDrink").alias("beverage_id"),
        F.col("source_beverage_type").alias("beverage_type"),
        surrogate_key("source_beverage_type", "source_alcohol_type").alias("beverage_category_sk"),
        F.col("source_alcohol_type").alias("alcoholic_type"),
    )


def base_beverage_ingredients_lookup(ingredients_table: DataFrame) -> DataFrame:
    return ingredients_table.where(F.col("idDrink").isNotNull()).select(
        F.col("source_ingredient").alias("ingredient"),
        F.col("idDrink").alias("beverage_id"),
        F.col("strDrink").alias("beverage_name"),
    )


def base_beverage_consumption(beverage_fact_data: DataFrame) -> DataFrame:
    return beverage_fact_data.select(
        F.col("idDrink").alias("id_drink"),
        F.col("strDrink").alias("str_drink"),
        F.col("strCategory").alias("str_category"),
        F.col("strAlcoholic").alias("str_alcoholic"),
        F.col("strGlass").alias("str_glass"),
        F.col("strInstructions").alias("str_instructions"),
        F.col("strDrinkThumb").alias("str_drink_thumb"),
        utc_date_of_local_text("dateModified").alias("date_melbourne"),
        *[F.col(f"strIngredient{i}").alias(name) for i, name in enumerate(INGREDIENTS, start=1)],
    )


def glass_types(glass_table: DataFrame) -> DataFrame:
    return glass_table.select(
        F.col("idDrink").alias("beverage_id"),
        F.col("source_glass").alias("glass_type"),
        surrogate_key("source_glass").alias("glass_type_sk"),
    )


def glass_type_snapshot(history: DataFrame | None, glass_table: DataFrame, run_at: str) -> DataFrame:
    return snapshot(history, glass_types(glass_table), "beverage_id", ["glass_type"], run_at)


def staging_beverage_lookup(beverages: DataFrame) -> DataFrame:
    return beverages.select(
        "beverage_name",
        "beverage_id",
        "beverage_type",
        surrogate_key("beverage_type").alias("beverage_type_sk"),
        surrogate_key("beverage_type", "alcoholic_type").alias("beverage_category_sk"),
        "alcoholic_type",
        surrogate_key("alcoholic_type").alias("alcoholic_type_sk"),
    )


def staging_beverage_consumption(
    consumption: DataFrame, glass_history: DataFrame, beverage_lookup: DataFrame
) -> DataFrame:
    """Drinks consumed with the keys of their current glass and of their category.

    Only open history rows take part; they are cut down before the join.
    """
    glasses = current_rows(glass_history).select(F.col("beverage_id").alias("id_drink"), "glass_type_sk")
    kinds = beverage_lookup.select(
        F.col("beverage_id").alias("id_drink"),
        "beverage_category_sk",
        "beverage_type_sk",
        "beverage_type",
        "alcoholic_type_sk",
        "alcoholic_type",
    )
    return (
        consumption.join(glasses, "id_drink", "left")
        .join(kinds, "id_drink", "left")
        .select(
            F.col("id_drink").alias("beverage_id"),
            F.col("str_drink").alias("beverage_name"),
            "beverage_category_sk",
            F.col("str_glass").alias("glass_type"),
            "beverage_type_sk",
            "beverage_type",
            "alcoholic_type_sk",
            "alcoholic_type",
            "str_category",
            "str_alcoholic",
            "glass_type_sk",
            F.col("str_instructions").alias("beverage_instructions"),
            F.col("str_drink_thumb").alias("beverage_url"),
            "date_melbourne",
            *INGREDIENTS,
        )
    )


def dim_alcoholic_type(beverage_lookup: DataFrame) -> DataFrame:
    return dimension(beverage_lookup, "alcoholic_type", "alcoholic_type_sk")


def dim_beverage_type(beverage_lookup: DataFrame) -> DataFrame:
    return dimension(
        beverage_lookup, "beverage_type", "alcoholic_type", "beverage_category_sk", "alcoholic_type_sk"
    )


def dim_beverage_glass_type(glass_history: DataFrame) -> DataFrame:
    """Glass types of all versions, closed ones too."""
    return dimension(glass_history, "glass_type", "glass_type_sk")


def dim_beverage_ingredient_jointable(ingredients_table: DataFrame) -> DataFrame:
    return key_bridge(ingredients_table, "idDrink", "beverage_id")


def dim_beverage_ingredient_hierarchy(ingredients_lookup: DataFrame) -> DataFrame:
    """Every ordered selection of up to seven ingredients of a drink.

    A table has no order; sort when reading it, if it should be listed.
    """
    levels = ["ingredient", *[f"ingredient{i}" for i in range(2, 8)]]
    rows = ordered_selections(
        ingredients_lookup, "beverage_id", "ingredient", levels, attrs=["beverage_name"]
    )
    return rows.select("ingredient", "beverage_id", "beverage_name", *levels[1:])


def fact_beverage_consumption(staged: DataFrame) -> DataFrame:
    return staged.select(
        "beverage_id",
        "beverage_name",
        "glass_type_sk",
        "beverage_category_sk",
        "beverage_type_sk",
        "alcoholic_type_sk",
        "beverage_type",
        "alcoholic_type",
        "beverage_instructions",
        "beverage_url",
        "glass_type",
        "date_melbourne",
        *INGREDIENTS,
    )
