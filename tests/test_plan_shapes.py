"""What the plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from lakeloom.plans import others, weather
from lakeloom.workload import inputs as I
from lakeloom.workload.registry import PLANS, Tables
from tests.conftest import SF, plan_text

FORBIDDEN = ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas", "MapInArrow", "ExistingRDD")


@pytest.mark.parametrize("name", list(PLANS))
def test_no_cross_join_and_no_python(spark, name):
    text = plan_text(entry_points.queries()[name](spark, SF))
    assert not [word for word in FORBIDDEN if word in text]


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    I.geo_cities(Tables(spark, SF)).withColumn("unused", F.lit(1)).write.parquet(str(tmp_path / "geo"))
    text = plan_text(weather.dim_country(weather.staging_geo(weather.base_geo(spark.read.parquet(str(tmp_path / "geo"))))))
    assert "In(country, [" in text
    assert re.search(r"ReadSchema: struct<country_code:string,country:string>", text)


def test_airline_filter_reaches_the_scan(spark, tmp_path):
    I.airlines(Tables(spark, SF)).write.parquet(str(tmp_path / "a"))
    text = plan_text(others.base_openflight_airlines(spark.read.parquet(str(tmp_path / "a"))).select("airline_id"))
    assert "Not(EqualTo(" in text and "ReadSchema: struct<Airline ID:string>" in text


def test_dimensions_aggregate_before_the_shuffle(spark):
    text = plan_text(entry_points.queries()["dim_beverage_type"](spark, SF))
    final, partial = text.index("HashAggregate"), text.rindex("HashAggregate")
    assert final < text.index("Exchange") < partial
