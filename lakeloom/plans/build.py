"""Building the tables of one subject, layer by layer.

Each table is published before the next one reads it, so every join sees inputs of known size,
and a build that dies can be done again from the start with the same version. A table that fails
one of its checks does not become the current version, and nothing is built on it; checks that
are named as ``report_only`` are left to the report. With ``as_of``, feeds that have become too old
stop a build before it begins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.dims import calendar
from lakeloom.operators.history import current_rows, read_history, snapshot_table
from lakeloom.operators.merge import append_table, read_if_exists
from lakeloom.operators.planning import freshness
from lakeloom.operators.quality import Check, NotNull, run_checks
from lakeloom.plans import contracts, drinks, meals, others, weather
from lakeloom.session import settle
from lakeloom.sinks.publish import ChecksFailed, publish, publish_view, require_rows

Feeds = Mapping[str, DataFrame]

ReportOnly = Mapping[str, Sequence[Check]]


class FeedTooOld(RuntimeError):
    """The newest row of a feed is older than its limit."""


class Build:
    """The tables published so far under one root and version.

    ``report_only`` names, by table, the checks that do not stop the build.
    """

    def __init__(self, root: str, version: str, report_only: ReportOnly | None = None):
        self.root = root.rstrip("/")
        self.version = version
        self.report_only = dict(report_only or {})
        self.tables: dict[str, DataFrame] = {}

    def stopping(self, name: str) -> list[Check]:
        """The checks of a table that stop the build."""
        return [c for c in contracts.CHECKS.get(name, ()) if c not in self.report_only.get(name, ())]

    def source(self, name: str, feed: DataFrame) -> DataFrame:
        """A feed that has rows and passes its own checks."""
        stop_if_failed(name, require_rows(feed, name), self.stopping(name), self.tables)
        return feed

    def table(self, layer: str, name: str, df: DataFrame) -> DataFrame:
        contract = contracts.CONTRACTS.get(name)
        self.tables[name] = publish(
            df, self.root, layer, name, self.version, contract, checks=self.stopping(name), parents=self.tables
        )
        return self.tables[name]

    def view(self, layer: str, name: str, df: DataFrame) -> DataFrame:
        self.tables[name] = publish_view(df, layer, name)
        return df

    def report(self) -> DataFrame:
        """Results of all checks declared for the tables built."""
        parts = []
        for name, df in self.tables.items():
            checks = contracts.CHECKS.get(name)
            if checks:
                rows = current_rows(df) if "dbt_valid_to" in df.columns else df
                result = run_checks(rows, checks, self.tables)
                parts.append(result.select(F.lit(name).alias("table_name"), "*"))
        if not parts:  # a subject without checks
            some = next(iter(self.tables.values()))
            none = run_checks(some, [NotNull(some.columns[0])], self.tables)
            parts.append(none.select(F.lit("").alias("table_name"), "*").limit(0))
        return reduce(DataFrame.unionByName, parts)


def stop_if_failed(name: str, rows: DataFrame, checks: Sequence[Check], parents: Feeds) -> None:
    if not checks:
        return
    failed = run_checks(rows, checks, parents).where("status = 'fail'").collect()
    if failed:
        shown = ", ".join(f"{r['check']} of {r['column']} ({r['failures']})" for r in failed)
        raise ChecksFailed(f"{name}: {shown}")


def stop_if_old(feeds: Feeds, as_of: str | None) -> None:
    """Nothing is built from a feed whose newest row is older than its limit; a warning does not stop."""
    if as_of is None:
        return
    old = freshness_report(feeds, as_of).where("status = 'error'").collect()
    if old:
        raise FeedTooOld(", ".join(sorted(r["table_name"] for r in old)))


def build_drinks(
    feeds: Feeds, root: str, version: str, run_at: str, report_only: ReportOnly | None = None
) -> Build:
    require_rows(feeds["beverage_fact_data"], "beverage_fact_data")
    b = Build(root, version, report_only)
    base = b.table("base", "base_beverages", drinks.base_beverages(feeds["beverages_table"], feeds["alcoholic_table"]))
    ingredients = b.table(
        "base",
        "base_beverage_ingredients_lookup",
        drinks.base_beverage_ingredients_lookup(feeds["ingredients_table"]),
    )
    consumed = b.table(
        "base", "base_beverage_consumption", drinks.base_beverage_consumption(feeds["beverage_fact_data"])
    )
    history_path = f"{b.root}/snapshots/glass_type_snapshot"
    glasses = drinks.glass_types(feeds["glass_table"])
    snapshot_table(glasses, history_path, "beverage_id", ["glass_type"], run_at)
    history = b.tables["glass_type_snapshot"] = read_history(base.sparkSession, history_path)
    stop_if_failed("glass_type_snapshot", current_rows(history), b.stopping("glass_type_snapshot"), b.tables)
    lookup = b.table("staging", "staging_beverage_lookup", drinks.staging_beverage_lookup(base))
    staged = b.table(
        "staging", "staging_beverage_consumption", drinks.staging_beverage_consumption(consumed, history, lookup)
    )
    b.table("common", "dim_alcoholic_type", drinks.dim_alcoholic_type(lookup))
    b.table("common", "dim_beverage_type", drinks.dim_beverage_type(lookup))
    b.table("common", "dim_beverage_glass_type", drinks.dim_beverage_glass_type(history))
    b.table(
        "common",
        "dim_beverage_ingredient_jointable",
        drinks.dim_beverage_ingredient_jointable(feeds["ingredients_table"]),
    )
    b.table("common", "dim_beverage_ingredient_hierarchy", drinks.dim_beverage_ingredient_hierarchy(ingredients))
    b.table("common", "fact_beverage_consumption", drinks.fact_beverage_consumption(staged))
    return b


def build_meals(feeds: Feeds, root: str, version: str, report_only: ReportOnly | None = None) -> Build:
    require_rows(feeds["consumption"], "consumption")
    b = Build(root, version, report_only)
    base = b.table(
        "base",
        "base_meal_category_country",
        meals.base_meal_category_country(feeds["country_table"], feeds["category_table"]),
    )
    consumed = b.table("base", "base_meal_consumption", meals.base_meal_consumption(feeds["consumption"]))
    used = b.table("base", "base_meal_ingredient_table", meals.base_meal_ingredient_table(feeds["ingredient_table"]))
    ids = b.table("base", "base_meal_ingredients", meals.base_meal_ingredients(feeds["ingredients"]))
    lookup = b.table("staging", "staging_meal_category_lookup", meals.staging_meal_category_lookup(base))
    staged = b.table("staging", "staging_meal_consumption", meals.staging_meal_consumption(consumed, lookup))
    ingredients = b.table(
        "staging", "staging_meal_ingredients_lookup", meals.staging_meal_ingredients_lookup(used, ids)
    )
    b.table("common", "dim_meal_category", meals.dim_meal_category(lookup))
    b.table("common", "dim_meal_country", meals.dim_meal_country(lookup))
    b.table("common", "dim_meal_ingredient_jointable", meals.dim_meal_ingredient_jointable(ingredients))
    b.table("common", "dim_meal_ingredient_hierarchy", meals.dim_meal_ingredient_hierarchy(ingredients))
    b.table("common", "fact_meal_consumption", meals.fact_meal_consumption(staged))
    return b


def build_weather(
    feeds: Feeds,
    root: str,
    version: str,
    as_of: str,
    report_only: ReportOnly | None = None,
    fresh_at: str | None = None,
) -> Build:
    """Places, weather, UV and the calendar; ``uv_index`` may be left out. Feeds must be fresh at ``fresh_at``."""
    require_rows(feeds["daily_weather"], "daily_weather")
    stop_if_old(feeds, fresh_at)
    b = Build(root, version, report_only)
    geo = b.table("base", "base_geo", weather.base_geo(feeds["geo_cities"]))
    base = b.table("base", "base_weather", weather.base_weather(feeds["daily_weather"]))
    places = b.table("staging", "staging_geo", weather.staging_geo(geo))
    staged = b.table("staging", "staging_weather", weather.staging_weather(base))
    b.table("common", "dim_city", weather.dim_city(places))
    b.table("common", "dim_country", weather.dim_country(places))
    b.table("common", "fact_weather", weather.fact_weather(staged, places))
    days = b.table("common", "dim_date", calendar(base.sparkSession))
    if "uv_index" in feeds:
        uv = b.table("base", "base_uv", weather.base_uv(feeds["uv_index"]))
        b.view("staging", "staging_uv_data_dates", weather.staging_uv_data_dates(days, uv, as_of))
    return b


def build_stocks(
    feeds: Feeds, root: str, version: str, report_only: ReportOnly | None = None, fresh_at: str | None = None
) -> Build:
    """Appends the ticks that are new; the table is one and the same over all versions.

    The feed and the rows to be added are checked before anything is appended.
    """
    stop_if_old(feeds, fresh_at)
    b = Build(root, version, report_only)
    ticks = b.source("gsheet_finance_data", feeds["gsheet_finance_data"])
    path = f"{b.root}/base/base_gsheets_finance"
    stored = read_if_exists(ticks.sparkSession, path)
    added = settle(others.base_gsheets_finance(ticks, stored), "new-ticks")
    stop_if_failed("base_gsheets_finance", added, b.stopping("base_gsheets_finance"), b.tables)
    append_table(added, path)
    b.tables["base_gsheets_finance"] = ticks.sparkSession.read.parquet(path)
    return b


def build_aviation(feeds: Feeds, root: str, version: str) -> Build:
    b = Build(root, version)
    b.table("base", "base_openflight_airlines", others.base_openflight_airlines(feeds["airlines"]))
    b.table("base", "base_openflight_airports", others.base_openflight_airports(feeds["airports"]))
    b.table("base", "base_openflight_routes", others.base_openflight_routes(feeds["routes"]))
    b.table("base", "base_openflight_planes", others.base_openflight_planes(feeds["planes"]))
    return b


def build_books(feeds: Feeds, root: str, version: str) -> Build:
    b = Build(root, version)
    b.table("base", "base_openlibrary_books", others.base_openlibrary_books(require_rows(feeds["books"], "books")))
    return b


def build_show(feeds: Feeds, root: str, version: str, report_only: ReportOnly | None = None) -> Build:
    b = Build(root, version, report_only)
    people = b.table("base", "base_rm_characters", others.base_rm_characters(feeds["character"]))
    episodes = b.table("base", "base_rm_episodes", others.base_rm_episodes(feeds["episode"]))
    places = b.table("base", "base_rm_locations", others.base_rm_locations(feeds["location"]))
    seen_in = b.table(
        "base", "base_rm_character_episode", others.base_rm_character_episode(feeds["character__episode"])
    )
    cast = b.table("base", "base_rm_episode_character", others.base_rm_episode_character(feeds["episode__characters"]))
    residents = b.table(
        "base", "base_rm_location_residents", others.base_rm_location_residents(feeds["location__residents"])
    )
    b.table("staging", "staging_rm_characters", others.staging_rm_characters(people, seen_in))
    b.table("staging", "staging_rm_episodes", others.staging_rm_episodes(episodes, cast))
    b.table("staging", "staging_rm_locations", others.staging_rm_locations(places, residents))
    return b


def freshness_report(feeds: Feeds, as_of: str) -> DataFrame:
    """Age of the newest row of each feed that has a limit."""
    at = F.lit(as_of).cast("timestamp_ntz")
    parts = [
        freshness(feeds[name], column, at, warn, error).select(F.lit(name).alias("table_name"), "*")
        for name, (column, warn, error) in contracts.FRESHNESS.items()
        if name in feeds
    ]
    if not parts:  # none of the feeds has a limit
        some = next(iter(feeds.values())).select(F.lit(None).cast("timestamp_ntz").alias("at"))
        parts.append(freshness(some, "at", at, 1, 1).select(F.lit("").alias("table_name"), "*").limit(0))
    return reduce(DataFrame.unionByName, parts)
