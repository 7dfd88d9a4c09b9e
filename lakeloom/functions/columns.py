"""Column helpers: null markers, keys, rule tables, times, codes, names.

All of them are compositions of built-in expressions, so they stay inside code generation.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.functions import fixed_values as V


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- null markers


def null_marker(c: Column | str, marker: str = V.MISSING) -> Column:
    """Null where the text is exactly the marker."""
    return F.nullif(as_col(c), F.lit(marker))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(as_col(c), F.lit(""))


def clean_text(c: Column | str) -> Column:
    """Drop the two-character newline text, trim spaces, null if nothing is left.

    The missing marker (``\\N``) stays: it differs from the newline text by case.
    """
    return blank_to_null(F.trim(F.replace(as_col(c), F.lit(V.NEWLINE_TEXT), F.lit(""))))


def first_filled(*cols: Column | str) -> Column:
    """The first value that is neither null nor empty text."""
    return F.coalesce(*[blank_to_null(c) for c in cols[:-1]], as_col(cols[-1]))


# ---------------------------------------------------------------- keys


def surrogate_key(*cols: Column | str) -> Column:
    """md5 over the '-'-joined text of the columns, nulls replaced by a fixed text."""
    texts = [F.coalesce(as_col(c).cast("string"), F.lit(V.NULL_KEY_TEXT)) for c in cols]
    return F.md5(F.concat_ws("-", *texts))


def row_key(*cols: Column | str) -> Column:
    """Deterministic row id of a landed row, equal on every rerun."""
    texts = [F.coalesce(as_col(c).cast("string"), F.lit("\u0000")) for c in cols]
    return F.sha2(F.concat_ws("\u001f", *texts), 256)


# ---------------------------------------------------------------- rule tables


def first_rule(rules: Iterable[tuple[Column, str]], default: str) -> Column:
    """Label of the first predicate that holds."""
    rules = list(rules)
    head, label = rules[0]
    chain = F.when(head, F.lit(label))
    for predicate, label in rules[1:]:
        chain = chain.when(predicate, F.lit(label))
    return chain.otherwise(F.lit(default))


def starts_with(c: Column | str, text: str) -> Column:
    return F.lower(as_col(c)).startswith(text.lower())


def has_text(c: Column | str, text: str) -> Column:
    return F.lower(as_col(c)).contains(text.lower())


def any_of(predicates: Sequence[Column]) -> Column:
    return reduce(or_, predicates)


def all_of(predicates: Sequence[Column]) -> Column:
    return reduce(and_, predicates)


def prefix_label(c: Column | str, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """Label of the first prefix the text starts with, in any case.

    The prefixes become one alternation, tried in order, and the one found is looked up; a long
    rule list thus costs one match per row, not one comparison per rule.
    """
    labels: dict[str, str] = {}
    for prefix, label in rules:
        labels.setdefault(prefix.lower(), label)
    pattern = "^(" + "|".join(re.escape(p) for p in labels) + ")"
    found = F.regexp_extract(F.lower(as_col(c)), pattern, 1)
    pairs = [F.lit(text) for pair in labels.items() for text in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), found), F.lit(default))


def aircraft_maker(name: Column | str) -> Column:
    return prefix_label(name, V.MAKER_PREFIXES, V.MAKER_DEFAULT)


def character_group(name: Column | str) -> Column:
    return first_rule(
        ((as_col(name).rlike(rf"(?i)^{lead}(?![A-Za-z0-9_])"), lead) for lead in V.CHARACTER_LEADS),
        V.CHARACTER_DEFAULT,
    )


def episode_group(name: Column | str) -> Column:
    fold = {"any": any_of, "all": all_of}
    return first_rule(
        ((fold[mode]([has_text(name, t) for t in texts]), label) for label, mode, texts in V.EPISODE_TEXTS),
        V.EPISODE_DEFAULT,
    )


def location_category(kind: Column | str) -> Column:
    return first_rule(
        ((F.lower(as_col(kind)).isin(kinds), label) for label, kinds in V.LOCATION_TYPES),
        V.LOCATION_DEFAULT,
    )


def dimension_group(dimension: Column | str) -> Column:
    test = {"contains": has_text, "starts": starts_with}
    return first_rule(
        (
            (any_of([test[mode](dimension, t) for t in texts]), label)
            for label, mode, texts in V.DIMENSION_TEXTS
        ),
        V.DIMENSION_DEFAULT,
    )


# ---------------------------------------------------------------- codes and paths


def trailing_id(path: Column | str) -> Column:
    """Number after the last slash. Text without one makes the cast fail, on purpose."""
    return F.regexp_replace(as_col(path), r".*/(\d+)$", "$1").cast("int")


def last_segment(path: Column | str) -> Column:
    return F.element_at(F.split(as_col(path), "/"), -1)


def code_number(code: Column | str, start: int, length: int) -> Column:
    """The number held by a fixed slice of a code such as ``S01E07``."""
    return F.substring(as_col(code), start, length).cast("int")


def safe_name(text: Column | str) -> Column:
    """Strip white space, drop what is not ASCII, turn other odd characters into '_'."""
    kept = F.regexp_replace(as_col(text), r"[\s\x1c-\x1f[^\x00-\x7f]]+", "")
    return F.regexp_replace(kept, r"[^\w.\-]", "_")


# ---------------------------------------------------------------- times
#
# The session zone is UTC (see lakeloom.session), so a wall clock and the instant it names in
# UTC are the same number and casting between the two types costs nothing.


def _as_utc(wall: Column | str) -> Column:
    return as_col(wall).cast("timestamp")


def to_local(wall_utc: Column | str, zone: str = V.MELBOURNE) -> Column:
    """Wall clock without zone, read as UTC, shown as the wall clock of ``zone``."""
    return F.from_utc_timestamp(_as_utc(wall_utc), zone).cast("timestamp_ntz")


def reinterpret_utc_as(instant: Column | str, zone: str = V.MELBOURNE) -> Column:
    """The instant at which a clock in ``zone`` shows the UTC wall clock of ``instant``.

    This is what two chained zone conversions do to a zoned timestamp: it moves backwards.
    """
    return F.to_utc_timestamp(as_col(instant), zone)


def utc_date_of_local_text(text: Column | str, zone: str = V.MELBOURNE) -> Column:
    """Date in UTC of a wall-clock text taken as local to ``zone``."""
    wall = F.to_timestamp_ntz(as_col(text))
    return F.to_date(F.to_utc_timestamp(_as_utc(wall), zone))


def long_date(text: Column | str) -> Column:
    """Timestamp of a text such as ``December 2, 2013``."""
    return F.to_timestamp_ntz(as_col(text), F.lit("MMMM d, yyyy"))


def utc_text_of_local_noon(day: Column | str, zone: str = V.SYDNEY) -> Column:
    """ISO text, in UTC, of noon on ``day`` in ``zone``."""
    noon = as_col(day).cast("timestamp_ntz") + F.expr("INTERVAL '12' HOUR")
    return F.date_format(F.to_utc_timestamp(_as_utc(noon), zone), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def iso_in_zone(instant: Column | str, zone: Column | str) -> Column:
    """ISO text of an instant, to the second, by the clock of ``zone`` and with its offset."""
    at = F.date_trunc("SECOND", as_col(instant).cast("timestamp"))
    local = F.from_utc_timestamp(at, zone)
    minutes = F.floor((F.unix_timestamp(local) - F.unix_timestamp(at)) / 60).cast("int")
    size = F.abs(minutes)
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    sign = F.when(minutes < 0, "-").otherwise("+")
    offset = F.concat(sign, two(F.floor(size / 60)), F.lit(":"), two(F.pmod(size, F.lit(60))))
    return F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), offset)


def in_market_hours(wall_utc: Column | str, zone: str = V.SYDNEY) -> Column:
    """Monday to Friday, 10:00 to 16:00 inclusive, by the clock of ``zone``."""
    local = to_local(wall_utc, zone)
    second = F.hour(local) * 3600 + F.minute(local) * 60 + F.date_part(F.lit("SECOND"), local)
    return (F.weekday(local) < 5) & second.between(10 * 3600, 16 * 3600)


def iso_text(c: Column | str, is_date: bool) -> Column:
    """Date as ISO text, anything else as its plain text."""
    return F.date_format(as_col(c), "yyyy-MM-dd") if is_date else as_col(c).cast("string")


def local_day_before(as_of: Column | str, days: int, zone: str = V.SYDNEY) -> Column:
    """The day ``days`` before today, where today is what ``zone`` shows at ``as_of`` (UTC)."""
    return F.date_sub(F.to_date(to_local(as_of, zone)), days)


# ---------------------------------------------------------------- numbers


def round_money(c: Column | str, digits: int = 2) -> Column:
    """Round through decimal, so that engines agree on halves."""
    return F.round(as_col(c).cast("decimal(38,10)"), digits)


def content_hash(df: DataFrame) -> Column:
    """Hash of all columns of a row; maps, which have no hash of their own, go in as text."""

    def hashable(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        return F.to_json(F.struct(column)) if '"type":"map"' in field.dataType.json() else column

    return F.xxhash64(*[hashable(f) for f in df.schema])
