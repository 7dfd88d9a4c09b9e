"""Readers for landed files: header-less CSV, JSON payloads, nested records.

A feed lands as a directory of files; one scan reads all pages and draws of it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, types as T
from pyspark.sql import functions as F

from lakeloom.functions.columns import row_key

# ---------------------------------------------------------------- CSV with a fixed header

# One field and the comma before it. A quoted field ends at a quote that is not doubled; text
# after it, up to the comma, still belongs to the field. Quantifiers do not give back.
_FIELD = r',("[^"]*+(?:""[^"]*+)*+"?+[^,]*+|[^,]*+)'
_QUOTED = r'(?s)^"([^"]*+(?:""[^"]*+)*+)"?+(.*)$'


def csv_fields(line: Column | str) -> Column:
    """Fields of one CSV line: quotes may hold commas, doubled quotes are one, '\\' is text."""
    line = F.col(line) if isinstance(line, str) else line
    raw = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_FIELD), F.lit(1))

    def unquote(field: Column) -> Column:
        inside = F.replace(F.regexp_extract(field, _QUOTED, 1), F.lit('""'), F.lit('"'))
        quoted = F.concat(inside, F.regexp_extract(field, _QUOTED, 2))
        return F.when(field.startswith('"'), quoted).otherwise(field)

    return (
        F.when(line == "", F.array().cast("array<string>"))
        .when(~line.contains('"'), F.split(line, ","))
        .otherwise(F.transform(raw, unquote))
    )


def csv_lines(lines: DataFrame, header: Sequence[str], value: str = "value") -> DataFrame:
    """The lines split into fields, with ``__ok`` telling whether the field count is right."""
    fields = lines.select(csv_fields(F.regexp_replace(value, r"\r$", "")).alias("__f"))
    return fields.withColumn("__ok", F.size("__f") == len(header))


def csv_rows(lines: DataFrame, header: Sequence[str], value: str = "value") -> DataFrame:
    """All-text rows of the lines that have as many fields as the header."""
    good = csv_lines(lines, header, value).where("__ok")
    return good.select(*[F.col("__f")[i].alias(name) for i, name in enumerate(header)])


def csv_metrics(lines: DataFrame, header: Sequence[str], value: str = "value") -> DataFrame:
    """Lines read (before the drop), lines with a wrong field count, and the header."""
    return csv_lines(lines, header, value).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(~F.col("__ok")).alias("malformed_rows"),
        F.lit(", ".join(header)).alias("headers"),
    )


def read_csv_checked(spark: SparkSession, path: str, header: Sequence[str]) -> DataFrame:
    return csv_rows(spark.read.text(path), header)


def read_csv_metrics(spark: SparkSession, path: str, header: Sequence[str]) -> DataFrame:
    return csv_metrics(spark.read.text(path), header)


def load_csv(lines: DataFrame, header: Sequence[str], to: str, value: str = "value") -> dict:
    """Write the good rows of the lines, or records, to ``to``; row_count, malformed_rows and headers of the load.

    The numbers are counted while the rows are written, so the file is read once.
    """
    seen = Observation()
    fields = csv_lines(lines, header, value).observe(
        seen, F.count(F.lit(1)).alias("row_count"), F.count_if(~F.col("__ok")).alias("malformed_rows")
    )
    good = fields.where("__ok").select(*[F.col("__f")[i].alias(name) for i, name in enumerate(header)])
    good.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(to)
    return {**seen.get, "headers": ", ".join(header)}


# ---------------------------------------------------------------- JSON payloads


def read_payloads(
    spark: SparkSession, path: str, envelope: str | None, one_per_file: bool = True
) -> DataFrame:
    """Landed payloads with the text under ``envelope`` (or the whole payload) as ``body``.

    Partition directories such as ``source_glass=Mug/`` come back as columns.
    """
    if envelope is None:
        return spark.read.text(path, wholetext=one_per_file).withColumnRenamed("value", "body")
    frame = spark.read.schema(f"`{envelope}` STRING").json(path, multiLine=one_per_file)
    return frame.withColumnRenamed(envelope, "body")


def unwrap(payloads: DataFrame, record: T.StructType | str, body: str = "body") -> DataFrame:
    """One row per object in the list under ``body``.

    Payloads that hold no list (``"None Found"``, null) and items that are no objects vanish;
    the other columns, such as the tag of the request, are kept on every row.
    """
    tags = [c for c in payloads.columns if c != body]
    items = payloads.select(*tags, F.explode(F.from_json(body, "array<string>")).alias("__item"))
    objects = items.where(F.ltrim(F.col("__item")).startswith("{"))
    return objects.select(*tags, F.from_json("__item", record).alias("__r")).select(*tags, "__r.*")


def tag_from_path(df: DataFrame, pattern: str, alias: str, group: int = 1) -> DataFrame:
    """Add the part of the file path that names where the rows came from."""
    return df.withColumn(alias, F.regexp_extract("_metadata.file_path", pattern, group))


def value_list(payloads: DataFrame, field: str, body: str = "body") -> DataFrame:
    """Values of one field over the listed objects, objects without it left out."""
    values = unwrap(payloads, f"`{field}` STRING", body)
    return values.select(field).where(F.col(field).isNotNull())


# ---------------------------------------------------------------- nested records


def flat_columns(schema: T.StructType, sep: str = "__", path: tuple[str, ...] = ()) -> list[Column]:
    """Leaf columns of nested structs, named by their path."""
    leaves: list[Column] = []
    for field in schema:
        here = (*path, field.name)
        if isinstance(field.dataType, T.StructType):
            leaves += flat_columns(field.dataType, sep, here)
        else:
            column = F.col(".".join(f"`{part}`" for part in here))
            leaves.append(column.alias(sep.join(here)))
    return leaves


def flatten_structs(df: DataFrame, sep: str = "__") -> DataFrame:
    return df.select(*flat_columns(df.schema, sep))


def with_row_id(df: DataFrame, keys: Sequence[str], alias: str = "_dlt_id") -> DataFrame:
    return df.withColumn(alias, row_key(*keys))


def with_lineage(df: DataFrame, keys: Sequence[str], load_id: str) -> DataFrame:
    """Every landed row with the load that brought it (``_dlt_load_id``) and an id of its own (``_dlt_id``).

    The row id depends on the keys alone, so a row that lands again has the same id under another load.
    """
    return with_row_id(df, keys).withColumn("_dlt_load_id", F.lit(load_id))


def loads_of(df: DataFrame, table: str) -> DataFrame:
    """(table_name, load_id, row_count): the rows that each load has left in a landed table."""
    counted = df.groupBy(F.col("_dlt_load_id").alias("load_id")).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.select(F.lit(table).alias("table_name"), "load_id", "row_count")


def child_table(df: DataFrame, lists: str, row_id: str = "_dlt_id") -> DataFrame:
    """The elements of a list column as rows of their own, with the id of their parent row."""
    rows = df.select(
        F.col(row_id).alias("_dlt_root_id"), F.posexplode(lists).alias("_dlt_list_idx", "value")
    )
    if isinstance(rows.schema["value"].dataType, T.StructType):
        return rows.select("_dlt_root_id", "_dlt_list_idx", "value.*")
    return rows


def zip_lists(df: DataFrame, lists: Mapping[str, str], *keep: str | Column) -> DataFrame:
    """Parallel lists to rows by index; ``lists`` maps output names to list columns.

    A list that is missing or shorter than the others gives nulls.
    """
    found = df.select(*[F.col(path).alias(name) for name, path in lists.items()]).schema
    zipped = F.arrays_zip(
        *[
            F.coalesce(path, F.array().cast(found[name].dataType)).alias(name)
            for name, path in lists.items()
        ]
    )
    named = F.transform(
        zipped, lambda z: F.struct(*[z[name].alias(name) for name in lists])
    )
    return df.select(*keep, F.inline(named))


def list_of_structs(values: Column | str, field: str) -> Column:
    """``[a, b]`` to ``[{field: a}, {field: b}]``; a missing list gives an empty one."""
    values = F.col(values) if isinstance(values, str) else values
    present = F.coalesce(values, F.array().cast("array<string>"))
    return F.transform(present, lambda v: F.struct(v.alias(field)))


def exploded_values(df: DataFrame, lists: str | Column, alias: str, *keep: str | Column) -> DataFrame:
    """Elements of a list as rows, without null and empty ones."""
    rows = df.select(*keep, F.explode(lists).alias(alias))
    return rows.where(F.col(alias) != "")


def zoned_times(text: str | Column, formats: Sequence[str] = ()) -> Column:
    """Timestamp in UTC of a text; null where it cannot be read."""
    text = F.col(text) if isinstance(text, str) else text
    tries = [F.try_to_timestamp(text)] + [F.try_to_timestamp(text, F.lit(f)) for f in formats]
    return F.coalesce(*tries)


# ---------------------------------------------------------------- load log


def table_metrics(df: DataFrame, name: str) -> DataFrame:
    """Row count and column names of a frame, for the load log."""
    return df.agg(
        F.lit(name).alias("table_name"),
        F.count(F.lit(1)).alias("row_count"),
        F.lit(", ".join(df.columns)).alias("columns"),
    )
