"""Large JSON payloads whose list of objects is cut at item borders, so that many tasks read one object.

A payload ``{"drinks": [{...}, {...}], ...}`` may be one line of a gigabyte. Its file is read in pieces that
end at closing braces, and each piece of text is known up to two things: whether it begins inside a
string, and how deep. Both follow from short sums per part of the file (quotes, and brackets
under either beginning), prefix-summed over the parts. An item begins at a brace two levels
deep in the wanted list and ends at the brace that closes it; only these texts are parsed, once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, types as T
from pyspark.sql import functions as F

from lakeloom.session import settle

#: a whole string, a bracket, or what stands between them; a string that is cut by the end goes to the end
_TOKEN = r'(?s)"(?:[^"\\]++|\\.)*+"?+|[\[\]{]|[^"\[\]{]++'
_STRING = r'(?s)"(?:[^"\\]++|\\.)*+"?+'


def _count(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def _deeper(text: Column, begun_inside: Column) -> Column:
    """Brackets opened less those closed outside of strings, the closing brace that ends the text not counted."""
    whole = F.when(begun_inside, F.concat(F.lit('"'), text)).otherwise(text)
    outside = F.regexp_replace(whole, _STRING, "")
    return (_count(outside, "{") + _count(outside, "[") - _count(outside, "]")).cast("long")


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, part, id, value, quotes): texts between closing braces, in order within a part of a file."""
    found = spark.read.option("lineSep", "}").text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("part"),
        F.monotonically_increasing_id().alias("id"),
    )
    bare = F.regexp_replace("value", r"(?s)\\.", "")
    return found.withColumn("quotes", _count(bare, '"').cast("long"))


def _walk(text: Column, depth: Column, envelope: str, inside_list: bool) -> Column:
    """(list, start): whether the text ends in the wanted list (null if it says nothing of it), and where an item begins.

    ``start`` counts the tokens from 1; a text holds no closing brace, so at most one item begins in it.
    """
    key = F.lit(f'"{envelope}"')
    begin = F.struct(
        depth.alias("depth"),
        F.lit("").alias("key"),
        F.lit(inside_list).alias("inside"),
        F.lit(None).cast("boolean").alias("said"),
        F.lit(0).alias("at"),
        F.lit(None).cast("int").alias("start"),
    )

    def step(acc: Column, token: Column) -> Column:
        opens, closes = token.isin("{", "["), token == "]"
        after = acc["depth"] + F.when(opens, 1).when(closes, -1).otherwise(0)
        enters = (token == "[") & (acc["depth"] == 1) & (acc["key"] == key)
        leaves = closes & (after == 1)
        at = acc["at"] + 1
        begins = (token == "{") & (acc["depth"] == 2) & acc["inside"] & acc["start"].isNull()
        return F.struct(
            after.cast("long").alias("depth"),
            F.when((acc["depth"] == 1) & token.startswith('"'), token).otherwise(acc["key"]).alias("key"),
            F.when(enters, True).when(leaves, False).otherwise(acc["inside"]).alias("inside"),
            F.when(enters, True).when(leaves, False).otherwise(acc["said"]).alias("said"),
            at.alias("at"),
            F.when(begins, at).otherwise(acc["start"]).alias("start"),
        )

    tokens = F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0))
    return F.aggregate(tokens, begin, step, lambda acc: F.struct(acc["said"].alias("list"), acc["start"].alias("start")))


def read_items(spark: SparkSession, path: str, envelope: str) -> DataFrame:
    """(file, item): the text of every object in the list under ``envelope`` of the payloads' outermost object.

    Payloads without such a list, and items that are no objects, have no rows. A file holds one
    payload, as long as it likes; an item, and what stands between two closing braces, must fit a task.
    """
    order = Window.partitionBy("file", "part").orderBy("id")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    parts = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")

    # quotes before a text in its part, and how deep it leads if the part begins outside or inside a string
    flipped = F.pmod(F.coalesce(F.sum("quotes").over(before), none), F.lit(2)) == 1
    texts = _pieces(spark, path).withColumn("flipped", flipped)
    ends_inside = (F.pmod(F.col("quotes"), F.lit(2)) == 1) != F.col("flipped")
    texts = texts.select(
        "*",
        (_deeper(F.col("value"), F.col("flipped")) - F.when(ends_inside, 0).otherwise(1)).alias("outside"),
        (_deeper(F.col("value"), ~F.col("flipped")) - F.when(ends_inside, 1).otherwise(0)).alias("inside"),
    )
    texts = settle(texts, "texts")
    sums = texts.groupBy("file", "part").agg(
        F.sum("quotes").alias("quotes"), F.sum("outside").alias("outside"), F.sum("inside").alias("inside")
    )
    begun = sums.withColumn("inverted", F.pmod(F.coalesce(F.sum("quotes").over(parts), none), F.lit(2)) == 1)
    begun = begun.withColumn("deeper", F.when(F.col("inverted"), F.col("inside")).otherwise(F.col("outside")))
    begun = settle(
        begun.select("file", "part", "inverted", F.coalesce(F.sum("deeper").over(parts), none).alias("depth")), "parts"
    )
    placed = texts.join(begun, ["file", "part"])
    own = F.when(F.col("inverted"), F.col("inside")).otherwise(F.col("outside"))
    placed = placed.withColumn("after", F.col("depth") + F.sum(own).over(upto))
    begins_inside = F.col("flipped") != F.col("inverted")
    placed = placed.select(
        "file",
        "part",
        "id",
        "after",
        (F.col("after") - own).alias("depth"),
        begins_inside.alias("in_string"),
        (((F.pmod(F.col("quotes"), F.lit(2)) == 1) != begins_inside)).alias("ends_in_string"),
        # a text that begins inside a string gets the quote it lacks, which is taken off again
        F.when(begins_inside, F.concat(F.lit('"'), "value")).otherwise(F.col("value")).alias("text"),
    )
    walked = placed.withColumns(
        {
            "out": _walk(F.col("text"), F.col("depth"), envelope, False),
            "in": _walk(F.col("text"), F.col("depth"), envelope, True),
        }
    )
    walked = settle(walked, "walked")
    # whether a text begins in the wanted list: what was last said of it
    said = F.coalesce("out.list", "in.list")
    last = walked.where(said.isNotNull()).groupBy("file", "part").agg(F.max_by(said, "id").alias("said"))
    lists = begun.select("file", "part").join(last, ["file", "part"], "left")
    lists = settle(
        lists.select("file", "part", F.coalesce(F.last("said", ignorenulls=True).over(parts), F.lit(False)).alias("in_list")),
        "lists",
    )
    here = F.coalesce(F.last(said, ignorenulls=True).over(before), F.col("in_list"))
    listed = walked.join(lists, ["file", "part"]).withColumn("listed", here)
    start = F.when(F.col("listed"), F.col("in.start")).otherwise(F.col("out.start"))
    ends_listed = F.coalesce(said, "listed")
    marked = listed.select(
        "file",
        "part",
        "id",
        "text",
        "in_string",
        start.alias("start"),
        (ends_listed & ~F.col("ends_in_string") & (F.col("after") == 2)).alias("closes"),
        (ends_listed & (F.col("after") >= 2)).alias("wanted"),
    ).where("wanted")
    tokens = F.regexp_extract_all("text", F.lit(_TOKEN), F.lit(0))
    plain = F.when(F.col("in_string"), F.expr("substring(text, 2)")).otherwise(F.col("text"))
    kept = F.when(F.col("start").isNotNull(), F.array_join(F.expr("slice(t, start, size(t))"), "")).otherwise(plain)
    marked = marked.withColumn("t", tokens).select(
        "file", "part", "id", "closes", F.col("start").isNotNull().alias("opens"), F.concat(kept, F.lit("}")).alias("text")
    )
    marked = settle(marked, "item-texts")
    # a text that opens no item goes on the one that is open, if there is one: the last text that opened or closed one tells
    event = F.when(F.col("closes"), False).when(F.col("opens"), True)
    begun_at = F.when(F.col("opens"), F.struct("part", "id"))
    ends = marked.groupBy("file", "part").agg(
        F.max(begun_at).alias("item"), F.max_by(event, F.when(event.isNotNull(), F.col("id"))).alias("open")
    )
    carried = ends.select(
        "file",
        "part",
        F.last("item", ignorenulls=True).over(parts).alias("item_before"),
        F.last("open", ignorenulls=True).over(parts).alias("open_before"),
    )
    known = marked.join(carried, ["file", "part"]).withColumns(
        {
            "item": F.coalesce(F.last(begun_at, ignorenulls=True).over(upto), "item_before"),
            "open": F.coalesce(F.last(event, ignorenulls=True).over(before), "open_before", F.lit(False)),
        }
    )
    whole = marked.where("opens and closes").select("file", F.col("text").alias("item"))
    joined = known.where("(opens and not closes) or (open and not opens)")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "id", "text"))), lambda x: x["text"]), "")
    long_items = joined.groupBy("file", "item").agg(text.alias("text"), F.max("closes").alias("closes")).where("closes")
    return whole.unionByName(long_items.select("file", F.col("text").alias("item")))


def read_envelope(spark: SparkSession, path: str, envelope: str, record: T.StructType | str) -> DataFrame:
    """One row per object in the list, parsed once; ``file`` says which payload it came from."""
    return read_items(spark, path, envelope).select("file", F.from_json("item", record).alias("r")).select("file", "r.*")
