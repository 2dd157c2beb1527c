"""Raw dumps: one row per posting, its JSON text untouched, its place in the dump.

A dump is one JSON array, or an object with the array in a field, of any size and on any number of lines. It is read as
text that ends records at ``}``, so a file is cut over many tasks wherever its splits fall. Whether a split
begins inside a string, and how deep, is not known to its task. So each split is summed up for both cases: whether
its quotes change the state, and by how much its brackets change the depth, if it begins outside a string and if
inside. These summaries are composed in the order of the splits, a row per split; then every record's depth is known
and postings end where it falls to that of the array. Only what crosses a split's border is put together across tasks.

``position`` orders the postings of one batch. It is read off the file, the
block and the place inside it, so it does not change with the partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_STRING = r'"(?:[^"\\]++|\\[\s\S])*+"'
# What stands before a posting, which may be the dump's own opening, and the posting.
_PREFIX_AND_OBJECT = rf'^(\s*+[\[{{]?+(?:[^"{{]++|{_STRING})*+)(\{{[\s\S]*+)\z'
_ONLY_COMMAS = r"^[\s,]*+\z"
_FIELD_OPENING = rf"({_STRING})\s*+:\s*+\[\s*+\z"


def _fragments(spark: SparkSession, path: str) -> DataFrame:
    """Text up to each closing brace, with what it does to the state for both states it may begin in.

    A brace is never escaped in JSON, so no escape crosses a fragment's end.
    """
    read = spark.read.option("lineSep", "}").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("file_size"), F.monotonically_increasing_id().alias("at"),
    )
    bare = read.withColumn("bare", F.regexp_replace("value", r"\\[\s\S]", ""))
    odd = F.regexp_count("bare", F.lit('"')) % 2

    def change(text: Column, closed: Column) -> Column:
        outside = F.regexp_replace(text, r'"[^"]*+(?:"|\z)', "")
        opened = F.regexp_count(outside, F.lit(r"[\[{]"))
        return opened - F.regexp_count(outside, F.lit(r"[\]}]")) - F.when(closed, 1).otherwise(0)

    return bare.select(
        "file", "block", "file_size", "at", "value", odd.alias("odd"),
        change(F.col("bare"), odd == 0).alias("from_outside"),
        change(F.concat(F.lit('"'), "bare"), odd == 1).alias("from_inside"),
    )


def _in_split(fragments: DataFrame) -> DataFrame:
    """``turned``: whether the state differs from that at the split's start."""
    before = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    return fragments.withColumn("turned", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)


def _split_starts(fragments: DataFrame, opening: str) -> DataFrame:
    """``file, block, inside, depth``: the state in which each split begins. A dump that is not whole fails."""
    same = F.col("turned") == 0
    sums = _in_split(fragments).groupBy("file", "block").agg(
        (F.sum("odd") % 2).alias("odd"), F.first("file_size").alias("file_size"),
        F.sum(F.when(same, F.col("from_outside")).otherwise(F.col("from_inside"))).alias("from_outside"),
        F.sum(F.when(same, F.col("from_inside")).otherwise(F.col("from_outside"))).alias("from_inside"),
        F.sum(F.octet_length("value") + 1).alias("bytes"),
        F.min_by(F.substring(F.regexp_replace("value", r"^\s+", ""), 1, 1), "at").alias("sign"),
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    turned = sums.withColumn("inside", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
    change = F.when(F.col("inside") == 0, F.col("from_outside")).otherwise(F.col("from_inside"))
    deep = turned.withColumn("change", change).select(
        "file", "block", "inside", F.coalesce(F.sum("change").over(before), F.lit(0)).alias("depth"),
        F.first("sign").over(Window.partitionBy("file").orderBy("block")).alias("sign"),
        (F.sum("odd").over(whole) % 2).alias("open_string"),
        # The end of the file is no brace, but was counted as one.
        (F.sum("change").over(whole) + F.when(F.sum("bytes").over(whole) > F.col("file_size"), 1).otherwise(0)).alias("rest"),
    )
    bad = (F.col("open_string") != 0) | (F.col("rest") != 0) | (F.col("sign") != opening)
    failed = F.raise_error(F.concat(F.lit("malformed dump: "), "file")).cast("long")
    return deep.select("file", "block", "inside", F.when(bad, failed).otherwise(F.col("depth")).alias("depth"))


def _pieces(spark: SparkSession, path: str, opening: str, level: int) -> DataFrame:
    """Text between the places where a brace closes down to ``level`` or less, in order.

    ``file, block, at, depth, text``: a piece belongs to the split in which it ends.
    """
    fragments = _fragments(spark, path)
    placed = _in_split(fragments).join(_split_starts(fragments, opening), ["file", "block"])
    state = (F.col("inside") + F.col("turned")) % 2
    change = F.when(state == 0, F.col("from_outside")).otherwise(F.col("from_inside"))
    order = Window.partitionBy("file", "block").orderBy("at")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    deep = placed.withColumn("change", change).withColumn("ends_inside", (state + F.col("odd")) % 2 == 1)
    deep = deep.withColumn("after", F.col("depth") + F.sum("change").over(so_far))
    deep = deep.withColumn("cut", ~F.col("ends_inside") & (F.col("after") <= level))
    numbered = deep.withColumn("piece", F.coalesce(F.sum(F.col("cut").cast("long")).over(earlier), F.lit(0)))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "value"))), lambda x: x["value"]), "}")
    # The grouping's keys begin with the windows' keys, so no row moves again.
    pieces = numbered.groupBy("file", "block", "piece").agg(
        F.concat(text, F.lit("}")).alias("text"), F.max(F.when(F.col("cut"), F.col("after"))).alias("depth")
    )
    ended = F.col("depth").isNotNull()
    inner = pieces.where((F.col("piece") > 0) & ended)
    # A split's first piece and its open last one belong to a piece that ends there, or in the next split with an end.
    edges = pieces.where((F.col("piece") == 0) | ~ended)
    later = Window.partitionBy("file").orderBy(F.desc("block"), F.desc("piece"))
    owned = edges.withColumn("owner", F.last(F.when(ended, F.col("block")), ignorenulls=True).over(later))
    parts = F.transform(
        F.array_sort(F.collect_list(F.struct(F.col("block").alias("b"), F.col("piece").alias("p"), "text"))),
        lambda x: x["text"],
    )
    joined = owned.where("owner is not null").groupBy("file", F.col("owner").alias("block")).agg(
        F.lit(0).cast("long").alias("piece"), F.array_join(parts, "").alias("text"), F.max("depth").alias("depth")
    )
    return inner.unionByName(joined).withColumnRenamed("piece", "at")


def _postings(pieces: DataFrame, is_posting: Column, text: Column) -> DataFrame:
    # Other pieces are no JSON; the condition in the payload keeps them from parsers that a later filter brings here.
    return pieces.where(is_posting).select(
        F.when(is_posting, text).alias("payload"),
        F.struct("file", F.col("block").cast("long").alias("block"), F.col("at").cast("long").alias("at")).alias("position"),
    )


def read_array_dump(spark: SparkSession, path: str) -> DataFrame:
    """Files that each hold one JSON array of postings (one API response per file)."""
    pieces = _pieces(spark, path, "[", 1).select(
        "*", F.regexp_extract("text", _PREFIX_AND_OBJECT, 1).alias("prefix"),
        F.regexp_extract("text", _PREFIX_AND_OBJECT, 2).alias("object"),
    )
    plain = F.regexp_replace("prefix", r"^\s*+\[", "").rlike(_ONLY_COMMAS) & (F.col("object") != "")
    failed = F.raise_error(F.concat(F.lit("malformed dump, not an array of objects: "), "file")).cast("string")
    return _postings(pieces, F.col("depth") == 1, F.when(plain, F.col("object")).otherwise(failed))


def read_envelope_dump(spark: SparkSession, path: str, field: str = "jobs") -> DataFrame:
    """Files that each hold an object with the postings under ``field``; none if it is missing."""
    pieces = _pieces(spark, path, "{", 2).select(
        "*", F.regexp_extract("text", _PREFIX_AND_OBJECT, 1).alias("prefix"),
        F.regexp_extract("text", _PREFIX_AND_OBJECT, 2).alias("object"),
    )
    # The field whose array a piece stands in: that of the piece before it, unless its prefix opens another.
    name = F.concat(F.lit("["), F.regexp_extract("prefix", _FIELD_OPENING, 1), F.lit("]"))
    opened = F.get(F.from_json(name, "array<string>"), 0)
    mark = F.when(F.col("depth") < 2, F.lit("")).when(
        ~F.col("prefix").rlike(_ONLY_COMMAS) | (F.col("object") == ""), F.coalesce(opened, F.lit(""))
    )
    marked = pieces.withColumn("mark", mark)
    last = marked.groupBy("file", "block").agg(F.max_by("mark", F.when(F.col("mark").isNotNull(), F.col("at"))).alias("mark"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("file", "block", F.last("mark", ignorenulls=True).over(before).alias("carried"))
    so_far = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    here = marked.withColumn("mark", F.last("mark", ignorenulls=True).over(so_far)).join(carried, ["file", "block"])
    return _postings(here, (F.col("depth") == 2) & (F.coalesce("mark", "carried") == field), F.col("object"))


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """Files with one posting per line."""
    lines = spark.read.text(path).where(F.length(F.trim("value")) > 0)
    return lines.select(
        F.col("value").alias("payload"),
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("at"),
        ).alias("position"),
    )
