"""Line dedup by overlapping windows of three lines, in DataFrame functions alone.

Every three consecutive lines are hashed. Of a window that occurs more than once, the first
occurrence stays and the lines of all later ones go; windows that overlap cover lines together.
Only hashes and positions are shuffled to find repeats; texts move once, to meet what is cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.session import settle

# Two hashes make 128 bits, so that among 10^12 windows no two fall together by chance. A window
# of blank lines says nothing and is left out.
WINDOWS = """
    if(size(l) >= 3, filter(transform(sequence(0, size(l) - 3), i -> struct(
        xxhash64(l[i], l[i + 1], l[i + 2]) AS a, xxhash64(l[i + 2], l[i + 1], l[i], 17) AS b, i AS pos,
        trim(concat(l[i], l[i + 1], l[i + 2])) = '' AS blank)), w -> NOT w.blank), array())
"""


def windows(docs: DataFrame) -> DataFrame:
    """(doc_id, copy, a, b, pos): the hash of each three lines; `copy` tells texts of one id apart."""
    lines = docs.where("text IS NOT NULL").select("doc_id", F.xxhash64("text").alias("copy"), F.split("text", "\n", -1).alias("l"))
    each = lines.select("doc_id", "copy", F.explode(F.expr(WINDOWS)).alias("w"))
    return each.select("doc_id", "copy", "w.a", "w.b", "w.pos")


def later_windows(found: DataFrame) -> DataFrame:
    """(doc_id, copy, pos) of the windows whose lines occur before: by id, null ids last, then by place."""
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "copy", "pos")
    repeated = (
        found.groupBy("a", "b").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").select("a", "b", "first")
    )
    return found.join(repeated, ["a", "b"]).where(~place.eqNullSafe(F.col("first"))).select("doc_id", "copy", "pos")


def dedup(docs: DataFrame) -> DataFrame:
    """Every row, nested as `row`, with its new text, its number of lines and of lines that went.

    Rows are told apart by doc_id and text, so rows given twice share one fate: they are no repeat of
    each other. A null text stays null; texts under three lines stay as they are; a text whose lines
    are all repeats becomes empty. Other columns, whatever their names, are kept in `row`.
    """
    text = F.col("text").cast("string")
    found, _ = settle(windows(docs.select("doc_id", text.alias("text"))))
    cut = later_windows(found).groupBy("doc_id", "copy").agg(F.collect_set("pos").alias("starts"))
    # a document's own windows: no more than it has lines
    cut = cut.select(F.col("doc_id").alias("_id"), F.col("copy").alias("_copy"), "starts")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), text.alias("t")).withColumn("copy", F.xxhash64("t"))
    joined = rows.join(cut, F.expr("id <=> _id AND copy = _copy"), "left").select("row", "t", "starts", F.split("t", "\n", -1).alias("l"))
    gone = F.expr("array_distinct(flatten(transform(starts, s -> sequence(s, s + 2))))")
    left = F.expr("array_join(transform(array_except(sequence(0, size(l) - 1), gone), i -> l[i]), '\n')")
    return joined.withColumn("gone", gone).select(
        "row",
        F.when(F.col("gone").isNull(), F.col("t")).otherwise(left).alias("text"),
        F.when(F.col("t").isNotNull(), F.size("l")).otherwise(0).alias("n_lines"),
        F.when(F.col("gone").isNotNull(), F.size("gone")).otherwise(0).alias("n_removed"),
    )
