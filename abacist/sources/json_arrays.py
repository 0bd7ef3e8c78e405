"""JSON arrays of any size, cut into records by many tasks.

A file is read as lines that end at a closing brace, so it splits anywhere. Whether
such a piece begins inside a string and how deep it is nested depends on all before
it: on the parity of quotes, and on the brackets outside strings. Every block of a
file sums up what it does to both, for either way it may begin; a pass over those
few sums gives each block its beginning, and a running sum each piece. A record
ends where a brace leads back to the depth of the array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_BLOCK = ("file", "block")


def _outside(parts: Column, first: int) -> Column:
    """Every other part between quotes, joined."""
    return F.array_join(F.filter(parts, lambda part, i: i % 2 == first), " ")


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _depth_change(outside: Column, ends_outside: Column) -> Column:
    """Brackets opened less those closed, with the brace that ended the piece."""
    inner = _count(outside, "{[") - _count(outside, "]")
    return (inner - F.when(ends_outside, 1).otherwise(0)).cast("bigint")


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """What lies between closing braces, by file and block, in order, with what it
    does if it begins outside (``change0``) or inside (``change1``) a string."""
    raw = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"),
        F.monotonically_increasing_id().alias("row"),
        "value",
    )
    plain = F.when(F.contains("value", F.lit("\\")), F.regexp_replace("value", r"(?s)\\.", "")).otherwise(F.col("value"))
    parts = F.split(plain, '"', -1)
    told = raw.withColumns({"_parts": parts, "_quotes": F.size(parts) - 1})
    even = F.col("_quotes") % 2 == 0
    return told.select(
        *raw.columns,
        (F.col("_quotes") % 2).alias("parity"),
        _depth_change(_outside(F.col("_parts"), 0), even).alias("change0"),
        _depth_change(_outside(F.col("_parts"), 1), ~even).alias("change1"),
    )


def _within_blocks(pieces: DataFrame) -> DataFrame:
    """Adds, for a block that begins outside (0) or inside (1) a string: whether the
    piece begins inside one, and how much deeper it begins and ends than the block."""
    ahead = W.partitionBy(*_BLOCK).orderBy("row").rowsBetween(W.unboundedPreceding, -1)
    so_far = W.partitionBy(*_BLOCK).orderBy("row").rowsBetween(W.unboundedPreceding, 0)
    begun = pieces.withColumn("inside0", F.coalesce(F.sum("parity").over(ahead), F.lit(0)) % 2)
    change0 = F.when(F.col("inside0") == 0, F.col("change0")).otherwise(F.col("change1"))
    change1 = F.when(F.col("inside0") == 0, F.col("change1")).otherwise(F.col("change0"))
    both = begun.withColumns({"_own0": change0, "_own1": change1})
    return both.withColumns(
        {
            "after0": F.sum("_own0").over(so_far),
            "after1": F.sum("_own1").over(so_far),
            "before0": F.sum("_own0").over(so_far) - F.col("_own0"),
            "before1": F.sum("_own1").over(so_far) - F.col("_own1"),
        }
    ).drop("change0", "change1", "_own0", "_own1")


def _block_beginnings(pieces: DataFrame) -> DataFrame:
    """One row per block: how it begins, and how many records end before it.

    The sums of a file's blocks are few, one per split; how often a block comes to
    a depth is one row per depth it comes to.
    """
    rows = _within_blocks(pieces)
    last = F.max(F.struct("row", "after0", "after1"))
    first = F.min(F.struct("row", F.regexp_like("value", F.lit(r"\A\s*\[")).alias("array")))
    sums = rows.groupBy(*_BLOCK).agg(
        (F.sum("parity") % 2).alias("parity"),
        last.alias("last"),
        first.alias("first"),
        F.sum(F.octet_length("value") + 1).alias("bytes"),
        F.max("size").alias("size"),
    )
    order = W.partitionBy("file").orderBy("block")
    ahead = order.rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy("file")
    inside = F.coalesce(F.sum("parity").over(ahead), F.lit(0)) % 2
    sums = sums.withColumn("inside", inside)
    deeper = F.when(F.col("inside") == 0, F.col("last.after0")).otherwise(F.col("last.after1"))
    sums = sums.withColumn("depth", F.coalesce(F.sum(deeper).over(ahead), F.lit(0)))
    sums = sums.withColumn("top", F.first("first.array").over(order.rowsBetween(W.unboundedPreceding, 0)).cast("int"))
    # a file that ends in a closing brace has no piece behind it
    open_end = F.sum("bytes").over(whole) == F.col("size") + 1
    final = F.when(open_end & (F.col("last.row") == F.max("last.row").over(whole)), F.col("last.row"))
    sums = sums.withColumn("final", final).select(*_BLOCK, "inside", "depth", "top", "final")

    reached = F.explode(F.array(F.struct(F.lit(0).alias("case"), F.col("after0").alias("after")), F.struct(F.lit(1).alias("case"), F.col("after1").alias("after"))))
    closes0, closes1 = (F.col("inside0") + F.col("parity")) % 2 == 0, (F.col("inside0") + F.col("parity")) % 2 == 1
    closing = rows.select(*_BLOCK, closes0.alias("closes0"), closes1.alias("closes1"), reached.alias("r")).where(
        F.when(F.col("r.case") == 0, F.col("closes0")).otherwise(F.col("closes1"))
    )
    depths = closing.groupBy(*_BLOCK, F.col("r.case").alias("inside"), F.col("r.after").alias("after")).count()
    ends = sums.withColumn("after", F.col("top") - F.col("depth")).join(depths, [*_BLOCK, "inside", "after"], "left")
    before = F.coalesce(F.sum("count").over(ahead), F.lit(0))
    return ends.withColumn("records", before).select(*_BLOCK, "inside", "depth", "top", "final", "records")


def json_array_records(spark: SparkSession, path: str) -> DataFrame:
    """``file, record, text``: every record of the JSON arrays at ``path``, numbered within its file.

    ``path`` is a file or a folder of files, each an array of objects or a single
    object. Files split like lines of text; of blocks that meet inside a record, its
    parts are put together. Records keep their text, so a malformed one fails where
    it is parsed; what follows unbalanced brackets or quotes is one malformed record.
    """
    pieces = _pieces(spark, path)
    begun = _within_blocks(pieces).join(_block_beginnings(pieces), list(_BLOCK))
    same = F.col("inside") == 0
    begun = begun.select(
        *_BLOCK,
        "row",
        "value",
        "top",
        "records",
        ((F.col("inside0") + F.col("inside")) % 2 == 1).alias("in_string"),
        ((F.col("inside0") + F.col("inside") + F.col("parity")) % 2 == 0).alias("closes"),
        (F.col("depth") + F.when(same, F.col("before0")).otherwise(F.col("before1"))).alias("before"),
        (F.col("depth") + F.when(same, F.col("after0")).otherwise(F.col("after1"))).alias("after"),
        F.coalesce(F.col("row") == F.col("final"), F.lit(False)).alias("is_final"),
    )
    ends = F.col("closes") & (F.col("after") == F.col("top")) & ~F.col("is_final")
    ahead = W.partitionBy(*_BLOCK).orderBy("row").rowsBetween(W.unboundedPreceding, -1)
    ended = F.coalesce(F.sum(F.when(ends, 1).otherwise(0)).over(ahead), F.lit(0))
    # between records there is a comma, before the first an opening bracket
    fresh = ~F.col("in_string") & ((F.col("before") == F.col("top")) | (F.col("before") == 0))
    numbered = begun.withColumns({"record": F.col("records") + ended, "ends": ends, "fresh": fresh})
    # what closes the array, or an array without any record
    over = F.col("is_final") & F.col("fresh") & F.when(F.col("top") == 1, F.col("value").rlike(r"\A\s*(\[\s*)?\]\s*\z")).otherwise(F.col("value").rlike(r"\A\s*\z"))
    lead = F.when(F.col("record") > 0, r"\A\s*,\s*(?=\{)").when(F.col("top") == 1, r"\A\s*\[\s*(?=\{)").otherwise(r"\A\s*(?=\{)")
    led = F.when(F.regexp_like("value", lead), F.regexp_replace("value", lead, F.lit(""))).otherwise(F.concat(F.lit("{"), "value"))
    text = F.when(F.col("fresh"), led).otherwise(F.col("value"))  # without its lead, a record stays malformed
    text = F.concat(text, F.when(F.col("is_final"), "").otherwise("}"))
    parts = numbered.where(~over).select(*_BLOCK, "row", "record", text.alias("text"), (F.col("fresh") & F.col("ends")).alias("whole"))
    single = parts.where("whole").select("file", "record", "text")
    several = parts.where(~F.col("whole")).groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("block", "row", "text"))).alias("p"))
    joined = several.select("file", "record", F.array_join(F.transform("p", lambda p: p["text"]), "").alias("text"))
    return single.union(joined)
