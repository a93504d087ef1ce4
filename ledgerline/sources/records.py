"""CSV records with line breaks inside quoted fields, read by one task per file block.

A line belongs to an open quoted field if an odd number of quotes stands before it. The first scan counts the quotes of every
block; the sums of the blocks before it say whether a block begins inside a field. The second scan joins the lines of
each record. Only records that cross a block's end move: their parts are put together by file and order.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LINE = "file string, start long, value string"
PARTS = "file string, start long, nth long, head boolean, whole boolean, record string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    place = (F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    return spark.read.option("lineSep", "\n").text(path).select(*place, "value")


def record_parts(spark: SparkSession, path: str) -> DataFrame:
    """``PARTS``: whole records, and parts of records that begin (``head``) or go on in a block; ``nth`` counts within the block."""
    lines = _lines(spark, path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    # A row per block of the files, as many as the tasks of the scan.
    blocks = lines.groupBy("file", "start").agg(F.sum(quotes).alias("quotes"))
    opened = blocks.select("file", "start", (F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2).cast("int").alias("odd"))

    # Nested, so that it travels with the task and executors need no copy of this package.
    def joined(batches):
        block, odd, nth, held, head = None, 0, 0, [], True
        for batch in batches:
            out = []
            for file, start, value, inside in batch.itertuples(index=False, name=None):
                if (file, start) != block:
                    if held:
                        out.append((*block, nth, head, False, "\n".join(held)))
                    block, odd, nth, held, head = (file, start), inside, 0, [], not inside
                held.append(value)
                odd ^= value.count('"') & 1
                if not odd:
                    # A part that goes on from the block before, or a whole record.
                    out.append((*block, nth, head, head, "\n".join(held)))
                    nth, held, head = nth + 1, [], True
            yield pd.DataFrame(out, columns=["file", "start", "nth", "head", "whole", "record"])
        if held:
            yield pd.DataFrame([(*block, nth, head, False, "\n".join(held))], columns=["file", "start", "nth", "head", "whole", "record"])

    # The join is with a broadcast table, so a block's lines stay together and in order.
    return lines.join(F.broadcast(opened), ["file", "start"]).select("file", "start", "value", "odd").mapInPandas(joined, PARTS)


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``record``: the text of every record below the header of its file; blank lines between records are left out.

    Quotes stand only around fields and, doubled, inside them. A file that ends inside a field ends its last record.
    """
    parts = record_parts(spark, path)
    whole = parts.where("whole").select("record", ((F.col("start") == 0) & (F.col("nth") == 0)).alias("header"))
    upto = Window.partitionBy("file").orderBy("start", "nth").rowsBetween(Window.unboundedPreceding, 0)
    # At most two parts per block.
    numbered = parts.where("NOT whole").withColumn("number", F.sum(F.col("head").cast("long")).over(upto))
    pieces = F.sort_array(F.collect_list(F.struct("start", "nth", "record")))
    crossing = numbered.groupBy("file", "number").agg(pieces.alias("pieces")).select(
        F.array_join(F.transform("pieces", lambda p: p["record"]), "\n").alias("record"),
        ((F.col("pieces")[0]["start"] == 0) & (F.col("pieces")[0]["nth"] == 0)).alias("header"),
    )
    text = F.regexp_replace("record", "\r$", "")
    return whole.unionByName(crossing).where("NOT header").select(text.alias("record")).where(F.trim("record") != "")
