"""Line deduplication over overlapping three-line windows, in DataFrame functions only.

Consecutive lines are hashed in windows of three; a window that occurs more than once in the whole table keeps its first
occurrence, by document id and line, and the lines of later occurrences are removed. Covered positions of overlapping
windows merge, so that a long repeated passage goes as one run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import carried, materialize, named, restored


def line_dedup(docs: DataFrame, *, doc: str = "doc_id", text: str = "text", window: int = 3, keep: tuple[str, ...] = ()) -> DataFrame:
    r"""Per document: id, ``keep`` columns, ``n_lines``, ``n_removed`` and ``text`` without the removed lines.

    Lines are split at ``\n``. A line is removed if a later occurrence of a repeated window covers it and no first
    occurrence of a repeated window does, so the first occurrence always stays whole. Windows without any word (only
    white space) are not considered: they are the layout of every text, not a passage. Texts of fewer than three lines stay as they are; null texts stay null with no
    lines. Rows that share an id are ordered by their content; identical rows with one id count as one occurrence.
    Memory is bounded by one document: windows are shuffled as hashes, counted with partial aggregation, and only
    repeated ones, which are stored, are joined back: adaptive execution splits the rows of a hot window between tasks. An empty table gives no rows; a kept column
    named like a result gives way to it.
    """
    whole = (doc, *(c for c in keep if c != doc))
    rows = carried(docs, whole, _doc=named(doc), _text=named(text))
    body = rows.select(F.col("_doc").alias("_id"), F.xxhash64("_text").alias("_key"), F.split(F.col("_text"), "\n", -1).alias("_l"))
    body = body.filter(F.size("_l") >= window)
    parts = lambda i: [F.get(F.col("_l"), i + k) for k in range(window)]
    has_word = lambda i: F.concat(*parts(i)).rlike(r"[^\x20\x09-\x0D]")
    starts = F.filter(F.sequence(F.lit(0), F.size("_l") - window), has_word)
    # two seeds make a 128-bit key of the window's lines
    keys = F.transform(starts, lambda i: F.struct(i.alias("at"), F.xxhash64(*parts(i)).alias("h1"), F.xxhash64(F.lit(window), *parts(i)).alias("h2")))
    wins = materialize(body.select("_id", "_key", F.explode(keys).alias("w")).select("_id", "_key", "w.*"), "line-windows")
    first = wins.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(F.struct("_id", "_key", "at")).alias("first"))
    first = materialize(first.filter("n > 1").select("h1", "h2", "first"), "line-first")  # a table: both sides of the join are then plain exchanges
    hits = wins.join(first, ["h1", "h2"]).withColumn("later", F.struct("_id", "_key", "at") != F.col("first"))
    spans = hits.groupBy("_id", "_key").agg(
        F.collect_set(F.when(F.col("later"), F.col("at"))).alias("_later"), F.collect_set(F.when(~F.col("later"), F.col("at"))).alias("_first")
    )
    cover = lambda c: F.array_distinct(F.flatten(F.transform(c, lambda i: F.sequence(i, i + window - 1))))
    spans = spans.filter(F.size("_later") > 0).select("_id", "_key", F.array_except(cover(F.col("_later")), cover(F.col("_first"))).alias("_gone"))
    same = F.col("_doc").eqNullSafe(F.col("_id")) & (F.xxhash64("_text") == F.col("_key"))
    joined = rows.join(spans, same, "left").withColumn("_l", F.split(F.col("_text"), "\n", -1))
    left = F.array_except(F.sequence(F.lit(0), F.size("_l") - 1), F.col("_gone"))
    rebuilt = F.array_join(F.transform(left, lambda i: F.get(F.col("_l"), i)), "\n")
    results = {
        "n_lines": F.coalesce(F.when(F.col("_l").isNotNull(), F.size("_l")), F.lit(0)).cast("long"),
        "n_removed": F.coalesce(F.when(F.col("_gone").isNotNull(), F.size("_gone")), F.lit(0)).cast("long"),
        text: F.when(F.coalesce(F.size("_gone"), F.lit(0)) > 0, rebuilt).otherwise(F.col("_text")),
    }
    return restored(joined.withColumns(results), whole, tuple(results))
