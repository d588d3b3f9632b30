"""Interaction audit of five document filters: what every order of them would remove, from one table of mask cells.

Each document becomes a mask of the filters that it fails; documents are only counted by part and mask. A recursive query
then extends filter prefixes by unused letters over the mask cells, carrying the applied bits, so that every level of the
recursion yields the metrics of one step. The recursion works on at most 32 cells, however large the corpus is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, named

#: Letters of the filters, in the order of their bits.
LETTERS = "ABCDE"
WHITE = " \t\n\x0b\x0c\r"


def failed_filters(docs: DataFrame, *, doc: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """Per row: ``id``, ``part``, ``content`` (SHA-256 of the text) and ``mask``, the bits of the text filters A to D that it fails."""
    rows = docs.select(named(doc).alias("id"), F.coalesce(named(part).cast("string"), F.lit("")).alias("part"), F.coalesce(named(text), F.lit("")).alias("t"))
    inner = F.btrim("t", F.lit(WHITE))
    rows = rows.withColumn("w", F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, r"[\x20\x09-\x0D]+", -1)))
    fails = (
        F.size("w") < 200,
        100 * F.size(F.array_distinct("w")) < 50 * F.size("w"),
        100 * F.regexp_count("t", F.lit("[A-Z]")) > 2 * F.length("t"),
        F.col("t").rlike("[#$%&*|]"),
    )
    mask = sum((F.when(f, F.lit(1 << k)).otherwise(F.lit(0)) for k, f in enumerate(fails)), F.lit(0))
    return rows.select("id", "part", F.unhex(F.sha2("t", 256)).alias("content"), mask.alias("mask"))


def mask_cells(docs: DataFrame, labels: DataFrame, *, doc: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(part, mask, n, good, toxic): documents by part and failed filters, and how many of them are labelled good or toxic.

    Bit E (identical to the text of a smaller id) needs no row-level join: rows are counted by content, id and part first,
    then by content and part, and only these counts meet the smallest id of their content. A content that a third of all
    rows share is spread by its ids and then collapses to a row per part, labels and task before it meets in one place.
    """
    marks = labels.groupBy(named(doc).alias("id")).agg(F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    marks = materialize(marks.filter("good or toxic"), "audit-marks")  # a table, so that the join's sides are plain exchanges
    rows = failed_filters(docs, doc=doc, text=text, part=part)
    each = rows.groupBy("content", "id", "part", "mask").agg(F.count("*").alias("c")).join(marks, "id", "left").fillna(False, ["good", "toxic"])
    first = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "c")))
    grouped = each.groupBy("content", "part", "mask", "good", "toxic").agg(F.sum("c").alias("n"), first.alias("first"), F.sum(F.when(F.col("id").isNull(), F.col("c")).otherwise(0)).alias("without"))
    least = F.min("first.id").over(Window.partitionBy("content"))  # as many rows a content as parts and labels
    original = F.col("without") + F.when(F.col("first.id") == least, F.col("first.c")).otherwise(0)
    split = grouped.withColumn("original", original).select(
        "part", "good", "toxic", F.explode(F.array(F.struct("mask", F.col("original").alias("n")), F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("original")).alias("n")))).alias("x")
    )
    count = lambda flag: F.sum(F.when(F.col(flag), F.col("x.n")).otherwise(0)).alias(flag)
    return split.filter("x.n > 0").groupBy("part", "x.mask").agg(F.sum("x.n").alias("n"), count("good"), count("toxic"))


WALK = """WITH RECURSIVE walk (prefix, letter, step, mask, bit, before) AS (
  SELECT '', '', 0, mask, 0, 0 FROM {masks}
  UNION ALL
  SELECT concat(prefix, l.letter), l.letter, step + 1, mask, l.bit, before | walk.bit
  FROM walk LATERAL VIEW explode(filter(__LETTERS__, x -> (before | walk.bit) & x.bit = 0)) AS l)
SELECT prefix, letter, step, mask, mask & (before | bit) = 0 AS kept, mask & bit <> 0 AND mask & before = 0 AS removed,
  mask & bit <> 0 AND mask & before <> 0 AS redundant, mask = bit AS alone FROM walk WHERE step > 0"""


def walk_prefixes(cells: DataFrame) -> DataFrame:
    """(prefix, letter, step, mask, kept, removed, redundant, alone): what each step of each order does to each mask that occurs.

    At most 32 masks by 325 prefixes. Every recursion level carries the bits applied before its step.
    """
    letters = ", ".join(f"named_struct('letter', '{x}', 'bit', {1 << k})" for k, x in enumerate(LETTERS))
    return cells.sparkSession.sql(WALK.replace("__LETTERS__", f"array({letters})"), masks=cells.select("mask").distinct())


def filter_audit(docs: DataFrame, labels: DataFrame, *, doc: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """One row per part, ``filter_order`` (all 120) and ``step``: documents kept, removed, redundant, failing only this
    filter, good and toxic ones lost, and the filter's removals summed over all orders (``shapley``).

    A null part is the empty one; a null text is empty, and so equal to every empty text. Rows that share id and text are
    the same document twice: neither is the other's copy. A null id is nobody's copy and nobody's original. Repeated
    labels of an id count once, as good or toxic if any says so. No documents give no rows; other columns are not read.
    """
    cells = materialize(mask_cells(docs, labels, doc=doc, text=text, part=part), "audit-cells")
    steps = materialize(walk_prefixes(cells), "audit-steps")
    count = lambda flag, what="n": F.sum(F.when(F.col(flag), F.col(f"c_{what}")).otherwise(0))
    counted = cells.select("mask", "part", *[F.col(x).alias(f"c_{x}") for x in ("n", "good", "toxic")])
    metrics = counted.join(F.broadcast(steps), "mask").groupBy("part", "prefix", "letter", "step").agg(  # at most 10,400 rows of steps
        count("kept").alias("kept"), count("removed").alias("removed"), count("redundant").alias("redundant"), count("alone").alias("unique_fails"),
        count("removed", "good").alias("good_lost"), count("removed", "toxic").alias("toxic_lost"),
    )
    orders = steps.filter(F.col("step") == len(LETTERS)).select(F.col("prefix").alias("filter_order")).distinct()
    orders = orders.select("filter_order", F.expr(f"explode(transform(sequence(1, {len(LETTERS)}), k -> left(filter_order, k)))").alias("prefix"))
    out = metrics.join(F.broadcast(orders), "prefix").withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "letter")))  # 600 rows; 120 rows a window
    return out.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
