"""Corpus pipeline over ``documents``: quality rules, near duplicates, decontamination, mixing, token output.

Every stage takes ``(spark, docs, sf_dir)``; ``run`` writes each stage's rows as Parquet to the shared scratch folder and
hands the table that it reads back to the next one. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmill.llm.common import materialize, settle, small_side, table
from cohortmill.llm.decontam import hits_of, row_key
from cohortmill.llm.jaccard_join import jaccard_components
from cohortmill.llm.mixing import downsample_to_targets
from cohortmill.llm.quality import quality_rules
from cohortmill.llm.queries import TARGETS
from cohortmill.llm.token_output import token_digests, write_tokens

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows whose ``_row`` is not in ``gone``; no text is shuffled unless too many rows go to broadcast their keys."""
    return docs.join(small_side(gone, gone.count()), "_row", "left_anti").select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality rules reject; only ids and content hashes go through the statistics.

    Null and empty texts go (they have no words); repeated rows go or stay together; null ids, languages and sources
    are like any other; an empty table stays empty; columns other than those of ``documents`` are left out.
    """
    settle(spark)
    keyed = docs.withColumn("_row", row_key(docs["doc_id"], docs["text"]))
    judged = quality_rules(keyed, keep=("_row",))
    return _without(keyed, materialize(judged.filter(~F.col("kept")).select("_row").distinct(), "pipeline-rejected"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies: that with the smallest id, of rows that share it the one with the smallest content hash.

    Where ids repeat or are null, id and content hash together tell texts apart (null ids first), and of rows with equal
    id and text one stays. Texts without words are in no group and all stay, repeated rows included once. An empty table
    stays empty; columns other than those of ``documents`` are left out.
    """
    settle(spark)
    keyed = docs.withColumn("_row", row_key(docs["doc_id"], docs["text"]))
    again = keyed.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1 or doc_id is null").limit(1).count()
    if not again:
        groups = jaccard_components(docs)
        gone = groups.filter("doc_id != component_id").select("doc_id")
        gone = materialize(gone, "pipeline-copies")
        return docs.join(small_side(gone, gone.count()), "doc_id", "left_anti").select(*COLUMNS)
    twice = materialize(keyed.groupBy("_row").agg(F.count("*").alias("n")).filter("n > 1").select("_row"), "pipeline-repeated")
    n = twice.count()
    once = keyed.join(small_side(twice, n), "_row", "left_anti")
    first = keyed.join(small_side(twice, n), "_row", "left_semi").dropDuplicates(["_row"])
    single = materialize(once.unionByName(first), "pipeline-single")
    groups = jaccard_components(single, doc="_row")
    return _without(single, materialize(groups.filter("_row != component_id").select("_row"), "pipeline-copies"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold an occurrence of a benchmark window; null and wordless texts hold none and stay.

    Rows that share an id are judged each by its own text, repeated rows alike; an empty table or benchmark drops nothing;
    columns other than those of ``documents`` are left out.
    """
    settle(spark)
    keyed = docs.withColumn("_row", row_key(docs["doc_id"], docs["text"]))
    return _without(keyed, materialize(hits_of(keyed, table(spark, sf_dir, "benchmark")).select("_row"), "pipeline-leaks"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shrinks over-represented domains to their target share of the clean domain's tokens; nothing is repeated.

    Null and empty texts weigh nothing and are drawn like the prior; rows that share an id are drawn alike if their
    domains are; ties need no rule, since the draw is a hash of the id; an empty table stays empty.
    """
    settle(spark)
    return downsample_to_targets(docs, table(spark, sf_dir, "labels"), TARGETS).select(*COLUMNS)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token ids of what is left, and returns a digest per document from the written files.

    Null and empty texts are the end id alone; null ids come first; repeated rows are written each; no rows give none.
    """
    settle(spark)
    return token_digests(write_tokens(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
    ("token-ID output", token_output),
]

#: SQL cannot express the robust estimates, the trained classifier and the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
