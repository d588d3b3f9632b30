"""Per-group feature frequencies with leave-one-out and population enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import log2_enrichment, rate


def attach_group(facts: DataFrame, entities: DataFrame, entity: str, group: str) -> DataFrame:
    """Inner join that gives facts the group of their entity, replacing a group column they may have."""
    one = entities.groupBy(entity).agg(F.min(group).alias(group))
    return facts.drop(group).join(one, entity)


def group_totals(entities: DataFrame, group: str) -> DataFrame:
    """Rows per group and over all groups."""
    counts = entities.groupBy(group).agg(F.count("*").alias("n_total"))
    return counts.withColumn("n_all", F.sum("n_total").over(Window.partitionBy()))  # as few rows as there are groups


def group_frequency(
    facts: DataFrame,
    entities: DataFrame,
    keys: list[str],
    *,
    entity: str,
    group: str,
    where: Column | None = None,
    other_keys: list[str] | None = None,
    high: Column | None = None,
    population: Column | None = None,
    population_keys: list[str] | None = None,
    eps: float = 1e-6,
) -> DataFrame:
    """Rates of entities with each feature (``keys``) per group.

    One shuffle by (keys, group, entity) reduces facts to one row an entity and feature, so a feature that a third of
    all facts share is spread by its entities; plain counts follow. Counts over other groups are a window over the
    grouped rows (``other_keys``, the keys if None), which is as many rows as there are groups for each feature.
    ``population`` is the largest population frequency over all facts, filtered or not, by ``population_keys``; with
    None as those keys it is taken within each output row. A single group has no others: its rates there are null.
    """
    chosen = facts if where is None else facts.filter(where)
    chosen = attach_group(chosen, entities, entity, group)
    seen = [F.max((F.coalesce(high, F.lit(False))).cast("int")).alias("_high")] if high is not None else []
    own = [F.max(population).alias("population")] if population is not None and population_keys is None else []
    pairs = chosen.filter(F.col(entity).isNotNull()).groupBy(*keys, group, entity).agg(*seen, *own, F.lit(1).alias("_one"))
    grouped = pairs.groupBy(*keys, group).agg(
        F.count("*").alias("n_entities"),
        *([F.sum("_high").alias("n_high")] if high is not None else []),
        *([F.max("population").alias("population")] if own else []),
    )
    totals = group_totals(entities, group)  # a row per group; adaptive execution broadcasts it if it is small
    out = grouped.join(totals, group, "left").withColumn("freq", rate(F.col("n_entities"), F.col("n_total")))
    if high is not None:
        out = out.withColumn("freq_high", rate(F.col("n_high"), F.col("n_total")))
    others = Window.partitionBy(*(other_keys or keys))
    out = out.withColumn("n_other", F.sum("n_entities").over(others) - F.col("n_entities"))
    out = out.withColumn("n_total_other", F.col("n_all") - F.col("n_total")).drop("n_all")
    out = out.withColumn("freq_other", rate(F.col("n_other"), F.col("n_total_other")))
    out = out.withColumn("log2_vs_other", log2_enrichment(F.col("freq"), F.col("freq_other"), eps))
    if population is not None:
        if population_keys is not None:
            largest = facts.groupBy(*population_keys).agg(F.max(population).alias("population"))
            out = out.join(largest, population_keys, "left")
        out = out.withColumn("log2_vs_population", log2_enrichment(F.col("freq"), F.coalesce("population", F.lit(0.0)), eps))
    return out


def gene_frequency(variants: DataFrame, samples: DataFrame, *, require_rare: bool = True, require_coding: bool = True) -> DataFrame:
    """Gene by lineage table: primary-aliquot patients with a coding, rare variant, their rates and enrichments."""
    where = F.col("primary_aliquot")
    where = where & F.col("is_coding") if require_coding else where
    where = where & F.col("is_rare") if require_rare else where
    out = group_frequency(
        variants, samples, ["hugo_symbol"], entity="submitter_id", group="lineage", where=where,
        high=F.col("is_high_impact"), population=F.col("gnomad_af"), population_keys=["hugo_symbol"],
    )
    return out.select(
        "hugo_symbol", "lineage", F.col("n_entities").alias("n_mutated_patients"), F.col("n_high").alias("n_high_impact_patients"),
        F.col("n_total").alias("n_total_patients"), "freq", F.col("freq_high").alias("freq_high_impact"), F.col("n_other").alias("n_mutated_other"),
        "n_total_other", F.col("freq_other").alias("freq_other_lineages"), F.col("log2_vs_other").alias("log2_enrichment_vs_other"),
        F.col("population").alias("gnomad_max_af_in_gene"), F.col("log2_vs_population").alias("log2_enrichment_vs_gnomad"),
    ).orderBy("lineage", F.desc("log2_enrichment_vs_other"), "hugo_symbol")


LOCUS = ["chrom", "pos", "ref", "alt"]
ANNOTATION = ["hugo_symbol", "hgvsp_short", "variant_class", "consequence", "impact"]


def variant_frequency(variants: DataFrame, samples: DataFrame, *, require_coding: bool = True) -> DataFrame:
    """Variant by lineage table; other lineages are counted by locus alone, population-common variants stay.

    Most variants have few patients, so one lineage's enrichments are alike: the order goes on by variant, which also
    lets the sort split them between tasks.
    """
    where = F.col("primary_aliquot")
    where = where & F.col("is_coding") if require_coding else where
    out = group_frequency(variants, samples, LOCUS + ANNOTATION, entity="submitter_id", group="lineage", where=where, other_keys=LOCUS, population=F.col("gnomad_af"))
    return out.select(
        *LOCUS, *ANNOTATION, "lineage", F.col("n_entities").alias("n_patients_with_variant"), F.col("n_total").alias("n_total_patients"),
        F.col("freq").alias("cohort_freq"), F.col("n_other").alias("n_with_variant_other"), "n_total_other", F.col("freq_other").alias("freq_other_lineages"),
        F.col("log2_vs_other").alias("log2_enrichment_vs_other"), F.col("population").alias("gnomad_af"), F.col("log2_vs_population").alias("log2_enrichment_vs_gnomad"),
    ).orderBy("lineage", F.desc("log2_enrichment_vs_other"), *LOCUS, *ANNOTATION)


def top_per_group(table: DataFrame, group: str, by: Column, tie: str, n: int, *, totals: str | None = None, least: int = 30, groups: int = 8) -> DataFrame:
    """The ``n`` best rows of each group; with ``totals``, only of the ``groups`` largest groups with ``least`` rows or more."""
    if totals is not None:
        large = table.groupBy(group).agg(F.max(totals).alias("_n")).filter(F.col("_n") >= least).orderBy(F.desc("_n"), group).limit(groups)
        table = table.join(F.broadcast(large.select(group)), group)  # at most `groups` rows
    return table.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(by.desc(), F.col(tie)))).filter(F.col("rank") <= n)
