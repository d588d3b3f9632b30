"""Variant annotation, the one-unit-per-entity pick, and per-entity summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import functions as C
from ..sources.delimited import near
from ..sources.scratch import stored
from ..sources.tables import keep_listed

#: Column contract of the variants table; other columns follow.
VARIANT_COLUMNS = (
    "chrom", "pos", "end_pos", "variant_type", "ref", "alt", "hugo_symbol", "transcript_id", "exon", "hgvsc", "hgvsp_short", "variant_class", "consequence", "impact",
    "is_coding", "is_high_impact", "t_depth", "t_alt_count", "vaf", "callers", "n_callers", "gnomad_af", "is_rare", "cosmic_id", "sift", "polyphen", "context", "hotspot",
    "case_id", "submitter_id", "project_id", "primary_diagnosis", "tumor_barcode", "normal_barcode", "normal_source", "primary_aliquot", "source_file",
)


def contract_order(df: DataFrame, known: tuple[str, ...]) -> DataFrame:
    """Known columns that exist, in contract order, then all others."""
    return df.select(*[c for c in known if c in df.columns], *[c for c in df.columns if c not in known])


def annotate(facts: DataFrame) -> DataFrame:
    """Flags and derived columns for whichever source columns exist."""
    rules = {
        "is_coding": ("variant_class", lambda: C.non_coding_aware(F.col("variant_class"))),
        "is_high_impact": ("impact", lambda: C.high_impact(F.col("impact"))),
        "is_rare": ("gnomad_af", lambda: C.rare(F.col("gnomad_af").cast("string"))),
        "n_callers": ("callers", lambda: C.item_count(F.col("callers"))),
        "normal_source": ("normal_barcode", lambda: C.normal_source(F.col("normal_barcode"))),
    }
    out = facts.withColumns({name: make() for name, (needs, make) in rules.items() if needs in facts.columns})
    if {"t_alt_count", "t_depth"} <= set(facts.columns):
        out = out.withColumn("vaf", C.allele_fraction(F.col("t_alt_count"), F.col("t_depth")))
    return out


def pick_unit(facts: DataFrame, *, entity: str, unit: str, depth: str | None = None) -> DataFrame:
    """(entity, unit) of the unit with the highest mean depth per entity, ties by unit ascending, null depths last.

    Rows are dealt by both before they are averaged: a read split has few rows of a unit, so its groups would only fill memory.
    """
    mean = F.avg(depth) if depth is not None and depth in facts.columns else F.lit(0.0)
    units = facts.repartition(entity, unit).groupBy(entity, unit).agg(mean.alias("_depth"))
    rank = F.row_number().over(Window.partitionBy(entity).orderBy(F.desc_nulls_last("_depth"), F.asc(unit)))
    return units.withColumn("_rank", rank).filter("_rank = 1").select(entity, unit)


def mark_primary(facts: DataFrame, *, entity: str = "submitter_id", unit: str = "tumor_barcode", depth: str = "t_depth", flag: str = "primary_aliquot") -> DataFrame:
    """Flags every row whose unit is picked for any entity; membership is by unit alone. Without the columns: false.

    The picked units are stored and counted: few of them go to the rows, so that units that many rows share are no task's alone.
    """
    if not {entity, unit} <= set(facts.columns):
        return facts.withColumn(flag, F.lit(False))
    picked = pick_unit(facts, entity=entity, unit=unit, depth=depth).select(unit).filter(F.col(unit).isNotNull()).distinct()
    picked = near(stored(picked, "picked-units").withColumn(flag, F.lit(True)))
    return facts.drop(flag).join(picked, unit, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def attach_clinical(facts: DataFrame, clinical: DataFrame | None, *, key: str = "case_id", columns: tuple[str, ...] = ("submitter_id", "project_id", "primary_diagnosis")) -> DataFrame:
    """Left join of case attributes; nothing happens without a clinical table."""
    if clinical is None:
        return facts
    have = [c for c in columns if c in clinical.columns]
    one = clinical.groupBy(key).agg(F.min(F.struct(*have)).alias("_c")).select(key, "_c.*")
    return facts.drop(*[c for c in have if c in facts.columns]).join(one, key, "left")


def variants_table(scanned: DataFrame, clinical: DataFrame | None = None) -> DataFrame:
    """Flags, clinical attributes and the primary flag, over all rows and in contract order.

    A panel filter belongs after this: pushing it below the pick would change which unit is primary.
    """
    return contract_order(mark_primary(attach_clinical(annotate(scanned), clinical)), VARIANT_COLUMNS)


def write_variants(scanned: DataFrame, out: str, clinical: DataFrame | None = None, genes: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Writes ``variants.parquet`` and ``variant_summary.parquet`` below ``out`` from one computation; returns both as read back.

    The unfiltered rows are stored once; the summary counts all of them, the table keeps those of ``genes`` (``value``).
    """
    rows = stored(variants_table(scanned, clinical), "variants")
    unit_summary(rows).write.mode("overwrite").parquet(f"{out}/variant_summary.parquet")
    keep_listed(rows, "hugo_symbol", genes).select(*rows.columns).write.mode("overwrite").parquet(f"{out}/variants.parquet")
    read = rows.sparkSession.read
    return read.parquet(f"{out}/variants.parquet"), read.parquet(f"{out}/variant_summary.parquet")


def unit_summary(facts: DataFrame, *, entity: str = "submitter_id", unit: str = "tumor_barcode", paired: str = "normal_barcode", paired_label: str = "normal_source", primary: str = "primary_aliquot", coding: str = "is_coding", high: str = "is_high_impact") -> DataFrame:
    """One row per entity: number of units, the primary unit with its pair, and burden on primary rows.

    Two aggregations: by (entity, unit), which spreads an entity with many rows, then by entity. Rows are dealt by entity and
    unit before they are counted, so that no task that reads a large split of a file holds the groups of all its rows.
    """
    per_unit = facts.filter(F.col(entity).isNotNull()).repartition(entity, unit).groupBy(entity, unit).agg(
        F.min(F.struct(F.col(paired).isNull(), F.col(paired), F.col(paired_label))).alias("_pair"),
        F.max(F.col(primary)).alias("_primary"),
        F.count_if(F.col(primary)).alias("_total"),
        F.count_if(F.col(primary) & F.col(coding)).alias("_coding"),
        F.count_if(F.col(primary) & F.col(high)).alias("_high"),
    )
    first = F.min(F.when(F.col("_primary"), F.struct(F.col(unit).alias("u"), F.col(f"_pair.{paired}").alias("p"), F.col(f"_pair.{paired_label}").alias("s"))))
    out = per_unit.groupBy(entity).agg(
        F.count(F.lit(1)).alias("n_tumor_aliquots"), first.alias("_f"),
        F.sum("_total").alias("n_variants_total"), F.sum("_coding").alias("n_variants_coding"), F.sum("_high").alias("n_variants_high_impact"),
    )
    return out.select(
        entity, F.col("_f.u").alias("primary_tumor_barcode"), F.col("_f.p").alias("primary_normal_barcode"), F.col("_f.s").alias("normal_source"),
        "n_tumor_aliquots", "n_variants_total", "n_variants_coding", "n_variants_high_impact",
    )


BURDEN = ["n_variants_total", "n_variants_coding", "n_variants_high_impact"]


def join_summary(entities: DataFrame, summary: DataFrame, *, entity: str = "submitter_id", counts: list[str] = BURDEN) -> DataFrame:
    """Left join that keeps entities without facts: counts become zero, identifiers stay null."""
    return entities.join(summary, entity, "left").fillna(0, [c for c in counts if c in summary.columns])


def burden_quantiles(table: DataFrame, value: str, *, exact: bool = True, accuracy: int = 10_000) -> DataFrame:
    """Median, lower and upper quartile (nearest rank) and largest value, in one row; approximate quartiles on demand."""
    if exact:
        quartile = lambda q: F.expr(f"percentile_disc({q}) within group (order by `{value}`)")
    else:
        quartile = lambda q: F.percentile_approx(value, q, accuracy)
    middle = F.median(value) if exact else quartile(0.5)
    kind = table.schema[value].dataType
    return table.agg(middle.cast("double").alias("median"), quartile(0.25).cast(kind).alias("q25"), quartile(0.75).cast(kind).alias("q75"), F.max(value).alias("largest"))


def value_counts(table: DataFrame, column: str | Column, top: int | None = None) -> DataFrame:
    """(value, n) by count and value; all of them, or the first ``top``."""
    out = table.groupBy(F.col(column).alias("value") if isinstance(column, str) else column.alias("value")).agg(F.count("*").alias("n"))
    out = out.orderBy(F.desc("n"), "value")
    return out if top is None else out.limit(top)
