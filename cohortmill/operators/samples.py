"""The samples table: one row per case with labels, demographics, unit structure and burden."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import program_of_project, years_from_days
from .crosswalk import CLINICAL_COLUMNS, attach_ontology, lineage
from .variants import contract_order, join_summary, unit_summary

SAMPLE_COLUMNS = (
    "case_id", "submitter_id", "project_id", "program", "primary_site", "disease_type", "primary_diagnosis", "lineage", "oncotree_code", "oncotree_name",
    "oncotree_main_type", "oncotree_tissue", "gender", "race", "ethnicity", "age_at_diagnosis_days", "age_at_diagnosis_years", "vital_status", "days_to_death",
    "days_to_last_followup", "ajcc_pathologic_stage", "n_tumor_aliquots", "primary_tumor_barcode", "primary_normal_barcode", "normal_source",
    "n_variants_total", "n_variants_coding", "n_variants_high_impact",
)


def samples_table(clinical: DataFrame, variants: DataFrame | None = None, summary: DataFrame | None = None, *, ontology: DataFrame | None = None, project_codes: DataFrame | None = None) -> DataFrame:
    """Clinical cases with derived labels and their variant summary; cases without variants have zero burden.

    The unfiltered ``summary`` is preferred; without it, it is computed from ``variants``. ``ontology`` (code, name,
    main_type, tissue) gives the ontology columns, by ``project_codes`` (project_id, oncotree_code) or the known projects.
    """
    out = clinical.select(*[F.col(a).alias(b) for a, b in CLINICAL_COLUMNS.items() if a in clinical.columns])
    if "project_id" in out.columns:
        if "primary_site" not in out.columns:
            out = out.withColumn("primary_site", F.lit(None).cast("string"))
        out = lineage(out.withColumn("program", program_of_project(F.col("project_id"))))
    if "age_at_diagnosis_days" in out.columns:
        out = out.withColumn("age_at_diagnosis_years", years_from_days(F.col("age_at_diagnosis_days")))
    if ontology is not None and "project_id" in out.columns:
        out = attach_ontology(out, ontology, project_codes)
    if summary is None and variants is not None:
        summary = unit_summary(variants)
    if summary is not None:
        out = join_summary(out, summary)
    return contract_order(out, SAMPLE_COLUMNS)
