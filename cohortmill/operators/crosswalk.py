"""Labels from lookup tables and from ordered prefix rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Tissue of each project (None where a project spans several), and ordered prefixes of primary sites.
TISSUES = {
    "TCGA-ACC": "adrenal", "TCGA-BLCA": "bladder", "TCGA-BRCA": "breast", "TCGA-CESC": "cervix", "TCGA-CHOL": "bile_duct", "TCGA-COAD": "colon",
    "TCGA-DLBC": "lymph_node", "TCGA-ESCA": "esophagus", "TCGA-GBM": "brain", "TCGA-HNSC": "head_and_neck", "TCGA-KICH": "kidney", "TCGA-KIRC": "kidney",
    "TCGA-KIRP": "kidney", "TCGA-LAML": "bone_marrow", "TCGA-LGG": "brain", "TCGA-LIHC": "liver", "TCGA-LUAD": "lung", "TCGA-LUSC": "lung",
    "TCGA-MESO": "pleura", "TCGA-OV": "ovary", "TCGA-PAAD": "pancreas", "TCGA-PCPG": "adrenal", "TCGA-PRAD": "prostate", "TCGA-READ": "rectum",
    "TCGA-SARC": "soft_tissue", "TCGA-SKCM": "skin", "TCGA-STAD": "stomach", "TCGA-TGCT": "testis", "TCGA-THCA": "thyroid", "TCGA-THYM": "thymus",
    "TCGA-UCEC": "uterus", "TCGA-UCS": "uterus", "TCGA-UVM": "eye", "TARGET-AML": "bone_marrow", "TARGET-ALL-P2": "bone_marrow", "TARGET-ALL-P3": "bone_marrow",
    "TARGET-NBL": "peripheral_nervous_system", "TARGET-OS": "bone", "TARGET-WT": "kidney", "MMRF-COMMPASS": "bone_marrow", "ALCHEMIST-ALCH": "lung",
    "MP2PRT-ALL": "bone_marrow", "BEATAML1.0-COHORT": "bone_marrow", "CMI-MBC": "breast", "CMI-MPC": "prostate", "CMI-ASC": "soft_tissue",
    "CGCI-HTMCP-CC": "cervix", "CGCI-BLGSP": "lymph_node", "RC-PTCL": "lymph_node", "CDDP_EAGLE-1": "lung", "CCG-CUPP": "unknown_primary",
    "HCMI-CMDC": None, "CPTAC-2": None, "CPTAC-3": None, "EXCEPTIONAL_RESPONDERS-ER": None,
}
SITE_PREFIXES = (
    ("bronchus and lung", "lung"), ("liver and intrahepatic bile ducts", "liver"), ("hematopoietic and reticuloendothelial", "bone_marrow"),
    ("bones, joints and articular cartilage", "bone"), ("heart, mediastinum, and pleura", "pleura"), ("breast", "breast"), ("lung", "lung"), ("liver", "liver"),
    ("pancreas", "pancreas"), ("brain", "brain"), ("kidney", "kidney"), ("colon", "colon"), ("rectum", "rectum"), ("stomach", "stomach"), ("esophagus", "esophagus"),
    ("ovary", "ovary"), ("prostate", "prostate"), ("uterus", "uterus"), ("corpus uteri", "uterus"), ("cervix", "cervix"), ("bladder", "bladder"), ("skin", "skin"),
    ("thyroid", "thyroid"), ("testis", "testis"), ("thymus", "thymus"), ("adrenal", "adrenal"), ("eye", "eye"), ("lymph nodes", "lymph_node"),
    ("connective, subcutaneous", "soft_tissue"), ("bile ducts", "bile_duct"), ("head and neck", "head_and_neck"), ("lip", "head_and_neck"), ("tonsil", "head_and_neck"),
    ("gum", "head_and_neck"), ("biliary tract", "bile_duct"), ("spinal cord", "brain"),
)


# The ontology code of each project.
PROJECT_CODES = {
    "TCGA-ACC": "ACC", "TCGA-BLCA": "BLCA", "TCGA-BRCA": "BRCA", "TCGA-CESC": "CESC", "TCGA-CHOL": "CHOL", "TCGA-COAD": "COAD", "TCGA-DLBC": "DLBCLNOS", "TCGA-ESCA": "ESCA", "TCGA-GBM": "GB",
    "TCGA-HNSC": "HNSC", "TCGA-KICH": "CHRCC", "TCGA-KIRC": "CCRCC", "TCGA-KIRP": "PRCC", "TCGA-LAML": "AML", "TCGA-LGG": "DIFG", "TCGA-LIHC": "HCC", "TCGA-LUAD": "LUAD", "TCGA-LUSC": "LUSC",
    "TCGA-MESO": "PLMESO", "TCGA-OV": "HGSOC", "TCGA-PAAD": "PAAD", "TCGA-PCPG": "PHC", "TCGA-PRAD": "PRAD", "TCGA-READ": "READ", "TCGA-SARC": "SARCNOS", "TCGA-SKCM": "SKCM", "TCGA-STAD": "STAD",
    "TCGA-TGCT": "TESTIS", "TCGA-THCA": "THPA", "TCGA-THYM": "THYM", "TCGA-UCEC": "UCEC", "TCGA-UCS": "UCS", "TCGA-UVM": "UM",
    "TARGET-AML": "AML", "TARGET-ALL-P2": "BLL", "TARGET-ALL-P3": "BLL", "TARGET-NBL": "NBL", "TARGET-OS": "OS", "TARGET-WT": "WT",
    "MMRF-COMMPASS": "PCM", "ALCHEMIST-ALCH": "NSCLC", "MP2PRT-ALL": "BLL", "BEATAML1.0-COHORT": "AML", "CMI-MBC": "BRCA", "CMI-MPC": "PRAD", "CMI-ASC": "SARCNOS", "CGCI-HTMCP-CC": "CESC",
    "CGCI-BLGSP": "DLBCLNOS", "RC-PTCL": "PTCL", "CDDP_EAGLE-1": "LUAD", "CCG-CUPP": "CUP",
    "HCMI-CMDC": "OTHER", "CPTAC-2": "OTHER", "CPTAC-3": "OTHER", "EXCEPTIONAL_RESPONDERS-ER": "OTHER",
}


def map_dimension(df: DataFrame, key: str, dimension: DataFrame, dimension_key: str) -> DataFrame:
    """Left join of a lookup table with one row per key; Spark broadcasts it if it is small."""
    return df.join(dimension.withColumnRenamed(dimension_key, key) if dimension_key != key else dimension, key, "left")


def literal_dimension(spark, mapping: dict, key: str, value: str) -> DataFrame:
    return spark.createDataFrame(list(mapping.items()), f"{key} string, {value} string")


def first_part(x: Column) -> Column:
    """The text before the first comma, trimmed, in lower case."""
    return F.lower(F.trim(F.substring_index(x, ",", 1)))


def map_by_prefix(df: DataFrame, column: str, rules: DataFrame, *, default: str = "unknown", label: str = "label") -> DataFrame:
    """First rule (``prefix, label, priority``) whose prefix starts the cleaned value; ``default`` if none does.

    Rules meet the distinct values only, so the theta join is as small as the vocabulary; values join back by equality.
    Rules are a short hand-written list, which is what bounds their broadcast.
    """
    part = first_part(F.col(column))
    values = df.select(part.alias("_part")).filter("_part != ''").distinct()
    matched = values.join(F.broadcast(rules), F.col("_part").startswith(F.col("prefix"))).groupBy("_part").agg(F.min_by("label", "priority").alias("_label"))
    out = df.withColumn("_part", part).join(matched, "_part", "left").drop("_part")
    return out.withColumn(label, F.coalesce("_label", F.lit(default))).drop("_label")


def prefix_rules(spark, rules=SITE_PREFIXES) -> DataFrame:
    return spark.createDataFrame([(p, v, k) for k, (p, v) in enumerate(rules)], "prefix string, label string, priority int")


def lineage(df: DataFrame, *, project: str = "project_id", site: str = "primary_site", tissues: dict = TISSUES, rules=SITE_PREFIXES, label: str = "lineage") -> DataFrame:
    """Tissue of the project, or of the primary site where the project has none."""
    spark = df.sparkSession
    pinned = literal_dimension(spark, {k: v for k, v in tissues.items() if v is not None}, project, "_pinned")
    out = map_by_prefix(df.join(F.broadcast(pinned), project, "left"), site, prefix_rules(spark, rules), label=label)
    return out.withColumn(label, F.coalesce("_pinned", label)).drop("_pinned")


def missing_keys(mapping: DataFrame, key: str, nodes: DataFrame, node_key: str) -> DataFrame:
    """Keys of a mapping that the node table does not have; a complete mapping gives no rows."""
    return mapping.filter(F.col(key).isNotNull()).join(nodes.select(F.col(node_key).alias(key)), key, "left_anti").select(key).distinct()


# Columns taken from the clinical table, by their names in the samples table.
CLINICAL_COLUMNS = {
    "case_id": "case_id", "submitter_id": "submitter_id", "project_id": "project_id", "primary_site": "primary_site", "disease_type": "disease_type",
    "diagnosis_primary_diagnosis": "primary_diagnosis", "demographic_gender": "gender", "demographic_race": "race", "demographic_ethnicity": "ethnicity",
    "diagnosis_age_at_diagnosis": "age_at_diagnosis_days", "demographic_vital_status": "vital_status", "demographic_days_to_death": "days_to_death",
    "diagnosis_days_to_last_follow_up": "days_to_last_followup", "diagnosis_ajcc_pathologic_stage": "ajcc_pathologic_stage",
}


def project_codes(spark: SparkSession, codes: dict[str, str] = PROJECT_CODES) -> DataFrame:
    """(project_id, oncotree_code): the crosswalk from projects to ontology codes."""
    return spark.createDataFrame(list(codes.items()), "project_id string, oncotree_code string")


def attach_ontology(df: DataFrame, nodes: DataFrame, codes: DataFrame | None = None) -> DataFrame:
    """Adds ``oncotree_code``, ``oncotree_name``, ``oncotree_main_type`` and ``oncotree_tissue`` by the row's ``project_id``.

    ``nodes`` as by ``ontology_nodes``. A project without a code, or whose code is no node, has nulls; the code stays.
    """
    codes = project_codes(df.sparkSession) if codes is None else codes
    named = nodes.select(F.col("code").alias("oncotree_code"), F.col("name").alias("oncotree_name"), F.col("main_type").alias("oncotree_main_type"), F.col("tissue").alias("oncotree_tissue"))
    return df.join(codes.join(named, "oncotree_code", "left"), "project_id", "left")
