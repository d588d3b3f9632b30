"""Nested metadata: flattening, provenance without guesses, and rollups of file catalogues.

A catalogue row is a file with ``cases: array<struct<case_id, submitter_id, project: struct<project_id>, samples: array<...>>>``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from ..functions import category_slug, classify_support


def _scalars(kind: StructType) -> list[str]:
    return [f.name for f in kind.fields if not isinstance(f.dataType, (StructType, ArrayType, MapType))]


def _element(kind: DataType) -> StructType:
    return kind.elementType if isinstance(kind, ArrayType) else kind


def flatten_case(cases: DataFrame, *, keep: tuple[str, ...] = ("case_id", "submitter_id", "disease_type", "primary_site")) -> DataFrame:
    """One flat row per case: scalar leaves with a prefix, the first of each nested list, and list lengths.

    Which columns come out follows from the schema. Treatments are those of the first diagnosis, counted over all.
    """
    schema = cases.schema
    out: list[Column] = [F.col(c) for c in keep if c in schema.fieldNames()]
    if "project" in schema.fieldNames():
        out.append(F.col("project.project_id").alias("project_id"))
    if "demographic" in schema.fieldNames():
        out += [F.col(f"demographic.{n}").alias(f"demographic_{n}") for n in _scalars(schema["demographic"].dataType)]
    lists = (("diagnoses", "diagnosis", "n_diagnoses"), ("exposures", "exposure", "n_exposures"), ("family_histories", "family_history", "n_family_histories"))
    for column, prefix, counter in lists:
        if column not in schema.fieldNames():
            continue
        kind, first = _element(schema[column].dataType), F.get(F.col(column), F.lit(0))
        out.append(F.coalesce(F.size(column), F.lit(0)).alias(counter))
        out += [first[n].alias(f"{prefix}_{n}") for n in _scalars(kind)]
        if column == "diagnoses" and "treatments" in kind.fieldNames():
            given = F.aggregate(column, F.lit(0), lambda n, d: n + F.coalesce(F.size(d["treatments"]), F.lit(0)))
            out.append(F.coalesce(given, F.lit(0)).alias("n_treatments"))
            treatment = F.get(first["treatments"], F.lit(0))
            out += [treatment[n].alias(f"treatment_{n}") for n in _scalars(_element(kind["treatments"].dataType))]
    return cases.select(*out)


def provenance(hits: DataFrame) -> DataFrame:
    """Adds case and sample identifiers, only where exactly one case (and sample) belongs to the file; JSON keeps all."""
    n = F.coalesce(F.size("cases"), F.lit(0))
    case = F.when(n == 1, F.get("cases", F.lit(0)))
    samples = F.when(n == 1, F.coalesce(case["samples"], F.array().cast(_element(hits.schema["cases"].dataType)["samples"].dataType)))
    sample = F.when(F.size(samples) == 1, F.get(samples, F.lit(0)))
    has = _element(_element(hits.schema["cases"].dataType)["samples"].dataType).fieldNames()
    pick = lambda name: sample[name] if name in has else F.lit(None).cast("string")
    return hits.withColumns(
        {
            "n_cases": n,
            "cases_json": F.to_json(F.coalesce("cases", F.array().cast(hits.schema["cases"].dataType))),
            "case_id": case["case_id"],
            "submitter_id": F.coalesce(case["submitter_id"], case["case_id"]),
            "project_id": case["project"]["project_id"],
            "n_samples": F.when(n == 1, F.size(samples)),
            "samples_json": F.to_json(samples),
            "sample_id": pick("sample_id"),
            "sample_submitter_id": pick("submitter_id"),
            "sample_type": pick("sample_type"),
            "tissue_type": pick("tissue_type"),
        }
    )


def single_case_key(hits: DataFrame) -> DataFrame:
    """(file_id, case_id, submitter_id) of files with exactly one case; the submitter falls back to the case."""
    one = hits.filter(F.size("cases") == 1).select("file_id", F.get("cases", F.lit(0)).alias("c"))
    return one.select("file_id", F.col("c.case_id").alias("case_id"), F.coalesce("c.submitter_id", "c.case_id").alias("submitter_id"))


def manifest(hits: DataFrame, present: DataFrame | None = None) -> DataFrame:
    """Provenance, target path ``<submitter or _multi>/<category>/<file>`` and status by presence of that path."""
    out = provenance(hits)
    folder = F.coalesce("submitter_id", F.lit("_multi"))
    out = out.withColumn("local_path", F.concat_ws("/", folder, category_slug(F.col("data_category")), F.col("file_name")))
    if present is None:
        return out.withColumn("status", F.lit("ok"))
    there = present.select("local_path", F.lit("ok").alias("status")).distinct()
    return out.join(there, "local_path", "left").withColumn("status", F.coalesce("status", F.lit("missing")))


def unnest(hits: DataFrame) -> DataFrame:
    """A row per file, case and sample; files without cases and cases without samples keep one row with nulls."""
    cases = hits.select("*", F.explode_outer("cases").alias("_case")).drop("cases")
    return cases.select("*", F.explode_outer("_case.samples").alias("_sample"))


def coverage(hits: DataFrame, *, program: str, projects: list[str] | None = None) -> DataFrame:
    """Distinct files and cases, and size once per file, by project and six metadata fields, with what each group supports."""
    clean = lambda c: F.when(c.cast("string") != "", c.cast("string"))
    base = {
        "data_category": F.col("data_category"), "data_type": F.col("data_type"), "data_format": F.col("data_format"),
        "experimental_strategy": F.col("experimental_strategy"), "workflow_type": F.col("analysis.workflow_type"), "access": F.col("access"),
    }
    rows = hits.select("file_id", F.coalesce("file_size", F.lit(0)).alias("size"), *[clean(c).alias(n) for n, c in base.items()], F.explode("cases").alias("c"))
    rows = rows.withColumn("access", F.coalesce("access", F.lit("open"))).withColumn("project_id", F.col("c.project.project_id")).filter("project_id != ''")
    if projects is not None:
        rows = rows.filter(F.col("project_id").isin(*projects))
    keys = ["project_id", *base]
    per_file = rows.groupBy(*keys, "file_id").agg(F.max("size").alias("size"))
    files = per_file.groupBy(*keys).agg(F.count("*").alias("n_files"), F.sum("size").alias("total_size"))
    cases = rows.select(*keys, F.col("c.case_id").alias("case_id")).groupBy(*keys).agg(F.count_distinct("case_id").alias("n_cases"))
    same = lambda a, b: [a[k].eqNullSafe(b[k]) for k in keys]
    both = files.alias("f").join(cases.alias("k"), same(files, cases)).select("f.*", "k.n_cases")
    support = classify_support(F.col("data_category"), F.col("data_type"), F.col("data_format"), F.col("experimental_strategy"), F.col("workflow_type"))
    out = both.withColumn("program", F.lit(program)).withColumn("_s", support)
    return out.select("program", *keys, "n_files", "n_cases", "total_size", "_s.*").orderBy(*[F.asc_nulls_first(k) for k in keys])


def preview(hits: DataFrame) -> DataFrame:
    """One row: files, distinct cases, total size and files with several cases."""
    n_files = hits.agg(F.count("*").alias("n_files"), F.coalesce(F.sum("file_size"), F.lit(0)).alias("total_size"), F.count_if(F.size("cases") > 1).alias("n_multi_case"))
    n_cases = hits.select(F.explode("cases").alias("c")).agg(F.count_distinct("c.case_id").alias("n_cases"))
    return n_files.crossJoin(n_cases)  # one row by one row


def files_by_category(hits: DataFrame, column: str = "data_category") -> DataFrame:
    return hits.groupBy(F.coalesce(column, F.lit("unknown")).alias(column)).agg(F.count("*").alias("n_files")).orderBy(column)


def canonical_json(column: Column, kind: DataType) -> Column:
    """JSON with the fields of every struct in alphabetical order, through arrays."""

    def ordered(x: Column, k: DataType) -> Column:
        if isinstance(k, StructType):
            return F.when(x.isNotNull(), F.struct(*[ordered(x[f.name], f.dataType).alias(f.name) for f in sorted(k.fields, key=lambda f: f.name)]))
        if isinstance(k, ArrayType) and isinstance(k.elementType, (StructType, ArrayType)):
            return F.transform(x, lambda y: ordered(y, k.elementType))
        return x

    return F.to_json(ordered(column, kind))
