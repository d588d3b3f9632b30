"""Scalar expressions over columns. Every function takes and returns ``Column``; nothing here runs Python on data."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Variant classes that do not change a protein, impact levels that count as high, the population
# frequency below which a variant is rare, and the sample-type codes of normal tissue in barcodes.
NON_CODING_CLASSES = ("Silent", "Intron", "IGR", "3'UTR", "5'UTR", "3'Flank", "5'Flank", "RNA", "Targeted_Region")
HIGH_IMPACT_LEVELS = ("HIGH", "MODERATE")
RARE_BELOW = 1e-3
NORMAL_SOURCES = {
    "10": "Blood Derived Normal",
    "11": "Solid Tissue Normal",
    "12": "Buccal Cell Normal",
    "13": "EBV Immortalized Normal",
    "14": "Bone Marrow Normal",
    "15": "Lymphoid Normal",
}
EPSILON = 1e-6


def lenient_double(x: Column) -> Column:
    """Number or null: unparsable text and NaN are null."""
    value = x.try_cast("double")
    return F.when(~F.isnan(value), value)


def lenient_long(x: Column) -> Column:
    """Nearest integer, halves to even; unparsable text is null."""
    return F.bround(lenient_double(x)).try_cast("long")


def non_coding_aware(variant_class: Column, non_coding: Iterable[str] = NON_CODING_CLASSES) -> Column:
    """True unless the class is one of the non-coding ones; null stays null."""
    return ~variant_class.isin(*non_coding)


def high_impact(impact: Column, levels: Iterable[str] = HIGH_IMPACT_LEVELS) -> Column:
    return impact.isin(*levels)


def rare(frequency: Column, below: float = RARE_BELOW) -> Column:
    """Null frequency (never seen in the population) or strictly below the threshold."""
    value = lenient_double(frequency)
    return value.isNull() | (value < below)


def allele_fraction(alt: Column, depth: Column) -> Column:
    """alt / depth; null where the depth is zero or either is null."""
    return F.try_divide(alt.cast("double"), depth.cast("double"))


def rate(count: Column, total: Column) -> Column:
    return F.try_divide(count.cast("double"), total.cast("double"))


def log2_enrichment(a: Column, b: Column, eps: float = EPSILON) -> Column:
    return F.log2(a + eps) - F.log2(b + eps)


def item_count(joined: Column, separator: str = ";") -> Column:
    """Number of separated items; null and empty text have none."""
    text = F.coalesce(joined, F.lit(""))
    return F.when(text == "", 0).otherwise(F.size(F.split(text, f"\\Q{separator}\\E"))).cast("long")


def normal_source(barcode: Column, codes: dict[str, str] | None = None) -> Column:
    """Label of the two-character code that starts the fourth dash-separated part; null if there is none."""
    lookup = F.create_map(*[F.lit(x) for kv in (codes or NORMAL_SOURCES).items() for x in kv])
    return F.try_element_at(lookup, F.substring(F.get(F.split(barcode, "-"), F.lit(3)), 1, 2))


def program_of_project(project: Column) -> Column:
    """Text before the first dash, null without a dash."""
    return F.when(project.contains("-"), F.substring_index(project, "-", 1))


def program_of_barcode(barcode: Column) -> Column:
    """Text before the first dash; ``unknown`` for null, dashless or empty prefixes."""
    prefix = F.when(barcode.contains("-"), F.substring_index(barcode, "-", 1))
    return F.when(F.coalesce(prefix, F.lit("")) == "", F.lit("unknown")).otherwise(prefix)


def years_from_days(days: Column) -> Column:
    return F.round(lenient_double(days.cast("string")) / 365.25, 2)


def log1p_or_null(x: Column) -> Column:
    value = lenient_double(x.cast("string"))
    return F.when(value >= 0, F.log1p(value))


def unversioned(identifier: Column) -> Column:
    return F.substring_index(identifier, ".", 1)


def _slug(x: Column, default: str) -> Column:
    plain = F.regexp_replace(F.lower(F.trim(x)), r"[^\p{L}\p{N}]+", "_")
    plain = F.regexp_replace(plain, r"^_+|_+$", "")
    return F.when(F.coalesce(plain, F.lit("")) == "", F.lit(default)).otherwise(plain)


def feature_slug(x: Column) -> Column:
    """Lower case, every run of other than letters and digits one underscore, none at the ends; ``feature`` if empty."""
    return _slug(x, "feature")


def category_slug(x: Column) -> Column:
    """Lower case with runs of other than ASCII letters and digits as underscores; ``unknown`` if null or empty."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(F.trim(x)), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.when(F.coalesce(plain, F.lit("")) == "", F.lit("unknown")).otherwise(plain)


def header_name(x: Column) -> Column:
    """A column name from a header cell: lower case, ``space - . /`` as underscores, no parentheses, no doubled underscores."""
    plain = F.translate(F.lower(F.trim(x)), " -./()", "____")
    return F.regexp_replace(F.regexp_replace(plain, "_+", "_"), "^_|_$", "")


# What each kind of file supports, in order of precedence.
SUPPORT_RULES = (
    ({"category": ["Simple Nucleotide Variation"], "format": ["MAF"]}, "variants", "variants", "Masked somatic mutation files become variant rows."),
    ({"category": ["Transcriptome Profiling"], "type": ["Gene Expression Quantification"], "strategy": ["RNA-Seq"], "workflow": ["STAR - Counts"]}, "rna_expression", "rna_expression", "Gene counts become long-form gene expression."),
    ({"category": ["Transcriptome Profiling"], "type": ["miRNA Expression Quantification"], "strategy": ["miRNA-Seq"]}, "mirna_expression", "mirna_expression", "miRNA quantification becomes long-form miRNA expression."),
    ({"category": ["DNA Methylation"], "type": ["Methylation Beta Value"]}, "methylation", "methylation_beta", "Beta values are normalised by probe."),
    ({"category": ["Copy Number Variation"], "type": ["Copy Number Segment", "Masked Copy Number Segment"]}, "copy_number", "copy_number_segments", "Segments are normalised by genomic segment."),
    ({"category": ["Copy Number Variation"], "type": ["Gene Level Copy Number"]}, "copy_number", "gene_copy_number", "Gene-level copy numbers are normalised by gene."),
    ({"category": ["Proteome Profiling"], "type": ["Protein Expression Quantification"]}, "protein_expression", "protein_expression", "Protein expression is normalised by target."),
)


def classify_support(category: Column, kind: Column, file_format: Column, strategy: Column, workflow: Column, rules=SUPPORT_RULES) -> Column:
    """Struct (support_status, recipe, outputs, notes) of a group of files; the first rule that holds wins."""
    fields = {"category": category, "type": kind, "format": file_format, "strategy": strategy, "workflow": workflow}
    row = lambda status, recipe, outputs, notes: F.struct(
        F.lit(status).alias("support_status"), F.lit(recipe).cast("string").alias("recipe"), F.lit(outputs).alias("outputs"), F.lit(notes).alias("notes")
    )
    out = None
    for wanted, recipe, output, notes in rules:
        holds = F.lit(True)
        for name, values in wanted.items():
            holds = holds & F.coalesce(fields[name], F.lit("")).isin(*values)
        value = row("supported", recipe, f"{output}.parquet", notes)
        out = F.when(holds, value) if out is None else out.when(holds, value)
    out = out.when(F.coalesce(category, F.lit("")) == "Clinical", row("raw_only", None, "", "Clinical supplements are kept raw; case metadata comes from the case table."))
    return out.otherwise(row("raw_only", None, "", "Files can be tracked, but no recipe normalises them."))
