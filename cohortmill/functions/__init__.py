"""Column expressions: built-in functions only, null-safe under ANSI mode."""

from .columns import (
    NON_CODING_CLASSES, allele_fraction, category_slug, classify_support, feature_slug, header_name, high_impact, item_count, lenient_double,
    lenient_long, log1p_or_null, log2_enrichment, non_coding_aware, normal_source, program_of_barcode, program_of_project, rare, rate, unversioned, years_from_days,
)

__all__ = [
    "NON_CODING_CLASSES", "allele_fraction", "category_slug", "classify_support", "feature_slug", "header_name", "high_impact", "item_count", "lenient_double",
    "lenient_long", "log1p_or_null", "log2_enrichment", "non_coding_aware", "normal_source", "program_of_barcode", "program_of_project", "rare", "rate", "unversioned", "years_from_days",
]
