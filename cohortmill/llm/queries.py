"""Registered queries of this subpackage: name -> (spark, sf_dir) -> DataFrame, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import table
from .decontam import decontaminate
from .fill_in_middle import fill_in_middle
from .filter_audit import filter_audit
from .html_extract import extract_pages
from .jaccard_join import jaccard_components
from .language_id import identify_languages
from .line_dedup import line_dedup
from .lm_scoring import lm_scores
from .mixing import mix_sources
from .quality import quality_rules
from .secret_scan import digest, scan_secrets
from .token_output import token_digests, write_tokens
from .toxicity import toxicity_scores


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(scan_secrets(table(spark, sf_dir, "documents")))


#: Token shares that the mix aims at.
TARGETS = {"clean": 0.90, "low": 0.04, "toxic": 0.06}


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), TARGETS)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


def op6_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_digests(write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op11_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle(table(spark, sf_dir, "documents"))


REGISTERED = (
    op1_toxicity, op2_secret_scan, op3_source_mixing, op4_line_dedup, op5_lm_scoring, op6_token_output, op7_html_extraction,
    op8_jaccard_join, op9_benchmark_decontamination, op10_quality_rules, op11_filter_interaction_audit, op12_language_id, op13_fill_in_middle,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in REGISTERED}


LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP4_SQL = r"""WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
 w AS (SELECT doc_id, i, ls[i + 1] AS a, ls[i + 2] AS b, ls[i + 3] AS c FROM (SELECT doc_id, ls, unnest(range(0, len(ls) - 2)) AS i FROM l WHERE len(ls) >= 3)),
 r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, i) AS k, count(*) OVER (PARTITION BY a, b, c) AS n FROM w WHERE regexp_matches(a || b || c, '[^\x20\x09-\x0D]')),
 p AS (SELECT DISTINCT doc_id, p, k = 1 AS first FROM (SELECT doc_id, k, unnest(range(i, i + 3)) AS p FROM r WHERE n > 1)),
 g AS (SELECT doc_id, p FROM p WHERE NOT first EXCEPT SELECT doc_id, p FROM p WHERE first),
 x AS (SELECT doc_id, i, ls[i + 1] AS line FROM (SELECT doc_id, ls, unnest(range(0, len(ls))) AS i FROM l WHERE doc_id IN (SELECT doc_id FROM g))),
 t AS (SELECT x.doc_id, string_agg(line, chr(10) ORDER BY i) AS t FROM x LEFT JOIN g ON g.doc_id = x.doc_id AND g.p = x.i WHERE g.p IS NULL GROUP BY 1),
 c AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1)
SELECT l.doc_id, coalesce(len(ls), 0) AS n_lines, coalesce(c.n, 0) AS n_removed, CASE WHEN c.n IS NULL THEN text ELSE coalesce(t.t, '') END AS text FROM l LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)"""

OP8_SQL = rf"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWERED}, '[^\x20\x09-\x0D]+') AS w FROM documents),
 sh AS (SELECT DISTINCT doc_id, array_to_string(w[i + 1 : i + least(5, len(w))], ' ') AS s FROM (SELECT doc_id, w, unnest(range(0, greatest(len(w) - 4, 1))) AS i FROM d WHERE len(w) > 0)),
 n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
 o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM sh a JOIN sh b USING (s) WHERE a.doc_id < b.doc_id GROUP BY ALL),
 k AS (SELECT x, y FROM o JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * o >= 75 * (a.n + b.n - o)),
 e AS (SELECT x, y FROM k UNION ALL SELECT y, x FROM k),
 r AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m AS component_id FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT x, min(y) AS m FROM r GROUP BY 1) ON x = d.doc_id"""

WORDS = rf"regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP9_SQL = rf"""WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents), b AS (SELECT item_id, {WORDS} AS w FROM benchmark),
 bw AS (SELECT DISTINCT item_id, k, array_to_string(w[i + 1 : i + k], ' ') AS s FROM (SELECT item_id, w, least(len(w), 10) AS k, unnest(range(0, len(w) - least(len(w), 10) + 1)) AS i FROM b WHERE len(w) > 0)),
 dw AS (SELECT doc_id, i, k, array_to_string(w[i + 1 : i + k], ' ') AS s FROM (SELECT doc_id, w, k, unnest(range(0, len(w) - k + 1)) AS i FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k)),
 h AS (SELECT doc_id, i, k, item_id FROM dw JOIN bw USING (k, s)),
 p AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM h) GROUP BY 1),
 t AS (SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS l FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM h) GROUP BY 1)
SELECT d.doc_id, len(w) AS n_words, coalesce(p.n, 0) AS n_hit, coalesce(t.n, 0) AS n_items, sha256(coalesce(l, '')) AS items_sha256, coalesce(p.n, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN t USING (doc_id)"""


OP11_SQL = r"""WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS part, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
 f AS (SELECT t, min(doc_id) AS first FROM d GROUP BY 1), l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY 1),
 m AS (SELECT part, CASE WHEN len(w) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END + CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t) THEN 4 ELSE 0 END
   + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN doc_id > first THEN 16 ELSE 0 END AS mask, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic FROM d JOIN f USING (t) LEFT JOIN l USING (doc_id)),
 c AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM m GROUP BY 1, 2),
 x AS (SELECT substr('ABCDE', k, 1) AS letter, 1 << (k - 1) AS bit FROM range(1, 6) r(k)),
 p AS (SELECT '' AS prefix, '' AS letter, 0 AS bit, 0 AS applied, 0 AS step UNION ALL SELECT prefix || x.letter, x.letter, x.bit, applied | p.bit, step + 1 FROM p, x WHERE (applied | p.bit) & x.bit = 0),
 s AS (SELECT part, prefix, letter, step, sum(n) FILTER (mask & (applied | bit) = 0) AS kept, sum(n) FILTER (mask & bit <> 0 AND mask & applied = 0) AS removed, sum(n) FILTER (mask & bit <> 0 AND mask & applied <> 0) AS redundant,
   sum(n) FILTER (mask = bit) AS alone, sum(good) FILTER (mask & bit <> 0 AND mask & applied = 0) AS good_lost, sum(toxic) FILTER (mask & bit <> 0 AND mask & applied = 0) AS toxic_lost FROM c, p WHERE step > 0 GROUP BY ALL),
 o AS (SELECT prefix AS filter_order, unnest(range(1, 6)) AS step FROM p WHERE step = 5)
SELECT part, filter_order, CAST(o.step AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed, CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(alone, 0) AS BIGINT) AS unique_fails,
 CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost, CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM o JOIN s ON s.prefix = left(filter_order, o.step)"""


def oracle_sql() -> dict[str, str]:
    """SQL where it can express the whole result; the others are held against brute force or held-out rows in the tests."""
    return {"op4_line_dedup": OP4_SQL, "op8_jaccard_join": OP8_SQL, "op9_benchmark_decontamination": OP9_SQL, "op11_filter_interaction_audit": OP11_SQL}
