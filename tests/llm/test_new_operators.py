"""Filter audit, language identification and fill-in-the-middle against brute force, planted mixtures and held-out rows."""

import hashlib
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortmill.llm import fill_in_middle as fim
from cohortmill.llm import html_extract, language_id, quality, queries, terms
from cohortmill.llm.common import words_of
from cohortmill.llm.filter_audit import filter_audit
from cohortmill.llm.language_id import identify_languages

from . import brute
from .test_llm import SCHEMA, odd_rows

LABELS = "doc_id long, quality int, toxic int, text string"


def audit_rows():
    """Odd rows, copies across parts, repeated rows, null ids and texts that fail each filter alone."""
    rng = random.Random(3)
    say = lambda n, words=9999: " ".join(f"w{rng.randrange(words)}" for _ in range(n))
    rows = [(*r[:2], *r[2:]) for r in odd_rows()]
    good = say(220)
    texts = [good, good, good.upper(), say(220, 20), good + " #", say(230), say(230), None, "", "a b " * 210, "É " * 300, say(220) + "\x0b\x0c\r\n\t", "ABC"]
    rows += [(100 + k, t, None, ("s", "t", None, "")[k % 4], None, "x") for k, t in enumerate(texts)]
    return rows + [(100, good, None, "s", None, "x"), (100, good, None, "t", None, "x"), (None, good, None, "u", None, None), (None, "one", None, "u", None, None), (3, "one", None, "u", None, None)]


def test_filter_audit_against_brute_force(spark):
    docs = audit_rows()
    labels = [(k, k % 2, int(k % 3 == 0), "clash") for k in range(0, 120, 2)] + [(100, 1, 1, None), (101, None, None, None), (None, 1, 1, None), (104, 0, 1, None), (104, 1, 0, None)]
    got = filter_audit(spark.createDataFrame(docs, SCHEMA).repartition(5), spark.createDataFrame(labels, LABELS))
    rows = {tuple(r) for r in got.collect()}
    assert rows == brute.filter_audit([(r[0], r[1], r[3]) for r in docs], labels) and len(rows) == 600 * 4


def test_filter_audit_of_nothing(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert filter_audit(nothing, spark.createDataFrame([], LABELS)).isEmpty()
    one = filter_audit(spark.createDataFrame([(1, None, None, None, None, None)], SCHEMA), spark.createDataFrame([], LABELS)).collect()
    assert len(one) == 600 and {r["part"] for r in one} == {""} and {r["shapley"] for r in one if r["filter_order"].startswith("A") and r["step"] == 1} == {120}


def test_filter_audit_against_sql(spark, small):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    exp = con.sql(queries.OP11_SQL)
    got = queries.op11_filter_interaction_audit(spark, small)
    assert got.columns == exp.columns and {tuple(r) for r in got.collect()} == set(exp.fetchall())


@pytest.mark.parametrize("units, size", [(4096, 1 << 18), (3, 1 << 18), (5, 4)])
def test_fill_in_middle_against_brute_force(spark, monkeypatch, units, size):
    monkeypatch.setattr(fim, "PIECE_UNITS", units)
    monkeypatch.setattr(fim, "PIECE_BYTES", size)
    monkeypatch.setattr(fim, "BLOCK", 7)
    rng = random.Random(units)
    alphabet = ["a", "Zz", " ", "<", ">", "<S", "P>", "é", "語", "\n", "0", "<M", "😀", "abcdefghijkl"]
    rows = [r for r in odd_rows() if len(r[1] or "") < 2000] + [(1000 + k, "".join(rng.choice(alphabet) for _ in range(rng.randrange(40))), None, None, None, None) for k in range(300)]
    rows += [(7, "again and again", None, None, None, None)] * 3 + [(None, "no id at all", None, None, None, None)] * 2
    docs = spark.createDataFrame(rows, SCHEMA)
    exp = [(i, *brute.fill_in_middle(i, t)[:4], *(hashlib.sha256(x.encode()).hexdigest() for x in (brute.fill_in_middle(i, t)[4], t or ""))) for i, t, *_ in rows]
    assert sorted(map(repr, map(tuple, fim.fill_in_middle(docs).collect()))) == sorted(map(repr, exp))
    assert {e[2] for e in exp} == {"plain", "psm", "spm"}
    made = sorted(repr((r["doc_id"], r["text"])) for r in fim.transformed_texts(docs).collect())
    assert made == sorted(repr((i, brute.fill_in_middle(i, t)[4])) for i, t, *_ in rows)


def test_fill_in_middle_of_a_long_text_and_of_none(spark):
    long = "word, " * 300_000 + "x" * 1_000_000
    docs = spark.createDataFrame([(k, long, None, None, None, None) for k in range(4)], SCHEMA)
    for r in fim.fill_in_middle(docs).collect():
        exp = brute.fill_in_middle(r["doc_id"], long)
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"]) == exp[:4] and r["output_sha256"] == hashlib.sha256(exp[4].encode()).hexdigest() and r["restored_sha256"] == hashlib.sha256(long.encode()).hexdigest()
    assert fim.fill_in_middle(spark.createDataFrame([], SCHEMA)).isEmpty()


def test_second_sort_moves_nothing(spark):
    """The plan has one exchange of the pieces and two sorts."""
    docs = spark.createDataFrame([(k, "some text here", None, None, None, None) for k in range(9)], SCHEMA)
    plan = fim.fill_in_middle(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 2


def words(rng, syllables, n):
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(n))


SYLLABLES = {"aa": ["ka", "lo", "mi", "tus"], "bb": ["sch", "en", "ung", "ber"], "cc": ["ción", "que", "ra", "ez"]}


@pytest.fixture(scope="module")
def model():
    rng = random.Random(1)
    counts = np.zeros((3, 1 << language_id.BITS))
    for k, s in enumerate(SYLLABLES.values()):
        for _, bucket in language_id.trigrams(pa.array([words(rng, s, 5000)])):
            counts[k] += np.bincount(bucket, minlength=counts.shape[1])
    return language_id.LanguageModel(list(SYLLABLES), counts)


def test_mixtures_are_found(model):
    rng = random.Random(2)
    texts, shares = [], []
    for a, b in (("aa", "bb"), ("bb", "cc"), ("cc", "aa")):
        for part in (0.6, 0.8):
            n = 400
            texts.append(words(rng, SYLLABLES[a], int(n * part)) + " " + words(rng, SYLLABLES[b], int(n * (1 - part))))
            letters = [sum(c.isalpha() for c in x) for x in (texts[-1][: len(texts[-1])],)]
            shares.append((a, b, part, letters))
    names, score, sets = model.predict(pa.array(texts), penalty=4.0)
    for (a, b, part, _), name, s, held in zip(shares, names, score, sets, strict=True):
        assert name == a and {x.split(":")[0] for x in held.split()} == {a, b} and abs(s - part) < 0.12
    names, score, sets = model.predict(pa.array([words(rng, SYLLABLES[x], 300) for x in SYLLABLES]), penalty=4.0)
    assert names == list(SYLLABLES) and (score == 1).all() and all(" " not in x for x in sets)


def test_proportions_reach_the_maximum(model):
    """Expectation-maximisation of two languages against a scan of their likelihood."""
    rng = random.Random(4)
    text = words(rng, SYLLABLES["aa"], 120) + " " + words(rng, SYLLABLES["bb"], 60)
    c = model.class_counts(pa.array([text]))
    got = model.fit(c, penalty=4.0)[0]
    grid = np.linspace(0.001, 0.999, 999)
    level = [(c[0] * np.log(g * model.p[0] + (1 - g) * model.p[1])).sum() for g in grid]
    assert abs(got[0] - grid[int(np.argmax(level))]) < 0.01 and got[2] == 0


def test_long_texts_in_blocks(monkeypatch):
    text = "Straße über Äpfel, ÇA va — 語 x1y2z " * 50
    whole = np.concatenate([b for _, b in language_id.trigrams(pa.array([text]))])
    monkeypatch.setattr(language_id, "LONG", 7)
    parts = list(language_id.trigrams(pa.array([text])))
    assert len(parts) > 100 and (np.concatenate([b for _, b in parts]) == whole).all()
    row, bucket = next(iter(language_id.trigrams(pa.array([None, text, "", "ab"]))))
    assert (bucket[row == 1] == whole).all() and (row == 3).sum() == 2 and set(row) == {1, 3}


def test_language_id_on_held_out_rows(spark, small):
    got = queries.op12_language_id(spark, small).join(spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r["lang"] == r["lang_pred"] for r in got if r["held_out"]]
    assert len(held) > 50 and sum(held) >= 0.97 * len(held) and all(0 <= r["score"] <= 1 for r in got)


def test_language_id_of_odd_rows(spark):
    rng = random.Random(6)
    rows = [(k, words(rng, SYLLABLES[x], 60), x, "s", None, None) for k, x in enumerate(list(SYLLABLES) * 10)]
    odd = [(500, None, "aa", "s", None, None), (501, "", None, "s", None, None), (502, "123 -- 4!", "bb", "s", None, None), (None, "kalomi tuska", None, "s", None, None), (504, "q", None, "s", None, None), (505, "ka " * 100_000, None, "s", None, None)]
    docs = spark.createDataFrame(rows + odd + odd[-1:], SCHEMA)
    got = identify_languages(docs, keep=("_text", "lang"))
    assert got.columns == ["doc_id", "_text", "lang", "held_out", "lang_pred", "score", "languages"] and got.count() == len(rows) + 7
    by = {r["doc_id"]: r for r in got.collect()}
    assert all(by[k]["lang_pred"] == "und" and by[k]["score"] == 0 for k in (500, 501, 502)) and by[None]["lang_pred"] == "aa" and not by[None]["held_out"] and by[505]["lang_pred"] == "aa"
    assert all(by[k]["lang_pred"] == x for k, _, x, *_ in rows) and by[504]["lang_pred"] in SYLLABLES
    blind = identify_languages(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {(r["lang_pred"], r["score"]) for r in blind.collect()} == {("und", 0.0)}
    assert identify_languages(spark.createDataFrame([], SCHEMA)).isEmpty()


def test_mcd_against_all_subsets(spark):
    """The determinant that concentration steps reach is that of the best of all subsets of the support's size."""
    from itertools import combinations

    rng = np.random.default_rng(2)
    names = [x for x, _ in quality.FEATURES][:2]
    floors = np.array([f for _, f in quality.FEATURES][:2]) * quality.SCALE
    groups = {}
    for g in range(6):
        inside = rng.normal(0, 400, (9, 2)) @ np.array([[1, 0.6], [0, 0.8]]) + g * 1000
        groups[f"s{g}"] = np.round(np.vstack([inside, rng.normal(0, 200, (3, 2)) + g * 1000 + [3000, -4000 + 500 * g]])).astype(int)
    rows = [(("x", g), *map(int, v)) for g, x in groups.items() for v in x]
    vectors = spark.createDataFrame(rows, "_grp struct<_lang:string,_source:string>, " + ", ".join(f"{n} long" for n in names))
    got = {r["_grp"]["_source"]: r["logdet"] for r in quality.mcd(vectors, names, support=0.75, prior=0).collect()}
    for g, x in groups.items():
        exp = min(np.linalg.slogdet(np.cov(x[list(c)].T, bias=True) + np.diag(floors**2))[1] for c in combinations(range(12), 9))
        assert abs(got[g] - exp) < 0.02


def test_active_terms_are_looked_up_in_runs(monkeypatch):
    """With active terms no word is hashed on its own, and the features are those of ``term_buckets``."""
    words = ["secret", "secrets", "(secretly)", "a", "ab--", "--", "-", "…", "über", "überall", "x?!", "?!", "toxic!!", "toxic", ""]
    texts = pa.array([" ".join(words), None, "", "secretary, ?! toxi", *words])
    plain = [[terms.term_buckets(w, 12) for w in words_of(t)] for t in texts.to_pylist()]
    every = sorted({b for t in plain for w in t for b in w})
    for active in ({b: k for k, b in enumerate(every[::2])}, {}):
        want = [sorted({active[b] for w in t for b in w if b in active}) for t in plain]
        with monkeypatch.context() as m:
            m.setattr(terms, "term_buckets", None)
            n, got = terms.TermCache(12, active).batch(texts)
        assert [g.tolist() for g in got] == want and n.tolist() == [len(t) for t in plain]


def test_mcd_starts_share_their_steps(spark, monkeypatch):
    """Both starts go on in the same jobs, two tables a step: plans, not rows, are what the driver's memory holds."""
    real, made = quality.materialize, []
    monkeypatch.setattr(quality, "materialize", lambda df, name, **o: made.append(name) or real(df, name, **o))
    names = [x for x, _ in quality.FEATURES][:2]
    rows = [((None, f"s{k % 3}"), int(x), int(y)) for k, (x, y) in enumerate(np.random.default_rng(4).normal(0, 400, (90, 2)))]
    schema = "_grp struct<_lang:string,_source:string>, " + ", ".join(f"{n} long" for n in names)
    assert quality.mcd(spark.createDataFrame(rows, schema), names).count() == 3
    assert made.count("mcd-start") == 1 and len(made) == 3 + 2 * made.count("mcd-step")
    assert quality.mcd(spark.createDataFrame([], schema), names).isEmpty()


def test_parser_is_linear():
    """A megabyte of malformed markup takes less than a few seconds, and keeps its text."""
    import time

    for page in ("<a " * 350_000, "<div>" * 100_000 + "</p>" * 100_000, "<div>" * 90_000 + "</section>" * 90_000, '<a "' * 250_000, "<" * 10**6, "<!" * 500_000, "<!-- " * 200_000, "<script>" * 125_000, "<div><article>" + "<section>" * 60_000 + "</div>" * 60_000):
        began = time.time()
        html_extract.blocks(page)
        assert time.time() - began < 5
    assert html_extract.blocks('<article><p title="a>b">one</p><p class="x>two</p>') == [(2, "one"), (2, "two")]
    assert html_extract.blocks("<article>1 < 2 <3 <") == [(2, "1 < 2 <3 <")]


@pytest.mark.parametrize("name, part", [("social-science", 2), ("side-by-side", 2), ("related-work", 2), ("site-footer", 0), ("related-posts", 0), ("ad", 0), ("x cookie-banner", 0), ("comment-17", 0), ("administration", 2)])
def test_furniture_names(name, part):
    page = f'<article><p>before</p><div class="{name}">inside</div><p>after</p></article>'
    assert dict((t, p) for p, t in html_extract.blocks(page))["inside"] == part
