"""Quality rules with risk-controlled cutoffs, in SQL functions only.

Per document: counts of words, word characters, symbols, repeated lines and
words in repeated three-word windows. The base rule rejects short and highly
repetitive texts. The method adds cutoffs on four ratios, chosen per stratum
(language) from labelled documents. The cutoffs of all ratios together go along one path of
LEVELS, each stricter than the one before; a document goes if any ratio is over its cutoff of
the stratum's level. A level is tested by the exact binomial bound: it is admitted if, were its
rule to reject more than ``RISK`` of the accepted documents of the stratum, so few
rejected labelled ones would have at most the chance ``DELTA`` / strata. The levels of a
stratum are tested in their fixed order up to the first that fails, so they need no
correction among themselves; the strata are corrected for each other (Bonferroni). Then, with
probability 1 - ``DELTA``, the rules of all strata together reject at most ``RISK`` of the accepted
documents of each. A stratum needs some 220 accepted labelled documents (with four strata) before
any level can be admitted; those with fewer reject nothing beyond the base rule.

The binomial tail P(X <= k) of a share of RISK is summed in logarithms by its
recurrence, so it neither under- nor overflows at any n.

Repeated windows are found inside the row: 64-bit fingerprints of the windows
are packed with their positions, sorted, and equal neighbours marked, which is
O(n log n) in the text's words. Where packing could mix up two windows (equal
leading bits, or more words than positions fit) the row sorts full structures.

Defined cases: a null text has no words and fails; an empty table gives an empty
result; repeated rows are judged each for itself; null languages are a stratum;
null labels are left out, conflicting ones count as rejected; columns that are named
like the counts give way to them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, table, text_of

WHITE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
WIDTH = 3

RISK, DELTA = 0.02, 0.05
#: Ratio (numerator, denominator) and its cutoffs in thousandths, a level each, loosest
#: first: a document is over one if 1000 * numerator > cutoff * denominator.
RATIOS = {
    "symbols": ("n_symbols", "word_chars", [200, 150, 100, 80, 60, 40, 20, 10]),
    "lines": ("n_dup_lines", "n_lines", [500, 450, 400, 350, 300, 250, 200, 150]),
    "repeats": ("n_repeat_words", "n_words", [400, 300, 200, 150, 100, 75, 50, 30]),
    "long_words": ("word_chars", "n_words", [12000, 11000, 10000, 9000, 8000, 7500, 7000, 6500]),
}
LEVELS = 8
#: Strata that are broadcast at most; more are dealt with the documents to so many parts each.
STRATA, SALTS = 10_000, 64

_POSITION_BITS = 20


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, WHITE, -1), lambda w: w != "")


def _covered(starts: Column, n: Column) -> Column:
    """Words under windows of WIDTH at the sorted, distinct ``starts``."""
    step = lambda acc, s: F.struct(
        (acc["n"] + WIDTH - F.greatest(acc["end"] - s, F.lit(0))).alias("n"), (s + WIDTH).alias("end")
    )
    return F.aggregate(starts, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WIDTH).cast("long").alias("end")), step, lambda a: a["n"])


def _neighbours(rows: Column, key) -> Column:
    """Positions of sorted (key, position) rows whose key equals a neighbour's.
    Two shifted copies of the array meet element by element, so no step looks
    anything up."""
    null = F.array(F.lit(None))
    before = F.concat(null, F.slice(rows, F.lit(1), F.greatest(F.size(rows) - 1, F.lit(0))))
    after = F.concat(F.slice(rows, F.lit(2), F.greatest(F.size(rows) - 1, F.lit(0))), null)
    pairs = F.zip_with(before, after, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    marked = F.zip_with(
        rows, pairs, lambda r, p: F.struct(r.alias("r"), (F.coalesce(key(r) == key(p["a"]), F.lit(False)) | F.coalesce(key(r) == key(p["b"]), F.lit(False))).alias("same"))
    )
    return F.filter(marked, lambda m: m["same"])


def with_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed.

    Each projection is a plain column for the next, so no array is built twice.
    """
    text = F.col("__text")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    n = F.size("__words")
    # Fingerprints of the windows: three shifted copies of the words' hashes meet.
    hashes = F.transform("__words", lambda w: F.xxhash64(w))
    many = n >= WIDTH
    shifted = lambda k: F.slice("__hashes", F.lit(k + 1), F.greatest(n - WIDTH + 1, F.lit(0)))
    windows = F.zip_with(
        F.zip_with(shifted(0), shifted(1), lambda a, b: F.xxhash64(a, b)), shifted(2), lambda ab, c: F.xxhash64(ab, c)
    )
    mask = (1 << _POSITION_BITS) - 1
    packed = F.sort_array(
        F.transform("__windows", lambda h, i: F.shiftleft(F.shiftrightunsigned(h, _POSITION_BITS), _POSITION_BITS).bitwiseOR(i.cast("long")))
    )
    lead = lambda r: F.shiftrightunsigned(r, _POSITION_BITS)
    fast = F.transform(_neighbours(F.col("__packed"), lead), lambda m: m["r"].bitwiseAND(F.lit(mask).cast("long")))
    full = F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.cast("long").alias("i"))))
    slow = F.transform(_neighbours(full, lambda r: r["h"]), lambda m: m["r"]["i"])
    # Equal leading bits stand for equal fingerprints if there are as many
    # different leading bits as different fingerprints.
    safe = (n <= mask) & (
        F.size(F.array_distinct("__windows")) == F.size(F.array_distinct(F.transform("__windows", lambda h: F.shiftrightunsigned(h, _POSITION_BITS))))
    )
    return (
        docs.withColumn("__text", text_of(text_col))
        .withColumn("__words", words_of(text))
        .withColumn("__lines", lines)
        .withColumn("__hashes", hashes)
        .withColumn("__windows", F.when(many, windows).otherwise(F.array().cast("array<bigint>")))
        .withColumn("__packed", packed)
        .withColumn("__starts", F.array_sort(F.when(safe, fast).otherwise(slow)))
        .withColumn("n_words", n.cast("long"))
        .withColumn("word_chars", F.length(F.array_join("__words", "")).cast("long"))
        .withColumn("n_symbols", F.regexp_count(text, F.lit(SYMBOLS)).cast("long"))
        .withColumn("n_lines", F.size("__lines").cast("long"))
        .withColumn("n_dup_lines", (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"))
        .withColumn("n_repeat_words", _covered(F.col("__starts"), n))
        .withColumn(
            "base_failed",
            (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
        )
        .drop("__text", "__words", "__lines", "__hashes", "__windows", "__packed", "__starts")
    )


def binomial_tail(k: Column, n: Column, p: float = RISK) -> Column:
    """P(X <= k) for X ~ Bin(n, p), summed in logarithms."""
    odds = math.log(p / (1 - p))
    step = lambda acc, j: F.struct(
        (acc["log"] + F.log((acc["n"] - j + 1) / j.cast("double")) + odds).alias("log"),
        (acc["sum"] + F.exp(acc["log"] + F.log((acc["n"] - j + 1) / j.cast("double")) + odds)).alias("sum"),
        acc["n"].alias("n"),
    )
    first = n.cast("double") * math.log1p(-p)
    start = F.struct(first.alias("log"), F.exp(first).alias("sum"), n.cast("double").alias("n"))
    tail = F.aggregate(F.sequence(F.lit(1), k), start, step, lambda acc: acc["sum"])
    return F.when(k > 0, F.least(tail, F.lit(1.0))).otherwise(F.exp(first))


def over(level: int) -> Column:
    """Whether any ratio is over its cutoff of a level (from 1)."""
    out = F.lit(False)
    for top, bottom, grid in RATIOS.values():
        out = out | F.coalesce(F.lit(1000) * F.col(top) > F.lit(grid[level - 1]) * F.col(bottom), F.lit(False))
    return out


def cutoffs(counted: DataFrame, labels: DataFrame, stratum: str) -> DataFrame:
    """Written strata (__stratum) with the strictest admitted level (0: none), the accepted
    labelled documents behind it (n), and how many of them each level rejects.
    """
    accepted = (
        labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("lo")).where("lo = 1").select("doc_id")
    )
    good = counted.where(~F.col("base_failed")).join(accepted, "doc_id", "left_semi").groupBy(F.col(stratum).alias("__stratum"))
    rejected = materialize(good.agg(F.count("*").cast("int").alias("n"), *[F.count_if(over(t)).cast("int").alias(f"k{t}") for t in range(1, LEVELS + 1)]), "strata")
    # The correction counts every stratum that is tested.
    alpha = F.lit(DELTA / max(rejected.count(), 1))
    level = F.lit(LEVELS)
    for t in range(LEVELS, 0, -1):
        level = F.when(binomial_tail(F.col(f"k{t}"), F.col("n")) > alpha, F.lit(t - 1)).otherwise(level)
    return materialize(rejected.withColumn("level", level), "strata")


def judged(counted: DataFrame, chosen: DataFrame, stratum: str) -> DataFrame:
    """Adds ``kept``: passes the base rule and the rule of its stratum's level."""
    acting = chosen.where("level > 0").select("__stratum", F.col("level").alias("__level"))
    same = F.col(stratum).eqNullSafe(F.col("__stratum"))
    if acting.count() <= STRATA:
        joined = counted.join(F.broadcast(acting), same, "left")
    else:
        dealt = counted.withColumn("__part", F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(SALTS)))
        parts = acting.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
        joined = dealt.join(parts, same & (F.col("__part") == F.col("__salt")), "left")
    gone = F.lit(False)
    for t in range(1, LEVELS + 1):
        gone = gone | (F.coalesce(F.col("__level") == t, F.lit(False)) & over(t))
    return joined.withColumn("kept", ~F.col("base_failed") & ~gone)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.col("lang").alias("__lang"))
    counted = materialize(with_counts(docs).drop("text"), "counts")
    chosen = cutoffs(counted, table(spark, sf_dir, "labels"), "__lang")
    return judged(counted, chosen, "__lang").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def _oracle() -> str:
    rule = {t: " OR ".join(f"coalesce(1000 * {top} > {grid[t - 1]} * {bottom}, false)" for top, bottom, grid in RATIOS.values()) for t in range(1, LEVELS + 1)}
    counts = ", ".join(f"count(*) FILTER ({r}) AS k{t}" for t, r in rule.items())
    tail = (
        f"(SELECT sum(exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({RISK}::DOUBLE) + (n - j) * ln(1 - {RISK}::DOUBLE)))"
        " FROM unnest(range(0, k{t} + 1)) AS q(j))"
    )
    level = "CASE " + " ".join(f"WHEN {tail.format(t=t)} > {DELTA}::DOUBLE / s THEN {t - 1}" for t in rule) + f" ELSE {LEVELS} END"
    gone = " OR ".join(f"(level = {t} AND ({r}))" for t, r in rule.items())
    return rf"""
WITH d AS (SELECT row_number() OVER () AS u, doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT u, doc_id, lang, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
win AS (SELECT u, p, array_to_string(w[p:p + 2], ' ') AS x FROM w, unnest(range(1, len(w) - 1)) AS r(p) WHERE len(w) > 2),
rep AS (SELECT u, p FROM (SELECT u, p, count(*) OVER (PARTITION BY u, x) AS n FROM win) WHERE n > 1),
cov AS (SELECT u, count(DISTINCT q) AS n FROM rep, unnest(range(p, p + 3)) AS r(q) GROUP BY u),
c AS (
  SELECT w.u, doc_id, lang, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '{SYMBOLS}'))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN cov ON cov.u = w.u),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM c),
ok AS (SELECT doc_id FROM labels WHERE quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1),
g AS (SELECT lang, count(*) AS n, {counts} FROM b WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM ok) GROUP BY lang),
s AS (SELECT g.*, (SELECT count(*) FROM g) AS s FROM g),
cut AS (SELECT lang, {level} AS level FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT coalesce({gone}, false) AS kept
FROM b LEFT JOIN cut ON cut.lang IS NOT DISTINCT FROM b.lang
"""


QUERIES = {"op5_quality_rules": op5_quality_rules}
ORACLE_SQL = {"op5_quality_rules": _oracle()}
