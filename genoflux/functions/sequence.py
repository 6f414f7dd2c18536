"""Sequence rules: validation, identity, CIGAR counts, composition, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

IUPAC = "ACGTURYKMSWBDHVN-"


def stripped(c: Column) -> Column:
    """Without white space at both ends, as Python's strip()."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def fixed(c: Column, digits: int) -> Column:
    """A double with ``digits`` (1 to 3) decimals, as C prints it: its binary value decides, ties go to
    the even digit. (Java's format rounds the shortest decimal text, ties up.) Null stays null.

    Twice the scaled value is taken as an exact sum of two doubles, from halves of the value's bits.
    """
    v, scale = F.abs(c), 10**digits
    high = v * 134217729.0 - (v * 134217729.0 - v)
    a, b = high * (2.0 * scale), (v - high) * (2.0 * scale)
    total = a + b
    rest = b - (total - a)
    whole = F.floor(total)
    below = F.when((total == whole) & (rest < 0), whole - 1).otherwise(whole)
    tie = (total == whole) & (rest == 0)
    up = (below % 2 == 1) & (~tie | (below % 4 == 3))
    r = (F.shiftright(below, 1) + up.cast("bigint")).cast("bigint")
    text = F.concat(F.floor(r / scale).cast("string"), F.lit("."), F.lpad((r % scale).cast("string"), digits, "0"))
    return F.concat(F.when(c < 0, "-").otherwise(""), text)


def count_of(text: Column, letters: str) -> Column:
    """How many characters are one of ``letters``."""
    return F.length(text) - F.length(F.translate(text, letters, ""))


def invalid_reason(seq: Column, min_length: int = 100) -> Column:
    """The first reason against a sequence, or null. Ambiguity codes but N are invalid."""
    s = F.upper(stripped(F.coalesce(seq, F.lit(""))))
    n = F.length(s)
    return (
        F.when(n < min_length, "too_short")
        .when(~s.rlike("^[ACGTN-]*$"), "invalid_characters")
        .when(count_of(s, "N") * 2 > n, "too_many_n")
        .when(count_of(s, "-") * 5 > n * 4, "too_many_gaps")
    )


def sanitised(seq: Column, min_length: int = 100) -> Column:
    """Upper case, no white space, U as T; null if too short, too gappy or of other letters."""
    s = F.translate(F.upper(F.regexp_replace(seq, r"\s", "")), "U", "T")
    n = F.length(s)
    return F.when(s.rlike(f"^[{IUPAC}]*$") & (n >= min_length) & (count_of(s, "-") * 5 <= n * 4), s)


def processid_of(header: Column) -> Column:
    return F.nullif(F.regexp_extract(header, r"_([^.\s_]+)(?:[.\s]|$)", 1), F.lit(""))


def header_of(organism: Column, processid: Column) -> Column:
    return F.concat(organism, F.lit("_"), processid, F.lit(".COI-5P"))


def ungapped_length(aln: Column) -> Column:
    """Letters but gaps and capital N (lower-case n counts)."""
    return F.length(F.translate(aln, "-N", ""))


def normal_species(species: Column) -> Column:
    return F.regexp_replace(stripped(F.coalesce(species, F.lit(""))), r"\s+", " ")


def genus_of(species: Column) -> Column:
    return F.coalesce(F.get(F.split(normal_species(species), " "), 0), F.lit(""))


def classic_identity(distance: Column, len1: Column, len2: Column) -> Column:
    longest = F.greatest(len1, len2)
    return F.when(longest == 0, F.lit(1.0)).otherwise(F.lit(1.0) - distance / longest)


def cigar_count(cigar: Column, ops: str) -> Column:
    """Total length of the given operations ('=M' counts both as matches)."""
    runs = F.regexp_extract_all(cigar, F.lit(f"([0-9]+)[{ops}]"), F.lit(1))
    return F.aggregate(F.transform(runs, lambda r: r.cast("int")), F.lit(0), lambda a, r: a + r)


def cigar_counts(cigar: Column) -> Column:
    return F.struct(*[cigar_count(cigar, ops).alias(name) for ops, name in (("=M", "matches"), ("X", "mismatches"), ("I", "insertions"), ("D", "deletions"))])


def path_free_identity(query: Column, target: Column, distance: Column | None = None) -> Column:
    """Identity without an alignment path: matches are taken as longest - distance
    (``distance``: the edit distance, if it is known).

    Both empty is an error of the input and gives null; one empty gives zeros.
    """
    q, t = F.length(query), F.length(target)
    d = F.levenshtein(query, target) if distance is None else distance
    approx = F.greatest(q, t) - d
    empty = (q == 0) | (t == 0)
    method = F.when(empty, "empty_sequence").when(query == target, "identical").otherwise("classic_fallback")
    zero = F.lit(0.0)
    return F.when(
        (q > 0) | (t > 0),
        F.struct(
            d.alias("edit_distance"),
            F.when(empty, F.lit(0)).otherwise(approx).alias("matches"),
            F.when(empty, zero).otherwise(approx / t.cast("double")).alias("target_identity"),
            F.when(empty, zero).otherwise(F.lit(1.0) - d / F.greatest(q, t)).alias("classic_identity"),
            method.alias("method"),
        ),
    )


def aligned_identity(a: Column, b: Column) -> Column:
    """Share of equal positions among those where both are A, C, G or T; 0 if there is none.

    Null for sequences of unequal length, which is an error of the input.
    """
    pairs = F.zip_with(F.split(F.upper(a), ""), F.split(F.upper(b), ""), lambda x, y: F.when(x.rlike("^[ACGT]$") & y.rlike("^[ACGT]$"), (x == y).cast("int")))
    used = F.filter(pairs, lambda p: p.isNotNull())
    same = F.aggregate(used, F.lit(0), lambda s, p: s + p)
    return F.when(F.length(a) == F.length(b), F.when(F.size(used) > 0, same / F.size(used)).otherwise(F.lit(0.0)))


def sequence_stats(seq: Column) -> Column:
    s = F.upper(seq)
    n = F.length(s)
    each = {b: count_of(s, b) for b in "ACGT"}
    acgt = each["A"] + each["C"] + each["G"] + each["T"]
    return F.struct(
        n.alias("length"),
        F.when(acgt > 0, (each["G"] + each["C"]) / acgt * 100).otherwise(F.lit(0.0)).alias("gc_content"),
        *[c.alias(f"n_{b.lower()}") for b, c in each.items()],
        count_of(s, "N").alias("n_count"),
        F.when(n > 0, count_of(s, "N") / n * 100).otherwise(F.lit(0.0)).alias("n_percent"),
        count_of(s, "-").alias("gap_count"),
    )


def short_label(group: Column) -> Column:
    return F.regexp_replace(group, "consensus_", "")


def species_label(assigned_sp: Column, group: Column) -> Column:
    return F.trim(F.concat_ws(" ", F.coalesce(assigned_sp, F.lit("")), short_label(group)))


def base_group(group: Column) -> Column:
    """consensus_c7_n125 -> consensus_c7; other names stay."""
    return F.coalesce(F.nullif(F.regexp_extract(group, r"^(consensus_c\d+)(?:_n\d+)?$", 1), F.lit("")), group)
