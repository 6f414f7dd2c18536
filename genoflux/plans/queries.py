"""Registered queries and the same results in DuckDB's SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import coords, sequence
from ..operators import aggregates, align, assign, cluster, consensus, distance, geo, plotdata, progressive, qc, taxonomy, tree
from ..sources import tables
from . import fixtures as fx
from .storage import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return put


SPEC = f"spec AS ({fx.SPECIMENS})"
CONS = f"cons AS ({fx.CONSENSUS})"
NUM = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_bare = "trim(translate(trim(coord), '[](){}', ''))"
_num = lambda i: f"CASE WHEN regexp_matches(trim(parts[{i}]), '{NUM}') THEN try_cast(trim(parts[{i}]) AS double) END"
PAIRS = f"""pairs AS (
  SELECT *, CASE WHEN len(parts) = 2 THEN {_num(1)} END AS x, CASE WHEN len(parts) = 2 THEN {_num(2)} END AS y
  FROM (SELECT *, CASE WHEN contains({_bare}, ',') THEN string_split({_bare}, ',') ELSE regexp_split_to_array({_bare}, '\\s+') END AS parts FROM spec))"""
LOCATED = f"""{SPEC}, {PAIRS}, located AS (
  SELECT processid, ord, fam, genus, species, country_ocean, coord_source, coord, nuc, aln,
         CASE WHEN ok THEN x END AS latitude, CASE WHEN ok THEN y END AS longitude
  FROM (SELECT *, coalesce(x BETWEEN -90 AND 90 AND y BETWEEN -180 AND 180, false) AS ok FROM pairs))"""


def located(spark: SparkSession, d: str) -> DataFrame:
    return qc.with_coordinates(fx.specimens(spark, d))


# --- scans, projections, filters -------------------------------------------------


@query(
    "s01_keep_first_dedupe",
    "SELECT l_orderkey, l_linenumber, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS r FROM lineitem) WHERE r = 1",
)
def _(spark, d):
    """Line numbers of an order repeat; of equal ones the first in the files stays."""
    columns = ["l_orderkey", "l_linenumber", "l_partkey"]
    placed = tables.in_file_order(spark.read.parquet(f"{d}/lineitem.parquet")).select(*columns, "__file", "__row")
    return qc.keep_first(placed, "l_orderkey", ["l_linenumber", "__file", "__row"]).select(*columns)


@query("p01_strip", f"WITH {SPEC} SELECT processid, regexp_replace(concat('  ', species, '\t '), '^\\s+|\\s+$', '', 'g') AS species FROM spec")
def _(spark, d):
    return qc.strip_strings(fx.specimens(spark, d).select("processid", F.concat(F.lit("  "), "species", F.lit("\t ")).alias("species")))


@query("p02_coord_parse", f"WITH {LOCATED} SELECT processid, latitude, longitude FROM located")
def _(spark, d):
    return located(spark, d).select("processid", "latitude", "longitude")


@query(
    "p03_coord_order",
    f"WITH {SPEC}, {PAIRS} SELECT CASE WHEN count(*) FILTER (abs(x) > 90) > 0 AND count(*) FILTER (abs(y) > 90) = 0 THEN 'lon_lat' ELSE 'lat_lon' END AS coord_order FROM pairs WHERE x IS NOT NULL AND y IS NOT NULL",
)
def _(spark, d):
    df = fx.specimens(spark, d).withColumn("pair", coords.coordinate_pair(F.col("coord"), validate=False))
    return qc.coordinate_order(df, "pair")


@query(
    "p04_coord_infer",
    f"""WITH {SPEC}, {PAIRS}, swapped AS (SELECT processid, y AS a, x AS b FROM pairs WHERE x IS NOT NULL AND y IS NOT NULL),
    o AS (SELECT count(*) FILTER (abs(a) > 90) > 0 AND count(*) FILTER (abs(b) > 90) = 0 AS s FROM swapped),
    t AS (SELECT processid, CASE WHEN s THEN b ELSE a END AS la, CASE WHEN s THEN a ELSE b END AS lo FROM swapped, o)
    SELECT spec.processid, CASE WHEN la BETWEEN -90 AND 90 AND lo BETWEEN -180 AND 180 THEN la END AS latitude,
           CASE WHEN la BETWEEN -90 AND 90 AND lo BETWEEN -180 AND 180 THEN lo END AS longitude FROM spec LEFT JOIN t USING (processid)""",
)
def _(spark, d):
    pair = coords.coordinate_pair(F.col("coord"), validate=False)
    turned = F.when(pair.isNotNull(), F.concat_ws(" ", pair["lon"].cast("string"), pair["lat"].cast("string")))
    return qc.with_coordinates(fx.specimens(spark, d).withColumn("coord", turned), infer_order=True).select("processid", "latitude", "longitude")


@query(
    "p05_embedded_pair",
    f"""WITH {SPEC} SELECT processid, CASE WHEN m THEN try_cast(regexp_extract(t, p, 1) AS double) END AS lat, CASE WHEN m THEN try_cast(regexp_extract(t, p, 2) AS double) END AS lon
    FROM (SELECT processid, concat('at ', coord, ' found') AS t, coord IS NOT NULL AND regexp_matches(concat('at ', coord, ' found'), '(-?\\d+(?:\\.\\d+)?)\\s*,\\s*(-?\\d+(?:\\.\\d+)?)') AS m, '(-?\\d+(?:\\.\\d+)?)\\s*,\\s*(-?\\d+(?:\\.\\d+)?)' AS p FROM spec)""".replace("regexp_extract(t, p,", "regexp_extract(t, '(-?\\d+(?:\\.\\d+)?)\\s*,\\s*(-?\\d+(?:\\.\\d+)?)',"),
)
def _(spark, d):
    pair = coords.embedded_pair(F.concat(F.lit("at "), "coord", F.lit(" found")))
    return fx.specimens(spark, d).select("processid", pair["lat"].alias("lat"), pair["lon"].alias("lon"))


@query(
    "p06_coord_filter",
    f"""WITH {LOCATED} SELECT processid, latitude, longitude FROM located WHERE latitude IS NOT NULL AND longitude IS NOT NULL
    AND NOT coalesce(contains(lower(coord_source), 'centroid'), false) AND NOT (latitude = 0 AND longitude = 0)""",
)
def _(spark, d):
    return qc.filter_coordinates(located(spark, d)).select("processid", "latitude", "longitude")


_VALID = """CASE WHEN length(s) < 100 THEN 'too_short' WHEN NOT regexp_matches(s, '^[ACGTN-]*$') THEN 'invalid_characters'
  WHEN (length(s) - length(replace(s, 'N', ''))) * 2 > length(s) THEN 'too_many_n' WHEN (length(s) - length(replace(s, '-', ''))) * 5 > length(s) * 4 THEN 'too_many_gaps' END"""
_DIRTY = "CASE ord % 6 WHEN 0 THEN nuc || 'X' WHEN 1 THEN nuc || repeat('n', 140) WHEN 2 THEN nuc || repeat('-', 900) ELSE nuc END"




@query("p07_seq_validate", f"WITH {SPEC} SELECT processid, {_VALID} AS reason FROM (SELECT processid, upper(trim(coalesce({_DIRTY}, ''))) AS s FROM spec)")
def _(spark, d):
    return fx.specimens(spark, d).select("processid", sequence.invalid_reason(F.expr(_DIRTY)).alias("reason"))


@query(
    "p08_sanitize",
    f"""WITH {SPEC} SELECT processid, CASE WHEN regexp_matches(s, '^[ACGTURYKMSWBDHVN-]*$') AND length(s) >= 100 AND (length(s) - length(replace(s, '-', ''))) * 5 <= length(s) * 4 THEN s END AS seq
    FROM (SELECT processid, replace(upper(regexp_replace(concat(' ', lower(substr(z, 1, 9)), 'uu ', substr(z, 10)), '\\s', '', 'g')), 'U', 'T') AS s FROM (SELECT processid, {_DIRTY} AS z FROM spec))""",
)
def _(spark, d):
    z = F.expr(_DIRTY)
    mixed = F.concat(F.lit(" "), F.lower(F.substring(z, 1, 9)), F.lit("uu "), F.substring(z, 10, 100000))
    df = fx.specimens(spark, d).select("processid", F.coalesce(mixed, F.lit(" uu ")).alias("m"))
    return df.select("processid", sequence.sanitised(F.col("m")).alias("seq"))


@query("p09_processid", f"WITH {SPEC} SELECT processid, nullif(regexp_extract(concat(replace(species, ' ', '_'), '_', processid, '.COI-5P'), '_([^.\\s_]+)(?:[.\\s]|$)', 1), '') AS found FROM spec")
def _(spark, d):
    header = sequence.header_of(F.translate("species", " ", "_"), F.col("processid"))
    return fx.specimens(spark, d).select("processid", sequence.processid_of(header).alias("found"))


@query("p12_ungapped_filter", f"WITH {SPEC} SELECT processid, length(replace(replace(aln, '-', ''), 'N', '')) AS n FROM spec WHERE length(replace(replace(aln, '-', ''), 'N', '')) >= 128")
def _(spark, d):
    return qc.filter_ungapped(fx.specimens(spark, d), 128).select("processid", sequence.ungapped_length(F.col("aln")).alias("n"))


@query(
    "p13_consensus_len_filter",
    f"WITH {SPEC}, m AS (SELECT median(length(nuc)) AS med, count(*) AS n FROM spec WHERE nuc IS NOT NULL) SELECT processid, length(nuc) AS n_bases FROM spec, m WHERE nuc IS NOT NULL AND (n <= 1 OR length(nuc) >= med * 0.75e0)",
)
def _(spark, d):
    df = fx.specimens(spark, d).where("nuc IS NOT NULL").select("processid", "nuc")
    return qc.filter_relative_length(df, 0.75, "nuc").select("processid", F.length("nuc").alias("n_bases"))


@query("p14_species_normalise", f"WITH {SPEC} SELECT processid, concat(genus, ' ', country_ocean) AS species, genus FROM spec")
def _(spark, d):
    messy = F.concat(F.lit(" "), "genus", F.lit("   "), "country_ocean", F.lit(" "))
    return fx.specimens(spark, d).select("processid", sequence.normal_species(messy).alias("species"), sequence.genus_of(messy).alias("genus"))


@query("p15_levenshtein_rows", "SELECT p_partkey, levenshtein(lower(p_name), lower(p_type))::BIGINT AS dist FROM part")
def _(spark, d):
    """The distance of one pair in every row of the table."""
    p = spark.read.parquet(f"{d}/part.parquet")
    return p.select("p_partkey", F.levenshtein(F.lower("p_name"), F.lower("p_type")).cast("bigint").alias("dist"))


@query("p16_classic_identity", f"WITH {SPEC}, {CONS} SELECT processid, 1e0 - levenshtein(nuc, consensus_seq)::DOUBLE / greatest(length(nuc), length(consensus_seq)) AS ident FROM spec JOIN cons ON cons.ord = fam WHERE nuc IS NOT NULL")
def _(spark, d):
    c = fx.consensus(spark, d).select(F.col("ord").alias("fam"), "consensus_seq")
    s = fx.specimens(spark, d).where("nuc IS NOT NULL").join(c, "fam")
    return s.select("processid", sequence.classic_identity(F.levenshtein("nuc", "consensus_seq"), F.length("nuc"), F.length("consensus_seq")).alias("ident"))


_CIGAR = "concat(cast(ord % 90 + 1 AS string), '=', cast(ord % 7 AS string), 'X', cast(ord % 5 AS string), 'I', cast(ord % 3 AS string), 'D', cast(ord % 11 AS string), 'M')"


@query("p17_cigar_counts", f"WITH {SPEC} SELECT processid, (ord % 90 + 1 + ord % 11)::BIGINT AS matches, (ord % 7)::BIGINT AS mismatches, (ord % 5)::BIGINT AS insertions, (ord % 3)::BIGINT AS deletions FROM spec")
def _(spark, d):
    c = sequence.cigar_counts(F.expr(_CIGAR))
    return fx.specimens(spark, d).select("processid", *[c[k].cast("bigint").alias(k) for k in ("matches", "mismatches", "insertions", "deletions")])


@query(
    "p18_path_identity",
    f"""WITH {SPEC}, {CONS} SELECT processid, levenshtein(aln, consensus_seq)::BIGINT AS edit_distance, 128 - levenshtein(aln, consensus_seq)::BIGINT AS matches,
    levenshtein(aln, consensus_seq)::BIGINT AS mismatches, 0::BIGINT AS insertions, 0::BIGINT AS deletions FROM spec JOIN cons ON cons.ord = fam""",
)
def _(spark, d):
    c = fx.consensus(spark, d).select(F.col("ord").alias("fam"), "consensus_seq")
    one = fx.specimens(spark, d).join(c, "fam").withColumn("p", assign.path_identity("aln", "consensus_seq"))
    n = lambda k: F.col(f"p.{k}").cast("bigint")
    return one.select("processid", (n("mismatches") + n("insertions") + n("deletions")).alias("edit_distance"), *[n(k).alias(k) for k in ("matches", "mismatches", "insertions", "deletions")])


#: Cell by cell over the table of a pair, the last row held: cost and the operations of the path that
#: takes the diagonal first, then the insertion, then the deletion.
_CELLS = """WITH RECURSIVE p AS (SELECT p_partkey, lower(p_name) AS q, lower(p_type) AS t FROM part),
  dp AS (SELECT p_partkey, q, t, length(q) AS n, length(t) AS m, 0 AS i, 0 AS j, [{'c': 0, 'e': 0, 'x': 0, 'a': 0, 'd': 0}] AS cells FROM p
    UNION ALL SELECT p_partkey, q, t, n, m, i, j, list_append(cells[greatest(len(cells) - m, 1):], CASE
      WHEN g IS NOT NULL AND g.c + w <= coalesce(u.c, 1000000) + 1 AND g.c + w <= coalesce(l.c, 1000000) + 1 THEN {'c': g.c + w, 'e': g.e + 1 - w, 'x': g.x + w, 'a': g.a, 'd': g.d}
      WHEN u IS NOT NULL AND u.c <= coalesce(l.c, 1000000) THEN {'c': u.c + 1, 'e': u.e, 'x': u.x, 'a': u.a + 1, 'd': u.d}
      ELSE {'c': l.c + 1, 'e': l.e, 'x': l.x, 'a': l.a, 'd': l.d + 1} END)
    FROM (SELECT *, CASE WHEN j > 0 THEN cells[len(cells)] END AS l, CASE WHEN i > 0 THEN cells[len(cells) - m] END AS u, CASE WHEN i > 0 AND j > 0 THEN cells[len(cells) - m - 1] END AS g,
        (substr(q, i::BIGINT, 1) <> substr(t, j::BIGINT, 1))::INT AS w
      FROM (SELECT p_partkey, q, t, n, m, CASE WHEN j = m THEN i + 1 ELSE i END AS i, CASE WHEN j = m THEN 0 ELSE j + 1 END AS j, cells FROM dp WHERE i < n OR j < m) s0) s1)
  SELECT p_partkey, f.e::BIGINT AS matches, f.x::BIGINT AS mismatches, f.a::BIGINT AS insertions, f.d::BIGINT AS deletions FROM (SELECT p_partkey, cells[len(cells)] AS f FROM dp WHERE i = n AND j = m)"""


@query("p18_paths_of_parts", _CELLS)
def _(spark, d):
    """Paths between texts of different lengths, in every row of the table."""
    p = spark.read.parquet(f"{d}/part.parquet").select("p_partkey", F.lower("p_name").alias("q"), F.lower("p_type").alias("t")).withColumn("p", assign.path_identity("q", "t"))
    return p.select("p_partkey", *[F.col(f"p.{k}").cast("bigint").alias(k) for k in ("matches", "mismatches", "insertions", "deletions")])


@query(
    "p19_aligned_identity",
    f"""WITH {SPEC}, {CONS}, e AS (SELECT processid, substr(aln, i, 1) AS x, substr(consensus_seq, i, 1) AS y FROM spec JOIN cons ON cons.ord = fam, unnest(range(1, 129)) AS r(i)),
    g AS (SELECT processid, sum((x = y)::INT) AS same, count(*) AS valid FROM e WHERE x IN ('A','C','G','T') AND y IN ('A','C','G','T') GROUP BY 1)
    SELECT processid, CASE WHEN valid > 0 THEN same::DOUBLE / valid ELSE 0e0 END AS ident FROM spec LEFT JOIN g USING (processid)""",
)
def _(spark, d):
    c = fx.consensus(spark, d).select(F.col("ord").alias("fam"), "consensus_seq")
    return fx.specimens(spark, d).join(c, "fam").select("processid", sequence.aligned_identity(F.col("aln"), F.col("consensus_seq")).alias("ident"))


_cnt = lambda c: f"(length(s) - length(replace(s, '{c}', '')))"


@query(
    "p20_seq_stats",
    f"""WITH {SPEC} SELECT processid, length(s)::BIGINT AS length, ({_cnt('G')} + {_cnt('C')})::DOUBLE / ({_cnt('A')} + {_cnt('C')} + {_cnt('G')} + {_cnt('T')}) * 100 AS gc_content,
    {_cnt('A')}::BIGINT AS n_a, {_cnt('C')}::BIGINT AS n_c, {_cnt('G')}::BIGINT AS n_g, {_cnt('T')}::BIGINT AS n_t, {_cnt('N')}::BIGINT AS n_count,
    {_cnt('N')}::DOUBLE / length(s) * 100 AS n_percent, 0::BIGINT AS gap_count FROM (SELECT processid, aln AS s FROM spec)""",
)
def _(spark, d):
    s = fx.specimens(spark, d).select("processid", sequence.sequence_stats(F.col("aln")).alias("s")).select("processid", "s.*")
    return s.select("processid", *[F.col(c).cast("bigint").alias(c) if k == "int" else F.col(c) for c, k in s.dtypes if c != "processid"])


@query("p21_labels", f"WITH {CONS} SELECT consensus_group, replace(consensus_group, 'consensus_', '') AS short, trim(concat('sp ', replace(consensus_group, 'consensus_', ''))) AS label FROM cons")
def _(spark, d):
    g = F.col("consensus_group")
    return fx.consensus(spark, d).select("consensus_group", sequence.short_label(g).alias("short"), sequence.species_label(F.lit("sp"), g).alias("label"))


@query("p22_base_name", f"WITH {CONS} SELECT concat(consensus_group, '_n', n_reference) AS name, consensus_group AS base FROM cons")
def _(spark, d):
    name = F.concat("consensus_group", F.lit("_n"), F.col("n_reference").cast("string"))
    return fx.consensus(spark, d).select(name.alias("name"), sequence.base_group(name).alias("base"))


@query("a25_skip_reasons", f"WITH {SPEC} SELECT reason, count(*) AS n FROM (SELECT CASE WHEN coalesce(nuc, '') = '' THEN 'empty' ELSE {_VALID} END AS reason FROM (SELECT nuc, upper(trim(coalesce(nuc, ''))) AS s FROM spec)) WHERE reason IS NOT NULL GROUP BY reason")
def _(spark, d):
    return qc.skip_reasons(fx.specimens(spark, d), 100)


@query(
    "a01_data_quality",
    f"""WITH {SPEC} SELECT count(*) AS n_records, count(DISTINCT processid) AS n_processids, count(nuc) AS n_with_sequence, count(*) - count(nuc) AS n_without_sequence,
    count(coord) AS n_with_coordinates, count(*) - count(coord) AS n_without_coordinates, count(*) FILTER (lower(coord_source) LIKE '%centroid%') AS n_centroids FROM spec""",
)
def _(spark, d):
    return qc.data_quality(fx.specimens(spark, d))


@query(
    "a02_coord_quality",
    f"""WITH {LOCATED} SELECT count(*) AS total_samples, count(*) FILTER (latitude IS NULL OR longitude IS NULL) AS missing_coords, count(*) FILTER (latitude = 0 AND longitude = 0) AS zero_coords,
    count(*) FILTER (lower(coord_source) LIKE '%centroid%') AS centroid_coords, avg(CASE WHEN latitude IS NOT NULL THEN length(coalesce(string_split(string_split(translate(coord, '[] ', ''), ',')[1], '.')[2], '')) END) AS mean_precision FROM located""",
)
def _(spark, d):
    return qc.coordinate_quality(located(spark, d))


# --- assignment --------------------------------------------------------------------


def _diag_sql(metric: str, min_identity: str = "0.9e0", margin: str = "0.01e0") -> str:
    ident = "target_identity" if metric == "target_based" else "classic_identity"
    return f"""{SPEC}, {CONS}, scored AS (
      SELECT processid, consensus_group, cons.ord AS c_ord, levenshtein(nuc, consensus_seq) AS dist, length(nuc) AS q, length(consensus_seq) AS t FROM spec, cons WHERE nuc IS NOT NULL),
    ident AS (SELECT *, (greatest(q, t) - dist)::BIGINT AS matches, (greatest(q, t) - dist)::DOUBLE / t AS target_identity, 1e0 - dist::DOUBLE / greatest(q, t) AS classic_identity FROM scored),
    ranked AS (SELECT *, {ident} AS identity, row_number() OVER (PARTITION BY processid ORDER BY {ident} DESC, c_ord) AS place FROM ident),
    b1 AS (SELECT * FROM ranked WHERE place = 1), b2 AS (SELECT processid, consensus_group AS g2, identity AS i2 FROM ranked WHERE place = 2),
    flagged AS (SELECT spec.processid, spec.nuc, b1.consensus_group AS g, b1.identity AS i, b1.target_identity AS ti, b1.classic_identity AS ci, b1.matches AS m, b1.dist AS d, abs(b1.q - b1.t) AS ld, g2, i2,
      coalesce(b1.identity >= {min_identity}, false) AS ok FROM spec LEFT JOIN b1 USING (processid) LEFT JOIN b2 USING (processid)),
    marked AS (SELECT *, ok AND i2 > 0 AND i >= 0.95e0 AND i - i2 < {margin} AS tie, ok AND i < {min_identity} + 0.03e0 AS low FROM flagged),
    diag AS (SELECT processid, CASE WHEN ok THEN g END AS consensus_group, coalesce(i, 0e0) AS identity, coalesce(ti, 0e0) AS target_identity, coalesce(ci, 0e0) AS classic_identity,
      coalesce(m, 0)::BIGINT AS matches, coalesce(d, 0)::BIGINT AS edit_distance, coalesce(ld, 0)::BIGINT AS length_discrepancy, g2 AS runner_up_group, coalesce(i2, 0e0) AS runner_up_identity,
      coalesce(tie, false) AS is_tie, coalesce(low, false) AS is_low_confidence,
      CASE WHEN nuc IS NULL THEN 'no_sequence' WHEN NOT ok THEN 'below_threshold' WHEN tie THEN 'tie' WHEN low THEN 'low_confidence' ELSE 'assigned' END AS status FROM marked)"""


DIAG = _diag_sql("target_based")
_DIAG_COLS = "processid, consensus_group, identity, target_identity, classic_identity, matches, edit_distance, length_discrepancy, runner_up_group, runner_up_identity, is_tie, is_low_confidence, status"


def diagnostics(spark: SparkSession, d: str, method: str = "target_based") -> DataFrame:
    return assign.assign(fx.specimens(spark, d), fx.consensus(spark, d), 0.9, method, tie_margin=0.01)


def _slim(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c.strip()).cast("bigint").alias(c.strip()) if c.strip() in ("matches", "edit_distance", "length_discrepancy") else F.col(c.strip()) for c in _DIAG_COLS.split(",")])


@query("k4_assign_target", f"WITH {DIAG} SELECT {_DIAG_COLS} FROM diag")
def _(spark, d):
    return _slim(diagnostics(spark, d))


@query("k4_assign_classic", f"WITH {_diag_sql('classic')} SELECT {_DIAG_COLS} FROM diag")
def _(spark, d):
    return _slim(diagnostics(spark, d, "classic"))


@query("k4_assign_legacy", f"WITH {_diag_sql('classic')} SELECT processid, consensus_group, identity AS identity_score, runner_up_group, runner_up_identity AS runner_up_score FROM diag")
def _(spark, d):
    return assign.assign_legacy(fx.specimens(spark, d), fx.consensus(spark, d))


@query("k4_assign_path")
def _(spark, d):
    return assign.assign(fx.specimens(spark, d), fx.consensus(spark, d), 0.9, tie_margin=0.01, path=True)


@query(
    "j01_meta_fasta",
    f"WITH {SPEC}, fa AS (SELECT processid, nuc AS seq, ord FROM spec WHERE nuc IS NOT NULL UNION ALL SELECT processid, 'ACGT', ord + 1000000 FROM spec WHERE ord % 20 = 0), f AS (SELECT processid, arg_min(seq, ord) AS nuc FROM fa GROUP BY 1) SELECT spec.processid, f.nuc FROM spec LEFT JOIN f USING (processid)",
)
def _(spark, d):
    s = fx.specimens(spark, d)
    header = sequence.header_of(F.lit("Genus"), F.col("processid"))
    fasta = s.where("nuc IS NOT NULL").select(header.alias("header"), F.col("nuc").alias("seq"), "ord").unionByName(s.where("ord % 20 = 0").select(header.alias("header"), F.lit("ACGT").alias("seq"), (F.col("ord") + 1000000).alias("ord")))
    return assign.with_metadata(s, fasta).select("processid", "nuc")


@query(
    "a07_rename_counts",
    f"""WITH {DIAG}, n AS (SELECT consensus_group AS g, concat(consensus_group, '_n', count(*)) AS new FROM diag WHERE consensus_group IS NOT NULL GROUP BY 1)
    SELECT processid, coalesce(a.new, consensus_group) AS consensus_group, coalesce(b.new, runner_up_group) AS runner_up_group FROM diag LEFT JOIN n a ON a.g = consensus_group LEFT JOIN n b ON b.g = runner_up_group""",
)
def _(spark, d):
    return assign.renamed_counts(diagnostics(spark, d)).select("processid", "consensus_group", "runner_up_group")


@query(
    "a08_stats",
    f"""WITH {DIAG} SELECT count(*) AS total, count(consensus_group) AS assigned, count(*) - count(consensus_group) AS unassigned, count(*) FILTER (status = 'no_sequence') AS no_sequence,
    count(*) FILTER (status = 'below_threshold') AS below_threshold, count(*) FILTER (is_tie) AS ties, count(*) FILTER (is_low_confidence) AS low_confidence FROM diag""",
)
def _(spark, d):
    return assign.summary_stats(diagnostics(spark, d))


@query("a26_ambiguity", f"WITH {DIAG} SELECT count(*) FILTER (identity - runner_up_identity < 0.01e0) AS n_ambiguous FROM diag WHERE consensus_group IS NOT NULL AND runner_up_group IS NOT NULL")
def _(spark, d):
    return assign.ambiguity(diagnostics(spark, d))


# --- distances, clusters, consensus -------------------------------------------------

def _all_nodes(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Distinct aligned sequences of all specimens (the first stands for all), their pairs, and the members."""
    s = fx.specimens(spark, d).select("processid", "ord", "aln", "fam")
    node = materialize(s.groupBy("aln").agg(F.min("ord").alias("ord")), "nodes")
    pairs = distance.pairwise(node.select(F.col("ord").cast("string").alias("seq_id"), "ord", "aln"))
    return node, materialize(pairs.select("i", "j", "dist"), "distances"), s


ALL_PAIRS = f"""{SPEC}, node AS (SELECT aln, min(ord) AS ord FROM spec GROUP BY aln),
 chars AS (SELECT ord, p, substr(aln, p, 1) AS c FROM node, unnest(range(1, 129)) AS r(p) WHERE substr(aln, p, 1) IN ('A','C','G','T')),
 dist AS (SELECT a.ord AS i, b.ord AS j, 1e0 - sum((a.c = b.c)::INT)::DOUBLE / count(*) AS dist FROM chars a JOIN chars b USING (p) WHERE a.ord < b.ord GROUP BY ALL)"""
_NUMBERED = "SELECT spec.processid, dense_rank() OVER (ORDER BY head)::BIGINT AS cluster_id FROM spec JOIN node USING (aln) JOIN heads ON heads.ord = node.ord"


def _clustered(spark, d, method, threshold, **how):
    s = fx.specimens(spark, d).select("processid", "ord", "aln")
    node = materialize(s.groupBy("aln").agg(F.min("ord").alias("ord")), "nodes")
    labels = cluster.cluster_alignment(node, threshold, method, **how).withColumnRenamed("ord", "node")
    return s.join(node.withColumnRenamed("ord", "node"), "aln").join(labels, "node").select("processid", F.col("cluster_id").cast("bigint").alias("cluster_id"))


@query(
    "k2_single_linkage",
    f"""WITH RECURSIVE {ALL_PAIRS}, e AS (SELECT i, j FROM dist WHERE dist <= 0.02e0 UNION ALL SELECT j, i FROM dist WHERE dist <= 0.02e0),
    reach(ord, other) AS (SELECT ord, ord FROM node UNION SELECT reach.ord, e.j FROM reach JOIN e ON e.i = reach.other),
    heads AS (SELECT ord, min(other) AS head FROM reach GROUP BY ord) {_NUMBERED}""",
)
def _(spark, d):
    return _clustered(spark, d, "single", 0.02)


@query("k2_average_linkage")
def _(spark, d):
    return _clustered(spark, d, "average", 0.03)


def average_by_rounds(spark: SparkSession, d: str) -> DataFrame:
    """The clusters of ``k2_average_linkage`` with every component dealt over many tasks."""
    return _clustered(spark, d, "average", 0.03, group_rows=1)


@query("k2_complete_linkage")
def _(spark, d):
    return _clustered(spark, d, "complete", 0.03)


@query("k2_weighted_linkage")
def _(spark, d):
    return _clustered(spark, d, "weighted", 0.03)


@query("k2_ward_linkage")
def _(spark, d):
    return _clustered(spark, d, "ward", 0.03)


@query(
    "k3_consensus",
    f"""WITH {SPEC}, c AS (SELECT fam, p, substr(upper(aln), p, 1) AS b, ord FROM spec, unnest(range(1, 129)) AS r(p)),
    v AS (SELECT fam, p, b, count(*) AS n, min(ord) AS f FROM c WHERE b IN ('A','C','G','T') GROUP BY ALL),
    t AS (SELECT *, sum(n) OVER (PARTITION BY fam, p) AS valid, row_number() OVER (PARTITION BY fam, p ORDER BY n DESC, f) AS r FROM v),
    g AS (SELECT fam, string_agg(b, '' ORDER BY p) AS s FROM t WHERE r = 1 AND n::DOUBLE / valid >= 0.7e0 GROUP BY fam)
    SELECT (fam + 1)::BIGINT AS cluster_id, concat('consensus_c', fam + 1) AS consensus_group, coalesce(s, '') AS consensus_seq, n_reference
    FROM (SELECT fam, count(*) AS n_reference FROM spec GROUP BY fam) LEFT JOIN g USING (fam)""",
)
def _(spark, d):
    out = consensus.consensus(fx.specimens(spark, d).withColumn("cluster_id", F.col("fam") + 1))
    return out.withColumns({"cluster_id": F.col("cluster_id").cast("bigint"), "n_reference": F.col("n_reference").cast("bigint")})


@query(
    "k1_all_pairs",
    f"""WITH {ALL_PAIRS}, size AS (SELECT node.ord, count(*) AS n FROM node JOIN spec USING (aln) GROUP BY node.ord)
    SELECT i, j, a.n AS n_i, b.n AS n_j, dist FROM dist JOIN size a ON a.ord = i JOIN size b ON b.ord = j""",
)
def _(spark, d):
    """Every pair of distinct sequences of all specimens, and how many specimens each stands for."""
    _, pairs, s = _all_nodes(spark, d)
    size = s.groupBy("aln").agg(F.min("ord").alias("ord"), F.count("*").alias("n"))
    side = lambda k: size.select(F.col("ord").alias(k), F.col("n").alias(f"n_{k}"))
    return pairs.join(side("i"), "i").join(side("j"), "j").select("i", "j", "n_i", "n_j", "dist")


@query(
    "a21_intra_cluster",
    f"""WITH {ALL_PAIRS}, lab AS (SELECT node.ord, any_value(fam) AS c FROM node JOIN spec USING (aln) GROUP BY node.ord), inside AS (SELECT a.c, dist FROM dist JOIN lab a ON a.ord = i JOIN lab b ON b.ord = j WHERE a.c = b.c)
    SELECT l.c AS cluster_id, l.n AS cluster_size, mn AS intra_min, mean AS intra_mean, med AS intra_median, mx AS intra_max, p95 AS intra_p95 FROM (SELECT c, count(*) AS n FROM lab GROUP BY c) l
    LEFT JOIN (SELECT c, min(dist) AS mn, avg(dist) AS mean, median(dist) AS med, max(dist) AS mx, quantile_cont(dist, 0.95) AS p95 FROM inside GROUP BY c) s ON s.c = l.c""",
)
def _(spark, d):
    node, pairs, s = _all_nodes(spark, d)
    labels = node.join(s.groupBy("aln").agg(F.min("fam").alias("cluster_id")), "aln").select("ord", "cluster_id")
    return aggregates.intra_cluster(labels, pairs)


# --- taxonomy -----------------------------------------------------------------------


def grouped(spark: SparkSession, d: str) -> DataFrame:
    return fx.specimens(spark, d).join(diagnostics(spark, d).select("processid", "consensus_group"), "processid")


GROUPED = f"{DIAG}, grp AS (SELECT spec.*, diag.consensus_group FROM spec JOIN diag USING (processid))"


def _vote_sql(source: str, threshold: str) -> str:
    return f"""cnt AS (SELECT consensus_group, species, count(*) AS n FROM {source} WHERE consensus_group IS NOT NULL GROUP BY ALL),
    sized AS (SELECT *, sum(n) OVER (PARTITION BY consensus_group) AS total, max(n) OVER (PARTITION BY consensus_group) AS best FROM cnt),
    tied AS (SELECT *, count(*) FILTER (n = best) OVER (PARTITION BY consensus_group) AS ties, row_number() OVER (PARTITION BY consensus_group ORDER BY n DESC, species) AS r FROM sized),
    gen AS (SELECT consensus_group, genus, row_number() OVER (PARTITION BY consensus_group ORDER BY count(*) DESC, min(ord), genus) AS r FROM {source} WHERE consensus_group IS NOT NULL GROUP BY consensus_group, genus),
    tax AS (SELECT consensus_group, CASE WHEN win THEN species ELSE genus END AS assigned_sp, CASE WHEN win THEN 'species' WHEN genus <> '' THEN 'genus' ELSE 'unassigned' END AS assignment_level,
      CASE WHEN win THEN printf('majority %.2f', frac) WHEN genus <> '' THEN 'tie or not majority; fell back to genus' ELSE 'no genus available' END AS assignment_notes, frac AS majority_fraction
      FROM (SELECT t.consensus_group, species, coalesce(g.genus, '') AS genus, n::DOUBLE / total AS frac, ties = 1 AND n::DOUBLE / total > {threshold} AND species <> '' AS win FROM tied t LEFT JOIN gen g ON g.consensus_group = t.consensus_group AND g.r = 1 WHERE t.r = 1))"""


@query("a03_species_counts", f"WITH {GROUPED}, c AS (SELECT consensus_group, species AS reported_species, count(*) AS n FROM grp GROUP BY ALL) SELECT *, CASE WHEN consensus_group IS NOT NULL THEN sum(n) OVER (PARTITION BY consensus_group) END::BIGINT AS n_in_group, CASE WHEN consensus_group IS NOT NULL THEN n::DOUBLE / sum(n) OVER (PARTITION BY consensus_group) END AS frac FROM c")
def _(spark, d):
    return taxonomy.species_counts(grouped(spark, d))


@query("a04_majority_fraction", f"WITH {GROUPED}, c AS (SELECT consensus_group, count(*) AS n FROM grp WHERE consensus_group IS NOT NULL GROUP BY consensus_group, species) SELECT consensus_group, max(n)::DOUBLE / sum(n) AS majority_fraction FROM c GROUP BY 1")
def _(spark, d):
    c = taxonomy.species_counts(grouped(spark, d)).where("consensus_group IS NOT NULL")
    return c.groupBy("consensus_group").agg(F.max("frac").alias("majority_fraction"))


@query("a05_taxonomy_vote", f"WITH {GROUPED}, {_vote_sql('grp', '0.1e0')} SELECT * FROM tax")
def _(spark, d):
    return taxonomy.vote(grouped(spark, d), 0.1)


_ORDERS = "ord AS (SELECT o_custkey % 50 AS consensus_group, o_orderpriority AS species, o_orderstatus AS genus, o_orderkey AS ord FROM orders)"


@query("a05_vote_orders", f"WITH {_ORDERS}, {_vote_sql('ord', '0.2e0')} SELECT * FROM tax")
def _(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet")
    rows = o.select((F.col("o_custkey") % 50).alias("consensus_group"), F.col("o_orderpriority").alias("species"), F.col("o_orderstatus").alias("genus"), F.col("o_orderkey").alias("ord"))
    return taxonomy.vote(rows, 0.2)


_EVID = """SELECT ord, CASE ord % 3 WHEN 0 THEN 'species' WHEN 1 THEN 'genus' ELSE 'none' END AS cl, CASE WHEN ord % 5 = 0 THEN NULL ELSE species END AS cs, 97 + (ord % 40) / 10e0 AS ci, 85 + (ord % 15) * 1e0 AS cq,
 CASE ord % 4 WHEN 0 THEN 'species' WHEN 1 THEN 'genus' ELSE 'unassigned' END AS ml, CASE WHEN ord % 7 = 0 THEN '' ELSE genus END AS ms, (ord % 10) / 10e0 AS mf FROM spec"""


@query(
    "a06_final_taxon",
    f"""WITH {SPEC}, ev AS ({_EVID}), p AS (SELECT *, CASE WHEN cl = 'species' AND ci >= 98.5e0 AND cq >= 90 AND coalesce(trim(cs), '') <> '' THEN 'cluster_seq'
      WHEN ml = 'species' AND mf >= 0.7e0 AND coalesce(trim(ms), '') <> '' THEN 'majority_species' WHEN cl = 'genus' AND coalesce(trim(cs), '') <> '' THEN 'cluster_genus'
      WHEN ml = 'genus' AND coalesce(trim(ms), '') <> '' THEN 'majority_genus' ELSE 'none' END AS provenance FROM ev)
    SELECT ord, provenance, CASE WHEN provenance IN ('cluster_seq', 'cluster_genus') THEN cs WHEN provenance IN ('majority_species', 'majority_genus') THEN ms ELSE '' END AS taxon,
      CASE provenance WHEN 'cluster_seq' THEN 'species' WHEN 'majority_species' THEN 'species' WHEN 'none' THEN 'unassigned' ELSE 'genus' END AS level FROM p""",
)
def _(spark, d):
    ev = spark.sql(_EVID.replace("FROM spec", "FROM {spec}"), spec=fx.specimens(spark, d))
    c = F.col
    return ev.select("ord", taxonomy.final_taxon(c("cs"), c("cl"), c("ci"), c("cq"), c("ms"), c("ml"), c("mf")).alias("t")).select("ord", "t.*")


# --- annotated table and reports -----------------------------------------------------

BASINS = f"boxes AS ({fx.BOXES_SQL})"
ANNOT = f"""{DIAG}, {PAIRS}, located AS (SELECT processid, ord, species, genus, nuc, CASE WHEN ok THEN x END AS lat, CASE WHEN ok THEN y END AS lon
   FROM (SELECT *, coalesce(x BETWEEN -90 AND 90 AND y BETWEEN -180 AND 180, false) AS ok FROM pairs)), {BASINS},
  hit AS (SELECT processid, arg_min(basin_name, poly_ord) AS basin FROM located JOIN boxes ON lon > xmin AND lon < xmax AND lat > ymin AND lat < ymax GROUP BY processid),
  grp AS (SELECT l.*, diag.consensus_group, coalesce(hit.basin, 'Unknown') AS ocean_basin FROM located l JOIN diag USING (processid) LEFT JOIN hit USING (processid)),
  {_vote_sql('grp', '0.1e0')},
  ann AS (SELECT g.*, t.assigned_sp, t.assignment_level, t.assignment_notes, t.majority_fraction,
    coalesce(CASE assignment_level WHEN 'species' THEN species <> assigned_sp WHEN 'genus' THEN genus <> assigned_sp END, false) AS taxonomy_conflict,
    CASE WHEN g.consensus_group IS NOT NULL THEN trim(concat(coalesce(assigned_sp, ''), ' ', replace(g.consensus_group, 'consensus_', ''))) END AS consensus_group_sp
    FROM grp g LEFT JOIN tax t ON t.consensus_group = g.consensus_group)"""


def basined(spark: SparkSession, d: str) -> DataFrame:
    s = located(spark, d).withColumnsRenamed({"latitude": "lat", "longitude": "lon"})
    return geo.assign_basins(s, fx.boxes(spark))


def annotated(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    diag = materialize(diagnostics(spark, d), "diagnostics")
    g = basined(spark, d).join(diag.select("processid", "consensus_group"), "processid")
    tax = taxonomy.labelled(taxonomy.vote(g, 0.1)).drop("consensus_group_short")
    ann = taxonomy.joined(g, materialize(tax, "taxonomy"))
    c = F.col
    return materialize(ann.withColumn("taxonomy_conflict", taxonomy.conflict(c("assignment_level"), c("species"), c("genus"), c("assigned_sp"))), "annotated"), diag


@query("j04_annotated", f"WITH {ANNOT} SELECT processid, consensus_group, assigned_sp, assignment_level, consensus_group_sp, lat, lon, ocean_basin FROM ann")
def _(spark, d):
    return annotated(spark, d)[0].select("processid", "consensus_group", "assigned_sp", "assignment_level", "consensus_group_sp", "lat", "lon", "ocean_basin")


@query("a12_conflict_flag", f"WITH {ANNOT} SELECT processid, taxonomy_conflict FROM ann")
def _(spark, d):
    return annotated(spark, d)[0].select("processid", "taxonomy_conflict")


_PCT = ", ".join(f"count(*) FILTER (status = '{s}') AS n_{s}, count(*) FILTER (status = '{s}')::DOUBLE / count(*) * 100 AS pct_{s}" for s in aggregates.STATUSES)


@query(
    "a09_assignment_summary",
    f"""WITH {ANNOT}, a AS (SELECT count(*) AS total_samples, count(*) FILTER (status <> 'no_sequence') AS samples_with_sequence, {_PCT}, avg(identity) FILTER (status = 'assigned') AS mean_identity_assigned,
    median(identity) FILTER (status = 'assigned') AS median_identity_assigned, min(identity) FILTER (status = 'assigned') AS min_identity_assigned, max(identity) FILTER (status = 'assigned') AS max_identity_assigned FROM diag),
    b AS (SELECT count(DISTINCT consensus_group) AS n_consensus_groups, count(DISTINCT nullif(assigned_sp, '')) AS n_species_identified, count(*) FILTER (taxonomy_conflict) AS n_taxonomy_conflicts,
    count(*) FILTER (taxonomy_conflict)::DOUBLE / count(nullif(assigned_sp, '')) * 100 AS pct_taxonomy_conflicts FROM ann) SELECT * FROM a, b""",
)
def _(spark, d):
    return aggregates.assignment_summary(*annotated(spark, d))


COMP = """(SELECT consensus_group, string_agg(concat(species, ': ', n, ' (', printf('%.1f', n::DOUBLE / total * 100), '%)'), ', ' ORDER BY n DESC, species) AS comp
  FROM (SELECT consensus_group, species, count(*) AS n, sum(count(*)) OVER (PARTITION BY consensus_group) AS total FROM {src} GROUP BY consensus_group, species) GROUP BY consensus_group)"""


@query(
    "a10_characterise",
    f"""WITH {ANNOT}, asg AS (SELECT ann.*, diag.identity FROM ann JOIN diag USING (processid) WHERE status = 'assigned' AND ann.consensus_group IS NOT NULL),
    s AS (SELECT consensus_group, any_value(assigned_sp) AS assigned_sp, any_value(assignment_notes) AS assignment_confidence, count(*) AS n_samples, avg(identity) AS mean_identity, min(identity) AS min_identity, max(identity) AS max_identity,
      string_agg(DISTINCT ocean_basin, ', ' ORDER BY ocean_basin) AS geographic_range, count(DISTINCT ocean_basin) AS n_ocean_basins FROM asg GROUP BY consensus_group)
    SELECT s.*, comp AS reported_species_composition FROM s JOIN {COMP.format(src='asg')} c USING (consensus_group)""",
)
def _(spark, d):
    out = aggregates.characterisation(*annotated(spark, d))
    return out.withColumn("n_ocean_basins", F.col("n_ocean_basins").cast("bigint"))


@query(
    "a11_conflict_report",
    f"""WITH {ANNOT} SELECT ann.processid, species AS reported_species, assigned_sp, ann.consensus_group, identity AS identity_to_assigned_group, n AS n_samples_in_assigned_group,
    comp AS species_composition_of_assigned_group, runner_up_group, runner_up_identity, identity - runner_up_identity AS delta_identity, status AS assignment_status,
    concat_ws('; ', concat('Genetic identity to assigned group: ', printf('%.3f', identity)), concat('Group contains ', n, ' samples'),
      CASE WHEN identity - runner_up_identity > 0.01e0 THEN concat('Identity ', printf('%.3f', identity - runner_up_identity), ' higher than runner-up') END,
      CASE status WHEN 'assigned' THEN 'High-confidence assignment' WHEN 'low_confidence' THEN 'Low-confidence assignment - verify manually' WHEN 'tie' THEN 'Tied assignment - verify manually' END) AS evidence_summary
    FROM ann JOIN diag USING (processid) JOIN (SELECT consensus_group, count(*) AS n FROM ann GROUP BY 1) z ON z.consensus_group = ann.consensus_group JOIN {COMP.format(src='ann')} c ON c.consensus_group = ann.consensus_group
    WHERE taxonomy_conflict AND nullif(assigned_sp, '') IS NOT NULL""",
)
def _(spark, d):
    return aggregates.conflict_report(*annotated(spark, d))


_n = "length(nuc)"
_ns = "(length(nuc) - length(replace(nuc, 'N', '')))"
_gc = "((length(nuc) - length(replace(nuc, 'G', ''))) + (length(nuc) - length(replace(nuc, 'C', ''))))::DOUBLE / length(nuc) * 100"
_M13 = {"total_sequences": "count(*)", "sequences_with_data": "count(nuc)", "sequences_missing": "count(*) - count(nuc)"}
_M13 |= {f"{k}_seq_length": f"{f}({_n})" for k, f in (("mean", "avg"), ("median", "median"), ("min", "min"), ("max", "max"), ("std", "stddev_samp"))}
for _k, _t in (("seq_below_500bp", f"{_n} < 500"), ("seq_below_600bp", f"{_n} < 600"), ("seq_above_650bp", f"{_n} > 650"), ("seq_with_Ns", f"{_ns} > 0"), ("seq_over_5pct_Ns", f"{_ns}::DOUBLE / {_n} * 100 > 5"), ("seq_over_1pct_Ns", f"{_ns}::DOUBLE / {_n} * 100 > 1")):
    _M13 |= {f"n_{_k}": f"count(*) FILTER ({_t})", f"pct_{_k}": f"count(*) FILTER ({_t})::DOUBLE / count(nuc) * 100"}
_M13 |= {"mean_n_count": f"avg({_ns})", "median_n_count": f"median({_ns})", "max_n_count": f"max({_ns})"}
_M13 |= {f"mean_pct_{b}": f"avg((length(nuc) - length(replace(nuc, '{b}', '')))::DOUBLE / length(nuc) * 100)" for b in "ATGC"}
_M13 |= {f"{k}_gc_content": f"{f}({_gc})" for k, f in (("mean", "avg"), ("median", "median"), ("min", "min"), ("max", "max"))}


@query("a13_seq_quality", f"WITH {SPEC}, w AS (SELECT " + ", ".join(f"({v})::DOUBLE AS {k}" for k, v in _M13.items()) + " FROM spec) " + " UNION ALL ".join(f"SELECT '{k}' AS metric, {k} AS value FROM w" for k in _M13))
def _(spark, d):
    return aggregates.sequence_quality(fx.specimens(spark, d))


@query("k5_basin_assign", f"WITH {ANNOT} SELECT processid, ocean_basin FROM ann")
def _(spark, d):
    return basined(spark, d).select("processid", "ocean_basin")


@query("k5_basin_polygons", f"WITH {ANNOT} SELECT processid, ocean_basin FROM ann")
def _(spark, d):
    s = located(spark, d).withColumnsRenamed({"latitude": "lat", "longitude": "lon"})
    return geo.assign_basins(s, fx.ringed(fx.boxes(spark))).select("processid", "ocean_basin")


@query("j12_marine_semi", f"WITH {ANNOT} SELECT processid FROM ann WHERE ocean_basin <> 'Unknown'")
def _(spark, d):
    s = located(spark, d).withColumnsRenamed({"latitude": "lat", "longitude": "lon"})
    return geo.marine(s, fx.boxes(spark)).select("processid")


@query("j12_marine_flag", f"WITH {ANNOT} SELECT processid, ocean_basin <> 'Unknown' AS is_marine FROM ann")
def _(spark, d):
    s = located(spark, d).withColumnsRenamed({"latitude": "lat", "longitude": "lon"})
    return geo.marine(s, fx.boxes(spark), remove=False).select("processid", "is_marine")


#: Even-odd over all rings of the jagged bands; a point on an edge is outside.
COASTS = f"""vert AS ({fx.VERTICES}), seg AS (SELECT poly_ord, ring, place, x AS ax, y AS ay, coalesce(lead(x) OVER w, first_value(x) OVER w) AS bx, coalesce(lead(y) OVER w, first_value(y) OVER w) AS by_
    FROM vert WINDOW w AS (PARTITION BY poly_ord, ring ORDER BY place)),
  spot AS (SELECT DISTINCT latitude AS py, longitude AS px FROM located WHERE latitude IS NOT NULL),
  crossed AS (SELECT px, py, poly_ord, count(*) FILTER ((ay > py) <> (by_ > py) AND px < (bx - ax) * (py - ay) / (by_ - ay) + ax) % 2 = 1 AND count(*) FILTER (
      (bx - ax) * (py - ay) - (by_ - ay) * (px - ax) = 0 AND px BETWEEN least(ax, bx) AND greatest(ax, bx) AND py BETWEEN least(ay, by_) AND greatest(ay, by_)) = 0 AS inside FROM spot, seg GROUP BY ALL),
  placed AS (SELECT px, py, min(poly_ord) AS poly_ord FROM crossed WHERE inside GROUP BY ALL)"""


@query(
    "k5_jagged_coasts",
    f"""WITH {LOCATED}, {COASTS} SELECT processid, coalesce(r_name, 'Unknown') AS ocean_basin
    FROM located LEFT JOIN placed ON px = longitude AND py = latitude LEFT JOIN region ON r_regionkey = poly_ord""",
)
def _(spark, d):
    """Basins with long coasts and holes, from the tables of customers, suppliers and regions."""
    s = located(spark, d).withColumnsRenamed({"latitude": "lat", "longitude": "lon"})
    return geo.assign_basins(s, fx.coasts(spark, d)).select("processid", "ocean_basin")


@query(
    "geo_snap_to_coast",
    f"""WITH {LOCATED}, {BASINS}, land AS (SELECT * FROM boxes WHERE poly_ord = 0),
    seg AS (SELECT unnest([{{'k': 1, 'ax': xmin, 'ay': ymin, 'bx': xmax, 'by': ymin}}, {{'k': 2, 'ax': xmax, 'ay': ymin, 'bx': xmax, 'by': ymax}}, {{'k': 3, 'ax': xmax, 'ay': ymax, 'bx': xmin, 'by': ymax}}, {{'k': 4, 'ax': xmin, 'ay': ymax, 'bx': xmin, 'by': ymin}}]) AS e FROM land),
    hit AS (SELECT DISTINCT latitude AS py, longitude AS px FROM located JOIN land ON longitude > xmin AND longitude < xmax AND latitude > ymin AND latitude < ymax),
    t AS (SELECT px, py, e.k AS k, e.ax AS ax, e.ay AS ay, e.bx AS bx, e.by AS by_, least(greatest(((px - e.ax) * (e.bx - e.ax) + (py - e.ay) * (e.by - e.ay)) / ((e.bx - e.ax) * (e.bx - e.ax) + (e.by - e.ay) * (e.by - e.ay)), 0e0), 1e0) AS t FROM hit, seg),
    near AS (SELECT px, py, k, ax + t * (bx - ax) AS x, ay + t * (by_ - ay) AS y FROM t),
    best AS (SELECT * FROM near QUALIFY row_number() OVER (PARTITION BY px, py ORDER BY (x - px) * (x - px) + (y - py) * (y - py), k) = 1)
    SELECT processid, coalesce(y, latitude) AS latitude, coalesce(x, longitude) AS longitude, CASE WHEN k IS NULL THEN 'precise' ELSE 'snapped_to_coast' END AS location_type
    FROM located LEFT JOIN best ON px = longitude AND py = latitude""",
)
def _(spark, d):
    land = fx.ringed(fx.boxes(spark).where("poly_ord = 0"))
    return geo.classify_coordinates(located(spark, d), land, "snap").select("processid", "latitude", "longitude", "location_type")


@query(
    "geo_snap_to_jagged_coast",
    f"""WITH {LOCATED}, {COASTS}, t AS (SELECT placed.px, placed.py, ring, place, ax, ay, bx, by_,
      least(greatest(((placed.px - ax) * (bx - ax) + (placed.py - ay) * (by_ - ay)) / ((bx - ax) * (bx - ax) + (by_ - ay) * (by_ - ay)), 0e0), 1e0) AS t
      FROM crossed c JOIN placed ON placed.px = c.px AND placed.py = c.py JOIN seg ON seg.poly_ord = c.poly_ord WHERE c.inside AND (ax <> bx OR ay <> by_)),
    near AS (SELECT px, py, ax + t * (bx - ax) - px AS dx, ay + t * (by_ - ay) - py AS dy FROM t)
    SELECT processid, round(sqrt(min(dx * dx + dy * dy)), 9) AS moved FROM located JOIN near ON px = longitude AND py = latitude GROUP BY processid""",
)
def _(spark, d):
    """How far points inside a jagged band move to its nearest coast, in degrees."""
    kept = located(spark, d).select("processid", "latitude", "longitude", F.col("latitude").alias("la"), F.col("longitude").alias("lo"))
    moved = geo.classify_coordinates(kept, fx.coasts(spark, d), "snap").where("location_type = 'snapped_to_coast'")
    dx, dy = F.col("longitude") - F.col("lo"), F.col("latitude") - F.col("la")
    return moved.select("processid", F.round(F.sqrt(dx * dx + dy * dy), 9).alias("moved"))


@query("a14_basin_counts", f"WITH {ANNOT} SELECT ocean_basin AS basin, count(*) AS n FROM ann GROUP BY 1")
def _(spark, d):
    return geo.basin_counts(basined(spark, d))


@query(
    "a15_basin_stats",
    f"""WITH {ANNOT} SELECT ocean_basin AS basin, count(*) AS n_samples, min(lat) AS lat_min, max(lat) AS lat_max, avg(lat) AS lat_mean, min(lon) AS lon_min, max(lon) AS lon_max, avg(lon) AS lon_mean FROM ann GROUP BY 1""",
)
def _(spark, d):
    return geo.basin_summary(basined(spark, d))


@query("a16_basin_assignment", f"WITH {ANNOT} SELECT ocean_basin, count(*) AS total, count(consensus_group) AS assigned, count(consensus_group)::DOUBLE / count(*) AS assigned_rate FROM ann GROUP BY 1")
def _(spark, d):
    return aggregates.basin_assignment(annotated(spark, d)[0])


@query(
    "a17_crosstab",
    f"""WITH {ANNOT}, n AS (SELECT coalesce(consensus_group, 'Unassigned') AS genotype, ocean_basin AS basin, count(*) AS n FROM ann GROUP BY ALL)
    SELECT *, sum(n) OVER (PARTITION BY genotype)::BIGINT AS row_total, sum(n) OVER (PARTITION BY basin)::BIGINT AS column_total FROM n""",
)
def _(spark, d):
    return aggregates.crosstab(annotated(spark, d)[0])


@query("a17_crosstab_customers", "SELECT n_name AS genotype, c_mktsegment AS basin, count(*) AS n, sum(count(*)) OVER (PARTITION BY n_name)::BIGINT AS row_total, sum(count(*)) OVER (PARTITION BY c_mktsegment)::BIGINT AS column_total FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name, c_mktsegment")
def _(spark, d):
    c, n = spark.read.parquet(f"{d}/customer.parquet"), spark.read.parquet(f"{d}/nation.parquet")
    return aggregates.crosstab(c.join(n, c["c_nationkey"] == n["n_nationkey"]), row="n_name", column="c_mktsegment")


@query("a18_basin_distribution", f"WITH {ANNOT} SELECT ocean_basin, count(*) AS n, count(*)::DOUBLE / sum(count(*)) OVER () * 100 AS pct FROM ann WHERE ocean_basin <> 'Unknown' GROUP BY 1")
def _(spark, d):
    return aggregates.basin_distribution(basined(spark, d))


@query("a19_missing_geography", f"WITH {ANNOT} SELECT count(*) AS total, count(*) FILTER (lat IS NULL OR lon IS NULL) AS missing FROM ann")
def _(spark, d):
    return aggregates.missing_geography(basined(spark, d))


@query(
    "a20_cluster_stats",
    f"""WITH {DIAG}, s AS (SELECT consensus_group AS g, {", ".join(f"count(*) FILTER (status = '{s}') AS n_{s}" for s in aggregates.STATUSES)}, count(*) AS n, min(identity) AS a, avg(identity) AS b, median(identity) AS c, max(identity) AS d FROM diag WHERE consensus_group IS NOT NULL GROUP BY 1)
    SELECT consensus_group, cluster_id, n_reference, coalesce(n_assigned, 0) AS n_assigned, greatest(n_reference - coalesce(n_assigned, 0), 0)::BIGINT AS n_cluster_members_fail, coalesce(n_tie, 0) AS n_tie, coalesce(n_low_confidence, 0) AS n_low_confidence,
    coalesce(n_below_threshold, 0) AS n_below_threshold, coalesce(n_no_sequence, 0) AS n_no_sequence, coalesce(n, 0) AS n_samples_considered, length(consensus_seq)::BIGINT AS consensus_length, a AS identity_min, b AS identity_mean, c AS identity_median, d AS identity_max
    FROM cons LEFT JOIN s ON s.g = consensus_group""",
)
def _(spark, d):
    out = aggregates.cluster_stats(fx.consensus(spark, d).drop("ord"), diagnostics(spark, d))
    return out.withColumn("consensus_length", F.col("consensus_length").cast("bigint"))


@query("a22_genotype_order", f"WITH {ANNOT} SELECT consensus_group AS genotype, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, min(ord))::BIGINT AS rank FROM ann WHERE consensus_group IS NOT NULL GROUP BY 1")
def _(spark, d):
    return plotdata.abundance(annotated(spark, d)[0]).withColumn("rank", F.col("rank").cast("bigint"))


@query(
    "a23_location_multiplicity",
    f"""WITH {ANNOT}, n AS (SELECT lat, lon, consensus_group AS genotype, count(*) AS n FROM ann WHERE lat IS NOT NULL AND lon IS NOT NULL AND consensus_group IS NOT NULL GROUP BY ALL), s AS (SELECT min(n) AS lo, max(n) AS hi FROM n)
    SELECT lat, lon, genotype, n, CASE WHEN hi > 1 AND hi > lo THEN 50e0 + (n - lo)::DOUBLE / (hi - lo) * 450e0 ELSE 50e0 END AS size FROM n, s""",
)
def _(spark, d):
    return plotdata.multiplicity(annotated(spark, d)[0])


_ABUND = f"{ANNOT}, n AS (SELECT ocean_basin AS basin, coalesce(consensus_group, 'Unassigned') AS genotype, count(*) AS n FROM ann WHERE ocean_basin <> 'Unknown' GROUP BY ALL), p AS (SELECT *, n::DOUBLE / sum(n) OVER (PARTITION BY basin) AS prop FROM n)"


@query("a24_basin_proportion", f"WITH {_ABUND} SELECT * FROM p")
def _(spark, d):
    return plotdata.basin_abundance(annotated(spark, d)[0])


_PLACE = "list_position([" + ", ".join(f"'{b}'" for b in geo.BASIN_ORDER) + "], basin)"


@query("v02_charted_basins", f"WITH {_ABUND} SELECT *, {_PLACE}::BIGINT AS basin_place FROM p WHERE {_PLACE} > 0")
def _(spark, d):
    return plotdata.charted(plotdata.basin_abundance(annotated(spark, d)[0])).withColumn("basin_place", F.col("basin_place").cast("bigint"))


@query("v05_faceted_abundance", f"WITH {ANNOT}, n AS (SELECT assigned_sp AS facet, ocean_basin AS basin, coalesce(consensus_group, 'Unassigned') AS genotype, count(*) AS n FROM ann WHERE ocean_basin <> 'Unknown' GROUP BY ALL) SELECT *, n::DOUBLE / sum(n) OVER (PARTITION BY facet, basin) AS prop FROM n")
def _(spark, d):
    return plotdata.basin_abundance(annotated(spark, d)[0], facet="assigned_sp")


@query("v04_map_extent", f"WITH {ANNOT} SELECT greatest(min(lon) - 20, -180)::DOUBLE AS lon_min, least(max(lon) + 20, 180)::DOUBLE AS lon_max, greatest(min(lat) - 20, -90)::DOUBLE AS lat_min, least(max(lat) + 20, 90)::DOUBLE AS lat_max FROM ann")
def _(spark, d):
    return plotdata.extent(basined(spark, d))


_COLORS = "[" + ", ".join(f"'{c}'" for c in plotdata.colors(40)) + "]"


@query("v06_color_rank", f"WITH {ANNOT}, r AS (SELECT consensus_group, min(consensus_group_sp) AS consensus_group_sp, row_number() OVER (ORDER BY count(*) DESC, min(ord)) AS rank FROM ann WHERE consensus_group IS NOT NULL GROUP BY 1) SELECT consensus_group, consensus_group_sp, ({_COLORS})[rank] AS color, rank::BIGINT AS rank FROM r")
def _(spark, d):
    return plotdata.color_map(annotated(spark, d)[0]).withColumn("rank", F.col("rank").cast("bigint"))


@query("v01_distribution_map")
def _(spark, d):
    return plotdata.distribution_document(annotated(spark, d)[0])


@query("v12_filtered", f"WITH {_ABUND} SELECT * FROM p WHERE n >= 5 AND basin IN ('Indian Ocean', 'South Pacific Ocean')")
def _(spark, d):
    return plotdata.filtered(plotdata.basin_abundance(annotated(spark, d)[0]), basins=["Indian Ocean", "South Pacific Ocean"], min_count=5)


@query(
    "a27_identity_hist",
    f"""WITH {DIAG}, p AS (SELECT identity FROM diag WHERE identity > 0), s AS (SELECT min(identity) AS lo, max(identity) AS hi FROM p)
    SELECT CASE WHEN hi > lo THEN least(floor((identity - lo) / (hi - lo) * 50), 49)::BIGINT ELSE 0 END AS bin, lo, hi, count(*) AS n FROM p, s GROUP BY ALL""",
)
def _(spark, d):
    return aggregates.identity_histogram(diagnostics(spark, d)).withColumn("bin", F.col("bin").cast("bigint"))


@query("a27_identity_by_status", f"WITH {DIAG} SELECT status, count(*) AS n, min(identity) AS min, quantile_cont(identity, 0.25) AS q1, quantile_cont(identity, 0.5) AS median, quantile_cont(identity, 0.75) AS q3, max(identity) AS max, avg(identity) AS mean FROM diag WHERE identity > 0 GROUP BY 1")
def _(spark, d):
    return aggregates.identity_by_status(diagnostics(spark, d))


@query("a27_status_counts", f"WITH {DIAG} SELECT status, count(*) AS n FROM diag GROUP BY 1")
def _(spark, d):
    return aggregates.status_counts(diagnostics(spark, d))


# --- trees and alignments -------------------------------------------------------------


@query(
    "j13_relabel",
    f"WITH {CONS} SELECT name, coalesce(a.l, b.l, name) AS label FROM (SELECT concat(consensus_group, CASE WHEN cluster_id % 2 = 0 THEN '_n9' ELSE '' END) AS name, consensus_group AS base FROM cons) t LEFT JOIN (SELECT consensus_group AS g, concat('sp ', cluster_id) AS l FROM cons WHERE cluster_id < 8) a ON a.g = t.name LEFT JOIN (SELECT consensus_group AS g, concat('sp ', cluster_id) AS l FROM cons WHERE cluster_id < 8) b ON b.g = t.base",
)
def _(spark, d):
    c = fx.consensus(spark, d)
    tips = c.select(F.concat("consensus_group", F.when(F.col("cluster_id") % 2 == 0, "_n9").otherwise("")).alias("name"))
    labels = c.where("cluster_id < 8").select("consensus_group", F.concat(F.lit("sp "), F.col("cluster_id").cast("string")).alias("consensus_group_sp"))
    return tree.relabelled(tips, labels)


def region_trees(spark: SparkSession, d: str) -> DataFrame:
    """region, text: a tree for each region, of its nations and their customers."""
    at = lambda t: spark.read.parquet(f"{d}/{t}.parquet")
    rows = at("customer").join(at("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    tip = F.concat(F.lit("'c "), F.col("c_custkey").cast("string"), F.lit("':"), (F.col("c_custkey") % 97 / 4).cast("string"))
    nation = rows.groupBy("n_regionkey", "n_nationkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", tip.alias("t")))), lambda x: x["t"]), ",").alias("tips"))
    inner = F.concat(F.lit("("), "tips", F.lit(")"), F.col("n_nationkey").cast("string"), F.lit(":"), (F.col("n_nationkey") % 7 / 8).cast("string"))
    texts = nation.groupBy("n_regionkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", inner.alias("t")))), lambda x: x["t"]), ",").alias("all"))
    return texts.select(F.col("n_regionkey").alias("region"), F.concat(F.lit("("), "all", F.lit(")"), F.col("n_regionkey").cast("string"), F.lit(";")).alias("text"))


@query(
    "s12_newick_nodes",
    """WITH tip AS (SELECT n_regionkey AS r, n_nationkey AS n, c_custkey AS k, row_number() OVER (PARTITION BY n_nationkey ORDER BY c_custkey) AS i, count(*) OVER (PARTITION BY n_nationkey) AS size FROM customer JOIN nation ON c_nationkey = n_nationkey),
    inner_ AS (SELECT r, n, coalesce(sum(size + 1) OVER (PARTITION BY r ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1 AS id FROM (SELECT DISTINCT r, n, size FROM tip))
    SELECT r AS region, 0::BIGINT AS node_id, NULL::BIGINT AS parent_id, NULL::DOUBLE AS branch_length, r::DOUBLE AS support, NULL AS name, false AS is_tip FROM (SELECT DISTINCT r FROM tip)
    UNION ALL SELECT r, id::BIGINT, 0::BIGINT, (n % 7)::DOUBLE / 8, n::DOUBLE, NULL, false FROM inner_
    UNION ALL SELECT tip.r, (id + i)::BIGINT, id::BIGINT, (k % 97)::DOUBLE / 4, NULL, concat('c ', k), true FROM tip JOIN inner_ ON inner_.n = tip.n""",
)
def _(spark, d):
    """A tree for each region, turned to nodes."""
    nodes = tree.node_rows(region_trees(spark, d), "region")
    return nodes.select("region", F.col("node_id").cast("bigint").alias("node_id"), F.col("parent_id").cast("bigint").alias("parent_id"), "branch_length", "support", "name", "is_tip")


@query(
    "v07_tree_layout",
    """WITH tip AS (SELECT n_regionkey AS r, n_nationkey AS n, c_custkey AS k, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey, c_custkey) - 1 AS y FROM customer JOIN nation ON c_nationkey = n_nationkey),
    inner_ AS (SELECT r, n, (n % 7)::DOUBLE / 8 AS x, (min(y) + max(y))::DOUBLE / 2 AS y FROM tip GROUP BY r, n)
    SELECT r AS region, concat('c ', k) AS name, (n % 7)::DOUBLE / 8 + (k % 97)::DOUBLE / 4 AS x, y::DOUBLE AS y, true AS is_tip, NULL::DOUBLE AS support FROM tip
    UNION ALL SELECT r, NULL, x, y, false, CASE WHEN n >= 10 THEN n::DOUBLE END FROM inner_ UNION ALL SELECT r, NULL, 0e0, (min(y) + max(y)) / 2, false, NULL FROM inner_ GROUP BY r""",
)
def _(spark, d):
    """Where the nodes of each region's tree stand; support is shown from 10 on."""
    return tree.layout_rows(region_trees(spark, d), "region", min_support=10.0)


@query("e01_progressive_align")
def _(spark, d):
    return progressive.align(fx.specimens(spark, d).where("nuc IS NOT NULL").select("processid", F.col("nuc").alias("seq"))).select("processid", "aln")


@query("e01_star_align")
def _(spark, d):
    return align.trim_columns(align.star_align(fx.specimens(spark, d).where("nuc IS NOT NULL").select("processid", F.col("nuc").alias("seq"), "ord"))).select("processid", "aln")


def _gappy(put: str, flags: str = "") -> str:
    """The specimens' aligned letters with gaps by rule: most rows lack every ninth place. The engines write replacements differently."""
    return f"CASE WHEN ord % 10 < 7 THEN regexp_replace(aln, '(.{{8}}).', '{put}'{flags}) ELSE aln END"


@query(
    "e02_trim_similarity",
    f"""WITH {SPEC}, a AS (SELECT processid, {_gappy(chr(92) + "1-", ", 'g'")} AS aln FROM spec),
    c AS (SELECT i - 1 AS k, substr(aln, i, 1) AS c, count(*) AS m FROM a, unnest(range(1, 129)) AS r(i) GROUP BY ALL),
    q AS (SELECT k, sum(m)::DOUBLE AS n, coalesce(sum(m::DOUBLE * (m - 1)) FILTER (c <> '-'), 0) AS same, coalesce(sum(m) FILTER (c <> '-'), 0)::DOUBLE AS filled FROM c GROUP BY k),
    t AS (SELECT k, filled = n AS full_, least(floor(same / (n * (n - 1)) * (filled / n) * 100), 99)::INT AS bin FROM q),
    b AS (SELECT bin, count(*)::DOUBLE AS n, sum(bin)::DOUBLE AS s FROM t GROUP BY bin),
    w AS (SELECT bin, max(bin) OVER lo AS last, sum(n) OVER lo AS n0, sum(s) OVER lo AS s0, sum(n) OVER () AS n, sum(s) OVER () AS s FROM b WINDOW lo AS (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    v AS (SELECT bin, (s0 * (n - n0) - (s - s0) * n0) * (s0 * (n - n0) - (s - s0) * n0) / (n0 * (n - n0)) AS v FROM w WHERE n0 IS NOT NULL AND last < 50),
    cut AS (SELECT coalesce((SELECT bin FROM v WHERE v > 0 ORDER BY v DESC, bin LIMIT 1), 0) AS cut)
    SELECT processid, string_agg(substr(aln, (k + 1)::INT, 1), '' ORDER BY k) AS aln FROM a, t, cut WHERE bin >= cut OR full_ GROUP BY processid""",
)
def _(spark, d):
    return align.trim_similar(fx.specimens(spark, d).select("processid", F.expr(_gappy("$1-")).alias("aln")))


@query("pipeline_genotyping")
def _(spark, d):
    from ..config import Config
    from .genotyping import run

    config = Config().update(dereplication__min_sequence_length=100, dereplication__min_post_trim_length=100, genotype_assignment__min_identity=0.9, geographic__exclude_missing=False)
    s = fx.specimens(spark, d).drop("aln", "fam")
    return run(s, config, fx.boxes(spark))["annotated"].select("processid", "consensus_group", "assigned_sp", "assignment_level", "ocean_basin")


from . import source_queries  # noqa: E402, F401  (registers its queries here)
