"""Secret scan: base patterns plus sliding-window entropy, in SQL functions only.

Base findings come from three fixed patterns. The method adds to them: over
candidate strings (long runs of token characters) it slides a window of
``window`` characters, keeps the count of every character of the class's
alphabet up to date by adding the one that enters and taking off the one that
leaves (two places of the list of counts), and so updates the Shannon entropy in
constant work per step. Windows
at or over the class's threshold are merged to spans; candidates on the
allow-list are suppressed. Entropies are compared as integers (``c log2 c``
scaled by 2^20), so every engine decides alike.

That choice of the class looks at a whole candidate, as the SQL does. With
``by_window`` each window chooses for itself: hex of either case, with or without
separators; letters and digits; base64; and letters of both cases without a digit,
each with its own threshold. Words on the allow-list then suppress only the windows
they overlap. All windows of the first kind are among these. ``redact`` and
``op1_secret_windows`` work by window.

Defined cases: a null text is empty and has no spans; an empty table gives an
empty result; repeated rows are scanned each for itself; other columns are
ignored by the query and kept by the operator.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_of

# The contract's base patterns. Letters of the key words match in
# either case (ASCII only).
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64", "entropy_alnum")
ASSIGN_MIN = 6

# Parameters of the entropy method.
WINDOW = 20
SCALE = 1 << 20
ALPHABETS = {
    "entropy_hex": "0123456789abcdef",
    "entropy_base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-",
}
THRESHOLDS = {"entropy_hex": 3.0, "entropy_base64": 3.8}
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: The look-behind only spares the engine restarts within a run.
CANDIDATE_FAST = r"(?<![A-Za-z0-9+/_=-])" + CANDIDATE
#: What stands in place of a found secret.
MARK = "[SECRET]"
ALLOW = r"example|EXAMPLE|sample|dummy|placeholder|changeme|0123456789|abcdefghij|ABCDEFGHIJ"


#: Thresholds of windows that choose their class; ``letters``: both cases, no digit.
WINDOW_THRESHOLDS = {"entropy_hex": 3.0, "entropy_base64": 3.8, "entropy_alnum": 3.6, "letters": 4.0}
#: Places in the base64 alphabet, from 1: character classes of a window.
CLASSES = {"hu": (1, 6), "ou": (7, 26), "hl": (27, 32), "ol": (33, 52), "d": (53, 62), "sep": (63, 67)}


def weight(count: int) -> int:
    """``c log2 c`` scaled to an integer."""
    return round(count * math.log2(count) * SCALE) if count else 0


def limit(kind: str, window: int = WINDOW, thresholds: dict = THRESHOLDS) -> int:
    """The largest sum of weights of a window that reaches the threshold:
    entropy = log2 W - sum / W."""
    return math.floor(window * (math.log2(window) - thresholds[kind]) * SCALE)


#: Matches or steps of one inner fold; outer folds join what they list.
CHUNK = 256


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once: lambdas know no common subexpressions."""
    return F.element_at(F.transform(F.array(value), use), 1)


def after(acc: Column, value: Column, use) -> Column:
    """The state ``use(acc, value)`` of the same type, with the value computed once and no
    copy of the state (``transform`` copies what it gives)."""
    return F.aggregate(F.array(value), acc, use)


def matches(text: Column, pattern: str, group: int = 0, least: int = 0) -> Column:
    """All matches as array<struct<start,end,text>>, code points, end exclusive.

    Positions follow from the pieces between matches, which ``split`` gives.
    Matches whose ``group`` is shorter than ``least`` are dropped. The fold walks
    over the zipped pieces, so no expression on the text runs once per match, and
    lists them in chunks, so that appending does not copy what many matches gave.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    gaps = F.split(text, pattern, -1)
    pieces = F.zip_with(F.zip_with(found, part, lambda f, v: F.struct(f.alias("f"), v.alias("v"))), gaps, lambda x, g: F.struct(x["f"].alias("f"), x["v"].alias("v"), g.alias("g")))
    kind = "array<struct<start:bigint,end:bigint,text:string>>"

    def step(acc: Column, x: Column) -> Column:
        at = acc["at"] + F.length(x["g"])
        end = at + F.length(x["f"])
        put = F.concat(acc["out"], F.array(F.struct(at.cast("long").alias("start"), end.cast("long").alias("end"), x["f"].alias("text"))))
        # The last piece has no match behind it.
        return F.struct(
            F.coalesce(end, at).alias("at"),
            F.when(x["f"].isNotNull() & (F.length(x["v"]) >= least), put).otherwise(acc["out"]).alias("out"),
        )

    def chunk(acc: Column, k: Column) -> Column:
        start = F.struct(acc["at"].alias("at"), F.array().cast(kind).alias("out"))
        inner = F.aggregate(F.slice(acc["pieces"], k * CHUNK + 1, F.lit(CHUNK)), start, step)
        return after(acc, inner, lambda a, v: F.struct(a["pieces"].alias("pieces"), v["at"].alias("at"), F.concat(a["out"], F.array(v["out"])).alias("out")))

    def listed(all_pieces: Column) -> Column:
        start = F.struct(all_pieces.alias("pieces"), F.lit(0).alias("at"), F.array().cast(f"array<{kind}>").alias("out"))
        chunks = F.sequence(F.lit(0), F.floor((F.size(all_pieces) - 1) / CHUNK).cast("int"))
        return F.aggregate(chunks, start, chunk, lambda acc: F.flatten(acc["out"]))

    return bound(pieces, listed)


# Counts of a window's characters: a string with one character per letter of the
# alphabet, whose code is the count plus that of "0". A step reads and writes two
# places of it. Before the text a window holds as many filling characters, which
# have the place behind the alphabet, so a step always adds one and takes off one.
_ZERO = ord("0")


def _turns(word: Column, alphabet: str, window: int) -> Column:
    """By step, the places (from 1) of the character that enters and of the one that leaves."""
    codes = F.transform(F.split(word, ""), lambda ch: F.instr(F.lit(alphabet), ch))
    filling = F.array_repeat(F.lit(len(alphabet) + 1), window)
    return bound(codes, lambda c: F.zip_with(c, F.slice(F.concat(filling, c), F.lit(1), F.size(c)), lambda x, y: F.struct(x.alias("x"), y.alias("y"))))


def _gains(window: int) -> Column:
    """By count c (from 0): what the sum of weights gains when the count grows by one."""
    return F.array(*[F.lit(weight(c + 1) - weight(c)).cast("long") for c in range(window)])


def _full(alphabet: str, window: int) -> Column:
    return F.lit("0" * len(alphabet) + chr(_ZERO + window))


def _counted(acc: Column, x: Column, use) -> Column:
    """``use(acc, v)`` after a step, where ``v`` has the counts ``n`` and the sum of weights ``s``."""
    at = lambda place: F.ascii(F.substring(acc["n"], place, F.lit(1)))
    change = F.struct(at(x["x"]).alias("more"), at(x["y"]).alias("less"))

    def changed(v: Column) -> Column:
        grown = F.overlay(acc["n"], F.chr(v["more"] + 1), x["x"], F.lit(1))
        counts = F.overlay(grown, F.chr(v["less"] - 1), x["y"], F.lit(1))
        total = acc["s"] + F.get(acc["gain"], v["more"] - _ZERO) - F.get(acc["gain"], v["less"] - 1 - _ZERO)
        return F.struct(counts.alias("n"), total.alias("s"))

    same = F.struct(acc["n"].alias("n"), acc["s"].alias("s"))
    return after(acc, F.when(x["x"] == x["y"], same).otherwise(bound(change, changed)), use)


def _listed(turns: Column, start: Column, step, last, kind: str) -> Column:
    """The ranges that ``step`` closes (field ``runs`` of the state, of type ``kind``) and the
    ``last`` one. They are handed on after every CHUNK steps, so that a step's work does
    not grow with what was found before."""
    none = F.array().cast(kind)

    def chunk(acc: Column, k: Column) -> Column:
        inner = F.aggregate(F.slice(acc["turns"], k * CHUNK + 1, F.lit(CHUNK)), acc["state"], step)
        return after(acc, inner, lambda a, v: F.struct(a["turns"].alias("turns"), v.withField("runs", none).alias("state"), F.concat(a["lists"], F.array(v["runs"])).alias("lists")))

    def every(t: Column) -> Column:
        begin = F.struct(t.alias("turns"), start.alias("state"), F.array().cast(f"array<{kind}>").alias("lists"))
        chunks = F.sequence(F.lit(0), F.floor((F.size(t) - 1) / CHUNK).cast("int"))
        return F.aggregate(chunks, begin, chunk, lambda acc: F.concat(F.flatten(acc["lists"]), last(acc["state"])))

    return bound(turns, every)


def entropy_windows(word: Column, alphabet: str, most: int, window: int) -> Column:
    """Merged [from, to) ranges of windows whose sum of weights is at most
    ``most``; offsets within ``word``."""
    runs = "array<struct<a:int,b:int>>"

    def step(acc: Column, x: Column) -> Column:
        def moved(a: Column, v: Column) -> Column:
            end = a["i"] + 1
            first = end - window
            hit = (first >= 0) & (v["s"] <= most)
            fresh = hit & (a["b"] < first)
            return F.struct(
                a["gain"].alias("gain"), end.alias("i"), v["n"].alias("n"), v["s"].alias("s"),
                F.when(fresh, first).otherwise(a["a"]).alias("a"), F.when(hit, end).otherwise(a["b"]).alias("b"),
                F.when(fresh & (a["b"] >= 0), F.concat(a["runs"], F.array(F.struct(a["a"].alias("a"), a["b"].alias("b"))))).otherwise(a["runs"]).alias("runs"),
            )

        return _counted(acc, x, moved)

    start = F.struct(
        _gains(window).alias("gain"), F.lit(0).alias("i"), _full(alphabet, window).alias("n"), F.lit(weight(window)).cast("long").alias("s"),
        F.lit(-1).alias("a"), F.lit(-1).alias("b"), F.array().cast(runs).alias("runs"),
    )
    last = lambda acc: F.when(acc["b"] >= 0, F.array(F.struct(acc["a"].alias("a"), acc["b"].alias("b")))).otherwise(F.array().cast(runs))
    return _listed(_turns(word, alphabet, window), start, step, last, runs)


def class_windows(word: Column, window: int, thresholds: dict, allow: str) -> Column:
    """Merged [a, b) ranges of found windows and their kind ``k``; offsets within ``word``.

    Beside the counts of characters the fold keeps those of character classes (eight
    bits each in one number), so that a window's class costs constant work too.
    """
    alphabet = ALPHABETS["entropy_base64"]
    runs = "array<struct<a:int,b:int,k:int>>"
    spared = F.when(word.rlike(allow), matches(word, allow)).otherwise(F.array().cast("array<struct<start:bigint,end:bigint,text:string>>"))
    mixed = word.rlike("[0-9]") & word.rlike("[A-Za-z]")
    at_most = {k: limit(k, window, thresholds) for k in thresholds}
    number = lambda k: F.lit(KINDS.index(k))
    names = list(CLASSES)
    place = [0] * (len(alphabet) + 2)
    for k, (lo, hi) in enumerate(CLASSES.values()):
        for code in range(lo, hi + 1):
            place[code] = 1 << 8 * k
    places = F.array(*[F.lit(v).cast("long") for v in place])

    def kind_of(acc: Column, classes: Column, total: Column) -> Column:
        count = {c: F.shiftright(classes, 8 * k).bitwiseAND(F.lit(255).cast("long")) for k, c in enumerate(names)}
        each = F.struct(*[v.alias(c) for c, v in count.items()])

        def decided(c: Column) -> Column:
            hexed = (c["ou"] + c["ol"] == 0) & (F.least(c["hl"], c["hu"]) == 0)
            hexed = hexed & F.when(c["sep"] == 0, acc["mixed"]).otherwise((c["sep"] * 4 <= window) & (c["hl"] + c["hu"] >= 2) & (c["d"] >= 2))
            alnum = (c["sep"] == 0) & (c["d"] >= 2) & (window - c["d"] >= 2)
            upper, lower = c["hu"] + c["ou"], c["hl"] + c["ol"]
            letters = (c["d"] == 0) & (F.least(upper, lower) * 5 >= window)
            return (
                F.when((total <= at_most["entropy_hex"]) & hexed, number("entropy_hex"))
                .when((total <= at_most["entropy_alnum"]) & alnum, number("entropy_alnum"))
                .when((total <= at_most["entropy_base64"]) & acc["mixed"], number("entropy_base64"))
                .when((total <= at_most["letters"]) & letters, number("entropy_base64"))
                .otherwise(F.lit(-1))
            )

        return bound(each, decided)

    def step(acc: Column, x: Column) -> Column:
        def moved(a: Column, v: Column) -> Column:
            classes = a["classes"] + F.get(a["places"], x["x"]) - F.get(a["places"], x["y"])
            return after(a, F.struct(v["n"].alias("n"), v["s"].alias("s"), classes.alias("c")), judged)

        def judged(a: Column, v: Column) -> Column:
            end = a["i"] + 1
            first = end - window
            free = ~F.exists(a["spared"], lambda m: (m["start"] < end) & (m["end"] > first))
            kind = F.when((first >= 0) & (v["s"] <= max(at_most.values())) & free, kind_of(a, v["c"], v["s"])).otherwise(F.lit(-1))
            return after(a, F.struct(v["n"].alias("n"), v["s"].alias("s"), v["c"].alias("c"), kind.alias("k")), put)

        def put(a: Column, v: Column) -> Column:
            end = a["i"] + 1
            first = end - window
            hit = v["k"] >= 0
            fresh = hit & ((a["k"] != v["k"]) | (a["b"] < first))
            return F.struct(
                a["gain"].alias("gain"), a["places"].alias("places"), a["spared"].alias("spared"), a["mixed"].alias("mixed"), end.alias("i"), v["n"].alias("n"), v["s"].alias("s"), v["c"].alias("classes"),
                F.when(fresh, first).otherwise(a["a"]).alias("a"), F.when(hit, end).otherwise(a["b"]).alias("b"), F.when(hit, v["k"]).otherwise(a["k"]).alias("k"),
                F.when(fresh & (a["k"] >= 0), F.concat(a["runs"], F.array(F.struct(a["a"].alias("a"), a["b"].alias("b"), a["k"].alias("k"))))).otherwise(a["runs"]).alias("runs"),
            )

        return _counted(acc, x, moved)

    start = F.struct(
        _gains(window).alias("gain"), places.alias("places"), spared.alias("spared"), mixed.alias("mixed"), F.lit(0).alias("i"), _full(alphabet, window).alias("n"), F.lit(weight(window)).cast("long").alias("s"), F.lit(0).cast("long").alias("classes"),
        F.lit(-1).alias("a"), F.lit(-1).alias("b"), F.lit(-1).alias("k"), F.array().cast(runs).alias("runs"),
    )
    last = lambda acc: F.when(acc["k"] >= 0, F.array(F.struct(acc["a"].alias("a"), acc["b"].alias("b"), acc["k"].alias("k")))).otherwise(F.array().cast(runs))
    return _listed(_turns(word, alphabet, window), start, step, last, runs)


def _span(kind: str, start: Column, end: Column) -> Column:
    return F.struct(start.cast("long").alias("start"), F.lit(KINDS.index(kind)).alias("k"), end.cast("long").alias("end"))


def _marker(kind: str):
    return lambda m: _span(kind, m["start"], m["end"])


SPANS = "array<struct<start:bigint,k:int,end:bigint>>"


def scan(df: DataFrame, text_col: str = "text", window: int = WINDOW, thresholds: dict = THRESHOLDS, allow: str = ALLOW, by_window: bool = False, names: tuple[str, str] = ("base_spans", "all_spans")) -> DataFrame:
    """Add the base spans and all spans (array<struct<start,k,end>>, sorted; ``k``
    numbers KINDS) to every row, as columns of these ``names``, to which columns of the
    same name give way. ``by_window``: windows choose their class, by WINDOW_THRESHOLDS
    and those given."""
    text = F.col("__text")
    none = F.array().cast(SPANS)
    df = df.withColumn("__text", text_of(text_col))

    assign = matches(text, ASSIGN, group=2, least=ASSIGN_MIN)
    found = {"assign": (ASSIGN, assign), "access": (ACCESS, matches(text, ACCESS)), "hex": (HEX, matches(text, HEX))}
    base = [
        F.when(text.rlike(pattern), F.transform(spots, _marker(kind))).otherwise(none)
        for kind, (pattern, spots) in found.items()
    ]

    # A candidate has a digit and a letter: invented or long plain words have no digit.
    candidates = F.filter(
        matches(text, CANDIDATE_FAST), lambda m: m["text"].rlike("[0-9]") & m["text"].rlike("[A-Za-z]") & ~m["text"].rlike(allow)
    )
    def extra(kind: str, wanted) -> Column:
        each = F.transform(
            F.filter(candidates, wanted),
            lambda m: F.transform(
                entropy_windows(m["text"], ALPHABETS[kind], limit(kind, window, thresholds), window),
                lambda r: _span(kind, m["start"] + r["a"], m["start"] + r["b"]),
            ),
        )
        return F.when(text.rlike(CANDIDATE_FAST), F.flatten(each)).otherwise(none)

    def windows() -> Column:
        limits = WINDOW_THRESHOLDS if thresholds is THRESHOLDS else WINDOW_THRESHOLDS | thresholds
        letters = lambda t: t.rlike("[0-9]") & t.rlike("[A-Za-z]") | t.rlike("[A-Z]") & t.rlike("[a-z]")
        each = F.transform(
            F.filter(matches(text, CANDIDATE_FAST), lambda m: letters(m["text"])),
            lambda m: F.transform(
                class_windows(m["text"], window, limits, allow),
                lambda r: F.struct((m["start"] + r["a"]).cast("long").alias("start"), r["k"].alias("k"), (m["start"] + r["b"]).cast("long").alias("end")),
            ),
        )
        return F.when(text.rlike(CANDIDATE_FAST), F.flatten(each)).otherwise(none)

    added = [windows()] if by_window else [
        extra("entropy_hex", lambda m: m["text"].rlike("^[0-9a-f]+$")),
        extra("entropy_base64", lambda m: ~m["text"].rlike("^[0-9a-f]+$")),
    ]
    return (
        df.withColumn(names[0], F.array_sort(F.concat(*base)))
        .withColumn(names[1], F.array_sort(F.concat(F.col(names[0]), *added)))
        .drop("__text")
    )


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["k"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(df: DataFrame, text_col: str = "text", mark: str = MARK) -> DataFrame:
    """Replace every found span (overlaps merged) by ``mark``; rows without a
    finding stay as they are, nulls stay null."""
    found = "__secret_spans"
    scanned = scan(df, text_col, by_window=True, names=("__secret_base", found))
    text = text_of(text_col)

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        gap = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(acc["out"], F.array(F.concat(gap, F.lit(mark))))).otherwise(acc["out"]).alias("out"),
        )

    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))
    rest = lambda acc: F.concat(
        F.array_join(acc["out"], ""), F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))
    )
    clean = F.when(F.size(found) > 0, F.aggregate(found, start, step, rest)).otherwise(F.col(text_col))
    return scanned.withColumn(text_col, clean).drop("__secret_base", found)


def _rows(spark: SparkSession, sf_dir: str, by_window: bool) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    count = lambda k: F.size(F.filter("base_spans", lambda s: s["k"] == KINDS.index(k))).cast("long")
    return scan(docs, by_window=by_window).select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(written(F.col("base_spans")).cast("binary"), 256).alias("base_sha256"),
        written(F.col("all_spans")).alias("spans"),
    )


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(spark, sf_dir, by_window=False)


def op1_secret_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(spark, sf_dir, by_window=True)


def _oracle() -> str:
    q = lambda s: s.replace("'", "''")
    weights = "[" + ",".join(str(weight(c)) for c in range(WINDOW + 1)) + "]"

    def spots(pattern: str) -> str:
        return (
            f"SELECT d.doc_id, d.u, i, list_sum(list_transform(list_slice(g, 1, i), lambda x: length(x)))"
            f" + coalesce(list_sum(list_transform(list_slice(m, 1, i - 1), lambda x: length(x))), 0) AS a, m[i] AS s"
            f" FROM (SELECT doc_id, u, regexp_extract_all(t, '{q(pattern)}', 0) AS m, string_split_regex(t, '{q(pattern)}') AS g FROM d) d,"
            f" unnest(range(1, len(m) + 1)) AS r(i)"
        )

    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS u FROM documents),
assign AS ({spots(ASSIGN)}),
access AS ({spots(ACCESS)}),
hex AS ({spots(HEX)}),
cand AS ({spots(CANDIDATE)}),
base AS (
  SELECT u, 0 AS k, 'assign' AS kind, a, a + length(s) AS b FROM assign WHERE length(regexp_extract(s, '{q(ASSIGN)}', 2)) >= {ASSIGN_MIN}
  UNION ALL SELECT u, 1, 'access', a, a + length(s) FROM access
  UNION ALL SELECT u, 2, 'hex', a, a + length(s) FROM hex),
good AS (
  SELECT u, a, s, regexp_full_match(s, '[0-9a-f]+') AS is_hex FROM cand
  WHERE regexp_matches(s, '[0-9]') AND regexp_matches(s, '[A-Za-z]') AND NOT regexp_matches(s, '{ALLOW}')),
win AS (
  SELECT u, a, is_hex, w, substr(s, w, {WINDOW}) AS x FROM good, unnest(range(1, length(s) - {WINDOW} + 2)) AS r(w)),
letters AS (SELECT u, a, is_hex, w, ch, count(*) AS n FROM win, unnest(string_split(x, '')) AS c(ch) GROUP BY ALL),
high AS (
  SELECT u, a, is_hex, w FROM letters GROUP BY ALL
  HAVING sum(({weights})[n + 1]) <= CASE WHEN is_hex THEN {limit('entropy_hex')} ELSE {limit('entropy_base64')} END),
marked AS (
  SELECT *, CASE WHEN w - lag(w) OVER (PARTITION BY u, a, is_hex ORDER BY w) <= {WINDOW} THEN 0 ELSE 1 END AS fresh FROM high),
runs AS (SELECT *, sum(fresh) OVER (PARTITION BY u, a, is_hex ORDER BY w) AS r FROM marked),
extra AS (
  SELECT u, CASE WHEN is_hex THEN 3 ELSE 4 END AS k, CASE WHEN is_hex THEN 'entropy_hex' ELSE 'entropy_base64' END AS kind,
         a + min(w) - 1 AS a, a + max(w) - 1 + {WINDOW} AS b FROM runs GROUP BY u, runs.a, is_hex, r),
both_kinds AS (SELECT * FROM base UNION ALL SELECT * FROM extra),
n AS (SELECT u, count(*) FILTER (k = 0) AS n0, count(*) FILTER (k = 1) AS n1, count(*) FILTER (k = 2) AS n2,
             string_agg(concat(kind, ':', a, ':', b), ',' ORDER BY a, k, b) AS joined FROM base GROUP BY u),
e AS (SELECT u, string_agg(concat(kind, ':', a, ':', b), ',' ORDER BY a, k, b) AS joined FROM both_kinds GROUP BY u)
SELECT d.doc_id, coalesce(n0, 0)::BIGINT AS n_assign, coalesce(n1, 0)::BIGINT AS n_access, coalesce(n2, 0)::BIGINT AS n_hex,
       sha256(coalesce(n.joined, '')) AS base_sha256, coalesce(e.joined, '') AS spans
FROM d LEFT JOIN n USING (u) LEFT JOIN e USING (u)
"""


QUERIES = {"op1_secret_scan": op1_secret_scan, "op1_secret_windows": op1_secret_windows}
ORACLE_SQL = {"op1_secret_scan": _oracle()}
