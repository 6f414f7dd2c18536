"""Toxicity: a learned lexicon trie met by Levenshtein automata, weighed by context.

Lexicon. Over a bounded sample of labelled training documents every word, and
every stem (word beginning) of 4 to 8 letters, is counted by document and label;
terms that are significantly tied to the toxic label enter a trie with their log
odds as weight.

Matching. The Levenshtein automaton of one edit runs over the trie: a state is a
set of (trie node, edits so far), made into a deterministic automaton as words
ask for it, so a word costs one table step per letter and most words leave the
trie within a few. A letter put in, left out or changed, or two neighbours swapped,
is one edit. Words of five letters and more match with one edit, shorter ones
exactly; stems match exactly; words are of any length.

Context. A hit counts less where the words around it quote or report it
(quotation marks, verbs of saying); counts inside and outside such windows are
separate features. A logistic regression over these features gives the score; in
training a document's own counts are taken off the lexicon's (leave one out). Of
rows that share an id the first text in order is fitted.

Labels, language, source and id are no inputs of a score. Defined cases: a null
text is scored as the empty text; repeated rows are scored each for itself; null
or conflicting labels are left out of training; without both classes, or where the
features tell nothing (as of empty texts alone), every score is below the threshold; an empty table gives an empty result. Kept columns may have
any name but ``score`` and ``predicted``, which give way to the results.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_of_id, enter, materialize, small_batches, table

#: Labelled documents used for fitting at most; they bound the lexicon too.
MAX_LABELLED = 12_000
#: A term stands in so many toxic training documents at least; its G statistic is so high at least.
LEAST_DOCUMENTS, LEAST_G = 3, 12.0
FOLDS, HELD_OUT, CUT_AT = 3, 1, 0.7
STEMS = range(4, 9)
#: Words on either side of a hit that tell quotation from abuse, and what a quoted hit still counts.
CONTEXT, QUOTED_COUNTS = 6, 0.3
#: Verbs and nouns that report speech.
REPORTING = frozenset(
    "said says wrote writes called quote quoted quotes quoting word words term reported allegedly"
    " sagte schrieb nannte zitat zitiert wort dit écrit appelé citation mot dijo escribió llamó cita palabra".split()
)
_QUOTES = frozenset("\"“”„«»‘’")
_LETTERS = re.compile(r"[^\W\d_]+")
_LEET = str.maketrans("013457@$", "oieastas")
_MARKS = ".,;:!?\"'()[]#*$%&|<>"
_NOTHING = (None, None, None)
#: Chunks and words remembered, and trie places in all states of the automaton (some 100 bytes each), before both are begun anew.
_CHUNKS, _SPOTS = 400_000, 300_000


def words_in(text: str) -> set[str]:
    return set(_LETTERS.findall(text.lower()))


def terms_of(words: set[str]) -> set[str]:
    return words | {f"{w[:k]}*" for w in words for k in STEMS if len(w) >= k}


class Lexicon:
    """terms: term -> (toxic documents, other documents); totals of both."""

    def __init__(self, terms: dict[str, tuple[int, int]], toxic: int, other: int):
        self.terms, self.totals = terms, (toxic, other)
        self.next: list[dict[str, int]] = [{}]
        self.word_at: list[str | None] = [None]
        self.stem_at: list[str | None] = [None]
        for term in sorted(terms):
            node = 0
            for c in term.rstrip("*"):
                if c not in self.next[node]:
                    self.next[node][c] = len(self.next)
                    self.next.append({})
                    self.word_at.append(None)
                    self.stem_at.append(None)
                node = self.next[node][c]
            (self.stem_at if term.endswith("*") else self.word_at)[node] = term
        self._begin()

    def _begin(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.held = 0
        self.start = self._state({(0, 0)})
        self.found: dict[str, tuple | None] = {}
        self.words: dict[str, tuple] = {}

    def _state(self, spots: set[tuple]) -> int:
        work = list(spots)
        while work:  # a letter left out of the text
            node, e = work.pop()
            if e == 0:
                for to in self.next[node].values():
                    if (to, 1) not in spots:
                        spots.add((to, 1))
                        work.append((to, 1))
        kept = frozenset(s for s in spots if s[1] != 1 or (s[0], 0) not in spots)
        if kept not in self.states:
            self.states[kept] = len(self.sets)
            self.held += len(kept)
            self.sets.append(kept)
            self.moves.append({})
        return self.states[kept]

    def _move(self, state: int, c: str) -> int:
        spots: set[tuple] = set()
        for node, e in self.sets[state]:
            if isinstance(e, str):  # the second of two swapped letters
                if e == c:
                    spots.add((node, 1))
                continue
            if c in self.next[node]:
                spots.add((self.next[node][c], e))
            if e == 0:
                spots.add((node, 1))  # a letter put in
                for k, to in self.next[node].items():
                    if k != c:
                        spots.add((to, 1))  # a letter changed
                        if c in self.next[to]:  # two neighbours swapped, if ``k`` comes next
                            spots.add((self.next[to][c], k))
        to = self._state(spots) if spots else -1
        self.moves[state][c] = to
        return to

    def match(self, word: str) -> tuple[str | None, str | None, str | None]:
        """The term itself, its longest stem, a term one edit away."""
        state, node, stem = self.start, 0, None
        moves, following, stems = self.moves, self.next, self.stem_at
        for c in word:
            if node >= 0:
                node = following[node].get(c, -1)
                if node >= 0 and stems[node]:
                    stem = stems[node]
            if state >= 0:
                to = moves[state].get(c)
                state = self._move(state, c) if to is None else to
            elif node < 0:
                break
        exact = self.word_at[node] if node >= 0 else None
        near = None
        if exact is None and state >= 0 and len(word) >= 5:
            close = [t for n, e in self.sets[state] if e == 1 and (t := self.word_at[n]) and len(t) >= 5]
            near = max(close, key=lambda t: (self.weight(t), t), default=None)
        return exact, stem, near

    def _matched(self, word: str) -> tuple[str | None, str | None, str | None]:
        found = self.match(word)
        if found == _NOTHING:
            found = _NOTHING
        if len(word) <= 64:
            self.words[word] = found
        return found

    def weight(self, term: str, label: int | None = None) -> float:
        """Log odds; with ``label`` as if one document of that label had not been counted."""
        a, b = self.terms[term]
        a, b = a - (label == 1), max(b - (label == 0), 0)
        if a < LEAST_DOCUMENTS - 1:
            return 0.0
        return math.log((a + 0.5) / (self.totals[0] + 1)) - math.log((b + 0.5) / (self.totals[1] + 1))

    def chunk(self, chunk: str) -> tuple | None:
        """Matches of a white-space chunk, or None."""
        if len(self.found) + len(self.words) > _CHUNKS or self.held > _SPOTS:
            self._begin()
        core = chunk.strip(_MARKS).lower()
        if core.isalpha():
            m = self.words.get(core) or self._matched(core)
            out = (m,) if m is not _NOTHING else None
            if len(chunk) <= 64:
                self.found[chunk] = out
            return out
        words = _LETTERS.findall(chunk.lower())
        if core != core.translate(_LEET) and any(map(str.isalpha, core)):
            folded = core.translate(_LEET)
            if folded.isalpha():
                words.append(folded)
        out = tuple(m for w in words if (m := self.words.get(w) or self._matched(w)) is not _NOTHING)
        if len(chunk) <= 64:
            self.found[chunk] = out or None
        return out or None

    def features(self, text: str | None, label: int | None = None) -> list[float]:
        chunks = (text or "").split()
        found, chunk = self.found, self.chunk
        hits = [(i, h) for i, h in enumerate([found[c] if c in found else chunk(c) for c in chunks]) if h]
        sums = [0.0, 0.0, 0.0, 0.0]  # exact, stem, near, quoted
        counts = [0, 0, 0, 0]
        strongest, kinds = 0.0, {}
        for i, ms in hits:
            around = chunks[max(i - CONTEXT, 0) : i + CONTEXT + 1]
            quoted = bool(_QUOTES & set(chunks[i])) or any(c.strip(".,:;!?").lower() in REPORTING for c in around) or _inside_quotes(chunks, i)
            for exact, stem, near in ms:
                w, kind = max(
                    (self.weight(exact, label) if exact else 0.0, 0), (self.weight(stem, label) if stem else 0.0, 1), (0.7 * self.weight(near) if near else 0.0, 2),
                    key=lambda x: (x[0], -x[1]),
                )
                if w <= 0:
                    continue
                if quoted:
                    sums[3] += w
                    counts[3] += 1
                    w *= QUOTED_COUNTS
                sums[kind] += w
                counts[kind] += 1
                strongest = max(strongest, w)
                term = (exact, stem, near)[kind]
                kinds[term] = max(kinds.get(term, 0.0), w)
        n = math.log1p(len(chunks))
        total, distinct = sum(sums[:3]), sum(kinds.values())
        return [
            *(math.log1p(s) for s in sums), *(math.log1p(c) for c in counts), strongest, math.log1p(distinct), math.log1p(total),
            math.log1p(total) / (1 + n), min(total / (1 + len(chunks)) * 20, 5.0), math.sqrt(distinct), n, float(total > 0),
        ]


FEATURES = 16
FEATURE_COLUMN = "__toxicity_features"


def _inside_quotes(chunks: list[str], i: int) -> bool:
    """An opening mark within the window before and a closing one after."""
    before = any(c[:1] in _QUOTES for c in chunks[max(i - CONTEXT, 0) : i] if c)
    return before and any(c.rstrip(".,:;!?")[-1:] in _QUOTES for c in chunks[i + 1 : i + CONTEXT + 1] if c)


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    for batch in batches:
        for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts[y].update(terms_of(words_in(text or "")))
    terms = list(counts[0].keys() | counts[1].keys())
    for at in range(0, len(terms), 50_000):
        part = terms[at : at + 50_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part), pa.array([counts[1][t] for t in part], pa.int64()), pa.array([counts[0][t] for t in part], pa.int64())], names=["term", "a", "b"]
        )


def learn_lexicon(training: DataFrame) -> Lexicon:
    """``training``: text and y, of a bounded number of documents. All terms that are tied to the toxic label."""
    sizes = training.groupBy("y").count().collect()
    n = {r["y"]: r["count"] for r in sizes}
    toxic, other = n.get(1, 0), n.get(0, 0)
    if not toxic or not other:
        return Lexicon({}, toxic, other)
    terms = training.select("text", "y").mapInArrow(_counter, "term string, a bigint, b bigint").groupBy("term").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    rate = lambda x, total: x * F.log(F.greatest(x, F.lit(1e-9)) / (total * (F.col("a") + F.col("b")) / F.lit(float(toxic + other))))
    g = F.lit(2.0) * (
        rate(F.col("a").cast("double"), F.lit(float(toxic))) + rate(F.col("b").cast("double"), F.lit(float(other)))
    )
    strong = (
        terms.where(F.col("a") >= LEAST_DOCUMENTS)
        .where(F.col("a") * other > 4 * F.col("b") * toxic)
        .withColumn("g", g)
        .where(F.col("g") >= LEAST_G)
    )
    return Lexicon({r["term"]: (int(r["a"]), int(r["b"])) for r in strong.collect()}, toxic, other)


_made: dict[int, Lexicon] = {}


def _featured(terms: dict[str, tuple[int, int]], totals: tuple[int, int], columns: list[str]):
    key = zlib.crc32(repr((sorted(terms.items()), totals)).encode())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("toxicity", _made.clear)
        if key not in _made:
            _made.clear()
            _made[key] = Lexicon(terms, *totals)
        lexicon = _made[key]
        for batch in batches:
            text = batch.column(len(columns))
            y = batch.column(len(columns) + 1).to_pylist()
            found = [lexicon.features(t.as_py(), label) for t, label in zip(text, y, strict=True)]
            kept = [batch.column(i) for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found, pa.list_(pa.float64()))], names=[*columns, FEATURE_COLUMN])

    return run


def features(df: DataFrame, lexicon: Lexicon, keep: list[str], text_col: str = "text", label: str | None = None) -> DataFrame:
    from pyspark.sql import types as T

    small_batches(df.sparkSession)
    y = F.col(label).cast("int") if label else F.lit(None).cast("int")
    given = df.select(*keep, F.col(text_col).cast("string").alias("__text"), y.alias("__y"))
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField(FEATURE_COLUMN, T.ArrayType(T.DoubleType()))])
    return given.mapInArrow(_featured(lexicon.terms, lexicon.totals, keep), schema)


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.02) -> dict:
    """Logistic regression by Newton steps, and the cut with the best F1 in training."""
    if not len(y) or y.min() == y.max():
        return {"w": np.zeros(FEATURES), "bias": -20.0}
    # The floor keeps a feature that hardly varies in training from deciding elsewhere.
    centre, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 0.1)
    z = np.hstack([(x - centre) / scale, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    penalty = np.eye(len(w)) * ridge
    penalty[-1, -1] = 1e-6
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (p - y) / len(y) + penalty @ w
        hessian = (z * (p * (1 - p))[:, None]).T @ z / len(y) + penalty
        move = np.linalg.solve(hessian, gradient)
        w -= move
        if np.abs(move).max() < 1e-7:
            break
    s = z @ w
    cuts = np.unique(np.quantile(s, np.linspace(0.3, 0.999, 300)))
    f1 = [2 * (y[s >= c].sum()) / max((s >= c).sum() + y.sum(), 1) for c in cuts]
    best = max(f1)
    if best <= 2 * y.sum() / (len(y) + y.sum()):  # no better than calling every text toxic
        return {"w": np.zeros(x.shape[1]), "bias": -20.0}
    good = [c for c, v in zip(cuts, f1, strict=True) if v >= best - 1e-12]
    cut = good[len(good) // 2]
    weights = w[:-1] / scale
    return {"w": weights, "bias": float(w[-1] - (centre * weights).sum() - cut)}


def scored(feats: DataFrame, model: dict, at: float = CUT_AT) -> DataFrame:
    w = F.array(*[F.lit(float(v)) for v in model["w"]])
    raw = F.aggregate(F.zip_with(FEATURE_COLUMN, w, lambda a, b: a * b), F.lit(float(model["bias"] + math.log(at / (1 - at)))), lambda a, v: a + v)
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.least(raw, F.lit(30.0)), F.lit(-30.0))))
    return feats.withColumn("score", score).withColumn("predicted", (F.col("score") >= F.lit(at)).cast("int"))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = FOLDS, held_out: int = HELD_OUT, most: int = MAX_LABELLED) -> tuple[Lexicon, dict]:
    given = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (crc_of_id() % folds != held_out))
        .groupBy("doc_id")
        .agg(F.min(label).alias("lo"), F.max(label).alias("hi"))
        .where("lo = hi")
        .select("doc_id", F.col("lo").cast("int").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    # At most ``most`` pairs of numbers are broadcast.
    # An id may repeat without bound in ``docs``; one text of each is fitted, so at most ``most`` texts.
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(given), "doc_id")
    training = materialize(texts.groupBy("doc_id", "y").agg(F.min("text").alias("text")), "training")
    lexicon = learn_lexicon(training)
    rows = features(training, lexicon, ["y"], label="y").toPandas()
    x = np.array(rows[FEATURE_COLUMN].tolist(), dtype=float).reshape(len(rows), -1) if len(rows) else np.zeros((0, FEATURES))
    return lexicon, fit(x, rows["y"].to_numpy())


def score(docs: DataFrame, lexicon: Lexicon, model: dict, keep: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """``keep`` columns (all by default), score and predicted."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("score", "predicted")]
    return scored(features(docs, lexicon, keep, text_col), model).drop(FEATURE_COLUMN)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lexicon, model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, lexicon, model, keep=["doc_id"]).select(
        "doc_id", (crc_of_id() % FOLDS == HELD_OUT).alias("held_out"), "score", "predicted"
    )


QUERIES = {"op9_toxicity": op9_toxicity}
ORACLE_SQL: dict[str, str] = {}
