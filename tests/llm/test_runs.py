"""op12: runs of words against brute force."""

import hashlib
import random
import zlib
from fractions import Fraction

import pytest

from genoflux.llm import periodic_runs
from genoflux.llm.periodic_runs import digest, repeated_tail, runs_of, words_of


def smallest_period(w):
    border = [0] * (len(w) + 1)
    k = 0
    for i in range(1, len(w)):
        while k and w[i] != w[k]:
            k = border[k]
        k += w[i] == w[k]
        border[i + 1] = k
    return len(w) - border[len(w)]


def brute(words):
    """Every maximal stretch of every period, kept if the period is its smallest."""
    n, out = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(24, 3 * q) and smallest_period(words[i : i + length]) == q:
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_digest(words):
    runs = brute(words)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    four = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (len(runs), *four, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def brute_tail(words, doc_id):
    h = zlib.crc32(doc_id.encode()) & 0xFFFFFFFF
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def sample(r):
    """Words with planted repeats, nested and overlapping ones too, over few or many different words."""
    letters = [f"w{i}" for i in range(r.choice([1, 2, 3, 50]))]
    out = []
    while len(out) < r.randrange(10, 400):
        unit = [r.choice(letters) for _ in range(r.randrange(1, 30))]
        if r.random() < 0.3:
            unit = unit * r.randrange(2, 5)
        out += unit * r.choice([1, 1, 2, 3, 4, 9]) + unit[: r.randrange(0, len(unit) + 1)]
    return out


@pytest.mark.parametrize("seed", range(150))
def test_runs_equal_brute_force(seed):
    words = sample(random.Random(seed))
    assert [tuple(x) for x in runs_of(words).tolist()] == brute(words)
    assert digest(words) == brute_digest(words)


@pytest.mark.parametrize("n", [0, 1, 23, 24, 25, 47, 48, 72, 73])
def test_lengths_at_the_bounds(n):
    for q in (1, 7, 8, 9, 15, 16, 17, 24, 25):
        words = [f"x{i % q}" for i in range(n)]
        assert [tuple(x) for x in runs_of(words).tolist()] == brute(words)
        assert [tuple(x) for x in runs_of(["a", *words, "b"]).tolist()] == brute(["a", *words, "b"])


def test_long_texts():
    r = random.Random(5)
    words = [f"w{r.randrange(500)}" for _ in range(60_000)]
    line = [f"v{i}" for i in range(7000)]
    words[20_000:20_000] = line * 4
    assert [tuple(x) for x in runs_of(words).tolist()] == [(20_000, 28_000, 7000)]
    assert [tuple(x) for x in runs_of(["x"] * 200_000).tolist()] == [(0, 200_000, 1)]


def test_query_on_odd_rows(spark, tmp_path):
    r = random.Random(9)
    texts = [" ".join(sample(r)) for _ in range(60)] + [None, "", " \t\n", "a b " * 20, "a b\x1cc " * 30, "a b " * 20]
    rows = [(i, t, i, "x") for i, t in enumerate(texts)] + [(3, texts[3], 0, "again"), (None, texts[0], 1, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_runs int, runs string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = periodic_runs.op12_periodic_runs(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    want = {str(i if i is not None else ""): brute_digest(brute_tail(words_of(t), str(i if i is not None else ""))) for i, t, *_ in rows}
    for row in got:
        assert tuple(row)[1:] == want[str(row["doc_id"] if row["doc_id"] is not None else "")]
    assert any(repeated_tail(words_of(t), str(i)) != words_of(t) for i, t in enumerate(texts))
    assert periodic_runs.find(df.limit(0), ["doc_id"]).count() == 0


def test_library_form(spark):
    df = spark.createDataFrame([(1, "s " + "a b c " * 10 + "t", "k"), (2, None, "k")], "doc_id bigint, text string, runs string")
    one, two = sorted(periodic_runs.find(df, ["doc_id", "runs"]).collect())
    assert (one["n_words"], [tuple(x) for x in one["runs"]], one["collapsed"]) == (32, [(1, 30, 3)], "s a b c t")
    assert (two["n_words"], two["runs"], two["collapsed"]) == (0, [], "")
