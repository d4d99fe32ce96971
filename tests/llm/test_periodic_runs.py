import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from brickyard.llm import periodic_runs


def brute_runs(words):
    """Every stretch that repeats with each period, less those that repeat with a shorter one."""
    found = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q) and not any(q % p == 0 and all(words[x] == words[x + p] for x in range(i, i + q - p + p)) for p in range(1, q)):
                found.append((i, j + q - i, q))
            i = j + 1
    return sorted((s, n, q) for s, n, q in found)


def brute(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in dropped).encode()).hexdigest())


def runs_of(texts):
    runs, collapsed = periodic_runs.step(pa.array(texts, pa.string()))
    return [[tuple(r.values()) for r in row] for row in runs.to_pylist()], collapsed.to_pylist()


@pytest.mark.parametrize("seed", range(12))
def test_runs_of_random_texts_equal_brute_force(seed):
    rng = np.random.default_rng(seed)
    texts = []
    for _ in range(60):
        words = [str(w) for w in rng.integers(0, 2 + seed % 4, rng.integers(0, 60))]
        for _ in range(rng.integers(0, 4)):  # stretches of all periods, some broken or nested
            root = words[:rng.integers(1, 40)] or ["x"]
            at = rng.integers(0, len(words) + 1)
            words[at:at] = (root * int(rng.integers(2, 8)))[:rng.integers(1, 200)]
        if rng.random() < 0.3:
            words = words * int(rng.integers(2, 6))
        texts.append(" ".join(words))
    got, collapsed = runs_of(texts)
    for text, found, rest in zip(texts, got, collapsed):
        words = text.split()
        assert found == brute_runs(words)
        dropped = {i for s, length, q in found for i in range(s + q, s + length)}
        assert rest == " ".join(w for i, w in enumerate(words) if i not in dropped)


def test_regular_texts():
    fibonacci = ["a", "b"]
    while len(fibonacci[-1]) < 1500:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    texts = ["a " * 3000, "a b " * 777 + "a", ("x" + " y" * 20 + " ") * 9, " ".join("ab"[bin(i).count("1") % 2] for i in range(2048)), " ".join(fibonacci[-1]),
             " ".join(f"w{i % 97}" for i in range(97 * 5 + 13)), (" ".join(f"w{i % 97}" for i in range(97 * 4)) + " z ") * 5, "", None, " \n "]
    got, _ = runs_of(texts)
    assert got == [brute_runs((t or "").split()) for t in texts]


def test_the_grammar_spells_the_text():
    words = np.array([0, 1, 2, 0, 1, 2, 3, 0, 1, 1, 1, 1, 1, 4, 0, 1, 2, 3, 0, 1])
    g = periodic_runs.Grammar(words, np.arange(len(words)), np.zeros(len(words), np.int64))
    spelled = {}
    for rule, start, end in zip(g.rule.tolist(), g.start.tolist(), g.end.tolist()):
        assert spelled.setdefault(rule, words[start:end].tolist()) == words[start:end].tolist()
    assert len(spelled) == len({tuple(v) for v in spelled.values()}) and min(np.unique(g.rule, return_counts=True)[1]) >= 2
    assert len(np.unique(g.middle)) == len(g.middle)


def rows_of(df):
    return sorted((tuple(r)[:8] for r in df.collect()), key=repr)


def test_documents_equal_brute_force(spark, docs):
    got = periodic_runs.run_digests(docs)
    assert got.columns[:8] == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    short = {i for i, t in rows if len(t) < 12_000}
    assert [r for r in rows_of(got) if r[0] in short] == sorted((brute(i, t) for i, t in rows if i in short), key=repr)
    assert sum(r[1] > 0 for r in rows_of(got)) > 5


def test_odd_rows(spark, odd, odd_rows, none):
    long = {6, 7}
    got = rows_of(periodic_runs.run_digests(odd))
    assert [r for r in got if r[0] not in long] == sorted((brute(r[0], r[1]) for r in odd_rows if r[0] not in long), key=repr)
    assert len(got) == len(odd_rows)
    empty = periodic_runs.run_digests(none)
    assert empty.count() == 0 and empty.schema == periodic_runs.run_digests(odd).schema
    alike = spark.createDataFrame([(i, "la la la la la la oh " * 8) for i in range(40)], "doc_id long, text string")
    assert rows_of(periodic_runs.run_digests(alike)) == sorted((brute(i, "la la la la la la oh " * 8) for i in range(40)), key=repr)
