"""Periodic runs against the definition."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np

from atlasweave.llm import periodic_runs as pr
from tests.llm.test_llm import SCHEMA, empty, odd  # noqa: F401


def brute(words, shortest=12):
    """Every maximal stretch of every period, the smallest period of each stretch."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(shortest, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, length, q) for (s, length), q in found.items())


def test_runs_are_those_of_the_definition():
    rng = random.Random(5)
    for _ in range(3000):
        words = [rng.randrange(rng.choice([1, 2, 3, 5])) for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.5:
            unit = [rng.randrange(4) for _ in range(rng.randint(1, 9))]
            at = rng.randint(0, len(words))
            words = words[:at] + (unit * 8)[: rng.randint(2, 40)] + words[at:]
        shortest = rng.choice([2, 5, 12])
        ids = np.array(words, np.int64)
        want = brute(words, shortest)
        assert pr.runs(ids, shortest) == want
        if want:  # a text with a run is never set aside
            assert len(pr._repeating(ids, np.zeros(len(ids), np.int64), -(-shortest // 2)))


def test_long_texts_of_one_word_and_of_a_long_period():
    assert pr.runs(np.zeros(50_000, np.int64)) == [(0, 50_000, 1)]
    assert pr.runs(np.tile(np.arange(4000), 5)[:-7]) == [(0, 19_993, 4000)]


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def expected(doc_id, text):
    words = planted(doc_id, (text or "").encode().split())
    found = brute(words)
    drop = {i for s, length, q in found for i in range(s + q, s + length)}
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
    return (len(found), *best, best[0] is not None and 1000 * best[1] // best[2] or None,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in drop)).hexdigest())


COLUMNS = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_query_against_brute_force(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(pr, "PORTION", 400)
    rng = random.Random(2)
    rows = []
    for i in range(400):
        words = [rng.choice(["la", "Ärger", "b", "c", "dé"]) for _ in range(rng.randint(0, 120))]
        rows.append((i, rng.choice([" ", "\n", "\t  "]).join(words), "en", "s", 1))
    rows += [(401, None, None, None, None), (None, "x " * 40, "en", "s", 1), (7, "ab cd " * 9, "en", "s", 1), (402, " \n ", "en", "s", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        str(tmp_path / "documents.parquet"))
    got = sorted((str(r["doc_id"]), *(r[c] for c in COLUMNS)) for r in pr.op11_periodic_runs(spark, str(tmp_path)).collect())
    assert got == sorted((str(r[0]), *expected(r[0], r[1])) for r in rows)
    assert sum(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows) > 20


def test_odd_rows(spark, odd, empty):  # noqa: F811
    got = pr.periodic_runs(odd).collect()
    assert len(got) == odd.count()
    long = next(r for r in got if r["n_words"] == 28000)
    assert [tuple(s) for s in long["runs"]] == [(0, 28000, 7)] and long["collapsed"] == "the end of a very long text"
    assert sum(r["collapsed"] == "a b c" for r in got) == 5 and sum(r["collapsed"] == "" for r in got) == 4
    assert pr.periodic_runs(empty).count() == 0
