"""N-gram Jaccard join against comparing all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from atlasweave.llm import jaccard_join as jj
from tests.llm.test_llm import SCHEMA, empty, odd  # noqa: F401


def gram_set(text, width=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < width:
        return frozenset([" ".join(words)] if words else [])
    return frozenset(" ".join(words[i : i + width]) for i in range(len(words) - width + 1))


def brute(rows):
    sets = [gram_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            shared = len(a & sets[j])
            if a and sets[j] and 100 * shared >= 85 * (len(a) + len(sets[j]) - shared):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted((str(d), len(s), str(least.get(find(i)) if s else d)) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def texts(rng):
    vocabulary = [f"w{i}" for i in range(300)]
    out = []
    for _ in range(8):  # clusters in which not all are alike, chains, and parts that all share
        words = [rng.choice(vocabulary) for _ in range(rng.randint(20, 160))]
        for _ in range(rng.randint(1, 25)):
            out.append(" ".join(words))
            words = list(words) if rng.random() < 0.7 else list(rng.choice(out).split())
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                at = rng.randrange(len(words))
                words[at : at + rng.choice([0, 1])] = [rng.choice(vocabulary).upper()]
    out += [" ".join(rng.choice("ab") for _ in range(rng.randint(1, 12))) for _ in range(60)]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("seed, hot", [(1, jj.HOT), (2, 4), (3, 1)])
def test_components_are_those_of_all_pairs(spark, seed, hot, monkeypatch):
    monkeypatch.setattr(jj, "SPREAD", 3)
    monkeypatch.setattr(jj, "CROWD", {1: jj.CROWD, 2: 3, 3: 0}[seed])
    monkeypatch.setattr(jj, "BLOCK", 5 if seed == 3 else jj.BLOCK)
    monkeypatch.setattr(jj, "IDS", 10 if seed == 2 else jj.IDS)
    rng = random.Random(seed)
    rows = [(i * 3 + 1, t) for i, t in enumerate(texts(rng))]
    rows += [(1, None), (500, ""), (None, rows[0][1]), (None, "a lone text without id and others"), (2, rows[5][1]), (2, rows[9][1]), rows[3]]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in jj.similar_documents(df, hot=hot).collect())
    assert got == brute(rows)


def test_parities_bound_the_difference_and_the_forest_connects():
    rng = random.Random(9)
    sets = [np.unique(np.array([rng.getrandbits(64) for _ in range(60)], np.uint64))]
    for _ in range(40):
        base = rng.choice(sets)
        sets.append(np.unique(np.concatenate([base[rng.randrange(4):], np.array([rng.getrandbits(64) for _ in range(3)], np.uint64)])))
    bits = np.array([jj.parities(g) for g in sets], np.int64).view(np.uint64)
    n = np.array([len(g) for g in sets])
    crowd = (np.arange(len(sets)), n, np.zeros(len(sets), np.int64), np.arange(len(sets)), bits)
    pairs = set(zip(*jj._remaining(crowd, 85)))
    for i, a in enumerate(sets):
        for j in range(i + 1, len(sets)):
            apart = int(np.bitwise_count(bits[i] ^ bits[j]).sum())
            shared = len(np.intersect1d(a, sets[j]))
            assert apart <= len(a) + len(sets[j]) - 2 * shared
            assert (i, j) in pairs or not jj.enough(shared, len(a) + len(sets[j]))
    forest = {tuple(sorted(p)) for p in zip(*jj._closest(crowd, 85))}
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    def classes(edges):
        root[:] = range(len(sets))
        for a, b in edges:
            root[find(a)] = find(b)
        return [min(k for k in range(len(sets)) if find(k) == find(i)) for i in range(len(sets))]

    assert forest <= pairs and classes(forest) == classes(pairs) and len(forest) == len(sets) - len(set(classes(pairs)))


def test_rows_under_a_key_whatever_the_batches():
    rng = np.random.default_rng(3)
    rows = sorted({(int(k), int(s) % 2, int(s)) for k, s in rng.integers(0, 12, (60, 2))} | {(99, 0, 4)})
    rows = [r for r in rows for _ in range(rng.integers(1, 3))]
    want = set()
    for key, salt, s in rows:
        run = sorted({x[2] for x in rows if x[:2] == (key, salt)})
        if len(run) > 1:
            want.add((key, s, run[0]))
    table = pa.table({"key": [r[0] for r in rows], "salt": pa.array([r[1] for r in rows], pa.int32()), "set": [r[2] for r in rows],
                      **{c: pa.array([1] * len(rows), pa.int32()) for c in ("n", "pos", "salts")}})
    for size in (1, 2, 7, 1000):
        got = [tuple(r[c] for c in ("key", "set", "head")) for b in jj._met(iter(table.to_batches(max_chunksize=size))) for r in b.to_pylist()]
        assert set(got) == want and len(got) == len(want)


def test_odd_rows(spark, odd, empty):  # noqa: F811
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in jj.similar_documents(odd).collect())
    assert got == brute(rows)
    assert jj.similar_documents(empty).count() == 0
