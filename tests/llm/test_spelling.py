"""Spelling variants against comparing every word with every other."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from atlasweave.llm import spelling
from tests.llm.test_llm import empty, odd  # noqa: F401


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


def counted(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return found


def brute(n):
    near = {w: [v for v in n if edits(w, v) == 1] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def rows_of(df):
    return {tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect()}


def test_query_against_brute_force(spark, tmp_path):
    rng = random.Random(4)
    base = ["".join(rng.choice("abcdeéÿ×nost") for _ in range(rng.randint(3, 9))) for _ in range(40)]

    def word():
        w = rng.choice(base[: rng.choice([3, 10, 40])])
        if rng.random() < 0.3:
            i = rng.randrange(len(w))
            w = rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("abné") + w[i:], w[:i] + rng.choice("abné") + w[i + 1 :]])
        return w.upper() if rng.random() < 0.1 else w

    rows = [(i, "".join(word() + rng.choice([" ", "-", "’", "2", "\n", "ł", "Ā", "€ "]) for _ in range(60)), "en", "s", 1) for i in range(120)]
    rows += [(3, None, None, None, None), (None, "abcde abcdé ABCDE " * 5, "en", "s", 1), (4, "", "en", "s", 1), (3, "Zebra zebra zebras", "en", "s", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        str(tmp_path / "documents.parquet"))
    n = {w: c for w, c in counted((r[0], r[1]) for r in rows).items() if len(w) >= 5 and c >= 3}
    assert len(n) > 100
    got = spelling.op13_spelling(spark, str(tmp_path))
    assert rows_of(got) == brute(n) and got.count() == len(n)


@pytest.mark.parametrize("symbols", [1, 4, 90])
def test_any_alphabet_gives_all_pairs(spark, symbols):
    rng = random.Random(symbols)
    words = list({"".join(rng.choice("abÿ") for _ in range(rng.randint(1, 6))) for _ in range(120)})
    df = spark.createDataFrame([(w, i + 1) for i, w in enumerate(words)], "word string, n long")
    got = [(r["word"], r["near"]) for r in spelling.near_pairs(df, symbols).collect()]
    want = {(a, b) for a in words for b in words if edits(a, b) == 1}
    assert len(got) == len(want) and set(got) == want


def test_a_long_chain_of_forms(spark):
    words = ["a" * k for k in range(5, 30)]
    df = spark.createDataFrame([(w, 2**i) for i, w in enumerate(words)], "word string, n long")
    assert {r["root"] for r in spelling.variants(df).collect()} == {words[-1]}


def test_letter_runs_and_odd_rows(spark, odd, empty):  # noqa: F811
    text = "Été-DÉJÀ l’œuvre naïve×x Ābßz ÿ2é́a A b"
    want = [re.sub("[A-Z]", lambda m: m[0].lower(), r).encode() for r in re.findall("[A-Za-zÀ-ÿ]+", text)]
    assert spelling.letter_runs(text.encode()) == want
    counts = {r["word"]: r["n"] for r in spelling.word_counts(odd, spelling.altered).collect()}
    assert sum(counts.values()) == sum(counted((r["doc_id"], r["text"]) for r in odd.collect()).values())
    assert spelling.variants(spelling.word_counts(empty)).count() == 0
