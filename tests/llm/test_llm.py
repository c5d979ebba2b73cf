"""Operators of atlasweave.llm against brute force, exact round trips and odd rows."""

from __future__ import annotations

import hashlib
import random
import re
import tempfile

from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import regex
import xxhash

import corpus_pipeline
from atlasweave.llm import (
    bpe, decontaminate, exact_dedup, language_id, licenses, passages, quality, simhash, token_files, toxicity)
from atlasweave.llm.components import components
from atlasweave.llm.fm_index import FMIndex

# A clashing column of each kind that operators use inside.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, digest string, fp long, row int, n int"
LONG = "the end of a very long text " * 4000


def frame(spark, texts, start=0, langs=None):
    rows = [(start + i, t, (langs or {}).get(i, "en"), "s", len(t or ""), True, "d", 7, 1, 2) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


ODD = ["", None, " \n ", "a", "a  b\tc", "a b c", "é½ ß", LONG, "a b c", "!!"]


@pytest.fixture
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, clashing names."""
    rows = [(i, t, "en", "s", 1, True, "d", 7, 1, 2) for i, t in enumerate(ODD)]
    rows += [(5, "a b c", "en", "s", 1, True, "d", 7, 1, 2), (None,) * 10, (None, "a b c", None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def nothing(spark, kind):
    return spark.createDataFrame([], kind)


# exact dedup

def test_exact_dedup_odd_rows_and_colliding_digests(spark, odd):
    from pyspark.sql import functions as F

    for digest in (exact_dedup.text_digest, lambda body: F.unhex(F.lpad(F.hex(F.length(body) % 3), 4, "0"))):
        got = exact_dedup.exact_duplicates(odd, 3, digest).collect()
        rows = [(r["doc_id"], re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "")) for r in odd.collect()]
        size = Counter(b for _, b in rows)
        least = {b: min((i for i, c in rows if c == b and i is not None), default=None) for b in size}
        want = Counter((i, least[b], size[b]) for i, b in rows)
        assert Counter((r["doc_id"], r["keep_id"], r["group_size"]) for r in got) == want
        assert sum(r["kept"] for r in got) == len(size)
    assert exact_dedup.deduplicated(odd).count() == len(size)
    assert exact_dedup.deduplicated(odd).columns == odd.columns


# simhash

def brute_components(prints):
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            if bin((prints[i] ^ prints[j]) & (2**64 - 1)).count("1") <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("block", [2048, 16])
def test_multi_index_links_are_those_of_all_pairs(spark, block):
    rng = random.Random(1)
    prints = []
    for _ in range(6):
        p = rng.getrandbits(64)
        for _ in range(60):
            prints.append(p)
            for b in rng.sample(range(64), rng.choice([0, 1, 2, 3, 4, 5])):
                p ^= 1 << b
    prints = {i: p - (p >> 63 << 64) for i, p in enumerate(dict.fromkeys(prints))}
    df = spark.createDataFrame([(p,) for p in prints.values()], "fp long")
    root = {r["node"]: r["root"] for r in components(simhash.linked(df, block)).collect()}
    want = brute_components(prints)
    groups = defaultdict(set)
    for i, p in prints.items():
        groups[root.get(p, p)].add(i)
    expected = defaultdict(set)
    for i, c in want.items():
        expected[c].add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_fingerprint_definition_and_odd_rows(spark, odd, empty):
    def slow(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        s = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
        h = [xxhash.xxh64(x.encode(), seed=42).intdigest() for x in s]
        p = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0
        return p - (p >> 63 << 64)

    got = simhash.near_duplicates(odd).collect()
    assert Counter((r["doc_id"], r["fp"]) for r in got) == Counter((r["doc_id"], slow(r["text"])) for r in odd.collect())
    comp = brute_components({r["doc_id"]: r["fp"] for r in got if r["doc_id"] is not None})
    assert all(r["component_id"] == comp[r["doc_id"]] for r in got if r["doc_id"] is not None)
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.one_of_each_group(odd).columns == odd.columns


# byte-level BPE

def test_bpe_round_trip(spark, odd, empty):
    tiktoken = pytest.importorskip("tiktoken")
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = bpe.read_ranks(path)
    tool = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = Counter(tuple(r) for r in bpe.round_trip(odd, path).collect())
    want = Counter()
    for r in odd.collect():
        ids = tool.encode_ordinary(r["text"] or "")
        want[r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
             hashlib.sha256((r["text"] or "").encode()).hexdigest()] += 1
    assert got == want
    assert bpe.round_trip(empty, path).count() == 0


def test_bpe_vocabularies_in_which_lower_ranks_come_up():
    tiktoken = pytest.importorskip("tiktoken")
    rng = random.Random(2)
    for _ in range(60):
        ranks = {bytes([b]): b for b in range(256)}
        own = list({bytes(rng.choice(b"abc") for _ in range(rng.randint(2, 4))) for _ in range(14)})
        rng.shuffle(own)
        for token in own:
            ranks[token] = len(ranks)
        tool = tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        pieces = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 30))) for _ in range(40)]
        ids, ends = bpe.replay([p.encode() for p in pieces], bpe.Merges(ranks))
        for piece, start, end in zip(pieces, [0, *ends[:-1]], ends):
            assert ids[start:end].tolist() == tool.encode_ordinary(piece)


# token files

def test_token_files(spark, odd, empty):
    tokenizers = pytest.importorskip("tokenizers")
    path = public_tokenizers.path("word_bpe_49k.json")
    tool = tokenizers.Tokenizer.from_file(path)
    more = frame(spark, ["İ Σ x", "“quote” <|endoftext|> 中文", "é 's 'LL", "x y\x85z"], 100)
    docs = odd.where("doc_id is null or doc_id <> 5").unionByName(more)
    folder = tempfile.mkdtemp()
    manifest = token_files.write_shards(docs, path, folder)
    got = {r["doc_id"]: (r["start"], np.frombuffer(r["ids"], "<u4").tolist()) for r in token_files.read_shards(manifest, folder).collect() if r["doc_id"] is not None}
    rows = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or "") for r in docs.collect()))
    at = 0
    for real, key, text in rows:
        ids = tool.encode(text, add_special_tokens=False).ids + [1]
        if real:
            assert got[key] == (at, ids)
        at += len(ids)
    folder = tempfile.mkdtemp()
    assert token_files.read_shards(token_files.write_shards(empty, path, folder), folder).count() == 0


# decontamination

def brute_windows(docs, items, size):
    find = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
    found = defaultdict(set)
    for i, t in items:
        w = find((t or "").encode().lower())
        for k in range(max(len(w) - size, 0) + 1 if w else 0):
            found[tuple(w[k : k + size])].add("" if i is None else str(i))
    out = Counter()
    for i, t in docs:
        w = find((t or "").encode().lower())
        hit, own = set(), set()
        for n in {len(x) for x in found}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in found:
                    hit.update(range(k, k + n))
                    own |= found[tuple(w[k : k + n])]
        out[i, len(w), len(hit), tuple(sorted(own))] += 1
    return out


@pytest.mark.parametrize("block_words", [10**6, 8, 1])
def test_decontamination(spark, block_words):
    rng = random.Random(5)
    items = [(i, " ".join(rng.choice("abcd") for _ in range(rng.randint(0, 6)))) for i in range(12)] + [(None, "a b c"), (3, None), (3, "d")]
    docs = [(i, " ".join(rng.choice("abcD") for _ in range(rng.randint(0, 40)))) for i in range(150)] + [(None, None), (1, ""), (2, "É" * 9)]
    found = decontaminate.occurrences(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), ["doc_id"], 4, block_words)
    got = Counter((r["row"]["doc_id"], r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), tuple(r["items"])) for r in found.collect())
    assert got == brute_windows(docs, items, 4)


def test_decontamination_cleans_and_cuts(spark, odd, empty):
    bench = spark.createDataFrame([(1, "One two three"), (2, "")], "item_id long, text string")
    docs = frame(spark, ["x, one TWO three! y", "clean é", None])
    assert [r["doc_id"] for r in decontaminate.clean(docs, bench).orderBy("doc_id").collect()] == [1, 2]
    assert [r["text"] for r in decontaminate.cut(docs, bench).orderBy("doc_id").collect()] == ["x, ! y", "clean é", None]
    assert decontaminate.clean(odd, nothing(spark, "item_id long, text string")).count() == odd.count()
    assert decontaminate.clean(empty, bench).count() == 0


def test_fm_index_finds_every_place():
    rng = np.random.default_rng(3)
    text = rng.integers(0, 4, 400)
    text[-1] = 0
    index = FMIndex(text, sample=8)
    for size in (1, 2, 3, 5):
        pattern = rng.integers(1, 4, (30, size))
        first, end = index.search(pattern, np.full(30, size))
        for k in range(30):
            want = [i for i in range(len(text) - size + 1) if (text[i : i + size] == pattern[k]).all()]
            assert sorted(index.locate(np.arange(first[k], max(first[k], end[k]))).tolist()) == want


# language identification

def test_code_lengths_are_those_of_a_complete_code():
    text = "abracadabra alakazam abrakadabra " * 3
    counts = Counter()
    x = language_id.prepared(text)
    for k in range(3, len(x)):
        counts[int.from_bytes(x[k - 3 : k + 1], "big")] += 1
    model = language_id.build([("xx", g, n) for g, n in counts.items()], 1)
    p = np.exp2(-model.costs.reshape(-1, model.width).astype(float))
    p[:, -1] *= 256 - (model.width - 1)
    assert np.allclose(p.sum(axis=1), 1)

    def slow(text):  # the definition, byte by byte
        y, bits = language_id.prepared(text), 0.0
        for k in range(3, len(y)):
            out = set()
            for order in (3, 2, 1, 0):
                c = Counter()
                for g, n in counts.items():
                    b = g.to_bytes(4, "big")
                    if b[3 - order : 3] == y[k - order : k] and b[3] not in out:
                        c[b[3]] += n
                if not c:
                    continue
                if y[k] in c:
                    bits += np.log2((sum(c.values()) + len(c)) / c[y[k]])
                    break
                bits += np.log2((sum(c.values()) + len(c)) / len(c))
                out |= set(c)
            else:
                bits += np.log2(256 - len(out))
        return bits

    for probe in ("abra", "zebra qux", "kazam!"):
        assert np.isclose(model.bits(probe)[0], slow(probe), rtol=1e-5)


def test_language_id(spark, odd, empty):
    texts = ["the cat and the dog went to the house", "der hund und die katze gehen nach haus"] * 40
    docs = frame(spark, texts, 0, {i: ("en", "de")[i % 2] for i in range(len(texts))})
    model = language_id.learn(docs, min_context=2)
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.predict(frame(spark, ["the dog and the house", "die katze und der hund", "12 !", None]), model, ["doc_id"]).collect()}
    assert got == {0: "en", 1: "de", 2: "und", 3: "und"}
    assert language_id.predict(odd, model, odd.columns).count() == odd.count()
    none = language_id.learn(empty)
    assert {r["lang_pred"] for r in language_id.predict(odd, none, ["doc_id"]).collect()} == {"und"}


# toxicity

def test_machine_learns_a_pair(spark):
    """Neither word tells anything alone; the two together are toxic."""
    rng = random.Random(4)
    fill = [f"w{k}" for k in range(30)]
    rows = []
    for i in range(900):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        rows.append((i, " ".join(rng.sample(fill, 5) + ["insult"] * a + ["group"] * b), int(a and b)))
    machine = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string, label int"))
    probe = frame(spark, ["w1 insult group w2", "w1 insult w3", "w4 group w5", "w6 w7", "", None])
    got = {r["doc_id"]: r["score"] for r in toxicity.score(probe, machine, ["doc_id"]).collect()}
    assert got[0] > 0.7 and max(got[k] for k in (1, 2, 3)) < 0.5 and got[4] == got[5]


def test_pair_sum_is_the_double_loop():
    rng = np.random.default_rng(3)
    machine = toxicity.Machine(0.3, np.arange(12), rng.normal(size=12), rng.normal(size=(12, 8)))
    for size in (0, 1, 2, 7, 12):
        slots = rng.choice(12, size, replace=False)
        slow = machine.bias + sum(machine.weights[i] for i in slots) + sum(
            float(machine.vectors[i] @ machine.vectors[j]) for k, i in enumerate(slots) for j in slots[k + 1 :])
        assert abs(machine.raw(slots) - slow) < 1e-9


def test_toxicity_odd_rows(spark, odd, empty):
    for labelled in ("doc_id long, text string, label int",):
        none = toxicity.fit(spark.createDataFrame([], labelled))
        one = toxicity.fit(spark.createDataFrame([(1, "x", 0), (None, None, None)], labelled))
    scores = [r["score"] for r in toxicity.score(odd, none, odd.columns).collect()]
    assert set(scores) == {0.5} and len(scores) == odd.count()
    assert {r["predicted"] for r in toxicity.score(odd, one, ["doc_id"]).collect()} == {0}


# quality

def test_kneser_ney_sums_to_one(spark):
    rng = random.Random(6)
    ids = [rng.choice([0, 1, 2, 3, 1, 1]) for _ in range(200)]
    keys, n = np.unique(quality.trigrams(np.array(ids), 5), return_counts=True)
    counts = spark.createDataFrame(list(zip(keys.tolist(), n.tolist())), "key long, c long")
    asked = [(u << 40) | (v << 20) | w for u, v in ((0, 1), (1, 1), (2, 3), (5, 5)) for w in range(5)]
    got = {r["key"]: r["bits"] for r in quality.with_bits(spark.createDataFrame([(k,) for k in asked], "key long"), counts, 4).collect()}
    for start in range(0, len(asked), 5):
        p = sum(2 ** -(got[k] - (20 if k & 0xFFFFF == 0 else 0)) for k in asked[start : start + 5])
        assert abs(p - 1) < 1e-4


def test_vocabulary_is_exact(spark):
    rng = random.Random(7)
    texts = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(30)) for _ in range(40)]
    count = Counter(w for t in texts for w in t.split())
    words, number = quality.vocabulary(frame(spark, texts).repartition(5), 0.05)
    assert number == sum(count.values())
    assert words == sorted(w for w, n in count.items() if n >= 0.05 * number)


def test_quality(spark, odd, empty):
    rng = random.Random(8)
    good = [" ".join(rng.choice(["the", "of", "and", "cat", "dog", "house", f"x{k % 7}"]) for _ in range(60)) for k in range(80)]
    junk = [" ".join(f"q{rng.random()}" for _ in range(60)) for _ in range(5)]
    docs = frame(spark, good + junk + ["", None])
    labels = spark.createDataFrame([(i, 1) for i in range(60)] + [(None, 1), (3, 1), (80, 0)], "doc_id long, quality int")
    got = {r["doc_id"]: r["accepted"] for r in quality.assessed(docs, labels, share=0.01, shard_words=500).collect()}
    assert not any(got[i] for i in range(80, 85)) and sum(got[i] for i in range(80)) >= 76 and got[85] and got[86]
    kept = quality.accepted(odd, labels)
    assert kept.columns == odd.columns and kept.where("doc_id is null").count() == 2
    assert quality.accepted(empty, labels).count() == 0
    assert quality.accepted(odd, nothing(spark, "doc_id long, quality int")).count() == odd.count()


def test_every_trusted_word_is_known(spark):
    """30,000 words, none of which is common: documents of words that trusted text has cost less than others in every language."""
    rng = random.Random(11)
    own = {"en": [f"w{k}" for k in range(27_000)], "fi": [f"s{k}" for k in range(3_000)]}
    texts, langs = [], {}
    for lang, n in (("en", 90), ("fi", 10)):
        for _ in range(n):
            langs[len(texts)] = lang
            texts.append(" ".join(rng.sample(own[lang], 1_500)))
    for lang in ("en", "fi"):
        for known in (True, False):
            langs[len(texts)] = lang
            texts.append(" ".join(w if known else "no" + w for w in rng.sample(own[lang], 1_500)))
    labels = spark.createDataFrame([(i, 1) for i in range(100)], "doc_id long, quality int")
    got = {r["doc_id"]: r["total_bits"] / r["n_words"] for r in quality.scored(frame(spark, texts, langs=langs), labels, shard_words=20_000).collect()}
    assert len(got) == 104
    assert got[100] + 3 < got[101] and got[102] + 3 < got[103]


def test_plain_units_are_split_at_once():
    """The pattern runs once over all units without white space; ids are those of units split on their own."""
    merges = bpe.Merges(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    split, pieces_of = bpe.units(regex.compile(public_tokenizers.PATTERN).findall)
    texts = ["the cat's 1234 ... don't", "", "  two  spaces", "tab\tand\nline  end \n", "x\u00a0y z\u0085w \u2003q", "a \x1cb c\x1f d", "'s 're 12ab \u0661\u0662\u0663\u0664 \u00e9t\u00e9"]
    fresh = list(dict.fromkeys(u for t in texts for u in split(t)))
    calls = []
    ids, ends = bpe.encode_units(fresh, lambda u: calls.append(u) or pieces_of(u), merges)
    assert len(calls) < len(fresh)
    for unit, own in zip(fresh, np.split(ids, ends[:-1])):
        assert own.tolist() == [i for p in pieces_of(unit) for i in merges.one(p.encode())]


def test_waves_make_one_model(spark, tmp_path, monkeypatch):
    """Bits by waves equal those of one model of all counts, and only the results of the waves stay on disk."""
    monkeypatch.setattr(quality, "WAVE_BYTES", 1_000)
    monkeypatch.setattr(quality, "BLOCK_WORDS", 300)
    rng = random.Random(21)
    texts = [" ".join(f"w{min(int(rng.expovariate(0.02)), 400)}" for _ in range(rng.randrange(60))) for _ in range(120)] * 2
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(200)], "doc_id long, quality int")
    before = {t.name for t in spark.catalog.listTables()}
    root = str(tmp_path)
    monkeypatch.setattr(quality, "scratch_path", lambda spark, label: f"{root}/{label}")
    monkeypatch.setattr("atlasweave.llm.stored.scratch_path", lambda spark, label: f"{root}/{label}")
    rows = quality.scored(frame(spark, texts).repartition(3), labels).collect()
    assert {t.name for t in spark.catalog.listTables()} == before
    assert sum(1 for r in rows if r["trusted"] and not r["held"]) > 80
    assert set(p.name for p in tmp_path.iterdir()) == {"quality-shards"}
    counts: dict = {}
    mine = {i: np.array([quality.word_id(w) for w in t.split()], np.uint64) for i, t in enumerate(texts)}
    for r in rows:
        if r["trusted"] and not r["held"]:
            x = np.concatenate([np.full(2, quality.BEGIN, np.uint64), mine[r["doc_id"]]])
            for gram in zip(*(x[k : len(x) - 2 + k].view(np.int64).tolist() for k in range(3))):
                counts[gram] = counts.get(gram, 0) + 1
    known, total, even = quality.model(spark.createDataFrame([(*g, c) for g, c in counts.items()], "a long, b long, w long, c long").cache())
    known = known.toArrow()
    for r in rows:
        x = np.concatenate([np.full(2, quality.BEGIN, np.uint64), mine[r["doc_id"]]])
        bits = quality.code_lengths(x[:-2], x[1:-1], x[2:], known, total, even).sum()
        assert r["n_words"] == len(x) - 2 and abs(r["total_bits"] - bits) < 1e-3 * (1 + bits)


def test_shards_and_ranges_follow_the_text(spark, monkeypatch):
    """However many partitions a session has, little text makes few shards, each of which asks few ranges of keys."""
    answered, made = quality._answered, []

    def counted(rows, known, parts, *rest):
        made.append(rows.count() * parts)
        answered(rows, known, parts, *rest)

    monkeypatch.setattr(quality, "_answered", counted)
    texts = [f"the cat and dog {k % 7} of house {k % 5}" for k in range(600)]  # counts beyond one byte
    labels = spark.createDataFrame([(i, 1) for i in range(580)], "doc_id long, quality int")
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 40)
    try:
        rows = quality.scored(frame(spark, texts).repartition(20), labels).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    assert sorted(r["doc_id"] for r in rows) == list(range(600)) and sum(made) <= 4 and max(r["total_bits"] / r["n_words"] for r in rows) < 3


def test_threshold_is_no_maximum(spark, monkeypatch):
    """One bad label in two hundred does not set a threshold, nor does the only held-out document of a language."""
    kind = "doc_id long, lang string, n_words long, trusted boolean, held boolean, total_bits double"
    rng = random.Random(12)
    bits = [rng.gauss(10, 0.5) for _ in range(400)] + [30.0, 30.0]
    rows = [(k, "en", 1000, True, True, 1000 * x) for k, x in enumerate(bits)]
    rows += [(1000, "fi", 1000, True, True, 12_000.0), (1001, "fi", 1000, False, False, 12_300.0), (1002, "fi", 1000, False, False, 20_000.0)]
    monkeypatch.setattr(quality, "scored", lambda docs, labels: spark.createDataFrame(rows, kind))
    got = {r["doc_id"]: r["accepted"] for r in quality.assessed(None, None).collect()}
    assert sum(got[k] for k in range(400)) >= 394 and not got[400] and not got[401]
    assert got[1000] and got[1001] and not got[1002]


# passages

def test_compact_windows_are_those_of_the_definition():
    rng = np.random.default_rng(0)
    for least in (3, 5, 8):
        for n in (0, 2, 7, 40, 90):
            v = rng.integers(1, 30, n).astype(np.uint64)
            want = set()
            for c in range(n):
                lo, hi = c, c
                while lo > 0 and v[lo - 1] >= v[c]:
                    lo -= 1
                while hi < n - 1 and v[hi + 1] >= v[c]:
                    hi += 1
                if hi - lo + 1 >= least and not (v[lo:c] == v[c]).any():
                    want.add((c, lo, hi))
            assert set(zip(*[x.tolist() for x in passages.compact_windows(v, least)])) == want


def test_passages(spark, odd, empty):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    fresh = lambda n: [word() for _ in range(n)]
    shared, other, short = fresh(60), fresh(90), fresh(30)
    near = [*other[:45], word(), *other[46:]]  # one word of ninety is another
    docs = [fresh(40) + shared + fresh(50), fresh(10) + shared, shared + fresh(200), other + fresh(30), fresh(70) + near,
            fresh(80) + short, short + fresh(80), fresh(150), fresh(120)]
    got = {r["doc_id"]: r for r in passages.repeated_passages(frame(spark, [" ".join(d) for d in docs])).collect()}
    assert set(got) == {0, 1, 2, 3, 4}
    assert {got[i]["class_id"] for i in (0, 1, 2)} == {0} and {got[i]["class_id"] for i in (3, 4)} == {3}
    assert [tuple(s) for s in got[0]["spans"]] == [(40, 100)] and [tuple(s) for s in got[1]["spans"]] == [(10, 70)]
    assert passages.repeated_passages(odd).count() == 0
    assert passages.repeated_passages(empty).count() == 0


def test_passages_with_wide_gaps_and_edits_near_an_end():
    shingles = lambda words: passages.Tokens()(" ".join(words).encode())
    fresh = lambda n, name: [f"{name}{k}" for k in range(n)]
    own = fresh(80, "p")
    a = shingles(fresh(30, "a") + own + fresh(30, "b"))
    b = shingles(fresh(20, "c") + own[:40] + fresh(7, "new") + own[40:] + fresh(20, "d"))
    assert passages.repeated(a, b, 46) == [(30, 106, 20, 103)] and passages.repeated(b, a, 46) == [(20, 103, 30, 106)]
    own = fresh(52, "q")
    a, b = shingles(own), shingles([*own[:2], "other", *own[3:]])
    assert len(passages.repeated(a, b, 46)) == 1 and len(passages.repeated(b, a, 46)) == 1
    a, b = (shingles(fresh(30, x) + own[:40] + fresh(30, y)) for x, y in ("ef", "gh"))  # 36 of 56 at best
    assert passages.repeated(a, b, 46) == []


@pytest.mark.parametrize("share", [0.0, 0.04, 0.08])
def test_near_passages_are_found(share):
    """Of passages of 60 to 150 words with edited words, those that stay similar enough are found, and only similar ones reported."""
    rng = random.Random(int(share * 100))
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    shingles = passages.Tokens()
    due = caught = 0
    for _ in range(150):
        own = [word() for _ in range(rng.randint(60, 150))]
        other = []
        for w in own:
            edit = rng.random() < share / 5  # an edit costs five shingles
            other += [] if edit and rng.random() < 0.3 else [word()] if edit else [w]
        pad = lambda: [word() for _ in range(rng.randint(0, 80))]
        a, b = (shingles(" ".join(x).encode()) for x in (pad() + own + pad(), pad() + other + pad()))
        got = passages.repeated(a, b, 46)
        x, y = (set(shingles(" ".join(w).encode()).tolist()) for w in (own, other))
        if len(x & y) >= 0.8 * len(x | y) and len(own) >= 60 <= len(other):
            due += 1
            caught += bool(got)
        for s, e, u, v in got:
            x, y = set(a[s:e].tolist()), set(b[u:v].tolist())
            assert e - s >= 46 <= v - u and len(x & y) >= 0.8 * len(x | y)
    assert due > 20 and caught >= 0.98 * due


def test_passages_in_other_places_and_of_words_that_recur():
    fresh = lambda n, name: [f"{name}{k}" for k in range(n)]
    shingles = passages.Tokens()
    p, q, loop = fresh(60, "p"), fresh(70, "q"), ["x", "y"] * 40
    a = shingles(" ".join(p + q + fresh(9, "a")).encode())
    b = shingles(" ".join(q + fresh(300, "b") + p).encode())
    assert len(passages.repeated(a, b, 46)) == 2 and len(passages.repeated(b, a, 46)) == 2
    a, b = (shingles(" ".join(fresh(40, n) + loop + fresh(40, n + "z")).encode()) for n in "cd")
    for s, e, u, v in passages.repeated(a, b, 46):
        x, y = set(a[s:e].tolist()), set(b[u:v].tolist())
        assert len(x & y) >= 0.8 * len(x | y)


def test_a_passage_in_the_second_row_of_a_doc_id(spark):
    fresh = lambda n, name: [f"{name}{k}" for k in range(n)]
    shared = fresh(60, "s")
    rows = [(1, " ".join(fresh(30, "a") + shared)), (2, " ".join(fresh(90, "b"))), (2, " ".join(shared + fresh(40, "c")))]
    got = {r["doc_id"]: r["class_id"] for r in passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 1}


def test_passages_are_verified_in_waves(spark, monkeypatch):
    """A job sends the stretches of its share of the pairs; together they find what one job finds."""
    rng = random.Random(5)
    shared = [[f"s{k}w{i}" for i in range(60)] for k in range(6)]
    rows = [(i, " ".join([f"d{i}x{rng.random()}" for _ in range(20)] + shared[i % 6])) for i in range(18)]
    docs, sizes, verified = spark.createDataFrame(rows, "doc_id long, text string"), [], passages.verified

    def counted(docs, found, *rest):
        sizes.append(found.count())
        return verified(docs, found, *rest)

    monkeypatch.setattr(passages, "verified", counted)
    whole = sorted((r["doc_id"], r["class_id"], r["links"], r["repeated_words"]) for r in passages.repeated_passages(docs).collect())
    monkeypatch.setattr(passages, "WAVE_PAIRS", 5)
    parts = sorted((r["doc_id"], r["class_id"], r["links"], r["repeated_words"]) for r in passages.repeated_passages(docs).collect())
    assert whole == parts and len(whole) == 18
    assert len(sizes) > 2 and sum(sizes[1:]) == sizes[0] and max(sizes[1:]) < sizes[0]


def test_passages_around_a_popular_phrase(spark):
    """Of three documents with a phrase of 40 words the last two share 50 around it: any one hash function finds them, whatever the first has."""
    fresh = lambda n, name: [f"{name}{k}" for k in range(n)]
    rows = []
    for t in range(60):
        phrase = fresh(40, f"p{t}x")
        wide = fresh(t % 11, f"q{t}x") + phrase + fresh(10 - t % 11, f"r{t}x")
        for k, own in enumerate((phrase, wide, wide)):
            rows.append((3 * t + k, " ".join(fresh(60, f"a{t}x{k}x") + own + fresh(60, f"z{t}x{k}x"))))
    found = passages.candidates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 50, hashes=1, enough=1)
    assert {(3 * t + 1, 3 * t + 2) for t in range(60)} <= {(r["a"], r["b"]) for r in found.collect()}


def test_passages_beside_one_with_a_gap(spark):
    """Of three documents two share 50 words; the third has them around seven others, too far apart for a passage, and stands for neither."""
    fresh = lambda n, name: [f"{name}{k}" for k in range(n)]
    rows = []
    for t in range(60):
        own = fresh(50, f"p{t}x")
        for k, part in enumerate((own[:25] + fresh(7, f"g{t}x") + own[25:], own, own)):
            rows.append((3 * t + k, " ".join(fresh(60, f"a{t}x{k}x") + part + fresh(60, f"z{t}x{k}x"))))
    found = passages.candidates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 50, hashes=1, enough=1)
    assert {(3 * t + 1, 3 * t + 2) for t in range(60)} <= {(r["a"], r["b"]) for r in found.collect()}


@pytest.mark.parametrize("rows_per_task", [1, 4])
def test_every_place_of_a_passage_is_found(spark, rows_per_task):
    """A document that has another's passage twice has two spans, whichever of the two comes first."""
    fresh = lambda n, name: [f"{name}{k}" for k in range(n)]
    rows, want = [], {}
    for t, size in enumerate((50, 120)):
        for k, (twice, once) in enumerate(((0, 1), (1, 0))):
            doc = 4 * t + 2 * k
            own = fresh(size, f"p{doc}x")
            text = fresh(30, f"a{doc}x") + own + fresh(150, f"b{doc}x") + own + fresh(40, f"c{doc}x")
            rows += [(doc + twice, " ".join(text)), (doc + once, " ".join(fresh(20, f"d{doc}x") + own + fresh(30, f"e{doc}x")))]
            want |= {doc + twice: [(30, 30 + size), (180 + size, 180 + 2 * size)], doc + once: [(20, 20 + size)]}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8 // rows_per_task)
    assert {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in passages.repeated_passages(docs).collect()} == want


def test_windows_of_a_signature_in_several_batches():
    rows = [(k, n, d, 5, 0, 50) for k, n, d in ((1, 1, 1), (2, 1, 1), (2, 1, 2), (2, 5, 3), (2, 7, 4), (2, 7, 5), (3, 1, 1), (3, 1, 2), (4, 1, 1), (4, 2, 2))]
    want_pairs = {(2, 1, 2), (2, 4, 5), (3, 1, 2)}
    for size in range(1, 11):
        batches = [passages._batch(np.array(rows[i : i + size], np.int64)) for i in range(0, 10, size)]
        out = [r for b in passages._joined(iter(batches)) for r in b.to_pylist()]
        assert {(r["key"], r["doc"], r["doc2"]) for r in out if r["doc2"] is not None} == want_pairs
        assert sorted((r["key"], r["doc"]) for r in out if r["doc2"] is None) == [(2, 1), (2, 3), (2, 4), (4, 1), (4, 2)]


# licenses

def test_patience_alignment():
    assert licenses.rising([3, 1, 2, 5, 4]) in ([1, 2, 3], [1, 2, 4])
    a, b = [1, 2, 3, 4, 5, 1], [9, 1, 2, 8, 3, 5, 4, 1]
    pairs = licenses.aligned(a, b)
    assert all(a[i] == b[j] for i, j in pairs) and len(pairs) == 5
    assert all(i < k and j < m for (i, j), (k, m) in zip(pairs, pairs[1:]))


def test_gaps_without_anchors_are_aligned_exactly_at_any_size(monkeypatch):
    def longest(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        return row[-1]

    rng = random.Random(14)
    for table in (1, 30, 40_000):
        monkeypatch.setattr(licenses, "TABLE", table)
        for n, m in ((0, 5), (1, 9), (12, 30), (60, 45), (220, 230)):
            a, b = [rng.randrange(5) for _ in range(n)], [rng.randrange(5) for _ in range(m)]
            pairs = licenses._common(a, b)
            assert len(pairs) == longest(a, b) and all(a[i] == b[j] for i, j in pairs)
            assert all(i < k and j < l for (i, j), (k, l) in zip(pairs, pairs[1:]))


def test_licenses(spark, odd, empty):
    mit = next(t for n, t in licenses.TEMPLATES if n == "MIT" and len(t) > 200)
    worn = " ".join(w for k, w in enumerate(mit.split()) if k % 11)
    texts = ["x y. Released under the MIT License.", "the the " + worn + " tail", "Licensed under the License of nobody", None,
             "Licensed under CC BY-NC 4.0.\nAll rights reserved.", "All rights reserved. " * 50 + mit]
    got = {r["doc_id"]: r for r in licenses.scanned(frame(spark, texts), ["doc_id"]).collect()}
    assert [got[i]["license"] for i in range(6)] == ["MIT", "MIT", None, None, "CC-BY-NC-4.0", "MIT"]
    assert 0.8 <= got[1]["coverage"] < 1 and got[4]["licenses"] == ["CC-BY-NC-4.0", "proprietary"]
    assert (got[0]["first_word"], got[0]["end_word"]) == (2, 7)
    assert licenses.scanned(odd, odd.columns).count() == odd.count() and licenses.scanned(empty, ["doc_id"]).count() == 0


# components and pipeline

def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{k: 100 for k in range(101, 160)}}


def test_pipeline_against_brute_force(spark, tmp_path):
    rng = random.Random(10)
    base = [" ".join(rng.choice(["the", "of", "and", "cat", "dog", "house", "tree", "road"]) for _ in range(80)) for _ in range(60)]
    texts = base + base[:4] + [base[5] + " end"] + [" ".join(f"q{rng.random()}" for _ in range(60))] + ["", None]
    docs = frame(spark, texts)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1) for i in range(50)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    bench = " ".join(base[7].split()[20:32])
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    ok = {r["doc_id"] for r in quality.accepted(docs, spark.read.parquet(f"{tmp_path}/labels.parquet")).collect()}
    first = {}
    for i in sorted(ok):
        first.setdefault(re.sub(r"\s+", " ", rows[i] or ""), i)
    kept = sorted(first.values())
    comp = brute_components({i: simhash.fingerprint((rows[i] or "").encode()) for i in kept})
    kept = [i for i in kept if comp[i] == i]
    clean = {i for (i, _, hit, _) in brute_windows([(i, rows[i]) for i in kept], [(1, bench)], 10) if not hit}
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(got) == clean and 7 not in clean
    assert all(got[i]["decoded_sha256"] == hashlib.sha256((rows[i] or "").encode()).hexdigest() for i in clean)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns


