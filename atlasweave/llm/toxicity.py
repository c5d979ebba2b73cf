"""Toxicity by a factorization machine over hashed terms.

A text is the set of hash buckets of its words. Its score is the logistic function of
a bias, a weight per bucket, and for every pair of buckets the inner product of their
latent vectors, summed in one pass as half of (sum of vectors) squared less the sum of
squares. So a pair, such as an insult together with a group mention, can count for
more than its two terms.

The machine is fitted on a bounded sample of labelled rows (``sample_rows`` of each
label, about, picked by a hash of doc_id). Buckets are chosen (``features`` at most)
whose counts by label lie ``least_gain`` standard deviations from chance, and with them
the most common ones, which can matter in pairs. Fitting is data-parallel: in
each round every part of the sample, held by one task, improves the weights it is
given, and the driver averages what the parts return, whose size is fixed.

Scoring reads every whole text and uses nothing else of a row.

Defined cases: null and empty texts have no terms and score the bias; so does every
text where no label could be learned from (bias 0 where there is none at all); a null
doc_id is not held out and not learned from; rows labelled twice count twice; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from atlasweave.llm.catalog import query, table
from atlasweave.llm.language_id import remainder, sampled
from atlasweave.llm.stored import stored

BUCKETS = 1 << 20
FACTORS = 8
PARTS = 6
TOXIC_AT = 0.7
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


class Terms:
    """Buckets of the words of texts; words met before are looked up."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def __call__(self, text: bytes | None) -> set[int]:
        if len(self.known) > 1_000_000:
            self.known.clear()
        known = self.known
        out = set()
        for word in set(text.translate(_WORDS).split()) if text else ():
            bucket = known.get(word)
            if bucket is None:
                known[word] = bucket = xxh64_intdigest(word) % BUCKETS
            out.add(bucket)
        return out


@dataclass
class Machine:
    """bias, buckets (sorted), weights, vectors (bucket, factor)."""

    bias: float
    buckets: np.ndarray
    weights: np.ndarray
    vectors: np.ndarray

    def raw(self, slots: np.ndarray) -> float:
        """Log-odds of a text with the features in ``slots``."""
        if not len(slots):
            return self.bias
        own = self.vectors[slots]
        total = own.sum(axis=0)
        return float(self.bias + self.weights[slots].sum() + 0.5 * (total @ total - (own * own).sum()))


def improved(machine: Machine, rows: list[np.ndarray], labels: np.ndarray, rng: np.random.Generator,
             epochs: int = 6, batch: int = 32, rate: float = 0.25, decay: float = 1e-4) -> Machine:
    """``machine`` after some epochs of adaptive gradient steps over ``rows`` of feature slots."""
    bias, w, v = machine.bias, machine.weights.copy(), machine.vectors.copy()
    seen_bias, seen_w, seen_v = 1e-2, np.full(w.shape, 1e-2), np.full(v.shape, 1e-2)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), batch):
            part = order[at : at + batch]
            sizes = np.array([len(rows[i]) for i in part])
            slots = np.concatenate([rows[i] for i in part])
            owner = np.repeat(np.arange(len(part)), sizes)
            own = v[slots]
            total = np.zeros((len(part), v.shape[1]))
            np.add.at(total, owner, own)
            z = bias + np.bincount(owner, w[slots], len(part)) + 0.5 * (
                (total**2).sum(axis=1) - np.bincount(owner, (own**2).sum(axis=1), len(part)))
            slope = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[part]) / len(part)
            names, back = np.unique(slots, return_inverse=True)
            grad_w = np.bincount(back, slope[owner], len(names)) + decay * w[names]
            grad_v = decay * v[names]
            np.add.at(grad_v, back, slope[owner, None] * (total[owner] - own))
            seen_bias += slope.sum() ** 2
            seen_w[names] += grad_w**2
            seen_v[names] += grad_v**2
            bias -= rate * slope.sum() / np.sqrt(seen_bias)
            w[names] -= rate * grad_w / np.sqrt(seen_w[names])
            v[names] -= rate * grad_v / np.sqrt(seen_v[names])
    return Machine(float(bias), machine.buckets, w, v)


def _slots(terms: set[int], buckets: np.ndarray) -> np.ndarray:
    own = np.fromiter(terms, np.int64, len(terms))
    at = np.searchsorted(buckets, own)
    at[at == len(buckets)] = 0
    return at[buckets[at] == own] if len(buckets) else at[:0]


def fit(labelled: DataFrame, sample_rows: int = 6000, features: int = 4096, least_docs: int = 5,
        least_gain: float = 4.0, rounds: int = 8) -> Machine:
    """A machine from rows (doc_id, text, label 0 or 1)."""
    spark = labelled.sparkSession
    rows = labelled.where("label IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "text", F.col("label").cast("int").alias("label"))
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).where("label IN (0, 1)").collect()}
    if len(counts) < 2:  # nothing to tell apart
        return Machine(4.0 if 1 in counts else -4.0 if 0 in counts else 0.0, np.empty(0, np.int64), np.empty(0), np.empty((0, FACTORS)))

    def terms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                own = [sorted(terms(t.as_py())) for t in part.column(2)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(own, pa.list_(pa.int64()))], ["part", "label", "terms"])

    sample = sampled(rows.where("label IN (0, 1)"), "label", sample_rows, 4)
    part = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(PARTS)).cast("int")
    sample = stored(sample.select(part.alias("part"), "label", F.col("text").cast("binary").alias("text")).mapInArrow(
        terms_of, "part int, label int, terms array<long>"), "toxicity-sample")
    total = sample.agg(F.sum(F.lit(1.0)).alias("n"), F.sum("label").alias("y")).first()
    n, y = total["n"] or 0.0, float(total["y"] or 0)
    share = y / n if n else 0.5
    tells = sample.select("label", F.explode("terms").alias("term")).groupBy("term").agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("y")).where(F.col("n") >= least_docs)
    gain = F.abs(F.col("y") - F.col("n") * share) / F.sqrt(F.col("n") * max(share * (1 - share), 1e-9))
    telling = tells.where(gain >= least_gain).orderBy(gain.desc(), "term").limit(features).select("term")
    common = tells.orderBy(F.col("n").desc(), "term").limit(min(features // 8, int(n // 20))).select("term")
    chosen = {r["term"] for r in telling.union(common).collect()}
    buckets = np.array(sorted(chosen), np.int64)
    rng = np.random.default_rng(7)
    machine = Machine(0.0, buckets, np.zeros(len(buckets)), rng.normal(0, 0.01, (len(buckets), FACTORS)))
    for turn in range(rounds):
        shipped = (machine.bias, machine.buckets, machine.weights, machine.vectors)

        def step(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
            now = Machine(*shipped)
            rows = [_slots(set(t), now.buckets) for t in frame["terms"]]
            new = improved(now, rows, frame["label"].to_numpy(float), np.random.default_rng([turn, int(key[0])]))
            flat = np.concatenate([[new.bias], new.weights, new.vectors.ravel()])
            return pd.DataFrame({"n": [len(frame)], "flat": [flat.tolist()]})

        got = sample.groupBy("part").applyInPandas(step, "n long, flat array<double>").collect()  # PARTS rows of fixed size
        if not got:
            break
        flat = np.average([r["flat"] for r in got], axis=0, weights=[r["n"] for r in got])
        size = len(buckets)
        machine = Machine(float(flat[0]), buckets, flat[1 : 1 + size], flat[1 + size :].reshape(size, FACTORS))
    return machine


def score(docs: DataFrame, machine: Machine, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of every row of ``docs``, with score and predicted."""
    shipped = docs.sparkSession.sparkContext.broadcast((machine.bias, machine.buckets, machine.weights, machine.vectors))
    width = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, terms = Machine(*shipped.value), Terms()
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                raw = np.array([machine.raw(_slots(terms(t.as_py()), machine.buckets)) for t in part.column(width)])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:width], pa.array(1 / (1 + np.exp(-np.clip(raw, -500, 500))))], [*keep, "score"])

    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("score", T.DoubleType())])
    return docs.select(*keep, F.col("text").cast("binary").alias("__text")).mapInArrow(run, schema).withColumn(
        "predicted", (F.col("score") >= TOXIC_AT).cast("int"))


@query("op4_toxicity")
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from labelled ones that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    learned = docs.where(remainder(F.col("doc_id"), 3) != 1).join(
        labels.select(F.col("doc_id").alias("__id"), F.col("toxic").alias("label")), F.col("doc_id") == F.col("__id"))
    machine = fit(learned.select("doc_id", "text", "label"))
    out = F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    return score(docs, machine, ["doc_id"]).select("doc_id", out.alias("held_out"), "score", "predicted")
