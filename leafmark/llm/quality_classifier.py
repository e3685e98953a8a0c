"""Quality classifier on supervised subword embeddings.

Every word and every character n-gram inside a word is hashed to a learned vector.  A document is the mean of its word
vectors plus the mean of its n-gram vectors; a softmax layer gives the class.  Numpy stochastic gradient descent trains all
three tables in one task on a sample of bounded size.  As the output is linear in the vectors, scoring folds the softmax
weights into one number a bucket: a pass over the bytes, no shuffle, 3 x BUCKETS floats broadcast.

A word that repeats the word before it falls to one shared bucket, whatever the word: runs of one word are a feature.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytetext as B
from . import scratch

BUCKETS = 1 << 16
DIM = 8
NGRAMS = (2, 3)
#: The most labelled rows that training takes, by order of a hash of their ids.
SAMPLE = 6000
EPOCHS = 12
RATE = 2.0
_REPEAT = 0


@dataclass
class Model:
    """``word`` and ``gram``: what a bucket adds to the log-odds of class 1; ``bias``: the log-odds without any."""

    word: np.ndarray
    gram: np.ndarray
    bias: float


def _word_buckets(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    s, e, doc = B.words(buf, offsets)
    h = B.span_hash(B.prefix(buf), s, e)
    bucket = 1 + (h % B.U(BUCKETS - 1)).astype(np.int64)
    again = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    bucket[1:][again] = _REPEAT
    return bucket, doc


def _gram_buckets(points: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the character n-grams (code points, so no character is cut), and where one lies in one document without white
    space inside; it may begin or end with one."""
    m = len(points) - size + 1
    if m <= 0:
        return np.zeros(0, np.int32), np.zeros(0, bool)
    x = np.full(m, 0x9747B28C + size, np.uint32)
    space = (points == 32) | ((points >= 9) & (points <= 13))
    flat = np.where(space, np.uint32(32), points)
    with np.errstate(over="ignore"):
        for k in range(size):
            x = (x ^ flat[k : m + k]) * np.uint32(0x01000193)
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x2C1B3C6D)
        x ^= x >> np.uint32(13)
    good = np.ones(m, bool)
    for k in range(1, size - 1):
        good &= ~space[k : m + k]
    good &= ~(space[:m] & space[size - 1 :])
    cuts = offsets[1:-1]
    for k in range(1, size):
        at = cuts - k
        good[at[(at >= 0) & (at < m)]] = False
    return (x & np.uint32(BUCKETS - 1)).astype(np.int32), good


def _means(values: np.ndarray, doc: np.ndarray, docs: int, weight: np.ndarray | None = None) -> np.ndarray:
    total = np.bincount(doc, weights=values, minlength=docs)
    number = np.bincount(doc, weights=weight, minlength=docs)
    return total / np.maximum(number, 1)


def score_chunk(model: Model, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    docs = len(offsets) - 1
    bucket, doc = _word_buckets(buf, offsets)
    z = model.bias + _means(model.word[bucket], doc, docs)
    total, number = np.zeros(docs), np.zeros(docs)
    points, at = B.characters(buf, offsets)
    some = np.flatnonzero(np.diff(at) > 0)
    edges = at[:-1]
    for size in NGRAMS:
        gram, good = _gram_buckets(points, at, size)
        if not len(gram):
            continue
        value = np.zeros(len(points), np.float32)
        value[: len(gram)] = np.where(good, model.gram[gram], np.float32(0))
        there = np.zeros(len(points), np.int32)
        there[: len(good)] = good
        if len(some):
            total[some] += np.add.reduceat(value, edges[some], dtype=np.float64)
            number[some] += np.add.reduceat(there, edges[some])
    return 1 / (1 + np.exp(-np.clip(z + total / np.maximum(number, 1), -30, 30)))


def train(texts: pa.Array, labels: np.ndarray, seed: int = 1) -> Model:
    """Numpy SGD, one document a step.  A constant prior where only one class is there, or nothing."""
    labels = np.asarray(labels, np.int64)
    share = (labels.sum() + 1) / (len(labels) + 2)
    prior = float(np.log(share / (1 - share)))
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros(BUCKETS, np.float32), np.zeros(BUCKETS, np.float32), prior)
    examples: list[tuple] = []
    for _, _, buf, offsets in B.chunks(texts):
        bucket, doc = _word_buckets(buf, offsets)
        points, at = B.characters(buf, offsets)
        grams = [_gram_buckets(points, at, n) for n in NGRAMS]
        for i in range(len(offsets) - 1):
            lo, hi = np.searchsorted(doc, (i, i + 1))
            w, wn = np.unique(bucket[lo:hi], return_counts=True)
            g = np.concatenate([g[at[i] : at[i + 1]][ok[at[i] : at[i + 1]]] for g, ok in grams])
            g, gn = np.unique(g, return_counts=True)
            examples.append((w, (wn / max(wn.sum(), 1)).astype(np.float32), g, (gn / max(gn.sum(), 1)).astype(np.float32)))
    random = np.random.default_rng(seed)
    word = random.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    gram = random.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    out, bias = np.zeros((2, DIM), np.float32), np.array([0, prior], np.float32)
    steps = EPOCHS * len(examples)
    for step, i in enumerate(np.concatenate([random.permutation(len(examples)) for _ in range(EPOCHS)])):
        w, wn, g, gn = examples[i]
        hidden = wn @ word[w] + gn @ gram[g]
        logit = out @ hidden + bias
        p = np.exp(logit - logit.max())
        p /= p.sum()
        p[labels[i]] -= 1
        rate = np.float32(RATE * (1 - step / steps))
        back = p @ out
        out -= 0.1 * rate * np.outer(p, hidden)
        bias -= 0.05 * rate * p
        word[w] -= rate * wn[:, None] * back
        gram[g] -= rate * gn[:, None] * back
    turn = out[1] - out[0]
    return Model((word @ turn).astype(np.float32), (gram @ turn).astype(np.float32), float(bias[1] - bias[0]))


def _trainer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tables = list(batches)
    texts = pa.concat_arrays([b.column(1) for b in tables]) if tables else pa.array([], pa.string())
    ids = np.concatenate([b.column(0).to_numpy(zero_copy_only=False) for b in tables]) if tables else np.zeros(0)
    labels = np.concatenate([b.column(2).to_numpy(zero_copy_only=False) for b in tables]) if tables else np.zeros(0)
    order = np.argsort(ids, kind="stable")
    model = train(texts.take(pa.array(order)), labels[order])
    yield pa.RecordBatch.from_arrays([pa.array([model.word.tobytes()]), pa.array([model.gram.tobytes()]), pa.array([model.bias])], ["word", "gram", "bias"])


def held_out(doc_id):
    """crc32 of the id as text, modulo 5, is 0: never learnt from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learns ``labels`` (doc_id, quality 0/1) from the texts of ``docs``.

    At most ``sample`` labelled rows, of those that are not held out, are taken in the order of a hash of their ids; that list
    has a fixed bound and is broadcast, the texts stay where they are but for the sample.  Rows without id, text or label are
    passed over; an id with two labels counts with the smaller.
    """
    known = labels.where("doc_id is not null AND quality in (0, 1)").where(~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").alias("__id")).agg(F.min("quality").cast("long").alias("__label"))
    known = known.orderBy(F.xxhash64("__id"), "__id").limit(sample)
    rows = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(known), F.col("doc_id") == F.col("__id"))
    taught = rows.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), "__label").repartition(1)
    got = scratch.passed(taught, _trainer, "word binary, gram binary, bias double").first()
    if got is None:
        return train(pa.array([], pa.string()), np.zeros(0))
    return Model(np.frombuffer(got[0], np.float32), np.frombuffer(got[1], np.float32), got[2])


def scores(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """doc_id, score (probability of label 1), predicted (1 where score >= ``threshold``) for each row of ``docs``.

    A null or empty text has the score of the bias alone.  Only ``doc_id`` (passed through) and ``text`` are read.  Repeated
    rows each have a row; a score of exactly ``threshold`` is 1; long texts are read whole; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, offsets in B.chunks(batch.column(1)):
                s = score_chunk(shared.value, buf, offsets)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return scratch.passed(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, "doc_id long, score double, predicted int")


def accepted(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """``docs`` without the rows that the classifier rejects (score under ``threshold``), all columns kept; rows do not move.

    Rows are judged one by one: repeated ids, null ids and null texts (the bias alone) are rows like others.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.schema
    at = schema.fieldNames().index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for lo, hi, buf, offsets in B.chunks(batch.column(at)):
                keep[lo:hi] = score_chunk(shared.value, buf, offsets) >= threshold
            yield batch.filter(pa.array(keep))

    return scratch.passed(docs, run, schema)
