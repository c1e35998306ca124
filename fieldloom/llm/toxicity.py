"""Toxicity by multiple-instance learning (operator 4).

A document is a bag of sentences.  A sentence's score is logistic in its hashed
words and word beginnings; the document's score is the noisy-or of its
sentences, 1 - prod(1 - p).  Weights are learned from document labels alone,
through the noisy-or; the fitted sentence scores then locate the offending
sentences.

Fitting uses a bounded sample: at most ``max_rows`` labelled documents of each
label (smallest hash of doc_id first) of at most ``max_chars`` characters.
Class weights restore the share of each label.  Scoring covers every whole
text.  The sample's features go to the driver (bounded by the two parameters);
the model is ``DIM`` floats, broadcast.

Edge cases: null or empty text and text without words score 0; null labels are
ignored; a doc_id with several labels counts as toxic if any says so; without
both labels to learn from every score is 0; lang, source, labels and doc_id are
no inputs of a score; repeated rows are scored alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import (WORD_BYTES, Words, batch, char_offsets, on_executors, sentence_starts, split_words, stored,
                                  text_pieces)

DIM = 1 << 18
STEM = 5  # bytes of a word's beginning
OFFENDING = 0.5
LEAST, ODDS = 5, 4.0  # toxic documents that hold a used feature, and how much more often they do


def held_out(doc_id: Column) -> Column:
    """Rows never learned from."""
    return F.crc32(doc_id.cast("string")) % 3 == 1


def _features(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Two hashed features per word (the word, its beginning), and where each sentence begins."""
    stem = split_words(w.data, w.bounds, WORD_BYTES, stem=STEM).hash
    f = np.stack([w.hash, stem ^ np.uint64(0x5BD1E995)], axis=1) >> np.uint64(64 - DIM.bit_length() + 1)
    return f.astype(np.int32), sentence_starts(w)


def _bags(batches):
    """Label, feature ids and sentence beginnings of each sampled document."""
    schema = pa.schema([("toxic", pa.int32()), ("features", pa.binary()), ("first", pa.binary())])
    for b in batches:
        y = b.column(0)
        rows = []
        for i, data, bounds in text_pieces(b.column(1)):
            w = split_words(data, bounds, WORD_BYTES)
            f, first = _features(w)
            for j, (s, e) in enumerate(zip(w.first[:-1], w.first[1:], strict=True)):
                own = first[(first >= s) & (first < e)] - s if e > s else first[:0]
                rows.append((y[i + j].as_py(), f[s:e].tobytes(), own.astype(np.int32).tobytes()))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)],
                                             schema=schema)


def _holders(batches):
    """Per task, how many documents of each label hold each feature."""
    schema = pa.schema([("feature", pa.int32()), ("clean", pa.int64()), ("toxic", pa.int64())])
    held = np.zeros((2, DIM), dtype=np.int64)
    for b in batches:
        for y, f in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            held[y, np.unique(np.frombuffer(f.as_buffer(), np.int32))] += 1
    some = np.flatnonzero(held.any(axis=0))
    yield batch(schema, some.astype(np.int32), held[0, some], held[1, some])


def _evidence(used):
    """Label, count of sentences, and of each used feature its place among ``used`` and its sentence."""
    schema = pa.schema([("toxic", pa.int32()), ("n", pa.int32()), ("code", pa.binary()), ("sentence", pa.binary())])

    def run(batches):
        place = np.full(DIM, -1, dtype=np.int32)
        place[used.value] = np.arange(len(used.value))
        for b in batches:
            n, codes, sentences = [], [], []
            for features, first in zip(b.column(1), b.column(2), strict=True):
                code, first = place[np.frombuffer(features.as_buffer(), np.int32)], np.frombuffer(first.as_buffer(), np.int32)
                at = np.flatnonzero(code >= 0)
                n.append(len(first))
                codes.append(code[at].tobytes())
                sentences.append((np.searchsorted(first, at // 2, "right") - 1).astype(np.int32).tobytes())  # two features per word
            yield batch(schema, b.column(0), n, codes, sentences)
    return run


def fit(bags: list[tuple[int, int, bytes, bytes]], used: np.ndarray, prior: tuple[float, float], rounds: int = 200,
        rate: float = 0.15, decay: float = 1e-5) -> tuple[np.ndarray, float]:
    """Non-negative weights and a bias that maximise the weighted noisy-or
    likelihood less ``decay`` times the sum of the weights (Adam, full batch)."""
    y = np.array([b[0] for b in bags], dtype=bool)
    size = np.array([b[1] for b in bags], dtype=np.int64)
    flat = np.frombuffer(b"".join(b[2] for b in bags), np.int32)
    held = [len(b[3]) // 4 for b in bags]
    sentence = np.frombuffer(b"".join(b[3] for b in bags), np.int32) + np.repeat(np.cumsum(size) - size, held)
    doc = np.repeat(np.arange(len(bags)), size)
    weight = np.where(y, prior[1] / max(1, y.sum()), prior[0] / max(1, (~y).sum())) * len(y)
    theta = np.zeros(len(used) + 1)  # the used features, last the bias
    theta[-1] = -6.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, rounds + 1):
        z = np.bincount(sentence, theta[flat], minlength=len(doc)) + theta[-1]
        soft = np.logaddexp(0, z)
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        s = np.bincount(doc, soft, minlength=len(bags))
        slope = np.where(y, -1 / np.expm1(np.clip(s, 1e-6, 50)), 1.0) * weight / len(y)
        g = slope[doc] * p
        grad = np.bincount(flat, g[sentence], minlength=len(theta)).astype(float)
        grad[-1] += g.sum()
        grad[:-1] += decay
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        theta -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        theta[:-1] = np.maximum(theta[:-1], 0)  # a sentence is evidence for, never against
    out = np.zeros(DIM, dtype=np.float32)
    out[used] = theta[:-1]
    return out, float(theta[-1])


SCORED = ("score double, n_sentences long, "
          "offending array<struct<start:int,end:int,score:double>>")


def _score(model):
    def run(batches):
        weights, bias = model.value
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        for b in batches:
            for i, data, bounds in text_pieces(b.column(b.num_columns - 1)):
                w = split_words(data, bounds, WORD_BYTES)
                f, first = _features(w)
                n = len(bounds) - 1
                score, count, spans = np.zeros(n), np.zeros(n, dtype=np.int64), [[] for _ in range(n)]
                if len(first):
                    z = np.add.reduceat(weights[f].sum(axis=1, dtype=np.float64), first) + bias
                    p = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
                    doc = np.searchsorted(w.first, first, "right") - 1
                    score = -np.expm1(-np.bincount(doc, np.logaddexp(0, z), minlength=n))
                    count = np.bincount(doc, minlength=n)
                    bad = np.flatnonzero(p >= OFFENDING)
                    if len(bad):
                        chars = char_offsets(data)
                        last = np.r_[first[1:], len(w.hash)] - 1
                        for k in bad.tolist():
                            at = chars[bounds[doc[k]]]
                            spans[doc[k]].append({"start": int(chars[w.start[first[k]]] - at),
                                                  "end": int(chars[w.end[last[k]]] - at), "score": float(p[k])})
                part = b.slice(i, n)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(score), pa.array(count), pa.array(spans, kind)],
                    names=[*part.schema.names[:-1], "score", "n_sentences", "offending"])
    return run


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          max_rows: int = 4000, max_chars: int = 200_000) -> tuple[np.ndarray, float]:
    """Fit on labelled rows that are not held out; see the module on the sample."""
    on_executors(docs.sparkSession)
    truth = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & ~held_out(F.col(id_col)))
             .groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.max(F.col(label_col).cast("int")).alias("toxic")))
    count = {r["toxic"]: r["n"] for r in truth.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(count) < 2:
        return np.zeros(DIM, dtype=np.float32), -np.inf
    picks = [truth.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows) for y in (0, 1)]
    sample = (docs.where(F.length(text_col) <= max_chars)
              .select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
              .join(F.broadcast(picks[0].union(picks[1])), "doc_id").select("toxic", "text")
              .mapInArrow(_bags, "toxic int, features binary, first binary"))
    bags = stored(sample, "bags").where("length(first) > 0")
    size = {r["toxic"]: r["n"] for r in bags.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(size) < 2:
        return np.zeros(DIM, dtype=np.float32), -np.inf
    # evidence: features that toxic documents hold clearly more often; others tell nothing apart from chance
    held = (bags.select("toxic", "features").mapInArrow(_holders, "feature int, clean long, toxic long")
            .groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")))
    odds = ((F.col("toxic") + 0.5) / (size[1] + 1)) / ((F.col("clean") + 0.5) / (size[0] + 1))
    used = np.array(sorted(r[0] for r in held.where((F.col("toxic") >= LEAST) & (odds >= ODDS)).select("feature").collect()), dtype=np.int64)
    shared = docs.sparkSession.sparkContext.broadcast(used)
    evidence = bags.mapInArrow(_evidence(shared), "toxic int, n int, code binary, sentence binary").coalesce(8)
    # the fit must not depend on the order of tasks
    found = sorted((r[0], r[1], bytes(r[2]), bytes(r[3])) for r in evidence.toLocalIterator())
    total = sum(count.values())
    return fit(found, used, (count[0] / total, count[1] / total))


def score(docs: DataFrame, model: tuple[np.ndarray, float], keep: list[str] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The ``keep`` columns of each row with ``score``, ``n_sentences`` and
    ``offending``: the noisy-or score and the sentences (character spans) whose own
    score reaches ``OFFENDING``.  Kept columns must not have these names."""
    clash = {c.lower() for c in keep} & {"score", "n_sentences", "offending"}
    if clash:
        raise ValueError(f"kept columns have the names of outputs: {sorted(clash)}")
    on_executors(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*(F.col(f"`{c}`") for c in keep), F.col(text_col).alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(_score(shared), f"{schema}, {SCORED}")


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7,
             **kw) -> DataFrame:
    """Train and score: adds ``held_out`` and ``predicted`` (score >= threshold)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = score(rows, train(docs, labels, id_col, text_col, **kw))
    return (out.withColumn("held_out", F.coalesce(held_out(F.col("doc_id")), F.lit(False)))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
