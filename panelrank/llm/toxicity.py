"""Toxicity by multiple-instance learning: sentence scores combined by noisy-or, trained from document labels.

A document is a bag of sentences; a sentence's probability is a logistic function of the features it holds (words and
word prefixes, as 64-bit hashes), and the document's is ``1 - prod(1 - p)``: one bad sentence is enough. Labels exist for
documents only, so the noisy-or's gradient hands the blame to the sentences that explain the label.

Training reads a bounded sample of the labelled rows (``max_rows``, chosen by a hash of the id). Feature counts are made in the
tasks and summed by Spark; the ``n_features`` with the largest likelihood ratio are kept, and the sample's sentences,
reduced to those features, are fitted on the driver. Scoring is one pass without a shuffle over whole texts.

Defined results: null, empty and wordless texts have no sentence and get the score 0; repeated rows score alike; rows
without label, with null label or null id don't train; without both classes in the sample every score is the base rate.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelrank.llm.arrays import ALNUM_WORD, Lookup, Words, append_column, fresh_name, group_sums, id_bucket, release, row_slices, text_buffer

MAX_ROWS = 12_000        # labelled rows that train, at most (about)
N_FEATURES = 3_000
PREFIXES = (4, 5, 6)     # bytes of the word prefixes that are features besides whole words
OFFENDING = 0.5          # a sentence with this probability or more is reported
STEPS, RATE, L2 = 250, 0.2, 2e-4

_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?\n"]] = True

FOUND = T.StructType([
    T.StructField("score", T.DoubleType()),
    T.StructField("sentences", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())]))),
])
_SENT = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
_FOUND = pa.struct([("score", pa.float64()), ("sentences", pa.list_(_SENT))])


def _sentences(buf: np.ndarray, w: Words) -> np.ndarray:
    """Sentence number of each word: words between sentence ends in one row share it; numbers ascend over the rows."""
    n = len(w.start)
    if not n:
        return np.zeros(0, np.int64)
    ends = np.concatenate([[0], np.cumsum(_ENDS[buf])])
    new = np.ones(n, bool)
    new[1:] = (ends[w.start[1:]] > ends[w.end[:-1]]) | (w.row[1:] != w.row[:-1])
    return np.cumsum(new) - 1


def _features(buf: np.ndarray, w: Words) -> list[np.ndarray]:
    """Feature hashes aligned with the words (0: no such feature)."""
    return [w.hash, *(w.prefix_hash(buf, k) for k in PREFIXES)]


def _slices(col: pa.Array):
    buf, off = text_buffer(col)
    for lo, hi in row_slices(off):
        part = buf[off[lo]:off[hi]]
        yield lo, hi, part, Words(part, off[lo:hi + 1] - off[lo], ALNUM_WORD), off[lo:hi + 1] - off[lo]


def training_rows(docs: DataFrame, labels: DataFrame, label: str, id_col: str, text_col: str, max_rows: int) -> DataFrame:
    """(text, label) of about ``max_rows`` labelled rows outside the held-out fold, chosen by a hash of the id."""
    lab = labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & (id_bucket(id_col) != 0))
    lab = lab.groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(label).cast("int")).alias("_label"))
    n = lab.count()
    if n > max_rows:
        lab = lab.where(F.pmod(F.xxhash64(F.col("_id")), F.lit(1 << 20)) < F.lit(int((1 << 20) * max_rows / n)))
    # the sample is bounded by max_rows, so is the broadcast
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(lab), "_id").select("_text", "_label")


def _choose(rows: DataFrame, n_features: int) -> np.ndarray:
    """Features by likelihood ratio between the classes, from document counts."""
    def count(batches):
        kept: list[np.ndarray] = []
        for b in batches:
            label = np.asarray(b.column(1).to_numpy(zero_copy_only=False), np.int64)
            for lo, _, buf, w, _ in _slices(b.column(0)):
                f = _features(buf, w)
                h = np.concatenate(f)
                row = np.concatenate([w.row] * len(f))
                order = np.argsort(h + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                h, row = h[order], row[order]
                new = np.append(True, (h[1:] != h[:-1]) | (row[1:] != row[:-1])) if len(h) else np.zeros(0, bool)
                new &= h != 0
                u, at = np.unique(h[new], return_inverse=True)
                y = label[lo + row[new]]
                kept.append(np.stack([u.view(np.int64), np.bincount(at, y == 1, len(u)).astype(np.int64), np.bincount(at, y == 0, len(u)).astype(np.int64)]))
        if kept:
            x = np.concatenate(kept, axis=1)
            u, at = np.unique(x[0], return_inverse=True)
            pos, neg = (np.bincount(at, x[i], len(u)).astype(np.int64) for i in (1, 2))
            del kept, x, at
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(pos), pa.array(neg)], names=["h", "pos", "neg"])
        release()

    n1, n0 = (F.lit(float(v)) for v in rows.agg(F.sum((F.col("_label") == 1).cast("int")) + 1, F.sum((F.col("_label") == 0).cast("int")) + 1).first())
    c = rows.mapInArrow(count, "h long, pos long, neg long").groupBy("h").agg(F.sum("pos").alias("p"), F.sum("neg").alias("q")).where("p + q >= 4")
    both, total = F.col("p") + F.col("q"), n1 + n0
    part = lambda k, n: F.when(k > 0, k * F.log(k * total / (both * n))).otherwise(0.0)
    gain = part(F.col("p"), n1) + part(F.col("q"), n0)
    top = c.select("h", gain.alias("g")).orderBy(F.desc("g"), "h").limit(n_features).collect()
    return np.array([r.h for r in top], np.int64).view(np.uint64)


def _bags(rows: DataFrame, keys) -> tuple[np.ndarray, ...]:
    """The sample as (feature, sentence) pairs, the sentences' document, sentences without a feature, and the labels."""
    def reduce(batches):
        look = Lookup(keys.value)
        for b in batches:
            ids, cnt, plain, lab = [], [], [], []
            y = b.column(1).to_pylist()
            for lo, hi, buf, w, _ in _slices(b.column(0)):
                sent = _sentences(buf, w)
                n_sent = int(sent[-1]) + 1 if len(sent) else 0
                pair = []
                for h in _features(buf, w):
                    i, k = look.find(h)
                    pair.append(sent[i] * len(look.keys) + k)
                pair = np.unique(np.concatenate(pair))
                s, k = pair // max(1, len(look.keys)), pair % max(1, len(look.keys))
                row_of = np.zeros(n_sent, np.int64)
                row_of[sent] = w.row
                used, n = np.unique(s, return_counts=True)
                per_row = np.searchsorted(row_of[used], np.arange(hi - lo + 1))
                edge = np.concatenate([[0], np.cumsum(n)])
                total = np.bincount(row_of, minlength=hi - lo)
                for r in range(hi - lo):
                    ids.append(k[edge[per_row[r]]:edge[per_row[r + 1]]].tolist())
                    cnt.append(n[per_row[r]:per_row[r + 1]].tolist())
                    plain.append(int(total[r] - (per_row[r + 1] - per_row[r])))
                    lab.append(y[lo + r])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.list_(pa.int32())), pa.array(cnt, pa.list_(pa.int32())), pa.array(plain, pa.int64()), pa.array(lab, pa.int32())], names=["f", "n", "plain", "label"])

    got = rows.mapInArrow(reduce, "f array<int>, n array<int>, plain long, label int").toArrow()
    feature = got.column("f").combine_chunks().flatten().to_numpy().astype(np.int64)
    per = got.column("n").combine_chunks()
    count = per.flatten().to_numpy().astype(np.int64)
    doc = np.repeat(np.arange(len(per)), np.diff(per.offsets.to_numpy()))
    return feature, np.repeat(np.arange(len(count)), count), doc, got.column("plain").to_numpy().astype(float), got.column("label").to_numpy().astype(float)


def fit_noisy_or(feature, sentence, doc, plain, label, n_features: int, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Sentence weights and bias that maximise the noisy-or likelihood of the document labels (Adam, L2 on the weights)."""
    theta, m, v = np.zeros(n_features + 1), np.zeros(n_features + 1), np.zeros(n_features + 1)
    theta[-1] = -5.0
    n = len(label)
    # rows of the sample come in no fixed order; sums below don't depend on it beyond rounding
    for t in range(1, steps + 1):
        z = theta[-1] + np.bincount(sentence, theta[feature], len(doc))
        z0 = theta[-1]
        # log(1 - sigmoid(z)) = -log(1 + e^z)
        quiet = -(np.bincount(doc, np.logaddexp(0, z), n) + plain * np.logaddexp(0, z0))
        p = np.clip(-np.expm1(quiet), 1e-9, 1.0)
        # dL/dz of a sentence: sigmoid(z) * (1 - y / p)
        slope = 1.0 - label / p
        gs = slope[doc] / (1 + np.exp(-z))
        grad = np.append(np.bincount(feature, gs[sentence], n_features) / n + L2 * theta[:-1], (gs.sum() + (slope * plain).sum() / (1 + np.exp(-z0))) / n)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta -= RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return theta[:-1], float(theta[-1])


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
          max_rows: int = MAX_ROWS, n_features: int = N_FEATURES) -> dict:
    """The model: sorted feature hashes, their weights, the bias (a few dozen KB)."""
    rows = training_rows(docs, labels, label, id_col, text_col, max_rows).persist()
    try:
        seen = {r["_label"]: r["count"] for r in rows.groupBy("_label").count().collect()}
        if not seen.get(0) or not seen.get(1):
            rate = seen.get(1, 0) / max(1, sum(seen.values()))
            return {"keys": np.zeros(0, np.uint64), "weights": np.zeros(0), "bias": 0.0, "constant": float(rate)}
        keys = np.sort(_choose(rows, n_features))
        w, b = fit_noisy_or(*_bags(rows, docs.sparkSession.sparkContext.broadcast(keys)), len(keys))
        return {"keys": keys, "weights": w, "bias": b, "constant": None}
    finally:
        rows.unpersist()


def score(docs: DataFrame, model: dict, text_col: str = "text", into: str = "toxicity") -> DataFrame:
    """``docs`` plus the struct ``into``: score, and the offending sentences as code point spans with their probability."""
    at, model = docs.columns.index(text_col), docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = model.value
        look = Lookup(m["keys"])

        def fn(b):
            scores, found = [], []
            for lo, hi, buf, w, off in _slices(b.column(at)):
                sent = _sentences(buf, w)
                n_sent = int(sent[-1]) + 1 if len(sent) else 0
                if m["constant"] is not None:
                    scores += [m["constant"]] * (hi - lo)
                    found += [[]] * (hi - lo)
                    continue
                pair = []
                for h in _features(buf, w):
                    i, k = look.find(h)
                    pair.append(sent[i] * max(1, len(look.keys)) + k)
                pair = np.unique(np.concatenate(pair))
                z = m["bias"] + np.bincount(pair // max(1, len(look.keys)), m["weights"][pair % max(1, len(look.keys))], n_sent)
                first = np.searchsorted(sent, np.arange(n_sent))
                row = w.row[first]
                edge = np.searchsorted(row, np.arange(hi - lo + 1))
                scores += np.clip(-np.expm1(-group_sums(np.logaddexp(0, z), edge)), 0.0, 1.0).tolist()
                mine = [[] for _ in range(hi - lo)]
                for s in np.flatnonzero(z >= np.log(OFFENDING / (1 - OFFENDING))):
                    last = (first[s + 1] if s + 1 < n_sent else len(sent)) - 1
                    o, a, e = off[row[s]], w.start[first[s]], w.end[last]
                    chars = lambda x, y: int(((buf[x:y] & 0xC0) != 0x80).sum())
                    start = chars(o, a)
                    mine[row[s]].append({"start": start, "end": start + chars(a, e), "score": float(1 / (1 + np.exp(-z[s])))})
                found += mine
            return pa.StructArray.from_arrays([pa.array(scores, pa.float64()), pa.array(found, pa.list_(_SENT))], fields=list(_FOUND))
        return fn
    return append_column(docs, into, FOUND, make)


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows scored ``threshold`` or more by a model trained on their labelled part."""
    name = fresh_name(docs, "_toxicity")
    return score(docs, train(docs, labels), into=name).where(F.col(f"{name}.score") < threshold).drop(name)


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    s = F.col("toxicity.score")
    return score(docs, model).select("doc_id", (id_bucket("doc_id") == 0).alias("held_out"), s.alias("score"), (s >= 0.5).cast("int").alias("predicted"), F.size("toxicity.sentences").alias("n_offending"))
