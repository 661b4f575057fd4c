"""Document fingerprints from closed syncmers.

A k-mer (``k`` code points) is chosen if, of the hashes of its inner substrings of ``s`` code points, the smallest stands at its
first or last place. The choice depends on the k-mer alone, so equal stretches give equal anchors wherever they stand and
whatever surrounds them. A fingerprint is the list of all anchors (32-bit hash and position) in text order, so it grows with the
text (about 2 anchors in 11 places) and a short passage shared by two long texts is seen anchor by anchor.

Likeness matches anchors by hash, the n-th place of a repeated one with the n-th, and keeps the longest chain that ascends in
both texts: ``2 * chain / (anchors of both)``.

Defined results: the empty (or null) text has the empty fingerprint, like itself 1 and anything else 0; a text without a
syncmer is its own single anchor; a repeated k-mer is an anchor at every place; equal texts have equal fingerprints.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelrank.llm.arrays import POWERS, fresh_name, mix

K, S = 16, 6
ANCHORS = math.inf       # most anchors of a fingerprint: every syncmer is one
SPAN = 1 << 18           # code points hashed at once


def _codes(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)


def _hashes(acc: np.ndarray, inv: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all substrings of ``n`` code points, from prefix sums."""
    return mix((acc[n:] - acc[:-n]) * inv[: len(acc) - n] + np.uint64(n))


def syncmers(codes: np.ndarray, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of the closed syncmers of a code point array, in spans that overlap by k - 1."""
    at, found = [], []
    for lo in range(0, max(0, len(codes) - k + 1), SPAN):
        part = codes[lo:lo + SPAN + k - 1]
        p, inv = POWERS.up_to(len(part) + 1)
        acc = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * p[:-1], out=acc[1:])
        inner = _hashes(acc, inv, s)
        n = len(part) - k + 1
        low, width = inner, 1                      # minima over ``width`` places, doubled until they cover the k-mer
        w = k - s + 1
        while 2 * width <= w:
            low, width = np.minimum(low[:-width], low[width:]), 2 * width
        low = np.minimum(low[:n], low[w - width:w - width + n])
        pick = np.flatnonzero((inner[:n] == low) | (inner[k - s:k - s + n] == low))
        at.append(pick + lo)
        found.append(mix((acc[pick + k] - acc[pick]) * inv[pick] + np.uint64(k)))
    return (np.concatenate(at), np.concatenate(found)) if at else (np.zeros(0, np.int64), np.zeros(0, np.uint64))


Fingerprint = tuple[np.ndarray, np.ndarray]  # 32-bit hashes and their ascending positions


def fingerprints(texts: list[str], k: int = K, s: int = S) -> list[Fingerprint]:
    codes = _codes(texts)
    off = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    at, h = syncmers(codes, k, s)
    doc = np.searchsorted(off, at, "right") - 1
    inside = at + k <= off[doc + 1] if len(at) else np.zeros(0, bool)
    at, h, doc = at[inside], (h[inside] >> np.uint64(32)).astype(np.int64), doc[inside]
    edge = np.searchsorted(doc, np.arange(len(texts) + 1))
    out = []
    for i, t in enumerate(texts):
        own = h[edge[i]:edge[i + 1]]
        if not len(own):
            sole = [int.from_bytes(hashlib.sha256(t.encode("utf-8", "surrogatepass")).digest()[:4])] if t else []
            out.append((np.array(sole, np.int64), np.zeros(len(sole), np.int64)))
            continue
        out.append((own, at[edge[i]:edge[i + 1]] - off[i]))
    return out


def show(f: Fingerprint) -> str:
    return ("%08x@%x," * len(f[0]) % tuple(np.stack(f, 1).ravel().tolist()))[:-1]


def _numbered(h: np.ndarray) -> np.ndarray:
    """Hash and occurrence number of each anchor in one integer: the n-th place of a k-mer matches the n-th in another text."""
    order = np.argsort(h, kind="stable")
    new = np.ones(len(h), bool)
    new[1:] = h[order[1:]] != h[order[:-1]]
    out = np.empty(len(h), np.int64)
    out[order] = np.arange(len(h)) - np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
    return (h << 31) + out


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    if not len(a[0]) or not len(b[0]):
        return float(len(a[0]) == len(b[0]))
    _, x, y = np.intersect1d(_numbered(a[0]), _numbered(b[0]), assume_unique=True, return_indices=True)
    there = y[np.argsort(x)]                       # places in b along a
    chain = len(there)
    if (np.diff(there) < 0).any():                 # longest chain: places in b ascend along a
        tails: list[int] = []
        for p in there.tolist():
            i = bisect_left(tails, p)
            tails[i:i + 1] = [p]
        chain = len(tails)
    return 2 * chain / (len(a[0]) + len(b[0]))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(block, tail, id, text): the documents dealt to blocks of consecutive ids, each block sorted and closed by the row that
    follows its last one (``tail``; after the last document, the first).

    Cut points are ids that exist, as many as shuffle partitions, so a block's follower is the row at the next cut. A null id
    comes first; repeated ids are ordered by text.
    """
    spark = docs.sparkSession
    least = -(1 << 63)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(least)).alias("key"), F.col(id_col).isNull().alias("void"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = rows.agg(F.min("key").alias("least"), F.percentile_approx("key", [i / parts for i in range(1, parts)], 50 * parts).alias("cuts")).first()
    cuts = sorted({found.least, *found.cuts}) if found.least is not None else [0]
    n = len(cuts)

    def deal(batches):
        c = np.array(cuts, np.int64)
        for b in batches:
            key = b.column("key").to_numpy()
            block = np.searchsorted(c, key, "right") - 1
            edge = np.flatnonzero(c[block] == key)
            take = np.concatenate([np.arange(len(key)), edge])
            to = np.concatenate([block, (block[edge] - 1) % n])
            tail = np.concatenate([np.zeros(len(key), bool), np.ones(len(edge), bool)])
            for lo in range(0, len(take), 2000):
                s = slice(lo, lo + 2000)
                part = b.take(pa.array(take[s]))
                yield pa.RecordBatch.from_arrays([pa.array(to[s].astype(np.int32)), pa.array(tail[s]), part.column("key"), part.column("void"), part.column("text")], names=["block", "tail", "key", "void", "text"])

    dealt = rows.mapInArrow(deal, "block int, tail boolean, key long, void boolean, text string")
    return dealt.repartitionById(n, F.col("block")).sortWithinPartitions("block", "tail", "key", "text")


RESULT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_chars", T.LongType()), T.StructField("edited_sha256", T.StringType()), T.StructField("fingerprint", T.StringType()),
    T.StructField("edited_fingerprint", T.StringType()), T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType()),
])


def edit(text: str, following: str) -> str:
    """The text with its last half replaced by the beginning of the following one."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and its edited text, and their likeness; one row per document row."""
    names = RESULT.names

    def run(batches):
        def emit(group):
            """Results of all but the last of these consecutive rows of one block."""
            texts = [g[4] for g in group]
            edited = [edit(a, b) for a, b in zip(texts, texts[1:], strict=False)]
            own = fingerprints(texts)
            new = fingerprints(edited)
            cols = [[], [], [], [], [], [], []]
            for i, e in enumerate(edited):
                if group[i][1]:
                    continue
                row = (None if group[i][3] else group[i][2], len(texts[i]), hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest(), show(own[i]), show(new[i]), likeness(own[i], new[i]), likeness(own[i], own[i + 1]))
                for c, v in zip(cols, row, strict=True):
                    c.append(v)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if n in ("doc_id", "n_chars") else pa.float64() if n[:4] == "near" else pa.string()) for c, n in zip(cols, names, strict=True)], names=names)

        held, size = [], 0
        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("block", "tail", "key", "void", "text")), strict=True):
                if held and (row[0] != held[-1][0] or size > 1 << 20):
                    same = row[0] == held[-1][0]
                    if same:
                        held.append(row)
                    if len(held) > 1:
                        yield emit(held)
                    held, size = [row], len(row[4])
                else:
                    held.append(row)
                    size += len(row[4])
        if len(held) > 1:
            yield emit(held)

    return with_next(docs, id_col, text_col).mapInArrow(run, RESULT)


def fingerprint(docs: DataFrame, text_col: str = "text", into: str = "fingerprint") -> DataFrame:
    """``docs`` plus the fingerprint of each text (a column of that name is replaced)."""
    docs = docs.drop(into)
    at, name = docs.columns.index(text_col), fresh_name(docs, into)

    def run(batches):
        for b in batches:
            texts = [t or "" for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([show(f) for f in fingerprints(texts)], pa.string())], names=[*b.schema.names, name])
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.StringType())]))


def op7_syncmers(spark, sf_dir: str) -> DataFrame:
    return compare_with_next(spark.read.parquet(f"{sf_dir}/documents.parquet"))
