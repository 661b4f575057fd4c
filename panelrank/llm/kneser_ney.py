"""Interpolated modified Kneser-Ney language model (order 2), counted in Spark and kept as sorted hash arrays.

Counting. Each task packs its distinct (context, word) pairs with counts, cut by fragment: a range of context hashes, so a
fragment has all of a context. Contexts with more than a fragment's share of tokens are spread over several fragments by
the pair's hash, and only their sums meet later. A fragment's reducer merges its pairs, writes them as one file (sorted pair
hashes, then counts) and sends per-word sums on: for a context how many words follow it once, twice and more often and how often
it occurs, for a word how many contexts it follows. Reducers of word ranges write these as files of the same kind.
Only sums of a few numbers per file reach the driver; all tables grow with the corpus and stay in the shared folder.

Scoring. A task maps the files into memory (pages load on demand and are shared between workers) and looks a slice of text up
by sorted unique hashes: ``p(w|v) = (c(v,w) - D(c)) / c(v) + gamma(v) * q(w)``; ``q`` is the discounted share of contexts that ``w``
follows, interpolated with the uniform distribution over the vocabulary and one unknown word. Discounts come from the
counts of counts. Every document starts in a start context and ends with an end token.

Files are written under another name and renamed, so a repeated task leaves the same files. A shared folder that isn't mounted is
copied to each worker's scratch folder first.

Defined results: null, empty and blank texts are the end token alone; repeated rows count and score each; with nothing to train on every
token has probability one over one (score 0, nothing known).
"""

from __future__ import annotations

import re
import uuid
from collections import OrderedDict

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelrank.llm.arrays import SHINGLE_BASE, SPACE_WORD, Words, append_column, group_sums, id_bucket, mix, row_slices, text_buffer, without
from panelrank.llm.jaccard import _expand, _squeeze
from panelrank.session import ensure_checkpoint_dir

START, END = np.uint64(0x6C62272E07BB0142), np.uint64(0x27D4EB2F165667C5)
FRAGMENT_TOKENS = 4_000_000
SLICE = 8 << 20            # bytes of text whose pairs are counted at once
LOOKUP = 1 << 20           # bytes of text looked up at once


def tokens(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes of some rows with the end token, the token before each, and the first token of each row."""
    w = Words(buf, off, SPACE_WORD)
    first = np.concatenate([[0], np.cumsum(w.count + 1)])
    out = np.full(first[-1], END, np.uint64)
    out[np.arange(len(w.hash)) + w.row] = w.hash
    before = np.empty_like(out)
    before[1:] = out[:-1]
    before[first[:-1]] = START
    return out, before, first


def pair_hash(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(before * SHINGLE_BASE + word)


class Dealer:
    """Fragment of a pair: the range its context falls into; a hot context's pairs go round from there."""

    def __init__(self, bits: int, hot: dict[int, int]):
        self.bits = bits
        keys = sorted(hot)
        self.keys = np.array(keys, np.uint64)
        self.spread = np.array([hot[k] for k in keys], np.int64)

    def __call__(self, before: np.ndarray, pair: np.ndarray) -> np.ndarray:
        f = (before >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(before), np.int64)
        if len(self.keys):
            i = np.minimum(np.searchsorted(self.keys, before), len(self.keys) - 1)
            at = np.flatnonzero(self.keys[i] == before)
            f[at] = (f[at] + (pair[at] % self.spread[i[at]].astype(np.uint64)).astype(np.int64)) % (1 << self.bits)
        return f


def _sum_by(key: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, and the sums of the columns for each."""
    if not len(key):
        return (key, *columns)
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return (key[first], *(np.add.reduceat(c[order], first) for c in columns))


# files ------------------------------------------------------------------------------------------

def _fs(uri: str):
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri if re.match(r"[A-Za-z][\w+.-]*:", uri) else f"file://{uri}"))


def write_arrays(folder: str, name: str, arrays: list[np.ndarray]) -> None:
    """One file: the number of entries, then each array; complete once it has its name."""
    fs, base = _fs(folder)
    fs.create_dir(base, recursive=True)
    tmp = f"{base}/.{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(tmp) as out:
        out.write(np.int64(len(arrays[0])).tobytes())
        for a in arrays:
            out.write(np.ascontiguousarray(a).data)
    fs.move(tmp, f"{base}/{name}")


def map_arrays(folder: str, name: str, kinds: list) -> list[np.ndarray]:
    """The arrays of a file, mapped into memory where the shared folder is mounted, else read from it; an absent file is empty arrays."""
    fs, base = _fs(folder)
    path = f"{base}/{name}"
    if fs.get_file_info(path).type == pafs.FileType.NotFound:
        return [np.zeros(0, k) for k in kinds]
    if isinstance(fs, pafs.LocalFileSystem):
        whole = np.memmap(path, np.uint8, "r")
    else:
        with fs.open_input_file(path) as f:
            whole = np.frombuffer(f.readall(), np.uint8)
    n = int(whole[:8].view(np.int64)[0])
    out, at = [], 8
    for k in kinds:
        size = n * np.dtype(k).itemsize
        out.append(whole[at:at + size].view(k))
        at += size
    return out


def is_mounted(folder: str) -> bool:
    return isinstance(_fs(folder)[0], pafs.LocalFileSystem)


PAIRS = [np.uint64, np.uint32]                                                  # pair hash, count
WORDS = [np.uint64, np.uint64, np.uint32, np.uint32, np.uint32, np.uint32]      # word hash, count, followers seen once, twice, more often, contexts


# counting ---------------------------------------------------------------------------------------

def _word_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """(h, n): token counts, made in the tasks and summed by Spark."""
    def run(batches):
        for b in batches:
            buf, off = text_buffer(b.column(0))
            for lo, hi in row_slices(off, SLICE):
                h, n = np.unique(tokens(buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], names=["h", "n"])
    return docs.select(text_col).mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def _pairs(docs: DataFrame, text_col: str, bits: int, hot: dict[int, int]) -> DataFrame:
    def run(batches):
        deal = Dealer(bits, hot)
        for b in batches:
            buf, off = text_buffer(b.column(0))
            for lo, hi in row_slices(off, SLICE):
                word, before, _ = tokens(buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
                pair = pair_hash(before, word)
                order = np.argsort(pair)
                pair = pair[order]
                first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
                n = np.diff(np.append(first, len(pair))).astype(np.uint32)
                at = order[first]
                word, before = word[at], before[at]
                f = deal(before, pair[first])
                order = np.lexsort((before, f))
                f, word, before, n = f[order], word[order], before[order], n[order]
                edge = np.searchsorted(f, np.arange((1 << bits) + 1))
                full = np.flatnonzero(edge[1:] > edge[:-1])
                for part in np.array_split(full, max(1, len(full) // 256)):
                    blobs = [_squeeze(before[edge[i]:edge[i + 1]], word[edge[i]:edge[i + 1]], n[edge[i]:edge[i + 1]]) for i in part]
                    yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(blobs, pa.binary())], names=["fragment", "blob"])
    return docs.select(text_col).mapInArrow(run, "fragment long, blob binary")


def _fragment(table: pa.Table, folder: str, bits: int) -> pa.Table:
    """Merges a fragment's pairs, writes them, and sends sums per word to the word ranges (range -1: counts of counts)."""
    parts = [_expand(x.as_py(), np.uint64, np.uint64, np.uint32) for x in table.column("blob")]
    before, word, n = (np.concatenate([p[i] for p in parts]) for i in range(3))
    del parts
    pair = pair_hash(before, word)
    order = np.argsort(pair)
    pair = pair[order]
    first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
    count = np.add.reduceat(n[order].astype(np.int64), first)
    before, word = before[order][first], word[order][first]
    write_arrays(folder, f"pairs-{int(table.column('fragment')[0].as_py())}", [pair[first], np.minimum(count, 0xFFFFFFFF).astype(np.uint32)])
    one, two, more = ((count == 1).astype(np.int64), (count == 2).astype(np.int64), (count > 2).astype(np.int64))
    nothing = np.zeros(len(word), np.int64)
    c = _sum_by(before, count, one, two, more)
    w = _sum_by(word, nothing + 1)
    key = np.concatenate([c[0], w[0]])
    key, *sums = _sum_by(key, *(np.concatenate([x, np.zeros(len(w[0]), np.int64)]) for x in c[1:]), np.concatenate([np.zeros(len(c[0]), np.int64), w[1]]))
    edge = np.concatenate([[0], np.searchsorted(key, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else [], [len(key)]]).astype(np.int64)
    full = np.flatnonzero(edge[1:] > edge[:-1])
    blobs = [_squeeze(key[edge[i]:edge[i + 1]], *(s[edge[i]:edge[i + 1]] for s in sums)) for i in full]
    coc = np.bincount(np.minimum(count, 5), minlength=6)[1:5].astype(np.int64)
    return pa.table({"range": pa.array(np.append(full, -1)), "blob": pa.array([*blobs, coc.tobytes()], pa.binary())})


def _range(table: pa.Table, folder: str) -> pa.Table:
    """Merges the sums of a range of words and writes them. Returns counts of counts, vocabulary size and number of pairs."""
    number = int(table.column("range")[0].as_py())
    blobs = [x.as_py() for x in table.column("blob")]
    if number < 0:
        coc = sum(np.frombuffer(b, np.int64) for b in blobs)
        return pa.table({"kind": ["pairs"], "a": pa.array([coc], pa.list_(pa.int64())), "vocabulary": pa.array([0], pa.int64()), "pairs": pa.array([0], pa.int64())})
    parts = [_expand(b, np.uint64, *[np.int64] * 5) for b in blobs]
    key, count, one, two, more, after = _sum_by(*(np.concatenate([p[i] for p in parts]) for i in range(6)))
    write_arrays(folder, f"words-{number}", [key, count.astype(np.uint64), *(np.minimum(x, 0xFFFFFFFF).astype(np.uint32) for x in (one, two, more, after))])
    coc = np.bincount(np.minimum(after, 5), minlength=6)[1:5].astype(np.int64)
    return pa.table({"kind": ["words"], "a": pa.array([coc], pa.list_(pa.int64())), "vocabulary": pa.array([int((after > 0).sum())], pa.int64()), "pairs": pa.array([int(after.sum())], pa.int64())})


def discounts(coc: np.ndarray) -> np.ndarray:
    """Discounts for counts 0, 1, 2, and 3 or more, from how many entries have the counts 1 to 4."""
    n = np.asarray(coc, float)
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
    d = [k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else 0.5 * k for k in (1, 2, 3)]
    return np.array([0.0, *(min(max(x, 0.1 * k), 0.95 * k) for k, x in zip((1, 2, 3), d, strict=True))])


def train(docs: DataFrame, text_col: str = "text", fragment_tokens: int = FRAGMENT_TOKENS) -> dict:
    """Counts the model from ``docs`` and returns its description: folder, ranges, discounts and sums."""
    spark = docs.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/kneser-ney-{uuid.uuid4().hex}"
    counts = _word_counts(docs, text_col)
    counts = counts.persist()
    try:
        total, vocabulary = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
        bits = int(np.ceil(np.log2(max(1, total / fragment_tokens))))
        share = max(1.0, total / (1 << bits))
        # contexts with over half a fragment's share: fewer than two a fragment
        hot = {int(r.h) & (2**64 - 1): int(np.ceil(2 * r.n / share)) for r in counts.where(F.col("n") > share / 2).collect()} if bits else {}
    finally:
        counts.unpersist()
    n_docs = docs.count()
    if bits and n_docs > share / 2:
        hot[int(START)] = int(np.ceil(2 * n_docs / share))
    sums = _pairs(docs, text_col, bits, hot).groupBy("fragment").applyInArrow(lambda t: _fragment(t, folder, bits), "range long, blob binary")
    got = sums.groupBy("range").applyInArrow(lambda t: _range(t, folder), "kind string, a array<long>, vocabulary long, pairs long").collect()
    add = lambda kind: sum((np.array(r.a) for r in got if r.kind == kind), np.zeros(4, np.int64))
    return {"folder": folder, "bits": bits, "hot": hot, "documents": n_docs, "tokens": int(total), "vocabulary": int(vocabulary), "types": sum(r.vocabulary for r in got), "pairs": sum(r.pairs for r in got),
            "d2": discounts(add("pairs")), "d1": discounts(add("words")), "coc1": add("words")}


# scoring ----------------------------------------------------------------------------------------

class Model:
    """A worker's view of the model: files are mapped when first needed."""

    def __init__(self, m: dict):
        self.m, self.deal, self.files = m, Dealer(m["bits"], m["hot"]), OrderedDict()
        self.most = 4096 if is_mounted(m["folder"]) else 16      # maps cost nothing, files read stay in memory
        n, d = m["coc1"].astype(float), m["d1"]
        many = max(0, m["types"] - n[0] - n[1])
        self.total = max(1, m["pairs"])
        left = (d[1] * n[0] + d[2] * n[1] + d[3] * many) / self.total if m["pairs"] else 1.0
        self.unknown = left / (m["vocabulary"] + 1)

    def _file(self, name: str, kinds: list) -> list[np.ndarray]:
        if name not in self.files:
            self.files[name] = map_arrays(self.m["folder"], name, kinds)
            if len(self.files) > self.most:
                self.files.popitem(last=False)
        return self.files[name]

    def _find(self, keys: np.ndarray, group: np.ndarray, kind: str, kinds: list, wanted: list[int]) -> list[np.ndarray]:
        """Values of keys (sorted within ascending groups), 0 where absent."""
        out = [np.zeros(len(keys), np.float64) for _ in wanted]
        start = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, np.int64)
        for a, z in zip(start, np.append(start[1:], len(keys)), strict=True):
            arrays = self._file(f"{kind}-{group[a]}", kinds)
            if len(arrays[0]):
                i = np.minimum(np.searchsorted(arrays[0], keys[a:z]), len(arrays[0]) - 1)
                hit = arrays[0][i] == keys[a:z]
                for o, c in zip(out, wanted, strict=True):
                    o[a:z][hit] = arrays[c][i[hit]]
        return out

    def words(self, h: np.ndarray) -> list[np.ndarray]:
        """Count, followers seen once, twice and more often, contexts: of sorted hashes."""
        bits = self.m["bits"]
        return self._find(h, (h >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64), "words", WORDS, [1, 2, 3, 4, 5])

    def pairs(self, before: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Count of each pair."""
        pair = pair_hash(before, word)
        f = self.deal(before, pair)
        order = np.lexsort((pair, f))
        out = np.empty(len(pair))
        out[order] = self._find(pair[order], f[order], "pairs", PAIRS, [1])[0]
        return out

    def log10(self, word: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each token: the model's log10 probability after the token before, and its training count."""
        both, at = np.unique(np.concatenate([word, before]), return_inverse=True)
        count, one, two, more, after = self.words(both)
        w, v = at[:len(word)], at[len(word):]
        q = np.maximum(after - self.m["d1"][np.minimum(after, 3).astype(int)], 0) / self.total + self.unknown
        d = self.m["d2"]
        c = self.pairs(before, word)
        seen = count[v] > 0
        down = np.where(seen, count[v], 1)
        gamma = np.where(seen, (d[1] * one[v] + d[2] * two[v] + d[3] * more[v]) / down, 1.0)
        p = np.maximum(c - d[np.minimum(c, 3).astype(int)], 0) / down * seen + gamma * q[w]
        # the end token is no context, so its count is that of the documents
        return np.log10(p), np.where(word == END, self.m["documents"], count[w])


SCORES = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()), T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())])
_SCORES = pa.struct([("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def score(docs: DataFrame, model: dict, text_col: str = "text", into: str = "lm") -> DataFrame:
    """``docs`` plus the struct ``into``: n_tokens, n_known, base_score (add-half unigrams) and score, both log10; perplexity is ``10 ** (-score / n_tokens)``.
    A column of that name is replaced."""
    docs = without(docs, into, text_col)
    at = docs.columns.index(text_col)

    def make():
        m = Model(model)
        end = model["tokens"] + 0.5 * (model["vocabulary"] + 1)

        def fn(b):
            buf, off = text_buffer(b.column(at))
            out = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)], [np.zeros(0)]
            for lo, hi in row_slices(off, LOOKUP):
                word, before, first = tokens(buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
                p, c = m.log10(word, before)
                for o, v in zip(out, (np.diff(first), group_sums(c > 0, first), group_sums(np.log10((c + 0.5) / end), first), group_sums(p, first)), strict=True):
                    o.append(v)
            return pa.StructArray.from_arrays([pa.array(np.concatenate(o), t.type) for o, t in zip(out, _SCORES, strict=True)], fields=list(_SCORES))
        return fn
    return append_column(docs, into, SCORES, make)


def op8_language_model(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    held = id_bucket("doc_id") == 1
    model = train(docs.where(~F.coalesce(held, F.lit(False))))
    return score(docs, model).select(
        "doc_id", held.alias("held_out"), F.col("lm.n_tokens").alias("n_tokens"), F.col("lm.n_known").alias("n_known"), F.lit(model["tokens"]).cast("long").alias("train_tokens"),
        F.col("lm.base_score").alias("base_score"), F.col("lm.score").alias("score"))
