"""Benchmark decontamination as a prefix-filtered set join.

An item is cut into item-sized windows (13 words; an item of fewer words is one window). A window is the
ordered list of its word shingles; the shingles are ordered by rarity (documents that hold them, counted over
the whole corpus). A document can only contain a window if it holds all its shingles, so one necessary prefix
token per window, its rarest shingle, is joined. A match at word position p proposes the window start p - offset;
positional and length bounds drop proposals that stick out of the document, and the rest is verified word by word.

The benchmark is the stated side: it is read in blocks of at most ``block_bytes`` of text, and only the index of one
block is broadcast at a time. Documents never shuffle with one block; with more, only ids and results do.

Defined results: null text has no words (n_words 0, nothing hit); null or wordless items have no window;
repeated document rows each give a row; an empty benchmark hits nothing; items sharing an id count once; a column of
``docs`` with the name of the result is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelrank.llm.arrays import ALNUM_WORD, Lookup, Words, append_column, fresh_name, release, row_slices, text_buffer, without

WINDOW = 13
SHINGLE = 5
BLOCK_BYTES = 16 << 20

HITS = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
])
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_HITS = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("spans", pa.list_(_SPAN))])


class WindowIndex:
    """Windows of one block of items: word hashes and lengths, their shingles, and after ``choose`` the prefix tokens."""

    def __init__(self, ids: list[str], texts: list[str], window: int, shingle: int):
        buf, off = text_buffer(pa.array(texts, pa.string()))
        w = Words(buf, off, ALNUM_WORD)
        self.ids, self.hash, self.size = ids, w.hash, (w.end - w.start).astype(np.int32)
        start, length, item = [], [], []
        for i, (a, n) in enumerate(zip(w.first[:-1], w.count, strict=True)):
            if n:
                k = max(1, n - window + 1)
                start.append(np.arange(a, a + k))
                length.append(np.full(k, min(n, window)))
                item.append(np.full(k, i))
        none = np.zeros(0, np.int64)
        self.start, self.length, self.item = (np.concatenate(x) if x else none for x in (start, length, item))
        # the window's shingles: runs of min(shingle, length) words
        self.k = np.minimum(shingle, self.length)
        self.kinds = sorted(set(self.k.tolist()))
        at_kind = {}
        for k in self.kinds:
            pos, h = w.shingles(int(k))
            table = np.zeros(len(w.hash), np.uint64)
            table[pos] = h
            at_kind[k] = table
        self.shingle_of = at_kind
        # a window has length - k + 1 shingles; the longest of its kind may have more
        spare = self.length - self.k
        places = {k: [self.start[(self.k == k) & (spare >= j)] + j for j in range(int(spare[self.k == k].max()) + 1)] for k in self.kinds}
        used = [at_kind[k][np.unique(np.concatenate(places[k]))] for k in self.kinds]
        self.keys = np.unique(np.concatenate(used)) if used else np.zeros(0, np.uint64)

    def choose(self, df: np.ndarray) -> None:
        """Prefix token of each window: its rarest shingle by ``df`` (aligned with ``keys``), ties by hash."""
        best, offset = np.zeros(len(self.start), np.uint64), np.zeros(len(self.start), np.int64)
        least = np.full(len(self.start), np.iinfo(np.int64).max)
        for k in self.kinds:
            rows = np.flatnonzero(self.k == k)
            for j in range(int((self.length - self.k)[rows].max()) + 1):
                r = rows[(self.length - self.k)[rows] >= j]
                h = self.shingle_of[k][self.start[r] + j]
                f = df[np.searchsorted(self.keys, h)]
                better = (f < least[r]) | ((f == least[r]) & (h < best[r]))
                r = r[better]
                best[r], least[r], offset[r] = h[better], f[better], j
        order = np.argsort(best, kind="stable")
        self.tokens, first = np.unique(best[order], return_index=True)
        self.first = np.append(first, len(order))
        self.by_token, self.offset = order, offset
        self.shingle_of = None  # only needed to choose


def _blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[tuple[list[str], list[str]]]:
    """Items with text, in blocks of bounded size (one item at least)."""
    rows = items.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t")).where("i is not null and t is not null")
    ids, texts, size = [], [], 0
    for r in rows.orderBy("i", "t").toLocalIterator():
        if ids and size + len(r.t) > block_bytes:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(r.i)
        texts.append(r.t)
        size += len(r.t)
    if ids:
        yield ids, texts


def _document_frequency(docs: DataFrame, text_col: str, index, n_keys: int, kinds: list[int]) -> np.ndarray:
    """Documents that hold each shingle of the block: counted in the tasks, summed by Spark."""
    def count(batches):
        lookup, total = Lookup(index.value["keys"]), np.zeros(n_keys, np.int64)
        for b in batches:
            buf, off = text_buffer(b.column(0))
            for lo, hi in row_slices(off):
                w = Words(buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], ALNUM_WORD)
                for k in kinds:
                    at, h = w.shingles(k)
                    i, key = lookup.find(h)
                    pair = np.unique(w.row[at[i]].astype(np.int64) * n_keys + key)
                    total += np.bincount(pair % n_keys, minlength=n_keys)
        k = np.flatnonzero(total)
        release()
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(total[k], pa.int64())], names=["k", "n"])

    out = np.zeros(n_keys, np.int64)
    for r in docs.select(text_col).mapInArrow(count, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).toLocalIterator():
        out[r.k] = r.n
    return out


def _matcher(index):
    """Task-side function: the column of hits of one batch of texts."""
    x = SimpleNamespace(**index.value)
    lookup = Lookup(x.tokens)

    def hits(col: pa.Array) -> pa.Array:
        buf, off = text_buffer(col)
        n_words, n_hit, items, spans = [], [], [], []
        for lo, hi in row_slices(off):
            w = Words(buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], ALNUM_WORD)
            size = (w.end - w.start).astype(np.int32)
            starts, wins = [], []
            for k in x.kinds:
                at, h = w.shingles(int(k))
                i, tok = lookup.find(h)
                if not len(i):
                    continue
                n = x.first[tok + 1] - x.first[tok]
                rep = np.repeat(np.arange(len(i)), n)
                win = x.by_token[x.first[tok][rep] + (np.arange(len(rep)) - np.repeat(np.cumsum(n) - n, n))]
                pos = at[i][rep]
                row = w.row[pos]
                begin = pos - x.offset[win]
                # position and length bounds: the window must lie inside this row's words
                ok = (x.k[win] == k) & (begin >= w.first[row]) & (begin + x.length[win] <= w.first[row + 1])
                begin, win = begin[ok], win[ok]
                for j in range(int(x.length[win].max()) if len(win) else 0):
                    more = j < x.length[win]
                    d, q = np.minimum(begin + j, len(size) - 1), np.minimum(x.start[win] + j, len(x.size) - 1)
                    same = ~more | ((w.hash[d] == x.hash[q]) & (size[d] == x.size[q]))
                    begin, win = begin[same], win[same]
                starts.append(begin)
                wins.append(win)
            begin = np.concatenate(starts) if starts else np.zeros(0, np.int64)
            win = np.concatenate(wins) if wins else np.zeros(0, np.int64)
            order = np.argsort(begin, kind="stable")
            begin, win = begin[order], win[order]
            cut = np.searchsorted(begin, w.first)
            for r in range(hi - lo):
                n_words.append(int(w.count[r]))
                a, z = cut[r], cut[r + 1]
                if a == z:
                    n_hit.append(0), items.append([]), spans.append([])
                    continue
                s, e = begin[a:z] - w.first[r], np.maximum.accumulate(begin[a:z] - w.first[r] + x.length[win[a:z]])
                new = np.append(True, s[1:] > e[:-1])
                s, e = s[new], e[np.append(np.flatnonzero(new)[1:] - 1, len(e) - 1)]
                n_hit.append(int((e - s).sum()))
                items.append(sorted({x.ids[i] for i in np.unique(x.item[win[a:z]])}))
                spans.append([{"start": int(p), "end": int(q)} for p, q in zip(s, e, strict=True)])
        return pa.StructArray.from_arrays([pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.string())), pa.array(spans, pa.list_(_SPAN))], fields=list(_HITS))
    return hits


def decontaminate(docs: DataFrame, items: DataFrame, *, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
                  window: int = WINDOW, shingle: int = SHINGLE, block_bytes: int = BLOCK_BYTES, into: str = "hits") -> DataFrame:
    """Every row and column of ``docs`` plus the struct ``into``: n_words, n_hit, sorted item ids, merged word spans."""
    if shingle > window or min(shingle, window) < 1:
        raise ValueError("need 1 <= shingle <= window")
    spark = docs.sparkSession
    docs = without(docs, into, text_col)
    parts = []
    for ids, texts in _blocks(items, item_id, item_text, block_bytes):
        x = WindowIndex(ids, texts, window, shingle)
        first = spark.sparkContext.broadcast(vars(x).copy())
        x.choose(_document_frequency(docs, text_col, first, len(x.keys), [int(k) for k in x.kinds]))
        index = spark.sparkContext.broadcast(vars(x).copy())
        parts.append(index)
    if not parts:
        parts = [spark.sparkContext.broadcast(vars(_empty_index(window, shingle)))]
    if len(parts) == 1:
        at = docs.columns.index(text_col)
        return append_column(docs, into, HITS, lambda: (lambda f: lambda b: f(b.column(at)))(_matcher(parts[0])))
    return _many_blocks(docs, text_col, parts, into)


def _empty_index(window: int, shingle: int) -> WindowIndex:
    x = WindowIndex([], [], window, shingle)
    x.choose(np.zeros(0, np.int64))
    return x


def _many_blocks(docs: DataFrame, text_col: str, parts: list, into: str) -> DataFrame:
    """Block by block over the distinct texts' digests; spans of all blocks are merged per digest, then joined back."""
    key = fresh_name(docs, "_digest")
    keyed = docs.withColumn(key, F.sha2(F.col(text_col).cast("binary"), 256))
    found = None
    for index in parts:
        part = append_column(keyed.select(key, F.col(text_col).alias("t")), "h", HITS, lambda index=index: (lambda f: lambda b: f(b.column(1)))(_matcher(index)))
        part = part.select(key, "h").where("h.n_hit > 0").groupBy(key).agg(F.first("h").alias("h"))
        found = part if found is None else found.unionByName(part)
    flat = lambda c, f: F.flatten(F.collect_list(f"h.{c}")) if f else None
    spans = F.array_sort(flat("spans", True))
    merged = F.aggregate(spans, F.array().cast(HITS["spans"].dataType), lambda acc, s: F.when(
        (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= s["start"]),
        F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end")))),
    ).otherwise(F.concat(acc, F.array(s))))
    found = found.groupBy(key).agg(F.max("h.n_words").alias("n_words"), F.array_sort(F.array_distinct(flat("items", True))).alias("items"), merged.alias("spans"))
    found = found.select(key, F.struct("n_words", F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"]).alias("n_hit"), "items", "spans").alias("_h"))
    at = [*docs.columns, key].index(text_col)
    plain, hit = fresh_name(keyed, "_w"), fresh_name(keyed, "_h")
    counted = append_column(keyed, plain, HITS, lambda: (lambda f: lambda b: f(b.column(at)))(_word_counter))
    return counted.join(found.withColumnRenamed("_h", hit), key, "left").select(*[F.col(f"`{c}`") for c in docs.columns], F.coalesce(hit, plain).alias(into))


def _word_counter(col: pa.Array) -> pa.Array:
    buf, off = text_buffer(col)
    n = [int(c) for lo, hi in row_slices(off) for c in Words(buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], ALNUM_WORD).count]
    return pa.array([{"n_words": c, "n_hit": 0, "items": [], "spans": []} for c in n], _HITS)


def is_contaminated(hits: str = "hits"):
    """The rule: a hit, and hit words at least a twentieth of the document's words."""
    return (F.col(f"{hits}.n_hit") > 0) & (F.col(f"{hits}.n_hit") * 20 >= F.col(f"{hits}.n_words"))


def op1_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id", F.col("hits.n_words").alias("n_words"), F.col("hits.n_hit").alias("n_hit"), F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("hits.items")).cast("binary"), 256).alias("items_sha256"), is_contaminated().alias("contaminated"))


# windows and document runs of the same number of words as text; covered words counted one by one
ORACLE_SQL = r"""
WITH item AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
win AS (SELECT DISTINCT item_id, CAST(least(13, len(ws)) AS INTEGER) AS k, unnest(list_transform(range(1, greatest(2, len(ws) - 11)), lambda i: array_to_string(ws[i:i + 12], ' '))) AS g FROM item WHERE len(ws) > 0),
doc AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
runs AS (SELECT r, k, ws, unnest(range(1, len(ws) - k + 2)) AS i FROM doc, (SELECT DISTINCT k FROM win) WHERE len(ws) >= k),
hits AS (SELECT runs.r, runs.i, runs.k, win.item_id FROM (SELECT r, i, k, array_to_string(ws[i:i + k - 1], ' ') AS g FROM runs) runs JOIN win ON win.k = runs.k AND win.g = runs.g),
covered AS (SELECT r, COUNT(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + k)) AS p FROM hits) GROUP BY r),
found AS (SELECT r, COUNT(DISTINCT item_id) AS n, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM hits GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, COALESCE(c.n, 0) AS n_hit, COALESCE(f.n, 0) AS n_items, sha256(COALESCE(f.ids, '')) AS items_sha256,
    COALESCE(c.n, 0) > 0 AND 20 * COALESCE(c.n, 0) >= len(ws) AS contaminated
FROM doc LEFT JOIN covered c ON c.r = doc.r LEFT JOIN found f ON f.r = doc.r
"""
