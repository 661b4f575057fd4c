"""Ranked lexical search by dual-tree traversal.

The query side (items) and the documents are both put into hierarchies. A node of the document tree holds, for every term, the
largest term score of its documents; a node of the item tree holds the weights of all terms of its items. The sum of weight times
largest term score bounds the score of every (item, document) pair below the two nodes, so a pair of nodes whose bound is below
the weakest k-th score of the node's items holds no result and the whole batch is skipped. What is left at the leaves is scored
exactly, in 64-bit integers. Nothing is approximate: the bound is never below a score, and equality isn't pruned.

Shape: the items are the stated side, read in blocks of at most ``block_bytes`` of text; one block's terms are broadcast
at a time. A pass over the documents keeps, per document, its length and the frequencies of the block's terms (a table in the
shared folder, far smaller than the texts); the counts N, L and df are aggregates over all documents. A search of a fixed share
of the documents (``1 / SEED``, chosen by a hash) gives every item a lower bound of its k-th score; with it as a start all
documents are searched, each task building the tree of its own rows. A task returns what reaches the bound, at most k rows an
item, so the rows that are ranked at the end don't grow with the number of tasks.

Defined results: null texts have no terms and count nowhere; items sharing an id are one item with the terms of all; items
without terms have no result; repeated document rows are documents of their own; equal scores rank by ascending document id, null
ids last. Terms are told apart by 64-bit hashes. Only the id and text columns are read, so other columns can't clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelrank.llm.arrays import ALNUM_WORD, Lookup, Words, release, row_slices, text_buffer
from panelrank.llm.store import Store

BLOCK_BYTES = 16 << 20
SEED = 32              # one document in so many gives the first bounds
LEAF = 4               # documents of a leaf
TREE = 4096            # most documents of a tree
NO_ID = np.iinfo(np.int64).max

MATCHES = "doc_id long, n long, terms array<int>, counts array<int>"


class Csr:
    """Rows of (term, value): ``first`` offsets into ``term`` and ``value``."""

    def __init__(self, first: np.ndarray, term: np.ndarray, value: np.ndarray):
        self.first, self.term, self.value = first, term, value

    def __len__(self) -> int:
        return len(self.first) - 1

    def entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions of these rows' entries, offsets of the rows among them)."""
        n = self.first[rows + 1] - self.first[rows]
        first = np.concatenate([[0], np.cumsum(n)])
        return np.repeat(self.first[rows] - first[:-1], n) + np.arange(first[-1]), first

    def paired(self, width: int = 2) -> Csr:
        """Rows of ``width`` neighbours each, a term with its largest value."""
        row = np.repeat(np.arange(len(self)), np.diff(self.first)) // width
        order = np.lexsort((-self.value, self.term, row))
        row, term, value = row[order], self.term[order], self.value[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (term[1:] != term[:-1])
        row, term, value = row[new], term[new], value[new]
        return Csr(np.searchsorted(row, np.arange(-(-len(self) // width) + 1)), term, value)


def levels(base: Csr) -> list[Csr]:
    """The base and its coarser levels, up to a single node."""
    out = [base]
    while len(out[-1]) > 1:
        out.append(out[-1].paired())
    return out


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums between offsets along the last axis; exact for whole doubles that add up below 2**53."""
    out = np.zeros((*values.shape[:-1], len(first) - 1))
    some = np.flatnonzero(first[1:] > first[:-1])
    if len(some):
        out[..., some] = np.add.reduceat(values, first[:-1][some], axis=-1)
    return out


class Items:
    """A block of items: ids, term hashes, and the tree over items; ``weigh`` sets the weights."""

    def __init__(self, ids: list, texts: list[list[str]]):
        buf, off = text_buffer(pa.array([" ".join(t) for t in texts], pa.string()))
        w = Words(buf, off, ALNUM_WORD)
        self.ids = ids
        self.keys = np.unique(w.hash)
        pair = np.unique(w.row.astype(np.int64) * max(1, len(self.keys)) + np.searchsorted(self.keys, w.hash))
        self.row, self.term = pair // max(1, len(self.keys)), (pair % max(1, len(self.keys))).astype(np.int64)

    def weigh(self, n_docs: int, df: np.ndarray) -> None:
        """Weights from document frequencies; items with a common rare term become neighbours."""
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(f) + 1))) for f in df], float)
        value = weight[self.term]
        n = len(self.ids)
        order = np.lexsort((self.term, -value, self.row))
        top = order[np.searchsorted(self.row[order], np.arange(n)).clip(max=max(0, len(order) - 1))] if len(order) else np.zeros(n, np.int64)
        rank = np.lexsort((np.arange(n), self.term[top] if len(order) else top))
        place = np.empty(n, np.int64)
        place[rank] = np.arange(n)
        self.ids = [self.ids[i] for i in rank]
        row = place[self.row]
        order = np.lexsort((self.term, row))
        self.tree = levels(Csr(np.searchsorted(row[order], np.arange(n + 1)), self.term[order], value[order]))


class Best:
    """The k best documents of every item seen so far, and the k-th scores, per level of the item tree."""

    def __init__(self, items: Items, k: int, start: np.ndarray):
        self.k, self.n = k, len(items.ids)
        self.kept: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(self.n)]
        self.held = np.zeros(self.n, np.int64)
        self.least = [start.astype(float)]
        while len(self.least[-1]) > 1:
            x = self.least[-1]
            self.least.append(np.minimum.reduceat(x, np.arange(0, len(x), 2)))

    def add(self, item: int, docs: np.ndarray, scores: np.ndarray) -> None:
        self.kept[item].append((docs, scores))
        self.held[item] += len(docs)
        if self.held[item] >= 4 * self.k:
            self.trim(item)

    def trim(self, item: int) -> tuple[np.ndarray, np.ndarray]:
        none = np.zeros(0, np.int64)
        docs, scores = (np.concatenate(x) for x in zip(*self.kept[item], strict=True)) if self.kept[item] else (none, none)
        order = np.lexsort((docs, -scores))[:self.k]
        docs, scores = docs[order], scores[order]
        self.kept[item], self.held[item] = [(docs, scores)], len(docs)
        if len(docs) == self.k and scores[-1] > self.least[0][item]:
            self.least[0][item] = scores[-1]
            for lo, up in zip(self.least[:-1], self.least[1:], strict=True):
                item //= 2
                up[item] = lo[2 * item:2 * item + 2].min()
        return docs, scores


def search_tree(items: Items, best: Best, docs: np.ndarray, impact: Csr) -> dict[str, int]:
    """Scores the documents of one tree (ids and term scores) against the items; counts of pairs seen and scored."""
    # documents of like weight become neighbours, so that light ones are pruned together
    weight = np.zeros(len(items.keys))
    weight[items.tree[0].term] = items.tree[0].value
    rank = np.argsort(-sums(weight[impact.term] * impact.value, impact.first), kind="stable")
    at, first = impact.entries(rank)
    docs, leafs = docs[rank], Csr(first, impact.term[at], impact.value[at])
    nodes = levels(leafs.paired(LEAF))
    top = len(items.tree) - 1
    vec = np.zeros(len(items.keys))
    counted = {"bounds": 0, "scored": 0, "pairs": len(docs) * len(items.ids)}

    def bounded(level: int, alive: np.ndarray) -> np.ndarray:
        tree = items.tree[level]
        e, f = tree.entries(alive) if len(alive) < len(tree) else (slice(None), tree.first)
        counted["bounds"] += len(alive)
        return alive[sums(vec[tree.term[e]] * tree.value[e], f) >= np.maximum(best.least[level][alive], 1)]

    def below(level: int, alive: np.ndarray) -> np.ndarray:
        kids = (2 * alive[:, None] + np.arange(2)).ravel()
        return kids[kids < len(items.tree[level - 1])]

    stack = [(len(nodes) - 1, 0, top, np.arange(1))]
    while stack:
        level, j, depth, alive = stack.pop()
        node = nodes[level]
        s = slice(node.first[j], node.first[j + 1])
        vec[node.term[s]] = node.value[s]
        alive = bounded(depth, alive)
        while len(alive) and depth and (level == 0 or depth > level * max(1, top) // max(1, len(nodes))):
            depth, alive = depth - 1, below(depth, alive)
            alive = bounded(depth, alive)
        vec[node.term[s]] = 0
        if not len(alive):
            continue
        if level:
            stack += [(level - 1, c, depth, alive) for c in (2 * j + 1, 2 * j) if c < len(nodes[level - 1])]
            continue
        lo, hi = j * LEAF, min(len(docs), (j + 1) * LEAF)
        s = slice(leafs.first[lo], leafs.first[hi])
        grid = np.zeros((hi - lo, len(items.keys)))
        grid[np.repeat(np.arange(hi - lo), np.diff(leafs.first[lo:hi + 1])), leafs.term[s]] = leafs.value[s]
        tree = items.tree[0]
        e, f = tree.entries(alive)
        scores = sums(grid[:, tree.term[e]] * tree.value[e], f)
        counted["scored"] += scores.size
        good = scores >= np.maximum(best.least[0][alive], 1)
        for c in np.flatnonzero(good.any(0)).tolist():
            r = np.flatnonzero(good[:, c])
            best.add(int(alive[c]), docs[lo + r], scores[r, c].astype(np.int64))
    return counted


def _blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[Items]:
    """Items with text, in blocks of bounded size; rows of one id stay together."""
    rows = items.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).where("t is not null")
    ids, texts, size = [], [], 0
    for r in rows.orderBy("i", "t").toLocalIterator():
        if ids and r.i == ids[-1]:
            texts[-1].append(r.t)
        else:
            if ids and size + len(r.t) > block_bytes:
                yield Items(ids, texts)
                ids, texts, size = [], [], 0
            ids.append(r.i)
            texts.append([r.t])
        size += len(r.t)
    if ids:
        yield Items(ids, texts)


def _matches(docs: DataFrame, id_col: str, text_col: str, keys) -> DataFrame:
    """Documents with terms: length n, and the block's terms with their frequencies."""
    def run(batches):
        lookup = Lookup(keys.value)
        width = max(1, len(keys.value))
        for b in batches:
            buf, off = text_buffer(b.column(1))
            for lo, hi in row_slices(off):
                w = Words(buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], ALNUM_WORD)
                i, key = lookup.find(w.hash)
                pair, count = np.unique(w.row[i].astype(np.int64) * width + key, return_counts=True)
                rows = np.flatnonzero(w.count)
                first = np.searchsorted(pair // width, np.append(rows, hi - lo)).astype(np.int32)
                if len(rows):
                    yield pa.RecordBatch.from_arrays([
                        b.column(0).take(pa.array(lo + rows)), pa.array(w.count[rows].astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(first), pa.array((pair % width).astype(np.int32))),
                        pa.ListArray.from_arrays(pa.array(first), pa.array(count.astype(np.int32)))], names=["doc_id", "n", "terms", "counts"])
        release()
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t")).mapInArrow(run, MATCHES)


def _search(rows: DataFrame, block, k: int, n_docs: int, n_terms: int, start, id_type: T.DataType) -> DataFrame:
    """Up to k (item_id, doc_id, score) per item and task, all that may belong to the k best."""
    schema = T.StructType([T.StructField("place", T.IntegerType()), T.StructField("item_id", id_type), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])

    def run(batches):
        items, first_bounds = block.value, start.value
        best = Best(items, k, first_bounds)
        for b in batches:
            ids, n = b.column(0).fill_null(NO_ID).to_numpy(), b.column(1).to_numpy()
            m = np.array([50 + 50 * int(x) * n_docs // n_terms for x in n.tolist()], np.int64)
            off = b.column(2).offsets.to_numpy().astype(np.int64)
            terms, tf = b.column(2).values.to_numpy(), b.column(3).values.to_numpy().astype(np.int64)
            for lo in range(0, len(ids), TREE):
                hi = min(len(ids), lo + TREE)
                s = slice(off[lo], off[hi])
                f = off[lo:hi + 1] - off[lo]
                impact = 1_000_000_000 * tf[s] // (1000 * tf[s] + 20 * np.repeat(m[lo:hi], np.diff(f)))
                search_tree(items, best, ids[lo:hi], Csr(f, terms[s].astype(np.int64), impact.astype(float)))
        got = [(i, *best.trim(i)) for i in range(best.n)]
        got = [g for g in got if len(g[1])]
        place = np.concatenate([np.full(len(g[1]), g[0], np.int32) for g in got]) if got else np.zeros(0, np.int32)
        docs = np.concatenate([g[1] for g in got]) if got else np.zeros(0, np.int64)
        scores = np.concatenate([g[2] for g in got]) if got else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([
            pa.array(place), pa.array([items.ids[p] for p in place.tolist()], arrow_type), pa.array(docs, mask=docs == NO_ID), pa.array(scores)], names=schema.names)
        release()

    from pyspark.sql.pandas.types import to_arrow_type

    arrow_type = to_arrow_type(id_type)
    return rows.mapInArrow(run, schema)


def search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of every item."""
    spark = docs.sparkSession
    store = Store(spark, "lexical-search")
    id_type = items.schema[item_id].dataType
    by = Window.partitionBy("place").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    parts = []
    for b, found in enumerate(_blocks(items, item_id, item_text, block_bytes)):
        if not len(found.keys):
            continue
        keys = spark.sparkContext.broadcast(found.keys)
        rows = store.write(_matches(docs, id_col, text_col, keys), f"matches-{b}")
        size = rows.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = np.zeros(len(found.keys), np.int64)
        for r in rows.select(F.explode("terms").alias("t")).groupBy("t").count().toLocalIterator():
            df[r.t] = r["count"]
        found.weigh(size[0], df)
        block, start = spark.sparkContext.broadcast(found), spark.sparkContext.broadcast(np.zeros(len(found.ids)))
        share = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(SEED)) == 0)
        first = _search(share, block, k, size[0], max(1, size[1]), start, id_type).withColumn("rank", F.row_number().over(by)).where(F.col("rank") == k)
        bounds = np.zeros(len(found.ids))
        for r in first.select("place", "score").toLocalIterator():
            bounds[r.place] = r.score
        start.unpersist()
        start = spark.sparkContext.broadcast(bounds)
        best = _search(rows, block, k, size[0], max(1, size[1]), start, id_type).withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
        parts.append(store.write(best.select("item_id", "rank", "doc_id", "score"), f"best-{b}"))
        store.drop(f"matches-{b}")
        for x in (keys, block, start):
            x.unpersist()
    if not parts:
        return spark.createDataFrame([], T.StructType([T.StructField("item_id", id_type), T.StructField("rank", T.IntegerType()), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def op11_lexical_search(spark, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ORACLE_SQL = r"""
WITH docs AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents WHERE text IS NOT NULL),
size AS (SELECT doc_id, row_number() OVER () AS r, ws, CAST(len(ws) AS BIGINT) AS n FROM docs WHERE len(ws) > 0),
total AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM size),
item_terms AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM benchmark),
tf AS (SELECT r, doc_id, n, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, doc_id, n, unnest(ws) AS term FROM size) GROUP BY ALL),
held AS (SELECT tf.* FROM tf SEMI JOIN item_terms USING (term)),
weight AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM held, total GROUP BY term, n_docs),
scored AS (
    SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms)))) AS BIGINT) AS score
    FROM held JOIN weight USING (term) JOIN item_terms USING (term), total GROUP BY item_id, r, doc_id),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 50
"""
