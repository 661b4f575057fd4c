"""Exact n-gram Jaccard join by vertical partitioning.

Texts are sets of 5-word shingles (64-bit hashes); the hash order is the global n-gram order, cut into ranges
(fragments). The steps:

1. ``text_sets``: set size and a 128-bit set signature per row; rows with equal sets are one class.
2. Each task packs the shingles of its texts, sorted and cut by fragment, into one compressed blob per fragment;
   a fragment's reducer merges them, counts the classes of each shingle and keeps the shingles of two classes or more.
   Fragments grow in number with the corpus, so each holds about ``FRAGMENT_ROWS`` postings, copies included.
3. The kept shingles go, packed, to buckets of classes. A class whose shared shingles are fewer than the threshold
   times its set can't link and leaves. The others keep their rarest shared shingles (class count, then hash) as
   prefix: two linked sets have a common prefix shingle.
4. Star rounds: each class is paired with one other, the member of its prefix lists with the largest shared part, so
   a group of near copies costs a row per member and not per pair. A pair's overlap is counted in each part of the
   n-gram order by itself and summed.
5. Exact rest: prefix lists that still span several components give their remaining cross-component pairs, after the
   length bound, the shared-count bound and the bitmap bound (a bit that one side lacks is a shingle that it lacks);
   these are counted likewise. Pairs inside one component change nothing.

Counts, thresholds and candidates cover all rows. Defined results: null, empty and wordless texts have an empty set and
link with nothing; fewer words than the shingle length make one shingle; repeated rows are one class; a null id belongs to no
component (null); texts that share an id are separate rows, and classes with the same smallest id are one node.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelrank.llm.arrays import SPACE_WORD, Words, append_column, fresh_name, mix, release, row_slices, text_buffer
from panelrank.llm.components import components
from panelrank.llm.store import Store

SHINGLE = 5
NUM, DEN = 80, 100               # link: DEN * intersection >= NUM * union
FRAGMENT_ROWS = 4_000_000        # postings of a fragment, and at most of a class bucket
SUB_BITS = 2                     # a fragment is merged in 2**SUB_BITS sub-ranges, one after another
SLICE = 4 << 20                  # bytes of text sorted at once
STAR_ROUNDS = 2                  # rounds with one pair per class before the exact rest
WORDS_OF_BITS = 16               # 64-bit words of a class's bitmap of shared shingles
PARTS = 8                        # ranges of the n-gram order in which a pair's overlap is counted (a power of two)

SETS = T.StructType([T.StructField(c, T.LongType()) for c in ("n", "sig", "sig2")])
_SETS = pa.struct([(c, pa.int64()) for c in ("n", "sig", "sig2")])


def _sets(buf: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of some rows: distinct (hash, row) sorted by hash, set sizes and signatures (two words each)."""
    w = Words(buf, off, SPACE_WORD)
    at, h = w.shingles(k)
    row = w.row[at]
    short = np.flatnonzero((w.count > 0) & (w.count < k))
    if len(short):
        sh = np.zeros(len(short), np.uint64)
        for j in range(k - 1):
            more = w.count[short] > j
            sh[more] = mix(sh[more] + w.hash[w.first[short[more]] + j]) + np.uint64(j + 1)
        h, row = np.concatenate([h, mix(sh)]), np.concatenate([row, short])
    order = np.lexsort((row, h)) if len(short) else np.argsort(h, kind="stable")  # rows ascend already
    h, row = h[order], row[order]
    if len(h):
        new = np.append(True, (h[1:] != h[:-1]) | (row[1:] != row[:-1]))
        h, row = h[new], row[new]
    n = np.bincount(row, minlength=len(off) - 1)
    sig = np.zeros((len(off) - 1, 2), np.uint64)
    np.add.at(sig[:, 0], row, mix(h + np.uint64(0x51ED27)))
    np.add.at(sig[:, 1], row, mix(h * np.uint64(0x2545F4914F6CDD1D) + np.uint64(7)))
    sig[:, 0] ^= n.astype(np.uint64)
    return h, row, n, sig


def text_sets(docs: DataFrame, text_col: str = "text", into: str = "set", k: int = SHINGLE) -> DataFrame:
    """``docs`` plus the struct ``into`` (n: set size, sig and sig2: 128-bit signature of the shingle set)."""
    at = docs.columns.index(text_col)

    def make():
        def fn(b):
            buf, off = text_buffer(b.column(at))
            got = [_sets(buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], k)[2:] for lo, hi in row_slices(off, SLICE)]
            n = np.concatenate([g[0] for g in got] or [np.zeros(0, np.int64)])
            sig = np.concatenate([g[1] for g in got] or [np.zeros((0, 2), np.uint64)]).view(np.int64)
            return pa.StructArray.from_arrays([pa.array(n.astype(np.int64)), pa.array(sig[:, 0].copy()), pa.array(sig[:, 1].copy())], fields=list(_SETS))
        return fn
    return append_column(docs, into, SETS, make)


def _planes(x: np.ndarray) -> bytes:
    """Bytes of the numbers, most alike together: all first bytes, then all second bytes, and so on."""
    return np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def _squeeze(*columns: np.ndarray) -> bytes:
    body = b"".join([np.int64(len(columns[0])).tobytes(), *map(_planes, columns)])
    return np.int64(len(body)).tobytes() + pa.Codec("zstd", compression_level=1).compress(body, asbytes=True)


def _expand(blob: bytes, *kinds: type) -> list[np.ndarray]:
    body = pa.Codec("zstd").decompress(blob[8:], int(np.frombuffer(blob, np.int64, 1)[0]), asbytes=True)
    n, at, out = int(np.frombuffer(body, np.int64, 1)[0]), 8, []
    for kind in kinds:
        w = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(np.frombuffer(body, np.uint8, w * n, at).reshape(w, n).T).view(kind).ravel())
        at += w * n
    return out


def _join_blobs(parts: list[bytes]) -> bytes:
    return np.array([len(parts), *map(len, parts)], np.int64).tobytes() + b"".join(parts)


def _split_blobs(blob: bytes) -> list[bytes]:
    size = np.frombuffer(blob, np.int64, 1 + int(np.frombuffer(blob, np.int64, 1)[0]))[1:]
    end = 8 * (len(size) + 1) + np.cumsum(size)
    return [blob[e - z:e] for e, z in zip(end, size, strict=True)]


def _edges(h: np.ndarray, bits: int) -> np.ndarray:
    """Where the sorted hashes pass from one of the 2**bits equal ranges to the next."""
    cuts = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(0, np.uint64)
    return np.concatenate([[0], np.searchsorted(h, cuts), [len(h)]])


def _postings(docs: DataFrame, text_col: str, bits: int, k: int) -> DataFrame:
    """(fragment, blob): the shingles of a slice of texts that fall into one range of the n-gram order.

    A blob holds the texts' (signature, set size) once, then the (text, hash) columns of each sub-range.
    """
    def run(batches):
        for b in batches:
            buf, off = text_buffer(b.column(0))
            for lo, hi in row_slices(off, SLICE):
                h, row, n, sig = _sets(buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], k)
                edge = _edges(h, bits + SUB_BITS)
                at, blobs = [], []
                for f in range(1 << bits):
                    e = edge[f << SUB_BITS:((f + 1) << SUB_BITS) + 1]
                    if e[-1] > e[0]:
                        used, who = np.unique(row[e[0]:e[-1]], return_inverse=True)
                        who = who.astype(np.uint32)
                        at.append(f)
                        blobs.append(_join_blobs([_squeeze(sig[used, 0], n[used].astype(np.uint32)), *(_squeeze(who[p - e[0]:q - e[0]], h[p:q]) for p, q in zip(e[:-1], e[1:], strict=True))]))
                    if at and (len(at) >= 256 or f + 1 == 1 << bits):
                        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(blobs, pa.binary())], names=["fragment", "blob"])
                        at, blobs = [], []
                if at:
                    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(blobs, pa.binary())], names=["fragment", "blob"])
        release()
    return docs.select(text_col).mapInArrow(run, "fragment long, blob binary")


def _classes_of(tables: list[list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct (signature, size) of several tables, sorted, and each table's entries as positions among them."""
    sig, n = (np.concatenate([t[i] for t in tables]) for i in (0, 1))
    order = np.lexsort((n, sig))
    new = np.append(True, (sig[order][1:] != sig[order][:-1]) | (n[order][1:] != n[order][:-1]))
    dense = np.empty(len(order), np.uint32)
    dense[order] = np.cumsum(new) - 1
    return sig[order][new], n[order][new], np.split(dense, np.cumsum([len(t[0]) for t in tables])[:-1])


def _shared(table: pa.Table, bits: int) -> pa.Table:
    """One fragment: the shingles that two classes or more have, with their class counts, packed by class bucket."""
    blobs = [_split_blobs(x.as_py()) for x in table.column("blob")]
    sig, n, place = _classes_of([_expand(x[0], np.uint64, np.uint32) for x in blobs])
    found = []
    for sub in range(1, 1 + (1 << SUB_BITS)):
        part = [_expand(x[sub], np.uint32, np.uint64) for x in blobs]
        who, h = np.concatenate([p[w] for (w, _), p in zip(part, place, strict=True)]), np.concatenate([h for _, h in part])
        del part
        order = np.lexsort((who, h))
        h, who = h[order], who[order]
        if len(h):
            new = np.append(True, (h[1:] != h[:-1]) | (who[1:] != who[:-1]))
            h, who = h[new], who[new]
        first = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)
        df = np.diff(np.append(first, len(h)))
        df = np.repeat(df, df)
        found.append((who[df > 1], h[df > 1], df[df > 1].astype(np.uint32)))
    release()
    who, h, df = (np.concatenate([f[i] for f in found]) for i in range(3))
    order = np.argsort(who, kind="stable")
    who, h, df = who[order], h[order], df[order]
    edge = _edges(sig, bits)                       # classes are sorted by signature: a bucket is a range of them
    cut = np.searchsorted(who, edge)
    at = np.flatnonzero(cut[1:] > cut[:-1])
    packed = []
    for b in at:
        w = who[cut[b]:cut[b + 1]]
        used, local = np.unique(w, return_inverse=True)
        packed.append(_join_blobs([_squeeze(sig[used], n[used]), _squeeze(local.astype(np.uint32), h[cut[b]:cut[b + 1]], df[cut[b]:cut[b + 1]])]))
    return pa.table({"bucket": pa.array(at, pa.int64()), "blob": pa.array(packed, pa.binary())})


def _candidates(table: pa.Table) -> pa.Table:
    """One bucket of classes: those whose shared shingles suffice to link, cut into parts, with their prefix shingles."""
    blobs = [_split_blobs(x.as_py()) for x in table.column("blob")]
    sig, n, place = _classes_of([_expand(x[0], np.uint64, np.uint32) for x in blobs])
    part = [_expand(x[1], np.uint32, np.uint64, np.uint32) for x in blobs]
    who = np.concatenate([p[w[0]] for w, p in zip(part, place, strict=True)])
    h, df = (np.concatenate([w[i] for w in part]) for i in (1, 2))
    del part, blobs
    n = n.astype(np.int64)
    s = np.bincount(who, minlength=len(n))
    able = DEN * s >= NUM * n
    keep = able[who]
    who, h, df = who[keep], h[keep], df[keep]
    # prefix: the rarest shared shingles; those of one class only come first in the order and are passed over
    order = np.lexsort((h, df, who))
    first = np.searchsorted(who[order], np.arange(len(n) + 1))
    length = np.maximum(1, n + (-(NUM * n) // DEN) + 1 - (n - s))
    rank = np.arange(len(who)) - first[who[order]]
    pre = order[rank < length[who[order]]]
    prefix_of = np.searchsorted(who[pre], np.arange(len(n) + 1))
    order = np.lexsort((h, who))
    who, h, prefix = who[order], h[order], h[pre]
    key = who.astype(np.int64) * PARTS + (h >> np.uint64(64 - PARTS.bit_length() + 1)).astype(np.int64)
    start = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    c = who[start].astype(np.int64)
    lead = np.append(True, c[1:] != c[:-1]) if len(c) else np.zeros(0, bool)
    size = np.where(lead, prefix_of[c + 1] - prefix_of[c], 0)  # the class's first row carries its prefix
    bits = np.zeros((len(n), WORDS_OF_BITS), np.uint64)
    bit = mix(h) & np.uint64(64 * WORDS_OF_BITS - 1)
    np.bitwise_or.at(bits, (who, (bit >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (bit & np.uint64(63)))
    off = lambda x: pa.array(x, pa.int32())
    return pa.table({
        "sig": pa.array(sig[c].view(np.int64)), "n": pa.array(n[c]), "s": pa.array(s[c]), "part": pa.array(key[start] % PARTS),
        "grams": pa.ListArray.from_arrays(off(np.append(start, len(h))), pa.array(h.view(np.int64))),
        "prefix": pa.ListArray.from_arrays(off(np.concatenate([[0], np.cumsum(size)])), pa.array(prefix.view(np.int64))),
        "bits": pa.ListArray.from_arrays(off(np.append(0, np.cumsum(lead * WORDS_OF_BITS))), pa.array(bits[c[lead]].ravel().view(np.int64))),
    })


def _may_link(nx: str, sx: str, ny: str, sy: str):
    """Length bound, and the shared-count bound: the overlap can't exceed either side's shared shingles."""
    return F.expr(f"{DEN} * least({nx}, {ny}) >= {NUM} * greatest({nx}, {ny}) and {NUM + DEN} * least({sx}, {sy}) >= {NUM} * ({nx} + {ny})")


def _only(x: str, y: str) -> str:
    """SQL for the bits that only ``x`` has: each stands for at least one shingle that ``y`` lacks."""
    return "(" + " + ".join(f"bit_count({x}[{i}] & ~{y}[{i}])" for i in range(WORDS_OF_BITS)) + ")"


def _linked(pairs: DataFrame, grams: DataFrame) -> DataFrame:
    """Pairs (a, na, b, nb) that link: partial overlaps per range of the n-gram order, summed per pair."""
    left = pairs.join(grams.select(F.col("id").alias("a"), "part", F.col("grams").alias("ga")), "a")
    both = left.join(grams.select(F.col("id").alias("b"), "part", F.col("grams").alias("gb")), ["b", "part"])
    total = both.select("a", "na", "b", "nb", F.size(F.array_intersect("ga", "gb")).alias("o")).groupBy("a", "na", "b", "nb").agg(F.sum("o").alias("o"))
    return total.where(f"{NUM + DEN} * o >= {NUM} * (na + nb)").select("a", "b")


def _spread(prefix: DataFrame, label: DataFrame | None) -> DataFrame:
    """Members (gram, id, n, s, c: component) of the prefix lists that span components and can still link there.

    A member stays only if the smallest set of its list that the length bound allows could overlap enough.
    """
    if label is None:
        member = prefix.withColumn("c", F.col("id"))
    else:
        member = prefix.join(label, F.col("id") == F.col("node"), "left").select("gram", "id", "n", "s", F.coalesce("component", "id").alias("c"))
    spans = lambda m: m.groupBy("gram").agg(F.min("n").alias("least"), F.min("c").alias("c0"), F.max("c").alias("c1")).where("c0 <> c1").select("gram", "least")
    able = member.join(spans(member), "gram").where(f"{NUM + DEN} * s >= {NUM} * (n + greatest(least, cast(ceil({NUM} * n / {DEN}) as long)))").drop("least")
    return able.join(spans(able).select("gram"), "gram")


def _star(member: DataFrame) -> DataFrame:
    """One pair (a, na, b, nb) per class at most: the best member of another component over all of its lists.

    A list offers its best member, and the best one outside that member's component; best: the largest shared part.
    """
    rank = F.struct((F.col("s") / F.col("n")).alias("r"), F.col("n").alias("nb"), F.col("s").alias("sb"), F.col("id").alias("b"), F.col("c").alias("cb"))
    of_c = member.groupBy("gram", "c").agg(F.max(rank).alias("best"))
    one = of_c.groupBy("gram").agg(F.max("best").alias("one"))
    two = of_c.join(one, "gram").where("c <> one.cb").groupBy("gram").agg(F.max("best").alias("two"), F.first("one").alias("one"))
    offer = member.join(two, "gram").withColumn("o", F.when(F.col("c") == F.col("one.cb"), F.col("two")).otherwise(F.col("one")))
    offer = offer.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("s").alias("sa"), "o").where(_may_link("na", "sa", "o.nb", "o.sb"))
    best = offer.groupBy("a", "na").agg(F.max("o").alias("o")).select("a", "na", F.col("o.b").alias("b"), F.col("o.nb").alias("nb"))
    return best.select(*_ordered("a", "na", "b", "nb")).distinct()


def _ordered(a: str, na: str, b: str, nb: str) -> list:
    """The pair's columns a, na, b, nb with the smaller id first."""
    up = F.col(a) < F.col(b)
    pick = lambda x, y, name: F.when(up, F.col(x)).otherwise(F.col(y)).alias(name)
    return [pick(a, b, "a"), pick(na, nb, "na"), pick(b, a, "b"), pick(nb, na, "nb")]


def _as_edges(label: DataFrame) -> DataFrame:
    return label.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE, fragment_rows: int = FRAGMENT_ROWS) -> DataFrame:
    """Per row: id, set size ``n``, set signature (``sig``, ``sig2``) and ``component`` (smallest id reachable over links)."""
    spark = docs.sparkSession
    store = Store(spark, "jaccard")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
    sets = store.write(text_sets(rows, "t", "s", k).select("id", "s.n", "s.sig", "s.sig2"), "sets")
    classes = store.write(sets.where("n > 0 and id is not null").groupBy("sig", "sig2", "n").agg(F.min("id").alias("cid")), "classes")
    total = sets.agg(F.sum("n")).first()[0] or 0
    bits = int(np.ceil(np.log2(max(1, total / fragment_rows))))
    shared = _postings(rows, "t", bits, k).groupBy("fragment").applyInArrow(lambda t: _shared(t, bits), "bucket long, blob binary")
    able = shared.groupBy("bucket").applyInArrow(_candidates, "sig long, n long, s long, part long, grams array<long>, prefix array<long>, bits array<long>")
    grams = store.write(able.join(classes, ["sig", "n"]).withColumnRenamed("cid", "id").drop("sig", "sig2"), "grams")
    prefix = store.write(grams.select("id", "n", "s", F.explode("prefix").alias("gram")), "prefix")
    label, tested = None, None
    for i in range(STAR_ROUNDS):
        pairs = _star(_spread(prefix, label))
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = store.write(pairs, f"pairs-{i}")
        found = store.write(_linked(pairs, grams), f"links-{i}")
        both = pairs.select("a", "b")
        tested = both if tested is None else tested.unionByName(both)
        label = store.write(components(found if label is None else _as_edges(label).unionByName(found), store, f"cc-{i}"), f"label-{i}")
    # exact rest: the pairs of lists that still span components
    member = store.write(_spread(prefix, label), "member")
    marked = member.join(grams.where(F.size("bits") > 0).select("id", "bits"), "id")
    # a list's largest component needs no pairs of its own: only members outside it look for partners
    largest = member.groupBy("gram", "c").count().groupBy("gram").agg(F.max_by("c", F.struct("count", "c")).alias("main"))
    marked = marked.join(largest, "gram")
    side = lambda x: marked.select("gram", "main", *(F.col(c).alias(f"{c}{x}") for c in ("id", "n", "s", "c", "bits")))
    rest = side("a").where("ca <> main").join(side("b").drop("main"), "gram").where("ca <> cb and (cb = main or ida < idb)").where(_may_link("na", "sa", "nb", "sb"))
    rest = rest.where(f"{NUM + DEN} * least(sa - {_only('bitsa', 'bitsb')}, sb - {_only('bitsb', 'bitsa')}) >= {NUM} * (na + nb)")
    rest = rest.select(*_ordered("ida", "na", "idb", "nb")).distinct().join(tested, ["a", "b"], "left_anti")
    more = store.write(_linked(rest, grams), "links-rest")
    final = store.write(components(_as_edges(label).unionByName(more), store, "cc-rest"), "final")
    store.drop("grams", "prefix", "member", "links-rest", *(f"{x}-{i}" for x in ("pairs", "links", "label") for i in range(STAR_ROUNDS)))
    of_class = classes.join(final, F.col("cid") == F.col("node"), "left").select("sig", "sig2", "n", F.coalesce("component", "cid").alias("component"))
    out = sets.join(of_class, ["sig", "sig2", "n"], "left")
    return out.select("id", "n", "sig", "sig2", F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id (one of its repeated rows).

    Rows with a null id belong to no component and all stay.
    """
    out = near_duplicates(docs, id_col, text_col)
    name, key = fresh_name(docs, "_gone"), fresh_name(docs, "_digest")
    gone = out.where("component <> id").select(F.col("id").alias(name)).distinct()
    kept = docs.join(gone, docs[id_col].cast("long") == F.col(name), "left_anti")
    named = kept.withColumn(key, F.when(F.col(id_col).isNull(), F.uuid()).otherwise(F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256)))
    return named.dropDuplicates([id_col, key]).drop(key)


def op5_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


# shingles as text, common ones counted per pair of documents, and the smallest id reachable over links
ORACLE_SQL = r"""
WITH RECURSIVE doc AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
sh AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM doc),
size AS (SELECT doc_id, COUNT(*) AS n FROM sh GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, COUNT(*) AS c FROM sh x JOIN sh y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM common JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b WHERE 100 * c >= 80 * (p.n + q.n - c)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(node, root) AS (SELECT doc_id, doc_id FROM doc UNION SELECT edge.b, reach.root FROM reach JOIN edge ON edge.a = reach.node AND reach.root < edge.b)
SELECT doc_id, COALESCE(n, 0) AS n_shingles, root AS component_id FROM (SELECT node AS doc_id, MIN(root) AS root FROM reach GROUP BY node) LEFT JOIN size USING (doc_id)
"""
