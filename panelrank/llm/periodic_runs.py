"""Runs of repeated words by block convolution.

A run is a stretch of consecutive words with smallest period q (words q apart are identical), at least ``max(12, 2 * q)`` long,
that no neighbouring word extends. Blocks of B = 2, 4, 8, ... words are laid over the text. A run with a period of ``2B - 1`` to
``4B - 2`` words (the first scale: 1 to 6) holds a whole block whose copy one period on is in the run too, so at each scale the
sum of squared differences between the block and the window that follows it is taken at every such distance. The sums come from
a number-theoretic transform: integers modulo a prime, exact, zero wherever block and window agree. Distances of zero sums seed
extensions to both sides, and the runs found are compared word by word, so a sum that is only a multiple of the prime, or two
stretches of equal hash, can't pass for a run.

Two kinds of blocks can't find anything new and aren't transformed: those with a word that doesn't recur within reach, and those
whose whole reach lies in a run already found with a period of B words or less (all its matches are multiples of that period).

Documents of a batch are laid end to end with a word of its own between them, so short ones share the numpy calls. No shuffle;
memory follows the longest text. A block longer than ``MAX_BLOCK`` words is represented by its first ``MAX_BLOCK``.

Defined results: null, empty and white-space texts have no words and no runs; repeated rows each give a row; columns whose names
clash with the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelrank.llm.arrays import fresh_name, release

LEAST = 12                     # shortest run
PRIME, ROOT = 7340033, 3       # 7 * 2**20 + 1: 128 products of residues add up exactly in a double
DIRECT = 128                   # longest transform taken as one matrix product
MAX_BLOCK = 1 << 17            # transforms are at most 2**19 long
CELLS = 1 << 18                # numbers transformed at once
SLICE_WORDS = 1 << 16          # words of short documents handled together
HASH_PRIMES, HASH_BASE = (2147483629, 2147483587), 1000003

Runs = list[tuple[int, int, int]]  # start, length, period

RUN = T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("period", T.LongType())])
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _mod(x: np.ndarray) -> np.ndarray:
    """Residues of whole doubles below 2**53 in size."""
    return x - np.floor(x / PRIME) * PRIME


class Transform:
    """Number-theoretic transforms of length n, along the last axis."""

    def __init__(self):
        self.kept: dict[tuple[int, bool], tuple] = {}

    def __reduce__(self):
        return Transform, ()

    def _powers(self, n: int, back: bool) -> np.ndarray:
        w = pow(ROOT, (PRIME - 1) // n, PRIME)
        if back:
            w = pow(w, -1, PRIME)
        out = np.ones(1)
        while len(out) < n:
            out = np.concatenate([out, _mod(out * float(pow(w, len(out), PRIME)))])
        return out

    def _plan(self, n: int, back: bool) -> tuple:
        plan = self.kept.get((n, back))
        if plan is None:
            p = self._powers(n, back)
            if n <= DIRECT:
                i = np.arange(n)
                plan = (p[np.outer(i, i) % n],)
            else:
                a = 1 << (n.bit_length() // 2)
                plan = (a, n // a, p[np.outer(np.arange(a), np.arange(n // a))])
            self.kept[n, back] = plan
        return plan

    def __call__(self, x: np.ndarray, back: bool = False) -> np.ndarray:
        n = x.shape[-1]
        plan = self._plan(n, back)
        if n <= DIRECT:
            return _mod(x @ plan[0])
        a, b, twist = plan
        # columns, twiddle factors, rows: index i1 * b + i2 in, k1 + a * k2 out
        y = self(np.ascontiguousarray(np.swapaxes(x.reshape(-1, a, b), 1, 2)), back)
        y = self(_mod(np.swapaxes(y, 1, 2) * twist), back)
        return np.ascontiguousarray(np.swapaxes(y, 1, 2)).reshape(x.shape)


NTT = Transform()


def zero_sums(words: np.ndarray, at: np.ndarray, block: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(index into ``at``, distance) where the squared differences between the block at ``at`` and the words ``distance`` on
    add up to zero modulo the prime; distances ``low`` to ``high``. ``words`` reaches beyond every window."""
    n, width = 4 * block, high - low + block
    rows = max(1, CELLS // n)
    inverse = float(pow(n, -1, PRIME))
    which, far = [], []
    for lo in range(0, len(at), rows):
        x = at[lo:lo + rows, None]
        a = words[x + np.arange(block)].astype(float)
        b = words[x + low + np.arange(width)].astype(float)
        pad = np.zeros((len(x), n))
        pad[:, :block] = a[:, ::-1]
        wide = np.zeros((len(x), n))
        wide[:, :width] = b
        # the product of the reversed block and the window holds the sum of products at distance low + d in place block - 1 + d
        cross = _mod(NTT(_mod(NTT(pad) * NTT(wide)), back=True) * inverse)[:, block - 1:width]
        squares = np.concatenate([np.zeros((len(x), 1)), np.cumsum(_mod(b * b), axis=1)], axis=1)
        total = _mod(_mod(squares[:, block:] - squares[:, :-block]) + _mod(np.sum(_mod(a * a), axis=1))[:, None] - 2 * cross)
        i, d = np.nonzero(total == 0)
        which.append(i + lo)
        far.append(d + low)
    none = np.zeros(0, np.int64)
    return (np.concatenate(which), np.concatenate(far)) if which else (none, none)


class Extender:
    """Longest common extensions of pairs of places, from prefix hashes modulo two primes."""

    def __init__(self, words: np.ndarray):
        self.n = len(words)
        self.sums, self.powers = [], []
        for p in HASH_PRIMES:
            pw = np.ones(1, np.int64)
            while len(pw) <= self.n:
                pw = np.concatenate([pw, pw * pow(HASH_BASE, len(pw), p) % p])
            self.powers.append(pw)
            self.sums.append(np.concatenate([[0], np.cumsum((words + 1) * pw[:self.n] % p)]))

    def _same(self, i: np.ndarray, d: np.ndarray, k: int) -> np.ndarray:
        out = np.ones(len(i), bool)
        for p, s, pw in zip(HASH_PRIMES, self.sums, self.powers, strict=True):
            out &= (s[i + k] - s[i]) % p * pw[d] % p == (s[i + d + k] - s[i + d]) % p
        return out

    def right(self, i: np.ndarray, d: np.ndarray) -> np.ndarray:
        """How many words from ``i`` on equal those ``d`` further."""
        got = np.zeros(len(i), np.int64)
        for t in reversed(range(self.n.bit_length())):
            k = 1 << t
            ok = np.flatnonzero(i + d + got + k <= self.n)
            got[ok[self._same(i[ok] + got[ok], d[ok], k)]] += k
        return got

    def left(self, i: np.ndarray, d: np.ndarray) -> np.ndarray:
        """How many words before ``i`` equal those ``d`` further."""
        got = np.zeros(len(i), np.int64)
        for t in reversed(range(self.n.bit_length())):
            k = 1 << t
            ok = np.flatnonzero(i - got >= k)
            got[ok[self._same(i[ok] - got[ok] - k, d[ok], k)]] += k
        return got


def _exact(words: np.ndarray, start: int, end: int, d: int, seed: int) -> tuple[int, int] | None:
    """The stretch around ``seed`` in which words ``d`` apart are equal; None if they differ at the seed itself."""
    if np.array_equal(words[start:end - d], words[start + d:end]):
        return start, end
    differ = np.flatnonzero(words[:-d] != words[d:])
    k = int(np.searchsorted(differ, seed))
    if k < len(differ) and differ[k] == seed:
        return None
    return int(differ[k - 1]) + 1 if k else 0, int(differ[k] if k < len(differ) else len(words) - d) + d


def find_runs(words: np.ndarray, longest: int) -> np.ndarray:
    """(start, end, period) of all runs in an array of word numbers, sorted by start, then period.

    ``longest``: no run is longer (the longest document, where several are laid end to end)."""
    n = len(words)
    none = np.zeros((0, 3), np.int64)
    if longest < LEAST:
        return none
    # distance from each word to its next occurrence
    order = np.argsort(words, kind="stable")
    gap = np.full(n, 2 * n + 2, np.int64)
    same = words[order[1:]] == words[order[:-1]]
    gap[order[:-1][same]] = (order[1:] - order[:-1])[same]
    found, extender, block = none, None, 2
    padded = None
    while (low := 1 if block == 2 else 2 * block - 1) * 2 <= longest:
        high = 4 * block - 2
        size = min(block, MAX_BLOCK)
        count = (n - size) // block + 1 if n >= size else 0
        at = np.arange(count) * block
        reach = np.concatenate([gap, np.zeros(max(0, count * block - n), np.int64)])[:count * block].reshape(count, block)[:, :size].max(1)
        keep = reach <= high
        if len(found):  # blocks whose reach lies in a run found
            short = found[(found[:, 2] <= size) & (found[:, 1] - found[:, 0] >= high + size)]
            inside = np.zeros(count + 1, np.int64)
            first, last = -(-short[:, 0] // block), (short[:, 1] - high - size) // block
            ok = first <= last
            np.add.at(inside, first[ok], 1)
            np.add.at(inside, last[ok] + 1, -1)
            keep &= np.cumsum(inside)[:count] == 0
        at = at[keep]
        if len(at):
            # beyond the end there are only words of a kind of their own
            beyond = high + 2 * size
            if padded is None or len(padded) < n + beyond:
                padded = np.concatenate([words, np.full(beyond, words.max() + 1)]) % PRIME
            which, d = [], []
            for a in range(low, high + 1, 3 * size):   # one step, but for blocks that stand for longer ones
                w, far = zero_sums(padded, at, size, a, min(high, a + 3 * size - 1))
                which.append(w)
                d.append(far)
            x, d = at[np.concatenate(which)], np.concatenate(d)
            ok = x + d + size <= n
            x, d = x[ok], d[ok]
            order = np.lexsort((x, d))
            x, d = x[order], d[order]
            # neighbouring blocks at one distance lie in one stretch
            fresh = np.ones(len(x), bool)
            fresh[1:] = (d[1:] != d[:-1]) | (x[1:] != x[:-1] + block) if size == block else True
            x, d = x[fresh], d[fresh]
            if len(x):
                extender = extender or Extender(words)
                start, end = x - extender.left(x, d), x + d + extender.right(x, d)
                long = end - start >= np.maximum(LEAST, 2 * d)
                got, seed = np.unique(np.stack([start, end, d], 1)[long], axis=0, return_index=True)
                # a stretch counts with its smallest period, and that one comes first
                have = {(s, e) for s, e, _ in found.tolist()}
                sure = []
                for (s, e, q), i in zip(got.tolist(), x[long][seed].tolist(), strict=True):
                    if (s, e) not in have and (real := _exact(words, s, e, q, i)) and real not in have and real[1] - real[0] >= max(LEAST, 2 * q):
                        have.add(real)
                        sure.append((*real, q))
                if sure:
                    found = np.concatenate([found, np.array(sure, np.int64)])
        block *= 2
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def text_runs(texts: list[list[bytes]]) -> list[Runs]:
    """The runs of each list of words."""
    names: dict[bytes, int] = {}
    parts, at = [], []
    where = 0
    for ws in texts:
        at.append(where)
        parts.append(np.fromiter((names.setdefault(w, len(names)) for w in ws), np.int64, len(ws)))
        where += len(ws) + 1
    v = len(names)
    gaps = [np.array([v + i]) for i in range(len(parts))]
    words = np.concatenate([a for pair in zip(parts, gaps, strict=True) for a in pair]) if parts else np.zeros(0, np.int64)
    found = find_runs(words, max((len(p) for p in parts), default=0))
    doc = np.searchsorted(np.array(at), found[:, 0], "right") - 1
    out: list[Runs] = [[] for _ in parts]
    for i, (s, e, q) in zip(doc.tolist(), found.tolist(), strict=True):
        out[i].append((s - at[i], e - s, q))
    return out


def collapse(words: list[bytes], runs: Runs) -> bytes:
    """The words joined by one space, without those that a run repeats (all of it but its first period)."""
    if not runs:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for s, n, q in runs:
        edge[s + q] += 1
        edge[s + n] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()])


def _groups(texts: list[str | None]) -> Iterator[list[list[bytes]]]:
    group, size = [], 0
    for t in texts:
        words = (t or "").encode("utf-8", "surrogatepass").split()
        if group and size + len(words) > SLICE_WORDS:
            yield group
            group, size = [], 0
        group.append(words)
        size += len(words)
    if group:
        yield group


def periodic_runs(docs: DataFrame, text_col: str = "text", runs: str = "runs", collapsed: str = "collapsed") -> DataFrame:
    """``docs`` plus the runs of each text, by start, then period, and the text with repeats collapsed."""
    docs = docs.drop(*[c for c in docs.columns if c.lower() in (runs.lower(), collapsed.lower()) and c != text_col])
    runs, collapsed = fresh_name(docs, runs), fresh_name(docs, collapsed)
    at = docs.columns.index(text_col)
    schema = T.StructType([*docs.schema.fields, T.StructField(runs, T.ArrayType(RUN)), T.StructField(collapsed, T.StringType())])

    def run(batches):
        for b in batches:
            every, texts = [], []
            for group in _groups(b.column(at).to_pylist()):
                got = text_runs(group)
                every += got
                texts += [collapse(w, r) for w, r in zip(group, got, strict=True)]
            flat = np.array([x for r in every for x in r], np.int64).reshape(-1, 3)
            spans = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], fields=list(_RUN))
            offsets = np.concatenate([[0], np.cumsum([len(r) for r in every])]).astype(np.int32)
            column = pa.ListArray.from_arrays(pa.array(offsets), spans)
            yield pa.RecordBatch.from_arrays([*b.columns, column, pa.array(texts, pa.binary()).cast(pa.string())], names=schema.names)
        release()

    return docs.mapInArrow(run, schema)


def with_planted_period(text: Column, doc_id: Column) -> Column:
    """The contract's edit: with h = crc32 of the id, where h % 10 is 0 the text's tail repeats one stretch of it."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    words = F.filter(F.split(text, "[ \t\n\x0B\f\r]+"), lambda w: w != "")
    parts = F.struct(words.alias("w"), F.floor(h / 10).alias("g"))
    edited = F.transform(F.array(parts), lambda x: F.array_join(F.transform(
        x["w"], lambda _, i: F.get(x["w"], _source(i.cast("long"), F.size(x["w"]).cast("long"), x["g"]).cast("int"))), " "))
    return F.when(h % 10 == 0, F.get(edited, F.lit(0))).otherwise(text)


def _source(i: Column, n: Column, g: Column) -> Column:
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    return F.when(i < a, i).otherwise(a + (i - a) % p)


def op12_periodic_runs(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = periodic_runs(docs.select("doc_id", with_planted_period(F.col("text"), F.col("doc_id")).alias("text"))).drop("text")
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], (-r["start"]).alias("before"), (-r["period"]).alias("shorter"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.before")).alias("start"), "best.length", (-F.col("best.shorter")).alias("period"),
        F.expr("1000 * best.length div -best.shorter").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


# equal words q apart, islands of neighbouring places, smallest period of each stretch; crc32 of the id bit by bit
ORACLE_SQL = r"""
WITH hashed AS (
    SELECT doc_id, row_number() OVER () AS r, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w0,
        xor(4294967295::BIGINT, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: list_concat([1000 + ord(c)]::BIGINT[], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[])))),
            lambda h, s: CASE WHEN s >= 1000 THEN xor(h, s - 1000) WHEN h % 2 = 1 THEN xor(h // 2, 3988292384) ELSE h // 2 END)) AS h
    FROM documents),
edit AS (SELECT *, CAST(len(w0) AS BIGINT) AS n, CASE WHEN len(w0) > 0 THEN (h // 10) % len(w0) END AS a, h // 10 AS g FROM hashed),
words AS (
    SELECT doc_id, r, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i: w0[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) ELSE w0 END AS ws FROM edit),
placed AS (SELECT r, n, unnest(ws) AS w, unnest(range(n)) AS i FROM words),
pairs AS (SELECT x.r, y.i - x.i AS q, x.i FROM placed x JOIN placed y ON x.r = y.r AND x.w = y.w AND y.i > x.i AND 2 * (y.i - x.i) <= x.n),
islands AS (SELECT r, q, min(i) AS s, max(i) + q + 1 AS e FROM (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS k FROM pairs) GROUP BY r, q, k HAVING max(i) + q + 1 - min(i) >= greatest(12, 2 * q)),
runs AS (SELECT r, s, e - s AS len, min(q) AS q FROM islands GROUP BY r, s, e),
listed AS (
    SELECT r, count(*) AS n_runs, max(struct_pack(l := len, s := -s, q := -q)) AS best, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS t, FROM runs GROUP BY r),
dropped AS (SELECT DISTINCT r, unnest(range(s + q, s + len)) AS i FROM runs),
kept AS (SELECT r, string_agg(w, ' ' ORDER BY i) AS t FROM placed ANTI JOIN dropped USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, -best.s AS start, best.l AS length, -best.q AS period, (1000 * best.l) // -best.q AS exponent_milli,
    sha256(coalesce(listed.t, '')) AS runs_sha256, sha256(coalesce(kept.t, '')) AS collapsed_sha256
FROM words LEFT JOIN listed USING (r) LEFT JOIN kept USING (r)
"""
