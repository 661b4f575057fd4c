"""Cost-balanced packing of tokenised documents into fixed-length sequences.

The cost of a piece of ``n`` tokens is estimated as ``LINEAR * n + n * n / 2`` (projections, and causal attention inside the
piece); a sequence costs the sum of its pieces. Pieces are assigned in descending size to the sequence of lowest cost that
has room; where no sequence has room for a whole piece, it is cut to fill the cheapest open one and the rest is assigned anew.

Work is local to a task: documents are tokenised as they stream in, and each ``GROUP`` tokens (or the task's rest) are packed
together, so memory is bounded and nothing shuffles. A group's tokens fill whole sequences of ``length``; what is left over
goes to the next group, and a task's last remainder is cut into sequences whose sizes are powers of two, which need no padding.
A sequence's id is the task's number in the high bits and a count in the low bits, so a repeated task gives the same ids.

Tokens are those of a public tokenizer file plus an end-of-document id. Its normaliser and splitter never join text across
white space, so texts are encoded by white-space chunk with a bounded memo; ids equal those of the whole text.

Defined results: null and empty texts are the end id alone; repeated rows are packed each; an empty table gives no piece.
"""

from __future__ import annotations

import heapq
import os
import re
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelrank.llm.arrays import release

LENGTH = 4096
GROUP = 2 << 20          # tokens packed together
LINEAR = 12 * 768        # linear cost of a token relative to attention over one earlier token (twelve widths of 768)
MEMO = 120_000           # chunks in one of the two generations of ids that a worker remembers
END_ID = 2

PIECE = [("start", T.LongType()), ("length", T.LongType()), ("ids", T.BinaryType()), ("doc_tokens", T.LongType()), ("sequence_id", T.LongType()), ("offset", T.LongType())]


# chunks of lower-case Latin letters followed by plain signs: the tokenizer's splitter parts them there and nowhere else
_PLAIN = re.compile("([a-z\u00e0-\u00f6\u00f8-\u00ff]*)([.,!?;:#$%&*|()-]*)")
# byte-level models write bytes as characters; those of two-byte Latin letters that aren't printable are shifted
_SHIFTED = [*range(0x21), *range(0x7F, 0xA1), 0xAD]
_BYTE_CHAR = {b: chr(0x100 + _SHIFTED.index(b)) if b in _SHIFTED else chr(b) for b in range(256)}


class Encoder:
    """Token ids of texts as little-endian 32-bit bytes; special-token strings count as the tokenizer file says.

    Ids are remembered by chunk in two generations: a full one becomes the old one, and chunks still in use move up.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        self.memo: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        probe = ["caf\u00e9###", "\u00e0\u00ff", "ab.", "(", "u!!"]
        self.direct = True
        self.direct = all(self._direct(p) == self._whole(p) for p in probe)  # only for tokenizers that split this way
        self.memo.clear()

    def _whole(self, chunk: str) -> bytes:
        ids = self.tok.encode(chunk, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _direct(self, chunk: str) -> bytes | None:
        m = _PLAIN.fullmatch(chunk)
        if m is None:
            return None
        if m[1] and m[2]:  # the letters alone may be known already
            return self._known(m[1].encode()) + self._known(m[2].encode())
        part = chunk if chunk.isascii() else "".join([_BYTE_CHAR[b] for b in chunk.encode()])
        ids = [t.id for t in self.model.tokenize(part)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _known(self, chunk: bytes) -> bytes:
        return self.memo.get(chunk) or self._new(chunk)

    def _new(self, chunk: bytes) -> bytes:
        got = self.old.get(chunk)
        if got is None:
            text = chunk.decode()
            got = (self._direct(text.lower()) if self.direct else None) or self._whole(text)
        if len(self.memo) >= MEMO:
            self.old, self.memo = self.memo, {}
        self.memo[chunk] = got
        return got

    def __call__(self, text: str) -> bytes:
        raw = text.encode()
        if self.direct and b"<|" not in raw:  # special-token strings heed case, the rest doesn't
            raw = raw.lower()
        parts = raw.split()  # of bytes: at ASCII white space only, which the tokenizer drops
        got = list(map(self.memo.get, parts))
        if None in got:
            got = [g if g is not None else self._known(p) for g, p in zip(got, parts, strict=True)]
        return b"".join(got)


def encoder(path: str) -> Encoder:
    """The worker's encoder of this file: kept on the tokenizers module, so later tasks of the same worker find its memo."""
    import tokenizers

    kept = tokenizers.__dict__.setdefault("_panelrank_encoders", {})
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


def piece_cost(n: int) -> float:
    return LINEAR * n + 0.5 * n * n


def assign(sizes: list[int], length: int = LENGTH, largest: int = LENGTH) -> tuple[list[tuple[int, int, int, int, int]], list[tuple[int, int, int]]]:
    """Pack documents of the given sizes into ``sum // length`` full sequences, in descending order.

    A document goes whole to the sequence of least cost that has room for it (the first of equal ones); it is cut only if it is longer
    than ``largest`` or no sequence has room, and then the cheapest open sequence takes a part.
    Returns (document, start, n, sequence, offset) of every piece, and (document, start, n) of the rest that fills no sequence
    (under ``length`` tokens in all, from the last documents).
    """
    seqs, rest = sum(sizes) // length, sum(sizes) % length
    left = []
    todo = []  # (-n, document, start): a heap of pieces, largest first
    for d in range(len(sizes) - 1, -1, -1):
        keep = min(rest, sizes[d])
        if keep:
            left.append((d, sizes[d] - keep, keep))
            rest -= keep
        for s in range(0, sizes[d] - keep, largest):
            todo.append((-min(largest, sizes[d] - keep - s), d, s))
    heapq.heapify(todo)
    cost, room = np.zeros(seqs), np.full(seqs, length)
    out = []
    while todo:
        n, d, s = heapq.heappop(todo)
        n = -n
        fits = np.flatnonzero(room >= n)
        if not len(fits):
            fits = np.flatnonzero(room)
        q = int(fits[np.argmin(cost[fits])])
        take = min(n, int(room[q]))
        out.append((d, s, take, q, length - int(room[q])))
        room[q] -= take
        cost[q] += piece_cost(take)
        if take < n:
            heapq.heappush(todo, (take - n, d, s + take))
    return out, left[::-1]


def _powers(n: int) -> list[int]:
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def pack(docs: DataFrame, tokenizer_path: str, *, text_col: str = "text", length: int = LENGTH, end_id: int = END_ID, group: int = GROUP, largest: int | None = None) -> DataFrame:
    """The pieces of all documents: ``docs`` without the text, plus start, length, ids, doc_tokens, sequence_id and offset.

    Columns of ``docs`` that clash with the added ones are renamed with a trailing underscore.
    """
    at = docs.columns.index(text_col)
    added = {n for n, _ in PIECE}
    kept = [(i, T.StructField(f.name + "_" * (f.name.lower() in added), f.dataType)) for i, f in enumerate(docs.schema.fields) if i != at]
    schema = T.StructType([*(f for _, f in kept), *(T.StructField(n, t) for n, t in PIECE)])
    end = struct.pack("<I", end_id)

    def run(batches):
        from pyspark import TaskContext

        encode, serial = encoder(tokenizer_path), TaskContext.get().partitionId() << 33
        rows: list = []      # of the open documents: (columns, ids not yet packed, start of those, all its tokens)
        held = 0

        def pieces(last: bool):
            nonlocal rows, held, serial
            done, left = assign([len(r[1]) // 4 for r in rows], length, largest or length)
            got = [(d, s, n, serial + q, o) for d, s, n, q, o in done]
            serial += held // length
            if last:
                size = iter(_powers(sum(n for _, _, n in left)))
                full = used = 0
                for d, s, n in left:
                    while n:
                        if used == full:
                            serial, full, used = serial + (full > 0), next(size), 0
                        take = min(n, full - used)
                        got.append((d, s, take, serial, used))
                        s, n, used = s + take, n - take, used + take
                serial += full > 0
            if got:
                of = pa.array([d for d, *_ in got])
                columns = [pa.concat_arrays([r[0][i] for r in rows]).take(of) for i in range(len(kept))]
                more = [pa.array([rows[d][2] + s for d, s, *_ in got], pa.int64()), pa.array([n for _, _, n, _, _ in got], pa.int64()),
                        pa.array([rows[d][1][4 * s:4 * (s + n)] for d, s, n, _, _ in got], pa.binary()), pa.array([rows[d][3] for d, *_ in got], pa.int64()),
                        pa.array([q for *_, q, _ in got], pa.int64()), pa.array([o for *_, o in got], pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, *more], names=schema.names)
            rows = [] if last else [(rows[d][0], rows[d][1][4 * s:4 * (s + n)], rows[d][2] + s, rows[d][3]) for d, s, n in left]
            held = sum(len(r[1]) // 4 for r in rows)

        for b in batches:
            text = b.column(at)
            for i in range(b.num_rows):
                ids = encode(text[i].as_py() or "") + end
                rows.append(([b.column(c).slice(i, 1) for c, _ in kept], ids, 0, len(ids) // 4))
                held += len(ids) // 4
                if held >= group:
                    yield from pieces(False)
        if rows:
            yield from pieces(True)
        release()

    return docs.mapInArrow(run, schema)


def padding(total: int, length: int = LENGTH) -> int:
    """Padding of a sequence of ``total`` tokens: none at a power of two, else up to ``length``."""
    return 0 if total and total & (total - 1) == 0 else length - total


def op2_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = pack(docs, str(public_tokenizers.path("word_bpe_49k.json")))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
