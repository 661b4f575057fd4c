"""Secret scan in Spark SQL functions only: fixed patterns, and sliding-window entropy over candidate strings.

Base kinds (``assign``, ``access``, ``hex``) are leftmost non-overlapping matches of a pattern, kept if long enough.
Positions come from the text between the matches (``split``) and the matches themselves, as code points.

The method adds ``entropy`` spans: candidates are long runs of token characters outside the base spans; each belongs to a character class
(hex, alphanumeric, base64) with its own window and threshold. The Shannon entropy of the window is kept by incremental
counts: with ``S = sum c*log2(c)`` over the window's character counts, a step adds ``f(c+1)-f(c)`` for the character that
enters and ``f(c-1)-f(c)`` for the one that leaves, and ``H = log2(w) - S/w``. Windows at or over the threshold are merged.
Allow-list: paths, slugs and runs made of words and short numbers, digits and UUIDs are suppressed. Placeholder words suppress the windows that
overlap them: a candidate is cut at them, and what is left on either side is a candidate of its own.

Defined results: null and empty texts have no span; repeated rows give equal spans; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelrank.llm.arrays import fresh_name

# FIXED VALUES of the base kinds: kind, pattern, capture group whose length counts, least length.
# hex: runs are maximal, so the least length can stand in the pattern; likewise access, whose runs' tails are shorter still.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KINDS = [("assign", ASSIGN, 2, 12), ("access", r"AKIA[A-Z0-9]{14,}", 0, 18), ("hex", r"[0-9a-f]{16,}", 0, 16)]

# character classes of the entropy scan: name, characters (letters compare without case in hex), window, bits
CLASSES = [
    ("hex", "0123456789abcdef", 16, 2.9),
    ("alnum", "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", 20, 3.6),
    ("base64", "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-", 20, 3.7),
]
LEAST = 20
PLACES = 128             # matches whose places are added up together
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{LEAST},}}"
# words in one case or with capitals, also run together, with a short number behind them, or a number
WORD = "(?:(?:(?:[A-Z]?[a-z]{2,}+|[A-Z]{2,}+)++|[A-Za-z])[0-9]{0,4}|[0-9]{1,8})"
ALLOWED = [
    rf"^(?:{WORD})?(?:[+/_=-]++(?:{WORD})?)++$",                                                # paths, slugs, rules
    r"^(?:[A-Z]?[a-z]{2,}+|[A-Z]{2,}+)++$",                                                     # words, also run together
    r"^[0-9+/_=-]+$",                                                                           # numbers, dates
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",           # UUID
]
# words of placeholders, at full length
PLACEHOLDER = r"(?i)(example|placeholder|changeme|your[_-]?(api|key|token|secret)|xxxx+|0?1234567890?|abcdefghijk?l?m?n?o?p?q?r?s?t?u?v?w?x?y?z?)"
PLACE = "array<struct<start:bigint,`end`:bigint,part:string>>"
SPAN = "array<struct<start:bigint,`end`:bigint,kind_no:int,kind:string>>"


def _lit(pattern: str) -> str:
    return "r'" + pattern.replace("'", "\\x27") + "'"


def _places(text: str, pattern: str, group: int) -> str:
    """SQL: array of (start, end, group's text) of the matches, in code points: text before, match and group are zipped.

    Places are added up within blocks of ``PLACES`` matches and the blocks shifted by what lies before them, so that no array
    longer than a block, or than the number of blocks, is copied at each step.
    """
    p = _lit(pattern)
    zipped = f"arrays_zip(slice(split({text}, {p}, -1), 1, size(regexp_extract_all({text}, {p}, 0))), regexp_extract_all({text}, {p}, 0), regexp_extract_all({text}, {p}, {group}))"
    block = f"""aggregate(c, named_struct('at', 0L, 'out', cast(array() as {PLACE})),
        (a, m) -> named_struct('at', a.at + length(m.`0`) + length(m.`1`), 'out', concat(a.out, array(named_struct('start', a.at + length(m.`0`), 'end', a.at + length(m.`0`) + length(m.`1`), 'part', m.`2`)))))"""
    blocks = f"transform(filter(transform(sequence(0, int(size(z) / {PLACES})), i -> slice(z, i * {PLACES} + 1, {PLACES})), c -> size(c) > 0), c -> {block})"
    before = "aggregate(y, cast(array(0L) as array<bigint>), (a, k) -> concat(a, array(element_at(a, -1) + k.at)))"
    shifted = "flatten(zip_with(y, slice(o, 1, size(y)), (k, at) -> transform(k.out, m -> named_struct('start', at + m.start, 'end', at + m.`end`, 'part', m.part))))"
    # an array of one element names a value for the expression that follows
    return f"element_at(transform(array({zipped}), z -> element_at(transform(array({blocks}), y -> element_at(transform(array({before}), o -> {shifted}), 1)), 1)), 1)"


def base_spans(text: str) -> str:
    """SQL: base spans of the text, by start, then kind."""
    each = [f"""case when {text} rlike {_lit(p)} then transform(filter({_places(text, p, g)}, m -> length(m.part) >= {n}),
        m -> named_struct('start', m.start, 'end', m.`end`, 'kind_no', {i}, 'kind', '{kind}')) else cast(array() as {SPAN}) end""" for i, (kind, p, g, n) in enumerate(KINDS)]
    return f"array_sort(concat({', '.join(each)}))"


def _windows(run: str, chars: str, window: int, bits: float, lower: bool) -> str:
    """SQL: merged (start, end) stretches of a run whose window entropy reaches ``bits``; counts are updated step by step."""
    f = ", ".join(repr(c * math.log2(c)) + "D" if c else "0D" for c in range(window + 1))
    code = f"transform(split({'lower(' + run + ')' if lower else run}, ''), ch -> locate(ch, '{chars}', 1) - 1)"
    zero = ", ".join("0" for _ in chars)
    # a step: z is the state, i the position, x.k the codes
    enter, leave = "element_at(x.k, i + 1)", f"(case when i >= {window} then element_at(x.k, i + 1 - {window}) else -1 end)"
    count = lambda c: f"element_at(z.n, {c} + 1)"
    step_in = f"(element_at(x.f, {count(enter)} + 2) - element_at(x.f, {count(enter)} + 1))"
    # the leaving character's count, after the entering one has been counted
    after = f"({count(leave)} + case when {leave} = {enter} then 1 else 0 end)"
    step_out = f"(case when i >= {window} then element_at(x.f, {after}) - element_at(x.f, {after} + 1) else 0D end)"
    s = f"(z.s + {step_in} + {step_out})"
    high = f"i >= {window - 1} and {math.log2(window)!r}D - {s} / {window} >= {bits}D"
    one = f"named_struct('start', cast(i + 1 - {window} as bigint), 'end', cast(i + 1 as bigint))"
    grown = f"concat(slice(z.out, 1, size(z.out) - 1), array(named_struct('start', element_at(z.out, -1).start, 'end', cast(i + 1 as bigint))))"
    out = f"case when {high} then case when size(z.out) > 0 and element_at(z.out, -1).`end` >= i + 1 - {window} then {grown} else concat(z.out, array({one})) end else z.out end"
    return f"""element_at(transform(array(named_struct('k', {code}, 'f', array({f}))), x -> aggregate(sequence(0, size(x.k) - 1),
        named_struct('n', array({zero}), 's', 0D, 'out', cast(array() as array<struct<start:bigint,`end`:bigint>>)),
        (z, i) -> named_struct('n', transform(z.n, (v, j) -> v + case when j = {enter} then 1 else 0 end - case when j = {leave} then 1 else 0 end), 's', {s}, 'out', {out}),
        z -> z.out)), 1)"""


def _outside(run: str, spans: str, at: str = "0L") -> str:
    """SQL: (start, end, text) of the candidates in a run (start, end, part) outside the spans, which are by start and counted from ``at``."""
    piece = lambda lo, hi: f"array(named_struct('start', {lo}, 'end', {hi}, 'part', substring({run}.part, int({lo} - {run}.start) + 1, int({hi} - {lo}))))"
    return f"""aggregate({spans}, named_struct('at', {run}.start, 'out', cast(array() as {PLACE})),
        (z, o) -> named_struct('at', greatest(z.at, {at} + o.`end`), 'out', case when {at} + o.start - z.at >= {LEAST} then concat(z.out, {piece('z.at', f'({at} + o.start)')}) else z.out end),
        z -> case when {run}.`end` - z.at >= {LEAST} then concat(z.out, {piece('z.at', f'{run}.`end`')}) else z.out end)"""


def entropy_spans(text: str, base: str) -> str:
    """SQL: spans of high entropy outside the base spans."""
    allowed = lambda m: "(" + " or ".join(f"{m}.part rlike {_lit(p)}" for p in ALLOWED) + ")"
    free = _outside("r", f"filter({base}, b -> b.start < r.`end` and b.`end` > r.start)")
    named = f"case when p.part rlike {_lit(PLACEHOLDER)} then {_outside('p', _places('p.part', PLACEHOLDER, 0), 'p.start')} else array(p) end"
    per = [f"when m.part rlike {_lit(rule)} then {_windows('m.part', chars, w, bits, name == 'hex')}" for (name, chars, w, bits), rule in zip(CLASSES, [r"^[0-9a-fA-F]+$", r"^[0-9A-Za-z]+$", r""], strict=True)]
    found = f"transform(case {' '.join(per)} end, s -> named_struct('start', m.start + s.start, 'end', m.start + s.`end`, 'kind_no', {len(KINDS)}, 'kind', 'entropy'))"
    runs = f"filter(flatten(transform({_places(text, CANDIDATE, 0)}, r -> {free})), p -> not {allowed('p')})"
    parts = f"filter(flatten(transform({runs}, p -> {named})), m -> not {allowed('m')})"
    return f"case when {text} rlike {_lit(CANDIDATE)} then flatten(transform({parts}, m -> {found})) else cast(array() as {SPAN}) end"


def find_secrets(docs: DataFrame, text_col: str = "text", into: str = "secrets") -> DataFrame:
    """``docs`` plus the struct ``into``: ``base`` and ``spans`` (base and entropy), each sorted by start, then kind."""
    t, b = fresh_name(docs, "_scanned"), fresh_name(docs, "_base")
    named = docs.withColumn(t, F.coalesce(F.col(text_col), F.lit("")))
    named = named.withColumn(b, F.expr(base_spans(f"`{t}`")))
    both = F.array_sort(F.concat(F.col(b), F.expr(entropy_spans(f"`{t}`", f"`{b}`"))))
    return named.withColumn(into, F.struct(F.col(b).alias("base"), both.alias("spans"))).drop(t, b)


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]", n_chars: str | None = None) -> DataFrame:
    """``docs`` with every stretch covered by spans replaced by ``mark``; ``n_chars`` names a length column to renew.

    All rows stay; texts without a span, null ones included, are unchanged.
    """
    name = fresh_name(docs, "_secrets")
    found = find_secrets(docs, text_col, name)
    spans, t = f"`{name}`.spans", f"`{text_col}`"
    pieces = f"""aggregate({spans}, named_struct('at', 0L, 'out', cast(array() as array<string>)),
        (a, s) -> case when s.`end` <= a.at then a when s.start < a.at then named_struct('at', s.`end`, 'out', a.out)
            else named_struct('at', s.`end`, 'out', concat(a.out, array(substring({t}, int(a.at) + 1, int(s.start - a.at)), '{mark}'))) end,
        a -> concat(array_join(a.out, ''), substring({t}, int(a.at) + 1, length({t}))))"""
    new = F.when(F.size(f"{name}.spans") > 0, F.expr(pieces)).otherwise(F.col(text_col))
    out = found.withColumn(text_col, new)
    if n_chars:
        kind = docs.schema[n_chars].dataType
        out = out.withColumn(n_chars, F.when(F.size(f"{name}.spans") > 0, F.length(text_col).cast(kind)).otherwise(F.col(n_chars)))
    return out.drop(name)


def span_list(spans: str) -> Column:
    """kind:start:end of an array of spans, comma-joined."""
    return F.expr(f"array_join(transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.`end`)), ',')")


def op4_secrets(spark, sf_dir: str) -> DataFrame:
    found = find_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    n = lambda kind: F.size(F.filter("secrets.base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *(n(kind) for kind, *_ in KINDS), F.sha2(span_list("secrets.base").cast("binary"), 256).alias("base_sha256"), span_list("secrets.spans").alias("spans"))
