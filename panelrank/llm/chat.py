"""Chat formatting with prefix-target expansion, in DataFrame functions only.

A turn is written ``### role: text</turn>`` and a line break. Control strings inside texts are escaped with a backslash code
each (``\\`` -> ``\\s``, ``###`` -> ``\\h``, ``</turn>`` -> ``\\t``; in roles also ``:`` -> ``\\c``), so an unescaped control
string is always the template's and the output can be read back exactly.

Every assistant turn becomes an example of its own: all preceding turns are its context and only that reply is trainable.
An example refers to its context as a prefix of the conversation's formatted text (``context_end``) and carries its reply, so
the rows grow with the turns and not with their square; ``with_text`` writes the whole prompt out where that is wanted.

Defined results: turns are ordered by turn, then role and text (ties, repeated rows are kept as turns); null role and text
are empty; a null turn number comes first; rows without a conversation id form the conversation null. A conversation
is one row, as its digest and its text are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, BETWEEN, TAIL = "### ", ": ", "</turn>\n"
# control strings and their codes, in the order of escaping
CODES = [("\\", "\\s"), ("###", "\\h"), ("</turn>", "\\t")]
ROLE_CODES = [*CODES, (":", "\\c")]


def escape(c: Column, codes: list[tuple[str, str]] = CODES) -> Column:
    for plain, code in codes:
        c = F.replace(c, F.lit(plain), F.lit(code))
    return c


def unescape(c: Column, codes: list[tuple[str, str]] = CODES) -> Column:
    for plain, code in reversed(codes):
        c = F.replace(c, F.lit(code), F.lit(plain))
    return c


def format_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", trained: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, n_turns, formatted, and ``targets`` (turn number from 0, start and end code points)."""
    r, t = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    rows = turns.select(F.col(conv).alias("conv_id"), F.struct(F.col(turn).alias("turn"), r.alias("role"), t.alias("text")).alias("t"))
    said = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    parts = F.transform("turns", lambda x: F.struct(
        F.concat(F.lit(HEAD), escape(x["role"], ROLE_CODES), F.lit(BETWEEN)).alias("head"), escape(x["text"]).alias("body"), (x["role"] == trained).alias("train")))
    said = said.withColumn("parts", parts)
    targets = F.expr(f"""aggregate(parts, named_struct('at', 0L, 'i', 0L, 'out', cast(array() as array<struct<turn:bigint,start:bigint,`end`:bigint>>)),
        (a, p) -> named_struct('at', a.at + length(p.head) + length(p.body) + {len(TAIL)}, 'i', a.i + 1,
            'out', case when p.train then concat(a.out, array(named_struct('turn', a.i, 'start', a.at + length(p.head), 'end', a.at + length(p.head) + length(p.body)))) else a.out end),
        a -> a.out)""")
    formatted = F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(TAIL))), "")
    return said.select("conv_id", F.size("turns").cast("long").alias("n_turns"), formatted.alias("formatted"), targets.alias("targets"))


def prefix_targets(formatted: DataFrame, with_text: bool = False) -> DataFrame:
    """One row per trainable turn: conv_id, example (from 1), context_turns, context_end (= loss_start), loss_end and ``target``,
    the escaped reply; ``with_text`` adds ``text``, the formatted prefix up to the reply's end of turn."""
    rows = formatted.select("conv_id", "formatted", F.posexplode("targets").alias("i", "t"))
    cols = ["conv_id", (F.col("i") + 1).cast("long").alias("example"), F.col("t.turn").alias("context_turns"), F.col("t.start").alias("context_end"), F.col("t.end").alias("loss_end"),
            F.expr("substring(formatted, int(t.start) + 1, int(t.`end` - t.start))").alias("target")]
    if with_text:
        cols.append(F.expr(f"substring(formatted, 1, int(t.`end`) + {len(TAIL)})").alias("text"))
    return rows.select(*cols)


def read_back(formatted: str) -> Column:
    """The turns (role, text) of a formatted conversation, unescaped."""
    split = F.expr(f"slice(split({formatted}, r'</turn>\\n', -1), 1, size(split({formatted}, r'</turn>\\n', -1)) - 1)")
    return F.transform(split, lambda x: F.struct(
        unescape(F.substring_index(F.substr(x, F.lit(len(HEAD) + 1)), BETWEEN, 1), ROLE_CODES).alias("role"),
        unescape(F.substr(x, F.locate(BETWEEN, x) + F.lit(len(BETWEEN)))).alias("text")))


def op9_chat(spark, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    own = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").unionByName(own)
    formatted = format_conversations(turns)
    # each example is its prefix text with a mask; it is digested before the examples of a conversation come together
    each = prefix_targets(formatted, with_text=True).select("conv_id", "example", F.expr("substring(text, int(context_end) + 1, int(loss_end - context_end))").alias("target"),
                                                            F.sha2(F.expr("substring(text, 1, int(context_end))").cast("binary"), 256).alias("context"))
    loss = each.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("example", "target", "context"))).alias("e"))
    loss = loss.select(F.col("conv_id").alias("_c"), F.array_join(F.transform("e", lambda e: unescape(e["target"])), "").alias("_loss"),
                       F.size("e").cast("long").alias("_n"), F.sha2(F.array_join(F.transform("e", lambda e: e["context"]), "\n").cast("binary"), 256).alias("_contexts"))
    turns_text = F.array_join(F.transform(read_back("formatted"), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    both = formatted.join(loss, F.col("conv_id").eqNullSafe(F.col("_c")), "left").withColumn("_loss", F.coalesce("_loss", F.lit("")))
    return both.select(
        "conv_id", F.size(read_back("formatted")).cast("long").alias("n_turns"), F.sha2(turns_text.cast("binary"), 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"), F.sha2(F.col("_loss").cast("binary"), 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
        F.coalesce("_n", F.lit(0)).alias("n_examples"), F.coalesce("_contexts", F.sha2(F.lit("").cast("binary"), 256)).alias("contexts_sha256"))


# the same template and escapes by plain string functions; contexts are prefixes in turn order
ORACLE_SQL = r"""
WITH said AS (SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
parts AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    '### ' || replace(replace(replace(replace(role, '\', '\s'), '###', '\h'), '</turn>', '\t'), ':', '\c') || ': ' AS head,
    replace(replace(replace(text, '\', '\s'), '###', '\h'), '</turn>', '\t') AS body FROM said),
lined AS (SELECT *, COALESCE(string_agg(head || body || '</turn>' || chr(10), '') OVER (PARTITION BY conv_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') || head AS context FROM parts)
SELECT CAST(conv_id AS BIGINT) AS conv_id, COUNT(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
    CAST(COALESCE(SUM(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars, sha256(COALESCE(string_agg(text, '' ORDER BY i) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    CAST(SUM(length(head) + length(body) + 8) AS BIGINT) AS formatted_chars, COUNT(*) FILTER (WHERE role = 'assistant') AS n_examples,
    sha256(COALESCE(string_agg(sha256(context), chr(10) ORDER BY i) FILTER (WHERE role = 'assistant'), '')) AS contexts_sha256
FROM lined GROUP BY conv_id
"""
