"""Query text and event payload helpers.

The reference asks a language model for the intent bucket; here the bucket
is a stand-in: ordered regular-expression rules (ours, first match wins),
evaluated by the JVM regex engine (``rlike``), no Python per row.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ANONYMIZED = "anonymized_privacy"

# our rules, in precedence order (C28 stand-in, not the reference's model); whole words only
INTENT_RULES = [
    ("Comparison", r"\b(vs|versus|compare[ds]?|comparison)\b"),
    ("Replacement", r"\b(alternatives?|replace[ds]?|replacements?|substitutes?|instead of)\b"),
    ("Risk/safety", r"\b(safe|safely|safety|risks?|risky|side effects?|dangers?|dangerous)\b"),
    ("Use-case", r"\b(for|how|use[ds]?|using)\b"),
    ("Decision-stage", r"\b(buy|buying|prices?|pricing|costs?|cheap|cheapest|discounts?|coupons?)\b"),
]
INTENT_DEFAULT = "Other"


def flatten_json(df: DataFrame, col: str, schema: str) -> DataFrame:
    """Nested JSON payload to top-level columns (C26); one row stays one row.

    Structs are expanded to their leaves, named by the path joined with ``_``; arrays and maps stay one column.
    """
    kind = T.StructType.fromDDL(schema)

    def leaves(c, of: T.StructType, path: tuple[str, ...]):
        for f in of.fields:
            here = c.getField(f.name)
            if isinstance(f.dataType, T.StructType):
                yield from leaves(here, f.dataType, (*path, f.name))
            else:
                yield here.alias("_".join((*path, f.name)))

    return df.select("*", *leaves(F.from_json(F.col(col), kind), kind, ()))


def payload_schema(df: DataFrame, col: str) -> T.StructType:
    """The schema of JSON payloads, merged over all rows (C26): a field whose rows disagree on its type is a variant.

    One aggregate with partial merging; rows that are NULL, no JSON or no object don't take part.
    """
    v = F.expr(f"try_parse_json(`{col}`)")
    objects = df.select(v.alias("_v")).filter(F.schema_of_variant("_v").startswith("OBJECT"))
    merged = objects.agg(F.schema_of_variant_agg("_v").alias("s")).first()["s"]  # one string
    if not merged or not merged.startswith("OBJECT"):
        return T.StructType()
    return T.DataType.fromDDL(re.sub(r"\bOBJECT<", "STRUCT<", merged).replace("VOID", "STRING"))


def flatten_variant(df: DataFrame, col: str, schema: T.StructType | None = None, prefix: str = "") -> DataFrame:
    """Nested JSON payload to top-level columns without a given schema (C26); one row stays one row.

    Leaves are named by their path joined with ``_``. A field of one type has that type; fields of mixed types, arrays and what
    else has no column type are JSON text, bare strings as they are. A payload that is NULL, no JSON or no object gives NULLs, as does a
    field that a row lacks. Pass ``schema`` to keep columns fixed over batches of a stream or a month.
    """
    schema = schema if schema is not None else payload_schema(df, col)

    def leaves(of: T.StructType, path: tuple[str, ...]):
        for f in of.fields:
            here = (*path, f.name)
            if isinstance(f.dataType, T.StructType) and f.dataType.fields:
                yield from leaves(f.dataType, here)
            else:
                yield here, f.dataType

    def value(path, kind):
        where = "$" + "".join('["' + p.replace("\\", "\\\\").replace('"', '\\"') + '"]' for p in path)
        simple = kind.simpleString() if isinstance(kind, (T.LongType, T.DoubleType, T.BooleanType, T.StringType, T.DecimalType)) else None
        # numbers of an object keep the least type that holds all of them; text is what remains otherwise
        return F.try_variant_get("_v", where, simple or "string")

    out = df.withColumn("_v", F.expr(f"try_parse_json(`{col}`)"))
    return out.select(*[F.col(f"`{c}`") for c in df.columns], *[value(p, k).alias(prefix + "_".join(p)) for p, k in leaves(schema, ())])


def flag_anonymized(col: str):
    """Blank or NULL query -> marked ``anonymized_privacy``, never dropped."""
    return F.col(col).isNull() | (F.trim(F.col(col)) == "")


def intent_bucket(df: DataFrame, col: str, rules=INTENT_RULES, out: str = "intent") -> DataFrame:
    """Ordered regex rules over the lower-cased text (C28 stand-in)."""
    t = F.lower(F.col(col))
    e = F.when(flag_anonymized(col), F.lit(ANONYMIZED))
    for label, pattern in rules:
        e = e.when(t.rlike(pattern), F.lit(label))
    return df.withColumn(out, e.otherwise(F.lit(INTENT_DEFAULT)))
