"""Quality classifier as a sparse rule ensemble compiled into Spark columns.

1. ``statistics``: scale-free text statistics as column expressions (shares of character kinds, word lengths, repetition).
2. Trees (MLlib boosting and a forest) are grown on a bounded sample of labelled rows; every tree path is a conjunctive rule over
   the statistics.
3. A lasso logistic regression over the rules' 0/1 columns keeps few of them.
4. The kept rules compile into one column, ``sigmoid(bias + sum of weights of the rules that hold)``; scoring whole texts is a
   projection without Python and without a shuffle.

Defined results: null and empty texts have all statistics 0 and a score like any other; repeated rows score alike; rows without
label, with null label or null id don't train; without both classes in the sample every score is the base rate.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelrank.llm.arrays import fresh_name, id_bucket

MAX_ROWS = 12_000         # labelled rows that train, at most (about)
TREES, DEPTH, LASSO = 12, 3, 0.001
SYMBOLS = "#$%&*|!@^~<>{}[]\\_=+/"
DIGITS = "0123456789"


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a text, each a double, none larger for a text only because it is longer."""
    t = F.coalesce(text, F.lit(""))
    n = F.greatest(F.length(t), F.lit(1)).cast("double")
    words = F.filter(F.split(t, r"[ \t\r\n]+"), lambda w: w != "")
    n_words = F.greatest(F.size(words), F.lit(1)).cast("double")
    lines = F.filter(F.split(t, r"\n"), lambda x: x != "")
    n_lines = F.greatest(F.size(lines), F.lit(1)).cast("double")
    share = lambda chars: F.length(t) - F.length(F.translate(t, chars, ""))
    upper = F.length(t) - F.length(F.regexp_replace(t, r"\p{Lu}+", ""))
    spaces = share(" \t\n\r")
    return {
        "symbols": share(SYMBOLS) / n, "digits": share(DIGITS) / n, "upper": upper / n, "periods": share(".") / n, "commas": share(",;:") / n,
        "bars": share("|") / n, "marks": share("!?") / n, "spaces": spaces / n,
        "word_length": (F.length(t) - spaces) / n_words, "distinct_words": F.size(F.array_distinct(words)) / n_words,
        "words_per_line": F.least(n_words / n_lines, F.lit(1000.0)), "distinct_lines": F.size(F.array_distinct(lines)) / n_lines,
        "root_words": F.size(F.array_distinct(words)) / F.sqrt(n_words), "words": F.log1p(n_words),
    }


def _with_statistics(docs: DataFrame, text_col: str) -> tuple[DataFrame, list[str], str]:
    name = fresh_name(docs, "_stats")
    stats = statistics(F.col(text_col))
    return docs.withColumn(name, F.struct(*(c.cast("double").alias(k) for k, c in stats.items()))), list(stats), name


Rule = tuple[tuple[str, bool, float], ...]  # (statistic, True: at most, threshold)


def _paths(node, names: list[str], so_far: Rule = ()) -> list[Rule]:
    """Conditions on the way to every node below the root of an MLlib tree."""
    out = [so_far] if so_far else []
    if node.subtreeDepth() > 0:
        split = node.split()
        name, cut = names[split.featureIndex()], float(split.threshold())
        out += _paths(node.leftChild(), names, (*so_far, (name, True, cut))) + _paths(node.rightChild(), names, (*so_far, (name, False, cut)))
    return out


def simplify(rule: Rule) -> Rule:
    """One bound a side for each statistic, in order of name."""
    low, high = {}, {}
    for name, at_most, cut in rule:
        side, pick = (high, min) if at_most else (low, max)
        side[name] = pick(side.get(name, cut), cut)
    return tuple(sorted([(n, True, c) for n, c in high.items()] + [(n, False, c) for n, c in low.items()]))


def holds(rule: Rule, stats: str) -> Column:
    out = F.lit(True)
    for name, at_most, cut in rule:
        c = F.col(f"{stats}.{name}")
        out = out & ((c <= cut) if at_most else (c > cut))
    return out


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text", max_rows: int = MAX_ROWS) -> dict:
    """The kept rules with their weights, and the bias."""
    lab = labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & (id_bucket(id_col) != 0))
    lab = lab.groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(label).cast("int")).alias("label"))
    n = lab.count()
    if n > max_rows:
        lab = lab.where(F.pmod(F.xxhash64(F.col("_id")), F.lit(1 << 20)) < F.lit(int((1 << 20) * max_rows / n)))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(lab), "_id")  # bounded by max_rows
    rows, names, stats = _with_statistics(rows, "_text")
    # a few numbers a row from here on; one partition a class of rows is enough for the sample
    flat = rows.select("_id", F.col("label").cast("double").alias("label"), *(F.col(f"{stats}.{s}").alias(s) for s in names)).repartition(4, "_id").sortWithinPartitions("_id", *names).persist()
    try:
        seen = {int(r["label"]): r["count"] for r in flat.groupBy("label").count().collect()}
        if not seen.get(0) or not seen.get(1):
            return {"rules": [], "bias": None, "constant": seen.get(1, 0) / max(1, sum(seen.values()))}
        data = VectorAssembler(inputCols=names, outputCol="features").transform(flat).select("label", "features")
        forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, maxBins=64, seed=7, featureSubsetStrategy="onethird").fit(data)
        boosted = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, maxBins=64, seed=7, stepSize=0.3).fit(data)
        trees = [*forest.trees, *boosted.trees]
        rules = sorted({simplify(p) for t in trees for p in _paths(t._call_java("rootNode"), names)})
        ruled = flat.select("label", F.struct(*names).alias("x")).select("label", *(holds(r, "x").cast("double").alias(f"r{i}") for i, r in enumerate(rules)))
        ruled = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="features").transform(ruled).select("label", "features")
        fit = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, maxIter=60, standardization=False).fit(ruled)
        kept = [(r, float(w)) for r, w in zip(rules, fit.coefficients.toArray(), strict=True) if abs(w) > 1e-6]
        return {"rules": kept, "bias": float(fit.intercept), "constant": None}
    finally:
        flat.unpersist()


def compile_rules(model: dict, stats: str) -> Column:
    """The model as one column over the struct of statistics."""
    if model["constant"] is not None:
        return F.lit(float(model["constant"]))
    z = F.lit(model["bias"])
    for rule, weight in model["rules"]:
        z = z + F.when(holds(rule, stats), F.lit(weight)).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-z))


def score(docs: DataFrame, model: dict, text_col: str = "text", into: str = "quality") -> DataFrame:
    """``docs`` plus the column ``into``: probability of good quality."""
    rows, _, stats = _with_statistics(docs, text_col)
    return rows.withColumn(into, compile_rules(model, stats)).drop(stats)


def describe(model: dict) -> list[str]:
    """The kept rules in words, heaviest first."""
    text = lambda r: " and ".join(f"{n} {'<=' if m else '>'} {c:.4g}" for n, m, c in r)
    return [f"{w:+.3f} if {text(r)}" for r, w in sorted(model["rules"], key=lambda x: -math.fabs(x[1]))]


def op6_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    s = F.col("quality")
    return score(docs, model).select("doc_id", (id_bucket("doc_id") == 0).alias("held_out"), s.alias("score"), (s >= 0.3).cast("int").alias("predicted"))
