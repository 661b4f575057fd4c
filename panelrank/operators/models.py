"""Learned scores with MLlib.

Estimators run distributed (MLlib trees aggregate split statistics per
partition; logistic regression uses tree-aggregated gradients). Class
balance is a ``weightCol`` = n / (2 n_class) (sklearn's "balanced").
"""

from __future__ import annotations

import gc
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelrank import constants as K

SEED = K.RANDOM_STATE


def feature_stages(numeric: list[str], categorical: list[str], out: str = "features"):
    """Feature matrix (E01): numeric block + one-hot block (all levels kept, ``unknown`` for NULL)."""
    stages = []
    if categorical:
        # one indexer for all columns: their levels are counted in one job
        oh_cols = [f"_{c}_i" for c in categorical]
        stages.append(StringIndexer(inputCols=[f"_{c}_s" for c in categorical], outputCols=oh_cols, handleInvalid="keep",
                                    stringOrderType="alphabetAsc"))
        stages.append(OneHotEncoder(inputCols=oh_cols, outputCols=[f"{c}_oh" for c in categorical], dropLast=False,
                                    handleInvalid="error"))  # the indexer already maps unseen to its own slot
    stages.append(VectorAssembler(inputCols=[f"_{c}_n" for c in numeric] + [f"{c}_oh" for c in categorical],
                                  outputCol=out, handleInvalid="keep"))
    return stages


def prepare_matrix(df: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """Numeric inputs: NaN/Inf/NULL -> 0; categorical: NULL -> ``unknown``."""
    from panelrank.functions.exprs import nan_to_null
    cols = [F.coalesce(nan_to_null(c), F.lit(0.0)).alias(f"_{c}_n") for c in numeric]
    cols += [F.coalesce(F.col(c).cast("string"), F.lit(K.UNKNOWN)).alias(f"_{c}_s") for c in categorical]
    return df.select("*", *cols)


def with_balanced_weight(df: DataFrame, label: str, out: str = "_w") -> DataFrame:
    """weight = n / (2 n_class); the two counts are taken once, as a fit makes many passes over its rows and a join would count anew in each."""
    c = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("p")).first()
    n, p = c["n"], c["p"]
    of_class = lambda k: F.lit(n / (2.0 * k) if k else None).cast("double")
    return df.withColumn(out, F.when(F.col(label) == 1, of_class(p)).otherwise(of_class(None if p is None else n - p)))


def logistic(n_rows: int, label: str = "label") -> list:
    """Standardize, then balanced L2 logistic regression (E02, D-07: regParam = 1 / n)."""
    return [StandardScaler(inputCol="features", outputCol="_scaled", withMean=True, withStd=True),
            LogisticRegression(featuresCol="_scaled", labelCol=label, weightCol="_w", maxIter=1000, tol=1e-4,
                               regParam=1.0 / max(1, n_rows), elasticNetParam=0.0, standardization=False)]


def tree(label: str = "label", depth: int = 5, leaf: int = 50) -> list:
    """Balanced decision tree."""
    return [DecisionTreeClassifier(labelCol=label, weightCol="_w", maxDepth=depth, minInstancesPerNode=leaf,
                                   seed=SEED)]


def forest(label: str = "label", trees: int = 200, depth: int = 10, leaf: int = 25, balanced: bool = True, seed: int = SEED,
           memory_mb: int = 1024) -> list:
    """Random forest (E04); MLlib has no trees deeper than 30, so a greater depth is refused."""
    if depth > 30:
        raise ValueError(f"depth {depth}: trees are at most 30 deep")
    kw = {"weightCol": "_w"} if balanced else {}
    # maxMemoryInMB bounds the per-pass node statistics: larger = fewer passes over the data
    return [RandomForestClassifier(labelCol=label, numTrees=trees, maxDepth=depth,
                                   minInstancesPerNode=leaf, seed=seed, maxMemoryInMB=memory_mb, cacheNodeIds=True,
                                   **kw)]


FOREST_NODES = 240_000     # nodes that a fitted part of a forest has at most, as far as whole trees allow: the driver holds them
FOREST_MEMORY_MB = 256     # node statistics of a pass, which every task of an executor holds at once
FOREST_BAG = 0.64          # share of the rows that a bootstrap sample holds, of which a leaf has one at least
FOREST_MARGIN = 1.25       # a tree to come may have so many times the nodes of the mean of the part before


def fit_score_forest(train: DataFrame, test: DataFrame, numeric, categorical, label: str, out: str, trees: int, depth: int, leaf: int = 1,
                     balanced: bool = False) -> DataFrame:
    """``test`` with P(positive) by a forest whose trees together may be too large for one model.

    Trees don't depend on each other and a forest's probability is the mean of its trees', so the forest is fitted in parts; every
    part scores the rows and is let go. The driver grows the trees of a part, makes its model of them and sends that to
    the tasks that score, so a part has as many trees as have ``FOREST_NODES`` nodes, one at least: first by the most nodes that so many
    rows allow, then by the nodes of the trees fitted. What fits at once is one part, a plain forest. The rows of
    several parts are dealt evenly to the cores once, as every part passes over them at each level.
    """
    from panelrank.operators.ordered import materialized
    rows = train.count()
    most = nodes = max(1, min(2 ** (depth + 1), int(2 * min(max(1, rows // leaf), FOREST_BAG * rows))))
    scored, at = test.withColumn("_sum", F.lit(0.0)), 0
    several = FOREST_NODES // nodes < trees
    if several:
        train = materialized(evenly(train.select(*numeric, *categorical, label), rows))
        scored = materialized(evenly(scored, rows))
    while at < trees:
        n = max(1, min(trees - at, FOREST_NODES // nodes))
        model = fit(train, numeric, categorical, forest(label, n, depth, leaf, balanced, SEED + at, FOREST_MEMORY_MB), label)
        if several:
            nodes = max(1, min(most, int(FOREST_MARGIN * model.stages[-1].totalNumNodes / n)))
            released(train.sparkSession)
        scored = materialized(score(model, scored, numeric, categorical, "_part").withColumn("_sum", F.col("_sum") + F.col("_part") * n).drop("_part"))
        del model
        if several:
            released(train.sparkSession)
        at += n
    return scored.withColumn(out, F.col("_sum") / trees).drop("_sum")


def evenly(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in partitions of like size, at most ``FOREST_ROWS_PER_TASK`` of ``rows`` rows each, as many for every core."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores * max(1, -(-rows // (cores * FOREST_ROWS_PER_TASK))))


def released(spark) -> None:
    """Collects the driver's garbage: what a part leaves there makes its heap grow, and the broadcasts, kept rows and files that belong
    to it are removed by Spark's cleaner only then."""
    gc.collect()
    spark._jvm.System.gc()


def boosted(label: str = "label", depth: int = 5, iters: int = 50) -> list:
    """Gradient-boosted trees."""
    return [GBTClassifier(labelCol=label, weightCol="_w", maxDepth=depth, maxIter=iters, seed=SEED)]


MODEL_NAMES = ["logistic_regression", "decision_tree", "random_forest"]


def build_models(n_rows: int, label: str, forest_trees: int = 200) -> dict[str, list]:
    return {"logistic_regression": logistic(n_rows, label), "decision_tree": tree(label),
            "random_forest": forest(label, trees=forest_trees)}


def fit(df: DataFrame, numeric, categorical, model_stages: list, label: str) -> PipelineModel:
    x = with_balanced_weight(prepare_matrix(df, numeric, categorical).withColumn(label, F.col(label).cast("double")),
                             label)
    return Pipeline(stages=feature_stages(numeric, categorical) + model_stages).fit(x)


def score(model: PipelineModel, df: DataFrame, numeric, categorical, out: str) -> DataFrame:
    """P(positive) for every row (E07), original columns kept."""
    x = prepare_matrix(df, numeric, categorical)
    s = model.transform(x).withColumn(out, vector_to_array(F.col("probability"))[1])
    return s.select(*df.columns, out)


def feature_names(model: PipelineModel, df: DataFrame, numeric, categorical) -> list[str]:
    """Slot names of the assembled vector (numeric names, then ``cat=level``)."""
    names = list(numeric)
    for st in model.stages:
        if type(st).__name__ == "StringIndexerModel":
            for c, levels in zip(st.getInputCols(), st.labelsArray):
                names += [f"{c[1:-2]}={lv}" for lv in levels] + [f"{c[1:-2]}=__invalid__"]
    return names


def slot_sums(encoder: PipelineModel, mat: DataFrame, names: list[str]) -> DataFrame:
    """(slot, name, total) of the encoded matrix (E01): the sum of every numeric input, the rows of every level."""
    total = mat.agg(Summarizer.sum(F.col("features")).alias("s")).select(F.posexplode(vector_to_array("s")).alias("slot", "total"))
    return total.select("slot", F.get(F.array(*[F.lit(n) for n in names]), F.col("slot")).alias("name"), "total")


def importance(model: PipelineModel | PartedForest, names: list[str], top: int = 25) -> list[tuple[str, float]]:
    """|coef| (logistic) or impurity importance (trees), top 25."""
    last = None if isinstance(model, PartedForest) else model.stages[-1]
    if last is None:
        vals = model.importances()
    elif hasattr(last, "coefficients"):
        vals = [abs(float(v)) for v in last.coefficients.toArray()]
    elif hasattr(last, "featureImportances"):
        vals = [float(v) for v in last.featureImportances.toArray()]
    else:
        vals = [0.0] * len(names)
    pairs = list(zip(names, vals))
    pairs.sort(key=lambda t: (-t[1], t[0]))
    return pairs[:top]


def leaf_table(model: PipelineModel, df: DataFrame, numeric, categorical, label: str) -> DataFrame:
    """Readable tree leaves (E05): rows, positives and rate per leaf."""
    tree_model = model.stages[-1]
    tree_model.setLeafCol("_leaf")
    x = model.transform(prepare_matrix(df, numeric, categorical))
    return x.groupBy("_leaf").agg(F.count(F.lit(1)).alias("rows"),
                                  F.sum(F.col(label).cast("long")).alias("positives"),
                                  F.avg(F.col(label).cast("double")).alias("positive_rate")) \
        .withColumnRenamed("_leaf", "leaf")


SHUFFLE_ROWS = 1_000_000  # rows among which a value is exchanged
SCORE_ROWS = 50_000       # rows whose replicates one task scores


def _encoder(model: PipelineModel) -> tuple[PipelineModel, PipelineModel]:
    """(stages up to the assembled ``features``, stages that read them)."""
    cut = 1 + next(i for i, st in enumerate(model.stages) if isinstance(st, VectorAssembler))
    return PipelineModel(stages=model.stages[:cut]), PipelineModel(stages=model.stages[cut:])


def _slots(model: PipelineModel, numeric, categorical) -> dict[str, tuple[int, int]]:
    """First slot and number of slots of every input in the assembled vector."""
    widths = [(c, 1) for c in numeric]
    for st in model.stages:
        if type(st).__name__ == "StringIndexerModel":
            widths += [(c, len(levels) + 1) for c, levels in zip(categorical, st.labelsArray)]
    out, at = {}, 0
    for c, width in widths:
        out[c] = (at, width)
        at += width
    return out


def permutation_importance(model: PipelineModel, df: DataFrame, numeric, categorical, label: str, id_col: str, cols: list[str] | None = None,
                           repeats: int = 1, seed: int = SEED) -> DataFrame:
    """Permutation importance of every input as the drop in AUC (E11): feature, base_auc, shuffled_auc, auc_drop.

    One row stands in for another's value: rows are dealt by a hash of their id to random groups of about ``SHUFFLE_ROWS``
    and inside one, in hash order, each row takes the next row's value (the last one the first's), a permutation
    without fixed points. The same partner serves every feature, so one window pass over the rows gives all of them. Rows are encoded once; a
    replicate (a feature, a row) is the row's vector with that feature's slots from the partner's, scored by the stages
    behind the encoder and reduced to one AUC per feature by a grouped pass.
    """
    from panelrank.operators import metrics as M
    from panelrank.operators import ordered as O
    inputs = [*numeric, *categorical]
    cols = list(cols or inputs)
    encoder, predictor = _encoder(model)
    x = encoder.transform(prepare_matrix(df.select(F.col(id_col).alias("_id"), F.col(label).alias("_y"), *inputs), numeric, categorical))
    rows = O.materialized(x.select("_id", "_y", vector_to_array("features").alias("_x")))
    n = rows.count()
    groups = max(1, -(-n // SHUFFLE_ROWS))
    dealt = rows.withColumn("_rep", F.explode(F.sequence(F.lit(1), F.lit(repeats)))).withColumn("_h", F.xxhash64(F.col("_id").cast("string"), "_rep", F.lit(seed)))
    w = Window.partitionBy("_rep", F.pmod("_h", F.lit(groups))).orderBy("_h", "_id")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    paired = dealt.withColumn("_z", F.coalesce(F.lead("_x").over(w), F.first("_x").over(whole)))
    # the replicates are many times the rows, so they are made and scored in more tasks than there are groups
    paired = paired.repartition(max(-(-n * repeats // SCORE_ROWS), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "_h")
    slots = _slots(model, numeric, categorical)

    def replicate(name):
        at, width = slots[name]
        swapped = F.concat(F.slice("_x", 1, at), F.slice("_z", at + 1, width), F.slice("_x", at + width + 1, sum(v[1] for v in slots.values())))
        return F.struct(F.lit(name).alias("feature"), swapped.alias("_v"))

    shuffled = paired.select("_y", "_rep", F.inline(F.array(*[replicate(c) for c in cols])))
    plain = rows.select("_y", F.lit(0).alias("_rep"), F.lit("").alias("feature"), F.col("_x").alias("_v"))
    scored = predictor.transform(plain.unionByName(shuffled).select("_y", "_rep", "feature", array_to_vector("_v").alias("features"))) \
        .select("_y", "_rep", "feature", vector_to_array("probability")[1].alias("_p"))
    auc = O.materialized(M.roc_auc(scored, "_y", "_p", by=["feature", "_rep"]))
    base = auc.filter("feature = ''").select(F.col("roc_auc").alias("base_auc"))  # one row
    drop = auc.filter("feature <> ''").groupBy("feature").agg(F.avg("roc_auc").alias("shuffled_auc")).crossJoin(F.broadcast(base))
    return drop.select("feature", "base_auc", "shuffled_auc", (F.col("base_auc") - F.col("shuffled_auc")).alias("auc_drop"))


def leak_probe(train: DataFrame, test: DataFrame, base_cols: list[str], suspect: str, label: str,
               id_col: str) -> DataFrame:
    """Train with and without a suspect column, compare P@50 and AUC."""
    from panelrank.operators import metrics as M
    out = []
    for name, cols in (("without", base_cols), ("with", base_cols + [suspect])):
        m = fit(train, cols, [], tree(label, depth=4, leaf=1), label)
        s = score(m, test, cols, [], "_p")
        r = M.metric_row(s, label, "_p", id_col, name)
        out.append(r.select("model", "roc_auc", "precision_at_50"))
    return reduce(DataFrame.unionByName, out)


# ---------------------------------------------------------------- shared feature matrix
def fit_matrix(df: DataFrame, numeric, categorical, label: str, keep: list[str]):
    """Fit the encoding once (on all rows, as the one-hot matrix is built before the split)
    and return (encoder model, matrix with ``features`` + ``keep`` columns, written to the checkpoint folder)."""
    from panelrank.operators.ordered import materialized
    x = prepare_matrix(df, numeric, categorical).withColumn(label, F.col(label).cast("double"))
    enc = Pipeline(stages=feature_stages(numeric, categorical)).fit(x)
    return enc, materialized(sized(enc.transform(x).select(*keep, label, "features")))


ROWS_PER_TASK, MOST_ROWS_PER_TASK = 2_000, 25_000


def sized(df: DataFrame) -> DataFrame:
    """A matrix for fits: a small one spread over the cores (``ROWS_PER_TASK`` rows a task at least), since a fit is many passes over few rows;
    a larger one in partitions of ``MOST_ROWS_PER_TASK`` rows, since a forest keeps two numbers a tree beside every row and a task reads them."""
    n, cores = df.count(), df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(1, min(cores, -(-n // ROWS_PER_TASK)), -(-n // MOST_ROWS_PER_TASK)))


FOREST_ROWS = 250_000           # rows of a matrix from which a forest is fitted in parts
FOREST_PART = 50                # trees of a part
FOREST_ROWS_PER_TASK = 100_000  # rows of a part's task


class PartedForest:
    """A forest fitted in parts: its probability is the mean of its trees', so that of its parts by their trees."""

    def __init__(self, parts: list[PipelineModel]):
        self.parts = [(m, m.stages[-1].getNumTrees) for m in parts]
        self.trees = sum(n for _, n in self.parts)

    def importances(self) -> list[float]:
        """Impurity importances, each tree's adding up to 1 as in one forest."""
        total = sum(m.stages[-1].featureImportances.toArray() * n for m, n in self.parts)
        return [float(v) for v in total / (total.sum() or 1.0)]


def fit_on_matrix(mat: DataFrame, model_stages: list, label: str, rows: int = 0) -> PipelineModel | PartedForest:
    """Fit model stages on an encoded matrix with balanced weights of that subset.

    A forest alone on a matrix of more than ``FOREST_ROWS`` rows (``rows``, where known) is fitted in parts of ``FOREST_PART`` trees:
    a fit keeps three numbers a tree beside every row, and a task the statistics of all open nodes, which it sends on at every
    level. So a part holds a bounded share of both, and its tasks read more rows each than the matrix's.
    """
    x = with_balanced_weight(mat, label)
    if not parted(model_stages, rows):
        return Pipeline(stages=model_stages).fit(x)
    last = model_stages[0]
    x = x.coalesce(max(mat.sparkSession.sparkContext.defaultParallelism, -(-rows // FOREST_ROWS_PER_TASK)))
    trees = last.getNumTrees()
    return PartedForest([Pipeline(stages=[last.copy({last.numTrees: min(FOREST_PART, trees - at), last.seed: last.getSeed() + at})]).fit(x)
                         for at in range(0, trees, FOREST_PART)])


def parted(model_stages: list, rows: int) -> bool:
    """Whether these stages are a forest that is fitted in parts on so many rows."""
    return rows > FOREST_ROWS and len(model_stages) == 1 and isinstance(model_stages[0], RandomForestClassifier)


def score_matrix(model: PipelineModel | PartedForest, mat: DataFrame, out: str) -> DataFrame:
    return add_score(model, mat, out).drop("features")


def add_score(model: PipelineModel | PartedForest, df: DataFrame, out: str) -> DataFrame:
    """Append P(positive) as ``out``; the model's own output columns are dropped, inputs kept."""
    if isinstance(model, PartedForest):
        scored = df
        for i, (m, _) in enumerate(model.parts):
            scored = add_score(m, scored, f"_part_{i}")
        mean = reduce(lambda a, b: a + b, [F.col(f"_part_{i}") * n for i, (_, n) in enumerate(model.parts)]) / model.trees
        return scored.select(*df.columns, mean.alias(out))
    t = model.transform(df).withColumn(out, vector_to_array(F.col("probability"))[1])
    return t.select(*df.columns, out)
