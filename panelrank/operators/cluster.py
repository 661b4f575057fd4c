"""Archetype clustering with MLlib.

log1p + standardize + K-Means, k chosen by silhouette; PCA(2) projection;
cluster profiles; stability across seeds by the adjusted Rand index from a
contingency table (a grouped count, k x k rows).
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelrank.operators.ordered import materialized


def _matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    x = df.select("*", *[F.log1p(F.greatest(F.coalesce(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)))
                         .alias(f"_k_{c}") for c in cols])
    return x


def _stages(cols):
    return [VectorAssembler(inputCols=[f"_k_{c}" for c in cols], outputCol="_raw"),
            StandardScaler(inputCol="_raw", outputCol="_kfeat", withMean=True, withStd=True)]


def archetypes(df: DataFrame, cols: list[str], ks=(3, 4, 5), seed: int = 42):
    """Fit K-Means for each k, keep the best silhouette (K01). Returns (assigned frame, scores)."""
    x = _matrix(df, cols)
    prep = Pipeline(stages=_stages(cols)).fit(x)
    m = materialized(prep.transform(x))
    ev = ClusteringEvaluator(featuresCol="_kfeat", predictionCol="cluster")
    scores, best = [], None
    for k in ks:
        model = KMeans(featuresCol="_kfeat", predictionCol="cluster", k=k, seed=seed).fit(m)
        s = ev.evaluate(model.transform(m))
        scores.append((k, float(s)))
        if best is None or s > best[1]:
            best = (k, s, model)
    out = best[2].transform(m).drop("_raw", "_kfeat", *[f"_k_{c}" for c in cols])
    return out, df.sparkSession.createDataFrame(scores, "k int, silhouette double")


def project_2d(df: DataFrame, cols: list[str]) -> DataFrame:
    """Two-dimensional PCA projection."""
    x = _matrix(df, cols)
    p = Pipeline(stages=_stages(cols) + [PCA(k=2, inputCol="_kfeat", outputCol="_pc")]).fit(x)
    from pyspark.ml.functions import vector_to_array
    y = p.transform(x).withColumn("_a", vector_to_array("_pc"))
    return y.select(*df.columns, F.col("_a")[0].alias("pc1"), F.col("_a")[1].alias("pc2"))


def cluster_profile(df: DataFrame, cluster: str, cols: list[str], actions: dict | None = None) -> DataFrame:
    """Per cluster size and exact medians of each column; optional literal action map."""
    from panelrank.operators.aggregates import grouped_quantiles
    prof = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("size"))
    long = df.select(cluster, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(cluster, cols, "_c", "_x")
    med = grouped_quantiles(long, [cluster, "_c"], "_x", [0.5])
    wide = med.groupBy(cluster).agg(*[F.max(F.when(F.col("_c") == c, F.col("q0"))).alias(f"median_{c}") for c in cols])
    prof = prof.join(wide, cluster, "left")
    if actions:
        m = F.create_map(*[x for k, v in actions.items() for x in (F.lit(k), F.lit(v))])
        prof = prof.withColumn("action", m[F.col(cluster)])
    return prof


def cluster_stability(df: DataFrame, cols: list[str], k: int, seeds=(1, 2)) -> DataFrame:
    """Adjusted Rand index between two K-Means runs with different seeds."""
    x = _matrix(df, cols)
    prep = Pipeline(stages=_stages(cols)).fit(x)
    m = materialized(prep.transform(x))
    a = KMeans(featuresCol="_kfeat", predictionCol="_ca", k=k, seed=seeds[0]).fit(m).transform(m)
    ab = KMeans(featuresCol="_kfeat", predictionCol="_cb", k=k, seed=seeds[1]).fit(a).transform(a)
    return adjusted_rand(ab, "_ca", "_cb").select(F.lit(k).alias("k"), "adjusted_rand", "n")


def contingency(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rows in every pair of clusters of two assignments (K04): one grouped count, k x k cells."""
    return df.groupBy(F.col(a).alias("cluster_a"), F.col(b).alias("cluster_b")).agg(F.count(F.lit(1)).alias("rows"))


def adjusted_rand(df: DataFrame, a: str, b: str) -> DataFrame:
    """Adjusted Rand index of two assignments of the same rows (K04), from their contingency table.

    1 for equal partitions, also where both put all rows into one cluster.
    """
    ct = contingency(df, a, b)

    def comb2(c):
        return c * (c - 1) / 2.0

    sij = ct.agg(F.sum(comb2(F.col("rows"))).alias("sij"), F.sum("rows").alias("n"))
    ai = ct.groupBy("cluster_a").agg(F.sum("rows").alias("a")).agg(F.sum(comb2(F.col("a"))).alias("sa"))
    bj = ct.groupBy("cluster_b").agg(F.sum("rows").alias("b")).agg(F.sum(comb2(F.col("b"))).alias("sb"))
    j = sij.crossJoin(ai).crossJoin(bj)  # one row each
    exp = F.when(F.col("n") > 1, F.col("sa") * F.col("sb") / comb2(F.col("n"))).otherwise(F.lit(0.0))
    mx = (F.col("sa") + F.col("sb")) / 2
    return j.select(F.when(mx == exp, F.lit(1.0)).otherwise((F.col("sij") - exp) / (mx - exp)).alias("adjusted_rand"), "n")
