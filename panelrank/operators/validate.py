"""Cross-validation over given folds (L05 with E07, M02, M04).

Each fold's rows are scored by a model that was fitted on the other folds, so with folds from ``split.group_folds`` no
client is in the training rows of its own score. MLlib's own ``CrossValidator`` checks its fold column row by row in a Python
function and keeps one average per candidate; here a fold is a plain filter on the encoded matrix, the candidates' fits
are independent jobs, and all metrics come from one grouped pass over the out-of-fold scores.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelrank.operators import metrics as M
from panelrank.operators import models as E
from panelrank.session import ensure_checkpoint_dir


def check_folds(mat: DataFrame, fold: str, folds: int, label: str) -> None:
    """Raise if a row's fold is NULL or outside 0 .. folds - 1, a fold is empty, or what is left without it has one class."""
    seen = {r["f"]: r for r in mat.groupBy(F.when(F.col(fold).between(0, folds - 1), F.col(fold)).alias("f"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("p")).collect()}  # folds + 1 rows
    if None in seen:
        raise ValueError(f"{seen[None]['n']} rows have a {fold} outside 0 .. {folds - 1}")
    empty = [i for i in range(folds) if i not in seen]
    if empty:
        raise ValueError(f"folds without rows: {empty}")
    n, p = sum(r["n"] for r in seen.values()), sum(r["p"] for r in seen.values())
    for i, r in seen.items():
        if p - r["p"] in (0, n - r["n"]):
            raise ValueError(f"without fold {i} the label has one class")


def out_of_fold(mat: DataFrame, candidates: dict[str, list], label: str, fold: str, folds: int, workers: int = 4) -> DataFrame:
    """(candidate, the matrix's columns but ``features``, probability): every row once per candidate, scored by the model
    that did not see its fold. The scores are checkpointed, so no model is applied twice."""
    mat = mat.persist()  # a fit reads its rows many times; what doesn't fit into memory lies on the executors' disks
    check_folds(mat, fold, folds, label)

    def one(job):
        name, i = job
        model = E.fit_on_matrix(mat.filter(F.col(fold) != i), candidates[name], label)
        return E.score_matrix(model, mat.filter(F.col(fold) == i), "probability").select(F.lit(name).alias("candidate"), "*")

    jobs = [(name, i) for name in candidates for i in range(folds)]
    with ThreadPoolExecutor(max_workers=workers) as pool:
        parts = list(pool.map(one, jobs))
    ensure_checkpoint_dir(mat.sparkSession)
    scores = reduce(DataFrame.unionByName, parts).checkpoint(eager=True)
    mat.unpersist()
    return scores


def fold_metrics(scores: DataFrame, label: str, score: str, id_col: str, by: list[str], k: int = 50) -> DataFrame:
    """Rows, positives, ROC AUC and precision@K of every group of ``by`` (say candidate and fold)."""
    size = scores.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("positives"))
    auc = M.roc_auc(scores, label, score, by=by)
    top = M.grouped_precision_at_k(scores, label, score, id_col, k, by)
    return size.join(auc, by).join(top, by)


def best_candidate(per_fold: DataFrame, order: list[str], k: int = 50) -> str:
    """The candidate with the greatest mean (precision@K, AUC) over its folds; ties go to the one given first."""
    rows = per_fold.groupBy("candidate").agg(F.avg(f"precision_at_{k}").alias("p"), F.avg("roc_auc").alias("a")).collect()  # one per candidate
    return max(rows, key=lambda r: (r["p"], r["a"], -order.index(r["candidate"])))["candidate"]


def cross_validate(df: DataFrame, numeric: list[str], categorical: list[str], candidates: dict[str, list], label: str, fold: str,
                   folds: int, keep: list[str], id_col: str, k: int = 50) -> tuple[DataFrame, DataFrame, str]:
    """(out-of-fold scores, metrics per candidate and fold, chosen candidate); ``df`` has the fold column.

    The encoding reads no label, so it is fitted once on all rows, as before every other split.
    """
    enc, mat = E.fit_matrix(df, numeric, categorical, label, [*keep, fold])
    scores = out_of_fold(mat, candidates, label, fold, folds)
    per_fold = fold_metrics(scores, label, "probability", id_col, ["candidate", fold], k)
    return scores, per_fold, best_candidate(per_fold, list(candidates), k)
