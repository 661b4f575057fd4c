"""Steps whose share of one task must not grow with the tables."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from panelrank.operators import metrics as M
from panelrank.operators import models as E
from panelrank.operators import ordered as O
from panelrank.sources import fixtures as fx


def _lines(spark, out):
    """Small part, orders and lineitem tables, with an item that comes twice and keys that are NULL."""
    parts = [(i, f"Brand#{i % 3}", f"item {i}") for i in range(20)] + [(3, "Brand#0", "item 3b"), (None, "Brand#1", None)]
    spark.createDataFrame(parts, "p_partkey long, p_brand string, p_name string").write.parquet(f"{out}/part.parquet")
    orders = [(i, i % 7, "P" if i % 11 == 0 else "O", None if i % 13 == 0 else f"{i % 5}-X") for i in range(200)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string").write.parquet(f"{out}/orders.parquet")
    lines = [(None if i % 97 == 0 else i % 200, i % 21, float(1 + i % 9)) for i in range(1500)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_quantity double").write.parquet(f"{out}/lineitem.parquet")


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_query_rows_are_dealt_by_the_number_of_lines(spark, tmp_path, monkeypatch, threshold):
    """The tasks of the query fixture follow the lines, with the same rows."""
    _lines(spark, str(tmp_path))
    plain = sorted(map(str, fx.fx_query_all(spark, str(tmp_path)).collect()))
    monkeypatch.setattr(fx, "ROWS_PER_TASK", 50, raising=False)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        q = fx.fx_query_all(spark, str(tmp_path))
        assert q.rdd.getNumPartitions() == 30  # 1,500 lines
        assert sorted(map(str, q.collect())) == plain
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_importance_scores_replicates_in_many_tasks(spark, monkeypatch):
    """F2: replicates are scored in tasks by the number of rows, not of shuffle groups, and equal a model run on swapped inputs."""
    rows = [(i, int(i % 5 < 2), float(i % 5) if i % 17 else None, float(i % 3), f"k{i % 4}" if i % 19 else None) for i in range(600)]
    df = spark.createDataFrame(rows, "content_id long, label int, a double, b double, kind string")
    m = E.fit(df, ["a", "b"], ["kind"], E.tree("label", depth=4, leaf=1), "label")
    monkeypatch.setattr(E, "SCORE_ROWS", 20, raising=False)
    tasks, auc = [], M.roc_auc
    monkeypatch.setattr(M, "roc_auc", lambda d, *a, **k: (tasks.append(d.rdd.getNumPartitions()), auc(d, *a, **k))[1])
    got = {r["feature"]: (r["base_auc"], r["shuffled_auc"]) for r in E.permutation_importance(m, df, ["a", "b"], ["kind"], "label", "content_id").collect()}
    assert tasks[0] >= 30
    h = df.select("*", F.xxhash64(F.col("content_id").cast("string"), F.lit(1), F.lit(E.SEED)).alias("h")).orderBy("h", "content_id").collect()
    base = auc(E.score(m, df, ["a", "b"], ["kind"], "p"), "label", "p").first()[0]
    for c in ("a", "b", "kind"):
        swapped = [(r["content_id"], r["label"], *[(h[(i + 1) % len(h)] if x == c else r)[x] for x in ("a", "b", "kind")]) for i, r in enumerate(h)]
        want = auc(E.score(m, spark.createDataFrame(swapped, df.schema), ["a", "b"], ["kind"], "p"), "label", "p").first()[0]
        assert got[c] == (pytest.approx(base), pytest.approx(want))


def test_average_precision_of_replicates_needs_no_array_per_score(spark, monkeypatch):
    """buckets, chunks, ties and NaN give the plain definition, and no prefix over arrays of every score is taken."""
    rng = np.random.default_rng(5)
    n, reps = 400, 20
    s = np.where(rng.random(n) < 0.4, 0.5, rng.integers(0, 60, n) / 60)
    s[:7] = np.nan
    y, g = rng.integers(0, 2, n), rng.integers(0, 6, n)
    df = spark.createDataFrame([(f"g{a}", int(b), float(c)) for a, b, c in zip(g, y, s)], "_g string, label int, score double")
    w = rng.poisson(1.0, (6, reps)).astype(float)
    weights = spark.createDataFrame([(f"g{i}", w[i].tolist()) for i in range(6)], "_g string, _w array<double>")
    monkeypatch.setattr(O, "ordered_array_prefix", lambda *a, **k: pytest.fail("an array for every score"))
    for chunk, per_bucket in ((4096, None), (7, 10)):
        monkeypatch.setattr(M, "AP_CHUNK", chunk, raising=False)
        got = M._weighted_ap(df, weights, "label", "score", reps, **({"rows_per_bucket": per_bucket} if per_bucket else {})).first()[0]
        key = np.where(np.isnan(s), 9.0, s)
        for r in range(reps):
            wr, tp, al, ap = w[g, r], 0.0, 0.0, 0.0
            for v in sorted(set(key), reverse=True):
                p, a = (wr * y)[key == v].sum(), wr[key == v].sum()
                tp, al = tp + p, al + a
                ap += p * tp / al if al else 0.0
            assert got[r] == pytest.approx(ap / tp if 0 < tp < al else 0.0)


def test_forest_is_fitted_in_parts(spark, monkeypatch):
    """a forest of many nodes is fitted in parts whose mean it is, and a pass holds little per task."""
    rows = [(i, int((i * 7919) % 101 < 50), float((i * 31) % 97), float(i % 13)) for i in range(400)]
    df = spark.createDataFrame(rows, "content_id long, label int, a double, b double").repartition(2, "content_id").cache()
    run = lambda: {r["content_id"]: r["p"] for r in E.fit_score_forest(df, df, ["a", "b"], [], "label", "p", 6, 5).collect()}
    seen, fit = [], E.fit

    def one(*a):
        seen.append(fit(*a))
        return seen[-1]

    monkeypatch.setattr(E, "fit", one)
    whole = run()
    assert [m.stages[-1].getNumTrees for m in seen] == [6] and seen[0].stages[-1].getMaxMemoryInMB() <= 256
    plain = {r["content_id"]: r["p"] for r in E.score(seen[0], df, ["a", "b"], [], "p").collect()}
    assert whole == pytest.approx(plain)
    seen.clear()
    monkeypatch.setattr(E, "FOREST_NODES", 4 * 64)  # four trees of depth 5
    parted = run()
    assert [m.stages[-1].getNumTrees for m in seen] == [4, 2]
    four, two = ({r["content_id"]: r["p"] for r in E.score(m, df, ["a", "b"], [], "p").collect()} for m in seen)
    assert parted == pytest.approx({i: (4 * four[i] + 2 * two[i]) / 6 for i in four})


def test_forest_parts_follow_the_nodes_of_fitted_trees(spark, monkeypatch):
    """the driver holds a bounded number of nodes: the first part follows the most nodes a tree can have, later ones the trees fitted."""
    assert E.FOREST_NODES <= 250_000
    rows = [(i, int((i * 7919) % 101 < 50), float((i * 31) % 97), float(i % 13), None if i % 5 else "x") for i in range(400)]
    plain = spark.createDataFrame([(i, int(i % 7 < 3), float(i % 7), float(i % 2), "x") for i in range(400)], "content_id long, label int, a double, b double, note string")
    noisy = spark.createDataFrame(rows, plain.schema)
    seen, tasks, freed, fit, released = [], [], [], E.fit, E.released

    def one(df, *a):
        tasks.append(df.rdd.getNumPartitions())
        seen.append(fit(df, *a))
        return seen[-1]

    monkeypatch.setattr(E, "fit", one)
    monkeypatch.setattr(E, "released", lambda s: (freed.append(len(seen)), released(s)))
    monkeypatch.setattr(E, "FOREST_NODES", 1100)  # two trees of at most 512 nodes
    for df in (plain, noisy):
        for x in (seen, tasks, freed):
            x.clear()
        got = E.fit_score_forest(df.repartition(3), df.repartition(3), ["a", "b"], [], "label", "p", 12, 30)
        assert got.columns == [*df.columns, "p"]
        p = {r["content_id"]: r["p"] for r in got.collect()}
        n = [m.stages[-1].getNumTrees for m in seen]
        nodes = [m.stages[-1].totalNumNodes for m in seen]
        assert n[0] == 2 and sum(n) == 12 and max(nodes) <= 1100 and len(p) == 400
        assert n[1] == min(10, 1100 // max(1, int(1.25 * nodes[0] / 2)))
        assert set(tasks) == {spark.sparkContext.defaultParallelism} and freed == sorted([*range(1, len(n) + 1)] * 2)
        of = [{r["content_id"]: r["p"] for r in E.score(m, df, ["a", "b"], [], "p").collect()} for m in seen]
        assert p == pytest.approx({i: sum(k * o[i] for k, o in zip(n, of)) / 12 for i in p})


def test_matrix_partitions_follow_the_rows(spark):
    """the rows of a matrix that one task reads are bounded, and a small matrix is spread over the cores."""
    assert E.sized(spark.range(600_000)).rdd.getNumPartitions() == 24
    assert E.sized(spark.range(20_000)).rdd.getNumPartitions() == 4
    assert E.sized(spark.range(0)).rdd.getNumPartitions() == 1


def test_class_weights_need_no_join(spark):
    """a fit passes over its rows many times; its class weights are constants, not a join that counts the classes anew each time."""
    df = spark.createDataFrame([(1, 1.0)] * 3 + [(2, 0.0)] * 5, "id long, y double")
    w = E.with_balanced_weight(df, "y")
    assert "Join" not in w._jdf.queryExecution().executedPlan().toString()
    assert {(r.y, r._w) for r in w.distinct().collect()} == {(1.0, 8 / 6), (0.0, 8 / 10)}
    assert [r._w for r in E.with_balanced_weight(df.filter("y = 0"), "y").distinct().collect()] == [0.5]


def test_large_forest_on_a_matrix_is_fitted_in_parts(spark, monkeypatch):
    """on many rows a forest is fitted in parts on few partitions; score and importance are those of all its trees. Few rows: one plain forest."""
    rows = [(i, float((i * 7919) % 101 < 50), float((i * 31) % 97), float(i % 13)) for i in range(400)]
    mat = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(
        spark.createDataFrame(rows, "content_id long, label double, a double, b double").repartition(64, "content_id")).select("content_id", "label", "features").cache()
    stages = E.forest("label", 5, depth=4, leaf=5)
    assert len(E.fit_on_matrix(mat, stages, "label", 400).stages) == 1
    monkeypatch.setattr(E, "FOREST_ROWS", 100)
    monkeypatch.setattr(E, "FOREST_PART", 2)
    seen, weight = [], E.with_balanced_weight

    def weighted(*a):
        seen.append(weight(*a))
        return seen[-1]

    monkeypatch.setattr(E, "with_balanced_weight", weighted)
    m = E.fit_on_matrix(mat, stages, "label", 400)
    assert [n for _, n in m.parts] == [2, 2, 1] and len(seen) == 1
    assert len({p.stages[-1].trees[0].toDebugString for p, _ in m.parts}) == 3  # parts are different trees
    of = [{r["content_id"]: r["probability"][1] for r in p.transform(mat).collect()} for p, _ in m.parts]
    mean = {i: (2 * of[0][i] + 2 * of[1][i] + of[2][i]) / 5 for i in of[0]}
    for scored in (E.score_matrix(m, mat, "p"), E.add_score(m, mat, "p")):
        assert {r["content_id"]: r["p"] for r in scored.collect()} == pytest.approx(mean)
    assert E.score_matrix(m, mat, "p").columns == ["content_id", "label", "p"]
    imp = sum(p.stages[-1].featureImportances.toArray() * n for p, n in m.parts) / 5
    assert dict(E.importance(m, ["a", "b"])) == pytest.approx(dict(zip("ab", imp)))
    tree = E.fit_on_matrix(mat, E.tree("label", leaf=5), "label", 400)
    assert len(tree.stages) == 1
