"""Cross-validation on given folds, importance of every input, intervals by client, sketches."""

import collections
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from panelrank.operators import metrics as M
from panelrank.operators import models as E
from panelrank.operators import ordered as O
from panelrank.operators import sketches as SK
from panelrank.operators import split as L
from panelrank.operators import validate as CV

COLS = ["x1", "x2", "noise"]


def _rows(n=900, clients=12, seed=1):
    """The label follows x1 and, above all, the client: a model that has seen a client knows its pages."""
    rng = random.Random(seed)
    love = {c: rng.random() < 0.5 for c in range(clients)}
    out = []
    for i in range(n):
        c = rng.randrange(clients)
        x1 = rng.random()
        y = int(love[c]) if rng.random() < 0.9 else int(x1 > 0.5)
        out.append((i, f"c{c}" if c else None, x1, rng.random(), rng.random(), y))
    return out


@pytest.fixture(scope="module")
def folded(spark):
    df = spark.createDataFrame(_rows(), "content_id long, client_id string, x1 double, x2 double, noise double, label int")
    return L.group_folds(df, "client_id", 4)


def test_no_client_is_in_its_own_training_fold(spark, folded):
    _, mat = E.fit_matrix(folded, COLS, ["client_id"], "label", ["content_id", "fold"])
    sides = folded.groupBy("client_id").agg(F.countDistinct("fold").alias("k"))
    assert sides.filter("k <> 1").count() == 0
    scores = CV.out_of_fold(mat, {"t": E.tree("label", depth=6, leaf=1)}, "label", "fold", 4)
    assert scores.count() == 900 and scores.select("content_id").distinct().count() == 900
    # each fold's scores are those of a model fitted without it
    for i in range(4):
        m = E.fit_on_matrix(mat.filter(F.col("fold") != i), E.tree("label", depth=6, leaf=1), "label")
        want = {r.content_id: r.p for r in E.score_matrix(m, mat.filter(F.col("fold") == i), "p").collect()}
        got = {r.content_id: r.probability for r in scores.filter(F.col("fold") == i).collect()}
        assert got == want
    # a model that may look up the client is right on its own rows and knows nothing of a client it has not seen
    whole = E.score_matrix(E.fit_on_matrix(mat, E.tree("label", depth=6, leaf=1), "label"), mat, "p")
    assert M.roc_auc(whole, "label", "p").first()["roc_auc"] > 0.9
    assert M.roc_auc(scores, "label", "probability").first()["roc_auc"] < 0.75


def test_cross_validate_metrics_and_choice(folded):
    cands = {"flat": E.tree("label", depth=1, leaf=1), "deep": E.tree("label", depth=4, leaf=20)}
    scores, per_fold, best = CV.cross_validate(folded, COLS, [], cands, "label", "fold", 4, ["content_id", "client_id"], "content_id", k=20)
    rows = per_fold.collect()
    assert {(r.candidate, r.fold) for r in rows} == {(c, i) for c in cands for i in range(4)} and best in cands
    by = collections.defaultdict(list)
    for r in scores.collect():
        by[r.candidate, r.fold].append((-r.probability, r.content_id, int(r.label)))
    for r in rows:
        own = sorted(by[r.candidate, r.fold])
        pos, neg = [s for s, _, y in own if y], [s for s, _, y in own if not y]
        auc = sum((p < n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
        assert r.n == len(own) and r.positives == len(pos) and abs(r.roc_auc - auc) < 1e-12
        assert r.precision_at_20 == sum(y for _, _, y in own[:20]) / 20


def test_folds_are_checked(folded):
    _, mat = E.fit_matrix(folded, COLS, [], "label", ["content_id", "fold"])
    with pytest.raises(ValueError, match="without rows"):
        CV.check_folds(mat, "fold", 5, "label")
    with pytest.raises(ValueError, match="outside"):
        CV.check_folds(mat, "fold", 3, "label")
    with pytest.raises(ValueError, match="one class"):
        CV.check_folds(mat.withColumn("label", (F.col("fold") == 1).cast("int")), "fold", 4, "label")


def test_importance_of_all_inputs_ranks_the_planted_signal_first(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, rng.random(), rng.random(), rng.choice("abc"), 0.0) for i in range(600)]
    df = spark.createDataFrame([(*r, int(r[1] > 0.5)) for r in rows], "content_id long, x1 double, x2 double, kind string, constant double, label int")
    m = E.fit(df, ["x1", "x2", "constant"], ["kind"], E.tree("label", depth=3, leaf=1), "label")
    for size in (E.SHUFFLE_ROWS, 50):  # one group and twelve
        monkeypatch.setattr(E, "SHUFFLE_ROWS", size)
        got = {r.feature: r for r in E.permutation_importance(m, df, ["x1", "x2", "constant"], ["kind"], "label", "content_id", repeats=2).collect()}
        assert set(got) == {"x1", "x2", "constant", "kind"}
        assert got["x1"].base_auc == 1.0 and 0.4 < got["x1"].shuffled_auc < 0.6
        assert all(abs(got[f].auc_drop) < 1e-12 for f in ("x2", "constant", "kind"))


def _weight(key, rep, seed=42):
    u = int(hashlib.md5(f"{key}|{rep}|{seed}".encode()).hexdigest()[:13], 16) / float(1 << 52)
    return sum(u >= e for e in M.poisson_edges())


def _brute(rows, score, rep, k):
    w = {c: _weight(c or "unknown", rep) for c in {r[1] for r in rows}}
    ranked = sorted(((-(r[score] or 0.0), r[0], r[5], w[r[1]]) for r in rows))
    n = sum(x[3] for x in ranked)
    acc = sum(x[3] for x in ranked if (x[0] <= -0.5) == bool(x[2])) / n if n else 0.0
    left, hit, took = k, 0, 0
    for _, _, y, c in ranked:
        t = min(c, left)
        left, hit, took = left - t, hit + y * t, took + t
    groups = collections.OrderedDict()
    for s, _, y, c in ranked:
        g = groups.setdefault(s, [0, 0])
        g[0] += y * c
        g[1] += c
    tp = al = 0
    ap, pos = 0.0, sum(g[0] for g in groups.values())
    for p, a in groups.values():
        tp, al = tp + p, al + a
        ap += p * tp / al if al else 0.0
    return {"accuracy": acc, f"precision_at_{k}": hit / took if took else 0.0, "average_precision": ap / pos if 0 < pos < n else 0.0}


def test_intervals_by_client_equal_brute_force(spark):
    rows = [(i, c, round(a, 1), round(b, 1), None, y) for i, c, a, b, _, y in _rows(300, 6, 5)]
    rows += [(1000 + i, "hot", 0.95, 0.5, None, i % 2) for i in range(150)]  # a third of the rows on one client, at the top
    df = spark.createDataFrame(rows, "content_id long, client_id string, a double, b double, z double, label int")
    reps, k = 30, 40
    for per_bucket in (O.ROWS_PER_BUCKET, 60):
        got = {r.metric: r for r in M.bootstrap_by_group(df, "label", "a", "b", "content_id", "client_id", ("accuracy", f"precision_at_{k}", "average_precision"), reps=reps,
                                                         rows_per_bucket=per_bucket).collect()}
        for m, r in got.items():
            diffs = sorted(_brute(rows, 2, rep, k)[m] - _brute(rows, 3, rep, k)[m] for rep in range(1, reps + 1))
            at = lambda q: diffs[int(q * (reps - 1))] + (q * (reps - 1) % 1) * (diffs[min(reps - 1, int(q * (reps - 1)) + 1)] - diffs[int(q * (reps - 1))])  # noqa: B023, E731
            assert r.reps == reps and abs(r.mean_diff - sum(diffs) / reps) < 1e-9 and abs(r.lo - at(0.025)) < 1e-9 and abs(r.hi - at(0.975)) < 1e-9, m
    # clients kept together spread wider than rows drawn alone
    alone = M.bootstrap_diff(df, "label", "a", "b", "content_id", reps=reps).first()
    assert got["accuracy"].hi - got["accuracy"].lo > alone.hi - alone.lo
    with pytest.raises(ValueError, match="no metric"):
        M.bootstrap_by_group(df, "label", "a", "b", "content_id", "client_id", ("f2",))


def test_intervals_of_an_empty_table(spark):
    df = spark.createDataFrame([], "content_id long, client_id string, a double, b double, label int")
    got = M.bootstrap_by_group(df, "label", "a", "b", "content_id", "client_id", reps=5).collect()
    assert {(r.metric, r.mean_diff, r.reps) for r in got} == {("accuracy", 0.0, 5), ("precision_at_50", 0.0, 5), ("average_precision", 0.0, 5)}


def test_array_prefix_equals_plain_prefixes(spark):
    rng = random.Random(7)
    rows = [(i, rng.choice([None, 1.0, 2.0, float("nan"), rng.random()]), [float(rng.randrange(5)) for _ in range(3)]) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, s double, v array<double>")
    got = {r.id: r["_before_v"] for r in O.ordered_array_prefix(df, [("s", True), "id"], "v", 3, rows_per_bucket=50).collect()}
    order = sorted(rows, key=lambda r: (r[1] is None, 0 if r[1] is None or r[1] != r[1] else 1, 0 if r[1] is None or r[1] != r[1] else -r[1], r[0]))
    run = [0.0, 0.0, 0.0]
    for i, _, v in order:
        assert got[i] == run
        run = [a + b for a, b in zip(run, v, strict=True)]


def test_sketches_stay_within_their_rank_error(spark):
    rng = random.Random(11)
    vals = [(c, m, rng.choice([1.0, 2.0, rng.gauss(0, 1) * 10 ** rng.randrange(4)])) for c in ("a", "b", None) for m in ("1", "2") for _ in range(3000)]
    vals += [("a", "1", None), ("a", "2", float("nan")), ("void", "1", None)] + [("hot", "1", 5.0)] * 9000
    df = spark.createDataFrame(vals, "client string, month string, x double")
    kept = O.materialized(SK.quantile_sketch(df, ["client", "month"], "x"))
    qs = [0.01, 0.25, 0.5, 0.75, 0.99]
    for by in (["client"], []):
        found = O.materialized(SK.sketch_quantiles(SK.merge_sketches(kept, by), qs))
        assert {tuple(r) for r in found.select(*by, "n").collect()} == ({("a", 6000), ("b", 6000), (None, 6000), ("hot", 9000), ("void", 0)} if by else {(27000,)})
        if by:
            assert found.filter("client = 'void'").first()["q2"] is None and found.filter("client = 'hot'").first()["q0"] == 5.0
        for r in SK.rank_check(df.na.fill("?", ["client"]), by, "x", found.na.fill("?", by or None), qs).collect():
            assert r.rank_low - 2 * SK.rank_error() <= r.q <= r.rank_high + 2 * SK.rank_error()


def test_ranks_and_folds_leave_nothing_persisted(spark):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    df = spark.createDataFrame(_rows(200), "content_id long, client_id string, x1 double, x2 double, noise double, label int")
    O.pct_rank(df, "x1", "r").count()
    M.roc_auc(df, "label", "x1", by=["client_id"]).count()
    M.compare(df, "label", {"a": "x1", "b": "x2"}, "content_id").count()
    L.client_holdout(df, "client_id", "label")[0].count()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_per_value_tables_are_broadcast_by_bytes(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for text, size, fits in (("10485760", 10 << 20, True), ("10485760", (10 << 20) + 1, False), ("64m", 64 << 20, True), ("64MB", 65 << 20, False), ("1g", 1 << 30, True), ("-1", 0, False), ("100b", 100, True)):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", text)
            assert O.fits_broadcast(spark, size) is fits
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        df = spark.createDataFrame([(i, float(i % 7)) for i in range(50)], "id long, v double")
        got = {r.id: r.p for r in O.pct_rank(df, "v", "p").collect()}
        assert got[0] == got[7] and len(got) == 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
