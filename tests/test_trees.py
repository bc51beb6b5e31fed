"""Trees and ensembles against plain versions, and on many rows as on few."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from lastmile.operators import big_trees, ensembles, trees
from lastmile.operators.ensembles import Trees, TreesModel
from lastmile.operators.trees import Boost, Rule

LEVELS = [np.arange(300.0)] * 4


def made_rows(n=500, seed=1):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(0, 20, n), rng.integers(0, 2, n), rng.integers(0, 6, n), np.zeros(n)], 1).astype(np.uint8)
    y = np.round(x[:, 0] * 1.5 + 4 * x[:, 1] * (x[:, 2] > 2) + rng.normal(0, 1, n), 3)
    return x, y


def slow_split(x, y, w, min_leaf):
    """(gain, slot, cut) by trying every cut."""
    best = (-np.inf, 0, 0)
    square = lambda m: (w[m] * y[m]).sum() ** 2 / w[m].sum()
    for s in range(x.shape[1]):
        for cut in np.unique(x[w > 0, s])[:-1]:
            left = x[:, s] <= cut
            if min(w[left].sum(), w[~left].sum()) >= min_leaf:
                gain = square(left) + square(~left) - square(np.ones(len(y), bool))
                if gain > best[0] + 1e-9:
                    best = (gain, s, int(cut))
    return best


def slow_tree(x, y, w, depth, min_leaf):
    if depth == 0 or w.sum() < 2 * min_leaf:
        return (w * y).sum() / w.sum()
    gain, s, cut = slow_split(x, y, w, min_leaf)
    if gain <= 1e-6:
        return (w * y).sum() / w.sum()
    left = x[:, s] <= cut
    return s, cut, slow_tree(x[left], y[left], w[left], depth - 1, min_leaf), slow_tree(x[~left], y[~left], w[~left], depth - 1, min_leaf)


def slow_predict(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


@pytest.mark.parametrize(("depth", "min_leaf"), [(1, 1), (3, 1), (4, 7), (30, 1)])
def test_tree_equals_one_that_tries_every_cut(depth, min_leaf):
    x, y = made_rows()
    w = trees.poisson_one(trees.uniform(3, np.arange(len(y))))
    tree = trees.grow(x, y[:, None], w, Rule(depth=depth, min_leaf=min_leaf), 1, LEVELS).arrays()
    used = w > 0
    want = slow_tree(x[used], y[used], w[used], depth, min_leaf)
    got = tree["value"][trees.leaf_of(tree, x[used]), 0]
    assert got == pytest.approx([slow_predict(want, r) for r in x[used]], abs=1e-4)


@pytest.mark.parametrize("rule", [Rule(), Rule(random_cuts=True), Rule(features=2), Rule(random_cuts=True, features=2, min_leaf=3)])
def test_histograms_and_sorting_choose_alike(rule):
    x, y = made_rows()
    rank = np.random.default_rng(2).integers(0, 9, len(y))
    keys, w = np.arange(9).astype(np.uint64), np.ones(len(y))
    flat = x.astype(np.int64) + np.arange(4) * 20
    a = trees.splits_of_histograms(*trees.histograms(flat, rank, 9, y[:, None], w, 20), keys, 5, rule, LEVELS)
    b = trees.splits_by_sorting(np.ascontiguousarray(x.T), rank, keys, y[:, None], w, 5, rule, LEVELS)
    assert a[0] == pytest.approx(b[0])
    assert (a[1] == b[1]).all() and (a[2] == b[2]).all()


def test_random_cuts_are_random_and_cover_the_range():
    x, y = made_rows(2000)
    cuts = [
        t.cut[0] for i in range(300)
        if (t := trees.grow(x, y[:, None], np.ones(len(y)), Rule(depth=1, random_cuts=True, features=1), i, LEVELS)).slot[0] == 0
    ]
    assert len(cuts) > 60 and len(set(cuts)) > 12
    assert abs(np.mean(cuts) - 9) < 1.6  # evenly between the least and the greatest value
    best = {trees.grow(x, y[:, None], np.ones(len(y)), Rule(depth=1), i, LEVELS).cut[0] for i in range(5)}
    assert len(best) == 1


def test_leaf_by_leaf_growth():
    x, y = made_rows(2000)
    rule = Rule(leaves=9, min_leaf=20)
    t = trees.grow(x, y[:, None], np.ones(len(y)), rule, 1, LEVELS).arrays()
    leaves = t["slot"] < 0
    assert leaves.sum() == 9 and t["rows"][leaves].min() >= 20
    # The same growth with every cut tried.
    parts = [np.ones(len(y), bool)]
    for _ in range(8):
        found = [slow_split(x[p], y[p], np.ones(p.sum()), 20) for p in parts]
        k = int(np.argmax([f[0] for f in found]))
        p, (_, s, cut) = parts.pop(k), found[k]
        parts += [p & (x[:, s] <= cut), p & (x[:, s] > cut)]
    want = np.zeros(len(y))
    for p in parts:
        want[p] = y[p].mean()
    assert t["value"][trees.leaf_of(t, x), 0] == pytest.approx(want, abs=1e-4)
    heavy = trees.grow(x, y[:, None], np.ones(len(y)), Rule(leaves=2, l2=1000.0), 1, LEVELS).arrays()
    p = x[:, heavy["slot"][0]] <= heavy["cut"][0]
    assert heavy["value"][1, 0] == pytest.approx(y[p].sum() / (p.sum() + 1000.0), rel=1e-5)


@pytest.mark.parametrize("loss", ["squares", "huber"])
def test_boosting_equals_a_plain_version(loss):
    x, y = made_rows()
    y[::50] += 60  # outliers
    steps = trees.boost(x, y, np.arange(len(y)), Rule(depth=2), Boost(rounds=15, rate=0.2, loss=loss), 1, LEVELS)
    total = np.full(len(y), next(steps))
    middle = lambda v: np.sort(v)[(len(v) - 1) // 2]
    f = np.full(len(y), middle(y) if loss == "huber" else y.mean())
    for tree in steps:
        total = total + tree["value"][trees.leaf_of(tree, x), 0]
        r = y - f
        clip = np.sort(np.abs(r))[int(np.ceil(0.9 * len(r))) - 1]
        aim = np.clip(r, -clip, clip) if loss == "huber" else r
        leaf = np.array([slow_predict(slow_tree(x, aim, np.ones(len(y)), 2, 1), row) for row in x])
        for v in np.unique(leaf):
            p = leaf == v
            m = middle(r[p])
            f[p] += 0.2 * (m + np.clip(r[p] - m, -clip, clip).mean() if loss == "huber" else r[p].mean())
    assert total == pytest.approx(f, abs=1e-3)


def test_entropy_and_shares_of_classes():
    x, _ = made_rows()
    y = (x[:, 0] > 10).astype(float) + (x[:, 1] == 1)
    t = ensembles.targets(y, 3)
    for criterion in ("squares", "entropy"):
        tree = trees.grow(x, t, np.ones(len(y)), Rule(criterion=criterion), 1, LEVELS).arrays()
        shares = tree["value"][trees.leaf_of(tree, x)]
        assert (shares.argmax(1) == y).all() and shares.sum(1) == pytest.approx(1)


def test_bins_and_nulls():
    cuts = [[1.0, 2.0, 5.0]]
    x = np.array([[0.5], [1.0], [1.5], [2.0], [3.0], [9.0], [np.nan]])
    assert ensembles.to_bins(x, cuts)[:, 0].tolist() == [0, 0, 1, 1, 2, 2, 3]


def test_bootstrap_has_mean_and_spread_of_one():
    w = trees.poisson_one(trees.uniform(7, np.arange(100_000)))
    assert abs(w.mean() - 1) < 0.02 and abs(w.var() - 1) < 0.03


# --- on Spark ---------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(1500).select(
        array_to_vector(F.array(*[F.pmod(F.xxhash64("id", F.lit(k)), F.lit(m)).cast("double") for k, m in enumerate((30, 2, 7))])).alias("features"),
        (F.pmod(F.xxhash64("id", F.lit(0)), F.lit(30)) * 0.7 + 5 * F.pmod(F.xxhash64("id", F.lit(1)), F.lit(2))
         + F.pmod(F.xxhash64("id", F.lit(9)), F.lit(100)) / 25).alias("label"),
    ).repartition(3).cache()


SETS = {
    "forest": Trees(numTrees=4), "random": Trees(numTrees=3, randomCuts=True, bootstrap=False, minInstancesPerNode=3),
    "some": Trees(numTrees=3, featureSubsetStrategy="0.7", maxDepth=4), "boost": Trees(kind="boosting", maxDepth=2, stepSize=0.4, maxIter=3),
    "leaves": Trees(kind="boosting", maxLeaves=5, minInstancesPerNode=20, stepSize=0.4, maxIter=3, l2=0.5),
    "huber": Trees(kind="boosting", loss="huber", maxDepth=2, stepSize=0.4, maxIter=3),
}


def errors(model, df):
    return model.transform(df).select(F.sqrt(F.avg((F.col("label") - F.col("prediction")) ** 2))).first()[0]


def predicted(model, df):
    return np.array([r[0] for r in model.transform(df).orderBy("features", "label").select("prediction").collect()])


def test_many_at_once_equal_single_fits_and_large_nodes_small_ones(spark, rows, monkeypatch):
    together = ensembles.fit_many(rows, SETS)
    plain = rows.select(F.stddev_pop("label")).first()[0]
    for name, model in together.items():
        assert errors(model, rows) < 0.75 * plain, name
    alone = ensembles.fit_many(rows, {"huber": SETS["huber"]})["huber"]
    assert predicted(alone, rows) == pytest.approx(predicted(together["huber"], rows), abs=1e-6)
    monkeypatch.setattr(ensembles, "NODE_ROWS", 200)
    monkeypatch.setattr(ensembles, "HISTOGRAM_CELLS", 1000)  # several passes per level
    monkeypatch.setattr(big_trees, "ROUNDS_PER_TABLE", 2)
    split = ensembles.fit_many(rows, SETS)
    for name in SETS:
        a, b = predicted(together[name], rows), predicted(split[name], rows)
        # Equal gains may be decided by the order of summation.
        assert np.mean(np.abs(a - b)) < 0.02, name


def test_candidates_share_trees_and_equal_their_own_fits(spark, rows, monkeypatch):
    points = [Trees(numTrees=n, maxDepth=d, minInstancesSplit=m) for n, d, m in ((2, 0, 2), (4, 0, 40), (3, 3, 2), (4, 5, 20))] + [
        Trees(kind="boosting", maxIter=n, maxDepth=2, stepSize=0.3) for n in (2, 4)
    ]
    assert len(ensembles.families(points)) == 2
    even = F.pmod(F.xxhash64("features", "label"), F.lit(2)) == 0
    folds = [(rows.where(even), rows.where(~even)), (rows.where(~even), rows.where(even))]
    found = {(r["candidate"], r["fold"], r["held"]): r["m"] for r in ensembles.score_many(points, folds, with_train=True).collect()}
    assert len(found) == len(points) * 4
    for i, point in enumerate(points):
        for k, (train, test) in enumerate(folds):
            model = point.fit(train)
            for held, df in ((True, test), (False, train)):
                m = dict(zip(ensembles.MOMENTS, found[i, k, held]))
                assert (m["e2"] / m["n"]) ** 0.5 == pytest.approx(errors(model, df), rel=1e-4)
    monkeypatch.setattr(ensembles, "NODE_ROWS", 200)
    again = {(r["candidate"], r["fold"], r["held"]): r["m"] for r in ensembles.score_many(points, folds, with_train=True).collect()}
    assert again.keys() == found.keys()
    for key in found:
        assert again[key][0] == found[key][0] and again[key][3] == pytest.approx(found[key][3], rel=0.05)


def test_save_and_load(spark, rows, tmp_path):
    model = Trees(kind="boosting", loss="huber", maxIter=5, maxDepth=2).fit(rows)
    PipelineModel([model]).write().overwrite().save(f"file://{tmp_path}/m")
    back = PipelineModel.load(f"file://{tmp_path}/m")
    assert isinstance(back.stages[0], TreesModel)
    assert (predicted(back, rows) == predicted(model, rows)).all()
    assert model.featureImportances.sum() == pytest.approx(1)
    with pytest.raises(ValueError, match="no rows"):
        Trees().fit(rows.limit(0))


def test_classes(spark, rows):
    few = rows.withColumn("label", (F.col("label") > 8).cast("double") + (F.col("label") > 16).cast("double"))
    model = Trees(numTrees=5, classes=3, featureSubsetStrategy="sqrt", impurity="gini").fit(few)
    assert model.transform(few).where("label = prediction").count() > 1300
