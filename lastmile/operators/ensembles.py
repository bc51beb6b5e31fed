"""Forests and boosting of binned trees: many ensembles, candidates and folds in one job.

Rows are binned once and written. A unit is a part of the work that needs the same rows: some
trees of a forest, one boosted ensemble, or one candidate family on one fold. Rows are routed
to units by one shuffle and each unit is worked off by one task, so that all estimators, folds
and candidates are fitted at the same time. A unit's rows are bounded by ``NODE_ROWS``: above
it the upper nodes of a tree are split by histograms that all tasks add up, for all trees of
all estimators at once, and only nodes below the bound are routed to a task.

Candidates that differ in the number of trees, or in the depth of a forest, share their trees:
a small forest is the beginning of a large one, and a shallow tree the top of a deep one.
"""

from __future__ import annotations

import io
import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lastmile.operators import trees
from lastmile.operators.sizing import release, written
from lastmile.operators.trees import Boost, Rule

NODE_ROWS = 1_000_000  # rows that one task takes; beyond, nodes are split by summed histograms
TREES_PER_UNIT = 7
TREES_PER_SCORE = 25  # of a forest whose candidates are scored, in one task
SCORE_ROWS = 10_000  # whose sums of trees meet in one task
HISTOGRAM_CELLS = 4_000_000  # of the nodes whose histograms one pass adds up
PARTITIONS_PER_UNIT = 4
SEED = 42


# --- parameters ----------------------------------------------------------------------------------


class TreeParams(HasLabelCol, HasFeaturesCol, HasPredictionCol):
    """Parameters of ``Trees``; names as in Spark's own tree estimators where there is one."""

    kind = Param(Params._dummy(), "kind", "forest or boosting", TypeConverters.toString)
    numTrees = Param(Params._dummy(), "numTrees", "trees of a forest", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "greatest depth, 0 for none", TypeConverters.toInt)
    minInstancesPerNode = Param(Params._dummy(), "minInstancesPerNode", "rows a leaf needs", TypeConverters.toInt)
    minInstancesSplit = Param(Params._dummy(), "minInstancesSplit", "rows a split needs", TypeConverters.toInt)
    featureSubsetStrategy = Param(Params._dummy(), "featureSubsetStrategy", "all, sqrt, log2 or a share", TypeConverters.toString)
    impurity = Param(Params._dummy(), "impurity", "variance, gini or entropy", TypeConverters.toString)
    bootstrap = Param(Params._dummy(), "bootstrap", "draw rows with replacement", TypeConverters.toBoolean)
    randomCuts = Param(Params._dummy(), "randomCuts", "random instead of best cuts", TypeConverters.toBoolean)
    maxLeaves = Param(Params._dummy(), "maxLeaves", "leaves of trees grown leaf by leaf, 0: level by level", TypeConverters.toInt)
    l2 = Param(Params._dummy(), "l2", "penalty on leaf values", TypeConverters.toFloat)
    maxIter = Param(Params._dummy(), "maxIter", "rounds of boosting", TypeConverters.toInt)
    stepSize = Param(Params._dummy(), "stepSize", "share of a tree that is added", TypeConverters.toFloat)
    loss = Param(Params._dummy(), "loss", "squares or huber", TypeConverters.toString)
    subsamplingRate = Param(Params._dummy(), "subsamplingRate", "share of the rows of a round", TypeConverters.toFloat)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature", TypeConverters.toInt)
    classes = Param(Params._dummy(), "classes", "number of classes, 0: regression", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed", TypeConverters.toInt)


DEFAULTS = {
    "kind": "forest", "numTrees": 100, "maxDepth": 0, "minInstancesPerNode": 1, "minInstancesSplit": 2,
    "featureSubsetStrategy": "all", "impurity": "variance", "bootstrap": True, "randomCuts": False, "maxLeaves": 0,
    "l2": 0.0, "maxIter": 100, "stepSize": 0.1, "loss": "squares", "subsamplingRate": 1.0, "maxBins": 255, "classes": 0,
    "seed": SEED,
}


class Trees(Estimator, TreeParams, MLWritable):
    """A forest or a boosted ensemble of trees, by what its parameters say."""

    def __init__(self, **params):
        super().__init__()
        self._setDefault(labelCol="label", featuresCol="features", predictionCol="prediction", **DEFAULTS)
        self._set(**params)

    def _fit(self, dataset: DataFrame) -> TreesModel:
        return fit_many(dataset, {"": self})[""]

    def settings(self) -> dict:
        return {k: self.getOrDefault(k) for k in DEFAULTS}

    def write(self) -> MLWriter:
        return DefaultParamsWriter(self)


def features_tried(strategy: str, slots: int) -> int:
    if strategy == "all":
        return 0
    n = {"sqrt": math.sqrt, "log2": math.log2, "onethird": lambda s: s / 3}.get(strategy, lambda s: float(strategy) * s)(slots)
    return max(1, int(n))


def rule_of(s: dict, slots: int) -> Rule:
    return Rule(
        depth=s["maxDepth"] or 64, min_leaf=s["minInstancesPerNode"], min_split=s["minInstancesSplit"],
        features=features_tried(s["featureSubsetStrategy"], slots), random_cuts=s["randomCuts"], l2=s["l2"],
        leaves=s["maxLeaves"], criterion="entropy" if s["impurity"] == "entropy" else "squares",
    )


def boost_of(s: dict) -> Boost:
    return Boost(rounds=s["maxIter"], rate=s["stepSize"], loss=s["loss"], share=s["subsamplingRate"])


# --- bins ---------------------------------------------------------------------------------------------


def feature_cuts(frame: DataFrame, features: str, bins: int) -> list[list[float]]:
    """Upper limits of the bins of each vector slot, the last one being the greatest value.

    One pass with a mergeable sketch per slot; slots of at most ``bins`` values keep them all.
    """
    first = frame.select(F.size(vector_to_array(features)).alias("n")).first()
    if first is None:
        raise ValueError("no rows to fit trees on")
    grid = F.array(*[F.lit(i / bins) for i in range(1, bins + 1)])
    values = frame.select(vector_to_array(features).alias("_x"))
    present = [F.when(~F.isnan(F.get("_x", F.lit(i))), F.get("_x", F.lit(i))) for i in range(first["n"])]
    row = values.agg(*[F.percentile_approx(x, grid, F.lit(20 * bins)).alias(f"s{i}") for i, x in enumerate(present)]).first()
    return [sorted({v for v in (found or []) if math.isfinite(v)}) or [0.0] for found in row]


def bin_levels(cuts: list[list[float]]) -> list[np.ndarray]:
    """A value for each bin; that of nulls lies behind the others."""
    return [np.array([*c, c[-1] + 1.0, c[-1] + 1.0], float) for c in cuts]


def to_bins(x: np.ndarray, cuts: list[list[float]]) -> np.ndarray:
    out = np.empty(x.shape, np.uint8)
    for s, c in enumerate(cuts):
        limits = np.array(c[:-1])
        out[:, s] = np.where(np.isnan(x[:, s]), len(c), np.searchsorted(limits, x[:, s], "left"))
    return out


def vectors_of(array: pa.Array, slots: int) -> np.ndarray:
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    return array.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, slots)


ROWS = "id long, y double, x binary, part int, held boolean"


def binned(frame: DataFrame, features: str, label: str, cuts: list[list[float]], part: int = 0, held: bool = False) -> DataFrame:
    """ROWS of a frame: bins as bytes. Rows without a label are left out."""
    slots = len(cuts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = to_bins(vectors_of(batch.column(2), slots), cuts)
            data = pa.py_buffer(np.ascontiguousarray(made))
            offsets = pa.py_buffer(np.arange(0, len(made) * slots + 1, max(slots, 1), dtype=np.int32))
            x = pa.Array.from_buffers(pa.binary(), len(made), [None, offsets, data])
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), x, pa.array([part] * n, pa.int32()), pa.array([held] * n, pa.bool_())],
                ["id", "y", "x", "part", "held"],
            )

    rows = frame.where(F.col(label).isNotNull()).select(
        F.monotonically_increasing_id().alias("id"), F.col(label).cast("double").alias("y"), vector_to_array(features).alias("x")
    )
    return rows.mapInArrow(run, ROWS)


def matrix(column: pa.ChunkedArray, slots: int) -> np.ndarray:
    """The bins of an Arrow column of bytes."""
    parts = []
    for chunk in column.chunks:
        offsets = np.frombuffer(chunk.buffers()[1], np.int32)[chunk.offset : chunk.offset + len(chunk) + 1]
        data = np.frombuffer(chunk.buffers()[2], np.uint8) if chunk.buffers()[2] else np.empty(0, np.uint8)
        parts.append(data[offsets[0] : offsets[-1]].reshape(-1, slots))
    return np.concatenate(parts) if parts else np.empty((0, slots), np.uint8)


def targets(y: np.ndarray, classes: int) -> np.ndarray:
    return (y[:, None] == np.arange(classes)).astype(float) if classes else y[:, None]


# --- the work of one task -------------------------------------------------------------------------------


def tree_seed(s: dict, i: int) -> int:
    return s["seed"] + 104729 * i


def row_weights(s: dict, i: int, ids: np.ndarray) -> np.ndarray:
    """How often each row is in the bootstrap of tree ``i``."""
    if not s["bootstrap"]:
        return np.ones(len(ids))
    return trees.poisson_one(trees.uniform(tree_seed(s, i), ids))


def grown(s: dict, numbers: list[int], x: np.ndarray, y: np.ndarray, ids: np.ndarray, levels: list[np.ndarray]) -> Iterator[dict]:
    """The trees of a forest with these numbers, or all of a boosted ensemble after its start."""
    rule = rule_of(s, x.shape[1])
    if s["kind"] == "boosting":
        yield from trees.boost(x, y, ids, rule, boost_of(s), s["seed"], levels)
        return
    t = targets(y, s["classes"])
    for i in numbers:
        yield trees.grow(x, t, row_weights(s, i, ids), rule, tree_seed(s, i), levels).arrays()


def packed(tree: dict) -> bytes:
    out = io.BytesIO()
    np.savez_compressed(out, **tree)
    return out.getvalue()


def unpacked(data: bytes) -> dict:
    with np.load(io.BytesIO(data), allow_pickle=False) as found:
        return dict(found)


# --- models ----------------------------------------------------------------------------------------------


class TreesModel(Model, TreeParams, MLWritable, MLReadable):
    """A fitted ensemble: bins, start value and packed trees. Saved with its trees as a table."""

    def __init__(self, cuts: list[list[float]] | None = None, start: float = 0.0, made: list[bytes] | None = None, **params):
        super().__init__()
        self._setDefault(labelCol="label", featuresCol="features", predictionCol="prediction", **DEFAULTS)
        self._set(**params)
        self.cuts, self.start, self.made = cuts or [], start, made or []

    @property
    def trees(self) -> list[dict]:
        return [unpacked(t) for t in self.made]

    def setPredictionCol(self, value: str) -> TreesModel:
        return self._set(predictionCol=value)

    @property
    def featureImportances(self) -> np.ndarray:  # as Spark's own models name it
        """Each feature's share of the gains, averaged over the trees."""
        total = np.zeros(len(self.cuts))
        for tree in self.trees:
            inner = tree["slot"] >= 0
            gains = np.bincount(tree["slot"][inner], tree["gain"][inner], len(self.cuts))
            total += gains / gains.sum() if gains.sum() > 0 else 0.0
        return total / total.sum() if total.sum() > 0 else total

    def _transform(self, dataset: DataFrame) -> DataFrame:
        shared = dataset.sparkSession.sparkContext.broadcast((self.cuts, self.made))
        mean, start, classes = self.getOrDefault("kind") == "forest", self.start, self.getOrDefault("classes")

        @F.arrow_udf("double")
        def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            cuts, made = shared.value
            for batch in batches:
                x = to_bins(vectors_of(batch, len(cuts)), cuts)
                total = np.zeros((len(x), max(classes, 1)))
                for data in made:
                    tree = unpacked(data)
                    total += tree["value"][trees.leaf_of(tree, x)]
                if mean and made:
                    total /= len(made)
                yield pa.array(total.argmax(1).astype(float) if classes else start + total[:, 0], pa.float64())

        return dataset.withColumn(self.getOrDefault("predictionCol"), predict(vector_to_array(self.getOrDefault("featuresCol"))))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: TreesModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        extra = {"cuts": self.model.cuts, "start": self.model.start}
        DefaultParamsWriter.saveMetadata(self.model, path, spark, extraMetadata=extra)
        table = pa.table({"tree": pa.array(range(len(self.model.made)), pa.int32()), "data": pa.array(self.model.made, pa.binary())})
        spark.createDataFrame(table).write.parquet(f"{path}/trees")


class _Reader(MLReader):
    def load(self, path: str) -> TreesModel:
        spark = SparkSession.getActiveSession()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        rows = spark.read.parquet(f"{path}/trees").orderBy("tree").collect()
        model = TreesModel(metadata["cuts"], metadata["start"], [bytes(r["data"]) for r in rows])
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


# --- fitting many at once -----------------------------------------------------------------------------------


def routed(rows: DataFrame, units: list[int]) -> DataFrame:
    """Every row once for each unit, by unit, in many more partitions than units so that few share one."""
    n = max(1, min(PARTITIONS_PER_UNIT * len(units), 4000))
    return rows.withColumn("unit", F.explode(F.array(*[F.lit(u) for u in units]))).repartition(n, "unit")


def fit_many(train: DataFrame, estimators: dict[str, Trees]) -> dict[str, TreesModel]:
    """Fit all estimators on the same vectors, at the same time."""
    if not estimators:
        return {}
    one = next(iter(estimators.values()))
    features, label = one.getOrDefault("featuresCol"), one.getOrDefault("labelCol")
    cuts = feature_cuts(train, features, one.getOrDefault("maxBins"))
    rows = written(binned(train, features, label, cuts))
    n = rows.count()
    if not n:
        raise ValueError("no rows to fit trees on")
    found = {}
    if n <= NODE_ROWS:
        found = _fit_in_tasks(rows, {k: e.settings() for k, e in estimators.items()}, cuts)
    else:
        from lastmile.operators import big_trees

        found = big_trees.fit(rows, {k: e.settings() for k, e in estimators.items()}, cuts)
    release(rows)
    out = {}
    for name, e in estimators.items():
        start, made = found[name]
        own = {k: e.getOrDefault(k) for k in ("labelCol", "featuresCol", "predictionCol")}
        out[name] = TreesModel(cuts, start, made, **own, **e.settings())
    return out


def tree_units(settings: dict[str, dict]) -> list[tuple[str, list[int]]]:
    """(estimator, its tree numbers) per unit; a boosted ensemble is one unit."""
    units = []
    for name, s in settings.items():
        size = TREES_PER_UNIT if s["kind"] == "forest" else 1
        count = s["numTrees"] if s["kind"] == "forest" else 1
        units += [(name, list(range(i, min(i + size, count)))) for i in range(0, count, size)]
    return units


def _fit_in_tasks(rows: DataFrame, settings: dict[str, dict], cuts: list[list[float]]) -> dict[str, tuple[float, list[bytes]]]:
    units = tree_units(settings)
    slots = len(cuts)

    def work(table: pa.Table) -> pa.Table:
        name, numbers = units[table.column("unit")[0].as_py()]
        x, y, ids = matrix(table.column("x"), slots), table.column("y").to_numpy(), table.column("id").to_numpy()
        order = np.argsort(ids)  # so that sums do not depend on the order of arrival
        made = list(grown(settings[name], numbers, x[order], y[order], ids[order], bin_levels(cuts)))
        start = made.pop(0) if settings[name]["kind"] == "boosting" else 0.0
        k = len(made)
        return pa.table(
            {"name": pa.array([name] * k, pa.string()), "tree": pa.array([numbers[0] + i for i in range(k)], pa.int32()),
             "start": pa.array([start] * k, pa.float64()), "data": pa.array([packed(t) for t in made], pa.binary())}
        )

    made = written(
        routed(rows.select("id", "y", "x"), list(range(len(units)))).groupBy("unit")
        .applyInArrow(work, "name string, tree int, start double, data binary")
    )
    found: dict[str, tuple[float, list]] = {name: (0.0, []) for name in settings}
    for r in made.orderBy("name", "tree").toLocalIterator():
        found[r["name"]][1].append(bytes(r["data"]))
        found[r["name"]] = (r["start"], found[r["name"]][1])
    release(made)
    return found


# --- scoring many candidates on many folds ---------------------------------------------------------------------


def families(points: list[Trees]) -> list[tuple[dict, list[tuple[int, int, int, int]]]]:
    """(settings, [(candidate, trees, depth, rows a split needs)]): candidates that share their trees together.

    The settings have the family's most trees, and for a forest the greatest depth and the
    smallest number of rows for a split.
    """
    shared: dict[str, tuple[dict, list]] = {}
    for i, e in enumerate(points):
        s = e.settings()
        forest = s["kind"] == "forest"
        many = "numTrees" if forest else "maxIter"
        s["minInstancesSplit"] = max(s["minInstancesSplit"], 2 * s["minInstancesPerNode"])
        nested = {many, "maxDepth", "minInstancesSplit"} if forest else {many}
        key = json.dumps({k: v for k, v in s.items() if k not in nested}, sort_keys=True)
        top, members = shared.setdefault(key, (dict(s), []))
        members.append((i, s[many], (s["maxDepth"] or 64) if forest else 64, s["minInstancesSplit"] if forest else 0))
        top[many] = max(top[many], s[many])
        if forest:
            top["maxDepth"] = 0 if 0 in (top["maxDepth"], s["maxDepth"]) else max(top["maxDepth"], s["maxDepth"])
            top["minInstancesSplit"] = min(top["minInstancesSplit"], s["minInstancesSplit"])
    return list(shared.values())


class Staged:
    """Sums of a family's trees on some rows, read off while its trees come.

    Trees are numbered from 1; ``first`` is the number before the first that comes.
    """

    def __init__(self, s: dict, members: list[tuple[int, int, int, int]], x: np.ndarray, first: int = 0):
        self.s, self.x, self.seen = s, x, first
        self.marks = {m[1] for m in members}
        self.stops = sorted({m[2:] for m in members})
        self.totals = {stop: np.zeros((len(x), max(s["classes"], 1))) for stop in self.stops}

    def add(self, tree: dict) -> None:
        self.seen += 1
        for (depth, split), total in self.totals.items():
            total += tree["value"][trees.leaf_of(tree, self.x, depth, split)]


def prediction(s: dict, total: np.ndarray, start: float, many: int) -> np.ndarray:
    if s["classes"]:
        return total.argmax(1)
    return start + total[:, 0] / (many if s["kind"] == "forest" else 1)


MOMENTS = ("n", "e", "abs_e", "e2", "y", "y2", "hits_10")
SUM_NAMES = ["family", "fold", "block", "mark", "stop", "ended", "start", "sums", "y", "held"]
SUM_KINDS = [*[pa.int32()] * 5, pa.bool_(), pa.float64(), *[pa.binary()] * 3]
SUMS = "family int, fold int, block int, mark int, stop int, ended boolean, start double, sums binary, y binary, held binary"
SCORES = "candidate int, fold int, held boolean, m array<double>"


def moments(y: np.ndarray, p: np.ndarray, classes: int) -> np.ndarray:
    """Sums that all scores follow from: MOMENTS, or the confusion matrix by rows."""
    if classes:
        return np.bincount((y * classes + p).astype(np.int64), minlength=classes * classes).astype(float)
    e = y - p
    return np.array([len(y), e.sum(), np.abs(e).sum(), (e * e).sum(), y.sum(), (y * y).sum(), (np.abs(e) <= 10).sum()])


def score_many(points: list[Trees], folds: list[tuple[DataFrame, DataFrame]], with_train: bool = False) -> DataFrame:
    """SCORES of all candidates on all folds: sums over the held-out (and the training) rows.

    Preprocessing and bins are each fold's own. Families of candidates and folds are units of
    one job, forests in parts; a family's trees are grown once, and the sums that its candidates
    predict from are read off on the way. Sums of parts meet by blocks of rows.
    """
    one = points[0]
    features, label = one.getOrDefault("featuresCol"), one.getOrDefault("labelCol")
    all_cuts, parts, largest = [], None, 0
    for i, (train, test) in enumerate(folds):
        cuts = feature_cuts(train, features, one.getOrDefault("maxBins"))
        all_cuts.append(cuts)
        for frame, held in ((train, False), (test, True)):
            made = binned(frame, features, label, cuts, i, held)
            parts = made if parts is None else parts.unionAll(made)
    rows = written(parts)
    largest = rows.groupBy("part").count().agg(F.max("count")).first()[0] or 0
    if largest > NODE_ROWS:
        from lastmile.operators import big_trees

        return big_trees.score(points, rows, all_cuts, with_train)
    made = families(points)
    units = []  # (family, fold, the forest's trees or None)
    for f, (settings, _) in enumerate(made):
        many = settings["numTrees"] if settings["kind"] == "forest" else 1
        size = TREES_PER_SCORE if settings["kind"] == "forest" else 1
        units += [(f, fold, i, min(i + size, many)) for fold in range(len(folds)) for i in range(0, many, size)]

    def work(table: pa.Table) -> pa.Table:
        family, fold, first, last = units[table.column("unit")[0].as_py()]
        s, members = made[family]
        cuts = all_cuts[fold]
        x, y, ids = matrix(table.column("x"), len(cuts)), table.column("y").to_numpy(), table.column("id").to_numpy()
        held = table.column("held").to_numpy(zero_copy_only=False).astype(bool)
        order = np.lexsort((ids, held))
        x, y, ids, held = x[order], y[order], ids[order], held[order]
        fit, seen = ~held, np.ones(len(y), bool) if with_train else held
        steps = grown(s, list(range(first, last)), x[fit], y[fit], ids[fit], bin_levels(cuts))
        start = next(steps) if s["kind"] == "boosting" else 0.0
        staged, out, n = Staged(s, members, x[seen], first), [], int(seen.sum())

        def note(end: bool) -> None:
            for stop, total in enumerate(staged.totals.values()):
                for block, at in enumerate(range(0, n, SCORE_ROWS)):
                    part = slice(at, at + SCORE_ROWS)
                    own = (y[seen][part].tobytes(), held[seen][part].tobytes()) if end and stop == 0 and first == 0 else (None, None)
                    out.append((family, fold, block, staged.seen, stop, end, start, total[part].tobytes(), *own))

        for tree in steps:
            staged.add(tree)
            if staged.seen in staged.marks:
                note(False)
        note(True)
        return pa.table({n_: pa.array(c, k) for n_, c, k in zip(SUM_NAMES, zip(*out), SUM_KINDS)})

    def assemble(table: pa.Table) -> pa.Table:
        rows_ = sorted(table.select(SUM_NAMES).to_pylist(), key=lambda r: (r["mark"], r["ended"]))
        s, members = made[rows_[0]["family"]]
        stops = sorted({m[2:] for m in members})
        whole = next(r for r in rows_ if r["y"] is not None)
        y, held = np.frombuffer(whole["y"]), np.frombuffer(whole["held"], bool)
        before, out = {k: np.zeros((len(y), max(s["classes"], 1))) for k in range(len(stops))}, []
        for r in rows_:
            total = before[r["stop"]] + np.frombuffer(r["sums"]).reshape(len(y), -1)
            if r["ended"]:
                before[r["stop"]] = total
                continue
            for candidate, many, *stop in members:
                if many == r["mark"] and tuple(stop) == stops[r["stop"]]:
                    p = prediction(s, total, r["start"], many)
                    out += [
                        (candidate, r["fold"], side, moments(y[held == side], p[held == side], s["classes"]).tolist())
                        for side in {*held.tolist()}
                    ]
        kinds = (pa.int32(), pa.int32(), pa.bool_(), pa.list_(pa.float64()))
        columns = list(zip(*out)) or [[]] * 4
        return pa.table({n_: pa.array(c, k) for n_, c, k in zip(("candidate", "fold", "held", "m"), columns, kinds)})

    numbered = F.array(*[F.struct(F.lit(u).alias("unit"), F.lit(unit[1]).alias("fold")) for u, unit in enumerate(units)])
    mine = F.filter(numbered, lambda u: u["fold"] == F.col("part"))
    n = max(1, min(PARTITIONS_PER_UNIT * len(units), 4000))
    spread = rows.withColumn("unit", F.explode(F.transform(mine, lambda u: u["unit"]))).select("unit", "id", "y", "x", "held")
    sums = spread.repartition(n, "unit").groupBy("unit").applyInArrow(work, SUMS)
    parts = sums.groupBy("family", "fold", "block").applyInArrow(assemble, SCORES)
    return written(added_moments(parts, len(MOMENTS) if not one.settings()["classes"] else max(s["classes"] for s, _ in made) ** 2))


def added_moments(parts: DataFrame, size: int) -> DataFrame:
    """SCORES of parts of the rows, added up."""
    return parts.groupBy("candidate", "fold", "held").agg(F.array(*[F.sum(F.get("m", F.lit(i))) for i in range(size)]).alias("m"))
