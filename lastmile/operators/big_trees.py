"""Trees over more rows than one task takes.

Nodes above the bound are split by histograms: each task adds up rows and target sums by node,
feature and bin for the open nodes of all trees of all estimators, the histograms are summed
per node, and the split of a node is chosen where its histogram is. Only splits come back.
Nodes below the bound are routed to a task each, which grows the rest of their tree.

Boosted ensembles are fitted by ``held_boosting`` as long as the tasks that run at the same time can
hold the rows. Beyond, they go round by round with jobs of their own, all of them side by side;
their medians and clip points then come from mergeable sketches.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lastmile.operators import ensembles, held_boosting, trees
from lastmile.operators.meeting import tasks_at_once
from lastmile.operators.sizing import release, written

ROUNDS_PER_TABLE = 10  # totals of boosted ensembles are written anew after so many rounds
ACCURACY = 10_000  # of the sketches for medians and clip points


@dataclass
class Open:
    """A node that may still be split."""

    node: int
    key: np.ndarray
    depth: int
    rows: float


@dataclass
class Growing:
    """A tree in the making. ``number`` is its place in a forest or the round of a boosted ensemble."""

    s: dict
    number: int
    seed: int
    tree: trees.Tree = field(default_factory=trees.Tree)
    open: list[Open] = field(default_factory=list)
    queue: list = field(default_factory=list)
    place: int = -1  # of a boosted ensemble in the rows' totals
    clip: float = 0.0
    recent: list[dict] = field(default_factory=list)  # trees that are not in the totals yet


def residual_of(g: Growing, x: np.ndarray, y: np.ndarray, totals: np.ndarray) -> np.ndarray:
    return y - totals[:, g.place] - sum((t["value"][trees.leaf_of(t, x), 0] for t in g.recent), np.zeros(len(y)))


def aim(g: Growing, x: np.ndarray, y: np.ndarray, ids: np.ndarray, totals: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(target, weight) of rows for a tree."""
    if g.place < 0:
        return ensembles.targets(y, g.s["classes"]), ensembles.row_weights(g.s, g.number, ids)
    left = residual_of(g, x, y, totals)
    share = g.s["subsamplingRate"]
    weight = np.ones(len(y)) if share >= 1 else (trees.uniform(g.s["seed"], g.number, ids) < share).astype(float)
    return (np.clip(left, -g.clip, g.clip) if g.s["loss"] == "huber" else left)[:, None], weight


def batches_of(batches: Iterator[pa.RecordBatch], slots: int) -> Iterator[tuple]:
    for batch in batches:
        table = pa.Table.from_batches([batch])
        totals = None
        if "totals" in table.column_names and len(table):
            totals = table.column("totals").combine_chunks().flatten().to_numpy().reshape(len(table), -1)
        if len(table):
            yield ensembles.matrix(table.column("x"), slots), table.column("y").to_numpy(), table.column("id").to_numpy(), totals


PARTIAL = "tree int, node int, rows binary, sums binary"
SPLIT = "tree int, node int, gain double, slot int, cut int, rows array<double>, sums array<double>"


def find_splits(rows: DataFrame, growing: list[Growing], cuts: list[list[float]]) -> dict[tuple[int, int], tuple]:
    """(gain, slot, cut, rows of the children, sums of the children) of the open nodes of all trees, in one job."""
    slots, width = len(cuts), max(map(len, cuts)) + 1
    levels = ensembles.bin_levels(cuts)
    asked = [(i, g, g.tree.arrays(), np.array([o.node for o in g.open])) for i, g in enumerate(growing) if g.open]
    classes = {i: max(g.s["classes"], 1) for i, g, *_ in asked}

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for x, y, ids, totals in batches_of(batches, slots):
            flat = x.astype(np.int64) + np.arange(slots) * width
            for i, g, tree, nodes in asked:
                at = trees.leaf_of(tree, x)
                rank = np.searchsorted(nodes, at)
                rank[rank == len(nodes)] = 0
                target, weight = aim(g, x, y, ids, totals)
                mine = np.flatnonzero((nodes[rank] == at) & (weight > 0))
                made = trees.histograms(flat[mine], rank[mine], len(nodes), target[mine], weight[mine], width)
                sums[i] = [a + b for a, b in zip(sums[i], made)] if i in sums else list(made)
        for i, _, _, nodes in asked:
            for k, node in enumerate(nodes.tolist() if i in sums else []):
                data = [[v] for v in (i, node, sums[i][0][k].tobytes(), sums[i][1][k].tobytes())]
                kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(data, kinds)], ["tree", "node", "rows", "sums"])

    def decide(table: pa.Table) -> pa.Table:
        i, node = table.column("tree")[0].as_py(), table.column("node")[0].as_py()
        total = [sum(np.frombuffer(v.as_py()) for v in table.column(c)) for c in ("rows", "sums")]
        g, place = next((g, [o.node for o in g.open].index(node)) for j, g, *_ in asked if j == i)
        rows_h, sums_h = total[0].reshape(1, slots, width), total[1].reshape(1, slots, width, classes[i])
        rule = ensembles.rule_of(g.s, slots)
        gain, slot, cut = (v[0] for v in trees.splits_of_histograms(rows_h, sums_h, g.open[place].key, g.seed, rule, levels))
        left, left_sums = rows_h[0, slot, : cut + 1].sum(), sums_h[0, slot, : cut + 1].sum(0)
        right, right_sums = rows_h[0, slot, cut + 1 :].sum(), sums_h[0, slot, cut + 1 :].sum(0)
        values = (i, node, float(gain), int(slot), int(cut), [left, right], [*left_sums.tolist(), *right_sums.tolist()])
        kinds = (pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()))
        names = ("tree", "node", "gain", "slot", "cut", "rows", "sums")
        return pa.table({n: pa.array([v], k) for n, v, k in zip(names, values, kinds)})

    found = rows.mapInArrow(add_up, PARTIAL).groupBy("tree", "node").applyInArrow(decide, SPLIT).collect()
    return {
        (r["tree"], r["node"]): (r["gain"], r["slot"], r["cut"], np.array(r["rows"]), np.array(r["sums"]).reshape(2, -1))
        for r in found
    }


def split_node(g: Growing, o: Open, found: tuple) -> list[Open]:
    """Apply a split; the children."""
    gain, slot, cut, rows, sums = found
    l2 = g.s["l2"]
    ids = g.tree.add(sums / np.maximum(rows + l2, 1e-300)[:, None], rows)
    g.tree.slot[o.node], g.tree.cut[o.node], g.tree.gain[o.node], g.tree.left[o.node] = slot, cut, gain, int(ids[0])
    keys = trees.child_keys(o.key)
    return [Open(int(ids[k]), keys[k : k + 1], o.depth + 1, float(rows[k])) for k in (0, 1)]


def may_split(o: Open, rule: trees.Rule) -> bool:
    return o.depth < rule.depth and o.rows >= max(rule.min_split, 2 * rule.min_leaf)


def split_big_nodes(rows: DataFrame, growing: list[Growing], cuts: list[list[float]], least: float) -> None:
    """Split open nodes of more than ``least`` rows, a level of all trees at a time, in passes of bounded size."""
    slots, width = len(cuts), max(map(len, cuts)) + 1
    most = max(1, ensembles.HISTOGRAM_CELLS // (slots * width))
    small: dict[int, list[Open]] = {i: [] for i in range(len(growing))}
    waiting = {i: list(g.open) for i, g in enumerate(growing)}
    while any(waiting.values()):
        room = most
        for i, g in enumerate(growing):
            rule = ensembles.rule_of(g.s, slots)
            small[i] += [o for o in waiting[i] if o.rows <= least and may_split(o, rule)]
            big = [o for o in waiting[i] if o.rows > least and may_split(o, rule)]
            g.open = sorted(big[:room], key=lambda o: o.node)
            waiting[i] = big[len(g.open) :]
            room -= len(g.open)
        if room == most:
            break
        found = find_splits(rows, growing, cuts)
        for i, g in enumerate(growing):
            for o in g.open:
                split = found.get((i, o.node))
                if split and split[0] > trees.SMALLEST_GAIN:
                    waiting[i] += split_node(g, o, split)
    for i, g in enumerate(growing):
        g.open = sorted(small[i], key=lambda o: o.node)


def split_by_leaves(rows: DataFrame, growing: list[Growing], cuts: list[list[float]]) -> None:
    """Leaf by leaf: each pass looks at the two new leaves of every tree."""
    slots = len(cuts)
    waiting = {i: list(g.open) for i, g in enumerate(growing)}
    leaves = dict.fromkeys(waiting, 1)
    while any(waiting.values()):
        for i, g in enumerate(growing):
            g.open = [o for o in waiting[i] if may_split(o, ensembles.rule_of(g.s, slots))]
            waiting[i] = []
        found = find_splits(rows, growing, cuts) if any(g.open for g in growing) else {}
        for i, g in enumerate(growing):
            for o in g.open:
                split = found.get((i, o.node))
                if split and split[0] > trees.SMALLEST_GAIN:
                    heapq.heappush(g.queue, (-split[0], o.node, o, split))
            if g.queue and leaves[i] < g.s["maxLeaves"]:
                _, _, o, split = heapq.heappop(g.queue)
                waiting[i] = split_node(g, o, split)
                leaves[i] += 1
            g.open = []


def finish_small_nodes(rows: DataFrame, growing: list[Growing], cuts: list[list[float]]) -> None:
    """Route the rows of the open nodes to a task per node, which grows the rest of the tree."""
    slots, levels = len(cuts), ensembles.bin_levels(cuts)
    asked = [(i, g, g.tree.arrays(), np.array([o.node for o in g.open])) for i, g in enumerate(growing) if g.open]
    if not asked:
        return
    names = ["tree", "node", "id", "y", "x", "w"]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y, ids, totals in batches_of(iter([batch]), slots):
                for i, g, tree, nodes in asked:
                    at = trees.leaf_of(tree, x)
                    target, weight = aim(g, x, y, ids, totals)
                    mine = np.flatnonzero(np.isin(at, nodes) & (weight > 0))
                    y_or_left = y if g.place < 0 else target[:, 0]
                    values = (
                        pa.array(np.full(len(mine), i, np.int32)), pa.array(at[mine].astype(np.int32)), pa.array(ids[mine]),
                        pa.array(y_or_left[mine]), pa.array([r.tobytes() for r in x[mine]], pa.binary()), pa.array(weight[mine]),
                    )
                    yield pa.RecordBatch.from_arrays(list(values), names)

    def finish(table: pa.Table) -> pa.Table:
        i, node = table.column("tree")[0].as_py(), table.column("node")[0].as_py()
        g, o = next((g, next(o for o in g.open if o.node == node)) for j, g, *_ in asked if j == i)
        order = np.argsort(table.column("id").to_numpy())
        x, y = ensembles.matrix(table.column("x"), slots)[order], table.column("y").to_numpy()[order]
        target = ensembles.targets(y, g.s["classes"])
        rule = ensembles.rule_of(g.s, slots)
        made = trees.grow(x, target, table.column("w").to_numpy()[order], rule, g.seed, levels, o.key, o.depth)
        return pa.table({"tree": pa.array([i], pa.int32()), "node": pa.array([node], pa.int32()),
                         "data": pa.array([ensembles.packed(made.arrays())], pa.binary())})

    spread = rows.mapInArrow(route, "tree int, node int, id long, y double, x binary, w double")
    for r in spread.groupBy("tree", "node").applyInArrow(finish, "tree int, node int, data binary").collect():
        graft(growing[r["tree"]].tree, r["node"], ensembles.unpacked(bytes(r["data"])))
    for g in growing:
        g.open = []


def graft(tree: trees.Tree, node: int, below: dict[str, np.ndarray]) -> None:
    """Put a subtree in the place of a leaf."""
    before = len(tree.slot) - 1  # its root takes the leaf's place
    tree.slot[node], tree.cut[node], tree.gain[node] = int(below["slot"][0]), int(below["cut"][0]), float(below["gain"][0])
    tree.left[node] = int(below["left"][0]) + before
    tree.slot += below["slot"][1:].tolist()
    tree.cut += below["cut"][1:].tolist()
    tree.gain += below["gain"][1:].tolist()
    tree.left += (below["left"][1:] + before).tolist()
    tree.value += list(below["value"][1:].astype(float))
    tree.rows += below["rows"][1:].tolist()


def planted(growing: list[Growing], slots: int, rows: int) -> None:
    """A root for each tree."""
    for g in growing:
        g.tree.add(np.zeros((1, max(g.s["classes"], 1))), np.array([float(rows)]))
        g.open = [Open(0, trees.root_key(), 0, float(rows))]


# --- forests and boosting -------------------------------------------------------------------------------


def fit(rows: DataFrame, settings: dict[str, dict], cuts: list[list[float]]) -> dict[str, tuple[float, list[bytes]]]:
    """(start, packed trees) of each estimator over ROWS."""
    found = _forests(rows, {k: s for k, s in settings.items() if s["kind"] == "forest"}, cuts)
    held = {k: s for k, s in settings.items() if held_boosting.suits(s)}
    tasks = tasks_at_once(rows.sparkSession)
    if held and rows.count() <= tasks * held_boosting.HELD_ROWS:
        found |= held_boosting.fit(rows, held, cuts, tasks)
    else:
        held = {}
    return found | _boosted(rows, {k: s for k, s in settings.items() if s["kind"] == "boosting" and k not in held}, cuts)


def _forests(rows: DataFrame, settings: dict[str, dict], cuts: list[list[float]]) -> dict:
    growing = [
        (name, Growing(s, i, ensembles.tree_seed(s, i))) for name, s in settings.items() for i in range(s["numTrees"])
    ]
    if not growing:
        return {}
    own = [g for _, g in growing]
    planted(own, len(cuts), rows.count())
    split_big_nodes(rows, own, cuts, ensembles.NODE_ROWS)
    finish_small_nodes(rows, own, cuts)
    out: dict[str, tuple[float, list]] = {name: (0.0, []) for name in settings}
    for name, g in growing:
        out[name][1].append(ensembles.packed(g.tree.arrays()))
    return out


def _boosted(rows: DataFrame, settings: dict[str, dict], cuts: list[list[float]]) -> dict:
    if not settings:
        return {}
    names, slots = list(settings), len(cuts)
    row = rows.agg(F.avg("y").alias("mean"), F.percentile_approx("y", 0.5, ACCURACY).alias("median"), F.count("*").alias("n")).first()
    starts = [row["median"] if settings[n]["loss"] == "huber" else row["mean"] for n in names]
    state = rows.withColumn("totals", F.array(*[F.lit(float(s)) for s in starts]))
    made: dict[str, list[dict]] = {n: [] for n in names}
    recent: dict[str, list[dict]] = {n: [] for n in names}
    table = None
    for i in range(max(s["maxIter"] for s in settings.values())):
        active = [n for n in names if i < settings[n]["maxIter"]]
        growing = [
            Growing(settings[n], i, settings[n]["seed"] + 7919 * i, place=names.index(n), recent=recent[n]) for n in active
        ]
        robust = [g for g in growing if g.s["loss"] == "huber"]
        planted(growing, slots, row["n"])
        set_clips(state, robust, slots)
        by_leaves = [g for g in growing if g.s["maxLeaves"]]
        by_levels = [g for g in growing if not g.s["maxLeaves"]]
        if by_leaves:
            split_by_leaves(state, by_leaves, cuts)
        if by_levels:
            split_big_nodes(state, by_levels, cuts, ensembles.NODE_ROWS)
            finish_small_nodes(state, by_levels, cuts)
        if robust:
            set_huber_leaves(state, robust, slots)
        for n, g in zip(active, growing):
            tree = g.tree.arrays()
            tree["value"] *= settings[n]["stepSize"]
            made[n].append(tree)
            recent[n].append(tree)
        if (i + 1) % ROUNDS_PER_TABLE == 0:
            newer = written(with_totals(state, [recent[n] for n in names], slots))
            if table is not None:
                release(table)
            state = table = newer
            recent = {n: [] for n in names}
    return {n: (float(s), [ensembles.packed(t) for t in made[n]]) for n, s in zip(names, starts)}


def residuals(state: DataFrame, robust: list[Growing], slots: int) -> DataFrame:
    """(tree, leaf, r): the residual of every row that a tree uses, and the leaf it is in."""
    asked = [(i, g, g.tree.arrays()) for i, g in enumerate(robust)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, y, ids, totals in batches_of(batches, slots):
            for i, g, tree in asked:
                used = aim(g, x, y, ids, totals)[1] > 0
                left = residual_of(g, x, y, totals)[used]
                leaf = trees.leaf_of(tree, x)[used]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(left), i, np.int32)), pa.array(leaf.astype(np.int32)), pa.array(left)], ["tree", "leaf", "r"]
                )

    return state.mapInArrow(run, "tree int, leaf int, r double")


def set_clips(state: DataFrame, robust: list[Growing], slots: int) -> None:
    if robust:
        alpha = ensembles.boost_of(robust[0].s).alpha
        # A subsample changes the residuals that count, but the clip point is that of all rows.
        found = residuals(state, robust, slots).groupBy("tree").agg(F.percentile_approx(F.abs("r"), alpha, ACCURACY).alias("clip"))
        for r in found.collect():
            robust[r["tree"]].clip = r["clip"]


def set_huber_leaves(state: DataFrame, robust: list[Growing], slots: int) -> None:
    """Leaf values: the median residual, moved by the mean of what is left when clipped."""
    left = residuals(state, robust, slots)
    middle = left.groupBy("tree", "leaf").agg(F.percentile_approx("r", 0.5, ACCURACY).alias("m"))
    clips = F.element_at(F.array(*[F.lit(float(g.clip)) for g in robust]), F.col("tree") + 1)
    # A row per leaf: a few for each of the ensembles that go side by side.
    moved = F.greatest(-clips, F.least(clips, F.col("r") - F.col("m")))
    found = left.join(F.broadcast(written(middle)), ["tree", "leaf"]).groupBy("tree", "leaf").agg(
        F.first("m").alias("m"), F.avg(moved).alias("d")
    )
    for r in found.collect():
        robust[r["tree"]].tree.value[r["leaf"]] = np.array([r["m"] + r["d"]])


def with_totals(state: DataFrame, recent: list[list[dict]], slots: int) -> DataFrame:
    """The rows with the recent trees of each ensemble added to its total."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, _, _, totals in batches_of(iter([batch]), slots):
                totals = totals.copy()
                for place, made in enumerate(recent):
                    for t in made:
                        totals[:, place] += t["value"][trees.leaf_of(t, x), 0]
                at = batch.schema.get_field_index("totals")
                yield batch.set_column(at, batch.schema.field(at), pa.array(list(totals), batch.schema.field(at).type))

    return state.mapInArrow(run, state.schema)


def score(points: list, rows: DataFrame, all_cuts: list[list[list[float]]], with_train: bool) -> DataFrame:
    """SCORES of candidates on folds: each family fitted on each fold, then one pass over the fold's rows."""
    made = ensembles.families(points)
    out = None
    for fold, cuts in enumerate(all_cuts):
        mine = rows.where(F.col("part") == fold)
        fitted = fit(mine.where(~F.col("held")), {str(k): s for k, (s, _) in enumerate(made)}, cuts)
        for k, (s, members) in enumerate(made):
            seen = mine if with_train else mine.where("held")
            part = seen.mapInArrow(scoring(fold, s, members, *fitted[str(k)], len(cuts)), ensembles.SCORES)
            out = part if out is None else out.unionAll(part)
    classes = max(s["classes"] for s, _ in made)
    return written(ensembles.added_moments(out, classes**2 or len(ensembles.MOMENTS)))


def scoring(fold: int, s: dict, members: list, start: float, packed: list[bytes], slots: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y, _, _ = next(batches_of(iter([batch]), slots))
            held = batch.column(batch.schema.get_field_index("held")).to_numpy(zero_copy_only=False).astype(bool)
            staged, rows = ensembles.Staged(s, members, x), []
            for data in packed:
                staged.add(ensembles.unpacked(data))
                for candidate, many, *stop in members:
                    if many == staged.seen:
                        p = ensembles.prediction(s, staged.totals[tuple(stop)], start, many)
                        for side in {*held.tolist()}:
                            m = ensembles.moments(y[held == side], p[held == side], s["classes"])
                            rows.append({"candidate": candidate, "fold": fold, "held": side, "m": m.tolist()})
            yield pa.RecordBatch.from_pylist(
                rows, pa.schema([("candidate", pa.int32()), ("fold", pa.int32()), ("held", pa.bool_()), ("m", pa.list_(pa.float64()))])
            )

    return run
