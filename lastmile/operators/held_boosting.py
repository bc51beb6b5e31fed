"""Boosting over more rows than one task takes: all tasks hold their share and go round by round together.

The tasks of one barrier stage read their rows once. For each level or leaf they add up histograms
of their own rows, exchange them, and every task takes the same decision from the same sums, so that
a round costs no job. Quantiles are exact: counts of ever narrower ranges are exchanged, then the few
values left. A lost task starts the stage anew.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.sql import DataFrame

from lastmile.operators import ensembles, trees
from lastmile.operators.meeting import Together, exchange, meeting_folder
from lastmile.operators.sizing import release, written

HELD_ROWS = 5_000_000  # that one task holds
DEPTH = 8  # greatest of trees that grow level by level here: their histograms are exchanged as a whole
CELLS = 4096  # of slots that are counted together
BLOCK = 1 << 17  # rows that are counted at once
RANGES, FEW = 1024, 4096  # of a quantile's pass; values that are exchanged as they are

def suits(s: dict) -> bool:
    return s["kind"] == "boosting" and bool(s["maxLeaves"] or 0 < s["maxDepth"] <= DEPTH)


class Held:
    """A task's rows: bins by feature, and codes of several features' bins that are counted together."""

    def __init__(self, x: np.ndarray, together: Together):
        self.columns, self.together = np.ascontiguousarray(x.T), together
        slots = len(self.columns)
        own = self.columns.max(1).astype(np.int64) + 1 if x.shape[0] else np.ones(slots, np.int64)
        self.widths = np.max(together(own), axis=0)
        self.width = int(self.widths.max(initial=1))
        self.groups: list[list[int]] = []
        for s in np.argsort(-self.widths, kind="stable").tolist():
            fits = (g for g in self.groups if np.prod(self.widths[[*g, s]]) <= CELLS)
            group = next(fits, None)
            if group is None:
                self.groups.append([s])
            else:
                group.append(s)
        self.codes = []
        for group in self.groups:
            code = np.zeros(x.shape[0], np.uint16)
            for s in group:
                code = code * np.uint16(self.widths[s]) + self.columns[s]
            self.codes.append(code)
        self.ends = np.cumsum(self.widths)

    def histograms(self, rows: np.ndarray, rank: np.ndarray, nodes: int, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, sums) by node, feature and bin over the rows of all tasks; ``rank`` and ``target`` belong to ``rows``."""
        flat = np.zeros((2, nodes, int(self.ends[-1])))
        whole = len(rows) == len(self.columns[0])  # all rows, in order
        for group, code in zip(self.groups, self.codes):
            shape = self.widths[group]
            size = int(np.prod(shape))
            made = np.zeros((2, nodes * size))
            for at in range(0, len(rows), BLOCK):
                part = slice(at, at + BLOCK)
                key = (code[part] if whole else code[rows[part]]).astype(np.int64)
                if nodes > 1:
                    key += rank[part] * size
                made[0] += np.bincount(key, minlength=nodes * size)
                made[1] += np.bincount(key, target[part], nodes * size)
            joint = made.reshape(2, nodes, *shape)
            for k, s in enumerate(group):
                others = tuple(2 + j for j in range(len(group)) if j != k)
                flat[:, :, self.ends[s] - self.widths[s] : self.ends[s]] = joint.sum(others)
        flat = sum(self.together(flat.ravel())).reshape(flat.shape)
        out = np.zeros((2, nodes, len(self.widths), self.width))
        for s, w in enumerate(self.widths.tolist()):
            out[:, :, s, :w] = flat[:, :, self.ends[s] - w : self.ends[s]]
        return out[0], out[1][..., None]


def quantile(values: np.ndarray, group: np.ndarray, groups: int, p: float, together: Together) -> np.ndarray:
    """For each group the least value that a share ``p`` of the values of all tasks does not exceed; NaN without values."""
    count = sum(together(np.bincount(group, minlength=groups).astype(float)))
    rank = np.maximum(np.ceil(count * p), 1.0)  # numbered from 1, among the values that are left
    out = np.full(groups, np.nan)
    left = count
    while True:
        if left.sum() <= FEW:
            everyone = together(np.column_stack([group.astype(float), values]).ravel())
            found = np.concatenate(everyone).reshape(-1, 2)
            found = found[np.lexsort((found[:, 1], found[:, 0]))]
            first = np.searchsorted(found[:, 0], np.arange(groups))
            open_ = left > 0
            out[open_] = found[(first + rank.astype(np.int64) - 1)[open_], 1]
            return out
        low, high = np.full(groups, np.inf), np.full(groups, -np.inf)
        np.minimum.at(low, group, values)
        np.maximum.at(high, group, values)
        low, high = -np.max(together(-low), axis=0), np.max(together(high), axis=0)
        same = (left > 0) & (low == high)
        out[same] = low[same]
        stay = ~same[group]
        values, group, left = values[stay], group[stay], np.where(same, 0.0, left)
        if not left.any():
            return out
        with np.errstate(invalid="ignore", divide="ignore"):
            place = np.minimum(((values - low[group]) / (high - low)[group] * RANGES).astype(np.int64), RANGES - 1)
        counts = sum(together(np.bincount(group * RANGES + place, minlength=groups * RANGES).astype(float))).reshape(groups, RANGES)
        upto = counts.cumsum(1)
        wanted = (upto < rank[:, None]).sum(1).clip(max=RANGES - 1)
        at = np.arange(groups)
        rank = rank - (upto[at, wanted] - counts[at, wanted])
        left = np.where(left > 0, counts[at, wanted], 0.0)
        stay = place == wanted[group]
        values, group = values[stay], group[stay]


def grow_levels(held: Held, target: np.ndarray, used: np.ndarray, rule: trees.Rule, seed: int, levels: list[np.ndarray]) -> trees.Tree:
    """``trees.grow`` over the rows of all tasks."""
    tree = trees.Tree()
    alive, rank = used, np.zeros(len(used), np.int64)
    counted = held.histograms(alive, rank, 1, target[alive] if len(alive) < len(target) else target)
    count, sums = counted[0][:, 0].sum(1), counted[1][:, 0].sum(1)
    value_of = lambda sums, count: sums / np.maximum(count + rule.l2, 1e-300)[:, None]
    ids, keys, depth = tree.add(value_of(sums, count), count), trees.root_key(), 0
    while len(ids) and depth < rule.depth:
        wide = (count >= rule.min_split) & (count >= 2 * rule.min_leaf)
        if not wide.any():
            break
        if not wide.all():
            stay = wide[rank]
            alive, rank = alive[stay], (np.cumsum(wide) - 1)[rank[stay]]
        ids, keys, count, sums = ids[wide], keys[wide], count[wide], sums[wide]
        own = trees.worth(sums, count, rule)
        if depth:
            counted = held.histograms(alive, rank, len(ids), target[alive] if len(alive) < len(target) else target)
        rows_h, sums_h = counted
        gain, slot, cut = trees.splits_of_histograms(rows_h, sums_h, keys, seed, rule, levels)
        split = gain > trees.SMALLEST_GAIN * (1 + np.abs(own))
        if not split.any():
            break
        below = np.arange(held.width)[None, :] <= cut[:, None]
        at = np.arange(len(ids))
        left, left_sums = (rows_h[at, slot] * below).sum(1)[split], (sums_h[at, slot, :, 0] * below).sum(1)[split]
        right, right_sums = rows_h[at, slot].sum(1)[split] - left, sums_h[at, slot, :, 0].sum(1)[split] - left_sums
        count = np.stack([left, right], 1).ravel()
        sums = np.stack([left_sums, right_sums], 1).ravel()[:, None]
        if not split.all():
            stay = split[rank]
            alive, rank = alive[stay], rank[stay]
        again = np.cumsum(split) - 1
        rank = 2 * again[rank] + (held.columns[slot[rank], alive] > cut[rank])
        parents = ids[split]
        ids = tree.add(value_of(sums, count), count)
        for p, s, c, g, first in zip(parents.tolist(), slot[split].tolist(), cut[split].tolist(), gain[split].tolist(), ids[::2].tolist()):
            tree.slot[p], tree.cut[p], tree.gain[p], tree.left[p] = s, c, g, first
        keys = trees.child_keys(keys[split])
        depth += 1
    return tree


def grow_leaves(held: Held, target: np.ndarray, used: np.ndarray, rule: trees.Rule, seed: int, levels: list[np.ndarray]) -> trees.Tree:
    """``trees.grow_by_leaves`` over the rows of all tasks."""
    tree = trees.Tree()
    queue: list = []

    def made(rows: np.ndarray) -> tuple:
        return held.histograms(rows, np.zeros(len(rows), np.int64), 1, target[rows])

    def offer(node: int, rows: np.ndarray, hist: tuple, key: np.ndarray, depth: int) -> None:
        if depth >= rule.depth:
            return
        gain, slot, cut = (x[0] for x in trees.splits_of_histograms(*hist, key, seed, rule, levels))
        if gain > trees.SMALLEST_GAIN:
            heapq.heappush(queue, (-gain, node, rows, hist, key, depth, int(slot), int(cut)))

    hist = made(used)
    count, total = hist[0][0, 0].sum(), hist[1][0, 0].sum()
    tree.add(np.array([[total / max(count + rule.l2, 1e-300)]]), np.array([count]))
    offer(0, used, hist, trees.root_key(), 0)
    for _ in range(rule.leaves - 1):
        if not queue:
            break
        gain, node, rows, hist, key, depth, slot, cut = heapq.heappop(queue)
        sides = [(h[0, slot, : cut + 1].sum(), h[0, slot, cut + 1 :].sum()) for h in hist]
        count, sums = np.array(sides[0]), np.array(sides[1])
        ids = tree.add((sums / np.maximum(count + rule.l2, 1e-300))[:, None], count)
        tree.slot[node], tree.cut[node], tree.gain[node], tree.left[node] = slot, cut, -gain, int(ids[0])
        right = held.columns[slot, rows] > cut
        parts = rows[~right], rows[right]
        small = int(count[1] < count[0])  # of all tasks, so that all look at the same side
        part = made(parts[small])
        rest = tuple(a - b for a, b in zip(hist, part))
        for side in (0, 1):
            offer(int(ids[side]), parts[side], part if side == small else rest, trees.child_keys(key)[side : side + 1], depth + 1)
    return tree


def boost(held: Held, y: np.ndarray, ids: np.ndarray, s: dict, levels: list[np.ndarray]) -> Iterator:
    """``trees.boost`` over the rows of all tasks: the start, then trees with values times the rate."""
    rule, boosting, seed, together = ensembles.rule_of(s, len(held.columns)), ensembles.boost_of(s), s["seed"], held.together
    robust, one = boosting.loss == "huber", np.zeros(len(y), np.int64)
    if robust:
        start = float(quantile(y, one, 1, 0.5, together)[0])
    else:
        total, n = sum(together(np.array([y.sum(), float(len(y))])))
        start = float(total / n)
    yield start
    totals = np.full(len(y), start)
    for i in range(boosting.rounds):
        left = y - totals
        clip = float(quantile(np.abs(left), one, 1, boosting.alpha, together)[0]) if robust else 0.0
        target = np.clip(left, -clip, clip) if robust else left
        used = np.arange(len(y))
        if boosting.share < 1:
            used = np.flatnonzero(trees.uniform(seed, i, ids) < boosting.share)
        grown = (grow_leaves if rule.leaves else grow_levels)(held, target, used, rule, seed + 7919 * i, levels)
        tree = grown.arrays()
        leaf = trees.leaf_of(tree, held.columns.T)
        if robust:
            n = len(tree["slot"])
            middle = quantile(left[used], leaf[used], n, 0.5, together)
            moved = np.clip(left[used] - middle[leaf[used]], -clip, clip)
            sums = sum(together(np.stack([np.bincount(leaf[used], moved, n), np.bincount(leaf[used], minlength=n).astype(float)]).ravel())).reshape(2, n)
            there = sums[1] > 0
            tree["value"][there, 0] = middle[there] + sums[0][there] / sums[1][there]
        tree["value"] *= boosting.rate
        totals += tree["value"][leaf, 0]
        yield tree


def fit(rows: DataFrame, settings: dict[str, dict], cuts: list[list[float]], tasks: int) -> dict[str, tuple[float, list[bytes]]]:
    """(start, packed trees) of each boosted ensemble over ROWS, in one barrier stage of so many tasks."""
    slots, levels, folder = len(cuts), ensembles.bin_levels(cuts), meeting_folder(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = [(ensembles.matrix(pa.chunked_array([b.column(2)]), slots), b.column(1).to_numpy(), b.column(0).to_numpy()) for b in batches if b.num_rows]
        x, y, ids = (np.concatenate(c) for c in zip(*table)) if table else (np.empty((0, slots), np.uint8), np.empty(0), np.empty(0, np.int64))
        del table
        order = np.argsort(ids)  # so that sums do not depend on the order of arrival
        x, y, ids = x[order], y[order], ids[order]
        context = BarrierTaskContext.get()
        held = Held(x, exchange(context, folder))
        del x
        for name, s in settings.items():
            steps = boost(held, y, ids, s, levels)
            start = next(steps)
            for i, tree in enumerate(steps):
                if not context.partitionId():
                    values = ([name], [i], [start], [ensembles.packed(tree)])
                    kinds = (pa.string(), pa.int32(), pa.float64(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], ["name", "tree", "start", "data"])

    dealt = rows.select("id", "y", "x").repartition(tasks, "id")
    made = written(dealt.mapInArrow(run, "name string, tree int, start double, data binary", barrier=True))
    found: dict[str, tuple[float, list]] = {name: (0.0, []) for name in settings}
    for r in made.orderBy("name", "tree").toLocalIterator():
        found[r["name"]] = (r["start"], [*found[r["name"]][1], bytes(r["data"])])
    release(made)
    return found
