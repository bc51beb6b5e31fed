"""Trees over binned features: growth of one tree, in numpy, on the rows that one task holds.

Features are numbered bins, a null has a bin of its own behind the others. A tree can grow level
by level or leaf by leaf, with best or random cuts, over all features or a random share of them
per node. Random draws depend on the seed and a node's path only, not on where or when a node
is looked at, so that nodes grown by different tasks give the same tree.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np

BINS = 256
SMALLEST_GAIN = 1e-10


@dataclass(frozen=True)
class Rule:
    """How a tree grows. ``features`` is the number of features tried per node (0: all)."""

    depth: int = 64
    min_leaf: int = 1
    min_split: int = 2
    features: int = 0
    random_cuts: bool = False
    l2: float = 0.0
    leaves: int = 0  # more than 0: leaf by leaf, up to so many
    criterion: str = "squares"  # or "entropy"; squares of class shares are the Gini index


@dataclass
class Tree:
    """Nodes in the order they were made: ``left`` is the first child, the other one follows it."""

    slot: list = field(default_factory=list)  # -1: leaf
    cut: list = field(default_factory=list)  # the last bin that goes left
    left: list = field(default_factory=list)
    value: list = field(default_factory=list)
    rows: list = field(default_factory=list)
    gain: list = field(default_factory=list)

    def add(self, values: np.ndarray, rows: np.ndarray) -> np.ndarray:
        first = len(self.slot)
        n = len(rows)
        self.slot += [-1] * n
        self.cut += [0] * n
        self.left += [0] * n
        self.gain += [0.0] * n
        self.value += list(values)
        self.rows += rows.tolist()
        return np.arange(first, first + n)

    def arrays(self) -> dict[str, np.ndarray]:
        return {
            "slot": np.array(self.slot, np.int16), "cut": np.array(self.cut, np.uint8),
            "left": np.array(self.left, np.int32), "value": np.array(self.value, float).reshape(len(self.slot), -1),
            "rows": np.array(self.rows, np.float32), "gain": np.array(self.gain, np.float32),
        }


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniform(*parts) -> np.ndarray:
    """Numbers in [0, 1) that depend on the given integers."""
    h = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        for p in parts:
            h = mix((np.asarray(p).astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) ^ (h * np.uint64(0xD6E8FEB86659FD93)))
    return (h >> np.uint64(11)).astype(np.float64) / 2.0**53


def poisson_one(u: np.ndarray) -> np.ndarray:
    """Draws of a Poisson variable of mean 1 from uniform ones: how often a row is in a bootstrap."""
    steps = np.cumsum(np.exp(-1) / np.array([1.0, 1, 2, 6, 24, 120, 720, 5040, 40320, 362880]))
    return np.searchsorted(steps, u, "right").astype(np.float64)


def worth(sums: np.ndarray, rows: np.ndarray, rule: Rule) -> np.ndarray:
    """What splits make greater: squared sums by rows, or the negative entropy of class counts."""
    if rule.criterion == "entropy":
        share = sums / np.maximum(rows, 1e-300)[..., None]
        return (sums * np.log(np.where(share > 0, share, 1.0))).sum(-1)
    return (sums * sums).sum(-1) / np.maximum(rows + rule.l2, 1e-300)


# --- the best split of nodes -----------------------------------------------------------------


def histograms(flat: np.ndarray, rank: np.ndarray, nodes: int, target: np.ndarray, weight: np.ndarray, bins: int) -> tuple:
    """(rows, sums) by node, feature and bin. ``flat`` holds feature * bins + bin."""
    n, slots = flat.shape
    at = (flat + (rank * (slots * bins))[:, None]).ravel()
    size = nodes * slots * bins
    once = not len(weight) or weight.min() == weight.max() == 1
    rows = np.bincount(at, None if once else np.repeat(weight, slots), size).reshape(nodes, slots, bins).astype(float)
    sums = [np.bincount(at, np.repeat(weight * target[:, k], slots), size) for k in range(target.shape[1])]
    return rows, np.stack(sums, -1).reshape(nodes, slots, bins, -1)


def tried_slots(keys: np.ndarray, varied: np.ndarray, seed: int, rule: Rule) -> np.ndarray:
    """Which features each node tries: a random choice among those that vary in it."""
    if not rule.features or rule.features >= varied.shape[1]:
        return varied
    draws = uniform(seed, keys[:, None], np.arange(varied.shape[1])[None, :])
    draws[~varied] = 2.0
    limit = np.partition(draws, rule.features - 1, axis=1)[:, rule.features - 1 : rule.features]
    return varied & (draws <= limit)


def random_cut_bins(low: np.ndarray, high: np.ndarray, keys: np.ndarray, seed: int, levels: np.ndarray) -> np.ndarray:
    """A cut per node and feature, drawn evenly between the least and the greatest value of the node's rows.

    ``levels`` are the values of the bins; the cut is at least the least and below the greatest bin.
    """
    u = uniform(seed + 1, keys[:, None], np.arange(low.shape[1])[None, :])
    out = np.empty_like(low)
    for s in range(low.shape[1]):
        a, b = levels[s][low[:, s]], levels[s][high[:, s]]
        point = a + u[:, s] * (b - a)
        out[:, s] = np.clip(np.searchsorted(levels[s], point, "right") - 1, low[:, s], high[:, s] - 1)
    return np.maximum(out, 0)


def splits_of_histograms(rows: np.ndarray, sums: np.ndarray, keys: np.ndarray, seed: int, rule: Rule, levels: np.ndarray) -> tuple:
    """(gain, slot, cut) of each node; a gain of -inf where none is allowed."""
    nodes, slots, bins = rows.shape
    here = rows > 0
    low, high = here.argmax(2), bins - 1 - here[:, :, ::-1].argmax(2)
    tried = tried_slots(keys, high > low, seed, rule)
    left_rows, left_sums = rows.cumsum(2), sums.cumsum(2)
    all_rows, all_sums = left_rows[:, :, -1:], left_sums[:, :, -1:]
    gain = worth(left_sums, left_rows, rule) + worth(all_sums - left_sums, all_rows - left_rows, rule)
    gain -= worth(all_sums, all_rows, rule)
    right = all_rows - left_rows
    allowed = here & (left_rows >= rule.min_leaf) & (right >= max(rule.min_leaf, 1)) & tried[:, :, None]
    if rule.random_cuts:
        cut = random_cut_bins(low, high, keys, seed, levels)
        # The cut may lie in an empty bin; the sums up to it are those of the last bin with rows before it.
        allowed = (left_rows >= rule.min_leaf) & (right >= max(rule.min_leaf, 1)) & tried[:, :, None]
        allowed &= np.arange(bins)[None, None, :] == cut[:, :, None]
    gain = np.where(allowed, gain, -np.inf).reshape(nodes, -1)
    best = gain.argmax(1)
    return gain[np.arange(nodes), best], best // bins, best % bins


def splits_by_sorting(columns: np.ndarray, rank: np.ndarray, keys: np.ndarray, target: np.ndarray, weight: np.ndarray,
                      seed: int, rule: Rule, levels: np.ndarray) -> tuple:
    """Like ``splits_of_histograms`` for many small nodes, whose histograms would be mostly empty.

    ``columns`` holds the bins by feature.
    """
    nodes, slots = len(keys), len(columns)
    order = np.argsort(rank, kind="stable")
    starts = np.searchsorted(rank[order], np.arange(nodes))
    low, high = np.empty((nodes, slots), np.int64), np.empty((nodes, slots), np.int64)
    for s in range(slots):
        ordered = columns[s][order]
        low[:, s], high[:, s] = np.minimum.reduceat(ordered, starts), np.maximum.reduceat(ordered, starts)
    tried = tried_slots(keys, high > low, seed, rule)
    weighed = weight[:, None] * target
    all_rows = np.bincount(rank, weight, nodes)
    all_sums = np.stack([np.bincount(rank, t, nodes) for t in weighed.T], -1)
    whole = worth(all_sums, all_rows, rule)
    best_gain, best_slot, best_cut = np.full(nodes, -np.inf), np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
    drawn = random_cut_bins(low, high, keys, seed, levels) if rule.random_cuts else None
    for s in range(slots):
        if not tried[:, s].any():
            continue
        r, b, w, t = rank, columns[s], weight, weighed
        if 2 * tried[:, s].sum() < nodes:  # look at the rows of these nodes only
            mine = np.flatnonzero(tried[:, s][rank])
            r, b, w, t = r[mine], b[mine], w[mine], t[mine]
        if rule.random_cuts:
            cut = drawn[:, s]
            go = b <= cut.astype(np.uint8)[r]
            left_rows = np.bincount(r, w * go, nodes)
            left_sums = np.stack([np.bincount(r, t[:, k] * go, nodes) for k in range(t.shape[1])], -1)
            gain = worth(left_sums, left_rows, rule) + worth(all_sums - left_sums, all_rows - left_rows, rule) - whole
            gain[(left_rows < rule.min_leaf) | (all_rows - left_rows < max(rule.min_leaf, 1))] = -np.inf
        else:
            width = int(b.max()) + 1
            dense = nodes * width <= 4 * len(r)
            gain, cut = (best_cuts_dense if dense else best_cuts_sorted)(r, b, w, t, width, all_rows, all_sums, whole, rule)
        gain = np.where(tried[:, s], gain, -np.inf)
        better = gain > best_gain
        best_gain[better], best_slot[better], best_cut[better] = gain[better], s, cut[better]
    return best_gain, best_slot, best_cut


def best_cuts_dense(r, b, w, t, width: int, all_rows, all_sums, whole, rule: Rule) -> tuple:
    """(gain, cut) of each node on one feature, from a histogram of the feature; ``t`` is weighed."""
    nodes = len(all_rows)
    at = r * width + b
    left_rows = np.bincount(at, w, nodes * width).reshape(nodes, width)
    here = left_rows > 0
    left_rows = left_rows.cumsum(1)
    left_sums = np.stack([np.bincount(at, t[:, k], nodes * width).reshape(nodes, width).cumsum(1) for k in range(t.shape[1])], -1)
    right = all_rows[:, None] - left_rows
    gain = worth(left_sums, left_rows, rule) + worth(all_sums[:, None] - left_sums, right, rule) - whole[:, None]
    gain[~(here & (left_rows >= rule.min_leaf) & (right >= max(rule.min_leaf, 1)))] = -np.inf
    cut = gain.argmax(1)
    return gain[np.arange(nodes), cut], cut


def best_cuts_sorted(r, b, w, t, width: int, all_rows, all_sums, whole, rule: Rule) -> tuple:
    """The same from the rows sorted by node and bin."""
    nodes = len(all_rows)
    key = r * width + b
    o = np.argsort(key)
    key = key[o]
    ends = np.append(np.flatnonzero(key[1:] != key[:-1]), len(key) - 1)
    node, bin_ = key[ends] // width, key[ends] % width
    up_rows = np.cumsum(w[o])[ends]
    up_sums = np.cumsum(t[o], axis=0)[ends]
    first = np.append(0, np.flatnonzero(node[1:] != node[:-1]) + 1)
    sizes = np.diff(np.append(first, len(node)))
    base = np.repeat(first - 1, sizes)
    before = base >= 0
    left_rows = up_rows - np.where(before, up_rows[base], 0.0)
    left_sums = up_sums - np.where(before[:, None], up_sums[base], 0.0)
    right = all_rows[node] - left_rows
    each = worth(left_sums, left_rows, rule) + worth(all_sums[node] - left_sums, right, rule) - whole[node]
    last = np.append(node[1:] != node[:-1], True)
    each[last | (left_rows < rule.min_leaf) | (right < max(rule.min_leaf, 1))] = -np.inf
    top = np.maximum.reduceat(each, first)
    at = np.flatnonzero(each == np.repeat(top, sizes))
    at = at[np.append(True, node[at][1:] != node[at][:-1])]
    gain, cut = np.full(nodes, -np.inf), np.zeros(nodes, np.int64)
    gain[node[at]], cut[node[at]] = each[at], bin_[at]
    return gain, cut


# --- growth -------------------------------------------------------------------------------------


def node_values(rank: np.ndarray, nodes: int, target: np.ndarray, weight: np.ndarray, rule: Rule) -> tuple:
    rows = np.bincount(rank, weight, nodes)
    sums = np.stack([np.bincount(rank, weight * t, nodes) for t in target.T], -1)
    return rows, sums, sums / np.maximum(rows + rule.l2, 1e-300)[:, None]


def child_keys(keys: np.ndarray) -> np.ndarray:
    """The paths of the children, left and right in turn."""
    with np.errstate(over="ignore"):
        twice = keys.astype(np.uint64) * np.uint64(2)
        return mix(np.stack([twice, twice + np.uint64(1)], 1) + np.uint64(0x632BE59BD9B4E019)).ravel()


def root_key() -> np.ndarray:
    return np.array([1], np.uint64)


def grow(bins: np.ndarray, target: np.ndarray, weight: np.ndarray, rule: Rule, seed: int, levels: np.ndarray,
         key: np.ndarray | None = None, depth: int = 0) -> Tree:
    """A tree over the rows of positive weight, level by level or leaf by leaf.

    ``key`` and ``depth`` say which node of a larger tree the rows belong to.
    """
    if rule.leaves:
        return grow_by_leaves(bins, target, weight, rule, seed, levels)
    tree = Tree()
    rows = np.flatnonzero(weight > 0)
    bins, target, weight = bins[rows], target[rows], weight[rows]
    width = int(bins.max(initial=0)) + 1
    flat = bins.astype(np.int64) + np.arange(bins.shape[1]) * width
    columns = np.ascontiguousarray(bins.T)
    keys = root_key() if key is None else key
    rank = np.zeros(len(rows), np.int64)
    count, sums, values = node_values(rank, 1, target, weight, rule)
    ids = tree.add(values, count)
    alive = np.arange(len(rows))
    while len(ids) and depth < rule.depth:
        wide = (count >= rule.min_split) & (count >= 2 * rule.min_leaf)
        if target.shape[1] > 1:
            wide &= sums.max(1) < count  # more than one class
        if not wide.any():
            break
        again = np.cumsum(wide) - 1
        stay = wide[rank]
        alive, rank = alive[stay], again[rank[stay]]
        ids, keys = ids[wide], keys[wide]
        own = worth(sums[wide], count[wide], rule)
        if len(ids) * width * 2 <= len(alive):
            made = histograms(flat[alive], rank, len(ids), target[alive], weight[alive], width)
            gain, slot, cut = splits_of_histograms(*made, keys, seed, rule, levels)
        else:
            gain, slot, cut = splits_by_sorting(columns[:, alive], rank, keys, target[alive], weight[alive], seed, rule, levels)
        split = gain > SMALLEST_GAIN * (1 + np.abs(own))
        if not split.any():
            break
        again = np.cumsum(split) - 1
        stay = split[rank]
        alive, old = alive[stay], rank[stay]
        rank = 2 * again[old] + (bins[alive, slot[old]] > cut[old])
        count, sums, values = node_values(rank, 2 * int(split.sum()), target[alive], weight[alive], rule)
        parents = ids[split]
        ids = tree.add(values, count)
        for p, s, c, g, left in zip(parents.tolist(), slot[split].tolist(), cut[split].tolist(), gain[split].tolist(), ids[::2].tolist()):
            tree.slot[p], tree.cut[p], tree.gain[p], tree.left[p] = s, c, g, left
        keys = child_keys(keys[split])
        depth += 1
    return tree


def grow_by_leaves(bins: np.ndarray, target: np.ndarray, weight: np.ndarray, rule: Rule, seed: int, levels: np.ndarray) -> Tree:
    """Splits the leaf of the greatest gain next; a child's histogram is its parent's less its sibling's."""
    tree = Tree()
    width = int(bins.max(initial=0)) + 1
    flat = bins.astype(np.int64) + np.arange(bins.shape[1]) * width
    queue: list = []

    def made(rows: np.ndarray) -> tuple:
        return histograms(flat[rows], np.zeros(len(rows), np.int64), 1, target[rows], weight[rows], width)

    def offer(node: int, rows: np.ndarray, hist: tuple, key: np.ndarray, depth: int) -> None:
        if depth >= rule.depth:
            return
        gain, slot, cut = (x[0] for x in splits_of_histograms(*hist, key, seed, rule, levels))
        if gain > SMALLEST_GAIN:
            heapq.heappush(queue, (-gain, node, rows, hist, key, depth, int(slot), int(cut)))

    rows = np.flatnonzero(weight > 0)
    count, _, values = node_values(np.zeros(len(rows), np.int64), 1, target[rows], weight[rows], rule)
    tree.add(values, count)
    offer(0, rows, made(rows), root_key(), 0)
    for _ in range(rule.leaves - 1):
        if not queue:
            break
        gain, node, rows, hist, key, depth, slot, cut = heapq.heappop(queue)
        right = bins[rows, slot] > cut
        count, _, values = node_values(right.astype(np.int64), 2, target[rows], weight[rows], rule)
        ids = tree.add(values, count)
        tree.slot[node], tree.cut[node], tree.gain[node], tree.left[node] = slot, cut, -gain, int(ids[0])
        parts = rows[~right], rows[right]
        small = int(len(parts[1]) < len(parts[0]))
        part = made(parts[small])
        rest = tuple(a - b for a, b in zip(hist, part))
        for side in (0, 1):
            offer(int(ids[side]), parts[side], part if side == small else rest, child_keys(key)[side : side + 1], depth + 1)
    return tree


def leaf_of(tree: dict[str, np.ndarray], bins: np.ndarray, depth: int = 1_000_000, min_split: int = 0) -> np.ndarray:
    """The node each row ends in, after ``depth`` steps at most and only through nodes of ``min_split`` rows."""
    node = np.zeros(len(bins), np.int64)
    slot, cut, left = tree["slot"], tree["cut"], tree["left"]
    open_ = (slot >= 0) & (tree["rows"] >= min_split) if min_split else slot >= 0
    inner = np.flatnonzero(open_[node])
    step = 0
    while len(inner) and step < depth:
        at = node[inner]
        at = left[at] + (bins[inner, slot[at]] > cut[at])
        node[inner] = at
        inner = inner[open_[at]]
        step += 1
    return node


# --- boosting -------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Boost:
    """Rounds of trees on residuals. The Huber loss clips residuals at their ``alpha`` point."""

    rounds: int = 100
    rate: float = 0.1
    loss: str = "squares"
    share: float = 1.0
    alpha: float = 0.9


def lower_quantile(x: np.ndarray, p: float) -> float:
    return float(np.quantile(x, p, method="inverted_cdf"))


def huber_leaf(residual: np.ndarray, clip: float) -> float:
    """The (lower) median, moved by the mean of what is left when clipped."""
    middle = lower_quantile(residual, 0.5)
    return middle + float(np.clip(residual - middle, -clip, clip).mean())


def boost(bins: np.ndarray, y: np.ndarray, ids: np.ndarray, rule: Rule, boosting: Boost, seed: int, levels: np.ndarray):
    """(start, trees as arrays, values times the rate): one after another."""
    robust = boosting.loss == "huber"
    start = lower_quantile(y, 0.5) if robust else float(y.mean())
    yield start
    total = np.full(len(y), start)
    for i in range(boosting.rounds):
        residual = y - total
        clip = lower_quantile(np.abs(residual), boosting.alpha) if robust else 0.0
        target = np.clip(residual, -clip, clip) if robust else residual
        weight = np.ones(len(y)) if boosting.share >= 1 else (uniform(seed, i, ids) < boosting.share).astype(float)
        tree = grow(bins, target[:, None], weight, rule, seed + 7919 * i, levels).arrays()
        leaf = leaf_of(tree, bins)
        if robust:
            used = weight > 0
            order = np.argsort(leaf[used], kind="stable")
            nodes, first = np.unique(leaf[used][order], return_index=True)
            for node, part in zip(nodes, np.split(residual[used][order], first[1:])):
                tree["value"][node, 0] = huber_leaf(part, clip)
        tree["value"] *= boosting.rate
        total += tree["value"][leaf, 0]
        yield tree
