"""Many boosted tree models in one job, on squared error.

Columns are cut into at most ``MAX_BINS`` bins per group (a group is a fold or the whole table); a
row is then one byte per column. Trees grow level by level: a level needs the count and the gradient
sum of every (model, node, column, bin), and nothing else of the rows. Residuals are whole numbers on
a fixed grid, so these sums do not depend on the order of rows, tasks or partitions.

Where a group's rows fit one task (``CELLS`` bytes of bins, checked by a count), models are dealt
over tasks and each task grows its models side by side from its copy of the rows (``Grove``): one job
for all trials, folds and horizons. Larger groups stay spread out: each level is one aggregate over all
models at once (``Tree``), and predictions are columns of a table that is written anew every few rounds.
Both ways give the same models, bit for bit.

Boosting goes on from where it stands: predictions and losses are kept from round to round, and a
model whose validation loss has not improved for ``patience`` rounds stops; nothing is regrown.

Two kinds of growth: by depth, or best leaf first up to ``num_leaves``. Leaf weights come from gradient
sums with L1 and L2 penalties, rows are drawn per round and columns per tree. Missing feature values
go to the first bin, rows without a label take no part in that label's models.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadtide.config import TIME, target_name
from leadtide.session import stored

MAX_BINS = 64
#: Bytes of binned rows that one task may hold.
CELLS = 32_000_000
#: Rows, counted per model, that a task grows side by side, and models of a task where there are many.
SIDE_ROWS = 1 << 15
SIDE = 12
#: Rounds between two writes of the predictions of spread-out groups, and models grown together there.
KEEP_EVERY = 10
TOGETHER = 64
#: Grid of residuals: this many steps for the largest distance of a label from the mean.
GRID = float(1 << 24)
_LOSS_GRID = float(1 << 30)
#: Rows counted at a time, and the unit of a count beside a gradient sum: residuals stay below
#: 2 ** 26 steps, so a slice's sum is below half a unit and a slice's count below 2 ** 12 units.
_SLICE = 1 << 12
_UNIT = float(1 << 40)
_FAR = float(1 << 26)


@dataclass(frozen=True)
class Boost:
    """Parameters of one model. ``num_leaves`` 0 grows by depth."""

    label: str
    group: int = 0
    rounds: int = 100
    learning_rate: float = 0.3
    max_depth: int = 6
    patience: int | None = None
    subsample: float = 1.0
    colsample: float = 1.0
    reg_alpha: float = 0.0
    reg_lambda: float = 1.0
    num_leaves: int = 0
    least_rows: int = 1
    seed: int = 42


@dataclass
class Scale:
    """Mean of a label over the training rows of a group, and its largest distance from it."""

    base: float
    reach: float


# Draws


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _uniform(ids: np.ndarray, *keys: int) -> np.ndarray:
    """A number in [0, 1) for each id that depends on id and keys only."""
    salt = 0
    for k in keys:
        salt = (salt * 0x9E3779B97F4A7C15 + k + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF
    return (_mixed(_mixed(ids.astype(np.uint64) + np.uint64(salt))) >> np.uint64(11)) / float(1 << 53)


def drawn_columns(p: Boost, turn: int, n: int) -> np.ndarray:
    if p.colsample >= 1:
        return np.arange(n)
    order = np.argsort(_uniform(np.arange(n), p.seed, 1, turn), kind="stable")
    return np.sort(order[: max(1, int(round(p.colsample * n)))])


def drawn_rows(p: Boost, turn: int, ids: np.ndarray) -> np.ndarray:
    """Which of the rows take part in this round."""
    return np.ones(len(ids), bool) if p.subsample >= 1 else _uniform(ids, p.seed, 2, turn) < p.subsample


# One tree


class Tree:
    """A tree while it grows. ``open`` has the nodes that need a histogram."""

    def __init__(self, p: Boost, columns: np.ndarray, width: int, step: float):
        self.p, self.columns, self.width, self.step = p, columns, width, step
        self.sure = max(p.reg_lambda, 1e-12)
        self.split = np.array([False])
        self._hold(np.full((5, 1), -1), np.zeros((5, 1)))
        self.depth[0] = 0
        self.open = np.array([0]) if p.max_depth else np.array([], int)

    def _hold(self, whole: np.ndarray, numbers: np.ndarray) -> None:
        self._whole, self._numbers = whole, numbers
        self.feature, self.left, self.cut, self.parent, self.depth = whole
        self.n, self.g, self.gain, self.left_n, self.left_g = numbers

    def _score(self, g: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Loss that a leaf takes away, in squares of the grid's step."""
        size = np.abs(g)
        if self.p.reg_alpha:
            size = np.maximum(size - self.p.reg_alpha / self.step, 0.0)
        size *= size
        size /= n + self.sure
        return size

    def learn(self, cells: np.ndarray, n: np.ndarray, g: np.ndarray) -> None:
        """The best split of each open node. ``cells`` ascend: (place in ``open``, column, bin)."""
        asked, self.open = self.open, np.array([], int)
        if not len(cells):
            return
        lane = cells // MAX_BINS
        begins = np.flatnonzero(lane[1:] != lane[:-1]) + 1
        begins = np.concatenate([[0], begins])
        runs = np.diff(begins, append=len(lane))
        lanes = lane[begins]  # one entry per (node, column) from here on
        whose = lanes // self.width
        starts = np.concatenate([[0], np.flatnonzero(whose[1:] != whose[:-1]) + 1])
        sum_n, sum_g = np.cumsum(n), np.cumsum(g)
        before_n, before_g = (sum_n - n)[begins], (sum_g - g)[begins]
        ends = begins + runs - 1
        whole_n, whole_g = (sum_n[ends] - before_n)[starts], (sum_g[ends] - before_g)[starts]
        self.n[asked], self.g[asked] = whole_n, whole_g
        left_n, left_g = sum_n - np.repeat(before_n, runs), sum_g - np.repeat(before_g, runs)
        per_node = np.add.reduceat(runs, starts)
        right_n, right_g = np.repeat(whole_n, per_node) - left_n, np.repeat(whole_g, per_node) - left_g
        parts = self._score(left_g, left_n) + self._score(right_g, right_n)
        gain = parts - np.repeat(self._score(whole_g, whole_n), per_node)
        least = max(1, self.p.least_rows)
        gain[(right_n < least) | (gain <= 1e-9 * parts)] = 0.0
        if least > 1:
            gain[left_n < least] = 0.0
        heads = np.concatenate([[0], np.cumsum(per_node)[:-1]])
        top = np.maximum.reduceat(gain, heads)
        hits = np.flatnonzero(gain == np.repeat(top, per_node))
        best = hits[np.searchsorted(hits, heads)]
        self.gain[asked] = top
        self.feature[asked], self.cut[asked] = lane[best] % self.width, cells[best] % MAX_BINS
        self.left_n[asked], self.left_g[asked] = left_n[best], left_g[best]

    def _chosen(self) -> np.ndarray:
        """Nodes that the tree splits, as far as gains are known; with a bound on leaves, best first."""
        if not self.p.num_leaves:
            return self.gain > 0
        chosen = np.zeros(len(self.gain), bool)
        queue, leaves = [(-self.gain[0], 0)], 1
        while queue and leaves < self.p.num_leaves:
            gain, node = heapq.heappop(queue)
            if gain >= 0:
                break
            chosen[node] = True
            leaves += 1
            if self.split[node]:
                for child in (self.left[node], self.left[node] + 1):
                    heapq.heappush(queue, (-self.gain[child], int(child)))
        return chosen

    def expand(self) -> bool:
        """Split the chosen nodes that are not split yet. False if there are none."""
        todo = np.flatnonzero(self._chosen() & ~self.split)
        if not len(todo):
            return False
        k, size = len(todo), len(self.gain)
        children = size + np.arange(2 * k)
        self.split[todo] = True
        self.left[todo] = children[::2]
        whole, numbers = np.full((5, 2 * k), -1), np.zeros((5, 2 * k))
        whole[3], whole[4] = np.repeat(todo, 2), np.repeat(self.depth[todo] + 1, 2)
        numbers[0, ::2], numbers[0, 1::2] = self.left_n[todo], self.n[todo] - self.left_n[todo]
        numbers[1, ::2], numbers[1, 1::2] = self.left_g[todo], self.g[todo] - self.left_g[todo]
        self._hold(np.concatenate([self._whole, whole], 1), np.concatenate([self._numbers, numbers], 1))
        self.split = np.concatenate([self.split, np.zeros(2 * k, bool)])
        self.open = children[(whole[4] < self.p.max_depth) & (numbers[0] >= 2 * self.p.least_rows)]
        return True

    def finish(self) -> "Grown":
        """The tree with its leaf weights; splits that better leaves have pushed out are taken back."""
        chosen = self._chosen() & self.split
        kept = np.arange(len(self.gain))
        alive = np.ones(len(kept), bool)
        if self.p.num_leaves:
            for i in range(1, len(kept)):
                up = self.parent[i]
                alive[i] = alive[up] and chosen[up]
                kept[i] = i if alive[i] else kept[up]
        place = np.cumsum(alive) - 1
        size = np.maximum(np.abs(self.g * self.step) - self.p.reg_alpha, 0.0)
        value = -self.p.learning_rate * np.sign(self.g) * size / (self.n + self.sure)
        feature, left = np.where(chosen, self.feature, -1), np.where(chosen, place[self.left], -1)
        return Grown(feature[alive], self.cut[alive], left[alive], value[alive], place[kept])

    def moved(self, at: np.ndarray, bins: np.ndarray) -> np.ndarray:
        """Rows that stand at a node with children go to one of them."""
        go = np.flatnonzero(self.split[at])
        node = at[go]
        out = at.copy()
        out[go] = self.left[node] + (bins[go, self.feature[node]] > self.cut[node])
        return out


@dataclass
class Grown:
    """Arrays by node; ``feature`` is -1 at a leaf, ``left`` + 1 is the right child."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    kept: np.ndarray

    def leaf(self, bins: np.ndarray) -> np.ndarray:
        at = np.zeros(len(bins), np.int64)
        while len(go := np.flatnonzero(self.feature[at] >= 0)):
            node = at[go]
            at[go] = self.left[node] + (bins[go, self.feature[node]] > self.cut[node])
        return at


def histogram(tree: Tree, at: np.ndarray, keys: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Occupied cells with their count and gradient sum, for rows at nodes ``at``.

    ``keys`` has column * MAX_BINS + bin of the drawn columns. A slice is counted and summed at once:
    counts stand above the largest gradient sum that a slice can have, and doubles hold both exactly.
    """
    place = np.full(len(tree.gain), -1)
    place[tree.open] = np.arange(len(tree.open))
    here = place[at]
    if (here < 0).any():
        rows = here >= 0
        keys, here, g = keys[rows], here[rows], g[rows]
    per_node = tree.width * MAX_BINS
    size, found = per_node * len(tree.open), None
    for i in range(0, len(here), _SLICE):
        key = (keys[i : i + _SLICE] + (here[i : i + _SLICE, None] * per_node)).ravel()
        both = np.bincount(key, weights=np.repeat(g[i : i + _SLICE] + _UNIT, keys.shape[1]), minlength=size)
        if i == 0 and len(here) <= _SLICE:
            cells = np.flatnonzero(both)
            both = both[cells]
            n = np.rint(both / _UNIT)
            return cells, n, both - n * _UNIT
        n = np.rint(both / _UNIT)
        found = [n, both - n * _UNIT] if found is None else [found[0] + n, found[1] + (both - n * _UNIT)]
    if found is None:
        return np.array([], int), np.zeros(0), np.zeros(0)
    cells = np.flatnonzero(found[0])
    return cells, found[0][cells], found[1][cells]


class Progress:
    """Rounds and losses of a model, and when it stops. Without patience the last round is the best."""

    def __init__(self, p: Boost):
        self.p, self.best, self.at, self.turn, self.trees = p, np.inf, 0, 0, []

    def add(self, tree: Grown, loss: float | None) -> bool:
        """False if the model is done."""
        self.trees.append(tree)
        self.turn += 1
        if self.p.patience is None or loss is None or loss < self.best:
            self.best, self.at = (np.inf if loss is None else loss), self.turn
        waits = self.p.patience is not None and self.turn - self.at >= self.p.patience
        return self.turn < self.p.rounds and not waits


def residuals(pred: np.ndarray, y: np.ndarray, step: float) -> np.ndarray:
    """Prediction minus label in whole steps of the grid."""
    return np.clip(np.rint((pred - y) / step), 1 - _FAR, _FAR - 1)


def _loss(error: np.ndarray, scale: Scale) -> int:
    return int(np.rint((error / scale.reach) ** 2 * _LOSS_GRID).astype(np.int64).sum())


class Cells:
    """Rows of a group as places in one row of cells: the bins of each column that varies, side by side."""

    def __init__(self, bins: np.ndarray):
        low, high = (bins.min(axis=0), bins.max(axis=0)) if len(bins) else (np.zeros(bins.shape[1], int),) * 2
        used = np.flatnonzero(high > low)
        used = used if len(used) else np.array([0])
        many = (high - low).astype(int)[used] + 1
        self.starts = np.cumsum(many) - many
        self.size, self.first = int(many.sum()), int(many[0])
        self.feature = np.repeat(used, many)
        self.bin = np.arange(self.size) - np.repeat(self.starts, many) + np.repeat(low.astype(int)[used], many)
        self.codes = (bins[:, used] + (self.starts - low[used])).astype(np.int32)
        self.rooms: dict[tuple[int, int], np.ndarray] = {}

    def room(self, name: tuple[int, int], places: int) -> np.ndarray:
        """Memory for sums of so many places, used again by each tree."""
        if name not in self.rooms or len(self.rooms[name]) < places:
            self.rooms[name] = np.empty((places + places // 2, self.size))
        return self.rooms[name][:places]

    def count(self, rows: np.ndarray, place: np.ndarray, g: np.ndarray, places: int) -> list[np.ndarray]:
        """Per (place, cell) the count plus the gradient sum in ``_UNIT``s; the two apart if the group has more rows than a slice."""
        size, codes = places * self.size, self.codes
        if len(codes) <= _SLICE:
            key = codes[rows] + (place * self.size)[:, None]
            return [np.bincount(key.ravel(), weights=np.repeat(g + 1.0, key.shape[1]), minlength=size).reshape(places, -1)]
        n, s = np.zeros(size), np.zeros(size)
        for i in range(0, len(rows), _SLICE):
            key = codes[rows[i : i + _SLICE]] + (place[i : i + _SLICE] * self.size)[:, None]
            both = np.bincount(key.ravel(), weights=np.repeat(g[i : i + _SLICE] + 1.0, key.shape[1]), minlength=size)
            more = np.rint(both)
            n += more
            s += both - more
        return [n.reshape(places, -1), s.reshape(places, -1)]


class Grove:
    """A tree for each of several models while they grow, level by level, on the same rows.

    The same splits as ``Tree`` finds, node by node: sums are whole numbers of steps, so those of the
    larger child are its parent's less those of the smaller one. Gradients are in ``_UNIT`` steps.
    """

    def __init__(self, models: Sequence[Boost], steps: np.ndarray, columns: Sequence[np.ndarray], cells: Cells):
        k = len(models)
        self.cells, self.models = cells, models
        self.sure = np.array([max(p.reg_lambda, 1e-12) for p in models])
        self.soft = np.array([p.reg_alpha for p in models], float) / steps / _UNIT
        self.least = np.array([max(1, p.least_rows) for p in models], float)
        self.enough = np.array([2 * p.least_rows for p in models])
        self.deepest = np.array([p.max_depth for p in models])
        self.leaves = np.array([p.num_leaves for p in models])
        self.drawn = np.stack([np.isin(cells.feature, c) for c in columns])
        self._hold(np.full((6, k), -1), np.zeros((3, k)), np.zeros((2, k)))
        self.depth[:], self.tree[:] = 0, np.arange(k)
        self.split, self.level = np.zeros(k, bool), 0

    def _hold(self, whole: np.ndarray, numbers: np.ndarray, left: np.ndarray) -> None:
        self._whole, self._numbers, self._left = whole, numbers, left
        self.feature, self.left, self.cut, self.parent, self.depth, self.tree = whole
        self.n, self.g, self.gain = numbers
        self.left_n, self.left_g = left

    def grow(self, flat: np.ndarray, place: np.ndarray, width: int, rows: np.ndarray, g: np.ndarray) -> np.ndarray:
        """Grow all trees. ``place`` has the row in ``flat`` of each (model, row), ``rows`` those that take
        part. The node that each (model, row) ends at."""
        at = np.repeat(np.arange(len(self.models)), len(place) // len(self.models))
        going, node, begin = np.arange(len(at)), at, place * width
        asked = np.flatnonzero(self.deepest > 0)
        last = None  # places and sums of the nodes asked before
        while len(asked):
            asked, rows, sums = self._histograms(asked, at, rows, place, g, last)
            self._learn(asked, sums)
            spot = np.full(len(self.gain), -1)
            spot[asked] = np.arange(len(asked))
            last = spot, sums
            children = self._expand(asked)
            if not len(children):
                break
            some = np.flatnonzero(self.split.take(node))
            going, node, begin = going.take(some), node.take(some), begin.take(some)
            node = self.left.take(node) + (flat.take(begin + self.feature.take(node)) > self.cut.take(node))
            at[going] = node
            owner = self.tree[children]
            asked = children[(self.depth[children] < self.deepest[owner]) & (self.n[children] >= self.enough[owner])]
        return at

    def _histograms(
        self, asked: np.ndarray, at: np.ndarray, rows: np.ndarray, place: np.ndarray, g: np.ndarray, last: tuple | None
    ) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """The nodes ``asked``, counted ones first, rows that are still at nodes in work, and the sums of the nodes."""
        self.level += 1
        up = self.parent[asked]
        known = np.zeros(len(asked), bool) if last is None else (up >= 0) & (last[0][up] >= 0)
        twin = np.where(up >= 0, 2 * self.left[up] + 1 - asked, -1)
        larger = known & ((self.n[asked] > self.n[twin]) | ((self.n[asked] == self.n[twin]) & (asked > twin)))
        mine, theirs, smaller = asked[~larger], asked[larger], twin[larger]
        spot = np.full(len(self.gain), -2)
        spot[theirs] = -1
        spot[mine] = np.arange(len(mine))
        extra = smaller[spot[smaller] == -2]
        spot[extra] = len(mine) + np.arange(len(extra))
        here = spot.take(at.take(rows))
        kept = np.flatnonzero(here >= -1)
        rows, here = rows.take(kept), here.take(kept)
        some = np.flatnonzero(here >= 0)
        counted = rows.take(some)
        found = self.cells.count(place.take(counted), here.take(some), g.take(counted), len(mine) + len(extra))
        if not len(theirs):
            return mine, rows, found
        before, other, sums = last[0][up[larger]], spot[smaller], []
        for k, (old, new) in enumerate(zip(last[1], found)):
            one = self.cells.room((k, self.level % 2), len(asked))
            one[: len(mine)] = new[: len(mine)]
            np.take(old, before, axis=0, out=one[len(mine) :], mode="clip")
            one[len(mine) :] -= new[other]
            sums.append(one)
        return np.concatenate([mine, theirs]), rows, sums

    def _learn(self, asked: np.ndarray, sums: list[np.ndarray], together: int = 32) -> None:
        """The best split of each node: of the splits with enough rows on both sides, the one with the best two leaves."""
        starts = self.cells.starts[1:]
        for i in range(0, len(asked), together):
            nodes = asked[i : i + together]
            owner = self.tree[nodes]
            sure, soft = self.sure[owner][:, None], self.soft[owner][:, None]
            whole, left = [], []
            for one in sums:
                one = one[i : i + together].copy()
                whole.append(one[:, : self.cells.first].sum(axis=1))
                one[:, starts] -= whole[-1][:, None]  # sums start anew at each column
                left.append(np.cumsum(one, axis=1, out=one))
            if len(sums) == 1:
                whole.insert(0, np.rint(whole[0]))
                whole[1] = whole[1] - whole[0]
                left.insert(0, np.rint(left[0]))
                left[1] -= left[0]
            (whole_n, whole_g), (left_n, left_g) = whole, left
            right_n, right_g = whole_n[:, None] - left_n, whole_g[:, None] - left_g
            fair = np.minimum(left_n, right_n) >= self.least[owner][:, None]
            fair &= self.drawn[owner]
            parts = self._score(left_g.copy(), left_n + sure, soft)
            right_n += sure
            parts += self._score(right_g, right_n, soft)
            parts *= fair
            best = parts.argmax(axis=1)
            every = np.arange(len(nodes))
            top = parts[every, best]
            gain = top - self._score(whole_g.copy(), whole_n + sure[:, 0], soft[:, 0])
            gain[gain <= 1e-9 * top] = 0.0
            self.n[nodes], self.g[nodes], self.gain[nodes] = whole_n, whole_g, gain
            self.feature[nodes], self.cut[nodes] = self.cells.feature[best], self.cells.bin[best]
            self.left_n[nodes], self.left_g[nodes] = left_n[every, best], left_g[every, best]

    @staticmethod
    def _score(g: np.ndarray, size: np.ndarray, soft: np.ndarray) -> np.ndarray:
        """As in ``Tree``, in place of ``g``."""
        np.abs(g, out=g)
        g -= soft
        np.maximum(g, 0.0, out=g)
        g *= g
        g /= size
        return g

    def _chosen(self) -> np.ndarray:
        chosen = self.gain > 0
        over = (self.leaves > 0) & (np.bincount(self.tree[chosen], minlength=len(self.models)) >= np.maximum(self.leaves, 1))
        for tree in np.flatnonzero(over):
            chosen[self.tree == tree] = False
            queue, leaves = [(-self.gain[tree], int(tree))], 1
            while queue and leaves < self.leaves[tree]:
                gain, node = heapq.heappop(queue)
                if gain >= 0:
                    break
                chosen[node] = True
                leaves += 1
                if self.split[node]:
                    for child in (int(self.left[node]), int(self.left[node]) + 1):
                        heapq.heappush(queue, (-self.gain[child], child))
        return chosen

    def _expand(self, asked: np.ndarray) -> np.ndarray:
        """The children of the nodes that are split now."""
        going = np.zeros(len(self.models), bool)
        going[self.tree[asked]] = True
        todo = np.flatnonzero(self._chosen() & ~self.split & going[self.tree])
        k, size = len(todo), len(self.gain)
        children = size + np.arange(2 * k)
        self.split[todo] = True
        self.left[todo] = children[::2]
        whole, numbers = np.full((6, 2 * k), -1), np.zeros((3, 2 * k))
        whole[3], whole[4], whole[5] = np.repeat(todo, 2), np.repeat(self.depth[todo] + 1, 2), np.repeat(self.tree[todo], 2)
        numbers[0, ::2], numbers[0, 1::2] = self.left_n[todo], self.n[todo] - self.left_n[todo]
        numbers[1, ::2], numbers[1, 1::2] = self.left_g[todo], self.g[todo] - self.left_g[todo]
        self._hold(np.concatenate([self._whole, whole], 1), np.concatenate([self._numbers, numbers], 1), np.concatenate([self._left, np.zeros((2, 2 * k))], 1))
        self.split = np.concatenate([self.split, np.zeros(2 * k, bool)])
        return children

    def finish(self, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Leaf weight of each node; for nodes whose split better leaves have pushed out, the node that
        stands for them; and which nodes stay split."""
        chosen = self._chosen() & self.split
        kept = np.arange(len(self.gain))
        out = self.split & ~chosen
        if out.any():
            for i in np.flatnonzero(self.parent >= 0):
                up = self.parent[i]
                kept[i] = i if kept[up] == up and chosen[up] else kept[up]
        rate, alpha = (np.array([getattr(p, k) for p in self.models], float)[self.tree] for k in ("learning_rate", "reg_alpha"))
        size = np.maximum(np.abs(self.g * _UNIT * steps[self.tree]) - alpha, 0.0)
        return -rate * np.sign(self.g) * size / (self.n + self.sure[self.tree]), kept, chosen

    def grown(self, tree: int, value: np.ndarray, kept: np.ndarray, chosen: np.ndarray) -> Grown:
        alive = (self.tree == tree) & (kept == np.arange(len(kept)))
        place, chosen = np.cumsum(alive) - 1, chosen[alive]
        feature, left = np.where(chosen, self.feature[alive], -1), np.where(chosen, place[self.left[alive]], -1)
        return Grown(feature, self.cut[alive], left, value[alive], None)


def _grow_in_task(models: Sequence[Boost], scales: Sequence[Scale], bins: np.ndarray, ids: np.ndarray, ys: Sequence[np.ndarray], train: np.ndarray, trees: bool) -> list[Progress]:
    """Models from the same rows in memory, a round of all of them at a time."""
    size, width = bins.shape
    cells = Cells(bins)
    done = [Progress(p) for p in models]
    fit, val = [np.flatnonzero(train & ~np.isnan(y)) for y in ys], [np.flatnonzero(~train & ~np.isnan(y)) for y in ys]
    pred = np.repeat(np.array([s.base for s in scales])[:, None], size, axis=1)
    y, steps = np.stack(ys), np.array([s.reach for s in scales]) / GRID
    flat, place = bins.ravel(), np.tile(np.arange(size), len(models))
    active, turn = np.arange(len(models)), 0
    while len(active):
        mine = [models[k] for k in active]
        g = residuals(pred[active], y[active], steps[active][:, None]).ravel() / _UNIT
        shared: dict[int, np.ndarray] = {}
        rows = []
        for i, k in enumerate(active):
            p, here = models[k], fit[k]
            if p.subsample < 1:
                if p.seed not in shared:
                    shared[p.seed] = _uniform(ids, p.seed, 2, turn)
                here = here[shared[p.seed][here] < p.subsample]
            rows.append(here + i * size)
        grove = Grove(mine, steps[active], [drawn_columns(p, turn, width) for p in mine], cells)
        at = grove.grow(flat, place[: g.size], width, np.concatenate(rows), g)
        value, kept, chosen = grove.finish(steps[active])
        pred[active] += value[kept[at]].reshape(len(active), size)
        turn, going = turn + 1, []
        for i, k in enumerate(active):
            p, known = models[k], val[k]
            needed = len(known) and (p.patience is not None or turn == p.rounds)
            loss = _loss(pred[k, known] - y[k, known], scales[k]) / len(known) if needed else None
            if done[k].add(grove.grown(i, value, kept, chosen) if trees else None, loss):
                going.append(k)
        active = np.array(going, int)
    return done


# Data


@dataclass
class Fitted:
    """A model: ``trees`` up to its best round, and thresholds instead of bins."""

    boost: Boost
    base: float
    columns: list[str]
    cuts: list[np.ndarray]
    best: int
    grown: int
    loss: float | None
    feature: np.ndarray = field(repr=False)
    cut: np.ndarray = field(repr=False)
    left: np.ndarray = field(repr=False)
    value: np.ndarray = field(repr=False)
    sizes: np.ndarray = field(repr=False)

    def predict(self, bins: np.ndarray) -> np.ndarray:
        out = np.full(len(bins), self.base)
        at = 0
        for size in self.sizes:
            part = slice(at, at + size)
            tree = Grown(self.feature[part], self.cut[part], self.left[part], self.value[part], None)
            out += tree.value[tree.leaf(bins)]
            at += size
        return out

    @property
    def rmse(self) -> float | None:
        return None if self.loss is None else float(np.sqrt(self.loss))


def _to_bins(columns: Sequence[np.ndarray], cuts: Sequence[np.ndarray]) -> np.ndarray:
    """A byte per value: the number of cuts below it."""
    out = np.zeros((len(columns[0]) if columns else 0, len(columns)), np.uint8)
    for k, (x, c) in enumerate(zip(columns, cuts)):
        out[:, k] = np.searchsorted(c, np.where(np.isnan(x), -np.inf, x), side="left")
    return out


def _cuts(train: DataFrame, columns: Sequence[str]) -> dict[int, list[np.ndarray]]:
    """Ascending cuts per group and column; a value up to a cut goes left.

    Columns with few values have a cut at each; others at equal ranks of a sketch. At most MAX_BINS - 1
    numbers per group and column reach the driver.
    """
    probs = F.array(*[F.lit(k / MAX_BINS) for k in range(1, MAX_BINS)])
    names = [F.col(f"`{c}`") for c in columns]
    wide = train.groupBy("group").agg(
        *[F.percentile_approx(c, probs, 10_000).alias(f"q{k}") for k, c in enumerate(names)],
        *[F.approx_count_distinct(c).alias(f"d{k}") for k, c in enumerate(names)],
    ).collect()
    few = [k for k in range(len(columns)) if max((r[f"d{k}"] for r in wide), default=0) <= MAX_BINS // 2]
    sets = {}
    if few:
        rows = train.groupBy("group").agg(*[F.collect_set(names[k]).alias(f"v{k}") for k in few]).collect()
        sets = {r["group"]: r for r in rows}
    out = {}
    for r in wide:
        found = []
        for k in range(len(columns)):
            values = np.unique(np.array((sets[r["group"]][f"v{k}"][:] if k in few else r[f"q{k}"]) or [], float))
            found.append(values[~np.isnan(values)][: MAX_BINS - 1])
        out[r["group"]] = found
    return out


def _scales(train: DataFrame, labels: Sequence[str]) -> dict[tuple[int, str], Scale]:
    """Means are rounded to a billionth of the label's range: a sum of doubles depends on their order."""
    rows = train.groupBy("group").agg(*[f(y).alias(f"{f.__name__}_{y}") for y in labels for f in (F.avg, F.min, F.max)]).collect()
    out = {}
    for r in rows:
        for y in labels:
            if r[f"avg_{y}"] is not None:
                low, high = float(r[f"min_{y}"]), float(r[f"max_{y}"])
                base = low + round((r[f"avg_{y}"] - low) / ((high - low) or 1.0), 9) * (high - low)
                out[r["group"], y] = Scale(base, max(high - base, base - low) or 1.0)
    return out


def _binned(data: DataFrame, columns: Sequence[str], labels: Sequence[str], cuts: dict) -> DataFrame:
    """group, id, train, bins, y: a row per row, labels NaN where unknown."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group = batch.column(0).to_numpy(zero_copy_only=False)
            values = [batch.column(3 + k).to_numpy(zero_copy_only=False).astype(float) for k in range(len(columns))]
            y = np.stack([batch.column(3 + len(columns) + k).to_numpy(zero_copy_only=False).astype(float) for k in range(len(labels))], 1)
            bins = np.zeros((batch.num_rows, len(columns)), np.uint8)
            for one in np.unique(group):
                if one in cuts:
                    mine = np.flatnonzero(group == one)
                    bins[mine] = _to_bins([v[mine] for v in values], cuts[one])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array([b.tobytes() for b in bins], pa.binary()), pa.array(list(y), pa.list_(pa.float64()))],
                names=["group", "id", "train", "bins", "y"],
            )

    doubles = [F.col(f"`{c}`").cast("double").alias(f"x{k}") for k, c in enumerate([*columns, *labels])]
    return data.select("group", "id", "train", *doubles).mapInArrow(rows, "group int, id bigint, train boolean, bins binary, y array<double>")


_FITTED = (
    "model int, best int, grown int, loss double, sizes array<int>, feature array<int>, cut array<int>, left array<int>, value array<double>"
)


def _row(model: int, done: Progress, scale: Scale, trees: bool) -> dict:
    kept = done.trees[: done.at] if trees else []
    flat = lambda name, kind: np.concatenate([getattr(t, name) for t in kept]).astype(kind) if kept else np.array([], kind)
    return {
        "model": model, "best": done.at, "grown": done.turn,
        "loss": done.best / _LOSS_GRID * scale.reach**2 if np.isfinite(done.best) else None,
        "sizes": [len(t.value) for t in kept], "feature": flat("feature", np.int32), "cut": flat("cut", np.int32),
        "left": flat("left", np.int32), "value": flat("value", float),
    }


def _matrix(rows: dict[str, list], width: int) -> tuple[np.ndarray, ...]:
    bins = np.frombuffer(b"".join(rows["bins"]), np.uint8).reshape(len(rows["bins"]), width)
    return bins, np.array(rows["id"], np.int64), np.array(rows["train"], bool), np.array(rows["y"], float).reshape(len(bins), -1)


def _fit_in_tasks(table: DataFrame, models: list[tuple[int, Boost]], counts: dict, scales: dict, labels: list[str], width: int, trees: bool) -> DataFrame:
    """All models in one job: a task has the rows of a group and some of its models."""
    spark = table.sparkSession
    slots = max(1, spark.sparkContext.defaultParallelism)
    cost = {k: counts[p.group] * p.rounds * p.max_depth for k, p in models}
    whole, tasks = sum(cost.values()), []
    for group in sorted({p.group for _, p in models}):
        mine = sorted((m for m in models if m[1].group == group), key=lambda m: -cost[m[0]])
        share = sum(cost[k] for k, _ in mine) / whole
        beside = min(SIDE, max(1, SIDE_ROWS // counts[group]))  # models of about equal rounds grow side by side
        parts = min(len(mine), max(1, round(slots * share), min(round(16 * slots * share), -(-len(mine) // beside))))
        tasks += [(group, mine[len(mine) * i // parts : len(mine) * (i + 1) // parts]) for i in range(parts)]
    tasks.sort(key=lambda t: -sum(cost[k] for k, _ in t[1]))  # long tasks start first
    dealt = spark.createDataFrame([(g, i) for i, (g, _) in enumerate(tasks)], "group int, task int")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[str, list] = {"task": [], "id": [], "train": [], "bins": [], "y": []}
        for batch in batches:
            for name in rows:
                rows[name] += batch.column(name).to_pylist()
        if not rows["task"]:
            return
        mine = tasks[rows.pop("task")[0]][1]
        bins, ids, train, y = _matrix(rows, width)
        del rows
        per = max(1, SIDE_ROWS // len(bins))
        for i in range(0, len(mine), per):
            some = [p for _, p in mine[i : i + per]]
            found = [scales[p.group, p.label] for p in some]
            done = _grow_in_task(some, found, bins, ids, [y[:, labels.index(p.label)] for p in some], train, trees)
            for (model, _), one, scale in zip(mine[i : i + per], done, found):
                yield pa.RecordBatch.from_pylist([_row(model, one, scale, trees)], schema=_ARROW)

    # As many rows as tasks: a proven bound.
    copies = table.join(F.broadcast(dealt), "group").drop("group")
    return copies.repartitionById(len(tasks), F.col("task")).mapInArrow(fit, _FITTED)


_ARROW = pa.schema([
    ("model", pa.int32()), ("best", pa.int32()), ("grown", pa.int32()), ("loss", pa.float64()), ("sizes", pa.list_(pa.int32())),
    ("feature", pa.list_(pa.int32())), ("cut", pa.list_(pa.int32())), ("left", pa.list_(pa.int32())), ("value", pa.list_(pa.float64())),
])


def _fit_by_levels(table: DataFrame, models: list[tuple[int, Boost]], scales: dict, labels: list[str], width: int, trees: bool) -> list[dict]:
    """Models over rows that stay spread out: one aggregate per level for all models together.

    What reaches the driver is one split per open node, and losses; a cell of the aggregate is one
    number pair per (model, node, column, bin), however many rows there are.
    """
    spark = table.sparkSession
    order = [k for k, _ in models]
    by_model = dict(models)
    progress = {k: Progress(p) for k, p in models}
    state = table.select("*", F.array(*[F.lit(scales[by_model[k].group, by_model[k].label].base) for k in order]).alias("pred"))
    state, since = stored(state, "boosting"), {k: [] for k in order}
    active = list(order)
    while active:
        growing = {k: Tree(by_model[k], drawn_columns(by_model[k], progress[k].turn, width), width, scales[by_model[k].group, by_model[k].label].reach / GRID) for k in active}
        pending = {k: t for k, t in growing.items() if len(t.open)}
        while pending:
            found = _level(state, pending, since, progress, order, by_model, scales, labels, width)
            for r in found.collect():  # a row per model with its occupied cells, bounded by nodes x columns x bins
                cells = np.array([c["cell"] for c in r["cells"]])
                pending[r["model"]].learn(cells, np.array([c["n"] for c in r["cells"]], float), np.array([c["g"] for c in r["cells"]], float))
            pending = {k: t for k, t in pending.items() if t.expand() and len(t.open)}
        for k, t in growing.items():
            since[k].append(t.finish())
        losses = _losses(state, since, progress, order, active, by_model, scales, labels, width)
        for k in list(active):
            if not progress[k].add(since[k][-1], losses.get(k)):
                active.remove(k)
        if max(len(x) for x in since.values()) >= KEEP_EVERY:
            state, since = stored(_with_predictions(state, since, order, width), "boosting"), {k: [] for k in order}
    return [_row(k, progress[k], scales[by_model[k].group, by_model[k].label], trees) for k in order]


def _predictions(batch: pa.RecordBatch, since: dict, order: list[int], width: int) -> tuple[np.ndarray, ...]:
    rows = {c: batch.column(c).to_pylist() for c in ("id", "train", "bins", "y", "pred")}
    bins, ids, train, y = _matrix(rows, width)
    pred = np.array(rows["pred"], float).reshape(len(bins), len(order))
    for i, k in enumerate(order):
        for tree in since[k]:
            pred[:, i] += tree.value[tree.leaf(bins)]
    return bins, ids, train, y, pred, batch.column("group").to_numpy(zero_copy_only=False)


def _with_predictions(state: DataFrame, since: dict, order: list[int], width: int) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                pred = _predictions(batch, since, order, width)[4]
                at = batch.schema.get_field_index("pred")
                yield batch.set_column(at, "pred", pa.array(list(pred), pa.list_(pa.float64())))

    return state.mapInArrow(rows, state.schema)


def _level(state: DataFrame, pending: dict, since: dict, progress: dict, order: list[int], by_model: dict, scales: dict, labels: list[str], width: int) -> DataFrame:
    turns = {k: progress[k].turn for k in pending}

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            bins, ids, train, y, pred, group = _predictions(batch, since, order, width)
            keys = bins + (np.arange(width, dtype=np.int32) * MAX_BINS)[None, :]
            for k, tree in pending.items():
                p = by_model[k]
                label = y[:, labels.index(p.label)]
                fit = np.flatnonzero(train & (group == p.group) & ~np.isnan(label))
                fit = fit[drawn_rows(p, turns[k], ids[fit])]
                at = np.zeros(len(fit), np.int64)
                for _ in range(int(tree.depth.max())):
                    at = tree.moved(at, bins[fit])
                cells, n, s = histogram(tree, at, keys[np.ix_(fit, tree.columns)], residuals(pred[fit, order.index(k)], label[fit], tree.step))
                if k not in sums:
                    size = width * MAX_BINS * len(tree.open)
                    sums[k] = np.zeros(size), np.zeros(size)
                sums[k][0][cells] += n
                sums[k][1][cells] += s
        for k, (n, s) in sums.items():
            cells = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(cells), k, np.int32)), pa.array(cells), pa.array(n[cells].astype(np.int64)), pa.array(s[cells].astype(np.int64))],
                names=["model", "cell", "n", "g"],
            )

    parts = state.mapInArrow(partial, "model int, cell bigint, n bigint, g bigint")
    each = parts.groupBy("model", "cell").agg(F.sum("n").alias("n"), F.sum("g").alias("g"))
    return each.groupBy("model").agg(F.array_sort(F.collect_list(F.struct("cell", "n", "g"))).alias("cells"))


def _losses(state: DataFrame, since: dict, progress: dict, order: list[int], active: list[int], by_model: dict, scales: dict, labels: list[str], width: int) -> dict[int, float]:
    """Mean validation loss per model after the round, of those that need it now."""
    active = [k for k in active if by_model[k].patience is not None or progress[k].turn + 1 == by_model[k].rounds]
    if not active:
        return {}

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            bins, _, train, y, pred, group = _predictions(batch, since, order, width)
            out = []
            for k in active:
                p = by_model[k]
                label = y[:, labels.index(p.label)]
                val = np.flatnonzero(~train & (group == p.group) & ~np.isnan(label))
                out.append({"model": k, "n": len(val), "loss": _loss(pred[val, order.index(k)] - label[val], scales[p.group, p.label])})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("model", pa.int32()), ("n", pa.int64()), ("loss", pa.int64())]))

    rows = state.mapInArrow(partial, "model int, n bigint, loss bigint").groupBy("model").agg(F.sum("n").alias("n"), F.sum("loss").alias("loss"))
    return {r["model"]: r["loss"] / r["n"] for r in rows.collect() if r["n"]}


def boost(
    data: DataFrame, columns: Sequence[str], models: Sequence[Boost], trees: bool = True, cells: int = CELLS
) -> list[Fitted | None]:
    """Fit all ``models`` and give them back in their order, None where a group has no training label.

    ``data`` has ``group`` (int), ``id`` (unique in a group), ``train`` (false for validation rows), the
    feature columns and the labels. Without ``trees`` only rounds and losses come back, for searches.
    """
    if not models:
        return []
    columns, labels = list(columns), sorted({p.label for p in models})
    data = data.select(F.col("group").cast("int").alias("group"), "id", "train", *[F.col(f"`{c}`") for c in [*columns, *labels]])
    data = stored(data, "rows")
    train = data.where("train")
    cuts, scales = _cuts(train, columns), _scales(train, labels)
    counts = {r["group"]: r["count"] for r in data.groupBy("group").count().collect()}  # a row per group
    numbered = [(k, p) for k, p in enumerate(models) if (p.group, p.label) in scales and p.rounds > 0]
    table = stored(_binned(data, columns, labels, cuts), "binned")
    fits = lambda p: counts[p.group] * len(columns) <= cells
    small, large = [m for m in numbered if fits(m[1])], [m for m in numbered if not fits(m[1])]
    found: dict[int, dict] = {}
    if small:
        there = table.where(F.col("group").isin(sorted({p.group for _, p in small})))
        found |= {r["model"]: r.asDict() for r in _fit_in_tasks(there, small, counts, scales, labels, len(columns), trees).collect()}
    for group in sorted({p.group for _, p in large}):
        mine = [m for m in large if m[1].group == group]
        for i in range(0, len(mine), TOGETHER):
            rows = _fit_by_levels(table.where(F.col("group") == group), mine[i : i + TOGETHER], scales, labels, len(columns), trees)
            found |= {r["model"]: r for r in rows}
    out: list[Fitted | None] = []
    for k, p in enumerate(models):
        r = found.get(k)
        arrays = {c: np.array(r[c], float if c == "value" else np.int64) for c in ("feature", "cut", "left", "value", "sizes")} if r else {}
        out.append(Fitted(p, scales[p.group, p.label].base, columns, cuts[p.group], r["best"], r["grown"], r["loss"], **arrays) if r else None)
    return out


def predictions(models: Sequence[Fitted], columns: Sequence[str]) -> Column:
    """An array with the prediction of each model, from feature columns."""
    held = list(models)

    @F.pandas_udf("array<double>")
    def score(x: pd.DataFrame) -> pd.Series:
        values = [x.iloc[:, k].to_numpy(float) for k in range(x.shape[1])]
        found = [m.predict(_to_bins(values, m.cuts)) for m in held]
        return pd.Series(list(np.stack(found, 1)))

    return score(F.struct(*[F.col(f"`{c}`").cast("double") for c in columns]))


def score_boosted(df: DataFrame, models: dict[str, Fitted], columns: Sequence[str]) -> DataFrame:
    """``df`` with a prediction column per name."""
    out = df.withColumn("_scores", predictions(list(models.values()), columns))
    return out.withColumns({name: F.col("_scores")[k] for k, name in enumerate(models)}).drop("_scores")


def boost_per_horizon(
    df: DataFrame, columns: Sequence[str], params: dict[int, dict], train: Column | None = None, by: Sequence[str] = ("series_id", TIME)
) -> dict[int, Fitted | None]:
    """A model per horizon on rows with a known target, all in one job.

    ``params`` has arguments of ``Boost`` per horizon; rows where ``train`` does not hold validate. ``by``
    names the columns that tell rows apart.
    """
    labels = [target_name(h) for h in params]
    data = df.select(
        F.lit(0).alias("group"), F.xxhash64(*by).alias("id"), (F.lit(True) if train is None else train).alias("train"),
        *[F.col(f"`{c}`") for c in [*columns, *labels]],
    )
    return dict(zip(params, boost(data, columns, [Boost(target_name(h), **p) for h, p in params.items()])))
