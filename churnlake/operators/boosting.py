"""Histogram-boosted trees: many models grown together, resumable, in one scan a level.

Features are cut into at most ``max_bins`` bins once, and the binned rows are written. From then on a fit needs only sums: for
each (member, node, feature, bin) the gradients, hessians and rows. A member is one model: a setting and the fold it leaves
out. All members' nodes of a level are keys of the same aggregate, so k folds times s settings cost one pass a level, not k * s.

* Features with few bins share a column of joint bins, from which their sums are read: one count over the rows for many features.
* Growth is leaf-wise (best gain first, up to ``max_leaves``), by depth, or symmetric (one cut a level for all nodes). Leaf-wise
  growth expands every leaf that can still be among the best; the order is then settled from the gains, so that the
  tree equals one grown leaf by leaf.
* Gains and leaf values have an l2 term: G^2 / (H + l2) and -G / (H + l2).
* Rows keep their margin of every member. The margins and the trees say all there is, so a fit can be resumed from an ensemble, and
  early stopping ends a member at its round without fitting it again. Losses and F1 of learnt and held-out rows come with the sums.

Rows stay in Spark's partitions as NumPy blocks (iterative imperative work for which an RDD is the fitting interface). Sums are added by a shuffle and
searched for cuts by the reducers; the driver gets one cut a node, whatever the number of rows or bins. Blocks are rebuilt from the written table if executors are lost, and
margins are written to the shared folder every ``CUT_EVERY`` rounds, which also cuts the lineage. A table of binned rows
below a checked bound is broadcast instead, and the members are spread over the tasks: the same sums without a job a wave. There rows are
kept by node, and only the smaller child of a split is summed; its sibling is the parent less that one.

Forests (`_Level`) grow a tree a member by whole levels: a node looks at sqrt(features) features, at all their cuts or at one drawn cut of each.
"""

from __future__ import annotations

import heapq
import math
import sys
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.operators.models import FEATURES, fit_partitions
from churnlake.session import require_checkpoint_dir, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need NumPy and pandas, not this package

CUT_EVERY = 50  # rounds
BLOCK_ROWS = 65_536
NODES_AT_ONCE = 256  # whose gains are looked at together
JOINT_BINS = 1024  # of features that share a column
HELD_BYTES = 64 << 20  # of binned rows that one task may hold
DRIVER_BYTES = 1 << 28  # of sums that a task may hold for members grown together
SPREAD_ROWS = 1 << 20  # rows a partition, at most
SUM_ROWS = 1 << 14  # rows summed at once, hessians and rows in one number: a row counts SUM_UNIT, above the sum of so many hessians
SUM_UNIT = float(1 << 13)
HESSIAN_UNIT = 2.0**-25  # hessians are whole multiples of it, so that those sums are exact


@dataclass(frozen=True)
class Setting:
    rounds: int = 100
    step: float = 0.1
    growth: str = "leaf"  # or "depth", "symmetric"
    max_leaves: int = 31  # leaf-wise
    max_depth: int = 64
    min_leaf: int = 20
    min_split: int = 2  # rows of a node that may be cut
    min_hessian: float = 1e-3
    l2: float = 0.0
    rows: float = 1.0  # share of the rows that a round learns from
    seed: int = 42
    patience: int | None = None  # rounds without a lower loss on the held-out fold that end the fit
    random_cuts: bool = False  # forest: a node looks at sqrt(features) features, and at one drawn cut of each
    random_features: bool = False  # forest: a node looks at sqrt(features) drawn features
    bootstrap: bool = False  # forest: rows count as often as drawn with replacement

    @property
    def forest(self) -> bool:
        return self.random_cuts or self.random_features


@dataclass(frozen=True)
class Member:
    """One model: its setting and the rows it leaves out (``fold`` of the fold column number ``by``; None: learns from all)."""

    setting: Setting
    fold: int | None = None
    by: int = 0
    features: tuple[int, ...] | None = None  # places of the features it may use; None: all


@dataclass
class Tree:
    """Nodes by number, 0 the root: rows with an id of at most ``cut`` in ``feature`` go left; a leaf has feature -1."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray


@dataclass
class Ensemble:
    member: Member
    base: float
    trees: list[Tree] = field(default_factory=list)
    curve: list[dict[str, float]] = field(default_factory=list)  # after each round: loss and F1 of learnt and held-out rows
    best: int = 0  # rounds kept: those up to the lowest held-out loss where patience is set, else all

    def kept(self) -> list[Tree]:
        return self.trees[: self.best]


# ----------------------------------------------------------------------------- bins


@dataclass
class Bins:
    """``cuts[f]``: rising values; a value's bin is the number of cuts below it. Bin ids of all features follow one another."""

    cuts: list[np.ndarray]

    def __post_init__(self) -> None:
        sizes = [len(c) + 1 for c in self.cuts]
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self.count = int(self.starts[-1])

    def ids(self, x: np.ndarray) -> np.ndarray:
        """Bin ids of rows of values; NaN falls into the last bin."""
        out = np.empty(x.shape, np.int32)
        for f, c in enumerate(self.cuts):
            out[:, f] = np.searchsorted(c, x[:, f], side="left") + self.starts[f]
        return out


def find_bins(df: DataFrame, n_features: int, max_bins: int = 255, features: str = FEATURES) -> Bins:
    """Cut points at the features' approximate quantiles, all in one aggregate of mergeable sketches."""
    shares = F.array(*[F.lit(k / max_bins) for k in range(1, max_bins)])
    x = df.select(vector_to_array(F.col(features)).alias("x"))
    found = x.agg(*[F.percentile_approx(F.get("x", F.lit(f)), shares, 10_000).alias(f"q{f}") for f in range(n_features)], *[F.max(F.get("x", F.lit(f))).alias(f"m{f}") for f in range(n_features)]).first()
    cuts = []
    for f in range(n_features):
        values = np.unique(np.array(found[f"q{f}"] or [], float))
        cuts.append(values[values < found[f"m{f}"]] if len(values) else values)  # nothing lies above the largest value
    return Bins(cuts)


@dataclass
class Binned:
    """Binned training rows: (ids, label, folds, row keys) in blocks, written once."""

    blocks: DataFrame
    bins: Bins
    n_features: int
    n_folds: int


def bin_rows(df: DataFrame, label: str, folds: Sequence[str] = ("fold",), id_col: str = "id", max_bins: int = 255, features: str = FEATURES) -> Binned:
    """Bins of all rows of a training frame; ``folds`` are integer columns. Labels must be 0 or 1 without nulls."""
    first = df.select(F.size(vector_to_array(F.col(features)))).first()
    if first is None:
        raise ValueError("no rows to learn from")
    n_features = first[0]
    bins = find_bins(df, n_features, max_bins, features)
    n_folds = len(folds)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, n_features)
            parts = [bins.ids(x).astype(np.uint16 if bins.count < 65_536 else np.uint32), b.column(1).to_numpy(zero_copy_only=False).astype(np.uint8)]
            parts.append(np.stack([b.column(3 + k).to_numpy(zero_copy_only=False).astype(np.int16) for k in range(n_folds)], axis=1) if n_folds else np.empty(0, np.int16))
            parts.append(b.column(2).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([pa.array([len(x)], pa.int32()), *(pa.array([np.ascontiguousarray(p).tobytes()], pa.binary()) for p in parts)], names=["n", "ids", "y", "folds", "keys"])

    chosen = df.select(vector_to_array(F.col(features)).alias("x"), F.col(label).cast("int").alias("y"), F.xxhash64(id_col).alias("key"), *[F.col(c).cast("int").alias(f"f{k}") for k, c in enumerate(folds)])
    packed = chosen.mapInArrow(pack, "n int, ids binary, y binary, folds binary, keys binary")
    return Binned(written(packed, "binned"), bins, n_features, n_folds)


# ----------------------------------------------------------------------------- in the tasks


def walk(tree: Tree, ids: np.ndarray) -> np.ndarray:
    """The leaf of each row (a column of ``ids``)."""
    n = ids.shape[1]
    leaf, own = tree.feature < 0, np.arange(len(tree.feature))
    next_node = np.column_stack([np.where(leaf, own, tree.left), np.where(leaf, own, tree.right)]).ravel()
    at, rows, flat, node, level = np.where(leaf, 0, tree.feature).astype(np.int64) * n, np.arange(n), ids.ravel(), np.zeros(n, np.int64), np.zeros(1, np.int64)
    while len(level := level[~leaf[level]]):
        node = next_node[2 * node + (flat[at[node] + rows] > tree.cut[node])]
        level = np.concatenate([tree.left[level], tree.right[level]])
    return node


def _spread(keys: np.ndarray, salt: int) -> np.ndarray:
    """A number in [0, 1) of each row key, another for each salt."""
    x = keys.view(np.uint64) ^ np.uint64((salt * 0x9E3779B97F4A7C15) % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)) / float(1 << 53)


def _learns(member: Member, folds: np.ndarray) -> np.ndarray:
    return np.ones(len(folds), bool) if member.fold is None else folds[:, member.by] != member.fold


class Columns:
    """Features by columns of joint bins: features with few bins share one, of at most ``joint`` bins."""

    def __init__(self, starts: np.ndarray, joint: int = JOINT_BINS):
        widths = np.diff(starts)
        self.starts, self.groups, cells = starts, [], []
        for f in np.argsort(widths, kind="stable").tolist() if joint else range(len(widths)):
            if self.groups and cells[-1] * widths[f] <= joint:
                self.groups[-1].append(f)
                cells[-1] *= int(widths[f])
            else:
                self.groups.append([f])
                cells.append(int(widths[f]))
        self.cells = np.array(cells)
        self.kinds = [np.min_scalar_type(n - 1) for n in cells]
        self.column, self.ids, self.marginal, self.places = [0] * len(widths), [np.empty(0)] * len(widths), [], []
        for c, group in enumerate(self.groups):
            stride, parts = 1, []
            for f in group:
                digit = np.arange(cells[c]) // stride % widths[f]
                self.column[f], self.ids[f] = c, digit + starts[f]
                parts.append(digit[:, None] == np.arange(widths[f]))
                stride *= int(widths[f])
            self.marginal.append(np.concatenate(parts, axis=1).astype(float) if len(group) > 1 else None)
            self.places.append(np.concatenate([np.arange(starts[f], starts[f + 1]) for f in group]))

    def pack(self, ids: np.ndarray) -> tuple[np.ndarray, ...]:
        """Columns of joint bins from (features x rows) of bin ids, each as narrow as its bins allow."""
        out = []
        for kind, group in zip(self.kinds, self.groups):
            stride, total = 1, np.zeros(ids.shape[1], np.int64)
            for f in group:
                total += (ids[f].astype(np.int64) - self.starts[f]) * stride
                stride *= int(self.starts[f + 1] - self.starts[f])
            out.append(total.astype(kind))
        return tuple(out)

    def right(self, x: Sequence[np.ndarray], feature: int, cut: int, rows: np.ndarray) -> np.ndarray:
        """Which of the rows go right of a cut."""
        return (self.ids[feature] > cut)[x[self.column[feature]][rows]]

    def routed(self, tree: Tree, x: Sequence[np.ndarray], rows: np.ndarray, start: int = 0) -> Iterator[tuple[int, np.ndarray]]:
        """The rows of every leaf below the node ``start``."""
        todo = [(start, rows)]
        while todo:
            k, rows = todo.pop()
            if tree.feature[k] < 0:
                yield k, rows
            else:
                right = self.right(x, tree.feature[k], tree.cut[k], rows)
                todo += [(tree.left[k], rows[~right]), (tree.right[k], rows[right])]

    def sums(self, x: Sequence[np.ndarray], rows: np.ndarray, slot: np.ndarray | None, slots: int, weights: tuple, use: Sequence[int]) -> np.ndarray:
        """(slots, 3, bins) of gradients, hessians and rows (weights None) for the columns ``use``."""
        out = np.zeros((slots, 3, int(self.starts[-1])))
        if slot is None and len(rows) and weights[1].min() >= 0 and weights[1].max() <= 0.25:
            ends, found = np.cumsum([0, *(self.cells[c] for c in use)]), 0
            for at in range(0, len(rows), SUM_ROWS):
                part, both = rows[at : at + SUM_ROWS], np.empty(min(SUM_ROWS, len(rows) - at), complex)
                both.real, both.imag = weights[0][at : at + SUM_ROWS], weights[1][at : at + SUM_ROWS] + SUM_UNIT
                total = np.zeros(ends[-1], complex)
                for c, start, end in zip(use, ends, ends[1:]):
                    np.add.at(total[start:end], x[c].take(part).astype(np.int64), both)
                counts = np.floor(total.imag / SUM_UNIT)
                found += np.stack([total.real, total.imag - counts * SUM_UNIT, counts])
            for c, start, end in zip(use, ends, ends[1:]):
                out[0][:, self.places[c]] = found[:, start:end] if self.marginal[c] is None else found[:, start:end] @ self.marginal[c]
            return out
        for c in use:
            cells = self.cells[c]
            at = x[c][rows].astype(np.int64)
            if slot is not None:
                at += slot * cells
            found = np.stack([np.bincount(at, weights=w, minlength=slots * cells).reshape(slots, cells) for w in weights], axis=1)
            out[:, :, self.places[c]] = found if self.marginal[c] is None else found @ self.marginal[c]
        return out

    def used_by(self, member: Member) -> list[int]:
        return list(range(len(self.groups))) if member.features is None else sorted({self.column[0], *(self.column[f] for f in member.features)})


def _block(row, kind, n_features: int, n_folds: int) -> tuple:
    """ids (features x rows), labels, folds, keys."""
    n = row["n"]
    folds = np.frombuffer(bytes(row["folds"]), np.int16).reshape(n, n_folds)
    return np.ascontiguousarray(np.frombuffer(bytes(row["ids"]), kind).reshape(n, n_features).T), np.frombuffer(bytes(row["y"]), np.uint8), folds, np.frombuffer(bytes(row["keys"]), np.int64)


def _together(held: list[tuple]) -> tuple:
    return tuple(np.concatenate(parts, axis=1 if k == 0 else 0) for k, parts in enumerate(zip(*held)))


def _joined(blocks: Iterator[tuple]) -> Iterator[tuple]:
    """A partition's small blocks put together, up to BLOCK_ROWS rows."""
    held, size = [], 0
    for b in blocks:
        if held and size + len(b[1]) > BLOCK_ROWS:
            yield _together(held)
            held, size = [], 0
        held.append(b)
        size += len(b[1])
    if held:
        yield _together(held)


def _gradients(y: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = 1 / (1 + np.exp(-z))
    return p - y, np.round(p * (1 - p) / HESSIAN_UNIT) * HESSIAN_UNIT


def _measured(member: Member, y: np.ndarray, folds: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Loss, rows, hits, predicted and true positives of the learnt rows, then of the held-out rows."""
    learns, positive, one = _learns(member, folds), z >= 0, y == 1
    loss, count = np.log(1 + np.exp(-np.abs(z))) + np.maximum(z, 0) - y * z, np.count_nonzero
    return np.array([v for r in (learns, ~learns) for v in (loss @ r.astype(float), count(r), count(one & positive & r), count(positive & r), count(one & r))], float)


def _used(member: Member, folds: np.ndarray, keys: np.ndarray, salt: int) -> np.ndarray:
    use = _learns(member, folds)
    return use & (_spread(keys, salt) < member.setting.rows) if member.setting.rows < 1 else use


@dataclass
class Ask:
    """Nodes of a member's growing tree whose best cuts are wanted, with their places (1 for the root, then 2 p and 2 p + 1)."""

    member: Member
    salt: int
    tree: Tree
    nodes: list[int]
    places: list[int]


class _HeldRows:
    """All rows in one task, for members that are grown there to their end."""

    ahead = 1  # leaves cut in a wave: a wave costs little here, a cut that is not kept as much as any

    def __init__(self, block: tuple, bins: Bins, columns: Columns, margins: dict[int, np.ndarray]):
        self.block, self.bins, self.columns, self.margins, self.round = block, bins, columns, margins, {}

    def best(self, work: dict[int, Ask]) -> Iterator[tuple]:
        x, y, folds, keys = self.block
        for m, ask in work.items():
            use = self.columns.used_by(ask.member)

            def summed(rows: np.ndarray) -> np.ndarray:
                return self.columns.sums(x, rows, None, 1, (g[rows], h[rows], None), use)[0]

            if m not in self.round:
                learns = _used(ask.member, folds, keys, ask.salt)
                rows = np.flatnonzero(learns)
                g, h = _gradients(y, self.margins[m])
                self.round[m] = g, h, {0: rows}, {0: summed(rows)}, {0: np.flatnonzero(~learns)}
            g, h, held, sums, others = self.round[m]
            for k in [k for k in sums if ask.tree.feature[k] >= 0]:
                left, right = int(ask.tree.left[k]), int(ask.tree.right[k])
                whole = sums.pop(k)
                if left not in ask.nodes and right not in ask.nodes:
                    continue
                for part in (held, others):
                    rows = part.pop(k)
                    goes = self.columns.right(x, ask.tree.feature[k], ask.tree.cut[k], rows)
                    part[left], part[right] = rows[~goes], rows[goes]
                small, large = (left, right) if len(held[left]) <= len(held[right]) else (right, left)
                sums[small] = summed(held[small])
                sums[large] = whole - sums[small]
                sums[large][:, np.round(sums[large][2]) <= 0] = 0  # bins without rows are empty, not nearly so
            yield m, best_cuts(ask, self.bins, [sums[k] for k in ask.nodes])

    def advance(self, trees: dict[int, Tree], numbers: dict[int, dict[int, int] | None]) -> None:
        """The rows lie in nodes of the growing tree already, so they go on from there; ``numbers``: those nodes' numbers in the tree."""
        for m, t in trees.items():
            _, _, held, _, others = self.round.pop(m)
            lie = [(k if numbers[m] is None else numbers[m].get(k), rows) for part in (held, others) for k, rows in part.items()]
            if any(k is None for k, _ in lie):  # nodes that the tree does not keep
                lie = [(0, np.arange(len(self.block[1])))]
            for start, rows in lie:
                for k, at in self.columns.routed(t, self.block[0], rows, start):
                    self.margins[m][at] += t.value[k]

    def measures(self, members: dict[int, Member]) -> Iterator[tuple]:
        return ((m, _measured(x, self.block[1], self.block[2], self.margins[m])) for m, x in members.items())


def _with_margins(bases: np.ndarray, trees: dict[int, list[Tree]], columns):
    def run(block: tuple) -> tuple:
        rows, margins = np.arange(len(block[1])), np.tile(bases, (len(block[1]), 1))
        for m, held in trees.items():
            for t in held:
                for k, at in columns.value.routed(t, block[0], rows):
                    margins[at, m] += t.value[k]
        return *block, margins

    return run


def _advanced(trees: dict[int, Tree], columns):
    """Add new trees to the margins of their members."""

    def run(block: tuple) -> tuple:
        rows, margins = np.arange(len(block[1])), block[4].copy()
        for m, tree in trees.items():
            for k, at in columns.value.routed(tree, block[0], rows):
                margins[at, m] += tree.value[k]
        return *block[:4], margins

    return run


def _spread_measures(members: dict[int, Member]):
    def run(blocks: Iterator[tuple]) -> Iterator[tuple]:
        total: dict[int, np.ndarray] = {}
        for _, y, folds, _, margins in blocks:
            for m, member in members.items():
                total[m] = total.get(m, 0) + _measured(member, y, folds, margins[:, m])
        yield from total.items()

    return run


def _spread_sums(work: dict[int, Ask], columns):
    """(member, slot) -> sums of a node asked for; of a symmetric tree (member, -1) -> sums of the whole level."""

    def run(blocks: Iterator[tuple]) -> Iterator[tuple]:
        total: dict[int, np.ndarray] = {}
        for x, y, folds, keys, margins in blocks:
            for m, ask in work.items():
                slot_of = {k: j for j, k in enumerate(ask.nodes)}
                if m not in total:
                    total[m] = np.zeros((len(ask.nodes), 3, int(columns.value.starts[-1])))
                for k, rows in columns.value.routed(ask.tree, x, np.flatnonzero(_used(ask.member, folds, keys, ask.salt))):
                    if k in slot_of:
                        total[m][slot_of[k]] += columns.value.sums(x, rows, None, 1, (*_gradients(y[rows], margins[rows, m]), None), columns.value.used_by(ask.member))[0]
        for m, sums in total.items():
            yield from [((m, -1), sums)] if work[m].member.setting.growth == "symmetric" else (((m, k), t) for k, t in enumerate(sums))

    return run


def _reduced(pairs) -> list[tuple]:
    """Sums by key: each partition sends one array a key, reducers add them, the driver gets one array a key."""
    parts = pairs.getNumPartitions()
    return pairs.collect() if parts == 1 else pairs.reduceByKey(lambda a, b: a + b, parts).collect()


class _SpreadRows:
    """Rows in Spark's partitions; each wave of nodes of all members is one job."""

    ahead = 16  # leaves cut in a wave, as a wave costs a job

    def __init__(self, rows, bins, columns, bases: np.ndarray, trees: dict[int, list[Tree]], folder: str):
        self.bins, self.columns, self.folder, self.rounds = bins, columns, folder, 0
        self.state = rows.map(_with_margins(bases, trees, columns)).persist(StorageLevel.MEMORY_AND_DISK)

    def best(self, work: dict[int, Ask]) -> Iterator[tuple]:
        bins, found = self.bins, {m: [None] * len(ask.nodes) for m, ask in work.items()}
        blank = {m: Ask(a.member, a.salt, None, a.nodes, a.places) for m, a in work.items()}

        def cuts(pair: tuple) -> tuple:
            (m, k), sums = pair
            ask = blank[m]
            return (m, k), best_cuts(ask if k < 0 else Ask(ask.member, ask.salt, None, [ask.nodes[k]], [ask.places[k]]), bins.value, sums if k < 0 else [sums])

        pairs = self.state.mapPartitions(_spread_sums(work, self.columns))
        parts = max(1, min(pairs.getNumPartitions(), sum(1 if a.member.setting.growth == "symmetric" else len(a.nodes) for a in work.values())))
        for (m, k), cut in pairs.reduceByKey(lambda a, b: a + b, parts).map(cuts).collect():  # a cut a node
            if k < 0:
                found[m] = cut
            else:
                found[m][k] = cut[0]
        return iter(found.items())

    def advance(self, trees: dict[int, Tree], numbers: dict[int, dict[int, int] | None]) -> None:
        self.old, self.state, self.rounds = self.state, self.state.map(_advanced(trees, self.columns)), self.rounds + 1
        if self.rounds % CUT_EVERY == 0:
            path, context = f"{self.folder}/margins-{uuid.uuid4().hex}", self.state.context
            parts = self.state.getNumPartitions()
            self.state.saveAsPickleFile(path)
            self.state = context.pickleFile(path, parts)
        self.state.persist(StorageLevel.MEMORY_AND_DISK)

    def measures(self, members: dict[int, Member]) -> list[tuple]:
        found = _reduced(self.state.mapPartitions(_spread_measures(members)))
        self.old.unpersist()
        return found

    def close(self) -> None:
        self.state.unpersist()


# ----------------------------------------------------------------------------- cuts


def split_gains(sums: np.ndarray, bins: Bins, l2: float | np.ndarray, min_leaf: int | np.ndarray, min_hessian: float | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of (nodes, 3, bins) sums: the gain of cutting after each bin (-inf where not allowed), and the left sides' sums."""
    run = np.cumsum(sums, axis=2)
    before = np.concatenate([np.zeros((*run.shape[:2], 1)), run], axis=2)[:, :, bins.starts[:-1]]
    widths = np.diff(bins.starts)
    left = run - np.repeat(before, widths, axis=2)
    total = sums[:, :, bins.starts[0] : bins.starts[1]].sum(axis=2, keepdims=True)  # every row is in one bin of the first feature
    right = total - left
    column = lambda v: np.reshape(v, (-1, 1)) if np.ndim(v) else v
    score = lambda t: t[:, 0] ** 2 / np.maximum(t[:, 1] + column(l2), 1e-300)
    gain = score(left) + score(right) - score(total)
    fine = (np.minimum(left[:, 2], right[:, 2]) >= np.maximum(column(min_leaf), 1)) & (np.minimum(left[:, 1], right[:, 1]) >= column(min_hessian))
    return np.where(fine, gain, -np.inf), left


def _first_best(gain: np.ndarray) -> np.ndarray:
    """The first of the highest entries of each row; entries that differ by rounding alone are the same."""
    top = gain.max(axis=-1, keepdims=True)
    return (gain >= top - 1e-10 * np.abs(top)).argmax(axis=-1)


def best_cuts(ask: Ask, bins: Bins, sums: Sequence[np.ndarray]) -> list[tuple]:
    """(sums, gain, cut, left sums) of every node asked for (the gain is 0 where no cut is of use); in a symmetric tree the cut is that of the level."""
    s, out = ask.member.setting, []
    barred = None
    if ask.member.features is not None:
        mask = np.ones(len(bins.cuts), bool)
        mask[list(ask.member.features)] = False
        barred = np.repeat(mask, np.diff(bins.starts))
    level, lefts = np.zeros(bins.count), []
    for at in range(0, len(sums), NODES_AT_ONCE):
        part = np.stack(sums[at : at + NODES_AT_ONCE])
        gain, left = split_gains(part, bins, s.l2, s.min_leaf, s.min_hessian)
        if barred is not None:
            gain[:, barred] = -np.inf
        total = part[:, :, : bins.starts[1]].sum(axis=2)
        if s.growth == "symmetric":
            level += np.where(np.isfinite(gain), np.maximum(gain, 0), 0).sum(axis=0)
            lefts.append((total, left))
            continue
        for j, b in enumerate(_first_best(gain).tolist()):
            out.append((total[j], float(gain[j, b]), b, left[j, :, b].copy()) if gain[j, b] > 1e-12 else (total[j], 0.0, 0, None))
    if s.growth == "symmetric":
        b = int(_first_best(level))
        out = [(t, float(level[b]) if level[b] > 1e-12 else 0.0, b, one[:, b].copy()) for total, left in lefts for t, one in zip(total, left)]
    return out


# ----------------------------------------------------------------------------- on the driver


class _Grower:
    """One member's tree of one round: nodes with their cuts and gains."""

    def __init__(self, member: Member, bins: Bins, salt: int, ahead: int):
        self.member, self.bins, self.salt, self.ahead, s = member, bins, salt, ahead, member.setting
        self.feature, self.cut, self.left, self.right, self.depth = [-1], [0], [-1], [-1], [0]
        self.total: list[np.ndarray | None] = [None]
        self.best: list[tuple | None] = [None]  # gain, cut id, left sums
        self.path = [1]
        self.asked = [0]
        self.done = False
        self.number: dict[int, int] | None = None  # of the grown nodes in the tree, where it keeps only some
        self.limit = s.max_leaves - 1 if s.growth == "leaf" else 1 << 30

    def tree(self) -> Tree:
        as_int = lambda v: np.array(v, np.int32)
        return Tree(as_int(self.feature), as_int(self.cut), as_int(self.left), as_int(self.right), np.zeros(len(self.feature)))

    def ask(self) -> Ask:
        return Ask(self.member, self.salt, self.tree(), self.asked, [self.path[k] for k in self.asked])

    def take(self, found: list[tuple]) -> None:
        """The best cuts of the nodes asked for; then say what to ask next."""
        fresh, self.asked = self.asked, []
        if self.total[0] is None:
            self.total[0] = found[0][0]
        for k, (_, gain, cut, left) in zip(fresh, found):
            if gain > 0 and self.total[k][2] >= self.member.setting.min_split:
                self.best[k] = gain, cut, left
        if self.member.setting.growth == "symmetric":
            for k, (_, gain, cut, left) in zip(fresh, found):
                if gain > 0:
                    self._cut(k, cut, left)
            self._ask_all(fresh)
        elif self.member.setting.growth == "depth":
            for k in fresh:
                if self.best[k]:
                    self._cut(k, *self.best[k][1:])
            self._ask_all(fresh)
        else:
            self._leaf_wise()

    def _ask_all(self, level: list[int]) -> None:
        for k in level:
            if self.feature[k] >= 0:
                self._ask(k)
        self.done = not self.asked

    def _cut(self, node: int, at: int, left: np.ndarray) -> None:
        f = int(np.searchsorted(self.bins.starts, at, side="right")) - 1
        self.feature[node], self.cut[node] = f, at
        self.left[node], self.right[node] = len(self.feature), len(self.feature) + 1
        for side in (left, self.total[node] - left):
            self.feature.append(-1), self.cut.append(0), self.left.append(-1), self.right.append(-1)
            self.path.append(2 * self.path[node] + (len(self.feature) - 1 == self.right[node]))
            self.depth.append(self.depth[node] + 1), self.total.append(side), self.best.append(None)

    def _ask(self, node: int) -> None:
        """The children of a cut node that may be cut."""
        s = self.member.setting
        if self.depth[node] + 1 < s.max_depth:
            least = 0 if s.growth == "symmetric" else max(s.min_split, 2 * max(s.min_leaf, 1))
            self.asked += [k for k in (self.left[node], self.right[node]) if round(self.total[k][2]) >= least]

    def _leaf_wise(self) -> None:
        """Cut, tentatively, every open leaf that can still be among the best; settle once the order is known."""
        while True:
            order, open_leaves = self._order()
            if not open_leaves:
                break
            room = self.limit - len(order)
            for _, k in heapq.nsmallest(min(room, self.ahead), ((-self.best[k][0], k) for k in open_leaves)):
                self._cut(k, *self.best[k][1:])
                self._ask(k)
            if self.asked:
                return
        self._prune(order)
        self.done = True

    def _order(self) -> tuple[list[int], list[int]]:
        """The cuts in the order leaf-wise growth makes them, as far as gains are known; and the leaves whose cut is known but not made,
        up to the first of them that comes next (then growth has to wait)."""
        order, heap, waiting = [], [(-self.best[0][0], 0)] if self.best[0] else [], []
        while heap and len(order) + len(waiting) < self.limit:
            _, k = heapq.heappop(heap)
            if self.feature[k] < 0:
                if len(order) + len(waiting) == self.limit - 1 and not waiting:
                    self._cut(k, *self.best[k][1:])  # the last cut: its children's gains do not matter
                else:
                    waiting.append(k)
                    continue
            if not waiting:
                order.append(k)
            for c in (self.left[k], self.right[k]):
                if self.best[c]:
                    heapq.heappush(heap, (-self.best[c][0], c))
        return order, waiting

    def _prune(self, order: list[int]) -> None:
        """Keep the cuts of ``order`` alone."""
        chosen, number, todo = set(order), {}, [0]
        while todo:
            k = todo.pop()
            number[k] = len(number)
            if k in chosen:
                todo += [self.right[k], self.left[k]]
        self.number, nodes = number, list(number)
        inner = [k in chosen for k in nodes]
        self.left = [number[self.left[k]] if i else -1 for k, i in zip(nodes, inner)]
        self.right = [number[self.right[k]] if i else -1 for k, i in zip(nodes, inner)]
        self.feature, self.cut = [self.feature[k] if i else -1 for k, i in zip(nodes, inner)], [self.cut[k] if i else 0 for k, i in zip(nodes, inner)]
        self.total = [self.total[k] for k in nodes]

    def finished(self) -> Tree:
        s, t = self.member.setting, self.tree()
        totals = np.array([np.zeros(3) if x is None else x for x in self.total])
        t.value = np.where(t.feature < 0, -s.step * totals[:, 0] / np.maximum(totals[:, 1] + s.l2, 1e-16), 0.0)
        t.value[totals[:, 2] <= 0] = 0.0  # a cut may leave a symmetric tree's leaf without rows
        return t


def best_round(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """The round with the lowest loss up to the first run of ``patience`` rounds without a lower one, and whether that run was seen."""
    best, at = float("inf"), -1
    for k, loss in enumerate(losses):
        if loss < best:
            best, at = loss, k
        elif k - at >= patience:
            return at, True
    return at, False


def _f1(hit: float, predicted: float, positive: float) -> float:
    return 2 * hit / (predicted + positive) if predicted + positive else 0.0


def _boost(found: dict[int, Ensemble], bins: Bins, rows) -> None:
    """Grow the ensembles round by round from the cuts that ``rows`` finds."""
    members = {m: e.member for m, e in found.items()}
    active = {m for m, e in found.items() if not _finished(e)}
    while active:
        growers = {m: _Grower(members[m], bins, _salt(found[m]), rows.ahead) for m in sorted(active)}
        growing = dict(growers)
        while growing:
            for m, cuts in rows.best({m: g.ask() for m, g in growing.items()}):
                growing[m].take(cuts)
            growing = {m: g for m, g in growing.items() if not g.done}
        new = {m: g.finished() for m, g in growers.items()}
        for m, t in new.items():
            found[m].trees.append(t)
        rows.advance(new, {m: growers[m].number for m in new})
        for m, t in rows.measures({m: members[m] for m in active}):
            found[m].curve.append(_point(t))
        active = {m for m in active if not _finished(found[m])}


def _salt(e: Ensemble) -> int:
    return e.member.setting.seed * 1_000_003 + len(e.trees)


def _point(t: np.ndarray) -> dict[str, float]:
    point = {}
    for part, (loss, n, hit, predicted, positive) in (("learn", t[:5].tolist()), ("held", t[5:].tolist())):
        point |= {f"{part}_loss": loss / n if n else math.nan, f"{part}_f1": _f1(hit, predicted, positive)}
    return point


def _finished(e: Ensemble) -> bool:
    return len(e.trees) >= e.member.setting.rounds or _stopped(e)


def _base(counts: np.ndarray) -> float:
    """The log-odds of the learnt rows' share of class 1."""
    share = min(max(counts[4] / counts[1] if counts[1] else 0.5, 1e-6), 1 - 1e-6)
    return math.log(share / (1 - share))


# ----------------------------------------------------------------------------- forests


def _times(keys: np.ndarray, salt: int) -> np.ndarray:
    """How often each row is drawn with replacement: a Poisson number of mean 1."""
    below = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])
    return np.searchsorted(below, _spread(keys, salt ^ 0x5DEECE66D), side="right").astype(float)


class _Level:
    """A forest member's tree, grown by whole levels: the open nodes stand in rising order."""

    def __init__(self, member: Member, bins: Bins, salt: int, base: float):
        self.member, self.bins, self.salt, p = member, bins, salt, 1 / (1 + math.exp(-base))
        self.share, self.hessian = p, p * (1 - p)
        self.n_drawn = max(1, math.isqrt(len(bins.cuts)))
        empty = np.empty(0, np.int64)
        self.feature, self.cut, self.left, self.total = np.array([-1]), np.array([0]), np.array([-1]), np.zeros((1, 2))
        self.open, self.place, self.depth, self.chosen, self.cuts = np.array([0]), np.array([1], np.uint64), 0, empty, empty

    def tree(self) -> Tree:
        as_int = lambda v: v.astype(np.int32)
        return Tree(as_int(self.feature), as_int(self.cut), as_int(self.left), as_int(np.where(self.left >= 0, self.left + 1, -1)), np.zeros(len(self.feature)))

    def slots(self) -> np.ndarray:
        out = np.full(len(self.feature), -1, np.int64)
        out[self.open] = np.arange(len(self.open))
        return out

    def draw(self, ranges: np.ndarray | None) -> None:
        """The features that the open nodes look at and, from their (smallest, largest) bins, one cut of each (-1: none)."""
        starts, n = self.bins.starts, len(self.bins.cuts)
        if not self.member.setting.random_cuts:
            order = np.stack([_spread(self.place * np.uint64(n) + np.uint64(f), self.salt) for f in range(n)], axis=1)
            if self.member.features is not None:
                order[:, [f for f in range(n) if f not in self.member.features]] += 1
            self.chosen = np.argsort(order, axis=1, kind="stable")[:, : self.n_drawn]
            return
        self.chosen, self.cuts = np.zeros((len(self.open), self.n_drawn), np.int64), np.full((len(self.open), self.n_drawn), -1)
        for j, path in enumerate(self.place.tolist()):
            draw, (low, high) = np.random.default_rng([self.salt, path]), ranges[j]
            order, at = draw.random(n), draw.random(n)
            varies = low < high
            if self.member.features is not None:
                varies &= np.isin(np.arange(n), self.member.features)
            picked = np.argsort(np.where(varies, order, 2.0))[: min(int(varies.sum()), self.n_drawn)]
            for i, f in enumerate(picked.tolist()):
                edges = self.bins.cuts[f][low[f] - starts[f] : high[f] - starts[f]]
                self.chosen[j, i] = f
                self.cuts[j, i] = low[f] + np.abs(edges - (edges[0] + at[f] * (edges[-1] - edges[0]))).argmin()

    def widths(self) -> np.ndarray:
        return np.diff(self.bins.starts)[self.chosen]

    def summed(self, ids: np.ndarray, rows: np.ndarray, sizes: np.ndarray, g: np.ndarray, w: np.ndarray) -> list[np.ndarray]:
        """Gradients and rows of the open nodes (rows in their order): for each drawn feature by bin, or left of the drawn cut and in all."""
        n, flat, slot, out, pairs = ids.shape[1], ids.ravel(), np.repeat(np.arange(len(sizes)), sizes), [], (g[rows] * w[rows], w[rows])
        if self.member.setting.random_cuts:
            every = [np.bincount(slot, weights=v, minlength=len(sizes)) for v in pairs]
            out = [np.stack(every)]
            for j in range(self.n_drawn):
                goes = flat[np.repeat(self.chosen[:, j] * n, sizes) + rows] <= np.repeat(self.cuts[:, j], sizes)
                out.append(np.stack([np.bincount(slot, weights=v * goes, minlength=len(sizes)) for v in pairs]))
            return out
        widths = self.widths()
        for j in range(self.n_drawn):
            ends = np.cumsum(widths[:, j])
            shift = ends - widths[:, j] - self.bins.starts[self.chosen[:, j]]
            at = flat[np.repeat(self.chosen[:, j] * n, sizes) + rows] + np.repeat(shift, sizes)
            out.append(np.stack([np.bincount(at, weights=v, minlength=ends[-1]) for v in pairs]))
        return out

    def found(self, sums: list[np.ndarray]) -> tuple[np.ndarray, ...]:
        """Which open nodes are cut, in what feature and where, the sums left of the cut and in all; and the sums of the first open node."""
        s, k = self.member.setting, len(self.open)
        score = lambda t: t[0] ** 2 / np.maximum(self.hessian * t[1] + s.l2, 1e-300)
        widths = None if s.random_cuts else self.widths()
        total = sums[0] if s.random_cuts else np.add.reduceat(sums[0], np.cumsum(widths[:, 0]) - widths[:, 0], axis=1)
        best, at, feature, lefts = np.full(k, 1e-12), np.full(k, -1), np.zeros(k, np.int64), np.zeros((2, k))
        for j in range(self.n_drawn):
            f = self.chosen[:, j]
            if s.random_cuts:
                left, inside = sums[1 + j], total - sums[1 + j]
                allowed = self.cuts[:, j] >= 0
            else:
                first = np.cumsum(widths[:, j]) - widths[:, j]
                run = np.cumsum(sums[j], axis=1)
                left = run - np.repeat((run - sums[j])[:, first], widths[:, j], axis=1)
                inside, allowed = np.repeat(total, widths[:, j], axis=1) - left, True
            gain = score(left) + score(inside) - (score(total) if s.random_cuts else np.repeat(score(total), widths[:, j]))
            gain = np.where(allowed & (np.minimum(left[1], inside[1]) > max(s.min_leaf, 1) - 0.5), gain, -np.inf)
            if s.random_cuts:
                place, cut = np.arange(k), self.cuts[:, j]
            else:
                top = np.maximum.reduceat(gain, first)
                same = np.flatnonzero(gain >= np.repeat(top - 1e-10 * np.abs(top), widths[:, j]))
                place = same[np.searchsorted(same, first)]
                cut = place - first + self.bins.starts[f]
                gain = gain[place]
            better = gain > best * (1 + 1e-10)
            if self.member.features is not None:
                better &= np.isin(f, self.member.features)
            best[better], at[better], feature[better], lefts[:, better] = gain[better], cut[better], f[better], left[:, place[better]]
        cut = np.flatnonzero((at >= 0) & (total[1] > s.min_split - 0.5))
        return cut.astype(np.int32), feature[cut].astype(np.int32), at[cut].astype(np.int32), lefts[:, cut], total[:, cut], total[:, 0].copy()

    def take(self, cut: np.ndarray, feature: np.ndarray, at: np.ndarray, lefts: np.ndarray, total: np.ndarray, first: np.ndarray) -> None:
        """Cut the open nodes where that is of use (``found``); their children that may be cut are the next open nodes."""
        s = self.member.setting
        if self.depth == 0:
            self.total[0] = first
        nodes, size = self.open[cut], len(self.feature)
        self.feature[nodes], self.cut[nodes], self.left[nodes] = feature, at, size + 2 * np.arange(len(cut))
        children = np.stack([lefts.T, (total - lefts).T], axis=1).reshape(-1, 2)
        for name, blank in (("feature", -1), ("cut", 0), ("left", -1)):
            setattr(self, name, np.concatenate([getattr(self, name), np.full(2 * len(cut), blank)]))
        self.total = np.concatenate([self.total, children])
        self.depth += 1
        fine = (children[:, 1] > max(s.min_split, 2 * max(s.min_leaf, 1)) - 0.5) & (self.depth < s.max_depth)
        self.open = size + np.flatnonzero(fine)
        self.place = np.stack([2 * self.place[cut], 2 * self.place[cut] + np.uint64(1)], axis=1).ravel()[fine]

    def finished(self) -> Tree:
        s, t = self.member.setting, self.tree()
        t.value = np.where((t.feature < 0) & (self.total[:, 1] > 0.5), -s.step * self.total[:, 0] / np.maximum(self.hessian * self.total[:, 1] + s.l2, 1e-16), 0.0)
        return t


def _sorted_open(level: _Level, ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the rows those in open nodes, node by node, and how many each has."""
    slot = level.slots()[walk(level.tree(), ids if len(rows) == ids.shape[1] else ids[:, rows])]
    order = np.argsort(slot.astype(np.int16) if len(level.open) < 32_768 else slot, kind="stable")
    order = order[np.count_nonzero(slot < 0) :]
    return rows[order], np.bincount(slot[order], minlength=len(level.open))


def _ranges(ids: np.ndarray, rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """(nodes, 2, features): smallest and largest bin id; a node without rows has them the wrong way round."""
    out = np.empty((len(sizes), 2, len(ids)), np.int64)
    out[:, 0], out[:, 1] = np.iinfo(np.int32).max, -1
    some = np.flatnonzero(sizes)
    if len(some):
        first = (np.cumsum(sizes) - sizes)[some]
        for f in range(len(ids)):
            x = ids[f][rows]
            out[some, 0, f], out[some, 1, f] = np.minimum.reduceat(x, first), np.maximum.reduceat(x, first)
    return out


def _split_open(level: _Level, ids: np.ndarray, rows: np.ndarray, sizes: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the nodes that were open (``before``), handed to those of their children that are open now."""
    left = level.left[before]
    node = np.repeat(left, sizes)
    rows, node = rows[node >= 0], node[node >= 0]
    feature, cut = level.feature[before], level.cut[before]
    kept = np.repeat(np.arange(len(before))[left >= 0], sizes[left >= 0])
    goes = ids.ravel()[feature[kept] * ids.shape[1] + rows] > cut[kept]
    child = level.slots()[node + goes]
    order = np.argsort(child.astype(np.int16) if len(level.open) < 32_768 else child, kind="stable")
    order = order[np.count_nonzero(child < 0) :]
    return rows[order], np.bincount(child[order], minlength=len(level.open))


def _held_tree(block: tuple, bins: Bins, e: Ensemble) -> Tree:
    """One forest member's tree over rows held in the task."""
    ids, y, folds, keys = block
    level = _Level(e.member, bins, _salt(e), e.base)
    rows = np.flatnonzero(_used(e.member, folds, keys, level.salt))
    w = _times(keys, level.salt) if e.member.setting.bootstrap else np.ones(len(y))
    rows, g = rows[w[rows] > 0], level.share - y
    sizes = np.array([len(rows)])
    while len(level.open) and len(rows):
        level.draw(_ranges(ids, rows, sizes) if e.member.setting.random_cuts else None)
        before = level.open
        level.take(*level.found(level.summed(ids, rows, sizes, g, w)))
        rows, sizes = _split_open(level, ids, rows, sizes, before)
    return level.finished()


def _spread_level(levels: dict[int, _Level], ranges: bool):
    """(member, part) -> ranges or sums of its open nodes."""

    def run(blocks: Iterator[tuple]) -> Iterator[tuple]:
        total: dict[tuple, np.ndarray] = {}
        for ids, y, folds, keys in blocks:
            for m, level in levels.items():
                w = _times(keys, level.salt) if level.member.setting.bootstrap else np.ones(len(y))
                rows, sizes = _sorted_open(level, ids, np.flatnonzero(_used(level.member, folds, keys, level.salt) & (w > 0)))
                if ranges:
                    found = _ranges(ids, rows, sizes)
                    found[:, 1] *= -1  # so that the smaller wins in both
                    total[m, 0] = np.minimum(total[m, 0], found) if (m, 0) in total else found
                else:
                    for j, t in enumerate(level.summed(ids, rows, sizes, level.share - y, w)):
                        total[m, j] = total.get((m, j), 0) + t
        yield from total.items()

    return run


def _spread_forest(lot: dict[int, Ensemble], bins: Bins, rows) -> None:
    """Grow a lot of forest members a level a job (two where cuts are drawn). Sums meet by member in the reducers, which find the cuts;
    the driver gets the cuts of the level's nodes alone, never what it knows of the trees already."""
    levels = {m: _Level(e.member, bins, _salt(e), e.base) for m, e in lot.items()}
    parts = rows.getNumPartitions()
    while True:
        opened = {m: v for m, v in levels.items() if len(v.open)}
        if not opened:
            break
        drawn = {m: v for m, v in opened.items() if v.member.setting.random_cuts}
        for m, v in opened.items():
            if m not in drawn:
                v.draw(None)

        def with_cuts(pair: tuple) -> tuple:
            (m, _), found = pair
            found[:, 1] *= -1
            drawn[m].draw(found)
            return m, (drawn[m].chosen.astype(np.int32), drawn[m].cuts.astype(np.int32))

        if drawn:
            found = rows.mapPartitions(_spread_level(drawn, True)).reduceByKey(np.minimum, min(parts, len(drawn))).map(with_cuts).collect()  # a few cuts a node
            for m, (chosen, cuts) in found:
                levels[m].chosen, levels[m].cuts = chosen.astype(np.int64), cuts.astype(np.int64)

        def cut(pair: tuple) -> tuple:
            m, sums = pair
            return m, opened[m].found([t for _, t in sorted(sums, key=lambda jt: jt[0])])

        sums = rows.mapPartitions(_spread_level(opened, False)).reduceByKey(lambda a, b: a + b, parts)
        for m, found in sums.map(lambda pair: (pair[0][0], (pair[0][1], pair[1]))).groupByKey(min(parts, len(opened))).map(cut).collect():  # a cut a node
            levels[m].take(*found)
    for m, e in lot.items():
        e.trees.append(levels[m].finished())


# ----------------------------------------------------------------------------- fits


def _grown(sent, start: dict[int, Ensemble], fresh: bool):
    """Grow one member to its end on rows held in the task."""

    def run(m: int) -> tuple[int, Ensemble]:
        (ids, *rest), x, columns, bins = sent.value
        e = start[m]
        if fresh:
            e.base = _base(_measured(e.member, rest[0], rest[1], np.zeros(len(rest[0]))))
        if e.member.setting.forest:
            e.trees.append(_held_tree((ids, *rest), bins, e))
            return m, e
        margin, rows = np.full(len(rest[0]), e.base), np.arange(len(rest[0]))
        for t in e.trees:
            for k, at in columns.routed(t, x, rows):
                margin[at] += t.value[k]
        _boost({m: e}, bins, _HeldRows((x, *rest), bins, columns, {m: margin}))
        return m, e

    return run


def fit(data: Binned, members: Sequence[Member], resume: Sequence[Ensemble] | None = None, held_bytes: int = HELD_BYTES) -> list[Ensemble]:
    """Boost all members together. With ``resume``, the ensembles of an earlier fit of the same data (members with more rounds) go on.

    Binned rows of at most ``held_bytes`` are broadcast, and each member is grown in a task of its own. Larger tables stay in
    their partitions, and every wave of nodes, of all members, is one aggregate over them. Both ways add the same sums.

    A member whose rows have one class only keeps about its base margin. Held-out rows are those of the member's fold; a member
    without one has no held-out loss, and patience does not stop it. Forest members are one tree each, without a curve.
    """
    spark = data.blocks.sparkSession
    kind, n_features, n_folds = np.uint16 if data.bins.count < 65_536 else np.uint32, data.n_features, data.n_folds
    found = {m: (_resumed(resume[m], x) if resume else Ensemble(x, 0.0)) for m, x in enumerate(members)}
    size = data.blocks.agg(F.sum("n").alias("rows"), F.sum(F.octet_length("ids")).alias("bytes")).first()
    columns, boosted = Columns(data.bins.starts), [m for m, e in found.items() if not e.member.setting.forest]
    if size["bytes"] <= held_bytes:
        block = _together([_block(r, kind, n_features, n_folds) for r in data.blocks.collect()])  # at most held_bytes
        forest = len(boosted) < len(found)
        sent = spark.sparkContext.broadcast(((block[0] if forest else None, *block[1:]), columns.pack(block[0]) if boosted else None, columns, data.bins))
        order = sorted(found, key=lambda m: -found[m].member.setting.rounds)
        slices = len(order) if boosted else min(len(order), 4 * spark.sparkContext.defaultParallelism)
        found = dict(spark.sparkContext.parallelize(order, slices).map(_grown(sent, found, not resume)).collect())
        sent.unpersist()
    else:
        parts = max(1, math.ceil(size["rows"] / SPREAD_ROWS), min(spark.sparkContext.defaultParallelism, fit_partitions(spark, size["rows"])))
        source = data.blocks.rdd
        source = source.coalesce(parts) if parts < source.getNumPartitions() else source
        plain = source.map(lambda r: _block(r, kind, n_features, n_folds)).mapPartitions(_joined).persist(StorageLevel.MEMORY_AND_DISK)
        sent, all_bins = spark.sparkContext.broadcast(columns), spark.sparkContext.broadcast(data.bins)
        for lot in _lots(found, data.bins.count, n_features):
            if not resume:
                counts = dict(_reduced(plain.map(lambda b, zeros=np.zeros(len(lot)): (*b, np.tile(zeros, (len(b[1]), 1)))).mapPartitions(_spread_measures({m: e.member for m, e in lot.items()}))))
                for m, e in lot.items():
                    e.base = _base(counts[m])
            if next(iter(lot.values())).member.setting.forest:
                _spread_forest(lot, data.bins, plain)
                continue
            drawn = any(e.member.setting.rows < 1 for e in lot.values())  # else no row's key is asked for
            rows = plain.map(lambda b, last=None if drawn else 0: (sent.value.pack(b[0]), *b[1:3], b[3][:last]))
            spread = _SpreadRows(rows, all_bins, sent, np.array([e.base for e in lot.values()]), {m: e.trees for m, e in lot.items()}, require_checkpoint_dir(spark))
            _boost(lot, data.bins, spread)
            spread.close()
        plain.unpersist()
    for e in found.values():
        patience, held = e.member.setting.patience, [p["held_loss"] for p in e.curve]
        e.best = best_round(held, patience)[0] + 1 if patience and held and not math.isnan(held[0]) else len(e.trees)
    return [found[m] for m in range(len(members))]


def _widest(setting: Setting) -> int:
    """The most nodes that have sums at a time."""
    return 2 * setting.max_leaves if setting.growth == "leaf" else 1 << min(setting.max_depth, 14)


def _lots(found: dict[int, Ensemble], n_bins: int, n_features: int) -> Iterator[dict[int, Ensemble]]:
    """Members in lots whose sums a task may hold, numbered from 0 in each lot; forest members apart."""
    for forest in (False, True):
        lot, held = {}, 0
        for e in found.values():
            if e.member.setting.forest != forest:
                continue
            size = _widest(e.member.setting) * 3 * 8 * (n_features if e.member.setting.random_cuts else n_bins)
            if lot and held + size > DRIVER_BYTES:
                yield lot
                lot, held = {}, 0
            lot[len(lot)] = e
            held += size
        if lot:
            yield lot


def _resumed(e: Ensemble, member: Member) -> Ensemble:
    """An ensemble of the same model that may grow on."""
    if replace(e.member.setting, rounds=0, patience=None) != replace(member.setting, rounds=0, patience=None):
        raise ValueError("only the number of rounds and the patience may change")
    return Ensemble(member, e.base, list(e.trees), list(e.curve))


def _stopped(e: Ensemble) -> bool:
    patience = e.member.setting.patience
    return bool(patience) and best_round([p["held_loss"] for p in e.curve], patience)[1]


# ----------------------------------------------------------------------------- scores


def with_margins(df: DataFrame, bins: Bins, ensembles: Sequence[Ensemble], out: str = "margins", features: str = FEATURES, fold: str | None = None) -> DataFrame:
    """``df`` with the margins of all ensembles as one array, in one pass over the rows: no union, shuffle or join by id.

    With ``fold``, a row is scored only by the models that left out its fold; the others' margins are NaN."""
    spark = df.sparkSession
    sent = spark.sparkContext.broadcast((bins.cuts, [(e.base, e.kept(), e.member.fold) for e in ensembles]))  # members x rounds x leaves

    @F.pandas_udf("array<double>")
    def run(x: pd.Series, own: pd.Series) -> pd.Series:
        cuts, models = sent.value
        if not len(x):
            return pd.Series([], dtype=object)
        ids, own = np.ascontiguousarray(Bins(cuts).ids(np.stack(x.to_numpy())).T), own.to_numpy()
        parts = {f: ids if fold is None else np.ascontiguousarray(ids[:, own == f]) for f in {f for _, _, f in models}}
        margins = np.full((len(models), len(x)), np.nan)
        for m, (base, trees, left_out) in enumerate(models):
            z = np.full(parts[left_out].shape[1], base)
            for t in trees:
                z += t.value[walk(t, parts[left_out])]
            margins[m, ... if fold is None else own == left_out] = z
        return pd.Series(list(margins.T))

    return df.withColumn(out, run(vector_to_array(F.col(features)), F.lit(0) if fold is None else F.col(fold).cast("int")))


def probability(margin):
    """The probability of class 1."""
    return 1 / (1 + F.exp(-margin))


def own_fold(margins: str, fold: str, first: int = 0):
    """Out-of-fold probability: members ``first`` + 0, 1, ... left out the folds 0, 1, ..."""
    return probability(F.get(F.col(margins), F.col(fold) + F.lit(first)))


def mean_over_folds(margins: str, first: int, k: int):
    """The mean probability of k fold models."""
    total = F.aggregate(F.slice(F.col(margins), first + 1, k), F.lit(0.0), lambda a, z: a + probability(z))
    return total / k


# ----------------------------------------------------------------------------- weighted stumps


@dataclass(frozen=True)
class Stump:
    """One cut and the class said on either side of it."""

    feature: int
    cut: int
    low: int
    high: int


def _missed(stumps: Sequence[tuple[Stump, float]], ids: np.ndarray, y: np.ndarray) -> np.ndarray:
    """A row's weight: the product of exp(alpha) over the stumps that miss it."""
    total = np.zeros(len(y))
    for s, alpha in stumps:
        total += alpha * (np.where(ids[s.feature] > s.cut, s.high, s.low) != y)
    return np.exp(total)


def _weighted(stumps: Sequence[tuple[Stump, float]], starts: np.ndarray):
    """Weights of classes 0 and 1 by bin, from the stumps so far: rows keep no state between the rounds."""

    def run(blocks: Iterator[tuple]) -> Iterator[tuple]:
        total = np.zeros((2, int(starts[-1])))
        for ids, y, _, _ in blocks:
            w = _missed(stumps, ids, y)
            for f in range(len(ids)):
                low, high = starts[f], starts[f + 1]
                total[:, low:high] += np.bincount(y * (high - low) + (ids[f].astype(np.int64) - low), weights=w, minlength=2 * (high - low)).reshape(2, -1)
        yield 0, total

    return run


def best_stump(sums: np.ndarray, bins: Bins) -> tuple[Stump, float, float]:
    """The cut with the largest Gini decrease (class 1 on a side where it weighs more), the weight it misses, and all weight."""
    total = sums[:, : bins.starts[1]].sum(axis=1)
    gini = lambda t: 2 * t[0] * t[1] / np.maximum(t[0] + t[1], 1e-300)
    best, found = 1e-12 * total.sum(), None
    for f, (low, high) in enumerate(zip(bins.starts, bins.starts[1:])):
        left = np.cumsum(sums[:, low:high], axis=1)[:, :-1]
        if left.shape[1]:
            gain = gini(total) - gini(left) - gini(np.maximum(total[:, None] - left, 0))
            at = int(_first_best(gain[None])[0])
            if gain[at] > best * (1 + 1e-10):
                best, found = gain[at], (f, int(low) + at, left[:, at])
    if found is None:
        side = int(total[1] > total[0])
        return Stump(0, bins.count, side, side), float(total[1 - side]), float(total.sum())
    f, cut, left = found
    right = total - left
    low, high = int(left[1] > left[0]), int(right[1] > right[0])
    return Stump(f, cut, low, high), float(left[1 - low] + right[1 - high]), float(total.sum())


def weighted_stumps(data: Binned, rounds: int, learning_rate: float = 1.0) -> list[tuple[Stump, float]]:
    """H7: SAMME over stumps, one job a round: a row's weight follows from its label and the stumps so far."""
    spark = data.blocks.sparkSession
    kind, n_features, n_folds, starts = np.uint16 if data.bins.count < 65_536 else np.uint32, data.n_features, data.n_folds, data.bins.starts
    n = data.blocks.agg(F.sum("n")).first()[0]
    source, parts = data.blocks.rdd, max(math.ceil(n / SPREAD_ROWS), min(spark.sparkContext.defaultParallelism, fit_partitions(spark, n)))
    source = source.coalesce(parts) if parts < source.getNumPartitions() else source
    rows = source.map(lambda r: _block(r, kind, n_features, n_folds)).mapPartitions(_joined).persist(StorageLevel.MEMORY_AND_DISK)
    stumps: list[tuple[Stump, float]] = []
    for _ in range(rounds):
        sums = rows.mapPartitions(_weighted(stumps, starts)).values().treeReduce(lambda a, b: a + b)
        stump, miss, whole = best_stump(sums, data.bins)
        err = miss / whole if whole else 0.0
        if err >= 0.5:
            break
        if err <= 0.0:
            stumps.append((stump, 1.0))
            break
        stumps.append((stump, learning_rate * math.log((1.0 - err) / err)))
    rows.unpersist()
    return stumps


# ----------------------------------------------------------------------------- settings


def boosted_hist(rounds: int = 300, step: float = 0.03, max_leaves: int = 31, min_leaf: int = 20, l2: float = 0.0, seed: int = 42) -> Setting:
    """H8: leaf-wise histogram boosting."""
    return Setting(rounds, step, "leaf", max_leaves, min_leaf=min_leaf, l2=l2, seed=seed)


def gradient_boosting(rounds: int = 100, step: float = 0.1, max_depth: int = 3, min_split: int = 2, seed: int = 42) -> Setting:
    """H6 over bins: trees of a fixed depth."""
    return Setting(rounds, step, "depth", max_depth=max_depth, min_leaf=1, min_split=min_split, seed=seed)


def random_cut_forest(trees: int = 200, max_depth: int = 10, min_leaf: int = 1, seed: int = 42) -> list[Member]:
    """H5: extremely randomised trees over all rows; cuts are drawn, not searched. One round from the base margin has constant
    hessians, so its gain is the Gini decrease but for a factor, and its leaf values say the leaf's share of class 1."""
    return [Member(Setting(1, 1.0, "depth", max_depth=max_depth, min_leaf=min_leaf, min_hessian=0.0, seed=seed + t, random_cuts=True)) for t in range(trees)]


def random_forest(trees: int = 100, max_depth: int = 10, min_leaf: int = 1, seed: int = 42, fold: int | None = None) -> list[Member]:
    """H4: trees over rows drawn with replacement; a node looks at sqrt(features) drawn features and takes the best cut."""
    return [Member(Setting(1, 1.0, "depth", max_depth=max_depth, min_leaf=min_leaf, min_hessian=0.0, seed=seed + t, random_features=True, bootstrap=True), fold) for t in range(trees)]


def forest_scored(df: DataFrame, bins: Bins, trees: Sequence[Ensemble], keep: Sequence[str], out: str = "p") -> DataFrame:
    """The mean over the trees of the share of class 1 in a row's leaf, beside the kept columns."""
    base, n = trees[0].base, len(trees)
    share = 1 / (1 + math.exp(-base))
    mean = F.aggregate("_margins", F.lit(0.0), lambda a, z: a + z) / n
    p = F.lit(share) + (mean - F.lit(base)) * F.lit(share * (1 - share))
    return with_margins(df, bins, trees, "_margins").select(*keep, F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0)).alias(out))


def boosted_profile(profile: str, rounds: int = 1500, step: float = 0.03, patience: int | None = 50, seed: int = 42) -> Setting:
    """A grows leaf by leaf, b by depth with an l2 term, c symmetric trees."""
    made = {
        "a": Setting(growth="leaf", max_leaves=31, min_leaf=20),
        "b": Setting(growth="depth", max_depth=5, min_leaf=1, min_hessian=1.0, l2=1.0),
        "c": Setting(growth="symmetric", max_depth=6, min_leaf=1, l2=3.0),
    }[profile]
    return replace(made, rounds=rounds, step=step, patience=patience, seed=seed)


def scored(df: DataFrame, bins: Bins, ensemble: Ensemble, keep: Sequence[str], out: str = "p") -> DataFrame:
    """The probability of class 1 beside the kept columns."""
    return with_margins(df, bins, [ensemble], "_margin").select(*keep, probability(F.get("_margin", F.lit(0))).alias(out))
