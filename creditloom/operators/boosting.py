"""Boosted trees grown by histograms, many models at once on one coded table.

Columns are coded once: numbers to quantile bins (0 is missing), categories to
numbers. Rows lie in blocks of code matrices with the role each row has for a
model: unused, learned from or held out. Folds and trials differ in roles and
settings only, so all of them share the blocks, and one pass over the blocks
serves the next level of the current tree of every model.

A pass adds up gradients, Hessians and rows per open node, feature and bin;
each task adds up all its blocks first, and only these sums leave it. The
driver receives the best split of every open node, extends the trees and decides
about patience. A model's margins are carried in the state: the trees grown
since the state was written are applied on top, and after ``CARRY`` of them the
state is written anew, so the work of a round does not grow with the rounds
before it.

Up to ``WHOLE_ROWS`` rows, or ``SHARED_ROWS`` where the models keep the cores
busy, every model is a task of its own, which reads all blocks and grows all its
trees: sums are complete in the task, no model waits for another, and of two
children only the smaller is summed, the other is what remains of their parent.
The task holds its rows' codes once, in a byte each where no column has more
than 256, and at most ``WHOLE_BYTES`` of them. Nodes of many rows are summed column by column; columns
of few codes are joined to one, whose sums are then added up for each of them.

Gradients are rounded to multiples of 2^-20 and the values of leaves to
2^-30, which makes all sums exact and the trees independent of how rows are dealt
to tasks and of how often growing was interrupted.
"""

from __future__ import annotations

import math
import pickle
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
UNUSED, LEARNED, HELD = 0, 1, 2
GRID, VALUE_GRID = float(1 << 20), float(1 << 30)
BLOCK_ROWS = 32_768
WHOLE_ROWS = 1 << 20
SHARED_ROWS = 1 << 22
WHOLE_BYTES = 384 << 20
READ_BLOCKS = 8
CHUNK_ROWS = 4096
WIDE_ROWS = 16_384
JOINED_CODES = 1024
DRIVER_SUMS = 32 << 20
CARRY = 8
MAX_CATEGORIES = 60_000
LEAST_HESSIAN = 1e-3


@dataclass(frozen=True)
class Settings:
    """What a model is grown with; ``leaves`` bounds a tree beside its depth, the best splits of a level coming first."""

    rounds: int = 100
    depth: int = 6
    rate: float = 0.1
    leaves: int = 1 << 30
    l1: float = 0.0
    l2: float = 0.0
    min_gain: float = 0.0
    min_rows: int = 1
    row_share: float = 1.0
    row_every: int = 1
    feature_share: float = 1.0
    bins: int = 255
    patience: int = 0
    positive_weight: float = 1.0
    seed: int = 42


@dataclass(frozen=True)
class Quantizer:
    """How columns become codes: cuts of numbers, values of categories, positions of ordered values."""

    cuts: dict[str, list[float]]
    values: dict[str, list[str | None]]
    ordered: dict[str, list[str]] = field(default_factory=dict)
    null_as: str | None = None

    @property
    def features(self) -> list[str]:
        return [*self.cuts, *self.ordered, *self.values]

    @property
    def sizes(self) -> np.ndarray:
        """Codes of every feature; numbers have one for missing, categories one for values not seen."""
        return np.array([len(c) + 2 for c in self.cuts.values()] + [len(v) + 1 for v in self.ordered.values()]
                        + [len(v) + 1 for v in self.values.values()], np.int64)

    @property
    def categorical(self) -> np.ndarray:
        return np.array([False] * (len(self.cuts) + len(self.ordered)) + [True] * len(self.values), bool)

    def codes(self, batch: pa.RecordBatch) -> np.ndarray:
        """The code matrix of a batch that has all features by name."""
        out = np.empty((batch.num_rows, len(self.features)), np.uint16)
        for i, (name, cuts) in enumerate(self.cuts.items()):
            x = pc.cast(batch.column(name), pa.float64(), safe=False).to_numpy(zero_copy_only=False)
            out[:, i] = np.where(np.isnan(x), 0, np.searchsorted(np.array(cuts), x) + 1)
        for i, (name, values) in enumerate(self.ordered.items(), len(self.cuts)):
            found = pc.index_in(batch.column(name), value_set=pa.array(values, pa.string()))
            if found.null_count:
                at = pc.index(pc.is_null(found), True).as_py()
                raise ValueError(f"unknown category in {name}: {batch.column(name)[at].as_py()}")
            out[:, i] = found.to_numpy(zero_copy_only=False) + 1
        for i, (name, values) in enumerate(self.values.items(), len(self.cuts) + len(self.ordered)):
            column = batch.column(name)
            if self.null_as is not None:
                column = column.fill_null(self.null_as)
            found = pc.index_in(column, value_set=pa.array(values, pa.string()))
            out[:, i] = found.fill_null(len(values)).to_numpy(zero_copy_only=False)
        return out


def fit_quantizer(df: DataFrame, numbers: list[str], categories: list[str], ordered: dict[str, tuple[str, ...]] | None = None,
                  bins: int = 255, null_as: str | None = None) -> Quantizer:
    """Quantile cuts of all numbers from one sketch, and the values of all categories from one aggregate."""
    cuts = {}
    if numbers:
        doubles = df.select(*[F.expr(f"nanvl(CAST(`{c}` AS DOUBLE), NULL)").alias(c) for c in numbers])
        found = doubles.approxQuantile(numbers, [i / bins for i in range(1, bins)], 1 / (4 * bins))
        highest = doubles.agg(*[F.max(c).alias(c) for c in numbers]).first()
        cuts = {c: sorted({q for q in qs if q < highest[c]}) for c, qs in zip(numbers, found)}
    values: dict[str, list[str | None]] = {}
    if categories:
        filled = df.select(*[F.coalesce(F.col(c), F.lit(null_as)).alias(c) if null_as is not None else F.col(c) for c in categories])
        found = filled.unpivot([], categories, "name", "value").distinct()
        counts = {r["name"]: r["n"] for r in found.groupBy("name").agg(F.count("*").alias("n")).collect()}
        if wide := {c: n for c, n in counts.items() if n > MAX_CATEGORIES}:
            raise ValueError(f"more than {MAX_CATEGORIES} categories: {wide}")
        values = {c: [] for c in categories}
        for r in found.collect():  # at most MAX_CATEGORIES per column
            values[r["name"]].append(r["value"])
        values = {c: sorted(v, key=lambda x: (x is not None, x or "")) for c, v in values.items()}
    return Quantizer(cuts, values, {c: list(v) for c, v in (ordered or {}).items()}, null_as)


@dataclass
class Tree:
    """Nodes by number; a leaf has feature -1. Numbers go left up to ``threshold``, categories where ``left_codes`` says so."""

    feature: list[int] = field(default_factory=lambda: [-1])
    threshold: list[int] = field(default_factory=lambda: [0])
    missing_left: list[bool] = field(default_factory=lambda: [False])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    cover: list[float] = field(default_factory=lambda: [0.0])
    left_codes: dict[int, np.ndarray] = field(default_factory=dict)

    def add_leaf(self, value: float, cover: float) -> int:
        for column, x in ((self.feature, -1), (self.threshold, 0), (self.missing_left, False), (self.left, 0), (self.right, 0),
                          (self.value, value), (self.cover, cover)):
            column.append(x)
        return len(self.feature) - 1

    def goes_left(self, node: np.ndarray, code: np.ndarray) -> np.ndarray:
        """For rows at inner nodes, from their code of the node's feature."""
        return self._steps()(node, code)

    def _steps(self) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
        """Whether rows at inner nodes go left, looked up in one table: per node its codes, the last standing for all above."""
        parts = [self.left_codes[n] if n in self.left_codes else [self.missing_left[n], *[True] * self.threshold[n], False] if f >= 0 else [False]
                 for n, f in enumerate(self.feature)]
        sizes = np.array([len(p) for p in parts])
        table, first = np.concatenate(parts).astype(bool), _offsets(sizes)
        return lambda node, code: table[first[node] + np.minimum(code, sizes[node] - 1)]

    def leaves(self, codes: np.ndarray) -> np.ndarray:
        """The node every row ends in."""
        node = np.zeros(len(codes), np.int64)
        feature, left, right = np.array(self.feature), np.array(self.left), np.array(self.right)
        rows, goes_left = np.arange(len(codes)), self._steps()
        while True:
            rows = rows[feature[node[rows]] >= 0]
            if not len(rows):
                return node
            at = node[rows]
            node[rows] = np.where(goes_left(at, codes[rows, feature[at]]), left[at], right[at])

    def facts(self) -> dict:
        """As plain values; categories as the codes that go left."""
        plain = {k: getattr(self, k) for k in ("feature", "threshold", "missing_left", "left", "right", "value", "cover")}
        return plain | {"left_codes": {str(n): [len(c), np.flatnonzero(c).tolist()] for n, c in self.left_codes.items()}}

    @staticmethod
    def of(facts: dict) -> Tree:
        tree = Tree(**{k: v for k, v in facts.items() if k != "left_codes"})
        for n, (size, codes) in facts["left_codes"].items():
            tree.left_codes[int(n)] = np.isin(np.arange(size), codes)
        return tree


@dataclass
class Model:
    """A fitted or growing model: the start margin, its trees and what its holdout has said after each of them.

    ``features`` are the numbers of the columns it may split on, all if not given. ``encode`` names the categories that are
    ordered by their smoothed label mean (smoothing and least count) over the model's own rows; others are ordered by
    gradient at every node.
    """

    role: int
    settings: Settings
    features: np.ndarray | None = None
    encode: dict[str, tuple[float, float]] = field(default_factory=dict)
    base: float = 0.0
    trees: list[Tree] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)
    #: Category codes of every encoded feature in ascending order of their encoded value.
    orders: dict[int, np.ndarray] = field(default_factory=dict)

    def margins(self, codes: np.ndarray) -> np.ndarray:
        total = np.full(len(codes), self.base)
        for tree in self.trees:
            total += np.array(tree.value)[tree.leaves(codes)]
        return total

    def best_rounds(self) -> int:
        """Rounds of least holdout loss, the first of several; all rounds without a holdout."""
        return int(np.argmin(self.losses)) + 1 if self.losses else len(self.trees)

    def best(self) -> Model:
        """The model of the best round."""
        rounds = self.best_rounds()
        return replace(self, trees=self.trees[:rounds], losses=self.losses[:rounds])


def coded_blocks(df: DataFrame, quantizer: Quantizer, label: str, key: str, roles: list[str], rows: int | None = None) -> DataFrame:
    """``block, n, codes, labels, hashes, roles``: numbered blocks of about ``BLOCK_ROWS`` rows as matrices; written once.

    Rows without a label are left out. ``roles`` are columns of ``UNUSED``, ``LEARNED`` or ``HELD``.
    """
    rows = df.where(F.col(label).isNotNull())
    parts = max(1, math.ceil(rows.count() / BLOCK_ROWS))
    features = dict.fromkeys(quantizer.features)
    hashed = F.xxhash64(F.col(key)).alias("__hash")
    chosen = rows.select(*features, F.col(label).cast("byte").alias("__label"), hashed,
                         *[F.col(r).cast("byte").alias(f"__role{i}") for i, r in enumerate(roles)])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        block_number = TaskContext.get().partitionId()

        def block() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            order = np.argsort(table.column("__hash").to_numpy(), kind="stable")
            [batch] = table.take(order).combine_chunks().to_batches()
            numbers = [np.asarray(batch.column(f"__role{i}")).astype(np.uint8) for i in range(len(roles))]
            columns = [quantizer.codes(batch), np.asarray(batch.column("__label")).astype(np.uint8),
                       np.asarray(batch.column("__hash")).astype(np.int64), np.stack(numbers, 1)]
            return pa.RecordBatch.from_arrays(
                [pa.array([block_number], pa.int32()), pa.array([batch.num_rows], pa.int32()), *[pa.array([c.tobytes()], pa.binary()) for c in columns]],
                names=["block", "n", "codes", "labels", "hashes", "roles"])

        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                held.append(batch.slice(at, BLOCK_ROWS))
                if sum(b.num_rows for b in held) >= BLOCK_ROWS:
                    yield block()
                    held, block_number = [], block_number + parts
        if held:
            yield block()

    dealt = chosen.repartition(parts, "__hash")
    return written(dealt.mapInArrow(blocks, "block int, n int, codes binary, labels binary, hashes binary, roles binary"), "blocks")


def _sampled(hashes: np.ndarray, share: float, seed: int, number: int) -> np.ndarray:
    """Rows of a round, chosen by a scramble of their key's hash."""
    x = hashes.view(np.uint64) + np.uint64(((seed << 20) + number + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) < share * float(1 << 53)


@dataclass
class Request:
    """What one model wants from a pass: splits at the open nodes of its growing tree, and the loss of its holdout."""

    number: int
    model: Model  # trees: those the state's margins do not hold yet
    growth: Growth
    features: np.ndarray
    round: int
    loss: bool
    statistics: bool = False


def _offsets(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes) - sizes


def _gradients(labels: np.ndarray, margin: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Gradients and Hessians on their grid."""
    weight = np.where(labels == 1, settings.positive_weight, 1.0)
    p = 1 / (1 + np.exp(-margin))
    return np.rint(weight * (p - labels) * GRID), np.rint(weight * p * (1 - p) * GRID)


def _loss(labels: np.ndarray, margin: np.ndarray, settings: Settings) -> np.ndarray:
    """Sum of the losses of held-out rows on their grid, and their number."""
    y = labels.astype(np.float64)
    losses = np.where(labels == 1, settings.positive_weight, 1.0) * (np.logaddexp(0.0, margin) - y * margin)
    return np.array([np.rint(losses * GRID).sum(), len(y)])


def _node_sums(codes: np.ndarray, rows: np.ndarray, g: np.ndarray, h: np.ndarray, offsets: np.ndarray, width: int) -> np.ndarray:
    """Gradients, Hessians and numbers of a node's rows per feature and code; ``codes`` has the chosen features only.

    Hessians are whole numbers: a row counts in their lower digits as long as doubles hold both.
    """
    total = np.zeros((3, width))
    digits = max(1, len(rows).bit_length())
    joined = len(rows) > 0 and float(h[rows].sum()) * (1 << digits) < 1 << 52
    for at in range(0, len(rows), CHUNK_ROWS):
        some = rows[at:at + CHUNK_ROWS]
        cells = (codes[some] + offsets).ravel()
        spread = (len(some), codes.shape[1])

        def added(x: np.ndarray) -> np.ndarray:
            return np.bincount(cells, np.broadcast_to(x[:, None], spread).ravel(), width)

        total[0] += added(g[some])
        if joined:
            both = added(h[some] * (1 << digits) + 1).astype(np.int64)
            total[1] += both >> digits
            total[2] += both & (1 << digits) - 1
        else:
            total[1] += added(h[some])
            total[2] += np.bincount(cells, minlength=width)
    return total


def _add_block(sums: dict, request: Request, codes: np.ndarray, labels: np.ndarray, hashes: np.ndarray, role: np.ndarray,
               margin: np.ndarray, sizes: np.ndarray) -> None:
    """Add one block's sums per node, feature and code, and its holdout loss, to those of the task."""
    settings, tree, nodes = request.model.settings, request.growth.tree, request.growth.nodes
    if request.loss:
        held = role == HELD
        sums[request.number, -1] = sums.get((request.number, -1), 0) + _loss(labels[held], margin[held], settings)
    if not nodes:
        return
    learned = role == LEARNED
    if not request.statistics and settings.row_share < 1:
        learned &= _sampled(hashes, settings.row_share, settings.seed, request.round // settings.row_every)
    place = np.full(len(tree.feature), -1)
    place[nodes] = np.arange(len(nodes))
    at = np.where(learned, place[tree.leaves(codes)], -1)
    by_node = np.argsort(at.astype(np.int16) if len(nodes) < 1 << 15 else at, kind="stable")
    ends = np.cumsum(np.bincount(at + 1, minlength=len(nodes) + 1))
    g, h = (labels.astype(np.float64), np.ones(len(labels))) if request.statistics else _gradients(labels, margin, settings)
    chosen = sizes[request.features]
    some = codes[:, request.features] if len(request.features) < codes.shape[1] else codes
    for i, node in enumerate(nodes):
        found = _node_sums(some, by_node[ends[i]:ends[i + 1]], g, h, _offsets(chosen), int(chosen.sum()))
        sums[request.number, node] = sums.get((request.number, node), 0) + found


@dataclass(frozen=True)
class _Joined:
    """Columns of few codes as one: its codes per row, the columns and how many codes each of them has."""

    codes: np.ndarray
    features: list[int]
    sizes: list[int]


def _joined_columns(codes: np.ndarray, sizes: np.ndarray, features: np.ndarray) -> list[_Joined]:
    """All columns, joined in ascending order of their codes as long as there are no more than ``JOINED_CODES`` together."""
    groups: list[list[int]] = []
    for f in sorted(features.tolist(), key=lambda f: int(sizes[f])):
        if groups and math.prod(int(sizes[x]) for x in groups[-1]) * int(sizes[f]) <= JOINED_CODES:
            groups[-1].append(f)
        else:
            groups.append([f])
    found = []
    for group in groups:
        joined = codes[:, group[0]]
        for f in group[1:]:
            joined = joined * np.uint16(sizes[f]) + codes[:, f]
        found.append(_Joined(joined, group, [int(sizes[f]) for f in group]))
    return found


def _wide_sums(joined: list[_Joined], rows: np.ndarray, g: np.ndarray, h: np.ndarray, features: np.ndarray, offsets: np.ndarray,
               width: int) -> np.ndarray:
    """What :func:`_node_sums` gives for the chosen features, column by column."""
    start = dict(zip(features.tolist(), offsets.tolist()))
    joined = [one for one in joined if not start.keys().isdisjoint(one.features)]
    totals = [np.zeros((3, math.prod(one.sizes))) for one in joined]
    digits = WIDE_ROWS.bit_length()
    for at in range(0, len(rows), WIDE_ROWS):
        some = rows[at:at + WIDE_ROWS]
        some_g, some_h = g[some], h[some]
        fits = float(some_h.sum()) * (1 << digits) < 1 << 52
        both = some_h * (1 << digits) + 1 if fits else some_h
        for one, total in zip(joined, totals):
            cells, size = one.codes[some].astype(np.intp), total.shape[1]
            total[0] += np.bincount(cells, some_g, size)
            found = np.bincount(cells, both, size)
            if fits:
                found = found.astype(np.int64)
                total[1] += found >> digits
                total[2] += found & (1 << digits) - 1
            else:
                total[1] += found
                total[2] += np.bincount(cells, minlength=size)
    out = np.empty((3, width))
    for one, total in zip(joined, totals):
        cube = total.reshape(3, *one.sizes)
        for i, f in enumerate(one.features):
            if f in start:
                others = tuple(k + 1 for k in range(len(one.sizes)) if k != i)
                out[:, start[f]:start[f] + one.sizes[i]] = cube.sum(others)
    return out


def _whole_tree(growth: Growth, request: Request, codes: np.ndarray, joined: list[_Joined], rows: np.ndarray, g: np.ndarray, h: np.ndarray,
                sizes: np.ndarray, categorical: np.ndarray, margin: np.ndarray) -> None:
    """Extend a tree to its end in the task that holds all rows, and add its values to their margins; the rows and sums of open
    nodes are kept between levels."""
    tree, features = growth.tree, request.features
    others = np.ones(len(margin), bool)
    others[rows] = False
    ended = []
    offsets, width = _offsets(sizes[features]), int(sizes[features].sum())

    def summed(rows: np.ndarray) -> np.ndarray:
        if joined and len(rows) >= WIDE_ROWS:
            return _wide_sums(joined, rows, g, h, features, offsets, width)
        some = codes[rows]
        return _node_sums(some if len(features) == codes.shape[1] else some[:, features], np.arange(len(rows)), g[rows], h[rows], offsets, width)

    held = {0: (rows, summed(rows))}
    while growth.nodes:
        growth.extend({n: best_split(sums, request, sizes, categorical) for n, (_, sums) in held.items()}, request.model.settings)
        following, wanted = {}, set(growth.nodes)
        for node, (rows, sums) in held.items():
            if tree.feature[node] < 0:
                ended.append((node, rows))
                continue
            children = (tree.left[node], tree.right[node])
            code = codes[rows, tree.feature[node]]
            if node in tree.left_codes:
                left = tree.left_codes[node][code]
            else:
                left = np.where(code == 0, tree.missing_left[node], code <= tree.threshold[node])
            parts = [rows[left], rows[~left]]
            small = int(len(parts[1]) < len(parts[0]))
            one = None if wanted.isdisjoint(children) else summed(parts[small])
            for k, child in enumerate(children):
                if child in wanted:
                    following[child] = (parts[k], one if k == small else sums - one)
                else:
                    ended.append((child, parts[k]))
        held = following
    for node, rows in [*ended, *((node, rows) for node, (rows, _) in held.items())]:
        margin[rows] += tree.value[node]
    rest = np.flatnonzero(others)
    margin[rest] += np.array(tree.value)[tree.leaves(codes[rest])]


def _gain(g: np.ndarray, h: np.ndarray, s: Settings) -> np.ndarray:
    """The score of a node: what its best value takes off the loss, twice."""
    reduced = np.maximum(np.abs(g) - s.l1, 0.0) if s.l1 else g
    return reduced * reduced / (h + s.l2 + 1e-300)


def leaf_value(g: float, h: float, s: Settings) -> float:
    value = -math.copysign(max(abs(g) - s.l1, 0.0), g) / (h + s.l2) * s.rate if h + s.l2 > 0 else 0.0
    return round(value * VALUE_GRID) / VALUE_GRID


def best_split(sums: np.ndarray, request: Request, sizes: np.ndarray, categorical: np.ndarray) -> dict:
    """The best split of one node from its sums of gradients, Hessians and rows; without ``feature`` if none gains enough."""
    s, chosen = request.model.settings, sizes[request.features]
    starts = _offsets(chosen)
    first = slice(0, int(chosen[0]))
    total = (float(sums[0][first].sum()) / GRID, float(sums[1][first].sum()) / GRID, float(sums[2][first].sum()))
    out, least = {"total": total}, max(s.min_rows, 1)
    if total[2] < 2 * least:
        return out
    order = np.arange(sums.shape[1])
    full, held = starts, sums[2] > 0
    held[starts] = True
    for i in np.flatnonzero(categorical[request.features]).tolist():
        f, segment = int(request.features[i]), slice(int(starts[i]), int(starts[i] + chosen[i]))
        inside = request.model.orders.get(f)
        if inside is None:
            inside = np.argsort(sums[0][segment] / (sums[1][segment] + GRID), kind="stable")
        order[segment] = starts[i] + inside
        held[segment] = True
    # A cut behind an empty bin is that before it: bins of numbers without rows are left out of the scan.
    order = order[held]
    chosen = np.add.reduceat(held, starts, dtype=np.int64)
    starts = _offsets(chosen)
    here = sums[:, order]
    here[:2] /= GRID
    upto = np.cumsum(here, 1)
    upto -= np.repeat(upto[:, starts] - here[:, starts], chosen, 1)
    number = ~categorical[request.features]
    missing = np.where(number, here[:, starts], 0.0)
    feature_of = np.repeat(np.arange(len(chosen)), chosen)
    inner = np.ones(len(order), bool)
    inner[starts + chosen - 1] = False
    own = _gain(np.array(total[0]), np.array(total[1]), s)
    best = None
    for missing_left in (True, False):
        if missing_left:
            places = np.flatnonzero(inner & (upto[2] >= least) & (upto[2] <= total[2] - least))
            left = upto[:, places]
        else:  # another cut only where numbers are missing
            places = np.flatnonzero(inner & (missing[2] > 0)[feature_of])
            left = upto[:, places] - missing[:, feature_of[places]]
            able = (left[2] >= least) & (left[2] <= total[2] - least)
            places, left = places[able], left[:, able]
        gl, hl, _ = left
        gr, hr = total[0] - gl, total[1] - hl
        able = (hl >= LEAST_HESSIAN) & (hr >= LEAST_HESSIAN)
        if not able.any():
            continue
        gains = np.where(able, _gain(gl, hl, s) + _gain(gr, hr, s) - own, -np.inf)
        at = int(np.argmax(gains))
        if gains[at] > max(s.min_gain, 1e-9) and (best is None or gains[at] > best[0]):
            best = (float(gains[at]), int(places[at]), missing_left, tuple(map(float, left[:, at])))
    if best is None:
        return out
    gain, at, missing_left, one = best
    i = int(feature_of[at])
    out |= {"gain": gain, "feature": int(request.features[i]), "threshold": int(order[at] - full[i]), "missing_left": missing_left, "left": one}
    if categorical[request.features[i]]:
        codes = np.zeros(int(chosen[i]), bool)
        codes[order[starts[i]:at + 1] - full[i]] = True
        out["left_codes"] = codes
    return out


@dataclass
class Growth:
    """A tree that is growing: its open nodes, levels and leaves so far."""

    tree: Tree = field(default_factory=Tree)
    nodes: list[int] = field(default_factory=lambda: [0])
    depth: int = 0
    leaves: int = 1

    def extend(self, splits: dict[int, dict], s: Settings) -> None:
        """Split the open nodes, best gains first, and open their children."""
        tree = self.tree
        if tree.feature == [-1] and 0 in splits:
            g, h, n = splits[0]["total"]
            tree.value[0], tree.cover[0] = leaf_value(g, h, s), n
        following = []
        for node, split in sorted(((n, x) for n, x in splits.items() if "feature" in x), key=lambda x: (-x[1]["gain"], x[0])):
            if self.leaves >= s.leaves:
                break
            self.leaves += 1
            total, left = split["total"], split["left"]
            right = tuple(a - b for a, b in zip(total, left))
            children = [tree.add_leaf(leaf_value(g, h, s), n) for g, h, n in (left, right)]
            tree.feature[node], tree.threshold[node], tree.missing_left[node] = split["feature"], split["threshold"], split["missing_left"]
            tree.left[node], tree.right[node] = children
            if "left_codes" in split:
                tree.left_codes[node] = split["left_codes"]
            following += [c for c in children if tree.cover[c] >= 2 * max(s.min_rows, 1)]
        self.depth += 1
        self.nodes = following if self.depth < s.depth and self.leaves < s.leaves else []


def _run_pass(state: DataFrame, parts: int, requests: list[list[Request]], sizes: np.ndarray, categorical: np.ndarray) -> dict:
    """Answers of one pass by (model, node): a split, the holdout's loss (node -1), or plain sums of statistics.

    The sums of the ``parts`` tasks are added up by a shuffle, or on the driver where they
    are no more than ``DRIVER_SUMS`` bytes whatever the number of rows.
    """
    by_number = {r.number: r for group in requests for r in group}
    groups = len(requests)

    def answer(number: int, node: int, contents: list[bytes]) -> object:
        request = by_number[number]
        total = sum(np.frombuffer(c, np.float64) for c in contents)
        if node < 0:
            return total
        total = total.reshape(3, -1)
        return total if request.statistics else best_split(total, request, sizes, categorical)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                group, _, n, codes, labels, hashes, roles, margins = (_plain(c[row]) for c in batch.columns)
                codes = np.frombuffer(codes, np.uint16).reshape(n, -1)
                labels, hashes = np.frombuffer(labels, np.uint8), np.frombuffer(hashes, np.int64)
                roles = np.frombuffer(roles, np.uint8).reshape(n, -1)
                margins = np.frombuffer(margins, np.float64).reshape(n, -1) if margins is not None else None
                for request in requests[group]:
                    model = request.model
                    own = replace(model, base=model.base if margins is None else 0.0)
                    margin = own.margins(codes) if not request.statistics else np.zeros(n)
                    if margins is not None:
                        margin = margin + margins[:, _column(request.number, groups)]
                    _add_block(sums, request, codes, labels, hashes, roles[:, model.role], margin, sizes)
        keys = list(sums)
        yield pa.RecordBatch.from_arrays([pa.array([m for m, _ in keys], pa.int32()), pa.array([n for _, n in keys], pa.int32()),
                                          pa.array([sums[k].tobytes() for k in keys], pa.binary())], names=["model", "node", "content"])

    def combine(key: tuple, table: pa.Table) -> pa.Table:
        number, node = key[0].as_py(), key[1].as_py()
        found = answer(number, node, table.column("content").to_pylist())
        return pa.table({"model": pa.array([number], pa.int32()), "node": pa.array([node], pa.int32()),
                         "content": pa.array([pickle.dumps(found)], pa.binary())})

    schema = "model int, node int, content binary"
    found = state.mapInArrow(add, schema)
    cells = sum(len(r.growth.nodes) * int(sizes[r.features].sum()) for r in by_number.values())
    if 24 * cells * math.ceil(parts / groups) <= DRIVER_SUMS:
        contents: dict[tuple[int, int], list[bytes]] = {}
        for m, n, c in zip(*(x.to_pylist() for x in found.toArrow().columns)):
            contents.setdefault((m, n), []).append(c)
        return {key: answer(*key, c) for key, c in contents.items()}
    table = found.groupBy("model", "node").applyInArrow(combine, schema).toArrow()
    return {(m, n): pickle.loads(c) for m, n, c in zip(*(table.column(i).to_pylist() for i in range(3)))}


def _plain(x: pa.Scalar) -> int | pa.Buffer | None:
    """A number, or the bytes of a binary value without a copy."""
    return x.as_buffer() if isinstance(x, pa.BinaryScalar) else x.as_py()


def _column(number: int, groups: int) -> int:
    """Models are dealt to groups in turn; this is a model's column in its group's margins."""
    return number // groups


class _Grower:
    """The driver's side of one model: its current tree and patience."""

    def __init__(self, number: int, model: Model, sizes: np.ndarray) -> None:
        self.number, self.model = number, model
        self.able = np.arange(len(sizes)) if model.features is None else model.features
        self.carried = 0  # trees whose values the state's margins hold
        self.done = False
        self._start()

    def _start(self) -> None:
        """Open the next tree, or only ask for the last loss where no round is left."""
        s = self.model.settings
        self.round = len(self.model.trees)
        full = self.round >= s.rounds
        if full and not s.patience:
            self.done = True
        self.growth = Growth(nodes=[] if full else [0])
        share = max(1, math.ceil(s.feature_share * len(self.able)))
        rng = np.random.Generator(np.random.Philox(key=[s.seed, self.round]))
        self.features = np.sort(rng.permutation(self.able)[:share])
        self.asks_loss = s.patience > 0 and self.round > len(self.model.losses)

    def request(self) -> Request:
        recent = replace(self.model, trees=self.model.trees[self.carried:], losses=[])
        return Request(self.number, recent, self.growth, self.features, self.round, self.asks_loss)

    def judge(self, answers: dict) -> None:
        """Take the holdout's loss and end the model where its patience is over."""
        if self.asks_loss:
            total, held = answers.get((self.number, -1), (0.0, 0))
            self.asks_loss = False
            if held:
                self.model.losses.append(float(total / GRID / held))
                if self.round - self.model.best_rounds() >= self.model.settings.patience:
                    self.done = True
        if not self.growth.nodes:
            self.done = True

    def take(self, answers: dict) -> None:
        """Judge the holdout's loss, then split the open nodes."""
        self.judge(answers)
        if not self.done:
            self.growth.extend({n: answers[self.number, n] for n in self.growth.nodes if (self.number, n) in answers}, self.model.settings)
            if not self.growth.nodes:
                self.finish()

    def finish(self) -> None:
        """Keep the tree that has grown to its end."""
        self.model.trees.append(self.growth.tree)
        self._start()


def _start_values(model: Model, sums: np.ndarray, encoded: list[str], quantizer: Quantizer) -> None:
    """A model's start margin, and the order of its encoded categories, from the label's sums over its learned rows."""
    sizes, names = quantizer.sizes, quantizer.features
    wanted = _wanted(encoded, quantizer)
    starts = _offsets(sizes[wanted])
    first = slice(0, int(sizes[wanted[0]]))
    ones, rows = float(sums[0][first].sum()), float(sums[2][first].sum())
    positive = model.settings.positive_weight * ones
    rate = min(max(positive / max(positive + rows - ones, 1.0), 1e-6), 1 - 1e-6)
    model.base = round(math.log(rate / (1 - rate)) * VALUE_GRID) / VALUE_GRID
    prior = ones / max(rows, 1.0)
    for i, name in enumerate(encoded):
        if name not in model.encode:
            continue
        smoothing, least = model.encode[name]
        segment = slice(int(starts[i]), int(starts[i] + sizes[wanted[i]]))
        y, n = sums[0][segment], sums[2][segment]
        weight = np.where(n > 0, 1 / (1 + np.exp(-(n - least) / smoothing)), 0.0)
        model.orders[names.index(name)] = np.argsort(prior * (1 - weight) + y / np.maximum(n, 1) * weight, kind="stable")


def _wanted(encoded: list[str], quantizer: Quantizer) -> np.ndarray:
    """The numbers of encoded columns; of the first column without any, as all rows are counted in one."""
    return np.array([quantizer.features.index(c) for c in encoded] or [0])


def _statistics(state: DataFrame, parts: int, models: list[Model], groups: int, quantizer: Quantizer) -> None:
    """Start values of all models."""
    encoded = list(dict.fromkeys(c for m in models for c in m.encode))
    requests: list[list[Request]] = [[] for _ in range(groups)]
    for number, model in enumerate(models):
        requests[number % groups].append(Request(number, model, Growth(), _wanted(encoded, quantizer), 0, False, statistics=True))
    answers = _run_pass(state, parts, requests, quantizer.sizes, quantizer.categorical)
    for number, model in enumerate(models):
        if (number, 0) in answers:
            _start_values(model, answers[number, 0], encoded, quantizer)


def grow(blocks: DataFrame, quantizer: Quantizer, models: list[Model]) -> list[Model]:
    """Grow all models together up to ``settings.rounds`` trees each; models that have trees already go on from them.

    A model with ``patience`` stops after as many rounds without less holdout loss; it
    keeps the trees of those rounds, ``best()`` leaves them out.
    """
    sizes, categorical = quantizer.sizes, quantizer.categorical
    n_blocks, rows = blocks.agg(F.count("*"), F.sum("n")).first()
    if not n_blocks:
        raise ValueError("no labelled rows to learn from")
    cores = blocks.sparkSession.sparkContext.defaultParallelism
    if n_blocks == 1 or rows <= _whole_rows(quantizer, len(models), cores):
        return _grown_apart(blocks, quantizer, models, rows)
    groups = max(1, min(len(models), math.ceil(cores / n_blocks)))
    parts = groups * min(n_blocks, max(1, cores // groups))
    fields = ["group", "block", "n", "codes", "labels", "hashes", "roles", "margins"]
    spread = blocks.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).withColumn("margins", F.lit(None).cast("binary"))
    state = _dealt(spread.select(*fields), groups, parts).persist(StorageLevel.MEMORY_AND_DISK)
    if any(not m.trees for m in models):
        _statistics(state, parts, [m if not m.trees else replace(m, orders={}) for m in models], groups, quantizer)
    growers = [_Grower(i, m, sizes) for i, m in enumerate(models)]
    while active := [g for g in growers if not g.done]:
        requests: list[list[Request]] = [[] for _ in range(groups)]
        for grower in active:
            requests[grower.number % groups].append(grower.request())
        answers = _run_pass(state, parts, requests, sizes, categorical)
        for grower in active:
            grower.take(answers)
        if max(len(g.model.trees) - g.carried for g in active) >= CARRY:
            state = _carried(state, parts, growers, groups, fields)
    state.unpersist()
    return models


def _dealt(state: DataFrame, groups: int, parts: int) -> DataFrame:
    """The state with as many blocks in every task, each with those of one group."""
    return state.repartitionById(parts, F.expr(f"int(pmod(block, {parts // groups}) * {groups} + `group`)"))


def _code_type(sizes: np.ndarray) -> type:
    """The type that a task of all rows holds codes in."""
    return np.uint8 if sizes.max(initial=1) <= 256 else np.uint16


def _whole_rows(quantizer: Quantizer, models: int, cores: int) -> int:
    """Rows up to which every model is a task that holds them all."""
    if 2 * models < cores or not WHOLE_ROWS:
        return WHOLE_ROWS
    width = len(quantizer.features) * np.dtype(_code_type(quantizer.sizes)).itemsize
    return max(WHOLE_ROWS, min(SHARED_ROWS, WHOLE_BYTES // max(width, 1)))


def _grown_apart(blocks: DataFrame, quantizer: Quantizer, models: list[Model], rows: int) -> list[Model]:
    """Every model in a task of its own, which reads all blocks, keeps the rows the model uses and grows all its trees."""
    sizes, categorical = quantizer.sizes, quantizer.categorical
    kind, total = _code_type(sizes), int(rows)

    def grown(number: int, codes: np.ndarray, labels: np.ndarray, hashes: np.ndarray, role: np.ndarray) -> Model:
        model = models[number]
        s, learned, held = model.settings, role == LEARNED, role == HELD
        if not model.trees:
            encoded = list(model.encode)
            wanted = _wanted(encoded, quantizer)
            sums = _node_sums(codes[:, wanted], np.flatnonzero(learned), labels.astype(np.float64), np.ones(len(labels)),
                              _offsets(sizes[wanted]), int(sizes[wanted].sum()))
            _start_values(model, sums, encoded, quantizer)
        grower = _Grower(number, model, sizes)
        joined = _joined_columns(codes, sizes, grower.able) if len(codes) >= WIDE_ROWS else []
        margin = model.margins(codes)
        while not grower.done:
            grower.judge({(number, -1): _loss(labels[held], margin[held], s)} if grower.asks_loss else {})
            if grower.done:
                break
            request = grower.request()
            rows = np.flatnonzero(learned & _sampled(hashes, s.row_share, s.seed, request.round // s.row_every) if s.row_share < 1 else learned)
            g, h = _gradients(labels, margin, s)
            _whole_tree(request.growth, request, codes, joined, rows, g, h, sizes, categorical, margin)
            grower.finish()
        return model

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def answer() -> pa.RecordBatch:
            model = grown(now, codes[:filled], *map(np.concatenate, zip(*others)))
            content = zlib.compress(pickle.dumps((model.base, model.orders, model.trees, model.losses)), 1)
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([content], pa.binary())], names=["model", "content"])

        now, codes, filled, others = None, None, 0, []
        for batch in batches:
            for row in range(batch.num_rows):
                number, n, content, labels, hashes, roles = (_plain(c[row]) for c in batch.columns)
                if number != now:  # the blocks of a model follow each other
                    if now is not None:
                        yield answer()
                    now, codes, filled, others = number, np.empty((total, len(sizes)), kind, order="F"), 0, []
                role = np.frombuffer(roles, np.uint8).reshape(n, -1)[:, models[number].role]
                used = role != UNUSED
                taken = int(used.sum())
                codes[filled:filled + taken] = np.frombuffer(content, np.uint16).reshape(n, -1)[used]
                filled += taken
                others.append((np.frombuffer(labels, np.uint8)[used], np.frombuffer(hashes, np.int64)[used], role[used]))
        if now is not None:
            yield answer()

    numbers = blocks.sparkSession.range(0, len(models), 1, len(models)).select(F.col("id").cast("int").alias("model"))
    table = blocks.select("n", "codes", "labels", "hashes", "roles").coalesce(1)
    # Every task reads the blocks; no copy is shuffled, and as the blocks are on the left, they are passed on one by one.
    copies = table.crossJoin(numbers.hint("shuffle_replicate_nl")).select("model", *table.columns)
    spark = blocks.sparkSession
    before = spark.conf.get(BATCH_ROWS, None)
    spark.conf.set(BATCH_ROWS, str(READ_BLOCKS))  # else all blocks of a model are one batch
    try:
        found = copies.mapInArrow(add, "model int, content binary").toArrow()
    finally:
        if before is None:
            spark.conf.unset(BATCH_ROWS)
        else:
            spark.conf.set(BATCH_ROWS, before)
    for number, content in zip(*(c.to_pylist() for c in found.columns)):
        model = models[number]
        model.base, model.orders, model.trees, model.losses = pickle.loads(zlib.decompress(content))
    return models


def _carried(state: DataFrame, parts: int, growers: list[_Grower], groups: int, fields: list[str]) -> DataFrame:
    """The state with the values of all finished trees in its margins, written and read back."""
    recent = [[replace(g.model, trees=g.model.trees[g.carried:], base=0.0 if g.carried else g.model.base)
               for g in growers if g.number % groups == k] for k in range(groups)]
    based = [[not g.carried for g in growers if g.number % groups == k] for k in range(groups)]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                group, _, n, codes, *_, margins = (_plain(c[row]) for c in batch.columns)
                matrix = np.frombuffer(codes, np.uint16).reshape(n, -1)
                added = np.stack([m.margins(matrix) for m in recent[group]], 1)
                if margins is not None:
                    before = np.frombuffer(margins, np.float64).reshape(n, -1)
                    bases = np.array([m.base if new else 0.0 for m, new in zip(recent[group], based[group])])
                    added = added - bases + before
                one = batch.slice(row, 1)
                yield pa.RecordBatch.from_arrays([*one.columns[:-1], pa.array([added.tobytes()], pa.binary())], names=fields)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in state.schema)
    following = _dealt(written(state.mapInArrow(apply, schema), "boosting"), groups, parts).persist(StorageLevel.MEMORY_AND_DISK)
    following.count()
    state.unpersist()
    for grower in growers:
        grower.carried = len(grower.model.trees)
    return following


def held_scores(blocks: DataFrame, models: list[Model]) -> DataFrame:
    """``model, target, score`` for the rows every model holds out, from one pass over the blocks."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, codes, labels, roles in zip(*(c.to_pylist() for c in batch.columns)):
                codes, labels = np.frombuffer(codes, np.uint16).reshape(n, -1), np.frombuffer(labels, np.uint8)
                roles = np.frombuffer(roles, np.uint8).reshape(n, -1)
                for number, model in enumerate(models):
                    held = roles[:, model.role] == HELD
                    margin = model.margins(codes[held])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(margin), number, np.int32)), pa.array(labels[held].astype(np.int32)),
                         pa.array(1 / (1 + np.exp(-margin)))], names=["model", "target", "score"])

    return blocks.select("n", "codes", "labels", "roles").mapInArrow(score, "model int, target int, score double")


def scored(df: DataFrame, quantizer: Quantizer, model: Model, name: str = "score") -> DataFrame:
    """``df`` with the model's probability of the positive class; its other columns unchanged."""
    kept = [c for c in df.columns if c != name]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != name)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margin = model.margins(quantizer.codes(batch))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1 / (1 + np.exp(-margin)))], names=[*kept, name])

    return df.select(*kept).mapInArrow(score, f"{fields}, {name} double")
