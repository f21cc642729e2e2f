"""Boosted trees with one softmax objective for all classes, grown from gradient histograms.

Values are binned once by the quantiles of the values present in each column and kept as blocks of rows, column
by column. A level of the trees of all classes costs one pass: every task adds up gradients and curvatures per class,
node, column and bin of its blocks, the sums meet by ranges of columns, and each range sends its best split per
class and node to the driver, which holds nothing but the trees. Values that are absent (zeros of sparse
vectors) go to the side of a split that gains more.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import scratch_path
from .blocks import sparse_entries, spread

BLOCK_ROWS = 8192
RANGE_CELLS = 500_000  # columns x bins that one range of columns holds at most
RANGE_WORTH = 20_000  # columns x bins that are worth a range of their own
STORED_EVERY = 10  # rounds between two written states of the margins

BLOCK = "labels binary, rows binary, cells binary, margins binary"
PART = "range int, part long, cells binary, sums binary, totals binary"
SPLIT = "class int, node int, gain double, cell int, absent_left boolean, left_g double, left_h double, g double, h double"


@dataclass
class Tree:
    """Nodes by number (root 1, children 2n and 2n + 1): splits (column, last bin to the left, absent to the left, gain) and leaves."""

    splits: dict[int, tuple[int, int, bool, float]] = field(default_factory=dict)
    leaves: dict[int, float] = field(default_factory=dict)

    def places(self, n: int, rows_of: Callable[[int], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The node that every row reaches; ``rows_of`` gives a column's rows and their bins."""
        at = np.ones(n, dtype=np.int64)
        for node in sorted(self.splits):
            column, last, absent_left, _ = self.splits[node]
            here = at == node
            if not here.any():
                continue
            rows, bins = rows_of(column)
            left = np.full(n, absent_left)
            left[rows] = bins <= last
            at[here] = 2 * node + ~left[here]
        return at

    def values(self, at: np.ndarray) -> np.ndarray:
        table = np.zeros(max(self.leaves) + 1)
        for node, value in self.leaves.items():
            table[node] = value
        return table[at]


class Block:
    """Binned rows, their entries sorted by cell (column * bins + bin)."""

    def __init__(self, rows: np.ndarray, cells: np.ndarray, bins: int):
        self.rows, self.cells, self.bins = rows, cells, bins

    def column(self, column: int) -> tuple[np.ndarray, np.ndarray]:
        # Bounds of another type would copy all cells.
        a, b = np.searchsorted(self.cells, np.array([column * self.bins, (column + 1) * self.bins], dtype=self.cells.dtype))
        return self.rows[a:b], self.cells[a:b] % self.bins


def _frombytes(batch: pa.RecordBatch, i: int, kinds: Sequence[type]) -> list[np.ndarray]:
    return [np.frombuffer(batch.column(c)[i].as_py(), dtype=k) for c, k in enumerate(kinds)]


def _shares(margins: np.ndarray) -> np.ndarray:
    odds = np.exp(margins - margins.max(axis=1, keepdims=True))
    return odds / odds.sum(axis=1, keepdims=True)


def _binned(indices: np.ndarray, values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Cell of each entry: its column's first bin whose upper cut is not below the value."""
    bins = cuts.shape[1] + 1
    out = np.empty(len(values), dtype=np.int64)
    for at in range(0, len(values), 65_536):
        i = indices[at:at + 65_536]
        out[at:at + 65_536] = i * bins + (values[at:at + 65_536, None] > cuts[i]).sum(axis=1)
    return out


def quantile_cuts(df: DataFrame, features: str, columns: int, bins: int, accuracy: int = 2000) -> np.ndarray:
    """Upper ends of the bins of each column, from a sketch of the values present; one row a column reaches the driver."""
    found = sparse_entries(df.select(features), features).select(F.explode(F.arrays_zip("_i", "_v")).alias("e")).where(
        "e._v != 0 and not isnan(e._v)").groupBy("e._i").agg(F.percentile_approx(
            "e._v", [j / bins for j in range(1, bins)], accuracy).alias("cuts"))
    cuts = np.full((columns, bins - 1), np.inf)
    for r in found.collect():
        ends = sorted(set(r["cuts"]))
        cuts[r["_i"], :len(ends)] = ends
    return cuts


def _blocks(df: DataFrame, label: str, features: str, cuts: np.ndarray, classes: int) -> DataFrame:
    bins, schema = cuts.shape[1] + 1, to_arrow_schema(_schema(BLOCK))

    def pack(labels: list[np.ndarray], sizes: list[np.ndarray], indices: list[np.ndarray], values: list[np.ndarray]) -> pa.RecordBatch:
        y, v = np.concatenate(labels).astype(np.int32), np.concatenate(values).astype(float)
        rows = np.repeat(np.arange(len(y), dtype=np.int32), np.concatenate(sizes))
        here = (v != 0) & ~np.isnan(v)
        cells = _binned(np.concatenate(indices).astype(np.int64)[here], v[here], cuts)
        order = np.argsort(cells, kind="stable")
        columns = [y, rows[here][order], cells[order].astype(np.int32), np.zeros(len(y) * classes)]
        return pa.RecordBatch.from_arrays([pa.array([c.tobytes()], type=pa.binary()) for c in columns], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list, list, list, list] = ([], [], [], [])
        n = 0
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                part = whole.slice(at, 1024)
                held[0].append(part.column(0).to_numpy(zero_copy_only=False))
                held[1].append(np.diff(part.column(1).offsets.to_numpy()))
                held[2].append(part.column(1).flatten().to_numpy(zero_copy_only=False))
                held[3].append(part.column(2).flatten().to_numpy(zero_copy_only=False))
                n += part.num_rows
                if n >= BLOCK_ROWS:
                    yield pack(*held)
                    held, n = ([], [], [], []), 0
        if n:
            yield pack(*held)

    rows = df.where(F.col(label).isNotNull() & F.col(features).isNotNull()).select(F.col(label).cast("int").alias("_y"), features)
    return sparse_entries(rows, features).select("_y", "_i", "_v").mapInArrow(run, BLOCK)


def _schema(ddl: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl)


def _state(batch: pa.RecordBatch, i: int, bins: int, classes: int, recent: list[list[Tree]]) -> tuple[np.ndarray, Block, np.ndarray]:
    y, rows, cells, margins = _frombytes(batch, i, (np.int32, np.int32, np.int32, np.float64))
    block, margins = Block(rows, cells, bins), margins.reshape(len(y), classes).copy()
    for trees in recent:
        for c, tree in enumerate(trees):
            margins[:, c] += tree.values(tree.places(len(y), block.column))
    return y, block, margins


def _histograms(
    blocks: DataFrame, bins: int, classes: int, recent: list[list[Tree]], growing: list[Tree], first: int, open_nodes: list[list[int]],
    starts: np.ndarray,
) -> DataFrame:
    """Per range of columns what a task's blocks add: cells of class, cell and node with sums of g and h; node totals."""
    schema = to_arrow_schema(_schema(PART))
    nodes = first  # a level's nodes are numbered from ``first`` to 2 * first - 1
    cells = int(starts[-1]) * bins

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((classes, nodes, 2))
        range_of = np.repeat(np.arange(len(starts) - 1, dtype=np.uint16), np.diff(starts) * bins)  # of every cell
        keys: list[np.ndarray] = []
        sums: list[np.ndarray] = []
        for batch in batches:
            for i in range(batch.num_rows):
                y, block, margins = _state(batch, i, bins, classes, recent)
                p = _shares(margins)
                g, h = p.copy(), np.maximum(2 * p * (1 - p), 1e-16)
                g[np.arange(len(y)), y] -= 1
                for c, tree in enumerate(growing):
                    at = tree.places(len(y), block.column)
                    here = np.isin(at, open_nodes[c])
                    node = np.where(here, at - first, -1)
                    totals[c, :, 0] += np.bincount(node[here], g[here, c], nodes)
                    totals[c, :, 1] += np.bincount(node[here], h[here, c], nodes)
                    mine = node[block.rows]
                    taken = np.flatnonzero(mine >= 0)
                    # Entries stand in order of cells, so dealing them out by node puts their keys in order.
                    taken = taken[np.argsort(mine[taken].astype(np.uint16 if nodes <= 1 << 16 else np.int64), kind="stable")]
                    rows = block.rows[taken]
                    key = (c * nodes + mine[taken]) * cells + block.cells[taken]
                    fresh = np.append(True, np.diff(key) != 0)[:len(key)]
                    back, found = np.cumsum(fresh) - 1, key[fresh]
                    keys.append(found)
                    sums.append(np.stack([np.bincount(back, g[rows, c], len(found)), np.bincount(back, h[rows, c], len(found))]))
                if len(keys) > 16 * classes:
                    found, added = _added(keys, sums)
                    keys, sums = [found], [added]
        if not keys:
            return
        found, added = _added(keys, sums)
        ranges = range_of[found % cells]
        by_range = np.argsort(ranges, kind="stable")
        ends = np.searchsorted(ranges[by_range], np.arange(len(starts)))
        part = TaskContext.get().partitionId()
        for r in range(len(starts) - 1):
            own = by_range[ends[r]:ends[r + 1]]
            columns = [pa.array([r], type=pa.int32()), pa.array([part], type=pa.int64())]
            columns += [pa.array([x.tobytes()], type=pa.binary()) for x in (found[own], np.ascontiguousarray(added[:, own]), totals)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return blocks.mapInArrow(run, PART)


def _added(keys: list[np.ndarray], sums: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    whole, both = np.concatenate(keys), np.concatenate(sums, axis=1)
    if (np.diff(whole) > 0).all():  # one block, class after class
        return whole, both
    found, back = np.unique(whole, return_inverse=True)
    return found, np.stack([np.bincount(back, both[0], len(found)), np.bincount(back, both[1], len(found))])


def _best_splits(
    parts: DataFrame, ranges: int, cells: int, bins: int, classes: int, nodes: int, reg: float, least: float, alone: bool,
) -> DataFrame:
    """The best split of each class and node within each range of columns."""
    schema = to_arrow_schema(_schema(SPLIT))

    def best(keys: list[np.ndarray], sums: list[np.ndarray], totals: np.ndarray) -> pa.RecordBatch:
        # A row for every node with rows; its gain stays below zero where no split is worth it.
        c0, node0 = np.nonzero(totals[:, :, 1] > 0)
        at = np.full((classes, nodes), -1)
        at[c0, node0] = np.arange(len(c0))
        n = len(c0)
        out = [c0, node0, np.full(n, -1.0), np.zeros(n, dtype=int), np.zeros(n, dtype=bool), np.zeros(n), np.zeros(n),
               totals[c0, node0, 0], totals[c0, node0, 1]]
        found, (g, h) = _added(keys, sums)
        if len(found):
            tops, values = tops_of(found, g, h, totals)
            rows = at[tops]
            for column, value in zip(out[2:7], values):
                column[rows] = value
        return pa.RecordBatch.from_arrays([pa.array(x).cast(f.type) for x, f in zip(out, schema)], schema=schema)

    def tops_of(found: np.ndarray, g: np.ndarray, h: np.ndarray, totals: np.ndarray) -> tuple[tuple, list[np.ndarray]]:
        # Cells stand in order within each class and node.
        group, cell = np.divmod(found, cells)
        c, node, column = group // nodes, group % nodes, cell // bins
        fresh = np.flatnonzero(np.append(True, (np.diff(column) != 0) | (np.diff(group) != 0)))
        sizes = np.diff(np.append(fresh, len(found)))

        def within(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            run = np.cumsum(x)
            base = np.repeat(run[fresh] - x[fresh], sizes)
            own = run - base
            return own, np.repeat(own[fresh + sizes - 1], sizes)

        (left_g, present_g), (left_h, present_h) = within(g), within(h)
        all_g, all_h = totals[c, node, 0], totals[c, node, 1]
        whole = all_g * all_g / (all_h + reg)

        def gain(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            value = a * a / (b + reg) + (all_g - a) ** 2 / (all_h - b + reg) - whole
            return np.where((b >= least) & (all_h - b >= least), value, -np.inf)

        with_absent = gain(left_g + all_g - present_g, left_h + all_h - present_h)
        alone = gain(left_g, left_h)
        absent_left = with_absent > alone + 1e-12
        gains = np.where(absent_left, with_absent, alone)
        # Equal gains go to the first cell, whatever the order in which sums arrived.
        rounded = np.round(gains, 9)
        heads = np.flatnonzero(np.append(True, np.diff(group) != 0))
        highest = np.repeat(np.maximum.reduceat(rounded, heads), np.diff(np.append(heads, len(found))))
        winners = np.flatnonzero((rounded == highest) & (gains > 1e-6))
        tops = winners[np.append(True, np.diff(group[winners]) != 0)] if len(winners) else winners
        a = np.where(absent_left, left_g + all_g - present_g, left_g)[tops]
        b = np.where(absent_left, left_h + all_h - present_h, left_h)[tops]
        return (c[tops], node[tops]), [gains[tops], cell[tops], absent_left[tops], a, b]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, keys, sums, totals = None, [], [], np.zeros((classes, nodes, 2))
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.column(0)[i].as_py()
                if current is not None and r != current:
                    yield best(keys, sums, totals)
                    keys, sums, totals = [], [], np.zeros((classes, nodes, 2))
                current = r
                keys.append(np.frombuffer(batch.column(2)[i].as_py(), dtype=np.int64))
                sums.append(np.frombuffer(batch.column(3)[i].as_py(), dtype=np.float64).reshape(2, -1))
                totals = totals + np.frombuffer(batch.column(4)[i].as_py(), dtype=np.float64).reshape(classes, nodes, 2)
                if len(keys) > 32:
                    found, added = _added(keys, sums)
                    keys, sums = [found], [added]
        if current is not None:
            yield best(keys, sums, totals)

    # Parts are added in the order of their tasks, so equal inputs give equal trees. A single task's parts need no shuffle.
    if not alone:
        parts = parts.repartitionById(ranges, F.col("range")).sortWithinPartitions("range", "part")
    return parts.mapInArrow(run, SPLIT)


def _stored(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "blocks")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _with_margins(blocks: DataFrame, bins: int, classes: int, recent: list[list[Tree]]) -> DataFrame:
    schema = to_arrow_schema(_schema(BLOCK))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                margins = _state(batch, i, bins, classes, recent)[2]
                columns = [batch.column(c).slice(i, 1) for c in range(3)] + [pa.array([margins.tobytes()], type=pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return blocks.mapInArrow(run, BLOCK)


class BoostedTrees:
    """Fitted trees: rounds of one tree per class over columns binned at ``cuts``."""

    def __init__(self, cuts: np.ndarray, rounds: list[list[Tree]], classes: int):
        self.cuts, self.rounds, self.classes = cuts, rounds, classes

    @property
    def bins(self) -> int:
        return self.cuts.shape[1] + 1

    def transform(self, df: DataFrame, features: str = "features", out: str = "probabilities") -> DataFrame:
        """Adds ``margins`` and ``out`` (array<double>, one per class) and the ``prediction`` of the largest margin.

        A NULL vector gets NULLs.
        """
        cuts, rounds, classes = self.cuts, self.rounds, self.classes
        shared = df.sparkSession.sparkContext.broadcast((cuts, rounds))  # bounded by columns x bins and rounds x classes x 2^depth

        @F.pandas_udf("array<double>")
        def margins(indices: pd.Series, values: pd.Series) -> pd.Series:
            cuts, rounds = shared.value
            n = len(indices)
            sizes = [0 if v is None else len(v) for v in values]
            total = np.zeros((n, classes))
            if sum(sizes):
                i, v = (np.concatenate([x for x in s if x is not None]) for s in (indices, values))
                rows, here = np.repeat(np.arange(n), sizes), (v != 0) & ~np.isnan(v)
                cells = _binned(i[here].astype(np.int64), v[here], cuts)
                order = np.argsort(cells, kind="stable")
                block = Block(rows[here][order], cells[order], cuts.shape[1] + 1)
            else:
                block = Block(np.empty(0, dtype=int), np.empty(0, dtype=int), cuts.shape[1] + 1)
            for trees in rounds:
                for c, tree in enumerate(trees):
                    total[:, c] += tree.values(tree.places(n, block.column))
            return pd.Series([None if v is None else list(row) for row, v in zip(total, values)])

        scored = sparse_entries(df, features).withColumn("margins", margins("_i", "_v")).drop("_i", "_v")
        top = F.array_max("margins")
        odds = F.transform("margins", lambda m: F.exp(m - top))
        return scored.withColumn("_odds", odds).withColumn(
            out, F.transform("_odds", lambda o: o / F.aggregate("_odds", F.lit(0.0), lambda a, b: a + b))
        ).drop("_odds").withColumn("prediction", (F.array_position("margins", top) - 1).cast("double"))

    def importance(self, terms: Sequence[str]) -> list[tuple[str, float, int]]:
        """(term, share of the mean gains, splits) of every column that splits, strongest first."""
        gains: dict[int, list[float]] = {}
        for trees in self.rounds:
            for tree in trees:
                for column, _, _, gain in tree.splits.values():
                    gains.setdefault(column, []).append(gain)
        means = {column: sum(g) / len(g) for column, g in gains.items()}
        whole = sum(means.values())
        return sorted(((terms[c], m / whole, len(gains[c])) for c, m in means.items()), key=lambda r: (-r[1], r[0]))

    def save(self, path: str) -> str:
        spark = SparkSession.active()
        rows = []
        for r, trees in enumerate(self.rounds):
            for c, tree in enumerate(trees):
                rows += [(r, c, n, s[0], s[1], s[2], s[3], None) for n, s in tree.splits.items()]
                rows += [(r, c, n, None, None, None, None, v) for n, v in tree.leaves.items()]
        spark.createDataFrame(
            rows, "round int, class int, node long, column int, bin int, absent_left boolean, gain double, value double"
        ).write.mode("overwrite").parquet(f"{path}/nodes")
        spark.createDataFrame(
            [(i, [float(x) for x in row], self.classes) for i, row in enumerate(self.cuts)], "column int, cuts array<double>, classes int"
        ).write.mode("overwrite").parquet(f"{path}/cuts")
        return path

    @staticmethod
    def load(path: str) -> BoostedTrees:
        spark = SparkSession.active()
        columns = spark.read.parquet(f"{path}/cuts").orderBy("column").collect()  # one row a column of the model
        classes = columns[0]["classes"]
        nodes = spark.read.parquet(f"{path}/nodes").collect()
        rounds = [[Tree() for _ in range(classes)] for _ in range(1 + max(r["round"] for r in nodes))]
        for r in nodes:
            tree = rounds[r["round"]][r["class"]]
            if r["value"] is None:
                tree.splits[r["node"]] = (r["column"], r["bin"], r["absent_left"], r["gain"])
            else:
                tree.leaves[r["node"]] = r["value"]
        return BoostedTrees(np.array([r["cuts"] for r in columns]), rounds, classes)


def fit_softmax_trees(
    df: DataFrame, classes: int, columns: int, rounds: int = 100, depth: int = 6, eta: float = 0.3, bins: int = 64,
    reg: float = 1.0, least: float = 1.0, label: str = "label", features: str = "features",
) -> BoostedTrees:
    """Boosted trees on (label 0..classes-1, vector of ``columns``), all classes under one softmax loss.

    ``reg`` is the penalty on leaf weights, ``least`` the smallest curvature of a child. Rows with a NULL
    label or vector take no part. Without rows every class gets the same share. A round in which no class finds a
    split is the last: the rows are fitted as far as ``least`` allows, and no later round could find one.
    """
    rows = df.select(label, features).persist()
    cuts = quantile_cuts(rows, features, columns, bins)
    blocks = _stored(_blocks(spread(rows), label, features, cuts, classes))
    tasks = blocks.rdd.getNumPartitions()
    alone = tasks == 1
    rows.unpersist()
    most = 1 if alone else min(df.sparkSession.sparkContext.defaultParallelism, columns * bins // RANGE_WORTH)
    ranges = max(1, most, -(-columns * bins // RANGE_CELLS))
    starts = np.linspace(0, columns, ranges + 1).round().astype(np.int64)
    done: list[list[Tree]] = []
    recent: list[list[Tree]] = []  # trees since the margins were written
    for _ in range(rounds):
        trees = [Tree() for _ in range(classes)]
        sums: list[dict[int, tuple[float, float]]] = [{} for _ in range(classes)]
        open_nodes = [[1] for _ in range(classes)]
        for level in range(depth):
            first = 1 << level
            parts_of = _histograms(blocks, bins, classes, recent, trees, first, open_nodes, starts)
            found: dict[tuple[int, int], tuple] = {}
            for r in _best_splits(parts_of, ranges, columns * bins, bins, classes, first, reg, least, alone).collect():  # classes x nodes x ranges rows
                key = (r["class"], first + r["node"])
                sums[key[0]].setdefault(key[1], (r["g"], r["h"]))
                rank = (-round(r["gain"], 9), r["cell"])
                if r["gain"] > 0 and (key not in found or rank < found[key][0]):
                    found[key] = (rank, r)
            following: list[list[int]] = [[] for _ in range(classes)]
            for (c, node), (_, r) in sorted(found.items(), key=lambda item: item[0]):
                trees[c].splits[node] = (r["cell"] // bins, r["cell"] % bins, r["absent_left"], r["gain"])
                sums[c][2 * node] = (r["left_g"], r["left_h"])
                sums[c][2 * node + 1] = (r["g"] - r["left_g"], r["h"] - r["left_h"])
                following[c] += [2 * node, 2 * node + 1]
            open_nodes = following
            if not any(open_nodes):
                break
        for c, tree in enumerate(trees):
            known = sums[c] or {1: (0.0, 0.0)}
            tree.leaves = {node: -eta * g / (h + reg) for node, (g, h) in known.items() if node not in tree.splits}
        done.append(trees)
        if not any(tree.splits for tree in trees):
            break
        recent.append(trees)
        if len(recent) == STORED_EVERY:
            blocks, recent = _stored(_with_margins(blocks, bins, classes, recent)), []
    return BoostedTrees(cuts, done, classes)
