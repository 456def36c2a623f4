"""Gradient-boosted trees over quantised columns: many models at once, rows stay where they are.

Columns become bins of one byte.  The binned rows are stored in blocks with their targets and predictions; a step is one
narrow pass over the blocks that sums gradients and rows by (model, leaf, column, bin) and one shuffle of those sums, in which
the best split of every leaf is found.  All models (targets, trials of a search) share the pass.  Trees grow best leaf
first: the leaf whose split gains most is next.  To need fewer passes the children of several promising leaves are measured
in one; which leaves end up in the tree does not depend on it.

The loss is the squared error.  With g the gradients' sum, h the rows of a leaf and T(g) = sign(g) * max(|g| - l1, 0):
a leaf's value is -T(g) / (h + l2), a split's gain is half of what T(g)^2 / (h + l2) rises by.
"""

from __future__ import annotations

import dataclasses
import json
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.functions.numeric import nan_free
from daygrain.session import written

BINS = 255
BLOCK_ROWS = 4096
COLUMNS = 16  # columns whose sums travel together
AHEAD = 4  # leaves whose children one pass may measure, for each model
REWRITE = 8  # rounds after which predictions are stored with the blocks

NODES = (
    "model string, target string, round int, node int, feature string, threshold double, left int, right int, gain double, rows bigint, value double"
)


@dataclass(frozen=True)
class Params:
    """Of one model.  ``depth`` 0: unbounded.  ``columns`` and ``rows``: shares a tree draws."""

    rounds: int = 300
    learning_rate: float = 0.05
    leaves: int = 63
    depth: int = 0
    least_rows: int = 20
    l1: float = 0.0
    l2: float = 0.0
    columns: float = 1.0
    rows: float = 1.0
    seed: int = 42


@dataclass(frozen=True)
class Job:
    model: str
    target: str
    params: Params


@dataclass
class Node:
    """A leaf, or a split once ``left`` is set; ``best`` is (gain, column, bin, gradients and rows to the left)."""

    gradient: float = 0.0
    rows: int = 0
    depth: int = 0
    best: tuple[float, int, int, float, int] | None = None
    left: int = -1
    taken: bool = False


@dataclass
class Growth:
    """A model in training: its finished trees, and the one that grows, with children measured ahead."""

    job: Job
    base: float
    trees: list[dict[str, np.ndarray]] = field(default_factory=list)
    stored: int = 0  # trees whose predictions are in the blocks
    nodes: list[Node] = field(default_factory=list)
    leaves: int = 1
    stopped: bool = False


# --- bins and blocks ---------------------------------------------------------------------------


def bin_edges(df: DataFrame, features: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Ascending values of each column that part its rows into at most ``bins`` bins of about as many rows.

    A value belongs to the bin after all edges below it.  A column with fewer distinct values than bins has each but the
    largest as an edge, found exactly; others by their approximate quantiles.
    """
    columns = [F.col(f"`{c}`").cast("double") for c in features]
    long = df.select(F.posexplode(F.array(*columns)).alias("i", "v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    shares = [k / bins for k in range(1, bins)]
    found = {r["i"]: r for r in long.groupBy("i").agg(
        F.approx_count_distinct("v", 0.02).alias("n"), F.percentile_approx("v", shares, 20 * bins).alias("q")
    ).collect()}  # a row a column
    few = [i for i, r in found.items() if r["n"] <= bins * 0.9]
    exact = {r["i"]: r["s"] for r in long.where(F.col("i").isin(few)).groupBy("i").agg(F.sort_array(F.collect_set("v")).alias("s")).collect()} if few else {}
    return [np.unique(np.array(exact[i][:-1] if i in exact else found[i]["q"] if i in found else [], float)) for i in range(len(features))]


def _blocks(edges: list[np.ndarray], features: int, targets: int, rows: int):
    from pyspark import TaskContext

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for i in range(0, batch.num_rows, rows):
                part = batch.slice(i, rows)
                column = lambda c: part.column(c).to_numpy(zero_copy_only=False).astype(float)
                # missing values lie below all others
                binned = np.stack([np.searchsorted(edges[c], np.nan_to_num(column(c), nan=-np.inf), "left") for c in range(features)]).astype(np.uint8)
                known = np.stack([column(features + t) for t in range(targets)])
                judged = part.column(features + targets).to_numpy(zero_copy_only=False).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x]) for x in (number, part.num_rows, binned.tobytes(), known.tobytes(), judged.tobytes())],
                    ["block", "n", "binned", "known", "judged"],
                )
                number += 1

    return run


@dataclass
class Binned:
    """Blocks of binned rows; rows marked ``judged`` are scored in every round, but no tree sees them."""

    blocks: DataFrame
    edges: list[np.ndarray]
    features: list[str]
    targets: list[str]
    rows: int
    judged: int
    means: dict[str, float]


def binned(
    df: DataFrame, features: Sequence[str], targets: Sequence[str], judged: str | None = None, bins: int = BINS, block_rows: int = BLOCK_ROWS
) -> Binned:
    """Blocks of the rows whose targets are all known, written once; ``judged`` names a boolean column."""
    features, targets = list(features), list(targets)
    mark = F.coalesce(F.col(judged), F.lit(False)) if judged else F.lit(False)
    rows = nan_free(df, [*features, *targets]).select(
        *[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(features)],
        *[F.col(f"`{t}`").cast("double").alias(f"t{i}") for i, t in enumerate(targets)], mark.alias("judged"),
    ).na.drop(subset=[f"t{i}" for i in range(len(targets))])
    learn = rows.where(~F.col("judged"))
    edges = bin_edges(learn.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(features)]), features, bins)
    blocks = written(
        rows.mapInArrow(_blocks(edges, len(features), len(targets), block_rows), "block bigint, n bigint, binned binary, known binary, judged binary"),
        "blocks",
    )
    told = rows.agg(
        F.count(F.when(~F.col("judged"), 1)).alias("rows"), F.count(F.when(F.col("judged"), 1)).alias("judged"),
        *[F.avg(F.when(~F.col("judged"), F.col(f"t{i}"))).alias(f"m{i}") for i in range(len(targets))],
    ).first()
    if not told["rows"]:
        raise ValueError("no row to learn from")
    means = {t: told[f"m{i}"] for i, t in enumerate(targets)}
    return Binned(blocks, edges, features, targets, told["rows"], told["judged"], means)


# --- what a pass does with a block ------------------------------------------------------------


def routed(tree: Mapping[str, np.ndarray], bins: np.ndarray) -> np.ndarray:
    """The node of a tree at which each row (a column of ``bins``) ends."""
    at = np.zeros(bins.shape[1], np.int32)
    open_ = np.arange(bins.shape[1]) if len(tree["left"]) and tree["left"][0] >= 0 else np.zeros(0, np.int64)
    while len(open_):
        node = at[open_]
        right = bins[tree["column"][node], open_] > tree["bin"][node]
        at[open_] = tree["left"][node] + right
        open_ = open_[tree["left"][at[open_]] >= 0]
    return at


def drawn(job: Job, round_: int, block: int, n: int) -> np.ndarray | None:
    """Which rows of a block a tree sees; None: all."""
    if job.params.rows >= 1:
        return None
    return np.random.default_rng([job.params.seed, round_, block >> 32, block & 0xFFFFFFFF]).random(n) < job.params.rows


def columns_of(job: Job, round_: int, columns: int) -> np.ndarray:
    """Which columns a tree may split."""
    if job.params.columns >= 1:
        return np.arange(columns)
    many = max(1, int(round(job.params.columns * columns)))
    return np.sort(np.random.default_rng([job.params.seed, round_]).choice(columns, many, replace=False))


@dataclass
class Task:
    """What a pass needs of one model."""

    job: Job
    base: float
    target: int
    stored: int | None  # place of its predictions in the blocks
    trees: list[dict[str, np.ndarray]]  # those not yet stored
    round: int
    tree: dict[str, np.ndarray]
    wanted: list[int]


def _predictions(task: Task, bins: np.ndarray, stored: np.ndarray | None) -> np.ndarray:
    out = np.full(bins.shape[1], task.base) if task.stored is None else stored[task.stored].copy()
    for tree in task.trees:
        out += tree["value"][routed(tree, bins)]
    return out


def _opened(batch: pa.RecordBatch, i: int, columns: int, targets: int):
    n = batch.column("n")[i].as_py()
    bins = np.frombuffer(batch.column("binned")[i].as_buffer(), np.uint8).reshape(columns, n)
    known = np.frombuffer(batch.column("known")[i].as_buffer(), float).reshape(targets, n)
    judged = np.frombuffer(batch.column("judged")[i].as_buffer(), np.uint8).astype(bool)
    stored = batch.column("stored")[i].as_buffer() if "stored" in batch.schema.names else None
    return n, bins, known, judged, np.frombuffer(stored, float).reshape(-1, n) if stored is not None else None


def _sums(tasks: list[Task], columns: int, targets: int, bins_: int):
    """Sums of a task's rows: gradients and rows by bin of wanted leaves, and at a root the squared errors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int, int], np.ndarray] = {}

        def add(key, values):
            if key in totals:
                totals[key] += values
            else:
                totals[key] = values

        for batch in batches:
            for i in range(batch.num_rows):
                n, bins, known, judged, stored = _opened(batch, i, columns, targets)
                block = batch.column("block")[i].as_py()
                for k, task in enumerate(tasks):
                    gradient = _predictions(task, bins, stored) - known[task.target]
                    if task.wanted == [0]:
                        square = gradient * gradient
                        add((k, -1, 0), np.array([square[~judged].sum(), (~judged).sum(), square[judged].sum(), judged.sum()], float))
                    leaf = routed(task.tree, bins)
                    slot = np.full(len(task.tree["left"]), -1)
                    slot[task.wanted] = np.arange(len(task.wanted))
                    slot = np.where(judged, -1, slot[leaf])
                    seen = drawn(task.job, task.round, block, n)
                    rows = np.flatnonzero(slot >= 0 if seen is None else (slot >= 0) & seen)
                    slot, own = slot[rows], gradient[rows]
                    wide = len(task.wanted) * bins_
                    for first in range(0, columns, COLUMNS):
                        part = bins[first:first + COLUMNS, rows]
                        at = (np.arange(len(part))[:, None] * wide + slot[None, :] * bins_ + part).reshape(-1)
                        both = np.stack([
                            np.bincount(at, weights=np.broadcast_to(own, part.shape).reshape(-1), minlength=len(part) * wide),
                            np.bincount(at, minlength=len(part) * wide),
                        ]).astype(float).reshape(2, len(part), len(task.wanted), bins_)
                        for s, node in enumerate(task.wanted):
                            add((k, node, first), both[:, :, s, :].copy())
        for (k, node, first), values in totals.items():
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (k, node, first, values.tobytes())], ["task", "node", "first", "sums"])

    return run


def shrunk(gradient, l1: float):
    return np.sign(gradient) * np.maximum(np.abs(gradient) - l1, 0.0)


def best_split(sums: np.ndarray, allowed: np.ndarray, params: Params) -> tuple[float, int, int, float, int] | None:
    """(gain, column, bin, gradients and rows to the left) of sums (2, columns, bins); rows up to the bin go left.

    Of equal gains the first column and the lowest bin wins.
    """
    gradient, rows = np.cumsum(sums[0], axis=1), np.cumsum(sums[1], axis=1)
    g, h = gradient[:, -1:], rows[:, -1:]
    score = lambda a, b: shrunk(a, params.l1) ** 2 / np.maximum(b + params.l2, 1e-300)
    gain = (score(gradient, rows) + score(g - gradient, h - rows) - score(g, h)) / 2
    gain[(rows < params.least_rows) | (h - rows < params.least_rows) | (rows < 1) | (h - rows < 1)] = -np.inf
    gain[~allowed] = -np.inf
    at = int(np.argmax(gain))
    column, bin_ = divmod(at, gain.shape[1])
    if not gain[column, bin_] > 1e-12 * max(1.0, float(score(g, h)[0, 0])):
        return None
    return float(gain[column, bin_]), column, bin_, float(gradient[column, bin_]), int(rows[column, bin_])


def _found(jobs: list[Job], rounds: list[int], columns: int, bins_: int):
    """The best split among the columns that travelled together, from the summed sums of all tasks."""

    def run(table: pa.Table) -> pa.Table:
        k, node, first = (table.column(c)[0].as_py() for c in ("task", "node", "first"))
        total = sum(np.frombuffer(b.as_buffer(), float) for b in table.column("sums"))
        none = {"gain": None, "column": None, "bin": None, "left_gradient": None, "left_rows": None}
        if node < 0:
            out = none | {"gradient": total[0], "rows": int(total[1]), "judged_gradient": total[2], "judged_rows": int(total[3])}
        else:
            sums = total.reshape(2, -1, bins_)
            allowed = np.isin(first + np.arange(sums.shape[1]), columns_of(jobs[k], rounds[k], columns))
            best = best_split(sums, allowed, jobs[k].params)
            out = none if best is None else dict(zip(none, (best[0], first + best[1], *best[2:])))
            out |= {"gradient": float(sums[0, 0].sum()), "rows": int(sums[1, 0].sum()), "judged_gradient": None, "judged_rows": None}
        return pa.Table.from_pylist([{"task": k, "node": node, "first": first, **out}], schema=_FOUND_ARROW)

    return run


_FOUND = (
    "task bigint, node bigint, first bigint, gain double, column bigint, bin bigint, left_gradient double, left_rows bigint, "
    "gradient double, rows bigint, judged_gradient double, judged_rows bigint"
)
_FOUND_ARROW = pa.schema([(c.split()[0], pa.float64() if c.split()[1] == "double" else pa.int64()) for c in _FOUND.split(", ")])


def _restored(tasks: list[Task], columns: int, targets: int):
    """Blocks with the predictions of all models in their order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                _, bins, _, _, stored = _opened(batch, i, columns, targets)
                made = np.stack([_predictions(t, bins, stored) for t in tasks])
                names = ["block", "n", "binned", "known", "judged"]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(i, 1) for c in names), pa.array([made.tobytes()], pa.binary())], [*names, "stored"]
                )

    return run


# --- growing ------------------------------------------------------------------------------------


def _as_arrays(nodes: list[Node]) -> dict[str, np.ndarray]:
    return {
        "left": np.array([n.left for n in nodes], np.int32),
        "column": np.array([n.best[1] if n.left >= 0 else 0 for n in nodes], np.int32),
        "bin": np.array([n.best[2] if n.left >= 0 else 0 for n in nodes], np.int32),
    }


def _grow(growth: Growth) -> list[int]:
    """Take leaves, best first, as long as their children are measured; then the leaves to measure next.

    An empty list: the tree is finished.
    """
    nodes, params = growth.nodes, growth.job.params
    deep = lambda n: bool(params.depth) and n.depth >= params.depth
    while growth.leaves < params.leaves:
        # leaves of the tree as taken so far: the root, and children of taken splits, that aren't taken
        leaves = [0] if not nodes[0].taken else [c for n in nodes if n.taken for c in (n.left, n.left + 1) if not nodes[c].taken]
        ready = [i for i in leaves if nodes[i].best is not None and not deep(nodes[i])]
        if not ready:
            return []
        top = max(ready, key=lambda i: (nodes[i].best[0], -i))
        if nodes[top].left < 0 and growth.leaves + 1 < params.leaves:
            # its children are not measured: measure those of the most promising leaves
            wanted = []
            ahead = [i for i in range(len(nodes)) if nodes[i].left < 0 and nodes[i].best is not None and not deep(nodes[i])]
            for i in sorted(ahead, key=lambda i: (i != top, -nodes[i].best[0], i))[:min(AHEAD, params.leaves - growth.leaves)]:
                wanted += _split(nodes, i)
            return wanted
        if nodes[top].left < 0:
            _split(nodes, top)
        nodes[top].taken = True
        growth.leaves += 1
    return []


def _split(nodes: list[Node], i: int) -> list[int]:
    node = nodes[i]
    _, _, _, gradient, rows = node.best
    node.left = len(nodes)
    nodes.append(Node(gradient, rows, node.depth + 1))
    nodes.append(Node(node.gradient - gradient, node.rows - rows, node.depth + 1))
    return [node.left, node.left + 1]


def _finished(growth: Growth) -> dict[str, np.ndarray]:
    """The taken part of the tree, numbered anew from the root; values of leaves include the learning rate."""
    nodes, params = growth.nodes, growth.job.params
    order, out = [0], {c: [] for c in ("left", "column", "bin", "gain", "rows", "value")}
    for i in order:
        node = nodes[i]
        out["left"].append(len(order) if node.taken else -1)
        for c, v in (("column", 1), ("bin", 2), ("gain", 0)):
            out[c].append(node.best[v] if node.taken else 0)
        out["rows"].append(node.rows)
        out["value"].append(0.0 if node.taken else -params.learning_rate * float(shrunk(node.gradient, params.l1)) / (node.rows + params.l2) if node.rows else 0.0)
        if node.taken:
            order += [node.left, node.left + 1]
    kinds = {"gain": float, "value": float, "rows": np.int64}
    return {c: np.array(v, kinds.get(c, np.int32)) for c, v in out.items()}


def train(
    data: Binned, jobs: Sequence[Job], after_round: Callable[[int, dict[int, tuple[float, float | None]]], set[int]] | None = None
) -> tuple[list[Growth], list[tuple[int, int, float, float | None]]]:
    """Train all jobs side by side.

    Returns the grown models, and (job, trees, mean squared error of the training rows, of the judged rows) after every
    round.  ``after_round`` gets the errors by job after each number of trees and names the jobs that stop there.
    """
    growths = [Growth(j, data.means[j.target]) for j in jobs]
    place = {t: i for i, t in enumerate(data.targets)}
    wide, deep = len(data.features), max((len(e) + 1 for e in data.edges), default=1)
    blocks, stored, errors, round_ = data.blocks, False, [], 0

    def task(i: int, tree: dict[str, np.ndarray], wanted: list[int]) -> Task:
        g = growths[i]
        return Task(g.job, g.base, place[g.job.target], i if stored else None, g.trees[g.stored:], round_, tree, wanted)

    live = list(range(len(growths)))
    while live:
        for i in live:
            growths[i].nodes, growths[i].leaves = [Node()], 1
        wanted = {i: [0] for i in live}
        while wanted:
            names = list(wanted)
            tasks = [task(i, _as_arrays(growths[i].nodes), wanted[i]) for i in names]
            sums = blocks.mapInArrow(_sums(tasks, wide, len(data.targets), deep), "task bigint, node bigint, first bigint, sums binary")
            found = sums.groupBy("task", "node", "first").applyInArrow(
                _found([t.job for t in tasks], [t.round for t in tasks], wide, deep), _FOUND
            ).collect()  # a row for each leaf and group of columns
            now = {}
            for row in sorted(found, key=lambda r: (r["node"], r["first"])):
                i = names[row["task"]]
                if row["node"] < 0:
                    judged = row["judged_gradient"] / row["judged_rows"] if row["judged_rows"] else None
                    now[i] = (row["gradient"] / max(1, row["rows"]), judged)
                    errors.append((i, len(growths[i].trees), *now[i]))
                    continue
                node = growths[i].nodes[row["node"]]
                node.gradient, node.rows = row["gradient"], row["rows"]
                if row["gain"] is not None and (node.best is None or row["gain"] > node.best[0]):
                    node.best = (row["gain"], row["column"], row["bin"], row["left_gradient"], row["left_rows"])
            if now:
                ended = {i for i in live if len(growths[i].trees) >= growths[i].job.params.rounds}
                for i in (after_round(round_, now) if after_round else set()) - ended:
                    growths[i].stopped = True
                    ended.add(i)
                live = [i for i in live if i not in ended]
                names = [i for i in names if i in live]
            wanted = {i: more for i in names if (more := _grow(growths[i]))}
        for i in live:
            growths[i].trees.append(_finished(growths[i]))
        round_ += 1
        if live and round_ % REWRITE == 0:
            everyone = [task(i, {}, []) for i in range(len(growths))]
            blocks = written(
                blocks.mapInArrow(
                    _restored(everyone, wide, len(data.targets)), "block bigint, n bigint, binned binary, known binary, judged binary, stored binary"
                ),
                "blocks",
            )
            stored = True
            for g in growths:
                g.stored = len(g.trees)
    return growths, errors


# --- trees as tables -------------------------------------------------------------------------------


def nodes_table(spark: SparkSession, data: Binned, growths: Sequence[Growth]) -> DataFrame:
    """A row for each node; node -1 of round -1 holds the value that all trees start from.

    A row whose feature is at most the threshold, or missing, goes left.  ``gain`` is 0 and feature null at leaves.
    """
    rows = []
    for g in growths:
        rows.append((g.job.model, g.job.target, -1, -1, None, None, None, None, 0.0, data.rows, float(g.base)))
        for t, tree in enumerate(g.trees):
            for n in range(len(tree["left"])):
                left = int(tree["left"][n])
                column = int(tree["column"][n])
                rows.append((
                    g.job.model, g.job.target, t, n, data.features[column] if left >= 0 else None,
                    float(data.edges[column][int(tree["bin"][n])]) if left >= 0 else None, left if left >= 0 else None,
                    left + 1 if left >= 0 else None, float(tree["gain"][n]), int(tree["rows"][n]), float(tree["value"][n]),
                ))
    return spark.createDataFrame(rows, NODES)


def importance(nodes: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    """(model, target, feature, splits, gain, rank): how often and with what gain each feature splits, by splits.

    With ``features`` those that never split are listed with 0.  Equal counts are ranked by gain, then by name.
    """
    from pyspark.sql.window import Window

    key = ["model", "target"]
    counts = nodes.where("feature is not null").groupBy(*key, "feature").agg(F.count("*").alias("splits"), F.sum("gain").alias("gain"))
    if features is not None:
        every = nodes.where("round < 0").select(*key, F.explode(F.array(*[F.lit(f) for f in features])).alias("feature"))
        counts = every.join(counts, [*key, "feature"], "left").select(
            *key, "feature", F.coalesce("splits", F.lit(0)).alias("splits"), F.coalesce("gain", F.lit(0.0)).alias("gain")
        )
    order = Window.partitionBy(*key).orderBy(F.desc("splits"), F.desc("gain"), "feature")  # a row a column
    return counts.withColumn("rank", F.row_number().over(order))


@dataclass
class Trees:
    """The trees of one model and target, for scoring: all nodes in arrays, the trees one after the other."""

    base: float
    roots: list[int]
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray

    def predict(self, columns: np.ndarray) -> np.ndarray:
        out = np.full(columns.shape[1], self.base)
        for root in self.roots:
            at = np.full(columns.shape[1], root)
            open_ = np.arange(columns.shape[1])
            while len(open_):
                open_ = open_[self.left[at[open_]] >= 0]
                node = at[open_]
                right = columns[self.feature[node], open_] > self.threshold[node]  # missing values go left
                at[open_] = self.left[node] + right
            out += self.value[at]
        return out


def read_trees(nodes: DataFrame, features: Sequence[str]) -> dict[tuple[str, str], Trees]:
    """Trees of each (model, target); nodes are bounded by models, rounds and leaves, so they come to the driver."""
    place = {f: i for i, f in enumerate(features)}
    rows: dict[tuple[str, str], list] = {}
    for r in nodes.orderBy("model", "target", "round", "node").collect():
        rows.setdefault((r.model, r.target), []).append(r)
    out = {}
    for key, own in rows.items():
        base = sum(r.value for r in own if r.round < 0)
        own = [r for r in own if r.round >= 0]
        roots = [i for i, r in enumerate(own) if r.node == 0]
        first = np.repeat(roots, np.diff([*roots, len(own)])) if roots else np.zeros(0, int)
        missing = sorted({r.feature for r in own if r.feature is not None} - set(place))
        if missing:
            raise ValueError(f"missing columns: {', '.join(missing)}")
        out[key] = Trees(
            base, roots, np.array([place.get(r.feature, 0) for r in own], np.int32),
            np.array([r.threshold if r.threshold is not None else 0.0 for r in own]),
            np.array([int(f) + r.left if r.left is not None else -1 for f, r in zip(first, own)], np.int32), np.array([r.value for r in own], float),
        )
    return out


def score(df: DataFrame, nodes: DataFrame, features: Sequence[str], keep: Sequence[str], name: Callable[[str, str], str] | None = None) -> DataFrame:
    """``keep`` columns and a prediction column for each model and target (by default named like the target)."""
    trees = read_trees(nodes, features)
    names = [name(*k) if name else k[1] for k in trees]
    kept, kept_names = len(keep), list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = np.stack([
                batch.column(kept + i).to_numpy(zero_copy_only=False).astype(float) for i in range(len(features))
            ]) if features else np.zeros((0, batch.num_rows))
            made = [pa.array(t.predict(columns)) for t in trees.values()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:kept], *made], [*kept_names, *names])

    rows = nan_free(df, list(features)).select(*keep, *[F.col(f"`{c}`").cast("double").alias(f"__f{i}") for i, c in enumerate(features)])
    schema = ", ".join([*[f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep], *[f"`{n}` double" for n in names]])
    return rows.mapInArrow(run, schema)


def params_json(params: Params) -> str:
    return json.dumps(dataclasses.asdict(params), sort_keys=True)
