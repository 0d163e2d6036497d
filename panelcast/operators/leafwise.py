"""Gradient boosting with trees that grow leaf by leaf, on histograms of binned columns.

Columns are cut into bins once, at approximate quantiles, and the binned rows are written. A tree
grows by splitting the leaf of highest gain until it has ``leaves`` of them. Its splits are
chosen on the driver from histograms (sums of gradients and row counts per node, column
and bin), whose size depends on the model's settings and not on the rows; the rows stay where
they are, and a task adds up the histograms of its rows before they are shuffled.

One pass over the rows serves every leaf that might be split next, all folds at once: the
children of all leaves that could still be split are counted together, the smaller child of
each from its rows and the larger by subtraction. The tree is the one that splitting strictly
one leaf at a time would give, with as many passes as it has levels. A fold that is done with
a tree goes on to its next one; it does not wait for the others.

Scores of rows are written every ``REWRITE`` trees of a fold; between that tasks add the trees
since. Rounds end ``patience`` trees after the lowest loss on the validation rows, and only
the trees up to it stay.

Cases: nulls are filled by the caller; values beyond the training bins fall into the outer
bins, categories unknown to a split go right; a fold without training rows gets no model; one
without validation rows keeps all rounds; equal gains go to the first column and bin.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.operators.encode import apply_label, fit_label
from panelcast.operators.features import features_of, fill_constants, split_features
from panelcast.operators.folds import Fold, assign_test_fold
from panelcast.operators.trees import IDS, cut_date, with_ids
from panelcast.operators.tree_shapley import Ensemble
from panelcast.session import materialize

ROUNDS, LEAVES, BINS, RATE, PATIENCE, MIN_ROWS = 1000, 31, 255, 0.05, 100, 20
REWRITE = 8
# Histograms on their way: one row per task, fold and node, bins as byte strings.
HISTOGRAM = ["fold", "node", "n", "g"]
EPOCH = dt.date(1970, 1, 1)


def days(d) -> int:
    return (dt.date.fromisoformat(str(d)) - EPOCH).days


@dataclass
class Columns:
    """Cut points of numbers and sizes of categories; where each column's bins start."""

    cuts: list[np.ndarray | None]
    sizes: list[int]

    def __post_init__(self):
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)

    def bins(self, x: np.ndarray) -> np.ndarray:
        """Bin numbers, one column each: numbers up to a cut fall below it."""
        out = np.empty(x.shape, np.uint16)
        for k, cuts in enumerate(self.cuts):
            column = x[:, k] if cuts is None else np.searchsorted(cuts, x[:, k], side="left")
            out[:, k] = np.clip(column, 0, self.sizes[k] - 1)
        return out


def fit_columns(df: DataFrame, features: list[str], categories: dict[str, int], bins: int = BINS) -> Columns:
    """Bins of every column from one pass; ``categories`` gives the sizes of columns of codes."""
    numbers = [c for c in features if c not in categories]
    shares = [k / bins for k in range(1, bins)]
    found = df.agg(*[F.percentile_approx(F.col(c).cast("double"), shares, 10_000).alias(c) for c in numbers]).first() if numbers else {}
    cuts = [None if c in categories else np.unique(np.array(found[c] or [], float)) for c in features]
    return Columns(cuts, [categories[c] if k is None else len(k) + 1 for c, k in zip(features, cuts)])


@dataclass
class Split:
    gain: float
    column: int
    left: np.ndarray  # which bins of the column go left
    n_left: int


@dataclass
class Node:
    n: int = 0
    gradient: float = 0.0
    counts: np.ndarray | None = None  # rows and gradients by bin
    split: Split | None = None
    children: tuple[int, int] | None = None


def best_split(counts: np.ndarray, columns: Columns, min_rows: int) -> Split | None:
    """The split of highest gain of a node's histogram; categories are ordered by mean gradient."""
    best = None
    for k, size in enumerate(columns.sizes):
        n, g = counts[:, columns.starts[k]:columns.starts[k] + size]
        order = np.arange(size)
        if columns.cuts[k] is None:
            seen = np.flatnonzero(n > 0)
            order = seen[np.argsort(g[seen] / n[seen], kind="stable")]
        n_left, g_left = np.cumsum(n[order])[:-1], np.cumsum(g[order])[:-1]
        total, slope = n.sum(), g.sum()
        n_right, g_right = total - n_left, slope - g_left
        fits = (n_left >= min_rows) & (n_right >= min_rows)
        if not fits.any():
            continue
        gain = np.where(fits, g_left**2 / np.maximum(n_left, 1) + g_right**2 / np.maximum(n_right, 1), -np.inf) - slope**2 / total
        at = int(gain.argmax())
        if gain[at] > 1e-12 * (1 + abs(slope**2 / total)) and (best is None or gain[at] > best.gain):
            left = np.zeros(size, bool)
            left[order[:at + 1]] = True
            best = Split(float(gain[at]), k, left, int(n_left[at]))
    return best


@dataclass
class Growing:
    """One fold's model: finished trees and the tree that grows."""

    columns: Columns
    rounds: int
    leaves: int
    patience: int
    min_rows: int
    start: float = 0.0
    trees: list[list[Node]] = field(default_factory=list)
    nodes: list[Node] = field(default_factory=lambda: [Node()])
    wanted: dict[int, int] = field(default_factory=dict)  # node to count -> its sibling
    best_loss: float = float("inf")
    best_trees: int = 0
    done: bool = False

    def receive(self, counts: dict[int, np.ndarray], loss: tuple[float, int] | None) -> None:
        """Histograms of the wanted nodes; the loss on validation rows if a tree begins."""
        if len(self.nodes) == 1 and loss is not None and loss[1]:
            if loss[0] / loss[1] < self.best_loss:
                self.best_loss, self.best_trees = loss[0] / loss[1], len(self.trees)
            elif len(self.trees) - self.best_trees >= self.patience:
                self.done = True
        if len(self.nodes) == 1 and len(self.trees) >= self.rounds:
            self.done = True
        if self.done:
            return
        empty = np.zeros((2, int(self.columns.starts[-1])))
        if len(self.nodes) == 1:
            self.settle(0, counts.get(0, empty))
        parent = {c: n for n in self.nodes if n.children for c in n.children}
        for k, other in self.wanted.items():
            own = counts.get(k, empty)
            self.settle(k, own)
            self.settle(other, parent[other].counts - own)
        self.wanted = {}
        self.choose()

    def settle(self, k: int, counts: np.ndarray) -> None:
        node, first = self.nodes[k], slice(0, self.columns.sizes[0])
        node.counts, node.n, node.gradient = counts, int(round(counts[0][first].sum())), float(counts[1][first].sum())
        node.split = best_split(counts, self.columns, self.min_rows) if node.n else None

    def choose(self) -> None:
        """Split known leaves, best first; ask for children where they are not known."""
        leaves, split = [0], set()
        while len(leaves) < self.leaves:
            able = [k for k in leaves if self.nodes[k].split]
            if not able:
                break
            k = max(able, key=lambda i: (self.nodes[i].split.gain, -i))
            if self.nodes[k].children is None:
                able.sort(key=lambda i: (-self.nodes[i].split.gain, i))
                for i in able[:self.leaves - len(leaves)]:
                    if self.nodes[i].children is None:
                        self.ask(i)
                return
            split.add(k)
            leaves.remove(k)
            leaves += self.nodes[k].children
        self.finish(split)

    def ask(self, k: int) -> None:
        node, at = self.nodes[k], len(self.nodes)
        self.nodes += [Node(), Node()]
        node.children = (at, at + 1)
        smaller = node.split.n_left * 2 <= node.n
        self.wanted[at if smaller else at + 1] = at + 1 if smaller else at

    def finish(self, split: set[int]) -> None:
        if not split:  # nothing left to gain
            self.done = True
            return
        for k, node in enumerate(self.nodes):
            node.counts = None
            if k not in split:
                node.children = None
        self.trees.append(self.nodes)
        self.nodes, self.wanted = [Node()], {}

    def kept(self) -> list[list[Node]]:
        """The trees up to the lowest validation loss; all without validation rows."""
        return self.trees[:self.best_trees] if np.isfinite(self.best_loss) else self.trees


def route(nodes: list[Node], bins: np.ndarray) -> np.ndarray:
    """The node each row ends in."""
    at = np.zeros(len(bins), np.int64)
    waiting = [(0, np.arange(len(bins)))]
    while waiting:
        k, rows = waiting.pop()
        node = nodes[k]
        if node.children is None:
            at[rows] = k
            continue
        left = node.split.left[bins[rows, node.split.column]]
        waiting += [(node.children[0], rows[left]), (node.children[1], rows[~left])]
    return at


def score(trees: list[list[Node]], bins: np.ndarray, rate: float) -> np.ndarray:
    total = np.zeros(len(bins))
    for nodes in trees:
        values = np.array([-rate * n.gradient / n.n if n.n else 0.0 for n in nodes])
        total += values[route(nodes, bins)]
    return total


def _matrix(batch, name: str, dtype, width: int) -> np.ndarray:
    """A column of byte strings as rows of numbers."""
    return np.frombuffer(b"".join(batch.column(name).to_pylist()), dtype).reshape(-1, width)


def histograms(state: DataFrame, spans: list, work: list, columns: Columns, rate: float) -> tuple[list[dict], list]:
    """(histograms by node, validation loss) of every fold, from one pass over the rows.

    ``spans`` has (first day, cut, last day) per fold: rows after the cut validate. ``work`` has
    (trees since the scores were written, growing nodes, nodes to count) or None per fold.
    """
    total = int(columns.starts[-1])
    shared = state.sparkSession.sparkContext.broadcast((spans, work))

    def run(batches):
        spans, work = shared.value
        slots = {}
        for k, job in enumerate(work):
            for node in job[2] if job else ():
                slots[k, node] = len(slots)
        counts, losses = np.zeros((2, len(slots) * total)), np.zeros((len(spans), 2))
        for batch in batches:
            bins = _matrix(batch, "bins", "<u2", len(columns.sizes))
            scores = _matrix(batch, "scores", "<f8", len(spans))
            target, day = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "day"))
            flat = bins.astype(np.int64) + columns.starts[:-1]
            for k, job in enumerate(work):
                if job is None:
                    continue
                recent, nodes, wanted = job
                first, cut, last = spans[k]
                inside = np.flatnonzero((day >= first) & (day <= last))
                gradient = scores[inside, k] + score(recent, bins[inside], rate) - target[inside]
                late = day[inside] > cut
                losses[k] += (float((gradient[late] ** 2).sum()), int(late.sum()))
                rows, gradient = inside[~late], gradient[~late]
                place = np.full(len(nodes), -1)
                for node in wanted:
                    place[node] = slots[k, node]
                slot = place[route(nodes, bins[rows])]
                hit = slot >= 0
                rows, gradient, slot = rows[hit], gradient[hit], slot[hit]
                cells = (flat[rows] + slot[:, None] * total).ravel()
                counts[0] += np.bincount(cells, minlength=counts.shape[1])
                counts[1] += np.bincount(cells, weights=np.repeat(gradient, bins.shape[1]), minlength=counts.shape[1])
        parts = counts.reshape(2, len(slots), total)
        sums = [*zip(slots, parts[0], parts[1]), *(((k, -1), loss[1:], loss[:1]) for k, loss in enumerate(losses))]
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0] for key, _, _ in sums], pa.int32()), pa.array([key[1] for key, _, _ in sums], pa.int32()),
             *(pa.array([part[i].tobytes() for part in sums], pa.binary()) for i in (1, 2))], names=HISTOGRAM)

    def added(table):
        n, g = (np.sum([np.frombuffer(x, "<f8") for x in table.column(c).to_pylist()], axis=0).tobytes() for c in HISTOGRAM[2:])
        return pa.table([*(table.column(c)[:1] for c in HISTOGRAM[:2]), pa.array([n], pa.binary()), pa.array([g], pa.binary())],
                        names=HISTOGRAM)

    schema = "fold int, node int, n binary, g binary"
    found = state.mapInArrow(run, schema).groupBy("fold", "node").applyInArrow(added, schema).collect()
    made: list[dict] = [{} for _ in spans]
    losses: list = [None] * len(spans)
    for r in found:
        n, g = np.frombuffer(r["n"], "<f8"), np.frombuffer(r["g"], "<f8")
        if r["node"] < 0:
            losses[r["fold"]] = (float(g[0]), int(n[0]))
        else:
            made[r["fold"]][r["node"]] = np.stack([n, g])
    return made, losses


def rescored(state: DataFrame, models: list[Growing], since: list[int], rate: float) -> DataFrame:
    """``state`` with the trees since the last time in its scores, written."""
    recent = [m.trees[at:] for m, at in zip(models, since)]
    width = len(models[0].columns.sizes)
    shared = state.sparkSession.sparkContext.broadcast(recent)

    def run(batches):
        for batch in batches:
            bins = _matrix(batch, "bins", "<u2", width)
            scores = _matrix(batch, "scores", "<f8", len(recent)) + np.stack([score(t, bins, rate) for t in shared.value], axis=1)
            packed = [row.tobytes() for row in scores.astype("<f8")]
            at = batch.schema.names.index("scores")
            yield batch.set_column(at, "scores", pa.array(packed, pa.binary()))

    return materialize(state.mapInArrow(run, state.schema), "boosting_scores")


def fit(df: DataFrame, features: list[str], categories: dict[str, int], folds: list[Fold], y: str = "sales", date: str = "date",
        rounds: int = ROUNDS, leaves: int = LEAVES, bins: int = BINS, rate: float = RATE, patience: int = PATIENCE,
        min_rows: int = MIN_ROWS) -> dict[int, list[dict]]:
    """Fold -> node rows (see ``tree_shapley``) of squared-loss boosting, one model a fold.

    ``df`` is materialized, holds numbers only in ``features``, and categories as codes from 0.
    """
    columns = fit_columns(df, features, categories, bins)
    daily = {r[date]: (r["n"], r["s"]) for r in df.where(F.col(y).isNotNull()).groupBy(date).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(y).cast("double")).alias("s")).collect()}  # a row per day
    spans, models = [], []
    for fold in folds:
        cut = cut_date({d: n for d, (n, _) in daily.items()}, fold)
        first, last = days(fold[1]), days(fold[2])
        spans.append((first, last if cut is None else days(cut), last))
        inside = [v for d, v in daily.items() if d is not None and first <= days(d) <= spans[-1][1]]
        n = sum(c for c, _ in inside)
        models.append(Growing(columns, rounds, leaves, patience, min_rows, sum(s for _, s in inside) / n if n else 0.0, done=not n))
    starts = np.array([m.start for m in models], "<f8").tobytes()

    def binned(batches):
        for batch in batches:
            x = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(len(features))], axis=1)
            packed = [row.tobytes() for row in columns.bins(x).astype("<u2")]
            yield pa.RecordBatch.from_arrays([batch.column("y"), batch.column("day"), pa.array(packed, pa.binary()),
                                              pa.array([starts] * len(x), pa.binary())], names=["y", "day", "bins", "scores"])

    numbers = df.where(F.col(y).isNotNull()).select(
        *[F.col(c).cast("double").alias(f"x{k}") for k, c in enumerate(features)], F.col(y).cast("double").alias("y"),
        F.datediff(date, F.lit("1970-01-01").cast("date")).alias("day"))
    state = materialize(numbers.mapInArrow(binned, "y double, day int, bins binary, scores binary"), "boosting_rows")
    since = [0] * len(models)
    while not all(m.done for m in models):
        if any(not m.done and len(m.trees) - at >= REWRITE for m, at in zip(models, since)):
            state = rescored(state, models, since, rate)
            since = [len(m.trees) for m in models]
        work = [None if m.done else (m.trees[at:], [slim(n) for n in m.nodes], list(m.wanted) or [0])
                for m, at in zip(models, since)]
        made, losses = histograms(state, spans, work, columns, rate)
        for m, counts, loss in zip(models, made, losses):
            if not m.done:
                m.receive(counts, loss)
    return {fold[0]: node_rows(m, rate) for fold, m in zip(folds, models)}


def slim(node: Node) -> Node:
    """A node as tasks need it: without its histogram."""
    return Node(node.n, node.gradient, None, node.split, node.children)


def node_rows(model: Growing, rate: float) -> list[dict]:
    """A model as node rows: a tree of one leaf for the start, then its trees."""
    blank = {"threshold": None, "categories": None, "left": -1, "right": -1, "feature": -1}
    out = [{**blank, "tree": 0, "weight": 1.0, "node": 0, "value": model.start, "cover": 1.0}]
    for t, nodes in enumerate(model.kept(), 1):
        waiting = [0]
        while waiting:
            k = waiting.pop()
            node = nodes[k]
            row = {**blank, "tree": t, "weight": rate, "node": k, "value": -node.gradient / max(node.n, 1), "cover": float(node.n)}
            if node.children is not None:
                s = node.split
                cuts = model.columns.cuts[s.column]
                row |= {"feature": s.column, "left": node.children[0], "right": node.children[1]}
                if cuts is None:
                    row["categories"] = [float(c) for c in np.flatnonzero(s.left)]
                else:
                    row["threshold"] = float(cuts[int(s.left.sum()) - 1])
                waiting += node.children
            out.append(row)
    return out


def predict(df: DataFrame, models: dict[int, list[dict]], features: list[str], keys: list[str], fold: str = "fold") -> DataFrame:
    """(keys, fold, y_pred) of rows that name their fold; a fold without model gives null."""
    shared = df.sparkSession.sparkContext.broadcast(models)

    def run(batches):
        ensembles = {f: Ensemble(rows) for f, rows in shared.value.items()}
        for batch in batches:
            x = np.stack([batch.column(f"x{k}").to_numpy(zero_copy_only=False) for k in range(len(features))], axis=1)
            of = batch.column("fold").to_numpy(zero_copy_only=False)
            out = np.full(len(x), np.nan)
            for f, ensemble in ensembles.items():
                rows = np.flatnonzero(of == f)
                if len(rows):
                    out[rows] = ensemble.predict(x[rows])
            kept = [batch.column(i) for i in range(len(keys) + 1)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(out, mask=np.isnan(out))], names=[*batch.schema.names[:len(kept)], "y_pred"])

    rows = df.select(*[F.col(f"`{k}`") for k in keys], F.col(fold).cast("int").alias("fold"),
                     *[F.col(c).cast("double").alias(f"x{k}") for k, c in enumerate(features)])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:len(keys) + 1])
    return rows.mapInArrow(run, f"{fields}, y_pred double")


def prepare(df: DataFrame, y: str = "sales", text_fill: str = "missing") -> tuple[DataFrame, list[str], dict[str, int]]:
    """(coded rows, features, category sizes): numbers with 0 for null, texts as codes over all rows."""
    features = features_of(df, [y, "date"])
    _, text = split_features(df.select(*features), [])
    filled = materialize(with_ids(fill_constants(df, 0, text_fill, subset=features)), "leafwise_input")
    mapping = materialize(fit_label(filled, text), "codes")
    sizes = {r["feature"]: r["count"] for r in mapping.groupBy("feature").count().collect()}
    return materialize(apply_label(filled, mapping, text), "leafwise_codes"), features, sizes


def leafwise_oof(df: DataFrame, folds: list[Fold], y: str = "sales", text_fill: str = "missing", **settings) -> DataFrame:
    """(date, store_nbr, family, fold, y_true, y_pred) of the test rows of every fold."""
    coded, features, sizes = prepare(df, y, text_fill)
    models = fit(coded, features, sizes, folds, y, **settings)
    tests = assign_test_fold(coded, folds).where("fold is not null")
    scored = predict(tests, models, features, [*IDS, y])
    return scored.select(*[F.col(i).alias(i.removeprefix("id_")) for i in IDS], "fold", F.col(y).alias("y_true"), "y_pred")
