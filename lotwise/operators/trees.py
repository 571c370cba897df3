"""Decision trees with many outputs, for forests and boosting.

A leaf holds one mean per output, and a split is judged by the squares it saves, summed over all outputs, so one ensemble serves
all horizons. Inputs are binned once, at cut points from a bounded sample of rows; a row then is one byte per input.

Nodes with many rows are split from histograms: each task sums rows, weights and weighted targets by (node, input, bin), the sums
are added up in the JVM, and only the best split of each node reaches the driver. Nodes that share a pass are limited by the
memory of their histograms. Once a node has at most ``LOCAL_ROWS`` rows, these go to one task that finishes the subtree: lower
levels would have more histogram cells than rows. Both ways take the same sums and find the same splits.

Forests draw each row's weight for each tree, and each node's inputs, from hashes, so that a task which is run again draws the same.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from lotwise.session import stored

# The task functions below travel by value, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BINS = 32
CUT_ROWS = 10_000        # rows, about, that cut points are taken from
LOCAL_ROWS = 20_000      # rows of a node that one task finishes
PASS_BYTES = 64 << 20    # histograms that a task holds at a time
STORED_ROUNDS = 10       # boosting rounds between two writings of the residuals

_NODE = "grp int, tree int, node int, feature int, bin int, value binary"
_POISSON = np.cumsum([0.36787944117144233 / f for f in (1, 1, 2, 6, 24, 120, 720, 5040, 40320)])

Top = dict[tuple[int, int], dict[int, tuple[int, int]]]   # splits so far: (group, tree) -> node -> (input, bin)


@dataclass(frozen=True)
class Growth:
    """How trees grow; nodes are numbered 1 for the root, 2n and 2n + 1 for the sides of n."""

    inputs: int
    outputs: int
    depth: int
    per_node: int          # inputs that a node may split on
    bootstrap: bool
    seed: int

    def picked(self, group: int, tree: int, node: int) -> np.ndarray:
        if self.per_node >= self.inputs:
            return np.arange(self.inputs)
        draw = np.random.default_rng([self.seed, group & 0xFFFFFFFF, tree, node])
        return np.sort(draw.choice(self.inputs, self.per_node, replace=False))

    def weights(self, keys: np.ndarray, tree: int) -> np.ndarray:
        """Times that each row is drawn for a tree (Poisson, mean 1)."""
        if not self.bootstrap:
            return np.ones(len(keys))
        u = np.uint64
        h = keys.astype(np.int64).view(u) ^ u((self.seed * 0x9E3779B97F4A7C15 + tree * 0xD6E8FEB86659FD93) % (1 << 64))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            h = (h ^ (h >> u(shift))) * u(factor)
        return np.searchsorted(_POISSON, (h ^ (h >> u(31))).astype(float) / 2.0 ** 64, side="right").astype(float)


def _matrix(column: pa.Array, kind) -> np.ndarray:
    """A column of equally long binary values as the rows of a matrix."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), kind).reshape(len(values), -1)


def _walk(bins: np.ndarray, splits: dict[int, tuple[int, int]]) -> np.ndarray:
    """The node that each row reaches."""
    node = np.ones(len(bins), np.int64)
    for n in sorted(splits):   # a node's number is larger than its parent's
        feature, cut = splits[n]
        here = np.flatnonzero(node == n)
        node[here] = 2 * n + (bins[here, feature] > cut)
    return node


def _histogram(bins: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """(input, bin, figure): each column of ``sums`` added up by the bins of each input."""
    n, width = bins.shape
    cells = (bins + np.arange(width) * BINS).ravel()
    return np.stack([np.bincount(cells, np.repeat(s, width), width * BINS) for s in sums.T], axis=-1).reshape(width, BINS, -1)


def _best(histogram: np.ndarray) -> tuple[float, int, int, np.ndarray] | None:
    """(score, place of the input, bin, figures of the lower side) of the split that saves most, if any does.

    The figures are rows, weight, and weighted targets.
    """
    low = np.cumsum(histogram, axis=1)
    total, low = low[:, -1:, :], low[:, :-1, :]
    high = total - low
    with np.errstate(divide="ignore", invalid="ignore"):
        score = (low[..., 2:] ** 2).sum(-1) / low[..., 1] + (high[..., 2:] ** 2).sum(-1) / high[..., 1]
    score[(low[..., 0] < 0.5) | (high[..., 0] < 0.5)] = -np.inf
    # Splits that part the rows alike differ by the order of their sums only: at thirty bits they tie, and the first one is taken.
    part, power = np.frexp(score)
    score = np.ldexp(np.round(part * 2.0 ** 30), power - 30)
    base = (total[0, 0, 2:] ** 2).sum() / total[0, 0, 1]
    place = int(score.argmax())
    if not score.flat[place] > base * (1 + 1e-9) + 1e-12:
        return None
    f, b = divmod(place, BINS - 1)
    return float(score[f, b]), f, b, low[f, b]


def _figures(weights: np.ndarray, targets: np.ndarray) -> np.ndarray:
    return np.hstack([np.ones((len(weights), 1)), weights[:, None], weights[:, None] * targets])


def _finish(growth: Growth) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Grows the subtree of one node from its rows."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("key")   # sums do not depend on the order of arrival
        group, tree, first = (int(rows[c].iloc[0]) for c in ("grp", "tree", "node"))
        bins = np.frombuffer(b"".join(rows["bins"]), np.uint8).reshape(len(rows), -1)
        figures = _figures(rows["w"].to_numpy(), np.frombuffer(b"".join(rows["y"])).reshape(len(rows), -1))
        chunk = max(1, (8 << 20) // len(rows))
        shared = growth.per_node >= growth.inputs   # a node's histogram then is the sum of those of its sides

        def summed(here: np.ndarray, picked: np.ndarray) -> np.ndarray:
            sub, mine = bins[here], figures[here]
            return np.concatenate([_histogram(sub[:, picked[at:at + chunk]], mine) for at in range(0, len(picked), chunk)])

        def open_at(node: int, here: np.ndarray) -> bool:
            return node.bit_length() <= growth.depth and len(here) > 1

        out, waiting = [], [(first, np.arange(len(rows)), None)]
        while waiting:
            node, here, histogram = waiting.pop()
            total, best = figures[here].sum(0), None
            if open_at(node, here):
                picked = growth.picked(group, tree, node)
                histogram = summed(here, picked) if histogram is None else histogram
                best = _best(histogram)
            feature = int(picked[best[1]]) if best else -1
            out.append((group, tree, node, feature, best[2] if best else 0, (total[2:] / total[1]).tobytes()))
            if best:
                above = bins[here, feature] > best[2]
                sides = [(2 * node, here[~above]), (2 * node + 1, here[above])]
                few, many = sorted(sides, key=lambda side: len(side[1]))
                known = {}
                if shared and open_at(*many):
                    known[few[0]] = summed(few[1], picked)
                    known[many[0]] = histogram - known[few[0]]
                waiting += [(*side, known.get(side[0])) for side in sides]
        return pd.DataFrame(out, columns=["grp", "tree", "node", "feature", "bin", "value"])
    return run


def _assigned(growth: Growth, trees: list[int], top: Top, wanted: set[tuple[int, int, int]],
              prepared: Callable[[np.ndarray, np.ndarray, int], np.ndarray]):
    """Rows of the wanted nodes, one batch for each tree: (group, tree, node, key, weight, bins, targets)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            if not batch.num_rows:
                continue
            groups = np.asarray(batch.column("grp"))
            keys = np.asarray(batch.column("key"))
            bins, targets = _matrix(batch.column("bins"), np.uint8), _matrix(batch.column("y"), np.float64)
            for group in np.unique(groups):
                mine = np.flatnonzero(groups == group)
                own_bins, own_keys = bins[mine], keys[mine]
                own = prepared(own_bins, targets[mine], int(group))
                for tree in trees:
                    nodes = _walk(own_bins, top.get((int(group), tree), {}))
                    weight = growth.weights(own_keys, tree)
                    for node in np.unique(nodes[weight > 0]):
                        if (int(group), tree, int(node)) in wanted:
                            here = (nodes == node) & (weight > 0)
                            yield int(group), tree, int(node), own_keys[here], weight[here], own_bins[here], own[here]
    return run


def _shipped(assigned):
    names = ["grp", "tree", "node", "key", "w", "bins", "y"]

    def run(batches):
        for group, tree, node, keys, weight, bins, targets in assigned(batches):
            n = len(keys)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, v, np.int32)) for v in (group, tree, node)] + [pa.array(keys), pa.array(weight)]
                + [pa.array([r.tobytes() for r in m], pa.binary()) for m in (bins, targets)], names)
    return run


def _summed(growth: Growth, places: dict[tuple[int, int, int], int], assigned):
    def run(batches):
        held: dict[tuple[int, int, int], np.ndarray] = {}
        for group, tree, node, _, weight, bins, targets in assigned(batches):
            key = group, tree, node
            part = _histogram(bins[:, growth.picked(*key)], _figures(weight, targets))
            held[key] = held[key] + part if key in held else part
        for key, sums in held.items():
            yield pd.DataFrame({"place": places[key], "input": growth.picked(*key), "sums": list(sums.reshape(len(sums), -1))})

    def arrow(batches):
        for frame in run(batches):
            yield pa.RecordBatch.from_pandas(frame.astype({"place": "int32", "input": "int32"}), preserve_index=False)
    return arrow


def _scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for place, feature, sums in batch.itertuples(index=False):
            histogram = np.asarray(sums).reshape(1, BINS, -1)
            best = _best(histogram)
            rows.append((place, best[0] if best else -1.0, -feature, best[2] if best else 0, histogram.sum((0, 1)).tolist(),
                         best[3].tolist() if best else None))
        yield pd.DataFrame(rows, columns=["place", "score", "order", "bin", "total", "low"])


def _split_pass(rows: DataFrame, growth: Growth, batch: list[tuple[int, int, int]], top: Top, prepared) -> dict:
    """Best split of each node of ``batch``: (input or None, bin, figures of the node, figures of the lower side)."""
    places = {key: i for i, key in enumerate(batch)}
    assigned = _assigned(growth, sorted({k[1] for k in batch}), top, set(batch), prepared)
    sums = (rows.mapInArrow(_summed(growth, places, assigned), "place int, input int, sums array<double>")
            .select("place", "input", array_to_vector("sums").alias("v")).groupBy("place", "input")
            .agg(Summarizer.metrics("sum").summary(F.col("v")).alias("s"))
            .select("place", "input", vector_to_array("s.sum").alias("sums")))
    scored = sums.mapInPandas(_scored, "place int, score double, `order` int, bin int, total array<double>, low array<double>")
    best = scored.groupBy("place").agg(F.max(F.struct("score", "order", "bin", "total", "low")).alias("b")).select("place", "b.*")
    return {batch[r["place"]]: (None if r["low"] is None else -r["order"], r["bin"], r["total"], r["low"]) for r in best.collect()}


def _value(figures: list[float]) -> bytes:
    return (np.asarray(figures[2:]) / figures[1]).tobytes()


def grow(rows: DataFrame, sizes: dict[int, int], trees: list[int], growth: Growth,
         prepared: Callable[[np.ndarray, np.ndarray, int], np.ndarray] = lambda bins, y, group: y) -> DataFrame:
    """Nodes of ``trees`` for each group of ``rows`` (grp, key, bins, y); ``sizes`` are the rows of each group.

    ``prepared`` turns stored targets into those to learn.
    """
    spark = rows.sparkSession
    top: Top = {}
    done: list[tuple] = []
    local: list[tuple[int, int, int]] = []
    waiting: list[tuple[int, int, int]] = []

    def sort_in(key: tuple[int, int, int], figures: list[float]) -> None:
        if key[2].bit_length() > growth.depth:
            done.append((*key, -1, 0, _value(figures)))
        else:
            (waiting if figures[0] > LOCAL_ROWS else local).append(key)

    for group, n in sizes.items():
        for tree in trees:
            sort_in((group, tree, 1), [n])
    at_once = max(1, PASS_BYTES // (growth.per_node * BINS * (growth.outputs + 2) * 8))
    while waiting:
        batch, waiting[:] = waiting[:at_once], waiting[at_once:]
        for key, (feature, cut, total, low) in _split_pass(rows, growth, batch, top, prepared).items():
            done.append((*key, -1 if feature is None else feature, cut, _value(total)))
            if feature is not None:
                top.setdefault(key[:2], {})[key[2]] = (feature, cut)
                sort_in((*key[:2], 2 * key[2]), low)
                sort_in((*key[:2], 2 * key[2] + 1), [t - x for t, x in zip(total, low, strict=True)])
    nodes = spark.createDataFrame(done, _NODE) if done else None
    if local:
        assigned = _assigned(growth, trees, top, set(local), prepared)
        kinds = "grp int, tree int, node int, key long, w double, bins binary, y binary"
        # Each group of rows is far more work than its size tells, so their number decides.
        shipped = rows.mapInArrow(_shipped(assigned), kinds).repartition(min(2 * len(local) - 1, 2000), "grp", "tree", "node")
        below = shipped.groupBy("grp", "tree", "node").applyInPandas(_finish(growth), _NODE)
        nodes = below if nodes is None else nodes.unionByName(below)
    return nodes


def cut_points(rows: DataFrame) -> list[np.ndarray]:
    """Up to BINS - 1 values per input of ``rows`` (key, x) at which about equally many rows lie; each is the top of its bin."""
    total = rows.count()
    share = min(1.0, CUT_ROWS / max(total, 1))
    sample = rows.where(F.pmod("key", F.lit(1 << 20)) < int(share * (1 << 20))) if share < 1 else rows

    def cuts(batches):
        parts = [np.asarray(b.column("x").flatten()).reshape(b.num_rows, -1) for b in batches if b.num_rows]
        if parts:
            x = np.sort(np.vstack(parts), axis=0)
            at = (np.arange(1, BINS) * len(x) + BINS - 1) // BINS - 1
            for column in x.T:
                own = np.unique(column)
                chosen = own if len(own) <= BINS else np.unique(column[at])
                yield pa.RecordBatch.from_arrays([pa.array([chosen[chosen < own[-1]].tolist()], pa.list_(pa.float64()))], ["cuts"])

    return [np.asarray(r[0]) for r in sample.select("x").coalesce(1).mapInArrow(cuts, "cuts array<double>").collect()]


def binned(rows: DataFrame, cuts: list[np.ndarray]) -> DataFrame:
    """(grp, key, bins, y) of ``rows`` (grp, key, x, targets): one byte per input, targets as doubles in a row."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                x = np.asarray(b.column("x").flatten()).reshape(b.num_rows, -1)
                y = np.asarray(b.column("targets").flatten()).reshape(b.num_rows, -1)
                bins = np.stack([np.searchsorted(c, x[:, k]) for k, c in enumerate(cuts)], axis=1).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [b.column("grp"), b.column("key"), *(pa.array([r.tobytes() for r in m], pa.binary()) for m in (bins, y))],
                    ["grp", "key", "bins", "y"])
    return rows.select("grp", "key", "x", "targets").mapInArrow(run, "grp int, key long, bins binary, y binary")


ENSEMBLE = "grp int, trees int, outputs int, features binary, cuts binary, below binary, `values` binary"


def packed(nodes: DataFrame, cuts: list[np.ndarray], factor: Callable[[int], float], outputs: int) -> DataFrame:
    """One row per group: all its trees as arrays over their nodes, roots first; ``below`` holds the places of both sides.

    ``factor`` is what a tree's values count in the sum over all trees. The size is bounded by trees x 2 ** depth, whatever the number of samples.
    """
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["tree", "node"])
        keys = list(zip(rows["tree"], rows["node"], strict=True))
        roots = [i for i, k in enumerate(keys) if k[1] == 1]
        order = roots + [i for i, k in enumerate(keys) if k[1] != 1]
        place = {keys[i]: p for p, i in enumerate(order)}
        features, bins = rows["feature"].to_numpy(), rows["bin"].to_numpy()
        inner = features >= 0
        limit = np.array([cuts[f][b] if f >= 0 else np.inf for f, b in zip(features, bins, strict=True)])
        sides = np.array([[place[t, 2 * n], place[t, 2 * n + 1]] if i else [p, p] for (t, n), i, p in
                          zip(keys, inner, (place[k] for k in keys), strict=True)], np.int32)
        scale = np.array([factor(t) for t, _ in keys])
        values = np.frombuffer(b"".join(rows["value"])).reshape(len(rows), -1) * scale[:, None]
        return pd.DataFrame({"grp": [int(rows["grp"].iloc[0])], "trees": [len(roots)], "outputs": [outputs],
                             "features": [np.maximum(features, 0)[order].astype(np.int32).tobytes()], "cuts": [limit[order].tobytes()],
                             "below": [sides[order].tobytes()], "values": [values[order].tobytes()]})
    return nodes.groupBy("grp").applyInPandas(run, ENSEMBLE)


def evaluated(x: np.ndarray, ensemble) -> np.ndarray:
    """(row, output): the sum over all trees of a packed ensemble."""
    features, cuts = np.frombuffer(ensemble["features"], np.int32), np.frombuffer(ensemble["cuts"])
    below = np.frombuffer(ensemble["below"], np.int32).reshape(-1, 2)
    values = np.frombuffer(ensemble["values"]).reshape(-1, ensemble["outputs"])
    out = np.zeros((len(x), values.shape[1]))
    for at in range(0, len(x), 1000):
        part = x[at:at + 1000]
        node = np.repeat(np.arange(ensemble["trees"])[None, :], len(part), axis=0)
        row = np.arange(len(part))[:, None]
        while True:
            after = below[node, (~(part[row, features[node]] <= cuts[node])).astype(np.int8)]
            if (after == node).all():
                break
            node = after
        out[at:at + 1000] = values[node].sum(1)
    return out


def _share(spec: float, inputs: int) -> int:
    return max(1, min(inputs, round(spec * inputs)))


def _outputs(rows: DataFrame) -> int:
    first = rows.select(F.size("targets")).first()
    return first[0] if first else 0


def forest(rows: DataFrame, trees: int, depth: int, seed: int, share: float, bootstrap: bool) -> DataFrame:
    """Packed forests of the groups of ``rows`` (grp, key, x, targets); no rows give no forest."""
    outputs = _outputs(rows)
    if not outputs:
        return rows.sparkSession.createDataFrame([], ENSEMBLE)
    cuts = cut_points(rows)
    data = stored(binned(rows, cuts), "binned")
    sizes = {r["grp"]: r["count"] for r in data.groupBy("grp").count().collect()}
    growth = Growth(len(cuts), outputs, depth, _share(share, len(cuts)), bootstrap, seed)
    nodes = grow(data, sizes, list(range(1, trees + 1)), growth)
    return packed(nodes, cuts, lambda tree: 1 / trees, outputs)


def boosting(rows: DataFrame, rounds: int, depth: int, step: float, seed: int) -> DataFrame:
    """Packed boosted ensembles of the groups of ``rows``: the means, then one tree per round that learns what is left.

    Residuals are written every STORED_ROUNDS rounds; in between tasks subtract the trees since then.
    """
    spark, outputs = rows.sparkSession, _outputs(rows)
    if not outputs:
        return spark.createDataFrame([], ENSEMBLE)
    cuts = cut_points(rows)
    means = rows.select("grp", array_to_vector("targets").alias("v")).groupBy("grp").agg(
        Summarizer.metrics("mean", "count").summary(F.col("v")).alias("s")).select("grp", vector_to_array("s.mean").alias("m"), "s.count").collect()
    sizes = {r["grp"]: r["count"] for r in means}
    growth = Growth(len(cuts), outputs, depth, len(cuts), False, seed)
    recent: dict[int, list[dict]] = {r["grp"]: [{1: (-1, 0, np.asarray(r["m"]))}] for r in means}
    found = [(r["grp"], 0, 1, -1, 0, np.asarray(r["m"]).tobytes()) for r in means]
    data = stored(binned(rows, cuts), "binned")

    def left(trees: dict[int, list[dict]]):
        def residuals(bins: np.ndarray, y: np.ndarray, group: int) -> np.ndarray:
            y = y.copy()
            for tree in trees.get(group, []):
                at = _walk(bins, {n: (f, b) for n, (f, b, _) in tree.items() if f >= 0})
                for node in np.unique(at):
                    y[at == node] -= tree[int(node)][2]
            return y
        return residuals

    for number in range(1, rounds + 1):
        nodes = grow(data, sizes, [number], growth, left(dict(recent))).collect()
        found += [tuple(n) for n in nodes]
        for group in sizes:
            recent[group] = recent[group] + [{n["node"]: (n["feature"], n["bin"], step * np.frombuffer(n["value"])) for n in nodes if n["grp"] == group}]
        if number % STORED_ROUNDS == 0 and number < rounds:
            data = stored(data.mapInArrow(_subtracted(left(dict(recent))), "grp int, key long, bins binary, y binary"), "residuals")
            recent = {group: [] for group in sizes}
    return packed(spark.createDataFrame(found, _NODE), cuts, lambda tree: step if tree else 1.0, outputs)


def _subtracted(residuals):
    def run(batches):
        for b in batches:
            if b.num_rows:
                groups, bins, y = np.asarray(b.column("grp")), _matrix(b.column("bins"), np.uint8), _matrix(b.column("y"), np.float64).copy()
                for group in np.unique(groups):
                    here = groups == group
                    y[here] = residuals(bins[here], y[here], int(group))
                yield pa.RecordBatch.from_arrays([b.column("grp"), b.column("key"), b.column("bins"),
                                                  pa.array([r.tobytes() for r in y], pa.binary())], ["grp", "key", "bins", "y"])
    return run
