"""numpy for regression trees: rows in bins, draws, growth of a tree, and its values. Apart from Spark ML, which workers need not import."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

#: Values kept of a feature with more, to find its bins; distinct rows to a chunk; bytes of counts to a task; cells whose prediction a task
#: keeps; rows that it reads before it goes through the trees.
SUMMARY, CHUNK, COUNTS, KNOWN, AHEAD = 4096, 1 << 18, 1 << 27, 1 << 20, 1 << 17

#: Gains below this share of the greatest label's square, for each unit of weight, are rounding.
NO_GAIN = 1e-24

Tree = tuple[np.ndarray, np.ndarray, np.ndarray]  # features by level, -1 for leaves; the last bins on the left; means of the leaves


def condensed(values: np.ndarray, weights: np.ndarray, most: int = SUMMARY) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and their weights; of more than `most`, the greatest of each of `most` equal shares of the weight."""
    values, back = np.unique(values, return_inverse=True)
    weights = np.bincount(back, weights, len(values))
    if len(values) > most:
        share = np.minimum(np.cumsum(weights) * (most / weights.sum()), most - 1).astype(int)
        last = np.flatnonzero(np.diff(share, append=most))
        values, weights = values[last], np.add.reduceat(weights, np.append(0, last[:-1] + 1))
    return values, weights


def edges(values: np.ndarray, weights: np.ndarray, bins: int) -> list[float]:
    """The greatest values of all bins but the last, as Spark ML chooses them: halfway between values, at equal weights if there are too many."""
    middle = (values[:-1] + values[1:]) / 2
    if len(values) <= bins:
        return middle.tolist()
    out, stride = [], weights.sum() / bins
    goal, sums = stride, np.cumsum(weights)
    for i in range(1, len(values)):
        if abs(sums[i - 1] - goal) < abs(sums[i] - goal):
            out.append(float(middle[i - 1]))
            goal += stride
    return out


def numbers(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(cuts)], axis=1).astype(np.uint8)


def summaries(width: int):
    """A row for each feature and kept value of a partition."""

    def work(batches: Iterator[pa.RecordBatch]):
        held = [[] for _ in range(width)]
        for b in batches:
            x, (y, w, n) = numbers(b.column("x"), width), (b.column(c).to_numpy(zero_copy_only=False) for c in ("y", "w", "n"))
            if not (np.isfinite(y).all() and np.isfinite(w).all() and (w >= 0).all()):
                raise ValueError("labels and weights have to be numbers, and weights not negative")
            for f, h in enumerate(held):
                h.append(condensed(x[:, f], n * w))
                if len(h) > 64:
                    h[:] = [condensed(*map(np.concatenate, zip(*h)))]
        for f, h in enumerate(held):
            if h:
                v, w = condensed(*map(np.concatenate, zip(*h)))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), f, np.int32)), pa.array(v), pa.array(w)], ["f", "v", "w"])

    return work


def in_bins(width: int, cuts: list[np.ndarray]):
    def work(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            rows = binned(numbers(b.column("x"), width), cuts)
            ends = pa.py_buffer(np.arange(0, rows.size + 1, width, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.binary(), len(rows), [None, ends, pa.py_buffer(rows)]), *map(b.column, ("y", "w", "n"))], ["bins", "y", "w", "n"])

    return work


def chunks(width: int):
    """Sorted rows as arrays: the distinct bins (cells), where the rows of each start, and how often rows occur, their weights and labels."""

    def packed(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(parts)
        bins = np.frombuffer(b"".join(t.column("bins").to_pylist()), np.uint8).reshape(-1, width)
        starts = np.flatnonzero(np.append(True, (bins[1:] != bins[:-1]).any(axis=1)))
        arrays = [bins[starts], starts, *(t.column(c).to_numpy().astype(float) for c in ("n", "w", "y"))]
        return pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()) for a in arrays], ["bins", "starts", "n", "w", "y"])

    def work(batches: Iterator[pa.RecordBatch]):
        held = []
        for b in batches:
            held += [b] * (len(b) > 0)
            if sum(map(len, held)) >= CHUNK:
                yield packed(held)
                held = []
        if held:
            yield packed(held)

    return work


def drawn(parts: list, rngs: list[np.random.Generator], middle: float) -> tuple[np.ndarray, np.ndarray]:
    """The bins of all cells; and for each tree and cell the drawn rows, their weight, and their weighted labels less `middle`."""
    cells = np.concatenate([p[0] for p in parts])
    out, at = np.zeros((len(rngs), 3, len(cells))), 0
    for bins, starts, n, w, y in parts:
        for sums, rng in zip(out, rngs):
            k = rng.poisson(n)
            for s, v in zip(sums, (k, k * w, k * (w * (y - middle)))):
                s[at : at + len(bins)] = np.add.reduceat(v, starts)
        at += len(bins)
    return cells, out


def best_splits(bins: np.ndarray, node: np.ndarray, sums: np.ndarray, total: np.ndarray, least: int, gain: np.ndarray, feature: np.ndarray, split: np.ndarray, f: int) -> None:
    """Sets gain, feature and split of the nodes that feature f splits better. bins are those of f; sums have labels less the node's mean."""
    key = node * 256 + bins
    order = np.argsort(key, kind="stable")
    key = key[order]
    end = np.flatnonzero(np.append(key[1:] != key[:-1], True))
    of = key[end] >> 8
    left = np.cumsum(sums[:, order], axis=1)[:, end]
    first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
    before = np.where(first > 0, left[:, first - 1], 0.0)
    left -= np.repeat(before, np.diff(np.append(first, len(of))), axis=1)
    n, w, d = left
    right = total[:2, of] - left[:2]
    # n is in whole numbers; the last bin of a node leaves nothing on the right, and a side without rows has no weight
    fits = (n >= least) & (right[0] >= least) & (w > 0) & (right[1] > 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        g = np.where(fits, d * d * (1 / w + 1 / right[1]), 0.0)
    top, ids = np.maximum.reduceat(g, first), of[first]
    at = np.flatnonzero(g == np.repeat(top, np.diff(np.append(first, len(of)))))[::-1]
    place = np.zeros(len(total[0]), int)
    place[of[at]] = at  # the first of equals
    better = ids[top > gain[ids]]
    gain[better], feature[better], split[better] = g[place[better]], f, key[end][place[better]] & 255


def grown(bins: np.ndarray, sums: np.ndarray, rng: np.random.Generator, depth: int, least: int, tried: int, middle: float, greatest: float) -> tuple[Tree, np.ndarray]:
    """A tree, and what each feature's splits gain. The k-th node with a split has the nodes 2k+1 and 2k+2 below it."""
    width = bins.shape[1]
    here = np.flatnonzero(sums[0] > 0)
    bins, sums, node = bins[here], sums[:, here], np.zeros(len(here), int)
    features, splits, means, gains, count = [], [], [], np.zeros(width), 1
    for level in range(depth + 1):
        total = np.stack([np.bincount(node, s, count) for s in sums])
        mean = np.divide(total[2], total[1], out=np.zeros(count), where=total[1] > 0)
        gain, feature, split = total[1] * (NO_GAIN * greatest * greatest), np.full(count, -1, np.int16), np.zeros(count, np.uint8)
        if level < depth:
            chosen = np.ones((count, width), bool) if tried >= width else np.argsort(rng.random((count, width)), axis=1).argsort(axis=1) < tried
            centred = np.stack([sums[0], sums[1], sums[2] - mean[node] * sums[1]])
            wide = total[0][node] >= 2 * least
            for f in range(width):
                rows = np.flatnonzero(chosen[node, f] & wide)
                if len(rows):
                    best_splits(bins[rows, f], node[rows], centred[:, rows], total, least, gain, feature, split, f)
        inner = feature >= 0
        features.append(feature)
        splits.append(split[inner])
        means.append(mean[~inner] + middle)
        gains += np.bincount(feature[inner], gain[inner], width)
        count = 2 * int(inner.sum())
        if not count:
            break
        rank, rows = np.cumsum(inner) - 1, np.flatnonzero(inner[node])
        bins, sums, node = bins[rows], sums[:, rows], node[rows]
        node = 2 * rank[node] + (bins[np.arange(len(rows)), feature[node]] > split[node])
    return (np.concatenate(features), np.concatenate(splits), np.concatenate(means)), gains


def value(tree: Tree, bins: np.ndarray) -> np.ndarray:
    features, splits, means = tree
    rank = np.cumsum(features >= 0) - 1
    node = np.zeros(len(bins), int)
    rows = np.arange(len(bins)) if features[0] >= 0 else np.empty(0, int)
    while len(rows):
        k = rank[node[rows]]
        node[rows] = 2 * k + 1 + (bins[rows, features[node[rows]]] > splits[k])
        rows = rows[features[node[rows]] >= 0]
    return means[node - rank[node] - 1]


def predictor(cuts: list[np.ndarray], groups: list, trees: int):
    """The mean of all trees. A task goes through them for many rows at once, and keeps what it has predicted for cells, where their bins make a number."""
    width = len(cuts)
    sizes = [len(c) + 1 for c in cuts]
    steps = np.array([math.prod(sizes[:f]) for f in range(width)], np.int64) if math.prod(sizes) < 1 << 62 else None

    def means(bins: np.ndarray) -> np.ndarray:
        out = np.zeros(len(bins))
        for g in groups:
            for tree in g.value:
                out += value(tree, bins)
        return out / trees

    @F.arrow_udf("double")
    def predict(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known, values = np.empty(0, np.int64), np.empty(0)

        def guesses(held: list[np.ndarray]) -> Iterator[pa.Array]:
            nonlocal known, values
            bins = np.concatenate(held)
            if steps is None:
                out = means(bins)
            else:
                code, first, back = np.unique(bins.astype(np.int64) @ steps, return_index=True, return_inverse=True)
                if len(known) > KNOWN:
                    known, values = known[:0], values[:0]
                new = ~np.isin(code, known, assume_unique=True)
                if new.any():
                    known, values = np.append(known, code[new]), np.append(values, means(bins[first[new]]))
                    order = np.argsort(known)
                    known, values = known[order], values[order]
                out = values[np.searchsorted(known, code)][back]
            return map(pa.array, np.split(out, np.cumsum([len(h) for h in held])[:-1]))

        held = []
        for column in columns:
            held.append(binned(numbers(column, width), cuts))
            if sum(map(len, held)) >= AHEAD:
                yield from guesses(held)
                held = []
        if held:
            yield from guesses(held)

    return predict
