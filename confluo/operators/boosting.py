"""Boosted trees over rows of bins, in the tasks of one barrier stage.

Each task keeps its rows as bytes; a level of a tree is one exchange of sums by node, feature and bin, so all
tasks grow the same trees. The rules are those of Spark's GBTClassifier with logistic loss: a first tree of the
labels (-1 and 1), then trees of the loss's negative gradient with a step, splits by the weighted variance.
"""

from __future__ import annotations

import json
import secrets
import socket
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Cells of features whose sums are made together, at most, and levels, at most: a row's leaf is a bit of 64.
JOINT, DEEPEST = 1024, 6
#: Seconds that a task waits for another's sums.
WAIT = 600


@dataclass
class Trees:
    """Complete trees of bins: a feature (-1: no split) and its last bin to the left for each inner node, a value for each leaf. cuts: the ends of each feature's bins."""

    cuts: list[list[float]]
    feature: list[list[int]]
    last: list[list[int]]
    value: list[list[float]]
    gains: list[float]

    def to_json(self) -> str:
        return json.dumps(self.__dict__)

    @staticmethod
    def from_json(text: str) -> Trees:
        return Trees(**json.loads(text))

    def margins(self, bins: np.ndarray) -> np.ndarray:
        """The sum of the trees' values for each row: a table for each group of features holds the leaves that are left, as bits."""
        groups = _groups([len(c) + 1 for c in self.cuts])
        at = _joint(bins, groups)
        out = np.zeros(bins.shape[1])
        for feature, last, value in zip(self.feature, self.last, self.value):
            left = np.uint64(0)
            for (features, widths), a in zip(groups, at):
                if (table := _left(features, widths, feature, last)) is not None:
                    left = left & table[a] if left.ndim else table[a]
            if left.ndim:
                out += np.array(value)[np.bitwise_count((left & -left) - np.uint64(1))]
            else:
                out += value[0]
        return out


def binned(columns: list[np.ndarray], cuts: list[list[float]]) -> np.ndarray:
    """A row of bytes for each feature: the number of its cuts up to each value."""
    return np.array([np.searchsorted(c, v.astype(np.float64), side="right") for c, v in zip(cuts, columns)], np.uint8).reshape(len(cuts), -1)


def _groups(widths: list[int]) -> list[tuple[list[int], list[int]]]:
    """Features, in groups of at most JOINT cells (or one feature), with their widths."""
    out: list[tuple[list[int], list[int]]] = []
    for f in sorted(range(len(widths)), key=lambda f: -widths[f]):
        for features, known in out:
            if np.prod(known) * widths[f] <= JOINT:
                features.append(f)
                known.append(widths[f])
                break
        else:
            out.append(([f], [widths[f]]))
    return out


def _joint(bins: np.ndarray, groups: list) -> list[np.ndarray]:
    return [np.ravel_multi_index([bins[f] for f in features], widths).astype(np.int64) for features, widths in groups]


def _left(features: list[int], widths: list[int], feature: list[int], last: list[int]) -> np.ndarray | None:
    """For each cell of a group: the leaves that its splits leave, as bits; None if it has no split. A row that goes right leaves the left half of a node."""
    own = [k for k, f in enumerate(feature) if f in features]
    if not own and feature[0] >= 0:
        return None
    table, leaves = np.full(widths, 0xFFFFFFFFFFFFFFFF, np.uint64), len(feature) + 1
    for k in own:
        level = (k + 1).bit_length() - 1
        size = leaves >> level
        gone = ((1 << size // 2) - 1) << (k + 1 - (1 << level)) * size
        axis = features.index(feature[k])
        table[(slice(None),) * axis + (slice(last[k] + 1, None),)] &= np.uint64(0xFFFFFFFFFFFFFFFF ^ gone)
    return table.ravel()


def _splits(s: np.ndarray, w: np.ndarray, widths: list[int]):
    """The best split of each node by sums and weights (nodes, all bins): feature, last bin to the left, gain, and the sums and weights of both sides."""
    n = len(s)
    feature, last, best = np.full(n, -1), np.full(n, 255), np.zeros(n)
    whole_s, whole_w = s[:, : widths[0]].sum(1), w[:, : widths[0]].sum(1)
    left_s, left_w = whole_s.copy(), whole_w.copy()
    base = np.divide(whole_s**2, whole_w, out=np.zeros(n), where=whole_w > 0)
    start = 0
    for f, width in enumerate(widths):
        a, b = (x[:, start : start + width].cumsum(1)[:, :-1] for x in (s, w))
        start += width
        if width < 2:
            continue
        c, d = whole_s[:, None] - a, whole_w[:, None] - b
        ok = (b > 1e-9 * whole_w[:, None]) & (d > 1e-9 * whole_w[:, None])
        gain = np.where(ok, np.divide(a**2, b, out=np.zeros_like(a), where=ok) + np.divide(c**2, d, out=np.zeros_like(a), where=ok) - base[:, None], 0)
        at, row = gain.argmax(1), np.arange(n)
        more = gain[row, at] > np.maximum(best, 1e-10 * whole_w)
        feature[more], last[more], best[more] = f, at[more], gain[row, at][more]
        left_s[more], left_w[more] = a[row, at][more], b[row, at][more]
    return feature, last, best, np.stack([left_s, whole_s - left_s], 1).ravel(), np.stack([left_w, whole_w - left_w], 1).ravel()


def boost(bins: np.ndarray, match: np.ndarray, val: np.ndarray, weight: float, cuts: list[list[float]], rounds: int, depth: int, step: float, patience: float, total: Callable[[np.ndarray], np.ndarray]) -> Trees:
    """Trees from this task's rows; total sums an array over all tasks."""
    widths = [len(c) + 1 for c in cuts]
    groups = _groups(widths)
    starts = np.concatenate([[0], np.cumsum(widths)])
    train, held = bins[:, ~val], bins[:, val]
    n = train.shape[1]
    y, w = (np.where(match[~val], a, b) for a, b in ((1.0, -1.0), (weight, 1.0)))
    vy, vw = (np.where(match[val], a, b) for a, b in ((1.0, -1.0), (weight, 1.0)))
    joint, flat, row = _joint(train, groups), train.ravel(), np.arange(n)
    margin, held_margin = np.zeros(n), np.zeros(held.shape[1])
    out, per_tree, least, kept = Trees(cuts, [], [], [], []), [], np.inf, 0
    for m in range(rounds + 1):
        # The loss of the rows held out goes with the next tree's first sums.
        loss = np.array([(vw * 2 * np.logaddexp(0, -2 * vy * held_margin)).sum(), vw.sum()])
        wr = w * (4 * y / (1 + np.exp(np.minimum(2 * y * margin, 700))) if m else y)
        node, feature, last, gains = np.zeros(n, np.int64), [], [], np.zeros(len(widths))
        for level in range(depth):
            nodes = 1 << level
            sums = np.zeros((2, nodes, starts[-1]))
            for (features, of), at in zip(groups, joint):
                size = int(np.prod(of))
                cell = node * size + at
                for k, x in enumerate((wr, w)):
                    table = np.bincount(cell, x, nodes * size).reshape(nodes, *of)
                    for axis, f in enumerate(features):
                        sums[k, :, starts[f] : starts[f + 1]] = table.sum(axis=tuple(i + 1 for i in range(len(of)) if i != axis))
            got = total(np.concatenate([sums.ravel(), loss] if not level else [sums.ravel()]))
            if not level and m and got[-1] > 0:
                error = got[-2] / got[-1]
                if m > 1 and least - error < patience * max(error, 0.01):
                    m = rounds
                    break
                if error < least:
                    least, kept = error, m
            elif not level:
                kept = m
            if m == rounds:
                break
            f, b, gain, s, u = _splits(*got[: sums.size].reshape(sums.shape), widths)
            feature += f.tolist()
            last += b.tolist()
            np.add.at(gains, f[f >= 0], gain[f >= 0])
            node = 2 * node + (flat[np.maximum(f, 0)[node] * n + row] > b[node])
        if m == rounds:
            break
        value = np.divide(s, u, out=np.zeros(len(s)), where=u > 0) * (step if m else 1.0)
        one = Trees(cuts, [feature], [last], [value.tolist()], [])
        margin += value[node]
        held_margin += one.margins(held)
        out.feature.append(feature)
        out.last.append(last)
        out.value.append(one.value[0])
        per_tree.append(gains)
    out.feature, out.last, out.value = out.feature[:kept], out.last[:kept], out.value[:kept]
    out.gains = np.sum(per_tree[:kept], axis=0).tolist() if kept else [0.0] * len(widths)
    return out


def packed(features: list[str], cuts: list[list[float]]) -> Callable:
    """Batches to one row of bytes each: the bins, then 1 for a match and 2 for a row held out."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [batch.column(c).to_numpy(zero_copy_only=False) for c in [*features, "is_match", "is_val"]]
            flags = x[-2].astype(np.uint8) | x[-1].astype(np.uint8) << 1
            yield pa.RecordBatch.from_arrays([pa.array([np.vstack([binned(x[:-2], cuts), flags]).tobytes()], pa.binary())], names=["block"])

    return run


def _received(peer: socket.socket, size: int) -> bytes:
    out = bytearray()
    while len(out) < size:
        if not (got := peer.recv(min(size - len(out), 1 << 20))):
            raise ConnectionError("a task of the stage has ended")
        out += got
    return bytes(out)


def summed(task) -> Callable[[np.ndarray], np.ndarray]:
    """A function that sums arrays over a barrier stage's tasks: each sends its own to the first task and gets the sum.

    The stage's own allGather, which takes a second a call, tells the first task's port alone.
    """
    me, peers = task.partitionId(), task.getTaskInfos()
    server = None if me else socket.create_server(("", 0))
    said = "" if me else f"{server.getsockname()[1]} {secrets.token_hex(16)}"
    port, secret = task.allGather(said)[0].split()
    links: list[socket.socket] = []
    if me:
        links.append(socket.create_connection((peers[0].address.rsplit(":", 1)[0], int(port)), WAIT))
        links[0].sendall(f"{secret}{me:8d}".encode())
    else:
        known: dict[int, socket.socket] = {}
        server.settimeout(WAIT)
        while len(known) < len(peers) - 1:
            link = server.accept()[0]
            link.settimeout(WAIT)
            hello = _received(link, len(secret) + 8).decode()
            if hello.startswith(secret):
                known[int(hello[len(secret) :])] = link
        server.close()
        # In the tasks' order, so that sums do not depend on who comes first.
        links = [known[k] for k in sorted(known)]
    for link in links:
        link.setsockopt(socket.IPPROTO_TCP, socket.TCP_NODELAY, 1)

    def total(x: np.ndarray) -> np.ndarray:
        if me:
            links[0].sendall(x.tobytes())
            return np.frombuffer(_received(links[0], x.nbytes))
        out = x.copy()
        for link in links:
            out += np.frombuffer(_received(link, x.nbytes))
        for link in links:
            link.sendall(out.tobytes())
        return out

    return total


def boosted(cuts: list[list[float]], weight: float, rounds: int, depth: int, step: float, patience: float) -> Callable:
    """Blocks to the trees as text, in a barrier stage; the first task returns them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import BarrierTaskContext

        task = BarrierTaskContext.get()
        blocks = [np.frombuffer(x.as_buffer(), np.uint8).reshape(len(cuts) + 1, -1) for batch in batches for x in batch.column(0)]
        rows = np.concatenate([np.zeros((len(cuts) + 1, 0), np.uint8), *blocks], axis=1)

        trees = boost(rows[:-1], (rows[-1] & 1).astype(bool), (rows[-1] & 2).astype(bool), weight, cuts, rounds, depth, step, patience, summed(task))
        if task.partitionId() == 0:
            yield pa.RecordBatch.from_arrays([pa.array([trees.to_json()])], names=["trees"])

    return run
