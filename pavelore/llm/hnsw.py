"""Hierarchical navigable small-world graph over unit vectors, batched in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

NEIGHBOURS = 24  # edges of a node on the ground layer
UPPER = 12  # and above
RATIO = 16  # nodes of a layer for each node of the next one
BUILD_BEAM = 48
INSERTED = 512  # nodes inserted at a time
ASKED = 256  # queries that walk the graph at a time
EXPANDED = 4  # nodes that a query expands in a step


@dataclass
class Graph:
    """``vectors`` by node; ``layers`` from the ground up, each ``(nodes, slot, edges)``.

    ``slot`` gives a node's row in ``edges``; rows hold nodes, -1 where there is none.
    """

    vectors: np.ndarray
    layers: list[tuple[np.ndarray, np.ndarray, np.ndarray]]


def _selected(base: np.ndarray, found: np.ndarray, near: np.ndarray, vectors: np.ndarray, most: int) -> np.ndarray:
    """The ``most`` neighbours of each row of candidates, sorted by similarity to the base.

    A candidate is taken first if it is nearer to the base than to all taken before it, so
    that edges lead in different directions; what is left is filled up with the nearest.
    """
    width = found.shape[1]
    near = np.where((found < 0) | (found == base[:, None]), -np.inf, near)
    order = np.argsort(-near, axis=1, kind="stable")
    found, near = np.take_along_axis(found, order, 1), np.take_along_axis(near, order, 1)
    near[:, 1:][found[:, 1:] == found[:, :-1]] = -np.inf
    points = vectors[np.maximum(found, 0)]
    between = np.matmul(points, points.transpose(0, 2, 1))
    taken = np.zeros(found.shape, dtype=bool)
    for i in range(width):
        blocked = (taken & (between[:, i, :] > near[:, i, None])).any(axis=1)
        taken[:, i] = ~blocked & np.isfinite(near[:, i]) & (taken.sum(axis=1) < most)
    rank = np.where(taken, near + 4, near)
    best = np.argsort(-rank, axis=1, kind="stable")[:, :most]
    chosen = np.take_along_axis(found, best, 1)
    chosen[~np.isfinite(np.take_along_axis(near, best, 1))] = -1
    if chosen.shape[1] < most:
        chosen = np.pad(chosen, ((0, 0), (0, most - chosen.shape[1])), constant_values=-1)
    return chosen


def _nearest(vectors: np.ndarray, nodes: np.ndarray, most: int) -> np.ndarray:
    """Edges of a small layer: each node's neighbours among all of its nodes."""
    edges = []
    for at in range(0, len(nodes), 256):
        own = nodes[at : at + 256]
        near = vectors[own] @ vectors[nodes].T
        width = min(len(nodes), 3 * most)
        best = np.argpartition(-near, width - 1, axis=1)[:, :width]
        edges.append(_selected(own, nodes[best], np.take_along_axis(near, best, 1), vectors, most))
    return np.concatenate(edges)


def walk(graph_vectors, slot, edges, queries: np.ndarray, start: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of each query's beam and their similarities, best first; -1 where it has fewer.

    A step expands the best unexpanded nodes of every beam at once; a walk ends when all
    nodes of its beam are expanded.
    """
    n, rows = len(queries), np.arange(len(queries))[:, None]
    seen = np.zeros((n, len(graph_vectors)), dtype=bool)
    width = max(beam, start.shape[1])
    found = np.full((n, width), -1, dtype=np.int64)
    near = np.full((n, width), -np.inf, dtype=np.float32)
    open_ = np.zeros((n, width), dtype=bool)
    found[:, : start.shape[1]] = start
    near[:, : start.shape[1]] = np.einsum("qmd,qd->qm", graph_vectors[np.maximum(start, 0)], queries)
    near[found < 0] = -np.inf
    open_[found >= 0] = True
    seen[np.nonzero(found >= 0)[0], found[found >= 0]] = True
    while True:
        wanted = np.where(open_, near, -np.inf)
        few = min(EXPANDED, width)
        best = np.argpartition(-wanted, few - 1, axis=1)[:, :few]
        valid = np.take_along_axis(open_, best, 1)
        if not valid.any():
            break
        open_[rows, best] = False
        nodes = np.where(valid, np.take_along_axis(found, best, 1), -1)
        around = np.where(nodes[..., None] >= 0, edges[slot[np.maximum(nodes, 0)]], -1).reshape(n, -1)
        around.sort(axis=1)
        fresh = around >= 0
        fresh[:, 1:] &= around[:, 1:] != around[:, :-1]
        fresh &= ~seen[rows, np.maximum(around, 0)]
        q, m = np.nonzero(fresh)
        node = around[q, m]
        seen[q, node] = True
        value = np.full(around.shape, -np.inf, dtype=np.float32)
        value[q, m] = np.einsum("nd,nd->n", graph_vectors[node], queries[q])
        found = np.concatenate([found, around], axis=1)
        near = np.concatenate([near, value], axis=1)
        open_ = np.concatenate([open_, fresh], axis=1)
        kept = np.argpartition(-near, width - 1, axis=1)[:, :width]
        found, near, open_ = (np.take_along_axis(a, kept, 1) for a in (found, near, open_))
    order = np.argsort(-near, axis=1, kind="stable")
    found, near = np.take_along_axis(found, order, 1), np.take_along_axis(near, order, 1)
    return np.where(np.isfinite(near), found, -1), near


def descend(graph: Graph, queries: np.ndarray) -> np.ndarray:
    """Nodes of the ground layer to start from: the best that the layers above lead to."""
    start = np.repeat(graph.layers[-1][0][None, :4], len(queries), axis=0)
    for _, slot, edges in reversed(graph.layers[1:]):
        start = walk(graph.vectors, slot, edges, queries, start, 8)[0][:, :4]
    return start


def build(vectors: np.ndarray, seed: int = 0) -> Graph:
    """The graph of unit vectors.

    Layers above the ground are small and are linked exactly. Their nodes come first on the
    ground, linked exactly too; all others are inserted batch by batch: each walks the
    graph so far, is linked to the neighbours it finds there and in its batch, and they back.
    """
    n = len(vectors)
    order = np.random.default_rng(seed).permutation(n)
    uppers = []
    size = n // RATIO
    while size >= 4:
        nodes = np.sort(order[:size])
        slot = np.full(n, -1, dtype=np.int64)
        slot[nodes] = np.arange(size)
        uppers.append((nodes, slot, _nearest(vectors, nodes, UPPER)))
        size //= RATIO
    first = max(len(uppers[0][0]) if uppers else 0, min(n, INSERTED))
    ground = np.full((n, NEIGHBOURS), -1, dtype=np.int64)
    ground[order[:first]] = _nearest(vectors, order[:first], NEIGHBOURS)
    everyone = np.arange(n)
    graph = Graph(vectors, [(everyone if not uppers else order[:first], everyone, ground), *uppers])
    for at in range(first, n, INSERTED):
        new = order[at : at + INSERTED]
        found, near = [], []
        for part in range(0, len(new), ASKED):
            queries = vectors[new[part : part + ASKED]]
            f, s = walk(vectors, everyone, ground, queries, descend(graph, queries), BUILD_BEAM)
            found.append(f)
            near.append(s)
        mates = vectors[new] @ vectors[new].T
        np.fill_diagonal(mates, -np.inf)
        few = min(8, len(new))
        best = np.argpartition(-mates, few - 1, axis=1)[:, :few]
        found = np.concatenate([np.concatenate(found), new[best]], axis=1)
        near = np.concatenate([np.concatenate(near), np.take_along_axis(mates, best, 1)], axis=1)
        ground[new] = _selected(new, found, near, vectors, NEIGHBOURS)
        _link_back(ground, new, vectors)
    graph.layers[0] = (everyone, everyone, ground)
    return graph


def _link_back(ground: np.ndarray, new: np.ndarray, vectors: np.ndarray) -> None:
    """Give the neighbours of new nodes an edge back, and choose anew among their edges."""
    source = np.repeat(new, NEIGHBOURS)
    target = ground[new].ravel()
    source, target = source[target >= 0], target[target >= 0]
    order = np.lexsort((-np.einsum("nd,nd->n", vectors[source], vectors[target]), target))
    source, target = source[order], target[order]
    nodes, starts, counts = np.unique(target, return_index=True, return_counts=True)
    place = np.arange(len(target)) - np.repeat(starts, counts)
    kept = place < NEIGHBOURS  # the nearest
    back = np.full((len(nodes), NEIGHBOURS), -1, dtype=np.int64)
    back[np.repeat(np.arange(len(nodes)), counts)[kept], place[kept]] = source[kept]
    for at in range(0, len(nodes), ASKED):
        own = nodes[at : at + ASKED]
        found = np.concatenate([ground[own], back[at : at + ASKED]], axis=1)
        near = np.einsum("qmd,qd->qm", vectors[np.maximum(found, 0)], vectors[own])
        ground[own] = _selected(own, found, near, vectors, NEIGHBOURS)


def search(graph: Graph, queries: np.ndarray, least: float, beam: int) -> list[np.ndarray]:
    """Per query the nodes found with a similarity of ``least`` or more.

    A beam that is full of such nodes is too narrow: its query walks again with four times
    the beam, up to the size of the graph.
    """
    size = len(graph.vectors)
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(queries)
    todo, _, ground = np.arange(len(queries)), *graph.layers[0][1:]
    slot = graph.layers[0][1]
    while len(todo):
        beam = min(beam, size)
        again = []
        asked = max(1, min(ASKED, ASKED * 256 // beam))
        for at in range(0, len(todo), asked):
            own = todo[at : at + asked]
            found, near = walk(graph.vectors, slot, ground, queries[own], descend(graph, queries[own]), beam)
            hits = (near >= least) & (found >= 0)
            for row, q in enumerate(own.tolist()):
                out[q] = found[row][hits[row]]
            again.append(own[hits[:, :beam].all(axis=1)])
        todo = np.concatenate(again) if beam < size else todo[:0]
        beam *= 4
    return out
