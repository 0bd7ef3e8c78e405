"""Hierarchical navigable small-world graph of one shard, searched many queries at a time."""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np

LINKS = 16
"""Neighbours of a node in upper layers; twice as many at the bottom."""

BUILD_BEAM = 64
FIRST_BEAM = 32
QUERIES = 256
WIDTH = 4
"""Nodes of a beam that one step expands."""

SMALL = 64
"""Nodes that a layer links by comparing all."""

AUDIT = 1024
"""Vectors of a shard, and about as many of all shards, whose true links are compared with those found."""

RECALL = 0.98
"""Share of true links that the audit wants found."""


def _levels(ids: np.ndarray) -> np.ndarray:
    """Layers of nodes, from a hash of their id: each layer has a sixteenth of the one below."""
    mixed = (ids.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xC2B2AE3D27D4EB4F)
    even = ((mixed >> np.uint64(11)).astype(np.float64) + 1) / 2.0**53
    return np.floor(-np.log(even) / np.log(LINKS)).astype(np.int64)


def _diverse(target: np.ndarray, candidates: np.ndarray, vectors: np.ndarray, links: int) -> np.ndarray:
    """Up to ``links`` candidates per target, each nearer to it than to those chosen before; -1 pads."""
    found = vectors[candidates]
    near = np.einsum("tcd,td->tc", found, target)
    near[candidates < 0] = -np.inf
    order = np.argsort(-near, axis=1, kind="stable")
    candidates, near = np.take_along_axis(candidates, order, 1), np.take_along_axis(near, order, 1)
    found = vectors[candidates]
    between = np.einsum("tcd,ted->tce", found, found)
    chosen = np.zeros(candidates.shape, bool)
    worst = np.full(candidates.shape, -np.inf, np.float32)
    for place in range(candidates.shape[1]):
        take = (candidates[:, place] >= 0) & (near[:, place] > worst[:, place]) & (chosen.sum(1) < links)
        chosen[:, place] = take
        worst = np.where(take[:, None], np.maximum(worst, between[:, :, place]), worst)
    spare = (candidates >= 0) & ~chosen
    rank = np.where(chosen, 0, np.where(spare, 1, 2)) * candidates.shape[1] + np.arange(candidates.shape[1])
    keep = np.argsort(rank, axis=1, kind="stable")[:, :links]  # free places go to the nearest of the rest
    kept = np.take_along_axis(candidates, keep, 1)
    full = np.full((len(kept), links), -1, np.int32)
    full[:, : kept.shape[1]] = kept
    return full


class Layer:
    """Neighbours of the nodes of one layer; ``nodes`` are their places in the shard."""

    def __init__(self, vectors: np.ndarray, nodes: np.ndarray, links: int) -> None:
        self.vectors, self.nodes, self.links = vectors, nodes, links
        self.neighbours = np.full((len(nodes), links), -1, np.int32)
        self._seen, self._round = np.zeros((0, len(nodes) + 1), np.uint8), 0

    def _visited(self, count: int) -> tuple[np.ndarray, int]:
        """A table of who has seen which node in which round, cleared every 255 rounds only."""
        if len(self._seen) < count:
            self._seen, self._round = np.zeros((count, len(self.nodes) + 1), np.uint8), 0
        if self._round == 255:
            self._seen[:], self._round = 0, 0
        self._round += 1
        self._seen[:count, -1] = self._round  # no node
        return self._seen, self._round

    def search(self, queries: np.ndarray, entries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Nodes nearest to each query and their cosines, best first, as far as the beam reaches."""
        count = len(queries)
        visited, seen = self._visited(count)
        every = np.arange(count)[:, None]
        ids = np.full((count, beam), -1, np.int32)
        near = np.full((count, beam), -np.inf, np.float32)
        ids[:, : entries.shape[1]] = entries[:, :beam]
        visited[every, entries] = seen
        near[:, : entries.shape[1]] = np.einsum("qed,qd->qe", self.vectors[ids[:, : entries.shape[1]]], queries)
        near[ids < 0] = -np.inf
        open_ = ids >= 0
        rows = np.arange(count)
        while len(rows):
            waiting = np.where(open_[rows], near[rows], -np.inf)
            best = np.argpartition(-waiting, min(WIDTH, beam) - 1, axis=1)[:, :WIDTH]
            real = np.isfinite(np.take_along_axis(waiting, best, 1))
            some = real.any(1)
            rows, best, real = rows[some], best[some], real[some]
            if not len(rows):
                break
            open_[rows[:, None], best] &= ~real
            nodes = np.where(real, ids[rows[:, None], best], -1)
            around = np.where(nodes[:, :, None] >= 0, self.neighbours[nodes], -1).reshape(len(rows), -1)
            around = np.where(visited[rows[:, None], around] == seen, -1, around)
            around.sort(axis=1)
            around[:, 1:][around[:, 1:] == around[:, :-1]] = -1
            visited[rows[:, None], around] = seen
            cosines = np.einsum("qed,qd->qe", self.vectors[around], queries[rows])
            cosines[around < 0] = -np.inf
            all_near = np.concatenate((near[rows], cosines), 1)
            keep = np.argpartition(-all_near, beam - 1, axis=1)[:, :beam]
            near[rows] = np.take_along_axis(all_near, keep, 1)
            ids[rows] = np.take_along_axis(np.concatenate((ids[rows], around), 1), keep, 1)
            fresh = np.concatenate((open_[rows], around >= 0), 1)
            open_[rows] = np.take_along_axis(fresh, keep, 1)
        order = np.argsort(-near, axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1)

    def build(self, entries) -> None:
        """Insert all nodes in batches; ``entries`` gives start nodes of the first so many for some vectors."""
        first = min(SMALL, len(self.nodes))
        start = self.vectors[:first]
        everyone = np.broadcast_to(np.arange(first, dtype=np.int32), (first, first)).copy()
        np.fill_diagonal(everyone, -1)
        self.neighbours[:first] = _diverse(start, everyone, self.vectors, self.links)
        done = first
        while done < len(self.nodes):
            size = min(QUERIES * 2, done, len(self.nodes) - done)
            batch = self.vectors[done : done + size]
            found, _ = self.search(batch, entries(batch, done), min(BUILD_BEAM, done))  # links lead to inserted nodes only
            mutual = batch @ batch.T
            np.fill_diagonal(mutual, -np.inf)
            inside = np.argsort(-mutual, axis=1, kind="stable")[:, : min(LINKS, size - 1)].astype(np.int32) + done
            self.neighbours[done : done + size] = _diverse(batch, np.concatenate((found, inside), 1), self.vectors, self.links)
            self._link_back(np.arange(done, done + size))
            done += size
        self.connect()

    def connect(self) -> None:
        """Link nodes that no path from the first one reaches, from the nearest of theirs that one does."""
        while True:
            reached = np.zeros(len(self.nodes), bool)
            front = np.zeros(1, np.int64)
            reached[front] = True
            while len(front):
                around = np.unique(self.neighbours[front])
                front = around[(around >= 0) & ~reached[around]]
                reached[front] = True
            lost = np.flatnonzero(~reached)
            if not len(lost):
                return
            own = self.neighbours[lost]
            fits = (own >= 0) & reached[own]
            some = fits.any(1)
            if not some.any():  # a part that links only itself
                lost, source = lost[:1], np.zeros(1, np.int64)
            else:
                lost, source = lost[some], own[some, fits[some].argmax(1)]
            order = np.argsort(source, kind="stable")
            lost, source = lost[order], source[order]
            _, begins, sizes = np.unique(source, return_index=True, return_counts=True)
            place = np.arange(len(lost)) - np.repeat(begins, sizes)
            take = place < 4  # the rest in the next round, by way of those
            more = np.full((len(self.nodes), int(place[take].max()) + 1), -1, np.int32)
            more[source[take], place[take]] = lost[take]
            self.neighbours = np.concatenate((self.neighbours, more), 1)

    def _link_back(self, nodes: np.ndarray) -> None:
        sources = np.repeat(nodes, self.links)
        targets = self.neighbours[nodes].ravel()
        real = targets >= 0
        sources, targets = sources[real], targets[real]
        near = np.einsum("nd,nd->n", self.vectors[sources], self.vectors[targets])
        order = np.lexsort((-near, targets))
        sources, targets = sources[order], targets[order]
        unique, begins, sizes = np.unique(targets, return_index=True, return_counts=True)
        place = np.arange(len(targets)) - np.repeat(begins, sizes)
        most = min(int(sizes.max()), self.links)
        incoming = np.full((len(unique), most), -1, np.int32)
        near_enough = place < most
        incoming[np.repeat(np.arange(len(unique)), sizes)[near_enough], place[near_enough]] = sources[near_enough]
        for at in range(0, len(unique), QUERIES * 4):
            part = unique[at : at + QUERIES * 4]
            own = self.neighbours[part]
            more = incoming[at : at + QUERIES * 4]
            more = np.where((more[:, :, None] == own[:, None, :]).any(2), -1, more)
            self.neighbours[part] = _diverse(self.vectors[part], np.concatenate((own, more), 1), self.vectors, self.links)


class Graph:
    """All layers over unit vectors, and the beam width that its audit asked for."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, threshold: float, asked: tuple[np.ndarray, np.ndarray] | None = None) -> None:
        """``asked``: ids and vectors from all shards that the audit asks for, besides those of its own."""
        level = _levels(ids)
        order = np.lexsort((ids, -level))  # higher nodes first, so every layer is a prefix
        self.ids, self.exact, level = ids[order], vectors[order], level[order]
        self._arrange([int((level >= layer).sum()) for layer in range(int(level.max()) + 1)])
        for number in range(len(self.layers) - 1, -1, -1):
            self.layers[number].build(lambda queries, done, above=number + 1: np.minimum(self._entries(queries, above), done - 1))
        self.beam = FIRST_BEAM
        self._audit(threshold, asked)

    def _arrange(self, sizes: list[int]) -> None:
        vectors = np.vstack((self.exact, np.zeros((1, self.exact.shape[1])))).astype(np.float32)  # -1 is the last row
        nodes = np.arange(len(self.ids))
        self.layers = []
        for number, size in enumerate(sizes):
            layer = Layer(np.vstack((vectors[:size], vectors[-1:])), nodes[:size], LINKS * (2 if number == 0 else 1))
            self.layers.append(layer)

    def _entries(self, queries: np.ndarray, above: int) -> np.ndarray:
        entries = np.zeros((len(queries), 1), np.int32)
        for layer in self.layers[: above - 1 if above else None : -1]:
            found, _ = layer.search(queries, entries, min(4, len(layer.nodes)))
            entries = found[:, :1]
        return entries

    def _scan(self, queries: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """Every pair of some queries, compared."""
        return np.nonzero(queries @ self.exact.T >= threshold)

    def within(self, queries: np.ndarray, threshold: float, beam: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of query and node whose cosine in double precision reaches the threshold, as found, some queries at a time.

        A beam that is full of such nodes is widened, from those it holds; one that
        would visit the whole shard compares the whole shard instead.
        """
        for at in range(0, len(queries), QUERIES):
            left, width = np.arange(at, min(at + QUERIES, len(queries))), beam or self.beam
            entries = None
            while len(left):
                if width * self.layers[0].links >= len(self.ids):
                    row, node = self._scan(queries[left], threshold)
                    yield left[row], node
                    break
                asked = queries[left].astype(np.float32)
                found, near = self.layers[0].search(asked, self._entries(asked, 1) if entries is None else entries, width)
                done = near[:, -1] < threshold - 1e-4
                row, place = np.nonzero((near >= threshold - 1e-4) & done[:, None])
                node = found[row, place]
                true = np.einsum("nd,nd->n", queries[left[row]], self.exact[node]) >= threshold
                yield left[row[true]], node[true].astype(np.int64)
                left, entries, width = left[~done], found[~done], width * 2

    def _planted(self, sample: np.ndarray, threshold: float) -> np.ndarray:
        """Near copies of some nodes, from the threshold to half-way to equal: each has a link to be found."""
        draws = np.random.default_rng(len(self.ids))
        vectors = self.exact[sample]
        aside = draws.normal(size=vectors.shape)
        aside -= np.einsum("nd,nd->n", aside, vectors)[:, None] * vectors
        length = np.linalg.norm(aside, axis=1, keepdims=True)
        aside = np.where(length > 0, aside / np.where(length > 0, length, 1), 0)
        cosine = draws.uniform(threshold + 1e-6, (1 + threshold) / 2, size=(len(vectors), 1))
        copies = cosine * vectors + np.sqrt(1 - cosine**2) * aside
        return copies / np.linalg.norm(copies, axis=1, keepdims=True)

    def recall(self, queries: np.ndarray, threshold: float) -> tuple[int, int]:
        """How many links of these vectors are found, and how many there are."""
        wanted = found = 0
        for at in range(0, len(queries), QUERIES):
            part = queries[at : at + QUERIES]
            wanted += len(self._scan(part, threshold)[0])
            found += sum(len(row) for row, _ in self.within(part, threshold))
        return found, wanted

    def _audit(self, threshold: float, asked: tuple[np.ndarray, np.ndarray] | None) -> None:
        """Widen the beam until enough links are found of near copies planted in the shard, and of vectors of all shards.

        Vectors of all shards may have none here; the near copies always have.
        """
        sample = np.argsort((self.ids.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)), kind="stable")[:AUDIT]
        groups = [self._planted(sample, threshold)]  # judged apart
        if asked is not None and len(asked[0]):
            groups.append(asked[1])
        while self.beam * self.layers[0].links < len(self.ids):
            figures = [self.recall(group, threshold) for group in groups]
            if all(found >= RECALL * wanted for found, wanted in figures):
                break
            self.beam *= 2

    def to_bytes(self) -> bytes:
        held = io.BytesIO()
        layers = {f"layer{i}": layer.neighbours for i, layer in enumerate(self.layers)}
        np.savez(held, ids=self.ids, exact=self.exact, beam=self.beam, **layers)
        return held.getvalue()

    @classmethod
    def from_bytes(cls, body: bytes) -> Graph:
        held, graph = np.load(io.BytesIO(body)), cls.__new__(cls)
        graph.ids, graph.exact, graph.beam = held["ids"], held["exact"], int(held["beam"])
        layers = [held[f"layer{i}"] for i in range(len(held.files) - 3)]
        graph._arrange([len(x) for x in layers])
        for layer, neighbours in zip(graph.layers, layers):
            layer.neighbours = neighbours
        return graph
