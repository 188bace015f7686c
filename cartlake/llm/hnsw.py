"""A hierarchical navigable small-world graph over unit vectors, in memory bounded by its shard."""

from __future__ import annotations

import heapq
import pickle

import numpy as np

# Links per node on the upper layers; the lowest layer has twice as many.
LINKS = 12
BUILD_BEAM = 64


class Graph:
    """Vectors are rows of ``vectors``, scaled to length one. Layers are adjacency lists."""

    def __init__(self, vectors: np.ndarray, layers: list[dict[int, list[int]]] | None = None, entry: int = 0):
        self.v = vectors.astype(np.float32)
        self.layers = layers or [{}]
        self.entry = entry

    @classmethod
    def build(cls, vectors: np.ndarray, seed: int = 7) -> Graph:
        graph = cls(vectors)
        tops = np.random.default_rng(seed).exponential(1 / np.log(LINKS), len(vectors)).astype(int)
        for node, top in enumerate(tops.tolist()):
            graph._insert(node, top)
        return graph

    def blob(self) -> bytes:
        return pickle.dumps((self.layers, self.entry), protocol=5)

    @classmethod
    def load(cls, vectors: np.ndarray, blob: bytes) -> Graph:
        layers, entry = pickle.loads(blob)
        return cls(vectors, layers, entry)

    def _insert(self, node: int, top: int) -> None:
        if node == 0:
            self.layers = [{0: []} for _ in range(top + 1)]
            return
        q = self.v[node]
        at = [(float(self.v[self.entry] @ q), self.entry)]
        for level in range(len(self.layers) - 1, top, -1):
            at = self._beam(q, at, 1, level)
        for level in range(min(top, len(self.layers) - 1), -1, -1):
            at = self._beam(q, at, BUILD_BEAM, level)
            layer = self.layers[level]
            most = 2 * LINKS if level == 0 else LINKS
            chosen = self._spread([i for _, i in sorted(at, reverse=True)], q, LINKS)
            layer[node] = chosen
            for other in chosen:
                back = layer[other]
                back.append(node)
                if len(back) > most:
                    sims = self.v[back] @ self.v[other]
                    layer[other] = self._spread([back[i] for i in np.argsort(-sims)], self.v[other], most)
        if top >= len(self.layers):
            self.layers += [{node: []} for _ in range(top + 1 - len(self.layers))]
            self.entry = node

    def _spread(self, nearest: list[int], q: np.ndarray, most: int) -> list[int]:
        """Neighbours in different directions: one that is closer to a chosen neighbour than to
        ``q`` waits until the others are through, so clusters stay connected to the rest."""
        if len(nearest) <= most:
            return list(nearest)
        rows = self.v[nearest]
        own, among = (rows @ q).tolist(), rows @ rows.T
        blocked = np.full(len(nearest), -2.0, np.float32)
        chosen, waiting = [], []
        for i in range(len(nearest)):
            if blocked[i] < own[i]:
                chosen.append(i)
                np.maximum(blocked, among[i], out=blocked)
                if len(chosen) == most:
                    break
            else:
                waiting.append(i)
        chosen += waiting[: most - len(chosen)]
        return [nearest[i] for i in chosen]

    def _beam(self, q: np.ndarray, start: list[tuple[float, int]], width: int, level: int):
        """The ``width`` most similar nodes that a best-first walk finds, as (similarity, node)."""
        layer, v = self.layers[level], self.v
        seen = {i for _, i in start}
        todo = [(-s, i) for s, i in start]
        best = list(start)
        heapq.heapify(todo)
        heapq.heapify(best)
        while len(best) > width:
            heapq.heappop(best)
        while todo:
            s, node = heapq.heappop(todo)
            if -s < best[0][0] and len(best) >= width:
                break
            new = [i for i in layer[node] if i not in seen]
            if not new:
                continue
            seen.update(new)
            for sim, i in zip((v[new] @ q).tolist(), new):
                if len(best) < width:
                    heapq.heappush(best, (sim, i))
                    heapq.heappush(todo, (-sim, i))
                elif sim > best[0][0]:
                    heapq.heapreplace(best, (sim, i))
                    heapq.heappush(todo, (-sim, i))
        return best

    def within(self, q: np.ndarray, least: float, width: int) -> list[int]:
        """Nodes of similarity ``least`` and more. A beam that is full of them is widened."""
        at = [(float(self.v[self.entry] @ q), self.entry)]
        for level in range(len(self.layers) - 1, 0, -1):
            at = self._beam(q, at, 1, level)
        while True:
            found = self._beam(q, at, width, 0)
            if found[0][0] < least or len(found) < width:
                return [i for s, i in found if s >= least]
            at, width = found, 2 * width
