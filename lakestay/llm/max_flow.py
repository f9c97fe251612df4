"""Two-label problems solved exactly by a minimum cut."""

from __future__ import annotations

from collections import deque


def minimum_cut(scores: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Labels that minimise the total cost; ties give False where both labels cost the same.

    Labelling i False costs scores[i] if positive, True costs -scores[i] if negative; an edge
    (i, j, weight) costs its weight if i and j differ. Weights are positive integers.

    Nodes whose score outweighs all their edges are settled first, and with them the terms of
    their neighbours; what is left is cut by maximum flow from True to False.
    """
    n = len(scores)
    score = list(scores)
    near: list[dict[int, int]] = [{} for _ in range(n)]
    for i, j, w in edges:
        if i != j:
            near[i][j] = near[i].get(j, 0) + w
            near[j][i] = near[j].get(i, 0) + w
    bound = [sum(x.values()) for x in near]
    label: list[bool | None] = [None] * n
    open_nodes = deque(range(n))
    while open_nodes:
        i = open_nodes.popleft()
        if label[i] is not None or abs(score[i]) <= bound[i]:
            continue
        label[i] = score[i] > 0
        for j, w in near[i].items():
            if label[j] is None:
                score[j] += w if label[i] else -w
                bound[j] -= w
                open_nodes.append(j)
    left = [i for i in range(n) if label[i] is None]
    if left:
        graph = _Flow(len(left) + 2)
        place = {i: k + 2 for k, i in enumerate(left)}
        for i in left:
            if score[i] > 0:
                graph.join(0, place[i], score[i], 0)
            elif score[i] < 0:
                graph.join(place[i], 1, -score[i], 0)
            for j, w in near[i].items():
                if i < j and label[j] is None:
                    graph.join(place[i], place[j], w, w)
        true = graph.source_side(0, 1)
        for i in left:
            label[i] = true[place[i]]
    return [bool(x) for x in label]


class _Flow:
    """Maximum flow by shortest blocking paths (Dinic)."""

    def __init__(self, nodes: int):
        self.out: list[list[int]] = [[] for _ in range(nodes)]
        self.to: list[int] = []
        self.room: list[int] = []

    def join(self, a: int, b: int, forward: int, backward: int) -> None:
        for x, y, room in ((a, b, forward), (b, a, backward)):
            self.out[x].append(len(self.to))
            self.to.append(y)
            self.room.append(room)

    def _levels(self, source: int) -> list[int]:
        level = [-1] * len(self.out)
        level[source] = 0
        queue = deque([source])
        while queue:
            x = queue.popleft()
            for e in self.out[x]:
                if self.room[e] and level[self.to[e]] < 0:
                    level[self.to[e]] = level[x] + 1
                    queue.append(self.to[e])
        return level

    def source_side(self, source: int, sink: int) -> list[bool]:
        """Which nodes the source still reaches when the flow is greatest."""
        while (level := self._levels(source))[sink] >= 0:
            tried = [0] * len(self.out)
            path: list[int] = []
            x = source
            while True:
                if x == sink:
                    least = min(self.room[e] for e in path)
                    for e in path:
                        self.room[e] -= least
                        self.room[e ^ 1] += least
                    path, x = [], source
                    continue
                out = self.out[x]
                while tried[x] < len(out):
                    e = out[tried[x]]
                    if self.room[e] and level[self.to[e]] == level[x] + 1:
                        break
                    tried[x] += 1
                if tried[x] < len(out):
                    path.append(out[tried[x]])
                    x = self.to[path[-1]]
                elif path:
                    x = self.to[path.pop() ^ 1]
                    tried[x] += 1
                else:
                    break
        return [x >= 0 for x in level]
