"""Cheapest paths through a few states, step by step, kept as a tree that shrinks from its root."""

from __future__ import annotations

from collections.abc import Hashable, Iterable, Iterator, Mapping
from typing import Any

Edge = tuple[Hashable, Hashable, int, str, Any]


class _Node:
    """One step of a path: its label, what it stands for, the step before, and the steps after."""

    __slots__ = ("above", "below", "label", "step", "what")

    def __init__(self, above: _Node | None, step: int, label: str, what: Any):
        self.above, self.step, self.label, self.what = above, step, label, what
        # The node's reference count is the length of this list.
        self.below: list[_Node] = []


class Survivors:
    """The cheapest path to every state, ties by the least label, with what all of them share emitted.

    Paths form a tree of back pointers. A node that no survivor refers to any more is dropped,
    and as soon as all survivors share the root's only child that step is final and handed out.
    So the tree holds no more than the steps on which the survivors still differ; tied paths are
    compared on all of those.

    ``slack`` says for two states how much more the rest of any path from the first one can cost
    when it is followed from the second. A path that is dearer than another by more than that
    can't be part of the answer and doesn't survive.
    """

    def __init__(self, start: Hashable, slack: Mapping[tuple[Hashable, Hashable], int] | None = None):
        self._slack = slack or {}
        self._root = _Node(None, 0, "", None)
        self._tips: dict[Hashable, tuple[int, _Node]] = {start: (0, self._root)}
        self._steps = 0

    @property
    def states(self) -> list[Hashable]:
        return list(self._tips)

    def cost(self, state: Hashable) -> int:
        return self._tips[state][0]

    def step(self, edges: Iterable[Edge]) -> Iterator[tuple[str, Any]]:
        """Follow edges (from, to, cost, label, what) from every state; what became final."""
        best: dict[Hashable, tuple[int, _Node, str, Any]] = {}
        for source, to, cost, label, what in edges:
            tip = self._tips.get(source)
            if tip is None:
                continue
            total, node = tip[0] + cost, tip[1]
            held = best.get(to)
            if (
                held is None
                or total < held[0]
                or total == held[0]
                and self._less(node, label, held[1], held[2])
            ):
                best[to] = (total, node, label, what)
        if not best:
            raise ValueError("no edge leads on from any survivor")
        best = {x: path for x, path in best.items() if not self._hopeless(x, path[0], best)}
        self._steps += 1
        old, self._tips = self._tips, {}
        for to, (total, node, label, what) in best.items():
            fresh = _Node(node, self._steps, label, what)
            node.below.append(fresh)
            self._tips[to] = (total, fresh)
        for _, node in old.values():
            while not node.below and node.above is not None:
                node.above.below.remove(node)
                node = node.above
        return self._settle()

    def _hopeless(self, x: Hashable, cost: int, best: dict) -> bool:
        slack = ((y, self._slack.get((x, y))) for y in best)
        return any(more is not None and cost > best[y][0] + more for y, more in slack)

    def _settle(self) -> Iterator[tuple[str, Any]]:
        final = []
        while len(self._root.below) == 1:
            (self._root,) = self._root.below
            self._root.above = None
            final.append((self._root.label, self._root.what))
        return iter(final)

    @staticmethod
    def _less(x: _Node, x_label: str, y: _Node, y_label: str) -> bool:
        """Whether the path to ``x`` and on by its label comes before the one to ``y``."""
        xs, ys = [x_label], [y_label]
        while x is not y:
            xs.append(x.label)
            ys.append(y.label)
            x, y = x.above, y.above
        return "".join(reversed(xs)) < "".join(reversed(ys))

    def path(self, state: Hashable) -> list[tuple[str, Any]]:
        """The steps to ``state`` that are not final yet."""
        node, steps = self._tips[state][1], []
        while node is not self._root:
            steps.append((node.label, node.what))
            node = node.above
        return steps[::-1]

    def unsettled(self) -> int:
        """Steps on which the survivors still differ."""
        return self._steps - self._root.step
