"""Survivor-coalescence Viterbi: the cheapest path through a few states, emitted as soon as it is certain.

Survivors are the best paths to each state. They form a tree of back pointers in which every node counts
its children and the survivors at it; a path that no survivor uses is freed at once. When all survivors
share an ancestor, the edits up to it are emitted and the ancestor becomes the root, so what is held is the part on
which survivors still differ. Survivors too dear to win are dropped, as ``apart`` bounds how much one state's
future can cost above another's. Of equally cheap paths that with the least edits as text survives; the two are
compared over all that is unresolved, back to their common ancestor.
"""

from __future__ import annotations

from collections.abc import Hashable, Iterable
from typing import Any


class _Node:
    __slots__ = ("edits", "item", "parent", "uses")

    def __init__(self, parent: _Node | None, edits: str, item: Any) -> None:
        self.parent, self.edits, self.item, self.uses = parent, edits, item, 0


def _suffixes(a: _Node, b: _Node) -> tuple[str, str]:
    """The edits of two nodes of one step since their common ancestor."""
    left, right = [], []
    while a is not b:
        left.append(a.edits)
        right.append(b.edits)
        a, b = a.parent, b.parent
    return "".join(reversed(left)), "".join(reversed(right))


class Survivors:
    def __init__(self, state: Hashable, apart: int) -> None:
        self.root = _Node(None, "", None)
        self.root.uses = 1
        self.alive: dict[Hashable, tuple[int, _Node]] = {state: (0, self.root)}
        self.apart = apart

    def _best(self, moves: Iterable[tuple[Hashable, Hashable, int, str]]) -> dict[Hashable, tuple[int, _Node, str]]:
        """For each state reached: cost, node it comes from, edits."""
        best: dict[Hashable, tuple[int, _Node, str]] = {}
        for source, target, cost, edits in moves:
            before = self.alive.get(source)
            if before is None:
                continue
            total, old = before[0] + cost, best.get(target)
            if old is not None and total >= old[0]:
                if total > old[0]:
                    continue
                mine, theirs = _suffixes(before[1], old[1])
                if mine + edits >= theirs + old[2]:
                    continue
            best[target] = total, before[1], edits
        return best

    def step(self, moves: Iterable[tuple[Hashable, Hashable, int, str]], item: Any = None) -> list[tuple[str, Any]]:
        """Takes the moves (from, to, cost, edits) of one item; returns the (edits, item) that are now certain."""
        best = self._best(moves)
        limit = min(total for total, _, _ in best.values()) + self.apart
        alive = {}
        for state, (total, parent, edits) in best.items():
            if total <= limit:
                node = _Node(parent, edits, item)
                node.uses = 1
                parent.uses += 1
                alive[state] = total, node
        for _, node in self.alive.values():
            self._release(node)
        self.alive = alive
        return self._certain()

    def _release(self, node: _Node) -> None:
        node.uses -= 1
        while node.uses == 0 and node.parent is not None:
            parent, node.parent = node.parent, None
            node = parent
            node.uses -= 1

    def _certain(self) -> list[tuple[str, Any]]:
        """Moves the root along the only path while there is but one."""
        if self.root.uses != 1:
            return []
        _, node = next(iter(self.alive.values()))
        out = []
        for n in reversed(self._path(node)):
            if self.root.uses != 1:
                break
            out.append((n.edits, n.item))
            self.root, n.parent, n.item = n, None, None
        return out

    def _path(self, node: _Node) -> list[_Node]:
        """The nodes from ``node`` up to below the root."""
        path = []
        while node is not self.root:
            path.append(node)
            node = node.parent
        return path

    def paths(self) -> dict[Hashable, tuple[int, list[tuple[str, Any]]]]:
        """For each state that survives: cost and what is unresolved on the way to it."""
        return {state: (cost, [(n.edits, n.item) for n in reversed(self._path(node))]) for state, (cost, node) in self.alive.items()}

    def finish(self, endings: dict[Hashable, tuple[int, str]]) -> tuple[int, list[tuple[str, Any]], str]:
        """Cost of the best path, what of it is unresolved, and the edits of its ending."""
        best = self._best((state, None, cost, edits) for state, (cost, edits) in endings.items())
        cost, node, edits = best[None]
        return cost, [(n.edits, n.item) for n in reversed(self._path(node))], edits
