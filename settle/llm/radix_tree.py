"""Adaptive radix tree over byte keys: nodes that grow with their children, paths compressed."""

from __future__ import annotations

from bisect import bisect
from collections.abc import Callable, Iterator
from typing import Any


class Node:
    """A node of 4, 16, 48 or 256 places for children, told apart by their next byte.

    `prefix` is the compressed path below the byte that leads here. Nodes of 4
    and 16 places keep sorted bytes beside the children, a node of 48 keeps a
    place for each byte value, a node of 256 has a child or None for each.
    """

    __slots__ = ("children", "keys", "prefix", "size", "value")

    def __init__(self, prefix: bytes, value: Any = None):
        self.prefix, self.value = prefix, value
        self.size, self.keys, self.children = 4, b"", None  # a leaf takes no room for children

    def child(self, byte: int) -> Node | None:
        if self.children is None:
            return None
        if self.size <= 16:
            place = self.keys.find(byte)
            return self.children[place] if place >= 0 else None
        if self.size == 48:
            return self.children[self.keys[byte] - 1] if self.keys[byte] else None
        return self.children[byte]

    def put(self, byte: int, child: Node) -> None:
        """Add a child, or replace the one of that byte."""
        if self.children is None:
            self.keys, self.children = bytearray(), []
        if self.size <= 16:
            place = self.keys.find(byte)
            if place >= 0:
                self.children[place] = child
                return
            if len(self.keys) < self.size:
                place = bisect(self.keys, byte)
                self.keys.insert(place, byte)
                self.children.insert(place, child)
                return
        elif self.size == 48:
            if self.keys[byte]:
                self.children[self.keys[byte] - 1] = child
                return
            if len(self.children) < 48:
                self.children.append(child)
                self.keys[byte] = len(self.children)
                return
        else:
            self.children[byte] = child
            return
        self._grow()
        self.put(byte, child)

    def _grow(self) -> None:
        if self.size == 4:
            self.size = 16
        elif self.size == 16:
            places = bytearray(256)
            for place, byte in enumerate(self.keys):
                places[byte] = place + 1
            self.size, self.keys = 48, places
        else:
            every: list[Node | None] = [None] * 256
            for byte, place in enumerate(self.keys):
                if place:
                    every[byte] = self.children[place - 1]
            self.size, self.keys, self.children = 256, b"", every

    def ordered(self) -> Iterator[Node]:
        """Children by rising byte."""
        if self.children is None:
            return iter(())
        if self.size <= 16:
            return iter(self.children)
        if self.size == 48:
            return (self.children[place - 1] for place in self.keys if place)
        return (child for child in self.children if child is not None)


def common_length(one: bytes, other: bytes) -> int:
    """Bytes that both begin with."""
    most = min(len(one), len(other))
    if one[:most] == other[:most]:
        return most
    low, high = 0, most  # the first `low` are equal, the first `high` are not
    while high - low > 1:
        middle = (low + high) // 2
        if one[low:middle] == other[low:middle]:
            low = middle
        else:
            high = middle
    return low


class Tree:
    def __init__(self) -> None:
        self.root: Node | None = None

    def insert(self, key: bytes) -> Node:
        """The node where `key` ends, made if it is new."""
        if self.root is None:
            self.root = Node(key)
            return self.root
        parent, byte, node, at = None, 0, self.root, 0
        while True:
            rest = key[at : at + len(node.prefix)]
            shared = len(rest) if rest == node.prefix else common_length(rest, node.prefix)
            if shared < len(node.prefix):  # the path parts inside the prefix
                upper = Node(node.prefix[:shared])
                upper.put(node.prefix[shared], node)
                node.prefix = node.prefix[shared + 1 :]
                if parent is None:
                    self.root = upper
                else:
                    parent.put(byte, upper)
                node = upper
            at += shared
            if at == len(key):
                return node
            parent, byte, at = node, key[at], at + 1
            below = node.child(byte)
            if below is None:
                made = Node(key[at:])
                node.put(byte, made)
                return made
            node = below

    def path(self, key: bytes) -> Iterator[Node]:
        """Nodes from the root to the end of a key that is in the tree."""
        node, at = self.root, len(self.root.prefix)
        yield node
        while at < len(key):
            node = node.child(key[at])
            at += 1 + len(node.prefix)
            yield node

    def fold(self, visit: Callable[[Node, int, int, list], Any]) -> Any:
        """visit(node, start, end, results of its children), children first; the root's result.

        A node covers the byte depths from `start` (not included; -1 for the root) to `end`.
        """
        frames = [(self.root, -1, len(self.root.prefix), self.root.ordered(), [])]
        while True:
            node, start, end, left, results = frames[-1]
            child = next(left, None)
            if child is not None:
                frames.append((child, end, end + 1 + len(child.prefix), child.ordered(), []))
                continue
            frames.pop()
            result = visit(node, start, end, results)
            if not frames:
                return result
            frames[-1][4].append(result)
