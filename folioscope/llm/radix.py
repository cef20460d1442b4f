"""Adaptive radix trees over byte keys (Leis et al., 2013): nodes grow with their fan-out, single paths are compressed."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b
from itertools import takewhile
from typing import Any

NOBODY = (1 << 63) - 1


class Listed:
    """Up to 4, then up to 16 children under their sorted key bytes."""

    __slots__ = ("room", "bytes", "kids")

    def __init__(self, room: int = 4):
        self.room, self.bytes, self.kids = room, bytearray(), []

    def get(self, byte: int) -> Node | None:
        at = self.bytes.find(byte)
        return self.kids[at] if at >= 0 else None

    def put(self, byte: int, kid: Node) -> Listed | Indexed:
        """The layout with the new child, which is a larger one if this one is full."""
        if len(self.kids) == self.room == 16:
            return Indexed(self).put(byte, kid)
        self.room = 16 if len(self.kids) >= 4 else self.room
        at = bisect_left(self.bytes, byte)
        self.bytes.insert(at, byte)
        self.kids.insert(at, kid)
        return self

    def items(self) -> Iterator[tuple[int, Node]]:
        return zip(self.bytes, self.kids)


class Indexed:
    """Up to 48 children, their places under all 256 bytes."""

    __slots__ = ("places", "kids")

    def __init__(self, smaller: Listed):
        self.places, self.kids = bytearray(256), []
        for byte, kid in smaller.items():
            self.put(byte, kid)

    def get(self, byte: int) -> Node | None:
        at = self.places[byte]
        return self.kids[at - 1] if at else None

    def put(self, byte: int, kid: Node) -> Indexed | Direct:
        if len(self.kids) == 48:
            return Direct(self).put(byte, kid)
        self.kids.append(kid)
        self.places[byte] = len(self.kids)
        return self

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((byte, self.kids[at - 1]) for byte, at in enumerate(self.places) if at)


class Direct:
    """A child for each of the 256 bytes."""

    __slots__ = ("kids",)

    def __init__(self, smaller: Indexed):
        self.kids: list[Node | None] = [None] * 256
        for byte, kid in smaller.items():
            self.kids[byte] = kid

    def get(self, byte: int) -> Node | None:
        return self.kids[byte]

    def put(self, byte: int, kid: Node) -> Direct:
        self.kids[byte] = kid
        return self

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((byte, kid) for byte, kid in enumerate(self.kids) if kid is not None)


class Node:
    """A compressed path, the value of the key that ends after it (None if none does) and the children."""

    __slots__ = ("path", "value", "layout")

    def __init__(self, path: bytes, value: Any = None):
        self.path, self.value, self.layout = path, value, Listed()


def insert(root: Node, key: bytes, value: Any) -> None:
    """Add a key; a path that the key leaves is split."""
    node, at = root, 0
    while True:
        path = node.path
        if not key.startswith(path, at):
            same = sum(1 for _ in takewhile(lambda pair: pair[0] == pair[1], zip(path, memoryview(key)[at:])))
            lower = Node(path[same + 1 :], node.value)
            lower.layout = node.layout
            node.path, node.value, node.layout = path[:same], None, Listed()
            node.layout = node.layout.put(path[same], lower)
        at += len(node.path)
        if at == len(key):
            node.value = value
            return
        kid = node.layout.get(key[at])
        if kid is None:
            node.layout = node.layout.put(key[at], Node(key[at + 1 :], value))
            return
        node, at = kid, at + 1


@dataclass(slots=True)
class Entry:
    """What a key brings: its members, the least of them, the least that ends here, and the totals of what lies below."""

    n: int
    first: int
    end: int | None = None
    kids: int = 0
    leaves: int = 0
    saved: int = 0


class Prefixes:
    """The nodes of a radix tree at byte depths that are whole ids of ``width`` bytes, parents first, as columns.

    The last four bytes of an id are the characters of its text. ``borders`` are the first and the last key of the task
    (None: not in this tree). Their prefixes can go on in other tasks: ``sides`` marks them with 1, 2 or 3, they get a
    key, and the totals ``kids``, ``leaves`` and ``saved`` of such a node leave out all marked nodes, itself included.
    """

    def __init__(self, root: Node, width: int, salt: bytes, borders: tuple[bytes | None, bytes | None]):
        self.width, self.borders = width, borders
        self.parent, self.depth, self.chars, self.sides = [], [], [], []
        self.end: list[int | None] = []
        self.n, self.first, self.kids, self.leaves, self.saved = [], [], [], [], []
        self.key: dict[int, bytes] = {}
        self._hashers = {-1: blake2b(salt, digest_size=16)}
        top = self._add(-1, b"", sum(bit for bit, key in zip((1, 2), borders) if key is not None))
        # node, bytes since the last whole id, place of that id in the columns
        stack = [(root, root.path, top)]
        while stack:
            node, loose, at = stack.pop()
            whole = len(loose) - len(loose) % width
            for i in range(0, whole, width):
                at = self._add(at, loose[i : i + width], self.sides[at])
            loose = loose[whole:]
            if node.value is not None:
                self._enter(at, node.value)
            stack += [(kid, loose + bytes((byte,)) + kid.path, at) for byte, kid in node.layout.items()]
        self._total()

    def _add(self, parent: int, turn: bytes, sides: int) -> int:
        at, depth = len(self.depth), self.depth[parent] + 1 if parent >= 0 else 0
        if sides and parent >= 0:
            start = (depth - 1) * self.width
            sides = sum(bit for bit, key in zip((1, 2), self.borders) if sides & bit and key.startswith(turn, start))
        if sides:
            hasher = self._hashers[parent].copy()
            hasher.update(turn)
            self._hashers[at], self.key[at] = hasher, hasher.digest()
        self.parent.append(parent)
        self.depth.append(depth)
        self.chars.append(int.from_bytes(turn[-4:], "big"))
        self.sides.append(sides)
        self.end.append(None)
        for column in (self.n, self.first, self.kids, self.leaves, self.saved):
            column.append(0)
        self.first[at] = NOBODY
        return at

    def _enter(self, at: int, own: Entry) -> None:
        self.end[at] = own.end
        self.n[at], self.first[at] = own.n, own.first
        self.kids[at], self.leaves[at], self.saved[at] = own.kids, own.leaves, own.saved

    def _total(self) -> None:
        for at in range(len(self.depth) - 1, -1, -1):
            up = self.parent[at]
            if not self.sides[at]:
                self.leaves[at] += not self.kids[at]
                self.saved[at] += (self.n[at] - 1) * self.chars[at]
            if up < 0:
                continue
            self.kids[up] += not self.sides[at]
            self.n[up] += self.n[at]
            self.first[up] = min(self.first[up], self.first[at])
            self.leaves[up] += self.leaves[at]
            self.saved[up] += self.saved[at]
