"""Counting id sequences in a burst trie of hash containers (a HAT-trie over word ids).

A key is a sequence of ids, four bytes each, so the order of keys is that of their bytes. Containers
are hash tables of keys with counts. A container covers a range of leading ids; one that grows beyond
``BURST`` entries is cut in two at an id in its middle, and one that covers a single id becomes a node
of the trie, which takes that id off its keys and goes on with a container below. The trie stays
shallow: only ids with many followers get nodes.

When the trie holds more than its budget, whole subtrees leave it as sorted runs, the largest first.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

BURST = 16_384
ID_BYTES = 4


class Container:
    """Keys that begin with an id from ``low`` up to the next container's."""

    __slots__ = ("low", "table")

    def __init__(self, low: bytes, table: dict[bytes, int]):
        self.low, self.table = low, table

    def __len__(self) -> int:
        return len(self.table)

    def add(self, keys: list[bytes], counts: list[int]) -> int:
        table, before = self.table, len(self.table)
        get = table.get
        for key, n in zip(keys, counts, strict=True):
            table[key] = get(key, 0) + n
        return len(table) - before

    def run(self) -> Iterator[tuple[bytes, int]]:
        return iter(sorted(self.table.items()))

    def burst(self) -> list[Container | Node]:
        """Two containers of smaller ranges; or a node, where all keys begin with one id, between
        containers for the ids below and above it."""
        heads = sorted(key[:ID_BYTES] for key in self.table)
        if heads[0] == heads[-1]:
            above = (int.from_bytes(heads[0]) + 1).to_bytes(ID_BYTES)
            node = Node(heads[0], {key[ID_BYTES:]: n for key, n in self.table.items()})
            return [Container(self.low, {})] * (self.low < heads[0]) + [node, Container(above, {})]
        middle = heads[len(heads) // 2]
        if middle == heads[0]:
            middle = heads[bisect_right(heads, middle)]
        lower = {key: n for key, n in self.table.items() if key < middle}
        upper = {key: n for key, n in self.table.items() if key >= middle}
        return [Container(self.low, lower), Container(middle, upper)]


class Node:
    """All keys that begin with the id ``low``; the trie below holds what follows it."""

    __slots__ = ("low", "below")

    def __init__(self, low: bytes, table: dict[bytes, int]):
        self.low, self.below = low, HatTrie(table)

    def __len__(self) -> int:
        return len(self.below)

    def add(self, keys: list[bytes], counts: list[int]) -> int:
        return self.below.add([key[ID_BYTES:] for key in keys], counts)

    def run(self) -> Iterator[tuple[bytes, int]]:
        return ((self.low + key, n) for key, n in self.below.run())


class HatTrie:
    def __init__(self, table: dict[bytes, int] | None = None):
        self.parts: list[Container | Node] = [Container(b"", table or {})]
        self.lows: list[bytes] = [b""]
        self.held = len(table or {})

    def __len__(self) -> int:
        return self.held

    def add(self, keys: list[bytes], counts: list[int]) -> int:
        """Adds sorted distinct keys of one length; returns the number of new entries."""
        if not keys:
            return 0
        before, i = self.held, max(0, bisect_right(self.lows, keys[0]) - 1)
        start = 0
        while start < len(keys):
            stop = len(keys) if i + 1 == len(self.parts) else bisect_left(keys, self.lows[i + 1], start)
            if stop > start:
                self.held += self.parts[i].add(keys[start:stop], counts[start:stop])
                start = stop
                if isinstance(self.parts[i], Container) and len(self.parts[i]) > BURST:
                    i += self._burst(i)
            i += 1
        return self.held - before

    def _burst(self, i: int) -> int:
        """Bursts a part until none of what comes of it is too large; returns how many more there are."""
        done, todo = [], [self.parts[i]]
        while todo:
            part = todo.pop(0)
            if isinstance(part, Container) and len(part) > BURST:
                todo = part.burst() + todo
            else:
                done.append(part)
        self.parts[i : i + 1] = done
        self.lows[i : i + 1] = [p.low for p in done]
        return len(done) - 1

    def run(self) -> Iterator[tuple[bytes, int]]:
        for part in self.parts:
            yield from part.run()

    def spill(self, keep: int) -> Iterator[Iterator[tuple[bytes, int]]]:
        """Takes out whole subtrees, the largest first, until at most ``keep`` entries are held, and
        gives each as a sorted run."""
        for i in sorted(range(len(self.parts)), key=lambda i: -len(self.parts[i])):
            if self.held <= keep:
                break
            part = self.parts[i]
            self.held -= len(part)
            self.parts[i] = Container(part.low, {})
            yield part.run()
        # emptied ranges join the container before them; a node has no range but its id
        kept: list[Container | Node] = []
        for part in self.parts:
            if len(part) or not kept or isinstance(kept[-1], Node):
                kept.append(part)
        self.parts, self.lows = kept, [p.low for p in kept]
