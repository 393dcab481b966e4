"""What a worker process remembers between rows, within a bound."""

from __future__ import annotations

from collections.abc import Callable, Hashable
from sys import getsizeof
from typing import TypeVar

Key = TypeVar("Key", bound=Hashable)
Value = TypeVar("Value")

#: Bytes that one memory may take.
BYTES = 48_000_000
#: Bytes of an entry besides its key and value: its share of the hash table as that grows.
SLOT = 104


def plain_weight(new: dict) -> int:
    """Bytes of keys and values that hold nothing else."""
    return sum(map(getsizeof, new)) + sum(map(getsizeof, new.values()))


class Recent(dict[Key, Value]):
    """Looks keys up, works out together what is not known, and keeps it.

    There are two generations of half the bound each. When the younger one is full, it takes
    the place of the older one; what is asked for again comes back from there. So frequent
    keys stay, and rare ones are worked out again now and then. What has more bytes than a
    generation is not kept.
    """

    def __init__(
        self,
        made: Callable[[list[Key]], dict[Key, Value]],
        size: int = BYTES,
        weigh: Callable[[dict[Key, Value]], int] = plain_weight,
    ):
        super().__init__()
        self.made, self.half, self.weigh, self.held, self.older = made, size // 2, weigh, 0, {}

    def values_of(self, keys: list[Key]) -> list[Value]:
        """The values of ``keys`` in their order; no value is None."""
        found = list(map(self.get, keys))
        missing = [i for i, value in enumerate(found) if value is None]
        if missing:
            older = self.older.get
            new, unseen = {}, []
            for key in {keys[i] for i in missing}:
                value = older(key)
                if value is None:
                    unseen.append(key)
                else:
                    new[key] = value
            if unseen:
                new.update(self.made(unseen))
            for i in missing:
                found[i] = new[keys[i]]
            self._keep(new)
        return found

    def _keep(self, new: dict[Key, Value]) -> None:
        weight = SLOT * len(new) + self.weigh(new)
        if weight > self.half:
            return
        if self.held + weight > self.half:
            self.older, self.held = self.copy(), 0
            self.clear()
        self.update(new)
        self.held += weight
