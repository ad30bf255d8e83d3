"""What a worker remembers of pieces of text, bounded in bytes."""

from __future__ import annotations

import gc
from collections.abc import Callable, Hashable, Iterable
from typing import Any

#: What an entry takes beside its characters, about.
ENTRY_BYTES = 300
#: Objects a worker makes before the collector looks for cycles: memos hold
#: hundreds of thousands of small objects, and none are in cycles.
COLLECT_EVERY = 200_000


class Memo(dict):
    """Results by argument, in two generations.

    Arguments met since the last full generation are the young ones. When they
    take ``most_bytes`` they become the old ones, and what was old is dropped:
    frequent arguments move on, rare ones go. Results of arguments longer than
    ``most_key`` are not kept, so that no long text stays in memory.

    ``results`` gives the results of a list of arguments; ``learn`` lets it
    work on all that are new at once.
    """

    def __init__(
        self, results: Callable[[list], list], most_bytes: int, most_key: int = 64, size: Callable[[Any], int] = len
    ) -> None:
        super().__init__()
        gc.set_threshold(COLLECT_EVERY, *gc.get_threshold()[1:])
        self.results, self.most_bytes, self.most_key, self.size = results, most_bytes, most_key, size
        self.held, self.old = 0, {}

    def _put(self, key: Hashable, value: Any) -> None:
        size = self.size(key)
        if size <= self.most_key:
            if self.held >= self.most_bytes:
                self.old = dict(self)
                self.clear()
                self.held = 0
            self[key] = value
            self.held += ENTRY_BYTES + 8 * size

    def __missing__(self, key: Hashable) -> Any:
        value = self.old.get(key)
        if value is None:
            value = self.results([key])[0]
        self._put(key, value)
        return value

    def learn(self, keys: Iterable) -> None:
        old, size, most = self.old, self.size, self.most_key
        new = [k for k in {k for k in keys if k not in self} if k not in old and size(k) <= most]
        for key, value in zip(new, self.results(new) if new else []):
            self._put(key, value)
