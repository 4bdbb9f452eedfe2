"""Byte-pair vocabularies of the public tokenizers library's JSON files, and exact merging by heap and linked list."""

from __future__ import annotations

import heapq
import json
from functools import lru_cache

NONE = -1


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte value in byte-level vocabularies.

    Printable Latin-1 characters stand for themselves, the others for the code points from 256 on, in order.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in set(shown) else chr(next(spare)) for b in range(256)]


class Merges:
    """Symbols are vocabulary ids; ``pair`` gives (rank, merged id) of an adjacent pair."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.special: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.alphabet = byte_alphabet()
        self.byte_id = [self.vocab[c] for c in self.alphabet]
        self.last_id = [self.vocab[c + self.suffix] for c in self.alphabet] if self.suffix else self.byte_id
        self.pair: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            self.pair[self.vocab[left], self.vocab[right]] = (rank, self.vocab[left + right])

    def symbols(self, word: str) -> list[int]:
        raw = word.encode("utf-8")
        ids = [self.byte_id[b] for b in raw]
        ids[-1] = self.last_id[raw[-1]]
        return ids

    def merge(self, symbols: list[int]) -> tuple[int, list[int], list[int]]:
        """Merge ``symbols`` in place; gives the number of merges, the symbols and the list of successors.

        Repeatedly the adjacent pair of lowest rank, the leftmost of equals, is popped. Entries that a later merge has made
        stale are recognised by their symbols and skipped, so the cost is O(n log n).
        """
        n, pair = len(symbols), self.pair
        following, before = [*range(1, n), NONE], list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            found = pair.get((symbols[i], symbols[i + 1]))
            if found:
                heap.append((found[0], i, symbols[i], symbols[i + 1], found[1]))
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, i, left, right, merged = heapq.heappop(heap)
            j = following[i]
            if j == NONE or symbols[i] != left or symbols[j] != right:
                continue
            merges += 1
            symbols[i], symbols[j] = merged, NONE
            k, h = following[j], before[i]
            following[i] = k
            if k != NONE:
                before[k] = i
                if found := pair.get((merged, symbols[k])):
                    heapq.heappush(heap, (found[0], i, merged, symbols[k], found[1]))
            if h != NONE and (found := pair.get((symbols[h], merged))):
                heapq.heappush(heap, (found[0], h, symbols[h], merged, found[1]))
        return merges, symbols, following


@lru_cache(maxsize=4)
def load(path: str) -> Merges:
    """Read once per Python worker."""
    return Merges(path)
