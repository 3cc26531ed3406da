"""A minimal acyclic transducer that maps words to token ids.

Words are kept in an automaton that shares prefixes and suffixes. Each arc
carries how many words sort before the ones behind it, so the sum along a word's
path is its number, and the number points to its ids. The arrays are written
one after the other, so that a reader can map the file into memory.
"""

from __future__ import annotations

import heapq
import io
import mmap
import tempfile

import numpy as np

LONGEST = 32  # bytes of a word in the automaton


class Merges:
    """Byte-pair merges of a vocabulary: exact ids of any piece of text."""

    def __init__(self, first: np.ndarray, left: np.ndarray, right: np.ndarray, made: np.ndarray):
        """first: the id of each byte; left, right, made: ids of each merge, by rank."""
        self.first = first.tolist()
        keys = (left.astype(np.int64) << 32 | right.astype(np.int64)).tolist()
        self.rank = dict(zip(keys, range(len(keys))))
        self.made = made.tolist()

    def ids(self, raw: bytes) -> list[int]:
        parts = [self.first[b] for b in raw]
        return self._by_heap(parts) if len(parts) > 64 else self._by_scan(parts)

    def _by_scan(self, parts: list[int]) -> list[int]:
        get, none = self.rank.get, len(self.made)
        ranks = [get(a << 32 | b, none) for a, b in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            parts[i : i + 2] = [self.made[best]]
            del ranks[i]
            if i:
                ranks[i - 1] = get(parts[i - 1] << 32 | parts[i], none)
            if i < len(ranks):
                ranks[i] = get(parts[i] << 32 | parts[i + 1], none)
        return parts

    def _by_heap(self, parts: list[int]) -> list[int]:
        """The same in n log n, for pieces without a space for long."""
        n, get = len(parts), self.rank.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (rank := get(parts[i] << 32 | parts[j])) is not None:
                heapq.heappush(heap, (rank, i, parts[i], parts[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i] if alive[i] else n
            if j >= n or parts[i] != a or parts[j] != b:
                continue
            parts[i], alive[j] = self.made[rank], False
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [p for p, kept in zip(parts, alive) if kept]


def compile_words(words: list[bytes]) -> dict[str, np.ndarray]:
    """The automaton of sorted distinct words, as arrays. Words come in order, so
    when a prefix is left behind nothing can be added to it: its states are then
    replaced by equal ones that exist."""
    register: dict[tuple, int] = {}
    counts: list[int] = []
    path: list[tuple[dict[int, int], list[bool]]] = [({}, [False])]

    def settle(node: tuple[dict[int, int], list[bool]]) -> int:
        arcs, final = node
        key = (final[0], *arcs.items())
        state = register.setdefault(key, len(register))
        if state == len(counts):
            counts.append(final[0] + sum(counts[s] for s in arcs.values()))
        return state

    last = b""
    for word in words:
        shared = 0
        while shared < min(len(last), len(word)) and last[shared] == word[shared]:
            shared += 1
        while len(path) > shared + 1:
            state = settle(path.pop())
            path[-1][0][last[len(path) - 1]] = state
        for _ in word[shared:]:
            path.append(({}, [False]))
        path[-1][1][0] = True
        last = word
    while len(path) > 1:
        state = settle(path.pop())
        path[-1][0][last[len(path) - 1]] = state
    root = settle(path[0])
    keys, targets, outputs, finals = [], [], [], []
    for (final, *arcs), state in register.items():
        finals.append(final)
        before = int(final)
        for byte, target in arcs:
            keys.append(state * 256 + byte)
            targets.append(target)
            outputs.append(before)
            before += counts[target]
    order = np.argsort(np.array(keys, dtype=np.int64), kind="stable")
    return {
        "keys": np.array(keys, dtype=np.int64)[order],
        "targets": np.array(targets, dtype=np.int32)[order],
        "outputs": np.array(outputs, dtype=np.int32)[order],
        "finals": np.array(finals, dtype=np.bool_),
        "root": np.array([root], dtype=np.int64),
    }


def look_up(automaton: dict[str, np.ndarray], words: list[bytes]) -> np.ndarray:
    """The number of each word, -1 where the automaton lacks it. All words take
    their next byte together."""
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    numbers = np.full(len(words), -1, dtype=np.int64)
    live = np.flatnonzero(sizes <= LONGEST)
    if not len(live) or not len(automaton["keys"]):
        return numbers
    cells = np.array([words[i] for i in live], dtype=f"S{LONGEST}").view(np.uint8).reshape(len(live), LONGEST)
    sizes = sizes[live]
    state = np.full(len(live), automaton["root"][0], dtype=np.int64)
    total = np.zeros(len(live), dtype=np.int64)
    rows = np.arange(len(live))
    keys = automaton["keys"]
    for place in range(int(sizes.max()) + 1):
        ends = sizes[rows] == place
        if ends.any():
            done = rows[ends]
            found = done[automaton["finals"][state[done]]]
            numbers[live[found]] = total[found]
            rows = rows[~ends]
        if not len(rows):
            break
        want = state[rows] * 256 + cells[rows, place]
        at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
        rows, at = rows[keys[at] == want], at[keys[at] == want]
        total[rows] += automaton["outputs"][at]
        state[rows] = automaton["targets"][at]
    return numbers


def pack(arrays: dict[str, np.ndarray]) -> bytes:
    """Name, type and length of each array in a first line, then the arrays."""
    head, body, at = [], io.BytesIO(), 0
    for name, array in arrays.items():
        body.write(b"\0" * (-at % 64))
        at += -at % 64
        head.append(f"{name}:{array.dtype.str}:{at}:{len(array)}")
        raw = np.ascontiguousarray(array).tobytes()
        body.write(raw)
        at += len(raw)
    first = (",".join(head) + "\n").encode()
    return first + b"\0" * (-len(first) % 64) + body.getvalue()


def mapped(blob: bytes) -> dict[str, np.ndarray]:
    """The arrays of a packed file, mapped: this process writes the file, which
    has no name any more and goes with the process."""
    with tempfile.TemporaryFile() as file:
        file.write(blob)
        file.flush()
        view = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
    line = view[: view.find(b"\n")].decode()
    start = len(line) + 1 + -(len(line) + 1) % 64
    out = {}
    for entry in line.split(","):
        name, kind, at, n = entry.split(":")
        out[name] = np.frombuffer(view, dtype=np.dtype(kind), count=int(n), offset=start + int(at))
    return out
