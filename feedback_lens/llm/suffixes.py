"""External induced sorting of the suffixes of one shard, with common-prefix values.

Suffixes are of type S or L as they are smaller or larger than the next one. The leftmost S suffixes are sorted first: one induction sorts the
substrings between them, equal ones get equal names, and the string of names is sorted one level down by rank doubling. From their
order a second induction yields all suffixes: passing over the sorted ones, each puts its predecessor behind what its first byte's
queue already has (ascending for type L, descending for type S). With a suffix goes the length of the prefix it shares with the one
before it: one more than the least value met between the two suffixes that induced them.

Queues are keyed by first byte and emptied in key order, so they are a monotone priority queue. They work on whole arrays, and spill to
files beyond ``memory`` bytes; the text and its types are memory-mapped. Order and common prefixes are exact up to ``limit`` bytes; suffixes
that agree further are neighbours in any order.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np

SYMBOLS = 258  # 0 ends the shard, 1 ends a string, then the bytes


class Queues:
    """For each symbol a first-in first-out queue of (position, common prefix)."""

    def __init__(self, folder: str, memory: int) -> None:
        self.folder, self.memory, self.held = folder, memory, 0
        self.chunks: list[list] = [[] for _ in range(SYMBOLS)]
        self.files = 0

    def push(self, symbol: int, positions: np.ndarray, shared: np.ndarray) -> None:
        self.chunks[symbol].append((positions, shared))
        self.held += positions.nbytes + shared.nbytes
        if self.held > self.memory:
            self._spill()

    def _spill(self) -> None:
        """Write the fullest queues to disk until half of the memory is free."""
        size = lambda chunks: sum(c[0].nbytes + c[1].nbytes for c in chunks if not isinstance(c, str))
        for symbol in sorted(range(SYMBOLS), key=lambda s: -size(self.chunks[s])):
            if self.held <= self.memory // 2:
                break
            kept = []
            for chunk in self.chunks[symbol]:
                if not isinstance(chunk, str):
                    path = os.path.join(self.folder, f"queue{id(self)}_{self.files}.npz")
                    self.files += 1
                    np.savez(path, p=chunk[0], s=chunk[1])
                    self.held -= chunk[0].nbytes + chunk[1].nbytes
                    chunk = path
                kept.append(chunk)
            self.chunks[symbol] = kept

    def drain(self, symbol: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Chunks in order; what is pushed meanwhile comes too."""
        while self.chunks[symbol]:
            chunk = self.chunks[symbol].pop(0)
            if isinstance(chunk, str):
                with np.load(chunk) as file:
                    positions, shared = file["p"], file["s"]
                os.unlink(chunk)
            else:
                positions, shared = chunk
                self.held -= positions.nbytes + shared.nbytes
            yield positions, shared


class Shard:
    """Strings written one after another to a file, then sorted."""

    def __init__(self, limit: int, memory: int = 256 << 20) -> None:
        self.limit, self.memory = limit, memory
        self._scratch = tempfile.TemporaryDirectory(prefix="suffixes")
        self.folder = self._scratch.name
        self.file = open(os.path.join(self.folder, "text"), "wb")
        self.size = 0

    def add(self, strings: list[bytes]) -> np.ndarray:
        """Append strings; returns where each starts."""
        starts = self.size + np.concatenate([[0], np.cumsum([len(s) + 1 for s in strings])]).astype(np.int64)
        line = np.frombuffer(b"\0".join([*strings, b""]), np.uint8).astype(np.uint16) + 2
        line[starts[1:] - self.size - 1] = 1
        line.tofile(self.file)
        self.size = int(starts[-1])
        return starts[:-1]

    def close(self) -> None:
        self.file.close()
        self._scratch.cleanup()

    def sorted(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Suffix positions in order with the prefix (at most ``limit``) shared with the one before, by first symbol."""
        np.zeros(1, np.uint16).tofile(self.file)
        self.file.flush()
        self.text = np.memmap(os.path.join(self.folder, "text"), np.uint16, "r")
        self._types()
        stars = np.flatnonzero(self.star)
        order = self._names_sorted(stars, self._stars_of(self._induced(stars, np.zeros(len(stars), np.uint8), False)))
        yield from self._induced(order, self._shared_prefixes(order), True)

    def _types(self) -> None:
        text = self.text
        n = len(text)
        small = np.memmap(os.path.join(self.folder, "types"), bool, "w+", shape=(n,))
        step = 1 << 24
        after = True  # the end mark is of type S
        for end in range(n, 0, -step):
            start = max(0, end - step)
            part = text[start : min(n, end + 1)].astype(np.int32)
            sign = np.sign(np.diff(part)) if end < n else np.append(np.sign(np.diff(part)), 1)
            places = np.where(sign != 0, np.arange(len(sign)), len(sign))
            following = np.minimum.accumulate(places[::-1])[::-1]
            small[start:end] = np.append(sign > 0, after)[following]
            after = bool(small[start])
        self.small = small
        self.star = np.zeros(n, bool)
        self.star[1:] = small[1:] & ~small[:-1]

    def _shared_prefixes(self, positions: np.ndarray) -> np.ndarray:
        """Common prefix of each position with the one before, by comparison."""
        out = np.zeros(len(positions), np.uint8)
        a, b = positions[:-1], positions[1:]
        last = len(self.text) - 1
        alive = np.arange(len(a))
        for k in range(self.limit):
            same = self.text[np.minimum(a[alive] + k, last)] == self.text[np.minimum(b[alive] + k, last)]
            alive = alive[same]
            if not len(alive):
                break
            out[alive + 1] = k + 1
        return out

    def _induced(self, stars: np.ndarray, shared: np.ndarray, final: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All suffixes by first symbol, from the leftmost S suffixes in order of their first symbol.

        Yields from the greatest symbol to the smallest; without ``final`` only positions count.
        """
        text, small = self.text, self.small
        heads = text[stars]
        if not final:
            by = np.argsort(heads, kind="stable")
            stars, heads = stars[by], heads[by]
        bounds = np.searchsorted(heads, np.arange(SYMBOLS + 1))
        queues, done = Queues(self.folder, self.memory), Queues(self.folder, self.memory)
        least = np.full(SYMBOLS, -1, np.int64)  # least prefix since the last push; -1: nothing pushed yet

        def pass_over(positions: np.ndarray, prefixes: np.ndarray, large: bool) -> None:
            """Put the predecessors of one type behind their queues."""
            before = positions - 1
            fits = np.flatnonzero((positions > 0) & (small[np.maximum(before, 0)] != large))
            targets = text[before[fits]]
            by = np.argsort(targets, kind="stable")
            fits, targets = fits[by], targets[by]
            starts = np.flatnonzero(np.concatenate([[True], targets[1:] != targets[:-1]])) if len(targets) else []
            ends = np.append(starts[1:], len(targets)) if len(targets) else []
            if final:
                lowest = int(prefixes.min()) if len(prefixes) else self.limit
                touched = least >= 0
                met = least.copy()
                least[touched] = np.minimum(least[touched], lowest)
            for start, end in zip(starts, ends, strict=True):
                rows, symbol = fits[start:end], int(targets[start])
                values = np.zeros(len(rows), np.uint8)
                if final:
                    cuts = np.concatenate([[0], rows[:-1] + 1])
                    lows = np.minimum.reduceat(prefixes[: rows[-1] + 1], cuts).astype(np.int64)
                    lows[0] = min(lows[0], met[symbol])
                    values = np.minimum(lows + 1, self.limit).astype(np.uint8)
                    rest = prefixes[rows[-1] + 1 :]
                    least[symbol] = int(rest.min()) if len(rest) else self.limit
                queues.push(symbol, before[rows], values)

        def seam(a: int, b: int) -> int:
            return int(self._shared_prefixes(np.array([a, b]))[1])

        tops = np.full(SYMBOLS, -1, np.int64)
        for symbol in range(SYMBOLS):
            for positions, prefixes in queues.drain(symbol):
                done.push(symbol, positions, prefixes)
                tops[symbol] = positions[-1]
                pass_over(positions, prefixes, True)
            part = slice(bounds[symbol], bounds[symbol + 1])
            if bounds[symbol] < bounds[symbol + 1]:
                prefixes = shared[part].copy()
                prefixes[0] = seam(tops[symbol], stars[part][0]) if final and tops[symbol] >= 0 else 0
                pass_over(stars[part], prefixes, True)
        least[:] = -1
        end = np.array([len(text) - 1])
        queues.push(0, end, np.zeros(1, np.uint8))
        for symbol in range(SYMBOLS - 1, -1, -1):
            falling: list[tuple[np.ndarray, np.ndarray]] = []
            for positions, prefixes in queues.drain(symbol):
                falling.append((positions, prefixes))
                pass_over(positions, prefixes, False)
            rising = list(done.drain(symbol))
            up = [np.concatenate([c[i] for c in rising]) if rising else np.empty(0, (np.int64, np.uint8)[i]) for i in (0, 1)]
            down = [np.concatenate([c[i] for c in falling]) if falling else np.empty(0, (np.int64, np.uint8)[i]) for i in (0, 1)]
            # A falling suffix shares its value with the larger one before it; rising order wants it with the smaller one.
            turned = np.concatenate([[0], down[1][::-1][:-1]]).astype(np.uint8) if len(down[0]) else down[1]
            middle = seam(up[0][-1], down[0][-1]) if final and len(up[0]) and len(down[0]) else 0
            if len(turned):
                turned[0] = middle
            if len(up[0]):
                back = np.concatenate([[middle], up[1][::-1][:-1]]).astype(np.uint8)
                pass_over(up[0][::-1], back, False)
            if len(up[0]) or len(down[0]):
                yield np.concatenate([up[0], down[0][::-1]]), np.concatenate([up[1], turned])

    def _stars_of(self, sorted_: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Leftmost S suffixes in the order of their substrings."""
        parts = [positions[self.star[positions]] for positions, _ in sorted_]
        return np.concatenate(parts[::-1]) if parts else np.empty(0, np.int64)

    def _names_sorted(self, stars: np.ndarray, order: np.ndarray) -> np.ndarray:
        """Leftmost S suffixes in order: equal substrings get equal names, names are ranked by doubling up to ``limit`` bytes."""
        if not len(stars):
            return stars
        ends = np.append(stars[1:], len(self.text) - 1)
        place = np.searchsorted(stars, order)
        length = ends[place] - order
        differs = np.append(True, length[1:] != length[:-1])
        alive = np.flatnonzero(~differs)
        k, last = 0, len(self.text) - 1
        while len(alive):
            same = self.text[np.minimum(order[alive] + k, last)] == self.text[np.minimum(order[alive - 1] + k, last)]
            differs[alive[~same]] = True
            k += 1
            alive = alive[same]
            alive = alive[k <= length[alive]]
        names = np.empty(len(stars), np.int64)
        names[place] = np.cumsum(differs)
        step, covered = 1, 2
        while covered < 2 * self.limit and names.max() < len(names):
            following = np.concatenate([names[step:], np.zeros(min(step, len(names)), np.int64)])[: len(names)]
            both = names * (len(names) + 2) + following
            by = np.argsort(both, kind="stable")
            names[by] = np.cumsum(np.append(True, np.diff(both[by]) > 0))
            step, covered = 2 * step, 2 * covered
        return stars[np.argsort(names, kind="stable")]
