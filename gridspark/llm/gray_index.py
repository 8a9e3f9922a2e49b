"""A hierarchical index of bit codes in Gray order, and the search for pairs within a radius.

Codes that agree on a masked bit pattern share a key; Spark groups them by it. The codes of a key are sorted by their
Gray rank, so neighbours share most bits, and cut into leaves of ``FAN`` codes, ``FAN`` leaves into a node, and so on up
to one root. A node holds the bits on which all codes below it agree, as mask and pattern.

A search walks down pairs of nodes. Each step adds the differences on those bits that both nodes have fixed and their
parents had not; once the sum is over the radius the two whole groups are dropped. At the codes themselves all bits are
fixed, so the sum is the distance. Codes that are joined already need no look, so a group of very many close codes costs
little more than its size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

FAN = 16
#: Groups up to this size are compared pair by pair, many groups at once; larger ones have a tree each.
SMALL = 128
#: Pairs that one step of numpy work takes.
STEP = 1 << 18


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray sequence."""
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


def distance(a: np.ndarray, b: np.ndarray, within: np.ndarray | None = None) -> np.ndarray:
    """Differing bits of codes (n, words), on the given bits only if any are."""
    x = a ^ b
    return np.bitwise_count(x if within is None else x & within).sum(-1, dtype=np.int64)


class Unions:
    """Smallest member of each joined set."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Joins pairs; true for those that joined what was apart."""
        made = np.zeros(len(x), bool)
        for lo in range(0, len(x), 20_000):
            some = slice(lo, lo + 20_000)
            rx, ry = self.root[x[some]], self.root[y[some]]
            apart = np.nonzero(rx != ry)[0]
            if not len(apart):
                continue
            up: dict[int, int] = {}

            def top(v: int, up: dict[int, int] = up) -> int:
                while (p := up.get(v, v)) != v:
                    up[v] = up.get(p, p)
                    v = p
                return v

            for k, u, v in zip(apart.tolist(), rx[apart].tolist(), ry[apart].tolist()):
                u, v = top(u), top(v)
                if u != v:
                    up[max(u, v)] = min(u, v)
                    made[lo + k] = True
            low = np.arange(len(self.root))
            low[list(up)] = [top(v) for v in up]
            self.root = low[self.root]
        return made


def small_pairs(group: np.ndarray, codes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs within the radius inside runs of equal ``group``."""
    at, xs, ys = np.arange(len(group)), [], []
    for d in range(1, len(group)):
        at = at[at + d < len(group)]
        at = at[group[at + d] == group[at]]
        if not len(at):
            break
        for lo in range(0, len(at), STEP):
            some = at[lo : lo + STEP]
            some = some[distance(codes[some], codes[some + d]) <= radius]
            xs.append(some)
            ys.append(some + d)
    none = np.zeros(0, np.int64)
    return (np.concatenate(xs), np.concatenate(ys)) if xs else (none, none)


class Tree:
    """The hierarchy over codes (n, words), which it sorts; ``order`` is their order."""

    def __init__(self, codes: np.ndarray):
        self.order = np.lexsort([gray_rank(codes[:, i]) for i in range(codes.shape[1])][::-1])
        codes = codes[self.order]
        self.masks, self.patterns = [np.full_like(codes, ~np.uint64(0))], [codes]
        while len(codes) > 1:
            first = np.arange(0, len(codes), FAN)
            both = np.bitwise_and.reduceat(codes, first) | ~np.bitwise_or.reduceat(codes, first)
            mask = np.bitwise_and.reduceat(self.masks[-1], first) & both
            codes = codes[first] & mask
            self.masks.append(mask)
            self.patterns.append(codes)

    def forest(self, radius: int, unions: Unions | None = None) -> tuple[np.ndarray, np.ndarray, Unions]:
        """Links that join the components of all pairs within the radius (positions in the given codes)."""
        unions = unions or Unions(len(self.order))
        xs, ys = [], []
        for x, y in self.pairs(radius, unions):
            made = unions.join(x, y)
            xs.append(x[made])
            ys.append(y[made])
        none = np.zeros(0, np.int64)
        return (np.concatenate(xs) if xs else none), (np.concatenate(ys) if ys else none), unions

    def pairs(self, radius: int, unions: Unions | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs within the radius; with ``unions``, without those that it has joined by then."""
        top = len(self.masks) - 1
        if not top:
            return
        zero = np.zeros(1, np.int64)
        todo = [(top, zero, zero, zero)]
        while todo:
            level, i, j, sofar = todo.pop()
            if level == 0:
                yield self.order[i], self.order[j]
                continue
            if unions is not None:
                keep = self.apart(level, i, j, unions)
                i, j, sofar = i[keep], j[keep], sofar[keep]
            if len(i) * FAN * FAN > STEP and len(i) > 1:
                half = STEP // (FAN * FAN)
                todo += [(level, i[lo : lo + half], j[lo : lo + half], sofar[lo : lo + half]) for lo in range(0, len(i), half)][::-1]
                continue
            if not len(i):
                continue
            n = len(self.masks[level - 1])
            step = np.arange(FAN)
            a = np.broadcast_to((i * FAN)[:, None, None] + step[:, None], (len(i), FAN, FAN)).ravel()
            b = np.broadcast_to((j * FAN)[:, None, None] + step[None, :], (len(i), FAN, FAN)).ravel()
            parent = np.repeat(np.arange(len(i)), FAN * FAN)
            # A pair of nodes is walked once; below a node and itself, lower codes come first.
            keep = (a < n) & (b < n) & (((i != j)[parent]) | (a < b if level == 1 else a <= b))
            a, b, parent = a[keep], b[keep], parent[keep]
            fixed = self.masks[level][i] & self.masks[level][j]
            new = self.masks[level - 1][a] & self.masks[level - 1][b] & ~fixed[parent]
            differ = sofar[parent] + distance(self.patterns[level - 1][a], self.patterns[level - 1][b], new)
            keep = differ <= radius
            a, b, differ = a[keep], b[keep], differ[keep]
            # Nodes with themselves first: what they join need not be compared again.
            own = a == b
            for part in (~own, own):
                if part.any():
                    todo.append((level - 1, a[part], b[part], differ[part]))

    def apart(self, level: int, i: np.ndarray, j: np.ndarray, unions: Unions) -> np.ndarray:
        """False where all codes below two nodes are joined."""
        root = unions.root[self.order]
        first = np.arange(0, len(root), FAN**level)
        low, high = np.minimum.reduceat(root, first), np.maximum.reduceat(root, first)
        return ~((low[i] == high[i]) & (low[j] == high[j]) & (low[i] == low[j]))


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int, most: int = 1 << 40) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """Columns of sorted batches as arrays, cut between groups of equal first ``keys`` columns, and each row's group. A
    group of more than ``most`` rows comes in several parts, so what is held stays bounded."""
    held: list[list[np.ndarray]] = []

    def cut(columns: list[np.ndarray]) -> np.ndarray:
        change = np.zeros(len(columns[0]), bool)
        for c in columns[:keys]:
            change[1:] |= c[1:] != c[:-1]
        return np.cumsum(change)

    for b in batches:
        if not b.num_rows:
            continue
        columns = [c.to_numpy(zero_copy_only=False) for c in b.columns]
        group = cut(columns)
        last = int(np.searchsorted(group, group[-1]))
        if held and last == 0 and all(held[-1][k][-1] == columns[k][0] for k in range(keys)):
            held.append(columns)
            if sum(len(h[0]) for h in held) > most:
                parts = [np.concatenate([h[k] for h in held]) for k in range(len(columns))]
                yield cut(parts), parts
                held = []
            continue
        if held or last:
            parts = [np.concatenate([*(h[k] for h in held), columns[k][:last]]) for k in range(len(columns))]
            yield cut(parts), parts
        held = [[c[last:] for c in columns]]
    if held:
        parts = [np.concatenate([h[k] for h in held]) for k in range(len(held[0]))]
        yield cut(parts), parts


def sized(group: np.ndarray, largest: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Which rows lie in groups of up to ``largest`` rows, and where the larger groups are."""
    first = np.nonzero(np.concatenate([[True], group[1:] != group[:-1]]))[0]
    size = np.diff(np.append(first, len(group)))
    return np.repeat(size <= largest, size), [(int(a), int(a + n)) for a, n in zip(first[size > largest], size[size > largest])]
