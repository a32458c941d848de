"""The random numbers that Spark's random forest draws, made by numpy a block at a time.

Rows are bagged by Poisson counts of mean 1, each from the doubles of one WELL19937c generator per
part of the rows (commons-math): doubles are multiplied until the product falls below 1/e. The
generator is linear over the two-element field, so its state any number of steps ahead is a
polynomial in the next 19,937 states. Lanes that begin at equal distances of one sequence run side
by side, and each lane's counts are cut out of its own doubles; where a lane's first count begins
is known when the lane before it has ended.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping
from functools import lru_cache

import numpy as np

# Fixed values of the generator: words and bits of its state, and how far back each step reads.
WORDS, BITS, BACK = 624, 19937, (70, 179, 449)
HIGH, LOW = np.uint32(0x80000000), np.uint32(0x7FFFFFFF)
LIMIT = math.exp(-1.0)
# Lanes at most, words of a lane at most, words that are made at once, doubles that a count may need
# beyond a block, and words that are not worth more than one lane.
LANES, LANE, BLOCK, AHEAD, ALONE = 512, 1 << 19, 2048, 64, 1 << 15
# Doubles at the front of a lane, among which its assumed counts meet the true ones.
FRONT = 2000


def seeded(seed: int) -> np.ndarray:
    """State words of the generator for a 64-bit seed."""
    v = [seed >> 32 & 0xFFFFFFFF, seed & 0xFFFFFFFF]
    for i in range(2, WORDS):
        word = v[i - 2] - (1 << 32) if v[i - 2] >> 31 else v[i - 2]
        v.append((1812433253 * (word ^ word >> 30) + i) & 0xFFFFFFFF)
    return np.array(v, dtype=np.uint32)


class Lanes:
    """Generators side by side: ``a`` is the last word of each, ``back`` the 623 words of history
    that its steps read, the latest last."""

    def __init__(self, a: np.ndarray, back: np.ndarray):
        self.a, self.back = a, back

    @classmethod
    def of(cls, seed: int) -> "Lanes":
        v = seeded(seed)
        return cls(v[:1].copy(), v[:0:-1].reshape(-1, 1).copy())

    def run(self, steps: int, history: bool = False):
        """The next words, a row per step; with ``history`` untempered, beside all of the history."""
        reach, lanes = WORDS - 1, len(self.a)
        b = np.empty((reach + steps, lanes), dtype=np.uint32)
        b[:reach] = self.back
        out = np.empty((steps, lanes), dtype=np.uint32)
        a, t1, t2 = self.a, np.empty(lanes, np.uint32), np.empty(lanes, np.uint32)
        for at in range(0, steps, BACK[0]):
            size = min(BACK[0], steps - at)
            old = [b[reach + at - back : reach + at - back + size] for back in (WORDS - 1, WORDS - 2, *BACK)]
            u = old[2] ^ (old[2] >> 27)
            z2 = (old[3] >> 9) ^ old[4] ^ (old[4] >> 1)
            rest = (old[0] & HIGH) ^ (old[1] & LOW) ^ (z2 << 21) ^ (u << 9) ^ ((u ^ z2) >> 21)
            w = np.empty((size, lanes), dtype=np.uint32)
            for i in range(size):
                # The only step that needs the one before.
                row, to = w[i], out[at + i]
                np.left_shift(a, 25, out=t1)
                np.bitwise_xor(a, t1, out=row)
                np.left_shift(row, 9, out=t1)
                np.right_shift(row, 21, out=t2)
                np.bitwise_xor(t1, t2, out=t1)
                np.bitwise_xor(rest[i], t1, out=to)
                a = to
            b[reach + at : reach + at + size] = w ^ u ^ z2
        first = self.a
        self.a, self.back = a.copy(), b[steps:].copy()
        if history:
            return np.vstack([first[None], out]), b
        out ^= (out << 7) & np.uint32(0xE46E1700)
        out ^= (out << 15) & np.uint32(0x9B868000)
        return out

    def ahead(self, jump: int) -> "Lanes":
        """The same lanes further on, by the steps that the bits of a polynomial stand for."""
        a, b = Lanes(self.a, self.back).run(BITS, history=True)
        new_a, new_b = np.zeros_like(self.a), np.zeros_like(self.back)
        for i in range(BITS):
            if jump >> i & 1:
                new_a ^= a[i]
                new_b ^= b[i : i + WORDS - 1]
        return Lanes(new_a, new_b)


@lru_cache(maxsize=1)
def characteristic() -> int:
    """The generator's characteristic polynomial as bits, found from its output (Berlekamp, Massey)."""
    words = Lanes.of(1).run(2 * BITS + 64)[:, 0]
    bits = (words >> 31).tolist()
    c, before, length, since, seen = 1, 1, 0, 1, 0
    for n, bit in enumerate(bits):
        seen = seen << 1 | bit
        # ``seen`` has the latest bit lowest, as ``c`` has the coefficient of the latest.
        if (c & seen).bit_count() & 1:
            kept = c
            c ^= before << since
            if 2 * length <= n:
                length, before, since = n + 1 - length, kept, 0
        since += 1
    if length != BITS:
        raise AssertionError("the generator is not the expected one")
    return int(f"{c:0{BITS + 1}b}"[::-1], 2)


def _reduced(value: int) -> int:
    modulus = characteristic()
    for shift in range(value.bit_length() - 1 - BITS, -1, -1):
        if value >> (shift + BITS) & 1:
            value ^= modulus << shift
    return value


@lru_cache(maxsize=64)
def jump_of(steps: int) -> int:
    """x^steps modulo the characteristic polynomial."""
    if steps < BITS:
        return 1 << steps
    half = jump_of(steps // 2)
    squared = int("0".join(f"{half:b}"), 2)
    return _reduced(squared << (steps % 2))


def _lanes_for(words: int) -> tuple[int, int]:
    """Lanes, and words of each, for a number of words; what more lanes save is weighed against what
    it takes to begin them (seconds, as measured)."""
    if words <= ALONE:
        return 1, -(-words // 2) * 2
    choices = []
    for size in (1 << i for i in range(13, LANE.bit_length())):
        lanes = min(LANES, -(-words // size))
        rounds = -(-words // (size * lanes))
        choices.append((rounds * (0.16 * lanes.bit_length() + 1.5e-3 * lanes + size * (5e-6 + 1.5e-8 * lanes)), lanes, size))
    return min(choices)[1:]


@lru_cache(maxsize=1)
def jumps() -> dict[int, int]:
    """The polynomials that lanes take to begin; made once, for all tasks."""
    return {1 << i: jump_of(1 << i) for i in range(13, LANE.bit_length() + LANES.bit_length())}


def _counts_from(u: np.ndarray) -> np.ndarray:
    """For each double but the last ``AHEAD``, the count that begins with it."""
    size = u.shape[1] - AHEAD
    product = u[:, :size].copy()
    n = np.zeros(product.shape, dtype=np.uint8)
    for j in range(1, AHEAD + 1):
        more = product >= LIMIT
        if not more.any():
            return n
        n += more
        product *= u[:, j : j + size]
    raise AssertionError("a count beyond all bounds")


def _walk(n: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marks where counts begin from the given places on, and where the next one begins beyond the end."""
    lanes, size = n.shape
    wide = np.zeros((lanes, size + AHEAD), dtype=np.int64)
    wide[:, :size] = n
    wide[:, :size] += 1
    flat, marks = wide.ravel(), np.zeros(lanes * (size + AHEAD), dtype=bool)
    base = np.arange(lanes) * (size + AHEAD)
    place = base + at
    while True:
        for _ in range(16):
            marks[place] = True
            place += flat[place]
        if (place - base >= size).all():
            break
    return marks.reshape(lanes, -1)[:, :size], place - base - size


def _side_by_side(first: Lanes, lanes: int, size: int, known: Mapping[int, int]) -> Lanes:
    """The lane, and those that begin ``size``, twice ``size``, ... words later."""
    while len(first.a) < lanes:
        steps = size * len(first.a)
        more = lanes - len(first.a)
        part = Lanes(first.a[:more], first.back[:, :more]).ahead(known.get(steps) or jump_of(steps))
        first = Lanes(np.concatenate([first.a, part.a]), np.hstack([first.back, part.back]))
    return first


def _joined(counts: np.ndarray, front: np.ndarray, marks: np.ndarray, entry: int) -> np.ndarray:
    """A lane's counts when its first one begins at ``entry`` instead of at its first double: they are
    the same from the first place on at which both begin one."""
    true, at = [], entry
    while at < len(marks) and not marks[at]:
        true.append(front[at])
        at += int(front[at]) + 1
    if at >= len(marks):
        raise AssertionError("the counts of a lane do not meet")
    return np.concatenate([np.array(true, dtype=np.uint8), counts[int(marks[:at].sum()) :]])


def poisson_counts(seed: int, samples: int, known: Mapping[int, int] | None = None) -> Iterator[np.ndarray]:
    """``samples`` counts of mean 1 in arrays of bytes. ``known`` are the polynomials of ``jumps``."""
    ahead, entry, left = Lanes.of(seed), 0, samples
    while left:
        # Four words a count, and some more for chance.
        lanes, size = _lanes_for(4 * left + 24 * math.isqrt(left) + 200)
        side = _side_by_side(ahead, lanes, size, known or {})
        pieces: list[list[np.ndarray]] = [[] for _ in range(lanes)]
        fronts: list[tuple[np.ndarray, np.ndarray]] = []
        at, held = np.zeros(lanes, dtype=np.int64), np.empty((lanes, 0))
        blocks = [min(BLOCK, size - begin) for begin in range(0, size, BLOCK)]
        for i, step in enumerate((*blocks, 2 * AHEAD)):
            if i == len(blocks):
                # Here the next lanes begin; what is made from here on is only looked at.
                last = Lanes(side.a[-1:].copy(), side.back[:, -1:].copy())
            words = np.ascontiguousarray(side.run(step).T) >> np.uint32(6)
            u = (words[:, 0::2].astype(np.int64) << 26 | words[:, 1::2]) * 2.0**-52
            u = np.hstack([held, u])
            held = u[:, -AHEAD:]
            if u.shape[1] <= AHEAD:
                continue
            n = _counts_from(u)
            marks, at = _walk(n, at)
            ends = np.cumsum(marks.sum(axis=1))[:-1]
            for kept, piece in zip(pieces, np.split(n[marks], ends)):
                kept.append(piece)
            if sum(f.shape[1] for f, _ in fronts) < FRONT:
                fronts.append((n, marks))
        front, marked = (np.hstack(x) for x in zip(*fronts))
        for lane in range(lanes):
            counts = np.concatenate(pieces[lane])
            if entry:
                counts = _joined(counts, front[lane], marked[lane], entry)
            yield counts[:left]
            left -= min(left, len(counts))
            if not left:
                return
            entry = int(at[lane])
        ahead = last
