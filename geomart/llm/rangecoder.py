"""Adaptive context-mixing range coder for token ids, many blocks side by side.

Every block is coded on its own from a fresh state, so thousands of blocks advance together, one
id per step, as the lanes of arrays. For each id, order-2 and order-1 contexts name the id they saw
last and how surely; a small mixer, trained as it goes, turns their confidence and
the order-0 frequency of the named id into one probability for "it is that id". If it isn't, the
id is coded by adaptive order-0 frequencies of its magnitude, and its remaining bits, all equally
likely, are written as they are, from the end of the block backwards. The chances of all magnitudes sum to a power of
two, so an id narrows the range once, without a division (decoding takes one), in arrays over all lanes. All
numbers are integers, so coding and decoding agree on any machine.
"""

from __future__ import annotations

import math

import numpy as np

SLOTS = 1024  # contexts a block remembers, of each order
MAGNITUDES = 17
MAX_ID = (1 << MAGNITUDES) - 2
LIMIT = 1 << 18
ONE = np.uint64(1)
WORD = np.uint64(32)
MASK = np.uint64(0xFFFFFFFF)
P_BITS = np.uint64(12)
SUM_BITS = 14  # the chances of all magnitudes, as a power of 2; with P_BITS below 32
LEAST = 24  # what every magnitude keeps of it

#: ln(p / (1 - p)) in 1/256 for p in 1/4096, and back.
STRETCH = np.array([round(256 * math.log(max(p, 0.5) / (4096 - max(p, 0.5)))) for p in range(4096)], np.int32)
SQUASH = np.array([min(4095, max(1, round(4096 / (1 + math.exp(-x / 256))))) for x in range(-2047, 2048)], np.int32)


def magnitude(ids: np.ndarray) -> np.ndarray:
    """Number of binary digits of id + 1, less one: the exponent of the number, which a float32 holds exactly."""
    return ((ids + np.int32(1)).astype(np.float32).view(np.int32) >> 23) - np.int32(127)


def taken(table: np.ndarray, at: np.ndarray) -> np.ndarray:
    return table.take(at, mode="clip")  # faster than an index; none is out of bounds but of a damaged file


class Encoder:
    """Range coder with 64-bit ranges that writes 32-bit words, one per lane."""

    def __init__(self, ids: np.ndarray):
        steps, lanes = ids.shape
        self.ids, self.step = ids, 0
        self.lane = np.arange(lanes)
        self.size, self.rest = np.empty(ids.shape, np.int8), np.empty(ids.shape, np.uint16)
        for t in range(0, steps, 64):
            some = ids[t : t + 64]
            size = magnitude(some)
            self.size[t : t + 64], self.rest[t : t + 64] = size, some + np.int32(1) - (np.int32(1) << size)
        self.low = np.zeros(lanes, np.uint64)
        self.range = np.full(lanes, np.iinfo(np.uint64).max, np.uint64)
        self.out: list[tuple[np.ndarray, np.ndarray]] = []
        self.raw_out: list[tuple[np.ndarray, np.ndarray]] = []
        self.raw = np.zeros(lanes, np.uint64)  # bits that don't fill a word yet, and how many
        self.n_raw = np.zeros(lanes, np.int32)

    def code(self, p: np.ndarray, named: np.ndarray, size: np.ndarray, cdf: np.ndarray) -> tuple[np.ndarray, ...]:
        """Code the next id of each lane: whether it is the named one, with chance p / 4096, else its magnitude and the rest.
        ``cdf`` holds the sums of the chances of smaller magnitudes. Gives the id, whether it is named, and its magnitude."""
        now = self.ids[self.step]
        hit = now == named
        size = self.size[self.step]
        at = size * np.int32(len(self.low)) + self.lane
        below = taken(cdf, at).astype(np.uint64)
        chance = taken(cdf[len(self.low) :], at).astype(np.uint64) - below
        cut = (self.range >> P_BITS) * p.astype(np.uint64)  # "named" takes the lower part
        unit = (self.range - cut) >> np.uint64(SUM_BITS)
        self.low = np.where(hit, self.low, self.low + cut + unit * below)
        self.range = np.where(hit, cut, unit * chance)
        self.settle()
        missed = ~hit
        self.raw |= (self.rest[self.step] * missed).astype(np.uint64) << self.n_raw.astype(np.uint64)
        self.n_raw += size * missed
        full = np.flatnonzero(self.n_raw >= 32)
        if len(full):
            self.keep(full)
        self.step += 1
        return now, hit, size

    def settle(self) -> None:
        """Write the upper word of each lane once 32 bits are settled."""
        small = np.flatnonzero(self.range <= MASK)
        if len(small):
            low, width = self.low[small], self.range[small]
            apart = ((low ^ (low + width - ONE)) >> WORD) != 0  # the upper word isn't settled: give up a part of the range
            width = np.where(apart, (~low + ONE) & MASK, width)
            self.out.append((small, (low >> WORD).astype("<u4")))
            self.low[small], self.range[small] = low << WORD, width << WORD

    def keep(self, lanes: np.ndarray) -> None:
        """Take a word of raw bits from these lanes."""
        bits = self.raw[lanes]
        self.raw_out.append((lanes, (bits & MASK).astype("<u4")))
        self.raw[lanes] = bits >> WORD
        self.n_raw[lanes] -= 32

    def finish(self) -> list[bytes]:
        lanes = len(self.low)
        self.out += [(self.lane, (self.low >> WORD).astype("<u4")), (self.lane, (self.low & MASK).astype("<u4"))]
        self.keep(np.flatnonzero(self.n_raw > 0))
        at, words = (np.concatenate(x) for x in zip(*self.out, *self.raw_out[::-1]))
        order = np.argsort(at.astype(np.min_scalar_type(lanes)), kind="stable")  # the fewer bytes, the sooner sorted
        cuts = np.searchsorted(at[order], np.arange(lanes + 1)) * 4
        raw = words[order].tobytes()
        return [raw[a:b] for a, b in zip(cuts.tolist(), cuts[1:].tolist())]


class Decoder:
    def __init__(self, payloads: list[bytes]):
        size = np.array([len(p) // 4 for p in payloads])
        self.words = np.concatenate((np.frombuffer(b"".join(payloads), "<u4").astype(np.uint64), np.zeros(2, np.uint64)))
        # what stands at a place and before it: raw bits go backwards
        self.pairs = self.words.copy()
        self.pairs[1:] |= self.words[:-1] << WORD
        self.end = np.cumsum(size) - 1
        self.used = np.zeros(len(size), np.int64)  # raw bits
        self.next = np.cumsum(size) - size
        self.low = np.zeros(len(size), np.uint64)
        self.range = np.full(len(size), np.iinfo(np.uint64).max, np.uint64)
        self.now = taken(self.words, self.next) << WORD | taken(self.words, self.next + 1)
        self.next += 2

    def code(self, p: np.ndarray, named: np.ndarray, size: np.ndarray, cdf: np.ndarray) -> tuple[np.ndarray, ...]:
        """As the encoder's; ``size`` is the magnitude of the named id."""
        lanes = len(self.low)
        over = self.now - self.low
        cut = (self.range >> P_BITS) * p.astype(np.uint64)
        hit = over < cut
        unit = (self.range - cut) >> np.uint64(SUM_BITS)
        value = np.minimum((over - cut) // unit, np.uint64((1 << SUM_BITS) - 1)).astype(np.int16)
        coded = np.add.reduce((cdf.reshape(-1, lanes)[1:MAGNITUDES] <= value).view(np.uint8), axis=0, dtype=np.uint8).astype(np.int32)
        at = coded * np.int32(lanes) + np.arange(lanes)
        below = taken(cdf, at).astype(np.uint64)
        chance = taken(cdf[lanes:], at).astype(np.uint64) - below
        self.low = np.where(hit, self.low, self.low + cut + unit * below)
        self.range = np.where(hit, cut, unit * chance)
        self.settle()
        n = coded * ~hit
        mask = (np.int32(1) << n) - np.int32(1)
        raw = (taken(self.pairs, self.end - (self.used >> 5)) >> (self.used & 31).astype(np.uint64)).astype(np.uint32).view(np.int32) & mask
        self.used += n
        return np.where(hit, named, mask + raw), hit, np.where(hit, size, coded)

    def settle(self) -> None:
        small = np.flatnonzero(self.range <= MASK)
        if len(small):
            low, width = self.low[small], self.range[small]
            apart = ((low ^ (low + width - ONE)) >> WORD) != 0
            width = np.where(apart, (~low + ONE) & MASK, width)
            self.now[small] = self.now[small] << WORD | taken(self.words, self.next[small])
            self.next[small] += 1
            self.low[small], self.range[small] = low << WORD, width << WORD


class Model:
    """State of every lane; all zero at the start of a block. Arrays of two rows are of order 1 and order 2."""

    def __init__(self, lanes: int):
        # what each context saw last, times 16, and how sure it is of that (0 to 15)
        self.seen = np.zeros(2 * lanes * SLOTS, np.int32)
        self.hit = np.full(2 * lanes * 16, 1024, np.int32)  # chance of a hit by how sure a context is
        self.weight = np.full((3, lanes), 1 << 15, np.int32)
        row = np.arange(MAGNITUDES + 1)[:, None]
        self.cdf = np.repeat((row << SUM_BITS) // MAGNITUDES, lanes, 1).astype(np.int16)
        self.rows = row[1:MAGNITUDES].astype(np.int16)
        self.least = (row[1:MAGNITUDES] * LEAST).astype(np.int16)
        self.steps = 0
        self.one = np.zeros(lanes, np.int32)  # the last id + 1, then the one before
        self.two = np.zeros(lanes, np.int32)
        self.lane = np.arange(lanes)
        self.slots = np.arange(2 * lanes).reshape(2, lanes) * SLOTS
        self.states = np.arange(2 * lanes).reshape(2, lanes) * 16

    def learn(self, size: np.ndarray) -> None:
        """Move the sums of chances towards the magnitude that came, slower with every step."""
        goal = size.astype(np.int16) - self.rows
        goal >>= 15  # all bits set in the rows above the magnitude
        goal &= (1 << SUM_BITS) - MAGNITUDES * LEAST
        goal += self.least
        inner = self.cdf[1:MAGNITUDES]
        goal -= inner
        goal >>= RATES[min(self.steps, len(RATES) - 1)]
        inner += goal
        self.steps += 1

    def step(self, coder: Encoder | Decoder) -> np.ndarray:
        """Code or decode the next id of each lane."""
        lanes = len(self.lane)
        mixed = self.one * np.int32(40503)
        slot = np.empty((2, lanes), np.int32)
        slot[0] = mixed
        np.bitwise_xor(self.two * np.int32(30011), mixed, out=slot[1])
        slot >>= 5
        slot &= SLOTS - 1
        slot = slot + self.slots
        seen = taken(self.seen, slot)
        sure = seen & 15
        named = np.where(sure[1] > 0, seen[1], seen[0]) >> 4
        state = sure.copy()
        state[0] *= seen[0] >> 4 == named
        state = state + self.states
        size = magnitude(named)
        at = size * np.int32(lanes) + self.lane
        cdf = self.cdf.reshape(-1)
        chance = (taken(cdf[lanes:], at) - taken(cdf, at)) >> (size + (SUM_BITS - 12))
        p = np.empty((3, lanes), np.int32)
        np.take(self.hit, state, mode="clip", out=p[:2])
        p[2] = chance
        np.minimum(p[2], 4095, out=p[2])
        had = p[:2]
        inputs = taken(STRETCH, p)
        total = np.add.reduce(self.weight * inputs, axis=0, dtype=np.int32)
        total >>= 16
        np.minimum(np.maximum(total, -2047, out=total), 2047, out=total)
        total += 2047
        chance = taken(SQUASH, total)
        now, hit, size = coder.code(chance, named, size, cdf)
        inputs *= (hit.astype(np.int32) << 12) - chance
        inputs >>= 10
        self.weight += inputs
        np.minimum(np.maximum(self.weight, -LIMIT, out=self.weight), LIMIT, out=self.weight)  # keeps the sum within 32 bits
        self.hit[state] = had + ((np.where(hit, np.int32(4095), np.int32(1)) - had) >> 4)
        self.learn(size)
        key = now << 4
        surer = np.minimum(seen + 1, seen | 15)
        other = np.where(sure > 1, seen - ((sure + 1) >> 1), key | 1)
        self.seen[slot] = np.where((seen ^ key) < 16, surer, other)
        self.two, self.one = self.one, now + np.int32(1)
        return now


#: How far the order-0 chances move, as a power of 1/2, at each step of a block.
RATES = [min(6, (t + 3).bit_length()) for t in range(128)]


def encode_blocks(ids: np.ndarray, block: int) -> list[bytes]:
    """Payload of each block of ``block`` ids; the last one may be shorter (beside others it is filled up with 0)."""
    lanes = -(-len(ids) // block)
    if not lanes:
        return []
    if ids.max() > MAX_ID:
        raise ValueError(f"id {ids.max()}: the coder takes ids up to {MAX_ID}")
    steps = min(block, len(ids))
    grid = np.zeros(lanes * steps, np.int32)
    grid[: len(ids)] = ids
    coder, model = Encoder(np.ascontiguousarray(grid.reshape(lanes, steps).T)), Model(lanes)
    for _ in range(steps):
        model.step(coder)
    return coder.finish()


def decode_blocks(payloads: list[bytes], n_ids: list[int]) -> np.ndarray:
    """Ids of blocks of equal length (but for the last one), one after the other."""
    lanes = len(payloads)
    if not lanes:
        return np.zeros(0, np.int64)
    block, last = n_ids[0], n_ids[-1]
    grid = np.zeros((block, lanes), np.int32)
    coder, model = Decoder(payloads), Model(lanes)
    for t in range(block):
        grid[t] = model.step(coder)
    flat = grid.T.reshape(-1)
    return flat[: (lanes - 1) * block + last]
