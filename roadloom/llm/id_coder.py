"""Token ids in compressed blocks: an adaptive context-mixing range coder.

A block holds whole documents and is coded on its own: its model starts from the same state, and its header has the
crc32 of its ids, which the reader checks. In a block, runs of equal length ("lanes") are coded side by side, so that one
numpy step codes the next id of every lane; all lanes share one adaptive model and learn from each other.

For each id the order-2 context (two ids before) and the order-1 context (one id before) predict one id each, with a
confidence of 0 to 3. Adaptive weights per pair of confidences mix three outcomes: the order-2 prediction, the order-1
prediction, or an id drawn from the adaptive order-0 frequencies. The outcome and, for the third, the id drive a 64-bit
range coder without carries that puts out 16-bit words, per lane.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"RLB1"
#: Ids after which a block is closed at the next end of a document; lanes and the least ids of a lane.
BLOCK_IDS, LANES, LANE_IDS = 1 << 20, 8192, 64

_U = np.uint64
_TOP, _LOW_RANGE = _U(1 << 48), _U(1 << 40)
_SHIFT, _WORD = _U(16), _U(48)
_HASH_BITS, _FLAG_BITS, _ID_BITS, _FIND_BITS = 18, 12, 25, 13
_MAY_SETTLE = _U(1 << 48)
#: Steps between new order-0 shares and between new outcome weights, after the first few, when each step counts.
_SUM_STEPS, _WEIGH_STEPS = 16, 4


class _Model:
    """What coder and decoder both hold and update alike after every step.

    A prediction is one number: the id, and in the two lowest bits its confidence. A hit adds to the confidence, a miss
    takes from it, and a miss at 0 puts the new id in its place.
    """

    def __init__(self, n_ids: int):
        self.count = 1 + 2048 // (16 + np.arange(n_ids, dtype=np.int64))  # early ids of a vocabulary are frequent ones
        self.seen: list[np.ndarray] = []
        self.order1, self.order2 = np.zeros(n_ids, np.int32), np.zeros(1 << _HASH_BITS, np.int32)
        self.flag = np.tile(np.array([2, 1, 1], np.int64), (32, 1))
        self.step = 0
        self._sum()
        self._weigh()

    def _sum(self) -> None:
        """Order-0 frequencies as shares of 2**_ID_BITS; every id keeps a share."""
        if self.seen:
            self.count += np.bincount(np.concatenate(self.seen), minlength=len(self.count)) * 16
            self.seen.clear()
        cum = np.cumsum(self.count)
        self.cum = np.zeros(len(cum) + 1, np.int64)
        self.cum[1:] = (cum << _ID_BITS) // cum[-1]
        self.found: np.ndarray | None = None

    def _weigh(self) -> None:
        """The outcomes' weights in each context as shares of 2**_FLAG_BITS, at least one each."""
        total = self.flag.sum(axis=1)
        if total.max() > 1 << 20:
            self.flag = (self.flag >> 1) + 1
            total = self.flag.sum(axis=1)
        table = np.zeros((32, 4), np.int64)
        np.cumsum(self.flag, axis=1, out=table[:, 1:])
        table = table * ((1 << _FLAG_BITS) - 3) // total[:, None] + np.arange(4)
        self.flag_cum = table.astype(np.uint64).ravel()

    def predict(self, one: np.ndarray, two: np.ndarray) -> None:
        """one, two: the ids one and two places before (int32)."""
        self.at1 = one
        self.at2 = (one.view(np.uint32) * np.uint32(0x9E3779B1) ^ two.view(np.uint32) * np.uint32(0x85EBCA77)) >> np.uint32(32 - _HASH_BITS)
        self.v1, self.v2 = self.order1.take(one), self.order2.take(self.at2)
        self.c1, self.c2 = self.v1 & 3, self.v2 & 3
        self.p1, self.p2 = self.v1 >> 2, self.v2 >> 2
        self.context = (self.c2 << 3) + (self.c1 << 1) + (self.p1 == self.p2)

    def learn(self, ids: np.ndarray, outcome: np.ndarray) -> None:
        fresh = ids << 2
        for v, c, p, at, table in ((self.v1, self.c1, self.p1, self.at1, self.order1), (self.v2, self.c2, self.p2, self.at2, self.order2)):
            table[at] = np.where(p == ids, v + (c < 3), np.where(c == 0, fresh, v - 1))
        self.flag += np.bincount(self.context * 3 + outcome, minlength=96).reshape(32, 3) * 8
        self.seen.append(ids)
        self.step += 1
        early = self.step & (self.step - 1) == 0
        if early or self.step % _WEIGH_STEPS == 0:
            self._weigh()
        if early or self.step % _SUM_STEPS == 0:
            self._sum()

    def find(self, target: np.ndarray) -> np.ndarray:
        """The id in whose share each target lies: a table of first ids by the target's high bits, then a search where shares are small."""
        if self.found is None:
            self.found = np.searchsorted(self.cum, np.arange(1 << _FIND_BITS) << (_ID_BITS - _FIND_BITS), "right") - 1
        y = self.found.take(target >> (_ID_BITS - _FIND_BITS))
        rest = np.flatnonzero(self.cum.take(y + 1) <= target)
        if len(rest):
            y[rest] = np.searchsorted(self.cum, target[rest], "right") - 1
        return y


def _shape(n: int) -> tuple[int, int]:
    lanes = max(1, min(LANES, -(-n // LANE_IDS)))
    steps = -(-n // lanes) if n else 0
    return (-(-n // steps) if steps else 0), steps


def encode(ids: np.ndarray) -> bytes:
    """One block's bytes. Ids are whole numbers from 0 below 2**20; an empty array gives an empty block."""
    ids = np.ascontiguousarray(ids, dtype=np.int64)
    n = len(ids)
    lanes, steps = _shape(n)
    n_ids = int(ids.max()) + 1 if n else 0
    if n_ids > 1 << 20:
        raise ValueError("ids go up to 2**20 - 1")
    head = MAGIC + struct.pack("<QIIII", n, lanes, steps, n_ids, zlib.crc32(ids.astype("<u4").tobytes()))
    if not n:
        return head
    grid = np.zeros(lanes * steps, np.int32)
    grid[:n] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, steps).T)
    model = _Model(n_ids)
    low, width = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 64) - 1, np.uint64)
    one, two = np.zeros(lanes, np.int32), np.zeros(lanes, np.int32)
    put_lane, put_word = [], []
    for t in range(steps):
        k = lanes if t < n - (lanes - 1) * steps else lanes - 1  # only the last lane may be short
        x = grid[t, :k]
        model.predict(one[:k], two[:k])
        outcome = np.where(model.p2 == x, 0, np.where(model.p1 == x, 1, 2))
        at = (model.context << 2) + outcome
        lo, wi = low[:k], width[:k]
        r = wi >> _U(_FLAG_BITS)
        begin = model.flag_cum.take(at)
        lo += r * begin
        np.multiply(r, model.flag_cum.take(at + 1) - begin, out=wi)
        free = np.flatnonzero(outcome == 2)
        y = x[free]
        begin = model.cum.take(y)
        r = wi[free] >> _U(_ID_BITS)
        lo[free] += r * begin.view(np.uint64)
        wi[free] = r * (model.cum.take(y + 1) - begin).view(np.uint64)
        lane = np.flatnonzero(wi < _MAY_SETTLE)
        while len(lane):
            l, w = lo[lane], wi[lane]
            settled = (l ^ (l + w)) < _TOP
            go = settled | (w < _LOW_RANGE)
            if not go.all():
                lane, l, w, settled = lane[go], l[go], w[go], settled[go]
                if not len(lane):
                    break
            if not settled.all():
                w = np.where(settled, w, (_U(0) - l) & (_LOW_RANGE - _U(1)))
            put_lane.append(lane.astype(np.uint16))
            put_word.append((l >> _WORD).astype("<u2"))
            l, w = l << _SHIFT, w << _SHIFT
            lo[lane], wi[lane] = l, w
            lane = lane[w < _MAY_SETTLE]
        model.learn(x, outcome)
        two, one = one, grid[t]
    final = (low + (_LOW_RANGE - _U(1))) >> _U(40)
    for shift in (_U(8), _U(0)):
        put_lane.append(np.arange(lanes, dtype=np.uint16))
        put_word.append(((final >> shift) & _U(0xFFFF)).astype("<u2") if shift else ((final & _U(0xFF)) << _U(8)).astype("<u2"))
    lane, word = np.concatenate(put_lane), np.concatenate(put_word)
    sizes = np.bincount(lane, minlength=lanes).astype("<u4")
    return head + sizes.tobytes() + word[np.argsort(lane, kind="stable")].tobytes()


def decode(block: bytes) -> np.ndarray:
    """The ids of a block; ValueError if it isn't whole."""
    if block[:4] != MAGIC:
        raise ValueError("not a block of ids")
    n, lanes, steps, n_ids, checksum = struct.unpack_from("<QIIII", block, 4)
    if not n:
        return np.zeros(0, np.int64)
    sizes = np.frombuffer(block, "<u4", lanes, 28).astype(np.int64)
    words = np.concatenate([np.frombuffer(block, "<u2", offset=28 + 4 * lanes), np.zeros(8, "<u2")]).astype(np.uint64)
    if sizes.sum() + 8 != len(words):
        raise ValueError("a block of ids is cut short")
    ends = np.cumsum(sizes)
    at = ends - sizes
    value = np.zeros(lanes, np.uint64)
    low, width = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 64) - 1, np.uint64)

    def pull(lane: np.ndarray) -> np.ndarray:
        place = at[lane]
        word = np.where(place < ends[lane], words[np.minimum(place, len(words) - 1)], _U(0))
        at[lane] = place + 1
        return word

    every = np.arange(lanes)
    for _ in range(4):
        value = value << _SHIFT | pull(every)
    grid = np.zeros((steps, lanes), np.int32)
    model = _Model(n_ids)
    one, two = np.zeros(lanes, np.int32), np.zeros(lanes, np.int32)
    for t in range(steps):
        k = lanes if t < n - (lanes - 1) * steps else lanes - 1
        model.predict(one[:k], two[:k])
        lo, wi, va = low[:k], width[:k], value[:k]
        row = model.context << 2
        r = wi >> _U(_FLAG_BITS)
        ahead = va - lo
        first, second = r * model.flag_cum.take(row + 1), r * model.flag_cum.take(row + 2)
        past1, past2 = ahead >= first, ahead >= second
        outcome = past1.astype(np.int32) + past2
        begin = np.where(past2, second, np.where(past1, first, 0))  # the first outcome begins at 0
        np.subtract(np.where(past2, r * model.flag_cum.take(row + 3), np.where(past1, second, first)), begin, out=wi)
        lo += begin
        x = np.where(past1, model.p1, model.p2)
        free = np.flatnonzero(past2)
        r = wi[free] >> _U(_ID_BITS)
        target = np.minimum((va[free] - lo[free]) // r, _U((1 << _ID_BITS) - 1)).view(np.int64)
        y = model.find(target)
        begin = model.cum.take(y)
        lo[free] += r * begin.view(np.uint64)
        wi[free] = r * (model.cum.take(y + 1) - begin).view(np.uint64)
        x[free] = y
        lane = np.flatnonzero(wi < _MAY_SETTLE)
        while len(lane):
            l, w = lo[lane], wi[lane]
            settled = (l ^ (l + w)) < _TOP
            go = settled | (w < _LOW_RANGE)
            if not go.all():
                lane, l, w, settled = lane[go], l[go], w[go], settled[go]
                if not len(lane):
                    break
            if not settled.all():
                w = np.where(settled, w, (_U(0) - l) & (_LOW_RANGE - _U(1)))
            l, w = l << _SHIFT, w << _SHIFT
            lo[lane], wi[lane] = l, w
            va[lane] = va[lane] << _SHIFT | pull(lane)
            lane = lane[w < _MAY_SETTLE]
        model.learn(x, outcome)
        grid[t, :k] = x
        two, one = one, grid[t]
    ids = np.ascontiguousarray(grid.T).ravel()[:n].astype(np.int64)
    if zlib.crc32(ids.astype("<u4").tobytes()) != checksum:
        raise ValueError("a block of ids has a wrong checksum")
    return ids
