"""Exact Jaccard self-join on word shingles by universe-partition pigeonhole.

Two sets R, S (|R| <= |S|) with Jaccard at least t differ in at most H = |R| (1 - t) / t
elements. Hash the universe into n > H segments: in every segment in which they differ they
spend at least one of the H differences. So a set may give each of its segments an allowance,
none (skipped, counts 0), exact (counts 1) or one deletion (counts 2), and no partner is missed
while the counts sum to more than H.

* Sets fall into size bands of ratio t. A set indexes the segment subsets of its own band (a
  pair's smaller side) and of the bands below that may hold a smaller partner (the larger side).
* n is at least a fifth above H + 1 and large enough that a set fills H or fewer segments with
  a probability below e^-40, so that empty segments can be skipped.
* Groups of equal subsets are first linked in stars (each set with the smallest of the group
  that it shares most subsets with), and joined into components.
* Only pairs of different components matter after that. Of such a pair the set of the smaller
  component asks. What a group costs it is the number of members of larger components there.
  Cost-based allocation: a set skips its costliest subsets, as many as H allows, and asks the
  rest if they cost at most HOT. If some cost more (a passage that very many texts share), it
  allows one deletion in as many of its cheap segments instead; partners are then among the
  members of its costly groups, and only these index their deletions.
* A set with too few cheap segments, or whose deletions meet a crowd too, asks in the finest
  partition, a segment for each element, among the same members: it must share t of its elements
  with a partner, so all but that many may be costly. One that consists of costly elements to
  more than t is compared with the members of their groups in blocks, element by element.
Nothing is capped or dropped. Candidates are pruned by size and by the bits in which two parity
bitmaps differ (no more than the sets do), and verified on the sets themselves. Sets and
classes of equal sets are held as 64-bit hashes.
"""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytes_np import mix, shingle_sets, slices
from .components import labelled
from .packed import SCHEMA, Dealer, dealt, edges, exchange, received, rows, run_ends, whole_groups
from .work import BROADCAST_KEYS, drop, pick, sized, store

#: A subset is costly to a set that would be compared with more than this many others through it.
HOT = 24
#: Bytes of text handled at once.
BLOCK = 1 << 18
#: Elements of a block of sets that are compared with all members of their groups.
ASKED = 1 << 21
#: Elements of sets for each bucket of a packed exchange.
DEALT = 1 << 19
U64, I64, I32, I8 = np.dtype(np.uint64), np.dtype(np.int64), np.dtype(np.int32), np.dtype(np.int8)
SALT = np.uint64(0xA5A5A5A5)
# kinds of packed rows: a subset's member (by subset), the allowance of a set (by set), its component (by set),
# a member with its component (by subset), the same with its cost, a subset that is asked, one that is too costly
# to ask, one that a deletion leads to or from, a set's name
MEMBER, NEED, INFO, TAGGED, PRICED, ASK, COSTLY, NEIGHBOUR, NAMED = range(9)
LAYOUT = {
    MEMBER: (U64, I64, I8), NEED: (I64, I8, I32), INFO: (I64, I32, I64, I32), TAGGED: (U64, I64, I8, I32, I64, I32, I32),
    PRICED: (U64, I64, I8, I32, I64, I32, I32, I32), ASK: (U64, I64), COSTLY: (U64,), NEIGHBOUR: (U64, I64, I8, I32, I64, I32), NAMED: (I64,),
}


class Bands:
    """Size bands and numbers of segments for a threshold num / den."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.tops = [1]
        while self.tops[-1] < 1 << 40:
            self.tops.append(max(self.tops[-1] + 1, self.tops[-1] * den // num))
        self.edges = np.array(self.tops, np.int64)
        self.counts: dict[int, int] = {}

    def of(self, size):
        return np.searchsorted(self.edges, size)

    def most(self, size):
        """Differences that the smaller set of a pair, of this size, allows."""
        return size * (self.den - self.num) // self.num

    def lowest(self, size):
        """The lowest band that may hold a smaller partner."""
        return self.of(np.maximum(1, -(-size * self.num // self.den)))

    def segments(self, band: int) -> int:
        if band not in self.counts:
            n = (self.most(self.tops[band]) + 1) * 6 // 5 + 1
            while not self.fills(band, n):
                n += n // 50 + 1
            self.counts[band] = n
        return self.counts[band]

    def fills(self, band: int, n: int) -> bool:
        """Whether sets of the band's least and largest size fill more than ``most`` of n segments, but for e^-40."""
        for size in (self.tops[band - 1] + 1 if band else 1, self.tops[band]):
            if most := self.most(size):
                ways = math.lgamma(n + 1) - math.lgamma(most + 1) - math.lgamma(n - most + 1)
                if ways + size * math.log(most / n) > -40:
                    return False
        return True


def flat(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Elements of all sets, the set each belongs to, and the sizes."""
    sizes = np.array([len(s) for s in sets], np.int64)
    return np.concatenate([*sets, np.zeros(0, np.uint64)]), np.repeat(np.arange(len(sets)), sizes), sizes


def classes_of(elements: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64-bit classes of the sets."""
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(elements), dtype=np.uint64)))
    at = np.concatenate(([0], np.cumsum(sizes)))
    return mix(sums[at[1:]] - sums[at[:-1]] + sizes.astype(np.uint64)).view(np.int64)


def subsets(bands: Bands, elements: np.ndarray, owner: np.ndarray, sizes: np.ndarray, step: int):
    """The full segments of all sets in the band ``step`` below their own, where it may hold a partner: set, band, segment,
    size and sum of mixed elements of each; and for each element (in the order returned) its segment's index."""
    own = bands.of(sizes)
    band = own - step
    there = (band >= bands.lowest(sizes)) & (sizes > 0)
    n = np.array([bands.segments(int(b)) if ok else 1 for b, ok in zip(band, there, strict=True)], np.uint64)
    keep = there[owner]
    elements, owner = elements[keep], owner[keep]
    segment = (elements >> np.uint64(20)) % n[owner]
    order = np.argsort((owner.astype(np.uint64) << np.uint64(40)) + segment)
    elements, owner, segment = elements[order], owner[order], segment[order]
    first = edges(owner) | edges(segment)
    starts = np.flatnonzero(first)
    sums = np.add.reduceat(mix(elements ^ SALT), starts) if len(starts) else np.zeros(0, np.uint64)
    counts = np.diff(np.append(starts, len(elements)))
    return owner[starts], band[owner[starts]], segment[starts], counts, sums, elements, np.cumsum(first) - 1


def signature(band: np.ndarray, segment: np.ndarray, counts: np.ndarray, sums: np.ndarray) -> np.ndarray:
    return mix(sums + mix((segment.astype(np.uint64) << np.uint64(24)) + band.astype(np.uint64) * np.uint64(131) + np.uint64(7)) + counts.astype(np.uint64))


def allowed(bands: Bands, sizes: np.ndarray, band: np.ndarray) -> np.ndarray:
    """Differences at most between sets of these sizes and a partner, the smaller of the two being of this band."""
    return bands.most(np.minimum(bands.edges[band], sizes))


def parity(elements: np.ndarray) -> bytes:
    """A bit for each of 2 |set| or more cells of the universe: whether the set has an odd number of elements there."""
    bits = 1 << max(6, int(2 * len(elements) - 1).bit_length())
    return np.packbits((np.bincount(((elements >> np.uint64(8)) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def odd_bits(a: bytes, b: bytes) -> int:
    """Cells in which two bitmaps differ, the longer folded to the length of the shorter: never more than elements that differ."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    n = min(len(x), len(y))
    x, y = (np.bitwise_xor.reduce(v.reshape(-1, n), axis=0) for v in (x, y))
    return int(np.bitwise_count(x ^ y).sum())


def _dealt(buckets, values, batches):
    return dealt(buckets, values(batches))


def _sets(batches, k):
    for batch in batches:
        for a, b, data, offsets in slices(batch.column("text"), BLOCK):
            yield batch.slice(a, b - a), shingle_sets(data, offsets, k)


def _known(batches, k):
    """Sets of rows (text, node, ...) that are of the class that the row names."""
    for batch, sets in _sets(batches, k):
        elements, _, sizes = flat(sets)
        nodes = classes_of(elements, sizes)
        same = np.flatnonzero(nodes == np.array(batch.column("node").to_pylist(), np.int64))
        if len(same):
            yield batch.take(pa.array(same)), [sets[i] for i in same]


def _classes(k):
    def run(batches):
        for batch, sets in _sets(batches, k):
            elements, _, sizes = flat(sets)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(classes_of(elements, sizes)), pa.array(sizes), pa.array([parity(s) if len(s) else None for s in sets], pa.binary())], ["doc_id", "text_hash", "node", "n", "bits"])

    return run


def _index(bands, k, buckets):
    """MEMBER rows of the subsets of all texts, and NEED rows: how many of its subsets, at least, a set shares with a partner."""

    def values(batches):
        for _, sets in _sets(batches, k):
            elements, owner, sizes = flat(sets)
            nodes = classes_of(elements, sizes)
            for step in range(3):
                of, band, segment, counts, sums, _, _ = subsets(bands, elements, owner, sizes, step)
                sig = signature(band, segment, counts, sums)
                yield sig, MEMBER, (sig, nodes[of], np.full(len(of), step, np.int8))
                one = edges(of)
                full = np.bincount(of, minlength=len(sizes))[of[one]] if len(of) else of
                yield nodes[of[one]], NEED, (nodes[of[one]], np.full(int(one.sum()), step, np.int8), (full - allowed(bands, sizes[of[one]], band[one])).astype(np.int32))

    return lambda batches: dealt(buckets, values(batches))


def _elements(num, den, k, buckets):
    """The finest partition: every element a subset, shared to num / den with a partner. Only sets with ``asks`` need partners."""

    def values(batches):
        for batch, sets in _known(batches, k):
            elements, owner, sizes = flat(sets)
            nodes = np.array(batch.column("node").to_pylist(), np.int64)
            asks = np.array(batch.column("asks").to_pylist(), bool)
            sig = mix(elements)
            yield sig, MEMBER, (sig, nodes[owner], np.zeros(len(sig), np.int8))
            yield nodes, NEED, (nodes, np.zeros(len(nodes), np.int8), np.where(asks, -(-sizes * num // den), -1).astype(np.int32))

    return lambda batches: dealt(buckets, values(batches))


def _shared(batches):
    """Subsets that several sets have, sorted by subset and set; one of them must be in its own band. NEED rows pass."""
    for bucket, got in received(batches, LAYOUT):
        if len(got[NEED][0]):
            yield rows([bucket], [NEED], [[c.tobytes() for c in got[NEED]]])
        sig, node, step = got[MEMBER]
        order = np.argsort(sig, kind="stable")
        same = sig[order][1:] == sig[order][:-1]
        order = order[np.concatenate(([False], same)) | np.concatenate((same, [False]))] if len(order) else order
        order = order[np.lexsort((node[order], sig[order]))]
        sig, node, step = sig[order], node[order], step[order]
        keep = edges(sig) | edges(node)
        sig, node, step = sig[keep], node[keep], step[keep]
        if not len(sig):
            continue
        first = edges(sig)
        starts = np.flatnonzero(first)
        sizes = np.diff(np.append(starts, len(sig)))
        keep = np.repeat((sizes > 1) & (np.minimum.reduceat(step, starts) == 0), sizes)
        yield from whole_groups(bucket, MEMBER, first[keep], (sig[keep], node[keep], step[keep]))


def _stars(batches):
    """Pairs of a member and the smallest of its group, with how many groups of the row they share so."""
    for batch in batches:
        for cols in batch.column("cols"):
            sig, node, _ = (np.frombuffer(c.as_py(), t) for c, t in zip(cols, LAYOUT[MEMBER], strict=True))
            first = edges(sig)
            centre = np.repeat(node[first], np.diff(np.append(np.flatnonzero(first), len(sig))))
            a, b = node[~first], centre[~first]
            order = np.lexsort((b, a))
            a, b = a[order], b[order]
            new = np.flatnonzero(edges(a) | edges(b))
            yield pa.RecordBatch.from_arrays([pa.array(a[new]), pa.array(b[new]), pa.array(np.diff(np.append(new, len(a))))], ["node", "centre", "m"])


def _by_set(batches):
    for batch in batches:
        for cols in batch.column("cols"):
            cols = tuple(np.frombuffer(c.as_py(), t) for c, t in zip(cols, LAYOUT[MEMBER], strict=True))
            yield cols[1], MEMBER, cols


def _info(batches):
    for batch in batches:
        cols = tuple(batch.column(c).to_numpy(zero_copy_only=False).astype(t) for c, t in zip(("node", "size", "label", "n"), LAYOUT[INFO], strict=True))
        yield cols[0], INFO, cols


def _tagged(batches):
    """Members with the size and label of their component, the size of the set and what it needs, dealt by subset."""
    for _, got in received(batches, LAYOUT, {MEMBER: 1}):
        node, size, label, n = got[INFO]
        order = np.argsort(node)
        node, size, label, n = node[order], size[order], label[order], n[order]
        sig, member, step = got[MEMBER]
        if not len(sig):
            continue
        at = np.searchsorted(node, member)
        need = np.full((len(node), 3), -1, np.int32)
        of, of_step, least = got[NEED]
        need[np.searchsorted(node, of), of_step] = least
        yield sig, TAGGED, (sig, member, step, size[at], label[at], n[at], need[at, step])


def _priced(batches):
    """Groups of several components, by component; and for each member how many of larger components it would be compared with."""
    for bucket, got in received(batches, LAYOUT):
        sig, node, step, size, label, n, need = got[TAGGED]
        order = np.lexsort((label, size, sig))
        cols = [c[order] for c in (sig, node, step, size, label, n, need)]
        sig, node, step, size, label, n, need = cols
        if not len(sig):
            continue
        first = edges(sig)
        ends, part = run_ends(first), run_ends(first | edges(label))
        own = np.concatenate(([0], np.cumsum(step == 0)))
        cost = np.where(step == 0, ends - part, own[ends] - own[part]).astype(np.int32)
        mixed = np.repeat(np.add.reduceat(cost, np.flatnonzero(first)) > 0, np.diff(np.append(np.flatnonzero(first), len(sig))))
        if mixed.any():
            yield from whole_groups(bucket, PRICED, first[mixed], tuple(c[mixed] for c in (*cols, cost)))


def _prices(batches):
    """Members that something is asked of, dealt by set."""
    for batch in batches:
        for cols in batch.column("cols"):
            cols = [np.frombuffer(c.as_py(), t) for c, t in zip(cols, LAYOUT[PRICED], strict=True)]
            some = (cols[7] > 0) & (cols[6] >= 0)
            yield cols[1][some], PRICED, tuple(c[some] for c in cols)


def _allotted(hot, buckets, batches):
    """ASK rows, and COSTLY rows of the sets that would have to ask costly subsets."""
    dealer = Dealer(buckets)
    for _, got in received(batches, LAYOUT, {PRICED: 1}):
        sig, node, step, _, _, _, need, cost = got[PRICED]
        order = np.lexsort((sig, -cost, step, node))
        sig, node, step, need, cost = (c[order] for c in (sig, node, step, need, cost))
        if not len(sig):
            continue
        first = edges(node) | edges(step)
        starts = np.flatnonzero(first)
        sizes = np.diff(np.append(starts, len(sig)))
        asked = np.arange(len(sig)) - np.repeat(starts, sizes) >= need - 1
        cheap = asked & (cost <= hot)
        yield from dealer.add(sig[cheap], ASK, (sig[cheap], node[cheap]))
        lacks = np.add.reduceat((asked & (cost > hot)).astype(np.int64), starts)
        some = (np.repeat(lacks, sizes) > 0) & (cost > hot)
        if some.any():
            of = np.repeat(np.arange(len(starts)), sizes)[some]
            cuts = np.append(np.flatnonzero(edges(of)), len(of))
            told = [[node[some][a].tobytes(), int(step[some][a]).to_bytes(8, "little"), int(lacks[of[a]]).to_bytes(8, "little"), sig[some][a:b].tobytes()] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield rows([-1] * len(told), [COSTLY] * len(told), told)
    yield from dealer.flush()


def _lacking(batches):
    """COSTLY rows as table rows."""
    for batch in batches:
        read = lambda i, b=batch: pa.array([int.from_bytes(c.as_py()[i], "little", signed=True) for c in b.column("cols")], pa.int64())
        yield pa.RecordBatch.from_arrays([read(0), read(1), read(2), pa.array([c.as_py()[3] for c in batch.column("cols")], pa.binary())], ["node", "step", "lacks", "costly"])


def _hash(sig: np.ndarray, node: np.ndarray) -> np.ndarray:
    return mix(sig ^ mix(node.view(np.uint64)))


def _ratio(x: np.ndarray, y: np.ndarray, num: int, den: int) -> np.ndarray:
    return np.minimum(x, y).astype(np.int64) * den >= np.maximum(x, y).astype(np.int64) * num


def _pairs(num, den, batches):
    """Pairs (a < b) of the sets that ask with the members of larger components that the group holds."""
    for _, got in received(batches, LAYOUT):
        sig, node, step, size, label, n, _, _ = got[PRICED]
        if not len(sig) or not len(got[ASK][0]):
            continue
        first = edges(sig)
        ends, part = run_ends(first), run_ends(first | edges(label))
        asks = np.flatnonzero(np.isin(_hash(sig, node), _hash(*got[ASK])))
        for at in np.array_split(asks, max(1, len(asks) >> 14)):
            many = ends[at] - part[at]
            x = np.repeat(at, many)
            y = np.arange(len(x)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(part[at], many)
            ok = ((step[x] == 0) | (step[y] == 0)) & _ratio(n[x], n[y], num, den)
            a, b = np.minimum(node[x[ok]], node[y[ok]]), np.maximum(node[x[ok]], node[y[ok]])
            order = np.lexsort((b, a))
            a, b = a[order], b[order]
            new = edges(a) | edges(b)
            yield pa.RecordBatch.from_arrays([pa.array(a[new]), pa.array(b[new])], ["a", "b"])


def _costly(batches):
    for batch in batches:
        sig = np.unique(np.concatenate([np.frombuffer(c, np.uint64) for c in batch.column("costly").to_pylist()]))
        yield sig, COSTLY, (sig,)


def _met(batches):
    """Sets of the groups that are too costly for some set, dealt by set."""
    for _, got in received(batches, LAYOUT):
        node = np.unique(got[PRICED][1][np.isin(got[PRICED][0], got[COSTLY][0])])
        yield node, NAMED, (node,)


def _once(batches):
    for _, got in received(batches, LAYOUT):
        node = np.unique(got[NAMED][0])
        if len(node):
            yield pa.RecordBatch.from_arrays([pa.array(node)], ["node"])


def _neighbours(bands, k, buckets):
    """NEIGHBOUR rows: of all members the exact subsets (role 2) and those with one deletion (3); of sets that lack counts
    the same (0 and 1) of as many cheap segments of the band as they lack. Sets with too few have a row of kind NEED."""

    def values(batches):
        for batch, sets in _known(batches, k):
            elements, owner, sizes = flat(sets)
            node, size, label, n = (np.array(batch.column(c).to_pylist(), t) for c, t in zip(("node", "size", "label", "n"), LAYOUT[INFO], strict=True))
            lacks = batch.column("lacking").to_pylist()
            for step in range(3):
                of, band, segment, counts, sums, items, at = subsets(bands, elements, owner, sizes, step)
                if not len(of):
                    continue
                exact = signature(band, segment, counts, sums)
                less = signature(band[at], segment[at], counts[at] - 1, sums[at] - mix(items ^ SALT))
                some = counts[at] > 1
                told = lambda i, role, sig: (sig, NEIGHBOUR, (sig, node[i], np.full(len(i), role, np.int8), size[i], label[i], n[i]))  # noqa: B023, E731
                yield told(of, 2, exact)
                yield told(of[at][some], 3, less[some])
                chosen, short = np.zeros(len(of), bool), []
                for i, found in enumerate(lacks):
                    for r in found or []:
                        if r["step"] == step:
                            own = np.flatnonzero((of == i) & (counts > 1) & ~np.isin(exact, np.frombuffer(r["costly"], np.uint64)))
                            own = own[np.argsort(-counts[own], kind="stable")][: r["lacks"]]
                            if len(own) < r["lacks"]:
                                short.append(node[i])
                            else:
                                chosen[own] = True
                yield told(of[chosen], 0, exact[chosen])
                yield told(of[at][chosen[at]], 1, less[chosen[at]])
                if short:
                    short = np.array(short, np.int64)
                    yield short, NEED, (short, np.zeros(len(short), np.int8), np.zeros(len(short), np.int32))

    return lambda batches: dealt(buckets, values(batches))


def _close(hot, num, den, batches):
    """Pairs (a, b) of a set that lacks counts and a member of a larger component of which one's deletion is the other's subset;
    b is null for sets that have too few segments or meet a crowd."""
    for _, got in received(batches, LAYOUT):
        sig, node, role, size, label, n = got[NEIGHBOUR]
        order = np.lexsort((label, size, role, sig))
        sig, node, role, size, label, n = (c[order] for c in (sig, node, role, size, label, n))
        a, b = [got[NEED][0]], [np.full(len(got[NEED][0]), -1)]
        asks = np.flatnonzero(role < 2)
        low, high = np.searchsorted(sig, sig[asks]), np.searchsorted(sig, sig[asks], "right")
        for i, p, q in zip(asks.tolist(), low.tolist(), high.tolist(), strict=True):
            # an exact subset meets deletions, a deletion exact ones
            y = np.arange(p, q)[role[p:q] == 3 - role[i]]
            y = y[(size[y] > size[i]) | (size[y] == size[i]) & (label[y] > label[i])]
            crowd = len(y) > hot
            y = y[:0] if crowd else y[_ratio(n[y], n[i], num, den)]
            a.append(np.full(len(y) + crowd, node[i]))
            b.append(np.append(node[y], np.full(int(crowd), -1, np.int64)))
        a, b = np.concatenate(a, dtype=np.int64), np.concatenate(b, dtype=np.int64)
        if len(a):
            a, b = np.unique(np.stack([a, b]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b, mask=b == -1)], ["a", "b"])


def _plausible(num, den):
    def run(batches):
        for batch in batches:
            n, m = (batch.column(c).to_numpy() for c in ("na", "nb"))
            most = (n + m) * (den - num) // (den + num)
            keep = [odd_bits(x, y) <= h for x, y, h in zip(batch.column("ba").to_pylist(), batch.column("bb").to_pylist(), most.tolist(), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _content(k):
    def run(batches):
        for batch, sets in _known(batches, k):
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "elements"])

    return run


def _verified(num, den):
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("ea").to_pylist(), batch.column("eb").to_pylist(), strict=True):
                merged = np.concatenate((np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)))
                merged.sort()
                both = int(np.count_nonzero(merged[1:] == merged[:-1]))
                keep.append(den * both >= num * (len(merged) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _blocks(num, den):
    """Links of the asking sets of a block with its members: common elements counted for all sets of a batch at once. Of all
    links of a block those that join components (by label) that no link before them has joined, so that a block makes fewer
    rows than it has components, whatever number of its sets link with each other."""

    def run(batches):
        now, held = None, []
        for batch in batches:
            out = [], []
            for block, salt, asks, node, label, raw in zip(*(batch.column(c).to_pylist() for c in ("block", "salt", "asks", "node", "label", "elements")), strict=True):
                if (block, salt) != now:
                    now, held, index = (block, salt), [], None
                own = np.frombuffer(raw, np.uint64)
                if asks:
                    held.append((node, label, own))
                    continue
                if index is None:
                    elements, owner, sizes = flat([s for _, _, s in held])
                    order = np.argsort(elements, kind="stable")
                    elements, owner = elements[order], owner[order]
                    index = True
                    nodes, joined = (np.array([h[i] for h in held], np.int64) for i in range(2))
                    above: dict[int, int] = {}
                while label in above:
                    label = above[label]
                if (joined == label).all():
                    continue
                low, high = np.searchsorted(elements, own), np.searchsorted(elements, own, "right")
                many = high - low
                both = np.bincount(owner[np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)], minlength=len(held))
                hit = np.flatnonzero((joined != label) & (den * both >= num * (sizes + len(own) - both)))
                if len(hit):
                    met, at = np.unique(joined[hit], return_index=True)
                    out[0].append(np.minimum(nodes[hit[at]], node))
                    out[1].append(np.maximum(nodes[hit[at]], node))
                    above.update(dict.fromkeys(met.tolist(), label))
                    joined[np.isin(joined, met)] = label
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["a", "b"])

    return run


def jaccard_components(docs: DataFrame, k: int = 5, num: int = 75, den: int = 100) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id.

    Texts link when their sets of k-word shingles (A-Z lower-cased, words between ASCII white
    space) have ``den * |intersection| >= num * |union|``; fewer than k words make one shingle;
    null, empty and blank texts have no set and link with nothing. component_id is the smallest
    doc_id that links lead to; rows without a set carry their own doc_id. Equal sets count as
    linked. A null doc_id counts in no minimum (a component of null ids has a null id); repeated
    rows are one class. An empty table gives no rows; further columns are ignored.
    """
    every, final = _components(docs, k, num, den)
    out = every.join(final, (every["node"] == final["node"]) & (every["n"] > 0), "left")
    return out.select(every["doc_id"], every["n"].alias("n_shingles"), F.when(every["n"] > 0, final["low"]).otherwise(every["doc_id"]).alias("component_id"))


def _components(docs: DataFrame, k: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, text_hash, node, n, bits) of all texts; and (node, low, first) of all classes, ``first`` being
    the first row (no_id, doc_id, text_hash) of the component."""
    spark = docs.sparkSession
    docs = docs.select(*pick(docs, "doc_id", "text"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("text_hash", F.xxhash64("text"))
    bands = Bands(num, den)
    parts = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    paths: list[str] = []

    def kept(df: DataFrame, name: str) -> DataFrame:
        df, path = store(df, name)
        paths.append(path)
        return df

    every, _ = store(docs.mapInArrow(_classes(k), "doc_id long, text_hash long, node long, n long, bits binary"), "classes")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash"))
    classes = kept(every.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("low"), first.alias("first"), F.first("n").alias("n"), F.first("bits").alias("bits"), F.count("*").alias("copies")), "reps")
    # a task that deals makes a row for each bucket, so rows grow with the square of the buckets: no more of them than the sets fill
    buckets = max(8, min(parts, int(classes.agg(F.sum("n")).first()[0] or 0) // DEALT))
    few = max(8, buckets // 4)

    def same(a: DataFrame, some: DataFrame, how: str) -> DataFrame:
        """``a`` joined by id and text hash, null ids too, with (id, hash, ...)."""
        return a.join(some, a["doc_id"].eqNullSafe(some["id"]) & (a["text_hash"] == some["hash"]), how)

    def texts(nodes: DataFrame) -> DataFrame:
        """(text, node, ...) of the sets that ``nodes`` (node, ...) names, each by its class's first row (again where that row repeats)."""
        some = nodes.join(classes.select("node", F.col("first.doc_id").alias("id"), F.col("first.text_hash").alias("hash")), "node")
        return same(docs, sized(kept(some, "named"), limit=BROADCAST_KEYS // 4), "inner").drop("doc_id", "text_hash", "id", "hash")

    def links(pairs: DataFrame) -> DataFrame:
        """Those of the pairs (a < b) that reach the threshold."""
        side = lambda s: classes.select(F.col("node").alias(s), F.col("n").alias(f"n{s}"), F.col("bits").alias(f"b{s}"))
        near = pairs.join(side("a"), "a").join(side("b"), "b").where(f"least(na, nb) * {den} >= greatest(na, nb) * {num}")
        near = kept(near.mapInArrow(_plausible(num, den), "a long, b long"), "near")
        ends = near.select(F.col("a").alias("node")).union(near.select(F.col("b").alias("node"))).distinct()
        sets = kept(texts(ends).mapInArrow(_content(k), "node long, elements binary").dropDuplicates(["node"]), "sets")
        side = lambda s: sets.select(F.col("node").alias(s), F.col("elements").alias(f"e{s}"))
        return kept(near.join(side("a"), "a").join(side("b"), "b").mapInArrow(_verified(num, den), "a long, b long"), "links")

    def packed(df: DataFrame, values) -> DataFrame:
        return df.mapInArrow(partial(_dealt, buckets, values), SCHEMA)

    def shared(index: DataFrame) -> DataFrame:
        return kept(exchange(index, buckets, _shared), "shared")

    def met(priced: DataFrame, lacking: DataFrame) -> DataFrame:
        """(node) of all members of the groups that are too costly for some set."""
        return exchange(exchange(priced.unionByName(packed(lacking.select("costly"), _costly)), buckets, partial(_dealt, buckets, _met)), buckets, _once, "node long")

    def meet(multi: DataFrame, info: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame | None]:
        """Links through cheap subsets between components, the priced groups, and the sets that lack counts (node, step, lacks, costly), None if there are none."""
        members = packed(multi.where(f"kind = {MEMBER}"), _by_set)
        tagged = exchange(members.unionByName(multi.where(f"kind = {NEED}")).unionByName(packed(info.select("node", "size", "label", "n"), _info)), buckets, partial(_dealt, buckets, _tagged))
        priced = kept(exchange(tagged, buckets, _priced).coalesce(few), "priced")
        allotted = kept(exchange(packed(priced, _prices), buckets, partial(_allotted, HOT, buckets)).coalesce(few), "allotted")
        pairs = exchange(priced.unionByName(allotted.where(f"kind = {ASK}")), buckets, partial(_pairs, num, den), "a long, b long").distinct()
        costly = allotted.where(f"kind = {COSTLY}")
        lacking = None if costly.isEmpty() else kept(costly.mapInArrow(_lacking, "node long, step long, lacks long, costly binary"), "lacking")
        return links(pairs), priced, lacking

    # all rows but the first of classes with several
    spare = every.where("n > 0").join(sized(classes.where("copies > 1").select("node", F.col("first.doc_id").alias("id"), F.col("first.text_hash").alias("hash")), limit=BROADCAST_KEYS // 8), "node")
    spare = kept(spare.where(~(F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash")))).select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")).distinct(), "spare")
    multi = shared(same(docs, sized(spare, limit=BROADCAST_KEYS // 2), "left_anti").select("text").mapInArrow(_index(bands, k, buckets), SCHEMA))
    stars = multi.where(f"kind = {MEMBER}").mapInArrow(_stars, "node long, centre long, m long").groupBy("node", "centre").agg(F.sum("m").alias("m"))
    stars = stars.groupBy("node").agg(F.max(F.struct("m", (-F.col("centre")).alias("c"))).alias("x")).select("node", (-F.col("x.c")).alias("centre"))
    found = links(stars.select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct())
    label = kept(labelled(found), "labels")
    label = label.join(label.groupBy("label").agg(F.count("*").cast("int").alias("size")), "label")
    info = kept(classes.select("node", F.col("n").cast("int").alias("n")).join(label, "node", "left").select("node", "n", F.coalesce("size", F.lit(1)).alias("size"), F.coalesce("label", "node").alias("label")), "info")
    more, priced, lacking = meet(multi, info)
    found = found.unionByName(more)
    if lacking is not None:
        asks = lacking.groupBy("node").agg(F.collect_list(F.struct("step", "lacks", "costly")).alias("lacking"))
        some = info.join(met(priced, lacking), "node", "left_semi").join(asks, "node", "left")
        close = kept(exchange(texts(some).mapInArrow(_neighbours(bands, k, buckets), SCHEMA), buckets, partial(_close, HOT, num, den), "a long, b long").coalesce(few), "close")
        last = kept(close.where("b is null").select(F.col("a").alias("node")).distinct(), "unserved")
        pairs = close.where("b is not null").join(last.withColumnRenamed("node", "a"), "a", "left_anti")
        found = found.unionByName(links(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()))
        if not last.isEmpty():
            some = info.join(met(priced, lacking.join(last, "node", "left_semi")), "node", "left_semi").join(last.withColumn("asks", F.lit(True)), "node", "left").withColumn("asks", F.coalesce("asks", F.lit(False)))
            finer = shared(texts(some.select("node", "asks")).mapInArrow(_elements(num, den, k, buckets), SCHEMA))
            more, priced, lacking = meet(finer, info)
            found = found.unionByName(more)
            if lacking is not None:
                found = found.unionByName(kept(_compared(info, met(priced, lacking), lacking, texts, kept, parts, k, num, den), "compared"))
    ends = kept(labelled(found), "components")
    ids = classes.join(ends, "node", "left").select("node", "low", "first", F.coalesce("label", "node").alias("label"))
    lowest = ids.groupBy("label").agg(F.min("low").alias("low"), F.min("first").alias("first"))
    final, _ = store(ids.select("node", "label").join(lowest, "label").select("node", "low", "first"), "final")
    drop(spark, *paths)
    return every, final


def _compared(info, members, lacking, texts, kept, parts, k, num, den) -> DataFrame:
    """Links of the sets that lack counts even by element: blocks of them meet all members of their groups."""
    asks = kept(lacking.select("node").distinct(), "asks")
    sets = kept(texts(info.select("node").join(members.union(asks).distinct(), "node")).mapInArrow(_content(k), "node long, elements binary").dropDuplicates(["node"]).join(info.select("node", "label"), "node"), "crowd")
    asking = sets.join(asks, "node", "left_semi")
    blocks = 1 + int(asking.agg(F.sum(F.length("elements"))).first()[0] or 0) // (8 * ASKED)
    salts = max(1, min(parts, sets.count() // 1000))
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    one = asking.select("node", "label", "elements", F.pmod(F.xxhash64("node"), F.lit(blocks)).alias("block"), upto(salts).alias("salt"), F.lit(True).alias("asks"))
    all_ = sets.select("node", "label", "elements", upto(blocks).alias("block"), F.pmod(F.xxhash64("node", F.lit(1)), F.lit(salts)).alias("salt"), F.lit(False).alias("asks"))
    dealt = one.unionByName(all_).repartition(max(parts, blocks * salts), "block", "salt").sortWithinPartitions("block", "salt", F.col("asks").desc())
    return dealt.mapInArrow(_blocks(num, den), "a long, b long").distinct()


def one_of_each(docs: DataFrame, k: int = 5, num: int = 75, den: int = 100) -> DataFrame:
    """One row, all columns, of each component of ``docs``: that of the smallest id, of a null id only if there
    is no other; of several texts under that id, that of the smallest hash. All rows without words stay. An empty
    table stays empty; further columns, whatever their names, stay as they are."""
    every, final = _components(docs, k, num, den)
    found = every.where("n > 0").join(final, "node").select(F.col("doc_id").alias("__d"), F.col("text_hash").alias("__t"), (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))).alias("kept"))
    # a row is known by its id and text, as repeated and null ids stand for several
    found = found.groupBy("__d", "__t").agg(F.first("kept").alias("kept"), F.count("*").alias("copies"))
    found, _ = store(found.where("not kept or copies > 1"), "decided")
    some = lambda which: sized(found.where(which).select("__d", "__t"), limit=BROADCAST_KEYS // 2)
    spare, again = some("not kept"), some("kept")
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    same = doc_id.eqNullSafe(F.col("__d")) & (F.xxhash64(text) == F.col("__t"))
    kept = docs.join(spare, same, "left_anti")
    # of rows with one id and text, one
    repeated = kept.join(again, same, "left_semi").withColumns({"__d": doc_id, "__t": F.xxhash64(text)}).dropDuplicates(["__d", "__t"]).drop("__d", "__t")
    return kept.join(again, same, "left_anti").unionByName(repeated)
