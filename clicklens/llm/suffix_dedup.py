"""Removal of repeated passages by sorted suffixes (deep-shallow sorting).

A byte of a document goes if it lies in a string of ``length`` bytes that also
starts in a document with a smaller id. All suffixes of the corpus, cut at
``length`` bytes, are put in order; those equal over the whole length stand
together, and each learns the smallest document of its group.

*Partitioning.* The order is needed only among suffixes that can be equal, so
they are dealt by content: of the 8-byte strings inside a suffix's first
``length`` bytes, the one with the least hash (the leftmost of equals) names its
bucket. Equal suffixes have the same one. Neighbouring suffixes mostly share
it, so they travel as one *region*, the bytes from the first one's start to the
last one's end: about 3.2 times the text, packed and compressed per bucket. The
number of buckets follows the size of the corpus. A naming string that is
frequent (by a sample of the texts, which settles where suffixes go and never
what is found) is too much for one bucket. The suffixes it names are dealt by it
and the bytes beside it, those on its left if it stands in the right half of the
suffix, else those on its right; where that is frequent too, by all their bytes.
Equal suffixes have the name at the same place, so they still meet.

*Before the shuffle* equal regions of a block of documents are merged: the
block's smallest document with the region stands for all, and the others are
decided on the spot. So a passage that a third of the corpus shares is sent
once for each block, and a document that repeats one line for ever sends it once.

*In a bucket* regions go whose context on neither side of the naming string
occurs in another document, and equal regions are merged. The suffixes that are
left are sorted: multikey quicksort, eight bytes at a step, down to a shallow
depth; what still is together then has a long common prefix and is ordered by a
blind trie, which compares each string with one other only.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicklens.llm.common import blocks

WORD = 8
SHALLOW = 40
BLOCK, SCAN = 8 << 20, 2 << 20
BUCKET = 12 << 20
LEVEL = 6
#: Bytes of regions from which a naming string is frequent; one text in so many, and every long one, is looked at.
HOT = BUCKET // 4
SAMPLE, LONG = 64, 1 << 20
COLD = (np.zeros(0, np.uint64), np.zeros(0, np.uint64))
#: Regions take about 1 + length / spacing times the text.
SPREAD = 3.3
NO_ID = (1 << 63) - 1
ORDER, DEAL, MIX = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))
LOW = np.uint64((1 << 27) - 1)

REGIONS = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("packed", T.BinaryType())])
WEIGHTS = T.StructType([T.StructField("beside", T.BooleanType()), T.StructField("key", T.LongType()),
                        T.StructField("weight", T.LongType())])
HITS = T.StructType([T.StructField("rank", T.LongType()), T.StructField("mark", T.IntegerType()),
                     T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])


def words_at(buffer: np.ndarray) -> np.ndarray:
    """View of a byte array as the little-endian 8-byte word at each of its positions."""
    return np.ndarray(max(0, len(buffer) - WORD + 1), "<u8", buffer, 0, (1,))


def _mixed(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    h = (h ^ word) * MIX
    return h ^ (h >> np.uint64(32))


def hashed(words: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hashes of the strings [start, start + size), each of 8 bytes at least."""
    h = size.astype(np.uint64) * ORDER
    for k in range(0, int(size.max(initial=0)), WORD):
        at = np.minimum(k, size - WORD)
        h = _mixed(h, words[start + at])
    return h


def same_bytes(words: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether [a, a + size) equals [b, b + size)."""
    out = np.ones(len(a), bool)
    for k in range(0, int(size.max(initial=0)), WORD):
        at = np.minimum(k, size - WORD)
        out &= words[a + at] == words[b + at]
    return out


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals as maximal ones, in order."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.r_[True, start[1:] > end[:-1]]
    last = np.r_[np.flatnonzero(new)[1:] - 1, len(start) - 1]
    return start[new], end[last]


def _least_in_windows(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    size = 1
    while size * 2 <= width:
        v = np.minimum(v[:-size], v[size:])
        size *= 2
    rest = width - size
    return np.minimum(v[:len(v) - rest], v[rest:]) if rest else v


def regions(buffer: np.ndarray, piece_start: np.ndarray, piece_end: np.ndarray, length: int):
    """(start, number of suffixes, place of the naming string) of the regions of all pieces."""
    words = words_at(buffer)
    h = words * ORDER
    h ^= h >> np.uint64(31)
    h *= MIX
    v = (h & ~LOW) | np.arange(len(h), dtype=np.uint64)
    owner = (_least_in_windows(v, length - WORD + 1) & LOW).astype(np.int64)
    valid = np.zeros(len(owner) + 1, bool)
    for a, b in zip(piece_start.tolist(), piece_end.tolist()):
        if b - a >= length:
            valid[a:b - length + 1] = True
    valid = valid[:-1]
    new = valid.copy()
    new[1:] &= (owner[1:] != owner[:-1]) | ~valid[:-1]
    # A piece may start right where the suffixes of the one before end.
    new[piece_start[piece_start < len(new)]] |= valid[piece_start[piece_start < len(new)]]
    first = np.flatnonzero(new)
    run = np.cumsum(new)[valid] - 1
    return first, np.bincount(run, minlength=len(first)), owner[first]


def sides(words: np.ndarray, first: np.ndarray, n: np.ndarray, name: np.ndarray, length: int):
    """(region, offset, number of suffixes, key) of regions cut by the side of the naming string that fills the key."""
    half = (length - WORD) // 2
    left = np.clip(name - half - first + 1, 0, n)
    of = np.repeat(np.arange(len(first)), 2)
    offset, num, start = (np.stack(x, 1).ravel() for x in ((left * 0, left), (left, n - left), (name - half, name)))
    some = num > 0
    of, offset, num, start = of[some], offset[some], num[some], start[some]
    return of, offset, num, hashed(words, start, np.full(len(of), half + WORD))


def pack(arrays: list[np.ndarray]) -> bytes:
    head = np.array([len(a) for a in arrays], "<i8")
    return zstandard.compress(b"".join([head.tobytes(), *(a.tobytes() for a in arrays)]), LEVEL)


KINDS = ["<i8", "<i4", "<i4", "<u2", "<u2", "<u4", "<i8", "u1", "<i4", "<i8", "<i8"]


def unpack(packed: bytes) -> list[np.ndarray]:
    raw = zstandard.decompress(packed)
    at, out = 8 * len(KINDS), []
    for n, kind in zip(np.frombuffer(raw, "<i8", len(KINDS)).tolist(), KINDS):
        out.append(np.frombuffer(raw, kind, n, at))
        at += out[-1].nbytes
    return out


def block_rows(rank: np.ndarray, mark: np.ndarray, pieces: list[tuple[int, int, bytes]], length: int,
               buckets: int, hot: tuple[np.ndarray, np.ndarray] = COLD) -> Iterator[tuple[int, bytes]]:
    """(bucket, packed regions) of a block; ``pieces`` are (document, offset in it, bytes), ``hot`` is of ``frequent``."""
    size = np.array([len(p[2]) for p in pieces], np.int64)
    ends = np.cumsum(size)
    starts = ends - size
    buffer = np.frombuffer(b"".join(p[2] for p in pieces), np.uint8)
    if len(buffer) < length:
        return
    parts, at = [], 0
    while at < len(pieces):
        # A few pieces at a time: the scan keeps several numbers for each byte.
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + SCAN, "right")))
        a, b = int(starts[at]), int(ends[to - 1])
        if b - a >= length:
            f, n, w = regions(buffer[a:b], starts[at:to] - a, ends[at:to] - a, length)
            parts.append((f + a, n, w + a))
        at = to
    first, n, name = (np.concatenate([p[i] for p in parts] or [np.zeros(0, np.int64)]) for i in range(3))
    if not len(first):
        return
    words = words_at(buffer)
    piece = np.searchsorted(starts, first, "right") - 1
    doc = np.array([p[0] for p in pieces], np.int64)[piece]
    start = first - starts[piece] + np.array([p[1] for p in pieces], np.int64)[piece]
    span = n + length - 1
    # Equal regions: the smallest document stays, others are hit; its own repeats share one entry.
    key = hashed(words, first, span)
    order = np.lexsort((start, doc, rank[doc], key))
    lead = np.r_[True, key[order][1:] != key[order][:-1]]
    leader = order[np.maximum.accumulate(np.where(lead, np.arange(len(order)), 0))]
    twin = ~lead & same_bytes(words, first[order], first[leader], np.where(
        span[order] == span[leader], span[order], WORD)) & (span[order] == span[leader])
    hit = twin & (rank[doc[order]] > rank[doc[leader]])
    again = twin & (doc[order] == doc[leader])
    entry = ~hit & ~again
    entries = order[entry]
    of = np.cumsum(entry) - 1
    # A repeat belongs to its leader's entry, which is the latest entry that leads.
    lead_of = of[np.maximum.accumulate(np.where(lead, np.arange(len(order)), 0))]
    of = np.where(again, lead_of, of)[~hit]
    own_start = start[order][~hit]
    by_entry = np.argsort(of, kind="stable")
    own_start, count = own_start[by_entry], np.bincount(of, minlength=len(entries))
    count_end = np.cumsum(count)
    hit_doc, hit_start, hit_end = doc[order][hit], start[order][hit], (start + span)[order][hit]
    # What travels: (entry, offset in it, suffixes, key); entries of frequent names are cut.
    of, offset, num, key = np.arange(len(entries)), np.zeros(len(entries), np.int64), n[entries], words[name[entries]]
    often = np.isin(key, hot[0])
    if often.any():
        cut = np.flatnonzero(often)
        at = entries[cut]
        side = sides(words, first[at], n[at], name[at], length)
        side = (cut[side[0]], *side[1:])
        very = np.isin(side[3], hot[1])
        each = np.repeat(side[0][very], side[2][very])
        nth = np.arange(len(each)) - np.repeat(np.cumsum(side[2][very]) - side[2][very], side[2][very])
        nth += np.repeat(side[1][very], side[2][very])
        at = first[entries[each]] + nth
        full = np.full(len(each), length)
        whole = hashed(words, at, full)
        # Of equal suffixes those of the smallest document stay, as with regions.
        own = rank[doc[entries[each]]]
        by = np.lexsort((own, whole))
        head = by[np.maximum.accumulate(np.where(np.r_[True, whole[by][1:] != whole[by][:-1]], np.arange(len(by)), 0))
                  ] if len(by) else by
        later = same_bytes(words, at[by], at[head], full) & (own[by] > own[head])
        lost, stay = by[later], np.sort(by[~later])
        c = count[each[lost]]
        s = own_start[np.repeat(count_end[each[lost]] - np.cumsum(c), c) + np.arange(int(c.sum()))]
        s = s + np.repeat(nth[lost], c)
        hit_doc, hit_start, hit_end = (np.r_[hit_doc, np.repeat(doc[entries[each[lost]]], c)], np.r_[hit_start, s],
                                       np.r_[hit_end, s + length])
        of, offset, num, key = (np.concatenate(x) for x in zip(
            (of[~often], offset[~often], num[~often], key[~often]), (x[~very] for x in side),
            (each[stay], nth[stay], np.ones(len(stay), np.int64), whole[stay])))
    bucket = ((key ^ MIX) * DEAL >> np.uint64(33)) % np.uint64(buckets)
    bucket = bucket.astype(np.int64)
    known = np.lexsort((hit_start, hit_doc))
    hit_doc, hit_start, hit_end = hit_doc[known], hit_start[known], hit_end[known]
    cut = np.r_[0, np.flatnonzero(np.diff(hit_doc)) + 1, len(hit_doc)] if len(hit_doc) else np.zeros(1, int)
    told: dict[int, list] = {}
    for i, j in zip(cut[:-1].tolist(), cut[1:].tolist()):
        s, e = merged(hit_start[i:j], hit_end[i:j])
        told.setdefault(int(hit_doc[i]) % buckets, []).append((int(hit_doc[i]), s, e))
    by_bucket = np.argsort(bucket, kind="stable")
    filled = np.unique(np.concatenate([bucket, np.fromiter(told, np.int64, len(told))]))
    edges = np.searchsorted(bucket[by_bucket], [filled, filled + 1])
    for b, i, j in zip(filled.tolist(), *edges.tolist()):
        e, mine = by_bucket[i:j], told.get(b, [])
        e = e[np.lexsort((start[entries[of[e]]] + offset[e], doc[entries[of[e]]]))]      # in page order they pack best
        r = entries[of[e]]
        from_, size = first[r] + offset[e], num[e] + length - 1
        docs, local = np.unique(np.concatenate([doc[r], [m[0] for m in mine]]).astype(np.int64), return_inverse=True)
        to = np.cumsum(size)
        source = np.repeat(from_ - (to - size), size) + np.arange(int(to[-1]) if len(to) else 0)
        runs = count[of[e]]
        ends_ = np.cumsum(runs)
        take = np.repeat(count_end[of[e]] - ends_, runs) + np.arange(int(ends_[-1]) if len(ends_) else 0)
        own = own_start[take] + np.repeat(offset[e], runs)
        yield b, pack([
            rank[docs].astype("<i8"), mark[docs].astype("<i4"),
            np.diff(local[:len(r)], prepend=0).astype("<i4"), size.astype("<u2"),
            (name[r] - from_).astype("<u2"), runs.astype("<u4"), own.astype("<i8"), buffer[source],
            np.repeat(local[len(r):], [len(m[1]) for m in mine]).astype("<i4"),
            np.concatenate([m[1] for m in mine] or [[]]).astype("<i8"),
            np.concatenate([m[2] for m in mine] or [[]]).astype("<i8")])


class BlindTrie:
    """Orders strings of one length that share a long prefix.

    A node knows only the place where its strings first differ and the byte
    each branch has there. A new string goes down blindly to some leaf and is
    compared with that one; the place of the first difference says where it
    belongs.
    """

    def __init__(self):
        self.root = None
        self.leaves: list[bytes] = []

    def insert(self, s: bytes) -> int:
        """The leaf of ``s``; equal strings have one leaf."""
        if self.root is None:
            self.leaves.append(s)
            self.root = 0
            return 0
        node = self.root
        while isinstance(node, tuple):
            at, keys, below = node
            i = bisect_left(keys, s[at])
            node = below[min(i, len(keys) - 1)]
        other = self.leaves[node]
        if other == s:
            return node
        differ = next(i for i, (a, b) in enumerate(zip(s, other)) if a != b)
        leaf = len(self.leaves)
        self.leaves.append(s)
        up, node = None, self.root
        while isinstance(node, tuple) and node[0] < differ:
            up, node = node, node[2][bisect_left(node[1], s[node[0]])]
        if isinstance(node, tuple) and node[0] == differ:
            i = bisect_left(node[1], s[differ])
            node[1].insert(i, s[differ])
            node[2].insert(i, leaf)
            return leaf
        pair = sorted([(s[differ], leaf), (other[differ], node)], key=lambda x: x[0])
        new = (differ, [p[0] for p in pair], [p[1] for p in pair])
        if up is None:
            self.root = new
        else:
            up[2][bisect_left(up[1], s[up[0]])] = new
        return leaf

    def order(self) -> list[int]:
        """Leaves in the order of their strings."""
        out, todo = [], [self.root] if self.root is not None else []
        while todo:
            node = todo.pop()
            if isinstance(node, tuple):
                todo += node[2][::-1]
            else:
                out.append(node)
        return out


def sort_suffixes(buffer: np.ndarray, pos: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes at ``pos`` by ``length`` bytes, and a number per place that equal ones share.

    Suffixes that have nothing equal to them stop as soon as they stand alone.
    """
    words = words_at(buffer)
    order = np.arange(len(pos))
    group = np.zeros(len(pos), np.int64)
    active = np.arange(len(pos))
    shallow = min(SHALLOW, length - length % WORD)
    for depth in range(0, shallow, WORD):
        if not len(active):
            break
        key = words[pos[order[active]] + depth].byteswap()
        by = np.lexsort((key, group[active])) if depth else np.argsort(key, kind="stable")
        order[active] = order[active][by]
        key, g = key[by], group[active]
        new = np.r_[True, (g[1:] != g[:-1]) | (key[1:] != key[:-1])]
        # A group is named by the place where it starts, so names keep the order.
        group[active] = active[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        alone = new & np.r_[new[1:], True]
        active = active[~alone]
    if len(active) and shallow < length:
        g = group[active]
        edge = np.r_[0, np.flatnonzero(np.diff(g)) + 1, len(g)]
        lead = np.repeat(edge[:-1], np.diff(edge))
        at = pos[order[active]]
        rest = max(shallow, length - WORD)
        differs = words[at + rest] != words[at[lead] + rest]
        if rest > shallow:
            differs |= words[at + shallow] != words[at[lead] + shallow]
        mixed = np.unique(lead[differs])
        sizes = np.diff(edge)[np.searchsorted(edge, mixed)]
        for i, n in zip(mixed.tolist(), sizes.tolist()):
            places = active[i:i + n]
            tails = [buffer[p + shallow:p + length].tobytes() for p in pos[order[places]].tolist()]
            trie = BlindTrie()
            leaf = np.array([trie.insert(t) for t in tails])
            nth = np.empty(len(trie.leaves), np.int64)
            nth[trie.order()] = np.arange(len(trie.leaves))
            by = np.argsort(nth[leaf], kind="stable")
            order[places] = order[places][by]
            leaf = leaf[by]
            new = np.r_[True, leaf[1:] != leaf[:-1]]
            group[places] = places[np.maximum.accumulate(np.where(new, np.arange(n), 0))]
    return order, group


def _shared(key: np.ndarray, there: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Which entries have a key, where it is there, that another rank has too."""
    out = np.zeros(len(key), bool)
    at = np.flatnonzero(there)
    if not len(at):
        return out
    order = at[np.argsort(key[at], kind="stable")]
    edge = np.flatnonzero(np.r_[True, key[order][1:] != key[order][:-1]])
    low, high = np.minimum.reduceat(rank[order], edge), np.maximum.reduceat(rank[order], edge)
    out[order] = np.repeat(low != high, np.diff(np.r_[edge, len(order)]))
    return out


def bucket_hits(packed: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """(rank, mark, start, end) of the repeated passages that a bucket's regions show."""
    parts = [unpack(p) for p in packed]
    base = np.cumsum([0, *(len(p[0]) for p in parts)])
    rank, mark = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    doc = np.concatenate([np.cumsum(p[2]) + o for p, o in zip(parts, base)])
    span, name = (np.concatenate([p[i] for p in parts]).astype(np.int64) for i in (3, 4))
    count = np.concatenate([p[5] for p in parts]).astype(np.int64)
    starts, buffer = np.concatenate([p[6] for p in parts]), np.concatenate([p[7] for p in parts])
    out = [(np.concatenate([p[8] + o for p, o in zip(parts, base)]), np.concatenate([p[9] for p in parts]),
            np.concatenate([p[10] for p in parts]))]
    del parts
    first = np.cumsum(span) - span
    occurs = np.cumsum(count) - count
    words = words_at(buffer)
    own = rank[doc]
    # A suffix reaches half the rest to the one side of the naming string or to the other.
    half = (length - WORD) // 2
    size = np.full(len(span), half + WORD, np.int64)
    left, right = name >= half, name + WORD + half <= span
    keys = [np.zeros(len(span), np.uint64) for _ in range(2)]
    keys[0][left] = hashed(words, (first + name - half)[left], size[left])
    keys[1][right] = hashed(words, (first + name)[right], size[right])
    near = np.flatnonzero(_shared(keys[0], left, own) | _shared(keys[1], right, own))
    if len(near):
        # Merge equal regions; ``low`` is the smallest document that holds one.
        h = hashed(words, first[near], span[near])
        order = np.lexsort((own[near], h))
        lead = np.r_[True, h[order][1:] != h[order][:-1]]
        leader = order[np.maximum.accumulate(np.where(lead, np.arange(len(order)), 0))]
        a, b = near[order], near[leader]
        lead |= (span[a] != span[b])
        lead |= ~same_bytes(words, first[a], first[b], np.where(span[a] == span[b], span[a], WORD))
        kind = np.cumsum(lead) - 1
        one = a[lead]
        low = np.minimum.reduceat(own[a], np.flatnonzero(lead))
        n = span[one] - length + 1
        at = np.cumsum(n) - n
        within = np.arange(int(n.sum())) - np.repeat(at, n)
        of = np.repeat(np.arange(len(one)), n)
        order, group = sort_suffixes(buffer, first[one][of] + within, length)
        edge = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        least = np.empty(len(order), np.int64)
        least[order] = np.repeat(np.minimum.reduceat(low[of[order]], edge), np.diff(np.r_[edge, len(order)]))
        # Whole regions in larger documents, then the suffixes of the smallest that others have too.
        whole = a[own[a] > low[kind]]
        which = np.repeat(whole, count[whole])
        nth = np.arange(len(which)) - np.repeat(np.cumsum(count[whole]) - count[whole], count[whole])
        s = starts[occurs[which] + nth]
        out.append((doc[which], s, s + span[which]))
        hit = least < low[of]
        edge = np.flatnonzero(hit & ~np.r_[False, hit[:-1] & (of[1:] == of[:-1])])
        stop = np.flatnonzero(hit & ~np.r_[hit[1:] & (of[1:] == of[:-1]), False])
        firsts = a[(own[a] == low[kind])]
        kinds = kind[own[a] == low[kind]]
        run_from, run_to = np.searchsorted(of[edge], kinds), np.searchsorted(of[edge], kinds, "right")
        runs = run_to - run_from
        reg = np.repeat(firsts, runs)
        r = np.arange(len(reg)) - np.repeat(np.cumsum(runs) - runs, runs) + np.repeat(run_from, runs)
        c = count[reg]
        reg2, r2 = np.repeat(reg, c), np.repeat(r, c)
        nth = np.arange(len(reg2)) - np.repeat(np.cumsum(c) - c, c)
        s = starts[occurs[reg2] + nth]
        out.append((doc[reg2], s + within[edge[r2]], s + within[stop[r2]] + length))
    d, s, e = (np.concatenate([o[i] for o in out]) for i in range(3))
    if not len(d):
        return rank[d], mark[d], s, e
    # Join what touches, on one line of all documents with a gap between them.
    apart = int(e.max()) + 2
    s, e = merged(s + d * apart, e + d * apart)
    d = s // apart
    return rank[d], mark[d], s - d * apart, e - d * apart


def weights(texts: list[bytes], length: int) -> Iterator[tuple[bool, np.ndarray, np.ndarray]]:
    """(whether with the bytes beside, keys, bytes of regions) of naming strings; equal regions of a scan count once."""
    texts = [t[at:at + SCAN] for t in texts if len(t) >= length for at in range(0, len(t) - length + 1, SCAN - length + 1)]
    at = 0
    while at < len(texts):
        to, held = at, 0
        while to < len(texts) and (to == at or held + len(texts[to]) <= SCAN):
            held += len(texts[to])
            to += 1
        ends = np.cumsum([len(t) for t in texts[at:to]])
        buffer = np.frombuffer(b"".join(texts[at:to]), np.uint8)
        first, n, name = regions(buffer, np.r_[0, ends[:-1]], ends, length)
        words = words_at(buffer)
        one = np.unique(hashed(words, first, n + length - 1), return_index=True)[1]
        first, n, name = first[one], n[one], name[one]
        of, _, num, beside = sides(words, first, n, name, length)
        for kind, keys, size in ((False, words[name], n), (True, beside, num)):
            keys, place = np.unique(keys, return_inverse=True)
            yield kind, keys, np.bincount(place, size + length - 1, len(keys)).astype(np.int64)
        at = to


def frequent(docs: DataFrame, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Naming strings of (text) whose regions take over ``HOT`` bytes, and such keys of one with the bytes beside it."""
    share, long_, least = SAMPLE, F.octet_length("text") >= LONG, HOT
    looked = docs.where(long_ | (F.rand(1) < 1 / share)).select(
        F.when(long_, 1).otherwise(share).cast("long").alias("times"), "text")

    def run(batches):
        for batch in batches:
            for b in blocks(batch, 1, BLOCK):
                times, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
                for n in set(times):
                    for kind, keys, size in weights([x.encode() for x, m in zip(texts, times) if m == n and x], length):
                        yield pa.RecordBatch.from_arrays([
                            pa.array(np.full(len(keys), kind)), pa.array(keys.view(np.int64)), pa.array(size * n)],
                            names=WEIGHTS.names)

    heavy = looked.mapInArrow(run, WEIGHTS).groupBy("beside", "key").agg(F.sum("weight").alias("weight")).where(
        F.col("weight") > least).collect()
    return tuple(np.array(sorted(r.key for r in heavy if r.beside == k), np.int64).view(np.uint64) for k in (False, True))


def _packed(docs: DataFrame, buckets: int, length: int, hot: tuple[np.ndarray, np.ndarray] = COLD) -> DataFrame:
    def run(batches):
        for batch in batches:
            for b in blocks(batch, 2, BLOCK):
                rank, mark = b.column(0).to_numpy(), b.column(1).to_numpy()
                texts = [(t or "").encode() for t in b.column(2).to_pylist()]
                step = BLOCK - length + 1
                pieces = [(i, at, t[at:at + BLOCK]) for i, t in enumerate(texts) if len(t) >= length
                          for at in range(0, len(t) - length + 1, step)]
                group, held = [], 0
                for piece in [*pieces, None]:
                    if group and (piece is None or held + len(piece[2]) > BLOCK):
                        rows = list(block_rows(rank, mark, group, length, buckets, hot))
                        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()),
                                                          pa.array([r[1] for r in rows], pa.binary())],
                                                         names=REGIONS.names)
                        group, held = [], 0
                    if piece:
                        group.append(piece)
                        held += len(piece[2])

    return docs.select("rank", "mark", "text").mapInArrow(run, REGIONS)


def repeats(docs: DataFrame, length: int = 50) -> DataFrame:
    """(rank, mark, start, end): repeated passages of documents (rank, mark, text), not yet joined across buckets."""
    if length < 2 * WORD:
        raise ValueError(f"length: {2 * WORD} at least")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-int(size * SPREAD) // BUCKET))

    def run(group):
        rank, mark, start, end = bucket_hits(group.column("packed").to_pylist(), length)
        return pa.table([pa.array(rank, pa.int64()), pa.array(mark, pa.int32()), pa.array(start, pa.int64()),
                         pa.array(end, pa.int64())], names=HITS.names)

    hot = frequent(docs, length) if buckets > 1 else COLD
    dealt = _packed(docs, buckets, length, hot).repartition(buckets, "bucket")
    return dealt.groupBy("bucket").applyInArrow(run, HITS)


def removed(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_bytes, spans (the maximal removed runs of bytes), kept (the bytes that stay).

    Defined cases: a null text is empty; a text shorter than ``length`` loses
    nothing; a null id counts as larger than any other, and rows that share an
    id never remove bytes from each other; repeated rows each get the same
    result; texts of any length are read whole; an empty table gives an empty
    result; further columns are not read.
    """
    kind = docs.schema[id_col].dataType
    again = docs.groupBy(F.col(id_col).alias("id")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # Only rows that share an id need more than it to be told apart.
    mark = F.lit(0) if again.isEmpty() else F.hash(text_col)
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("rank"),
                       mark.alias("mark"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = repeats(base.select("rank", "mark", "text"), length)
    per_doc = found.groupBy("rank", "mark").agg(F.collect_list(F.struct("start", "end")).alias("hits"))
    schema = T.StructType([
        T.StructField(id_col, kind), T.StructField("n_bytes", T.LongType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()),
                                                         T.StructField("end", T.LongType())]))),
        T.StructField("kept", T.BinaryType())])

    def press(batches):
        for batch in batches:
            for b in blocks(batch, 3):
                small = zstandard.ZstdCompressor(level=3)
                packed = pa.array([small.compress(t.encode()) for t in b.column(3).to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([*b.columns[:3], packed], names=["id", "rank", "mark", "packed"])

    def run(batches):
        for batch in batches:
            for b in blocks(batch, 1, 2 << 20):
                sizes, spans, kept = [], [], []
                for packed, hits in zip(b.column(1).to_pylist(), b.column(2)):
                    raw = zstandard.decompress(packed)
                    sizes.append(len(raw))
                    if hits.values is None:
                        spans.append([])
                        kept.append(raw)
                        continue
                    start, end = merged(*(hits.values.field(i).to_numpy() for i in (0, 1)))
                    stay = np.r_[0, end], np.r_[start, len(raw)]
                    spans.append([{"start": i, "end": j} for i, j in zip(start.tolist(), end.tolist())])
                    kept.append(b"".join(raw[i:j] for i, j in zip(stay[0].tolist(), stay[1].tolist())))
                yield pa.RecordBatch.from_arrays([
                    b.column(0), pa.array(sizes, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    pa.array(kept, pa.binary())], names=schema.names)

    # The texts are shuffled once more, to their hits; packed, they are less than half.
    pressed = base.mapInArrow(press, T.StructType([*(base.schema[c] for c in ("id", "rank", "mark")),
                                                   T.StructField("packed", T.BinaryType())]))
    return pressed.join(per_doc, ["rank", "mark"], "left").select("id", "packed", "hits").mapInArrow(run, schema)
