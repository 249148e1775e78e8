import random

import numpy as np
import pytest

from clicklens.llm import suffix_dedup
from clicklens.llm.suffix_dedup import BlindTrie, block_rows, bucket_hits, merged, removed, sort_suffixes
from llm_tools import frame


def brute(docs, length):
    """Bytes to remove of each document: the rule as it is stated."""
    first = {}
    for i, t in docs:
        for s in range(len(t) - length + 1):
            first[t[s:s + length]] = min(first.get(t[s:s + length], i), i)
    out = []
    for i, t in docs:
        gone = np.zeros(len(t), bool)
        for s in range(len(t) - length + 1):
            if first[t[s:s + length]] < i:
                gone[s:s + length] = True
        out.append(gone)
    return out


def made(rnd, length):
    alphabet = rnd.choice(["ab", "abcd", "abcdefgh é"])
    passages = ["".join(rnd.choices(alphabet, k=rnd.randint(10, 150))) for _ in range(4)] + ["a" * rnd.randint(1, 200)]
    return [(i, "".join(rnd.choice([rnd.choice(passages), "".join(rnd.choices(alphabet, k=rnd.randint(0, 60)))])
                        for _ in range(rnd.randint(0, 5)))) for i in rnd.sample(range(1000), rnd.randint(2, 25))]


def test_blocks_and_buckets_equal_brute_force():
    rnd = random.Random(5)
    for _ in range(40):
        length = rnd.choice([16, 24, 50])
        docs = [(i, t.encode()) for i, t in made(rnd, length)]
        buckets, per_block, piece = rnd.choice([1, 3, 7]), rnd.choice([1, 4, 100]), rnd.choice([80, 200])
        rows = {}
        for k in range(0, len(docs), per_block):
            part = docs[k:k + per_block]
            pieces = [(n, at, t[at:at + piece]) for n, (_, t) in enumerate(part) if len(t) >= length
                      for at in range(0, len(t) - length + 1, piece - length + 1)]
            for b, packed in block_rows(np.array([d[0] for d in part]), np.zeros(len(part), np.int32), pieces, length,
                                        buckets):
                rows.setdefault(b, []).append(packed)
        got = {i: np.zeros(len(t), bool) for i, t in docs}
        for packed in rows.values():
            for i, _, s, e in zip(*bucket_hits(packed, length)):
                got[int(i)][s:e] = True
        assert all((got[d[0]] == gone).all() for d, gone in zip(docs, brute(docs, length)))


def packed_rows(docs, length, buckets, per_block, hot):
    rows = {}
    for k in range(0, len(docs), per_block):
        part = docs[k:k + per_block]
        pieces = [(n, 0, t) for n, (_, t) in enumerate(part) if len(t) >= length]
        for b, packed in block_rows(np.array([d[0] for d in part]), np.zeros(len(part), np.int32), pieces, length,
                                    buckets, hot):
            rows.setdefault(b, []).append(packed)
    return rows


def keys_of(docs, length):
    found = [list(suffix_dedup.weights([t], length)) for _, t in docs]
    return [np.unique(np.concatenate([x[1] for f in found for x in f if x[0] == k] or [suffix_dedup.COLD[0]]))
            for k in (False, True)]


def test_frequent_names_are_dealt_finer_with_the_same_result():
    rnd = random.Random(12)
    for _ in range(40):
        length = rnd.choice([16, 24, 50, 51])
        docs = [(i, t.encode()) for i, t in made(rnd, length)]
        names, beside = keys_of(docs, length)
        hot = (names[::rnd.choice([1, 2])], beside[::rnd.choice([1, 2, 10 ** 6])])
        got = {i: np.zeros(len(t), bool) for i, t in docs}
        for packed in packed_rows(docs, length, 7, rnd.choice([1, 4, 100]), hot).values():
            for i, _, s, e in zip(*bucket_hits(packed, length)):
                got[int(i)][s:e] = True
        assert all((got[d[0]] == gone).all() for d, gone in zip(docs, brute(docs, length)))


def test_a_frequent_name_is_not_one_bucket(spark, monkeypatch):
    rnd = random.Random(4)
    order = lambda w: int(np.frombuffer(w, "<u8")[0]) * int(suffix_dedup.ORDER) % 2 ** 64
    mix = lambda h: (h ^ h >> 31) * int(suffix_dedup.MIX) % 2 ** 64
    name = min((f"t{i:06} ".encode() for i in range(20000)), key=lambda w: mix(order(w)))
    word = lambda: "".join(rnd.choices("abcdefghij", k=45)).encode()
    docs = [(i, b"".join(word() + name for _ in range(40)) + word()) for i in range(50)]
    for limit in ("SAMPLE", 1), ("HOT", 20000):
        monkeypatch.setattr(suffix_dedup, *limit)
    hot = suffix_dedup.frequent(frame(spark, "text string", [(t.decode(),) for _, t in docs]), 50)
    assert int(np.frombuffer(name, "<u8")[0]) in hot[0].tolist() and len(hot[1]) == 0
    most = [max(sum(len(p) for p in x) for x in packed_rows(docs, 50, 16, 10, h).values())
            for h in (suffix_dedup.COLD, hot)]
    assert most[0] > 3 * most[1]


def test_sorting_equals_sorted_and_groups_equal_suffixes():
    rnd = random.Random(8)
    text = "".join(rnd.choice(["x" * 45 + "abc", "x" * 45 + "abd", "yz", "q" * 60]) for _ in range(60)).encode()
    buffer = np.frombuffer(text, np.uint8)
    pos = np.arange(len(text) - 50 + 1)
    order, group = sort_suffixes(buffer, pos, 50)
    cut = [text[p:p + 50] for p in pos[order].tolist()]
    assert cut == sorted(cut)
    assert [a == b for a, b in zip(group[1:], group)] == [a == b for a, b in zip(cut[1:], cut)]


def test_blind_trie_orders_and_finds_equal_strings():
    rnd = random.Random(1)
    strings = [bytes(rnd.choices(b"ab", k=10)) for _ in range(500)]
    trie = BlindTrie()
    leaves = [trie.insert(s) for s in strings]
    assert [trie.leaves[i] for i in trie.order()] == sorted(set(strings))
    assert all(trie.leaves[i] == s for i, s in zip(leaves, strings))


def test_merged_intervals():
    s, e = merged(np.array([5, 0, 10, 30]), np.array([10, 3, 12, 31]))
    assert (s.tolist(), e.tolist()) == ([0, 5, 30], [3, 12, 31])


@pytest.mark.parametrize("block", [300, 8 << 20])
def test_rows_equal_brute_force(spark, monkeypatch, block):
    rnd = random.Random(3)
    rows = made(rnd, 50) + [(2000, None), (2001, ""), (2002, "short"), (2003, "z" * 3000), (2004, "z" * 70)]
    rows += [(2005, rows[0][1]), (2005, rows[0][1]), (2005, "another text of the same id " * 5), (None, rows[1][1])]
    df = frame(spark, "doc_id long, text string, rank string, kept int", [(*r, "x", 1) for r in rows]).repartition(3)
    monkeypatch.setattr(suffix_dedup, "BLOCK", block)
    got = sorted((r.doc_id or -1, r.n_bytes, bytes(r.kept), sum(s.end - s.start for s in r.spans), len(r.spans))
                 for r in removed(df, 50).collect())
    docs = [(10 ** 9 if i is None else i, (t or "").encode()) for i, t in rows]
    want = []
    for (i, _), (_, raw), gone in zip(rows, docs, brute(docs, 50)):
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        want.append((i or -1, len(raw), bytes(b for b, g in zip(raw, gone) if not g), int(gone.sum()), runs))
    assert got == sorted(want)


def test_empty_table_and_short_length(spark):
    df = frame(spark, "doc_id long, text string", [])
    assert removed(df).count() == 0
    with pytest.raises(ValueError):
        removed(df, 8)
