"""Ranked search against scoring every document for every item."""

import math
import random
import re

import numpy as np
import pytest

from clicklens.llm import lexical_search as L
from clicklens.llm.lexical_search import search
from llm_tools import frame

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, top):
    held = [(d, terms(t)) for d, t in docs]
    n_docs, n_terms = sum(bool(w) for _, w in held), sum(len(w) for _, w in held)
    df = {}
    for _, w in held:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms(t))
    out = {}
    for i, want in wanted.items():
        scored = []
        for d, w in held:
            m = 100 - 50 + (50 * len(w) * n_docs) // n_terms if n_terms else 0
            score = 0
            for t in want & set(w):
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += weight * ((1_000_000_000 * w.count(t)) // (1000 * w.count(t) + 20 * m))
            if score > 0:
                scored.append((-score, d is not None, d))
        for rank, (score, _, d) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:top], 1):
            out[i, rank] = (d, -score)
    return out


def got(df):
    return {(r.item_id, r["rank"]): (r.doc_id, r.score) for r in df.collect()}


def made(seed=3):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Öl", "ÖL", "東京", "x1", "É"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ,.\n"[i % 4].join(rnd.choices(words, weights, k=rnd.choice([0, 1, 3, 20, 200, 900])))) for i in range(300)]
    docs += [(1000, None), (1001, ""), (1002, "..."), (5, docs[7][1]), (5, docs[7][1]), (None, docs[9][1]), (3000, docs[9][1])]
    items = [(i, " ".join(rnd.choices(words, k=rnd.choice([1, 2, 9, 30])))) for i in range(25)]
    items += [(50, None), (51, "!"), (52, "nowhere"), (3, "W1 w2"), (None, "w4 w5")]
    return docs, items


@pytest.mark.parametrize("pairs_at_once", [100_000, 40])
def test_equals_scoring_all(spark, pairs_at_once):
    docs, items = made()
    d = frame(spark, "doc_id long, text string, key long, number int, rank int, score long", [(*x, 1, 2, 3, 4) for x in docs])
    i = frame(spark, "item_id long, text string, item string, term int", [(*x, "a", 1) for x in items])
    out = search(d.repartition(3), i, top=7, pairs_at_once=pairs_at_once)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    assert got(out) == brute(docs, items, 7)


def test_bounds_are_never_below_the_score():
    docs, items = made(8)
    texts = [(t or "").encode() for _, t in docs]
    rows = [(i, w) for i, (_, t) in enumerate(items) for w in sorted(set(L.terms((t or "").encode())))]
    q = L.Items(rows, 5)
    lengths, entries = L._entries(texts)
    df = {}
    for t in texts:
        for w in q.terms.keys() & set(L.terms(t)):
            df[w] = df.get(w, 0) + 1
    q.weigh(df, sum(map(bool, lengths)), sum(lengths))
    held = [(i, n, e) for i, (n, e) in enumerate(zip(lengths, entries)) if n]
    for bits in (256, 1 << 15):
        bits_, keys, ns, slices = L._block(bits, held)
        assert bits_ == bits
        for at, bound in q.bounds(bits, np.array(ns), slices):
            for j in range(bound.shape[1]):
                exact = q.exact(texts[keys[at + j]], range(len(q.sets)))
                assert (bound[:, j] >= exact).all()


def test_a_long_text_and_equal_scores(spark):
    docs = [(9, "alpha " * 200_000 + "beta"), (4, "gamma delta"), (2, "gamma delta"), (3, "gamma")]
    items = [(1, "beta"), (2, "gamma delta")]
    out = search(frame(spark, "doc_id long, text string", docs), frame(spark, "item_id long, text string", items), top=2)
    assert got(out) == brute(docs, items, 2)
    assert got(out)[2, 1][0] == 2


def test_empty_tables(spark):
    d, i = frame(spark, "doc_id long, text string", []), frame(spark, "item_id long, text string", [])
    some_d, some_i = frame(spark, "doc_id long, text string", [(1, "a")]), frame(spark, "item_id long, text string", [(1, "a")])
    for x, y in ((d, i), (d, some_i), (some_d, i), (frame(spark, "doc_id long, text string", [(1, None)]), some_i)):
        assert search(x, y).collect() == []
