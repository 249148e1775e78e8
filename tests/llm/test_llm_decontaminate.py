import random
import re

import pytest

from clicklens.llm.decontaminate import contamination, without_contaminated, without_spans
from llm_tools import as_set, frame

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, bench, n):
    out = set()
    for d, t in docs:
        w, inside, items = words(t), set(), set()
        for i, b in bench:
            bw = words(b)
            k = min(n, len(bw))
            windows = {tuple(bw[j:j + k]) for j in range(len(bw) - k + 1)} if k else set()
            for j in range(len(w) - k + 1 if k else 0):
                if tuple(w[j:j + k]) in windows:
                    inside.update(range(j, j + k))
                    items.add(str(i))
        out.add((d, len(w), len(inside), tuple(sorted(items)), bool(inside) and 20 * len(inside) >= len(w)))
    return out


def made(seed=2):
    rnd = random.Random(seed)
    vocabulary = ["the", "of", "Öl", "x1", "a", "b", "c", "d"]
    bench = [(i, " ".join(rnd.choices(vocabulary, k=rnd.choice([1, 2, 4, 6, 9])))) for i in range(12)]
    bench += [(50, None), (51, ""), (52, "..."), (53, bench[0][1])]
    docs = [(i, " ,;\n".join(rnd.choices(vocabulary, k=rnd.choice([0, 1, 3, 10, 60])))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "!!!"), (103, bench[5][1].upper()), (104, "word " * 3000 + bench[4][1])]
    return docs, bench


@pytest.mark.parametrize("limit", [16 << 20, 0])
def test_equals_brute_force_broadcast_or_shuffled(spark, limit):
    docs, bench = made()
    out = contamination(frame(spark, "doc_id long, text string", docs),
                        frame(spark, "item_id long, text string", bench), n=5, max_bytes=limit)
    got = {(r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in out.collect()}
    assert got == brute(docs, bench, 5)


def test_removal_of_documents_and_spans(spark):
    docs, bench = made()
    d = frame(spark, "doc_id long, text string, w string, size int", [(*x, "c", 1) for x in docs])
    b = frame(spark, "item_id long, text string", bench)
    bad = {r[0] for r in brute(docs, bench, 5) if r[4]}
    left = without_contaminated(d, b, n=5)
    assert left.columns == d.columns
    assert {r.doc_id for r in left.collect()} == {x[0] for x in docs} - bad
    per = {r[0]: r for r in brute(docs, bench, 5)}
    for r in without_spans(d, b, n=5).collect():
        assert len(r.clean_words) == per[r.doc_id][1] - per[r.doc_id][2]


def test_repeated_rows_null_ids_and_rows_that_share_an_id(spark):
    bench = frame(spark, "item_id long, text string", [(1, "one two three")])
    rows = [(1, "one two three"), (1, "one two three"), (1, "clean"), (None, "one two three four"), (None, None)]
    out = contamination(frame(spark, "doc_id long, text string", rows), bench, n=3).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.n_hit) for r in out) == [(0, 0, 0), (0, 4, 3), (1, 1, 0), (1, 3, 3), (1, 3, 3)]


def test_empty_tables(spark):
    docs, bench = made()
    none_d = frame(spark, "doc_id long, text string", [])
    none_b = frame(spark, "item_id long, text string", [])
    assert contamination(none_d, frame(spark, "item_id long, text string", bench)).count() == 0
    out = contamination(frame(spark, "doc_id long, text string", docs), none_b)
    assert as_set(out, "n_hit", "contaminated") == {(0, False)}


def test_clashing_column_names_stay(spark):
    docs, bench = made()
    names = ["_id", "_mark", "own_0", "own_id", "_own_id", "hit", "gone", "w", "at"]
    d = frame(spark, "doc_id long, text string, " + ", ".join(f"{n} long" for n in names),
              [(*x, *range(len(names))) for x in docs])
    b = frame(spark, "item_id long, text string", bench)
    bad = {r[0] for r in brute(docs, bench, 5) if r[4]}
    left = without_contaminated(d, b, n=5)
    assert left.columns == d.columns
    assert {tuple(r)[0::2] for r in left.collect()} == {(x[0], 0, 2, 4, 6, 8)[:1] + tuple(range(0, 9, 2)) for x in docs
                                                         if x[0] not in bad}
    assert without_spans(d, b, n=5).columns == [*d.columns, "clean_words"]


def test_a_long_text_takes_time_in_proportion_and_one_scan_finds_all_sizes(spark):
    bench = frame(spark, "item_id long, text string", [(1, "x1 x2 x3 x4 x5"), (2, "y1 y2"), (3, "z")])
    words_ = [f"w{i % 997}" for i in range(300_000)]
    words_[200_000:200_005] = ["x1", "x2", "x3", "x4", "x5"]
    docs = frame(spark, "doc_id long, text string", [(1, " ".join(words_)), (2, "y1 y2 and z")])
    out = contamination(docs, bench, n=5)
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"], r.contaminated) for r in out.collect()}
    assert got == {1: (300_000, 5, ["1"], False), 2: (4, 3, ["2", "3"], True)}
