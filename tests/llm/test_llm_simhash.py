import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from clicklens.llm.components import components
from clicklens.llm.simhash import fingerprint, links, masks, near_duplicates, representatives
from llm_tools import as_set, frame


def plain(text, k=3):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate(
        {i: " " for i in range(9, 14)}).split(" ") if w]
    runs = [words[i:i + k] for i in range(len(words) - k + 1)] if len(words) >= k else [words] * bool(words)
    h = [xxhash.xxh64_intdigest(" ".join(r).encode(), 42) for r in runs]
    x = sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))
    return x - (1 << 64) if x >> 63 else x


def groups(fps, radius):
    todo, out = set(fps), {}
    while todo:
        seen, near = set(), {min(todo)}
        while near:
            x = near.pop()
            seen.add(x)
            todo.discard(x)
            near |= {y for y in todo if ((x ^ y) & (2 ** 64 - 1)).bit_count() <= radius}
        out |= {x: min(seen) for x in seen}
    return out


def test_fingerprint_equals_the_plain_rule():
    rnd = random.Random(3)
    texts = [None, "", " \t\n", "One", "one TWO", "a b c", "É é", "a\x0bb\x0cc d", "x y z " * 30000]
    texts += [" ".join(rnd.choices("abcdef", k=rnd.randint(1, 50))) for _ in range(100)]
    assert [fingerprint(t) for t in texts] == [plain(t) for t in texts]


def test_masks_of_an_odd_radius():
    near, far = masks(3)
    assert (len(near), len(far)) == (65, 992)
    assert masks(2)[1] == []


def test_links_join_all_and_only_what_is_within_the_radius(spark):
    rnd = random.Random(9)
    for radius in (1, 2, 3):
        fps = set()
        for _ in range(12):
            x = rnd.getrandbits(64)
            for _ in range(15):
                fps.add(x)
                for b in rnd.sample(range(64), rnd.choice([1, 2, 3, 4])):
                    x ^= 1 << b
        fps = [x - (1 << 64) if x >> 63 else x for x in fps]
        edges = links(frame(spark, "fp long", [(x,) for x in fps]), radius)
        assert all(((r.u ^ r.v) & (2 ** 64 - 1)).bit_count() <= radius for r in edges.collect())
        found = {r.vertex: r.component for r in components(edges, "tests").collect()}
        want = groups(fps, radius)
        assert {x: found.get(x, x) for x in fps} == want


def test_long_chain_and_star(spark):
    chain = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1400)] + [(5, 5)]
    out = as_set(components(frame(spark, "u long, v long", chain), "tests"), "vertex", "component")
    assert out == {(i, 0) for i in range(301)} | {(i, 1000) for i in range(1000, 1400)}


def rows():
    rnd = random.Random(5)
    base = [" ".join(rnd.choices(["alpha", "beta", "gamma", "delta", "eps"], k=400)) for _ in range(4)]
    out = [(i, base[i % 4] + (f" tail{i}" if i % 3 else ""), "x", 1) for i in range(60)]
    return out + [(70, None, "x", 1), (71, "", "x", 1), (72, " \n", "x", 1), (73, "w", "y", 2), (73, "w", "y", 2),
                  (None, "alone one two", None, None)]


def test_components_equal_brute_force(spark):
    df = frame(spark, "doc_id long, text string, fp string, low int", rows())
    got = near_duplicates(df).collect()
    by_fp = groups({plain(r[1]) for r in rows()}, 3)
    least = {}
    for r in rows():
        if r[0] is not None:
            g = by_fp[plain(r[1])]
            least[g] = min(r[0], least.get(g, r[0]))
    want = sorted((r[0] or -1, format(plain(r[1]) & (2 ** 64 - 1), "016x"), least.get(by_fp[plain(r[1])])) for r in rows())
    assert sorted((r.doc_id or -1, r.fingerprint, r.component_id) for r in got) == want


def test_representatives_leave_one_of_each_component(spark):
    df = frame(spark, "doc_id long, text string, fp string, low int", rows())
    stay = representatives(df)
    assert stay.columns == df.columns
    by_fp = groups({plain(r[1]) for r in rows()}, 3)
    assert stay.count() == len(set(by_fp.values()))
    assert np.all(sorted(r.doc_id for r in stay.collect() if r.doc_id == 73) == [73])


def test_rows_that_share_an_id_or_have_none_are_judged_apart(spark):
    rnd = random.Random(6)
    text = [" ".join(rnd.choices(["alpha", "beta", "gamma", "delta", "eps"], k=400)) for _ in range(8)]
    near = text[0] + " tail"
    assert len(set(groups({plain(t) for t in [*text, near, text[5] + " tail"]}, 3).values())) == len(text)
    alone = [(None, text[1]), (None, text[2]), (5, text[3]), (5, text[4])]
    # A row without an id and one of id 5 are near document 1; a pair of null ids is near, another repeated.
    linked = [(1, text[0]), (None, near), (5, near)]
    pair = [(None, text[5]), (None, text[5] + " tail")]
    again = [(None, text[6])] * 3 + [(7, text[7])] * 2
    docs = frame(spark, "doc_id long, text string", alone + linked + pair + again)
    got = [tuple(r) for r in representatives(docs).collect()]
    one = [r for r in got if r in pair]
    assert len(one) == 1
    want = alone + linked[:1] + [(None, text[6]), (7, text[7])]
    assert sorted(map(str, got)) == sorted(map(str, want + one))


def test_empty_table(spark):
    df = frame(spark, "doc_id long, text string", [])
    assert near_duplicates(df).count() == 0 and representatives(df).count() == 0


def test_clashing_column_names_and_the_spread_of_fingerprints(spark):
    df = frame(spark, "doc_id long, text string, _id long, _mark string, own_0 string, fp int", [
        (1, "one two three four", 1, "a", "b", 2), (2, "one two three four", 3, "c", "d", 4)])
    out = representatives(df)
    assert out.columns == df.columns and [tuple(r) for r in out.collect()] == [(1, "one two three four", 1, "a", "b", 2)]
    distinct = df.select(F.xxhash64("text").alias("fp")).groupBy("fp").agg(F.count(F.lit(1))).select("fp")
    plan = links(distinct)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan
