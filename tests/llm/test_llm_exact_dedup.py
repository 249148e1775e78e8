import hashlib
import random

import pytest

from clicklens.llm.exact_dedup import deduplicated, exact_groups
from llm_tools import as_set, frame


def fold(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def brute(rows, keep):
    groups = {}
    for i, t in rows:
        groups.setdefault(fold(t), []).append(i)
    pick = max if keep == "largest" else min
    return {(i, pick(groups[fold(t)]), len(groups[fold(t)]), i == pick(groups[fold(t)]),
             hashlib.sha256(fold(t).encode()).hexdigest()) for i, t in rows}


@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize("fan_in", [2, 16])
def test_equals_brute_force(spark, keep, fan_in):
    rnd = random.Random(1)
    texts = ["", None, "A", "a", "É", "é", "same text", "Same TEXT", "x" * 200_000]
    rows = [(i, rnd.choice(texts) if rnd.random() < .7 else f"own {i}") for i in range(300)]
    df = frame(spark, "doc_id long, text string", rows).repartition(7)
    got = as_set(exact_groups(df, keep=keep, fan_in=fan_in),
                 "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert got == brute(rows, keep)


def test_hot_group_over_many_partitions_leaves_one(spark):
    df = spark.range(5000).selectExpr("id as doc_id", "if(id % 3 = 0, 'Hot', concat('t', id)) as text").repartition(40)
    out = exact_groups(df, keep="largest", fan_in=4)
    assert out.where("group_size = 1667 and keep_id = 4998").count() == 1667
    assert out.where("kept").count() == 5000 - 1667 + 1


def test_null_ids_and_repeated_rows(spark):
    rows = [(None, "a"), (2, "A"), (2, "a"), (None, "b"), (None, "b"), (7, "c")]
    df = frame(spark, "doc_id long, text string", rows)
    out = exact_groups(df, keep="largest").collect()
    assert sum(r.kept for r in out if r.keep_id == 2) == 1
    assert sum(r.kept for r in out if r.keep_id is None) == 1
    assert {r.group_size for r in out if r.keep_id == 2} == {3}


def test_deduplicated_keeps_columns_and_one_row_each(spark):
    rows = [(1, "a", "x", 9), (2, "A", "y", 8), (2, "A", "y", 8), (3, None, "z", 7), (4, "", "z", 6), (2, "q", "w", 5)]
    df = frame(spark, "doc_id long, text string, best string, run int", rows)
    out = deduplicated(df, keep="largest")
    assert out.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in out.collect()) == [(2, "A"), (2, "q"), (4, "")]
    once = frame(spark, "doc_id long, text string", [(1, "a"), (2, "b"), (3, "B")])
    assert as_set(deduplicated(once), "doc_id") == {(1,), (2,)}


def test_empty_table_and_wrong_arguments(spark):
    df = frame(spark, "doc_id long, text string", [])
    assert exact_groups(df).count() == 0
    assert deduplicated(df).count() == 0
    with pytest.raises(ValueError):
        exact_groups(df, keep="middle")
    with pytest.raises(ValueError):
        exact_groups(df, fan_in=1)


def test_clashing_column_names_stay(spark):
    df = frame(spark, "doc_id long, text string, _id long, _own_id long, own_0 string, keep_id string, kept int, id int", [
        (1, "A", 1, 2, "x", "y", 3, 4), (2, "a", 5, 6, "z", "w", 7, 8), (2, "a", 5, 6, "z", "w", 7, 8)])
    out = deduplicated(df, keep="largest")
    assert out.columns == df.columns and [tuple(r) for r in out.collect()] == [(2, "a", 5, 6, "z", "w", 7, 8)]
