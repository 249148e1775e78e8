import hashlib

from pyspark.sql import functions as F

import corpus_pipeline as P
from llm_tools import frame
from test_llm_decontaminate import brute as contaminated
from test_llm_exact_dedup import fold
from test_llm_simhash import groups, plain

SF = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark):
    """All but language identification are held against plain rules, each on its own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert [n for n, _ in P.STAGES] == ["language_id", "exact_dedup", "simhash_near_dedup", "decontamination", "bpe"]
    extra = frame(spark, docs.schema, [(10_001, None, "en", "s", 0), (10_002, "12 34", "en", "s", 5),
                                       (10_003, docs.first().text, None, None, None)])
    now, rows = docs.unionByName(extra), None
    for name, stage in P.STAGES:
        now = P.written(stage(spark, now, SF), "tests", name)
        before, rows = rows, [(r.doc_id, r.text) for r in now.collect()] if name != "bpe" else now.collect()
        if name != "bpe":
            assert now.columns == P.COLUMNS
        if name == "language_id":
            assert sorted(r[0] for r in rows) == sorted(r.doc_id for r in docs.select("doc_id").collect()) + [10_003]
        elif name == "exact_dedup":
            best = {}
            for i, t in before:
                best[fold(t)] = max(i, best.get(fold(t), i))
            assert sorted(r[0] for r in rows) == sorted(best.values())
        elif name == "simhash_near_dedup":
            part = groups({plain(t) for _, t in before}, 3)
            least = {}
            for i, t in before:
                least[part[plain(t)]] = min(i, least.get(part[plain(t)], i))
            assert sorted(r[0] for r in rows) == sorted(least.values())
        elif name == "decontamination":
            clean = [r[0] for r in contaminated(before, bench, 13) if not r[4]]
            assert sorted(r[0] for r in rows) == sorted(clean)
        else:
            assert sorted(r.doc_id for r in rows) == sorted(b[0] for b in before)
            assert all(r.round_trip and r.n_tokens == len(r.ids) for r in rows)


def test_empty_documents(spark):
    docs = frame(spark, "doc_id long, text string, lang string, source string, n_chars long", [])
    for _, stage in P.STAGES:
        docs = P.written(stage(spark, docs, SF), "tests", "empty")
        assert docs.count() == 0


def test_digest_columns_of_the_queries(spark):
    import __spark_entry__ as E
    q = E.queries()
    assert {f"op{n}" for n in range(1, 11)} == {k.split("_")[0] for k in q if k.startswith("op")}
    assert "pipeline" in q
    r = q["op10_exact_dedup"](spark, SF).where("kept").first()
    text = spark.read.parquet(f"{SF}/documents.parquet").where(F.col("doc_id") == r.doc_id).first().text
    assert r.text_sha256 == hashlib.sha256(fold(text).encode()).hexdigest()
