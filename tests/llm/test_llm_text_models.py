import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from clicklens.llm import langid, pii_crf, queries, toxicity
from llm_tools import frame

SF = "/root/testdata/sf0.1"


def test_gradients_of_the_recurrent_network():
    net = langid.Network(["a", "b", "c"], hidden=4, seed=1)
    for p in net.parameters():
        p *= 2
    rng = np.random.default_rng(0)
    x, y = rng.integers(97, 100, (5, 6)), rng.integers(0, 3, 5)

    def loss():
        p = net.positions(x)[0]
        return -np.log(p[:, np.arange(5), y].astype(float)).mean()

    for p, g in zip(net.parameters(), net.gradients(x, y)):
        i = np.unravel_index(np.abs(g).argmax(), g.shape)
        old = p[i]
        p[i] = old + 1e-2
        up = loss()
        p[i] = old - 1e-2
        down = loss()
        p[i] = old
        assert abs((up - down) / 2e-2 - g[i]) < 2e-3 + 0.05 * abs(g[i])


def test_language_of_held_out_documents(spark):
    out = queries.op2_language_id(spark, SF).where("held_out")
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    got = out.join(docs, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert got[1] > 3000 and got[0] > 0.98


def test_language_cases(spark):
    words = {"xx": "aaab aab ab", "yy": "zzzy zzy zy"}
    rows = [(i, words[k] * (1 + i % 3), k, 0.5) for i, k in enumerate(["xx", "yy"] * 30)]
    df = frame(spark, "doc_id long, text string, lang string, score double", rows)
    net = langid.learn(df)
    seen = frame(spark, "doc_id long, text string, lang_pred string", [
        (1, None, "q"), (2, "", "q"), (3, "12 !? 3.4", "q"), (4, "zzy zzzy", "q"), (4, "zzy zzzy", "q"), (None, "aab ab", "q"),
        (6, "b" + "a" * 300_000, "q")])
    out = langid.predictions(seen, net).collect()
    assert out[0].asDict().keys() == {"doc_id", "lang_pred", "score"}
    got = sorted((r.doc_id or 0, r.lang_pred) for r in out)
    assert got == [(0, "xx"), (1, "und"), (2, "und"), (3, "und"), (4, "yy"), (4, "yy"), (6, "xx")]
    assert all(0 <= r.score <= 1 for r in out)
    assert langid.predictions(seen.limit(0), net).count() == 0
    none = langid.learn(df.where("false"))
    assert {r.lang_pred for r in langid.predictions(seen, none).collect()} == {"und"}


def test_toxicity_of_held_out_documents(spark):
    out = queries.op8_toxicity(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = out.where("held_out").join(labels, "doc_id").select("toxic", "predicted", "score").collect()
    toxic = [r for r in rows if r.toxic == 1]
    clean = [r for r in rows if r.toxic == 0]
    assert len(toxic) > 50 and sum(r.predicted for r in toxic) >= 0.9 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
               for r in out.select("doc_id", "held_out").head(200))


@pytest.fixture(scope="module")
def lexicon(spark):
    rows = [(i, f"you are such an idiot number{i} today" if i % 4 == 0 else f"you see idiomatic number{i} code", int(i % 4 == 0))
            for i in range(200)]
    docs = frame(spark, "doc_id long, text string, toxic int", rows)
    return toxicity.learn(docs, docs.select("doc_id", "toxic"), exceptions=("Idiot-proof",))


@pytest.mark.parametrize("text", ["IDIOT!", "an 1d10t", "аn іdiоt", "i­diot", "x " * 20 + "idiots",
                                  "ｉｄｉｏｔ", "𝐢𝐝𝐢𝐨𝐭", "ídïôt", "ıđiøt", "ⓘⓓⓘⓞⓣ", "🅸🅳🅸🅾🆃", "an i.d.i.o.t here", "i-d-i-o-t",
                                  "i\u0336d\u0336i\u0336o\u0336t", "you are such an ідіот".replace("д", "d")])
def test_folding_finds_disguised_words(lexicon, text):
    assert lexicon.score(text) >= 0.5


@pytest.mark.parametrize("text", ["", None, "12345 10 01", "idiomatic code", "an idiot proof design", "clean " * 50_000])
def test_clean_texts_and_exceptions(lexicon, text):
    assert lexicon.score(text) < 0.5


def plain_matches(lexicon, words):
    """Weights by trying every entry and every exception at every word."""
    text = " ".join(words) + " "
    starts = [sum(len(w) + 1 for w in words[:i]) for i in range(len(words))]
    inside = {s for e in lexicon.exceptions for at in starts if text.startswith(e, at)
              for s in starts if at <= s < at + len(e)}
    return [max(w for e, w in lexicon.entries.items() if text.startswith(e, s)) for s in starts
            if s not in inside and any(text.startswith(e, s) for e in lexicon.entries)]


def test_automaton_equals_plain_matching():
    rng = np.random.default_rng(5)
    draw = lambda n: ["".join(rng.choice(list("ab"), rng.integers(1, 5))) for _ in range(n)]
    for _ in range(300):
        entries = {e: float(rng.integers(1, 9)) for e in draw(4)}
        exceptions = [*(e for e in draw(2) if e not in entries), " ".join(draw(2)) + " "]
        lexicon, words = toxicity.Lexicon(entries, exceptions, [0.0] * 4), draw(30)
        assert sorted(lexicon.matched(words)) == sorted(plain_matches(lexicon, words)), (entries, exceptions, words)


def test_texts_in_other_scripts_stay():
    for t in ("московские новости и погода", "η ελληνική γλώσσα είναι αρχαία", "շատ լավ", "東京 タワー", "한국어 문장"):
        assert not any(c.isascii() for w in toxicity.folded(t) for c in w), toxicity.folded(t)
    assert toxicity.folded("a соре of words") == ["a", "cope", "of", "words"]
    assert toxicity.folded("e.g. end. A b. 3.4 x") == ["e", "g", "end", "a", "b", "3", "4", "x"]


def test_phrases_of_clean_documents_are_exceptions(spark):
    texts = [f"you are such an idiot number{i}" for i in range(60)]
    texts += [f"an idiot proof design number{i}" for i in range(20)] + [f"the useful idiot of history number{i}" for i in range(20)]
    texts += [f"plain text number{i}" for i in range(100)]
    docs = frame(spark, "doc_id long, text string, toxic int", [(i, t, int(i < 60)) for i, t in enumerate(texts)])
    learned = toxicity.learn(docs, docs.select("doc_id", "toxic"))
    assert any(e.startswith("idiot proof") for e in learned.exceptions)
    assert learned.matched("an idiot proof cover".split()) == learned.matched("one useful idiot".split()) == []
    assert len(learned.matched("idiot proofs of one idiot".split())) == 2
    assert learned.score("an idiot proof cover") < learned.score("one idiot")


def test_toxicity_cases(spark, lexicon):
    df = frame(spark, "doc_id long, text string, score string", [(1, None, "a"), (1, None, "a"), (None, "idiot", "b")])
    out = toxicity.scores(df, lexicon)
    assert sorted(r.score >= 0.5 for r in out.collect()) == [False, False, True]
    assert toxicity.scores(df.limit(0), lexicon).count() == 0
    empty = toxicity.learn(df.limit(0), frame(spark, "doc_id long, toxic int", []))
    assert {r.score for r in toxicity.scores(df, empty).collect()} == {0.5}


KINDS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
         ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def plain_spans(t):
    def holds(kind, m):
        d = re.sub("[^0-9]", "", m)
        return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.split(".")),
                "card": 12 <= len(d) <= 19 and pii_crf.luhn(d), "phone": 9 <= len(d) <= 15}[kind]
    return sorted((m.start(), i, m.end()) for i, (k, r) in enumerate(KINDS) for m in re.finditer(r, t) if holds(k, m[0]))


def test_base_spans_equal_the_plain_patterns():
    rng = np.random.default_rng(3)
    for alphabet in ("0123456789.", "ab@.-+ 1", "+1 ()-.2", "0 -123456789", "a@b.c+1 2\n"):
        for _ in range(3000):
            t = "".join(rng.choice(list(alphabet), rng.integers(0, 40)))
            assert pii_crf.base_spans(t) == plain_spans(t), t


def test_very_long_runs_take_linear_time():
    for t in ("1" * 300_000, "1." * 150_000, "a" * 300_000 + "@", "+1" + " " * 300_000, "1 " * 150_000):
        assert pii_crf.base_spans(t) in ([], plain_spans(t) if t.startswith("1.") else [])
        assert pii_crf.added_spans([t], [[]], pii_crf.train([], [])) == [[]]


def test_viterbi_equals_all_paths():
    rng = np.random.default_rng(1)
    field = pii_crf.Field(["f"])
    field.step, field.start = rng.normal(size=field.step.shape), rng.normal(size=field.start.shape)
    k = len(pii_crf.LABELS)
    lengths = np.array([3, 1, 2, 3])
    starts = np.array([0, 4, 6, 9])                  # a row between two chains belongs to none
    x = rng.normal(size=(12, k))
    step, start = field.transitions()
    label = field.decode(x, starts, lengths)
    for s, n in zip(starts, lengths):
        score = {}
        for path in itertools.product(range(k), repeat=int(n)):
            score[path] = start[path[0]] + x[s, path[0]] + sum(
                step[path[i - 1], path[i]] + x[s + i, path[i]] for i in range(1, n))
        assert tuple(label[s:s + n]) == max(score, key=score.get)


@pytest.fixture(scope="module")
def field(spark):
    return pii_crf.learn(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"))


def test_scores_by_type_are_the_sums_of_the_features(field):
    lines = [["call", "me", "at", "0171", "2345678."], ["Ünder", "4.0"], ["x"]]
    tokens = [t for line in lines for t in [*line, pii_crf.BREAK]]
    ids = field.types().ids(tokens)
    one = np.concatenate([[0, 0], ids, [0, 0]])
    before, after = one[1:-3], one[3:-1]
    x = field.types().scores(ids, before, after, np.where(before == 0, 0, one[:-4]), np.where(after == 0, 0, one[4:]))
    want = np.concatenate([np.concatenate([field.emissions(field.rows(pii_crf.features(line))), np.zeros((1, x.shape[1]))])
                           for line in lines])
    inside = ids != 0
    assert np.allclose(x[inside], want[inside], atol=1e-3)


def test_forms_without_a_pattern_are_added(field):
    """Held-out sentences: other numbers, names and words. The field finds 9 of 10 spans that no pattern has."""
    table = pii_crf.labelled_table(1500, seed=99)
    texts = [" ".join(tokens) for tokens, _ in table]
    base = [pii_crf.base_spans(t) for t in texts]
    found = pii_crf.added_spans(texts, base, field)
    hit, whole, wrong, per = 0, 0, 0, {}
    for text, (tokens, gold), b, f in zip(texts, table, base, found):
        places = [m.span() for m in re.finditer(r"\S+", text)]
        want = [[s, (y - 1) // 2] for (s, _), y in zip(places, gold) if y % 2]
        want = [w for w in want if not any(x[0] <= w[0] < x[2] for x in b)]
        for w in want:
            good = any(x[0] == w[0] and x[1] == w[1] for x in f)
            whole, hit = whole + 1, hit + good
            seen = per.setdefault(pii_crf.KINDS[w[1]], [0, 0])
            seen[0] += good
            seen[1] += 1
        wrong += sum(not any(x[0] == w[0] for w in want) for x in f)
    assert whole > 500 and hit >= 0.9 * whole and wrong <= 0.05 * whole, (hit, whole, wrong, per)


def test_documents_without_personal_data_are_left_alone(spark, field):
    texts = [r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").where("doc_id % 5 = 2").collect()]
    found = pii_crf.added_spans(texts, [pii_crf.base_spans(t) for t in texts], field)
    assert sum(map(bool, found)) <= 0.01 * len(texts), [
        [t[s:e] for s, _, e in f] for t, f in zip(texts, found) if f][:20]


def test_query_counts_are_the_base_spans(spark):
    sf = "/root/testdata/sf0.001"
    want = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        spans = plain_spans(r.text or "")
        text = ",".join(f"{pii_crf.KINDS[k]}:{s}:{e}" for s, k, e in spans)
        want[r.doc_id] = (*(sum(k == i for _, k, _ in spans) for i in range(4)), hashlib.sha256(text.encode()).hexdigest())
    assert {r[0]: tuple(r[1:6]) for r in queries.op6_personal_data(spark, sf).collect()} == want


def test_the_field_learns_the_kinds_and_base_spans_stay(spark, field):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    texts = [r.text for r in docs.where(F.col("text").rlike("[0-9@]") & (F.col("doc_id") % 7 == 3)).limit(400).collect()]
    base = [pii_crf.base_spans(t) for t in texts]
    found = pii_crf.added_spans(texts, [[] for _ in texts], field)
    whole = sum(map(len, base))
    hit = sum(any(a[1] == b[1] and a[0] < b[2] and b[0] < a[2] for a in f) for f, bs in zip(found, base) for b in bs)
    assert whole > 40 and hit >= 0.9 * whole
    df = frame(spark, "doc_id long, text string, spans string", [
        (1, None, "s"), (2, "", "s"), (3, "é mail a.b@c.de, ip 10.0.0.1 x", "s"), (3, "é mail a.b@c.de, ip 10.0.0.1 x", "s")])
    out = sorted(((r.doc_id, [tuple(s) for s in r.spans if s.base]) for r in pii_crf.find(df, field).collect()))
    both = [("email", 7, 15, True), ("ip", 20, 28, True)]
    assert out == [(1, []), (2, []), (3, both), (3, both)]
    assert pii_crf.find(df.limit(0), field).count() == 0
    assert pii_crf.find(df, pii_crf.train([], [])).count() == 4
