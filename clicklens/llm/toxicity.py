"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton on folded text.

Folding undoes disguises: letters are lowered and brought to their plain form
without marks, look-alike letters of other scripts in words that mix scripts, and
digits or signs inside words, become the Latin letters they stand for, and what is
no word becomes one blank. An entry of the lexicon is the
beginning of a word. Entries and weights are learned from labelled documents:
word beginnings that mark label 1 far more often than chance, with their log
odds as weight. Longer beginnings of an entry that mark clean documents are its
exceptions: where one matches, the entry does not count. Pairs and triples of
words around an entry that mark clean documents are exceptions too, and further
phrases can be given.

The score is a logistic function of the matched weight, plain and normalised by
the text's length, fitted on the same labelled documents.

Learning uses ``per_label`` documents of each label at most, chosen by a hash of
their ids. Their word beginnings and phrases are counted on the executors; what reaches the
driver are the entries and phrases that pass the test and one row of features for each of
those documents.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicklens.llm.common import blocks, written

PER_LABEL = 4000
SHORTEST, LONGEST = 3, 12
#: An entry: documents with label 1 that hold it, its strength, and its share of documents with
#: label 1. An exception: that share at most.
LEAST_DOCS, LEAST_STRENGTH, LEAST_PRECISION, CLEAN_PRECISION = 5, 5.0, 0.4, 0.1

#: A phrase marks clean documents as a word does, and is that far from its entry's share of label 1 besides.
LEAST_CONTRAST = 2.5

#: Small letters of other scripts that look like Latin ones (Cyrillic, Greek, Armenian), a line for each
#: Latin letter; then digits and signs with the letters they stand for.
LOOK_ALIKE = str.maketrans({c: line[0] for line in (
    "aаαɑ", "bьвβ", "cсϲ", "dԁժ", "eеєε", "gɡց", "hһнհη", "iіιɩ", "jјϳ", "kкκ", "lӏ", "mмϻ", "nпոռν", "oоοσօ",
    "pрρ", "qԛզգ", "rгя", "sѕտ", "tтτ", "uυцսμ", "vѵ", "wԝшωա", "xхχ", "yуүγ", "zʐ") for c in line[1:]})
DIGIT = str.maketrans("0134578@$!", "oieastbasi")
HIDDEN = re.compile("[­​-‏⁠﻿]")
MARK = re.compile("[\u0300-\u036f\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff\ufe20-\ufe2f]")
OTHER_SCRIPT = re.compile("[Ͱ-ӿԀ-֏]")
LATIN = re.compile("[a-z]")
WORD = re.compile(r"(?:[@$!](?=[^\W\d_])|[^\W_])+")
MIXED = re.compile(r"[\d@$!]")
#: Three or more single letters with one sign between each two.
SPACED = re.compile(r"(?<![^\W_])[^\W\d_](?:[.\-_*·][^\W\d_]){2,}(?![^\W_])")
SIGN = re.compile(r"[.\-_*·]")

#: Names of letters that are a Latin letter in another shape and have no decomposition.
LATIN_SHAPE = re.compile(r"LATIN (?:SMALL|CAPITAL) LETTER (?:SCRIPT |DOTLESS )?([A-Z])(?: WITH .*)?$"
                         r"|LATIN LETTER SMALL CAPITAL ([A-Z])$"
                         r"|(?:NEGATIVE )?(?:SQUARED|CIRCLED) LATIN CAPITAL LETTER ([A-Z])$"
                         r"|REGIONAL INDICATOR SYMBOL LETTER ([A-Z])$")


def _shapes() -> dict[int, str]:
    """Code point -> Latin letter, by the names of the characters."""
    out = {}
    for c in (*range(0xC0, 0x300), *range(0x1D00, 0x1F00), *range(0x2C60, 0x2C80), *range(0xA720, 0xA800),
              *range(0x1F110, 0x1F200)):
        if m := LATIN_SHAPE.match(unicodedata.name(chr(c), "")):
            out[c] = next(filter(None, m.groups())).lower()
    return out


SHAPE = _shapes()


def _one_script(word: str, latin: bool) -> str:
    """A word that mixes scripts in Latin letters; in a Latin text one of nothing but look-alikes too."""
    if not OTHER_SCRIPT.search(word):
        return word
    if LATIN.search(word) or (latin and all(ord(c) in LOOK_ALIKE for c in word if c.isalpha())):
        return word.translate(LOOK_ALIKE)
    return word


def folded(text: str | None) -> list[str]:
    """The words of a text without their disguises.

    Compatibility forms (full-width, mathematical, circled letters) become plain
    ones, diacritical marks and hidden characters go, Latin letters of another
    shape become the plain ones, single letters with a sign between each two are
    put together. Letters of other scripts become the Latin ones that they look
    like only in words that mix scripts (and, in a text of mostly Latin letters, in words of
    nothing but look-alikes): texts in other scripts stay as they are.
    """
    t = (text or "").lower()
    plain = t.isascii()
    if not plain:
        t = unicodedata.normalize("NFC", MARK.sub("", unicodedata.normalize("NFKD", HIDDEN.sub("", t)))).lower()
        t = t.translate(SHAPE)
    t = SPACED.sub(lambda m: SIGN.sub("", m[0]), t)
    words = WORD.findall(t)
    if not plain and (other := len(OTHER_SCRIPT.findall(t))):
        latin = len(LATIN.findall(t)) > other
        words = [_one_script(w, latin) for w in words]
    if MIXED.search(t):
        words = [w.translate(DIGIT) if not w.isalpha() and any(map(str.isalpha, w)) else w for w in words]
    return words


class Lexicon:
    """Entries (word beginning -> weight), exceptions, and the weights of the logistic function."""

    def __init__(self, entries: dict[str, float], exceptions: list[str], logit: list[float]):
        self.entries, self.exceptions, self.logit = entries, exceptions, logit
        self._automaton = None

    def __getstate__(self):
        return self.__dict__ | {"_automaton": None}

    def matched(self, words: list[str]) -> list[float]:
        """Weights of the entries matched outside exceptions."""
        if not self.entries:
            return []
        if self._automaton is None:
            self._automaton = ahocorasick.Automaton()
            for e in self.exceptions:
                self._automaton.add_word(" " + e, (len(e) + 1, None))
            for e, w in self.entries.items():
                self._automaton.add_word(" " + e, (len(e) + 1, w))
            self._automaton.make_automaton()
        hits: dict[int, float] = {}
        not_at = set()
        text = " " + " ".join(words) + " "
        for end, (size, weight) in self._automaton.iter(text):
            if weight is None:
                # An entry that starts at any word of a phrase is inside of it.
                at = end - size + 1
                while at >= 0:
                    not_at.add(at - 1)
                    at = text.find(" ", at + 1, end)
            else:
                hits[end - size] = max(weight, hits.get(end - size, 0.0))
        return [w for at, w in hits.items() if at not in not_at]

    def features(self, text: str | None) -> list[float]:
        words = folded(text)
        weights = self.matched(words)
        return [1.0, max(weights, default=0.0), math.log1p(sum(weights)),
                min(10.0, 100 * sum(weights) / (len(words) + 20))]

    def score(self, text: str | None) -> float:
        z = float(np.dot(self.logit, self.features(text)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _beginnings(labelled: DataFrame) -> DataFrame:
    """(term, ones, docs): documents, and those with label 1, that hold a word beginning."""

    def run(batches):
        for batch in batches:
            ones, docs = Counter(), Counter()
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                terms = {w[:k] for w in set(folded(text)) for k in range(SHORTEST, min(LONGEST, len(w)) + 1)}
                docs.update(terms)
                if label:
                    ones.update(terms)
            yield pa.RecordBatch.from_arrays([
                pa.array(list(docs), pa.string()), pa.array([ones[t] for t in docs], pa.int64()),
                pa.array(list(docs.values()), pa.int64())], names=["term", "ones", "docs"])

    return (labelled.select("text", "label").mapInArrow(run, "term string, ones long, docs long")
            .groupBy("term").agg(F.sum("ones").alias("ones"), F.sum("docs").alias("docs")))


def _phrases(labelled: DataFrame, entries: dict[str, float], not_words: list[str]) -> DataFrame:
    """(entry, phrase, ones, docs): as above, of the pairs and triples of words around an entry."""
    known = set(not_words)

    def run(batches):
        for batch in batches:
            ones, docs = Counter(), Counter()
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words, found = folded(text), set()
                for i, w in enumerate(words):
                    heads = [w[:k] for k in range(SHORTEST, min(LONGEST, len(w)) + 1)]
                    entry = next((h for h in heads if h in entries), None)
                    if entry is None or not known.isdisjoint(heads):
                        continue
                    found.update((entry, " ".join(words[a:b])) for a, b in (
                        (i - 1, i + 1), (i, i + 2), (i - 2, i + 1), (i - 1, i + 2), (i, i + 3))
                        if a >= 0 and b <= len(words))
                docs.update(found)
                if label:
                    ones.update(found)
            yield pa.RecordBatch.from_arrays([
                pa.array([k[0] for k in docs], pa.string()), pa.array([k[1] for k in docs], pa.string()),
                pa.array([ones[k] for k in docs], pa.int64()), pa.array(list(docs.values()), pa.int64())],
                names=["entry", "phrase", "ones", "docs"])

    return (labelled.select("text", "label").mapInArrow(run, "entry string, phrase string, ones long, docs long")
            .groupBy("entry", "phrase").agg(F.sum("ones").alias("ones"), F.sum("docs").alias("docs")))


def _strength(ones: int, docs: int, share: float) -> float:
    """Root of the likelihood ratio against a term that marks label 1 as often as any document has it."""
    clean = docs - ones
    g = (ones * math.log(ones / (docs * share)) if ones else 0) + (
        clean * math.log(clean / (docs * (1 - share))) if clean else 0)
    return math.sqrt(max(0.0, 2 * g))


def _select(rows, n1: int, n0: int) -> tuple[dict[str, float], list[str]]:
    """Entries, strongest first and none that begins or goes on another; then exceptions below them."""
    terms = {r["term"]: (r["ones"], r["docs"]) for r in rows}
    share = n1 / max(1, n1 + n0)
    marks = {t: z for t, (a, d) in terms.items() if a >= LEAST_DOCS and a >= LEAST_PRECISION * d
             and (z := _strength(a, d, share)) >= LEAST_STRENGTH}
    entries: dict[str, float] = {}
    heads = set()
    # Of terms in the same documents, the longest says most.
    for t in sorted(marks, key=lambda t: (-marks[t], -len(t), t)):
        if t in heads or any(t[:k] in entries for k in range(SHORTEST, len(t))):
            continue
        a, d = terms[t]
        entries[t] = math.log((a + .5) / (n1 + 1)) - math.log((d - a + .5) / (n0 + 1))
        heads.update(t[:k] for k in range(SHORTEST, len(t)))
    clean = [t for t, (a, d) in terms.items() if d - a >= LEAST_DOCS and a <= CLEAN_PRECISION * d
             and any(t[:k] in entries for k in range(SHORTEST, len(t)))]
    return entries, clean


def _fit(x: np.ndarray, y: np.ndarray, steps: int = 30, ridge: float = 0.5) -> np.ndarray:
    """Ridge logistic regression by Newton's method; the classes weigh the same."""
    w = np.zeros(x.shape[1])
    each = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (each * p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        w = w + np.linalg.solve(h, x.T @ (each * (y - p)) - ridge * w)
    return w


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", per_label: int = PER_LABEL, exceptions: tuple[str, ...] = ()) -> Lexicon:
    """A lexicon from the documents that ``labels`` marks 0 or 1; other labels and null ids are left out."""
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).alias("id")).agg(F.max(label_col).alias("label"))
    chosen = None
    for label in (0, 1):
        some = known.where(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(per_label)
        chosen = some if chosen is None else chosen.unionByName(some)
    text = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # 2 * per_label ids at most, so the broadcast is bounded.
    labelled = written(text.join(F.broadcast(written(chosen, "toxicity", "chosen")), "id").select("text", "label"),
                       "toxicity", "labelled")
    n = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = written(_beginnings(labelled).where(F.col("docs") >= LEAST_DOCS), "toxicity", "counts")
    strong = counts.where((F.col("ones") >= LEAST_DOCS) & (F.col("ones") >= LEAST_PRECISION * F.col("docs")))
    clean = counts.where((F.col("docs") - F.col("ones") >= LEAST_DOCS)
                         & (F.col("ones") <= CLEAN_PRECISION * F.col("docs")))
    heads = strong.select(F.col("term").alias("head"))
    cut = F.explode(F.sequence(F.lit(SHORTEST), F.length("term") - 1))
    below = (clean.where(F.length("term") > SHORTEST).select("term", "ones", "docs", cut.alias("k"))
             .join(heads, F.expr("substring(term, 1, k)") == F.col("head"), "left_semi")
             .select("term", "ones", "docs").distinct())
    rows = strong.collect() + below.collect()
    entries, not_words = _select(rows, n.get(1, 0), n.get(0, 0))
    if entries:
        share = {r["term"]: min(r["ones"] / r["docs"], 0.99) for r in rows if r["term"] in entries}
        found = _phrases(labelled, entries, not_words).where(
            (F.col("docs") - F.col("ones") >= LEAST_DOCS) & (F.col("ones") <= CLEAN_PRECISION * F.col("docs"))).collect()
        # The blank after a phrase makes its last word a whole one.
        not_words += sorted({r["phrase"] + " " for r in found
                             if _strength(r["ones"], r["docs"], share[r["entry"]]) >= LEAST_CONTRAST})
    lexicon = Lexicon(entries, [*not_words, *(" ".join(folded(e)) for e in exceptions)], [0.0] * 4)

    def features(batches):
        for batch in batches:
            x = np.array([lexicon.features(t) for t in batch.column(0).to_pylist()]).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([*[pa.array(x[:, i]) for i in range(4)], batch.column(1)],
                                             names=["a", "b", "c", "d", "label"])

    seen = labelled.mapInArrow(features, "a double, b double, c double, d double, label int").toArrow()
    if seen.num_rows:
        x = np.column_stack([seen.column(i).to_numpy() for i in range(4)])
        lexicon.logit = _fit(x, seen.column(4).to_numpy().astype(float)).tolist()
    return lexicon


def scores(docs: DataFrame, lexicon: Lexicon, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with ``out``, from 0 to 1, in the place of the text.

    Defined cases: an empty or null text and one without a match get the score
    of a text without any entry; a text of any length is matched whole;
    repeated rows each get the same score; an empty table gives an empty one;
    an empty lexicon scores 0.5.
    """
    rest = [c for c in docs.columns if c not in (text_col, out)]
    schema = T.StructType([*(docs.schema[c] for c in rest), T.StructField(out, T.DoubleType())])
    model = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches):
        for batch in batches:
            for b in blocks(batch, len(rest)):
                got = pa.array([model.value.score(t) for t in b.column(len(rest)).to_pylist()], pa.float64())
                yield pa.RecordBatch.from_arrays([*b.columns[:len(rest)], got], names=schema.names)

    return docs.select(*[F.col(f"`{c}`") for c in rest], F.col(text_col)).mapInArrow(run, schema)
