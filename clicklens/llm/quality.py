"""Quality by Naive Bayes support vectors: a hinge-loss model over scaled n-gram indicators.

A text is read as tokens: runs of letters and digits, lowered, and runs of
other signs. Its features are the tokens and pairs of neighbouring tokens that
it holds, and triples of neighbouring echoes, each once however often it occurs;
a token's echo is how many tokens back the same one stood, up to four, and says
of repeated words what the words themselves, mostly rare, cannot. An n-gram's indicator is scaled by
its log-count ratio, the log of its share among the n-grams of label 1 over that
among those of label 0, both smoothed. On the scaled indicators a linear model
with hinge loss is fitted by dual coordinate descent: one dual variable for each
document, visited in a new random order in each pass, clipped to its box, until
the largest projected gradient of a pass is small. Classes weigh the same. A
logistic function of the margin, fitted on the same documents, gives the score.

Learning uses a bounded sample, chosen by a hash of the ids: ``per_label``
documents of each label at most, and of those as many as hold ``sample_bytes``
of text. Their n-grams are counted on the executors; what reaches the driver
are the ``features`` strongest n-grams and, for each document of the sample,
the numbers of those that it holds.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicklens.llm.common import blocks, written

PER_LABEL = 4000
SAMPLE_BYTES = 32 << 20
FEATURES = 100_000
#: Documents of the sample that hold an n-gram, at least; added to each count; cost of a hinge error.
LEAST_DOCS, SMOOTHING, COST = 3, 1.0, 1.0
TOKEN = re.compile(r"[^\W_]+|(?:_|[^\w\s])+")


def grams(text: str | None) -> set[str]:
    """Tokens of a text, pairs of neighbouring tokens (a blank between them) and triples of echoes."""
    tokens = TOKEN.findall((text or "").lower())
    a, b, c, d = ([*[None] * k, *tokens[:-k]] for k in (1, 2, 3, 4))
    echo = "".join(["1" if t == w else "2" if t == x else "3" if t == y else "4" if t == z else "0"
                    for t, w, x, y, z in zip(tokens, a, b, c, d)])
    return {*tokens, *map(" ".join, zip(tokens, tokens[1:])),
            *map(" echo ".__add__, {echo[i:i + 3] for i in range(len(echo) - 2)})}


def coordinate_descent(start: np.ndarray, index: np.ndarray, value: np.ndarray, sign: np.ndarray, cost: np.ndarray,
                       n_features: int, passes: int = 200, tolerance: float = 1e-3, seed: int = 7) -> tuple:
    """(weights, dual variables) of the linear model with hinge loss.

    Row ``i`` has the features ``index[start[i]:start[i + 1]]`` with ``value``;
    ``sign`` is 1 or -1 and ``cost`` bounds the row's dual variable.
    """
    w, alpha = np.zeros(n_features), np.zeros(len(sign))
    square = np.array([v @ v for v in (value[a:b] for a, b in zip(start, start[1:]))])
    order = np.random.default_rng(seed)
    for _ in range(passes):
        worst = 0.0
        for i in order.permutation(len(sign)).tolist():
            if not square[i]:
                continue
            at, v = index[start[i]:start[i + 1]], value[start[i]:start[i + 1]]
            gradient = sign[i] * (w[at] @ v) - 1
            old = alpha[i]
            worst = max(worst, abs(min(gradient, 0) if old == 0 else max(gradient, 0) if old == cost[i] else gradient))
            alpha[i] = min(max(old - gradient / square[i], 0.0), cost[i])
            if alpha[i] != old:
                w[at] += (alpha[i] - old) * sign[i] * v
        if worst < tolerance:
            break
    return w, alpha


def _logistic(margin: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset of the score, by Newton's method; the classes weigh the same."""
    x = np.column_stack([margin, np.ones(len(margin))])
    each = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    # Targets short of 0 and 1 keep the slope finite where the margins separate the labels.
    target = np.where(y == 1, 1 - 1 / (2 + (y == 1).sum()), 1 / (2 + (y == 0).sum()))
    c = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ c, -30, 30)))
        h = (x * (each * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        c = c + np.linalg.solve(h, x.T @ (each * (target - p)) - 1e-3 * c)
    return float(c[0]), float(c[1])


class Model:
    """N-grams with their log-count ratios and weights (the bias last), and the logistic function."""

    def __init__(self, names: list[str], ratios: np.ndarray, weights: np.ndarray, slope: float, offset: float):
        self.place = {g: i for i, g in enumerate(names)}
        self.scaled, self.square = weights[:-1] * ratios, ratios * ratios
        self.bias, self.slope, self.offset = float(weights[-1]), slope, offset

    def margin(self, text: str | None) -> float:
        """The linear model on the text's scaled indicators and the bias, as a vector of length 1."""
        get = self.place.get
        at = sorted(i for g in grams(text) if (i := get(g)) is not None)
        return (float(self.scaled[at].sum()) + self.bias) / math.sqrt(float(self.square[at].sum()) + 1)

    def score(self, text: str | None) -> float:
        z = self.slope * self.margin(text) + self.offset
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _sample(docs, labels, id_col, text_col, label_col, per_label, sample_bytes) -> DataFrame:
    """(text, label) of the documents to learn from."""
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
    chosen = None
    for label in (0, 1):
        some = known.where(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(per_label)
        chosen = some if chosen is None else chosen.unionByName(some)
    text = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # 2 * per_label ids at most, so the broadcast is bounded; an id that several documents share counts once.
    found = text.join(F.broadcast(written(chosen, "quality", "chosen")), "id").groupBy("id", "label").agg(
        F.max("text").alias("text"))
    before = Window.partitionBy("label").orderBy(F.xxhash64("id"), "id").rowsBetween(Window.unboundedPreceding, 0)
    size = F.sum(F.octet_length("text")).over(before)
    return written(found.withColumn("_size", size).where(F.col("_size") <= sample_bytes).select("text", "label"),
                   "quality", "sample")


def _counts(sample: DataFrame) -> DataFrame:
    """(gram, ones, docs): documents, and those with label 1, that hold an n-gram."""

    def run(batches):
        for batch in batches:
            for b in blocks(batch, 0):
                ones, docs = Counter(), Counter()
                for text, label in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    found = grams(text)
                    docs.update(found)
                    if label:
                        ones.update(found)
                yield pa.RecordBatch.from_arrays([
                    pa.array(list(docs), pa.string()), pa.array([ones[g] for g in docs], pa.int64()),
                    pa.array(list(docs.values()), pa.int64())], names=["gram", "ones", "docs"])

    return (sample.mapInArrow(run, "gram string, ones long, docs long")
            .groupBy("gram").agg(F.sum("ones").alias("ones"), F.sum("docs").alias("docs")))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", per_label: int = PER_LABEL, sample_bytes: int = SAMPLE_BYTES,
          features: int = FEATURES) -> Model:
    """A model from the documents that ``labels`` marks 0 or 1; other labels and null ids are left out.

    Defined cases: an id with both labels has label 1; without documents of both
    labels the model scores every text 0.5.
    """
    sample = _sample(docs, labels, id_col, text_col, label_col, per_label, sample_bytes)
    counts = written(_counts(sample).where(F.col("docs") >= LEAST_DOCS), "quality", "counts")
    total = counts.agg(F.coalesce(F.sum("ones"), F.lit(0)), F.coalesce(F.sum(F.col("docs") - F.col("ones")), F.lit(0)),
                       F.count(F.lit(1))).first()
    ones, zeros, n = (int(x) for x in total)
    if not ones or not zeros:
        return Model([], np.zeros(0), np.zeros(1), 0.0, 0.0)
    ratio = (F.log((F.col("ones") + SMOOTHING) / F.lit(ones + SMOOTHING * n))
             - F.log((F.col("docs") - F.col("ones") + SMOOTHING) / F.lit(zeros + SMOOTHING * n)))
    strongest = (counts.withColumn("ratio", ratio)
                 .orderBy((F.abs("ratio") * F.sqrt("docs")).desc(), "gram").limit(features).toArrow())
    names, ratios = strongest.column("gram").to_pylist(), strongest.column("ratio").to_numpy()
    place = sample.sparkSession.sparkContext.broadcast({g: i for i, g in enumerate(names)})

    def held(batches):
        for batch in batches:
            for b in blocks(batch, 0):
                at = [sorted(place.value[g] for g in grams(t) if g in place.value) for t in b.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.list_(pa.int32())), b.column(1)],
                                                 names=["at", "label"])

    rows = sample.mapInArrow(held, "at array<int>, label int").toArrow().combine_chunks()
    lists, y = rows.column("at"), rows.column("label").to_numpy()
    start = np.concatenate([[0], np.cumsum(lists.combine_chunks().value_lengths().to_numpy(zero_copy_only=False))])
    flat = lists.combine_chunks().flatten().to_numpy()
    # The last feature is the bias: 1 in every document.
    index = np.insert(flat, start[1:], len(names)).astype(np.int64)
    value = np.append(ratios, 1.0)[index]
    start = start + np.arange(len(start))
    # Rows of length 1, so that long documents do not outweigh short ones.
    value = value / np.repeat(np.sqrt(np.add.reduceat(value * value, start[:-1])), np.diff(start))
    cost = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum()) * len(y) * COST
    w, _ = coordinate_descent(start, index, value, np.where(y == 1, 1.0, -1.0), cost, len(names) + 1)
    margin = np.add.reduceat(w[index] * value, start[:-1])
    return Model(names, ratios, w, *_logistic(margin, y))


def scores(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with ``out``, from 0 to 1, in the place of the text.

    Defined cases: an empty or null text and one without a known n-gram get the
    score of the bias alone; a text of any length is read whole; repeated rows
    each get the same score; an empty table gives an empty one; a column already
    named ``out`` is replaced.
    """
    rest = [c for c in docs.columns if c not in (text_col, out)]
    schema = T.StructType([*(docs.schema[c] for c in rest), T.StructField(out, T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for b in blocks(batch, len(rest)):
                got = pa.array([shared.value.score(t) for t in b.column(len(rest)).to_pylist()], pa.float64())
                yield pa.RecordBatch.from_arrays([*b.columns[:len(rest)], got], names=schema.names)

    return docs.select(*[F.col(f"`{c}`") for c in rest], F.col(text_col)).mapInArrow(run, schema)
