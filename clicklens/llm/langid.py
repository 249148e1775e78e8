"""Language identification with a bidirectional gated recurrent network over bytes.

The network reads the bytes of a segment in both directions and labels every
position with a distribution over the learned languages. A segment is a word of
the lowered text between two blanks, or the next ``LONGEST`` bytes of a longer one;
the state starts anew with each. A document's distribution is the pooled (mean)
distribution of all its positions. As segments are independent, equal ones are
run once for a batch of texts, from a bounded memo.

Training is backpropagation through time in numpy, on the driver, over words of
``DOCS_PER_LANG`` documents of each language at most and ``WORDS_PER_DOC`` words of
each, spread over the whole text. Inference runs on the executors over all of
every text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicklens.llm.common import blocks, written

DOCS_PER_LANG, WORDS_PER_DOC = 1000, 60
LONGEST = 24
HIDDEN = 20
STEPS, BATCH, RATE = 900, 192, 0.01
MEMO = 300_000
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")


def segments(text: str) -> list[bytes]:
    """The words of a lowered text as bytes, long ones in pieces."""
    words = text.lower().encode().split()
    if max(map(len, words), default=0) <= LONGEST:
        return words
    return [w[i:i + LONGEST] for w in words for i in range(0, len(w), LONGEST)]


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


class Direction:
    """One gated recurrent layer; the input table stands for embedding and input weights."""

    def __init__(self, rng, hidden: int):
        self.table = rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32)
        self.back = rng.normal(0, hidden ** -0.5, (hidden, 3 * hidden)).astype(np.float32)
        self.bias = np.zeros(hidden, np.float32)

    def forward(self, x, keep: bool = False):
        """States (steps, batch, hidden) over byte columns ``x`` (batch, steps)."""
        n, steps = x.shape
        k = self.back.shape[0]
        h = np.zeros((n, k), np.float32)
        states, kept = np.empty((steps, n, k), np.float32), []
        for t in range(steps):
            a, b = self.table[x[:, t]], h @ self.back
            gate = _sigmoid(a[:, :2 * k] + b[:, :2 * k])
            z, r = gate[:, :k], gate[:, k:]
            inner = b[:, 2 * k:] + self.bias
            new = np.tanh(a[:, 2 * k:] + r * inner)
            if keep:
                kept.append((h, z, r, inner, new))
            h = new + z * (h - new)
            states[t] = h
        return states, kept

    def backward(self, x, kept, grad):
        """Gradients of table, back and bias for gradients of the states."""
        k = self.back.shape[0]
        d_table, d_back, d_bias = np.zeros_like(self.table), np.zeros_like(self.back), np.zeros_like(self.bias)
        carry = np.zeros_like(grad[0])
        for t in range(x.shape[1] - 1, -1, -1):
            h, z, r, inner, new = kept[t]
            g = grad[t] + carry
            d_new = g * (1 - z) * (1 - new * new)
            d_z = g * (h - new) * z * (1 - z)
            d_r = d_new * inner * r * (1 - r)
            d_b = np.concatenate([d_z, d_r, d_new * r], 1)
            np.add.at(d_table, x[:, t], np.concatenate([d_z, d_r, d_new], 1))
            d_back += h.T @ d_b
            d_bias += d_b[:, 2 * k:].sum(0)
            carry = g * z + d_b @ self.back.T
        return d_table, d_back, d_bias


class Network:
    """Two directions and a softmax over languages at every position."""

    def __init__(self, langs: list[str], hidden: int = HIDDEN, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.langs = langs
        self.there, self.here = Direction(rng, hidden), Direction(rng, hidden)
        self.out = rng.normal(0, 0.1, (2 * hidden, len(langs))).astype(np.float32)
        self.bias = np.zeros(len(langs), np.float32)

    def parameters(self):
        return [self.there.table, self.there.back, self.there.bias, self.here.table, self.here.back, self.here.bias,
                self.out, self.bias]

    def positions(self, x, keep: bool = False):
        """Probabilities (steps, batch, languages) and what the backward pass needs."""
        f, kept_f = self.there.forward(x, keep)
        b, kept_b = self.here.forward(x[:, ::-1], keep)
        both = np.concatenate([f, b[::-1]], 2)
        logits = both @ self.out + self.bias
        p = np.exp(logits - logits.max(2, keepdims=True))
        return p / p.sum(2, keepdims=True), (both, kept_f, kept_b)

    def gradients(self, x, y):
        """Of the mean cross entropy of all positions."""
        p, (both, kept_f, kept_b) = self.positions(x, keep=True)
        d = p.copy()
        d[:, np.arange(len(y)), y] -= 1
        d /= d.shape[0] * d.shape[1]
        k = both.shape[2] // 2
        d_both = d @ self.out.T
        flat = d.reshape(-1, d.shape[2])
        return [*self.there.backward(x, kept_f, d_both[:, :, :k]),
                *self.here.backward(x[:, ::-1], kept_b, d_both[::-1, :, k:]),
                both.reshape(-1, 2 * k).T @ flat, flat.sum(0)]

    def summed(self, words: list[bytes]) -> np.ndarray:
        """For each segment, the sum of its positions' probabilities."""
        out = np.zeros((len(words), len(self.langs)))
        for at, x in same_length(words):
            for i in range(0, len(at), 4096):
                out[at[i:i + 4096]] = self.positions(x[i:i + 4096])[0].sum(0, dtype=np.float64)
        return out


def same_length(words: list[bytes]):
    """(indexes, byte matrix with a blank on both sides) of the words of each length."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    for n in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == n)
        x = np.full((len(at), n + 2), 32, np.uint8)
        x[:, 1:-1] = np.frombuffer(b"".join([words[i] for i in at.tolist()]), np.uint8).reshape(-1, n)
        yield at, x


def train(words: list[bytes], langs: list[int], names: list[str], steps: int = STEPS, seed: int = 7) -> Network:
    """Adam on batches of words of one length; each language is drawn as often as any other."""
    net, rng = Network(names, seed=seed), np.random.default_rng(seed)
    y = np.array(langs)
    groups = [(x, y[at], x.size) for at, x in same_length(words)]
    if not groups or len(names) < 2:
        return net
    weight = 1 / np.bincount(y, minlength=len(names)).clip(1)
    draw = [weight[g[1]] / weight[g[1]].sum() for g in groups]
    share = np.array([weight[g[1]].sum() * g[0].shape[1] for g in groups])
    share /= share.sum()
    mean = [np.zeros_like(p) for p in net.parameters()]
    square = [np.zeros_like(p) for p in net.parameters()]
    for step in range(1, steps + 1):
        g = rng.choice(len(groups), p=share)
        pick = rng.choice(len(groups[g][1]), BATCH, p=draw[g])
        rate = RATE * (1 - 0.9 * step / steps)
        for p, d, m, s in zip(net.parameters(), net.gradients(groups[g][0][pick], groups[g][1][pick]), mean, square):
            m += 0.1 * (d - m)
            s += 0.01 * (d * d - s)
            p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-7)
    return net


def learn(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
          docs_per_lang: int = DOCS_PER_LANG, words_per_doc: int = WORDS_PER_DOC) -> Network:
    """A network from the rows with a language and a text; rows are chosen by a hash of their ids."""
    known = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    names = sorted(r["lang"] for r in known.select("lang").distinct().collect())
    ids = None
    for name in names:
        some = (known.where(F.col("lang") == name).select("id", "lang")
                .orderBy(F.xxhash64("id"), "id").limit(docs_per_lang))
        ids = some if ids is None else ids.unionByName(some)

    def draw(batches):
        for batch in batches:
            langs, words = [], []
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                got = segments(text)
                picked = [got[i * len(got) // words_per_doc] for i in range(words_per_doc)] if len(
                    got) > words_per_doc else got
                words += picked
                langs += [lang] * len(picked)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(langs, pa.string())],
                                             names=["word", "lang"])

    if ids is None:
        return Network([])
    chosen = written(ids, "langid", "chosen")
    # docs_per_lang ids for each language at most, so the broadcast is bounded.
    rows = known.join(F.broadcast(chosen.select("id", "lang").distinct()), ["id", "lang"]).select("text", "lang")
    got = rows.mapInArrow(draw, "word binary, lang string").orderBy("lang", "word").toArrow()
    place = {n: i for i, n in enumerate(names)}
    return train(got.column(0).to_pylist(), [place[x] for x in got.column(1).to_pylist()], names)


def predictions(docs: DataFrame, net: Network, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` in the place of the text.

    ``score`` is the pooled probability of the language. Defined cases: a text
    that is null or has no letter is ``und`` with score 0, as is every text of a
    network without a language; a text of any length is read whole; of equal
    probabilities the language first in the alphabet is named; repeated rows each
    get the same result; an empty table gives an empty one.
    """
    rest = [c for c in docs.columns if c not in (text_col, "lang_pred", "score")]
    schema = T.StructType([*(docs.schema[c] for c in rest), T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    model = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches):
        net = model.value
        place: dict[bytes, int] = {}
        table, used = np.zeros((0, len(net.langs))), 0
        for batch in batches:
            for b in blocks(batch, len(rest), 4 << 20):
                texts = [t if t and LETTER.search(t) and net.langs else "" for t in b.column(len(rest)).to_pylist()]
                parts = [segments(t) for t in texts]
                words = [w for p in parts for w in p]
                new = list(dict.fromkeys(w for w in words if w not in place))
                if used + len(new) > MEMO and used:
                    place, used = {}, 0
                    new = list(dict.fromkeys(words))
                if used + len(new) > len(table):
                    table = np.concatenate([table[:used], np.zeros((max(len(new), used), len(net.langs)))])
                table[used:used + len(new)] = net.summed(new)
                place.update(zip(new, range(used, used + len(new))))
                used += len(new)
                at = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
                sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
                ends = np.cumsum([0, *map(len, parts)])
                names, scores = [], []
                for i, j in zip(ends[:-1].tolist(), ends[1:].tolist()):
                    if i == j:
                        names.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    p = table[at[i:j]].sum(0) / sizes[i:j].sum()
                    best = int(p.round(6).argmax())
                    names.append(net.langs[best])
                    scores.append(min(1.0, round(float(p[best]), 6)))
                yield pa.RecordBatch.from_arrays([*b.columns[:len(rest)], pa.array(names, pa.string()),
                                                  pa.array(scores, pa.float64())], names=schema.names)

    return docs.select(*[F.col(f"`{c}`") for c in rest], F.col(text_col)).mapInArrow(run, schema)
