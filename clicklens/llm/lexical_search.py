"""Ranked lexical search over bit-sliced Bloom signatures, with exact results.

``index`` gives every document a Bloom signature of its terms. A term is set once
for each level that its number of occurrences reaches (``LEVELS``), so the
signature bounds the count and not only tells presence. Signatures are as long
as the document's own entries need (a power of two, ``BITS`` bits an entry at
least); documents of one length are put together in blocks and stored by bit:
a block's slice ``p`` is a bitmap with a bit for each of its documents.

``search`` ranks all documents for each item. The AND of a term's slices is a
bitmap of the documents that may hold it, none missing; summed with the largest
contribution that the level allows, weighted by the term, these bitmaps give an
upper bound of each document's score. The documents with the highest bounds are
scored exactly first; the lowest of the best ``top`` of them is a score that a
result needs. Every document whose bound reaches it is then scored exactly from
its whole text, so nothing is lost to the filter.

The score is integer arithmetic on doubles' weights: a term's weight is
floor(1000*ln((2N+2)/(2df+1))), its contribution weight times
(10^9*tf) div (1000*tf+20*m), and m = 50 + (50*n*N) div L, where N counts the
documents with a term, L all terms, n the document's, df the documents with the
term and tf its occurrences in the document.

Items are searched in blocks, so that what is sent to the executors stays
bounded however many items there are; the index is read once for each block.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicklens.llm.common import blocks, written
from clicklens.operators.lookup import checked_side

#: A term is a run of letters, digits and characters beyond ASCII, A-Z lowered. In UTF-8 every byte of the
#: latter is beyond ASCII, so bytes can be mapped and split: what is in no term becomes a blank.
TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
TERM_BYTES = bytes(range(256)).lower().translate(bytes(b if TERM.match(bytes([b])) else 32 for b in range(256)))
#: Occurrences from which a level is set.
LEVELS = (1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 64, 128, 512)
HASHES, BITS, LEAST_BITS = 4, 16, 256
#: Documents of a block at most, and its bits.
BLOCK_DOCS, BLOCK_BITS = 1024, 1 << 23
#: (item, term) pairs of a block of items, and elements of one array of bounds.
PAIRS_AT_ONCE, CELLS = 100_000, 1 << 21
#: Documents scored first for each item, as a multiple of those wanted: the more, the higher the score that others
#: have to reach.
FIRST = 4

INDEX = "bits int, keys array<long>, lengths array<long>, slices binary"


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a whole text in UTF-8, with repeats; null has none."""
    return (text or b"").translate(TERM_BYTES).split()


def _texts(df: DataFrame, text_col: str, *rest) -> DataFrame:
    """``rest``, and last the text as bytes."""
    return df.select(*rest, F.col(f"`{text_col}`").cast("binary").alias("_text"))


def row_key(id_col: str, text_col: str) -> Column:
    """What finds a document again. Documents that share it by chance are scored needlessly, no more."""
    return F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """64 bits that depend on all bits of ``x`` and on ``salt``."""
    x = x ^ np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _positions(entries: np.ndarray, bits: int):
    """``HASHES`` arrays of bit numbers: two halves of the hash, stepped."""
    first, step = entries & np.uint64(0xFFFFFFFF), (entries >> np.uint64(32)) | np.uint64(1)
    for k in range(HASHES):
        yield ((first + np.uint64(k) * step) & np.uint64(bits - 1)).astype(np.int64)


def _entries(texts: list[bytes | None]) -> tuple[list[int], list[np.ndarray]]:
    """Number of terms and Bloom entries of each text."""
    lengths, counts = [], []
    for t in texts:
        words = terms(t)
        lengths.append(len(words))
        counts.append(Counter(words))
    total = sum(map(len, counts))
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, chain.from_iterable(counts)), np.uint64, total)
    tf = np.fromiter(chain.from_iterable(c.values() for c in counts), np.int64, total)
    doc = np.repeat(np.arange(len(texts)), [len(c) for c in counts])
    made, at = [], []
    for level, least in enumerate(LEVELS):
        reach = np.flatnonzero(tf >= least)
        made.append(_mixed(h[reach], level))
        at.append(doc[reach])
    made, at = np.concatenate(made), np.concatenate(at)
    order = np.argsort(at, kind="stable")
    return lengths, np.split(made[order], np.searchsorted(at[order], np.arange(1, len(texts))))


def _block(bits: int, docs: list) -> tuple:
    """A row of the index: the documents' signatures, turned by bit."""
    slices = np.zeros((bits, -(-len(docs) // 8)), np.uint8)
    for i, (_, _, entries) in enumerate(docs):
        for p in _positions(entries, bits):
            slices[p, i >> 3] |= 1 << (i & 7)
    return bits, [d[0] for d in docs], [d[1] for d in docs], slices.tobytes()


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                      names=["bits", "keys", "lengths", "slices"])


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The blocks of all documents with a term; the others cannot score.

    A text of any length has a signature of its own size; a block of long ones
    holds few documents.
    """
    def run(batches):
        open_: dict[int, list] = {}
        for batch in batches:
            for b in blocks(batch, 1):
                keys = b.column(0).to_pylist()
                for key, length, entries in zip(keys, *_entries(b.column(1).to_pylist())):
                    if not length:
                        continue
                    bits = max(LEAST_BITS, 1 << (BITS * len(entries) - 1).bit_length())
                    own = open_.setdefault(bits, [])
                    own.append((key, length, entries))
                    if len(own) >= max(8, min(BLOCK_DOCS, BLOCK_BITS // bits)):
                        yield _rows([_block(bits, open_.pop(bits))])
        for bits in sorted(open_):
            yield _rows([_block(bits, open_[bits])])

    return _texts(docs, text_col, row_key(id_col, text_col).alias("key")).mapInArrow(run, INDEX)


class Items:
    """A block of items as the executors need it: terms, their hashes and weights, the terms of each item."""

    def __init__(self, rows, top: int):
        self.top = top
        self.terms: dict[bytes, int] = {}
        by_item: dict = {}
        for number, term in rows:
            by_item.setdefault(number, []).append(self.terms.setdefault(bytes(term), len(self.terms)))
        self.hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, self.terms), np.uint64, len(self.terms))
        self.numbers = list(by_item)
        self.sets = [frozenset(x) for x in by_item.values()]
        self.flat = np.array([t for x in by_item.values() for t in x], np.int64)
        self.starts = np.cumsum([0, *map(len, by_item.values())])[:-1]
        self.place = {n: i for i, n in enumerate(self.numbers)}
        self.least = [1] * len(self.numbers)
        self.weights, self.n_docs, self.n_terms = np.zeros(len(self.terms), np.int64), 0, 1

    def weigh(self, df: dict[bytes, int], n_docs: int, n_terms: int) -> None:
        """Weights from the documents that hold each term; a term that none holds keeps weight 0."""
        self.n_docs, self.n_terms = n_docs, n_terms
        for t, n in df.items():
            self.weights[self.terms[t]] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1)))

    def m(self, lengths: np.ndarray) -> np.ndarray:
        return 50 + (50 * lengths * self.n_docs) // self.n_terms

    def exact(self, text: bytes | None, at: list[int]) -> list[int]:
        """Scores of one document for some items."""
        words = terms(text)
        m = 50 + (50 * len(words) * self.n_docs) // self.n_terms
        tf = Counter(filter(self.terms.__contains__, words))
        gain = {(t := self.terms[w]): int(self.weights[t]) * ((1_000_000_000 * k) // (1000 * k + 20 * m))
                for w, k in tf.items()}
        return [sum(gain[t] for t in gain.keys() & self.sets[i]) for i in at]

    def bounds(self, bits: int, lengths: np.ndarray, slices: bytes):
        """(first document, upper bounds by item and document) for runs of a block's documents."""
        matrix = np.frombuffer(slices, np.uint8).reshape(bits, -1)
        wide = max(1, CELLS // max(1, len(self.flat), len(self.terms)) // 8)
        for a in range(0, matrix.shape[1], wide):
            yield a * 8, self._bounds(bits, lengths[a * 8:(a + wide) * 8], matrix[:, a:a + wide])

    def _bounds(self, bits: int, n: np.ndarray, matrix: np.ndarray) -> np.ndarray:
        level = np.zeros((len(self.terms), len(n)), np.uint8)
        alive, below = np.arange(len(self.terms)), None
        for i in range(len(LEVELS)):
            rows = below
            for p in _positions(_mixed(self.hashes[alive], i), bits):
                rows = matrix[p] if rows is None else rows & matrix[p]
            some = rows.any(axis=1)
            alive, below = alive[some], rows[some]
            if not len(alive):
                break
            level[alive] += np.unpackbits(below, axis=1, count=len(n), bitorder="little")
        m = self.m(n)
        # The largest count that a level allows: one less than the next, or all terms of the document.
        most = np.stack([np.zeros_like(n), *[np.minimum(x - 1, n) for x in LEVELS[1:]], n])
        gain = (1_000_000_000 * most) // (1000 * most + 20 * m)
        each = gain[level, np.arange(len(n))] * self.weights[:, None]
        return np.add.reduceat(each[self.flat], self.starts, axis=0)


def _highest(blocks_: DataFrame, items) -> DataFrame:
    """(number, key): for each item, the documents with the highest bounds."""

    def run(batches):
        q = items.value
        best = np.zeros((len(q.numbers), FIRST * q.top), np.int64)
        keys = np.zeros((len(q.numbers), FIRST * q.top), np.int64)
        for batch in batches:
            for bits, k, lengths, slices in zip(*[c.to_pylist() for c in batch.columns]):
                k = np.array(k, np.int64)
                for at, bound in q.bounds(bits, np.array(lengths, np.int64), slices):
                    both = np.concatenate([best, bound], axis=1)
                    own = np.concatenate([keys, np.broadcast_to(k[at:at + bound.shape[1]], bound.shape)], axis=1)
                    pick = np.argpartition(-both, FIRST * q.top - 1, axis=1)[:, :FIRST * q.top]
                    best, keys = np.take_along_axis(both, pick, 1), np.take_along_axis(own, pick, 1)
        row, col = np.nonzero(best)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.array(q.numbers, np.int64)[row]), pa.array(keys[row, col]), pa.array(best[row, col])],
            names=["number", "key", "bound"])

    found = blocks_.mapInArrow(run, "number long, key long, bound long")
    place = F.row_number().over(Window.partitionBy("number").orderBy(F.desc("bound"), "key"))
    return found.withColumn("_place", place).where(F.col("_place") <= FIRST * items.value.top).select("number", "key")


def _possible(blocks_: DataFrame, items) -> DataFrame:
    """(number, key): for each item, all documents whose bound reaches the item's least score."""

    def run(batches):
        q = items.value
        numbers, least = np.array(q.numbers, np.int64), np.array(q.least, np.int64)
        for batch in batches:
            for bits, k, lengths, slices in zip(*[c.to_pylist() for c in batch.columns]):
                k = np.array(k, np.int64)
                for at, bound in q.bounds(bits, np.array(lengths, np.int64), slices):
                    row, col = np.nonzero(bound >= least[:, None])
                    yield pa.RecordBatch.from_arrays([pa.array(numbers[row]), pa.array(k[at + col])],
                                                     names=["number", "key"])

    return blocks_.mapInArrow(run, "number long, key long").distinct()


def _scored(docs: DataFrame, wanted: DataFrame, items, id_col: str, text_col: str) -> DataFrame:
    """(number, id, score) of the wanted pairs with a score above 0, from the documents' whole texts."""
    # A document's list is as long as the block has items at most.
    by_doc = checked_side(wanted.groupBy("key").agg(F.collect_list("number").alias("numbers")))
    text = _texts(docs, text_col, row_key(id_col, text_col).alias("key"), F.col(f"`{id_col}`").alias("id"))
    found = text.join(by_doc, "key").select("id", "numbers", "_text")
    schema = T.StructType([T.StructField("number", T.LongType()), T.StructField("id", docs.schema[id_col].dataType),
                           T.StructField("score", T.LongType())])

    def run(batches):
        q = items.value
        for batch in batches:
            for b in blocks(batch, 2):
                at, numbers, scores = [], [], []
                for i, (own, text) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist())):
                    for number, score in zip(own, q.exact(text, [q.place[n] for n in own])):
                        if score > 0:
                            at.append(i)
                            numbers.append(number)
                            scores.append(score)
                yield pa.RecordBatch.from_arrays([
                    pa.array(numbers, pa.int64()), b.column(0).take(pa.array(at, pa.int64())),
                    pa.array(scores, pa.int64())], names=schema.names)

    return found.mapInArrow(run, schema)


def _ranked(scored: DataFrame, top: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("number").orderBy(F.desc("score"), F.asc("id")))
    return scored.withColumn("rank", rank).where(F.col("rank") <= top)


def _numbered(items: DataFrame, item_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """((number, item), (number, term)): the items with a term, numbered, and their distinct terms."""

    def run(batches):
        for batch in batches:
            for b in blocks(batch, 1):
                own = [sorted(set(terms(t))) for t in b.column(1).to_pylist()]
                at = np.repeat(np.arange(len(own)), [len(x) for x in own])
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array(
                    list(chain.from_iterable(own)), pa.binary())], names=["item", "term"])

    schema = T.StructType([T.StructField("item", items.schema[item_col].dataType),
                           T.StructField("term", T.BinaryType())])
    words = written(_texts(items, text_col, F.col(f"`{item_col}`").alias("item")).mapInArrow(run, schema).distinct(),
                    "search", "words")
    # Written once, so that an item keeps its number.
    names = written(words.select("item").distinct().withColumn("number", F.monotonically_increasing_id()),
                    "search", "items")
    own = names.select(F.col("item").alias("_item"), "number")
    return names, words.join(own, F.col("item").eqNullSafe(F.col("_item"))).select("number", "term")


def _documents_with(docs: DataFrame, text_col: str, items) -> dict[bytes, int]:
    """How many documents hold each term of a block of items."""

    def run(batches):
        df, known = Counter(), items.value.terms.keys()
        for batch in batches:
            for b in blocks(batch, 0):
                for t in b.column(0).to_pylist():
                    df.update(known & set(terms(t)))
        yield pa.RecordBatch.from_arrays([pa.array(list(df), pa.binary()), pa.array(list(df.values()), pa.int64())],
                                         names=["term", "df"])

    counts = _texts(docs, text_col).mapInArrow(run, "term binary, df long").groupBy("term").agg(
        F.sum("df").alias("df"))
    return {bytes(r["term"]): r["df"] for r in counts.collect()}


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", top: int = 50,
           pairs_at_once: int = PAIRS_AT_ONCE) -> DataFrame:
    """(item_col, rank, id_col, score): the ``top`` documents with the highest scores above 0 of each item.

    Equal scores are ranked by ascending id. Defined cases: a null or empty text
    has no term, so such a document or item has no row; equal documents each
    have a rank of their own; rows of ``items`` with one id are one item with the
    terms of all of them, a null id among them; a null document id comes first
    among equal scores; empty tables give no row; other columns are ignored.
    """
    spark = docs.sparkSession
    blocks_ = written(index(docs, id_col, text_col), "search", "index")
    names, pairs = _numbered(items, item_col, item_text_col)
    pairs = written(pairs, "search", "pairs")
    n_docs, n_terms = (int(x) for x in blocks_.agg(
        F.coalesce(F.sum(F.size("keys")), F.lit(0)),
        F.coalesce(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)), F.lit(0))).first())
    parts = -(-max(1, pairs.count()) // pairs_at_once) if n_docs else 0
    results = None
    for part in range(parts):
        rows = pairs.where(F.pmod(F.xxhash64("number"), F.lit(parts)) == part).orderBy("number", "term").collect()
        if not rows:
            continue
        block = Items(rows, top)
        sent = spark.sparkContext.broadcast(block)
        block.weigh(_documents_with(docs, text_col, sent), n_docs, n_terms)
        sent = spark.sparkContext.broadcast(block)
        first = written(_scored(docs, _highest(blocks_, sent), sent, id_col, text_col), "search", "first")
        least = _ranked(first, top).where(F.col("rank") == top).select("number", "score").collect()
        for r in least:
            block.least[block.place[r["number"]]] = r["score"]
        sent = spark.sparkContext.broadcast(block)
        best = _ranked(_scored(docs, _possible(blocks_, sent), sent, id_col, text_col), top)
        best = written(best, "search", "best")
        results = best if results is None else results.unionByName(best)
    if results is None:
        results = spark.createDataFrame([], T.StructType([
            T.StructField("number", T.LongType()), T.StructField("id", docs.schema[id_col].dataType),
            T.StructField("score", T.LongType()), T.StructField("rank", T.IntegerType())]))
    return results.join(names, "number").select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col),
                                                "score")
