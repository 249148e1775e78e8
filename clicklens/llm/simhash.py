"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at distance d <= r meet at some point between them. Every
fingerprint emits the variants within half the radius, the variants are
shuffled, and fingerprints that emitted the same variant are linked after their
distance is verified.

For an odd r, half of it is no whole number. The two ends of a distance of
exactly r have bit counts of different parity, so it is enough that those with
an even count also emit variants at ``(r + 1) / 2`` flips; and as the bits are
dealt to two classes, of any r bits ``(r + 1) / 2`` lie in one class, so flips
within one class are enough. With r = 3 an even fingerprint emits 1,057
variants, an odd one 65.

Equal fingerprints are merged before, so a variant can be emitted by a fixed
number of fingerprints only (2,017 at r = 3), whatever the size of the groups of
copies. Within a variant, all others are linked to one *hub* that is at most
``r // 2`` flips away from it: any such link is at most r long, and any two
fingerprints that both are farther away, yet within r, share another variant
where both are near. So no pairs are listed and no link is lost.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from clicklens.llm.common import blocks, without, written
from clicklens.llm.components import components

BITS = 64
SEED = 42
BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The fingerprint of one text, as a signed 64-bit integer; 0 without a word."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        run = zip(*(words[i:] for i in range(shingle)))
        hashes = [xxhash.xxh64_intdigest(s, SEED) for s in map(b" ".join, run)]
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), BLOCK):
        part = np.array(hashes[i:i + BLOCK], "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text",
                 mark: Column | None = None) -> DataFrame:
    """(id, fp) of every document, and ``mark`` if one is given; ``bytes.lower`` and ``bytes.split`` are the contract's
    ASCII rules."""
    kind = docs.schema[id_col].dataType
    more = [] if mark is None else [mark.alias("mark")]
    names = ["id", "fp", "mark"][:2 + len(more)]

    def run(batches):
        for batch in batches:
            for b in blocks(batch, 1):
                fps = pa.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], pa.int64())
                yield pa.RecordBatch.from_arrays([b.column(0), fps, *b.columns[2:]], names=names)

    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *more)
    schema = T.StructType([T.StructField("id", kind), T.StructField("fp", T.LongType()),
                           *([read.schema["mark"]] if more else [])])
    return read.mapInArrow(run, schema)


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def masks(radius: int) -> tuple[list[int], list[int]]:
    """Flip masks of every fingerprint, and those that an even one emits besides."""
    flips = [1 << i for i in range(BITS)]
    near = [sum(c) for k in range(radius // 2 + 1) for c in combinations(flips, k)]
    half = (radius + 1) // 2
    far = [sum(c) for part in (flips[::2], flips[1::2]) for c in combinations(part, half)] if radius % 2 else []
    return [_signed(m) for m in near], [_signed(m) for m in far]


def links(fps: DataFrame, radius: int = 3) -> DataFrame:
    """(u, v): verified links that join all distinct fingerprints ``fp`` within ``radius`` bits."""
    near, far = masks(radius)
    even = F.bit_count("fp") % 2 == 0
    flips = F.when(even, F.lit(np.array(near + far, np.int64))).otherwise(F.lit(np.array(near, np.int64)))
    # The fingerprints are small and their variants are not: spread them before they multiply. They come
    # partitioned by ``fp`` and put together in few tasks, and a number of partitions alone would be dropped
    # as needless; by another key it is a shuffle of its own.
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    emitted = fps.repartition(parts, F.xxhash64("fp")).select("fp", F.explode(flips).alias("mask")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"))
    away = F.bit_count(F.col("fp").bitwiseXOR(F.col("variant"))) > radius // 2
    order = W.partitionBy("variant").orderBy(away, "fp")
    hub = F.first(F.when(~away, F.col("fp"))).over(order)
    met = emitted.select("fp", hub.alias("hub")).where("fp <> hub")
    return met.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("hub"))) <= radius).select(
        F.greatest("fp", "hub").alias("u"), F.least("fp", "hub").alias("v")).distinct()


def _best(own: DataFrame, low: Column, radius: int) -> DataFrame:
    """(fp, best) of every distinct fingerprint: the least ``low`` of its component."""
    distinct = own.groupBy("fp").agg(low.alias("low"))
    part = components(links(distinct.select("fp"), radius), "simhash")
    named = distinct.join(part, distinct["fp"] == part["vertex"], "left").select(
        "fp", "low", F.coalesce("component", "fp").alias("component"))
    least = named.groupBy("component").agg(F.min("low").alias("best"))
    return named.join(least, "component").select("fp", "best")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id.

    Documents whose fingerprints differ in ``radius`` bits at most are linked;
    ``component_id`` is the smallest id that can be reached. Defined cases: a
    text without a word, empty or null, has fingerprint zero and is linked like
    any other; a null id never names a component that has another id; repeated
    rows each get the same result; an empty table gives an empty result;
    further columns are not read.
    """
    own = written(fingerprints(docs, shingle, id_col, text_col), "simhash", "fingerprints")
    by_fp = _best(own, F.min("id"), radius).withColumnRenamed("best", "component_id")
    return own.join(by_fp, "fp").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, shingle: int = 3, radius: int = 3, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One document of each component, that with its smallest id, with the columns as they were.

    Rows are looked up by id and SHA-256 of the text, so documents that share an
    id, or have none, are judged apart. Of a component's rows with the smallest
    id, the one with the least digest stays; a null id stays only in a component
    without another. Where a whole pair of id and text is repeated (a null text
    is an empty one), one of its rows stays.
    """
    mark = F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    own = written(fingerprints(docs, shingle, id_col, text_col, mark), "simhash", "fingerprints")
    by_fp = _best(own, F.min(F.struct(F.col("id").isNull().alias("none"), "id", "mark")), radius)
    stay = F.col("id").eqNullSafe(F.col("best")["id"]) & (F.col("mark") == F.col("best")["mark"])
    groups = written(own.join(by_fp, "fp").select(
        F.col("id").alias("_id"), F.col("mark").alias("_mark"), stay.alias("stay")), "simhash", "groups")
    gone = groups.where("not stay").select("_id", "_mark").distinct()
    twice = groups.where("stay").groupBy("_id", "_mark").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(
        "_id", "_mark")
    return without(docs, [F.col(id_col), mark], gone, twice)
