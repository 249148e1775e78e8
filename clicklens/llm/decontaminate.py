"""Benchmark decontamination (DataFrame functions only).

The benchmark's normalised n-grams form the set; one scan of the training texts
looks up every window of every size. The look-up goes by a 64-bit key over
three of the window's word hashes (first, middle, last) and carries no words:
those are fetched for the documents with a hit alone, and a hit is verified by
comparing all its words. Hits become word counts per document, or take out
spans or documents. The work grows with the length of a text.

The set of keys, the documents with hits and the windows' words are each
broadcast only if they are at most ``max_bytes``, measured as written tables; a
larger one is joined by shuffle on the same key instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicklens.llm.common import ascii_lower, fresh, without, written
from clicklens.operators.lookup import MAX_BROADCAST_BYTES, file_bytes

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text after lowering A-Z; none for a null text."""
    parts = F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD)
    return F.filter(parts, lambda w: w != "")


def _window_key(h: Column, i: Column, size: Column) -> Column:
    """Key of the window of ``size`` words that starts at word ``i`` (from 0)."""
    return F.xxhash64(F.get(h, i), F.get(h, i + F.floor(size / 2).cast("int")), F.get(h, i + size - 1))


def _starts(n: Column, size: int) -> Column:
    """0 .. n - size, or no start at all."""
    return F.when(n >= size, F.sequence(F.lit(0), n - size)).otherwise(F.array().cast("array<int>"))


def benchmark_windows(bench: DataFrame, n: int = 13, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(size, key, window, items) for each distinct window of the benchmark.

    A window is ``n`` consecutive words of an item; an item of fewer words, but
    not none, is one window. Nulls and items without a word have none.
    """
    items = bench.select(F.col(id_col).alias("item"), words(F.col(text_col)).alias("w"))
    items = items.withColumn("size", F.least(F.size("w"), F.lit(n))).where("size > 0")
    cut = items.select("item", "size", F.explode(F.transform(
        F.sequence(F.lit(0), F.size("w") - F.col("size")),
        lambda i: F.slice(F.col("w"), i + 1, F.col("size")))).alias("window"))
    h = F.transform("window", lambda w: F.xxhash64(w))
    key = _window_key(h, F.lit(0), F.col("size"))
    return cut.groupBy("size", "window").agg(F.collect_set("item").alias("items")).withColumn("key", key)


def hits(docs: DataFrame, bench: DataFrame, n: int = 13, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """(id, mark, pos, size, items): every occurrence of a window in a document.

    ``pos`` counts words from 0, ``items`` are the benchmark items that hold the
    window, and ``mark`` is a hash of the text, so that rows which share an
    identifier stay apart.
    """
    windows = written(benchmark_windows(bench, n, item_col), "decontaminate", "windows")
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect())
    own = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("mark"), F.col(text_col).alias("text"))
    if not sizes:
        return own.where("false").select("id", "mark", F.lit(0).alias("pos"), F.lit(0).alias("size"),
                                         F.array().cast(windows.schema["items"].dataType).alias("items"))
    keys = _side(windows.select("size", "key").distinct(), max_bytes)
    cut = own.select("id", "mark", F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("h"))
    every = F.concat(*[_keys(F.col("h"), size) for size in sizes])
    near = cut.select("id", "mark", F.inline(every)).join(keys, ["size", "key"], "left_semi")
    there = _side(near.groupBy(F.col("id").alias("_id"), F.col("mark").alias("_mark")).agg(
        F.collect_set(F.struct("pos", "size", "key")).alias("at")), max_bytes)
    both = F.col("id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark"))
    w = own.join(there, both).select("id", "mark", words(F.col("text")).alias("w"), "at")
    # Named twice in the lambda, so that the optimizer does not cut the text again for each window.
    here = F.transform("at", lambda a: F.struct(a["pos"].alias("pos"), a["size"].alias("size"), a["key"].alias("key"),
                                                F.when(F.size("w") > 0, F.slice("w", a["pos"] + 1, a["size"]))
                                                .alias("window")))
    lookup = _side(windows.select("size", "key", F.col("window").alias("_window"), "items"), max_bytes)
    hit = w.select("id", "mark", F.inline(here)).join(lookup, ["size", "key"]).where(F.col("window") == F.col("_window"))
    return hit.select("id", "mark", "pos", "size", "items")


def _keys(h: Column, size: int) -> Column:
    """(pos, size, key) of every window of ``size`` words, from the words' hashes."""
    return F.transform(_starts(F.size(h), size), lambda i: F.struct(
        i.alias("pos"), F.lit(size).alias("size"), _window_key(h, i, F.lit(size)).alias("key")))


def _side(side: DataFrame, max_bytes: int) -> DataFrame:
    """``side`` as a written table, broadcast if its files are small enough."""
    stored = written(side, "decontaminate", "side")
    return F.broadcast(stored) if file_bytes(stored) <= max_bytes else stored


def contamination(docs: DataFrame, bench: DataFrame, n: int = 13, share: int = 20, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id",
                  max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """One row per document: id, n_words, n_hit, items, spans, contaminated, mark.

    ``n_hit`` counts words inside any occurrence of a window, ``items`` lists
    the items with occurring windows sorted as strings, ``spans`` the windows
    as (pos, size). Contaminated: ``n_hit > 0`` and ``share * n_hit >= n_words``.

    Defined cases: a null or empty text has no words and no hits; an empty
    benchmark leaves every document clean; repeated rows each get the same
    result; a null identifier is one like any other; further columns are not
    read.
    """
    found = hits(docs, bench, n, id_col, text_col, item_col, max_bytes)
    per_doc = found.groupBy(F.col("id").alias("_id"), F.col("mark").alias("_mark")).agg(
        F.array_sort(F.collect_set(F.struct("pos", "size"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.col("items").cast("array<string>"))))).alias("items"))
    inside = F.flatten(F.transform("spans", lambda s: F.sequence(s["pos"], s["pos"] + s["size"] - 1)))
    per_doc = per_doc.withColumn("n_hit", F.size(F.array_distinct(inside)).cast("long"))
    base = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("mark"),
                       F.size(words(F.col(text_col))).cast("long").alias("n_words"))
    both = F.col("id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark"))
    out = base.join(per_doc, both, "left").withColumn("n_hit", F.coalesce("n_hit", F.lit(0).cast("long")))
    return out.select(
        F.col("id").alias(id_col), "n_words", "n_hit",
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<pos:int,size:int>>")).alias("spans"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))).alias("contaminated"), "mark")


def without_contaminated(docs: DataFrame, bench: DataFrame, n: int = 13, share: int = 20, id_col: str = "doc_id",
                         text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """The documents that are not contaminated, with their columns as they were."""
    found = hits(docs, bench, n, id_col, text_col, item_col)
    inside = F.flatten(F.transform("at", lambda s: F.sequence(s["pos"], s["pos"] + s["size"] - 1)))
    per_doc = found.groupBy("id", "mark").agg(F.collect_set(F.struct("pos", "size")).alias("at")).select(
        "id", "mark", F.size(F.array_distinct(inside)).alias("hit"))
    # The number of words is counted again for the documents with hits alone.
    own = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_mark"), F.col(text_col).alias("_text"))
    both = F.col("id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark"))
    much = own.join(_side(per_doc, MAX_BROADCAST_BYTES), both).where(
        F.col("hit") * share >= F.size(words(F.col("_text"))))
    gone = _side(much.select("_id", "_mark").distinct(), MAX_BROADCAST_BYTES)
    return without(docs, [F.col(id_col), F.xxhash64(text_col)], gone)


def without_spans(docs: DataFrame, bench: DataFrame, n: int = 13, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id") -> DataFrame:
    """The documents with their hit words taken out, as ``clean_words`` (the words that are left, lowered);
    a column already named so is replaced."""
    docs = docs.drop("clean_words")
    own_id, own_mark, w, id_, mark, gone = fresh(docs, "own_id", "own_mark", "w", "id_", "mark", "gone")
    found = hits(docs, bench, n, id_col, text_col, item_col)
    inside = F.array_distinct(F.flatten(F.transform("at", lambda s: F.sequence(s["pos"], s["pos"] + s["size"] - 1))))
    per_doc = found.groupBy(F.col("id").alias(id_), F.col("mark").alias(mark)).agg(
        F.collect_set(F.struct("pos", "size")).alias("at")).select(id_, mark, inside.alias(gone))
    marked = docs.withColumns({own_id: F.col(id_col), own_mark: F.xxhash64(text_col), w: words(F.col(text_col))})
    both = F.col(own_id).eqNullSafe(F.col(id_)) & (F.col(own_mark) == F.col(mark))
    left = F.array_except(F.sequence(F.lit(0), F.size(w) - 1), F.col(gone))
    kept = F.transform(left, lambda i: F.get(F.col(w), i))
    return (marked.join(per_doc, both, "left")
            .withColumn("clean_words", F.when(F.col(gone).isNull(), F.col(w)).otherwise(kept))
            .drop(own_id, own_mark, w, id_, mark, gone))
