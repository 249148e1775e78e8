"""Secret scans over a content-addressed ledger.

Every historical version of a text is addressed by the SHA-256 of its content.
The ledger, a table in a shared folder, holds one row for each (blob, rule
version) that was ever scanned, with its findings, none included. A run scans
the blobs that the ledger lacks under the present rules, each once however
many paths hold it, appends them, and joins the findings back to all paths.

Beside the base rules there are rules for key blocks, tokens of known providers,
signed web tokens, passwords in addresses, and strings too random to be words;
their findings are added where no rule listed before has one. The rules' version
is a hash of their patterns, so changed rules scan again and unchanged ones never do. A run that is lost before its append leaves the
ledger as it was; a batch that was appended twice counts once, as rows of one
(blob, rule version) are equal.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicklens.llm.common import blocks

#: kind, pattern, group whose length counts, least length, what a text must hold for a match.
#: Fixed values. A run of hexadecimal digits is one match of ``[0-9a-f]+``, so asking for 24 at
#: once finds the same; the same holds for the access keys.
RULES = (
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, ":="),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20, ""),
    ("hex", r"[0-9a-f]{24,}", 0, 24, ""),
)
#: Added rules, with the strings of which a text must hold one, and least bits of entropy a character.
#: Every pattern starts where a run starts or ends at a sign that no run holds, so time is linear in the text.
MORE_RULES = (
    ("key_block", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----(?:[A-Za-z0-9+/=\s]*+-----END [A-Z ]{0,40}PRIVATE KEY-----)?",
     0, 20, ("-----BEGIN",)),
    ("github", r"(?:gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{22,})", 0, 22, ("ghp_", "gho_", "ghu_", "ghs_",
                                                                                   "ghr_", "github_pat_")),
    ("slack", r"xox[abeoprs]-[A-Za-z0-9-]{10,}", 0, 15, ("xox",)),
    ("google", r"AIza[A-Za-z0-9_-]{35,}", 0, 39, ("AIza",)),
    ("stripe", r"[prs]k_(?:live|test)_[A-Za-z0-9]{16,}", 0, 24, ("k_live_", "k_test_")),
    ("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{6,}+\.[A-Za-z0-9_-]{6,}+\.[A-Za-z0-9_-]{6,}", 0, 23, ("eyJ",)),
    ("url_password", r"://[^\s/:@]{1,256}:([^\s/:@]{3,256})@", 1, 3, ("://",)),
    ("random", r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{32,}+={0,2}", 0, 32, (), 4.3),
)
ALL_RULES = RULES + MORE_RULES
BASE_KINDS = tuple(r[0] for r in RULES)
EITHER_CASE = {"assign"}

FINDINGS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                                     T.StructField("end", T.IntegerType())]))
ARROW_FINDINGS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
LEDGER = T.StructType([T.StructField("blob", T.BinaryType()), T.StructField("rules", T.StringType()),
                       T.StructField("findings", FINDINGS)])


def rule_version(rules=ALL_RULES) -> str:
    return hashlib.sha256(json.dumps(rules).encode()).hexdigest()[:16]


def entropy(text: str) -> float:
    """Bits a character, by the text's own frequencies."""
    return -sum(n / len(text) * math.log2(n / len(text)) for n in Counter(text).values())


def find(text: str, rules=ALL_RULES) -> list[dict]:
    """Spans of all kinds by start, then kind as listed; leftmost, not overlapping within a kind.

    A span of an added rule that overlaps one of a rule listed before is that one again, and left out."""
    out, taken = [], []
    for order, (kind, pattern, group, least, needs, *bits) in enumerate(rules):
        if needs and not any(c in text for c in needs):
            continue
        flags = re.ASCII | (re.IGNORECASE if kind in EITHER_CASE else 0)
        for m in re.compile(pattern, flags).finditer(text):
            start, end = m.span(group if kind not in BASE_KINDS else 0)
            if m.end(group) - m.start(group) < least or bits and entropy(m[0]) < bits[0]:
                continue
            if kind not in BASE_KINDS and any(s < end and start < e for s, e in taken):
                continue
            out.append((start, order, {"kind": kind, "start": start, "end": end}))
        taken += [(x[2]["start"], x[2]["end"]) for x in out[len(taken):]]
    return [x[2] for x in sorted(out, key=lambda x: x[:2])]


def _scan(unseen: DataFrame, rules) -> DataFrame:
    version = rule_version(rules)

    def run(batches):
        for batch in batches:
            for b in blocks(batch, 1):
                found = pa.array([find(t or "", rules) for t in b.column(1).to_pylist()], ARROW_FINDINGS)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array([version] * b.num_rows, pa.string()), found], names=LEDGER.names)

    return unseen.mapInArrow(run, LEDGER)


def read_ledger(history: DataFrame, path: str) -> DataFrame | None:
    """The ledger at ``path``, or None before the first run."""
    spark = history.sparkSession
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(fs_path):
        return None
    return spark.read.schema(LEDGER).parquet(path)


def _blob(text_col: str):
    text = F.coalesce(F.col(text_col), F.lit(""))
    return F.unhex(F.sha2(text, 256)).alias("blob"), text.alias("content")


def scan_unseen(history: DataFrame, ledger: str, text_col: str = "text", rules=ALL_RULES) -> None:
    """Scan the blobs of ``history`` that the ledger lacks under the present rules, and append them to it."""
    # Copies are dropped where they are read, before the shuffle; the ledger's keys meet them after it.
    unseen = history.select(*_blob(text_col)).groupBy("blob").agg(F.first("content").alias("content"))
    known = read_ledger(history, ledger)
    if known is not None:
        unseen = unseen.join(known.where(F.col("rules") == rule_version(rules)).select("blob"), "blob", "left_anti")
    _scan(unseen, rules).write.mode("append").parquet(ledger)


def findings(history: DataFrame, ledger: str, text_col: str = "text", rules=ALL_RULES) -> DataFrame:
    """``history`` with ``blob`` and ``findings`` from the ledger, without the text; reads the ledger as it is now."""
    rest = [c for c in history.columns if c not in (text_col, "blob", "findings")]
    now = read_ledger(history, ledger).where(F.col("rules") == rule_version(rules)).select("blob", "findings")
    found = now.where(F.size("findings") > 0).dropDuplicates(["blob"])
    paths = history.select(*[F.col(f"`{c}`") for c in rest], _blob(text_col)[0])
    return paths.join(found, "blob", "left").select(
        *[F.col(f"`{c}`") for c in rest], "blob", F.coalesce("findings", F.array().cast(FINDINGS)).alias("findings"))


def scan(history: DataFrame, ledger: str, text_col: str = "text", rules=ALL_RULES) -> DataFrame:
    """``history`` (any path columns, one row for each version) with ``blob`` and ``findings``, without the text.

    Scans what the ledger at the path ``ledger`` lacks and appends it there.
    Defined cases: a null text is the empty blob; repeated rows and equal texts
    share one scan and each get its findings; an empty table appends nothing; a
    text of any length is scanned whole; path columns may have any name but
    those two.
    """
    scan_unseen(history, ledger, text_col, rules)
    return findings(history, ledger, text_col, rules)
