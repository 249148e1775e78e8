"""Byte-level BPE encoding and decoding with forced boundaries.

A merge makes a token of the vocabulary, so two neighbouring bytes that stand
next to each other in no token are never merged across: between them there is a
certain cut. Texts are cut there, every fragment is encoded on its own (equal
fragments once, from a bounded memo), and the ids are concatenated.

Two kinds of cut are used. In a text: before ASCII white space that follows
another character, if no token has that character's last byte and the white
space next to each other; the pattern that splits text before the merges ends
a piece there too, and looks no further ahead. It also ends one after a run of
letters, so a plain word is a fragment without the signs behind it. In a piece:
at any byte pair that no token holds.

The fragments of a block of texts that the memo lacks are encoded together, in
numpy: parts of one length are the rows of a matrix, and each step makes the
merge of lowest rank in every row. The memo belongs to the worker process and
has two generations: when the young one is full it becomes the old one, and
what is used again is young again.

The vocabulary file is read on the driver from the path given and sent to the
executors as it is (1.5 MB for 50,000 tokens).
"""

from __future__ import annotations

import heapq
import json
import re
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicklens.llm.common import blocks

#: Fixed value: the pattern of the byte-level pre-tokenizer.
PIECE = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
#: Bytes of a generation of the memo, about; a fragment's own cost beside its characters and ids.
MEMO_BYTES, ENTRY = 40 << 20, 200
#: Fragments encoded together, and characters up to which a fragment is kept and a part goes into a matrix.
TOGETHER, LONG = 1 << 16, 64
#: A plain word: Latin letters, one blank before them perhaps, and no letter behind them.
WORD = r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+(?=[\x00-@\[-`{-\x7f]|\Z)"
NO_MERGE = 1 << 62
READ_AT_ONCE = 1 << 16
#: Bytes of text encoded together, about, and ids decoded together: what they need beside the memo grows with these.
BLOCK, IDS_AT_ONCE = 1 << 20, 1 << 16


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabulary files."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def ending_with(byte: int) -> list[str]:
    """The characters of the basic plane whose UTF-8 ends with a byte."""
    if byte < 0x80:
        return [chr(byte)]
    if byte >= 0xC0:
        return []
    return [chr(c) for c in range(0x80 + (byte & 0x3F), 0x10000, 64) if not 0xD800 <= c < 0xE000]


class Vocabulary:
    """Tokens, merges and forced boundaries of one tokenizer file."""

    def __init__(self, file: bytes):
        spec = json.loads(file)
        alphabet = byte_alphabet()
        vocab = spec["model"]["vocab"]
        raw = {i: bytes(alphabet[c] for c in t) for t, i in vocab.items() if all(c in alphabet for c in t)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes = raw | {i: t.encode() for t, i in self.special.items()}
        self.single = [vocab[c] for c, b in sorted(alphabet.items(), key=lambda x: x[1])]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        # (left, right) -> rank and new id in one number, so that the least is the first merge
        self.merges = {(vocab[a], vocab[b]): rank << 32 | vocab[a + b] for rank, (a, b) in enumerate(pairs)}
        inside = np.zeros((256, 256), bool)
        for t in raw.values():
            b = np.frombuffer(t, np.uint8)
            inside[b[:-1], b[1:]] = True
        # No cut: before white space that may share a token with the last byte of the character
        # before it. Beyond the basic plane, no cut is the simple choice.
        space = " \t\n\r\x0b\x0c"
        rare = "".join(c for c in map(chr, range(0x10000)) if c.isspace() and c not in space)
        kept = [f"[{re.escape(rare)}]"]
        for s in space:
            if last := [c for b in np.flatnonzero(inside[:, ord(s)]).tolist() for c in ending_with(b) if not c.isspace()]:
                kept.append(f"(?<=[{re.escape(''.join(last))}\U00010000-\U0010ffff]){re.escape(s)}")
        self.fragment = re.compile(rf"{WORD}|\s*\S+(?:(?:{'|'.join(kept)})\s*\S+)*|\s+")
        self.cut = ~inside
        order = np.array(sorted((a << 32 | b, m) for (a, b), m in self.merges.items()), np.int64).reshape(-1, 2)
        self.pairs, self.merge = np.append(order[:, 0], NO_MERGE), np.append(order[:, 1], NO_MERGE)
        self.first = np.array(self.single, np.int64)
        self.at_special = re.compile("|".join(map(re.escape, self.special))) if self.special else None

    def ranked(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank and new id of the merge of each pair, in one number; ``NO_MERGE`` where there is none."""
        pair = left << 32 | right
        at = np.searchsorted(self.pairs, pair)
        return np.where(self.pairs[at] == pair, self.merge[at], NO_MERGE)

    def merged_rows(self, ids: np.ndarray):
        """(rows, their ids) for parts of one length: the merge of lowest rank first, the leftmost of equals."""
        rows = np.arange(len(ids))
        could = self.ranked(ids[:, :-1], ids[:, 1:])
        while ids.shape[1] > 1:
            at = could.argmin(axis=1)
            least = could[np.arange(len(ids)), at]
            done = least == NO_MERGE
            if done.any():
                yield rows[done], ids[done]
                rows, ids, could, at, least = (x[~done] for x in (rows, ids, could, at, least))
            if not len(ids):
                return
            each = np.arange(len(ids))
            ids[each, at] = least & 0xFFFFFFFF
            # Every row loses the right one of its pair, so all stay equally long.
            here = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, here + (here > at[:, None]), 1)
            here = here[:-1]
            could = np.take_along_axis(could, here + (here >= at[:, None]), 1)
            for side in (0, 1):
                some = np.flatnonzero(at > 0) if side == 0 else np.flatnonzero(at < ids.shape[1] - 1)
                i = at[some] - 1 + side
                could[some, i] = self.ranked(ids[some, i], ids[some, i + 1])
        yield rows, ids

    def encoded(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces one after the other, number of ids of each piece); no piece is empty."""
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        begins = np.zeros(len(raw), bool)
        begins[1:] = self.cut[raw[:-1], raw[1:]]
        begins[np.r_[0, ends[:-1]]] = True
        start = np.flatnonzero(begins)
        length = np.diff(np.r_[start, len(raw)])
        number, made = np.ones(len(start), np.int64), []
        for n in np.unique(length).tolist():
            own = np.flatnonzero(length == n)
            if n > LONG:
                for i in own.tolist():
                    ids = self._merged_long(self.first[raw[start[i]:start[i] + n]].tolist())
                    number[i] = len(ids)
                    made.append((np.array([i]), np.array([ids], np.int64)))
                continue
            rows = self.first[raw[start[own][:, None] + np.arange(n)]]
            for some, ids in self.merged_rows(rows):
                number[own[some]] = ids.shape[1]
                made.append((own[some], ids))
        place = np.cumsum(number) - number
        out = np.empty(int(number.sum()), np.int32)
        for own, ids in made:
            out[place[own][:, None] + np.arange(ids.shape[1])] = ids
        of_piece = np.searchsorted(start, np.r_[0, ends[:-1]])
        return out, np.add.reduceat(number, of_piece)

    def _merged_long(self, ids: list[int]) -> list[int]:
        """The same with a heap over a linked list, for fragments without a cut for long."""
        n, get = len(ids), self.merges.get
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(m, i, ids[i], ids[i + 1]) for i in range(n - 1) if (m := get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            merge, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = merge & 0xFFFFFFFF, -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if (m := get((ids[i], ids[k]))) is not None:
                    heapq.heappush(heap, (m, i, ids[i], ids[k]))
            if (h := before[i]) >= 0 and (m := get((ids[h], ids[i]))) is not None:
                heapq.heappush(heap, (m, h, ids[h], ids[i]))
        return [x for x in ids if x >= 0]


class Encoder(dict):
    """Memo of fragment -> its ids as int32, in two generations of about ``MEMO_BYTES`` each."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.v, self.old, self.size = vocabulary, {}, 0

    def learn(self, fragments: set[str]) -> None:
        """Make every fragment known; old ones are young again."""
        if self.size >= MEMO_BYTES:
            self.old, self.size = dict(self), 0
            self.clear()
        missing = [f for f in fragments if f not in self]
        again = [f for f in missing if f in self.old]
        self.update((f, self.old[f]) for f in again)
        new = [f for f in missing if f not in self.old] if again else missing
        for i in range(0, len(new), TOGETHER):
            some = new[i:i + TOGETHER]
            split = [[f] if f.isascii() and f.lstrip(" ").isalpha() else PIECE.findall(f) for f in some]
            ids, number = self.v.encoded([p.encode() for p in chain.from_iterable(split)])
            ends = np.cumsum(number)[np.cumsum([len(p) for p in split]) - 1].tolist()
            raw, at = ids.tobytes(), 0
            for f, end in zip(some, ends):
                self[f], at = raw[4 * at:4 * end], end
        self.size += sum(map(len, missing)) * 5 + ENTRY * len(missing)

    def joined(self, texts: list[list[str]]) -> list[bytes]:
        """Ids of texts given by their fragments."""
        self.learn(set().union(*texts))
        made = [b"".join(map(self.__getitem__, t)) for t in texts]
        for f in [f for f in self if len(f) > LONG]:
            del self[f]
        return made

    def _long(self, text: str) -> bytes:
        """A long text, a run of its fragments at a time."""
        found = (m[0] for m in self.v.fragment.finditer(text))
        return b"".join(iter(lambda: self.joined([list(islice(found, READ_AT_ONCE))])[0], b""))

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Ids of whole texts; a special token's string in one is that token."""
        plain, place = [], []
        out: list = [[] for _ in texts]
        for own, text in zip(out, texts):
            at, special = 0, self.v.at_special
            for m in special.finditer(text) if text and special else ():
                own += [text[at:m.start()], np.array([self.v.special[m[0]]], np.int32).tobytes()]
                at = m.end()
            own.append((text or "")[at:])
            for i, part in enumerate(own):
                if isinstance(part, str):
                    if len(part) > 1 << 20:
                        own[i] = self._long(part)
                    else:
                        plain.append(self.v.fragment.findall(part))
                        place.append((own, i))
        for (own, i), ids in zip(place, self.joined(plain)):
            own[i] = ids
        return [b"".join(own) for own in out]

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text])[0]


class Decoder:
    """Bytes of ids, gathered from one buffer of all tokens."""

    def __init__(self, vocabulary: Vocabulary):
        n = max(vocabulary.bytes) + 1
        self.length = np.zeros(n + 1, np.int64)
        for i, t in vocabulary.bytes.items():
            self.length[i] = len(t)
        self.start = np.cumsum(self.length) - self.length
        self.buffer = np.frombuffer(b"".join(vocabulary.bytes.get(i, b"") for i in range(n)), np.uint8)
        self.n = n

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, number of bytes of each id); ids that the vocabulary lacks, and nulls as -1, give none."""
        ids = np.where((ids < 0) | (ids >= self.n), self.n, ids)
        length = self.length[ids]
        raw, at = np.empty(int(length.sum()), np.uint8), 0
        for i in range(0, len(ids), IDS_AT_ONCE):
            own = length[i:i + IDS_AT_ONCE]
            end = np.cumsum(own)
            shift = np.repeat(self.start[ids[i:i + IDS_AT_ONCE]] - (end - own), own)
            raw[at:at + shift.size] = self.buffer[shift + np.arange(shift.size)]
            at += shift.size
        return raw, length


@lru_cache(maxsize=2)
def _vocabulary(file: bytes) -> Vocabulary:
    return Vocabulary(file)


@lru_cache(maxsize=1)
def _encoder(file: bytes) -> Encoder:
    """The worker's own, so that its memo serves all tasks of the worker."""
    return Encoder(_vocabulary(file))


def _file(df: DataFrame, path: str):
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(df: DataFrame, path: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """``df`` with ``out``, the token ids of ``text_col``, in the place of that column.

    Defined cases: an empty or null text has no ids; a text of any length and
    without any cut is encoded whole; a column that is already named ``out`` is
    replaced; an empty table gives an empty one; repeated rows stay.
    """
    rest = [c for c in df.columns if c not in (text_col, out)]
    schema = T.StructType([*(df.schema[c] for c in rest), T.StructField(out, T.ArrayType(T.IntegerType()))])
    file = _file(df, path)

    def run(batches):
        memo = _encoder(file.value)
        for batch in batches:
            for b, lists in _encoded(memo, batch, len(rest)):
                yield pa.RecordBatch.from_arrays([*b.columns[:len(rest)], lists], names=schema.names)

    return df.select(*[F.col(f"`{c}`") for c in rest], F.col(text_col)).mapInArrow(run, schema)


def _id_lists(made: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, made)]) // 4
    ids = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(made))])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids)


def _encoded(memo: Encoder, batch, col: int):
    """(slice of the batch, the ids of its texts), a block at a time."""
    for b in blocks(batch, col, BLOCK):
        yield b, _id_lists(memo.encode_all(b.column(col).to_pylist()))


def _texts(decoder: Decoder, lists) -> pa.Array:
    """The texts of lists of ids: all ids in one gather, then cut by the lengths of their tokens."""
    number = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    ids = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
    raw, length = decoder.decode(ids)
    ends = np.r_[0, np.cumsum(length)][np.r_[0, np.cumsum(number)]]
    out = pa.Array.from_buffers(pa.large_string(), len(lists), [None, pa.py_buffer(ends.astype(np.int64)),
                                                               pa.py_buffer(raw)])
    try:
        out.validate(full=True)
    except pa.ArrowInvalid:
        return pa.array([raw[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(ends, ends[1:])], pa.string())
    return out.cast(pa.string())


def decode(df: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with ``out``, the text of the ids in ``ids_col``.

    Special tokens are written out; bytes that are no UTF-8 become U+FFFD.
    Defined cases: null or no ids give the empty text; unknown ids and null
    ids give nothing; a column that is already named ``out`` is replaced.
    """
    rest = [c for c in df.columns if c != out]
    schema = T.StructType([*(df.schema[c] for c in rest), T.StructField(out, T.StringType())])
    file = _file(df, path)

    def run(batches):
        decoder = Decoder(_vocabulary(file.value))
        for batch in batches:
            texts = _texts(decoder, batch.column(rest.index(ids_col)))
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=schema.names)

    return df.select(*[F.col(f"`{c}`") for c in rest]).mapInArrow(run, schema)


def encoded_and_decoded(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``ids`` and ``decoded`` in the place of the text: both operators in one pass.

    The cases of both hold; columns already named ``ids`` or ``decoded`` are replaced.
    """
    rest = [c for c in docs.columns if c not in (text_col, "ids", "decoded")]
    schema = T.StructType([*(docs.schema[c] for c in rest), T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("decoded", T.StringType())])
    file = _file(docs, path)

    def run(batches):
        memo, decoder = _encoder(file.value), Decoder(_vocabulary(file.value))
        for batch in batches:
            for b, lists in _encoded(memo, batch, len(rest)):
                yield pa.RecordBatch.from_arrays([*b.columns[:len(rest)], lists, _texts(decoder, lists)],
                                                 names=schema.names)

    return docs.select(*[F.col(f"`{c}`") for c in rest], F.col(text_col)).mapInArrow(run, schema)
