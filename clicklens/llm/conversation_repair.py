"""Conversation structure repair by depth-first branch-and-bound.

A conversation is its rows by turn (nulls first; rows of one turn by role, then
by the SHA-256 of the text). A row's first fault counts: blank (nothing but
white space), duplicate (role and text as in an earlier row), truncated (its
last visible character ends no sentence). Edits turn the rows into a
conversation whose roles' initials read ``(s?(ua)+)?``:

* K keeps a row, free; R gives it the role user or assistant, 3; a truncated
  row costs 3 more in both cases;
* D deletes a row, 4; a blank or duplicate row has to go;
* I inserts an empty row of user or assistant, 3.

The cheapest edits are found by depth-first branch-and-bound. A node is a row
and a state of the grammar. Prefixes wait on an explicit stack, their next edits
in ASCII order. A backward pass gives each node a lower bound of what its suffix
costs (the grammar holds, audits are left out of account). The incumbent is the
cheapest repair so far, the ASCII-least audit of equal ones; the first dive
follows the lowest bounds. A prefix goes if its cost and bound exceed the
incumbent's cost, if at equal cost its audit is greater, or if the table of its
node knows a prefix no worse. An empty stack proves the incumbent optimal. Two
prefixes of equal cost at one node have the same number of edits of each price,
so neither audit begins the other and the lesser one stays so with any suffix.

A conversation may hold any share of all rows. Rows, without their texts, are
range-partitioned by conversation and turn and cut into pieces of ``PIECE`` rows
at most; for a piece that may not be a whole conversation, the search runs from
each state of the grammar to each. The same search then goes over the pieces. The
digest of a repaired conversation is a chain over its texts, so one task reads
them in order; it keeps one row and the audit in memory.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of a piece, at most.
PIECE = 1024
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
WHITE = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")

#: States of the grammar: nothing yet, after s, after u, after a. A conversation ends in START or ASSISTANT.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where a row's kind (s, u, a) leads from each state.
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
#: The state after an inserted row, or one whose role is changed: the only role that fits.
FITS = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
INFINITE = 1 << 60

#: A row's fault in one character each.
NONE, BLANK, DUPLICATE, CUT = "-", "b", "d", "t"


def _edits(kind: str, fault: str, state: int):
    """(letter, next state, cost, rows read) of the edits of a row, in ASCII order."""
    yield "D", state, DELETE, 1
    yield "I", FITS[state], INSERT, 0
    if fault in (BLANK, DUPLICATE):
        return
    extra = TRUNCATED if fault == CUT else 0
    if (state, kind) in NEXT:
        yield "K", NEXT[state, kind], extra, 1
    yield "R", FITS[state], REROLE + extra, 1


def _suffix_bounds(kinds: str, faults: str, end: list[int]) -> list[list[int]]:
    """Least cost from each row and state on, given what each state costs after the last row."""
    def inserted(c):
        # At most two rows are worth inserting at one place: after a third the state was there before.
        return [min(c[s], INSERT + c[FITS[s]], 2 * INSERT + c[FITS[FITS[s]]]) for s in range(4)]

    out = [inserted(end)]
    for kind, fault in zip(reversed(kinds), reversed(faults)):
        after = out[-1]
        out.append(inserted([min(cost + after[to] for _, to, cost, read in _edits(kind, fault, s) if read)
                             for s in range(4)]))
    out.reverse()
    return out


def search(kinds: str, faults: str, start: int, end: list[int]) -> tuple[int, str, int]:
    """(cost, audit, last state) of the cheapest edits of some rows, the ASCII-least audit of equal ones.

    ``end`` has what each state costs after the last row, ``INFINITE`` where a repair cannot end.
    """
    n, bounds = len(kinds), _suffix_bounds(kinds, faults, end)
    if bounds[0][start] >= INFINITE:
        return INFINITE, "", start
    incumbent: tuple[int, bytes, int] = (INFINITE, b"", start)
    known: dict[tuple[int, int], int] = {}
    path = bytearray()
    # (row, state, cost, edits so far, last edit)
    stack = [(0, start, 0, 0, "")]
    while stack:
        i, state, cost, depth, letter = stack.pop()
        del path[max(0, depth - 1):]
        path += letter.encode()
        least = cost + bounds[i][state]
        if least > incumbent[0] or (least == incumbent[0] and path > incumbent[1][:depth]):
            continue
        # Prefixes come in ASCII order below the first dive, so one that is no cheaper is no better.
        if known.get((i, state), INFINITE) <= cost:
            continue
        known[i, state] = cost
        if i == n and end[state] + cost == least:
            incumbent = (least, bytes(path), state)
            continue
        nodes = [(i + read, to, cost + price, depth + 1, edit) for edit, to, price, read in
                 (_edits(kinds[i], faults[i], state) if i < n else [("I", FITS[state], INSERT, 0)])]
        nodes.reverse()
        if incumbent[0] == INFINITE:
            # The first dive goes to the lowest bound, the ASCII-least of equals; the others wait below it.
            best = min(nodes, key=lambda x: (x[2] + bounds[x[0]][x[1]], x[4]))
            nodes.remove(best)
            nodes.append(best)
        stack += nodes
    return incumbent[0] - end[incumbent[2]], incumbent[1].decode(), incumbent[2]


@dataclass
class Piece:
    """Rows of one conversation that follow each other, and what the conversation needs of them."""

    kinds: list[str] = field(default_factory=list)
    faults: list[str] = field(default_factory=list)
    low: int | None = None
    high: int | None = None
    turns: int = 0
    illegal: int = 0

    def add(self, turn, kind: str, fault: str) -> None:
        if self.kinds and self.kinds[-1] + kind not in ("su", "ua", "au"):
            self.illegal += 1
        self.kinds.append(kind)
        self.faults.append(fault)
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.turns += 1

    def repairs(self, whole: bool) -> list[tuple[int, int, int, str]]:
        """(from state, to state, cost, audit): of a whole conversation its repair only."""
        kinds, faults = "".join(self.kinds), "".join(self.faults)
        if whole:
            cost, audit, last = search(kinds, faults, START, [0, INFINITE, INFINITE, 0])
            return [(START, last, cost, audit)]
        found = []
        for a in range(4):
            for b in range(4):
                cost, audit, _ = search(kinds, faults, a, [0 if s == b else INFINITE for s in range(4)])
                if cost < INFINITE:
                    found.append((a, b, cost, audit))
        return found


def joined(tables: list[list[tuple[int, int, int, str]]]) -> tuple[int, str]:
    """(cost, audit) of a conversation from the repairs of its pieces: the ASCII-least way of lowest bound."""
    bounds = [[0, INFINITE, INFINITE, 0]]
    for table in reversed(tables):
        after = bounds[-1]
        bounds.append([min([c + after[b] for a, b, c, _ in table if a == s], default=INFINITE) for s in range(4)])
    bounds.reverse()
    state, parts, total = START, [], 0
    for table, after in zip(tables, bounds[1:]):
        # Every piece's repairs of equal cost cover the same rows, so the least audit is the least beginning.
        _, audit, to, cost = min((c + after[b], audit, b, c) for a, b, c, audit in table if a == state)
        parts.append(audit)
        state, total = to, total + cost
    return total, "".join(parts)


def _faulty(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows as (conv, turn, role, digest, kind, fault), without their texts."""
    seen, first = F.rtrim(F.col(f"`{text}`"), F.lit(WHITE)), F.substring(F.col(f"`{role}`"), 1, 1)
    df = rows.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"),
                     F.col(f"`{role}`").alias("role"), F.sha2(F.col(f"`{text}`"), 256).alias("digest"),
                     F.when(first.isin("s", "u", "a"), first).otherwise("x").alias("kind"),
                     F.when(seen == "", BLANK).when(F.substring(seen, -1, 1).isin(*ENDS), NONE)
                     .otherwise(CUT).alias("fault"))
    again = F.row_number().over(Window.partitionBy("conv", "role", "digest").orderBy("turn")) > 1
    return df.withColumn("fault", F.when((F.col("fault") != BLANK) & again, DUPLICATE).otherwise(F.col("fault")))


ORDER = ("conv", "turn", "role", "digest")
PIECES = ("part int, place long, rows long, low long, high long, turns long, illegal long, first string, "
          "last string, blank long, duplicate long, truncated long, "
          "repairs array<struct<a:int,b:int,cost:long,audit:string>>")


def _pieces(faulty: DataFrame, size: int) -> DataFrame:
    """A row for each piece, ``part`` and ``place`` in the order of the conversation."""
    schema = T.StructType([faulty.schema["conv"], *T._parse_datatype_string(PIECES).fields])

    def run(batches):
        part, place, conv, piece, inside = TaskContext.get().partitionId(), 0, None, None, False
        made = []

        def close(ended: bool):
            whole = inside and ended
            f = piece.faults
            made.append((conv, part, place, len(f), piece.low, piece.high, piece.turns, piece.illegal, piece.kinds[0],
                         piece.kinds[-1], f.count(BLANK), f.count(DUPLICATE), f.count(CUT),
                         [dict(zip(("a", "b", "cost", "audit"), r)) for r in piece.repairs(whole)]))

        def flush():
            cols = [pa.array(c, k) for c, k in zip(zip(*made), kinds)]
            made.clear()
            return pa.RecordBatch.from_arrays(cols, names=schema.names)

        kinds, key = None, object()
        for batch in batches:
            if kinds is None:
                kinds = [batch.schema.field(0).type, pa.int32(), *[pa.int64()] * 6, pa.string(), pa.string(),
                         *[pa.int64()] * 3, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()),
                                                                ("cost", pa.int64()), ("audit", pa.string())]))]
            for own, turn, kind, fault in zip(*[c.to_pylist() for c in batch.columns]):
                if piece is None or own != key:
                    # Only a conversation that begins and ends inside this partition is known to be whole.
                    if piece is not None:
                        close(True)
                    inside, place = piece is not None, place + 1
                    key = conv = own
                    piece = Piece()
                elif len(piece.kinds) >= size:
                    inside = False
                    close(False)
                    place, piece = place + 1, Piece()
                piece.add(turn, kind, fault)
                if len(made) >= 1024:
                    yield flush()
        if piece is not None:
            close(False)
        if made:
            yield flush()

    rows = faulty.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    return rows.select("conv", F.col("turn").cast("long").alias("turn"), "kind", "fault").mapInArrow(run, schema)


VERDICT = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")


def _verdicts(pieces: DataFrame) -> DataFrame:
    """A row for each conversation: its faults, and the cheapest edits."""
    schema = T.StructType([pieces.schema["conv"], *T._parse_datatype_string(VERDICT).fields])

    def verdict(conv, own):
        low, high, turns, illegal, last = None, None, 0, 0, ""
        for p in own:
            if p["turns"]:
                low = p["low"] if low is None else low
                turns += p["turns"] - (p["low"] == high)
                high = p["high"]
            illegal += p["illegal"] + bool(last and last + p["first"] not in ("su", "ua", "au"))
            last = p["last"]
        cost, audit = joined([[tuple(r.values()) for r in p["repairs"]] for p in own])
        return (conv, 0 if low is None else high - low + 1 - turns, *(sum(p[k] for p in own) for k in (
            "blank", "duplicate", "truncated")), illegal, cost, audit)

    def run(batches):
        own, key, kinds = [], None, None
        for batch in batches:
            kinds = kinds or [batch.schema.field(0).type, *[pa.int64()] * 6, pa.string()]
            made = []
            for p in batch.to_pylist():
                if own and p["conv"] != key:
                    made.append(verdict(key, own))
                    own = []
                key = p["conv"]
                own.append(p)
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made), kinds)], names=schema.names)
        if own:
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(verdict(key, own), kinds)],
                                             names=schema.names)

    return pieces.repartition("conv").sortWithinPartitions("conv", "part", "place").mapInArrow(run, schema)


def _edited(rows, audit: str):
    """(role, text, edit) of the repaired rows, as the audit says; ``rows`` is read in step."""
    state = START
    for letter in audit:
        if letter == "I":
            state = FITS[state]
            yield ROLE[state], "", letter
            continue
        role, text = next(rows)
        if letter == "R":
            state = FITS[state]
            yield ROLE[state], text, letter
        elif letter == "K":
            state = NEXT[state, role[0]]
            yield role, text, letter


def _in_step(rows: DataFrame, verdicts: DataFrame, every: DataFrame, names: tuple[str, str, str, str]) -> DataFrame:
    """Each conversation's id, then its verdict, then its rows with their texts, in one partition and in order."""
    conv, turn, role, text = (F.col(f"`{n}`") for n in names)
    none = F.lit(None)
    cols = [f.name for f in T._parse_datatype_string(VERDICT).fields]
    heads = every.select(F.col(f"`{names[0]}`").alias("conv")).distinct().select(
        "conv", F.lit(0).alias("what"), none.cast("long").alias("turn"), none.cast("string").alias("role"),
        none.cast("string").alias("digest"), none.cast("string").alias("text"),
        *[none.cast(verdicts.schema[c].dataType).alias(c) for c in cols])
    found = verdicts.select(
        "conv", F.lit(1).alias("what"), none.cast("long").alias("turn"), none.cast("string").alias("role"),
        none.cast("string").alias("digest"), none.cast("string").alias("text"), *cols)
    texts = rows.select(
        conv.alias("conv"), F.lit(2).alias("what"), turn.cast("long").alias("turn"), role.alias("role"),
        F.sha2(text, 256).alias("digest"), text.alias("text"),
        *[none.cast(verdicts.schema[c].dataType).alias(c) for c in cols])
    return (heads.unionByName(found).unionByName(texts).repartition("conv")
            .sortWithinPartitions("conv", "what", "turn", "role", "digest").drop("digest", "turn"))


def _walk(batches):
    """(conversation, verdict or None, its rows) of the rows of ``_in_step``, nothing kept but the present row."""
    def flat():
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                yield row

    rows = flat()
    ahead = [next(rows, None)]
    while ahead[0] is not None:
        conv, verdict = ahead[0][0], None
        ahead[0] = next(rows, None)
        if ahead[0] is not None and ahead[0][1] == 1 and ahead[0][0] == conv:
            verdict, ahead[0] = ahead[0][4:], next(rows, None)

        def own(conv=conv):
            while ahead[0] is not None and ahead[0][1] == 2 and ahead[0][0] == conv:
                row, ahead[0] = ahead[0], next(rows, None)
                yield row[2], row[3]

        texts = own()
        yield conv, verdict, texts
        for _ in texts:
            pass


def _prepared(rows, every, conv, turn, role, text, size):
    clean = rows.select(F.col(f"`{conv}`"), F.col(f"`{turn}`"), *[
        F.coalesce(F.col(f"`{c}`"), F.lit(" ")).alias(c) for c in (role, text)])
    verdicts = _verdicts(_pieces(_faulty(clean, conv, turn, role, text), size))
    return _in_step(clean, verdicts, every if every is not None else clean, (conv, turn, role, text))


def repair(rows: DataFrame, every: DataFrame | None = None, conv: str = "conv_id", turn: str = "turn",
           role: str = "role", text: str = "text", size: int = PIECE) -> DataFrame:
    """One row for each conversation: (conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256).

    ``gaps`` counts the missing turns between the first and the last, ``illegal``
    the neighbouring rows whose roles' initials are none of su, ua, au, and the
    digest is of the repaired rows as ``role:text``, joined by newlines.
    ``every`` may name conversations that have no row left; they get zeros, an
    empty audit and the digest of the empty string.

    Defined cases: a null role or text is one blank; a null turn comes first and
    counts for no gap; all rows without a conversation id are one conversation;
    equal rows of one turn are duplicates but for the first; an empty text is
    blank; texts and conversations of any length are read whole; other columns
    are ignored; an empty table gives an empty one.
    """
    stepped = _prepared(rows, every, conv, turn, role, text, size)
    fields = T._parse_datatype_string(VERDICT).fields
    schema = T.StructType([T.StructField(conv, stepped.schema["conv"].dataType), *fields,
                           T.StructField("repaired_sha256", T.StringType())])

    def run(batches):
        made, kinds = [], None

        def peek():
            nonlocal kinds
            for batch in batches:
                kinds = kinds or [batch.schema.field(0).type, *[pa.int64()] * 6, pa.string(), pa.string()]
                yield batch

        def flush():
            cols = [pa.array(c, k) for c, k in zip(zip(*made), kinds)]
            made.clear()
            return pa.RecordBatch.from_arrays(cols, names=schema.names)

        for own, verdict, texts in _walk(peek()):
            verdict = verdict or (*[0] * 6, "")
            digest = hashlib.sha256()
            for i, (r, t, _) in enumerate(_edited(texts, verdict[-1])):
                digest.update(("\n" * bool(i) + f"{r}:{t}").encode())
            made.append((own, *verdict, digest.hexdigest()))
            if len(made) >= 4096:
                yield flush()
        if made:
            yield flush()

    return stepped.mapInArrow(run, schema)


def repaired(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
             size: int = PIECE) -> DataFrame:
    """The repaired rows: (conv, position from 0, role, text, edit: K, R or I); cases as in ``repair``."""
    stepped = _prepared(rows, None, conv, turn, role, text, size)
    schema = T.StructType([T.StructField(conv, stepped.schema["conv"].dataType),
                           T.StructField("position", T.LongType()), T.StructField("role", T.StringType()),
                           T.StructField("text", T.StringType()), T.StructField("edit", T.StringType())])

    def run(batches):
        made, kinds = [], [None]

        def peek():
            for batch in batches:
                kinds[0] = batch.schema.field(0).type
                yield batch

        def flush():
            cols = [pa.array(c, k) for c, k in zip(zip(*made), [kinds[0], pa.int64(), *[pa.string()] * 3])]
            made.clear()
            return pa.RecordBatch.from_arrays(cols, names=schema.names)

        for own, verdict, texts in _walk(peek()):
            for i, (r, t, edit) in enumerate(_edited(texts, verdict[-1] if verdict else "")):
                made.append((own, i, r, t, edit))
                if len(made) >= 1024:
                    yield flush()
        if made:
            yield flush()

    return stepped.mapInArrow(run, schema)


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """(conv, turn, role, text) with faults that a checksum of ``conv:turn`` chooses, of 20 remainders:

    0 drops the row, 1 empties its text, 2 removes the sentence ends from it, 3
    repeats the row, 4 makes its role user. Nulls are one blank, in the checksum too
    (a conversation or turn itself stays null).
    """
    blank = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")) for c in (conv, turn, role, text)]
    spot = F.crc32(F.concat(blank[0], F.lit(":"), blank[1])) % 20
    cut = F.when(spot == 1, "").when(spot == 2, F.translate(blank[3], "".join(ENDS), "")).otherwise(blank[3])
    return rows.where(spot != 0).select(
        F.col(f"`{conv}`"), F.col(f"`{turn}`"), F.when(spot == 4, "user").otherwise(blank[2]).alias(role),
        cut.alias(text), F.explode(F.array_repeat(F.lit(0), F.when(spot == 3, 2).otherwise(1))).alias("_copy")
    ).drop("_copy")

