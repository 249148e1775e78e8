"""Personal data: fixed patterns, and a linear-chain conditional random field besides.

The patterns (``PATTERNS``) give the base spans. The field labels every token
(a run without white space) with the beginning or the inside of a kind, or with
nothing, so that forms without a pattern are found too: telephone numbers as
written inside a country, addresses spelled out (name at host dot com), names
of people after words that announce them, and street addresses. Its features are
word shapes (letters, signs and runs of digits with their length), cue words, and
both of the two tokens on either side.

A line is a chain, and all chains of a block of texts are decoded together by
Viterbi in numpy: at each step those that are long enough, so time is linear in
the text. A token's share of its own and its neighbours' scores depends on its
shape and word only; tokens of one type share it.

The field is trained on the driver from a small labelled table: sentences made
from ``TEMPLATES`` with made-up numbers, names and words (``labelled_table``), and
lines of at most ``TRAIN_DOCS`` documents with a digit or an at sign and as many
without, chosen by a hash, which the patterns label. It adds the spans it
finds where no base span is; base spans always stay.

All patterns run in time linear in the text, whatever it holds.
"""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicklens.llm.common import blocks, written

#: Kinds of the patterns, then those that only the field finds.
KINDS = ("email", "ip", "card", "phone", "name", "address")
LABELS = ["O", *(f"{p}-{k}" for k in KINDS for p in "BI")]
#: Sentences of the labelled table; documents, lines and characters of a line beside them.
TRAIN_SENTENCES, TRAIN_DOCS, TRAIN_LINES, TRAIN_LINE = 1700, 300, 300, 240
EPOCHS, RATE, RIDGE = 40, 0.3, 0.02
#: What a span has to score above no label.
LEAST_GAIN = 3.0
NEVER = -1e4
#: Token types and tokens that a worker remembers.
TYPES, KNOWN = 40_000, 300_000

#: Sentences with slots. Slots of a kind in KINDS are labelled, all others are not.
TEMPLATES = (
    "call me at {phone} after six.", "my phone is {phone}", "phone: {phone}", "Tel. {phone}, {word} {word}", "tel {phone}",
    "{Word} {word} telephone {phone} {word}", "mobile {phone}", "fax: {phone}", "you can reach us on {phone}.",
    "Telefon: {phone}", "Meine Nummer ist {phone}.", "téléphone : {phone}", "appelez le {phone} {word}", "teléfono {phone}",
    "llame al {phone} {word}", "{word} {word} {phone} {word} {word}",
    "write to {email}", "my address is {email}.", "mail: {email}", "e-mail {email} {word}", "contact {email} for details",
    "{word} {word} {email} {word} {word}", "schreib an {email}", "écrivez à {email}", "escribe a {email}.",
    "my name is {name}", "my name is {name}, and {word}", "contact {name} for details", "contact: {name}", "signed, {name}",
    "Dear {name},", "Mr. {name} {word} {word}", "Mrs. {name} {word}", "Dr. {name} {word} {word}", "ask for {name}.",
    "mein Name ist {name}", "Herr {name} {word}", "Frau {name} {word}", "je m'appelle {name}", "Madame {name} {word}",
    "me llamo {name}", "Señor {name} {word}", "name: {name}", "name: {name} phone: {phone}",
    "I live at {address}.", "ship to {address}", "address: {address}", "visit us at {address}, {word}", "wohnhaft {address}",
    "Adresse: {address}", "j'habite {address}", "dirección: {address}", "{word} {word} {address} {word}",
    "{word} {ip} {word} {word}", "{Word} {word} {ip}", "{word} {ip} {card} {word}", "{word} {word} {card} {word}", "card {card}",
    "{card} {word} {word}", "{word} {name16} {card} {word}", "{Word} {word} {ip} {phone} {word}", "{word} {phone} {ip}.",
    "{word} {word}.{mail} {word}", "{word} {mail} {ip} {word}", "{word} {word} {intl} {word}", "{Word} {word} {intl} {card}", "{word} {name16} {word} {word}",
    "{Word} {word} {word}.", "{word} {word} at {word} {word}", "{Word} {word}, at {word} of {word}.", "{word} dot {word}",
    "look at the dot on page {small}", "version {version} of the {word}", "chapter {small} {word} {word}", "in {year} {word}",
    "Licensed under CC BY-NC {version}.", "room {small} at noon", "a {word} of {small} {word}", "it cost {price} {word}",
    "order {long} shipped", "{date} {word} {word}", "at {time} {word} {word}", "the name of the {word}", "{Word} {Word} {word}",
    "my phone is {word}", "the address of {word} {word}", "contact us", "call me {word}", "mail {word} {word}", "{long}",
    "{Word} {word} {word} | {word} | {word}", "{Word}, {word} {word} {word}.", "at {word} dot {word} {word}",
    "{word} {hex} {word}", "key = \"{hex}\" {word}", "{WORD}!! {WORD}, {WORD}!! {WORD}!!", "{word}*** {word}### {Word}&&& {word}%%%",
    "{twice}", "{WORD}!! {long}!! {WORD}!!", "{word} {small} {small} {word}", "{small}, {small} and {small} {word}",
)
FIRST = "Anna Ben Carla David Emma Felix Greta Hugo Ines Jonas Karin Louis Maria Nils Olga Paul Rosa Simon Tina Uwe".split()
LAST = "Keller Smith Dupont Garcia Meyer Jones Moreau Lopez Braun Taylor Petit Ruiz Wagner Brown Roux Vega Koch Hill".split()
ROADS = ("{n} {W} Street", "{n} {W} Road", "{n} {W} Avenue", "{n}b {W} Lane", "{W}straße {n}", "{W}weg {n}",
         "{n} rue {W} {W}", "{n}, rue {W}", "Calle {W} {n}", "Avenida {W} {n}")
HOSTS = "example mail post test corp web office home shop club".split()
ENDINGS = "com org net de fr es io eu".split()
SYLLABLES = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de se me ch ei un ge qu ll".split()

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A match starts at the start of a run of digits, so asking for that and never going back finds the same.
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]+")
SIGN = re.compile(r"[0-9@]")
CARD_DIGITS = range(12, 20)
TOKEN = re.compile(r"\n|\S+")
BREAK = "\n"
SHORTEST_WORD = re.compile(r"\W+")

SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                                  T.StructField("end", T.IntegerType()), T.StructField("base", T.BooleanType())]))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str):
    """An address starts where the run before its at sign starts, and not before the last one's end."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all patterns, by start, then kind."""
    out = [(s, 0, e) for s, e in _emails(text)]
    if SIGN.search(text):
        for m in IP.finditer(text):
            if all(len(g.lstrip("0")) <= 3 and int(g.lstrip("0") or 0) <= 255 for g in m.groups()):
                out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = m[0].replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= sum(map(len, DIGITS.findall(m[0]))) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def _word(rng: random.Random) -> str:
    return "".join(rng.choices(SYLLABLES, k=rng.randint(1, 4)))


def _slot(kind: str, rng: random.Random) -> str:
    """A value for a slot of a template."""
    def digits(n):
        return "".join(rng.choices("0123456789", k=n))

    word, name = _word(rng), _word(rng).capitalize()
    if kind == "phone":
        a, b, c = digits(3), digits(3), digits(4)
        return rng.choice((f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"0{a} {digits(7)}", f"{a} {b} {c}",
                           f"0{digits(1)} {digits(2)} {digits(2)} {digits(2)} {digits(2)}", f"0{a}/{digits(6)}",
                           f"({a}){b}-{c}", f"+1 ({a}) {b}-{c}", f"+49 {a} {digits(7)}"))
    if kind == "email":
        who = rng.choice((word, f"{word}.{_word(rng)}", f"{word}{digits(2)}", rng.choice(FIRST).lower()))
        host, end = rng.choice((*HOSTS, word)), rng.choice(ENDINGS)
        at, dot = rng.choice((("at", "dot"), ("[at]", "[dot]"), ("(at)", "(dot)"), ("at", "dot"), ("AT", "DOT")))
        return rng.choice((f"{who} {at} {host} {dot} {end}", f"{who} {at} {host} {dot} {end}",
                           f"{who} {at} {host} {dot} co {dot} {end}", f"{who}@{host}.{end}"))
    if kind == "name":
        first = rng.choice((*FIRST, name, name, name))
        return rng.choice((f"{first} {rng.choice((*LAST, _word(rng).capitalize()))}",) * 3
                          + (f"{first} {name[:1]}. {rng.choice(LAST)}",))
    if kind == "address":
        return rng.choice(ROADS).replace("{n}", str(rng.randint(1, 240))).replace("{W}", name, 1).replace(
            "{W}", _word(rng).capitalize())
    if kind == "card":
        body = "4" + digits(14)
        return next(body + c for c in "0123456789" if luhn(body + c))
    if kind == "name16":
        body = digits(15)
        return next(body + c for c in "5167420938" if not luhn(body + c))
    if kind == "mail":
        return f"{rng.choice((word, digits(2)))}@{rng.choice((word, 'mail' + digits(1)))}.{rng.choice(HOSTS)}.{rng.choice(ENDINGS)}"
    if kind == "intl":
        return f"+{rng.choice(('1', '49', '33', '34'))} ({digits(3)}) {digits(3)}-{digits(4)}"
    if kind == "twice":
        return " ".join([rng.choice((word, name, name + "."))] * rng.randint(4, 12))
    return {"WORD": word.upper(), "ip": ".".join(str(rng.randint(1, 255)) for _ in range(4)), "word": word, "Word": name,
            "small": str(rng.randint(1, 99)), "year": str(rng.randint(1900, 2030)), "price": f"{digits(2)}.{digits(2)}",
            "version": f"{rng.randint(1, 9)}.{rng.randint(0, 9)}", "long": digits(rng.choice((5, 7, 8, 9, 14, 22))),
            "date": f"20{digits(2)}-{digits(2)}-{digits(2)}", "time": f"{rng.randint(0, 23)}:{digits(2)}",
            "hex": "".join(rng.choices("0123456789abcdef", k=40))}[kind]


def labelled_table(size: int = TRAIN_SENTENCES, seed: int = 1) -> list[tuple[list[str], list[int]]]:
    """(tokens, label numbers) of made-up sentences, the templates in turn."""
    rng = random.Random(seed)
    table = []
    for i in range(size):
        tokens, gold = [], []
        for part in TEMPLATES[i % len(TEMPLATES)].split(" "):
            m = re.search(r"\{(\w+)\}", part)
            value = part[:m.start()] + _slot(m[1], rng) + part[m.end():] if m else part
            own = value.split(" ")
            name = {"mail": "email", "intl": "phone"}.get(m[1], m[1]) if m else ""
            kind = KINDS.index(name) if name in KINDS else -1
            tokens += own
            gold += [1 + 2 * kind + (j > 0) if kind >= 0 else 0 for j in range(len(own))]
        before = [_word(rng) for _ in range(rng.randint(0, 4))]
        after = [_word(rng) for _ in range(rng.randint(0, 4))]
        table.append((before + tokens + after, [0] * len(before) + gold + [0] * len(after)))
    return table


#: Words that the field knows as such: those of the templates; all others are known by their shape.
CUES = frozenset(w for t in TEMPLATES for p in t.split(" ") if "{" not in p and (w := SHORTEST_WORD.sub("", p.lower()))
                 ) | frozenset(ENDINGS) | frozenset("street road avenue lane rue calle avenida co".split())


def shape(token: str) -> str:
    """Classes of the characters, runs collapsed, a run of digits with its length up to seven."""
    out: list[str] = []
    run, last = 0, ""
    for c in token:
        k = "d" if "0" <= c <= "9" else "x" if c.islower() else "X" if c.isupper() else c if c < "\x7f" else "o"
        if k == last:
            run += 1
            continue
        if last == "d":
            out[-1] = f"d{min(run, 7)}"
        out.append(k)
        run, last = 1, k
    if last == "d":
        out[-1] = f"d{min(run, 7)}"
    return "".join(out) if len(out) <= 24 else f"many {'@' in out} {len(out) > 80}"


def describe(token: str) -> tuple[str, str, str]:
    """(shape, word, last sign) of a token; long numbers say whether their check digit is right."""
    if token.isalpha() and token.islower():
        return "x", token if token in CUES else "?", ""
    digits = "".join(DIGITS.findall(token))
    check = f" {luhn(digits)}" if len(digits) in CARD_DIGITS else ""
    word = SHORTEST_WORD.sub("", token.lower()) if len(token) <= 40 else ""
    return shape(token) + check, word if word in CUES else "?", token[-1] if not token[-1].isalnum() else ""


EDGE = ("^", "^", "")


def _names(what: tuple[str, str, str], place: int) -> list[str]:
    """Features that a token gives to the token ``place`` before it (its own at 0)."""
    form, word, sign = what
    if place == 0:
        return ["bias", f"s={form}", f"w={word}", f"e={sign}", f"s={form} w={word}"]
    return [f"{place}s={form}", f"{place}w={word}", f"{place}e={sign}"] if abs(place) == 1 else [
        f"{place}s={form}", f"{place}w={word}"]


PLACES = (0, -1, 1, -2, 2)


def features(tokens: list[str]) -> list[list[str]]:
    """Names of the features of each token of a line."""
    what = [EDGE, EDGE, *map(describe, tokens), EDGE, EDGE]
    return [[f for p in PLACES for f in _names(what[i + 2 + p], p)] for i in range(len(tokens))]


def labels(places: list[tuple[int, int]], spans: list[tuple[int, int, int]]) -> list[int]:
    """Label numbers of tokens at (start, end) under spans (start, kind, end)."""
    out, last, at = [], None, 0
    spans = sorted(spans)
    for s, e in places:
        while at < len(spans) and spans[at][2] <= s:
            at += 1
        over = spans[at] if at < len(spans) and spans[at][0] < e else None
        out.append(0 if over is None else 1 + 2 * over[1] + (over is last))
        last = over
    return out


class Field:
    """Weights of features and transitions; scores of label sequences are their sums."""

    def __init__(self, names: list[str]):
        self.place = {n: i for i, n in enumerate(names)}
        self.weight = np.zeros((len(names) + 1, len(LABELS)))
        self.step = np.zeros((len(LABELS), len(LABELS)))
        self.start = np.zeros(len(LABELS))
        self.allowed = np.array([[not b.startswith("I") or a[2:] == b[2:] for b in LABELS] for a in LABELS])
        self.may_start = np.array([not b.startswith("I") for b in LABELS])
        self._types = None

    def __getstate__(self):
        return self.__dict__ | {"_types": None}

    def types(self) -> Types:
        if self._types is None:
            self._types = Types(self)
        return self._types

    def transitions(self):
        return np.where(self.allowed, self.step, NEVER), np.where(self.may_start, self.start, NEVER)

    def rows(self, found: list[list[str]]) -> list[list[int]]:
        none = len(self.place)
        return [[self.place.get(f, none) for f in token] for token in found]

    def emissions(self, rows: list[list[int]]) -> np.ndarray:
        flat = np.fromiter((i for r in rows for i in r), np.int64)
        at = np.cumsum([0, *map(len, rows[:-1])])
        return np.add.reduceat(self.weight[flat], at, axis=0)

    def gradients(self, x: np.ndarray, y: np.ndarray):
        """Forward and backward over chains (n, steps, labels): log loss, and its gradients."""
        step, start = self.transitions()
        n, steps, k = x.shape
        a, b = np.empty_like(x), np.zeros_like(x)
        a[:, 0] = start + x[:, 0]
        for t in range(1, steps):
            a[:, t] = x[:, t] + _logsum(a[:, t - 1][:, :, None] + step, 1)
        for t in range(steps - 2, -1, -1):
            b[:, t] = _logsum(step + (x[:, t + 1] + b[:, t + 1])[:, None, :], 2)
        z = _logsum(a[:, -1], 1)
        p = np.exp(a + b - z[:, None, None])
        gold = np.eye(k)[y]
        d_step = np.zeros((k, k))
        for t in range(1, steps):
            pair = a[:, t - 1][:, :, None] + step + (x[:, t] + b[:, t])[:, None, :] - z[:, None, None]
            d_step += np.exp(pair).sum(0) - gold[:, t - 1].T @ gold[:, t]
        return p - gold, d_step, (p[:, 0] - gold[:, 0]).sum(0)

    def decode(self, x: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Viterbi over chains: the label of each row of ``x`` in a chain ``starts[i] : starts[i] + lengths[i]``."""
        step, start = (a.astype(x.dtype) for a in self.transitions())
        label = np.zeros(len(x), np.int8)
        if not len(starts):
            return label
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        back = np.zeros((len(x), len(LABELS)), np.int8)
        best = start + x[starts]
        longest = int(lengths[0])
        # Chains longer than t come first.
        more = np.searchsorted(-lengths, -np.arange(longest), side="left")
        for t in range(1, longest):
            n = more[t]
            through = best[:n, :, None] + step
            by = through.argmax(1)
            back[starts[:n] + t] = by
            best[:n] = np.take_along_axis(through, by[:, None, :], 1)[:, 0] + x[starts[:n] + t]
        now = best.argmax(1)
        label[starts + lengths - 1] = now
        for t in range(longest - 1, 0, -1):
            n = more[t]
            now[:n] = back[starts[:n] + t, now[:n]]
            label[starts[:n] + t - 1] = now[:n]
        return label

    def label_all(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(labels, scores above no label) of tokens; ``BREAK`` stands between lines."""
        types = self.types()
        ids = types.ids(tokens)
        one = np.concatenate([[0, 0], ids, [0, 0]])
        before, after = one[1:-3], one[3:-1]
        far_before, far_after = np.where(before == 0, 0, one[:-4]), np.where(after == 0, 0, one[4:])
        x = types.scores(ids, before, after, far_before, far_after)
        inside = ids != 0
        edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
        label = self.decode(x, edges[::2], edges[1::2] - edges[::2])
        return label, x[np.arange(len(x)), label] - x[:, 0]


class Types(dict):
    """Token -> number of its type (shape and word), and each type's share of the scores at every place. 0: a break."""

    def __init__(self, field: Field):
        super().__init__()
        self.field = field
        self._reset()

    def _reset(self) -> None:
        self.clear()
        self.known: dict[tuple[str, str, str], int] = {}
        self.table = np.zeros((256, len(PLACES), len(LABELS)), np.float32)
        self._add(EDGE)
        self[BREAK] = 0

    def _add(self, what: tuple[str, str, str]) -> int:
        i = self.known.setdefault(what, len(self.known))
        if i >= len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        place, weight = self.field.place, self.field.weight
        for k, p in enumerate(PLACES):
            self.table[i, k] = sum(weight[place[f]] for f in _names(what, p) if f in place)
        return i

    def __missing__(self, token: str) -> int:
        what = describe(token)
        i = self.known.get(what)
        if i is None:
            i = self._add(what)
        if len(token) <= 40:
            self[token] = i
        return i

    def ids(self, tokens: list[str]) -> np.ndarray:
        if len(self) > KNOWN or len(self.known) > TYPES:
            self._reset()
        return np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))

    def scores(self, *ids: np.ndarray) -> np.ndarray:
        out = self.table[ids[0], 0]
        for k in range(1, len(PLACES)):
            out += self.table[ids[k], k]
        return out


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis, keepdims=True))).squeeze(axis)


def _by_length(items: list) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for i, x in enumerate(items):
        out.setdefault(len(x), []).append(i)
    return out


def train(found: list[list[list[str]]], gold: list[list[int]], epochs: int = EPOCHS) -> Field:
    """Adam on the whole labelled table; features seen once are left out. No table, no label."""
    count = Counter(f for chain in found for token in chain for f in token)
    field = Field(sorted(f for f, n in count.items() if n > 1))
    if not found:
        return field
    groups = _by_length(found)
    # All tokens, those of chains of one length together; every token has the same number of features.
    index = np.array([r for at in groups.values() for i in at for r in field.rows(found[i])])
    y = np.concatenate([np.array([gold[i] for i in at]).ravel() for at in groups.values()])
    shapes = [(len(at), n) for n, at in groups.items()]
    ends = np.cumsum([0, *[a * n for a, n in shapes]])
    order = np.argsort(index, axis=None, kind="stable")
    used, first = np.unique(index.ravel()[order], return_index=True)
    of_token = order // index.shape[1]
    parameters = [field.weight, field.step, field.start]
    mean, square = ([np.zeros_like(p) for p in parameters] for _ in range(2))
    for epoch in range(1, epochs + 1):
        grads = [RIDGE * p / len(found) for p in parameters]
        x, d = field.weight[index].sum(1), np.empty((len(index), len(LABELS)))
        for shape_, a, b in zip(shapes, ends, ends[1:]):
            part, d_step, d_start = field.gradients(x[a:b].reshape(*shape_, -1), y[a:b].reshape(shape_))
            d[a:b] = part.reshape(b - a, -1)
            grads[1] += d_step / len(found)
            grads[2] += d_start / len(found)
        grads[0][used] += np.add.reduceat(d[of_token], first, axis=0) / len(found)
        for p, g, m, s in zip(parameters, grads, mean, square):
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            p -= RATE * (m / (1 - 0.9 ** epoch)) / (np.sqrt(s / (1 - 0.99 ** epoch)) + 1e-8)
        field.weight[-1] = 0
    return field


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_docs: int = TRAIN_DOCS,
          train_lines: int = TRAIN_LINES, sentences: int = TRAIN_SENTENCES) -> Field:
    """A field from the labelled table and from ``train_lines`` lines with a digit or an at sign and as many without
    one, at most, of ``train_docs`` documents of either sort.

    Lines of more than ``TRAIN_LINE`` characters are left out of the table, so what
    reaches the driver is bounded.
    """
    text = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(
        F.col("text").isNotNull() & F.col("id").isNotNull())
    sign = F.col("text").rlike("[0-9@]")
    some = [text.where(c).select("id").orderBy(F.xxhash64("id"), "id").limit(train_docs) for c in (sign, ~sign)]
    chosen = written(some[0].unionByName(some[1]).distinct(), "pii", "chosen")
    # 2 * train_docs ids at most, so the broadcast is bounded.
    every = written(text.join(F.broadcast(chosen), "id").select(F.explode(F.split("text", "\n")).alias("text"))
                    .where(F.length("text").between(1, TRAIN_LINE)).distinct(), "pii", "lines")
    lines = [row["text"] for c in (sign, ~sign)
             for row in every.where(c).orderBy(F.xxhash64("text"), "text").limit(train_lines).collect()]
    found, gold = [], []
    for tokens, own in labelled_table(sentences):
        found.append(features(tokens))
        gold.append(own)
    for line in lines:
        places = [m.span() for m in TOKEN.finditer(line)]
        if places:
            found.append(features([line[s:e] for s, e in places]))
            gold.append(labels(places, base_spans(line)))
    return train(found, gold)


def _may_be(kind: int, span: str) -> bool:
    """Whether a span has what its kind cannot lack."""
    digits = "".join(DIGITS.findall(span))
    words = span.split()
    said = {SHORTEST_WORD.sub("", w.lower()) for w in words}
    return {"email": "@" in span or len(words) <= 9 and {"at", "dot"} <= said, "ip": span.count(".") >= 3 and len(digits) >= 4,
            "card": len(digits) in CARD_DIGITS and luhn(digits), "phone": 7 <= len(digits) <= 15,
            "name": 2 <= len(words) <= 4 and not digits and len(said) == len(words) and all(w[0].isupper() for w in words),
            "address": 2 <= len(words) <= 8 and 1 <= len(digits) <= 5}[KINDS[kind]]


def added_spans(texts: list[str], base: list[list[tuple[int, int, int]]], field: Field) -> list[list]:
    """For each text, the (start, kind, end) that the field finds where no base span is."""
    tokens: list[str] = []
    first = []
    for t in texts:
        first.append(len(tokens))
        tokens += TOKEN.findall(t)
        tokens.append(BREAK)
    out: list[list] = [[] for _ in texts]
    label, gain = field.label_all(tokens)
    hot = np.flatnonzero(label)
    if not len(hot):
        return out
    own = np.searchsorted(first, hot, side="right") - 1
    for i in np.unique(own).tolist():
        places = [m.span() for m in TOKEN.finditer(texts[i])]
        spans: list[list] = []
        last = -2
        for j in hot[own == i].tolist():
            (s, e), y = places[j - first[i]], int(label[j])
            if y % 2 or last != j - 1:
                spans.append([s, (y - 1) // 2, e, 0.0])
            spans[-1][2] = e
            spans[-1][3] += float(gain[j])
            last = j
        taken = sorted(base[i])
        at = 0
        for s, kind, e, score in spans:
            while e > s + 1 and not texts[i][e - 1].isalnum() and texts[i][e - 1] not in ")]":
                e -= 1
            while at < len(taken) and taken[at][2] <= s:
                at += 1
            if score >= LEAST_GAIN and _may_be(kind, texts[i][s:e]) and not (at < len(taken) and taken[at][0] < e):
                out[i].append((s, kind, e))
    return out


def find(docs: DataFrame, field: Field, text_col: str = "text", out: str = "spans") -> DataFrame:
    """``docs`` with ``out`` in the place of the text: (kind, start, end, base) in code points, by start, then kind.

    Defined cases: an empty or null text has no spans; a text of any length is
    searched whole; a field without training adds nothing; repeated rows each get
    the same spans; an empty table gives an empty one.
    """
    rest = [c for c in docs.columns if c not in (text_col, out)]
    schema = T.StructType([*(docs.schema[c] for c in rest), T.StructField(out, SPANS)])
    model = docs.sparkSession.sparkContext.broadcast(field)
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                                ("base", pa.bool_())]))

    def run(batches):
        for batch in batches:
            for b in blocks(batch, len(rest), 1 << 20):
                texts = [t or "" for t in b.column(len(rest)).to_pylist()]
                base = [base_spans(t) for t in texts]
                more = added_spans(texts, base, model.value)
                spans = [[{"kind": KINDS[k], "start": s, "end": e, "base": own}
                          for s, k, e, own in sorted([*((*x, True) for x in a), *((*x, False) for x in m)])]
                         for a, m in zip(base, more)]
                yield pa.RecordBatch.from_arrays([*b.columns[:len(rest)], pa.array(spans, arrow)], names=schema.names)

    return docs.select(*[F.col(f"`{c}`") for c in rest], F.col(text_col)).mapInArrow(run, schema)
