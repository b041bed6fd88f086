"""Personal data: exact patterns, and a linear-chain conditional random field over word shapes."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenrec.llm.common import read

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]  # kind, start, end (code points, end exclusive)

# ---------------------------------------------------------------- exact patterns

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match can only start where a run of digits starts, and taking whole runs loses none: linear time.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# What a whole decoded span of each kind has to look like; ASCII only, like the exact patterns.
_WHOLE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+" + _DOMAIN.pattern),
    "ip": re.compile(r"[0-9]+(?:\.[0-9]+){3}"),
    "card": re.compile(r"[0-9](?:[\x20.-]?[0-9])+"),
    "phone": re.compile(r"\+?[(0-9][\x20().0-9-]*[0-9]"),
}


def digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(number: str) -> bool:
    """13 to 19 digits whose Luhn sum is a multiple of ten."""
    if not 13 <= len(number) <= 19:
        return False
    total = 0
    for k, c in enumerate(reversed(number)):
        d = int(c) * (2 if k % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def is_ip(text: str) -> bool:
    """Four runs of ASCII digits between dots, each at most 255."""
    if not _WHOLE["ip"].fullmatch(text):
        return False
    return all(len(p) <= 3 and int(p or 0) <= 255 for p in (part.lstrip("0") for part in text.split(".")))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses. The part before ``@`` is the longest run of its characters
    after the last match, so each ``@`` is looked at once."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            end = m.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[Span]:
    """The exact patterns, by kind and then start."""
    spans: list[Span] = [("email", s, e) for s, e in emails(text)]
    spans += [("ip", *m.span()) for m in _IP.finditer(text) if is_ip(m.group())]
    spans += [("card", *m.span()) for m in _CARD.finditer(text) if luhn(digits(m.group()))]
    if "+" in text:
        spans += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(digits(m.group())) <= 15]
    return spans


# ---------------------------------------------------------------- the conditional random field

_TOKEN = re.compile(r"[0-9]+|[^\W0-9_]+|\S")
_SPECIAL = re.compile(r"[0-9@]")
REACH = 2  # tokens to either side that a token's features look at
NEAR = 8  # tokens between a part of a span and the nearest digit or @, at most
TAGS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))

#: The labelled table: {kind|text} marks a span. Written for this purpose.
LABELLED = (
    "Reach the desk on {phone|(030) 901-8200} before noon.",
    "Phone: {phone|555-201-7788} or visit us.",
    "tel. {phone|0171 555 0199}, ask for the clerk",
    "fax {phone|(212) 555-0147}",
    "Call {phone|+44 20 7946 0018} today.",
    "call {phone|+1 (415) 555-2671} now and wait",
    "Rufen Sie {phone|(089) 555-1234} an.",
    "llame al {phone|(915) 555-8870} hoy",
    "appelez le {phone|(145) 555-6302} ce soir",
    "mobile {phone|555-867-5309}; office {phone|(617) 555-0100}.",
    "My number is {phone|(303) 555-4421}%%% thanks",
    "{phone|(206) 555-9912}!! NOW!!",
    "write to {email|ann.lee@mail.example.com} soon",
    "Mail {email|j.doe+news@example.org}, please.",
    "contact: {email|info@sub.example.co} for help",
    "die {email|max88@post.example.de} schreiben",
    "{email|a_b@example.net}!! now",
    "send it to {email|x.y@mail3.example.com}%%% or not",
    "the host {ip|192.168.0.14} was down",
    "from {ip|10.0.0.1} to {ip|172.16.254.3}.",
    "ping {ip|8.8.4.4} twice",
    "la {ip|97.51.17.173} queda",
    "of {ip|203.0.113.77}&&& then",
    "Address {ip|81.2.69.160}, logged.",
    "card {card|4111 1111 1111 1111} was charged",
    "paid with {card|5500-0000-0000-0004} today",
    "number {card|4012888888881881} on file",
    "los {card|9807915762804490} en",
    "charge {card|3782.8224.6310.0056} please",
    "old {card|6011 0009 9013 9424}!! card",
    "the year 1998 was warm and 2004 was cold",
    "Licensed under the Apache License, Version 2.0.",
    "Public License, version 3. All rights kept",
    "released as CC BY-NC 4.0. in part",
    'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" was set',
    'key = "9b0b3c6a43eb78aa99cbd7049c572391524f37a8" in the file',
    'token = "4d44c79e8bf7c55759c4958dd60ed83d2ef8cd4e"!! seen',
    "it cost 12,500.75 euros in 2019",
    "chapter 3, verse 16, page 211",
    "room 101 on floor 7 at 10:45",
    "on 2021-04-17 and 17.04.2021 they met",
    "between 1914-1918 and 1939-1945 there was war",
    "version 1.2.3 follows 1.2.2, see section 4.1",
    "score 3-1 after 90 minutes, 45 each",
    "about 3.14159 or 22/7, never 4",
    "isbn 978-3-16-148410-0 is a book",
    "follow @anna or @bob99 there",
    "price @ 3 per unit, 5 @ 12",
    "The reader of the second part was in the house and left.",
    "Der Weg war lang, und die Nacht kam früh.",
    "El camino era largo, y la noche cayó.",
    "Le chemin était long; la nuit tomba tôt.",
    "Words, words, words: and then (again) nothing!",
    "ALL OF THIS!! WAS!! SHOUTED!! AT!! US.",
    "The### noise*** was&&& here%%% and$$$ there.",
    "one | two | three | four. | five",
    "He said \"no\" - and went home. She didn't.",
    "a + b = c, so c - b = a",
)


def read_labelled(line: str) -> tuple[str, list[Span]]:
    """Text and spans of a marked line."""
    text, spans, at = "", [], 0
    for m in re.finditer(r"\{(\w+)\|([^}]*)\}", line):
        text += line[at : m.start()]
        spans.append((m.group(1), len(text), len(text) + len(m.group(2))))
        text += m.group(2)
        at = m.end()
    return text + line[at:], spans


def shape(token: str) -> str:
    """Digits by their number, letters by case, any other character as itself."""
    if "0" <= token[0] <= "9":
        return f"d{min(len(token), 20)}"
    if token[0].isalpha():
        if token.islower():
            return "x"
        return "X" if len(token) == 1 else "XX" if token.isupper() else "Xx"
    return token


def features(shapes: list[str], gaps: list[bool], at: int) -> list[str]:
    """Shapes up to ``REACH`` tokens away with the blank before them, and the pairs next to the token."""

    def look(k: int) -> str:
        i = at + k
        return "edge" if not 0 <= i < len(shapes) else shapes[i] + ("_" if gaps[i] else "")

    near = [look(k) for k in range(-REACH, REACH + 1)]
    out = [f"{k}:{s}" for k, s in zip(range(-REACH, REACH + 1), near)]
    return [*out, f"p:{near[REACH - 1]} {near[REACH]}", f"n:{near[REACH]} {near[REACH + 1]}"]


@dataclass
class Sequence:
    """Tokens of a text, from ``first`` to before ``last``, that are decoded together."""

    starts: list[int]
    ends: list[int]
    rows: list[list[int]]  # numbers of the known features of each token


@dataclass
class Crf:
    """Emission weights by feature, and transition weights; tag 0 is "outside", also at both ends."""

    number: dict[str, int]
    emit: np.ndarray = field(default_factory=lambda: np.zeros((0, len(TAGS))))
    step: np.ndarray = field(default_factory=lambda: np.zeros((len(TAGS), len(TAGS))))

    def tokens(self, text: str) -> tuple[list[re.Match], list[str], list[bool]]:
        found = list(_TOKEN.finditer(text))
        gaps = [m.start() == 0 or text[m.start() - 1].isspace() for m in found]
        return found, [shape(m.group()) for m in found], gaps

    def sequences(self, text: str, whole: bool = False) -> list[Sequence]:
        """The parts of a text that need decoding: tokens within ``NEAR`` of a digit or an ``@``.

        The model allows no other tag than "outside" for any other token, so the chain falls apart
        there, and decoding the parts, each between two outside tokens, gives the path of the text.
        """
        if not whole and not _SPECIAL.search(text):
            return []
        found, shapes, gaps = self.tokens(text)
        if whole:
            parts = [(0, len(found))]
        else:
            parts = []
            for i, m in enumerate(found):
                if _SPECIAL.match(m.group()):
                    a, b = max(0, i - NEAR), min(len(found), i + NEAR + 1)
                    if parts and a <= parts[-1][1]:
                        parts[-1] = (parts[-1][0], b)
                    else:
                        parts.append((a, b))
        return [
            Sequence(
                [m.start() for m in found[a:b]], [m.end() for m in found[a:b]],
                [[self.number[f] for f in features(shapes, gaps, i) if f in self.number] for i in range(a, b)],
            )
            for a, b in parts if b > a
        ]

    def scores(self, sequences: list[Sequence]) -> tuple[np.ndarray, np.ndarray]:
        """Emissions (sequence, token, tag), zero beyond a sequence's length, and the lengths."""
        n = np.array([len(s.rows) for s in sequences])
        out = np.zeros((len(sequences), n.max(), len(TAGS)))
        for k, s in enumerate(sequences):
            for i, row in enumerate(s.rows):
                out[k, i] = self.emit[row].sum(axis=0)
        return out, n

    def decode(self, sequences: list[Sequence]) -> list[np.ndarray]:
        """Best tags of each sequence by Viterbi's algorithm, for a batch of sequences at once."""
        if not sequences:
            return []
        emit, n = self.scores(sequences)
        best = emit[:, 0] + self.step[0]
        back = np.zeros(emit.shape, np.int8)
        for t in range(1, emit.shape[1]):
            paths = best[:, :, None] + self.step[None]
            back[:, t] = paths.argmax(axis=1)
            best = np.where((t < n)[:, None], paths.max(axis=1) + emit[:, t], best)
        tag = (best + self.step[:, 0]).argmax(axis=1)
        tags = np.zeros(emit.shape[:2], np.int8)
        for t in range(emit.shape[1] - 1, -1, -1):
            tags[:, t] = np.where(t < n, tag, 0)
            if t:
                tag = np.where(t < n, back[np.arange(len(n)), t, tag], tag)
        return [tags[k, :m] for k, m in enumerate(n)]


def train(lines: list[tuple[str, list[Span]]], rounds: int = 300, rate: float = 0.2, decay: float = 2e-4) -> Crf:
    """Maximum conditional likelihood with a quadratic penalty, by Adam on the whole table.

    Forward and backward sums run over all lines at once. The result depends on the table only.
    """
    crf = Crf({})
    sequences, gold = [], []
    for text, spans in lines:
        found, shapes, gaps = crf.tokens(text)
        for i in range(len(found)):
            for f in features(shapes, gaps, i):
                crf.number.setdefault(f, len(crf.number))
    for text, spans in lines:
        for s in crf.sequences(text, whole=True):
            tags = np.zeros(len(s.rows), np.int64)
            for kind, a, b in spans:
                inside = [i for i in range(len(tags)) if a <= s.starts[i] < b]
                tags[inside] = TAGS.index(f"I-{kind}")
                tags[inside[:1]] = TAGS.index(f"B-{kind}")
            sequences.append(s)
            gold.append(tags)
    k, n = len(TAGS), np.array([len(g) for g in gold])
    longest = n.max(initial=1)
    emit, step = np.zeros((len(crf.number), k)), np.zeros((k, k))
    # token-by-feature counts as flat index lists, once
    where = np.array([(a, t) for a, s in enumerate(sequences) for t, row in enumerate(s.rows) for _ in row]).reshape(-1, 2)
    which = np.array([f for s in sequences for row in s.rows for f in row], np.int64)
    seen, moves = np.zeros_like(emit), np.zeros_like(step)
    tag = np.zeros((len(gold), longest), np.int64)
    for a, g in enumerate(gold):
        tag[a, : len(g)] = g
        np.add.at(moves, (np.append(0, g), np.append(g, 0)), 1)
    np.add.at(seen, (which, tag[where[:, 0], where[:, 1]]), 1)
    m = [np.zeros_like(emit), np.zeros_like(step)]
    v = [np.zeros_like(emit), np.zeros_like(step)]

    def total(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis=axis, keepdims=True)
        return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)

    for r in range(1, rounds + 1):
        crf.emit, crf.step = emit, step
        e, _ = crf.scores(sequences)
        ahead, behind = np.zeros(e.shape), np.zeros(e.shape)
        ahead[:, 0] = e[:, 0] + step[0]
        for t in range(1, longest):
            ahead[:, t] = total(ahead[:, t - 1, :, None] + step, 1) + e[:, t]
        for t in range(longest - 1, -1, -1):
            onward = total(step + (e[:, t + 1] + behind[:, t + 1])[:, None, :], 2) if t + 1 < longest else 0
            behind[:, t] = np.where((t == n - 1)[:, None], step[:, 0], onward)
        z = total(ahead[np.arange(len(n)), n - 1] + step[:, 0], 1)
        p = np.exp(ahead + behind - z[:, None, None])
        expected, hops = np.zeros_like(emit), np.zeros_like(step)
        np.add.at(expected, which, p[where[:, 0], where[:, 1]])
        hops[0] += p[:, 0].sum(axis=0)
        hops[:, 0] += p[np.arange(len(n)), n - 1].sum(axis=0)
        for t in range(1, longest):
            live = t < n
            pair = ahead[live, t - 1, :, None] + step + (e[live, t] + behind[live, t])[:, None, :]
            hops += np.exp(pair - z[live, None, None]).sum(axis=0)
        for x, g, i in ((emit, seen - expected - decay * len(gold) * emit, 0), (step, moves - hops - decay * len(gold) * step, 1)):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            x += rate * (1 - r / (rounds + 1)) * (m[i] / (1 - 0.9**r)) / (np.sqrt(v[i] / (1 - 0.999**r)) + 1e-8)
    crf.emit, crf.step = emit, step
    return crf


def valid(kind: str, text: str) -> bool:
    """The checks that a decoded span has to pass: its kind's whole pattern, and those of the exact patterns."""
    if not _WHOLE[kind].fullmatch(text):
        return False
    if kind == "card":
        return luhn(digits(text))
    if kind == "ip":
        return is_ip(text)
    return kind == "email" or (7 <= len(digits(text)) <= 15 and any(c in "( -" for c in text))


def decode_batches(order: list[int], size: list[int], most: int = 512, cells: int = 500_000) -> Iterator[list[int]]:
    """``order`` (by rising size) in batches of at most ``most`` sequences and ``cells`` tokens, padding
    included; a longer sequence is a batch of its own."""
    part: list[int] = []
    for i in order:
        if part and (len(part) == most or (len(part) + 1) * size[i] > cells):
            yield part
            part = []
        part.append(i)
    if part:
        yield part


def find_spans(texts: list[str], crf: Crf) -> list[tuple[list[Span], list[Span]]]:
    """For each text the exact spans and the spans the model adds (those that touch no exact one)."""
    out = [(base_spans(t), []) for t in texts]
    owners, sequences = [], []
    for k, text in enumerate(texts):
        found = crf.sequences(text)
        owners += [k] * len(found)
        sequences += found
    # similar lengths together, so that little of a batch is padding
    order = sorted(range(len(sequences)), key=lambda i: len(sequences[i].rows))
    for part in decode_batches(order, [len(s.rows) for s in sequences]):
        for i, tags in zip(part, crf.decode([sequences[j] for j in part])):
            base, added = out[owners[i]]
            text, s = texts[owners[i]], sequences[i]
            at = 0
            while at < len(tags):
                name = TAGS[tags[at]]
                end = at + 1
                if name != "O":
                    kind = name[2:]
                    while end < len(tags) and TAGS[tags[end]] == f"I-{kind}":
                        end += 1
                    a, b = s.starts[at], s.ends[end - 1]
                    if valid(kind, text[a:b]) and not any(x < b and a < y for _, x, y in base):
                        added.append((kind, a, b))
                at = end
    return out


def model() -> Crf:
    return train([read_labelled(line) for line in LABELLED])


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


def personal_data(docs: DataFrame, crf: Crf | None = None, rows: int = 500) -> DataFrame:
    """One row per document: counts and digest of the exact spans, and all spans.

    Null texts count as empty and have no spans. Repeated rows are treated alike. Other columns are
    ignored. One pass; nothing is shuffled or collected.
    """
    crf = crf or model()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                found = find_spans(part["text"].to_pylist(), crf)
                counts = {f"n_{k}": pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k in KINDS}
                yield pa.record_batch(
                    {
                        "doc_id": part["doc_id"], **counts,
                        "base_sha256": [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found],
                        "spans": [joined(base + added) for base, added in found],
                        "n_added": pa.array([len(added) for _, added in found], pa.int64()),
                    }
                )

    schema = (
        "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
        "base_sha256 string, spans string, n_added bigint"
    )
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.mapInArrow(task, schema)


def mask(text: str, spans: list[Span]) -> str:
    """Spans replaced by their kind in angle brackets; overlapping spans give one mark, of the first kind."""
    out, at = [], 0
    merged: list[list] = []
    for kind, a, b in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))):
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], b)
        else:
            merged.append([kind, a, b])
    for kind, a, b in merged:
        out += [text[at:a], f"<{kind.upper()}>"]
        at = b
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, crf: Crf | None = None, rows: int = 500) -> DataFrame:
    """The documents with personal data masked in ``text`` and ``n_chars`` (if there) set to the new
    length; all other columns and rows as they are. A null text stays null."""
    crf = crf or model()
    names = [c.lower() for c in docs.columns]
    at = names.index("text")
    length = names.index("n_chars") if "n_chars" in names else None

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                texts = part.column(at).to_pylist()
                found = find_spans([t or "" for t in texts], crf)
                masked = [t if t is None else mask(t, base + added) for t, (base, added) in zip(texts, found)]
                columns = list(part.columns)
                columns[at] = pa.array(masked, part.schema.field(at).type)
                if length is not None:
                    old = columns[length].to_pylist()
                    new = [n if m == t else len(m) for n, m, t in zip(old, masked, texts)]
                    columns[length] = pa.array(new, part.schema.field(length).type)
                yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    return docs.mapInArrow(task, docs.schema)


def op1_crf_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(read(spark, sf_dir, "documents"))
