"""Personal data in texts: exact patterns, and a semi-Markov conditional random field.

The patterns give the base spans. The field reads windows of text around cues (a digit,
an ``@``, a bracketed "at" or "dot") as tokens, scores whole candidate segments by features
of the span (its shape, digit groups, checksums, separators, neighbours) and chooses
boundaries and types together by a dynamic programme over segments of bounded length; the
windows themselves are whole words and as long as their cues go on. It is trained on a
bounded sample of windows whose base spans are the labels, and adds spans where no base
span is; base spans always stay.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickshard.llm.scratch import Scratch, freeing, text_or_empty

KINDS = ("email", "ip", "card", "phone")
#: Different windows the field is trained on at most, chosen by a hash of their text; so many
#: places are first for windows with a label of each kind.
SAMPLE = 1500
PER_KIND = 250
EPOCHS = 4
MAX_TOKENS = 14
#: How much better than leaving it out a segment must score.
MARGIN = 2.0
#: Characters of a window for training at most; a longer one is cut between words there.
WINDOW = 400

# The base patterns.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

_CUE = re.compile(r"[0-9@]|[\[({<] ?(?:at|AT|At|dot|DOT|Dot) ?[\])}>]")
_AT = re.compile(r" ?[\[({<] ?(?:at|AT|At) ?[\])}>] ?")
_DOT = re.compile(r" ?[\[({<] ?(?:dot|DOT|Dot) ?[\])}>] ?")
_WORD = re.compile(r"\S+")
#: The rest of a word, and two more words.
_REST = re.compile(r"\S*+")
_NEAR = re.compile(r"\S*+(?:\s++\S++){0,2}+")
_TOKEN = re.compile(r"[^\W_]+|[^\s]")

#: Features without which a span of a kind is wrong whatever it scores.
_PROOF = {0: "mail=True1", 1: "octets=True", 2: "luhn=True"}

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of local part, @, dotted domain; every character is looked at a few times."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            last = domain.end()
        at = text.find("@", max(at + 1, last))


def _octet(digits: str) -> bool:
    """At most 255, leading zeros aside; a run of digits may be very long."""
    value = digits.lstrip("0")
    return len(value) <= 3 and int(value or 0) <= 255


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) of every base match, by kind and then by start."""
    found = [(0, *span) for span in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(_octet(p) for p in m.groups()):
                found.append((1, m.start(), m.end()))
        for m in _CARD.finditer(text):
            digits = _digits(m[0]) if m.end() - m.start() < 64 else ""
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append((2, m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                    found.append((3, m.start(), m.end()))
    return found


def windows(text: str) -> list[tuple[int, int]]:
    """Stretches around cues: whole words, two to either side, joined where they meet."""
    found: list[list[int]] = []
    backward, word_end = "", 0
    for m in _CUE.finditer(text):
        if m.end() <= word_end:
            continue  # what is around it is around the cue before it in its word
        backward = backward or text[::-1]
        word_end = _REST.match(text, m.end()).end()
        high = _NEAR.match(text, m.end()).end()
        if found and m.start() <= found[-1][1]:
            found[-1][1] = max(high, found[-1][1])
            continue
        low = len(text) - _NEAR.match(backward, len(text) - m.start()).end()
        if found and low <= found[-1][1]:
            found[-1][1] = high
        else:
            found.append([low, high])
    return [(low, high) for low, high in found]


def short_windows(text: str) -> Iterator[str]:
    """Windows for training: long ones cut between words, words beyond WINDOW left out."""
    for low, high in windows(text):
        if high - low <= WINDOW:
            yield text[low:high]
            continue
        start = end = low
        for m in _WORD.finditer(text, low, high):
            if m.end() - start > WINDOW:
                if end > start:
                    yield text[start:end]
                start = m.start()
            if m.end() - m.start() > WINDOW:
                start = m.end()
            end = m.end()
        if end > start:
            yield text[start:end]


def tokens(text: str, low: int, high: int) -> list[tuple[int, int]]:
    return [(m.start(), m.end()) for m in _TOKEN.finditer(text, low, high)]


def features(text: str, start: int, end: int) -> list[str] | None:
    """What a whole candidate span looks like; None for spans that can't be an entity."""
    span = text[start:end]
    if not (span[-1].isalnum() and (span[0].isalnum() or span[0] in "+(")) or "\n" in span:
        return None
    length = end - start
    if "at" in span.lower():  # a bracketed "at" or "dot" between words counts as its sign
        plain = _DOT.sub(".", _AT.sub("@", span))
        length, span = len(plain), plain
    digits = _digits(span)
    if not digits and "@" not in span:
        return None
    groups = re.findall(r"[0-9]+", span)
    letters = sum(c.isalpha() for c in span)
    marks = "".join(sorted({c for c in span if not c.isalnum()}))
    shape = re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]+", "9", span))
    before = text[start - 1] if start else " "
    after = text[end] if end < len(text) else " "
    found = [
        "bias",
        f"digits={min(len(digits), 20)}",
        f"groups={min(len(groups), 7)}",
        f"letters={min(letters, 3)}",
        f"marks={marks[:8]}",
        f"shape={shape[:24]}",
        f"first={span[0] if not span[0].isalnum() else 'x'}",
        f"edge={before.isalnum() or before in '@._%+-'}{after.isalnum() or after == '@'}",
        f"length={min(length // 4, 8)}",
    ]
    if "@" in span:
        local, _, domain = span.partition("@")
        found.append(f"mail={bool(local) and ' ' not in span}{min(domain.count('.'), 1)}")
    if not letters and 13 <= len(digits) <= 19:
        found.append(f"luhn={luhn(digits)}")
    if len(groups) == 4 and span.count(".") == 3:
        found.append(f"octets={all(len(g) < 4 and int(g) < 256 for g in groups)}")
    return found


def _segments(text: str, parts: list[tuple[int, int]]):
    """For each token the candidate segments that end with it: (first token, features)."""
    for j, (_, end) in enumerate(parts):
        own = []
        for i in range(j, max(-1, j - MAX_TOKENS), -1):
            found = features(text, parts[i][0], end)
            if found is not None:
                own.append((i, found))
        yield own


def _joined(spans: list[Span]) -> tuple[list[int], list[int]]:
    """Starts and ends of the stretches that *spans* cover, in order and apart."""
    starts: list[int] = []
    ends: list[int] = []
    for start, end in sorted((s, e) for _, s, e in spans):
        if ends and start <= ends[-1]:
            ends[-1] = max(end, ends[-1])
        else:
            starts.append(start)
            ends.append(end)
    return starts, ends


class Field:
    """Weights of (feature, kind); a segment of kind None is one token and scores 0."""

    def __init__(self, weights: dict[tuple[str, int], float] | None = None):
        self.weights = weights or {}

    def score(self, found: list[str], kind: int) -> float:
        get = self.weights.get
        return sum(get((f, kind), 0.0) for f in found)

    def decode(self, text: str, low: int, high: int) -> list[tuple[Span, float]]:
        """The best segmentation of a window; each entity with its score."""
        parts = tokens(text, low, high)
        best, back = [0.0], [None]
        for j, own in enumerate(_segments(text, parts)):
            top, how = best[j], None
            for i, found in own:
                for kind in range(len(KINDS)):
                    if kind in _PROOF and _PROOF[kind] not in found:
                        continue
                    gain = self.score(found, kind)
                    if gain > MARGIN and best[i] + gain > top:
                        top, how = best[i] + gain, (i, kind, gain)
            best.append(top)
            back.append(how)
        spans, j = [], len(parts)
        while j:
            how = back[j]
            if how is None:
                j -= 1
            else:
                i, kind, gain = how
                spans.append(((kind, parts[i][0], parts[j - 1][1]), gain))
                j = i
        return spans[::-1]

    def fit(self, texts: list[str]) -> Field:
        """Stochastic gradient of the log likelihood; partition sums by forward and backward passes."""
        examples = []
        for text in texts:
            parts = tokens(text, 0, len(text))
            gold = {(s, e): k for k, s, e in base_spans(text)}
            table = []
            for j, own in enumerate(_segments(text, parts)):
                for i, found in own:
                    kind = gold.get((parts[i][0], parts[j][1]), -1)
                    table.append((i, j, found, kind))
            if table:
                examples.append((len(parts), table))
        weights = self.weights
        for epoch in range(EPOCHS):
            rate = 0.5 / (1 + epoch)
            for n, table in examples:
                scores = [[self.score(f, k) for k in range(len(KINDS))] for _, _, f, _ in table]
                inside, outside = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
                inside[0] = outside[n] = 0.0
                ending: dict[int, list[int]] = {}
                starting: dict[int, list[int]] = {}
                for t, (i, j, _, _) in enumerate(table):
                    ending.setdefault(j, []).append(t)
                    starting.setdefault(i, []).append(t)
                for j in range(n):
                    terms = [inside[j]]
                    for t in ending.get(j, ()):
                        terms += [inside[table[t][0]] + s for s in scores[t]]
                    inside[j + 1] = np.logaddexp.reduce(terms)
                for i in range(n - 1, -1, -1):
                    terms = [outside[i + 1]]
                    for t in starting.get(i, ()):
                        terms += [outside[table[t][1] + 1] + s for s in scores[t]]
                    outside[i] = np.logaddexp.reduce(terms)
                for t, (i, j, found, gold_kind) in enumerate(table):
                    for kind in range(len(KINDS)):
                        p = np.exp(inside[i] + scores[t][kind] + outside[j + 1] - inside[n])
                        step = rate * (float(kind == gold_kind) - p)
                        if abs(step) > 1e-3:
                            for f in found:
                                weights[f, kind] = weights.get((f, kind), 0.0) + step
        return self

    def spans(self, text: str) -> tuple[list[Span], list[Span]]:
        """Base spans, and all spans: those of the field are added where no base span is."""
        base = base_spans(text)
        if not self.weights:
            return base, base
        more = []
        starts, ends = _joined(base)
        for low, high in windows(text):
            for span, _ in self.decode(text, low, high):
                at = bisect_left(starts, span[2])  # stretches that begin before its end
                if not at or ends[at - 1] <= span[1]:
                    more.append(span)
        return base, sorted(base + more)


def _hash(text: str) -> int:
    raw = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest()
    return int.from_bytes(raw, "little", signed=True)


def _first_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's different windows, the first by hash: SAMPLE of all, PER_KIND of each kind."""
    held: dict[int, tuple[str, set[int]]] = {}

    def trim() -> None:
        order = sorted(held)
        kept = set(order[:SAMPLE])
        for kind in range(len(KINDS)):
            kept.update([h for h in order if kind in held[h][1]][:PER_KIND])
        for h in order:
            if h not in kept:
                del held[h]

    for batch in batches:
        for text in batch.column("text").to_pylist():
            for window in short_windows(text):
                if (h := _hash(window)) not in held:
                    held[h] = window, {k for k, _, _ in base_spans(window)}
            if len(held) > 8 * SAMPLE:
                trim()
    trim()
    yield pa.RecordBatch.from_pydict(
        {
            "hash": pa.array(list(held), pa.int64()),
            "text": pa.array([w for w, _ in held.values()], pa.string()),
            "kinds": pa.array([sum(1 << k for k in ks) for _, ks in held.values()], pa.int64()),
        }
    )


def sample_windows(docs: DataFrame) -> list[str]:
    """At most SAMPLE different windows of *docs*, the first by a hash of their text.

    PER_KIND places for each kind come first, so every kind with a base span in a window is
    among them. A task hands on no more windows than the sample could take from it.
    """
    cued = docs.select("text").where(F.col("text").rlike(_CUE.pattern))
    with Scratch(docs.sparkSession) as scratch:
        made = cued.mapInArrow(freeing(_first_windows), "hash bigint, text string, kinds bigint")
        stored = scratch.store(made).distinct()

        def first(rows: DataFrame, most: int) -> list[str]:
            return [r["text"] for r in rows.orderBy("hash", "text").limit(most).collect()]

        chosen = {}
        for kind in range(len(KINDS)):
            labelled = stored.where(F.col("kinds").bitwiseAND(1 << kind) != 0)
            chosen |= dict.fromkeys(first(labelled, PER_KIND))
        chosen |= dict.fromkeys(first(stored, SAMPLE))
    return sorted(list(chosen)[:SAMPLE])


def train(docs: DataFrame) -> Field:
    return Field().fit(sample_windows(docs))


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def find(docs: DataFrame, field: Field) -> DataFrame:
    """Spans in every text: counts of base spans by kind, their digest and all spans.

    Offsets are code points, ends exclusive. A NULL text counts as empty: no spans, and the
    digest of the empty string. One row per row, NULL or repeated ids included; other
    columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [[] for _ in KINDS]
            digest, spans = [], []
            for text in batch.column("text"):
                base, every = shared.value.spans(text.as_py())
                for kind in range(len(KINDS)):
                    counts[kind].append(sum(k == kind for k, _, _ in base))
                digest.append(hashlib.sha256(listed(base).encode()).hexdigest())
                spans.append(listed(every))
            columns = [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts)]
            columns += [pa.array(digest, pa.string()), pa.array(spans, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]
    fields = "doc_id bigint, " + ", ".join(f"n_{k} bigint" for k in KINDS)
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    return rows.mapInArrow(freeing(run), f"{fields}, base_sha256 string, spans string")


def masked(text: str, spans: list[Span]) -> str:
    """*text* with every stretch of spans replaced by the kind of the first of them."""
    out, done = [], 0
    for start, end, kind in sorted((s, e, k) for k, s, e in spans):
        if start >= done:
            out += [text[done:start], f"[{KINDS[kind].upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def mask(docs: DataFrame, field: Field) -> DataFrame:
    """*docs* with personal data in text masked; NULL texts stay, n_chars follows the text if there."""
    shared = docs.sparkSession.sparkContext.broadcast(field)
    names = docs.columns
    counted = "n_chars" in names and isinstance(docs.schema["n_chars"].dataType, T.LongType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            changed = [None if t is None else masked(t, shared.value.spans(t)[1]) for t in texts]
            columns = dict(zip(names, batch.columns))
            columns["text"] = pa.array(changed, pa.string())
            if counted:
                old = columns["n_chars"].to_pylist()
                columns["n_chars"] = pa.array(
                    [n if a == b else len(b) for n, a, b in zip(old, texts, changed)], pa.int64()
                )
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names=names)

    return docs.mapInArrow(freeing(run), docs.schema)
