"""Packing token pieces into sequences: minimum bin slack over piece lengths.

Documents become token ids and one end id; whole windows are cut off first, and what
remains has a length below the window. The plan needs only how many pieces of each
length there are, at most one number per length. Each step fixes the longest length left
and picks, by a subset-sum dynamic programme on bitsets, the multiset of remaining
lengths that fills the window closest to its capacity; backtracking gives its counts, and
the pattern is used as often as the counts allow. A piece finds its place in the plan by
its rank among the pieces of its length.
"""

from __future__ import annotations

import functools
import json
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickshard.llm.scratch import freeing, ranked, result
from tickshard.llm.words import Words, byte_class, portions

#: Pieces of one length that are ranked together, on average.
CELL = 256
#: Chunks of text whose ids a worker remembers, and their bytes.
REMEMBERED, REMEMBERED_BYTES = 400_000, 16 << 20
#: Characters that are encoded together.
PORTION = 4_000_000


class Encoder:
    """Token ids of texts by the byte-level BPE in a ``tokenizers`` file.

    In this kind of tokenizer a single space between two other characters always begins a
    new piece, so a text falls into chunks whose ids do not depend on each other, and most
    chunks have been seen before. New chunks of a batch are encoded in one call with the
    vocabulary's ranks. Texts that have white space next to a space or at an end, or a
    special token's text, go to the tokenizer whole.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        taken = set(self.special)
        byte_of = _byte_alphabet()
        ranks = {
            bytes(byte_of[c] for c in token): n
            for token, n in spec["model"]["vocab"].items()
            if token not in taken
        }
        self.ranks = tiktoken.Encoding(
            "ranks", pat_str=_PIECES, mergeable_ranks=ranks, special_tokens={}
        )
        self.width = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, n in ranks.items():
            self.width[n] = len(token)
        #: Ids as bytes by a chunk's bytes, which begin with the space before it if there is one.
        self.known: dict[bytes, bytes] = {}
        self.held = 0

    def _learn(self, chunks: list[bytes]) -> None:
        """Remember the ids of chunks, each with the space before it, in one call."""
        if not chunks:
            return
        ids = self.ranks.encode_to_numpy(
            b"".join(chunks).decode("utf-8", "surrogatepass"), disallowed_special=()
        )
        ends = np.cumsum(self.width[ids])
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        cuts = (np.searchsorted(ends, np.cumsum(sizes)) + 1) * 4
        raw, at = ids.astype("<u4").tobytes(), 0
        for chunk, cut in zip(chunks, cuts.tolist()):
            self.known[chunk] = raw[at:cut]
            at = cut

    def _whole(self, text: str) -> bytes:
        ids = self.whole.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        if len(self.known) > REMEMBERED or self.held > REMEMBERED_BYTES:
            self.known.clear()
            self.held = 0
        words = Words(texts, _NOT_SPACE, lower=False)
        first = words.first
        spaced = np.ones(len(words.starts), dtype=bool)
        spaced[first[:-1][np.diff(first) > 0]] = False  # the first of its text
        coded = words.slices(spaced).dictionary_encode()
        chunks, known = _bytes_of(coded.dictionary), self.known
        held = list(map(known.get, chunks))
        new = [i for i, own in enumerate(held) if own is None]
        self.held += sum(len(chunks[i]) for i in new)
        self._learn([chunks[i] for i in new if chunks[i][0] == 32])
        for i in new:
            chunk = chunks[i]
            if chunk[0] != 32:
                ids = self.ranks.encode_ordinary(chunk.decode("utf-8", "surrogatepass"))
                known[chunk] = np.array(ids, dtype="<u4").tobytes()
            held[i] = known[chunk]
        table = np.empty(len(chunks), dtype=object)
        table[:] = held
        ids = table[coded.indices.to_numpy()].tolist()
        odd = self._odd(texts, words)
        rows = zip(texts, odd, first[:-1].tolist(), first[1:].tolist())
        return [
            self._whole(text) if whole else b"".join(ids[low:high])
            for text, whole, low, high in rows
        ]

    def _odd(self, texts: list[str], words: Words) -> list[bool]:
        """Texts that can't be cut at their spaces."""
        buffer, begins = words.buffer, words.begins
        white = _WHITE[buffer]
        beside = np.zeros(len(buffer) + 1, dtype=bool)
        beside[1:-1] = white[1:] & white[:-1] & ((buffer[1:] == 32) | (buffer[:-1] == 32))
        odd = np.zeros(len(texts), dtype=bool)
        # a text's own bytes lie between the byte before it and the byte after it
        at = np.searchsorted(begins, np.flatnonzero(beside), side="right") - 1
        odd[np.minimum(at, len(texts) - 1)] = True
        for i, text in enumerate(texts):
            if not odd[i] and text:
                odd[i] = (
                    text[0].isspace()
                    or text[-1].isspace()
                    or _RARE_WHITE.search(text) is not None
                    or any(s in text for s in self.special)
                )
        return (odd & np.array([bool(t) for t in texts], dtype=bool)).tolist()


_WHITE = byte_class(lambda b: 0x09 <= b <= 0x0D or b == 0x20)
# Other characters that are white space somewhere.
_RARE_WHITE = re.compile(
    "[\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"
)
_NOT_SPACE = byte_class(lambda b: b != 0x20)


def _bytes_of(values: pa.Array) -> list[bytes]:
    """The items of an array of bytes that has no offset, without a Python object for each scalar."""
    ends = np.frombuffer(values.buffers()[1], dtype=np.int64)[: len(values) + 1].tolist()
    data = (values.buffers()[2] or pa.py_buffer(b"")).to_pybytes()
    return [data[a:b] for a, b in zip(ends, ends[1:])]


@functools.cache
def _encoder(path: str) -> Encoder:
    """One for each worker process."""
    return Encoder(path)


# How this kind of tokenizer cuts texts.
_PIECES = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def _byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes: printable ones for themselves, others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


def cut_pieces(docs: DataFrame, tokenizer: str, window: int, with_ids: bool) -> DataFrame:
    """Each document's ids and the end id 0, cut into whole windows and a rest.

    Ids are bytes here: two for each if a document's ids allow it, else four.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        for batch in batches:
            texts = [text or "" for text in batch.column("text").to_pylist()]
            for part in portions(texts, PORTION):
                low, rows, start, length, crc, total, ids = part.start, [], [], [], [], [], []
                for i, tokens in enumerate(encoder.encode(texts[part])):
                    tokens += b"\0\0\0\0"
                    if with_ids:
                        short = np.frombuffer(tokens, dtype="<u4")
                        wide = 2 if short.max() < 1 << 16 else 4
                        short = short.astype(f"<u{wide}").tobytes()
                    for at in range(0, len(tokens), 4 * window):
                        piece = tokens[at : at + 4 * window]
                        rows.append(low + i)
                        start.append(at // 4)
                        length.append(len(piece) // 4)
                        crc.append(zlib.crc32(piece))
                        total.append(len(tokens) // 4)
                        if with_ids:
                            begin = at // 4 * wide
                            ids.append(short[begin : begin + window * wide])
                columns = {
                    "doc_id": batch.column("doc_id").take(pa.array(rows, pa.int64())),
                    "start": pa.array(start, pa.int64()),
                    "length": pa.array(length, pa.int64()),
                    "ids_crc32": pa.array(crc, pa.int64()),
                    "doc_tokens": pa.array(total, pa.int64()),
                }
                if with_ids:
                    columns["ids"] = pa.array(ids, pa.binary())
                yield pa.RecordBatch.from_pydict(columns)

    fields = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    fields += ", ids binary" if with_ids else ""
    return docs.select("doc_id", "text").mapInArrow(freeing(run), fields)


def _listed(column: pa.Array, lengths: list[int]) -> pa.Array:
    """Lists of ids from their bytes."""
    parts = [
        np.frombuffer(raw, dtype=f"<u{len(raw) // n}") for raw, n in zip(column.to_pylist(), lengths)
    ]
    flat = np.concatenate([np.empty(0, "<i4"), *parts], dtype=np.int32, casting="unsafe")
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *lengths]), pa.int32()), pa.array(flat))


def fill(room: int, counts: list[int]) -> dict[int, int]:
    """The multiset of lengths with the largest sum up to *room*; counts[n] are left of length n.

    Bit ``s`` of a layer says that a sum ``s`` can be reached. Counts are split into powers
    of two, so a length takes part in about log2(count) layers.
    """
    layers: list[tuple[int, int, int]] = []
    reach, mask = 1, (1 << (room + 1)) - 1
    for n in range(min(room, len(counts) - 1), 0, -1):
        left, batch = min(counts[n], room // n), 1
        while left:
            take = min(batch, left)
            layers.append((reach, n, take))
            reach |= (reach << (n * take)) & mask
            left -= take
            batch *= 2
        if reach >> room:
            break
    total, chosen = reach.bit_length() - 1, {}
    for before, n, take in reversed(layers):
        if not before >> total & 1:
            chosen[n] = chosen.get(n, 0) + take
            total -= n * take
    return chosen


def plan(histogram: dict[int, int], window: int) -> list[tuple[list[int], int]]:
    """Patterns of lengths, longest first, and how many sequences follow each."""
    counts = [0] * (window + 1)
    for n, c in histogram.items():
        counts[n] = c
    patterns = []
    longest = window
    while longest:
        if not counts[longest]:
            longest -= 1
            continue
        counts[longest] -= 1
        chosen = fill(window - longest, counts)
        counts[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(counts[n] // k for n, k in chosen.items())
        for n, k in chosen.items():
            counts[n] -= k * times
        patterns.append(([n for n in sorted(chosen, reverse=True) for _ in range(chosen[n])], times))
    return patterns


def _places(patterns: list[tuple[list[int], int]]) -> dict[int, tuple[list, list]]:
    """For each length: ranks where its share of a pattern begins, and that share."""
    table: dict[int, tuple[list, list]] = {}
    used: dict[int, int] = {}
    first = 0
    for lengths, times in patterns:
        offsets: dict[int, list[int]] = {}
        at = 0
        for n in lengths:
            offsets.setdefault(n, []).append(at)
            at += n
        for n, own in offsets.items():
            begins, shares = table.setdefault(n, ([], []))
            begins.append(used.get(n, 0))
            shares.append((first, own))
            used[n] = used.get(n, 0) + times * len(own)
        first += times
    return table


def pack(
    docs: DataFrame, tokenizer: str, window: int = 1024, with_ids: bool = True
) -> DataFrame:
    """The pieces of all *docs* (doc_id, text) with their sequence and offset in it.

    doc_id, start, length, ids_crc32 (of the ids as little-endian unsigned 32-bit numbers),
    doc_tokens (with the end id 0), ids, sequence_id (gapless from 0), offset (gapless from 0 in
    a sequence); *with_ids* false leaves ids out. A NULL or empty text is one piece: the end id.
    Rows that repeat an id are documents of their own. Other columns are ignored; an empty
    table has no pieces. The pieces are stored for a day; the result finds their places when it
    is read, so ids are stored once.
    """
    spark = docs.sparkSession
    pieces = result(cut_pieces(docs, tokenizer, window, with_ids))
    counts = pieces.groupBy("length").count().limit(window + 1).collect()
    histogram = {r["length"]: r["count"] for r in counts}
    shared = spark.sparkContext.broadcast(_places(plan(histogram, window)))
    cells = [-(-histogram.get(n, 1) // CELL) for n in range(window + 1)]
    ways = F.get(F.array(*map(F.lit, cells)), F.col("length").cast("int"))
    placed = ranked(pieces, ["length"], ["doc_id", "start", "ids_crc32"], "place", ways)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = [], []
            rank = batch.column("place").to_pylist()
            lengths = batch.column("length").to_pylist()
            for n, r in zip(lengths, rank):
                begins, shares = shared.value[n]
                at = bisect_right(begins, r) - 1
                first, own = shares[at]
                turn, slot = divmod(r - begins[at], len(own))
                sequence.append(first + turn)
                offset.append(own[slot])
            columns = dict(zip(names, batch.columns))
            if with_ids:
                columns["ids"] = _listed(columns["ids"], lengths)
            columns["sequence_id"] = pa.array(sequence, pa.int64())
            columns["offset"] = pa.array(offset, pa.int64())
            yield pa.RecordBatch.from_pydict(columns)

    names = pieces.columns
    fields = T.StructType()
    for field in pieces.schema.fields:
        kind = T.ArrayType(T.IntegerType()) if field.name == "ids" else field.dataType
        fields.add(field.name, kind)
    for name in ("sequence_id", "offset"):
        fields.add(name, T.LongType())
    return placed.select(*pieces.columns, "place").mapInArrow(freeing(run), fields)
