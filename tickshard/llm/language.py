"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams of all labelled rows on the executors and adds the counts up by
language and strip of the hash range; only the finished matrix of log probabilities, of
fixed width and one row per language, reaches the driver. It is broadcast, and whole
batches of texts are scored with numpy.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickshard.llm.scratch import freeing
from tickshard.llm.words import mix, portions

BUCKETS = 1 << 15
STRIP = 1 << 11
SIZES = (1, 2, 3)
SMOOTHING = 0.5
#: A table with more languages than this is not one of languages; keeps the matrix small.
MAX_LANGUAGES = 1000
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")
_PORTION = 500_000


def has_letter(text: str | None) -> bool:
    """Whether a letter is among the word characters; numerals like a half are none."""
    return text is not None and any(m[0].isalpha() for m in _LETTER.finditer(text))


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of lower-cased texts, and where each text's begin.

    ASCII characters that are no letters count as one space, and runs of spaces as one.
    """
    parts = [f" {(t or '').lower()} ".encode("utf-32-le", "surrogatepass") for t in texts]
    points = np.frombuffer(b"".join(parts), dtype=np.uint32)
    owner = np.repeat(np.arange(len(parts)), [len(p) // 4 for p in parts])
    points = np.where((points < 128) & ((points < 97) | (points > 122)), 32, points)
    space = points == 32
    same = np.zeros(len(points), dtype=bool)
    same[1:] = owner[1:] == owner[:-1]
    keep = ~space
    keep[1:] |= ~space[:-1]
    keep |= ~same
    points, owner = points[keep].astype(np.uint64), owner[keep]
    codes, owners = [], []
    rolling = np.zeros(len(points), dtype=np.uint64)
    for n in SIZES:
        shift = n - 1
        size = max(0, len(points) - shift)
        rolling = rolling[:size] * np.uint64(0x110000) + points[shift:]
        inside = owner[:size] == owner[shift:]
        if n == 1:
            inside &= points != 32
        codes.append((mix(rolling + np.uint64(n)) >> np.uint64(49))[inside].astype(np.int32))
        owners.append(owner[:size][inside])
    order = np.argsort(np.concatenate(owners), kind="stable")
    code = np.concatenate(codes)[order]
    begins = np.concatenate(
        ([0], np.cumsum(sum(np.bincount(o, minlength=len(parts)) for o in owners)))
    )
    return code, begins


@dataclass
class Model:
    """log_probability[bucket, language] and log_prior[language], languages sorted."""

    languages: list[str]
    log_probability: np.ndarray
    log_prior: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        real = [i for i, t in enumerate(texts) if has_letter(t)]
        if not self.languages or not real:
            return names, scores
        code, begins = grams([texts[i] for i in real])
        total = np.add.reduceat(self.log_probability[code], begins[:-1], axis=0, dtype=np.float64)
        total += self.log_prior
        best = total.argmax(axis=1)
        odds = np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        for i, b, o in zip(real, best, odds):
            names[i], scores[i] = self.languages[b], 1 / o
        return names, scores


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    rows: dict[str, int] = {}
    for batch in batches:
        texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
        for part in portions(texts, _PORTION):
            own = np.array(langs[part])
            code, begins = grams(texts[part])
            lang_of = np.repeat(own, np.diff(begins))
            for lang in np.unique(own):
                add = np.bincount(code[lang_of == lang], minlength=BUCKETS)
                counts[lang] = counts.get(lang, 0) + add
                rows[lang] = rows.get(lang, 0) + int((own == lang).sum())
    for lang, table in counts.items():
        for strip in range(BUCKETS // STRIP):
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": [str(lang)],
                    "strip": pa.array([strip], pa.int32()),
                    "n": [table[strip * STRIP : (strip + 1) * STRIP].tolist()],
                    "rows": [rows[lang]],
                }
            )


def _add(left):
    total = np.zeros(STRIP, dtype=np.int64)
    for n in left.column("n").to_pylist():
        total += np.array(n, dtype=np.int64)
    rows = sum(left.column("rows").to_pylist())
    return pa.table(
        {
            "lang": left.column("lang")[:1],
            "strip": left.column("strip")[:1],
            "n": pa.array([total.tolist()], pa.list_(pa.int64())),
            "rows": pa.array([rows], pa.int64()),
        }
    )


def train(docs: DataFrame) -> Model:
    """A model from all rows of *docs* (text, lang) whose lang is known and text has letters."""
    fields = "lang string, strip int, n array<bigint>, rows bigint"
    known = docs.select("text", "lang").where(
        "lang IS NOT NULL AND text IS NOT NULL AND lang <> 'und'"
    )
    strips = known.mapInArrow(freeing(_count), fields).groupBy("lang", "strip").applyInArrow(_add, fields)
    found = strips.limit(MAX_LANGUAGES * BUCKETS // STRIP + 1).collect()
    languages = sorted({r["lang"] for r in found})
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    counts = np.zeros((BUCKETS, len(languages)))
    rows = np.zeros(len(languages))
    for r in found:
        at = languages.index(r["lang"])
        counts[r["strip"] * STRIP : (r["strip"] + 1) * STRIP, at] = r["n"]
        rows[at] = r["rows"]
    smooth = counts + SMOOTHING
    log_probability = np.log(smooth / smooth.sum(axis=0)).astype(np.float32)
    return Model(languages, log_probability, np.log(rows / rows.sum()))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """*docs* with lang_pred and score, the probability of that language.

    A text that is NULL or has no letter is ``und`` with score 0, as is every text when
    nothing was learned. Ties go to the language first in order. Columns of *docs* with
    these two names are replaced; all others, NULLs included, are passed on.
    """
    docs = docs.drop("lang_pred", "score")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            names, scores = [], []
            for part in portions(texts, _PORTION):
                own, score = shared.value.predict(texts[part])
                names += own
                scores.append(score)
            numbers = np.concatenate(scores) if scores else np.zeros(0)
            columns = [*batch.columns, pa.array(names, pa.string()), pa.array(numbers)]
            yield pa.RecordBatch.from_arrays(
                columns, names=[*batch.schema.names, "lang_pred", "score"]
            )

    schema = T.StructType(
        [
            *docs.schema.fields,
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    return docs.mapInArrow(freeing(run), schema)


def held_out(doc_id: str = "doc_id"):
    """Rows kept out of training: crc32 of the id as text, modulo 4, is 2. NULL ids are not."""
    remainder = F.crc32(F.col(doc_id).cast("string")) % 4
    return F.coalesce(remainder == 2, F.lit(False))
