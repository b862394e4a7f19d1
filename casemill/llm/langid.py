"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1 (drawn from the letter's code
point, so all workers agree).  A letter trigram binds its three letters: the
first two are permuted by a roll of two and of one and the three multiplied
elementwise.  A text bundles (adds up) the vectors of its trigrams; a
language's prototype bundles its training texts.  A text gets the language
whose prototype has the largest cosine with it.

Letters are lower-cased; any run of other characters is one blank, which has a
vector too.  A null text, or one without letters, is `und` with score 0, as is
every text when nothing was learnt.  Equal cosines go to the language that
sorts first.  Repeated rows are predicted row by row.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemill.llm.common import arrow_batch, as_text, raw_text, sample_at_most

DIM = 1024
FIELD = 21  # bits of a code point
_CLASS = np.full(0x110000, -1, np.int32)  # code point -> itself if a letter, else 0; -1: not asked yet


@lru_cache(maxsize=20_000)
def letter_vector(code: int) -> np.ndarray:
    bits = np.random.Generator(np.random.PCG64([2024, code])).integers(0, 2, DIM, np.int8)
    return bits * np.int8(2) - np.int8(1)


def trigrams(text: str) -> np.ndarray:
    """Packed letter trigrams of a text; empty if it has no letters."""
    a = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    seen = _CLASS[a]
    if (seen < 0).any():
        for c in np.unique(a[seen < 0]):
            _CLASS[c] = int(c) if chr(c).isalpha() else 0
        seen = _CLASS[a]
    if not seen.any():
        return np.empty(0, np.int64)
    a = np.concatenate([[0], seen, [0]]).astype(np.int64)
    keep = np.ones(len(a), bool)
    keep[1:] = (a[1:] != 0) | (a[:-1] != 0)
    a = a[keep]
    return (a[:-2] << 2 * FIELD) | (a[1:-1] << FIELD) | a[2:]


def trigram_vectors(grams: np.ndarray) -> np.ndarray:
    """One bound vector per packed trigram."""
    mask = (1 << FIELD) - 1
    first, second, third = grams >> 2 * FIELD, (grams >> FIELD) & mask, grams & mask
    letters = np.unique(np.concatenate([first, second, third]))
    v = np.stack([letter_vector(int(c)) for c in letters])
    at = lambda x: np.searchsorted(letters, x)
    return (np.roll(v, 2, 1)[at(first)] * np.roll(v, 1, 1)[at(second)] * v[at(third)]).astype(np.float32)


def bundles(texts: list[str], block: int = 4096) -> np.ndarray:
    """A vector per text (zeros without letters).  Distinct trigrams go
    through in blocks, so memory stays bounded whatever the texts hold."""
    grams = [trigrams(t) for t in texts]
    out = np.zeros((len(texts), DIM), np.float32)
    owner = np.repeat(np.arange(len(texts)), [len(g) for g in grams])
    if not len(owner):
        return out
    distinct, which = np.unique(np.concatenate(grams), return_inverse=True)
    for at in range(0, len(distinct), block):
        n = min(block, len(distinct) - at)
        inside = (which >= at) & (which < at + n)
        cell = owner[inside] * n + (which[inside] - at)
        counts = np.bincount(cell, minlength=len(texts) * n).reshape(len(texts), n)
        out += counts.astype(np.float32) @ trigram_vectors(distinct[at : at + n])
    return out


def held_out(key: str = "doc_id") -> Column:
    """crc32 of the id as text, mod 5, is 0 (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 5 == 0


PART = pa.schema([("lang", pa.string()), ("dim", pa.int32()), ("v", pa.int64())])
PREDICTED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])


def learn_prototypes(labelled: DataFrame, max_train: int = 50_000) -> dict[str, list[int]]:
    """Prototype per language from at most about `max_train` rows of
    (`doc_id`, `text`, `lang`).  Each task adds up its own rows; the driver
    receives one vector of `DIM` numbers per language."""

    def add_up(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 32):
                raw, langs = (c.to_pylist() for c in batch.slice(at, 32).columns)
                for lang, v in zip(langs, bundles([as_text(r) for r in raw]), strict=True):
                    sums[lang] = sums.get(lang, 0) + v.astype(np.int64)
        yield arrow_batch([(lang, d, int(x)) for lang, v in sums.items() for d, x in enumerate(v)], PART)

    rows = sample_at_most(labelled.where("lang IS NOT NULL AND text IS NOT NULL"), max_train, F.col("doc_id"))
    parts = rows.select(raw_text("text"), "lang").mapInArrow(add_up, "lang string, dim int, v long")
    sums = parts.groupBy("lang", "dim").agg(F.sum("v").alias("v"))
    whole = sums.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("dim", "v"))), lambda s: s["v"]).alias("v"))
    return {r["lang"]: list(r["v"]) for r in whole.orderBy("lang").collect()}


def predict(docs: DataFrame, prototypes: dict[str, list[int]]) -> DataFrame:
    """`doc_id, held_out, lang_pred, score` for every row of `docs`."""
    langs = sorted(prototypes)
    rows = [np.asarray(prototypes[x], np.float64) for x in langs]
    unit = np.stack([v / max(np.linalg.norm(v), 1e-12) for v in rows]) if langs else np.zeros((0, DIM))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 32):
                ids, held, raw = (c.to_pylist() for c in batch.slice(at, 32).columns)
                v = bundles([as_text(r) for r in raw]).astype(np.float64)
                size = np.linalg.norm(v, axis=1)
                out = []
                for i, h, x, s in zip(ids, held, v, size, strict=True):
                    if not s or not langs:
                        out.append((i, h, "und", 0.0))
                        continue
                    cos = unit @ x / s
                    k = int(np.argmax(cos))
                    out.append((i, h, langs[k], float(min(max(cos[k], 0.0), 1.0))))
                yield arrow_batch(out, PREDICTED)

    rows_in = docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), raw_text("text"))
    return rows_in.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, max_train: int = 50_000) -> DataFrame:
    """Learn from the labelled rows that are not held out, predict all rows."""
    learnt = learn_prototypes(docs.where(~held_out()).select("doc_id", "text", "lang"), max_train)
    return predict(docs, learnt)
