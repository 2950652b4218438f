"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text is lower-cased and every run of non-letters becomes one space; features
are all n-grams of 1 to ``longest`` characters of what is left, spaces included
(a lone space is none), hashed to ``2**bits`` slots. Slot counts per language
are taken over every training document, added up in Spark, and turned into a
matrix of log-probabilities (slots x languages) that is broadcast. Scoring
gathers the rows of the slots that a text has and adds them up per document.

The matrix has at most ``entries`` numbers: with many languages there are fewer
slots. More than ``max_langs`` different values raise an error, as the column
then does not name languages; so the broadcast, and what the driver gets, are
bounded whatever the corpus.

Documents of the held-out fold (crc32 of the id as text, mod ``folds``, is 0)
are never learnt from; neither the id nor the source nor the language of a
document is an input of its own prediction.

Defined results: a null text or one without a letter (Unicode category L) is
``und`` with score 0; so is every text if there is nothing to learn from. Null
languages and null ids are not learnt from; a null id is not held out. Ties go
to the language that is least by code point. Repeated rows count each time and
get equal answers. An empty table gives no rows. Texts are read whole, in pieces
of bounded size. Extra columns are never looked at.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import fresh, slices
from .toxicity import held_out

UNKNOWN = "und"
_P = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(0xC2B2AE3D27D4EB4F)
_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """Which code points are letters."""
    global _letters
    if _letters is None:
        _letters = np.array([unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)])
    return _letters


def _spaced(points: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters as they are, one space for every run of others before or after them."""
    letter = letters()[points]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    return np.where(letter, points, np.uint32(32))[keep], doc[keep]


def ngrams(texts: pa.Array, bits: int, longest: int, piece: int = 1 << 20):
    """(document, slot) of every n-gram occurrence, in runs of about ``piece``
    characters; within a document every occurrence comes exactly once."""
    texts = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    lengths = pc.utf8_length(texts).to_numpy(zero_copy_only=False)
    whole = "\n".join(["", *texts.to_pylist()])   # each text led by a separator, which is no letter
    doc = np.repeat(np.arange(len(lengths)), lengths + 1)
    down = np.uint64(64 - bits)
    # A separator also stands behind the last text, so every word ends in a space.
    points = np.frombuffer((whole + "\n").encode("utf-32-le"), np.uint32)
    doc = np.append(doc, len(lengths))
    points, doc = _spaced(points, doc)
    # The space behind a text's last letter belongs to it, also across the join.
    lead = points == 32
    doc[1:][lead[1:]] = doc[:-1][lead[1:]]
    points = points.astype(np.uint64)
    for a in range(0, len(points), piece):
        p, d = points[a:a + piece + longest - 1], doc[a:a + piece + longest - 1]
        starts = min(piece, len(points) - a)
        h = np.zeros(len(p), np.uint64)
        for n in range(1, longest + 1):
            if len(p) < n:
                break
            m = min(starts, len(p) - n + 1)
            h = h[:m] * _P + p[n - 1:n - 1 + m] + np.uint64(1) if n > 1 else p[:m] * _P + np.uint64(1)
            same = d[:m] == d[n - 1:n - 1 + m]
            if n == 1:
                same = same & (p[:m] != 32)
            mixed = (h ^ (h >> np.uint64(29))) * _Q + np.uint64(n)
            slot = ((mixed ^ (mixed >> np.uint64(32))) * _P) >> down
            yield d[:m][same], slot[same].astype(np.int64)


@dataclass
class Model:
    langs: list[str]
    log_p: np.ndarray        # slots x languages, float32
    prior: np.ndarray        # languages
    bits: int
    longest: int


def train(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
          bits: int = 18, longest: int = 4, smoothing: float = 0.1, folds: int = 5,
          entries: int = 1 << 23, max_langs: int = 4096) -> Model | None:
    """Counts over all training documents; None if there is none."""
    known = docs.where(F.col(lang).isNotNull() & F.col(doc_id).isNotNull() & ~held_out(doc_id, folds))
    per_lang = {r[0]: r[1] for r in known.groupBy(F.col(lang).cast("string")).count().limit(max_langs + 1).collect()}
    if not per_lang:
        return None
    if len(per_lang) > max_langs:
        raise ValueError(f"{lang} has more than {max_langs} different values")
    langs = sorted(per_lang)
    while bits > 1 and len(langs) << bits > entries:
        bits -= 1
    place = {v: i for i, v in enumerate(langs)}

    def count(batches):
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, "t", 4 << 20):
                here = part.column("l")
                for value in pc.unique(here).to_pylist():
                    i = place[value]
                    if i not in found:
                        found[i] = np.zeros(1 << bits, np.int64)
                    for _, slot in ngrams(part.column("t").filter(pc.equal(here, value)), bits, longest):
                        found[i] += np.bincount(slot, minlength=1 << bits)
        for i, seen in found.items():
            slots = np.flatnonzero(seen)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(slots), i, np.int32)), pa.array(slots.astype(np.int32)), pa.array(seen[slots])],
                ["lang", "slot", "n"])

    counts = np.zeros((1 << bits, len(langs)), np.float32)
    rows = (known.select(F.col(lang).cast("string").alias("l"), F.col(text).alias("t"))
            .mapInArrow(count, "lang int, slot int, n bigint").groupBy("lang", "slot").agg(F.sum("n").alias("n")))
    for batch in rows.toArrow().to_batches():   # at most `entries` rows
        l, s, n = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        counts[s, l] = n
    counts += smoothing
    log_p = np.log(counts)
    log_p -= np.log(counts.sum(axis=0, dtype=np.float64)).astype(np.float32)
    docs_of = np.array([per_lang[v] for v in langs], float)
    return Model(langs, log_p, np.log(docs_of / docs_of.sum()), bits, longest)


def log_likelihood(texts: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(documents x languages sums of log-probabilities, n-grams of each document)."""
    total = np.zeros((len(texts), len(model.langs)))
    grams = np.zeros(len(texts), np.int64)
    step = max(1024, (1 << 22) // len(model.langs))
    for doc, slot in ngrams(texts, model.bits, model.longest):
        for a in range(0, len(doc), step):
            d = doc[a:a + step]
            first = np.flatnonzero(np.r_[True, d[1:] != d[:-1]])
            total[d[first]] += np.add.reduceat(model.log_p[slot[a:a + step]], first, axis=0, dtype=np.float64)
            grams[d[first]] += np.diff(np.append(first, len(d)))
    return total, grams


def predict(docs: DataFrame, model: Model | None, keep: tuple[str, ...] = ("doc_id",),
            text: str = "text", name: str = "lang_pred", score: str = "score") -> DataFrame:
    """``keep`` columns, the language as ``name`` and its posterior as ``score``."""
    if model is None:
        return docs.select(*keep, F.lit(UNKNOWN).alias(name), F.lit(0.0).alias(score))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    whole = fresh(docs, "_t")

    def run(batches):
        model = shared.value
        for batch in batches:
            for part in slices(batch, whole, 4 << 20):
                total, grams = log_likelihood(part.column(whole), model)
                total += model.prior
                best = total.argmax(axis=1)
                p = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
                none = grams == 0
                lang = pa.array([UNKNOWN if no else model.langs[b] for b, no in zip(best, none)], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [part.column(k) for k in keep] + [lang, pa.array(np.where(none, 0.0, p))], [*keep, name, score])

    src = docs.select(*keep, F.col(text).alias(whole))
    schema = StructType([src.schema[k] for k in keep]
                        + [StructField(name, StringType()), StructField(score, DoubleType())])
    return src.mapInArrow(run, schema)
