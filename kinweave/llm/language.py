"""Language identification with a bit-sliced Bloom filter of n-grams.

Slot ``i`` of the filter holds a bit for each language; a language's n-grams set its bit in the
slots that three hash functions give. The ``and`` of an n-gram's three slots names all
languages that hold it. A text's n-grams are counted for each language, the counts are
corrected for the false positives expected from the filter's fill, and the largest decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.llm.common import bounded_sample

#: Bytes of an n-gram, and slots of the filter.
GRAM, SLOTS = 4, 1 << 19
#: Labelled documents that a model is fitted on, at most about.
SAMPLE = 20_000
#: Share of a language's documents that must hold an n-gram for it to be learned.
LEAST_SHARE = 0.01

#: ASCII bytes that are no letters become spaces.
_CLASSES = np.array([b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)], np.uint8)


def grams(text: str) -> np.ndarray:
    """Codes of all byte n-grams of the lower-cased text, with runs of non-letters as one space."""
    raw = _CLASSES[np.frombuffer(f" {text.lower()} ".encode("utf-8", "surrogatepass"), np.uint8)]
    blank = raw == 32
    keep = np.ones(len(raw), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    b = raw[keep].astype(np.uint32)
    if len(b) < GRAM:
        return np.empty(0, np.uint32)
    out = b[: len(b) - GRAM + 1].copy()
    for i in range(1, GRAM):
        out = out << np.uint32(8) | b[i : len(b) - GRAM + 1 + i]
    return out


def slots(g: np.ndarray) -> list[np.ndarray]:
    """Three slots of each n-gram."""
    h = g.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return [((h >> np.uint64(s)) & np.uint64(SLOTS - 1)).astype(np.int64) for s in (5, 24, 43)]


@dataclass
class LanguageModel:
    """``masks``: one array of slots for each 64 languages; ``false_positives``: chance for each language."""

    languages: list[str]
    masks: list[np.ndarray]
    false_positives: np.ndarray
    fallback: str

    @classmethod
    def build(cls, languages: list[str], held: dict[str, np.ndarray], fallback: str) -> LanguageModel:
        masks = [np.zeros(SLOTS, np.uint64) for _ in range(-(-len(languages) // 64))]
        fill = []
        for i, language in enumerate(languages):
            mask, bit = masks[i // 64], np.uint64(1 << i % 64)
            for s in slots(held[language]):
                mask[s] |= bit
            fill.append(float((mask & bit > 0).mean()) ** 3)
        return cls(languages, masks, np.array(fill), fallback)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or text is None or not any(map(str.isalpha, text)):
            return "und", 0.0
        g = grams(text)
        a, b, c = slots(g)
        hits = []
        for at, m in enumerate(self.masks):
            found, n = np.unique(m[a] & m[b] & m[c], return_counts=True)
            hits += [int(n[(found >> np.uint64(i)) & np.uint64(1) > 0].sum()) for i in range(min(64, len(self.languages) - 64 * at))]
        true = np.maximum((np.array(hits) - len(g) * self.false_positives) / (1 - np.minimum(self.false_positives, 0.999)), 0)
        best = int(np.argmax(true))
        if true[best] <= 0:
            return self.fallback, 0.0
        return self.languages[best], float(true[best] / true.sum())


def fit(labelled: DataFrame, most: int = SAMPLE, least_share: float = LEAST_SHARE) -> LanguageModel:
    """Model of ``doc_id, text, lang`` rows (null texts and labels go), from about ``most`` of them at most.

    The driver holds, for each language, the n-grams that at least ``least_share`` of its sampled
    documents hold; that share and the size of a document bound their number.
    """
    rows = bounded_sample(labelled.filter("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "lang", "text"), F.struct("doc_id", "text"), most)
    schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                by.setdefault(lang, []).append(np.unique(grams(text)))
            for lang, parts in by.items():
                g, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g)), pa.array(g.astype(np.int64)), pa.array(n.astype(np.int64))], schema=schema)

    sizes = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return LanguageModel([], [], np.empty(0), "und")
    counted = rows.select("lang", "text").mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    least = F.create_map(*[x for k, v in sizes.items() for x in (F.lit(k), F.lit(max(2.0 if v > 20 else 1.0, least_share * v)))])
    held: dict[str, list[int]] = {k: [] for k in sizes}
    for r in counted.filter(F.col("n") >= least[F.col("lang")]).select("lang", "gram").collect():
        held[r.lang].append(r.gram)
    return LanguageModel.build(sorted(sizes), {k: np.array(v, np.uint32) for k, v in held.items()}, min(sizes, key=lambda k: (-sizes[k], k)))


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` of each row, from its whole text.

    ``und`` with score 0 if the text is null or has no letter, or if nothing was learned. A text
    without any known n-gram gets the most frequent learned language with score 0. Equal
    counts go to the language that comes first by name.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # slots * 8 bytes for each 64 languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")
