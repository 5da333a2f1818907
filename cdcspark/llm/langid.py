"""Language identification by the nearest of several TF-IDF centroids per language.

A text's vector counts its letter n-grams (1 to 3, lower case, words apart) in hashed buckets, damped by the logarithm,
weighted by inverse document frequency and normalised. The model is fitted on a bounded sample of labelled rows:
``PER_LANGUAGE`` per language, those with the least hash of their id. Each language's vectors are clustered into
``CENTROIDS`` directions by spherical k-means. A text gets the language of the centroid of largest cosine. It is rejected
if even that one is farther away than fragments of the sample's texts of like length ever are, with a margin.

Prediction reads every whole text once, in parts of bounded size, and shuffles nothing.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcspark.llm.common import bounded_batches

#: Labelled rows per language that the model is fitted on, and centroids per language.
PER_LANGUAGE, CENTROIDS = 300, 4

#: Buckets of hashed n-grams; buckets the sample does not use have the largest weight and no centroid has a share in them.
BUCKETS = 1 << 15

#: A text is rejected below this part of the least cosine of the sample's fragments of its length.
MARGIN = 0.5

#: Letters of the fragments that thresholds are measured on.
FRAGMENTS = (1, 2, 4, 8, 16, 32, 64, 128)

PART_CHARS = 1 << 20

UNKNOWN = "und"

_tables: dict[str, np.ndarray] = {}


def _letters() -> np.ndarray:
    """Lower-cased code point of every letter, 0 for all other characters."""
    if "letters" not in _tables:
        table = np.zeros(0x110000, np.uint32)
        for c in range(0x110000):
            x = chr(c)
            if x.isalpha():
                low = x.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _tables["letters"] = table
    return _tables["letters"]


def ngram_buckets(text: str) -> np.ndarray:
    """The buckets of the n-grams inside the words of ``text``, word borders counting as a character, with repeats."""
    table = _letters()
    found = [
        _part_buckets(table[np.frombuffer(text[i : i + PART_CHARS].encode("utf-32-le", "surrogatepass"), "<u4")])
        for i in range(0, len(text), PART_CHARS)
    ]
    return np.concatenate(found) if found else np.empty(0, np.int64)


def _part_buckets(codes: np.ndarray) -> np.ndarray:
    letter = codes > 0
    if not letter.any():
        return np.empty(0, np.int64)
    # One border character between words, none repeated.
    held = letter.copy()
    held[1:] |= letter[:-1]
    x = np.concatenate([[0], codes[held], [0]]).astype(np.uint64)
    mul = np.uint64(0x9E3779B97F4A7C15)
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    one = x[x > 0] * mul
    two = (x[:-1] * np.uint64(0x1F123BB5) + x[1:]) * mul + np.uint64(1)
    three = ((x[:-2] * np.uint64(0x1F123BB5) + x[1:-1]) * np.uint64(0x2545F491) + x[2:]) * mul + np.uint64(2)
    three = three[x[1:-1] > 0]
    return (np.concatenate([one, two, three]) * mul >> shift).astype(np.int64)


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets in use and the damped counts of them."""
    counts = np.bincount(ngram_buckets(text), minlength=1)
    used = np.flatnonzero(counts)
    return used, (1 + np.log(counts[used])).astype(np.float32)


@dataclass
class Model:
    """Weights of the buckets, centroids of unit length, their languages, and the least cosine by length."""

    idf: np.ndarray
    centroids: np.ndarray
    languages: list[str]
    least: np.ndarray

    def nearest(self, text: str) -> tuple[str, float, bool]:
        """Language, cosine (0 to 1) and whether the text is too far from every centroid."""
        return self.nearest_counts(*counted(text))

    def nearest_counts(self, used: np.ndarray, weight: np.ndarray) -> tuple[str, float, bool]:
        if not len(used) or not self.languages:
            return UNKNOWN, 0.0, True
        weight = weight * self.idf[used]
        close = self.centroids[:, used] @ weight / np.sqrt(weight @ weight)
        best = int(close.argmax())
        score = float(min(1.0, max(0.0, close[best])))
        return self.languages[best], score, score < self.threshold(len(used))

    def threshold(self, used: int) -> float:
        return float(self.least[min(len(self.least) - 1, int(used).bit_length())])


def _clusters(vectors: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; the first centres are spread by taking, again and again, the vector farthest from all taken."""
    centres = [vectors.mean(axis=0)]
    while len(centres) < min(k, len(vectors)):
        near = np.max(vectors @ np.array(centres).T, axis=1)
        centres.append(vectors[int(near.argmin())])
    centres = np.array(centres)
    for _ in range(rounds):
        centres = centres / np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
        own = (vectors @ centres.T).argmax(axis=1)
        for c in range(len(centres)):
            if (own == c).any():
                centres[c] = vectors[own == c].mean(axis=0)
    return centres / np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)


Counts = tuple[np.ndarray, np.ndarray]


def lesson(text: str) -> list[Counts]:
    """What a labelled text teaches: its own counts, then those of fragments from its start and its middle."""
    middle = text[len(text) // 2 :]
    parts = [text, *(x[:letters] for letters in FRAGMENTS for x in (text, middle))]
    return [c for c in map(counted, parts) if len(c[0])]


def fit(lessons: list[tuple[str, list[Counts]]], centroids: int = CENTROIDS) -> Model:
    """A model of pairs of language and ``lesson``; texts without letters teach nothing."""
    rows = [(lang, parts) for lang, parts in lessons if parts]
    seen = np.zeros(BUCKETS)
    for _, parts in rows:
        seen[parts[0][0]] += 1
    idf = (np.log((1 + len(rows)) / (1 + seen)) + 1).astype(np.float32)
    found, names = [np.empty((0, BUCKETS), np.float32)], []
    for lang in sorted({lang for lang, _ in rows}):
        own = [parts[0] for x, parts in rows if x == lang]
        vectors = np.zeros((len(own), BUCKETS), np.float32)
        for i, (used, weight) in enumerate(own):
            vectors[i, used] = weight * idf[used]
        vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
        found.append(_clusters(vectors, centroids))
        names += [lang] * len(found[-1])
    model = Model(idf, np.concatenate(found).astype(np.float32), names, np.zeros(1))
    least: dict[int, float] = {}
    for _, parts in rows:
        for used, weight in parts:
            band = int(len(used)).bit_length()
            least[band] = min(least.get(band, 1.0), model.nearest_counts(used, weight)[1])
    # A shorter text is never asked for more than a longer one.
    bands = max(least, default=0) + 1
    model.least = np.array([MARGIN * min([1.0, *(v for b, v in least.items() if b >= band)]) for band in range(bands)])
    return model


def sample(documents: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """At most ``per_language`` rows (text, lang) of each language, those whose ids have the least hashes."""
    ranked = documents.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "lang")
    counts = ranked.groupBy("lang").count()
    ranked = ranked.withColumn("_at", F.xxhash64("doc_id")).join(F.broadcast(counts), "lang")
    # A few times as many as asked for pass here, so that no task has to rank a whole language.
    share = (F.col("_at").cast("double") + 2.0**63) / 2.0**64
    ranked = ranked.where(share * F.col("count") <= 4.0 * per_language).select("doc_id", "lang", "_at").dropDuplicates()
    ranked = ranked.withColumn("_rank", F.expr("row_number() OVER (PARTITION BY lang ORDER BY _at, doc_id)"))
    chosen = ranked.where(F.col("_rank") <= per_language).select("doc_id", "lang")
    rows = documents.select("doc_id", "lang", "text").join(F.broadcast(chosen), ["doc_id", "lang"])
    return rows.dropDuplicates(["doc_id", "lang"]).select("text", "lang", F.xxhash64("doc_id").alias("at"))


def train(documents: DataFrame, per_language: int = PER_LANGUAGE, centroids: int = CENTROIDS) -> Model:
    """A model of labelled ``documents`` (doc_id, text, lang); see ``sample`` for the rows it is fitted on.

    Only counts come to the driver, at most ``BUCKETS`` numbers for each text of the sample however long it is. Languages
    are taken to be few.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [
                pickle.dumps([(used.astype(np.uint16), weight) for used, weight in lesson(x.as_py())])
                for x in batch.column(0)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array(parts, pa.binary())], ["lang", "at", "parts"]
            )

    bounded_batches(documents.sparkSession)
    rows = sample(documents, per_language).mapInArrow(work, "lang string, at long, parts binary").collect()
    rows.sort(key=lambda r: (r["lang"], r["at"], r["parts"]))
    return fit([(r["lang"], pickle.loads(r["parts"])) for r in rows], centroids)


PREDICTED = "lang_pred string, score double, rejected boolean"


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """All columns of ``documents`` with lang_pred, score and rejected (columns of these names are replaced).

    Null text, text without a letter and an empty model give ``und``, 0 and rejected. Ties go to the language that comes
    first. Only the text is looked at.
    """
    documents = documents.drop("lang_pred", "score", "rejected")
    shared = documents.sparkSession.sparkContext.broadcast(model)
    at = documents.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.nearest(x.as_py() or "") for x in batch.column(at)]
            names, scores, far = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(far, pa.bool_())],
                [*batch.schema.names, "lang_pred", "score", "rejected"],
            )

    bounded_batches(documents.sparkSession)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema)
    return documents.mapInArrow(work, f"{fields}, {PREDICTED}")


def held_out(doc_id: Column) -> Column:
    """Rows that the model may not learn from: crc32 of the id as text leaves 2 when divided by 4. Null ids are not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected of every document, learned from those that are not held out."""
    rows = documents.select("doc_id", "text", "lang")
    model = train(rows.where(~held_out(F.col("doc_id"))))
    found = predict(rows.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")
