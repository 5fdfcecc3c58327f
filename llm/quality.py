"""Quality scores from compression with class dictionaries.

One zstandard dictionary is built from good, one from bad labelled text.  A
text is compressed in blocks under both (whole text, so that the dictionary
keeps its say in long ones); the normalised difference of the two sizes says
which class it resembles.  A logistic curve of that difference, fitted on
labelled rows that the dictionaries were not built from, makes it a calibrated
score.

The model is fitted on a bounded sample: of each class at most
``rows_per_class`` labelled keys, those first by a hash of the key, with one
text each and at most ``SAMPLE_CHARS`` characters of it (a longer text gives
that many in pieces spread evenly over the whole of it).  Scores always read
whole texts.

Definitions for odd input: a NULL text counts as empty, and an empty text gets
the score of a zero difference; labels other than 0 and 1 are ignored; equal
labels of a key count once, different ones both; of a repeated key's texts one
is learnt from, chosen by a hash of the text; with labels of one class only,
or none, the score is that class (0.5 without any); repeated rows are scored
each on its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import remainder, text_groups

ROWS_PER_CLASS = 1500
DICTIONARY_BYTES = 112_640
BLOCK_BYTES = 512
LEVEL = 3
SAMPLE_CHARS = 65_536
_SAMPLE_PIECES = 64


def blocks(text: str | None) -> list[bytes]:
    raw = (text or "").encode("utf-8", "replace")
    return [raw[at:at + BLOCK_BYTES] for at in range(0, len(raw), BLOCK_BYTES)]


def build_dictionary(texts: list[str]) -> bytes:
    """A trained dictionary; of very little text, the text itself."""
    samples = [b for t in texts for b in blocks(t) if len(b) >= 16]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-DICTIONARY_BYTES:]


@dataclass
class QualityModel:
    good: bytes
    bad: bytes
    weights: list[float]        # of the difference, then the constant

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer:
    def __init__(self, model: QualityModel):
        def compressor(raw: bytes | None):
            own = {"dict_data": zstandard.ZstdCompressionDict(raw)} if raw else {}
            return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False, **own)

        self.good, self.bad = compressor(model.good), compressor(model.bad)
        self.slope, self.constant = model.weights

    def difference(self, text: str | None) -> float:
        """Above zero: smaller under the good dictionary."""
        good = bad = 0
        for b in blocks(text):
            good += len(self.good.compress(b))
            bad += len(self.bad.compress(b))
        return (bad - good) / max(bad, good, 1)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        x = np.array([self.difference(t) for t in texts], dtype=np.float64)
        return 1.0 / (1.0 + np.exp(-np.clip(x * self.slope + self.constant, -40, 40)))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 40) -> list[float]:
    """Weighted logistic regression by Newton steps, lightly regularised."""
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    g = np.column_stack([(x - mean) / spread, np.ones(len(x))])
    w = np.zeros(g.shape[1])
    ridge = 1e-2 * np.eye(len(w))
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(g @ w, -30, 30)))
        step = np.linalg.solve((g * (weight * p * (1 - p))[:, None]).T @ g + ridge,
                               g.T @ (weight * (p - y)) + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    own = w[:-1] / spread
    return [*own.tolist(), float(w[-1] - own @ mean)]


def sampled_text(text: Column, limit: int = SAMPLE_CHARS) -> Column:
    """At most ``limit`` characters: the text, or pieces spread evenly over it."""
    size = F.length(text)
    piece = limit // _SAMPLE_PIECES
    # the last piece ends with the text
    pieces = F.transform(F.sequence(F.lit(0), F.lit(_SAMPLE_PIECES - 1)),
                         lambda i: F.substr(text, F.floor((size - piece).cast("long") * i / (_SAMPLE_PIECES - 1)).cast("int") + 1,
                                            F.lit(piece)))
    return F.when(size <= limit, text).otherwise(F.array_join(pieces, ""))


def training_rows(docs: DataFrame, marked: DataFrame, key: str, text: str, rows_per_class: int) -> DataFrame:
    """(_key, _label, _text, _half) of at most ``2 * rows_per_class`` rows.
    ``marked``: distinct (_key, _label)."""
    first = [marked.filter(F.col("_label") == c).orderBy(F.xxhash64("_key", F.lit(2)), "_key").limit(rows_per_class)
             for c in (0, 1)]
    # at most 2 x rows_per_class rows of two small columns
    keys = F.broadcast(first[0].unionByName(first[1]))
    texts = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text")).join(
        F.broadcast(keys.select("_key").distinct()), "_key", "left_semi")
    # a key's rows shrink to one where they are read
    one = (texts.select("_key", F.xxhash64("_text").alias("_at"), sampled_text(F.col("_text")).alias("_text"))
           .groupBy("_key").agg(F.min(F.struct("_at", "_text")).alias("_row")))
    return (one.join(keys, "_key")
            .select("_key", "_label", F.col("_row._text").alias("_text"),
                    F.pmod(F.xxhash64("_key", F.lit(22)), F.lit(2)).alias("_half")))


def train(docs: DataFrame, labels: DataFrame, learn_from: Column, key: str = "doc_id", text: str = "text",
          label: str = "quality", rows_per_class: int = ROWS_PER_CLASS) -> QualityModel:
    """Dictionaries from one half of the sample, the logistic curve from the other."""
    marked = (labels.filter(learn_from & F.col(key).isNotNull() & F.col(label).isin(0, 1))
              .select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label")).distinct())
    counts = {r[0]: r[1] for r in marked.groupBy("_label").count().collect()}
    if len(counts) < 2:
        return QualityModel(b"", b"", [0.0, {(): 0.0, (0,): -40.0, (1,): 40.0}[tuple(counts)]])
    rows = (training_rows(docs, marked, key, text, rows_per_class)
            .orderBy("_key", "_label").toPandas())
    half = rows[rows._half == 0]
    texts = {c: half[half._label == c]._text.tolist() for c in (0, 1)}
    model = QualityModel(build_dictionary(texts[1]), build_dictionary(texts[0]), [0.0, 0.0])
    rest = rows[rows._half == 1]
    if rest._label.nunique() < 2:       # too few rows to spare any
        rest = rows
    if not len(rest):                   # no labelled row has a document
        return model
    scorer = model.scorer()
    x = np.array([[scorer.difference(t)] for t in rest._text])
    y = rest._label.to_numpy(dtype=float)
    seen = {c: max(1, int((y == c).sum())) for c in (0, 1)}
    model.weights = fit_logistic(x, y, np.array([counts[int(c)] / seen[int(c)] for c in y])
                                 * len(y) / (counts[0] + counts[1]))
    return model


def score(docs: DataFrame, model: QualityModel, key: str = "doc_id", text: str = "text",
          name: str = "score") -> DataFrame:
    """(key, score) of every row; higher: likelier of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared.value.scorer()
        for part, texts in text_groups(batches, text):
            yield pa.RecordBatch.from_arrays([part.column(key), pa.array(scorer.scores(texts))], names=[key, name])

    return docs.select(key, text).mapInArrow(run, T.StructType([docs.schema[key], T.StructField(name, T.DoubleType())]))


HELD_OUT_OF, HELD_OUT = 3, 1


def op2_quality(spark, sf_dir: str) -> DataFrame:
    """Quality of every document; learnt from the labels of rows not held out."""
    from llm.common import load

    docs = load(spark, sf_dir, "documents")
    learnable = F.coalesce(remainder("doc_id", HELD_OUT_OF) != HELD_OUT, F.lit(False))
    model = train(docs, load(spark, sf_dir, "labels"), learnable)
    return (score(docs, model)
            .select("doc_id",
                    F.coalesce(remainder("doc_id", HELD_OUT_OF) == HELD_OUT, F.lit(False)).alias("held_out"),
                    "score", (F.col("score") >= 0.5).cast("int").alias("predicted")))
