"""A quality classifier from compression: which of two dictionaries, built from good and bad text, fits a text better.

``fit`` takes labelled texts, trains one zstandard dictionary per class on one part of them and calibrates on the other.
A text is cut into pieces of ``PIECE`` bytes (all of it, so long texts are judged by the same measure as short ones);
its pieces are compressed with either dictionary, and (bad size - good size) / bytes of the text goes through a
logistic curve to a score between 0 and 1.

The only bounded part is the labelled sample: at most ``ROWS_PER_CLASS`` keys of each class in the order of a hash of the
key, of these the rows with texts of at most ``LONGEST`` bytes, and at most ``SAMPLE_BYTES`` bytes a class. Texts are
learned from whole or not at all. Scoring reads every text whole, in narrow tasks.

Defined results: a null or empty text has difference 0 and the score that belongs to it; null labels, and keys whose
label rows disagree, are not learned from; repeated label rows count once; a class without rows makes every score the share of the other one; equal texts get equal scores; other columns
are carried whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ripecast.llm import spans
from ripecast.llm.common import as_text, fresh, text_last

ROWS_PER_CLASS = 4_000
SAMPLE_BYTES = 12 << 20
LONGEST = 192 << 10
DICTIONARY_BYTES = 112 << 10
PIECE = 2_048
LEVEL = 3


@dataclass(frozen=True)
class Model:
    """Both dictionaries and the curve: score = 1 / (1 + exp(-(slope * difference + shift)))."""

    good: bytes
    bad: bytes
    slope: float
    shift: float

    def score(self, difference: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * difference + self.shift, -30.0, 30.0)))


class Sizes:
    """Compressed sizes of texts under one dictionary."""

    def __init__(self, dictionary: bytes):
        if dictionary:
            ready = zstandard.ZstdCompressionDict(dictionary)
            ready.precompute_compress(level=LEVEL)
            self.packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=ready, write_content_size=False, write_dict_id=False)
        else:
            self.packer = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)

    def of(self, text: bytes | memoryview) -> int:
        return sum(len(self.packer.compress(text[k : k + PIECE])) for k in range(0, len(text), PIECE))


def difference(good: Sizes, bad: Sizes, text: bytes | memoryview) -> float:
    if not len(text):
        return 0.0
    g, b = good.of(text), bad.of(text)
    return (b - g) / len(text)


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    key: str,
    text: str,
    label: str,
    rows: int = ROWS_PER_CLASS,
    most_bytes: int = SAMPLE_BYTES,
    longest: int = LONGEST,
) -> DataFrame:
    """key, text, label of the bounded sample. The chosen keys are at most two times ``rows`` and are broadcast."""
    order = F.md5(F.col("k").cast("string"))
    known = labels.select(F.col(key).alias("k"), F.col(label).alias("y")).where(F.col("k").isNotNull() & F.col("y").isin(0, 1))
    known = known.groupBy("k").agg(F.min("y").alias("y"), F.max("y").alias("other")).where(F.col("y") == F.col("other")).drop("other")
    chosen = [known.where(F.col("y") == y).orderBy(order, "k").limit(rows) for y in (0, 1)]
    keys = chosen[0].unionByName(chosen[1])
    found = docs.select(F.col(key).alias("k"), as_text(text).alias("text")).join(F.broadcast(keys), "k")
    # before the running sum, so that the rows behind a very long one still take part
    found = found.where(F.octet_length("text") <= longest)
    sofar = Window.partitionBy("y").orderBy(order, "k").rowsBetween(Window.unboundedPreceding, 0)
    sized = found.withColumn("bytes", F.sum(F.octet_length("text")).over(sofar))
    return sized.where(F.col("bytes") <= most_bytes).select(F.col("k").alias("key"), "text", F.col("y").alias("label"))


def _dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary; the text itself where there is too little of it to train on."""
    pieces = [t[k : k + PIECE] for t in texts for k in range(0, len(t), PIECE)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[-DICTIONARY_BYTES:]


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 100) -> tuple[float, float]:
    """Slope and shift by Newton steps, with a light penalty on the slope so that separable data stay finite."""
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 1.0) / (len(y) + 2.0)
        return 0.0, float(np.log(share / (1.0 - share)))
    scale = float(np.std(x)) or 1.0
    design = np.column_stack([x / scale, np.ones(len(x))])
    w, penalty = np.zeros(2), np.diag([0.01, 1e-6])
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(design @ w, -30, 30)))
        step = np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + penalty, design.T @ (y - p) - penalty @ w)
        w = w + np.clip(step, -2.0, 2.0)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1])


def fit(rows: list[tuple[bytes, int, bool]]) -> Model:
    """From (text, label, whether it calibrates): dictionaries from the rest, the curve from those that calibrate."""
    train = [(t, y) for t, y, calibrates in rows if not calibrates]
    good, bad = (_dictionary([t for t, y in train if y == wanted]) for wanted in (1, 0))
    a, b = Sizes(good), Sizes(bad)
    held = [(difference(a, b, t), y) for t, y, calibrates in rows if calibrates]
    slope, shift = _logistic(np.array([d for d, _ in held]), np.array([y for _, y in held], float))
    return Model(good, bad, slope, shift)


def _task(model: Model, kept: int):
    """Scores of the last column; the first ``kept`` columns are given back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good, bad = Sizes(model.good), Sizes(model.bad)
        for batch in batches:
            scores = []
            for _, _, data, offsets in spans.slices(batch.column(batch.num_columns - 1)):
                view = memoryview(np.ascontiguousarray(data))
                scores.append([difference(good, bad, view[offsets[k] : offsets[k + 1]]) for k in range(len(offsets) - 1)])
            found = model.score(np.array([d for part in scores for d in part], float))
            columns = [batch.column(k) for k in range(kept)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.float64())], names=[*batch.schema.names[:kept], "score"])

    return run


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score", keep_text: bool = True) -> DataFrame:
    """The input rows with ``out``, the calibrated score; without the text where it is not to be kept."""
    own, columns, kept, schema = text_last(docs, text, keep_text)
    scored = own.mapInArrow(_task(model, kept), f"{schema}, score double" if schema else "score double")
    wanted = [c for c in docs.columns if keep_text or c != text]
    return scored.select(*[columns[c] for c in wanted], "score").toDF(*wanted, fresh(wanted, out))


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", folds: int = 5) -> Model:
    """The model from the labelled rows given (drop held-out rows before); the last fold by key calibrates."""
    sample = labelled_sample(docs, labels, key, text, label)
    fold = F.crc32(F.col("key").cast("string").cast("binary")) % folds
    found = sample.select("text", "label", (fold == folds - 1).alias("calibrates"), "key").orderBy("key", "text").collect()
    return fit([(r["text"].encode(), int(r["label"]), bool(r["calibrates"])) for r in found])
