"""Compression quality classifier (operator 9).

Two zstandard dictionaries are built, one from good and one from bad labelled
text. A text is cut into chunks of 1 KiB, each compressed on its own with both
dictionaries, so a long text cannot teach the compressor its own words. The
normalised difference of the two compressed sizes, with both sizes and the
length beside it, becomes a probability by logistic calibration on labelled rows
that no dictionary has seen.

What is learned comes from bounded samples of the labelled rows (parameters of
`train`); scoring reads every whole text.
"""

from __future__ import annotations

import functools
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vigil.llm import common

CHUNK_BYTES = 1024
DICTIONARY_BYTES = 110 << 10
LEVEL = 3
THRESHOLD = 0.3
#: Documented sample bounds: rows of each label that chunks are drawn from, chunks
#: of each label that a dictionary is built from, and rows for the calibration.
DICTIONARY_ROWS, DICTIONARY_CHUNKS, CALIBRATION_ROWS = 1500, 5000, 20_000


@dataclass(frozen=True)
class Model:
    """Dictionaries (bad, good), calibration, and the score where it has neither."""
    dictionaries: tuple[bytes, bytes]
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    constant: float | None = None


def chunks(text: str) -> list[bytes]:
    raw = text.encode("utf-8", "surrogatepass")
    return [raw[i:i + CHUNK_BYTES] for i in range(0, len(raw), CHUNK_BYTES)] or [b""]


@functools.lru_cache(maxsize=4)
def _compressors(dictionaries: tuple[bytes, bytes]) -> list[zstandard.ZstdCompressor]:
    return [zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_checksum=False,
                                     write_content_size=False, write_dict_id=False) for d in dictionaries]


def features(dictionaries: tuple[bytes, bytes], text: str) -> tuple[float, ...]:
    parts = chunks(text)
    bad, good = (sum(len(c.compress(x)) for x in parts) for c in _compressors(dictionaries))
    n = sum(map(len, parts)) + 20  # about the bytes that a frame has besides its content
    return (bad - good) / (bad + good), (bad - good) / n, good / n, (good / n) ** 2, math.log(n)


def build_dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or the samples themselves where they are too few to train on."""
    samples = [s for s in samples if s]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES] or b"\n" * 8


def calibrate(x: np.ndarray, y: np.ndarray, rounds: int = 40) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean, scale and weights of a ridge logistic regression (Newton steps)."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.c_[np.ones(len(x)), (x - mean) / scale]
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hessian = (z * (p * (1 - p) + 1e-6)[:, None]).T @ z + 1e-2 * np.eye(len(w))
        w = w + np.linalg.solve(hessian, z.T @ (y - p) - 1e-2 * w)
    return mean, scale, w


def probability(model: Model, text: str) -> float:
    if model.constant is not None:
        return model.constant
    x = (np.array(features(model.dictionaries, text)) - model.mean) / model.scale
    return float(1 / (1 + math.exp(-min(30.0, max(-30.0, model.weights[0] + x @ np.array(model.weights[1:]))))))


def held_out() -> Column:
    """crc32 of the id as text, mod 5, is 0; false for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from the labelled documents outside the held-out fifth.

    Samples follow a hash of the id, so they do not depend on file order. Rows with
    a null id or label teach nothing; where a document has several labels the larger
    counts, and where it has several rows the largest text. If one label has no rows, the model's score is the share of label 1
    (0.5 without any rows).
    """
    spark = docs.sparkSession
    marked = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
              .where("doc_id is not null and label in (0, 1)").where(~held_out())
              .groupBy("doc_id").agg(F.max("label").alias("label")))
    known = marked.join(docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "doc_id", "left_semi")
    order = F.xxhash64("doc_id", F.lit("sample"))
    # a third of the labelled rows calibrates, the rest gives the dictionaries
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(3)) == 0
    known = known.withColumn("calibrates", part).withColumn("at", order)
    picks = None
    for where, n in (("calibrates", CALIBRATION_ROWS), ("not calibrates and label = 0", DICTIONARY_ROWS),
                     ("not calibrates and label = 1", DICTIONARY_ROWS)):
        some = known.where(where).orderBy("at").limit(n)
        picks = some if picks is None else picks.unionByName(some)
    picked = [(r["doc_id"], r["label"], r["calibrates"], r["at"]) for r in picks.collect()]  # bounded by the limits
    counts = [sum(p[1] == k for p in picked) for k in (0, 1)]
    if not all(counts):
        return Model((b"", b""), (), (), (), counts[1] / sum(counts) if sum(counts) else 0.5)
    small = spark.createDataFrame(picked, "doc_id long, label int, calibrates boolean, at long")
    # one text a document, however often its row is repeated: of several the largest
    texts = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_of().alias("text"))
             .join(F.broadcast(small), "doc_id").groupBy("doc_id", "label", "calibrates", "at").agg(F.max("text").alias("text")))

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [(label, at, k, c) for label, at, t in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)
                for k, c in enumerate(chunks(t))]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
            zip(*rows, strict=True), (pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["label", "at", "k", "chunk"])

    pieces = common.python_rows(texts.where("not calibrates").select("label", "at", "text"), cut,
                                "label int, at long, k long, chunk binary")
    spread = F.xxhash64("at", "k")
    dictionaries = tuple(
        build_dictionary([bytes(r[0]) for r in pieces.where(F.col("label") == k).orderBy(spread, "chunk")
                          .select("chunk").limit(DICTIONARY_CHUNKS).collect()]) for k in (0, 1))

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"label": batch.column(0), "at": batch.column(1), "x": [
            list(features(dictionaries, t)) for t in batch.column(2).to_pylist()]},
            pa.schema([("label", pa.int32()), ("at", pa.int64()), ("x", pa.list_(pa.float64()))]))

    seen = common.python_rows(texts.where("calibrates").select("label", "at", "text"), measure,
                              "label int, at long, x array<double>").orderBy("at", "x").collect()
    y = np.array([r["label"] for r in seen], float)
    if len(set(y)) < 2:
        return Model((b"", b""), (), (), (), counts[1] / sum(counts))
    mean, scale, weights = calibrate(np.array([r["x"] for r in seen]), y)
    return Model(dictionaries, tuple(mean), tuple(scale), tuple(weights))


def with_score(docs: DataFrame, model: Model, column: str) -> DataFrame:
    """`docs` with the probability of label 1 of each whole text (null: empty) as `column`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of at most 110 KiB

    @F.pandas_udf("double")
    def rate(texts):
        import pandas as pd
        return pd.Series([probability(shared.value, t or "") for t in texts], dtype=float)

    return docs.withColumn(column, rate("text"))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of `docs` (repeated rows too): doc_id, held_out, score, predicted.

    Reads `doc_id` and `text`; other columns are left out. A null doc_id is not held out.
    """
    rated = with_score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model, "score")
    return rated.select("doc_id", held_out().alias("held_out"), "score",
                        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def accepted(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs`, all columns, whose score reaches the threshold."""
    name = common.fresh(docs, "_score")
    return with_score(docs, model, name).where(F.col(name) >= threshold).drop(name)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents from labels outside the held-out fifth."""
    docs = common.table(spark, sf_dir, "documents")
    return score(docs, train(docs, common.table(spark, sf_dir, "labels")))
