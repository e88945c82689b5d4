"""Quality classifier by compression with dictionaries of good and of bad text."""

from __future__ import annotations

import math

import numpy as np
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeflow.llm.common import map_rows, session

#: Labelled rows of each class that the model is fitted on, at most (a documented bound of the sample).
FIT_ROWS = 1200
#: Labelled texts longer than so many characters are not fitted on (the same bound, of bytes); all texts are scored whole.
FIT_CHARS = 100_000
#: Bytes of one dictionary.
DICT_BYTES = 48 * 1024
LEVEL = 3
#: Texts are compressed in pieces of so many bytes, and sizes added: far copies within a text don't count.
PIECE = 512
#: Predicted good from this score on.
THRESHOLD = 0.3


def fit_labels(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> list[tuple[int, str]]:
    """(quality, text) of at most ``rows`` labelled documents of each class outside the held-out fifth.

    The ids are chosen first, by a hash, so only their texts are joined and sent: a bounded number of bounded texts.
    A document with contradictory labels is left out; of several texts with one id the least counts.
    """
    known = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other")).where("quality = other and pmod(crc32(cast(doc_id as string)), 5) <> 0")
    picked = None
    for q in (0, 1):
        part = known.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).select("doc_id", "quality")
        picked = part if picked is None else picked.unionByName(part)
    short = docs.select("doc_id", "text").where(F.length("text").between(1, FIT_CHARS))
    got = short.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text")).collect()
    return [(r["quality"], r["text"]) for r in sorted(got, key=lambda r: r["doc_id"])]


class Model:
    """Two dictionaries and the calibration that turns sizes into a score."""

    def __init__(self, good: bytes, bad: bytes, weights: list[float]):
        self.good, self.bad, self.weights = good, bad, weights
        self._tools = None

    def __getstate__(self):
        return self.good, self.bad, self.weights

    def __setstate__(self, state):
        self.__init__(*state)

    def difference(self, text: str | None) -> float:
        """How much smaller the text gets with the good dictionary than with the bad one, as a share of both sizes."""
        if self._tools is None:
            self._tools = [zstd.ZstdCompressor(level=LEVEL, dict_data=zstd.ZstdCompressionDict(d) if d else None, write_checksum=False, write_content_size=False, write_dict_id=False) for d in (self.good, self.bad)]
        raw = (text or "").encode("utf-8", "surrogatepass")
        good = bad = 0
        for i in range(0, len(raw), PIECE):
            piece = raw[i : i + PIECE]
            good += len(self._tools[0].compress(piece))
            bad += len(self._tools[1].compress(piece))
        return (bad - good) / (bad + good) if raw else 0.0

    def features(self, text: str | None) -> np.ndarray:
        return np.array([1.0, self.difference(text)])

    def score(self, text: str | None) -> float:
        z = float(self.features(text) @ np.array(self.weights))
        return 1.0 / (1.0 + math.exp(-max(-50.0, min(50.0, z))))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> list[float]:
    """Newton steps of a ridge logistic regression on standardised columns."""
    mean, sd = x.mean(axis=0), x.std(axis=0)
    mean[0], sd[sd < 1e-9] = 0.0, 1.0
    sd[0] = 1.0
    z = (x - mean) / sd
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (weight * (p - y)) + ridge * w
        hess = (z * (weight * p * (1 - p))[:, None]).T @ z + (ridge + 1e-9) * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    raw = w / sd
    raw[0] = w[0] - float((w[1:] * mean[1:] / sd[1:]).sum())
    return raw.tolist()


def train(rows: list[tuple[int, str]]) -> Model:
    """Dictionaries from all labelled texts; their differences are calibrated on halves, each scored by dictionaries from the other.

    With one class only, the score is that class's smoothed share for every text.
    """
    by = {q: [t for label, t in rows if label == q] for q in (0, 1)}
    if min(len(by[0]), len(by[1])) < 8:
        share = (len(by[1]) + 1) / (len(rows) + 2)
        return Model(b"", b"", [math.log(share / (1 - share)), 0.0])
    x, y = [], []
    for fold in (0, 1):
        part = Model(_dictionary(by[1][fold::2]), _dictionary(by[0][fold::2]), [])
        for q in (0, 1):
            for t in by[q][1 - fold :: 2]:
                x.append(part.features(t))
                y.append(q)
    y = np.array(y, dtype=float)
    return Model(_dictionary(by[1]), _dictionary(by[0]), _logistic(np.array(x), y, np.ones(len(y))))


def _dictionary(texts: list[str]) -> bytes:
    raws = [t.encode("utf-8", "surrogatepass") for t in texts]
    samples = [raw[i : i + PIECE] for raw in raws for i in range(0, len(raw), PIECE)]
    samples = [s for s in samples if len(s) >= 8]
    size = min(DICT_BYTES, max(1024, sum(map(len, samples)) // 8))
    try:
        return zstd.train_dictionary(size, samples).as_bytes()
    except zstd.ZstdError:
        return b"".join(samples)[:size]  # too little text for the trainer: the text itself is the dictionary


def classify(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document.

    One map over the scan: each whole text is compressed with both dictionaries. The model (two dictionaries of
    ``DICT_BYTES`` and two weights) is broadcast. Labels, language, source and ids are never inputs of a score.
    Defined results: null and empty texts get the score of an empty text; null ids are not held out; repeated rows
    give a row each; without labels of both classes every score is the smoothed share; other columns are not read.
    """
    spark = session(docs)
    model = spark.sparkContext.broadcast(train(fit_labels(docs, labels, fit_rows)))

    def make():
        m = model.value
        return lambda ids, texts: [ids, [m.score(t) for t in texts]]

    scored = map_rows(docs, ["doc_id", "text"], f"doc_id {dict(docs.dtypes)['doc_id']}, score double", make)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
