"""Toxicity by compression distance.

Two zstandard dictionaries are trained on labelled text. Both end in the
same ordinary prose; before it the toxic one holds the strings that set
toxic texts apart and the ordinary one more prose of equal length, so that
all distances are alike. A window that the toxic dictionary compresses
better than the ordinary one speaks for toxicity; a document's windows are
summed up in a few figures, and a logistic curve, fitted on labelled rows
that trained no dictionary, turns them into a calibrated score.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paxflow.llm.memory import frees_memory

# Training uses at most this many labelled rows of each class, the first by
# the MD5 of their id, among rows of at most TRAIN_CHARS characters.
TRAIN_TOXIC = 3000
TRAIN_ORDINARY = 4000
TRAIN_CHARS = 16_000
# A distinguishing string: GRAM bytes long or more, in at least this share of
# the toxic texts, with at least these log odds against the ordinary ones.
GRAM = 5
MIN_SHARE = 0.004
MIN_ODDS = 3.0
TOXIC_BYTES = 2048
SHARED_BYTES = 24_000
WINDOW = 64
STRIDE = 32
LEVEL = 12
GAINS = (2, 3, 4, 5, 6, 8)


def normal(text: str) -> bytes:
    return b" " + " ".join(text.lower().split()).encode("utf-8", "replace") + b" "


def windows(text: str) -> list[bytes]:
    raw = normal(text)
    return [raw[i : i + WINDOW] for i in range(0, max(1, len(raw) - WINDOW + STRIDE), STRIDE)]


@dataclass(frozen=True)
class Model:
    toxic: bytes
    ordinary: bytes
    weights: tuple[float, ...]  # per figure, then the intercept; empty: nothing to learn from

    def scorer(self):
        """Text -> score between 0 and 1."""
        if not self.weights:
            return lambda text: 0.0
        gains, weights = gain_function(self.toxic, self.ordinary), np.array(self.weights)

        def score(text: str) -> float:
            z = float(figures(gains(text)) @ weights[:-1] + weights[-1])
            return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))

        return score


def gain_function(toxic: bytes, ordinary: bytes):
    """Text -> bytes that the toxic dictionary saves against the ordinary one, per window."""
    import zstandard as zstd

    def compressor(content: bytes):
        trained = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
        trained.precompute_compress(level=LEVEL)
        return zstd.ZstdCompressor(
            level=LEVEL, dict_data=trained, write_content_size=False, write_checksum=False, write_dict_id=False
        ).compress

    by_toxic, by_ordinary = compressor(toxic), compressor(ordinary)
    return lambda text: np.array([len(by_ordinary(w)) - len(by_toxic(w)) for w in windows(text)], np.float64)


def figures(gain: np.ndarray) -> np.ndarray:
    """What the score sees of a document: mean and summed gains, the share of
    windows over each gain, the three largest gains, the size."""
    n = len(gain)
    top = np.sort(gain)[::-1][:3]
    return np.array(
        [
            gain.mean(),
            np.maximum(gain, 0).sum() / (n + 5),
            *[(gain >= g).sum() / (n + 5) for g in GAINS],
            top[0],
            top.sum(),
            math.log(n),
        ]
    )


def train_dictionaries(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes]:
    def grams(text: str) -> set[bytes]:
        raw = normal(text)
        return {raw[i : i + GRAM] for i in range(len(raw) - GRAM + 1)}

    of_toxic: Counter = Counter()
    of_ordinary: Counter = Counter()
    for text in toxic:
        of_toxic.update(grams(text))
    for text in ordinary:
        of_ordinary.update(grams(text))
    base = math.log((len(toxic) + 1) / (len(ordinary) + 1))
    least = max(4, MIN_SHARE * len(toxic))
    apart = {g for g, c in of_toxic.items() if c >= least and math.log((c + 0.5) / (of_ordinary[g] + 0.5)) - base >= MIN_ODDS}
    strings: Counter = Counter()
    for text in toxic:
        own = set()
        for word in set(normal(text).split()):
            raw, i = b" " + word + b" ", 0
            while i <= len(raw) - GRAM:
                j = i
                while j <= len(raw) - GRAM and raw[j : j + GRAM] in apart:
                    j += 1
                if j > i:
                    own.add(raw[i : j - 1 + GRAM])
                i = j + 1
        strings.update(own)
    # The most frequent last: the nearer a string, the cheaper its match.
    marks = b""
    for found, count in sorted(strings.items(), key=lambda x: (-x[1], x[0])):
        if count < 4 or len(marks) + len(found) + 1 > TOXIC_BYTES:
            break
        marks = found + b"\n" + marks
    prose = b"".join(normal(t)[:600] for t in ordinary)
    shared = prose[:SHARED_BYTES]
    other = b"".join(normal(t)[700:1000] for t in ordinary)
    return marks + shared, (other + prose[SHARED_BYTES:] + b"\n" * len(marks))[: len(marks)] + shared


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[float, ...]:
    """Logistic regression by Newton steps, on standardised figures."""
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.c_[(x - mean) / spread, np.ones(len(x))]
    w, penalty = np.zeros(z.shape[1]), np.full(z.shape[1], ridge)
    penalty[-1] = 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty + 1e-9), z.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    own = w[:-1] / spread
    return (*own.tolist(), float(w[-1] - own @ mean))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model from labelled rows outside the held-out fold.

    Rows are chosen by id and text length alone; only the texts chosen, a
    bounded number, are read as texts. Several labels of an id count as their
    largest, several texts as the first in order. Half of the sample trains
    the dictionaries, the other half the curve.
    """
    marks = labels.groupBy(F.col(id_col).alias("id")).agg(F.max("toxic").alias("toxic")).filter(~held_out(F.col("id")))
    short = docs.filter(F.length(text_col) <= TRAIN_CHARS)
    usable = short.select(F.col(id_col).alias("id")).distinct().join(marks, "id").withColumn("draw", F.md5(F.col("id").cast("string")))
    sample: dict[int, list[str]] = {}
    for label, most in ((1, TRAIN_TOXIC), (0, TRAIN_ORDINARY)):
        chosen = usable.filter(F.col("toxic") == label).orderBy("draw").limit(most).select("id", "draw")
        texts = short.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id")
        found = texts.groupBy("draw").agg(F.min("text").alias("text")).collect()
        sample[label] = [r.text for r in sorted(found, key=lambda r: r.draw)]
    if min(map(len, sample.values())) < 8:
        return Model(b"", b"", ())
    toxic, ordinary = train_dictionaries(sample[1][::2], sample[0][::2])
    gains = gain_function(toxic, ordinary)
    held = [(t, 1) for t in sample[1][1::2]] + [(t, 0) for t in sample[0][1::2]]
    weights = fit_curve(np.array([figures(gains(t)) for t, _ in held]), np.array([y for _, y in held], float))
    return Model(toxic, ordinary, weights)


def held_out(id_col: Column, folds: int = 5, fold: int = 0) -> Column:
    """Whether the row's labels are kept from training."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == fold, F.lit(False))


def score_texts(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` plus ``score`` (0 to 1). A map over rows: each whole text is
    cut into overlapping windows; a null or empty text is one empty window."""
    fields = [f for f in docs.schema.fields if f.name != "score"]
    kept = docs.select(*[F.col(f"`{f.name}`") for f in fields])

    @frees_memory
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = model.scorer()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            scores = pa.array([of(t.as_py() or "") for t in texts], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*batch.schema.names, "score"])

    from pyspark.sql.types import DoubleType, StructField, StructType

    return kept.mapInArrow(score, StructType([*fields, StructField("score", DoubleType())]))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col, held_out, score, predicted``.

    Labels of the held-out fold are never read. Without at least 8 training
    rows of each class every score is 0. Repeated rows get equal scores, an
    empty table gives an empty result, other columns are never inputs.
    """
    model = train(docs, labels, id_col, text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    scored = score_texts(rows, model, "id", "text")
    return scored.select(
        F.col("id").alias(id_col),
        held_out(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
