"""Language identification with a string kernel.

A text's features are the letter strings of 1 to 4 characters that occur in
it, each counted once (a blended spectrum of presences); the kernel of two
texts is the number of strings they share over the root of the product of
their own numbers. Landmark windows of training texts span a Nyström space:
a text is its kernel values with the landmarks, turned by the inverse root of
the landmarks' own kernel matrix. One ridge regression per language, that
language against the rest, is fitted in this space from sums that tasks add
up, and the largest answer names the language.

Kernel values with the landmarks are products of a presence matrix (texts by
strings) and the landmarks' presences (strings by landmarks). The regression
follows as one more matrix; for scoring the two are multiplied first, so a
slice of texts costs one sparse product with as many columns as languages.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paxflow.llm.matrices import LINE_DDL, matrix_lines, summed_matrix
from paxflow.llm.memory import frees_memory
from paxflow.llm.words import slices
from paxflow.plans.sizing import stored

LONGEST = 4  # characters of a string
LETTER_BITS = 12  # a letter's number; LONGEST * LETTER_BITS + 16 bits of the text's number make 64
MOST_LETTERS = (1 << LETTER_BITS) - 2
MOST_TEXTS = 1 << 15  # texts of a slice
# The regression is fitted on at most this many training rows, shared evenly by the languages (4 each at least).
TRAIN_ROWS = 8000
# Landmarks: this many windows of training texts, shared evenly (1 each at least), of this many characters.
LANDMARKS = 256
LANDMARK_CHARS = 1200
RIDGE = 1e-3  # times the number of training rows
TEXTS_AT_ONCE = 128  # of dense presence rows in training

UNDETERMINED = "und"


def held_out(id_col: Column, folds: int = 3, fold: int = 1) -> Column:
    """Whether the row's language is kept from training."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == fold, F.lit(False))


def normal(texts: pa.Array) -> pa.Array:
    """Lower-cased letters; everything between words is one space, and so are both ends."""
    lowered = pc.utf8_lower(pc.fill_null(texts, "").cast(pa.large_string()))
    letters = pc.replace_substring_regex(lowered, r"[^\p{L}\p{M}]+", " ")
    nothing, space = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
    return pc.binary_join_element_wise(nothing, pc.utf8_trim(letters, " "), nothing, space)


def has_letter(texts: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)


def _code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all code points, where each text begins, and the end)."""
    lengths = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    joined = "".join(texts.to_pylist()).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(joined, np.uint32), np.r_[0, np.cumsum(lengths)]


class Alphabet:
    """Numbers of letters, from 1; letters it does not know share the last number."""

    def __init__(self, letters: np.ndarray):
        self.letters = letters  # sorted code points

    @classmethod
    def of(cls, texts: pa.Array) -> Alphabet:
        letters, counts = np.unique(_code_points(texts)[0], return_counts=True)
        common = np.lexsort((letters, -counts))[:MOST_LETTERS]
        return cls(np.sort(letters[common]))

    def numbers(self, points: np.ndarray) -> np.ndarray:
        if not len(self.letters):
            return np.full(len(points), MOST_LETTERS + 1, np.uint64)
        at = np.minimum(np.searchsorted(self.letters, points), len(self.letters) - 1)
        return np.where(self.letters[at] == points, at + 1, MOST_LETTERS + 1).astype(np.uint64)

    def strings(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(text, code) of the distinct strings of each text, in order. A code
        is the letters' numbers side by side, so no two strings share one."""
        points, bounds = _code_points(texts)
        text = np.repeat(np.arange(len(bounds) - 1, dtype=np.uint64), np.diff(bounds))
        numbers = self.numbers(points)
        width = np.uint64(LETTER_BITS)
        found, code = [], np.zeros(len(points), np.uint64)
        for size in range(1, LONGEST + 1):
            if len(points) < size:
                break
            code = (code[: len(points) - size + 1] << width) | numbers[size - 1 :]
            inside = text[: len(code)] == text[size - 1 :]
            found.append((text[: len(code)][inside] << np.uint64(48)) | code[inside])
        keys = np.sort(np.concatenate(found)) if found else np.empty(0, np.uint64)
        keys = keys[np.r_[True, keys[1:] != keys[:-1]]] if len(keys) else keys
        return (keys >> np.uint64(48)).astype(np.int64), keys & np.uint64((1 << 48) - 1)


def known_strings(letters: np.ndarray, codes: np.ndarray, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place in ``codes``) of the strings in ``codes`` that occur, and each text's number of all its strings."""
    text, code = Alphabet(letters).strings(texts)
    sizes = np.bincount(text, minlength=len(texts))
    if not len(codes):
        return text[:0], text[:0], sizes
    at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
    known = codes[at] == code
    return text[known], at[known], sizes


@dataclass(frozen=True)
class Landmarks:
    letters: np.ndarray
    codes: np.ndarray  # sorted codes of all strings of the landmarks
    presence: np.ndarray  # (codes, landmarks), over the root of the landmark's number of strings
    turn: np.ndarray  # inverse root of the landmarks' kernel matrix

    @classmethod
    def of(cls, windows: list[str]) -> Landmarks:
        texts = normal(pa.array(windows, pa.string()))
        alphabet = Alphabet.of(texts)
        text, code = alphabet.strings(texts)
        codes, column = np.unique(code, return_inverse=True)
        sizes = np.maximum(np.bincount(text, minlength=len(windows)), 1)
        presence = np.zeros((len(codes), len(windows)), np.float32)
        presence[column, text] = (1 / np.sqrt(sizes))[text]
        kernel = presence.T.astype(np.float64) @ presence
        value, vector = np.linalg.eigh(kernel)
        # directions that the landmarks do not span are left out
        kept = value > 1e-6 * value.max(initial=0)
        turn = vector[:, kept] / np.sqrt(value[kept])
        return cls(alphabet.letters, codes, presence, turn)

    def features(self, texts: pa.Array) -> np.ndarray:
        """Normal texts in the Nyström space, (texts, directions)."""
        text, at, sizes = known_strings(self.letters, self.codes, texts)
        dense = np.zeros((len(texts), len(self.codes)), np.float32)
        dense[text, at] = 1
        return (dense @ self.presence).astype(np.float64) @ self.turn / np.sqrt(np.maximum(sizes, 1))[:, None]


@dataclass(frozen=True)
class Model:
    """Languages, most frequent first, and their weights per string."""

    languages: tuple[str, ...]
    letters: np.ndarray
    codes: np.ndarray
    weights: np.ndarray  # (codes, languages)

    def answers(self, texts: pa.Array) -> np.ndarray:
        """Regression values of normal texts, (texts, languages), between about -1 and 1."""
        text, at, sizes = known_strings(self.letters, self.codes, texts)
        found = np.zeros((len(texts), len(self.languages)))
        if len(text):
            first = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
            for k in range(len(self.languages)):  # a column at a time bounds what is gathered
                found[text[first], k] = np.add.reduceat(self.weights[at, k], first)
        return found / np.sqrt(np.maximum(sizes, 1))[:, None]


def _slices(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    for part in slices(batch, text):
        for start in range(0, part.num_rows, MOST_TEXTS):
            yield part.slice(start, MOST_TEXTS)


def _sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> tuple[DataFrame, list[tuple[str, int]]]:
    """(training rows: lang, draw, text; languages with their numbers of rows).

    Rows are chosen per language by a hash of their id, without their texts;
    then the texts of the rows chosen are read. Of several texts of an id and
    language the first in order counts."""
    usable = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.col("text") != "") & ~held_out(F.col("id"))
    )
    counts = [(r["lang"], r["rows"]) for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")).collect()]
    counts.sort(key=lambda c: (-c[1], c[0]))
    each = max(4, TRAIN_ROWS // max(1, len(counts)))
    draw = F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit("null")))
    ids = usable.select("lang", draw.alias("draw")).distinct()
    order = Window.partitionBy("lang").orderBy("draw")
    chosen = ids.withColumn("turn", F.row_number().over(order)).filter(F.col("turn") <= each)
    texts = usable.withColumn("draw", draw).join(F.broadcast(chosen), ["lang", "draw"])
    return texts.groupBy("lang", "turn").agg(F.min("text").alias("text")), counts


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """A model from training rows with a language and a text; None without any."""
    sample, counts = _sample(docs, id_col, text_col, lang_col)
    if not counts:
        return None
    languages = tuple(lang for lang, _ in counts)
    rows = stored(sample, "language-sample")
    each = max(1, LANDMARKS // len(languages))
    start = F.pmod(F.xxhash64("text"), F.greatest(F.lit(1), F.length("text") - LANDMARK_CHARS + 1)).cast("int") + 1
    picked = rows.filter(F.col("turn") <= each).select("lang", "turn", F.substring("text", start, F.lit(LANDMARK_CHARS)).alias("window"))
    windows = [r["window"] for r in sorted(picked.collect(), key=lambda r: (r["lang"], r["turn"]))]
    marks = Landmarks.of(windows)
    width, n_lang = marks.turn.shape[1], len(languages)
    if not width:
        return Model(languages, marks.letters, marks.codes, np.zeros((len(marks.codes), n_lang)))
    number = {lang: k for k, lang in enumerate(languages)}

    @frees_memory
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, sums, rows_of = np.zeros((width, width)), np.zeros((n_lang, width)), 0
        for batch in batches:
            for part in _slices(batch, 1):
                texts = normal(part.column(1))
                label = np.array([number[v] for v in part.column(0).to_pylist()])
                for start in range(0, part.num_rows, TEXTS_AT_ONCE):
                    block = marks.features(texts.slice(start, TEXTS_AT_ONCE))
                    gram += block.T @ block
                    np.add.at(sums, label[start : start + TEXTS_AT_ONCE], block)
                rows_of += part.num_rows
        if rows_of:
            yield from matrix_lines(np.r_[gram, sums])

    spread = rows.select("lang", "turn", "text").repartition("lang", "turn").select("lang", "text")
    total = summed_matrix(spread.mapInArrow(add, LINE_DDL), width)
    gram, sums = total[:width], total[width:]
    against = 2 * sums - sums.sum(axis=0)  # targets: 1 for the language, -1 for the rest
    weights = np.linalg.solve(gram + RIDGE * rows.count() * np.eye(width), against.T)
    return Model(languages, marks.letters, marks.codes, marks.presence.astype(np.float64) @ (marks.turn @ weights))


_PREDICTED = "doc_id bigint, held_out boolean, lang_pred string, score double"


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row: a map over whole texts.

    ``score`` is the largest regression value, brought from [-1, 1] to [0, 1].
    A text that is null or has no letter, and every text where there is no
    model, is ``und`` with score 0. Texts that share no string with a landmark,
    and ties, go to the most frequent language.
    """

    @frees_memory
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(model.languages if model else (UNDETERMINED,), object)
        for batch in batches:
            for part in _slices(batch, 2):
                texts = part.column(2)
                named = has_letter(texts) if model else np.zeros(part.num_rows, bool)
                language, score = np.full(part.num_rows, UNDETERMINED, object), np.zeros(part.num_rows)
                if named.any():
                    answers = model.answers(normal(texts.filter(pa.array(named))))
                    best = answers.argmax(axis=1)
                    language[named] = names[best]
                    score[named] = np.clip((answers[np.arange(len(best)), best] + 1) / 2, 0, 1)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(language, pa.string()), pa.array(score)],
                    ["doc_id", "held_out", "lang_pred", "score"],
                )

    asked = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text")
    )
    return asked.mapInArrow(predict, _PREDICTED)


def languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Train on ``docs`` and name the language of every row of it.

    Rows of the held-out fold (and only they) never train; a null id is not
    held out. Null languages, null and empty texts train nothing; rows that
    share id and language train once, with the first of their texts. Very long
    texts are read whole. Repeated rows get equal answers, an empty table gives
    an empty result, and other columns are never inputs.
    """
    return identify(docs, train(docs, id_col, text_col, lang_col), id_col, text_col)
