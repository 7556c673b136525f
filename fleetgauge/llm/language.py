"""Language of a text: its family first, then linear machines between the family's languages.

A text is the frequencies of its runs of two to four bytes, letters only. One linear
support vector machine for each pair of families decides the family by votes, then one
for each pair of its languages decides the language. Margins are turned into
probabilities on training rows that the machines have not seen.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetgauge.llm import words as W
from fleetgauge.llm.sampling import training_rows
from fleetgauge.llm.tiles import bound_batches, give_back

UNKNOWN = "und"
# Families of languages by their codes; any other language is a family of its own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fy", "is", "lb", "nl", "no", "nb", "nn", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "baltic": ("lt", "lv"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "ky", "tr", "uz"),
    "semitic": ("am", "ar", "he", "mt"),
    "indo-aryan": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
    "dravidian": ("kn", "ml", "ta", "te"),
    "sinitic": ("wuu", "yue", "zh"),
    "austronesian": ("id", "jv", "ms", "tl"),
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}

FEATURES = 1 << 13
RUNS = (2, 3, 4)
# The bound of the training sample: rows, the same number of each language, and characters of a text.
TRAINING_ROWS = 3000
TRAINING_CHARS = 20_000
# Rows of a language that its probabilities need before they are shifted.
FEW = 10

# Bytes that are no letters become blanks, A-Z become a-z; bytes above 127 are parts of letters.
_LETTERS = np.full(256, 0x20, dtype=np.uint32)
_LETTERS[0x80:] = np.arange(0x80, 0x100)
_LETTERS[ord("a") : ord("z") + 1] = _LETTERS[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)


def features(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Square roots of the hashed runs' frequencies, a row of length 1 for each text."""
    out = np.zeros((len(bounds) - 1, FEATURES), dtype=np.float32)
    for row, (low, high) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        total = np.zeros(FEATURES, dtype=np.int64)
        for start in range(low, high, W.SEGMENT):
            # Runs that cross the edge of a segment are counted with it.
            part = _LETTERS[data[max(low, start - RUNS[-1] + 1) : min(high, start + W.SEGMENT)]]
            before = min(start - low, RUNS[-1] - 1)
            code = part.copy()
            for run in range(2, RUNS[-1] + 1):
                code = code[:-1] * np.uint32(0x01000193) + part[run - 1 :]
                own = code[max(before - run + 1, 0) :] if before else code
                hashed = ((own ^ (own >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - 13)
                total += np.bincount(hashed, minlength=FEATURES)
        out[row] = np.sqrt(total / max(total.sum(), 1))
    return out


@dataclass
class Sample:
    """Rows of features as their entries that are not 0, as the driver holds them for training."""

    values: list[np.ndarray]
    places: list[np.ndarray]

    @classmethod
    def of(cls, data: np.ndarray, bounds: np.ndarray) -> Sample:
        out = cls([], [])
        for low in range(0, len(bounds) - 1, 64):
            for row in features(data, bounds[low : low + 65]):
                out.places.append(np.flatnonzero(row).astype(np.uint16))
                out.values.append(row[out.places[-1]])
        return out

    def __len__(self) -> int:
        return len(self.values)

    def of_rows(self, chosen: np.ndarray) -> Sample:
        rows = np.flatnonzero(chosen).tolist()
        return Sample([self.values[k] for k in rows], [self.places[k] for k in rows])

    def matrix(self, chosen: np.ndarray) -> np.ndarray:
        """All entries of the rows that are chosen: 32 KB a row, so no more than two classes' rows at a time."""
        rows = np.flatnonzero(chosen).tolist()
        out = np.zeros((len(rows), FEATURES), dtype=np.float32)
        for row, k in zip(out, rows):
            row[self.places[k]] = self.values[k]
        return out


def _machine(x: np.ndarray, y: np.ndarray, penalty: float = 0.001, steps: int = 60) -> tuple[np.ndarray, float]:
    """Linear support vector machine with squared hinge loss, by accelerated gradient steps.

    ``y`` is 1 or -1; both sides weigh the same however many rows they have.
    """
    y = y.astype(x.dtype)
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(x.dtype)
    w = np.zeros(x.shape[1] + 1, dtype=x.dtype)
    look, speed = w.copy(), 1.0
    # Rows and the bias have length 1 each, so the gradient's slope is 4 at most.
    rate = x.dtype.type(1 / (4 + penalty))
    for _ in range(steps):
        pull = weight * y * np.maximum(0, 1 - y * (x @ look[:-1] + look[-1]))
        step = look - rate * (np.append(pull @ x, pull.sum()) * -2 + x.dtype.type(penalty) * look)
        faster = (1 + np.sqrt(1 + 4 * speed * speed)) / 2
        look, w, speed = step + x.dtype.type((speed - 1) / faster) * (step - w), step, faster
    return w[:-1], float(w[-1])


def _sigmoid(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift that make margins probabilities of ``y`` > 0, by Newton steps with smoothed targets.

    Both sides weigh the same here too: how many rows a language has says nothing of a text.
    A side of a few rows says nothing of where the middle is, so there is no shift.
    """
    up, down = (y > 0).sum(), (y < 0).sum()
    weight = np.where(y > 0, 0.5 * len(y) / max(up, 1), 0.5 * len(y) / max(down, 1))
    target = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    slope, shift = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margin + shift, -30, 30)))
        off = weight * (p - target)
        g = np.array([(off * margin).sum() + 1e-3 * slope, off.sum()])
        v = weight * p * (1 - p)
        if min(up, down) < FEW:
            slope -= np.clip(g[0] / ((v * margin * margin).sum() + 1e-3), -2, 2)
            continue
        h = np.array([[(v * margin * margin).sum() + 1e-3, (v * margin).sum()], [(v * margin).sum(), v.sum() + 1e-6]])
        move = np.linalg.solve(h, g)
        slope, shift = slope - np.clip(move[0], -2, 2), shift - np.clip(move[1], -2, 2)
    return float(max(slope, 1e-3)), float(shift)


@dataclass
class Round:
    """One-versus-one machines between classes."""

    classes: list[str]
    pairs: list[tuple[int, int]]
    weights: np.ndarray
    biases: np.ndarray
    slopes: np.ndarray
    shifts: np.ndarray

    @classmethod
    def fit(cls, x: Sample, labels: np.ndarray, check: np.ndarray) -> Round:
        """Machines from the rows not in ``check``, probabilities from those in it."""
        classes = sorted(set(labels.tolist()))
        pairs = list(combinations(range(len(classes)), 2))
        weights, rest = np.zeros((FEATURES, len(pairs)), dtype=np.float32), []
        for k, (a, b) in enumerate(pairs):
            own = np.isin(labels, [classes[a], classes[b]])
            y = np.where(labels == classes[a], 1.0, -1.0)
            learn = own & ~check
            if len(set(y[learn])) < 2:
                learn = own
            weights[:, k], bias = _machine(x.matrix(learn), y[learn])
            test = own & check
            if len(set(y[test])) < 2:
                test = own
            rest.append((bias, *_sigmoid(x.matrix(test) @ weights[:, k] + bias, y[test])))
        rest = np.array(rest).reshape(len(pairs), 3)
        return cls(classes, pairs, weights, rest[:, 0], rest[:, 1], rest[:, 2])

    def decide(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The class with most votes, ties by summed probability, and its probability."""
        if not self.pairs:
            return np.zeros(len(x), dtype=np.int64), np.ones(len(x))
        p = 1 / (1 + np.exp(-np.clip((x @ self.weights + self.biases) * self.slopes + self.shifts, -30, 30)))
        votes, sums = np.zeros((2, len(x), len(self.classes)))
        for k, (a, b) in enumerate(self.pairs):
            votes[:, a] += p[:, k] >= 0.5
            votes[:, b] += p[:, k] < 0.5
            sums[:, a] += p[:, k]
            sums[:, b] += 1 - p[:, k]
        best = np.argmax(votes + sums / (len(self.classes) + 1), axis=1)
        shares = sums / sums.sum(axis=1, keepdims=True) if len(self.classes) == 2 else _coupled(p, self.pairs, len(self.classes))
        return best, shares[np.arange(len(x)), best]


def _coupled(p: np.ndarray, pairs: Sequence[tuple[int, int]], classes: int) -> np.ndarray:
    """Class probabilities from pairwise ones: normalised geometric means."""
    logs = np.zeros((len(p), classes))
    for k, (a, b) in enumerate(pairs):
        logs[:, a] += np.log(np.clip(p[:, k], 1e-9, 1))
        logs[:, b] += np.log(np.clip(1 - p[:, k], 1e-9, 1))
    shares = np.exp((logs - logs.max(axis=1, keepdims=True)) * 2 / classes)
    return shares / shares.sum(axis=1, keepdims=True)


@dataclass
class LanguageModel:
    families: Round | None
    languages: dict[str, Round]

    @classmethod
    def fit(cls, texts: Sequence[str] | pa.ChunkedArray, labels: Sequence[str]) -> LanguageModel:
        if not len(texts):
            return cls(None, {})
        x = Sample.of(*W.text_buffers(texts if isinstance(texts, pa.ChunkedArray) else pa.array(texts, pa.string())))
        labels = np.array(labels, dtype=object)
        family = np.array([FAMILY_OF.get(code.split("-")[0].lower(), code) for code in labels], dtype=object)
        check = np.arange(len(x)) % 4 == 0
        inner = {name: Round.fit(x.of_rows(family == name), labels[family == name], check[family == name]) for name in set(family)}
        return cls(Round.fit(x, family, check), inner)

    def predict(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Language and probability of each text."""
        x = features(*W.text_buffers(texts))
        lang, score = np.full(len(x), UNKNOWN, dtype=object), np.zeros(len(x))
        if self.families is None:
            return lang, score
        family, sure = self.families.decide(x)
        for k, name in enumerate(self.families.classes):
            own = np.flatnonzero(family == k)
            inner = self.languages[name]
            best, share = inner.decide(x[own])
            lang[own] = np.array(inner.classes, dtype=object)[best]
            score[own] = sure[own] * share
        return lang, score


def has_letters(texts: pa.Array) -> np.ndarray:
    """Whether a text has a letter of any script."""
    found = pa.compute.match_substring_regex(texts.fill_null(""), r"\pL")
    return found.to_numpy(zero_copy_only=False)


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> LanguageModel:
    """Learn from at most TRAINING_ROWS rows that are not held out and have a language, evenly from each.

    Null and empty texts and languages teach nothing; repeated rows may be drawn as often as they come.
    """
    rows = docs.select(key, F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    rows = training_rows(rows.toDF("key", "text", "lang"), "key", "text", "lang", TRAINING_ROWS, TRAINING_CHARS)
    # In a fixed order, so that the same rows make the same model.
    sample = rows.toArrow().sort_by([(c, "ascending") for c in ("key", "text", "lang")])
    sample = sample.filter(has_letters(sample["text"])) if len(sample) else sample
    model = LanguageModel.fit(sample["text"], sample["lang"].to_pylist())
    give_back()
    return model


def predictions(model: LanguageModel, texts: pa.Array):
    """(low, high, language, score) of a column, a portion of rows at a time."""
    # A row of features takes 32 KB.
    for low, high in W.slices(texts, 1 << 20):
        for start in range(low, high, 512):
            part = texts.slice(start, min(high, start + 512) - start)
            lang, score = model.predict(part)
            blank = ~has_letters(part)
            lang[blank], score[blank] = UNKNOWN, 0.0
            yield start, start + len(part), lang, np.clip(score, 0, 1)
    give_back()


def _identified(model: LanguageModel, names: list[str]) -> Callable:
    def run(batches):
        for batch in batches:
            for low, high, lang, score in predictions(model, batch.column(1)):
                keys = batch.column(0).slice(low, high - low)
                yield pa.RecordBatch.from_arrays([keys, pa.array(lang, pa.string()), pa.array(score)], names=names)

    return run


def identify(docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``lang_pred`` and ``score`` (0 to 1) of every row, from the whole text alone.

    A null or empty text, or one without a letter, is ``und`` with score 0, as is every
    text for a model without training rows. One row for each row, repeated ones included;
    columns other than ``key`` and ``text`` are not read.
    """
    bound_batches(docs.sparkSession)
    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), *T.StructType.fromDDL("lang_pred string, score double")])
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    rows = rows.mapInArrow(_identified(model, schema.names), schema)
    return rows.select(F.col("key").alias(key), "lang_pred", "score")


def keep_identified(docs: DataFrame, model: LanguageModel, least: float, text: str = "text") -> DataFrame:
    """Rows, whole, whose language is known with a score of ``least`` or more.

    Null and empty texts and those without a letter go. Repeated rows are judged alike, an empty
    table stays empty, and no other column is looked at, whatever its name.
    """
    bound_batches(docs.sparkSession)
    at = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            keep = [(lang != UNKNOWN) & (score >= least) for _, _, lang, score in predictions(model, batch.column(at).cast(pa.string()))]
            if keep:
                yield batch.filter(pa.array(np.concatenate(keep)))

    names = [f"c{i}" for i in range(len(docs.columns))]
    renamed = docs.toDF(*names)
    return renamed.mapInArrow(run, renamed.schema).toDF(*docs.columns)
