"""Licence notices in texts: a trained paragraph classifier, confirmed by its templates.

Paragraphs are lines, read through windows of some words where they are long. A window's
runs of one to three words are features of a logistic regression over the licence
families, an unknown family and no licence at all, trained on the notices of
``licence_texts`` with words lost, changed and put around them; its temperature is set on
variants it has not seen. A family it predicts must then be like one of that family's
notices, word pair by word pair, or the paragraph counts as of unknown family.

Every other family that has a word of its own in the window, and a notice nearly all of
whose word pairs are there, is found with it: works may be under several licences.

Only windows that hold an anchor, a word that speaks for a licence, can score for one, as
every feature has one; other windows are passed over without a change in result. ``mit`` is
an anchor only beside words of licensing, being a word of everyday German.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetgauge.llm import words as W
from fleetgauge.llm.licence_texts import NO_TERMS, NOTICES, OTHER_TERMS

UNKNOWN, NONE = "unknown", "none"
WINDOW = 64
SURE = 0.5
ALIKE = 0.4
# The likeness by which a family is found that the classifier did not put first.
CONFIRMED = 0.75
RUNS = (1, 2, 3)
VARIANTS = 24
# Words too common to speak for a licence.
COMMON = frozenset(
    "a above all an and any are as asked at be by can copies do each either end file for found from had has have he her his in into is it "
    "its later law list may must name no not note of on or our out own paper part people person plan possible prior project "
    "received related rest retain river said see she should show so some south spring that the their them this to until up use "
    "was were which who with without work works year years you your i we they if new two ten one more than book city end "
    "mit only under version released published use used using source sold subject provided available agreed kind either "
    "first form forms free house hours large letter made man means members month general public".split()
)
# Words before and after the one licence whose name is a common word.
BEFORE_NAME = frozenset("under the license licence licensed identifier or and".split())
AFTER_NAME = frozenset("license licence licensed".split())
COMMON_NAME = "mit"
_TOKEN = re.compile(r"[^\W\d_]+|\d+")
_LETTERS = np.zeros(256, dtype=np.uint8)
_LETTERS[0x80:] = 1
_LETTERS[ord("a") : ord("z") + 1] = _LETTERS[ord("A") : ord("Z") + 1] = 1
_LETTERS[ord("0") : ord("9") + 1] = 2


def named(words: list[str]) -> list[str]:
    """The words, those that name a licence by a common word marked as names."""
    for k, word in enumerate(words):
        if word == COMMON_NAME:
            before, after = words[k - 1] if k else "", words[k + 1] if k + 1 < len(words) else ""
            if after in AFTER_NAME or before in BEFORE_NAME:
                words[k] = f"{word}!"
    return words


def tokens(text: str) -> list[str]:
    return named([t.lower() for t in _TOKEN.findall(text)])


def is_anchor(token: str) -> bool:
    return token not in COMMON and not token.isdigit() and (len(token) > 2 or token == "cc")


def features(words: Sequence[str], anchors: frozenset[str]) -> Counter:
    """Runs of words that hold an anchor."""
    out = Counter()
    for run in RUNS:
        for k in range(len(words) - run + 1):
            own = words[k : k + run]
            if any(w in anchors for w in own):
                out[" ".join(own)] += 1
    return out


def _pairs(words: Sequence[str]) -> Counter:
    plain = [w for w in words if not w.isdigit()]
    return Counter(zip(plain, plain[1:]))


def alike(words: Sequence[str], notice: Counter) -> float:
    """Share of a notice's word pairs that the words have, or of theirs if they are fewer; numbers aside."""
    own = _pairs(words)
    size = min(sum(own.values()), sum(notice.values()))
    return sum((own & notice).values()) / size if size else 0.0


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


@dataclass
class LicenceModel:
    classes: list[str]
    anchors: frozenset[str]
    vocabulary: dict[str, int]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    notices: dict[str, list[Counter]]
    # Words that only one family's notices have.
    own: dict[str, frozenset[str]]

    @classmethod
    def train(cls) -> LicenceModel:
        drawn = np.random.default_rng(11)
        labelled = [(family, tokens(t)) for family, notices in NOTICES.items() for t in notices]
        labelled += [(UNKNOWN, tokens(t)) for t in OTHER_TERMS] + [(NONE, tokens(t)) for t in NO_TERMS]
        around = [w for t in NO_TERMS for w in tokens(t)]
        rows = [(label, words) for label, own in labelled for words in _variants(own, label, around, drawn)]
        classes = [*NOTICES, UNKNOWN, NONE]
        # A word of the notices by itself, amid words never met, names no licence.
        rows += [(NONE, [w]) for w in sorted({w for _, own in labelled for w in own}) for _ in range(4)]
        anchors = frozenset(w for label, own in labelled if label != NONE for w in own if is_anchor(w))
        counted = [features(words, anchors) for _, words in rows]
        vocabulary = {f: k for k, f in enumerate(sorted(set().union(*counted)))}
        said = {label: {w for family, own in labelled if family == label for w in own} for label in classes}
        alone = {f: frozenset(w for w in said[f] & anchors if sum(w in other for other in said.values()) == 1) for f in NOTICES}
        model = cls(classes, anchors, vocabulary, None, None, 1.0, {}, alone)
        model.notices = {f: [_pairs(tokens(t)) for t in notices] for f, notices in NOTICES.items()}
        model.notices[UNKNOWN] = [_pairs(tokens(t)) for t in OTHER_TERMS] + sum(model.notices.values(), [])
        x = model._matrix(counted)
        y = np.eye(len(classes))[[classes.index(label) for label, _ in rows]]
        check = np.arange(len(rows)) % 4 == 3
        model._fit(x[~check], y[~check])
        tried = np.geomspace(0.25, 4, 41)
        logits = x[check] @ model.weights + model.bias
        losses = [-np.mean(np.log(_softmax(logits / t)[y[check] > 0] + 1e-12)) for t in tried]
        model.temperature = float(tried[int(np.argmin(losses))])
        return model

    def _matrix(self, counted: Sequence[Counter]) -> np.ndarray:
        """A row of length 1 for each text, or of zeros without features."""
        x = np.zeros((len(counted), len(self.vocabulary)), dtype=np.float32)
        for row, own in enumerate(counted):
            known = [(self.vocabulary[f], n) for f, n in own.items() if f in self.vocabulary]
            if known:
                at, often = np.array(known).T
                x[row, at] = 1 + np.log(often)
                x[row] /= np.linalg.norm(x[row])
        return x

    def _fit(self, x: np.ndarray, y: np.ndarray, steps: int = 250, penalty: float = 1e-4) -> None:
        w, bias = np.zeros((x.shape[1], y.shape[1]), np.float32), np.zeros(y.shape[1], np.float32)
        look, speed = w.copy(), 1.0
        for _ in range(steps):
            off = (_softmax(x @ look + bias) - y).astype(np.float32) / len(x)
            step = look - 2.0 * (x.T @ off + np.float32(penalty) * look)
            bias -= 2.0 * off.sum(axis=0)
            faster = (1 + np.sqrt(1 + 4 * speed * speed)) / 2
            look, w, speed = step + np.float32((speed - 1) / faster) * (step - w), step, faster
        self.weights, self.bias = w, bias

    def judge(self, windows: Sequence[Sequence[str]]) -> list[tuple[str, float, float]]:
        """The first family of each window, its probability and likeness to its nearest notice."""
        return [found[0] for found in self.judge_all(windows)]

    def judge_all(self, windows: Sequence[Sequence[str]]) -> list[list[tuple[str, float, float]]]:
        """Every family that a window of words names, the likeliest first; or that it names none."""
        out = []
        for low in range(0, len(windows), 256):
            part = windows[low : low + 256]
            p = _softmax((self._matrix([features(w, self.anchors) for w in part]) @ self.weights + self.bias) / self.temperature)
            for words, own in zip(part, p):
                best = int(np.argmax(own))
                family, sure = self.classes[best], float(own[best])
                like = max((alike(words, n) for n in self.notices.get(family, [])), default=0.0)
                if family != NONE and (sure < SURE or like < ALIKE):
                    # Not surely this one: some licence, if that is likelier than none and notices speak so.
                    licence = 1 - float(own[self.classes.index(NONE)])
                    like = max((alike(words, n) for n in self.notices[UNKNOWN]), default=0.0)
                    family, sure = (UNKNOWN, licence) if licence >= SURE and like >= ALIKE else (NONE, 1 - licence)
                found = [(family, sure, like)]
                words_here = set(words)
                for k, other in enumerate(NOTICES):
                    if other != family and self.own[other] & words_here:
                        near = max(alike(words, n) for n in self.notices[other])
                        if near >= CONFIRMED:
                            found.append((other, float(own[k]), near))
                if len(found) > 1 and family in (UNKNOWN, NONE):
                    # What is confirmed by its notice is neither unknown nor nothing.
                    del found[0]
                out.append(found)
        return out


def _variants(own: list[str], label: str, around: list[str], drawn: np.random.Generator) -> list[list[str]]:
    """The words as they are, and with some lost, numbers changed, and other words before and after."""
    out = [own]
    for _ in range(VARIANTS - 1):
        kept = [w for w in own if drawn.random() > 0.12] or own
        kept = [str(drawn.integers(1, 10)) if w.isdigit() and drawn.random() < 0.3 else w for w in kept]
        if drawn.random() < 0.5:
            low = int(drawn.integers(0, len(around) - 30))
            kept = around[low : low + int(drawn.integers(0, 12))] + kept
        if drawn.random() < 0.5:
            low = int(drawn.integers(0, len(around) - 30))
            kept = kept + around[low : low + int(drawn.integers(0, 12))]
        out.append(kept)
    return out


@lru_cache(maxsize=1)
def trained() -> LicenceModel:
    return LicenceModel.train()


def _hashes(words: Sequence[str]) -> np.ndarray:
    return W.run_hashes(*W.text_buffers(pa.array(words)), _LETTERS, fold_case=True)[0]


@lru_cache(maxsize=1)
def _anchor_hashes() -> np.ndarray:
    return np.sort(_hashes(sorted(w for w in trained().anchors if not w.endswith("!"))))


def _with_anchors(texts: pa.Array) -> np.ndarray:
    """Which texts have a word of the notices."""
    found = np.zeros(len(texts), dtype=bool)
    table = _anchor_hashes()
    for low, high in W.slices(texts, 1 << 20):
        hashes, bounds = W.run_hashes(*W.text_buffers(texts.slice(low, high - low)), _LETTERS, fold_case=True)
        hit = table[np.minimum(np.searchsorted(table, hashes), len(table) - 1)] == hashes
        # A name that is a common word counts beside its words; texts' edges only let too much through.
        is_name = np.flatnonzero(hashes == _hashes([COMMON_NAME])[0])
        if len(is_name):
            before, after = hashes[np.maximum(is_name - 1, 0)], hashes[np.minimum(is_name + 1, len(hashes) - 1)]
            hit[is_name] = np.isin(before, _hashes(sorted(BEFORE_NAME))) | np.isin(after, _hashes(sorted(AFTER_NAME)))
        hits = np.concatenate([[0], np.cumsum(hit)])
        found[low:high] = hits[bounds[1:]] > hits[bounds[:-1]]
    return found


def findings(text: str, model: LicenceModel) -> list[tuple[int, int, int, str, float, float, str]]:
    """(paragraph, start, end, family, probability, likeness, words' text) of each licence in a text.

    ``start`` and ``end`` are characters of the text. Of a long line's windows those of one
    family that overlap are one finding, from the first's start to the last's end, as sure
    as the surest of them.
    """
    windows, places = [], []
    at = 0
    for number, line in enumerate(text.split("\n")):
        words = [(m.group().lower(), m.start(), m.end()) for m in _TOKEN.finditer(line)]
        words = [(w, *place) for w, (_, *place) in zip(named([w[0] for w in words]), words)]
        flags = [w[0] in model.anchors for w in words]
        if any(flags):
            for low in range(0, max(len(words) - WINDOW // 2, 1), WINDOW // 2):
                own = words[low : low + WINDOW]
                if any(flags[low : low + WINDOW]):
                    windows.append([w[0] for w in own])
                    places.append((number, at + own[0][1], at + own[-1][2]))
        at += len(line) + 1
    found, last = [], {}
    judged = [(place, one) for place, every in zip(places, model.judge_all(windows)) for one in every]
    for (number, start, end), (family, sure, like) in judged:
        if family == NONE:
            continue
        at = last.get((number, family))
        if at is not None and start < found[at][2]:
            _, first, _, _, surest, nearest = found[at]
            sure, like = (sure, like) if sure > surest else (surest, nearest)
            found[at] = (number, first, end, family, sure, like)
        else:
            last[number, family] = len(found)
            found.append((number, start, end, family, sure, like))
    return [(n, s, e, f, p, like, text[s:e]) for n, s, e, f, p, like in sorted(found, key=lambda r: (r[0], r[3], r[1]))]


def _scanned(names: list[str]) -> Callable:
    def run(batches):
        model = trained()
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            rows = np.flatnonzero(_with_anchors(texts))
            found, owner = [], []
            for row, text in zip(rows.tolist(), texts.take(pa.array(rows)).to_pylist()):
                own = findings(text, model)
                found += own
                owner += [row] * len(own)
            columns = list(zip(*found)) or [[]] * 7
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.float64(), pa.string()]
            arrays = [pa.array(list(c), k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([keys.take(pa.array(owner, pa.int64())), *arrays], names=names)

    return run


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each licence notice: ``key``, ``paragraph`` (line, from 0), ``start``, ``end``,
    ``family``, ``probability``, ``likeness`` and ``notice``.

    Null and empty texts have none. Repeated rows have theirs each; columns other than
    ``key`` and ``text`` are not read.
    """
    fields = "paragraph long, start long, end long, family string, probability double, likeness double, notice string"
    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), *T.StructType.fromDDL(fields).fields])
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_scanned(schema.names), schema).withColumnRenamed("key", key)
