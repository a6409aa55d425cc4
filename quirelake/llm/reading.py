"""Problem 10: the reading level of each document.

Graded texts say at which grade a word is at home: its acquisition grade is the middle of its
smoothed distribution over the levels, every level weighing alike, on a scale from 0 to 1. A document's level comes from
quantiles of the grades of its known words, calibrated by logistic regression on the same graded
texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirelake.session import stage

#: Labelled documents the calibration is fitted on at most, the first by a hash of their id; words are graded by all.
SAMPLE = 6000
#: Words that take part occur in so many labelled documents at least.
LEAST_DOCS = 3
QUANTILES = (0.1, 0.25, 0.5, 0.75, 0.9)
LEVELS = (1, 2, 3, 4)
LEAST_WORDS = 60

# Frequent words of four languages that tell them apart.
STOPWORDS = {
    "en": "the of and to in is that it for was with as be by this are which from an at not have has its their can we our you were on no but or than so because when",
    "de": "der die das und ist nicht mit von zu den im für auf ein eine einen dem des sich wird bei durch über oder aus wurde dass nach wenn dabei kleine",
    "fr": "le la les de des du et est une un dans pour que qui sur par avec ne pas au aux ce cette sont ont été plus nous comme ou où",
    "es": "el la los las de del y es una un en para que con por se no al lo su como más sus este esta son fue entre cuando",
}
_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
_FENCE = re.compile(r"(?m)^(`{3,}|~{3,})[^\n]*\n(?:[^\n]*\n)*?(?:\1[^\n]*$|\Z)")
_FORMULA = re.compile(r"\$\$[^$]*\$\$|\$[^$\n]+\$")
_TAG = re.compile(r"<page_number>[^<]*</page_number>")
#: Headings and table rows; a longer line is prose that lost its breaks.
_FURNITURE = re.compile(r"(?m)^(?:#{1,6} |\|)[^\n]{0,100}$")
_REFERENCE = re.compile(r"\b(?:vol\. ?\d|pp\. ?\d|et al|doi:)|\(\d{4}\)|\d{4};\d")


class Model(NamedTuple):
    grades: dict[str, float]
    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    quantiles: tuple[float, ...]


def prose_words(text: str | None) -> list[str]:
    """Lower-case words of the prose: without code, formulas, headings, tables, page markers and reference lists."""
    if not text:
        return []
    if "```" in text or "~~~" in text:
        text = _FENCE.sub(" ", text)
    if "$" in text:
        text = _FORMULA.sub(" ", text)
    if "<page" in text:
        text = _TAG.sub(" ", text)
    if "# " in text or "|" in text:
        text = _FURNITURE.sub(" ", text)
    if _REFERENCE.search(text):
        text = "\n".join(line for line in text.split("\n") if not (len(line) < 400 and _REFERENCE.search(line)))
    if "’" in text:
        text = text.replace("’", "'")
    return _WORD.findall(text.lower())


_SETS = {k: frozenset(v.split()) for k, v in STOPWORDS.items()}


def is_english(words: list[str]) -> bool:
    """Whether English stop words make up an eighth of ``words`` and outnumber those of the other languages."""
    if not words:
        return False
    hits = {k: sum(map(v.__contains__, words)) for k, v in _SETS.items()}
    return hits["en"] >= 0.125 * len(words) and hits["en"] > max(v for k, v in hits.items() if k != "en")


def features(words: list[str], grades: dict[str, float], quantiles: tuple[float, ...] = QUANTILES) -> np.ndarray:
    """Quantiles and mean of the grades of the known words; without any, the middle of the scale."""
    known = np.fromiter((g for g in map(grades.get, words) if g is not None), float)
    if not len(known):
        return np.full(len(quantiles) + 3, 0.5)
    known.sort()
    at = np.minimum((np.array(quantiles) * len(known)).astype(int), len(known) - 1)
    return np.concatenate([known[at], [known.mean(), (known < 0.25).mean(), (known > 0.75).mean()]])


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def grades_of(counts: dict[str, np.ndarray], total: np.ndarray) -> dict[str, float]:
    """Acquisition grades of the words with their ``counts`` (occurrences, then documents, by level) among ``total`` words by level."""
    grades = {}
    for w, c in counts.items():
        if c[len(LEVELS) :].sum() >= LEAST_DOCS:
            share = (c[: len(LEVELS)] + 0.1) / total
            share /= share.sum()
            grades[w] = float((np.arange(len(LEVELS)) * share).sum() / (len(LEVELS) - 1))
    return grades


def count_words(rows) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Counts of each word and words in all by level, of (words, level from 0) pairs."""
    counts: dict[str, np.ndarray] = {}
    total = np.zeros(len(LEVELS))
    for words, level in rows:
        for w, n in Counter(words).items():
            if w not in counts:
                counts[w] = np.zeros(2 * len(LEVELS))
            counts[w][level] += n
            counts[w][len(LEVELS) + level] += 1
        total[level] += len(words)
    return counts, total


def _empty() -> Model:
    return Model({}, np.zeros((len(QUANTILES) + 4, len(LEVELS))), np.zeros(len(QUANTILES) + 3), np.ones(len(QUANTILES) + 3), QUANTILES)


def calibrate(x: np.ndarray, y: np.ndarray, keep: np.ndarray, grades: dict[str, float]) -> Model:
    """The logistic calibration of levels ``y`` (from 0) on the :func:`features` ``x`` by ``grades``, those of ``keep``."""
    mean, scale = x[keep].mean(0), x[keep].std(0) + 1e-6
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    weights = np.zeros((z.shape[1], len(LEVELS)))
    zk, tk = z[keep], np.eye(len(LEVELS))[y][keep]
    step = np.zeros_like(weights)
    for _ in range(600):
        gradient = zk.T @ (_softmax(zk @ weights) - tk) / len(zk) + 1e-4 * weights
        step = 0.9 * step - 0.5 * gradient
        weights += step
    return Model(grades, weights, mean, scale, QUANTILES)


def plausible(x: np.ndarray, level: int, model: Model) -> bool:
    """Whether ``model`` doesn't find the label ``level`` (from 0) of a text with the features ``x`` far off."""
    z = np.append((x - model.mean) / model.scale, 1.0)
    return bool(_softmax((z @ model.weights)[None])[0, level] > 0.05)


def fit(texts: list[str], levels: list[int], rounds: int = 2) -> Model:
    """Grades and calibration from graded texts; a second round leaves out labels the first finds far off.

    Deterministic. With no texts every document gets the middle of the scale.
    """
    rows = [prose_words(t) for t in texts]
    y = np.array(levels, int) - 1
    keep = np.ones(len(y), bool)
    model = _empty()
    for _ in range(rounds if len(y) else 0):
        counts, total = count_words((w, k) for w, k, kept in zip(rows, y, keep) if kept)
        grades = grades_of(counts, total + 1)
        x = np.array([features(w, grades) for w in rows])
        model = calibrate(x, y, keep, grades)
        keep = np.array([plausible(f, k, model) for f, k in zip(x, y)])
    return model


def predict(words: list[str], model: Model) -> int:
    z = np.append((features(words, model.grades, model.quantiles) - model.mean) / model.scale, 1.0)
    return int(np.argmax(z @ model.weights)) + 1


def _grades(labelled: DataFrame, model: Model | None) -> dict[str, float]:
    """Grades from all ``labelled`` texts, with ``model`` those whose labels it doesn't find far off; counted within each task before the shuffle."""
    shared = labelled.sparkSession.sparkContext.broadcast(model)
    names = [f"n{i}" for i in range(2 * len(LEVELS))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            rows = ((prose_words(t), k - 1) for t, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            counts, _ = count_words((w, k) for w, k in rows if model is None or plausible(features(w, model.grades, model.quantiles), k, model))
            columns = np.array(list(counts.values())).reshape(-1, len(names)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), *(pa.array(c) for c in columns.T)], ["word", *names])

    each = labelled.select("text", "level").mapInArrow(run, "word string, " + ", ".join(f"{n} bigint" for n in names))
    summed = stage(each.groupBy("word").agg(*(F.sum(n).alias(n) for n in names)))
    total = np.array([v or 0 for v in summed.agg(*(F.sum(n) for n in names[: len(LEVELS)])).first()], float)
    known = summed.where(" + ".join(names[len(LEVELS) :]) + f" >= {LEAST_DOCS}").orderBy("word")
    return grades_of({r[0]: np.array(r[1:], float) for r in known.toLocalIterator()}, total + 1)


def fit_levels(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, rounds: int = 2) -> Model:
    """As :func:`fit`: grades from all labelled documents of ``documents``, calibration on at most ``sample`` of them, chosen by a hash of ``doc_id``."""
    marked = labels.where(F.col("level").isin(*LEVELS)).select("doc_id", F.col("level").cast("int").alias("level"))
    labelled = stage(documents.select("doc_id", F.col("text").cast("string").alias("text")).where("text IS NOT NULL").join(marked, "doc_id"))
    chosen = stage(labelled.orderBy(F.xxhash64("doc_id"), "doc_id", "level").limit(sample))
    keep, model = None, None
    for _ in range(rounds):
        grades = _grades(labelled, model)
        x, y = _features(chosen, grades)
        if not len(y):
            break
        model = calibrate(x, y, np.ones(len(y), bool) if keep is None else keep, grades)
        keep = np.array([plausible(f, k, model) for f, k in zip(x, y)])
    return model or _empty()


def _features(chosen: DataFrame, grades: dict[str, float]) -> tuple[np.ndarray, np.ndarray]:
    """Features and levels (from 0) of the sampled documents in a fixed order: some numbers of each come to the driver, no text does."""
    shared = chosen.sparkSession.sparkContext.broadcast(grades)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [features(prose_words(t), shared.value).tolist() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(made, pa.list_(pa.float64()))], ["doc_id", "level", "x"])

    found = sorted((tuple(r) for r in chosen.select(F.col("doc_id").cast("bigint"), "text", "level").mapInArrow(run, "doc_id bigint, level int, x array<double>").collect()), key=lambda r: r[:2])
    return np.array([r[2] for r in found], float), np.array([r[1] for r in found], int) - 1


def reading_levels(documents: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row for each document: ``key``, ``n_words`` (split at white space), ``english`` and ``level``.

    A map without shuffle over whole texts. ``level`` is null where the text isn't English or its
    prose has no word; null and empty texts have 0 words. Other columns are not read.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([documents.schema[key], T.StructField("n_words", T.IntegerType()), T.StructField("english", T.BooleanType()), T.StructField("level", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            n, english, levels = [], [], []
            for value in batch.column(1).to_pylist():
                words = prose_words(value)
                n.append(len((value or "").split()))
                english.append(is_english(words))
                levels.append(predict(words, model) if english[-1] else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int32()), pa.array(english), pa.array(levels, pa.int32())], schema.names)

    return documents.select(key, F.col(text).cast("string")).mapInArrow(run, schema)
