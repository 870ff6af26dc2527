"""Quality classifier by co-training.

Two views of a document are judged apart: its text content, and its page
metadata (source, language, length, layout of lines). Both are fitted to a
bounded sample of labelled documents. Over some rounds each labels the
unlabelled documents it is surest of, and the other learns from those. On
labelled documents kept aside each view is calibrated to true chances, and a
last model weighs the two. That one scores all documents.

The rounds go over all unlabelled documents. A round is told by its weights
and cuts, so what a document has been labelled so far follows from the
rounds before and is not stored. Tasks give sums only: the slope and
bend of a Newton step, or how many documents have which score.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import lean, packed, settled, unpacked
from .quality import class_counts

# Bound of the labelled sample that the models are fitted to.
MAX_LABELLED = 20_000
# Steps of log odds that a cut is told by, and the highest odds that are told apart.
_BINS, _SUREST = 4096, 30.0
# So many sums reach the driver at most in one pass over the documents.
_SUMS = 128

_HASHED = 64
CONTENT = 21
METADATA = 7 + 2 * _HASHED


def content_features(text: str) -> list[float]:
    """Shares of characters and words, and how far words and lines repeat."""
    words = text.split()
    n = max(1, len(words))
    chars = max(1, len(text))
    lengths = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    shares = class_counts(text) / chars
    lines = [x for x in text.split("\n") if x.strip()]
    after = sum(a == b for a, b in zip(words, words[1:], strict=False)) / n
    return [
        *shares.tolist(),
        len(set(words)) / n,
        after,
        lengths.mean() / 10,
        lengths.std() / 10,
        np.log1p(n) / 10,
        1 - len(set(lines)) / max(1, len(lines)),
        sum(text.count(c) for c in ".!?") / n,
        text.count("|") / n,
        text.count("!!") / n,
        sum(w.isupper() for w in words) / n,
        sum(not any(map(str.isalpha, w)) for w in words) / n,
        1.0,
    ]


def metadata_features(chars: int, lines: int, source: str | None, lang: str | None) -> list[float]:
    """Where a page comes from and how long it and its lines are, without its words."""
    row = [0.0] * METADATA
    row[:7] = [
        1.0,
        np.log1p(chars) / 10,
        np.log1p(lines) / 10,
        np.log1p(chars / lines) / 10,
        float(chars == 0),
        float(source is None),
        float(lang is None),
    ]
    row[7 + xxhash.xxh3_64_intdigest(source or "") % _HASHED] = 1.0
    row[7 + _HASHED + xxhash.xxh3_64_intdigest(lang or "") % _HASHED] = 1.0
    return row


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _odds(x: np.ndarray, beta: np.ndarray) -> np.ndarray:
    """Row by row, so that a document has the same odds in any batch."""
    return (x * beta).sum(1)


def _newton_sums(x: np.ndarray, y: np.ndarray, beta: np.ndarray) -> np.ndarray:
    """Number, loss, slope and bend of each class, end to end. ``y`` is NaN for rows that don't count."""
    out = []
    for side in (1.0, 0.0):
        own = x[y == side]
        odds = own @ beta
        p = _sigmoid(odds)
        loss = np.logaddexp(0, -odds if side else odds).sum()
        out += [[len(own), loss], own.T @ (p - side), ((own * (p * (1 - p))[:, None]).T @ own).ravel()]
    return np.concatenate(out)


class _Fit:
    """Logistic regression by Newton steps, the classes weighted alike; a step that does not pay is halved.

    ``at`` is where the next sums are wanted.
    """

    def __init__(self, beta: np.ndarray, ridge: float):
        self.at, self.ridge, self.done = beta, ridge, False
        self.base, self.loss, self.move, self.gain = beta, np.inf, 0.0, 0.0

    def size(self) -> int:
        return 2 * (2 + len(self.at) + len(self.at) ** 2)

    def take(self, sums: np.ndarray) -> None:
        k = len(self.at)
        loss, slope, bend = self.ridge / 2 * self.at @ self.at, self.ridge * self.at, self.ridge * np.eye(k)
        for own in sums.reshape(2, -1):
            weight = 0.5 / max(1.0, own[0])
            loss = loss + weight * own[1]
            slope = slope + weight * own[2 : k + 2]
            bend = bend + weight * own[k + 2 :].reshape(k, k)
        if loss > self.loss - 1e-4 * self.gain + 1e-12:
            self.move, self.gain = self.move / 2, self.gain / 2
        else:
            self.base, self.loss = self.at, loss
            self.move = np.linalg.solve(bend, slope)
            self.gain = slope @ self.move
        self.at = self.base - self.move
        self.done = np.abs(self.move).max() < 1e-6


@dataclass(frozen=True)
class Model:
    """Two views with their scales, calibrations and joint weights; without views everything passes."""

    content: np.ndarray | None = None
    metadata: np.ndarray | None = None
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    calibration: tuple = ()
    joint: np.ndarray | None = None

    def scaled(self, content: np.ndarray) -> np.ndarray:
        return np.clip((content - self.mean) / self.scale, -8, 8)

    def views(self, content: np.ndarray, metadata: np.ndarray) -> np.ndarray:
        """Calibrated log odds of both views."""
        raw = (self.scaled(content) @ self.content, metadata @ self.metadata)
        return np.stack([a * r + b for r, (a, b) in zip(raw, self.calibration, strict=True)], axis=1)

    def scores(self, content: np.ndarray, metadata: np.ndarray) -> np.ndarray:
        """Chance of good quality by content, by metadata and by both."""
        odds = self.views(content, metadata)
        both = np.column_stack([odds, np.ones(len(odds))]) @ self.joint
        return _sigmoid(np.column_stack([odds, both]))


def _level(odds: np.ndarray, low: float) -> np.ndarray:
    """The step that odds beyond ``low`` belong to, below 0 for those that are not sure."""
    far = np.minimum(np.abs(odds), _SUREST) - low
    return np.where(far > 0, np.minimum((far * (_BINS / (_SUREST - low))).astype(np.int64), _BINS - 1), -1)


def _cut(counts: np.ndarray, wanted: int) -> tuple[int, float]:
    """The step down to which the surest ``wanted`` reach, and the share of that step that is among them."""
    above = np.cumsum(counts[::-1])[::-1]
    if above[0] <= wanted:
        return 0, 1.0
    edge = int(np.flatnonzero(above >= wanted)[-1])
    return edge, 1 - (above[edge] - wanted) / counts[edge]


def _taught(x: tuple, luck: np.ndarray, rounds: list, low: float) -> list[np.ndarray]:
    """What each view has been told of unlabelled documents in the rounds so far; NaN for nothing."""
    told = [np.full(len(luck), np.nan) for _ in x]
    for betas, cuts in rounds:
        for v in (0, 1):
            odds = _odds(x[v], betas[v])
            level = _level(odds, low)
            free = np.isnan(told[1 - v]) & (level >= 0)
            for side, (edge, share) in zip((1.0, 0.0), cuts[v], strict=True):
                own = free & ((odds > 0) == (side == 1.0))
                told[1 - v][own & ((level > edge) | ((level == edge) & (luck < share)))] = side
    return told


def cotrain(content: np.ndarray, metadata: np.ndarray, labels: np.ndarray, luck: np.ndarray | None = None, **settings) -> Model:
    """Fit the model to documents in memory. ``labels`` are 1, 0, or NaN for unlabelled documents."""
    known = ~np.isnan(labels)
    luck = np.random.default_rng(6).random(len(labels)) if luck is None else luck
    pool = (content[~known], metadata[~known], luck[~known])
    return _cotrain(content[known], metadata[known], labels[known], lambda sums: sums(*pool), **settings)


def _cotrain(
    content: np.ndarray, metadata: np.ndarray, labels: np.ndarray, summed: Callable,
    rounds: int = 5, share: float = 0.05, sure: float = 0.9, ridge: float = 1e-3, steps: int = 30,
) -> Model:
    """Fit the model to labelled documents and a pool of others.

    ``summed`` adds up what a function makes of parts of the pool, given as
    content, metadata and an even number in [0, 1) for each document. In each
    round a view labels up to ``share`` of the unlabelled documents, those it
    gives more than ``sure`` to one class, good and bad ones in the
    proportion of the labels. Of documents at the cut as many are taken, by
    their numbers, as the share still needs. Fewer than five labels of either
    class give a model that lets everything pass.
    """
    if min((labels == 1).sum(), (labels == 0).sum()) < 5:
        return Model()
    # Every fourth label is kept for calibration, of each class alike.
    aside = np.zeros(len(labels), dtype=bool)
    for side in (0, 1):
        aside[np.flatnonzero(labels == side)[::4]] = True

    def moments(content, metadata, luck):
        return np.concatenate([[len(content)], content.sum(0), (content**2).sum(0)])

    k = content.shape[1]
    both = moments(content, metadata, None) + summed(moments)
    mean = both[1 : k + 1] / both[0]
    scale = np.sqrt(np.maximum(both[k + 1 :] / both[0] - mean**2, 0)) + 1e-6
    mean[-1], scale[-1] = 0.0, 1.0
    low = float(np.log(sure / (1 - sure)))

    def views(content, metadata):
        return (np.clip((content - mean) / scale, -8, 8), metadata)

    x = views(content, metadata)
    good = float((labels == 1).mean())
    own = np.where(aside, np.nan, labels)
    betas = [np.zeros(part.shape[1]) for part in x]
    past: list = []
    for turn in range(rounds + 1):
        fits = [_Fit(beta, ridge) for beta in betas]
        for _ in range(steps):
            open_ = {v: f.at for v, f in enumerate(fits) if not f.done}
            if not open_:
                break

            def newton(content, metadata, luck, open_=open_, past=tuple(past)):
                x = views(content, metadata)
                told = _taught(x, luck, past, low)
                return np.concatenate([_newton_sums(x[v], told[v], beta) for v, beta in open_.items()])

            sums = np.concatenate([_newton_sums(x[v], own, beta) for v, beta in open_.items()])
            if past:
                sums = sums + summed(newton)
            ends = np.cumsum([fits[v].size() for v in open_])
            for v, part in zip(open_, np.split(sums, ends[:-1]), strict=True):
                fits[v].take(part)
        betas = [f.at for f in fits]
        if turn == rounds:
            break

        def levels(content, metadata, luck, betas=tuple(betas), past=tuple(past)):
            x = views(content, metadata)
            told, out = _taught(x, luck, past, low), []
            for v in (0, 1):
                odds = _odds(x[v], betas[v])
                free, level = np.isnan(told[1 - v]), _level(odds, low)
                out.append([free.sum()])
                out += [np.bincount(level[free & (level >= 0) & above], minlength=_BINS) for above in (odds > 0, odds <= 0)]
            return np.concatenate(out).astype(np.float64)

        cuts = []
        for counts in summed(levels).reshape(2, 1 + 2 * _BINS):
            room = int(share * counts[0])
            cuts.append([_cut(counts[1 + i * _BINS :][:_BINS], max(1, int(room * part))) for i, part in enumerate((good, 1 - good))])
        past.append((tuple(betas), tuple(cuts)))
    y = labels[aside]
    calibration = []
    for v in (0, 1):
        raw = x[v][aside] @ betas[v]
        calibration.append(tuple(_plain(np.column_stack([raw, np.ones(len(raw))]), y)))
    odds = np.column_stack([a * (x[v][aside] @ betas[v]) + b for v, (a, b) in enumerate(calibration)])
    joint = _plain(np.column_stack([odds, np.ones(len(odds))]), y)
    return Model(betas[0], betas[1], mean, scale, tuple(calibration), joint)


def _plain(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression that keeps the classes' true proportion, for chances."""
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = _sigmoid(x @ beta)
        slope = x.T @ (p - y) + 0.1 * beta
        bend = (x * np.maximum(p * (1 - p), 1e-4)[:, None]).T @ x + 0.1 * np.eye(x.shape[1])
        beta -= np.linalg.solve(bend, slope)
    return beta


def _content(texts) -> np.ndarray:
    return np.array([content_features(t or "") for t in texts]).reshape(-1, CONTENT)


def _metadata(chars, lines, sources, langs) -> np.ndarray:
    rows = [metadata_features(int(c), int(n), s, g) for c, n, s, g in zip(chars, lines, sources, langs, strict=True)]
    return np.array(rows).reshape(-1, METADATA)


def _size(texts) -> tuple[list[int], list[int]]:
    return [len(t or "") for t in texts], [(t or "").count("\n") + 1 for t in texts]


def _compact(content: np.ndarray, metadata: np.ndarray) -> np.ndarray:
    """Both views of documents, of the two marked columns of the metadata only their places."""
    dense = METADATA - 2 * _HASHED
    marks = metadata[:, dense:].reshape(-1, 2, _HASHED).argmax(2)
    return np.column_stack([content, metadata[:, :dense], marks])


def _views(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    dense = METADATA - 2 * _HASHED
    metadata = np.zeros((len(rows), METADATA))
    metadata[:, :dense] = rows[:, CONTENT : CONTENT + dense]
    for i in (0, 1):
        metadata[np.arange(len(rows)), dense + i * _HASHED + rows[:, CONTENT + dense + i].astype(np.int64)] = 1.0
    return np.ascontiguousarray(rows[:, :CONTENT]), metadata


def _unpacked(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return _views(np.frombuffer(b"".join(packed), dtype=np.float64).reshape(-1, CONTENT + METADATA - 2 * _HASHED + 2))


def features(docs: DataFrame) -> DataFrame:
    """Both views of each row of ``docs`` in a few bytes, and an even number in [0, 1) that follows from it."""

    def made(frames):
        for frame in frames:
            for at in range(0, len(frame), 512):
                some = frame.iloc[at : at + 512]
                rows = _compact(_content(some["text"]), _metadata(*_size(some["text"]), some["source"], some["lang"]))
                packed = [r.tobytes() for r in rows]
                yield pd.DataFrame({"doc_id": some["doc_id"].to_numpy(), "packed": packed})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "source", "lang")
    packed = rows.mapInPandas(lean(made), "doc_id long, packed binary")
    luck = F.shiftrightunsigned(F.xxhash64(F.lit(6), "doc_id", "packed"), 11) / F.lit(2.0**53)
    return packed.withColumn("luck", luck)


def _summed(pool: DataFrame):
    """Adds up what a function makes of parts of the pool; nothing else reaches the driver."""

    def add(sums):
        def part(batches):
            total = 0.0
            for batch in batches:
                for at in range(0, batch.num_rows, 4096):
                    some = batch.slice(at, 4096)
                    total = total + sums(*_unpacked(some["packed"].to_pylist()), some["luck"].to_numpy())
            if np.ndim(total):
                yield pa.RecordBatch.from_pydict({"sums": pa.array([total.tobytes()], pa.binary())})

        rows = pool.coalesce(_SUMS).mapInArrow(lean(part), "sums binary").collect()
        return sum((np.frombuffer(r["sums"], dtype=np.float64) for r in rows), sums(*_unpacked([]), np.zeros(0)))

    return add


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, **settings) -> Model:
    """Fit the model to at most ``max_labelled`` labelled documents and to all others.

    The labelled sample is that of the lowest hashes of doc_id, so a rerun
    takes the same. Labels other than 0 and 1, and labels of a document that
    contradict one another, count for nothing. Of rows with one labelled
    doc_id one counts; unlabelled rows all count, those without an id too.
    """
    clean = (
        labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
        .filter("low = high")
        .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("low").cast("double").alias("quality"))
    )
    found = settled(features(docs))
    labelled = found.join(clean, "doc_id").groupBy("doc_id").agg(F.min("packed").alias("packed"), F.first("quality").alias("quality"))
    rows = labelled.orderBy(F.xxhash64(F.lit(6), "doc_id"), "doc_id").limit(max_labelled).toArrow().sort_by("doc_id")
    quality = rows["quality"].to_numpy()
    # Rows without an id all have one key, so they don't go through the join.
    named = found.filter("doc_id is not null").join(clean, "doc_id", "left_anti")
    pool = settled(named.unionByName(found.filter("doc_id is null")).select("packed", "luck"))
    return _cotrain(*_unpacked(rows["packed"].to_pylist()), quality, _summed(pool), **settings)


_SCORES = "content_score double, metadata_score double, score double"


def score(docs: DataFrame, model: Model):
    """A column of the three scores of each document; null where the model knows nothing."""

    @F.pandas_udf(_SCORES)
    def scored(texts: pd.Series, sources: pd.Series, langs: pd.Series) -> pd.DataFrame:
        names = ["content_score", "metadata_score", "score"]
        if model.joint is None or not len(texts):
            return pd.DataFrame({n: pd.Series([None] * len(texts), dtype="float64") for n in names})
        parts = []
        for i in range(0, len(texts), 512):
            some = texts[i : i + 512]
            metadata = _metadata(*_size(some), sources[i : i + 512], langs[i : i + 512])
            parts.append(model.scores(_content(some), metadata))
        return pd.DataFrame(np.concatenate(parts), columns=names)

    return scored("text", "source", "lang")


def classify(docs: DataFrame, labels: DataFrame, least: float = 0.5, **settings) -> DataFrame:
    """One row per document with its scores and whether it is kept.

    Null text counts as empty, a null source or language as one of its own.
    Repeated rows are scored one by one, an empty table gives no rows; with
    too few labels scores are null and everything is kept. Only doc_id, text,
    source and lang are read, and doc_id and quality of the labels.
    """
    model = train(docs, labels, **settings)
    rows = docs.select("doc_id", score(docs, model).alias("s")).select("doc_id", "s.*")
    return rows.withColumn("kept", F.coalesce(F.col("score") >= least, F.lit(True)))


def keep_good(docs: DataFrame, labels: DataFrame, least: float = 0.5, **settings) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with all their columns, whatever their names.

    Null text counts as empty, repeated rows fare alike, an empty table gives
    no rows; with too few labels everything is kept.
    """
    model = train(docs, labels, **settings)
    read = packed(docs).select("_docs", *[F.col("_docs").getField(c).alias(c) for c in ("text", "source", "lang")])
    scored = read.select("_docs", score(read, model).alias("_quality"))
    return unpacked(scored.filter(F.coalesce(F.col("_quality.score") >= least, F.lit(True))), docs.columns)
