"""Language of a text: multinomial naive Bayes over hashed character n-grams.

1. Each task counts the n-grams of its share of the labelled texts, per
   language and bucket. The counts are summed by language and bucket, so a
   language that holds most texts costs no task more than another.
2. A language's logarithms become one vector. The matrix of at most
   ``LANGS_PER_PASS`` vectors is broadcast; more languages take more passes,
   which hand the best one so far on within the same stage.
3. Texts are scored in batches: the n-grams of a batch, counted per text,
   are a sparse matrix whose product with the broadcast one is summed by text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from .common import settled

ORDERS = (1, 2, 3)
BUCKETS = 1 << 15
# Added to every count.
SMOOTHING = 0.5
# Characters whose n-grams are looked at together.
BATCH_CHARS = 500_000
# Vectors of one broadcast matrix: 256 of 128 KB each.
LANGS_PER_PASS = 256
# Languages that a counting task holds at a time.
LANGS_PER_TASK = 64
UNKNOWN = "und"

_DOCS = -1
_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(1_000_003)
_LETTER = regex.compile(r"\p{L}")


def held_out(doc_id: Column) -> Column:
    """Is crc32 of the id as text 1 modulo 3? A null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def _batches(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Code points of lower-cased, padded texts, the number of the text of each, and how many may start an n-gram.

    A text beyond the size of a batch is cut; each piece but the last reads on
    into the next one, so that every n-gram is met once.
    """
    reach = max(ORDERS) - 1
    owners, held, chars = [], [], 0

    def codes(joined: str) -> np.ndarray:
        return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)

    for number, text in enumerate(texts):
        padded = f" {text.lower()} "
        while len(padded) > BATCH_CHARS + reach:
            piece = codes(padded[: BATCH_CHARS + reach])
            yield piece, np.full(len(piece), number), BATCH_CHARS
            padded = padded[BATCH_CHARS:]
        owners.append(number)
        held.append(padded)
        chars += len(padded)
        if chars >= BATCH_CHARS:
            yield codes("".join(held)), np.repeat(owners, [len(x) for x in held]), chars
            owners, held, chars = [], [], 0
    if held:
        yield codes("".join(held)), np.repeat(owners, [len(x) for x in held]), chars


def ngrams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Number of the text and bucket of every n-gram of the texts, batch by batch."""
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    for codes, owner, starts in _batches(texts):
        rolled, found = codes, []
        for n in range(1, max(ORDERS) + 1):
            if n > 1:
                rolled = rolled[:-1] * _STEP + codes[n - 1 :]
            if n in ORDERS:
                inside = owner[: len(rolled)] == owner[n - 1 :]
                inside[starts:] = False
                found.append((owner[: len(rolled)][inside], ((rolled[inside] + np.uint64(n)) * _MIX >> shift).astype(np.int64)))
        yield np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


_COUNTS = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("n", pa.int64())])


def _count(batches):
    """Documents and n-grams of each language in a task."""
    counts: dict[str, np.ndarray] = {}
    docs: dict[str, int] = {}

    def flush():
        for lang, own in counts.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * (len(at) + 1)), pa.array([_DOCS, *at.tolist()], pa.int32()), pa.array([docs[lang], *own[at].tolist()], pa.int64())],
                schema=_COUNTS,
            )
        counts.clear()
        docs.clear()

    for batch in batches:
        for low in range(0, batch.num_rows, 256):
            some = batch.slice(low, 256)
            texts = [x or "" for x in some["text"].to_pylist()]
            langs = some["lang"].to_pylist()
            names = sorted(set(langs))
            if len(counts) + len(names) > LANGS_PER_TASK:
                yield from flush()
            row = np.array([names.index(x) for x in langs])
            for lang in names:
                counts.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                docs[lang] = docs.get(lang, 0) + langs.count(lang)
            for owner, bucket in ngrams(texts):
                for number, lang in enumerate(names):
                    counts[lang] += np.bincount(bucket[row[owner] == number], minlength=BUCKETS)
    yield from flush()


def _vector(rows: pd.DataFrame) -> pd.DataFrame:
    """Logarithms of one language's shares, from its at most ``BUCKETS`` counts."""
    grams = rows[rows["bucket"] != _DOCS]
    counts = np.full(BUCKETS, SMOOTHING)
    counts[grams["bucket"].to_numpy()] += grams["n"].to_numpy()
    logs = np.log(counts / counts.sum()).astype(np.float32)
    return pd.DataFrame({"lang": [rows["lang"].iloc[0]], "docs": [int(rows.loc[rows["bucket"] == _DOCS, "n"].sum())], "logs": [logs.tobytes()]})


def learn(labelled: DataFrame) -> DataFrame:
    """One row per language of (text, lang) rows: its documents and its vector of logarithms. Rows without a language are left out."""
    named = labelled.filter(F.col("lang").isNotNull()).select("text", "lang")
    summed = named.mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    return settled(summed.groupBy("lang").applyInPandas(_vector, "lang string, docs long, logs binary"))


_SCORED = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("held_out", pa.bool_()), ("lang", pa.string()), ("best", pa.float64()), ("total", pa.float64())])


def log_chances(texts: list[str], priors: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Logarithm of each text's joint chance with each language: its sparse row of counts times the matrix."""
    out = np.repeat(priors[None, :], len(texts), axis=0)
    for owner, bucket in ngrams(texts):
        keys = np.sort(owner * BUCKETS + bucket)
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        if not len(first):
            continue
        times = np.diff(first, append=len(keys))
        cells = keys[first]
        text = cells // BUCKETS
        begins = np.flatnonzero(np.diff(text, prepend=-1))
        out[text[begins]] += np.add.reduceat(matrix[cells % BUCKETS].astype(np.float64) * times[:, None], begins, axis=0)
    return out


def _score(model):
    """Compare each text with the languages of one pass and keep the best one met so far."""

    def score(batches):
        langs, priors, packed = model.value
        matrix = np.stack([np.frombuffer(x, dtype=np.float32) for x in packed], axis=1)
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                some = batch.slice(low, 256)
                texts = some["text"].to_pylist()
                chances = log_chances([x or "" for x in texts], priors, matrix)
                at = chances.argmax(1)
                best = chances[np.arange(len(texts)), at]
                total = best + np.log(np.exp(chances - best[:, None]).sum(1))
                rows = zip(some["lang"].to_pylist(), some["best"].to_pylist(), some["total"].to_pylist(), strict=True)
                names, tops, totals = [], [], []
                for (name, top, sum_), i, b, t in zip(rows, at, best, total, strict=True):
                    own = langs[i]
                    if name is not None:
                        t = np.logaddexp(sum_, t)
                        if (top, own) > (b, name):
                            own, b = name, top
                    names.append(own)
                    tops.append(b)
                    totals.append(t)
                columns = [some["doc_id"], some["text"], some["held_out"], pa.array(names, pa.string()), pa.array(tops, pa.float64()), pa.array(totals, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, schema=_SCORED)

    return score


def _has_letter(texts: pd.Series) -> pd.Series:
    return texts.map(lambda x: x is not None and _LETTER.search(x) is not None).astype(bool)


def predict(docs: DataFrame, models: DataFrame) -> DataFrame:
    """doc_id, held_out, the language of each whole text and its chance among those learned.

    A text that is null or without letters is ``und`` with score 0, and so is
    every text where nothing was learned; equal chances go to the first
    language by name. Repeated rows are predicted one by one, an empty table
    gives no rows. Only doc_id and text are read.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.when(F.pandas_udf(_has_letter, "boolean")("text"), F.col("text")).alias("text"),
        held_out(F.col("doc_id")).alias("held_out"),
        F.lit(None).cast("string").alias("lang"),
        F.lit(None).cast("double").alias("best"),
        F.lit(None).cast("double").alias("total"),
    )
    known, documents = models.agg(F.count("*"), F.sum("docs")).first()
    passes = -(-known // LANGS_PER_PASS)
    for number in range(passes):
        own = models.filter(F.pmod(F.xxhash64("lang"), F.lit(passes)) == number).collect()
        own.sort(key=lambda r: r["lang"])
        if own:
            priors = np.log([r["docs"] / documents for r in own])
            model = spark.sparkContext.broadcast(([r["lang"] for r in own], priors, [bytes(r["logs"]) for r in own]))
            rows = rows.mapInArrow(_score(model), "doc_id long, text string, held_out boolean, lang string, best double, total double")
    sure = F.col("text").isNotNull() & F.col("lang").isNotNull()
    return rows.select(
        "doc_id",
        "held_out",
        F.when(sure, F.col("lang")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(sure, F.least(F.exp(F.col("best") - F.col("total")), F.lit(1.0))).otherwise(0.0).alias("score"),
    )


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the labelled documents that are not held out, and predict all; see ``predict``."""
    return predict(docs, learn(docs.filter(~held_out(F.col("doc_id")))))
