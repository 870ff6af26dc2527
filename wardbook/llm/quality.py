"""Quality rules: how far a document's characters and common words stray from its language.

A language's reference is the histogram of all its documents: shares of
character classes, and shares of its common words (each at least
``COMMON`` of all words) with one bin for the rest. A document is compared
to both by Jensen-Shannon distance, if it is long enough for its own
histogram to mean something.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .common import settled

# A common word has at least this share of its language's words; so a language has at most 500.
COMMON = 0.002
# Distinct words that a task counts before it passes the counts on.
HELD = 200_000
# Up to this many candidate words, or languages, go to every task.
FEW_WORDS, FEW_LANGUAGES = 200_000, 1_000

CLASSES = ("vowel", "consonant", "capital", "digit", "space", "stop", "symbol", "accented", "other")
_SYMBOLS = "#*$%&|<>"
_SPACES = "\t\n\x0b\x0c\r "


def _class(c: str) -> int:
    if c in _SPACES:
        return 4
    if c < "\x80":
        if c.isdigit():
            return 3
        if c.isupper():
            return 2
        if c.islower():
            return 0 if c in "aeiou" else 1
        return 5 if c in ".,;:!?'\"()-" else 6
    return 7 if c.islower() else 2 if c.isupper() else 8


# One entry per character up to the end of the extended Latin block; all further ones are "other".
_TABLE = np.array([*[_class(chr(i)) for i in range(0x250)], 8], dtype=np.int64)


def class_counts(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    return np.bincount(_TABLE[np.minimum(points, 0x250)], minlength=len(CLASSES))


def distance(counts: np.ndarray, reference: np.ndarray) -> float:
    """Jensen-Shannon distance, 0 to 1, of two histograms given as counts."""
    p, q = counts / counts.sum(), reference / reference.sum()
    m = (p + q) / 2

    def gain(x: np.ndarray) -> float:
        on = x > 0
        return float((x[on] * np.log2(x[on] / m[on])).sum())

    return float(np.sqrt(max(0.0, (gain(p) + gain(q)) / 2)))


def _repeated(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found at least twice."""
    n = len(words) - 2
    if n < 2:
        return 0
    names: dict[bytes, int] = {}
    ids = np.array([names.setdefault(w, len(names)) for w in words], dtype=np.int64)
    if len(names) == len(words):
        return 0
    pairs = np.unique(ids[:-1] * len(names) + ids[1:], return_inverse=True)[1]
    _, at, seen = np.unique(pairs[:-1] * len(names) + ids[2:], return_inverse=True, return_counts=True)
    twice = np.flatnonzero(seen[at] > 1)
    covered = np.zeros(len(words), dtype=bool)
    for i in range(3):
        covered[twice + i] = True
    return int(covered.sum())


def base_rules(text: str, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    seen, repeats = set(), 0
    for line in text.split("\n"):
        if line in seen:
            repeats += 1
        elif line.encode().split():
            seen.add(line)
    return (
        len(words),
        len(text) - sum(text.count(c) for c in _SPACES),
        sum(text.count(c) for c in _SYMBOLS),
        repeats,
        _repeated(words),
    )


def _chunks(frames):
    """Word counts of the texts by language, passed on whenever many distinct words are held."""
    counts, classes = defaultdict(Counter), defaultdict(lambda: np.zeros(len(CLASSES), dtype=np.int64))
    for frame in frames:
        for lang, text in zip(frame["lang"], frame["text"], strict=True):
            if text:
                counts[lang].update(text.encode().split())
                classes[lang] += class_counts(text)
                if sum(map(len, counts.values())) > HELD:
                    yield counts, classes
                    counts.clear()
                    classes.clear()
    yield counts, classes


def _candidates(frames):
    for counts, _ in _chunks(frames):
        least = {lang: COMMON * own.total() for lang, own in counts.items()}
        rows = [
            (lang, word.decode()) for lang, own in counts.items() for word, n in own.items() if n >= least[lang]
        ]
        yield pd.DataFrame(rows, columns=["lang", "word"])


def references(docs: DataFrame) -> DataFrame:
    """One row per language: class counts, word total and common words with counts, over all its documents.

    A word common in a language is common in at least one chunk of it, so the
    words common in some chunk are all that need counting.
    """
    texts = docs.select("lang", "text")
    words = settled(texts.mapInPandas(_candidates, "lang string, word string").distinct())
    wanted = None
    if words.count() <= FEW_WORDS:
        wanted = docs.sparkSession.sparkContext.broadcast({(r["lang"], r["word"].encode()) for r in words.collect()})

    def counted(frames):
        for counts, classes in _chunks(frames):
            rows = []
            for lang, own in counts.items():
                rows.append((lang, "total", "", own.total()))
                rows += [(lang, "class", str(i), int(n)) for i, n in enumerate(classes[lang])]
                rows += [(lang, "word", w.decode(), n) for w, n in own.items() if wanted is None or (lang, w) in wanted.value]
            yield pd.DataFrame(rows, columns=["lang", "kind", "item", "n"])

    sums = (
        texts.mapInPandas(counted, "lang string, kind string, item string, n long")
        .groupBy("lang", "kind", "item")
        .agg(F.sum("n").alias("n"))
    )
    total = F.max(F.when(F.col("kind") == "total", F.col("n"))).over(Window.partitionBy("lang"))
    common = settled(sums).withColumn("total", total).filter(
        (F.col("kind") == "class") | ((F.col("kind") == "word") & (F.col("n") >= COMMON * F.col("total")))
    )
    listed = F.array_sort(F.collect_list(F.concat_ws(" ", "kind", "item", "n")))
    return common.groupBy("lang").agg(F.max("total").alias("total"), F.array_join(listed, "\n").alias("reference"))


_SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "class_distance double, word_distance double"
)


def _parsed(reference: str, total: int):
    classes, words, counts = np.zeros(len(CLASSES)), {}, []
    for line in reference.split("\n"):
        kind, item, n = line.split(" ")
        if kind == "class":
            classes[int(item)] = int(n)
        else:
            words[item.encode()] = len(words)
            counts.append(int(n))
    return classes, words, np.array([*counts, total - sum(counts)], dtype=float)


def rate(docs: DataFrame, min_words: int = 50, min_reference: int = 1_000, most_class: float = 0.30, most_word: float = 0.55) -> DataFrame:
    """One row per document with the base rules, both distances and the verdict.

    Distances are null for documents under ``min_words`` words and for
    languages under ``min_reference`` words; such documents are judged by the
    base rules alone. A null language is one of its own, a null text has no
    words. Repeated rows are rated one by one, an empty table gives no rows.
    Only doc_id, text and lang are read.
    """
    spark = docs.sparkSession
    known = settled(references(docs).filter(F.col("total") >= min_reference))
    if known.count() <= FEW_LANGUAGES:
        known = F.broadcast(known)
    own = docs.select("doc_id", "text", "lang").join(
        known.withColumnRenamed("lang", "_lang"), F.col("lang").eqNullSafe(F.col("_lang")), "left"
    )

    @F.pandas_udf(_SCHEMA)
    def rated(texts: pd.Series, listed: pd.Series, totals: pd.Series) -> pd.DataFrame:
        parsed, rows = {}, []
        for text, reference, total in zip(texts, listed, totals, strict=True):
            text = text or ""
            words = text.encode().split()
            row = base_rules(text, words)
            far = (None, None)
            if reference is not None and len(words) >= min_words:
                if reference not in parsed:
                    parsed[reference] = _parsed(reference, int(total))
                classes, index, counts = parsed[reference]
                rest = len(index)
                at = np.fromiter((index.get(w, rest) for w in words), np.int64, len(words))
                far = (
                    distance(class_counts(text), classes),
                    distance(np.bincount(at, minlength=rest + 1), counts),
                )
            rows.append((*row, *far))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in _SCHEMA.split(", ")])

    rows = own.select("doc_id", rated("text", "reference", "total").alias("r")).select("doc_id", "r.*")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    strays = (F.col("class_distance") > most_class) | (F.col("word_distance") > most_word)
    return rows.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & ~F.coalesce(strays, F.lit(False))
    )
