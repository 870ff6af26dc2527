"""Line dedup: repeated runs of lines by prefix doubling over line ids.

All documents, one after the other in the order of their ids, make one
sequence of lines; a run never leaves its document. Round k gives every
suffix the rank of its first 2^k lines. Only equality of ranks is ever read,
so a class of equal prefixes, which in the sorted suffix array is an interval
whose longest common prefix is at least 2^k, is named by its first position
instead of its place in the order; that saves a global sort per round. Two
ranks of round k make one of round k + 1. A suffix alone in its class has no
equal of that length or any greater one and leaves, so rounds shrink quickly.

A run of m lines is named by two overlapping ranks of the largest round with
2^k <= m. A run that holds ``least`` words and whose class begins earlier is
a later copy. It is enough to look at runs that hold ``least`` words and would
not without their first, or their last, line: every longer repeated run is
made up of these, so their union is what the maximal repeated runs cover.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import lean, packed, settled, unpacked

LEAST_WORDS = 50


def tight_runs(words: list[int], least: int) -> list[list[int]]:
    """For each line the lengths of the runs from there that have ``least`` words, but lack them
    without their first or without their last line."""
    sums = np.concatenate([[0], np.cumsum(words)])
    n = len(words)
    out: list[list[int]] = [[] for _ in range(n)]
    # Shortest run from each start, and longest start for each end.
    ends = np.searchsorted(sums, sums[:-1] + least, side="left")
    starts = np.searchsorted(sums, sums[1:] - least, side="right") - 1
    for start, end in enumerate(ends.tolist()):
        if end <= n:
            out[start].append(end - start)
    for last, start in enumerate(starts.tolist()):
        if start >= 0 and last + 1 - start not in out[start]:
            out[start].append(last + 1 - start)
    return out


def _lines(least: int):
    def cut(frames):
        for frame in frames:
            rows = []
            for doc_id, key, text in zip(frame["doc_id"], frame["key"], frame["text"], strict=True):
                lines = [x for x in map(str.strip, (text or "").split("\n")) if x]
                runs = tight_runs([len(x.split()) for x in lines], least)
                for seq, (line, own) in enumerate(zip(lines, runs, strict=True)):
                    digest = xxhash.xxh3_128_digest(line.encode())
                    low, high = np.frombuffer(digest, dtype=np.int64).tolist()
                    rows.append((doc_id, key, seq, low, high, own))
                if len(rows) > 20_000:
                    yield pd.DataFrame(rows, columns=_COLUMNS)
                    rows = []
            yield pd.DataFrame(rows, columns=_COLUMNS)

    return cut


_COLUMNS = ["doc_id", "key", "seq", "r1", "r2", "runs"]
_PLACE = ("doc_id", "key", "seq")


def _key(within: str = "") -> Column:
    """Tells documents with one id apart; equal ids with equal texts are one document."""
    return F.xxhash64(f"{within}doc_id", f"{within}text")


def _shared(rows: DataFrame, names: list[str]) -> DataFrame:
    """Rows whose names occur at two places or more, with the first place of their class."""
    place = F.struct(*_PLACE)
    classes = (
        rows.groupBy(*names)
        .agg(F.min(place).alias("first"), F.max(place).alias("_last"))
        .filter("first != _last")
        .drop("_last")
    )
    return rows.join(classes, names)


def _ranked(rows: DataFrame) -> DataFrame:
    """Name each class by its first place, in 128 bits."""
    ranked = _shared(rows, ["r1", "r2"])
    place = ("first.doc_id", "first.key", "first.seq")
    return ranked.select(
        *_PLACE, F.xxhash64(*place).alias("r1"), F.xxhash64(F.lit(4), *reversed(place)).alias("r2"), "runs"
    )


def repeated_runs(docs: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """Later copies of repeated runs: doc_id, key, first line and number of lines. Lines without words don't count."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _key().alias("key"), "text")
    lines = texts.mapInPandas(lean(_lines(least)), "doc_id long, key long, seq int, r1 long, r2 long, runs array<int>")
    # Rows with equal id and text have equal places and would meet one another in every join below.
    ranks = settled(_ranked(lines).distinct())
    longest = ranks.agg(F.max(F.array_max("runs"))).first()[0] or 0
    runs, size = None, 1
    while size <= longest:
        # A run of m lines from here: the rank here, and the one that ends with the run's last line.
        own = ranks.withColumn("m", F.explode(F.filter("runs", lambda m: (m >= size) & (m < 2 * size))))
        there = ranks.select(
            F.col("doc_id").alias("_doc_id"), F.col("key").alias("_key"), F.col("seq").alias("_seq"),
            F.col("r1").alias("r3"), F.col("r2").alias("r4"),
        )
        ending = (
            F.col("doc_id").eqNullSafe(F.col("_doc_id"))
            & (F.col("key") == F.col("_key"))
            & (F.col("seq") + F.col("m") - size == F.col("_seq"))
        )
        named = own.join(there, ending).select(*_PLACE, "m", "r1", "r2", "r3", "r4")
        later = _shared(named, ["m", "r1", "r2", "r3", "r4"]).filter(F.col("first") != F.struct(*_PLACE))
        later = settled(later.select("doc_id", "key", "seq", "m"))
        runs = later if runs is None else runs.unionByName(later)
        if 2 * size > longest:
            break
        ahead = Window.partitionBy("doc_id", "key").orderBy("seq").rangeBetween(size, size)
        doubled = ranks.select(
            *_PLACE, "runs", F.col("r1").alias("a"), F.col("r2").alias("b"),
            F.first("r1").over(ahead).alias("c"), F.first("r2").over(ahead).alias("d"),
        ).filter(F.col("c").isNotNull())
        pairs = doubled.select(
            *_PLACE, F.xxhash64("a", "b", "c", "d").alias("r1"), F.xxhash64(F.lit(4), "d", "c", "b", "a").alias("r2"), "runs"
        )
        ranks = settled(_ranked(pairs))
        size *= 2
    if runs is None:
        return ranks.select("doc_id", "key", "seq", F.lit(0).alias("m")).limit(0)
    return runs


_CUT = "text string, n_lines long, n_cut long"


def _without(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
    rows = []
    for text, own in zip(texts, spans, strict=True):
        if text is None:
            rows.append((None, 0, 0))
            continue
        lines = text.split("\n")
        full = [i for i, x in enumerate(lines) if x.strip()]
        gone = set()
        for span in own if own is not None else ():
            gone.update(full[span["seq"] : span["seq"] + span["m"]])
        if gone:
            text = "\n".join(x for i, x in enumerate(lines) if i not in gone)
        rows.append((text, len(full), len(gone)))
    return pd.DataFrame(rows, columns=["text", "n_lines", "n_cut"])


def cut_repeats(docs: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """``docs`` as one column ``_docs``, and ``_cut``: the text without later copies, its lines with words, how many went.

    The first copy, by doc_id (null first) and place, stays. A null text
    stays null. Rows with equal id and equal text are one document and fare
    alike. An empty table gives no rows.
    """
    gone = repeated_runs(docs, least).groupBy(F.col("doc_id").alias("_doc_id"), F.col("key").alias("_key"))
    spans = settled(gone.agg(F.collect_set(F.struct("seq", "m")).alias("_spans")))
    keyed = packed(docs).withColumn("_line_key", _key("_docs."))
    same = F.col("_docs.doc_id").cast("long").eqNullSafe(F.col("_doc_id")) & (F.col("_line_key") == F.col("_key"))
    # The spans grow with the corpus: merged at every size, never broadcast.
    rows = keyed.join(spans.hint("merge"), same, "left")
    # Said to be non-deterministic, or else a filter on what it returns would make it run a second time.
    without = F.pandas_udf(_without, _CUT).asNondeterministic()
    return rows.select("_docs", without("_docs.text", "_spans").alias("_cut"))


def dedup_lines(docs: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """``docs`` in its own columns, whatever their names, with later copies of lines cut out; ``n_chars`` follows the text.

    Documents of which no line is left are copies through and through, and
    go. Null and empty texts stay as they are, rows with equal id and text
    fare alike, an empty table gives no rows.
    """
    rows = cut_repeats(docs, least)
    rows = rows.filter((F.col("_cut.n_lines") > F.col("_cut.n_cut")) | (F.col("_cut.n_cut") == 0))
    new = {"text": F.col("_cut.text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.coalesce(F.length("_cut.text").cast("long"), F.col("_docs.n_chars"))
    return unpacked(rows, docs.columns, **new)


def line_report(docs: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """One row per document: its lines with words, how many were cut, and the text without them."""
    rows = cut_repeats(docs.select("doc_id", "text"), least)
    return rows.select("_docs.doc_id", "_cut.n_lines", "_cut.n_cut", F.col("_cut.text").alias("text"))
