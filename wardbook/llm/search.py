"""Ranked lexical search by the Best Position Algorithm.

Documents are taken in chunks of bounded size. A chunk has one impact list
per query term, its documents by falling impact. For each item the lists are
read downwards together; every document met is looked up in all the item's
lists at once, which gives its whole score and its position in each list. A
list's best position is the end of the unbroken run of positions seen from
its top, by reading or by lookup. No document unseen so far can score more
than the sum of the impacts at the best positions, so reading stops once that
is strictly below the tenth score, ties being settled by doc_id.

A task carries the best ten of each item from chunk to chunk, so later chunks
stop earlier, and hands on ten rows an item; these are cut to ten in two
steps. The items are the stated queries: they are read in blocks of bounded
size, and each block is put to all documents.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import settled

TOP = 10
# Terms of the items of one block, repeats within an item counted once.
BLOCK_TERMS = 100_000
# Documents and list entries of a chunk.
CHUNK_DOCS = 4_096
CHUNK_ENTRIES = 1_000_000
# Positions of each list that are read first; then twice as many each time.
FIRST_DEPTH = 4
# Parts into which an item's rows are dealt for the first cut.
PARTS = 64

# Terms consist of digits, letters and all bytes of code points beyond ASCII; only A-Z change.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)


def terms(text: str | None) -> list[bytes]:
    """Terms of a whole text in order, in UTF-8; none for null."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


@dataclass(frozen=True)
class Queries:
    """Items of a block: the number of each term, and per item its terms' numbers and how often each counts."""

    vocabulary: dict[bytes, int]
    items: list[tuple[np.ndarray, np.ndarray]]


def _item_terms(batches):
    for batch in batches:
        for item_id, text in zip(batch["item_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
            found = sorted(Counter(terms(text)).items())
            if found:
                yield pa.RecordBatch.from_pydict(
                    {"item_id": pa.array([item_id], pa.int64()), "terms": pa.array([[t for t, _ in found]], pa.list_(pa.binary())), "counts": pa.array([[n for _, n in found]], pa.list_(pa.int64()))}
                )


_STATS = pa.schema([("term", pa.int32()), ("n", pa.int64())])
_DOCS, _ALL_TERMS = -1, -2


def _statistics(queries):
    """Documents with a term, all their terms, and the documents that hold each query term."""

    def count(batches):
        vocabulary = queries.value.vocabulary
        known = vocabulary.keys()
        docs, total, holding = 0, 0, Counter()
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                for text in batch.slice(low, 256)["text"].to_pylist():
                    found = terms(text)
                    if found:
                        docs += 1
                        total += len(found)
                        holding.update(known & set(found))
        numbers = [_DOCS, _ALL_TERMS, *[vocabulary[t] for t in holding]]
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array([docs, total, *holding.values()], pa.int64())], schema=_STATS)

    return count


def weight(documents: int, holding: int) -> int:
    """A term's weight by the number of documents and of those that hold it."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


class Lists:
    """Impact lists of a chunk of documents, and the way from a document and term to its entry."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, width: int):
        # Entries lie in order of document and term; that is the order of direct accesses.
        self._keys, self._impact, self._width = doc * width + term, impact, width
        order = np.lexsort((doc, -impact, term))
        self._starts = np.searchsorted(term[order], np.arange(width + 1))
        self._doc, self._sorted = doc[order], impact[order]
        self._place = np.empty(len(order), dtype=np.int64)
        self._place[order] = np.arange(len(order)) - self._starts[term[order]]

    def _direct(self, docs: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Impact and position of documents in lists; 0 and -1 where a list does not have the document."""
        keys = (docs[:, None] * self._width + of[None, :]).ravel()
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        there = self._keys[at] == keys
        shape = len(docs), len(of)
        return np.where(there, self._impact[at], 0).reshape(shape), np.where(there, self._place[at], -1).reshape(shape)

    def best(self, of: np.ndarray, times: np.ndarray, known: np.ndarray, top: int = TOP) -> tuple[np.ndarray, np.ndarray]:
        """Documents that can be among the best for a query, with their whole scores.

        ``known`` holds the best scores found elsewhere. Stops once no unseen
        document can reach the last of the ``top`` best scores.
        """
        sizes = self._starts[of + 1] - self._starts[of]
        of, times, sizes = of[sizes > 0], times[sizes > 0], sizes[sizes > 0]
        none = np.zeros(0, dtype=np.int64)
        if not len(of):
            return none, none
        begins = self._starts[of]
        # One mark per position and one that is never set behind each list.
        marks = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        seen = np.zeros(int((sizes + 1).sum()), dtype=bool)
        index = np.arange(len(seen))
        positions = np.zeros(len(of), dtype=np.int64)  # best positions, as the number of seen entries from the top
        docs, scores, best = none, none, known
        low, high = 0, FIRST_DEPTH
        while True:
            bound = np.where(positions == 0, self._sorted[begins], np.where(positions < sizes, self._sorted[begins + positions - 1], 0))
            if (len(best) == top and (bound * times).sum() < best.min()) or low >= sizes.max():
                return docs, scores
            lengths = np.clip(sizes - low, 0, high - low)
            read = np.repeat(begins + low - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
            new = np.setdiff1d(self._doc[read], docs)
            for some in np.array_split(new, max(1, len(new) * len(of) // CHUNK_ENTRIES)):
                impact, place = self._direct(some, of)
                seen[(marks[None, :] + place)[place >= 0]] = True
                own = impact @ times
                docs, scores = np.concatenate([docs, some]), np.concatenate([scores, own])
                best = np.sort(np.concatenate([best, own]))[-top:]
            positions = np.minimum.reduceat(np.where(seen, len(seen), index), marks) - marks
            low, high = high, 2 * high


_HITS = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])


def _search(queries, documents: int, all_terms: int, weights, top: int):
    """The best documents of a task's share for each item."""

    def search(batches):
        vocabulary, items = queries.value.vocabulary, queries.value.items
        known, worth = vocabulary.keys(), weights.value
        best_ids = [np.zeros(0, dtype=object) for _ in items]
        best_scores = [np.zeros(0, dtype=np.int64) for _ in items]
        ids, numbers, counts, sizes, slowness = [], [], [], [], []

        def close():
            if sum(sizes):
                doc = np.repeat(np.arange(len(ids)), sizes)
                term, tf = np.array(numbers, dtype=np.int64), np.array(counts, dtype=np.int64)
                impact = worth[term] * (1_000_000_000 * tf // (1000 * tf + 8 * np.array(slowness, dtype=np.int64)[doc]))
                order = np.lexsort((term, doc))
                some = order[impact[order] > 0]
                if len(some):
                    lists = Lists(doc[some], term[some], impact[some], len(vocabulary))
                    own = np.array(ids, dtype=object)
                    for i, (of, times) in enumerate(items):
                        found, scores = lists.best(of, times, best_scores[i], top)
                        if len(found):
                            merge(i, own[found], scores)
            for kept in (ids, numbers, counts, sizes, slowness):
                kept.clear()

        def merge(i, found, scores):
            if len(best_scores[i]) == top:
                near = scores >= best_scores[i].min()
                found, scores = found[near], scores[near]
            all_ids, all_scores = np.concatenate([best_ids[i], found]), np.concatenate([best_scores[i], scores])
            absent = np.array([x is None for x in all_ids])
            first = np.lexsort((np.array([x or 0 for x in all_ids], dtype=np.int64), absent, -all_scores))[:top]
            best_ids[i], best_scores[i] = all_ids[first], all_scores[first]

        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                some = batch.slice(low, 256)
                for doc_id, text in zip(some["doc_id"].to_pylist(), some["text"].to_pylist(), strict=True):
                    found = terms(text)
                    times = Counter(found)
                    held = [t for t in times if t in known] if len(times) < len(known) else list(known & times.keys())
                    if not held:
                        continue
                    ids.append(doc_id)
                    numbers += [vocabulary[t] for t in held]
                    counts += [times[t] for t in held]
                    sizes.append(len(held))
                    slowness.append(25 + 75 * len(found) * documents // all_terms)
                    if len(ids) >= CHUNK_DOCS or len(numbers) >= CHUNK_ENTRIES:
                        close()
        close()
        for i in range(len(items)):
            if len(best_ids[i]):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i] * len(best_ids[i]), pa.int32()), pa.array(best_ids[i].tolist(), pa.int64()), pa.array(best_scores[i], pa.int64())], schema=_HITS
                )

    return search


def _top(hits: DataFrame, group: list[str], top: int) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _ask(docs: DataFrame, rows: list, top: int) -> DataFrame:
    """The best documents for the items of one block, numbered as in ``rows``."""
    spark = docs.sparkSession
    vocabulary: dict[bytes, int] = {}
    items = []
    for r in rows:
        of = np.array([vocabulary.setdefault(bytes(t), len(vocabulary)) for t in r["terms"]], dtype=np.int64)
        items.append((of, np.array(r["counts"], dtype=np.int64)))
    queries = spark.sparkContext.broadcast(Queries(vocabulary, items))
    counted = docs.select("text").mapInArrow(_statistics(queries), "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    n = {r["term"]: r["n"] for r in counted.collect()}  # one row per term of the block
    documents, all_terms = n.get(_DOCS, 0), n.get(_ALL_TERMS, 0)
    weights = spark.sparkContext.broadcast(np.array([weight(documents, n.get(i, 0)) for i in range(len(vocabulary))], dtype=np.int64))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    hits = texts.mapInArrow(_search(queries, documents, all_terms, weights, top), "item int, doc_id long, score long")
    hits = hits.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(PARTS)))
    return _top(_top(hits, ["item", "part"], top).drop("rank", "part"), ["item"], top)


def rank_documents(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id and score of each item's best documents, equal scores by ascending doc_id, null ids last.

    Items with equal id and text are one; an item or document without terms,
    as one with null or empty text, has no rows. Repeated documents count and
    rank one by one. Empty tables give no rows. Only item_id, doc_id and text
    are read.
    """
    spark = docs.sparkSession
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    asked = settled(asked.mapInArrow(_item_terms, "item_id long, terms array<binary>, counts array<long>"))
    blocks = -(-(asked.agg(F.sum(F.size("terms"))).first()[0] or 0) // BLOCK_TERMS)
    found = []
    for block in range(blocks):
        rows = asked.filter(F.pmod(F.xxhash64("item_id", "terms"), F.lit(blocks)) == block).collect()
        if rows:
            names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], "item int, item_id long")
            found.append(_ask(docs, rows, top).join(names, "item").select("item_id", "rank", "doc_id", "score"))
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.union, found)
