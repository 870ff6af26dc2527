"""Ranked search against a plain scoring of every document."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from wardbook.llm import search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, top=10):
    """Rows of (item_id, rank, doc_id, score) by scoring every document for every item."""
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    found = []
    for item, text in items:
        scores = []
        for i, c in counts:
            m = 100 - 75 + 75 * sum(c.values()) * n // total
            score = 0
            for t in terms(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, i is None, i))
        scores.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        found += [(item, k, i, -s) for k, (s, _, i) in enumerate(scores[:top], 1)]
    return found


def in_order(rows):
    return sorted(rows, key=lambda r: [(x is not None, x or 0) for x in r])


def test_ranks_equal_those_of_scoring_everything(given):
    docs, items = given("documents"), given("benchmark")
    expected = plain([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.collect()])
    assert in_order(map(tuple, search.rank_documents(docs, items).collect())) == in_order(expected)
    assert len(expected) > 100


def test_small_chunks_blocks_and_depths_change_nothing(given, monkeypatch):
    monkeypatch.setattr(search, "CHUNK_DOCS", 7)
    monkeypatch.setattr(search, "CHUNK_ENTRIES", 300)
    monkeypatch.setattr(search, "BLOCK_TERMS", 200)
    monkeypatch.setattr(search, "FIRST_DEPTH", 1)
    docs, items = given("documents"), given("benchmark")
    expected = plain([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.collect()])
    assert in_order(map(tuple, search.rank_documents(docs.repartition(5), items).collect())) == in_order(expected)


def test_search_edges(edges, nothing, spark, given):
    items = [
        (1, "One two THREE three"), (1, "One two THREE three"), (1, "four five"), (2, None), (3, ""), (4, " . , "),
        (None, "mail éé ÀÉ license MIT 9½ ٣"), (5, "unknownword"), (6, "w1 " * 500 + "w77 w2"), (7, "x" * 100_000),
    ]
    asked = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' as rank", "'y' as score", "'z' as doc_id")
    docs = [tuple(r) for r in edges.select("doc_id", "text").collect()]
    expected = plain(docs, dict.fromkeys(items))
    assert in_order(map(tuple, search.rank_documents(edges, asked).collect())) == in_order(expected)
    assert search.rank_documents(nothing, asked).count() == 0
    assert search.rank_documents(edges, asked.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]


def test_equal_scores_go_by_doc_id(spark):
    docs = spark.createDataFrame([(i, "alpha beta") for i in range(40, 0, -1)] + [(i, "gamma") for i in range(100, 140)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "alpha")], "item_id long, text string")
    assert [r["doc_id"] for r in search.rank_documents(docs, items).orderBy("rank").collect()] == list(range(1, 11))


@pytest.mark.parametrize("seed", range(5))
def test_best_positions_stop_only_when_nothing_better_is_left(seed):
    rng = np.random.default_rng(seed)
    n, width = 400, 12
    have = rng.random((n, width)) < 0.3
    doc, term = np.nonzero(have)
    impact = rng.integers(1, 6, len(doc)) * rng.integers(1, 100, len(doc))
    lists = search.Lists(doc, term, impact, width)
    table = defaultdict(int, {(d, t): i for d, t, i in zip(doc.tolist(), term.tolist(), impact.tolist(), strict=True)})
    stopped = 0
    for _ in range(50):
        of = rng.choice(width, rng.integers(1, 6), replace=False)
        times = rng.integers(1, 4, len(of))
        scores = {d: sum(c * table[d, t] for t, c in zip(of.tolist(), times.tolist(), strict=True)) for d in range(n)}
        known = np.sort(rng.integers(0, 400, rng.integers(0, 11)))[-10:]
        docs, found = lists.best(of, times, known)
        assert len(set(docs.tolist())) == len(docs)
        assert all(scores[d] == s for d, s in zip(docs.tolist(), found.tolist(), strict=True))
        every = sorted([*known.tolist(), *[s for s in scores.values() if s]], reverse=True)[:10]
        met = sorted([*known.tolist(), *found.tolist()], reverse=True)[:10]
        assert met == every
        # All documents at the tenth score are met, so ties can be settled by id.
        if len(every) == 10:
            last = every[-1]
            assert {d for d, s in scores.items() if s >= last} == {d for d, s in zip(docs.tolist(), found.tolist(), strict=True) if s >= last}
        stopped += len(docs) < sum(s > 0 for s in scores.values())
    assert stopped > 10
