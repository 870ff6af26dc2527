"""Language predictions against a plain naive Bayes, and on held-out documents."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
import regex

from wardbook.llm import langid

MIDDLE = "/root/testdata/sf0.01"


def grams(text):
    """Buckets of all n-grams of a padded, lower-cased text, one by one."""
    padded = f" {text.lower()} "
    found = Counter()
    for n in langid.ORDERS:
        for i in range(len(padded) - n + 1):
            code = 0
            for c in padded[i : i + n]:
                code = (code * 1_000_003 + ord(c)) % 2**64
            found[((code + n) * 0x9E3779B97F4A7C15 % 2**64) >> 49] += 1
    return found


def out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1


def plain(rows):
    """(doc_id, held_out, lang_pred, score) of (doc_id, text, lang) rows."""
    counts, docs = {}, Counter()
    for doc_id, text, lang in rows:
        if lang is not None and not out(doc_id):
            counts.setdefault(lang, Counter()).update(grams(text or ""))
            docs[lang] += 1
    logs = {}
    for lang, own in counts.items():
        total = sum(own.values()) + langid.SMOOTHING * langid.BUCKETS
        logs[lang] = {b: math.log((own[b] + langid.SMOOTHING) / total) for b in range(langid.BUCKETS)}
    found = []
    for doc_id, text, _ in rows:
        if text is None or not regex.search(r"\p{L}", text) or not docs:
            found.append((doc_id, out(doc_id), "und", 0.0))
            continue
        own = grams(text)
        chance = {lang: math.log(docs[lang] / sum(docs.values())) + sum(n * logs[lang][b] for b, n in own.items()) for lang in sorted(docs)}
        best = max(chance, key=chance.get)
        found.append((doc_id, out(doc_id), best, 1 / sum(math.exp(c - chance[best]) for c in chance.values())))
    return found


def in_order(rows):
    return sorted(rows, key=lambda r: [(x is not None, x) for x in r])


def same(found, expected):
    assert [r[:3] for r in found] == [r[:3] for r in expected]
    assert [r[3] for r in found] == pytest.approx([r[3] for r in expected], abs=1e-3)


def test_predictions_equal_plain_bayes(given):
    docs = given("documents").filter("length(text) < 3000")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang").collect()]
    found = langid.identify(docs)
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"]
    same(in_order(map(tuple, found.collect())), in_order(plain(rows)))
    assert len(rows) > 100


def test_edges(edges, nothing):
    docs = edges.selectExpr("*", "'x' as held_out", "'x' as best", "'x' as total", "'x' as bucket").filter("length(text) < 3000 or text is null")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang").collect()]
    same(in_order(map(tuple, langid.identify(docs).collect())), in_order(plain(rows)))
    assert langid.identify(nothing).count() == 0
    assert {r["lang_pred"] for r in langid.identify(edges.selectExpr("doc_id", "text", "cast(null as string) lang")).collect()} == {"und"}


def test_languages_in_several_passes(given, monkeypatch):
    docs = given("documents").filter("length(text) < 3000").withColumn("lang", _spread())
    whole = in_order(map(tuple, langid.identify(docs).collect()))
    monkeypatch.setattr(langid, "LANGS_PER_PASS", 4)
    monkeypatch.setattr(langid, "LANGS_PER_TASK", 3)
    same(in_order(map(tuple, langid.identify(docs).collect())), whole)
    assert len({r[2] for r in whole}) > 5


def _spread():
    from pyspark.sql import functions as F

    return F.concat("lang", F.pmod("doc_id", F.lit(4)).cast("string"))


def test_long_texts_are_cut_without_loss(monkeypatch):
    text = "Ab é" * 500
    whole = Counter(np.concatenate([b for _, b in langid.ngrams([text, "", "xyz"])]).tolist())
    monkeypatch.setattr(langid, "BATCH_CHARS", 97)
    cut = Counter(np.concatenate([b for _, b in langid.ngrams([text, "", "xyz"])]).tolist())
    assert cut == whole == grams(text) + grams("") + grams("xyz")


def test_accuracy_on_held_out_documents(given):
    docs = given("documents", MIDDLE)
    rows = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(rows) > 200
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.98
