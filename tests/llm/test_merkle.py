"""The manifest against a tree built in plain Python."""

import hashlib
import zlib

import pytest

from wardbook.llm import merkle

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def framed(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def tree(level):
    """Levels of a tree, from its leaves to its top."""
    levels = [level]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i : i + 8]) for i in range(0, len(last), 8)])
    return levels


def walk(levels, at, found):
    """Siblings on the way up and the digest folded from ``found``."""
    siblings = []
    for level in levels[:-1]:
        low = at // 8 * 8
        run = level[low : low + 8]
        siblings += [d for i, d in enumerate(run) if i != at - low]
        run = run.copy()
        run[at - low] = found
        found, at = h(*run), at // 8
    return siblings, found


def plain(rows):
    """Rows of the manifest for (doc_id, source, lang, n_chars, text) rows."""
    langs = {}
    for doc_id, source, lang, n_chars, text in rows:
        own = [framed(x) for x in (doc_id, source, lang, n_chars)]
        leaf = h(*own, framed(text))
        hit = doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
        langs.setdefault(lang, []).append((doc_id, leaf, h(*own, framed(lowered(text) if hit else text))))
    ordered = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in ordered:
        langs[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[lang] = tree([leaf for _, leaf, _ in langs[lang]])
    top = tree([trees[lang][-1][0] for lang in ordered])
    found = []
    for place, lang in enumerate(ordered):
        for at, (doc_id, leaf, now) in enumerate(langs[lang]):
            low, folded = walk(trees[lang], at, now)
            high, folded = walk(top, place, folded)
            root = top[-1][0]
            found.append((doc_id, leaf, trees[lang][-1][0], root, h(*low, *high), folded, folded == root))
    return found


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


def rows_in(df):
    return [tuple(r) for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()]


def test_manifest_equals_plain_tree(given):
    docs = given("documents")
    found = merkle.manifest(docs)
    assert found.columns == COLUMNS
    rows = [tuple(r) for r in found.collect()]
    assert in_order(rows) == in_order(plain(rows_in(docs)))
    assert 0 < sum(r[-1] for r in rows) < len(rows)


@pytest.mark.parametrize("per_lang", [(1,), (8,), (9,), (1, 1, 65), (64, 7, 1, 1, 1, 1, 1, 1, 1, 3), (600,)])
def test_manifest_of_any_shape(spark, per_lang, monkeypatch):
    monkeypatch.setattr(merkle, "RUNS_PER_BLOCK", 3)
    rows = [(1000 * k + i, "S", None if k == 1 else f"l{k}", i, f"Text {i}") for k, n in enumerate(per_lang) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(3)
    assert in_order(map(tuple, merkle.manifest(docs).collect())) == in_order(plain(rows))


def test_manifest_edges(edges, nothing):
    docs = edges.selectExpr("*", "'x' as tree", "'x' as digest", "1 as pos", "1 as n", "1 as run", "1 as block", "1 as h")
    assert in_order(map(tuple, merkle.manifest(docs).collect())) == in_order(plain(rows_in(edges)))
    found = merkle.manifest(nothing)
    assert found.columns == COLUMNS and found.count() == 0


def test_equal_rows_are_leaves_of_their_own(spark):
    rows = [(None, "S", "en", 4, "Same")] * 300 + [(3, "S", "en", 4, "Same")] * 100 + [(9, None, "", None, None)] * 9
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    assert in_order(map(tuple, merkle.manifest(docs).collect())) == in_order(plain(rows))


def test_setting_of_the_session_is_left_as_it_was(spark, given):
    spark.conf.set("spark.sql.cteRecursionRowLimit", "77")
    try:
        assert merkle.manifest(given("documents")).count() > 77
        assert spark.conf.get("spark.sql.cteRecursionRowLimit") == "77"
    finally:
        spark.conf.unset("spark.sql.cteRecursionRowLimit")
