"""Operators over the whole corpus against brute force."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardbook.llm import cotraining, jaccard, lines, mixing

MIDDLE = "/root/testdata/sf0.01"


# Line dedup


def plain_dedup(docs, least):
    """Every run of every length of every document, first places first."""
    split = {i: [x for x in map(str.strip, (t or "").split("\n")) if x] for i, t in docs}
    seen, gone = {}, defaultdict(set)
    longest = max((len(x) for x in split.values()), default=0)
    for m in range(1, longest + 1):
        for i in sorted(split):
            own = split[i]
            for s in range(len(own) - m + 1):
                run = tuple(own[s : s + m])
                if sum(len(x.split()) for x in run) >= least:
                    first = seen.setdefault(run, (i, s))
                    if first != (i, s):
                        gone[i] |= set(range(s, s + m))
    return {i: [x for k, x in enumerate(own) if k not in gone[i]] for i, own in split.items()}


@pytest.mark.parametrize("seed", range(4))
def test_line_dedup_against_every_run(docs_of, seed):
    rng = np.random.default_rng(seed)
    alphabet = [" ".join(f"{c}{i}" for i in range(n)) for c, n in zip("abcdefg", (1, 2, 3, 4, 5, 9, 2), strict=True)]
    docs = [(i, "\n".join(rng.choice(alphabet, rng.integers(0, 18)))) for i in range(25)]
    docs += [(100, docs[3][1]), (101, "\n\n".join(docs[5][1].split("\n")) + "\n"), (102, "\n".join(["a0 b"] * 30))]
    got = {r["doc_id"]: r for r in lines.line_report(docs_of(docs), least=6).collect()}
    expected = plain_dedup(docs, 6)
    for i, left in expected.items():
        assert [x.strip() for x in got[i]["text"].split("\n") if x.strip()] == left, i
        assert got[i]["n_lines"] - got[i]["n_cut"] == len(left)


def test_line_dedup_on_given_documents(given):
    docs = [(r["doc_id"], r["text"]) for r in given("documents").collect()]
    expected = plain_dedup(docs, lines.LEAST_WORDS)
    got = {r["doc_id"]: r["text"] for r in lines.line_report(given("documents")).collect()}
    assert {i: [x.strip() for x in t.split("\n") if x.strip()] for i, t in got.items()} == expected
    assert sum(len(t) for t in got.values()) < sum(len(t) for _, t in docs)


def test_tight_runs():
    assert lines.tight_runs([3, 3, 3], 5) == [[2], [2], []]
    assert lines.tight_runs([1, 1, 5], 5) == [[3], [2], [1]]
    assert lines.tight_runs([2, 2, 1], 4) == [[2, 3], [], []]
    assert lines.tight_runs([], 5) == []


def test_equal_rows_make_their_runs_once(docs_of):
    """Rows with equal id and text, whose lines are found elsewhere too."""
    text = "\n".join(" ".join(f"a{i}b{k}" for k in range(4)) for i in range(6))
    other = "first of all\n" + text
    docs = docs_of([(None, text)] * 40 + [(7, text)] * 30 + [(8, other)])
    runs = lines.repeated_runs(docs, least=6).select("doc_id", "key", "seq", "m").collect()
    assert len(runs) == len(set(runs)) > 0
    got = lines.line_report(docs, least=6).collect()
    assert len(got) == 71
    assert {(r["doc_id"], r["n_lines"], r["n_cut"]) for r in got} == {(None, 6, 0), (7, 6, 6), (8, 7, 6)}


def test_line_dedup_edges(edges, nothing):
    assert lines.dedup_lines(nothing).collect() == []
    before = edges.collect()
    left = lines.dedup_lines(edges)
    assert left.columns == edges.columns
    rows = {}
    for r in left.collect():
        rows.setdefault(r["doc_id"], []).append(r["text"])
    assert len(rows[5]) == 2 and rows[1] == [None] and rows[2] == [""]
    assert rows[10] == ["\n".join(rows[10][0].split("\n")[:1])] and rows[10][0].count("\n") == 0
    assert set(rows) == {r["doc_id"] for r in before}


# Quality classifier


def test_classifier_on_held_out_labels(given):
    docs, labels = given("documents", MIDDLE), given("labels", MIDDLE)
    held = labels.filter("doc_id % 3 = 0")
    scored = cotraining.classify(docs, labels.filter("doc_id % 3 <> 0")).join(held.select("doc_id", "quality"), "doc_id")
    rows = scored.collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert np.mean(good) > 0.97
    assert np.mean(bad) < 0.25
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_classifier_learns_from_the_other_view():
    rng = np.random.default_rng(3)
    n = 2000
    truth = (rng.random(n) < 0.5).astype(float)
    a = np.column_stack([truth + rng.normal(0, 0.4, n), rng.normal(0, 1, n), np.ones(n)])
    b = np.column_stack([truth * 2 + rng.normal(0, 0.8, n), np.ones(n)])
    labels = np.where(np.arange(n) < 60, truth, np.nan)
    model = cotraining.cotrain(a, b, labels)
    assert np.mean((model.scores(a, b)[:, 2] > 0.5) == (truth > 0.5)) > 0.85


def test_classifier_edges(edges, nothing, spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (None, 1), (3, None)], "doc_id long, quality long")
    rows = cotraining.classify(edges, labels).collect()
    assert len(rows) == edges.count() and all(r["kept"] and r["score"] is None for r in rows)
    many = spark.createDataFrame([(i, i % 2) for i in range(1, 14)], "doc_id long, quality long")
    assert cotraining.classify(edges, many).count() == edges.count()
    assert cotraining.classify(nothing, many).collect() == []
    assert cotraining.keep_good(edges, labels).columns == edges.columns


def test_classifier_learns_from_all_unlabelled_documents(spark):
    """The rounds in Spark are those over all documents in memory; there are more than any sample held."""
    rng = np.random.default_rng(5)
    n = 21_000
    good = rng.random(n) < 0.5
    texts = [" ".join(rng.choice(["some", "plain", "words", "here."] if g else ["!!", "|", "BUY", "words"], 4 + i % 9)) for i, g in enumerate(good)]
    rows = [(i, t, "en", f"s{int(g) + 2 * (i % 3)}") for i, (t, g) in enumerate(zip(texts, good, strict=True))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(i, int(good[i])) for i in range(300)], "doc_id long, quality long")
    found = cotraining.features(docs).toArrow().sort_by("doc_id")
    content, metadata = cotraining._unpacked(found["packed"].to_pylist())
    known = np.where(np.arange(n) < 300, good, np.nan)
    expected = cotraining.cotrain(content, metadata, known, found["luck"].to_numpy())
    got = cotraining.train(docs, labels)
    assert np.allclose(got.mean, expected.mean) and np.allclose(got.scale, expected.scale)
    assert np.allclose(got.content, expected.content, atol=1e-4) and np.allclose(got.metadata, expected.metadata, atol=1e-4)
    assert np.allclose(got.mean[:-1], content.mean(0)[:-1])


def test_cut_takes_the_wanted_share():
    counts = np.array([50, 0, 10, 3])
    assert cotraining._cut(counts, 3) == (3, 1.0)
    assert cotraining._cut(counts, 8) == (2, 0.5)
    assert cotraining._cut(counts, 13) == (2, 1.0)
    assert cotraining._cut(counts, 100) == (0, 1.0)


# N-gram Jaccard join


def plain_join(docs):
    sets = []
    for i, t in docs:
        words = (t or "").encode().lower().split()
        grams = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} if words else set())
        sets.append((i, grams))
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    lists = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for g in s:
            lists[g].append(k)
    pairs = {(a, b) for own in lists.values() for x, a in enumerate(own) for b in own[x + 1 :]}
    for a, b in pairs:
        x, y = sets[a][1], sets[b][1]
        both = len(x & y)
        if 100 * both >= 80 * (len(x) + len(y) - both):
            parent[root(a)] = root(b)
    least = {}
    for k, (i, s) in enumerate(sets):
        if s and i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return [(i, len(s), least.get(root(k)) if s else i) for k, (i, s) in enumerate(sets)]


def ordered(rows):
    return sorted(rows, key=lambda r: [(x is not None, x) for x in r])


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", MIDDLE])
def test_join_against_all_pairs(given, folder):
    docs = given("documents", folder)
    expected = plain_join([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert ordered(map(tuple, jaccard.join_documents(docs).collect())) == ordered(expected)


@pytest.mark.parametrize("seed", range(3))
def test_join_near_the_limit(docs_of, seed, monkeypatch):
    """Chains, copies with edits up to just beyond the limit, sets that share most of a common passage."""
    monkeypatch.setattr(jaccard, "LONG", (64, 3, 8)[seed])
    monkeypatch.setattr(jaccard, "LOW", (16, 1, 3)[seed])
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(5000)]
    docs, n = [], 0
    for _ in range(12):
        base = list(rng.choice(words, rng.integers(3, 120)))
        for copy in range(rng.integers(1, 9)):
            text = list(base)
            for _ in range(rng.integers(0, max(1, len(text) // 25) + 1)):
                text[rng.integers(len(text))] = str(rng.choice(words))
            if copy % 3 == 2:
                base = text
            docs.append((n, " ".join(text)))
            n += 1
    passage = " ".join(rng.choice(words, 30))
    for extra in range(40):
        docs.append((n, passage + " " + " ".join(rng.choice(words, extra % 12))))
        n += 1
    expected = plain_join(docs)
    assert ordered(map(tuple, jaccard.join_documents(docs_of(docs)).collect())) == ordered(expected)
    assert len({c for _, _, c in expected}) < len(docs)


@pytest.mark.parametrize("bits", [1, 7])
def test_join_of_sets_with_equal_ids(given, docs_of, monkeypatch, bits):
    monkeypatch.setattr(jaccard, "ID_BITS", bits)
    rows = [(r["doc_id"], r["text"]) for r in given("documents").select("doc_id", "text").collect()]
    words = rows[3][1].split()
    near = [" ".join([*words[:i], "other", *words[i + 1 :]]) for i in range(0, len(words), 9)]
    rows += [(10_000 + i, t) for i, t in enumerate(near)] + [(20_000, None), (20_001, " "), (20_002, rows[5][1]), (None, rows[7][1])]
    found = jaccard.join_documents(docs_of(rows)).collect()
    assert ordered(map(tuple, found)) == ordered(plain_join(rows))
    left = jaccard.one_of_each(docs_of(rows)).select("doc_id").collect()
    assert len(left) == len({r["component_id"] for r in found})


def test_join_shuffles_few_texts_that_are_not_read_again(spark, docs_of, monkeypatch):
    places = docs_of([(i, f"text {i % 3000}") for i in range(4000)] + [(None, None)]).withColumn("place", F.xxhash64("text"))
    first = places.filter("doc_id % 100 = 3 or doc_id is null").select("doc_id", "place")
    wanted = {r["place"] for r in first.collect()}
    for bits in (jaccard.MOST_BITS, 1 << 15):
        monkeypatch.setattr(jaccard, "MOST_BITS", bits)
        found = jaccard._maybe(places, first)
        assert found.columns == places.columns
        rows = found.collect()
        assert sum(r["place"] in wanted for r in rows) == sum(r["place"] in wanted for r in places.collect())
        assert sum(r["place"] not in wanted for r in rows) < 100
    assert jaccard._maybe(places, first.filter("false")).collect() == []


def test_lists_with_the_same_members_are_compared_once(spark):
    rows = [(name, i, 5 if i == 6 else i) for name in range(30) for i in (5, 6, 7)]
    rows += [(100, 5, 5), (100, 6, 5), (101, 5, 5), (101, 7, 7), (102, 5, 5), (102, 7, 7), (103, 6, 5), (103, 7, 7)]
    found = jaccard._main_parts(spark.createDataFrame(rows, "name long, id long, component long")).collect()
    assert {r["name"]: r["main"] for r in found} == {0: 5, 101: 7, 103: 7}


def test_join_edges(edges, nothing):
    texts = [(r["doc_id"], r["text"]) for r in edges.select("doc_id", "text").collect()]
    assert ordered(map(tuple, jaccard.join_documents(edges).collect())) == ordered(plain_join(texts))
    assert jaccard.join_documents(nothing).collect() == []
    left = jaccard.one_of_each(edges)
    assert left.columns == edges.columns
    kept = [r["doc_id"] for r in left.collect()]
    assert kept.count(5) == 1 and 6 not in kept and {1, 2, 3, 4}.issubset(kept)
    assert jaccard.one_of_each(nothing).collect() == []


def test_index_guarantee():
    """Two sets at the limit hold the same in at least as many listed blocks as promised."""
    rng = np.random.default_rng(0)
    for n in (1, 2, 3, 5, 9, 17, 40, 100, 333, 1200):
        for _ in range(20):
            x = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
            drop = rng.integers(0, max(1, int(0.2 * len(x))) + 1)
            y = x[rng.permutation(len(x))[: len(x) - drop]]
            y = np.unique(np.concatenate([y, rng.integers(0, 2**64, int(0.05 * n), dtype=np.uint64)]))
            both = len(np.intersect1d(x, y))
            if 100 * both < 80 * (len(x) + len(y) - both):
                continue
            classes = jaccard._Classes()
            shared = 0
            for c in set(classes.of(len(x))) & set(classes.of(len(y))):
                a, need_a = jaccard.index_entries(x, *c)
                b, need_b = jaccard.index_entries(y, *c)
                met = len(np.intersect1d(a, b))
                if c == max(classes.of(len(x))[0], classes.of(len(y))[0]):
                    assert met >= max(1, min(need_a, need_b))
                shared += met
            assert shared >= 1


def test_index_need_holds_for_each_set():
    """A set that lists its empty blocks, and a linked one that has fewer and lists none."""
    number, high = 3, 10
    blocks, equal = jaccard.blocks_of(high)
    token = lambda block, low: (((block << 32) // blocks + 7) << 32) + low
    x = [token(i % 2, i) for i in range(8)]
    y = [*x, token(3, 1), token(4, 1)]
    x, y = (np.array(sorted(t), dtype=np.uint64) for t in (x, y))
    a, need_a = jaccard.index_entries(x, number, high)
    b, need_b = jaccard.index_entries(y, number, high)
    assert len(a) == blocks and len(b) < blocks
    met = len(np.intersect1d(a, b))
    assert met >= need_a >= 1 and met >= need_b >= 1


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    found = {r["id"]: r["component"] for r in jaccard.components(links).collect()}
    assert found == {**{i: 0 for i in range(1, 41)}, 101: 100}


# Mixing


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: weights[k % 3] for k, s in enumerate(names)}
    out = {s: share * sum(sizes.values()) * w[s] / sum(w.values()) for s in names}
    for _ in range(10_000):
        over = [s for s in names if out[s] > most * sizes[s] + 1e-9]
        if not over:
            break
        excess = sum(out[s] - most * sizes[s] for s in over)
        for s in over:
            out[s] = most * sizes[s]
        free = [s for s in names if out[s] < most * sizes[s] - 1e-9]
        for s in free:
            out[s] += excess * w[s] / sum(w[x] for x in free)
    return out


def test_targets_reshare_the_excess(spark):
    def targets(sizes):
        sums = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        return {r["source"]: r["target"] for r in mixing.source_targets(sums).collect()}

    sizes = {"b": 10, "a": 1000, "é": 500, "z": 3, None: 700, "c": 0}
    got = targets(sizes)
    assert got == pytest.approx(plain_targets(sizes), rel=1e-6, abs=1e-6)
    assert sum(got.values()) == pytest.approx(1.5 * sum(sizes.values()))
    rng = np.random.default_rng(5)
    sizes = {f"s{i}": int(n) for i, n in enumerate(10 ** rng.uniform(0, 6, 300))}
    assert targets(sizes) == pytest.approx(plain_targets(sizes), rel=1e-6, abs=1e-6)
    assert targets({}) == {}


def test_sources_are_numbered_by_code_point(spark):
    names = [None, "", "a", "B", "é", "\uffff", "\U0001f600"] + [f"host{i}.example" for i in range(3000)]
    sums = spark.createDataFrame([(s, 1) for s in names], "source string, source_size long").repartition(7)
    rows = sorted(mixing.numbered(sums).collect(), key=lambda r: r["number"])
    assert [r["number"] for r in rows] == list(range(len(names)))
    assert [r["source"] for r in rows] == sorted(names[1:], key=lambda s: s.encode()) + [None]


def test_more_sources_than_a_driver_would_list(spark):
    """Every other document is a source of its own; half of all words are in one."""
    docs = spark.range(400_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("h"), F.col("id"))).alias("source"),
        F.lit("two words").alias("text"),
    )
    rows = mixing.mixed(docs)
    got = rows.groupBy(F.col("source_size") > 2).agg(F.count("*"), F.sum("target") / F.count("*"), F.max("taken"), F.sum("taken")).collect()
    hot, single = (next(r for r in got if r[0] is own) for own in (True, False))
    assert (hot[1], single[1]) == (200_000, 200_000) and max(hot[3], single[3]) <= 4
    assert single[4] + hot[4] == pytest.approx(1.5 * 800_000, rel=0.01)


def test_mix_contract(given):
    docs = given("documents", MIDDLE)
    texts = {r["doc_id"]: r for r in docs.collect()}
    rows = mixing.mixed(docs).collect()
    assert ordered(map(tuple, rows)) == ordered(map(tuple, mixing.mixed(docs).collect()))
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        assert r["size"] == len((texts[r["doc_id"]]["text"] or "").encode().split())
        assert 0 <= r["taken"] <= 2 * r["size"]
        source = texts[r["doc_id"]]["source"]
        sizes[source] += r["size"]
        taken[source] += r["taken"]
    wanted = plain_targets(sizes)
    for r in rows:
        source = texts[r["doc_id"]]["source"]
        assert r["source_size"] == sizes[source]
        assert r["target"] == pytest.approx(wanted[source], rel=1e-9)
    for s in sizes:
        assert taken[s] == pytest.approx(wanted[s], abs=3 * mixing.BLOCK, rel=0.01)
    assert sum(taken.values()) == pytest.approx(1.5 * sum(sizes.values()), rel=0.01)


def test_mixture_takes_what_the_mix_says(given, edges, nothing):
    for docs in (given("documents"), edges):
        mix = mixing.mixture(docs)
        assert mix.columns == docs.columns
        rows = mix.collect()
        whole = defaultdict(list)
        for r in docs.collect():
            whole[r["doc_id"]] += (r["text"] or "").encode().split()
        for r in rows:
            words = r["text"].encode().split()
            assert 0 < len(words) <= len(whole[r["doc_id"]])
            assert r["n_chars"] == len(r["text"])
        total = mixing.mixed(docs).agg(F.sum("taken")).first()[0]
        assert sum(len(r["text"].encode().split()) for r in rows) == total
    assert mixing.mixture(nothing).collect() == []
    assert mixing.mixed(nothing).collect() == []


@pytest.mark.parametrize("n", [1, 2, 3, 16, 17, 1000, 65_537])
def test_permutation(n):
    for key in (0, 7):
        assert sorted(mixing.permutation(np.arange(n), n, key).tolist()) == list(range(n))


def test_permutations_of_several_ranges_at_once():
    sizes = [1, 2, 5, 64, 1000]
    index, n, key = (np.concatenate(x) for x in zip(*[(np.arange(k), np.full(k, k), np.full(k, 9 + k)) for k in sizes], strict=True))
    got = mixing.permutation(index, n, key)
    for k in sizes:
        assert got[n == k].tolist() == mixing.permutation(np.arange(k), k, 9 + k).tolist()
        assert sorted(got[n == k]) == list(range(k))


@pytest.mark.parametrize("few", [0, 64, 10**9])
def test_draws_are_multinomial(few):
    """Mean, variance and covariance of a source's slots in 8 shards, over 4,000 sources, however the tree is cut."""
    n, shards = 200, 8
    tables = mixing.dealt(list(mixing.halves([(s, 150, 0, shards, n, 0) for s in range(4000)], few, 7)), 7)
    counts = tables.groupby(["number", "shard"]).size().unstack(fill_value=0).to_numpy()
    assert (counts.sum(1) == n).all()
    p = 1 / shards
    assert np.abs(counts.mean(0) - n * p).max() < 5 * np.sqrt(n * p * (1 - p) / 4000)
    cov = np.cov(counts.T)
    assert cov.diagonal() == pytest.approx(np.full(shards, n * p * (1 - p)), rel=0.12)
    assert cov[~np.eye(shards, dtype=bool)].mean() == pytest.approx(-n * p * p, rel=0.12)


def test_slots_take_every_block_in_each_pass(spark, monkeypatch):
    """Sources of all sizes, trees cut into small nodes: totals exact, one block per pass, shards of like size."""
    monkeypatch.setattr(mixing, "_SLOTS_PER_TASK", 300)
    monkeypatch.setattr(mixing, "FEW", 8)
    plan = [(0, 5000, 7500), (1, 1, 2), (2, 40, 80), (3, 300, 0), (4, 77, 30)]
    total = sum(p[2] for p in plan)
    frame = spark.createDataFrame(plan, "number long, blocks long, n_slots long")
    rows = mixing.slots_of(frame, 20, total, 3).toPandas()
    assert sorted(map(tuple, rows.to_numpy())) == sorted(map(tuple, mixing.slots_of(frame.repartition(3), 20, total, 3).toPandas().to_numpy()))
    for number, blocks, n in plan:
        times = rows[rows["number"] == number]["block"].value_counts()
        assert times.sum() == n and (not n or times.max() <= -(-n // blocks)) and (n < blocks or len(times) == blocks)
    sizes = rows["shard"].value_counts()
    assert len(sizes) == 20 and (np.abs(sizes - total / 20) < 6 * np.sqrt(total / 20)).all()


def test_small_sources_reach_their_target(docs_of):
    """Sources of a few blocks beside a large one, over many shards: all that are wanted in full are taken in full."""
    rows = [(i, " ".join(["hot"] * 500), None, "hot") for i in range(400)]
    rows += [(1000 + i, " ".join(["w"] * (mixing.BLOCK * (1 + i % 5))), None, f"small{i:02}") for i in range(40)]
    docs = docs_of(rows)
    taken, target, size = defaultdict(int), {}, {}
    found = mixing.mixed(docs, slots=64).join(docs.select("doc_id", "source"), "doc_id").collect()
    for r in found:
        taken[r["source"]] += r["taken"]
        target[r["source"]], size[r["source"]] = r["target"], r["source_size"]
    full = [s for s in size if target[s] == 2 * size[s]]
    assert len(full) == 40
    assert all(taken[s] == 2 * size[s] for s in full)
    assert taken["hot"] == pytest.approx(target["hot"], abs=2 * mixing.BLOCK)


# Pipeline


def test_pipeline(spark):
    import corpus_pipeline as c

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, before = docs.columns, docs.count()
    counts = []
    for name, stage in c.STAGES[:-1]:
        docs = c.settled(stage(spark, docs, folder))
        assert docs.columns == columns, name
        counts.append(docs.count())
    assert before > counts[0] >= counts[1] >= counts[2] > 0
    final = c.run(spark, folder).collect()
    assert len(final) == counts[3]
    assert all(r["n_tokens"] == len(r["ids"]) for r in final)
