"""Operators on single texts against plain restatements of their contracts."""

import hashlib
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash

from wardbook.llm import bpe, licenses, pii, quality, queries, sharding, spotsigs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def both(given, edges):
    """The given documents and the edge cases, as (frame, [(doc_id, text)])."""
    for df in (given("documents"), edges):
        yield df, [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def ordered(rows):
    return sorted(rows, key=lambda r: [(x is not None, x) for x in r])


# Quality rules


def base_of(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            inside |= {i, i + 1, i + 2}
    seen, repeats = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            repeats += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, repeats, len(inside), failed


def test_quality_base_rules(given, edges):
    for df, texts in both(given, edges):
        found = quality.rate(df).select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"
        )
        assert ordered(map(tuple, found.collect())) == ordered((i, *base_of(t)) for i, t in texts)


def test_quality_distances_follow_the_references(given):
    df = given("documents")
    rows = df.select("doc_id", "text", "lang").collect()
    totals, words, classes = Counter(), {}, {}
    for r in rows:
        found = WORD.findall(r["text"])
        totals[r["lang"]] += len(found)
        words.setdefault(r["lang"], Counter()).update(found)
        classes[r["lang"]] = classes.get(r["lang"], 0) + quality.class_counts(r["text"])
    got = {r["doc_id"]: r for r in quality.rate(df, min_reference=1).collect()}
    judged = 0
    for r in rows:
        own = WORD.findall(r["text"])
        if len(own) < 50:
            assert got[r["doc_id"]]["word_distance"] is None
            continue
        judged += 1
        common = [w for w, n in words[r["lang"]].items() if n >= quality.COMMON * totals[r["lang"]]]
        reference = [words[r["lang"]][w] for w in common]
        mine = Counter(own)
        p = np.array([*[mine[w] for w in common], len(own) - sum(mine[w] for w in common)], dtype=float)
        q = np.array([*reference, totals[r["lang"]] - sum(reference)], dtype=float)
        assert got[r["doc_id"]]["word_distance"] == pytest.approx(quality.distance(p, q), abs=1e-9)
        assert got[r["doc_id"]]["class_distance"] == pytest.approx(
            quality.distance(quality.class_counts(r["text"]), classes[r["lang"]]), abs=1e-9
        )
    assert judged > 100


def test_quality_keeps_labelled_good_documents(given):
    folder = "/root/testdata/sf0.01"
    rated = quality.rate(given("documents", folder)).join(given("labels", folder), "doc_id")
    rows = rated.filter("not base_failed").select("quality", "kept").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert np.mean(good) > 0.99
    assert np.mean(bad) < 0.5


def test_distance_of_histograms():
    a, b = np.array([1.0, 0.0]), np.array([0.0, 2.0])
    assert quality.distance(a, a) == 0
    assert quality.distance(a, b) == pytest.approx(1)


# Byte-level BPE


def test_bpe_agrees_with_the_library(given, edges):
    import tiktoken

    ranks = bpe.read_ranks(public_tokenizers.path(queries.RANKS))
    known = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=dict(ranks), special_tokens={})
    for df, texts in both(given, edges):
        encoded = bpe.encode(df, ranks, public_tokenizers.PATTERN)
        found = bpe.digests(bpe.decode(encoded, ranks))
        both_ways = bpe.round_trip(df, ranks, public_tokenizers.PATTERN, with_ids=True)
        assert ordered(map(tuple, both_ways.drop("ids").collect())) == ordered(map(tuple, found.collect()))
        assert all(len(r["ids"]) == r["n_tokens"] for r in both_ways.collect())
        expected = []
        for i, t in texts:
            ids = known.encode_ordinary(t or "")
            expected.append(
                (i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
            )
        assert ordered(map(tuple, found.collect())) == ordered(expected)


def test_bpe_blocks_and_pieces_of_any_size(given, monkeypatch):
    import tiktoken

    monkeypatch.setattr(bpe, "BLOCK_CHARS", 5_000)
    monkeypatch.setattr(bpe, "PIECE_TOKENS", 300)
    ranks = bpe.read_ranks(public_tokenizers.path(queries.RANKS))
    known = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=dict(ranks), special_tokens={})
    df = given("documents")
    found = {r["doc_id"]: r["ids"] for r in bpe.encode(df, ranks, public_tokenizers.PATTERN, files=True).collect()}
    assert found == {r["doc_id"]: known.encode_ordinary(r["text"]) for r in df.collect()}


def test_bpe_space_cuts_change_nothing():
    import regex

    find = regex.compile(public_tokenizers.PATTERN).findall
    rng = np.random.default_rng(1)
    signs = ["a", "'s", "É", "7", "!", " ", "  ", "\n", "\t", "\x1c", "\x85", "　", "中", "​", "'", "ll"]
    for _ in range(3000):
        text = "".join(rng.choice(signs, rng.integers(0, 14)))
        block = bpe.Block(public_tokenizers.PATTERN)
        block.add(1, text)
        words = list(block.words)
        ((_, numbers),) = block.tokens()
        assert [words[n] for n in numbers] == find(text), repr(text)


def test_pack_round_trip():
    for values in ([], [0], [1, 2**32 - 1, 77], list(range(5000))):
        assert bpe.unpack(bpe.pack(values)).tolist() == values


# Sharding


def test_sharding_contract(given, edges):
    for df, texts in both(given, edges):
        rows = sharding.shard_documents(df, [1.0] * 8).collect()
        data = lambda t: (t or "").encode()
        assert ordered((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == ordered(
            (i, len(data(t)) + 1, zlib.crc32(data(t))) for i, t in texts
        )
        assert all(r["grown_shard"] in (r["shard"], 8) and 0 <= r["shard"] < 8 and r["law"] == "key" for r in rows)
        by_shard = {}
        for r in rows:
            by_shard.setdefault(r["shard"], []).append(r["slot"])
        assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
        assert len({(r["doc_id"], r["shard"]) for r in rows}) == len({r["doc_id"] for r in rows})


def test_sharding_follows_weights(spark):
    df = spark.range(40_000).selectExpr("id as doc_id", "'' as text")
    shares = Counter(r["shard"] for r in sharding.shard_documents(df, [1.0, 2.0, 5.0]).select("shard").collect())
    assert [round(shares[i] / 40_000, 1) for i in range(3)] == [0.1, 0.2, 0.6]


# Licenses


def test_license_base_phrases(given, edges):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for df, texts in both(given, edges):
        expected = []
        for i, t in texts:
            words = word.findall((t or "").translate(lower))
            places = [
                (at, label)
                for label, phrase in licenses.PHRASES
                for at in range(len(words))
                if words[at : at + len(phrase.split())] == phrase.split()
            ]
            starts = [at for at, _ in places]
            expected.append(
                (i, len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})))
            )
        found = licenses.scan_licenses(df)
        rows = found.collect()
        names = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
        assert ordered(tuple(r[n] for n in names) for r in rows) == ordered(expected)
        for r in rows:
            assert 0 <= r["score"] <= 1
            assert set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) | {""}


def test_license_templates_with_a_word_put_in_or_left_out(docs_of):
    text = licenses.TEMPLATES[0][1]
    words = text.split()
    cases = [
        (1, text),
        (2, " ".join([*words[:8], "really", *words[8:]])),
        (3, " ".join([*words[:9], *words[10:]])),
        (4, " ".join(words[:7])),
        (5, " ".join(words[::-1])),
        (6, "This work is licensed under the GNU General Public License, version 3."),
    ]
    found = {r["doc_id"]: r["labels"] for r in licenses.scan_licenses(docs_of(cases)).collect()}
    assert found == {1: "mit", 2: "mit", 3: "mit", 4: "", 5: "", 6: "gpl-3"}


# Personal data


def luhn(d):
    digits = [int(c) for c in d][::-1]
    return sum(digits[::2] + [sum(divmod(2 * x, 10)) for x in digits[1::2]]) % 10 == 0


def pii_of(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub(r"[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_pii_base_spans(given, edges):
    names = ("email", "ip", "card", "phone")
    for df, texts in both(given, edges):
        expected, spans = [], {}
        for i, t in texts:
            found = sorted(pii_of(t or ""), key=lambda x: (x[1], names.index(x[0])))
            listed = ",".join(f"{k}:{a}:{b}" for k, a, b in found)
            spans[i] = set(listed.split(",")) - {""}
            expected.append((i, *[sum(f[0] == n for f in found) for n in names], hashlib.sha256(listed.encode()).hexdigest()))
        rows = pii.find_pii(df).collect()
        assert ordered(tuple(r)[:6] for r in rows) == ordered(expected)
        assert all(spans[r["doc_id"]] <= set(r["spans"].split(",")) for r in rows if r["doc_id"] is not None)


def test_pii_base_spans_of_random_signs():
    rng = np.random.default_rng(3)
    signs = ["1", "25", "256", "007", ".", ".", "..", "@", "@", "a", "b-", "%", "+", "_", " ", "x.y", "[at]", "(at)", " org", "é", ",", "+4 ", "(", ")", "1111"]
    for _ in range(6000):
        text = "".join(rng.choice(signs, rng.integers(0, 25)))
        assert sorted((k, a, b) for k, a, b, holds in pii.base_spans(text) if holds) == sorted(pii_of(text)), text
        base, more = pii.candidates(text)
        spans = sorted((a, b) for _, a, b, *_ in more)
        # Further spans touch neither the base nor one another.
        assert all(b <= c for (_, b), (c, _) in zip(spans, spans[1:], strict=False))
        assert not any(a < d and c < b for a, b in spans for _, c, d in base)


@pytest.mark.parametrize("text", [
    "see " + "0" * 5000 + "1.1.1.1 end", "7" * 1_000_000, "x" * 500_000 + "@" + "y" * 500_000, "a@" * 400_000, "1." * 500_000, "@" * 1_000_000,
    "mail me [at] home (at) " + "q" * 1_000_000, "+1 " * 300_000, "a.b@c.de " * 100_000, "1.2.3.4 " * 120_000, "9 " * 500_000, "password=" + "z" * 1_000_000,
    "me [at] home.org " * 50_000, "+1" + " " * 1_000_000, "(555) 010-0199 " * 60_000,
], ids=lambda t: t[:12])
def test_pii_takes_no_longer_than_the_text(text):
    began = time.perf_counter()
    pii.base_spans(text)
    assert time.perf_counter() - began < 3
    base, more = pii.candidates(text)
    assert time.perf_counter() - began < 12
    if text.startswith("see"):
        assert base == [("ip", 4, 4 + 5007)]


def test_pii_finds_more_than_the_base(given):
    rows = pii.find_pii(given("documents", "/root/testdata/sf0.01")).collect()
    more = [s for r in rows for s in r["spans"].split(",") if s.startswith("secret")]
    assert more
    starts = [[int(s.split(":")[1]) for s in r["spans"].split(",") if s] for r in rows]
    assert all(s == sorted(s) for s in starts)


def planted(texts, seed):
    """Texts with a made span each, in words the labelers know and in others, whether it is personal data, and where it stands."""
    rng = np.random.default_rng(seed)
    digits = lambda n: "".join(str(d) for d in rng.integers(0, 10, n))
    name = lambda n: "".join(rng.choice(list("abcdefghiklmnoprstuvw"), n))

    def number():
        d = digits(15)
        return next(d + str(c) for c in range(10) if not luhn(d + str(c)))

    makers = [
        (True, "secret", "", lambda: f"password={name(5)}{digits(7)}"),
        (True, "secret", "with ", lambda: f"api_key: {digits(4)}{name(12)}"),
        (True, "email", "write to ", lambda: f"{name(6)} [at] {name(7)}.org"),
        (True, "email", "ask ", lambda: f"{name(4)}.{name(5)}(at){name(5)}(dot)com"),
        (True, "phone", "call ", lambda: f"({digits(3)}) {digits(3)}-{digits(4)}"),
        (True, "phone", "reach us under ", lambda: f"{digits(3)}-{digits(3)}-{digits(4)}"),
        (False, "ip", "version ", lambda: f"{rng.integers(1, 9)}.{rng.integers(300, 999)}.{digits(1)}.{rng.integers(256, 999)}"),
        (False, "ip", "release ", lambda: f"{rng.integers(1, 9)}.{digits(1)}.{rng.integers(256, 999)}.{digits(1)}"),
        (False, "card", "order no. ", number),
        (False, "card", "batch ", number),
    ]
    out = []
    for i, text in enumerate(texts):
        true, kind, before, make = makers[rng.integers(len(makers))]
        words, span = text.split(" "), make()
        at = int(rng.integers(len(words) + 1))
        head = " ".join(words[:at] + [before])
        out.append((i, head + span + " " + " ".join(words[at:]), true, f"{kind}:{len(head)}:{len(head) + len(span)}"))
    return out


def test_pii_recall_and_precision_of_further_spans(given, docs_of):
    texts = [r["text"] for r in given("documents", "/root/testdata/sf0.01").orderBy("doc_id").select("text").collect()]
    made = planted(texts, 8)
    rows = {r["doc_id"]: r for r in pii.find_pii(docs_of([m[:2] for m in made])).collect()}
    said = [m[3] in rows[m[0]]["spans"].split(",") for m in made]
    true = [m[2] for m in made]
    hits = sum(s and t for s, t in zip(said, true, strict=True))
    recall, precision = hits / sum(true), hits / sum(said)
    print("recall", recall, "precision", precision)
    by_kind = Counter((m[3].split(":")[0], m[2], s) for m, s in zip(made, said, strict=True))
    assert recall > 0.9 and precision > 0.9, by_kind
    assert all(r["n_spans"] == len([s for s in r["spans"].split(",") if s]) for r in rows.values())


def test_pii_classifier_learns_from_what_no_labeler_sees():
    # One pattern, two kinds of surroundings with other chances: only the hashed words tell them apart.
    texts = [f"lorem{i % 7} {'ring' if i % 2 else 'lot'} 555-010-{1000 + i} end" for i in range(400)]
    spans = [pii.candidates(t)[1][0] for t in texts]
    assert len({s[3] for s in spans}) == 1
    features = [pii._features(t, *s[1:]) for t, s in zip(texts, spans, strict=True)]
    truth = np.array([i % 2 for i in range(400)], dtype=float)
    weights = pii.train(features[:200], np.ones(200), truth[:200])
    assert np.mean((pii.scores(features[200:], weights) > 0.5) == truth[200:]) > 0.98


def test_pii_sample_is_bounded_and_weighted(given, monkeypatch):
    df = given("documents", "/root/testdata/sf0.01")
    whole = {r["doc_id"]: r["spans"] for r in pii.find_pii(df).collect()}
    fitted = []
    train = pii.train
    monkeypatch.setattr(pii, "MAX_OF_PATTERN", 8)
    monkeypatch.setattr(pii, "train", lambda f, n, c: fitted.append((len(f), n.sum())) or train(f, n, c))
    few = {r["doc_id"]: r["spans"] for r in pii.find_pii(df).collect()}
    total = sum(len(s.split(",")) for s in whole.values() if s)
    assert fitted[0][0] < total / 2 and total / 3 < fitted[0][1] < 3 * total
    assert np.mean([few[i] == s for i, s in whole.items()]) > 0.97


@pytest.mark.parametrize("after", ["", " on page 7", " and me [at] home.org"])
def test_pii_proposes_secrets_in_texts_without_digits(after):
    text = "log in with password=correct-horse-battery" + after
    assert ("secret", 12, 42) in [m[:3] for m in pii.candidates(text)[1]]


def test_expectation_maximisation_trusts_reliable_labelers():
    rng = np.random.default_rng(5)
    truth = rng.random(4000) < 0.5
    votes = []
    for t in truth:
        good = ["y" if (t if rng.random() < 0.95 else not t) else "n" for _ in range(3)]
        coin = ["y" if rng.random() < 0.5 else "n" for _ in range(3)]
        votes.append("email|" + "".join(good + coin) + "|1")
    counted = Counter(votes)
    patterns = sorted(counted)
    chance = dict(zip(patterns, pii.estimate(patterns, np.array([counted[p] for p in patterns], dtype=float)), strict=True))
    right = np.mean([(chance[v] > 0.5) == t for v, t in zip(votes, truth, strict=True)])
    assert right > 0.97


# Fingerprints


def test_fingerprints_contract(given, edges):
    for df, texts in both(given, edges):
        rows = spotsigs.fingerprints(df).collect()
        assert len(rows) == len(texts)
        if df is edges:
            continue
        line = sorted(texts, reverse=True)
        got = {r["doc_id"]: r for r in rows}
        for (i, t), (_, after) in zip(line, line[1:] + line[:1], strict=True):
            cut = len(t) // 3
            changed = t[: len(t) - cut] + after[:cut]
            r = got[i]
            a, b, c = (spotsigs.signatures(x) for x in (t, changed, after))
            assert r["n_chars"] == len(t)
            assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
            assert (r["fingerprint"], r["edited_fingerprint"]) == (spotsigs.fingerprint(a), spotsigs.fingerprint(b))
            for name, x in (("near_edited", b), ("near_next", c)):
                union = len(set(a) | set(x))
                assert r[name] == pytest.approx(len(set(a) & set(x)) / union if union else 1.0)
        assert np.mean([r["near_edited"] for r in rows]) > np.mean([r["near_next"] for r in rows]) + 0.3


def test_fingerprint_round_trip_and_pruning():
    spots = spotsigs.signatures("the quick brown fox jumps over the lazy dog and the cat sat on a mat near the door")
    assert np.array_equal(spotsigs.parse(spotsigs.fingerprint(spots)), spots)
    assert spotsigs.likeness(spots, spots) == 1
    assert spotsigs.likeness(spots[:2], spots, 0.8) == 0 < spotsigs.likeness(spots[:2], spots)


# Empty tables


@pytest.mark.parametrize("least", [44, 80, 100])
def test_near_sets_against_all_pairs(given, edges, docs_of, least):
    rng = np.random.default_rng(least)
    words = np.array(["the", "of", "und", *[f"word{i}" for i in range(60)]])
    made = []
    for i in range(12):
        text = list(rng.choice(words, rng.integers(1, 150)))
        made.append((100 * i, " ".join(text)))
        for k in range(1, 5):
            text[rng.integers(len(text))] = str(rng.choice(words))
            text += list(rng.choice(words, rng.integers(0, 3)))
            made.append((100 * i + 17 * k, " ".join(text)))
    for df in (given("documents"), edges, docs_of(made + [(5000, made[7][1])])):
        members, pairs = spotsigs.near_sets(df, least)
        rows = df.select("doc_id", "text").collect()
        own = {r["set"]: r["n"] for r in members.collect()}
        assert members.count() == len(rows)
        sets = {}
        for r in rows:
            x = spotsigs.signatures(r["text"])
            sets[xxhash.xxh3_128_digest(x.astype("<u4").tobytes())] = frozenset(x.tolist())
        assert {k: len(x) for k, x in sets.items()} == own
        names = [k for k in sorted(sets, key=lambda k: (len(sets[k]), k)) if sets[k]]
        expected = {}
        for i, a in enumerate(names):
            for b in names[i + 1 :]:
                both, either = len(sets[a] & sets[b]), len(sets[a] | sets[b])
                if 100 * both >= least * either:
                    expected[a, b] = both / either
        got = [((bytes(r["a"]), bytes(r["b"])), r["near"]) for r in pairs.collect()]
        assert len(got) == len(dict(got)) and dict(got) == expected
    assert least == 100 or expected


@pytest.mark.parametrize("least", [30, 50, 80, 99, 100])
def test_linked_lengths_are_in_neighbouring_partitions(least):
    lows = np.array(spotsigs.length_partitions(2000, least))
    n = np.arange(1, 2001)
    at = np.searchsorted(lows, n, "right") - 1
    longest = n * 100 // least
    reach = np.searchsorted(lows, np.minimum(longest, 2000), "right") - 1
    assert (reach - at <= 1).all()


@pytest.mark.parametrize("name", ["rate", "encode", "shard", "scan", "pii", "spots"])
def test_empty_table(nothing, name):
    ranks = [(bytes([i]), i) for i in range(256)]
    found = {
        "rate": lambda: quality.rate(nothing),
        "encode": lambda: bpe.digests(bpe.decode(bpe.encode(nothing, ranks, public_tokenizers.PATTERN), ranks)),
        "shard": lambda: sharding.shard_documents(nothing, [1.0]),
        "scan": lambda: licenses.scan_licenses(nothing),
        "pii": lambda: pii.find_pii(nothing),
        "spots": lambda: spotsigs.fingerprints(nothing),
    }[name]()
    assert found.collect() == []
