"""Personal data: labelers vote on candidate spans, expectation maximisation weighs them.

1. Patterns propose spans. Regular expressions, gazetteers and the words in
   front of a span vote yes, no or abstain on each.
2. Spans with equal kind, votes and length class are counted over all
   documents; there are at most a few thousand such patterns, whatever the
   input. On these counts expectation maximisation estimates how far each
   labeler can be trusted, and gives every pattern the chance that it is
   personal data.
3. A logistic model decides. Besides the votes it sees what no labeler looks
   at: the span's run of signs and the words and signs around it, hashed. It
   is fitted to the estimated chances, on a bounded sample of the spans.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import settled

# The base patterns and their order.
KINDS = ("email", "ip", "card", "phone")
# email: [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+, in its part before the @ and the one behind it
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# ip: [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+), four neighbours of a chain of dotted numbers
_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Spans that the method proposes besides.
_LOOSE = (
    ("phone", re.compile(r"(?<![0-9+.])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])")),
    ("secret", re.compile(r"(?:password|passwd|token|api_key|secret) ?[=:] ?\"?[A-Za-z0-9_-]{8,128}")),
)
# An address with its signs spelt out: what stands behind the name, whose signs these are, and how many there may be.
_SPELT = re.compile(r"(?:\[at\]|\(at\)) ?[A-Za-z0-9-]{1,63}(?: ?(?:\[dot\]|\(dot\)|\.) ?[A-Za-z]{2,24}){1,3}")
_SPELT_LOCAL, _SPELT_MOST = _LOCAL - {"%"}, 64
# Without these a loose pattern of the kind has no match.
_NEEDED = {"phone": re.compile("[0-9]"), "secret": re.compile("[=:]")}
_ORDER = {kind: i for i, kind in enumerate((*KINDS, "secret"))}

# Gazetteers and cue words.
_ENDINGS = frozenset("com org net edu gov io de fr es uk eu info example".split())
_COUNTRIES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 52 54 55 56 57 61 62 63 64 65 66 81 82 84 86 90 91 92".split())
_CUES = re.compile(r"\b(?:e-?mail|contact|write|call|phone|tel|mobile|fax|whatsapp|ip|host|address|server|login|card|visa|credit|pay|password|token|secret|key)\b", re.IGNORECASE)
_AGAINST = re.compile(r"\b(?:version|ver|isbn|issn|order|invoice|page|fig|figure|section|chapter|part|no|nr|doi)\b[ .:#=]*$", re.IGNORECASE)
_REACH = 32

VOTES = ("strict", "check", "gazetteer", "cue", "against", "shape")

# Places of the classifier's weights; features meet there by hash.
WIDTH = 1 << 12
# So many spans, all different, the classifier is fitted on at most, about, and of one pattern.
MAX_SPANS, MAX_OF_PATTERN = 50_000, 1_000
_SIGNS = ((re.compile("[0-9]+"), "9"), (re.compile("[A-Z]+"), "A"), (re.compile("[a-z]+"), "a"), (re.compile(r"[^\x00-\x7F]+"), "é"))
_WORD = re.compile(r"[^\W_]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _checked(kind: str, span: str) -> bool:
    """Does a span hold what its kind asks beyond the pattern?"""
    if kind == "ip":
        parts = [p.lstrip("0") for p in span.split(".")]
        return all(len(p) < 4 and int(p or "0") < 256 for p in parts)
    if kind == "card":
        d = _digits(span)
        return 12 <= len(d) <= 19 and luhn(d)
    if kind == "phone":
        return 9 <= len(_digits(span)) <= 15
    return True


def _back(text: str, at: int, low: int, signs: frozenset[str]) -> int:
    """Where the run of ``signs`` that ends at ``at`` begins, no further back than ``low``."""
    while at > low and text[at - 1] in signs:
        at -= 1
    return at


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of the address pattern, leftmost first, in time linear in the text.

    A match holds one @, and its first part is the whole run in front of it,
    as far as no match before has taken it; no other start can be further left.
    """
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        behind = _DOMAIN.match(text, at + 1)
        start = _back(text, at, end, _LOCAL) if behind else at
        if start < at:
            end = behind.end()
            found.append((start, end))
        at = text.find("@", max(at + 1, end))
    return found


def ips(text: str) -> list[tuple[int, int]]:
    """Matches of the pattern of four dotted numbers, leftmost first, in time linear in the text.

    A match begins and ends with whole numbers, so a chain of dotted numbers
    holds one for every four of them.
    """
    found = []
    for chain in _CHAIN.finditer(text):
        if chain[0].count(".") < 3:
            continue
        start, bounds = chain.start(), []
        for number in chain[0].split("."):
            bounds.append((start, start + len(number)))
            start += len(number) + 1
        found += [(bounds[i][0], bounds[i + 3][1]) for i in range(0, len(bounds) - 3, 4)]
    return found


def spelt_emails(text: str) -> list[tuple[int, int]]:
    """Addresses whose @ is spelt out, leftmost first."""
    found, end = [], 0
    for sign in _SPELT.finditer(text):
        name = sign.start() - (sign.start() > end and text[sign.start() - 1] == " ")
        start = _back(text, name, max(end, name - _SPELT_MOST), _SPELT_LOCAL)
        if start < name:
            end = sign.end()
            found.append((start, end))
    return found


def base_spans(text: str) -> list[tuple[str, int, int, bool]]:
    """Every match of the base patterns, leftmost and without overlap per kind, and whether it holds."""
    found = [("email", start, end, True) for start, end in emails(text)]
    if re.search("[0-9]", text):
        found += [("ip", start, end, _checked("ip", text[start:end])) for start, end in ips(text)]
        found += [("card", m.start(), m.end(), _checked("card", m[0])) for m in _CARD.finditer(text)]
    if "+" in text:
        found += [("phone", m.start(), m.end(), _checked("phone", m[0])) for m in _PHONE.finditer(text)]
    return found


def _votes(text: str, kind: str, start: int, end: int, strict: bool) -> str:
    """One letter per labeler: y, n or - (abstains), then the span's length class."""
    span, ahead = text[start:end], text[max(0, start - _REACH) : start]
    digits = _digits(span)
    votes = ["y" if strict else "-"]
    if kind == "email":
        ending = re.split(r"[^A-Za-z0-9-]+", span.rstrip(")]"))[-1].lower()
        votes += ["y" if re.fullmatch("[a-z]{2,24}", ending) else "n", "y" if ending in _ENDINGS else "-"]
    elif kind == "secret":
        votes += ["y" if digits else "n", "-"]
    elif kind == "phone":
        votes += ["y" if 9 <= len(digits) <= 15 else "n", "y" if any(digits[:n] in _COUNTRIES for n in (1, 2)) and span[0] == "+" else "-"]
    else:
        votes += ["y" if _checked(kind, span) else "n", "-"]
    votes.append("y" if _CUES.search(ahead) or kind == "secret" else "-")
    votes.append("n" if _AGAINST.search(ahead) else "-")
    shaped = {
        "email": "@" in span,
        "secret": len(span) >= 16,
        "phone": bool(re.search("[ ().-]", span)),
        "card": 13 <= len(digits) <= 16,
        "ip": 7 <= len(span) <= 15,
    }[kind]
    votes.append("y" if shaped else "n")
    return f"{kind}|{''.join(votes)}|{min(3, len(span) // 8)}"


def _features(text: str, start: int, end: int, pattern: str) -> str:
    """Places of a span's features, four hexadecimal digits each, in order.

    Votes and length class are among them by name. The others are the runs of
    signs inside (its first 24 runs, and each three in a row of these), the
    sign at either end, and the words around, whole or as they are cut by
    ``_REACH``.
    """
    kind, votes, length = pattern.split("|")
    found = [f"length {length}", *[f"{v} {c}" for v, c in zip(VOTES, votes, strict=True)]]
    runs = text[start : min(end, start + 256)]
    for signs, name in _SIGNS:
        runs = signs.sub(name, runs)
    runs = runs[:24]
    found += [f"runs {runs}", *[f"in {runs[i : i + 3]}" for i in range(len(runs) - 2)]]
    ahead, behind = text[max(0, start - _REACH) : start], text[end : end + _REACH]
    found += [f"before {ahead[-1:]}", f"after {behind[:1]}"]
    words = [w.lower() for w in _WORD.findall(ahead)][-2:]
    found += [f"ahead {w}" for w in words] + [f"next ahead {w}" for w in words[-1:]]
    found += [f"behind {w.lower()}" for w in _WORD.findall(behind)[:1]]
    places = {zlib.crc32(f"{kind} {f}".encode("utf-8", "replace")) % WIDTH for f in found}
    places |= {zlib.crc32(f.encode()) % WIDTH for f in found[1 : 1 + len(VOTES)]} | {zlib.crc32(kind.encode()) % WIDTH}
    return "".join(f"{x:04x}" for x in sorted(places))


def candidates(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int, str]]]:
    """Base spans, and further proposed spans with their pattern.

    Card matches count as proposals only from 12 digits on: shorter runs of
    digits are numbers of any kind.
    """
    base, more = [], []
    for kind, start, end, holds in base_spans(text):
        if holds:
            base.append((kind, start, end))
        elif kind != "card" or (end - start >= 12 and len(_digits(text[start:end])) >= 12):
            more.append((kind, start, end, False))
    more += [("email", start, end, False) for start, end in spelt_emails(text)]
    for kind, pattern in _LOOSE:
        if _NEEDED[kind].search(text):
            more += [(kind, m.start(), m.end(), False) for m in pattern.finditer(text)]
    taken = sorted((s, e) for _, s, e in base)
    starts, furthest = [s for s, _ in taken], list(accumulate((e for _, e in taken), max))
    kept, last = [], 0
    for kind, start, end, _ in sorted(more, key=lambda x: (x[1], -x[2])):
        # The furthest end of the base spans that begin before this one ends tells whether one of them overlaps it.
        before = bisect_left(starts, end)
        if start >= last and (not before or furthest[before - 1] <= start):
            last = end
            kept.append((kind, start, end, _votes(text, kind, start, end, False)))
    return base, kept


def _spans_text(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], _ORDER[x[0]], x[2])))


_FOUND = (
    "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base string, more string, "
    "tallies string"
)


def _found(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for text in texts:
        text = text or ""
        base, more = candidates(text)
        listed = _spans_text(base)
        votes = [(s, e, _votes(text, k, s, e, True)) for k, s, e in base] + [m[1:] for m in more]
        tallies = [f"{p}/{_features(text, s, e, p)}" for s, e, p in votes]
        rows.append(
            (
                *[sum(b[0] == kind for b in base) for kind in KINDS],
                hashlib.sha256(listed.encode()).hexdigest(),
                listed,
                ",".join(f"{k}:{s}:{e}:{t.partition('/')[2]}" for (k, s, e, _), t in zip(more, tallies[len(base) :], strict=True)),
                ",".join(tallies),
            )
        )
    return pd.DataFrame(rows, columns=[c.split()[0] for c in _FOUND.split(", ")])


def estimate(patterns: list[str], counts: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Chance that a span of each pattern is personal data, by expectation maximisation.

    Each labeler has its own odds of saying yes for true and for false spans;
    these and the share of true spans are estimated in turn. Votes of one
    span count as independent given the truth, and abstaining says nothing.
    """
    votes = np.array([["yn-".index(c) for c in p.split("|")[1]] for p in patterns])
    yes, no = (votes == 0).sum(1), (votes == 1).sum(1)
    chance = (yes + 1.0) / (yes + no + 2.0)
    for _ in range(rounds):
        prior = np.clip((chance * counts).sum() / counts.sum(), 0.05, 0.95)
        logs = np.full((len(patterns), 2), [np.log(1 - prior), np.log(prior)])
        for column in votes.T:
            said = column < 2
            for side, weight in ((0, (1 - chance) * counts), (1, chance * counts)):
                table = np.bincount(column[said], weights=weight[said], minlength=2) + 1.0
                logs[said, side] += np.log(table / table.sum())[column[said]]
        chance = 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -50, 50)))
    return chance


def _places(features: list[str]) -> np.ndarray:
    """Places of each span's features, a row each, filled up with the place behind the last one."""
    rows = [np.frombuffer(bytes.fromhex(f), ">u2") for f in features]
    out = np.full((len(rows), max(map(len, rows), default=0)), WIDTH, dtype=np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def scores(features: list[str], weights: np.ndarray) -> np.ndarray:
    """The classifier's chance that each span is personal data."""
    return 1 / (1 + np.exp(-np.clip(weights[_places(features)].sum(axis=1), -50, 50)))


def train(features: list[str], counts: np.ndarray, chance: np.ndarray, steps: int = 300) -> np.ndarray:
    """Weights of a logistic model of the spans' features, fitted to the estimated chances.

    Each of the features' places has its own step length, by the gradients it has had.
    """
    places = _places(features)
    weight = counts / counts.sum()
    beta, past = np.zeros(WIDTH + 1), np.full(WIDTH + 1, 1e-8)
    for _ in range(steps):
        miss = weight * (1 / (1 + np.exp(-np.clip(beta[places].sum(axis=1), -50, 50))) - chance)
        slope = np.bincount(places.ravel(), np.repeat(miss, places.shape[1]), minlength=WIDTH + 1) + 1e-4 * beta
        slope[WIDTH] = 0
        past += slope * slope
        beta -= 0.3 * slope / np.sqrt(past)
    return beta


def _fitted(rows: DataFrame) -> np.ndarray | None:
    """The classifier's weights; none if no text holds a span.

    All spans are counted. Of a pattern's different spans, those whose hash
    falls below the pattern's share are fitted, each standing for as many as
    it is its share of.
    """
    tallies = settled(
        rows.filter(F.col("tallies") != "")
        .select(F.explode(F.split("tallies", ",")).alias("tally"))
        .groupBy("tally")
        .count()
        .select(F.split_part("tally", F.lit("/"), F.lit(1)).alias("pattern"), F.split_part("tally", F.lit("/"), F.lit(2)).alias("features"), "count")
    )
    # At most 5 kinds x 3^6 votes x 4 lengths.
    counted = tallies.groupBy("pattern").agg(F.sum("count").alias("n"), F.count("*").alias("different")).orderBy("pattern").collect()
    if not counted:
        return None
    chance = estimate([r["pattern"] for r in counted], np.array([r["n"] for r in counted], dtype=float))
    most = min(MAX_OF_PATTERN, max(1, MAX_SPANS // len(counted)))
    known = [(r["pattern"], float(c), min(1.0, most / r["different"])) for r, c in zip(counted, chance, strict=True)]
    told = rows.sparkSession.createDataFrame(known, "pattern string, chance double, share double")
    place = (F.xxhash64("pattern", "features").bitwiseAND(F.lit((1 << 30) - 1)) + 0.5) / float(1 << 30)
    sample = tallies.join(F.broadcast(told), "pattern").filter(place < F.col("share")).collect()
    sample.sort(key=lambda r: (r["pattern"], r["features"]))
    return train(
        [r["features"] for r in sample],
        np.array([r["count"] / r["share"] for r in sample]),
        np.array([r["chance"] for r in sample]),
    )


def find_pii(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """One row per document with counts of base spans, their digest, all spans and the number of these.

    Spans read kind:start:end in code points, the end exclusive. Base spans
    stay whatever the model says; others join where it gives ``least`` or
    more. Null text counts as empty, without spans. Repeated rows are treated
    one by one, an empty table gives no rows. Only doc_id and text are read.
    """
    rows = settled(docs.select("doc_id", F.pandas_udf(_found, _FOUND)("text").alias("f")).select("doc_id", "f.*"))
    weights = _fitted(rows)

    @F.pandas_udf("spans string, n_spans long")
    def spans(base: pd.Series, more: pd.Series) -> pd.DataFrame:
        out = []
        for own, extra in zip(base, more, strict=True):
            listed = [x.split(":") for x in own.split(",") if x]
            if extra:
                proposed = [x.split(":") for x in extra.split(",")]
                found = scores([x[3] for x in proposed], weights)
                listed += [x for x, score in zip(proposed, found, strict=True) if score >= least]
            out.append((_spans_text([(x[0], int(x[1]), int(x[2])) for x in listed]), len(listed)))
        return pd.DataFrame(out, columns=["spans", "n_spans"])

    return rows.withColumn("s", spans("base", "more")).select("*", "s.*").drop("base", "more", "tallies", "s")
