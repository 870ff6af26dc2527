"""Document fingerprints of spot signatures.

A spot signature is a common word (the anchor) with the chain of the next
content words behind it. Common words are spread evenly over prose and rare
in tables, menus and lists, so the set of these signatures follows a
document's running text. Texts without common words would have no
signatures; so words whose hash begins with three zero bits are anchors too.

Near copies are found by ``near_sets``: distinct signature sets are
partitioned by length, so that linked ones lie in one partition or in
neighbouring ones, and meet there on their rarest signatures.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from .common import settled

CHAIN = 2
LEAST = 80  # per cent

# Common words of English, German, French and Spanish.
ANCHORS = frozenset(
    """
    a an and are as at be by for from in is it of on or that the this to was were what with
    als auf aus das dem den der die ein eine für im in ist mit nicht sich sie und von zu
    au avec dans de des du en est et il la le les ne par pas pour qui que se sur un une
    al como con del el en es las lo los más no para por su una y
    """.split()
)
_EDGES = ".,;:!?\"'()[]{}<>«»¿¡-–—|*#$%&"
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    """Hash of each word once, its lowest bit set for anchors; 0 for what holds no letters or digits."""

    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        bare = word.strip(_EDGES).lower()
        value = 0
        if bare:
            value = xxhash.xxh3_64_intdigest(bare.encode())
            anchor = bare in ANCHORS or value >> 61 == 0
            value = (value | 1) if anchor else (value | 2) & ~1
        self[word] = value
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * _MULTIPLIER
    return (x ^ (x >> np.uint64(29))) * _MULTIPLIER


def signatures(text: str | None, cache: _Words | None = None) -> np.ndarray:
    """Sorted distinct 32-bit signatures of a whole text.

    A text too short for one chain has its words as signatures; null and
    wordless texts have none.
    """
    cache = _Words() if cache is None else cache
    found = (text or "").split()
    words = np.fromiter(map(cache.__getitem__, found), np.uint64, len(found))
    words = words[words != 0]
    is_anchor = (words & np.uint64(1)).astype(bool)
    content = words[~is_anchor]
    # Content words before each position tell where the chain behind an anchor starts.
    start = np.cumsum(~is_anchor)[is_anchor]
    whole = start + CHAIN <= len(content)
    start = start[whole]
    if len(start):
        value = words[is_anchor][whole]
        for i in range(CHAIN):
            value = _mixed(value) + content[start + i]
    else:
        value = words
    return np.unique((_mixed(value) >> np.uint64(32)).astype(np.uint32))


def fingerprint(spots: np.ndarray) -> str:
    """The whole set as text: its length, then the signatures in order."""
    return f"{len(spots)}:{base64.b64encode(spots.astype('<u4').tobytes()).decode()}"


def parse(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text.partition(":")[2]), dtype="<u4")


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard of two signature sets; two empty sets are alike.

    Where the lengths alone keep it below ``least`` the sets are not compared
    and the result is 0.
    """
    short, long = sorted((len(a), len(b)))
    if long == 0:
        return 1.0
    if short / long < least:
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (short + long - both)


def edited(text: str, following: str) -> str:
    """The last third of the code points gives way to as many first ones of the following text."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ]
)


def _compared(doc_id, text: str, spots: np.ndarray, following: str, next_spots: np.ndarray, cache) -> tuple:
    changed = edited(text, following)
    changed_spots = signatures(changed, cache)
    return (
        doc_id,
        len(text),
        hashlib.sha256(changed.encode()).hexdigest(),
        fingerprint(spots),
        fingerprint(changed_spots),
        likeness(spots, changed_spots),
        likeness(spots, next_spots),
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)


def _walk(batches):
    """Compare each row of a sorted part with the one after it. Last in a part comes the first text of the next one."""
    cache, held, rows = _Words(), None, []
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            some = batch.slice(at, 256)
            for part, follows, doc_id, text in zip(*(some[c].to_pylist() for c in ("part", "follows", "doc_id", "text")), strict=True):
                text = text or ""
                spots = signatures(text, cache)
                if held is not None and held[0] == part:
                    rows.append(_compared(*held[1:], text, spots, cache))
                held = None if follows else (part, doc_id, text, spots)
            if len(rows) >= 2_000:
                yield _batch(rows)
                rows = []
    if rows:
        yield _batch(rows)


def _parts(bounds: np.ndarray):
    """The part of an id between bounds; an id that fills several parts alone is cut by hash."""

    def part(ids: pd.Series, hashes: pd.Series) -> pd.Series:
        own = ids.to_numpy(dtype=np.int64)
        low, high = np.searchsorted(bounds, own, "left"), np.searchsorted(bounds, own, "right")
        share = (hashes.to_numpy(dtype=np.int64).astype(np.float64) + 2.0**63) / 2.0**64
        inside = np.floor(share * np.maximum(high - low, 1)).astype(np.int64)
        return pd.Series(low + np.minimum(inside, np.maximum(high - low - 1, 0)))

    return F.pandas_udf(part, "long")


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: fingerprints of its text and of its edited text, and likeness to both neighbours.

    The next document is the one with the next lower id (null ids come last,
    equal ids in the order of their texts' hashes); after the last comes the
    first. Null text counts as empty. Repeated rows each have a row, an empty
    table gives none. Only doc_id and text are read.

    Rows are dealt out in parts of neighbouring ids and walked in order. The
    first text of each part also goes to the part before it.
    """
    spark = docs.sparkSession
    # A null id stands below all others.
    own = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), own.alias("at"), F.xxhash64("text").alias("hash"), "text"
    )
    n = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    steps = [i / n for i in range(1, n)]
    bounds = docs.select(own.cast("double").alias("at")).approxQuantile("at", steps, 0.1 / n)
    bounds = np.array([max(int(b), -(2**63)) for b in bounds], dtype=np.int64)
    rows = rows.withColumn("part", _parts(bounds)("at", "hash"))
    # One row per part: its first document in falling order.
    firsts = settled(rows.groupBy("part").agg(F.max(F.struct("at", "hash")).alias("first")).select("part", "first.*"))
    line = Window.orderBy("part")
    above = firsts.select(F.coalesce(F.lead("part").over(line), F.min("part").over(Window.partitionBy())).alias("part"), "at", "hash")
    heads = docs.select(own.alias("at"), F.xxhash64("text").alias("hash"), "text").join(
        F.broadcast(above), ["at", "hash"]
    ).dropDuplicates(["part"])
    shape = ["part", "follows", "doc_id", "at", "hash", "text"]
    both = rows.withColumn("follows", F.lit(False)).select(shape).unionByName(
        heads.select("part", F.lit(True).alias("follows"), F.lit(None).cast("long").alias("doc_id"), "at", "hash", "text")
    )
    walked = both.repartition("part").sortWithinPartitions("part", "follows", F.desc("at"), F.desc("hash"))
    return walked.select("part", "follows", "doc_id", "text").mapInArrow(_walk, _SCHEMA)


def length_partitions(longest: int, least: int = LEAST) -> list[int]:
    """Lowest length of each partition; sets that are linked lie in one partition or in neighbouring ones."""
    lows = [1]
    while lows[-1] <= longest:
        lows.append(max(lows[-1], lows[-1] * 100 // least) + 1)
    return lows


def _partition(least: int):
    """Number of a length's partition, and whether a set of that length can be linked to one of the next."""

    @F.pandas_udf("part long, next boolean")
    def part(n: pd.Series) -> pd.DataFrame:
        own = n.to_numpy(dtype=np.int64)
        lows = np.array(length_partitions(int(own.max(initial=1)), least), dtype=np.int64)
        at = np.searchsorted(lows, own, "right") - 1
        return pd.DataFrame({"part": at, "next": 100 * own >= least * lows[at + 1]})

    return part


def _spots(batches):
    """The signature set of each document, named by its digest."""
    cache, schema = _Words(), pa.schema([("doc_id", pa.int64()), ("set", pa.binary()), ("n", pa.int64()), ("spots", pa.binary())])
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            some = batch.slice(at, 256)
            rows = []
            for doc_id, text in zip(some["doc_id"].to_pylist(), some["text"].to_pylist(), strict=True):
                spots = signatures(text, cache)
                own = spots.astype("<u4").tobytes()
                rows.append((doc_id, xxhash.xxh3_128_digest(own), len(spots), own))
            columns = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _listed(spots: pd.Series) -> pd.Series:
    return pd.Series([np.frombuffer(x, dtype="<u4").astype(np.int64) for x in spots], dtype=object)


def near_sets(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """Every document with the name of its signature set, and all pairs of distinct sets with a Jaccard of ``least`` per cent.

    Columns are doc_id, set, n and a, b, near; of a pair a is the shorter set,
    or at equal length the one with the lower name. Documents with equal sets
    share a name and make no pairs; the empty set is in none. An empty table
    gives no rows.

    The signatures of a set stand from rare to common. Two linked sets of n
    and m share one among the first n - least * n + 1 and m - least * m + 1,
    and from the first one that they share on enough are left in both. Pairs
    whose lengths or positions don't allow it are never compared.
    """
    if not 0 < least <= 100:
        raise ValueError("least is a share in per cent")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = settled(texts.mapInArrow(_spots, "doc_id long, set binary, n long, spots binary"))
    sets = settled(found.filter("n > 0").dropDuplicates(["set"]).select("set", "n", "spots"))
    each = sets.select("set", "n", F.explode(F.pandas_udf(_listed, "array<long>")("spots")).alias("sig"))
    often = each.groupBy("sig").agg(F.count("*").alias("often"))
    ranked = each.join(often, "sig").groupBy("set", "n").agg(F.array_sort(F.collect_list(F.struct("often", "sig"))).alias("sigs"))
    first = F.expr(f"cast(n - (n * {least} + 99) div 100 + 1 as int)")
    entries = ranked.select("set", "n", F.posexplode(F.slice("sigs", F.lit(1), first)).alias("pos", "s")).filter("s.often > 1")
    entries = settled(entries.withColumn("p", _partition(least)("n")).select("set", "n", "pos", "s.sig", "p.*"))
    b = entries.select("part", "sig", F.col("set").alias("b"), F.col("n").alias("b_n"), F.col("pos").alias("b_pos"))
    shape = ["part", "sig", F.col("set").alias("a"), F.col("n").alias("a_n"), F.col("pos").alias("a_pos")]
    a = entries.withColumn("below", F.lit(False)).unionByName(
        entries.filter("next").withColumn("part", F.col("part") + 1).withColumn("below", F.lit(True))
    ).select(*shape, "below")
    shorter = F.col("below") | (F.struct("a_n", "a") < F.struct("b_n", "b"))
    lengths = 100 * F.col("a_n") >= least * F.col("b_n")
    left = F.least(F.col("a_n") - F.col("a_pos"), F.col("b_n") - F.col("b_pos"))
    positions = left * (100 + least) >= least * (F.col("a_n") + F.col("b_n"))
    pairs = settled(a.join(b, ["part", "sig"]).filter(shorter & lengths & positions).select("a", "b").distinct())
    spots = sets.select("set", "spots")
    both = pairs.join(spots.select(F.col("set").alias("a"), F.col("spots").alias("a_spots")), "a").join(
        spots.select(F.col("set").alias("b"), F.col("spots").alias("b_spots")), "b"
    )

    @F.pandas_udf("double")
    def near(x: pd.Series, y: pd.Series) -> pd.Series:
        parsed = ((np.frombuffer(s, dtype="<u4"), np.frombuffer(t, dtype="<u4")) for s, t in zip(x, y, strict=True))
        return pd.Series([likeness(s, t, least / 100) for s, t in parsed], dtype="float64")

    compared = both.select("a", "b", near("a_spots", "b_spots").alias("near"))
    return found.select("doc_id", "set", "n"), compared.filter(F.col("near") >= least / 100)
