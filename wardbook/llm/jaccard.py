"""Exact Jaccard join of word 5-gram sets, down to connected components.

Index lists are skipped by position. The range of shingle hashes is cut into
blocks of positions, as many as two sets of a size class can differ in and
some more, so two linked sets hold the same shingles in some block. There is
one list per block content instead of one per shingle: a set looks at no list
of another block, another content or another size class. Frequent shingles
make no long lists, as their lists also tell what stands beside them.

Answers are derived. In every list the first set leads. A set is compared
with the leader that it meets most often, and what links to one leader
belongs together without further comparison. The rest, sets of one list that
are still apart, is compared pair by pair, if bounds from sizes, parity
sketches and the answers to the leaders leave a link possible; a pair that
shares many lists is made in the first of them.
"""

from __future__ import annotations

import struct
from functools import partial
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import lean, packed, settled, unpacked

SHINGLE = 5
LEAST = 80  # per cent
# Lists above this length hold only sets that could miss each other in every shorter one.
LONG = 64
SKETCH = 16  # words of 64 bits
# So many names of a set's lists, the smallest, tell in which list it meets another set first.
LOW = 16
ID_BITS = 64
# Bits at most, 8 MB, of the bitmap that tells which texts are read again.
MOST_BITS = 1 << 26

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    """Hash of each word once."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: str | None, words: _Words) -> np.ndarray:
    """Sorted distinct hashes of the 5-word shingles; a shorter text is one shingle, an empty one has none."""
    found = (text or "").encode().lower().split()  # on bytes both know ASCII only
    if len(found) < SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(found), seed=SHINGLE)] if found else [], dtype=np.uint64)
    hashes = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    n = len(found) - SHINGLE + 1
    x = hashes[:n]
    for i in range(1, SHINGLE):
        x = _mixed(x) + hashes[i : n + i]
    return np.unique(_mixed(x))


def size_classes(largest: int) -> list[tuple[int, int]]:
    """Lowest and highest size of each class; linked sets are in one class or in neighbouring ones."""
    out, low = [], 1
    while not out or out[-1][1] < largest:
        high = max(low, low * 100 // LEAST)
        out.append((low, high))
        low = high + 1
    return out


def blocks_of(high: int) -> tuple[int, int]:
    """Number of blocks of a class, and how many of them any two linked sets have equal."""
    differ = 2 * high * (100 - LEAST) // (100 + LEAST)
    equal = high // 32 + 5
    return differ + equal, equal


def index_entries(tokens: np.ndarray, number: int, high: int) -> tuple[np.ndarray, int]:
    """The list names of a set within one class, and how many of them it shares at least with any linked set.

    Empty blocks make no entries while the equal blocks outnumber them;
    beyond that they count like any other content. A partner may have fewer
    empty ones and list none, so all but one of the equal blocks can be empty
    and unlisted there.
    """
    blocks, equal = blocks_of(high)
    block = ((tokens >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    starts = np.flatnonzero(np.diff(block, prepend=np.uint64(blocks)))
    content = np.add.reduceat(_mixed(tokens + np.uint64(number)), starts)
    at = block[starts]
    empty = blocks - len(at)
    if empty >= equal:
        gaps = np.setdiff1d(np.arange(blocks, dtype=np.uint64), at)
        at, content = np.concatenate([at, gaps]), np.concatenate([content, np.zeros(len(gaps), np.uint64)])
        empty = equal - 1
    names = _mixed(content + _mixed(at * np.uint64(1 << 20) + np.uint64(number)))
    return names, equal - empty


def set_id(tokens: np.ndarray, bits: int = ID_BITS) -> int:
    return int(np.frombuffer(xxhash.xxh3_64_digest(tokens.tobytes()), dtype=np.int64)[0]) >> (64 - bits)


def sketch(tokens: np.ndarray) -> np.ndarray:
    """Parities of the shingles in each of some buckets: one more or less shingle changes one bit."""
    counts = np.bincount((tokens & np.uint64(64 * SKETCH - 1)).astype(np.int64), minlength=64 * SKETCH)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def wide_sketch(tokens: np.ndarray) -> bytes | None:
    """Parities in as many buckets as a large set has shingles; null for sets that the short sketch tells apart."""
    if len(tokens) <= 64 * SKETCH:
        return None
    buckets = 1 << (len(tokens) - 1).bit_length()
    counts = np.bincount((tokens & np.uint64(buckets - 1)).astype(np.int64), minlength=buckets)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def wide_difference(a: bytes | None, b: bytes | None) -> int:
    """The least number of shingles in which two sets differ, by their wide sketches."""
    if a is None or b is None:
        return 0
    x, y = sorted((np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)), key=len)
    folded = np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)
    return int(np.bitwise_count(x ^ folded).sum())


_SETS = pa.schema(
    [
        ("doc_id", pa.int64()), ("place", pa.int64()), ("id", pa.int64()), ("check", pa.binary()), ("n", pa.int64()),
        ("sketch", pa.list_(pa.int64())), ("wide", pa.binary()),
    ]
)
_SETS_SQL = (
    "doc_id long, place long, id long, check binary, n long, sketch array<long>, wide binary"
)


class _Classes:
    def __init__(self):
        self.classes = size_classes(1)

    def of(self, n: int) -> list[tuple[int, int]]:
        """Number and highest size of the set's class, and of the next if it can be a smaller partner there."""
        if n > self.classes[-1][1]:
            self.classes = size_classes(2 * n)
        if n * 100 // LEAST >= self.classes[-1][1]:
            self.classes = size_classes(3 * n)
        i = next(k for k, (_, high) in enumerate(self.classes) if n <= high)
        low, high = self.classes[i + 1]
        return [(i, self.classes[i][1]), *([(i + 1, high)] if 100 * n >= LEAST * low else [])]


def _pieces(batch, columns, step=256):
    for at in range(0, batch.num_rows, step):
        some = batch.slice(at, step)
        yield from zip(*(some[c].to_pylist() for c in columns), strict=True)


def _record(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_ENTRIES = pa.schema([("name", pa.int64()), ("id", pa.int64()), ("role", pa.int32()), ("about", pa.binary())])
_ABOUT = struct.Struct(f"<?qq16sq{8 * SKETCH}s")


def _entries(bits, batches):
    """Index entries of each set, and a row about each document; copies met again by one task make no more entries."""
    words, classes, seen = _Words(), _Classes(), set()
    for batch in batches:
        names, ids, roles, about = [], [], [], []
        for doc_id, place, text in _pieces(batch, ("doc_id", "place", "text")):
            tokens = shingles(text, words)
            own = set_id(tokens, bits)
            if len(tokens):
                found = [index_entries(tokens, *c) for c in classes.of(len(tokens))]
                if own not in seen:
                    if len(seen) > 500_000:
                        seen.clear()
                    seen.add(own)
                    # The role in the class, and how many entries the set shares with any partner there.
                    for role, (entries, need) in enumerate(found):
                        names.append(entries)
                        ids.append(np.full(len(entries), own, dtype=np.int64))
                        roles.append(np.full(len(entries), 2 * need + role, dtype=np.int32))
            check = xxhash.xxh3_128_digest(tokens.tobytes())
            head = (doc_id is None, doc_id or 0, place, check, len(tokens), sketch(tokens).tobytes())
            about.append((place, own, 0, _ABOUT.pack(*head) + (wide_sketch(tokens) or b"")))
        yield _record(about, _ENTRIES)
        if names:
            parts = (np.concatenate(names).view(np.int64), np.concatenate(ids), np.concatenate(roles))
            whole = pa.RecordBatch.from_arrays([*map(pa.array, parts), pa.nulls(len(parts[0]), pa.binary())], schema=_ENTRIES)
            for at in range(0, whole.num_rows, 50_000):
                yield whole.slice(at, 50_000)


def _members(batches):
    """The rows about documents as columns."""
    for batch in batches:
        rows = []
        for own, about in _pieces(batch, ("id", "about")):
            none, doc_id, place, check, n, bits = _ABOUT.unpack_from(about)
            wide = about[_ABOUT.size :] or None
            rows.append((None if none else doc_id, place, own, check, n, np.frombuffer(bits, np.int64).tolist(), wide))
        yield _record(rows, _SETS)


_LISTS = pa.schema(
    [("name", pa.int64()), ("leader", pa.int64()), ("id", pa.int64()), ("role", pa.int32()), ("about", pa.binary())]
)


def _lists(batches):
    """Of entries sorted by list and id, those in lists of two sets or more, with the list's first id.

    Rows about documents pass as they are.
    """
    name = leader = last = None  # of the list that the last batch ended in
    single = None  # its only entry, if it has one
    for batch in batches:
        told = batch["about"].is_valid()
        about = batch.filter(told)
        if about.num_rows:
            columns = (about["name"], about["id"], about["id"], about["role"], about["about"])
            yield pa.RecordBatch.from_arrays(list(columns), schema=_LISTS)
        batch = batch.filter(pc.invert(told))
        names, ids, roles = (batch[c].to_numpy() for c in ("name", "id", "role"))
        again = np.zeros(len(names), dtype=bool)
        again[1:] = (names[1:] == names[:-1]) & (ids[1:] == ids[:-1])
        if name is not None and len(names):
            again[0] = names[0] == name and ids[0] == last
        names, ids, roles = names[~again], ids[~again], roles[~again]
        if not len(names):
            continue
        first = np.ones(len(names), dtype=bool)
        first[1:] = names[1:] != names[:-1]
        joins = name is not None and names[0] == name
        start = np.maximum.accumulate(np.where(first, np.arange(len(names)), 0))
        leaders = ids[start]
        shared = ~first
        shared[:-1] |= ~first[1:]
        if joins:
            leaders = np.where(start == 0, leader, leaders)
            shared |= start == 0
        out = (names, leaders, ids, roles)
        parts = [x[shared] for x in out]
        if joins and single is not None:
            parts = [np.concatenate([[a], x]).astype(x.dtype) for a, x in zip(single, parts, strict=True)]
        single = None if shared[-1] else tuple(x[-1] for x in out)
        name, leader, last = names[-1], leaders[-1], ids[-1]
        if len(parts[0]):
            columns = [pa.array(p, f.type) for p, f in zip(parts, _LISTS, strict=False)]
            yield pa.RecordBatch.from_arrays([*columns, pa.nulls(len(parts[0]), pa.binary())], schema=_LISTS)


def _possible() -> Column:
    """Can a and b be linked? Their difference is no smaller than that of sizes and of sketches."""
    differ = F.lit(0)
    for i in range(SKETCH):
        differ = differ + F.bit_count(F.get("a_sketch", F.lit(i)).bitwiseXOR(F.get("b_sketch", F.lit(i))))
    differ = F.greatest(differ.cast("long"), F.abs(F.col("a_n") - F.col("b_n")))
    return differ * (100 + LEAST) <= (F.col("a_n") + F.col("b_n")) * (100 - LEAST)


def _meet_first() -> Column:
    """Is this list the first, by name, that a and b share? Unless neither's lowest names tell: then in every list.

    A name that both sets have among their lowest is shared, and so is
    nothing below it but what is among the lowest of both, too.
    """
    return F.coalesce(F.array_min(F.array_intersect("a_low", "b_low")), F.col("name")) == F.col("name")


def _linked(overlap) -> Column:
    return 100 * overlap >= LEAST * (F.col("a_n") + F.col("b_n") - overlap)


def _side(sets: DataFrame, name: str) -> DataFrame:
    return sets.select(F.col("id").alias(name), F.col("n").alias(f"{name}_n"), F.col("sketch").alias(f"{name}_sketch"))


def _maybe(texts: DataFrame, first: DataFrame) -> DataFrame:
    """The texts with a ``place`` that is in ``first``, and some others that meet one in a bitmap of the places.

    While there are no more than ``MOST_BITS`` / 64 places, two in a hundred others pass.
    """
    bits = min(MOST_BITS, max(1 << 15, 1 << (64 * first.count()).bit_length()))
    spot = F.col("place").bitwiseAND(F.lit(bits - 1))
    marks = first.groupBy(F.bitmap_bucket_number(spot).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(spot)).alias("_marks")
    )
    at = F.bitmap_bit_position(spot).cast("int")
    byte = F.conv(F.hex(F.substring("_marks", F.shiftright(at, 3) + 1, F.lit(1))), 16, 10).cast("int")
    marked = F.getbit(byte, at.bitwiseAND(F.lit(7))) == 1
    near = texts.join(F.broadcast(marks), (F.bitmap_bucket_number(spot) == F.col("_bucket")) & marked)
    return near.drop("_bucket", "_marks")


def _tokens(docs: DataFrame, sets: DataFrame, wanted: DataFrame) -> DataFrame:
    """The shingles of the wanted sets, made again from the first document of each.

    Which documents these are is read from files, so Spark knows its size.
    Where they are too many to be broadcast, only texts that a bitmap lets
    pass are shuffled.
    """
    first = settled(wanted.join(sets, "id").select("first.doc_id", "first.place", "id"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("place", F.xxhash64("text"))
    found = _maybe(texts, first).join(
        first.select(F.col("doc_id").alias("_doc_id"), F.col("place").alias("_place"), "id"),
        F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("place") == F.col("_place")),
    )

    def made(batches):
        words = _Words()
        schema = pa.schema([("id", pa.int64()), ("tokens", pa.binary())])
        for batch in batches:
            rows = []
            for own, text in _pieces(batch, ("id", "text")):
                rows.append((own, shingles(text, words).tobytes()))
                if len(rows) >= 500:
                    yield _record(rows, schema)
                    rows = []
            yield _record(rows, schema)

    return settled(found.select("id", "text").mapInArrow(lean(made), "id long, tokens binary").dropDuplicates(["id"]))


def _overlap(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(
        [len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True)) for x, y in zip(a, b, strict=True)],
        dtype="int64",
    )


def _wide_differences(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([wide_difference(x, y) for x, y in zip(a, b, strict=True)], dtype="int64")


def _compared(docs: DataFrame, sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """Add the exact overlap to pairs; those that the wide sketches rule out are dropped."""
    wide = sets.filter("wide is not null")
    apart = F.pandas_udf(_wide_differences, "long")("a_wide", "b_wide")
    pairs = settled(
        pairs.join(wide.select(F.col("id").alias("a"), F.col("wide").alias("a_wide")), "a", "left")
        .join(wide.select(F.col("id").alias("b"), F.col("wide").alias("b_wide")), "b", "left")
        .withColumn("apart", apart)
        .filter(F.col("apart") * (100 + LEAST) <= (F.col("a_n") + F.col("b_n")) * (100 - LEAST))
        .drop("a_wide", "b_wide", "apart")
    )
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    tokens = _tokens(docs, sets, wanted)
    both = pairs.join(tokens.select(F.col("id").alias("a"), F.col("tokens").alias("a_tokens")), "a").join(
        tokens.select(F.col("id").alias("b"), F.col("tokens").alias("b_tokens")), "b"
    )
    return both.withColumn("overlap", F.pandas_udf(_overlap, "long")("a_tokens", "b_tokens")).drop("a_tokens", "b_tokens")


def _stars(edges: DataFrame) -> bool:
    """Does each u of the edges (u, v), v < u, have one edge, to a v that is no u itself? Then v is the smallest it reaches."""
    up, down = F.struct(F.col("u").alias("id"), F.lit(1).alias("ups")), F.struct(F.col("v").alias("id"), F.lit(0).alias("ups"))
    ends = edges.select(F.explode(F.array(up, down)).alias("e")).select("e.id", "e.ups")
    ends = ends.groupBy("id").agg(F.sum("ups").alias("ups"), F.count("*").alias("n"))
    return ends.agg(F.count_if(F.expr("ups > 1 or ups = 1 and n > 1"))).first()[0] == 0


def components(links: DataFrame) -> DataFrame:
    """Smallest id reachable from each id of the links (a, b), by large-star and small-star rounds."""
    edges = settled(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct())
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u != v").distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = settled(small.select("e.u", "e.v").filter("u != v").distinct())
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return rows.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))


def _sets(members: DataFrame) -> DataFrame:
    """One row per id, with its first document and the lowest and highest check of the sets that have it."""
    return settled(
        members.filter("n > 0")
        .groupBy("id")
        .agg(
            F.min(F.struct("doc_id", "place")).alias("first"), F.min("doc_id").alias("lowest"),
            F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("wide").alias("wide"),
            F.min("check").alias("low"), F.max("check").alias("high"),
        )
    )


def _told_apart(members: DataFrame, sets: DataFrame, twice: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Members and sets with an id of its own for each set of the ids ``twice``, and these new ids."""
    shared = twice.withColumn("shared", F.lit(True))
    for salt in count():
        new = F.when(F.col("shared"), F.xxhash64(F.lit(salt), "check")).otherwise(F.col("id"))
        renamed = settled(members.join(shared, "id", "left").withColumn("id", new))
        told = _sets(renamed)
        if told.filter("low != high").isEmpty():
            alone = settled(renamed.filter("shared and n > 0").select("id").distinct())
            return renamed.select(members.columns), told, alone


def _size_class() -> Column:
    """Linked sets are at most two of these classes apart, whatever way the logarithm is rounded."""
    return F.floor(F.log("n") / F.log(F.lit(100 / LEAST))).cast("int")


def _against_all(some: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of the sets ``some`` with any set that could be linked to them, by sizes and sketches alone."""
    near = F.explode(F.transform(F.array(*[F.lit(i) for i in range(-2, 3)]), lambda i: F.col("class") + i))
    classed = sets.withColumn("class", _size_class())
    shape = ("id", "n", "sketch")
    a = settled(classed.join(some, "id", "left_semi").select(near.alias("class"), *[F.col(c).alias(f"a_{c}") for c in shape]))
    b = classed.select("class", *[F.col(c).alias(f"b_{c}") for c in shape])
    both = a.join(b, "class").withColumnsRenamed({"a_id": "a", "b_id": "b"})
    return both.filter(F.col("a") != F.col("b")).filter(_possible()).select("a", "b", "a_n", "b_n")


def _main_parts(members: DataFrame) -> DataFrame:
    """Lists whose members, rows (name, id, component), are in two components or more, with the largest of these as ``main``.

    Of lists with the same members, told by 128 bits and their number, the one
    with the lowest name is kept: the others make the same pairs. Two sets
    that are alike in many blocks share many such lists.
    """
    parts = members.groupBy("name", "component").agg(
        F.count("*").alias("k"),
        F.bit_xor(F.xxhash64("id")).alias("x"),
        F.bit_xor(F.xxhash64(F.lit(1), "id")).alias("y"),
    )
    lists = parts.groupBy("name").agg(
        F.max_by("component", F.struct("k", "component")).alias("main"), F.count("*").alias("parts"),
        F.sum("k").alias("length"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"),
    ).filter("parts > 1")
    first = lists.groupBy("x", "y", "length").agg(F.min(F.struct("name", "main")).alias("first"))
    return first.select("first.name", "first.main")


def link_sets(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Every document with the id of its set, every set, and the component of each set that is linked to others.

    Ids have 64 bits. Sets that have one id by chance, told by a digest of 128
    bits, get ids of their own, leave the lists, where one can't be told from
    the other, and are compared with all sets of their size: of n sets these
    are about n * n / 2 ** 64.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("place"), "text")
    entries = texts.mapInArrow(lean(partial(_entries, ID_BITS)), "name long, id long, role int, about binary")
    found = entries.repartition("name").sortWithinPartitions("name", "id").mapInArrow(
        lean(_lists), "name long, leader long, id long, role int, about binary"
    )
    found = settled(found)
    members = settled(found.filter("about is not null").select("id", "about").mapInArrow(lean(_members), _SETS_SQL))
    lists = found.filter("about is null").drop("about")
    sets, alone = _sets(members), None
    if not sets.filter("low != high").isEmpty():
        twice = settled(sets.filter("low != high").select("id"))
        members, sets, alone = _told_apart(members, sets, twice)
        lists = lists.join(twice, "id", "left_anti").drop("leader")
        lists = settled(lists.join(lists.groupBy("name").agg(F.min("id").alias("leader")), "name"))
    # Each set against the leader that it meets most often.
    met = lists.filter("id != leader").groupBy("id", "leader").agg(F.count("*").alias("times"))
    best = met.groupBy(F.col("id").alias("b")).agg(F.max_by("leader", F.struct("times", "leader")).alias("a"))
    candidates = best.join(_side(sets, "a"), "a").join(_side(sets, "b"), "b").filter(_possible())
    answers = settled(_compared(docs, sets, candidates.select("a", "b", "a_n", "b_n")))
    links = answers.filter(_linked(F.col("overlap"))).select("a", "b")
    labels = components(links)

    # What is still apart within a list.
    sizes = lists.groupBy("name").agg(F.count("*").alias("length"))
    sized = settled(_labelled(lists.join(sizes, "name").select("name", "id", "role", "length"), labels))
    # A set that has fewer entries in long lists than it shares with any partner meets that one in a short list too.
    times = F.count("*").over(Window.partitionBy("id", "role"))
    long_ = sized.filter(F.col("length") > LONG).withColumn("times", times).filter("times >= role div 2")
    open_ = sized.filter(F.col("length") <= LONG).unionByName(long_.drop("times"))
    largest = _main_parts(open_)
    own = Window.partitionBy("id")
    low = F.when(F.row_number().over(own.orderBy("name")) <= LOW, F.col("name"))
    rows = open_.join(largest, "name").withColumn("low", low).withColumn("low", F.collect_list("low").over(own))
    apart = settled(rows.join(sets.select("id", "n", "sketch"), "id"))
    columns = ["id", "component", "n", "sketch", "low"]
    a = apart.filter("component != main").select("name", *[F.col(c).alias(f"a_{c}") for c in columns])
    b = apart.select("name", "main", *[F.col(c).alias(f"b_{c}") for c in columns])
    new = F.col("a_component") != F.col("b_component")
    once = (F.col("b_component") == F.col("main")) | (F.col("a_id") < F.col("b_id"))
    pairs = a.join(b, "name").filter(new & once & _possible() & _meet_first())
    pairs = pairs.select(F.col("a_id").alias("a"), F.col("b_id").alias("b"), "a_n", "b_n")
    if alone is not None:
        pairs = pairs.unionByName(_against_all(alone, sets))
    pairs = pairs.distinct()
    more = _compared(docs, sets, _derived(pairs, answers))
    links = links.unionByName(more.filter(_linked(F.col("overlap"))).select("a", "b"))
    return members, sets, components(settled(links))


def _derived(pairs: DataFrame, answers: DataFrame) -> DataFrame:
    """Leave out pairs that the answers to a common leader rule out.

    Of the shingles that a and b share, those in the leader are at most as
    many as either shares with it, the others at most as many as either has
    outside it.
    """
    known = answers.select(F.col("b").alias("id"), F.col("a").alias("leader"), "overlap")
    a = known.select(F.col("id").alias("a"), F.col("leader").alias("a_leader"), F.col("overlap").alias("a_o"))
    b = known.select(F.col("id").alias("b"), F.col("leader").alias("b_leader"), F.col("overlap").alias("b_o"))
    both = pairs.join(a, "a", "left").join(b, "b", "left")
    most = F.least("a_o", "b_o") + F.least(F.col("a_n") - F.col("a_o"), F.col("b_n") - F.col("b_o"))
    ruled_out = (F.col("a_leader") == F.col("b_leader")) & ~_linked(most)
    return both.filter(~F.coalesce(ruled_out, F.lit(False))).select("a", "b", "a_n", "b_n")


def join_documents(docs: DataFrame) -> DataFrame:
    """One row per document: size of its shingle set and the smallest doc_id that links lead to.

    Links are pairs with 100 * intersection >= 80 * union. Equal sets are one
    set, however many documents hold it. Documents without words have an
    empty set and are linked with nothing. A null doc_id is never the smallest
    unless there is no other; rows with equal ids are documents of their own.
    An empty table gives no rows. Only doc_id and text are read.
    """
    members, sets, labels = link_sets(docs)
    # Components are named set by set: one may hold a large share of all documents, as copies of a few sets.
    rows = _labelled(sets.select("id", "lowest"), labels)
    smallest = rows.groupBy("component").agg(F.min("lowest").alias("component_id"))
    names = rows.join(smallest, "component").select("id", "component_id")
    named = members.filter("n > 0").join(names, "id").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    empty = members.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return named.unionByName(empty)


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest id; documents without words stay.

    Columns may have any names; all but doc_id and text are passed on as they
    are. An empty table gives no rows. Of several rows with that id one stays, the one whose text has the lowest
    hash; if no row of a component has an id, the one with the lowest hash.
    Of equal rows one stays.
    """
    members, _, labels = link_sets(docs)
    rows = _labelled(members.filter("n > 0").select("doc_id", "place", "id"), labels)
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), F.col("place").alias("place"))
    kept = rows.groupBy("component").agg(F.min(order).alias("o")).select("o")
    times = members.groupBy("doc_id", "place").agg(F.count("*").alias("times"), F.max("n").alias("n"))
    same = F.col("o.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("o.place") == F.col("place"))
    stay = settled(
        times.filter("n = 0").unionByName(times.join(kept, same, "left_semi")).select(
            F.col("doc_id").alias("_doc_id"), F.col("place").alias("_place"), "n", "times"
        ).withColumn("_again", F.expr("n > 0 and times > 1")).drop("n", "times")
    )
    placed = packed(docs).withColumn("_text_place", F.xxhash64("_docs.text"))
    same = F.col("_docs.doc_id").cast("long").eqNullSafe(F.col("_doc_id")) & (F.col("_text_place") == F.col("_place"))
    left = placed.join(stay, same)
    once = left.filter("not _again").unionByName(left.filter("_again").dropDuplicates(["_doc_id", "_place"]))
    return unpacked(once, docs.columns)
