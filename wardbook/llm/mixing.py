"""Mixing sources to target weights by packed blocks.

1. Documents of a source stand in a fixed pseudorandom order; their words,
   end to end, are cut into blocks of ``BLOCK`` words.
2. The mix is a row of slots in output shards of about ``SLOTS`` each. How many
   slots of a source lie in each shard is a multinomial draw over the shards of
   all that the source has to give. It is drawn down a binary tree of the shards,
   one binomial count per node, so the shards' counts add up exactly, a node is
   drawn again alike wherever it is needed, and a shard's share of a source
   starts where the shards before it end.
3. The j-th slot of a source takes block ``permutation(j)``: a pass over all
   blocks in pseudorandom order, then a second one in another order.
4. Blocks and slots meet by block number.

Sources and their targets are a table; only sums over all sources reach the
driver, so there may be as many as there are documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .common import lean, packed, settled, unpacked

BLOCK = 128
SLOTS = 16_384
# Slots of a node that are dealt to its shards one by one instead of by halves.
FEW = 64
_WORDS_PER_BUCKET = 200_000
_BUCKETS_PER_STEP = 4_096
_SLOTS_PER_TASK = 500_000
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_NODE = "number long, blocks long, low long, high long, n long, first long"


def numbered(sums: DataFrame) -> DataFrame:
    """The sources with ``number``, counted from 0 by code point, null last.

    They are sorted in ranges; each range is counted on from the ones before it.
    """
    placed = settled(sums.orderBy(F.col("source").asc_nulls_last()).withColumn("at", F.monotonically_increasing_id()))
    placed = placed.withColumn("part", F.shiftright("at", 33))
    # One row per range of the sort, that is per partition.
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("start"))
    within = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(starts, "part").withColumn("number", F.col("start") + within).drop("at", "part", "start")


def source_targets(sums: DataFrame, weights=(3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``number``, ``source``, ``source_size`` and ``target``, the words wanted of each source.

    ``sums`` has a row per ``source`` with its ``source_size``. All words times
    ``share`` go to the sources by weight, none above ``most`` times its own.
    Sources take the weights in turn, by code point, null last. What one cannot
    take goes to the others by weight, until none is above its limit: each round
    sums the sizes of the full sources and the weights of the others.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    turn = F.array(*[F.lit(float(w)) for w in weights])
    known = settled(numbered(sums).withColumn("weight", F.get(turn, F.pmod("number", F.lit(len(weights))).cast("int"))))
    limit = F.col("source_size") * float(most)
    unit, before = 0.0, -1.0
    while unit > before:
        full = limit < F.lit(unit) * F.col("weight")
        sizes, held, free = known.agg(
            F.sum("source_size"), F.sum(F.when(full, F.col("source_size"))), F.sum(F.when(~full, F.col("weight")))
        ).first()
        before, unit = unit, (share * (sizes or 0) - most * (held or 0)) / free if free else float("inf")
    wanted = F.least(F.lit(unit) * F.col("weight"), limit)
    return known.select("number", "source", "source_size", wanted.alias("target"))


def _mix64(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def permutation(index: np.ndarray, n, key) -> np.ndarray:
    """Pseudorandom permutation of 0..n-1, computed entry by entry; ``n`` and ``key`` may differ by entry.

    Four Feistel rounds permute the next power of four; an image outside the
    range goes through again until it falls inside.
    """
    x = index.astype(np.uint64)
    n, key = (np.broadcast_to(np.asarray(v, dtype=np.uint64), x.shape) for v in (n, key))
    bits = np.frexp((n - np.uint64(1)).astype(np.float64))[1]
    shift = np.maximum(1, (bits + 1) // 2).astype(np.uint64)
    low = (np.uint64(1) << shift) - np.uint64(1)
    todo = np.arange(len(x))
    while len(todo):
        left, right = x[todo] >> shift[todo], x[todo] & low[todo]
        with np.errstate(over="ignore"):
            salt = key[todo] * np.uint64(0x9E3779B97F4A7C15)
            for _ in range(4):
                left, right = right, left ^ (_mix64(right ^ salt) & low[todo])
                salt = salt + np.uint64(0xD1342543DE82EF95)
        x[todo] = (left << shift[todo]) | right
        todo = todo[x[todo] >= n[todo]]
    return x.astype(np.int64)


def halves(nodes: Iterable[tuple], few: int, seed: int) -> Iterator[tuple]:
    """Draw a source's slots down the tree of shards, to single shards or nodes of ``few`` slots at most.

    A node (number, blocks, low, high, n, first) has ``n`` slots of source
    ``number``, from its ``first`` on, in the shards from ``low`` up to ``high``.
    Each slot lies in any of them with equal chance, so the left half has a
    binomial share, seeded by the node itself.
    """
    stack = list(nodes)
    while stack:
        number, blocks, low, high, n, first = stack.pop()
        if not n:
            continue
        if high - low == 1 or n <= few:
            yield number, blocks, low, high, n, first
            continue
        middle = (low + high) // 2
        left = int(np.random.default_rng([seed, number, low, high]).binomial(n, (middle - low) / (high - low)))
        stack.append((number, blocks, middle, high, n - left, first + left))
        stack.append((number, blocks, low, middle, left, first))


def dealt(nodes: list[tuple], seed: int) -> pd.DataFrame:
    """The slots of nodes with their shard and block. The slots of a node go to its shards one by one, in the order of shards."""
    number, blocks, low, high, n, first = np.array(nodes, dtype=np.int64).reshape(-1, 6).T
    node = np.repeat(np.arange(len(n)), n)
    within = np.arange(len(node)) - np.repeat(np.cumsum(n) - n, n)
    j, own = first[node] + within, number[node]
    with np.errstate(over="ignore"):
        source = _mix64(own.astype(np.uint64) + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15))
        chance = (_mix64(source ^ _mix64(j.astype(np.uint64))) >> np.uint64(11)).astype(np.float64) / (1 << 53)
    shard = low[node] + (chance * (high - low)[node]).astype(np.int64)
    shard = shard[np.lexsort((shard, node))]
    turn, at = np.divmod(j, blocks[node])
    with np.errstate(over="ignore"):
        key = source + turn.astype(np.uint64)
    return pd.DataFrame({"shard": shard, "number": own, "block": permutation(at, blocks[node], key)})


def slots_of(plan: DataFrame, shards: int, total: int, seed: int) -> DataFrame:
    """Every slot of the mix: ``shard``, ``number`` of the source, ``block``.

    ``plan`` has ``number``, ``blocks`` and ``n_slots`` of each source. A source
    may hold any share of the slots: its tree is cut into nodes of a bounded
    number of slots, which are dealt out over the tasks before they are drawn
    further.
    """

    def tops(frames):
        for frame in frames:
            held = []
            for node in halves(frame.astype("int64").itertuples(index=False, name=None), _SLOTS_PER_TASK, seed):
                held.append(node)
                if len(held) == 10_000:
                    yield pd.DataFrame(np.array(held, dtype=np.int64), columns=frame.columns)
                    held = []
            if held:
                yield pd.DataFrame(np.array(held, dtype=np.int64), columns=frame.columns)

    def filled(frames):
        held, size = [], 0
        for frame in frames:
            for node in halves(frame.itertuples(index=False, name=None), FEW, seed):
                held.append(node)
                size += node[4]
                if size >= _SLOTS_PER_TASK:
                    yield dealt(held, seed)
                    held, size = [], 0
        if held:
            yield dealt(held, seed)

    roots = plan.filter("n_slots > 0").select(
        "number", "blocks", F.lit(0).cast("long").alias("low"), F.lit(shards).cast("long").alias("high"),
        F.col("n_slots").alias("n"), F.lit(0).cast("long").alias("first"),
    )
    nodes = roots.mapInPandas(lean(tops), _NODE).repartition(max(1, total // _SLOTS_PER_TASK), "number", "low")
    return nodes.mapInPandas(lean(filled), "shard long, number long, block long")


def _words(docs: DataFrame, row) -> DataFrame:
    @F.pandas_udf("long")
    def size(texts: pd.Series) -> pd.Series:
        return pd.Series([0 if t is None else len(t.encode().split()) for t in texts], dtype="int64")

    return docs.select(
        "doc_id", "source", size("text").alias("size"),
        F.xxhash64(F.lit(20), "doc_id", "text").alias("place"),
        (F.monotonically_increasing_id() if row is None else row).alias("row"),
    )


def _starts(sums: DataFrame) -> DataFrame:
    """Words of a source in the buckets before each one, summed in two levels, so that no task holds all buckets of a source."""
    step = F.expr(f"bucket div {_BUCKETS_PER_STEP}")
    sums = sums.withColumn("step", step)
    ahead = Window.partitionBy("number").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    steps = sums.groupBy("number", "step").agg(F.sum("n").alias("n"))
    steps = steps.select("number", "step", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    inside = Window.partitionBy("number", "step").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    own = sums.withColumn("inner", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return own.join(steps, ["number", "step"]).select("number", "bucket", (F.col("base") + F.col("inner")).alias("offset"))


def _pieces(known: DataFrame, total: int, block: int) -> DataFrame:
    """The words of each document by block: ``start`` is its first word there, ``words`` their number.

    A source may hold any share of the words: it is cut by ``place`` into
    buckets, whose sizes give where each bucket's words start.
    """
    buckets = max(64, total // _WORDS_PER_BUCKET)
    cut = known.filter("size > 0").select("row", "doc_id", "place", "size", "number", F.pmod("place", F.lit(buckets)).alias("bucket"))
    offsets = _starts(cut.groupBy("number", "bucket").agg(F.sum("size").alias("n")))
    within = Window.partitionBy("number", "bucket").orderBy("place", "doc_id", "row").rowsBetween(Window.unboundedPreceding, -1)
    placed = cut.withColumn("ahead", F.coalesce(F.sum("size").over(within), F.lit(0))).join(offsets, ["number", "bucket"])
    first = F.col("offset") + F.col("ahead")
    span = placed.select("row", "number", first.alias("first"), (first + F.col("size")).alias("end"))
    blocks = F.expr(f"sequence(first div {block}, (end - 1) div {block})")
    each = span.select("row", "number", "first", "end", F.explode(blocks).alias("block"))
    low, high = F.greatest("first", F.col("block") * block), F.least("end", (F.col("block") + 1) * block)
    return each.select("row", "number", "block", (low - F.col("first")).alias("start"), (high - low).alias("words"))


def mix(docs: DataFrame, weights=(3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0, block: int = BLOCK, slots: int = SLOTS, seed: int = 20, row=None) -> tuple[DataFrame, DataFrame]:
    """The documents by row with size and target, and their pieces with the times that the mix takes each.

    Sources are compared by code point, a null one is a source of its own. A
    null or wordless text has size 0 and is never taken. Repeated rows are
    documents of their own. Only doc_id, source and text are read. ``row`` may
    name a column that numbers the rows.
    """
    if int(most) != most:
        raise ValueError("a source is passed over a whole number of times")
    rows = settled(_words(docs, row))
    sources = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    # A source's last block may be short, so a slot of it brings size / blocks words on average.
    blocks = F.expr(f"(source_size + {block - 1}) div {block}")
    slots_wanted = F.floor(F.col("target") * F.col("blocks") / F.col("source_size") + 0.5)
    plan = settled(
        sources.withColumn("blocks", blocks).withColumn(
            "n_slots", F.when(F.col("source_size") > 0, F.least(slots_wanted, F.col("blocks") * int(most))).otherwise(0).cast("long")
        )
    )
    words, n_slots = (n or 0 for n in plan.agg(F.sum("source_size"), F.sum("n_slots")).first())
    n_shards = max(1, round(n_slots / slots))
    # Written, so that the join sees its true size; it grows with the corpus.
    taken = settled(slots_of(plan, n_shards, n_slots, seed).groupBy("number", "block").agg(F.count("*").alias("times")))
    # No hint: the table of sources is broadcast if it is small, else a hot source is split by the skew join.
    about = plan.select(F.col("source").alias("_source"), "number", "source_size", "target")
    known = rows.join(about, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    chosen = _pieces(known, words, block).join(taken, ["number", "block"]).select("row", "start", "words", "times")
    return known.drop("number"), chosen


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """One row per document with its size, its source's size and target, and the words that the mix takes of it."""
    known, chosen = mix(docs, **settings)
    taken = chosen.groupBy("row").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    return known.join(taken, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


def mixture(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself, in the columns of ``docs``: a row per document and pass with the words taken in that pass.

    Blocks taken twice are in both rows; documents that no block was taken of
    have none. Between two taken stretches of a text stands a line break.
    ``n_chars``, if there is such a column, is that of the new text. Other
    columns, whatever their names, are passed on; null and wordless texts have
    no row, and an empty table gives none.
    """
    numbered = settled(packed(docs).withColumn("_mix_row", F.monotonically_increasing_id()))
    read = numbered.select(*[F.col("_docs").getField(c).alias(c) for c in ("doc_id", "source", "text")], "_mix_row")
    _, chosen = mix(read, row=F.col("_mix_row"), **settings)
    stretches = chosen.groupBy(F.col("row").alias("_mix_row")).agg(
        F.array_sort(F.collect_list(F.struct("start", "words", "times"))).alias("_mix_pieces")
    )

    @F.pandas_udf("array<string>")
    def passes(texts: pd.Series, pieces: pd.Series) -> pd.Series:
        out = []
        for text, own in zip(texts, pieces, strict=True):
            at = [m.span() for m in _WORD.finditer(text)]
            parts = []
            for turn in range(max(p["times"] for p in own)):
                spans: list[list[int]] = []
                for p in own:
                    if p["times"] > turn:
                        if spans and spans[-1][1] == p["start"]:
                            spans[-1][1] += p["words"]
                        else:
                            spans.append([p["start"], p["start"] + p["words"]])
                parts.append("\n".join(text[at[a][0] : at[b - 1][1]] for a, b in spans))
            out.append(parts)
        return pd.Series(out, dtype=object)

    full = numbered.join(stretches, "_mix_row").withColumn("_mix_text", F.explode(passes("_docs.text", "_mix_pieces")))
    return unpacked(full, docs.columns, text=F.col("_mix_text"), n_chars=F.length("_mix_text").cast("long"))
