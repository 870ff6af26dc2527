"""Merkle manifest of a dataset, and a recursive query that climbs it.

Rows are leaves. Every eight consecutive nodes of a level make one node of the
next; each language has a tree of its own, and the roots of these trees make
the last tree. The levels are written one after another, each node as a row
with the number of its parent and the digests beside it.

A recursive query then climbs from the leaves to the root, one level in each
step, and at every level appends the siblings and folds the digest in hand.
The leaves of one run share all their siblings from the second level on, so a
run climbs as one row, with the folded digest of each of its leaves.

Near the root few nodes meet all climbers. A node is therefore stored once for
each block of ``RUNS_PER_BLOCK`` runs below it, and a climber meets the copy of
its own block, so no join key has more than a block's rows. Places in a level
come from one sort by range, so no language, however large, is one task.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import settled

FAN = 8
RUNS_PER_BLOCK = 512
# Lower-case names of trees that are no language; languages have "=" in front.
_NO_LANG = "-"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def framed(value: Column) -> Column:
    """A value so that no two lists of values read alike: its UTF-8 length, a colon and its text, or - for null."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(*parts: Column) -> Column:
    """sha256 of the concatenated parts, in 32 bytes."""
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def _hash(packed: str) -> str:
    """SQL for the digest over concatenated digests, each read as hexadecimal text."""
    return f"unhex(sha2(lower(hex({packed})), 256))"


def _packed(digests: str) -> str:
    """SQL for an array of digests one after another."""
    return f"aggregate({digests}, cast('' as binary), (a, x) -> concat(a, x))"


def _text(c: str | Column) -> Column:
    return F.lower(F.hex(c))


def tampered(text: Column, doc_id: Column) -> Column:
    """The text with A-Z lower-cased where 3 divides crc32 of the id as text; a null id is left alone."""
    hit = F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 0
    return F.when(hit, F.translate(text, _UPPER, _LOWER)).otherwise(text)


def placed(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Add each row's place within its group, from 0, and the group's size as ``n``.

    The rows are sorted by range and written. A row's place is the number of
    its group's rows in the parts before plus its own in the part; only the
    sizes of parts are summed. Rows equal in everything are told apart by
    where they were read, so many of them are no single part.
    """
    keys = [group, *order, "_read"]
    ranged = rows.withColumn("_read", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    ranged = settled(ranged.drop("_read").withColumn("_row", F.monotonically_increasing_id()))
    ranged = ranged.withColumn("_part", F.shiftright("_row", 33))
    parts = ranged.groupBy(group, "_part").agg(F.count("*").alias("_size"), F.min("_row").alias("_first"))
    each = Window.partitionBy(group)
    before = each.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        group, "_part", "_first",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"), F.sum("_size").over(each).alias("n"),
    )
    return (
        ranged.join(parts, [group, "_part"])
        .withColumn("pos", F.col("_before") + F.col("_row") - F.col("_first"))
        .drop("_row", "_part", "_first", "_before")
    )


def _runs(level: DataFrame, *more: str) -> DataFrame:
    """Eight consecutive nodes as one row: tree, n, run, and the nodes in order."""
    return settled(
        level.groupBy("tree", "n", F.expr(f"pos div {FAN}").alias("run")).agg(
            F.array_sort(F.collect_list(F.struct("pos", "digest", *more))).alias("nodes")
        )
    )


def _next_level(runs: DataFrame) -> DataFrame:
    """The nodes above runs of a tree with more than one node in the level."""
    return runs.select(
        "tree",
        F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n"),
        F.col("run").alias("pos"),
        F.expr(_hash(_packed("transform(nodes, x -> x.digest)"))).alias("digest"),
    )


def _linked(runs: DataFrame, height: int) -> DataFrame:
    """A run's nodes as rows: place, parent's place, and the digests before and after within the run."""
    return runs.select("tree", "n", "run", F.posexplode("nodes").alias("at", "node"), "nodes").select(
        "tree",
        F.lit(height).alias("h"),
        F.col("n").alias("level_n"),
        F.col("node.pos").alias("pos"),
        F.col("run").alias("parent"),
        F.expr(_packed("transform(slice(nodes, 1, at), x -> x.digest)")).alias("before"),
        F.expr(_packed("transform(slice(nodes, at + 2, size(nodes)), x -> x.digest)")).alias("after"),
    )


def grow(leaves: DataFrame, most: int, *more: str) -> tuple[DataFrame, list[DataFrame], DataFrame]:
    """Runs of the leaves, nodes of each level as linked rows, and the top node of each tree with its height.

    ``most`` is the size of the largest tree.
    """
    first = _runs(leaves, *more)
    tops = first.filter("n = 1").select("tree", F.lit(0).alias("top"), F.col("nodes")[0]["digest"].alias("digest"))
    linked, runs, height = [_linked(first.filter("n > 1"), 0)], first, 0
    while most > 1:
        most, height = -(-most // FAN), height + 1
        level = _next_level(runs.filter("n > 1"))
        runs = _runs(level)
        tops = tops.union(runs.filter("n = 1").select("tree", F.lit(height), F.col("nodes")[0]["digest"]))
        linked.append(_linked(runs.filter("n > 1"), height))
    return first, linked, tops


@contextmanager
def _whole_recursion(spark: SparkSession) -> Iterator[None]:
    """Let a recursive query return any number of rows."""
    name = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "-1")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


_CLIMB = f"""
WITH RECURSIVE climb(tree, run, block, h, pos, last, folds, siblings) AS (
    SELECT tree, run, block, h, pos, last, folds, siblings FROM {{start}}
    UNION ALL
    SELECT c.tree, c.run, c.block, c.h + 1, n.parent, c.last,
           transform(c.folds, f -> {_hash("concat(n.before, f, n.after)")}),
           concat(c.siblings, n.before, n.after)
    FROM climb c JOIN {{nodes}} n ON n.tree = c.tree AND n.block = c.block AND n.h = c.h AND n.pos = c.pos
    WHERE c.h < c.last
)
SELECT tree, run, folds, siblings FROM climb WHERE h = last
"""


def _climb(spark: SparkSession, start: DataFrame, nodes: DataFrame) -> DataFrame:
    """Every run's siblings from its parent to the root, and each of its leaves' digest folded up to there."""
    names = {n: f"merkle_{n}_{uuid.uuid4().hex}" for n in ("start", "nodes")}
    start.createOrReplaceTempView(names["start"])
    nodes.createOrReplaceTempView(names["nodes"])
    try:
        with _whole_recursion(spark):
            return settled(spark.sql(_CLIMB.format(**names)))
    finally:
        for name in names.values():
            spark.catalog.dropTempView(name)


def _copies(nodes: DataFrame, first: str, last: str) -> DataFrame:
    """A node once for each block below it."""
    return nodes.withColumn("block", F.explode(F.sequence(F.expr(first).cast("long"), F.expr(last).cast("long"))))


def manifest(docs: DataFrame) -> DataFrame:
    """Leaf, subroot of the language, root, and whether the row as found now still leads to the root.

    A leaf digests doc_id, source, lang, n_chars and text, each ``-`` if
    null. Leaves of a language (null is one, and comes first) ascend by
    doc_id, null ids first; rows with equal id ascend by their digests, so
    repeated rows are leaves of their own. ``proof_sha256`` digests the
    siblings from the leaf to the root. ``folded_root`` starts from the row
    as ``tampered`` leaves it. A single row is subroot and root itself; an
    empty table has no root and gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    own = [framed(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")]
    text = F.col("text")
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(_NO_LANG)).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        digest(*own, framed(text)).alias("digest"),
        digest(*own, framed(tampered(text, F.col("doc_id")))).alias("found"),
    )
    # Written first: the sort by range reads its input twice, and texts are to be digested once.
    leaves = settled(placed(settled(leaves), "tree", ["doc_id", "digest"]))
    most = leaves.agg(F.max("n")).first()[0]
    if most is None:
        empty = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
        return spark.createDataFrame([], empty)
    runs, linked, tops = grow(leaves, most, "doc_id", "found")

    # The tree over the languages' roots: its nodes are joined to the trees they stand above.
    ordered = settled(placed(tops.withColumn("all", F.lit("")), "all", ["tree"]))
    roots = ordered.select(F.lit("").alias("tree"), "n", "pos", "digest")
    trees = ordered.count()
    _, above, top = grow(roots, trees)
    height = top.first()["top"]
    sizes = runs.groupBy("tree").agg(F.max("run").alias("last_run"), F.max("n").alias("n"))
    each = ordered.select("tree", F.col("top").alias("tree_top"), "pos").join(sizes.drop("n"), "tree")
    each = settled(each.withColumn("last_block", F.expr(f"last_run div {RUNS_PER_BLOCK}")))

    stored = []
    for h, nodes in enumerate(linked[1:], 1):
        below = FAN ** (h - 1)  # runs under a node
        wide = nodes.join(each.select("tree", "last_run", "last_block"), "tree")
        wide = _copies(
            wide, f"pos * {below} div {RUNS_PER_BLOCK}", f"least(last_block, ((pos + 1) * {below} - 1) div {RUNS_PER_BLOCK})"
        )
        stored.append(wide.select("tree", "block", "h", "pos", "parent", "before", "after"))
    for h, nodes in enumerate(above[:height]):
        # A tree's top node has place 0 in its own numbering.
        under = each.withColumn("place", F.expr(f"pos div {FAN**h}")).drop("pos")
        met = under.join(nodes.drop("tree", "h"), F.col("place") == F.col("pos"))
        met = met.select("tree", (F.col("tree_top") + h).alias("h"), (F.lit(0) if h == 0 else F.col("pos")).cast("long").alias("pos"), "parent", "before", "after", "last_block")
        stored.append(_copies(met, "0", "last_block").select("tree", "block", "h", "pos", "parent", "before", "after"))
    nodes = None
    for part in stored:
        nodes = part if nodes is None else nodes.unionByName(part)

    lone = F.col("n") == 1
    start = runs.join(each.select("tree", "tree_top"), "tree").select(
        "tree",
        "run",
        F.expr(f"run div {RUNS_PER_BLOCK}").alias("block"),
        F.when(lone, 0).otherwise(1).alias("h"),
        F.col("run").alias("pos"),
        (F.col("tree_top") + height).alias("last"),
        F.when(lone, F.expr("transform(nodes, x -> x.found)"))
        .otherwise(F.expr(f"transform(nodes, (x, i) -> {_hash(_packed('transform(nodes, (y, j) -> if(j = i, x.found, y.digest))'))})"))
        .alias("folds"),
        F.expr("cast('' as binary)").alias("siblings"),
    )
    start = settled(start)
    climbed = _climb(spark, start, settled(nodes)) if nodes is not None else start.select("tree", "run", "folds", "siblings")

    root = F.lit(bytes(top.first()["digest"]))
    whole = runs.join(climbed, ["tree", "run"]).join(tops.select("tree", F.col("digest").alias("subroot")), "tree")
    rows = whole.select("subroot", "siblings", "folds", F.posexplode("nodes").alias("at", "node"), "nodes")
    beside = F.expr(_packed("transform(filter(nodes, (x, i) -> i != at), x -> x.digest)"))
    folded = F.col("folds")[F.col("at")]
    return rows.select(
        F.col("node.doc_id").alias("doc_id"),
        _text("node.digest").alias("leaf"),
        _text("subroot").alias("subroot"),
        _text(root).alias("root"),
        F.sha2(_text(F.concat(beside, F.col("siblings"))).cast("binary"), 256).alias("proof_sha256"),
        _text(folded).alias("folded_root"),
        (folded == root).alias("verified"),
    )
