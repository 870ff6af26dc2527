"""Byte-level BPE over a whole corpus: each distinct word is encoded once.

1. Documents are cut into pre-tokens. A block of documents keeps them as
   numbers in order of position and lists its distinct ones once. The lists
   are dealt out by word hash, in slices.
2. In a slice every distinct word is encoded once, however many blocks hold it.
3. The ids go back to the blocks, where each position finds those of its
   word and the documents are put together again.
4. Decoding joins ids with the bytes of the token table, which has as many
   rows as the vocabulary.

Blocks keep the shuffles small: positions never leave their block's rows, and
a word travels once per block instead of once per occurrence. Slices are cut
by hash and blocks by size, so no word, source or document makes one large.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from .common import lean, settled

# Text of a block; one task holds its distinct words, or their ids, at a time.
BLOCK_CHARS = 12_000_000
# Positions that travel as one row.
PIECE_TOKENS = 500_000

# Every character that the pattern takes for white space is white space here too.
_SPLIT = re.compile(r"(?<=\S) (?=\S)")
_DOUBLE = re.compile(r"\s | \s")


def read_ranks(path: str) -> list[tuple[bytes, int]]:
    """Token bytes and ids of a rank file, read on the driver."""
    with open(path, "rb") as lines:
        return [(base64.b64decode(token), int(rank)) for token, rank in map(bytes.split, lines)]


def pack(numbers) -> bytes:
    """Whole numbers from 0 on, byte by byte of equal weight, compressed."""
    planes = np.ascontiguousarray(np.asarray(numbers, dtype="<u4")).view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(np.ascontiguousarray(planes).tobytes(), 3)


def unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(packed), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1).astype(np.int64)


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the runs that begin at ``starts``, one after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


class Block:
    """Documents as numbers of their chunks, and the pre-tokens that each chunk holds.

    A single space between two characters that are no white space always
    starts a pre-token, and no match looks at what lies before it. So a text
    may be cut there, and equal chunks are matched once per block.
    """

    def __init__(self, pattern: str):
        self._find = regex.compile(pattern).findall
        self._first: dict[str, int] = {}
        self._later: dict[str, int] = {}
        self._inside: list[list[int]] = []
        self.words: dict[str, int] = {}
        self.docs: list[tuple[int | None, np.ndarray]] = []
        self.chars = 0
        self.rows = 0

    def _list(self, known: dict[str, int], chunk: str, space: str) -> None:
        words = self.words
        known[chunk] = len(self._inside)
        self._inside.append([words.setdefault(w, len(words)) for w in self._find(space + chunk)])

    def add(self, doc_id: int | None, text: str, place: bool = True) -> None:
        """Take up a document; without ``place`` only its words, which get the same numbers."""
        chunks = _SPLIT.split(text) if _DOUBLE.search(text) else text.split(" ")
        first = chunks.pop(0)
        if first not in self._first:
            self._list(self._first, first, "")
        # In a fixed order, so that each pass over the texts numbers the words alike.
        for chunk in sorted(set(chunks).difference(self._later)):
            self._list(self._later, chunk, " ")
        if place:
            numbers = np.fromiter(map(self._later.__getitem__, chunks), dtype=np.int32, count=len(chunks))
            self.docs.append((doc_id, np.concatenate([[self._first[first]], numbers]).astype(np.int32)))
        self.chars += len(text)
        self.rows += 1

    def tokens(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """Each document with the numbers of its pre-tokens in order."""
        lengths = np.array([len(x) for x in self._inside], dtype=np.int64)
        flat = np.array([n for x in self._inside for n in x], dtype=np.int32)
        starts = np.cumsum(lengths) - lengths
        for doc_id, chunks in self.docs:
            yield doc_id, flat[gather(starts[chunks], lengths[chunks])]


_ROWS = "block long, kind int, part int, a binary, b binary, c binary, ids array<long>"
_ARROW = pa.schema(
    [
        ("block", pa.int64()), ("kind", pa.int32()), ("part", pa.int32()), ("a", pa.binary()), ("b", pa.binary()),
        ("c", pa.binary()), ("ids", pa.list_(pa.int64())),
    ]
)
_REPLY, _PIECE = 0, 1


def _record(rows: list[tuple], schema: pa.Schema = _ARROW) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _blocks(batches, pattern: str, place: bool) -> Iterator[tuple[int, Block]]:
    """The texts of a partition, block by block. The same rows give the same blocks each time."""
    number, block = None, Block(pattern)
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            some = batch.slice(at, 256)
            if number is None:
                number = some["origin"][0].as_py() << 32
            for doc_id, text in zip(some["doc_id"].to_pylist(), some["text"].to_pylist(), strict=True):
                block.add(doc_id, text or "", place)
                if block.chars >= BLOCK_CHARS:
                    yield number, block
                    number, block = number + 1, Block(pattern)
    if block.rows:
        yield number, block


def _cut_words(pattern: str, slices: int):
    def cut(batches):
        for number, block in _blocks(batches, pattern, False):
            words = list(block.words)
            encoded = [w.encode() for w in words]
            part = np.array([xxhash.xxh3_64_intdigest(w) % slices for w in encoded], dtype=np.int64)
            order = np.argsort(part, kind="stable")
            bounds = np.flatnonzero(np.diff(part[order], prepend=-1, append=slices))
            rows = []
            for low, high in zip(bounds, bounds[1:], strict=False):
                own = order[low:high]
                texts = [encoded[i] for i in own]
                rows.append((number, _REPLY, int(part[own[0]]), pack(own), pack([len(t) for t in texts]), zstandard.compress(b"".join(texts), 3), None))
            if rows:
                yield _record(rows)

    return cut


def _cut_pieces(pattern: str):
    def cut(batches):
        for number, block in _blocks(batches, pattern, True):
            part, ids, tokens, held = 0, [], [], 0
            for doc_id, own in block.tokens():
                ids.append(doc_id)
                tokens.append(own)
                held += len(own)
                if held >= PIECE_TOKENS:
                    yield _record([(number, _PIECE, part, pack([len(t) for t in tokens]), pack(np.concatenate(tokens)), None, ids)])
                    part, ids, tokens, held = part + 1, [], [], 0
            if ids:
                yield _record([(number, _PIECE, part, pack([len(t) for t in tokens]), pack(np.concatenate(tokens)), None, ids)])

    return cut


def _encode_words(ranks, pattern: str):
    def encode(batches):
        import tiktoken

        encoding = tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=dict(ranks.value), special_tokens={})
        piece = encoding._core_bpe.encode_single_piece
        known: dict[bytes, list[int]] = {}
        slice_ = None
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if row["part"] != slice_:
                    slice_ = row["part"]
                    known.clear()
                text = zstandard.decompress(row["c"])
                ends = np.cumsum(unpack(row["b"]))
                counts, ids, start = [], [], 0
                for end in ends.tolist():
                    word = text[start:end]
                    found = known.get(word)
                    if found is None:
                        found = known[word] = piece(word)
                    counts.append(len(found))
                    ids += found
                    start = end
                rows.append((row["block"], _REPLY, row["part"], row["a"], pack(counts), pack(ids), None))
            if rows:
                yield _record(rows)

    return encode


_IDS = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])


def _whole(batches) -> Iterator[pa.RecordBatch]:
    """Documents with their ids. Replies of a block come first, then its pieces."""
    block, numbers, counts, ids, table = None, [], [], [], None
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            if row["block"] != block:
                block, numbers, counts, ids, table = row["block"], [], [], [], None
            if row["kind"] == _REPLY:
                numbers.append(unpack(row["a"]))
                counts.append(unpack(row["b"]))
                ids.append(unpack(row["c"]).astype(np.int32))
                continue
            if table is None:
                if numbers:
                    number, count = np.concatenate(numbers), np.concatenate(counts)
                    lengths, starts = np.zeros(len(number), dtype=np.int64), np.zeros(len(number), dtype=np.int64)
                    lengths[number], starts[number] = count, np.cumsum(count) - count
                    table = starts, lengths, np.concatenate(ids)
                else:
                    table = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
            starts, lengths, flat = table
            words = unpack(row["b"])
            found = flat[gather(starts[words], lengths[words])]
            # Tokens per document: those of its words, summed.
            sums = np.concatenate([[0], np.cumsum(lengths[words])])
            offsets = sums[np.concatenate([[0], np.cumsum(unpack(row["a"]))])]
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(found, pa.int32()))
            whole = pa.RecordBatch.from_arrays([pa.array(row["ids"], pa.int64()), lists], schema=_IDS)
            for at in range(0, whole.num_rows, 512):
                yield whole.slice(at, 512)


_DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
_ROUND_TRIP = pa.schema(
    [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), ("ids", pa.list_(pa.int32()))]
)


def _there_and_back(table, with_ids: bool):
    """Put documents together, decode them and digest both, in one operator: a task holds one Python worker, not two."""

    def told(batches):
        token = table.value.__getitem__
        for batch in _whole(batches):
            lists = batch["ids"]
            flat, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
            own = [flat[a:b] for a, b in zip(offsets, offsets[1:], strict=False)]
            columns = [
                batch["doc_id"],
                pa.array([len(x) for x in own], pa.int64()),
                pa.array([_sha256_of_ids(x) for x in own], pa.string()),
                pa.array([hashlib.sha256(b"".join(map(token, x.tolist()))).hexdigest() for x in own], pa.string()),
            ]
            if with_ids:
                yield pa.RecordBatch.from_arrays([*columns, lists], schema=_ROUND_TRIP)
            else:
                yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(list(_ROUND_TRIP)[:-1]))

    return told


def _met(docs: DataFrame, ranks: list[tuple[bytes, int]], pattern: str, files: bool) -> DataFrame:
    """Per block the ids of its words, and then its documents as numbers of words."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = (texts if files else settled(texts)).withColumn("origin", F.spark_partition_id().cast("long"))
    slices = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = spark.sparkContext.broadcast(ranks)
    words = texts.mapInArrow(lean(_cut_words(pattern, slices)), _ROWS).repartition("part").sortWithinPartitions("part")
    replies = words.mapInArrow(lean(_encode_words(table, pattern)), _ROWS)
    pieces = texts.mapInArrow(lean(_cut_pieces(pattern)), _ROWS)
    return replies.unionByName(pieces).repartition("block").sortWithinPartitions("block", "kind", "part")


def encode(docs: DataFrame, ranks: list[tuple[bytes, int]], pattern: str, files: bool = False) -> DataFrame:
    """doc_id and token ids of every whole text, each match of ``pattern`` encoded on its own, no special tokens.

    A null text counts as empty and has no ids. Repeated rows are encoded one
    by one, an empty table gives no rows. Only doc_id and text are read.
    ``files`` says that ``docs`` is read from files as it is, so that it has
    the same rows in the same partitions each time; else it is written first.
    """
    return _met(docs, ranks, pattern, files).mapInArrow(lean(_whole), "doc_id long, ids array<int>")


def round_trip(docs: DataFrame, ranks: list[tuple[bytes, int]], pattern: str, files: bool = False, with_ids: bool = False) -> DataFrame:
    """``digests`` of ``decode`` of ``encode``, without carrying ids and bytes from one operator to the next.

    The ids themselves are a further column if asked for.
    """
    table = docs.sparkSession.sparkContext.broadcast({rank: token for token, rank in ranks})
    schema = f"{_DIGESTS}, ids array<int>" if with_ids else _DIGESTS
    return _met(docs, ranks, pattern, files).mapInArrow(lean(_there_and_back(table, with_ids)), schema)


def decode(encoded: DataFrame, ranks: list[tuple[bytes, int]]) -> DataFrame:
    """Add ``decoded``, the bytes of the ids in order. An id outside the table is an error; no ids give no bytes."""
    # The table has one row per token of the vocabulary and is joined on the map side.
    table = encoded.sparkSession.sparkContext.broadcast({rank: token for token, rank in ranks})

    @F.pandas_udf("binary")
    def joined(ids: pd.Series) -> pd.Series:
        token = table.value.__getitem__
        return pd.Series([b"" if x is None else b"".join(map(token, x.tolist())) for x in ids], dtype=object)

    return encoded.withColumn("decoded", joined("ids"))


def _sha256_of_ids(ids) -> str:
    """Digest of ids as little-endian unsigned 32-bit integers."""
    return hashlib.sha256(np.asarray(ids, dtype="<u4").tobytes()).hexdigest()


def _ids_sha256(ids: pd.Series) -> pd.Series:
    return pd.Series(list(map(_sha256_of_ids, ids)), dtype=object)


def digests(decoded: DataFrame, *more: str) -> DataFrame:
    """Number and digest of the ids, digest of the decoded bytes, and further columns as they are."""
    return decoded.select(
        "doc_id",
        *more,
        F.size("ids").cast("long").alias("n_tokens"),
        F.pandas_udf(_ids_sha256, "string")("ids").alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
