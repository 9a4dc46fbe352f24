"""Best-fit packing of tokenized documents into fixed-length sequences.

Bounded-space online best-fit: a task takes its pieces as they come, in the order of a hash, and keeps a fixed number of open
bins in a bitset keyed by free space. It puts each piece into the fullest bin that can hold it, and closes the fullest bin when it
needs room for a new one. What the tasks leave open at their end is packed the same way once more by fewer tasks; as these
pieces are few and known, the longest of them come first.

Results for odd input: a null text counts as empty and gives one piece that holds the end token alone; a row with a
null or repeated doc_id is packed like any other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import ceil_div, given_back, materialize, WordCache

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PLACED = PIECE + ", sequence_id long, offset long, open boolean"
SPECIAL = "<|endoftext|>"


class FastTokenizer:
    """The ids of tokenizers' byte-level BPE, as little-endian unsigned 32-bit bytes.

    A text without doubled white space is encoded word by word from a cache, since the pre-tokenizer's pattern never
    crosses a single space before a non-space; other texts are encoded whole. A text that spells a special token goes
    to the tokenizers library itself.
    """

    def __init__(self, json_path: str, ranks_path: str, pattern: str):
        import regex
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encode = tiktoken.Encoding("lodestone", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.json_path, self.slow = json_path, None
        self.doubled = regex.compile(r"\s\s|^\s|\s$").search
        self.words = WordCache(lambda w: np.array(self.encode(" " + w), "<u4").tobytes())

    def __call__(self, text: str) -> bytes:
        if SPECIAL in text:
            if self.slow is None:
                from tokenizers import Tokenizer

                self.slow = Tokenizer.from_file(self.json_path)
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if not text or self.doubled(text):
            return np.array(self.encode(text), "<u4").tobytes()
        first, *rest = text.split(" ")
        return np.array(self.encode(first), "<u4").tobytes() + b"".join(map(self.words.__getitem__, rest))


def public_tokenizer() -> dict[str, str]:
    """Paths and pattern of the public byte-level BPE with 50,257 ids."""
    import public_tokenizers as P

    return {"json_path": P.path("byte_bpe_50k.json"), "ranks_path": P.path("byte_bpe_50k.tiktoken"), "pattern": P.PATTERN}


def cut(docs: DataFrame, tokenizer: dict[str, str], capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """Pieces of at most capacity ids; only the first piece of a longer document may be shorter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = FastTokenizer(**tokenizer), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            ids, numbers, starts, lengths, crcs = [], [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = encode(text.as_py()) + end
                n = len(data) // 4
                first = n % capacity or min(n, capacity)
                at, k = 0, 0
                while at < n:
                    to = at + (capacity if k else first)
                    ids.append(doc_id)
                    numbers.append(k)
                    starts.append(at)
                    lengths.append(to - at)
                    crcs.append(zlib.crc32(data[4 * at : 4 * to]))
                    at, k = to, k + 1
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(numbers, pa.int32()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(given_back(run), PIECE)


class OpenBins:
    """At most limit open bins. bits has a bit for each free space that some open bin has."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit = capacity, limit
        self.closed_early, self.bits, self.open, self.by_free = 0, 0, 0, [[] for _ in range(capacity + 1)]

    def _take(self, free: int) -> list:
        stack = self.by_free[free]
        items = stack.pop()
        if not stack:
            self.bits ^= 1 << free
        self.open -= 1
        return items

    def put(self, item, length: int) -> list | None:
        """Place an item shorter than the capacity; returns the items of the bin that this closes, if any."""
        closed = None
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            items = self._take(free)
        else:
            if self.open >= self.limit:
                closed = self._take((self.bits & -self.bits).bit_length() - 1)
                self.closed_early += 1
            free, items = self.capacity, []
        items.append(item)
        free -= length
        if not free:  # only a bin that was open can be full now, as no item fills a bin alone
            return items
        self.by_free[free].append(items)
        self.bits |= 1 << free
        self.open += 1
        return closed

    def rest(self) -> Iterator[tuple[int, list]]:
        for free, stack in enumerate(self.by_free):
            for items in stack:
                yield free, items


def _packer(capacity: int, open_bins: int, loose: int | None):
    """Packs the pieces of a partition. Bins still open at the end with more than loose ids free are handed back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 36
        bins, rows = OpenBins(capacity, open_bins), []

        def close(items: list, is_open: bool = False) -> None:
            nonlocal number
            offset = 0
            for item in items:
                rows.append((*item, number, offset, is_open))
                offset += item[3]
            number += 1

        def batch_of() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
            names = ("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "open")
            columns = list(zip(*rows)) or [()] * len(names)
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], list(names))
            rows.clear()
            return out

        for batch in batches:
            for item in zip(*(c.to_pylist() for c in batch.columns)):
                closed = bins.put(item, item[3])
                if closed:
                    close(closed)
            if len(rows) > 50_000:
                yield batch_of()
        for free, items in bins.rest():
            close(items, loose is not None and free > loose)
        yield batch_of()

    return run


def pack(pieces: DataFrame, capacity: int = 1024, open_bins: int = 512, pieces_per_task: int = 32_768, loose: int = 8) -> DataFrame:
    """Assign pieces to sequences of at most capacity ids, gapless from offset 0.

    Pieces are dealt at random over tasks of about pieces_per_task, each with at most open_bins open bins. Bins that a task
    leaves open and not nearly full give their pieces back to a second, smaller round, so the loss doesn't grow with the
    number of tasks.
    Every piece of full length is a sequence of its own. pieces must be a stored table: it is read more than once.
    """
    columns = [F.col(x.split()[0]) for x in PIECE.split(", ")]
    order = F.xxhash64("doc_id", "piece", "ids_crc32", "start")
    part = pieces.filter(F.col("length") < capacity).select(*columns)
    tasks = max(1, ceil_div(part.count(), pieces_per_task))
    first = materialize(part.repartition(tasks, order).sortWithinPartitions(order, "doc_id", "piece").mapInArrow(_packer(capacity, open_bins, loose), _PLACED), "packed")
    back = first.filter("open").select(*columns)
    again = back.repartition(max(1, ceil_div(back.count(), 4 * pieces_per_task))).sortWithinPartitions(F.desc("length"), order, "doc_id", "piece").mapInArrow(_packer(capacity, open_bins, None), _PLACED)
    out = [F.col("doc_id"), F.col("piece"), F.col("start"), F.col("length"), F.col("ids_crc32")]
    full = pieces.filter(F.col("length") >= capacity).select(*columns)
    return (
        full.select(*out, (3 * F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
        .unionByName(first.filter("not open").select(*out, (3 * F.col("sequence_id") + 1).alias("sequence_id"), "offset"))
        .unionByName(again.select(*out, (3 * F.col("sequence_id") + 2).alias("sequence_id"), "offset"))
    )


def pack_documents(docs: DataFrame, tokenizer: dict[str, str] | None = None, capacity: int = 1024, **options) -> DataFrame:
    """Tokenize, cut and pack documents."""
    return pack(materialize(cut(docs, tokenizer or public_tokenizer(), capacity), "pieces"), capacity, **options)
