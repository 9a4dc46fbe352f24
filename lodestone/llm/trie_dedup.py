"""Exact dedup with compressed radix tries.

Texts are dealt by byte length and content hash. Each task inserts full byte strings into a Patricia trie per length;
a terminal node stores the text's owner (its smallest or largest identifier) and the number of rows. A trie that
outgrows its memory budget spills its heaviest subtrees to local files and finishes them one by one.

A first trie in each scan task collapses the copies that the task sees, so a text that a third of all rows share
reaches its owner's task once per scan task. Owners then go back to the rows through a join on length and hash, whose
hot keys AQE can split; no task gathers a group's rows. Two different texts of one length and SHA-256 would stop the job.

Results for odd input: a null text counts as empty, and all empty texts are one group; rows that repeat an id and its
text all count in group_size and, if they own the group, are all kept; a null id owns a group only if all its ids are
null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import ascii_lower

_CLASS = "n_bytes int, sha binary, text binary, owner long, size long"
_NAMES = ["n_bytes", "sha", "text", "owner", "size"]


class _Node:
    __slots__ = ("label", "children", "owner", "count", "spill")

    def __init__(self, label: bytes):
        self.label, self.children, self.owner, self.count, self.spill = label, {}, None, 0, None


def _shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    if a == b[: len(a)]:
        return len(a)
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[:mid] == b[:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


class PatriciaTrie:
    """Byte strings to (owner, count). best(a, b) picks the owner of two identifiers.

    budget bounds the label bytes held; beyond it the heaviest child subtrees of the root go to temporary files, and
    later insertions below them are appended there.
    """

    NODE = 200  # bytes that a node takes besides its label

    def __init__(self, best=min, budget: int = 128 << 20):
        self.best, self.budget = best, budget
        self.root, self.bytes = _Node(b""), 0

    def insert(self, key: bytes, owner: int | None, count: int = 1) -> None:
        node, rest = self.root, key
        while True:
            if not rest:
                if node.count and None not in (owner, node.owner):
                    node.owner = self.best(node.owner, owner)
                elif owner is not None:
                    node.owner = owner
                node.count += count
                return
            child = node.children.get(rest[0])
            if child is None:
                node.children[rest[0]] = child = _Node(rest)
                child.owner, child.count = owner, count
                self._grow(len(rest) + self.NODE)
                return
            if child.spill is not None:
                pickle.dump((rest, owner, count), child.spill)
                return
            n = _shared(child.label, rest)
            if n < len(child.label):  # split the edge
                upper = _Node(child.label[:n])
                child.label = child.label[n:]
                upper.children[child.label[0]] = child
                node.children[rest[0]] = child = upper
                self.bytes += self.NODE  # spilling waits until the string is in
            node, rest = child, rest[n:]

    def _grow(self, n: int) -> None:
        self.bytes += n
        while self.bytes > self.budget and (heavy := self._heaviest()):
            self._spill(heavy)

    def _weight(self, node: _Node) -> int:
        total, stack = 0, [node]
        while stack:
            x = stack.pop()
            total += len(x.label) + self.NODE
            stack += x.children.values()
        return total

    def _heaviest(self) -> _Node | None:
        return max((x for x in self.root.children.values() if x.spill is None), key=self._weight, default=None)

    def _spill(self, node: _Node) -> None:
        self.bytes -= self._weight(node)
        spill = tempfile.TemporaryFile()
        for item in self._items(node, b""):
            pickle.dump(item, spill)
        node.label, node.children, node.owner, node.count, node.spill = node.label[:1], {}, None, 0, spill

    def _items(self, top: _Node, prefix: bytes) -> Iterator[tuple[bytes, int | None, int]]:
        stack = [(top, prefix)]
        while stack:
            node, prefix = stack.pop()
            if node.spill is not None:
                node.spill.seek(0)
                inner = PatriciaTrie(self.best, max(2 * self.budget, 1 << 16))  # twice as much, so that spills nest to a small depth only
                while True:
                    try:
                        rest, owner, count = pickle.load(node.spill)
                    except EOFError:
                        break
                    inner.insert(rest[1:], owner, count)  # the first byte is the edge that was followed
                node.spill.close()
                for key, owner, count in inner.drain():
                    yield prefix + node.label + key, owner, count
                continue
            key = prefix + node.label
            if node.count:
                yield key, node.owner, node.count
            stack += [(x, key) for x in node.children.values()]

    def drain(self) -> Iterator[tuple[bytes, int | None, int]]:
        """All (key, owner, count)."""
        yield from self._items(self.root, b"")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 5
    kinds = (pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], _NAMES)


def _emit(trie: PatriciaTrie, with_text: bool, most: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    rows, held = [], 0
    for key, owner, count in trie.drain():
        rows.append((len(key), hashlib.sha256(key).digest(), key if with_text else None, owner, count))
        held += len(key) + 100
        if held > most:
            yield _batch(rows)
            rows, held = [], 0
    if rows:
        yield _batch(rows)


def _combine(best, budget: int):
    """Within a scan task: one row per text that a flush of the trie holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = PatriciaTrie(best, 4 * budget)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                trie.insert(text.as_py(), doc_id)
                if trie.bytes > budget:  # what is flushed early meets again after the shuffle
                    yield from _emit(trie, True)
                    trie = PatriciaTrie(best, 4 * budget)
        yield from _emit(trie, True)

    return run


def _own(best, budget: int):
    """Within a task of the shuffle, whose rows are sorted by length: one row per text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, length = PatriciaTrie(best, budget), None
        for batch in batches:
            for n_bytes, text, owner, size in zip(batch.column(0).to_pylist(), batch.column(2), *(batch.column(k).to_pylist() for k in (3, 4))):
                if n_bytes != length:
                    yield from _emit(trie, False)
                    trie, length = PatriciaTrie(best, budget), n_bytes
                trie.insert(text.as_py(), owner, size)
        yield from _emit(trie, False)

    return run


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min", normalize=ascii_lower, budget: int = 64 << 20) -> DataFrame:
    """One row per row of docs: its id, keep_id, group_size, kept and text_sha256 (of the normalised text).

    keep: "min" or "max", the identifier that owns a group. normalize: Column to Column; texts are equal when their
    normalised bytes are. budget: bytes a trie holds before it flushes or spills.
    """
    best = {"min": min, "max": max}[keep]

    def normal() -> Column:
        return normalize(F.coalesce(F.col(text_col), F.lit("")))

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), normal().cast("binary").alias("text"))
    classes = (
        rows.mapInArrow(_combine(best, budget), _CLASS)
        .repartition("n_bytes", "sha")
        .sortWithinPartitions("n_bytes")
        .mapInArrow(_own(best, budget), _CLASS)
        .groupBy("n_bytes", "sha")
        .agg(F.max("owner").alias("owner"), F.max("size").alias("size"), F.count("*").alias("texts"))
        .select("n_bytes", "sha", "owner", F.when(F.col("texts") == 1, F.col("size")).otherwise(F.raise_error(F.lit("two texts share their length and SHA-256"))).alias("size"))
    )
    keys = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.octet_length(normal()).alias("n_bytes"), F.unhex(F.sha2(normal().cast("binary"), 256)).alias("sha"))
    return keys.join(classes, ["n_bytes", "sha"]).select("doc_id", F.col("owner").alias("keep_id"), F.col("size").alias("group_size"), F.col("doc_id").eqNullSafe(F.col("owner")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
