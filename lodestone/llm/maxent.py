"""Language-model scores by a hashed maximum-entropy model with class-factored softmax.

P(word | history) = P(class | history) P(word | class). The class comes from a softmax over hashed features of the
words before: the last word, the one before it and the third last (skips), and the last two together. Within a class the
words are the leaves of a binary tree, Huffman's, and every turn on the way to a word is a logistic decision with hashed features of
the turn and the same words before. Untrained, the turns give words their training frequencies; any weights leave a distribution. Classes are clusters of the frequent words by the company they keep
in documents, split by frequency; the end of a text and all words that aren't frequent have a class each. The latter are dealt by
hash to groups, the leaves of their class's tree, and share a group by add-one counts, so that with one unknown word a group the
probabilities add up to one. As history every word counts by its own hash.

The frequent words and the hashed features grow with the square root of the tokens, the groups with that of the distinct words
(Shape.of); the number of classes is fixed, as the trees tell the words of a class apart.

Everything that is counted covers all training rows: word counts by a distributed aggregate, the clusters' profiles and the
gradients by one pass each. In a round of training all tasks sum the gradient and its curvature over their rows from the
same weights, the sums are added up in two levels, and one step divides them; so how rows are dealt to tasks changes nothing
but rounding. Each training row is used in one round. Scoring runs in sparse numpy batches; only
the head of the vocabulary (at most head words) is broadcast, and the counts of all other words are joined.

Results for odd input: a null text counts as empty and has the end token alone; a row with a null id counts as the empty id; rows that
repeat an id are scored one by one; an empty table gives no rows, and without training rows the model is uniform over the
classes; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import ASCII_LOWER, crc32_mod, materialize

END = b""  # no word is empty
TEMPLATES = 4
TASKS_A_CORE = 1
SUMMED = 64  # arrays that are added up in one go
#: Of each round of training: its share of the rows, and the steps of classes and turns.
ROUNDS = ((1, 6.0, 0.5), (1, 4.0, 0.3), (2, 3.0, 0.2))
#: What is added to the counts and curvatures that divide a gradient.
DAMPING, TURN_DAMPING = 20.0, 5.0
#: How far a weight moves in a round at most, so that features which go together don't overshoot together.
FARTHEST = 0.75
WIDE = 1 << 24  # numbers of a history before they are dealt to slots
CLASS_BLOCK, BLOCK = 32_768, 16_384  # tokens whose classes and whose turns are worked out at a time: what is held of them stays in the cache, as do a template's weights
SPACE = 0x20
#: A byte in lower case, any white space as a blank.
LOWER_BYTE = np.frombuffer(ASCII_LOWER.translate(bytes.maketrans(b"\t\n\v\f\r", b"     ")), np.uint8)

#: What a byte does to a CRC-32, which zlib only gives inverted.
CRC_BYTE = np.array([zlib.crc32(bytes([k])) for k in range(256)], np.uint32)
CRC_BYTE = CRC_BYTE[np.arange(256) ^ 0xFF] ^ np.uint32(0xFF000000)


def tokens(text: str | None) -> list[bytes]:
    """Words in lower case, and the end."""
    return [*(text or "").encode("utf-8", "surrogatepass").translate(ASCII_LOWER).split(), END]


def _slices(column: pa.Array, most: int = 1 << 22) -> Iterator[tuple[int, int]]:
    """Rows from and to of pieces of a column of texts that have about so many bytes."""
    size = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(size):
        end = max(at + 1, int(np.searchsorted(size, most + (size[at - 1] if at else 0), "right")))
        yield at, end
        at = end


def token_table(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The tokens of all texts of a column, one after the other as tokens() has them, and where each text begins."""
    column = pc.fill_null(column, "").cast(pa.binary())
    n = len(column)
    _, borders, data = column.buffers()
    borders = np.frombuffer(borders, np.int32)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int32)
    text = np.frombuffer(data, np.uint8)[borders[0] : borders[-1]] if borders[-1] > borders[0] else np.zeros(0, np.uint8)
    borders = borders.astype(np.int64) - borders[0]
    text = LOWER_BYTE.take(text)
    inside = text != SPACE
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begin = borders[:-1][borders[:-1] < len(text)]
    first[begin] = inside[begin]
    starts = np.flatnonzero(first)
    upto = np.searchsorted(starts, borders[1:])  # words of this text and those before it
    offsets = np.append(np.cumsum(inside, dtype=np.int32)[starts] - 1, np.count_nonzero(inside)).astype(np.int32)
    offsets = np.insert(offsets, upto, offsets[upto])  # the ends, of no length
    words = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(text[inside])])
    return words, np.concatenate(([0], upto[:-1] + np.arange(1, n))) if n else np.zeros(0, np.int64)


def _count(most: int = 2_000_000):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Array] = []

        def flush() -> pa.RecordBatch:
            counts = pa.chunked_array(held, pa.binary()).value_counts()
            held.clear()
            return pa.RecordBatch.from_arrays([counts.field("values"), counts.field("counts")], ["word", "n"])

        for batch in batches:
            for at, end in _slices(batch.column(0)):
                held.append(token_table(batch.column(0).slice(at, end - at))[0])
                if sum(map(len, held)) > most:
                    yield flush()
        yield flush()

    return run


@dataclass(frozen=True)
class Shape:
    """head: frequent words at most. anchors: of these, words whose company makes the profiles. clusters, bands: classes are clusters by frequency bands. slots: hashed features of a template.

    batch: training tokens whose gradients are summed at a time; as each sum goes through all slots and turns, they grow together. turns: hashed features of a template in the trees, a power of two. groups: of the words beyond the head.
    """

    head: int = 32_768
    anchors: int = 32
    clusters: int = 6
    bands: int = 3
    slots: int = 8192
    batch: int = 32_768
    turns: int = 1 << 18
    groups: int = 64

    @classmethod
    def of(cls, total: int, kinds: int) -> Shape:
        """The shape for so many training tokens and distinct words."""
        power = lambda x: 1 << int(math.log2(max(x, 1)))
        root = math.sqrt(total)
        turns = max(cls.turns, power(64 * root))
        return cls(head=max(cls.head, int(4 * root)), slots=max(cls.slots, power(2 * root)), batch=max(cls.batch, turns // 16), turns=turns, groups=max(cls.groups, power(math.sqrt(kinds))))


def _crc32(words: pa.Array, longest: int = 32) -> np.ndarray:
    """zlib.crc32 of each word; a byte of all words at a time, longer words one by one."""
    _, borders, data = words.buffers()
    borders = np.frombuffer(borders, np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64) if len(words) else np.zeros(1, np.int64)
    length, out = np.diff(borders), np.full(len(words), 0xFFFFFFFF, np.uint32)
    order = np.argsort(-length, kind="stable")
    text, ends = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), np.searchsorted(-length[order], -np.arange(longest), "left")
    order = order[np.searchsorted(-length[order], -longest, "left") :]
    skipped = len(words) - len(order)
    crc, begin = out[order], borders[:-1][order]
    for k in range(longest):
        n = ends[k] - skipped  # words with more than k bytes
        if n <= 0:
            break
        crc[:n] = CRC_BYTE[(crc[:n] ^ text[begin[:n] + k]) & 0xFF] ^ (crc[:n] >> 8)
    out[order] = ~crc
    for k in np.flatnonzero(length >= longest).tolist():
        out[k] = zlib.crc32(words[k].as_py())
    return out


class Indexer:
    """Words to numbers: the head by rank, any other word to head + its hash."""

    def __init__(self, head: list[bytes], shape: Shape):
        self.head, self.n = pa.array(head, pa.binary()), shape.head

    def __call__(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """The numbers, and which of the distinct words each is, and those."""
        coded = words.dictionary_encode()
        of, kinds = coded.indices.to_numpy(), coded.dictionary
        number = pc.fill_null(pc.index_in(kinds, value_set=self.head), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        rare = np.flatnonzero(number < 0)
        number[rare] = _crc32(kinds.take(pa.array(rare))).astype(np.int64) + self.n
        return number[of], of, kinds


def _profiles(head: list[bytes], shape: Shape):
    """What each word's documents have of the anchor words, summed over a task's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, total = Indexer(head, shape), np.zeros((shape.head, shape.anchors), np.float32)
        for batch in batches:
            for at, end in _slices(batch.column(0)):
                words, starts = token_table(batch.column(0).slice(at, end - at))
                for ids in np.split(index(words)[0], starts[1:]):
                    ids = np.sort(ids[ids < shape.head])
                    new = np.flatnonzero(np.diff(ids, prepend=-1))
                    n = np.diff(new, append=len(ids))
                    ids = ids[new]
                    few = np.searchsorted(ids, shape.anchors)
                    if few:
                        company = np.zeros(shape.anchors, np.float32)
                        company[ids[:few]] = n[:few]
                        total[ids] += np.minimum(n, 3)[:, None].astype(np.float32) * (company / company.sum())
        yield from _parts(total)

    return run


def _parts(total: np.ndarray, n: int = 64) -> Iterator[pa.RecordBatch]:
    """An array as n rows, with the task's number."""
    context = TaskContext.get()
    task = context.partitionId() if context else 0
    pieces = [p.astype(np.float32).tobytes() for p in np.array_split(total.reshape(-1), n)]
    yield pa.RecordBatch.from_arrays([pa.array(range(n), pa.int32()), pa.array([task] * n, pa.int32()), pa.array(pieces, pa.binary())], ["part", "task", "data"])


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up the rows of each part and turn, which follow each other. Holds one sum."""
    current, total = None, np.zeros(0)

    def out() -> pa.RecordBatch:
        part, task = current
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([task], pa.int32()), pa.array([total.astype(np.float32).tobytes()], pa.binary())], ["part", "task", "data"])

    for batch in batches:
        for part, task, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            if (part, task) != current:
                if current:
                    yield out()
                current, total = (part, task), np.zeros(len(data.as_buffer()) // 4)
            total += np.frombuffer(data.as_buffer(), np.float32)
    if current:
        yield out()


def _summed(parts: DataFrame, tasks: int) -> np.ndarray | None:
    """The sum of the arrays of so many tasks at most; SUMMED arrays are added up at a time, so no task's work grows with their number."""
    while True:
        tasks = -(-tasks // SUMMED)
        turn = F.floor(F.col("task") / SUMMED).cast("int")
        dealt = parts.withColumn("own", F.col("task")).withColumn("task", turn).repartition("part", "task").sortWithinPartitions("part", "task", "own")
        parts = dealt.select("part", "task", "data").mapInArrow(_add, "part int, task int, data binary")
        if tasks <= 1:
            break
    rows = sorted(parts.collect(), key=lambda r: r["part"])
    return np.concatenate([np.frombuffer(r["data"], np.float32) for r in rows]) if rows else None


def cluster(profiles: np.ndarray, weight: np.ndarray, n: int, rounds: int = 25) -> np.ndarray:
    """k-means on the profiles' shares, relative to the mean profile; begins far apart among the frequent words."""
    mean = profiles.sum(axis=0) + 1e-6
    x = (profiles + 1e-3) / mean
    x = np.log(x / x.mean(axis=1, keepdims=True))
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    x = x / np.maximum(norm, 1e-9)
    often = x[: max(n, len(x) // 16)]
    chosen = [0]
    while len(chosen) < n:
        chosen.append(int((often @ often[chosen].T).max(axis=1).argmin()))
    centres = often[chosen]
    for _ in range(rounds):
        own = (x @ centres.T).argmax(axis=1)
        for k in range(n):
            if (own == k).any():
                c = (x[own == k] * np.sqrt(weight[own == k])[:, None]).sum(axis=0)
                centres[k] = c / max(np.linalg.norm(c), 1e-9)
    return (x @ centres.T).argmax(axis=1)


def classes(head: list[bytes], counts: np.ndarray, profiles: np.ndarray | None, shape: Shape) -> np.ndarray:
    """The class of each head word. Class 0 is for all words beyond the head, class 1 for the end."""
    out = np.full(len(head), 2)
    if profiles is not None and len(head) > shape.clusters:
        own = cluster(profiles[: len(head)].astype(np.float64), counts, shape.clusters)
        for k in range(shape.clusters):
            at = np.flatnonzero(own == k)  # by falling frequency, as the head is
            mass = np.cumsum(counts[at])
            if len(at):
                out[at] = 2 + k * shape.bands + np.minimum(shape.bands - 1, (mass - counts[at]) * shape.bands // max(mass[-1], 1)).astype(int)
    out[[k for k, w in enumerate(head) if w == END]] = 1
    return out


@dataclass(frozen=True)
class Trees:
    """A binary tree of each class's leaves. first: where a leaf's way begins in turns and signs (1 or -1), and the end. bias: of each turn. weights: TEMPLATES x Shape.turns."""

    first: np.ndarray
    turns: np.ndarray
    signs: np.ndarray
    bias: np.ndarray
    weights: np.ndarray

    def ways(self, leaves: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
        """How many turns the way to each leaf has; of all of them number, sign and hashed features. keys: wide history of the leaves."""
        begin = self.first[leaves]
        n = self.first[leaves + 1] - begin
        at = np.repeat(begin - np.cumsum(n) + n, n)
        at += np.arange(len(at))
        turns = self.turns.take(at, mode="clip") if len(at) else self.turns[:0]
        mixed, shift = turns.astype(np.uint32) * np.uint32(0x85EBCA6B), np.uint32(33 - self.weights.shape[1].bit_length())
        words = keys.astype(np.uint32) * np.uint32(0x9E3779B1)
        return n, turns, self.signs.take(at, mode="clip") if len(at) else self.signs[:0], [((np.repeat(w, n) ^ mixed) * np.uint32(0xC2B2AE35) >> shift).astype(np.intp) for w in words]

    def lean(self, weights: np.ndarray, turns: np.ndarray, signs: np.ndarray, slots: list[np.ndarray]) -> np.ndarray:
        """How far each turn leans to the side that its sign asks for."""
        z = self.bias.take(turns, mode="clip") if len(turns) else np.zeros(0, np.float32)
        for k in range(TEMPLATES):
            z += weights[k].take(slots[k], mode="clip")
        return np.clip(z, -30, 30) * signs

    def log_share(self, leaves: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Log-probability of each leaf within its class."""
        n, turns, signs, slots = self.ways(leaves, keys)
        upto = np.concatenate(([0], np.cumsum(np.log(1 + np.exp(-self.lean(self.weights, turns, signs, slots))), dtype=np.float64)))
        end = np.cumsum(n)
        return upto[end - n] - upto[end]

    def slope(self, gradient: np.ndarray, curve: np.ndarray, leaves: np.ndarray, keys: np.ndarray) -> None:
        """Adds the gradient towards the leaves, and its curvature, to arrays like weights. A table of a template's size is summed for each call, so leaves are best many."""
        found = []
        for at in range(0, len(leaves), BLOCK):
            _, turns, signs, slots = self.ways(leaves[at : at + BLOCK], keys[:, at : at + BLOCK])
            miss = 1 / (1 + np.exp(self.lean(self.weights, turns, signs, slots)))
            found.append((signs * miss, miss * (1 - miss), *(s.astype(np.int32) for s in slots)))
        uphill, bend, *slots = (np.concatenate(x) for x in zip(*found))
        uphill, bend = uphill.astype(np.float64), bend.astype(np.float64)
        for k in range(TEMPLATES):
            at = slots[k].astype(np.intp)
            gradient[k] += np.bincount(at, uphill, gradient.shape[1])
            curve[k] += np.bincount(at, bend, curve.shape[1])


def grow(own: np.ndarray, mass: np.ndarray, turns: int) -> Trees:
    """Huffman's tree of each class. own, mass: class and count of each leaf."""
    n = len(own)
    parent, side = np.full(2 * n, -1), np.zeros(2 * n, np.float32)
    bias, node = [], n
    for k in np.unique(own):
        heap = [(float(mass[i]), int(i)) for i in np.flatnonzero(own == k)]
        heapq.heapify(heap)
        while len(heap) > 1:
            (a, i), (b, j) = heapq.heappop(heap), heapq.heappop(heap)
            parent[i] = parent[j] = node
            side[i], side[j] = 1, -1
            bias.append(math.log(a / b))
            heapq.heappush(heap, (a + b, node))
            node += 1
    leaf, at, steps = np.arange(n), np.arange(n), []
    while True:
        below = parent[at] >= 0
        leaf, at = leaf[below], at[below]
        if not len(at):
            break
        steps.append((leaf, parent[at] - n, side[at]))
        at = parent[at]
    leaf, turn, sign = (np.concatenate([s[k] for s in steps]) if steps else np.zeros(0, np.int64) for k in range(3))
    order = np.argsort(leaf, kind="stable")
    first = np.concatenate(([0], np.cumsum(np.bincount(leaf, minlength=n))))
    return Trees(first, turn[order].astype(np.int32), sign[order].astype(np.float32), np.array(bias, np.float32), np.zeros((TEMPLATES, turns), np.float32))


@dataclass(frozen=True)
class Model:
    """weights: TEMPLATES x slots x classes. own: class of each head word. inner: log10 P(word | class) of head words by frequency, where the trees begin. base: log10(count + 1) of them. trees: leaves are the head words, then the groups of others. shared: log10 of the groups' add-one counts."""

    shape: Shape
    head: list[bytes]
    own: np.ndarray
    inner: np.ndarray
    base: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trees: Trees | None = None
    shared: np.ndarray | None = None

    def n_classes(self) -> int:
        return len(self.bias)

    def leaf_of(self, ids: np.ndarray) -> np.ndarray:
        return np.where(ids < len(self.own), ids, len(self.own) + (ids - self.shape.head) % self.shape.groups)

    def class_of(self, ids: np.ndarray) -> np.ndarray:
        return np.where(ids < len(self.own), self.own[np.minimum(ids, max(len(self.own) - 1, 0))] if len(self.own) else 0, 0)


def history(ids: np.ndarray, slots: int, starts: np.ndarray | tuple = (0,)) -> np.ndarray:
    """TEMPLATES x tokens: hashed features of what stands before each token of a text. starts: where texts begin, none of which is empty."""
    outside, starts = 1 << 40, np.asarray(starts, np.int64)
    before = np.concatenate((np.full(3, outside, np.int64), ids[:-1]))
    one, two, three = (before[k : k + len(ids)].copy() for k in (2, 1, 0))
    for far, words in enumerate((one, two, three), 1):
        for k in range(far):
            words[starts[starts + k < len(ids)] + k] = outside
    one, two, three = (words.view(np.uint64) for words in (one, two, three))
    mix, shift = np.uint64(0x9E3779B97F4A7C15), np.uint64(40)
    keys = (one, two + np.uint64(1 << 50), three + np.uint64(1 << 51), one * np.uint64(0xBF58476D1CE4E5B9) + two)
    out = np.stack([(key * mix >> shift).astype(np.uint32) for key in keys])
    return out if slots == WIDE else out % np.uint32(slots)


def _by_class(weights: np.ndarray) -> np.ndarray:
    """The same weights, those of a class side by side in memory."""
    return np.ascontiguousarray(weights.transpose(0, 2, 1)).transpose(0, 2, 1)


def _logits(weights: np.ndarray, bias: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Scores of the classes, a row each, the largest of each token 0."""
    z = np.empty((len(bias), features.shape[1]), np.float32)
    for c, row in enumerate(z):
        row[:] = bias[c]
        for k in range(TEMPLATES):
            row += weights[k, :, c].take(features[k])
    z -= z.max(axis=0)
    return z


def _log_share(z: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Log-probability of each token's own class."""
    return z[own, np.arange(len(own))] - np.log(np.exp(z).sum(axis=0))


def _batches(batches: Iterator[pa.RecordBatch], index: Indexer, shape: Shape, column: int = 0):
    """(ids, wide history) of shape.batch tokens, those of the last fewer."""
    held, n = [], 0
    for batch in batches:
        for at, end in _slices(batch.column(column)):
            words, starts = token_table(batch.column(column).slice(at, end - at))
            ids = index(words)[0]
            keys = history(ids, WIDE, starts)
            done = 0
            while n + len(ids) - done >= shape.batch:
                held.append((ids[done : done + shape.batch - n], keys[:, done : done + shape.batch - n]))
                yield np.concatenate([i for i, _ in held]), np.concatenate([f for _, f in held], axis=1)
                done, n, held = done + shape.batch - n, 0, []
            if done < len(ids):
                held.append((ids[done:], keys[:, done:]))
                n += len(ids) - done
    if held:
        yield np.concatenate([i for i, _ in held]), np.concatenate([f for _, f in held], axis=1)


def _train(model, shape: Shape):
    """The sums of gradient and count of the classes' features, and of gradient and curvature of the trees', over a task's rows. model: a broadcast Model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        index, seen = Indexer(m.head, shape), False
        weights = _by_class(m.weights)
        gradient, times = _by_class(np.zeros(weights.shape, np.float32)), np.zeros(weights.shape[:2], np.float32)
        inner, curve = (np.zeros(m.trees.weights.shape, np.float32) for _ in range(2))
        for ids, keys in _batches(batches, index, shape):
            own, seen, features = m.class_of(ids), True, (keys % np.uint32(shape.slots)).astype(np.intp)
            m.trees.slope(inner, curve, m.leaf_of(ids), keys)
            slope = np.empty((m.n_classes(), len(ids)), np.float64)
            for at in range(0, len(ids), CLASS_BLOCK):
                z = np.exp(_logits(weights, m.bias, features[:, at : at + CLASS_BLOCK]))
                np.divide(z, z.sum(axis=0), out=slope[:, at : at + CLASS_BLOCK])
            slope[own, np.arange(len(own))] -= 1
            for k in range(TEMPLATES):
                times[k] += np.bincount(features[k], minlength=shape.slots)
                for j, miss in enumerate(slope):
                    gradient[k, :, j] += np.bincount(features[k], miss, shape.slots)
        if seen:
            yield from _parts(np.concatenate([x.reshape(-1) for x in (gradient, times, inner, curve)]))

    return run


def _stepped(m: Model, sums: np.ndarray, rate: float, turn_rate: float) -> Model:
    """The model after one step along the sums of _train."""
    n_times, n_inner = TEMPLATES * m.shape.slots, m.trees.weights.size
    gradient, times, inner, curve = np.split(sums, np.cumsum([m.weights.size, n_times, n_inner]))
    move = np.float32(rate) * gradient.reshape(m.weights.shape)
    move /= (times + np.float32(DAMPING)).reshape(TEMPLATES, -1, 1)
    turn = np.float32(turn_rate) * inner
    turn /= curve + np.float32(TURN_DAMPING)
    weights, turns = m.weights - move.clip(-FARTHEST, FARTHEST, out=move), m.trees.weights + turn.clip(-FARTHEST, FARTHEST, out=turn).reshape(m.trees.weights.shape)
    return replace(m, weights=weights, trees=replace(m.trees, weights=turns))


def _most_frequent(counts: DataFrame, most: int) -> list:
    """The most frequent words, at most so many: those above a level of frequency. Levels are 64 to a doubling, so few counts reach the driver to choose one."""
    level = F.floor(F.log2("n") * 64).cast("int")
    found, lowest = 0, 1 << 20
    for row in sorted(counts.groupBy(level.alias("level")).count().collect(), key=lambda r: -r["level"]):
        found += row["count"]
        if found > most:
            break
        lowest = row["level"]
    return sorted(counts.filter(level >= lowest).collect(), key=lambda r: (-r["n"], bytes(r["word"])))


def fit(train: DataFrame, counts: DataFrame, total: int, shape: Shape, rounds: tuple[tuple[int, float, float], ...] = ROUNDS) -> Model:
    """train: doc_id, text of the training rows. counts: word, n. rounds: each one's share of the rows and steps."""
    top = _most_frequent(counts, shape.head)
    head, n = [bytes(r["word"]) for r in top], np.array([r["n"] for r in top], np.float64)
    context = train.sparkSession.sparkContext
    few = TASKS_A_CORE * context.defaultParallelism  # tasks, so that their arrays stay few beside the rows
    profiles = _summed(train.select("text").coalesce(few).mapInArrow(_profiles(head, shape), "part int, task int, data binary"), few)
    profiles = None if profiles is None else profiles.reshape(shape.head, shape.anchors)
    own = classes(head, n, profiles, shape)
    n_classes = 2 + shape.clusters * shape.bands
    mass = np.bincount(own, n, minlength=n_classes) if len(head) else np.zeros(n_classes)
    mass[0] = total - n.sum() + 1
    inner = np.log10(n / mass[own]) if len(head) else n
    grouped = np.ones(shape.groups)
    for r in counts.groupBy((F.crc32("word") % shape.groups).alias("at")).agg((F.sum("n") + F.count("*")).alias("n")).collect():
        grouped[r["at"]] += r["n"]
    np.subtract.at(grouped, np.array([zlib.crc32(w) % shape.groups for w in head], int), n + 1)
    trees = grow(np.concatenate((own, np.zeros(shape.groups, own.dtype))), np.concatenate((n, grouped)), shape.turns)
    bias = np.log((mass + 0.5) / (mass + 0.5).sum()).astype(np.float32)
    model = Model(shape, head, own, inner, np.log10(n + 1), np.zeros((TEMPLATES, shape.slots, n_classes), np.float32), bias, trees, np.log10(grouped))
    before = 0
    fold = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(sum(share for share, _, _ in rounds)))
    for share, rate, turn_rate in rounds:
        sent = context.broadcast(model)
        part = train.filter((fold >= before) & (fold < before + share)).select("text").coalesce(few)
        sums = _summed(part.mapInArrow(_train(sent, shape), "part int, task int, data binary"), few)
        before += share
        sent.destroy()  # else the driver keeps its copy until its JVM collects garbage
        if sums is not None:
            model = _stepped(model, sums, rate, turn_rate)
    return model


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        index, shape = Indexer(m.head, m.shape), m.shape
        base, n_head, weights = m.base, len(m.head), _by_class(m.weights)
        for whole in batches:
            for begin, end in _slices(whole.column(1)):
                batch = whole.slice(begin, end - begin)
                words, starts = token_table(batch.column(1))
                ids, of, kinds = index(words)
                keys, own, leaves = history(ids, WIDE, starts), m.class_of(ids), m.leaf_of(ids)
                known, sizes = ids < n_head, np.diff(starts, append=len(ids))
                score = np.empty(len(ids))
                for at in range(0, len(ids), CLASS_BLOCK):
                    near = slice(at, at + CLASS_BLOCK)
                    features = (keys[:, near] % np.uint32(shape.slots)).astype(np.intp)
                    score[near] = _log_share(_logits(weights, m.bias, features), own[near])
                for at in range(0, len(ids), BLOCK):
                    score[at : at + BLOCK] += m.trees.log_share(leaves[at : at + BLOCK], keys[:, at : at + BLOCK])
                others = np.flatnonzero(~known)
                score /= math.log(10)
                score[others] -= m.shared[leaves[others] - n_head]
                counted = np.where(known, base[np.where(known, ids, 0)], 0) if n_head else np.zeros(len(ids))
                found = [np.add.reduceat(x, starts) for x in (score, counted, known.astype(np.int64))]
                row = np.repeat(np.arange(len(sizes)), sizes)[others]
                pairs, times = np.unique(row * len(kinds) + of[others], return_counts=True)  # each text's words beyond the head
                lengths = np.bincount(pairs // len(kinds), minlength=len(sizes))
                rare = pa.StructArray.from_arrays([kinds.take(pa.array(pairs % len(kinds))), pa.array(times, pa.int32())], ["word", "times"])
                rows = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *lengths]).astype(np.int32)), rare)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(found[0]), pa.array(found[1]), pa.array(found[2], pa.int64()), rows], ["doc_id", "n_tokens", "score", "base", "known", "rare"])

    return run


def score_documents(docs: DataFrame, folds: int = 7, held_out: int = 2, shape: Shape | None = None, rounds: tuple[tuple[int, float, float], ...] = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row, learned from the rows whose crc32(doc_id as text) mod folds isn't held_out.

    base_score: log10 probability under add-one counts of single tokens. score: under the model. Without a shape, it follows the counts.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    train = docs.filter(crc32_mod(F.col("doc_id"), folds) != held_out)
    counts = materialize(train.select("text").mapInArrow(_count(), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "counts")
    stats = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    total, kinds = int(stats[0]), int(stats[1])
    model = fit(train, counts, total, shape or Shape.of(total, kinds), rounds)
    base_log = math.log10(total + kinds + 1)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id long, n_tokens long, score double, base double, known long, rare array<struct<word: binary, times: int>>"
    del model
    partial = materialize(docs.mapInArrow(_score(sent), schema).withColumn("row", F.monotonically_increasing_id()), "partial")
    sent.destroy()
    rare = partial.select("row", F.inline("rare")).join(counts.hint("shuffle_hash"), "word", "left")
    times, n = F.col("times"), F.coalesce("n", F.lit(0))
    tails = rare.groupBy("row").agg(F.sum(times * F.log10(n + 1)).alias("tail"), F.sum(F.when(n > 0, times).otherwise(0)).alias("tail_known"))
    joined = partial.drop("rare").join(tails, "row", "left")
    tail = F.coalesce("tail", F.lit(0.0))
    return joined.select(
        "doc_id",
        (crc32_mod(F.col("doc_id"), folds) == held_out).alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("tail_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + tail - F.col("n_tokens") * F.lit(base_log)).alias("base_score"),
        (F.col("score") + tail).alias("score"),
    )
