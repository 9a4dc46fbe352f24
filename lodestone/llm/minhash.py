"""Near-duplicate documents by b-bit MinHash.

A document is the set of its distinct word shingles. Its minima under n_bands * band_rows hash functions give band
keys, for candidates, and a packed signature of the low bits of the remixed minima, for a collision-corrected estimate
of the similarity by bit counts. An odd sketch beside it has a bit for the parity of each bucket of the set, so the bits in which two
differ are at most the elements that one set has and the other hasn't; pairs that differ in too many aren't candidates, which
loses nothing in short texts and less than one pair in a million in long ones. Copies with equal sets count once, as the smallest id, and get their component by a
join at the end. Only pairs whose estimate is high enough are confirmed on their full sets:

1. Every document is compared with the smallest id of each of its bands, and the one with the best estimate is
   confirmed. A group of near copies is linked by one pair a document here, however large it is.
2. Bands whose documents are in several components yet are compared across components: in a first wave the few best
   estimates of each document that isn't in its band's largest component, and, once their links are settled, all that is left.
   Bands are read in tiles of a fixed size, of which those within a band's largest component are never made, and pairs
   are streamed, never gathered.

Pairs are confirmed by the documents' ids: the first one's set is held, at most chunk others stream past it, and a
document with more partners is dealt to several tasks. So no task's memory grows with a group or a band.

With 24 bands of 4 rows a pair at similarity 0.8 shares no band once in 300,000 times; the estimate's margin is five
standard errors.

Results for odd input: a null, empty or blank text has an empty set and is linked with nothing; a text with fewer words
than a shingle has its whole sequence as the one shingle; rows that share an id and have words are one document for linking; a row
without an id is linked with nothing and kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import ASCII_LOWER, given_back, materialize, release, WordCache
from lodestone.llm.graph import components

_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
_S = [np.uint64(x) for x in (29, 31, 32)]


class Shingler:
    """Texts to sorted arrays of distinct 64-bit shingle hashes."""

    def __init__(self, width: int):
        self.width = width
        self.words = WordCache(lambda w: hashlib.blake2b(w, digest_size=8).digest())

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").translate(ASCII_LOWER).split()
        hashes = np.frombuffer(b"".join(map(self.words.__getitem__, words)), "<u8")
        if not len(hashes):
            return hashes
        width = min(self.width, len(hashes))
        n = len(hashes) - width + 1
        out = np.full(n, width, np.uint64)
        for k in range(width):  # position-dependent, as each step mixes what came before
            out = (out ^ (out >> _S[0])) * _MIX[0] + hashes[k : k + n]
            out = (out ^ (out >> _S[1])) * _MIX[1]
        out = (out ^ (out >> _S[2])) * _MIX[2]
        return np.unique(out ^ (out >> _S[0]))


class Signer:
    """Band keys and signature of a set: the packed low bits of the minima, words longs for each bit plane, padded by zeros, then the odd sketch."""

    def __init__(self, n_bands: int, band_rows: int, bits: int, odd: int = 1024, seed: int = 1):
        draw = np.random.default_rng(seed)
        n = n_bands * band_rows
        self.a = draw.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.b = draw.integers(0, 1 << 32, n, dtype=np.uint32)
        self.shape, self.bits = (n_bands, band_rows), bits
        self.words, self.odd = -(-n // 64), odd
        self.salt = np.arange(1, n_bands + 1, dtype=np.uint64) * _MIX[1]

    def minima(self, shingles: np.ndarray) -> np.ndarray:
        low = (shingles >> np.uint64(32)).astype(np.uint32)
        found = np.full(len(self.a), 0xFFFFFFFF, np.uint32)
        for at in range(0, len(low), 2048):
            np.minimum(found, (low[at : at + 2048, None] * self.a + self.b).min(axis=0), out=found)
        return found

    def __call__(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        least = self.minima(shingles)
        keys = self.salt.copy()
        for column in least.reshape(self.shape).T.astype(np.uint64):
            keys = (keys ^ (keys >> _S[0])) * _MIX[0] + column
            keys = (keys ^ (keys >> _S[1])) * _MIX[1]
        low = (least * np.uint32(0x9E3779B1)) >> np.uint32(32 - self.bits)  # bits of the remixed minimum
        planes = np.zeros((self.bits, 64 * self.words), np.uint8)
        planes[:, : len(low)] = (low >> np.arange(self.bits, dtype=np.uint32)[:, None]) & np.uint32(1)
        parity = np.bincount((shingles & np.uint64(self.odd - 1)).astype(np.intp), minlength=self.odd) & 1
        return (keys ^ (keys >> _S[2])).view(np.int64), np.packbits(np.concatenate((planes.reshape(-1), parity.astype(np.uint8)))).view(np.int64)


def estimates(one: np.ndarray, many: np.ndarray, bits: int, minima: int) -> np.ndarray:
    """Similarities of packed signatures, corrected for chance collisions. one: (i, 1, w), many: (1, j, w) of int64, bit planes first."""
    per = -(-minima // 64)
    differ = one[..., :per] ^ many[..., :per]
    for k in range(1, bits):
        differ = differ | (one[..., k * per : k * per + per] ^ many[..., k * per : k * per + per])
    same = 1 - np.bitwise_count(differ.view(np.uint64)).sum(axis=-1, dtype=np.int32) / minima
    return (same - 2.0**-bits) / (1 - 2.0**-bits)


def estimate(one: str, other: str, bits: int, minima: int) -> Column:
    """estimates() of the signatures in columns one and other, arrays of longs."""
    per = -(-minima // 64)
    differ = F.lit(0)
    for k in range(per):
        planes = [F.element_at(one, j * per + k + 1).bitwiseXOR(F.element_at(other, j * per + k + 1)) for j in range(bits)]
        either = planes[0]
        for plane in planes[1:]:
            either = either.bitwiseOR(plane)
        differ = differ + F.bit_count(either)
    return (1 - differ / minima - 2.0**-bits) / (1 - 2.0**-bits)


def _most_odd(both, per: int, of: int, odd: int, exp, least):
    """How many bits the odd sketches of sets that are linked differ in, at most; both: the sum of their sizes.

    No more than the elements not in common, and within five standard deviations of what so many leave of the sketch.
    """
    apart = both * (of - per) / (of + per)
    return least(apart, odd / 2 * (1 - exp(-2 * apart / odd)) + 2.5 * math.sqrt(odd))


def odd_apart(one: str, other: str, begin: int, odd: int) -> Column:
    """Bits in which the odd sketches of the signatures differ."""
    words = [F.bit_count(F.element_at(one, begin + k + 1).bitwiseXOR(F.element_at(other, begin + k + 1))) for k in range(odd // 64)]
    return reduce(lambda a, b: a + b, words)


def features(docs: DataFrame, width: int, n_bands: int, band_rows: int, bits: int, odd: int) -> DataFrame:
    """doc_id, n (size of the set), set_key (16 bytes, equal for equal sets), bands and signature; neither of the last two for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, signer = Shingler(width), Signer(n_bands, band_rows, bits, odd)
        none = np.empty(0, np.int64)

        def lists(arrays: list[np.ndarray]) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, arrays)]).astype(np.int32)), pa.array(np.concatenate([none, *arrays])))

        for batch in batches:
            sizes, keys, bands, signed = [], [], [], []
            for text in batch.column(1):
                shingles = shingler(text.as_py())
                sizes.append(len(shingles))
                keys.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                band, signature = signer(shingles) if len(shingles) else (none, none)
                bands.append(band)
                signed.append(signature)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), lists(bands), lists(signed)], ["doc_id", "n", "set_key", "bands", "signature"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(given_back(run), "doc_id long, n long, set_key binary, bands array<long>, signature array<long>")


_HELD = "a long, salt int, role int, id long, text string"
_PAIR = "a long, b long"


def _confirm(width: int, per: int, of: int):
    """Rows are sorted by a, salt and role: the texts of a (role 0), then those of its partners. Gives the pairs that are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, current, held = Shingler(width), None, []
        for batch in batches:
            firsts, seconds = [], []
            keys = zip(*(batch.column(k).to_pylist() for k in range(4)))
            for (a, salt, role, b), text in zip(keys, batch.column(4)):
                if (a, salt) != current:
                    current, held = (a, salt), []
                own = shingler(text.as_py())
                if not len(own):
                    continue
                if role == 0:
                    if not any(np.array_equal(own, x) for x in held):  # an id that is repeated with other texts has several sets
                        held.append(own)
                    continue
                for x in held:
                    if of * min(len(x), len(own)) < per * max(len(x), len(own)):
                        continue
                    common = int(np.count_nonzero(x[np.minimum(np.searchsorted(x, own), len(x) - 1)] == own))
                    if of * common >= per * (len(x) + len(own) - common):
                        firsts.append(a)
                        seconds.append(b)
                        break
            yield pa.RecordBatch.from_arrays([pa.array(firsts, pa.int64()), pa.array(seconds, pa.int64())], ["a", "b"])

    return run


def confirm(pairs: DataFrame, docs: DataFrame, width: int, per: int, of: int, chunk: int = 1000, most_sent: int = 100_000) -> DataFrame:
    """The pairs (a, b), a stored table, whose documents' full sets are similar enough.

    chunk: partners of a that one task group reads. most_sent: rows up to which the list of texts to fetch is broadcast; beyond it the texts are shuffled.
    """
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / chunk).cast("int").alias("parts"))
    salted = pairs.join(parts, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("salt"))
    wanted = salted.select("a", "salt", F.lit(0).alias("role"), F.col("a").alias("id")).distinct().union(salted.select("a", "salt", F.lit(1), "b"))
    if pairs.count() <= most_sent // 2:  # at most two rows a pair
        wanted = F.broadcast(wanted)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    held = texts.join(wanted, F.col("doc_id") == F.col("id")).select("a", "salt", "role", "id", "text")
    return held.repartition("a", "salt").sortWithinPartitions("a", "salt", "role").mapInArrow(given_back(_confirm(width, per, of)), _PAIR)


def _across(bits: int, minima: int, odd: int, per: int, of: int, least: float, top: int | None, rows: int = 64):
    """Rows are sorted by band and tile, side 0 before side 1. Gives the pairs across components that may be linked by their estimate, which is least or more, and odd sketches; top: of each row of side 0 only so many, the best."""
    begin = bits * -(-minima // 64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, sides = None, ([], [])

        def found() -> Iterator[pa.RecordBatch]:
            left, right = sides[0], sides[1] or sides[0]
            if not left or not right:
                return
            ids, where, sizes, signed = (np.array([r[k] for r in right]) for k in range(4))
            for at in range(0, len(left), rows):
                i, w, n, s = (np.array([r[k] for r in left[at : at + rows]]) for k in range(4))
                guess = estimates(s[:, None], signed[None], bits, minima)
                small, large = np.minimum(n[:, None], sizes), np.maximum(n[:, None], sizes)
                x, y = np.nonzero((guess >= least) & (w[:, None] != where) & (of * small >= per * large))
                apart = np.bitwise_count((s[x, begin:] ^ signed[y, begin:]).view(np.uint64)).sum(axis=1)
                near = apart <= _most_odd(n[x] + sizes[y], per, of, odd, np.exp, np.minimum)
                x, y = x[near], y[near]
                if top:
                    order = np.lexsort((-guess[x, y], x))
                    x, y = x[order], y[order]
                    turn = np.arange(len(x)) - np.searchsorted(x, x)
                    x, y = x[turn < top], y[turn < top]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(i[x], ids[y])), pa.array(np.maximum(i[x], ids[y]))], ["a", "b"])

        for batch in batches:
            band, i, j, side, *values = (c.to_pylist() for c in batch.columns)
            for key, at, value in zip(zip(band, i, j), side, zip(*values)):
                if key != current:
                    yield from found()
                    current, sides = key, ([], [])
                sides[at].append(value)
        yield from found()

    return run


def across(members: DataFrame, labels: DataFrame, cards: DataFrame, tile: int, run) -> DataFrame:
    """Candidate pairs of bands whose members are in several components. members: band, rep. labels: node, component. cards: rep, n, signature. run: from _across."""
    named = members.join(labels, F.col("rep") == F.col("node"), "left").select("band", "rep", F.coalesce("component", "rep").alias("component"))
    shares = named.groupBy("band", "component").agg(F.count("*").alias("n_own"))
    largest = shares.groupBy("band").agg(F.max(F.struct("n_own", "component")).alias("top"), F.sum("n_own").alias("n_all")).filter("n_all > top.n_own")
    parts = lambda n: F.ceil(n / tile).cast("int")
    bounds = largest.select("band", F.col("top.component").alias("main"), parts(F.col("n_all") - F.col("top.n_own")).alias("few"), parts(F.col("top.n_own")).alias("many"))
    placed = named.join(bounds, "band").withColumn("is_main", F.col("component") == F.col("main"))
    part = F.pmod(F.xxhash64("rep"), F.when(F.col("is_main"), F.col("many")).otherwise(F.col("few"))).cast("int")
    where = lambda i, j, side: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(side).alias("side"))
    minor = F.concat(  # the rest of the band by itself, and against the largest component
        F.transform(F.sequence(F.col("part"), F.col("few") - 1), lambda j: where(F.col("part"), j, 0)),
        F.filter(F.transform(F.sequence(F.lit(0), F.col("part")), lambda i: where(i, F.col("part"), 1)), lambda t: t["i"] != t["j"]),
        F.transform(F.sequence(F.col("few"), F.col("few") + F.col("many") - 1), lambda j: where(F.col("part"), j, 0)),
    )
    main = F.transform(F.sequence(F.lit(0), F.col("few") - 1), lambda i: where(i, F.col("few") + F.col("part"), 1))
    tiles = placed.withColumn("part", part).select("band", "rep", "component", F.inline(F.when(F.col("is_main"), main).otherwise(minor)))
    rows = tiles.join(cards, "rep").select("band", "i", "j", "side", "rep", "component", "n", "signature")
    return rows.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j", "side").mapInArrow(given_back(run), _PAIR).distinct()


def near_duplicates(docs: DataFrame, width: int = 5, per: int = 80, of: int = 100, n_bands: int = 24, band_rows: int = 4, bits: int = 2, odd: int = 1024, margin: float = 0.25, tries: int = 4, chunk: int = 1000, tile: int = 4096) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of docs.

    Documents are linked if of * intersection >= per * union; component_id is the smallest doc_id reachable.
    width: words of a shingle. bits: low bits kept of each minimum. odd: bits of the odd sketch, a power of two. margin: how far below the threshold an estimate may be.
    tries: candidates of a document in a tile that are settled before all others are looked at. chunk, tile: partners of a document, and rows of a band's side, that one group reads.
    """
    minima, least = n_bands * band_rows, per / of - margin
    found = materialize(features(docs, width, n_bands, band_rows, bits, odd), "features")
    usable = found.filter("n > 0 and doc_id is not null")
    classes = materialize(usable.groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.first("bands").alias("bands"), F.first("signature").alias("signature")), "classes")
    cards = classes.select("rep", "n", "signature")
    banded = classes.select("rep", F.explode("bands").alias("band"))
    hubs = banded.groupBy("band").agg(F.min("rep").alias("hub"), F.max("rep").alias("last")).filter("hub != last")
    members = materialize(banded.join(hubs, "band").select("band", "rep", "hub"), "members")

    one, other = (cards.select(F.col("rep").alias(c), F.col("n").alias(f"n_{c}"), F.col("signature").alias(f"signature_{c}")) for c in "ab")
    stars = members.filter("rep != hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct().join(other, "b").join(one, "a")
    guess = estimate("signature_a", "signature_b", bits, minima)
    begin = bits * -(-minima // 64)
    alike = odd_apart("signature_a", "signature_b", begin, odd) <= _most_odd(F.col("n_a") + F.col("n_b"), per, of, odd, F.exp, F.least)
    near = stars.withColumn("guess", guess).filter((F.col("guess") >= least) & (of * F.least("n_a", "n_b") >= per * F.greatest("n_a", "n_b")) & alike)
    best = materialize(near.groupBy("b").agg(F.max(F.struct("guess", (-F.col("a")).alias("a"))).alias("best")).select((-F.col("best.a")).alias("a"), "b"), "pairs")
    links = [materialize(confirm(best, docs, width, per, of, chunk), "links")]
    release(best)

    labels = components(links[0])
    for top in (tries, None):
        pairs = materialize(across(members.select("band", "rep"), labels, cards, tile, _across(bits, minima, odd, per, of, least, top)), "pairs")
        if pairs.isEmpty():
            break  # where no document has a candidate, there is none
        links.append(materialize(confirm(pairs, docs, width, per, of, chunk), "links"))
        release(pairs)
        if not links[-1].isEmpty():
            release(labels)
            labels = components(_union(links))
    release(members)

    owners = classes.select("set_key", "rep")
    repeated = usable.groupBy("doc_id").agg(F.min(F.xxhash64("set_key")).alias("low"), F.max(F.xxhash64("set_key")).alias("high")).filter("low != high").select("doc_id")
    shared = usable.select("doc_id", "set_key").join(repeated, "doc_id").join(owners, "set_key")
    same_id = materialize(shared.join(shared.groupBy("doc_id").agg(F.min("rep").alias("a")), "doc_id").select("a", F.col("rep").alias("b")).distinct(), "same_id")
    if not same_id.isEmpty():
        release(labels)
        labels = components(_union([*links, same_id]))
    release(*links, same_id)
    placed = owners.join(labels, F.col("rep") == F.col("node"), "left").select("set_key", F.coalesce("component", "rep").alias("component"))
    component = F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("component")), F.col("doc_id"))
    out = found.select("doc_id", "n", "set_key").join(placed, "set_key", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def _union(tables: list[DataFrame]) -> DataFrame:
    first, *rest = tables
    for table in rest:
        first = first.union(table)
    return first
