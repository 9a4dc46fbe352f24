"""Training-data operators against brute force, on small tables with nulls, empty and long texts, ties and repeats."""

import hashlib
import math
import os
import random
import re
import sys
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestone.llm import html, linededup, maxent, minhash, mixing, packing, topk, toxicity, trie_dedup, urlfilter
from lodestone.llm.common import ASCII_LOWER

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, taken string"


def table(spark, rows):
    """documents with two extra columns that clash with results' names."""
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), True, "x") for i, t, s in rows], DOCS)


def words(draw, n, vocabulary=400):
    return [f"w{draw.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="module")
def odd(spark):
    draw = random.Random(5)
    long = " ".join(words(draw, 3000))
    rows = [(k, " ".join(words(draw, 20)) + "\n" + " ".join(words(draw, 15)), f"s{k % 4}") for k in range(60)]
    rows += [(100, None, "s0"), (101, "", "s0"), (102, "  \n ", None), (103, long, None), (104, long.upper(), "s1"), (105, "one two", "s1"), (106, "ONE two", "s2"), (107, "ünï çödé <|endoftext|> x  y", "s2"), (3, rows[3][1], "s3"), (None, "no id here", "s3"), (None, None, None)]
    return rows


def empty(spark):
    return table(spark, [])


def grouped(rows, key):
    out = defaultdict(list)
    for r in rows:
        out[key(r)].append(r)
    return out


def test_exact_dedup(spark, odd):
    found = trie_dedup.exact_dedup(table(spark, odd), keep="max", budget=2000).collect()
    assert len(found) == len(odd)
    low = lambda t: (t or "").encode().translate(ASCII_LOWER)
    groups = grouped(odd, lambda r: low(r[1]))
    expected = Counter()
    for text, members in groups.items():
        owner = max((m[0] for m in members if m[0] is not None), default=None)
        for m in members:
            expected[m[0], owner, len(members), m[0] == owner, hashlib.sha256(text).hexdigest()] += 1
    assert Counter(tuple(r) for r in found) == expected
    assert trie_dedup.exact_dedup(empty(spark)).count() == 0


def test_trie_spills_by_subtree():
    draw = random.Random(1)
    keys = [bytes(draw.choices(b"abc", k=draw.randrange(0, 12))) for _ in range(3000)]
    for budget in (1 << 30, 20_000, 3000, 0):
        trie = trie_dedup.PatriciaTrie(min, budget)
        for k, key in enumerate(keys):
            trie.insert(key, k)
        found = {key: (owner, count) for key, owner, count in trie.drain()}
        assert found == {key: (keys.index(key), n) for key, n in Counter(keys).items()}


def test_mix(spark, odd):
    rows = mixing.mix(table(spark, odd)).collect()
    again = mixing.mix(table(spark, odd).repartition(7)).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again)) and len(rows) == len(odd)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r["doc_id"], r["size"]) for r in rows) == Counter((i, size(t)) for i, t, _ in odd)
    by = grouped(rows, lambda r: r["source"])
    sizes = {s: sum(r["size"] for r in m) for s, m in by.items()}
    order = sorted((s for s in by if s is not None)) + [None]
    weight, caps = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}, {s: 2.0 * n for s, n in sizes.items()}
    low, high = 0.0, 1e9  # the water level, by halving
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(caps[s], mid * weight[s]) for s in order) < 1.5 * sum(sizes.values()) else (low, mid)
    for s, members in by.items():
        assert members[0]["target"] == pytest.approx(min(caps[s], low * weight[s])) and members[0]["source_size"] == sizes[s]
        assert all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in members)
        assert abs(sum(r["taken"] for r in members) - members[0]["target"]) <= max(r["size"] for r in members)
    assert mixing.mix(empty(spark)).count() == 0


def test_pack(spark, odd):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path("byte_bpe_50k.json"))
    rows = packing.pack_documents(table(spark, odd), open_bins=4, pieces_per_task=16).collect()
    expected = Counter()
    for i, t, _ in odd:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        at, first = 0, len(ids) % 1024 or 1024
        for piece, to in enumerate([*range(first, len(ids), 1024), len(ids)] if len(ids) > 1024 else [len(ids)]):
            expected[i, piece, at, to - at, zlib.crc32(ids[at:to].tobytes())] += 1
            at = to
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == expected
    for members in grouped(rows, lambda r: r["sequence_id"]).values():
        at = 0
        for r in sorted(members, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
    n = len({r["sequence_id"] for r in rows})
    assert n <= math.ceil(1.05 * sum(r["length"] for r in rows) / 1024) + 1
    assert packing.pack_documents(empty(spark)).count() == 0


def test_open_bins_are_bounded_and_the_fullest_closes():
    bins = packing.OpenBins(10, 2)
    assert bins.put("a", 6) is None and bins.put("b", 7) is None and bins.put("c", 8) == ["b"] and bins.open == 2
    assert bins.put("d", 4) == ["a", "d"] and bins.put("e", 2) == ["c", "e"] and not bins.bits


def test_placements_equal_a_plain_loop():
    draw = random.Random(4)
    lengths = [min(1023, int(draw.lognormvariate(5, 1)) + 1) for _ in range(5000)]
    bins, found = packing.OpenBins(1024, 16), []
    for k, n in enumerate(lengths):
        closed = bins.put(k, n)
        if closed:
            found.append(closed)
    assert bins.closed_early > 0
    found += [items for _, items in bins.rest()]
    open_, closed = [], []  # plain: [free, items], the latest of equals first
    for k, n in enumerate(lengths):
        fits = [b for b in open_ if b[0] >= n]
        if fits:
            best = min(fits, key=lambda b: b[0])
            best = [b for b in fits if b[0] == best[0]][-1]
            open_.remove(best)
        else:
            if len(open_) == 16:
                least = min(b[0] for b in open_)
                fullest = [b for b in open_ if b[0] == least][-1]
                open_.remove(fullest)
                closed.append(fullest[1])
            best = [1024, []]
        best = [best[0] - n, [*best[1], k]]
        (open_ if best[0] else closed).append(best if best[0] else best[1])
    assert sorted(found) == sorted([*closed, *(b[1] for b in open_)])


def test_bins_close_in_a_large_table(spark):
    draw = random.Random(5)
    rows = [(k, 0, 0, min(1023, int(draw.lognormvariate(5, 1)) + 1), k) for k in range(20_000)]
    pieces = spark.createDataFrame(rows, packing.PIECE)
    found = packing.pack(pieces, open_bins=64).collect()
    free = Counter()
    for r in found:
        free[r["sequence_id"]] += r["length"]
    least = sum(r[3] for r in rows) / 1024
    assert len(found) == len(rows) and max(free.values()) <= 1024 and len(free) <= 1.01 * least
    assert sum(1 for n in free.values() if n < 1024) > 2 * 64  # more than stayed open: the fullest closed before


def test_top_k(spark):
    draw = np.random.default_rng(2)
    rows = [(int(k), [float(x) for x in np.round(draw.normal(size=4) * (1 + k % 3), 1)]) for k in range(300)]
    rows += [(400, rows[100][1]), (500, [0.0] * 4), (501, None), (502, [1.0, None, 2.0, 3.0]), (503, [1.0, float("nan"), 2.0, 3.0]), (600, [1.0, 2.0]), (601, [3.0, -4.0]), (None, [1.0] * 4), (7, rows[7][1])]
    made = spark.createDataFrame([(i, v, i) for i, v in rows], "vec_id long, embedding array<double>, score long")
    found = [tuple(r) for r in topk.top_k(made, lambda c: c % 100 == 0, block_rows=16, n_pivots=5).collect()]
    good = {i: np.floor(1024 * np.array(v)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all()}
    expected = []
    for q in (i for i in good if i % 100 == 0):
        scored = sorted((-int(good[q] @ v), i) for i, v in good.items() if i != q and len(v) == len(good[q]))[:10]
        expected += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scored)]
    assert sorted(found) == sorted(expected)
    assert topk.top_k(made.limit(0), lambda c: c % 100 == 0).count() == 0


def test_top_k_leaves_blocks_out(spark, caplog):
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(20, 16))
    x = np.repeat(centres, 100, axis=0) + 0.02 * draw.normal(size=(2000, 16))
    made = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    with caplog.at_level("INFO", "lodestone.llm.topk"):
        found = [tuple(r) for r in topk.top_k(made, lambda c: c % 100 == 0, block_rows=16, n_pivots=24, page_rows=7, widen=3).collect()]
    q = np.floor(1024 * x)
    expected = []
    for k in range(0, 2000, 100):
        scored = sorted((-int(q[k] @ q[j]), j) for j in range(2000) if j != k)[:10]
        expected += [(k, n + 1, j, -s) for n, (s, j) in enumerate(scored)]
    assert sorted(found) == sorted(expected)
    visits, pairs = caplog.records[-1].args
    assert 0 < visits < 0.5 * pairs


def test_scores_beyond_doubles_are_exact():
    draw = np.random.default_rng(7)
    a, b = draw.integers(-(1 << 27), 1 << 27, (3, 40)), draw.integers(-(1 << 27), 1 << 27, (5, 40))
    assert topk._scores(a.astype(float), b.astype(float)).tolist() == [[sum(int(x) * int(y) for x, y in zip(q, v)) for v in b] for q in a]
    assert topk._scores(np.full((1, 2), 2.0**40), np.full((1, 2), 2.0**40)).tolist() == [[(1 << 63) - 1]]


def edits(a, b):
    """Edit distance over words."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_line_dedup(spark):
    draw = random.Random(8)
    bases = [words(draw, 12 + k, 30) for k in range(6)] + [["a", "b"], ["same"] * 11]
    rows = []
    for d in range(60):
        lines = []
        for _ in range(draw.randrange(5)):
            line = list(draw.choice(bases))
            for _ in range(draw.randrange(3)):
                at = draw.randrange(len(line))
                draw.choice([lambda: line.pop(at), lambda: line.insert(at, "new"), lambda: line.__setitem__(at, f"x{draw.randrange(3)}"), lambda: line.reverse()])()
                line = line or ["z"]
            lines.append(draw.choice(["", " ", "\t"]) + " ".join(line))
        rows.append((draw.randrange(1000), "\n".join(lines), "s"))
    rows = list({r[0]: r for r in rows}.values()) + [(2000, None, "s"), (2001, "", "s"), (2002, "\n \n", "s"), (2003, " ".join(["long"] * 4000), "s"), (None, "first of all\nx", "s")]
    rows.append(rows[0])
    found = linededup.dedup_lines(table(spark, rows)).collect()
    assert found[0].__fields__ == ["doc_id", "text", "lang", "source", "n_chars", "kept", "taken", "n_lines", "n_removed"]
    seen, expected = [], {}
    for i, t, _ in sorted({(r[0], r[1]): r for r in rows}.values(), key=lambda r: (r[0] is not None, r[0])):
        kept = []
        for line in (t or "").split("\n"):
            w = line.split()
            if not w:
                kept.append(line)
                continue
            near = any(w == s or (min(len(w), len(s)) >= 10 and abs(len(w) - len(s)) < 2 and edits(w, s) <= 1) for s in seen if " ".join(w) == " ".join(s) or len(s) >= 10)
            if not near:
                kept.append(line)
            seen.append(w)
        expected[i] = None if t is None else "\n".join(kept)
    assert {r["doc_id"]: r["text"] for r in found} == expected and len(found) == len(rows)
    assert any(r["n_removed"] for r in found) and all(0 <= r["n_removed"] <= r["n_lines"] for r in found)
    assert linededup.dedup_lines(empty(spark)).count() == 0


def shingles(text, width):
    w = (text or "").encode().translate(ASCII_LOWER).split()
    return {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()


def brute_components(rows, width, per=80, of=100):
    sets, parent = [(i, shingles(t, width)) for i, t in rows if i is not None], {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and of * len(a & b) >= per * len(a | b) and root(i) != root(j):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return {i: root(i) for i in parent}


@pytest.mark.parametrize("chunk, tile", [(1000, 4096), (3, 2)])
def test_near_duplicates(spark, odd, chunk, tile):
    draw = random.Random(9)
    rows = [(i, t) for i, t, _ in odd]
    for g in range(6):
        base = words(draw, 60, 5000)
        for k in range(14):
            w = list(base)
            for _ in range(draw.randrange(5)):
                w[draw.randrange(len(w))] = f"e{draw.randrange(9999)}"
            rows.append((1000 + 20 * g + k, " ".join(w)))
    found = minhash.near_duplicates(table(spark, [(i, t, "s") for i, t in rows]), width=4, chunk=chunk, tile=tile).collect()
    expected = brute_components(rows, 4)
    assert {r["doc_id"]: r["component_id"] for r in found if r["doc_id"] is not None} == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found) and len(found) == len(rows)
    assert Counter((r["doc_id"], r["n_shingles"]) for r in found) == Counter((i, len(shingles(t, 4))) for i, t in rows)
    if chunk > 3:
        assert minhash.near_duplicates(empty(spark)).count() == 0


def test_estimates_are_close():
    draw = np.random.default_rng(4)
    signer = minhash.Signer(24, 4, 2)
    pool = np.unique(draw.integers(0, 1 << 63, 4000, dtype=np.uint64))
    for share in (0.3, 0.6, 0.9):
        n = int(1000 * share)
        errors = []
        for k in range(20):
            p = draw.permutation(pool)
            a, b = np.sort(p[:1000]), np.sort(np.concatenate((p[:n], p[2000 : 3000 - n])))
            s = [signer(x)[1][None, None] for x in (a, b)]
            errors.append(minhash.estimates(s[0], s[1], 2, 96)[0, 0] - n / (2000 - n))
        assert abs(np.mean(errors)) < 0.04


def test_components(spark):
    from lodestone.llm.graph import components

    edges = [(k, k + 1) for k in range(50)] + [(100, 99), (5, 5), (99, 100), (200, 200)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {k: 0 for k in range(51)} | {99: 99, 100: 99}


def test_maxent(spark, odd):
    draw = random.Random(6)
    rows = list(odd) + [(1000 + k, " ".join(f"{'ab'[k % 2]}{int(draw.paretovariate(0.6)) % 60}" for _ in range(80)), "s") for k in range(150)]
    shape = maxent.Shape(head=64, anchors=8, clusters=2, bands=2, slots=256, batch=512)
    found = maxent.score_documents(table(spark, rows), shape=shape).collect()
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    split = lambda t: [*(t or "").encode().translate(ASCII_LOWER).split(), b""]
    counts = Counter(w for i, t, _ in rows if not held(i) for w in split(t))
    total, kinds = sum(counts.values()), len(counts)
    expected = Counter()
    for i, t, _ in rows:
        expected[i, held(i), len(split(t)), sum(counts[w] > 0 for w in split(t)), total, round(sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in split(t)), 6)] += 1
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in found) == expected
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in found)
    out = [r for r in found if r["held_out"] and (r["doc_id"] or 0) >= 1000]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)
    assert maxent.score_documents(empty(spark), shape=shape).count() == 0


def test_maxent_learns_alike_however_rows_are_dealt(spark, monkeypatch):
    draw = random.Random(16)
    rows = [(k, " ".join(f"{'abc'[k % 3]}{int(draw.paretovariate(0.6)) % 60}" for _ in range(120)), "s") for k in range(300)]
    shape = maxent.Shape(head=64, anchors=8, clusters=2, bands=2, slots=256, batch=512, turns=1 << 12)
    monkeypatch.setattr(maxent, "SUMMED", 3)  # several levels of sums
    found = []
    for parts, a_core in ((1, 1), (16, 1), (128, 16)):
        monkeypatch.setattr(maxent, "TASKS_A_CORE", a_core)
        out = maxent.score_documents(table(spark, rows).repartition(parts, "doc_id"), shape=shape).collect()
        found.append({r["doc_id"]: (r["score"], r["base_score"], r["held_out"]) for r in out})
    gains = [sum(s - b for s, b, held in f.values() if held) for f in found]
    assert gains[0] > 0 and gains[1] == pytest.approx(gains[0], rel=1e-3) and gains[2] == pytest.approx(gains[0], rel=1e-3)
    assert all(found[1][k][0] == pytest.approx(found[0][k][0], rel=1e-3) for k in found[0])


def test_maxent_is_a_distribution():
    shape = maxent.Shape(head=4, anchors=2, clusters=1, bands=1, slots=16)
    draw = np.random.default_rng(1)
    own = np.array([1, 2, 2, 2])
    n = np.array([9.0, 5.0, 3.0, 2.0])
    model = maxent.Model(shape, [b"", b"a", b"b", b"c"], own, np.log10(n / np.bincount(own, n)[own]), np.log10(n + 1), draw.normal(size=(4, 16, 3)).astype(np.float32), np.zeros(3, np.float32))
    z = maxent._logits(model.weights, model.bias, maxent.history(np.array([1, 2, 1, 3]), 16))
    share = np.exp(np.stack([maxent._log_share(z, np.full(4, c)) for c in range(3)]))
    assert np.allclose(share.sum(axis=0), 1)
    assert np.allclose(share[1] + share[2] * sum(10 ** model.inner[1:]) + share[0], 1)


def test_maxent_trees_are_distributions():
    draw = np.random.default_rng(2)
    own = np.array([1, *draw.integers(2, 4, 40)])
    n = draw.integers(1, 100, 41).astype(float)
    trees, keys = maxent.grow(own, n, 64), np.repeat(draw.integers(0, maxent.WIDE, (4, 1)), 41, axis=1)
    assert np.allclose(np.exp(trees.log_share(np.arange(41), keys)), n / np.bincount(own, n)[own])
    trees.weights[:] = draw.normal(size=trees.weights.shape)
    assert np.allclose(np.bincount(own, np.exp(trees.log_share(np.arange(41), keys)))[1:], 1)


@pytest.mark.parametrize("head", [64, 4])
def test_maxent_order_within_a_class(spark, head):
    draw = random.Random(8)
    pairs = lambda step: " ".join(f"a{k} b{(k + step) % 12}" for k in draw.sample(range(12), 12))
    held = [k for k in range(3000) if zlib.crc32(str(k).encode()) % 7 == 2]
    rows = [(k, " ".join(pairs(0) for _ in range(8)), "s") for k in range(300) if k not in held]
    rows += [(held[-1], pairs(0), "s"), (held[-2], pairs(5), "s")]
    shape = maxent.Shape(head=head, anchors=4, clusters=1, bands=1, slots=256, batch=256)
    score = {r["doc_id"]: r["score"] for r in maxent.score_documents(table(spark, rows), shape=shape).collect()}
    assert score[held[-1]] > score[held[-2]] + 6


def test_maxent_grows(spark):
    small, large = maxent.Shape.of(0, 0), maxent.Shape.of(5_000_000_000, 200_000_000)
    assert small == maxent.Shape() and large.head > 8 * small.head and large.slots > 8 * small.slots > 65_536 // 2 and large.turns > 8 * small.turns and large.groups > 8 * small.groups
    counts = {f"w{k}".encode(): 1 + k for k in range(200)}
    rows = spark.createDataFrame(list(counts.items()), "word binary, n long")
    shape = maxent.Shape(head=20, anchors=2, clusters=1, bands=1, slots=1 << 17, groups=16, batch=256)
    model = maxent.fit(table(spark, [(1, "w1 w2", "s")]), rows, sum(counts.values()), shape)
    sums = Counter({k: 1 for k in range(16)})
    for w, n in counts.items():
        sums[zlib.crc32(w) % 16] += (n + 1) * (w not in model.head)
    assert 0 < len(model.head) <= 20 and np.allclose(10**model.shared, [sums[k] for k in range(16)])


def test_maxent_token_table():
    draw = random.Random(21)
    texts = ["".join(draw.choice("aAZé\u3000\x1c\x85 \t\n\v\f\r  x") for _ in range(draw.randrange(40))) for _ in range(300)] + [None, "", " ", "w" * 99]
    draw.shuffle(texts)
    for column in (pa.array(texts), pa.array(["cut off", *texts, "cut"]).slice(1, len(texts)), pa.array(texts, pa.large_string()), pa.array([None], pa.string()), pa.array([], pa.string())):
        expected = [maxent.tokens(t) for t in column.to_pylist()]
        words, starts = maxent.token_table(column)
        assert words.to_pylist() == [w for t in expected for w in t]
        assert starts.tolist() == [sum(map(len, expected[:k])) for k in range(len(expected))]
        assert [k for piece in maxent._slices(column, 50) for k in range(*piece)] == list(range(len(column)))
    head, shape = [b"", b"x", b"a"], maxent.Shape(head=4)
    words, starts = maxent.token_table(pa.array(texts))
    ids, of, kinds = maxent.Indexer(head, shape)(words)
    assert ids.tolist() == [head.index(w) if w in head else 4 + zlib.crc32(w) for w in words.to_pylist()] and kinds.take(pa.array(of)).equals(words)
    one_by_one = [maxent.history(t, 256) for t in np.split(ids, starts[1:])]
    assert (maxent.history(ids, 256, starts) == np.concatenate(one_by_one, axis=1)).all()


def test_maxent_sums_gradients_of_turns():
    draw = np.random.default_rng(22)
    trees = maxent.grow(np.full(3000, 2), 1e6 / np.arange(1, 3001), 1 << 12)
    trees.weights[:] = draw.normal(size=trees.weights.shape)
    leaves, keys = draw.integers(0, 3000, 40_000), draw.integers(0, maxent.WIDE, (4, 40_000))  # several blocks
    gradient, curve, plain, bend = (np.zeros(trees.weights.shape, t) for t in (np.float32, np.float32, float, float))
    trees.slope(gradient, curve, leaves, keys)
    _, turns, signs, slots = trees.ways(leaves, keys)
    miss = 1 / (1 + np.exp(trees.lean(trees.weights, turns, signs, slots).astype(float)))
    for k in range(4):
        np.add.at(plain[k], slots[k], signs * miss)
        np.add.at(bend[k], slots[k], miss * (1 - miss))
    assert np.allclose(gradient, plain, rtol=1e-4, atol=1e-2) and np.allclose(curve, bend, rtol=1e-4, atol=1e-2)


def test_maxent_calls_python_once_a_column():
    """Each pass goes through the texts of a batch together: ten times the texts take few calls more, not ten times as many."""
    head, shape = [f"w{k}".encode() for k in range(30)], maxent.Shape(head=32, anchors=4, slots=64, turns=1 << 8, groups=4)
    own, n = np.full(30, 2), np.arange(60.0, 30, -1)
    trees = maxent.grow(np.concatenate((own, np.zeros(4, int))), np.concatenate((n, np.ones(4))), shape.turns)
    model = maxent.Model(shape, head, own, np.log10(n / n.sum()), np.log10(n + 1), np.zeros((4, 64, 3), np.float32), np.zeros(3, np.float32), trees, np.zeros(4))
    draw, sent = random.Random(23), SimpleNamespace(value=model)

    def calls(run, n_texts):
        column, seen = pa.array([" ".join(words(draw, 30, 60)) for _ in range(n_texts)]), Counter()
        batch = pa.RecordBatch.from_arrays([column], ["text"]) if run is not maxent._score else pa.RecordBatch.from_arrays([pa.array(range(n_texts)), column], ["doc_id", "text"])
        made = run(sent, shape) if run is maxent._train else run(sent) if run is maxent._score else run()
        sys.setprofile(lambda _, event, __: seen.update([event]))
        try:
            list(made([batch]))
        finally:
            sys.setprofile(None)
        return seen["call"] + seen["c_call"]

    for run in (maxent._count, maxent._train, maxent._score):
        calls(run, 40)  # modules that are loaded with the first use
        assert calls(run, 400) < 2 * calls(run, 40)


def test_maxent_leaves_no_broadcasts(spark):
    files = lambda: len(os.listdir(spark.sparkContext._temp_dir))
    before = files()
    out = maxent.score_documents(table(spark, [(k, f"w{k % 3} w{k % 5}", "s") for k in range(40)]), shape=maxent.Shape(head=16, anchors=2, clusters=1, bands=1, slots=64, turns=64))
    assert out.count() == 40 and files() == before


def test_toxicity_grammar():
    reader = toxicity.Model({"idiot": 2.0}, {"scum": 1.0}).reader()
    of = lambda text: {k for k, x in zip(toxicity.KINDS, toxicity.match(text, reader)) if x}
    assert of("What an idiot.") == {"insult"} and of("You are an idiot!") == {"targeted"} and of("not an idiot") == {"negated"}
    assert of("He said: fine. He said idiot") == {"reported"} and of("I will kill you") == {"targeted_threat"} and of("scummy water; kill time") == {"insult", "threat"}
    assert of("the idiot said so") == {"insult"} and of("not one of the very many idiot") == {"insult"} and of("") == of(None) == set()


def test_toxicity_reach():
    reader = toxicity.Model({"idiot": 2.0}, {}).reader()
    of = lambda text: {k for k, x in zip(toxicity.KINDS, toxicity.match(text, reader)) if x}
    assert of("he is not, you idiot, a friend") == {"targeted"} and of("not an idiot but an idiot") == {"negated", "insult"}
    assert of("an idiot, he said, an idiot") == {"insult", "reported"} and of("he is not the idiot, you") == {"negated"}


def test_toxicity_of_few_and_repeated_labels(spark):
    docs = table(spark, [(1, "good words here", "s"), (2, "grumpf words here", "s"), (None, "you idiot", "s")] + [(k, f"text {k % 50} of {k}", "s") for k in range(3, 300) for _ in range(2)])
    few = toxicity.fit(docs, spark.createDataFrame([(1, 1, 0), (2, 1, 1)], "doc_id long, quality int, toxic int"), held_out=None)
    assert few == toxicity.Model({w: 3.0 for w in toxicity.INSULTS}, {})
    scored = {r["text"]: r["toxicity"] for r in toxicity.score(docs, few).collect()}
    assert scored["good words here"] < 0.5 < scored["you idiot"]
    seen = []
    real = toxicity._logistic
    toxicity._logistic = lambda x, y, **o: seen.append(len(x)) or real(x, y, **o)
    try:
        toxicity.fit(docs, spark.createDataFrame([(k, 1, k % 2) for k in range(300)], "doc_id long, quality int, toxic int"), held_out=None, max_rows=40)
    finally:
        toxicity._logistic = real
    assert seen and seen[0] <= 40


def test_toxicity_learns(spark):
    draw = random.Random(2)
    rows, labels = [], []
    for k in range(400):
        w, bad = words(draw, 30), k % 5 == 0
        if bad:
            w[draw.randrange(30)] = f"grumpf{draw.choice('abcdefgh')}{draw.choice('xyz')}"
        rows.append((k, " ".join(w), "s"))
        labels.append((k, 1, int(bad)))
    docs = table(spark, [*rows, (900, None, "s"), (901, "", "s"), (None, "w1", "s")])
    given = spark.createDataFrame([*labels, (None, 1, 1), (901, 1, None)], "doc_id long, quality int, toxic int")
    scored = {r["doc_id"]: r["toxicity"] for r in toxicity.score(docs, toxicity.fit(docs, given)).collect()}
    held = [k for k in range(400) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert all((scored[k] >= 0.5) == (k % 5 == 0) for k in held) and len(scored) == 403 and all(0 <= s <= 1 for s in scored.values())
    assert scored[900] == scored[901] < 0.5
    assert toxicity.score(empty(spark), toxicity.fit(empty(spark), given.limit(0))).count() == 0


def test_url_filter(spark):
    entries = [("bad.org", "add", 10), ("bad.org", "remove", 20), ("bad.org", "add", 20), ("bad.org", "add", 25), ("bad.org", "remove", 30), ("x.ok.org", "add", 0), ("ok.org/spam", "add", 5), ("ok.org/spam", "remove", 6), ("never.org", "remove", 1), (None, "add", 1), ("y.org", "add", None)]
    captures = [("http://a.BAD.org/x", 9), ("http://a.bad.org/x", 10), ("http://bad.org", 25), ("http://bad.org", 30), ("https://x.ok.org:80/p", 3), ("https://ok.org/spam/2", 5), ("https://ok.org/spam/2", 6), ("https://ok.org/", 5), ("mailto:a@b", 5), (None, 5), ("http://never.org", 5), ("http://bad.org", None), ("http://bad.org", 25)]
    made = spark.createDataFrame([(k, u, t, "p") for k, (u, t) in enumerate(captures)], "page_id long, url string, fetched int, pattern string")
    listed = spark.createDataFrame(entries, "pattern string, action string, day int")
    found = {r["page_id"]: (r["blocked"], r["pattern"], r["since"]) for r in urlfilter.blocked_captures(made, listed).collect()}
    no = (False, None, None)
    bad, again = (True, "bad.org", 10), (True, "bad.org", 20)
    assert found == dict(enumerate([no, bad, again, no, (True, "x.ok.org", 0), (True, "ok.org/spam", 5), no, no, no, no, no, no, again]))
    assert urlfilter.blocked_captures(made.limit(0), listed).count() == 0 and not any(r["blocked"] for r in urlfilter.blocked_captures(made, listed.limit(0)).collect())


def test_url_filter_against_all_pairs(spark):
    draw = random.Random(12)
    names = ["a.org", "x.a.org", "y.x.a.org", "b.net", "c.com"]
    entries = [(draw.choice([*names, "a.org/p", "b.net/q"]), draw.choice(["add", "remove"]), draw.randrange(60)) for _ in range(150)]
    captures = [(k, f"http://{draw.choice(names)}{draw.choice(['', '/p', '/q/r', '/P'])}", draw.randrange(70), "keep") for k in range(400)] + [(400, "http://a.org/p", 7, "keep")] * 3
    made = spark.createDataFrame(captures, "page_id long, url string, fetched int, since string")
    found = Counter((r["page_id"], r["url"], r["fetched"], r["blocked"], r["pattern"], r["since"]) for r in urlfilter.blocked_captures(made, spark.createDataFrame(entries, "pattern string, action string, day int")).collect())
    spans = defaultdict(list)
    for p, action, day in sorted(set(entries), key=lambda e: (e[0], e[2], e[1] == "add")):
        if action == "add" and not (spans[p] and spans[p][-1][1] is None):
            spans[p].append([day, None])
        elif action == "remove" and spans[p] and spans[p][-1][1] is None:
            spans[p][-1][1] = day
    expected = Counter()
    for k, url, day, _ in captures:
        name, _, path = url[7:].partition("/")
        keys = [name, *(name.split(".", n)[n] for n in range(1, name.count("."))), *([f"{name}/{path.split('/')[0]}"] if path else [])]
        hits = [(-len(p), p, a) for p in keys for a, b in spans.get(p, []) if a <= day and (b is None or day < b)]
        expected[(k, url, day, bool(hits), *(min(hits)[1:] if hits else (None, None)))] += 1
    assert found == expected and any(r[3] for r in found) and any(r[4] and "/" in r[4] for r in found)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><!-- c --><header><h1>Site name</h1></header><nav><ul><li><a href=/a>Home</a><li><a href=/b>News of all kinds</a></ul></nav>
<div class="cookie-notice">We use cookies to make this very good site work for you</div>
<%s><h1>Main &amp; title</h1><p>First   part <b>of</b> the
text.<br>More&nbsp;of it &lt;here&gt;.<p>Second part, with <a href="x">a link</a> and many words in it.</p><aside>See also this other page</aside><script>var t="</p>";</script>
<ul><li>Point one of the list<li>Point two of the list</ul><form><p>Sign up here</p></form><blockquote>A quoted line of text</blockquote></%s>
<section class="comments"><p>I think that this is a comment by a reader</p></section><div class=sidebar>Popular things of today</div><footer>All rights &copy; us</footer></body></html>"""
TEXT = "Main & title\n\nFirst part of the text. More of it <here>.\n\nSecond part, with a link and many words in it.\n\nPoint one of the list\n\nPoint two of the list\n\nA quoted line of text"


def test_html(spark):
    pages = [PAGE % ("article", "article"), PAGE % ("div", "div"), None, "", "<p>unclosed <b>bold", "<!-- never closed <p>x", "<script>x", "plain words only", "<nav><a href=x>only a menu</a></nav>", PAGE % ("main", "main")]
    made = spark.createDataFrame([(k, f"u{k}", p, "x") for k, p in enumerate(pages)], "page_id long, url string, html string, text string")
    found = {r["page_id"]: r for r in html.extract(made, html.fit(made)).collect()}
    assert [found[k]["text"] for k in range(len(pages))] == [TEXT, TEXT, "", "", "unclosed bold", "", "", "plain words only", "", TEXT]
    assert found[0]["n_chars"] == len(TEXT) and found[0]["url"] == "u0"
    assert html.extract(made.limit(0), html.fit(made.limit(0))).count() == 0


BODY = "<h1>A title of some words</h1><p>The first paragraph has a good many words in it.</p>"
KEPT = "A title of some words\n\nThe first paragraph has a good many words in it."


@pytest.fixture(scope="module")
def learned(spark):
    pages = [(k, "u", PAGE % ("article", "article")) for k in range(30)]
    return html.fit(spark.createDataFrame(pages, "page_id long, url string, html string"))


@pytest.mark.parametrize(
    "page, text",
    [
        ('<div class="layout with-sidebar"><article>%s</article></div>', KEPT),
        ('<div id="search-results"><article>%s</article></div>', KEPT),
        ('<div class="share-price-news"><main>%s</main></div>', KEPT),
        ('<form><div class="widget"><article>%s</article></div></form>', KEPT),
        ('<article>%s</article><div class="comments"><article>A reader writes a comment here</article></div>', KEPT),
        ('<div class="related"><article>Other news</article></div><article>%s</article>', KEPT),
        ("<article>%s<ul><li>one point<li>two points</ul></article>", KEPT + "\n\none point\n\ntwo points"),
        ("<article>%s<blockquote>A quote</blockquote><table><tr><td>1<td>2</table><p>Short end.</article>", KEPT + "\n\nA quote\n\n1\n\n2\n\nShort end."),
        ("<article>%s<figure><img><figcaption>A caption</figcaption></figure><p>Where <math><mi>x</mi> = 1</math>.</article>", KEPT + "\n\nA caption\n\nWhere x = 1."),
        ('<nav><a href=x>Home</a></nav><div class="post">%s<ul><li>one point of some words<li>two points of some words</ul></div><div class="footer">All rights</div>', KEPT + "\n\none point of some words\n\ntwo points of some words"),
        ("<div class=banner><h1>A title of some words</h1><p>The first paragraph has a good many words in it.</p></div>%.0s", KEPT),
    ],
)
def test_html_keeps_the_article(learned, page, text):
    assert html.main_text(page % BODY, learned) == text


def test_html_of_deep_and_long_pages(learned):
    import time

    def seconds(n):
        began = time.perf_counter()
        for page in ("<div>" * n + BODY, "<i><div>" + "<b>" * n + "x" + "</i>" * n, "<div class=nav>" * n + f"<article>{BODY}</article>", f"<article>{BODY}" + "<p>more words" * n):
            html.main_text(page, learned)
        return time.perf_counter() - began

    assert html.main_text("<div>" * 100_000 + BODY, learned) == KEPT
    assert seconds(100_000) < 40 * max(seconds(10_000), 0.05)  # a quadratic parser takes 100 times as long


def test_best_region_against_all_runs():
    draw = random.Random(4)
    for _ in range(200):
        page = [html.Block("w " * draw.randrange(1, 6), draw.choice("pqr"), ["t"] * draw.randrange(4), False, False) for _ in range(draw.randrange(8))]
        weights = html.Weights({"p": 1.0, "q": -1.0, "r": 0.3}, {"t": -0.4})
        total = lambda a, b: sum(weights.word(x) * len(x.text.split()) for x in page[a:b]) - 0.4 * sum(len(x.tags) for x in page[a + 1 : b])
        best = max([(total(a, b), -a, -b) for a in range(len(page)) for b in range(a + 1, len(page) + 1)], default=(0, 0, 0))
        a, b = html.best_region(page, weights)
        assert total(a, b) == pytest.approx(max(best[0], 0))


