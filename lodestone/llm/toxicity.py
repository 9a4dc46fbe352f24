"""Toxicity by a weighted finite-state pattern grammar.

A lexical transducer turns words into symbols with weights: insults, threats, targets, negations and reporting verbs.
Transducers for insult, threat, target, negation and reported speech read the symbols of a clause. Their composition tags the
arc of each insult or threat, which carries the word's weight, and the clause's last state; both together give the kind of match: a plain,
targeted, negated or reported insult, or a targeted or plain threat. A negation or report holds for the words in its reach alone,
and a negation ends at a comma. A document's score is a logistic function of the weights of its matches by kind, so a word counts by the
clause it stands in.

Insults are a seed list and words or word beginnings learned from labelled rows, with their log-odds as arc weights;
the weights of the kinds of match are learned too; threats, targets, negations and reports are the seed lists. At most max_rows labelled rows are used for learning, those whose
ids hash lowest; the lexicon keeps at most max_terms terms. With fewer than least_rows toxic or clean rows nothing is learned, and the
seed lists with default weights are used. Scoring reads every whole text.

Results for odd input: null, empty and unlabelled texts get a score from the bias alone; rows with a null or repeated id
are scored like any other; of the texts of a labelled id that is repeated the smallest is learned from; a null label takes no part, and of several labels of an id the largest counts; with empty
tables the seed lists and default weights are used; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import crc32_mod, given_back, hash_sample, materialize, WordCache

# Seed words in English, German, French and Spanish.
INSULTS = "idiot moron stupid loser scum trash pathetic worthless imbecile bastard dummkopf abschaum trottel connard abruti crétin imbécile estúpido basura".split()
THREATS = "kill hurt destroy beat murder töten umbringen verprügeln tuer frapper détruire matar golpear destruir".split()
TARGETS = "you your yourself u du dich dir ihr euch tu toi te vous tú ti usted ustedes".split()
NEGATIONS = "not never no nobody isn wasn nicht kein keine nie ne pas jamais aucun nunca jamás ningún".split()
REPORTS = "said says say claimed claims called wrote reported sagte sagt behauptet schrieb dit affirme écrit dijo dice escribió".split()

WORD = re.compile(r"[^\W\d_]+|[.!?;,\n]")
SYMBOLS = ("insult", "threat", "target", "negation", "report", "comma", "other")
KINDS = ("insult", "targeted", "negated", "reported", "threat", "targeted_threat")
FEATURES = (*KINDS, "heaviest", "density")


@dataclass(frozen=True)
class Transducer:
    """A deterministic transducer over SYMBOLS; what isn't in steps stays in its state. arcs: tags of a step by state and symbol. output: tags of a last state."""

    start: object
    steps: dict
    arcs: dict
    output: dict

    def step(self, state, symbol):
        return self.steps.get((state, symbol), state)

    def arc(self, state, symbol):
        return self.arcs.get((state, symbol), frozenset())

    def tag(self, state):
        return self.output.get(state, frozenset())


def compose(a: Transducer, b: Transducer) -> Transducer:
    """The transducer that reads with a and b together and gives both tags; only states that can be reached are made."""
    steps, arcs, output, todo = {}, {}, {}, [(a.start, b.start)]
    while todo:
        state = todo.pop()
        if state in output:
            continue
        output[state] = a.tag(state[0]) | b.tag(state[1])
        for symbol in SYMBOLS:
            after = (a.step(state[0], symbol), b.step(state[1], symbol))
            if after != state:
                steps[state, symbol] = after
            if tags := a.arc(state[0], symbol) | b.arc(state[1], symbol):
                arcs[state, symbol] = tags
            todo.append(after)
    return Transducer((a.start, b.start), steps, arcs, output)


def _hit(symbol: str) -> Transducer:
    """Tags every arc of the symbol."""
    return Transducer(0, {}, {(0, symbol): frozenset([symbol])}, {})


def _once(symbol: str) -> Transducer:
    """Tags a clause that has the symbol anywhere."""
    return Transducer(0, {(0, symbol): 1}, {}, {1: frozenset([symbol])})


def _negation(reach: int = 3) -> Transducer:
    """Tags the arcs of insults and threats within reach words of a negation, with no comma between."""
    steps = {(k, "negation"): reach for k in range(reach + 1)}
    for k in range(1, reach + 1):
        steps |= {(k, s): k - 1 for s in SYMBOLS if s not in ("negation", "comma")} | {(k, "comma"): 0}
    return Transducer(0, steps, {(k, s): frozenset(["negation"]) for k in range(1, reach + 1) for s in ("insult", "threat")}, {})


def _report() -> Transducer:
    """Tags the arcs of insults and threats that follow a reporting verb."""
    return Transducer(0, {(0, "report"): 1}, {(1, s): frozenset(["report"]) for s in ("insult", "threat")}, {})


GRAMMAR = reduce(compose, (_hit("insult"), _hit("threat"), _once("target"), _negation(), _report()))


def kind(tags: frozenset) -> str | None:
    """The kind of match that the tags of an arc and of its clause's last state stand for."""
    if not tags & {"insult", "threat"}:
        return None
    if "negation" in tags:
        return "negated"
    if "report" in tags:
        return "reported"
    if "insult" in tags:
        return "targeted" if "target" in tags else "insult"
    return "targeted_threat" if "target" in tags else "threat"


@dataclass(frozen=True)
class Model:
    """words and stems: arc weights of insults, by word and by beginning; weights: of FEATURES; bias."""

    words: dict[str, float]
    stems: dict[str, float]
    weights: tuple[float, ...] = (1.5, 2.5, 0.3, 0.5, 0.3, 1.5, 0.5, 0.5)
    bias: float = -3.0

    def reader(self) -> WordCache:
        """The lexical transducer: words to (symbol, weight)."""
        fixed = {",": ("comma", 0.0)} | {w: (s, 1.0) for s, words in (("report", REPORTS), ("negation", NEGATIONS), ("target", TARGETS), ("threat", THREATS)) for w in words}
        lengths = sorted({len(s) for s in self.stems})

        def read(word: str) -> tuple[str, float] | None:
            weight = max((self.stems.get(word[:k], 0.0) for k in lengths if k <= len(word)), default=0.0)
            weight = max(weight, self.words.get(word, 0.0))
            return ("insult", weight) if weight > 0 else fixed.get(word)

        return WordCache(read)


def match(text: str | None, reader: WordCache) -> np.ndarray:
    """FEATURES of a text: weight of the matches by kind, the heaviest clause's, and all by length."""
    out = np.zeros(len(FEATURES))
    words = WORD.findall((text or "").lower())
    read = list(map(reader.__getitem__, words))
    hits = [k for k, s in enumerate(read) if s and s[0] in ("insult", "threat")]
    done, total, end_of = -1, 0.0, ".!?;\n"
    for hit in hits:
        if hit <= done:
            continue
        first = hit
        while first and words[first - 1] not in end_of:
            first -= 1
        last = hit
        while last + 1 < len(words) and words[last + 1] not in end_of:
            last += 1
        done, state, matched = last, GRAMMAR.start, []
        for s in read[first : last + 1]:
            symbol, weight = s or ("other", 0.0)
            if tags := GRAMMAR.arc(state, symbol):
                matched.append((tags, weight))
            state = GRAMMAR.step(state, symbol)
        clause = 0.0
        for tags, weight in matched:
            out[KINDS.index(kind(tags | GRAMMAR.tag(state)))] += weight
            clause += weight
        out[-2] = max(out[-2], clause)
        total += clause
    out[: len(KINDS)] = np.log1p(out[: len(KINDS)])
    out[-1] = 100 * total / (100 + len(words))
    return out


def _terms(text: str, lengths: range) -> set[tuple[str, bool]]:
    words = {w for w in WORD.findall(text.lower()) if len(w) > 2}
    return {(w, False) for w in words} | {(w[:k], True) for w in words for k in lengths if k <= len(w)}


def _count_terms(lengths: range):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())

        def flush() -> pa.RecordBatch:
            terms = list(counts[0] | counts[1])
            out = pa.RecordBatch.from_arrays([pa.array([t for t, _ in terms], pa.string()), pa.array([s for _, s in terms], pa.bool_()), pa.array([counts[0][t] for t in terms], pa.int64()), pa.array([counts[1][t] for t in terms], pa.int64())], ["term", "stem", "clean", "toxic"])
            for c in counts:
                c.clear()
            return out

        for batch in batches:
            for text, toxic in zip(batch.column(1), batch.column(2).to_pylist()):
                counts[toxic].update(_terms(text.as_py() or "", lengths))
                if len(counts[0]) + len(counts[1]) > 150_000:  # what is flushed early meets again in the shuffle
                    yield flush()
        yield flush()

    return run


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Ridge logistic regression by Newton's method; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, penalty = np.zeros(x.shape[1]), np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty + 1e-9 * np.eye(len(w)), x.T @ (p - y) + penalty @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int | None = 0, max_rows: int = 20_000, max_terms: int = 4096, least_rows: int = 5, stem_lengths: range = range(4, 9)) -> Model:
    """Learn from rows whose crc32(doc_id as text) mod folds isn't held_out (None: from all)."""
    seeds = {w: 3.0 for w in INSULTS}
    rows = labels.filter("doc_id is not null and toxic is not null").select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic") > 0).cast("int").alias("toxic"))
    if held_out is not None:
        rows = rows.filter(crc32_mod(F.col("doc_id"), folds) != held_out)
    rows = hash_sample(rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), max_rows, "doc_id")
    held = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(rows), "doc_id")
    sample = materialize(held.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")), "labelled")
    n = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if min(n.get(0, 0), n.get(1, 0)) < least_rows:
        return Model(seeds, {})
    counted = sample.mapInArrow(given_back(_count_terms(stem_lengths)), "term string, stem boolean, clean long, toxic long").groupBy("term", "stem").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    odds = F.log((F.col("toxic") + 0.5) / (n[1] + 1)) - F.log((F.col("clean") + 0.5) / (n[0] + 1))
    share, both = F.col("toxic") / (F.col("toxic") + F.col("clean")), F.col("toxic") + F.col("clean")
    z = 1.96  # lower end of Wilson's interval for the share of toxic rows among the rows that have the term
    low = (share + z * z / (2 * both) - z * F.sqrt(share * (1 - share) / both + z * z / (4 * both * both))) / (1 + z * z / both)
    terms = counted.filter("toxic >= 3").withColumn("odds", odds).withColumn("low", low).filter((F.col("odds") > 2) & (F.col("low") > 0.45)).orderBy(F.desc(F.col("toxic") * F.col("odds")), "term", "stem").limit(max_terms).collect()
    learned = {False: {}, True: {}}
    for r in terms:
        learned[r["stem"]][r["term"]] = float(r["odds"])
    model = Model(seeds | learned[False], learned[True])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = model.reader()
        for batch in batches:
            found = [match(t.as_py(), reader).tolist() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.float64())), batch.column(2)], ["x", "toxic"])

    table = sample.mapInArrow(given_back(measure), "x array<double>, toxic int").toPandas()  # at most max_rows rows
    w = _logistic(np.array(table["x"].tolist()), table["toxic"].to_numpy(float))
    return Model(model.words, model.stems, tuple(map(float, w[:-1])), float(w[-1]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of docs, and toxicity double. A column of that name is replaced."""
    docs = docs.drop("toxicity")
    schema = docs.withColumn("toxicity", F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, weights = model.reader(), np.array(model.weights)
        for batch in batches:
            x = np.array([match(t.as_py(), reader) for t in batch.column(batch.schema.get_field_index("text"))]).reshape(-1, len(FEATURES))
            p = 1 / (1 + np.exp(-np.clip(x @ weights + model.bias, -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], [*batch.schema.names, "toxicity"])

    return docs.mapInArrow(given_back(run), schema)
