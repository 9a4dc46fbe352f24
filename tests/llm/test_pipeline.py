"""The corpus pipeline, stage by stage and as a whole."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from lodestone.llm import minhash, mixing, toxicity


def _tables(spark, path):
    draw = random.Random(11)
    word = lambda: f"w{draw.randrange(3000)}"
    shared = " ".join(word() for _ in range(60))
    rows, labels = [], []
    for k in range(120):
        lines = [" ".join(word() for _ in range(25)) for _ in range(3)]
        if k % 6 == 0:
            lines.insert(1, shared)
        if k % 10 == 9:
            lines[0] = f"{lines[0]} vilest creature{k}"
        rows.append((k, "\n".join(lines), "en", f"s{k % 3}", 0))
        labels.append((k, 1, int(k % 10 == 9)))
    near = rows[7][1].split()
    near[5] = "changed"
    rows += [(200, rows[1][1], "en", "s0", 0), (201, " ".join(near), "en", "s1", 0), (202, None, "en", None, 0), (203, "", "en", "s0", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return docs, shared


def test_stages(spark, tmp_path):
    d = str(tmp_path)
    docs, shared = _tables(spark, d)
    model = toxicity.fit(docs, spark.read.parquet(f"{d}/labels.parquet"))
    scores = {r["doc_id"]: r["toxicity"] for r in toxicity.score(docs, model).collect()}
    clean = corpus_pipeline.drop_toxic(spark, docs, d)
    assert {r["doc_id"] for r in clean.collect()} == {i for i, s in scores.items() if s < 0.5} == {i for i in scores if i % 10 != 9 or i >= 200}
    lines = corpus_pipeline.dedup_lines(spark, clean, d)
    found = {r["doc_id"]: r["text"] for r in lines.collect()}
    assert lines.columns == docs.columns and sum(shared in (t or "") for t in found.values()) == 1 and shared in found[0]
    assert 200 not in found and {202, 203} <= set(found)
    near = corpus_pipeline.drop_near_duplicates(spark, lines, d)
    left = {r["doc_id"]: r["text"] for r in near.collect()}
    kept = {r["doc_id"] for r in minhash.near_duplicates(lines).collect() if r["kept"]}
    assert set(left) == kept and 201 not in left and set(found) - set(left) == {201} and near.columns == docs.columns
    mixed = corpus_pipeline.mix_sources(spark, near, d)
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(near).collect()}
    taken = [r["doc_id"] for r in mixed.collect()]
    assert mixed.columns == docs.columns and {i: taken.count(i) for i in copies} == copies
    packed = corpus_pipeline.pack(spark, mixed, d).collect()
    assert sorted(r["doc_id"] for r in packed if r["piece"] == 0) == sorted(taken)
    whole = corpus_pipeline.run(spark, d).collect()
    key = lambda r: (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
    assert sorted(map(key, whole)) == sorted(map(key, packed))


def test_near_duplicates_by_row(spark):
    draw = random.Random(3)
    text = lambda: " ".join(f"w{draw.randrange(3000)}" for _ in range(40))
    a, b, c = text(), text(), text()
    rows = [(1, a), (2, a), (2, b), (3, c), (3, c), (3, b + " more"), (4, ""), (4, ""), (None, a), (None, a)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = sorted(((r["doc_id"] or 0, r["text"]) for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()))
    assert left == sorted([(1, a), (2, b), (3, c), (4, ""), (0, a), (0, a)])


def test_mixing_by_row(spark):
    rows = [(None, "w " * (5 + k), f"s{k % 3}") for k in range(40)] + [(k % 4, "w " * (50 + k), f"s{k % 3}") for k in range(20)]
    docs = spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    due = {}
    for r in mixing.mix(docs).collect():
        due[r["source"], r["size"]] = r["copies"]
    taken = [(r["source"], len(r["text"].split())) for r in corpus_pipeline.mix_sources(spark, docs, "").collect()]
    assert len(due) == 60 and {k: taken.count(k) for k in due} == due


def test_stages_of_odd_tables(spark, tmp_path):
    d = str(tmp_path)
    _tables(spark, d)
    long = " ".join(f"z{k}" for k in range(30_000))
    rows = [(None, "text without an id", None), (None, None, "s"), (1, "line one of this\nline two", "s"), (1, "other text of the id", "s"), (2, "", "s"), (2, "", "s"), (3, long, "t"), (4, "line two", "t")]
    names = "doc_id long, text string, lang string, source string, n_chars long, toxicity string, n_lines int, n_removed int, copies string, size string, component_id string, n long"
    docs = spark.createDataFrame([(i, t, "en", s, len(t or ""), "own", -1, -2, "c", "z", "k", 7) for i, t, s in rows], names)
    texts = lambda df: sorted(((r["doc_id"] or 0, r["text"] or "") for r in df.collect()))
    own = lambda df: {(r["toxicity"], r["n_lines"], r["n_removed"], r["copies"], r["size"], r["component_id"], r["n"]) for r in df.collect()}
    whole = sorted((i or 0, t or "") for i, t, _ in rows)
    clean = corpus_pipeline.drop_toxic(spark, docs, d)
    assert clean.columns == docs.columns and texts(clean) == whole
    lines = corpus_pipeline.dedup_lines(spark, clean, d)
    assert lines.columns == docs.columns and texts(lines) == [x for x in whole if x != (4, "line two")]
    near = corpus_pipeline.drop_near_duplicates(spark, lines, d)
    assert near.columns == docs.columns and texts(near) == [(0, ""), (0, "text without an id"), (1, "line one of this\nline two"), (1, "other text of the id"), (2, ""), (3, long)]
    mixed = corpus_pipeline.mix_sources(spark, near, d)
    assert mixed.columns == docs.columns and all(own(x) == {("own", -1, -2, "c", "z", "k", 7)} for x in (clean, lines, near, mixed))
    assert mixed.filter(F.length("text") == len(long)).count() <= 2 and corpus_pipeline.pack(spark, mixed, d).count() >= mixed.count()
    none = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, none, d)
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.pack(spark, none, d).count() == 0
