"""Registered queries against their SQL on inputs that the test tables don't hold."""

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from litloom.operators import dedup, phrases
from litloom.queries import QUERIES, SQL


def differences(spark, folder, name: str, **tables: dict) -> set:
    con = duckdb.connect()
    for table, columns in tables.items():
        pq.write_table(pa.table(columns), f"{folder}/{table}.parquet")
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    found = QUERIES[name](spark, str(folder))
    result = con.execute(SQL[name])
    names = [d[0] for d in result.description]
    return {tuple(r[c] for c in names) for r in found.collect()} ^ set(result.fetchall())


def test_repaired_texts(spark, tmp_path):
    texts = [
        "A " * 200 + "end", "x " + "B " * 65, "C " * 64, "ÉA B", "A BÉ C D", "A\x0bB C", "A B", "one.\n;b c; d e f g", "one\n; two; b c d e", " One;  two three four; x", "some words [in\rFrench]", "a longer title here [in two]",
        "words that stay here [b\nc] [d]　", "a b c d.; ;x", "[a] ", None, "",
    ]
    assert not differences(spark, tmp_path, "repaired_texts", documents={"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})


@pytest.mark.parametrize("name", ["near_dup_pairs", "dedup_survivors", "dedup_by_source", "new_articles"])
def test_many_articles_of_a_title(spark, tmp_path, monkeypatch, name):
    """Articles of one title meet in chunks, whose pairs are those of the SQL."""
    monkeypatch.setattr(dedup, "CHUNK", 3)
    words = [f"word{chr(97 + i)}x" for i in range(20)]
    texts = [f"Maize yield in dry lands. {' '.join(words[: 8 + i % 5] + words[15 : 15 + i // 5])}" for i in range(20)]
    texts += [t.replace("dry lands", "dry land") for t in texts[:6]] + [f"Maize yield of rice. {words[i]}" for i in range(4)] + [texts[0], "", None, "12"]
    ids = pa.array(range(len(texts)), pa.int64())
    sources = pa.array([f"src{i % 4}" for i in range(len(texts))])
    assert not differences(spark, tmp_path, name, documents={"doc_id": ids, "text": pa.array(texts, pa.string()), "source": sources})


def test_vectors_cluster_as_by_all_pairs(spark, monkeypatch):
    """Blocks and pieces of any size connect what all pairs connect; copies give a link each, not one for each pair."""
    rng = np.random.default_rng(5)
    rows = [(f"n{i}", i % 2, [float(x) for x in rng.normal(size=6) + (i % 7) * 0.4], i % 5) for i in range(150)]
    rows += [("zero", 0, [0.0] * 6, 1), ("short", 0, [1.0, 2.0], 1), ("like short", 0, [2.0, 4.0], 2), ("none", 1, None, 1), ("hole", 1, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), ("empty", 1, [], 1), ("no group", None, [1.0] * 6, 1)]
    df = spark.createDataFrame(rows, "name string, kind int, vector array<double>, n int").cache()
    x, y = df.alias("x"), df.alias("y")
    met = x.join(y, (F.col("x.kind") == F.col("y.kind")) & (F.col("x.name") < F.col("y.name")) & (phrases.cosine(F.col("x.vector"), F.col("y.vector")) >= 0.9))
    want = connected([(r[0], r[1]) for r in met.select("x.name", "y.name").collect()])
    assert want and ("like short", "short") in {tuple(sorted(c)) for c in want}
    for block, cells in ((4096, 1 << 21), (20, 64), (7, 1)):
        monkeypatch.setattr(phrases, "BLOCK", block)
        monkeypatch.setattr(phrases, "CELLS", cells)
        assert connected([(r["a"], r["b"]) for r in phrases.vector_links(df, "kind", 0.9).collect()]) == want
    monkeypatch.undo()
    copies = spark.createDataFrame([(f"c{i}", 0, [1.0, 2.0, 3.0], i) for i in range(400)], "name string, kind int, vector array<double>, n int")
    assert phrases.vector_links(copies, "kind", 0.9).count() == 399
    assert {r["representative"] for r in phrases.cluster_vectors(copies, "kind", 0.9).collect()} == {"c399"}


def connected(links):
    group = {}
    for a, b in links:
        joined = group.get(a, {a}) | group.get(b, {b})
        group |= dict.fromkeys(joined, joined)
    return {frozenset(g) for g in group.values()}


def test_trigrams_read_their_texts_once(spark):
    """Terms are costly: they are computed once, and pairs that meet less often than `least` are not counted by their words."""
    read = spark.sparkContext.accumulator(0)

    def counted(words):
        read.add(1)
        return words

    texts = [["the", "green", "maize", "field", f"w{i}", f"w{i // 2}", "end"] for i in range(60)] + [["lone"], []]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, words array<string>")
    found = phrases.trigrams(docs.select("doc_id", F.udf(counted, "array<string>")("words").alias("words")), score=0.5).collect()
    assert read.value == len(texts)
    # "the green" and "maize field" are joined first, so four words are one phrase.
    kinds = 60 + 4
    assert [(r["a"], r["b"], r["n"], round(r["score"], 6)) for r in found] == [("the_green", "maize_field", 60, round(55 * kinds / 3600, 6))]


def test_texts_are_judged_within_shared_terms():
    """Terms without a partner are left out of the matrices, and articles that cannot reach the bound; no cosine that does is lost or changed."""
    rng = np.random.default_rng(3)

    def chunk(n, first):
        own = np.repeat(np.arange(n), 40)
        term = np.concatenate([np.append(rng.choice(32, 30, replace=False), first + 100 * i + np.arange(10)) for i in range(n)]).astype(np.int64)
        w = rng.uniform(0.8, 1.2, len(own)) * np.where(term >= 1000, np.repeat(rng.random(n) < 0.5, 40) * 3 + 0.01, 1)
        return own, term, w / np.sqrt(np.bincount(own, w**2, n))[own], n

    def dense(x):
        full = np.zeros((x[3], 100_000))
        full[x[0], x[1]] = x[2]
        return full

    for y in (None, chunk(15, 50_000)):
        x = chunk(20, 1000)
        shared, keep_x, keep_y = dedup._shared(x, y, 0.8)
        assert shared.max() < 32 and 0 < keep_x.sum() < 20
        other = y or x
        exact = dense(x) @ dense(other).T
        found = np.zeros_like(exact)
        found[np.ix_(keep_x, keep_y)] = dedup._matrix(*x[:3], keep_x, shared) @ dedup._matrix(*other[:3], keep_y, shared).T
        if y is None:
            np.fill_diagonal(exact, 0)
            np.fill_diagonal(found, 0)
        assert (exact >= 0.8).any() and ((exact >= 0.8) == (found >= 0.8)).all() and np.allclose(found[exact >= 0.8], exact[exact >= 0.8])
