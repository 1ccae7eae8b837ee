"""The pipeline on a small corpus, against what each stage must do."""

import random
from collections import Counter
from types import SimpleNamespace

import corpus_pipeline
from litloom.llm import mixing, storage

from .conftest import sentence
from .test_ngram_join import brute

WORDS = {"aa": "the and of house water green", "bb": "der und das haus wasser gruen"}
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus():
    rng = random.Random(1)
    items = [(i, sentence(900 + i, 25)) for i in range(4)]
    rows = []
    for i in range(120):
        lang = sorted(WORDS)[i % 2]
        rows.append((i, " ".join(rng.choice(WORDS[lang].split()) + str(rng.randrange(50)) * 0 + sentence(rng.random(), 1) * (k % 3 == 0) for k in range(40)), lang, f"s{i % 4}"))
    rows += [(200 + i, rows[i][1] if i < 5 else " ".join(rows[i][1].split()[:-1]), rows[i][2], "s1") for i in range(10)]
    rows += [(300 + i, f"{rows[20 + i][1]} {items[i][1]}", "aa", "s2") for i in range(4)]
    rows += [(400, "123 456 !!", None, "s0"), (401, "", None, "s0"), (402, None, None, None), (3, rows[3][1], rows[3][2], "s3")]
    return [(*r, len(r[1] or "")) for r in rows], items


def test_stages(spark, tmp_path):
    rows, items = corpus()
    folder = str(tmp_path / "sf")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
        seen.append([r.asDict() for r in docs.collect()])
        if i < 4:
            assert docs.columns == COLUMNS
    ids = [Counter(r["doc_id"] for r in s) for s in seen]
    assert set(ids[0]) == {r[0] for r in rows if r[0] not in (400, 401, 402)} and ids[0][3] == 2
    first = {i for i, _, c in brute([(r["doc_id"], r["text"]) for r in seen[0]]) if i == c}
    assert ids[1] == Counter(first)
    assert set(ids[2]) == first - {300, 301, 302, 303}
    taken = Counter()
    for r in mixing.copies(spark.read.parquet(f"{folder}/2")).collect():
        taken[r["doc_id"]] += r["copies"]
    assert ids[3] == +taken
    assert ids[4] == ids[3] and len({(r["shard"], r["slot"]) for r in seen[4]}) == len(seen[4])
    ran = corpus_pipeline.run(spark, folder)
    assert Counter((r["doc_id"], r["size"], r["shard"]) for r in ran.collect()) == Counter((r["doc_id"], r["size"], r["shard"]) for r in seen[4])


def test_empty(spark, tmp_path):
    folder = str(tmp_path / "sf")
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_queries_registered(spark):
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names and all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 11))


def test_driver_heap_is_collected_between_rounds(monkeypatch):
    class Runtime:
        def __init__(self, total):
            self.totalMemory, self.maxMemory = (lambda: total), (lambda: 100)

    swept = []
    monkeypatch.setattr(storage, "sweep", swept.append)
    for total in (50, 51):
        heap = Runtime(total)
        jvm = SimpleNamespace(java=SimpleNamespace(lang=SimpleNamespace(Runtime=SimpleNamespace(getRuntime=lambda heap=heap: heap))))
        session = SimpleNamespace(sparkContext=SimpleNamespace(_jvm=jvm, getCheckpointDir=lambda: "there"))
        storage.settle(SimpleNamespace(sparkSession=session, checkpoint=lambda eager: eager))
        assert len(swept) == (total > 50)
