import zlib
from collections import Counter, defaultdict

import pytest

from litloom.llm import mixing, sharding

from .conftest import frame, sentence


def check(rows, found, shards=40):
    assert len(found) == len(rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    slots = defaultdict(list)
    for r in found:
        assert 0 <= r["shard"] < shards and r["law"] == "bytes" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sharding_edges(spark, edges):
    rows, df = edges
    check(rows, sharding.shard_by_bytes(df).collect())
    assert sharding.shard_by_bytes(df.limit(0)).count() == 0


def test_sharding_balance(spark):
    rows = [(i, sentence(i, 20 + i % 50)) for i in range(3000)]
    rows += [(5000 + i, "a copy of the same text " * 8) for i in range(1500)] + [(7000 + i, sentence(i // 2, 30)) for i in range(40)]
    found = sharding.shard_by_bytes(frame(spark, rows)).collect()
    check(rows, found)
    sizes, where = Counter(), defaultdict(set)
    texts = {i: t for i, t, *_ in rows}
    for r in found:
        sizes[r["shard"]] += r["size"]
        where[texts[r["doc_id"]]].add(r["shard"])
    mean = sum(sizes.values()) / 40
    assert len(sizes) == 40 and max(abs(s - mean) for s in sizes.values()) < 0.1 * mean
    hot = "a copy of the same text " * 8
    assert all(len(s) == 1 for t, s in where.items() if t != hot)
    assert max(where[hot]) - min(where[hot]) == len(where[hot]) - 1


def targets(sizes):
    total = sum(sizes.values())
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    capped = {}
    while True:
        free = [s for s in order if s not in capped]
        level = (total - sum(capped.values())) / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if weight[s] * level > 3 * sizes[s]]
        if not over:
            return capped | {s: weight[s] * level for s in free}
        capped |= {s: 3.0 * sizes[s] for s in over}


def mixed_rows():
    rows = [(i, sentence(i, 5 + i % 40), f"s{i % 7}") for i in range(700)] + [(1000 + i, "tiny text", "small") for i in range(5)]
    return rows + [(2000, None, None), (2001, "null source words", None), (2002, "", "void"), (3, sentence(3, 8), "s3"), (None, "null id", "s1")]


def test_mixing(spark):
    rows = mixed_rows()
    found = mixing.copies(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    wanted = targets(sizes)
    taken = Counter()
    for r in found:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(wanted[r["source"]]) and r["copies"] <= 3
        taken[r["source"]] += r["size"] * r["copies"]
    assert all(abs(taken[s] - wanted[s]) < 0.25 * wanted[s] + 20 for s in wanted)


def test_mix_repeats_rows(spark):
    rows = mixed_rows()
    df = frame(spark, rows)
    out = mixing.mix(df)
    assert out.columns == df.columns
    wanted = Counter()
    for r in mixing.copies(df).collect():
        wanted[r["doc_id"], r["source"]] += r["copies"]
    assert Counter((r["doc_id"], r["source"]) for r in out.collect()) == +wanted


def test_mixing_empty(spark):
    df = frame(spark, [])
    assert mixing.copies(df).count() == 0 and mixing.mix(df).count() == 0
    assert mixing.mix(frame(spark, [(1, None, None), (2, "", "a")])).count() == 0


def test_ties_of_sources(spark):
    """Sources that are capped from the same level on, null among them, against the definition."""
    import random

    df = spark.createDataFrame([(1, "w " * 10, "a"), (2, "w " * 20, None)], "doc_id long, text string, source string")
    assert {r["source"]: r["target"] for r in mixing.copies(df).collect()} == {"a": 10.0, None: 20.0}
    rng = random.Random(2)
    for _ in range(12):
        names = rng.sample(["", "a", "b", "c", "d", None], rng.randint(1, 6))
        order = sorted(n for n in names if n is not None) + [None] * (None in names)
        sizes = {n: rng.choice((0, 1, 2, 5, 10)) * (1 + i % 3) for i, n in enumerate(order)}
        df = spark.createDataFrame([(i, "w " * size, n) for i, (n, size) in enumerate(sizes.items())], "doc_id long, text string, source string")
        found = {r["source"]: r["target"] for r in mixing.copies(df).collect()}
        assert found == pytest.approx(targets(sizes)), sizes


def test_shards_do_not_depend_on_ranges(spark):
    rows = [(i, sentence(i // 2, 20 + i % 50)) for i in range(600)]
    before = sharding.ROWS_A_RANGE, sharding.ROWS_A_SALT
    place = lambda: {(r["doc_id"], r["shard"], r["slot"]) for r in sharding.shard_by_bytes(frame(spark, rows)).select("doc_id", "shard", "slot").collect()}
    few = {s[:2] for s in place()}
    sharding.ROWS_A_RANGE, sharding.ROWS_A_SALT = 1, 1
    sharding.LEAST_RANGES, sharding.LEAST_SALTS = 2, 2
    try:
        many = {s[:2] for s in place()}
    finally:
        sharding.ROWS_A_RANGE, sharding.ROWS_A_SALT = before
        sharding.LEAST_RANGES, sharding.LEAST_SALTS = 1024, 256
    assert few == many


def test_shards_by_definition(spark):
    """Texts in order of their hash, each group of copies at the middle of its bytes: brute force."""
    from pyspark.sql import functions as F

    rows = [(i, sentence(i // 2 if i < 400 else i, 5 + i % 60)) for i in range(2000)] + [(9000, None), (9001, "")]
    df = frame(spark, rows)
    found = {r["doc_id"]: r["shard"] for r in sharding.shard_by_bytes(df).collect()}
    hashes = {r["doc_id"]: r["h"] for r in df.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    groups = defaultdict(list)
    for i, t in rows:
        groups[hashes[i], zlib.crc32((t or "").encode()), len((t or "").encode()) + 16].append(i)
    total = sum(size * len(ids) for (_, _, size), ids in groups.items())
    before = 0
    for (_, _, size), ids in sorted(groups.items()):
        whole = size * len(ids)
        assert whole * 40 <= 0.05 * total
        assert {found[i] for i in ids} == {min(39, (2 * before + whole) * 40 // (2 * total))}
        before += whole
