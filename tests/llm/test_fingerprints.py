import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from litloom.llm import fingerprints as P
from litloom.llm import kernels

from .conftest import frame, sentence


def shingles(text):
    words = text.encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def test_kernel_matches_sets():
    texts = ["", "a b", "a b c d e", "A b C d e f", sentence(1, 300), "a\x0bb c  d\te\nf g", "x" * (kernels.BLOCK + 5) + " y"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(t.encode()) for t in texts])))
    found, ahead = kernels.text_shingles(data, offsets)
    for i, t in enumerate(texts):
        assert len(np.unique(found[ahead[i] : ahead[i + 1]])) == len(shingles(t))
    assert found[ahead[2]] == found[ahead[3]]


def test_estimates():
    a, b = sentence(2, 3000), sentence(2, 3000)[: 9000] + sentence(3, 1500)
    x, y = P.sketches([a.encode(), b.encode()])
    sa, sb = shingles(a), shingles(b)
    assert P.resemblance(x, y) == pytest.approx(len(sa & sb) / len(sa | sb), abs=0.12)
    assert P.containment(x, y) == pytest.approx(len(sa & sb) / len(sa), abs=0.2)
    assert P.distinct(x) == pytest.approx(len(sa), rel=0.3)
    assert (P.merge([x, y]) == P.sketches([(a + " " + b).encode()])[0]).mean() > 0.9
    assert (P.decode(P.encode(x)) == x).all()
    assert P.resemblance(x[:0], x[:0]) == 1.0 and P.resemblance(x, x[:0]) == 0.0


def brute(rows):
    order = sorted(rows, key=lambda r: (-(r[0] if r[0] is not None else -(1 << 63)), r[1] is not None, r[1] or ""))
    out = []
    for i, (id_, text, *_) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        m = len(text) // 3
        out.append((id_, len(text), hashlib.sha256((text[: len(text) - m] + after[:m]).encode()).hexdigest()))
    return sorted(out, key=str)


def test_edits(spark, edges):
    rows, df = edges
    found = P.fingerprint_edits(df).collect()
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in found), key=str) == brute(rows)
    prints = {}
    for r in found:
        prints.setdefault(next(t or "" for i, t, *_ in rows if i == r["doc_id"]), set()).add(r["fingerprint"])
    assert all(len(v) == 1 for v in prints.values())


def test_many_partitions(spark):
    rows = [(i * 7 % 101, sentence(i, 5 + i % 30)) for i in range(101)]
    found = P.fingerprint_edits(frame(spark, rows).repartition(7)).collect()
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in found), key=str) == brute(rows)


def test_single_and_empty(spark):
    assert P.fingerprint_edits(frame(spark, [])).count() == 0
    row = P.fingerprint_edits(frame(spark, [(1, "abcdef")])).first()
    assert row["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest() and row["near_next"] == 1.0


def test_merge_groups(spark):
    rows = frame(spark, [(1, sentence(1, 300)), (1, sentence(2, 300)), (2, None)])
    merged = P.merge_fingerprints(rows.select("doc_id", P.fingerprint(F.col("text")).alias("f")), ["doc_id"], "f")
    found = {r["doc_id"]: r["f"] for r in merged.collect()}
    parts = P.sketches([sentence(1, 300).encode(), sentence(2, 300).encode()])
    assert found == {1: P.encode(P.merge(parts)), 2: ""}


def test_many_rows_without_an_id(spark):
    """Rows without an id spread over buckets, and still form one chain with the others."""
    rows = [(i, sentence(i, 12)) for i in range(30)] + [(None, sentence(1000 + i, 12)) for i in range(200)] + [(None, None), (None, sentence(1000, 12))]
    before = P.ROWS_A_BUCKET
    P.ROWS_A_BUCKET = 20
    try:
        found = P.fingerprint_edits(frame(spark, rows)).collect()
        dealt = P.neighbours(frame(spark, rows))
        sizes = [r["count"] for r in dealt.where("role = 0 and id is null").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        P.ROWS_A_BUCKET = before
    assert len(found) == len(rows) and max(sizes) < 60
    digests = sorted(hashlib.sha256(P.edited(a or "", b or "").encode()).hexdigest() for a, b in [(rows[i][1], rows[i - 1][1]) for i in range(1, 30)])
    assert sorted(r["edited_sha256"] for r in found if r["doc_id"] is not None and r["doc_id"] > 0) == digests
    # Every text is the successor of one row: each edit ends as some other row's text begins.
    begins = Counter(d.hexdigest() for d in (hashlib.sha256(P.edited(x, y).encode()) for x in {t or "" for _, t in rows[30:]} for y in {t or "" for _, t in rows}))
    assert all(r["edited_sha256"] in begins for r in found if r["doc_id"] is None)


def test_likenesses_against_exact_sets(spark):
    """Estimates over a table, within the error of a sketch of 128 hashes."""
    rows = [(i, f"{sentence(i // 3, 300)} {sentence(i, 20 + 40 * (i % 3))}") for i in range(60)]
    found = {r["doc_id"]: r for r in P.fingerprint_edits(frame(spark, rows)).collect()}
    errors = []
    for i in range(1, 60):
        a, b = shingles(rows[i][1]), shingles(rows[i - 1][1])
        e = shingles(P.edited(rows[i][1], rows[i - 1][1]))
        errors += [abs(found[i]["near_next"] - len(a & b) / len(a | b)), abs(found[i]["near_edited"] - len(a & e) / len(a | e))]
    assert max(errors) < 0.2 and sum(errors) / len(errors) < 0.05
