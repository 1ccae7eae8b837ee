import random
import re
import string

from pyspark.sql import functions as F

from litloom.llm import decontam, licenses, secrets

from .conftest import frame, sentence

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def scanned(spark, rows):
    return {r["doc_id"]: r for r in secrets.scan_secrets(frame(spark, rows)).collect()}


def test_secret_patterns(spark, edges):
    rows = [*(r for r in edges[0] if r[0] not in (None, 5)), (20, 'Token = "0641917ea4e9feb9cda83477b57ac2654884f485" é passWORD:short token: secret: abcdefghij'), (21, "😀AKIAAKIAAKIA1234567 AKIA123 " + "deadbeef" * 4), (22, "api_key='a.b/c+d=e_f-' apikey=12345678 secret" + " " * 5 + ":" + "x" * 5000)]
    found = scanned(spark, rows)
    for i, text, *_ in rows:
        assert [(s["start"], s["kind"], s["end"]) for s in found[i]["base"]] == base(text)
        assert all((text or "")[s["start"] : s["end"]] == s["value"] for s in found[i]["base"])


def test_random_tokens(spark):
    rng = random.Random(3)
    alphabet = string.ascii_letters + string.digits
    rows = [(i, f"{sentence(i, 10)} {''.join(rng.choice(alphabet) for _ in range(48))} tail") for i in range(40)]
    plain = ["aaaaaaaaaaaaaaaaaaaaaaaaa1", "version-1-of-the-long-name-of-things", "abcabcabcabcabcabcabcabc123123123", "1111111111111111111111111a", "the_quick_brown_fox_jumps_over_2_dogs"]
    rows += [(100 + i, f"see {w} there") for i, w in enumerate(plain)]
    found = scanned(spark, rows)
    assert sum(len(found[i]["added"]) == 1 for i in range(40)) >= 36
    assert sum(len(found[100 + i]["added"]) for i in range(len(plain))) <= 1
    assert secrets.scan_secrets(frame(spark, [])).count() == 0


def test_licenses(spark, edges):
    mit = ". ".join(licenses.SENTENCES[k].capitalize() for k in ("mit.grant", "mit.notice", "mit.warranty", "mit.liability")) + "."
    bsd = "\n\n".join(licenses.SENTENCES[k].upper() + "." for k in ("bsd.grant", "bsd.source", "bsd.binary", "bsd.names", "bsd.warranty"))
    rows = [*edges[0], (20, f"Intro.\n{mit} Tail"), (21, bsd), (22, "Words. Licensed under the Apache License, Version 2.0.\nMore"), (23, "code\nSPDX-License-Identifier: MIT\nmore code"), (24, "I lost my license yesterday."), (25, "Licensed under CC BY-NC 4.0. Released under the MIT License."), (26, mit.replace(" ", "\n"))]
    found = {r["doc_id"]: r for r in licenses.scan_licenses(frame(spark, rows)).collect()}
    assert {i: found[i]["licenses"] for i in range(20, 27)} == {20: ["MIT"], 21: ["BSD-3-Clause"], 22: ["Apache-2.0"], 23: ["MIT"], 24: [], 25: ["CC-BY-NC-4.0", "MIT"], 26: ["MIT"]}
    assert all(not found[i]["licenses"] for i, *_ in edges[0])
    texts = {i: t for i, t, *_ in rows}
    for i in (22, 23, 25):
        for s in found[i]["sentences"]:
            assert re.sub("[^a-z0-9]+", " ", texts[i][s["start"] : s["end"]].lower()).strip() in licenses.known_sentences()
    assert licenses.scan_licenses(frame(spark, [])).count() == 0


def test_every_known_sentence_is_hinted():
    assert all(re.search(licenses.HINT, s) for s in licenses.known_sentences())


def edited(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        at = rng.randrange(len(out))
        out[at : at + 1] = rng.choice([[], ["q"], [out[at], "z"]])
    return "".join(out)


def test_contamination(spark, edges):
    rng = random.Random(5)
    items = [(i, sentence(1000 + i, 30)) for i in range(12)] + [(50, None), (51, ""), (52, "tiny"), (53, sentence(1000, 30)), (None, sentence(2000, 20))]
    rows, wanted = list(edges[0]), set()
    for k in range(36):
        item = items[k % 12]
        rows.append((100 + k, f"{sentence(k, 40)}\n\t{edited(rng, item[1], (k // 12) * 3).upper() if k % 2 else edited(rng, item[1], (k // 12) * 3)} {sentence(k + 500, 40)}"))
        wanted.add(100 + k)
    rows += [(200, sentence(3, 200_000) + " " + items[4][1]), (201, sentence(3, 5000))]
    wanted.add(200)
    benchmark = spark.createDataFrame([(*i, "z") for i in items], "item_id long, text string, doc_id string")
    found = decontam.find_contamination(frame(spark, rows), benchmark).collect()
    assert {r["doc_id"] for r in found} == wanted
    texts, by_item = {i: t for i, t, *_ in rows}, dict(items)
    exact = [r for r in found if r["edits"] == 0 and r["item_id"] is not None and r["doc_id"] < 112]
    assert exact and all(decontam.plain(texts[r["doc_id"]][r["start"] : r["end"]]) == decontam.plain(by_item[r["item_id"]])[r["item_start"] : r["item_end"]] for r in exact)
    kept = decontam.clean(frame(spark, rows), benchmark)
    assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in rows} - wanted
    assert decontam.find_contamination(frame(spark, []), benchmark).count() == 0
    assert decontam.find_contamination(frame(spark, rows), benchmark.limit(0)).count() == 0


def test_copies_leave_other_candidates_alone(spark):
    """How often one value occurs does not decide which other values are taken for random."""
    rng = random.Random(21)
    values = ["a1" + "".join(rng.choices(string.ascii_letters + string.digits, k=38)) for _ in range(80)]
    tested = secrets._tested(secrets._located(F.col("text"), secrets.CANDIDATE, 3))
    p = {r["text"]: r["c"][0]["p"] for r in frame(spark, list(enumerate(values))).select("text", tested.alias("c")).collect()}
    hot = next(v for v in values if 0.2 <= p[v] < 0.3)
    rows = list(enumerate(values))
    copies = rows + [(1000 + i, hot) for i in range(60)]
    few, many = scanned(spark, rows), scanned(spark, copies)
    assert {i: len(few[i]["added"]) for i, _ in rows} == {i: len(many[i]["added"]) for i, _ in rows}


def test_grams_bound():
    """Windows at the edit budget are found: brute force over edits."""
    rng = random.Random(6)
    item = sentence(9, 30)
    index = decontam.Items([(1, item)])
    missed = 0
    for _ in range(200):
        window = decontam.plain(item)[: decontam.WINDOW].decode()
        doc = f"{sentence(rng.random(), 10)} {edited(rng, window, 5)} {sentence(rng.random(), 10)}"
        missed += not list(index.search([decontam.plain(doc)]))
    assert missed == 0


def test_long_texts_are_linear(spark):
    """A megabyte of sentences, of one encoded run, of many runs and of many spans: each within seconds in one task."""
    import time

    rng = random.Random(8)
    alphabet = string.ascii_letters + string.digits + "+/"
    run = "".join(rng.choices(alphabet, k=1_000_000))
    many = " ".join("".join(rng.choices("0123456789abcdef", k=40)) + " x" + "".join(rng.choices(alphabet[:62], k=30)) for _ in range(8000))
    known = (licenses.SENTENCES["gpl.details"].capitalize() + ". ") * 2000
    text = known + "Some words here. Short license line\n" * 30_000
    for what, value in (("run", run), ("many", many)):
        began = time.time()
        found = scanned(spark, [(1, value)])[1]
        assert time.time() - began < 30, what
        if what == "many":
            assert [(s["start"], s["kind"], s["end"]) for s in found["base"]] == base(value)
            spans = [(s["start"], s["end"]) for s in found["added"]]
            assert spans and all(value[a:b].startswith("x") for a, b in spans)
        else:
            assert [(s["start"], s["end"]) for s in found["added"] if s["kind"] == 3] in ([(0, len(run))], [])
    began = time.time()
    found = licenses.scan_licenses(frame(spark, [(1, text)])).collect()[0]
    assert time.time() - began < 30
    assert len(found["sentences"]) == 2000 and all(re.sub("[^a-z0-9]+", " ", text[s["start"] : s["end"]].lower()).strip() == licenses.SENTENCES["gpl.details"] for s in found["sentences"])


def test_running_sums(spark):
    """Sums before each element, for arrays below, at and above the length of a block."""
    from litloom.llm import arrays

    rng = random.Random(4)
    rows = [([rng.randrange(9) for _ in range(n)],) for n in (0, 1, 2, arrays.BLOCK, arrays.BLOCK + 1, 3 * arrays.BLOCK + 7)]
    found = spark.createDataFrame(rows, "x array<bigint>").select("x", arrays.sums_before(F.col("x"), 5).alias("s")).collect()
    assert all(r["s"] == [5 + sum(r["x"][:i]) for i in range(len(r["x"]))] for r in found)


def test_short_items():
    """Items without a q-gram bound: whole words of under eight bytes, and one edit in those of 13 to 15."""
    index = decontam.Items([(1, "yes no"), (2, "abcdefghijklm"), (3, "x"), (4, "abcdefgh")])
    ids = lambda t: sorted({index.ids[r[1]] for r in index.search([decontam.plain(t)])})
    assert ids("so yes  NO maybe") == [1] and ids("oh yes now") == [] and ids("yes no") == [1]
    assert ids("zz abcdefghijklm zz") == [2, 4] and ids("zz abcXefghijklm zz") == [2] and ids("zz abcdefgijklm") == [2] and ids("abcXefghijkYm") == []
    assert ids("a x b") == [3] and ids("axb") == []
    import pickle

    assert pickle.loads(pickle.dumps(index)).ids == index.ids


def test_size_of_the_index():
    """The index of a block of items, as it is broadcast, is within some 30 bytes for each byte of text."""
    import pickle

    items = [(i, sentence(i, 60)) for i in range(3000)]
    size = sum(len(t) for _, t in items)
    assert len(pickle.dumps(decontam.Items(items))) < 30 * size + (1 << 24)


def test_battery_by_definition(spark):
    """The p of each candidate against a direct computation of the three tests."""
    import math

    rng = random.Random(31)
    values = ["".join(rng.choices(alphabet, k=n)) for alphabet in (string.digits + "abcdef", string.ascii_letters + string.digits, "ab12") for n in (24, 33, 64, 200)]
    values = [v for v in values if re.search("[0-9]", v) and re.search("[A-Za-z]", v)] + ["a1" * 20, "abc123" * 9]
    tested = secrets._tested(secrets._located(F.col("text"), secrets.CANDIDATE, 3))
    found = {r["text"]: r["c"] for r in frame(spark, list(enumerate(values))).select("text", tested.alias("c")).collect()}
    upper = lambda z: 0.5 * math.erfc(z / math.sqrt(2))
    for value in values:
        alphabet = next(a for _, rule, a in secrets.ENCODINGS if re.match(rule, value))
        k, n, v = len(alphabet), len(value), [alphabet.index(c) for c in value]
        chi = (k / n * sum(v.count(s) ** 2 for s in range(k)) - n - (k - 1)) / math.sqrt(2 * (k - 1) * (n - 1) / n)
        high = [2 * x >= k for x in v]
        ones, runs = sum(high), 1 + sum(a != b for a, b in zip(high, high[1:], strict=False))
        wanted = 2 * ones * (n - ones) / n + 1
        spread = (wanted - 1) * (wanted - 2) / (n - 1)
        run_z = (runs - wanted) / math.sqrt(spread) if spread > 0 else 99
        mean = sum(v) / n
        variance = sum((x - mean) ** 2 for x in v)
        serial = (sum((a - mean) * (b - mean) for a, b in zip(v, v[1:], strict=False)) / variance + 1 / n) * math.sqrt(n) if variance else 99
        p = min(1, 3 * min(upper(chi), 2 * upper(abs(run_z)), 2 * upper(abs(serial))))
        assert abs(found[value][0]["p"] - p) < 1e-5, value
