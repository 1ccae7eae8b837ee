"""Secret scans: fixed patterns, and a battery of randomness tests with false-discovery control.

Patterns find assigned credentials, access key ids and long hex runs. Beside them, every run of encoding
symbols is a candidate: its encoding is inferred from the symbols it uses, and three tests ask whether it
looks drawn at random from that alphabet (chi-squared uniformity of symbols, Wald-Wolfowitz runs
about the alphabet's middle, lag-1 serial correlation). A candidate's p is three times the least of the
three p-values. How many distinct candidates of a length class are random follows from those with p of a half
or more, however often each occurs; the class accepts p from the least value on at which the expected share of others stays within
FALSE_SHARE. So short runs, where the tests have little power, need more evidence.

DataFrame expressions only.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litloom.llm.arrays import let, sums_before
from litloom.llm.storage import settle

# The patterns, in the order in which spans of equal start are listed.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"
LEAST_VALUE = 8

KINDS = ("assign", "access", "hex", "random")
FALSE_SHARE = 0.05
STEPS = (0.0005, 0.001, 0.002, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5)
CLASSES = (24, 32, 48, 64, 128)  # upper bounds of length classes; one more above

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = (  # name, symbols that tell it, alphabet in order of value
    ("hex", "^[0-9a-f]+$", DIGITS + "abcdef"),
    ("hex-upper", "^[0-9A-F]+$", DIGITS + "ABCDEF"),
    ("base32", "^[A-Z2-7]+$", UPPER + "234567"),
    ("base36-upper", "^[0-9A-Z]+$", DIGITS + UPPER),
    ("base36", "^[0-9a-z]+$", DIGITS + LOWER),
    ("base62", "^[0-9A-Za-z]+$", UPPER + LOWER + DIGITS),
    ("base64", "^[0-9A-Za-z+/]+$", UPPER + LOWER + DIGITS + "+/"),
    ("base64url", "^[0-9A-Za-z_-]+$", UPPER + LOWER + DIGITS + "-_"),
)

SPAN = "struct<start:bigint,kind:int,end:bigint,value:string>"


def _located(text: Column, pattern: str, kind: int, kept=None) -> Column:
    """All leftmost non-overlapping matches as SPANs; `kept` may refuse a match by (match, its group 2)."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    group = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if kept else found
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("hit"), group.alias("group"))
    parts = F.filter(parts, lambda p: p["hit"].isNotNull())

    def placed(parts: Column) -> Column:
        starts = sums_before(F.transform(parts, lambda p: (F.length(p["gap"]) + F.length(p["hit"])).cast("bigint")))
        return F.zip_with(starts, parts, lambda at, p: F.struct((at + F.length(p["gap"])).alias("start"), p["hit"].alias("hit"), p["group"].alias("group")))

    spans = let(parts, placed)
    if kept:
        spans = F.filter(spans, lambda p: kept(p["hit"], p["group"]))
    spans = F.transform(spans, lambda p: F.struct(p["start"].alias("start"), F.lit(kind).alias("kind"), (p["start"] + F.length(p["hit"])).alias("end"), p["hit"].alias("value")))
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(f"array<{SPAN}>"))


def _tail(z: Column) -> Column:
    """Upper tail of the standard normal distribution, by a rational approximation of erfc."""
    x = F.abs(z) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    upper = 0.5 * poly * F.exp(-x * x)
    return F.when(z >= 0, upper).otherwise(1 - upper)


def _tested(spans: Column) -> Column:
    """Candidate spans with their encoding, length class and p; those without one, or with one kind of symbol, go."""
    def encoding(value: Column) -> Column:
        return F.coalesce(*[F.when(value.rlike(rule), F.lit(i)) for i, (_, rule, _) in enumerate(ENCODINGS)])

    alphabets = F.array(*[F.lit(a) for _, _, a in ENCODINGS])
    spans = F.filter(spans, lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]"))
    rows = F.transform(spans, lambda s: F.struct(s.alias("s"), encoding(s["value"]).alias("code")))
    rows = F.filter(rows, lambda r: r["code"].isNotNull())

    def symbols(r: Column) -> Column:
        letters = F.element_at(alphabets, r["code"] + 1)
        values = F.transform(F.split(r["s"]["value"], ""), lambda c: (F.position(c, letters) - 1).cast("double"))
        return F.struct(r["s"].alias("s"), r["code"].alias("code"), F.length(letters).cast("double").alias("k"), values.alias("v"))

    rows = F.transform(rows, symbols)
    total = lambda values, f: F.aggregate(values, F.lit(0.0), lambda a, x: a + f(x))

    def counted(r: Column) -> Column:
        n = F.size(r["v"]).cast("double")
        squares = total(F.sequence(F.lit(0), r["k"].cast("int") - 1), lambda s: F.pow(F.size(F.filter(r["v"], lambda x: x == s)).cast("double"), F.lit(2.0)))
        high = F.transform(r["v"], lambda x: (x * 2 >= r["k"]).cast("int"))
        return F.struct(*[r[c].alias(c) for c in ("s", "code", "k", "v")], n.alias("n"), squares.alias("squares"), high.alias("high"), (total(r["v"], lambda x: x) / n).alias("mean"))

    rows = F.transform(rows, counted)

    def measured(r: Column) -> Column:
        n, k = r["n"], r["k"]
        chi = (k / n * r["squares"] - n - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
        ones = total(r["high"], lambda x: x.cast("double"))
        after = lambda values: F.slice(values, 2, F.size(values) - 1)
        before = lambda values: F.slice(values, 1, F.size(values) - 1)
        runs = 1 + total(F.zip_with(before(r["high"]), after(r["high"]), lambda a, b: (a != b).cast("double")), lambda x: x)
        wanted = 2 * ones * (n - ones) / n + 1
        spread = (wanted - 1) * (wanted - 2) / (n - 1)
        variance = total(r["v"], lambda x: (x - r["mean"]) * (x - r["mean"]))
        together = total(F.zip_with(before(r["v"]), after(r["v"]), lambda a, b: (a - r["mean"]) * (b - r["mean"])), lambda x: x)
        return F.struct(
            r["s"].alias("s"), r["code"].alias("code"), n.alias("n"), chi.alias("chi"),
            F.when(spread > 0, (runs - wanted) / F.sqrt(spread)).otherwise(F.lit(99.0)).alias("runs"),
            F.when(variance > 0, (together / variance + 1 / n) * F.sqrt(n)).otherwise(F.lit(99.0)).alias("serial"),
        )

    def judged(r: Column) -> Column:
        p = F.least(F.lit(1.0), 3 * F.least(_tail(r["chi"]), 2 * _tail(F.abs(r["runs"])), 2 * _tail(F.abs(r["serial"]))))
        group = sum(((r["n"] > c).cast("int") for c in CLASSES), F.lit(0))
        return F.struct(r["s"].alias("s"), r["code"].alias("code"), group.alias("group"), p.alias("p"))

    return F.transform(F.transform(rows, measured), judged)


def _limits(candidates: DataFrame, share: float) -> DataFrame:
    """One row: for each length class the least p that it accepts (over 1: none). Of distinct values, told apart by 128 bits of hash."""
    one = candidates.select(F.explode("candidates").alias("c")).select(F.col("c.group").alias("group"), F.col("c.p").alias("p"), F.col("c.s.value").alias("value"))
    one = one.groupBy("group", "p", F.xxhash64("value").alias("x"), F.xxhash64(F.lit(8), "value").alias("y")).agg(F.count(F.lit(1)))
    counts = one.groupBy("group").agg(F.count_if(F.col("p") >= 0.5).alias("half"), *[F.count_if(F.col("p") >= t).alias(f"n{i}") for i, t in enumerate(STEPS)])
    fits = [F.when((F.col(f"n{i}") > 0) & (F.col(f"n{i}") - 2 * F.col("half") * (1 - t) <= share * F.col(f"n{i}")), F.lit(t)) for i, t in enumerate(STEPS)]
    limit = F.coalesce(*fits, F.lit(2.0))
    found = counts.select("group", limit.alias("limit"))
    return found.agg(*[F.coalesce(F.max(F.when(F.col("group") == g, F.col("limit"))), F.lit(2.0)).alias(f"l{g}") for g in range(len(CLASSES) + 1)]).select(F.array(*[f"l{g}" for g in range(len(CLASSES) + 1)]).alias("limits"))


def _apart(runs: Column, base: Column, length: Column) -> Column:
    """The runs that overlap no base span. Among many spans a run meets only those of its stretches of the text."""

    def free(of: Callable[[Column], Column]) -> Column:
        return F.filter(runs, lambda c: ~F.exists(of(c), lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))

    width = F.greatest(F.lit(4096), F.floor(length / 256) + 1).cast("bigint")
    nth = lambda at: F.floor(at / width).cast("int")
    stretches = F.transform(F.sequence(F.lit(0), nth(length)), lambda k: F.filter(base, lambda b: (b["start"] < (k + 1) * width) & (b["end"] > k * width)))
    met = let(stretches, lambda s: free(lambda c: F.flatten(F.slice(s, nth(c["start"]) + 1, nth(c["end"] - 1) - nth(c["start"]) + 1))))
    return F.when(F.size(base) <= 64, free(lambda _: base)).otherwise(met)


def scan_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", false_share: float = FALSE_SHARE) -> DataFrame:
    """Columns doc_id, base, added: arrays of spans (start, kind, end, value), by start, then kind.

    Offsets are code points, the end exclusive; kind indexes KINDS; an assignment's span is the whole match. One
    row per input row; null texts count as empty; an empty table gives no rows; rows that repeat an id or a text are scanned alike.
    A candidate that overlaps a pattern's span is not added again. Base spans depend on the text alone; which candidates are
    added also depends on the limits, which follow from all rows. The text is scanned once; what is found is checkpointed.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    base = F.concat(
        _located(F.col("text"), ASSIGN, 0, lambda _, value: F.length(value) >= LEAST_VALUE),
        _located(F.col("text"), ACCESS, 1),
        _located(F.col("text"), HEX, 2),
    )
    found = rows.select("doc_id", F.length("text").alias("length"), F.array_sort(base).alias("base"), _located(F.col("text"), CANDIDATE, 3).alias("runs"))
    apart = _apart(F.col("runs"), F.col("base"), F.col("length"))
    found = settle(found.select("doc_id", "base", _tested(apart).alias("candidates")))
    limits = _limits(found, false_share)
    # One row of a fixed number of limits.
    accepted = F.filter("candidates", lambda c: c["p"] >= F.element_at(F.col("limits"), c["group"] + 1))
    return found.crossJoin(F.broadcast(limits)).select("doc_id", "base", F.transform(accepted, lambda c: c["s"]).alias("added"))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
