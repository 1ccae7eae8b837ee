"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A fingerprint is the k smallest distinct 48-bit hashes of a text's five-word shingles, in
ascending order, six big-endian bytes each, as base64. Sketches of parts merge into the sketch
of the whole, and two sketches give resemblance, containment and distinct counts.

Null and empty texts, and texts without a word, have the empty fingerprint "". A text of fewer than
five words has one shingle. Equal texts have equal fingerprints.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litloom.llm import kernels
from litloom.llm.storage import shuffle_partitions, small_batches

SKETCH_SIZE = 128
SHINGLE = 5
SPACE_48 = float(1 << 48)
ROWS_A_BUCKET = 200_000


def encode(sketch: np.ndarray) -> str:
    return base64.b64encode(sketch.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()).decode()


def decode(fingerprint: str | None) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(fingerprint or ""), np.uint8).reshape(-1, 6)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, 2:] = raw
    return wide.reshape(-1).view(">u8").astype(np.uint64)


def sketches(texts: list[bytes], k: int = SKETCH_SIZE, size: int = SHINGLE) -> list[np.ndarray]:
    """The bottom-k sketch of each text."""
    out: list[np.ndarray] = []
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts], dtype=np.int64)))
    data = np.frombuffer(b"".join(texts), np.uint8)
    for _, _, block, inner in kernels.blocks(data, offsets):
        hashes, ahead = kernels.text_shingles(block, inner, size)
        hashes >>= np.uint64(16)
        for i in range(len(ahead) - 1):
            part = hashes[ahead[i] : ahead[i + 1]]
            if len(part) > 8 * k:  # most of a long text can't be among its k smallest
                low = part[part <= np.partition(part, 4 * k)[4 * k]]
                part = low if len(np.unique(low)) >= k else part
            out.append(np.unique(part)[:k])
    return out


def merge(parts: Iterable[np.ndarray], k: int = SKETCH_SIZE) -> np.ndarray:
    parts = list(parts)
    return np.unique(np.concatenate(parts))[:k] if parts else np.zeros(0, np.uint64)


def distinct(sketch: np.ndarray, k: int = SKETCH_SIZE) -> float:
    """Estimated number of distinct shingles; exact below k."""
    return float(len(sketch)) if len(sketch) < k else (k - 1) / ((float(sketch[-1]) + 1) / SPACE_48)


def _shared(a: np.ndarray, b: np.ndarray, k: int) -> tuple[int, np.ndarray]:
    both = np.sort(np.concatenate((a, b)))
    again = both[1:] == both[:-1]
    union = both[np.concatenate(([True], ~again))][:k] if len(both) else both
    twice = both[1:][again]
    return int(np.searchsorted(twice, union[-1], "right")) if len(union) else 0, union


def resemblance(a: np.ndarray, b: np.ndarray, k: int = SKETCH_SIZE) -> float:
    """Estimated Jaccard similarity of the shingle sets; 1 for two empty ones."""
    shared, union = _shared(a, b, k)
    return shared / len(union) if len(union) else 1.0


def containment(a: np.ndarray, b: np.ndarray, k: int = SKETCH_SIZE) -> float:
    """Estimated share of a's shingles that b has too; 1 where a is empty."""
    if not len(a):
        return 1.0
    shared, union = _shared(a, b, k)
    return min(1.0, shared / len(union) * distinct(union, k) / distinct(a, k))


def _pandas(function, kind: str):
    return F.pandas_udf(function, kind)


def fingerprint(text: Column, k: int = SKETCH_SIZE, size: int = SHINGLE) -> Column:
    """The fingerprint of a text column."""

    def one(batch: pd.Series) -> pd.Series:
        return pd.Series([encode(s) for s in sketches([(t or "").encode() for t in batch], k, size)], dtype=object)

    return _pandas(one, "string")(text)


def _pairwise(measure, a: Column, b: Column, k: int) -> Column:
    def one(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([measure(decode(p), decode(q), k) for p, q in zip(x, y, strict=True)], dtype=float)

    return _pandas(one, "double")(a, b)


def estimate_resemblance(a: Column, b: Column, k: int = SKETCH_SIZE) -> Column:
    return _pairwise(resemblance, a, b, k)


def estimate_containment(a: Column, b: Column, k: int = SKETCH_SIZE) -> Column:
    return _pairwise(containment, a, b, k)


def estimate_distinct(a: Column, k: int = SKETCH_SIZE) -> Column:
    return _pandas(lambda x: pd.Series([distinct(decode(p), k) for p in x], dtype=float), "double")(a)


def merge_fingerprints(df: DataFrame, keys: list[str], column: str, k: int = SKETCH_SIZE) -> DataFrame:
    """One fingerprint per group of rows: that of the union of their shingles.

    The hashes are ranked as rows, pre-aggregated and salted by their own value, so a group of any size
    spreads over tasks: each of 64 salts keeps its k smallest, then those meet. Null
    fingerprints count as empty; a group of empty ones gives "". Columns: keys, `column`.
    """
    from pyspark.sql import Window

    def hashes(batch: pd.Series) -> pd.Series:
        return pd.Series([decode(p).astype(np.int64) for p in batch])

    rows = df.select(*keys, F.explode_outer(_pandas(hashes, "array<bigint>")(F.col(column))).alias("__hash"))
    rows = rows.groupBy(*keys, "__hash").agg(F.lit(1).alias("__one")).withColumn("__salt", F.pmod("__hash", F.lit(64)))
    for by in ([*keys, "__salt"], keys):
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.col("__hash").asc_nulls_last()))
        rows = rows.withColumn("__rank", rank).where(F.col("__rank") <= k)
    lists = rows.groupBy(*keys).agg(F.sort_array(F.collect_list("__hash")).alias("__hashes"))

    def pack(batch: pd.Series) -> pd.Series:
        return pd.Series([encode(np.asarray(h, np.uint64)) if len(h) else "" for h in batch], dtype=object)

    return lists.select(*keys, _pandas(pack, "string")("__hashes").alias(column))


def neighbours(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows dealt out so that each stands right before its successor in descending id order.

    Columns role, key, id, text. Ids are cut at quantiles into buckets, one partition each, sorted by
    descending id, then text. Rows without an id come last, by a hash of the text, in as many buckets as they need. After its
    own rows (role 0) a bucket holds, as role 1, copies of the first rows of the next bucket (the last one: of the first). The
    texts are shuffled once; only the bucket bounds and each bucket's largest key reach the driver.
    """
    spark = df.sparkSession
    small_batches(spark)
    id_ = F.col(id_col).cast("long")
    rows = df.select(id_.isNull().alias("lacking"), F.coalesce(id_, F.xxhash64(text_col)).alias("key"), id_.alias("id"), F.col(text_col).alias("text"))
    counted = rows.agg(F.count("id").alias("n"), F.count_if("lacking").alias("lacking")).first()
    least = shuffle_partitions(spark)
    buckets = lambda n, low: max(1, min(n, max(low, -(-n // ROWS_A_BUCKET))))
    parts, spare = buckets(counted["n"], least), buckets(counted["lacking"], -(-counted["lacking"] * least // max(1, counted["n"] + counted["lacking"])))
    shares = [i / parts for i in range(1, parts)]
    cuts = rows.where("not lacking").agg(F.percentile_approx("key", shares, max(10_000, 20 * parts)).alias("q")).first()["q"] if shares and counted["n"] else []
    bounds = np.array(sorted(set(cuts or [])), np.int64)
    # Hashes are even, so their cuts need no quantiles.
    even = np.array([-(1 << 63) + (i << 64) // spare for i in range(1, spare)], np.int64)

    def of(lacking: pd.Series, keys: pd.Series) -> np.ndarray:
        key = keys.to_numpy()
        own = len(bounds) - np.searchsorted(bounds, key, "left")
        return np.where(lacking.to_numpy(bool), len(bounds) + 1 + len(even) - np.searchsorted(even, key, "left"), own).astype(np.int32)

    own = _pandas(lambda lacking, keys: pd.Series(of(lacking, keys)), "int")
    tops = {r["b"]: (r["lacking"], r["top"]) for r in rows.select("lacking", "key").groupBy(own("lacking", "key").alias("b"), "lacking").agg(F.max("key").alias("top")).collect()}
    filled = sorted(tops)
    wanted = {tops[b]: filled[i - 1] for i, b in enumerate(filled)}  # the first bucket's goes to the last
    lists = {flag: sorted((key, to) for (lack, key), to in wanted.items() if lack == flag) for flag in (False, True)}

    def place(lacking: pd.Series, keys: pd.Series) -> pd.DataFrame:
        also = np.full(len(keys), -1, np.int32)
        flags, key = lacking.to_numpy(bool), keys.to_numpy()
        for flag, pairs in lists.items():
            if pairs:
                top, to = np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.int32)
                at = np.minimum(np.searchsorted(top, key), len(top) - 1)
                also = np.where((flags == flag) & (top[at] == key), to[at], also)
        return pd.DataFrame({"own": of(lacking, keys), "also": also})

    placed = rows.withColumn("at", _pandas(place, "own int, also int")("lacking", "key"))
    first = F.struct(F.col("at.own").alias("bucket"), F.lit(0).alias("role"))
    copy = F.struct(F.col("at.also").alias("bucket"), F.lit(1).alias("role"))
    dealt = placed.withColumn("to", F.explode(F.when(F.col("at.also") >= 0, F.array(first, copy)).otherwise(F.array(first))))
    dealt = dealt.select(F.col("to.bucket").alias("bucket"), F.col("to.role").alias("role"), "lacking", "key", "id", "text")
    return dealt.repartitionById(len(bounds) + len(even) + 2, F.col("bucket")).sortWithinPartitions("role", "lacking", F.desc("key"), "text").drop("bucket", "lacking")


EDITED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, distinct_shingles double, edited_containment double"


def edited(text: str, following: str) -> str:
    """The text with its last third (rounded down) replaced by as much of the start of the following text."""
    m = len(text) // 3
    return text[: len(text) - m] + following[:m]


def fingerprint_edits(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SKETCH_SIZE, size: int = SHINGLE) -> DataFrame:
    """Fingerprints of every text and of its edit with the next text, and their likenesses.

    One row per input row, columns as EDITED. Null texts count as empty. Rows that share an id are ordered
    by text, rows without an id come last, by a hash of the text; with a single row the next document is the row itself. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c.split()[0], {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}[c.split()[1]]) for c in EDITED.split(", ")])
        waiting = None  # id, text, sketch of the last row, whose successor has not come yet
        ended = False
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                texts = [t or "" for t in part.column("text").to_pylist()]
                roles, ids = part.column("role").to_pylist(), part.column("id").to_pylist()
                own = sketches([t.encode() for t in texts], k, size)
                pairs = []
                for role, i, text, sketch in zip(roles, ids, texts, own, strict=True):
                    if waiting is not None and not ended:
                        pairs.append((waiting, (text, sketch)))
                    ended |= role == 1
                    waiting = (i, text, sketch)
                if not pairs:
                    continue
                changed = [edited(a[1], b[0]).encode() for a, b in pairs]
                out = [[] for _ in schema]
                for (a, b), text, sketch in zip(pairs, changed, sketches(changed, k, size), strict=True):
                    row = (a[0], len(a[1]), hashlib.sha256(text).hexdigest(), encode(a[2]), encode(sketch), resemblance(a[2], sketch, k), resemblance(a[2], b[1], k), distinct(a[2], k), containment(a[2], sketch, k))
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)

    return neighbours(df, id_col, text_col).mapInArrow(run, EDITED)
