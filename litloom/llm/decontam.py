"""Benchmark decontamination by q-gram counting and banded alignment.

A document is contaminated by an item if some window of the item, WINDOW bytes long (or the whole item,
if it is shorter), lies within an edit distance of BUDGET times its length of a stretch of the document. Both
are compared as UTF-8 with A-Z lower-cased and each run of white space as one space.

An edit destroys at most Q shared q-grams, so a window of n bytes with e edits shares at least
n - Q + 1 - Q * e of them, on diagonals that drift by at most e. Shared q-grams are counted in overlapping
bands of diagonals; stretches that reach the bound are verified by a banded alignment of all their windows.
Where the bound leaves no q-gram, items are found by parts of them that must occur as they are: an item with e edits in one of
its e + 1 parts, and one of fewer than Q bytes, which allows no edit, whole and as words of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litloom.llm.storage import small_batches

Q = 8
WINDOW = 80
BUDGET = 0.08
BAND = 16
PIECE = 1 << 19
ITEM_BYTES = 4 << 20
SPREAD = np.uint64(0x9E3779B97F4A7C15)

FOUND = "doc_id long, item_id long, start long, end long, item_start long, item_end long, edits long"


def plain(text: str | None) -> bytes:
    return b" ".join((text or "").encode().lower().split())


def grams(data: bytes | np.ndarray) -> np.ndarray:
    """The Q bytes from each position on, as one number."""
    n = len(data) - Q + 1
    out = np.zeros(max(n, 0), np.uint64)
    for k in range(min(Q, len(out))):
        out[k::Q] = np.frombuffer(data, "<u8", (len(data) - k) // Q, k)
    return out


def budget(length: int) -> tuple[int, int, int]:
    """For an item of that length: window, edits allowed, q-grams that such a window must share (below 1: none need be)."""
    n = min(WINDOW, length)
    edits = int(BUDGET * n)
    return n, edits, n - Q + 1 - Q * edits


class Items:
    """A block of benchmark items, indexed by their q-grams: some 20 bytes for each byte of text."""

    def __init__(self, rows: list[tuple[int, str | None]]):
        kept = [(i, p) for i, t in rows if len(p := plain(t))]
        kept.sort(key=lambda r: budget(len(r[1]))[2] < 1)  # those without a q-gram bound come last
        self.ids = [i for i, _ in kept]
        self.texts = [p for _, p in kept]
        bounds = np.array([budget(len(t)) for t in self.texts], np.int64).reshape(-1, 3)
        self.window, self.edits, self.share = bounds.T
        codes = [grams(t) for t, least in zip(self.texts, self.share, strict=True) if least > 0]
        code = np.concatenate([*codes, np.zeros(0, np.uint64)])
        order = np.argsort(code, kind="stable")
        self.item = np.repeat(np.arange(len(codes), dtype=np.int32), [len(c) for c in codes])[order]
        self.place = np.concatenate([*[np.arange(len(c), dtype=np.int32) for c in codes], np.zeros(0, np.int32)])[order]
        self.codes, first = np.unique(code[order], return_index=True)
        self.edges = np.append(first, len(code)).astype(np.int32)
        self.shift = np.uint64(64 - min(24, max(16, (8 * len(self.codes)).bit_length())))
        self.known = np.zeros(1 << (64 - int(self.shift)), bool)
        self.known[(self.codes * SPREAD) >> self.shift] = True
        self.parts = self._parts(len(codes))

    def _parts(self, first: int) -> ahocorasick.Automaton | None:
        """Parts of the items from `first` on, each with the (item, place in it) that it stands for."""
        parts: dict[str, list[tuple[int, int]]] = {}
        for i in range(first, len(self.texts)):
            text, n = self.texts[i].decode("latin-1"), int(self.edits[i]) + 1
            for k in range(n):
                lo, hi = k * len(text) // n, (k + 1) * len(text) // n
                parts.setdefault(text[lo:hi], []).append((i, lo))
        if not parts:
            return None
        automaton = ahocorasick.Automaton()
        for text, uses in parts.items():
            automaton.add_word(text, (len(text), uses))
        automaton.make_automaton()
        return automaton

    def short(self, document: bytes) -> Iterator[tuple[int, int, int, int, int, int]]:
        """(item, start, end, item start, item end, edits) of the items without a q-gram bound, in plain bytes."""
        for last, (length, uses) in self.parts.iter(document.decode("latin-1")):
            start = last + 1 - length
            for item, place in uses:
                text, edits = self.texts[item], int(self.edits[item])
                begin = start - place
                end = begin + len(text)
                if not edits:
                    if (begin == 0 or document[begin - 1 : begin] == b" ") and (end == len(document) or document[end : end + 1] == b" "):
                        yield item, begin, end, 0, len(text), 0
                    continue
                lo = max(0, begin - WINDOW)
                found = self.verify(document[lo : end + WINDOW], item, np.zeros(1, np.int64), begin - lo)
                if found:
                    yield item, lo + found[0], lo + found[1], *found[2:]

    def stretches(self, buffer: bytes) -> np.ndarray:
        """Rows (position, item, item position) of the q-grams in bands that reach an item's bound, by band."""
        if not len(self.codes):
            return np.zeros((0, 4), np.int64)
        code = grams(buffer)
        at = np.flatnonzero(self.known[(code * SPREAD) >> self.shift])
        which = np.searchsorted(self.codes, code[at])
        which[which == len(self.codes)] = 0
        hit = self.codes[which] == code[at]
        at, which = at[hit], which[hit]
        first = self.edges[which].astype(np.int64)
        times = self.edges[which + 1] - first
        position = np.repeat(at, times)
        entry = np.repeat(first - np.concatenate(([0], np.cumsum(times)[:-1])), times) + np.arange(times.sum()) if len(times) else np.zeros(0, np.int64)
        item, place = self.item[entry].astype(np.int64), self.place[entry].astype(np.int64)
        diagonal = position - place + (1 << 32)
        found = []
        for shift in (0, BAND // 2):
            band = (diagonal + shift) // BAND
            order = np.lexsort((position, band, item))
            i, b, p = item[order], band[order], position[order]
            ahead = np.arange(len(i)) + self.share[i] - 1
            inside = ahead < len(i)
            ahead[~inside] = 0
            reach = self.window[i] - Q + self.edits[i]
            good = np.flatnonzero(inside & (i[ahead] == i) & (b[ahead] == b) & (p[ahead] - p <= reach))
            if len(good):
                rows = np.unique(np.concatenate([np.arange(g, ahead[g] + 1) for g in good]))
                found.append(np.stack((p[rows], i[rows], place[order][rows], b[rows] * 2 + (shift > 0)), axis=1))
        return np.concatenate(found) if found else np.zeros((0, 4), np.int64)

    def verify(self, document: bytes, item: int, starts: np.ndarray, diagonal: int) -> tuple[int, int, int, int, int] | None:
        """Windows of an item at `starts`, aligned near the diagonal: extent in document and item, and least edits."""
        n, allowed, _ = budget(len(self.texts[item]))
        text = np.frombuffer(self.texts[item], np.uint8)
        width = BAND
        padded = np.zeros(len(document) + 2 * (n + 2 * width), np.uint8)
        left = n + 2 * width
        padded[left : left + len(document)] = np.frombuffer(document, np.uint8)
        spread = 2 * width + 1
        cost = np.zeros((len(starts), spread), np.int32)
        origin = np.tile(np.arange(spread), (len(starts), 1))
        base = starts + diagonal + left - width
        base = np.clip(base, 0, len(padded) - n - spread)
        for step in range(n):
            letters = padded[base[:, None] + step + np.arange(spread)]
            match = cost + (letters != text[starts + step][:, None])
            gap = np.concatenate((cost[:, 1:] + 1, np.full((len(starts), 1), 1 << 20, np.int32)), axis=1)
            best = np.minimum(match, gap)
            come = np.where(match <= gap, origin, np.concatenate((origin[:, 1:], origin[:, -1:]), axis=1))
            # Extra letters of the document: a running minimum along the band.
            slope = best - np.arange(spread)
            low = np.minimum.accumulate(slope, axis=1)
            source = np.maximum.accumulate(np.where(slope == low, np.arange(spread), 0), axis=1)
            cost = low + np.arange(spread)
            origin = np.take_along_axis(come, source, axis=1)
        end = np.argmin(cost, axis=1)
        least = cost[np.arange(len(starts)), end]
        good = np.flatnonzero(least <= allowed)
        if not len(good):
            return None
        begin = base[good] - left + origin[good, end[good]]
        finish = base[good] - left + n + end[good]
        return max(0, int(begin.min())), min(len(document), int(finish.max())), int(starts[good].min()), int(starts[good].max()) + n, int(least[good].min())

    def search(self, documents: list[bytes]) -> Iterator[tuple[int, int, int, int, int, int, int]]:
        """(document, item, start, end, item start, item end, edits) of contaminated stretches, in plain bytes."""
        pieces: list[tuple[int, int, bytes]] = []
        overlap = WINDOW * 2 + BAND * 2
        for d, text in enumerate(documents):
            for lo in range(0, max(1, len(text) - overlap), PIECE - overlap):
                pieces.append((d, lo, text[lo : lo + PIECE]))
        at = 0
        while at < len(pieces):
            upto, size = at, 0
            while upto < len(pieces) and (upto == at or size + len(pieces[upto][2]) <= PIECE):
                size += len(pieces[upto][2]) + Q
                upto += 1
            block = pieces[at:upto]
            begins = np.cumsum([0] + [len(p[2]) + Q for p in block])
            rows = self.stretches(b"".join(p[2] + bytes(Q) for p in block))
            if len(rows):
                yield from self._aligned(block, begins, rows)
            at = upto
        if self.parts:
            for d, text in enumerate(documents):
                yield from ((d, *found) for found in self.short(text))

    def _aligned(self, block, begins, rows) -> Iterator[tuple[int, int, int, int, int, int, int]]:
        piece = np.searchsorted(begins, rows[:, 0], "right") - 1
        key = np.stack((piece, rows[:, 1], rows[:, 3]), axis=1)
        order = np.lexsort((rows[:, 0], key[:, 2], key[:, 1], key[:, 0]))
        key, rows = key[order], rows[order]
        jump = np.ones(len(rows), bool)
        jump[1:] = (key[1:] != key[:-1]).any(axis=1) | (rows[1:, 0] - rows[:-1, 0] > WINDOW)
        edges = np.append(np.flatnonzero(jump), len(rows))
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            p, item = int(key[lo, 0]), int(key[lo, 1])
            d, offset, text = block[p]
            first, last = rows[lo], rows[hi - 1]
            n, allowed, _ = budget(len(self.texts[item]))
            a, b = int(first[0] - begins[p]), int(last[0] - begins[p]) + Q
            x, y = int(rows[lo:hi, 2].min()), int(rows[lo:hi, 2].max()) + Q
            if b - a == y - x >= n and text[a:b] == self.texts[item][x:y]:
                yield d, item, offset + a, offset + b, x, y, 0
                continue
            starts = np.arange(max(0, x - n + Q), min(len(self.texts[item]) - n, y - Q) + 1)
            near = int(np.median(rows[lo:hi, 0] - begins[p] - rows[lo:hi, 2]))
            lo_text, hi_text = max(0, a - 2 * WINDOW), min(len(text), b + 2 * WINDOW)
            found = self.verify(text[lo_text:hi_text], item, starts, near - lo_text)
            if found:
                yield d, item, offset + lo_text + found[0], offset + lo_text + found[1], found[2], found[3], found[4]


def _code_points(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of plain(text) as code-point spans of the text itself."""
    plain_at, place = [], []
    spot, start = 0, False
    for i, c in enumerate(text):
        if c in " \t\n\r\x0b\x0c":
            start = True
            continue
        if start and spot:
            plain_at.append(spot)
            place.append(i - 1)
            spot += 1
        start = False
        plain_at.append(spot)
        place.append(i)
        spot += len(c.encode())
    out = []
    for a, b in spans:
        lo = int(np.searchsorted(plain_at, a, "right")) - 1
        hi = int(np.searchsorted(plain_at, b, "left")) - 1
        out.append((place[max(lo, 0)], place[max(hi, 0)] + 1))
    return out


def _merged(found) -> list[tuple[int, int, int, int, int, int, int]]:
    """Overlapping stretches of the same document and item as one."""
    out: list[list[int]] = []
    for row in sorted(found):
        if out and out[-1][:2] == list(row[:2]) and row[2] <= out[-1][3]:
            last = out[-1]
            last[3], last[4], last[5], last[6] = max(last[3], row[3]), min(last[4], row[4]), max(last[5], row[5]), max(last[6], row[6])
        else:
            out.append(list(row))
    return [tuple(r) for r in out]


def find_contamination(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per contaminated stretch, columns as FOUND: offsets are code points of the document and
    bytes of the item's plain form, the end exclusive. Null and empty texts hold nothing and match nothing; repeated
    items each match; empty tables give no rows.

    Every item is searched in every whole text. Items travel to the tasks in blocks of about ITEM_BYTES of text, with an
    index some 20 times as large; a larger benchmark takes one pass over the documents for each block.
    """
    spark = df.sparkSession
    small_batches(spark)
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text")).where(F.col("text").isNotNull())
    total = items.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    passes = max(1, -(-total // ITEM_BYTES))
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    out = None
    for k in range(passes):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k) if passes > 1 else items
        shared = spark.sparkContext.broadcast(Items([(r["item_id"], r["text"]) for r in own.collect()]))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                ids = batch.column("doc_id")
                for lo in range(0, batch.num_rows, 256):
                    texts = batch.column("text").slice(lo, 256).to_pylist()
                    found = _merged(index.search([plain(t) for t in texts]))
                    if found:
                        spans = {d: _code_points(texts[d], [(r[2], r[3]) for r in found if r[0] == d]) for d in {r[0] for r in found}}
                        rows = [(ids[lo + r[0]].as_py(), index.ids[r[1]], *spans[r[0]].pop(0), *r[4:]) for r in found]
                        names = [c.split()[0] for c in FOUND.split(", ")]
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names)

        part = docs.mapInArrow(run, FOUND)
        out = part if out is None else out.unionByName(part)
    return out


def clean(df: DataFrame, benchmark: DataFrame, text_col: str = "text", item_text_col: str = "text") -> DataFrame:
    """The rows of `df`, unchanged, that no benchmark item contaminates. Rows never leave their task."""
    spark = df.sparkSession
    small_batches(spark)
    items = benchmark.select(F.col(item_text_col).alias("text")).where(F.col("text").isNotNull()).distinct()
    total = items.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    passes = max(1, -(-total // ITEM_BYTES))
    for k in range(passes):
        own = items.where(F.pmod(F.xxhash64("text"), F.lit(passes)) == k) if passes > 1 else items
        shared = spark.sparkContext.broadcast(Items([(i, r["text"]) for i, r in enumerate(own.collect())]))

        @F.pandas_udf("boolean")
        def free(texts, shared=shared):
            import pandas as pd

            out = np.ones(len(texts), bool)
            for lo in range(0, len(texts), 256):
                for d in {r[0] for r in shared.value.search([plain(t) for t in texts[lo : lo + 256]])}:
                    out[lo + d] = False
            return pd.Series(out)

        df = df.where(free(F.col(text_col)))
    return df
