"""Benchmark decontamination: q-gram lemma over diagonal bands, then banded alignment."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyboard.llm.common import slices

Q = 10
#: Edits allowed for each character of an item.
EDIT_RATE = 0.08
#: Characters of benchmark text that one broadcast index is made of; more text makes more indexes.
INDEX_CHARS = 8_000_000
_BITMAP_BITS = 22
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_WORD = re.compile(r"[^\W_]+")

SCHEMA = "doc_id long, item_id long, edits int, span_start long, span_end long"


def normal_form(text: str) -> str:
    """Words of letters and digits in lower case, one space between them."""
    return " ".join(_WORD.findall(text.lower()))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


def _qgrams(codes: np.ndarray, q: int) -> np.ndarray:
    n = max(len(codes) - q + 1, 0)
    h = np.zeros(n, np.uint64)
    for j in range(q):
        h *= _FACTOR
        h += codes[j : j + n]
    return h ^ (h >> np.uint64(29))


def edit_budget(length: int, q: int, rate: float) -> int:
    """Edits allowed; never so many that the lemma would ask for no shared q-gram."""
    return max(0, min(int(rate * length), (length - q) // q))


def shared_needed(length: int, budget: int, q: int) -> int:
    """The q-gram lemma: a text within ``budget`` edits of one of ``length`` shares as many q-grams at least."""
    return length - q + 1 - budget * q


@dataclass
class Item:
    item_id: int
    codes: np.ndarray
    budget: int
    needed: int


class BenchmarkIndex:
    """The q-grams of benchmark items, sorted, with a bitmap before them."""

    def __init__(self, items: list[tuple[int, str]], q: int = Q, rate: float = EDIT_RATE):
        self.q = q
        self.items: list[Item] = []
        self.short: dict[tuple[str, ...], list[int]] = {}  # words of an item too short for q-grams -> its ids
        grams, owner, place = [], [], []
        for item_id, text in items:
            form = normal_form(text or "")
            codes = _codes(form)
            if len(codes) < q:
                if form:
                    self.short.setdefault(tuple(form.split(" ")), []).append(item_id)
                continue
            budget = edit_budget(len(codes), q, rate)
            h = _qgrams(codes, q)
            grams.append(h)
            owner.append(np.full(len(h), len(self.items), np.int64))
            place.append(np.arange(len(h)))
            self.items.append(Item(item_id, codes, budget, shared_needed(len(codes), budget, q)))
        joined = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        order = np.argsort(joined, kind="stable")
        self.grams = joined[order]
        self.owner = (np.concatenate(owner) if owner else np.zeros(0, np.int64))[order]
        self.place = (np.concatenate(place) if place else np.zeros(0, np.int64))[order]
        self.seen = np.zeros(1 << _BITMAP_BITS, bool)
        self.seen[self.grams >> np.uint64(64 - _BITMAP_BITS)] = True
        self.width = np.array([item.budget + 1 for item in self.items], np.int64)
        self.needed = np.array([item.needed for item in self.items], np.int64)

    def whole_words(self, form: str) -> Iterator[tuple[int, int, int]]:
        """(item id, start, end) in the normal form of the first place of each short item, word for word."""
        words = form.split(" ")
        for size in {len(key) for key in self.short}:
            left = {key for key in self.short if len(key) == size}
            for at in range(len(words) - size + 1):
                key = tuple(words[at : at + size])
                if key in left:
                    left.remove(key)
                    start = sum(map(len, words[:at])) + at
                    for item_id in self.short[key]:
                        yield item_id, start, start + len(" ".join(key))
                    if not left:
                        break

    def candidates(self, codes: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, lowest, highest diagonal) of the bands that share enough q-grams with an item.

        A band is two neighbouring cells, each one wider than the budget, and neighbouring bands
        overlap by a cell: an alignment drifts by at most the budget, so one band holds all of it.
        """
        h = _qgrams(codes, self.q)
        at = np.flatnonzero(self.seen[h >> np.uint64(64 - _BITMAP_BITS)])
        low = np.searchsorted(self.grams, h[at], "left")
        counts = np.searchsorted(self.grams, h[at], "right") - low
        hit = counts > 0
        at, low, counts = at[hit], low[hit], counts[hit]
        if not len(at):
            return []
        ends = np.cumsum(counts)
        entry = np.arange(ends[-1]) - np.repeat(ends - counts, counts) + np.repeat(low, counts)
        item = self.owner[entry]
        cell = (np.repeat(at, counts) - self.place[entry] + self._shift) // self.width[item]
        keys, shared = np.unique((item << 40) + cell, return_counts=True)
        following = np.append(shared[1:] * (keys[1:] == keys[:-1] + 1), 0)
        before = np.append(0, shared[:-1] * (keys[1:] == keys[:-1] + 1))
        items = keys >> 40
        cells = keys & ((1 << 40) - 1)
        out = set()
        for good, shift in ((shared + following >= self.needed[items], 0), (shared + before >= self.needed[items], -1)):
            for i, c in zip(items[good].tolist(), cells[good].tolist(), strict=True):
                width = int(self.width[i])
                first = (c + shift) * width - self._shift
                out.add((i, first, first + 2 * width - 1))
        return sorted(out)

    @property
    def _shift(self) -> int:
        """Makes every diagonal of a batch positive."""
        return 1 << 32


def banded_distance(pattern: np.ndarray, text: np.ndarray, low: int, high: int) -> tuple[int, int]:
    """Fewest edits that turn ``pattern`` into some stretch of ``text`` along diagonals low..high, and where it ends.

    Diagonal d means that pattern position i stands at text position i + d. The
    stretch may begin and end anywhere in the band.
    """
    big = 1 << 29
    d = np.arange(low, high + 1)
    steps = np.arange(len(d))
    row = np.where((d >= 0) & (d <= len(text)), 0, big)
    for i, code in enumerate(pattern):
        at = i + d  # text position that pattern[i] meets on the diagonal
        inside = (at >= 0) & (at < len(text))
        same = np.zeros(len(d), bool)
        same[inside] = text[at[inside]] == code
        # Match or substitute on the diagonal; drop pattern[i] and go one diagonal down.
        step = np.where(inside, row + ~same, big)
        step[:-1] = np.minimum(step[:-1], row[1:] + 1)
        ends = at + 1
        step[(ends < 0) | (ends > len(text))] = big
        # Extra text characters go up the diagonals, one edit each.
        row = np.minimum(np.minimum.accumulate(step - steps) + steps, big)
        row[(ends < 0) | (ends > len(text))] = big
    best = int(np.argmin(row))
    return int(row[best]), len(pattern) + int(d[best])


def passages(index: BenchmarkIndex, texts: list[str]) -> Iterator[tuple[int, int, int, int, int]]:
    """(text number, item id, edits, start, end in code points of the text) of each item found, its best place."""
    forms = [normal_form(t) for t in texts]
    codes = _codes("\n".join(forms) + "\n")
    starts = np.cumsum([0] + [len(f) + 1 for f in forms])
    best: dict[tuple[int, int], tuple[int, int]] = {}
    for i, low, high in index.candidates(codes) if index.items else ():
        item = index.items[i]
        # The documents that the band crosses: usually one.
        first = int(np.searchsorted(starts, max(low, 0), "right")) - 1
        last = int(np.searchsorted(starts, min(max(high + len(item.codes), 0), starts[-1] - 1), "right")) - 1
        for doc in range(max(first, 0), min(last, len(texts) - 1) + 1):
            a, b = int(starts[doc]), int(starts[doc + 1]) - 1
            # Only what the band can reach: a long text is not copied whole.
            left = max(a, low - item.budget)
            right = min(b, high + len(item.codes) + item.budget + 1)
            if right - left < len(item.codes) - item.budget:
                continue
            edits, end = banded_distance(item.codes, codes[left:right], low - left - item.budget, high - left + item.budget)
            if edits <= item.budget:
                found = (edits, end + left - a)
                key = (doc, i)
                if key not in best or found < best[key]:
                    best[key] = found
    spans: dict[int, list[tuple[int, int]]] = {}
    for (doc, i), (edits, end) in sorted(best.items()):
        item = index.items[i]
        if doc not in spans:
            spans[doc] = _word_spans(texts[doc])
        start = max(0, end - len(item.codes))
        yield doc, item.item_id, edits, *_original(spans[doc], start, end)
    for doc, form in enumerate(forms if index.short else ()):
        for item_id, start, end in index.whole_words(form):
            yield doc, item_id, 0, *_original(_word_spans(texts[doc]), start, end)


def _word_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, length in lower case) of each word; a letter may grow in lower case, so places there are led back."""
    lower = text.lower()
    found = [m.span() for m in _WORD.finditer(lower)]
    if len(lower) == len(text):
        return [(a, b, b - a) for a, b in found]
    owner = [i for i, c in enumerate(text) for _ in c.lower()]
    return [(owner[a], owner[b - 1] + 1, b - a) for a, b in found]


def _original(words: list[tuple[int, int, int]], start: int, end: int) -> tuple[int, int]:
    """From positions in the normal form to code points of the text, whole words."""
    at, first, last = 0, None, 0
    for a, b, size in words:
        if at + size > start and first is None:
            first = a
        if at < end:
            last = b
        at += size + 1
        if at >= end:
            break
    return first or 0, last


def contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    q: int = Q,
    rate: float = EDIT_RATE,
    index_chars: int = INDEX_CHARS,
    short_items: bool = True,
) -> DataFrame:
    """One row per document and benchmark item found in it: doc_id, item_id, edits, span_start, span_end.

    An item of m characters (in normal form: words in lower case, one space apart) is found where some stretch of the
    document is within ``rate`` * m edits of it. Such a stretch shares at least
    m - q + 1 - budget * q of the item's q-grams, all within a band of diagonals as wide as the budget; bands that share
    fewer are passed over, the others verified by banded alignment. The span is the best place, earliest
    among equals, in code points of the text.

    Benchmark text is indexed and broadcast in parts of ``index_chars`` characters, so
    any amount of it is searched; the documents are read once per part and never shuffled.
    An item whose normal form is shorter than q characters is found where its words stand side by side, without
    edits; with ``short_items`` false it is not looked for. Null texts and those without a word contain nothing and are contained nowhere. Items with one text are all found; repeated documents are repeated.
    """
    spark = documents.sparkSession
    items = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    size = items.agg(F.sum(F.char_length("text"))).first()[0] or 0
    parts = -(-size // index_chars) or 1
    bodies = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("body"))
    found = None
    for part in range(parts):
        chosen = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        rows = [(row.item_id, row.text) for row in chosen.orderBy("item_id", "text").collect()]  # about index_chars
        shared = spark.sparkContext.broadcast(rows)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = BenchmarkIndex(shared.value, q, rate)
            if not short_items:
                index.short = {}
            for batch in slices(batches, "body"):
                texts = [t or "" for t in batch.column("body").to_pylist()]
                ids = batch.column("doc_id").to_pylist()
                hits = list(passages(index, texts)) if index.items or index.short else []
                columns = [
                    pa.array([ids[h[0]] for h in hits], pa.int64()),
                    pa.array([h[1] for h in hits], pa.int64()),
                    pa.array([h[2] for h in hits], pa.int32()),
                    pa.array([h[3] for h in hits], pa.int64()),
                    pa.array([h[4] for h in hits], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "edits", "span_start", "span_end"])

        here = bodies.mapInArrow(search, SCHEMA)
        found = here if found is None else found.unionByName(here)
    return found
