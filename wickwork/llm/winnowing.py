"""Benchmark decontamination by winnowing.

Every text keeps the smallest hash of each window of word grams (Schleimer, Wilkerson and
Aiken 2003). With grams of 5 words and windows of 6 grams, any run of 10 shared words
leaves a shared fingerprint. Fingerprints of the documents meet those of the benchmark;
around each hit all 10-word windows are compared word by word, and the windows that agree
extend the hit to its whole span.

The benchmark is read in blocks of `block_bytes` of text at most (or one item). A block's
index is broadcast, documents pass by without a shuffle; further blocks go over the
documents again. Items shorter than a window are one window of their own length.

Defined results: null or empty text has no words and no hit; null or empty items have no
window; an item with a null id marks words but is neither counted nor listed; items that
share an id are one item; an empty benchmark leaves all documents clean.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import annotate, sliding, stored, within
from .words import LETTER_WORDS, Words, gram_starts, range_hashes

WINDOW = 10
GRAM = 5
BLOCK_BYTES = 4 << 20

FIELDS = [
    ("n_words", "bigint"),
    ("spans", "array<struct<start:int,end:int>>"),
    ("items", "array<string>"),
]


def fingerprints(words: Words, hashes: np.ndarray, window: int, gram: int) -> np.ndarray:
    """First words of the grams that winnowing keeps, and their hashes.

    A gram is kept if it is the smallest (or ties) in a window of `window` words of one text.
    """
    starts, _ = gram_starts(words, window)
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    width = window - gram + 1
    first = np.arange(len(hashes) - gram + 1)
    grams = range_hashes(hashes, first, first + gram)
    smallest = np.zeros(len(grams) + width - 1, np.uint64)
    smallest[starts + width - 1] = sliding(grams, width, np.minimum)[starts]
    # Windows over gram p start at p - width + 1 to p.
    kept = np.flatnonzero(sliding(smallest, width, np.maximum) == grams)
    return kept, grams[kept]


class Index:
    """Windows and fingerprints of one block of benchmark items."""

    def __init__(self, ids: list, texts: pa.Array, window: int, gram: int):
        words = Words(texts, LETTER_WORDS, lower=True)
        hashes = words.hashes()
        self.ids, self.window, self.gram = ids, window, gram
        self.words = words
        self.tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.kept = np.unique(fingerprints(words, hashes, window, gram)[1])
        item_of = np.repeat(np.arange(len(ids)), words.counts)
        starts, _ = gram_starts(words, window)
        self._table(window, range_hashes(hashes, starts, starts + window), starts, item_of)
        for size in np.unique(words.counts[(words.counts > 0) & (words.counts < window)]):
            at = words.first[:-1][words.counts == size]
            self._table(int(size), range_hashes(hashes, at, at + size), at, item_of)

    def _table(self, size, hashes, starts, item_of) -> None:
        if len(starts):
            order = np.argsort(hashes, kind="stable")
            self.tables[size] = hashes[order], starts[order]
            self.item_of = item_of

    def hits(self, words: Words, hashes: np.ndarray) -> list[tuple[int, int, set]]:
        """(first word, length, items) of every window of the documents that an item holds."""
        found = []
        for size, (table, places) in self.tables.items():
            starts, _ = gram_starts(words, size)
            if size == self.window and len(starts):
                kept, grams = fingerprints(words, hashes, size, self.gram)
                kept = kept[within(self.kept, grams) >= 0]
                near = np.zeros(len(hashes) + 1, bool)
                for back in range(size - self.gram + 1):
                    near[np.maximum(kept - back, -1)] = True
                starts = starts[near[starts]]
            if not len(starts):
                continue
            at = within(table, range_hashes(hashes, starts, starts + size))
            for start, row in zip(starts[at >= 0].tolist(), at[at >= 0].tolist()):
                mine = [words.word(i) for i in range(start, start + size)]
                items = self._items(table, places, row, mine, size)
                if items is not None:
                    found.append((start, size, items))
        return found

    def _items(self, table, places, row, mine, size) -> set | None:
        """Items whose window at this hash has these very words; None if there is none."""
        value, items, same = table[row], set(), False
        while row < len(table) and table[row] == value:
            place = int(places[row])
            if [self.words.word(i) for i in range(place, place + size)] == mine:
                same = True
                if self.ids[self.item_of[place]] is not None:
                    items.add(self.ids[self.item_of[place]])
            row += 1
        return items if same else None


def merged(spans: list[tuple[int, int]]) -> list[dict]:
    out: list[dict] = []
    for start, end in sorted(spans):
        if out and start <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], end)
        else:
            out.append({"start": start, "end": end})
    return out


def scan(texts: pa.Array, index: Index) -> tuple:
    words = Words(texts, LETTER_WORDS, lower=True)
    spans: list = [[] for _ in range(len(texts))]
    items: list = [[] for _ in range(len(texts))]
    per_row: dict[int, tuple[list, set]] = {}
    for start, size, found in index.hits(words, words.hashes()):
        row = int(np.searchsorted(words.first, start, "right")) - 1
        at = start - int(words.first[row])
        own = per_row.setdefault(row, ([], set()))
        own[0].append((at, at + size))
        own[1].update(found)
    for row, (own, ids) in per_row.items():
        spans[row], items[row] = merged(own), sorted(ids)
    return words.counts, spans, items


def blocks(benchmark: DataFrame, item: str, text: str, block_bytes: int):
    """The number of blocks, and each as (ids, texts) of bounded size, read when it is its turn."""
    table = benchmark.select(
        benchmark[item].cast("string").alias("item"), benchmark[text].cast("string").alias("text")
    ).where("text is not null")
    size = table.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    # Half full on average, so that a hash that deals unevenly still keeps the bound.
    count = max(1, -(-2 * size // block_bytes)) if size > block_bytes else 1

    def read(k: int):
        part = table.where(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == k)
        rows = part.distinct().toArrow()
        return rows.column("item").to_pylist(), rows.column("text").combine_chunks()

    return count, (read(k) for k in range(count))


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    keep: list[str] | None = None,
    window: int = WINDOW,
    gram: int = GRAM,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(row, n_words, spans, items): word spans of each text that benchmark windows cover."""
    context = docs.sparkSession.sparkContext
    count, parts = blocks(benchmark, item, item_text, block_bytes)
    keep = list(docs.columns if keep is None else keep)
    out = None
    for ids, texts in parts:
        index = context.broadcast(Index(ids, texts, window, gram))

        def work(values: pa.Array, index=index):
            return scan(values, index.value)

        if count == 1:
            return annotate(docs, text, FIELDS, work, keep)
        if out is None:
            packed = docs.select(
                F.struct(*[docs[c] for c in keep]).alias("kept"),
                docs[text].cast("string").alias("text"),
            )
            out = annotate(packed, "text", FIELDS, work)
        else:
            # What earlier blocks have found travels with the row.
            so_far = out.select("row.kept", "row.text", "n_words", "spans", "items")
            out = annotate(stored(so_far), "text", FIELDS, work).select(
                "row",
                "n_words",
                F.expr(UNION).alias("spans"),
                F.array_sort(F.array_union("items", "row.items")).alias("items"),
            )
    return out.select(F.col("row.kept").alias("row"), "n_words", "spans", "items")


#: Two sorted lists of spans as one; overlapping and touching spans become one span.
UNION = """
aggregate(
  array_sort(concat(spans, row.spans)),
  cast(array() as array<struct<start:int,end:int>>),
  (done, s) -> if(size(done) > 0 and s.start <= element_at(done, -1).end,
    concat(slice(done, 1, size(done) - 1),
           array(named_struct('start', element_at(done, -1).start,
                              'end', greatest(element_at(done, -1).end, s.end)))),
    concat(done, array(s))))
"""


def summary(leaks: DataFrame, key: str) -> DataFrame:
    """One row per document: its key, counts, and a digest of the items found."""
    n_hit = F.expr("cast(aggregate(spans, 0L, (n, s) -> n + s.end - s.start) as bigint)")
    return leaks.select(
        F.col(f"row.{key}").alias(key),
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
