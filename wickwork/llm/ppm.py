"""Language-model scores by prediction by partial matching over bytes.

The training texts are counted into byte contexts of up to `ORDER` bytes. A byte is coded in
its longest known context; a byte new to that context escapes to the next shorter one, with
the escape estimate of method C (Moffat 1990) and with all bytes of the longer context
excluded, down to equal odds for bytes never seen. The model is trained beforehand, not
while scoring, so a byte's code length depends on its window of `ORDER + 1` bytes alone:
each distinct window of a batch is coded once.

A text is coded as its words, lower-case, one blank between, and an end symbol. Beside it
stands the unigram base score. The trie is a table per order that holds every window of the
training texts; the probability of each distinct window of the documents comes from joins with
its shorter windows, so nothing is pruned whatever the corpus size. The windows that the
documents use most (`MODEL_WINDOWS` at most) are broadcast with their probabilities, and so are
frequent tokens (`MODEL_TOKENS` at most) with their counts; all others meet theirs in a join.

Defined results: null, empty and blank texts have one token, the end; repeated rows are scored
alike; without training texts every byte has odds of 1 in 256.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import annotate, stored, within, written
from .words import BLANK_WORDS, Words, slices

ORDER = 5
MODEL_WINDOWS = 1 << 20
MODEL_TOKENS = 1 << 20
END = 0xFF  # never a byte of UTF-8
END_TOKEN = np.uint64(0x656E64)
TOKEN, WINDOW = 0, 1


# ---- byte windows ------------------------------------------------------------------------


def windows(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The window of every coded byte, oldest byte first, and the number of bytes per text.

    In front of a text stand `ORDER` end symbols.
    """
    lengths = words.ends - words.starts
    coded = np.bincount(
        np.repeat(np.arange(len(words.counts)), words.counts), weights=lengths + 1, minlength=len(words.counts)
    ).astype(np.int64)
    coded[words.counts == 0] = 1
    place = np.concatenate([[0], np.cumsum(coded + ORDER)])
    stream = np.full(int(place[-1]), END, np.uint64)
    if len(lengths):
        # Each word moves to its place; one byte behind it is a blank, or the end symbol.
        before = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
        empty = np.concatenate([[0], np.cumsum(words.counts == 0)])
        of = np.repeat(np.arange(len(words.counts)), words.counts)
        to = before + ORDER * (of + 1) + empty[of]
        shift = np.repeat(to - words.starts, lengths)
        at = np.arange(int(lengths.sum())) + np.repeat(
            words.starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths
        )
        stream[at + shift] = words.data[at]
        last = np.zeros(len(lengths), bool)
        last[words.first[1:][words.counts > 0] - 1] = True
        stream[(to + lengths)[~last]] = 0x20
    code = np.zeros(max(len(stream) - ORDER, 0), np.uint64)
    for k in range(ORDER + 1):
        code = (code << np.uint64(8)) | stream[k : k + len(code)]
    keep = np.ones(len(stream), bool)
    for k in range(ORDER):
        keep[place[:-1] + k] = False
    return code[keep[ORDER:]], coded


def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of distinct keys."""
    if not keys:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    all_keys, all_counts = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(all_keys, kind="stable")
    all_keys, all_counts = all_keys[order], all_counts[order]
    first = np.flatnonzero(np.concatenate([[True], all_keys[1:] != all_keys[:-1]])[: len(all_keys)])
    return all_keys[first], np.add.reduceat(all_counts, first) if len(first) else all_counts


class Tally:
    """Counts of keys, merged whenever many have gathered."""

    LIMIT = 1 << 21

    def __init__(self):
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.size = 0

    def add(self, keys: np.ndarray) -> None:
        found, n = np.unique(keys, return_counts=True)
        self.keys.append(found)
        self.counts.append(n)
        self.size += len(found)
        if self.size > self.LIMIT:
            keys, n = merged(self.keys, self.counts)
            self.keys, self.counts, self.size = [keys], [n], 0

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        return merged(self.keys, self.counts)


def corpus_counts(texts: DataFrame, wanted: tuple[int, ...] = (TOKEN, WINDOW)) -> DataFrame:
    """(kind, key, n): token hashes and byte windows of all texts, with their counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies = {kind: Tally() for kind in wanted}
        for batch in slices(batches, lambda b: b.column(0)):
            words = Words(batch.column(0), BLANK_WORDS, lower=True)
            if TOKEN in tallies:
                ends = np.full(batch.num_rows, END_TOKEN, np.uint64)
                tallies[TOKEN].add(np.concatenate([words.hashes(), ends]))
            if WINDOW in tallies:
                tallies[WINDOW].add(windows(words)[0])
        for kind, tally in tallies.items():
            keys, n = tally.total()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(keys), kind, np.int8)), pa.array(keys.view(np.int64)), pa.array(n)],
                names=["kind", "key", "n"],
            )

    parts = texts.mapInArrow(count, "kind tinyint, key bigint, n bigint")
    return written(parts.groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")


def threshold(tables: list[DataFrame], most: int) -> int:
    """The smallest count such that at most `most` keys of all tables occur so often."""
    bins: dict[int, int] = {}
    for table in tables:
        step = F.floor(F.log2("n") * 8).cast("int").alias("step")
        for level, rows in table.groupBy(step).agg(F.count("*")).collect():
            bins[level] = bins.get(level, 0) + rows
    kept, low = 0, None
    for level in sorted(bins, reverse=True):
        kept += bins[level]
        if kept > most:
            break
        low = level
    if low is None:
        return 1 << 62
    return 1 if low == min(bins) else math.ceil(2 ** (low / 8))


# ---- the trie ----------------------------------------------------------------------------


@dataclass
class Level:
    """Contexts of one length: their windows, sums, numbers of bytes, and what they exclude."""

    windows: np.ndarray
    counts: np.ndarray
    contexts: np.ndarray
    sums: np.ndarray
    kinds: np.ndarray
    excluded: np.ndarray  # of the next shorter context's sum: bytes that this one holds


class Trie:
    """The odds that `window_odds` gets from joins, in memory, for few windows."""

    def __init__(self, tables: list[tuple[np.ndarray, np.ndarray]]):
        """tables: windows (as keys) and counts by order, 0 first."""
        self.levels: list[Level] = []
        for order, (keys, counts) in enumerate(tables):
            at = np.argsort(keys)
            keys, counts = keys[at].astype(np.uint64), counts[at].astype(np.float64)
            contexts, of = np.unique(keys >> np.uint64(8), return_inverse=True)
            sums = np.bincount(of, weights=counts, minlength=len(contexts))
            kinds = np.bincount(of, minlength=len(contexts)).astype(np.float64)
            excluded = np.zeros(len(contexts))
            if order:
                below = self.levels[-1]
                suffix = keys & np.uint64((1 << (8 * order)) - 1)
                excluded = np.bincount(
                    of, weights=below.counts[within(below.windows, suffix)], minlength=len(contexts)
                )
            self.levels.append(Level(keys, counts, contexts, sums, kinds, excluded))

    def log10(self, codes: np.ndarray) -> np.ndarray:
        """log10 of the probability of the last byte of each window after the bytes before it."""
        out = np.zeros(len(codes))
        open_ = np.arange(len(codes))
        less_sum, less_kinds = np.zeros(len(codes)), np.zeros(len(codes))
        for order in range(ORDER, -1, -1):
            if not len(open_):
                return out
            level = self.levels[order]
            window = codes[open_] & np.uint64((1 << (8 * (order + 1))) - 1)
            context = within(level.contexts, window >> np.uint64(8))
            known = context >= 0
            at = np.maximum(context, 0)
            if not len(level.contexts):
                continue
            sums = level.sums[at] - less_sum[open_]
            kinds = level.kinds[at] - less_kinds[open_]
            hit = within(level.windows, window)
            found = known & (hit >= 0)
            room = sums + kinds
            out[open_[found]] += np.log10(level.counts[hit[found]] / room[found])
            escape = known & (hit < 0) & (room > 0)
            out[open_[escape]] += np.log10(kinds[escape] / room[escape])
            less_sum[open_] = np.where(known, level.excluded[at], 0.0)
            less_kinds[open_] = np.where(known, level.kinds[at], 0.0)
            open_ = open_[~found]
        seen = self.levels[0].kinds[0] if len(self.levels[0].kinds) else 0
        out[open_] -= math.log10(256 - seen) if seen < 256 else 0.0
        return out


def after(at: str, less_sum: Column, less_kinds: Column) -> Column:
    """log10 of the last byte's probability at one order; what the longer context holds is less."""
    n, sums, kinds, rest = (F.col(f"{at}{c}") for c in ("n", "sums", "kinds", "rest"))
    room = sums + kinds - less_sum - less_kinds
    odds = F.when(n > 0, n).otherwise(kinds - less_kinds) / F.when(room > 0, room)
    return (
        F.when(kinds == 0, rest)
        .when(n > 0, F.log10(odds))
        .when(room > 0, F.log10(odds) + rest)
        .otherwise(rest)
    )


def window_odds(counts: DataFrame, asked: DataFrame, order: int = ORDER) -> DataFrame:
    """(key, m, log) of each asked window (key, m): log10 of its last byte's probability.

    counts: (key, n) of all training windows. A table per order holds the windows of both,
    n = 0 for those that training lacks. From the shortest up, each window meets its suffix,
    which has at most 256 longer windows, as a context has at most 256 bytes; `rest` is the
    code of a byte that escapes to the suffix.
    """
    both = counts.select("key", "n", F.lit(0).cast("bigint").alias("m")).union(
        asked.select("key", F.lit(0).cast("bigint"), "m")
    )
    longest = written(both.groupBy("key").agg(F.sum("n").alias("n"), F.sum("m").alias("m")), "windows")
    tables = [longest]
    for size in range(order, 0, -1):
        suffix = F.col("key").bitwiseAND(F.lit((1 << (8 * size)) - 1))
        tables.append(stored(tables[-1].groupBy(suffix.alias("key")).agg(F.sum("n").alias("n"))))
    of = Window.partitionBy("context")
    seen = F.col("n") > 0
    facts = {
        "context": F.shiftright("key", 8),
        "sums": F.sum("n").over(of),
        "kinds": F.sum(F.when(seen, 1).otherwise(0)).over(of),
    }
    below = None
    for size, table in enumerate(reversed(tables)):
        if below is not None:
            suffix = F.col("key").bitwiseAND(F.lit((1 << (8 * size)) - 1))
            table = table.join(below, suffix == F.col("below_key"))
        for name, column in facts.items():
            table = table.withColumn(name, column)
        if below is None:
            fresh = F.when(F.col("kinds") < 256, -F.log10(256 - F.col("kinds"))).otherwise(0.0)
        else:
            table = table.withColumn("excluded", F.sum(F.when(seen, F.col("below_n")).otherwise(0)).over(of))
            # Without a known context nothing is excluded: its sums are 0.
            fresh = after("below_", F.col("excluded"), F.col("kinds"))
        level = table.withColumn("rest", F.when(seen, 0.0).otherwise(fresh))
        below = level.select(*[F.col(c).alias(f"below_{c}") for c in ("key", "n", "sums", "kinds", "rest")])
    none = F.lit(0)
    return written(level.where("m > 0").select("key", "m", after("", none, none).alias("log")), "odds")


# ---- documents ---------------------------------------------------------------------------

FIELDS = [
    ("n_tokens", "bigint"),
    ("n_known", "bigint"),
    ("log_counts", "double"),
    ("score", "double"),
    ("rare", "array<struct<key:bigint,n:int>>"),
    ("rare_windows", "array<struct<key:bigint,n:int>>"),
]


def score(
    docs: DataFrame,
    training: DataFrame,
    *,
    text: str = "text",
    training_text: str = "text",
    keep: list[str] | None = None,
    most_windows: int = MODEL_WINDOWS,
    most_tokens: int = MODEL_TOKENS,
) -> DataFrame:
    """(row, n_tokens, n_known, train_tokens, base_score, score) of each document."""
    context = docs.sparkSession.sparkContext
    counts = corpus_counts(training.select(training[training_text].cast("string")))
    vocabulary = counts.where(F.col("kind") == TOKEN).select("key", "n")
    total, kinds = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    frequent = threshold([vocabulary], most_tokens)
    rows = vocabulary.where(F.col("n") >= frequent).toArrow()
    keys = rows.column("key").to_numpy().view(np.uint64)
    at = np.argsort(keys)
    logs = np.log10(rows.column("n").to_numpy()[at] + 1.0)
    asked = corpus_counts(docs.select(docs[text].cast("string")), (WINDOW,))
    odds = window_odds(
        counts.where(F.col("kind") == WINDOW), asked.select("key", F.col("n").alias("m"))
    )
    often = threshold([odds.select(F.col("m").alias("n"))], most_windows)
    rows = odds.where(F.col("m") >= often).toArrow()
    codes = rows.column("key").to_numpy().view(np.uint64)
    by_code = np.argsort(codes)
    code_logs = rows.column("log").to_numpy()[by_code]
    model = context.broadcast((codes[by_code], code_logs, keys[at], logs))

    def work(texts: pa.Array) -> list:
        cached, code_logs, known, logs = model.value
        words = Words(texts, BLANK_WORDS, lower=True)
        codes, coded = windows(words)
        distinct, place = np.unique(codes, return_inverse=True)
        first = np.concatenate([[0], np.cumsum(coded)[:-1]])
        at = within(cached, distinct)
        found = at >= 0
        values = np.zeros(len(distinct))
        values[found] = code_logs[at[found]]
        scores = np.add.reduceat(values[place], first) if len(coded) else []
        missed = ~found[place]
        windows_of = np.repeat(np.arange(len(coded)), coded)[missed]
        rare_windows = rare_keys(codes[missed], windows_of, len(coded))
        # One end symbol behind the words of each text.
        tokens = np.insert(words.hashes(), words.first[1:], END_TOKEN)
        size = words.counts + 1
        of = np.repeat(np.arange(len(size)), size)
        at = within(known, tokens)
        found = at >= 0
        part = np.bincount(of[found], weights=logs[at[found]], minlength=len(size))
        n_known = np.bincount(of[found], minlength=len(size))
        rare = rare_keys(tokens[~found], of[~found], len(size))
        return [size, n_known, part, scores, rare, rare_windows]

    plain = annotate(docs, text, FIELDS, work, keep)
    table = written(plain.withColumn("id", F.monotonically_increasing_id()), "scored")
    rare = table.select("id", F.inline("rare")).join(
        vocabulary.where(F.col("n") < frequent).withColumnRenamed("n", "count"), "key"
    )
    rare_windows = table.select("id", F.inline("rare_windows")).join(
        odds.where(F.col("m") < often).select("key", "log"), "key"
    )
    parts = rare.select(
        "id", "n", (F.col("n") * F.log10(F.col("count") + 1.0)).alias("logs"), F.lit(0.0).alias("code")
    ).union(rare_windows.select("id", F.lit(0), F.lit(0.0), F.col("n") * F.col("log")))
    more = parts.groupBy("id").agg(
        F.sum("n").alias("more_known"), F.sum("logs").alias("more_logs"), F.sum("code").alias("more_score")
    )
    logs_of_all = F.col("log_counts") + F.coalesce("more_logs", F.lit(0.0))
    unit = math.log10(total + kinds + 1)
    return table.join(more, "id", "left").select(
        "row",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).cast("bigint").alias("n_known"),
        F.lit(int(total)).cast("bigint").alias("train_tokens"),
        (logs_of_all - F.col("n_tokens") * unit).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )


def rare_keys(keys: np.ndarray, of: np.ndarray, count: int) -> pa.Array:
    """Per text the keys that are not frequent, each with its number."""
    order = np.lexsort((keys, of))
    keys, of = keys[order], of[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (of[1:] != of[:-1])
    first = np.flatnonzero(fresh)
    number = np.diff(np.append(first, len(keys))).astype(np.int32)
    per_row = np.bincount(of[first], minlength=count)
    offsets = np.concatenate([[0], np.cumsum(per_row)]).astype(np.int32)
    inside = pa.StructArray.from_arrays(
        [pa.array(keys[first].view(np.int64)), pa.array(number)], names=["key", "n"]
    )
    return pa.ListArray.from_arrays(pa.array(offsets), inside)
