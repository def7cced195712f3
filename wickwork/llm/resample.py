"""Documents drawn towards a target distribution, by importance weights of hashed n-grams.

Features are all runs of one to three words of a text, hashed into `BUCKETS` counts. A bucket
that the target has more often than the corpus has a positive gain; a document's weight is the
sum of its features' gains, and Gumbel noise from its id makes the highest scores a random
draw in proportion to the weights.

Segments are deduplicated. A newline separates words, so it cuts a text into lines: the runs
inside a line depend on that line alone. Equal lines of all documents are grouped (by their
text, with partial counts before the shuffle), the features of each distinct line are hashed
once, its bucket counts are multiplied by its occurrences, and its gain is summed once and
joined back to the places where it stands. Runs that reach over a line's end are few; they are
hashed per document and added separately.

At scale: texts are read twice and never gathered. Lines of more than a thousandth of all
places meet them by broadcast (a thousand rows at most), the rest by a shuffle on 16-byte keys.
Through the driver go `BUCKETS` counts, whatever the input.

Defined results: null, empty and blank texts, and texts of signs only, have no features, weight
0 and are never drawn, as they have fewer than `LEAST_WORDS` words; a null id hashes like an
empty one; rows that share an id share its noise and are drawn or left separately (ties by
weight); very long texts are worked through whole, alone in their slice; an empty table gives
no rows, an empty target a corpus-only gain; columns of the input sit inside `row`, so their
names cannot clash.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import annotate, bounded_batches, hot_join, ranked, written
from .words import LETTER_WORDS, Words, slices, text_bytes

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 5
SEED = 42

# ---- CRC-32 of runs of words, from those of the words -------------------------------------

_POLYNOMIAL = np.uint32(0xEDB88320)
#: Words of more bytes are hashed one by one; the CRC is moved on by so many bytes at once.
_STEP = 128


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """The CRC of each byte, and the CRC register moved over 0 to _STEP zero bytes, by bytes."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, (one >> 1) ^ _POLYNOMIAL, one >> 1).astype(np.uint32)
    moved = np.empty((_STEP + 1, 4, 256), np.uint32)
    moved[0] = np.arange(256, dtype=np.uint32)[None] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(_STEP):
        moved[n + 1] = one[moved[n] & 255] ^ (moved[n] >> 8)
    return one, moved.reshape(-1)


_ONE, _MOVED = _tables()
_BLANK = zlib.crc32(b" ")


def moved(crcs: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """CRCs as they count in front of `steps` further bytes."""
    far = np.flatnonzero(steps > _STEP)
    if len(far):
        crcs, steps = crcs.copy(), steps.copy()
        while len(far):
            crcs[far] = moved(crcs[far], np.full(len(far), _STEP))
            steps[far] -= _STEP
            far = far[steps[far] > _STEP]
    at = steps * 1024
    out = _MOVED[at + (crcs & 255)]
    for k in (1, 2, 3):
        out ^= _MOVED[at + 256 * k + ((crcs >> (8 * k)) & 255)]
    return out


def word_crcs(words: Words, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths of all words; at `of`, the CRCs of the words and of a blank and the word."""
    lengths = words.ends - words.starts
    crcs = np.zeros(len(lengths), np.uint32)
    spaced = np.zeros(len(lengths), np.uint32)
    short = of[lengths[of] <= _STEP]
    order = short[np.argsort(-lengths[short], kind="stable")]
    sizes, starts = lengths[order], words.starts[order]
    state = np.full(len(order), 0xFFFFFFFF, np.uint32)
    upto = np.searchsorted(-sizes, -np.arange(1, (sizes[0] if len(sizes) else 0) + 1), "right")
    for j, n in enumerate(upto):
        state[:n] = _ONE[(state[:n] ^ words.data[starts[:n] + j]) & 255] ^ (state[:n] >> 8)
    crcs[order] = ~state
    for i in of[lengths[of] > _STEP]:
        crcs[i] = zlib.crc32(words.word(i))
    spaced[of] = moved(np.full(len(of), _BLANK, np.uint32), lengths[of]) ^ crcs[of]
    return lengths, crcs, spaced


def inner_buckets(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all runs inside each text, text by text, and their number per text."""
    n = len(words.starts)
    lengths, crcs, spaced = word_crcs(words, np.arange(n))
    rows = np.repeat(np.arange(len(words.counts)), words.counts)
    found = np.zeros((n, 3), np.uint32)
    valid = np.zeros((n, 3), bool)
    found[:, 0], valid[:, 0] = crcs, True
    for size in (2, 3):
        last = np.arange(size - 1, n)
        found[: len(last), size - 1] = moved(found[: len(last), size - 2], lengths[last] + 1) ^ spaced[last]
        valid[: len(last), size - 1] = rows[: len(last)] == rows[last]
    counts = sum(np.maximum(words.counts - k, 0) for k in range(3))
    return (found[valid] % BUCKETS).astype(np.uint16), counts


def crossing_buckets(words: Words, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the runs of each text that touch more than one line (`lines`: per word)."""
    n = len(words.starts)
    rows = np.repeat(np.arange(len(words.counts)), words.counts)

    def starts(size: int) -> np.ndarray:
        a, b = slice(0, max(n - size + 1, 0)), slice(size - 1, n)
        return np.flatnonzero((rows[a] == rows[b]) & (lines[a] != lines[b]))

    two, three = starts(2), starts(3)
    used = np.unique(np.concatenate([two, two + 1, three, three + 1, three + 2]))
    lengths, crcs, spaced = word_crcs(words, used)

    def follow(crc: np.ndarray, at: np.ndarray) -> np.ndarray:
        return moved(crc, lengths[at] + 1) ^ spaced[at]

    pairs = follow(crcs[two], two + 1)
    triples = follow(follow(crcs[three], three + 1), three + 2)
    at = np.concatenate([two, three])
    order = np.argsort(at, kind="stable")
    found = np.concatenate([pairs, triples])[order] % BUCKETS
    return found.astype(np.uint16), np.bincount(rows[at], minlength=len(words.counts))


# ---- packed buckets -----------------------------------------------------------------------


def packed(buckets: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A binary value per row: its buckets as 16-bit numbers."""
    offsets = np.concatenate([[0], np.cumsum(counts) * 2]).astype(np.int32)
    data = pa.py_buffer(np.ascontiguousarray(buckets, "<u2").tobytes())
    return pa.BinaryArray.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets), data])


def unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = text_bytes(column.cast(pa.large_binary()).view(pa.large_string()))
    return data.view("<u2"), offsets // 2


def histogram(rows: DataFrame) -> np.ndarray:
    """Counts per bucket over (n, buckets): n times each bucket; the last cell adds up n."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(BUCKETS + 1, np.int64)
        for batch in batches:
            values, offsets = unpacked(batch.column("buckets"))
            times = batch.column("n").to_numpy()
            weights = np.repeat(times, np.diff(offsets))
            held[:BUCKETS] += np.bincount(values, weights, minlength=BUCKETS).astype(np.int64)
            held[BUCKETS] += times.sum()
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(held[at])], names=["bucket", "n"])

    counted = rows.select("n", "buckets").mapInArrow(count, "bucket int, n bigint")
    # BUCKETS + 1 rows at most.
    found = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BUCKETS + 1, np.int64)
    out[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return out


def weighed(rows: DataFrame, gains: np.ndarray, keep: list[str]) -> DataFrame:
    """The kept columns and `weight`, the sum of the gains of `buckets`."""
    names = [*keep, "weight"]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, offsets = unpacked(batch.column("buckets"))
            sums = np.concatenate([[0], np.cumsum(gains[values])])
            made = pa.array(sums[offsets[1:]] - sums[offsets[:-1]], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), made], names=names)

    kinds = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keep)
    return rows.select(*keep, "buckets").mapInArrow(weigh, f"{kinds}, weight bigint")


# ---- lines and documents ------------------------------------------------------------------


def line_key(line: bytes) -> bytes:
    return blake2b(line, digest_size=16).digest()


def distinct_lines(docs: DataFrame, text: str) -> DataFrame:
    """(key, n, buckets): every distinct line with words, its occurrences and its features."""
    lines = docs.select(F.explode(F.split(docs[text].cast("string"), "\n", -1)).alias("line"))
    counted = lines.groupBy("line").agg(F.count("*").alias("n"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, lambda b: b.column("line")):
            texts = batch.column("line")
            buckets, counts = inner_buckets(Words(texts, LETTER_WORDS, lower=True))
            data, offsets = text_bytes(texts)
            raw = data.tobytes()
            keys = [line_key(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
            made = pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), batch.column("n"), packed(buckets, counts)],
                names=["key", "n", "buckets"],
            )
            yield made.filter(pa.array(counts > 0))

    return counted.mapInArrow(hashed, "key binary, n bigint, buckets binary")


def by_document(docs: DataFrame, text: str, keep: list[str] | None) -> DataFrame:
    """`row`, n_words, n_features, `lines` (keys of lines with words), `buckets` across lines."""

    def work(texts: pa.Array) -> list:
        words = Words(texts, LETTER_WORDS, lower=True)
        data, offsets = text_bytes(texts)
        ends = np.flatnonzero(data == 10)
        lines = np.searchsorted(ends, words.starts)
        buckets, crossing = crossing_buckets(words, lines)
        rows = np.repeat(np.arange(len(texts)), words.counts)
        # The first word of every line with words; a text's start and end bound lines too.
        first = np.ones(len(lines), bool)
        first[1:] = (lines[1:] != lines[:-1]) | (rows[1:] != rows[:-1])
        line, row = lines[first], rows[first]
        edges = np.concatenate([[-1], ends, [len(data)]])
        begin = np.maximum(edges[line] + 1, offsets[row])
        end = np.minimum(edges[line + 1], offsets[row + 1])
        raw = data.tobytes()
        keys = pa.array([line_key(raw[a:b]) for a, b in zip(begin, end)], pa.binary())
        upto = np.searchsorted(row, np.arange(len(texts) + 1)).astype(np.int32)
        features = sum(np.maximum(words.counts - k, 0) for k in range(3))
        return [
            pa.array(words.counts, pa.int64()),
            pa.array(features, pa.int64()),
            pa.ListArray.from_arrays(pa.array(upto), keys),
            packed(buckets, crossing),
        ]

    fields = [("n_words", "bigint"), ("n_features", "bigint"), ("lines", "array<binary>"), ("buckets", "binary")]
    return annotate(docs, text, fields, work, keep)


def target_counts(target: DataFrame, text: str) -> np.ndarray:
    """Bucket counts of whole texts."""
    bounded_batches(target.sparkSession)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, lambda b: b.column(0)):
            buckets, counts = inner_buckets(Words(batch.column(0), LETTER_WORDS, lower=True))
            ones = pa.array(np.ones(len(counts), np.int64))
            yield pa.RecordBatch.from_arrays([ones, packed(buckets, counts)], names=["n", "buckets"])

    texts = target.select(target[text].cast("string").alias("text"))
    return histogram(texts.mapInArrow(hashed, "n bigint, buckets binary"))[:BUCKETS]


def gains_of(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket: how much more often the target has it, in thousandths of a natural logarithm."""
    of_corpus, of_target = float(corpus.sum() + BUCKETS), float(target.sum() + BUCKETS)
    ratios = (target + 1.0) * of_corpus / ((corpus + 1.0) * of_target)
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def importance(
    docs: DataFrame,
    target: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    keep: list[str] | None = None,
    seed: int = SEED,
) -> DataFrame:
    """Every document as `row`, with n_words, n_features, weight, score and a unique `at`.

    `keep` names the columns inside `row`; the id is needed there.
    """
    keep = list(docs.columns if keep is None else keep)
    bounded_batches(docs.sparkSession)
    lines = written(distinct_lines(docs, text), "lines")
    numbered = by_document(docs, text, keep).withColumn("at", F.monotonically_increasing_id())
    documents = written(numbered, "documents")
    inside = histogram(lines)
    across = histogram(documents.select(F.lit(1).cast("bigint").alias("n"), "buckets"))
    gains = gains_of((inside + across)[:BUCKETS], target_counts(target, target_text))
    places = documents.select("at", F.explode("lines").alias("key"))
    of_lines = written(weighed(lines, gains, ["key", "n"]), "weights")
    found = hot_join(places, of_lines, "key", "n", int(inside[BUCKETS]))
    parts = found.select("at", "weight").union(weighed(documents, gains, ["at"]))
    weights = parts.groupBy("at").agg(F.sum("weight").alias("weight"))
    text_id = F.coalesce(F.col("row").getField(id_column).cast("string"), F.lit(""))
    noise = F.sha2(F.concat(F.lit(f"{seed}:"), text_id).cast("binary"), 256).substr(1, 8)
    share = (F.conv(noise, 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return documents.drop("lines", "buckets").join(weights, "at").select(
        "row", "at", "n_words", "n_features", "weight",
        (F.col("weight") + F.floor(-1000 * F.log(-F.log(share)))).cast("bigint").alias("score"),
    )


def resample(scored: DataFrame, id_column: str = "doc_id", percent: int = PERCENT) -> DataFrame:
    """The rows of `importance` with `rank`: 1, 2, ... for those drawn, null for all others.

    Drawn are the highest scores, `percent` of the documents with `LEAST_WORDS` words, rounded
    down; ties go to the smaller id, nulls last.
    """
    able = F.col("n_words") >= LEAST_WORDS
    marked = written(scored, "scored").withColumns({"able": able, "id": F.col("row").getField(id_column)})
    draws = marked.where("able").count() * percent // 100
    order = [F.desc("able"), F.desc("score"), F.asc_nulls_last("id"), F.asc("weight"), F.asc("at")]
    out = ranked(marked, *order)
    rank = F.when(F.col("rank") < draws, F.col("rank") + 1)
    return out.withColumn("rank", rank.cast("bigint")).drop("able", "id", "at")
