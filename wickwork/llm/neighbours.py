"""Quality by nearest-neighbour voting in a latent space.

A text becomes counts of its hashed words and runs of three characters, weighted by how few of
all documents have them, and beside these terms counts of byte kinds, of hashed runs of three
kinds, and of coarse facts about repetition and word shape. Latent semantic analysis (a truncated singular value decomposition
of the labelled sample's weighted counts) gives `DIMENSIONS` coordinates. The sample is bounded
by `SAMPLE_GOOD` and `SAMPLE_BAD`; its features stay in a written table, over which executors
add up what the decomposition needs, and only its short latent vectors are broadcast; every document is compared
with all of them by exact cosine products, block by block, and the labels of the `NEIGHBOURS`
closest vote with weights that grow with similarity.

Defined results: null, empty and blank texts are the empty vector, whose neighbours are those
of no similarity, so they get the sample's prior; repeated labels of a document count once,
good only if all say so; null labels and ids teach nothing; with no labels every score is the
prior of `PRIOR`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import annotate, stored, written
from .words import BLANK_WORDS, LETTER_WORDS, Words, gram_starts, range_hashes, slices, text_bytes

SAMPLE_GOOD = 3000
SAMPLE_BAD = 2000
#: Parts of the sample, and passes over it that find the axes.
SAMPLE_PARTS, PASSES = 4, 4
#: Texts whose features, dense rows, are in a worker at once.
SLICE_ROWS = 200
DIMENSIONS = 96
NEIGHBOURS = 25
BLOCK = 1024
SHARPNESS = 12.0
PRIOR = 0.5

# ---- features ----------------------------------------------------------------------------

#: Kinds of bytes: letters, capitals, digits, blanks, line ends, each common sign, others.
_SIGNS = ".,;:!?#$%&*|<>@=+-_\"'()/"
KINDS = 6 + len(_SIGNS)
_KIND = np.full(256, 5, np.int64)
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[[32, 9, 11, 12, 13]], _KIND[10] = 0, 1, 2, 3, 4
for _i, _c in enumerate(_SIGNS):
    _KIND[ord(_c)] = 6 + _i
_KIND[0x80:] = 0
_CONTINUES = (np.arange(256) >= 0x80) & (np.arange(256) < 0xC0)
GRAMS = 2048
_FACTOR = np.uint64(0x9E3779B97F4A7C15)

#: Facts, each as one of `STEPS` levels.
FACTS, STEPS = 7, 12
#: Hashed terms: words, and runs of `RUN` characters.
WORD_BITS, RUN_BITS, RUN = 12, 11, 3
TERMS = (1 << WORD_BITS) + (1 << RUN_BITS)
FEATURES = KINDS + GRAMS + FACTS * STEPS + TERMS
WEIGHTS = (1.0, 1.0, 1.2, 1.2, 0.8)


def per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of values over the ranges between offsets."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[offsets[1:]] - total[offsets[:-1]]


def facts(texts: pa.Array, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Shares between 0 and 1 that describe repetition and the shape of words."""
    words = Words(texts, BLANK_WORDS, lower=True)
    hashes = words.hashes()
    rows = np.repeat(np.arange(len(texts)), words.counts)
    n = np.maximum(words.counts, 1)

    def repeats(keys: np.ndarray, of: np.ndarray, count: np.ndarray) -> np.ndarray:
        order = np.lexsort((keys, of))
        k, r = keys[order], of[order]
        again = np.zeros(len(k), bool)
        again[1:] = (k[1:] == k[:-1]) & (r[1:] == r[:-1])
        return np.bincount(r, weights=again, minlength=len(texts)) / np.maximum(count, 1)

    adjacent = np.zeros(len(hashes), bool)
    adjacent[1:] = (hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])
    starts, runs = gram_starts(words, 5)
    grams = range_hashes(hashes, starts, starts + 5)
    last = data[words.ends - 1] if len(words.ends) else np.empty(0, np.uint8)
    signs = (_KIND[last] >= 6) & (_KIND[last] != 6) & (_KIND[last] != 7)
    single = (words.ends - words.starts == 1) & signs
    upper = (data >= 65) & (data <= 90)
    lengths = np.maximum(np.diff(offsets), 1)
    word_bytes = np.bincount(rows, weights=words.ends - words.starts, minlength=len(texts)) / n
    return np.column_stack([
        np.bincount(rows, weights=adjacent, minlength=len(texts)) / n,
        repeats(grams, np.repeat(np.arange(len(texts)), runs), runs),
        np.bincount(rows, weights=signs, minlength=len(texts)) / n,
        np.bincount(rows, weights=single, minlength=len(texts)) / n,
        per_text(upper, offsets) / lengths,
        np.minimum(word_bytes / 24, 1),
        repeats(hashes, rows, words.counts),
    ])


def terms(texts: pa.Array) -> np.ndarray:
    """Counts of hashed lower-case words and of runs of characters, a row per text."""
    count = len(texts)
    words = Words(texts, LETTER_WORDS, lower=True)
    rows = np.repeat(np.arange(count), words.counts)
    cells = [rows * TERMS + (words.hashes() >> np.uint64(64 - WORD_BITS)).astype(np.int64)]
    starts = ~_CONTINUES[words.data]
    at = np.append(np.flatnonzero(starts), len(words.data))
    if len(at) > RUN:
        _, offsets = text_bytes(texts)
        of = np.repeat(np.arange(count), per_text(starts, offsets))
        runs = range_hashes(words.data.astype(np.uint64) + np.uint64(1), at[:-RUN], at[RUN:])
        cell = (1 << WORD_BITS) + (runs >> np.uint64(64 - RUN_BITS)).astype(np.int64)
        same = of[: len(cell)] == of[RUN - 1 :]
        cells.append((of[: len(cell)] * TERMS + cell)[same])
    return np.bincount(np.concatenate(cells), minlength=count * TERMS).reshape(count, TERMS)


def rarity(docs: DataFrame, text: str) -> np.ndarray:
    """Inverse document frequency of each term, counted over all documents."""

    def count(batches):
        held, rows = np.zeros(TERMS, np.int64), 0
        for batch in slices(batches, lambda b: b.column(0), rows=SLICE_ROWS):
            held += np.count_nonzero(terms(batch.column(0)), axis=0)
            rows += batch.num_rows
        cells = np.arange(-1, TERMS, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(np.append(rows, held))], names=["cell", "n"])

    parts = docs.select(docs[text].cast("string")).mapInArrow(count, "cell int, n bigint")
    found = parts.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    held = np.zeros(TERMS + 1)
    held[found.column("cell").to_numpy() + 1] = found.column("n").to_numpy()
    return np.log((held[0] + 1) / (held[1:] + 1)) + 0.1


def features(texts: pa.Array, rare: np.ndarray) -> np.ndarray:
    """A row of weighted features per text; each of the five parts has length one."""
    data, offsets = text_bytes(texts)
    count = len(texts)
    starts = ~_CONTINUES[data]
    kinds, chars = _KIND[data[starts]], np.concatenate([[0], np.cumsum(starts)])[offsets]
    rows = np.repeat(np.arange(count), np.diff(chars))
    first = np.bincount(rows * KINDS + kinds, minlength=count * KINDS).reshape(count, KINDS)
    grams = np.zeros((count, GRAMS))
    if len(kinds) > 2:
        code = (kinds[:-2] * KINDS + kinds[1:-1]) * KINDS + kinds[2:]
        cell = ((code.astype(np.uint64) * _FACTOR) >> np.uint64(64 - 11)).astype(np.int64)
        same = rows[2:] == rows[:-2]
        grams = np.bincount((rows[2:] * GRAMS + cell)[same], minlength=count * GRAMS).reshape(count, GRAMS)
    shares = facts(texts, data, offsets)
    # Square roots give small shares more levels.
    level = np.minimum((np.sqrt(shares) * STEPS).astype(np.int64), STEPS - 1)
    bins = np.zeros((count, FACTS * STEPS))
    bins[np.arange(count)[:, None], np.arange(FACTS) * STEPS + level] = 1.0
    bins[chars[1:] == chars[:-1]] = 0.0
    parts = []
    weighted = np.sqrt(terms(texts)) * rare
    split = np.split(weighted, [1 << WORD_BITS], axis=1)
    for rooted, weight in zip((*map(np.sqrt, (first, grams, bins)), *split), WEIGHTS):
        norm = np.maximum(np.linalg.norm(rooted, axis=1, keepdims=True), 1e-9)
        parts.append(weight * rooted / norm)
    return np.hstack(parts).astype(np.float32)


def passed(vectors: DataFrame, basis: np.ndarray) -> np.ndarray:
    """M'M times `basis` for the matrix M of all rows: each part adds up its own rows' share."""
    shared = vectors.sparkSession.sparkContext.broadcast(basis)

    def add(batches):
        total = np.zeros(shared.value.shape)
        for batch in batches:
            rows = matrix_of(batch.column("vector"))
            total += rows.T @ (rows @ shared.value)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sum"])

    # SAMPLE_PARTS rows of the size of the basis.
    found = vectors.select("vector").mapInArrow(add, "sum binary").toArrow().column("sum")
    out = np.zeros(basis.shape)
    for part in found:
        out += np.frombuffer(part.as_buffer(), float).reshape(basis.shape)
    shared.destroy()
    return out


def latent(vectors: DataFrame, dimensions: int, seed: int = 7) -> np.ndarray:
    """Right singular vectors of the largest singular values, by a randomised range finder.

    The rows stay where they are; a pass over them brings sums of the size of the basis here.
    """
    basis = np.random.default_rng(seed).standard_normal((FEATURES, dimensions + 16))
    for _ in range(PASSES - 1):
        basis = np.linalg.qr(passed(vectors, basis))[0]
    values, turned = np.linalg.eigh(basis.T @ passed(vectors, basis))
    best = np.argsort(-values)[:dimensions]
    # A small sample has fewer directions.
    best = best[values[best] > 1e-9 * values.max()]
    return (basis @ turned[:, best]).astype(np.float32)


def matrix_of(column: pa.Array) -> np.ndarray:
    return np.array([np.frombuffer(v, np.float16) for v in column.to_pylist()], np.float32).reshape(-1, FEATURES)


def placed(matrix: np.ndarray, axes: np.ndarray) -> np.ndarray:
    point = matrix @ axes
    return point / np.maximum(np.linalg.norm(point, axis=1, keepdims=True), 1e-9)


def vote(points: np.ndarray, known: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Similarity-weighted share of label 1 among the nearest labelled points."""
    take = min(NEIGHBOURS, len(known))
    best = np.full((len(points), 0), 0.0, np.float32)
    of = np.full((len(points), 0), 0, np.int64)
    for at in range(0, len(known), BLOCK):
        near = points @ known[at : at + BLOCK].T
        best = np.hstack([best, near])
        of = np.hstack([of, np.broadcast_to(np.arange(at, at + near.shape[1]), near.shape)])
        if best.shape[1] > take:
            top = np.argpartition(-best, take - 1, axis=1)[:, :take]
            best, of = np.take_along_axis(best, top, 1), np.take_along_axis(of, top, 1)
    weight = np.maximum(best.astype(np.float64), 0) ** SHARPNESS
    total = weight.sum(axis=1)
    share = (weight * labels[of]).sum(axis=1) / np.maximum(total, 1e-12)
    # Far from all labels, the vote leans to the prior.
    trust = total / (total + 0.5)
    return trust * share + (1 - trust) * PRIOR


def sample(docs: DataFrame, teach: DataFrame, doc: str, text: str, rare) -> DataFrame:
    """(label, vector) of a bounded number of documents per label, the same on every run.

    Written in SAMPLE_PARTS parts; its bound is that of the labelled rows.
    """
    chosen = [
        teach.where(F.col("label") == value).orderBy(F.xxhash64(F.lit("quality"), "doc")).limit(most)
        for value, most in ((1, SAMPLE_GOOD), (0, SAMPLE_BAD))
    ]
    # SAMPLE_GOOD + SAMPLE_BAD rows at most.
    ids = F.broadcast(chosen[0].unionByName(chosen[1]))
    rows = docs.select(docs[doc].alias("doc"), docs[text].cast("string").alias("text")).join(ids, "doc")

    def features_of(batches):
        for batch in slices(batches, lambda b: b.column("text"), rows=SLICE_ROWS):
            made = features(batch.column("text"), rare.value).astype(np.float16)
            vectors = pa.array([r.tobytes() for r in made], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("label"), vectors], names=["label", "vector"])

    made = rows.select("label", "text").mapInArrow(features_of, "label int, vector binary")
    return written(made.repartition(SAMPLE_PARTS), "sample").coalesce(SAMPLE_PARTS)


def points_of(vectors: DataFrame, axes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sample in the latent space, and its labels: a bounded number of short rows."""

    def place(batches):
        for batch in batches:
            found = placed(matrix_of(batch.column("vector")), axes)
            made = pa.array([r.tobytes() for r in found], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("label"), made], names=["label", "point"])

    found = vectors.mapInArrow(place, "label int, point binary").toArrow()
    points = [np.frombuffer(v, np.float32) for v in found.column("point").to_pylist()]
    return np.array(points, np.float32).reshape(-1, axes.shape[1]), found.column("label").to_numpy().astype(float)


def score(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    keep: list[str] | None = None,
) -> DataFrame:
    """(row, score): labels are those to learn from; score is the share of votes for 1."""
    teach = stored(
        labels.select(labels[doc].alias("doc"), labels[label].cast("int").alias("label"))
        .where("doc is not null and label is not null")
        .groupBy("doc")
        .agg(F.min("label").alias("label"))
    )
    context = docs.sparkSession.sparkContext
    rare = context.broadcast(rarity(docs, text))
    vectors = sample(docs, teach, doc, text, rare)
    if vectors.take(1):
        axes = latent(vectors, DIMENSIONS)
        known, votes = points_of(vectors, axes)
    else:
        axes, known, votes = np.zeros((FEATURES, 1), np.float32), np.zeros((1, 1), np.float32), np.zeros(1)
    model = context.broadcast((axes, known, votes))

    def work(texts: pa.Array) -> list:
        axes, known, votes = model.value
        return [vote(placed(features(texts, rare.value), axes), known, votes)]

    return annotate(docs, text, [("score", "double")], work, keep, rows=SLICE_ROWS)
