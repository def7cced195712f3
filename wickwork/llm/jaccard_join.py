"""Documents whose sets of word shingles overlap: a distributed T-occurrence search.

Two sets link if 100 * |A & B| >= 75 * |A | B|; a document of n shingles then shares
T = ceil(0.75 n) of them at least. Equal sets are one entry from the start.

First, sets without a partner drop out. If A and B link, the first n - T + c shingles of
each, by hash, hold min(c_A, c_B) common ones at least (c is one in `OCCURRENCES`). Only
those are gathered per shingle; a set that shares too few of its own goes. For the rest all
shingles are gathered, and a set of which no T occur elsewhere goes.

Then DivideSkip (Li, Lu and Lu 2008): of the s lists that a set shares, it puts the T - 1
longest aside; a partner must meet it in one of the s - T + 1 short ones. Only the classes of
linked documents are asked for, so sets already in one class are not compared again: each
set is first compared with the most central set of its short lists, where groups of near
copies collapse. Sets that lists of several classes still connect are searched in cells of
bounded size: a query merges its short lists into candidates, which probe the long lists by
binary search until they reach T or not. A list that more than `LIST_ROWS` sets share is
dealt over several tasks when it is gathered.

Nothing is capped or sampled. Sets and shingles are known by 64-bit hashes.

Defined results: null, empty and blank texts have the empty set, which links with nothing;
a text of fewer than five words is one shingle; repeated rows and equal texts link; a null id
never is the smallest of its class, unless it has no other; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small
from .common import components, hot_join, of_keys, stored, within, written
from .words import BLANK_WORDS, Words, gram_starts, mix, range_hashes, slices

SIZE = 5
PERCENT = 75
OCCURRENCES = 10  # one in so many shingles must be common in the postings
LIST_ROWS = 50_000
FREQUENT = 256  # shingles per task that are looked at as frequent
BLOCK = 1 << 19  # shingles of a block of sets in the search
FLUSH = 1 << 18  # postings that a task holds before it packs them


class Sets:
    """The sets of some texts: sorted distinct shingles, sizes and 64-bit keys."""

    def __init__(self, texts: pa.Array, size: int = SIZE):
        words = Words(texts, BLANK_WORDS, lower=True)
        hashes = words.hashes()
        starts, runs = gram_starts(words, size)
        rows = np.repeat(np.arange(len(runs)), runs)
        short = np.flatnonzero((words.counts > 0) & (words.counts < size))
        whole = range_hashes(hashes, words.first[short], words.first[short + 1])
        values = np.concatenate([range_hashes(hashes, starts, starts + size), whole])
        rows = np.concatenate([rows, short])
        order = np.lexsort((values, rows))
        values, rows = values[order], rows[order]
        fresh = np.ones(len(values), bool)
        fresh[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
        self.values, self.rows = values[fresh], rows[fresh]
        self.sizes = np.bincount(self.rows, minlength=len(texts)).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.sizes)])
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(self.values), dtype=np.uint64)])
        self.keys = mix(total[self.first[1:]] - total[self.first[:-1]] + self.sizes.astype(np.uint64))


def required(n):
    """Common shingles that a partner of a set of n must have."""
    return -(-PERCENT * n // 100)


def occurrences(n):
    return np.maximum(1, n // OCCURRENCES)


def base_table(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """(kind, doc, text_key, key, n): a row per document, and rows of frequent shingles per task."""
    plain = docs.select(
        docs[doc].cast("bigint").alias("doc"),
        F.xxhash64(docs[text].cast("string")).alias("text_key"),
        docs[text].cast("string").alias("text"),
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, values, counts = np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64)
        kept: list[np.ndarray] = []
        names = ["kind", "doc", "text_key", "key", "n"]
        for batch in slices(batches, lambda b: b.column("text")):
            sets = Sets(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.zeros(batch.num_rows, np.int8)),
                    batch.column("doc"),
                    batch.column("text_key"),
                    pa.array(sets.keys.view(np.int64)),
                    pa.array(sets.sizes),
                ],
                names=names,
            )
            fresh = np.unique(sets.keys, return_index=True)[1]
            fresh = fresh[~np.isin(sets.keys[fresh], seen)]
            seen = np.concatenate([seen, sets.keys[fresh]])
            mine = np.zeros(batch.num_rows, bool)
            mine[fresh] = True
            kept.append(sets.values[mine[sets.rows]])
            if sum(map(len, kept)) > FLUSH:
                values, counts = tallied(values, counts, kept)
                kept = []
        values, counts = tallied(values, counts, kept)
        top = np.argsort(-counts, kind="stable")[:FREQUENT]
        top = top[counts[top] > 16]
        none = pa.nulls(len(top), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.ones(len(top), np.int8)),
                none,
                none,
                pa.array(values[top].view(np.int64)),
                pa.array(counts[top]),
            ],
            names=names,
        )

    schema = "kind tinyint, doc bigint, text_key bigint, key bigint, n bigint"
    return written(plain.mapInArrow(work, schema), "sets")


def tallied(values: np.ndarray, counts: np.ndarray, more: list) -> tuple[np.ndarray, np.ndarray]:
    """Counts with more values added; single ones are forgotten, so the counts are low estimates."""
    found, n = np.unique(np.concatenate([values[:0], *more]), return_counts=True)
    values, of = np.unique(np.concatenate([values, found]), return_inverse=True)
    counts = np.bincount(of, weights=np.concatenate([counts, n]), minlength=len(values)).astype(np.int64)
    often = counts > 1
    return values[often], counts[often]


def frequent_shingles(base: DataFrame, list_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingles that come last in the order, their known counts, and over how many tasks to deal them.

    At most the 65,536 most frequent ones; which they are changes the work, not the result.
    """
    rows = (
        base.where("kind = 1")
        .groupBy("key")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "key")
        .limit(1 << 16)
        .toArrow()
    )
    keys = rows.column("key").to_numpy().view(np.uint64)
    counts = rows.column("n").to_numpy()
    at = np.argsort(keys)
    return keys[at], counts[at], -(-counts[at] // list_rows)


def pack(found: list[tuple], frequent, buckets: int) -> pa.RecordBatch:
    """Postings (keys, sizes, shingles) as one row per bucket of shingles, 12 bytes a posting."""
    keys, sizes, values = (np.concatenate(x) for x in zip(*found))
    known, _, deal = frequent
    salt = np.zeros(len(values), np.uint64)
    if len(known):
        at = within(known, values)
        dealt = at >= 0
        salt[dealt] = keys[dealt] % deal[at[dealt]].astype(np.uint64)
    bucket = (mix(values + np.uint64(7919) * salt) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((keys, bucket))
    keys, sizes, values, bucket = keys[order], sizes[order], values[order], bucket[order]
    edges = np.searchsorted(bucket, np.arange(buckets + 1))
    blobs: list[list] = [[], [], [], []]
    for b in np.flatnonzero(np.diff(edges)):
        mine = slice(edges[b], edges[b + 1])
        owners, first = np.unique(keys[mine], return_index=True)
        number = np.diff(np.append(first, edges[b + 1] - edges[b]))
        blobs[0].append(b)
        blobs[1].append(owners.tobytes())
        blobs[2].append(np.stack([sizes[mine][first], number]).astype(np.int32).tobytes())
        blobs[3].append(values[mine].tobytes())
    return pa.RecordBatch.from_arrays(
        [pa.array(blobs[0], pa.int32()), *[pa.array(x, pa.binary()) for x in blobs[1:]]],
        names=["bucket", "owners", "numbers", "shingles"],
    )


PACKED = "bucket int, owners binary, numbers binary, shingles binary"


def prefixes(docs: DataFrame, text: str, frequent, buckets: int) -> DataFrame:
    """Packed postings of the prefix of every distinct set."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held, seen = [], 0, np.empty(0, np.uint64)
        for batch in slices(batches, lambda b: b.column(0)):
            sets = Sets(batch.column(0))
            fresh = np.unique(sets.keys, return_index=True)[1]
            fresh = fresh[~np.isin(sets.keys[fresh], seen)]
            seen = np.concatenate([seen, sets.keys[fresh]])
            mine = np.zeros(batch.num_rows, bool)
            mine[fresh] = True
            values, rows = sets.values, sets.rows
            late = within(frequent.value[0], values) >= 0
            if late.any():
                order = np.lexsort((values, late, rows))
                values, rows = values[order], rows[order]
            rank = np.arange(len(values)) - sets.first[rows]
            prefix = sets.sizes - required(sets.sizes) + occurrences(sets.sizes)
            take = mine[rows] & (rank < prefix[rows])
            found.append((sets.keys[rows[take]], sets.sizes[rows[take]], values[take]))
            held += int(take.sum())
            if held > FLUSH:
                yield pack(found, frequent.value, buckets)
                found, held = [], 0
        if held:
            yield pack(found, frequent.value, buckets)

    return docs.select(docs[text].cast("string")).mapInArrow(emit, PACKED)


def all_shingles(whole: DataFrame, frequent, buckets: int) -> DataFrame:
    """Packed postings of all shingles of some sets; a set may come twice."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                lists = part.column("shingles")
                count = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
                keys = np.repeat(part.column("key").to_numpy().view(np.uint64), count)
                if len(keys):
                    sizes = np.repeat(part.column("n").to_numpy(), count)
                    values = lists.flatten().to_numpy().view(np.uint64)
                    yield pack([(keys, sizes, values)], frequent.value, buckets)

    return whole.select("key", "n", "shingles").mapInArrow(emit, PACKED)


def listed(packed: DataFrame, frequent, parts: int, buckets: int, counts_only: bool) -> DataFrame:
    """Postings of lists that two sets or more share, packed again by the key of the set.

    With `counts_only`, their number per set; else every posting with the length of its list.
    """

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sizes, values = [], [], []
        for batch in batches:
            for k in range(batch.num_rows):
                owners = np.frombuffer(batch.column("owners")[k].as_buffer(), np.uint64)
                n, number = np.frombuffer(batch.column("numbers")[k].as_buffer(), np.int32).reshape(2, -1)
                keys.append(np.repeat(owners, number))
                sizes.append(np.repeat(n, number))
                values.append(np.frombuffer(batch.column("shingles")[k].as_buffer(), np.uint64))
        if not keys:
            return
        keys, sizes, values = np.concatenate(keys), np.concatenate(sizes), np.concatenate(values)
        order = np.lexsort((keys, values))
        keys, sizes, values = keys[order], sizes[order], values[order]
        fresh = np.ones(len(keys), bool)
        fresh[1:] = (keys[1:] != keys[:-1]) | (values[1:] != values[:-1])
        keys, sizes, values = keys[fresh], sizes[fresh], values[fresh]
        first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
        size = np.diff(np.append(first, len(values)))
        number = size
        known, counts, deal = frequent.value
        if len(known):
            # A list dealt over several tasks is as long as counted before, in all of them.
            at = within(known, values[first])
            dealt = (at >= 0) & (deal[np.maximum(at, 0)] > 1)
            number = np.where(dealt, counts[np.maximum(at, 0)], size)
        length = np.repeat(number, size)
        keep = np.flatnonzero(length > 1)
        keys, sizes = keys[keep], sizes[keep].astype(np.int32)
        if counts_only:
            keys, at, number = np.unique(keys, return_index=True, return_counts=True)
            columns = [keys, sizes[at], number.astype(np.int32)]
        else:
            columns = [keys, sizes, length[keep].astype(np.int32), values[keep]]
        bucket = (mix(keys) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        columns = [c[order] for c in columns]
        edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
        some = np.flatnonzero(np.diff(edges))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(some.astype(np.int32)),
                *[
                    pa.array([c[edges[b] : edges[b + 1]].tobytes() for b in some], pa.binary())
                    for c in columns
                ],
            ],
            names=["bucket", "keys", "sizes", "numbers", "shingles"][: 1 + len(columns)],
        )

    kind = "bucket int, keys binary, sizes binary, numbers binary"
    kind += "" if counts_only else ", shingles binary"
    return packed.repartition(parts, "bucket").mapInArrow(gather, kind).repartition(parts, "bucket")


def unpacked(batches: Iterator[pa.RecordBatch], kinds: dict) -> list[np.ndarray] | None:
    parts: dict[str, list] = {name: [] for name in kinds}
    for batch in batches:
        for name, kind in kinds.items():
            for k in range(batch.num_rows):
                parts[name].append(np.frombuffer(batch.column(name)[k].as_buffer(), kind))
    if not parts["keys"]:
        return None
    return [np.concatenate(p) for p in parts.values()]


def enough(counts: DataFrame, least: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """Keys of the sets of n that share least(n) of their postings or more."""

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = unpacked(batches, {"keys": np.uint64, "sizes": np.int32, "numbers": np.int32})
        if found is not None:
            keys, at, of = np.unique(found[0], return_index=True, return_inverse=True)
            shared = np.bincount(of, weights=found[2], minlength=len(keys))
            kept = keys[shared >= least(found[1][at].astype(np.int64))]
            yield pa.RecordBatch.from_arrays([pa.array(kept.view(np.int64))], names=["key"])

    return stored(counts.mapInArrow(total, "key bigint"))


def short_lists(postings: DataFrame) -> DataFrame:
    """(shingle, key, weight) of the lists that a set cannot put aside.

    The weight of a set, the sum of all its lists' lengths, tells how central it is.
    """

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"keys": np.uint64, "sizes": np.int32, "numbers": np.int32, "shingles": np.uint64}
        found = unpacked(batches, kinds)
        if found is None:
            return
        order = np.lexsort((found[3], found[2], found[0]))
        keys, sizes, rows, values = (f[order] for f in found)
        fresh = np.concatenate([[True], keys[1:] != keys[:-1]])
        first = np.flatnonzero(fresh)
        shared = np.diff(np.append(first, len(keys)))
        weight = np.add.reduceat(rows.astype(np.int64), first)
        of = np.cumsum(fresh) - 1
        spare = shared[of] - required(sizes.astype(np.int64))
        take = np.flatnonzero(np.arange(len(keys)) - first[of] <= spare)
        for at in range(0, len(take), 1 << 16):
            part = take[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(values[part].view(np.int64)), pa.array(keys[part].view(np.int64)), pa.array(weight[of[part]])],
                names=["shingle", "key", "weight"],
            )

    return written(postings.mapInArrow(choose, "shingle bigint, key bigint, weight bigint"), "short")


def whole_sets(docs: DataFrame, text: str, kept: DataFrame, base: DataFrame) -> DataFrame:
    """(key, n, shingles): whole sets of the kept keys, from one text each."""
    one = stored(
        base.where("kind = 0 and n > 0")
        .join(kept, "key", "left_semi")
        .groupBy("key")
        .agg(F.min("text_key").alias("text_key"))
        .select("text_key")
    )
    plain = docs.select(
        F.xxhash64(docs[text].cast("string")).alias("text_key"), docs[text].cast("string").alias("text")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, lambda b: b.column("text")):
            sets = Sets(part.column("text"))
            lists = pa.ListArray.from_arrays(
                pa.array(sets.first.astype(np.int32)), pa.array(sets.values.view(np.int64))
            )
            columns = [pa.array(sets.keys.view(np.int64)), pa.array(sets.sizes), lists]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "n", "shingles"])

    return written(of_keys(plain, one, "text_key").mapInArrow(work, "key bigint, n bigint, shingles array<bigint>"), "whole")


def linked(pairs: DataFrame, whole: DataFrame) -> DataFrame:
    """The pairs (a, b) of keys whose sets link."""
    left = whole.select(F.col("key").alias("a"), F.col("n").alias("n_a"), F.col("shingles").alias("s_a"))
    right = whole.select(F.col("key").alias("b"), F.col("n").alias("n_b"), F.col("shingles").alias("s_b"))
    common = F.size(F.array_intersect("s_a", "s_b"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .where((F.col("n_a") * 100 >= PERCENT * F.col("n_b")) & (F.col("n_b") * 100 >= PERCENT * F.col("n_a")))
        .where(100 * common >= PERCENT * (F.col("n_a") + F.col("n_b") - common))
        .select("a", "b")
    )


def in_classes(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows with the class of their key; a key without links is its own class."""
    named = classes.select(F.col("node").alias("key"), F.col("component"))
    return rows.join(named, "key", "left").select(
        *rows.columns, F.coalesce("component", "key").alias("class")
    )


def joined_classes(classes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component) of `classes` after links (a, b) between the classes, few beside the nodes."""
    larger = components(links)
    named = larger.select(F.col("node").alias("component"), F.col("component").alias("_larger"))
    moved = classes.join(broadcast_if_small(named), "component", "left").select("node", F.coalesce("_larger", "component").alias("component"))
    return stored(moved.union(larger))


def mixed_lists(short: DataFrame, classes: DataFrame) -> DataFrame:
    """Short postings (a written table), with class, of lists that hold more than one class."""
    rows = in_classes(short, classes)
    mixed = rows.groupBy("shingle").agg(
        F.min("class").alias("low"), F.max("class").alias("high"), F.count("*").alias("times")
    )
    mixed = stored(mixed.where("low < high").select("shingle", "times"))
    return hot_join(rows, mixed, "shingle", "times", short.count()).select(*rows.columns)


def pivot_pairs(short: DataFrame) -> DataFrame:
    """For each set the pivot, a list's most central set, that it meets most often."""
    pivots = short.groupBy("shingle").agg(
        F.max_by("key", F.struct("weight", "key")).alias("pivot"), F.count("*").alias("times")
    )
    return (
        hot_join(short, stored(pivots.where("times > 1")), "shingle", "times", short.count())
        .where("key <> pivot")
        .groupBy("key", "pivot")
        .agg(F.count("*").alias("times"))
        .groupBy("key")
        .agg(F.max_by("pivot", F.struct("times", "pivot")).alias("pivot"))
        .select(F.least("key", "pivot").alias("a"), F.greatest("key", "pivot").alias("b"))
        .distinct()
    )


def cells(rows: DataFrame, whole: DataFrame, block: int) -> DataFrame:
    """(group, i, j, key, class, member, query, shingles): what must still be compared.

    Sets that lists connect form a group. Those outside its largest class are queries
    against all its members. Both are dealt into blocks of about `block` shingles, and a cell
    is one block of queries with one block of members, however large the group is.
    """
    lists = stored(rows.groupBy("shingle").agg(F.min("key").alias("first"), F.count("*").alias("times")))
    met = hot_join(rows, lists, "shingle", "times", rows.count())
    near = components(met.select(F.col("key").alias("a"), F.col("first").alias("b")))
    sets = rows.select("key", "class").distinct().join(whole.select("key", "n"), "key")
    grouped = stored(
        sets.join(near.withColumnRenamed("node", "key"), "key", "left").select(
            "key", "class", "n", F.coalesce("component", "key").alias("group")
        )
    )
    classes = grouped.groupBy("group", "class").agg(F.count("*").alias("members"))
    largest = classes.groupBy("group").agg(F.max_by("class", F.struct("members", "class")).alias("main"))
    asked = grouped.join(largest, "group").withColumn("query", F.col("class") != F.col("main"))
    blocks = asked.groupBy("group").agg(
        F.ceil(F.sum("n") / block).alias("m"), F.ceil(F.sum(F.when(F.col("query"), F.col("n"))) / block).alias("q")
    )
    placed = asked.join(blocks, "group").where("q > 0").selectExpr(
        "group", "key", "class", "query", "m", "q", "pmod(xxhash64(key), m) as j", "pmod(xxhash64(key, 1), q) as i"
    )
    as_member = "transform(sequence(0L, q - 1), x -> struct(x as i, j as j, true as member, query and x = i as query))"
    as_query = (
        "if(query, filter(transform(sequence(0L, m - 1), x -> struct(i as i, x as j, false as member, true as query)),"
        " c -> c.j <> j), array())"
    )
    dealt = placed.selectExpr("group", "key", "class", f"inline(concat({as_member}, {as_query}))")
    return dealt.join(whole.select("key", "shingles"), "key")


def search(cell: pa.Table) -> pa.Table:
    """Links between the classes of queries and of members of a cell, as a forest, by DivideSkip."""
    keys = cell.column("key").to_numpy()
    lists = cell.column("shingles").combine_chunks()
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    values = lists.flatten().to_numpy().view(np.uint64)
    ends = np.cumsum(sizes)
    classes = cell.column("class").to_numpy()
    member = cell.column("member").to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(keys)), sizes)
    inside = member[owner]
    known, of = np.unique(values[inside], return_inverse=True)
    # Inverted lists: code is list * width + set, sorted, so a probe is one binary search.
    width = len(keys)
    code = np.sort(of * width + owner[inside])
    heads = np.searchsorted(code, np.arange(len(known) + 1) * width)
    length = np.diff(heads)
    parent = {c: c for c in classes.tolist()}

    def root(c):
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    links: list[tuple[int, int]] = []
    for q in np.flatnonzero(cell.column("query").to_numpy(zero_copy_only=False)):
        need = int(required(sizes[q]))
        mine = within(known, values[ends[q] - sizes[q] : ends[q]])
        mine = mine[mine >= 0]
        if len(mine) < need:
            continue
        mine = mine[np.argsort(length[mine], kind="stable")]
        short, long = mine[: len(mine) - need + 1], mine[len(mine) - need + 1 :]
        at = np.concatenate([np.arange(heads[k], heads[k + 1]) for k in short])
        met, count = np.unique(code[at] % width, return_counts=True)
        fits = (100 * sizes[met] >= PERCENT * sizes[q]) & (100 * sizes[q] >= PERCENT * sizes[met])
        fits &= classes[met] != classes[q]
        met, count = met[fits], count[fits]
        for k in long:
            if not len(met):
                break
            count = count + (within(code, k * width + met) >= 0)
        good = 100 * count >= PERCENT * (sizes[q] + sizes[met] - count)
        for m in met[good].tolist():
            x, y = root(classes[q].item()), root(classes[m].item())
            if x != y:
                parent[max(x, y)] = min(x, y)
                links.append((x, y))
    a, b = zip(*links) if links else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def classes_of(
    docs: DataFrame,
    *,
    doc: str = "doc_id",
    text: str = "text",
    list_rows: int = LIST_ROWS,
    block: int = BLOCK,
) -> DataFrame:
    """(doc, text_key, n, group, class): each document's group, and the smallest id in it."""
    spark = docs.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    buckets = 2 * parts
    base = base_table(docs, doc, text)
    frequent = spark.sparkContext.broadcast(frequent_shingles(base, list_rows))
    # Sets that share enough of their prefix, then of all they hold.
    counts = listed(prefixes(docs, text, frequent, buckets), frequent, parts, buckets, True)
    kept = enough(counts, lambda n: occurrences(required(n)))
    whole = whole_sets(docs, text, kept, base)
    counts = listed(all_shingles(whole, frequent, buckets), frequent, parts, buckets, True)
    kept = enough(counts, required)
    whole = written(of_keys(whole, kept, "key").dropDuplicates(["key"]), "kept")
    short = short_lists(listed(all_shingles(whole, frequent, buckets), frequent, parts, buckets, False))
    classes = components(linked(pivot_pairs(short), whole))
    rest = stored(mixed_lists(short, classes))
    cell = cells(rest, whole, block).groupBy("group", "i", "j")
    classes = joined_classes(classes, cell.applyInArrow(search, "a bigint, b bigint"))
    rows = in_classes(base.where("kind = 0").select("doc", "text_key", "key", "n"), classes)
    lowest = rows.where("n > 0").groupBy("class").agg(F.min("doc").alias("least"))
    return rows.join(lowest, "class", "left").select(
        "doc",
        "text_key",
        F.col("n"),
        F.col("class").alias("group"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc")).alias("class"),
    )


def keep_one(docs: DataFrame, *, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs`, one of each group: that of the smallest id, then the smallest text hash.

    Rows that go are found by the hash of id and text; while those hashes are few enough
    they are broadcast, so the texts are not shuffled. Texts without words all stay.
    """
    found = stored(
        classes_of(docs, doc=doc, text=text)
        .where("n > 0")
        .select("group", F.xxhash64(F.col("doc"), F.col("text_key")).alias("row_key"), "doc", "text_key")
    )
    first = F.struct(F.col("doc").isNull().alias("unnamed"), "doc", "text_key", "row_key")
    best = found.groupBy("group").agg(F.min(first).alias("first"))
    rows = found.join(best, "group")
    gone = rows.where(F.col("row_key") != F.col("first.row_key")).select("row_key").distinct()
    again = (
        rows.where(F.col("row_key") == F.col("first.row_key"))
        .groupBy("row_key")
        .agg(F.count("*").alias("n"))
        .where("n > 1")
        .select("row_key")
    )
    keyed = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        F.xxhash64(docs[doc].cast("bigint"), F.xxhash64(docs[text].cast("string"))).alias("row_key"),
    )
    repeated = stored(again)
    # Rows that go, and rows that stand twice or more, of which one is added again.
    apart = stored(gone.union(repeated).distinct())
    single = of_keys(keyed, apart, "row_key", inside=False).select("row.*")
    return single.union(
        of_keys(keyed, repeated, "row_key").dropDuplicates(["row_key"]).select("row.*")
    )
