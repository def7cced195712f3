"""Removing repeated spans by compacting a de Bruijn graph of word k-mers.

The graph is sparse: its nodes are the k-mers that are smallest, by hash, in some window of
`SPAN - NODE + 1` k-mers, so every run of `SPAN` words holds a node that the run alone decides.
An edge is the longer k-mer from one node of a text to the next; a text's start and end are
edges too. Nodes seen in one document only drop out: no window over them is shared. A node
whose occurrences all have the same edges does not branch, and a chain of such nodes is one
path: it occurs as a whole in the same documents. One aggregation by node finds the branches,
a join brings them back to the occurrences, and neighbours in a text compact to path
occurrences with their coordinates.

A window inside a path is repeated in exactly the documents of its nodes, which settles the
inside of long repeats without looking at their windows. Around branches, where documents
part, windows are verified one by one: their hashes are aggregated to the smallest document
and joined back. So the work follows the borders of repeats, not their length.

A document of a group of copies meets partial sums of its nodes, never a list of the others.
Windows, nodes and edges are compared by 64-bit hashes of their whole word sequence.

Defined results: null, empty and blank texts have no words; texts under `SPAN` words stay
whole; a repeat within one document only stays, and so do repeats among rows that share an
id; a document with a null id is neither cut nor a source; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import field, hot_join, of_keys, sliding, stored, written
from .words import BLANK_WORDS, Words, mix, range_hashes, slices

SPAN = 50
NODE = 16
PLACE_BITS = 31  # for the position of a node in its text

_START, _END = np.uint64(0x5354415254), np.uint64(0x454E44)


def gap_bits(width: int) -> int:
    """Bits of a gap between nodes, which is at most the number of k-mers in a span."""
    bits = width.bit_length()
    if width < 1 or 4 * bits + PLACE_BITS > 63:
        raise ValueError("a span must hold 1 to 255 nodes; choose a node nearer to the span")
    return bits


class Nodes:
    """Nodes of some texts, with the hash of their edges and the distance to their neighbours."""

    def __init__(self, words: Words, span: int, node: int):
        hashes = words.hashes()
        width = span - node + 1
        rows = np.flatnonzero(words.counts >= span)
        self.rows, self.at = np.empty(0, np.int64), np.empty(0, np.int64)
        self.hashes, self.contexts = np.empty(0, np.uint64), np.empty(0, np.uint64)
        self.before = self.after = self.far = self.near = self.at
        if not len(rows):
            return
        first = np.arange(len(hashes) - node + 1)
        grams = range_hashes(hashes, first, first + node)
        of = np.repeat(np.arange(len(words.counts)), words.counts)
        # Windows that lie in one text; the smallest k-mer of each, ties included, is a node.
        whole = of[: len(grams) - width + 1] == of[span - 1 :][: len(grams) - width + 1]
        smallest = np.zeros(len(grams) + width - 1, np.uint64)
        lowest = sliding(grams, width, np.minimum)
        smallest[width - 1 : width - 1 + len(lowest)][whole] = lowest[whole]
        at = np.flatnonzero(sliding(smallest, width, np.maximum) == grams)
        rows = of[at]
        begin, end = words.first[rows], words.first[rows + 1]
        same_before = np.zeros(len(at), bool)
        same_before[1:] = rows[1:] == rows[:-1]
        same_after = np.zeros(len(at), bool)
        same_after[:-1] = same_before[1:]
        previous = np.where(same_before, np.roll(at, 1), begin - 1)
        following = np.where(same_after, np.roll(at, -1), end - node + 1)
        into = range_hashes(hashes, np.maximum(previous, begin), at + node)
        out = range_hashes(hashes, at, np.where(same_after, following + node, end))
        into = np.where(same_before, into, mix(into ^ _START))
        out = np.where(same_after, out, mix(out ^ _END))
        self.rows, self.at = rows, at - begin
        self.hashes = grams[at]
        self.contexts = mix(into + mix(out))
        self.before, self.after = at - previous, following - at
        # Windows whose smallest k-mer this is: first to last, as distances in front of it.
        self.far, self.near = np.zeros(len(at), np.int64), np.full(len(at), width, np.int64)
        for back in range(width):
            own = smallest[np.maximum(at - back, 0) + width - 1] == self.hashes
            own &= at - back >= 0
            self.far[own] = back
            self.near = np.where(own, np.minimum(self.near, back), self.near)


def node_table(docs: DataFrame, text: str, doc: str, span: int, node: int) -> DataFrame:
    """(doc, row_key, place, node, edges) of every node occurrence; place packs position and gaps."""
    bits = gap_bits(span - node + 1)
    plain = docs.select(
        docs[doc].cast("bigint").alias("doc"),
        F.xxhash64(docs[doc], docs[text]).alias("row_key"),
        docs[text].cast("string").alias("text"),
    ).where("doc is not null")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, lambda b: b.column("text")):
            nodes = Nodes(Words(batch.column("text"), BLANK_WORDS, lower=False), span, node)
            rows = pa.array(nodes.rows)
            place = nodes.at
            for gap in (nodes.before, nodes.after, nodes.far, nodes.near):
                place = (place << bits) | gap
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc").take(rows),
                    batch.column("row_key").take(rows),
                    pa.array(place),
                    pa.array(nodes.hashes.view(np.int64)),
                    pa.array(nodes.contexts.view(np.int64)),
                ],
                names=["doc", "row_key", "place", "node", "edges"],
            )

    return plain.mapInArrow(work, "doc bigint, row_key bigint, place bigint, node bigint, edges bigint")


def shared_nodes(occurrences: DataFrame) -> DataFrame:
    """Occurrences of nodes that two documents or more hold, with what is known of the node."""
    nodes = written(
        occurrences.groupBy("node")
        .agg(
            F.min("doc").alias("low"),
            F.max("doc").alias("high"),
            (F.min("edges") == F.max("edges")).alias("simple"),
            F.count("*").alias("times"),
        )
        .where("low < high")
        .drop("high"),
        "nodes",
    )
    found = hot_join(occurrences.drop("edges"), nodes, "node", "times", occurrences.count())
    return found.drop("node", "times")


def settle(
    row: np.ndarray, doc: np.ndarray, place: np.ndarray, low: np.ndarray, simple: np.ndarray, width: int
) -> tuple[tuple, tuple]:
    """Ranges of window starts, as (row, first, last): settled as repeated, and still open.

    Each window belongs to the node that is its smallest k-mer. If all nodes of the text in
    a window are simple, the window lies on their path.
    """
    order = np.lexsort((place, row))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (np.diff(row[order]) != 0) | (np.diff(place[order]) != 0)
    order = order[fresh]
    row, doc, place, low, simple = (v[order] for v in (row, doc, place, low, simple))
    bits = gap_bits(width)
    gaps = [(place >> (bits * k)) & ((1 << bits) - 1) for k in (3, 2, 1, 0)]
    at = place >> (4 * bits)
    before, after, far, near = gaps
    # Paths: neighbouring simple nodes.
    linked = np.zeros(len(at), bool)
    linked[1:] = (row[1:] == row[:-1]) & (at[1:] - before[1:] == at[:-1]) & simple[1:] & simple[:-1]
    path = np.cumsum(~linked) - 1
    head = np.flatnonzero(~linked)
    tail = np.append(head[1:], len(at)) - 1
    start = (at - before)[head][path] + 1
    stop = (at + after)[tail][path] - width
    first, last = at - far, at - near
    inner_first = np.where(simple, np.maximum(first, start), last + 1)
    inner_last = np.where(simple, np.minimum(last, stop), last)
    some = inner_first <= inner_last
    done = some & (low < doc)
    left_last = np.where(some, inner_first - 1, last)
    left = first <= left_last
    right_first = inner_last + 1
    right = some & (right_first <= last)
    settled = (row[done], inner_first[done], inner_last[done])
    still = tuple(
        np.concatenate([a[left], b[right]]) for a, b in ((row, row), (first, right_first), (left_last, last))
    )
    return settled, still


def range_lists(ranges: tuple, count: int) -> pa.Array:
    row, first, last = ranges
    order = np.argsort(row, kind="stable")
    offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=count))]).astype(np.int32)
    parts = pa.StructArray.from_arrays([pa.array(first[order]), pa.array(last[order])], names=["first", "last"])
    return pa.ListArray.from_arrays(pa.array(offsets), parts)


def plan(shared: DataFrame, span: int, node: int) -> DataFrame:
    """(doc, row_key, done, still): ranges of window starts of each document that has any."""
    grouped = shared.groupBy("doc", "row_key").agg(
        F.collect_list(F.struct("place", "low", "simple")).alias("nodes")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, doc = batch.column("nodes"), batch.column("doc").to_numpy()
            row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(lists).to_numpy())
            nodes = lists.flatten()
            place, low, simple = (pc.struct_field(nodes, [k]).to_numpy(zero_copy_only=False) for k in range(3))
            found = settle(row, doc[row], place, low, simple, span - node + 1)
            some = np.zeros(batch.num_rows, bool)
            for part in found:
                some[part[0]] = True
            made = [batch.column("doc"), batch.column("row_key")]
            made += [range_lists(part, batch.num_rows) for part in found]
            names = ["doc", "row_key", "done", "still"]
            yield pa.RecordBatch.from_arrays(made, names=names).filter(pa.array(some))

    part = "array<struct<first:bigint,last:bigint>>"
    return written(
        grouped.mapInArrow(work, f"doc bigint, row_key bigint, done {part}, still {part}"), "paths"
    )


def kept_words(texts: pa.Array, removed: list[np.ndarray | None] | None, span: int) -> list:
    """Number of words, of removed words, and the words that are left, of each text."""
    n_words, n_removed, left = [], [], []
    for i, text in enumerate(texts.to_pylist()):
        words = (text or "").encode().split()
        n_words.append(len(words))
        gone = 0
        if removed is not None and removed[i] is not None:
            cover = np.zeros(len(words) + 1, np.int64)
            starts = removed[i]
            np.add.at(cover, starts, 1)
            np.add.at(cover, starts + span, -1)
            stay = np.cumsum(cover)[:-1] == 0
            gone = len(words) - int(stay.sum())
            words = [w for w, s in zip(words, stay) if s]
        n_removed.append(gone)
        left.append(b" ".join(words).decode())
    return [n_words, n_removed, left]


def digest(parts: list) -> list:
    n_words, n_removed, left = parts
    return [n_words, n_removed, [hashlib.sha256(t.encode()).hexdigest() for t in left]]


def cut_repeats(
    docs: DataFrame,
    *,
    doc: str = "doc_id",
    text: str = "text",
    keep: list[str] | None = None,
    span: int = SPAN,
    node: int = NODE,
    texts: bool = True,
) -> DataFrame:
    """(row, n_words, n_removed, kept): kept is the text that is left, or its sha256."""
    keep = list(docs.columns if keep is None else keep)
    shared = shared_nodes(written(node_table(docs, text, doc, span, node), "occurrences"))
    paths = plan(shared, span, node)
    plain = docs.select(
        F.struct(*[docs[c] for c in keep]).alias("kept_row"),
        docs[text].cast("string").alias("text"),
        docs[doc].cast("bigint").alias("doc"),
        F.xxhash64(docs[doc], docs[text]).alias("row_key"),
    )
    fields = [("n_words", "bigint"), ("n_removed", "bigint"), ("kept", "string")]
    finish = (lambda parts: parts) if texts else digest

    here = T.StructType([T.StructField("row", plain.schema["kept_row"].dataType), *(field(*f) for f in fields)])

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, lambda b: b.column("text")):
            yield made(part, kept_words(part.column("text"), None, span))

    def made(batch: pa.RecordBatch, parts: list) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string())
        arrays = [pa.array(m, t) for m, t in zip(finish(parts), kinds)]
        return pa.RecordBatch.from_arrays([batch.column("kept_row"), *arrays], names=here.names)

    keys = paths.select("row_key")
    whole = of_keys(plain, keys, "row_key", inside=False).mapInArrow(rest, here)
    mine = of_keys(plain, keys, "row_key")
    touched = written(mine.join(paths.drop("doc"), "row_key"), "touched")
    repeated = open_windows(touched, span)
    found = touched.join(repeated, "row_key", "left")
    part = found.select("kept_row", "text", "done", "windows")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, lambda b: b.column("text")):
            starts = []
            for done, single in zip(batch.column("done").to_pylist(), batch.column("windows").to_pylist()):
                mine = [np.arange(r["first"], r["last"] + 1) for r in done or []]
                starts.append(np.concatenate([*mine, np.array(single or [], np.int64)]))
            removed = [s if len(s) else None for s in starts]
            yield made(batch, kept_words(batch.column("text"), removed, span))

    return whole.union(part.mapInArrow(remove, here))


def open_windows(touched: DataFrame, span: int) -> DataFrame:
    """(row_key, windows): starts of open windows that a smaller document holds as well."""
    rows = touched.where(F.size("still") > 0).select("doc", "row_key", "text", "still")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, lambda b: b.column("text")):
            words = Words(batch.column("text"), BLANK_WORDS, lower=False)
            starts, owners = [], []
            for i, still in enumerate(batch.column("still").to_pylist()):
                # Nodes that tie, as in a run of one word, share their windows.
                mine = np.unique(np.concatenate([np.arange(r["first"], r["last"] + 1) for r in still]))
                starts.append(mine)
                owners.append(np.full(len(mine), i))
            at, of = np.concatenate(starts), np.concatenate(owners)
            begin = words.first[of] + at
            hashes = range_hashes(words.hashes(), begin, begin + span)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc").take(pa.array(of)),
                    batch.column("row_key").take(pa.array(of)),
                    pa.array(at),
                    pa.array(hashes.view(np.int64)),
                ],
                names=["doc", "row_key", "at", "window"],
            )

    windows = stored(rows.mapInArrow(work, "doc bigint, row_key bigint, at bigint, window bigint"))
    lowest = windows.groupBy("window").agg(
        F.min("doc").alias("low"), F.max("doc").alias("high"), F.count("*").alias("times")
    )
    lowest = stored(lowest.where("low < high").drop("high"))
    return (
        hot_join(windows, lowest, "window", "times", windows.count())
        .where("low < doc")
        .groupBy("row_key")
        .agg(F.collect_set("at").alias("windows"))
    )
