"""Chat turns as token ids with a loss mask, and the way back from ids to turns.

A turn is assembled from tokens, not from text: the role and the text are encoded separately
with a public byte-level vocabulary, and reserved ids beyond it are spliced in between, so no
merge reaches over a mark and no content can produce one. As text a turn reads
`### role: text</turn>` and a line end; there, a backslash stands before each character of the
content at which a mark begins (in roles also before a colon) and before each backslash, which
`unescape` takes back. The loss mask covers the text of assistants: +1 where it begins, -1
behind it, summed up over the tokens.

At scale: turns are encoded where they are read; one range sort by conversation and turn cuts
even a conversation with most of all rows into many parts, and gives every turn its place and
the number of tokens before it by prefix sums. `read_back` makes one digest per conversation:
a SHA-256 is a chain, so the turns of a conversation stream through one task in order; nothing
but the running digest is held. The vocabulary (under a megabyte) is broadcast.

Defined results: null roles and texts count as empty; turns follow by `turn` (nulls first), then
role, then the text's md5, repeated rows stay; a null conversation id is one conversation;
texts of more than `PIECE` characters are encoded piece by piece; an empty table gives no rows;
columns of the input sit inside `row`, so their names cannot clash.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, field, ranked, written
from .words import slices

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: The public pattern by which texts are cut before the merges of such vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: What the reserved ids read as: before a role, between role and text, behind a text.
BEGIN, SAYS, END = "### ", ": ", "</turn>\n"
LEARNED = "assistant"
PIECE = 1 << 16

_MARKS = r"\\|#(?=##)|<(?=/turn>)"
_IN_TEXT, _IN_ROLE, _ESCAPED = re.compile(_MARKS), re.compile(_MARKS + "|:"), re.compile(r"\\(.)", re.DOTALL)


def escape(content: str, role: bool = False) -> str:
    return (_IN_ROLE if role else _IN_TEXT).sub(r"\\\g<0>", content)


def unescape(content: str) -> str:
    return _ESCAPED.sub(r"\1", content)


class Codec:
    """Ids of texts and bytes of ids; the three reserved ids follow the vocabulary's."""

    def __init__(self, data: bytes):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
        self.encoding = tiktoken.Encoding(
            "chat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        size = max(ranks.values()) + 1
        self.begin, self.says, self.end = range(size, size + 3)
        self.pieces = [b""] * size + [m.encode() for m in (BEGIN, SAYS, END)]
        for piece, i in ranks.items():
            self.pieces[i] = piece
        self.role = lru_cache(4096)(lambda role: self.encode(escape(role, role=True)))

    def encode(self, text: str) -> list[int]:
        if len(text) <= PIECE:
            return self.encoding.encode_ordinary(text)
        return [i for at in range(0, len(text), PIECE) for i in self.encoding.encode_ordinary(text[at : at + PIECE])]

    def decode(self, ids: np.ndarray) -> str:
        return b"".join([self.pieces[i] for i in ids.tolist()]).decode()


@lru_cache(1)
def codec(data: bytes) -> Codec:
    return Codec(data)


def vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """The file's bytes, read on the driver, for all executors."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def encode_turns(
    rows: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    keep: list[str] | None = None,
    path: str = VOCABULARY,
) -> DataFrame:
    """One row per turn: `row`, conv, turn, role, tie, `ids`, and `mask` (1 where loss counts)."""
    spark = rows.sparkSession
    bounded_batches(spark)
    shared = vocabulary(spark, path)
    keep = list(rows.columns if keep is None else keep)
    said = F.coalesce(rows[text].cast("string"), F.lit(""))
    packed = rows.select(
        F.struct(*[rows[c] for c in keep]).alias("row"),
        rows[conversation].alias("conv"),
        rows[turn].alias("turn"),
        F.coalesce(rows[role].cast("string"), F.lit("")).alias("role"),
        F.md5(said.cast("binary")).alias("tie"),
        said.alias("text"),
    )
    kept = ["row", "conv", "turn", "role", "tie"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(shared.value)
        for batch in slices(batches, lambda b: b.column("text")):
            ids: list[int] = []
            sizes, roles = [], batch.column("role").to_pylist()
            for who, text in zip(roles, batch.column("text").to_pylist()):
                before, words = own.role(who), own.encode(escape(text))
                ids += [own.begin, *before, own.says, *words, own.end]
                sizes.append((len(before) + 2, len(words)))
            heads, bodies = np.array(sizes, np.int64).reshape(-1, 2).T
            offsets = np.concatenate([[0], np.cumsum(heads + bodies + 1)])
            learned = np.array([who == LEARNED for who in roles])
            steps = np.zeros(len(ids) + 1, np.int64)
            begins = (offsets[:-1] + heads)[learned]
            np.add.at(steps, begins, 1)
            np.add.at(steps, begins + bodies[learned], -1)
            mask = np.cumsum(steps[:-1]).astype(np.int8)
            at = pa.array(offsets, pa.int32())
            lists = [pa.ListArray.from_arrays(at, pa.array(v, k)) for v, k in ((ids, pa.int32()), (mask, pa.int8()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *lists], names=[*kept, "ids", "mask"])

    made = [field("ids", "array<int>"), field("mask", "array<tinyint>")]
    return packed.mapInArrow(run, T.StructType([*(packed.schema[c] for c in kept), *made]))


def assemble(turns: DataFrame) -> DataFrame:
    """The turns in the order of all conversations: `place` from 0, and `start`, the tokens before."""
    numbered = written(turns, "turns").withColumn("at", F.monotonically_increasing_id())
    order = [F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("tie"), F.asc("at")]
    out = ranked(numbered, *order, measures={"tokens": F.size("ids").cast("bigint")})
    return out.withColumnsRenamed({"rank": "place", "tokens_before": "start"}).drop("at", "tie")


def read_back(assembled: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """Per conversation, from ids and masks alone: turns and loss text as digests, and lengths."""
    spark = assembled.sparkSession
    shared = vocabulary(spark, path)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    streamed = assembled.select("conv", "place", "ids", "mask")
    streamed = streamed.repartition(parts, "conv").sortWithinPartitions("conv", "place")
    fields = [streamed.schema["conv"]] + [
        field(n, k)
        for n, k in (
            ("n_turns", "bigint"), ("turns_sha256", "string"), ("loss_chars", "bigint"),
            ("loss_sha256", "string"), ("formatted_chars", "bigint"),
        )
    ]
    schema = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(shared.value)
        held: list = []  # conversation, turns, digest, loss characters, digest, characters

        def finished(rows: list[list], kind: pa.DataType) -> pa.RecordBatch:
            columns = list(zip(*[(c, n, t.hexdigest(), m, l.hexdigest(), k) for c, n, t, m, l, k in rows]))
            kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            return pa.RecordBatch.from_arrays(arrays, names=schema.names)

        for batch in batches:
            done, convs, lists = [], batch.column("conv"), batch.column("ids")
            offsets = lists.offsets.to_numpy()
            ids, mask = lists.values.to_numpy(), batch.column("mask").values.to_numpy()
            moved = batch.column("mask").offsets.to_numpy()
            for i, conv in enumerate(convs.to_pylist()):
                own_ids, own_mask = ids[offsets[i] : offsets[i + 1]], mask[moved[i] : moved[i + 1]]
                says = int(np.flatnonzero(own_ids == own.says)[0])
                if own_ids[0] != own.begin or own_ids[-1] != own.end:
                    raise ValueError("a turn does not begin and end with its marks")
                role, text = own.decode(own_ids[1:says]), own.decode(own_ids[says + 1 : -1])
                loss = unescape(own.decode(own_ids[own_mask == 1]))
                if not held or held[0] != conv:
                    done += [held] if held else []
                    held = [conv, 0, sha256(), 0, sha256(), 0]
                held[1] += 1
                held[2].update(f"{unescape(role)}\n{unescape(text)}\n".encode())
                held[3] += len(loss)
                held[4].update(loss.encode())
                held[5] += len(BEGIN) + len(role) + len(SAYS) + len(text) + len(END)
            if done:
                yield finished(done, convs.type)
            kind = convs.type
        if held:
            yield finished([held], kind)

    return streamed.mapInArrow(run, schema)


def rendered(turns: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """The turns with `formatted`, their ids as text with all marks."""
    shared = vocabulary(turns.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(shared.value)
        for batch in batches:
            texts = [own.decode(np.asarray(ids)) for ids in batch.column("ids").to_pylist()]
            yield batch.append_column("formatted", pa.array(texts, pa.string()))

    return turns.mapInArrow(run, T.StructType([*turns.schema, field("formatted", "string")]))
