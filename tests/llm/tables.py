"""Small tables with every odd case the operators must survive."""

from __future__ import annotations

import random
from pathlib import Path

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq

SYLLABLES = "ka lo mi ner tu sa vo ri den pa gu shi bel ont ar que".split()


def words(rng: random.Random, count: int) -> list[str]:
    return ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(count)]


def odd_documents() -> list[dict]:
    rng = random.Random(5)
    passage = words(rng, 70)
    line = " ".join(words(rng, 12))
    base = words(rng, 160)
    rows: list[tuple] = []

    def add(doc, text, lang="en", source="src0"):
        rows.append((doc, text, lang, source))

    for i in range(60):
        text = words(rng, rng.randint(20, 120))
        if i % 5 == 0:
            at = rng.randint(0, len(text))
            text[at:at] = passage
        add(100 + i, " ".join(text) + f"\n{line}\n" + " ".join(words(rng, 15)), "en" if i % 3 else "fr", f"src{i % 4}")
    for i in range(25):  # near copies, and their neighbours' neighbours
        text = list(base)
        for _ in range(1 + i // 6):
            text[rng.randrange(len(text))] = "changed"
        add(200 + i, " ".join(text), "de", "src1")
    for i in range(12):  # exact copies
        add(300 + i, " ".join(base), "de", "src2")
    add(400, None)
    add(401, "")
    add(402, " \t\r\n\v\f ")
    add(403, "one")
    add(404, "two words")
    add(405, "One")
    add(406, "a b c d", None, None)
    add(407, "a b c d", None, None)
    add(408, " ".join(["same"] * 400))
    add(409, "\n".join(["the very same line again"] * 60), "en", None)
    add(410, " ".join(words(rng, 9000)), "es", "src3")  # very long
    add(410, " ".join(words(rng, 30)), "es", "src3")  # an id twice
    for _ in range(3):  # repeated rows
        add(411, " ".join(passage) + " tail of it", "en", "src0")
    add(None, " ".join(words(rng, 60)))
    add(None, " ".join(base), "de", "src2")
    add(412, "ÀÉÎ Ünïcödé żółw  nobreak   line 日本語 text \U0001f600 \U0001f600")
    add(413, "### $$$ and%%% of### &&& | | <b> *** " * 12)
    add(414, "x" * 3000 + " " + "1" * 700)
    add(415, "\x00 zero \x01 marks \x02 \x03 12\x013 a\x03b@c.d.e")
    add(416, "Call +1 (555) 123-4567 or +44 20 7946 0958, mail a.b@c-d.example.com. x@y, _z@q.r_s@t.uv")
    add(417, "ip 1.2.3.4 and 999.1.1.1, 1.2.3.4.5.6.7.8 cards 4111 1111 1111 1111, 4111-1111-1111-1112 0")
    add(418, 'token = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b" id 12  34 5 - 6')
    columns = ["doc_id", "text", "lang", "source"]
    out = [dict(zip(columns, r)) for r in rows]
    for k, r in enumerate(out):
        # Extra columns whose names an operator might use itself.
        r |= {
            "n_chars": None if k % 7 == 0 else len(r["text"] or ""),
            "row": f"r{k}",
            "score": "mine",
            "size": k,
            "rank": -k,
            "key": None,
            "kept": "no",
            "shard": 99,
            "hits": [k],
            "n_words": "many",
            "class": "c",
            "spans": 1.5,
            "text_key": "t",
        }
    return out


SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text", pa.string()),
        ("lang", pa.string()),
        ("source", pa.string()),
        ("n_chars", pa.int64()),
        ("row", pa.string()),
        ("score", pa.string()),
        ("size", pa.int64()),
        ("rank", pa.int64()),
        ("key", pa.string()),
        ("kept", pa.string()),
        ("shard", pa.int32()),
        ("hits", pa.list_(pa.int64())),
        ("n_words", pa.string()),
        ("class", pa.string()),
        ("spans", pa.float64()),
        ("text_key", pa.string()),
    ]
)


CONVERSATIONS = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("turn", pa.int64()),
        ("role", pa.string()),
        ("text", pa.string()),
        # Names that an operator might use itself.
        ("conv", pa.string()),
        ("row", pa.int64()),
        ("place", pa.int64()),
        ("ids", pa.string()),
        ("state", pa.string()),
    ]
)


def odd_conversations() -> list[dict]:
    rng = random.Random(9)
    rows: list[tuple] = []
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "User", "umpire", "a:b\\c"]
    ends = [".", "!", "?", "", " ", ".\n", ",", "\u2028", ". \t"]

    def said() -> str | None:
        some = rng.random()
        if some < 0.1:
            return rng.choice([None, "", "  \t\n", "\v\f\r"])
        if some < 0.2:
            return "the same again."
        return " ".join(words(rng, rng.randint(1, 4))) + rng.choice(ends)

    for conv in range(40):
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(roles) if conv % 3 else ("user", "assistant")[turn % 2]
            rows.append((conv, turn * rng.choice([1, 1, 2]), role, said()))
    for turn in range(400):  # one conversation of most rows
        rows.append((50, turn, rng.choice(roles[:5]), said()))
    rows += [(51, 3, "user", "over and over.")] * 90  # repeated rows
    rows += [(None, t, r, "no id.") for t, r in ((0, "user"), (1, "assistant"), (None, "system"))]
    rows += [(52, None, "user", "no turn"), (52, None, "assistant", None), (53, None, None, None)]
    rows += [(54, t, "user", "x") for t in (-5, 7)]
    marks = "### user: a</turn>\\ \\\\### #### ##### </turn></turn> \\n <|endoftext|> \u65e5\u672c \U0001f600"
    rows += [(55, t, r, marks) for t, r in ((0, "user"), (1, "assistant"), (2, "assistant"))]
    rows += [(56, 0, "assistant", "long " * 40000 + "x" * 70000), (56, 1, "user", " " * 90000 + ".")]
    rows += [(57, t, ("user", "assistant")[t % 2], "fine %d." % t) for t in range(60)]
    extra = ("c", 1, 2, "i", "s")
    return [dict(zip(CONVERSATIONS.names, (*r, *extra))) for r in rows]


def write(
    folder: Path,
    documents: list[dict],
    benchmark: list[tuple],
    labels: list[tuple],
    conversations: list[dict] = (),
) -> str:
    folder.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.Table.from_pylist(documents, schema=SCHEMA), folder / "documents.parquet")
    said = pa.Table.from_pylist(list(conversations), schema=CONVERSATIONS)
    pq.write_table(said, folder / "conversations.parquet")
    items = pa.schema([("item_id", pa.int64()), ("text", pa.string()), ("spans", pa.string())])
    pq.write_table(
        pa.Table.from_pylist([{"item_id": i, "text": t, "spans": "s"} for i, t in benchmark], schema=items),
        folder / "benchmark.parquet",
    )
    marks = pa.schema([("doc_id", pa.int64()), ("quality", pa.int32()), ("toxic", pa.int32())])
    pq.write_table(
        pa.Table.from_pylist([dict(zip(marks.names, r)) for r in labels], schema=marks),
        folder / "labels.parquet",
    )
    return str(folder)


def odd_tables(folder: Path) -> str:
    documents = odd_documents()
    texts = {d["doc_id"]: d["text"] for d in documents}
    passage = texts[411].split()
    benchmark = [
        (1, " ".join(passage[5:30])),
        (2, " ".join(passage[20:24])),
        (3, None),
        (4, ""),
        (5, "!!! ---"),
        (6, " ".join(texts[410].split()[3:14])),
        (6, "A B, C; D"),
        (None, " ".join(texts[200].split()[:10])),
        (7, "one"),
        (8, " ".join(passage[5:30])),
        (10, "same " * 11),
    ]
    labels = [(d, int(d % 5 > 0), int(d % 6 == 0)) for d in range(100, 225)]
    labels += [(100, 0, 1), (None, 1, 1), (101, None, None), (9999, 1, 0), (102, 1, 1), (102, 1, 1)]
    return write(folder, documents, benchmark, labels, odd_conversations())


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in ("documents", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con
