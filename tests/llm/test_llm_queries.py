"""Registered queries over odd and empty tables, against their SQL or a brute-force version."""

import hashlib
import math
import re
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

import tables  # noqa: E402
from compare import difference  # noqa: E402
from wickwork.llm.oracles import SQL  # noqa: E402
from wickwork.llm.queries import QUERIES  # noqa: E402

BLANK = "\x20\x09-\x0d"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def odd(tmp_path_factory):
    return tables.odd_tables(tmp_path_factory.mktemp("odd"))


@pytest.fixture(scope="module")
def empty(tmp_path_factory):
    return tables.write(tmp_path_factory.mktemp("empty"), [], [], [])


def texts_of(folder):
    return [(d["doc_id"], d["text"] or "") for d in tables.odd_documents()]


@pytest.mark.parametrize("name", sorted(SQL))
def test_odd_tables_agree_with_sql(spark, odd, name):
    ours = QUERIES[name](spark, odd).toPandas()
    theirs = tables.duck(odd).execute(SQL[name]).df()
    assert difference(ours, theirs) is None


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_no_rows(spark, empty, name):
    # op12 brings a conversation of its own.
    assert QUERIES[name](spark, empty).count() == (name == "op12_chat_format")


@pytest.mark.parametrize("name,parts,wanted", [("op1_toxicity", 3, 1), ("op3_neighbours", 5, 0)])
def test_scores_of_odd_tables(spark, odd, name, parts, wanted):
    rows = QUERIES[name](spark, odd).collect()
    assert Counter(r.doc_id for r in rows) == Counter(d for d, _ in texts_of(odd))
    line = 0.7 if name == "op1_toxicity" else 0.3
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= line)
        text = "" if r.doc_id is None else str(r.doc_id)
        assert r.held_out == (zlib.crc32(text.encode()) % parts == wanted)


def base_spans(text):
    """The fixed kinds by Python's re."""

    def luhn(number):
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(number))]
        return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0

    def count(value):
        return len(re.sub("[^0-9]", "", value))

    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(p) <= 255 for p in v.split("."))),
        (
            "card",
            r"[0-9]([\x20-]?[0-9])+",
            lambda v: 12 <= count(v) <= 19 and luhn(re.sub("[^0-9]", "", v)),
        ),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 9 <= count(v) <= 15),
    ]
    found = [
        (m.start(), k, m.end())
        for k, (_, pattern, valid) in enumerate(kinds)
        for m in re.finditer(pattern, text)
        if valid(m.group())
    ]
    return [(kinds[k][0], a, b) for a, k, b in sorted(found)]


def test_private_spans_of_odd_tables(spark, odd):
    ours = defaultdict(list)
    for r in QUERIES["op9_pii"](spark, odd).collect():
        ours[r.doc_id].append(r)
    wanted = defaultdict(list)
    for doc, text in texts_of(odd):
        wanted[doc].append(base_spans(text))
    assert set(ours) == set(wanted)
    for doc, all_spans in wanted.items():
        digests = sorted(
            hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in s).encode()).hexdigest() for s in all_spans
        )
        assert digests == sorted(r.base_sha256 for r in ours[doc])
        for r in ours[doc]:
            counts = Counter(s.split(":")[0] for s in r.spans.split(",") if s)
            assert (counts["email"], counts["ip"], counts["card"], counts["phone"]) == (
                r.n_email,
                r.n_ip,
                r.n_card,
                r.n_phone,
            )
    assert "secret:9:49" in ours[418][0].spans


def slow_ppm(training, order):
    """PPM with method C escapes and exclusion, from dictionaries of contexts."""
    contexts = defaultdict(Counter)
    for data in training:
        stream = b"\xff" * order + data + b"\xff"
        for i in range(order, len(stream)):
            for size in range(order + 1):
                contexts[stream[i - size : i]][stream[i]] += 1

    def log10(data):
        stream, total = b"\xff" * order + data + b"\xff", 0.0
        for i in range(order, len(stream)):
            excluded = set()
            for size in range(order, -1, -1):
                seen = contexts.get(stream[i - size : i])
                if not seen:
                    continue
                left = {s: n for s, n in seen.items() if s not in excluded}
                room = sum(left.values()) + len(left)
                if stream[i] in left:
                    total += math.log10(left[stream[i]] / room)
                    break
                if left:
                    total += math.log10(len(left) / room)
                excluded |= set(seen)
            else:
                total -= math.log10(256 - len(excluded))
        return total

    return log10


def test_language_model_scores_of_odd_tables(spark, odd):
    from wickwork.llm.ppm import ORDER

    documents = texts_of(odd)

    def split(text):
        return re.findall(f"[^{BLANK}]+", text.translate(LOWER))

    def trains(doc):
        return zlib.crc32(("" if doc is None else str(doc)).encode()) % 7 != 2

    training = [split(t) for d, t in documents if trains(d)]
    counts = Counter(w for ws in training for w in [*ws, "\0end"])
    total, kinds = sum(counts.values()), len(counts)
    model = slow_ppm([" ".join(ws).encode() for ws in training], ORDER)
    wanted = defaultdict(list)
    for doc, text in documents:
        tokens = [*split(text), "\0end"]
        base = sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in tokens)
        known = sum(counts[w] > 0 for w in tokens)
        wanted[doc].append((len(tokens), known, base, model(" ".join(tokens[:-1]).encode())))
    ours = defaultdict(list)
    for r in QUERIES["op10_ppm"](spark, odd).collect():
        assert r.train_tokens == total and r.held_out != trains(r.doc_id)
        ours[r.doc_id].append((r.n_tokens, r.n_known, r.base_score, r.score))
    assert set(ours) == set(wanted)
    for doc in wanted:
        for mine, right in zip(sorted(ours[doc]), sorted(wanted[doc])):
            assert mine == pytest.approx(right, rel=1e-9)
