"""Chat formats, structure repair and resampling, against brute-force versions."""

import itertools
import math
import random
import re
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))

import tables  # noqa: E402
from wickwork.llm import chat, repair, resample  # noqa: E402
from wickwork.llm.words import LETTER_WORDS, Words  # noqa: E402

SCHEMA = "conv_id bigint, turn bigint, role string, text string, place string"


def rows_of(spark, rows):
    return spark.createDataFrame([(*r, "mine") for r in rows], SCHEMA)


# ---- structure repair ---------------------------------------------------------------------


def every_repair(symbols, most):
    """All edit strings up to a cost of `most`, row by row: (cost, audit)."""
    found = []

    def go(i, roles, cost, audit):
        if cost > most:
            return
        if i == len(symbols) and re.fullmatch("(s?(ua)+)?", roles):
            found.append((cost, audit))
        if not any(re.fullmatch("(s?(ua)+)?", roles + end) for end in ("", "a", "ua")):
            return
        for role in "ua":
            go(i, roles + role, cost + 2, audit + "I")
        if i == len(symbols):
            return
        initial, fault = symbols[i]
        go(i + 1, roles, cost + 3, audit + "D")
        if fault != "goes":
            cut = fault == "cut"
            go(i + 1, roles + initial, cost + cut, audit + "K")
            for role in "ua":
                go(i + 1, roles + role, cost + cut + 2, audit + "R")

    go(0, "", 0, "")
    return min(found)


def test_tables_give_the_least_of_all_repairs():
    kinds = [(i, f) for i in "suax" for f in ("", "cut")] + [("u", "goes")]
    t = repair.tables()
    rng = random.Random(1)
    cases = [list(c) for n in range(3) for c in itertools.product(kinds, repeat=n)]
    cases += [rng.choices(kinds, k=rng.randint(3, 5)) for _ in range(150)]
    cases = [c for c in cases if c]
    numbers = [[repair.GOES if f == "goes" else "suax".index(i) + 4 * (f == "cut") for i, f in c] for c in cases]
    starts = np.cumsum([0, *map(len, numbers)])[:-1]
    pieces = repair.Pieces(np.array(sum(numbers, [])), starts)
    zeros = np.zeros(len(cases), int)
    states, letters = pieces.trace(pieces.look_up(zeros)[1], zeros)
    letters = letters[pieces.at]
    for case, start, state in zip(cases, starts, states):
        audit, cost = "", 0
        for (_, fault), (inserts, action, _) in zip(case, letters[start:]):
            letter = repair.ACTIONS[action]
            audit += "I" * inserts + letter
            cost += 2 * inserts + {"D": 3, "K": 0, "R": 2}[letter] + (fault == "cut" and letter != "D")
        tail = int(t.ends[state])
        assert (cost + 2 * tail, audit + "I" * tail) == every_repair(case, cost + 2 * tail)


def test_blocks_equal_their_symbols():
    t = repair.tables()
    rng = random.Random(2)
    for _ in range(300):
        symbols, vector = rng.choices(range(repair.SYMBOLS), k=repair.BLOCK), rng.randrange(len(t.vectors))
        code, now = int("".join(map(str, symbols))), vector
        for s in reversed(symbols):
            now = t.step[now, s]
        assert t.block[vector, code] == now


@pytest.mark.parametrize("part_rows", [3, 64, repair.PART_ROWS])
def test_parts_do_not_change_a_repair(spark, part_rows):
    rows = [tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in tables.odd_conversations()]
    edited = repair.edits(rows_of(spark, rows), part_rows=part_rows)
    assert "row.place" in [f"row.{f}" for f in edited.schema["row"].dataType.names]
    found = {r.conv: r for r in repair.summary(edited).collect()}
    whole = defaultdict(list)
    for conv, turn, role, text in rows:
        whole[conv].append((turn is not None, turn or 0, " " if role is None else role, " " if text is None else text))
    assert set(found) == set(whole)
    after = defaultdict(list)
    for r in repair.repaired(edited).orderBy("place", "part").collect():
        after[r.conv].append((r.role, r.text))
    for conv, r in found.items():
        roles = [role for role, _ in after[conv]]
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in roles))
        text = "\n".join(f"{a}:{b}" for a, b in after[conv])
        assert repair.sha256(text.encode()).hexdigest() == r.repaired_sha256
        assert sum(r.audit.count(k) for k in "DKR") == len(whole[conv])
        assert r.duplicate == len(whole[conv]) - len({x[2:] for x in whole[conv]}) - again(whole[conv])
    test_parts_do_not_change_a_repair.seen = getattr(test_parts_do_not_change_a_repair, "seen", found)
    assert {c: tuple(r) for c, r in found.items()} == {
        c: tuple(r) for c, r in test_parts_do_not_change_a_repair.seen.items()
    }


def again(rows):
    """Blank rows that are repeats count as blank only."""
    blank = [x[2:] for x in rows if not x[3].strip(" \t\n\v\f\r")]
    return len(blank) - len(set(blank))


# ---- chat formats -------------------------------------------------------------------------


def test_escapes_are_taken_back_and_hide_all_marks():
    rng = random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choices(["#", "\\", "</turn>", "<", "/turn>", ":", " ", "a", "\n"], k=rng.randint(0, 14)))
        for role in (False, True):
            hidden = chat.escape(text, role)
            assert chat.unescape(hidden) == text
            left = re.sub(r"\\.", "\0", hidden, flags=re.DOTALL)
            assert chat.BEGIN.strip() not in left and "</turn>" not in left
            assert not role or ":" not in left


def test_turns_stand_in_order_with_their_offsets(spark):
    rows = [tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in tables.odd_conversations()]
    turns = chat.assemble(chat.encode_turns(rows_of(spark, rows)))
    found = chat.rendered(turns).orderBy("place").collect()
    own = chat.codec(open(chat.VOCABULARY, "rb").read())
    start, order = 0, []
    for place, r in enumerate(found):
        assert (r.place, r.start) == (place, start)
        start += len(r.ids)
        order.append((r.conv is not None, r.conv or 0, r.turn is not None, r.turn or 0, r.role))
        text = r.row.text or ""
        assert r.formatted == f"### {chat.escape(r.row.role or '', True)}: {chat.escape(text)}</turn>\n"
        assert r.ids.count(own.begin) == r.ids.count(own.says) == r.ids.count(own.end) == 1
        under = own.decode(np.array([i for i, m in zip(r.ids, r.mask) if m], int))
        assert chat.unescape(under) == (text if r.row.role == "assistant" else "")
    assert order == sorted(order) and len(found) == len(rows)


def test_a_conversation_in_many_tasks_keeps_its_order(spark):
    rows = [(1, t, ("user", "assistant")[t % 2], f"turn {t}.") for t in range(3000)]
    (r,) = chat.read_back(chat.assemble(chat.encode_turns(rows_of(spark, rows)))).collect()
    said = "".join(x[3] for x in rows if x[2] == "assistant")
    assert (r.n_turns, r.loss_chars) == (3000, len(said))
    assert r.loss_sha256 == chat.sha256(said.encode()).hexdigest()


# ---- resampling ---------------------------------------------------------------------------


def test_crcs_of_runs_equal_zlib():
    import pyarrow as pa

    rng = random.Random(4)
    texts = [" ".join(tables.words(rng, rng.randint(0, 30))) for _ in range(40)]
    texts += ["", None, "Ä ö " + "y" * 700 + " z", "x" * 128 + "\n" + "x" * 129, "one\n\ntwo three\n\n\nfour"]
    words = Words(pa.array(texts), LETTER_WORDS, lower=True)
    buckets, counts = resample.inner_buckets(words)
    at = 0
    for text, count in zip(texts, counts):
        ws = (text or "").replace("Ä", "Ä").lower().replace("ä", "Ä").split()
        runs = [" ".join(ws[i : i + k]) for i in range(len(ws)) for k in (1, 2, 3) if i + k <= len(ws)]
        assert [zlib.crc32(f.encode()) % resample.BUCKETS for f in runs] == buckets[at : at + count].tolist()
        at += count


def test_frequent_lines_meet_by_broadcast_and_others_by_shuffle(spark):
    """A line in nearly all places, and weights that add up to those of whole texts."""
    rng = random.Random(6)
    hot = "the line that stands everywhere"
    docs = [(i, "\n".join([hot] * (i % 40) + [" ".join(tables.words(rng, 6))] + [hot, ""])) for i in range(400)]
    target = [(1, "the line of the target stands alone"), (2, None)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    found = resample.importance(frame, spark.createDataFrame(target, "item_id bigint, text string")).collect()

    def features(text):
        ws = (text or "").split()
        return Counter(
            zlib.crc32(" ".join(ws[i : i + k]).encode()) % resample.BUCKETS
            for k in (1, 2, 3)
            for i in range(len(ws) - k + 1)
        )

    corpus, wanted = Counter(), Counter()
    for _, text in docs:
        corpus.update(features(text))
    for _, text in target:
        wanted.update(features(text))
    total, of_target = sum(corpus.values()) + resample.BUCKETS, sum(wanted.values()) + resample.BUCKETS
    gain = {
        b: math.floor(1000 * math.log((wanted[b] + 1) * total / ((corpus[b] + 1) * of_target))) for b in corpus
    }
    for r in found:
        own = features(dict(docs)[r.row.doc_id])
        assert r.weight == sum(gain[b] * n for b, n in own.items()) and r.n_features == sum(own.values())
