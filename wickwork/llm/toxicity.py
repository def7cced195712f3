"""Toxicity of texts behind leetspeak, spacing and repetition.

A noisy channel turns clean words into what stands in a text: letters become digits or
symbols, are repeated, masked, or set apart by blanks, line ends and punctuation. Each token that
may be such a word becomes a lattice of letters it can stand for, and Viterbi decoding finds the
likeliest path under a character 4-gram model counted over the words of all documents.
Tokens with one reading only are their own best path and skip the search. Runs of single
characters, and of short pieces of which the model does not expect one to be a word, become
lattices with the blanks as letters that may fall away. Tokens without any letter are read as
words if they mix signs that stand for letters; digits alone stay numbers unless the letters
are likelier than evenly drawn digits.

The restored text is scored by terms (words and beginnings of words). Terms come from a
bounded sample of labelled rows (`SAMPLE_TOXIC`, `SAMPLE_CLEAN`, near copies counted once);
how reliable each one is, is counted over all labelled training rows. A logistic model, fit
on `SAMPLE_FIT` labelled rows at most, turns the evidence of all matched words into a score.

Defined results: null, empty and wordless texts get the score of a text without any term;
texts of any length are read whole, in one row; paths that tie are settled by the order of the
readings, so reruns agree; repeated rows get one and the same score; an empty table gives no
rows; extra columns of any name travel inside `row`. Repeated labels of a document count once,
toxic if any says so; labels without a document, null labels and null ids teach nothing; without
toxic labels every text gets the score of a text without any term.
"""

from __future__ import annotations

import math
import re
import string
from array import array
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import annotate, field, stored
from .words import slices, text_bytes

# ---- the character model -----------------------------------------------------------------

#: 0 is a word border, 1 to 26 are letters, 27 any other letter.
SYMBOLS = 28
ORDER = 4
CELLS = SYMBOLS**ORDER
_CONTEXTS = SYMBOLS ** (ORDER - 1)

_BYTE_SYMBOL = np.zeros(256, np.int32)
_BYTE_SYMBOL[97:123] = np.arange(1, 27)
_BYTE_SYMBOL[65:91] = np.arange(1, 27)
_BYTE_SYMBOL[0xC2:0xF5] = 27
_CONTINUES = (np.arange(256) >= 0x80) & (np.arange(256) < 0xC0)


def symbol(char: str) -> int:
    if "a" <= char <= "z":
        return ord(char) - 96
    return 27 if char.isalpha() else 0


def gram_counts(texts: pa.Array) -> np.ndarray:
    """How often each run of four symbols ends a position of the words of some texts."""
    data, offsets = text_bytes(texts)
    border = np.zeros(len(data), bool)
    border[offsets[:-1][offsets[:-1] < len(data)]] = True  # a text never continues the one before
    own = ~_CONTINUES[data]
    symbols = np.where(border, 0, _BYTE_SYMBOL[data])[own]
    fresh = np.ones(len(symbols), bool)
    fresh[1:] = (symbols[1:] > 0) | (symbols[:-1] > 0)
    symbols = np.concatenate([[0] * (ORDER - 1), symbols[fresh], [0]])
    cell = np.zeros(len(symbols) - ORDER + 1, np.int64)
    for k in range(ORDER):
        cell = cell * SYMBOLS + symbols[k : k + len(cell)]
    return np.bincount(cell, minlength=CELLS)


def char_model(docs: DataFrame, text: str) -> np.ndarray:
    """log p(symbol | three before), dense: its size is fixed, its counts cover all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, np.int64)
        for batch in slices(batches, lambda b: b.column(0)):
            total += gram_counts(batch.column(0))
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cells.astype(np.int32)), pa.array(total[cells])], names=["cell", "n"]
        )

    parts = docs.select(docs[text].cast("string")).mapInArrow(count, "cell int, n bigint")
    rows = parts.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(CELLS)
    counts[rows.column("cell").to_numpy()] = rows.column("n").to_numpy()
    counts = counts.reshape((SYMBOLS,) * ORDER)
    # Shorter contexts back up longer ones, each with the weight of one more unseen event.
    model = np.full(SYMBOLS, 1.0 / SYMBOLS)
    for order in range(1, ORDER + 1):
        own = counts.sum(axis=tuple(range(ORDER - order)))
        weight = 5.0
        model = (own + weight * model) / (own.sum(axis=-1, keepdims=True) + weight)
    return np.log(model).astype(np.float32).ravel()


# ---- the channel -------------------------------------------------------------------------

# Letters that a sign commonly stands for.
LEET = {
    "0": "o",
    "1": "il",
    "2": "z",
    "3": "e",
    "4": "a",
    "5": "s",
    "6": "gb",
    "7": "t",
    "8": "b",
    "9": "g",
    "@": "a",
    "$": "s",
    "!": "il",
    "|": "il",
    "(": "c",
    "+": "t",
    "€": "e",
    "£": "l",
}
MASKS = "*#"
VOWELS = "aeiou"
LEET_COST, MASK_COST, DROP_COST, KEEP_COST, REPEAT_COST = -1.5, -4.0, -1.5, -6.0, -1.0
#: Writing a letter twice that stands once, a blank kept between single characters, a blank
#: dropped between pieces, and one digit of a number.
DOUBLE_COST, SPACE_COST, JOIN_COST, DIGIT_COST = -4.0, -1.0, -4.0, -math.log(10)
#: A piece whose letters are on average less likely than one of ten is not expected to be a word.
EXPECTED = -math.log(10)

#: Longer runs of digits are no words.
LONGEST_NUMBER = 12

#: Longer runs of pieces are decoded each time they are met.
REMEMBERED_RUN = 32

_LETTERS = string.ascii_lowercase
_EDGE = "".join(c for c in string.punctuation if c not in "$@")
_RUNS = re.compile(r"(.)\1*", re.DOTALL)
_TAIL = re.compile(r"([^\w\s])\1{2,}$")
_REPEATED = re.compile(r"([^\W\d_])\1")
_DOUBLED = re.compile(r"([^\W\d_])\1+")
_TRIPLE = re.compile(r"([^\W\d_])\1\1")
#: Three or more single characters, each between blanks or line ends.
_SPACED = re.compile(r"(?<!\S)\S(?:\s+\S){2,}(?!\S)")
#: Two or more pieces of few letters.
_PIECES = re.compile(r"(?<!\S)[^\W\d_]{1,4}(?:\s+[^\W\d_]{1,4})+(?!\S)")
_WORDS = re.compile(r"[^\W\d_]+")


def readings(run: str) -> list[tuple[str, float]]:
    """What a run of one character can stand for, with log probabilities of the channel."""
    char, length = run[0], len(run)
    if char.isalpha():
        if length == 1:
            return [(run, 0.0)]
        if length == 2:
            return [(run, 0.0), (char, DOUBLE_COST)]
        return [(char, REPEAT_COST), (char * 2, REPEAT_COST)]
    out = [("", DROP_COST), (run, KEEP_COST)] if not char.isdigit() else [(run, KEEP_COST)]
    out += signs_for(run)
    if char in MASKS:
        out += [(letter, MASK_COST) for letter in _LETTERS]
    elif char in LEET and char not in "123456789":
        out += [(letter, MASK_COST) for letter in VOWELS]
    return out


def signs_for(run: str) -> list[tuple[str, float]]:
    """Letters that a run of one sign commonly stands for; of two signs rather two letters."""
    once = LEET_COST + (DOUBLE_COST if len(run) == 2 else 0.0)
    out = [(letter, once) for letter in LEET.get(run[0], "")]
    return out + [(letter * 2, LEET_COST) for letter in LEET.get(run[0], "") if len(run) > 1]


def letters_for(token: str) -> list[list[tuple[str, float]]]:
    """The lattice of a token whose signs all stand for letters."""
    return [signs_for(m.group()) for m in _RUNS.finditer(token)]


class Decoder:
    """Restores words; remembers what it has restored, up to a bounded number of tokens."""

    REMEMBER = 200_000

    def __init__(self, model: np.ndarray):
        self.model = array("f", model.tobytes())
        self.known: dict[str, tuple[str, ...]] = {}
        self.pieces: dict[str, bool] = {}
        self.runs: dict[str, tuple[str, ...]] = {}
        self.steps: dict[tuple[int, str], tuple[float, int]] = {}

    def best(self, lattice: list[list[tuple[str, float]]]) -> tuple[float, str]:
        """The likeliest path through a lattice, with its log probability."""
        model = self.model
        # A path is a chain of its last piece and the path before.
        states: dict[int, tuple[float, tuple]] = {0: (0.0, ())}
        for options in lattice:
            after: dict[int, tuple[float, tuple]] = {}
            for context, (score, path) in states.items():
                for out, cost in options:
                    now, s = context, score + cost
                    for char in out:
                        k = symbol(char)
                        s += model[now * SYMBOLS + k]
                        now = (now * SYMBOLS + k) % _CONTEXTS if k else 0
                    if now not in after or s > after[now][0]:
                        after[now] = (s, (out, path))
            states = after
        total, path = max(((s + model[c * SYMBOLS], path) for c, (s, path) in states.items()), key=lambda x: x[0])
        pieces = []
        while path:
            piece, path = path
            pieces.append(piece)
        return total, "".join(reversed(pieces))

    def viterbi(self, lattice: list[list[tuple[str, float]]]) -> str:
        return self.best(lattice)[1]

    def word(self, token: str) -> tuple[str, ...]:
        """The words that a lower-case token stands for; one with double letters also as it stands."""
        found = self.read(token)
        plain = token.strip(_EDGE)
        if found and plain.isalpha() and found[0] != plain and not _TRIPLE.search(plain):
            return (*found, plain)
        return found

    def read(self, token: str) -> tuple[str, ...]:
        """The likeliest words of a lower-case token."""
        found = self.known.get(token)
        if found is None:
            if len(self.known) >= self.REMEMBER:
                self.known.clear()
            found = self.known[token] = self._read(token)
        return found

    def _read(self, token: str) -> tuple[str, ...]:
        if token.isalpha() and not _REPEATED.search(token):
            return (token,)
        core = _TAIL.sub("", token).lstrip(_EDGE).rstrip(_EDGE + "@")
        if core.isalpha() and not _REPEATED.search(core):
            return (core,)
        if not any(c.isalpha() for c in core):
            return self._signs(token)
        if core.isalpha() and len(doubled := list(_DOUBLED.finditer(core))) == 1 and len(doubled[0].group()) == 2:
            return (self._one_double(core, doubled[0].start() + 1),)
        lattice = [readings(m.group()) for m in _RUNS.finditer(core)]
        return tuple(_WORDS.findall(self.viterbi(lattice)))

    def _one_double(self, word: str, at: int) -> str:
        """A word whose only doubled letter ends at a place, with or without it.

        The two paths through its lattice differ around that place only: contexts have three letters.
        """
        model, start = self.model, 0
        for char in word[max(0, at - ORDER + 1) : at]:
            start = start * SYMBOLS + symbol(char)
        after = [symbol(c) for c in word[at + 1 : at + ORDER]]
        if len(after) < ORDER - 1:
            after.append(0)
        odds = []
        for codes in ([symbol(word[at]), *after], after):
            s, now = 0.0, start
            for k in codes:
                s += model[now * SYMBOLS + k]
                now = (now * SYMBOLS + k) % _CONTEXTS
            odds.append(s)
        return word if odds[0] >= odds[1] + DOUBLE_COST else word[:at] + word[at + 1 :]

    def _signs(self, token: str) -> tuple[str, ...]:
        """The word in a token without letters, if its signs can be one."""
        if len(token) < 3 or len(set(token)) < 2 or not all(c in LEET for c in token):
            return ()
        signs = sum(not c.isdigit() for c in token)
        if signs >= 2:
            return (self.viterbi(letters_for(token)),)
        if signs or len(token) > LONGEST_NUMBER:
            return ()
        score, word = self.best(letters_for(token))
        return (word,) if score > len(token) * DIGIT_COST else ()

    def expected(self, piece: str) -> bool:
        """Whether the model takes a piece for a word of its own."""
        found = self.pieces.get(piece)
        if found is None:
            if len(self.pieces) >= self.REMEMBER:
                self.pieces.clear()
            found = self.pieces[piece] = self.best([[(piece, 0.0)]])[0] > (len(piece) + 1) * EXPECTED
        return found

    def joined(self, run: str) -> tuple[str, ...]:
        """Words that short pieces are parts of; none if all pieces may be words."""
        pieces = run.split()
        if all(len(p) == 1 for p in pieces) or all(self.expected(p) for p in pieces):
            return ()
        own = set(pieces)
        return tuple(w for w in self.pieced(pieces).split() if w not in own)

    def step(self, context: int, piece: str) -> tuple[float, int]:
        """Log probability of a piece after a context, and the context after it."""
        key = (context, piece)
        found = self.steps.get(key)
        if found is None:
            if len(self.steps) >= self.REMEMBER:
                self.steps.clear()
            s, now = 0.0, context
            for char in piece:
                k = symbol(char)
                s += self.model[now * SYMBOLS + k]
                now = (now * SYMBOLS + k) % _CONTEXTS if k else 0
            found = self.steps[key] = (s, now)
        return found

    def pieced(self, pieces: list[str]) -> str:
        """Pieces with the likeliest blanks between them: Viterbi with remembered steps."""
        model, step = self.model, self.step
        s, now = step(0, pieces[0])
        states: dict[int, tuple[float, tuple]] = {now: (s, (pieces[0], ()))}
        for piece in pieces[1:]:
            after: dict[int, tuple[float, tuple]] = {}
            score, path = max(
                ((s + model[c * SYMBOLS], path) for c, (s, path) in states.items()), key=lambda x: x[0]
            )
            s, now = step(0, piece)
            after[now] = (score + s, (" " + piece, path))
            for context, (score, path) in states.items():
                s, now = step(context, piece)
                s += score + JOIN_COST
                if now not in after or s > after[now][0]:
                    after[now] = (s, (piece, path))
            states = after
        path = max(((s + model[c * SYMBOLS], path) for c, (s, path) in states.items()), key=lambda x: x[0])[1]
        out = []
        while path:
            piece, path = path
            out.append(piece)
        return "".join(reversed(out))

    def spaced(self, run: str) -> tuple[str, ...]:
        """Words set in single characters; the path decides where one word ends."""
        chars = run.split()
        if sum(c.isalpha() for c in chars) < 2:
            return ()
        lattice: list[list[tuple[str, float]]] = []
        for char in chars:
            if lattice:
                lattice.append([("", 0.0), (" ", SPACE_COST)])
            lattice.append(readings(char))
        return tuple(_WORDS.findall(self.viterbi(lattice)))

    def apart(self, text: str) -> Iterator[tuple[str, ...]]:
        """Words of a lower-case text that are set apart by blanks, run by run."""
        for run in _SPACED.findall(text):
            yield self.spaced(run)
        for run in _PIECES.findall(text):
            found = self.runs.get(run)
            if found is None:
                found = self.joined(run)
                if len(run) <= REMEMBERED_RUN:
                    if len(self.runs) >= self.REMEMBER:
                        self.runs.clear()
                    self.runs[run] = found
            if found:
                yield found

    def words(self, text: str) -> set[str]:
        """The distinct words of the restored text."""
        text = text.lower()
        out: set[str] = set()
        for token in set(text.split()):
            out.update(self.word(token))
        for found in self.apart(text):
            out.update(found)
        return out

    def _rejoined(self, run: str) -> str:
        """A run of pieces with those that make a word put together."""
        return self.pieced(run.split()) if self.joined(run) else run

    def restore(self, text: str) -> str:
        """The text with every restored token in its place."""
        text = _SPACED.sub(lambda m: " ".join(self.spaced(m.group())) or m.group(), text.lower())
        text = _PIECES.sub(lambda m: self._rejoined(m.group()), text)
        return re.sub(r"\S+", lambda m: " ".join(self.read(m.group())) or m.group(), text)


# ---- terms -------------------------------------------------------------------------------

SAMPLE_TOXIC = 2000
SAMPLE_CLEAN = 4000
PREFIXES = range(3, 9)
SAMPLE_FIT = 20_000
LEAST_PRECISION = 0.8


def terms_of(words: set[str]) -> set[str]:
    out = set(words)
    for word in words:
        out.update(word[:k] + "-" for k in PREFIXES if len(word) > k)
    return out


def signature(text: str, size: int = 3, hashes: int = 4) -> tuple[int, ...]:
    """Smallest hashes of word shingles: near copies share some of them."""
    codes = np.array([crc32(w.encode()) for w in text.lower().split()], np.uint64)
    if len(codes) < size:
        return ()
    mixed = sum(codes[k : len(codes) - size + 1 + k] * np.uint64(2 * k + 2654435761) for k in range(size))
    factors = (11400714819323198485, 14029467366897019727, 1609587929392839161, 9650029242287828579)
    return tuple(int(((mixed * np.uint64(f)) >> np.uint64(16)).min()) for f in factors[:hashes])


def distinct_texts(texts: list[str]) -> list[str]:
    """One text of each group that shares a smallest hash."""
    seen: set[tuple[int, int]] = set()
    out = []
    for text in texts:
        mine = set(enumerate(signature(text)))
        if not mine & seen:
            out.append(text)
        seen |= mine
    return out


def learn_terms(toxic: list[str], clean: list[str], decoder: Decoder) -> dict[str, bool]:
    """Terms that speak for toxicity; True for those whose support cannot be chance."""
    toxic, clean = distinct_texts(toxic), distinct_texts(clean)
    if not toxic:
        return {}
    held: Counter[str] = Counter()
    for text in toxic:
        held.update(terms_of(decoder.words(text)))
    often = {t: n for t, n in held.items() if n >= 3}
    other: Counter[str] = Counter()
    for text in clean:
        other.update(t for t in terms_of(decoder.words(text)) if t in often)
    share = len(toxic) / max(1, len(toxic) + len(clean))
    # So many toxic texts in a row are expected for less than one term of `often` by chance.
    support = math.log(max(2, 2 * len(held))) / -math.log(min(share, 0.5))
    good = {t: n for t, n in often.items() if n / (n + other[t]) >= LEAST_PRECISION}
    return {t: good[t] >= support for t in sorted(good, key=lambda t: (-good[t], t))}


# ---- documents ---------------------------------------------------------------------------

class Matcher:
    """Terms in the words that tokens stand for, remembered by token."""

    REMEMBER = 500_000

    def __init__(self, decoder: Decoder, number: dict[str, int]):
        self.decoder, self.number = decoder, number
        self.known: dict[str, tuple[tuple[int, ...], ...]] = {}

    def chains(self, words: tuple[str, ...]) -> tuple[tuple[int, ...], ...]:
        out = []
        for word in words:
            names = [word, *[word[:k] + "-" for k in PREFIXES if len(word) > k]]
            if found := tuple(self.number[n] for n in names if n in self.number):
                out.append(found)
        return tuple(out)

    def match(self, text: str) -> tuple[int, list[dict]]:
        """The number of tokens, and the terms of each matched word with its count."""
        text = text.lower()
        tokens = text.split()
        if len(self.known) > self.REMEMBER:
            self.known.clear()
        known, hits = self.known, Counter()
        for token, n in Counter(tokens).items():
            found = known.get(token)
            if found is None:
                found = known[token] = self.chains(self.decoder.word(token))
            for chain in found:
                hits[chain] += n
        for found in self.decoder.apart(text):
            for chain in self.chains(found):
                hits[chain] += 1
        return len(tokens), [{"terms": list(c), "n": n} for c, n in sorted(hits.items())]


_MATCHERS: dict[int, Matcher] = {}


def matcher_of(model, number) -> Matcher:
    """One matcher per worker process and model, with what it remembers."""
    key = id(number.value)
    if key not in _MATCHERS:
        _MATCHERS.clear()
        _MATCHERS[key] = Matcher(Decoder(model.value), number.value)
    return _MATCHERS[key]


def labelled(docs: DataFrame, labels: DataFrame, doc: str, text: str, label: str, value: int, most: int):
    """Texts of at most `most` documents with a label, the same ones on every run."""
    ids = labels.where(F.col("label") == value).orderBy(F.xxhash64(F.lit(label), "doc")).limit(most)
    rows = docs.select(docs[doc].alias("doc"), docs[text].cast("string").alias("text")).join(
        F.broadcast(ids.select("doc")), "doc", "left_semi"
    )
    return sorted(r.text or "" for r in rows.select("text").toLocalIterator())


def score(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    keep: list[str] | None = None,
) -> DataFrame:
    """(row, score): labels are those to learn from; score is between 0 and 1."""
    spark = docs.sparkSession
    keep = list(docs.columns if keep is None else keep)
    teach = stored(
        labels.select(labels[doc].alias("doc"), labels[label].cast("int").alias("label"))
        .where("doc is not null and label is not null")
        .groupBy("doc")
        .agg(F.max("label").alias("label"))
    )
    model = spark.sparkContext.broadcast(char_model(docs, text))
    decoder = Decoder(model.value)
    terms = learn_terms(
        labelled(docs, teach, doc, text, label, 1, SAMPLE_TOXIC),
        labelled(docs, teach, doc, text, label, 0, SAMPLE_CLEAN),
        decoder,
    )
    names = list(terms)
    number = spark.sparkContext.broadcast({t: i for i, t in enumerate(names)})

    def find(texts: pa.Array) -> list:
        matcher = matcher_of(model, number)
        return list(zip(*[matcher.match(t or "") for t in texts.to_pylist()])) or [[], []]

    plain = docs.select(
        F.struct(*[docs[c] for c in keep]).alias("kept"),
        docs[doc].alias("doc"),
        docs[text].cast("string").alias("text"),
    )
    fields = [("n_tokens", "int"), ("hits", "array<struct<terms:array<int>,n:int>>")]
    found = stored(
        annotate(plain, "text", fields, find, ["kept", "doc"]).select("row.*", "n_tokens", "hits")
    )
    known = found.join(teach, "doc").select("doc", "n_tokens", "hits", "label")
    counts = (
        known.where(F.size("hits") > 0)
        .select("doc", "label", F.explode(F.array_distinct(F.flatten("hits.terms"))).alias("term"))
        .distinct()
        .groupBy("term")
        .agg(F.sum("label").alias("toxic"), F.count("*").alias("rows"))
        .collect()
    )
    power = np.zeros((2, len(names)))
    for term, toxic, rows in counts:
        strength = -math.log(1 - (toxic + 1) / (rows + 2))
        weak = not terms[names[term]] or toxic < LEAST_PRECISION * rows
        power[int(weak), term] = strength
    strengths = spark.sparkContext.broadcast(power)

    def facts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, hits = batch.column("n_tokens").to_pylist(), batch.column("hits").to_pylist()
            facts = [evidence(n, h, strengths.value) for n, h in zip(tokens, hits)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(facts, pa.list_(pa.float64())), batch.column("label")], names=["facts", "label"]
            )

    sample = known.orderBy(F.xxhash64(F.lit("fit"), "doc")).limit(SAMPLE_FIT)
    rows = sample.select("n_tokens", "hits", "label").mapInArrow(facts_of, "facts array<double>, label int")
    rows = rows.collect()
    weights = spark.sparkContext.broadcast((power, fit([r.facts for r in rows], [r.label for r in rows])))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        power, model = weights.value
        for batch in batches:
            tokens, hits = batch.column("n_tokens").to_pylist(), batch.column("hits").to_pylist()
            facts = [evidence(n, h, power) for n, h in zip(tokens, hits)]
            scores = predict(np.array(facts).reshape(-1, FACTS), model)
            yield pa.RecordBatch.from_arrays(
                [batch.column("kept"), pa.array(scores, pa.float64())], names=["row", "score"]
            )

    kept = found.select("kept", "n_tokens", "hits")
    schema = T.StructType([T.StructField("row", kept.schema["kept"].dataType), field("score", "double")])
    return kept.mapInArrow(weigh, schema)


FACTS = 4


def evidence(n_tokens: int, hits: list, power: np.ndarray) -> list[float]:
    """What speaks for toxicity: sure and weak terms, matched words, and the text's length."""
    sums, words = [0.0, 0.0], 0
    for terms, n in ((h["terms"], h["n"]) for h in hits):
        at = np.array(terms)
        best = power[:, at].max(axis=1)
        # A word gives what the strongest of its terms gives, sure ones first.
        sums[0 if best[0] > 0 else 1] += n * float(best[0] if best[0] > 0 else best[1])
        words += n if best[0] > 0 else 0
    return [min(sums[0], 30.0), min(sums[1], 30.0), min(words, 5.0), math.log1p(n_tokens)]


def fit(facts: list[list[float]], labels: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logistic regression by Newton steps, with a weak pull of all weights to zero."""
    if not facts:
        return np.zeros(FACTS), np.ones(FACTS), np.array([-3.0, *[0.0] * FACTS])
    x, y = np.array(facts), np.array(labels, float)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    scale[scale < 1e-6] = 1.0
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    share = (y.sum() + 0.5) / (len(y) + 1)
    # More evidence never lowers a score; a longer text alone never raises it.
    sign = np.array([0, *[1] * (FACTS - 1), -1])
    used = np.ones(FACTS + 1, bool)
    while True:
        w = np.zeros(FACTS + 1)
        w[0] = math.log(share / (1 - share))
        pull = np.diag([1e-3, *[0.3] * FACTS])[np.ix_(used, used)]
        part = z[:, used]
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(part @ w[used], -30, 30)))
            slope = part.T @ (y - p) - pull @ w[used]
            step = np.linalg.solve((part * (p * (1 - p))[:, None]).T @ part + pull, slope)
            w[used] += np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-6:
                break
        wrong = used & (w * sign < 0)
        if not wrong.any():
            break
        used &= ~wrong
    return mean, scale, w


def predict(facts: np.ndarray, model: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    mean, scale, w = model
    return 1 / (1 + np.exp(-np.clip(w[0] + ((facts - mean) / scale) @ w[1:], -30, 30)))


def restored(docs: DataFrame, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(row, restored): every text as the channel's likeliest clean text, lower-case."""
    context = docs.sparkSession.sparkContext
    model, no_terms = context.broadcast(char_model(docs, text)), context.broadcast({})

    def work(texts: pa.Array) -> list:
        own = matcher_of(model, no_terms).decoder
        return [[None if t is None else own.restore(t) for t in texts.to_pylist()]]

    return annotate(docs, text, [("restored", "string")], work, keep)
