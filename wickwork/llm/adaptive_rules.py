"""Quality rules whose limits come from the data: quantile sketches per language and source.

Each document is measured; documents that pass the base rules are counted into sketches, one
per (language, source, measure). A sketch is a table of counts by value in thousandths (or
tenths of a character, in steps of `EXACT_BITS` leading bits above 2 ** EXACT_BITS): it merges
by addition, its quantiles are exact to one such step, and reruns agree. A limit lies `FENCE`
spreads beyond the quartiles of its group; a spread is the distance between the quartiles, a
measure's least spread and the step at the upper quartile at least. A group of under `MIN_ROWS`
documents uses the merged sketch of its language, or else of all documents. Documents are
joined with the limits of their group, a table of one row per group.

Only SQL functions are used. Windows of words are compared by 64-bit hashes.

Defined results: null, empty and blank texts have no words, fail the base rules and are not
kept; null languages and sources are groups of their own; repeated rows stay; an empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import broadcast_if_small
from .common import BLANKS, stored

MIN_WORDS = 10
MOST_REPEATED = 20  # percent
WINDOW = 5

#: Values have so many leading bits: exact below 2048, then in steps of 0.1 % of the value at
#: most, so a sketch stays small however long words are.
EXACT_BITS = 11


def step_bits(value: str) -> str:
    """SQL: the low bits that a value's step spans."""
    return f"greatest(length(bin({value})) - {EXACT_BITS}, 0)"


def stepped(value: str) -> str:
    bits = step_bits(value)
    return f"shiftleft(shiftright({value}, {bits}), {bits})"


#: Measure: (expression in its integer steps, least spread, limited below too).
MEASURES = {
    "symbols": ("n_symbols * 1000 div greatest(word_chars, 1)", 5, False),
    "repeats": ("n_repeat_words * 1000 div greatest(n_words, 1)", 20, False),
    "same_lines": ("n_dup_lines * 1000 div greatest(n_lines, 1)", 50, False),
    "word_length": (stepped("(word_chars * 10 div greatest(n_words, 1))"), 10, True),
}
FENCE = 3
MIN_ROWS = 100
GROUP_ROWS = 100_000  # limits are broadcast up to so many groups


def let(value: str, name: str, body: str) -> str:
    """SQL: body, with `name` for the value, which is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def repeated_words(words: str, window: int = WINDOW) -> str:
    """SQL: words that lie in a window of words found twice or more, all of them counted."""
    parts = ", ".join(f"{words}[i + {k}]" for k in range(window))
    hashes = f"transform(sequence(0, size({words}) - {window}), i -> xxhash64({parts}))"
    # Windows by hash; those with an equal neighbour; their places in order; words they cover.
    ordered = "sort_array(transform(h, (x, i) -> named_struct('x', x, 'i', i)))"
    same = "filter(o, (s, k) -> coalesce(get(o, k - 1).x = s.x, false) or coalesce(get(o, k + 1).x = s.x, false))"
    places = f"sort_array(transform({same}, s -> s.i))"
    covered = (
        f"aggregate(transform(p, (x, k) -> least({window}, coalesce(get(p, k + 1) - x, {window}))),"
        " 0L, (a, x) -> a + x)"
    )
    count = let(ordered, "o", let(places, "p", covered))
    some = f"if(size(array_distinct(h)) = size(h), 0L, {count})"
    return f"if(size({words}) < {window}, 0L, {let(hashes, 'h', some)})"


def measured(docs: DataFrame, *, text: str, lang: str, source: str, keep: list[str]) -> DataFrame:
    """(row, lang, source, counts, base_failed) of each document."""
    plain = docs.select(
        F.struct(*[docs[c] for c in keep]).alias("row"),
        docs[lang].cast("string").alias("lang"),
        docs[source].cast("string").alias("source"),
        F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"),
    )
    split = f"filter(split(text, '[{BLANKS}]+'), w -> w <> '')".replace("\\", "\\\\")
    lines = f"filter(split(text, '\\n'), l -> l rlike '[^{BLANKS}]')".replace("\\", "\\\\")
    counts = (
        "named_struct('n_words', cast(size(w) as bigint),"
        " 'word_chars', cast(char_length(array_join(w, '')) as bigint),"
        f" 'n_repeat_words', {repeated_words('w')})"
    )
    of_lines = (
        "named_struct('n_lines', cast(size(l) as bigint),"
        " 'n_dup_lines', cast(size(l) - size(array_distinct(l)) as bigint))"
    )
    made = plain.select(
        "row",
        "lang",
        "source",
        F.expr(let(split, "w", counts)).alias("of_words"),
        F.expr(let(lines, "l", of_lines)).alias("of_lines"),
        F.length(F.regexp_replace("text", "[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
    )
    failed = f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MOST_REPEATED} * n_words"
    return made.select("row", "lang", "source", "of_words.*", "of_lines.*", "n_symbols").withColumn(
        "base_failed", F.expr(failed)
    )


def sketches(table: DataFrame) -> DataFrame:
    """(lang, source, measure, value, rows): the sketches of documents that pass the base rules."""
    values = ", ".join(
        f"named_struct('measure', '{m}', 'value', {e})" for m, (e, _, _) in MEASURES.items()
    )
    return (
        table.where("not base_failed")
        .select("lang", "source", F.inline(F.expr(f"array({values})")))
        .groupBy("lang", "source", "measure", "value")
        .agg(F.count("*").alias("rows"))
    )


def merge(sketch: DataFrame, *by: str) -> DataFrame:
    return sketch.groupBy(*by, "measure", "value").agg(F.sum("rows").alias("rows"))


def quartiles(sketch: DataFrame, *by: str) -> DataFrame:
    """(by, measure, rows, q1, q3) of each sketch; a sketch is a bounded number of values."""
    of = Window.partitionBy(*by, "measure")
    upto = F.sum("rows").over(of.orderBy("value"))
    return (
        sketch.withColumn("upto", upto)
        .withColumn("all", F.sum("rows").over(of))
        .groupBy(*by, "measure")
        .agg(
            F.max("all").alias("rows"),
            F.min(F.when(F.col("upto") * 4 >= F.col("all"), F.col("value"))).alias("q1"),
            F.min(F.when(F.col("upto") * 4 >= F.col("all") * 3, F.col("value"))).alias("q3"),
        )
    )


def limits(groups: DataFrame, sketch: DataFrame, min_rows: int) -> DataFrame:
    """(lang, source, <measure>_low, <measure>_high) of each group of documents."""
    levels = [
        ("of_group", ["lang", "source"]),
        ("of_lang", ["lang"]),
        ("of_all", []),
    ]
    names = F.array(*[F.lit(m) for m in MEASURES])
    out = groups.select("lang", "source", F.explode(names).alias("measure"))
    for level, by in levels:
        part = quartiles(sketch if level == "of_group" else merge(sketch, *by), *by).select(
            *[F.col(b).alias(f"{level}_{b}") for b in by],
            F.col("measure").alias(f"{level}_measure"),
            F.struct("rows", "q1", "q3").alias(level),
        )
        same = F.col("measure") == F.col(f"{level}_measure")
        for b in by:
            same = same & F.col(b).eqNullSafe(F.col(f"{level}_{b}"))
        out = out.join(part, same, "left")
    enough = [F.when(F.col(f"{level}.rows") >= min_rows, F.col(level)) for level, _ in levels[:2]]
    out = out.select("lang", "source", "measure", F.coalesce(*enough, F.col("of_all")).alias("q"))
    wide = []
    for measure, (_, least, below) in MEASURES.items():
        mine = F.col("measure") == measure
        step = F.expr(f"shiftleft(1L, {step_bits('q.q3')})")
        spread = F.greatest(F.col("q.q3") - F.col("q.q1"), F.lit(least), step)
        wide.append(F.max(F.when(mine, F.col("q.q3") + FENCE * spread)).alias(f"{measure}_high"))
        if below:
            wide.append(F.max(F.when(mine, F.col("q.q1") - FENCE * spread)).alias(f"{measure}_low"))
    return out.groupBy("lang", "source").agg(*wide)


def verdict() -> Column:
    inside = []
    for measure, (value, _, below) in MEASURES.items():
        inside.append(f"{value} <= {measure}_high")
        if below:
            inside.append(f"{value} >= {measure}_low")
    return F.expr(f"not base_failed and coalesce({' and '.join(inside)}, true)")


def judge(
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    keep: list[str] | None = None,
    min_rows: int = MIN_ROWS,
) -> DataFrame:
    """(row, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept)."""
    keep = list(docs.columns if keep is None else keep)
    table = stored(measured(docs, text=text, lang=lang, source=source, keep=keep))
    sketch = stored(sketches(table))
    groups = table.select("lang", "source").distinct()
    found = stored(limits(groups, sketch, min_rows)).withColumnsRenamed(
        {"lang": "of_lang", "source": "of_source"}
    )
    joined = table.join(
        broadcast_if_small(found, GROUP_ROWS),
        table["lang"].eqNullSafe(F.col("of_lang")) & table["source"].eqNullSafe(F.col("of_source")),
    )
    return joined.select(
        "row",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        verdict().alias("kept"),
    )
