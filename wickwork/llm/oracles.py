"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from .adaptive_rules import FENCE, MIN_ROWS
from .hilbert import BITS, LEVELS, OVERHEAD, SHARDS
from .mixing import MOST_EPOCHS, SEED, WEIGHTS

SQL: dict[str, str] = {}

BLANK = "[\\x20\\x09-\\x0D]"
WORD = "[^\\x20\\x09-\\x0D]+"

SQL["op5_mixing"] = f"""
WITH sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
         md5(concat('{SEED}:', coalesce(doc_id::VARCHAR, ''))) AS k
  FROM documents),
sizes AS (
  SELECT source, sum(size)::HUGEINT AS s,
         {list(WEIGHTS)}[1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)})::INT]
           ::HUGEINT AS w
  FROM sized GROUP BY source),
ordered AS (
  SELECT *, sum(s) OVER () AS total, sum(w) OVER () AS weights,
         coalesce(sum({MOST_EPOCHS} * s) OVER before, 0) AS capped,
         coalesce(sum(w) OVER before, 0) AS used
  FROM sizes
  WINDOW before AS (ORDER BY s / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
-- The first source, by size for its weight, that the share of the rest does not fill.
level AS (
  SELECT total - capped AS left_over, weights - used AS share FROM ordered
  WHERE {MOST_EPOCHS} * s * (weights - used) >= w * (total - capped)
  ORDER BY s / w, source NULLS LAST LIMIT 1),
targets AS (
  SELECT source, s, CASE WHEN {MOST_EPOCHS} * s * share < w * left_over THEN ({MOST_EPOCHS} * s)::DOUBLE
                         ELSE (w * left_over)::DOUBLE / share::DOUBLE END AS target
  FROM sizes, level),
placed AS (
  SELECT doc_id, size, s, target,
         CASE WHEN s > 0 THEN round(target)::BIGINT // s::BIGINT ELSE 0 END AS passes,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id NULLS LAST, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, s::BIGINT AS source_size, target,
       (passes * size + greatest(0, least(size, round(target)::BIGINT - passes * s::BIGINT - ahead)))::BIGINT
         AS taken
FROM placed
"""

_LETTERS = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), " \
    "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

SQL["op7_winnowing"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_LETTERS}, []) AS w FROM documents),
b AS (SELECT item_id, {_LETTERS} AS w FROM benchmark WHERE text IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size,
         array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') AS words
  FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 8))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
hits AS (
  SELECT r, place, p.size, item_id
  FROM (SELECT r, size, place, array_to_string(list_slice(w, place, place + size - 1), ' ') AS words
        FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS place FROM d, sizes WHERE len(w) >= size)) p
  JOIN windows USING (size, words)),
covered AS (
  SELECT r, count(DISTINCT word) AS n
  FROM (SELECT r, unnest(range(place, place + size)) AS word FROM (SELECT DISTINCT r, place, size FROM hits)) GROUP BY r),
found AS (
  SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(c.n, 0)::BIGINT AS n_hit,
       coalesce(f.n, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(c.n, 0) > 0 AS contaminated
FROM d LEFT JOIN covered c USING (r) LEFT JOIN found f USING (r)
"""


def _hilbert() -> str:
    """The curve's steps one by one, each a query over the one before."""
    names = ["x0", "x1", "x2", "x3"]
    inner = "SELECT * FROM leveled"
    for bit in range(BITS - 1, 0, -1):
        q, p = 1 << bit, (1 << bit) - 1
        for i, name in enumerate(names):
            new = []
            for j, other in enumerate(names):
                if j == 0:
                    new.append(f"CASE WHEN {name} & {q} <> 0 THEN xor(x0, {p}) ELSE xor(x0, xor(x0, {name}) & {p}) END AS x0")
                elif j == i:
                    new.append(f"CASE WHEN {name} & {q} <> 0 THEN {name} ELSE xor({name}, xor(x0, {name}) & {p}) END AS {name}")
                else:
                    new.append(other)
            inner = f"SELECT r, doc_id, size, crc, {', '.join(new)} FROM ({inner})"
    inner = f"SELECT r, doc_id, size, crc, x0, xor(x0, x1) AS x1, xor(xor(x0, x1), x2) AS x2, xor(xor(xor(x0, x1), x2), x3) AS x3 FROM ({inner})"
    turn = "0"
    for bit in range(BITS - 1, 0, -1):
        turn = f"xor({turn}, CASE WHEN x3 & {1 << bit} <> 0 THEN {(1 << bit) - 1} ELSE 0 END)"
    inner = f"SELECT *, {turn} AS t FROM ({inner})"
    index = "0::BIGINT"
    for bit in range(BITS - 1, -1, -1):
        for name in names:
            index = f"({index} * 2 + ((xor({name}, t) >> {bit}) & 1))"
    return f"SELECT r, doc_id, size, crc, {index} AS hilbert FROM ({inner})"


SQL["op4_hilbert"] = f"""
WITH polynomial AS (  -- the table of the reflected polynomial EDB88320
  SELECT list(c ORDER BY n) AS crcs FROM (
    WITH RECURSIVE t(n, k, c) AS (
      SELECT n, 0, n::UBIGINT FROM range(256) v(n)
      UNION ALL
      SELECT n, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END
      FROM t WHERE k < 8)
    SELECT n, c FROM t WHERE k = 8)),
plain AS (
  SELECT row_number() OVER () AS r, doc_id, source, lang,
         coalesce(octet_length(encode(text)), 0)::BIGINT AS bytes, coalesce(hex(encode(text)), '') AS h
  FROM documents),
summed AS (
  SELECT r, doc_id, source, lang, bytes + {OVERHEAD} AS size,
         xor(list_reduce(
           list_transform(range(bytes), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::UBIGINT),
           lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255)::INT + 1]), 4294967295::UBIGINT),
           4294967295::UBIGINT)::BIGINT AS crc
  FROM plain, polynomial),
by_source AS (
  SELECT source, (coalesce(sum(n) OVER (ORDER BY source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                  * {LEVELS} // sum(n) OVER ())::INT AS level
  FROM (SELECT source, count(*) AS n FROM documents GROUP BY source)),
by_lang AS (
  SELECT lang, (coalesce(sum(n) OVER (ORDER BY lang NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                * {LEVELS} // sum(n) OVER ())::INT AS level
  FROM (SELECT lang, count(*) AS n FROM documents GROUP BY lang)),
leveled AS (
  SELECT r, doc_id, size, crc, s.level AS x0, l.level AS x1,
         least(len(bin(size)), {LEVELS - 1})::INT AS x2,
         coalesce(((doc_id - low)::HUGEINT * {LEVELS} // (high - low + 1))::INT, {LEVELS - 1}) AS x3
  FROM summed d, (SELECT min(doc_id)::HUGEINT AS low, max(doc_id)::HUGEINT AS high FROM documents)
  JOIN by_source s ON d.source IS NOT DISTINCT FROM s.source
  JOIN by_lang l ON d.lang IS NOT DISTINCT FROM l.lang),
placed AS (
  SELECT doc_id, size, crc, count(*) OVER () AS n,
         row_number() OVER (ORDER BY hilbert, crc, doc_id NULLS LAST, size) - 1 AS pos
  FROM ({_hilbert()})),
cut AS (SELECT *, n // {SHARDS} AS small, n % {SHARDS} AS longer, (n % {SHARDS}) * (n // {SHARDS} + 1) AS edge FROM placed)
SELECT doc_id, size, crc AS text_crc32, 'rows' AS law,
       (CASE WHEN pos < edge THEN pos // (small + 1) ELSE longer + (pos - edge) // greatest(small, 1) END)::INT AS shard,
       (CASE WHEN pos < edge THEN pos % (small + 1) ELSE (pos - edge) % greatest(small, 1) END)::BIGINT AS slot,
       NULL::INT AS grown_shard
FROM cut
"""


#: Tenths of a character per word; from 2,048 on only the first eleven bits count.
_LENGTH = "(word_chars * 10 // greatest(n_words, 1))"
_FIRST_BITS = f"((1::BIGINT) << greatest(len(bin({_LENGTH})) - 11, 0)::INT)"

#: op2's measures in SQL of its own: (expression, least spread, limited below too).
_MEASURES = {
    "symbols": ("n_symbols * 1000 // greatest(word_chars, 1)", 5, False),
    "repeats": ("n_repeat_words * 1000 // greatest(n_words, 1)", 20, False),
    "same_lines": ("n_dup_lines * 1000 // greatest(n_lines, 1)", 50, False),
    "word_length": (f"({_LENGTH} // {_FIRST_BITS} * {_FIRST_BITS})", 10, True),
}


def _measures() -> str:
    return ", ".join(f"{e} AS {m}" for m, (e, _, _) in _MEASURES.items())


def _limits() -> str:
    """Per measure: quartiles of the group, its language or all, and the limits from them."""
    out = []
    for m, (_, least, below) in _MEASURES.items():
        def quartile(q: int, m=m) -> str:
            level = "CASE WHEN g.n >= {0} THEN g.{1}_{2} WHEN l.n >= {0} THEN l.{1}_{2} ELSE a.{1}_{2} END"
            return level.format(MIN_ROWS, m, q)
        spread = f"greatest({quartile(3)} - {quartile(1)}, {least})"
        out.append(f"d.{m} <= {quartile(3)} + {FENCE} * {spread}")
        if below:
            out.append(f"d.{m} >= {quartile(1)} - {FENCE} * {spread}")
    return " AND ".join(out)


_QUARTILES = ", ".join(
    f"quantile_disc({m}, {q / 4}) AS {m}_{q}" for m in _MEASURES for q in (1, 3)
)

SQL["op2_adaptive_rules"] = f"""
WITH base AS (
  SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
split AS (
  SELECT *, regexp_extract_all(text, '{WORD}') AS w,
         list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM base),
grams AS (
  SELECT r, place, array_to_string(list_slice(w, place, place + 4), ' ') AS words
  FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS place FROM split WHERE len(w) >= 5)),
twice AS (SELECT r, words FROM grams GROUP BY r, words HAVING count(*) > 1),
repeats AS (
  SELECT r, count(DISTINCT word) AS n
  FROM (SELECT r, unnest(range(place, place + 5)) AS word FROM grams JOIN twice USING (r, words)) GROUP BY r),
counts AS (
  SELECT r, doc_id, lang, source, len(w)::BIGINT AS n_words,
         length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM split LEFT JOIN repeats USING (r)),
measured AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, {_measures()} FROM counts),
good AS (SELECT * FROM measured WHERE NOT base_failed),
g AS (SELECT lang, source, count(*) AS n, {_QUARTILES} FROM good GROUP BY lang, source),
l AS (SELECT lang, count(*) AS n, {_QUARTILES} FROM good GROUP BY lang),
a AS (SELECT {_QUARTILES} FROM good)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce({_limits()}, true) AS kept
FROM measured d CROSS JOIN a
LEFT JOIN g ON d.lang IS NOT DISTINCT FROM g.lang AND d.source IS NOT DISTINCT FROM g.source
LEFT JOIN l ON d.lang IS NOT DISTINCT FROM l.lang
"""


SQL["op8_jaccard_join"] = """
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\\x20\\x09-\\x0D]+'), []) AS w
  FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT r, array_to_string(list_slice(w, i, i + 4), ' ') AS g
  FROM (SELECT r, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT r, count(*) AS n FROM s GROUP BY r),
often AS (SELECT g FROM s GROUP BY g HAVING count(*) > 1),
links AS MATERIALIZED (
  SELECT a, b FROM (
    SELECT x.r AS a, y.r AS b, count(*) AS c
    FROM (SELECT * FROM s SEMI JOIN often USING (g)) x JOIN (SELECT * FROM s SEMI JOIN often USING (g)) y USING (g)
    WHERE x.r <> y.r GROUP BY x.r, y.r)
  JOIN n na ON na.r = a JOIN n nb ON nb.r = b WHERE 100 * c >= 75 * (na.n + nb.n - c)),
reach AS (
  SELECT a, b FROM links
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles,
       CASE WHEN m.least IS NULL THEN d.doc_id ELSE least(d.doc_id, m.least) END AS component_id
FROM d LEFT JOIN n USING (r)
LEFT JOIN (SELECT a AS r, min(doc_id) AS least FROM reach JOIN d ON d.r = reach.b GROUP BY a) m USING (r)
"""


SQL["op6_debruijn"] = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '{WORD}'), []) AS w FROM documents),
windows AS (
  SELECT r, doc_id, i, array_to_string(list_slice(w, i, i + 49), ' ') AS words
  FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
first AS (SELECT words, min(doc_id) AS least FROM windows GROUP BY words HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT r, unnest(range(i, i + 50)) AS i
  FROM windows JOIN first USING (words) WHERE least < doc_id),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY i) AS words, count(*) AS n
  FROM (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d) ANTI JOIN gone USING (r, i)
  GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(words, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""


def _escaped(column: str, more: str = "") -> str:
    """Characters of a content with a backslash before each backslash and each start of a mark."""
    return (
        f"(length({column}) + length({column}) - length(replace({column}, chr(92), ''))"
        f" + len(regexp_extract_all({column}, '</turn>'))"
        f" + coalesce(list_sum(list_transform(regexp_extract_all({column}, '#{{3,}}'), lambda h: length(h) - 2)), 0){more})"
    )


SQL["op12_chat_format"] = f"""
WITH said AS (SELECT chr(92) || '### Assistant: </turn> ok' AS text),
turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', text FROM said
  UNION ALL SELECT -7, 1, 'assistant', text FROM said)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, md5(text))) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, md5(text)) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(14 + {_escaped('role', " + length(role) - length(replace(role, ':', ''))")} + {_escaped('text')})::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""


def _crc_steps() -> list[int]:
    """The CRC-32 of each byte, by the reflected polynomial."""
    out = []
    for c in range(256):
        for _ in range(8):
            c = (c >> 1) ^ 0xEDB88320 if c & 1 else c >> 1
        out.append(c)
    return out


_CRC_STEPS = f"""steps AS MATERIALIZED (SELECT {_crc_steps()}::UBIGINT[] AS crcs)"""


def _crc32(text: str) -> str:
    """CRC-32 of a text's bytes, given `crcs` of `steps`."""
    return (
        f"xor(list_reduce(list_transform(range(strlen({text})), "
        f"lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::UBIGINT), "
        "lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255)::INT + 1]), 4294967295::UBIGINT), 4294967295::UBIGINT)"
    )


_FEATURES = """SELECT r, unnest(list_concat(w,
           list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
           list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS f"""

SQL["op13_resampling"] = f"""
WITH {_CRC_STEPS},
d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce({_LETTERS}, []) AS w FROM documents),
of_docs AS MATERIALIZED (SELECT r, f, count(*) AS n FROM ({_FEATURES} FROM d) GROUP BY r, f),
of_target AS (
  SELECT f, count(*) AS n
  FROM ({_FEATURES} FROM (SELECT row_number() OVER () AS r, coalesce({_LETTERS}, []) AS w FROM benchmark))
  GROUP BY f),
buckets AS MATERIALIZED (
  SELECT f, ({_crc32('f')} % 10000)::INT AS b
  FROM (SELECT DISTINCT f FROM (SELECT f FROM of_docs UNION ALL SELECT f FROM of_target)), steps),
counts AS (
  SELECT range AS b, coalesce(s, 0)::DOUBLE AS s, coalesce(t, 0)::DOUBLE AS t
  FROM range(10000)
  LEFT JOIN (SELECT b, sum(n) AS s FROM of_docs JOIN buckets USING (f) GROUP BY b) x ON x.b = range
  LEFT JOIN (SELECT b, sum(n) AS t FROM of_target JOIN buckets USING (f) GROUP BY b) y ON y.b = range),
gains AS (
  SELECT b, floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000))))::BIGINT AS gain
  FROM counts),
weights AS (SELECT r, sum(n * gain)::BIGINT AS weight FROM of_docs JOIN buckets USING (f) JOIN gains USING (b) GROUP BY r),
scored AS (
  SELECT r, doc_id, len(w) AS n_words, greatest(3 * len(w) - 3, 2 * len(w) - 1, 0)::BIGINT AS n_features,
         coalesce(weight, 0) AS weight,
         ('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
  FROM d LEFT JOIN weights USING (r)),
noised AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM scored),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST, weight) AS place,
         5 * count(*) FILTER (n_words >= 20) OVER () // 100 AS draws
  FROM noised)
SELECT doc_id, if(n_words = 0, 0, n_features) AS n_features, weight, score,
       CASE WHEN n_words >= 20 AND place <= draws THEN place END AS rank
FROM ranked
"""


def _least(options: list[str]) -> str:
    """Of structs (cost, audit, rows) the cheapest, then that of the least audit; nulls don't count."""
    out = options[0]
    for o in options[1:]:
        out = (
            f"CASE WHEN ({out}) IS NULL THEN {o} WHEN ({o}) IS NULL THEN ({out}) "
            f"WHEN ({o}).c < ({out}).c OR (({o}).c = ({out}).c AND ({o}).a < ({out}).a) THEN {o} ELSE ({out}) END"
        )
    return out


def _then(state: str, cost: str, letter: str, row: str | None) -> str:
    """A struct after one more edit, which may put out a row."""
    rows = f"{state}.o" if row is None else f"list_append({state}.o, {row})"
    return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'o': {rows}}} END"


def _repair_sql() -> str:
    """One row after another: the cheapest way to each of the four states of (s?(ua)+)?."""
    role, nxt = ["user", "user", "assistant", "user"], [2, 2, 3, 2]
    own = "(p.role || ':' || p.text)"
    free = "p.fault NOT IN (1, 2)"
    ways: list[list[str]] = [[], [], [], []]
    for q in range(4):
        ways[q].append(_then(f"s{q}", "3", "D", None))
        changed = _then(f"s{q}", "2 + (p.fault = 3)::INT", "R", f"('{role[q]}:' || p.text)")
        ways[nxt[q]].append(f"CASE WHEN {free} THEN {changed} END")
        kept = _then(f"s{q}", "(p.fault = 3)::INT", "K", own)
        ways[nxt[q]].append(f"CASE WHEN {free} AND p.role[1] = '{role[q][0]}' THEN {kept} END")
    ways[1].append(f"CASE WHEN {free} AND p.role[1] = 's' THEN {_then('s0', '(p.fault = 3)::INT', 'K', own)} END")
    kind = "STRUCT(c INTEGER, a VARCHAR, o VARCHAR[])"

    def step(names: list[str], table: str) -> str:
        """Pairwise least, so that expressions stay short."""
        return f"SELECT *, {', '.join(names)} FROM ({table})"

    sql = "SELECT r.conv, r.i + 1 AS i, p.role, p.text, p.fault, " + ", ".join(
        f"({w})::{kind} AS w{q}_{k}" for q in range(4) for k, w in enumerate(ways[q])
    ) + " FROM r JOIN p ON p.conv IS NOT DISTINCT FROM r.conv AND p.i = r.i + 1"
    left = {q: [f"w{q}_{k}" for k in range(len(ways[q]))] for q in range(4)}
    turn = 0
    while any(len(v) > 1 for v in left.values()):
        made = []
        for q, v in left.items():
            if len(v) > 1:
                made.append(f"{_least(v[:2])} AS m{q}_{turn}")
                left[q] = [f"m{q}_{turn}", *v[2:]]
        sql, turn = step(made, sql), turn + 1

    def put(target: int, source: str, name: str, before: str) -> None:
        nonlocal sql
        more = _then(source, "2", "I", f"'{role[int(name[1])]}:'")
        sql = step([f"({more})::{kind} AS x{name}"], sql)
        sql = step([f"{_least([before, 'x' + name])} AS y{name}"], sql)

    put(2, left[0][0], "i0", left[2][0])
    put(2, left[1][0], "i1", "yi0")
    put(2, left[3][0], "i3", "yi1")
    sql = step([f"({_then('yi3', '2', 'I', chr(39) + 'assistant:' + chr(39))})::{kind} AS xi2"], sql)
    sql = step([f"{_least([left[3][0], 'xi2'])} AS yi2"], sql)
    return f"SELECT conv, i, {left[0][0]}, {left[1][0]}, yi3, yi2 FROM ({sql})"


SQL["op11_structure_repair"] = f"""
WITH RECURSIVE {_CRC_STEPS},
original AS (
  SELECT *, {_crc32('k')} % 20 AS fault FROM (
    SELECT conv_id AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations), steps),
after AS (
  SELECT conv, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) FROM original)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, sha256(text)) AS i,
         right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last FROM after),
p AS MATERIALIZED (
  SELECT conv, i, turn, role, text,
         CASE WHEN last = '' THEN 1
              WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 THEN 2
              WHEN last NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
         lag(role[1]) OVER (PARTITION BY conv ORDER BY i) || role[1] AS pair,
         i > 1 AND coalesce(pair NOT IN ('su', 'ua', 'au'), true) AS illegal
  FROM placed),
r(conv, i, s0, s1, s2, s3) AS (
  SELECT conv, 0::BIGINT, {{'c': 0, 'a': '', 'o': []::VARCHAR[]}}, NULL::STRUCT(c INTEGER, a VARCHAR, o VARCHAR[]),
         {{'c': 2, 'a': 'I', 'o': ['user:']}}, {{'c': 4, 'a': 'II', 'o': ['user:', 'assistant:']}}
  FROM (SELECT DISTINCT conv FROM p)
  UNION ALL
  {_repair_sql()}),
numbers AS (
  SELECT conv, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
         count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (illegal) AS illegal
  FROM p GROUP BY conv),
ended AS (
  SELECT conv, i, {_least(['s0', 's3'])} AS s FROM r)
SELECT o.conv AS conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(s.c, 0)::BIGINT AS cost, coalesce(s.a, '') AS audit,
       sha256(coalesce(array_to_string(s.o, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id AS conv FROM conversations) o
LEFT JOIN numbers n ON o.conv IS NOT DISTINCT FROM n.conv
LEFT JOIN ended e ON e.conv IS NOT DISTINCT FROM n.conv AND e.i = n.n
"""
