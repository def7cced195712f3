"""Personal data: exact patterns, and spans that weak labelers propose and agree on.

Four kinds have fixed patterns: email, ip, card and phone. For everything else labelers propose
spans of their own (`PROPOSERS`): long runs with digits, grouped numbers, bank accounts, IPv6
addresses, values after words for secrets, base64, persons after titles, streets. Over the union
of all proposals labelers vote: the proposers of a span, regular expressions on it, gazetteers of
words in front of it, and its context. A label model is fit by expectation-maximisation
(Dawid and Skene 1979, votes given the class independent): how often each labeler is right is
estimated from agreement alone, over all candidates of the corpus. The candidates' posterior
labels then train the span classifier, a naive Bayes model over the shape and the surroundings
of a span; votes and classifier decide together. Accepted spans that overlap become one, of the kind of the
first. Proposals inside a fixed span are left to it; others may reach over one (a card number in
a token), and masking covers both.

Everything that touches documents is SQL functions. Vote patterns (a labeler says one of three
things, most of them one of two; what a text holds does not add to their number) and feature
counts (a fixed set of features) are all that reaches the driver.

Patterns are written so that they take linear time: a run is only tried from its start, repeats
are bounded or possessive, and separators inside numbers and domains are marked first.

Defined results: null and empty texts have no spans; texts of any length are searched whole, in
one row; repeated rows get the same spans; spans that tie on a place are one span with all their
proposers; an empty table gives no rows; extra columns of any name travel inside `row` and meet
none of the operator's own; positions count code points.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .adaptive_rules import let
from .common import written

KINDS = ("email", "ip", "card", "phone", "secret", "number", "line", "account", "ipv6", "name", "street")

#: Marks, each one code point, so positions hold: M1 stands for a separator inside a number,
#: M2 for a dot inside a domain, M0 for either sign where the text itself has it.
M0, M1, M2 = "\u0002", "\u0001", "\u0003"
LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": (
        f"(?:\\G|(?<![{M2}{LOCAL}]))[{M2}{LOCAL}]++@[A-Za-z0-9-]++{M2}[A-Za-z0-9-][{M2}A-Za-z0-9-]*+"
    ),
    "ip": "(?<![0-9])[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++",
    "card": f"[0-9][0-9{M1}]++",
    "phone": "\\+[0-9][\\x20().0-9-]+[0-9]",
}
CONTEXT = 32

# Words that stand in front of private values, and in front of harmless numbers.
PRIVATE_WORDS = (
    "token|secret|key|password|passwd|pwd|auth|bearer|api|credential|phone|tel|mobile|call|fax"
    "|card|visa|account|iban|ssn|passport|licence no"
)
HARMLESS_WORDS = "version|license|chapter|page|figure|volume|isbn|doi|http|section|article|year"

SECRET_WORDS = "password|passwd|passcode|pwd|secret|token|api[_-]?key|bearer|credential|iban|ssn"
TITLES = "Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sra?"
STREETS = "Street|St|Avenue|Ave|Road|Rd|Lane|Drive|Boulevard|Blvd|Square|Court"

#: What each proposer looks for: a text that may hold it, its pattern, what of a match is the
#: span (a pattern; None: all of it), and a condition on the span v.
PROPOSERS = {
    "run": (
        "numbers",
        "\\([0-9]{3}\\)\\x20?[0-9]{3}[\\x20.-][0-9]{4}(?![0-9])"
        "|(?<![0-9A-Za-z_-])(?=[A-Za-z_-]*+[0-9])[0-9A-Za-z_-]{9,}+",
        None,
        "true",
    ),
    "groups": (
        "numbers",
        "(?<![0-9A-Za-z.,+-])(?:\\([0-9]{2,4}\\)\\x20?|[0-9]{2,4}[\\x20.-])[0-9]{2,4}"
        "(?:[\\x20.-][0-9]{2,4}){1,3}+(?![0-9A-Za-z])",
        None,
        "length(regexp_replace(v, '[^0-9]', '')) between 9 and 15 and not v rlike '^(19|20)[0-9]{2}[ .-][0-9]{2}[ .-]'",
    ),
    "account": (
        "numbers",
        "(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\\x20?[0-9A-Z]{4}){2,7}+(?:\\x20?[0-9A-Z]{1,3}(?![0-9A-Za-z]))?",
        None,
        "true",
    ),
    "ipv6": (
        "numbers and instr(text, ':') > 0",
        "(?<![0-9A-Za-z:.])[0-9A-Fa-f]{1,4}(?:::?[0-9A-Fa-f]{1,4}){2,7}+(?![0-9A-Za-z:])",
        None,
        "not v rlike '^[0-9]{1,4}(:[0-9]{1,2}){2}$'",
    ),
    "value": (
        "sets",
        f"(?<![A-Za-z])(?i:{SECRET_WORDS})[\"']?\\x20{{0,3}}[=:]\\x20{{0,3}}[\"']?[^\\s\"',;]{{6,}}+",
        "[^\\s\"',;=:][^\\s\"',;]*+$",
        "length(v) >= 6",
    ),
    "base64": (
        "numbers",
        "(?<![0-9A-Za-z_+/-])(?=[A-Za-z+/]*+[0-9])(?=[0-9A-Za-z]*+[+/=])[0-9A-Za-z+/]{10,}+={0,2}+",
        None,
        "v rlike '[A-Z]' and v rlike '[a-z]' and not v rlike '(^|/)[a-z]{3,}/|^/'",
    ),
    "person": (
        "true",
        f"(?<![A-Za-z])(?:{TITLES})\\.?\\x20[A-Z][a-z]{{1,30}}+(?:\\x20[A-Z][a-z]{{1,30}}+)?",
        "[A-Z][a-z]++(?:\\x20[A-Z][a-z]++)?$",
        "true",
    ),
    "street": (
        "numbers",
        f"(?<![0-9A-Za-z])[0-9]{{1,5}}\\x20(?:[A-Z][a-z]{{1,30}}\\x20){{1,3}}(?:{STREETS})(?![A-Za-z])",
        None,
        "true",
    ),
}
BITS = {name: 1 << k for k, name in enumerate(PROPOSERS)}
#: Long runs are proposed whatever they are, so proposing them is no vote.
VOTING = [name for name in PROPOSERS if name != "run"]
CANDIDATE_TYPE = "array<struct<start:int,end:int,less:int,v:string,l:string,bit:int>>"


def proposed_by(*names: str) -> str:
    return f"(c.by & {sum(BITS[n] for n in names)}) > 0"


#: Labelers over v (the span), l (what stands in front, lower-case) and by (the proposers' bits):
#: 1, -1, or 0 to abstain.
LABELERS = [
    "if(c.v rlike '^[0-9a-fA-F]{24,}$|[0-9A-Za-z]={1,2}$', 1, 0)",
    "case when length(c.v) >= 16 and c.v rlike '[A-Za-z]' and c.v rlike '[0-9].*[0-9].*[0-9]' then 1"
    f" when length(c.v) < 16 and c.v rlike '[A-Za-z]{{6}}' and not {proposed_by('value', 'person', 'street')}"
    " then -1 else 0 end",
    f"if(c.l rlike '({PRIVATE_WORDS})[^a-z]*$', 1, 0)",
    "if(c.l rlike '[=:][\\\\s\"\\']*$', 1, 0)",
    "case when c.v rlike '^[0-9]{12,19}$|^\\\\(|^[0-9]{3}-[0-9]{2}-[0-9]{4}$|^[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}$' then 1"
    " when c.v rlike '^[0-9]{4}[ .-][0-9]{2}[ .-][0-9]{2}|^[0-9]{1,3}([. ][0-9]{3})+$' then -1 else 0 end",
    f"if(c.l rlike '({HARMLESS_WORDS})[^a-z]*$', -1, 0)",
    f"if(length(c.v) < 12 and not c.v rlike '[^0-9A-Za-z_-]' and not {proposed_by('value', 'person')}, -1, 0)",
    f"case when not {proposed_by('value')} then 0 when c.v rlike '^[A-Z]?[a-z]+[.!?]?$' then -1"
    " when c.v rlike '[0-9].*[0-9]|[a-z].*[A-Z]' then 1 else 0 end",
    f"if({proposed_by('account', 'ipv6')} and not c.v rlike '[a-z]{{5}}', 1, 0)",
    *[f"if({proposed_by(name)}, 1, 0)" for name in VOTING],
]
#: Features of the span classifier, each with few values: name=value.
FEATURES = [
    "concat('length=', least(length(c.v) div 8, 8))",
    "concat('digits=', length(regexp_replace(c.v, '[^0-9]', '')) * 4 div length(c.v))",
    "concat('case=', if(c.v rlike '[a-z]', 'l', ''), if(c.v rlike '[A-Z]', 'u', ''))",
    "concat('front=', case when c.l rlike '[a-z]\\\\s*$' then 'word' when c.l rlike '[0-9]\\\\s*$' then 'digit'"
    " when c.l rlike '[=:][\\\\s\"\\']*$' then 'set' when c.l = '' then 'none' else 'sign' end)",
    f"concat('near=', if(c.l rlike '({PRIVATE_WORDS})[^a-z]*$', 'private',"
    f" if(c.l rlike '({HARMLESS_WORDS})[^a-z]*$', 'harmless', '')))",
    "concat('signs=', if(c.v like '%-%', '-', ''), if(c.v like '%\\\\_%', '_', ''), if(c.v like '(%', '(', ''))",
    "concat('by=', c.by)",
]
MOST_ROUNDS = 50


def sql_string(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def matches(text: str, pattern: str, body: str) -> str:
    """SQL: array of body over m (a match), start, end and front (the text since the last one)."""
    p = sql_string(pattern)
    step = (
        "(a, i) -> named_struct("
        "'at', a.at + char_length(p[i]) + char_length(f[i]),"
        " 'out', concat(a.out, array(named_struct('m', f[i], 'start', a.at + char_length(p[i]),"
        f" 'end', a.at + char_length(p[i]) + char_length(f[i]), 'front', right(p[i], {CONTEXT})))))"
    )
    empty = "cast(array() as array<struct<m:string,start:int,end:int,front:string>>)"
    places = (
        f"aggregate(sequence(0, size(f) - 1), named_struct('at', 0, 'out', {empty}), {step}, a -> a.out)"
    )
    pieces = let(f"split({text}, {p}, -1)", "p", places)
    found = f"if(size(f) = 0, {empty}, {pieces})"
    return f"transform({let(f'regexp_extract_all({text}, {p}, 0)', 'f', found)}, x -> {body})"


def digits(value: str) -> str:
    return f"regexp_replace({value}, '[^0-9]', '')"


def luhn(number: str) -> str:
    """SQL: true if the digits of a number pass the check sum."""
    places = f"sequence(0, length({number}) - 1)"
    value = f"cast(substr({number}, length({number}) - i, 1) as int)"
    doubled = f"{value} * 2 - if({value} > 4, 9, 0)"
    return f"(aggregate({places}, 0, (s, i) -> s + if(i % 2 = 0, {value}, {doubled})) % 10 = 0)"


def spans(kind: str, text: str, needs: str, valid: str) -> str:
    """SQL: array of (start, no, end) of one kind; texts that lack `needs` are not searched."""
    number = KINDS.index(kind)
    body = f"named_struct('start', x.start, 'no', {number}, 'end', x.end, 'ok', {valid})"
    found = f"filter({matches(text, PATTERNS[kind], body)}, x -> x.ok)"
    plain = f"transform({found}, x -> named_struct('start', x.start, 'no', x.no, 'end', x.end))"
    return f"if({needs}, {plain}, cast(array() as array<struct<start:int,no:int,end:int>>))"


def proposals() -> str:
    """SQL: the union of all proposers' spans of a text, equal ones once, with their bits."""
    every = []
    for name, (needs, pattern, inner, valid) in PROPOSERS.items():
        v = "x.m" if inner is None else f"regexp_extract(x.m, {sql_string(inner)}, 0)"
        front = "x.front" if inner is None else f"concat(x.front, left(x.m, char_length(x.m) - char_length({v})))"
        body = let(
            v,
            "v",
            f"named_struct('start', x.end - char_length(v), 'end', x.end, 'less', -least(char_length({front}), {CONTEXT}),"
            f" 'v', v, 'l', lower(right({front}, {CONTEXT})), 'bit', if({valid}, {BITS[name]}, 0))",
        )
        found = f"filter({matches('text', pattern, body)}, x -> x.bit > 0)"
        every.append(f"if({needs}, {found}, cast(array() as {CANDIDATE_TYPE}))")
    # Sorted, proposals of one span are neighbours, the one that sees most of the front first.
    same = "coalesce(get(s, i + {0}).start = x.start and get(s, i + {0}).end = x.end, false)".format
    bits = " + ".join(f"if({same(k)}, get(s, i + {k}).bit, 0)" for k in range(len(PROPOSERS)))
    joined = (
        "named_struct('v', x.v, 'l', x.l, 'start', x.start, 'end', x.end,"
        f" 'by', {bits}, 'first', not {same(-1)})"
    )
    return let(
        f"sort_array(concat({', '.join(every)}))",
        "s",
        f"filter(transform(s, (x, i) -> {joined}), x -> x.first)",
    )


def located(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """(row, base, candidates) of each document."""
    plain = docs.select(
        F.struct(*[docs[c] for c in keep]).alias("row"),
        F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"),
    ).select(
        "*",
        F.expr("text rlike '[0-9]'").alias("numbers"),
        F.expr("instr(text, '@') > 0").alias("ats"),
        F.expr("text rlike '[=:]'").alias("sets"),
    )
    clear = f"translate(text, '{M1}{M2}', '{M0}{M0}')"
    marked = plain.select(
        "*",
        F.expr(
            f"if(numbers, regexp_replace({clear}, '(?<=[0-9])[ -](?=[0-9])', '{M1}'), '')"
        ).alias("for_cards"),
        F.expr(
            f"if(ats, regexp_replace({clear}, '(?<=[A-Za-z0-9-])[.](?=[A-Za-z0-9-])', '{M2}'), '')"
        ).alias("for_emails"),
    )
    parts = "forall(split(x.m, '[.]'), y -> length(ltrim('0', y)) <= 3 and cast(concat('0', right(y, 3)) as int) <= 255)"
    number = let(digits("x.m"), "d", f"length(d) between 12 and 19 and {luhn('d')}")
    base = [
        spans("email", "for_emails", "ats", "true"),
        spans("ip", "text", "numbers", parts),
        spans("card", "for_cards", "numbers", number),
        spans("phone", "text", "numbers and instr(text, '+') > 0", f"length({digits('x.m')}) between 9 and 15"),
    ]
    found = marked.select(
        "row",
        F.expr(f"sort_array(concat({', '.join(base)}))").alias("base"),
        F.expr(proposals()).alias("runs"),
    )
    votes = ", ".join(f"cast({v} as string)" for v in LABELERS)
    kind = (
        f"case when {proposed_by('person')} then 'name' when {proposed_by('street')} then 'street'"
        f" when {proposed_by('ipv6')} then 'ipv6' when {proposed_by('account')} then 'account'"
        f" when c.v like '(%' or {proposed_by('groups')} and not c.v rlike '^[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}$'"
        " then 'line' when c.v rlike '[A-Za-z]' then 'secret' else 'number' end"
    )
    judged = (
        f"transform(runs, c -> named_struct('start', c.start, 'end', c.end, 'kind', {kind},"
        f" 'votes', concat_ws(',', array({votes})), 'features', array({', '.join(FEATURES)})))"
    )
    apart = (
        f"filter({judged}, c -> not exists(base, b -> b.start <= c.start and c.end <= b.end))"
    )
    return written(found.select("row", "base", F.expr(apart).alias("candidates")), "spans")


# ---- the label model ---------------------------------------------------------------------


def fit_labelers(patterns: list[tuple[tuple[int, ...], int]]) -> tuple[float, list[dict], dict]:
    """Prior, per labeler p(vote | class), and p(class 1) per vote pattern, by EM.

    Starts from labelers that are right four times out of five; each estimate keeps ten
    votes of that belief, so a labeler that hardly votes stays near it.
    """
    prior, labelers = 0.5, len(patterns[0][0])
    belief = [{y: {v: 0.2 if v == 0 else (0.64 if (v > 0) == y else 0.16) for v in (-1, 0, 1)} for y in (0, 1)}
              for _ in range(labelers)]
    rates = belief
    posterior: dict[tuple[int, ...], float] = {}
    for _ in range(MOST_ROUNDS):
        before = dict(posterior)
        for votes, _n in patterns:
            one, zero = math.log(prior), math.log(1 - prior)
            for k, v in enumerate(votes):
                # Abstaining says nothing.
                if v:
                    one += math.log(rates[k][1][v] / (rates[k][1][1] + rates[k][1][-1]))
                    zero += math.log(rates[k][0][v] / (rates[k][0][1] + rates[k][0][-1]))
            posterior[votes] = 1 / (1 + math.exp(max(-500.0, min(500.0, zero - one))))
        total = sum(n for _, n in patterns)
        prior = (sum(n * posterior[v] for v, n in patterns) + 1) / (total + 2)
        rates = []
        for k in range(labelers):
            rates.append({})
            for y in (0, 1):
                counts = {v: 10 * belief[k][y][v] for v in (-1, 0, 1)}
                for votes, n in patterns:
                    counts[votes[k]] += n * (posterior[votes] if y else 1 - posterior[votes])
                whole = sum(counts.values())
                rates[k][y] = {v: c / whole for v, c in counts.items()}
        if before and max(abs(before[v] - posterior[v]) for v, _ in patterns) < 1e-6:
            break
    return prior, rates, posterior


def vote_odds(rates: list[dict]) -> dict[str, float]:
    """Log odds that a labeler's vote gives, as fit_labelers weighs it; abstaining gives none."""
    return {
        f"vote{k}={v}": math.log(rate[1][v] / (rate[1][1] + rate[1][-1]))
        - math.log(rate[0][v] / (rate[0][1] + rate[0][-1]))
        for k, rate in enumerate(rates)
        for v in (-1, 1)
    }


def fit_classifier(rows: list[tuple[str, str, int]], prior: float, posterior: dict) -> dict[str, float]:
    """Log odds per feature from counts (feature, vote pattern, spans), labelled by the posterior.

    One more span per feature, shared as the prior says, keeps rare values near the middle.
    """
    sums: dict[str, list[float]] = {}
    for feature, votes, n in rows:
        p = posterior[tuple(int(v) for v in votes.split(","))]
        mine = sums.setdefault(feature, [1 - prior, prior])
        mine[0] += n * (1 - p)
        mine[1] += n * p
    groups: dict[str, list[float]] = {}
    for feature, (zero, one) in sums.items():
        whole = groups.setdefault(feature.split("=")[0], [0.0, 0.0])
        whole[0] += zero
        whole[1] += one
    out = {}
    for feature, (zero, one) in sums.items():
        whole = groups[feature.split("=")[0]]
        out[feature] = math.log(one / whole[1]) - math.log(zero / whole[0])
    return out


def find_private(docs: DataFrame, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(row, base, added): spans as (start, no, end); `KINDS[no]` is the kind."""
    keep = list(docs.columns if keep is None else keep)
    table = located(docs, text, keep)
    each = table.select(F.explode("candidates").alias("c")).select("c.*")
    counts = each.groupBy("votes").agg(F.count("*").alias("n")).collect()
    patterns = [(tuple(int(v) for v in r.votes.split(",")), r.n) for r in sorted(counts)]
    weights, bias = {"": 0.0}, -1.0
    if patterns:
        prior, rates, posterior = fit_labelers(patterns)
        rows = (
            each.select(F.explode("features").alias("feature"), "votes")
            .groupBy("feature", "votes")
            .agg(F.count("*").alias("n"))
            .collect()
        )
        weights |= fit_classifier([tuple(r) for r in rows], prior, posterior) | vote_odds(rates)
        bias = math.log(prior / (1 - prior))
    known = "map(" + ", ".join(f"{sql_string(k)}, {v!r}D" for k, v in sorted(weights.items())) + ")"
    # Features see much the same, so their odds are averaged; votes add up.
    facts = (
        f"concat(transform(split(c.votes, ','), (v, k) -> coalesce({known}[concat('vote', k, '=', v)], 0D)),"
        f" transform(c.features, f -> coalesce({known}[f], 0D) / {len(FEATURES)}))"
    )
    score = f"aggregate({facts}, {bias!r}D, (s, x) -> s + x)"
    number = f"array_position(array({', '.join(sql_string(k) for k in KINDS)}), c.kind) - 1"
    chosen = (
        f"transform(filter(candidates, c -> {score} > 0),"
        f" c -> named_struct('start', c.start, 'no', cast({number} as int), 'end', c.end))"
    )
    # Candidates are sorted by start; those that overlap the last one lengthen it.
    last = "get(a, size(a) - 1)"
    longer = f"named_struct('start', {last}.start, 'no', {last}.no, 'end', greatest({last}.end, s.end))"
    added = (
        f"aggregate({chosen}, cast(array() as array<struct<start:int,no:int,end:int>>),"
        f" (a, s) -> if(size(a) > 0 and s.start < {last}.end,"
        f" concat(slice(a, 1, size(a) - 1), array({longer})),"
        " concat(a, array(s))))"
    )
    return table.select("row", "base", F.expr(added).alias("added"))


def summary(found: DataFrame, key: str) -> DataFrame:
    """One row per document: its key, counts of the fixed kinds, a digest of them, and all spans."""
    names = f"array({', '.join(sql_string(k) for k in KINDS)})"
    listed = f"array_join(transform({{0}}, s -> concat({names}[s.no], ':', s.start, ':', s.end)), ',')"
    counts = [
        F.expr(f"cast(size(filter(base, s -> s.no = {i})) as bigint)").alias(f"n_{kind}")
        for i, kind in enumerate(KINDS[:4])
    ]
    return found.select(
        F.col(f"row.{key}").alias(key),
        *counts,
        F.sha2(F.expr(listed.format("base")), 256).alias("base_sha256"),
        F.expr(listed.format("sort_array(concat(base, added))")).alias("spans"),
    )


def masked(found: DataFrame, text: str) -> DataFrame:
    """(row, masked): the text of `row` with every span replaced by its kind in brackets."""
    names = f"array({', '.join(sql_string(k.upper()) for k in KINDS)})"
    step = (
        "(a, s) -> if(s.start < a.at, named_struct('at', greatest(a.at, s.end), 'out', a.out),"
        " named_struct('at', s.end, 'out',"
        f" concat(a.out, substr(row.{text}, a.at + 1, s.start - a.at), '[', {names}[s.no], ']')))"
    )
    whole = (
        f"aggregate(sort_array(concat(base, added)), named_struct('at', 0, 'out', ''), {step},"
        f" a -> concat(a.out, substr(row.{text}, a.at + 1)))"
    )
    return found.select("row", F.expr(whole).alias("masked"))
