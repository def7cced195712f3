"""The operators' own interfaces: texts, files, groups, limits and small parameters."""

import itertools
import random
import sys
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).parent))

import tables  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from wickwork.llm import adaptive_rules, common, debruijn, hilbert, jaccard_join, mixing, neighbours, pii, ppm, toxicity, winnowing  # noqa: E402
from wickwork.llm import words as word_module  # noqa: E402
from wickwork.llm.common import components, ranked  # noqa: E402
from wickwork.llm.words import BLANK_WORDS, Words  # noqa: E402


@pytest.fixture(scope="module")
def odd(tmp_path_factory):
    return tables.odd_tables(tmp_path_factory.mktemp("odd"))


@pytest.fixture(scope="module")
def docs(spark, odd):
    return spark.read.parquet(f"{odd}/documents.parquet")


def test_ranks_and_prefix_sums_of_ties(spark):
    rng = random.Random(1)
    rows = [(rng.randint(0, 3), i % 50, rng.randint(0, 9)) for i in range(500)]
    df = spark.createDataFrame(rows, "a int, b int, n int")
    out = ranked(df, F.col("a"), F.col("b"), F.col("n"), measures={"n": F.col("n")}).collect()
    out.sort(key=lambda r: r["rank"])
    assert [r["rank"] for r in out] == list(range(500))
    assert [(r.a, r.b, r.n) for r in out] == sorted(rows)
    ahead = 0
    for r in out:
        assert r.n_before == ahead
        ahead += r.n


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (300, 299)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    found = {r.node: r.component for r in components(df).collect()}
    assert found == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 160)}, 300: 299}


def test_stars_of_their_smallest_node_need_no_round(spark, monkeypatch):
    tables_written, plain = [], common.stored
    monkeypatch.setattr(common, "stored", lambda df: tables_written.append(1) or plain(df))
    df = spark.createDataFrame([(100, i) for i in range(101, 160)] + [(8, 7), (5, 5)], "a bigint, b bigint")
    found = {r.node: r.component for r in components(df).collect()}
    assert found == {**{i: 100 for i in range(101, 160)}, 8: 7}
    assert len(tables_written) == 1


def test_a_row_leaves_a_hot_join_once(spark):
    rows = spark.createDataFrame([(i % 7 if i < 900 else 50 + i, i) for i in range(1000)], "key bigint, at bigint")
    table = rows.groupBy("key").agg(F.count("*").alias("n"), F.max("at").alias("last"))
    found = common.hot_join(rows, table.where("key <> 3"), "key", "n", 100_000)
    plain = rows.join(table.where("key <> 3"), "key")
    assert sorted(map(tuple, found.select(*plain.columns).collect())) == sorted(map(tuple, plain.collect()))
    # an outer join in front of both parts would put every row out twice
    assert "LeftOuter" not in found._jdf.queryExecution().toString()


def hidden(word, how, rng):
    leet = {"i": "1", "o": "0", "e": "3", "a": "4", "s": "$", "t": "7"}
    if how == "leet":
        return "".join(leet.get(c, c) if rng.random() < 0.6 else c for c in word)
    if how == "spaced":
        return " ".join(word)
    if how == "dotted":
        return ".".join(word)
    at = rng.randrange(len(word))
    return word[: at + 1] + word[at] * 4 + word[at + 1 :]


def test_hidden_words_are_restored_and_scored(spark):
    rng = random.Random(3)
    bad = ["villain", "rotten", "filthy", "nasty", "coward"]
    rows, labels = [], []
    for i in range(400):
        text, toxic = tables.words(rng, 60), i % 5 == 0
        if toxic:
            for _ in range(3):
                text.insert(rng.randrange(len(text)), rng.choice(bad))
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    ways = ["leet", "spaced", "dotted", "repeated"]
    for k in range(80):
        text = tables.words(rng, 60)
        for _ in range(3):
            text.insert(rng.randrange(len(text)), hidden(rng.choice(bad), ways[k % 4], rng))
        rows.append((1000 + k, " ".join(text)))
    for k in range(80):
        rows.append((2000 + k, " ".join(tables.words(rng, 60)) + " v2 3d 100% b2b a b c 24/7 :-) www.x1y2.org"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    teach = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    score = {r.doc_id: r.score for r in toxicity.score(docs, teach).select("row.doc_id", "score").collect()}
    assert np.mean([score[1000 + k] >= 0.7 for k in range(80)]) > 0.9
    assert np.mean([score[2000 + k] >= 0.7 for k in range(80)]) < 0.05
    out = {r.doc_id: r.restored for r in toxicity.restored(docs).select("row.doc_id", "restored").collect()}
    kept = sum(any(b in out[1000 + k] for b in bad) for k in range(80))
    assert kept > 70
    # Plain words stay as they are.
    assert all(set(t.split()) == set(out[i].split()) for i, t in rows[:50])


def channel_decoder():
    """A decoder over words of which some are bad ones."""
    text = "the stupid idiot said that stupid ass of a house feeds the good little bottle and looks well "
    rng = random.Random(4)
    texts = [text * 20, *[" ".join(tables.words(rng, 60)) for _ in range(50)]]
    counts = toxicity.gram_counts(pa.array(texts)).astype(float).reshape((toxicity.SYMBOLS,) * toxicity.ORDER)
    model = np.full(toxicity.SYMBOLS, 1.0 / toxicity.SYMBOLS)
    for order in range(1, toxicity.ORDER + 1):
        own = counts.sum(axis=tuple(range(toxicity.ORDER - order)))
        model = (own + 5 * model) / (own.sum(axis=-1, keepdims=True) + 5)
    return toxicity.Decoder(np.log(model).astype(np.float32).ravel())


@pytest.mark.parametrize(
    "form,word",
    [
        ("stuupid", "stupid"), ("iidiioot", "idiot"), ("st00pid", "stupid"), ("st*pid", "stupid"),
        ("$tup1d", "stupid"), ("s.t.u.p.i.d", "stupid"), ("@$$", "ass"), ("i  d  i  o  t", "idiot"),
        ("i\nd\ni\no\nt", "idiot"), ("st up id", "stupid"), ("id iot", "idiot"),
    ],
)
def test_channel_is_open(form, word):
    decoder = channel_decoder()
    assert decoder.restore(form) == word and word in decoder.words(form)


def test_channel_leaves_plain_text_alone():
    decoder = channel_decoder()
    for plain in ["the good little bottle", "feeds the house well", "2024 455 100", "the house of a bottle"]:
        assert decoder.restore(plain) == plain
    # A doubled letter that is one stays known beside its other reading.
    assert "quooz" in decoder.words("quooz")


def test_viterbi_is_the_best_of_all_paths():
    decoder, rng = channel_decoder(), random.Random(8)
    for _ in range(150):
        token = "".join(rng.choice("stupid0011@$!*oo") for _ in range(rng.randrange(1, 7)))
        lattice = [toxicity.readings(m.group()) for m in toxicity._RUNS.finditer(token)]
        best = -np.inf
        for path in itertools.product(*lattice):
            score, now = sum(cost for _, cost in path), 0
            for char in "".join(out for out, _ in path):
                k = toxicity.symbol(char)
                score += decoder.model[now * toxicity.SYMBOLS + k]
                now = (now * toxicity.SYMBOLS + k) % toxicity._CONTEXTS if k else 0
            best = max(best, score + decoder.model[now * toxicity.SYMBOLS])
        assert decoder.best(lattice)[0] == pytest.approx(best, abs=1e-4)


def test_limits_of_unspaced_script_are_not_clipped(spark):
    # Mean lengths of runs: 120 to 300 characters, some honest short ones, and real outliers.
    lengths = [120 + i % 180 for i in range(400)] + [60, 75, 96] + [40_000, 90_000]
    rows = [(i, "\n".join(chr(0x4E00 + (i + k) % 5000) * n for k in range(12)), "zh", "web") for i, n in enumerate(lengths)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    kept = {r.row.doc_id: r.kept for r in adaptive_rules.judge(docs, keep=["doc_id"]).collect()}
    assert all(kept[i] for i in range(403)) and not kept[403] and not kept[404]


def test_steps_of_long_words_grow_with_the_value(spark):
    value = adaptive_rules.stepped("v")
    rows = spark.createDataFrame([(v,) for v in (0, 1, 1000, 2047, 2048, 2049, 123_457, 2**40 + 5)], "v bigint")
    got = [tuple(r) for r in rows.selectExpr("v", value).collect()]
    assert all(v == s for v, s in got if v < 2048)
    assert all(0 <= v - s <= v / 1000 for v, s in got) and got[-1][1] == 2**40


def test_votes_are_exact_over_blocks():
    rng = np.random.default_rng(2)
    known = rng.standard_normal((3000, 8)).astype(np.float32)
    known /= np.linalg.norm(known, axis=1, keepdims=True)
    points, labels = known[:40] + 0.1, (rng.random(3000) < 0.4).astype(float)
    near = points @ known.T
    top = np.argsort(-near, axis=1)[:, : neighbours.NEIGHBOURS]
    weight = np.maximum(np.take_along_axis(near, top, 1).astype(float), 0) ** neighbours.SHARPNESS
    share = (weight * labels[top]).sum(1) / weight.sum(1)
    trust = weight.sum(1) / (weight.sum(1) + 0.5)
    assert neighbours.vote(points, known, labels) == pytest.approx(
        trust * share + (1 - trust) * neighbours.PRIOR, rel=1e-4
    )


def test_junk_is_told_from_prose_on_held_out_rows(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(300):
        text, good = tables.words(rng, 50), i % 4 > 0
        if not good:
            text = [w + "###" for w in text] if i % 8 else [w for w in text[:4] for _ in range(12)]
        rows.append((i, " ".join(text)))
        labels.append((i, int(good)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    teach = spark.createDataFrame([x for x in labels if x[0] < 200], "doc_id bigint, quality int")
    found = neighbours.score(docs, teach).select("row.doc_id", "score").collect()
    right = [(r.score >= 0.3) == bool(labels[r.doc_id][1]) for r in found if r.doc_id >= 200]
    assert np.mean(right) > 0.97


def test_wording_of_the_same_shape_tells_quality(spark):
    """Words of five small letters each, with the same repetition: only the wording differs."""
    rng = random.Random(9)
    vocabulary = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=5)) for _ in range(400)]
    rows = [(i, " ".join(rng.sample(vocabulary[:200] if i % 2 else vocabulary[200:], 40))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    teach = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id bigint, quality int")
    found = neighbours.score(docs, teach).select("row.doc_id", "score").collect()
    good, bad = ([r.score for r in found if r.doc_id >= 300 and r.doc_id % 2 == k] for k in (1, 0))
    assert np.mean([[g > b for b in bad] for g in good]) > 0.97


def test_curve_visits_neighbours(spark):
    """Consecutive positions differ by one step in one dimension, and no cell is met twice."""
    grid = spark.range(8).crossJoin(spark.range(8).toDF("y")).crossJoin(spark.range(8).toDF("z"))
    df = grid.select(F.array(*[F.col(c).cast("int") for c in ("id", "y", "z")]).alias("levels"))
    cells = df.select("levels", hilbert.curve_index("levels", 3, 3).alias("at")).orderBy("at").collect()
    assert [c["at"] for c in cells] == list(range(512))
    for a, b in zip(cells, cells[1:]):
        assert sum(abs(x - y) for x, y in zip(a.levels, b.levels)) == 1


def test_shards_are_files_with_narrow_ranges(spark, docs, tmp_path):
    made = hilbert.shard(docs, keep=["doc_id", "text", "source"], shards=6)
    path = str(tmp_path / "shards")
    hilbert.write_shards(made, path, rows_per_file=10)
    back = spark.read.parquet(path)
    assert back.count() == docs.count()
    sizes = [r["count"] for r in back.groupBy("shard").count().collect()]
    assert len(sizes) == 6 and max(sizes) - min(sizes) <= 1
    ranges = hilbert.file_ranges(made).collect()
    spread = np.mean([r.source_high - r.source_low for r in ranges])
    assert sum(r.rows for r in ranges) == docs.count() and spread < hilbert.LEVELS - 1


def test_mix_meets_budgets_and_repeats(spark):
    rows = [(i, "w " * (1 + i % 9), "abc"[i % 3] if i % 2 else "b") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    mixed = mixing.mix(docs).cache()
    by_source = mixed.groupBy("row.source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target"), F.sum("size").alias("size")
    )
    for r in by_source.collect():
        assert abs(r.taken - r.target) <= 0.5 and r.target <= 3 * r["size"]
    again = {r.row.doc_id: r.taken for r in mixing.mix(docs.repartition(7)).collect()}
    assert again == {r.row.doc_id: r.taken for r in mixed.collect()}
    copies = Counter(r.doc_id for r in mixing.mixed_rows(mixed).collect())
    for r in mixed.collect():
        assert abs(copies[r.row.doc_id] * r["size"] - r.taken) <= r["size"] / 2


def test_benchmark_in_blocks_finds_the_same(spark, odd, docs):
    benchmark = spark.read.parquet(f"{odd}/benchmark.parquet")
    one, many = (
        sorted(
            winnowing.summary(winnowing.find_leaks(docs, benchmark, block_bytes=b), "doc_id").collect(),
            key=repr,
        )
        for b in (1 << 20, 60)
    )
    assert one == many and any(r.contaminated for r in one)


@pytest.mark.parametrize("list_rows,block", [(2, 1000), (50_000, 1 << 19)])
def test_dealt_lists_and_small_cells_find_the_same(spark, list_rows, block):
    rng = random.Random(9)
    base = tables.words(rng, 60)
    rows = []
    for i in range(150):  # one large group of near copies, all within reach of another one
        text = list(base)
        for _ in range(rng.randint(0, 5)):
            text[rng.randrange(60)] = f"x{i % 40}"
        rows.append((i, " ".join(text)))
    rows += [(500 + i, " ".join(base[:20] + tables.words(rng, 30))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found = {r.doc: r["class"] for r in jaccard_join.classes_of(docs, list_rows=list_rows, block=block).collect()}
    sets = {}
    for i, text in rows:
        w = text.lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    least = {i: i for i in sets}
    ids = sorted(sets)
    for _ in range(6):
        for a in ids:
            for b in ids:
                if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    least[a] = least[b] = min(least[a], least[b])
    assert found == least


def test_keys_too_many_to_broadcast_are_joined(spark, docs, monkeypatch):
    def results():
        cut = debruijn.cut_repeats(docs, keep=["doc_id"]).select("row.doc_id", "n_removed", "kept").collect()
        return sorted(cut, key=repr), sorted(jaccard_join.keep_one(docs).select("doc_id", "text").collect(), key=repr)

    usual = results()
    monkeypatch.setattr(common, "KNOWN_KEYS", -1)
    assert results() == usual
    assert sum(r.n_removed for r in usual[0]) > 0


def test_keep_one_of_each_group(spark, docs):
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    groups = defaultdict(set)
    for r in jaccard_join.classes_of(docs).where("n > 0").collect():
        groups[r.group].add(r.doc)
    texts = [r for r in kept.collect() if (r.text or "").split()]
    assert len(texts) == len(groups)
    assert kept.where("doc_id in (400, 401, 402)").count() == 3


def test_rare_tokens_and_small_tries_keep_the_base(spark, docs):
    whole = ppm.score(docs, docs, keep=["doc_id"])
    small = ppm.score(docs, docs, keep=["doc_id"], most_tokens=5, most_windows=50)
    a, b = (
        sorted(((r.row.doc_id or -1, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in x.collect()))
        for x in (whole, small)
    )
    assert a == b


def test_windows_out_of_the_cache_keep_the_score(spark, docs):
    whole, small, none = (
        sorted((r.row.doc_id or -1, r.score) for r in ppm.score(docs, docs, keep=["doc_id"], most_windows=n).collect())
        for n in (1 << 20, 50, 0)
    )
    for other in (small, none):
        assert [d for d, _ in other] == [d for d, _ in whole]
        assert [s for _, s in other] == pytest.approx([s for _, s in whole], rel=1e-9)


def test_model_probabilities_sum_to_one():
    words = ppm.Words(ppm.pa.array(["ab ac ad", "ab ab", ""]), ppm.BLANK_WORDS, True)
    codes, _ = ppm.windows(words)
    keys, counts = np.unique(codes, return_counts=True)
    levels = [(keys, counts)]
    for size in range(ppm.ORDER, 0, -1):
        levels.append(ppm.merged([levels[-1][0] & np.uint64((1 << (8 * size)) - 1)], [levels[-1][1]]))
    trie = ppm.Trie(list(reversed(levels)))
    for code in [*codes.tolist(), 0]:
        context = np.uint64(code >> 8) << np.uint64(8)
        odds = trie.log10(context | np.arange(256, dtype=np.uint64))
        assert (10**odds).sum() == pytest.approx(1)


def test_labelers_agree_on_reliability():
    good, bad = (1, 1, 1, 0, 0, 0, 0), (0, -1, 0, 0, 0, -1, -1)
    odd_vote = (0, -1, 1, 0, 0, 0, -1)
    prior, rates, posterior = pii.fit_labelers([(good, 50), (bad, 80), (odd_vote, 2)])
    assert posterior[good] > 0.95 and posterior[bad] < 0.05 and 0.2 < prior < 0.6
    assert rates[0][1][1] > rates[0][0][1]


def private_corpus():
    """Texts with tokens, harmless runs, and forms that only one labeler proposes."""
    rng = random.Random(1)
    forms = {
        "555 123 4567": "LINE",
        "555.123.4567": "LINE",
        "(555) 123-4567": "LINE",
        "123-45-6789": "NUMBER",
        "DE89 3704 0044 0532 0130 00": "ACCOUNT",
        "2001:db8:85a3::8a2e:370:7334": "IPV6",
        "password: hunter22": "SECRET",
        "ab+/cd3fGH12==": "SECRET",
        "Dr. Jane Miller": "NAME",
        "12 Green Hill Road": "STREET",
    }
    harmless = ["chapter12-foo", "version 2024-01-15", "page 12 34 56", "10.000.000", "see section1234"]
    harmless += ["at 12:30:45 today", "src/main/lib2/file", "Key: things", "on 2023 11 02 12", "Doctor Who"]
    said = ['token = "' + "".join(rng.choices("0123456789abcdef", k=40)) + '"' for _ in range(60)]
    said += [harmless[k % len(harmless)] for k in range(80)]
    rows = [(i, " ".join([*tables.words(rng, 8), x, *tables.words(rng, 8)])) for i, x in enumerate([*said, *forms])]
    return rows, list(forms.values())


def test_labelers_propose_spans_of_their_own(spark):
    rows, kinds = private_corpus()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = {r.row.doc_id: r.masked for r in pii.masked(pii.find_private(docs), "text").collect()}
    assert all("[SECRET]" in out[i] for i in range(60))
    assert all("[" not in out[i] for i in range(60, 140))
    for k, kind in enumerate(kinds):
        assert f"[{kind}]" in out[140 + k], (rows[140 + k], out[140 + k])


def test_added_spans_equal_a_slow_label_model(spark):
    rows, _ = private_corpus()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = [(r.row.doc_id, r.candidates) for r in pii.located(docs, "text", ["doc_id"]).collect()]
    each = [(d, c, [int(v) for v in c.votes.split(",")]) for d, cs in found for c in cs]
    votes = np.array([v for _, _, v in each])
    belief = np.array([[[0.64, 0.16], [0.16, 0.64]]] * votes.shape[1])  # labeler, class, vote -1 or 1
    rates, prior, old = belief, 0.5, None
    for _ in range(pii.MOST_ROUNDS):
        odds = np.full(len(votes), np.log(prior / (1 - prior)))
        for k in range(votes.shape[1]):
            share = rates[k] / rates[k].sum(axis=1, keepdims=True)
            for at, v in enumerate((-1, 1)):
                odds += (votes[:, k] == v) * np.log(share[1, at] / share[0, at])
        p = 1 / (1 + np.exp(-odds))
        prior = (p.sum() + 1) / (len(p) + 2)
        # Abstentions change no share of votes, so they need no count.
        rates = np.array([
            [[10 * belief[k, y, at] + (w * (votes[:, k] == v)).sum() for at, v in enumerate((-1, 1))]
             for y, w in ((0, 1 - p), (1, p))]
            for k in range(votes.shape[1])
        ])
        if old is not None and np.abs(old - p).max() < 1e-6:
            break
        old = p
    wanted = defaultdict(list)
    total = np.full(len(votes), np.log(prior / (1 - prior)))
    for k in range(votes.shape[1]):
        share = rates[k] / rates[k].sum(axis=1, keepdims=True)
        for at, v in enumerate((-1, 1)):
            total += (votes[:, k] == v) * np.log(share[1, at] / share[0, at])
    for f in range(len(pii.FEATURES)):
        values = np.array([c.features[f] for _, c, _ in each])
        one = {x: p[values == x].sum() + prior for x in set(values)}
        zero = {x: (1 - p)[values == x].sum() + 1 - prior for x in set(values)}
        for i, x in enumerate(values):
            total[i] += np.log(one[x] / sum(one.values()) / (zero[x] / sum(zero.values()))) / len(pii.FEATURES)
    for (doc, c, _), t in zip(each, total):
        if t > 0:
            last = wanted[doc][-1] if wanted[doc] else None
            if last and c.start < last[2]:
                last[2] = max(last[2], c.end)
            else:
                wanted[doc].append([c.start, pii.KINDS.index(c.kind), c.end])
    got = {r.row.doc_id: [list(s) for s in r.added] for r in pii.find_private(docs, keep=["doc_id"]).collect()}
    assert {d: s for d, s in got.items() if s} == {d: s for d, s in wanted.items() if s}


def test_masked_texts_and_long_runs(spark):
    rows = [
        (1, "mail a@b.cd now"),
        (2, "1" * 60_000 + " " + "a." * 40_000 + "@" + "b." * 40_000 + "c"),
        (3, None),
        (4, "1 2" * 30_000 + " 1.2.3.4"),
        (5, "12 " * 20_000 + "ab:" * 20_000 + "a/b+" * 20_000 + " DE12 " + "AB12 " * 9_000 + "Dr. " * 9_000),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = {r.row.doc_id: r.masked for r in pii.masked(pii.find_private(docs), "text").collect()}
    assert out[1] == "mail [EMAIL] now" and out[4].endswith("[IP]")


def regular_words(length):
    """A word whose letters alternate as the parity of the bits of their places, and its opposite."""
    bits = [bin(i).count("1") % 2 for i in range(length)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("length", [64, 1024, 2048, 4096])
def test_regular_words_do_not_meet(length):
    words = Words(pa.array([" ".join(regular_words(length))]), BLANK_WORDS, lower=False)
    assert len(set(words.hashes().tolist())) == 2


def test_range_hashes_are_those_of_the_polynomials():
    rng = np.random.default_rng(5)
    values = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    starts = rng.integers(0, 300, 80)
    ends = np.minimum(starts + rng.integers(0, 60, 80), 300)
    found = word_module.range_hashes(values, starts, ends)
    for start, end, h in zip(starts.tolist(), ends.tolist(), found):
        code = 0
        for prime, base in word_module._FIELDS:
            part = sum(int(v) * pow(base, i, prime) for i, v in enumerate(values[start:end])) % prime
            code = code << 31 | part
        assert h == word_module.mix(np.array([code], np.uint64))[0]


def test_documents_of_regular_words_share_nothing(spark):
    one, two = regular_words(2048)
    docs = spark.createDataFrame([(1, " ".join([one] * 60)), (2, " ".join([two] * 60))], "doc_id long, text string")
    cut = debruijn.cut_repeats(docs, keep=["doc_id"]).collect()
    assert {r.n_removed for r in cut} == {0}
    classes = {r.doc: r["class"] for r in jaccard_join.classes_of(docs).collect()}
    assert classes == {1: 1, 2: 2}


@pytest.mark.parametrize("span, node", [(20, 8), (50, 40), (80, 16), (100, 16), (150, 16)])
def test_repeats_of_other_lengths(spark, span, node):
    rng = np.random.default_rng(span)
    passages = [[f"p{i}w{j}" for j in range(rng.integers(span - 15, 2 * span))] for i in range(6)]
    texts = {}
    for doc in range(40):
        words = []
        for p in rng.choice(6, 3):
            words += [f"d{doc}x{j}" for j in range(rng.integers(0, 30))]
            cut = rng.integers(0, 8)
            words += passages[p][cut:] if doc % 3 else ["u", "v"] * (span // 2 + 3)
        texts[doc] = words
    smallest = {}
    for doc in sorted(texts):
        for i in range(len(texts[doc]) - span + 1):
            smallest.setdefault(tuple(texts[doc][i : i + span]), doc)
    wanted = {}
    for doc, words in texts.items():
        gone = set()
        for i in range(len(words) - span + 1):
            if smallest[tuple(words[i : i + span])] < doc:
                gone.update(range(i, i + span))
        wanted[doc] = (len(gone), " ".join(w for i, w in enumerate(words) if i not in gone))
    docs = spark.createDataFrame([(d, " ".join(w)) for d, w in texts.items()], "doc_id long, text string")
    cut = debruijn.cut_repeats(docs, keep=["doc_id"], span=span, node=node).collect()
    assert {r.row.doc_id: (r.n_removed, r.kept) for r in cut} == wanted
    assert sum(n for n, _ in wanted.values()) > 0


def test_a_span_of_too_many_nodes_is_refused(spark, docs):
    with pytest.raises(ValueError, match="node nearer"):
        debruijn.cut_repeats(docs, span=1000, node=16)
