"""Every stage of the pipeline over the odd tables, judged on its own input, and over empty ones."""

import sys
from collections import Counter, defaultdict
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

import corpus_pipeline  # noqa: E402
import tables  # noqa: E402
from wickwork.llm import neighbours  # noqa: E402
from wickwork.llm.common import bucket  # noqa: E402
from wickwork.llm.oracles import SQL  # noqa: E402
from wickwork.llm.queries import table  # noqa: E402


@pytest.fixture(scope="module")
def odd(tmp_path_factory):
    return tables.odd_tables(tmp_path_factory.mktemp("odd"))


def ids(rows):
    return Counter((r["doc_id"], r["row"]) for r in rows)


def judged(folder, rows, name, columns):
    """The SQL of an operator over the rows of one stage, by row."""
    con = tables.duck(folder)
    documents = tables.pa.Table.from_pylist(
        [{**r, "doc_id": i} for i, r in enumerate(rows)], schema=tables.SCHEMA
    )
    con.execute("DROP VIEW documents")
    con.register("documents", documents)
    return {r[0]: r[1:] for r in con.execute(f"SELECT doc_id, {columns} FROM ({SQL[name]})").fetchall()}


def test_stages_of_odd_tables(spark, odd, tmp_path):
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
    docs, held = table(spark, odd, "documents"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = [r.asDict() for r in docs.collect()]
        out = stage(spark, docs, odd)
        if name != "hilbert_sharding":
            assert out.columns == columns
        path = str(tmp_path / name)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        held[name] = (before, [r.asDict() for r in docs.collect()])

    # Documents whose score says so go; every other row stays as it was.
    before, after = held["quality_classifier"]
    teach = table(spark, odd, "labels").where(~bucket("doc_id", 5, 0))
    scored = neighbours.score(table(spark, odd, "documents"), teach).collect()
    good = Counter((r.row.doc_id, r.row.row) for r in scored if r.score >= corpus_pipeline.LEAST_QUALITY)
    assert ids(after) == good and 0 < len(after) <= len(before)

    # One row of every class of linked rows; rows without shingles are linked with nothing.
    before, after = held["ngram_jaccard_join"]
    classes = judged(odd, before, "op8_jaccard_join", "component_id")
    groups = defaultdict(list)
    for i, r in enumerate(before):
        groups[classes[i][0]].append((r["doc_id"], r["row"]))
    kept = ids(after)
    assert len(after) == len(groups) and not kept - ids(before)
    assert all(sum(kept[m] for m in members) == 1 for members in groups.values())

    # Rows without a window of the benchmark.
    before, after = held["benchmark_decontamination"]
    hits = judged(odd, before, "op7_winnowing", "contaminated")
    assert ids(after) == ids([r for i, r in enumerate(before) if not hits[i][0]])

    # Whole copies: as many as the words taken hold, a half and more counts as one.
    before, after = held["mixing_sources"]
    assert set(ids(after)) <= set(ids(before))
    assert all(n <= 4 for n in ids(after).values())

    # Every row gets a shard and a place; the shards' sizes differ by one row at most.
    before, after = held["hilbert_sharding"]
    assert ids(after) == ids(before)
    sizes = Counter(r["shard"] for r in after)
    assert set(sizes) <= set(range(24)) and max(sizes.values()) - min(sizes[s] for s in range(24)) <= 1
    assert all(sorted(r["slot"] for r in after if r["shard"] == s) == list(range(n)) for s, n in sizes.items())


def test_run_over_empty_tables(spark, tmp_path):
    folder = tables.write(tmp_path / "empty", [], [], [])
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_run_equals_its_stages(spark, odd):
    """A second run gives the same rows in the same shards."""
    first, second = (corpus_pipeline.run(spark, odd).select("doc_id", "row", "shard", "slot") for _ in range(2))
    assert Counter(map(tuple, first.collect())) == Counter(map(tuple, second.collect()))
    assert set(first.select("row").collect()) <= set(table(spark, odd, "documents").select("row").collect())
