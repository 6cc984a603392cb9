"""Registered queries against their SQL answers, and the pipeline against brute force, stage by stage."""

import re
from collections import defaultdict

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm.test_dedup import components_of, slow_print
from tests.llm.test_packing import contract_ids
from tests.oracle import compare, connect
from tidespan.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, duck, name):
    problem, _ = compare(duck, queries.QUERIES[name](spark, SF), queries.ORACLES[name])
    assert problem is None, problem


def test_all_are_registered():
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("name,table,key", [
    ("op2_pii", "documents", "doc_id"), ("op5_toxicity", "documents", "doc_id"), ("op6_simhash_near_dedup", "documents", "doc_id"),
    ("op9_quality", "documents", "doc_id"), ("op10_warc", "pages", "page_id"),
])
def test_one_row_for_each_input_row(spark, name, table, key):
    out = queries.QUERIES[name](spark, SF).cache()
    ids = sorted(r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(key).collect())
    assert sorted(r[0] for r in out.select(key).collect()) == ids


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, rows = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        assert k == len(corpus_pipeline.STAGES) - 1 or out.columns == columns
        out.write.parquet(str(tmp_path / name))
        rows[name] = {r.doc_id: r.text for r in docs.collect()}, (docs := spark.read.parquet(str(tmp_path / name))).collect()

    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    before, after = rows["toxicity"]
    kept = {r.doc_id for r in after}
    clean = [d for d in before if labels.get(d) == 0]
    assert np.mean([d in kept for d in clean]) > 0.97 and len(after) == len(kept)

    before, after = rows["exact_dedup"]
    groups = defaultdict(list)
    for d, t in before.items():
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), d))
    assert sorted(r.doc_id for r in after) == sorted(min(g)[1] for g in groups.values())

    before, after = rows["simhash_near_dedup"]
    prints = {d: slow_print(t) for d, t in before.items()}
    roots, least = components_of(sorted(set(prints.values())), 2), {}
    for d in sorted(before):
        least.setdefault(roots[prints[d]], d)
    assert sorted(r.doc_id for r in after) == sorted(least.values())

    before, after = rows["mixing"]
    assert {r.doc_id for r in after} <= set(before) and 0.5 < len(after) / len(before) < 0.9

    before, after = rows["best_fit_packing"]
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in after:
        pieces[r.doc_id].append((r.start, bytes(r.ids)))
        sequences[r.sequence_id].append((r.offset, r.length))
    for d, t in before.items():
        ids = contract_ids(t or "") + [0]
        assert b"".join(p for _, p in sorted(pieces[d])) == np.array(ids, "<u4").tobytes()
    for parts in sequences.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:], strict=False))
        assert sum(n for _, n in parts) <= 2048


DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long, topic string, kept boolean"


def small_corpus(spark, folder, rows):
    """A folder of tables with columns that the operators use as well."""
    spark.createDataFrame(rows, DOCUMENT).write.parquet(f"{folder}/documents.parquet")
    labels = [(r[0], 1, int(i % 9 == 0)) for i, r in enumerate(rows) if r[0] is not None]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_pipeline_of_odd_rows(spark, tmp_path):
    """Null keys, texts, sources and languages, repeated and empty rows, long texts and clashing columns: nothing fails, and
    what the first stages keep is what their definitions say."""
    rows = [(i, f"words of document number {i} about subject {i * 7} and so on {i * i}", "en", "a" if i % 3 else None, 5, "t", True) for i in range(60)]
    rows += [(None, None, None, None, None, None, None), (None, None, None, None, None, None, None), (200, "", "de", "b", 0, None, False)]
    rows += [(201, "long text " * 30_000, "en", "b", 1, "x", None), rows[5], rows[5], (202, rows[6][1], "en", "a", 5, "t", True), (203, "x" * 100_000, None, "b", 1, None, None)]
    folder = small_corpus(spark, tmp_path / "odd", rows)
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, out = docs.collect(), stage(spark, docs, folder)
        assert out.columns == columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = before, docs.collect()
    before, after = kept["exact_dedup"]
    assert len(after) == len({re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in before})
    before, after = kept["simhash_near_dedup"]
    assert {slow_print(r.text) for r in after} <= {slow_print(r.text) for r in before} and 0 < len(after) <= len(before)
    packed = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in packed} <= {r[0] for r in rows} and all(0 < r.length <= 2048 for r in packed)


def test_pipeline_of_an_empty_table(spark, tmp_path):
    folder = small_corpus(spark, tmp_path / "none", [])
    assert corpus_pipeline.run(spark, folder).collect() == []
