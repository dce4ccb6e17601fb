"""The pipeline and the registered queries."""

from __future__ import annotations

import re
from collections import Counter

import oracle
import pytest

import corpus_pipeline
from tidemark.llm import queries
from tidemark.llm.common import stored


def test_every_operator_has_a_query():
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES if n.startswith("op")} == set(range(1, 14))
    assert set(queries.ORACLES) <= set(queries.QUERIES) and "pipeline" in queries.QUERIES


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, sf_dir, name):
    found = oracle.spark_rows(queries.QUERIES[name](spark, sf_dir))
    assert found == oracle.duckdb_rows(oracle.connect(sf_dir), queries.ORACLES[name])


def test_stages_in_turn(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, sf_dir), "test-stage")
        seen.append(Counter(r.doc_id for r in docs.select("doc_id").collect()))
        assert docs.columns == columns or name == "packing"
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    everything = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id").collect()}
    gone = everything - set(seen[0])
    assert sum(labels[i].toxic for i in gone if i in labels) >= 0.95 * len(gone & set(labels))
    junk = {i for i, r in labels.items() if r.quality == 0} & set(seen[0])
    assert len(junk & set(seen[1])) <= 0.05 * len(junk)
    assert all(set(b) <= set(a) for a, b in zip(seen, seen[1:])) and set(seen[2].values()) == {1}
    assert set(seen[3]) == set(seen[4]) and max(seen[3].values()) == 2
    tokens = Counter()
    for r in docs.collect():
        tokens[r.sequence_id] += r.length
    assert all(n == 2048 for w, n in tokens.items() if w != max(tokens))


def test_operators_do_not_swallow_import_errors():
    import pathlib

    import tidemark.llm

    files = [*pathlib.Path(tidemark.llm.__file__).parent.glob("*.py"), pathlib.Path(corpus_pipeline.__file__)]
    assert not [f.name for f in files if re.search(r"except (\(.*)?(ImportError|ModuleNotFoundError)", f.read_text())]
