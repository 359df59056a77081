"""Every query of the package on the smallest driver tables, and the pipeline stage by stage."""

import os
import re

import oracle
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from tallystream.llm import minhash, packing, pii, queries, quality_rules

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, name):
    assert oracle.difference(spark, oracle.connect(SF_DIR), queries.QUERIES[name], queries.ORACLES[name], SF_DIR) is None


def test_all_are_registered():
    assert {*queries.QUERIES, "pipeline"} <= set(contract.queries())


def test_pipeline_keeps_what_each_stage_keeps(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    good = {d: t for d, t in docs.items() if quality_rules.first_rejecting(quality_rules.Measures(t.encode()), quality_rules.RULES) is None}
    sets = {d: {*minhash.shingle_set(t.encode()).tolist()} for d, t in good.items()}
    least = {d: d for d in good}
    for _ in good:
        before = dict(least)
        for a in good:
            for b in good:
                if least[a] < least[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                    least[b] = least[a]
        if before == least:
            break
    single = {d: t for d, t in good.items() if least[d] == d}
    words = lambda t: re.findall("[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    windows = set()
    for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect():
        w = words(r.text)
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
    sizes = {len(w) for w in windows}
    clean = {d for d, t in single.items() if not any(tuple(words(t)[i : i + n]) in windows for n in sizes for i in range(len(words(t)) - n + 1))}
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r.doc_id for r in rows} == clean
    masked = pii.masked(spark.createDataFrame([(d, docs[d]) for d in sorted(clean)], "doc_id long, text string"))
    want = {(r.doc_id, r.start, r.length, r.ids_crc32) for r in packing.token_pieces(masked).collect()}
    assert {(r.doc_id, r.start, r.length, r.ids_crc32) for r in rows} == want
