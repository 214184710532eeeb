"""The pipeline against its stages done plainly, on the smallest given tables."""

import hashlib
import re

import brute
import pytest

import corpus_pipeline
from eventlens.llm import queries as Q
from eventlens.llm import quality_rules, secret_scan


def test_stages_take_and_return_documents(spark, table):
    docs = table("documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, "/root/testdata/sf0.001").columns == docs.columns, name


def test_pipeline_equals_brute_force(spark, table):
    tokenizers = pytest.importorskip("tokenizers")
    docs = {r.doc_id: r.text for r in table("documents").collect()}
    items = [r.text for r in table("benchmark").collect()]
    # The verdict on frequent lines has its own tests; base rules are done plainly here.
    kept = {r.doc_id for r in quality_rules.judge(table("documents")).filter("kept").collect()}
    figures = {i: brute.base_figures(t) for i, t in docs.items()}
    assert all(f[0] >= 20 and 100 * f[4] <= 30 * f[0] for i, f in figures.items() if i in kept)
    rows = [(i, docs[i]) for i in sorted(kept)]
    one = [(i, docs[i]) for i, n, c in brute.components(rows, 5, 80) if i == c or not n]
    clean = [(i, t) for i, t in one if not any(brute.contains(t, x, 0.2) for x in items)]
    library = tokenizers.Tokenizer.from_file(Q.tokenizer_path())
    wanted = {}
    for i, t in clean:
        t = re.sub(r'(token = ")[0-9a-fA-F]{40}(?=")', rf"\1{secret_scan.MARK}", t)
        ids = library.encode(t, add_special_tokens=False).ids
        wanted[i] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(t.encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256)
           for r in corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()}
    assert got == wanted and len(one) > len(clean)


def test_pipeline_of_empty_tables(spark, table, tmp_path):
    for name in ("documents", "benchmark"):
        table(name).limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
