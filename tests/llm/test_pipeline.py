"""The pipeline against its stages in plain Python, and the subpackage's isolation."""

import ast
import os

import brute
from llm_helpers import SF
from orderpulse.llm import mixing, quality
from orderpulse.llm.common import read_table
from orderpulse.llm.queries import END_ID, ORACLES, QUERIES, tokenizer_path

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_pipeline_against_plain_stages(spark):
    import corpus_pipeline as C

    docs = read_table(spark, SF, "documents")
    good = {r.doc_id for r in quality.score_documents(docs, read_table(spark, SF, "labels")).where("score >= 0.3").collect()}
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect() if r.doc_id in good]
    groups = brute.simhash_groups([r[:2] for r in rows])
    rows = [r for r, g in zip(rows, groups) if g[0] == g[2]]
    items = [tuple(r) for r in read_table(spark, SF, "benchmark", "item_id", "text").collect()]
    rows = [r for r, d in zip(rows, brute.decontaminated([r[:2] for r in rows], items)) if not d[5]]
    # the mix is held against its definition in test_documents.py; here its copies are taken as they are
    left = spark.createDataFrame([(*r, "en", 0) for r in rows], "doc_id bigint, text string, source string, lang string, n_chars bigint")
    copies = {r.doc_id: r["_copies"] for r in mixing.mix(left).collect()}
    want = brute.tokens([(d, t) for d, t, _ in rows for _ in range(copies[d])], tokenizer_path(), END_ID)
    got = sorted(tuple(r) for r in C.run(spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert got == sorted(want)
    assert 0 < len(rows) < docs.count()


def test_stages_keep_the_documents_columns(spark):
    import corpus_pipeline as C

    docs = read_table(spark, SF, "documents")
    assert [n for n, _ in C.STAGES] == ["quality classifier", "SimHash near-dedup", "benchmark decontamination",
                                        "mixing sources to target weights", "token-ID / binary output"]
    for _, stage in C.STAGES[:-1]:
        assert stage(spark, docs, SF).schema.names == docs.schema.names
    for _, stage in C.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_queries_and_oracles_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


def test_oracles_match(spark):
    from orderpulse.plans.compare import compare, duckdb_connection

    for name, sql in ORACLES.items():
        ok, why = compare(QUERIES[name](spark, SF), sql, duckdb_connection(SF))
        assert ok, (name, why)


def test_nothing_else_imports_the_subpackage():
    for folder, _, names in os.walk(os.path.join(REPO, "orderpulse")):
        for name in names:
            path = os.path.join(folder, name)
            if not name.endswith(".py") or f"{os.sep}llm{os.sep}" in path:
                continue
            for node in ast.walk(ast.parse(open(path).read())):
                told = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(
                    node, ast.ImportFrom) else []
                assert not any(t.startswith("orderpulse.llm") or t == "corpus_pipeline" for t in told), path
