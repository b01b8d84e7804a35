"""The registered queries and the pipeline on the smallest tables."""

import os
import shutil
import subprocess
import sys
from collections import Counter

import duckdb
import numpy as np
import pytest
from llm_cases import EDGE_ROWS
from test_chat_format import wanted as brute_chats
from test_documents import base_counts, base_spans, brute_components, judged
from test_prefix_trie import brute_trie
from test_spelling import brute_variants

import __spark_entry__ as spark_entry
import corpus_pipeline
from varloom.llm.chat_format import HARD_CASE
from varloom.llm.common import tokenizer_path
from varloom.llm.queries import ORACLES, QUERIES
from varloom.llm.url_rules import RULES
from varloom.staging import staged

SF_DIR = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return con


@pytest.fixture(scope="module")
def documents(duck):
    return [(d, t or "") for d, t in duck.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()]


def test_all_are_registered():
    registered = spark_entry.queries()
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(registered) and set(ORACLES) <= set(spark_entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_statement(spark, duck, name):
    found = QUERIES[name](spark, SF_DIR)
    wanted = duck.execute(ORACLES[name])
    names = [c[0] for c in wanted.description]
    assert sorted(found.columns) == sorted(names)
    assert Counter(map(tuple, found.select(*names).collect())) == Counter(wanted.fetchall())


def test_queries_against_brute_force(spark, duck, documents):
    found = QUERIES["op2_secret_scan"](spark, SF_DIR).collect()
    assert Counter(tuple(r)[:5] for r in found) == Counter((d, *base_spans(t)) for d, t in documents)
    found = QUERIES["op3_near_duplicates"](spark, SF_DIR).collect()
    assert sorted(tuple(r)[:3] for r in found) == sorted(brute_components(documents, 3, 85))
    urls = duck.execute("SELECT page_id, url FROM pages").fetchall()
    assert Counter(map(tuple, QUERIES["op9_url_filter"](spark, SF_DIR).collect())) == Counter((i, *judged(u, RULES)) for i, u in urls)
    docs = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").collect()]
    assert {tuple(r) for r in QUERIES["op11_prefix_trie"](spark, SF_DIR).collect()} == brute_trie(docs)
    found = QUERIES["op12_spelling_variants"](spark, SF_DIR).collect()
    assert {tuple(r) for r in found} == brute_variants(documents) and len(found) == len(set(found))
    found = QUERIES["op13_chat_format"](spark, SF_DIR).collect()
    assert {r.conv_id: tuple(r)[1:5] for r in found} == brute_chats(docs + [(HARD_CASE[0], *t) for t in HARD_CASE[1]])
    found = QUERIES["op10_quality_rules"](spark, SF_DIR).collect()
    assert Counter(tuple(r)[:6] for r in found) == Counter((d, *base_counts(t)) for d, t in documents)


def test_the_pipeline_by_stages(spark, duck, documents):
    """Each stage against brute force on what the stage before it kept."""
    from tokenizers import Tokenizer

    docs, results = spark.read.parquet(f"{SF_DIR}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SF_DIR))
        results[name] = docs.collect()
    wanted = {d for d, in duck.execute(f"SELECT doc_id FROM ({ORACLES['op10_quality_rules']}) WHERE kept").fetchall()}
    assert sorted(r.doc_id for r in results["quality_rules"]) == sorted(wanted)
    pairs = [(r.doc_id, r.text) for r in results["quality_rules"]]
    heads = sorted({component for _, _, component in brute_components(pairs, 5, 80)})
    assert sorted(r.doc_id for r in results["near_dedup"]) == heads
    before = {r.doc_id: r for r in results["near_dedup"]}
    after = {r.doc_id: r for r in results["secret_scan"]}
    assert set(before) == set(after)
    for doc, row in after.items():
        assert row.n_chars == len(row.text) and (row.lang, row.source) == (before[doc].lang, before[doc].source)
        assert (row.text == before[doc].text) == (sum(base_spans(before[doc].text)[:3]) == 0)
        assert sum(base_spans(row.text)[:3]) == 0
    tok, pieces = Tokenizer.from_file(tokenizer_path(corpus_pipeline.TOKENIZER)), {}
    for r in sorted(results["packing"], key=lambda r: (r.doc_id, r.start)):
        pieces[r.doc_id] = pieces.get(r.doc_id, b"") + bytes(r.ids)
    assert set(pieces) == set(after)
    for doc, raw in pieces.items():
        assert np.frombuffer(raw, "<u4").tolist() == tok.encode(after[doc].text, add_special_tokens=False).ids + [corpus_pipeline.END_ID]


def test_the_pipeline_takes_edge_cases(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    edge = [(d, t, "en", s, len(t or "")) for d, t, s in EDGE_ROWS]
    for k, rows in enumerate((edge, [])):
        folder = tmp_path / str(k)
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
        found = corpus_pipeline.run(spark, str(folder)).collect()
        assert {r.doc_id for r in found} == ({4} if rows else set())


def test_later_stages_take_edge_cases(spark):
    """Each stage after the first on all edge rows and on none."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    edge = [(d, t, "en", s, len(t or "")) for d, t, s in EDGE_ROWS]
    for name, stage in corpus_pipeline.STAGES[1:]:
        docs = spark.createDataFrame(edge, schema)
        found = stage(spark, docs, SF_DIR).collect()
        assert stage(spark, docs.limit(0), SF_DIR).count() == 0
        if name == "near_dedup":
            assert {(r.doc_id, r.text) for r in found} <= {(d, t) for d, t, *_ in edge} and len(found) == len(set(found))
        elif name == "secret_scan":
            assert Counter((r.doc_id, r.text, r.source) for r in found) == Counter((d, t, s) for d, t, _, s, _ in edge)
        else:
            assert Counter(r.doc_id for r in found if r.start == 0) == Counter(d for d, *_ in edge)


def test_the_entry_works_without_this_subpackage(tmp_path):
    for name in ("__spark_entry__.py", "fixture_queries.py", "fixture_tables.py"):
        shutil.copy(os.path.join(ROOT, name), tmp_path / name)
    shutil.copytree(os.path.join(ROOT, "varloom"), tmp_path / "varloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'process_vep' in q and not [n for n in q if n.startswith('op') or n == 'pipeline']"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
