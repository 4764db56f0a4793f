"""The subpackage's queries against their SQL over the smallest tables; those without SQL must run."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from oracle import FOLDER, connect, same  # noqa: E402

from headwaykit.llm import catalog, tokens  # noqa: E402

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_its_sql(spark, name):
    same(spark, connect(), catalog.QUERIES[name], catalog.SQL[name])


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_query_runs(spark, name):
    assert catalog.QUERIES[name](spark, FOLDER).count() > 0


def test_mix_is_as_large_as_the_targeted_documents(spark):
    shares = catalog.QUERIES["p9_shares"](spark, FOLDER).collect()
    once, used = sum(r.tokens_once for r in shares), sum(r.tokens_used for r in shares)
    assert abs(used - once) < 0.05 * once  # each source within one document of its amount
    short = [r for r in shares if r.tokens_once and r.actual_share < r.target_share - 0.02]
    assert short and all(r.tokens_used == r.max_repeats * r.tokens_once for r in short)


def test_long_documents_are_cut_and_have_the_tokenizers_ids(spark, monkeypatch):
    sizes, encode = [], tokens.encode_corpus
    monkeypatch.setattr("headwaykit.llm.text_queries.encode_corpus", lambda *a, **k: sizes.append(k.get("piece_chars", 8192)) or encode(*a, **k))
    got = {r.doc_id: list(r.ids) for r in catalog.QUERIES["p8_ids"](spark, FOLDER).collect()}
    texts = {r.doc_id: r.t or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").selectExpr("doc_id", "make_valid_utf8(text) t").collect()}
    with open(tokens.vocabulary_file(), "rb") as f:
        enc = tokens.encoder(f.read())
    assert got == {i: enc.encode_ordinary(t) for i, t in texts.items()}
    assert sum(len(t) > sizes[0] for t in texts.values()) > 0


def test_unsplit_runs_of_documents_have_the_tokenizers_ids(spark):
    got = {r.doc_id: list(r.ids) for r in catalog.QUERIES["p8_unsplit"](spark, FOLDER).collect()}
    texts = {r.doc_id: r.t or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").selectExpr("doc_id", r"regexp_replace(make_valid_utf8(text), '\\P{L}+', '') t").collect()}
    with open(tokens.vocabulary_file(), "rb") as f:
        enc = tokens.encoder(f.read())
    assert got == {i: enc.encode_ordinary(t) for i, t in texts.items()}
    assert sum(len(t) > 4 * 256 for t in texts.values()) > 5
