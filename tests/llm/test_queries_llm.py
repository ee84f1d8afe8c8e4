"""The registered queries of the text operators: against SQL where it is given, and by contract."""

import pytest

import __spark_entry__ as contract
from opspark.llm import queries
from tests.conftest import SF
from tools.check import compare, database


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, name):
    df = queries.QUERIES[name](spark, SF)
    cur = database(SF).execute(queries.ORACLES[name])
    cols = [d[0] for d in cur.description]
    assert compare(df.columns, [tuple(r) for r in df.collect()], cols, cur.fetchall()) is None


def test_all_and_the_pipeline_are_registered():
    names = contract.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))
    assert "pipeline" in names


COLUMNS = {
    "op1": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
    "op3": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op4": ["vec_id", "n_links", "component_id", "kept"],
    "op5": ["page_id", "url", "text", "n_chars"],
    "op6": ["doc_id", "size", "source_size", "target", "taken"],
    "op7": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op9": ["doc_id", "n_shingles", "component_id"],
    "op10": ["doc_id", "held_out", "score", "predicted"],
    "op11": ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
    "op12": ["word", "form", "root", "n", "n_near", "form_n"],
    "op13": ["query_id", "rank", "vec_id", "score"],
}


@pytest.mark.parametrize("op", sorted(COLUMNS))
def test_contract_columns(spark, op):
    name = next(n for n in queries.QUERIES if n.startswith(op + "_"))
    assert set(COLUMNS[op]) <= set(queries.QUERIES[name](spark, SF).columns)
