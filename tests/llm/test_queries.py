"""The registered queries: against their oracle SQL, and their contracts' columns."""

import zlib

import pytest

from martforge.llm.catalog import LLM_ORACLE_SQL, LLM_QUERIES

from ..conftest import SMALL_SF
from ..oracle import compare, duck

COLUMNS = {
    "op1_": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op2_": "doc_id size source_size target taken",
    "op3_": "doc_id n_shingles component_id kept",
    "op4_": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op5_": "doc_id held_out lang_pred score",
    "op8_": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op9_": "doc_id start n_tokens ids_crc32",
    "op10_": "vec_id n_links component_id kept",
    "op11_": "page_id host path rule verdict",
    "op12_": "doc_id leaf subroot root proof_sha256 folded_root verified",
    "op13_": "item_id rank doc_id score",
}


@pytest.mark.parametrize("name", sorted(LLM_ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    r = compare(spark, duck(SMALL_SF), name, LLM_QUERIES[name], LLM_ORACLE_SQL[name], SMALL_SF)
    assert r["cols_match"] and r["values_match"], r


@pytest.mark.parametrize("prefix", sorted(COLUMNS))
def test_contract_columns(spark, prefix):
    (name,) = [n for n in LLM_QUERIES if n.startswith(prefix)]
    assert set(COLUMNS[prefix].split()) <= set(LLM_QUERIES[name](spark, SMALL_SF).columns)


def test_folds_follow_the_crc_of_the_id(spark):
    for prefix, modulus, remainder in (("op4_", 5, 1), ("op5_", 4, 2)):
        (name,) = [n for n in LLM_QUERIES if n.startswith(prefix)]
        for r in LLM_QUERIES[name](spark, SMALL_SF).select("doc_id", "held_out").collect():
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % modulus == remainder)
