"""Queries against their SQL oracles on the smallest test data; check_oracles.py runs them all."""

import pytest

import __spark_entry__ as contract
from check_oracles import compare, duck
from tests.conftest import SMALL

QUICK = (
    "scan_csv", "scan_tsv", "scan_json", "scan_jsonl", "text_cards", "grid_records", "detect_format", "union_sources",
    "file_reports", "canonical_field", "custom_aliases", "fuse_aliases", "normalize_string", "normalize_date",
    "dispatch_clean", "normalize_records", "similarity_ratio", "secondary_keys", "hash_fnv1a", "match_exact",
    "match_phone", "possible_pairs", "detect", "bucket_profile", "page_records", "search_records",
)


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_oracle(spark, con, name):
    assert compare(spark, con, name, SMALL).startswith("ok")


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).columns[:2] == ["record_id", "is_duplicate"]
