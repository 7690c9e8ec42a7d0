"""The registered queries of the subpackage that have SQL, against it on the smallest tables; every one keeps its contract's columns."""

import glob
import os

import duckdb
import pytest

from modelstream.llm.queries import ORACLE, QUERIES

TABLES = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(TABLES), reason="needs the test tables")

COLUMNS = {
    "op2_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op3_minhash": "doc_id n_shingles component_id kept",
    "op4_quality_model": "doc_id held_out score predicted",
    "op5_chat_tree": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    "op6_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op7_decontamination": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op8_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op9_secrets": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op10_language": "doc_id held_out lang_pred score",
    "op11_filter_audit": "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley",
    "op12_warc": "page_id payload_bytes payload_digest record_type refers_to",
    "op13_whitening": "vec_id component n deviation whitened explained identity_error",
}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, name):
    db = duckdb.connect()
    for path in glob.glob(f"{TABLES}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    cursor = db.execute(ORACLE[name])
    found = [d[0] for d in cursor.description]
    rows = QUERIES[name](spark, TABLES).select(*found).collect()
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, cursor.fetchall()))


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, name):
    frame = QUERIES[name](spark, TABLES)
    assert frame.columns[: len(COLUMNS[name].split())] == COLUMNS[name].split()
