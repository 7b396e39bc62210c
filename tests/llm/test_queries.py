"""All corpus queries over whole small tables: they run, and a row stands for each row or node that is asked for."""

import pytest

from ledgerforge.llm.queries import ORACLES, QUERIES

DOCUMENT_COLUMNS = {
    "op1_language_id": {"doc_id", "held_out", "lang_pred", "score"},
    "op2_pii": {"doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"},
    "op4_mixing": {"doc_id", "size", "source_size", "target", "taken"},
    "op7_toxicity": {"doc_id", "held_out", "score", "predicted"},
    "op8_lm_scoring": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"},
    "op9_near_duplicates": {"doc_id", "class_id", "links", "members"},
    "op10_media": {"doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"},
}


@pytest.mark.parametrize("name", sorted(DOCUMENT_COLUMNS))
def test_a_row_for_each_document(spark, sf_dir, name):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id")
    got = QUERIES[name](spark, sf_dir)
    assert set(got.columns) >= DOCUMENT_COLUMNS[name]
    rows = got.select("doc_id").collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in docs.collect())


def test_all_thirteen_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)
