"""Every registered query: its columns, and its rows against the same query in SQL or against brute force."""

import hashlib

import duckdb
import public_tokenizers
import pytest
from test_byte_pairs import KNOWN
from test_personal_data import brute

import __spark_entry__
from sievetally.llm.oracles import ORACLES
from sievetally.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
TYPES = {
    "op1_bpe": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op2_topk": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
    "op3_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op4_near_vectors": {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op5_pii": {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint", "base_sha256": "string", "spans": "string"},
    "op6_langid": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double", "rejected": "boolean"},
    "op7_token_counts": {"doc_id": "bigint", "n_tokens": "bigint"},
    "op8_packing": {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"},
    "op9_warc": {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint"},
    "op10_jaccard": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op11_ranking": {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"},
    "op12_sources": {"lang": "string", "source": "string", "part": "string", "item": "string", "value": "bigint", "rank": "int"},
    "op13_secrets": {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"},
}


@pytest.fixture(scope="module")
def docs(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= set(__spark_entry__.queries()) and set(QUERIES) == set(TYPES)
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", ORACLES)
def test_rows_match_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    assert dict(df.dtypes) == TYPES[name]
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({ORACLES[name]})").fetchall()
    assert sorted((tuple(r) for r in df.collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_columns(spark, name):
    assert dict(QUERIES[name](spark, "/root/testdata/sf0.001").dtypes) == TYPES[name]


def test_digests_of_ids(spark, docs):
    rows = {r["doc_id"]: r for r in QUERIES["op1_bpe"](spark, SF).collect()}
    assert rows.keys() == docs.keys()
    for doc, text in docs.items():
        ids = KNOWN.encode_ordinary(text or "")
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        assert tuple(rows[doc])[1:] == (len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())


def test_token_counts(spark, docs):
    rows = {r["doc_id"]: r["n_tokens"] for r in QUERIES["op7_token_counts"](spark, SF).collect()}
    assert rows == {doc: len(KNOWN.encode_ordinary(text or "")) for doc, text in docs.items()}


def test_personal_data_of_all_documents(spark, docs):
    rows = {r["doc_id"]: r for r in QUERIES["op5_pii"](spark, SF).collect()}
    assert rows.keys() == docs.keys()
    for doc, text in docs.items():
        base = brute(text)
        kinds = [x.split(":")[0] for x in base.split(",")]
        assert rows[doc]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert [rows[doc][f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [kinds.count(k) for k in ("email", "ip", "card", "phone")]
        assert set(filter(None, base.split(","))) <= set(rows[doc]["spans"].split(","))


def test_packing_is_tight(spark, docs):
    from tokenizers import Tokenizer

    known = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = QUERIES["op8_packing"](spark, SF).collect()
    total = {}
    for r in rows:
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["length"]
    assert total == {doc: len(known.encode(text or "", add_special_tokens=False).ids) + 1 for doc, text in docs.items()}
    assert len({r["sequence_id"] for r in rows}) <= 1.02 * -(-sum(total.values()) // 1024)
