import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from passagework.operators import catalogue
from passagework.operators.messages import (
    NOT_JSON,
    NOT_OBJECT,
    REQUIRED,
    require_valid,
    split_messages,
    to_bodies,
)

VALID = {
    "document_id": "AAPL-10K-1",
    "s3_bucket": "filings",
    "s3_key": "AAPL/x/doc.htm",
    "tenant": "AAPL",
    "doc_type": "10-K",
}


def _split(spark, *bodies):
    texts = [b if isinstance(b, str) else json.dumps(b) for b in bodies]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, body string")
    checked = split_messages(df)
    return (
        {r["i"]: r for r in checked.valid.collect()},
        {r["i"]: r["reason"] for r in checked.rejected.collect()},
    )


def test_valid_message_and_defaults(spark):
    bare = {k: v for k, v in VALID.items() if k != "doc_type"}
    valid, rejected = _split(
        spark,
        VALID,
        bare,
        VALID | {"metadata": {"cik": "0000320193"}, "unknown": [1]},
        VALID | {"doc_type": "", "tenant": " AAPL "},
    )
    assert rejected == {}
    assert valid[0]["tenant"] == "AAPL" and valid[0]["doc_type"] == "10-K"
    assert valid[1]["doc_type"] == "10-K" and valid[1]["metadata"] == {}
    assert valid[2]["metadata"] == {"cik": "0000320193"}
    assert valid[3]["doc_type"] == "" and valid[3]["tenant"] == " AAPL "


@pytest.mark.parametrize("field", REQUIRED)
def test_blank_missing_null_fields_are_refused(spark, field):
    missing = {k: v for k, v in VALID.items() if k != field}
    bodies = [VALID | {field: b} for b in ("   ", "", "\xa0\t", "　", None)] + [missing]
    valid, rejected = _split(spark, *bodies)
    assert valid == {}
    assert set(rejected.values()) == {f"required field '{field}' is missing or empty"}


def test_first_failing_field_is_named(spark):
    _, rejected = _split(spark, {"s3_key": "", "tenant": 5}, VALID | {"tenant": "", "s3_key": 1})
    assert rejected[0] == "required field 'document_id' is missing or empty"
    assert rejected[1] == "required field 'tenant' is missing or empty"


def test_shapes_and_types(spark):
    valid, rejected = _split(
        spark,
        "not-json{",
        "[1, 2]",
        "null",
        '"text"',
        VALID | {"tenant": 0},
        VALID | {"s3_key": False, "doc_type": None},
        VALID | {"metadata": {"a": 1}},
        VALID | {"metadata": None},
        VALID | {"metadata": [1]},
        VALID | {"document_id": {}},
        "",
    )
    assert valid == {}
    assert rejected[0] == rejected[10] == NOT_JSON
    assert rejected[1] == rejected[2] == rejected[3] == NOT_OBJECT
    assert rejected[4] == "wrong type for: tenant"
    assert rejected[5] == "wrong type for: s3_key, doc_type"
    assert rejected[6] == rejected[7] == rejected[8] == "wrong type for: metadata"
    assert rejected[9] == "wrong type for: document_id"


def test_last_of_repeated_keys_counts(spark):
    body = json.dumps(VALID)[:-1] + ', "tenant": "MSFT"}'
    valid, _ = _split(spark, body)
    assert valid[0]["tenant"] == "MSFT"


def test_strict_form_stops_the_job(spark):
    df = spark.createDataFrame([(json.dumps(VALID),), ("{}",)], "body string")
    with pytest.raises(PySparkException, match="document_id"):
        require_valid(df).collect()
    good = spark.createDataFrame([(json.dumps(VALID),)], "body string")
    assert require_valid(good).first()["tenant"] == "AAPL"


def test_bodies_round_trip(spark):
    row = [("D", "b", "k", 'T"x', "10-K", {"a": "é"})]
    schema = (
        "document_id string, s3_bucket string, s3_key string, tenant string, "
        "doc_type string, metadata map<string,string>"
    )
    typed = spark.createDataFrame(row, schema)
    assert split_messages(to_bodies(typed)).valid.collect() == typed.collect()


def test_company_is_the_first_match_in_any_case(spark):
    listed = spark.createDataFrame(
        [(0, "aapl", "320193", "Apple"), (1, "AAPL", "1", "Other"), (2, "BIG", "12345678901", "Big")],
        "pos int, ticker string, cik_str string, title string",
    )
    asked = spark.createDataFrame([("Aapl",), ("nope",), ("big",)], "ticker string")
    got = {r["ticker"]: (r["cik"], r["title"]) for r in catalogue.resolve_companies(asked, listed).collect()}
    assert got == {
        "Aapl": ("0000320193", "Apple"),
        "nope": (None, None),
        "big": ("12345678901", "Big"),
    }
    assert [r["ticker"] for r in catalogue.unknown_tickers(asked, listed).collect()] == ["nope"]


def test_latest_filing_is_exact_and_stops_at_the_shortest_array(spark):
    rows = [
        (1, ["8-K", "10-K/A", "10-K", "10-K"], ["a-1", "a-2", "a-3", "a-4"], ["p1", "p2", "p3", "p4"]),
        (2, ["8-K", "8-K", "10-K"], ["b-1", "b-2", "b-3"], ["q1", "q2"]),
        (3, [], [], []),
    ]
    feeds = spark.createDataFrame(
        rows, "c int, forms array<string>, accessions array<string>, documents array<string>"
    )
    got = {r["c"]: (r["accession"], r["primary_document"]) for r in catalogue.latest_filing(feeds).collect()}
    assert got == {1: ("a3", "p3"), 2: (None, None), 3: (None, None)}
    flat = feeds.select(
        F.col("c").alias("company"), F.posexplode(F.arrays_zip("forms", "accessions", "documents"))
    ).select("company", "pos", "col.*")
    flat = flat.withColumnsRenamed({"forms": "form", "accessions": "accession", "documents": "document"})
    latest = catalogue.latest_filing_rows(flat.where(F.col("document").isNotNull())).collect()
    assert [tuple(r) for r in latest] == [(1, "a3", "p3")]


def test_locations_and_messages(spark):
    row = [("aapl", "0000320193", "Apple", "0001", "doc.htm")]
    filings = spark.createDataFrame(
        row, "ticker string, cik string, title string, accession string, primary_document string"
    )
    located = catalogue.filing_locations(filings, "https://archive.example")
    first = located.first()
    assert first["document_id"] == "AAPL-10K-0001"
    assert first["s3_key"] == "AAPL/0001/doc.htm"
    assert first["archive_url"] == "https://archive.example/320193/0001/doc.htm"
    body = json.loads(to_bodies(catalogue.filing_messages(located, "raw")).first()["body"])
    assert body == {
        "document_id": "AAPL-10K-0001",
        "s3_bucket": "raw",
        "s3_key": "AAPL/0001/doc.htm",
        "tenant": "AAPL",
        "doc_type": "10-K",
        "metadata": {"company": "Apple", "accession": "0001"},
    }
