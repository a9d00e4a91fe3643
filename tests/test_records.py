"""Records of payloads that the tables at hand don't hold."""

import duckdb
import pytest
from pyspark.sql import functions as F

from noticeworks import catalogue
from noticeworks.operators import enrich, events, lineage, records
from noticeworks.session import in_parts

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def zeros(spark, tmp_path_factory):
    """The tables, with balances of 0."""
    folder = str(tmp_path_factory.mktemp("zeros"))
    for name in ("orders", "supplier"):
        spark.read.parquet(f"{SF}/{name}.parquet").coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    balance = F.when(F.col("c_custkey") % 7 == 0, 0.0).otherwise(F.col("c_acctbal")).alias("c_acctbal")
    customers = spark.read.parquet(f"{SF}/customer.parquet")
    customers.select(*(balance if c == "c_acctbal" else c for c in customers.columns)).coalesce(1).write.parquet(f"{folder}/customer.parquet")
    return folder


@pytest.mark.parametrize("name", ["tender_records", "silver_events"])
def test_a_zero_amount_is_an_amount(spark, zeros, name):
    c = duckdb.connect()
    for t in ("orders", "customer", "supplier"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{zeros}/{t}.parquet/*.parquet'")
    df = catalogue.queries()[name](spark, zeros)
    shown = lambda rows: sorted(map(repr, rows))
    want = c.execute(f"SELECT {', '.join(df.columns)} FROM ({catalogue.oracle_sql()[name]})").fetchall()
    assert shown(map(tuple, df.collect())) == shown(want)


def test_a_field_alone_counts_as_it_is(spark):
    payloads = ['{"tender_no": "1", "amount_tax_exclusive": 0, "summary": 0}', '{"tender_no": 0, "atom_id": "2", "amount_tax_exclusive": ""}']
    rows = records.tender_records(spark.createDataFrame([("placsp", p) for p in payloads], "source string, payload_json string"))
    assert sorted((r.tender_id, r.amount, r.summary) for r in rows.collect()) == [("1", 0.0, "0"), ("2", None, "")]


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString().lower()


@pytest.fixture(scope="module")
def some(spark):
    rows = [("ted", '{"ND": "1", "TI": "nube", "PD": "2024-01-02", "amount": "x"}'), ("ted", '{"ND": "1", "TI": " "}'), ("boe", '{"item_id": "", "title": "red", "publication_date": "2024-01-02"}')]
    return records.tender_records(spark.createDataFrame(rows, "source string, payload_json string"))


def test_quality_counts_scored_records_in_one_pass(some):
    rows = records.scored(some)
    once, apart = records.record_quality(rows), records.record_quality(rows, records.opportunity_rows(rows))
    values = {r.metric: r.value for r in once.collect()}
    assert values == {"records": 3, "title_null_share": 0.3333, "publication_date_null_share": 0.3333, "invalid_amount_share": 0.3333, "technology_match_share": 0.6667, "duplicate_keys": 1, "duplicate_share": 0}
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, apart.collect()))
    assert _plan(once).count("logicalrdd") == 1


def test_issues_and_bi_rows_make_records_once(some):
    issues = records.record_issues(some)
    assert "from_json" not in _plan(issues)
    assert sorted(map(tuple, issues.collect())) == [("1", "required_title"), ("1", "unique_source_tender_id"), ("<missing>", "required_tender_id")]
    rows = records.bi_rows(records.opportunity_rows(records.scored(some)))
    assert "from_json" not in _plan(rows)
    assert [r.technology_score for r in rows.collect()] == [1, 1, 0]


def test_acceptance_judges_each_payload_once(spark):
    plan = _plan(catalogue.queries()["acceptance"](spark, SF))
    assert "union" not in plan and "repartition" in plan  # one file is spread over all cores


def test_code_summary_takes_labels_last_and_holds_bounded_parts(spark):
    rows = spark.createDataFrame([(1, "B1", "A", "1.50"), (1, "B1", "B", "1.50"), (2, None, "A", "2.00")], "procedure_id long, buyer_id string, cpv_code string, v string")
    labels = spark.createDataFrame([("A", "first"), ("C", "third")], "code string, label string")
    found = enrich.code_summary(rows.withColumn("estimated_value", F.col("v").cast("decimal(20,2)")), labels)
    assert sorted((r.cpv_code, r.label, r.opportunities_count, r.buyers_count, str(r.total_estimated_value)) for r in found.collect()) == [("A", "first", 2, 1, "3.50"), ("B", None, 1, 1, "1.50")]
    assert in_parts(spark.range(1000), "id", rows=100).rdd.getNumPartitions() == 10


def test_vectors_hold_a_record_and_its_rare_shared_tokens(spark):
    rows = [("b", "k1", "x", 1, "red red azul uno"), ("b", "k2", "y", 2, "red azul dos"), ("c", "k3", "x", 1, "red uno")]
    found = lineage.vectors(spark.createDataFrame(rows, "block string, key string, source string, at int, title string"), 0.1)
    got = {r.key: ({x.token for x in r.vector}, set(r.rare), sum(x.w**2 for x in r.vector)) for r in found.collect()}
    assert {k: v[:2] for k, v in got.items()} == {"k1": ({"red", "azul", "uno"}, {"red", "azul"}), "k2": ({"red", "azul", "dos"}, {"red", "azul"}), "k3": ({"red", "uno"}, set())}
    assert all(abs(v[2] - 1) < 1e-9 for v in got.values())


def test_columns_are_projected_before_the_generator(spark):
    plan = _plan(events._once(spark.range(3), a=F.col("id") + 1).select("a", (F.col("a") * 2).alias("b")))
    assert "generate inline(array(_made" in plan
