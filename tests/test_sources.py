import hashlib
import io
import json
import zipfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from noticeworks.operators import events, state
from noticeworks.operators.contracts import EVENT_FIELDS, ContractError, assert_key, check, empty
from noticeworks.sources import exports, raw

FEED = """<feed xmlns="http://www.w3.org/2005/Atom" xmlns:at="http://purl.org/atompub/tombstones/1.0"
 xmlns:cbc="urn:dgpe:names:draft:codice:schema:xsd:CommonBasicComponents-2" xmlns:cac="urn:dgpe:names:draft:codice:schema:xsd:CommonAggregateComponents-2"
 xmlns:p="urn:dgpe:names:draft:codice-place-ext:schema:xsd:CommonAggregateComponents-2" xmlns:pb="urn:dgpe:names:draft:codice-place-ext:schema:xsd:CommonBasicComponents-2">
<at:deleted-entry ref="https://x/3" when="2026-02-03T00:00:00Z"/><at:deleted-entry when="2026-02-03T00:00:00Z"/>
<entry><id>https://x/1</id><title>Suministro de café \ufffd</title><summary>s</summary><updated> 2026-01-02T03:04:05.5+01:00 </updated><link href=" https://x/p/1 "/>
<p:ContractFolderStatus><cbc:ContractFolderID>F1</cbc:ContractFolderID><pb:ContractFolderStatusCode>PUB</pb:ContractFolderStatusCode>
<cac:Lot><cbc:ItemClassificationCode>99000000</cbc:ItemClassificationCode><cbc:ID schemeName="DIR3">L1</cbc:ID><cbc:CityName>Elsewhere</cbc:CityName><cbc:CountrySubentity>No</cbc:CountrySubentity>
<cbc:TaxExclusiveAmount currencyID="EUR">7</cbc:TaxExclusiveAmount></cac:Lot>
<cac:Party><cac:PartyIdentification><cbc:ID schemeName="NIF">N1</cbc:ID></cac:PartyIdentification><cac:PartyIdentification><cbc:ID schemeName="DIR3">E1</cbc:ID></cac:PartyIdentification>
<cac:PartyName><cbc:Name>Buyer</cbc:Name></cac:PartyName><cac:PostalAddress><cbc:CityName>Madrid</cbc:CityName></cac:PostalAddress></cac:Party>
<cac:BudgetAmount><cbc:EstimatedOverallContractAmount currencyID="USD">5.000,00</cbc:EstimatedOverallContractAmount><cbc:TaxExclusiveAmount currencyID="EUR">1234.50</cbc:TaxExclusiveAmount></cac:BudgetAmount>
<cac:RequiredCommodityClassification><cbc:ItemClassificationCode>15000000</cbc:ItemClassificationCode></cac:RequiredCommodityClassification>
<cac:RequiredCommodityClassification><cbc:ItemClassificationCode>15000000</cbc:ItemClassificationCode></cac:RequiredCommodityClassification>
<cac:RealizedLocation><cbc:CountrySubentityCode>ES300</cbc:CountrySubentityCode></cac:RealizedLocation>
</p:ContractFolderStatus></entry>
<entry><id>no number</id><title>t</title></entry><entry><id>https://x/2</id></entry></feed>"""


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    top = tmp_path_factory.mktemp("raw")
    lines = [json.dumps({"ND": "1", "TI": {"eng": "b", "spa": "a"}, "PC": ["x", "x"], "amount": "1.234,5", "CY": "ESP", "PD": "2024-01-05Z"}).encode(), b"", b"[1]", b'{"a": NaN}', b'{"a": "\xff"}', b"{"]
    (top / "ted.JSONL").write_bytes(b"\n".join(lines))
    (top / "one.atom").write_text(FEED)
    (top / "bad.xml").write_text("<feed")
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("readme.txt", "x")
        z.writestr("a.atom", FEED)
        z.writestr("b.atom", "<x/>")
        z.writestr("c.xml", FEED)
    (top / "all.zip").write_bytes(out.getvalue())
    (top / "none.zip").write_bytes(b"PK?")
    for name, digest in (("one.atom", hashlib.sha256(FEED.encode()).hexdigest()), ("gone.atom", "0" * 64), ("bad.xml", "0" * 64)):
        evidence = {"source": "placsp", "raw_path": name, "sha256": digest, "retrieved_at": "2026-02-01T12:30:45+00:00", "partition": None, "window_start": None, "window_end": None, "version": 1}
        (top / f"{name}.provenance.json").write_text(json.dumps(evidence))
    return str(top)


def test_scan_locates_records_and_rejections(spark, folder):
    rows = raw.scan_folder(spark, folder).collect()
    name = lambda r: r["path"].rpartition("/")[2]
    found = {(name(r), r["member"], r["member_index"], r["locator"], r["kind"], r["reason"]) for r in rows}
    assert ("ted.JSONL", None, None, 1, "record", None) in found
    assert {(3, "expected_json_object"), (4, "invalid_json"), (5, "invalid_json"), (6, "invalid_json")} == {x[3::2] for x in found if x[0] == "ted.JSONL" and x[4] == "rejection"}
    feed = {("tombstone", 1, None), ("rejection", 2, "missing_tombstone_ref"), ("record", 1, None), ("rejection", 2, "invalid_atom_id"), ("rejection", 3, "missing_title")}
    assert {(x[4], x[3], x[5]) for x in found if x[0] == "one.atom"} == feed
    assert {(x[4], x[3], x[5]) for x in found if x[1] == "a.atom" and x[2] == 2} == feed
    assert ("all.zip", "b.atom", 3, None, "rejection", "expected_atom_feed") in found
    assert ("none.zip", None, None, None, "rejection", "invalid_zip") in found and ("bad.xml", None, None, None, "rejection", "invalid_xml") in found


def test_split_json_lines_equal_whole_files(spark, folder, tmp_path):
    """Lines are numbered alike when a file is cut into many splits, blank lines included."""
    lines = [b"" if i % 7 == 0 else b'{"a": "\xff"}' if i % 11 == 0 else b"[]" if i % 13 == 0 else json.dumps({"n": i, "b": "x" * (i % 90)}).encode() for i in range(3000)]
    (tmp_path / "a.jsonl").write_bytes(b"\n".join(lines) + b"\r\n")
    (tmp_path / "b.JSONL").write_bytes(b"\n\n{}")
    (tmp_path / "c.jsonl").write_bytes(b"")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        for place in (str(tmp_path), folder):
            want = []
            for path in Path(place).iterdir():
                if path.name.lower().endswith(".jsonl"):
                    want += [raw.parse_json_line(path.name, line, n) for n, line in enumerate(path.read_bytes().split(b"\n"), 1)]
            got = [(r["path"].rpartition("/")[2], *r[1:]) for r in raw.scan_json_lines(spark, place).collect()]
            assert sorted(map(str, got)) == sorted(str(x) for x in want if x[4] != "blank")
        assert raw.scan_json_lines(spark, str(tmp_path)).count() > 2000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_feed_fields_stand_in_their_places(spark, folder):
    row = raw.scan_folder(spark, folder).where("kind = 'record' AND path LIKE '%all.zip'").first()
    got = json.loads(row.payload_json)
    want = {"buyer_dir3": "E1", "buyer_nif": "N1", "city": "Madrid", "region": None, "nuts_code": "ES300", "cpv": ["15000000", "15000000"], "contract_folder_id": "F1", "_atom_file": "a.atom",
            "amount_estimated_overall": 5000.0, "amount_estimated_overall_raw": "5.000,00", "amount_tax_exclusive": 1234.5, "url": "https://x/p/1", "tender_no": "1"}
    assert {k: got[k] for k in want} == want and "amount_total" not in got


@pytest.mark.parametrize(
    ("payload", "value", "currency"),
    [
        ({"amount_estimated_overall": 500.0, "amount_estimated_overall_raw": "500", "amount_estimated_overall_currency": "USD", "amount_tax_exclusive": 100.0, "amount_tax_exclusive_currency": "EUR"}, "500.00", "USD"),
        ({"amount_estimated_overall": None, "amount_tax_exclusive": 100.0, "amount_tax_exclusive_currency": "EUR"}, None, None),
        ({"amount_tax_exclusive": 100.0, "amount_tax_exclusive_currency": "EUR"}, "100.00", "EUR"),
        ({"amount_tax_exclusive": 1e7, "amount_tax_exclusive_currency": "EUR"}, "10000000.00", "EUR"),
        ({"amount_tax_exclusive": 1.0, "amount_tax_exclusive_raw": "1e7"}, "10000000.00", None),
    ],
)
def test_feed_amounts(spark, payload, value, currency):
    text = json.dumps({"atom_id": "https://x/9", "title": "[Anulado] t", "updated": " 2026-01-02T03:04:05Z\n"} | payload)
    row = events.record_events(spark.createDataFrame([("placsp", text)], "source string, payload_json string").withColumn("retrieved_at", F.current_timestamp())).first()
    assert (None if row.estimated_value is None else str(row.estimated_value), row.currency) == (value, currency)
    assert row.event_id == "placsp:notice:https://x/9@2026-01-02T03:04:05+00:00" and row.title == "[Anulado] t"


def test_notices_by_their_own_types(spark):
    rows = [
        {"ND": 7, "TI": {"spa": "[Anulado] Obras"}, "amount": 0, "PC": "1", "procedure-identifier": ["a", " a"], "BI": ["b", "c"], "CY": ["ESP"], "links": {"html": {"FRA": "f", "SPA": "s"}}, "notice-type": "cn"},
        {"ND": "8", "TI": {"spa": ""}, "title": "not this one", "estimated-value-lot": "x", "amount": "5", "currency": "USD", "PC": [], "cpv": ["2", "2"]},
        {"ND": "9", "TI": [], "title": ["", "this"], "framework-maximum-value-lot": "1e3", "amount": 5, "currency": "USD", "CY": "FR", "url": "u"},
    ]
    df = spark.createDataFrame([("ted", json.dumps(r)) for r in rows], "source string, payload_json string").withColumn("retrieved_at", F.current_timestamp())
    got = {r.event_id[-1]: r for r in events.record_events(df).collect()}
    short = lambda r: (r.title, None if r.estimated_value is None else str(r.estimated_value), r.currency, r.cpv_codes, r.procedure_id, r.buyer_id, r.country, r.source_url, r.source_event_type)
    assert short(got["7"]) == ("[Anulado] Obras", "0.00", "EUR", ["1"], "ted:procedure:a", None, "ES", "s", "notice:cn")
    assert short(got["8"]) == (None, None, None, ["2"], None, None, None, None, "notice")
    assert short(got["9"]) == ("this", "1000.00", "USD", [], None, None, "FR", "u", "notice")


@pytest.mark.parametrize(
    ("payload", "reason"),
    [
        ('{"ND": "1", "TI": {"spa": "a \ufffd b"}}', None), ('{"ND": "1", "TI": {"spa": "[Anulado] Obras"}}', None), ('{"ND": "1", "TI": "a \\ud83d\\ude00"}', None), ('{"ND": "1", "TI": "a \\ud83d"}', "invalid_unicode_payload"),
        ('{"ND": "1", "TI": "a \\\\ud83d"}', None), ('{"ND": "[]", "TI": "{}"}', None), ('{"ND": [], "TI": "t"}', "missing_tender_id"), ('{"ND": "1", "TI": {"spa": ""}, "title": "t"}', "missing_title"),
    ],
)
def test_acceptance(spark, payload, reason):
    from noticeworks.operators import intake

    df = spark.createDataFrame([("ted", payload)], "source string, payload_json string")
    assert df.select(intake.rejection_reason(F.col("source"), F.col("payload_json")).alias("r")).first().r == reason


def test_accounting_and_strict(spark, folder):
    rows = raw.scan_folder(spark, folder)
    one = {r["path"].rpartition("/")[2]: r for r in raw.accounting(rows).collect()}["one.atom"]
    assert (one.accepted, one.rejected, one.control_errors, one.tombstones) == (1, 2, 1, 1)
    with pytest.raises(Exception, match="invalid|missing|expected"):
        raw.strict(rows).collect()


def test_evidence(spark, folder):
    issues = {r["path"].rpartition("/")[2]: r["issue"] for r in raw.evidence_issues(raw.raw_files(spark, folder), raw.sidecars(spark, folder)).collect()}
    assert issues == {"gone.atom": "orphan_sidecar", "bad.xml": "checksum_mismatch", "ted.JSONL": "missing_sidecar", "all.zip": "missing_sidecar", "none.zip": "missing_sidecar"}


def test_events_from_raw_to_decision(spark, folder):
    rows = raw.scan_folder(spark, folder).withColumn("retrieved_at", F.lit("2026-02-01 00:00:00").cast("timestamp"))
    rows = rows.where("path LIKE '%one.atom' OR path LIKE '%JSONL'")
    records = rows.where("kind = 'record'").select(F.when(F.col("path").endswith("JSONL"), "ted").otherwise("placsp").alias("source"), "payload_json", "retrieved_at")
    gone = rows.where("kind = 'tombstone'").select(F.col("record_id").alias("ref"), "deleted_at", "retrieved_at")
    found = events.procurement_events(records, gone)
    assert check(found, EVENT_FIELDS) == 3
    by_id = {r.event_id: r for r in found.collect()}
    assert set(by_id) == {"ted:notice:1", "placsp:notice:https://x/1@2026-01-02T02:04:05.500000+00:00", "placsp:tombstone-dated:1770076800000000:https://x/3"}
    ted = by_id["ted:notice:1"]
    assert (ted.title, ted.country, str(ted.estimated_value), ted.currency, ted.cpv_codes, str(ted.publication_date)) == ("a", "ES", "1234.50", "EUR", ["x"], "2024-01-05")
    entry = by_id["placsp:notice:https://x/1@2026-01-02T02:04:05.500000+00:00"]
    assert (entry.title, entry.status, entry.cpv_codes, str(entry.estimated_value), entry.currency, entry.publication_date) == ("Suministro de café \ufffd", "PUB", ["15000000"], "5000.00", "USD", None)
    assert (entry.buyer_id, entry.nuts_code, entry.source_url, entry.description) == ("E1", "ES300", "https://x/p/1", "s")
    current, issues = state.current_state(found)
    assert [r.reason for r in issues.collect()] == [state.NO_ID]
    opened, counts = state.open_opportunities(current, None)
    assert [r.procedure_id for r in opened.collect()] == ["placsp:procedure:https://x/1"]
    assert {r.decision: r.n for r in counts.collect()} == {"open": 1, "deleted": 1, "deadline_passed": 0, "status_closed": 0, "insufficient_evidence": 0}


def test_spreadsheet(spark, tmp_path):
    sheet = '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData><row r="2"><c r="B2" t="inlineStr"><is><t>code</t></is></c></row><row r="3"><c r="B3" t="s"><v>0</v></c><c r="C3"><v>7</v></c></row></sheetData></worksheet>'
    strings = '<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><si><t>E1</t></si></sst>'
    with zipfile.ZipFile(tmp_path / "u.xlsx", "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", sheet)
        z.writestr("xl/sharedStrings.xml", strings)
    rows = raw.sheet_rows(raw.raw_files(spark, str(tmp_path), ("xlsx",))).collect()
    assert [(r.row, r.cells) for r in rows] == [(2, {"B": "code"}), (3, {"B": "E1", "C": "7"})]


def test_exports(spark, tmp_path):
    df = spark.sql("SELECT * FROM VALUES ('b', NULL, array('x', 'é')), ('a', '', array()), (NULL, 'q\"', NULL) AS t(k, v, a)")
    exports.write_csv(df, str(tmp_path / "csv"), ("k",))
    text = "".join(p.read_text() for p in sorted((tmp_path / "csv").glob("part-*")))
    lines = [x for x in text.split("\n") if x and x != "k,v,a"]
    assert lines[0].startswith('a,"",') and lines[1] == 'b,,"[""x"",""é""]"' and lines[2] == ',"q""",'
    exports.write_json_lines(df, str(tmp_path / "json"))
    exports.write_parquet(df, str(tmp_path / "pq"), ("k",))
    assert spark.read.parquet(str(tmp_path / "pq")).count() == spark.read.text(str(tmp_path / "json")).count() == 3


def test_contract_is_enforced(spark):
    none = empty(spark, EVENT_FIELDS)
    assert check(none, EVENT_FIELDS) == 0
    with pytest.raises(ContractError):
        check(none.drop("title"), EVENT_FIELDS)
    with pytest.raises(ContractError):
        assert_key(spark.sql("SELECT * FROM VALUES (1), (1), (NULL) AS t(k)"), "k")
