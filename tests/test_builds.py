import hashlib
import json
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from noticeworks.operators import builds, intake, legacy, records, state
from noticeworks.operators.contracts import ContractError
from noticeworks.sources import exports, files, raw

AT = datetime(2026, 2, 1, tzinfo=UTC)


def notices(spark, extra=()):
    rows = [("placsp", json.dumps({"atom_id": f"https://x/{i}", "tender_no": str(i), "title": f"t{i}", "updated": "2026-01-02T00:00:00Z", "status_code": s, "cpv": ["03000000", "99"], "buyer": "b"})) for i, s in enumerate(("PUB", "ADJ", "ZZZ"))]
    rows += [("ted", json.dumps({"ND": "9", "TI": "t", "amount": "5"})), *extra]
    return spark.createDataFrame(rows, "source string, payload_json string").withColumn("retrieved_at", F.lit(AT).cast("timestamp"))


def deletes(spark):
    return spark.createDataFrame([("https://x/5", "2026-01-03T00:00:00Z")], "ref string, deleted_at string").withColumn("retrieved_at", F.lit(AT).cast("timestamp"))


def test_chain_from_records_to_csv(spark, tmp_path):
    twice = notices(spark).unionByName(notices(spark).withColumn("retrieved_at", F.col("retrieved_at") + F.expr("INTERVAL 1 DAY")))
    assert builds.build_events(twice, deletes(spark), [], str(tmp_path / "silver")) == 5
    codes = spark.createDataFrame([("03000000", "a")], "cpv_code string, label string")
    found = builds.build_gold(spark, str(tmp_path / "silver"), str(tmp_path / "gold"), AT, codes)
    assert found["decisions"] == {"open": 1, "status_closed": 1, "insufficient_evidence": 1, "deleted": 1, "deadline_passed": 0}
    assert found["issues"] == 1 and found["codes"]["occurrences"] == 2 and found["codes"]["unmatched_codes"] == 1
    assert files.read_document(spark, str(tmp_path / "gold" / "gold_manifest.json")) == json.loads(json.dumps(found))
    assert files.read_document(spark, str(tmp_path / "gold" / "current_state_manifest.json"))["rows"] == {"current_state": 4, "current_state_issues": 1}
    dim = spark.createDataFrame([("03000000", "uno", "one", 1, None, True)], "cpv_code string, label_es string, label_en string, level int, parent_code string, is_leaf boolean")
    views = builds.register_views(spark, str(tmp_path / "gold"), dim)
    assert [(r.cpv_position, r.cpv_code, r.cpv_matched, r.label_es) for r in spark.table("opportunity_cpv").orderBy("cpv_position").collect()] == [(0, "03000000", True, "uno"), (1, "99", False, None)]
    rows = builds.export_views(views, str(tmp_path / "csv"))
    assert files.read_document(spark, str(tmp_path / "csv" / "manifest.json"))["files"]["opportunity_cpv"] == {"row_count": 2, "view": "opportunity_cpv"}
    assert builds.export_views(builds.register_views(spark, str(tmp_path / "gold")), str(tmp_path / "csv")) == rows
    assert not [p for p in (tmp_path / "csv").iterdir() if "staging" in p.name or "replaced" in p.name]
    assert rows == {"open_opportunities": 1, "opportunity_cpv": 2, "buyer_summary": 1, "cpv_summary": 2, "opportunities_monthly": 0}


def test_views_keep_their_contract(spark, tmp_path):
    builds.build_events(notices(spark), deletes(spark), [], str(tmp_path / "silver"))
    builds.build_gold(spark, str(tmp_path / "silver"), str(tmp_path / "gold"), AT)
    opened = spark.read.parquet(str(tmp_path / "gold" / "open_opportunities"))
    for name, bad in (("type", opened.withColumn("estimated_value", F.col("estimated_value").cast("double"))), ("order", opened.select(*reversed(opened.columns))), ("twice", opened.unionByName(opened))):
        bad.write.parquet(str(tmp_path / name / "open_opportunities"))
        with pytest.raises(ContractError):
            builds.register_views(spark, str(tmp_path / name))
    twice = spark.createDataFrame([("03000000", "a"), ("03000000", "b")], "cpv_code string, label_es string")
    with pytest.raises(ContractError):
        builds.register_views(spark, str(tmp_path / "gold"), twice)


def test_a_failed_export_leaves_the_old_one(spark, tmp_path):
    views = {name: spark.createDataFrame([(1, 2, 3)], ", ".join(f"{c} int" for c in (order + ("x", "y"))[:3])) for name, order in exports.EXPORTS.items()}
    builds.export_views(views, str(tmp_path))
    before = files.read_document(spark, f"{tmp_path}/manifest.json")
    broken = views | {"opportunities_monthly": views["opportunities_monthly"].withColumn("x", F.raise_error(F.lit("no")))}
    with pytest.raises(Exception, match="no"):
        builds.export_views(broken, str(tmp_path))
    assert files.read_document(spark, f"{tmp_path}/manifest.json") == before and not [p for p in tmp_path.iterdir() if "staging" in p.name]
    assert spark.read.option("header", "true").csv(f"{tmp_path}/open_opportunities").count() == 1
    with pytest.raises(ContractError, match="missing"):
        builds.export_views({}, str(tmp_path))


def test_dimensions_are_resolved(spark, tmp_path):
    with pytest.raises(ContractError):
        builds.resolve_code_dimension(spark, None, str(tmp_path / "none"), str(tmp_path / "no.csv"))
    (tmp_path / "v.csv").write_text("code,nombre,name\n03000000,a,b\n03100000,c,d\n")
    assert [r.cpv_code for r in builds.resolve_code_dimension(spark, vocabulary=str(tmp_path / "v.csv")).collect()] == ["03000000", "03100000"]
    spark.createDataFrame([("1",), ("1",)], "cpv_code string").write.parquet(str(tmp_path / "bad"))
    with pytest.raises(ContractError):
        builds.resolve_code_dimension(spark, explicit=str(tmp_path / "bad"))
    assert builds.resolve_unit_dimension(spark, str(tmp_path / "none")) is None


def sheet(spark, scope, codes, path="u"):
    titles = {"A": "C_ID_UD_ORGANICA", "B": "C_DNM_UD_ORGANICA", "C": "C_ID_NIVEL_ADMON", "D": "N_NIVEL_JERARQUICO", "E": "C_ID_DEP_UD_SUPERIOR", "F": "C_ID_DEP_UD_PRINCIPAL", "G": "C_ID_ESTADO", "H": "D_VIG_ALTA_OFICIAL", "I": "NIF_CIF"}
    rows = [(path, 2, titles)] + [(path, i, {"A": c, "B": "n", "C": scope, "D": "1", "E": "EA0000001", "F": "EA0000001", "G": s, "H": "01/12/19"}) for i, (c, s) in enumerate(codes, 3)]
    return spark.createDataFrame(rows, "path string, row int, cells map<string,string>")


def test_units_of_all_scopes(spark, tmp_path):
    sheets = {"1": sheet(spark, "1", [("EA0000002", "V"), ("EA0000001", "E"), ("x", "V"), ("EA0000009", "Q")]), "2": sheet(spark, "2", [("EA0000003", "V")])}
    got = builds.build_units(sheets, str(tmp_path))
    assert got == files.read_document(spark, f"{tmp_path}/units_manifest.json")
    assert (got["row_count"], got["status_counts"], got["parents_unresolved"]) == (3, {"V": 2, "E": 1}, 0)
    assert got["scopes"]["1"] == {"accepted": 2, "rejected": 2, "rejection_reasons": {"invalid_dir3_code_format": 1, "invalid_status": 1}} and got["scopes"]["2"]["accepted"] == 1
    with pytest.raises(ContractError, match="EA0000002"):
        builds.build_units({"1": sheets["1"], "2": sheet(spark, "2", [("EA0000002", "V")])}, str(tmp_path / "twice"))


def test_file_manifest(spark, tmp_path):
    (tmp_path / "b.xml").write_bytes(b"yy")
    (tmp_path / "a.xml").write_bytes(b"x")
    got = files.file_manifest(raw.raw_files(spark, str(tmp_path))).collect()
    assert [(r.path[-5:], r.bytes, r.sha256) for r in got] == [(n, len(c), hashlib.sha256(c).hexdigest()) for n, c in (("a.xml", b"x"), ("b.xml", b"yy"))]


def test_records_of_every_source(spark):
    rows = [
        ("ted", {"ND": "1", "TI": {"spa": "Servicio en la nube"}, "estimated-value-lot": "", "amount": "1.234,5", "PC": ["72400000", "x"], "CY": "FR", "links": {"html": {"SPA": "s"}}}),
        ("placsp", {"tender_no": "2", "title": "t", "updated": "2026-01-02T00:00:00Z", "amount_tax_exclusive": 7.5, "amount_tax_exclusive_currency": "EUR", "amount_estimated_overall": 9.0, "cpv": ["48000000"], "region": "R", "status_code": "PUB"}),
        ("boe", {"item_id": "3", "titulo": "u", "department": "d"}), ("ted", {"ND": "1", "TI": "", "amount": "x"}),
    ]
    df = spark.createDataFrame([(s, json.dumps(p)) for s, p in rows], "source string, payload_json string")
    found = records.tender_records(df)
    got = found.collect()
    assert [(r.tender_id, r.title, r.amount, r.currency, r.country, r.url, r.cpv_main, r.region, r.status, r.buyer) for r in got] == [
        ("1", "Servicio en la nube", 1234.5, "EUR", "FR", "s", "72400000", None, None, None), ("2", "t", 7.5, "EUR", "ES", None, "48000000", "R", "PUB", None),
        ("3", "u", None, None, "ES", None, None, None, None, "d"), ("1", "", None, None, None, None, None, None, None, None),
    ]
    assert len(found.columns) == 15
    scored = records.scored(found)
    assert [(r.category, r.category_source, r.score) for r in scored.collect()] == [("Cloud", "keywords", 1), ("Software & Development", "cpv", 0), ("Other", "none", 0), ("Other", "none", 0)]
    marks = spark.createDataFrame([("ted", "1", 1, "boe", "3"), ("boe", "3", 1, "boe", "3")], "source string, tender_id string, group_no int, canonical_source string, canonical_id string")
    flat = {(r.source, r.title): r for r in records.opportunity_rows(scored, marks).collect()}
    assert (flat["ted", ""].is_canonical, flat["ted", ""].duplicate_of, flat["boe", "u"].is_canonical, flat["placsp", "t"].dup_group) == (False, "boe:3", True, None)
    bi = records.bi_rows(records.opportunity_rows(scored)).collect()
    assert [r.tender_id for r in bi][0] == "1" and bi[0].matched_keywords == "nube" and {r.published_date for r in bi} == {"", "2026-01-02"}
    assert sorted((r.record, r.rule) for r in records.record_issues(found).collect()) == [("1", "required_title"), ("1", "unique_source_tender_id")]
    gates = {r.metric: (r.value, r.passed) for r in records.record_quality(found, records.opportunity_rows(scored), 1).collect()}
    assert gates["title_null_share"] == (0.25, False) and gates["invalid_amount_share"][0] == 0.25 and gates["duplicate_keys"] == (1.0, False) and gates["duplicate_share"] == (0.25, True) and gates["technology_match_share"] == (0.25, True)
    with pytest.raises(Exception, match="unsupported source"):
        records.tender_records(spark.createDataFrame([("x", "{}")], df.schema)).collect()


def test_canonical_records_and_ties(spark):
    rows = [("r", None, "long title", "a", "s1"), ("r", datetime(2024, 1, 2).date(), "tt", "c", "s2"), ("r", datetime(2024, 1, 2).date(), "tt", "b", "s2"), ("q", None, "t", "x", "s2"), ("q", None, "t", "x", "s1")]
    df = spark.createDataFrame(rows, "root string, day date, title string, key string, source string")
    assert {(r.root, r.canonical) for r in legacy.canonical(df, "day", "title", "key", "source").collect()} == {("r", "b"), ("q", "x")}
    mart = legacy.mart_order(spark.createDataFrame([("b", "c", 1), ("a", "c", 1), ("z", "c", 5)], "buyer string, category string, records long"), *legacy.BUYER_ORDER)
    assert [r.buyer for r in mart.collect()] == ["z", "a", "b"]


def test_differing_contents_of_an_event_fail(spark, tmp_path):
    other = ("placsp", json.dumps({"atom_id": "https://x/0", "tender_no": "0", "title": "changed", "updated": "2026-01-02T00:00:00Z"}))
    with pytest.raises(ContractError, match="https://x/0@"):
        builds.build_events(notices(spark, [other]), deletes(spark), [], str(tmp_path / "silver"))


def test_state_does_not_depend_on_input_order(spark):
    events = builds.procurement_events(notices(spark), deletes(spark))
    want = {tuple(r) for r in state.current_state(events)[0].select("procedure_id", "event_id", "is_deleted").collect()}
    for seed in (1, 2):
        mixed = events.orderBy(F.rand(seed)).repartition(3)
        assert {tuple(r) for r in state.current_state(mixed)[0].select("procedure_id", "event_id", "is_deleted").collect()} == want


def test_gazette_levels_may_be_single_or_lists(spark):
    item = lambda n: {"identificador": f"B-{n}", "titulo": f"t{n}", "url_html": "u"}
    body = {"data": {"sumario": {"diario": [{"seccion": [{"codigo": "5A", "departamento": {"nombre": "d", "epigrafe": [{"item": item(1)}, {"item": [item(2), item(3)]}], "item": item(4)}}, {"codigo": "1", "departamento": []}]}]}}}
    days = spark.createDataFrame([("2024-01-01", json.dumps(body)), ("2024-01-02", "no json"), ("2024-01-03", None)], "day string, body string")
    assert sorted((r.day, r.section, r.department, r.item_id) for r in intake.gazette_items(days).collect()) == [("2024-01-01", "5A", "d", f"B-{n}") for n in (1, 2, 3, 4)]
    assert intake.gazette_items(days, sections=("1",)).count() == 0


@pytest.mark.parametrize(
    ("change", "reason"),
    [({}, None), ({"code": " "}, "missing_dir3_code"), ({"code": "1"}, "invalid_dir3_code_format"), ({"name": None}, "missing_name"), ({"status": "X"}, "invalid_status"), ({"scope": "2"}, "nivel_admin_mismatch"),
     ({"hierarchy": "a"}, "invalid_hierarchy_level"), ({"parent": None, "principal": None}, "missing_parent_dir3_code"), ({"principal": "E1"}, "invalid_principal_dir3_code"), ({"valid_from": "32/01/20"}, "invalid_valid_from_date"), ({"valid_from": None}, None)],
)
def test_unit_rows(spark, change, reason):
    row = {"code": "EA0000001", "name": "n", "status": "V", "scope": "1", "hierarchy": "2", "parent": "EA0000002", "principal": "E00000003", "valid_from": "01/12/19"} | change
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} string" for k in row))
    assert df.select(intake.unit_rejection("1").alias("r")).first().r == reason


def test_latest_snapshots_mark_ties(spark):
    rows = [("a", None, 1, "x"), ("a", None, 2, "y"), ("a", None, 2, "z"), ("b", "w", 1, "x"), ("b", "w", 1, "x")]
    got = intake.latest_snapshots(spark.createDataFrame(rows, "source string, part string, at long, sha string"), ["source"], "at", "sha").collect()
    assert {(r.source, r["at"], r.sha, r.tie) for r in got} == {("a", 2, "z", True), ("b", 1, "x", False)}


def test_duplicates_are_linked_across_sources(spark):
    day = lambda n: datetime(2024, 1, n).date()
    rows = [("1", "ted", "b", day(1), "suministro equipos red"), ("2", "boe", "b", day(8), "suministro equipos red"), ("3", "placsp", "b", day(9), "suministro equipos red"), ("4", "ted", "b", day(2), "obras carretera norte"),
            ("5", "ted", "b", None, "suministro equipos red"), ("6", "boe", "other", day(1), "suministro equipos red"), ("7", "ted", "b", day(3), "suministro equipos red")]
    df = spark.createDataFrame(rows, "key string, source string, block string, day date, title string")
    got = {r.key: (r.group_no, r.canonical) for r in builds.link_duplicates(df, 7, 0.75).collect()}
    assert got == {k: (1, "1") for k in ("1", "2", "3", "7")}


def test_groups_of_long_chains(spark):
    """A chain of any length is one group; null ends and links to oneself add nothing."""
    chain = [(f"a{(i * 7) % 401:03}", f"a{((i + 1) * 7) % 401:03}") for i in range(400)]
    links = spark.createDataFrame([*chain, *chain[:5], ("b2", "b1"), ("c", "c"), ("d", None), (None, None)], "a string, b string")
    found = {r.node: (r.root, r.group_no) for r in legacy.numbered_groups(legacy.link_groups(links)).collect()}
    assert found == {f"a{i:03}": ("a000", 1) for i in range(401)} | {"b1": ("b1", 2), "b2": ("b1", 2), "c": ("c", 3)}
