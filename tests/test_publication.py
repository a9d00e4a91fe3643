"""Publication of builds, units in Gold, contracts of views."""

import threading

import pytest
from pyspark.sql import functions as F

from noticeworks.operators import builds
from noticeworks.operators.contracts import ContractError
from noticeworks.sources import files, publication
from tests.test_builds import AT, deletes, notices


def test_a_build_that_fails_leaves_all_old_datasets(spark, tmp_path, monkeypatch):
    out, silver = str(tmp_path / "gold"), str(tmp_path / "silver")
    assert publication.current(spark, out) is None
    with pytest.raises(FileNotFoundError):
        publication.published(spark, out, "current_state")
    builds.build_events(notices(spark), deletes(spark), [], silver)
    codes = spark.createDataFrame([("03000000", "a")], "cpv_code string, label string")
    builds.publish_gold(spark, silver, out, AT, codes)
    first, names = publication.current(spark, out), ("current_state", "current_state_issues", "open_opportunities", "cpv_enriched")
    before = {n: publication.published(spark, out, n).collect() for n in names}
    twice = codes.union(codes)  # fails after the first datasets are written
    with pytest.raises(ContractError):
        builds.publish_gold(spark, silver, out, None, twice)
    assert publication.current(spark, out) == first and {n: publication.published(spark, out, n).collect() for n in names} == before
    assert files.names(spark, f"{out}/builds") == [first["folder"].rpartition("/")[2]]
    held = publication.published(spark, out, "current_state")
    builds.publish_gold(spark, silver, out, AT, codes)
    assert publication.current(spark, out)["number"] == 2 and held.collect() == before["current_state"]  # a reader of the build before goes on
    builds.publish_gold(spark, silver, out, AT, codes)
    assert len(files.names(spark, f"{out}/builds")) == publication.KEPT


def test_something_is_published_at_any_time(spark, tmp_path):
    """A reader beside builds sees one of them, whole, at every moment."""
    out, seen, stop = str(tmp_path), [], threading.Event()

    def build(n):
        with publication.publishing(spark, out) as folder:
            files.write_document(spark, f"{folder}/doc.json", {"n": n})

    def watch():
        while not stop.is_set():
            found = publication.current(spark, out)
            seen.append(found and found["number"])

    build(0)
    reader = threading.Thread(target=watch)
    reader.start()
    for n in range(1, 8):
        build(n)
    stop.set()
    reader.join()
    assert None not in seen and seen == sorted(seen) and publication.current(spark, out)["number"] == 8


def test_units_in_gold(spark, tmp_path):
    facts = spark.createDataFrame([(1, "E1"), (2, "E9"), (3, None), (4, "E1")], "procedure_id long, buyer_id string")
    unit = ("n", "1", 2, "E2", "E3", "V", "N")
    units = spark.createDataFrame([("E1", *unit), ("E2", *unit)], "code string, name string, scope string, hierarchy smallint, parent string, principal string, status string, nif string")
    got = builds.with_units(facts, units)
    assert {(r.procedure_id, r.buyer_dir3_matched, r.buyer_dir3_name) for r in got.collect()} == {(1, True, "n"), (2, False, None), (3, False, None), (4, True, "n")}
    assert builds.enrich.unit_coverage(got).first().asDict() == {"input_events": 4, "events_with_buyer_id": 3, "events_without_buyer_id": 1, "resolved_events": 2, "unresolved_events_with_buyer_id": 1}
    with pytest.raises(ContractError):
        builds.with_units(facts, units.union(units))
    silver = str(tmp_path / "silver")
    builds.build_events(notices(spark), deletes(spark), [], silver)
    manifest = builds.build_gold(spark, silver, str(tmp_path / "gold"), AT, units=units)
    assert manifest["units"]["input_events"] == manifest["open"] and manifest["units"]["dimension_rows"] == 2
    assert spark.read.parquet(str(tmp_path / "gold" / "buyer_enriched")).count() == manifest["open"]


def test_a_code_listed_twice_fails(spark):
    rows = spark.createDataFrame([("a", ["1", "2"]), ("b", ["1", "1"]), ("c", [])], "procedure_id string, cpv_codes array<string>")
    assert [r.procedure_id for r in builds.enrich.repeated_codes(rows).collect()] == ["b"]


def test_every_view_has_a_contract(spark, tmp_path):
    silver = str(tmp_path / "silver")
    builds.build_events(notices(spark), deletes(spark), [], silver)
    builds.build_gold(spark, silver, str(tmp_path / "gold"), AT)
    views = builds.register_views(spark, str(tmp_path / "gold"))
    assert set(views) == {*builds.VIEW_TYPES, "open_opportunities"}
    for name in builds.VIEW_TYPES:
        column = views[name].columns[-1]
        for bad in (views[name].withColumn(column, F.lit("x")), views[name].drop(column), views[name].select(*reversed(views[name].columns))):
            with pytest.raises(ContractError, match=name):
                builds.check_views(views | {name: bad})
