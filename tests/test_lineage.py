"""Payloads by shape, duplicate groups and evaluation: against brute force."""

import json
import math
import random
from collections import Counter
from datetime import date, timedelta
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from noticeworks.functions import money, shapes
from noticeworks.operators import events, lineage, records

ODD = ["[x]", "{x}", "[Anulado] t", '["a"]', "{}", "[]", "", " padded \n", "0", "false", 'a"[b]"', 0, 0.0, 1.5, 12, 1e3, True, False, None, [], {}, ["a", " b ", ""], [["n"]], [{"a": 1}], [1.5, 2], [None, "q"],
       {"spa": "uno", "eng": "two"}, {"eng": ["", "b"], "fra": "c"}, {"spa": ["x", "y"]}, {"spa": None, "fra": "f"}, {"spa": ""}, {"html": {"SPA": "s", "FRA": "f"}}, "7,25", "2024-01-02T03:04:05+01:00"]


def test_both_ways_of_reading_give_the_same(spark, monkeypatch):
    rng, rows = random.Random(5), []
    for _ in range(600):
        fields = {n: rng.choice(ODD) for n in events._READ if rng.random() < 0.4}
        rows.append((rng.choice(["ted", "placsp", "boe"]), json.dumps(fields, sort_keys=True, separators=rng.choice([(",", ":"), (", ", ": ")])), None))
    df = spark.createDataFrame(rows, "source string, payload_json string, retrieved_at timestamp").coalesce(1)
    by_shape = [events.record_events(df).collect(), records.tender_records(df).collect()]
    monkeypatch.setattr(shapes, "is_odd", lambda *_, **__: F.lit(True))
    assert by_shape == [events.record_events(df).collect(), records.tender_records(df).collect()]


def test_usual_payloads_are_not_odd(spark):
    usual = [{"TI": {"spa": "[Anulado] t", "eng": "x"}, "PC": ["1", "2"], "amount": 7.25, "links": {"html": {"SPA": "u"}}, "description-glo": {"spa": ["a, b"]}}, {"title": "x", "cpv": [], "amount_tax_exclusive": 0.5, "buyer": None}]
    odd = [{"title": "[x]"}, {"title": 0}, {"cpv": [["1"]]}, {"cpv": {"a": "b"}}, {"amount_estimated_overall": None}, {"title": 1.5}, {"cpv": [1.5]}]
    df = spark.createDataFrame([(json.dumps(x),) for x in usual + odd], "p string").select("p", F.from_json("p", shapes.text_schema(events._READ)).alias("f"))
    found = df.select(shapes.is_odd(F.col("p"), F.col("f"), events._READ, exact=("amount", "amount_tax_exclusive"), present=("amount_estimated_overall",), listed=("cpv",))).collect()
    assert [r[0] for r in found] == [False] * len(usual) + [True] * len(odd)


@pytest.mark.parametrize(("value", "amount"), [("12d", None), ("1.5f", None), ("0x1p3", None), ("1_000", 1000.0), ("1__0", None), ("_1", None), ("٣٫", None), ("٣٤", 34.0), ("1.234,5", 1234.5), ("+7", 7.0), ("-1", None), ("1e400", None), ("inf", None), (" 1 000 ", 1000.0), (".5", 0.5), ("5.", 5.0), ("e5", None), ("", None), (None, None)])
def test_lenient_amounts(spark, value, amount):
    from noticeworks.sources.raw import amount_of

    assert spark.createDataFrame([(value,)], "x string").select(money.lenient_amount(F.col("x"))).first()[0] == amount
    if value is not None and "inf" not in value and value != "1e400":
        assert amount_of(value) == amount


def tokens_of(title):
    return [w for w in "".join(c if c.isalnum() else " " for c in title.lower()).split() if len(w) > 2]


def brute_links(rows, window, threshold):
    """Candidate, evaluated and linked pairs of (key, source, block, day, title)."""
    near = lambda x, y: x[2] == y[2] and x[1] != y[1] and x[3] and y[3] and abs((x[3] - y[3]).days) <= window
    pairs = [(x, y) for x, y in combinations(sorted(rows), 2) if near(x, y)]
    some = {r for p in pairs for r in p}
    sizes, often = Counter(r[2] for r in some), Counter((r[2], t) for r in some for t in set(tokens_of(r[4])))

    def vector(r):
        v = {t: (1 + n) * math.log((1 + sizes[r[2]]) / (1 + often[r[2], t])) + 1 for t, n in Counter(tokens_of(r[4])).items()}
        norm = math.sqrt(sum(w * w for w in v.values()))
        return {t: w / norm for t, w in v.items()}

    vectors = {r: vector(r) for r in some}
    scored = [(x, y) for x, y in pairs if vectors[x] and vectors[y]]
    links = {(x[0], y[0]) for x, y in scored if round(sum(w * vectors[y].get(t, 0) for t, w in vectors[x].items()), 12) >= threshold}
    return pairs, scored, links, some


@pytest.mark.parametrize(("window", "threshold"), [(7, 0.75), (0, 0.5), (30, 0.95), (3, 0.2)])
def test_links_and_counts_equal_brute_force(spark, window, threshold):
    rng = random.Random(window)
    words = "obra pública servidor red nube software suministro energía lote contrato".split()
    rows = []
    for i in range(150):
        day = date(2024, 1, 1) + timedelta(days=rng.randint(0, 25)) if rng.random() < 0.9 else None
        title = " ".join(rng.choice(words) for _ in range(rng.randint(0, 6)))
        rows.append((f"k{i:03}", rng.choice(["ted", "placsp", "boe"]), rng.choice(["hot"] * 5 + ["a", "b"]), day, title))
    df = spark.createDataFrame(rows, "key string, source string, block string, day date, title string")
    pairs, scored, links, some = brute_links(rows, window, threshold)
    found, compared = lineage.similar_pairs(df, window, threshold)
    assert {(r.a, r.b) for r in found.collect()} == links and compared.count() <= len(scored)
    assert {r.key for r in lineage.involved(df, window).collect()} == {r[0] for r in some}
    assert lineage.pair_count(df, window).first()[0] == len(pairs)
    ids = df.withColumn("tender_id", F.col("key")).withColumn("size", F.length("title"))
    assigned, stats = lineage.duplicate_groups(ids, window, threshold)
    one = stats.first()
    assert (one.candidate_pairs, one.evaluated_pairs, one.linked_pairs, one.records_without_date) == (len(pairs), len(scored), len(links), sum(r[3] is None for r in rows))
    assert one.duplicated_records == assigned.count() - one.linked_groups and one.linked_groups == assigned.select("group_no").distinct().count()
    with pytest.raises(ValueError, match="above 0"):
        lineage.similar_pairs(df, window, 0)


def test_few_pairs_of_a_hot_block_are_compared(spark):
    """A block of one day, whose titles share common words: pairs by rare tokens alone."""
    rows = spark.range(1200).select(
        F.format_string("k%05d", "id").alias("key"), F.when(F.col("id") % 2 == 0, "ted").otherwise("placsp").alias("source"), F.lit("hot").alias("block"), F.lit("2024-01-01").cast("date").alias("day"),
        F.concat(F.lit("contrato de obras expediente número "), (F.col("id") / 2).cast("int").cast("string"), F.lit("xx")).alias("title"),
    )
    found, compared = lineage.similar_pairs(rows, 7, 0.75)
    assert lineage.pair_count(rows, 7).first()[0] == 360_000 and found.count() == 600 and compared.count() < 2000


def test_groups_reach_the_records(spark):
    payloads = [
        ("ted", {"ND": "1", "TI": {"spa": "Obras del puente viejo"}, "buyer": "Villa de X", "PC": ["45233000"], "PD": "2024-01-01"}),
        ("placsp", {"tender_no": "2", "title": "obras del puente viejo", "buyer": "VILLA DE X", "cpv": ["45000000"], "updated": "2024-01-05T00:00:00Z"}),
        ("placsp", {"tender_no": "3", "title": "obras del puente viejo", "buyer": "VILLA DE X", "cpv": ["30000000"], "updated": "2024-01-05T00:00:00Z"}),
        ("boe", {"item_id": "4", "title": "Obras del puente viejo!", "buyer": "villa de x", "publication_date": "2024-01-02"}),
    ]
    df = spark.createDataFrame([(s, json.dumps(p)) for s, p in payloads], "source string, payload_json string")
    scored = records.scored(records.tender_records(df))
    assigned, stats = lineage.duplicate_groups(lineage.linkable(scored))
    got = {r.tender_id: (r.dup_group, r.is_canonical, r.duplicate_of) for r in lineage.assigned_opportunities(scored, assigned).collect()}
    assert got == {"1": (1, True, None), "2": (1, False, "1"), "3": (None, True, None), "4": (None, True, None)}
    assert stats.first().asDict() == {"candidate_pairs": 1, "evaluated_pairs": 1, "compared_pairs": 1, "linked_pairs": 1, "linked_groups": 1, "duplicated_records": 1, "records_without_date": 0}


def test_evaluation_against_codes(spark):
    rows = [("48000000", "Software & Development", "keywords"), ("48000000", "Cloud", "keywords"), ("72415000", "Cloud", "cpv"), ("72300000", "Other", "none"), (None, "Cloud", "keywords"), ("15000000", "Cloud", "keywords"), ("30200000", "Cybersecurity", "keywords")]
    got = {r.category: r for r in lineage.code_evaluation(spark.createDataFrame(rows, "cpv_main string, category string, category_source string")).collect()}
    short = lambda r: (r.precision, r.recall, r.f1, r.support)
    assert short(got["Software & Development"]) == (1.0, 0.5, 0.6667, 2) and short(got["Cloud"]) == (0.0, 0.0, 0.0, 0) and short(got["Data & Analytics"]) == (0.0, 0.0, 0.0, 1)
    one = got["Cloud"]
    assert (one.evaluated_records, one.total_records, one.coverage, one.macro_f1, len(got)) == (4, 7, 0.5714, 0.1111, 6)
    none = lineage.code_evaluation(spark.createDataFrame([], "cpv_main string, category string, category_source string")).first()
    assert (none.total_records, none.coverage, none.macro_f1) == (0, 0.0, 0.0)
