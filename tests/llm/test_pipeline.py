"""The pipeline's stages against brute force on a small corpus, each on its own input."""

import os
from collections import Counter

import pytest

import corpus_pipeline
from noticeworks.llm import catalogue, packing
from noticeworks.llm.common import noting
from tests.llm.conftest import prose
from tests.llm.test_row_operators import measures
from tests.llm.test_text_operators import brute_components, check_packing, deleted_lines, shingles, spans_of


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    passage = prose(400, 72)
    texts = [prose(i, 60 + 5 * i) for i in range(30)]
    texts += [texts[3], texts[3], texts[5] + " more", passage + "\n" + prose(200, 40), prose(201, 40) + "\n" + passage, "too short", "again and again it says the same thing here\n" * 20, None, "", "password=hunter2hunter2 " + prose(202, 50)]
    top = tmp_path_factory.mktemp("sf")
    rows = [(i, t, ("en", "fr")[i % 2], f"s{i % 3}", len(t) if t is not None else None) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{top}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id long, quality int, toxic int").write.parquet(f"{top}/labels.parquet")
    return str(top)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, steps = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        docs.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        steps.append({r.doc_id: r for r in docs.collect()} if name != "best_fit_packing" else docs.collect())
        assert name == "best_fit_packing" or docs.columns == columns
    given = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    judged, deduped, single, clean, packed = steps
    failed = lambda t: measures(t)[0] < 10 or 100 * measures(t)[4] > 20 * measures(t)[0]
    assert set(judged) == {d for d, r in given.items() if not failed(r.text)}
    order = sorted(judged)
    gone = deleted_lines([(d, judged[d].text) for d in order], 50)
    left = {d for d, g in zip(order, gone, strict=True) if any(x.strip() for k, x in enumerate(judged[d].text.split("\n")) if k not in g)}
    assert set(deduped) == left and len(left) < len(order)
    for d, g in zip(order, gone, strict=True):
        if d not in left:
            continue
        assert deduped[d].text == "\n".join(x for k, x in enumerate(judged[d].text.split("\n")) if k not in g)
        assert deduped[d].n_chars == len(deduped[d].text) or not g
    want = brute_components([(d, r.text) for d, r in deduped.items()], catalogue.jaccard.Threshold(5, 80, 100))
    assert set(single) == {c for d, n, c in want if n} | {d for d, n, c in want if not n}
    assert all(len(shingles(single[d].text, 5)) == len(shingles(deduped[d].text, 5)) for d in single)
    assert set(clean) == set(single) and all(not spans_of(r.text) for r in clean.values())
    assert all(clean[d].text == single[d].text for d in clean if not spans_of(single[d].text))
    t = packing._tokenizer(packing.default_tokenizer())
    lengths = {d: len(t.encode(r.text, add_special_tokens=False).ids) + 1 for d, r in clean.items()}
    assert {d: sum(r.length for r in packed if r.doc_id == d) for d in lengths} == lengths
    assert all(r.length > 1 for r in packed)
    assert check_packing(None, packed, 4096) == packing.sequences_of(packing.plan_fillings(Counter(r.length for r in packed)))


def test_run_is_its_stages(spark, folder):
    assert corpus_pipeline.run(spark, folder).count() == spark.read.parquet(f"{folder}/best_fit_packing").count()


@pytest.mark.parametrize("name", ["op1_secret_ownership", "op2_url_filter", "op3_line_winnowing", "op6_chat_format", "op9_risk_controlled_quality"])
def test_oracles(spark, name):
    import duckdb

    sf, c = "/root/testdata/sf0.001", duckdb.connect()
    for x in os.listdir(sf):
        c.execute(f"CREATE VIEW {x.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{x}'")
    answer = c.execute(catalogue.oracle_sql()[name])
    columns = [d[0] for d in answer.description]
    df = catalogue.queries()[name](spark, sf)
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(str, (tuple(r) for r in df.select(columns).collect()))) == sorted(map(str, answer.fetchall()))


def test_native_operators_run_no_python(spark):
    for name in ("op1_secret_ownership", "op3_line_winnowing", "op6_chat_format", "op9_risk_controlled_quality", "op10_jump_sharding"):
        plan = catalogue.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow")), name


def test_stages_need_no_writing_between(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
    assert Counter(map(tuple, docs.collect())) == Counter(map(tuple, corpus_pipeline.run(spark, folder).collect()))


def test_results_stay_readable_beside_later_runs(spark, folder):
    """Two results of a session, one of them made in another thread at the same time."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(2) as pool:
        first, second = pool.map(lambda _: corpus_pipeline.run(spark, folder), range(2))
    third = corpus_pipeline.run(spark, folder)
    counts = [Counter(map(tuple, df.collect())) for df in (first, second, third, first)]
    assert counts[0] == counts[1] == counts[2] == counts[3] and counts[0]


def test_a_run_leaves_its_pieces_alone(spark, folder):
    with noting() as left:
        packed = corpus_pipeline.run(spark, folder)
    assert [name for path in left if os.path.exists(path) for name in os.listdir(path)] == ["pieces"]
    assert packed.count() > 0


@pytest.mark.parametrize("rows", [[], [(None, "the same words again and again " + prose(7, 60), None, None, None)] * 40 + [(None, None, "en", "s", 1), (3, "", "en", "s", 0), (4, prose(8, 9000), "en", "s", 1)] * 2])
def test_odd_documents(spark, folder, tmp_path, rows):
    """An empty table; repeated rows, null ids and texts, a long text; further columns."""
    docs = spark.createDataFrame([(*r, "mine") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, _key string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} == ({None, 4} if rows else set())
    assert not rows or sum(r.length for r in got if r.doc_id == 4) > 9000
