import pytest
from pyspark.sql import functions as F

from noticeworks.functions import codes, jsonx, money, text, timex


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("value", "amount", "error"),
    [("1.234,50", "1234.50", None), ("98000,00", "98000.00", None), ("1.005", None, "too_many_fraction_digits"), ("1.000", "1.00", None), ("1.000.000", "1000000.00", None),
     ("999999999999999999.99", "999999999999999999.99", None), ("1000000000000000000", None, "too_large"), ("-5", None, None), ("x", None, None), ("", None, None), (None, None, None)],
)
def test_exact_amount(spark, value, amount, error):
    found = one(spark, value, money.exact_amount)
    assert (None if found.value is None else str(found.value), found.error) == (amount, error)


@pytest.mark.parametrize(
    ("value", "micros"),
    [("2024-01-02T03:04:05Z", 1704164645000000), ("2024-01-02T03:04:05.5+01:00", 1704161045500000), ("20240102T030405Z", 1704164645000000), ("2024-01-02T03:04:05", None),
     ("2024-01-02", None), ("2024-13-02T00:00:00Z", None), ("", None), (None, None), ("2024-01-02T03z", 1704164400000000), ("2024-01-02_03:04:05+00:00", 1704164645000000),
     ("2024-01-02T03:04:05+00:00:30", 1704164615000000), ("2024-01-02T03:04:05.5-010000", 1704168245500000), ("2024-01-02T03:04:05-00:00:05", 1704164650000000), ("2024-01-02T03:04:05+00:00:75", None)],
)
def test_aware_instant(spark, value, micros):
    assert one(spark, value, lambda x: F.unix_micros(timex.aware_instant(x))) == micros


@pytest.mark.parametrize(("value", "stripped"), [("  a ", "a"), ("\x1ca b\t", "a b"), ("", ""), (None, None)])
def test_strip(spark, value, stripped):
    assert one(spark, value, text.strip) == stripped


def test_fold_and_words(spark):
    assert one(spark, "INTELIGENCIA Ártificial", text.fold) == "inteligencia artificial"
    assert one(spark, "la red local", lambda x: text.has_word(x, "Red")) and not one(spark, "ßred redes", lambda x: text.has_word(x, "red"))
    assert one(spark, "el ayuntamiento de la villa de x", text.block_key) == "ayuntamiento villa" and one(spark, None, text.block_key) == "sin-comprador"


@pytest.mark.parametrize(
    ("value", "shown"),
    [('{"t": "a"}', "a"), ('{"t": {"eng": "b", "spa": ""}}', ""), ('{"t": {"eng": ["", "b"], "fra": "c"}}', "b"), ('{"t": ["", " c "]}', "c"), ('{"t": null}', ""), ("{}", ""), ("no json", "")],
)
def test_localized(spark, value, shown):
    assert one(spark, value, lambda x: jsonx.localized(jsonx.payload(x), "t")) == shown


@pytest.mark.parametrize(("code", "level", "parent", "valid"), [("03000000", 1, None, True), ("03212211", 7, "03212210", True), ("30000000", 1, None, True), ("03210200", 5, "03210000", False), ("0321020", 6, "03210000", False), ("00000000", 1, None, False)])
def test_codes(spark, code, level, parent, valid):
    if len(code) == 8:
        assert one(spark, code, codes.level) == level and one(spark, code, codes.structural_parent) == parent
    assert one(spark, code, codes.is_valid) is valid


def test_as_of():
    assert timex.as_of_midnight("2026-06-30").isoformat() == "2026-06-30T00:00:00+00:00" and timex.as_of_midnight(None) is None
    with pytest.raises(ValueError):
        timex.as_of_midnight("20260630")


def test_stream_equals_one_batch(spark, tmp_path):
    """Batches out of order, with replays and with keys in few buckets: the state is that of one
    batch, for the latest event and for the first observation."""
    from noticeworks.streaming import latest

    rows = [(f"k{i % 7}", (i * 37) % 101 if i % 5 else None, f"e{i:03}", f"f{(i * 11) % 13}") for i in range(120)]
    schema = "k string, at long, id string, file string"
    for n in range(4):
        part = rows[n * 30 : n * 30 + 30] + rows[:10]
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"p{n}"))
    whole = spark.createDataFrame(rows, schema)
    provenance = F.struct("file", F.col("at").isNull(), "at", "id")
    for name, fold, run in (
        ("latest", latest.latest("k", "at", "id"), lambda s, o, c: latest.run_latest(s, o, c, "k", "at", "id")),
        ("first", latest.first_observation("k", provenance), lambda s, o, c: latest.run_first(s, o, c, "k", provenance)),
    ):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
        run(stream, str(tmp_path / name), str(tmp_path / f"{name}-cp")).awaitTermination(120)
        got = latest.read_state(spark, str(tmp_path / name), whole.schema, fold)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, fold(whole).collect()), key=str), name


@pytest.mark.parametrize(
    ("text", "value", "error"),
    [
        ("1e7", "10000000.00", None), ("1.0E7", "10000000.00", None), ("1.5e3", "1500.00", None), ("100e-2", "1.00", None), ("1000e-3", "1.00", None), ("12e-3", None, "too_many_fraction_digits"),
        ("0e99", "0.00", None), ("1e18", None, "too_large"), ("9.99e17", "999000000000000000.00", None), ("0.0000001e5", "0.01", None), ("1e400", None, "too_large"), ("inf", None, "too_large"),
        ("e5", None, None), ("1e", None, None), ("-1e2", None, None), ("+2.50", "2.50", None), (".5", "0.50", None), ("5.", "5.00", None), ("nan", None, None), ("", None, None), (None, None, None),
    ],
)
def test_exact_amounts(spark, text, value, error):
    row = one(spark, text, money.exact_amount)
    assert (None if row.value is None else str(row.value), row.error) == (value, error)


@pytest.mark.parametrize(
    ("value", "shown"),
    [
        ('{"t": {"spa": "[Anulado] Obras"}}', "[Anulado] Obras"), ('{"t": {"spa": "", "eng": "x"}}', ""), ('{"t": {"spa": null, "eng": ["", " y "]}}', "y"), ('{"t": ["", {"eng": "z"}]}', "z"),
        ('{"t": "{}"}', "{}"), ('{"t": 5}', "5"), ('{"t": null}', ""), ('{"u": 1}', ""),
    ],
)
def test_texts_by_their_own_type(spark, value, shown):
    assert one(spark, value, lambda x: jsonx.localized(jsonx.payload(x), "t")) == shown


@pytest.mark.parametrize(("value", "kept"), [('"[]"', True), ('"{}"', True), ("[]", False), ("{}", False), ('""', False), ("0", False), ("0.0", False), ("false", False), ('"false"', True), ("[0]", True), ("null", False), ('"0"', True), ("1e-3", True)])
def test_truthiness(spark, value, kept):
    assert one(spark, f'{{"t": {value}}}', lambda x: jsonx.truthy(jsonx.payload(x), "t")) is kept


def test_padded_instants(spark):
    assert one(spark, "\u00a0 2024-01-02T03:04:05+01:00\n", lambda x: timex.aware_instant(x).cast("string")) == "2024-01-02 02:04:05"
