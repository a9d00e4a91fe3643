"""Typed events from accepted records and deletes, and their checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeworks.functions import jsonx, money, shapes, text, timex
from noticeworks.operators.contracts import EVENT_FIELDS

_NAMES = [f.name for f in EVENT_FIELDS]


#: Fixed: what event and procedure ids begin with.
NOTICES = {"ted": "ted:notice:", "placsp": "placsp:notice:", "boe": "boe:notice:"}
PROCEDURES = {"ted": "ted:procedure:", "placsp": "placsp:procedure:"}


def _event(rows: DataFrame, **columns: Column) -> DataFrame:
    """The contract's columns in order and type; those not given are null."""
    ddl = {f.name: f.kind for f in EVENT_FIELDS}
    return rows.select(*(columns.get(n, F.lit(None)).cast(ddl[n]).alias(n) for n in _NAMES))


#: Fixed: the payload fields of each column by source; of several the first truthy one counts.
TEXTS = {
    "id": {"ted": ("ND", "notice_id"), "placsp": ("atom_id",), "boe": ("item_id", "identificador")},
    "title": {"ted": ("TI", "title"), "placsp": ("title",), "boe": ("title", "titulo")},
    "description": {"ted": ("description-glo", "description"), "placsp": ("summary",), "boe": ("summary",)},
    "buyer_name": {"ted": ("buyer-name", "buyer"), "placsp": ("buyer",), "boe": ("buyer", "department")},
    "day": {"ted": ("PD", "publication_date", "publication-date"), "boe": ("publication_date",)},
    "url": {"ted": ("url",), "placsp": ("url",), "boe": ("url",)},
    "kind": {"ted": ("notice-type",)},
    "country": {"ted": ("CY", "country")},
    "updated": {"placsp": ("updated",)},
    "buyer_dir3": {"placsp": ("buyer_dir3",)},
    "status": {"placsp": ("status_code",)},
    "nuts": {"placsp": ("nuts_code",)},
}
CODES = {"ted": ("PC", "cpv"), "placsp": ("cpv",)}
PROCEDURE, BUYER = ("procedure-identifier", "BT-04-notice"), ("buyer-identifier", "BI")
LISTED = tuple(dict.fromkeys([n for names in CODES.values() for n in names] + [*PROCEDURE, *BUYER]))
#: Fixed: a notice's amount is the first of these that isn't null, even if it is invalid; a feed
#: entry's the first whose key is there, even if it is null.
TED_AMOUNTS = ("estimated-value-lot", "framework-maximum-value-lot", "amount")
FEED_AMOUNTS = ("amount_estimated_overall", "amount_tax_exclusive")
_READ = tuple(
    dict.fromkeys(
        [n for by in TEXTS.values() for names in by.values() for n in names] + [n for names in CODES.values() for n in names] + [*PROCEDURE, *BUYER, *TED_AMOUNTS, "currency", "links"]
        + [f"{n}{end}" for n in FEED_AMOUNTS for end in ("", "_raw", "_currency")]
    )
)


def _once(rows: DataFrame, **columns: Column) -> DataFrame:
    """rows with columns that later projections refer to; the optimizer can't copy them there,
    so each is computed once a row. They are projected first: a projection is compiled where a
    generator with functions over arrays isn't."""
    made = rows.select("*", F.struct(*(c.alias(n) for n, c in columns.items())).alias("_made"))
    return made.select(*rows.columns, F.inline(F.array("_made")))


_NAMES_OF_TEXTS = (*TEXTS, "amount", "currency")
_LISTS = ("codes", "procedure", "buyer")


#: Fields among which the first truthy one counts.
_ASKED = tuple(dict.fromkeys(n for by in (*TEXTS.values(), CODES) for names in by.values() if len(names) > 1 for n in names))


def _full(reader: shapes.Variants | shapes.Texts) -> Column:
    """An array of the asked fields, null where one isn't truthy."""
    return F.transform(F.array(*map(reader.value, _ASKED)), lambda x: F.when(reader.truthy(x), x))


def _picked(reader: shapes.Variants | shapes.Texts, full: Column) -> dict[str, Column]:
    """The fields that a payload's columns are made of, chosen by source."""
    source, at = F.col("source"), reader.value
    by_source = lambda choices: shapes.by_source(source, choices)

    def pick(names: tuple[str, ...]) -> Column:
        return at(names[0]) if len(names) == 1 else F.coalesce(*(F.get(full, F.lit(_ASKED.index(n))) for n in names))

    overall, exclusive = FEED_AMOUNTS
    chosen = lambda end: F.when(at(overall).isNotNull(), at(f"{overall}{end}")).otherwise(at(f"{exclusive}{end}"))
    given = F.coalesce(*(F.when(reader.given(at(n)), at(n)) for n in TED_AMOUNTS))
    found = {c: by_source({s: pick(names) for s, names in by.items()}) for c, by in (TEXTS | {"codes": CODES}).items()}
    found |= {"amount": by_source({"ted": given, "placsp": chosen("_raw")}), "currency": by_source({"ted": at("currency"), "placsp": chosen("_currency")})}
    found |= {f"{n}_{i}": at(x) for n, names in (("procedure", PROCEDURE), ("buyer", BUYER)) for i, x in enumerate(names)}
    return found | {"number": by_source({"placsp": chosen("")}), "link": by_source({"ted": at("links")})}


def _finished(reader: shapes.Variants | shapes.Texts, picked: dict[str, Column]) -> Column:
    """A struct of what the fields say: texts, lists of texts, a number's text, an address."""
    lists = [picked[n] for n in ("codes", *(f"{n}_{i}" for n, names in (("procedure", PROCEDURE), ("buyer", BUYER)) for i in range(len(names))))]
    number, link = reader.text(picked["number"]), reader.link(picked["link"])
    return F.struct(reader.shown(picked[c] for c in _NAMES_OF_TEXTS).alias("texts"), reader.items(lists).alias("lists"), number.alias("number"), link.alias("link"))


def record_events(records: DataFrame) -> DataFrame:
    """Events of accepted records: source, payload_json, retrieved_at. One pass over them: a
    payload of usual shape is read into texts at once, others by VARIANT, and each column
    chooses among the fields by source."""
    source, payload = F.col("source"), F.col("payload_json")
    by_source = lambda choices: shapes.by_source(source, choices)
    rows = records.select("source", "retrieved_at", "payload_json").where(source.isin(*NOTICES))
    rows = _once(rows, f=F.from_json(payload, shapes.text_schema(_READ)))
    texts = shapes.Texts(F.col("f"))
    odd = shapes.is_odd(payload, F.col("f"), _READ, exact=(*FEED_AMOUNTS, *TED_AMOUNTS), present=FEED_AMOUNTS[:1], listed=LISTED)
    rows = _once(rows, odd=F.coalesce(odd, F.lit(True)), full=_full(texts))
    picked = _picked(texts, F.col("full"))
    rows = _once(rows, picked=F.struct(*(x.alias(c) for c, x in picked.items())))
    usual = _finished(texts, {c: F.col(f"picked.{c}") for c in picked})

    def any_shape(f: Column) -> Column:
        reader = shapes.Variants(f)
        return money.let(_full(reader), lambda full: _finished(reader, _picked(reader, full)))

    by_variant = money.let(jsonx.fields(jsonx.payload(payload), _READ), any_shape)
    rows = _once(rows, found=F.when(F.col("odd"), by_variant).otherwise(usual)).select("source", "retrieved_at", "found.*")
    # codes, and what is published under two names for each of procedure and buyer
    listed = [F.get("lists", F.lit(0)), *(F.flatten(F.array_compact(F.slice("lists", i, 2))) for i in (2, 4))]
    rows = _once(rows, own_lists=F.transform(F.array(*listed), shapes.distinct), **{c: F.get("texts", F.lit(i)) for i, c in enumerate(_NAMES_OF_TEXTS)})
    rows = _once(rows.drop("texts"), **{f"all_{c}": F.get("own_lists", F.lit(i)) for i, c in enumerate(_LISTS)})
    # a feed's amount counts only beside its number, as published where that is there
    amount = F.when(source == "ted", F.col("amount")).when(F.col("number").isNotNull(), F.coalesce(F.col("amount"), F.col("number")))
    rows = _once(rows, exact=money.exact_amount(amount)["value"], instant=timex.aware_instant(F.col("updated")))
    one_of = lambda c: F.when(F.size(c) == 1, F.get(c, F.lit(0)))
    c = F.col
    return _event(
        rows,
        event_id=by_source({
            "ted": F.concat(F.lit(NOTICES["ted"]), c("id")),
            "placsp": F.concat(F.lit(NOTICES["placsp"]), c("id"), F.lit("@"), F.coalesce(timex.iso_marker(c("instant")), F.lit("undated"))),
            "boe": F.concat(F.lit(NOTICES["boe"]), c("id")),
        }),
        procedure_id=by_source({"ted": F.concat(F.lit(PROCEDURES["ted"]), one_of("all_procedure")), "placsp": F.concat(F.lit(PROCEDURES["placsp"]), c("id"))}),
        source=source,
        source_event_type=by_source({"ted": F.coalesce(F.concat(F.lit("notice:"), c("kind")), F.lit("notice")), "placsp": F.lit("notice_snapshot"), "boe": F.lit("notice")}),
        buyer_id=by_source({"ted": one_of("all_buyer"), "placsp": c("buyer_dir3")}),
        buyer_name=c("buyer_name"),
        title=c("title"),
        description=c("description"),
        cpv_codes=c("all_codes"),
        estimated_value=c("exact"),
        currency=F.when(c("exact").isNotNull(), F.coalesce(c("currency"), F.when(source == "ted", "EUR"))),
        publication_date=timex.lenient_date(c("day")),
        source_updated_at=c("instant"),
        status=c("status"),
        nuts_code=c("nuts"),
        country=F.when(source == "ted", text.country_code(c("country"))).otherwise(F.lit("ES")),
        source_url=F.coalesce(c("url"), c("link")),
        ingested_at=c("retrieved_at"),
    )


def tombstone_events(rows: DataFrame) -> DataFrame:
    """Deletes: dated ones carry their time in the id. ``ref``, ``deleted_at``, ``retrieved_at``."""
    at = timex.aware_instant(F.col("deleted_at"))
    dated = F.concat(F.lit("placsp:tombstone-dated:"), F.unix_micros(at).cast("string"), F.lit(":"), F.col("ref"))
    return _event(
        rows,
        event_id=F.coalesce(dated, F.concat(F.lit("placsp:tombstone:"), F.col("ref"))),
        procedure_id=F.concat(F.lit(PROCEDURES["placsp"]), F.col("ref")),
        source=F.lit("placsp"),
        source_event_type=F.lit("tombstone"),
        cpv_codes=F.array().cast("array<string>"),
        source_updated_at=at,
        ingested_at=F.col("retrieved_at"),
    )


def procurement_events(records: DataFrame, tombstones: DataFrame) -> DataFrame:
    """All events, a row per observation. ``records``: source, payload_json, retrieved_at."""
    return record_events(records).unionByName(tombstone_events(tombstones))


def money_issues(rows: DataFrame, amount: Column) -> DataFrame:
    """Rows whose amount can't be exact, with the reason; a build with any fails."""
    return rows.withColumn("issue", money.exact_amount(amount)["error"]).where("issue IS NOT NULL")
