"""The record lineage from payloads: source mappers, classification, rows for BI tools."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeworks.functions import jsonx, money, shapes, text, timex
from noticeworks.operators import legacy
from noticeworks.operators.events import _once
from noticeworks.session import cut

#: Fixed: the classifier's categories in order of preference, with their keywords.
CATEGORIES = [
    ("Cloud", ["cloud", "nube", "iaas", "paas", "saas"]),
    ("AI & Machine Learning", ["inteligencia artificial", "machine learning", "deep learning", "modelo de lenguaje", "nlp"]),
    ("Data & Analytics", ["big data", "data lake", "analitica", "business intelligence", "inteligencia de datos", "cuadro de mando"]),
    ("Cybersecurity", ["ciberseguridad", "seguridad de la informacion", "siem", "soc"]),
    ("Software & Development", ["software", "aplicacion", "desarrollo", "mantenimiento de sistemas", "mantenimiento de aplicaciones"]),
    ("Infrastructure & Hardware", ["servidor", "almacenamiento", "red", "hardware", "equipamiento informatico", "virtualizacion"]),
]
#: Fixed: code prefixes that name a category.
PREFIXES = [
    ("72415", "Cloud"), ("72514", "Cloud"), ("723", "Data & Analytics"), ("48", "Software & Development"), ("7221", "Software & Development"), ("7223", "Software & Development"),
    ("7226", "Software & Development"), ("7242", "Software & Development"), ("72413", "Software & Development"), ("302", "Infrastructure & Hardware"), ("324", "Infrastructure & Hardware"),
    ("325", "Infrastructure & Hardware"), ("5031", "Infrastructure & Hardware"), ("72411", "Infrastructure & Hardware"),
]
#: Fixed: quality gates (metric, operator, threshold).
GATES = [
    ("records", ">=", 1.0), ("title_null_share", "<=", 0.05), ("publication_date_null_share", "<=", 0.05), ("invalid_amount_share", "<=", 0.10),
    ("technology_match_share", ">=", 0.05), ("duplicate_keys", "<=", 0.0), ("duplicate_share", "<=", 0.35),
]

#: Fixed: payload fields of a record's columns by source; of several the first truthy one counts.
_TEXTS = {
    "tender_id": {"ted": ("ND", "notice_id"), "placsp": ("tender_no", "atom_id"), "boe": ("item_id", "identificador")},
    "title": {"ted": ("TI", "title"), "placsp": ("title",), "boe": ("title", "titulo")},
    "summary": {"ted": ("description-glo", "description"), "placsp": ("summary",), "boe": ("summary",)},
    "buyer": {"ted": ("buyer-name", "buyer"), "placsp": ("buyer",), "boe": ("buyer", "department")},
    "day": {"ted": ("PD", "publication_date", "publication-date"), "placsp": ("updated",), "boe": ("publication_date",)},
    "amount_text": {"ted": ("estimated-value-lot", "framework-maximum-value-lot", "amount"), "placsp": ("amount_tax_exclusive",)},
    "money": {"ted": ("currency",), "placsp": ("amount_tax_exclusive_currency",)},
    "place": {"ted": ("CY", "country")},
    "url": {"ted": ("url",), "placsp": ("url",), "boe": ("url",)},
    "code": {"ted": ("PC", "cpv"), "placsp": ("cpv",)},
    "buyer_id": {"placsp": ("buyer_dir3",)},
    "region": {"placsp": ("region",)},
    "status": {"placsp": ("status_code",)},
}
_READ = tuple(dict.fromkeys([n for by in _TEXTS.values() for names in by.values() for n in names] + ["links"]))
#: Fields among which the first truthy one counts; a field alone counts as it is, be it 0.
_ASKED = tuple(dict.fromkeys(n for by in _TEXTS.values() for names in by.values() if len(names) > 1 for n in names))


def tender_records(records: DataFrame) -> DataFrame:
    """One row per accepted record (source, payload_json): the 15 fields of its lineage.

    A feed's amount is the one without tax alone, its date that of its update; ``cpv_main`` is
    the first code. Title and summary are empty rather than null. An unknown source fails.
    """
    source = F.col("source")
    known = F.when(source.isin("ted", "placsp", "boe"), source).otherwise(F.raise_error(F.concat(F.lit("unsupported source: "), F.coalesce(source, F.lit("")))).cast("string"))
    payload = F.col("payload_json")
    rows = _once(records.select(known.alias("source"), "payload_json"), f=F.from_json(payload, shapes.text_schema(_READ)))

    def finished(reader: shapes.Variants | shapes.Texts, full: Column) -> Column:
        pick = lambda names: reader.value(names[0]) if len(names) == 1 else F.coalesce(*(F.get(full, F.lit(_ASKED.index(n))) for n in names))
        chosen = [shapes.by_source(source, {s: pick(names) for s, names in by.items()}) for by in _TEXTS.values()]
        return F.struct(reader.shown(chosen).alias("texts"), F.when(source == "ted", reader.link(reader.value("links"))).alias("link"))

    full = lambda reader: F.transform(F.array(*map(reader.value, _ASKED)), lambda x: F.when(reader.truthy(x), x))
    texts, any_shape = shapes.Texts(F.col("f")), shapes.Variants
    amounts = [n for names in _TEXTS["amount_text"].values() for n in names]
    rows = _once(rows, odd=F.coalesce(shapes.is_odd(payload, F.col("f"), _READ, exact=amounts), F.lit(True)), full=full(texts))
    by_variant = money.let(jsonx.fields(jsonx.payload(payload), _READ), lambda f: money.let(full(any_shape(f)), lambda x: finished(any_shape(f), x)))
    rows = _once(rows, found=F.when(F.col("odd"), by_variant).otherwise(finished(texts, F.col("full")))).select("source", "payload_json", "found.*")
    rows = _once(rows, **{c: F.get("texts", F.lit(i)) for i, c in enumerate(_TEXTS)})
    # null where the number is; what a payload holds as a number is taken as it is
    rows = _once(rows, amount=money.lenient_amount(F.col("amount_text")))
    empty = F.lit("")
    return rows.select(
        "source", F.coalesce("tender_id", empty).alias("tender_id"), F.coalesce("title", empty).alias("title"), F.coalesce("summary", empty).alias("summary"), "buyer",
        timex.lenient_date(F.col("day")).alias("published_date"), "amount",
        F.when(source == "ted", F.coalesce("money", F.when(F.col("amount").isNotNull(), "EUR"))).otherwise(F.col("money")).alias("currency"),
        F.when(source == "ted", F.col("place")).otherwise("ES").alias("country"), F.coalesce("url", F.col("link")).alias("url"),
        F.col("code").alias("cpv_main"), "buyer_id", "region", "status", F.col("payload_json").alias("raw"),
    )


def scored(records: DataFrame) -> DataFrame:
    """Records with matched_keywords, category, category_source and score, by title and summary."""
    searchable = text.fold(F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("summary", F.lit(""))))
    return legacy.classified(records.withColumn("_searchable", searchable), "_searchable", CATEGORIES, PREFIXES, "cpv_main").drop("_searchable")


def opportunity_rows(scored: DataFrame, assignments: DataFrame | None = None) -> DataFrame:
    """A record's fields beside its scoring and linkage fields: category, technology_score,
    matched_keywords, category_source, dup_group, is_canonical, duplicate_of.

    ``assignments``: source, tender_id, group_no and the canonical record's source and
    tender_id (``canonical_source``, ``canonical_id``). Records in no group are canonical.
    """
    rows = scored.withColumnRenamed("score", "technology_score")
    if assignments is None:
        return rows.select("*", F.lit(None).cast("int").alias("dup_group"), F.lit(True).alias("is_canonical"), F.lit(None).cast("string").alias("duplicate_of"))
    own = assignments.select(F.col("source").alias("_s"), F.col("tender_id").alias("_t"), "group_no", "canonical_source", "canonical_id")
    joined = rows.join(own, (F.col("source") == F.col("_s")) & (F.col("tender_id") == F.col("_t")), "left")
    first = F.col("group_no").isNull() | ((F.col("source") == F.col("canonical_source")) & (F.col("tender_id") == F.col("canonical_id")))
    other = F.when(~first, F.concat("canonical_source", F.lit(":"), "canonical_id"))
    return joined.select(*rows.columns, F.col("group_no").alias("dup_group"), first.alias("is_canonical"), other.alias("duplicate_of"))


def bi_rows(opportunities: DataFrame) -> DataFrame:
    """Rows for BI tools, best score first: keywords as one text, a missing date as an empty one."""
    shown = {"matched_keywords": F.array_join("matched_keywords", ", "), "published_date": F.coalesce(F.date_format("published_date", "yyyy-MM-dd"), F.lit(""))}
    # written before they are sorted: ranges are drawn from a sample, for which all would be made twice
    rows = cut(opportunities.select(*(shown[c].alias(c) if c in shown else F.col(c) for c in opportunities.columns)))
    return rows.orderBy(F.desc("technology_score"), "tender_id")


def quality_rules() -> dict[str, Column]:
    """Rules of a record for itself."""
    blank = lambda c: text.strip(F.coalesce(c, F.lit(""))) == ""
    return {"required_tender_id": blank("tender_id"), "required_source": blank("source"), "required_title": blank("title"), "non_negative_amount": F.col("amount") < 0}


def record_issues(records: DataFrame) -> DataFrame:
    """Broken rules: tender_id, rule. A repeated (source, tender_id) is one issue."""
    record = F.coalesce(F.nullif(F.col("tender_id"), F.lit("")), F.lit("<missing>"))
    # records are made once: keys and what they break serve both kinds of issues
    judged = cut(records.select("source", "tender_id", record.alias("_id"), legacy.broken_rules(quality_rules()).alias("_broken")))
    own = judged.select(F.col("_id").alias("record"), F.explode("_broken").alias("rule"))
    repeated = judged.groupBy("source", "tender_id").agg(F.count("*").alias("n")).where("n > 1")
    return own.unionByName(repeated.select(F.col("tender_id").alias("record"), F.lit("unique_source_tender_id").alias("rule")))


def invalid_amount() -> Column:
    """An amount is there but no number: of the first field that the payload has."""
    names = ("estimated-value-lot", "framework-maximum-value-lot", "amount")
    first = lambda f: F.coalesce(*(f[n] for n in names))
    given = money.let(money.let(jsonx.fields(jsonx.payload(F.col("raw")), names), first), lambda x: jsonx.is_given(x) & ~jsonx.as_text(x).isin("", "[]"))
    return F.coalesce(F.when(F.col("amount").isNull(), given), F.lit(False))  # few payloads are parsed again


def record_quality(records: DataFrame, opportunities: DataFrame | None = None, duplicated: int = 0) -> DataFrame:
    """One row per gate over all records: metric, value, operator, threshold, passed.

    Without ``opportunities`` the records are scored ones (``scored``), and one pass over them
    counts everything by key.
    """
    of = {
        "_t": text.strip(F.coalesce("title", F.lit(""))) == "",
        "_d": F.col("published_date").isNull(),
        "_a": invalid_amount(),
    }
    if opportunities is None:
        of["_m"] = F.col("score") > 0
    keys = records.groupBy("source", "tender_id").agg(F.count("*").alias("n"), *(F.count_if(c).alias(name) for name, c in of.items()))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    one = keys.agg(total("n").alias("records"), F.count_if(F.col("n") > 1).alias("duplicate_keys"), *(total(name).alias(name) for name in of))
    if opportunities is not None:
        one = one.join(F.broadcast(opportunities.agg(F.count_if(F.col("technology_score") > 0).alias("_m"))))  # a single row each
    n = F.col("records")
    shares = {"title_null_share": "_t", "publication_date_null_share": "_d", "invalid_amount_share": "_a", "technology_match_share": "_m"}
    metrics = one.select("records", "duplicate_keys", *(money.share(F.col(c), n).alias(name) for name, c in shares.items()), money.share(F.lit(duplicated), n).alias("duplicate_share"))
    return legacy.quality_gates(metrics, GATES)
