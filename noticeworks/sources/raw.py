"""Raw evidence: files with sidecars, JSON lines, Atom feeds, ZIP archives of feeds, spreadsheets.

Files are read by Spark's own sources, so any file system that Spark knows will do. JSON lines
are read in splits, feeds a file to a task, archives a member to a task; what can't be parsed
becomes a located rejection.
"""

from __future__ import annotations

import io
import itertools
import json
import lzma
import math
import re
import zipfile
import zlib
from collections.abc import Iterator
from datetime import datetime
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from noticeworks.session import cut

SIDECAR = ".provenance.json"
_SIDECAR_SCHEMA = "source string, raw_path string, sha256 string, retrieved_at string, partition string, window_start string, window_end string, version int"
_ROWS = "path string, member string, member_index int, locator int, kind string, record_id string, deleted_at string, payload_json string, reason string, scope string"


def raw_files(spark: SparkSession, folder: str, suffixes: tuple[str, ...] = ("jsonl", "xml", "atom", "zip")) -> DataFrame:
    """path, content, length of every raw file below a folder, by suffix in any case."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return found.where(F.lower("path").rlike(rf"\.({'|'.join(suffixes)})$")).select("path", "content", "length")


def sidecars(spark: SparkSession, folder: str) -> DataFrame:
    """The evidence beside each file: path of the file it speaks of, and its fields."""
    text = spark.read.option("pathGlobFilter", f"*{SIDECAR}").text(folder, wholetext=True, recursiveFileLookup=True)
    named = text.select(F.regexp_replace(F.col("_metadata.file_path"), re.escape(SIDECAR) + "$", "").alias("path"), F.from_json("value", _SIDECAR_SCHEMA).alias("e"))
    return named.select("path", "e.*")


def sidecar_error() -> Column:
    """The first rule that a sidecar breaks; null for a sound one."""
    return (
        F.when(~F.coalesce(F.col("version") == 1, F.lit(False)), "version")
        .when(~F.coalesce(F.col("source").rlike("^[a-z0-9][a-z0-9_-]*$"), F.lit(False)), "source")
        .when(~F.coalesce(F.col("sha256").rlike("^[0-9a-f]{64}$"), F.lit(False)), "sha256")
        .when(F.col("raw_path").isNull() | F.col("raw_path").rlike(r"^/|(^|/)\.\.?(/|$)|//"), "raw_path")
        .when(~F.coalesce(F.col("retrieved_at").rlike(r"([Zz]|[+-]\d{2}:?\d{2})$"), F.lit(False)), "retrieved_at")
        .when(F.col("window_start").isNull() != F.col("window_end").isNull(), "window")
    )


def evidence_issues(files: DataFrame, evidence: DataFrame) -> DataFrame:
    """Files without a sidecar, sidecars without a file, unsound sidecars, wrong digests."""
    own = files.select("path", F.sha2("content", 256).alias("_own"))
    both = own.join(evidence.withColumn("_error", sidecar_error()), "path", "full")
    issue = (
        F.when(F.col("version").isNull() & F.col("source").isNull() & F.col("sha256").isNull(), "missing_sidecar")
        .when(F.col("_own").isNull(), "orphan_sidecar")
        .when(F.col("_error").isNotNull(), F.concat(F.lit("invalid_"), F.col("_error")))
        .when(F.col("_own") != F.col("sha256"), "checksum_mismatch")
        .when(~F.col("path").endswith(F.concat(F.lit("/"), F.col("raw_path"))), "path_mismatch")
    )
    return both.select("path", issue.alias("issue")).where("issue IS NOT NULL")


def _row(path, member, index, locator, kind, record_id=None, deleted_at=None, payload=None, reason=None, scope=None):
    return (path, member, index, locator, kind, record_id, deleted_at, payload, reason, scope)


def _is_instant(text: str) -> bool:
    try:
        return datetime.fromisoformat(text.strip().replace("z", "Z")).utcoffset() is not None
    except (ValueError, OverflowError):
        return False


def _finite(text: str) -> float:
    value = float(text)
    if value in (float("inf"), float("-inf")):
        raise ValueError("not finite")
    return value


def _refuse(name: str):
    raise ValueError(name)


def parse_json_line(path: str, raw: bytes, number: int) -> tuple:
    """The line as a record with its payload's keys sorted, a located rejection or a blank."""
    if not raw.strip():
        return _row(path, None, None, number, "blank")
    try:
        value = json.loads(raw.decode("utf-8"), parse_constant=_refuse, parse_float=_finite)
        if not isinstance(value, dict):
            raise TypeError
        payload = json.dumps(value, sort_keys=True, ensure_ascii=False)
        payload.encode()
    except UnicodeEncodeError:
        return _row(path, None, None, number, "rejection", reason="invalid_unicode_payload", scope="record")
    except TypeError:
        return _row(path, None, None, number, "rejection", reason="expected_json_object", scope="record")
    except (ValueError, RecursionError):
        return _row(path, None, None, number, "rejection", reason="invalid_json", scope="record")
    return _row(path, None, None, number, "record", payload=payload)


def scan_json_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Records and rejections of the JSON lines below a folder, for files of any size.

    Files are read in Spark's splits, several tasks to a file. Lines are numbered within their
    split, and a split starts after the lines of those before it in its file; only one count a
    split meets the rows. The parsed rows are cut from their lineage first, so that counts and
    rows come from the same splits.
    """
    text = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.[jJ][sS][oO][nN][lL]").text(folder)
    lines = text.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("line"))
    columns = [x.split()[0] for x in _ROWS.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of, number = None, 0
        for batch in batches:
            rows, blocks = [], batch["block"].tolist()
            for path, block, line in zip(batch["path"], blocks, batch["line"], strict=True):
                number = number + 1 if of == (path, block) else 1
                of = (path, block)
                rows.append(parse_json_line(path, bytes(line), number))
            frame = pd.DataFrame(rows, columns=columns).astype({"member_index": "Int32", "locator": "Int32"})
            yield frame.assign(block=blocks)

    rows = cut(lines.mapInPandas(run, f"{_ROWS}, block long"))
    before = W.partitionBy("path").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    counts = rows.groupBy("path", "block").agg(F.max("locator").alias("n"))
    starts = counts.select("path", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    found = rows.where("kind <> 'blank'").join(starts, ["path", "block"])
    return found.withColumn("locator", (F.col("locator") + F.col("_start")).cast("int")).select(*columns)


#: Fixed: name spaces of feeds, and where the fields of a notice stand below its entry.
_SPACES = {
    "atom": "http://www.w3.org/2005/Atom",
    "at": "http://purl.org/atompub/tombstones/1.0",
    "cbc": "urn:dgpe:names:draft:codice:schema:xsd:CommonBasicComponents-2",
    "cac": "urn:dgpe:names:draft:codice:schema:xsd:CommonAggregateComponents-2",
    "place": "urn:dgpe:names:draft:codice-place-ext:schema:xsd:CommonAggregateComponents-2",
    "placeb": "urn:dgpe:names:draft:codice-place-ext:schema:xsd:CommonBasicComponents-2",
}
_PLACES = {
    "contract_folder_id": ".//place:ContractFolderStatus/cbc:ContractFolderID",
    "status_code": ".//placeb:ContractFolderStatusCode",
    "buyer": ".//cac:Party/cac:PartyName/cbc:Name",
    "city": ".//cac:PostalAddress/cbc:CityName",
    "nuts_code": ".//cac:RealizedLocation/cbc:CountrySubentityCode",
    "region": ".//cac:RealizedLocation/cbc:CountrySubentity",
}
_IDENTIFIERS, _SCHEMES = ".//cac:Party/cac:PartyIdentification/cbc:ID", {"DIR3": "buyer_dir3", "NIF": "buyer_nif"}
_CODES = ".//cac:RequiredCommodityClassification/cbc:ItemClassificationCode"
_AMOUNTS = {
    "amount_tax_exclusive": ".//cac:BudgetAmount/cbc:TaxExclusiveAmount",
    "amount_total": ".//cac:BudgetAmount/cbc:TotalAmount",
    "amount_estimated_overall": ".//cac:BudgetAmount/cbc:EstimatedOverallContractAmount",
}


def _text(node) -> str | None:
    return (node.text or "").strip() or None if node is not None else None


def amount_of(text: str) -> float | None:
    """What functions.money.lenient_amount makes of a published amount, infinity included."""
    t = re.sub(r"\s+", "", text)  # float() takes digits of any alphabet and underscores between them, and names of infinity
    last = max(t.rfind(","), t.rfind("."))
    if "," in t and "." in t:
        t = re.sub("[,.]", "", t[:last]) + "." + t[last + 1 :]
    elif "," in t:
        t = t.replace(",", ".")
    elif t.count(".") > 1:
        t = t.replace(".", "")
    try:
        number = float(t)
    except ValueError:
        return None
    return number if number >= 0 else None


def _entry_fields(entry) -> dict:
    """A notice's fields of one feed entry, each from its own place. An amount is there only
    where one is published: as a number (null if it is none), as text and with its currency."""
    fields = {name: _text(entry.find(f"atom:{name}", _SPACES)) or "" for name in ("title", "summary", "updated")}
    link = entry.find("atom:link", _SPACES)
    fields |= {"_source": "placsp", "atom_id": _text(entry.find("atom:id", _SPACES)), "url": (link.get("href") or "").strip() or None if link is not None else None}
    fields |= {name: _text(entry.find(place, _SPACES)) for name, place in _PLACES.items()}
    fields |= dict.fromkeys(_SCHEMES.values())
    for node in entry.iterfind(_IDENTIFIERS, _SPACES):
        if name := _SCHEMES.get(node.get("schemeName", "")):
            fields[name] = fields[name] or _text(node)
    fields["cpv"] = [t for t in map(_text, entry.iterfind(_CODES, _SPACES)) if t]
    for name, place in _AMOUNTS.items():
        node = entry.find(place, _SPACES)
        if text := _text(node):
            fields |= {name: amount_of(text), f"{name}_raw": text, f"{name}_currency": node.get("currencyID")}
    return fields


def parse_feed(path: str, content: bytes, member: str | None = None, index: int | None = None) -> Iterator[tuple]:
    """Deletes, then entries, each numbered from 1."""
    try:
        root = ElementTree.fromstring(content)
    except (ElementTree.ParseError, ValueError):
        yield _row(path, member, index, None, "rejection", reason="invalid_xml", scope="document")
        return
    if root.tag != f"{{{_SPACES['atom']}}}feed":
        yield _row(path, member, index, None, "rejection", reason="expected_atom_feed", scope="document")
        return
    for n, node in enumerate(root.iterfind("at:deleted-entry", _SPACES), 1):
        if ref := (node.get("ref") or "").strip():
            when = node.get("when")
            yield _row(path, member, index, n, "tombstone", ref, when)
            if when is not None and not _is_instant(when):
                yield _row(path, member, index, n, "rejection", ref, reason="invalid_tombstone_when", scope="control")
        else:
            yield _row(path, member, index, n, "rejection", reason="missing_tombstone_ref", scope="control")
    for n, entry in enumerate(root.iterfind("atom:entry", _SPACES), 1):
        fields = _entry_fields(entry)
        number = re.search(r"/(\d+)\s*$", fields["atom_id"] or "")
        reason = "invalid_atom_id" if not number else "missing_title" if not fields["title"] else None
        if reason:
            yield _row(path, member, index, n, "rejection", reason=reason, scope="record")
        elif any(isinstance(x, float) and not math.isfinite(x) for x in fields.values()):
            yield _row(path, member, index, n, "rejection", reason="non_finite_amount", scope="record")
        else:
            own = {"tender_no": number[1]} | ({"_atom_file": member} if member is not None else {})
            payload = json.dumps(fields | own, sort_keys=True, ensure_ascii=False)
            yield _row(path, member, index, n, "record", fields["atom_id"], payload=payload)


_MEMBERS = "path string, member string, member_index int, content binary, reason string"


def archive_members(archives: DataFrame) -> DataFrame:
    """The feeds of ZIP archives, a row each, numbered in the directory's order, or why there is
    none. A task holds an archive and one open member; members are rows before any is parsed."""

    def members(path: str, content: bytes) -> Iterator[tuple]:
        try:
            archive = zipfile.ZipFile(io.BytesIO(content))
        except zipfile.BadZipFile:
            yield path, None, None, None, "invalid_zip"
            return
        feeds = [(n, x) for n, x in enumerate(archive.infolist(), 1) if not x.is_dir() and x.filename.lower().endswith(".atom")]
        if not feeds:
            yield path, None, None, None, "no_atom_members"
        for n, info in feeds:
            try:
                yield path, info.filename, n, archive.read(info), None
            except (zipfile.BadZipFile, zlib.error, lzma.LZMAError, RuntimeError, NotImplementedError, OSError, EOFError):
                yield path, info.filename, n, None, "unreadable_zip_member"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                for row in members(path, bytes(content)):
                    yield pd.DataFrame([row], columns=[x.split()[0] for x in _MEMBERS.split(", ")]).astype({"member_index": "Int32"})

    return archives.select("path", "content").mapInPandas(run, _MEMBERS)


def scan(files: DataFrame) -> DataFrame:
    """Records, tombstones and rejections of feeds and archives, located: see _ROWS for the
    columns. Each feed is parsed in a task of its own, also those of one archive."""
    zipped = F.lower("path").endswith(".zip")
    feeds = files.where(~zipped & ~F.lower("path").endswith(".jsonl"))
    alone = feeds.select("path", F.lit(None).cast("string").alias("member"), F.lit(None).cast("int").alias("member_index"), "content", F.lit(None).cast("string").alias("reason"))
    every = alone.unionByName(archive_members(files.where(zipped)).repartition("path", "member_index"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            indices = batch["member_index"].astype("Int32")
            for path, member, index, content, reason in zip(batch["path"], batch["member"], indices, batch["content"], batch["reason"], strict=True):
                index = None if pd.isna(index) else int(index)
                found = parse_feed(path, bytes(content), member, index) if reason is None else [_row(path, member, index, None, "rejection", reason=reason, scope="document")]
                for rows in itertools.batched(found, 10_000):
                    frame = pd.DataFrame(rows, columns=[x.split()[0] for x in _ROWS.split(", ")])
                    yield frame.astype({"member_index": "Int32", "locator": "Int32"})

    return every.mapInPandas(run, _ROWS)


def scan_folder(spark: SparkSession, folder: str) -> DataFrame:
    """Everything below a folder: JSON lines in splits, feeds, archives."""
    return scan_json_lines(spark, folder).unionByName(scan(raw_files(spark, folder, ("xml", "atom", "zip"))))


def strict(rows: DataFrame) -> DataFrame:
    """rows, failing at the first rejection."""
    failed = F.raise_error(F.concat_ws(": ", F.col("path"), F.col("locator").cast("string"), F.col("reason"))).cast("string")
    return rows.withColumn("reason", F.when(F.col("kind") == "rejection", failed))


def accounting(rows: DataFrame, by: str = "path") -> DataFrame:
    """By file, or by source where rows have one: records parsed, accepted and rejected, document
    and control errors, tombstones, and whether nothing was rejected."""
    is_rejection = F.col("kind") == "rejection"
    counts = rows.groupBy(by).agg(
        F.count_if(F.col("kind") == "record").alias("accepted"),
        F.count_if(is_rejection & (F.col("scope") == "record")).alias("rejected"),
        F.count_if(F.col("scope") == "document").alias("document_errors"),
        F.count_if(F.col("scope") == "control").alias("control_errors"),
        F.count_if(F.col("kind") == "tombstone").alias("tombstones"),
        (F.count_if(is_rejection) == 0).alias("passed"),
    )
    return counts.withColumn("parsed", F.col("accepted") + F.col("rejected"))


def sheet_rows(files: DataFrame, header_row: int = 2) -> DataFrame:
    """Rows of the first sheet of spreadsheets: path, row, cells by column letter."""
    ns = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"

    def rows_of(content: bytes):
        archive = zipfile.ZipFile(io.BytesIO(content))
        shared = []
        if "xl/sharedStrings.xml" in archive.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{ns}t")) for si in ElementTree.fromstring(archive.read("xl/sharedStrings.xml")).iter(f"{ns}si")]
        sheet = min(n for n in archive.namelist() if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n))
        for row in ElementTree.fromstring(archive.read(sheet)).iter(f"{ns}row"):
            cells = {}
            for c in row.iter(f"{ns}c"):
                value, inline = c.find(f"{ns}v"), "".join(t.text or "" for t in c.iter(f"{ns}t"))
                text = inline if c.get("t") == "inlineStr" else value.text if value is not None else None
                if text is not None:
                    cells[re.sub(r"\d", "", c.get("r", "A"))] = shared[int(text)] if c.get("t") == "s" else text
            yield int(row.get("r", 0)), cells

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                found = [(path, n, cells) for n, cells in rows_of(bytes(content)) if n >= header_row]
                yield pd.DataFrame(found, columns=["path", "row", "cells"])

    return files.select("path", "content").mapInPandas(run, "path string, row int, cells map<string,string>")
