"""Readers of the archive's text and JSON inputs.

All rows keep an explicit arrival order: the file's path, where its split begins,
and the row's place in the split, so that "first" and "last" mean the same on any
number of tasks. Untrusted JSON becomes VARIANT; a bad line aborts.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import files
from ..functions import text, urls
from ..operators.checks import Violation

# Accepted key names, in order of preference.
URL_FIELDS = ["url", "original", "source_url", "request_url"]
ROW_LISTS = ["records", "requests", "rows", "items"]
FEED_LISTS = ["entries", "items", "requests"]
EXPORT_LISTS = ["records", "requests", "entries", "items", "results", "data"]
CDX_HEADER = ["original", "timestamp", "digest"]
MAX_QUEUE_LINE = 1_048_576

ATTACHMENTS = "array<struct<name:string,url:string,content_type:string,size:bigint,sha256:string>>"
REQUEST = f"request_id bigint, url_title string, title string, authority string, body_tag string, state string, html_captured boolean, attachments {ATTACHMENTS}, warc_record_ids array<string>, license string, attribution string, first_seen string, last_updated string, content_sha256 string"
META = "generated_at string, captured_at string, source string, instance_id string, jurisdiction string, version string, record_count bigint, schema string"


def _lines(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    arrival = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("row"))
    return reader.text(path).select("value", arrival.alias("arrival")).where(F.trim("value") != "")


def _is_object(value: Column) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(value), F.lit("OBJECT")), F.lit(False))


def _has(line: Column, key: str) -> Column:
    return F.coalesce(F.array_contains(F.json_object_keys(line), key), F.lit(False))


def read_jsonl(spark: SparkSession, path: str, glob: str | None = None, check: bool = True) -> DataFrame:
    """Objects of JSON lines: arrival, value (text), row (variant). Blank lines are skipped.

    A line that is no JSON object aborts, in an action of its own.
    """
    rows = _lines(spark, path, glob).withColumn("row", F.try_parse_json("value"))
    if check:
        bad = rows.where(F.col("row").isNull() | ~_is_object(F.col("row"))).limit(1).collect()
        if bad:
            raise Violation(f"no JSON object in {bad[0]['arrival']['file']}: {bad[0]['value'][:200]}")
    return rows


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Process events of a file or a folder of shards: typed columns and the canonical payload."""
    shards = "*.jsonl" if not path.endswith(".jsonl") else None
    rows = read_jsonl(spark, path, shards)
    if rows.isEmpty():
        raise Violation(f"no event lines found in {path}")
    get = lambda p, t="string": F.try_variant_get("row", p, t)
    line = F.col("value")
    structured = F.when(_has(line, "source_index"), get("$.source_index", "bigint")).when(_has(line, "source_order"), F.coalesce(get("$.source_order.event_sequence", "bigint"), get("$.source_order.sequence", "bigint"), get("$.source_order", "bigint")))
    return rows.select(
        "arrival",
        get("$.event_id").alias("event_id"),
        F.when(_has(line, "case_id"), get("$.case_id")).otherwise(get("$.logical_request_id")).alias("case_id"),
        get("$.activity").alias("activity"),
        F.coalesce(F.nullif(get("$.logical_event_id"), F.lit("")), get("$.event_id"), F.lit("")).alias("logical_id"),
        F.coalesce(get("$.revision", "bigint"), F.lit(1)).alias("revision"),
        get("$.operation").alias("operation"),
        F.coalesce(structured, F.lit(0)).alias("source_index"),
        text.request_sequence(get("$.source_order.request_sequence"), F.coalesce(get("$.case_id"), get("$.logical_request_id"))).alias("request_id"),
        get("$.contract_version").alias("contract_version"),
        F.to_json("row").alias("payload"),
    )


def event_files(spark: SparkSession, path: str) -> DataFrame:
    """Names of the shards that an event log is read from."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.jsonl").load(path)
    return files.select(F.substring_index("path", "/", -1).alias("file")).distinct()


def read_attachments(spark: SparkSession, path: str) -> DataFrame:
    """Attachment rows of JSON lines: ids, contract version, the usual fields, and the canonical payload."""
    get = lambda k, t="string": F.try_variant_get("row", f"$.{k}", t).alias(k)
    return read_jsonl(spark, path).select("arrival", get("case_id"), get("event_id"), get("contract_version"), get("name"), get("url"), get("content_type"), get("size", "bigint"), get("sha256"), F.to_json("row").alias("payload"))


def read_takedowns(spark: SparkSession, path: str) -> DataFrame:
    """Ids of a takedown list: per row the first of case_id, event_id, id that is a text and not blank."""
    rows = read_jsonl(spark, path)
    truthy = lambda k: F.when(~F.coalesce(F.try_variant_get("row", f"$.{k}", "string"), F.lit("")).isin("", "0", "false"), F.struct(F.schema_of_variant(F.try_variant_get("row", f"$.{k}", "variant")).alias("kind"), F.try_variant_get("row", f"$.{k}", "string").alias("id")))
    first = F.coalesce(truthy("case_id"), truthy("event_id"), truthy("id"))
    return rows.select(first.alias("f")).where("f.kind = 'STRING'").select("f.id").distinct()


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Distinct ids of completed ledger rows, as text."""
    rows = read_jsonl(spark, path)
    done = rows.where(F.try_variant_get("row", "$.status", "string") == "completed")
    return done.select(F.try_variant_get("row", "$.request_id", "string").alias("request_id")).where("request_id is not null").distinct()


def read_queue(spark: SparkSession, path: str) -> DataFrame:
    """Queued requests; a line over one MiB or without an id aborts."""
    lines = _lines(spark, path)
    if not lines.where(F.octet_length("value") > MAX_QUEUE_LINE).isEmpty():
        raise Violation(f"queue line exceeds {MAX_QUEUE_LINE} bytes")
    get = lambda k: F.try_variant_get("row", f"$.{k}", "string")
    rows = read_jsonl(spark, path).select("arrival", get("request_id").alias("request_id"), *[F.coalesce(get(k), F.lit("")).alias(k) for k in ("url_title", "title", "authority")])
    if not rows.where("request_id is null").isEmpty():
        raise Violation("queue row without request_id")
    return rows


def id_range(spark: SparkSession, first: int, last: int) -> DataFrame:
    """Requests of an inclusive id range."""
    return spark.range(first, last + 1).select(F.col("id").alias("request_id"))


def rehearsal(spark: SparkSession, n: int) -> DataFrame:
    """Placeholder requests of a rehearsal."""
    return spark.range(1, n + 1).select(F.col("id").alias("request_id"), F.concat(F.lit("dry-run-"), "id").alias("url_title"), F.concat(F.lit("Dry-run request "), "id").alias("title"), F.lit("dry-run").alias("state"))


def _documents(spark: SparkSession, path: str, glob: str | None = None, deep: bool = False) -> DataFrame:
    read = spark.read.text(path, wholetext=True, pathGlobFilter=glob, recursiveFileLookup=deep)
    return read.select(F.col("_metadata.file_path").alias("file"), F.regexp_replace("value", "^\ufeff", "").alias("value"))


def read_manifest(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """A manifest document: its one-row meta table and its requests."""
    doc = _documents(spark, path).select(F.from_json("value", f"struct<meta:struct<{', '.join(f'{a}:{b}' for a, b in (x.split() for x in META.split(', ')))}>,requests:array<struct<{', '.join(':'.join(x.split(' ', 1)) for x in REQUEST.split(', '))}>>>").alias("d"))
    return doc.select("d.meta.*"), doc.select(F.posexplode("d.requests").alias("row", "r")).select("row", "r.*")


def read_derived(spark: SparkSession, folder: str) -> DataFrame:
    """Request records of a derived folder: top-level *.json, and request folders with their sidecars.

    A request folder holds request.json, attachments.json, snapshot_meta.json and
    page.html; a numeric folder name stands in for a missing id. One pass over the
    folder groups files by their parent.
    """
    files = _documents(spark, folder, deep=True).withColumn("dir", F.regexp_extract("file", "^(.*)/[^/]*$", 1)).withColumn("name", F.regexp_extract("file", "([^/]*)$", 1))
    base = F.regexp_replace(F.lit(folder), "/+$", "")
    top = files.where(F.endswith("dir", base) & F.endswith("name", F.lit(".json")) & (F.col("name") != "request.json")).select("file", F.try_parse_json("value").alias("v"), F.lit(False).alias("html_captured"), F.lit(None).cast("string").alias("attachments"), F.lit(None).cast("string").alias("meta"))
    pick = lambda n: F.max(F.when(F.col("name") == n, F.col("value")))
    grouped = files.groupBy("dir").agg(pick("request.json").alias("request"), pick("attachments.json").alias("attachments"), pick("snapshot_meta.json").alias("meta"), F.bool_or(F.col("name") == "page.html").alias("html_captured")).where("request is not null")
    rows = top.unionByName(grouped.select(F.concat("dir", F.lit("/request.json")).alias("file"), F.try_parse_json("request").alias("v"), "html_captured", "attachments", "meta"))
    if not rows.where(F.col("v").isNull() | ~_is_object(F.col("v"))).isEmpty():
        raise Violation("request record must be an object")
    get = lambda k, t="string": F.try_variant_get("v", f"$.{k}", t)
    number = F.coalesce(get("request_id", "bigint"), get("id", "bigint"), F.nullif(F.regexp_extract("file", r"/([0-9]+)/request\.json$", 1), F.lit("")).try_cast("bigint"))
    if not rows.where(number.isNull()).isEmpty():
        raise Violation("request without an id in a folder that is not numeric")
    blank = lambda k: F.coalesce(get(k), F.lit("")).alias(k)
    warc = F.transform(F.filter(F.from_json(F.coalesce("meta", F.lit("{}")), "resources array<struct<warc_record_id:string>>")["resources"], lambda r: F.coalesce(r["warc_record_id"], F.lit("")) != ""), lambda r: r["warc_record_id"])
    return rows.select(number.alias("request_id"), blank("url_title"), blank("title"), blank("authority"), blank("body_tag"), blank("state"), F.coalesce(get("html_captured", "boolean"), "html_captured").alias("html_captured"), F.coalesce(F.from_json("attachments", ATTACHMENTS), F.from_json(F.to_json(F.try_variant_get("v", "$.attachments", "variant")), ATTACHMENTS), F.array().cast(ATTACHMENTS)).alias("attachments"), F.coalesce(warc, F.array().cast("array<string>")).alias("warc_record_ids"), get("license").alias("license"), get("attribution").alias("attribution"), get("first_seen").alias("first_seen"), get("last_updated").alias("last_updated"), get("content_sha256").alias("content_sha256"))


def _first_list(value: Column, keys: list[str]) -> Column:
    return F.coalesce(*[F.try_variant_get(value, f"$.{k}", "array<variant>") for k in keys])


def _document_rows(docs: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of documents (file, value): an array, an object with a list under one of the keys,
    one object, or JSON lines. An array of arrays has its header first: file, at, row."""
    parsed = docs.withColumn("v", F.try_parse_json("value"))
    lines = F.filter(F.split("value", "\r?\n"), lambda x: F.trim(x) != "")
    as_list = F.try_variant_get("v", "$", "array<variant>")
    # a parser that stops after the first value would take JSON lines for one object
    by_line = F.col("v").isNull() | ((F.size(lines) > 1) & F.forall(lines, lambda x: F.try_parse_json(x).isNotNull()))
    rows = F.when(by_line, F.transform(lines, lambda x: F.try_parse_json(x))).when(as_list.isNotNull(), as_list).otherwise(F.coalesce(_first_list(F.col("v"), keys), F.array("v")))
    parsed = parsed.select("file", rows.alias("rows")).withColumn("header", F.try_variant_get(F.get("rows", F.lit(0)), "$", "array<string>"))
    flat = parsed.select("file", "header", F.posexplode("rows").alias("at", "cell"))
    zipped = F.parse_json(F.to_json(F.map_from_arrays(F.slice("header", 1, F.least(F.size("header"), F.size(F.col("cells")))), F.slice("cells", 1, F.least(F.size("header"), F.size(F.col("cells")))))))
    flat = flat.withColumn("cells", F.try_variant_get("cell", "$", "array<string>"))
    flat = flat.where(F.col("header").isNull() | (F.col("at") > 0))
    return flat.select("file", "at", F.when(F.col("header").isNotNull(), zipped).otherwise(F.col("cell")).alias("row"))


def read_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a URL inventory in any accepted shape: url, synthetic, state, title. A row without an address aborts."""
    rows = _document_rows(_documents(spark, path), ROW_LISTS)
    get = lambda k, t="string": F.try_variant_get("row", f"$.{k}", t)
    plain = F.when(F.schema_of_variant("row") == "STRING", F.col("row").cast("string"))
    found = rows.select(F.coalesce(plain, *[get(k) for k in URL_FIELDS]).alias("url"), get("synthetic", "boolean").alias("synthetic"), get("state").alias("state"), get("title").alias("title"))
    if not found.where("url is null").isEmpty():
        raise Violation("inventory row has no supported URL field")
    return found


HISTORICAL = ["source", "evidence_role", "source_url", "source_record_id", "title", "authority", "state", "observed_at", "archive_digest"]


def _historical(rows: DataFrame, source: str, role: str, **columns: Column) -> DataFrame:
    blank = {c: F.lit("") for c in HISTORICAL}
    values = blank | {"source": F.lit(source), "evidence_role": F.lit(role)} | columns
    url = urls.discovery_url(values["source_url"], exact=True)
    out = rows.select("at", url.alias("source_url"), *[F.coalesce(values[c], F.lit("")).alias(c) for c in HISTORICAL if c != "source_url"])
    return out.where("source_url <> ''")


def _named(row: Column, *keys: str) -> Column:
    return F.coalesce(*[F.nullif(F.try_variant_get(row, f"$.{k}", "string"), F.lit("")) for k in keys])


def _feed_columns(row: Column, links: tuple[str, ...], titles: tuple[str, ...], bodies: tuple[str, ...], times: tuple[str, ...]) -> dict[str, Column]:
    link = _named(row, *links)
    body = F.coalesce(_named(row, *[f"{b}.name" for b in bodies], *[f"{b}.url_name" for b in bodies]), _named(row, *bodies))
    return {"source_url": link, "source_record_id": F.coalesce(_named(row, "id", "request_id"), link), "title": _named(row, *titles), "authority": body, "state": _named(row, "state", "status"), "observed_at": _named(row, *times)}


def read_morph(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.csv(path, header=True, multiLine=True, escape='"').withColumn("at", F.monotonically_increasing_id())
    col = lambda n: F.col(n) if n in rows.columns else F.lit(None).cast("string")
    return _historical(rows, "morph_io", "authoritative_discovery", source_url=F.coalesce(F.nullif(col("request_url"), F.lit("")), col("url")), source_record_id=col("request_url"), title=col("title"), authority=col("public_body_name"), state=F.coalesce(F.nullif(col("described_state"), F.lit("")), col("display_status")), observed_at=col("created_at"))


def read_cdx(spark: SparkSession, path: str) -> DataFrame:
    """Index rows as lists (short ones padded) or objects; the exact header is skipped, other kinds of rows too."""
    docs = _documents(spark, path).withColumn("rows", F.try_variant_get(F.try_parse_json("value"), "$", "array<variant>"))
    if not docs.where("rows is null").isEmpty():
        raise Violation("index export must be a JSON array")
    flat = docs.select(F.posexplode("rows").alias("at", "row")).withColumn("cells", F.try_variant_get("row", "$", "array<string>"))
    flat = flat.where(~((F.col("at") == 0) & F.coalesce(F.col("cells") == F.array(*[F.lit(h) for h in CDX_HEADER]), F.lit(False))))
    cell = lambda i, k: F.coalesce(F.get("cells", F.lit(i)), F.try_variant_get("row", f"$.{k}", "string"))
    digest = cell(2, "digest")
    return _historical(flat, "internet_archive_cdx", "historical_discovery_candidate", source_url=cell(0, "original"), source_record_id=digest, observed_at=cell(1, "timestamp"), archive_digest=digest)


def read_feed(spark: SparkSession, path: str, source: str = "alaveteli_feed_json") -> DataFrame:
    rows = _document_rows(_documents(spark, path), FEED_LISTS)
    return _historical(rows, source, "authoritative_discovery", **_feed_columns(F.col("row"), ("url", "link", "html_url"), ("title", "name"), ("authority", "public_body"), ("updated", "created_at")))


def read_atom(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.format("xml").option("rowTag", "entry").schema("id string, title string, updated string, published string, link struct<_href:string>").load(path).withColumn("at", F.monotonically_increasing_id())
    link = F.col("link._href")
    return _historical(rows, "alaveteli_atom", "authoritative_discovery", source_url=link, source_record_id=F.coalesce("id", link), title=F.col("title"), observed_at=F.coalesce("updated", "published"))


def read_structured(spark: SparkSession, path: str, source: str) -> DataFrame:
    """Official dataset or operator export: CSV, TSV or JSON rows that hold a public request address."""
    if path.lower().endswith((".csv", ".tsv")):
        table = spark.read.csv(path, header=True, multiLine=True, escape='"', sep="\t" if path.lower().endswith(".tsv") else ",")
        rows = table.select(F.monotonically_increasing_id().alias("at"), F.parse_json(F.to_json(F.struct("*"))).alias("row"))
    else:
        rows = _document_rows(_documents(spark, path), [k2 for k in EXPORT_LISTS for k2 in (k, f"{k}.records")])
    return _historical(rows, source, "authoritative_discovery", **_feed_columns(F.col("row"), ("source_url", "request_url", "url", "html_url", "link"), ("title", "subject", "name"), ("authority", "public_body", "public_body_name"), ("updated", "updated_at", "created_at")))


HISTORICAL_KINDS = {
    "morph": read_morph,
    "internet_archive_cdx": read_cdx,
    "alaveteli_feed_json": read_feed,
    "alaveteli_atom": read_atom,
    "official_dataset": lambda spark, path: read_structured(spark, path, "official_dataset"),
    "operator_export": lambda spark, path: read_structured(spark, path, "operator_export"),
}


def read_historical(spark: SparkSession, path: str, kind: str, doc: int = 0) -> tuple[DataFrame, DataFrame]:
    """Records of one historical source and a provenance row (digest, modification time, count)."""
    if kind not in HISTORICAL_KINDS:
        raise ValueError(f"unsupported historical source kind: {kind}")
    records = HISTORICAL_KINDS[kind](spark, path).withColumn("doc", F.lit(doc)).withColumnRenamed("at", "row")
    files = spark.read.format("binaryFile").load(path).select(F.lit(kind).alias("source"), F.col("path").alias("input_path"), F.sha2("content", 256).alias("sha256"), F.col("modificationTime").alias("retrieved_at"))
    return records, files.crossJoin(records.agg(F.count("*").alias("record_count")))


def read_replay(spark: SparkSession, records: str, raw: str, selection: DataFrame) -> DataFrame:
    """Records of a finished replay (key, content_sha256); records, raw files and the selection must agree exactly."""
    rows = read_jsonl(spark, records).select(F.try_variant_get("row", "$.key", "string").alias("key"), F.try_variant_get("row", "$.content_sha256", "string").alias("content_sha256"))
    files = spark.read.format("binaryFile").load(raw).select(F.regexp_extract("path", r"([^/]*?)(\.[^./]*)?$", 1).alias("key"), F.sha2("content", 256).alias("actual"))
    joined = rows.join(files, "key", "full_outer").join(selection.select("key", F.lit(True).alias("chosen")), "key", "full_outer")
    bad = joined.where(F.col("chosen").isNull() | ~F.coalesce(F.col("actual") == F.col("content_sha256"), F.lit(False)))
    if not bad.isEmpty() or not rows.groupBy("key").count().where("count > 1").isEmpty():
        raise Violation("replay records, raw files and selection differ")
    return rows


def registry(spark: SparkSession, rows: list[dict], ddl: str, *keys: str) -> DataFrame:
    """A small registry as a table; repeated keys abort."""
    seen = [tuple(r.get(k) for k in keys) for r in rows]
    if len(set(seen)) != len(seen):
        raise Violation(f"registry repeats {', '.join(keys)}")
    return spark.createDataFrame([tuple(r.get(c.split()[0]) for c in ddl.split(", ")) for r in rows], ddl)


def jurisdiction_rules(spark: SparkSession, document: dict) -> DataFrame:
    """Rules {jurisdictions: {name: [tags]}, default} as rows tag, jurisdiction, ord in file order."""
    names, default = document.get("jurisdictions"), document.get("default")
    if not isinstance(names, dict) or default not in names or any(not isinstance(t, list) for t in names.values()):
        raise Violation("jurisdiction rules need lists of tags and a known default")
    rows = [{"tag": t, "jurisdiction": n, "ord": i} for i, (n, tags) in enumerate(names.items()) for t in tags]
    return spark.createDataFrame([(r["tag"], r["jurisdiction"], r["ord"]) for r in rows], "tag string, jurisdiction string, ord int").select(text.body_tag(F.col("tag")).alias("tag"), "jurisdiction", "ord")


CHANGES = "bucket string, request_id bigint, url_title string, content_sha256 string, previous_sha256 string"


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a change document with their bucket, in no order; an absent document has none."""
    if not files.exists(spark, path):
        return spark.createDataFrame([], CHANGES)
    doc = _documents(spark, path).select(F.try_parse_json("value").alias("d"))
    if not doc.where(F.col("d").isNull() | ~_is_object(F.col("d"))).isEmpty():
        raise Violation("change document must be an object")
    entry = lambda k, t="string": F.try_variant_get("e", f"$.{k}", t).alias(k)
    parts = [doc.select(F.lit(b).alias("bucket"), F.explode(F.try_variant_get("d", f"$.{b}", "array<variant>")).alias("e")) for b in ("added", "updated", "removed")]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rows.select("bucket", entry("request_id", "bigint"), entry("url_title"), entry("content_sha256"), entry("previous_sha256"))


def read_package_lines(spark: SparkSession, path: str, label: str) -> DataFrame:
    """Objects of a package's NDJSON file: arrival, value, row. A missing file, and a line that is no object, abort under ``label``."""
    if not files.exists(spark, path):
        raise Violation(f"{label}: {path} is missing")
    try:
        return read_jsonl(spark, path)
    except Violation as error:
        raise Violation(f"{label}: {error}") from error


def read_catalogs(spark: SparkSession, path: str) -> DataFrame:
    """Catalogue archives below a path: path, bodies (JSON), provenance (JSON), problem (null for a good one)."""
    from .index_api import parse_catalog

    def run(batches):
        for batch in batches:
            out = []
            for at, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    found, origin = parse_catalog(body)
                    out.append((at, json.dumps(found, sort_keys=True), json.dumps(origin, sort_keys=True), None))
                except ValueError as error:
                    out.append((at, None, None, str(error)))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in (zip(*out, strict=True) if out else [[]] * 4)], ["path", "bodies", "provenance", "problem"])

    archives = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", "true").load(path)
    return archives.select("path", "content").mapInArrow(run, "path string, bodies string, provenance string, problem string")
