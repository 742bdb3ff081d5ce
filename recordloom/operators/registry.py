"""Registries, selections and lookups: small dimension tables against larger ones."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls
from .checks import Violation, require_unique
from .manifest import jurisdiction_of


def requested(rows: DataFrame, wanted: list[str], key: str) -> DataFrame:
    """Rows of the wanted keys (all, if none are named); an unknown key aborts."""
    if not wanted:
        return rows
    known = {r[0] for r in rows.where(F.col(key).isin(wanted)).select(key).distinct().collect()}
    if missing := sorted(set(wanted) - known):
        raise Violation(f"unknown {key}: {', '.join(missing)}")
    return rows.where(F.col(key).isin(wanted))


def automation_targets(instances: DataFrame) -> DataFrame:
    """Enabled instances in order."""
    return instances.where(F.coalesce("enabled", F.lit(False))).orderBy("instance_id")


def tag_jurisdictions(bodies: DataFrame, rules: DataFrame, default: str = "OTHER") -> DataFrame:
    """One row per body (slug) and tag: slug, at, jurisdiction."""
    tags = bodies.select("slug", F.posexplode("tags").alias("at", "tag"))
    flat = tags.withColumn("tag", F.trim(F.regexp_replace(F.lower("tag"), "[^a-z0-9]+", " ")))
    return jurisdiction_of(flat, rules, "tag", default).select("slug", "at", "jurisdiction")


def body_jurisdictions(bodies: DataFrame, rules: DataFrame, default: str = "OTHER") -> DataFrame:
    """Jurisdiction per body: that of its first tag that has another than the default."""
    by = tag_jurisdictions(bodies, rules, default).groupBy("slug").agg(F.min_by("jurisdiction", F.struct((F.col("jurisdiction") == default).alias("d"), "at")).alias("jurisdiction"))
    return bodies.select("slug").distinct().join(by, "slug", "left").withColumn("jurisdiction", F.coalesce("jurisdiction", F.lit(default)))


def bodies_of(bodies: DataFrame, rules: DataFrame, wanted: str, order: str) -> DataFrame:
    """Bodies with any tag of the wanted jurisdiction, once by slug (the last wins), in order."""
    hit = tag_jurisdictions(bodies, rules).where(F.col("jurisdiction") == wanted).select("slug").distinct()
    last = bodies.groupBy("slug").agg(F.max_by(F.struct(*bodies.columns), order).alias("b")).select("b.*")
    return last.join(hit, "slug", "left_semi").orderBy("slug")


def body_labels(bodies: DataFrame) -> DataFrame:
    """Slug and name of bodies with the accepted stand-ins; bodies without either are dropped."""
    pick = lambda *names: F.coalesce(*[F.nullif(F.trim(F.col(n)), F.lit("")) for n in names if n in bodies.columns], F.lit(None).cast("string"))
    slug = pick("slug", "url_name", "id")
    return bodies.select(slug.alias("slug"), F.coalesce(pick("name", "title"), slug).alias("name"), F.coalesce("tags", F.array().cast("array<string>")).alias("tags")).where("slug is not null")


def source_graph(instances: DataFrame, sites: DataFrame, targets: DataFrame) -> DataFrame:
    """Instances (instance_id, host) with their sites (site_id, host) and targets (target_id, site_id).

    Every site must belong to exactly one instance and every target to exactly one
    site; anything else aborts. Source lists keep their order without repeats.
    """
    require_unique(instances, "instance host", "host")
    require_unique(sites, "site", "site_id")
    require_unique(targets, "target", "target_id")
    lost = sites.join(instances, "host", "left_anti")
    stray = targets.join(sites, "site_id", "left_anti")
    for df, what, name in ((lost, "site", "site_id"), (stray, "target", "target_id")):
        if not (bad := df.select(name).limit(1)).isEmpty():
            raise Violation(f"{what} {bad.first()[0]} resolves to nothing")
    placed = sites.join(instances.select("instance_id", "host"), "host")
    by = targets.groupBy("site_id").agg(F.array_sort(F.collect_set("target_id")).alias("targets"))
    return placed.join(by, "site_id", "left").groupBy("instance_id").agg(F.array_sort(F.collect_set("site_id")).alias("sites"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("targets")))).alias("targets"))


def same_mapping(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that only one of two mappings has: side (missing from a, extra in a) and the row."""
    return b.exceptAll(a).withColumn("side", F.lit("missing")).unionByName(a.exceptAll(b).withColumn("side", F.lit("extra")))


def approved(rows: DataFrame, registry: DataFrame, *keys: str) -> DataFrame:
    """Rows joined with their one approval by exact keys; none or several abort."""
    require_unique(registry, "approval", *keys)
    if not rows.join(registry, list(keys), "left_anti").isEmpty():
        raise Violation("row without an approval")
    return rows.join(registry, list(keys))


def looked_up(rows: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Rows with their dimension columns; an unknown key aborts."""
    require_unique(dimension, key, key)
    if not (bad := rows.join(dimension, key, "left_anti").limit(1)).isEmpty():
        raise Violation(f"unknown {key}: {bad.first()[key]}")
    return rows.join(dimension, key)


def ordered_sources(default: Column, extra: Column) -> Column:
    """Default source ids before extra ones, each once."""
    return F.array_distinct(F.concat(default, F.coalesce(extra, F.array().cast("array<string>"))))


def json_path(pointer: str) -> str:
    """JSON path of a JSON pointer."""
    if pointer == "":
        return "$"
    if not pointer.startswith("/"):
        raise ValueError("a pointer is empty or starts with a slash")
    parts = [p.replace("~1", "/").replace("~0", "~") for p in pointer[1:].split("/")]
    return "$" + "".join(f"[{p}]" if p.isdigit() else f"['{p}']" for p in parts)


def pointed(document: Column, pointer: str) -> Column:
    """Text of the value at a pointer of JSON text, null if there is none."""
    return F.try_variant_get(F.try_parse_json(document), json_path(pointer), "string")


# --- selections over capture indexes -----------------------------------------


def filtered_index(rows: DataFrame, keep: Column) -> tuple[DataFrame, DataFrame]:
    """Kept rows, and one row of counts: before and after."""
    keep = F.coalesce(keep, F.lit(False))
    return rows.where(keep), rows.agg(F.count("*").alias("input_count"), F.count_if(keep).alias("output_count"))


def capture_candidates(rows: DataFrame, site: str | None = None) -> DataFrame:
    """Index rows (original, timestamp, digest, statuscode) of request pages that answered 200: adds slug and kind.

    A slug has no dot but for the .json twin of a page.
    """
    u = F.col("original")
    slug = urls.request_slug(u)
    kind = F.when(F.endswith(F.regexp_replace(urls.path(u), "/+$", ""), F.lit(".json")), "json").otherwise("html")
    fine = (F.col("statuscode") == "200") & (slug != "") & ~F.contains(slug, F.lit("."))
    return rows.where(fine & (urls.host(u) == site if site else F.lit(True))).withColumns({"slug": slug, "kind": kind})


def index_row_rules() -> list[tuple[str, Column]]:
    """Rules of index rows."""
    return [
        ("timestamp is not 14 digits", ~F.coalesce(F.col("timestamp").rlike("^[0-9]{14}$"), F.lit(False))),
        ("original is no web address", urls.normalize_url(F.col("original")).isNull()),
        ("digest is missing", F.coalesce("digest", F.lit("")) == ""),
    ]


def without_internal(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_")])


def slice_of(df: DataFrame, order: list[str], offset: int, limit: int) -> DataFrame:
    """A page of rows in a fixed order."""
    return df.orderBy(*order).offset(offset).limit(limit)


def pinned(members: DataFrame, candidates: DataFrame, key: str, url: str) -> DataFrame:
    """Members with the one candidate that has their key; none, several or another address abort."""
    found = members.join(candidates.withColumnRenamed(url, "_url"), key, "left")
    counted = found.groupBy(key).agg(F.count("_url").alias("n"), F.bool_and(F.col("_url") == F.col(url)).alias("same"))
    if not counted.where("n <> 1 or not coalesce(same, false)").isEmpty():
        raise Violation("member without exactly one matching candidate")
    return found.drop("_url")


def latest_verified(artifacts: DataFrame, order: str) -> DataFrame:
    """The newest artifact that passed its checks."""
    return artifacts.where("verified").groupBy().agg(F.max_by(F.struct(*artifacts.columns), order).alias("a")).select("a.*").where("verified")


def last_by_id(rows: DataFrame, key: str, order: str) -> DataFrame:
    """Rows once by id, the last wins, in id order."""
    return rows.groupBy(key).agg(F.max_by(F.struct(*rows.columns), order).alias("r")).select("r.*").orderBy(key)


def site_totals(pages: DataFrame) -> DataFrame:
    """Per site: pages, rows, and whether the pages are complete (each of 0..n-1 once, no fingerprint twice)."""
    each = (F.max("page") + 1 == F.count("*")) & (F.count_distinct("page") == F.count("*")) & (F.min("page") == 0)
    complete = each & (F.count_distinct("fingerprint") == F.count("*"))
    return pages.groupBy("site_id").agg(F.count("*").alias("pages"), F.sum("rows").alias("rows"), complete.alias("complete"))


def progress(sites: DataFrame, now: DataFrame, prior: DataFrame) -> DataFrame:
    """Rows per site now, before, and the difference; coverage stays null, as no total is known."""
    a, b = now.select("site_id", F.col("rows").alias("rows_now")), prior.select("site_id", F.col("rows").alias("rows_before"))
    out = sites.select("site_id").join(a, "site_id", "left").join(b, "site_id", "left").fillna(0, ["rows_now", "rows_before"])
    return out.withColumns({"delta": F.col("rows_now") - F.col("rows_before"), "coverage": F.lit(None).cast("double")})


def union_all(*parts: DataFrame) -> DataFrame:
    """Rows of all parts by column name; missing columns are null, columns sorted by name."""
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return together.select(*sorted(together.columns))


def replacement_problems(wanted: DataFrame, members: DataFrame, rows: DataFrame) -> DataFrame:
    """Wanted replacements (member_id, candidate_url, capture_timestamp, source_row_sha256) with their first problem, null if none.

    ``members`` holds member_id, canonical_url, state; ``rows`` the approved index rows: row_sha256 and
    own_sha256 (stated, and as computed), member_id, canonical_url, capture_timestamp (ISO), archive_url,
    query_scope, retrieved_at. A replacement is for a failed member, for its exact address inside the approved
    scope, and pinned to exactly one row, whose digest, identity, archive address and times hold.
    """
    found = rows.groupBy("row_sha256").agg(F.count("*").alias("_rows"), F.any_value(F.struct(*[c for c in rows.columns if c != "row_sha256"])).alias("_r"))
    asked = wanted.join(members.select("member_id", F.col("canonical_url").alias("_url"), F.col("state").alias("_state")), "member_id", "left")
    asked = asked.join(found, asked["source_row_sha256"] == found["row_sha256"], "left")
    r = lambda name: F.col(f"_r.{name}")
    taken = F.try_to_timestamp("capture_timestamp")
    place = F.concat(F.lit("https://web.archive.org/web/"), F.date_format(taken, "yyyyMMddHHmmss"), F.lit("id_/"), F.col("_url"))
    differs = lambda a, b: ~a.eqNullSafe(b)
    problem = (
        F.when(F.col("_state").isNull(), "member is outside the population")
        .when(~F.col("_state").isin("retryable", "terminal"), "member has not failed")
        .when(~F.coalesce(urls.is_safe_https(F.col("candidate_url")), F.lit(False)) | differs(F.col("candidate_url"), F.col("_url")), "address is not the member's")
        .when(F.col("_rows").isNull(), "pinned row is missing")
        .when(F.col("_rows") > 1, "pinned row is ambiguous")
        .when(differs(r("own_sha256"), F.col("source_row_sha256")), "pinned row does not match its digest")
        .when(~F.coalesce(urls.in_scope(F.col("_url"), r("query_scope")), F.lit(False)), "address is outside the approved scope")
        .when(differs(r("member_id"), F.col("member_id")) | differs(r("canonical_url"), F.col("_url")) | differs(r("capture_timestamp"), F.col("capture_timestamp")), "pinned row is another capture")
        .when(taken.isNull(), "capture time cannot be read")
        .when(differs(r("archive_url"), place), "archive address does not follow from the capture")
        .when(taken > F.try_to_timestamp(r("retrieved_at")), "capture is later than its retrieval")
    )
    return asked.select(*wanted.columns, problem.alias("problem"))


def bound_checkpoints(queries: DataFrame, checkpoints: DataFrame, bodies: DataFrame, header: list[str]) -> DataFrame:
    """Queries (canonical_slug, media_kind, exact_url) with what keeps their checkpoint from standing, null if nothing does.

    ``checkpoints`` holds the same keys, status, exact_url, records (array of rows), record_count,
    response_body_filename, response_sha256 and response_byte_count; ``bodies`` holds name and content.
    A checkpoint stands if it is complete, about this very query, and its body, by name, length and
    digest, holds exactly its records: successes of the exact address under the expected header.
    """
    keys = ["canonical_slug", "media_kind"]
    held = checkpoints.select(*keys, F.struct(*[c for c in checkpoints.columns if c not in keys]).alias("c"))
    rows = queries.join(held, keys, "left").withColumn("_name", F.concat("canonical_slug", F.lit("."), "media_kind", F.lit(".json")))
    there = bodies.select(F.col("name").alias("_name"), F.sha2("content", 256).alias("_digest"), F.octet_length("content").alias("_bytes"), F.from_json(F.decode("content", "UTF-8"), "array<array<string>>").alias("_rows"))
    rows = rows.join(there, "_name", "left")
    told = F.when(F.size("c.records") > 0, F.concat(F.array(F.array(*[F.lit(h) for h in header])), F.col("c.records"))).otherwise(F.col("_rows"))
    listed = F.when(F.size("_rows") > 0, F.slice("_rows", 2, F.greatest(F.size("_rows") - 1, F.lit(1)))).otherwise(F.col("_rows"))
    at = {name: i for i, name in enumerate(header)}
    strange = F.exists(listed, lambda x: (F.size(x) != len(header)) | ~x[at["original"]].eqNullSafe(F.col("exact_url")) | ~x[at["statuscode"]].eqNullSafe(F.lit("200")))
    problem = (
        F.when(F.col("c").isNull(), "no checkpoint")
        .when(~F.col("c.status").eqNullSafe("complete"), "not complete")
        .when(~F.col("c.exact_url").eqNullSafe(F.col("exact_url")), "of another query")
        .when(~F.col("c.response_body_filename").eqNullSafe(F.col("_name")), "names another body")
        .when(F.col("_digest").isNull(), "body is missing")
        .when((F.col("_bytes") != F.col("c.response_byte_count")) | ~F.col("_digest").eqNullSafe(F.col("c.response_sha256")), "body was changed")
        .when(F.col("_rows").isNull() | F.coalesce((F.size("_rows") > 0) & (F.col("_rows")[0] != F.array(*[F.lit(h) for h in header])), F.lit(False)), "body is no answer")
        .when(F.coalesce(strange, F.lit(False)), "body holds other captures")
        .when(~told.eqNullSafe(F.col("_rows")) | ~F.col("c.record_count").eqNullSafe(F.greatest(F.size("_rows") - 1, F.lit(0)).cast("bigint")), "records differ from the body")
    )
    return rows.select(*queries.columns, problem.alias("problem"))
