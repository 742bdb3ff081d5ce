"""Request manifests: normal form, merging, roll-ups, change diffs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.canonical import json_digest

# Columns of a request record and their defaults (null stays null where none is given).
RECORD = {"request_id": None, "url_title": "", "title": "", "authority": "", "body_tag": "", "state": "", "html_captured": False, "license": None, "attribution": None, "first_seen": None, "last_updated": None}


def authority_name(value: Column) -> Column:
    """Authority of JSON text: an object's url_name, name or id, else the text itself."""
    parsed = F.try_parse_json(value)
    at = lambda p: F.nullif(F.try_variant_get(parsed, p, "string"), F.lit(""))
    return F.coalesce(F.when(F.ltrim(value).startswith("{"), F.coalesce(at("$.url_name"), at("$.name"), at("$.id"))), value, F.lit(""))


def normalize_records(rows: DataFrame, hashed: bool = False) -> DataFrame:
    """Request records with all columns and defaults; ``id`` stands in for request_id.

    With ``hashed`` every row has a content_sha256: its own, or that of its canonical form.
    """
    types = {"request_id": "bigint", "html_captured": "boolean"}
    out = []
    for name, default in RECORD.items():
        names = [n for n in ([name, "id"] if name == "request_id" else [name]) if n in rows.columns]
        value = F.coalesce(*[F.col(n).cast(types.get(name, "string")) for n in names]) if names else F.lit(None).cast(types.get(name, "string"))
        out.append((value if default is None else F.coalesce(value, F.lit(default))).alias(name))
    made = rows.select(*out, F.nullif(F.col("content_sha256"), F.lit("")).alias("content_sha256") if "content_sha256" in rows.columns else F.lit(None).cast("string").alias("content_sha256"))
    if not hashed:
        return made if "content_sha256" in rows.columns else made.drop("content_sha256")
    # a row without a hash gets that of its own canonical form
    whole = F.to_json(F.struct(*sorted(RECORD)), {"ignoreNullFields": "false"})
    return made.withColumn("content_sha256", F.coalesce("content_sha256", json_digest(whole, "manifest")))


def merge_last_wins(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """Last row per key by explicit arrival order (file, then row); order columns are dropped."""
    keep = [c for c in rows.columns if c not in order]
    return rows.groupBy(key).agg(F.max_by(F.struct(*keep), F.struct(*order)).alias("r")).select("r.*")


def authorities(rows: DataFrame) -> DataFrame:
    """Distinct authorities that are not blank, in order."""
    return rows.select("authority").where("authority <> ''").distinct().orderBy("authority")


def authority_state_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("authority", "state").agg(F.count("*").alias("n"))


def change_diff(before: DataFrame, after: DataFrame, key: str, digest: str) -> DataFrame:
    """Changes between two tables: key, bucket (added, updated, removed), digests."""
    a, b = before.select(key, F.col(digest).alias("previous_sha256")), after.select(key, F.col(digest).alias("content_sha256"))
    joined = a.withColumn("_a", F.lit(1)).join(b.withColumn("_b", F.lit(1)), key, "full_outer")
    bucket = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").when(~F.col("previous_sha256").eqNullSafe(F.col("content_sha256")), "updated")
    return joined.select(key, bucket.alias("bucket"), "content_sha256", "previous_sha256").where("bucket is not null")


def candidate_delta(before: DataFrame, after: DataFrame, key: str, payload: str) -> DataFrame:
    """Added, removed and changed candidates by canonical payload."""
    found = change_diff(before, after, key, payload)
    return found.select(key, F.when(F.col("bucket") == "updated", "changed").otherwise(F.col("bucket")).alias("bucket"))


def change_rows(changes: DataFrame) -> DataFrame:
    """Rehearsal rows of a diff: one request per added or updated change, its bucket as state."""
    return changes.where("bucket <> 'removed'").select("request_id", "url_title", F.col("url_title").alias("title"), F.col("bucket").alias("state"), "content_sha256")


def distinct_objects(rows: DataFrame, digest: str, order: str) -> DataFrame:
    """Content-addressed objects: per digest the first row and the number of copies."""
    return rows.groupBy(digest).agg(F.min(order).alias(order), F.count("*").alias("copies"))


def jurisdiction_of(rows: DataFrame, tags: DataFrame, tag: str, default: str = "OTHER") -> DataFrame:
    """First matching jurisdiction in rule order per row's tag; ``tags`` has tag, jurisdiction, ord."""
    first = tags.groupBy("tag").agg(F.min_by("jurisdiction", "ord").alias("jurisdiction"))
    return rows.join(first, rows[tag] == first["tag"], "left").drop(first["tag"]).withColumn("jurisdiction", F.coalesce("jurisdiction", F.lit(default)))


def first_label(rows: DataFrame, key: str, label: str, order: str, default: str = "OTHER") -> DataFrame:
    """First label in order per key; the default label only where no other occurs."""
    return rows.groupBy(key).agg(F.min_by(label, F.struct((F.col(label) == default).alias("d"), F.col(order).alias("o"))).alias(label))


def propagate_profiles(rows: DataFrame, group: str, profile: str, unresolved: str = "UNRESOLVED") -> DataFrame:
    """A row's own profile, else the one profile of its group if all agree, else unresolved."""
    agreed = rows.where(F.col(profile).isNotNull()).groupBy(group).agg(F.min(profile).alias("_low"), F.max(profile).alias("_high"))
    one = F.when(F.col("_low") == F.col("_high"), F.col("_low"))
    return rows.join(agreed, group, "left").withColumn("resolved", F.coalesce(F.col(profile), one, F.lit(unresolved))).drop("_low", "_high")
