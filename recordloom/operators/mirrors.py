"""Mirrors and packages: comparing artifacts, parity of counts, inventories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import checksum_matches
from .checks import require_same
from .prefix import ordinals


def compare_artifacts(local: DataFrame, remote: DataFrame) -> DataFrame:
    """Local artifacts (name, size, sha256) with the remote ones: present, size_matches,
    checksum_matches; the last two are null where the remote does not tell."""
    r = remote.select("name", F.col("size").alias("_size"), F.col("sha256").alias("_sha"), F.lit(True).alias("_there"))
    out = local.join(r, "name", "left")
    return out.select("name", "size", F.coalesce("_there", F.lit(False)).alias("present"), (F.col("_size") == F.col("size")).alias("size_matches"), checksum_matches(F.col("_sha"), F.col("sha256")).alias("checksum_matches"))


def mirror_verified(compared: DataFrame) -> DataFrame:
    """One row: every artifact is present and nothing known differs; true for none."""
    fine = F.col("present") & F.coalesce("size_matches", F.lit(True)) & F.coalesce("checksum_matches", F.lit(True))
    return compared.agg(F.coalesce(F.bool_and(fine), F.lit(True)).alias("verified"))


def parity(counts: DataFrame, reference: str = "local", tolerance: int = 25, per_mille: int = 1) -> DataFrame:
    """Counts (mirror, n) against the reference mirror's, within a tolerance."""
    base = counts.where(F.col("mirror") == reference).agg(F.max("n").alias("base"))
    limit = F.greatest(F.lit(tolerance), F.floor(F.col("base") * per_mille / 1000)).cast("bigint")
    return counts.where(F.col("mirror") != reference).crossJoin(F.broadcast(base)).select("mirror", "n", (F.col("n") - F.col("base")).alias("difference"), F.coalesce(F.abs(F.col("n") - F.col("base")) <= limit, F.lit(False)).alias("within"))


def role_counts(files: DataFrame, role: str) -> DataFrame:
    return files.groupBy(role).agg(F.count("*").alias("n"))


def require_partition(outputs: DataFrame, index: DataFrame) -> None:
    """Outputs and index hold the same rows: nothing repeated, unknown or missing."""
    require_same(outputs, index, "outputs and index")


def upsert_reports(reports: DataFrame, fresh: DataFrame, key: str = "mirror") -> DataFrame:
    """Reports with the fresh ones in place of those of the same mirror."""
    return reports.join(fresh.select(key).distinct(), key, "left_anti").unionByName(fresh)


def eligible(mirrors: DataFrame) -> DataFrame:
    """Mirrors without those that are unavailable with no records."""
    return mirrors.where(~((F.col("status") == "unavailable") & (F.coalesce("n", F.lit(0)) == 0)))


def listed_artifacts(listings: DataFrame) -> DataFrame:
    """Artifacts of mirrors' listings (mirror, body), whatever their shape: mirror, name, size, checksum, url.

    A listing holds its files under ``files``, ``data`` or ``siblings``; a file's facts lie at its top,
    under ``attributes`` or under ``lfs``. The name is the last part of a path; a file without one is
    passed over. A checksum is given bare, or with its kind before a colon; text that is no JSON
    aborts.
    """
    doc = F.try_parse_json("body")
    parsed = F.when(F.col("body").isNotNull() & doc.isNull(), F.raise_error(F.lit("a listing is no JSON")).cast("variant")).otherwise(doc)
    rows = listings.select("mirror", parsed.alias("d"))
    files = F.coalesce(*[F.try_variant_get("d", f"$.{k}", "array<variant>") for k in ("files", "data", "siblings")])
    each = rows.select("mirror", F.explode(files).alias("f"))
    text = lambda *paths: F.coalesce(*[F.nullif(F.try_variant_get("f", p, "string"), F.lit("")) for p in paths])
    number = lambda *paths: F.coalesce(*[F.try_variant_get("f", p, "bigint") for p in paths])
    path = text("$.filename", "$.key", "$.attributes.name", "$.attributes.materialized_path", "$.rfilename")
    return each.select(
        "mirror",
        F.substring_index(F.rtrim(path, F.lit("/")), "/", -1).alias("name"),
        number("$.filesize", "$.size", "$.attributes.size", "$.lfs.size").alias("size"),
        text("$.checksum", "$.attributes.extra.hashes.sha256", "$.lfs.sha256", "$.lfs.oid").alias("checksum"),
        text("$.links.download", "$.links.self", "$.links.html", "$.url").alias("url"),
    ).where("name <> ''")


def status_ordered(rows: DataFrame, status: str, order: list[str], *tie: str) -> DataFrame:
    """Rows in the order of their status, unknown ones last, then by ``tie``: adds place, from 1.

    The order is a column, so that it outlives any shuffle; places come from a scan in two levels.
    """
    rank = F.array_position(F.array(*[F.lit(s) for s in order]), F.col(status))
    ranked = rows.withColumn("_rank", F.when(F.coalesce(rank, F.lit(0)) == 0, len(order) + 1).otherwise(rank))
    return ordinals(ranked, ["_rank", *tie], "place").withColumn("place", F.col("place") + 1).drop("_rank")


def inventory_differences(declared: DataFrame, actual: DataFrame, key: str, *facts: str) -> DataFrame:
    """Files that are declared, there, or both with other facts: key, problem (missing, not declared, differs)."""
    a = declared.select(key, F.struct(*facts).alias("_a"))
    b = actual.select(key, F.struct(*facts).alias("_b"))
    problem = F.when(F.col("_b").isNull(), "missing").when(F.col("_a").isNull(), "not declared").when(~F.col("_a").eqNullSafe(F.col("_b")), "differs")
    return a.join(b, key, "full_outer").select(key, problem.alias("problem")).where("problem is not null")


def partition_problems(outputs: DataFrame, index: DataFrame, key: str) -> DataFrame:
    """Keys that keep outputs from being an exact partition of an index: key, problem (repeated, unknown, missing).

    Both sides are counted before they meet, so a key that is there often moves one row a task.
    """
    out, known = (df.groupBy(key).agg(F.count("*").alias(n)) for df, n in ((outputs, "_out"), (index, "_known")))
    problem = F.when(F.col("_known").isNull(), "unknown").when(F.col("_out").isNull(), "missing").when((F.col("_out") > 1) | (F.col("_known") > 1), "repeated")
    return out.join(known, key, "full_outer").select(key, problem.alias("problem")).where("problem is not null")
