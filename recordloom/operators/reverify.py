"""Independent verification of a replay: journal, objects and checkpoint from their bytes.

Nothing here is shared with the code that wrote them but the definition of a digest. A
journal, however long, is cut into segments of consecutive entries; each segment is checked
in its own task and gives one row with its two ends; segments are joined end to start. The
last states are then joined, both ways, with the objects that are there and with the checkpoint.
Each finding names the first entry that is broken.
"""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import files
from .checks import Violation

SEGMENT = 65_536
#: Problems of an entry, gravest first: what makes the later ones meaningless comes before them.
GRAVEST = ["is no entry", "has another place", "does not have its own digest", "begins with a link", "has no entry before", "does not follow the entry before"]


def entry_fields(text: str) -> dict | None:
    """An entry's fields; None if the line is no object."""
    try:
        made = json.loads(text)
    except (TypeError, ValueError):
        return None
    return made if isinstance(made, dict) else None


def own_digest(entry: dict) -> str:
    """Digest of the compact, key-sorted text of all fields but ``entry_sha256``."""
    rest = {k: v for k, v in entry.items() if k != "entry_sha256"}
    return hashlib.sha256(json.dumps(rest, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode("utf-8")).hexdigest()


def _named(value: object) -> str | None:
    """A stated digest; what is no text is told from any digest by its first words."""
    return value if value is None or isinstance(value, str) else f"no text: {json.dumps(value)}"


_CHECKED = T.StructType([T.StructField(f, T.StringType()) for f in ("problem", "link", "own")])


@F.pandas_udf(_CHECKED)
def _checked(place: pd.Series, text: pd.Series) -> pd.DataFrame:
    """What is wrong with an entry by itself, the digest that it follows, and its own as stated."""
    out = []
    for at, line in zip(place.tolist(), text.tolist(), strict=True):
        entry = entry_fields(line)
        found = (
            "is no entry" if entry is None
            else "has another place" if entry.get("sequence") != at or isinstance(entry.get("sequence"), bool)
            else "does not have its own digest" if own_digest(entry) != entry.get("entry_sha256")
            else None
        )
        entry = entry or {}
        out.append((found, _named(entry.get("previous_entry_sha256")), _named(entry.get("entry_sha256"))))
    return pd.DataFrame(out, columns=["problem", "link", "own"], dtype="object")


def journal_segments(lines: DataFrame, keys: list[str] | None = None, size: int = SEGMENT) -> DataFrame:
    """Segments of journals (keys, place from 0, entry text): their ends and their first problem.

    Entries are checked where they lie. Segments are a window over what is left of them, so
    that many short journals cost no more than a few long ones.
    """
    keys = keys or []
    one = [*keys, "segment"]
    rows = lines.select(*keys, "place", F.floor(F.col("place") / size).cast("bigint").alias("segment"), _checked("place", "entry").alias("e"))
    rows = rows.select(*one, "place", "e.*")
    before = Window.partitionBy(*one).orderBy("place")
    unlinked = F.when(F.lag("place").over(before).isNotNull() & ~F.col("link").eqNullSafe(F.lag("own").over(before)), "does not follow the entry before")
    found = rows.select(*one, "place", "link", "own", F.coalesce("problem", unlinked).alias("problem"))
    worst = F.min(F.when(F.col("problem").isNotNull(), F.struct("place", "problem")))
    ends = found.groupBy(*one).agg(F.min(F.struct("place", "link")).alias("a"), F.max(F.struct("place", "own")).alias("z"), worst.alias("w"))
    return ends.select(*one, F.col("a.place").alias("first"), F.col("z.place").alias("last"), F.col("a.link").alias("head"), F.col("z.own").alias("tail"), F.col("w.problem").alias("problem"), F.col("w.place").alias("problem_at"))


def chain_findings(segments: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Problems of segments and of their joins, one row for each: keys, place, problem.

    Each segment tells its first place, the place after its last and its problem's; what is
    told of one place meets there. Segments are read once, and no journal is one task's.
    """
    keys = keys or []
    told = lambda place, what, text: F.struct(place.cast("bigint").alias("place"), F.lit(what).alias("what"), text.cast("string").alias("text"))
    parts = F.array(told(F.col("first"), "begins", F.col("head")), told(F.col("last") + 1, "led", F.col("tail")), told(F.col("problem_at"), "within", F.col("problem")))
    rows = segments.select(*keys, F.explode(parts).alias("t")).select(*keys, "t.*").where("place is not null")
    of = lambda what: F.when(F.col("what") == what, F.col("text"))
    met = rows.groupBy(*keys, "place").agg(
        F.count_if(F.col("what") == "begins").alias("begins"), F.max(of("begins")).alias("head"),
        F.count_if(F.col("what") == "led").alias("led"), F.max(of("led")).alias("before"),
        F.max(of("within")).alias("within"),
    )
    first = F.col("begins") > 0
    broken = (
        F.when(first & (F.col("place") == 0) & F.col("head").isNotNull(), "begins with a link")
        .when(first & (F.col("place") > 0) & (F.col("led") == 0), "has no entry before")
        .when(first & (F.col("place") > 0) & ~F.col("head").eqNullSafe(F.col("before")), "does not follow the entry before")
    )
    both = F.explode(F.array_distinct(F.array(F.col("within"), broken))).alias("problem")
    return met.select(*keys, "place", both).where("problem is not null")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a journal file with their place. A journal is one file; its lines are numbered by partition offsets."""
    rows = spark.read.text(path).withColumn("_id", F.monotonically_increasing_id())
    rows = rows.select(F.shiftright("_id", 33).alias("_part"), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)).alias("_at"), F.col("value").alias("entry"))
    sizes = {r["_part"]: r["n"] for r in rows.groupBy("_part").agg(F.count("*").alias("n")).collect()}
    offset, total = {}, 0
    for part in range(max(sizes, default=-1) + 1):  # partitions of one file follow its bytes
        offset[part], total = total, total + sizes.get(part, 0)
    starts = F.array(*[F.lit(offset[p]).cast("bigint") for p in range(len(offset))]) if offset else F.array(F.lit(0).cast("bigint"))
    return rows.select((starts[F.col("_part").cast("int")] + F.col("_at")).alias("place"), "entry")


def findings(spark: SparkSession, folder: str, members: list[str] | DataFrame, size: int = SEGMENT) -> DataFrame:
    """What is wrong with a replay folder (journal.jsonl, objects, checkpoint.json): what, at, problem."""
    lines = _lines(spark, f"{folder}/journal.jsonl") if files.exists(spark, f"{folder}/journal.jsonl") else spark.createDataFrame([], "place bigint, entry string")
    chain = chain_findings(journal_segments(lines, size=size)).select(F.lit("journal").alias("what"), F.col("place").cast("string").alias("at"), "problem")
    fields = F.from_json("entry", "member string, disposition string, object_sha256 string")
    entries = lines.select("place", fields.alias("e")).select("place", "e.*")
    known = members if isinstance(members, DataFrame) else spark.createDataFrame([(m,) for m in members], "member string")

    strange = entries.join(known, "member", "left_anti").select(F.lit("journal").alias("what"), F.col("place").cast("string").alias("at"), F.lit("is about an unknown member").alias("problem"))
    settled = Window.partitionBy("member").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    after = entries.withColumn("_done", F.max(F.col("disposition").isin("complete", "terminal")).over(settled)).where("_done")
    after = after.select(F.lit("journal").alias("what"), F.col("place").cast("string").alias("at"), F.lit("comes after the member was settled").alias("problem"))

    there = _objects(spark, folder)
    named = entries.where("object_sha256 is not null").groupBy("object_sha256").agg(F.min("place").alias("place"))
    both = named.join(there, named["object_sha256"] == there["name"], "full_outer")
    wrong = F.when(F.col("name").isNull(), "is gone").when(F.col("object_sha256").isNull(), "is named by no entry").when(F.col("digest") != F.col("name"), "has another digest")
    objects = both.select(F.lit("object").alias("what"), F.coalesce("object_sha256", "name").alias("at"), wrong.alias("problem")).where("problem is not null")
    bare = entries.where((F.col("disposition") == "complete") != F.col("object_sha256").isNotNull())
    bare = bare.select(F.lit("journal").alias("what"), F.col("place").cast("string").alias("at"), F.lit("has an object and no success, or the reverse").alias("problem"))

    last = known.join(entries.groupBy("member").agg(F.max_by("disposition", "place").alias("found")), "member", "left").select("member", F.coalesce("found", F.lit("pending")).alias("found"))
    held = json.loads(files.read(spark, f"{folder}/checkpoint.json"))["states"] if files.exists(spark, f"{folder}/checkpoint.json") else {}
    told = spark.createDataFrame(list(held.items()), "member string, stated string")
    states = last.join(told, "member", "full_outer")
    differs = F.when(F.col("found").isNull(), "is no member").when(F.col("stated").isNull(), F.when(F.col("found") != "pending", "is missing")).when(F.col("stated") != F.col("found"), "is not what the journal says")
    states = states.select(F.lit("checkpoint").alias("what"), F.col("member").alias("at"), differs.alias("problem")).where("problem is not null")
    return chain.unionByName(strange).unionByName(after).unionByName(bare).unionByName(objects).unionByName(states)


def _objects(spark: SparkSession, folder: str) -> DataFrame:
    if not files.exists(spark, f"{folder}/objects"):
        return spark.createDataFrame([], "name string, digest string")
    bodies = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{folder}/objects")
    return bodies.select(F.substring_index("path", "/", -1).alias("name"), F.sha2("content", 256).alias("digest"))


def require_whole(spark: SparkSession, folder: str, members: list[str] | DataFrame, size: int = SEGMENT) -> None:
    """Aborts with the first finding: of the journal by place, then objects, then the checkpoint."""
    rank = F.when(F.col("what") == "journal", 0).when(F.col("what") == "object", 1).otherwise(2)
    grave = F.array_position(F.array(*[F.lit(p) for p in GRAVEST]), F.col("problem"))
    grave = F.when(grave == 0, len(GRAVEST) + 1).otherwise(grave)
    place = F.when(F.col("what") == "journal", F.col("at").try_cast("bigint"))
    bad = findings(spark, folder, members, size).orderBy(rank, place, grave, "at", "problem").head(1)
    if bad:
        raise Violation(f"{bad[0]['what']} {bad[0]['at']} {bad[0]['problem']}")
