"""Rollout of jurisdictions: all tables of a version are published together, or none is.

Every jurisdiction's table is written into the version's folder and checked there; the
national table is merged from what was written (a later jurisdiction replaces earlier requests).
One small document names the version: until it is renamed into place, readers see the old
version whole. Progress is a document in the version's folder, so that a run that was
stopped does not write finished jurisdictions again.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import files
from ..operators.checks import Rule, Violation, require, require_unique
from ..operators.manifest import merge_last_wins
from ..sinks.documents import content_digest_of

POINTER = "current.json"
Capture = Callable[[str], DataFrame]


def request_rules() -> list[Rule]:
    """What every published table has to keep."""
    return [("request without a positive id", F.coalesce(F.col("request_id") < 1, F.lit(True))), ("dry-run rows are not published", F.col("state").eqNullSafe("dry-run"))]


def _read(spark: SparkSession, path: str) -> dict:
    return json.loads(files.read(spark, path)) if files.exists(spark, path) else {}


def current_version(spark: SparkSession, root: str) -> dict:
    """The published version: name, jurisdictions with rows and digest, the national table's; empty before the first."""
    return _read(spark, f"{root}/{POINTER}")


def table(spark: SparkSession, root: str, jurisdiction: str = "national") -> DataFrame:
    """A table of the published version."""
    held = current_version(spark, root)
    if jurisdiction not in held.get("tables", {}):
        raise Violation(f"{jurisdiction} is not published")
    return spark.read.parquet(f"{root}/versions/{held['version']}/{jurisdiction}")


def roll_out(spark: SparkSession, root: str, version: str, jurisdictions: list[str], capture: Capture | Mapping[str, DataFrame], rules: list[Rule] | None = None) -> dict:
    """Publish one version of all jurisdictions, in order; returns what the pointer then says.

    A jurisdiction that fails, by its capture or by a rule, aborts with the pointer as it was;
    those that are done stay for the next run of the same version. A version that is published
    is not written again.
    """
    if not re.fullmatch(r"[0-9A-Za-z][0-9A-Za-z._-]*", version) or len(set(jurisdictions)) < len(jurisdictions) or not jurisdictions or "national" in jurisdictions:
        raise Violation("a rollout needs a plain version name and distinct jurisdictions")
    held = current_version(spark, root)
    if held.get("version") == version:
        return held
    folder = f"{root}/versions/{version}"
    done = _read(spark, f"{folder}/progress.json").get("tables", {})
    for name in jurisdictions:
        if name in done:
            continue
        rows = capture(name) if callable(capture) else capture[name]
        files.delete(spark, f"{folder}/{name}")
        rows.write.parquet(f"{folder}/{name}")
        written = spark.read.parquet(f"{folder}/{name}")
        require_unique(require(written, rules or request_rules()), f"requests of {name}", "request_id")
        done[name] = content_digest_of(written)
        files.write(spark, f"{folder}/progress.json", json.dumps({"tables": done}, sort_keys=True).encode())
    parts = [spark.read.parquet(f"{folder}/{name}").withColumns({"jurisdiction": F.lit(name), "_file": F.lit(i)}) for i, name in enumerate(jurisdictions)]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    files.delete(spark, f"{folder}/national")
    merge_last_wins(every, "request_id", "_file").write.parquet(f"{folder}/national")
    national = spark.read.parquet(f"{folder}/national")
    digest = content_digest_of(national)
    if digest["rows"] != every.select("request_id").distinct().count():
        raise Violation("the national table does not hold every request once")
    document = {"version": version, "tables": {k: done[k] for k in jurisdictions} | {"national": digest}}
    files.write(spark, f"{root}/{POINTER}", json.dumps(document, sort_keys=True).encode())
    return document
