"""Command line: python -m recordloom <command> ...

Exit status 2 means that a verification is false, 1 that a rule was broken or that counts drift.
"""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from pyspark.sql import functions as F

from .commands import COMMANDS
from .operators import completeness, events, manifest, projection, ranges
from .operators.checks import CONTRACT, Violation, event_rules, require
from .session import session
from .sinks import documents, packages
from .sources import readers


def project(a) -> dict:
    """Event log to projection: merge, takedown, latest revision, roll-ups, coverage, checksums."""
    spark = session()
    log = require(events.merge_shards(readers.read_events(spark, a.events).drop("arrival"), payload=F.col("payload")), event_rules())
    gone = readers.read_takedowns(spark, a.takedowns) if a.takedowns else None
    kept = events.without_takedowns(log, gone) if gone is not None else log
    active = events.not_retracted(events.latest_revisions(kept)).persist()
    given = readers.read_attachments(spark, a.attachments).drop("arrival") if a.attachments else None
    files = projection.kept_attachments(given, gone) if given is not None else spark.createDataFrame([], "case_id string, event_id string, payload string")
    meta, figures, records = None, None, None
    if a.manifest:
        document, rows = readers.read_manifest(spark, a.manifest)
        meta, figures = document.first(), projection.manifest_figures(rows).first()
        if a.require_live and figures["rehearsals"]:
            raise Violation("manifest contains dry-run rows")
        records = projection.published_records(active, manifest.merge_last_wins(rows, "request_id", "row"), F.lit(meta["source"]))
    counted = events.coverage(log, kept, active).withColumns(
        {
            "attachment_count": F.lit(files.count()),
            "source_record_count": F.lit(None if records is None else records.count()).cast("bigint"),
            "manifest_request_count": F.lit(meta and meta["record_count"]).cast("bigint"),
            "manifest_attachment_count": F.lit(figures and figures["attachments"]).cast("bigint"),
            "attachments_given": F.lit(given is not None),
        }
    )
    coverage = projection.reconciled(counted).drop("attachments_given").first().asDict()
    coverage |= {
        "contract_version": CONTRACT,
        "source_events": sorted(r["file"] for r in readers.event_files(spark, a.events).collect()),
        "snapshot_revision": a.revision,
        "takedown_ids": [] if gone is None else sorted(r["id"] for r in gone.collect()),
        "manifest_dry_run_request_count": figures["rehearsals"] if figures else 0,
        "require_live_manifest": a.require_live,
    }
    if a.source_reconciliation:
        coverage["source_reconciliation"] = projection.reconciliation_note(Path(a.source_reconciliation).read_text(encoding="utf-8"))
    tables = {"events": active, "cases": events.cases(active), "attachments": files, "revisions": projection.revision_row(active, a.revision, meta["captured_at"] if meta else None)}
    if records is not None:
        tables["source_records"] = records
    documents.write_projection(a.output, tables, coverage, "process-events")
    return coverage


def verify(a) -> dict:
    return documents.verify_projection(session(), a.folder)


def merge_manifests(a) -> dict:
    """Later manifests replace earlier requests."""
    spark, parts = session(), []
    for i, path in enumerate(a.manifests):
        _, rows = readers.read_manifest(spark, path)
        parts.append(rows.withColumn("file", F.lit(i)))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    rows = manifest.merge_last_wins(every, "request_id", "file", "row")
    document = documents.manifest_document({"source": a.source}, rows)
    documents.write_manifest(a.output, document, rows)
    return document["meta"]


def package(a) -> dict:
    files = {"cases": a.cases, "events": a.events, "attachments": a.attachments}
    made = packages.build_package(session(), a.store, a.instance, a.revision, files, {"repository": a.repository, "revision": a.repository_revision}, {"kind": a.kind})
    return {k: made[k] for k in ("package_id", "archive_revision", "counts")}


def verify_package(a) -> dict:
    return {"package_id": packages.verify_package(session(), a.folder)["package_id"]}


def verify_store(a) -> dict:
    return {"packages": packages.verify_store(session(), a.store)}


def completeness_report(a) -> dict:
    spark = session()
    load = lambda path: completeness.inventory(readers.read_inventory(spark, path)).where("not is_synthetic").select("url")
    channels = dict(c.split("=", 1) for c in a.channel)
    metrics, redundancy = completeness.report(load(a.enumerated), {n: load(p) for n, p in channels.items()})
    return {"channels": [r.asDict() for r in metrics.orderBy("channel").collect()], "redundancy": redundancy.first().asDict()}


def backfill(a) -> dict:
    spark = session()
    v = ranges.backfill_verification(F.lit(a.captured), F.lit(a.merged), [F.lit(m) for m in a.mirror])
    return spark.range(1).select(*[c.alias(n) for n, c in v.items()]).first().asDict()


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="recordloom")
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name, run, *options):
        p = commands.add_parser(name, help=run.__doc__)
        for flag, kw in options:
            p.add_argument(flag, **kw)
        p.set_defaults(run=run)

    need, some = {"required": True}, {"default": None}
    command("project", project, ("--events", need), ("--output", need), ("--takedowns", some), ("--manifest", some), ("--attachments", some), ("--source-reconciliation", some), ("--revision", some), ("--require-live", {"action": "store_true"}))
    command("verify", verify, ("folder", {}))
    command("merge-manifests", merge_manifests, ("manifests", {"nargs": "+"}), ("--output", need), ("--source", need))
    command("package", package, ("--store", need), ("--instance", need), ("--revision", {"type": int, **need}), ("--cases", need), ("--events", need), ("--attachments", need), ("--repository", need), ("--repository-revision", need), ("--kind", {"default": "snapshot"}))
    command("verify-package", verify_package, ("folder", {}))
    command("verify-store", verify_store, ("store", {}))
    command("completeness", completeness_report, ("--enumerated", need), ("--channel", {"action": "append", "default": []}))
    command("backfill", backfill, ("--captured", {"type": int, **need}), ("--merged", {"type": int, **need}), ("--mirror", {"type": int, "action": "append", "default": []}))
    for name, (run, options) in COMMANDS.items():
        command(name, run, *options)
    args = parser.parse_args(argv)
    try:
        result = args.run(args)
    except Violation as error:
        print(f"violation: {error}", file=sys.stderr)
        return 1
    print(json.dumps(result, indent=2, sort_keys=True, default=str))
    if result.get("valid") is False or result.get("healthy") is False:
        return 1
    return 2 if result.get("fully_verified") is False or result.get("verified") is False else 0


if __name__ == "__main__":
    sys.exit(main())
