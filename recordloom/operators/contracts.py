"""Rules of governing documents: sampling frames, target registries, capabilities, field mappings,
derived manifests, replay configurations, selections with pinned counts.

A document is JSON text. Its lists become tables, and every rule is a condition on a
table's rows (``checks.Rule``); ``problems`` gives the names of all that are broken, so
that a caller may report or abort. What a document does not state breaks the rule that asks for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .checks import FORBIDDEN_FIELDS, Rule, Violation, blank, is_digest, messages, unique

# Vocabularies of the contracts.
JURISDICTIONS = ["FEDERAL", "NSW", "ACT", "QLD", "VIC", "WA", "SA", "TAS", "NT"]
PILOT = ["FEDERAL", "NSW"]
OUTCOMES = ["access", "partial_access", "refusal", "transfer", "extension", "fees", "invalid", "information_not_held", "review", "unknown"]
RIGHTS = ["source_terms_recorded", "takedown_route_recorded", "sensitive_data_review_required", "permitted_use_recorded"]
TARGET_STATUSES = ["archived", "blocked", "unsupported"]
TARGET_EVIDENCE = ["source_issue", "capture_adapter", "rights_status", "manifest_status", "replay_status", "privacy_status"]
CLASSIFICATIONS = ["exact", "approximate", "extension-only", "unmapped"]
REPLAY_STATES = ["pending", "complete", "retryable", "terminal"]


def document(spark: SparkSession, text: str) -> DataFrame:
    """One row: the document as a variant, ``d``. Text that is no JSON object aborts."""
    row = spark.createDataFrame([(text,)], "text string").select(F.try_parse_json("text").alias("d"))
    if row.where(F.startswith(F.schema_of_variant("d"), F.lit("OBJECT"))).isEmpty():
        raise Violation("document is no JSON object")
    return row


def _at(path: str, kind: str = "string", of: str = "d") -> Column:
    return F.try_variant_get(of, f"$.{path}", kind)


def _true(path: str) -> Column:
    return F.coalesce(_at(path, "boolean"), F.lit(False))


def _items(doc: DataFrame, path: str) -> DataFrame:
    """Elements of a list of the document: place ``i`` and variant ``x``; none if there is no list."""
    return doc.select(F.posexplode(_at(path, "array<variant>")).alias("i", "x"))


def _of(path: str, kind: str = "string") -> Column:
    return _at(path, kind, "x")


def _known(value: Column, names: list[str]) -> Column:
    return F.coalesce(value.isin(names), F.lit(False))


def _lacks(doc: DataFrame, path: str) -> list[str]:
    return [] if not _items(doc, path).isEmpty() else [f"{path} is no list with elements"]


def _repeats(rows: DataFrame, key: Column, what: str) -> list[str]:
    named = rows.select(key.alias("k")).where("k is not null")
    return [f"{what} is repeated"] if not unique(named, "k").isEmpty() else []


def sampling_frame(spark: SparkSession, text: str) -> list[str]:
    """Problems of a sampling frame: approvals, strata, rights."""
    doc = document(spark, text)
    rules: list[Rule] = [
        ("capture is not authorised", ~_true("capture_authorized")),
        ("publication must stay unauthorised", F.coalesce(_at("publication_authorized", "boolean"), F.lit(True))),
        ("private retention is not authorised", ~_true("private_hf_retention_authorized")),
        ("authorisation does not say by whom, when and what", _true("capture_authorized") & F.array_contains(F.array(*[blank(_at(f"operator_authorization.{k}")) for k in ("authorized_by", "authorized_at", "scope")]), True)),
        *[(f"rights gate {k} is open", ~_true(f"rights_gates.{k}")) for k in RIGHTS],
    ]
    strata = _items(doc, "strata")
    outcomes = _of("outcomes", "array<string>")
    of_strata: list[Rule] = [
        ("stratum of an unknown jurisdiction", ~_known(_of("jurisdiction"), JURISDICTIONS)),
        ("stratum without outcomes, or with unknown ones", ~F.coalesce((F.size(outcomes) > 0) & F.forall(outcomes, lambda o: o.isin(OUTCOMES)), F.lit(False))),
        ("stratum without a positive request cap", F.coalesce(_of("request_cap", "bigint"), F.lit(0)) < 1),
    ]
    pilot = strata.select(_of("jurisdiction").alias("j")).where(F.col("j").isin(PILOT)).distinct().count() < len(PILOT)
    return messages(doc, rules) + _lacks(doc, "strata") + messages(strata, of_strata) + _repeats(strata, _of("jurisdiction"), "jurisdiction") + (["pilot strata are missing"] if pilot else [])


def target_registry(spark: SparkSession, text: str) -> list[str]:
    """Problems of a registry of archive targets: status, evidence, blockers."""
    doc = document(spark, text)
    targets = _items(doc, "targets").crossJoin(doc)
    stated = lambda k: F.coalesce(_of(f"evidence.{k}"), _at(f"evidence_defaults.{k}"))
    archived = F.coalesce(_of("status") == "archived", F.lit(False))
    rules: list[Rule] = [
        ("target without an id", blank(_of("target_id"))),
        ("target of an unknown status", ~_known(_of("status"), TARGET_STATUSES)),
        *[(f"target without evidence of {k}", stated(k).isNull()) for k in TARGET_EVIDENCE],
        ("archived target without its manifest and revision", archived & (blank(stated("manifest_sha256")) | blank(stated("capture_revision")))),
        ("target neither archived nor blocked by anything", ~archived & blank(_of("blocker"))),
    ]
    one = messages(doc, [("publication must stay disallowed", F.coalesce(_at("publication_allowed", "boolean"), F.lit(True)))])
    return one + _lacks(doc, "targets") + messages(targets, rules) + _repeats(targets, _of("target_id"), "target_id")


def capabilities(spark: SparkSession, text: str, schema: str, supported: dict[str, list[str]]) -> list[str]:
    """Problems of a capability declaration against the contract versions that are supported."""
    doc = document(spark, text)
    known = F.create_map(*[F.lit(x) if isinstance(x, str) else F.array(*map(F.lit, x)) for pair in supported.items() for x in pair])
    ours, theirs = F.try_element_at(known, _of("contract_id")), _of("supported_versions", "array<string>")
    rules: list[Rule] = [
        ("capability of an unsupported contract", ours.isNull()),
        ("capability without versions", ours.isNotNull() & (F.coalesce(F.size(theirs), F.lit(0)) < 1)),
        ("capability with unknown versions", F.coalesce(F.size(F.array_except(theirs, ours)) > 0, F.lit(False))),
        ("unknown versions must be rejected", F.coalesce(_of("unknown_version_behavior"), F.lit("reject")) != "reject"),
    ]
    one = messages(doc, [("unsupported declaration version", F.coalesce(_at("schema_version"), F.lit("")) != schema), ("declaration without a consumer", blank(_at("consumer_id")))])
    return one + _lacks(doc, "capabilities") + messages(_items(doc, "capabilities"), rules)


def field_mapping(spark: SparkSession, text: str) -> list[str]:
    """Problems of a mapping of native fields to a common vocabulary."""
    doc = document(spark, text)
    kind, target = _of("classification"), _of("riopa_field")
    rules: list[Rule] = [
        ("mapping of an unknown classification", ~_known(kind, CLASSIFICATIONS)),
        ("mapping without a native field", blank(_of("native_field"))),
        ("mapping without its target", kind.isin("exact", "approximate") & target.isNull()),
        ("unmapped field with a target", (kind == "unmapped") & target.isNotNull()),
        ("mapping without a rationale", blank(_of("rationale"))),
        ("mapping without evidence", blank(_of("evidence_fixture"))),
    ]
    one: list[Rule] = [
        ("unsupported mapping version", F.coalesce(_at("schema_version"), F.lit("")) != "1.0.0"),
        ("mapping without a full revision", F.coalesce(F.length(_at("source_revision")), F.lit(0)) != 40),
        *[(f"mapping document without {k}", blank(_at(k))) for k in ("repository", "profile_version")],
    ]
    entries = _items(doc, "mappings")
    return messages(doc, one) + _lacks(doc, "mappings") + messages(entries, rules) + _repeats(entries, _of("native_field"), "native_field")


def projected_fields(spark: SparkSession, mapping: str, fixture: str) -> DataFrame:
    """Mapped fields with the fixture's value, which counts as projected only where the classification
    carries meaning over: native_field, classification, native_value, projected_value."""
    from .registry import json_path

    rows = _items(document(spark, mapping), "mappings").select(_of("native_field").alias("native_field"), _of("classification").alias("classification"), F.split_part(_of("evidence_fixture"), F.lit("#"), F.lit(2)).alias("pointer")).collect()
    value = lambda r: F.struct(F.lit(r["native_field"]).alias("native_field"), F.lit(r["classification"]).alias("classification"), F.to_json(F.try_variant_get("d", json_path(r["pointer"]), "variant")).alias("native_value"))
    none = F.array().cast("array<struct<native_field:string,classification:string,native_value:string>>")
    # the fixture is parsed once, whatever the number of mappings
    out = document(spark, fixture).select(F.explode(F.array(*[value(r) for r in rows]) if rows else none).alias("m")).select("m.*")
    if not out.where("native_value is null").isEmpty():
        raise Violation("a mapped field is not in the fixture")
    return out.withColumn("projected_value", F.when(F.col("classification").isin("exact", "approximate"), F.col("native_value")))


def derived_manifest(spark: SparkSession, text: str, contract: str, contract_id: str, provenance: list[str]) -> list[str]:
    """Problems of the manifest of a derived layer."""
    doc = document(spark, text)
    rules: list[Rule] = [
        *[(f"raw field {k} in the derived manifest", _at(k, "variant").isNotNull()) for k in FORBIDDEN_FIELDS],
        ("conforms to another contract", F.coalesce(_at("conforms_to"), F.lit("")) != contract),
        ("names another contract", F.coalesce(_at("contract_id"), F.lit("")) != contract_id),
        ("release status is neither draft nor verified", ~_known(_at("release_status"), ["draft", "verified"])),
        ("outputs must stay candidates", F.coalesce(_at("candidate_status"), F.lit("")) != "candidate"),
        ("manifest without a version", blank(_at("version"))),
        *[(f"{k} is not pinned by digest", ~is_digest(_at(f"{k}.sha256"))) for k in ("ontology", "profile", "codebook")],
        *[(f"provenance does not state {k}", _at(f"provenance.{k}", "variant").isNull()) for k in provenance],
        ("source revision moves", _known(_at("provenance.source_revision"), ["main", "latest", "HEAD"])),
        ("source digest is none", ~is_digest(_at("provenance.source_digest"))),
    ]
    return messages(doc, rules)


def replay_policy_rules() -> list[Rule]:
    """Rules of a replay policy's one-row table of numbers."""
    number = lambda k: F.col(k).cast("double")
    within = lambda k, low, high: ~F.coalesce(number(k).between(low, high), F.lit(False))
    count = lambda k: ~F.coalesce((number(k) >= 1) & (number(k) == F.floor(number(k))), F.lit(False))
    return [
        ("floor is not positive", ~F.coalesce(number("floor_seconds") > 0, F.lit(False))),
        ("floor exceeds ceiling", ~F.coalesce(number("floor_seconds") <= number("ceiling_seconds"), F.lit(False))),
        ("backoff below one", ~F.coalesce(number("backoff_multiplier") >= 1, F.lit(False))),
        ("jitter outside 0 to 1", within("jitter_fraction", 0, 1)),
        ("failure ratio outside 0 to 1", within("failure_ratio", 0, 1)),
        ("decay outside (0, 1]", within("decay_factor", 1e-300, 1)),
        ("circuit time is negative", ~F.coalesce(number("circuit_seconds") >= 0, F.lit(False))),
        *[(f"{k} is no positive whole number", count(k)) for k in ("circuit_consecutive_failures", "window_size", "minimum_window")],
        ("least window exceeds the window", ~F.coalesce(number("minimum_window") <= number("window_size"), F.lit(False))),
    ]


def checkpoint_problems(states: DataFrame, members: DataFrame, counts: dict[str, int]) -> list[str]:
    """Problems of a replay checkpoint: its states (member_id, state) against the members, its counts against both."""
    out = messages(states, [("unknown member state", ~_known(F.col("state"), REPLAY_STATES))])
    if not unique(members, "member_id").isEmpty():
        out.append("member is repeated")
    a, b = states.select("member_id"), members.select("member_id")
    if not a.exceptAll(b).isEmpty() or not b.exceptAll(a).isEmpty():
        out.append("checkpoint and members differ")
    found = {r["state"]: r["n"] for r in states.groupBy("state").agg(F.count("*").alias("n")).collect()}
    if counts.get("population") != sum(found.values()) or any(counts.get(s, 0) != found.get(s, 0) for s in REPLAY_STATES):
        out.append("counts do not add up to the population")
    return out


def selection_problems(selected: DataFrame, missing: DataFrame, asked: int | None = None, pinned: dict[str, int] | None = None) -> list[str]:
    """Problems of a capture selection (slug, kind) and the slugs without one (slug): together they are
    all that was asked for, each once; ``pinned`` counts of kinds must be met exactly."""
    out = [f"slug repeated among {what}" for what, df in (("selected", selected), ("missing", missing)) if not unique(df, "slug").isEmpty()]
    if not selected.select("slug").intersect(missing.select("slug")).isEmpty():
        out.append("slug both selected and missing")
    kinds = {r["kind"]: r["n"] for r in selected.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    if asked is not None and sum(kinds.values()) + missing.count() != asked:
        out.append("selected and missing slugs are not all that was asked for")
    if pinned is not None and any(kinds.get(k, 0) != n for k, n in pinned.items()):
        out.append("counts differ from those that were authorised")
    return out
