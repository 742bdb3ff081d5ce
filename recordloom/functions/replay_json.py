"""Fields of archived request documents in JSON, by paths of a variant: no Python runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: JSON texts that count as absent where one field stands in for another.
EMPTY = ["null", '""', "{}", "[]", "0", "0.0", "false"]

FIELDS = "title string, authority string, authority_slug string, authority_tags array<string>, state string, law_used string, first_seen string, last_updated string, request_id string"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once a row however often it is used."""
    return F.transform(F.array(value), use)[0]


def _seen(value: Column) -> Column:
    """A variant ``v`` and its JSON text ``j``, whose first character tells its kind."""
    return _let(value, lambda v: F.struct(v.alias("v"), F.to_json(v).alias("j")))


def _is_string(s: Column) -> Column:
    """Numbers beyond all doubles are quoted in JSON text too."""
    return s["j"].startswith('"') & ~(s["j"].isin('"Infinity"', '"-Infinity"') & (F.schema_of_variant(s["v"]) != "STRING"))


def _text(seen: Column) -> Column:
    """A scalar's text; JSON text of anything else; null for null."""
    return _let(seen, lambda s: F.when(_is_string(s), F.try_variant_get(s["v"], "$", "string")).when(s["j"] != "null", s["j"]))


def _get(document: Column, path: str) -> Column:
    return _seen(F.try_variant_get(document, path, "variant"))


def _first(document: Column, *paths: str) -> Column:
    """The first value that is there and does not count as absent."""
    return F.coalesce(*[_let(_get(document, p), lambda s: F.when(~s["j"].isin(EMPTY), s)) for p in paths])


def _tag(tag: Column) -> Column:
    """A tag, or the first entry of a tag pair."""
    return F.when(tag["j"].startswith("[") & (tag["j"] != "[]"), _text(_get(tag["v"], "$[0]"))).otherwise(_text(tag))


def replay_fields(text: Column) -> Column:
    """Struct of ``FIELDS`` from a document's text; null if the text is no JSON object.

    The authority is an object (name, slug, tags) or a scalar (a name); tags are texts or pairs of
    which the first counts, and other kinds are passed over. Text fields are '' where absent,
    times and the id are null. A text is parsed once.
    """
    is_object = text.rlike(r"^[ \t\r\n]*\{")
    return F.when(is_object, _let(F.try_parse_json(text), lambda doc: F.when(doc.isNotNull(), _let(_first(doc, "$.public_body", "$.authority"), lambda body: _fields(doc, body)))))


def _fields(doc: Column, body: Column) -> Column:
    is_object = F.coalesce(body["j"].startswith("{"), F.lit(False))
    within = lambda path: F.coalesce(_text(_first(body["v"], path)), F.lit(""))
    raw = F.when(is_object, F.try_variant_get(body["v"], "$.tags", "array<variant>"))
    kept = F.filter(F.transform(raw, _seen), lambda t: t["j"].startswith("[") | _is_string(t))
    tags = F.coalesce(F.transform(kept, _tag), F.array().cast("array<string>"))
    plain = lambda *paths: F.coalesce(_text(_first(doc, *paths)), F.lit(""))
    return F.struct(
        plain("$.title").alias("title"),
        F.when(is_object, within("$.name")).otherwise(F.coalesce(_text(body), F.lit(""))).alias("authority"),
        F.when(is_object, within("$.url_name")).otherwise(F.lit("")).alias("authority_slug"),
        tags.alias("authority_tags"),
        plain("$.state", "$.described_state").alias("state"),
        plain("$.law_used").alias("law_used"),
        F.coalesce(_text(_first(doc, "$.created_at")), _text(_get(doc, "$.date_created"))).alias("first_seen"),
        F.coalesce(_text(_first(doc, "$.updated_at")), _text(_get(doc, "$.date_updated"))).alias("last_updated"),
        _text(_get(doc, "$.id")).alias("request_id"),
    )


def record_count(document: Column) -> Column:
    """Records that a manifest's text states: in its meta object, else at its top, else 0."""
    count = lambda doc, path: _let(F.try_variant_get(doc, path, "bigint"), lambda n: F.nullif(n, F.lit(0).cast("bigint")))
    return _let(F.try_parse_json(document), lambda doc: F.coalesce(count(doc, "$.meta.record_count"), count(doc, "$.record_count"), F.lit(0).cast("bigint")))
