"""Canonical JSON and content digests.

Inside Spark, equality of payloads is equality of ``canonical_text``. Digests that
must equal published ones byte by byte use ``canonical_bytes``, whose four
flavours differ in escaping and in what they refuse.
"""

from __future__ import annotations

import base64
import hashlib
import json
import math
import zlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLAVOURS = {
    "manifest": {"ensure_ascii": True, "default": str},
    "package": {"ensure_ascii": False, "allow_nan": False},
    "diff": {"ensure_ascii": False},
    "graph": {"ensure_ascii": True},
}


def canonical_bytes(value: object, flavour: str = "package") -> bytes:
    """Compact JSON with sorted keys."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), **FLAVOURS[flavour]).encode("utf-8")


def content_digest(value: object, flavour: str = "package") -> str:
    return hashlib.sha256(canonical_bytes(value, flavour)).hexdigest()


def json_digest(text: Column, flavour: str = "package") -> Column:
    """SHA-256 of the canonical form of JSON text; null for null, aborts on bad JSON."""

    @F.pandas_udf(T.StringType())
    def run(part: pd.Series) -> pd.Series:
        return part.map(lambda t: content_digest(json.loads(t), flavour) if isinstance(t, str) else None)

    return run(text)


def canonical_text(text: Column) -> Column:
    """Key-sorted JSON text inside the JVM; null if the text is no JSON."""
    return F.to_json(F.try_parse_json(text))


def file_digest(content: Column) -> Column:
    return F.sha2(content, 256)


def strict_json(text: str, label: str = "document") -> object:
    """Parse JSON; repeated keys and numbers that are not finite abort."""

    def pairs(items):
        found = dict(items)
        if len(found) != len(items):
            raise ValueError(f"{label}: repeated key")
        return found

    def refuse(name):
        raise ValueError(f"{label}: {name} is no JSON number")

    value = json.loads(text, object_pairs_hook=pairs, parse_constant=refuse)
    stack = [value]
    while stack:
        x = stack.pop()
        if isinstance(x, float) and not math.isfinite(x):
            refuse(x)
        stack += x.values() if isinstance(x, dict) else x if isinstance(x, list) else []
    return value


STATE_ENCODING = "zlib+base64"


def encode_state(state: dict, name: str = "backfill-state.v1") -> dict[str, str]:
    """Controller state in a wrapper of compressed JSON; ``name`` is the wrapper's format field."""
    packed = zlib.compress(canonical_bytes(state, "graph"), 9)
    return {"format": name, "encoding": STATE_ENCODING, "payload": base64.b64encode(packed).decode("ascii")}


def decode_state(body: str) -> dict:
    """Controller state from plain JSON or from a compressed wrapper; aborts on anything but an object."""
    value = json.loads(body)
    if isinstance(value, dict) and value.get("encoding") == STATE_ENCODING and "format" in value:
        if not value.get("payload"):
            raise ValueError("state wrapper has no payload")
        value = json.loads(zlib.decompress(base64.b64decode(value["payload"])))
    if not isinstance(value, dict):
        raise ValueError("controller state must be a JSON object")
    return value


@F.pandas_udf(T.StringType())
def decoded_states(bodies: pd.Series) -> pd.Series:
    """Column form of ``decode_state``: JSON text of each state."""
    return bodies.map(lambda b: canonical_bytes(decode_state(b), "diff").decode("utf-8") if isinstance(b, str) else None)
