"""Versioned evidence, split indexes, provenance and cards."""

from __future__ import annotations

import hashlib
from datetime import date
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .documents import write_bytes, write_json, write_table


def write_versioned(folder: str, name: str, document: dict, month: date) -> tuple[str, str]:
    """Write a document under its month and as the latest."""
    month_path = Path(folder) / f"{month:%Y-%m}" / name
    latest = Path(folder) / "latest" / name
    for path in (month_path, latest):
        write_json(path, document)
    return str(month_path), str(latest)


def write_split(df: DataFrame, path: str, column: str) -> None:
    """One folder per value of a column, internal columns left out."""
    df.drop(*[c for c in df.columns if c.startswith("_")]).repartition(column).write.mode("overwrite").partitionBy(column).parquet(path)


def artifact_rows(root: str, patterns: list[str]) -> list[dict]:
    """Name, size and sha256 of the files that patterns find, once each, in order."""
    base = Path(root)
    found = sorted({p for pattern in patterns for p in base.glob(pattern) if p.is_file() and not p.is_symlink()})
    return [{"name": p.relative_to(base).as_posix(), "size": p.stat().st_size, "sha256": hashlib.sha256(p.read_bytes()).hexdigest()} for p in found]


def provenance(rule: str, inputs: list[dict], outputs: list[dict], counts: dict) -> dict:
    """What was made of what, by which rule."""
    return {"transformation": rule, "inputs": sorted(inputs, key=lambda r: r["name"]), "outputs": sorted(outputs, key=lambda r: r["name"]), "counts": counts}


def input_receipt(df: DataFrame) -> DataFrame:
    """Files and bytes of binary-file rows, and a digest of their digests in path order."""
    one = df.select("path", "length", F.sha2("content", 256).alias("sha256"))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("path", "sha256"))), lambda x: x["sha256"]), "\n")
    return one.agg(F.count("*").alias("files"), F.sum("length").alias("bytes"), F.sha2(listed, 256).alias("sha256"))


def dataset_card(title: str, languages: list[str], license_name: str, summary: dict[str, object], text: str) -> str:
    """A card with front matter, a table of figures and a text."""
    front = ["---", f"pretty_name: {title}", f"license: {license_name}", "language:", *[f"- {x}" for x in languages], "---"]
    table = ["| Figure | Value |", "|---|---|", *[f"| {k} | {v} |" for k, v in sorted(summary.items())]]
    return "\n".join([*front, "", f"# {title}", "", text, "", *table, ""])


def write_card(path: str, card: str) -> None:
    write_bytes(path, card.encode("utf-8"))


def write_reports(reports: DataFrame, path: str) -> None:
    """Mirror reports as one table."""
    write_table(reports.orderBy("mirror"), path)
