"""Quality rules: plain text rules plus a hashed n-gram log-likelihood ratio.

DataFrame functions only; no Python runs on the executors.

Every word and every pair of adjacent words is hashed to one of ``buckets``
counters. Two multinomials are counted, one over the trusted documents and one
over the whole corpus; the weight of a bucket is the logarithm of the ratio of
its smoothed shares. A document's score is the mean weight of its features. Half of
the trusted documents (by hash of the id) feed the trusted multinomial; the
threshold is a fixed low percentile of the scores of the other half, which the
weights have not seen, so that it is right for unseen clean text and the same for
every run over the same tables.

All trusted documents count; their ids are counted first and broadcast only where they
are few. The weight table has ``buckets`` rows, which bounds its broadcast.
Counting is a partial aggregate per task with at most ``buckets`` groups. Word
windows are compared inside their row, so a hot source or text moves no data.

Rows: null and empty texts have no words and fail the rules; repeated rows and
null ids are judged row by row; without a trusted document no document is
rejected by score.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import CONTENT, materialise_native, small_side, text_keys

BUCKETS = 1 << 16
STEP = 1e-6
PERCENTILE = 0.001
SMOOTHING = 1.0
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

_SPACE = " \t\n\x0b\f\r"
_SPLIT = "[ \\t\\n\\x0B\\f\\r]+"
_SYMBOLS = "#*$%&|<>"


def words_of(text: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+`; null gives none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _SPLIT), "")


def _windows(hashes: Column) -> Column:
    """Hash of each window of five words."""
    last = F.size(hashes) - WINDOW
    at = lambda i, k: F.get(hashes, i + k)
    each = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.xxhash64(*[at(i, k) for k in range(WINDOW)]))
    return F.when(last >= 0, each).otherwise(F.array().cast("array<bigint>"))


def _repeat_words(windows: Column) -> Column:
    """Words inside windows that occur at least twice (64-bit equality)."""
    placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    twin = lambda s, x, j, d: F.coalesce(F.get(s, j + d)["h"] == x["h"], F.lit(False))
    starts = lambda s: F.array_sort(F.transform(F.filter(s, lambda x, j: F.when(j > 0, twin(s, x, j, -1)).otherwise(False) | twin(s, x, j, 1)), lambda x: x["i"]))
    # bind intermediate arrays once each by a one-element transform
    bind = lambda value, use: F.get(F.transform(F.array(value), use), F.lit(0))
    covered = lambda p: F.aggregate(F.transform(p, lambda a, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - a, F.lit(WINDOW)))), F.lit(0), lambda x, y: x + y)
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(bind(placed, lambda s: bind(starts(s), covered)))


def _dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.length(F.translate(x, _SPACE, "")) > 0)
    return F.size(lines) - F.size(F.array_distinct(lines))


def base_columns(docs: DataFrame) -> DataFrame:
    """Rule counts of rows (doc_id, text, trusted), keeping `words`."""
    text = F.coalesce("text", F.lit(""))
    bare = F.length(F.translate(text, _SPACE, ""))
    step = docs.select("doc_id", "trusted", *text_keys(F.col("text")), bare.cast("bigint").alias("word_chars"), (F.length(text) - F.length(F.translate(text, _SYMBOLS, ""))).cast("bigint").alias("n_symbols"), _dup_lines(F.col("text")).cast("bigint").alias("n_dup_lines"), words_of(F.col("text")).alias("words"))
    step = step.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    step = step.withColumn("windows", _windows(F.col("hashes")))
    return step.select("doc_id", "trusted", *CONTENT, F.size("words").cast("bigint").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", _repeat_words(F.col("windows")).cast("bigint").alias("n_repeat_words"), "hashes")


def _features(rows: DataFrame, buckets: int, *keep: str) -> DataFrame:
    """One row per word: its bucket f1, and f2 for it with the next word (null at the end)."""
    n = F.size("hashes")
    place = F.explode_outer(F.when(n > 0, F.sequence(F.lit(0), n - 1)))
    rows = rows.select(*keep, "hashes", place.alias("i"))
    here, after = F.get("hashes", F.col("i")), F.get("hashes", F.col("i") + 1)
    bucket = lambda *h: F.pmod(F.xxhash64(*h), F.lit(buckets)).cast("int")
    return rows.select(*keep, F.when(here.isNotNull(), bucket(here)).alias("f1"), F.when(after.isNotNull(), bucket(here, after)).alias("f2"))


def weights(rows: DataFrame, buckets: int, smoothing: float = SMOOTHING) -> DataFrame:
    """Log ratio of the trusted to the corpus share of each bucket: f, w."""
    seen = _features(rows, buckets, "trusted").select("trusted", F.explode(F.array("f1", "f2")).alias("f")).where("f is not null")
    counts = seen.groupBy("f").agg(F.count("*").alias("raw"), F.sum(F.col("trusted").cast("bigint")).alias("target"))
    totals = counts.agg(F.sum("raw").alias("raws"), F.sum("target").alias("targets"))
    share = lambda c, n: (F.col(c) + smoothing) / (F.col(n) + smoothing * buckets)
    weight = F.when(F.col("targets") > 0, F.log(share("target", "targets")) - F.log(share("raw", "raws"))).otherwise(F.lit(0.0))
    return counts.crossJoin(F.broadcast(totals)).select("f", weight.alias("w"))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Distinct ids of labels with quality 1."""
    return labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("bigint").alias("trusted_id")).distinct()


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS, percentile: float = PERCENTILE) -> DataFrame:
    """Per row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, llr, and the content keys.

    The verdict depends on the text alone.
    """
    known = materialise_native(trusted_ids(labels), "trusted")
    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    flagged = source.join(small_side(known), F.col("doc_id") == F.col("trusted_id"), "left").select("doc_id", "text", F.col("trusted_id").isNotNull().alias("trusted"))
    fits = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    hashed = flagged.select((F.col("trusted") & F.coalesce(fits, F.lit(False))).alias("trusted"), F.transform(words_of(F.col("text")), lambda w: F.xxhash64(w)).alias("hashes"))
    table = materialise_native(weights(hashed, buckets), "llr-weights")
    base = base_columns(flagged).withColumn("row_id", F.monotonically_increasing_id())
    kept = ["doc_id", "trusted", *CONTENT, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    one, two = (F.broadcast(table.select(F.col("f").alias(f"f{k}"), F.col("w").alias(f"w{k}"))) for k in (1, 2))
    scored = _features(base, buckets, "row_id", *kept).join(one, "f1", "left").join(two, "f2", "left")
    scored = scored.groupBy("row_id").agg(*[F.first(c).alias(c) for c in kept], F.sum(F.coalesce("w1", F.lit(0.0)) + F.coalesce("w2", F.lit(0.0))).alias("total"))
    scored = scored.withColumn("llr", F.when(F.col("n_words") > 0, F.col("total") / (2 * F.col("n_words") - 1)).otherwise(F.lit(0.0)))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    scored = materialise_native(scored.drop("total").withColumn("base_failed", failed), "llr-scores")
    # over a histogram in steps of STEP, so that no task holds all scores
    held = scored.where(F.col("trusted") & ~F.col("base_failed") & ~fits).groupBy(F.floor(F.col("llr") / STEP).alias("step")).agg(F.count("*").alias("n"))
    least = held.agg((F.percentile("step", F.lit(percentile), F.col("n")) * F.lit(STEP)).alias("least"))
    passed = ~F.col("base_failed") & (F.coalesce("least", F.lit(float("-inf"))) <= F.col("llr"))
    return scored.crossJoin(F.broadcast(least)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", passed.alias("kept"), "llr", *CONTENT)
