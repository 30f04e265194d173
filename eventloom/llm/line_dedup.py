"""Removes passages of lines that stand earlier in the corpus.

Windows of three consecutive lines overlap; each is hashed (two 64-bit hashes).
Windows that occur more than once anywhere are found by a count per hash, and the
occurrence in the smallest document, then at the smallest place, stays. The lines of
all later ones are covered; covered places are merged per document and cut out.

All in DataFrame functions. Hashes and places are shuffled, not lines; counts are
merged before the shuffle, and the join that finds the later occurrences splits
hot windows (``hot_key_join``).

Lines end at a line feed. Lines of white space alone are in no window and stay.
A text of fewer than three other lines, but not none, is one window.

Defined cases: null and empty texts have no lines and stay as they are. Rows
without an id come before all others. Rows equal in id and text are one document
and lose the same lines. Windows that repeat within a document count like others, so
of a line repeated many times the first stays. Very long texts are taken whole. Other
columns stay; names that begin with ``dedup_`` must be free.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import written
from eventloom.operators.joins import hot_key_join

WINDOW = 3
_VISIBLE = r"[^ \t\n\x0B\f\r]"


def _all_lines(text: str) -> Column:
    """Every line with its place."""
    return F.transform(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x, i: F.struct(i.alias("at"), x.alias("line")))


def _visible(lines: Column) -> Column:
    return F.filter(lines, lambda s: s["line"].rlike(_VISIBLE))


def windows(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """doc_id, text_hash, place (among the visible lines) and two hashes of each window."""
    rows = docs.select(F.col(doc).alias("doc_id"), F.xxhash64(text).alias("text_hash"), _visible(_all_lines(text)).alias("lines"))
    last = F.greatest(F.size("lines") - F.lit(WINDOW), F.lit(0))
    starts = F.when(F.size("lines") > 0, F.sequence(F.lit(0), last))

    def window(i: Column) -> Column:
        parts = [F.get("lines", i + F.lit(k))["line"] for k in range(WINDOW)]
        return F.struct(i.alias("place"), F.xxhash64(F.lit(1), *parts).alias("h1"), F.xxhash64(F.lit(2), *parts).alias("h2"))

    return rows.select("doc_id", "text_hash", F.inline(F.transform(starts, window)))


def covered(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text_hash and the places of all windows that occur earlier."""
    found = written(windows(docs, doc, text), "windows")
    occurrence = F.struct("doc_id", "text_hash", "place")
    firsts = found.groupBy("h1", "h2").agg(F.min(occurrence).alias("first"), F.count("*").alias("n")).where("n > 1").select("h1", "h2", "first")
    firsts = written(firsts, "repeated")
    later = hot_key_join(found, firsts, ["h1", "h2"], spread_by=["doc_id", "place"]).where(~occurrence.eqNullSafe(F.col("first")))
    return later.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("place")).alias("places"))


def without_repeats(docs: DataFrame, doc: str = "doc_id", text: str = "text", removed: str | None = None) -> DataFrame:
    """The documents without the covered lines; ``removed`` names a column for how many those are."""
    clash = {c for c in docs.columns if c.startswith("dedup_") or c == removed}
    if clash:
        raise ValueError(f"rename these columns first: {sorted(clash)}")
    places = written(covered(docs, doc, text), "covered").select(F.col("doc_id").alias("dedup_doc"), F.col("text_hash").alias("dedup_of"), F.col("places").alias("dedup_places"))
    hashed = docs.withColumn("dedup_hash", F.xxhash64(text))
    # one plan at every size: the texts meet their places in one shuffle
    joined = hashed.join(places.hint("merge"), F.col(doc).eqNullSafe(F.col("dedup_doc")) & (F.col("dedup_hash") == F.col("dedup_of")), "left")

    visible = _visible(_all_lines(text))
    at = F.array_distinct(F.flatten(F.transform("dedup_places", lambda p: F.sequence(p, p + F.lit(WINDOW - 1)))))
    gone = F.array_compact(F.transform(at, lambda j: F.get("dedup_visible", j)))
    kept = F.array_except(_all_lines(text), gone)
    cut = F.array_join(F.transform(kept, lambda s: s["line"]), "\n")
    some = F.col("dedup_places").isNotNull()
    rows = joined.withColumn("dedup_visible", F.when(some, visible))
    out = [F.when(some, cut).otherwise(F.col(text)).alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns]
    if removed:
        out.append(F.when(some, F.size(gone)).otherwise(F.lit(0)).cast("long").alias(removed))
    return rows.select(out)


def digest(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, lines that are not blank, lines removed, SHA-256 of what is left."""
    rows = docs.select("doc_id", "text", F.size(_visible(_all_lines("text"))).cast("long").alias("n_lines"))
    out = without_repeats(rows, removed="n_removed")
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256).alias("text_sha256"))
