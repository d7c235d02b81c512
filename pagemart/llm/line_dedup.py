"""Line deduplication by content-defined chunks.

A document's lines are hashed; a rolling hash over each two neighbouring line hashes marks a
boundary where its value falls on a fixed residue, so boundaries depend on nearby lines only and
come back when a passage is shifted or set into another document. The lines between boundaries form a chunk. A chunk of two
or more lines that occurs again anywhere is kept at its first place (smallest id, then place) and removed at the others,
after the bytes of the lines have been compared. Chunks of one line, and chunks whose boundaries lie outside a shared
passage, do not come back; the overlapping two-line windows cover those. DataFrame expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import doc_key, lookup, settle, sheltered

DIVISOR = 2       # a boundary at one line in so many


def boundaries(hashes: str, divisor: int) -> Column:
    """Indexes (from 0) at which chunks start: 0, and i where the rolling hash of lines i and i + 1 falls on the residue."""
    rolling = lambda i: F.pmod(F.xxhash64(F.element_at(hashes, i + 1), F.element_at(hashes, i + 2)), F.lit(divisor)) == 0
    inner = F.filter(F.sequence(F.lit(1), F.size(hashes) - 2), rolling)
    return F.concat(F.array(F.lit(0)), F.when(F.size(hashes) > 2, inner).otherwise(F.array().cast("array<int>")))


def chunked(docs: DataFrame, text: str, divisor: int) -> DataFrame:
    """``docs`` with lines (array) and spans (array of the chunks' start and n lines)."""
    return (docs.withColumn("lines", F.split(F.coalesce(F.col(text), F.lit("")), "\n"))
            .withColumn("hashes", F.transform("lines", lambda x: F.xxhash64(x)))
            .withColumn("starts", boundaries("hashes", divisor))
            .withColumn("spans", F.transform("starts", lambda s, i: F.struct(
                s.alias("start"), (F.coalesce(F.try_element_at("starts", i + 2), F.size("lines")) - s).alias("n"))))
            .drop("hashes", "starts"))


def chunk_text(span: Column) -> Column:
    return F.array_join(F.slice("lines", span["start"] + 1, span["n"]), "\n")


def windows() -> Column:
    """Every two neighbouring lines that are not blank, as (start, n lines); blank lines between them belong to the window."""
    at = F.sequence(F.lit(0), F.size("lines") - 1)
    solid = F.filter(at, lambda i: F.element_at("lines", i + 1).rlike(r"(?U)\S"))
    return F.transform(F.slice(solid, 1, F.greatest(F.size(solid) - 1, F.lit(0))), lambda s, i: F.struct(
        s.alias("start"), (F.element_at(solid, i + 2) - s + 1).alias("n")))


def hashed(span: Column) -> list[Column]:
    return [span["start"].alias("start"), span["n"].alias("n"), F.xxhash64(chunk_text(span)).alias("h"),
            F.xxhash64(F.lit(1), chunk_text(span)).alias("h2")]


def window_places(keyed: DataFrame) -> DataFrame:
    """(k_id, k_text, start, n, h, h2): the overlapping two-line windows, with two hashes of their bytes."""
    found = (keyed.withColumn("lines", F.split(F.coalesce(F.col("text"), F.lit("")), "\n")).withColumn("spans", windows())
             .select("k_id", "k_text", F.explode(F.transform("spans", lambda s: F.struct(*hashed(s)))).alias("s")))
    return found.select("k_id", "k_text", "s.*")


def chunk_places(keyed: DataFrame, divisor: int) -> DataFrame:
    """(k_id, k_text, start, n, h, h2): the multi-line chunks that are not blank, with two hashes of their bytes."""
    spans = F.explode(F.filter("spans", lambda s: s["n"] > 1)).alias("s")
    return (chunked(keyed, "text", divisor).select("k_id", "k_text", "lines", spans)
            .select("k_id", "k_text", F.col("s.start").alias("start"), F.col("s.n").alias("n"), chunk_text(F.col("s")).alias("chunk"))
            .where(F.trim(F.col("chunk")) != "")
            .select("k_id", "k_text", "start", "n", F.xxhash64("chunk").alias("h"), F.xxhash64(F.lit(1), "chunk").alias("h2")))


def without(lines: str, gone: str) -> Column:
    """``lines`` without those of the spans ``gone``."""
    lost = F.array_distinct(F.flatten(F.transform(gone, lambda s: F.sequence(s["start"], s["start"] + s["n"] - 1))))
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), lost)
    return F.transform(left, lambda i: F.element_at(lines, i + 1))


def deduplicate_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", divisor: int = DIVISOR,
                      overlapping: bool = False) -> DataFrame:
    """``docs`` with ``text`` freed of repeated multi-line chunks, and n_lines and n_removed (lines).

    With ``overlapping`` the two-line windows take part too, so every passage of two or more lines that is not blank goes from
    all places but its first, wherever the chunk boundaries fall; a line goes if a window or chunk over it has an earlier place.
    Of equal chunks the first by (id, text hash, line) stays; null ids come first. A document may lose all lines; its text is then
    empty. A null text stays null with n_lines 0. Repeated rows are one document: each of them keeps or loses the same
    lines. Columns of ``docs`` named n_lines or n_removed are replaced; all others stay, whatever their names. Texts and lines may have
    any length."""
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    docs, (doc_id, text) = sheltered(docs.select(*names), doc_id, text)
    key, hashes, place = ["k_id", "k_text"], ["h", "h2"], F.struct("k_id", "k_text", "start", "n")
    keyed = docs.select(*doc_key(doc_id, text), F.col(text).alias("text"))
    places = chunk_places(keyed, divisor)
    places = settle((places.union(window_places(keyed)) if overlapping else places).distinct(), "line-chunks")
    total = places.count()
    again = settle(places.groupBy(*hashes).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1"), "line-again")

    # Bytes decide: chunks of a repeated hash meet by their text. Only if a hash stands for a single text are its later places removed.
    span = F.struct("start", "n")
    marked = lookup(places, again, hashes, "copies", total).groupBy(*key).agg(F.collect_set(span).alias("marked"))
    suspects = (keyed.join(marked.hint("merge"), key).withColumn("lines", F.split(F.coalesce(F.col("text"), F.lit("")), "\n"))
                .select(*key, F.explode(F.transform("marked", lambda s: F.struct(
                    *hashed(s), chunk_text(s).alias("chunk")))).alias("s"))
                .select(*key, "s.*").select(place.alias("place"), *hashes, "chunk"))
    texts = suspects.groupBy(*hashes, "chunk").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("copies"))
    proven = (texts.groupBy(*hashes).agg(F.count(F.lit(1)).alias("texts"), F.min("first").alias("first"), F.sum("copies").alias("copies"))
              .where("texts = 1 and copies > 1").drop("texts"))
    late = lookup(places, settle(proven, "line-proven"), hashes, "copies", total).where(place != F.col("first"))
    removed = settle(late.groupBy(*key).agg(F.collect_set(span).alias("gone")), "line-gone")

    kept = docs.columns
    whole = (docs.select(*kept, *doc_key(doc_id, text)).join(removed.hint("merge"), key, "left")
             .withColumn("lines", F.split(F.coalesce(F.col(text), F.lit("")), "\n")))
    return (whole.withColumn("left", F.when(F.col("gone").isNull(), F.col("lines")).otherwise(without("lines", "gone")))
            .withColumn("n_lines", F.when(F.col(text).isNull(), 0).otherwise(F.size("lines")))
            .withColumn("n_removed", F.size("lines") - F.size("left"))
            .withColumn(text, F.when(F.col("gone").isNull(), F.col(text)).otherwise(F.array_join("left", "\n")))
            .select(*kept, "n_lines", "n_removed").toDF(*names, "n_lines", "n_removed"))
