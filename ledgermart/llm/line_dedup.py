"""Operator 2: lines repeated up to one edit, by a deletion-neighbourhood join. DataFrame functions only.

Of lines that are equal, the earliest stays (by document id, then place). A line within one
character edit of a line that first occurs earlier goes too, in all its places.

Two lines within one edit share a variant: both without the same character (a substitution), or
the longer one without a character and the shorter one whole. Variants are hashed and joined. Deleting
every character of every line would write the corpus many times over, so two exact screens come first:
an edit lies in one half of a line, so the other half has to be shared; and in one of ``SEGMENTS``
segments, so all the rest has to be shared. Only the characters of such a segment are deleted.
Inside a bucket of equal variants of a substitution all lines are within one edit, so each is held
against the bucket's earliest alone; for an insertion the whole line is held against the earliest of
the longer ones. No pairs within a bucket are listed. The edit distance is verified on the texts.

Blank lines (spaces and ASCII control white space) always stay, and lines of fewer than ``min_chars``
characters beside spaces, if it is given; from ``near_chars`` on, one edit counts as equal. Texts shuffle only where a filter says that they may be concerned.

Edge cases: a null text stays null and an empty one empty, with no lines dropped; blank lines stay;
rows that agree in id and text are one document and get the same text; null ids come first; ids
that repeat with different texts are ordered by a hash of the text; a document all of whose lines go
gets an empty text; an empty table gives an empty table; other columns, whatever their names, pass
through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermart.llm.bitmaps import bitmap_of, bits_for, marked
from ledgermart.llm.common import scratch_table, text_of

#: Equal lines of any length count as repeated; only the near join has a floor.
MIN_CHARS = 1
NEAR_CHARS = 20
SEGMENTS = 8
#: A line that isn't blank.
SAYS = r"[^\x20\x09-\x0D]"
CUT, LONGER, WHOLE = 0, 1, 2


def _cut(line: str, start: Column, end: Column) -> Column:
    """Characters start (from 0) up to end of the column ``line``."""
    return F.substring(F.col(line), start + 1, F.greatest(end - start, F.lit(0)))


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, text) to doc_id, name, pos, line for lines of at least ``min_chars`` characters."""
    named = docs.select("doc_id", F.xxhash64("doc_id", F.xxhash64("text")).alias("name"), "text")
    return named.select("doc_id", "name", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))


def halves(size: int) -> list[Column]:
    """Keys of a line as one of length ``m``: its first floor(m / 2) characters, its last m - floor(m / 2)."""
    m = F.col("chars") - size
    half = F.floor(m / 2).cast("int")
    first, last = _cut("line", F.lit(0), half), _cut("line", F.col("chars") - (m - half), F.col("chars"))
    return [F.xxhash64(F.lit("first"), m, first), F.xxhash64(F.lit("last"), m, last)]


def near_pairs(distinct: DataFrame) -> DataFrame:
    """(h1, h2, earlier h1, h2) for lines that have an earlier one within one edit.

    ``distinct``: line, chars, h1, h2 and first (ordered place of the first occurrence).
    """
    who = F.struct("first", "h1", "h2").alias("who")
    keyed = distinct.select("line", "chars", who, F.explode(F.array(F.lit(0), F.lit(1))).alias("size"))
    parts = F.sequence(F.lit(0), F.lit(SEGMENTS - 1))
    # as a line of length m = chars - size; the segment's end counts from the line's end
    cells = keyed.select("line", "chars", "who", "size", (F.col("chars") - F.col("size")).alias("m"), F.explode(parts).alias("part"))
    begin = F.floor(F.col("m") * F.col("part") / SEGMENTS).cast("int")
    after = F.col("m") - F.floor(F.col("m") * (F.col("part") + 1) / SEGMENTS).cast("int")
    cells = cells.withColumn("begin", begin).withColumn("end", F.col("chars") - after)
    rest = F.xxhash64("m", "part", _cut("line", F.lit(0), F.col("begin")), _cut("line", F.col("end"), F.col("chars")))
    cells = cells.select("who", "size", rest.alias("rest"), _cut("line", F.col("begin"), F.col("end")).alias("segment"))
    shared = cells.groupBy("rest").agg(F.count("*").alias("times")).where("times > 1").select("rest")
    close = cells.join(shared, "rest", "left_semi")

    # variants: of a line of length m without character i (CUT) or WHOLE; of a longer one without a character (LONGER)
    n = F.length("segment")
    places = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    without = lambda i: F.concat(F.substring(F.col("segment"), F.lit(1), i), F.substring(F.col("segment"), i + 2, n))
    whole = F.struct(F.xxhash64("rest", F.lit("whole"), "segment").alias("key"), F.lit(WHOLE).alias("kind"))
    cut = F.transform(places, lambda i: F.struct(F.xxhash64(F.col("rest"), i, without(i)).alias("key"), F.lit(CUT).alias("kind")))
    longer = F.transform(places, lambda i: F.struct(F.xxhash64(F.col("rest"), F.lit("whole"), without(i)).alias("key"), F.lit(LONGER).alias("kind")))
    variants = close.select("who", F.explode(F.when(F.col("size") == 0, F.array_append(cut, whole)).otherwise(longer)).alias("v")).select("who", "v.key", "v.kind")
    is_whole = F.col("kind") == WHOLE
    buckets = variants.groupBy("key").agg(F.min(F.when(~is_whole, F.col("who"))).alias("cut"), F.min(F.when(is_whole, F.col("who"))).alias("uncut"), F.count("*").alias("times"))
    met = variants.join(buckets.where("times > 1").drop("times"), "key")
    # longer lines meet the whole one, all others the earliest of those that lost a character
    partner = F.when(F.col("kind") == LONGER, F.col("uncut")).otherwise(F.col("cut"))
    found = met.withColumn("partner", partner).where(F.col("partner") < F.col("who"))
    return found.groupBy("who").agg(F.min("partner").alias("partner")).select(F.col("who.h1").alias("h1"), F.col("who.h2").alias("h2"), F.col("partner.h1").alias("e1"), F.col("partner.h2").alias("e2"))


def repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, near_chars: int = NEAR_CHARS) -> DataFrame:
    """(name, gone, near) for documents that lose lines: places of the lines that go, and how many of them are not equal to an earlier line."""
    lines = lines_of(docs).withColumn("chars", F.length("line")).where(F.col("line").rlike(SAYS) & (F.length(F.trim("line")) >= min_chars))
    lines = lines.withColumn("h1", F.xxhash64("line")).withColumn("h2", F.xxhash64(F.lit(1), "line"))
    place = F.struct("doc_id", "name", "pos")
    near = F.col("chars") >= near_chars
    keys = F.when(near, F.array(*halves(0), *halves(1))).otherwise(F.array().cast("array<bigint>"))
    # what is known of a line without its text; equal lines meet in partial aggregates
    distinct = scratch_table(
        lines.select("h1", "h2", place.alias("place"), keys.alias("keys")).groupBy("h1", "h2", "keys").agg(F.min("place").alias("first"), F.count("*").alias("times")),
        "lines",
    )
    half = distinct.select("h1", F.explode("keys").alias("key"))
    shared = half.groupBy("key").agg(F.count("*").alias("times")).where("times > 1").select("key")
    flagged = scratch_table(half.join(shared, "key", "left_semi").select(F.col("h1").alias("hash")).distinct(), "flagged")
    bits = bits_for(flagged.count())
    maybe = marked(lines.where(near), F.col("h1"), bitmap_of(flagged, bits), bits, "maybe").where("maybe")
    texts = maybe.select("h1", "h2", "line", place.alias("place")).groupBy("h1", "h2").agg(F.any_value("line").alias("line"), F.min("place").alias("first")).withColumn("chars", F.length("line"))
    texts = scratch_table(texts.join(flagged, texts["h1"] == flagged["hash"], "left_semi"), "line-texts")

    pairs = near_pairs(texts)
    one = texts.select("h1", "h2", "line")
    two = texts.select(F.col("h1").alias("e1"), F.col("h2").alias("e2"), F.col("line").alias("earlier"))
    verified = pairs.join(one, ["h1", "h2"]).join(two, ["e1", "e2"]).where(F.levenshtein("line", "earlier", 1) >= 0)
    close = scratch_table(verified.select("h1", "h2", F.lit(True).alias("near")), "near-lines")

    verdicts = distinct.drop("keys").join(close, ["h1", "h2"], "left").where("times > 1 or near")
    places = lines.select("h1", "h2", "name", "pos", place.alias("place"))
    gone = places.join(verdicts, ["h1", "h2"]).where(F.coalesce("near", F.lit(False)) | (F.col("place") > F.col("first")))
    return gone.groupBy("name").agg(F.collect_set("pos").alias("gone"), F.count_if("near").alias("near"))


def dedup(docs: DataFrame, min_chars: int = MIN_CHARS, near_chars: int = NEAR_CHARS, id_col: str = "doc_id", text_col: str = "text", counts: tuple[str, str, str] = ("n_lines", "n_dropped", "n_near")) -> DataFrame:
    """All columns of ``docs`` with the text's repeated lines removed, and the three ``counts`` columns."""
    text = text_of(text_col)
    drops = scratch_table(repeated_lines(docs.select(F.col(id_col).alias("doc_id"), text.alias("text")), min_chars, near_chars), "line-drops")
    bits = bits_for(drops.count())
    # the input's columns travel in one struct, so their names don't matter
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.xxhash64(F.col(id_col), F.xxhash64(text)).alias("name"), text.alias("now"))
    rows = marked(rows, F.col("name"), bitmap_of(drops.select(F.col("name").alias("hash")), bits), bits, "maybe")
    none = F.array().cast("array<int>")
    through = rows.where("not maybe").select("row", "now", none.alias("gone"), F.lit(0).cast("bigint").alias("near"))
    through = through.unionByName(rows.where("maybe").join(drops, "name", "left").select("row", "now", F.coalesce("gone", none).alias("gone"), F.coalesce("near", F.lit(0).cast("bigint")).alias("near")))
    split = F.split("now", "\n", -1)
    stay = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("gone"))
    fewer = F.concat_ws("\n", F.transform(F.array_sort(stay), lambda i: F.get(split, i)))
    changed = F.when(F.size("gone") == 0, F.col(f"row.`{text_col}`")).otherwise(fewer)
    kept = [changed.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    lines = F.when(F.col("now") == "", F.lit(0)).otherwise(F.size(split)).cast("bigint")
    return through.select(*kept, lines.alias(counts[0]), F.size("gone").cast("bigint").alias(counts[1]), F.col("near").alias(counts[2]))
