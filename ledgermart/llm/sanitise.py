"""Operator 6: information-theoretic sanitisation of personal data. DataFrame functions only.

Base spans (e-mail, IP, card and phone numbers) come from patterns and checks. Each value found is a
protected entity. Removing it isn't enough where a word beside it gives it away, so the corpus
says how much each term reveals: with document counts n(t), n(e) and n(t, e) (t within
``context`` characters of e) among N documents, a term discloses PMI(t; e) = ln(n(t, e) N / (n(t) n(e)))
of the IC(e) = ln(N / n(e)) that the entity holds. A term whose share PMI / IC reaches ``generalise``
is replaced by a placeholder where it stands beside the entity, and from ``remove`` on it is deleted.
Most entities stand in one text only, so pairs count at every support with ``SINGLE``: a term's
share is shrunk as if it had been met ``prior`` times more without regard to the entity, so a name met
once beside an address is generalised, in a corpus of any size (``firm``), and one met often beside it is removed. ``support`` above one
asks for that many different texts instead (copies of one text count once).

With ``whole`` a term counts wherever it stands in a document that holds the entity, not only within
``context`` characters, words are runs of letters, marks, digits and underscores of any length, and a
disclosing term is treated at each of its places in every document, also where the entity isn't written.
Entities held by exactly the same documents disclose alike, so one stands for all of them; terms too
frequent to disclose any entity never pair. Without ``whole`` words have three letters or more and are
treated beside the entity alone.

Patterns are written so that matching is linear: a run that failed once is not tried again from
its middle (possessive repetition, and a match starts only where a run starts or the last match ended).
Places of matches and the sanitised text are built in linear time too, by scans over short runs.
Terms are counted in one aggregate over all texts, after a filter for the words that may disclose an
entity. Texts never shuffle for that, only those that get term spans do, for the join
with their spans.

Edge cases: null text counts as empty and stays null; repeated rows get equal spans and count as one
document; an empty table gives an empty table; other columns, whatever their names, pass through.
Spans are in code points, end exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermart.llm.bitmaps import bitmap_of, bits_for, marked
from ledgermart.llm.common import scratch_table, text_of

# Kinds in order, and the contract's patterns in a linear form. In [A-Za-z0-9._%+-]+@
# a match starts at the start of a run of these characters, or where the last match ended in one;
# likewise for the digits of an address.
KINDS = ("email", "ip", "card", "phone", "term")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without these can't match.
TRIGGERS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
WORD = r"\p{L}{3,}+"
TERM = r"[\p{L}\p{M}\p{N}_]++"
SPAN = "struct<start:int,end:int,kind:int,value:string>"
#: Items folded at a time, and code points of a piece of a text.
RUN, PIECE = 256, 1024


@dataclass(frozen=True)
class Limits:
    """Thresholds of disclosure: shares of an entity's information, support in texts, context in characters, shrinkage in documents.

    ``firm``: in how many documents a term must be met with an entity before it is deleted rather than generalised.
    """

    generalise: float = 0.9
    remove: float = 0.97
    support: int = 3
    context: int = 100
    prior: float = 0.0
    whole: bool = False
    firm: int = 2


#: Every pair is scored, also those of one text; shrunk by half a document (0.9 is in reach from 58 documents on).
SINGLE = Limits(support=1, prior=0.5)
#: As ``SINGLE``, over whole documents and at every place.
WHOLE = Limits(support=1, prior=0.5, whole=True)


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(values: Column, step) -> Column:
    """Per item of an integer array, ``step`` over it and all before it, from 0 (a sum, a maximum).

    Spark copies what a fold carries at each step, so a fold that gathers n values copies n * n / 2.
    Here runs of ``RUN`` are folded, then their last values, so that even millions of items are few copies each.
    """

    def scan(items: Column) -> Column:
        begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        take = lambda done, x: F.struct(step(done["at"], x).alias("at"), F.array_append(done["out"], step(done["at"], x)).alias("out"))
        return F.aggregate(items, begin, take, lambda done: done["out"])

    def joined(runs: Column) -> Column:
        before = lambda last, i: F.coalesce(F.get(last, i - 1), F.lit(0))
        rest = lambda last: F.flatten(F.transform(runs, lambda run, i: F.transform(run, lambda x: step(before(last, i), x))))
        return let(scan(F.transform(runs, lambda run: F.element_at(run, -1))), rest)

    def whole(v: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / RUN).cast("int")), lambda k: scan(F.slice(v, k * RUN + 1, RUN)))
        return F.when(F.size(v) == 0, F.array().cast("array<int>")).otherwise(let(runs, joined))

    return let(values, whole)


def placed(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as an array of (start, end, value); what lies between them gives their places."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    sizes = lambda f: F.zip_with(F.slice(gaps, 1, F.size(f)), f, lambda gap, hit: F.length(gap) + F.length(hit))
    span = lambda hit, end: F.struct((end - F.length(hit)).alias("start"), end.alias("end"), hit.alias("value"))
    return let(found, lambda f: F.zip_with(f, running(sizes(f), lambda at, x: at + x), span))


def matches(text: Column, pattern: str, kind: int, passes=lambda value: F.lit(True)) -> Column:
    """Leftmost non-overlapping matches that pass, as an array of spans."""
    kept = F.filter(placed(text, pattern), lambda s: passes(s["value"]))
    return F.transform(kept, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind"), s["value"].alias("value")))


def apart(spans: Column, cut) -> Column:
    """``cut(span, reached)`` of each span of an array in order, where ``reached`` is the greatest end of those before it."""
    reach = lambda all_: running(F.transform(all_, lambda s: s["end"]), lambda at, x: F.greatest(at, x))
    return let(spans, lambda all_: let(reach(all_), lambda ends: F.transform(all_, lambda s, i: cut(s, F.coalesce(F.get(ends, i - 1), F.lit(0))))))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    def add(total: Column, place: Column) -> Column:
        digit = F.substring(number, F.length(number) - place + 1, F.lit(1)).cast("int")
        double = digit * 2
        return total + F.when(place % 2 == 1, digit).when(double > 9, double - 9).otherwise(double)

    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), add) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        short = lambda p: F.regexp_replace(p, "^0+", "")
        return F.forall(F.split(value, r"\."), lambda p: (F.length(short(p)) < 3) | ((F.length(short(p)) == 3) & (short(p) <= "255")))
    if kind == "card":
        return F.when(F.length(digits(value)).between(14, 19), luhn(digits(value))).otherwise(False)
    if kind == "phone":
        return F.length(digits(value)).between(10, 15)
    return F.lit(True)


def with_base_spans(df: DataFrame, text: str = "text", into: str = "base") -> DataFrame:
    """``df`` with its base spans, ordered by start, then kind."""
    for i, kind in enumerate(KINDS[:4]):
        # most texts have nothing of a kind, and an empty text costs nothing to match
        df = df.withColumn(f"t{i}", F.when(F.col(text).rlike(TRIGGERS[kind]), F.col(text)).otherwise(""))
    for i, kind in enumerate(KINDS[:4]):
        df = df.withColumn(f"s{i}", matches(F.col(f"t{i}"), PATTERNS[kind], i, lambda value, kind=kind: valid(kind, value)))
    drop = [f"{c}{i}" for c in "ts" for i in range(4)]
    ordered = F.array_sort(F.concat(*[F.transform(f"s{i}", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["value"].alias("value"))) for i in range(4)]))
    return df.withColumn(into, ordered).drop(*drop)


def entity_of(span: Column) -> Column:
    """The value's name: addresses in lower case, numbers by their digits."""
    return F.concat(span["kind"].cast("string"), F.lit(":"), F.when(span["kind"] <= 1, F.lower(span["value"])).otherwise(digits(span["value"])))


def beside(df: DataFrame, context: int) -> DataFrame:
    """(name, text_hash, entity, term, start, end): whole words within ``context`` characters of base spans, outside of all of them."""
    spans = df.select("name", "text_hash", "text", "base", F.explode("base").alias("span"))
    left, right = F.greatest(F.col("span.start") - context, F.lit(0)), F.col("span.end")
    windows = spans.select(
        "name", "text_hash", "base",
        entity_of(F.col("span")).alias("entity"),
        F.explode(F.array(
            F.struct(left.alias("at"), F.substring("text", left + 1, F.col("span.start") - left).alias("piece"), (left > 0).alias("cut_left"), F.lit(False).alias("cut_right")),
            F.struct(right.alias("at"), F.substring("text", right + 1, F.lit(context)).alias("piece"), F.lit(False).alias("cut_left"), (F.length("text") > right + context).alias("cut_right")),
        )).alias("w"),
    )
    words = windows.select("name", "text_hash", "base", "entity", "w", F.explode(matches(F.col("w.piece"), WORD, 4)).alias("word"))
    # a word at the window's cut may be the rest of a longer one
    whole = ~(F.col("w.cut_left") & (F.col("word.start") == 0)) & ~(F.col("w.cut_right") & (F.col("word.end") == F.length("w.piece")))
    start, end = F.col("w.at") + F.col("word.start"), F.col("w.at") + F.col("word.end")
    words = words.where(whole).select("name", "text_hash", "base", "entity", F.lower("word.value").alias("term"), start.alias("start"), end.alias("end"))
    return words.where(~F.exists("base", lambda s: (s["start"] < F.col("end")) & (F.col("start") < s["end"]))).drop("base")


def disclosing(rows: DataFrame, held: DataFrame, texts: DataFrame, limits: Limits) -> DataFrame:
    """(entity, term, share) of the pairs whose share of disclosure reaches ``limits.generalise``.

    ``rows``: what ``beside`` gives; ``held``: (name, entity) of all base spans; ``texts``: name and text of all documents.
    """
    in_texts = rows.select("entity", "term", "text_hash", "name").distinct().groupBy("entity", "term", "text_hash").agg(F.count("*").alias("docs"))
    pairs = in_texts.groupBy("entity", "term").agg(F.sum("docs").alias("n_both"), F.count("*").alias("texts")).where(F.col("texts") >= limits.support)
    pairs = scratch_table(pairs, "term-pairs")
    terms = scratch_table(pairs.select("term", F.xxhash64("term").alias("hash")).distinct(), "terms")
    bits = bits_for(terms.count())
    words = texts.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0)))).alias("term"))
    some = marked(words, F.xxhash64("term"), bitmap_of(terms, bits), bits, "maybe").where("maybe")
    n_term = some.groupBy("term").agg(F.count("*").alias("n_term"))
    n_entity = held.distinct().groupBy("entity").agg(F.count("*").alias("n_entity"))
    total = texts.count()
    known = pairs.join(n_term, "term").join(n_entity, "entity")
    return known.withColumn("share", share_of(limits, total)).where(F.col("share") >= limits.generalise).select("entity", "term", "share")


def share_of(limits: Limits, total: int) -> Column:
    """The share of its information that an entity loses to a term, from n_both, n_term and n_entity among ``total``."""
    info = F.log(F.lit(float(max(total, 1))) / F.col("n_entity"))
    met = F.col("n_both") + limits.prior * F.col("n_entity") / max(total, 1)
    # n(t) is at least n(t, e): a word beside an entity is a word of the text
    share = F.when(info > 0, 1 - F.log((F.greatest("n_term", "n_both") + limits.prior) / met) / info).otherwise(0.0)
    # the share of a pair met once grows with the corpus alone, which is no ground for deleting its term
    return F.when(F.col("n_both") < limits.firm, F.least(share, F.lit((limits.generalise + limits.remove) / 2))).otherwise(share)


def pieces_of(text: Column) -> Column:
    """The text in pieces of ``PIECE`` code points."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def between(pieces: Column, start: Column, end: Column) -> Column:
    """Code points ``start`` to ``end`` of a text in pieces, without walking through what stands before."""
    first, last = F.floor(start / PIECE).cast("int"), F.floor((end - 1) / PIECE).cast("int")
    part = lambda p, i: F.substring(p, F.greatest(start - (first + i) * PIECE, F.lit(0)) + 1, F.least(end - (first + i) * PIECE, F.lit(PIECE)) - F.greatest(start - (first + i) * PIECE, F.lit(0)))
    return F.when(end <= start, "").otherwise(F.concat_ws("", F.transform(F.slice(pieces, first + 1, last - first + 1), part)))


def replaced(text: Column, spans: Column, by) -> Column:
    """``text`` with each of the spans (start, end, ...; in order, apart from each other) replaced by ``by(span)``."""

    def over(pieces: Column, spans: Column) -> Column:
        before = lambda s, i: F.concat(between(pieces, F.when(i == 0, 0).otherwise(F.get(spans, i - 1)["end"]), s["start"]), by(s))
        tail = between(pieces, F.element_at(spans, -1)["end"], F.length(text))
        return F.concat(F.concat_ws("", F.transform(spans, before)), tail)

    # one value each, and no pieces where there is nothing to replace
    return let(spans, lambda held: F.when(F.size(held) == 0, text).otherwise(let(pieces_of(text), lambda pieces: over(pieces, held))))


def masked() -> Column:
    """``text`` with its base spans as blanks; all other characters keep their places."""

    cut = lambda s, reached: F.struct(F.greatest(reached, s["start"]).alias("start"), s["end"].alias("end"))
    blanks = F.filter(apart(F.col("base"), cut), lambda s: s["end"] > s["start"])
    return replaced(F.col("text"), blanks, lambda s: F.repeat(F.lit(" "), s["end"] - s["start"]))


def terms_in(text: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower))


def disclosing_anywhere(found: DataFrame, texts: DataFrame, limits: Limits) -> DataFrame:
    """(term, share) of the terms that disclose ``limits.generalise`` of an entity of a document they stand in.

    ``found``: name, text, text_hash and base of the documents with base spans; ``texts``: name and text of all documents.
    """
    total = texts.count()
    held = found.select("name", "text_hash", F.explode(F.array_distinct(F.transform("base", entity_of))).alias("entity"))
    holders = F.struct(F.count("*").alias("n_entity"), F.bit_xor("name").alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "name")).alias("y"))
    per_entity = held.groupBy("entity").agg(holders.alias("holders"))
    alike = scratch_table(per_entity.groupBy("holders").agg(F.min("entity").alias("entity")).select("entity", "holders.n_entity"), "entities")
    by_name = held.join(alike, "entity").groupBy("name").agg(F.collect_list(F.struct("entity", "n_entity")).alias("entities"))
    docs = scratch_table(found.select("name", "text_hash", terms_in(masked()).alias("terms")).join(by_name, "name"), "entity-terms")

    # n(t) of the words of these documents, and of those the ones that are rare enough for some entity
    words = scratch_table(docs.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("held_by")), "words")
    bits = bits_for(words.count())
    candidates = marked(texts.select(F.explode(terms_in(F.col("text"))).alias("term")), F.xxhash64("term"), bitmap_of(words.select(F.xxhash64("term").alias("hash")), bits), bits, "maybe")
    n_term = candidates.where("maybe").groupBy("term").agg(F.count("*").alias("n"))
    n_term = words.join(n_term, "term", "left").select("term", F.greatest("held_by", F.coalesce("n", F.lit(0))).alias("n_term"))
    most = alike.agg(F.max("n_entity")).first()[0] or 0
    rare = scratch_table(n_term.where(F.col("n_term") + limits.prior <= reach(most, total, limits)), "rare-terms")
    bits = bits_for(rare.count())
    some = marked(docs.select("text_hash", "entities", F.explode("terms").alias("term")), F.xxhash64("term"), bitmap_of(rare.select(F.xxhash64("term").alias("hash")), bits), bits, "maybe").where("maybe")
    pairs = some.select("term", "text_hash", F.explode("entities").alias("e")).select("term", "e.entity", "e.n_entity", "text_hash")
    if limits.support > 1:
        pairs = pairs.groupBy("term", "entity", "n_entity", "text_hash").agg(F.count("*").alias("docs"))
        pairs = pairs.groupBy("term", "entity", "n_entity").agg(F.sum("docs").alias("n_both"), F.count("*").alias("texts")).where(F.col("texts") >= limits.support)
    else:
        pairs = pairs.groupBy("term", "entity", "n_entity").agg(F.count("*").alias("n_both"))
    shares = pairs.join(rare, "term").withColumn("share", share_of(limits, total))
    return shares.groupBy("term").agg(F.max("share").alias("share")).where(F.col("share") >= limits.generalise)


def reach(n_entity: int, total: int, limits: Limits) -> float:
    """The most that n(t) plus the prior can be for an entity of ``n_entity`` documents; a little more, for rounding."""
    held = max(n_entity, 1)
    return 1.000001 * (held + limits.prior * held / max(total, 1)) * (max(total, 1) / held) ** (1 - limits.generalise)


def places_of_terms(rows: DataFrame, telling: DataFrame, limits: Limits) -> DataFrame:
    """(name, terms) of the documents in which a term of ``telling`` stands outside of base spans, with all its places."""
    bits = bits_for(telling.count())
    bitmap = bitmap_of(telling.select(F.xxhash64("term").alias("hash")), bits)
    words = marked(rows.select("name", F.explode(terms_in(F.col("text"))).alias("term")), F.xxhash64("term"), bitmap, bits, "maybe")
    has = words.where("maybe").select("name", "term").distinct().join(telling, "term")
    share_of_name = F.collect_list(F.when(F.col("share") >= limits.remove, F.col("term")))
    by_name = scratch_table(has.groupBy("name").agg(F.collect_list("term").alias("telling"), share_of_name.alias("gone")), "telling-names")
    bits = bits_for(by_name.count())
    docs = marked(rows, F.col("name"), bitmap_of(by_name.select(F.col("name").alias("hash")), bits), bits, "maybe").where("maybe").select("name", "text")
    docs = with_base_spans(docs.join(by_name, "name").dropDuplicates(["name"])).withColumn("text", masked())

    found = F.filter(placed(F.col("text"), TERM), lambda s: F.array_contains(F.col("telling"), F.lower(s["value"])))
    span = lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.array_contains(F.col("gone"), F.lower(s["value"])).alias("removed"))
    return docs.select("name", F.transform(found, span).alias("terms"))


def places_beside(found: DataFrame, rows: DataFrame, limits: Limits) -> DataFrame:
    """(name, terms) of the documents with terms to treat beside their entities."""
    context = scratch_table(beside(found, limits.context), "beside")
    held = found.select("name", F.explode("base").alias("span")).select("name", entity_of(F.col("span")).alias("entity"))
    telling = scratch_table(disclosing(context, held, rows.select("name", "text"), limits), "disclosing")
    term_spans = context.join(telling, ["entity", "term"]).groupBy("name", "start", "end").agg(F.max("share").alias("share"))
    removed = (F.col("share") >= limits.remove).alias("removed")
    return term_spans.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("start", "end", removed))).alias("terms"))


def spans(docs: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, text, base, terms): the input's columns as a struct, the text, base spans and term spans (start, end, removed)."""
    text = text_of(text_col)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.xxhash64(F.col(id_col), F.xxhash64(text)).alias("name"),
        text.alias("text"),
    )
    found = with_base_spans(rows.select("name", "text", F.xxhash64("text").alias("text_hash"))).where(F.size("base") > 0).dropDuplicates(["name"])
    found = scratch_table(found, "protected")
    if limits.whole:
        telling = scratch_table(disclosing_anywhere(found, rows.select("name", "text"), limits), "disclosing")
        by_name = scratch_table(places_of_terms(rows.select("name", "text"), telling, limits), "term-spans")
    else:
        by_name = scratch_table(places_beside(found, rows, limits), "term-spans")
    bits = bits_for(by_name.count())
    all_rows = marked(rows, F.col("name"), bitmap_of(by_name.select(F.col("name").alias("hash")), bits), bits, "maybe")
    none = F.array().cast("array<struct<start:int,end:int,removed:boolean>>")
    plain = all_rows.where("not maybe").select("row", "text", none.alias("terms"))
    joined = all_rows.where("maybe").join(by_name, "name", "left").select("row", "text", F.coalesce("terms", none).alias("terms"))
    return with_base_spans(plain.unionByName(joined)).select("row", "text", "base", "terms")


def listed(found: Column) -> Column:
    """kind:start:end of spans (start, kind, end), comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(found, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))


def all_spans() -> Column:
    """Base and term spans of a row of ``spans``, ordered by start, then kind."""
    base = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    terms = F.transform("terms", lambda s: F.struct(s["start"].alias("start"), F.lit(4).alias("kind"), s["end"].alias("end")))
    return F.array_sort(F.concat(base, terms))


def count_of(kind: str) -> Column:
    """Base spans of a kind in a row of ``spans``."""
    return F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("bigint")


def cleaned() -> Column:
    """The text of a row of ``spans`` with base spans as [EMAIL] and the like, generalised terms as [TERM], removed ones gone.

    Overlapping spans are one, named by the first.
    """
    labels = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    base = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.get(labels, s["kind"]).alias("label")))
    terms = F.transform("terms", lambda s: F.struct(s["start"].alias("start"), F.lit(4).alias("kind"), s["end"].alias("end"), F.when(s["removed"], "").otherwise("[TERM]").alias("label")))

    def cut(s: Column, reached: Column) -> Column:
        # a span that begins inside the last one lengthens it and brings no label of its own
        label = F.when(s["start"] < reached, "").otherwise(s["label"])
        return F.struct(F.greatest(reached, s["start"]).alias("start"), F.greatest(reached, s["end"]).alias("end"), (s["start"] < reached).alias("inside"), label.alias("label"))

    merged = F.filter(apart(F.array_sort(F.concat(base, terms)), cut), lambda s: ~s["inside"] | (s["end"] > s["start"]))
    return replaced(F.col("text"), merged, lambda s: s["label"])


def sanitise(docs: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` with the text sanitised; a null text stays null."""
    found = spans(docs, limits, id_col, text_col)
    text = F.when(F.col(f"row.`{text_col}`").isNull() | ((F.size("base") == 0) & (F.size("terms") == 0)), F.col(f"row.`{text_col}`")).otherwise(cleaned())
    return found.select(*[text.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
