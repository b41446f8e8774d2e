"""Benchmark decontamination by template canonicalisation, in DataFrame functions only.

Texts become templates: numbers (digits or number words), units after a
number and names (a capitalised word inside a sentence, or a common given
name) are each replaced by a typed placeholder, the other words are
lower-cased, marks are dropped.  Windows of ``WINDOW`` template tokens are
hash-joined with the benchmark's, so a question with other numbers, names or
units is found.  A match keeps the slot values of both sides.  A window whose words
all equal the item's (but for case) is always kept; within any other window a
benchmark value must always become the same document value (several may become
one), else that window, and it alone, is dropped as a chance likeness.

The join runs in three steps.  Each benchmark window names its longest plain word as its anchor.
The tokens of the documents meet the *distinct* (anchor, place, length) rows, a few per word however
many windows share it; around such a token, and only there, the text is canonicalised.
The template's hash, and that of the words, is then equi-joined with the windows', and what meets is
compared whole.  Equal templates have equal plain words, so no window is missed, and the texts
are neither canonicalised nor shuffled as a whole.

A window with fewer than ``LITERALS`` plain words matches verbatim, as its template alone is no
evidence; its anchor is the longest of all its tokens.  If it is a whole item of at least
``FEWEST`` plain words, its template matches too where the document has it as a sentence of its own
(no word before or after it is tied to it by a blank or a comma), slots consistent: a short question with
other numbers.  An item shorter than a window is matched as a whole, however short it is: every
document that holds a one-word item's word is reported with it, but ``clean`` lets an item of fewer than
``LITERALS`` tokens remove a document only where it is such a sentence.

Cases: null and empty texts match nothing; several items of one text are each
reported; repeated rows are reported once; rows sharing a doc_id are told apart by
their text; null doc_ids and item_ids are kept; empty tables give an empty
result; extra columns are ignored, and kept by ``clean``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_key, written

WINDOW = 10
LITERALS = 5
FEWEST = 2
MOST_SHAPES = 500_000                         # (anchor, place, length) rows of 24 bytes; beyond it the token join is shuffled

NUMBER, UNIT, NAME = "\uE001", "\uE002", "\uE003"   # private-use characters as placeholders

# Number words, units of measure, common given names.
NUMBER_WORDS = ("two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen "
                "sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty "
                "ninety hundred thousand million billion")
UNITS = ("mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres "
         "kilometer kilometers kilometre kilometres centimeter centimeters mg g kg lb lbs oz gram grams "
         "kilogram kilograms pound pounds ounce ounces ton tons ml l liter liters litre litres gallon "
         "gallons second seconds minute minutes hour hours day days week weeks month months year years "
         "cent cents dollar dollars euro euros percent degree degrees mph kmh")
GIVEN_NAMES = ("Adam Alice Amy Andrew Anna Anne Ben Bob Carl Carlos Carol Charlie Claire Dan Daniel David "
               "Diana Emily Emma Eric Eva Frank George Grace Hannah Harry Helen Henry Ivan Jack James "
               "Jane Janet Jason Jen Jenny Jerry Jessica Jim Joe John Jose Josh Juan Julia Julie Karen "
               "Kate Kevin Laura Lily Linda Lisa Lucy Luis Maria Mark Martha Martin Mary Matt Max Mia "
               "Michael Mike Nancy Natalie Nick Olivia Pablo Paul Peter Rachel Robert Ryan Sam Samantha "
               "Sara Sarah Sophia Steve Susan Thomas Tim Tom Tony Victor William")

# A token keeps the blank (after a comma or semicolon at most) that ties it to the token before:
# such a token stands inside a sentence.  Java recurses once per repeat of a group unless it is possessive.
TOKEN = ("(?:(?<=[\\p{L}\\p{M}\\p{N}])[,;]? )?"
         "(?:[\\p{L}\\p{M}]+|\\p{N}++(?:[.,:/]\\p{N}++)*+)")


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))


def _core(token: Column) -> Column:
    return F.ltrim(token, F.lit(" ,;"))


def _is_number(token: Column) -> Column:
    core = _core(token)
    return core.rlike("^\\p{N}") | F.lower(core).isin(NUMBER_WORDS.split())


def _template(tokens: Column, start: Column, length: Column) -> Column:
    """Template of ``length`` tokens from ``start`` (counted from 0); units and names see the token before."""
    def one(i):
        token = F.element_at(tokens, i)
        core = _core(token)
        name = core.rlike("^\\p{Lu}\\p{Ll}+$") & ((core != token) | core.isin(GIVEN_NAMES.split()))
        unit = (i > 1) & F.lower(core).isin(UNITS.split()) \
            & _is_number(F.element_at(tokens, F.greatest(i - 1, F.lit(1))))
        return F.when(_is_number(token), NUMBER).when(unit, UNIT).when(name, NAME) \
                .otherwise(F.lower(core))

    return F.transform(F.sequence(start + 1, start + length), one)


def _plain(token: Column) -> Column:
    return ~token.between(NUMBER, NAME)


def _word_key(words: Column) -> Column:
    return F.xxhash64(F.lit("words"), F.transform(words, F.lower))


def _template_key(template: Column) -> Column:
    return F.xxhash64(F.lit("template"), template)


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(anchor, offset, length, literal, whole, item_id, item_key, item_at, item_template, item_words, keys) per window.

    ``anchor`` hashes the window's longest plain word (longest token if it has fewer than LITERALS
    plain words, then ``literal`` is true), ``offset`` is its place in the window.  ``whole``: the window
    is its whole item, which has FEWEST plain words.  ``keys``: the hashes it can be met by.
    """
    items = benchmark.select("item_id", text_key(F.col("text")).alias("item_key"),
                             _tokens(F.col("text")).alias("w")).distinct() \
                     .filter(F.size("w") > 0)
    length = F.least(F.lit(window), F.size("w"))
    spread = items.select("item_id", "item_key", "w", length.alias("length"), F.explode(
        F.sequence(F.lit(0), F.size("w") - length)).alias("item_at"))
    full = spread.select(
        "item_id", "item_key", "item_at", "length", (F.size("w") == F.col("length")).alias("all"),
        _template(F.col("w"), F.col("item_at"), F.col("length")).alias("item_template"),
        F.transform(F.slice("w", F.col("item_at") + 1, F.col("length")), _core).alias("item_words"))
    plain = F.size(F.filter("item_template", _plain))
    literal = full.withColumn("literal", plain < LITERALS).withColumn("whole", F.col("all") & (plain >= FEWEST))
    # a literal window of a whole item keeps a plain word as its anchor, as its numbers may change
    literal = literal.withColumn("words", F.when(F.col("literal") & ~F.col("whole"), F.transform("item_words", F.lower))
                                 .otherwise(F.col("item_template")))
    longest = F.element_at(F.array_sort(F.transform(
        F.filter("words", _plain), lambda t: F.struct((-F.char_length(t)).alias("n"), t.alias("t")))), 1)["t"]
    by_words = F.array(_word_key(F.col("item_words")))
    return literal.withColumn("word", longest).select(
        F.xxhash64("word").alias("anchor"),
        (F.array_position("words", F.col("word")).cast("int") - 1).alias("offset"), "length", "literal", "whole",
        "item_id", "item_key", "item_at", "item_template", "item_words",
        F.when(F.col("literal") & ~F.col("whole"), by_words).otherwise(
            F.concat(by_words, F.array(_template_key(F.col("item_template"))))).alias("keys"))


def _around_anchors(docs: DataFrame, theirs: DataFrame) -> DataFrame:
    """(doc_id, text_key, at, length, lead, near, start, end) per place where a window may stand.

    ``near`` holds its tokens, after the ``lead`` (0 or 1) tokens before it; ``start`` and ``end`` tell whether
    it begins and ends a sentence.
    """
    shapes = written(theirs.select("anchor", "offset", "length").distinct(), "benchmark-shapes")
    texts = docs.select("doc_id", text_key(F.col("text")).alias("text_key"),
                        _tokens(F.col("text")).alias("w"))
    tokens = texts.select("doc_id", "text_key", "w", F.posexplode("w").alias("place", "token")) \
        .withColumn("anchor", F.xxhash64(F.lower(_core(F.col("token")))))
    if shapes.count() <= MOST_SHAPES:
        met = tokens.join(F.broadcast(shapes), "anchor")
    else:                                      # narrow token rows are shuffled, then the texts met
        met = tokens.select("doc_id", "text_key", "place", "anchor").join(shapes, "anchor") \
            .withColumnRenamed("doc_id", "met_id").withColumnRenamed("text_key", "met_key")
        one = texts.dropDuplicates(["doc_id", "text_key"])
        met = met.join(one, one.doc_id.eqNullSafe(F.col("met_id")) & (one.text_key == F.col("met_key")))
    at = F.col("place") - F.col("offset")
    inside = met.filter((at >= 0) & (at + F.col("length") <= F.size("w")))
    untied = lambda i: F.element_at("w", i) == _core(F.element_at("w", i))
    after = at + F.col("length") + 1
    # Only the window and the token before it go on.  The id is a barrier: below it all is one
    # generated loop over the tokens, and what is canonicalised above it are met rows alone.
    return inside.select(
        "doc_id", "text_key", at.alias("at"), "length", F.least(at, F.lit(1)).alias("lead"),
        F.slice("w", F.greatest(at, F.lit(1)), F.col("length") + F.least(at, F.lit(1))).alias("near"),
        untied(at + 1).alias("start"),
        F.when(after > F.size("w"), True).otherwise(untied(F.least(after, F.size("w")))).alias("end"),
        F.monotonically_increasing_id().alias("barrier")).filter(F.col("barrier") >= 0).drop("barrier")


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_key, item_id, item_key, at, item_at, length, verbatim, sentence, slots) per matched window.

    ``at`` and ``item_at`` count tokens; ``verbatim`` tells whether all words are equal but for
    case, ``sentence`` whether the document has it as a sentence of its own; ``slots`` pairs the
    values at the placeholders.
    """
    theirs = written(benchmark_windows(benchmark, window), "benchmark-windows")
    here = F.transform(F.slice("near", F.col("lead") + 1, F.col("length")), _core)
    keyed = _around_anchors(docs, theirs).select(
        "*", here.alias("words"), _template(F.col("near"), F.col("lead"), F.col("length")).alias("template"))
    keyed = keyed.select("*", F.explode(F.array(_word_key(F.col("words")), _template_key(F.col("template")))).alias("key"))
    listed = theirs.select("*", F.explode("keys").alias("key")).drop("keys", "anchor", "offset")
    # first by the bare hashes, so that only what meets a window meets the whole windows
    known = listed.select("key").distinct()
    met = keyed.join(known, "key", "left_semi").join(listed.withColumnRenamed("length", "item_length"), "key")
    verbatim = F.transform("words", F.lower) == F.transform("item_words", F.lower)
    reworded = (F.col("template") == F.col("item_template")) & (
        ~F.col("literal") | F.col("whole") & F.col("sentence"))
    pairs = F.arrays_zip(F.col("item_template").alias("kind"), F.col("words").alias("value"),
                         F.col("item_words").alias("item_value"))
    return met.withColumn("sentence", F.col("start") & F.col("end")).filter(
        (F.col("length") == F.col("item_length")) & (verbatim | reworded)).select(
        "doc_id", "text_key", "item_id", "item_key", "at", "item_at", "length",
        verbatim.alias("verbatim"), "sentence", F.filter(pairs, lambda p: ~_plain(p["kind"])).alias("slots"))


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, item_id, text_key, n_windows, first_token, reworded, firm): one row per document and item.

    ``firm``: a matched window has LITERALS tokens, or is a sentence of the document.
    """
    item_value = lambda s: F.struct(s["kind"], F.lower(s["item_value"]))
    both_values = lambda s: F.struct(
        s["kind"], F.lower(s["item_value"]), F.lower(s["value"]))
    distinct = lambda f: F.size(F.array_distinct(F.transform("slots", f)))
    good = matches(docs, benchmark, window).filter(
        F.col("verbatim") | (distinct(item_value) == distinct(both_values)))
    return good.groupBy("doc_id", "item_id", "text_key").agg(
        F.count_distinct("at", "length").alias("n_windows"),
        F.min("at").cast("long").alias("first_token"),
        F.max(~F.col("verbatim")).alias("reworded"),
        F.max((F.col("length") >= LITERALS) | F.col("sentence")).alias("firm")).select(
        "doc_id", "item_id", "n_windows", "first_token", "reworded", "firm", "text_key")


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the contaminated documents (those with a firm match)."""
    found = contaminated(docs, benchmark, window).filter("firm").select(
        F.col("doc_id").alias("bad_id"), F.col("text_key").alias("bad_key")).distinct()
    return docs.join(found, docs.doc_id.eqNullSafe(found.bad_id)
                     & (text_key(docs.text) == found.bad_key), "left_anti")
