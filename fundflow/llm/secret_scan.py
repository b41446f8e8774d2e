"""Secret scans over a trigram inverted index, in DataFrame functions only.

From each rule's regex a Boolean trigram query is derived: every string that
some fixed part of the regex can take (lower-cased) needs its trigrams, a part
needs one of its strings, a match needs all parts.  The postings
(trigram, doc_id) of the trigrams that queries ask for are written to shared
storage, intersected by document, and the candidates verified by the regex.  A rule
without mandatory trigrams (a bare run of hex digits) scans every text.

Spans count code points, the end is exclusive.  Matches are leftmost and
non-overlapping per rule; one whose value is too short is dropped after it was
consumed.

Cases: null text is empty and has no spans; rows sharing a doc_id (or lacking one)
share candidates, which only adds verification; repeated rows each keep a row;
overlapping spans of several rules are all reported, and redacted as one; an empty
table gives an empty result; extra columns are kept, ``spans`` is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

MOST_STRINGS = 64                             # strings a fixed part may take before it is cut short
BLOCK = 256                                   # array elements whose running totals are taken together


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str                              # syntax that Java's and Python's engines share
    group: int = 0                            # group that holds the value
    least: int = 0                            # least characters of the value
    base: bool = False


# The base rules of the contract, then public key formats.
RULES = (
    Rule("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
                   r"([A-Za-z0-9+/_.=-]+)", group=2, least=6, base=True),
    Rule("access", r"AKIA[A-Z0-9]+", least=20, base=True),
    Rule("hex", r"[0-9a-f]{24,}", base=True),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    # possessive, as Java recurses once per repeat of a group otherwise
    Rule("private_key", r"-----BEGIN (?:[A-Z]++ (?!KEY-----))*+PRIVATE KEY-----"),
)


def _trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i:i + 3] for i in range(len(text) - 2))


def _strings(items) -> tuple[set[str] | None, list]:
    """Of a parsed regex part: all strings it can match (None: not a small set), and its clauses."""
    now, clauses = {""}, []

    def cut():
        options = {_trigrams(s) for s in now}
        if frozenset() not in options:
            clauses.append(options)
        return {""}

    whole = True
    for op, arg in items:
        name, more = str(op), None
        if name == "LITERAL":
            more = {chr(arg).lower()}
        elif name == "IN" and all(str(o) == "LITERAL" for o, _ in arg):
            more = {chr(c).lower() for _, c in arg}
        elif name == "SUBPATTERN":
            more, inner = _strings(arg[3])
            if more is None:
                clauses += inner
        elif name == "BRANCH":
            parts = [_strings(x)[0] for x in arg[1]]
            more = None if None in parts else set().union(*parts)
        elif name == "MAX_REPEAT":
            low, high, inner = arg
            some, own = _strings(inner)
            if (low, high) == (0, 1) and some is not None:
                more = some | {""}
            elif low == high == 1:
                more = some
            elif low >= 1:
                if some is not None and len(now) * len(some) <= MOST_STRINGS:
                    now = {a + b for a in now for b in some}
                elif some is None:
                    clauses += own
        if more is None or len(now) * len(more) > MOST_STRINGS:
            now, whole = cut(), False
        else:
            now = {a + b for a in now for b in more}
    if whole:
        return now, []
    cut()
    return None, clauses


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """AND of clauses, each an OR of trigram sets that must all occur; empty: scan fully."""
    strings, clauses = _strings(parser.parse(pattern))
    if strings is not None:
        options = {_trigrams(s) for s in strings}
        clauses = [] if frozenset() in options else [options]
    # (a and b) or a = a: an option that asks for more than another one adds nothing
    return [sorted((o for o in c if not any(p < o for p in c)), key=sorted) for c in clauses]


def postings(docs: DataFrame, rules=RULES) -> DataFrame:
    """(trigram, doc_id): the inverted index over the trigrams that the rules ask for."""
    wanted = sorted({t for r in rules for c in trigram_query(r.pattern) for o in c for t in o})
    low = docs.select("doc_id", F.lower("text").alias("low")).filter("low is not null")
    has = F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in wanted])
    return low.select("doc_id", F.explode(F.array_compact(has)).alias("trigram")) \
              .select("trigram", "doc_id")


def candidates(index: DataFrame, rules=RULES) -> DataFrame:
    """(doc_id, rules bit mask): documents whose postings satisfy a rule's trigram query."""
    terms, full_option, full_rule = [], [], []
    for r, rule in enumerate(rules):
        query = trigram_query(rule.pattern)
        if query:
            full_rule.append((r, (1 << len(query)) - 1))
        for c, options in enumerate(query):
            for o, trigrams in enumerate(options):
                full_option.append((r, c, o, (1 << len(trigrams)) - 1))
                terms += [(t, r, c, o, i) for i, t in enumerate(sorted(trigrams))]
    spark = index.sparkSession
    term = spark.createDataFrame(terms, "trigram string, r int, c int, o int, bit int")
    option = spark.createDataFrame(full_option, "r int, c int, o int, full long")
    whole = spark.createDataFrame(full_rule, "r int, full long")
    bit = lambda c: F.expr(f"bit_or(shiftleft(1L, {c}))")
    hits = index.join(F.broadcast(term), "trigram").repartition("doc_id")   # rules are few
    options = hits.groupBy("doc_id", "r", "c", "o").agg(bit("bit").alias("seen")) \
                  .join(F.broadcast(option), ["r", "c", "o"]).filter("seen = full")
    clauses = options.groupBy("doc_id", "r").agg(bit("c").alias("seen")) \
                     .join(F.broadcast(whole), "r").filter("seen = full")
    return clauses.groupBy("doc_id").agg(bit("r").alias("rules"))


def _let(value: Column, use) -> Column:
    """``use(value)``, with ``value`` worked out once however often a lambda inside asks for it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _blocks(values: Column) -> Column:
    """A non-empty array in arrays of ``BLOCK`` elements."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int")),
                       lambda b: F.slice(values, b * BLOCK + 1, F.lit(BLOCK)))


def _running(values: Column, fold) -> Column:
    """Running totals of a non-empty array of counts under ``fold``, a block at a time.

    An element costs a pass over its block, not a copy of all that came before it.
    """
    def total(part):
        return F.aggregate(part, F.lit(0), fold)

    def within(blocks, totals):
        return F.flatten(F.transform(blocks, lambda part, b: _let(
            total(F.slice(totals, F.lit(1), b)),
            lambda before: F.transform(part, lambda _, k: fold(before, total(F.slice(part, F.lit(1), k + 1)))))))

    return _let(_blocks(values), lambda blocks: _let(
        F.transform(blocks, total), lambda totals: within(blocks, totals)))


def _spans(text: Column, order: int, rule: Rule) -> Column:
    """Array of (start, order, end, kind) of the rule's matches that are long enough."""
    kind = "array<struct<start:int,order:int,end:int,kind:string>>"
    pattern = F.lit(rule.pattern)
    zipped = F.arrays_zip(F.split(text, rule.pattern, -1).alias("gap"),
                          F.regexp_extract_all(text, pattern, F.lit(0)).alias("match"),
                          F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("value"))
    sizes = F.transform(zipped, lambda p: F.struct(
        F.char_length(p["gap"]).alias("gap"), F.coalesce(F.char_length(p["match"]), F.lit(0)).alias("match"),
        F.coalesce(F.char_length(p["value"]) >= rule.least, F.lit(False)).alias("long")))

    def placed(parts):
        ends = _running(F.transform(parts, lambda p: p["gap"] + p["match"]), lambda x, y: x + y)
        every = F.zip_with(parts, ends, lambda p, end: F.struct(
            (end - p["match"]).alias("start"), F.lit(order).alias("order"), end.alias("end"),
            F.lit(rule.kind).alias("kind"), p["long"].alias("long")))
        return F.transform(F.filter(every, lambda s: s["long"]), lambda s: F.struct(
            s["start"].alias("start"), s["order"].alias("order"), s["end"].alias("end"), s["kind"].alias("kind")))

    return F.when(text.rlike(rule.pattern), _let(sizes, placed).cast(kind)).otherwise(F.array().cast(kind))


def scan(docs: DataFrame, rules=RULES) -> DataFrame:
    """``docs`` plus spans: array of (start, order, end, kind) by start, then the rules' order."""
    index = written(postings(docs, rules), "trigram-postings")
    found = candidates(index, rules)
    columns = [c for c in docs.columns if c != "spans"]
    text = F.coalesce(docs.text, F.lit(""))
    joined = docs.join(found, docs.doc_id.eqNullSafe(found.doc_id), "left")
    each = []
    for at, rule in enumerate(rules):
        spans = _spans(text, at, rule)
        if trigram_query(rule.pattern):
            asked = F.coalesce(found.rules, F.lit(0)).bitwiseAND(F.lit(1 << at)) != 0
            spans = F.when(asked, spans)
        each.append(spans)
    all_spans = F.array_sort(F.flatten(F.array_compact(F.array(*each))))
    return joined.select(*[docs[c] for c in columns], all_spans.alias("spans"))


def spans_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def base_spans(spans: Column, rules=RULES) -> Column:
    kinds = [r.kind for r in rules if r.base]
    return F.filter(spans, lambda s: s["kind"].isin(kinds))


def _without(text: Column, spans: Column) -> Column:
    """``text`` with its (one or more) spans replaced; spans that overlap become one, named by the first.

    Pieces are cut from the stretch of text that a block of spans covers, so that a piece
    costs a pass over its stretch, not over the text.
    """
    def pieces(block):
        first = F.get(block, F.lit(0))["at"]
        stretch = F.substring(text, first + 1, F.get(block, F.size(block) - 1)["start"] - first)
        return _let(F.struct(first.alias("first"), stretch.alias("text")), lambda own: F.transform(
            block, lambda s: F.concat(F.substring(own["text"], s["at"] - own["first"] + 1, s["start"] - s["at"]),
                                      F.lit("<secret:"), s["kind"], F.lit(">"))))

    def clean(reach):
        each = F.transform(spans, lambda s, i: F.struct(
            F.when(i > 0, F.get(reach, i - 1)).otherwise(F.lit(0)).alias("at"), s["start"].alias("start"),
            s["kind"].alias("kind")))
        heads = F.filter(each, lambda s: s["start"] >= s["at"])
        cut = _let(heads, lambda h: F.flatten(F.transform(_blocks(h), pieces)))
        return F.concat(F.array_join(cut, ""), F.substring(text, F.get(reach, F.size(reach) - 1) + 1,
                                                           F.char_length(text)))

    return _let(_running(F.transform(spans, lambda s: s["end"]), lambda x, y: F.greatest(x, y)), clean)


def redact(docs: DataFrame, rules=RULES) -> DataFrame:
    """``docs`` with every span of the text replaced by ``<secret:kind>`` (n_chars follows)."""
    clean = _without(F.col("text"), F.col("spans"))
    found = scan(docs, rules)
    out = found.withColumn("text", F.when(F.size("spans") > 0, clean).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(
            F.size("spans") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType))
            .otherwise(F.col("n_chars")))
    return out.select(*[c for c in docs.columns if c != "spans"])
