"""First matching keyword of a taxonomy, by (priority, keyword).

A row matches keyword ``k`` when any of its texts, lower-cased, contains
``lower(k)`` (substring semantics, so hits inside words count).  Among the
matches the smallest ``(priority, keyword)`` wins, a NULL priority after all others.
An empty keyword is contained in every non-NULL text; a NULL keyword in none.

Two plans give the same answer:

* **inline** (taxonomy of at most ``MAX_INLINE_KEYWORDS`` rows): the keywords
  become one look-ahead trie-shaped regular expression scanned over each
  text in the row's own task.  No shuffle, no join, and a hot employer costs nothing extra.
* **gram join** (larger taxonomies): every keyword is filed under one of its grams of
  ``GRAM`` letters, the one that fewest keywords hold (a shorter keyword under itself).
  Every distinct text is cut into its grams, about as many rows as it has letters whatever
  lengths the keywords have; they are equi-joined to the filed grams, and a keyword met is
  compared whole at its place.  The best match per text is an aggregate and is joined back.
  Exact, and it never pairs every text with every keyword.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_INLINE_KEYWORDS = 512
GRAM = 3

MATCH_FIELDS = ["keyword", "industry", "industry_group", "priority"]


def collect_taxonomy(taxonomy: DataFrame, max_rows: int = MAX_INLINE_KEYWORDS):
    """The taxonomy rows sorted by (priority, keyword), or None if too many."""
    rows = (taxonomy.select(*MATCH_FIELDS)
            .filter(F.col("keyword").isNotNull())
            .limit(max_rows + 1).collect())
    if len(rows) > max_rows:
        return None
    return sort_keywords(rows)


def sort_keywords(rows) -> list[tuple]:
    """Keyword rows in match order: priority (NULL last), then keyword."""
    rows = [tuple(r) for r in rows if r[0] is not None]
    return sorted(rows, key=lambda r: (r[3] is None, r[3] if r[3] is not None else 0, r[0]))


def _sql_str(v: str | None) -> str:
    if v is None:
        return "CAST(NULL AS STRING)"
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _sql_int(v) -> str:
    return "NULL" if v is None else str(int(v))


def _match_struct_type() -> str:
    return "struct<keyword:string,industry:string,industry_group:string,priority:int>"


def _trie_pattern(words: list[str]) -> str:
    """Regex matching, at one position, the longest of ``words`` that starts there.

    Branches of a trie node start with different characters, so at most one
    can continue; optional tails are greedy, so the longest keyword on the
    path wins and backtracking falls back to shorter ones.
    """
    trie: dict = {}
    for w in words:
        node = trie
        for ch in w:
            node = node.setdefault(ch, {})
        node[""] = True                      # a keyword ends here

    def body(node: dict) -> str:
        alts = []
        for ch in sorted(k for k in node if k != ""):
            child = node[ch]
            tail = body(child)
            lit = re.escape(ch)
            if child.get("") and tail:
                alts.append(f"{lit}(?:{tail})?")
            elif child.get(""):
                alts.append(lit)
            else:
                alts.append(lit + tail)
        if not alts:
            return ""
        return alts[0] if len(alts) == 1 else "(?:" + "|".join(alts) + ")"

    return body(trie)


def first_match_index(texts: list[Column], keywords: list[tuple],
                      whole_words: bool = False) -> Column:
    """Position (in ``keywords`` order) of the first keyword any text contains, or NULL.

    Every keyword that matches at one position of a text lies on one trie
    path, so each is a prefix of the longest one there.  A look-ahead trie
    regex ``(?=(...))`` reports that longest keyword at every position; the
    best rank among the keywords that are prefixes of a reported one
    (precomputed per keyword) is then the best keyword the text contains.
    Smaller is better, so ``min`` of this index over rows picks the best match.

    ``whole_words``: a keyword only counts where it is not glued to a letter
    or digit on either side ("gas" then misses "Vegas").  There a shorter
    keyword may end at a word break where the longest does not, so that mode
    uses a flat alternation in rank order instead: at each position it
    reports the best-ranked keyword that fits.
    """
    if not keywords:
        return F.lit(None).cast("int")
    rank: dict[str, int] = {}
    for i, (kw, _, _, _) in enumerate(keywords):
        rank.setdefault(kw.lower(), i)
    empty_rank = rank.pop("", None)            # '' is contained in every text
    if not rank:
        best = {}
        pattern = None
    elif whole_words:
        alternatives = "|".join(map(re.escape, rank))
        pattern = "(?=(?<![\\p{L}\\p{N}])(" + alternatives + ")(?![\\p{L}\\p{N}]))"
        best = dict(rank)
    else:
        pattern = "(?=(" + _trie_pattern(list(rank)) + "))"
        best = {k: min(r for j, r in rank.items() if k.startswith(j)) for k in rank}
    ranks = (F.expr("map(" + ", ".join(f"{_sql_str(k)}, {i}" for k, i in best.items()) + ")")
             if best else None)

    def best_in(text: Column) -> Column:
        if pattern is None:
            found_rank = F.lit(None).cast("int")
        else:
            found = F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(1))
            found_rank = F.array_min(F.transform(found, lambda k: ranks[k]))
        if empty_rank is not None:
            found_rank = F.when(text.isNotNull(), F.least(found_rank, F.lit(empty_rank)))
        return found_rank

    indexes = [best_in(t) for t in texts]
    # least() skips NULLs: the best over all texts
    return indexes[0] if len(indexes) == 1 else F.least(*indexes)


def match_at(index: Column, keywords: list[tuple]) -> Column:
    """The (keyword, industry, industry_group, priority) struct at ``index``."""
    if not keywords:
        return F.lit(None).cast(_match_struct_type())
    table = F.expr("array(" + ", ".join(
        f"named_struct('keyword', {_sql_str(kw)}, 'industry', {_sql_str(ind)}, "
        f"'industry_group', {_sql_str(grp)}, 'priority', CAST({_sql_int(pri)} AS INT))"
        for kw, ind, grp, pri in keywords) + ")")
    return F.when(index.isNotNull(), F.get(table, index))


def first_match_inline(texts: list[Column], keywords: list[tuple],
                       whole_words: bool = False) -> Column:
    """Struct (keyword, industry, industry_group, priority) of the first hit, or NULL."""
    return match_at(first_match_index(texts, keywords, whole_words), keywords)


def filed_keywords(keywords: DataFrame) -> DataFrame:
    """(_gram, _offset, _kw): the gram that each lower-cased keyword ``_kw`` is filed under, and its place there.

    It is the gram that fewest keywords hold, the first such gram and place at ties.
    """
    words = keywords.select("_kw").filter("_kw != ''")
    size = F.least(F.lit(GRAM), F.length("_kw"))
    grams = words.select("_kw", size.alias("_n"), F.explode(
        F.sequence(F.lit(0), F.length("_kw") - size)).alias("_offset"))
    grams = grams.withColumn("_gram", F.substring("_kw", F.col("_offset") + 1, F.col("_n")))
    held = grams.groupBy("_gram").agg(F.count_distinct("_kw").alias("_held"))
    return grams.join(held, "_gram").groupBy("_kw").agg(
        F.min(F.struct("_held", "_gram", "_offset")).alias("_f")).select("_f._gram", "_f._offset", "_kw")


def text_grams(texts: DataFrame, sizes: list[int]) -> DataFrame:
    """(_text, _at, _gram): the grams of each ``_text`` at its letters, counted from 1, for each of ``sizes``."""
    at = F.explode(F.sequence(F.lit(1), F.length("_text"))).alias("_at")
    places = texts.filter("_text != ''").select("_text", at)
    grams = F.explode(F.array(*[F.struct(F.substring("_text", F.col("_at"), F.lit(n)).alias("gram"),
                                         F.lit(n).alias("size")) for n in sizes])).alias("_g")
    return places.select("_text", "_at", grams).filter(F.length("_g.gram") == F.col("_g.size")) \
                 .select("_text", "_at", F.col("_g.gram").alias("_gram"))


def first_match_join(df: DataFrame, text_cols: list[str], taxonomy: DataFrame,
                     out_col: str = "match", whole_words: bool = False) -> DataFrame:
    """Add ``out_col`` to ``df`` with the gram equi-join plan (any taxonomy size)."""
    def rank(m):                                # NULL priority last, as in the inline plan
        return F.struct(m["priority"].isNull().alias("none"), m["priority"].alias("priority"),
                        m["keyword"].alias("keyword"))

    tax = taxonomy.filter(F.col("keyword").isNotNull()) \
                  .select(F.lower("keyword").alias("_kw"), F.struct(*MATCH_FIELDS).alias("_k"))
    best_kw = tax.groupBy("_kw").agg(F.min_by("_k", rank(F.col("_k"))).alias("_k"))
    filed = filed_keywords(best_kw)
    sizes = [r[0] for r in filed.select(F.length("_gram")).distinct().collect()]      # at most GRAM numbers
    texts = reduce(lambda a, b: a.unionByName(b),
                   [df.select(F.lower(F.col(c)).alias("_text")) for c in text_cols]) \
        .filter(F.col("_text").isNotNull()).distinct()
    start, size = F.col("_at") - F.col("_offset"), F.length("_kw")
    grams = text_grams(texts, sizes or [GRAM]).join(filed, "_gram").filter(
        (start >= 1) & (F.substring("_text", start, size) == F.col("_kw")))
    if whole_words:
        before = F.when(start > 1, F.substring("_text", start - 1, F.lit(1)))
        after = F.substring("_text", start + size, F.lit(1))
        glued = "[\\p{L}\\p{N}]"
        grams = grams.filter(~F.coalesce(before, F.lit("")).rlike(glued) & ~after.rlike(glued))
    hits = grams.select("_text", "_kw").distinct().join(best_kw, "_kw").select("_text", "_k")
    # the empty keyword's row, if there is one, is a candidate for every text
    empty = best_kw.filter(F.col("_kw") == "").select(F.lit(1).alias("_one"), F.col("_k"))
    every = texts.select("_text", F.lit(1).alias("_one")).join(F.broadcast(empty), "_one")
    best = hits.unionByName(every.select("_text", "_k")).groupBy("_text").agg(
        F.min_by("_k", rank(F.col("_k"))).alias("_m"))
    out = df
    for i, c in enumerate(text_cols):
        b = best.select(F.col("_text").alias(f"_t{i}"), F.col("_m").alias(f"_m{i}"))
        out = out.join(b, F.lower(out[c]) == b[f"_t{i}"], "left").drop(f"_t{i}")
    # the best of the per-text winners; NULLs lose
    winner = reduce(lambda a, b: F.when(
        b.isNotNull() & (a.isNull() | (rank(b) < rank(a))), b).otherwise(a),
        [F.col(f"_m{i}") for i in range(len(text_cols))])
    return out.withColumn(out_col, winner).drop(*[f"_m{i}" for i in range(len(text_cols))])


def add_first_match(df: DataFrame, text_cols: list, taxonomy: DataFrame,
                    out_col: str = "match", max_inline: int = MAX_INLINE_KEYWORDS,
                    keywords: list[tuple] | None = None,
                    whole_words: bool = False) -> DataFrame:
    """Choose the plan by the taxonomy's size and add the match struct.

    ``keywords`` may carry an already collected (sorted) taxonomy.
    ``whole_words`` ignores hits inside longer words.  Both plans give the same result.
    """
    if keywords is None:
        keywords = collect_taxonomy(taxonomy, max_inline)
    if keywords is not None:
        cols = [F.col(c) if isinstance(c, str) else c for c in text_cols]
        return df.withColumn(out_col, first_match_inline(cols, keywords, whole_words))
    names = []
    tmp = df
    for i, c in enumerate(text_cols):
        if isinstance(c, str):
            names.append(c)
        else:
            tmp = tmp.withColumn(f"_text_in{i}", c)
            names.append(f"_text_in{i}")
    out = first_match_join(tmp, names, taxonomy, out_col, whole_words)
    return out.drop(*[n for n in names if n.startswith("_text_in")])
