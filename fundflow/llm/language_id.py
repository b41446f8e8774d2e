"""Language identification by hierarchical discrimination.

A text is first given to a language family (one linear SVM per family against
the rest, one SVM for two families), then one-versus-one linear SVMs separate
the languages within that family; the pair votes decide, their margins break
ties, then the name.  A text's features are the relative frequencies of its
byte trigrams around letters, lower-cased, hashed into ``DIM`` buckets, over the
whole text.

Training takes ``SAMPLE`` labelled rows a language at most (the smallest hashes
of doc_id), whose features go to the driver: at most SAMPLE x languages rows of
DIM counts.  The fit is deterministic dual coordinate descent.  Prediction
reads the text alone.

A text is *unlearned* (a language or letter junk not in the sample) if both its
score is below nearly all true-class scores of the sample and its share of
trigrams that the sample lacks is beyond nearly all that a sample row has against
the other rows, with an allowance for short texts.  The limits are fitted with the
model; with one language the second test decides alone.

Cases: a null text or one without a letter is ``und`` with score 0; rows with a
null label or doc_id teach nothing (they are still predicted); without any label
all texts are ``und``; with one language that one is predicted; repeated rows and
ties are rows like any other; a label outside the family table is a family of
its own; an empty table gives an empty result.  ``predict`` keeps extra columns and
replaces columns named ``lang_pred`` and ``score``.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIM = 1 << 16
SAMPLE = 500
SCALE = 30.0                                   # brings the norm of a frequency vector near one
STEPS = 40
COST = 1.0
UNKNOWN = "und"
LOW, HIGH = 0.01, 0.999                        # quantiles of the sample's scores and unseen shares
CHUNK = 1 << 20                                # characters of text scored at a time

# ISO 639-1 codes by language family.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fy af lb yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky tk tt",
    "celtic": "ga gd cy br",
    "indo-aryan": "hi bn mr ur pa gu ne si",
    "iranian": "fa ku ps tg",
    "semitic": "ar he am mt",
    "dravidian": "ta te kn ml",
    "austronesian": "id ms tl jv mg",
    "sinitic": "zh yue",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

_CLASS = np.full(256, 32, dtype=np.uint32)     # letters and multi-byte characters; the rest are gaps
_CLASS[97:123] = np.arange(97, 123)
_CLASS[128:] = np.arange(128, 256)


def _grams(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every byte trigram, and whether its middle byte is no gap."""
    b = _CLASS[np.frombuffer(data, dtype=np.uint8)]
    mixed = (b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]) * np.uint32(2654435761)
    return mixed >> np.uint32(16), b[1:-1] != 32


def _prepared(text: Column) -> Column:
    return F.concat(F.lit(" "), F.lower(F.coalesce(text, F.lit(""))), F.lit(" "))


def _features(text: Column) -> Column:
    """Struct of the buckets that a text's trigrams fall into and each one's share of them."""
    @F.pandas_udf("struct<bucket:array<int>,share:array<float>>")
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            bucket, real = _grams(t.encode())
            at, n = np.unique(bucket[real], return_counts=True)
            rows.append((at.astype(np.int32), (n / max(1, n.sum())).astype(np.float32)))
        return pd.DataFrame({"bucket": [r[0] for r in rows], "share": [r[1] for r in rows]})

    return run(_prepared(text))


def _fit(rows: list, sign: np.ndarray) -> np.ndarray:
    """Weights (the last one is the bias) of a linear SVM by dual coordinate descent."""
    w, alpha = np.zeros(DIM + 1), np.zeros(len(rows))
    norm = np.array([float(x @ x) for _, x in rows])
    order = np.random.default_rng(7)
    for _ in range(STEPS):
        moved = 0.0
        for i in order.permutation(len(rows)):
            at, x = rows[i]
            slack = sign[i] * float(w[at] @ x) - 1.0
            new = min(max(alpha[i] - slack / norm[i], 0.0), COST)
            if new != alpha[i]:
                w[at] += (new - alpha[i]) * sign[i] * x
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w


def train(labelled: DataFrame, sample: int = SAMPLE) -> dict:
    """Model from columns doc_id, text, lang; rows without one of them teach nothing."""
    known = labelled.filter("lang is not null and doc_id is not null and text is not null") \
                    .select("doc_id", "lang", "text")
    # a hash cut leaves about 4 x sample rows of a language, however many there are; then the least
    hashed = F.shiftrightunsigned(F.xxhash64("doc_id"), 33)
    cuts = known.groupBy("lang").agg((F.lit(4.0 * sample * (1 << 31)) / F.count(F.lit(1))).alias("cut"))
    order = Window.partitionBy("lang").orderBy(hashed, "doc_id")
    chosen = known.select("doc_id", "lang").join(F.broadcast(cuts), "lang").filter(hashed < F.col("cut")) \
                  .withColumn("place", F.row_number().over(order)) \
                  .filter(F.col("place") <= sample).select("doc_id").distinct()
    picked = known.join(F.broadcast(chosen), "doc_id") \
                  .withColumn("x", _features(F.col("text"))) \
                  .withColumn("place", F.row_number().over(order)) \
                  .filter(F.col("place") <= sample).select("doc_id", "lang", "x") \
                  .orderBy("lang", "doc_id").collect()
    langs, rows = [], []
    for r in picked:
        if r.x.bucket:
            langs.append(r.lang)
            rows.append((np.append(np.array(r.x.bucket, dtype=np.int64), DIM),
                         np.append(np.array(r.x.share) * SCALE, 1.0)))
    langs = np.array(langs, dtype=object)
    family = np.array([FAMILY_OF.get(x, x) for x in langs], dtype=object)
    names = sorted(set(family))
    weights, members, pairs = [], [], []
    for name in names[:1] if len(names) == 2 else names if len(names) > 2 else []:
        weights.append(_fit(rows, np.where(family == name, 1.0, -1.0)))
    for name in names:
        members.append(sorted(set(langs[family == name])))
        for a, b in combinations(members[-1], 2):
            near = np.nonzero((langs == a) | (langs == b))[0]
            pairs.append((len(members) - 1, a, b, len(weights)))
            weights.append(_fit([rows[i] for i in near], np.where(langs[near] == a, 1.0, -1.0)))
    table = np.array(weights, dtype=np.float64).reshape(len(weights), DIM + 1)
    model = {"families": names, "members": members, "pairs": pairs,
             "weights": (table[:, :DIM] * SCALE).astype(np.float32), "bias": table[:, DIM]}
    return model | _limits(model, rows, langs, table)


def _limits(model: dict, rows: list, langs: np.ndarray, table: np.ndarray) -> dict:
    """Which buckets the sample has, and the limits of a learned text's score and unseen share."""
    holders = np.zeros(DIM, dtype=np.int64)
    for at, _ in rows:
        holders[at[:-1]] += 1
    limits = {"unseen": (holders == 0).astype(np.float32), "least_score": 0.0, "most_unseen": 1.0}
    if rows:
        margins = np.array([[w[at] @ x for w in table] for at, x in rows]).reshape(len(rows), len(table))
        limits["least_score"] = float(np.quantile(_true_scores(model, margins, langs), LOW))
        limits["most_unseen"] = float(np.quantile(
            [x[:-1][holders[at[:-1]] < 2].sum() / SCALE for at, x in rows], HIGH))
    return limits


def _margins(model: dict, texts: list[str], sizes: np.ndarray | None = None) -> np.ndarray:
    """(text, classifier) margins, a few MB of text at a time; ``sizes`` takes the trigram counts."""
    out = np.zeros((len(texts), len(model["weights"])))
    start = 0
    while start < len(texts):
        stop, size = start, 0
        while stop < len(texts) and (stop == start or size + len(texts[stop]) <= CHUNK):
            size += len(texts[stop])
            stop += 1
        part = [t.encode() for t in texts[start:stop]]
        ends = np.cumsum([len(t) for t in part])
        begins = np.concatenate([[0], ends[:-1]])
        bucket, real = _grams(b"".join(part))
        total = lambda x: (lambda s: s[ends - 2] - s[begins])(
            np.concatenate([[0.0], np.cumsum(x, dtype=np.float64)]))
        n = np.maximum(total(real), 1)
        if sizes is not None:
            sizes[start:stop] = n
        for c, w in enumerate(model["weights"]):
            out[start:stop, c] = total(w[bucket] * real) / n + model["bias"][c]
        start = stop
    return out


def classify(model: dict, texts: list[str]) -> tuple[list[str], np.ndarray]:
    """Predicted language and score (0 to 1) of lower-cased texts with a space at either end."""
    return _decided(model, _margins(model, texts))


def judge(model: dict, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """``classify`` and whether each text is in a language of the sample."""
    if not model["families"]:
        return *classify(model, texts), np.zeros(len(texts), dtype=bool)
    sizes = np.zeros(len(texts))
    margins = _margins({"weights": [*model["weights"], model["unseen"]],
                        "bias": [*model["bias"], 0.0]}, texts, sizes)
    lang, score = _decided(model, margins[:, :-1])
    limit = model["most_unseen"]
    strange = margins[:, -1] > limit + 3 * np.sqrt(limit / np.maximum(sizes, 1)) + 3 / np.maximum(sizes, 1)
    unsure = score < model["least_score"] if len(model["weights"]) else np.ones(len(texts), dtype=bool)
    return lang, score, ~(strange & unsure)


def _sure(margin):
    return 1 / (1 + np.exp(-2 * np.clip(margin, -20, 20)))


def _by_family(model: dict, margins: np.ndarray) -> np.ndarray:
    names = model["families"]
    return (np.ones((len(margins), 1)) if len(names) == 1
            else np.stack([margins[:, 0], -margins[:, 0]], 1) if len(names) == 2
            else margins[:, :len(names)])


def _true_scores(model: dict, margins: np.ndarray, langs: np.ndarray) -> np.ndarray:
    """Score of each row's own label."""
    names, by_family = model["families"], _by_family(model, margins)
    family = np.array([names.index(FAMILY_OF.get(x, x)) for x in langs])
    score = np.ones(len(langs)) if len(names) == 1 else _sure(by_family[np.arange(len(langs)), family])
    for _, a, b, c in model["pairs"]:
        for side, name in ((1, a), (-1, b)):
            own = langs == name
            score[own] = np.minimum(score[own], _sure(side * margins[own, c]))
    return score


def _decided(model: dict, margins: np.ndarray) -> tuple[list[str], np.ndarray]:
    names, n, sure = model["families"], len(margins), _sure
    if not names:
        return [UNKNOWN] * n, np.zeros(n)
    by_family = _by_family(model, margins)
    family = by_family.argmax(1)
    score = np.ones(n) if len(names) == 1 else sure(by_family[np.arange(n), family])
    lang = np.empty(n, dtype=object)
    for f, members in enumerate(model["members"]):
        own = np.nonzero(family == f)[0]
        votes = np.zeros((len(own), len(members)))
        for _, a, b, c in (p for p in model["pairs"] if p[0] == f):
            m = margins[own, c]
            soft = np.clip(m, -20, 20) / (100 * len(members) ** 2)
            votes[:, members.index(a)] += (m >= 0) + soft
            votes[:, members.index(b)] += (m < 0) - soft
        best = votes.argmax(1)
        lang[own] = np.array(members, dtype=object)[best]
        for _, a, b, c in (p for p in model["pairs"] if p[0] == f):
            for side, name in ((1, a), (-1, b)):
                won = own[best == members.index(name)]
                score[won] = np.minimum(score[won], sure(side * margins[won, c]))
    return list(lang), score


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` plus lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)   # classifiers x DIM floats

    @F.pandas_udf("struct<lang_pred:string,score:double>")
    def run(texts: pd.Series) -> pd.DataFrame:
        lang, score = classify(shared.value, texts.tolist())
        return pd.DataFrame({"lang_pred": lang, "score": score})

    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    found = docs.select(*kept, run(_prepared(F.col("text"))).alias("_found"))
    real = F.coalesce(F.col("text"), F.lit("")).rlike("\\p{L}")
    return found.select(
        *kept, F.when(real, F.col("_found.lang_pred")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(real, F.col("_found.score")).otherwise(0.0).alias("score"))


def learned(docs: DataFrame, model: dict) -> DataFrame:
    """``predict`` of the texts that are in a language of the sample."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("struct<lang_pred:string,score:double,learned:boolean>")
    def run(texts: pd.Series) -> pd.DataFrame:
        lang, score, known = judge(shared.value, texts.tolist())
        return pd.DataFrame({"lang_pred": lang, "score": score, "learned": known})

    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    judged = run.asNondeterministic()          # else the filter below judges every text a second time, in workers of its own
    found = docs.filter(F.col("text").rlike("\\p{L}")).select(*kept, judged(_prepared(F.col("text"))).alias("_found"))
    return found.filter("_found.learned").select(*kept, "_found.lang_pred", "_found.score")


def held_out(doc_id: Column) -> Column:
    """True for the third of the doc_ids that training must not see."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))
