import random
import re

import pytest

from conftest import SF_ORACLE
from fundflow.llm import decontaminate as S
from fundflow.llm.common import table

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"
Q = ("Alice has 3 apples and 5 pears that weigh 12 kg in total, so how many apples does Alice give to Bob "
     "each day if he eats 5 pears")


def _found(spark, docs, items):
    rows = S.contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()
    return {(r.doc_id, r.item_id): r for r in rows}


def test_whole_table_finds_exact_passages_and_nothing_else(spark):
    docs, items = table(spark, SF_ORACLE, "documents"), table(spark, SF_ORACLE, "benchmark")
    split = lambda t: tuple(re.findall(r"\w+", (t or "").lower()))
    windows = {}
    for r in items.collect():
        w = split(r.text)
        for i in range(len(w) - S.WINDOW + 1):
            windows.setdefault(w[i:i + S.WINDOW], set()).add(r.item_id)
    want = set()
    for r in docs.collect():
        w = split(r.text)
        for i in range(len(w) - S.WINDOW + 1):
            want |= {(r.doc_id, x) for x in windows.get(w[i:i + S.WINDOW], ())}
    got = S.contaminated(docs, items).collect()
    assert want and {(r.doc_id, r.item_id) for r in got} == want
    kept = S.clean(docs, items)
    assert kept.columns == docs.columns
    assert kept.count() == docs.count() - len({d for d, _ in want})


def test_new_numbers_names_and_units(spark):
    other = Q.replace("Alice", "Maria").replace("12 kg", "31 lbs").replace("3", "7").replace("5", "9")
    docs = [(1, "Well. " + other + " thanks"), (2, Q.replace("5 pears that", "9 pears that")), (3, Q),
            (4, "nothing of the kind " * 20), (5, Q.upper())]
    got = _found(spark, docs, [(7, Q)])
    # document 2 has two values for the item's 5; the windows that hold only one of them still match
    assert set(got) == {(1, 7), (2, 7), (3, 7), (5, 7)} and got[1, 7].reworded and not got[3, 7].reworded


@pytest.mark.parametrize("small", [True, False])
def test_both_joins(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(S, "MOST_SHAPES", -1)
    assert set(_found(spark, [(1, "x " + Q), (2, "y")], [(7, Q), (8, Q)])) == {(1, 7), (1, 8)}


def test_edge_cases(spark):
    short = "one small item with six plain words here"
    long = "filler words go on and on " * 20_000 + Q
    docs = [(1, None), (2, ""), (3, "so " + short + " end"), (4, long), (4, "clean row of the same id"), (None, Q),
            (5, "1 2 3 4 5 6 7 8 9 10 11 12 13 14"), (4, long)]
    items = [(1, None), (2, ""), (3, short), (None, Q), (4, "too short"), (5, "1 2 3 4 5 6 7 8 9 10 11 12")]
    got = _found(spark, docs, items)
    assert set(got) == {(3, 3), (4, None), (None, None), (5, 5)}      # a list of numbers matches verbatim
    df, bench = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    kept = [tuple(r) for r in S.clean(df, bench).collect()]
    assert sorted(kept, key=str) == sorted([docs[0], docs[1], docs[4]], key=str)
    none, nothing = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    assert S.contaminated(none, bench).count() == 0 and S.contaminated(df, nothing).count() == 0
    assert S.clean(df, nothing).count() == len(docs)


def test_extra_columns_with_clashing_names(spark):
    df = spark.createDataFrame([(1, "x " + Q, 2, 3, "h")], DOCS + ", bad_id int, at int, hash string")
    bench = spark.createDataFrame([(1, Q, 5)], ITEMS + ", n int")
    assert S.contaminated(df, bench).count() == 1 and S.clean(df, bench).count() == 0


def test_verbatim_windows_of_an_inconsistent_alignment_and_equal_new_values(spark):
    item = "a box holds 3 red balls and 5 blue balls so how many balls are in it"
    docs = [(1, Q.replace("5 pears that", "9 pears that")), (2, item.replace("3", "4").replace("5", "4")),
            (3, "Tom buys 4 kites and 4 ropes for 4 boys today"), (4, "Tom buys 4 kites and 6 ropes for 9 boys today")]
    items = [(7, Q), (8, item), (9, "Tom buys 2 kites and 3 ropes for 2 boys today")]
    got = _found(spark, docs, items)
    # document 4 has two values for item 9's 2
    assert set(got) == {(1, 7), (2, 8), (3, 9)}
    assert got[2, 8].reworded and got[3, 9].reworded and got[1, 7].n_windows == 20


def test_verbatim_copies_with_few_plain_words(spark):
    items = [(1, "1 2 3 4 5 6 7 8 9 10 11 12"), (2, "what is 7 times 8"), (3, "Anna, Bob and Carl met Dan, Emma and Frank"),
             (4, "too short"), (5, "12 kg 5 cm 3 lbs 40 km 7 oz 9 g"), (6, "?!")]
    docs = [(i, "so it says " + t.upper() + " and goes on") for i, t in items]
    other = [(11, "2 3 4 5 6 7 8 9 10 11 13 14"), (12, "what is 7 times 9"), (13, "Anna, Bob and Carl met Dan, Emma and Max"),
             (14, "too long or short"), (15, "11 kg 5 cm 3 lbs 40 km 7 oz 8 g")]
    got = _found(spark, docs + other, items)
    # 12 and 13 are short items with other values, each a sentence of its own
    assert set(got) == {(i, i) for i in range(1, 6)} | {(11, 1), (12, 2), (13, 3)}
    assert {k for k, r in got.items() if r.reworded} == {(12, 2), (13, 3)}
    assert not got[4, 4].firm
    df, bench = spark.createDataFrame(docs + other + [(20, None), (21, "")], DOCS), spark.createDataFrame(items, ITEMS)
    assert {r.doc_id for r in S.clean(df, bench).collect()} == {4, 6, 14, 15, 20, 21}
    none, nothing = df.filter("false"), bench.filter("false")
    assert S.contaminated(none, bench).count() == 0 and S.contaminated(df, nothing).count() == 0


def test_long_number_lists(spark):
    numbers = ",".join(["1"] * 100_000)
    docs = [(1, numbers), (2, numbers + " " + Q), (3, "1" + "/2" * 100_000 + " " + Q)]
    assert set(_found(spark, docs, [(7, Q)])) == {(2, 7), (3, 7)}


def test_short_items_need_a_sentence_to_be_reworded_or_to_remove_a_document(spark):
    items = [(1, "what is 7 times 8"), (2, "true"), (3, "name the capital")]
    docs = [(1, "Well. What is 3 times 4? Think."), (2, "so what is 3 times 4 then"), (3, "What is 3 times 4, he said"),
            (4, "a true story"), (5, "Is it so? True."), (6, "Name the capital"), (7, "I name the capital here"),
            (8, "What is 7 times 8, he said"), (9, "what is 7 times seven")]
    got = _found(spark, docs, items)
    assert set(got) == {(1, 1), (4, 2), (5, 2), (6, 3), (7, 3), (8, 1), (9, 1)}
    kept = S.clean(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))
    assert {r.doc_id for r in kept.collect()} == {2, 3, 4, 7}


NAMES, FRUITS = ["Anna", "Bob", "Maria", "Tom", "Emma", "Frank", "Lucy", "Max"], ["apples", "pears", "plums", "kites"]
QUESTIONS = ["{a} has {x} {f} and buys {y} more in the shop, how many {f} does {a} have now",
             "A train drives {x} km in {y} hours, how far does it get in {z} hours",
             "{a} and {b} share {x} {f}, so that {a} gets {y} of them", "how much is {x} plus {y}",
             "If {a} pays {x} dollars for {y} {f}, what does {b} pay for {z} {f}"]


def _questions(rng, template):
    a, b = rng.sample(NAMES, 2)
    x, y, z = rng.sample(range(2, 900), 3)
    return template.format(a=a, b=b, f="{f}", x=x, y=y, z=z)


def test_recall_of_reworded_questions(spark):
    rng = random.Random(11)
    templates = [t.replace("{f}", f) for t in QUESTIONS for f in FRUITS]
    items = [(i, _questions(rng, t)) for i, t in enumerate(dict.fromkeys(templates))]
    clean = [(1000 + i, " ".join(rng.choices("the train shop drives apples how many hours is plus now pay for 3 9".split(), k=60)))
             for i in range(40)]
    planted, want = [], set()
    for i, t in enumerate(dict.fromkeys(templates)):
        for k in range(5):
            doc = 10 * i + k
            planted.append((doc, f"Some words before it. {_questions(rng, t)}. And more after."))
            want.add((doc, i))
    got = set(_found(spark, planted + clean, items))
    assert len(got & want) >= 0.9 * len(want), sorted(want - got)[:5]
    assert not {d for d, _ in got} & {d for d, _ in clean}


def test_many_windows_share_an_anchor(spark):
    """The tokens meet a word's distinct places, not its windows."""
    word = lambda i: "v" + "".join("abcdefghij"[int(c)] for c in str(i))
    items = [(i, f"calculate the value {word(i)} from a list of small things given here") for i in range(300)]
    docs = [(d, "calculate " * 200 + items[d][1]) for d in range(20)]
    assert set(_found(spark, docs, items)) == {(d, d) for d in range(20)}
    theirs = S.benchmark_windows(spark.createDataFrame(items, ITEMS))
    near = S._around_anchors(spark.createDataFrame(docs, DOCS), theirs)
    assert near.count() < 20 * 230 * 5 < theirs.count() * 20 * 200


def test_reworded_questions_in_other_letter_case(spark):
    other = Q.replace("Alice", "Maria").replace("12 kg", "31 lbs").replace("3", "7").replace("5", "9")
    got = _found(spark, [(1, Q.upper()), (2, Q.lower()), (3, other.replace("so how many", "SO HOW MANY"))], [(7, Q)])
    assert set(got) == {(1, 7), (2, 7), (3, 7)}
