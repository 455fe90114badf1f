"""Templates, slots and the joins of benchmark decontamination."""

import random

import numpy as np
import pyarrow as pa

from linkloom.llm import bitmaps
from linkloom.llm import decontaminate as D
from linkloom.llm.textcols import texts_of

ITEMS = [
    (10, "Once Tom has 5 apples and gives 3 kg of them to Anna before he walks home again today"),
    (11, "We see Tom has 5 apples and 5 pears and 5 plums in the big basket of Tom now"),
    (12, None), (13, ""), (14, "A short item of only seven words"),
    (15, "Once Tom has 5 apples and gives 3 kg of them to Anna before he walks home again today"),
]


def found(spark, docs, items=ITEMS):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    return {r.doc_id: r for r in D.decontaminate(d, i).collect()}


def test_template_words():
    t = D.Template(texts_of(pa.array(['He met Anna, who paid 12.50 dollars (5kg). "Bob" SHOUTS! Éa Ünder the -- x2y', None, ""])))
    marks = [D.MARKS[k] or t.word(i) for i, k in enumerate(t.kind)]
    assert marks == ["he", "met", "<name>", "who", "paid", "<num>", "<unit>", "<num>", "bob", "shouts", "éa", "<name>", "the", "--", "x2y"]
    assert t.length.tolist() == [15, 0, 0]


def test_copies_and_new_parameters(spark):
    got = found(
        spark,
        [
            (1, "Intro. " + ITEMS[0][1] + " and more words follow here."),
            (2, "Sorry? said Bob has 7 apples and gives 9 kg of them to Carla before he walks home again today"),
            (3, "We see Zed has 6 apples and 6 pears and 6 plums in the big basket of Zed now"),
            (4, "We see Zed has 6 apples and 7 pears and 8 plums in the big basket of Kim now"),
            (5, ""), (6, None), (7, "Something else that says apples and pears and plums in the basket"),
            (8, "a short ITEM of only, seven words!"),
        ],
    )
    assert {i for i, r in got.items() if r.contaminated} == {1, 2, 3, 8}
    assert got[1].verbatim and not got[2].verbatim and not got[3].verbatim
    assert got[1].item_ids == [10] and got[3].item_ids == [11] and got[4].item_ids is None
    assert got[2].n_covered >= 12


def test_odd_tables(spark):
    assert not any(r.contaminated for r in found(spark, [(1, ITEMS[0][1])], []).values())
    assert found(spark, []) == {}
    rows = spark.createDataFrame([(1, ITEMS[0][1], 5), (1, ITEMS[0][1], 6), (None, ITEMS[0][1], 7)], "doc_id long, text string, item_id int")
    items = spark.createDataFrame([(1, ITEMS[0][1], "z"), (None, "x", "z")], "item_id long, text string, pos string")
    assert sorted((r.doc_id or 0, r.contaminated) for r in D.decontaminate(rows, items).collect()) == [(0, False), (1, True), (1, True)]


def test_against_brute_force(spark):
    """Every passage of 12 or more words of an item is found, nothing else."""
    rng = random.Random(4)
    words = [f"w{k}" for k in range(3000)]
    items = [(k, " ".join(rng.choices(words, k=30))) for k in range(40)]
    docs, leaked = [], set()
    for n in range(300):
        text = rng.choices(words, k=60)
        if n % 3 == 0:
            start, size = rng.randrange(10), rng.choice([5, 7, 12, 20])
            text[10:10] = rng.choice(items)[1].split()[start : start + size]
            leaked |= {n} if size >= 12 else set()
        docs.append((n, " ".join(text)))
    got = found(spark, docs, items)
    assert {i for i, r in got.items() if r.contaminated} == leaked


def test_items_that_share_windows(spark):
    """A copy is held against its own item, whatever others have the same form or the same words in front."""
    family = [(1, ITEMS[1][1]), (2, "We see Tom has 5 apples and 7 pears and 8 plums in the big basket of Tom now")]
    long = "the quick brown fox jumps over lazy dogs while many other small animals watch from behind a tall green hedge near our house"
    short = [(3, long), (4, "the quick brown fox jumps over lazy dogs"), (5, "other small animals watch from behind a tall red fence")]
    docs = [(1, "So. " + family[1][1] + " and on"), (2, "so the quick brown fox jumps over lazy dogs again"), (3, "all other small animals watch from behind a tall red fence again")]
    got = found(spark, docs, family + short)
    assert [got[i].contaminated for i in (1, 2, 3)] == [True] * 3
    assert 2 in got[1].item_ids and got[1].verbatim and 4 in got[2].item_ids and 5 in got[3].item_ids


def test_one_changed_value(spark):
    """A long copy with one of two equal values changed is found; a text that only shares the form is not."""
    words = [f"w{k}" for k in range(100)]
    other = [*words]
    words[20] = words[70] = "5"
    other[20], other[70] = "5", "6"
    new = [*words]
    new[20], new[70] = "7", "8"
    got = found(spark, [(1, " ".join(other)), (2, " ".join(new))], [(1, " ".join(words))])
    assert got[1].contaminated and got[1].verbatim and got[1].n_covered >= 80
    assert got[2].contaminated
    forms = [{"pos": k, "size": 8, "item_slots": ["5", "3"], "slots": [str(k), "3"]} for k in range(8)]
    assert not D.judge(forms, 30, 12)[1]


def test_runs_that_hold():
    """The longest consistent run against all runs tried out."""
    rng = random.Random(1)
    for _ in range(300):
        held = {(at, 4): {(rng.choice("ab"), rng.choice("xxxy"))} for at in sorted(rng.sample(range(40), 20))}
        order, most = sorted(held), 0
        for i in range(len(order)):
            for j in range(i, len(order)):
                if j > i and order[j][0] > order[j - 1][0] + 4:
                    break
                pairs = set().union(*(held[w] for w in order[i : j + 1]))
                if len({a for a, _ in pairs}) == len(pairs):
                    most = max(most, order[j][0] + 4 - order[i][0])
        got = D._stretch(held)
        assert got[-1][0] + 4 - got[0][0] == most


def test_numbers_and_names(spark):
    """Windows of few plain words are found where they stand word for word, and only there; document 5 has the whole short item's form."""
    items = [(1, "What comes next: 1 4 9 16 25 36 49 64 81 100 121 144 ?"), (2, "Did Anna Smith meet Bob Jones in Paris last Monday"), (3, "- - - - - - - - - - - - -")]
    docs = [(1, "Well. " + items[0][1]), (2, "So: did Anna Smith meet Bob Jones in Paris last Monday, then"), (3, "- " * 40),
            (4, "What comes next: 1 5 9 17 25 37 49 65 81 101 121 145 ?"), (5, "did Carl Smith meet Bob Jones in Rome last Monday")]
    got = found(spark, docs, items)
    assert {i for i, r in got.items() if r.contaminated} == {1, 2, 5}
    assert got[1].verbatim and not got[5].verbatim and got[1].item_ids == [1] and got[2].item_ids == [2]


def test_names_that_start_sentences(spark):
    item = "Anna has 12 apples. Anna gives 5 to Bob. How many apples does Anna have left?"
    docs = [(1, item.replace("Anna", "Carla")), (2, "Then " + item.replace("Anna", "Carla").replace("12", "9")), (3, item), (4, "Who? " + item.replace("Anna gives", "Zoe gives").replace("does Anna", "does Mia"))]
    got = found(spark, docs, [(1, item)])
    assert {i for i, r in got.items() if r.contaminated} >= {1, 2, 3}
    assert got[3].verbatim and not got[1].verbatim and got[1].n_covered == 16
    # One sentence start of two is a plain word on the other side.
    got = found(spark, [(1, "and yet the cat sat there. Carla gives 5 plums to each hungry child")], [(1, "The cat sat there. Anna gives 5 plums to each hungry child")])
    assert got[1].contaminated


def test_given_benchmark(spark):
    root = "/root/testdata/sf0.01"
    docs, items = spark.read.parquet(f"{root}/documents.parquet"), spark.read.parquet(f"{root}/benchmark.parquet")
    known = {tuple(w[k : k + 8]) for r in items.collect() for w in [r.text.split()] for k in range(len(w) - 7)}
    texts = {r.doc_id: r.text.split() for r in docs.collect()}
    plain = {i for i, w in texts.items() if any(tuple(w[k : k + 8]) in known for k in range(len(w) - 7))}
    assert plain and plain == {r.doc_id for r in D.decontaminate(docs, items).collect() if r.contaminated}


def test_bitmap(spark):
    keys = np.random.default_rng(0).integers(-(2**63), 2**63 - 1, 5000)
    keys[:3] = (0, -1, bitmaps.BITS - 1)
    bits = bitmaps.key_bitmap(spark.createDataFrame([(int(k),) for k in keys], "key long"), "key")
    assert bitmaps.maybe_in(bits, keys).all()
    assert bitmaps.maybe_in(bits, keys[3:] ^ 1).mean() < 0.01
