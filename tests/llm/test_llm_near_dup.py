"""Near duplicates against brute force."""

import random
import re
import string

import pytest

from linkloom.llm import near_dup as N

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return set()
    return {tuple(words[k : k + size]) for k in range(max(len(words) - size, 0) + 1)}


def brute(rows, size, percent):
    sets = {i: shingles(t, size) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = 0
    ids = sorted(sets)
    for i in ids:
        for j in ids:
            both = len(sets[i] & sets[j])
            if j < i and both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                links += 1
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in ids}, links


def answer(spark, rows, size=4, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return {r.doc_id: (r.n_shingles, r.component_id) for r in N.near_duplicates(df, size=size, **options).collect()}


def edited(rng, words, edits, pool=None):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        kind = rng.random()
        new = pool[rng.randrange(len(pool))] if pool else f"n{rng.randrange(10**9)}"
        if kind < 0.6:
            words[at] = new
        elif kind < 0.8:
            words.insert(at, new)
        elif len(words) > 5:
            del words[at]
    return words


@pytest.mark.parametrize("seed", [1, 2])
def test_families_of_edited_copies(spark, seed):
    """Copies about the border, copies of copies, edits drawn from a small pool: many pairs are linked beside the centre."""
    rng = random.Random(seed)
    rows, n = [], 0
    for family in range(4):
        base = [f"f{family}w{rng.randrange(400)}" for _ in range(rng.choice([30, 60, 120]))]
        pool = [f"p{k}" for k in range(6)] if family % 2 else None
        members = [base]
        for _ in range(60):
            source = base if rng.random() < 0.6 else rng.choice(members)
            members.append(edited(rng, source, rng.randrange(0, max(2, len(base) // 18)), pool))
        for words in members:
            rows.append((n, " ".join(words)))
            n += 1
    rng.shuffle(rows)
    expected, links = brute(rows, 4, 80)
    assert links > 200
    assert answer(spark, rows) == expected


def test_copies_of_one_edit_outside_the_centre(spark):
    """Two texts that aren't linked to their family's centre but to each other and to a text between."""
    rng = random.Random(9)
    base = [f"w{k}" for k in range(100)]
    far = edited(rng, base, 4)
    rows = [(k, " ".join(edited(rng, base, 1))) for k in range(40)]
    rows += [(100 + k, " ".join(edited(rng, far, k % 2))) for k in range(12)]
    rows += [(200, " ".join(base))]
    expected, _ = brute(rows, 4, 80)
    assert answer(spark, rows) == expected


def test_odd_rows(spark):
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "One\ttwo"), (8, "two one"),
        (9, "a b c d"), (10, "a b c d e"), (11, "a b c d e f"), (12, "x " * 3000), (13, "x " * 2999), (14, "é ü ß ñ ö"), (15, "É ü ß ñ ö"),
        (16, "a b c d"), (16, "a b c d"), (None, "a b c d"),
    ]
    got = answer(spark, rows)
    expected, _ = brute([r for r in set(rows) if r[0] is not None], 4, 80)
    assert got == expected
    assert got[1] == (0, 1) and got[5] == (1, 4) and got[16] == (1, 9)


def test_empty_table_and_extra_columns(spark):
    assert answer(spark, []) == {}
    df = spark.createDataFrame([(1, "a b c d e", 7, "x"), (2, "a b c d e", 8, "y")], "doc_id long, text string, component_id int, bands string")
    rows = sorted(N.near_duplicates(df).collect())
    assert [(r.doc_id, r.component_id, r.kept) for r in rows] == [(1, 1, True), (2, 1, False)]


def test_hot_group_makes_few_pairs(spark):
    """A large family of copies with edits of their own: candidate edges grow with its size, not with its square."""
    rng = random.Random(3)
    base = [f"w{k}" for k in range(80)]
    rows = [(k, " ".join(edited(rng, base, rng.randrange(1, 9)))) for k in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    classes = N.sketches(df, 4).selectExpr("doc_id as rep", "explode(bands) as bucket")
    edges = N.star_edges(classes)
    star = N.compared(edges, N.pair_texts(edges, df), 4, 80, True)
    assert edges.count() < 20 * 600
    assert N.side_pairs(star, 80).count() < 20 * 600


def test_small_sets_share_buckets():
    """Recall of the bands on the hardest sets: five shingles against four of them."""
    import numpy as np

    rng = np.random.default_rng(1)
    missed = 0
    for _ in range(400):
        large = np.unique(rng.integers(0, 2**63, 5).astype(np.uint64) * np.uint64(2))
        small = np.delete(large, rng.integers(5))
        missed += not np.intersect1d(N.bands_of([large])[0], N.bands_of([small])[0]).size
    assert missed == 0
