"""Near duplicates against all pairs in plain Python, and the shape of their plans."""

import random

from pyspark.sql import functions as F

from linkloom.operators import similar as S


def plain_groups(rows, words=5, percent=80):
    """page_id -> (set, group, similarity to the group's first page)."""
    sets = {}
    for page, text in rows:
        tokens = (text or "").lower().split()
        shingles = {tuple(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))} if tokens else set()
        sets[page] = shingles
    group = {p: p for p in sets}

    def root(p):
        while group[p] != p:
            p = group[p]
        return p

    pages = sorted(sets)
    for i, a in enumerate(pages):
        for b in pages[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                group[high] = low
    out = []
    for p in pages:
        g = root(p)
        alike = len(sets[p] & sets[g]) / len(sets[p] | sets[g]) if sets[p] else 1.0
        out.append((p, len(sets[p]), g, alike, g == p))
    return out


def found(df):
    return sorted((r.page_id, r.n_shingles, r.group_id, r.similarity, r.is_first) for r in df.collect())


def families(rng):
    """Copies of a few originals with edits of all sizes, chains of edits, and unrelated and odd texts."""
    vocabulary = [f"w{i}" for i in range(400)]
    rows, page = [], 0
    for _ in range(6):
        original = rng.choices(vocabulary, k=rng.choice([6, 30, 80, 200]))
        text = list(original)
        for k in range(25):
            if k % 3 == 0:
                text = list(original)  # a star; else a chain of further edits
            for _ in range(rng.randrange(1 + len(text) // 25)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append((page, " ".join(text)))
            page += 1
    for text in ("", None, " \t\n", "one", "One", "a b c d", "a b c d e", "a  b c\nd e", "x " * 50, "x " * 60, "Ä ö ü ß é"):
        rows.append((page, text))
        page += 1
    rng.shuffle(rows)
    return rows


def test_groups_equal_all_pairs(spark):
    for seed, words, percent in ((1, 5, 80), (2, 3, 60)):
        rows = families(random.Random(seed))
        df = spark.createDataFrame([(p, t, "clash", 1) for p, t in rows], "page_id long, text string, bucket string, n_shingles int")
        expected = plain_groups(rows, words, percent)
        assert len({g for _, _, g, _, _ in expected}) < len(rows) - 20
        assert found(S.near_duplicates(df, F.col("text"), percent / 100, words)) == expected


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, text string")
    assert S.near_duplicates(df, F.col("text")).count() == 0


def test_large_family_makes_no_pairs(spark):
    """400 copies of one text, each with an edit of its own: comparisons stay in proportion to the copies."""
    rng = random.Random(9)
    original = [f"w{i}" for i in range(120)]
    rows = []
    for page in range(400):
        text = list(original)
        text[rng.randrange(120)] = f"edit{page}"
        rows.append((page, " ".join(text)))
    df = spark.createDataFrame(rows, "page_id long, text string")
    sets = df.select(F.col("page_id").alias("class"), S.word_shingles(F.col("text")).alias("shingles"))
    members = sets.select("class", F.explode(S.band_keys(F.col("shingles"))).alias("bucket"))
    tested = S._centres(members)
    assert tested.count() < 400 * 10
    star = S._stars(tested, sets, 80)
    assert S._side_pairs(star, 80).count() < 400 * 10
    assert {g for _, _, g, _, _ in found(S.near_duplicates(df, F.col("text")))} == {0}


def test_plan_has_no_python_and_no_pairs(spark):
    df = spark.createDataFrame([(1, "a b c d e f")], "page_id long, text string")
    sets = df.select(F.col("page_id").alias("class"), S.word_shingles(F.col("text")).alias("shingles"))
    members = sets.select("class", F.explode(S.band_keys(F.col("shingles"))).alias("bucket"))
    for plan in (S._centres(members), S._stars(S._centres(members), sets, 80), S.near_duplicates(df, F.col("text"))):
        shown = plan._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in shown and "Arrow" not in shown and "Cartesian" not in shown and "NestedLoop" not in shown


def test_bands(spark):
    texts = ["a", "a b c d e", " ".join(f"w{i}" for i in range(3000))]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    rows = df.select(S.word_shingles(F.col("text")).alias("s")).select("s", S.band_keys(F.col("s")).alias("k")).collect()
    for r in rows:
        values = {}
        for x in r.s:
            bin_ = (x >> (64 - S.BIN_BITS)) + S.BINS // 2
            values[bin_] = min(values.get(bin_, x), x)
        assert len(r.k) == S.BINS // S.ROWS and sorted(r.s) == r.s
        assert len(values) == min(len(r.s), S.BINS) or len(r.s) > 1
    assert len(set(rows[0].k)) == S.BINS // S.ROWS


def test_sets_and_keys_are_made_and_written_once(spark, monkeypatch):
    written, real = [], S.stored

    def spy(df, label):
        written.append((df.columns, df._jdf.queryExecution().optimizedPlan().toString()))
        return real(df, label)

    monkeypatch.setattr(S, "stored", spy)
    rows = families(random.Random(4))[:40]
    df = spark.createDataFrame(rows, "page_id long, text string")
    assert found(S.near_duplicates(df, F.col("text"))) == plain_groups(rows)
    assert sum("shingles" in columns for columns, _ in written) == 1
    # Band keys fill empty bins by array_repeat; the differences are ranked in one table.
    assert sum("array_repeat" in plan for _, plan in written) == 1
    assert sum("row_number()" in plan for _, plan in written) == 1
    assert not any("array_sort(" in plan or "array_join(" in plan for _, plan in written)


def sketched(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "page_id long, text string")
    sets = df.select(F.col("page_id").alias("class"), S.word_shingles(F.col("text")).alias("shingles"))
    return sets, sets.select("class", F.explode(S.band_keys(F.col("shingles"), S.band_rows(80))).alias("bucket"))


def test_phrase_in_short_texts_makes_few_pairs(spark):
    """300 short texts with one phrase in common and nothing else: few of them meet."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(3000)]
    texts = [" ".join([*rng.choices(words, k=rng.randrange(6, 16)), "all rights are reserved by us", *rng.choices(words, k=rng.randrange(6, 16))]) for _ in range(300)]
    _, members = sketched(spark, texts)
    assert S._centres(members).count() < 60


def test_short_sets_meet(spark):
    """Sets of four to sixty shingles and the same with as many more as a similarity of 0.8 allows share a bucket."""
    rng = random.Random(6)
    texts = []
    for k in range(300):
        n = 4 + k % 57
        longer = [f"w{rng.randrange(10**9)}" for _ in range(n + n // 4 + 4)]
        texts += [" ".join(longer[: n + 4]), " ".join(longer)]
    _, members = sketched(spark, texts)
    met = members.withColumn("pair", F.expr("class div 2")).groupBy("pair", "bucket").count().where("count = 2").select("pair").distinct()
    assert met.count() == 300


def test_bins_of_their_own_or_drawn(spark):
    """Band keys against plain Python's values of bins."""
    texts = [" ".join(f"w{i}" for i in range(n)) for n in (3, 5, 7, 12, 40, 150, 400, 2000)]
    sets, _ = sketched(spark, texts)
    shown = sets.select("shingles", *(S.band_keys(F.col("shingles"), r).alias(f"keys{r}") for r in (4, 3, 2, 1))).collect()
    values, asked = [], []
    for r in shown:
        full = {}
        for x in r.shingles:
            full.setdefault((x >> (64 - S.BIN_BITS)) + S.BINS // 2, x)
        for j in range(S.BINS):
            tried = [j, *(S.DONORS[j] >> k & (S.BINS - 1) for k in range(0, 63, S.BIN_BITS))]
            values.append(next((full[d] for d in tried if d in full), None))
            asked.append(list(full.values()))
    df = spark.createDataFrame([(k // S.BINS, k % S.BINS, v, a) for k, (v, a) in enumerate(zip(values, asked, strict=True))], "t int, j int, v long, a array<long>")
    df = df.withColumn("v", F.coalesce("v", F.array_min(F.transform("a", lambda y: F.xxhash64("j", y)))))
    for rows in (4, 3, 2, 1):
        band = df.where(F.col("j") < S.BINS // rows * rows).groupBy("t", (F.col("j") / rows).cast("int").alias("band")).agg(F.sort_array(F.collect_list(F.struct("j", "v")))["v"].alias("v"))
        keys = band.select("t", "band", F.xxhash64("band", *(F.get("v", F.lit(k)) for k in range(rows))).alias("key")).orderBy("t", "band").collect()
        assert [k.key for k in keys] == [k for r in shown for k in r[f"keys{rows}"]]


def test_narrowed(spark, monkeypatch):
    rows, ids = spark.range(20000).select(F.concat(F.lit("p"), "id").alias("class")), spark.range(0, 20000, 40).select(F.concat(F.lit("p"), "id").alias("a"))
    ids = ids.union(ids).union(spark.createDataFrame([(None,)], "a string"))
    kept = S._narrowed(rows, "class", ids)
    plan = kept._jdf.queryExecution().executedPlan().toString().split("Subquer")[0]
    assert "Exchange" not in plan and "Join" not in plan
    assert ids.where("a is not null").join(kept, F.col("a") == F.col("class"), "left_anti").count() == 0
    assert kept.count() < 1000
    assert S._narrowed(rows, "class", ids.where("a is null")).count() < 100
    monkeypatch.setattr(S, "MASK_WORDS", 4)
    assert ids.where("a is not null").join(S._narrowed(rows, "class", ids), F.col("a") == F.col("class"), "left_anti").count() == 0


def test_only_sets_to_compare_are_written(spark, monkeypatch):
    written, real = {}, S.stored

    def spy(df, label):
        out = real(df, label)
        written[label] = (out[0].columns, out[0].count())
        return out

    monkeypatch.setattr(S, "stored", spy)
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) for _ in range(200)]
    rows = [(i, t) for i, t in enumerate([*texts, texts[3] + " more", texts[5] + " more", texts[3]])]
    df = spark.createDataFrame(rows, "page_id long, text string")
    assert found(S.near_duplicates(df, F.col("text"))) == plain_groups(rows)
    assert [n for columns, n in written.values() if "shingles" in columns] == [4]
    assert not any("text" in columns for columns, _ in written.values())
