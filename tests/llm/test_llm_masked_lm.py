"""The network's gradient, normalisation and learning; scores against a plain loop; results that don't depend on splits."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from linkloom.llm import masked_lm as M
from linkloom.llm.textcols import texts_of
from linkloom.session import stored

DOCS = "/root/testdata/sf0.001/documents.parquet"


def random_network(seed=0):
    net = M.Network.fresh(seed)
    for part in net.parts[:3]:
        part += np.random.default_rng(seed).normal(0, 0.2, part.shape).astype(np.float32)
    return net


def hashes(text):
    return M.words_of(texts_of(pa.array([text])))[0]


def counted(docs):
    return stored(M.word_counts(docs), "test-words")[0]


def test_probabilities_sum_to_one():
    net = random_network()
    context = np.repeat(np.array([[3, 900, 17, M.EDGE], [0, 1, 2, 3]]), M.UNITS, axis=0)
    unit = np.tile(np.arange(M.UNITS), 2)
    total = np.exp(net.log_probs(context, unit)).reshape(2, -1).sum(1)
    assert np.allclose(total, 1, atol=1e-4)


def test_steps_follow_the_gradient():
    """Against differences of the loss; a step moves each parameter by rate * slope / root of its squares."""
    rng = np.random.default_rng(2)
    context, unit = rng.integers(0, 40, (50, 4)), rng.integers(0, 200, 50)
    net = random_network()
    after = M.Network(net.flat.copy())
    after.step(context, unit, 1e-3)
    loss = lambda: -net.log_probs(context, unit).sum()
    for part, squares in ((0, 3), (1, 4), (2, 5)):
        moved = (net.parts[part] - after.parts[part]) / 1e-3
        scale = np.sqrt(after.parts[squares])
        slope = moved * (scale[:, None] if part == 0 else scale)
        for place in rng.permutation(np.argwhere(np.abs(slope) > 0.2))[:12]:
            place, eps = tuple(place), np.float32(0.02)
            net.parts[part][place] += eps
            up = loss()
            net.parts[part][place] -= 2 * eps
            down = loss()
            net.parts[part][place] += eps
            assert (up - down) / (2 * eps) == pytest.approx(slope[place], rel=0.05, abs=0.02)


def test_steps_lower_the_loss():
    rng = np.random.default_rng(1)
    unit = np.tile(rng.integers(0, M.UNITS, 20), 100)
    at = np.arange(len(unit))
    context = M.contexts(unit, np.zeros(len(unit), int), at)
    net = M.Network.fresh()
    before = net.log_probs(context, unit).mean()
    for _ in range(60):
        pick = rng.integers(0, len(at), 256)
        net.step(context[pick], unit[pick])
    assert net.log_probs(context, unit).mean() > before + 2


def test_context_stops_at_the_edges():
    unit, owner = np.array([1, 2, 3, 4, 5]), np.array([0, 0, 0, 1, 1])
    assert M.contexts(unit, owner, np.array([0, 2, 3])).tolist() == [[M.EDGE, M.EDGE, 2, 3], [1, 2, M.EDGE, M.EDGE], [M.EDGE, M.EDGE, 5, M.EDGE]]


def test_vocabulary_counts_the_whole_corpus(spark):
    rows = [(k, " ".join(["The"] * (k % 5 + 1) + ["a", f"only{k}"])) for k in range(2000)]
    docs = spark.createDataFrame([*rows, (9000, None), (9001, "")], "doc_id long, text string")
    counts = counted(docs)
    assert {r.word: r.n for r in counts.collect()}[int(hashes("tHE").view(np.int64)[0])] == sum(k % 5 + 1 for k in range(2000))
    for share in (M.SHARE, 0.01):
        vocabulary, words = M.build_vocabulary(counts, share)
        assert words == sum(len(r[1].split()) for r in rows)
        assert vocabulary.units(hashes("the a")).tolist() == [0, 1]
        rare = vocabulary.log_counts(hashes("the only7 never"))[1].tolist()
        assert rare == [False, share > M.SHARE, True]


def plain_scores(docs, training, vocabulary, network):
    """Word by word: unit from its context, then the word's count among those of its unit."""
    split = lambda t: [w for w in re.split(r"[ \t-\r]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or "")) if w]
    count = Counter(w for t in training for w in split(t))
    unit_of = lambda ws: vocabulary.units(hashes(" ".join(ws))).tolist() if ws else []
    total = Counter()
    for w, u in zip(count, unit_of(list(count))):
        total[u] += count[w]
    for text in docs:
        words = split(text)
        unit, value = unit_of(words), 0.0
        for t, w in enumerate(words):
            around = [unit[t + d] if 0 <= t + d < len(unit) else M.EDGE for d in (-2, -1, 1, 2)]
            value += network.log_probs(np.array([around]), np.array(unit[t : t + 1]))[0]
            value += math.log(max(count[w], 1)) - math.log(max(total[unit[t]], 1)) if unit[t] >= M.TOP else 0
        yield len(words), value


@pytest.mark.parametrize("share", [M.SHARE, 1e-4, 0.5])
def test_scores_word_by_word(spark, share):
    docs = spark.read.parquet(DOCS)
    vocabulary, network = M.train(docs, counted(docs), share=share)
    got = {r.doc_id: r for r in M.score_documents(docs, share=share).collect()}
    picked = docs.where("doc_id < 12").collect()
    training = [r.text for r in docs.select("text").collect()]
    for r, (n, value) in zip(picked, plain_scores([r.text for r in picked], training, vocabulary, network)):
        assert got[r.doc_id].n_tokens == n
        assert got[r.doc_id].log_prob == pytest.approx(value, rel=1e-5, abs=1e-6)
        assert (got[r.doc_id].mean_log_prob is None) == (n == 0)


def test_scores_do_not_depend_on_splits(spark):
    docs = spark.read.parquet(DOCS)
    docs = docs.unionByName(docs.where("doc_id = 3").crossJoin(spark.range(30)).drop("id"))  # one text thirty times more
    means = []
    for splits in (1, 16):
        rows = M.score_documents(docs.repartition(splits), shard_words=3_000).collect()
        means.append(sorted((r.doc_id, r.n_tokens, r.mean_log_prob or 0) for r in rows))
    assert [m[:2] for m in means[0]] == [m[:2] for m in means[1]]
    assert np.allclose([m[2] for m in means[0]], [m[2] for m in means[1]], rtol=1e-6, atol=0)


def test_training_beats_word_frequencies(spark):
    """On texts that it was not trained on, also when many shards train apart."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held, rest = docs.where("doc_id % 10 = 0"), docs.where("doc_id % 10 <> 0")
    vocabulary, network = M.train(rest, counted(rest))
    _, parted = M.train(rest, counted(rest), shard_words=20_000)
    texts = [r.text for r in held.select("text").where("text is not null").collect()]
    words, owner = M.words_of(texts_of(pa.array(texts)))
    unit = vocabulary.units(words)
    context = M.contexts(unit, owner, np.arange(len(unit)))
    frequency = np.exp(vocabulary.total)
    flat = np.log(frequency / frequency.sum())[unit].mean()
    assert network.log_probs(context, unit).mean() > flat + 0.1
    assert parted.log_probs(context, unit).mean() > flat + 0.1


def test_every_position_is_dealt_once(spark):
    rows = [(k, f"w{k % 40} x y{k}") for k in range(300)] + [(k, "same text") for k in range(1000, 1200)] + [(7, None), (8, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    vocabulary, _ = M.build_vocabulary(counted(docs))
    for shards in (1, 7, 40):
        dealt = M.dealt_texts(docs, vocabulary, shards).collect()
        assert sum(len(r.units) // 2 * r.copies for r in dealt) == 300 * 3 + 200 * 2
        hot = [r.copies for r in dealt if len(r.units) == 4]
        assert sum(hot) == 200 and len(hot) == shards and max(hot) - min(hot) <= 1
        assert all(r["round"] == int(math.log2(r.shard // M.FIRST + 1)) and 0 <= r.shard < shards for r in dealt)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, "a b", 1), (3, "a b", 1), (None, "x " * 200_000, 1)], "doc_id long, text string, n_tokens int")
    rows = sorted(((r.doc_id or 9, r.n_tokens, r.log_prob <= 0, r.mean_log_prob is None) for r in M.score_documents(docs).collect()))
    assert rows == [(1, 0, True, True), (2, 0, True, True), (3, 2, True, False), (3, 2, True, False), (9, 200_000, True, False)]
    assert M.score_documents(docs.limit(0)).count() == 0
    (unseen,) = M.score_documents(docs.where("doc_id = 3").limit(1), training=docs.limit(0)).collect()
    assert unseen.n_tokens == 2 and unseen.log_prob < 0
