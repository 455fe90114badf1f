"""Language identification by averaged hashed subword embeddings.

A text is the average of the embeddings of its subwords: byte n-grams of 2 to 4 inside a word and at its edges, in lower case, hashed to
``BUCKETS`` rows. A linear softmax on the average gives the languages; embeddings and weights are trained together by
stochastic gradient descent in numpy. As both layers are linear, a trained model folds into one table of scores by bucket, and
a text is scored by adding up table rows.

Training takes a bounded sample: about ``per_lang`` documents of each language (the share of its documents with the smallest
hashes), never held-out ones. A fifth of the sample is set aside to calibrate: a temperature that fits the softmax to the
observed accuracy, and the probability under which a prediction is marked ``rejected`` (``reject`` of the right answers fall below).
Predictions read whole texts and nothing but the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.textcols import Texts, slices, texts_of

BUCKETS = 1 << 15
WIDTH = 16
GRAMS = (2, 3, 4)
PER_LANG = 500
MOST_LANGS = 200
EPOCHS = 6
RATE = 0.5
REJECT = 0.01
UNKNOWN = "und"

SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean"


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # buckets x languages
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents that no training sees."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def subwords(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text number of every subword. Bytes that are no letters part words and count as a blank."""
    data = texts.data
    low = np.where((data >= 65) & (data <= 90), data + 32, data)
    if len(data) > 1:
        accent = np.zeros(len(data), bool)
        accent[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        low = np.where(accent, data + 32, low)
    solid = ((low >= 97) & (low <= 122)) | (low >= 0x80)
    low = np.where(solid, low, 32).astype(np.uint32)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(texts.bounds))
    buckets, owners = [], []
    for n in GRAMS:
        m = len(data) - n + 1
        if m <= 0:
            continue
        code = np.zeros(m, np.uint32)
        for k in range(n):
            code = code * np.uint32(0x01000193) ^ low[k : k + m]
        ok = owner[:m] == owner[n - 1 :]
        for k in range(1, n - 1):
            ok &= solid[k : k + m]
        ok &= solid[:m] | solid[n - 1 :] if n > 2 else solid[:m] & solid[n - 1 :]
        code = (code[ok] ^ np.uint32(n)) * np.uint32(0x9E3779B1)
        buckets.append((code >> np.uint32(17)).astype(np.int64))
        owners.append(owner[:m][ok])
    if not buckets:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    return np.concatenate(buckets), np.concatenate(owners)


def bags(texts: Texts) -> list[tuple[np.ndarray, np.ndarray]]:
    """(buckets, shares) of each text."""
    bucket, owner = subwords(texts)
    order = np.argsort(owner, kind="stable")
    bucket, cuts = bucket[order], np.searchsorted(owner[order], np.arange(len(texts) + 1))
    out = []
    for i in range(len(texts)):
        found, n = np.unique(bucket[cuts[i] : cuts[i + 1]], return_counts=True)
        out.append((found.astype(np.int32), (n / max(n.sum(), 1)).astype(np.float32)))
    return out


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def train(rows: list[tuple[np.ndarray, np.ndarray, str]], seed: int = 5) -> Model:
    """Fit embeddings and softmax on four fifths of the rows, temperature and threshold on the rest."""
    rows = [r for r in rows if len(r[0])]
    langs = sorted({r[2] for r in rows})
    if not langs:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.float32))
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    aside, fit = order[: len(rows) // 5], order[len(rows) // 5 :]
    label = np.array([langs.index(r[2]) for r in rows])
    embed = rng.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH)).astype(np.float32)
    weight, bias = np.zeros((WIDTH, len(langs)), np.float32), np.zeros(len(langs), np.float32)
    steps, step = EPOCHS * len(fit), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(fit):
            bucket, share, _ = rows[i]
            rate = RATE * (1 - step / steps)
            step += 1
            hidden = share @ embed[bucket]
            error = softmax(hidden @ weight + bias)
            error[label[i]] -= 1
            back = weight @ error
            weight -= rate * np.outer(hidden, error)
            bias -= rate * 0.1 * error
            embed[bucket] -= rate * len(bucket) ** 0.5 * share[:, None] * back[None, :]
    table = (embed @ weight).astype(np.float32)
    model = Model(langs, table, bias)
    if len(aside):
        logits = np.stack([rows[i][1] @ table[rows[i][0]] + bias for i in aside])
        gold = label[aside]
        options = np.geomspace(0.05, 10, 60)
        loss = [-np.log(softmax(logits / t)[np.arange(len(aside)), gold] + 1e-12).mean() for t in options]
        model.temperature = float(options[int(np.argmin(loss))])
        right = softmax(logits / model.temperature)[np.arange(len(aside)), gold]
        model.threshold = float(np.quantile(right, REJECT))
    return model


def sample(docs: DataFrame, per_lang: int) -> DataFrame:
    """The bounded training sample: (``doc_id``, ``text``, ``lang``)."""
    known = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    langs = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGS).collect()
    if not langs:
        return known.limit(0)
    share = F.create_map(*(F.lit(x) for r in langs for x in (r["lang"], min(1.0, per_lang / r["count"]))))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 24)) / F.lit(float(1 << 24))
    return known.where(place < share[F.col("lang")]).limit(2 * per_lang * len(langs))


def fit_languages(docs: DataFrame, per_lang: int = PER_LANG) -> Model:
    """Train on the bounded sample; its hashed bags come to the driver, the texts don't."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = bags(texts_of(batch.column("text")))
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id").cast(pa.int64()),
                    "lang": batch.column("lang").cast(pa.string()),
                    "buckets": pa.array([b.tobytes() for b, _ in found], pa.binary()),
                    "shares": pa.array([s.tobytes() for _, s in found], pa.binary()),
                }
            )

    rows = sample(docs, per_lang).mapInArrow(measure, "doc_id long, lang string, buckets binary, shares binary").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["lang"], bytes(r["buckets"])))
    return train([(np.frombuffer(r["buckets"], np.int32), np.frombuffer(r["shares"], np.float32), r["lang"]) for r in rows])


def predict(texts: Texts, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Best language's number and its calibrated probability."""
    bucket, owner = subwords(texts)
    n = len(texts)
    sums = np.stack([np.bincount(owner, model.table[bucket, k], minlength=n) for k in range(len(model.langs))], axis=1)
    mean = sums / np.maximum(np.bincount(owner, minlength=n), 1)[:, None]
    chance = softmax((mean + model.bias) / model.temperature)
    return chance.argmax(1), chance.max(1)


def has_letter(text: str) -> bool:
    return text.isalpha() or any(map(str.isalpha, text))


def identify_language(docs: DataFrame, *, per_lang: int = PER_LANG, training: DataFrame | None = None) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): ``held_out``, ``lang_pred``, ``score`` (calibrated probability) and ``rejected``.

    ``training`` (``doc_id``, ``text``, ``lang``; ``docs`` itself by default) gives the sample. Null texts and texts without a letter are
    ``und`` with score 0 and rejected, and so is every text if there is nothing to learn from. Repeated rows are predicted one by one;
    ``held_out`` is null where the id is.
    """
    model = fit_languages(docs if training is None else training, per_lang)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            spoken = np.array([t is not None and has_letter(t) for t in texts]) & bool(model.langs)
            names, score = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
            if spoken.any():
                best, chance = predict(texts_of(batch.column("text")), model)
                names[spoken] = np.array(model.langs, object)[best[spoken]]
                score[spoken] = np.clip(chance[spoken], 0, 1)
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id").cast(pa.int64()),
                    "held_out": batch.column("held_out"),
                    "lang_pred": pa.array(names.tolist(), pa.string()),
                    "score": pa.array(score),
                    "rejected": pa.array(~spoken | (score < model.threshold)),
                }
            )

    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(label, SCHEMA)
