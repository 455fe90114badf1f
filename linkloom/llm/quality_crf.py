"""Quality rules by line labelling.

Each line of a text becomes one observation of a linear-chain conditional random field with two states,
boilerplate (0) and content (1). Viterbi decoding labels whole texts; a text is kept if the base rules
accept it and content lines hold at least ``min_content`` of its line bytes.

The field is fitted in numpy on a bounded sample of labelled documents: ``max_docs`` for each value of
``quality``, smallest hash of the id first, and ``max_lines`` consecutive lines of a document. Lines of documents
with quality 0 count as boilerplate, the others as content, so the chain learns how junk lines look and that
lines of a kind stand together. Everything else covers all lines of all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.textcols import Texts, counts, repeats, slices, texts_of, windows

MAX_DOCS = 1000
MAX_LINES = 200
BINS = 6
EPOCHS = 100
RIDGE = 1e-3
PRIOR = 0.85  # share of the weight that content lines have in training
MIN_CONTENT = 0.5
MIN_WORDS = 20
REPEAT_WINDOW = 8
MAX_REPEAT_PCT = 30
SYMBOLS = b"#*$%&|<>"

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, n_lines long, n_content_lines long, content_share double, kept boolean"
)
#: Measures of a line and the edges of their bins. Shares have the same edges whatever the sample looks like.
FEATURES = {
    "bytes": (8, 40, 120, 400, 20000),
    "bytes per word": (2.5, 3.5, 9, 14, 30),
    "symbols per word": (0.03, 0.1, 0.3, 0.6, 0.9),
    "marks per word": (0.1, 0.25, 0.5, 0.8, 1.2),
    "upper-case share of letters": (0.001, 0.12, 0.25, 0.5, 0.8),
    "digit share of bytes": (0.02, 0.1, 0.2, 0.4, 0.7),
    "words equal to the one before": (0.05, 0.1, 0.3, 0.6, 0.9),
    "stands twice or more in the text": (0.5, 1.5, 2.5, 3.5, 4.5),
    "brackets, slashes and signs per byte": (0.02, 0.05, 0.1, 0.2, 0.4),
}
EDGES = np.array(list(FEATURES.values()), np.float64)


@dataclass
class LineModel:
    """Weights of the field: ``emit`` scores content against boilerplate for each bin of each feature."""

    emit: np.ndarray
    step: np.ndarray
    start: np.ndarray


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


class Lines:
    """Measures of the lines of some texts."""

    def __init__(self, texts: Texts) -> None:
        data = texts.data
        self.starts, self.ends, self.text = texts.lines()
        self.word_starts, self.word_ends, self.word_text = texts.words()
        self.words = texts.hashes(self.word_starts, self.word_ends)
        table = np.zeros(256, np.uint8)
        table[list(SYMBOLS)] = 1
        table[[ord("!"), ord("?"), ord("|")]] |= 2
        table[65:91] |= 4
        table[97:123] |= 8
        table[48:58] |= 16
        table[list(b"{}[]()<>=_/\\@;~^")] |= 32
        self.kinds = table[data]
        self.line_of_word = np.searchsorted(self.starts, self.word_starts, side="right") - 1 if len(self.starts) else self.word_starts
        self.n_words = counts(self.line_of_word, len(self.starts))
        self.hash = texts.hashes(self.starts, self.ends)
        spoken = self.n_words > 0
        self.dup = np.zeros(len(self.starts), bool)
        twice, later = repeats(self.text[spoken], self.hash[spoken])
        self.dup[spoken] = later
        self.twice = np.zeros(len(self.starts), bool)
        self.twice[spoken] = twice

    def per_line(self, bit: int) -> np.ndarray:
        sums = np.zeros(len(self.kinds) + 1, np.int64)
        np.cumsum((self.kinds & bit) > 0, out=sums[1:])
        return sums[self.ends] - sums[self.starts]

    def features(self) -> np.ndarray:
        """One row per line: numbers that don't depend on the language."""
        size = self.ends - self.starts
        upper, lower = self.per_line(4), self.per_line(8)
        echo = np.zeros(len(self.words), bool)
        echo[1:] = (self.words[1:] == self.words[:-1]) & (self.line_of_word[1:] == self.line_of_word[:-1])
        return np.column_stack(
            [
                size,
                _share(size, self.n_words),
                _share(self.per_line(1), self.n_words),
                _share(self.per_line(2), self.n_words),
                _share(upper, upper + lower),
                _share(self.per_line(16), size),
                _share(np.bincount(self.line_of_word[echo], minlength=len(size)), self.n_words),
                self.twice,
                _share(self.per_line(32), size),
            ]
        ).astype(np.float32)


def _coded(x: np.ndarray, edges: np.ndarray = EDGES) -> np.ndarray:
    """Number of the bin of each feature, offset so that each (feature, bin) has a weight of its own."""
    out = np.empty(x.shape, np.int64)
    for k in range(x.shape[1]):
        out[:, k] = k * (edges.shape[1] + 1) + np.searchsorted(edges[k], x[:, k], side="right")
    return out


def fit_field(rows: list[tuple[np.ndarray, int]], epochs: int = EPOCHS) -> LineModel:
    """Maximum likelihood by gradient ascent (Adam). ``rows``: line features and label of each document.

    With no rows, or rows of one label only, nothing can be learned: all lines decode as content.
    """
    n_features = len(FEATURES)
    flat = LineModel(np.zeros(n_features * BINS), np.zeros((2, 2)), np.array([0.0, 1.0]))
    rows = [(x, y) for x, y in rows if len(x)]
    if len({y for _, y in rows}) < 2:
        return flat
    rows = sorted(rows, key=lambda r: -len(r[0]))
    lengths = np.array([len(x) for x, _ in rows])
    n, steps = len(rows), int(lengths[0])
    codes = np.zeros((n, steps, n_features), np.int64)
    for i, (x, _) in enumerate(rows):
        codes[i, : len(x)] = _coded(x)
    label = np.array([y for _, y in rows])
    live = np.arange(steps)[None, :] < lengths[:, None]
    balance = np.where(label == 1, PRIOR / max((lengths * (label == 1)).sum(), 1), (1 - PRIOR) / max((lengths * (label == 0)).sum(), 1))
    parts = {"emit": np.zeros(n_features * BINS), "step": np.zeros((2, 2)), "start": np.zeros(2)}
    first = {k: np.zeros_like(v) for k, v in parts.items()}
    second = {k: np.zeros_like(v) for k, v in parts.items()}
    for epoch in range(1, epochs + 1):
        emit, step, start = parts["emit"], parts["step"], parts["start"]
        score = np.zeros((n, steps, 2))
        score[:, :, 1] = emit[codes].sum(2)
        forward, backward = np.zeros((n, steps, 2)), np.zeros((n, steps, 2))
        forward[:, 0] = score[:, 0] + start
        for t in range(1, steps):
            m = int((lengths > t).sum())
            forward[:m, t] = score[:m, t] + np.logaddexp(forward[:m, t - 1, :1] + step[0], forward[:m, t - 1, 1:] + step[1])
        for t in range(steps - 2, -1, -1):
            m = int((lengths > t + 1).sum())
            ahead = score[:m, t + 1] + backward[:m, t + 1]
            backward[:m, t] = np.logaddexp(step[:, 0] + ahead[:, :1], step[:, 1] + ahead[:, 1:])
        last = forward[np.arange(n), lengths - 1]
        total = np.logaddexp(last[:, 0], last[:, 1])
        marginal = np.exp(forward + backward - total[:, None, None]) * live[:, :, None]
        gold = np.zeros((n, steps, 2))
        gold[np.arange(n), :, label] = 1
        error = (gold * live[:, :, None] - marginal) * balance[:, None, None]
        grad = {"emit": np.bincount(codes.ravel(), np.repeat(error[:, :, 1].ravel(), n_features), minlength=len(emit)), "start": error[:, 0].sum(0)}
        pair = np.zeros((2, 2))
        if steps > 1:
            both = live[:, 1:]
            for a in range(2):
                for b in range(2):
                    p = np.exp(np.minimum(forward[:, :-1, a] + step[a, b] + score[:, 1:, b] + backward[:, 1:, b] - total[:, None], 0)) * both
                    pair[a, b] = ((both * ((label == a) & (label == b))[:, None] - p) * balance[:, None]).sum()
        grad["step"] = pair
        for k, g in grad.items():
            g = g - RIDGE * parts[k]
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            parts[k] = parts[k] + 0.1 * (first[k] / (1 - 0.9**epoch)) / (np.sqrt(second[k] / (1 - 0.99**epoch)) + 1e-8)
    return LineModel(parts["emit"], parts["step"], parts["start"])


def viterbi(score: np.ndarray, text: np.ndarray, n: int, model: LineModel) -> np.ndarray:
    """Best state of each line. All texts advance together, line by line; a tie goes to content."""
    lengths = counts(text, n)
    begin = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    order = np.argsort(-lengths, kind="stable")
    lengths, begin = lengths[order], begin[order]
    states = np.zeros(len(score), np.int8)
    back = np.zeros((len(score), 2), np.int8)
    live = int((lengths > 0).sum())
    if not live:
        return states
    value = np.zeros((live, 2)) + model.start
    value[:, 1] += score[begin[:live]]
    tops = int(lengths[0])
    last = np.zeros((n, 2))
    alive = np.searchsorted(-lengths, -np.arange(1, tops + 1), side="right")  # texts with more than t lines, at t
    for t in range(1, tops):
        m = int(alive[t])
        last[m : len(value)] = value[m:]
        value = value[:m]
        options = value[:, :, None] + model.step[None]
        came = (options[:, 1, :] >= options[:, 0, :]).astype(np.int8)
        at = begin[:m] + t
        back[at] = came
        value = np.where(came == 1, options[:, 1, :], options[:, 0, :])
        value[:, 1] += score[at]
    last[: len(value)] = value
    current = (last[:live, 1] >= last[:live, 0]).astype(np.int8)
    for t in range(tops - 1, -1, -1):
        m = int(alive[t])
        at = begin[:m] + t
        states[at] = current[:m]
        current[:m] = back[at, current[:m]] if t else current[:m]
    return states


def judge(texts: Texts, model: LineModel, min_content: float) -> dict[str, np.ndarray]:
    """Measures and verdict of each text."""
    n = len(texts)
    lines = Lines(texts)
    word_byte = np.zeros(len(texts.data) + 1, np.int64)
    points = (texts.data & 0xC0) != 0x80
    blank = (texts.data == 32) | ((texts.data >= 9) & (texts.data <= 13))
    np.cumsum(points & ~blank, out=word_byte[1:])
    symbol = np.zeros(len(texts.data) + 1, np.int64)
    np.cumsum((lines.kinds & 1) > 0, out=symbol[1:])
    starts, keys = windows(lines.words, lines.word_text, REPEAT_WINDOW)
    twice, _ = repeats(lines.word_text[starts], keys)
    edges = np.zeros(len(lines.words) + REPEAT_WINDOW, np.int64)
    np.add.at(edges, starts[twice], 1)
    np.add.at(edges, starts[twice] + REPEAT_WINDOW, -1)
    covered = np.cumsum(edges)[: len(lines.words)] > 0
    n_words = counts(lines.word_text, n)
    n_repeat = counts(lines.word_text[covered], n)
    failed = (n_words < MIN_WORDS) | (100 * n_repeat > MAX_REPEAT_PCT * n_words)
    spoken = lines.n_words > 0
    text = lines.text[spoken]
    score = model.emit[_coded(lines.features()[spoken])].sum(1)
    content = viterbi(score, text, n, model) == 1
    size = (lines.ends - lines.starts)[spoken]
    share = np.bincount(text[content], size[content], minlength=n) / np.maximum(np.bincount(text, size, minlength=n), 1)
    return {
        "n_words": n_words,
        "word_chars": word_byte[texts.bounds[1:]] - word_byte[texts.bounds[:-1]],
        "n_symbols": symbol[texts.bounds[1:]] - symbol[texts.bounds[:-1]],
        "n_dup_lines": counts(lines.text[lines.dup], n),
        "n_repeat_words": n_repeat,
        "base_failed": failed,
        "n_lines": counts(text, n),
        "n_content_lines": counts(text[content], n),
        "content_share": share,
        "kept": ~failed & (share >= min_content),
    }


def sample_lines(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS) -> list[tuple[np.ndarray, int]]:
    """Line features of the bounded labelled sample, brought to the driver (a few MB at most)."""
    known = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    rank = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = {q: [r[0] for r in known.where(F.col("quality") == q).orderBy(*rank).select("doc_id").limit(max_docs).collect()] for q in (0, 1)}
    label = {i: q for q, ids in picked.items() for i in ids}
    if not label:
        return []

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            lines = Lines(texts_of(batch.column("text")))
            spoken = lines.n_words > 0
            x, text = lines.features()[spoken], lines.text[spoken]
            out = [x[text == i][:MAX_LINES].tobytes() for i in range(batch.num_rows)]
            yield pa.record_batch({"doc_id": batch.column("doc_id").cast(pa.int64()), "x": pa.array(out, pa.binary())})

    rows = (
        docs.select("doc_id", "text").where(F.col("doc_id").isin(list(label)))
        .mapInArrow(measure, "doc_id long, x binary").limit(2 * max_docs).collect()
    )
    rows = sorted(((r[0], bytes(r[1])) for r in rows), key=lambda r: r)
    return [(np.frombuffer(x, np.float32).reshape(-1, len(FEATURES)), label[i]) for i, x in rows]


def quality_rules(docs: DataFrame, labels: DataFrame, *, max_docs: int = MAX_DOCS, min_content: float = MIN_CONTENT) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``) with its base measures and the field's verdict.

    Null and empty texts have no words and fail the base rules. Repeated rows are judged one by one. Columns
    beyond the two are ignored. Without usable labels every line counts as content.
    """
    model = fit_field(sample_lines(docs, labels, max_docs))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out = judge(texts_of(batch.column("text")), model, min_content)
            yield pa.record_batch({"doc_id": batch.column("doc_id").cast(pa.int64()), **{k: pa.array(v) for k, v in out.items()}})

    return docs.select("doc_id", "text").mapInArrow(label, SCHEMA)


def keep_quality(docs: DataFrame, labels: DataFrame, *, max_docs: int = MAX_DOCS, min_content: float = MIN_CONTENT) -> DataFrame:
    """The rows of ``docs``, all columns, that :func:`quality_rules` keeps. Filters where the rows are read: no shuffle."""
    model = fit_field(sample_lines(docs, labels, max_docs))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield batch.filter(pa.array(judge(texts_of(batch.column("text")), model, min_content)["kept"]))

    return docs.mapInArrow(keep, docs.schema)
