"""Benchmark decontamination by templates.

Texts become sequences of template words: numbers turn into ``<num>``, units after a number into ``<unit>``, capitalised words inside
a sentence into ``<name>``, those that start one into either (a window is read both ways); other words lose case and edge punctuation. Windows of ``WINDOW`` template words of the
documents are hash-joined with those of the benchmark. A match is then held against the slots: within
one aligned passage every benchmark value must always stand for the same document value, so a question that was
given other numbers and names is caught, while a text that only shares the form is not. Windows with another value than the
usual one are left out, those that stand there word for word always count. A benchmark window with fewer than ``MIN_PLAIN`` different
plain words (numbers and names, mostly) matches only the same words.

A document is contaminated if consistent windows cover ``MIN_WORDS`` template words of one item in step, or of one
unbroken run, or a whole item that is shorter.

Scale: benchmark windows set bits in a bitmap of fixed size (8 MB whatever the benchmark's
size), which is shared with all tasks; documents emit only windows that hit it. What the bitmap lets through
is joined exactly by the window's text, first once per window, whatever the number of items that have it. Only documents whose
windows cover enough words together, or a short item, are then held against every item that has the window. Items with
the same text are one.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkloom.llm.bitmaps import key_bitmap, maybe_in
from linkloom.llm.textcols import Texts, mix, slices, texts_of, windows
from linkloom.session import stored

WINDOW = 8
MIN_WORDS = 12
MIN_PLAIN = 4

#: Units as they are written after a number.
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg t oz lb lbs pound pounds ml l liter liters litre litres "
    "gallon gallons s sec second seconds min minute minutes h hour hours day days week weeks month months year years "
    "hz khz mhz ghz b kb mb gb tb w kw mw v mv a ma j kj cal kcal n pa kpa c f k mph kmh percent dollar dollars cent cents euro euros"
).split()
PLAIN, NUM, UNIT, NAME = range(4)
MARKS = ("", "<num>", "<unit>", "<name>")

_CLASS = np.zeros(256, np.uint8)  # 1 digit, 2 upper, 4 lower, 8 part of a number, 16 edge punctuation, 32 ends a sentence
_CLASS[48:58] |= 1
_CLASS[65:91] |= 2
_CLASS[97:123] |= 4
_CLASS[list(b".,:/%$+-")] |= 8
_CLASS[list(b"\"'`.,;:!?()[]{}<>-*_~$%+")] |= 16
_CLASS[list(b".!?:")] |= 32


class Template:
    """Template words of some texts: ``key`` hashes the word or its mark, ``kind`` says which, ``begin`` and ``end`` cut
    the slot value (or the plain word) out of ``text``, the lower-cased bytes."""

    def __init__(self, texts: Texts) -> None:
        data = texts.data.copy()
        capital = (data >= 65) & (data <= 90)
        accent = np.zeros(len(data), bool)  # second byte of a capital from U+00C0 to U+00DE
        accent[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        data[capital | accent] += 32
        self.text = Texts(data, texts.bounds)
        start, end, self.owner = texts.words()
        kinds = _CLASS[texts.data]
        solid = (kinds & 16) == 0
        position = np.arange(len(data))
        after = np.minimum.accumulate(np.where(solid, position, len(data))[::-1])[::-1] if len(data) else position
        before = np.maximum.accumulate(np.where(solid, position, -1)) if len(data) else position
        self.begin, self.end = after[start], before[end - 1] + 1
        bare = (self.begin >= end) | (self.end <= start)  # punctuation alone stays
        self.begin, self.end = np.where(bare, start, self.begin), np.where(bare, end, self.end)
        n = len(start)

        def within(mask: np.ndarray) -> np.ndarray:
            sums = np.zeros(len(data) + 1, np.int64)
            np.cumsum(mask, out=sums[1:])
            return sums[self.end] - sums[self.begin]

        digits, ascii_letters, other = within((kinds & 1) > 0), within((kinds & 6) > 0), within((kinds & 15) == 0)
        capitals = within(capital | accent)
        number = (digits > 0) & (other == 0) & ((ascii_letters == 0) | ((ascii_letters <= 5) & ((kinds[self.begin] & 1) > 0) & ((kinds[self.end - 1] & 6) > 0)))
        breaks = np.zeros(len(data) + 1, np.int64)
        np.cumsum(texts.data == 10, out=breaks[1:])
        opens = np.ones(n, bool)
        if n > 1:
            opens[1:] = (self.owner[1:] != self.owner[:-1]) | (breaks[start[1:]] != breaks[start[:-1]]) | ((kinds[end[:-1] - 1] & 32) > 0)
        first = np.minimum(self.begin + 1, len(data) - 1) if len(data) else self.begin
        titled = (capital[self.begin] | (accent[first] & (texts.data[self.begin] == 0xC3))) & (capitals == 1) & (self.end - self.begin > 1)
        self.key = self.text.hashes(self.begin, self.end)
        unit = np.zeros(n, bool)
        if n > 1:
            unit[1:] = number[:-1] & np.isin(self.key[1:], _unit_keys()) & (self.owner[1:] == self.owner[:-1])
        self.kind = np.where(number, NUM, np.where(unit, UNIT, np.where(titled & ~opens, NAME, PLAIN)))
        self.opener = titled & (self.kind == PLAIN)  # starts a sentence, line or text: a name, or a plain word
        marks = mix(np.arange(1, 5, dtype=np.uint64))
        self.literal = mix(self.key ^ marks[0])
        self.key = np.where(self.kind > 0, marks[self.kind], self.key)
        self.named = marks[NAME]
        self.length = np.bincount(self.owner, minlength=len(texts))

    def word(self, i: int) -> str:
        return self.text.data[self.begin[i] : self.end[i]].tobytes().decode()

    def readings(self, size: int, classes: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Starts and hashes of the windows, and which words are read as names: none of the sentence starts, then each choice of their
        numbers modulo ``classes``. With up to ``classes`` sentence starts in a window, that's every choice."""
        number = np.cumsum(self.opener) % classes
        starts = [self.opener & (number == c) for c in range(classes)]
        for chosen in range(1 << classes):
            members = [starts[c] for c in range(classes) if chosen >> c & 1]
            named = np.logical_or.reduce(members) if members else np.zeros(len(self.key), bool)
            at, keys = windows(np.where(named, self.named, self.key), self.owner, size)
            for member in members:  # a window without one of the numbers has been read by a smaller choice
                sums = np.concatenate([[0], np.cumsum(member)])
                some = sums[at + size] > sums[at]
                at, keys = at[some], keys[some]
            yield at, keys, named

    def window(self, at: int, size: int, named: np.ndarray) -> tuple[str, list[str]] | None:
        """Form and slot values of a window, ``named`` words read as names; None if it has too few different plain words to say anything."""
        kinds = np.where(named[at : at + size], NAME, self.kind[at : at + size]).tolist()
        words = [self.word(i) for i in range(at, at + size)]
        if len({w for w, k in zip(words, kinds) if not k}) < min(MIN_PLAIN, max(1, size - 1)):
            return None
        return " ".join(MARKS[k] or w for w, k in zip(words, kinds)), [w for w, k in zip(words, kinds) if k]

    def exact(self, at: int, size: int) -> tuple[str, list[str]] | None:
        """A window as it stands, for those with few plain words: it matches the same words only. None if it has less than two
        different words other than punctuation (rules, dot leaders, a single number)."""
        words = [self.word(i) for i in range(at, at + size)]
        if len({w for w in words if any(c.isalnum() for c in w)}) < 2:
            return None
        return "= " + " ".join(words), []


def _unit_keys() -> np.ndarray:
    data = "".join(UNITS).encode()
    ends = np.cumsum([len(u) for u in UNITS])
    return Texts(np.frombuffer(data, np.uint8), np.array([0, len(data)])).hashes(ends - [len(u) for u in UNITS], ends)


WINDOWS = "item_id long, n_words int, item_pos int, size int, key long, form string, item_slots array<string>"
HITS = "doc_id long, pos int, size int, key long, form string, slots array<string>"
PASSAGES = "doc_id long, item_id long, covered int, whole boolean, same boolean, kept array<struct<at: int, size: int>>"


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    text = pa.list_(pa.string())
    kinds = {"item_id": pa.int64(), "doc_id": pa.int64(), "key": pa.int64(), "form": pa.string(), "slots": text, "item_slots": text}
    return pa.record_batch({k: pa.array([r[i] for r in rows], kinds.get(k, pa.int32())) for i, k in enumerate(names)})


def benchmark_windows(items: DataFrame, size: int, least: int) -> DataFrame:
    """All windows of all items; items with the same text count once, as the smallest id. An item of fewer than ``least`` words
    is a window of its own length too, so that finding it whole is one match."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 17):
            template = Template(texts_of(batch.column("text")))
            begin = np.concatenate([[0], np.cumsum(template.length)])
            ids, rows = batch.column("item_id").to_pylist(), []
            for length in sorted({s for n in template.length.tolist() if n for s in (min(size, n), n if n < least else size) if s <= n}):
                few = set()
                for at, keys, named in template.readings(length, 4):
                    plain = not named.any()
                    for p, key in zip(at.tolist(), keys.view(np.int64).tolist()):
                        i = int(template.owner[p])
                        n = int(template.length[i])
                        if length == min(size, n) or length == n < least:
                            if found := template.window(p, length, named):
                                rows.append((ids[i], n, p - int(begin[i]), length, key, *found))
                            elif plain:
                                few.add(p)
                at, keys = windows(template.literal, template.owner, length)
                for p, key in zip(at.tolist(), keys.view(np.int64).tolist()):
                    if p in few and (found := template.exact(p, length)):
                        i = int(template.owner[p])
                        rows.append((ids[i], int(template.length[i]), p - int(begin[i]), length, key, *found))
            yield _batch(rows, ["item_id", "n_words", "item_pos", "size", "key", "form", "item_slots"])

    distinct = items.where("item_id is not null").groupBy("text").agg(F.min(F.col("item_id").cast("long")).alias("item_id"))
    return distinct.select("item_id", "text").mapInArrow(cut, WINDOWS).distinct()


def matching_windows(docs: DataFrame, known: DataFrame, size: int) -> DataFrame:
    """Windows of the documents that may be in the benchmark: all that are, and a few others."""
    bitmap = docs.sparkSession.sparkContext.broadcast(key_bitmap(known, "key"))
    sizes = sorted(r[0] for r in known.select("size").distinct().collect())  # no more than the words of the longest window

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value
        for batch in slices(batches, "text"):
            template = Template(texts_of(batch.column("text")))
            begin = np.concatenate([[0], np.cumsum(template.length)])
            ids, rows = batch.column("doc_id").to_pylist(), []
            for length in sizes:
                for at, keys, named in template.readings(length, 2):
                    hit = maybe_in(bits, keys)
                    for p, key in zip(at[hit].tolist(), keys[hit].view(np.int64).tolist()):
                        if found := template.window(p, length, named):
                            i = int(template.owner[p])
                            rows.append((ids[i], p - int(begin[i]), length, key, *found))
                at, keys = windows(template.literal, template.owner, length)
                hit = maybe_in(bits, keys)
                for p, key in zip(at[hit].tolist(), keys[hit].view(np.int64).tolist()):
                    if found := template.exact(p, length):
                        i = int(template.owner[p])
                        rows.append((ids[i], p - int(begin[i]), length, key, *found))
            yield _batch(rows, ["doc_id", "pos", "size", "key", "form", "slots"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null").mapInArrow(look_up, HITS)


def _covered(kept: list[tuple[int, int]]) -> int:
    """Words covered by the windows (position, size) in ``kept``, sorted."""
    total, reach = 0, -1
    for at, size in kept:
        total += max(0, at + size - max(at, reach))
        reach = max(reach, at + size)
    return total


def _majority(held: dict[tuple[int, int], set[tuple[str, str]]]) -> dict[str, str]:
    """The document value that each benchmark value stands for most often; the same value, then the smallest, on a tie."""
    votes = Counter(pair for pairs in held.values() for pair in pairs)
    best: dict[str, str] = {}
    for (a, b), _ in sorted(votes.items(), key=lambda v: (v[1], v[0][0] == v[0][1], v[0][::-1])):
        best[a] = b
    return best


def _stretch(held: dict[tuple[int, int], set[tuple[str, str]]]) -> list[tuple[int, int]]:
    """The longest unbroken run of windows in which every benchmark value always stands for the same document value."""
    order, values, best = sorted(held), {}, (0, 0, 0)
    start = clashes = 0
    for i, w in enumerate(order):
        if i and w[0] > order[i - 1][0] + order[i - 1][1]:
            start, values, clashes = i, {}, 0
        for a, b in held[w]:
            seen = values.setdefault(a, Counter())
            clashes += not seen[b] and bool(seen)
            seen[b] += 1
        while clashes:
            for a, b in held[order[start]]:
                values[a][b] -= 1
                if not values[a][b]:
                    del values[a][b]
                    clashes -= bool(values[a])
            start += 1
        if start <= i:
            best = max(best, (w[0] + w[1] - order[start][0], start, i + 1))
    return order[best[1] : best[2]]


def judge(found: list[dict], n_words: int, least: int) -> tuple[int, bool, bool, list[tuple[int, int]]] | None:
    """Windows of one document and one item in step: words covered by those that hold, whether that's enough, whether no
    slot changed its value in them or in enough of them, and the windows that hold.

    A window holds if its slots have the document's values, or if each has the value that the benchmark value mostly stands for;
    in an unbroken run long enough, each may stand for another value than elsewhere.
    """
    # Of the readings of one window, the one with the fewest names: the others add words that are equal.
    order = sorted(found, key=lambda w: -len(w["slots"]))
    held = {(w["pos"], w["size"]): set(zip(w["item_slots"], w["slots"])) for w in order}
    mostly = _majority(held)
    equal = sorted(w for w, pairs in held.items() if all(a == b for a, b in pairs))
    kept = sorted({*equal, *(w for w, pairs in held.items() if all(mostly[a] == b for a, b in pairs))})
    enough = min(least, n_words)
    if _covered(stretch := _stretch(held)) >= enough:
        kept = sorted({*kept, *stretch})
    if not kept:
        return None
    covered = _covered(kept)
    return covered, covered >= enough, len(equal) == len(kept) or _covered(equal) >= enough, kept


def contamination(docs: DataFrame, items: DataFrame, *, size: int = WINDOW, least: int = MIN_WORDS) -> DataFrame:
    """One row per contaminated ``doc_id`` of ``docs`` (``doc_id``, ``text``): ``n_covered`` (most words covered at once),
    ``verbatim`` (no slot changed its value in some passage) and ``item_ids`` (sorted; the smallest id of items with the same text).

    Null and empty texts match nothing, an empty benchmark leaves no row, repeated rows count once, and rows
    without an id are not looked at. Other columns are ignored.
    """
    known, _ = stored(benchmark_windows(items, size, least), "windows")  # shuffled anew for each join: AQE can split a hot window
    forms = known.groupBy("key", "form", "size").agg(F.max(F.col("size") >= F.least(F.lit(least), "n_words")).alias("enough"))
    by_doc = Window.partitionBy("doc_id").orderBy("pos")
    before = F.max(F.col("pos") + F.col("size")).over(by_doc.rowsBetween(Window.unboundedPreceding, -1))
    of_doc = Window.partitionBy("doc_id")
    # Forms first: a document whose windows can't make a passage, whatever items they come from, is not held against items.
    hits = (
        matching_windows(docs, known, size).distinct().join(forms, ["key", "form", "size"])
        .withColumn("new", F.greatest(F.lit(0), F.col("pos") + F.col("size") - F.greatest("pos", F.coalesce(before, F.lit(0)))))
        .withColumn("total", F.sum("new").over(of_doc)).withColumn("enough", F.max("enough").over(of_doc))
        .where((F.col("total") >= least) | F.col("enough")).drop("new", "total", "enough")
    )
    aligned = hits.join(known, ["key", "form", "size"]).groupBy(
        "doc_id", "item_id", (F.col("pos") - F.col("item_pos")).alias("shift"), "n_words"
    ).agg(F.collect_list(F.struct("pos", "size", "item_slots", "slots")).alias("found"))

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in PASSAGES.split(", ")[:5]]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_()]
        windows_type = pa.list_(pa.struct([("at", pa.int32()), ("size", pa.int32())]))
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                rows = []
                for r in batch.slice(start, 256).to_pylist():
                    if judged := judge(r["found"], r["n_words"], least):
                        rows.append((r["doc_id"], r["item_id"], *judged[:3], [{"at": a, "size": s} for a, s in judged[3]]))
                columns = {n: pa.array([r[i] for r in rows], kinds[i]) for i, n in enumerate(names)}
                yield pa.record_batch({**columns, "kept": pa.array([r[5] for r in rows], windows_type)})

    passages = aligned.mapInArrow(hold, PASSAGES)
    # A run: windows of the same document that touch or overlap, whatever items they come from. Runs and passages are taken from one
    # reading: a row per passage, and its windows.
    per_doc = passages.groupBy("doc_id").agg(
        F.max("covered").alias("passage_words"),
        F.max("whole").alias("whole"),
        F.max("same").alias("verbatim"),
        F.array_sort(F.collect_set("item_id")).alias("item_ids"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("kept")))).alias("kept"),
    )
    run = "if(w.at <= r.reach, named_struct('start', r.start, 'reach', greatest(r.reach, w.at + w.size), 'most', greatest(r.most, w.at + w.size - r.start)), "
    run += "named_struct('start', w.at, 'reach', w.at + w.size, 'most', greatest(r.most, w.size)))"
    longest = F.expr(f"aggregate(kept, named_struct('start', 0, 'reach', -1, 'most', 0), (r, w) -> {run}, r -> r.most)")
    return (
        per_doc.withColumn("run_words", longest).where(F.col("whole") | (F.col("run_words") >= least))
        .select("doc_id", F.greatest("passage_words", "run_words").alias("n_covered"), "verbatim", "item_ids")
    )


def decontaminate(docs: DataFrame, items: DataFrame, **options: int) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``contaminated`` and, if so, the columns of :func:`contamination`."""
    found = contamination(docs, items, **options).withColumn("contaminated", F.lit(True))
    return docs.select("doc_id").join(found, "doc_id", "left").select(
        "doc_id", F.coalesce("contaminated", F.lit(False)).alias("contaminated"), F.coalesce("n_covered", F.lit(0)).alias("n_covered"), "verbatim", "item_ids"
    )
