"""Token ids as binary shards with a minimal perfect hash index.

A shard is two files. ``*.ids`` holds the raw ids of its documents, one after the other, as little-endian unsigned integers of 2 or 4
bytes. ``*.idx`` holds the index: document keys and offsets in file order, and a minimal perfect hash over the
distinct keys that gives each key its slot in constant time; the slot has a 32-bit fingerprint of the key and the number
of the key's first record. A key that is not in the shard is told by its fingerprint (wrong with a chance of 2^-32).

The hash is built by levels: keys are hashed into twice as many bits as there are keys; bits that one key alone hits
stay set, the other keys go on to the next level. A key's slot is the number of set bits before its own.

Index layout, little-endian: magic ``LKIX0001``; then 64-bit integers: bytes per id, records, keys, levels; bits of each level;
then the bit arrays of the levels, padded to 64 bits; fingerprints (uint32) and first records (uint32) by slot; record offsets in
ids (uint64, one more than records); record keys (int64).
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkloom.llm.textcols import mix, slices
from linkloom.session import scratch_path, stored

MAGIC = b"LKIX0001"
END_ID = 1
CACHE_WORDS = 700_000
BITS_PER_KEY = 2
MAX_LEVELS = 64
READ_IDS = 1 << 21


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys."""

    def __init__(self, levels: list[np.ndarray]) -> None:
        self.levels = levels
        self.ranks, base = [], 0
        for bits in levels:
            filled = np.concatenate([[0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)])
            self.ranks.append(base + filled)
            base += int(filled[-1])

    @staticmethod
    def place(keys: np.ndarray, level: int, words: int) -> np.ndarray:
        """Bit of each key at a level of ``words`` 64-bit words."""
        return (mix(mix(keys.view(np.uint64)) ^ np.uint64(level * 0x9E3779B1 + 1)) % np.uint64(words * 64)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, left = [], keys
        while len(left):
            if len(levels) == MAX_LEVELS:
                raise ValueError("keys are not distinct")
            words = (len(left) * BITS_PER_KEY + 63) // 64
            at = cls.place(left, len(levels), words)
            alone = np.bincount(at, minlength=words * 64) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = left[~alone[at]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 for some keys that are not among those it was built from."""
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, bits in enumerate(self.levels):
            at = self.place(keys[open_], level, len(bits))
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            hit = (bits[word] >> bit) & np.uint64(1) == 1
            below = bits[word] & ((np.uint64(1) << bit) - np.uint64(1))
            out[open_[hit]] = (self.ranks[level][word] + np.bitwise_count(below))[hit]
            open_ = open_[~hit]
        return out


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys.view(np.uint64) + np.uint64(0xA5A5A5A5)) >> np.uint64(32)).astype("<u4")


def index_bytes(keys: np.ndarray, offsets: np.ndarray, width: int) -> bytes:
    """The index of records with these keys (equal ones are neighbours) and offsets."""
    distinct, first = np.unique(keys, return_index=True)
    found = PerfectHash.build(distinct)
    slot = found.slots(distinct)
    prints, records = np.zeros(len(distinct), "<u4"), np.zeros(len(distinct), "<u4")
    prints[slot], records[slot] = fingerprints(distinct), first
    head = np.array([width, len(keys), len(distinct), len(found.levels), *(len(b) * 64 for b in found.levels)], "<u8")
    parts = [head, *found.levels, prints, records, offsets.astype("<u8"), keys.astype("<i8")]
    return MAGIC + b"".join(p.tobytes() for p in parts)


class Index:
    """A shard's index, read from bytes."""

    def __init__(self, raw: bytes) -> None:
        if raw[:8] != MAGIC:
            raise ValueError("not a token index")
        at = 8

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            part = np.frombuffer(raw, kind, n, at)
            at += part.nbytes
            return part

        self.width, n, m, levels = (int(x) for x in take("<u8", 4))
        sizes = take("<u8", levels)
        self.hash = PerfectHash([take("<u8", int(s) // 64) for s in sizes])
        self.prints, self.records = take("<u4", m), take("<u4", m)
        self.offsets, self.keys = take("<u8", n + 1).astype(np.int64), take("<i8", n)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """First record of each key, -1 if the shard doesn't have it."""
        slot = self.hash.slots(keys)
        known = slot >= 0
        known[known] = self.prints[slot[known]] == fingerprints(keys[known])
        return np.where(known, self.records.astype(np.int64)[np.maximum(slot, 0)] if len(self.records) else 0, -1)


#: A word of lower-case letters up to U+00FF: one piece of the tokenizer's splitting, unchanged by its normalisation.
_LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+\Z")
def byte_letters() -> dict[int, int]:
    """The byte-level alphabet by its rule: printable Latin-1 stands for itself, the other bytes follow from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    return dict(zip((b for b in range(256) if b not in shown), range(0x100, 0x200)))


class WordCoder:
    """Ids of texts by way of their words. The tokenizer (lower case, white space dropped) never joins across
    white space, so a text's ids are those of its words in turn, and a word seen before needs no second encoding."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one task, one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.mark = next(iter(self.tokenizer.get_added_tokens_decoder().values())).content
        self.mark_id = self.tokenizer.token_to_id(self.mark)
        self.alphabet = byte_letters()
        self.slot: dict[bytes, int] = {}
        self.begin, self.size = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self.flat, self.filled = np.zeros(1 << 14, np.uint32), 0

    @staticmethod
    def words(text: str | None) -> list[bytes]:
        """Parts of a text that the tokenizer encodes independently of each other. Lower case comes first, unless the text may hold
        one of the tokenizer's special tokens, which are told by case."""
        raw = (text or "").encode()
        return raw.split() if b"<|" in raw else raw.lower().split()

    def _plain(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of letters, each of which is one piece for the model."""
        tokenize, ids, sizes = self.tokenizer.model.tokenize, [], []
        for word in words:
            found = tokenize(word.decode() if word.isascii() else word.decode("latin-1").translate(self.alphabet))
            ids.extend([t.id for t in found])
            sizes.append(len(found))
        return np.array(ids, np.uint32), np.array(sizes, np.int64)

    def _full(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of other words: through the whole tokenizer together, parted by one of its special tokens."""
        text = self.mark.join(w.decode() for w in words)
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        cuts = np.flatnonzero(ids == self.mark_id)
        sizes = np.diff(np.concatenate([[-1], cuts, [len(ids)]])) - 1
        return np.delete(ids, cuts), sizes

    def _add(self, words: list[bytes]) -> None:
        """Encode words that aren't known yet. A word of letters with a full stop or comma is encoded as the word and the mark: the
        tokenizer always cuts there."""
        plain, other, marked, alone = [], [], [], []
        for w in words:
            if _LETTERS.match(w):
                plain.append(w)
            elif w[-1] in b".," and _LETTERS.match(w, 0, len(w) - 1):
                marked.append(w)
            elif b"<|" in w:
                alone.append(w)
            else:
                other.append(w)
        plain = list(dict.fromkeys([*plain, *(w[:-1] for w in marked if w[:-1] not in self.slot)]))
        self._store(plain, *self._plain(plain))
        other += [m for m in (b".", b",") if marked and m not in self.slot and m not in other]
        for k in range(0, len(other), 2000):
            self._store(other[k : k + 2000], *self._full(other[k : k + 2000]))
        for w in alone:
            ids = np.array(self.tokenizer.encode(w.decode(), add_special_tokens=False).ids, np.uint32)
            self._store([w], ids, np.array([len(ids)]))
        if marked:
            core = np.fromiter((self.slot[w[:-1]] for w in marked), np.int64, len(marked))
            sign = np.fromiter((self.slot[w[-1:]] for w in marked), np.int64, len(marked))
            pairs = np.stack([core, sign], axis=1).ravel()
            ids, sizes = self._gather(pairs)
            self._store(marked, ids, sizes.reshape(-1, 2).sum(1))

    def _store(self, words: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        known = len(self.slot)
        while known + len(words) > len(self.begin):
            self.begin, self.size = np.resize(self.begin, 2 * len(self.begin)), np.resize(self.size, 2 * len(self.size))
        while self.filled + len(ids) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.flat[self.filled : self.filled + len(ids)] = ids
        self.size[known : known + len(words)] = sizes
        self.begin[known : known + len(words)] = self.filled + np.cumsum(sizes) - sizes
        self.filled += len(ids)
        self.slot.update(zip(words, range(known, known + len(words))))

    def _gather(self, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words in these slots, one after the other, and how many each has."""
        sizes = self.size[slot]
        ends = np.cumsum(sizes)
        return self.flat[np.repeat(self.begin[slot] - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)], sizes

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each has."""
        by_text = [self.words(t) for t in texts]
        words = [w for ws in by_text for w in ws]
        slot = np.fromiter(map(self.slot.get, words, repeat(-1)), np.int64, len(words))
        unknown = np.flatnonzero(slot < 0)
        if len(unknown):
            if len(self.slot) > CACHE_WORDS:  # bounds the memory; frequent words come back at once
                self.slot.clear()
                self.filled, unknown = 0, np.arange(len(words))
            self._add(list(dict.fromkeys([words[i] for i in unknown])))
            slot[unknown] = np.fromiter(map(self.slot.__getitem__, [words[i] for i in unknown]), np.int64, len(unknown))
        ids, sizes = self._gather(slot)
        stops = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum([len(ws) for ws in by_text])] if by_text else np.zeros(0, np.int64)
        return ids, np.diff(np.concatenate([[0], stops]))


@lru_cache(maxsize=2)
def coder(path: str) -> WordCoder:
    """Loaded once in each worker process."""
    return WordCoder(path)


MANIFEST = "shard long, ids_path string, index_path string, n_docs long, n_ids long"


def write_shards(docs: DataFrame, tokenizer: str, folder: str, *, end_id: int = END_ID) -> DataFrame:
    """Write ``docs`` (``doc_id``, ``text``) below ``folder`` in ascending order of ``doc_id``; returns the stored manifest, one row
    per shard: ``shard`` (in order), its files, documents and ids.

    Every text is encoded whole, with ``end_id`` after it; a null text counts as empty. Rows that repeat an id are all written,
    rows without one are left out. ``folder`` must be reachable by all executors. A task that runs again writes files of its own,
    and only those of the attempt that succeeded are in the manifest. The number of shards is that of the session's
    shuffle partitions. Rows with the same id are dealt out too, so no id can fill a task.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(tokenizer)
        kind = np.dtype(f"<u{c.width}")
        shard = TaskContext.get().partitionId()
        store, base = arrow_fs.FileSystem.from_uri(folder)
        name = f"{base}/shard-{shard:06d}-{uuid.uuid4().hex}"
        keys, sizes, out = [], [], None
        for batch in slices(batches, "text"):
            if out is None:
                store.create_dir(base, recursive=True)
                out = store.open_output_stream(f"{name}.ids")
            ids, n = c.encode(batch.column("text").to_pylist())
            ends = np.cumsum(n)
            out.write(np.insert(ids, ends, end_id).astype(kind).tobytes())
            keys.append(batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64))
            sizes.append(n + 1)
        if out is None:
            return
        out.close()
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        with store.open_output_stream(f"{name}.idx") as index:
            index.write(index_bytes(np.concatenate(keys), offsets, c.width))
        where = folder.rstrip("/") + "/" + name.rsplit("/", 1)[1]
        yield pa.record_batch(
            {"shard": [shard], "ids_path": [f"{where}.ids"], "index_path": [f"{where}.idx"], "n_docs": [len(offsets) - 1], "n_ids": [int(offsets[-1])]}
        )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    ranged = rows.repartitionByRange("doc_id", F.rand(7)).sortWithinPartitions("doc_id")
    return stored(ranged.mapInArrow(write, MANIFEST), "token-manifest")[0]


def _load(path: str) -> bytes:
    store, where = arrow_fs.FileSystem.from_uri(path)
    with store.open_input_stream(where) as f:
        return f.read()


def read_shards(manifest: DataFrame) -> DataFrame:
    """One row per document, from the files: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids`` as
    little-endian unsigned 32-bit integers. Each shard is read by one task; its documents are looked up by key."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                index = Index(_load(row["index_path"]))
                first = index.find(index.keys)
                number = np.arange(len(first))
                wrong = (first < 0) | (index.keys[np.maximum(first, 0)] != index.keys)
                if wrong.any():
                    raise ValueError(f"{row['index_path']} doesn't find its own keys")
                repeat_no = number - np.maximum.accumulate(np.where(first == number, number, 0))  # among rows with the same id
                record = first + repeat_no
                lo, hi = index.offsets[record], index.offsets[record + 1]
                store, where = arrow_fs.FileSystem.from_uri(row["ids_path"])
                with store.open_input_file(where) as f:
                    at = 0
                    while at < len(lo):
                        stop = max(at + 1, int(np.searchsorted(hi, lo[at] + READ_IDS, side="right")))
                        f.seek(int(lo[at]) * index.width)
                        ids = np.frombuffer(f.read(int(hi[stop - 1] - lo[at]) * index.width), f"<u{index.width}").astype("<u4")
                        cuts = hi[at:stop] - lo[at]
                        starts = lo[at:stop] - lo[at]
                        yield pa.record_batch(
                            {
                                "doc_id": pa.array(index.keys[at:stop]),
                                "start": pa.array(row["base"] + lo[at:stop]),
                                "n_tokens": pa.array(hi[at:stop] - lo[at:stop]),
                                "ids": pa.array([ids[s:e].tobytes() for s, e in zip(starts, cuts)], pa.binary()),
                            }
                        )
                        at = stop

    order = Window.orderBy("shard")  # over one row per shard, not per document
    based = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return based.repartition(max(1, manifest.count())).mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def lookup(manifest_rows: list[dict], key: int) -> np.ndarray | None:
    """The ids of one document by its key, reading only its bytes; None if no shard has it."""
    for row in manifest_rows:
        index = Index(_load(row["index_path"]))
        record = int(index.find(np.array([key], np.int64))[0])
        if record >= 0:
            store, where = arrow_fs.FileSystem.from_uri(row["ids_path"])
            with store.open_input_file(where) as f:
                f.seek(int(index.offsets[record]) * index.width)
                return np.frombuffer(f.read(int(index.offsets[record + 1] - index.offsets[record]) * index.width), f"<u{index.width}").astype(np.uint32)
    return None


def shared_uri(spark: SparkSession, label: str) -> str:
    """The address of a new folder below the shared one."""
    path = scratch_path(spark, label)
    return path if "://" in path or path.startswith("file:") else "file://" + path
