"""Encoding with a SentencePiece model, keeping where each piece stands in the original bytes.

The text is normalised with the model's compiled character map: at each position the longest prefix in
the map is replaced (without one, the character stays), then spaces and the leading mark are applied as the model's
settings say. Every normalised byte remembers the original byte range that it came from, so each piece projects to a
span of the original UTF-8 text. Ids come from the library; the spans are checked against its pieces in tests.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from linkloom.llm.textcols import slices

SPACE = "▁".encode()
SLICE_BYTES = 1 << 18
SCHEMA = "doc_id long, n_tokens long, ids binary, starts binary, ends binary, decoded string"


def read_charsmap(blob: bytes) -> dict[bytes, bytes]:
    """The compiled character map as a plain map: UTF-8 prefix to replacement. Format: length of the
    double array in bytes, its 32-bit units, then the replacements, each ended by a zero byte."""
    if not blob:
        return {}
    (size,) = struct.unpack_from("<I", blob)
    units = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
    pool = blob[4 + size :]
    found: dict[bytes, bytes] = {}

    def offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    stack = [(offset(units[0]), b"")]
    while stack:
        node, prefix = stack.pop()
        for c in range(1, 256):
            at = node ^ c
            if at < len(units) and units[at] & 0x800000FF == c:
                child, key = at ^ offset(units[at]), prefix + bytes([c])
                if units[at] >> 8 & 1:
                    begin = units[child] & 0x7FFFFFFF
                    found[key] = pool[begin : pool.index(b"\0", begin)]
                stack.append((child, key))
    return found


class Normaliser:
    """Normalised bytes of a text with the original start and end of each."""

    def __init__(self, charsmap: dict[bytes, bytes], dummy_prefix: bool, squeeze: bool, escape: bool) -> None:
        self.map, self.dummy_prefix, self.squeeze = charsmap, dummy_prefix, squeeze
        self.space = SPACE if escape else b" "
        self.longest = max(map(len, charsmap), default=0)
        self.heads = np.zeros(256, bool)
        self.heads[[k[0] for k in charsmap]] = True

    def mapped(self, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes after the character map, and the original range of each."""
        data = np.frombuffer(raw, np.uint8)
        heads = np.flatnonzero(self.heads[data]) if self.map else ()
        out, begins, ends, at = [], [], [], 0

        def keep(stop: int) -> None:
            part = data[at:stop]
            lead = np.flatnonzero((part & 0xC0) != 0x80)
            number = np.cumsum((part & 0xC0) != 0x80) - 1
            out.append(part)
            begins.append(at + lead[number])
            ends.append(at + np.append(lead[1:], len(part))[number])

        for i in heads:
            if i < at or data[i] & 0xC0 == 0x80:
                continue
            for n in range(min(self.longest, len(raw) - i), 0, -1):
                new = self.map.get(raw[i : i + n])
                if new is not None:
                    if i > at:
                        keep(i)
                    out.append(np.frombuffer(new, np.uint8))
                    begins.append(np.full(len(new), i))
                    ends.append(np.full(len(new), i + n))
                    at = int(i) + n
                    break
        if at < len(raw):
            keep(len(raw))
        if not out:
            return data, np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(out), np.concatenate(begins), np.concatenate(ends)

    def __call__(self, raw: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
        data, begin, end = self.mapped(raw)
        blank = data == 32
        if self.squeeze and len(data):
            solid = np.flatnonzero(~blank)
            if not len(solid):
                return b"", np.zeros(0, np.int64), np.zeros(0, np.int64)
            stay = ~blank
            stay[1:] |= blank[1:] & ~blank[:-1]
            stay[: solid[0]] = False
            stay[solid[-1] + 1 :] = False
            data, begin, end, blank = data[stay], begin[stay], end[stay], blank[stay]
        if not len(data):
            return b"", np.zeros(0, np.int64), np.zeros(0, np.int64)
        width = np.where(blank, len(self.space), 1)
        spread = np.repeat(np.arange(len(data)), width)
        body = data[spread].copy()
        for k, byte in enumerate(self.space):
            body[np.cumsum(width)[blank] - len(self.space) + k] = byte
        begin, end = begin[spread], end[spread]
        if self.dummy_prefix:
            body = np.concatenate([np.frombuffer(self.space, np.uint8), body])
            lead = np.full(len(self.space), begin[0])
            begin, end = np.concatenate([lead, begin]), np.concatenate([lead, end])
        return body.tobytes(), begin, end


class Codec:
    """A SentencePiece model with its normaliser."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(self.model.serialized_model_proto())
        spec = proto.normalizer_spec
        self.normalise = Normaliser(
            read_charsmap(spec.precompiled_charsmap), spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        )
        kinds = np.array([p.type for p in proto.pieces])
        #: Normalised bytes that a piece stands for; an unknown piece's length depends on the text, control pieces have none.
        self.width = np.array([len(p.piece.encode()) for p in proto.pieces], np.int64)
        self.width[kinds == 6] = 1  # byte pieces
        self.width[kinds == 3] = 0  # control pieces
        self.unknown = self.model.unk_id()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids with begin and end marks, as the library gives them without sampling."""
        return [np.array(x, np.uint32) for x in self.model.encode(texts, add_bos=True, add_eos=True, num_threads=1)]

    def spans(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Original byte range of each id. Begin and end marks are empty ranges at the ends of the text."""
        raw = text.encode()
        body, begin, end = self.normalise(raw)
        stops = np.cumsum(self.width[ids])
        if self.unknown in ids and len(body) != (stops[-1] if len(stops) else 0):
            stops = np.cumsum(self._widths(body.decode(), ids))
        starts = np.concatenate([[0], stops[:-1]])
        if not len(body):
            return np.zeros(len(ids), np.uint32), np.full(len(ids), 0, np.uint32)
        first = np.minimum(starts, len(body) - 1)
        left = np.where(starts < len(body), begin[first], len(raw))
        right = np.where(stops > starts, end[np.maximum(stops, 1) - 1], left)
        return left.astype(np.uint32), right.astype(np.uint32)

    def _widths(self, body: str, ids: np.ndarray) -> np.ndarray:
        """Widths when unknown pieces occur: the library cuts the normalised text itself."""
        pieces = self.model.encode(body.replace(SPACE.decode(), " ").removeprefix(" "), out_type=str)
        middle = [len(p.encode()) for p in pieces]
        return np.array([0, *middle, 0]) if len(middle) == len(ids) - 2 else self.width[ids]

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        return self.model.decode([x.tolist() for x in ids])


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """The model is loaded once in each worker process."""
    return Codec(path)


def encode_pieces(docs: DataFrame, model: str) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): ids with begin and end marks, the original byte range of
    each (``ids``, ``starts``, ``ends``: little-endian unsigned 32-bit integers) and the text decoded from the ids.

    ``model`` is the path of the model file on every executor. Null counts as empty: it has the two marks
    only and decodes to the empty text. Repeated rows are encoded one by one; other columns are ignored.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        for batch in slices(batches, "text", SLICE_BYTES):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            ids = c.encode(texts)
            where = [c.spans(t, x) for t, x in zip(texts, ids)]
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id").cast(pa.int64()),
                    "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
                    "ids": pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()),
                    "starts": pa.array([s.astype("<u4").tobytes() for s, _ in where], pa.binary()),
                    "ends": pa.array([e.astype("<u4").tobytes() for _, e in where], pa.binary()),
                    "decoded": pa.array(c.decode(ids), pa.string()),
                }
            )

    return docs.select("doc_id", "text").mapInArrow(encode, SCHEMA)
