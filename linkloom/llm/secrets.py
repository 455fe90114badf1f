"""Secret scan: three base patterns and an assignment-aware lexer.

The base patterns (``assign``, ``access``, ``hex``) report every leftmost non-overlapping match that is long
enough. The lexer reads source and configuration syntax into (name, value) pairs: plain names, quoted ones, subscripts, long options, and
values that stand in a call. It follows names that stand for other names, and scores each literal by the names that it reaches. Constants are
propagated in the order of the text: a value that is put together from literals and names is scored as a whole, and if it is a secret, all of
the literals that it was put together from are. Literals with a score of ``THRESHOLD`` or more are reported as ``literal`` spans beside the base ones.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from linkloom.llm.textcols import Texts, runs, slices, texts_of

KINDS = ("assign", "access", "hex", "literal")
THRESHOLD = 2.0

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_WORDS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX_MIN, ACCESS_MIN, ASSIGN_MIN = 16, 18, 12
_HEX = np.isin(np.arange(256), list(b"0123456789abcdef"))

#: A pair starts with a name, quoted or not, with an optional declaration word before it; then ``=``, ``:=``, ``=>``, ``:`` or a
#: blank after a long option; then a value: literals or names joined by ``+`` or ``.``. Repeats are possessive, so no length needs a bound.
_NAME = r"""(?:(?<![\w.$-])(?P<option>--)?(?P<name>[A-Za-z_][\w.-]*+)|(?P<quote>["'])(?P<quoted>[A-Za-z_][\w. -]*+)(?P=quote))"""
_PAIR = re.compile(_NAME + r"""[ \t]*+(?:\][ \t]*+)?(?:(?P<sign>:=|=>|==?|:)[ \t]*+(?=\S)|(?(option)(?<=[ \t])(?=[^\s-])|(?!)))""")
_ATOM = re.compile(
    r"""[brufBRUF]{0,2}\"{3}(?P<triple>(?:[^"\\]++|\\[\s\S]|"(?!""))*+)\"{3}|[brufBRUF]{0,2}'{3}(?P<triple1>(?:[^'\\]++|\\[\s\S]|'(?!''))*+)'{3}"""
    r"""|`(?P<tick>(?:[^`\\]++|\\[\s\S])*+)`|[brufBRUF]{0,2}"(?P<double>(?:[^"\\\n]|\\.)*)"|[brufBRUF]{0,2}'(?P<single>(?:[^'\\\n]|\\.)*)'|\$\{(?P<hole>[A-Za-z_]\w*+)\}|\$?(?P<word>[^\s"'`,;(){}\[\]<>|&#]+)"""
)
#: A literal as the first argument of calls, one within the other.
_CALL = re.compile(r"""(?:new[ \t]++)?(?:(?P<function>[A-Za-z_][\w.:]*+)[ \t]*+\([ \t]*+)++(?=[brufBRUF]{0,2}["'`])""")
_PLUS = re.compile(r"[ \t]*[+.][ \t]*(?=[\"'A-Za-z_$])")
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
_IDENTIFIER = re.compile(r"[A-Za-z_][\w.]*\Z")

#: Weights of name parts.
SENSITIVE = {
    "password": 2.0, "passwd": 2.0, "pwd": 2.0, "passphrase": 2.0, "secret": 2.0, "token": 1.5, "apikey": 2.0,
    "credential": 1.5, "credentials": 1.5, "bearer": 1.5, "auth": 1.0, "private": 0.8, "access": 0.7,
    "signing": 0.7, "encryption": 0.7, "api": 0.7, "key": 0.8, "client": 0.2, "pass": 1.0,
}
#: Name parts that make a literal harmless: what it says is about a secret, not one.
HARMLESS = {"public", "example", "sample", "placeholder", "hint", "label", "length", "len", "count", "name", "url", "type", "path", "file", "id", "max", "min"}
#: Parts of the names of functions whose argument says where a value is, not what it is.
LOOKUPS = {"get", "getenv", "env", "environ", "find", "lookup", "load", "read", "open", "fetch", "require", "format", "print", "log", "error", "prompt", "input", "path", "has"}
DUMMY = re.compile(r"(?i)\A(?:x+|\*+|\.+|changeme|none|null|true|false|undefined|todo|example.*|your[-_ ].*|<.*>|\$\{.*\}|%\(.*\)s)\Z")


def name_weight(name: str) -> float:
    parts = [p.lower() for p in _PARTS.findall(name)]
    weight = sum(SENSITIVE.get(p, 0.0) for p in parts)
    if "apikey" not in parts and "api" in parts and "key" in parts:
        weight += 0.5
    return weight - 1.5 * sum(p in HARMLESS for p in parts)


def literal_weight(value: str) -> float:
    """How much a literal looks like key material."""
    if DUMMY.match(value):
        return -5.0
    return characters_weight(Counter(value)) - (1.5 if " " in value.strip() else 0.0)


def characters_weight(signs: Counter) -> float:
    """The same by the characters alone: their number, entropy and mix."""
    n = sum(signs.values())
    if n < 6 or len(signs) < 3:
        return -5.0
    entropy = -sum(c / n * math.log2(c / n) for c in signs.values())
    every = "".join(signs)
    classes = sum(bool(re.search(p, every)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9 ]"))
    weight = min(n, 40) / 40 + entropy / 4 + 0.3 * (classes - 1)
    if classes == 1 and not re.search("[0-9]", every):
        weight -= 0.8
    return weight


def pairs(text: str) -> Iterator[tuple[str, list[tuple[str, str, int, int]]]]:
    """(name, atoms) of each assignment; an atom is (``literal`` or ``name``, value, start, end)."""
    for m in _PAIR.finditer(text):
        if m["sign"] == "==":
            continue
        at, atoms = m.end(), []
        while True:
            call = _CALL.match(text, at)
            a = _ATOM.match(text, call.end() if call else at)
            if not a:
                break
            kind = a.lastgroup
            if call:
                if not LOOKUPS & {p.lower() for p in _PARTS.findall(call["function"])} and re.search("[0-9]", a[kind] or ""):
                    atoms.append(("literal", a[kind], a.start(kind), a.end(kind)))
            elif kind == "word" and _IDENTIFIER.match(a["word"]):
                atoms.append(("name", a["word"].rstrip("."), a.start("word"), a.end("word")))
            elif kind == "hole":
                atoms.append(("name", a["hole"], a.start("hole"), a.end("hole")))
            elif a[kind]:
                atoms.append(("literal", a[kind], a.start(kind), a.end(kind)))
            plus = _PLUS.match(text, a.end()) if kind != "word" or _IDENTIFIER.match(a["word"]) else None
            if not plus:
                break
            at = plus.end()
        if atoms:
            yield (m["name"] or m["quoted"]).split(".")[-1], atoms


def assembled(found: list[tuple[str, list[tuple[str, str, int, int]]]], defined: set[str]) -> tuple[dict[int, Counter], list[list[int]]]:
    """Characters of the values that are put together from parts, a name among them, by what the names stand for when the text gets
    there; and the assignments that each assignment takes its names' values from. Counts of a character stop at a million."""
    last: dict[str, int] = {}
    signs: list[Counter] = []
    joined, takes = {}, []
    for i, (name, atoms) in enumerate(found):
        own, sources = Counter(), []
        for kind, value, _, _ in atoms:
            source = last.get(value.split(".")[-1]) if kind == "name" else None
            if source is not None:
                sources.append(source)
                for c, n in signs[source].items():
                    own[c] = min(own[c] + n, 10**6)
            elif kind == "literal" or value.split(".")[-1] not in defined:
                own.update(value)
        if sources:
            joined[i] = own
        signs.append(own)
        takes.append(sources)
        last[name] = i
    return joined, takes


def lexed_spans(text: str) -> list[tuple[int, int, float]]:
    """Literals that reach a sensitive name: (start, end, score). Reads the whole text; a name that gets several
    values keeps each. A bare word that no assignment defines is a literal of its own (as in configuration files)."""
    if "=" not in text and ":" not in text and "--" not in text:
        return []
    found = list(pairs(text))
    if not found:
        return []
    defined = {name for name, _ in found}
    feeds: dict[str, set[str]] = {}  # name -> names whose values it takes
    for name, atoms in found:
        for kind, value, _, _ in atoms:
            if kind == "name" and value.split(".")[-1] in defined:
                feeds.setdefault(name, set()).add(value.split(".")[-1])
    best = {name: name_weight(name) for name in defined}
    work = sorted(best, key=best.get)
    while work:  # the weight of a target flows back to what is put into it; each name settles after few rounds
        name = work.pop()
        for source in feeds.get(name, ()):
            if best[name] > best[source]:
                best[source] = best[name]
                work.append(source)
    joined: dict[int, float] = {}  # assignment -> weight of the best secret that its literals are part of
    if feeds:
        signs, takes = assembled(found, defined)
        weights = {i: characters_weight(c) for i, c in signs.items() if best[found[i][0]] > 0}
        for top in sorted(weights, key=weights.get, reverse=True):  # the heaviest first, so each assignment is visited once
            todo = [top] if best[found[top][0]] + weights[top] - 1.0 >= THRESHOLD else []
            while todo:
                i = todo.pop()
                if i not in joined:
                    joined[i] = weights[top]
                    todo += takes[i]
    out = []
    for i, (name, atoms) in enumerate(found):
        if best[name] <= 0:
            continue
        literals = [a for a in atoms if a[0] == "literal" or a[1].split(".")[-1] not in defined]
        whole = max(literal_weight("".join(a[1] for a in literals)), joined.get(i, -5.0))
        for kind, value, start, end in literals:
            if kind == "name" and not re.search(r"\d", value):
                continue
            score = best[name] + max(whole, literal_weight(value)) - 1.0
            if whole > -5 and score >= THRESHOLD:
                out.append((start, end, score))
    return out


def hex_runs(texts: Texts) -> dict[int, list[tuple[int, int]]]:
    """Runs of HEX_MIN or more lower-case hexadecimal digits of each text that has any, in code points."""
    starts, ends = runs(_HEX[texts.data], texts.bounds)
    long = ends - starts >= HEX_MIN
    starts, ends = starts[long], ends[long]
    points = np.zeros(len(texts.data) + 1, np.int64)
    np.cumsum((texts.data & 0xC0) != 0x80, out=points[1:])
    found: dict[int, list[tuple[int, int]]] = {}
    for i, s, e in zip(texts.owner(starts).tolist(), starts.tolist(), ends.tolist()):
        begin = points[texts.bounds[i]]
        found.setdefault(i, []).append((int(points[s] - begin), int(points[e] - begin)))
    return found


def spans(text: str, hexes: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of a text in the order of the report; ``hexes``: its runs of hexadecimal digits."""
    found = [(s, 2, e) for s, e in hexes]
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_MIN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_MIN]
    found += {(s, 3, e) for s, e, _ in lexed_spans(text)}
    return sorted(found)


def render(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in found)


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, n_literal long, base_sha256 string, spans string"


def scan_secrets(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): spans of secrets in code points, ends exclusive.

    Null counts as empty and has no spans; repeated rows are scanned one by one; other columns are ignored.
    ``spans`` is empty if nothing is found, and ``base_sha256`` is then the hash of the empty text.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            hexes = hex_runs(texts_of(batch.column("text")))
            rows: dict[str, list] = {k: [] for k in ("n_assign", "n_access", "n_hex", "n_literal", "base_sha256", "spans")}
            for i, text in enumerate(batch.column("text").to_pylist()):
                found = spans(text or "", hexes.get(i, []))
                for k, kind in enumerate(KINDS):
                    rows[f"n_{kind}"].append(sum(f[1] == k for f in found))
                rows["base_sha256"].append(hashlib.sha256(render([f for f in found if f[1] < 3]).encode()).hexdigest())
                rows["spans"].append(render(found))
            yield pa.record_batch({"doc_id": batch.column("doc_id").cast(pa.int64()), **{k: pa.array(v) for k, v in rows.items()}})

    return docs.select("doc_id", "text").mapInArrow(scan, SCHEMA)


def redact(text: str, found: str, mark: str = "[secret]") -> str:
    """``text`` with the reported spans, overlapping ones joined, replaced by ``mark``."""
    cuts = sorted((int(s), int(e)) for _, s, e in (f.split(":") for f in found.split(",") if f))
    out, at = [], 0
    for s, e in cuts:
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact_secrets(docs: DataFrame) -> DataFrame:
    """All rows and columns of ``docs``; texts with secrets have them cut out and ``n_chars``, if there, recounted."""

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            hexes = hex_runs(texts_of(batch.column("text")))
            changed = {}
            for i, text in enumerate(texts):
                if found := spans(text or "", hexes.get(i, [])):
                    changed[i] = redact(text, render(found))
            if changed:
                columns = dict(zip(batch.schema.names, batch.columns))
                columns["text"] = pa.array([changed.get(i, t) for i, t in enumerate(texts)], batch.schema.field("text").type)
                if "n_chars" in columns:
                    sizes = columns["n_chars"].to_pylist()
                    columns["n_chars"] = pa.array([len(changed[i]) if i in changed else n for i, n in enumerate(sizes)], batch.schema.field("n_chars").type)
                batch = pa.RecordBatch.from_arrays(list(columns.values()), schema=batch.schema)
            yield batch

    return docs.mapInArrow(clean, docs.schema)
