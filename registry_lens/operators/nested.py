"""Deeply nested JSON into flat, linked tables by vectorised structural indexing.

The texts of an Arrow batch are one byte buffer. Over the whole buffer at once numpy builds
the bitmap of escaped bytes, the bitmap of quotes, from its running parity the mask of bytes
inside strings, the bitmaps of brackets and delimiters outside strings, and by a prefix sum
of the brackets the nesting depth. Whether a record is valid JSON follows from the same
index: its marks, strings and literals are tokens, and each pair of neighbours must be one
that the grammar allows in the container around it. Values of a path are then found for all
records together, level by level, and their spans cut out of the buffer. No record is parsed
into objects; only single keys and strings that are emitted are decoded.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registry_lens.functions.arrow_text import blocks, utf8_buffer
from registry_lens.session import persist_table, spread

QUOTE, SLASH, COMMA, COLON = b'"\\,:'
OPEN_O, CLOSE_O, OPEN_A, CLOSE_A = b"{}[]"
#: JSON's white space, its escapes, hexadecimal digits and literals.
BLANK = np.isin(np.arange(256), list(b" \t\n\r"))
ESCAPED = np.isin(np.arange(256), list(b'"\\/bfnrtu'))
HEX = np.isin(np.arange(256), list(b"0123456789abcdefABCDEF"))
LITERAL = re.compile(rb"true|false|null|-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?")
#: Bytes indexed at a time; a batch is cut into such blocks between records.
BLOCK = 2 << 20

# tokens of the grammar
T_START, T_OPEN_O, T_CLOSE_O, T_OPEN_A, T_CLOSE_A, T_COMMA, T_COLON, T_STRING, T_LITERAL, T_KEY = range(10)
_TOKEN = np.zeros(256, dtype=np.int8)
for _byte, _token in zip(b"{}[],:", range(T_OPEN_O, T_COLON + 1)):
    _TOKEN[_byte] = _token
ROOT, OBJECT, ARRAY = range(3)
#: Which token may follow which, by the container around both.
ALLOWED = np.zeros((3, 10, 10), dtype=bool)
_VALUE, _ENDS = (T_OPEN_O, T_OPEN_A, T_STRING, T_LITERAL), (T_CLOSE_O, T_CLOSE_A, T_STRING, T_LITERAL)
ALLOWED[ROOT, T_START, _VALUE] = True
ALLOWED[OBJECT, T_OPEN_O, (T_KEY, T_CLOSE_O)] = ALLOWED[OBJECT, T_COMMA, T_KEY] = ALLOWED[OBJECT, T_KEY, T_COLON] = ALLOWED[OBJECT, T_COLON, _VALUE] = True
ALLOWED[ARRAY, T_OPEN_A, (*_VALUE, T_CLOSE_A)] = ALLOWED[ARRAY, T_COMMA, _VALUE] = True
for _end in _ENDS:
    ALLOWED[OBJECT, _end, (T_COMMA, T_CLOSE_O)] = ALLOWED[ARRAY, _end, (T_COMMA, T_CLOSE_A)] = True


class StructuralIndex:
    """Bitmaps, depths and marks of many JSON texts laid end to end.

    ``mark_depth`` is the depth in which a mark lies: brackets have that of what surrounds
    them, so a record's outer braces have 0 and the colons of its own members 1.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        n, self.data = len(data), data
        at = np.arange(n)
        slash = data == SLASH
        run_start = np.maximum.accumulate(np.where(slash, -1, at)) if n else at
        escaped = np.zeros(n, dtype=bool)
        escaped[1:] = slash[:-1] & ((at - run_start)[:-1] % 2 == 1)  # an odd number of backslashes before it
        starts, ends = offsets[:-1], offsets[1:]
        escaped[starts[starts < n]] = False
        self.quotes = (data == QUOTE) & ~escaped
        lengths = ends - starts

        def since_start(steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Prefix sums that begin anew with each record, and each record's total."""
            total = np.concatenate(([0], np.cumsum(steps, dtype=np.int64)))
            return total[1:] - np.repeat(total[starts], lengths), total[ends] - total[starts]

        parity, quotes_total = since_start(self.quotes)
        outside = (parity % 2 == 0) & ~self.quotes
        opens = outside & ((data == OPEN_O) | (data == OPEN_A))
        closes = outside & ((data == CLOSE_O) | (data == CLOSE_A))
        level, level_total = since_start(opens.astype(np.int8) - closes.astype(np.int8))
        self.mark_at = np.flatnonzero(opens | closes | (outside & ((data == COMMA) | (data == COLON))))
        self.mark = data[self.mark_at]
        self.mark_depth = (level - opens)[self.mark_at]
        self.mark_open = opens[self.mark_at]
        #: Records whose quotes and brackets close; the others can't be valid.
        self.closed = (quotes_total % 2 == 0) & (level_total == 0)
        self.starts, self.ends, self.outside, self.escaped, self._slash = starts, ends, outside, escaped, slash
        self._opening = self.quotes & (parity % 2 == 1)
        content = ~BLANK[data]
        self._content = np.concatenate(([0], np.cumsum(content)))
        self._content_at = np.append(np.flatnonzero(content), n)
        self._slashes = np.concatenate(([0], np.cumsum(slash, dtype=np.int32)))
        self._sorted: dict[tuple[str, int], np.ndarray] = {}

    def text(self, a: int, b: int) -> bytes:
        return self.data[a:b].tobytes().strip(b" \t\n\r")

    def first_content(self, offsets: np.ndarray) -> np.ndarray:
        """First byte at or after each offset that is no white space (the buffer's length if there is none)."""
        return self._content_at[self._content[offsets]]

    def _marks(self, kind: str, depth: int) -> np.ndarray:
        """Marks of a kind in a depth, in order, with the last mark of all behind them; found once per block."""
        if (kind, depth) not in self._sorted:
            close = ~self.mark_open & ((self.mark == CLOSE_O) | (self.mark == CLOSE_A))
            if kind == "colon":
                found = (self.mark == COLON) & (self.mark_depth == depth)
            elif kind == "comma":
                found = (self.mark == COMMA) & (self.mark_depth == depth)
            elif kind == "close":
                found = close & (self.mark_depth == depth)
            else:
                found = ((self.mark == COMMA) & (self.mark_depth == depth)) | (close & (self.mark_depth == depth - 1))
            self._sorted[kind, depth] = np.append(np.flatnonzero(found), len(self.mark) - 1)
        return self._sorted[kind, depth]

    def value_ends(self, marks: np.ndarray, depth: int) -> np.ndarray:
        """Marks that end the values beginning after ``marks``, all in that depth: a comma, or the bracket around."""
        ends = self._marks("end", depth)
        return ends[np.minimum(np.searchsorted(ends, marks, side="right"), len(ends) - 1)]

    def closing(self, opening: np.ndarray, depth: int) -> np.ndarray:
        """Marks of the brackets closing those that lie in ``depth``."""
        ends = self._marks("close", depth)
        return ends[np.minimum(np.searchsorted(ends, opening, side="right"), len(ends) - 1)]

    def member(self, opening: np.ndarray, depth: int, name: str) -> np.ndarray:
        """For each object (mark of its brace, lying in ``depth``) the colon of the member ``name``, or -1.

        Objects must be in order; entries of -1 stay -1. Of a repeated key the last counts.
        """
        out = np.full(len(opening), -1)
        live = np.flatnonzero(opening >= 0)
        if not len(live):
            return out
        lo, hi = opening[live], self.closing(opening[live], depth)
        colons = self._marks("colon", depth + 1)[:-1]
        owner = np.searchsorted(lo, colons, side="right") - 1
        mine = (owner >= 0) & (colons < hi[owner])
        colons, owner = colons[mine], owner[mine]
        key_end = self._content_at[self._content[self.mark_at[colons]] - 1]  # its closing quote
        token = np.frombuffer(f'"{name}"'.encode(), dtype=np.uint8)
        key_start = key_end - len(token) + 1
        fits = key_start >= 0
        for k, byte in enumerate(token):
            fits &= self.data[np.maximum(key_start + k, 0)] == byte
        fits &= self.quotes[np.maximum(key_start, 0)]
        before = self.mark_at[np.maximum(colons - 1, 0)] + 1
        escaped = (colons > 0) & (self._slashes[key_end] > self._slashes[np.minimum(before, key_end)])
        for k in np.flatnonzero(~fits & escaped):  # keys spelled with escapes
            a = int(before[k])
            key = self.text(a, int(key_end[k]) + 1)
            fits[k] = b"\\u" in key and strict(key) == name
        out[live[owner[fits]]] = colons[fits]
        return out

    def first_mark(self, records: np.ndarray) -> np.ndarray:
        """The brace of each record that is an object, -1 for others."""
        at = self.first_content(self.starts[records])
        fits = at < self.ends[records]
        fits[fits] = self.data[at[fits]] == OPEN_O
        return np.where(fits, np.searchsorted(self.mark_at, at), -1)

    def valid(self) -> np.ndarray:
        """Which records are JSON texts, of whatever depth."""
        data, n, records = self.data, len(self.data), len(self.starts)
        good = self.closed & (self.ends > self.starts)
        owner = lambda at: np.searchsorted(self.starts, at, side="right") - 1

        def bad(at: np.ndarray) -> None:
            good[owner(at)] = False

        inside = ~self.outside & ~self.quotes
        bad(np.flatnonzero(inside & (data < 0x20)))
        slash = np.flatnonzero(self._slash & inside & ~self.escaped)
        after = data[np.minimum(slash + 1, n - 1)]
        bad(slash[~ESCAPED[after]])
        unicode = slash[after == ord("u")]
        digits = np.minimum(unicode[:, None] + np.arange(2, 6), n - 1)
        fits = HEX[data[digits]].all(axis=1) & ~self.quotes[digits].any(axis=1)
        bad(unicode[~fits])
        # tokens: marks, strings at their opening quotes, literals at their first byte
        literal = self.outside & ~BLANK[data]
        literal[self.mark_at] = False
        fresh = np.zeros(n + 1, dtype=bool)
        fresh[self.starts], fresh[n] = True, True
        begin = np.flatnonzero(literal & (fresh[:-1] | ~np.append(False, literal[:-1])))
        end = np.flatnonzero(literal & (fresh[1:] | ~np.append(literal[1:], False))) + 1
        texts = [data[x:y].tobytes() for x, y in zip(begin.tolist(), end.tolist())]
        known = {t: LITERAL.fullmatch(t) is not None for t in set(texts)}
        bad(begin[~np.fromiter((known[t] for t in texts), dtype=bool, count=len(texts))])
        strings = np.flatnonzero(self._opening)
        at = np.concatenate((self.mark_at, strings, begin))
        kind = np.concatenate((_TOKEN[self.mark], np.full(len(strings), T_STRING, dtype=np.int8), np.full(len(begin), T_LITERAL, dtype=np.int8)))
        order = np.argsort(at, kind="stable")
        record, kind = owner(at[order]), kind[order]
        empty = np.ones(records, dtype=bool)
        empty[record] = False
        good &= ~empty
        kind, record = kind[good[record]], record[good[record]]
        if not len(kind):
            return good
        opens, closes = (kind == T_OPEN_O) | (kind == T_OPEN_A), (kind == T_CLOSE_O) | (kind == T_CLOSE_A)
        level = np.cumsum(opens.astype(np.int64) - closes)  # the records left are closed, so each begins and ends at 0
        good[record[level < 0]] = False
        # the container after a token is the bracket last opened to its level: bring tokens of a level together
        by = np.argsort(level, kind="stable")
        last = np.maximum.accumulate(np.where(opens[by], np.arange(len(by)), 0))
        holder = np.empty_like(by)
        holder[by] = by[last]
        around = np.where(level <= 0, ROOT, np.where(kind[holder] == T_OPEN_O, OBJECT, ARRAY))
        first = np.append(True, record[1:] != record[:-1])
        container = np.where(first, ROOT, np.append(ROOT, around[:-1]))
        before = np.where(first, T_START, np.append(T_START, kind[:-1]))
        kind = np.where((kind == T_STRING) & (container == OBJECT) & ((before == T_OPEN_O) | (before == T_COMMA)), T_KEY, kind)
        before = np.where(first, T_START, np.append(T_START, kind[:-1]))
        good[record[~ALLOWED[container, before, kind]]] = False
        return good


def strict(text: bytes):
    """The value of a short JSON text, or None; NaN and Infinity are not JSON."""
    if text[:1] == b'"' and b"\\" not in text and text.count(b'"') == 2 and text[-1:] == b'"':
        return text[1:-1].decode()
    try:
        return json.loads(text) if LITERAL.fullmatch(text) or text[:1] in b'"[{' else None
    except (ValueError, RecursionError):
        return None


@dataclass
class Values:
    """Values of a path in a block: each lies between two marks at a depth and belongs to a record.

    ``start`` is the mark before the value (a colon, comma or bracket) and ``end`` the one
    after it; ``places`` has the positions in the lists passed, ``key`` the last member
    name passed by ``{}``, as the mark of its colon, or -1.
    """

    record: np.ndarray
    start: np.ndarray
    end: np.ndarray
    depth: int
    places: list[np.ndarray]
    key: np.ndarray

    def take(self, at: np.ndarray) -> Values:
        return Values(self.record[at], self.start[at], self.end[at], self.depth, [p[at] for p in self.places], self.key[at])


STEP = re.compile(r"[^.\[\]{}]+|\[\]|\{\}")


def _inside(index: StructuralIndex, holders: Values, opening: np.ndarray, name: str) -> Values:
    """One step of a path into the brackets ``opening``, in order, that are the given values."""
    depth = holders.depth
    if name not in ("[]", "{}"):
        colons = index.member(opening, depth, name)
        found = np.flatnonzero(colons >= 0)
        out, colons = holders.take(found), colons[found]
        return Values(out.record, colons, index.value_ends(colons, depth + 1), depth + 1, out.places, out.key)
    closing = index.closing(opening, depth)
    filled = np.flatnonzero(index.first_content(index.mark_at[opening] + 1) != index.mark_at[closing])
    holders, opening, closing = holders.take(filled), opening[filled], closing[filled]
    commas = index._marks("comma", depth + 1)[:-1]
    low, high = np.searchsorted(commas, opening), np.searchsorted(commas, closing)
    counts = high - low + 1
    owner = np.repeat(np.arange(len(opening)), counts)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    padded = np.append(commas, 0)
    start = np.where(place == 0, opening[owner], padded[np.maximum(low[owner] + place - 1, 0)])
    end = np.where(place == counts[owner] - 1, closing[owner], padded[np.minimum(low[owner] + place, len(commas))])
    out = holders.take(owner)
    if name == "{}":  # the colon comes next, as a key has no mark
        return Values(out.record, start + 1, end, depth + 1, [*out.places, place], start + 1)
    return Values(out.record, start, end, depth + 1, [*out.places, place], out.key)


def values_at(index: StructuralIndex, usable: np.ndarray, path: str) -> Values:
    """The values of a path such as ``time.unpublished.versions[].version`` in the usable records (objects) of a block."""
    none = np.zeros(0, dtype=np.int64)
    record = np.flatnonzero(usable)
    values = Values(record, none, none, 0, [], np.full(len(record), -1))
    opening = index.first_mark(record) if len(record) else none
    for n, name in enumerate(STEP.findall(path)):
        if n == 0:  # the outer braces
            values.start = values.end = opening
            fits = np.full(len(record), name != "[]")
        elif len(values.start):
            opening = np.minimum(values.start + 1, len(index.mark) - 1)
            fits = (index.mark[opening] == (OPEN_A if name == "[]" else OPEN_O)) & (index.first_content(index.mark_at[values.start] + 1) == index.mark_at[opening])
        if not len(values.start):
            return Values(none, none, none, values.depth, [none] * (len(values.places) + sum(x in ("[]", "{}") for x in STEP.findall(path)[n:])), none)
        values = _inside(index, values.take(np.flatnonzero(fits)), opening[fits], name)
    return values


def texts_of(index: StructuralIndex, values: Values) -> list[bytes]:
    at = index.mark_at
    return [index.text(a, b) for a, b in zip((at[values.start] + 1).tolist(), at[values.end].tolist())] if len(values.start) else []


def key_of(index: StructuralIndex, colon: int) -> str | None:
    """The member name before a colon."""
    before = int(index.mark_at[colon - 1]) + 1
    return strict(index.text(before, int(index.mark_at[colon])))


OUT = pa.schema([("rec_id", pa.int64()), ("usable", pa.bool_()), ("name", pa.string()), ("by_name", pa.string()), ("n_versions", pa.int32()), ("ordinal", pa.int32()), ("version", pa.string())])


LISTED = "time.unpublished.versions"


def _block_rows(data: np.ndarray, offsets: np.ndarray, ids: list) -> list[tuple]:
    index = StructuralIndex(data, offsets)
    rows = len(offsets) - 1
    good = index.valid()
    usable = good & (index.first_mark(np.arange(rows)) >= 0)

    def strings(path: str) -> Iterator[tuple[int, tuple[int, ...], str]]:
        """(record, positions, string) of the strings at a path."""
        found = values_at(index, usable, path)
        places = list(zip(*(p.tolist() for p in found.places))) if found.places else [()] * len(found.record)
        for record, place, text in zip(found.record.tolist(), places, texts_of(index, found)):
            if text[:1] == b'"' and isinstance(value := strict(text), str):
                yield record, place, value

    name, by = ({r: v for r, _, v in strings(path)} for path in ("name", "time.unpublished.name"))
    listed: dict[int, list[tuple[tuple[int, ...], str]]] = {}
    for path in (LISTED, f"{LISTED}[]", f"{LISTED}[].version"):
        for record, place, value in strings(path):
            listed.setdefault(record, []).append((place, value))
    keyed = values_at(index, usable, f"{LISTED}{{}}")
    for record, place, colon in zip(keyed.record.tolist(), keyed.places[0].tolist() if keyed.places else [], keyed.key.tolist()):
        listed.setdefault(record, []).append(((place,), key_of(index, colon)))
    out = []
    for k in range(rows):
        versions = list(dict.fromkeys(v for _, v in sorted(listed.get(k, ())) if v))
        head = (ids[k], bool(usable[k]), name.get(k), by.get(k) or "", len(versions))
        out.append((*head, None, None))
        out.extend((*head, n, v) for n, v in enumerate(versions))
    return out


def _flatten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8_buffer(batch.column(1))
        ids = batch.column(0).to_pylist()
        for a, b in blocks(offsets, BLOCK):
            rows = _block_rows(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], ids[a:b])
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), OUT)], schema=OUT)


def _texts(documents: DataFrame, rec_id: str, raw: str) -> DataFrame:
    return spread(documents.select(F.col(rec_id).cast("long").alias("rec_id"), F.col(raw).alias("raw")))


def flatten_documents(documents: DataFrame, rec_id: str = "rec_id", raw: str = "raw") -> DataFrame:
    """One row per distinct document (version null) and one per version it lists as unpublished, linked by rec_id.

    Columns: rec_id, usable (raw is a valid JSON object), name, by_name ('' if there is none),
    n_versions, ordinal (from 0, in the order listed), version. Null, empty, cut-off and
    non-object texts give one row with usable false; nesting may be of any depth; repeated
    rows collapse; further columns are ignored.
    """
    schema = "rec_id long, usable boolean, name string, by_name string, n_versions int, ordinal int, version string"
    return _texts(documents, rec_id, raw).mapInArrow(_flatten, schema).distinct()


def unpublished_versions(documents: DataFrame) -> DataFrame:
    """(rec_id, ordinal, version, by_name): the child table."""
    return flatten_documents(documents).where("version is not null").select("rec_id", "ordinal", "version", "by_name")


def document_rows(documents: DataFrame) -> DataFrame:
    """(rec_id, usable, name, by_name, n_versions): the parent table."""
    return flatten_documents(documents).where("version is null").drop("version", "ordinal")


def linked_tables(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parent and child table from one pass, which is stored in the shared folder."""
    rows = persist_table(flatten_documents(documents), "flattened")
    return rows.where("version is null").drop("version", "ordinal"), rows.where("version is not null").select("rec_id", "ordinal", "version", "by_name")


FLAT = pa.schema([("rec_id", pa.int64()), ("path", pa.string()), ("position", pa.string()), ("key", pa.string()), ("value", pa.string())])


def flatten_paths(documents: DataFrame, paths: Sequence[str], rec_id: str = "rec_id", raw: str = "raw") -> DataFrame:
    """(rec_id, path, position, key, value) of every value at the given paths, all from one index of each text.

    A path has member names, ``[]`` for the elements of a list and ``{}`` for the members
    of an object, as in ``versions{}.dist.shasum``. ``position`` joins the positions in
    the lists and objects passed (from 0) with dots and links children of one parent;
    ``key`` is the last member name passed by ``{}``. ``value`` is a string's text, another
    value's JSON text, or null for null. Unusable texts have no rows; repeated rows
    collapse; of a repeated member the last counts, except that ``{}`` has them all.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8_buffer(batch.column(1))
            ids = batch.column(0).to_pylist()
            for a, b in blocks(offsets, BLOCK):
                index = StructuralIndex(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                usable = index.valid() & (index.first_mark(np.arange(b - a)) >= 0)
                for path in paths:
                    found = values_at(index, usable, path)
                    texts = texts_of(index, found)
                    position = [".".join(map(str, p)) for p in zip(*(p.tolist() for p in found.places))] if found.places else [""] * len(texts)
                    keys = [key_of(index, c) if c >= 0 else None for c in found.key.tolist()]
                    values = [strict(t) if t[:1] == b'"' else None if t == b"null" else t.decode() for t in texts]
                    columns = ([ids[a + r] for r in found.record.tolist()], [path] * len(texts), position, keys, values)
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, FLAT)], schema=FLAT)

    return _texts(documents, rec_id, raw).mapInArrow(run, "rec_id long, path string, position string, key string, value string").distinct()
