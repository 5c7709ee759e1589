"""Personal information in free text and in JSON records: found, and replaced by typed placeholders.

The model is a semi-Markov conditional random field (``pii_model``), trained on the driver
from a fixed number of generated sentences (``SAMPLES``); its few hundred weights are
broadcast. The texts of an Arrow batch are laid out in pages, whose candidates are scored
together; nothing is shuffled but the found items, and those only to make them distinct.
"""

from __future__ import annotations

import bisect
import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registry_lens.llm.pii_model import KINDS, Page, SemiCRF, propose
from registry_lens.llm.pii_samples import samples
from registry_lens.session import spread

#: Sentences the model is trained on, and how often it sees them.
SAMPLES, ROUNDS = 6000, 10
#: Characters of a page; a longer text has a page of its own.
PAGE = 400_000
PLACEHOLDERS = {"email": "[EMAIL]", "phone": "[PHONE]", "id_number": "[ID_NUMBER]", "address": "[ADDRESS]", "name": "[NAME]"}
STRING = re.compile(r'"([^"\\]*(?:\\.[^"\\]*)*)"(\s*:)?', re.DOTALL)
ESCAPE = re.compile(r"\\u[dD][89abAB][0-9a-fA-F]{2}\\u[dD][c-fC-F][0-9a-fA-F]{2}|\\u[0-9a-fA-F]{4}|\\.", re.DOTALL)
#: Keys whose values are names or contacts as a whole (see ``Page``); all other values are prose.
FIELDS = {k: 1 for k in ("name", "author", "maintainer", "owner", "reporter", "full_name", "fullName")} | {k: 2 for k in ("contact", "contacts", "email", "mail", "phone", "tel")}
#: What a text must have for any gate to propose something: an at sign, written out, percent-encoded or not, an upper-case letter, or five digits.
WORTH_A_LOOK = re.compile(r"@|%40|\b(?:at|AT)\b|[^\W\d_a-z]|(?:\d\D*){5}", re.UNICODE)
#: Longest text whose items a worker remembers; short ones recur (versions, ecosystems, names of organisations).
SHORT = 80
#: Short texts a worker remembers before it starts anew.
REMEMBERED = 100_000

Items = list[tuple[int, int, str]]


@lru_cache(maxsize=2)
def trained(count: int = SAMPLES, rounds: int = ROUNDS) -> SemiCRF:
    """The model; training takes some seconds and is done once per process."""
    model = SemiCRF()
    model.train(samples(count), rounds=rounds)
    return model


def find_in_texts(model: SemiCRF, texts: list[str], fields: list[int]) -> list[Items]:
    """(start, end, kind) of the personal items of each text, in order and without overlap.

    An address of a role, a service or a code host can be told from the address itself, so
    the model sees it as a segment of its own and rejects it. Equal texts are read once.
    """
    memory = model.__dict__.setdefault("memory", {})
    if len(memory) > REMEMBERED:
        memory.clear()
    known: dict[tuple[str, int], Items] = {}
    fresh: list[tuple[str, int]] = []
    for key in zip(texts, fields):
        if key not in known:
            if key in memory:
                known[key] = memory[key]
            else:
                known[key] = []
                if WORTH_A_LOOK.search(key[0]):
                    fresh.append(key)
                elif len(key[0]) <= SHORT:
                    memory[key] = known[key]
    at = 0
    while at < len(fresh):
        stop, size = at, 0
        while stop < len(fresh) and (stop == at or size + len(fresh[stop][0]) <= PAGE):
            size += len(fresh[stop][0])
            stop += 1
        part = fresh[at:stop]
        page = Page([t for t, _ in part], [f for _, f in part])
        found = model.best(propose(page))
        owner = (np.searchsorted(page.begins, [a for a, _, _ in found], side="right") - 1).tolist()
        for (a, b, kind), k in zip(found, owner):
            begin = int(page.begins[k])
            known[part[k]].append((a - begin, b - begin, KINDS[kind]))
        for key in part:
            if len(key[0]) <= SHORT:
                memory[key] = known[key]
        at = stop
    return [known[key] for key in zip(texts, fields)]


def find_in_text(model: SemiCRF, text: str, field: int = 0) -> Items:
    """The items of one text."""
    return find_in_texts(model, [text], [field])[0]


def escape_map(body: str) -> Callable[[int], int]:
    """The function from offsets in a JSON string's text to those in its body as it is written."""
    size = at = 0
    decoded, raw = [0], [0]  # where a stretch without escapes begins, in both
    for e in ESCAPE.finditer(body):
        size += e.start() - at
        char = 1  # an escape is one character, also a pair of surrogates
        decoded += [size, size + char]
        raw += [e.start(), e.end()]
        size, at = size + char, e.end()

    def back(offset: int) -> int:
        k = bisect.bisect_right(decoded, offset) - 1
        return raw[k] + offset - decoded[k]

    return back


def json_strings(raw: str) -> list[tuple[str, int, int, str | None]]:
    """The string values of a JSON text: (text, field, where it begins in ``raw``, its body if that has escapes).

    A text that is no JSON is one value, read as plain text.
    """
    try:
        json.loads(raw)
    except (ValueError, RecursionError):
        return [(raw, 0, 0, None)]
    out, field = [], 0
    for m in STRING.finditer(raw):
        body = m[1]
        if m.lastindex == 2:  # a key names the field of what follows
            field = FIELDS.get(body, 0)
        elif "\\" in body:
            out.append((json.loads(f'"{body}"', strict=False), field, m.start(1), body))
        elif body:
            out.append((body, field, m.start(1), None))
    return out


def find_in_values(model: SemiCRF, values: list[str | None], as_json: bool) -> list[Items]:
    """The items of each value, as offsets into it as it is written; null and empty values have none."""
    strings: list[tuple[str, int, int, str | None]] = []
    owner: list[int] = []
    for k, value in enumerate(values):
        if value:
            found = json_strings(value) if as_json else [(value, 0, 0, None)]
            strings += found
            owner += [k] * len(found)
    out: list[Items] = [[] for _ in values]
    for k, (_, _, base, body), items in zip(owner, strings, find_in_texts(model, [x[0] for x in strings], [x[1] for x in strings])):
        if items:
            back = escape_map(body) if body is not None else int
            out[k] += [(base + back(a), base + back(b), kind) for a, b, kind in items]
    return out


def find_in_json(model: SemiCRF, raw: str) -> Items:
    """The items of one JSON text."""
    return find_in_values(model, [raw], True)[0]


def replace(text: str, items: Items) -> str:
    """The text with each item replaced; all else stays as it is."""
    parts, at = [], 0
    for a, b, kind in items:
        parts += [text[at:a], PLACEHOLDERS[kind]]
        at = b
    return "".join([*parts, text[at:]])


FOUND = pa.schema([("id", pa.string()), ("field", pa.string()), ("kind", pa.string()), ("value", pa.string())])


def _broadcast(df: DataFrame):
    return df.sparkSession.sparkContext.broadcast(trained().weights)


_MODELS: dict[int, SemiCRF] = {}


def _worker_model(shared) -> SemiCRF:
    key = id(shared.value)
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = SemiCRF(shared.value)
    return _MODELS[key]


def find_personal(records: DataFrame, key: str = "id", plain: tuple[str, ...] = ("summary",), structured: tuple[str, ...] = ("raw",)) -> DataFrame:
    """(id, field, kind, value): each distinct personal item of the given columns, as the column writes it.

    ``structured`` columns hold JSON and keep their escapes; a text there that is no JSON is
    read as plain text. Null and empty values have no items; repeated rows collapse; other
    columns are ignored.
    """
    shared = _broadcast(records)
    fields = [(c, False) for c in plain] + [(c, True) for c in structured]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _worker_model(shared)
        for batch in batches:
            rows = set()
            ids = batch.column(0).to_pylist()
            for n, (name, as_json) in enumerate(fields):
                values = batch.column(n + 1).to_pylist()
                for k, value, items in zip(ids, values, find_in_values(model, values, as_json)):
                    rows.update((k, name, kind, value[a:b]) for a, b, kind in items)
            columns = list(zip(*sorted(rows, key=str))) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.string()) for c in columns], schema=FOUND)

    picked = spread(records.select(F.col(key).cast("string").alias("id"), *(F.col(c) for c, _ in fields)))
    return picked.mapInArrow(run, "id string, field string, kind string, value string").distinct()


def redact(records: DataFrame, key: str = "id", plain: tuple[str, ...] = ("summary",), structured: tuple[str, ...] = ("raw",)) -> DataFrame:
    """Key and columns with every personal item replaced; one row per row, nulls stay null, JSON stays JSON."""
    shared = _broadcast(records)
    fields = [(c, False) for c in plain] + [(c, True) for c in structured]
    schema = pa.schema([(key, pa.string()), *((c, pa.string()) for c, _ in fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _worker_model(shared)
        for batch in batches:
            out = [batch.column(0)]
            for n, (_, as_json) in enumerate(fields):
                values = batch.column(n + 1).to_pylist()
                items = find_in_values(model, values, as_json)
                out.append(pa.array([v if v is None else replace(v, x) for v, x in zip(values, items)], type=pa.string()))
            yield pa.RecordBatch.from_arrays(out, schema=schema)

    picked = spread(records.select(F.col(key).cast("string").alias(key), *(F.col(c) for c, _ in fields)))
    return picked.mapInArrow(run, ", ".join(f"`{f.name}` string" for f in schema))
