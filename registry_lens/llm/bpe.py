"""Encoding of a whole corpus with a public byte-level BPE vocabulary, in numpy.

Splitting and merging both work on flat arrays of many texts. The split into words follows
the published pattern by comparing the character classes of neighbours, with no regular
expression in the loop. The distinct words of a block are found by a 64-bit hash, checked
byte by byte, and those not met before are merged in rounds: the symbols of all words lie
in one array, the rank of a pair is found by binary search over sorted pair keys, each word
merges its lowest pair in a round, and finished words leave. The vocabulary
is a fixed file, so what is broadcast has a fixed size.
"""

from __future__ import annotations

import base64
import importlib.util
import os
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry_lens.functions.arrow_text import blocks, utf8_buffer
from registry_lens.session import spread

#: Bytes of text worked on at a time.
BLOCK = 2 << 20
#: Words a worker remembers before it starts anew; bounds its memory.
REMEMBERED = 250_000
#: Bytes of a stretch of a word (see ``merge_words``), and places after which the weights of the word hash repeat.
STRETCH, PERIOD = 1024, 4096
NO_RANK = np.int32(2**31 - 1)
OTHER, LETTER, NUMBER, SPACE = range(4)
#: Characters with the Unicode property White_Space.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@dataclass(frozen=True)
class Vocabulary:
    """Ranks of single bytes, and the sorted keys of all pairs of tokens whose join is a token."""

    byte_ids: np.ndarray
    pair_keys: np.ndarray
    pair_ranks: np.ndarray
    token_bytes: np.ndarray  # length in bytes by id


def tokenizer_folder() -> str:
    """Where the vocabulary files lie: LENS_TOKENIZERS, the installed package, or /opt/tokenizers."""
    if folder := os.environ.get("LENS_TOKENIZERS"):
        return folder
    spec = importlib.util.find_spec("public_tokenizers")
    return os.path.dirname(spec.origin) if spec and spec.origin else "/opt/tokenizers"


def load_vocabulary(path: str) -> Vocabulary:
    """Read a rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    pairs = {}
    for token, rank in ranks.items():
        for k in range(1, len(token)):
            left, right = ranks.get(token[:k]), ranks.get(token[k:])
            if left is not None and right is not None:
                pairs[left << 32 | right] = rank
    keys = np.fromiter(pairs, dtype=np.int64, count=len(pairs))
    values = np.fromiter(pairs.values(), dtype=np.int32, count=len(pairs))
    order = np.argsort(keys)
    lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int32)
    for token, rank in ranks.items():
        lengths[rank] = len(token)
    return Vocabulary(np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32), keys[order], values[order], lengths)


def character_classes() -> np.ndarray:
    """Class of every code point: letter (L), number (N), white space, other."""
    first = np.array([ord(unicodedata.category(chr(c))[0]) for c in range(0x110000)], dtype=np.uint8)
    table = np.zeros(0x110000, dtype=np.uint8)
    table[first == ord("L")] = LETTER
    table[first == ord("N")] = NUMBER
    table[WHITE_SPACE] = SPACE
    return table


def word_starts(chars: np.ndarray, doc_starts: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Mask of the characters at which a word of the published pattern begins.

    ``chars`` are the code points of all texts, ``doc_starts`` the mask of their first ones.
    """
    n = len(chars)
    cls = classes[chars]
    start = doc_starts.copy()
    start[1:] |= cls[1:] != cls[:-1]
    # white space before something else in the same text: its last character stands alone, or joins what follows if it is a blank
    before = np.flatnonzero((cls[:-1] == SPACE) & (cls[1:] != SPACE) & ~doc_starts[1:])
    start[before] = True
    start[before[chars[before] == 0x20] + 1] = False
    # contractions, where the apostrophe begins a word
    quote = np.flatnonzero((chars == 0x27) & start)
    if len(quote):
        padded = np.concatenate((chars, np.zeros(3, dtype=chars.dtype)))
        fresh = np.concatenate((doc_starts, np.ones(3, dtype=bool)))
        a, b = padded[quote + 1], padded[quote + 2]
        here, both = ~fresh[quote + 1], ~fresh[quote + 1] & ~fresh[quote + 2]
        one = here & np.isin(a, [ord(x) for x in "stmd"])
        two = both & (((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l"))))
        for mask, length in ((one, 2), (two, 3)):
            at = quote[mask]
            start[at + 1] = False
            after = at + length
            start[after[after < n]] = True
    return start


class Encoder:
    """Encodes byte buffers of many texts; remembers the words it has merged."""

    def __init__(self, vocabulary: Vocabulary):
        self.v, self.classes = vocabulary, character_classes()
        rng = np.random.default_rng(20260302)
        self.weights = rng.integers(1, 2**63, size=PERIOD, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.flat, self.used = np.zeros(1 << 16, dtype=np.int32), 0
        self.at, self.size = np.zeros(1 << 14, dtype=np.int64), np.zeros(1 << 14, dtype=np.int64)

    # merging

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of symbols, by binary search over the sorted pair keys."""
        keys = left.astype(np.int64) << 32 | right
        place = np.minimum(np.searchsorted(self.v.pair_keys, keys), len(self.v.pair_keys) - 1)
        return np.where(self.v.pair_keys[place] == keys, self.v.pair_ranks[place], NO_RANK)

    def merge_words(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words end to end, how many each word has), by merge rounds over all of them together.

        Symbols lie at their first byte's place, linked to their neighbours. A word is cut
        into stretches, each with the least rank of its pairs. A round merges each word's
        lowest pair: only stretches that have it are looked at, and only pairs beside a
        merged one are ranked again, so a long word costs no more than what changes in it.
        """
        word = np.repeat(np.arange(len(starts)), lengths)
        n = len(word)
        if not n:
            return np.zeros(0, dtype=np.int32), np.zeros(len(starts), dtype=np.int64)
        first = np.cumsum(lengths) - lengths
        at = np.arange(n) - first[word]
        symbols = self.v.byte_ids[data[starts[word] + at]]
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        ends, begins = (first + lengths - 1)[lengths > 0], first[lengths > 0]
        after[ends], before[begins] = n, n  # n is no place: the end of a word
        rank = np.full(n + 1, NO_RANK, dtype=np.int32)
        paired = np.flatnonzero(after[:n] < n)
        rank[paired] = self._rank(symbols[paired], symbols[paired + 1])
        cut = np.flatnonzero(at % STRETCH == 0)
        of = np.cumsum(at % STRETCH == 0) - 1
        size, owner = np.diff(np.append(cut, n)), word[cut]
        least = np.minimum.reduceat(rank[:n], cut)

        def places(stretches: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            sizes = size[stretches]
            heads = np.cumsum(sizes) - sizes
            return np.repeat(cut[stretches] - heads, sizes) + np.arange(int(sizes.sum())), heads

        live = np.arange(len(cut))
        while True:
            heads = np.flatnonzero(np.append(True, owner[live][1:] != owner[live][:-1]))
            mine = least[live]
            lowest = np.repeat(np.minimum.reduceat(mine, heads), np.diff(np.append(heads, len(live))))
            going = lowest != NO_RANK
            if not going.all():  # finished words leave
                live, mine, lowest = live[going], mine[going], lowest[going]
                if not len(live):
                    break
            active, wanted = live[mine == lowest], lowest[mine == lowest]
            where, _ = places(active)
            left = where[rank[where] == np.repeat(wanted, size[active])]
            # of overlapping pairs every second one, from the left
            count = np.arange(len(left))
            run = np.maximum.accumulate(np.where(np.append(True, after[left[:-1]] != left[1:]), count, 0))
            left = left[(count - run) % 2 == 0]
            right = after[left]
            beyond = after[right]
            symbols[left] = rank[left]
            symbols[right] = -1
            after[left], before[beyond] = beyond, left
            rank[right] = NO_RANK
            previous = before[left]
            again = np.concatenate((left, previous[previous < n]))
            following = after[again]
            rank[again] = np.where(following < n, self._rank(symbols[again], symbols[np.minimum(following, n - 1)]), NO_RANK)
            touched = np.unique(of[np.concatenate((again, right))])
            where, heads = places(touched)
            least[touched] = np.minimum.reduceat(rank[where], heads)
        kept = symbols >= 0
        return symbols[kept], np.bincount(word[kept], minlength=len(starts))

    # words

    def _learn(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Numbers of the given distinct words, merging those that are new."""
        raw = data.tobytes()
        words = [raw[a:b] for a, b in zip(starts.tolist(), (starts + lengths).tolist())]
        number = np.fromiter((self.known.get(w, -1) for w in words), dtype=np.int64, count=len(words))
        fresh = np.flatnonzero(number < 0)
        if len(fresh):
            merged, sizes = self.merge_words(data, starts[fresh], lengths[fresh])
            base = len(self.known)
            need = base + len(fresh)
            if need > len(self.at):
                self.at, self.size = np.resize(self.at, 2 * need), np.resize(self.size, 2 * need)
            total = int(sizes.sum())
            if self.used + total > len(self.flat):
                self.flat = np.resize(self.flat, 2 * (self.used + total))
            self.flat[self.used : self.used + total] = merged
            self.at[base:need] = self.used + np.cumsum(sizes) - sizes
            self.size[base:need] = sizes
            self.used += total
            number[fresh] = np.arange(base, need)
            self.known.update((words[k], base + j) for j, k in enumerate(fresh.tolist()))
        return number

    def _block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > REMEMBERED:
            self._forget()
        chars = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
        if len(chars) == len(data):  # all ASCII
            char_at = offsets
        else:
            lead = np.cumsum((data & 0xC0) != 0x80)
            char_at = np.append(0, lead)[offsets]
        docs = np.zeros(len(chars), dtype=bool)
        filled = char_at[:-1][char_at[:-1] < char_at[1:]]
        docs[filled] = True
        begins = np.flatnonzero(word_starts(chars, docs, self.classes))
        starts = begins if len(chars) == len(data) else np.flatnonzero((data & 0xC0) != 0x80)[begins]
        lengths = np.diff(np.append(starts, len(data)))
        place = np.arange(len(data)) - np.repeat(starts, lengths)
        hashes = np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * self.weights[place % PERIOD], starts)
        _, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        same = (lengths == lengths[first][inverse]).all() and np.array_equal(data, data[place + np.repeat(starts[first][inverse], lengths)])
        if not same:  # a collision of the hash: every word counts as distinct
            first = inverse = np.arange(len(starts))
        number = self._learn(data, starts[first], lengths[first])[inverse]
        sizes = self.size[number]
        ends = np.cumsum(sizes)
        ids = self.flat[np.arange(int(ends[-1])) + np.repeat(self.at[number] - (ends - sizes), sizes)]
        return ids, np.append(0, ends)[np.searchsorted(starts, offsets)]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, offsets of each text's ids)."""
        parts, counts = [], [np.zeros(1, dtype=np.int64)]
        done = 0
        for a, b in blocks(offsets, BLOCK):
            part = data[offsets[a] : offsets[b]]
            local = offsets[a : b + 1] - offsets[a]
            if len(part):
                ids, at = self._block(part, local)
            else:
                ids, at = np.zeros(0, dtype=np.int32), np.zeros(b - a + 1, dtype=np.int64)
            parts.append(ids)
            counts.append(at[1:] + done)
            done += len(ids)
        return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int32), np.concatenate(counts)


_ENCODERS: dict[int, Encoder] = {}


def worker_encoder(shared) -> Encoder:
    """The worker's encoder for a broadcast vocabulary; made once per worker."""
    key = id(shared.value)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(shared.value)
    return _ENCODERS[key]


def broadcast_vocabulary(spark: SparkSession, tokenizer: str = "byte_bpe_50k", folder: str | None = None):
    """Broadcast a vocabulary file; some 250,000 pairs, whatever the corpus."""
    return spark.sparkContext.broadcast(load_vocabulary(os.path.join(folder or tokenizer_folder(), f"{tokenizer}.tiktoken")))


def map_encoded(documents: DataFrame, fields: list[str], schema: str, shared, make: Callable) -> DataFrame:
    """mapInArrow over ``fields`` (the last one is the text); ``make(encoder, batch, data, offsets, ids, at)`` yields record batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(shared)
        for batch in batches:
            data, offsets = utf8_buffer(batch.column(batch.num_columns - 1))
            ids, at = encoder.encode(data, offsets)
            yield from make(encoder, batch, data, offsets, ids, at)

    return spread(documents.select(*fields)).mapInArrow(run, schema)


def _ids_batch(encoder, batch, data, offsets, ids, at):
    if at[-1] > 2**31 - 1:
        raise ValueError("an Arrow batch may hold 2^31 ids; lower spark.sql.execution.arrow.maxRecordsPerBatch")
    lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids, type=pa.int32()))
    yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["doc_id", "ids"])


def encode_documents(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str = "byte_bpe_50k", folder: str | None = None) -> DataFrame:
    """(doc_id, ids) of every row, without special tokens; a map over the rows, nothing is gathered.

    Null and empty texts have an empty list. Repeated rows stay repeated; further columns
    are ignored. Strings of special tokens in a text are ordinary text.
    """
    shared = broadcast_vocabulary(documents.sparkSession, tokenizer, folder)
    # bytes that are no UTF-8 become U+FFFD before they are encoded
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.make_valid_utf8(F.col(text)).alias("text"))
    return map_encoded(rows, ["doc_id", "text"], "doc_id long, ids array<int>", shared, _ids_batch)


def _count_batch(encoder, batch, data, offsets, ids, at):
    yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(at).astype(np.int64))], names=["doc_id", "tokens"])


def count_tokens(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str = "byte_bpe_50k", folder: str | None = None) -> DataFrame:
    """(doc_id, tokens) of every row."""
    shared = broadcast_vocabulary(documents.sparkSession, tokenizer, folder)
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.make_valid_utf8(F.col(text)).alias("text"))
    return map_encoded(rows, ["doc_id", "text"], "doc_id long, tokens long", shared, _count_batch)
