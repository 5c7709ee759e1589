"""Splitting oversized texts at natural boundaries, by dynamic programming over boundary positions.

Every token boundary of a text has a penalty that tells how natural a cut would be there.
The program chooses, among all sequences of cuts whose pieces respect the size limit with
the overlap included, the one with the least sum of cut penalties and of squared unused
shares of the limit; being convex, the latter also evens out the sizes. It looks at every
token boundary: as pieces are bounded, each has at most ``limit - overlap`` predecessors,
and their distances are the same for all, so one step is a sum with a fixed vector.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registry_lens.llm.bpe import broadcast_vocabulary, map_encoded

#: Penalties of a cut, from the most to the least natural place.
PARAGRAPH, LINE, SENTENCE, CLAUSE, WORD, INSIDE, IN_CHARACTER = 0.0, 0.2, 0.4, 1.2, 1.6, 4.0, 9.0
#: Weight of the squared unused share of a piece.
BALANCE = 2.0
#: Texts solved side by side; their windows fit into a core's cache.
SIDE = 64


def _flags(chars: bytes) -> np.ndarray:
    return np.isin(np.arange(256), list(chars))


BLANK, STOP, CLOSER, COMMA = _flags(b" \n\t\r"), _flags(b".!?"), _flags(b"\")'"), _flags(b",;:")


def cut_penalties(data: np.ndarray, ends: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Penalty of a cut at each byte offset of ``ends``; the text it lies in is data[first:last]."""

    padded = np.concatenate((np.zeros(3, dtype=np.uint8), data, np.zeros(2, dtype=np.uint8)))
    third, second, before, after, later = (padded[ends + k] for k in range(5))  # bytes -3 to +1
    second[ends - first < 2] = 0
    third[ends - first < 3] = 0
    after[last <= ends] = 0
    later[last - ends < 2] = 0
    stop = STOP[before] | (CLOSER[before] & STOP[second])
    wide_stop = ((third == 0xE3) & (second == 0x80) & (before == 0x82)) | ((third == 0xEF) & (second == 0xBC) & ((before == 0x81) | (before == 0x9F)))
    out = np.full(len(ends), INSIDE)
    out[BLANK[after] | BLANK[before]] = WORD
    out[COMMA[before] & BLANK[after]] = CLAUSE
    out[(stop & BLANK[after]) | wide_stop] = SENTENCE
    out[(before == 0x0A) | (after == 0x0A)] = LINE
    out[((before == 0x0A) & (second == 0x0A)) | ((after == 0x0A) & (later == 0x0A))] = PARAGRAPH
    out[(after & 0xC0) == 0x80] = IN_CHARACTER
    return out


def candidates(penalty: np.ndarray, n: int, overlap: int) -> np.ndarray:
    """Cut positions looked at: all that leave the next piece something to overlap with."""
    return np.arange(overlap + 1, n)


def _solve(penalties: list[np.ndarray], sizes: list[int], limit: int, overlap: int) -> list[list[int]]:
    """The program for several texts of more than ``limit`` tokens side by side: step j decides position j of all of them."""
    step, rows, most = limit - overlap, len(sizes), max(sizes)
    best = np.full((rows, most + 1), np.inf)  # the cost up to a cut at each position, its penalty included
    for r, (penalty, n) in enumerate(zip(penalties, sizes)):
        best[r, overlap + 1 : n] = penalty[overlap : n - 1]
        best[r, n] = 0.0
    # a single piece is best as far as it reaches: an earlier cut costs a piece more and leaves more unused
    best[:, : limit + 1] += BALANCE * ((limit - np.arange(limit + 1)) / limit) ** 2
    waste = BALANCE * (np.arange(step) / limit) ** 2  # of the pieces from the last ``step`` positions, the farthest first
    back = np.zeros((rows, most + 1), dtype=np.int32)
    total, line = np.empty((rows, step)), np.arange(rows)
    for j in range(limit + 1, most + 1):
        np.add(best[:, j - step : j], waste, out=total)
        k = total.argmin(axis=1)
        best[:, j] += total[line, k]
        back[:, j] = k + (j - step)
    out = []
    for r, n in enumerate(sizes):
        ends = [n]
        while ends[-1] > limit:
            ends.append(int(back[r, ends[-1]]))
        out.append(ends[::-1])
    return out


def best_cuts(penalties: list[np.ndarray], sizes: list[int], limit: int, overlap: int) -> list[list[int]]:
    """Ends of the pieces of texts of ``sizes`` tokens; ``penalties[t][k]`` is that of a cut of text t after token k + 1.

    Texts of like sizes are solved side by side.
    """
    out: list[list[int]] = [[n] for n in sizes]
    order = sorted((t for t, n in enumerate(sizes) if n > limit), key=lambda t: sizes[t])
    k = 0
    while k < len(order):
        group = [t for t in order[k : k + SIDE] if sizes[t] - limit <= 1.25 * (sizes[order[k]] - limit) + 16]
        k += len(group)
        for t, ends in zip(group, _solve([penalties[t] for t in group], [sizes[t] for t in group], limit, overlap)):
            out[t] = ends
    return out


OUT = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("ids", pa.list_(pa.int32())), ("text", pa.string())])


def split_documents(documents: DataFrame, limit: int = 512, overlap: int = 64, tokenizer: str = "byte_bpe_50k", folder: str | None = None) -> DataFrame:
    """Pieces of the texts of more than ``limit`` tokens: doc_id, piece (from 0), start, end, ids, text.

    ``start`` and ``end`` count tokens of the whole text; each piece begins ``overlap``
    tokens before the end of the one before it. ``ids`` are exact; in ``text`` a character
    cut in two by its tokens shows as U+FFFD. Smaller, empty and null texts have no row;
    equal rows are split each; further columns are ignored.
    """
    if not 0 <= overlap < limit:
        raise ValueError("the overlap must be smaller than the limit")
    shared = broadcast_vocabulary(documents.sparkSession, tokenizer, folder)

    def pieces(encoder, batch, data, offsets, ids, at):
        sizes = encoder.v.token_bytes[ids]
        ends = np.cumsum(sizes, dtype=np.int64)
        counts = np.diff(at)
        doc_ids = batch.column(0).to_pylist()
        large = np.flatnonzero(counts > limit)
        for some in np.array_split(large, max(1, int(counts[large].sum()) >> 19)):  # half a million tokens at a time
            if not len(some):
                continue
            n = counts[some]
            token = np.concatenate([np.arange(at[k], at[k + 1]) for k in some])
            penalty = cut_penalties(data, ends[token], np.repeat(offsets[some], n), np.repeat(offsets[some + 1], n))
            split = np.split(penalty, np.cumsum(n)[:-1])
            rows: dict[str, list] = {name: [] for name in OUT.names}
            for k, stops in zip(some.tolist(), best_cuts([p[:-1] for p in split], n.tolist(), limit, overlap)):
                a = int(at[k])
                for piece, stop in enumerate(stops):
                    start = stops[piece - 1] - overlap if piece else 0
                    rows["doc_id"].append(doc_ids[k])
                    rows["piece"].append(piece)
                    rows["start"].append(start)
                    rows["end"].append(stop)
                    rows["ids"].append(ids[a + start : a + stop])
                    rows["text"].append(data[ends[a + start] - sizes[a + start] : ends[a + stop - 1]].tobytes().decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([pa.array(rows[f.name], type=f.type) for f in OUT], schema=OUT)

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.make_valid_utf8("text").alias("text"))
    # a token has at least one byte, so a text of no more bytes than the limit has no more tokens
    return map_encoded(rows.where(F.octet_length("text") > limit), ["doc_id", "text"], "doc_id long, piece int, start int, end int, ids array<int>, text string", shared, pieces)

