"""Text operators: exact round trips, brute force and held-out accuracy."""

from __future__ import annotations

import base64
import itertools
import json
import os
import random
import re
import sys
import time

import numpy as np
import pyarrow as pa
import pytest

from registry_lens.functions.arrow_text import utf8_buffer
from registry_lens.llm import bpe, packing, pii, pii_model, splitting
from registry_lens.llm.pii_samples import CONTACTS, NAME_FIELDS, TEXTS, samples

sys.path.insert(0, os.path.dirname(__file__))
from second_grammar import SENTENCES as SECOND  # noqa: E402
from second_grammar import labelled  # noqa: E402

RANKS = os.path.join(bpe.tokenizer_folder(), "byte_bpe_50k.tiktoken")
pytestmark = pytest.mark.skipif(not os.path.exists(RANKS), reason="no vocabulary files")


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.load_vocabulary(RANKS))


@pytest.fixture(scope="module")
def ranks():
    with open(RANKS, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def encode(encoder, texts):
    data, offsets = utf8_buffer(pa.array(texts, type=pa.string()))
    ids, at = encoder.encode(data, offsets)
    return [ids[at[k] : at[k + 1]].tolist() for k in range(len(texts))]


NASTY = [
    "", None, " ", "\n\n  x", "don't they're I'll we've I'd 'sam ''s 's's", " 's", "a\u2003b\u00a0 c", "x\x1cy", "中文没有空格的文本。真的！", "e\u0301\u0301 ñ", "🎉👩‍👩‍👧", "aaaaaaaaaaaa" * 40, "<|endoftext|> text", "\t\tif x:\r\n\treturn 1", "12345 6789 ½ ²", "�broken\ufffd",
    "ab" * 4000, "".join(random.Random(1).choice("abcdefg") for _ in range(9000)),
]


def test_encoding_equals_a_plain_merge_loop(encoder, ranks):
    regex = pytest.importorskip("regex")
    pattern = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")

    def plain(text):
        out = []
        for word in pattern.findall(text or ""):
            parts = [bytes([b]) for b in word.encode()]
            while len(parts) > 1:
                best = min(range(len(parts) - 1), key=lambda k: ranks.get(parts[k] + parts[k + 1], 1 << 30))
                if parts[best] + parts[best + 1] not in ranks:
                    break
                parts[best : best + 2] = [parts[best] + parts[best + 1]]
            out += [ranks[p] for p in parts]
        return out

    r = random.Random(2)
    pool = list("ab 's't're've'll'd'm\n\t \r  12é\u00a0\u2003\x1c中.,;!?\"")
    texts = NASTY[:16] + ["".join(r.choice(pool) for _ in range(r.randint(0, 60))) for _ in range(800)]
    assert encode(encoder, texts) == [plain(t) for t in texts]


def test_long_words_and_library(encoder, ranks):
    tiktoken = pytest.importorskip("tiktoken")
    pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    other = tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    assert encode(encoder, NASTY) == [other.encode_ordinary(t or "") for t in NASTY]


LONG = {
    "one letter": "x" * 5_000_000,
    "random": "".join(random.Random(1).choices("abcdefghijklmnopqrstuvwxyz", k=400_000)),
    "period": "abcdefghij" * 100_000,
    "signs": "".join(random.Random(2).choices("=-_*#", k=300_000)),
    "letters of three bytes": "".join(random.Random(3).choices("的一是不了人我在有他", k=60_000)),
}


@pytest.mark.parametrize("kind", LONG)
def test_a_word_of_megabytes(encoder, ranks, kind):
    """Linear enough for texts without a blank; equal to the library and, byte for byte, to the text."""
    tiktoken = pytest.importorskip("tiktoken")
    text = LONG[kind]
    began = time.process_time()
    (ids,) = encode(encoder, [text])
    assert time.process_time() - began < 60
    back = {v: k for k, v in ranks.items()}
    assert b"".join(back[i] for i in ids).decode() == text
    other = tiktoken.Encoding("other", pat_str=r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""", mergeable_ranks=ranks, special_tokens={})
    part = text[:50_000]
    assert encode(encoder, [part])[0] == other.encode_ordinary(part)


def test_encoding_round_trip_in_spark(spark, ranks):
    back = {v: k for k, v in ranks.items()}
    rows = [(k, t, "clash") for k, t in enumerate(NASTY)] + [(None, "x", None), (0, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = bpe.encode_documents(df).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r["ids"] for r in got if r["doc_id"]}
    assert all(b"".join(back[i] for i in by[k]).decode() == NASTY[k] for k in range(2, len(NASTY)))
    assert by[1] == [] and [r["ids"] for r in got if r["doc_id"] == 0] == [[], []]
    assert bpe.encode_documents(df.limit(0)).collect() == []


def test_patterns_are_optimal():
    sizes = np.array([900, 700, 500, 300])
    for seed in range(20):
        value = np.random.default_rng(seed).random(4)
        got = packing.best_pattern(value, sizes, 2048)
        every = itertools.product(*(range(2048 // s + 1) for s in sizes))
        assert got @ sizes <= 2048
        assert value @ got == pytest.approx(max(value @ np.array(p) for p in every if sizes @ np.array(p) <= 2048))


@pytest.mark.parametrize("seed", range(6))
def test_plans_place_every_item_within_capacity(seed):
    r = np.random.default_rng(seed)
    capacity = 256
    sizes = [r.integers(1, 257, 400), r.integers(1, 20, 300), r.integers(200, 257, 90), np.full(77, 256), np.array([129] * 50 + [128] * 50), np.array([], dtype=int)][seed]
    plan = packing.make_plan(np.bincount(sizes, minlength=capacity + 1), capacity)
    if not len(sizes):
        assert plan.containers == 0
        return
    ordered = np.sort(sizes)[::-1]
    rank = np.arange(len(ordered))
    k = np.searchsorted(plan.start, rank, side="right") - 1
    container = plan.first[k] + (rank - plan.start[k]) // plan.per[k]
    load = np.bincount(container, weights=ordered, minlength=plan.containers)
    assert load.max() <= capacity and container.max() < plan.containers
    # not worse than first fit decreasing
    open_: list[int] = []
    for s in ordered:
        at = next((j for j, used in enumerate(open_) if used + s <= capacity), None)
        if at is None:
            open_.append(int(s))
        else:
            open_[at] += int(s)
    assert (load > 0).sum() <= len(open_) + 1


def test_packing_in_spark(spark):
    rows = [(1, 0), (2, 5000), (3, 2048), (4, 2049), (5, 100), (5, 100), (None, 7), (6, 1)] + [(k, 300 + k % 900) for k in range(10, 400)] + [(k, 777) for k in range(1000, 1300)]
    df = spark.createDataFrame(rows, "doc_id long, tokens long")
    got = packing.pack(df).collect()
    load, per_doc = {}, {}
    for r in got:
        load[r["container"]] = load.get(r["container"], 0) + r["size"]
        if r["doc_id"] is not None:
            per_doc.setdefault(r["doc_id"], []).append((r["start"], r["size"]))
    assert max(load.values()) <= 2048 and sum(load.values()) == sum(t for _, t in rows)
    assert len(load) <= -(-sum(load.values()) // 2048) * 1.1 + 2
    assert sorted(per_doc[2]) == [(0, 2048), (2048, 2048), (4096, 904)] and sorted(per_doc[4]) == [(0, 2048), (2048, 1)]
    assert all(len(v) == 1 for d, v in per_doc.items() if d not in (2, 4, 5))
    assert packing.pack(df.limit(0)).collect() == []


def brute_cuts(penalty, n, limit, overlap, places):
    at = [*places, n]
    best = {}
    for j, e in enumerate(at):
        tail = 0.0 if e == n else penalty[e - 1]
        options = [(splitting.BALANCE * ((limit - e) / limit) ** 2, None)] if e <= limit else []
        options += [(best[i][0] + splitting.BALANCE * ((limit - (e - at[i] + overlap)) / limit) ** 2, i) for i in range(j) if e - at[i] + overlap <= limit and i in best]
        if options:
            cost, i = min(options, key=lambda x: x[0])
            best[j] = (cost + tail, i)
    return best[len(at) - 1][0]


def test_cuts_are_optimal_over_their_places():
    r = np.random.default_rng(4)
    penalties, sizes = [], []
    for _ in range(25):
        n = int(r.integers(60, 700))
        penalties.append(r.choice([0.0, 0.2, 0.4, 1.6, 4.0, 9.0], n - 1, p=[0.01, 0.02, 0.03, 0.3, 0.54, 0.1]))
        sizes.append(n)
    limit, overlap = 100, 16
    for penalty, n, ends in zip(penalties, sizes, splitting.best_cuts(penalties, sizes, limit, overlap)):
        places = splitting.candidates(penalty, n, overlap).tolist() if n > limit else []
        starts = [0, *(e - overlap for e in ends[:-1])]
        lengths = [e - s for s, e in zip(starts, ends)]
        assert ends[-1] == n and max(lengths) <= limit and all(b > a for a, b in zip([0, *ends], ends))
        cost = sum(splitting.BALANCE * ((limit - x) / limit) ** 2 for x in lengths) + sum(penalty[e - 1] for e in ends[:-1])
        assert cost == pytest.approx(brute_cuts(penalty, n, limit, overlap, places))


def test_cuts_are_optimal_over_all_positions():
    """Sizes that leave few places for the least number of pieces, and a clause end between near sentence ends."""
    sizes = [954, 957, 960, 1403, 1408, 1409, 960, 700, 961, 513, 512]
    penalties = [np.full(n - 1, splitting.INSIDE) for n in sizes[:6]]
    prose = np.full(959, splitting.WORD)
    prose[39::40] = splitting.SENTENCE
    prose[511] = splitting.CLAUSE
    penalties += [prose, np.full(699, splitting.WORD), np.full(960, splitting.INSIDE), np.full(512, splitting.INSIDE), np.full(511, splitting.INSIDE)]
    r = np.random.default_rng(9)
    for n in (600, 958, 1407):
        penalties.append(r.choice([0.0, 0.2, 0.4, 1.2, 1.6, 4.0, 9.0], n - 1, p=[0.002, 0.003, 0.02, 0.05, 0.4, 0.425, 0.1]))
        sizes.append(n)
    limit, overlap = 512, 64
    got = splitting.best_cuts(penalties, sizes, limit, overlap)
    assert [len(ends) for ends in got[:11]] == [2, 2, 2, 3, 3, 4, 2, 2, 3, 2, 1] and got[6] == [512, 960]
    for penalty, n, ends in zip(penalties, sizes, got):
        starts = [0, *(e - overlap for e in ends[:-1])]
        lengths = [e - s for s, e in zip(starts, ends)]
        assert ends[-1] == n and max(lengths) <= limit and all(b > a for a, b in zip([0, *ends], ends))
        cost = sum(splitting.BALANCE * ((limit - x) / limit) ** 2 for x in lengths) + sum(penalty[e - 1] for e in ends[:-1])
        assert cost == pytest.approx(brute_cuts(penalty, n, limit, overlap, range(overlap + 1, n)))


def test_penalties():
    text = "One. Two,\nthree\n\nvier é。end".encode()
    cut = lambda s: float(splitting.cut_penalties(np.frombuffer(text, dtype=np.uint8), np.array([text.index(s)]), np.array([0]), np.array([len(text)]))[0])
    assert [cut(b" Two"), cut(b"three"), cut(b"vier"), cut(b"ier"), cut("é".encode()), cut(b"end"), cut(b"\xa9")] == [splitting.SENTENCE, splitting.LINE, splitting.PARAGRAPH, splitting.INSIDE, splitting.WORD, splitting.SENTENCE, splitting.IN_CHARACTER]


def test_splitting_in_spark(spark, encoder):
    prose = " ".join(f"Sentence number {k} is here." + ("\n\n" if k % 9 == 8 else "") for k in range(300))
    texts = ["short", None, "", prose, "x" * 30000, "字" * 3000, prose + "y" * 5000]
    df = spark.createDataFrame([(k, t, 9) for k, t in enumerate(texts)] + [(3, prose, 1)], "doc_id long, text string, piece int")
    got = splitting.split_documents(df).collect()
    whole = dict(enumerate(encode(encoder, texts)))
    assert {r["doc_id"] for r in got} == {k for k, ids in whole.items() if len(ids) > 512}
    for doc in {r["doc_id"] for r in got}:
        pieces = sorted({(r["piece"], r["start"], r["end"], tuple(r["ids"]), r["text"]) for r in got if r["doc_id"] == doc})
        assert [p[0] for p in pieces] == list(range(len(pieces))) and pieces[0][1] == 0 and pieces[-1][2] == len(whole[doc])
        for (_, s, e, ids, text), nxt in zip(pieces, [*pieces[1:], None]):
            assert list(ids) == whole[doc][s:e] and e - s <= 512 and (nxt is None or nxt[1] == e - 64)
        if doc == 3:
            assert all(p[4].endswith(("\n\n", ".", "\n")) for p in pieces[:-1])
    assert splitting.split_documents(df.limit(0)).collect() == []


def test_semi_crf_recursions_against_enumeration():
    r = random.Random(8)
    for _ in range(30):
        spans = sorted({tuple(sorted(r.sample(range(12), 2))) for _ in range(6)})
        start, end, kind = (np.array(x) for x in zip(*((a, b, k) for a, b in spans for k in (1, 4))))
        score = np.array([r.uniform(-1, 2) for _ in start])
        legal = [s for n in range(len(start) + 1) for s in itertools.combinations(range(len(start)), n) if all(end[x] <= start[y] or end[y] <= start[x] for x, y in itertools.combinations(s, 2))]
        of = lambda s: float(score[list(s)].sum())
        chosen = {(a, b, k) for a, b, k in pii_model.best_segments(start, end, kind, score)}
        assert sum(score[k] for k in range(len(start)) if (start[k], end[k], kind[k]) in chosen) == pytest.approx(max(map(of, legal)))
        probability, total = pii_model.expectations(start, end, score)
        weight = [np.exp(of(s)) for s in legal]
        assert total == pytest.approx(np.log(sum(weight)))
        for k, p in enumerate(probability):
            assert p == pytest.approx(sum(w for s, w in zip(legal, weight) if k in s) / sum(weight))


def rates(model, cases):
    """{kind: (precision, recall)} of (text, field, labelled spans)."""
    hit, wrong, missed = ({k: 0 for k in pii.KINDS} for _ in range(3))
    for (_, _, gold), items in zip(cases, pii.find_in_texts(model, [t for t, _, _ in cases], [f for _, f, _ in cases])):
        got = {(k, a, b) for a, b, k in items}
        for counts, found in ((hit, got & gold), (wrong, got - gold), (missed, gold - got)):
            for k, _, _ in found:
                counts[k] += 1
    return {k: (hit[k] / max(1, hit[k] + wrong[k]), hit[k] / max(1, hit[k] + missed[k])) for k in pii.KINDS}


def test_accuracy_on_fresh_sentences_of_the_grammar():
    for kind, (precision, recall) in rates(pii.trained(), samples(800, seed=4711)).items():
        assert precision > 0.93 and recall > 0.93, kind


def test_accuracy_on_a_second_grammar():
    """Sentences, names and formats that the training grammar has not: what to expect of text it was not written for."""
    for kind, (precision, recall) in rates(pii.trained(), [(t, 0, g) for t, g in labelled(800, 20)]).items():
        assert precision > 0.95 and recall > 0.95, kind


def test_no_sentence_is_taken_from_the_tables(smallest):
    """No template of either grammar has five words in a row with the advisories' texts."""
    import pyarrow.parquet as pq

    words = lambda t: re.findall(r"[^\W_]+", t.lower())
    runs = lambda t: {tuple(w[k : k + 5]) for w in [words(t)] for k in range(len(w) - 4)}
    theirs = set()
    for sf in ("sf0.001", "sf0.01"):
        table = pq.read_table(os.path.join(os.path.dirname(smallest), sf, "osv_records.parquet"), columns=["summary", "raw"]).to_pydict()
        for text in {t for column in table.values() for t in column if t}:
            for part in re.split(r"\\[nrt]|[\"{}\[\]]", text):
                theirs |= runs(part)
    for template in (*TEXTS, *NAME_FIELDS, *CONTACTS, *SECOND):
        for stretch in re.split(r"\{\w+\}", template):
            assert not runs(stretch) & theirs, template


SENTENCES = [
    ("Commit signed off by Ana Prewitt <ana.p@example.com>.", {("name", "Ana Prewitt"), ("email", "ana.p@example.com")}),
    ("Dr. Ana de la Prewitt's phone is +44 7700 900123.", {("name", "Ana de la Prewitt"), ("phone", "+44 7700 900123")}),
    ("Write to bo.lund [at] mail (dot) example (dot) org or security@example.com.", {("email", "bo.lund [at] mail (dot) example (dot) org")}),
    ("Offsets 555-1024 of the bundle, ticket 2026-03-1738, 192.0.2.7:8443 and CVE-2099-2613.", set()),
    ("Clone git@git.example.com:tools/x.git or pin @scope/pkg@1.2.3.", set()),
    ("Letters to the author go to 12 Larch Street, Oxbridge 90210.", {("address", "12 Larch Street, Oxbridge 90210")}),
    ("Reported through Larch Research Group.", set()),
]


def test_sentences():
    model = pii.trained()
    for text, want in SENTENCES:
        assert {(k, text[a:b]) for a, b, k in pii.find_in_text(model, text)} == want


ENCODED = [
    ("https://drop.gutter.invalid/c?u=iskarvholt%40example.org&v=6.4.13", ["iskarvholt%40example.org"]),
    ("https://drop.quill.invalid/c?u=pavel+npm0%40example.com", ["pavel+npm0%40example.com"]),
    ("https://drop.quill.invalid/c?u=pavel%2Bnpm0%40dept.corp.example&v=1.0.0", ["pavel%2Bnpm0%40dept.corp.example"]),
    ("https://jetty.example/c?to=noreply%40example.org&v=1.0.0", []),
    ("https://jetty.example/plain?ref=pkg-x%401.2.3", []),
]


@pytest.mark.parametrize("text,want", ENCODED)
def test_percent_encoded_emails(text, want):
    model = pii.trained()
    for field in (0, 2):
        items = pii.find_in_text(model, text, field)
        assert [(k, text[a:b]) for a, b, k in items] == [("email", w) for w in want]
        raw = json.dumps({"urls": [text]})
        found = pii.find_in_json(model, raw)
        assert [raw[a:b] for a, b, _ in found] == want
        assert json.loads(pii.replace(raw, found))["urls"] == [text.replace(want[0], "[EMAIL]") if want else text]


@pytest.mark.parametrize("name", ["An Le", "Ping An", "A. Du"])
def test_names_of_function_words(name):
    model = pii.trained()
    for field, text in ((1, name), (0, f"Reported privately by {name}."), (0, f"Thanks to {name} for the analysis.")):
        assert [(k, text[a:b]) for a, b, k in pii.find_in_text(model, text, field)] == [("name", name)]
    for text, want in (("Ping Ana Prewitt or write to ana.p@example.com.", ["Ana Prewitt", "ana.p@example.com"]), ("The Report of an Author. It Is Not New. My Package", [])):
        assert [text[a:b] for a, b, _ in pii.find_in_text(model, text)] == want


def test_personal_items_in_spark(spark):
    raw = json.dumps({"id": "X-1", "details": "Line\nJürgen Prewitt found a backdoor in pkg-x 1.2.3", "credits": [{"name": "Zoë Lund", "contact": ["mailto:z.lund@example.com", "02.99.00.28.86"]}, {"name": "Larch Labs"}], "email": "support@example.com"})
    rows = [("a", "Ana Prewitt found a backdoor in pkg-y 2.0.0", raw, "clash"), ("b", None, None, None), ("c", "", "", ""), ("d", "x" * 60000, "{broken Ana Prewitt", None), (None, "Contact ana.p@example.com for the write-up.", None, None)]
    df = spark.createDataFrame(rows + rows[:1], "id string, summary string, raw string, field string")
    got = {tuple(r) for r in pii.find_personal(df).collect()}
    assert {g for g in got if g[0] == "a"} == {
        ("a", "summary", "name", "Ana Prewitt"), ("a", "raw", "name", "J\\u00fcrgen Prewitt"), ("a", "raw", "name", "Zo\\u00eb Lund"), ("a", "raw", "email", "z.lund@example.com"), ("a", "raw", "phone", "02.99.00.28.86"),
    }
    assert (None, "summary", "email", "ana.p@example.com") in got
    clean = {r["id"]: r for r in pii.redact(df).collect()}
    doc = json.loads(clean["a"]["raw"])
    assert doc["credits"][0] == {"name": "[NAME]", "contact": ["mailto:[EMAIL]", "[PHONE]"]} and doc["details"].startswith("Line\n[NAME] found") and doc["credits"][1]["name"] == "Larch Labs"
    assert clean["b"]["raw"] is None and clean["c"]["raw"] == "" and clean["a"]["summary"] == "[NAME] found a backdoor in pkg-y 2.0.0"
    assert pii.find_personal(df.limit(0)).collect() == []


EDGES = ["", " ", "\x00", "a\x00Ana Prewitt\x00b", "\ud800 Ana Prewitt", "@", "at", "%40", "+", "(", "J.", "O'", "-", "\n\n", "A" * 5000, "1" * 5000, "A B " * 3000, "1 2 " * 3000, "Street 1 " * 500, "字" * 3000, "é" * 3000, "@ " * 3000, "(" * 3000]


@pytest.mark.parametrize("text", EDGES)
def test_odd_texts(text):
    """Signs, long runs and broken characters: nothing fails, and spans lie within the text."""
    for a, b, _ in pii.find_in_text(pii.trained(), text):
        assert 0 <= a < b <= len(text) and "\x00" not in text[a:b]
    assert pii.json_strings(json.dumps({"k": text, "l": [text]}))[-1][0] == text if text else True


def test_pages_do_not_touch_results(monkeypatch):
    texts = [t for t, _, _ in samples(300, seed=6)]
    model = pii_model.SemiCRF(pii.trained().weights)
    whole = pii.find_in_texts(model, texts, [0] * len(texts))
    monkeypatch.setattr(pii, "PAGE", 300)
    assert pii.find_in_texts(pii_model.SemiCRF(model.weights), texts, [0] * len(texts)) == whole
    assert [pii.find_in_text(pii_model.SemiCRF(model.weights), t) for t in texts[:60]] == whole[:60]


def test_replacement_changes_nothing_else():
    model = pii.trained()
    for text, field, _ in samples(200, seed=5):
        items = pii.find_in_text(model, text, field)
        out, at = pii.replace(text, items), 0
        for a, b, kind in items:
            assert out.startswith(text[at:a] + pii.PLACEHOLDERS[kind])
            out, at = out[len(text[at:a]) + len(pii.PLACEHOLDERS[kind]) :], b
        assert out == text[at:]


def test_registered_queries(spark, smallest):
    from registry_lens.llm import queries

    documents = spark.read.parquet(f"{smallest}/documents.parquet")
    ids = {r["doc_id"]: len(r["ids"]) for r in queries.p8_ids(spark, smallest).collect()}
    assert len(ids) == documents.count()
    assert sorted(r[0] for r in queries.p9_found(spark, smallest).collect()) == sorted(d for d, n in ids.items() if n > 2048)
    assert sorted(r[0] for r in queries.p10_found(spark, smallest).collect()) == sorted(d for d, n in ids.items() if n > 512)
    assert queries.p6_found(spark, smallest).columns == ["id", "field", "kind", "value"]
