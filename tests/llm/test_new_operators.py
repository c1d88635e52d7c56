"""Hard negatives, source divergence and packing against plain Python."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cardmill.llm import chat, divergence, negatives, packing
from cardmill.llm import text as tx
from cardmill.llm.queries import QUERIES

from .helpers import write
from .test_operators import plain_digests

VECTORS = "vec_id long, label int, embedding array<float>, anchor_id string"


# Hard negatives


def plain_negatives(rows, is_anchor, positives=5, negatives_=10, low=30, high=90, scale=256):
    kept = []
    for n, (key, label, vector, *_) in enumerate(rows):
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((n, key, label, [math.floor(scale * float(np.float32(x))) for x in vector]))
    out = []
    for n, key, label, vector in kept:
        if key is None or not is_anchor(key):
            continue
        scored = [(sum(x * y for x, y in zip(vector, w)), k, lab) for m, k, lab, w in kept if m != n]
        scored.sort(key=lambda s: (-s[0], s[1] is None, s[1] or 0))
        for score, positive, _ in [s for s in scored if s[2] == label][:positives]:
            window = [s for s in scored if s[2] != label and low * score <= 100 * s[0] <= high * score]
            out += [(key, positive, i + 1, s[1], score, s[0]) for i, s in enumerate(window[:negatives_])]
    return Counter(out)


def found_negatives(df):
    return Counter((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


@pytest.mark.parametrize("blocks", [(1 << 19, 1 << 18), (60, 12)])
def test_negatives_equal_a_plain_search(spark, blocks):
    rng = random.Random(3)
    rows = []
    for i in range(160):
        vector = [rng.choice([-0.5, 0.0, 0.25, 0.5, 0.75, 1.0]) for _ in range(6)]
        rows.append((i, rng.randint(0, 3), vector, "x"))
    rows += [(7, 1, [1.0] * 6, "x"), (20, 1, [0.5] * 6, "x"), (20, 1, [0.5] * 6, "x"), (None, 2, [1.0] * 6, "x"), (200, None, [1.0] * 6, "x")]
    rows += [(201, 1, None, "x"), (202, 1, [1.0, None, 1.0], "x"), (203, 1, [1.0, math.nan, 1.0], "x"), (204, 1, [math.inf] * 6, "x")]
    rows += [(220, 2, [1.0, 1.0], "x"), (240, 3, [], "x"), (260, 2, [-1.0] * 6, "x")]
    found = negatives.mine(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 20 == 0, row_values=blocks[0], anchor_values=blocks[1])
    assert found_negatives(found) == plain_negatives(rows, lambda k: k % 20 == 0)


def test_negatives_of_one_common_vector(spark):
    rows = [(i, i % 2, [0.5, 0.5], "x") for i in range(300)] + [(300 + i, i % 2, [0.25, 0.25], "x") for i in range(30)]
    found = negatives.mine(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 100 == 0, row_values=64, anchor_values=4)
    want = plain_negatives(rows, lambda k: k % 100 == 0)
    assert found_negatives(found) == want and len(want) == 4 * 5 * 10


def test_negatives_with_products_beyond_doubles(spark):
    rows = [(0, 0, [3e5, 3e5, 1.0], "x"), (1, 0, [3e5, 3e5, 1.25], "x"), (2, 1, [2e5, 2e5, 1.0], "x"), (3, 1, [2e5, 2e5, 1.25], "x")]
    found = negatives.mine(spark.createDataFrame(rows, VECTORS), F.col("vec_id") == 0, low=0, high=100)
    assert found_negatives(found) == plain_negatives(rows, lambda k: k == 0, low=0, high=100)


@pytest.mark.parametrize("rows", [[], [(1, 0, [1.0], "x")], [(100, 0, [1.0], "x")], [(100, None, None, None)]])
def test_negatives_of_nothing(spark, rows):
    assert negatives.mine(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 100 == 0).count() == 0


# Source divergence

DOCS = "doc_id long, text string, lang string, source string, n_chars int, term string"


def plain_audit(rows, least, top=50):
    counts, documents, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source, *_ in rows:
        text, lang, source = text or "", lang or "", source or ""
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)
        counts[lang, source].update(words)
        documents[lang].update(set(words))
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in documents[lang].items() if n >= least]
        total = Counter()
        for s in sources:
            total.update({t: counts[lang, s][t] for t in kept})

        def shares(count):
            n = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (n + 5 * len(kept)) for t in kept}

        p, q = {s: shares(counts[lang, s]) for s in sources}, shares(total)
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            over = [(q[t] - p[s][t], t.encode()) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(over)[:top])):
                out += [(lang, s, part, item.decode(), -value, i + 1) for i, (value, item) in enumerate(items)]
    return sorted(out)


def words(rng, n, vocabulary):
    return " ".join(rng.choice(vocabulary[: rng.randint(2, len(vocabulary))]) for _ in range(n))


@pytest.mark.parametrize("strip,band", [(4096, 256), (8, 2), (5, 3)])
def test_audit_equals_plain_counts(spark, monkeypatch, strip, band):
    rng = random.Random(8)
    vocabulary = ["Ab", "ab", "c3d", "é", "É", "zz-top", "naïve", "x" * 50, "你好", "ẞ"] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    rows = [(i, words(rng, rng.randint(0, 40), vocabulary), rng.choice("ab"), f"s{rng.randint(0, 6)}", 1, "t") for i in range(120)]
    rows += [(None, None, None, None, None, None), (1, "", "a", None, 1, "t"), (1, "", "a", None, 1, "t"), (5, "lone word", "only", "s1", 1, "t")]
    rows += [(6, "12 34", "empty", "s1", 1, "t"), (7, "56", "empty", "s2", 1, "t")]
    for name, value in (("STRIP", strip), ("BAND", band)):
        monkeypatch.setattr(divergence, name, value)
    found = divergence.audit(spark.createDataFrame(rows, DOCS), least_documents=3)
    assert sorted(tuple(r) for r in found.collect()) == plain_audit(rows, 3)


def test_a_long_text_is_counted_in_windows(monkeypatch):
    monkeypatch.setattr(divergence, "SLICE", 64)
    text = "Aa bb aa " * 50 + "x" * 200 + " bb"
    data, offsets = tx.flat(pa.array([text]))
    group, term, count, documents = divergence._counted(data, offsets, np.array([3]))
    assert dict(zip(term.to_pylist(), count.tolist())) == {"aa": 100, "bb": 51, "x" * 200: 1}
    assert set(group.tolist()) == {3} and set(documents.tolist()) == {1}


def test_audit_of_nothing(spark):
    assert divergence.audit(spark.createDataFrame([], DOCS)).count() == 0


# Packing


@pytest.fixture(scope="module")
def model(spark):
    return packing.vocabulary(spark)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def optimum(items, capacity):
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for room in {capacity - b for b in bins if b + items[i] <= capacity}:
            at = bins.index(capacity - room)
            bins[at] += items[i]
            go(i + 1, bins)
            bins[at] -= items[i]
        go(i + 1, [*bins, items[i]])

    go(0, [])
    return best[0]


def test_reduction_keeps_an_optimal_packing():
    rng, seen = random.Random(5), Counter()
    for _ in range(800):
        capacity = rng.choice([10, 20, 30])
        items = [rng.randint(rng.choice([1, 3, capacity // 5 + 1, capacity // 4 + 1]), capacity) for _ in range(rng.randint(1, 9))]
        fixed, rest = packing.reduced(Counter(items), capacity)
        seen.update(sum(n for _, n in content) for content, _ in fixed)
        assert optimum(items, capacity) == sum(m for _, m in fixed) + (optimum(list(rest.elements()), capacity) if rest else 0)
    assert set(seen) == {1, 2, 3}


def test_plan_places_every_piece_once():
    rng = random.Random(6)
    for _ in range(200):
        counts = Counter({rng.randint(1, 64): rng.randint(1, 10**9) for _ in range(rng.randint(1, 64))})
        placed = Counter()
        for content, times in packing.plan(counts, 64):
            assert sum(s * n for s, n in content) <= 64 and times > 0
            placed.update({s: n * times for s, n in content})
        assert placed == counts


def test_best_fit_equals_best_fit_piece_by_piece():
    rng = random.Random(7)
    for _ in range(300):
        items = sorted((rng.randint(1, 20) for _ in range(rng.randint(1, 60))), reverse=True)
        rooms = []
        for item in items:
            fitting = [r for r in rooms if r >= item]
            if fitting:
                rooms.remove(min(fitting))
            rooms.append((min(fitting) if fitting else 20) - item)
        found = Counter()
        for content, times in packing.best_fit(Counter(items), 20):
            found[20 - sum(s * n for s, n in content)] += times
        assert found == Counter(rooms)


def test_encoding_equals_the_tokenizer(model, tokenizer):
    rng, marks = random.Random(1), "    　 ab1.'s\né×÷你à»а\t\x1c\x85<|"
    texts = ["".join(rng.choice(marks) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["", "it's <|endoftext|> x<|endoftext|>y", "a" * 3000 + " b" * 3000, "x\n\ny\nz \n q"]
    data, offsets = tx.flat(pa.array(texts))
    ids, counts = packing.Encoder(model).encode(data, offsets)
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_forgetting_changes_no_ids(model, monkeypatch):
    data, offsets = tx.flat(pa.array([" ".join(f"w{i % 97}" for i in range(900)), "w1 w2"]))
    want = packing.Encoder(model).encode(data, offsets)
    monkeypatch.setattr(packing, "CACHED", 10)
    monkeypatch.setattr(packing, "STRETCH", 50)
    found = packing.Encoder(model)
    for _ in range(2):
        again = found.encode(data, offsets)
        assert all((x == y).all() for x, y in zip(want, again))


def check_packing(rows, ids, capacity):
    """The contract on rows of (key, piece, start, length, crc, sequence, offset); returns the number of sequences."""
    by_key, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_key[r[0]].append(r)
        by_sequence[r[5]].append((r[6], r[3]))
    assert by_key.keys() == ids.keys()
    for key, found in by_key.items():
        found.sort(key=lambda r: r[1])
        at = 0
        for i, (_, piece, start, length, crc, *_) in enumerate(found):
            assert (piece, start) == (i, at) and 1 <= length <= capacity and (i == 0 or length == capacity)
            assert crc == zlib.crc32(np.array(ids[key][at : at + length], dtype="<u4").tobytes())
            at += length
        assert at == len(ids[key]) and (len(found) == 1) == (at <= capacity)
    for content in by_sequence.values():
        at = 0
        for offset, length in sorted(content):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_pack_small_documents(spark, model, tokenizer):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["the", "of", "déjà", "x\ny"]) for _ in range(rng.choice([0, 1, 3, 7, 20, 90]))), 1) for i in range(60)]
    rows += [(100, None, 1), (101, "", 1)]
    ids = {k: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for k, t, _ in rows}
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int")
    placed = packing.place(packing.pieces(docs, model, capacity=16), 16)
    columns = ["doc_id", "piece", "start", "length", F.crc32("ids"), "sequence_id", "offset"]
    check_packing([tuple(r) for r in placed.select(*columns).collect()], ids, 16)
    joined = packing.sequences(placed).collect()
    assert sum(r.length for r in joined) == sum(map(len, ids.values())) and all(len(r.ids) == 4 * r.length for r in joined)


def test_repeated_and_unnamed_documents_are_packed_one_by_one(spark, model):
    docs = spark.createDataFrame([(1, "a b")] * 5 + [(None, "a b")] * 4, "doc_id long, text string")
    placed = packing.place(packing.pieces(docs, model, capacity=8), 8).collect()
    assert len(placed) == 9 and len({(r.sequence_id, r.offset) for r in placed}) == 9
    assert packing.place(packing.pieces(docs.limit(0), model), 8).count() == 0
    with pytest.raises(ValueError, match="outside 1 to 2"):
        packing.place(packing.pieces(docs, model), 2)


def test_op13_packs_the_whole_table_tightly(spark, tokenizer):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    ids = {k: [*tokenizer.encode(t, add_special_tokens=False).ids, 2] for k, t in texts.items()}
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    rows = [tuple(r) for r in QUERIES["op13_packing"](spark, folder).select(*columns).collect()]
    used, full = check_packing(rows, ids, 1024), math.ceil(sum(map(len, ids.values())) / 1024)
    assert used <= full + 1


def test_clashing_names(spark, tmp_path):
    rows = [(i, i // 10 % 2, [1.0, 0.5] if i // 10 % 2 else [0.5, 0.25], 1, 2, 3) for i in range(0, 300, 10)]
    names = "vec_id long, label int, embedding array<float>, row int, score int, slot int"
    write(spark.createDataFrame(rows, names), tmp_path, "embeddings")
    assert QUERIES["op11_negatives"](spark, str(tmp_path)).count() > 0


def test_a_conversation_with_most_turns_is_formatted_in_a_stream(spark):
    rng = random.Random(12)
    rows = [(7, i, rng.choice(["user", "assistant"]), rng.choice([None, "", "<|end|> é\\n", "word " * rng.randint(1, 30)])) for i in range(2500)]
    rows += [(100 + i // 3, i % 3, rng.choice(["system", "assistant"]), f"t{i}") for i in range(900)]
    made = chat.windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), budget=200)
    found = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digests(made).collect()}
    assert found == plain_digests(rows)
