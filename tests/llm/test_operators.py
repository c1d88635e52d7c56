import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardmill.llm import chat, components, decontaminate, lines, minhash, pieces, quality, sharding, substrings, tables, toxicity, vectors

from .helpers import by_key, documents, removed_bytes, sha, shingles, smallest_reachable


@pytest.fixture(autouse=True, scope="module")
def settings(spark):
    tables.ready(spark)


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(n))


def corpus(seed=0):
    """Copies, near copies, shared passages, short, empty and null texts, a long one."""
    rng = random.Random(seed)
    base = [prose(rng, 60) for _ in range(6)]
    texts = [None, "", " ", "one two", "one two", "One  two"]
    for b in base:
        words = b.split()
        texts += [b, b, b.upper(), " ".join([*words[:30], "new", *words[31:]]), " ".join(words[:50]), prose(rng, 40) + " " + " ".join(words[5:50])]
    texts.append(prose(rng, 6000))
    return list(enumerate(texts))


# --- helpers over DataFrames


def test_numbering_is_gapless_in_every_group(spark):
    rows = [(None if i % 7 == 0 else i % 3, i) for i in range(200)]
    found = tables.numbered(spark.createDataFrame(rows, "g long, v long").repartition(5), ["g"], ["v"], "n").collect()
    for g in (None, 0, 1, 2):
        mine = sorted((r.v, r.n) for r in found if r.g == g)
        assert [n for _, n in mine] == list(range(len(mine)))
    assert tables.numbered(spark.createDataFrame([], "g long, v long"), ["g"], ["v"], "n").count() == 0


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (None, 3), (5, None), (1, 2)]
    found = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 130)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- 1 lines


def plain_lines(rows, least, chars):
    sequence = {k: (t.split("\n") if t else []) for k, t in rows}
    gone = {k: set() for k in sequence}
    for length in (1, least):
        seen = set()
        for k in sorted(sequence):
            for i in range(len(sequence[k]) - length + 1):
                run = tuple(sequence[k][i : i + length])
                if run in seen and (length == least or len(run[0]) >= chars):
                    gone[k].update(range(i, i + length))
                seen.add(run)
    return {k: (len(s), len(gone[k]), "\n".join(x for i, x in enumerate(s) if i not in gone[k]) if s else None) for k, s in sequence.items()}


@pytest.mark.parametrize("least", [2, 3, 5])
def test_lines_like_plain_python(spark, least):
    rng = random.Random(least)
    pool = ["a", "b", "c", "", "d" * 30]
    rows = [(k, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 12)))) for k in range(25)] + [(25, None), (26, ""), (27, "\n\n")]
    found = by_key(lines.remove_repeated_lines(documents(spark, rows).repartition(3), min_lines=least, min_chars=20))
    for k, (n, removed, kept) in plain_lines(rows, least, 20).items():
        text = dict(rows)[k]
        assert (found[k].n_lines, found[k].n_removed, found[k].text) == (n, removed, kept if text else text), k


def test_lines_cases(spark):
    schema = "doc_id long, text string, __doc string, n_lines string"
    rows = [(1, "x\ny\nz", "k", "k"), (1, "x\ny\nz", "k", "k"), (None, "x\ny\nz", "k", "k"), (2, "x\ny\nz\nw", "k", "k")]
    found = lines.remove_repeated_lines(documents(spark, rows, schema))
    assert found.columns == ["doc_id", "text", "__doc", "n_lines", "n_removed", "n_runs"]
    assert sorted((r.doc_id or 0, r.text, r.n_runs) for r in found.collect()) == [(0, "x\ny\nz", 0), (1, "", 1), (1, "", 1), (2, "w", 1)]
    assert lines.remove_repeated_lines(documents(spark, [])).count() == 0


def test_lines_use_no_python_on_executors(spark):
    plan = lines.remove_repeated_lines(documents(spark, [(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# --- 2 vectors


def test_vectors_like_brute_force(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(12, 16))
    rows, nan = [], float("nan")
    for i in range(150):
        v = base[i % 12] + rng.normal(size=16) * (0.12 if i % 3 else 0.35)
        rows.append((i, v.astype(np.float32).tolist(), i % 2))
    rows += [(150 + i, rows[0][1], 0) for i in range(20)]
    rows += [(200, None, 0), (201, [0.0] * 16, 0), (202, [nan] * 16, 0), (203, rows[0][1], None), (204, [None] + rows[0][1][1:], 0), (205, rows[0][1][:8], 0)]
    rows.append((206, [float("inf")] + rows[0][1][1:], 0))
    old = vectors.LIST_SIZE, vectors.BLOCK
    vectors.LIST_SIZE, vectors.BLOCK = 20, 16
    try:
        found = by_key(vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3), 0.93), "vec_id")
    finally:
        vectors.LIST_SIZE, vectors.BLOCK = old
    good = {k: (np.array(v, dtype=np.float64), y) for k, v, y in rows if k < 200 or k == 205}
    links = [
        (a, b) for a in good for b in good
        if a < b and good[a][1] == good[b][1] and len(good[a][0]) == len(good[b][0])
        and good[a][0] @ good[b][0] / np.linalg.norm(good[a][0]) / np.linalg.norm(good[b][0]) >= 0.93
    ]
    reach = smallest_reachable([r[0] for r in rows], links)
    for k, *_ in rows:
        assert (found[k].n_links, found[k].component_id, found[k].kept) == (sum(k in x for x in links), reach[k], reach[k] == k), k


def test_vectors_cases(spark):
    schema = "vec_id long, embedding array<float>, label string, id int, v int, weight int"
    rows = [(1, [1.0], "a", 0, 0, 0), (1, [1.0], "a", 0, 0, 0), (None, [1.0], "a", 0, 0, 0)]
    found = vectors.near_vectors(spark.createDataFrame(rows, schema), 0.9).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.kept) for r in found) == [(0, 2, True), (1, 2, True), (1, 2, True)]
    assert vectors.near_vectors(spark.createDataFrame([], schema), 0.9).count() == 0
    assert vectors.near_vectors(spark.createDataFrame([(1, None, None, 0, 0, 0)], schema), 0.9).count() == 1


# --- 3 pieces


def test_pieces_round_trip(spark):
    model = pieces.model_bytes(spark)
    rows = corpus() + [(None, "no key"), (900, "▁\U0001f600 \x00"), (900, "▁\U0001f600 \x00")]
    docs = documents(spark, rows).withColumns({"pieces": F.lit("old"), "__text": F.lit("other")})
    found = pieces.decode(pieces.encode(docs, model), model)
    assert found.columns == ["doc_id", "text", "__text", "pieces", "decoded"]
    assert found.filter("not (decoded <=> text)").count() == 0
    assert found.filter("text is null and pieces is not null").count() == 0
    again = pieces.encode(docs.repartition(7), model)
    assert again.select("doc_id", "pieces").exceptAll(found.select("doc_id", "pieces")).count() == 0
    assert pieces.encode(documents(spark, []), model).count() == 0


# --- 4 substrings


@pytest.mark.parametrize("hot", [4096, 1])
def test_substrings_like_brute_force(spark, hot):
    rows = corpus(3) + [(500, "ab" * 300), (501, "x" + "ab" * 120), (502, "c" * 199), (503, "c" * 200), (504, "é" * 150), (505, "zé" * 90 + "é" * 101)]
    old, substrings.HOT = substrings.HOT, hot
    try:
        found = by_key(substrings.remove_repeats(documents(spark, rows).repartition(4)))
    finally:
        substrings.HOT = old
    for k, gone in removed_bytes(dict(rows), 200).items():
        data = (dict(rows)[k] or "").encode()
        starts = sum(1 for i in gone if i - 1 not in gone)
        kept = bytes(b for i, b in enumerate(data) if i not in gone)
        assert (found[k].n_bytes, found[k].n_removed, found[k].n_spans, bytes(found[k].kept)) == (len(data), len(gone), starts, kept), k


def test_substrings_cases(spark):
    text = prose(random.Random(9), 80)
    rows = [(1, text, 0, 0), (1, text, 0, 0), (None, "short", 0, 0)]
    found = substrings.remove_repeats(documents(spark, rows, "doc_id long, text string, doc int, hash int")).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in found) == [(0, 0), (1, len(text)), (1, len(text))]
    assert substrings.remove_repeats(documents(spark, [])).count() == 0


# --- 5 toxicity


def labelled(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(400):
        words = prose(rng, 30).split()
        if i % 5 == 0:
            words[3:3] = rng.sample(["grob", "fies", "mies", "pfui"], 2)
        rows.append((i, " ".join(words)))
        labels.append((i, i % 5 == 0))
    rows += [(1000, None), (1001, ""), (1002, "GROB fies"), (1002, "GROB fies"), (None, "grob mies")]
    marks = [(k, int(y)) for k, y in labels] + [(5000, 1), (3, None), (None, 1)]
    return documents(spark, rows, "doc_id long, text string").withColumns({"score": F.lit("s"), "key": F.lit("k")}), spark.createDataFrame(marks, "doc_id long, toxic int"), dict(rows), dict(labels)


def test_toxicity_finds_held_out_cases(spark):
    docs, marks, _, truth = labelled(spark)
    found = by_key(toxicity.score(docs, toxicity.train(docs, marks)))
    held = [k for k in truth if zlib.crc32(str(k).encode()) % 3 == 1]
    assert all((found[k].score >= 0.7) == truth[k] for k in held)
    assert found[1000].score == found[1001].score < 0.7 <= found[1002].score
    assert all(0 <= r.score <= 1 for r in found.values())


def test_block_max_search_equals_full_search():
    rng = np.random.default_rng(0)
    x = (rng.random((500, 20)) * (rng.random((500, 20)) < 0.2)).astype(np.float32)
    x = x[x.any(axis=1)]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    blocks = np.stack([x[a : a + toxicity.BLOCK].max(axis=0) for a in range(0, len(x), toxicity.BLOCK)])
    best, place = toxicity.nearest({"vectors": x, "blocks": blocks}, x[:100], 7)
    cosine = x[:100] @ x.T
    assert np.allclose(np.sort(cosine, axis=1)[:, ::-1][:, :7].clip(0), best.clip(0), atol=1e-6)
    assert np.allclose(np.take_along_axis(cosine, np.maximum(place, 0), 1)[place >= 0], best[place >= 0], atol=1e-6)


def test_toxicity_without_labels_or_documents(spark):
    docs, marks, _, _ = labelled(spark)
    none = toxicity.train(docs, marks.filter("false"))
    assert toxicity.score(docs, none).filter("score <> 0").count() == 0
    assert toxicity.score(docs.filter("false"), toxicity.train(docs.filter("false"), marks)).count() == 0


# --- 6 sharding


def test_sharding_laws(spark):
    rng = random.Random(6)
    rows = [(i, prose(rng, rng.randint(1, 60))) for i in range(600)]
    rows += [(1000 + i, "the same text again and again") for i in range(400)] + [(3000 + i, prose(random.Random(7), 50)) for i in range(3)]
    rows += [(2000, None), (2001, ""), (None, "x"), (None, "x"), (2002, "ü" * 10)]
    found = sharding.assign(documents(spark, rows).repartition(4).withColumn("group", F.lit(1)), 5).collect()
    assert len(found) == len(rows)
    sizes, counts, slots = [0] * 5, [0] * 5, [[] for _ in range(5)]
    for r in found:
        sizes[r.shard] += r.size
        counts[r.shard] += 1
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    assert max(sizes) < 1.03 * min(sizes) and max(counts) < 1.1 * min(counts)
    by = {r.doc_id: r for r in found if r.doc_id is not None}
    assert by[2000].size == by[2001].size == 8 and by[2000].text_crc32 == 0 and by[2002].size == 28
    assert by[2002].text_crc32 == zlib.crc32(("ü" * 10).encode())
    assert by[2000].shard == by[2001].shard and len({by[3000 + i].shard for i in range(3)}) == 1
    assert sharding.assign(documents(spark, []), 5).count() == 0


def test_group_of_up_to_one_shard_stays_whole(spark):
    rng = random.Random(61)
    rows = [(i, prose(rng, 40)) for i in range(800)]
    same = {1000: (90, prose(rng, 40)), 2000: (120, prose(rng, 40)), 3000: (330, prose(rng, 40))}  # shares of a shard below
    rows += [(start + i, text) for start, (n, text) in same.items() for i in range(n)]
    found = by_key(sharding.assign(documents(spark, rows).repartition(4), 8))
    sizes = [sum(r.size for r in found.values() if r.shard == s) for s in range(8)]
    parts = {start: max(n * found[start].size / (sum(sizes) / 8), n / (len(rows) / 8)) for start, (n, _) in same.items()}
    assert 0.5 < parts[1000] < 0.65 < parts[2000] < 0.9 and parts[3000] > 1.5
    held = {start: {found[start + i].shard for i in range(n)} for start, (n, _) in same.items()}
    assert len(held[1000]) == len(held[2000]) == 1 and len(held[3000]) > 1
    assert len(found) == len(rows) and max(sizes) < 1.03 * min(sizes)


# --- 7 near duplicates


def test_near_duplicates_like_brute_force(spark):
    rng = random.Random(7)
    hub = prose(rng, 70).split()
    rows = corpus(7)
    for i in range(40):  # near copies of one text that are mostly not near each other
        words = list(hub)
        for at in rng.sample(range(70), 1 + i % 3):
            words[at] = f"w{i}x{at}"
        rows.append((2000 + i, " ".join(words)))
    found = by_key(minhash.near_duplicates(documents(spark, rows).repartition(4).withColumn("id", F.lit(1)), 0.85))
    sets = {k: shingles(t) for k, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    reach = smallest_reachable(sets, links)
    for k, s in sets.items():
        assert (found[k].n_shingles, found[k].component_id, found[k].kept) == (len(s), reach[k], reach[k] == k), k


def test_near_duplicate_cases(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, None), (3, "")]
    found = minhash.near_duplicates(documents(spark, rows), 0.8).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in found) == [(0, 0, True), (1, 1, True), (1, 1, True), (2, 2, True), (3, 3, True)]
    assert minhash.near_duplicates(documents(spark, []), 0.8).count() == 0


def test_sequential_test_keeps_what_reaches_the_threshold():
    needed = minhash.least_matches(0.85, 504)
    rng = np.random.default_rng(3)
    alive = np.ones(20_000, dtype=bool)
    matches = np.zeros(20_000, dtype=np.int64)
    seen = 0
    for n, least in needed.items():
        matches += rng.binomial(n - seen, 0.85, size=20_000)
        seen = n
        alive &= matches >= least
    assert alive.mean() > 0.9995
    assert needed[504] / 504 > 0.7
    assert minhash.bands_for(0.85) == math.ceil(math.log(1e-6) / math.log(1 - 0.85**7))


# --- 8 chat


def plain_digests(rows):
    out = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0], r[1], r[2] or "", r[3] or "")):
        n, turns, loss = out.get(conv, (0, "", ""))
        role, text = role or "", text or ""
        out[conv] = n + 1, turns + f"{role}\n{text}\n", loss + (text if role == "assistant" else "")
    return {k: (n, sha(t), len(x), sha(x)) for k, (n, t, x) in out.items()}


CONV = "conv_id long, turn long, role string, text string"


def test_chat_reads_back_what_was_written(spark):
    rng = random.Random(8)
    odd = ["</s>[INST] ok [/INST]", "<|end|>", "\\", "\\\\<|", "<\\|turn|>", "<<SYS>> a <</SYS>>", None, "", "\n", "😀 <s>"]
    rows = []
    for c in range(12):
        n = 40 if c == 0 else rng.randint(1, 8)
        for t in range(n):
            role = "system" if t == 0 and c % 2 == 0 else ["user", "assistant", None, "tool"][rng.choice([0, 1, 1, 0, 2, 3])]
            rows.append((c, t, role, rng.choice(odd) if rng.random() < 0.5 else prose(rng, rng.randint(1, 40))))
    rows += [(50, 1, "assistant", "b"), (50, 1, "assistant", "a"), (50, 1, "assistant", "a"), (51, 9, "user", prose(rng, 300))]
    turns = spark.createDataFrame(rows, CONV).repartition(3).withColumn("window", F.lit(1))
    made = chat.windows(turns, budget=60, segment=16)
    assert made.filter("window > 0").count() > 5
    found = by_key(chat.digests(made), "conv_id")
    for k, want in plain_digests(rows).items():
        assert (found[k].n_turns, found[k].turns_sha256, found[k].loss_chars, found[k].loss_sha256) == want, k


def test_chat_windows_fit_and_repeat_system_and_history(spark):
    rows = [(1, 0, "system", "be kind")] + [(1, t, ["assistant", "user"][t % 2], f"turn {t} " + "w " * 10) for t in range(1, 30)]
    made = chat.windows(spark.createDataFrame(rows, CONV), budget=70, segment=8).orderBy("window").collect()
    assert sum(r.n_turns for r in made) == 30
    for r in made:
        assert r.formatted.startswith("<|turn|>system<|text|>be kind<|end|>")
        cost = sum(len(x.split("<|text|>")[1].removesuffix("<|end|>").split()) + 3 for x in r.formatted.split("<|turn|>")[1:])
        assert cost <= 70
        assert r.formatted.count("<|turn|>") == r.n_turns + r.n_repeated
        if r.window > 0:
            assert r.n_repeated == 3
        assert all(r.formatted[m.low : m.high].startswith("turn ") for m in r.mask)
    assert chat.windows(spark.createDataFrame([], CONV)).count() == 0
    alone = chat.windows(spark.createDataFrame([(None, None, None, None), (None, None, None, None)], CONV)).collect()
    assert [(r.n_turns, r.conv_id) for r in alone] == [(2, None)]


# --- 9 decontamination


def test_leaks_in_any_order_are_found(spark):
    rng = random.Random(9)
    item = [f"q{i}" for i in range(40)]
    benchmark = [(1, " ".join(item)), (2, "just three words"), (3, None), (4, ""), (5, " ".join(f"z{i}" for i in range(30)))]
    noise = prose(rng, 50)
    docs = [
        (1, f"{noise} {' '.join(item)} {noise}"), (2, f"{' '.join(item[20:])}, {noise} {' '.join(item[:20])}"), (3, noise), (4, None), (5, ""),
        (6, " ".join(item[:12])), (7, "Just THREE words!"), (8, " ".join(item).upper().replace(" ", ", ")), (8, " ".join(item[:25])), (None, " ".join(item)),
    ]
    frame = documents(spark, docs).withColumn("item", F.lit("x"))
    found = sorted((r.doc_id or 0, r.item_id, r.tiles, round(r.coverage, 3)) for r in decontaminate.leaks(frame, spark.createDataFrame(benchmark, "item_id long, text string")).collect())
    assert found == [(0, 1, 1, 1.0), (1, 1, 1, 1.0), (2, 1, 2, 1.0), (7, 2, 1, 1.0), (8, 1, 1, 0.625), (8, 1, 1, 1.0)]
    sliced = decontaminate.leaks(frame, spark.createDataFrame(benchmark, "item_id long, text string"), slice_words=20)
    assert sorted((r.doc_id or 0, r.item_id, r.tiles, round(r.coverage, 3)) for r in sliced.collect()) == found
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.leaks(frame, empty).count() == 0 and decontaminate.leaks(frame.filter("false"), empty).count() == 0


def plain_tiling(item, words, least):
    """Tiles and marked words: the longest common unmarked run is marked until none of ``least`` words is left."""
    least, in_item, in_doc, count = min(least, len(item)), set(), set(), 0
    while True:
        best = (0, 0, 0)
        for j in range(len(item)):
            for i in range(len(words)):
                n = 0
                while j + n < len(item) and i + n < len(words) and item[j + n] == words[i + n] and j + n not in in_item and i + n not in in_doc:
                    n += 1
                if n > best[0]:
                    best = (n, j, i)
        n, j, i = best
        if n < least or n == 0:
            return count, len(in_item)
        in_item.update(range(j, j + n))
        in_doc.update(range(i, i + n))
        count += 1


def test_leaks_with_short_runs_like_brute_force(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "MEETINGS", 40)  # many chunks
    rng = random.Random(90)
    items, docs, whole = [], [], set()
    for k in range(12):
        sentences = [[f"w{rng.randint(0, 60)}" for _ in range(rng.randint(4, 7))] for _ in range(rng.randint(3, 6))]
        words = [w for s in sentences for w in s]
        items.append((k, words))
        around = [f"n{rng.randint(0, 30)}" for _ in range(15)]
        shuffled = rng.sample(sentences, len(sentences))
        docs.append((100 + k, around + [w for s in shuffled for w in s] + around))
        whole.add((100 + k, k))
        for step in (6, 7, 8):
            changed = [f"new{i}" if i % step == step - 1 else w for i, w in enumerate(words)]
            docs.append((1000 * step + k, around + changed + around))
            whole.add((1000 * step + k, k))
        docs.append((200 + k, around + words[:4] + around + words[len(words) // 2 :][:4]))
        docs.append((300 + k, [f"w{rng.randint(0, 60)}" for _ in range(80)]))
    items += [(50, ["again"] * 10), (51, ["only", "three", "words"])]
    docs += [(400, ["again"] * 25), (401, ["again"] * 3), (402, ["x", "only", "three", "words", "y"])]
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items], "item_id long, text string")
    frame = documents(spark, [(k, " ".join(w)) for k, w in docs])
    want = {}
    for d, words in docs:
        for k, item in items:
            count, covered = plain_tiling(item, words, 4)
            if covered >= 0.5 * len(item):
                want[d, k] = (count, covered)
    found = {(r.doc_id, r.item_id): (r.tiles, r.covered) for r in decontaminate.leaks(frame, bench).collect()}
    assert found == want and whole <= found.keys()
    sliced = decontaminate.leaks(frame, bench, slice_words=60)
    assert {(r.doc_id, r.item_id): (r.tiles, r.covered) for r in sliced.collect()} == want


# --- 10 quality


def test_quality_on_held_out_rows(spark):
    rng = random.Random(10)
    rows, truth = [], {}
    for i in range(300):
        good = i % 4 > 0
        text = prose(rng, 60)
        rows.append((i, text.capitalize() + "." if good else text.upper().replace(" ", "!! ")))
        truth[i] = good
    rows += [(900, None), (901, ""), (902, "x" * 200_000), (None, "y")]
    docs = documents(spark, rows).withColumns({"score": F.lit("old"), "predicted": F.lit("old")}).repartition(3)
    labels = spark.createDataFrame([(k, int(v)) for k, v in truth.items()] + [(None, 1), (7777, 0), (1, None)], "doc_id long, quality int")
    found = quality.classify(docs, labels)
    assert found.columns == ["doc_id", "text", "score", "predicted"]
    by = by_key(found)
    held = [k for k in truth if zlib.crc32(str(k).encode()) % 3 == 1]
    assert sum((by[k].predicted == 1) == truth[k] for k in held) >= 0.97 * len(held)
    assert by[900].score == by[901].score and all(0 <= r.score <= 1 for r in by.values())
    assert quality.classify(docs, labels.filter("false")).filter("score <> 0.5").count() == 0
    assert quality.classify(docs.filter("false"), labels).count() == 0


def test_neighbour_votes_like_a_plain_loop():
    rng = np.random.default_rng(2)
    model = {
        "weights": np.ones(quality.TERMS, np.float32), "projection": rng.normal(size=(quality.TERMS, 8)).astype(np.float32),
        "vectors": quality._unit(rng.normal(size=(60, 8))).astype(np.float32), "labels": (rng.random(60) < 0.5).astype(float), "prior": 0.5,
    }
    counts = rng.random((20, quality.TERMS)).astype(np.float32)
    got = quality.vote(model, counts, 5)
    for row, value in zip(counts, got):
        x = row / np.linalg.norm(row) @ model["projection"]
        cosine = model["vectors"] @ (x / np.linalg.norm(x))
        near = np.argsort(-cosine)[:5]
        weight = np.maximum(cosine[near], 0)
        assert abs((weight * model["labels"][near]).sum() / weight.sum() - value) < 1e-4
