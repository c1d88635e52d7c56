"""Distinct words that a polynomial modulo 2^64 cannot tell apart, and vectors whose keys are repeated."""

import numpy as np
import pyarrow as pa
import pytest

from cardmill.llm import pieces, substrings
from cardmill.llm import text as tx
from cardmill.llm.minhash import near_duplicates
from cardmill.llm.vectors import near_vectors

from .helpers import by_key, documents, removed_bytes


def thue_morse(length, swap=False):
    return "".join("ab"[(bin(i).count("1") + swap) % 2] for i in range(length))


def hashes(texts, kind=0, lower=True):
    data, offsets = tx.flat(pa.array(texts))
    return tx.span_hashes(data, offsets[:-1], offsets[1:], lower, kind)


@pytest.mark.parametrize("length", [1024, 2048, 4096])
@pytest.mark.parametrize("kind", [0, 1])
def test_thue_morse_words_differ(length, kind):
    one, other = hashes([thue_morse(length), thue_morse(length, True)], kind)
    assert one != other
    data, offsets = tx.flat(pa.array([thue_morse(length), thue_morse(length, True)]))
    short = tx.short_hashes(data, offsets[:-1], offsets[1:])
    assert length < 2048 or short[0] == short[1]  # what the other hash is there for


def test_hashes_of_equal_ranges_are_equal_wherever_they_stand():
    rng = np.random.default_rng(1)
    texts = ["".join(rng.choice(list("abé\0 Z"), rng.integers(0, 40))) for _ in range(400)]
    for kind in (0, 1):
        found = hashes(texts + texts[::-1], kind, lower=False)
        assert (found[:400] == found[400:][::-1]).all() and len(set(found.tolist())) == len(set(texts))
    assert (hashes(["AbC", "é"]) == hashes(["aBc", "é"])).all() and hashes(["AbC"], lower=False) != hashes(["abc"], lower=False)
    full = [t for t in texts if t]
    assert (hashes(full) != hashes(full, 1)).all()


def test_long_slices_give_the_same_hashes():
    data = np.frombuffer(b"abcdefgh" * (1 << 21), dtype=np.uint8)
    assert len(data) == 1 << 24
    at = np.array([0, 8, len(data) - 16])
    assert len(set(tx.span_hashes(data, at, at + 16).tolist())) == 1
    assert tx.span_hashes(data, at, at + 16)[0] == tx.span_hashes(data[:16], np.array([0]), np.array([16]))[0]


def test_pieces_are_lossless_for_colliding_words(spark):
    rows = [(i, t) for i, t in enumerate([thue_morse(1024), thue_morse(1024, True), f"x {thue_morse(2048)} y", f"x {thue_morse(2048, True)} y"])]
    model = pieces.model_bytes(spark)
    docs = documents(spark, rows).coalesce(1)
    assert {r.doc_id: r.decoded for r in pieces.decode(pieces.encode(docs, model), model).collect()} == dict(rows)


def test_pieces_are_coded_and_decoded_by_one_worker(spark):
    rows = [(0, None), (1, ""), (2, "some \u2581 words, some words"), (None, "no key"), (4, "x" * 3000 + " \u00e9\U0001f600")]
    model, docs = pieces.model_bytes(spark), documents(spark, rows)
    both, apart = pieces.encode_and_decode(docs, model), pieces.decode(pieces.encode(docs, model), model)
    assert both.columns == apart.columns and both.exceptAll(apart).isEmpty() and apart.exceptAll(both).isEmpty()
    assert both._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert pieces.encode_and_decode(documents(spark, []), model).count() == 0


def test_kinds_are_checked_byte_by_byte(monkeypatch):
    monkeypatch.setattr(tx, "span_hashes", lambda data, starts, ends, lower=True, kind=0: np.zeros(len(starts), np.uint64))
    data = np.frombuffer(b"ab ab abc xy ab", dtype=np.uint8)
    starts, ends = np.array([0, 2, 5, 9, 12]), np.array([2, 5, 9, 12, 15])
    one, kind = pieces._kinds(data, starts, ends)
    assert [data[starts[i] : ends[i]].tobytes() for i in one[kind]] == [data[s:e].tobytes() for s, e in zip(starts, ends)]


def test_near_duplicates_do_not_link_colliding_words(spark):
    rows = [(1, thue_morse(1024)), (2, thue_morse(1024, True)), (3, thue_morse(2048)), (4, thue_morse(2048, True)), (5, thue_morse(1024))]
    found = by_key(near_duplicates(documents(spark, rows), 0.85))
    assert {k: r.component_id for k, r in found.items()} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 1}


def test_contexts_are_hashed_twice_independently():
    data, _ = tx.flat(pa.array([thue_morse(4096) + thue_morse(4096, True)]))
    one, two = substrings._context_hashes(data, np.array([0, 4096]), np.array([3896, 7992]), 200)
    assert one[0] != one[1] and two[0] != two[1]


def test_repeated_bytes_of_colliding_texts(spark):
    texts = {1: thue_morse(2048), 2: thue_morse(2048, True)}
    found = by_key(substrings.remove_repeats(documents(spark, list(texts.items())), length=200))
    assert {k: r.n_removed for k, r in found.items()} == {k: len(v) for k, v in removed_bytes(texts, 200).items()}


def plain_links(rows, threshold):
    usable = [(i, label, np.array(v, float)) for i, (_, label, v) in enumerate(rows) if label is not None and v is not None and np.isfinite(v).all() and np.any(v)]
    unit = {i: (label, (v / np.abs(v).max()) / np.linalg.norm(v / np.abs(v).max())) for i, label, v in usable}
    near = {i: {j for j in unit if j != i and unit[i][0] == unit[j][0] and unit[i][1] @ unit[j][1] >= threshold} for i in unit}
    out = []
    for i, (key, _, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near.get(todo.pop(), set()) - seen:
                seen.add(j)
                todo.append(j)
        keys = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((key, len(near.get(i, ())), min(keys) if key is not None else None))
    return sorted(out, key=str)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")


def test_vectors_with_repeated_and_null_keys(spark):
    e2 = [0.0, 1.0]
    rows = [(1, 0, [1.0, 0.0]), (5, 0, [1.0, 0.0]), (1, 0, e2), (7, 0, e2), (8, 0, [0.0, 1.0001]), (9, 0, [0.0, 0.9999])]
    rows += [(None, 0, [1.0, 0.01]), (10, 0, [1.0, 0.02]), (None, 1, [3.0, 3.0]), (None, 1, [3.0, 3.0]), (11, 1, None), (12, None, e2)]
    found = near_vectors(vectors(spark, rows), 0.93).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in found), key=str) == plain_links(rows, 0.93)


def test_vectors_of_any_size(spark):
    rows = [(1, 0, [1e300, 1e300]), (2, 0, [1e-300, 1e-300]), (3, 0, [1.0, 1.0]), (4, 0, [1e300, -1e300]), (5, 0, [0.0, 0.0]), (6, 0, [5e-324, 5e-324])]
    found = near_vectors(vectors(spark, rows), 0.93).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in found), key=str) == plain_links(rows, 0.93)
