import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from cardmill.llm import decontaminate, pieces, substrings
from cardmill.llm import text as tx

from .helpers import shingles

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbé \n\t", max_size=40)), min_size=0, max_size=6)


def split(texts):
    return tx.flat(pa.array(texts, pa.string()))


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_shingle_sets_have_the_sizes_of_plain_python(texts):
    data, offsets = split(texts)
    values, rows = tx.distinct(*tx.shingles(*tx.words(data, offsets)[:2], 5))
    assert np.bincount(rows, minlength=len(texts)).tolist() == [len(shingles(t)) for t in texts]


@settings(max_examples=40, deadline=None)
@given(TEXTS)
def test_equal_shingles_have_equal_hashes(texts):
    data, offsets = split(texts + texts)
    values, rows = tx.distinct(*tx.shingles(*tx.words(data, offsets)[:2], 5))
    n = len(texts)
    for i in range(n):
        assert values[rows == i].tolist() == values[rows == i + n].tolist()


def test_slices_take_whole_rows_and_a_long_row_alone():
    data, offsets = split(["a" * 10, "", "b" * 100, "c"])
    assert list(tx.slices(offsets, 50)) == [(0, 2), (2, 3), (3, 4)]
    assert list(tx.slices(split([])[1], 50)) == []


def test_flat_reads_a_slice_of_an_array():
    data, offsets = tx.flat(pa.array(["xx", "abc", None, "d"]).slice(1, 3))
    assert data.tobytes() == b"abcd" and offsets.tolist() == [0, 3, 3, 4]


def test_groups_go_on_over_batches():
    batches = [pa.RecordBatch.from_pydict({"k": [1, 1, 2], "v": [1, 2, 3]}), pa.RecordBatch.from_pydict({"k": [2, 3], "v": [4, 5]})]
    assert [(k, t.column("v").to_pylist()) for k, t in tx.groups(batches, 1)] == [((1,), [1, 2]), ((2,), [3, 4]), ((3,), [5])]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=24), min_size=1, max_size=12), st.data())
def test_multikey_sort_orders_and_counts_common_bytes(strings, data):
    group = np.array([data.draw(st.integers(0, 1)) for _ in strings])
    padded = [s.ljust(24, b"\0") for s in strings]
    order, common = substrings.multikey_order(group, substrings._padded(strings, 24))
    assert [(group[i], padded[i]) for i in order] == sorted(zip(group, padded))
    for n in range(1, len(order)):
        a, b = order[n - 1], order[n]
        same = next((k for k in range(24) if padded[a][k] != padded[b][k]), 24)
        assert common[n] == (same if group[a] == group[b] else -1)


def test_tiling_marks_the_longest_first_and_never_twice():
    # item 0..9, document: items 0-5, then items 3-9
    runs = [(6, 0, 0), (7, 3, 10)]
    assert decontaminate.tiles(runs, 3) == (2, 10)
    assert decontaminate.tiles(runs, 4) == (1, 7)
    assert decontaminate.tiles([], 3) == (0, 0)


def test_diagonal_runs_join_neighbouring_seeds():
    assert sorted(decontaminate.diagonal_runs([(0, 5), (1, 6), (4, 9), (1, 20)], 3)) == [(3, 1, 20), (3, 4, 9), (4, 0, 5)]


def _vocabulary(alpha=1.0):
    with open(pieces.MODEL, "rb") as f:
        return pieces.Vocabulary(f.read(), alpha)


def test_pieces_give_back_any_text():
    v = _vocabulary()
    texts = ["", None, "hello world", "  two  spaces ", "▁ \n\t\r", "ü 漢字 😀", "x" * 3000, "a", " "]
    data, offsets = split(texts)
    for seed in (0, 1):
        ids, bound = pieces.piece_ids(v, data, offsets, np.arange(len(texts)), seed)
        for i, t in enumerate(texts):
            assert b"".join(v.bytes[j] for j in ids[bound[i] : bound[i + 1]]).decode() == (t or "")


def test_sampled_segmentations_follow_their_weights():
    v, word, n = _vocabulary(), "then he", 20_000
    known = {b: i for i, b in enumerate(v.bytes) if len(b) and i > 258}

    def ways(rest):
        if not rest:
            yield ()
        for k in range(1, len(rest) + 1):
            if rest[:k] in known:
                for more in ways(rest[k:]):
                    yield (known[rest[:k]], *more)

    all_ways = list(ways(word.encode()))
    weight = np.exp([v.weights[list(w)].sum() for w in all_ways])
    share = dict(zip(all_ways, weight / weight.sum()))
    data, offsets = split([word] * n)
    ids, bound = pieces.piece_ids(v, data, offsets, np.arange(n), 0)
    drawn = [tuple(ids[bound[i] : bound[i + 1]]) for i in range(n)]
    assert set(drawn) <= set(all_ways)
    for way, p in share.items():
        assert abs(drawn.count(way) / n - p) < 4 * (p * (1 - p) / n) ** 0.5 + 1e-3


def test_a_row_is_segmented_alike_wherever_it_stands():
    v = _vocabulary()
    text = "some words that can be cut in several ways " * 5
    one = pieces.piece_ids(v, *split([text]), np.array([7]), 0)[0]
    ids, bound = pieces.piece_ids(v, *split(["before", text, "after"]), np.array([1, 7, 9]), 0)
    assert ids[bound[1] : bound[2]].tolist() == one.tolist()
    other = pieces.piece_ids(v, *split([text]), np.array([8]), 0)[0]
    assert other.tolist() != one.tolist()
