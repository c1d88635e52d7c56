"""The registered queries that SQL cannot express, against plain Python on the smallest tables."""

import re
import zlib

import pytest

from cardmill.llm.queries import ORACLES, QUERIES

from .helpers import by_key
from .test_operators import plain_digests

FOLDER = "/root/testdata/sf0.001"


def table(spark, name):
    return spark.read.parquet(f"{FOLDER}/{name}.parquet")


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in table(spark, "documents").collect()}


def test_every_operator_has_one_query():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)


def test_op3_round_trip(spark, texts):
    found = QUERIES["op3_pieces"](spark, FOLDER).collect()
    assert len(found) == len(texts) and all(r.lossless and r.n_pieces == len(r.pieces) for r in found)


@pytest.mark.parametrize("name,label,limit", [("op5_toxicity", "toxic", 0.7), ("op10_quality", "quality", 0.5)])
def test_scores_and_folds(spark, texts, name, label, limit):
    found = by_key(QUERIES[name](spark, FOLDER))
    assert found.keys() == texts.keys()
    for k, r in found.items():
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= limit)
        assert r.held_out == (zlib.crc32(str(k).encode()) % 3 == 1)
    truth = {r.doc_id: r[label] for r in table(spark, "labels").collect()}
    held = [k for k in truth if found[k].held_out]
    assert sum(found[k].predicted == truth[k] for k in held) >= 0.85 * len(held)


def test_op6_laws(spark, texts):
    found = by_key(QUERIES["op6_sharding"](spark, FOLDER))
    assert found.keys() == texts.keys()
    slots = {}
    for k, r in found.items():
        data = (texts[k] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 8, zlib.crc32(data), "bytes", None)
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(slots) <= set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_op8_digests(spark):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in table(spark, "conversations").collect()]
    probe = "</s>[INST] ok [/INST]"
    want = plain_digests([*rows, (-1, 0, "user", probe), (-1, 1, "assistant", probe)])
    found = by_key(QUERIES["op8_chat"](spark, FOLDER), "conv_id")
    assert {k: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for k, r in found.items()} == want
    assert all(r.formatted_chars > r.loss_chars for r in found.values())


def test_op9_finds_whole_items(spark, texts):
    def words(text):
        return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", (text or "").lower())

    items = {r.item_id: " ".join(words(r.text)) for r in table(spark, "benchmark").collect()}
    plain = {k: f" {' '.join(words(t))} " for k, t in texts.items()}
    want = {(k, i) for k, t in plain.items() for i, item in items.items() if item and f" {item} " in t}
    found = QUERIES["op9_decontaminate"](spark, FOLDER).collect()
    assert {(r.doc_id, r.item_id) for r in found if r.coverage == 1.0} >= want
    assert {r.doc_id for r in found if r.coverage == 1.0 and r.tiles == 1} == {k for k, _ in want}
