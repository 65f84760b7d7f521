"""Pairs are found by their hash, and what is remembered is one array of ids."""

import numpy as np

from tests.llm.test_merge_dropout import TABLES
from textlab.llm.merge_dropout import Encoder


def test_pairs_found_by_hash():
    at, found = TABLES.find(TABLES.pair_key)
    assert found.all() and (at == np.arange(len(at))).all()
    keys = np.random.default_rng(1).integers(0, TABLES.size ** 2, 200_000)
    assert (TABLES.find(keys)[1] == np.isin(keys, TABLES.pair_key)).all()


def test_remembered_ids_stand_in_one_array():
    encoder = Encoder(TABLES, 0.2, 1)
    text = " ".join(["international", "the", "x" * 40, "seldom"] * 40)
    first = encoder.encode([text, "", "a  b"], [1, 2, 3])
    assert encoder.memo and sum(p & 0xFFFFFFFF for p in encoder.memo.values()) == encoder.n_ids
    assert encoder.encode([text, "", "a  b"], [1, 2, 3]) == first == Encoder(TABLES, 0.2, 1, memo_words=2).encode([text, "", "a  b"], [1, 2, 3])
