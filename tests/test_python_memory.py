"""Python tasks hold a bounded part of a batch."""

import pandas as pd
import pyarrow as pa

from textlab.functions import stem as ST
from textlab.operators import augment as AG


def test_lists_are_stemmed_by_their_distinct_words(monkeypatch):
    seen = []
    original = ST._stem_cached
    monkeypatch.setattr(ST, "_stem_cached", lambda w: (seen.append(w), original(w))[1])
    lists = [["häuser", "laufen"], None, [], ["laufen"] * 5000, ["häuser", None]]
    got = ST._stem_lists(pa.array([["x"]] + lists, pa.list_(pa.string()))[1:]).to_pylist()
    assert got == [None if a is None else [None if w is None else ST.german_stem(w) for w in a] for a in lists]
    assert sorted(seen) == ["häuser", "laufen"]


def test_rewriting_takes_a_part_of_a_batch_at_a_time():
    sizes = []

    def rewriter(texts, attempt):
        sizes.append(len(texts))
        return AG.drop_every_fourth(texts, attempt)

    batch = pd.DataFrame({"id": range(1000), "_src": [f"a b c d e f g {i}" for i in range(1000)], "_meta": None})
    got = pd.concat(AG._rewrite_partition(rewriter, AG.word_overlap_score, 0.5, 2)(iter([batch])))
    assert max(sizes) <= AG.REWRITE_ROWS and list(got["id"]) == list(range(1000))
    assert list(got["_new"]) == AG.drop_every_fourth(batch["_src"], 0).tolist()
