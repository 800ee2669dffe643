"""Families of near duplicates that only some of their pairs hold together."""

import random

import numpy as np
import pytest

import corpus_pipeline
from larch.llm import near_dedup
from larch.llm.shingles import multiset_overlap, shingles


def _edited(words, edits, rng):
    out = list(words)
    for k in rng.sample(range(len(words) // 5), edits):
        out[5 * k + 2] = f"e{rng.random()}"
    return " ".join(out)


def _classes(texts):
    """The smallest place of each text's class, by all pairs."""
    bags, root = [shingles(t) for t in texts], list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(bags):
        for j in range(i):
            if (ri := find(i)) != (rj := find(j)):
                both, either = multiset_overlap(a, bags[j])
                if 5 * both >= 4 * either:
                    root[max(ri, rj)] = min(ri, rj)
    return [find(i) for i in range(len(texts))]


def _hub(copies):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(400)]
    return [" ".join(words), *(_edited(words, 5, rng) for _ in range(copies))]


def _chain(n):
    words = [f"w{i}" for i in range(400 + 25 * n)]
    return [" ".join(words[25 * i:25 * i + 400]) for i in range(n)]


def _frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)


def test_hub_with_2000_copies_is_one_class(spark):
    rows = near_dedup.near_duplicates(_frame(spark, _hub(2000))).collect()
    assert {r["class_id"] for r in rows} == {0} and sum(r["kept"] for r in rows) == 1


@pytest.mark.parametrize("nodes", [3, 512])
def test_families_equal_all_pairs(spark, monkeypatch, nodes):
    """Without a hub, in a chain and beside others, in blocks of any size."""
    monkeypatch.setattr(near_dedup, "BLOCK_NODES", nodes)
    rng = random.Random(3)
    near = [_edited([f"v{i}" for i in range(400)], 6, rng) for _ in range(60)]
    texts = [*_hub(60)[1:], *_chain(60), *near, *(" ".join(t.split() * 2) for t in near[:9])]
    rows = near_dedup.near_duplicates(_frame(spark, texts)).collect()
    assert {r["doc_id"]: r["class_id"] for r in rows} == dict(enumerate(_classes(texts)))


def test_pipeline_keeps_one_of_each_class(spark):
    texts = [*_hub(300), *_chain(40)]
    stage = dict(corpus_pipeline.STAGES)["near_dedup"]
    kept = [r["doc_id"] for r in stage(spark, _frame(spark, texts), "").collect()]
    assert sorted(kept) == sorted(set(_classes(texts)))


def test_similar_equals_the_overlap_of_multisets():
    rng = np.random.default_rng(5)
    bags = []
    for _ in range(60):
        h = np.unique(rng.integers(1, 40, 36).astype(np.uint64))
        bags.append((h, rng.integers(1, 4, len(h))))
    bags += [(h, np.where(np.arange(len(c)) < 2, c + 1, c)) for h, c in bags]
    sets = [near_dedup.elements(b) for b in bags]
    got = near_dedup.similar(sets[:60], sets[60:])
    for i in range(60):
        for j in range(60):
            both, either = multiset_overlap(bags[i], bags[60 + j])
            assert got[i, j] == (5 * both >= 4 * either)
    assert got.any() and not got.all()
