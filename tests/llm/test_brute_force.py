"""Registered queries over whole small tables against brute force."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np

import corpus_pipeline
from larch.llm import catalog
from larch.llm.shingles import multiset_overlap, shingles
from larch.llm.tokens import tokenizer_path
from tests.conftest import SF001, SF01


def _tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = True
    return t


def test_html_keeps_the_article_and_nothing_else(spark):
    import html
    import re

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF001}/pages.parquet").collect()}
    for r in catalog.QUERIES["op1_html_extraction"](spark, SF001).collect():
        inside = re.search(r"<article>(.*)</article>", pages[r["page_id"]], re.S).group(1)
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", inside))
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


def test_repeated_strings(spark, small_docs):
    size, texts = 400, {d: (t or "").encode() for d, t, *_ in small_docs}
    seen = Counter(hash(t[i:i + size]) for t in texts.values() for i in range(len(t) - size + 1))
    rows = {r["doc_id"]: r for r in catalog.QUERIES["op2_substring_dedup"](spark, SF001).collect()}
    removed = 0
    for d, t in texts.items():
        gone = np.zeros(len(t), dtype=bool)
        for i in range(len(t) - size + 1):
            if seen[hash(t[i:i + size])] > 1:
                gone[i:i + size] = True
        left = bytes(np.frombuffer(t, dtype=np.uint8)[~gone])
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        assert (rows[d]["n_bytes"], rows[d]["n_removed"], rows[d]["n_spans"], rows[d]["kept_sha256"]) == (
            len(t), int(gone.sum()), spans, hashlib.sha256(left).hexdigest())
        removed += int(gone.sum())
    assert removed


def test_hot_anchors_give_the_same(spark):
    from larch.llm.substring_dedup import remove_repeated

    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    assert sorted(remove_repeated(docs, hot_cells=0).collect()) == sorted(remove_repeated(docs, bucket_bytes=50_000).collect())


def test_quality_agrees_with_the_labels(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    good, bad = [], []
    for r in catalog.QUERIES["op3_quality_rules"](spark, SF01).collect():
        if r["doc_id"] in labels and not r["base_failed"]:
            (good if labels[r["doc_id"]] else bad).append(r["kept"])
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.1


def test_near_classes(spark, small_docs):
    bags = {d: shingles(t) for d, t, *_ in small_docs}
    holders, root = defaultdict(list), {d: d for d in bags}
    for d, (h, _) in bags.items():
        for x in h.tolist():
            holders[x].append(d)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    pairs = {(a, b) for ds in holders.values() for i, a in enumerate(ds) for b in ds[i + 1:]}
    for a, b in pairs:
        both, either = multiset_overlap(bags[a], bags[b])
        if 5 * both >= 4 * either:
            root[max(find(a), find(b))] = min(find(a), find(b))
    rows = catalog.QUERIES["op4_near_dedup"](spark, SF001).collect()
    assert {r["doc_id"]: r["class_id"] for r in rows} == {d: find(d) for d in bags}
    assert all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in rows) and any(r["class_size"] > 1 for r in rows)


def test_mixing_meets_its_targets(spark):
    rows = catalog.QUERIES["op5_source_mixing"](spark, SF01).toPandas()
    total = rows["tokens"].sum()
    for d in ("source", "lang", "topic"):
        have = rows["tokens"].groupby(rows[d]).sum()
        want = have ** 0.7 / (have ** 0.7).sum() * 0.6 * total
        got = (rows["tokens"] * rows["probability"]).groupby(rows[d]).sum()
        assert (abs(got / want - 1) < 0.02).mean() > 0.9
    assert abs(rows.loc[rows["sampled"], "tokens"].sum() / total - 0.6) < 0.06


def test_token_files_round_trip(spark, small_docs):
    t, start = _tokenizer(), 0
    rows = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in catalog.QUERIES["op6_arrow_tokens"](spark, SF001).collect()}
    for d, text, *_ in small_docs:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        assert rows[d] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def _check_packing(pieces, texts):
    t, by_doc, by_sequence, total = _tokenizer(), defaultdict(list), defaultdict(list), 0
    for r in pieces:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(by_doc) == set(texts)
    for d, text in texts.items():
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        at, total = 0, total + len(ids)
        for k, r in enumerate(sorted(by_doc[d], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (k, at) and r["length"] <= 1024 and (k == 0 or r["length"] == 1024)
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(by_sequence) <= 1.02 * -(-total // 1024) + 1


def test_packing(spark, small_docs):
    _check_packing(catalog.QUERIES["op8_pattern_packing"](spark, SF001).collect(), {d: t for d, t, *_ in small_docs})


def test_languages_of_held_out_documents(spark):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    rows = [r for r in catalog.QUERIES["op10_language_id"](spark, SF01).collect() if r["held_out"] and truth[r["doc_id"]]]
    assert rows and np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in rows]) > 0.98


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r for r in docs.collect()}
        docs = corpus_pipeline.materialize(stage(spark, docs, SF001), f"test_{name}")
        rows = docs.collect()
        assert docs.columns == columns and all(before[r["doc_id"]] == r for r in rows) and len({r["doc_id"] for r in rows}) == len(rows)
        kept[name] = [before, {r["doc_id"] for r in rows}]
    before, after = kept["language_id"]
    assert all(any(map(str.isalpha, before[d]["text"] or "")) for d in after)
    before, after = kept["exact_dedup"]
    squeezed = {d: "".join((r["text"] or "").translate({c: None for c in (32, 9, 10, 11, 12, 13)})) for d, r in before.items()}
    assert sorted(Counter(squeezed[d] for d in after).items()) == sorted((t, 1) for t in set(squeezed.values()))
    before, after = kept["near_dedup"]
    bags = {d: shingles(r["text"]) for d, r in before.items()}
    for d in set(before) - after:
        overlaps = (multiset_overlap(bags[d], bags[o]) for o in before if o != d)
        assert any(5 * both >= 4 * either for both, either in overlaps)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    _check_packing(corpus_pipeline.STAGES[-1][1](spark, docs, SF001).collect(), texts)
