"""Spelling variants, tokenizer alignment and language-model scores against brute force,
and their edge cases."""

import hashlib
import math
import os
import subprocess
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from larch.llm import alignment, catalog, language_scoring, recurrent, spelling
from larch.llm.tokens import tokenizer_path
from tests.conftest import SF001
from tests.llm.conftest import ROWS


# ---- operator 11 ---------------------------------------------------------------

def brute_words(docs):
    counts = Counter()
    lower = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
    letters = {*map(chr, range(65, 91)), *map(chr, range(97, 123)), *map(chr, range(0xC0, 0x100))}
    for doc_id, text in docs:
        for run in "".join(c if c in letters else " " for c in text or "").split(" "):
            if run := run.translate(lower):
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(words):
    near = defaultdict(set)
    keyed = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            keyed[w[:i] + "*" + w[i + 1:]].add(w)
            if (short := w[:i] + w[i + 1:]) in words:
                near[w].add(short)
                near[short].add(w)
    for group in keyed.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w in words:
        if near[w]:
            best = min(near[w], key=lambda v: (-words[v], v))
            if words[best] >= 2 * words[w]:
                form[w] = best
    out = {}
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n, len(near[w]), words.get(form.get(w)))
    return out


def _variants(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def test_spelling_variants(spark, small_docs):
    expected = brute_variants(brute_words([(d, t) for d, t, *_ in small_docs]))
    assert _variants(catalog.QUERIES["op11_spelling_variants"](spark, SF001)) == expected
    assert sum(v[0] is not None for v in expected.values()) > 50


def test_every_near_pair_of_random_words_is_found(spark):
    """Few letters, so nearly all words are anagrams of others."""
    rng = np.random.default_rng(2)
    words = {"".join(rng.choice(list("abé"), n)): int(c) for n, c in zip(rng.integers(5, 9, 1500), rng.integers(3, 50, 1500))}
    words["a" * 300] = 9
    words["a" * 301] = 4
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(4)
    pairs = {(r["a"], r["b"]) for r in spelling.near_words(df).collect()}
    listed = sorted(words)
    expected = {(a, b) for i, a in enumerate(listed) for b in listed[i + 1:] if one_edit(a, b)}
    assert {tuple(sorted(p)) for p in pairs} == expected and len(pairs) == len(expected)
    assert _variants(spelling.spelling_variants(df)) == brute_variants(words)


def test_spelling_edge_cases(odd_docs, no_docs):
    words = {r["word"]: r["n"] for r in spelling.word_counts(odd_docs).collect()}
    assert words == brute_words([(r[0], r[1]) for r in ROWS])
    assert spelling.spelling_variants(spelling.word_counts(no_docs)).collect() == []


# ---- operator 12 ---------------------------------------------------------------

def brute_alignment(rows):
    """Per row: the contract's numbers, from whole texts."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_tok = Tokenizer.from_file(tokenizer_path(alignment.TOKENS_A))
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(alignment.TOKENS_B))
    t = alignment.Tokenizers(tokenizer_path(alignment.TOKENS_A), tokenizer_path(alignment.TOKENS_B))
    counts, found = Counter(), []
    for _, text in rows:
        a, b = (a_tok.encode(" " + text, add_special_tokens=False).ids, b_tok.encode(text)) if text else ([], [])
        raw = (" " + (text or "")).encode()
        if not text or b"".join(t.bytes_a[x] for x in a) != raw or b"".join(t.bytes_b[x] for x in b) != raw:
            found.append((0, 0, 0, [], ""))
            continue
        ends = [np.cumsum([len(bytes_of[x]) for x in ids]) for bytes_of, ids in ((t.bytes_a, a), (t.bytes_b, b))]
        cuts = np.intersect1d(*ends)
        of = [np.searchsorted(cuts, e) for e in ends]
        groups = ";".join("|".join(",".join(str(x) for x, g in zip(ids, o) if g == k) for ids, o in zip((a, b), of)) for k in range(len(cuts))) \
            if len(cuts) < 400 else None
        owner = [np.repeat(np.arange(len(ids)), np.diff(e, prepend=0)) for ids, e in zip((a, b), ends)]
        links = [(a[i], b[j]) for i, j in sorted(set(zip(owner[0].tolist(), owner[1].tolist())))]
        counts.update(links)
        found.append((len(a), len(b), len(cuts), links, None if groups is None else hashlib.sha256(groups.encode()).hexdigest()))
    top = defaultdict(int)
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    return [(na, nb, ng, len(links), sum(counts[x] == top[x[1]] for x in links), sum(counts[x] for x in links), sha)
            for na, nb, ng, links, sha in found]


def _aligned(df):
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted([(r["doc_id"], *(r[n] for n in names)) for r in df.collect()], key=str)


def _same(got, expected):
    assert len(got) == len(expected)
    for g, e in zip(got, expected):
        assert g[:-1] == e[:-1] and e[-1] in (None, g[-1])


def test_alignment(spark, small_docs):
    rows = [(d, t) for d, t, *_ in small_docs]
    expected = sorted([(d, *x) for (d, _), x in zip(rows, brute_alignment(rows))], key=str)
    _same(_aligned(catalog.QUERIES["op12_token_alignment"](spark, SF001)), expected)


ODD_TEXTS = [None, "", " ", "a ", "  a\n b\t  c 　 d  ", "x▁y z", "<|endoftext|> <s> é é 字字 \x00 \x85 end", "\x1c a\x1c b",
             "a  b 's don't  IT'S   ", "word " * 50, "1234567 12.5 --- ...\n\n\n  x"]


def test_alignment_of_odd_texts(spark, odd_docs, no_docs):
    rows = list(enumerate(ODD_TEXTS))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    _same(_aligned(alignment.align_documents(df)), sorted([(d, *x) for (d, _), x in zip(rows, brute_alignment(rows))], key=str))
    odd = [(r[0], r[1]) for r in ROWS]
    _same(_aligned(alignment.align_documents(odd_docs)), sorted([(d, *x) for (d, _), x in zip(odd, brute_alignment(odd))], key=str))
    assert alignment.align_documents(no_docs).collect() == []


def test_small_blocks_give_the_same(spark, monkeypatch):
    df = spark.read.parquet(f"{SF001}/documents.parquet").limit(60).coalesce(1)
    whole = _aligned(alignment.align_documents(df))
    monkeypatch.setattr(alignment, "BLOCK_CHARS", 20_000)
    monkeypatch.setattr(alignment, "BATCH_PIECES", 100)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    number = alignment.tokenizers(tokenizer_path(alignment.TOKENS_A), tokenizer_path(alignment.TOKENS_B))
    parts = [alignment.align(p, number) for p in alignment._batches(alignment.pieces_of(rows[0][1]))]
    assert sum(len(p.ids_a) for p in parts) == next(x for x in whole if x[0] == rows[0][0])[1]


def test_products_against_dense_matrices():
    rng = np.random.default_rng(4)
    for _ in range(20):
        a, b = ((rng.random((6, 9)) < 0.3).astype(int), (rng.random((9, 5)) < 0.3).astype(int))

        def rows(x):
            at = np.nonzero(x)
            return alignment.Rows(np.concatenate([[0], np.cumsum(x.sum(axis=1))]), at[1], x[at], x.shape[1])

        p = alignment.product(rows(a), rows(b))
        dense = np.zeros((6, 5), dtype=int)
        dense[np.repeat(np.arange(6), np.diff(p.start)), p.column] = p.value
        assert (dense == a @ b).all()
        t = rows(a).transposed()
        assert (np.repeat(np.arange(9), np.diff(t.start)).tolist(), t.column.tolist()) == tuple(x.tolist() for x in np.nonzero(a.T))


def test_overlap_links_hold_the_shared_bytes(spark):
    df = spark.createDataFrame([(1, "unbelievable stories"), (2, None)], "doc_id long, text string")
    rows = alignment.overlap_links(df).collect()
    assert {r["doc_id"] for r in rows} == {1} and sum(r["n_bytes"] for r in rows) == len(" unbelievable stories")


# ---- operator 13 ---------------------------------------------------------------

def tokens(text):
    return (text or "").encode().lower().split() + [b" "]


def brute_base(rows):
    c = Counter()
    for d, t in rows:
        if zlib.crc32(("" if d is None else str(d)).encode()) % 7 != 2:
            c.update(tokens(t))
    n, v = sum(c.values()), len(c)
    return {(d, t): (zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2, len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n,
                     sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens(t))) for d, t in rows}


def _check_base(got, rows):
    expected = sorted([(d, *x) for (d, _), x in zip(rows, [brute_base(rows)[r] for r in rows])], key=str)
    got = sorted([(r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got], key=str)
    assert [g[:5] for g in got] == [e[:5] for e in expected]
    assert all(abs(g[5] - e[5]) <= 1e-9 * abs(e[5]) for g, e in zip(got, expected))


def test_language_scores(spark, small_docs):
    """Counts and base against brute force; held-out documents are more probable than
    under the base."""
    rows = catalog.QUERIES["op13_lm_scoring"](spark, SF001).collect()
    _check_base(rows, [(d, t) for d, t, *_ in small_docs])
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > 0.95 * sum(r["base_score"] for r in held)
    assert all(r["score"] < 0 for r in rows)


def test_language_scores_of_odd_documents(odd_docs, no_docs):
    rows = language_scoring.language_scores(odd_docs).collect()
    _check_base(rows, [(r[0], r[1]) for r in ROWS])
    assert all(math.isfinite(r["score"]) for r in rows)
    assert language_scoring.language_scores(no_docs).collect() == []


def test_nothing_to_learn_a_model_from(spark):
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2][:3]
    df = spark.createDataFrame([(i, f"some words {i}") for i in held], "doc_id long, text string")
    rows = language_scoring.language_scores(df).collect()
    assert all(r["held_out"] and r["train_tokens"] == 0 and r["n_known"] == 0 and r["base_score"] == 0 and math.isfinite(r["score"]) for r in rows)


def _model(hidden=5, n=30, classes=6):
    counts = np.sort(np.random.default_rng(0).integers(1, 100, n))[::-1].astype(float)
    shape = recurrent.Shape(hidden, recurrent.class_bounds(counts, classes))
    return shape, recurrent.initial(shape, counts, 1).astype(np.float64)


def test_probabilities_sum_to_one():
    shape, flat = _model()
    h = np.random.default_rng(1).standard_normal((1, 5))
    p = np.exp(recurrent.Recurrent(shape, flat).log_probability(np.repeat(h, 30, axis=0), np.arange(30)))
    assert abs(p.sum() - 1) < 1e-12 and (p > 0).all()


def test_gradient_is_the_derivative_of_the_loss():
    shape, flat = _model()
    rng = np.random.default_rng(2)
    docs = [rng.integers(0, 30, n).astype("<u2") for n in (7, 3, 11, 1, 0, 5)]
    x, y, fresh, owner = next(recurrent.Streams(docs, 3).windows(9))
    h0 = rng.standard_normal((3, 5))

    def loss(f):
        return recurrent.Recurrent(shape, f).step(x, y, fresh, owner >= 0, h0)[1] / (owner >= 0).sum()

    grad = recurrent.Recurrent(shape, flat).step(x, y, fresh, owner >= 0, h0)[0]
    for i in rng.integers(0, len(flat), 40):
        e = np.zeros_like(flat)
        e[i] = 1e-4
        assert abs((loss(flat + e) - loss(flat - e)) / 2e-4 - grad[i]) < 1e-6


def test_state_is_carried_over_windows():
    """Scores don't depend on windows or streams."""
    shape, flat = _model()
    rng = np.random.default_rng(3)
    docs = [rng.integers(0, 30, n).astype("<u2") for n in (40, 3, 0, 17, 90)]
    model = recurrent.Recurrent(shape, flat)
    whole = recurrent.score(model, docs, 1, 500)
    for streams, steps in ((1, 7), (3, 4), (9, 32)):
        assert np.abs(recurrent.score(model, docs, streams, steps) - whole).max() < 1e-9
    assert whole[2] == 0


def test_windows_reuse_memory():
    """Windows take no new pages from the system: those took a quarter of the time."""
    code = """
import resource
import numpy as np
from larch.llm import recurrent
counts = np.arange(1500, 0, -1.0)
shape = recurrent.Shape(16, recurrent.class_bounds(counts, 32))
model = recurrent.Recurrent(shape, recurrent.initial(shape, counts, 1))
rng = np.random.default_rng(2)
faults = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_minflt
for run in (lambda d: recurrent.train(model, d, 256, 32, 0.01, 512), lambda d: recurrent.score(model, d, 256, 32)):
    seen = []
    for length in (64, 64, 512):
        docs, before = [rng.integers(0, 1500, length).astype("<u2") for _ in range(256)], faults()
        run(docs)
        seen.append(faults() - before)
    print(seen[2] - seen[1])
"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    out = subprocess.run([sys.executable, "-c", code], check=True, capture_output=True, text=True, cwd=root, env=os.environ | {"OMP_NUM_THREADS": "1"})
    for more in out.stdout.split():
        assert int(more) < 14 * 300  # of 14 windows; they have over 2,000 pages each


def test_averages_are_weighted(spark):
    rows = [(k, k + 1, np.full(3, float(k), dtype="<f4").tobytes()) for k in range(70)]
    df = spark.createDataFrame([(a, b, bytearray(c)) for a, b, c in rows], "block long, n long, flat binary").repartition(7)
    got = language_scoring._averaged(df, 70)
    assert got == pytest.approx(np.full(3, sum(k * (k + 1) for k in range(70)) / sum(k + 1 for k in range(70))), rel=1e-5)


def test_a_block_numbers_its_words_and_counts_training_tokens():
    block = language_scoring._Block(7)
    for doc_id, held, text in [("1", False, b"B a  b"), ("2", True, b"c a"), (None, False, None)]:
        block.add(doc_id, held, text)
    docs, words = (b.to_pylist() for b in block.frames())
    assert [(r["kind"], r["block"], r["doc_id"], r["held_out"], r["n_tokens"], r["word"]) for r in docs] == [
        ("doc", 7, "1", False, 4, None), ("doc", 7, "2", True, 3, None), ("doc", 7, None, False, 1, None)]
    assert [np.frombuffer(r["ids"], "<i4").tolist() for r in docs] == [[0, 1, 0, 2], [3, 1, 2], [2]]
    assert [(r["kind"], r["block"], r["word"], r["at"], r["n"], r["ids"]) for r in words] == [
        ("word", 7, b"b", 0, 2, None), ("word", 7, b"a", 1, 1, None), ("word", 7, b" ", 2, 2, None), ("word", 7, b"c", 3, 0, None)]


def test_logits_are_held_back_only_where_they_may_be_too_large(monkeypatch):
    shape, flat = _model()
    model = recurrent.Recurrent(shape, flat)
    h, y = np.tanh(np.random.default_rng(2).standard_normal((30, 5))), np.arange(30)
    assert model._bounded(h) and not model._bounded(10_000 * h)
    free = model.log_probability(h, y)
    model.p["word_b"][...] += 2 * recurrent.MOST  # of all words of a class: no probability changes
    assert not model._bounded(h)
    assert np.isfinite(model.log_probability(h, y)).all()
    model.p["word_b"][...] -= 2 * recurrent.MOST
    monkeypatch.setattr(recurrent.Recurrent, "_bounded", lambda self, h: False)
    assert np.abs(model.log_probability(h, y) - free).max() < 1e-12
