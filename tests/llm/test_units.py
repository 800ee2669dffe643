"""Parts of the operators against plain versions of themselves."""

import math
import random
from collections import Counter
from functools import lru_cache

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from larch.llm import language_id, mixing, near_dedup, packing, preferences, quality_rules
from larch.llm.anchors import cells
from larch.llm.bwt import bounded_lcp, repeated_windows, suffix_order
from larch.llm.html_extract import main_text
from larch.llm.shingles import multiset_overlap, shingles
from larch.llm import tokens
from larch.llm.tokens import encode_bytes, tokenizer_path


def test_repeated_windows_match_counting():
    rng = random.Random(3)
    for _ in range(200):
        size = rng.choice([1, 2, 3, 5, 9, 17])
        texts = [bytes(rng.choice(b"ab\x00c"[:rng.randint(1, 4)]) for _ in range(rng.randint(0, 40))) for _ in range(rng.randint(1, 6))]
        seen = Counter(t[i:i + size] for t in texts for i in range(len(t) - size + 1))
        want = [[seen[t[i:i + size]] > 1 for i in range(len(t) - size + 1)] for t in texts]
        assert [x.tolist() for x in repeated_windows(texts, size)] == want


def test_common_prefixes_by_increasing_value():
    codes = np.frombuffer(b"\x02\x01\x03\x01\x03\x01\x04\x00", dtype=np.uint8)  # banana, a mark, its end
    order = suffix_order(codes, 8)
    assert order.tolist() == [7, 1, 3, 5, 0, 2, 4, 6]
    assert bounded_lcp(codes, order, 9)[2:8].tolist() == [3, 1, 0, 0, 2, 0]
    assert bounded_lcp(codes, order, 2)[2:8].tolist() == [2, 1, 0, 0, 2, 0]


def test_cells_hold_each_window_once_and_equal_windows_meet():
    rng = np.random.default_rng(5)
    passage = rng.integers(97, 101, 60).astype(np.uint8)
    docs = [np.concatenate([rng.integers(97, 101, 50).astype(np.uint8), passage, rng.integers(97, 101, 30).astype(np.uint8)]) for _ in range(4)]
    data, doc = np.concatenate(docs), np.repeat(np.arange(4), [len(d) for d in docs])
    first, last, anchor = cells(data, doc, 20, 8)
    windows = [i for a, b in zip(first, last) for i in range(a, b + 1)]
    assert windows == [i for i in range(len(data) - 19) if doc[i] == doc[i + 19]]
    met: dict[bytes, set[int]] = {}
    for a, b, g in zip(first, last, anchor):
        for i in range(a, b + 1):
            met.setdefault(data[i:i + 20].tobytes(), set()).add(int(g))
    assert all(len(g) == 1 for g in met.values())


@pytest.mark.parametrize("share", [0.3, 0.8, 0.97])
def test_bag_min_hash_is_unbiased(share):
    rng, errors = np.random.default_rng(0), []
    for _ in range(30):
        a = np.unique(rng.integers(0, 2**62, 200).astype(np.uint64))
        ca = rng.integers(1, 9, len(a))
        same = rng.random(len(a)) < share
        b = np.concatenate([a[same], rng.integers(0, 2**62, (~same).sum()).astype(np.uint64)])
        cb = np.concatenate([np.maximum(1, ca[same] + rng.integers(-1, 2, same.sum())), rng.integers(1, 9, (~same).sum())])
        o = np.argsort(b)
        x, y = multiset_overlap((a, ca), (b[o], cb[o]))
        t = near_dedup.bag_min_hash([(a, ca), (b[o], cb[o])])
        errors.append((t[0] == t[1]).mean() - x / y)
    assert abs(np.mean(errors)) < 4 * 0.036 / math.sqrt(30)


def test_overlap_counts_repeats():
    a, b = shingles("a b c d e " * 3), shingles("a b c d e " * 2)
    def count(t):
        w = t.split()
        return Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    ca, cb = count("a b c d e " * 3), count("a b c d e " * 2)
    assert multiset_overlap(a, b) == (sum((ca & cb).values()), sum((ca | cb).values()))


def test_ids_equal_the_tokenizers():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = True
    rng = random.Random(1)
    parts = [*"ab. ,'s\n\t  \xa0é　字1!", "<|endoftext|>", " don't", "\r\n", "  ", "\x85 ", "\x1c", "ñ", " word", " Wort.", "Zürich,"]
    for _ in range(2000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert np.frombuffer(encode_bytes(text, tokenizer_path()), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, repr(text)


def test_encoder_keeps_a_bounded_number_of_words(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(tokens, "WORDS", 20)
    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = True
    parts = tokens._Words(tokenizer_path())
    monkeypatch.setitem(tokens._ENCODERS, (tokenizer_path(), True), parts)
    rng = random.Random(3)
    letters = "abcdeñé"
    for i in range(300):
        words = ["the", "".join(rng.choice(letters) for _ in range(6)) + rng.choice(["", ".", "!!", "$$$", ",\n" + rng.choice("ab") * 3 + ".", "\n...", "\n\nx", "\t\nb"])]
        text = " ".join(["", *words, *words[:1]])
        assert np.frombuffer(encode_bytes(text, tokenizer_path(), True), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, repr(text)
        assert len(parts) <= 20 and len(parts.older) <= 20
    assert "the" in parts  # goes on occurring
    assert not any("\n" in x and x[0] != "\n" and x.strip(letters) == "\n" or "$" in x for x in {**parts, **parts.older})


def test_forward_sums_all_segmentations():
    pieces = sorted(["▁", "▁a", "▁ab", "a", "ab", "abc", "b", "bc", "c"])
    index = language_id.prefix_index(pieces)
    prob = np.random.default_rng(2).random((len(pieces) + 1, 2)) / 10
    words = ["a", "abc", "abcab", "bcx", "x"]

    def brute(word, lang):
        s = "▁" + word

        @lru_cache(None)
        def f(i):
            if i == len(s):
                return 1.0
            known = [b for b in range(i + 1, len(s) + 1) if s[i:b] in pieces]
            out = sum(prob[pieces.index(s[i:b]), lang] * f(b) for b in known)
            return out + (0 if i + 1 in known else prob[-1, lang] * f(i + 1))
        return math.log(f(0))

    got = language_id.Lattice(words, index, len(pieces)).log_prob(prob)
    assert np.allclose(got, [[brute(w, k) for k in range(2)] for w in words])


def test_expected_uses_add_up():
    pieces = ["a", "ab", "b", "▁a", "▁b"]
    lattice = language_id.Lattice(["ab", "ba"], language_id.prefix_index(sorted(pieces)), len(pieces))
    uses = lattice.expected_uses(np.full((6, 1), 0.2), np.array([1.0, 1.0]))
    by_length = dict(zip(sorted(pieces), uses))
    assert math.isclose(sum(n * len(p.replace("▁", "")) for p, n in by_length.items()), 4.0)


def test_plans_hold_every_piece_and_are_tight():
    rng = random.Random(4)
    counts = Counter(min(1024, max(1, int(rng.expovariate(1 / 300)))) for _ in range(5000))
    plan = packing.plan_sequences(dict(counts), 1024)
    held = Counter()
    for seq, many in plan:
        assert sum(seq) <= 1024 and many > 0
        for n in seq:
            held[n] += many
    assert held == counts
    least = -(-sum(n * c for n, c in counts.items()) // 1024)
    assert least <= sum(m for _, m in plan) <= 1.01 * least + 1


def test_patterns_fill_exactly():
    assert sorted(packing.fill_patterns([1, 2, 3, 6], 6)) == [(2, 2, 2), (3, 2, 1), (3, 3), (6,)]
    assert packing.cut(2500, 1024) == [(0, 452), (452, 1024), (1476, 1024)] and packing.cut(2048, 1024) == [(0, 1024), (1024, 1024)]


def test_raking_meets_reachable_targets():
    rng = np.random.default_rng(1)
    cells = pd.DataFrame([(s, g, t, float(rng.integers(50, 500))) for s in "abc" for g in "xy" for t in "01"], columns=["source", "lang", "topic", "tokens"])
    p = mixing.cell_probabilities(cells, budget=0.5, temperature=0.8)
    total = cells["tokens"].sum()
    for d in ("source", "lang", "topic"):
        have = cells["tokens"].groupby(cells[d]).sum()
        want = have ** 0.8 / (have ** 0.8).sum() * total * 0.5
        got = (cells["tokens"] * p["p"]).groupby(cells[d]).sum()
        assert np.allclose(got, want, rtol=1e-6)


def test_label_model_outweighs_one_vote():
    n = len(quality_rules.RULES)

    def pattern(votes):
        return sum((v + 1) * 3 ** j for j, v in enumerate(votes))
    clean, junk = [0] * 7 + [1] * 3, [-1, -1] + [0] * 8
    p, report = quality_rules.fit_label_model({pattern(clean): 900, pattern(junk): 100, pattern([0] * n): 5})
    assert p[pattern(clean)] > 0.99 and p[pattern(junk)] < 0.01 and list(report["rule"]) == list(quality_rules.RULES)
    assert quality_rules.votes_of_pattern(pattern(junk)) == junk


def test_text_stats_count_as_stated():
    text = "a b c a b c\nx # y\nx # y\n\n"
    s = dict(zip(quality_rules.STATS, quality_rules.text_stats(text)))
    words = text.split()
    seen = Counter(zip(words, words[1:], words[2:]))
    covered = {j for i, w in enumerate(zip(words, words[1:], words[2:])) if seen[w] > 1 for j in range(i, i + 3)}
    assert (s["n_words"], s["word_chars"], s["n_symbols"], s["n_dup_lines"], s["n_repeat_words"]) == (12, 12, 2, 1, len(covered))


@pytest.mark.parametrize("html,text", [
    ("<body><nav>menu menu menu</nav><article><h1>T &amp; U</h1><p>One\n two&nbsp;three.<p>Four <b>five<br></article><footer>f</footer>", "T & U\nOne two three.\nFour five"),
    ("<div class='site-header'>x</div><div><p>" + "long text " * 30 + "</p><p>more text here</p></div><div id=comments><p>" + "chatter " * 90 + "</p></div>",
     ("long text " * 30).strip() + "\nmore text here"),
    ("<main><header><h1>Head</h1><p>by me</p></header><article><header><h2>Own</h2><p>date</p></header><p>Body of it.</p><aside>no</aside><form>f</form></article></main>", "Own\nBody of it."),
    ("<!-- a --><script>if(a<b){'</p>'}</script><p>x &lt;b&gt; &amp;amp;</p><style>p{}</style>", "x <b> &amp;"),
    ("<ul><li>one<li>two</ul><table><tr><td>a<td>b</table>", "one\ntwo\na\nb"), ("<!-- never closed <p>x", ""), ("just text", "just text"),
    ("<div hidden>no</div><div style='display: none'>no</div><p>yes it is</p>", "yes it is"), ("<div>" * 3000 + "deep", "deep"),
])
def test_main_text(html, text):
    assert main_text(html) == text


PARAGRAPH = "<p>" + "The river carried the boats past the old town while people watched. " * 3 + "</p>"
NOISE = "<div class='cookie-notice'>We use cookies to improve the service on this site.</div><nav><a href=x>Home</a></nav>"


@pytest.mark.parametrize("body,kept", [
    (f"<article><h1>A</h1>{PARAGRAPH * 3}</article><article><h2>B</h2>{PARAGRAPH * 2}</article>", 15),
    (f"<div class='share-price-report'><h1>T</h1>{PARAGRAPH * 4}</div>", 12),
    (f"<article>{PARAGRAPH * 3}<section class='related-work'><h2>Related</h2>{PARAGRAPH * 2}</section></article>", 15),
    (f"<article>{PARAGRAPH * 3}<div id='feedback-loops'>{PARAGRAPH * 2}</div><div class='ad'>Buy now</div></article><div class='comments'>{PARAGRAPH}</div>", 15),
    (f"<div id=text>{PARAGRAPH * 3}</div><div class='sidebar'>{PARAGRAPH}</div>", 9),
])
def test_text_overrules_class_words(body, kept):
    """Pages without, with one and with several articles, and worded elements of text."""
    text = main_text(f"<html><body>{NOISE}{body}</body></html>")
    assert text.count("river") == kept and not any(w in text for w in ("cookies", "Home", "Buy"))


def test_common_prefix_of_any_conversations(spark):
    t = "array<struct<role:string,text:string>>"
    rows = [([("u", "a"), ("assistant", "b")], [("u", "a"), ("assistant", "c"), ("u", "d")]), ([("u", "a")], [("u", "a")]), ([("u", "a")], [("u", "z")]),
            ([], [("u", "a")]), ([("u", None)], [("u", None), ("assistant", "xyz")])]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"conv_id int, chosen {t}, rejected {t}")
    got = {r["conv_id"]: r["n"] for r in df.select("conv_id", preferences.common_turns(F.col("chosen"), F.col("rejected")).alias("n")).collect()}
    assert got == {0: 1, 1: 1, 2: 0, 3: 0, 4: 1}
    out = {r["conv_id"]: r for r in preferences.format_preferences(df).collect()}
    r = out[0]
    assert [r["rejected_completion"][s["start"]:s["end"]] for s in r["rejected_mask"]] == ["c<|im_end|>"]
    assert r["prompt"] + r["chosen_completion"] == "<|im_start|>u\na<|im_end|>\n<|im_start|>assistant\nb<|im_end|>\n"
    plan = preferences.format_preferences(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_components_of_a_long_chain_and_stars(spark):
    chain = [(i + 1, i) for i in range(0, 21)] + [(31, 30), (32, 30), (33, 32)]
    links = spark.createDataFrame([(bytes([a]), bytes([b])) for a, b in chain], "a binary, b binary")
    want = {bytes([i]): bytes([0]) for i in range(22)} | {bytes([i]): bytes([30]) for i in range(30, 34)}
    assert {bytes(r["node"]): bytes(r["label"]) for r in near_dedup.connected(links).collect()} == want
    roots = {bytes(r["node"]): bytes(r["label"]) for r in near_dedup._roots(links).collect()}
    assert roots == {n: v for n, v in want.items() if n != v}
    labels = near_dedup._joined(near_dedup._roots(links), spark.createDataFrame([(bytes([33]), bytes([5])), (bytes([50]), bytes([40]))], "a binary, b binary"))
    got = {bytes(r["node"]): bytes(r["label"]) for r in labels.collect()}
    assert all(got[bytes([i])] == bytes([0]) for i in (1, 21, 31, 33)) and got[bytes([50])] == got[bytes([40])] == bytes([40])


def test_pipeline_stages_send_few_texts_at_a_time(spark):
    import corpus_pipeline
    from larch.llm.common import _BATCH_ROWS, TEXT_ROWS

    before = spark.conf.get(_BATCH_ROWS)
    docs = spark.createDataFrame([(1, "some words", "en", "web", 10)], "doc_id long, text string, lang string, source string, n_chars long")
    try:
        for name, stage in corpus_pipeline.STAGES[1:2] + corpus_pipeline.STAGES[-1:]:
            spark.conf.set(_BATCH_ROWS, "10000")
            assert stage(spark, docs, "").count() == 1, name
            assert int(spark.conf.get(_BATCH_ROWS)) == TEXT_ROWS, name
        spark.conf.set(_BATCH_ROWS, "100")  # a session's own smaller batches stay
        stage(spark, docs, "")
        assert spark.conf.get(_BATCH_ROWS) == "100"
    finally:
        spark.conf.set(_BATCH_ROWS, before)
