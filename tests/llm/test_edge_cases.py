"""Nulls, empty and very long texts, ties, repeated rows, empty tables and
clashing column names, for every operator and every row-keeping form."""

import hashlib
import zlib

import pytest

from larch.llm import exact_dedup, language_id, mixing, near_dedup, packing, quality_rules, substring_dedup
from larch.llm.arrow_tokens import token_digests, write_token_files
from larch.llm.common import materialize
from larch.llm.html_extract import extract_main_text
from larch.llm.preferences import conversations, format_preferences, replaced_reply_pairs
from larch.llm.tokens import tokenizer_path
from larch.session import unique_path
from tests.llm.conftest import CLASHES, ROWS

N = len(ROWS)
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", *CLASHES]


def _pack(docs):
    return packing.pack(materialize(packing.pieces_of(docs, tokenizer_path()), "pieces"))


def _tokens(docs):
    manifest = write_token_files(docs, unique_path(docs.sparkSession, "test", "tokens"), tokenizer_path())
    return token_digests(manifest, "bigint")


OPERATORS = {
    "op2": substring_dedup.remove_repeated, "op3": quality_rules.quality_verdicts, "op4": near_dedup.near_duplicates,
    "op5": mixing.mix_documents, "op6": _tokens, "op8": _pack, "op9": exact_dedup.exact_groups,
    "op10": lambda d: language_id.identify_languages(d, language_id.fit_languages(d)),
}
KEEPERS = {"op4": near_dedup.keep_one_of_each, "op5": mixing.sample_documents, "op9": exact_dedup.keep_one_of_each, "op10": language_id.keep_identified}


@pytest.mark.parametrize("name", OPERATORS)
def test_no_documents(no_docs, name):
    assert OPERATORS[name](no_docs).collect() == []


@pytest.mark.parametrize("name", KEEPERS)
def test_keepers_return_the_columns(no_docs, name):
    out = KEEPERS[name](no_docs)
    assert out.columns == COLUMNS and out.count() == 0


def _ids(rows):
    return sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows)


@pytest.mark.parametrize("name", [n for n in OPERATORS if n != "op8"])
def test_every_row_comes_back(odd_docs, name):
    rows = OPERATORS[name](odd_docs).collect()
    assert _ids(rows) == sorted((r[0] is None, r[0] or 0) for r in ROWS)


def test_exact_groups(odd_docs):
    rows = exact_dedup.exact_groups(odd_docs).collect()
    prose = [r for r in rows if r["doc_id"] in (1, 2, 3)]
    assert {(r["keep_id"], r["group_size"]) for r in prose} == {(3, 4)}  # the leading space makes 3 the longest
    assert [r["doc_id"] for r in prose if r["kept"]] == [3]
    blank = [r for r in rows if r["text_sha256"] == hashlib.sha256(b"").hexdigest()]
    assert len(blank) == 4 and [r["doc_id"] for r in blank if r["kept"]] == [6]
    kept = exact_dedup.keep_one_of_each(odd_docs)
    assert kept.columns == COLUMNS and _ids(kept.collect()) == _ids([r for r in rows if r["kept"]])


def test_repeated_rows_keep_one(spark, odd_docs):
    twice = odd_docs.where("doc_id = 2").select(COLUMNS)
    for form in (exact_dedup, near_dedup):
        assert form.keep_one_of_each(twice).count() == 1
    assert sorted(r["kept"] for r in exact_dedup.exact_groups(twice).collect()) == [False, True]
    assert sorted(r["kept"] for r in near_dedup.near_duplicates(twice).collect()) == [False, True]


def test_near_classes(odd_docs):
    rows = {r["doc_id"]: r for r in near_dedup.near_duplicates(odd_docs).collect()}
    assert {rows[i]["class_id"] for i in (1, 2, 3, 12)} == {1} and rows[1]["kept"] and not rows[12]["kept"]
    assert {rows[i]["class_id"] for i in (4, 5, 6)} == {4}
    for i in (7, 8, 9, 11):
        assert rows[i]["class_id"] == i and rows[i]["class_size"] == 1


def test_removed_bytes(odd_docs):
    rows = {r["doc_id"]: r for r in substring_dedup.remove_repeated(odd_docs).collect()}
    assert rows[2]["n_removed"] == rows[2]["n_bytes"] and rows[2]["n_spans"] == 1
    assert rows[1]["n_removed"] == rows[1]["n_bytes"] and rows[3]["n_removed"] >= rows[3]["n_bytes"] - 1
    assert rows[4]["n_bytes"] == rows[5]["n_bytes"] == 0 and rows[9]["n_removed"] == 0


def test_quality(odd_docs):
    rows = {r["doc_id"]: r for r in quality_rules.quality_verdicts(odd_docs).collect()}
    assert rows[4]["n_words"] == rows[6]["n_words"] == 0 and rows[4]["base_failed"] and not rows[4]["kept"]
    assert rows[9]["n_words"] == 60_000 and not rows[9]["base_failed"]
    assert rows[11]["n_words"] == len(next(r[1] for r in ROWS if r[0] == 11).encode().split())  # only ASCII white space separates


def test_mixing_samples_by_probability(odd_docs):
    rows = mixing.mix_documents(odd_docs).collect()
    assert all(0 < r["probability"] <= 1 for r in rows)
    kept = mixing.sample_documents(odd_docs)
    assert kept.columns == COLUMNS and _ids(kept.collect()) == _ids([r for r in rows if r["sampled"]])


def test_languages(odd_docs):
    rows = OPERATORS["op10"](odd_docs).collect()
    for r in rows:
        if r["doc_id"] in (4, 5, 6, 10):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        if r["doc_id"] is not None:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    kept = language_id.keep_identified(odd_docs)
    assert kept.columns == COLUMNS and 10 not in [r["doc_id"] for r in kept.collect()]


def test_nothing_to_learn_from(odd_docs):
    unlabelled = odd_docs.where("lang IS NULL")
    assert {r["lang_pred"] for r in OPERATORS["op10"](unlabelled).collect()} == {"und"}


def test_pages(spark):
    pages = spark.createDataFrame([(1, "u", None), (2, None, ""), (None, "u", "<p>a"), (3, "u", "<p>x</p>" * 20_000), (3, "u", "plain")],
                                  "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS n_chars")
    rows = sorted(((r["page_id"] or 0, r["n_chars"], r["text"][:5]) for r in extract_main_text(pages).collect()))
    assert rows == [(0, 1, "a"), (1, 0, ""), (2, 0, ""), (3, 5, "plain"), (3, 39_999, "x\nx\nx")]
    assert extract_main_text(pages.limit(0)).collect() == []


def test_odd_conversations(spark):
    turns = spark.createDataFrame([
        (1, 0, "user", "q"), (1, 1, "assistant", "a"), (2, 0, None, None), (2, 1, "assistant", "b"), (2, 1, "assistant", "b"),
        (3, 0, "user", "only"), (None, None, None, None), (70, 0, "assistant", "alone")],
        "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS prompt", "2 AS k")
    rows = {r["conv_id"]: r for r in format_preferences(replaced_reply_pairs(conversations(turns))).collect()}
    assert set(rows) == {1, 2, 3, None, 70}
    assert rows[1]["rejected_completion"] == "<|im_start|>assistant\nb<|im_end|>\n" and rows[1]["n_prompt_turns"] == 1
    assert rows[2]["prompt"].startswith("<|im_start|>unknown\n<|im_end|>\n") and rows[2]["n_prompt_turns"] == 1
    assert rows[2]["chosen_completion"] == "<|im_start|>assistant\nb<|im_end|>\n" * 2 and len(rows[2]["chosen_mask"]) == 2
    assert rows[3]["rejected_completion"] is None and rows[3]["chosen_completion"] == ""
    assert rows[70]["chosen_completion"] == "<|im_start|>assistant\nalone<|im_end|>\n" and rows[70]["rejected_mask"] is None
    assert format_preferences(replaced_reply_pairs(conversations(turns.limit(0)))).collect() == []


def test_every_turn_is_rendered_once(spark):
    """Prompt and chosen completion hold all turns; forks lie at any reply, also before later turns."""
    from larch.llm.catalog import QUERIES
    from tests.conftest import SF001

    whole = {r["conv_id"]: r["t"] for r in spark.sql(f"""
        SELECT conv_id, concat_ws('', transform(sort_array(collect_list(struct(turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text))),
            t -> concat('<|im_start|>', t.role, '\n', t.text, '<|im_end|>\n'))) AS t FROM parquet.`{SF001}/conversations.parquet` GROUP BY conv_id""").collect()}
    rows = QUERIES["op7_preference_formatting"](spark, SF001).collect()
    assert {r["conv_id"]: r["prompt"] + r["chosen_completion"] for r in rows} == whole
    assert sum((r["chosen_completion"] or "").count("<|im_start|>") > 1 and r["rejected_completion"] is not None for r in rows) > 0
