"""Language identification by segmentation-marginalised unigrams (operator 10).

Each language has a probability for every piece of a fixed public vocabulary.
The probability of a word is the sum, over all ways to cut it into pieces, of
the product of their probabilities (the forward algorithm); a text's score in a
language adds the logarithms over its words to that of the language's share.
The best language wins; its posterior is the score.

Words are runs of letters in lower case, led by the vocabulary's word mark.
Longer runs than ``WORD_CHARS`` are scored in stretches of that many letters. A
letter that is no piece by itself has the same small probability everywhere.

The piece probabilities come from expectation maximisation (forward-backward)
over the word counts of a sample of labelled documents: about ``TRAIN_DOCS`` per
language, chosen by a hash of id and text, so the fit is bounded however large
the input; the shares are counted over all labelled documents. Documents whose
crc32 of the id is 2 modulo 4 are held out of both.

Defined cases: a null text or one without a letter is "und" with score 0, and so
is every text when nothing labelled can be learned from; a null id hashes as ""
for the split; repeated rows give repeated rows; ties go to the language first
in alphabetical order; an empty table gives an empty result; other columns are
not read. Whole texts are scored; a worker remembers words of about ``CACHE_BYTES``.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larch.llm.common import claim_memory, read_table, whole_row

VOCABULARY = "piece_bpe_32k.model"
TRAIN_DOCS = 500
EM_ROUNDS = 5
#: Expected uses that every piece is given beforehand.
SMOOTHING = 0.02
LETTER_FLOOR = 1e-7
WORD_CHARS = 32
#: Memory of the scored words that a worker keeps, and what a word takes besides its letters and numbers.
CACHE_BYTES, WORD_BYTES = 96_000_000, 170
LATTICE_WORDS = 20_000
GROUP_CHARS = 1_000_000
UNKNOWN = "und"
#: The pipeline rejects documents whose best language is less probable.
MIN_SCORE = 0.5
HELD_OUT = 2
_LETTERS = re.compile(r"[^\W\d_]+")
_MARK = "▁"


def words_of(text: str) -> list[str]:
    return _LETTERS.findall(text.lower())


def vocabulary(path: str) -> list[str]:
    """The pieces made of lower-case letters, with or without the word mark."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i)))
    return sorted({p for p in pieces if (s := p.removeprefix(_MARK)).isalpha() and s == s.lower()})


def prefix_index(pieces: list[str]) -> dict[str, int]:
    """Piece -> its number, and -1 for what only begins a piece. The number
    after the last is that of a letter that is no piece."""
    out = {p[:i]: -1 for p in pieces for i in range(1, len(p))}
    out.update((p, i) for i, p in enumerate(pieces))
    return out


class Lattice:
    """All cuts of a list of words into pieces: edges from one letter position
    to a later one, grouped by where they end and where they start."""

    def __init__(self, words: list[str], index: dict[str, int], n_pieces: int) -> None:
        word, start, end, piece = [], [], [], []
        get = index.get
        for w, s in enumerate(words):
            s = _MARK + s
            n = len(s)
            for a in range(n):
                one = False
                for b in range(a + 1, n + 1):
                    p = get(s[a:b])
                    if p is None:
                        break
                    if p >= 0:
                        word.append(w), start.append(a), end.append(b), piece.append(p)
                        if b == a + 1:
                            one = True
                if not one:
                    word.append(w), start.append(a), end.append(a + 1), piece.append(n_pieces)
        self.n_words = len(words)
        self.length = np.array([len(s) + 1 for s in words], dtype=np.int64)
        self.width = int(self.length.max(initial=1)) + 1
        self.word, self.start = np.array(word, dtype=np.int64), np.array(start, dtype=np.int64)
        self.end, self.piece = np.array(end, dtype=np.int64), np.array(piece, dtype=np.int64)
        self.by_end = [np.flatnonzero(self.end == e) for e in range(self.width)]
        self.by_start = [np.flatnonzero(self.start == s) for s in range(self.width)]

    def forward(self, prob: np.ndarray) -> np.ndarray:
        """alpha[word, position, language]: the sum over all cuts up to there."""
        k = prob.shape[1]
        alpha = np.zeros((self.width, self.n_words, k))
        alpha[0] = 1.0
        for e in range(1, self.width):
            at = self.by_end[e]
            if len(at):
                add = alpha[self.start[at], self.word[at]] * prob[self.piece[at]]
                for j in range(k):
                    alpha[e, :, j] = np.bincount(self.word[at], add[:, j], self.n_words)
        return alpha

    def log_prob(self, prob: np.ndarray) -> np.ndarray:
        return np.log(np.maximum(self.forward(prob)[self.length, np.arange(self.n_words)], 1e-300))

    def expected_uses(self, prob: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece (one language) over words seen ``counts`` times."""
        p = prob[:, 0]
        alpha = self.forward(prob)[:, :, 0]
        beta = np.zeros_like(alpha)
        beta[self.length, np.arange(self.n_words)] = 1.0
        for s in range(self.width - 1, -1, -1):
            at = self.by_start[s]
            if len(at):
                beta[s] += np.bincount(self.word[at], p[self.piece[at]] * beta[self.end[at], self.word[at]], self.n_words)
        total = np.maximum(beta[0], 1e-300)
        share = alpha[self.start, self.word] * p[self.piece] * beta[self.end, self.word] / total[self.word]
        return np.bincount(self.piece, share * counts[self.word], len(p))


def _stretches(word: str) -> list[str]:
    return [word[i:i + WORD_CHARS] for i in range(0, len(word), WORD_CHARS)]


def _groups(texts: list[str | None]) -> Iterator[list[str | None]]:
    """Runs of texts of about GROUP_CHARS, so that few words are held at once."""
    group, size = [], 0
    for t in texts:
        group.append(t)
        size += len(t or "")
        if size >= GROUP_CHARS:
            yield group
            group, size = [], 0
    if group:
        yield group


#: Of this worker: a model's name -> (word -> row, rows of log probabilities).
_SCORED: dict[str, tuple[dict[str, int], np.ndarray]] = {}


class UnigramLanguages:
    """languages, log shares and piece probabilities (pieces + 1, languages)."""

    def __init__(self, pieces: list[str], languages: list[str], shares: np.ndarray, prob: np.ndarray) -> None:
        self.pieces, self.languages, self.prob = pieces, languages, prob
        self.log_share = np.log(shares)
        self.name = uuid.uuid4().hex
        self.word_bytes = WORD_BYTES + 8 * len(languages)

    @classmethod
    def fit(cls, word_counts: dict[str, dict[str, int]], shares: dict[str, float], pieces: list[str]) -> UnigramLanguages:
        index = prefix_index(pieces)
        languages, columns = sorted(word_counts), []
        for lang in languages:
            counts: Counter[str] = Counter()
            for w, n in word_counts[lang].items():
                for s in _stretches(w):
                    counts[s] += n
            lattice = Lattice(list(counts), index, len(pieces))
            n = np.array(list(counts.values()), dtype=float)
            p = np.full((len(pieces) + 1, 1), 1 / max(len(pieces), 1))
            p[-1] = LETTER_FLOOR
            for _ in range(EM_ROUNDS):
                uses = lattice.expected_uses(p, n)[:-1] + SMOOTHING
                p[:-1, 0] = uses / uses.sum()
            columns.append(p)
        prob = np.concatenate(columns, axis=1) if columns else np.zeros((len(pieces) + 1, 0))
        return cls(pieces, languages, np.array([shares[x] for x in languages]), prob)

    def _rows(self, words: list[list[str]]) -> tuple[dict[str, int], np.ndarray]:
        """Rows of log probabilities that cover these words."""
        if self.name not in _SCORED:
            claim_memory("languages", _SCORED.clear)
        index, rows = _SCORED.get(self.name) or ({}, np.zeros((0, len(self.languages))))
        need = list({w for doc in words for w in doc if w not in index})
        if need:
            if sum(map(len, need)) + (len(index) + len(need)) * self.word_bytes > CACHE_BYTES:
                index, rows = {}, rows[:0]
                need = list({w for doc in words for w in doc})
            parts = [_stretches(w) for w in need]
            distinct = list(dict.fromkeys(s for p in parts for s in p))
            if not hasattr(self, "_index"):
                self._index = prefix_index(self.pieces)
            scored = np.concatenate([Lattice(distinct[i:i + LATTICE_WORDS], self._index, len(self.pieces)).log_prob(self.prob)
                                     for i in range(0, len(distinct), LATTICE_WORDS)])
            at = {s: i for i, s in enumerate(distinct)}
            new = scored[[at[p[0]] for p in parts]]
            for i, p in enumerate(parts):
                for s in p[1:]:
                    new[i] += scored[at[s]]
            index.update(zip(need, range(len(rows), len(rows) + len(need)), strict=True))
            rows = np.concatenate([rows, new])
            _SCORED.clear()
            _SCORED[self.name] = index, rows
        return index, rows

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        labels, scores = [], []
        if not self.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        for group in _groups(texts):
            words = [words_of(t) if t else [] for t in group]
            index, rows = self._rows(words)
            for w in words:
                if not w:
                    labels.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                log = self.log_share + rows[list(map(index.__getitem__, w))].sum(axis=0)
                best = int(log.argmax())
                labels.append(self.languages[best])
                scores.append(float(1 / np.exp(np.minimum(log - log[best], 0)).sum()))
        return labels, scores

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_index"}


def _held_out(id_col: str) -> Column:
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")) % 4 == HELD_OUT


def fit_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  train_docs: int = TRAIN_DOCS, vocabulary_path: str | None = None) -> UnigramLanguages:
    """Fit on the labelled documents that are not held out."""
    import public_tokenizers

    pieces = vocabulary(vocabulary_path or public_tokenizers.path(VOCABULARY))
    labelled = docs.where(F.col(f"`{lang_col}`").isNotNull() & ~_held_out(id_col)).select(
        F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"),
        F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("h"))
    seen = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    total = sum(seen.values())
    limit = F.lit(None).cast("double")
    for lang, n in seen.items():
        limit = F.when(F.col("lang") == lang, F.lit(min(1.0, train_docs / n))).otherwise(limit)
    sample = labelled.where(F.pmod("h", F.lit(1 << 20)) < limit * (1 << 20)).select("lang", "text")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter[tuple[str, str]] = Counter()
        for b in batches:
            for lang, text in zip(b["lang"], b["text"], strict=True):
                counts.update((lang, w) for w in words_of(text or ""))
        yield pd.DataFrame([(*k, n) for k, n in counts.items()], columns=["lang", "word", "n"]).astype({"n": "int64"})

    table = sample.mapInPandas(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words: dict[str, dict[str, int]] = {}
    for r in table.toLocalIterator():
        words.setdefault(r["lang"], {})[r["word"]] = r["n"]
    return UnigramLanguages.fit(words, {k: n / max(total, 1) for k, n in seen.items()}, pieces)


def predict_column(model: UnigramLanguages, text: Column) -> Column:
    """struct<lang_pred, score> of a text column."""
    @F.pandas_udf("struct<lang_pred:string,score:double>")
    def run(texts: pd.Series) -> pd.DataFrame:
        labels, scores = model.predict(texts.tolist())
        return pd.DataFrame({"lang_pred": labels, "score": scores})

    return run(text)


def identify_languages(docs: DataFrame, model: UnigramLanguages, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    return docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), _held_out(id_col).alias("held_out"),
        predict_column(model, F.col(f"`{text_col}`").cast("string")).alias("p"),
    ).select("doc_id", "held_out", "p.lang_pred", "p.score")


def keep_identified(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The documents, with all their columns, whose language is found with at
    least ``min_score``; the model is fitted on these documents' own labels."""
    p = predict_column(fit_languages(docs), F.col("text").cast("string"))
    return docs.select(whole_row(docs), p.alias("p")).where((F.col("p.lang_pred") != UNKNOWN) & (F.col("p.score") >= min_score)).select("row.*")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return identify_languages(docs, fit_languages(docs))
