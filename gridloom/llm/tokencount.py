"""Count-only Viterbi: how many pieces a unigram tokenizer makes of a text, without making them.

The tokenizer is a unigram model behind a split at white space and a word mark before each word.
No piece goes beyond a word, so a text's count is the sum of its words' counts, and a word's count is kept in a
bounded cache. For a new word an Aho-Corasick automaton enumerates the vocabulary's matches, and
dynamic programming carries the best score and its number of pieces along the word. Ties follow the
tokenizers library: nodes are left in order of place, shorter pieces first, and a later path must be
strictly better; a character that no single piece covers costs the least score less 10, and
unknown characters in a row are one piece.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import documents

MARK = "▁"
UNKNOWN_PENALTY = 10.0

#: Words in the cache; beyond, it is emptied.
CACHED = 1_000_000

#: The tokenizer's white space: Unicode's property, to which Python's split() adds four controls.
_SPACE = re.compile("[\t-\r \x85\xa0  -     　]+")
_ODD = re.compile("[\x1c-\x1f]")


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Unigram vocabulary of a piece model's file: its pieces in order, scored by the logarithm of their place.

    The public piece file holds merge ranks instead of probabilities; places follow frequency, so the logarithm
    stands for one (Zipf). Control and byte pieces are left out; the unknown piece is the first.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    keep = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i) or model.is_unused(i))]
    return [("<unk>", 0.0)] + [(model.id_to_piece(i), -math.log(n + 2)) for n, i in enumerate(keep)]


def tokenizer(vocab: list[tuple[str, float]]):
    """The tokenizer of the library that the counts are exact for."""
    from tokenizers import Tokenizer, models, pre_tokenizers

    out = Tokenizer(models.Unigram(vocab, unk_id=0, byte_fallback=False))
    out.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.Metaspace(MARK, prepend_scheme="always", split=True)])
    return out


class Counter:
    def __init__(self, vocab: list[tuple[str, float]]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in vocab[1:]:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {piece for piece, _ in vocab if len(piece) == 1}
        self.unknown = min(score for _, score in vocab) - UNKNOWN_PENALTY
        self.cache: dict[str, int] = {}

    def word(self, word: str) -> int:
        """Pieces of one word, given with its mark."""
        n = len(word)
        score: list[float] = [0.0] + [-math.inf] * n
        count = [0] * (n + 1)
        if self.single.issuperset(word):  # nothing unknown: of the matches that end together the longest, left first, comes first
            for end, (length, gain) in self.automaton.iter(word):
                new = score[end + 1 - length] + gain
                if new > score[end + 1]:
                    score[end + 1], count[end + 1] = new, count[end + 1 - length] + 1
            return count[n]
        starts: dict[int, list[tuple[int, float]]] = defaultdict(list)
        for end, (length, gain) in self.automaton.iter(word):
            starts[end + 1 - length].append((end + 1, gain))  # shorter pieces end first
        unknown = [False] * (n + 1)
        for i in range(n):
            base, pieces = score[i], count[i]
            for end, s in starts[i]:
                if base + s > score[end]:
                    score[end], count[end], unknown[end] = base + s, pieces + 1, False
            if word[i] not in self.single and base + self.unknown > score[i + 1]:
                score[i + 1], count[i + 1], unknown[i + 1] = base + self.unknown, pieces + (not unknown[i]), True
        return count[n]

    def chunk(self, chunk: str) -> int:
        """Pieces of what stands between white space; marks in it begin words of their own."""
        return sum(self.word(MARK + w) for w in chunk.removeprefix(MARK).split(MARK))

    def text(self, text: str | None) -> tuple[int, int]:
        """Chunks and pieces of a whole text."""
        if not text:
            return 0, 0
        words = [w for w in _SPACE.split(text) if w] if _ODD.search(text) else text.split()
        try:
            return len(words), sum(map(self.cache.__getitem__, words))
        except KeyError:
            new = set(words).difference(self.cache)
            if len(self.cache) + len(new) > CACHED:
                self.cache.clear()
            if len(new) > CACHED // 4:  # a huge text of ever new words isn't kept
                return len(words), sum(map(self.chunk, words))
            new = new if self.cache else set(words)
            self.cache.update((w, self.chunk(w)) for w in new)
            return len(words), sum(map(self.cache.__getitem__, words))


_COUNTERS: dict[str, Counter] = {}


def token_counts(docs: DataFrame, piece_file: str) -> DataFrame:
    """(doc_id, n_words, n_tokens) of each row of ``docs`` (doc_id, text).

    Null, empty and blank texts count 0. Repeated rows come back repeated; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if piece_file not in _COUNTERS:
            _COUNTERS[piece_file] = Counter(vocabulary(piece_file))
        count = _COUNTERS[piece_file].text
        for batch in batches:
            rows = [count(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64())], names=["doc_id", "n_words", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_words long, n_tokens long")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
