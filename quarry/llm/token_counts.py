"""Token counts under a unigram segmentation, by dynamic programming over a trie.

Texts are cut at blanks into pre-tokens. The distinct pre-tokens of some hundred texts go
into a trie; walking it depth first keeps the forward scores of the current path, so a prefix
shared by many pre-tokens is scored once, and a terminal stores its token
count. Terminal counts are remembered from group to group, and by a Python worker from
task to task, within a bound.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator, Mapping
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: The mark that begins a pre-token, and bytes as pieces. Fixed values of the vocabulary.
SPACE = "▁"
BYTE = "<0x{:02X}>"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Pre-tokens remembered per task before the memory is emptied.
REMEMBER = 1_000_000
#: Texts whose new pre-tokens go into one trie.
GROUP = 500
#: Code points by which a byte piece is worse than the rarest piece.
BYTE_PENALTY = 10.0


def load_pieces(path: str = VOCABULARY) -> dict[str, float]:
    """Piece to log score. The vocabulary has ranks, not probabilities, so the score is Zipf's: ``-ln(rank + 1)``."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return {sp.id_to_piece(i): -math.log(i + 1) for i in range(sp.get_piece_size())
            if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i))}


class TrieCounter:
    """Token counts of pre-tokens. Best total score wins, of equal scores fewer tokens. Scores
    are logarithms of probabilities, 0 or less. A character in no piece costs its UTF-8 bytes, one token each."""

    def __init__(self, pieces: Mapping[str, float]):
        self.pieces = pieces
        # every ending of a piece: its score if it is a piece too, else 1 (scores are 0 or less)
        self.endings = {p[i:]: 1.0 for p in pieces for i in range(1, len(p))} | dict(pieces)
        self.byte = min(pieces.values(), default=0.0) - BYTE_PENALTY
        self.known: dict[str, int] = {}

    def add(self, pretokens: set[str]) -> None:
        """Store the counts of these pre-tokens: sorted, they are the trie in depth-first order, and
        what two neighbours share is the path whose scores are kept."""
        if len(self.known) + len(pretokens) > REMEMBER:
            self.known.clear()
        get, byte, known = self.endings.get, self.byte, self.known
        before, best, count = "", [0.0], [0]
        for word in sorted(pretokens):
            path = SPACE + word
            shared, most = 0, min(len(before), len(path))
            while shared < most and before[shared] == path[shared]:
                shared += 1
            del best[shared + 1:], count[shared + 1:]
            for end in range(shared + 1, len(path) + 1):
                # the node at this depth: the best last piece over the path
                ch = path[end - 1]
                score, tokens = -math.inf, 0
                for start in range(end - 1, -1, -1):
                    p = get(path[start:end])
                    if p is None:
                        break  # no piece ends like this, nor like anything longer
                    if p <= 0.0:
                        s = best[start] + p
                        if s > score or s == score and count[start] + 1 < tokens:
                            score, tokens = s, count[start] + 1
                if ch not in self.pieces:
                    cost = len(ch.encode("utf-8", "surrogatepass"))
                    s = best[end - 1] + cost * byte
                    if s > score or s == score and count[end - 1] + cost < tokens:
                        score, tokens = s, count[end - 1] + cost
                best.append(score)
                count.append(tokens)
            before = path
            known[word] = count[-1]

    def counts(self, texts: Iterable[str]) -> Iterator[tuple[int, int]]:
        """(pre-tokens, tokens) of each text, ``GROUP`` texts to a trie."""
        texts = iter(texts)
        while some := list(islice(texts, GROUP)):
            cut = [WORD.findall(t) for t in some]
            distinct = set().union(*cut)
            new = distinct.difference(self.known)
            if new:
                # where the bound empties the memory, the words of this group are all new
                self.add(distinct if len(self.known) + len(new) > REMEMBER else new)
            known = self.known.__getitem__
            for words in cut:
                yield len(words), sum(map(known, words))


_LAST: list = []


def _counter(pieces: dict[str, float], name: str) -> TrieCounter:
    """The counter of a vocabulary; a Python worker keeps the last one, with its counts, from task to task."""
    if not _LAST or _LAST[0] != name:
        _LAST[:] = [name, TrieCounter(pieces)]
    return _LAST[1]


def count_tokens(docs: DataFrame, text_col: str = "text", vocabulary: str = VOCABULARY,
                 pieces: Mapping[str, float] | None = None) -> DataFrame:
    """``docs`` plus ``n_pretokens`` and ``n_tokens`` (long; replaced if there). A null text has none of either.

    Row by row, nothing is shuffled. The vocabulary (a file the driver reads, or ``pieces``) is
    broadcast: tens of thousands of strings, whatever the size of the data.
    """
    spark: SparkSession = docs.sparkSession
    pieces = dict(pieces) if pieces is not None else load_pieces(vocabulary)
    name = hashlib.sha256(repr(sorted(pieces.items())).encode()).hexdigest()
    shared = spark.sparkContext.broadcast(pieces)

    @F.pandas_udf("pretokens long, tokens long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counter = _counter(shared.value, name)
        for texts in batches:
            rows = list(counter.counts(t or "" for t in texts))
            yield pd.DataFrame(rows, columns=["pretokens", "tokens"], dtype="int64")
    out = docs.withColumn("_counted", counted(F.col(text_col)))
    return (out.withColumn("n_pretokens", F.col("_counted.pretokens"))
            .withColumn("n_tokens", F.col("_counted.tokens")).drop("_counted"))
