"""Piece counts by Viterbi over scored pieces, without the pieces themselves."""

from __future__ import annotations

import ahocorasick
from pyspark.sql import DataFrame

from netgroom.llm.common import map_texts, table, texts

CACHE = 200_000
#: What an unknown character costs below the least score of the vocabulary.
UNKNOWN = 10.0


def read_pieces(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece model, controls and unknown left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(n) if not model.is_control(i) and not model.is_unknown(i)]


class Counter:
    """Number of pieces of the best segmentation of each word behind its space mark.

    A text is split in front of each space, which becomes the mark; a mark is put in front
    of a text that has none.  Ties go to the segmentation found first, with starts
    ascending.  Neighbouring unknown characters count as one, or as their bytes where the
    vocabulary holds all of these.
    """

    def __init__(self, pieces: list[tuple[str, float]]):
        self.scores = dict(pieces)
        self.least = min(self.scores.values(), default=0.0) - UNKNOWN
        self.all_bytes = all(f"<0x{b:02X}>" in self.scores for b in range(256))
        self.matches = ahocorasick.Automaton()
        for piece, value in self.scores.items():
            self.matches.add_word(piece, (len(piece), value))
        if self.scores:
            self.matches.make_automaton()
        self.known: dict[str, int] = {}

    def word(self, text: str) -> int:
        """Best score, piece count and whether the last piece is unknown, for each prefix of a word."""
        n = len(text)
        score, count, unknown = [0.0] + [None] * n, [0] * (n + 1), [False] * (n + 1)
        found: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        if self.scores:
            for last, hit in self.matches.iter(text):
                found[last].append(hit)
        for end in range(1, n + 1):
            single = False
            # the earlier start first: of equal scores the first stands
            for size, value in sorted(found[end - 1], reverse=True):
                single = single or size == 1
                new = score[end - size] + value
                if score[end] is None or new > score[end]:
                    score[end], count[end], unknown[end] = new, count[end - size] + 1, False
            if not single:
                new = score[end - 1] + self.least
                if score[end] is None or new > score[end]:
                    width = len(text[end - 1].encode()) if self.all_bytes else int(not unknown[end - 1])
                    score[end], count[end], unknown[end] = new, count[end - 1] + width, True
        return count[n]

    def count(self, text: str) -> int:
        if not text:
            return 0
        marked = text.replace(" ", "▁")
        if marked[0] != "▁":
            marked = "▁" + marked
        total, known = 0, self.known
        for part in marked.split("▁")[1:]:
            n = known.get(part)
            if n is None:
                n = self.word("▁" + part)
                if len(part) <= 64:
                    if len(known) >= CACHE:
                        known.clear()
                    known[part] = n
            total += n
        return total


def count_tokens(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens) of every whole text; null and empty texts have 0; repeated rows are answered each.

    The pieces' scores are taken as log-probabilities.  Those of a BPE model are merge ranks, so
    the counts are then not those of the model itself.
    The vocabulary (a fixed file) is read by the driver and broadcast.
    """
    pieces = df.sparkSession.sparkContext.broadcast(read_pieces(path))

    def make():
        counter = Counter(pieces.value)
        return lambda i, text: [(i, counter.count(text or ""))]

    return map_texts(texts(df, id_col, text_col), "id long, n_tokens long", make).withColumnRenamed("id", id_col)


def op10_counts(spark, sf_dir):
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
