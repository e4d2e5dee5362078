"""Harmonic packing: token ids of documents in sequences of a fixed capacity."""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netgroom.llm.common import table, texts
from netgroom.llm.text import chunks

CAPACITY, END = 4096, 2
#: Tokens that a full bin of a class may leave empty.
SLACK = 1
#: Segments, and words, in one generation of a worker's tables, and the longest kept.
SEGMENTS, WORDS, KEPT = 300_000, 300_000, 64

_TOKEN = 4


#: Text that normal forms leave alone and that every library lower-cases alike, and its words by the file's pattern.
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]*")
_WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else the next free one from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(256 + hidden.index(b)) if b in hidden else chr(b) for b in range(256)]


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit numbers, by a file of the tokenizers library.

    The file lower-cases a text, drops its white space and joins tokens within the words of a pattern
    only.  So a text's ids are those of its segments between ASCII white space, and a plain
    segment's are those of its words, which the library's model is asked for; both are kept in two
    bounded generations.  All other segments go to the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.letters = _byte_letters()
        self.segments: dict[bytes, bytes] = {}
        self.older_segments: dict[bytes, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.older_words: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            ids = self.older_words.get(word)
            if ids is None:
                shown = word if word.isascii() else "".join(map(self.letters.__getitem__, word.encode()))
                ids = _pack([t.id for t in self.model.tokenize(shown)])
            if len(word) <= KEPT:
                if len(self.words) >= WORDS:
                    self.words, self.older_words = {}, self.words
                self.words[word] = ids
        return ids

    def _segment(self, part: bytes) -> bytes:
        ids = self.segments.get(part)
        if ids is None:
            ids = self.older_segments.get(part)
            if ids is None:
                if part.isalpha():
                    ids = self._word(part.lower().decode())
                elif part[:-1].isalpha() and 32 < part[-1] < 127:
                    ids = self._word(part[:-1].lower().decode()) + self._word(chr(part[-1]))
                else:
                    text = part.decode()
                    if _PLAIN.fullmatch(text) and not any(s in text for s in self.special):
                        ids = b"".join([self._word(w) for w in _WORDS.findall(text.lower())])
                    else:
                        ids = _pack(self.whole.encode(text, add_special_tokens=False).ids)
            if len(part) <= KEPT:
                if len(self.segments) >= SEGMENTS:
                    self.segments, self.older_segments = {}, self.segments
                self.segments[part] = ids
        return ids

    def encode(self, text: str) -> bytes:
        parts = text.encode("utf-8", "replace").split()
        out = list(map(self.segments.get, parts))
        if None in out:
            for k, ids in enumerate(out):
                if ids is None:
                    out[k] = self._segment(parts[k])
        return b"".join(out)


def _pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def lengths(capacity: int = CAPACITY, slack: int = SLACK) -> list[int]:
    """For each rest of a document the longest piece cut from it: a length that fills ``capacity`` up to ``slack`` tokens."""
    out, best = [0], 0
    for n in range(1, capacity + 1):
        best = n if capacity % n <= slack else best
        out.append(best)
    return out


class Bins:
    """The open bins of one worker.

    A piece of length s belongs to the class of capacity // s pieces.  Each class has one open
    bin; it is closed at that count.  ``finish`` cuts what the open bins hold anew: into full
    sequences, and the rest into sequences whose lengths are powers of two, which need no padding.
    """

    def __init__(self, first: int, capacity: int = CAPACITY, slack: int = SLACK):
        self.capacity, self.next = capacity, first
        self.cut = lengths(capacity, slack)
        self.open: dict[int, list[tuple]] = {}

    def _close(self, pieces: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for doc, start, ids, n in pieces:
            yield doc, start, len(ids) // _TOKEN, ids, n, self.next, offset
            offset += len(ids) // _TOKEN
        self.next += 1

    def add(self, doc, ids: bytes) -> Iterator[tuple]:
        """Pieces of the bins that this document completes: (doc, start, length, ids, document's length, sequence, offset)."""
        n = len(ids) // _TOKEN
        start = 0
        while start < n:
            size = self.cut[min(n - start, self.capacity)]
            bin_ = self.open.setdefault(size, [])
            bin_.append((doc, start, ids[start * _TOKEN : (start + size) * _TOKEN], n))
            start += size
            if len(bin_) == self.capacity // size:
                yield from self._close(self.open.pop(size))

    def finish(self) -> Iterator[tuple]:
        left = [piece for size in sorted(self.open, reverse=True) for piece in self.open[size]]
        self.open = {}
        rest = sum(len(ids) for _, _, ids, _ in left) // _TOKEN
        held: list[tuple] = []
        room = 0
        for doc, start, ids, n in left:
            at = 0
            while at < len(ids):
                if not room:
                    # the largest power of two in what is left, or a full sequence
                    room = self.capacity if rest >= self.capacity else 1 << (rest.bit_length() - 1)
                take = min(room, (len(ids) - at) // _TOKEN)
                held.append((doc, start + at // _TOKEN, ids[at : at + take * _TOKEN], n))
                at, room, rest = at + take * _TOKEN, room - take, rest - take
                if not room:
                    yield from self._close(held)
                    held = []


_SCHEMA = "id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
_ARROW = pa.schema(
    [(c, pa.binary() if c == "ids" else pa.int64()) for c in ("id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")]
)
#: The encoder of a worker process, kept with its bounded table for the next tasks of the same file.
_kept: dict[str, Encoder] = {}


def _encoder(data: tuple[str, bytes]) -> Encoder:
    import tempfile

    digest, content = data
    if digest not in _kept:
        _kept.clear()
        with tempfile.NamedTemporaryFile(suffix=".json") as f:
            f.write(content)
            f.flush()
            _kept[digest] = Encoder(f.name)
    return _kept[digest]


def pack(df: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, slack: int = SLACK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents in sequences: (id, start, length, ids, doc_tokens, sequence_id, offset).

    A document is the ids of its text and ``end``.  It is cut into pieces of lengths that
    divide ``capacity`` up to ``slack`` tokens, longest first; each worker fills bins of one
    length with their fixed number of pieces, on its own and without a shuffle.  Full bins leave
    at most ``slack`` tokens; what a worker's last bins hold is cut into full sequences and powers of
    two.  ``ids`` are little-endian unsigned 32-bit numbers.  A null or empty text is ``end``
    alone; rows that repeat an id, or have none, are documents each; an empty table has no rows.
    A worker holds one open bin for each length and one document.  ``capacity`` must be a power of
    two.  The file of the tokenizer (a fixed vocabulary) is read by the driver and broadcast.
    """
    if capacity & (capacity - 1) or capacity < 1:
        raise ValueError("the capacity must be a power of two")
    with open(path, "rb") as f:
        content = f.read()
    shared = df.sparkSession.sparkContext.broadcast((hashlib.sha256(content).hexdigest(), content))
    mark = end.to_bytes(_TOKEN, "little")

    def run(batches):
        encoder = _encoder(shared.value)
        bins = Bins(TaskContext.get().partitionId() << 32, capacity, slack)

        def emit(rows):
            columns = list(zip(*rows)) if rows else [[] for _ in _ARROW]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)

        for batch in batches:
            for part in chunks(batch, "text"):
                pairs = zip(part.column(0).to_pylist(), part.column(1).to_pylist())
                yield emit([row for i, text in pairs for row in bins.add(i, encoder.encode(text or "") + mark)])
        yield emit(list(bins.finish()))

    return texts(df, id_col, text_col).mapInArrow(run, _SCHEMA).withColumnRenamed("id", id_col)


def op12_packing(spark, sf_dir):
    import public_tokenizers

    pieces = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
