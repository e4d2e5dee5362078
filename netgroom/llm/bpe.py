"""Byte-level BPE by prefix dynamic programming."""

from __future__ import annotations

import base64
import hashlib
import math
import re
from itertools import chain

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from netgroom.llm.common import map_texts, table, texts
from netgroom.llm.text import chunks

#: Pieces, and prefixes of pieces, in one generation of a worker's tables; the longest piece kept (characters) and the
#: longest done by kept prefixes (bytes); pairs kept.
CACHE, KEPT, SHARED, PAIRS = 500_000, 32, 40, 1_000_000
#: The pattern that ``_quick`` writes for ``re``, and characters that it does not know.
_KNOWN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_FAR = re.compile("[\U00010000-\U0010ffff]")


def _quick() -> re.Pattern:
    """``_KNOWN`` for ``re``, twice as fast as ``regex``: its classes as sets of characters up to U+FFFF, larger sets are slow."""
    every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x10000))))
    runs = [regex.findall(kind, every) for kind in (r"\p{L}+", r"\p{N}+", r"\p{White_Space}+")]
    letter, number, space = ("".join(f"{re.escape(r[0])}-{re.escape(r[-1])}" for r in found) for found in runs)
    return re.compile(
        f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+"
    )


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Bpe:
    """Encode and decode by a table of ranks.

    A sequence of tokens is what merging by rank gives if and only if each token
    merges to itself and each pair of neighbours, merged alone, stays that pair.
    So every prefix of a text has one valid last token, found from the tokens
    that end there and the last token of the prefix before them.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.exact = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.quick = _quick() if pattern == _KNOWN else None
        self.longest = max(map(len, ranks))
        #: Finds the tokens that end at each byte, the longest first.
        self.ends = ahocorasick.Automaton()
        for data, i in ranks.items():
            self.ends.add_word(data.decode("latin-1"), (len(data), i))
        self.ends.make_automaton()
        self.width = max(self.bytes_of) + 1
        self.sizes = [len(self.bytes_of.get(i, b"")) for i in range(self.width)]
        self.names = list(map(str, range(self.width)))
        #: Merging steps of the tokens tried so far; None for those that do not merge to themselves.
        self.traces: dict[int, list[tuple[float, bytes, bytes]] | None] = {}
        #: Whether a token may follow another, under left * width + right; left is -1 at the start.
        self.fits: dict[int, bool] = {}
        #: Pieces and prefixes of pieces seen lately and those before them: two bounded generations each.
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.prefixes: dict[bytes, tuple[int, ...]] = {}
        self.older_prefixes: dict[bytes, tuple[int, ...]] = {}

    def steps(self, data: bytes) -> list[tuple[float, bytes, bytes]]:
        """Merging of a single token: before each merge its rank, the first and the last part; at the end no rank."""
        parts = [data[i : i + 1] for i in range(len(data))]
        ranks, out = self.ranks, []
        while True:
            best, at = math.inf, -1
            for i in range(len(parts) - 1):
                r = ranks.get(parts[i] + parts[i + 1])
                if r is not None and r < best:
                    best, at = r, i
            out.append((best, parts[0], parts[-1]))
            if at < 0:
                return out
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _fits(self, left: int, token: int) -> bool:
        """Whether ``token`` merges to itself and stays beside ``left`` (-1: stands at the start)."""
        if token not in self.traces:
            data = self.bytes_of[token]
            trace = self.steps(data)
            self.traces[token] = trace if trace[-1][1] == data else None
        return self.traces[token] is not None and (left < 0 or self._pair(left, token))

    def _pair(self, left: int, right: int) -> bool:
        """Whether two valid tokens, merged together, stay as they are.

        Both merge on their own, the lower rank first and the left one of equal
        ranks, until a merge over their border comes first or both are done.
        """
        a, b, ranks, i, j = self.traces[left], self.traces[right], self.ranks, 0, 0
        while True:
            rank_a, _, last = a[i]
            rank_b, first, _ = b[j]
            over = ranks.get(last + first)
            if over is not None and over < rank_a and over <= rank_b:
                return False
            if rank_a <= rank_b:
                if rank_a == math.inf:
                    return True
                i += 1
            else:
                j += 1

    def append(self, data: bytes, last: list[int], until: int | None = None) -> list[int]:
        """Extend ``last``, the last token of each prefix done so far, to all prefixes of ``data``.

        For each prefix the tokens that end there are tried, the longest first; the one that fits
        behind the last token before its start is the only one.
        """
        done, n, fits, width = len(last), len(data) if until is None else until, self.fits, self.width
        first = max(0, done + 1 - self.longest)
        last.extend([-1] * (n - done))
        for at, (size, token) in self.ends.iter(data[first:n].decode("latin-1")):
            at += first
            if last[at] < 0:
                # before the start of a token stands the last one of that prefix; in front of all, the end of the list, still -1
                key = last[at - size] * width + token
                good = fits.get(key)
                if good is None:
                    if at >= size and last[at - size] < 0:
                        continue
                    if len(fits) >= PAIRS:
                        fits.clear()
                    good = fits[key] = self._fits(last[at - size], token)
                if good:
                    last[at] = token
        if n > done and min(last[done:]) < 0:
            raise ValueError("the vocabulary lacks single bytes")
        return last

    def replace(self, data: bytes, last: list[int], start: int, end: int, new: bytes) -> tuple[bytes, list[int]]:
        """Prefix tokens after data[start:end] becomes ``new``; work stops where old ones hold again."""
        changed = data[:start] + new + data[end:]
        shift = len(new) - (end - start)
        out, agree, at = last[:start], 0, start
        while at < len(changed):
            self.append(changed, out, at + 1)
            old = at - shift
            agree = agree + 1 if at >= start + len(new) and old >= 0 and out[at] == last[old] else 0
            at += 1
            # a prefix depends on this many earlier ones and on bytes that are the same from here on
            if agree >= self.longest:
                out.extend(last[at - shift :])
                break
        return changed, out

    def tokens(self, last: list[int]) -> list[int]:
        out, at, sizes = [], len(last), self.sizes
        while at:
            token = last[at - 1]
            out.append(token)
            at -= sizes[token]
        return out[::-1]

    def _last(self, data: bytes) -> tuple[int, ...]:
        """Ids of ``data`` by its last token; only the prefixes that a token tried leads to are done, or known from other pieces."""
        ranks, fits, width, n = self.ranks, self.fits, self.width, len(data)
        for start in range(max(0, n - self.longest), n):
            token = ranks.get(data[start:])
            if token is None:
                continue
            ids = ()
            if start:
                before = data[:start]
                ids = self.prefixes.get(before) or self._prefix(before)
            left = ids[-1] if ids else -1
            key = left * width + token
            good = fits.get(key)
            if good is None:
                if len(fits) >= PAIRS:
                    fits.clear()
                good = fits[key] = self._fits(left, token)
            if good:
                return (*ids, token)
        raise ValueError("the vocabulary lacks single bytes")

    def _prefix(self, data: bytes) -> tuple[int, ...]:
        ids = self.older_prefixes.get(data) or self._last(data)
        if len(self.prefixes) >= CACHE:
            self.prefixes, self.older_prefixes = {}, self.prefixes
        self.prefixes[data] = ids
        return ids

    def piece(self, text: str) -> tuple[int, ...]:
        """Ids of one match of the pattern; a match that is a token itself is that token."""
        data = text.encode()
        whole = self.ranks.get(data)
        if whole is not None:
            return (whole,)
        return self._last(data) if len(data) <= SHARED else tuple(self.tokens(self.append(data, [])))

    def _piece(self, part: str) -> tuple[int, ...]:
        ids = self.pieces.get(part)
        if ids is None:
            ids = self.older.get(part) or self.piece(part)
            if len(part) <= KEPT:
                if len(self.pieces) >= CACHE:
                    self.pieces, self.older = {}, self.pieces
                self.pieces[part] = ids
        return ids

    def split(self, text: str) -> list[str]:
        """Matches of the pattern."""
        exact = self.quick is None or _FAR.search(text)
        return (self.exact if exact else self.quick).findall(text)

    def encode(self, text: str) -> list[int]:
        """Ids of a text, from those of its pieces."""
        parts = self.split(text)
        found = list(map(self.pieces.get, parts))
        if None in found:
            for k, ids in enumerate(found):
                if ids is None:
                    found[k] = self._piece(parts[k])
        return list(chain.from_iterable(found))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


#: The encoder of a worker process, kept with its bounded caches for the next tasks of the same vocabulary.
_kept: dict[tuple, Bpe] = {}


def warm(ranks, pattern: str) -> Bpe:
    """An encoder by broadcast ``ranks`` (digest, table)."""
    digest, table_of = ranks.value
    key = (digest, pattern)
    if key not in _kept:
        _kept.clear()
        _kept[key] = Bpe(table_of, pattern)
    return _kept[key]


def _shared(df: DataFrame, path: str):
    """The ranks of a file (a fixed vocabulary) as a broadcast (digest, table)."""
    learned = read_ranks(path)
    digest = hashlib.sha256(repr(sorted(learned.items())).encode()).hexdigest()
    return df.sparkSession.sparkContext.broadcast((digest, learned))


def _digests(bpe: Bpe, text: str) -> tuple[list[int], int, str, str, bool]:
    ids = bpe.encode(text)
    back = bpe.decode(ids)
    listed = ",".join(map(bpe.names.__getitem__, ids)).encode()
    return ids, len(ids), hashlib.sha256(listed).hexdigest(), hashlib.sha256(back).hexdigest(), back == text.encode()


def bpe_digests(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of every text, decoded again: (id, n_tokens, ids_sha256, decoded_sha256, lossless).

    The rank file (a fixed vocabulary) is read by the driver and broadcast.  A
    null or empty text has no tokens; repeated rows are answered each; a very
    long text takes memory in proportion to itself alone.
    """
    ranks = _shared(df, path)

    def make():
        bpe = warm(ranks, pattern)
        return lambda i, text: [(i, *_digests(bpe, text or "")[1:])]

    schema = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string, lossless boolean"
    return map_texts(texts(df, id_col, text_col), schema, make).withColumnRenamed("id", id_col)


_ADDED = ["token_ids", "n_tokens", "ids_sha256", "decoded_sha256", "lossless"]


def with_tokens(df: DataFrame, path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``df`` with the token ids of every text and their digests in five more columns (replaced if there).

    A null or empty text has no tokens; all other columns, repeated rows and rows without an id stay as they are.
    """
    ranks = _shared(df, path)
    base = df.drop(*_ADDED)
    kept = base.columns

    def run(batches):
        bpe = warm(ranks, pattern)
        kinds = [pa.list_(pa.int32()), pa.int64(), pa.string(), pa.string(), pa.bool_()]
        for batch in batches:
            for part in chunks(batch, text_col):
                found = [_digests(bpe, t or "") for t in part.column(part.schema.get_field_index(text_col)).to_pylist()]
                added = [pa.array([f[k] for f in found], kind) for k, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([*part.columns, *added], [*kept, *_ADDED])

    added = [T.StructField("token_ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType())]
    added += [T.StructField(c, T.StringType()) for c in ("ids_sha256", "decoded_sha256")] + [T.StructField("lossless", T.BooleanType())]
    return base.mapInArrow(run, T.StructType([*base.schema.fields, *added]))


def op5_bpe(spark, sf_dir):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe_digests(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
