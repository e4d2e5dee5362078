"""Benchmark decontamination by template canonicalisation, chained windows and slot consistency."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netgroom.llm.common import map_texts, stored, table, texts
from netgroom.llm.text import mix

WINDOW = 5
SIMILARITY = 0.8
#: Words by which the shift may move between two neighbouring matches of one item.
DRIFT = 5
#: Bits of each filter that is broadcast; a fixed number, whatever the benchmark's size.
FILTER_BITS = 1 << 23
#: Words a task remembers.
KNOWN_WORDS = 500_000

#: Words that count as units after a number.
UNITS = frozenset(
    "mm cm m km g kg mg t l ml s ms min h hours hour minutes minute seconds second days day weeks week months month "
    "years year usd eur dollars dollar euros euro cents cent percent miles mile feet foot inches inch pounds pound "
    "metres metre meters meter grams gram litres litre liters liter".split()
)

_TOKEN = regex.compile(r"[^\W\d_]++|\d+(?:[.,]\d+)*|[.!?\n]")
#: The same for ASCII, where the standard library is faster and cuts alike.
_ASCII = re.compile(r"[A-Za-z]++|\d+(?:[.,]\d+)*|[.!?\n]", re.ASCII)
_ENDS = frozenset(".!?\n")

# Low bits of a word's code; the others are those of the hash of the lower-cased word.
_END, _NUMBER, _UNIT, _CAPITAL, _BENCHMARK = (np.uint64(1 << k) for k in range(5))
_FLAGS = np.uint64(31)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_PLACES = [np.uint64(xxhash.xxh64_intdigest(f"<{kind}>")) & ~_FLAGS for kind in ("number", "unit", "name")]


def _bit(word: str) -> int:
    return xxhash.xxh64_intdigest(word) % FILTER_BITS


class Codes(dict):
    """Code of each word: hash of the word in lower case and flags of what it can be."""

    def __init__(self, names: np.ndarray | None = None):
        super().__init__()
        self.names = names

    def __missing__(self, word: str) -> int:
        if len(self) > KNOWN_WORDS:
            self.clear()
        low = word.lower()
        digest = xxhash.xxh64_intdigest(low)
        code = digest & ~31
        if low in UNITS:
            code |= 4
        if low != word:
            if len(word) > 1 and word[0].isupper() and word[1:].islower():
                at = digest % FILTER_BITS
                code |= 8 | 16 * (self.names is not None and int(self.names[at >> 3]) >> (at & 7) & 1)
        elif word[0].isdigit():
            code |= 2
        elif word in _ENDS:
            code |= 1
        self[word] = code
        return code


class Template:
    """Tokens of a text with placeholders for numbers, names and units.

    ``hashes`` are those of the tokens, ``at`` their numbers among the words of the text.
    A name is a capitalised word (of two letters or more) inside a sentence; one that begins a
    sentence is a name where the benchmark shows it inside one, or, with ``own``, where the text
    itself does and never has it in lower case.  Neighbouring names are one.
    """

    def __init__(self, found: list[str], codes: np.ndarray, own: np.ndarray | None = None):
        self.found = found
        flags = codes & _FLAGS
        end = (flags & _END) > 0
        number = (flags & _NUMBER) > 0
        unit = np.zeros(len(codes), bool)
        np.logical_and(flags[1:] & _UNIT, number[:-1], out=unit[1:])
        capital = ((flags & _CAPITAL) > 0) & ~unit
        first = np.ones(len(codes), bool)
        first[1:] = end[:-1]
        self.inside = capital & ~first
        self.unsure = capital & first & ((flags & _BENCHMARK) == 0)
        name = capital & ~self.unsure
        if own is not None:
            name |= own
        again = np.zeros(len(codes), bool)
        np.logical_and(name[1:], name[:-1], out=again[1:])
        kinds = np.zeros(len(codes), np.int8)
        hashes = codes & ~_FLAGS
        for kind, (there, place) in enumerate(zip((number, unit, name), _PLACES), 1):
            if there.any():
                kinds[there], hashes[there] = kind, place
        self.kept = np.flatnonzero(~(end | again))
        self.hashes = hashes[self.kept]
        self.kinds = kinds
        self.at = (np.cumsum(~end) - 1)[self.kept]

    def value(self, k: int) -> str:
        """What stands behind the placeholder of token ``k``; empty for a plain word."""
        at = int(self.kept[k])
        kind = self.kinds[at]
        if not kind:
            return ""
        if kind != 3:
            return self.found[at].lower()
        end = int(self.kept[k + 1]) if k + 1 < len(self.kept) else len(self.found)
        while end - 1 > at and self.kinds[end - 1] != 3:
            end -= 1
        return " ".join(w.lower() for w in self.found[at:end])

    def windows(self, size: int) -> np.ndarray:
        """Hash of every run of ``size`` tokens."""
        n = len(self.hashes) - size + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        total = np.full(n, size, np.uint64)
        for k in range(size):
            total *= _STEP
            total += self.hashes[k : k + n]
        return mix(total)


def _read(text: str, codes: Codes) -> tuple[list[str], np.ndarray]:
    found = (_ASCII if text.isascii() else _TOKEN).findall(text)
    return found, np.fromiter(map(codes.__getitem__, found), np.uint64, len(found))


def templates(text: str, codes: Codes) -> list[Template]:
    """The template of a text, and a second one where the text itself shows names that begin sentences."""
    found, coded = _read(text, codes)
    if not found:
        return []
    one = Template(found, coded)
    if not one.inside.any() or not one.unsure.any():
        return [one]
    both = {found[k] for k in np.flatnonzero(one.unsure)} & {found[k] for k in np.flatnonzero(one.inside)}
    if not both:
        return [one]
    plain = {w.lower() for w in both}.intersection(found)
    names = {w for w in both if w.lower() not in plain}
    own = np.zeros(len(found), bool)
    own[[k for k in np.flatnonzero(one.unsure) if found[k] in names]] = True
    return [one, Template(found, coded, own)] if names else [one]


def inner_names(text: str) -> set[str]:
    found, coded = _read(text, Codes())
    if not found:
        return set()
    return {found[k].lower() for k in np.flatnonzero(Template(found, coded).inside)}


def _bits(places: DataFrame) -> np.ndarray:
    """A bit for each of the ``at``, merged from the tasks; the size is FILTER_BITS / 8 bytes."""
    bits = np.zeros(FILTER_BITS >> 3, np.uint8)
    found = places.select("at").distinct().toArrow().column("at").to_numpy()
    np.bitwise_or.at(bits, found >> 3, (1 << (found & 7)).astype(np.uint8))
    return bits


def _items(rows: DataFrame, size: int, names) -> DataFrame:
    """(id, size, grams, ats, slots): all windows of each item; an item shorter than a window is one of its length."""

    def make():
        codes = Codes(names.value)

        def work(i, text):
            found, coded = _read(text or "", codes)
            if not found:
                return
            t = Template(found, coded)
            n = min(size, len(t.hashes))
            grams = t.windows(n) if n else []
            if not len(grams):
                return
            values = [t.value(k) for k in range(len(t.hashes))]
            starts = range(len(grams))
            yield i, n, grams.view(np.int64).tolist(), t.at[: len(grams)].tolist(), [values[k : k + n] for k in starts]

        return work

    return map_texts(rows, "id long, size int, grams array<long>, ats array<int>, slots array<array<string>>", make)


def _hits(rows: DataFrame, sizes: list[int], size: int, keep, names) -> DataFrame:
    """(id, grams, ats, slots) of the texts that have windows in the filter."""

    def make():
        codes, bits = Codes(names.value), keep.value

        def work(i, text):
            out = []
            for t in templates(text or "", codes):
                values: dict[int, str] = {}
                for s in sizes:
                    grams = t.windows(s)
                    at = (grams % np.uint64(FILTER_BITS)).astype(np.int64)
                    seen = set()
                    for k in np.flatnonzero(bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).tolist():
                        for j in range(k, k + s):
                            if j not in values:
                                values[j] = t.value(j)
                        row = (int(grams[k].view(np.int64)), int(t.at[k]), tuple(values[j] for j in range(k, k + s)))
                        # a short item is one window: its first place with the same values suffices
                        if s < size:
                            if row[::2] in seen:
                                continue
                            seen.add(row[::2])
                        out.append(row)
            if out:
                out = sorted(set(out), key=lambda r: r[1])
                yield i, [r[0] for r in out], [r[1] for r in out], [list(r[2]) for r in out]

        return work

    return map_texts(rows, "id long, grams array<long>, ats array<int>, slots array<array<string>>", make)


def _consistent(pairs: set[tuple[str, str]]) -> bool:
    """No changed value has become that of a slot which stands unchanged."""
    still = {i for i, d in pairs if i == d}
    return not any(i != d and d in still for i, d in pairs)


def held(item: tuple, places: dict[int, list[tuple[int, list[str]]]], similarity: float) -> tuple[int, int, int] | None:
    """(n_matched, place, n_changed) of the best chain of an item's windows in a text, or none.

    In a chain, matches ascend in item and text and the shift moves by ``DRIFT`` words at most from one to the next.
    ``places`` has (word number, slots) of each gram of the text.
    """
    grams, ats, slots = item
    if len(grams) == 1 and all(slots[0]):
        # an item of placeholders alone has no frame: its values themselves must stand in the text
        same = [at for at, s in places.get(grams[0], ()) if s == slots[0]]
        return (1, min(same), 0) if same else None
    hits = sorted((at, k, s) for k, g in enumerate(grams) for at, s in places.get(g, ()))
    length: list[int] = []
    last: list[int] = []
    recent: dict[int, list[int]] = defaultdict(list)
    for h, (at, k, found) in enumerate(hits):
        shift = at - ats[k]
        best, link = 0, -1
        for s in range(shift - DRIFT, shift + DRIFT + 1):
            row = recent.get(s, ())
            # of one shift, the latest that stands before this one has the longest chain
            for e in reversed(row[-2 * DRIFT - 2 :]):
                before, item_at, old = hits[e]
                if before >= at or item_at >= k:
                    continue
                over = k - item_at
                if s != shift and over < len(found):
                    # one value for each slot of the item
                    if any(a != b for a, b in zip(old[over:], found[: len(found) - over])):
                        continue
                if length[e] > best or (length[e] == best and s == shift):
                    best, link = length[e], e
                break
        length.append(best + 1)
        last.append(link)
        recent[shift].append(h)
    need = similarity * len(grams)
    for h in sorted((h for h in range(len(hits)) if length[h] >= need), key=lambda h: (-length[h], hits[h][0])):
        pairs, at = set(), h
        while at >= 0:
            _, k, found = hits[at]
            pairs |= {(i, d) for i, d in zip(slots[k], found) if i}
            start, at = hits[at][0], last[at]
        if _consistent(pairs):
            return length[h], start, sum(i != d for i, d in pairs)
    return None


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    size: int = WINDOW,
    similarity: float = SIMILARITY,
) -> DataFrame:
    """(id, item, n_matched, n_windows, coverage, n_changed): documents that hold a benchmark item.

    Windows of template tokens are joined by hash.  A document holds an item if
    ``similarity`` or more of the item's windows match in a chain: in order, the
    shift moving by a few words where something was added or left out.  Each slot of
    the item has one value in the document; equal values may come to differ and
    different ones to be equal, unless a changed value becomes one that stands
    unchanged.  ``n_changed`` counts the changes.  One row per document and item, the
    best chain; ties to the earlier one.

    Null or empty texts on either side match nothing; an item shorter than a window is one
    window of its own length, and one of placeholders alone must have the same values; rows
    without an id are left out of the report; repeated rows of an id count as one.
    """
    spark = docs.sparkSession
    rows = texts(benchmark, item_col, item_text).where("id is not null")
    shown = map_texts(rows, "at long", lambda: lambda i, text: [(_bit(w),) for w in inner_names(text or "")])
    names = spark.sparkContext.broadcast(_bits(shown))
    items = stored(_items(rows, size, names).distinct())
    gram = F.explode("grams").alias("gram")
    grams = items.select("id", "size", F.size("grams").alias("n_windows"), gram)
    place = F.expr(f"pmod(case when gram >= 0 then gram else gram & {(1 << 63) - 1} end, {FILTER_BITS}L)")
    keep = spark.sparkContext.broadcast(_bits(grams.select(place.alias("at"))))
    sizes = sorted({size} | {r.size for r in items.select("size").distinct().collect()})
    found = stored(_hits(texts(docs, id_col, text_col).where("id is not null"), sizes, size, keep, names))

    # documents in which enough windows of an item stand at all; rows that repeat an item's id are items of their own
    key = F.xxhash64("id", "grams", F.col("slots")).alias("key")
    keyed = items.select(key, F.col("id").alias("item"), "grams", "ats", "slots")
    counted = keyed.select("key", F.size("grams").alias("n"), gram).groupBy("key", "n", "gram").agg(F.count("*").alias("c"))
    pairs = found.select("id", F.explode(F.array_distinct("grams")).alias("gram")).distinct().join(counted, "gram")
    enough = pairs.groupBy("id", "key", "n").agg(F.sum("c").alias("c")).where(F.col("c") >= similarity * F.col("n"))
    wanted = enough.select("id", "key").join(keyed, "key").groupBy("id")
    wanted = wanted.agg(F.collect_list(F.struct("item", "grams", "ats", "slots")).alias("items"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "item", "m", "n", "place", "changed"]
        for batch in batches:
            out = []
            for k in range(batch.num_rows):
                i, grams, ats, slots, items = (c[k].as_py() for c in batch.columns)
                places = defaultdict(list)
                for g, at, s in zip(grams, ats, slots):
                    places[g].append((at, s))
                for item in items:
                    got = held((item["grams"], item["ats"], item["slots"]), places, similarity)
                    if got:
                        out.append((i, item["item"], got[0], len(item["grams"]), got[1], got[2]))
            columns = zip(*out) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    schema = "id long, item long, m long, n long, place long, changed long"
    runs = found.join(wanted, "id").select("id", "grams", "ats", "slots", "items").mapInArrow(check, schema)
    best = runs.groupBy("id", "item").agg(F.max(F.struct("m", -F.col("place"), -F.col("changed"), "n", "changed")).alias("best"))
    return best.select(
        F.col("id").alias(id_col),
        F.col("item").alias(item_col),
        F.col("best.m").alias("n_matched"),
        F.col("best.n").alias("n_windows"),
        F.round(F.col("best.m") / F.col("best.n"), 6).alias("coverage"),
        F.col("best.changed").alias("n_changed"),
    )


def op4_decontamination(spark, sf_dir):
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
