"""Records of CSV files that are split over tasks, whatever stands inside their quotes.

A split reader sees lines, and a line break inside quotes does not end a record.
Whether a line begins inside quotes depends on all quotes before it.  Two passes settle that:

1. Each split is run through the quoting rules twice, as if it began between records and as
   if it began inside quotes.  That gives one row for each split, a map from its first to its
   last state.  These maps are composed over the splits of a file in order, which
   tells the state in which every split begins.
2. Each split is parsed from its true state.  What belongs to a record that began in an
   earlier split, and what goes on in a later one, is put together by file and parsed then.

The rules are those of Python's ``csv``: a quote opens a quoted value only at its start, a doubled
quote stands for one, and any other quote is a plain character.
"""

from __future__ import annotations

import csv
import io
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from netgroom.session import as_now

# These functions travel to the executors by value: tasks need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: What may stand in front of the text of a file.
BOM = "\ufeff"
#: States between characters: at the start of a value, within a plain one, within quotes, behind a quote within quotes.
START, PLAIN, QUOTED, CLOSING = range(4)


@dataclass(frozen=True)
class Dialect:
    delimiter: str = ","
    quote: str = '"'


def open_after(line: str, inside: bool, dialect: Dialect = Dialect()) -> bool:
    """Whether the quotes are open at the end of a line that begins between records, or ``inside`` quotes."""
    delimiter, quote = dialect.delimiter, dialect.quote
    at, n = 0, len(line)
    state = QUOTED if inside else START
    while True:
        if state == QUOTED:
            at = line.find(quote, at)
            if at < 0:
                return True
            at, state = at + 1, CLOSING
        elif state == CLOSING:
            if at < n and line[at] == quote:
                at, state = at + 1, QUOTED
            else:
                state = PLAIN
        elif state == PLAIN:
            # a carriage return outside quotes ends the record as a line break does
            ends = [k for k in (line.find(delimiter, at), line.find("\r", at)) if k >= 0]
            if not ends:
                return False
            at, state = min(ends) + 1, START
        elif at < n and line[at] == quote:
            at, state = at + 1, QUOTED
        else:
            state = PLAIN


def lines_of(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """Lines of the files with their file and the start of their split; lines of a split stay in order."""
    return placed(spark.read.option("lineSep", "\n").option("pathGlobFilter", glob).text(path))


def placed(lines: DataFrame) -> DataFrame:
    return lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.Array]]:
    """(file, start of the split, lines) for each run of lines of one split in a batch."""
    files, starts = batch.column(1), batch.column(2)
    at = 0
    while at < batch.num_rows:
        same = pc.and_(pc.equal(files.slice(at), files[at]), pc.equal(starts.slice(at), starts[at]))
        end = pc.index(same, False).as_py()
        n = batch.num_rows - at if end < 0 else end
        yield files[at].as_py(), starts[at].as_py(), batch.column(0).slice(at, n)
        at += n


def split_states(lines: DataFrame, dialect: Dialect = Dialect()) -> DataFrame:
    """(file, start, inside): whether each split begins inside quotes (1) or between records (0)."""
    quote = dialect.quote

    def run(batches):
        last, maps = None, {}
        for batch in batches:
            for file, start, values in _runs(batch):
                key = (file, start)
                if key != last:
                    if last is not None:
                        yield _states(last, maps[last])
                        maps.pop(last)
                    last = key
                ends = maps.setdefault(key, [False, True])
                # a line without a quote leaves both states as they are
                for line in values.filter(pc.match_substring(values, quote)).to_pylist():
                    ends[:] = [open_after(line, e, dialect) for e in ends]
        if last is not None:
            yield _states(last, maps[last])

    def _states(key, ends):
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]]), pa.array([key[1]], pa.int64()), pa.array([int(ends[0])], pa.int32()), pa.array([int(ends[1])], pa.int32())],
            ["file", "start", "from_0", "from_1"],
        )

    maps = lines.mapInArrow(run, "file string, start long, from_0 int, from_1 int")
    # a split that ends alike from both states fixes the state; after it each swap turns it over
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    fixed = F.col("from_0") == F.col("from_1")
    swaps = maps.withColumn("swaps", F.sum(F.when(~fixed & (F.col("from_0") == 1), 1).otherwise(0)).over(Window.partitionBy("file").orderBy("start")))
    known = F.last(F.when(fixed, F.struct(F.col("from_0").alias("state"), "swaps")), ignorenulls=True).over(before)
    swapped = F.coalesce(F.max("swaps").over(before), F.lit(0))
    state = (F.coalesce(F.col("known.state"), F.lit(0)) + swapped - F.coalesce(F.col("known.swaps"), F.lit(0))) % 2
    return swaps.withColumn("known", known).select("file", "start", state.cast("int").alias("inside"))


def _parse(text: str, dialect: Dialect) -> Iterator[list[str]]:
    """Records of a text, blank lines left out; a carriage return ends a line as a line break does."""
    csv.field_size_limit(sys.maxsize)
    found = csv.reader(io.StringIO(text, newline=""), delimiter=dialect.delimiter, quotechar=dialect.quote)
    return (r for r in found if len(r) > 1 or r and r[0].strip(" \t"))


class _Split:
    """One split in the second pass: its lines from the true state on."""

    def __init__(self, inside: bool, dialect: Dialect, strict: bool):
        self.dialect, self.inside, self.strict = dialect, inside, strict
        #: Lines of an earlier record, until it ends here; those of the record that is open, from its first line on.
        self.head: list[str] | None = [] if inside else None
        self.ended: list[str] | None = None
        self.open: list[str] = []

    def feed(self, values: pa.Array) -> Iterator[list[str]]:
        """Complete records of some more lines."""
        ready: list[str] = []
        for line in values.to_pylist():
            if self.inside or self.dialect.quote in line:
                self.inside = open_after(line, self.inside, self.dialect)
                if self.inside and self.strict:
                    raise ValueError(f"row {line.split(self.dialect.delimiter)[0]}: quoted line break")
            if self.head is not None:
                self.head.append(line)
                if not self.inside:
                    self.ended, self.head = self.head, None
                continue
            self.open.append(line)
            if not self.inside:
                ready += self.open
                self.open = []
        return _parse("\n".join(ready), self.dialect)


#: What a row of the second pass is: a whole record, or the part that goes on from an earlier split (with or without its end), or the part that begins one.
WHOLE, ENDS, MIDDLE, BEGINS = range(4)


def _second(
    lines: DataFrame, inside: dict[tuple[str, int], bool] | None, names: list[str], dialect: Dialect, strict: bool = False, parts_of: set[str] | None = None
) -> DataFrame:
    """(kind, file, start, values, text) of the second pass; the header of each file is checked and left out.

    ``inside`` has every split of the first pass (None: there was none, every split begins between records).  ``parts_of``
    names files of which only the parts of records are wanted.
    """
    schema = "kind int, file string, start long, values array<string>, text string"
    fields = [pa.int32(), pa.string(), pa.int64(), pa.list_(pa.string()), pa.string()]

    def table(rows):
        columns = list(zip(*rows)) if rows else [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, fields)], ["kind", "file", "start", "values", "text"])

    def left(key, split, header):
        rows = []
        if split.ended is not None:
            rows.append((ENDS, *key, None, "\n".join(split.ended)))
        if split.head is not None:
            rows.append((MIDDLE, *key, None, "\n".join(split.head)))
        if split.open:
            # values mark a header that is still open
            rows.append((BEGINS, *key, [] if header else None, "\n".join(split.open)))
        return rows

    def run(batches):
        key, split, header = None, None, False
        for batch in batches:
            for file, start, values in _runs(batch):
                if parts_of is not None and file not in parts_of:
                    continue
                if (file, start) != key:
                    if split is not None:
                        yield table(left(key, split, header))
                    if inside is not None and (file, start) not in inside:
                        raise ValueError(f"the split of {file} at {start} is none of the first pass")
                    key, split, header = (file, start), _Split(inside is not None and inside[file, start], dialect, strict), start == 0
                rows = []
                for record in split.feed(values):
                    if header:
                        header = False
                        check_header(record, names, file)
                        continue
                    if parts_of is not None:
                        break
                    rows.append((WHOLE, *key, check_width(record, len(names)), None))
                yield table(rows)
        if split is not None:
            yield table(left(key, split, header))

    return lines.mapInArrow(run, schema)


def check_header(record: list[str], names: list[str], file: str) -> None:
    found = [record[0].removeprefix(BOM), *record[1:]]
    if found != names:
        raise ValueError(f"the header of {file} is {found}, not {names}")


def check_width(record: list[str], width: int) -> list[str]:
    if len(record) > width:
        raise ValueError(f"row {record[0]}: too many values")
    return record


def _stitched(parts: DataFrame, names: list[str], dialect: Dialect) -> DataFrame:
    """Records that cross splits: their parts in order of the splits, put together and parsed."""
    order = Window.partitionBy("file").orderBy("start", "kind")
    # within a split the end of an earlier record comes before the beginning of a new one
    number = F.sum((F.col("kind") == BEGINS).cast("long")).over(order)
    part = F.struct("start", "text")
    whole = parts.withColumn("record", number).groupBy("file", "record")
    text = F.array_join(F.transform(F.sort_array(F.collect_list(part)), lambda p: p["text"]), "\n")
    joined = whole.agg(text.alias("text"), F.max(F.col("values").isNotNull()).alias("header"))

    def run(batches):
        for batch in batches:
            out = []
            for file, text, header in zip(*(c.to_pylist() for c in batch.columns)):
                for record in _parse(text, dialect):
                    if header:
                        check_header(record, names, file)
                        header = False
                    else:
                        out.append(check_width(record, len(names)))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.string()))], ["values"])

    return joined.select("file", "text", "header").mapInArrow(run, "values array<string>")


def header_of(spark: SparkSession, path: str, glob: str, dialect: Dialect = Dialect()) -> list[str]:
    """The first record of the first file, read line by line until its quotes are closed."""
    first = lines_of(spark, path, glob).where("start = 0").select("value").limit(100).collect()
    for record in _parse("\n".join(r.value for r in first), dialect):
        return [record[0].removeprefix(BOM), *record[1:]]
    raise ValueError(f"no header in {path}")


def read_records(spark: SparkSession, path: str, glob: str, names: list[str], dialect: Dialect = Dialect()) -> DataFrame:
    """The records of CSV files as text columns ``names``; a short record is filled up with NULL.

    Every file has the header ``names``.  Files are split over tasks and read twice.  A record with
    more values is an error, a blank line is none, an empty file or one with a header alone has no
    records; quotes that are open at the end of a file end there.  The list of splits with their states is collected: it is as long as
    the list of splits that the driver plans anyway.  All passes read the same splits: they depend on the options and cores
    at hand and on the files listed, so options are kept as they are now, and no pass leaves out a file.
    """
    kept = lines_of(as_now(spark), path, glob)
    none = spark.sql("SELECT '' AS value, '' AS file, 0L AS start WHERE false")
    lines = none.unionByName(kept)
    inside = {(r.file, r.start): r.inside == 1 for r in split_states(lines, dialect).collect()}
    rows = _second(lines, inside, names, dialect)
    whole = rows.where(F.col("kind") == WHOLE).select("values")
    crossed = {file for (file, _), within in inside.items() if within}
    if crossed:
        # files in which a record crosses a split are gone through once more for its parts
        parts = _second(lines, inside, names, dialect, parts_of=crossed).where(F.col("kind") != WHOLE)
        whole = whole.unionByName(_stitched(parts, names, dialect))
    return _columns(whole, names)


def line_records(lines: DataFrame, names: list[str], dialect: Dialect = Dialect()) -> DataFrame:
    """Records of files, batch or stream, whose lines are records each: as :func:`read_records` in one pass.

    A line break inside quotes is an error.
    """
    return _columns(_second(lines, None, names, dialect, strict=True).where(F.col("kind") == WHOLE), names)


def _columns(rows: DataFrame, names: list[str]) -> DataFrame:
    return rows.select(*(F.get("values", F.lit(k)).alias(name) for k, name in enumerate(names)))
