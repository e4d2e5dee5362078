"""What changed between runs: differences of two snapshots, validity intervals, and lookups as of a date.

A snapshot is the table of one run.  Rows are told apart by a key and compared by the other
columns, nulls being equal.  A key may stand on several rows: equal ones are one state with a number
of copies, and different ones are states side by side.

A task sorts and groups about ``ROWS`` rows, however many there are: histories are dealt to so many
``tasks`` as their rows need.  Without the argument, the tables given are counted for it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netgroom.operators.skew import left_lookup

#: Rows that one task sorts and groups.
ROWS = 500_000


def tasks_for(*tables: DataFrame) -> int:
    """Tasks among which the rows of ``tables`` are dealt; they are counted."""
    rows = sum(t.count() for t in tables)
    return max(tables[0].sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS))


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, change, changed_fields, rows_old, rows_new) of every key whose rows are not the same in both.

    Rows that stand in both snapshots cancel out.  What is left of a key was ``added``, ``removed`` or
    ``changed``; ``rows_old`` and ``rows_new`` count it.  ``changed_fields`` names the fields, in the
    order of ``columns``, where one row became one other row, and is NULL else.  Rows without a
    key are compared with each other.  No join is needed, and no key meets one task with all its rows.
    """
    state = [key, *columns]
    sides = old.select(*state, F.lit(1).alias("_old"), F.lit(0).alias("_new")).unionByName(
        new.select(*state, F.lit(0).alias("_old"), F.lit(1).alias("_new"))
    )
    left = sides.groupBy(*state).agg(F.sum("_old").alias("_old"), F.sum("_new").alias("_new"))
    left = left.withColumns({"_gone": F.greatest(F.col("_old") - F.col("_new"), F.lit(0)), "_come": F.greatest(F.col("_new") - F.col("_old"), F.lit(0))})
    left = left.where("_gone > 0 OR _come > 0")
    row = F.struct(*columns)
    kept = left.groupBy(key).agg(
        F.sum("_gone").alias("rows_old"),
        F.sum("_come").alias("rows_new"),
        F.any_value(F.when(F.col("_gone") > 0, row), ignoreNulls=True).alias("_was"),
        F.any_value(F.when(F.col("_come") > 0, row), ignoreNulls=True).alias("_is"),
    )
    differs = [F.when(~F.col(f"_was.`{c}`").eqNullSafe(F.col(f"_is.`{c}`")), F.lit(c)) for c in columns]
    one = (F.col("rows_old") == 1) & (F.col("rows_new") == 1)
    change = F.when(F.col("rows_old") == 0, "added").when(F.col("rows_new") == 0, "removed").otherwise("changed")
    return kept.select(key, change.alias("change"), F.when(one, F.array_compact(F.array(*differs))).alias("changed_fields"), "rows_old", "rows_new")


def _states(snapshots: DataFrame, by: Sequence[str], place: Sequence[str], tasks: int) -> DataFrame:
    """Rows counted by ``by``, dealt by the columns ``place`` of them.

    Equal rows are first counted for each task that read them, so one state on any share of the rows meets no task whole.
    """
    rows = snapshots.select(*by, F.spark_partition_id().alias("_reader"))
    counted = rows.repartition(tasks, *by, "_reader").groupBy(*by, "_reader").agg(F.count(F.lit(1)).alias("_rows"))
    return counted.repartition(tasks, *place).groupBy(*by).agg(F.sum("_rows").alias("copies"))


def history(snapshots: DataFrame, key: str, columns: Sequence[str], run: str = "run_date", tasks: int | None = None) -> DataFrame:
    """Validity intervals of every state of every key: (key, columns, copies, valid_from, valid_to, runs).

    ``snapshots`` are the tables of all runs with the date of the run.  An interval holds from the run
    that first shows a state to the first run that does not (NULL while the last run shows it); a state that comes
    back has a new one.  A run that published no row at all is not known here.
    """
    state = [key, *columns, "copies"]
    # what follows needs the rows of a state together, as they are then
    rows = _states(snapshots, [run, key, *columns], [key, *columns], tasks or tasks_for(snapshots))
    # one row for each run, numbered in order
    order = Window.orderBy(run)
    dates = snapshots.select(run).distinct().select(run, F.row_number().over(order).alias("_no"), F.lead(run).over(order).alias("_next"))
    placed = rows.join(F.broadcast(dates), run)
    # in an unbroken series number and place differ by the same amount
    place = F.row_number().over(Window.partitionBy(*state).orderBy("_no"))
    islands = placed.withColumn("_island", F.col("_no") - place).groupBy(*state, "_island")
    spans = islands.agg(F.min(run).alias("valid_from"), F.max_by("_next", "_no").alias("valid_to"), F.count(F.lit(1)).alias("runs"))
    return spans.drop("_island")


def extend_history(
    known: DataFrame, snapshot: DataFrame, run_date: str | Column, key: str, columns: Sequence[str], tasks: int | None = None
) -> DataFrame:
    """``known`` after one more run: states that it shows go on, others end with it, new ones begin.

    Earlier runs are not read again.  The run must be later than all known ones.
    """
    date = run_date if isinstance(run_date, Column) else F.lit(run_date)
    date = date.cast(known.schema["valid_from"].dataType)
    state = [key, *columns, "copies"]
    tasks = tasks or tasks_for(known, snapshot)
    shown = _states(snapshot, [key, *columns], [key, *columns], tasks).select(*state, F.lit(None).cast(known.schema["valid_from"].dataType).alias("valid_from"), F.lit(0).cast("long").alias("runs"), F.lit(1).alias("_shown"))
    open_ = known.where("valid_to IS NULL").select(*state, "valid_from", "runs", F.lit(0).alias("_shown"))
    both = open_.unionByName(shown).repartition(tasks, *state).groupBy(*state).agg(F.min("valid_from").alias("_from"), F.max("runs").alias("_runs"), F.max("_shown").alias("_shown"))
    now = both.select(
        *state,
        F.coalesce("_from", date).alias("valid_from"),
        F.when(F.col("_shown") == 0, date).alias("valid_to"),
        (F.col("_runs") + F.col("_shown")).alias("runs"),
    )
    return known.where("valid_to IS NOT NULL").select(*now.columns).unionByName(now)


def snapshot_at(known: DataFrame, date: str) -> DataFrame:
    """The states that held at a date, of all keys."""
    return known.where((F.col("valid_from") <= date) & (F.col("valid_to").isNull() | (F.col("valid_to") > date)))


def as_of(known: DataFrame, lookups: DataFrame, key: str, at: str, tasks: int | None = None) -> DataFrame:
    """``lookups`` with the states that their key had at the date in column ``at``; a lookup that meets none keeps NULLs.

    The states of a key are brought together first, so a lookup key on any share of the rows is
    joined with one row.
    """
    state = [c for c in known.columns if c != key]
    keyed = known.where(F.col(key).isNotNull()).repartition(tasks or tasks_for(known, lookups), key)
    by_key = keyed.groupBy(key).agg(F.collect_list(F.struct(*state)).alias("_states"))
    held = left_lookup(lookups, by_key, key)
    fits = F.filter("_states", lambda s: (s["valid_from"] <= F.col(at)) & (s["valid_to"].isNull() | (F.col(at) < s["valid_to"])))
    return held.select(*lookups.columns, F.inline_outer(fits))
