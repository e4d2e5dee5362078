"""Handing rows to a model as column-oriented JSON and reading its replies.

A payload is ``{column: {row id: value}}`` for a bounded number of rows.
Payloads are cut inside each partition from Arrow batches: no shuffle, and no
group of rows is ever gathered.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netgroom.sources.schema import ANOMALY, ANOMALY_INPUT_COLUMNS, OWNER_COLUMNS, OWNER_REPLY

ROWS_PER_CALL = 500


def payloads(
    df: DataFrame, columns: Sequence[str], key: str = "source_row_id", rows_per_call: int = ROWS_PER_CALL
) -> DataFrame:
    """Column-oriented JSON of the rows, at most ``rows_per_call`` in each text.

    Rows that share a key cannot stand in one text and go to separate ones; rows
    without one cannot be answered and are left out (:func:`without_key` counts them).  A key of
    every row, as the daily run gives it, avoids both.
    """
    columns = list(columns)

    # local, so that it travels to the executors with the task
    def to_json(part: pd.DataFrame) -> str:
        ids = part[key].astype(str)
        return json.dumps(
            {c: {i: None if pd.isna(v) else v for i, v in zip(ids, part[c].tolist())} for c in columns},
            ensure_ascii=False,
        )

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), rows_per_call):
                chunk = batch.iloc[start : start + rows_per_call]
                copies = chunk.groupby(key).cumcount()
                for _, part in chunk.groupby(copies):
                    yield pd.DataFrame({"n_rows": [len(part)], "payload": [to_json(part)]})

    wanted = df.where(F.col(key).isNotNull()).select(*dict.fromkeys([key, *columns]))
    return wanted.mapInPandas(cut, "n_rows long, payload string")


def without_key(df: DataFrame, key: str = "source_row_id") -> int:
    """Number of rows that :func:`payloads` leaves out."""
    return df.where(F.col(key).isNull()).count()


def ask(payload_table: DataFrame, model: Callable[[str], str]) -> DataFrame:
    """Send every payload to ``model``; a failed call leaves ``reply`` NULL and ``error`` filled.

    ``model`` runs on the executors.  Write the result before using it twice:
    a model may answer differently the next time.
    """

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for n_rows, payload in zip(batch["n_rows"], batch["payload"]):
                try:
                    reply, error = model(payload), None
                except Exception as problem:  # the row stays as it is, the job goes on
                    reply, error = None, repr(problem)
                yield pd.DataFrame({"n_rows": [n_rows], "reply": [reply], "error": [error]})

    schema = "n_rows long, reply string, error string"
    return payload_table.mapInPandas(call, schema)


def owner_payloads(clean: DataFrame, rows_per_call: int = ROWS_PER_CALL, key: str = "source_row_id") -> DataFrame:
    return payloads(clean, OWNER_COLUMNS, key, rows_per_call)


def anomaly_payloads(clean: DataFrame, rows_per_call: int = ROWS_PER_CALL) -> DataFrame:
    return payloads(clean, ANOMALY_INPUT_COLUMNS, rows_per_call=rows_per_call)


def column_rows(texts: DataFrame, text: str, columns: T.StructType, key: str = "source_row_id") -> DataFrame:
    """Texts ``{column: {row: value}}`` as rows of ``key`` (text) and the columns.

    ``columns`` names the maps and their types.  A row named in any map counts.
    Texts that are not such JSON give no rows.
    """
    names = columns.names
    maps = F.from_json(F.col(text), columns).alias("m")
    parsed = texts.select(maps).where("m IS NOT NULL").select(
        *[F.coalesce(F.col(f"m.{f.name}"), F.create_map().cast(f.dataType)).alias(f.name) for f in columns]
    )
    keys = [F.map_keys(c) for c in names]
    # The usual text lists the same rows in every map: put the values side by side.
    same_rows = reduce(Column.__and__, [k == keys[0] for k in keys])
    aligned = F.arrays_zip(keys[0].alias("row"), *[F.map_values(c).alias(c) for c in names])
    looked_up = F.transform(
        F.array_distinct(F.concat(*keys)),
        lambda k: F.struct(k.alias("row"), *[F.try_element_at(F.col(c), k).alias(c) for c in names]),
    )
    rows = F.when(same_rows, aligned).otherwise(looked_up)
    return parsed.select(F.inline(rows)).withColumnRenamed("row", key)


# Confidences are read as text: a model may write 95, 95.0 or "95".
_OWNER_TEXT = T.StructType([T.StructField(c, T.MapType(T.StringType(), T.StringType())) for c in OWNER_REPLY.names])
_ANOMALY_TEXT = T.StructType(
    [T.StructField(f.name, T.StringType()) if isinstance(f.dataType, T.LongType) else f for f in ANOMALY]
)


def owner_reply_rows(replies: DataFrame, reply: str = "reply", first_row_id: int = 0, key: str = "source_row_id") -> DataFrame:
    """Replies about owners as proposals, one row each; unreadable ones give no rows.

    ``first_row_id`` is added to the row numbers when a reply counts rows by position.
    """
    rows = column_rows(replies, reply, _OWNER_TEXT, key)
    return rows.withColumns(
        {
            key: F.col(key).try_cast("long") + first_row_id,
            "confidence_percentage": F.col("confidence_percentage").try_cast("double"),
        }
    )


def unreadable_owner_replies(replies: DataFrame, reply: str = "reply") -> DataFrame:
    """The replies that hold none of the maps, failed calls included."""
    parsed = F.from_json(F.col(reply), _OWNER_TEXT)
    return replies.where(reduce(Column.__and__, [parsed[c].isNull() for c in OWNER_REPLY.names]))


def _records(reply: str) -> Column:
    """The records of a reply; numbers through double, what is no number becomes NULL."""
    return F.transform(
        F.from_json(F.col(reply), T.ArrayType(_ANOMALY_TEXT)),
        lambda r: F.struct(
            *[
                (r[f.name].try_cast("double").try_cast("long") if isinstance(f.dataType, T.LongType) else r[f.name]).alias(f.name)
                for f in ANOMALY
            ]
        ),
    )


# What a record may recommend.
ACTIONS = ["modify", "drop"]


def _whole(record: Column) -> Column:
    """A record that says all it must: a row, a list of field names, an issue, a known action, a confidence from 0 to 100."""
    fields, confidence = record["affected_fields"], record["anomaly_confidence"]
    named = (F.size(fields) > 0) & F.forall(fields, lambda f: f.isNotNull())
    good = record["source_row_id"].isNotNull() & fields.isNotNull() & named & record["issue_type"].isNotNull()
    return F.coalesce(good & record["recommended_action"].isin(ACTIONS) & confidence.between(0, 100), F.lit(False))


def anomaly_reply_rows(replies: DataFrame, reply: str = "reply") -> DataFrame:
    """Replies holding a list of anomaly records, one row for each record."""
    return replies.select(F.inline(_records(reply)))


def readable_anomaly_reply(reply: str = "reply") -> Column:
    """Whether a reply is a list of whole records; a list without any says that nothing was found."""
    listed = F.trim(F.col(reply)).startswith("[")
    return F.coalesce(F.forall(_records(reply), _whole) & listed, F.lit(False))


def unreadable_anomaly_replies(replies: DataFrame, reply: str = "reply") -> DataFrame:
    """The replies that are no list of whole records, failed calls included."""
    return replies.where(~readable_anomaly_reply(reply))


def audit_anomaly_replies(replies: DataFrame, reply: str = "reply") -> DataFrame:
    """``replies`` with ``readable``, the number of ``records`` and of those that are ``whole``.

    A reply that is no list has no records.
    """
    listed = F.trim(F.col(reply)).startswith("[")
    records = F.when(listed, _records(reply))
    return replies.withColumns(
        {
            "readable": readable_anomaly_reply(reply),
            "records": F.coalesce(F.size(records), F.lit(0)).cast("long"),
            "whole": F.coalesce(F.size(F.filter(records, _whole)), F.lit(0)).cast("long"),
        }
    )
