"""What the operators of this package share: Arrow batches of (id, text) in, rows out."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Texts are handed to Python in pieces of at most this many characters (one longer text is a piece of its own).
PIECE_CHARS = 4_000_000


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns the operators read, under fixed names; other columns cannot clash with results."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def pieces(batches: Iterable[pa.RecordBatch], text_col: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose texts together stay below PIECE_CHARS, so that memory is bounded."""
    for batch in batches:
        start, chars = 0, 0
        lengths = pc.binary_length(batch.column(text_col)).to_pylist()
        for row, length in enumerate(lengths):
            length = length or 0
            if row > start and chars + length > PIECE_CHARS:
                yield batch.slice(start, row - start)
                start, chars = row, 0
            chars += length
        if start < len(lengths):
            yield batch.slice(start)


def map_texts(df: DataFrame, make: Callable[[], Callable[[list, list], dict]], schema: str) -> DataFrame:
    """``make()`` once per task gives ``handle(ids, texts) -> columns``, called for each piece."""
    names = [part.strip().split()[0] for part in _fields(schema)]

    def run(batches):
        handle = make()
        types = None
        for batch in pieces(batches):
            columns = handle(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())
            types = types or _arrow_types(schema)
            yield pa.RecordBatch.from_arrays([pa.array(columns[n], t) for n, t in zip(names, types, strict=True)], names=names)

    return df.mapInArrow(run, schema)


def rewrite_texts(df: DataFrame, make: Callable[[], Callable[[list], list]], text_col: str = "text", extra: str | None = None) -> DataFrame:
    """Rows as they are, with ``make()(texts)`` as new texts; False instead of a text drops the row.

    With ``extra``, a column after those of ``df``'s result, ``make()(texts, extras)`` is called and the column is dropped.
    """
    schema = df.drop(extra).schema if extra else df.schema
    place = schema.names.index(text_col)

    def run(batches):
        handle = make()
        for batch in pieces(batches, text_col):
            texts = batch.column(text_col).to_pylist()
            new = handle(texts, batch.column(extra).to_pylist()) if extra else handle(texts)
            if extra:
                batch = batch.select(schema.names)
            stay = pa.array([t is not False for t in new], pa.bool_())
            texts = pa.array([None if t is False else t for t in new], batch.schema.field(place).type)
            yield batch.set_column(place, batch.schema.field(place), texts).filter(stay)

    return df.mapInArrow(run, schema)


def _fields(schema: str) -> list[str]:
    parts, depth, current = [], 0, ""
    for character in schema:
        depth += (character == "<") - (character == ">")
        if character == "," and not depth:
            parts.append(current)
            current = ""
        else:
            current += character
    return [*parts, current]


_PLAIN = {
    "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "float": pa.float32(), "string": pa.string(), "binary": pa.binary(),
    "boolean": pa.bool_(),
}


def _arrow_types(schema: str) -> list[pa.DataType]:
    def of(name: str) -> pa.DataType:
        name = name.strip()
        if name.startswith("array<"):
            return pa.list_(of(name[6:-1]))
        if name.startswith("struct<"):
            inner = [part.strip().split(":", 1) for part in _fields(name[7:-1])]
            return pa.struct([(n.strip(), of(t)) for n, t in inner])
        return _PLAIN[name]

    return [of(part.strip().split(None, 1)[1]) for part in _fields(schema)]
