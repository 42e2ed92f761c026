"""Nested JSON documents written as a stream of sorted pieces.

A piece is a value, or an item of a list, with the path of keys that leads to
it. Sorted by path, the pieces of a document follow one another as its
canonical text has them (keys sorted, no white space), so a task writes text
and digest piece by piece and holds no list of a document.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VALUE, LIST, ITEM = 0, 1, 2
#: Characters of a part of a document's text.
PART = 1 << 20


def canonical(text: str) -> str:
    return json.dumps(json.loads(text), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


class Encoder:
    """Turns pieces in the order of their paths into the text of one document."""

    def __init__(self) -> None:
        self.at: list[str] | None = None
        self.kind, self.items = VALUE, 0

    def add(self, path: list[str], kind: int, text: str | None) -> str:
        out = ""
        if self.at is None or path != self.at:
            out = self._move(path)
            self.at, self.kind, self.items = path, kind, 0
            if kind != VALUE:
                out += "["
        elif kind == VALUE or self.kind == VALUE:
            raise ValueError(f"two values at {'.'.join(path)}")
        if kind == VALUE:
            return out + canonical(text)
        if kind == ITEM:
            out += ("," if self.items else "") + canonical(text)
            self.items += 1
        return out

    def _move(self, path: list[str]) -> str:
        if self.at is None:
            out, common = "{", 0
        else:
            common = 0
            while common < min(len(path), len(self.at)) and path[common] == self.at[common]:
                common += 1
            if common == min(len(path), len(self.at)):
                raise ValueError(f"a value and an object at {'.'.join(path[:common])}")
            out = ("]" if self.kind != VALUE else "") + "}" * (len(self.at) - 1 - common) + ","
        return out + "{".join(json.dumps(k, ensure_ascii=False) + ":" for k in path[common:])

    def end(self) -> str:
        return "{}" if self.at is None else ("]" if self.kind != VALUE else "") + "}" * len(self.at)


def _piece(rows: DataFrame, keys: list[str], path: list[str] | Column, kind: int, order: list[str], text: Column) -> DataFrame:
    where = F.array(*map(F.lit, path)) if isinstance(path, list) else path
    by = F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in order]) if order else F.array().cast("array<string>")
    return rows.select(*keys, where.alias("_path"), F.lit(kind).alias("_kind"), by.alias("_order"), text.alias("_text"))


def value(rows: DataFrame, keys: list[str], path: list[str] | Column, column: Column) -> DataFrame:
    """One value for each row, null where ``column`` is."""
    return _piece(rows, keys, path, VALUE, [], _json(column))


def _json(column: Column) -> Column:
    """The JSON text of any column, wrapped in a list that the encoder of the piece takes off again."""
    return F.to_json(F.array(F.struct(column.alias("v"))), {"ignoreNullFields": "false"})


def items(rows: DataFrame, keys: list[str], path: list[str] | Column, order: list[str], item: Column | None = None) -> DataFrame:
    """An item of a list for each row, in the order of ``order`` as text: ``item``, or an object of all columns but the keys."""
    own = F.struct(*[c for c in rows.columns if c not in keys]) if item is None else item
    return _piece(rows, keys, path, ITEM, order, _json(own))


def empty_lists(rows: DataFrame, keys: list[str], path: list[str] | Column) -> DataFrame:
    """Declares a list for each row, so that it is written even if it has no items."""
    return _piece(rows, keys, path, LIST, [], F.lit(None).cast("string"))


def streamed(pieces: list[DataFrame], keys: list[str], part: int = PART) -> DataFrame:
    """(keys, part, text, sha256, size_bytes): the documents of all keys in parts.

    Parts of a document follow one another by number; the last one has the
    digest and size of the whole text. A document is one task's, as its digest
    needs its bytes in order; it is never held as a whole.
    """
    rows = reduce(DataFrame.unionByName, pieces)
    names = [*keys, "_path", "_kind", "_order", "_text"]
    rows = rows.select(*names).repartition(*keys).sortWithinPartitions(*names)
    schema = T.StructType([*(rows.schema[k] for k in keys), T.StructField("part", T.IntegerType()), T.StructField("text", T.StringType()), T.StructField("sha256", T.StringType()), T.StructField("size_bytes", T.LongType())])
    n = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, kinds = None, []
        encoder, sha, size, held, length, parts = Encoder(), hashlib.sha256(), 0, [], 0, 0

        def out(last: bool) -> pa.RecordBatch:
            nonlocal held, length, size, parts
            text = "".join(held)
            raw = text.encode()
            sha.update(raw)
            size += len(raw)
            row = [*now, parts, text, sha.hexdigest() if last else None, size if last else None]
            held, length, parts = [], 0, parts + 1
            return pa.record_batch([pa.array([v], t) for v, t in zip(row, [*kinds, pa.int32(), pa.string(), pa.string(), pa.int64()], strict=True)], names=schema.names)

        for batch in batches:
            kinds = [batch.schema.field(k).type for k in range(n)]
            columns = [c.to_pylist() for c in batch.columns]
            for key, path, kind, text in zip(zip(*columns[:n], strict=True), columns[n], columns[n + 1], columns[n + 3], strict=True):
                if key != now:
                    if now is not None:
                        held.append(encoder.end())
                        yield out(True)
                    now = key
                    encoder, sha, size, held, length, parts = Encoder(), hashlib.sha256(), 0, [], 0, 0
                # the piece without the list and the name around it
                more = encoder.add(path, kind, None if text is None else text[len('[{"v":') : -len("}]")])
                held.append(more)
                length += len(more)
                if length >= part:
                    yield out(False)
        if now is not None:
            held.append(encoder.end())
            yield out(True)

    return rows.mapInArrow(run, schema)


def index(parts: DataFrame, keys: list[str]) -> DataFrame:
    """(bundle_id, sha256, size_bytes, keys) of every document."""
    return parts.where("sha256 is not null").select(F.concat(F.lit("bundle_"), F.col("sha256")).alias("bundle_id"), "sha256", "size_bytes", *keys)


def write(parts: DataFrame, keys: list[str], path: str) -> None:
    """A folder ``bundle_id=...`` for each document below ``path``/documents, one file of its parts as lines, and ``path``/index.

    Line breaks between the parts stand between tokens; without them the file is the canonical text.
    """
    named = index(parts, keys)
    rows = parts.join(named.select("bundle_id", *keys), keys).select("bundle_id", "part", "text")
    rows.repartition("bundle_id").sortWithinPartitions("bundle_id", "part").select("bundle_id", F.col("text").alias("value")).write.partitionBy("bundle_id").text(f"{path}/documents")
    named.write.json(f"{path}/index")
