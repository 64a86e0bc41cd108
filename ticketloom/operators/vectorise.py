"""Sparse feature rows made where the tickets are: nothing is shuffled and no id is needed.

Words come from Spark's expressions; their n-grams are looked up here as tuples, so no text is made
of those that the vocabulary has not.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom.session import bounded_batches, ship_with_tasks

ship_with_tasks(__name__)


@dataclass
class Lookup:
    """A bounded vocabulary and category dictionary as arrays for the tasks."""

    terms: pa.Array
    index: np.ndarray
    idf: np.ndarray
    values: list[pa.Array]  # per category column
    slots: list[np.ndarray]

    @classmethod
    def of(cls, vocab: DataFrame, dictionary: DataFrame | None, columns: list[str], n_terms: int) -> Lookup:
        """Both tables must be of checked size."""
        table = vocab.select("term", "idx", "idf").toArrow().combine_chunks()
        values, slots = [], []
        if columns:
            cells = dictionary.select("column_name", "value", "slot").toArrow().combine_chunks()
            for column in columns:
                own = cells.filter(pc.equal(cells["column_name"], column)).combine_chunks()
                values.append(_one(own["value"], pa.string()))
                slots.append(own["slot"].to_numpy().astype(np.int64) + n_terms)
        return cls(
            _one(table["term"], pa.string()), table["idx"].to_numpy().astype(np.int64),
            table["idf"].to_numpy(), values, slots)


def _one(column: pa.ChunkedArray, kind: pa.DataType) -> pa.Array:
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], kind)


def _found(column: pa.Array, known: pa.Array) -> np.ndarray:
    """Place of each value among the known ones, -1 for others."""
    return pc.fill_null(pc.index_in(column, value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64)


def _sparse(rows: np.ndarray, index: np.ndarray, weight: np.ndarray, n: int) -> tuple[pa.Array, pa.Array]:
    """Lists of indices, ascending, and of weights for n rows."""
    order = np.lexsort((index, rows))
    ends = pa.array(np.r_[0, np.cumsum(np.bincount(rows, minlength=n))].astype(np.int32))
    return (pa.ListArray.from_arrays(ends, pa.array(index[order].astype(np.int32))),
            pa.ListArray.from_arrays(ends, pa.array(weight[order])))


def _ngrams(words: list[str], low: int, high: int) -> Iterator[tuple[str, ...]]:
    for n in range(low, high + 1):
        yield from zip(*(words[k:] for k in range(n)))


def _vectoriser(shared, names: list[str], low: int, high: int):
    def vectorise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = Lookup(*shared.value)
        place_of = {tuple(t.split(" ")): i for i, t in enumerate(look.terms.to_pylist())}
        size = max(1, len(place_of))
        for batch in batches:
            n = batch.num_rows
            found = [np.zeros(0, np.int64)]
            for number, own in enumerate(batch.column("_words").to_pylist()):
                places = [p for p in map(place_of.get, _ngrams(own or [], low, high)) if p is not None]
                found.append(np.array(places, np.int64) + number * size)
            keys, tf = np.unique(np.concatenate(found), return_counts=True)
            rows, place = keys // size, keys % size
            order = np.lexsort((look.index[place], rows))
            rows, place = rows[order], place[order]
            raw = (np.log(tf[order].astype(float)) + 1.0) * look.idf[place]
            norm = np.sqrt(np.bincount(rows, raw * raw, minlength=n))
            parts = [(rows, look.index[place], raw / norm[rows])]
            cells = batch.column("_cells").flatten()
            for number, (values, slots) in enumerate(zip(look.values, look.slots)):
                place = _found(cells.take(pa.array(np.arange(n) * len(look.values) + number)), values)
                have = np.flatnonzero(place >= 0)
                parts.append((have, slots[place[have]], np.ones(len(have))))
            rows, index, weight = (np.concatenate(x) for x in zip(*parts))
            lists = _sparse(rows, index, weight, n)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *lists], [*names, "indices", "values"])

    return vectorise


def vectorise(
    tickets: DataFrame, keep: list[str], words: Column, low: int, high: int, cells: list[Column], lookup: Lookup
) -> DataFrame:
    """(*keep, indices, values): weights of the n-grams of `words`, an array of text, scaled to length
    one, then one slot per category cell. Unknown terms and cells add nothing.
    """
    bounded_batches(tickets.sparkSession)
    cells = F.array(*cells) if cells else F.array().cast("array<string>")
    rows = tickets.select(*keep, words.alias("_words"), cells.alias("_cells"))
    schema = T.StructType([
        *(rows.schema[c] for c in keep), T.StructField("indices", T.ArrayType(T.IntegerType())),
        T.StructField("values", T.ArrayType(T.DoubleType()))])
    # plain arrays: a broadcast names the class of a value, which workers need not have
    shared = tickets.sparkSession.sparkContext.broadcast(
        (lookup.terms, lookup.index, lookup.idf, lookup.values, lookup.slots))
    return rows.mapInArrow(_vectoriser(shared, keep, low, high), schema)
