"""Dictionaries and features of tile layers on Arrow batches, one layer part at a time (T22): a helper of ``pack.pack_tiles``.

Features come in the order of their parts, and a part begins where their number is a multiple of its size. No more than one
part and one batch are held.
"""

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

from .chains import _counts
from .clips import _nested

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this package


def _ranks(texts):
    """Distinct texts in order of their bytes, nulls first, and the place of each text among them."""
    held = texts.dictionary_encode(null_encoding="encode")
    order = pc.array_sort_indices(held.dictionary, null_placement="at_start").to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return held.dictionary.take(pa.array(order)), place[held.indices.to_numpy(zero_copy_only=False)]


def _packed(rows, n_keys, kinds):
    """The row of a part: its keys, layer order, key and value dictionaries, and features."""
    number, order, fid, gtype, geometry, names, texts = rows.columns[n_keys:]
    counts = _counts(names)
    owner = np.repeat(np.arange(len(counts)), counts)
    words, ki = _ranks(names.flatten())
    texts, ti = _ranks(texts.flatten())
    sorted_kinds = sorted({kinds.get(w, "string") for w in words.to_pylist()}, key=str.encode)
    kind_of = np.array([sorted_kinds.index(kinds.get(w, "string")) for w in words.to_pylist()], np.int64)
    pairs, vi = np.unique(kind_of[ki] * (len(texts) + 1) + ti, return_inverse=True)
    tags = np.lexsort((vi, ki, owner))
    tags = np.stack((ki[tags], vi[tags]), 1).astype(np.int32).ravel()
    value = pa.StructArray.from_arrays([pa.array(sorted_kinds, pa.string()).take(pa.array(pairs // (len(texts) + 1))), texts.take(pa.array(pairs % (len(texts) + 1)))], ["kind", "text"])
    features = pa.StructArray.from_arrays([fid, gtype, _nested(np.concatenate(([0], 2 * np.cumsum(counts))), pa.array(tags)), geometry], ["id", "type", "tags", "geometry"])
    one = lambda values: _nested([0, len(values)], values)
    return [*[c.slice(0, 1) for c in rows.columns[:n_keys]], order.slice(0, 1), one(words), one(value), one(features)]


def in_parts(names, n_keys, per_row, kinds):
    """For ``mapInArrow``: the keys of a part, and its packed columns, from features in order of part and number."""

    def run(batches):
        held = []  # of the part that may go on

        def packed():
            columns = [pa.concat_arrays(c) for c in zip(*(b.columns for b in held))]
            return pa.RecordBatch.from_arrays(_packed(pa.RecordBatch.from_arrays(columns, held[0].schema.names), n_keys, kinds), names=names)

        for batch in batches:
            if not batch.num_rows:
                continue
            begins = batch.column(n_keys).to_numpy() % per_row == 0
            cuts = [0, *(np.flatnonzero(begins[1:]) + 1), batch.num_rows]
            for low, high in zip(cuts, cuts[1:]):
                if low < high and begins[low] and held:
                    yield packed()
                    held.clear()
                held.append(batch.slice(low, high - low))
        if held:
            yield packed()

    return run
