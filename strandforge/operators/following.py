"""The next row of a group in an order, for which rows travel packed."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from ..shipping import ship

#: Parts into which groups are dealt, rows that a task packs at once, and most values of a string column that are told by numbers.
PARTS, HELD, FEW = 1024, 1 << 20, 16


def _pack(group: str):
    def out(t: pa.Table) -> pa.RecordBatch:
        t = t.take(pc.sort_indices(t, sort_keys=[("_part", "ascending"), (group, "ascending")]))
        part, t = t["_part"].to_numpy(), t.drop(["_part"]).combine_chunks()
        for k, c in enumerate(t.column_names):
            if pa.types.is_string(t.schema.field(c).type) and len((x := t[c].combine_chunks().dictionary_encode()).dictionary) <= FEW:
                t = t.set_column(k, c, x)
        cut, raws = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(part)]]), []
        for i, j in zip(cut[:-1], cut[1:]):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, t.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                w.write_table(t.slice(i, j - i))
            raws.append(sink.getvalue().to_pybytes())
        return pa.RecordBatch.from_arrays([pa.array(part[cut[:-1]]), pa.array(raws, pa.binary())], names=["_part", "_rows"])

    def run(batches):
        held, n = [], 0
        for b in batches:
            held.append(b)
            n += b.num_rows
            if n >= HELD:
                yield out(pa.Table.from_batches(held).combine_chunks())
                held, n = [], 0
        if n:
            yield out(pa.Table.from_batches(held).combine_chunks())

    return run


def _unpacked(raw: bytes) -> pa.Table:
    t = pa.ipc.open_stream(raw).read_all()
    return pa.table({c: t[c].cast(t[c].type.value_type) if pa.types.is_dictionary(t[c].type) else t[c] for c in t.column_names})


def packed(df: DataFrame, group: str) -> DataFrame:
    """The rows that have a group, as compressed bytes by parts of the groups."""
    ship(df.sparkSession)
    rows = df.where(f"{group} is not null").selectExpr("*", f"pmod(xxhash64({group}), {PARTS}) as _part")
    return rows.mapInArrow(_pack(group), "_part long, _rows binary")


def followed(rows: DataFrame, like: DataFrame, group: str, order: list[str], keep: list[str], after: dict[str, str]) -> DataFrame:
    """Of the packed() rows of `like` those that another of their group follows: keep, and columns of the next under new names.

    Nulls come last in the order, as in SQL. All rows of a part, and so of a group, meet in one task.
    """

    def out(raws):
        t = pa.concat_tables([_unpacked(r) for r in raws]).combine_chunks()
        t = t.take(pc.sort_indices(t, sort_keys=[(c, "ascending") for c in (group, *order)], null_placement="at_end")).combine_chunks()
        g = t[group]
        at = np.flatnonzero(pc.equal(g.slice(1), g.slice(0, max(0, len(g) - 1))).to_numpy())
        own, other = t.take(pa.array(at)), t.take(pa.array(at + 1))
        return pa.table({**{c: own[c] for c in keep}, **{new: other[c] for c, new in after.items()}}).combine_chunks().to_batches()

    def run(batches):
        now, raws = None, []
        for b in batches:
            for part, raw in zip(b["_part"].to_pylist(), b["_rows"].to_pylist()):
                if raws and part != now:
                    yield from out(raws)
                    raws = []
                now = part
                raws.append(raw)
        if raws:
            yield from out(raws)

    schema = [f"`{new}` {like.schema[c].dataType.simpleString()}" for c, new in [*zip(keep, keep), *after.items()]]
    return rows.repartition("_part").sortWithinPartitions("_part").mapInArrow(run, ", ".join(schema))
