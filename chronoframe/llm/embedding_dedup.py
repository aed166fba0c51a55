"""Operator 7: embedding near-dedup as an exact metric range join.

Vectors are compared within a label. Equal vectors are one class with a weight. Labels with many classes have pivots
(classes drawn by hash, as many as the label's size asks for, at most ``MOST_PIVOTS`` in all). A vector lives in the cell
of its nearest pivot; by the triangle inequality on angles it is copied to each other cell that may hold a partner: not
farther from that pivot than the cell's radius plus r, nor than its own pivot's distance plus 2 r. Each cell then joins by
itself, in blocks, so each class finds all its partners in the cell where it lives.

Defined results: null label or vector, zero vector, or null, infinite or NaN components: no links. Vectors of unequal
length have no links between them. Rows with equal vectors and labels are linked with each other. A null id is no
smallest id, unless there is no other. Extra columns are dropped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import Scratch, components

COSINE = 0.93
#: Classes of a label per pivot, about; raised when there would be more than MOST_PIVOTS in all.
CELL = 2000
MOST_PIVOTS = 16384
_SLACK = 1e-6


def usable(vector: str = "embedding", label: str = "label"):
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(label).isNotNull() & good & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    x = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), -1)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _angles(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(x @ pivots.T, -1, 1))


def _by_space(batch: pa.RecordBatch):
    """Rows of a batch by (label, dim), as positions and unit vectors."""
    spaces: dict[tuple, list[int]] = {}
    for i, s in enumerate(zip(batch.column("label").to_pylist(), batch.column("dim").to_pylist(), strict=True)):
        spaces.setdefault(s, []).append(i)
    for s, rows in spaces.items():
        yield s, np.array(rows), _matrix(batch.column("vector").take(pa.array(rows)))


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, key: str = "vec_id", cell: int = CELL) -> DataFrame:
    """(key, n_links, component_id, kept) of every row."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "vectors")
    r = float(np.arccos(cosine))
    rows = vectors.select(F.col(key).alias("id"), "label", "embedding", usable().alias("ok"))
    label_kind, vector_kind = dict(rows.dtypes)["label"], dict(rows.dtypes)["embedding"]
    classes = rows.where("ok").groupBy("label", F.col("embedding").alias("vector")).agg(F.count("*").alias("weight"), F.min("id").alias("least")).withColumns({"cid": F.monotonically_increasing_id(), "dim": F.size("vector")})
    classes = scratch.write(classes, "classes")

    total = classes.count()
    size = max(cell, -(-total // MOST_PIVOTS))
    spaces = classes.groupBy("label", "dim").count().where(F.col("count") > size).withColumn("k", F.ceil(F.col("count") / size))
    by_hash = Window.partitionBy("label", "dim").orderBy(F.xxhash64("cid"), "cid")
    drawn = classes.join(spaces.drop("count"), ["label", "dim"]).withColumn("n", F.row_number().over(by_hash)).where("n <= k").select("label", "dim", "n", "vector").collect()
    pivots: dict[tuple, np.ndarray] = {}
    for p in sorted(drawn, key=lambda p: (str(p["label"]), p["dim"], p["n"])):
        x = np.asarray(p["vector"], np.float64)
        pivots.setdefault((p["label"], p["dim"]), []).append(x / np.sqrt(x @ x))
    pivots = {k: np.stack(v) for k, v in pivots.items()}

    def home(batches):
        for batch in batches:
            cells, far = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows)
            for s, at, x in _by_space(batch):
                if s in pivots:
                    a = _angles(x, pivots[s])
                    cells[at] = a.argmin(axis=1)
                    far[at] = a.min(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells), pa.array(far)], names=[*batch.schema.names, "cell", "far"])

    fields = f"cid long, label {label_kind}, dim int, weight long, vector {vector_kind}"
    homes = scratch.write(classes.select("cid", "label", "dim", "weight", "vector").mapInArrow(home, f"{fields}, cell int, far double"), "homes")
    radius: dict[tuple, dict[int, float]] = {}
    if pivots:
        wide = homes.groupBy("label", "dim", "cell").agg(F.max("far").alias("far"))
        for c in wide.join(spaces.select("label", "dim"), ["label", "dim"], "left_semi").collect():
            radius.setdefault((c["label"], c["dim"]), {})[c["cell"]] = c["far"]

    def spread(batches):
        for batch in batches:
            take, cells, lives = [np.arange(batch.num_rows)], [batch.column("cell").to_numpy()], [np.ones(batch.num_rows, bool)]
            for s, at, x in _by_space(batch):
                if s not in pivots:
                    continue
                a = _angles(x, pivots[s])
                reach = np.array([radius[s].get(c, -np.inf) for c in range(len(pivots[s]))])
                own = cells[0][at]
                guest = (a <= reach[None, :] + r + _SLACK) & (a <= a.min(axis=1, keepdims=True) + 2 * r + _SLACK)
                guest[np.arange(len(at)), own] = False
                i, c = np.nonzero(guest)
                take.append(at[i])
                cells.append(c)
                lives.append(np.zeros(len(i), bool))
            rows = batch.select(["cid", "label", "dim", "weight", "vector"]).take(pa.array(np.concatenate(take)))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(np.concatenate(cells).astype(np.int32)), pa.array(np.concatenate(lives))], names=["cid", "label", "dim", "weight", "vector", "cell", "lives"])

    def join_cell(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        x = _matrix(table.column("vector").combine_chunks())
        cid, weight, lives = table.column("cid").to_numpy(), table.column("weight").to_numpy(), table.column("lives").to_numpy(zero_copy_only=False)
        mine, group, links = np.flatnonzero(lives), np.arange(len(cid)), np.zeros(len(cid), np.int64)
        for at in range(0, len(mine), 256):
            block = mine[at : at + 256]
            hit = x[block] @ x.T >= cosine
            hit[np.arange(len(block)), block] = True
            links[block] = hit @ weight - 1
            for i in np.flatnonzero(hit.sum(axis=1) > 1):
                near = group[hit[i]]
                low = near.min()
                if (near != low).any():
                    group[np.isin(group, near)] = low
        return pa.table({"cid": cid, "root": cid[group], "n_links": pa.array(links, mask=~lives)})

    dealt = homes.mapInArrow(spread, f"{fields}, cell int, lives boolean").groupBy("label", "dim", "cell").applyInArrow(join_cell, "cid long, root long, n_links long")
    told = scratch.write(dealt, "cells")
    comps = components(scratch, told.where("cid <> root").select(F.col("cid").alias("a"), F.col("root").alias("b")))
    linked = classes.join(told.where("n_links is not null").select("cid", "n_links"), "cid").join(comps, F.col("cid") == F.col("id"), "left").select("label", "vector", "least", "n_links", F.coalesce("root", "cid").alias("root"))
    smallest = linked.groupBy("root").agg(F.min("least").alias("smallest"))
    told = linked.join(smallest, "root").select(F.col("label").alias("l"), "vector", F.col("n_links").alias("n"), "smallest")
    out = rows.join(told, F.col("ok") & (F.col("label") == F.col("l")) & (F.col("embedding") == F.col("vector")), "left")
    return out.select(F.col("id").alias(key), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("smallest", "id").alias("component_id")).withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))
