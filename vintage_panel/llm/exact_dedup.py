"""Exact duplicates by content sort.

Splitters sampled by Spark range-partition the normalised texts, each partition is sorted
externally, and neighbours are compared in full.  A range is cut by content first and by id
last, so a text with any number of copies spreads over as many partitions as it fills; the
runs at partition ends are then joined by their full text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from .common import lower_ascii, partitions, stored

HEAD = 64  # characters that the splitters carry; neighbours compare whole texts


def _runs(id_type: pa.DataType):
    """Function for mapInArrow: sorted rows in, rows with their run of equal texts out."""
    schema = pa.schema(
        [
            ("id", id_type), ("part", pa.int32()), ("run", pa.int64()), ("run_keep", id_type),
            ("run_size", pa.int64()), ("last", pa.bool_()), ("sha", pa.string()),
            ("edge_text", pa.string()),
        ]
    )

    def closed(run: dict, part: int, number: int, edge: bool) -> pa.RecordBatch:
        ids, n = run["ids"], len(run["ids"])
        keep = ids[-1]  # ids ascend, NULL first
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, id_type), pa.array([part] * n, pa.int32()),
                pa.array([number] * n, pa.int64()), pa.array([keep] * n, id_type),
                pa.array([n] * n, pa.int64()),
                pa.array([False] * (n - 1) + [True], pa.bool_()),
                pa.array([run["sha"]] * n, pa.string()),
                pa.array([None] * (n - 1) + [run["text"] if edge else None], pa.string()),
            ],
            schema=schema,
        )

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, first_key = TaskContext.get().partitionId(), 0, None
        waiting: list[tuple[dict, int]] = []  # runs that share the newest key, not yet out
        run: dict | None = None
        out: list[pa.RecordBatch] = []
        rows = 0

        def flush(last: bool) -> None:
            nonlocal waiting, rows
            for r, k in waiting:
                out.append(closed(r, part, k, last or r["key"] == first_key))
                rows += len(r["ids"])
            waiting = []

        for batch in batches:
            ids, texts, keys = (c.to_pylist() for c in batch.columns)
            for i, text, key in zip(ids, texts, keys, strict=True):
                if run is not None and key == run["key"] and text == run["text"]:
                    run["ids"].append(i)
                    continue
                if run is not None:
                    waiting.append((run, number))
                    number += 1
                    if key != run["key"]:
                        flush(False)
                first_key = key if first_key is None else first_key
                sha = hashlib.sha256(text.encode("utf-8", "replace")).hexdigest()
                run = {"text": text, "key": key, "ids": [i], "sha": sha}
            if rows > 5_000:
                yield pa.Table.from_batches(out, schema).combine_chunks().to_batches()[0]
                out, rows = [], 0
        if run is not None:
            waiting.append((run, number))
            flush(True)
        if out:
            yield pa.Table.from_batches(out, schema).combine_chunks().to_batches()[0]

    return mapped


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_partitions: int | None = None
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; NULL counts as empty.  Of equal
    texts the row with the largest id stays.  NULL ids come before all others, so they stay
    only in a group without ids.  Of rows that repeat an id and a text one stays.  An empty
    table gives no rows; other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    n = n_partitions or partitions(spark)
    base = docs.select(
        F.col(id_col).alias("id"), lower_ascii(F.coalesce(F.col(text_col), F.lit(""))).alias("norm")
    )
    content = [F.substring("norm", 1, HEAD), F.xxhash64("norm")]
    order = F.col("id").asc_nulls_first()
    ranged = (
        base.repartitionByRange(n, *content, order)
        .sortWithinPartitions(*content, "norm", order)
        .select("id", "norm", F.xxhash64("norm").alias("key"))
    )
    id_type = base.schema["id"].dataType
    fields = [
        ("id", id_type), ("part", T.IntegerType()), ("run", T.LongType()), ("run_keep", id_type),
        ("run_size", T.LongType()), ("last", T.BooleanType()), ("sha", T.StringType()),
        ("edge_text", T.StringType()),
    ]
    schema = T.StructType([T.StructField(*f) for f in fields])
    from pyspark.sql.pandas.types import to_arrow_type

    rows = stored(ranged.mapInArrow(_runs(to_arrow_type(id_type)), schema))

    # runs at partition ends: at most two per partition, but for hash collisions
    edges = rows.filter("edge_text is not null").select(
        "part", "run", "run_keep", "run_size", "edge_text"
    )
    whole = edges.groupBy("edge_text").agg(
        F.max("run_keep").alias("all_keep"),
        F.sum("run_size").alias("all_size"),
        F.max("part").alias("last_part"),
    )
    mend = edges.join(whole, "edge_text").select(
        "part", "run", "all_keep", "all_size", (F.col("part") == F.col("last_part")).alias("is_last")
    )
    return rows.join(F.broadcast(mend), ["part", "run"], "left").select(
        F.col("id").alias("doc_id"),
        F.when(F.col("all_size").isNull(), F.col("run_keep"))
        .otherwise(F.col("all_keep"))
        .alias("keep_id"),
        F.coalesce("all_size", "run_size").alias("group_size"),
        (F.col("last") & F.coalesce("is_last", F.lit(True))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
