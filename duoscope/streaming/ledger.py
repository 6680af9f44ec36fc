"""The ledger's current state as a stream: appended writes merge into versioned snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from duoscope.operators.ledger import CELL, final_state, merged_state, partial_state
from duoscope.storage import shared_dir


def _versions(path: str) -> list[int]:
    """Numbers of the complete snapshots of a table, from its folder's listing."""
    store, folder = fs.FileSystem.from_uri(path)
    found = store.get_file_info(fs.FileSelector(f"{folder}/", allow_not_found=True, recursive=False))
    done = store.get_file_info([f"{f.path}/_SUCCESS" for f in found if f.base_name.startswith("version=")])
    names = [d.path.rsplit("/", 2)[1] for d in done if d.type == fs.FileType.File]
    return sorted(int(n.removeprefix("version=")) for n in names)


def _snapshot(spark: SparkSession, path: str, below: int | None = None) -> tuple[int | None, DataFrame | None]:
    found = [v for v in _versions(path) if below is None or v < below]
    return (found[-1], spark.read.parquet(f"{path}/version={found[-1]}")) if found else (None, None)


def follow_ledger(
    spark: SparkSession, landed: DataFrame, path: str, name: str = "ledger-state", keys: Sequence[str] = CELL, seq: str = "seq", keep: int = 2
):
    """Merge all writes that have landed into the state table at ``path``; returns when that is done.

    ``landed`` is a streaming DataFrame of ledger writes. Snapshot k holds the partial states after batch k: those of the
    snapshot before it and of the batch, merged. Merging takes maxima only, so late writes find their place and a batch
    or a write that comes twice changes nothing. A batch that is run again, after a lost driver say, reads the snapshot
    below its own number and overwrites its own. Progress is kept in the folder that all executors share. Older snapshots
    than the last ``keep`` are removed. ``path`` is a URI or an absolute path that the driver can list.
    """
    def merge(batch: DataFrame, number: int) -> None:
        fresh = partial_state(batch, keys, seq)
        _, before = _snapshot(spark, path, number)
        rows = merged_state(before.unionByName(fresh), keys) if before is not None else fresh
        rows.write.mode("overwrite").parquet(f"{path}/version={number}")
        for old in _versions(path)[: -keep]:
            _empty(f"{path}/version={old}")

    query = (
        landed.writeStream.foreachBatch(merge)
        .option("checkpointLocation", f"{shared_dir(spark).rstrip('/')}/{name}").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def _empty(path: str) -> None:
    store, folder = fs.FileSystem.from_uri(path)
    store.delete_dir(folder)


def followed_state(spark: SparkSession, path: str, keys: Sequence[str] = CELL, seq: str = "seq") -> DataFrame:
    """Current cells of the newest snapshot."""
    _, rows = _snapshot(spark, path)
    if rows is None:
        raise FileNotFoundError(f"no snapshot in {path}")
    return final_state(rows, keys, seq)


def compact(spark: SparkSession, writes: DataFrame, path: str, keys: Sequence[str] = CELL, seq: str = "seq") -> int:
    """Write a snapshot of all ``writes`` and of the snapshot before it; returns its number.

    Afterwards the state is that of the snapshot and of what is appended later (:func:`compacted_state`), and
    the writes that went into it need not be read again.
    """
    number, before = _snapshot(spark, path)
    fresh = partial_state(writes, keys, seq)
    rows = merged_state(before.unionByName(fresh), keys) if before is not None else fresh
    new = 0 if number is None else number + 1
    rows.write.mode("overwrite").parquet(f"{path}/version={new}")
    return new


def compacted_state(spark: SparkSession, path: str, tail: DataFrame | None = None, keys: Sequence[str] = CELL, seq: str = "seq") -> DataFrame:
    """Current cells from the newest snapshot and the writes after it."""
    _, rows = _snapshot(spark, path)
    parts = [p for p in (rows, partial_state(tail, keys, seq) if tail is not None else None) if p is not None]
    if not parts:
        raise FileNotFoundError(f"neither a snapshot in {path} nor writes")
    both = parts[0] if len(parts) == 1 else merged_state(parts[0].unionByName(parts[1]), keys)
    return final_state(both, keys, seq)
