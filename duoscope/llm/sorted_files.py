"""Numbers filed under sorted 64-bit codes in files of the shared folder, and texts as blocks of words."""

from __future__ import annotations

import uuid
from collections import OrderedDict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame

from duoscope.llm.common import WordKind, shared_dir, text_chunks

#: Bytes of text in a block; only a single longer word makes a longer block.
BLOCK_BYTES = 2 << 20
#: Files that a Python worker holds open at once.
OPEN_FILES = 64


@dataclass
class Block:
    """Whole rows ``first ...``, or a piece of one long row."""

    first: int
    data: np.ndarray
    offsets: np.ndarray
    continued: bool = False
    complete: bool = True


def blocks(texts: pa.Array, kind: WordKind, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a string array into blocks; a text above ``limit`` bytes is cut between words into several."""
    for first, last, data, offsets in text_chunks(texts, limit):
        if last - first > 1 or len(data) <= limit:
            yield Block(first, data, offsets)
            continue
        at = 0
        while at < len(data):
            end = min(at + limit, len(data))
            if end < len(data):
                gaps = np.flatnonzero(~kind.is_word[data[at:end]])
                if len(gaps):
                    end = at + int(gaps[-1]) + 1
                while end < len(data) and kind.is_word[data[end - 1]]:
                    more = np.flatnonzero(~kind.is_word[data[end : end + limit]])
                    end = end + int(more[0]) + 1 if len(more) else min(end + limit, len(data))
            piece = data[at:end]
            yield Block(first, piece, np.array([0, len(piece)]), at > 0, end == len(data))
            at = end


def new_folder(spark, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_file(base: str, columns: dict[str, np.ndarray]) -> str:
    """Write one Arrow file under a name of its own; its path.

    Only the names that a successful attempt returns are used, so files of lost attempts do no harm.
    """
    store, folder = fs.FileSystem.from_uri(base)
    store.create_dir(folder)
    path = f"{folder}/{uuid.uuid4().hex}"
    batch = pa.RecordBatch.from_arrays([pa.array(v) for v in columns.values()], names=list(columns))
    with store.open_output_stream(path) as sink, pa.ipc.new_file(sink, batch.schema) as file:
        file.write_batch(batch)
    return path


def read_file(base: str, path: str) -> dict[str, np.ndarray]:
    """The columns of a file: mapped where the folder is a mounted one, else read."""
    store, _ = fs.FileSystem.from_uri(base)
    if isinstance(store, fs.LocalFileSystem):
        store = fs.LocalFileSystem(use_mmap=True)
    batch = pa.ipc.open_file(store.open_input_file(path)).get_batch(0)
    return {n: batch.column(n).to_numpy() for n in batch.schema.names}


class SortedFiles:
    """Files with a sorted ``code`` column each, in ascending ranges of codes.

    Only the list of files (first code and path) travels to the workers; they look codes up in
    sorted order and hold at most ``OPEN_FILES`` files.
    """

    def __init__(self, base: str, files: Sequence[tuple[int, str]]):
        files = sorted(files)
        self.base = base
        self.firsts = np.array([f[0] for f in files], np.int64)
        self.paths = [f[1] for f in files]
        self._open: OrderedDict | None = None

    def __getstate__(self):
        return self.__dict__ | {"_open": None}

    def _columns(self, path: str) -> dict[str, np.ndarray]:
        if self._open is None:
            self._open = OrderedDict()
        if path in self._open:
            self._open.move_to_end(path)
            return self._open[path]
        found = self._open[path] = read_file(self.base, path)
        if len(self._open) > OPEN_FILES:
            self._open.popitem(last=False)
        return found

    def find(self, codes: np.ndarray, columns: dict[str, type], distinct: bool = False) -> list[np.ndarray]:
        """Values of each code, by column; 0 where a code is not filed. ``distinct``: codes are sorted and come once."""
        wanted, back = (codes, slice(None)) if distinct else np.unique(codes, return_inverse=True)
        out = [np.zeros(len(wanted), t) for t in columns.values()]
        which = np.searchsorted(self.firsts, wanted, side="right") - 1
        edges = [0, *(np.flatnonzero(np.diff(which)) + 1).tolist(), len(which)]
        for lo, hi in zip(edges, edges[1:]):
            if lo == hi or which[lo] < 0:
                continue
            table = self._columns(self.paths[which[lo]])
            at = np.minimum(np.searchsorted(table["code"], wanted[lo:hi]), len(table["code"]) - 1)
            hit = table["code"][at] == wanted[lo:hi]
            for o, name in zip(out, columns):
                o[lo:hi][hit] = table[name][at[hit]]
        return [o[back] for o in out]


def write_sorted(rows: DataFrame, base: str, code: str, columns: dict[str, type], most: int = 500_000) -> SortedFiles:
    """File the rows under distinct codes, ``most`` to a file. A row per file comes to the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, held, n = [], [], 0

        def flush() -> None:
            nonlocal held, n
            if n:
                merged = {"code": np.concatenate([h[0] for h in held])}
                merged |= {c: np.concatenate([h[j + 1] for h in held]) for j, c in enumerate(columns)}
                done.append((int(merged["code"][0]), write_file(base, merged)))
            held, n = [], 0

        for batch in batches:
            values = [batch.column(c).to_numpy(zero_copy_only=False).astype(t) for c, t in [(code, np.int64), *columns.items()]]
            for at in range(0, batch.num_rows, most):
                held.append([v[at : at + most] for v in values])
                n += len(held[-1][0])
                if n >= most:
                    flush()
        flush()
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string())], names=["first", "path"]
        )

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.select(code, *columns).repartitionByRange(n, code).sortWithinPartitions(code)
    files = dealt.mapInArrow(run, "first bigint, path string").collect()
    return SortedFiles(base, [(r["first"], r["path"]) for r in files])
