"""Token ids in Arrow files of fixed-size-list batches, and their way back."""

from __future__ import annotations

import json
import re
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from duoscope.llm.common import (
    WordKind, default_parts, order_bounds, shared_dir, stored, trimmed, word_hashes, word_spans,
)
from duoscope.llm.sorted_files import blocks

END_ID = 2
#: Ids in a sequence, and sequences in a record batch.
SEQUENCE = 2048
BATCH = 64
#: Runs of letters up to this length are remembered by a Python worker, this many twice over; and so many pieces of text.
PIECE, RUNS, REMEMBERED = 40, 100_000, 500_000
#: Pieces are what lies between blanks and line feeds.
PIECES = WordKind({0x20, 0x0A})

ENCODED = "part int, doc_id bigint, ids binary"
MANIFEST = "part int, path string, n_docs bigint, n_tokens bigint"
BACK = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


# What a tokenizer does before its model if its ids can be found word by word.
WORD_STEPS = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"},
    ]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "behavior": "Removed", "invert": True, "pattern": {
            "Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ]},
    "post_processor": None,
}

#: Printable Latin-1 without apostrophe and blanks: its small letters, digits and signs are one code point each.
_LATIN = re.compile("[!-&(-~\u00a1-\u00ff]+")
_RUNS = re.compile("[a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u00ff]+|[0-9\u00b2\u00b3\u00b9\u00bc-\u00be]|[^a-z0-9\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u00ff\u00b2\u00b3\u00b9\u00bc-\u00be]+")


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class Encoder:
    """A tokenizer with a memory of pieces.

    For a tokenizer with :data:`WORD_STEPS`, blanks and line feeds end a token and are
    dropped, so a text's ids are those of the pieces between them; and a piece of
    Latin-1 falls into runs of letters, digits and runs of signs that its model encodes one by
    one. Other pieces go through the whole tokenizer, and so do whole texts of any
    other tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        shape = json.loads(self.tokenizer.to_str())
        self.by_word = all(shape.get(k) == v for k, v in WORD_STEPS.items())
        specials = [t["content"] for t in shape["added_tokens"]]
        self.starts = sorted({t[:2] for t in specials})
        self.by_word &= not any(" " in t or "\n" in t for t in specials)
        self.by_word &= not any(t[k] for t in shape["added_tokens"] for k in ("lstrip", "rstrip", "single_word"))
        self.width = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.code = {2: "H", 4: "I"}[self.width.itemsize] if sys.byteorder == "little" else None
        self.by_word &= self.code is not None
        self.model = self.tokenizer.model
        self.letters = str.maketrans(_byte_letters())
        self.young_runs: dict[str, bytes] = {}
        self.old_runs: dict[str, bytes] = {}
        self._forget()

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.width).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _run(self, run: str) -> bytes:
        ids = self.young_runs.get(run)
        if ids is None:
            ids = self.old_runs.get(run)
            if ids is None:
                # Printable ASCII is spelled as itself.
                spelled = run if run.isascii() else run.encode("utf-8").decode("latin-1").translate(self.letters)
                ids = array(self.code, [t.id for t in self.model.tokenize(spelled)]).tobytes()
            if len(run) <= PIECE:
                self.young_runs[run] = ids
        return ids

    def _pieces(self, wanted: list[str]) -> dict[str, bytes]:
        """Ids of each piece."""
        out, rest, run = {}, [], self._run
        for w in wanted:
            latin = w.isprintable() and "'" not in w if w.isascii() else _LATIN.fullmatch(w)
            if latin:
                low = w.lower()
                out[w] = run(low) if low.isalpha() and low.isascii() else b"".join(map(run, _RUNS.findall(low)))
            else:
                rest.append(w)
        if rest:
            out.update(zip(rest, self._whole(rest)))
        if len(self.young_runs) > RUNS:
            self.old_runs, self.young_runs = self.young_runs, {}
        return out

    def _places(self, codes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Where the ids of each piece are, by its hash; new pieces are encoded."""
        at = np.searchsorted(self.codes, codes)
        known = at < len(self.codes)
        known[known] = self.codes[at[known]] == codes[known]
        new = np.flatnonzero(~known)
        if len(new) + len(self.codes) > REMEMBERED and len(self.codes):
            self._forget()
            return self._places(codes, data, starts, ends)
        if len(new):
            body = data.tobytes()
            words = [body[a:b].decode("utf-8", "replace") for a, b in zip(starts[new].tolist(), ends[new].tolist())]
            found = self._pieces(words)
            ids = [found[w] for w in words]
            size = np.fromiter(map(len, ids), np.int64, len(ids)) // self.width.itemsize
            offset = len(self.pool) + np.cumsum(size) - size
            self.pool = np.concatenate([self.pool, np.frombuffer(b"".join(ids), self.width)])
            self.offset, self.size = np.concatenate([self.offset, offset]), np.concatenate([self.size, size])
            self.codes = np.insert(self.codes, at[new], codes[new])
            self.entry = np.insert(self.entry, at[new], len(self.size) - len(new) + np.arange(len(new)))
            at = np.searchsorted(self.codes, codes)
        return self.entry[at]

    def _forget(self) -> None:
        self.codes, self.entry = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.pool, self.offset, self.size = np.zeros(0, self.width), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text, little-endian, in as few bytes as the vocabulary needs.

        Pieces are found and told apart by 64-bit hashes of their bytes (ASCII letters in either case, as they are encoded alike), a block of
        text at a time; the ids of those met before are gathered.
        """
        texts = texts.fill_null("")
        if not self.by_word:
            return self._whole(texts.to_pylist())
        special = np.zeros(len(texts), bool)
        for s in self.starts:
            special |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        out: list[list[bytes]] = [[] for _ in range(len(texts))]
        for b in blocks(pc.if_else(pa.array(special), "", texts), PIECES):
            starts, ends, edges = word_spans(b.data, b.offsets, PIECES)
            codes, first, back = np.unique(word_hashes(b.data, starts, ends, PIECES), return_index=True, return_inverse=True)
            places = self._places(codes, b.data, starts[first], ends[first])[back]
            size = self.size[places]
            bounds = np.zeros(len(size) + 1, np.int64)
            np.cumsum(size, out=bounds[1:])
            ids = self.pool[np.repeat(self.offset[places] - bounds[:-1], size) + np.arange(bounds[-1])]
            cuts = bounds[edges].tolist()
            for row, (lo, hi) in enumerate(zip(cuts, cuts[1:]), b.first):
                out[row].append(ids[lo:hi].tobytes())
        rows = np.flatnonzero(special).tolist()
        for row, ids in zip(rows, self._whole([texts[i].as_py() for i in rows]) if rows else []):
            out[row] = [ids]
        return [o[0] if len(o) == 1 else b"".join(o) for o in out]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This Python worker's encoder for a tokenizer file."""
    if path not in _ENCODERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _encode(path: str, bounds: np.ndarray, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        it = encoder(path)
        end = np.array([end_id], it.width).tobytes()
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                keys = batch.column("doc_id")
                parts = np.searchsorted(bounds, keys.fill_null(np.iinfo(np.int64).min).to_numpy(), side="right")
                ids = it.encode(batch.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(parts, pa.int32()), keys, pa.array([i + end for i in ids], pa.binary())],
                    names=["part", "doc_id", "ids"],
                )

    return run


class _PartWriter:
    """One part's file of sequences and its index of documents, each put in place when complete."""

    def __init__(self, base: str, part: int, width: np.dtype, sequence: int):
        self.store, root = fs.FileSystem.from_uri(base)
        self.part, self.width, self.sequence = part, width, sequence
        self.path = f"{root}/part-{part:06d}.arrow"
        self.own = f"{root}/.part-{part:06d}-{uuid.uuid4().hex}"
        ids = pa.list_(pa.from_numpy_dtype(width), sequence)
        self.schema = pa.schema([("ids", ids), ("mask", pa.list_(pa.bool_(), sequence))])
        self.store.create_dir(root, recursive=True)
        self.sink = self.store.open_output_stream(self.own)
        self.file = pa.ipc.new_file(self.sink, self.schema)
        self.buffer: list[bytes] = []
        self.held = self.n_tokens = 0
        self.docs: list[tuple[int | None, int, int]] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n = len(ids) // self.width.itemsize
        self.docs.append((doc_id, self.n_tokens, n))
        self.n_tokens += n
        self.buffer.append(ids)
        self.held += n
        if self.held >= self.sequence * BATCH:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        flat = np.frombuffer(b"".join(self.buffer), self.width)
        step = self.sequence * BATCH
        upto = len(flat) if last else len(flat) - len(flat) % self.sequence
        for at in range(0, upto, step):
            ids = flat[at : min(at + step, upto)]
            rows = -(-len(ids) // self.sequence)
            mask = np.zeros(rows * self.sequence, bool)
            mask[: len(ids)] = True
            padded = np.zeros(rows * self.sequence, self.width)
            padded[: len(ids)] = ids
            self.file.write_batch(pa.RecordBatch.from_arrays(
                [pa.FixedSizeListArray.from_arrays(pa.array(padded), self.sequence), pa.FixedSizeListArray.from_arrays(pa.array(mask), self.sequence)],
                schema=self.schema,
            ))
        self.buffer, self.held = [flat[upto:].tobytes()], len(flat) - upto

    def close(self) -> tuple[int, str, int, int]:
        self._flush(True)
        self.file.close()
        self.sink.close()
        keys, starts, sizes = zip(*self.docs)
        index = pa.table({"doc_id": pa.array(keys, pa.int64()), "start": pa.array(starts, pa.int64()), "n_tokens": pa.array(sizes, pa.int64())})
        with self.store.open_output_stream(self.own + ".index") as sink, pa.ipc.new_file(sink, index.schema) as file:
            file.write_table(index)
        # A part's content does not depend on the attempt that wrote it, so the last one may win.
        self.store.move(self.own + ".index", self.path + ".index")
        self.store.move(self.own, self.path)
        return self.part, self.path, len(self.docs), self.n_tokens


def _write(base: str, width: np.dtype, sequence: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, done = None, []
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("part", "doc_id", "ids"))
            for part, doc_id, ids in zip(*columns):
                if writer is None or part != writer.part:
                    if writer is not None:
                        done.append(writer.close())
                    writer = _PartWriter(base, part, width, sequence)
                writer.add(doc_id, ids)
        if writer is not None:
            done.append(writer.close())
        columns = list(zip(*done)) or [[], [], [], []]
        kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["part", "path", "n_docs", "n_tokens"]
        )

    return run


def write_tokens(
    docs: DataFrame, tokenizer: str, base: str, end_id: int = END_ID, sequence: int = SEQUENCE, parts: int | None = None
) -> DataFrame:
    """Write the ids of all documents in ascending doc_id order; return the manifest.

    The order is cut into parts by ranges of doc_id, sorted inside. A part is one Arrow
    file: record batches with ``ids`` and ``mask``, both fixed-size lists of
    ``sequence`` values, so the n-th sequence lies at a known place; documents
    follow each other without gaps, and only a part's last sequence is padded
    (mask 0). Beside it, ``.index`` holds each document's id, start and length. The manifest
    has ``part, path, n_docs, n_tokens`` and ``start`` (ids in earlier parts).

    Null texts count as empty: such a document is its end id. Null ids come
    first, equal ids follow each other in order of their ids' bytes. An empty table gives no files. Files are
    written under a name of their attempt and renamed when complete. ``base`` is a
    folder that all executors share, by any URI that Arrow can write to.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n = parts or default_parts(spark, rows.count())
    bounds = order_bounds(rows, "doc_id", n)
    width = encoder(tokenizer).width
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = (
        rows.mapInArrow(trimmed(_encode(tokenizer, bounds, end_id)), ENCODED)
        .repartitionById(tasks, F.pmod("part", F.lit(tasks)))
        .sortWithinPartitions("part", "doc_id", "ids")
    )
    manifest = stored(dealt.mapInArrow(_write(base, width, sequence), MANIFEST), "tokens")
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # a row per file
    return manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def _documents(base: str, path: str) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """``(doc_id, start in the file, ids)`` of a part's documents, one record batch in memory at a time."""
    store, _ = fs.FileSystem.from_uri(base)
    with store.open_input_file(path + ".index") as f:
        index = pa.ipc.open_file(f).read_all()
    with store.open_input_file(path) as f:
        file = pa.ipc.open_file(f)
        held, at = [], 0
        have = 0
        for doc_id, start, n in zip(*(index.column(c).to_pylist() for c in ("doc_id", "start", "n_tokens"))):
            while have < n:
                batch = file.get_batch(at)
                ids = batch.column("ids").flatten().to_numpy()
                held.append(ids[batch.column("mask").flatten().to_numpy(zero_copy_only=False)])
                have += len(held[-1])
                at += 1
            flat = held[0] if len(held) == 1 else np.concatenate(held)
            yield doc_id, start, flat[:n]
            held, have = [flat[n:]], have - n


def _read(base: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _ENCODERS.clear()  # all is encoded by now, and what this worker remembers can go
        for batch in batches:
            for path, before in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                rows = [
                    (doc_id, before + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
                    for doc_id, start, ids in _documents(base, path)
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*rows)], names=["doc_id", "start", "n_tokens", "ids_crc32"]
                )

    return run


def read_tokens(manifest: DataFrame, base: str) -> DataFrame:
    """Read the files of a manifest: per document its id, global start, length and checksum.

    A file's start travels with its path, so nothing is joined.
    """
    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    files = manifest.select("path", "start", F.pmod("part", F.lit(n)).alias("task"))
    return files.repartitionById(n, "task").mapInArrow(trimmed(_read(base)), BACK)


def token_output(docs: DataFrame, tokenizer: str | None = None, **options) -> DataFrame:
    """Write documents' ids to a new folder beside the checkpoints and read them back.

    ``tokenizer`` is a tokenizer file; by default that of the public 49k word vocabulary.
    """
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    base = f"{shared_dir(docs.sparkSession).rstrip('/')}/token-files-{uuid.uuid4().hex}"
    return read_tokens(write_tokens(docs, tokenizer, base, **options), base)


def op8_token_files(spark, sf_dir: str) -> DataFrame:
    """All documents' token files, read back."""
    return token_output(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
