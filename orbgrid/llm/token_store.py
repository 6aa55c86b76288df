"""Token ids in binary files: byte or bit planes of fixed-size blocks, zstandard, chunk index.

A file holds whole documents in order of their id::

    magic (8 bytes)
    planes of block 0, planes of block 1, ...     each plane one zstandard frame
    footer: zstandard frame of an Arrow stream pair (documents, chunk index)
    length of the footer (8 bytes, little endian), magic (8 bytes)

A block has ``BLOCK_IDS`` ids (the last one fewer) as little-endian unsigned
32-bit integers.  Their bytes (or bits) are transposed, so that each plane
has the same byte (or bit) of every id; the high planes are nearly all zero.
The chunk index has, for each plane, its block, offset and length, so that
any block can be read alone.
"""

from __future__ import annotations

import io
import json
import os
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orbgrid.llm.common import stored
from orbgrid.session import scratch_root

MAGIC = b"PLANES01"
BLOCK_IDS = 1 << 16
#: A file is closed with the first document that brings it to so many ids.
FILE_IDS = 1 << 21
LEVEL = 3
#: Characters that are split into words at a time, and words whose ids a worker remembers.
PIECE_CHARS, MEMO_WORDS, MEMO_CHARS = 1 << 22, 400_000, 64
#: Marks that end words.
_MARKS = ".,!?;:%$#&*|"

#: Normaliser, splitter and word end of the tokenizers that are encoded by word.
_BY_WORD = (
    {'type': 'Sequence', 'normalizers': [{'type': 'NFC'}, {'type': 'Replace', 'pattern': {'Regex': '\\s+'}, 'content': ' '}, {'type': 'Lowercase'}]},
    {'type': 'Sequence', 'pretokenizers': [{'type': 'Split', 'pattern': {'Regex': "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, 'behavior': 'Removed', 'invert': True}, {'type': 'ByteLevel', 'add_prefix_space': False, 'trim_offsets': True, 'use_regex': False}]},
    "</w>",
)

#: Words of Basic Latin and Latin-1 letters alone: lower-casing and splitting leave them whole.
_PLAIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch
#: Byte-level BPE writes each byte as a character: itself where it prints, else the next from 256 on.
_BYTE_LEVEL = {
    b: 256 + n
    for n, b in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255))
}


# -- planes and files -----------------------------------------------------------------------------


def to_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """The planes of one block, lowest first."""
    raw = ids.astype("<u4", copy=False).view(np.uint8).reshape(-1, 4)
    if kind == "bit":
        raw = np.unpackbits(raw, axis=1, bitorder="little")
        return [p.tobytes() for p in np.packbits(raw.T, axis=1, bitorder="little")]
    return [p.tobytes() for p in raw.T]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    """The ids of one block; 4 planes are bytes, 32 are bits."""
    rows = np.frombuffer(b"".join(planes), np.uint8).reshape(len(planes), -1)
    if len(planes) == 32:
        bits = np.unpackbits(rows, axis=1, bitorder="little")[:, :n]
        rows = np.packbits(bits.T, axis=1, bitorder="little")
        return np.ascontiguousarray(rows).view("<u4").ravel()
    return np.ascontiguousarray(rows.T).view("<u4").ravel()


def encode_file(doc_ids: list, lengths: list[int], data: bytes, kind: str) -> bytes:
    """The bytes of one file; ``data`` has the documents' ids, one after another."""
    pack = zstandard.ZstdCompressor(level=LEVEL).compress
    ids, out, at = np.frombuffer(data, "<u4"), io.BytesIO(), len(MAGIC)
    out.write(MAGIC)
    index: dict[str, list[int]] = {"block": [], "offset": [], "length": [], "n_ids": []}
    for block, first in enumerate(range(0, len(ids), BLOCK_IDS)):
        part = ids[first : first + BLOCK_IDS]
        for plane in map(pack, to_planes(part, kind)):
            out.write(plane)
            for key, value in zip(index, (block, at, len(plane), len(part)), strict=True):
                index[key].append(value)
            at += len(plane)
    documents = pa.table({"doc_id": pa.array(doc_ids, pa.int64()), "n_ids": pa.array(lengths, pa.int64())})
    chunks = pa.table({k: pa.array(v, pa.int64()) for k, v in index.items()})
    foot = io.BytesIO()
    for table in (documents, chunks):
        with pa.ipc.new_stream(foot, table.schema) as stream:
            stream.write_table(table)
    packed = pack(foot.getvalue())
    out.write(packed + len(packed).to_bytes(8, "little") + MAGIC)
    return out.getvalue()


class TokenFile:
    """One file, read by ranges: the footer first, then the blocks that are asked for."""

    def __init__(self, source) -> None:
        self.source = source
        size = source.size()
        tail = source.read_at(16, size - 16)
        if tail[8:] != MAGIC or source.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError("not a token file")
        n = int.from_bytes(tail[:8], "little")
        foot = io.BytesIO(zstandard.decompress(source.read_at(n, size - 16 - n)))
        self.documents = pa.ipc.open_stream(foot).read_all()
        self.chunks = pa.ipc.open_stream(foot).read_all()
        block = self.chunks["block"].to_numpy()
        self._starts = np.flatnonzero(np.diff(block, prepend=-1)) if len(block) else np.zeros(0, int)

    @property
    def n_blocks(self) -> int:
        return len(self._starts)

    def block(self, k: int) -> np.ndarray:
        """The ids of block ``k``."""
        last = self._starts[k + 1] if k + 1 < len(self._starts) else len(self.chunks)
        rows = self.chunks.slice(self._starts[k], last - self._starts[k]).to_pydict()
        unpack = zstandard.ZstdDecompressor().decompress
        planes = [unpack(self.source.read_at(n, at)) for at, n in zip(rows["offset"], rows["length"], strict=True)]
        return from_planes(planes, rows["n_ids"][0])

    def each_document(self) -> Iterator[tuple[int | None, Iterator[np.ndarray]]]:
        """Documents in order, each as its id and the pieces of its ids; one block in memory."""
        held, at, k = np.zeros(0, "<u4"), 0, 0

        def pieces(n: int) -> Iterator[np.ndarray]:
            nonlocal held, at, k
            while n:
                if at == len(held):
                    held, at, k = self.block(k), 0, k + 1
                part = held[at : at + n]
                at += len(part)
                n -= len(part)
                yield part

        for doc, n in zip(self.documents["doc_id"].to_pylist(), self.documents["n_ids"].to_pylist(), strict=True):
            yield doc, pieces(n)


# -- tokens ---------------------------------------------------------------------------------------


def _pieces(text: str) -> Iterator[str]:
    """The text in pieces of bounded length, cut at spaces only."""
    at = 0
    while at < len(text):
        end = len(text)
        if end - at > PIECE_CHARS:
            cut = text.find(" ", at + PIECE_CHARS)
            end = cut if cut >= 0 else end
        yield text[at:end]
        at = end


class WordEncoder:
    """Encodes whole texts; word by word where the tokenizer never joins words across white space.

    The ids of a text are then those of its space-separated words one after
    another, so words are given to the library once and remembered.  The
    memory has two generations of at most MEMO_WORDS: when the younger is
    full, it becomes the older, which is forgotten; words in use move back.
    Tokenizers whose normaliser and splitter aren't the known ones get whole
    texts.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        made = json.loads(self.tokenizer.to_str())
        self.by_word = (made["normalizer"], made["pre_tokenizer"], made["model"]["end_of_word_suffix"]) == _BY_WORD
        self.known: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}

    def _tail(self, marks: str) -> bytes:
        if marks not in self.tails:
            if len(self.tails) > MEMO_WORDS // 8:
                self.tails = {}
            self.tails[marks] = array("I", self.tokenizer.encode(marks, add_special_tokens=False).ids).tobytes()
        return self.tails[marks]

    def _learn(self, words: list[str]) -> None:
        """Plain words go to the library's BPE at once, others through its whole chain.

        Marks at the end of a plain word are cut off, as the tokenizer does;
        so the many words that differ by a comma or a capital are encoded once.
        """
        known, older, tokenize, others = self.known, self.older, self.tokenizer.model.tokenize, []
        for w in words:
            got = older.get(w)
            if got is not None:
                known[w] = got
                continue
            stem = w.rstrip(_MARKS) if w[-1] in _MARKS else w
            low = stem.lower()
            if low.isascii() and low.isalpha():
                byte_level = low
            elif _PLAIN(stem):
                byte_level = low.encode().decode("latin-1").translate(_BYTE_LEVEL)
            else:
                others.append(w)
                continue
            got = known.get(low)
            if got is None:
                got = known[low] = array("I", [t.id for t in tokenize(byte_level)]).tobytes()
            known[w] = got if stem is w else got + self._tail(w[len(stem) :])
        for at in range(0, len(others), 4096):
            part = others[at : at + 4096]
            for w, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                known[w] = array("I", e.ids).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text.

        Words are split and told apart by Arrow; Python sees the distinct ones of a group of texts.
        """
        if not self.by_word:
            return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        words = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.string()), "\n", " "), " ")
        coded = words.flatten().dictionary_encode()
        distinct, which = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        learned = self._remember(distinct)
        blobs = list(map(self.known.__getitem__, distinct))
        for w in learned:
            if len(w) > MEMO_CHARS:
                self.known.pop(w, None)
                self.known.pop(w.rstrip(_MARKS).lower(), None)
        # Every word's ids, in order: gathered from those of the distinct words.
        sizes = np.fromiter(map(len, blobs), np.int64, len(blobs)) // 4
        starts = np.cumsum(sizes) - sizes
        own = sizes[which]
        ends = np.cumsum(own)
        ids = np.frombuffer(b"".join(blobs), "<u4")[np.repeat(starts[which] - (ends - own), own) + np.arange(own.sum())]
        cuts = np.concatenate([[0], ends])[words.offsets.to_numpy()].tolist()
        return [ids[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def _remember(self, words: list[str]) -> list[str]:
        """See to it that all ``words`` (distinct) are known; returns those that weren't."""
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > MEMO_WORDS:
            self.known, self.older = {"": b""}, self.known
            new = [w for w in words if w]
        self._learn(new)
        return new


_ENCODERS: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def encode_whole(encoder: WordEncoder, texts: list[str]) -> Iterator[bytes]:
    """Ids of each whole text; short texts go in groups, long ones in pieces."""
    group: list[str] = []
    size = 0
    for text in texts:
        if len(text) > PIECE_CHARS and encoder.by_word:
            yield from encoder.encode(group)
            group, size = [], 0
            yield b"".join(encoder.encode([p])[0] for p in _pieces(text))
            continue
        group.append(text)
        size += len(text)
        if size > PIECE_CHARS:
            yield from encoder.encode(group)
            group, size = [], 0
    yield from encoder.encode(group)


# -- jobs -----------------------------------------------------------------------------------------


def _open(uri: str):
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{os.path.abspath(uri)}")


def _writer(folder: str, tokenizer: str, end_id: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seq = _encoder(tokenizer), TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<u4").tobytes()
        ids: list = []
        parts: list[bytes] = []
        size = 0

        def close() -> pa.RecordBatch:
            nonlocal ids, parts, size, seq
            # Another attempt of this task gets other names; only what the stored manifest lists counts.
            name = f"{folder}/{part:06d}-{seq:05d}-{uuid.uuid4().hex}.planes"
            fs, path = _open(name)
            fs.create_dir(path.rpartition("/")[0], recursive=True)
            data = encode_file(ids, [len(p) // 4 for p in parts], b"".join(parts), kind)
            with fs.open_output_stream(path) as out:
                out.write(data)
            row = {"file": [name], "part": [part], "seq": [seq], "n_docs": [len(ids)], "n_ids": [size], "n_bytes": [len(data)]}
            ids, parts, size, seq = [], [], 0, seq + 1
            return pa.RecordBatch.from_pydict(row, schema=_MANIFEST)

        for batch in (b.slice(at, 2000) for b in batches for at in range(0, b.num_rows, 2000)):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for doc, got in zip(batch.column("doc_id").to_pylist(), encode_whole(encoder, texts), strict=True):
                ids.append(doc)
                parts.append(got + end)
                size += len(parts[-1]) // 4
                if size >= FILE_IDS:
                    yield close()
        if ids:
            yield close()

    return run


_MANIFEST = pa.schema(
    [("file", pa.string())] + [(k, pa.int64()) for k in ("part", "seq", "n_docs", "n_ids", "n_bytes")]
)
_MANIFEST_DDL = "file string, part bigint, seq bigint, n_docs bigint, n_ids bigint, n_bytes bigint"


def write_tokens(
    spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None, kind: str = "byte"
) -> DataFrame:
    """Write the ids of every whole text of ``docs`` (doc_id, text); returns the stored manifest.

    Documents are in ascending id order (nulls first; rows of one id by their text), each followed by
    ``end_id``.  Null and empty texts have the end id only.  The manifest has
    one row a file, with ``start``, the ids in all files before it.  An empty
    table gives no file and an empty manifest.  ``folder`` must be one that
    all executors reach; by default it is in the session's scratch folder.
    """
    folder = folder or f"{scratch_root(spark)}-planes"
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange("doc_id")
    files = stored(
        spark,
        ordered.sortWithinPartitions("doc_id", "text").mapInArrow(_writer(folder, tokenizer, end_id, kind), _MANIFEST_DDL),
    )
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _reader(arrays: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True):
                fs, path = _open(name)
                rows: list[tuple] = []
                with fs.open_input_file(path) as source:
                    for doc, pieces in TokenFile(source).each_document():
                        n, crc, kept = 0, 0, []
                        for p in pieces:
                            n += len(p)
                            crc = zlib.crc32(p.tobytes(), crc)
                            if arrays:
                                kept.append(p)
                        rows.append((doc, start, n, crc, np.concatenate(kept).astype(np.int64) if kept else None))
                        start += n
                        if len(rows) == 2000:
                            yield _documents(rows, arrays)
                            rows = []
                if rows:
                    yield _documents(rows, arrays)

    return run


def _documents(rows: list[tuple], arrays: bool) -> pa.RecordBatch:
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(4)]
    if arrays:
        columns.append(pa.array([r[4] for r in rows], pa.list_(pa.int64())))
        names.append("ids")
    return pa.RecordBatch.from_arrays(columns, names)


def read_tokens(manifest: DataFrame, ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ``ids``) of every document, from the files."""
    ddl = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<bigint>" * ids
    # A given number, as adaptive execution would put so few rows into one task; files are long.
    files = manifest.count()
    spread = manifest.select("file", "start").repartition(max(1, min(files, 64 + files // 16)), "file")
    return spread.mapInArrow(_reader(ids), ddl)
