"""Token ids in Arrow stream files of fixed-size lists (operator 9).

Documents are dealt to tasks by ranges of the key, sorted, encoded, and their ids
written one after another in sequences of equal length: each record batch holds a
fixed-size list of ids and one of mask bits (false where the last sequence of a file is
padded). Batches are not compressed and all but the last are of one size, so that `SequenceReader`, which
maps the file, gets at sequence i with one multiplication and no copy. Beside every file stands an index with the key,
first id and number of ids of each document.

Writing is safe against lost executors: a task writes under a name of its own attempt,
and only names that reach the settled manifest are ever read.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexforge.llm.shared import scratch, settle
from lexforge.llm.words import NON_SPACE, lut, slices, split

LETTER = lut([(0x41, 0x5A), (0x61, 0x7A)])
SIGN = lut([(0x21, 0x7E)]) & ~LETTER

#: Ids of a file after which a task starts the next one; bounds what a reader holds.
FILE_IDS = 16 << 20
#: Sequences of one record batch.
BATCH_ROWS = 512
#: Distinct words whose ids a Python worker remembers before it starts anew.
MEMORY_WORDS = 1_000_000


def cuts_at_pieces(config: dict) -> bool:
    """Whether a tokenizer's configuration shows that no token crosses white space, or runs from an ASCII letter on to an ASCII digit or sign.

    * Its normalisers are NFC, white space to a blank, and lower case. NFC changes a character only together
      with combining marks behind it, and none of those is ASCII or composes with white space; lower case goes character by character.
    * Its first splitter keeps the matches of a pattern each of whose alternatives is a run of letters, one number, a run of
      other signs, or an apostrophe with letters. No such match holds white space, nor a letter and a digit or sign behind it,
      and as they cover all characters but white space, the search stands at each of those places afresh.
    * What follows it maps bytes of a match, and the model sees one match at a time.
    """
    normal, split_ = config.get("normalizer") or {}, config.get("pre_tokenizer") or {}
    normals = normal.get("normalizers", [normal] if normal else [])
    splitters = split_.get("pretokenizers", [split_] if split_ else [])
    plain = [n["type"] in ("NFC", "Lowercase") or n == {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "} for n in normals]
    if not all(plain) or not splitters or splitters[0]["type"] != "Split":
        return False
    pattern = splitters[0]["pattern"].get("Regex", "")
    runs = {r"[\p{L}]+", r"[\p{N}]", r"[^\s\p{L}\p{N}]+"}
    kinds = set(pattern.split("|"))
    keeps = splitters[0]["invert"] and splitters[0]["behavior"] == "Removed" and runs <= kinds and all(re.fullmatch("'[a-z]+", k) for k in kinds - runs)
    bytes_ = all(x["type"] == "ByteLevel" and not x["add_prefix_space"] and not x["use_regex"] for x in splitters[1:])
    return bool(keeps and bytes_ and not config.get("post_processor") and not config["model"].get("dropout"))


class WordEncoder:
    """Encodes whole texts with the library, each distinct piece of them once.

    Pieces end at ASCII white space and between an ASCII letter and an ASCII digit or
    sign. Where the tokenizer's own configuration says that none of its steps looks across such a
    place (`cuts_at_pieces`), the ids of a text are those of its pieces one after another. Texts that hold the string of an
    added token, and all texts with other tokenizers, are handed to the library in one piece.
    """

    CUT = (LETTER, SIGN)

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.width = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.by_piece = cuts_at_pieces(json.loads(self.tokenizer.to_str()))
        self._forget()

    def _plain(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.first, self.flat = np.zeros(1, np.int64), np.zeros(0, self.width)

    def _numbers(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > MEMORY_WORDS:
            self._forget()
        if new := [w for w in words if w not in self.known]:
            ids = self._plain([w.decode() for w in new])
            ends = self.first[-1] + np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))
            self.known |= zip(new, range(len(self.known), len(self.known) + len(new)), strict=True)
            self.first = np.concatenate([self.first, ends])
            self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(ids), self.width)])
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def _by_piece(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        w = split(texts, NON_SPACE, fold=False, cut=self.CUT)
        entry = self._numbers(w.vocabulary.to_pylist())
        size = (self.first[entry + 1] - self.first[entry])[w.ids]
        total = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(self.first[entry][w.ids] - total[:-1], size) + np.arange(total[-1])
        return self.flat[at], np.diff(total[w.first])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows one after another, ids of each row); null counts as empty."""
        whole = np.full(len(texts), not self.by_piece)
        for token in self.added:
            whole |= pa.compute.match_substring(texts, token, ignore_case=True).fill_null(False).to_numpy(zero_copy_only=False)
        if not whole.any():
            return self._by_piece(texts)
        ids = dict(zip(np.flatnonzero(whole).tolist(), self._plain([t or "" for t in texts.filter(pa.array(whole)).to_pylist()]), strict=True))
        flat, counts = self._by_piece(texts.filter(pa.array(~whole)))
        ends, place = np.cumsum(counts), np.cumsum(~whole) - 1
        rows = [ids[i] if i in ids else flat[ends[place[i]] - counts[place[i]] : ends[place[i]]] for i in range(len(texts))]
        return np.concatenate([np.array(x, self.width) for x in rows]), np.array([len(x) for x in rows], np.int64)


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


class SequenceFile:
    """One file and its index, written as ids come."""

    def __init__(self, base: str, width: np.dtype, length: int, key: pa.DataType) -> None:
        self.base, self.length, self.width = base, length, width
        self.store, path = fs.FileSystem.from_uri(base)
        self.store.create_dir(path.rpartition("/")[0], recursive=True)
        kind = pa.from_numpy_dtype(width)
        self.schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.index_schema = pa.schema([("key", key), ("first", pa.int64()), ("n_ids", pa.int64())])
        self.sinks = [self.store.open_output_stream(path + ".arrows"), self.store.open_output_stream(path + ".index.arrows")]
        self.ids = pa.ipc.new_stream(self.sinks[0], self.schema)
        self.index = pa.ipc.new_stream(self.sinks[1], self.index_schema)
        self.rest, self.n_ids = np.zeros(0, width), 0

    def _sequences(self, flat: np.ndarray, mask: np.ndarray) -> None:
        for at in range(0, len(flat), BATCH_ROWS * self.length):
            part = slice(at, at + BATCH_ROWS * self.length)
            self.ids.write_batch(pa.RecordBatch.from_arrays(
                [pa.FixedSizeListArray.from_arrays(pa.array(x[part]), self.length) for x in (flat, mask)], schema=self.schema,
            ))

    def add(self, keys: pa.Array, flat: np.ndarray, counts: np.ndarray) -> None:
        first = self.n_ids + np.cumsum(counts) - counts
        self.index.write_batch(pa.RecordBatch.from_arrays([keys.cast(self.index_schema.field(0).type), pa.array(first), pa.array(counts)], schema=self.index_schema))
        self.n_ids += len(flat)
        flat = np.concatenate([self.rest, flat])
        whole = len(flat) // (BATCH_ROWS * self.length) * (BATCH_ROWS * self.length)
        self._sequences(flat[:whole], np.ones(whole, bool))
        self.rest = flat[whole:]

    def close(self) -> None:
        pad = -len(self.rest) % self.length
        self._sequences(np.concatenate([self.rest, np.zeros(pad, self.width)]), np.arange(len(self.rest) + pad) < len(self.rest))
        for x in (self.ids, self.index, *self.sinks):
            x.close()


def _write(batches: Iterator[pa.RecordBatch], out: str, tokenizer: str, eos: int, length: int, file_ids: int) -> Iterator[pa.RecordBatch]:
    enc, task, file, done = encoder(tokenizer), TaskContext.get(), None, []

    def finish(file: SequenceFile) -> None:
        file.close()
        done.append((task.partitionId(), len(done), file.base, file.n_ids))

    for part in slices(batches, "text"):
        flat, counts = enc.encode(part.column("text"))
        ends = np.cumsum(counts)
        flat = np.insert(flat, ends, eos)
        if file is None:
            file = SequenceFile(f"{out}/part-{task.partitionId():06d}-{len(done):04d}-{uuid.uuid4().hex}", enc.width, length, part.schema.field("key").type)
        file.add(part.column("key"), flat, counts + 1)
        if file.n_ids >= file_ids:
            finish(file)
            file = None
    if file is not None:
        finish(file)
    yield pa.RecordBatch.from_arrays([
        pa.array([d[k] for d in done], kind) for k, kind in enumerate((pa.int32(), pa.int32(), pa.string(), pa.int64()))
    ], names=["part", "number", "base", "n_ids"])


def write_tokens(docs: DataFrame, out: str, tokenizer: str, eos: int = 2, length: int = 2048, key: str = "doc_id", text: str = "text", file_ids: int = FILE_IDS) -> DataFrame:
    """Write the ids of all documents in ascending order of `key`; returns the manifest.

    Manifest: part, number, base (path without its ending), n_ids. Rows of one key are
    ordered by their text's hash; null keys come first. Each document's ids end with
    `eos`, so a null or empty text has that id alone.
    """
    spread = F.xxhash64(F.col("text"))
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    rows = rows.repartitionByRange("key", spread).sortWithinPartitions("key", spread)
    return settle(rows.mapInArrow(
        partial(_write, out=out, tokenizer=tokenizer, eos=eos, length=length, file_ids=file_ids), "part int, number int, base string, n_ids long",
    ), "token-manifest")


def open_stream(path: str) -> pa.ipc.RecordBatchStreamReader:
    """Maps a local file, and streams any other."""
    store, where = fs.FileSystem.from_uri(path)
    return pa.ipc.open_stream(pa.memory_map(where) if isinstance(store, fs.LocalFileSystem) else store.open_input_stream(where))


class SequenceReader:
    """Random access to the sequences of a file. A local file is mapped, and ids and masks are views of the mapping."""

    def __init__(self, base: str) -> None:
        store, path = fs.FileSystem.from_uri(base + ".arrows")
        self.file = pa.memory_map(path) if isinstance(store, fs.LocalFileSystem) else store.open_input_file(path)
        self.schema = pa.ipc.read_schema(pa.ipc.read_message(self.file))
        self.head, self.length = self.file.tell(), self.schema.field("ids").type.list_size
        end = self.file.size() - 8  # the mark of the stream's end
        self.rows = self.step = self.count = 0
        if self.head < end:
            self.rows = self._batch(self.head).num_rows
            self.step = self.file.tell() - self.head
            whole = -(-(end - self.head) // self.step) - 1  # batches before the last
            self.count = whole * self.rows + self._batch(self.head + whole * self.step).num_rows

    def _batch(self, at: int) -> pa.RecordBatch:
        self.file.seek(at)
        return pa.ipc.read_record_batch(pa.ipc.read_message(self.file), self.schema)

    def __len__(self) -> int:
        return self.count

    def sequence(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """(ids, mask) of sequence i."""
        if not 0 <= i < self.count:
            raise IndexError(i)
        batch, row = self._batch(self.head + i // self.rows * self.step), i % self.rows
        ids, mask = (batch.column(c).values.slice(row * self.length, self.length) for c in ("ids", "mask"))
        return ids.to_numpy(), mask


def real_ids(base: str) -> np.ndarray:
    """All ids of a file under its mask, in order."""
    out = []
    for b in open_stream(base + ".arrows"):
        ids, mask = (b.column(c).flatten() for c in ("ids", "mask"))
        out.append(ids.to_numpy() if mask.true_count == len(mask) else ids.filter(mask).to_numpy())
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for base, start in zip(batch.column("base").to_pylist(), batch.column("start").to_pylist(), strict=True):
            flat = real_ids(base).astype("<u4")
            for b in open_stream(base + ".index.arrows"):
                first, n = (b.column(c).to_numpy() for c in ("first", "n_ids"))
                crc = [zlib.crc32(flat[i : i + k]) for i, k in zip(first.tolist(), n.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(first + start), b.column("n_ids"), pa.array(crc, pa.int64())], names=["key", "start", "n_tokens", "ids_crc32"])


def read_tokens(manifest: DataFrame, key_type: T.DataType, key: str = "doc_id") -> DataFrame:
    """Per document, from the files: key, start, n_tokens, ids_crc32.

    `start` counts the ids of all documents before it. The driver adds up one number a
    file (tens of millions of ids each).
    """
    files, start = [], 0
    for r in manifest.orderBy("part", "number").toLocalIterator():
        files.append((r.base, start))
        start += r.n_ids
    spark = manifest.sparkSession
    listed = spark.createDataFrame(files, "base string, start long").repartition(max(1, len(files)))
    schema = T.StructType([T.StructField("key", key_type), *(T.StructField(c, T.LongType()) for c in ("start", "n_tokens", "ids_crc32"))])
    return listed.mapInArrow(_read, schema).withColumnRenamed("key", key)


def tokens_roundtrip(docs: DataFrame, tokenizer: str, eos: int = 2, length: int = 2048, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write all documents to token files in the shared folder and read them back.

    Null texts count as empty and have the end id alone; repeated rows are written as often as they come, rows
    of one key in the order of their texts' hashes, with null keys first; a text of any length is encoded whole and lies in one
    file; an empty table gives an empty result; other columns are not read.
    """
    manifest = write_tokens(docs, scratch(docs.sparkSession, "tokens"), tokenizer, eos, length, key, text)
    return read_tokens(manifest, docs.schema[key].dataType, key)
