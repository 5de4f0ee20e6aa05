"""Flat token-id files (operator 7).

Documents are range-partitioned by id; each task writes a flat file of little-endian unsigned ids
(16-bit where the vocabulary fits, else 32-bit), one of 64-bit offsets and one of document ids, as
the documents come, under names of its own attempt. The manifest row that a task returns names the
files of the attempt that counts, so a lost executor only leaves unread files behind. The manifest
(one row a partition) is written; a running sum over it gives each partition's base. Reading maps
the files into memory, or reads them by ranges where the store is no file system.
"""

from __future__ import annotations

import functools
import json
import os
import re
import unicodedata
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import pieces, shared

#: Words kept with their ids in a worker's memory, from task to task; the cache is emptied beyond that.
CACHE_WORDS = 400_000

MANIFEST = "part int, dtype string, path string, n_docs long, n_ids long"
#: Documents that are read back together; their ids are read in ranges of about so many.
READ_DOCS, READ_IDS = 10_000, 1 << 22
ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"


#: What a tokenizer's file must say for WordIds to hold: lower case, white space and all other
#: separators dropped, letters in runs, bytes written as characters.
SEPARABLE = {
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
    "split": ("'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+", "Removed", True),
}
#: Texts that are cut here: visible ASCII and the letters of Latin-1, all in NFC and of one lower case each, with
#: white space; and the parts of their words in lower case, as SEPARABLE's split gives them.
PLAIN = re.compile("[\t\n\r !-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*")
PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^\t\n\r a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")
#: Bytes that byte-level tokenizers write as characters from 256 on; all others stay as they are.
SHIFTED = {b: 256 + i for i, b in enumerate([*range(33), *range(127, 161), 173])}
WRITTEN = [chr(SHIFTED.get(b, b)) for b in range(256)]


def separable(tokenizer_json: str) -> bool:
    """Whether a text's ids are those of its parts between spaces and line ends, in order."""
    spec = json.loads(tokenizer_json)
    try:
        kinds = spec["normalizer"]["normalizers"]
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        how = (split["pattern"]["Regex"], split["behavior"], split["invert"])
        plain = level["type"] == "ByteLevel" and not level["add_prefix_space"] and not level["use_regex"]
        if any(t["content"].isalpha() or re.search(r"\s", t["content"]) for t in spec["added_tokens"]):
            return False  # these may begin or end inside runs of letters, or go over spaces
        return kinds == SEPARABLE["normalizers"] and how == SEPARABLE["split"] and plain and spec["post_processor"] is None and spec["model"]["type"] == "BPE"
    except (KeyError, TypeError, ValueError):
        return False


def stays_letters(word: str) -> bool:
    """Whether a word is letters only, also in NFC and lower case: a mark at its end would join the punctuation after it.

    Said only of scripts below U+0530, whose letters every library's Unicode tables agree on.
    """
    return word.isalpha() and max(word) < "\u0530" and unicodedata.normalize("NFC", word).lower().isalpha()


class WordIds(dict):
    """Word -> its ids as bytes, for a tokenizer that is separable()."""

    def __init__(self, tokenizer, dtype: str):
        super().__init__()
        self.tokenizer, self.pieces, self.dtype = tokenizer, tokenizer.model.tokenize, dtype
        packed = np.arange(1 << 16 if dtype == "<u2" else tokenizer.get_vocab_size(with_added_tokens=True), dtype=dtype).tobytes()
        self.code = [packed[i : i + int(dtype[-1])] for i in range(0, len(packed), int(dtype[-1]))]
        # Tokens that the library finds before it cuts words.
        self.added = re.compile("|".join(re.escape(t.content.lower()) for t in tokenizer.get_added_tokens_decoder().values()) or "(?!)")

    def packed(self, ids: list[int]) -> bytes:
        return np.asarray(ids, self.dtype).tobytes()

    def lower(self, text: str) -> str | None:
        """A plain text in lower case; None for others, and for those that hold added tokens."""
        if PLAIN.fullmatch(text) and not self.added.search(low := text.lower()):
            return low
        return None

    def part(self, low: str) -> bytes:
        """The ids of one part in lower case."""
        written = low if low.isascii() else "".join(map(WRITTEN.__getitem__, low.encode()))
        return b"".join([self.code[t.id] for t in self.pieces(written)])

    def __missing__(self, word: str) -> bytes:
        if word.isascii() and word.isalpha() and word.islower():
            ids = self.part(word)
        elif (low := self.lower(word)) is not None:
            parts = PARTS.findall(low)
            ids = self.part(low) if parts == [low] else b"".join(map(self.__getitem__, parts))
        elif len(word) > 1 and word[-1] in ".,;:!?" and stays_letters(word[:-1]):
            ids = self[word[:-1]] + self[word[-1]]
        else:
            ids = self.packed(self.tokenizer.encode(word, add_special_tokens=False).ids)
        self[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        out = []
        for piece in pieces.cut(text):
            if len(self) > CACHE_WORDS:
                self.clear()
            low = self.lower(piece)  # so that words of both cases are one
            out.append(b"".join(map(self.__getitem__, (piece if low is None else low).replace("\n", " ").split(" "))))
        return b"".join(out)


@functools.lru_cache(maxsize=1)
def _encoder(tokenizer_json: str, end_id: int) -> tuple:
    """Tokenizer, type of its ids, and WordIds where they hold; one of each in a worker, for all its tasks."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(tokenizer_json)
    dtype = "<u2" if max(end_id + 1, tokenizer.get_vocab_size(with_added_tokens=True)) <= 1 << 16 else "<u4"
    return tokenizer, dtype, WordIds(tokenizer, dtype), separable(tokenizer.to_str())


def _open(path: str):
    return pafs.FileSystem.from_uri(path)


def write(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 2, partitions: int | None = None) -> DataFrame:
    """Writes the ids of every whole text, each document's ids followed by end_id, and returns the manifest.

    docs: doc_id, text (other columns are ignored). A null text counts as empty: its document is
    end_id alone. Null ids come first; equal ids follow each other in the order of their texts; no
    row is merged with another. An empty table gives an empty manifest. Memory: one Arrow batch of
    texts and their ids at a time; a text is never split or cut.
    """
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
        .repartitionByRange(n, F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "text")
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        with open(tokenizer_path, encoding="utf-8") as file:
            tokenizer, dtype, words, by_word = _encoder(file.read(), end_id)
        end, width = np.asarray([end_id], dtype).tobytes(), int(dtype[-1])
        name = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}"
        store, path = _open(name)
        out, n, at = None, 0, 0
        for batch in batches:
            if out is None:
                store.create_dir(os.path.dirname(path), recursive=True)
                out = {end: store.open_output_stream(f"{path}.{end}") for end in ("ids", "offsets", "docs")}
                out["offsets"].write(np.zeros(1, "<i8").tobytes())
            ends = []
            for text in batch.column(1):
                text = text.as_py()
                ids = (words.encode(text) if by_word else words.packed(tokenizer.encode(text, add_special_tokens=False).ids)) + end
                out["ids"].write(ids)
                at += len(ids) // width
                ends.append(at)
            n += len(ends)
            out["offsets"].write(np.asarray(ends, "<i8").tobytes())
            column = batch.column(0)  # each document's id, and whether it has one
            pairs = np.stack([column.fill_null(0).to_numpy(zero_copy_only=False), np.asarray(column.is_valid())], axis=1)
            out["docs"].write(pairs.astype("<i8").tobytes())
        if out is None:
            return
        for stream in out.values():
            stream.close()
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "dtype": [dtype], "path": [name], "n_docs": pa.array([n], pa.int64()), "n_ids": pa.array([at], pa.int64())})

    manifest = shared.written(ordered.mapInArrow(encode, MANIFEST), "manifest")
    # One row a partition, so a single ordered window is bounded by the number of files.
    return manifest.withColumn("base", F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))).fillna(0, ["base"])


class Flat:
    """A file as an array: mapped into memory where the store is a file system, else read by ranges."""

    def __init__(self, path: str, dtype: str):
        store, inner = _open(path)
        self.dtype, self.source, self.whole = np.dtype(dtype), None, None
        if not isinstance(store, pafs.LocalFileSystem):
            self.source = store.open_input_file(inner)
        else:
            self.whole = np.memmap(inner, dtype, "r") if os.path.getsize(inner) else np.zeros(0, dtype)

    def range(self, start: int, stop: int) -> np.ndarray:
        if self.whole is not None:
            return self.whole[start:stop]
        size = self.dtype.itemsize
        return np.frombuffer(self.source.read_at((stop - start) * size, start * size), self.dtype)


def read(manifest: DataFrame) -> DataFrame:
    """Reads the files of a manifest: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""

    def crc(ids: Flat, start: int, stop: int) -> int:
        out = 0
        for at in range(start, stop, READ_IDS):
            out = zlib.crc32(ids.range(at, min(at + READ_IDS, stop)).astype("<u4"), out)
        return out

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.to_pylist():
                ids, offsets, docs = Flat(file["path"] + ".ids", file["dtype"]), Flat(file["path"] + ".offsets", "<i8"), Flat(file["path"] + ".docs", "<i8")
                for first in range(0, file["n_docs"], READ_DOCS):
                    last = min(first + READ_DOCS, file["n_docs"])
                    own, pairs = np.array(offsets.range(first, last + 1)), np.array(docs.range(2 * first, 2 * last)).reshape(-1, 2)
                    sums = [crc(ids, a, b) for a, b in zip(own[:-1].tolist(), own[1:].tolist(), strict=True)]
                    yield pa.RecordBatch.from_pydict(
                        {"doc_id": pa.array(pairs[:, 0].copy(), pa.int64(), mask=pairs[:, 1] == 0), "start": pa.array(own[:-1] + file["base"], pa.int64()), "n_tokens": pa.array(np.diff(own), pa.int64()), "ids_crc32": pa.array(sums, pa.int64())}
                    )

    spark = manifest.sparkSession
    files = manifest.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "part")
    return files.mapInArrow(rows, ROWS)


def op7_token_files(spark, sf_dir: str) -> DataFrame:
    """Token-id files of all documents, written and read back.

    A null or empty text is the end id alone; null ids come first, repeated rows and ids follow each
    other and each have their row. An empty table gives no rows. Very long texts are encoded whole;
    other columns are ignored. There are as many files as shuffle partitions.
    """
    import public_tokenizers

    docs = shared.table(spark, sf_dir, "documents")
    folder = shared.new_path(spark, "token-files")
    return read(write(docs, folder, public_tokenizers.path("word_bpe_49k.json")))
