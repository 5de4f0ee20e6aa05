"""Cross-tokenizer alignment (operator 12).

Two tokenizers' tokens cover the same bytes; byte offsets where both end a token cut them into groups.
A long text is cut into byte ranges, and each range gives a fragment: an open prefix (the tokens up to
its first common end), closed groups, an open suffix (the tokens after its last one). Fragments
compose associatively, so a tree of joins over neighbours puts very long documents together, whatever
task each range was in. What a common end links is known in its own range; only groups cross ranges.

How often a pair of ids is linked over all documents is counted by blocks: a block holds about a
million links of consecutive documents as indices into its own table of distinct pairs, so what is
counted and looked up is one row a block and pair, not one a link.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from . import shared
from .token_files import SHIFTED

#: Bytes of a range, about; a stretch without a place to cut makes its range longer.
CHUNK = 1 << 16
#: Links of a block, about.
BLOCK = 1 << 19
#: Neighbouring fragments that one join of the tree composes.
FAN = 8
#: Both tokenizers end a token before a single space between words, and merge nothing over it.
_CUT = re.compile(r"(?<=[\w.,;:!?]) (?=\w)")
#: How a byte-level tokenizer that is set to do so parts a text before it merges. Fixed value.
PARTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts that the faster of two equal encoders does not take: letters that Unicode versions may differ on, and very long words.
_RARE = re.compile("[\u0530-\U0010ffff]|\\S{1000}")

_EDGES = "head_a array<int>, head_b array<int>, tail_a array<int>, tail_b array<int>, cut boolean, body string"
_SUMS = ("n_a", "n_b", "n_groups", "n_links")
FRAGMENT = f"block long, key string, idx int, doc_id long, ok boolean, {', '.join(f'{c} long' for c in _SUMS)}, sha string, {_EDGES}, links binary, width int, pairs array<int>, counts array<int>"


def ranges(text: str, size: int = 0) -> Iterator[str]:
    """The pieces of a text, without the space before each but the first."""
    size, at = size or CHUNK, 0
    while len(text) - at > size:
        found = _CUT.search(text, at + size)
        if not found:
            break
        yield text[at : found.start()]
        at = found.end()
    yield text[at:]


def merged_by_rank(tokenizer_json: str) -> bool:
    """Whether a tokenizer's ids are those of a merge by rank of PARTS: its ids number the bytes, then the merges in order."""
    spec = json.loads(tokenizer_json)
    model, level = spec["model"], spec["pre_tokenizer"] or {}
    plain = spec["normalizer"] is None and spec["post_processor"] is None and level.get("type") == "ByteLevel" and level.get("use_regex") and not level.get("add_prefix_space")
    if not plain or model["type"] != "BPE" or model["dropout"] or model["unk_token"] or model.get("ignore_merges"):
        return False
    made = ("".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"])
    return all(model["vocab"].get(token) == 256 + i for i, token in enumerate(made))


class Vocabulary:
    """The two tokenizers, the bytes of their tokens, and the text of an id in a list of groups."""

    def __init__(self, byte_path: str, piece_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; more threads only contend for it
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.bytes_of_a, self.pieces = Tokenizer.from_file(byte_path), SentencePieceProcessor(model_file=piece_path)
        self.bytes_of_a.encode_special_tokens = True  # their strings in a text are plain text
        shown = {chr(SHIFTED.get(b, b)): b for b in range(256)}
        size = self.bytes_of_a.get_vocab_size(with_added_tokens=True)
        entries = [self.bytes_of_a.id_to_token(i) or "" for i in range(size)]
        self.a = [bytes(shown[c] for c in e) if all(c in shown for c in e) else e.encode() for e in entries]
        names = [self.pieces.id_to_piece(i) for i in range(self.pieces.get_piece_size())]
        self.b = [bytes([int(n[3:-1], 16)]) if self.pieces.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]
        self.fast = self._fast() if merged_by_rank(self.bytes_of_a.to_str()) else None
        self.len_a, self.len_b = (np.array([len(x) for x in t], np.int64) for t in (self.a, self.b))
        self.words = [f"{i}{end}" for n, ends in ((len(self.a), ",|"), (len(self.b), ",;")) for end in ends for i in range(n)]

    def _fast(self):
        """The same encoding by ranks, several times faster."""
        from tiktoken import Encoding

        special = self.bytes_of_a.get_added_tokens_decoder()
        return Encoding("ranks", pat_str=PARTS, mergeable_ranks={b: i for i, b in enumerate(self.a) if i not in special}, special_tokens={})

    def ids_of_a(self, texts: list[str]) -> Iterator[list[int]]:
        rare = [i for i, t in enumerate(texts) if self.fast is None or _RARE.search(t)]
        slow = dict(zip(rare, self.bytes_of_a.encode_batch([" " + texts[i] for i in rare], add_special_tokens=False), strict=True))
        for i, text in enumerate(texts):
            yield slow[i].ids if i in slow else self.fast.encode_ordinary(" " + text)

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        """The ids of each text by either, and whether both give the bytes of a space and the text."""
        for text, a, b in zip(texts, self.ids_of_a(texts), self.pieces.encode(texts, num_threads=1), strict=True):
            whole = b" " + text.encode()
            ok = b"".join(map(self.a.__getitem__, a)) == whole and b"".join(map(self.b.__getitem__, b)) == whole
            yield np.array(a, np.int64), np.array(b, np.int64), ok

    def ends(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places, in a and in b, of the tokens that end together. No token is without bytes."""
        at_a, at_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        top = int(max(at_a[-1] if len(a) else 0, at_b[-1] if len(b) else 0)) + 1
        in_a, in_b = np.zeros(top, bool), np.zeros(top, bool)
        in_a[at_a], in_b[at_b] = True, True
        return np.flatnonzero(in_b[at_a]), np.flatnonzero(in_a[at_b])

    def groups(self, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> str:
        """Groups as text, a1,a2|b1;a3|b2: of all tokens, the last of which end together."""
        if not len(cut_a):
            return ""
        of_a, of_b = np.searchsorted(cut_a, np.arange(len(a))), np.searchsorted(cut_b, np.arange(len(b)))
        before = np.concatenate([[0], cut_b[:-1] + 1])
        line = np.empty(len(a) + len(b), np.int64)
        code_a, code_b = a.copy(), b + 2 * len(self.a)
        code_a[cut_a] += len(self.a)
        code_b[cut_b] += len(self.b)
        line[np.arange(len(a)) + before[of_a]] = code_a
        line[np.arange(len(b)) + cut_a[of_b] + 1] = code_b
        return "".join(map(self.words.__getitem__, line.tolist()))[:-1]


@dataclass
class Fragment:
    """What a byte range knows: cut says whether it has a common end; without one, all its tokens are head."""

    head_a: list[int] = field(default_factory=list)
    head_b: list[int] = field(default_factory=list)
    cut: bool = False
    body: str = ""
    tail_a: list[int] = field(default_factory=list)
    tail_b: list[int] = field(default_factory=list)

    def __add__(self, right: Fragment) -> Fragment:
        """The fragment of both ranges. Associative; Fragment() is neutral."""
        if not self.cut:
            return Fragment(self.head_a + right.head_a, self.head_b + right.head_b, right.cut, right.body, right.tail_a, right.tail_b)
        if not right.cut:
            return Fragment(self.head_a, self.head_b, True, self.body, self.tail_a + right.head_a, self.tail_b + right.head_b)
        middle = group_text(self.tail_a + right.head_a, self.tail_b + right.head_b)
        return Fragment(self.head_a, self.head_b, True, ";".join(x for x in (self.body, middle, right.body) if x), right.tail_a, right.tail_b)

    def closed(self) -> str:
        """All groups of a whole document, whose last tokens end together."""
        return ";".join(x for x in (group_text(self.head_a, self.head_b), self.body) if x) if self.cut else ""


def group_text(a: list[int], b: list[int]) -> str:
    return f"{','.join(map(str, a))}|{','.join(map(str, b))}"


def fragment(words: Vocabulary, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> Fragment:
    """The fragment of the tokens that end in a byte range, given the places of its common ends."""
    if not len(cut_a):
        return Fragment(a.tolist(), b.tolist())
    x, y, z, w = cut_a[0] + 1, cut_b[0] + 1, cut_a[-1] + 1, cut_b[-1] + 1
    body = words.groups(a[x:z], b[y:w], cut_a[1:] - x, cut_b[1:] - y)
    return Fragment(a[:x].tolist(), b[:y].tolist(), True, body, a[z:].tolist(), b[w:].tolist())


def _encoded(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """Fragments (key, idx, doc_id, text -> FRAGMENT) and, for each block, its distinct pairs and their counts."""
    schema = to_arrow_schema(StructType.fromDDL(FRAGMENT))

    def block(rows: list[dict], links: list[np.ndarray], key: str | None) -> Iterator[pa.RecordBatch]:
        """The rows of a block with their links as indices, then the block's pairs."""
        own, every = uuid.uuid4().int >> 65, np.concatenate(links)
        pairs, place, counts = np.unique(every, return_inverse=True, return_counts=True)
        width, at = (2 if len(pairs) <= 1 << 16 else 4), 0
        for row, mine in zip(rows, links, strict=True):
            row |= {"block": own, "links": place[at : at + len(mine)].astype(f"<u{width}").tobytes(), "width": width}
            at += len(mine)
        table = {"block": own, "key": key, "ok": True, "pairs": pairs.astype(np.int32), "counts": counts.astype(np.int32)}
        yield pa.RecordBatch.from_pylist([{c: r.get(c) for c in schema.names} for r in [*rows, table]], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, rows, links, held = Vocabulary(byte_path, piece_path), [], [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64).to_pylist()
                for doc, (a, b, ok) in zip(part, words.encode([d["text"] or "" for d in part]), strict=True):
                    row, mine = {"key": doc["key"], "idx": doc["idx"], "doc_id": doc["doc_id"], "ok": ok}, np.zeros(0, np.int64)
                    if doc["text"] and ok:
                        cut_a, cut_b = words.ends(a, b)
                        mine = b[cut_b] << 16 | a[cut_a]
                        row |= {"n_a": len(a), "n_b": len(b), "n_groups": len(cut_a), "n_links": len(mine)}
                        if doc["key"] is None:
                            row["sha"] = hashlib.sha256(words.groups(a, b, cut_a, cut_b).encode()).hexdigest()
                        else:
                            row |= vars(fragment(words, a, b, cut_a, cut_b))
                    else:
                        row |= {c: 0 for c in _SUMS} | {"sha": ""}
                    if doc["key"] is not None:  # alone, since another range may show that its document has no tokens
                        yield from block([row], [mine], doc["key"])
                        continue
                    rows.append(row)
                    links.append(mine)
                    held += len(mine)
                    if held >= BLOCK or len(rows) >= 20_000:
                        yield from block(rows, links, None)
                        rows, links, held = [], [], 0
        if rows:
            yield from block(rows, links, None)

    return docs.mapInArrow(run, FRAGMENT)


_OUT = f"key string, idx int, doc_id long, ok boolean, {', '.join(f'{c} long' for c in (*_SUMS, 'n_best', 'count_sum'))}, sha string, {_EDGES}"


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a block: first its pairs in order, with their counts, then its fragments, which look theirs up."""
    names = [f.split()[0] for f in _OUT.split(", ")]
    block, counts, best, table = None, [], [], None
    for batch in batches:
        blocks, kinds = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("block", "kind"))
        edges = [0, *(np.flatnonzero((blocks[1:] != blocks[:-1]) | (kinds[1:] != kinds[:-1])) + 1).tolist(), len(blocks)]
        for x, y in zip(edges[:-1], edges[1:], strict=True):
            if x == y:
                continue
            if blocks[x] != block:
                block, counts, best, table = blocks[x], [], [], None
            rows = batch.slice(x, y - x)
            if kinds[x] == 0:
                counts.append(rows.column("count").to_numpy(zero_copy_only=False))
                best.append(rows.column("best").to_numpy(zero_copy_only=False))
                continue
            if table is None:
                none = np.zeros(0, np.int64)
                table = np.concatenate(counts or [none]), np.concatenate(best or [none.astype(bool)])
            sums, bests = [], []
            for links, width in zip(rows.column("links"), rows.column("width").to_pylist(), strict=True):
                place = np.frombuffer(links.as_py(), f"<u{width}")
                known = len(table[0]) > 0  # a document without tokens has no pairs in its block
                sums.append(int(table[0][place].sum()) if known else 0)
                bests.append(int(np.count_nonzero(table[1][place])) if known else 0)
            rows = rows.append_column("n_best", pa.array(bests, pa.int64())).append_column("count_sum", pa.array(sums, pa.int64()))
            yield rows.select(names)


def _composed(group: pd.DataFrame) -> pd.DataFrame:
    """Neighbouring fragments of a document as one."""
    group, whole = group.sort_values("idx"), Fragment()
    for r in group.itertuples(index=False):
        if r.cut is not None or r.head_a is not None:
            whole = whole + Fragment(list(r.head_a), list(r.head_b), bool(r.cut), r.body or "", list(r.tail_a), list(r.tail_b))
    first = group.iloc[0]
    out = {"key": first.key, "idx": int(first.idx) // FAN, "doc_id": first.doc_id, "ok": bool(group.ok.all())}
    out |= {c: int(group[c].sum()) for c in (*_SUMS, "n_best", "count_sum")} | {"sha": None} | vars(whole)
    return pd.DataFrame([out])


def align(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """For each row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A null or empty text, and one whose tokens' bytes are not a space and the text, has no tokens:
    zeros and an empty digest; its links count nowhere. Null and repeated ids and repeated rows each
    have their row; an empty table gives none. Other columns are ignored. The groups of one document,
    as text, must fit a row (2 GB, about 500 MB of text).
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    long = F.coalesce(F.octet_length("text") > CHUNK, F.lit(False))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                key = uuid.uuid4().hex
                for idx, piece in enumerate(ranges(text.as_py())):
                    yield pa.RecordBatch.from_pydict({"key": [key], "idx": pa.array([idx], pa.int32()), "doc_id": pa.array([doc], pa.int64()), "text": [piece]})

    # Ranges of long texts are dealt over all tasks; short texts are encoded where they lie.
    pieces = shared.written(rows.where(long).mapInArrow(cut, "key string, idx int, doc_id long, text string"), "ranges")
    short = rows.where(~long).select(F.lit(None).cast("string").alias("key"), F.lit(0).alias("idx"), "doc_id", "text")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = shared.written(_encoded(short.unionByName(pieces.repartition(n)), byte_path, piece_path), "fragments")

    # A range whose bytes differ takes the links of its whole document out of the counts.
    lost = shared.written(parts.where("key IS NOT NULL AND NOT ok").select("key").distinct(), "lost")
    tables = parts.where("pairs IS NOT NULL").select("block", "key", "pairs", "counts")
    kept = tables.where("key IS NULL").unionByName(tables.where("key IS NOT NULL").join(lost, "key", "left_anti").select(*tables.columns))
    pairs = kept.select("block", F.explode(F.arrays_zip("pairs", "counts")).alias("x")).select("block", F.col("x.pairs").alias("pair"), F.col("x.counts").alias("n"))
    counts = shared.written(pairs.groupBy("pair").agg(F.sum("n").alias("count")), "counts")
    most = counts.groupBy(F.shiftright("pair", 16).alias("b")).agg(F.max("count").alias("most"))
    ranked = counts.withColumn("b", F.shiftright("pair", 16)).join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    answers = pairs.select("block", "pair").join(ranked, "pair").withColumn("kind", F.lit(0))
    asking = parts.where("pairs IS NULL").drop("pairs", "counts").withColumn("kind", F.lit(1))
    both = asking.unionByName(answers, allowMissingColumns=True).repartition(n, "block").sortWithinPartitions("block", "kind", "pair")
    found = shared.written(both.mapInArrow(_resolve, _OUT), "aligned")

    # The tree: a round composes up to FAN neighbours of each document that has several ranges.
    tree = found.where("key IS NOT NULL")
    size = 1 + (tree.agg(F.max("idx")).first()[0] or 0)
    while True:
        tree = shared.written(tree.groupBy("key", F.floor(F.col("idx") / FAN)).applyInPandas(_composed, _OUT), "tree")
        if size <= 1 or (size := -(-size // FAN)) == 1:
            break
    closed = tree.mapInArrow(_closed, _OUT)
    every = found.where("key IS NULL").unionByName(closed)
    return every.select("doc_id", *_SUMS[:3], "n_links", "n_best", "count_sum", F.col("sha").alias("groups_sha256"))


def _closed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of one fragment, closed; those that are not whole have no tokens."""
    for batch in batches:
        rows = batch.to_pylist()
        for r in rows:
            whole = Fragment(r["head_a"] or [], r["head_b"] or [], bool(r["cut"]), r["body"] or "")
            r["sha"] = hashlib.sha256(whole.closed().encode()).hexdigest() if r["ok"] else ""
            r |= {"head_a": [], "head_b": [], "tail_a": [], "tail_b": [], "body": ""}
            if not r["ok"]:
                r |= {c: 0 for c in (*_SUMS, "n_best", "count_sum")}
        yield pa.RecordBatch.from_pylist(rows, batch.schema)


def op12_token_alignment(spark, sf_dir: str) -> DataFrame:
    """The alignment of all documents by a byte-level and a piece vocabulary. See align()."""
    import public_tokenizers

    return align(shared.table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
