"""Token ids of whole texts in files of patched frame-of-reference blocks.

Documents are dealt by ranges of their id, sorted within each range, encoded and
written as one file a range, or more where a range is large. The files hold the ids in ascending order of document,
so a document's start is the sum of what the files before its own hold, plus the sum
of what stands before it in its file; nothing of the texts is moved a second time.

Encoding cuts a text at spaces between two characters that aren't white space, where
byte-level pre-tokens always end, and keeps the ids of pieces and pre-tokens that it
has met in tables of a bounded size.
"""

from __future__ import annotations

import functools
import re
import string
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gazetta.llm.common import NO_ID, column, materialise, qualified, scratch_dir
from gazetta.llm.patched_blocks import decode_file, encode_file
from gazetta.llm.shared_files import read_files, write_file

VOCABULARY, END_ID = "byte_bpe_50k.json", 0
SUFFIX = ".pfor"
#: UTF-8 bytes of text for one file, about, and entries of a worker's tables.
FILE_BYTES, MOST_PIECES = 16 << 20, 250_000
#: Ids after which a task begins a new file, bits of a file's number within its range, and ranges whose sums are taken together.
FILE_IDS, FILE_BITS, CHUNK_BITS = 12 << 20, 24, 12
#: ASCII characters that are neither letters, digits nor white space.
MARKS = string.punctuation


def default_tokenizer() -> str:
    return public_tokenizers.path(VOCABULARY)


def _byte_letters() -> dict[int, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes for themselves, others from 256 on."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: b for b in printable} | {b: 256 + i for i, b in enumerate(others)}


class _Blank(Exception):
    """A piece has white space at a border, where a cut at a space is not one between pre-tokens."""


class _Pieces(dict):
    """Text without a space in it, to the ids of it with ``prefix`` before it, as bytes.

    The table has two generations: a full one becomes the older, from which what is
    asked for again comes back, so that frequent words outlive the many that come once.
    """

    def __init__(self, prefix: str, model, find, code: str, most: int, bare: _Pieces | None = None):
        self.prefix, self.model, self.find, self.code, self.most = prefix, model, find, code, most
        self.letters, self.older = _byte_letters(), {}
        self.start = "".join(chr(self.letters[b]) for b in prefix.encode())
        self.bare = self if bare is None else bare

    def ids(self, pre_token: str) -> bytes:
        letters = pre_token.encode().decode("latin-1").translate(self.letters)
        return array(self.code, [t.id for t in self.model.tokenize(letters)]).tobytes()

    def make(self, piece: str) -> tuple[bytes, bool]:
        """The ids of a piece that isn't all letters, and whether they are worth keeping."""
        if not piece or piece[0].isspace() or piece[-1].isspace():
            raise _Blank
        core = piece.rstrip(MARKS)
        if core.isalpha():  # letters, then one pre-token of marks
            known = core in self or core in self.older
            return self[core] + self.bare[piece[len(core) :]], known
        if "\n" in piece:
            lines = piece.split("\n")
            if not any(not x or x[0].isspace() or x[-1].isspace() for x in lines):
                # A line end between two characters that aren't white space is a pre-token; two words around one hardly come again.
                return self[lines[0]] + b"".join([x for line in lines[1:] for x in (self.bare.line_end, self.bare[line])]), False
        parts = self.find(self.prefix + piece)
        if len(parts) == 1:
            return self.ids(parts[0]), True
        head = parts[0][len(self.prefix) :]
        found = self[head] if head and not head[0].isspace() and not head[-1].isspace() else self.ids(parts[0])
        return found + b"".join([self.bare.whole(p) for p in parts[1:]]), "\n" not in piece

    def whole(self, pre_token: str) -> bytes:
        """One pre-token, which may hold white space."""
        return self.ids(pre_token) if pre_token[0].isspace() or pre_token[-1].isspace() else self[pre_token]

    @functools.cached_property
    def line_end(self) -> bytes:
        return self.ids("\n")

    def __missing__(self, piece: str) -> bytes:
        found = self.older.get(piece)
        if found is None:
            if piece.isalpha():  # one pre-token; ASCII letters stand for themselves
                letters = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
                found = array(self.code, [t.id for t in self.model.tokenize(self.start + letters)]).tobytes()
            else:
                found, keep = self.make(piece)
                if not keep:
                    return found
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[piece] = found
        return found


class Encoder:
    """Whole texts to ids, equal to ``encode(text, add_special_tokens=False)`` of the tokenizer as it is loaded.

    A text that holds the text of an added token goes to the library itself, which knows
    it. Works for byte-level BPE vocabularies that the library pre-tokenizes with ``public_tokenizers.PATTERN``.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        small = self.tokenizer.get_vocab_size() <= 1 << 16
        self.kind, code = ("<u2", "H") if small else ("<u4", "I")
        self.find = regex.compile(public_tokenizers.PATTERN).findall
        self.bare = _Pieces("", self.tokenizer.model, self.find, code, MOST_PIECES // 8)
        self.pieces = _Pieces(" ", self.tokenizer.model, self.find, code, MOST_PIECES // 2, self.bare)

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, self.kind)
        if any(x in text for x in self.added):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind)
        parts, pieces = text.split(" "), self.pieces
        try:
            if len(parts) > 1 and (not parts[0] or parts[0][-1].isspace()):
                raise _Blank
            rest = b"".join([pieces[p] for p in parts[1:]])
        except _Blank:
            # White space beside a space: cut nothing there, leave it to the pattern.
            parts = re.split(r"(?<=\S) (?=\S)", text)
            rest = b"".join([pieces[p] if not p[-1].isspace() else b"".join([self.bare.whole(x) for x in self.find(" " + p)]) for p in parts[1:]])
        first = b"".join([self.bare.whole(p) for p in self.find(parts[0])])
        return np.frombuffer(first + rest, self.kind)


@functools.lru_cache(maxsize=1)
def encoder_of(path: str) -> Encoder:
    """One encoder a worker: its tables serve all tasks that the worker runs."""
    return Encoder(path)


def _write(folder: str, path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = encoder_of(path), TaskContext.get().partitionId()
        ids, counts, parts, size, number = [], [], [], 0, 0
        end = np.array([end_id], encoder.kind)

        def flush() -> pa.RecordBatch:
            values = np.concatenate(parts)
            write_file(folder, f"part-{part:08d}-{number:06d}{SUFFIX}", encode_file(ids, counts, values))
            row = (part << FILE_BITS | number, len(values), ids[0], ids[-1])
            return pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in row], ["file", "n_ids", "first", "last"])

        for batch in batches:
            for owner, text in zip(batch.column("owner").to_pylist(), batch.column("text"), strict=True):
                own = encoder.encode(text.as_py() or "")
                ids.append(owner)
                parts += [own, end]
                counts.append(len(own) + 1)
                size += len(own) + 1
                if size >= FILE_IDS:
                    yield flush()
                    ids, counts, parts, size, number = [], [], [], 0, number + 1
        if ids:
            yield flush()

    return run


def write_tokens(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write the ids of every whole text (null: empty), each with ``end_id`` behind it.

    Returns the manifest, a written table with a row a file: ``file`` (its number, in the
    order of the ids), ``n_ids``, ``first`` and ``last`` id of a document. Rows that share an id stand
    side by side, ordered by text; rows without an id stand last, in as many ranges and files as
    their texts need. An empty table writes no file. Other columns are ignored.
    """
    base = docs.select(F.coalesce(column(docs, id_col).cast("long"), F.lit(NO_ID)).alias("owner"), column(docs, text_col).alias("text"))
    size = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // FILE_BYTES))
    # The beginnings of texts cut what shares an id; they sort as the texts do.
    dealt = base.repartitionByRange(n, "owner", F.substring("text", 1, 32)).sortWithinPartitions("owner", "text")
    written = dealt.mapInArrow(_write(qualified(docs.sparkSession, folder), tokenizer or default_tokenizer(), end_id), "file long, n_ids long, first long, last long")
    manifest = materialise(written)
    before = F.lag("last").over(Window.partitionBy("chunk").orderBy("file"))
    chunked = manifest.withColumn("chunk", F.shiftright("file", FILE_BITS + CHUNK_BITS)).withColumn("before", before)
    if not chunked.where("first > last OR before > first").isEmpty():
        raise RuntimeError("the files are not in the order of the ids")
    return manifest


def file_starts(manifest: DataFrame) -> DataFrame:
    """``file``, ``base``: the number of ids in all files before. Sums within chunks of the ranges, then over the chunks."""
    chunked = manifest.withColumn("chunk", F.shiftright("file", FILE_BITS + CHUNK_BITS))
    inner = F.coalesce(F.sum("n_ids").over(Window.partitionBy("chunk").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = chunked.groupBy("chunk").agg(F.sum("n_ids").alias("many"))
    outer = F.coalesce(F.sum("many").over(Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return chunked.withColumn("inner", inner).join(sums.withColumn("outer", outer), "chunk").select("file", (F.col("inner") + F.col("outer")).alias("base"))


def read_tokens(spark: SparkSession, folder: str, manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """Read the files of a manifest back: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` (of the ids as
    little-endian unsigned 32-bit integers) and, if asked for, ``ids``."""
    schema = "file long, doc_id long, before long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    if manifest.isEmpty():
        return spark.createDataFrame([], schema).withColumnRenamed("before", "start").drop("file")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("name").to_pylist(), batch.column("content"), strict=True):
                part, number = map(int, re.findall(r"\d+", name)[:2])
                ids, counts, values = decode_file(content.as_buffer().to_pybytes())
                values = values.astype("<u4")
                ends = np.cumsum(counts)
                before = ends - counts
                crcs = [zlib.crc32(values[a:b]) for a, b in zip(before.tolist(), ends.tolist(), strict=True)]
                cols = [
                    pa.array(np.full(len(ids), part << FILE_BITS | number), pa.int64()),
                    pa.array(ids, pa.int64(), mask=ids == NO_ID),
                    pa.array(before, pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array(crcs, pa.int64()),
                ]
                names = ["file", "doc_id", "before", "n_tokens", "ids_crc32"]
                if with_ids:
                    cols.append(pa.array([values[a:b].astype(np.int64) for a, b in zip(before.tolist(), ends.tolist(), strict=True)], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    rows = read_files(spark, folder, SUFFIX).mapInArrow(run, schema)
    kept = ["doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    return rows.join(file_starts(manifest), "file").select(*kept)


def token_round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """Write all texts as token files in the shared folder and return what the files say."""
    folder = scratch_dir(docs.sparkSession)
    return read_tokens(docs.sparkSession, folder, write_tokens(docs, folder, id_col, text_col, tokenizer))
