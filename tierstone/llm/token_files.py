"""Token ids of documents in compressed files with a shared dictionary and an offset index.

A file holds, one after the other: the magic word, the documents' frames, the
dictionary, the index, and a footer of fixed length. Each document is one zstandard
frame over its ids (little-endian, two bytes each where the vocabulary allows, else
four), made with the dictionary, so any one is read and decoded without the others.
Integers are little-endian; the index has per document: id, a flag for a NULL id,
offset and length of the frame, number of ids.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierstone.llm.common import in_batches, python_values, share, small_batches, stored
from tierstone.scratch import new_folder

# Fixed values of the format.
MAGIC = b"TSTOKEN1"
FOOTER = struct.Struct("<QQQB32s8s")
INDEX = np.dtype(
    [("doc_id", "<i8"), ("null_id", "u1"), ("offset", "<u8"), ("size", "<u4"), ("n_tokens", "<u4")]
)

END_ID = 1
#: The dictionary is trained on about this many documents, none longer than this.
SAMPLE_DOCUMENTS, SAMPLE_BYTES, DICTIONARY_BYTES = 2000, 32_768, 65_536
LEVEL = 3


class WordCache(dict):
    """Ids of stretches without space or newline, as bytes; what is new is encoded.

    Such a stretch is encoded alone as it is inside its text: this tokenizer drops
    white space and begins a new word after it, and neither normal forms nor lower
    case reach across a space. `bound` limits the entries.
    """

    def __init__(self, tokenizer, kind: str, bound: int = 1_000_000) -> None:
        super().__init__()
        self.tokenizer, self.kind, self.bound = tokenizer, kind, bound
        # Marks at the end of a stretch, but for apostrophes and those that special tokens have.
        special = {c for token in tokenizer.get_added_tokens_decoder().values() for c in token.content}
        inside = "".join(re.escape(c) for c in sorted(special) if not c.isalnum())
        self.marks = re.compile(rf"(?<=[^\W_])[^\w\s'{inside}]+\Z")
        # What the tokenizer makes of each letter before it looks words up.
        split = tokenizer.pre_tokenizer.pre_tokenize_str
        letters = [chr(c) for c in range(0x80, 0x130) if chr(c).isalpha()]
        self.letters = {ord(c): "".join(piece for piece, _ in split(c)) for c in letters}

    def _encoded(self, stretch: str) -> bytes:
        if stretch.isalpha() and stretch == stretch.lower() and (stretch.isascii() or max(stretch) < "\u0130"):
            # One word of letters, each composed and lower: only their spelling changes.
            word = stretch if stretch.isascii() else stretch.translate(self.letters)
            ids = [token.id for token in self.tokenizer.model.tokenize(word)]
        else:
            ids = self.tokenizer.encode(stretch, add_special_tokens=False).ids
        return array("H" if self.kind == "<u2" else "I", ids).tobytes()

    def __missing__(self, stretch: str) -> bytes:
        if len(self) >= self.bound:
            self.clear()
        lowered = stretch.lower() if stretch.isascii() or max(stretch) < "\u0130" else None
        if lowered is None:
            ids = self._encoded(stretch)
        # Below that letter, lower case goes letter by letter, and marks after a letter or
        # digit begin a word of their own; apostrophes may belong to what is before them.
        elif lowered and not lowered[-1].isalnum() and (marks := self.marks.search(lowered)):
            ids = self[lowered[: marks.start()]] + self[marks[0]]
        elif lowered != stretch:
            ids = self[lowered]
        else:
            ids = self._encoded(stretch)
        self[stretch] = ids
        return ids


class Encoder:
    """Encodes whole texts with a tokenizer file; `tokenizers` does the encoding.

    A tokenizer that is not of the kind `WordCache` is right for encodes text by text.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.words = WordCache(self.tokenizer, self.kind) if _drops_space(self.tokenizer) else None

    def __call__(self, text: str) -> bytes:
        if self.words is None:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return np.array(ids, self.kind).tobytes()
        return b"".join(map(self.words.__getitem__, text.replace("\n", " ").split(" ")))


def _drops_space(tokenizer) -> bool:
    """Whether it lowers case, drops white space and splits words there: checked by what
    it makes of a small sample."""
    ids = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
    apart = ids("Ab") + ids("c") + ids(".") + ids("d") + ids("'s")
    return ids("Ab\nc. d 's") == apart == ids("ab c .  d 's")


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process and tokenizer: its word cache serves later tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def train_dictionary(
    docs: DataFrame, tokenizer: str, end_id: int, doc_id: str, text: str,
    documents: int = SAMPLE_DOCUMENTS, longest: int = SAMPLE_BYTES,
) -> bytes:
    """A shared zstandard dictionary from the ids of about `documents` documents.

    The sample is drawn by a hash of id and text among those of at most `longest`
    bytes; both are bounds on what the driver holds, and the dictionary affects the
    size of files only. Too few documents to train on give an empty dictionary.
    """
    short = docs.where(F.octet_length(F.col(text)).between(1, longest))
    rate = min(1.0, documents / max(1, short.count()))
    rows = short.where(share(F.col(doc_id), F.col(text)) < rate).select(F.col(text))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        end = np.array([end_id], encode.kind).tobytes()
        made = ((encode(content) + end,) for (content,) in python_values(batches))
        return in_batches(made, pa.schema([("ids", pa.binary())]), 200)

    samples = [bytes(r[0]) for r in rows.mapInArrow(work, "ids binary").collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=True)


def _decompressor(dictionary: bytes) -> zstandard.ZstdDecompressor:
    data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdDecompressor(dict_data=data)


#: Schemes that Spark's file systems have and Arrow knows by another name.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def arrow_uri(path: str) -> str:
    scheme, mark, rest = path.partition("://")
    return f"{SCHEMES.get(scheme, scheme)}{mark}{rest}"


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(arrow_uri(path))


_MANIFEST = pa.schema(
    [("path", pa.string()), ("part", pa.int64()), ("documents", pa.int64()), ("tokens", pa.int64()),
     ("dictionary_hash", pa.string())]
)


def write(
    docs: DataFrame, tokenizer: str, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Encode and write all documents; returns the manifest, one row per file.

    Files follow each other in ascending id (NULL ids first), and so do the documents
    in a file; equal ids are ordered by a hash of the text. NULL texts are empty ones
    and hold the end id alone. Every attempt of a task writes a file of its own
    name, and only files of attempts that ended well are in the manifest, so retried,
    lost or repeated tasks leave nothing that is read. An empty table gives no file.
    """
    small_batches(docs.sparkSession)
    dictionary = train_dictionary(docs, tokenizer, end_id, doc_id, text)
    folder = new_folder(docs.sparkSession, "tokens")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = python_values(batches)
        first = next(rows, None)
        if first is None:
            return iter(())
        return in_batches(iter([_write_file(folder, first, rows, encoder(tokenizer), end_id, dictionary)]), _MANIFEST)

    order = [F.col("doc_id"), F.xxhash64("text")]
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    kinds = "path string, part long, documents long, tokens long, dictionary_hash string"
    return stored(dealt.mapInArrow(work, kinds), "manifest")


def _write_file(folder, first, rows, encode, end_id, dictionary) -> tuple:
    from pyspark import TaskContext

    context = TaskContext.get()
    part, attempt = context.partitionId(), context.taskAttemptId()
    path = f"{folder}/part-{part:06d}-{attempt}.tok"
    system, place = _open(path)
    system.create_dir(place.rpartition("/")[0], recursive=True)
    end, width = np.array([end_id], encode.kind).tobytes(), np.dtype(encode.kind).itemsize
    compress = _compressor(dictionary).compress
    index, tokens, at = [], 0, len(MAGIC)
    with system.open_output_stream(place) as out:
        out.write(MAGIC)
        row = first
        while row is not None:
            ids = encode(row[1]) + end
            frame = compress(ids)
            out.write(frame)
            index.append((row[0] or 0, row[0] is None, at, len(frame), len(ids) // width))
            at, tokens = at + len(frame), tokens + len(ids) // width
            row = next(rows, None)
        out.write(dictionary)
        entries = np.array(index, INDEX)
        out.write(entries.tobytes())
        digest = hashlib.sha256(dictionary).digest()
        out.write(FOOTER.pack(at, len(dictionary), len(entries), width, digest, MAGIC))
    return path, part, len(index), tokens, digest.hex()


class TokenFile:
    """Random access to the documents of one file."""

    def __init__(self, path: str) -> None:
        system, place = _open(path)
        self.file = system.open_input_file(place)
        size = self.file.size()
        tail = self.file.read_at(FOOTER.size, size - FOOTER.size)
        end, dictionary_size, documents, width, digest, magic = FOOTER.unpack(tail)
        if magic != MAGIC:
            raise ValueError(f"{path}: not a token file")
        dictionary = self.file.read_at(dictionary_size, end)
        if hashlib.sha256(dictionary).digest() != digest:
            raise ValueError(f"{path}: damaged dictionary")
        self.kind = f"<u{width}"
        self.index = np.frombuffer(
            self.file.read_at(documents * INDEX.itemsize, end + dictionary_size), INDEX
        )
        self.decompress = _decompressor(dictionary).decompress

    def ids(self, number: int) -> np.ndarray:
        """Ids of the file's document of that number, alone."""
        entry = self.index[number]
        frame = self.file.read_at(int(entry["size"]), int(entry["offset"]))
        ids = np.frombuffer(self.decompress(frame), self.kind)
        if len(ids) != entry["n_tokens"]:
            raise ValueError("damaged frame")
        return ids

    def __enter__(self) -> TokenFile:
        return self

    def __exit__(self, *_) -> None:
        self.file.close()


def read_files(manifest: DataFrame, summarise: Callable[[np.ndarray], tuple], kinds: str, schema: pa.Schema) -> DataFrame:
    """Read every document of the manifest's files back, in as many tasks as there are files.

    Gives doc_id, start (ids of all documents before it, in file order) and what
    `summarise` makes of the ids. Only the manifest, one row per file, is ordered
    as a whole; it has as many rows as the writing job had tasks.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    out = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), *schema])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for path, start in python_values(batches):
                with TokenFile(path) as file:
                    for number, entry in enumerate(file.index):
                        ids = file.ids(number)
                        yield None if entry["null_id"] else int(entry["doc_id"]), start, *summarise(ids)
                        start += len(ids)

        return in_batches(rows(), out)

    # A task for each file: left to itself, adaptive execution would merge these few rows, and
    # with them all files, into one task.
    dealt = files.select("path", "start").repartition(max(1, manifest.count()), "path")
    return dealt.mapInArrow(work, f"doc_id long, start long, {kinds}")


def count_and_checksum(ids: np.ndarray) -> tuple[int, int]:
    """Number of ids, and crc32 of the ids as little-endian unsigned 32-bit integers."""
    return len(ids), zlib.crc32(ids.astype("<u4").tobytes())
