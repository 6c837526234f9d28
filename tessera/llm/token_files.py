"""Token-id files with a shared zstandard dictionary.

Under a path lie two Parquet tables (so that Spark's committer writes them to any store, and a lost task leaves nothing):
`dictionary`, one row with the shared dictionary and its SHA-256, and `ids`, a row for each segment: ids of consecutive
documents in ascending doc_id order, each document a zstandard frame of its own, and an index of (doc_id, place of its frame,
tokens before it). Any session can read them by the path alone. `open_document` finds a document's segment by the range of its
ids, which the scan's statistics prune, and decompresses one frame. The dictionary is trained on a bounded sample of the
serialised id arrays; each segment names it by its SHA-256, and readers check it.
"""

import hashlib
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import prepare, scratch_root
from .tokens import encode_all

MAGIC = b"TSRAIDS1"
END = 1
#: The dictionary: its bytes, and the documents and ids that it is trained on at most.
DICTIONARY, SAMPLE_DOCS, SAMPLE_IDS, LEVEL = 65536, 2000, 4096, 3
#: A segment is closed at so many bytes. A file gets about so many documents.
SEGMENT, FILE_DOCS = 1 << 21, 8192
#: Files, which are sorted ranges, at most: beyond that they get longer, not more, so that their bounds stay a small table.
MOST_FILES = 1 << 16
#: A row group of the files, which a writer holds in memory and a reader of one document reads.
ROW_GROUP = 8 << 20
_SCHEMA = "file int, first_doc long, last_doc long, before long, n long, body binary"
_HEAD = struct.Struct("<8s32sII")  # magic, dictionary's SHA-256, documents, bytes of an id
_INDEX = np.dtype([("doc_id", "<i8"), ("place", "<i8"), ("before", "<i8")])


def width(tokenizer: str) -> int:
    from tokenizers import Tokenizer

    return 2 if Tokenizer.from_file(tokenizer).get_vocab_size() <= 1 << 16 else 4


def serialised(ids: bytes, bytes_per_id: int) -> bytes:
    return np.frombuffer(ids, "<u4").astype(f"<u{bytes_per_id}").tobytes() if bytes_per_id != 4 else ids


def train(sample: list[bytes]) -> bytes:
    """A dictionary from serialised id arrays; a raw one, the samples' own bytes, where too few are given to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY, sample).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(sample)[:DICTIONARY] or b"\0" * 8


def segment(entries: list[tuple[int, bytes, int]], dictionary_hash: bytes, bytes_per_id: int) -> bytes:
    """entries: doc_id, frame, tokens. Header, frames, index."""
    index = np.zeros(len(entries) + 1, _INDEX)
    index["doc_id"][:-1] = [e[0] for e in entries]
    index["place"][1:] = np.cumsum([len(e[1]) for e in entries])
    index["before"][1:] = np.cumsum([e[2] for e in entries])
    return _HEAD.pack(MAGIC, dictionary_hash, len(entries), bytes_per_id) + b"".join(e[1] for e in entries) + index.tobytes()


class Segment:
    """Reads a segment: documents by position, each decompressed alone."""

    def __init__(self, body: bytes, dictionary: bytes) -> None:
        magic, name, n, self.width = _HEAD.unpack_from(body)
        if magic != MAGIC or name != hashlib.sha256(dictionary).digest():
            raise ValueError("not a segment of this dictionary")
        self.body, self.index = body, np.frombuffer(body, _INDEX, n + 1, len(body) - (n + 1) * _INDEX.itemsize)
        self.reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))

    def __len__(self) -> int:
        return len(self.index) - 1

    def ids(self, k: int) -> np.ndarray:
        s, e = self.index["place"][k : k + 2] + _HEAD.size
        return np.frombuffer(self.reader.decompress(self.body[s:e]), f"<u{self.width}").astype("<u4")

    def open_document(self, doc_id: int) -> np.ndarray:
        """The ids of one document; KeyError if it isn't here."""
        k = int(np.searchsorted(self.index["doc_id"][:-1], doc_id))
        if k >= len(self) or self.index["doc_id"][k] != doc_id:
            raise KeyError(doc_id)
        return self.ids(k)


def write(docs: DataFrame, tokenizer: str, path: str, end: int = END) -> None:
    """Writes docs (doc_id, text; null text: empty, null doc_id: before all others) under path.

    Rows of one doc_id follow each other, in no set order. A text of any length is one frame. Other columns are ignored. No
    rows give a table without segments, and a dictionary."""
    prepare(spark := docs.sparkSession)
    wide, least = width(tokenizer), -(1 << 63)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(least)).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n = rows.select("doc_id").count()
    files = max(1, min(MOST_FILES, -(-n // FILE_DOCS)))
    # The sample: the documents with the least hashes, at most SAMPLE_DOCS; of each the first SAMPLE_IDS ids.
    wanted = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) <= F.lit(min(1 << 20, (1 << 20) * SAMPLE_DOCS // max(1, n) + 1)))
    sample = [r.text for r in wanted.select(F.xxhash64("doc_id").alias("h"), F.substring("text", 1, SAMPLE_IDS * 4).alias("text")).orderBy("h", "text").limit(SAMPLE_DOCS).collect()]
    dictionary = train([serialised(x[: 4 * SAMPLE_IDS], wide) for x in encode_all(tokenizer, sample, end)])
    name = hashlib.sha256(dictionary).digest()
    spark.createDataFrame([(name, dictionary)], "sha256 binary, body binary").coalesce(1).write.parquet(f"{path}/dictionary")
    shared = spark.sparkContext.broadcast(dictionary)

    def compress(batches):
        of = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(shared.value))
        for b in batches:
            frames, sizes = [], []
            for ids in encode_all(tokenizer, b["text"].to_pylist(), end):
                frames.append(of.compress(serialised(ids, wide)))
                sizes.append(len(ids) // 4)
            file = pa.array(np.searchsorted(table, b["doc_id"].to_numpy()).astype(np.int32))
            yield pa.RecordBatch.from_arrays([b["doc_id"], file, pa.array(sizes, pa.int64()), pa.array(frames, pa.binary())], names=["doc_id", "file", "n", "frame"])

    # Files are ranges of doc_id. Their bounds come from the ids alone, so that texts are not encoded twice.
    bounds = rows.agg(F.percentile_approx("doc_id", [k / files for k in range(1, files)], max(10000, 20 * files)) if files > 1 else F.array().alias("b")).first()[0] or []
    table = np.unique(np.array(bounds, np.int64))
    encoded = rows.mapInArrow(compress, "doc_id long, file int, n long, frame binary")

    def gather(batches):
        """Segments of each file, and the tokens of the file before each."""
        at, held, size, before, first = None, [], 0, 0, 0

        def out():
            body = segment(held, name, wide)
            tokens = sum(e[2] for e in held)
            return tokens, pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), *(pa.array([x], pa.int64()) for x in (held[0][0], held[-1][0], before, tokens)), pa.array([body], pa.binary())], names=["file", "first_doc", "last_doc", "before", "n", "body"])

        for b in batches:
            for i, f, n, frame in zip(*(b[k].to_pylist() for k in ("doc_id", "file", "n", "frame")), strict=True):
                if held and (f != at or size >= SEGMENT):
                    tokens, batch = out()
                    yield batch
                    held, size, before = [], 0, before + tokens if f == at else 0
                at = f
                held.append((i, frame, n))
                size += len(frame)
        if held:
            yield out()[1]

    dealt = encoded.repartitionById(len(table) + 1, F.col("file")).sortWithinPartitions("file", "doc_id")
    dealt.mapInArrow(gather, _SCHEMA).write.option("parquet.block.size", ROW_GROUP).parquet(f"{path}/ids")


def dictionary_of(spark: SparkSession, path: str) -> bytes:
    """The dictionary of the files under path; ValueError if it isn't what its SHA-256 says."""
    row = spark.read.parquet(f"{path}/dictionary").first()
    if hashlib.sha256(row.body).digest() != bytes(row.sha256):
        raise ValueError(f"the dictionary under {path} is damaged")
    return bytes(row.body)


def open_document(spark: SparkSession, path: str, doc_id: int) -> np.ndarray:
    """The ids of one document of the files under path (of rows with one doc_id, the first); KeyError if there is none.

    Reads the segment whose range of ids holds it, and decompresses that document alone."""
    held = spark.read.schema(_SCHEMA).parquet(f"{path}/ids").where((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id))
    if (row := held.orderBy("file", "before").select("body").first()) is None:
        raise KeyError(doc_id)
    return Segment(bytes(row.body), dictionary_of(spark, path)).open_document(doc_id)


def read(spark: SparkSession, path: str) -> DataFrame:
    """A row for each document of the files: doc_id, start (ids before it, over all files), n_tokens, ids_crc32.

    Documents of a null id have a null doc_id again. Files without segments give no rows."""
    segments = spark.read.schema(_SCHEMA).parquet(f"{path}/ids")
    per_file = segments.groupBy("file").agg(F.sum("n").alias("n"))  # one short row for each file
    offsets = per_file.select(F.col("file").alias("f"), (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("offset"))
    shared = spark.sparkContext.broadcast(dictionary_of(spark, path))

    def decode(batches):
        for b in batches:
            for base, body in zip(b["start"].to_pylist(), b["body"].to_pylist(), strict=True):
                s = Segment(body, shared.value)
                ids = s.index["doc_id"][:-1]
                crc = [zlib.crc32(s.ids(k).tobytes()) for k in range(len(s))]
                yield pa.RecordBatch.from_arrays([pa.array(ids, mask=ids == -(1 << 63)), pa.array(s.index["before"][:-1] + base), pa.array(np.diff(s.index["before"])), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    on = segments.join(offsets, F.col("file") == F.col("f")).select((F.col("before") + F.col("offset")).alias("start"), "body")
    return on.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, end: int = END) -> DataFrame:
    """Writes docs to the shared folder and reads them back: the rows of `read`, cases as in `write`."""
    path = f"{scratch_root(docs.sparkSession)}/tessera-{uuid.uuid4().hex}/ids"
    write(docs, tokenizer, path, end)
    return read(docs.sparkSession, path)
