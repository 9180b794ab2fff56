"""Token-ID / binary output: documents as Simple-8b files of token ids, in ascending order of their ids.

Spark deals the documents out by ranges of doc_id and the texts' beginnings, and sorts them inside the ranges; each task
tokenizes its documents, and writes a file whenever it has `file_ids` ids. Every file has a name of its own, and the
manifest, which Spark commits, names those of the tasks that succeeded: what a lost task has left is never read. Reading
takes whole files, decodes all their blocks and slices the documents out.

File layout, little-endian: b"S8B1"; uint32 ids per block; int64 documents, ids, words; then int64 doc_id and uint8
is-null flag per document, int64 ids per document, int64 first word per block and for the end, uint64 words.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weavegraph.llm import simple8b
from weavegraph.llm.common import scratch, slices

MAGIC = b"S8B1"
BLOCK = 1024
MANIFEST = "file string, part int, seq int, n_docs bigint, n_ids bigint"
DOCUMENT = "file string, doc_id bigint, local bigint, n_tokens bigint, ids_crc32 bigint"

#: Tokenizers that drop white space and split off runs of letters allow encoding word by word; the parts of the
#: tokenizer's own description that say so.
WORDWISE = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}


#: Between an ASCII letter or digit and an ASCII mark other than an apostrophe these tokenizers always cut.
PLAIN = np.array([chr(c).isalnum() and c < 128 for c in range(256)])
MARK = np.array([33 <= c < 127 and not chr(c).isalnum() and c != 39 for c in range(256)])


class Numbers(dict):
    """Words to numbers, in the order in which they are first asked for."""

    def __missing__(self, key):
        n = self[key] = len(self)
        return n


def gathered(pool: np.ndarray, size: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the words numbered `at`, one after the other, and each word's number of them; pool has word after word."""
    own = size[at]
    upto = np.cumsum(own)
    return pool[np.repeat((np.cumsum(size) - size)[at] - upto + own, own) + np.arange(upto[-1] if len(upto) else 0)], own


class Encoder:
    """Texts to the ids of the tokenizers library, each distinct word once.

    Where the tokenizer drops white space and cuts between letters and marks, a text's ids are those of its pieces. Pieces
    of Latin-1 letters go to the library's model directly, lower-cased and in its byte alphabet; all others through its
    whole encoding. The first `most_words` pieces stay known. All ids of some texts are gathered as one array.
    """

    def __init__(self, path: str, most_words: int = 200_000):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        described = json.loads(self.tokenizer.to_str())
        self.added = [t["content"] for t in described.get("added_tokens") or []]
        self.wordwise = all(described[k] == v for k, v in WORDWISE.items())
        alphabet = ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {c: alphabet.pre_tokenize_str(chr(c))[0][0] for c in range(128, 256) if chr(c).isalpha()}
        self.model, self.most_words = self.tokenizer.model, most_words
        self.known = Numbers()
        self.ids, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces, one after the other, and each piece's number of them."""
        made: list = [None] * len(pieces)
        rest, tokenize, letters = [], self.model.tokenize, self.letters
        for i, piece in enumerate(pieces):
            if piece.isalpha():
                if piece.isascii():
                    made[i] = [t.id for t in tokenize(piece.lower())]
                    continue
                if max(piece) < "\u0100":
                    made[i] = [t.id for t in tokenize(piece.lower().translate(letters))]
                    continue
            rest.append(i)
        for i, ids in zip(rest, self.whole([pieces[i] for i in rest]), strict=True):
            made[i] = ids
        sizes = np.fromiter(map(len, made), np.int64, len(made))
        return np.fromiter(chain.from_iterable(made), np.uint32, int(sizes.sum())), sizes

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and each text's number of them."""
        if not self.wordwise:
            made = self.whole(texts)
            return np.fromiter(chain.from_iterable(made), np.uint32), np.array([len(x) for x in made], dtype=np.int64)
        if any(a in t for t in texts for a in self.added):
            # A text with an added token in it is a piece as it stands.
            split = [[t] if any(a in t for a in self.added) else t.replace("\n", " ").split(" ") for t in texts]
            pieces, counts = list(chain.from_iterable(split)), np.fromiter(map(len, split), np.int64, len(split))
        else:
            pieces, counts = self.cut(texts)
        before = len(self.known)
        at = np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))
        ids, sizes = self.encode(list(islice(self.known, before, None)))
        pool, size = np.concatenate((self.ids, ids)), np.concatenate((self.sizes, sizes))
        while len(self.known) > max(before, self.most_words):
            self.known.popitem()
        self.sizes = size[: len(self.known)]
        self.ids = pool[: int(self.sizes.sum())]
        out, own = gathered(pool, size, at)
        upto = np.concatenate(([0], np.cumsum(own)))
        return out, np.diff(upto[np.cumsum(counts)], prepend=0)

    @staticmethod
    def cut(texts: list[str]) -> tuple[list[str], np.ndarray]:
        """The pieces of all texts between spaces, line breaks and cuts, and each text's number of them."""
        raw = [t.encode() for t in texts]
        code = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)
        cuts = np.flatnonzero(PLAIN[code[:-1]] & MARK[code[1:]]) + 1
        wide = np.insert(code, cuts, 32)
        wide[wide == 10] = 32
        end = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 1) - 1
        spaces = np.cumsum(wide == 32)[end + np.searchsorted(cuts, end, side="right")]
        return wide[:-1].tobytes().decode().split(" "), np.diff(spaces, prepend=0)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process and file: words met in one task are known in the next."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def forget_words() -> None:
    """Let go of what this worker process knows of words: reading needs none, and the next stage needs the memory."""
    _encoders.clear()


def ended(ids: np.ndarray, lengths: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with end_id behind each text's, and the lengths with it."""
    out = np.empty(len(ids) + len(lengths), dtype=np.uint32)
    mine = np.ones(len(out), dtype=bool)
    mine[np.cumsum(lengths + 1) - 1] = False
    out[mine], out[~mine] = ids, end_id
    return out, lengths + 1


def pack(doc_ids: list[int | None], lengths: np.ndarray, values: np.ndarray) -> bytes:
    """A file of the documents' ids, each document's `lengths` many."""
    words, first = simple8b.encode(values, BLOCK)
    head = MAGIC + np.array([BLOCK], dtype="<u4").tobytes() + np.array([len(doc_ids), len(values), len(words)], dtype="<i8").tobytes()
    keys = np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes() + np.array([d is None for d in doc_ids], dtype="u1").tobytes()
    return head + keys + lengths.astype("<i8").tobytes() + first.astype("<i8").tobytes() + words.astype("<u8").tobytes()


def unpack(content: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """doc_ids, ids per document and all ids of a file."""
    if content[:4] != MAGIC:
        raise ValueError("not a token file")
    block = int(np.frombuffer(content, "<u4", 1, 4)[0])
    docs, n, n_words = np.frombuffer(content, "<i8", 3, 8).tolist()
    at = 32
    keys, null = np.frombuffer(content, "<i8", docs, at), np.frombuffer(content, "u1", docs, at + 8 * docs)
    at += 9 * docs
    lengths = np.frombuffer(content, "<i8", docs, at)
    at += 8 * docs
    blocks = -(-n // block)
    first = np.frombuffer(content, "<i8", blocks + 1, at)
    words = np.frombuffer(content, "<u8", n_words, at + 8 * (blocks + 1))
    return [None if z else k for k, z in zip(keys.tolist(), null.tolist(), strict=True)], lengths, simple8b.decode(words, first, n, block)


def _put(folder: str, name: str, content: bytes) -> None:
    from pyarrow import fs

    for ours, theirs in (("s3a://", "s3://"), ("s3n://", "s3://")):  # Spark's names for stores that pyarrow calls otherwise
        if folder.startswith(ours):
            folder = theirs + folder[len(ours) :]
    files, path = fs.FileSystem.from_uri(folder)
    files.create_dir(path, recursive=True)
    with files.open_output_stream(f"{path}/{name}") as out:
        out.write(content)


#: Characters of a text by which rows of one doc_id are dealt.
HEAD = 64


def write_tokens(docs: DataFrame, folder: str, *, tokenizer: str, end_id: int = 1, doc_id: str = "doc_id", text: str = "text", file_ids: int = 4 << 20) -> DataFrame:
    """Write the files and the manifest under folder, a path of the shared file system; the manifest is returned.

    Null and empty texts are documents of the end id alone, long ones are encoded whole; rows of one doc_id follow each
    other in order of their texts' first HEAD characters, so even all rows of one id, or without one, are shared out;
    null doc_ids come first; repeated rows each count; other columns play no part; no documents, no files.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", F.substring("text", 1, HEAD).alias("head"), F.monotonically_increasing_id().alias("tie"))
    order = ["doc_id", "head", "tie"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, part, seq = encoder(tokenizer), TaskContext.get().partitionId(), 0
        keys, sizes, ids, held = [], [], [], 0

        def flush():
            name = f"part-{part:06d}-{seq:06d}-{os.urandom(8).hex()}.s8b"
            _put(f"{folder}/files", name, pack(keys, np.concatenate(sizes), np.concatenate(ids)))
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(keys)], pa.int64()), pa.array([held], pa.int64())], names=["file", "part", "seq", "n_docs", "n_ids"]
            )

        for batch in batches:
            for piece in slices(batch, 1, 1 << 20):
                values, lengths = ended(*encode(piece.column(1).to_pylist()), end_id)
                its, upto, start = piece.column(0).to_pylist(), np.cumsum(lengths), 0
                while start < len(its):
                    # As many documents as the file still takes, the one that fills it included.
                    before = int(upto[start - 1]) if start else 0
                    stop = min(len(its), int(np.searchsorted(upto, before + file_ids - held)) + 1)
                    keys += its[start:stop]
                    sizes.append(lengths[start:stop])
                    ids.append(values[before : int(upto[stop - 1])])
                    held, start = held + len(ids[-1]), stop
                    if held >= file_ids:
                        yield flush()
                        keys, sizes, ids, held, seq = [], [], [], 0, seq + 1
        if keys:
            yield flush()

    rows.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document in the files: doc_id, start, n_tokens, ids_crc32."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    if manifest.isEmpty():
        return spark.createDataFrame([], "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_words()
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                keys, lengths, ids = unpack(content.as_buffer().to_pybytes())
                upto = np.cumsum(lengths)
                data = memoryview(ids.astype("<u4").tobytes())
                crcs = [zlib.crc32(data[4 * (b - n) : 4 * b]) for b, n in zip(upto.tolist(), lengths.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path.rsplit("/", 1)[1]] * len(keys)), pa.array(keys, pa.int64()), pa.array(upto - lengths), pa.array(lengths), pa.array(crcs, pa.int64())], names=["file", "doc_id", "local", "n_tokens", "ids_crc32"]
                )

    found = spark.read.format("binaryFile").load(f"{folder}/files").select("path", "content").mapInArrow(run, DOCUMENT)
    # A file's first id: the ids of the parts before its own (few rows, one per part), and of its part's earlier files.
    earlier = lambda w, c: F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = manifest.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", earlier(Window.orderBy("part"), "n").alias("base"))
    bases = manifest.join(parts, "part").select("file", (F.col("base") + earlier(Window.partitionBy("part").orderBy("seq"), "n_ids")).alias("base"))
    return found.join(bases, "file").select("doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")


def token_digest(docs: DataFrame, *, tokenizer: str, **options) -> DataFrame:
    """Write all documents and read the files back: doc_id, start, n_tokens, ids_crc32."""
    folder = scratch(docs.sparkSession, "tokens")
    write_tokens(docs, folder, tokenizer=tokenizer, **options)
    return read_tokens(docs.sparkSession, folder)
