"""Token-id files: byte planes of fixed-size id blocks, with a chunk index.

A file is MAGIC, the compressed planes of its blocks one after another, the
compressed document table, the index as JSON, the index's length (8 bytes,
little endian) and MAGIC again. A block holds BLOCK ids (the last one fewer) as
as many byte planes as its largest id needs: plane p has byte p of every id.
"""

from __future__ import annotations

import json
import os
import re
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorlake.llm.common import Commit, Scratch, filesystem, parts, small_batches, table

MAGIC = b"IDPLANE1"
BLOCK = 1 << 16
#: A file is closed when it has so many bytes, or so many documents.
ROLL_BYTES = 64 << 20
ROLL_DOCS = 1 << 20
#: Words whose ids a worker remembers.
REMEMBERED = 800_000
TOKENIZER = "word_bpe_49k.json"
END = 2

MANIFEST = "file string, part int, seq int, docs long, tokens long, bytes long"


#: A text in which the tokenizer's own parts are found by PART alone: ASCII and
#: composed Latin letters, which no normal form changes.
PLAIN = re.compile(r"[\t\n\x20-\x7E\u00C0-\u024F]*")
#: The parts that the tokenizer encodes one by one, as its file states them,
#: for the letters and digits that a plain text has in lower case.
LETTERS = r"a-z\u00DF-\u00F6\u00F8-\u02AF\u2C60-\u2C7F"
PART = re.compile(rf"[{LETTERS}]+|[^\s{LETTERS}0-9'][^\s{LETTERS}0-9]*|[0-9]|'(?:s|t|re|ve|m|ll|d)|'[^\s{LETTERS}0-9]*")


class WordEncoder:
    """Ids of whole texts, as bytes. A plain text's ids are those of its parts
    in turn, and each distinct part is encoded once: with many others in one
    text, cut after each id that ends a part. Other texts are cut at spaces,
    tabs and line feeds, which never join what stands around them in a token of
    this tokenizer, and each distinct word is encoded as it is."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer, self.words, self.parts = Tokenizer.from_file(path), {}, {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True

    def __call__(self, texts: list[str]) -> list[bytes]:
        cut = []
        for x in texts:
            if PLAIN.fullmatch(x) and "<|" not in x:
                cut.append((self.parts, PART.findall(x.lower())))
            else:
                cut.append((self.words, x.replace("\n", " ").replace("\t", " ").split(" ")))
        for known, learn in ((self.parts, self.learn_parts), (self.words, self.learn_words)):
            if len(known) > REMEMBERED:
                known.clear()
            learn(list(set().union(*(pieces for of, pieces in cut if of is known)).difference(known)))
        return [b"".join(map(known.__getitem__, pieces)) for known, pieces in cut]

    def encode(self, words: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype="<u4") for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def learn_words(self, words: list[str]) -> None:
        for at in range(0, len(words), 4096):
            some = words[at:at + 4096]
            self.words.update((w, x.tobytes()) for w, x in zip(some, self.encode(some)))

    def learn_parts(self, parts: list[str]) -> None:
        for at in range(0, len(parts), 4096):
            some = parts[at:at + 4096]
            ids, = self.encode([" ".join(some)])
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(some) or cuts[-1] != len(ids):
                raise ValueError("the tokenizer's file has other parts than this encoder")
            data, ends = ids.tobytes(), (4 * cuts).tolist()
            self.parts.update(zip(some, map(data.__getitem__, map(slice, [0, *ends], ends))))


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(name: str) -> WordEncoder:
    """One encoder for each worker process and tokenizer."""
    if name not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker for each core
        import public_tokenizers
        _ENCODERS[name] = WordEncoder(public_tokenizers.path(name))
    return _ENCODERS[name]


def encode_block(ids: np.ndarray, c: zstandard.ZstdCompressor) -> list[bytes]:
    planes = max(1, (int(ids.max(initial=0)).bit_length() + 7) // 8)
    by_byte = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    return [c.compress(np.ascontiguousarray(by_byte[:, p]).tobytes()) for p in range(planes)]


def decode_block(planes: list[bytes], n: int) -> np.ndarray:
    d, by_byte = zstandard.ZstdDecompressor(), np.zeros((n, 4), np.uint8)
    for p, data in enumerate(planes):
        by_byte[:, p] = np.frombuffer(d.decompress(data, max_output_size=max(n, 1)), np.uint8)
    return by_byte.reshape(-1).view("<u4")


class Writer:
    """One file. Ids wait for a full block only, never for the whole file."""

    def __init__(self, folder: str, name: str, level: int = 3):
        self.out, self.c = Commit(folder, name), zstandard.ZstdCompressor(level=level)
        self.out.write(MAGIC)
        self.name, self.index, self.docs, self.tokens = name, [], [], 0
        self.held, self.waiting = [], 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append((doc_id, len(ids) // 4))
        self.tokens += len(ids) // 4
        self.held.append(ids)
        self.waiting += len(ids)
        if self.waiting >= 4 * BLOCK:
            self.flush(False)

    def flush(self, last: bool) -> None:
        ids = np.frombuffer(b"".join(self.held), "<u4")
        upto = len(ids) if last else len(ids) // BLOCK * BLOCK
        for at in range(0, upto, BLOCK):
            block = ids[at:min(at + BLOCK, upto)]
            planes, start = encode_block(block, self.c), self.out.size
            for p in planes:
                self.out.write(p)
            self.index.append([start, len(block), [len(p) for p in planes]])
        self.held, self.waiting = [ids[upto:].tobytes()], 4 * (len(ids) - upto)

    def close(self) -> dict:
        self.flush(True)
        known = np.array([d is not None for d, _ in self.docs], np.uint8)
        columns = [np.array([d or 0 for d, _ in self.docs], "<i8"), np.array([n for _, n in self.docs], "<i8"), known]
        packed, start = self.c.compress(b"".join(x.tobytes() for x in columns)), self.out.size
        self.out.write(packed)
        index = json.dumps({"blocks": self.index, "docs": [start, len(packed), len(self.docs)], "tokens": self.tokens}, separators=(",", ":"), sort_keys=True).encode()
        self.out.write(index + len(index).to_bytes(8, "little") + MAGIC)
        self.out.close()
        return {"file": self.name, "docs": len(self.docs), "tokens": self.tokens, "bytes": self.out.size}


class Reader:
    def __init__(self, folder: str, name: str):
        fs, root = filesystem(folder)
        self.f = fs.open_input_file(f"{root}/{name}")
        size = self.f.size()
        tail = self.at(size - 16, 16)
        if tail[8:] != MAGIC or self.at(0, 8) != MAGIC:
            raise ValueError(f"{name} is not a whole token file")
        n = int.from_bytes(tail[:8], "little")
        self.index = json.loads(self.at(size - 16 - n, n))

    def at(self, start: int, n: int) -> bytes:
        self.f.seek(start)
        return self.f.read(n)

    def documents(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, token counts, and which ids are not null."""
        start, n, docs = self.index["docs"]
        raw = zstandard.ZstdDecompressor().decompress(self.at(start, n), max_output_size=max(17 * docs, 1))
        return np.frombuffer(raw[:8 * docs], "<i8"), np.frombuffer(raw[8 * docs:16 * docs], "<i8"), np.frombuffer(raw[16 * docs:], np.uint8).astype(bool)

    def blocks(self, first: int = 0):
        """Ids of the blocks from number ``first`` on."""
        for start, n, sizes in self.index["blocks"][first:]:
            data, planes = self.at(start, sum(sizes)), []
            for s in sizes:
                planes.append(data[:s])
                data = data[s:]
            yield decode_block(planes, n)

    def ids(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from position ``start``, from the blocks that hold them."""
        out, first = [], start // BLOCK
        at, need = first * BLOCK, start + n
        for b in self.blocks(first):
            if at >= need:
                break
            out.append(b[max(0, start - at):need - at])
            at += len(b)
        return np.concatenate(out) if out else np.zeros(0, "<u4")

    def close(self) -> None:
        self.f.close()


def write_token_files(docs: DataFrame, folder: str, tokenizer: str = TOKENIZER, end: int = END, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write ``docs`` (doc_id, text) in ascending doc_id order and return the
    manifest, which is also written beside the files.

    Null ids come last; rows with equal ids are ordered by text hash; null
    texts are empty and hold the end id alone; an empty table writes no file.
    Files have their own names only when whole, and a repeated task writes the
    same bytes again, so lost executors leave nothing half done. Only files
    that the manifest names count.
    """
    spark = docs.sparkSession
    small_batches(spark)
    schema = pa.schema([("file", pa.string()), ("part", pa.int32()), ("seq", pa.int32()), ("docs", pa.int64()), ("tokens", pa.int64()), ("bytes", pa.int64())])

    def run(batches):
        part, seq, out = TaskContext.get().partitionId(), 0, None
        encode, last = encoder(tokenizer), np.array([end], "<u4").tobytes()

        def done(w: Writer, seq: int):
            row = w.close() | {"part": part, "seq": seq}
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for b in batches:
            texts = [x or "" for x in b.column("text").to_pylist()]
            for doc_id, ids in zip(b.column("doc_id").to_pylist(), encode(texts)):
                out = out or Writer(folder, f"tokens-{part:06d}-{seq:06d}.idp")
                out.add(doc_id, ids + last)
                if out.out.size >= roll_bytes or len(out.docs) >= ROLL_DOCS:
                    yield done(out, seq)
                    out, seq = None, seq + 1
        if out:
            yield done(out, seq)

    order = [F.col("doc_id").asc_nulls_last(), F.col("h").asc()]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
    rows = rows.repartitionByRange(parts(spark), *order).sortWithinPartitions(*order).select("doc_id", "text")
    path = f"{folder}/manifest"
    rows.mapInArrow(run, MANIFEST).write.parquet(path)
    return spark.read.schema(MANIFEST).parquet(path)


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document of the files
    that the manifest names; start counts the ids of all before it."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    before = F.coalesce(F.sum("tokens").over(Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = manifest.select("file", before.alias("before"))  # a row for each file
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches):
        for b in batches:
            for name, start in zip(b.column("file").to_pylist(), b.column("before").to_pylist()):
                r = Reader(folder, name)
                doc, n, known = r.documents()
                crc, blocks, held, out = [], r.blocks(), np.zeros(0, "<u4"), zlib.crc32(b"")
                for want in n.tolist():
                    out = zlib.crc32(b"")
                    while want:
                        if not len(held):
                            held = next(blocks)
                        out = zlib.crc32(held[:want].tobytes(), out)
                        want, held = want - len(held[:want]), held[want:]
                    crc.append(out)
                r.close()
                at = start + np.cumsum(n) - n
                for i in range(0, len(n), 10_000):
                    s = slice(i, i + 10_000)
                    yield pa.RecordBatch.from_arrays([pa.array(doc[s], mask=~known[s]), pa.array(at[s]), pa.array(n[s]), pa.array(crc[s], pa.int64())], schema=schema)

    return files.repartition(parts(spark), "file").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_documents(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """Write token files into the shared folder and read every document back."""
    spark = docs.sparkSession
    folder = Scratch(spark, "tokens").path("files")
    write_token_files(docs, folder, tokenizer)
    return read_documents(spark, folder)


def op2_tokens(spark, sf_dir: str) -> DataFrame:
    return token_documents(table(spark, sf_dir, "documents"))
