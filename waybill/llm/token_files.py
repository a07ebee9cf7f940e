"""Token ids as flat binary files.

A part is three flat little-endian files: ``ids`` (unsigned 16- or 32-bit integers, by the size of the
vocabulary), ``offsets`` (n + 1 unsigned 64-bit integers, positions in the part) and ``docs`` (signed
64-bit ids; the smallest value stands for null). Documents ascend by id within parts and over them. The
parts and their bases, prefix sums of the parts' lengths, are the rows of a small table beside them; it
names the files of the attempts that succeeded, so a lost executor's half-written files are never read.
Reading maps the files into memory where the shared folder is a mounted path.

Nulls: a null text is an empty one (its end token only); null ids come first. Rows with equal ids are
in the order of their packed token ids.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm import common as C
from waybill.llm.bpe import byte_letters

#: Characters of texts that are cut at white space; texts with others are encoded whole.
PLAIN = re.compile(r"[^\x09-\x0d\x20-\x7e\xa1-ɏ]|<\|")
NULL_ID = -(1 << 63)


MARKS = frozenset(".,;:!?")


class Words(dict):
    """Run of non-space characters -> packed ids, by the tokenizers library. Bounded: emptied when full.

    The vocabulary file's steps cut a run at the border of letters and marks, so a word with a mark behind
    it is the word and the mark; plain words go to the library's model at once, in lower case and in the
    file's letters for bytes, everything else through all its steps."""

    def __init__(self, path: str, dtype: str, most: int = 300_000):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        super().__init__()
        self.tokenizer, self.dtype, self.most = Tokenizer.from_file(path), np.dtype(dtype), most
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model, self.plain = self.tokenizer.model, {}
        self.letter = {b: c for c, b in byte_letters().items()}

    def pack(self, ids) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def whole(self, text: str) -> bytes:
        return self.pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def word(self, word: str) -> bytes:
        """Ids of a word of lower-case letters."""
        ids = self.plain.get(word)
        if ids is None:
            bytes_ = word if word.isascii() else word.encode().decode("latin-1").translate(self.letter)
            ids = self.pack([t.id for t in self.model.tokenize(bytes_)])
            if len(self.plain) >= self.most:
                self.plain.clear()
            self.plain[word] = ids
        return ids

    def __missing__(self, word: str) -> bytes:
        low = word.lower()
        if low.isalpha():
            ids = self.word(low)
        elif low[-1] in MARKS and low[:-1].isalpha():
            ids = self.word(low[:-1]) + self[low[-1]]
        else:
            ids = self.whole(word)
        if len(word) <= 64:
            if len(self) >= self.most:
                self.clear()
            self[word] = ids
        return ids

    def encode(self, texts: list[str], end: int) -> list[bytes]:
        stop = self.pack([end])
        return [(self.whole(t) if PLAIN.search(t) else b"".join(map(self.__getitem__, t.split()))) + stop for t in texts]


def encode(docs: DataFrame, path: str, end: int, dtype: str) -> DataFrame:
    """doc_id, ids: packed ids with the end token."""
    def run(batches):
        words = C.held(("words", path, dtype), lambda: Words(path, dtype))
        for batch in (part for whole in batches for part in C.slices(whole, 1)):
            text = C.as_text(batch.column(1)).to_pylist()
            ids = words.encode(text, end)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    C.ship(docs.sparkSession)
    C.record_batches(docs.sparkSession, 1000)
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(run, "doc_id long, ids binary"))


def _store(folder: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(folder if "://" in folder else re.sub("^(file:)?/+", "file:///", folder))


def write(encoded: DataFrame, ids: DataFrame, folder: str, dtype: str, part_docs: int = 20_000) -> DataFrame:
    """Writes the files and returns the table of parts: part, path, n_docs, n_tokens, base.

    ``ids`` has the document ids alone (the cuts between parts come from them without encoding)."""
    spark = encoded.sparkSession
    C.ship(spark)
    width = np.dtype(dtype).itemsize
    parts = max(1, -(-ids.count() // part_docs))
    cuts = np.array([])
    if parts > 1:
        key = F.coalesce(F.col("doc_id"), F.lit(NULL_ID)).alias("k")
        at = [i / parts for i in range(1, parts)]
        cuts = np.unique(ids.select(key).approxQuantile("k", at, max(0.1 / parts, 1e-6)))

    def number(batches):
        for batch in batches:
            ids_ = pc.fill_null(batch.column(0), NULL_ID).to_numpy(zero_copy_only=False)
            part = np.searchsorted(cuts, ids_.astype(float)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(part), *batch.columns], names=["part", "doc_id", "ids"])

    def run(batches):
        disk, root = _store(folder)
        current, files, sums = None, None, None

        def close():
            np_off = np.cumsum([0, *sums["n"]]).astype("<u8")
            files["offsets"].write(np_off.tobytes())
            for f in files.values():
                f.close()
            return current, sums["path"], len(sums["n"]), int(np_off[-1])

        for batch in batches:
            done = []
            for p, doc, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if p != current:
                    if files:
                        done.append(close())
                    current, name = p, f"part-{p:06d}-{uuid.uuid4().hex}"
                    sums = {"n": [], "path": name}
                    files = {k: disk.open_output_stream(f"{root}/{name}.{k}") for k in ("ids", "offsets", "docs")}
                files["ids"].write(data)
                files["docs"].write(int(NULL_ID if doc is None else doc).to_bytes(8, "little", signed=True))
                sums["n"].append(len(data) // width)
            if done:
                yield _manifest(done)
        if files:
            yield _manifest([close()])

    disk, root = _store(folder)
    disk.create_dir(root, recursive=True)
    rows = (encoded.select("doc_id", "ids").mapInArrow(number, "part int, doc_id long, ids binary")
            .repartitionById(parts, F.col("part"))
            .sortWithinPartitions("part", F.col("doc_id").asc_nulls_first(), "ids")  # rows of one id: by their ids
            .mapInArrow(run, "part int, path string, n_docs long, n_tokens long"))
    found = C.written(rows, "token-parts").orderBy("part").collect()  # one row for each part
    bases = np.cumsum([0, *(r["n_tokens"] for r in found)])
    table = [(r["part"], r["path"], r["n_docs"], r["n_tokens"], int(b)) for r, b in zip(found, bases)]
    with disk.open_output_stream(f"{root}/parts.json") as f:
        f.write(json.dumps({"dtype": dtype, "parts": table}).encode())
    return spark.createDataFrame(table, "part int, path string, n_docs long, n_tokens long, base long")


def _manifest(rows):
    cols = list(zip(*rows))
    return pa.RecordBatch.from_arrays(
        [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int64()),
         pa.array(cols[3], pa.int64())], names=["part", "path", "n_docs", "n_tokens"])


def mapped(folder: str, name: str, dtype: str):
    """(ids, offsets, doc ids) of a part, memory-mapped on a mounted path."""
    disk, root = _store(folder)
    out = []
    for kind, t in (("ids", dtype), ("offsets", "<u8"), ("docs", "<i8")):
        path = f"{root}/{name}.{kind}"
        size = disk.get_file_info(path).size
        if disk.type_name == "local":
            out.append(np.memmap(path, t, "r") if size else np.zeros(0, t))
        else:
            with disk.open_input_file(path) as f:
                out.append(np.frombuffer(f.read(), t))
    return out


def read(parts: DataFrame, folder: str, dtype: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    def run(batches):
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids, off, docs = mapped(folder, name, dtype)
                off = off.astype(np.int64)
                crc = [zlib.crc32(ids[off[i]:off[i + 1]].astype("<u4").tobytes()) for i in range(len(docs))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.asarray(docs), mask=np.asarray(docs) == NULL_ID), pa.array(off[:-1] + base),
                     pa.array(np.diff(off)), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    C.ship(parts.sparkSession)
    n = max(1, parts.count())
    return (parts.select("path", "base").repartition(n)
            .mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def op8_token_files(spark, sf_dir):
    import public_tokenizers
    docs = C.scan(spark, sf_dir, "documents")
    folder = C.new_folder(spark, "tokens")
    encoded = encode(docs, public_tokenizers.path("word_bpe_49k.json"), 1, "<u2")
    parts = write(encoded, docs.select(F.col("doc_id").cast("long").alias("doc_id")), folder, "<u2")
    return read(parts, folder, "<u2")
