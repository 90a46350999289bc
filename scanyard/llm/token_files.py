"""Token ids in files of independent zstandard frames with a trailing seek table.

Documents are laid down in ascending order of id, one file per range of ids and one frame per
document. The last frame is a skippable one that lists every frame's sizes and the checksum of its
content, as the public seekable format describes it, so any zstandard reader can read a file as a
whole and ``read`` takes only the frames of the documents asked for. A file is written under a
name of its own; the index lists the files of tasks that ended well, so those of lost executors
are never read.

Each document is its ids and one end id, so null or empty texts are one id. Repeated ids are laid
side by side in the order of their texts, null ids come first; an empty table gives no files and an
empty index. Columns other than id and text are not read.
"""

from __future__ import annotations

import struct
import uuid

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scanyard.llm.common import keep, open_folder, pairs
from scanyard.llm.tokens import END, encoder, small, vocabulary_path
from scanyard.session import shared_dir

# Fixed values of the seekable format: magic of the skippable frame and of its footer, and the
# descriptor bit that says checksums follow.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
CHECKSUMS = 0x80
_ENTRY = np.dtype([("packed", "<u4"), ("size", "<u4"), ("checksum", "<u4")])
_FOOTER = struct.Struct("<IBI")
LEVEL = 3


def checksum(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


def seek_table(entries: list[tuple[int, int, int]]) -> bytes:
    body = np.array(entries, _ENTRY).tobytes() + _FOOTER.pack(len(entries), CHECKSUMS, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(file) -> np.ndarray:
    """The entries of an open file, with the place of each frame in the file."""
    size = file.size()
    file.seek(size - _FOOTER.size)
    count, descriptor, magic = _FOOTER.unpack(file.read(_FOOTER.size))
    if magic != SEEKABLE or descriptor != CHECKSUMS:
        raise ValueError("no seek table with checksums at the end of the file")
    length = count * _ENTRY.itemsize
    file.seek(size - _FOOTER.size - length)
    entries = np.frombuffer(file.read(length), _ENTRY)
    ends = np.cumsum(entries["packed"].astype(np.int64))
    return entries, ends - entries["packed"]


_INDEX = "id {id}, part int, file string, frame long, start_in_file long, n_tokens long"


def write(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text",
          vocabulary: str | None = None) -> DataFrame:
    """Write the files under ``folder``; returns the index: id, file, frame, start, n_tokens."""
    given = pairs(docs, id_col, text_col).repartitionByRange("id").sortWithinPartitions(
        "id", "body")
    schema = _INDEX.format(id=given.schema["id"].dataType.simpleString())
    path = vocabulary or vocabulary_path()

    def run(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        store, base = open_folder(folder)
        name = f"tokens-{part:06d}-{uuid.uuid4().hex}.zst"
        encode, packer, out = encoder(path).encode, zstandard.ZstdCompressor(level=LEVEL), None
        entries, total = [], 0
        for batch in small(batches):
            if out is None:
                store.create_dir(base, recursive=True)
                out = store.open_output_stream(f"{base}/{name}", compression=None)
            first, starts = len(entries), []
            texts = [b.decode("utf-8", "replace") for b in batch.column("body").to_pylist()]
            for ids in encode(texts):
                data = np.append(ids, np.uint32(END)).astype("<u4").tobytes()
                frame = packer.compress(data)
                out.write(frame)
                entries.append((len(frame), len(data), checksum(data)))
                starts.append(total)
                total += len(data) // 4
            rows = len(starts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([part] * rows, pa.int32()), pa.array([name] * rows),
                 pa.array(range(first, first + rows), pa.int64()), pa.array(starts, pa.int64()),
                 pa.array((e[1] // 4 for e in entries[first:]), pa.int64())],
                ["id", "part", "file", "frame", "start_in_file", "n_tokens"])
        if out is not None:
            out.write(seek_table(entries))
            out.close()

    index = keep(given.mapInArrow(run, schema), "index")
    # One row per file: ids of all files before it.
    sizes = index.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    return index.join(bases, "part").select(
        "id", "file", "frame", (F.col("base") + F.col("start_in_file")).alias("start"), "n_tokens")


def read(index: DataFrame, folder: str) -> DataFrame:
    """The documents of some rows of the index: id, start and their ids as little-endian uint32.

    Only their frames are read and decompressed, each against its checksum.
    """
    schema = f"id {index.schema['id'].dataType.simpleString()}, start long, ids binary"
    files = max(1, index.select("file").distinct().count())
    ordered = index.select("id", "start", "file", "frame").repartition(
        files, "file").sortWithinPartitions("file", "frame")

    def run(batches):
        store, base = open_folder(folder)
        unpack, name, file = zstandard.ZstdDecompressor(), None, None
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                some, out = batch.slice(at, 1000), []
                for wanted, frame in zip(some.column("file").to_pylist(),
                                         some.column("frame").to_pylist()):
                    if wanted != name:
                        name, file = wanted, store.open_input_file(f"{base}/{wanted}")
                        entries, places = read_seek_table(file)
                    entry = entries[frame]
                    file.seek(int(places[frame]))
                    data = unpack.decompress(file.read(int(entry["packed"])),
                                             max_output_size=int(entry["size"]))
                    if len(data) != entry["size"] or checksum(data) != entry["checksum"]:
                        raise ValueError(f"frame {frame} of {name} is damaged")
                    out.append(data)
                yield pa.RecordBatch.from_arrays(
                    [some.column("id"), some.column("start"), pa.array(out, pa.binary())],
                    ["id", "start", "ids"])

    return ordered.mapInArrow(run, schema)


def new_folder(docs: DataFrame) -> str:
    return f"{shared_dir(docs.sparkSession)}/tokens"
