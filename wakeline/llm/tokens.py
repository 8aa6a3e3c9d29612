"""Token counts of flat, unindexed token files.

A flat file is token ids of one width end to end, each document closed by a separator id. Blocks of
the files are searched for the separator, each by a task that reads its own byte range. A prefix scan
over the block summaries (separators so far, place of the last one) then tells each block which
document its first tokens belong to and where that began, however many blocks it spans.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wakeline.sources.scratch import materialise, scratch_path

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How the vocabulary's texts are split before merging (a fixed value of that vocabulary).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BLOCK_BYTES = 8 << 20
#: A file is closed at the first document end beyond this size.
FILE_BYTES = 256 << 20
#: Characters that one encoder call takes; a longer text is cut before a letter that follows a space.
CALL_CHARS = 1 << 20
_SAFE_CUT = re.compile(r"(?<=[^\W\d_]) (?=[^\W\d_])")


def _open(path: str):
    """File system and path for a URI (file, hdfs, s3, ...) or a plain path."""
    from pyarrow import fs

    if not re.match(r"\w+:", path):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


def read_ranks(path: str) -> dict[bytes, int]:
    """Byte string -> id, from a rank file; the file is small and travels with the tasks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def pieces(text: str) -> Iterator[str]:
    """The text in pieces that encode as the whole does: cuts lie where the pattern always splits."""
    at = 0
    while len(text) - at > CALL_CHARS:
        cut = _SAFE_CUT.search(text, at + CALL_CHARS)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def write_flat(docs: DataFrame, folder: str, vocabulary: str = VOCABULARY, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Encodes every whole text into flat files below ``folder``, each text closed by the separator.

    Returns the stored manifest (file, ordinal, doc_id). Files carry no index. Each attempt of a
    task writes files of its own, and only those that the manifest names count. Null and empty
    texts are a separator alone; the separator's spelling inside a text is ordinary text.
    """
    ranks = read_ranks(vocabulary)
    eod = len(ranks)
    width = np.dtype("<u2" if eod < 1 << 16 else "<u4")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        encode = tiktoken.Encoding("flat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        system, root = _open(folder)
        system.create_dir(root, recursive=True)
        out, name, held, size = None, "", [], 0

        def manifest() -> Iterator[pa.RecordBatch]:
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(held)), pa.array(range(len(held)), pa.int64()), pa.array(held, pa.int64())],
                names=["file", "ordinal", "doc_id"],
            )

        for batch in batches:
            for doc, t in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                if out is None:
                    name, held, size = f"{uuid4().hex}.bin", [], 0
                    out = system.open_output_stream(f"{root}/{name}")
                for piece in pieces(t.as_py() or ""):
                    made = np.array(encode(piece), width).tobytes()
                    out.write(made)
                    size += len(made)
                out.write(np.array([eod], width).tobytes())
                held.append(doc)
                if size >= FILE_BYTES:
                    out.close()
                    yield from manifest()
                    out = None
        if out is not None:
            out.close()
            yield from manifest()

    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return materialise(slim.mapInArrow(rows, "file string, ordinal long, doc_id long"), "manifest")


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """path and bytes of the files in a folder; no content is read."""
    return spark.read.format("binaryFile").load(folder).select("path", F.col("length").alias("bytes"))


def _search(eod: int, width: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = np.dtype(width).itemsize
        for batch in batches:
            for path, block, begin, end, total in zip(*(batch.column(c).to_pylist() for c in ("path", "block", "begin", "end", "bytes"))):
                system, place = _open(path)
                with system.open_input_file(place) as file:
                    file.seek(begin)
                    ids = np.frombuffer(file.read(end - begin), width)
                found = np.flatnonzero(ids == eod) + begin // unit
                if end == total and len(ids) and ids[-1] != eod:
                    found = np.append(found, total // unit)  # a last document that nothing closes
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([path]),
                        pa.array([block], pa.int64()),
                        pa.array([len(found)], pa.int64()),
                        pa.array([found[-1] if len(found) else None], pa.int64()),
                        pa.array([found], pa.list_(pa.int64())),
                    ],
                    names=["path", "block", "n", "last", "ends"],
                )

    return rows


def count_tokens(files: DataFrame, eod: int, width: str = "<u2", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """path, ordinal, n_tokens of each document in flat files (path, bytes).

    Documents are numbered from 0 in each file; the separator is not counted. A file's last
    document need not be closed; an empty file has none. Blocks are dealt out singly, so one huge
    file is read by many tasks.
    """
    unit = np.dtype(width).itemsize
    step = max(unit, block_bytes // unit * unit)
    blocks = (
        files.where("bytes > 0")
        .select("path", "bytes", F.posexplode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(step).cast("long"))).alias("block", "begin"))
        .select("path", "bytes", F.col("block").cast("long").alias("block"), "begin", F.least(F.col("begin") + step, F.col("bytes")).alias("end"))
        .repartition("path", "block")
    )
    found = materialise(blocks.mapInArrow(_search(eod, width), "path string, block long, n long, last long, ends array<long>"), "separators")
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = found.select(
        "path",
        "block",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"),
        F.coalesce(F.max("last").over(earlier), F.lit(-1)).alias("before"),
    )
    each = found.where("n > 0").join(base, ["path", "block"]).select(
        "path", "first", F.posexplode(F.arrays_zip("ends", F.concat(F.array("before"), F.col("ends")).alias("starts"))).alias("i", "z")
    )
    return each.where(F.col("z.ends").isNotNull()).select(
        "path", (F.col("first") + F.col("i")).alias("ordinal"), (F.col("z.ends") - F.col("z.starts") - 1).alias("n_tokens")
    )


def document_tokens(
    docs: DataFrame,
    vocabulary: str = VOCABULARY,
    id_col: str = "doc_id",
    text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """doc_id, n_tokens for each row of ``docs``, counted in the flat files that its texts make.

    Null and empty texts have 0 tokens; repeated rows and null ids come back as often. Other columns
    are not read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "tokens")
    eod = len(read_ranks(vocabulary))
    manifest = write_flat(docs, folder, vocabulary, id_col, text)
    if manifest.isEmpty():
        return manifest.select("doc_id", F.lit(0).cast("long").alias("n_tokens"))
    named = manifest.select("file").distinct()
    files = list_files(spark, folder).withColumn("file", F.element_at(F.split("path", "/"), -1)).join(named, "file", "left_semi")
    counts = count_tokens(files, eod, "<u2" if eod < 1 << 16 else "<u4", block_bytes)
    return (
        counts.withColumn("file", F.element_at(F.split("path", "/"), -1))
        .join(manifest, ["file", "ordinal"])
        .select("doc_id", "n_tokens")
    )
