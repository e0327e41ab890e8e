"""Sources and sinks: listings, text with encodings, WAV, embedding stores, manifests, provider-backed codecs."""

from __future__ import annotations

import io
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxloom.functions import text as X

# Fixed values.
ENCODINGS = ("utf-8-sig", "utf-8", "cp949", "euc-kr", "utf-16", "utf-16-le", "utf-16-be")
MANIFEST = T.StructType([T.StructField(c, T.StringType()) for c in ("filename", "index", "timestamp_start", "timestamp_end", "transcript")])
CLUSTERS = T.StructType([*MANIFEST.fields, T.StructField("cluster_dir", T.StringType())])


def listing(spark: SparkSession, path: str, recursive: bool = False, glob: str | None = None) -> DataFrame:
    """(path, name, folder, mtime, length) of files; their content is not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    files = (reader.option("pathGlobFilter", glob) if glob else reader).load(path)
    return files.select("path", X.file_name(F.col("path")).alias("name"), F.regexp_extract("path", r"([^/]*)/[^/]*$", 1).alias("folder"), F.col("modificationTime").alias("mtime"), "length")


def count_by_extension(files: DataFrame, extensions: tuple[str, ...]) -> DataFrame:
    return files.where(X.extension(F.col("name")).isin(*extensions)).agg(F.count(F.lit(1)).alias("n"))


def cluster_scan(spark: SparkSession, path: str) -> DataFrame:
    """(filename, cluster_dir, mtime) of the WAVs of a result folder's sub-folders."""
    wavs = listing(spark, path, recursive=True).where(F.lower("name").endswith(".wav"))
    return wavs.select(F.col("name").alias("filename"), F.col("folder").alias("cluster_dir"), F.coalesce(F.col("mtime").cast("double"), F.lit(0.0)).alias("mtime"))


def decode_text(content: bytes | None, encodings: tuple[str, ...] = ENCODINGS) -> str | None:
    """The first encoding that fits, UTF-8 with replacements if none does."""
    if content is None:
        return None
    for encoding in encodings:
        try:
            return content.decode(encoding)
        except UnicodeDecodeError:
            continue
    return content.decode("utf-8", errors="replace")


def read_texts(spark: SparkSession, path: str, encodings: tuple[str, ...] = ENCODINGS) -> DataFrame:
    """(path, name, text) of files in any of the encodings."""

    @F.pandas_udf("string")
    def decode(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield part.map(lambda b: decode_text(b, encodings))

    files = spark.read.format("binaryFile").load(path)
    return files.select("path", X.file_name(F.col("path")).alias("name"), decode("content").alias("text"))


def parse_wav(content: bytes) -> tuple[int, np.ndarray]:
    """(rate, samples by channel as float32) of PCM of 8 to 32 bits or IEEE floats."""
    if content[:4] != b"RIFF" or content[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, form, data = 12, None, b""
    while at + 8 <= len(content):
        name, size = content[at : at + 4], struct.unpack("<I", content[at + 4 : at + 8])[0]
        body = content[at + 8 : at + 8 + size]
        if name == b"fmt ":
            kind, channels, rate, _, _, bits = struct.unpack("<HHIIHH", body[:16])
            form = (struct.unpack("<H", body[24:26])[0] if kind == 0xFFFE else kind, channels, rate, bits)
        elif name == b"data":
            data = body
        at += 8 + size + size % 2
    if form is None:
        raise ValueError("no format chunk")
    kind, channels, rate, bits = form
    data = data[: len(data) // (channels * bits // 8) * (channels * bits // 8)]
    if kind == 3:
        x = np.frombuffer(data, f"<f{bits // 8}").astype(np.float32)
    elif bits == 8:
        x = (np.frombuffer(data, np.uint8).astype(np.float32) - 128) / 128
    elif bits == 24:
        raw = np.frombuffer(data, np.uint8).reshape(-1, 3).astype(np.int32)
        x = (((raw[:, 0] | raw[:, 1] << 8 | raw[:, 2] << 16) << 8 >> 8) / float(1 << 23)).astype(np.float32)
    else:
        x = np.frombuffer(data, f"<i{bits // 8}").astype(np.float32) / float(1 << (bits - 1))
    return rate, x.reshape(-1, channels).T


def write_wav(rate: int, channels: np.ndarray) -> bytes:
    """A WAV file of 32-bit floats."""
    data = np.ascontiguousarray(np.atleast_2d(channels).T, "<f4").tobytes()
    n = np.atleast_2d(channels).shape[0]
    head = b"fmt " + struct.pack("<IHHIIHH", 16, 3, n, rate, rate * n * 4, n * 4, 32)
    return b"RIFF" + struct.pack("<I", 4 + len(head) + 8 + len(data)) + b"WAVE" + head + b"data" + struct.pack("<I", len(data)) + data


def read_wavs(spark: SparkSession, path: str, chunk: int = 1 << 20, mono: bool = True) -> DataFrame:
    """Chunk table (name, sample_rate, channel, chunk_no, start_sample, samples); unreadable files give one row with a reason."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    rate, x = parse_wav(content)
                except (ValueError, struct.error) as e:
                    yield pd.DataFrame([(name, 0, 0, 0, 0, None, str(e))], columns=columns)
                    continue
                x = x.mean(axis=0, keepdims=True) if mono else x
                rows = [(name, rate, c, i // chunk, i, x[c, i : i + chunk], "") for c in range(len(x)) for i in range(0, x.shape[1], chunk)]
                yield pd.DataFrame(rows, columns=columns)

    columns = ["path", "sample_rate", "channel", "chunk_no", "start_sample", "samples", "reason"]
    chunks = files.select("path", "content").mapInPandas(run, "path string, sample_rate int, channel int, chunk_no int, start_sample long, samples array<float>, reason string")
    return chunks.withColumn("name", X.file_name(F.col("path")))


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """(filename, embedding) of NPZ stores with arrays filenames and embeddings; a store of another shape gives no rows, blank names and zero vectors go."""
    files = spark.read.format("binaryFile").load(path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                with np.load(io.BytesIO(content), allow_pickle=False) as store:
                    if not {"filenames", "embeddings"} <= set(store.files):
                        continue
                    names, x = store["filenames"].astype(str), store["embeddings"]
                    if x.ndim != 2 or len(x) != len(names):
                        continue
                    keep = np.array([bool(n.strip()) for n in names], bool) & (np.linalg.norm(x, axis=1) > 1e-12)
                    yield pd.DataFrame({"filename": [n.strip() for n in names[keep]], "embedding": list(x[keep].astype(np.float32))})

    return files.select("content").mapInPandas(run, "filename string, embedding array<float>")


def store_path(path: str, kind: str) -> str:
    """Where the store of a manifest, a WAV folder or a result folder lies."""
    parent = path.rstrip("/").rpartition("/")[0]
    return {"manifest": f"{parent}/embeddings.npz", "wav": f"{path.rstrip('/')}/embeddings.npz", "result": f"{parent}/embeddings.npz"}[kind]


def read_manifest(spark: SparkSession, *paths: str) -> DataFrame:
    """Manifest rows by column name, as strings, each with its row number and the number of its file; unknown columns stay."""
    parts = []
    for i, path in enumerate(paths):
        rows = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').csv(path)
        for name in MANIFEST.names:
            if name not in rows.columns:
                rows = rows.withColumn(name, F.lit("").cast("string"))
        parts.append(rows.na.fill("").withColumn("row_no", F.monotonically_increasing_id()).withColumn("source_no", F.lit(i)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def write_manifest(manifest: DataFrame, path: str, ordered: bool = True) -> None:
    """CSV with a header, nulls as empty strings."""
    rows = manifest.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in manifest.columns])
    rows = rows.orderBy("filename") if ordered else rows
    rows.write.option("header", "true").option("emptyValue", "").option("escape", '"').mode("overwrite").csv(path)


Codec = Callable[[bytes, str], bytes]


def transcode(files: DataFrame, codec: Codec, suffix: str) -> DataFrame:
    """(name, output, content, status) of files (name, content) through a codec provider; a failure is a status, not the end."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, content in zip(batch["name"], batch["content"], strict=True):
                try:
                    rows.append((name, codec(content, name), "converted"))
                except Exception as e:  # a provider may raise anything; the row says so
                    rows.append((name, None, f"failed: {e}"))
            yield pd.DataFrame(rows, columns=["name", "content", "status"])

    return files.select("name", "content").mapInPandas(run, "name string, content binary, status string").withColumn("output", F.concat(X.stem(F.col("name")), F.lit(suffix)))


def transcode_summary(done: DataFrame) -> DataFrame:
    return done.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("status") == "converted").alias("converted"), F.count_if(F.col("status").startswith("failed")).alias("failed"), F.array_sort(F.collect_list(F.when(F.col("status").startswith("failed"), F.col("name")))).alias("failed_names")
    )
