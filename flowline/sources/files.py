"""File scans: raw bytes (``binaryFile``) and decoded images (``image``).

Decoding happens in the executors' JVM through Spark's image source (no
Python codec).  The image source reports ``origin`` as ``file:///...`` while
the binary source reports ``file:/...``; ``normalize_path`` makes them
joinable.  The image source stores pixels as BGR(A).
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def binary_files(spark: SparkSession, path: str, glob: str | None = "*.jpg",
                 recursive: bool = True) -> DataFrame:
    """One row per file: path, modificationTime, length, content.  The glob is
    applied at listing; recursive lookup turns partition discovery off."""
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    return r.load(path)


def image_files(spark: SparkSession, path: str, glob: str | None = "*.jpg",
                recursive: bool = True, drop_invalid: bool = True) -> DataFrame:
    """Decoded images, flattened: path, height, width, nChannels, mode, data
    (BGR bytes).  Undecodable files are dropped (``dropInvalid``)."""
    r = spark.read.format("image").option("dropInvalid", str(drop_invalid).lower())
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    df = r.load(path)
    return df.select(normalize_path(F.col("image.origin")).alias("path"),
                     "image.height", "image.width", "image.nChannels", "image.mode", "image.data")


def normalize_path(c: Column) -> Column:
    """``file:/x``, ``file:///x`` -> ``/x`` (other schemes untouched)."""
    return F.regexp_replace(c, r"^file:(//)?(?=/)", "")


def with_decoded(bronze: DataFrame, images: DataFrame) -> DataFrame:
    """File metadata joined to its decoded pixels on the normalised path.
    Both sides are one row per file, so this is a plain shuffle join on a
    unique key (no broadcast: image tables are large)."""
    b = bronze.withColumn("_npath", normalize_path(F.col("path")))
    i = images.withColumnRenamed("path", "_npath")
    return b.join(i, "_npath", "inner").drop("_npath")


def undecodable(bronze: DataFrame, images: DataFrame) -> DataFrame:
    """Files the decoder dropped (report)."""
    b = bronze.withColumn("_npath", normalize_path(F.col("path")))
    i = images.select(F.col("path").alias("_npath"))
    return b.join(i, "_npath", "left_anti").drop("_npath")


# ---------------------------------------------------------------- PNG writer
def png_bytes(rgb: np.ndarray) -> bytes:
    """Minimal lossless PNG (8-bit RGB, no filter) for an (h, w, 3) array."""
    h, w, _ = rgb.shape
    raw = b"".join(b"\x00" + rgb[y].astype(np.uint8).tobytes() for y in range(h))

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + \
            struct.pack(">I", zlib.crc32(kind + data) & 0xFFFFFFFF)

    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0))
            + chunk(b"IDAT", zlib.compress(raw, 6)) + chunk(b"IEND", b""))


def _filesystem(root: str):
    """(pyarrow filesystem, path) for a Spark-style URI: ``file:`` paths map to
    the local filesystem; other schemes (hdfs://, s3://, ...) resolve through
    pyarrow, so tasks write straight into the shared folder."""
    from pyarrow import fs as pafs
    if root.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + root[5:].lstrip("/")
    return pafs.FileSystem.from_uri(root)


def write_png_files(df: DataFrame, root: str, path_col: str, pixels_col: str,
                    height: int, width: int) -> DataFrame:
    """Each task writes the PNGs of its own rows under ``root`` (a shared
    folder); file names come from the data, so a retried task rewrites the
    same files; each file appears atomically (written aside, then renamed),
    so a speculative duplicate task cannot leave a torn file.  Returns
    (path, n_bytes) per file (lazy).  A ``root`` without a scheme means the
    default file system, as everywhere in Spark."""
    spark = df.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    root = folder.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(folder).toString()

    def write(batches):
        fs, base = _filesystem(root)
        made = set()
        for pdf in batches:
            out_p, out_n = [], []
            for rel, px in zip(pdf[path_col], pdf[pixels_col]):
                img = np.asarray(px, dtype=np.uint8).reshape(height, width, 3)
                full = f"{base.rstrip('/')}/{rel}"
                parent = full.rsplit("/", 1)[0]
                if parent not in made:
                    fs.create_dir(parent, recursive=True)
                    made.add(parent)
                data = png_bytes(img)
                tmp = f"{full}.{uuid.uuid4().hex}.part"
                with fs.open_output_stream(tmp) as fh:
                    fh.write(data)
                fs.move(tmp, full)
                out_p.append(full)
                out_n.append(len(data))
            yield pd.DataFrame({"path": out_p, "n_bytes": np.asarray(out_n, dtype=np.int64)})

    return df.select(path_col, pixels_col).mapInPandas(write, "path string, n_bytes bigint")
