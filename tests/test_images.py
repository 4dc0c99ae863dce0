import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowline.operators import features as FE
from flowline.sources import files as FS

# fixed values for the fixtures: class -> (r, g, b) fill
CLASSES = {"reds": (250, 10, 10), "greens": (10, 250, 10), "blues": (10, 10, 250)}


def _write_jpeg(spark, path, w, h, pixel, gray=False):
    jvm = spark._jvm
    jvm.java.lang.System.setProperty("java.awt.headless", "true")
    BI = jvm.java.awt.image.BufferedImage
    img = BI(w, h, BI.TYPE_BYTE_GRAY if gray else BI.TYPE_INT_RGB)
    for y in range(h):
        for x in range(w):
            r, g, b = pixel(x, y)
            img.setRGB(x, y, (r << 16) | (g << 8) | b)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    assert jvm.javax.imageio.ImageIO.write(img, "jpg", jvm.java.io.File(path))


@pytest.fixture(scope="module")
def image_dir(spark):
    import tempfile
    root = os.path.join(tempfile.mkdtemp(prefix="flowline-img-"), "img")
    for cls, rgb in CLASSES.items():
        for k in range(4):
            w, h = (16, 12) if k % 2 else (12, 12)           # non-square too
            _write_jpeg(spark, f"{root}/{cls}/{k}.jpg", w, h,
                        lambda x, y, rgb=rgb, k=k: tuple(max(0, min(255, c - 3 * k)) for c in rgb))
    _write_jpeg(spark, f"{root}/reds/gray.jpg", 8, 8, lambda x, y: (128, 128, 128), gray=True)
    with open(f"{root}/greens/bad.jpg", "wb") as fh:
        fh.write(b"not a jpeg at all")
    with open(f"{root}/blues/notes.txt", "w") as fh:
        fh.write("text")
    return root


def test_binary_scan_glob_and_recursion(spark, image_dir):
    b = FS.binary_files(spark, image_dir, glob="*.jpg")
    paths = [r.path for r in b.select("path").collect()]
    assert len(paths) == 14 and not any(p.endswith(".txt") for p in paths)
    assert set(b.columns) == {"path", "modificationTime", "length", "content"}


def test_decode_drops_invalid_and_join(spark, image_dir):
    raw = FS.binary_files(spark, image_dir, glob="*.jpg")
    imgs = FS.image_files(spark, image_dir, glob="*.jpg")
    assert imgs.count() == 13
    bad = [r.path for r in FS.undecodable(raw, imgs).collect()]
    assert len(bad) == 1 and bad[0].endswith("greens/bad.jpg")
    assert FS.with_decoded(raw.select("path", "length"), imgs).count() == 13


def test_channel_order_and_gray(spark, image_dir):
    imgs = FS.image_files(spark, image_dir, glob="*.jpg").collect()
    for r in imgs:
        rgb = FE.to_rgb(bytes(r.data), r.height, r.width, r.nChannels)
        assert rgb.shape == (r.height, r.width, 3)
        mean = rgb.reshape(-1, 3).mean(axis=0)
        cls = r.path.split("/")[-2]
        if r.path.endswith("gray.jpg"):
            assert r.nChannels == 1 and np.allclose(mean, mean[0])
        else:
            assert int(np.argmax(mean)) == int(np.argmax(CLASSES[cls]))   # RGB, not BGR


def test_resize_and_featurise(spark, image_dir):
    x = np.arange(12 * 16 * 3, dtype=np.float64).reshape(12, 16, 3)
    y = FE.resize_bilinear(x, 24, 32)
    assert y.shape == (24, 32, 3) and y.min() >= x.min() and y.max() <= x.max()
    assert FE.resize_bilinear(x, 12, 16).tolist() == x.tolist()
    imgs = FS.image_files(spark, image_dir, glob="*.jpg")
    f = FE.featurise(imgs, height=10, width=14, grid=2).collect()
    assert len(f) == 13 and all(len(r.features) == 12 for r in f)
    assert all(-1.0 <= v <= 1.0 for r in f for v in r.features)


def test_ingest_train_score_images(spark, image_dir, tmp_dir):
    from flowline.operators import trainer as TR
    from flowline.plans.pipelines import train_on_images
    from flowline.sources.tables import drop_database
    db = "flowline_img_test"
    from flowline.sources.tables import create_database
    drop_database(spark, db, cascade=True)
    create_database(spark, db, f"{tmp_dir}/wh")
    # batch 8 per shard holds every training image (about 11 over 2 shards), so
    # no class is left out of the single full step per epoch
    cfg = TR.TrainConfig(epochs=30, batch_size=8, workers=2, learning_rate=0.1, dropout=0.0)
    from flowline.plans.pipelines import ingest_images
    prepared = ingest_images(spark, image_dir, db)
    fit, model, scored = train_on_images(spark, image_dir, db, cfg, height=8, width=8, grid=1,
                                         prepared=prepared)
    assert prepared.vocab.count() == 3            # still readable: not overwritten
    assert sorted(model.classes) == sorted(CLASSES)
    rows = scored.collect()
    assert len(rows) == 13                      # bad.jpg is not decodable
    acc = np.mean([r.label == r.prediction for r in rows])
    assert acc >= 0.8                           # colours are separable (the gray image may miss)
    bronze = spark.table(f"{db}.bronze")
    assert bronze.count() == 14
    # serving from files with the model's stored preprocessing reproduces the
    # pipeline's own predictions
    from flowline.plans.pipelines import score_images
    served = {r.path: (r.label, r.prediction) for r in score_images(spark, image_dir, model).collect()}
    norm = lambda p: p[len("file:"):] if p.startswith("file:") else p
    assert served == {norm(r.path): (r.label, r.prediction) for r in rows}
    drop_database(spark, db, cascade=True)


def test_bronze_is_uncompressed_and_cascade_is_explicit(spark, image_dir, tmp_dir):
    import glob
    import pyarrow.parquet as pq
    from flowline.sources import tables as TB
    db = "flowline_codec_test"
    TB.drop_database(spark, db, cascade=True)
    TB.create_database(spark, db, f"{tmp_dir}/wh2")
    raw = FS.binary_files(spark, image_dir, glob="*.jpg")
    TB.save_table(raw, f"{db}.bronze", compression="uncompressed", path=f"{tmp_dir}/bronze")
    files = glob.glob(f"{tmp_dir}/bronze/*.parquet")
    assert files
    md = pq.ParquetFile(files[0]).metadata
    assert md.row_group(0).column(0).compression == "UNCOMPRESSED"
    # the session codec was not changed
    assert spark.conf.get("spark.sql.parquet.compression.codec") != "uncompressed"
    with pytest.raises(Exception):
        TB.drop_database(spark, db)                  # not empty, no cascade asked
    TB.drop_database(spark, db, cascade=True)


def test_pluggable_extractor_in_sub_batches(spark, image_dir):
    seen = []

    def extractor(batch):
        seen.append(len(batch))
        return batch.reshape(len(batch), -1).mean(axis=1, keepdims=True)   # one feature per image

    imgs = FS.image_files(spark, image_dir, glob="*.jpg").coalesce(1)
    f = FE.featurise(imgs, height=6, width=6, extractor=extractor, sub_batch=4).collect()
    assert len(f) == 13 and all(len(r.features) == 1 for r in f)
    default = {r.path: r.features for r in FE.featurise(imgs, height=6, width=6, grid=1).collect()}
    for r in f:
        assert abs(r.features[0] - sum(default[r.path]) / 3) < 1e-5


def test_ingest_writes_bytes_once_and_matches_materialized(spark, image_dir, tmp_dir):
    from flowline.plans.pipelines import ingest_images
    from flowline.sources.tables import drop_database
    for db in ("flowline_views", "flowline_copies"):
        drop_database(spark, db, cascade=True)
    a = ingest_images(spark, image_dir, "flowline_views", location=f"{tmp_dir}/a")
    b = ingest_images(spark, image_dir, "flowline_copies", location=f"{tmp_dir}/b", materialize=True)
    key = lambda df: sorted((r.path, r.label, r.label_idx) for r in df.select("path", "label", "label_idx").collect())
    assert key(a.train) == key(b.train) and key(a.val) == key(b.val)
    assert a.num_classes == b.num_classes == 3
    assert spark.catalog.getTable("flowline_views.silver_val").tableType == "VIEW"
    plan = spark.table("flowline_views.silver_val")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan                       # reads only split=val
    for db in ("flowline_views", "flowline_copies"):
        drop_database(spark, db, cascade=True)


def test_cascade_drop_only_on_our_databases(spark, tmp_dir):
    from flowline.sources import tables as TB
    spark.sql(f"CREATE DATABASE IF NOT EXISTS flowline_foreign LOCATION '{tmp_dir}/foreign'")
    spark.range(3).write.option("path", f"{tmp_dir}/foreign_t").saveAsTable("flowline_foreign.t")
    with pytest.raises(PermissionError):
        TB.drop_database(spark, "flowline_foreign", cascade=True)
    assert spark.catalog.databaseExists("flowline_foreign")
    TB.drop_database(spark, "flowline_foreign", cascade=True, force=True)
    TB.create_database(spark, "flowline_ours", f"{tmp_dir}/ours")
    assert TB.created_by_us(spark, "flowline_ours")
    TB.drop_database(spark, "flowline_ours", cascade=True)
    assert not spark.catalog.databaseExists("flowline_ours")
