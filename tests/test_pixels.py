import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.functions import pixels as P
from tidemill.functions.hashing import keyed_md5
from tidemill.functions.vectors import argmax, cross_entropy

SHAPE = (3, 5, 4)
ROWS = 40


@pytest.fixture(scope="module")
def images():
    return np.random.default_rng(0).integers(0, 256, (ROWS, *SHAPE)).astype(float)


@pytest.fixture(scope="module")
def df(spark, images):
    rows = [(i, image.ravel().tolist()) for i, image in enumerate(images)]
    return spark.createDataFrame(rows, "id long, p array<double>").withColumn(
        "h", keyed_md5(1, F.col("id"))
    )


def run(df, change):
    rows = df.select("id", change.alias("out")).collect()
    return np.array([r["out"] for r in sorted(rows, key=lambda r: r["id"])]).reshape(ROWS, *SHAPE)


def digest(i):
    return hashlib.md5(f"1:{i}".encode()).hexdigest()


def cropped(image, i, pad):
    h = digest(i)
    down, right = (int(h[a : a + 8], 16) % (2 * pad + 1) for a in (0, 8))
    padded = np.pad(image, ((0, 0), (pad, pad), (pad, pad)))
    return padded[:, down : down + SHAPE[1], right : right + SHAPE[2]]


def mirrored(image, i):
    return image[:, :, ::-1] if int(digest(i)[16], 16) % 2 == 0 else image


@pytest.mark.parametrize("pad", [1, 2, 4])
def test_crop(df, images, pad):
    expected = np.array([cropped(image, i, pad) for i, image in enumerate(images)])
    assert np.array_equal(run(df, P.random_crop(F.col("p"), SHAPE, pad, F.col("h"))), expected)


def test_flip(df, images):
    assert np.array_equal(run(df, P.flip(F.col("p"), SHAPE)), images[:, :, :, ::-1])
    assert np.array_equal(run(df, P.flip(P.flip(F.col("p"), SHAPE), SHAPE)), images)
    expected = np.array([mirrored(image, i) for i, image in enumerate(images)])
    assert np.array_equal(run(df, P.random_flip(F.col("p"), SHAPE, F.col("h"))), expected)


def standard(images):
    mean = np.array([125.3, 123.0, 113.9])[:, None, None]
    std = np.array([63.0, 62.1, 66.7])[:, None, None]
    return (images / 255 - mean / 255) / (std / 255)


def test_whole_pipelines(df, images):
    train = np.array([mirrored(cropped(m, i, 4), i) for i, m in enumerate(images)])
    found = run(df, P.train_pixels(F.col("p"), SHAPE, F.col("h")))
    assert np.allclose(found, standard(train), atol=1e-12)
    assert np.allclose(run(df, P.eval_pixels(F.col("p"), SHAPE)), standard(images), atol=1e-12)


def test_images_are_worked_on_in_portions(df, images, monkeypatch):
    monkeypatch.setattr(P, "IMAGES_AT_ONCE", 7)
    one_batch = df.coalesce(1)
    train = np.array([mirrored(cropped(m, i, 2), i) for i, m in enumerate(images)])
    found = run(one_batch, P.train_pixels(F.col("p"), SHAPE, F.col("h"), pad=2))
    assert np.allclose(found, standard(train), atol=1e-12)


def test_an_absent_image_stays_absent(spark):
    df = spark.createDataFrame([(0, None), (1, [2.0] * 60)], "id long, p array<double>")
    rows = df.select("id", P.flip(F.col("p"), SHAPE).alias("out")).orderBy("id").collect()
    assert rows[0]["out"] is None and rows[1]["out"] == [2.0] * 60


def test_an_image_of_another_size_is_an_error(spark):
    df = spark.createDataFrame([(0, [2.0] * 59)], "id long, p array<double>")
    with pytest.raises(Exception, match="60 values"):
        df.select(P.flip(F.col("p"), SHAPE)).collect()


def test_scores(spark):
    rows = [([1.0, 3.0, 3.0], 1), ([1000.0, 0.0, -1000.0], 1), ([0.0, 0.0, 0.0], 2)]
    df = spark.createDataFrame(rows, "z array<double>, y int").coalesce(1)
    found = df.select(argmax(F.col("z")).alias("k"), cross_entropy(F.col("z"), F.col("y"))).collect()
    assert [r["k"] for r in found] == [1, 0, 0]
    z = np.array([r[0] for r in rows])
    z = z - z.max(axis=1, keepdims=True)
    expected = np.log(np.exp(z).sum(axis=1)) - z[range(3), [1, 1, 2]]
    assert np.allclose([r[1] for r in found], expected)
