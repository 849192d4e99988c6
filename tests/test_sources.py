"""Write-and-read round trips for the file sources and sinks, in a fresh temporary folder."""

import os
import struct
import tempfile
import zlib

import numpy as np

from tessera.sources import files
from tessera.operators.images import parse_pixels


def _tmp():
    return tempfile.mkdtemp(prefix="tessera-src-")


def test_block_and_string_csv(spark):
    d = _tmp()
    p = os.path.join(d, "b.csv")
    with open(p, "w") as f:
        f.write("id_0,PM2.5,1,NR\nid_1,RAINFALL,2,3\n")
    df = files.read_block_csv(spark, p, ["id", "item", "hr_1", "hr_2"])
    assert [tuple(r) for r in df.orderBy("id").collect()] == [("id_0", "PM2.5", "1", "NR"), ("id_1", "RAINFALL", "2", "3")]
    p2 = os.path.join(d, "s.csv")
    with open(p2, "w") as f:
        f.write("age,workclass\n39, State-gov\n")
    r = files.read_string_csv(spark, p2).first()
    assert r["age"] == "39" and r["workclass"] == " State-gov"


def test_encoding_and_multichar_sep(spark):
    d = _tmp()
    p = os.path.join(d, "big5.csv")
    with open(p, "wb") as f:
        f.write("日期,測項\n2014/1/1,PM2.5\n".encode("big5"))
    r = files.read_table_csv(spark, p, "date string, item string", encoding="big5").first()
    assert r["date"] == "2014/1/1" and r["item"] == "PM2.5"
    p2 = os.path.join(d, "users.dat")
    with open(p2, "w") as f:
        f.write("1::F::1::10\n2::M::56::16\n")
    df = files.read_table_csv(spark, p2, "UserID int, Gender string, Age int, Occupation int", sep="::", header=False)
    assert [tuple(r) for r in df.orderBy("UserID").collect()] == [(1, "F", 1, 10), (2, "M", 56, 16)]


def test_text_readers(spark):
    d = _tmp()
    p = os.path.join(d, "lab.txt")
    with open(p, "w") as f:
        f.write("1 +++$+++ good movie , really\n0 +++$+++ bad\n")
    assert [tuple(r) for r in files.read_labeled_text(spark, p).orderBy("label").collect()] == [
        ("0", "bad"), ("1", "good movie , really")]
    p2 = os.path.join(d, "test.txt")
    with open(p2, "w") as f:
        f.write("id,text\n1,a,b,c\n2,plain\nA7,b\n")
    assert [tuple(r) for r in files.read_id_text(spark, p2).orderBy("id").collect()] == [(None, "b"), (1, "a,b,c"), (2, "plain")]
    p3 = os.path.join(d, "tok.txt")
    with open(p3, "w") as f:
        f.write("a b c\n\n")
    got = [r["tokens"] for r in files.read_tokens(spark, p3).collect()]
    assert ["a", "b", "c"] in got and [""] in got
    assert [r["text"] for r in files.read_lines(spark, p3).collect()] == ["a b c", ""]


def test_pixels(spark):
    df = spark.createDataFrame([("0 255 7 8",), ("1 2",)], "feature string")
    got = [r["pixels"] for r in parse_pixels(df, "feature", 4).collect()]
    assert got == [[0, 255, 7, 8], None]


def _png(path, w, h, rgb):
    raw = b"".join(b"\x00" + bytes(rgb) * w for _ in range(h))

    def chunk(t, data):
        return struct.pack(">I", len(data)) + t + data + struct.pack(">I", zlib.crc32(t + data) & 0xFFFFFFFF)

    with open(path, "wb") as f:
        f.write(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0))
                + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def test_image_dir(spark):
    d = _tmp()
    _png(os.path.join(d, "0.png"), 2, 2, (10, 20, 30))
    r = files.read_image_dir(spark, d).first()
    assert (r["height"], r["width"], r["channels"]) == (2, 2, 3)
    assert r["pixels"][:3] == [30, 20, 10]  # BGR


def test_sinks_and_params(spark):
    d = _tmp()
    df = spark.createDataFrame([(1, 0), (2, 1)], "id int, label int")
    files.write_predictions(df, os.path.join(d, "pred"), ["id", "label"])
    back = files.read_table_csv(spark, os.path.join(d, "pred"), "id int, label int")
    assert sorted(map(tuple, back.collect())) == [(1, 0), (2, 1)]
    t = files.checkpoint_table(df, os.path.join(d, "tbl"))
    assert t.count() == 2
    files.save_params(spark, os.path.join(d, "params"), "ridge", {"coef": np.array([1.0, 2.5]), "lam": 3.0})
    p = files.load_params(spark, os.path.join(d, "params"), "ridge")
    assert np.allclose(p["coef"], [1.0, 2.5]) and np.allclose(p["lam"], [3.0])


def test_any_encoding_in_a_plain_session(spark, tmp_path):
    assert spark.conf.get("spark.sql.legacy.javaCharsets", "false") == "false"
    rows = [("日期", "測項"), ("2014/1/1", '"PM2.5, 細"'), ("", ""), ("2014/1/2", "許功蓋")]
    for name in ("a.csv", "b.csv"):
        (tmp_path / name).write_bytes("\r\n".join(",".join(r) if any(r) else "" for r in rows).encode("big5"))
    got = files.read_string_csv(spark, str(tmp_path), encoding="big5")
    assert got.columns == ["日期", "測項"]
    assert sorted(map(tuple, got.collect())) == sorted([("2014/1/1", "PM2.5, 細"), ("2014/1/2", "許功蓋")] * 2)
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "x.dat").write_bytes("1::Ünïcode::2.5\n2::x::\n".encode("cp1252"))
    typed = files.read_table_csv(spark, str(tmp_path / "c"), "id int, t string, v double", sep="::", encoding="cp1252", header=False)
    assert sorted(map(tuple, typed.collect())) == [(1, "Ünïcode", 2.5), (2, "x", None)]
    block = files.read_block_csv(spark, str(tmp_path / "c"), ["all"], encoding="cp1252")
    assert block.columns == ["all"] and block.count() == 2
    bad = tmp_path / "bad.txt"
    bad.write_bytes(b"ok\n\xff\xff\n")
    assert [r["value"] for r in files.decoded_lines(spark, str(bad), "big5").collect()] == ["ok", "��"]


def test_images_are_widened_in_linear_time_and_broken_files_stay(spark, tmp_path):
    import time

    big = os.urandom(1 << 20)
    df = spark.createDataFrame([(1, bytearray(big)), (2, None), (3, bytearray(b""))], "id int, d binary")
    files.image_bytes_to_pixels(df, "d", "p").count()
    t = time.time()
    got = {r["id"]: r["n"] for r in files.image_bytes_to_pixels(df, "d", "p").selectExpr("id", "aggregate(p, 0L, (a, x) -> a + x) n").collect()}
    assert got == {1: sum(big), 2: None, 3: 0}
    assert time.time() - t < 5
    (tmp_path / "broken.png").write_bytes(b"no image")
    row = files.read_image_dir(spark, str(tmp_path)).first()
    assert row["origin"].endswith("broken.png") and row["error"] and row["pixels"] is None and row["height"] is None
