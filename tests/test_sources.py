import gzip
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from tidemark.sources import detect, discover
from tidemark.sources.scan import CsvOptions, as_columns, concatenated, read_clean, resume, scan, unpack


def test_encodings():
    assert detect.detect_encoding(b"\xef\xbb\xbfa").name == "utf-8-sig"
    assert detect.detect_encoding(b"\xff\xfe\x00\x00a").name == "utf-32-le" and detect.detect_encoding(b"\xff\xfea\x00").name == "utf-16-le"
    assert detect.detect_encoding("zażółć gęślą".encode("cp1250")).name == "cp1250" and detect.detect_encoding("zażółć".encode()).name == "utf-8"
    assert detect.detect_encoding("abc".encode("utf-16-be")).name == "utf-16-be"
    with pytest.raises(detect.SourceError, match="undecodable-bytes"):
        detect.decode(b"\xff", "utf-8")


def test_dialect_header_footer():
    assert detect.detect_delimiter("a;b\n1;2,5\n") == ";" and detect.detect_delimiter("one\ntwo\n") == "" and detect.detect_delimiter("a,b", "|") == "|"
    with pytest.raises(detect.SourceError, match="declined"):
        detect.require_delimiter("")
    rows = [["report"], ["id", " name "], ["1", "a"], ["id", " name "], ["2", "b"], ["Total", "2"], ["end"]]
    head = detect.detect_header(rows, footer_patterns=["Total"])
    assert head.index == 1 and head.names == ("id", "name") and head.footer == (5, 6) and head.repeated == (3,)
    with pytest.raises(detect.SourceError, match="duplicate-header-names"):
        detect.detect_header([["Id", "ID"], ["1", "2"]])
    assert detect.detect_header([["a", "b"]]).index == 0


def test_types(spark):
    def guess(*values, f=()):
        row = detect.infer_types(spark.createDataFrame([(v,) for v in values], "v string"), ["v"], f).first()
        return row.suggested_type, () if row.red_flag is None else (row.red_flag,)

    assert guess() == ("string", ("empty-sample",)) and guess("0", "1") == ("integer", ()) and guess("yes", "0") == ("boolean", ())
    assert guess("007", "12") == ("string", ("leading-zero",)) and guess("1E5") == ("string", ("scientific-notation",)) and guess("1.5", "2") == ("decimal", ())
    assert guess("1", "x") == ("string", ("mixed-parseable",)) and guess("2024-01-02", f="yyyy-MM-dd") == ("date", ()) and guess("a") == ("string", ())
    assert guess("02.01.2024 10:00", f=("yyyy-MM-dd", "dd.MM.yyyy HH:mm")) == ("timestamp", ())


def test_code_pages_that_read_alike_or_not():
    name = lambda text, page: detect.detect_encoding(text.encode(page)).name
    assert name("España año", "cp1252") == "undetermined" and name("très élevé", "cp1252") == "undetermined"
    assert name("Müller größer", "cp1252") in ("cp1250", "cp1252") and detect.detect_encoding("Müller".encode("cp1252")).confidence == 1.0
    assert name("příliš žluťoučký kůň", "cp1250") == "cp1250"


def test_quotes_are_told():
    assert detect.detect_dialect("a,b\n1,'x,y'\n2,'z'\n") == detect.Dialect(",", "'")
    assert detect.detect_dialect('a,b\n1,"x,y"\n2,it\'s\n') == detect.Dialect(",", '"')
    assert detect.detect_dialect("a^b\n1^2\n").delimiter == "^" and detect.detect_dialect("it's\n'tis\n").delimiter == ""


def test_masks(spark):
    mask = detect.compile_mask("{dataset}_{day:%Y%m%d}[_{seq:03d}].csv")
    df = spark.createDataFrame([("orders_20240102.csv",), ("orders_20240102_007.csv",), ("orders_20241302.csv",), ("xorders_20240102.csv.gz",)], "name string")
    rows = df.select(*mask.columns(F.col("name")), mask.error(F.col("name")).alias("e")).collect()
    assert [(r.dataset, str(r.day), r.seq, r.e) for r in rows] == [("orders", "2024-01-02", None, None), ("orders", "2024-01-02", 7, None), ("orders", "None", None, None), (None, "None", None, "filename-does-not-match-mask")]
    plain = detect.compile_mask("v1.0 ({n:2d}) {t:%H-%M}.csv")
    row = spark.createDataFrame([("v1.0 (07) 10-59.csv",)], "name string").select(plain.error(F.col("name")).alias("e"), *plain.columns(F.col("name"))).first()
    assert row.e is None and row.n == 7
    for bad in ("[a[b]]", "a]", "[a", "{x:%q}", "{a}{a}", "{a", "a}", "{}", "{x:abc}", "{x:%B}"):
        with pytest.raises(ValueError):
            detect.compile_mask(bad)


def test_scan(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'\xef\xbb\xbfid,name\r\n1,"x\n""y"""\r\n\r\n2,b,c\r\n3,z\x00\r\n')
    (tmp_path / "b.csv.gz").write_bytes(gzip.compress(b"id,name\n4,q\n") + gzip.compress(b"5,r\n"))
    (tmp_path / "bad.csv").write_bytes(b"\xef\xbb\xbf")
    found = scan(spark, str(tmp_path), glob="*.csv*")
    rows = sorted((r.path.rsplit("/", 1)[1], r.ordinal, r.fields, r.error) for r in found.collect())
    assert rows == [
        ("a.csv", 0, ["id", "name"], None), ("a.csv", 1, ["1", 'x\n"y"'], None), ("a.csv", 2, [], "RAGGED_ROW"), ("a.csv", 3, ["2", "b", "c"], "RAGGED_ROW"), ("a.csv", 4, ["3", "z"], None),
        ("b.csv.gz", 0, ["id", "name"], None), ("b.csv.gz", 1, ["4", "q"], None), ("b.csv.gz", 2, ["5", "r"], None), ("bad.csv", -1, [], "empty-file"),
    ]
    assert sorted(r.name for r in as_columns(found, ["id", "name"]).collect()) == ["q", "r", 'x\n"y"', "z"]
    assert resume(found, 4).count() == 1


def test_archives():
    two = io.BytesIO()
    with zipfile.ZipFile(two, "w") as z:
        z.writestr("a", "1")
        z.writestr("b", "2")
    for name, raw, code in (("a.zip", two.getvalue(), "archive-member-count"), ("a.zip", b"no", "corrupted-archive"), ("a.gz", b"no", "corrupted-archive"), ("a.gz", gzip.compress(b"x" * 40)[:-9], "corrupted-archive"), ("a.gz", gzip.compress(b"x" * 100), "decompression-bomb-exceeded")):
        with pytest.raises(detect.SourceError, match=code):
            unpack(name, raw, 50)


def test_files_are_read_piece_by_piece(monkeypatch):
    import tidemark.sources.scan as m

    lines = ["id,name"] + [f'{k},"é {k}\n""x"""' for k in range(2000)] + ["x"]
    raw = "\r\n".join(lines).encode()
    want = list(m.records(lambda: m.unpacked("a.csv", raw), CsvOptions()))
    assert want[0] == (0, ["id", "name"], None) and want[2000] == (2000, ["1999", 'é 1999\n"x"'], None) and want[-1] == (2001, ["x"], "RAGGED_ROW")
    packed = gzip.compress(raw[:30_001]) + b"\0\0" + gzip.compress(raw[30_001:])
    zipped = io.BytesIO()
    with zipfile.ZipFile(zipped, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a.csv", raw)
    for piece in (1 << 20, 7, 1):
        monkeypatch.setattr(m, "PIECE", piece)
        for name, data in (("a.csv", raw), ("a.csv.gz", packed), ("a.csv.zip", zipped.getvalue())):
            assert list(m.records(lambda: m.unpacked(name, data), CsvOptions())) == want, (name, piece)
    late = raw + b"\n5,\xff\n"  # a bad byte far behind the sample: no record comes first
    assert [r[0] for r in m.records(lambda: m.unpacked("a.csv", late + raw * 3), CsvOptions(encoding="utf-8"))] == [-1]


def test_clean_reader_and_parts(spark, tmp_path):
    (tmp_path / "p.1.csv").write_text('id,name\n1,"a,b"\n2\n')
    (tmp_path / "p.2.csv").write_text("3,c\n")
    rows = read_clean(spark, str(tmp_path / "p.1.csv"), "id int, name string").collect()
    assert [(r.id, r.name, r._corrupt) for r in rows] == [(1, "a,b", None), (2, None, "2")]
    whole = concatenated(spark, [str(tmp_path / "p.1.csv"), str(tmp_path / "p.2.csv")], CsvOptions(delimiter=",")).collect()
    assert [(r.ordinal, r.fields) for r in whole] == [(0, ["id", "name"]), (1, ["1", "a,b"]), (2, ["2"]), (3, ["3", "c"])]


def test_discovery(spark, tmp_path):
    for name, data in (("a.csv", "1"), ("b.csv", "1"), ("c.txt", "2"), ("d.csv", ""), ("x.part1.csv", "3"), ("x.part2.csv", "4"), ("y.part1.csv", "5"), ("y.part3.csv", "6"), ("done.json", '{"expected_row_count": 7}')):
        (tmp_path / name).write_text(data)
    listing = discover.list_files(spark, str(tmp_path), content=True)
    gate = {r.name: r.reason for r in discover.integrity(listing).collect()}
    assert gate["a.csv"] is None and gate["c.txt"] == "unsupported-extension" and gate["d.csv"] == "empty-file"
    groups = {r.group: (len(r.parts), r.error) for r in discover.multipart(listing, r"^(.)\.part([0-9]+)\.csv$").collect()}
    assert groups == {"x": (2, None), "y": (2, "multipart-group-incomplete")}
    marks = spark.createDataFrame([("done.json", '{"expected_row_count": 7}'), ("bad.json", '{"expected_row_count": -1}')], "name string, text string")
    assert discover.marked(listing, marks, "done.json").count() == 8 and discover.marked(listing, marks, "bad.json").count() == 0
    files = discover.integrity(listing).select(F.lit(1).alias("dataset_id"), F.when(F.col("name") == "a.csv", 1).otherwise(2).alias("file_id"), "path", "content_sha256", "status")
    names = [r.path.rsplit("/", 1)[1] for r in discover.candidates(files, files.filter("false")).collect()]
    assert "b.csv" not in names and "a.csv" in names and len(discover.candidates(files, files.filter("false"), 2).collect()) == 2
    assert discover.stable(lambda: discover.list_files(spark, str(tmp_path)), 0.1).count() == 9
