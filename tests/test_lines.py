"""Files cut into many splits: bytes, hashes and quoted records are those of the whole file."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from wayfuse.sources import files as FL
from wayfuse.sources import lines as LN
from wayfuse.sources import text as TX


@pytest.fixture(params=["300", "100m"])
def cuts(spark, request):
    """The size of a split."""
    keys = {"spark.sql.files.maxPartitionBytes": request.param, "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield request.param
    for k, v in before.items():
        spark.conf.set(k, v)


def tree(content, chunk, fan):
    """The hash of a content by hand."""
    nodes = [hashlib.sha256(content[i:i + chunk]).hexdigest() for i in range(0, len(content), chunk)] or [hashlib.sha256(b"").hexdigest()]
    while len(nodes) > 1:
        nodes = [hashlib.sha256("".join(nodes[i:i + fan]).encode()).hexdigest() for i in range(0, len(nodes), fan)]
    return nodes[0]


def contents():
    rng = random.Random(7)
    lines = b"".join(bytes(rng.randrange(256) for _ in range(rng.randrange(0, 60))) + rng.choice([b"\n", b"\r\n", b"\n\n"]) for _ in range(60))
    return {"plain.csv": b"a,b\n1,2\n", "open.csv": b"a,b\n1,2", "empty.csv": b"", "feed.csv": b"\n", "feeds.csv": b"\n\n\n",
            "mark.csv": b"\xef\xbb\xbfa,b\r\n1,2\r\n", "mark_open.csv": b"\xef\xbb\xbfa,b", "only_mark.csv": b"\xef\xbb\xbf",
            "bytes.bin": lines, "bytes_open.bin": lines + b"end", "one_line.txt": b"x" * 5000, "odd.gz": None}


def test_hash_of_files_of_any_cut(spark, tmp_path, cuts):
    import gzip
    held = contents()
    held["odd.gz"] = gzip.compress(b"packed\n" * 50, mtime=0)
    for name, content in held.items():
        (tmp_path / name).write_bytes(content)
    for chunk, fan in ((64, 3), (1 << 20, 1024)):
        pieces = LN.byte_pieces(spark, str(tmp_path)).select(FL.file_name(F.col("path")).alias("name"), "start", "content")
        got = {r.name: r.sha256 for r in FL.content_hash(pieces, ["name"], chunk, fan).collect()}
        assert got == {n: tree(c, chunk, fan) for n, c in held.items() if c}, chunk
    rows = {r.name: r for r in FL.fingerprints(spark, str(tmp_path)).collect()}
    assert {n: r.sha256 for n, r in rows.items()} == {n: hashlib.sha256(c).hexdigest() for n, c in held.items() if c}
    assert {n: r.size_bytes for n, r in rows.items()} == {n: len(c) for n, c in held.items() if c}  # an empty file is not listed


def test_parts_may_be_cut_anywhere_but_not_swapped(spark, tmp_path):
    rng = random.Random(8)
    content = bytes(rng.randrange(10, 14) for _ in range(3000))

    def file(folder, *cuts):
        place = tmp_path / folder / "file=a.csv"
        place.mkdir(parents=True)
        for i, (a, b) in enumerate(zip((0, *cuts), (*cuts, len(content)))):
            (place / f"part-{i:05d}.csv").write_bytes(content[a:b])
        return FL.fingerprints(spark, str(tmp_path / folder), 256).first().sha256
    assert file("one") == file("two", 1234) == file("three", 1, 1, 2999) == tree(content, 256, 1024)
    place = tmp_path / "swapped" / "file=a.csv"
    place.mkdir(parents=True)
    (place / "part-00000.csv").write_bytes(content[1234:])
    (place / "part-00001.csv").write_bytes(content[:1234])
    assert FL.fingerprints(spark, str(tmp_path / "swapped"), 256).first().sha256 != tree(content, 256, 1024)


def quoted(rng):
    """A CSV text with line ends, quotes, commas and blanks inside its cells."""
    def cell():
        text = "".join(rng.choice(["a", "é", '"', "\n", ",", " ", "NA", "x\r\ny"]) for _ in range(rng.randrange(0, 9)))
        plain = not any(c in text for c in '",\n\r') and text == text.strip()
        return text if plain and rng.random() < 0.7 else '"' + text.replace('"', '""') + '"'
    end = rng.choice(["\n", "\r\n"])
    rows = [",".join(["one", '"t,wo"', "three"])] + [",".join(["k" + str(i), cell(), cell()]) for i in range(60)]
    return end.join(rows) + rng.choice(["", end, end + end])


@pytest.mark.parametrize("seed", [1, 2])
def test_quoted_line_ends_over_splits(spark, tmp_path, cuts, seed):
    (tmp_path / "a.csv").write_bytes(quoted(random.Random(seed)).encode())
    whole = (spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"')
             .option("nullValue", "").option("emptyValue", "").csv(str(tmp_path)))
    got = TX.read_csv_text(spark, str(tmp_path), multi_line=True)
    assert got.columns == whole.columns == ["one", "t,wo", "three"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)
    if cuts == "300":
        assert LN.numbered_lines(spark, str(tmp_path)).select("split").distinct().count() > 1
    known = FL.csv_sanity(spark, str(tmp_path), multi_line=True).first()
    assert (known.status, known.header_columns, known.row_count) == ("ok", 3, 60)


def test_header_that_differs_fails(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n1,"2\n3"\n')
    assert TX.read_csv_text(spark, str(tmp_path), ["x", "y"], multi_line=True).collect()[0] == ("1", "2\n3")
    with pytest.raises(Exception, match="header differs"):
        TX.read_csv_text(spark, str(tmp_path), ["x", "z"], multi_line=True).collect()


def test_union_of_quoted_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n1,"2\n3"\n')
    (tmp_path / "b.csv").write_text('y,z\n"4\n","5"\n')
    got = TX.read_csv_union(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], multi_line=True)
    assert sorted(map(tuple, got.collect()), key=str) == [("1", "2\n3", None), (None, "4\n", "5")]
