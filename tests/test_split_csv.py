"""Files with line breaks in quoted fields, cut into byte ranges, against Spark's reader for whole files."""

import random

import pytest
from pyspark.errors import PySparkException

from ripecast.sources import deliveries, split_csv

COLUMNS = "id name note"
VALUES = ["", "plain", "two\nlines", 'a "quoted" word', "comma, here", "\n\n", "ends\n", '"', '""', "ünïcode\nß", "a\r\nb", "x" * 90, None]


def field(v):
    if v is None:
        return ""
    return '"' + v.replace('"', '""') + '"' if v == "" or any(c in v for c in '",\n\r') else v


def write(path, rows, end="\n", tail=True):
    text = end.join([COLUMNS.replace(" ", ","), *[",".join(field(v) for v in r) for r in rows]]) + (end if tail else "")
    path.write_bytes(text.encode())


def made(seed, n):
    rng = random.Random(seed)
    return [(f"{seed}-{i}", rng.choice(VALUES), rng.choice(VALUES)) for i in range(n)]


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def ranges(spark):
    """Cut files every so many bytes."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def cut(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield cut
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_equals_the_whole_file_reader(spark, tmp_path, ranges, end):
    for k in range(3):
        # line breaks in fields stay as they are, where the other reader rewrites them to those it takes records to end by
        rows = [tuple(v and v.replace("\r\n", "\n") for v in r) for r in made(k, 12 * (k + 1))] if end == "\r\n" else made(k, 12 * (k + 1))
        write(tmp_path / f"{k}.csv", rows, end, tail=k != 1)
    expected = content(deliveries.read_csv(spark, str(tmp_path), columns=COLUMNS, multi_line=True))
    assert len(expected) == 72
    for n in (17, 64, 333, 100_000):
        ranges(n)
        assert content(deliveries.read_csv(spark, str(tmp_path), columns=COLUMNS, multi_line="split")) == expected


def test_cut_at_every_offset(spark, tmp_path, ranges):
    """Two ranges, the second one beginning at each byte of the file."""
    rows = [("1", "a\nb", 'c "d"\n'), ("2", "", None), ("3", "\n", "e,f"), ("4", '"', "g")]
    path = tmp_path / "f.csv"
    write(path, rows)
    expected = content(deliveries.read_csv(spark, str(path), columns=COLUMNS, multi_line=True))
    size = path.stat().st_size
    for n in range(size // 2 + 1, size):
        ranges(n)
        assert content(deliveries.read_csv(spark, str(path), columns=COLUMNS, multi_line="split")) == expected, n


def test_a_field_over_many_ranges(spark, tmp_path, ranges):
    long = "line\n" * 60
    write(tmp_path / "f.csv", [("1", "a", "b"), ("2", long, long), ("3", "c", "d")])
    ranges(40)
    got = deliveries.read_csv(spark, str(tmp_path / "f.csv"), columns=COLUMNS, multi_line="split")
    assert content(got) == [("1", "a", "b"), ("2", long, long), ("3", "c", "d")]
    assert spark.read.text(str(tmp_path / "f.csv")).rdd.getNumPartitions() > 4


def test_line_breaks_stay_as_they_are(spark, tmp_path):
    write(tmp_path / "f.csv", [("1", "a\r\nb", "c\nd")], "\r\n")
    assert content(deliveries.read_csv(spark, str(tmp_path / "f.csv"), columns=COLUMNS, multi_line="split")) == [("1", "a\r\nb", "c\nd")]


def test_empty_lines_headers_and_errors(spark, tmp_path, ranges):
    ranges(20)
    (tmp_path / "lines.csv").write_text('id,name,note\n\n1,a,b\n\n\n2,"c\n\nd",e\n\n')
    read = lambda name, **more: deliveries.read_csv(spark, str(tmp_path / name), multi_line="split", **more)
    assert content(read("lines.csv", columns=COLUMNS)) == [("1", "a", "b"), ("2", "c\n\nd", "e")]
    assert read("lines.csv").columns == COLUMNS.split()
    (tmp_path / "header.csv").write_text("id,name,note\n")
    (tmp_path / "none.csv").write_text("")
    assert content(read("header.csv", columns=COLUMNS)) == [] and content(read("none.csv", columns=COLUMNS)) == []
    (tmp_path / "other.csv").write_text("id,note,name\n1,2,3\n")
    with pytest.raises(PySparkException, match="unexpected header"):
        read("other.csv", columns=COLUMNS).collect()
    (tmp_path / "open.csv").write_text('id,name,note\n1,"a,b\n2,c,d\n')
    with pytest.raises(PySparkException, match="inside a quoted field"):
        read("open.csv", columns=COLUMNS).collect()


def test_lines_of_a_range_are_not_shuffled(spark, tmp_path):
    write(tmp_path / "f.csv", made(7, 3))
    records = split_csv.records(spark, [str(tmp_path / "f.csv")])
    plan = records._jdf.queryExecution().optimizedPlan()
    sorted_, todo = [], [plan]
    while todo:
        node = todo.pop()
        if node.nodeName() == "Window":
            sorted_.append(node.output().toString())
        todo += [node.children().apply(k) for k in range(node.children().size())]
    # windows order ranges and the pieces at their edges, never lines
    assert sorted_ and not any("_line" in columns for columns in sorted_)
