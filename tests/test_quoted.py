import random

import pytest
from pyspark.sql.types import StructType

from meterlark.sources import files
from meterlark.sources.quoted import read_quoted, records

SCHEMA = StructType().add("a", "string").add("b", "integer").add("c", "string")


def write(path, rows, end="\n"):
    def field(v):
        if v is None:
            return ""
        v = str(v)
        return '"' + v.replace('"', '""') + '"' if any(x in v for x in ',"\n\r') or v == "" else v

    path.write_bytes(("a,b,c" + end + "".join(",".join(map(field, r)) + end for r in rows)).encode())


def one_task(spark, path, options):
    return sorted(map(tuple, spark.read.schema(SCHEMA).options(**options, multiLine=True).csv(str(path)).collect()), key=repr)


def many(spark, path, options):
    return sorted(map(tuple, read_quoted(spark, str(path), SCHEMA, options).collect()), key=repr)


@pytest.fixture
def small_blocks(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


TEXTS = [None, "", "plain", " blanks ", "two\nlines", "a,b", 'say ""', '"', '"\n"', "\n\n", "x" * 400, ("long\n" * 300).strip(), "né,\n", "1,\"2\"\n3"]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_equals_one_task_per_file(spark, tmp_path, small_blocks, end):
    rng = random.Random(4)
    for k in range(3):
        write(tmp_path / f"{k}.csv", [(rng.choice(TEXTS), rng.randint(0, 99), rng.choice(TEXTS[2:])) for _ in range(60)], end)
    for options in (files.CSV_OPTIONS, {**files.CSV_OPTIONS, "nullValue": "\0"}):
        want = one_task(spark, tmp_path, options)
        assert len(want) == 180
        assert many(spark, tmp_path, options) == want
    assert records(spark, str(tmp_path)).select("block").distinct().count() > 10


def test_one_record_over_many_blocks_and_header_with_breaks(spark, tmp_path, small_blocks):
    (tmp_path / "x.csv").write_text('"a\n' + "h" * 700 + '",b,c\n"' + "q\n" * 900 + '",1,z\nlast,2,"y"')
    assert many(spark, tmp_path, files.CSV_OPTIONS) == sorted([("q\n" * 900, 1, "z"), ("last", 2, "y")], key=repr)


def test_header_only_empty_files_and_errors(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b,c\n")
    (tmp_path / "y.csv").write_text("")
    assert many(spark, tmp_path, files.CSV_OPTIONS) == []
    (tmp_path / "z.csv").write_text('a,b,c\n5" pipe,1,x\nother 6" pipe,2,y\n')
    with pytest.raises(Exception, match="inside an unquoted text"):
        many(spark, tmp_path, files.CSV_OPTIONS)


def test_headers_are_checked(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b,wrong\n1,2,3\n")
    with pytest.raises(ValueError, match="wrong"):
        read_quoted(spark, str(tmp_path), SCHEMA, files.CSV_OPTIONS, check_header=True)
