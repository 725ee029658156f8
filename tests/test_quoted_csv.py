"""CSV with line breaks in quotes, split over many tasks, against one task per file."""

import csv
import random

import pytest

from subtide.schemas import RAW_SCHEMAS
from subtide.sources.raw_files import bronze_tables, read_csv

SCHEMA = RAW_SCHEMAS["support_cases"]


@pytest.fixture
def small_ranges(spark):
    """Byte ranges of a few hundred bytes."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def odd_rows(rng, n):
    parts = ["a", " ", ",", "\n", "\n\n", '"', '""', "é", "'", "x" * 30, "line\nbreak", '"q",\n"r"', "\\"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 6))) for _ in range(n)]
    return [(f"k{i}", "u", "2024-01-01 00:00:00", text, rng.choice(["resolved", "", " pending\n"])) for i, text in enumerate(texts)]


def write(path, rows, line_end="\n", bom=False, quoting=csv.QUOTE_MINIMAL):
    with open(path, "w", newline="", encoding="utf-8-sig" if bom else "utf-8") as f:
        writer = csv.writer(f, lineterminator=line_end, quoting=quoting)
        writer.writerow(SCHEMA.names)
        writer.writerows(rows)


def whole_files(spark, path):
    return spark.read.schema(SCHEMA).csv(path, header=True, multiLine=True, escape='"', mode="FAILFAST")


def as_set(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_equals_one_task_per_file(spark, tmp_path, small_ranges, seed):
    rng = random.Random(seed)
    rows = odd_rows(rng, 150)
    # a field over several ranges, and one that fills whole ranges with lines
    rows[20] = ("big", "u", "t", "y" * 2000 + "\n" + "z" * 500, "r")
    rows[40] = ("lines", "u", "t", "\n".join(["w" * 9] * 200), "r")
    write(f"{tmp_path}/c.csv", rows, quoting=csv.QUOTE_ALL if seed % 2 else csv.QUOTE_MINIMAL)
    df = read_csv(spark, f"{tmp_path}/c.csv", SCHEMA, multiline=True)
    assert df.schema == SCHEMA
    expected = sorted((tuple(x or None for x in row) for row in rows), key=repr)
    assert as_set(df) == expected == as_set(whole_files(spark, f"{tmp_path}/c.csv"))
    assert spark.read.text(f"{tmp_path}/c.csv").rdd.getNumPartitions() > 20


def test_line_ends_marks_and_blank_lines(spark, tmp_path, small_ranges):
    rows = [(f"k{i}", "u", "t", "two\r\nlines" if i % 3 == 0 else "one", "r") for i in range(60)]
    write(f"{tmp_path}/c.csv", rows, line_end="\r\n", bom=True)
    with open(f"{tmp_path}/c.csv", "a", newline="") as f:
        f.write("\r\n  \r\n")
    assert as_set(read_csv(spark, f"{tmp_path}/c.csv", SCHEMA, multiline=True)) == sorted(rows)


def test_folders_of_files_and_their_names(spark, tmp_path, small_ranges):
    rng = random.Random(9)
    given = {f"part-{i}.csv": [(f"f{i}-{r[0]}", *r[1:]) for r in odd_rows(rng, n)] for i, n in enumerate((0, 1, 40, 80))}
    (tmp_path / "c.csv").mkdir()
    for name, rows in given.items():
        write(tmp_path / "c.csv" / name, rows)
    df = read_csv(spark, f"{tmp_path}/c.csv", SCHEMA, multiline=True, file_column="file")
    expected = {(row[0], name) for name, rows in given.items() for row in rows}
    assert {(r.case_id, r.file) for r in df.collect()} == expected and df.count() == len(expected)
    plain = read_csv(spark, f"{tmp_path}/c.csv", SCHEMA, multiline=False, file_column="file")
    assert plain.columns == [*SCHEMA.names, "file"]


def test_broken_files_fail(spark, tmp_path, small_ranges):
    def read(text):
        (tmp_path / "c.csv").write_text(",".join(SCHEMA.names) + "\n" + text)
        return read_csv(spark, f"{tmp_path}/c.csv", SCHEMA, multiline=True).collect()

    assert read("") == []
    with pytest.raises(ValueError, match="without an end: .'c.csv'"):
        read('k1,u,t,"open,r\n')
    for text in ("k1,u,t\n", "k1,u,t,a,b,c\n", 'k1,u,t,"a\nb",r,more\n'):
        with pytest.raises(Exception, match="MALFORMED"):
            read(text)
    (tmp_path / "c.csv").write_text("case_id,b,c,d,e\nk1,u,t,a,r\n")
    with pytest.raises(Exception, match="the header of c.csv is"):
        read_csv(spark, f"{tmp_path}/c.csv", SCHEMA, multiline=True).collect()


def test_bronze_rows_name_the_file_they_came_from(spark, tmp_path):
    from tests.helpers import event, user
    import json

    for name in ("plans", "subscriptions", "payments", "support_cases"):
        (tmp_path / f"{name}.csv").write_text(",".join(RAW_SCHEMAS[name].names) + "\n")
    (tmp_path / "users.csv").mkdir()
    for i in range(2):
        row = user(f"u{i}")
        (tmp_path / "users.csv" / f"part-{i}.csv").write_text(
            ",".join(RAW_SCHEMAS["users"].names) + "\n" + ",".join(row[c] for c in RAW_SCHEMAS["users"].names) + "\n"
        )
    (tmp_path / "content_events.json").mkdir()
    for i in range(2):
        (tmp_path / "content_events.json" / f"e{i}.json").write_text(json.dumps([event(f"u{i}")]))
    for multiline in (False, True):
        bronze = bronze_tables(spark, str(tmp_path), "2024-02-15 06:00:00", multiline=multiline)
        assert {(r.user_id, r._source_file) for r in bronze["users"].collect()} == {("u0", "part-0.csv"), ("u1", "part-1.csv")}
        assert {(r.user_id, r._source_file) for r in bronze["content_events"].collect()} == {("u0", "e0.json"), ("u1", "e1.json")}
