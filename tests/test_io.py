import datetime as dt

import pytest
from conftest import at, tuples

from fieldbook.plans import records
from fieldbook.session import stored, work_folder
from fieldbook.sources import files, readers, schemas, writers

LAYOUT = schemas.struct("id:l name:s created_on:t")


def test_declared_layout_is_enforced(table):
    df = table("name:s id:l created_on:t", [("x", 1, None)])
    assert schemas.conform(df, LAYOUT).columns == ["id", "name", "created_on"]
    with pytest.raises(schemas.SchemaMismatch, match="missing columns \\['name'\\]"):
        schemas.conform(df.drop("name"), LAYOUT)
    with pytest.raises(schemas.SchemaMismatch, match="unexpected columns \\['extra'\\]"):
        records.snapshot(df.withColumnRenamed("name", "extra"), LAYOUT)


def test_replace_and_rerun_of_a_day_leave_one_copy(spark, table):
    path = work_folder(spark, "t")
    one = table("id:l name:s created_on:t", [(1, "x", at("2024-01-01 00:00:00"))])
    for day in (1, 2, 1):
        writers.publish(one, path, LAYOUT, run_date=dt.date(2024, 1, day))
    assert tuples(spark.read.parquet(path), "id", "run_date") == [(1, dt.date(2024, 1, 1)), (1, dt.date(2024, 1, 2))]
    other = work_folder(spark, "t")
    for _ in range(2):
        writers.publish(one, other, LAYOUT)
    assert readers.read_table(spark, other, LAYOUT).count() == 1
    with pytest.raises(schemas.SchemaMismatch):
        readers.read_table(spark, other, schemas.struct("id:l"))


def test_sheet_round_trip_and_missing_header(spark, table):
    path = work_folder(spark, "s")
    writers.write_sheet(table("a:l b:s", [(1, 'say "hi", ok'), (2, None), (3, "two\nlines")]), path)
    assert tuples(readers.read_text_sheet(spark, path, {"b": "text", "a": "n"}, multi_line=True), "n", "text") == [
        ("1", 'say "hi", ok'), ("2", None), ("3", "two\nlines")]
    with pytest.raises(ValueError, match="no columns \\['c'\\]"):
        readers.read_text_sheet(spark, path, ["a", "c"])


def test_compressed_csv(spark, table):
    path = work_folder(spark, "c")
    writers.write_csv(table("a:l", [(1,), (2,)]), path)
    here = readers.current(spark, path)
    files = [f for f in spark.read.format("binaryFile").load(here).select("path").collect()]
    assert all(f.path.endswith(".csv.gz") for f in files)
    assert spark.read.option("header", True).csv(here).count() == 2


def test_stack_fills_missing_columns(table):
    assert tuples(readers.stack(table("a:l", [(1,)]), table("a:l b:s", [(2, "x")]))) == [(1, None), (2, "x")]


def test_stored_result_reads_its_own_table(table):
    df = stored(table("a:l", [(1,)]), "x")
    assert tuples(df) == [(1,)] and len(df.inputFiles()) >= 1


def test_jdbc_reads_in_parallel_ranges():
    class Reader:
        def __init__(self):
            self.seen = {}

        def format(self, name):
            self.seen["format"] = name
            return self

        def options(self, **more):
            self.seen.update(more)
            return self

        def option(self, name, value):
            self.seen[name] = value
            return self

        def load(self):
            return self.seen

    class Session:
        read = Reader()

    got = readers.read_jdbc(Session, {"url": "jdbc:x"}, "calls", split_on="id", lower=1, upper=99, partitions=8)
    assert got == {"format": "jdbc", "url": "jdbc:x", "dbtable": "calls", "partitionColumn": "id",
                   "lowerBound": 1, "upperBound": 99, "numPartitions": 8}


def sheet(spark, path):
    return tuples(spark.read.option("header", True).csv(readers.current(spark, path)))


def test_a_write_that_fails_leaves_the_old_table(spark, table):
    path = work_folder(spark, "kept")
    writers.write_csv(table("a:l", [(1,)]), path)
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO|division"):
        writers.write_csv(table("a:l", [(1,), (0,)]).selectExpr("1 div a as a"), path)
    assert sheet(spark, path) == [("1",)]
    writers.write_csv(table("a:l", [(2,)]), path)
    assert sheet(spark, path) == [("2",)]


class Killed(BaseException):
    pass


STEPS = ("written", "pointer written", "pointer in place", "old removed")


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("when", ["before", "after"])
def test_a_run_killed_between_any_two_steps_leaves_a_readable_table(spark, table, monkeypatch, step, when):
    path = work_folder(spark, "killed")
    for n in (1, 2, 3):
        writers.write_csv(table("a:l", [(n,)]), path)

    def dies(real):
        def call(*args, **kwargs):
            if when == "before":
                raise Killed
            real(*args, **kwargs)
            raise Killed
        return call

    with monkeypatch.context() as patch:
        if step == "written":
            real = writers.write_csv.__globals__["replace"]
            patch.setattr(writers, "replace", lambda p, df, write: real(p, df, dies(write)))
        elif step == "pointer written":
            patch.setattr(files.uuid, "uuid4", dies(files.uuid.uuid4)) if when == "before" else patch.setattr(files.Files, "write", half_written)
        elif step == "pointer in place":
            patch.setattr(files.Files, "write", dies(files.Files.write))
        else:
            patch.setattr(files.Files, "delete", dies(files.Files.delete))
        with pytest.raises(Killed):
            writers.write_csv(table("a:l", [(4,)]), path)
    swapped = step == "old removed" or (step, when) == ("pointer in place", "after")
    assert sheet(spark, path) == [("4",) if swapped else ("3",)]
    writers.write_csv(table("a:l", [(5,)]), path)
    assert sheet(spark, path) == [("5",)]
    writers.write_csv(table("a:l", [(6,)]), path)
    left = files.Files(spark, path).folders(path)
    assert sheet(spark, path) == [("6",)] and len(left) == 2  # the current and the one before


def half_written(self, path, text):
    self._fs.create(self._path(f"{path}.half"), True).close()
    raise Killed


def test_a_missing_pointer_means_the_newest_complete_version(spark, table):
    path = work_folder(spark, "pointer")
    writers.write_csv(table("a:l", [(1,)]), path)
    writers.write_csv(table("a:l", [(2,)]), path)
    own = files.Files(spark, path)
    own.delete(f"{path}/{writers.CURRENT}")
    own.write(f"{path}/v000009-dead/part", "")
    assert sheet(spark, path) == [("2",)]
    plain = work_folder(spark, "plain")
    table("a:l", [(7,)]).write.parquet(plain)
    assert readers.current(spark, plain) == plain and readers.read_table(spark, plain).count() == 1


def test_a_reader_that_has_begun_keeps_its_version(spark, table):
    path = work_folder(spark, "reader")
    writers.publish(table("id:l name:s created_on:t", [(1, "x", None)]), path, LAYOUT)
    reading = readers.read_table(spark, path, LAYOUT)
    writers.publish(table("id:l name:s created_on:t", [(2, "y", None)]), path, LAYOUT)
    assert tuples(reading, "id") == [(1,)] and tuples(readers.read_table(spark, path, LAYOUT), "id") == [(2,)]
