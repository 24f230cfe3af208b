from decimal import Decimal

from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F, types as T
import pytest

from skyledger.operators import coerce
from skyledger.sinks import tables

TARGET = T.StructType(
    [
        T.StructField("temperature", T.DecimalType(3, 1)),
        T.StructField("winddirection", T.ShortType()),
        T.StructField("batch_id", T.IntegerType()),
    ]
)
SHAPE = "temperature double, winddirection int, batch_id bigint, note string"


def frame(spark, *rows):
    return spark.createDataFrame(rows, SHAPE)


@pytest.mark.parametrize("ansi", ["true", "false"])
class TestBothArithmeticModes:
    def test_strict_rounds_and_keeps_nulls_and_other_columns(self, spark, with_conf, ansi):
        with_conf(spark__sql__ansi__enabled=ansi)
        out = coerce.strict(
            frame(spark, (9.96, 3, 4, "a"), (-0.25, None, None, None), (None, 1, 2, "b"), (99.94, 1, 1, "")), TARGET
        )
        assert out.schema["temperature"].dataType == T.DecimalType(3, 1)
        assert out.schema["note"].dataType == T.StringType()
        assert [tuple(r) for r in out.collect()] == [
            (Decimal("10.0"), 3, 4, "a"),
            (Decimal("-0.3"), None, None, None),
            (None, 1, 2, "b"),
            (Decimal("99.9"), 1, 1, ""),
        ]

    @pytest.mark.parametrize(
        "row, column",
        [
            ((100.0, 1, 1, ""), "temperature"),
            ((99.95, 1, 1, ""), "temperature"),
            ((1.0, 40_000, 1, ""), "winddirection"),
            ((1.0, 1, 3_000_000_000, ""), "batch_id"),
        ],
    )
    def test_strict_fails_on_a_misfit(self, spark, with_conf, ansi, row, column):
        with_conf(spark__sql__ansi__enabled=ansi)
        with pytest.raises(Exception, match=f"{column} does not fit"):
            coerce.strict(frame(spark, (1.0, 1, 1, ""), row), TARGET).collect()

    def test_split_keeps_every_row_once(self, spark, with_conf, ansi):
        with_conf(spark__sql__ansi__enabled=ansi)
        rows = [(1.04, 1, 1, "fits"), (100.0, 40_000, 1, "two"), (None, None, None, "nulls"), (1.0, 1, 2**40, "one")]
        accepted, rejected = coerce.split(frame(spark, *rows), TARGET)
        assert {(r.note, r.temperature) for r in accepted.collect()} == {("fits", Decimal("1.0")), ("nulls", None)}
        assert {(r.note, tuple(r.rejected_columns)) for r in rejected.collect()} == {
            ("two", ("temperature", "winddirection")),
            ("one", ("batch_id",)),
        }
        # A rejected row keeps the values it came with.
        assert {r.batch_id for r in rejected.collect()} == {1, 2**40}


def test_nothing_to_coerce_rejects_nothing(spark):
    marked = coerce.mark(spark.createDataFrame([("x",)], "note string"), TARGET)
    assert marked.first()[coerce.REJECTED] == []


def test_bounds_agree_with_trying_the_cast(spark):
    """Values at and around every bound, from each numeric type to each declared type."""
    kinds = [T.DecimalType(3, 1), T.DecimalType(8, 6), T.DecimalType(5, 0), T.DecimalType(18, 2), T.DecimalType(38, 10)]
    kinds += [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.DoubleType()]
    edges = [0.0, 99.94, 99.95, 99.96, 99.9999994, 99.9999995, 99.99999949999999, 99999.4, 99999.5, 1e16, 9999999999999998.0]
    edges += [127.0, 128.0, 32767.0, 32768.0, 2147483647.0, 2147483648.0, 9.3e18, 1e30, 127.9, 32767.5]
    edges += [float("inf"), float("nan")]
    values = edges + [-v for v in edges]
    doubles = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    frames = [
        doubles,
        doubles.select(F.col("v").cast("float").alias("v")),
        doubles.select(F.col("v").try_cast("decimal(30,9)").alias("v")),
        doubles.select(F.col("v").try_cast("bigint").alias("v")),
        doubles.select(F.col("v").try_cast("int").alias("v")),
    ]
    for df in frames:
        for kind in kinds:
            target = T.StructType([T.StructField("v", kind)])
            misfits = coerce.mark(df, target).where(F.size(coerce.REJECTED) > 0).count()
            same_type = df.schema["v"].dataType == kind
            tried = 0 if same_type else df.where(F.col("v").isNotNull() & F.col("v").try_cast(kind).isNull()).count()
            assert misfits == tried, (df.schema["v"].dataType, kind)
            accepted, rejected = coerce.split(df, target)
            assert accepted.count() + rejected.count() == df.count()
            assert accepted.schema["v"].dataType == kind


def rows_read(spark):
    """Rows that all stages so far have read from files."""
    context = spark.sparkContext._jsc.sc()
    context.listenerBus().waitUntilEmpty(30_000)
    found = unknown = stage = 0
    while unknown < 50:
        try:
            found += context.statusStore().lastStageAttempt(stage).inputRecords()
        except Py4JJavaError:
            unknown += 1
        stage += 1
    return found


def test_a_split_write_reads_its_source_once(spark, tmp_path):
    """Rows that fit come back in the declared types, the others as they were; nothing is read twice or shuffled."""
    source = str(tmp_path / "source")
    spark.range(0, 3_000, 1, 3).selectExpr(
        "id", "IF(id % 7 = 0, NULL, id * 1.5D) AS price", "concat('t', id) AS `a b`", "id * 20 AS code", "'x' AS rejected"
    ).write.parquet(source)
    df = spark.read.parquet(source)
    target = T.StructType([T.StructField("price", T.DecimalType(6, 2)), T.StructField("code", T.ShortType())])
    before = rows_read(spark)
    parts = tables.write_split(df, target, str(tmp_path / "out"))
    assert rows_read(spark) - before == 3_000
    accepted, rejected = parts.accepted.collect(), parts.rejected.collect()
    assert len(accepted) + len(rejected) == 3_000
    assert [f.dataType for f in parts.accepted.schema][:2] == [T.LongType(), T.DecimalType(6, 2)]
    assert parts.rejected.schema["price"].dataType == T.DoubleType() and parts.rejected.schema["code"].dataType == T.LongType()
    assert {r.id for r in accepted} == {i for i in range(3_000) if i * 20 < 32_768 and (i % 7 == 0 or i * 1.5 < 9_999.995)}
    assert all(r.price == (None if r.id % 7 == 0 else r.id * 1.5) and r["a b"] == f"t{r.id}" for r in rejected)
    assert {tuple(r.rejected_columns) for r in rejected} <= {("code",), ("price", "code")}
    again = tables.write_split(df.where("id < 10"), target, str(tmp_path / "out"))
    assert (again.accepted.count(), again.rejected.count()) == (10, 0)
    assert tables.write_split(df.limit(0), target, str(tmp_path / "none")).accepted.count() == 0
