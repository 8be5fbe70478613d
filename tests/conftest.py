import pytest

from talkmill.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="6g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def values(spark):
    """Values of a column function over literal inputs."""

    def run(function, *inputs, ddl="t string"):
        from pyspark.sql import functions as F

        rows = [(v,) if not isinstance(v, tuple) else v for v in inputs]
        frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"_i int, {ddl}")
        columns = [F.col(c) for c in frame.columns[1:]]
        found = frame.select("_i", function(*columns).alias("v")).collect()
        return [r["v"] for r in sorted(found, key=lambda r: r["_i"])]

    return run
