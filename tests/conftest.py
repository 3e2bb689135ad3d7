import pytest

from featuremart.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g",
           "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    if session.sparkContext.getCheckpointDir() is None:
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Value of an expression over a single text (or typed) input ``x``."""

    def evaluate(expression, *values, type="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {type}")
        rows = df.select("i", expression.alias("y")).orderBy("i").collect()
        return [r["y"] for r in rows]

    return evaluate
