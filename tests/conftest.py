import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import siltbed as sb  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    return sb.ship(session)


@pytest.fixture
def spec(spark, tmp_path):
    database = "bronze_" + tmp_path.name.replace("-", "_")
    made = sb.DatasetSpec(
        "crm", "events", f"{tmp_path}/landing", f"{tmp_path}/raw", f"{tmp_path}/bronze", database
    )
    yield made
    spark.sql(f"DROP TABLE IF EXISTS {made.table}")


@pytest.fixture
def drop_file(spec):
    """Put a text file into the dated landing tree."""

    def drop(name, text, day="2024/01/01"):
        folder = Path(spec.landing_dir.removeprefix("file:")) / day
        folder.mkdir(parents=True, exist_ok=True)
        data = text if isinstance(text, bytes) else text.encode()
        (folder / name).write_bytes(data)
        return folder / name

    return drop


def rows(df, *columns):
    """Sorted rows as tuples."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
