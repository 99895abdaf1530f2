import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
for folder in (ROOT, ROOT / "tests"):
    sys.path.insert(0, str(folder))

from voltalake import schemas as S  # noqa: E402
from voltalake.session import SETTINGS  # noqa: E402

# The sample files, whose results are known.
DATA = ROOT / "tests" / "data"
DAY = "2024-01-15"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = SparkSession.builder.master("local[4]").appName("tests")
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def raw(spark):
    """Raw rows of a dataset, given as tuples of texts."""

    def build(dataset, rows):
        return spark.createDataFrame(rows, S.raw_schema(dataset, corrupt=False))

    return build


@pytest.fixture(scope="session")
def sample(spark):
    """The three sample files as raw datasets."""
    return {
        name: spark.read.schema(S.raw_schema(name, corrupt=False))
        .option("header", True)
        .csv(str(DATA / f"{name}.csv"))
        for name in S.RAW_COLUMNS
    }


@pytest.fixture
def dirty(raw):
    """Small raw datasets with one of each defect (fixed values)."""
    return {
        "proveedores": raw("proveedores", [
            ("EnerSol Caribe  ", "eolica", "Colombia", "350", "2021-03-15", "true"),
            ("HidroAndes S.A.", "HIDROELECTRICA ", "Colombia", "1200", "2019-07-22", "true"),
            ("NuclearPower Co.", "nuclear", "Francia", "2000", "2020-01-10", "true"),
            ("VientoNorte Ltda.", "eolica", "Colombia", "180", "2022-05-30", "true"),
            ("EnerSol Caribe  ", "eolica", "Colombia", "350", "2021-03-15", "true"),
            ("InvalidType Corp", "carbon", "Colombia", "500", "2023-01-01", "true"),
        ]),
        "clientes": raw("clientes", [
            ("cc", "1023456789", "  María López  ", "bogotá", "RESIDENCIAL", "2020-01-15", "350"),
            ("NIT", "900123456-1", "Industrias S.A.", "medellín", "industrial", "2018-06-20",
             "45000"),
            ("CC", "987654321", "Carlos Ruiz", "Cali", "residencial", "2021-03-10", "280"),
            ("CC", "1023456789", "Duplicado", "Bogotá", "residencial", "2022-01-01", "100"),
            ("INVALIDO", "000000", "Nadie", "Ninguna", "ninguna", "2023-01-01", "0"),
        ]),
        "transacciones": raw("transacciones", [
            ("TRX-001", "compra", "EnerSol Caribe", "500000", "285.50", "eolica", "2024-01-05",
             "completada", "mayorista"),
            ("TRX-002", "venta", "María López", "350", "410.00", "eolica", "2024-01-05",
             "completada", "minorista"),
            ("TRX-003", "compra", "HidroAndes S.A.", "1200000", "260.00", "hidroelectrica",
             "2024-01-06", "completada", "mayorista"),
            ("TRX-004", "venta", "Industrias S.A.", "45000", "395.00", "hidroelectrica",
             "2024-01-06", "completada", "minorista"),
            ("TRX-005", "COMPRA", " NuclearPower", "800000", "210.50", "nuclear", "2024-01-07",
             "pendiente", "mayorista"),
            ("TRX-001", "compra", "EnerSol Caribe", "500000", "285.50", "eolica", "2024-01-05",
             "completada", "mayorista"),
        ]),
    }


def values(df, *columns):
    """Rows as tuples, in the order of the DataFrame."""
    return [tuple(row) for row in (df.select(*columns) if columns else df).collect()]


def plan_of(df, mode="formatted"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)
