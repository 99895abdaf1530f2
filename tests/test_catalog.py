import pytest

from conftest import DATA, DAY, values
from voltalake import schemas as S
from voltalake.plans import analytics, daily
from voltalake.sources import catalog, files
from voltalake.streaming import ingest


@pytest.fixture(scope="module")
def root(spark, sample, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("lake"))
    daily.run_load(sample, folder, DAY)
    return folder


def test_refresh_adds_tables_partitions_and_columns(spark, sample, root):
    status = catalog.refresh(spark, root, "cat", "processed")
    assert {r["tabla"]: (r["columnas"], r["particiones"], r["estado"]) for r in status.collect()} == {
        name: (len(columns) + 3, 1, "SUCCEEDED") for name, columns in S.PROCESSED.items()
    }
    assert spark.table("cat_processed.transacciones").count() == 15
    assert dict(spark.table("cat_processed.clientes").dtypes)["month"] == "string"

    day2 = files.read_processed(spark, root, "proveedores", DAY).selectExpr("*", "1 AS nueva")
    files.write_processed(day2, root, "proveedores", "2024-01-16")
    again = catalog.refresh(spark, root, "cat", "processed").where("tabla = 'proveedores'").first()
    assert (again["columnas"], again["particiones"]) == (12, 2)
    table = spark.table("cat_processed.proveedores")
    assert sorted(values(table.groupBy("month", "day", "nueva").count()), key=repr) == [
        ("01", "15", None, 10), ("01", "16", 1, 10)
    ]


def test_raw_and_curated_zones(spark, tmp_path):
    root, landing = str(tmp_path / "lake"), str(tmp_path / "in")
    files.land({name: str(DATA / f"{name}.csv") for name in S.RAW_COLUMNS}, spark, landing, DAY)
    for name in S.RAW_COLUMNS:
        ingest.ingest(spark, name, landing, root, str(tmp_path / "marks"), DAY)
    daily.load_ingested(spark, root, DAY)
    results = analytics.run_queries(daily.processed_tables(spark, root, DAY), DAY, "q1,q7")
    for name, result in results.items():
        files.write_curated(result, root, name)
    status = {
        (r["zona"], r["tabla"]): (r["particiones"], r["estado"])
        for r in catalog.refresh(spark, root, "zonas").collect()
    }
    assert {k: v for k, v in status.items() if k[0] == "raw"} == {
        ("raw", name): (1, "SUCCEEDED") for name in S.RAW_COLUMNS
    }
    assert {k[1] for k, v in status.items() if v[1] == "FAILED"} == {"q2", "q3", "q4", "q5", "q6"}
    assert spark.table("zonas_raw.transacciones").where("fecha = '2024-01-15'").count() == 15
    assert spark.table("zonas_curated.q7").count() == 9

    day2 = "2024-01-16"
    files.land({"clientes": str(DATA / "clientes.csv")}, spark, landing, day2)
    ingest.ingest(spark, "clientes", landing, root, str(tmp_path / "marks"), day2)
    catalog.refresh(spark, root, "zonas", "raw")
    rows = spark.table("zonas_raw.clientes").groupBy("fecha").count()
    assert sorted(values(rows.selectExpr("CAST(fecha AS STRING)", "count"))) == [
        (DAY, 10), (day2, 10)
    ]


def test_missing_folders_are_reported(spark, tmp_path):
    status = catalog.refresh(spark, str(tmp_path), "nada", "curated")
    assert set(values(status, "zona", "estado")) == {("curated", "FAILED")}
    with pytest.raises(ValueError, match="zone"):
        catalog.refresh(spark, str(tmp_path), "nada", "gold")


def test_listing(spark, root):
    catalog.refresh(spark, root, "lista", "processed")
    rows = dict(values(catalog.listing(spark, ["lista_processed"]), "tabla", "columnas"))
    assert rows["clientes"] == 13 and set(rows) == set(S.PROCESSED)


def test_analysts_see_no_identification(spark, root):
    catalog.refresh(spark, root, "gob", "processed")
    catalog.create_analyst_views(spark, "gob_processed", "gob_analistas")
    names = {t.name for t in spark.catalog.listTables("gob_analistas") if not t.isTemporary}
    assert names == {*S.PROCESSED, "clientes_analista"} - {"clientes"}
    shown = spark.table("gob_analistas.clientes_analista")
    assert "identificacion" not in shown.columns
    assert "identificacion_enmascarada" in shown.columns and shown.count() == 10


def test_a_refresh_opens_only_new_footers(spark, sample, tmp_path, monkeypatch):
    root = str(tmp_path)
    opened = []
    columns_in = catalog._columns_in
    monkeypatch.setattr(
        catalog, "_columns_in", lambda s, x, p: opened.append(list(x)) or columns_in(s, x, p)
    )
    suppliers = files.read_processed  # the stored form of the sample
    daily.run_load(sample, root, DAY)
    rows = suppliers(spark, root, "proveedores", DAY)
    catalog.refresh(spark, root, "nuevo", "processed")
    opened.clear()
    catalog.refresh(spark, root, "nuevo", "processed")
    assert opened == []
    files.write_processed(rows, root, "proveedores", "2024-02-01")
    catalog.refresh(spark, root, "nuevo", "processed")
    assert opened == [[f"{root}/processed/proveedores/year=2024/month=02/day=01"]]
    assert spark.table("nuevo_processed.proveedores").count() == 20


def test_partitions_without_a_folder_go(spark, sample, tmp_path):
    root, landing, marks = (str(tmp_path / x) for x in ("lake", "in", "marks"))
    for rows in (sample["clientes"], sample["clientes"].limit(3)):
        files.land({"clientes": rows}, spark, landing, DAY)
        ingest.ingest(spark, "clientes", landing, root, marks, DAY)
        catalog.refresh(spark, root, "menos", "raw")
    assert spark.table("menos_raw.clientes").count() == 3
    assert spark.sql("SHOW PARTITIONS menos_raw.clientes").count() == 1
