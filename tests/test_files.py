import gzip
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import DATA, DAY, plan_of, values
from voltalake import schemas as S
from voltalake import session
from voltalake.operators.normalize import normalize_customers, quarantine, readable
from voltalake.session import fresh_folder, shared_folder, sizing, stage
from voltalake.sources import files, layout


def test_landing_path():
    path = layout.landing_path("ventas", "2024-01-15", "08", "ventas.csv")
    assert path == "raw/ventas/year=2024/month=01/day=15/hour=08/ventas.csv"
    assert layout.day_parts("2025-12-05") == {"year": "2025", "month": "12", "day": "05"}


@pytest.mark.parametrize("bad", ["15/01/2024", "2024-13-01", "2024-1-5"])
def test_malformed_load_date_is_an_error(bad):
    with pytest.raises(ValueError):
        layout.day_parts(bad)


def test_table_name_is_the_lower_cased_stem(spark):
    paths = ["s3://b/in/Ventas.csv", "/l/raw/x/CLIENTES.csv/part-0-a.c000.csv", "/l/raw/part-1.csv"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    names = [r[0] for r in df.select(layout.table_name(F.col("p"))).collect()]
    assert names == ["ventas", "clientes", "part-1"]


def test_landing_reports_each_dataset(spark, sample, tmp_path):
    sources = {
        "proveedores": sample["proveedores"],
        "clientes": str(DATA / "clientes.csv"),
        "transacciones": str(tmp_path / "not_there.csv"),
    }
    dry = files.land(sources, spark, str(tmp_path), DAY, 7, dry_run=True)
    assert values(dry, "dataset", "filas", "estado") == [
        ("proveedores", 10, "simulado"), ("clientes", 10, "simulado"),
        ("transacciones", None, "omitido"),
    ]
    assert not (tmp_path / "raw").exists()
    done = files.land(sources, spark, str(tmp_path), DAY, 7)
    assert values(done, "filas", "estado") == [(10, "ok"), (10, "ok"), (None, "omitido")]
    assert (tmp_path / done.first()["destino"]).is_dir()
    back = readable(files.scan_csv(spark, str(tmp_path), "clientes", DAY))
    assert sorted(values(back)) == sorted(values(sample["clientes"]))


def test_landed_text_comes_back_unchanged(spark, raw, tmp_path):
    rows = [('  a, "b" ', "eolica ", " x\\", "1", "2024-01-01", None)]
    files.land({"proveedores": raw("proveedores", rows)}, spark, str(tmp_path), DAY)
    back = readable(files.scan_csv(spark, str(tmp_path), "proveedores"))
    assert values(back) == rows


def test_scan_reads_one_load_date(spark, sample, tmp_path):
    for day in (DAY, "2024-01-16"):
        files.land({"proveedores": sample["proveedores"]}, spark, str(tmp_path), day)
    assert files.scan_csv(spark, str(tmp_path), "proveedores", DAY).count() == 10
    assert files.scan_csv(spark, str(tmp_path), "proveedores").count() == 20


def csv_file(tmp_path, text):
    folder = tmp_path / "raw" / "proveedores"
    folder.mkdir(parents=True)
    (folder / "proveedores.csv").write_text(text, encoding="utf-8")
    return str(tmp_path)


def test_lines_of_the_wrong_shape(spark, tmp_path):
    header = ",".join(S.RAW_COLUMNS["proveedores"])
    root = csv_file(
        tmp_path, f"{header}\na,eolica,x,1,2024-01-01,true\nb,eolica\nc,eolica,x,1,2024-01-01,true,9\n"
    )
    rows = files.scan_csv(spark, root, "proveedores")
    assert values(readable(rows), "nombre_proveedor") == [("a",)]
    assert sorted(values(quarantine(rows, "proveedores"), S.CORRUPT)) == [
        ("b,eolica",), ("c,eolica,x,1,2024-01-01,true,9",)
    ]


def written(folder, **files_by_name):
    folder.mkdir(parents=True, exist_ok=True)
    for name, text in files_by_name.items():
        (folder / f"{name}.csv").write_text(text, encoding="utf-8")


ROW = {
    "nombre_proveedor": "a", "tipo_energia": "eolica", "pais_origen": "x", "capacidad_mw": "1",
    "fecha_registro": "2024-01-01", "activo": "true",
}


def test_columns_are_mapped_by_each_files_header(spark, tmp_path):
    names = list(ROW)
    orders = {"uno": names, "dos": names[::-1], "tres": names[3:] + names[:3]}
    texts = {k: f"{','.join(x)}\n{','.join(ROW[c] for c in x)}\n" for k, x in orders.items()}
    texts["cuatro"] = "\n \n\ufeff" + texts["dos"].upper().replace("TRUE", "true")
    folder = tmp_path / "raw" / "proveedores" / "un día {1}"
    written(folder, **{**texts, "cuatro": texts["cuatro"].lstrip("\n ")}, vacio="")
    rows = files.scan_csv(spark, str(tmp_path), "proveedores")
    assert {tuple(x)[0].lower() for x in values(readable(rows))} == {"a"}
    assert sorted(values(readable(rows))) == sorted([tuple(ROW.values())] * 3 + [
        tuple(v if v == "true" else v.upper() for v in ROW.values())
    ])


def test_lines_under_a_foreign_header_go_to_quarantine(spark, tmp_path):
    good = f"{','.join(ROW)}\n{','.join(ROW.values())}\n"
    written(
        tmp_path / "raw" / "proveedores",
        bueno=good, ajeno=good.replace("pais_origen", "pais"), corto="activo\ntrue\n",
        doble=good.replace("pais_origen", "activo"),
    )
    rows = files.scan_csv(spark, str(tmp_path), "proveedores")
    assert values(readable(rows)) == [tuple(ROW.values())]
    bad = values(quarantine(rows, "proveedores"), S.CORRUPT, "motivo")
    assert len(bad) == 6 and {x[1] for x in bad} == {S.CORRUPT}
    assert ("true", S.CORRUPT) in bad


def test_records_may_span_lines(spark, tmp_path):
    header = ",".join(ROW)
    written(
        tmp_path / "raw" / "proveedores",
        largo=f'{header}\n"a\nb\r\n ""c""",eolica,x,1,2024-01-01,true\nd,eolica,x,1,2024-01-01,true\n',
        abierto=f'{header}\n"a,eolica,x,1,2024-01-01,true\ne,eolica,x,1,2024-01-01,true\n',
    )
    rows = files.scan_csv(spark, str(tmp_path), "proveedores")
    assert sorted(values(readable(rows), "nombre_proveedor")) == [
        ('a\nb\r\n "c"',), ("d",), ("e",),
    ]
    # A quote that nothing closes spoils its own line only.
    assert values(quarantine(rows, "proveedores"), S.CORRUPT) == [
        ('"a,eolica,x,1,2024-01-01,true',)
    ]


def test_landed_line_breaks_come_back(spark, raw, tmp_path):
    rows = [("a\nb\"c", "eolica", " \n", "1", "2024-01-01", None)]
    files.land({"proveedores": raw("proveedores", rows)}, spark, str(tmp_path), DAY)
    assert values(readable(files.scan_csv(spark, str(tmp_path), "proveedores"))) == rows


def test_a_file_that_cannot_be_read_stops_no_other(spark, tmp_path):
    folder = tmp_path / "raw" / "proveedores"
    written(folder, **{f"b{k}": f"{','.join(ROW)}\n{','.join(ROW.values())}\n" for k in range(5)})
    (folder / "roto.csv.gz").write_bytes(b"\x1f\x8b\x08\x00 not gzip")
    rows = files.scan_csv(spark, str(tmp_path), "proveedores")
    assert len(values(readable(rows))) == 5
    [(text,)] = values(quarantine(rows, "proveedores"), S.CORRUPT)
    assert "roto.csv.gz: ilegible" in text


def test_landing_a_file_with_a_foreign_header_is_an_error(spark, tmp_path):
    written(tmp_path, malo="a,b\n1,2\n")
    with pytest.raises(ValueError, match="columnas desconocidas: a, b"):
        files.land({"proveedores": str(tmp_path / "malo.csv")}, spark, str(tmp_path), DAY)


def test_a_load_replaces_only_its_own_date(spark, sample, tmp_path):
    first = normalize_customers(sample["clientes"], DAY, DAY)
    other = normalize_customers(sample["clientes"], "2024-02-03", "2024-02-03")
    assert files.write_processed(first, str(tmp_path), "clientes", DAY) == 10
    files.write_processed(other, str(tmp_path), "clientes", "2024-02-03")
    fewer = first.where("segmento = 'comercial'")
    assert files.write_processed(fewer, str(tmp_path), "clientes", DAY) == 2
    everything = files.read_processed(spark, str(tmp_path), "clientes")
    counts = everything.groupBy("year", "month", "day").count()
    assert sorted(values(counts)) == [("2024", "01", "15", 2), ("2024", "02", "03", 10)]
    one = files.read_processed(spark, str(tmp_path), "clientes", "2024-02-03")
    assert one.dtypes == list(S.PROCESSED["clientes"].items())
    assert sorted(values(one)) == sorted(values(other))


def test_a_load_reads_only_its_own_folder(spark, sample, tmp_path):
    for day in (DAY, "2024-02-03"):
        rows = normalize_customers(sample["clientes"], day, day)
        files.write_processed(rows, str(tmp_path), "clientes", day)
    plan = plan_of(files.read_processed(spark, str(tmp_path), "clientes", DAY).select("nombre"))
    assert "(month" in plan[plan.index("PartitionFilters"):] and "ReadSchema: struct<nombre:string>" in plan


def test_export(spark, tmp_path):
    df = spark.createDataFrame([("a,b", 1.5), (None, None)], "t string, v double")
    files.export(df, str(tmp_path / "c"), "csv")
    back = spark.read.schema(df.schema).options(**files.CSV_READ).csv(str(tmp_path / "c"))
    assert sorted(values(back), key=repr) == sorted(values(df), key=repr)
    files.export(df, str(tmp_path / "j"), "json")
    lines = [line for f in Path(tmp_path / "j").glob("part-*") for line in f.read_text().split("\n")]
    assert sorted(json.loads(line)["t"] or "" for line in lines if line) == ["", "a,b"]
    with pytest.raises(ValueError, match="xml"):
        files.export(df, str(tmp_path / "x"), "xml")


def test_scans_with_pieces_enough_are_not_shuffled(spark):
    wide = spark.range(0, 100, 1, 8)
    assert files.spread(wide, "id") is wide
    narrow = files.spread(spark.range(0, 100, 1, 1), "id")
    assert "REPARTITION_BY_NUM" in plan_of(narrow) and narrow.count() == 100


def test_staged_rows_are_files_in_the_shared_folder(spark):
    df = spark.range(5).withColumn("t", F.lit("x"))
    staged = stage(df, "s")
    assert staged.dtypes == df.dtypes and sorted(values(staged)) == sorted(values(df))
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert f"{shared_folder(spark)}/s-" in staged.inputFiles()[0]
    assert fresh_folder(spark, "s") != fresh_folder(spark, "s")


def test_staging_frees_its_shuffles(spark):
    before = spark.conf.get(session.SHUFFLE_CLEANUP)
    inside = []
    with session.freed_shuffles(spark):
        inside.append(spark.conf.get(session.SHUFFLE_CLEANUP))
    assert inside == ["true"] and spark.conf.get(session.SHUFFLE_CLEANUP) == before
    rows = spark.range(100).repartition(3, "id")
    assert stage(rows, "s").count() == 100 and rows.count() == 100


def test_sizing_follows_the_input():
    def tasks(size):
        return int(sizing(size)["spark.sql.shuffle.partitions"])

    assert [tasks(0), tasks(10 * 2**30), tasks(100 * 10**12)] == [8, 40, 50_000]


def test_a_load_without_rows_replaces_the_last(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.createDataFrame([("a",)], "tipo_energia string")
    for day in ("2024-01-14", DAY):
        files.write_processed(rows, root, "metricas_energia", day)
    assert files.write_processed(rows.where("false"), root, "metricas_energia", DAY) == 0
    assert files.read_processed(spark, root, "metricas_energia", DAY).isEmpty()
    assert files.read_processed(spark, root, "metricas_energia").count() == 1


def test_landed_files_are_compressed(spark, tmp_path):
    """Their text is several times as large, and lies beside all that comes after it."""
    rows = spark.range(20_000).select(
        *[F.concat(F.lit(f"{x} "), F.col("id") % 50).alias(x) for x in S.RAW_COLUMNS["proveedores"]]
    )
    files.land({"proveedores": rows.repartition(2)}, spark, str(tmp_path), DAY)
    landed = list((tmp_path / "raw").rglob("carga-*.csv.gz"))
    assert len(landed) == 2
    packed = sum(x.stat().st_size for x in landed)
    assert packed * 4 < sum(len(gzip.decompress(x.read_bytes())) for x in landed)
    assert files.scan_csv(spark, str(tmp_path), "proveedores", DAY).count() == 20_000
