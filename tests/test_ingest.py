import os
import shutil
from pathlib import Path

from conftest import DATA, DAY, plan_of, values
from voltalake import schemas as S
from voltalake.operators.normalize import readable
from voltalake.plans import daily
from voltalake.session import shared_folder
from voltalake.sources import files
from voltalake.streaming import ingest


def test_each_file_is_taken_once(spark, sample, tmp_path):
    landing, root, marks = (str(tmp_path / n) for n in ("in", "lake", "marks"))
    folder = tmp_path / "in" / "raw" / "proveedores" / "year=2024" / "month=01"
    folder.mkdir(parents=True)
    shutil.copy(DATA / "proveedores.csv", folder / "uno.csv")

    def run():
        ingest.ingest(spark, "proveedores", landing, root, marks, DAY)
        return ingest.read_ingested(spark, root, "proveedores").count()

    assert run() == 10
    assert run() == 10
    shutil.copy(DATA / "proveedores.csv", folder / "dos.csv")
    assert run() == 20
    rows = ingest.read_ingested(spark, root, "proveedores", DAY)
    assert rows.count() == 20
    assert {r[0].rsplit("/", 1)[1] for r in values(rows, "_origen")} == {"uno.csv", "dos.csv"}
    assert set(values(rows, "tabla")) == {("proveedores",)}
    distinct = readable(rows).select(*S.RAW_COLUMNS["proveedores"]).distinct()
    assert sorted(values(distinct)) == sorted(values(sample["proveedores"]))
    assert ingest.read_ingested(spark, root, "proveedores", "2024-01-16").isEmpty()


def test_unparseable_lines_are_kept(spark, tmp_path):
    landing, root, marks = (str(tmp_path / n) for n in ("in", "lake", "marks"))
    folder = tmp_path / "in" / "raw" / "clientes"
    folder.mkdir(parents=True)
    header = ",".join(S.RAW_COLUMNS["clientes"])
    (folder / "c.csv").write_text(f"{header}\nCC,1,a,b,c,2024-01-01,5\nCC,2\n")
    ingest.ingest(spark, "clientes", landing, root, marks)
    rows = ingest.read_ingested(spark, root, "clientes")
    assert sorted(values(rows, "identificacion", S.CORRUPT), key=repr) == [
        ("1", None), ("2", "CC,2")
    ]


def test_other_tables_are_kept_as_lines(spark, tmp_path):
    landing, root, marks = (str(tmp_path / n) for n in ("in", "lake", "marks"))
    folder = tmp_path / "in" / "varios"
    folder.mkdir(parents=True)
    (folder / "Medidores.csv").write_text("a,b\n1,2\n")
    (folder / "clientes.csv").write_text("x\n9\n")
    (folder / "Ventas.csv").mkdir()
    (folder / "Ventas.csv" / "part-0.csv").write_text("z\n")
    ingest.ingest_other(spark, landing, root, marks, DAY)
    rows = ingest.read_ingested(spark, root, ingest.LINES)
    assert sorted(values(rows, "tabla", "linea")) == [
        ("medidores", "1,2"), ("medidores", "a,b"), ("ventas", "z"),
    ]


def test_batches_of_files_take_everything(spark, tmp_path):
    landing, root, marks = (str(tmp_path / n) for n in ("in", "lake", "marks"))
    folder = tmp_path / "in" / "raw" / "clientes"
    folder.mkdir(parents=True)
    for i in range(5):
        shutil.copy(DATA / "clientes.csv", folder / f"{i}.csv")
    ingest.ingest(spark, "clientes", landing, root, marks, DAY, files_per_batch=2)
    assert ingest.read_ingested(spark, root, "clientes").count() == 50


def test_landing_to_processed_tables(spark, tmp_path):
    root, marks = str(tmp_path / "lake"), str(tmp_path / "marks")
    sources = {name: str(DATA / f"{name}.csv") for name in S.RAW_COLUMNS}
    files.land(sources, spark, str(tmp_path / "in"), DAY)
    for name in S.RAW_COLUMNS:
        ingest.ingest(spark, name, str(tmp_path / "in"), root, marks, DAY)
    counts = daily.load_ingested(spark, root, DAY)
    assert dict(values(counts, "tabla", "filas")) == {
        "proveedores": 10, "clientes": 10, "transacciones": 15,
        "metricas_energia": 6, "metricas_segmento": 3,
    }
    assert not list(Path(shared_folder(spark)).glob("load-*"))


def test_each_file_goes_to_one_stream(spark, sample, tmp_path):
    landing, root, marks = (str(tmp_path / n) for n in ("in", "lake", "marks"))
    files.land(sample, spark, landing, DAY)
    shutil.copy(DATA / "clientes.csv", tmp_path / "in" / "CLIENTES.csv")
    (tmp_path / "in" / "notas.csv").write_text("n\n")
    for _ in range(2):
        for name in S.RAW_COLUMNS:
            ingest.ingest(spark, name, landing, root, marks, DAY)
        ingest.ingest_other(spark, landing, root, marks, DAY)
    counts = {name: ingest.read_ingested(spark, root, name).count() for name in S.RAW_COLUMNS}
    assert counts == {"proveedores": 10, "clientes": 20, "transacciones": 15}
    assert values(ingest.read_ingested(spark, root, ingest.LINES), "tabla", "linea") == [("notas", "n")]


def test_old_files_are_taken_in_later_runs(spark, tmp_path):
    landing, root, marks = (str(tmp_path / n) for n in ("in", "lake", "marks"))
    folder = tmp_path / "in" / "raw" / "proveedores"
    folder.mkdir(parents=True)
    for n, name in enumerate(("new.csv", "old.csv")):
        shutil.copy(DATA / "proveedores.csv", folder / name)
        if name == "old.csv":
            os.utime(folder / name, (0, 0))
        ingest.ingest(spark, "proveedores", landing, root, marks, DAY)
        assert ingest.read_ingested(spark, root, "proveedores").count() == 10 * (n + 1)


def test_landing_again_replaces(spark, sample, tmp_path):
    landing, root, marks = (str(tmp_path / n) for n in ("in", "lake", "marks"))
    for rows in (sample["proveedores"], sample["proveedores"].limit(4)):
        files.land({"proveedores": rows}, spark, landing, DAY)
        ingest.ingest(spark, "proveedores", landing, root, marks, DAY)
    assert ingest.read_ingested(spark, root, "proveedores", DAY).count() == 4


def test_appends_of_other_writers_all_count(spark, sample, tmp_path):
    landing, root, marks = (str(tmp_path / n) for n in ("in", "lake", "marks"))
    hour = "raw/proveedores/year=2024/month=01/day=15/hour=00"
    for rows in (sample["proveedores"], sample["proveedores"].limit(4)):
        files.land({"proveedores": rows}, spark, landing, DAY)
        ingest.ingest(spark, "proveedores", landing, root, marks, DAY)
        # One write beside the landing, one to a folder of appends, one of another table.
        for folder in (hour, "raw/proveedores/socio", "varios/Ventas.csv"):
            rows.write.mode("append").option("header", True).csv(f"{landing}/{folder}")
        ingest.ingest(spark, "proveedores", landing, root, marks, DAY)
        ingest.ingest_other(spark, landing, root, marks, DAY)
    assert ingest.read_ingested(spark, root, "proveedores").count() == 4 + 2 * (10 + 4)
    assert ingest.read_ingested(spark, root, ingest.LINES).count() == 11 + 5


def test_taken_files_are_archived(spark, tmp_path):
    landing, root, marks = (str(tmp_path / n) for n in ("in", "lake", "marks"))
    folder = tmp_path / "in" / "raw" / "clientes"
    folder.mkdir(parents=True)
    for k in range(3):
        shutil.copy(DATA / "clientes.csv", folder / f"{k}.csv")
        ingest.ingest(
            spark, "clientes", landing, root, marks, DAY, archive=str(tmp_path / "done")
        )
    assert ingest.read_ingested(spark, root, "clientes").count() == 30
    assert len(list(folder.glob("*.csv"))) < 3


def run(spark, landing, root, marks, *names, day=DAY):
    for name in names or ("proveedores",):
        ingest.ingest(spark, name, landing, root, marks, day)


def folders(tmp_path):
    return tuple(str(tmp_path / n) for n in ("in", "lake", "marks"))


def test_an_empty_landing_replaces(spark, sample, tmp_path):
    landing, root, marks = folders(tmp_path)
    for rows in (sample["proveedores"], sample["proveedores"].limit(0)):
        files.land({"proveedores": rows}, spark, landing, DAY)
        run(spark, landing, root, marks)
    assert ingest.read_ingested(spark, root, "proveedores").isEmpty()


def test_a_landing_replaces_rows_of_earlier_days(spark, sample, tmp_path):
    landing, root, marks = folders(tmp_path)
    rows = sample["proveedores"]
    for hour in (1, 2):
        files.land({"proveedores": rows}, spark, landing, DAY, hour)
    run(spark, landing, root, marks)
    files.land({"proveedores": rows.limit(3)}, spark, landing, DAY, 2)
    run(spark, landing, root, marks, day="2024-01-16")
    assert ingest.read_ingested(spark, root, "proveedores", DAY).count() == 10
    assert ingest.read_ingested(spark, root, "proveedores", "2024-01-16").count() == 3
    assert ingest.read_ingested(spark, root, "proveedores").count() == 13


def test_files_of_a_landing_wait_for_their_manifest(spark, sample, tmp_path):
    landing, root, marks = folders(tmp_path)
    files.land({"proveedores": sample["proveedores"]}, spark, landing, DAY)
    [manifest] = Path(landing).rglob(f"*{files.MANIFEST}")
    text = manifest.read_text()
    manifest.unlink()
    run(spark, landing, root, marks)
    assert ingest.read_ingested(spark, root, "proveedores").isEmpty()
    manifest.write_text(text)
    run(spark, landing, root, marks)
    assert ingest.read_ingested(spark, root, "proveedores").count() == 10


def test_bad_files_go_to_dead_letters_and_later_ones_are_taken(spark, tmp_path):
    landing, root, marks = folders(tmp_path)
    folder = tmp_path / "in" / "raw" / "proveedores"
    folder.mkdir(parents=True)
    shutil.copy(DATA / "proveedores.csv", folder / "uno.csv")
    (folder / "ajeno.csv").write_text("nombre_proveedor,tipo\na,b\nc,d\n")
    (folder / "roto.csv.gz").write_bytes(b"\x1f\x8b\x08\x00 not gzip")
    columns = S.RAW_COLUMNS["proveedores"][::-1]
    (folder / "vuelto.csv").write_text(f"{','.join(columns)}\ntrue,2024-01-01,1,x,eolica,a\n")
    run(spark, landing, root, marks)
    shutil.copy(DATA / "proveedores.csv", folder / "dos.csv")
    run(spark, landing, root, marks)
    rows = ingest.read_ingested(spark, root, "proveedores")
    assert rows.count() == 21
    assert values(rows.where("_origen like '%vuelto%'"), *columns[-2:]) == [("eolica", "a")]
    bad = ingest.read_dead_letters(spark, root, "proveedores", DAY)
    found = {(x["ruta"].rsplit("/")[-1], x["linea"], x["intentos"]) for x in bad.collect()}
    assert found == {
        ("ajeno.csv", "nombre_proveedor,tipo", 1), ("ajeno.csv", "a,b", 1),
        ("ajeno.csv", "c,d", 1), ("roto.csv.gz", None, 3),
    }
    assert ingest.read_dead_letters(spark, root, "clientes").isEmpty()


def test_a_repeated_batch_changes_nothing(spark, sample, tmp_path):
    """As after a failure: the batch is not in the checkpoint's commits and runs again."""
    landing, root, marks = folders(tmp_path)
    files.land(sample, spark, landing, DAY)
    (tmp_path / "in" / "raw" / "clientes" / "malo.csv").write_text("x\n1\n")
    (tmp_path / "in" / "raw" / "clientes" / "notas.csv").write_text("x\n1\n")
    for _ in range(2):
        ingest.ingest_all(spark, landing, root, marks, None)
        for commit in Path(marks).rglob("commits/*0*"):
            commit.unlink()
    counts = {name: ingest.read_ingested(spark, root, name).count() for name in S.RAW_COLUMNS}
    assert counts == {"proveedores": 10, "clientes": 10, "transacciones": 15}
    assert ingest.read_dead_letters(spark, root, "clientes").count() == 4


def test_one_run_takes_all_tables(spark, sample, tmp_path):
    landing, root, marks = folders(tmp_path)
    files.land(sample, spark, landing, DAY)
    (tmp_path / "in" / "Medidores.csv").write_text("a\n1\n")
    (tmp_path / "in" / "leeme.txt").write_text("no table")
    for _ in range(2):
        ingest.ingest_all(spark, landing, root, marks, DAY)
    counts = {name: ingest.read_ingested(spark, root, name).count() for name in ingest.ALL}
    assert counts == {"proveedores": 10, "clientes": 10, "transacciones": 15, "otros": 2}


def test_streams_with_other_checkpoints_keep_apart(spark, tmp_path):
    landing, root, _ = folders(tmp_path)
    folder = tmp_path / "in" / "raw" / "clientes"
    folder.mkdir(parents=True)
    shutil.copy(DATA / "clientes.csv", folder / "c.csv")
    for marks in ("one", "two"):
        run(spark, landing, root, str(tmp_path / marks), "clientes")
    assert ingest.read_ingested(spark, root, "clientes").count() == 20


def test_a_day_is_read_from_its_own_folder(spark, sample, tmp_path):
    landing, root, marks = folders(tmp_path)
    for day in (DAY, "2024-01-16"):
        files.land({"clientes": sample["clientes"]}, spark, landing, day)
        run(spark, landing, root, marks, "clientes", day=day)
    rows = ingest.read_ingested(spark, root, "clientes", DAY)
    plan = plan_of(rows, "formatted")
    assert len(rows.inputFiles()) == 1 and "fecha=2024-01-16" not in plan
    assert "Join" not in plan and "Aggregate" not in plan
    days = ingest.read_ingested(spark, root, "clientes").selectExpr("CAST(fecha AS STRING)")
    assert set(values(days)) == {(DAY,), ("2024-01-16",)}


def test_counts_of_a_load_add_up(spark, tmp_path):
    landing, root, marks = folders(tmp_path)
    names = ",".join(S.RAW_COLUMNS["proveedores"])
    lines = [
        names, "a,eolica,x,1,2024-01-01,true", "a,eolica,x,2,2023-01-01,true",
        "b,carbon,x,1,2024-01-01,true", "c,nuclear,x,n/d,2024-01-01,true", "d,eolica",
    ]
    folder = tmp_path / "in" / "raw" / "proveedores"
    folder.mkdir(parents=True)
    (folder / "p.csv").write_text("\n".join(lines) + "\n")
    ingest.ingest_all(spark, landing, root, marks, DAY)
    counts = {x["tabla"]: tuple(x)[1:] for x in daily.load_ingested(spark, root, DAY).collect()}
    assert counts["proveedores"] == (5, 1, 1, 1, 2)
    assert counts["clientes"] == counts["transacciones"] == (0, 0, 0, 0, 0)
    assert counts["metricas_energia"] == (None, None, None, None, 0)
    bad = files.read_rejected(spark, root, "proveedores", DAY)
    assert sorted(values(bad, "nombre_proveedor", "motivo")) == [
        ("c", "capacidad_mw"), ("d", S.CORRUPT),
    ]


def test_rows_find_their_landing_without_patterns(spark, sample, tmp_path, monkeypatch):
    """A pattern on the path of each row took more time than all else of an ingest."""
    landing, root, marks = (str(tmp_path / n) for n in ("in", "lake", "marks"))
    files.land({"proveedores": sample["proveedores"]}, spark, landing, DAY)
    shutil.copy(DATA / "proveedores.csv", tmp_path / "in" / "proveedores.csv")

    def pattern(*_):
        raise AssertionError("a pattern on paths")

    monkeypatch.setattr(ingest.F, "regexp_extract", pattern)
    ingest.ingest(spark, "proveedores", landing, root, marks, DAY)
    monkeypatch.undo()
    found = spark.read.parquet(f"{root}/raw/proveedores").groupBy("carga").count().collect()
    assert sorted((x["carga"] == ingest.LOOSE, x["count"]) for x in found) == [(False, 10), (True, 10)]
