from pathlib import Path

import pytest
from pyspark.errors import AnalysisException

from shelfcast.catalog.fixtures import Fixtures
from shelfcast.operators.cleaning import clean_tables
from shelfcast.schemas import CLEAN_SCHEMAS, DATASET_COLUMNS, RAW_SCHEMAS
from shelfcast.sinks import audit
from shelfcast.sinks.tables import by_month, write_dataset, write_table
from shelfcast.sources import staging
from shelfcast.sources.staging import dropping_staged, new_path, stage, stage_all, staged
from shelfcast.sources.tables import (
    preview,
    read_clean_tables,
    read_model_dataset,
    read_raw_tables,
    read_table,
    unreadable_values,
)

CSV = {
    "ventas": "fecha,id_tienda,id_producto,unidades_vendidas,precio_unitario\n"
    "2025-01-03,1,1,12.5,2.5\nbad,1,2,6,\n",
    "promociones": "fecha,id_tienda,id_producto,promocion_activa,descuento_pct\n"
    "2025-01-03,1,1,1,12.5\n",
    "clima": "fecha,temperatura_media,lluvia_mm\n2025-01-03,9.5,1.0\n2025-01-03,9.5,1.0\n",
    "productos": "id_producto,nombre_producto,categoria\n1,Pan,\n",
}


@pytest.fixture()
def paths(tmp_path):
    for name, text in CSV.items():
        (tmp_path / f"{name}.csv").write_text(text)
    return {name: str(tmp_path / f"{name}.csv") for name in CSV}


@pytest.mark.parametrize("infer", [True, False])
def test_raw_csv_to_clean_tables(spark, paths, tmp_path, rows, infer):
    raw = read_raw_tables(spark, paths, infer=infer)
    if not infer:
        assert {n: df.schema for n, df in raw.as_dict().items()} == RAW_SCHEMAS
    cleaned = clean_tables(raw)
    counts = {name: df.count() for name, df in cleaned.as_dict().items()}
    assert counts == {"ventas": 1, "promociones": 1, "clima": 1, "productos": 1}

    out = {}
    for name, df in cleaned.as_dict().items():
        out[name] = str(tmp_path / f"{name}-limpio")
        write_table(df, out[name], fmt="csv")
    again = read_clean_tables(spark, out, fmt="csv")
    assert again.ventas.schema == CLEAN_SCHEMAS["ventas"] or infer
    assert [r.unidades_vendidas for r in again.ventas.collect()] == [12.5]
    assert [r.descuento_pct for r in again.promociones.collect()] == [12.5]
    assert rows(again.productos) == [(1, "Pan", "Sin categoria")]


def test_columns_are_found_by_name(spark, tmp_path, rows):
    path = tmp_path / "x.csv"
    path.write_text("id_producto,otra,categoria,nombre_producto\n1,z,a,b\n")
    df = read_table(spark, str(path), schema=RAW_SCHEMAS["productos"])
    assert df.columns == ["id_producto", "nombre_producto", "categoria"]
    assert rows(df) == [(1, "b", "a")]


def test_files_of_one_table_need_one_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id_producto,nombre_producto,categoria\n1,a,b\n" * 1)
    (tmp_path / "b.csv").write_text("id_producto,categoria,nombre_producto\n1,b,a\n" * 1)
    with pytest.raises(Exception, match="(?i)header"):
        read_table(spark, str(tmp_path), schema=RAW_SCHEMAS["productos"]).collect()


def test_no_value_is_lost_without_a_word(spark, tmp_path, rows):
    path = str(tmp_path / "v.csv")
    (tmp_path / "v.csv").write_text(
        "precio_unitario,fecha,id_tienda,id_producto,unidades_vendidas\n"
        "2.5,2025-01-03,1,2.0, 12.5 \n,2025-01-04,1,2,\n3,2025-01-05,1.5,2,muchas\n"
    )
    schema = RAW_SCHEMAS["ventas"]
    with pytest.raises(Exception, match="id_tienda|unidades_vendidas"):
        read_table(spark, path, schema=schema).collect()
    lenient = read_table(spark, path, schema=schema, bad="null")
    assert rows(lenient.select("id_tienda", "id_producto", "unidades_vendidas", "precio_unitario")) == [
        (1, 2, 12.5, 2.5),
        (1, 2, None, None),
        (None, 2, None, 3.0),
    ]
    counts = unreadable_values(spark, path, schema).first().asDict()
    assert {k: v for k, v in counts.items() if v} == {"id_tienda": 1, "unidades_vendidas": 1}
    with pytest.raises(ValueError, match="fail or become null"):
        read_table(spark, path, schema=schema, bad="?")


def test_missing_dataset(spark, tmp_path):
    with pytest.raises(AnalysisException):
        read_model_dataset(spark, str(tmp_path / "none"))


def test_preview(spark):
    df = spark.range(100).selectExpr("100 - id AS k")
    assert [r.k for r in preview(df, ["k"], 3).collect()] == [1, 2, 3]


def dataset_like(spark):
    return Fixtures(spark, "/root/testdata/sf0.001")["ventas"].selectExpr(
        *(
            c if c in ("fecha", "id_tienda", "id_producto", "unidades_vendidas", "precio_unitario")
            else "year(fecha) AS anio" if c == "anio"
            else "month(fecha) AS mes" if c == "mes"
            else f"'x' AS {c}" if c in ("nombre_producto", "categoria")
            else f"1 AS {c}"
            for c in DATASET_COLUMNS
        )
    )


def test_dataset_is_written_by_month(spark, tmp_path):
    path = str(tmp_path / "d")
    df = dataset_like(spark)
    assert "RebalancePartitions [anio" in by_month(df)._jdf.queryExecution().analyzed().toString()
    write_dataset(df, path)
    back = read_model_dataset(spark, path)
    assert back.count() == df.count()
    one = back.where("anio = 1996 AND mes = 2")
    assert one.count() == df.where("anio = 1996 AND mes = 2").count() > 0
    assert len(one.inputFiles()) <= len(back.inputFiles())
    assert "PartitionFilters: [isnotnull(anio" in one._jdf.queryExecution().toString()


def test_audit_runs_are_replaced_not_repeated(spark, tmp_path):
    root = str(tmp_path)
    audit.create_tables(spark, root)
    for name, schema in audit.TABLES.items():
        empty = audit.read_audit(spark, root, name)
        assert empty.isEmpty() and empty.schema == schema
    df = dataset_like(spark)
    n = df.count()
    audit.append_dataset(df, root, run_id="a")
    audit.append_dataset(df, root, run_id="a")
    audit.append_dataset(df, root, run_id="b")
    audit.create_tables(spark, root)  # leaves existing rows alone
    stored = audit.read_audit(spark, root, "dataset_modelo")
    assert {r.run_id: r["count"] for r in stored.groupBy("run_id").count().collect()} == {
        "a": n,
        "b": n,
    }
    assert stored.select("id").distinct().count() == 2 * n


def test_staging(spark, tmp_path):
    df = spark.range(10)
    stored = stage(df, "x")
    assert stored.dtypes == df.dtypes and stored.count() == 10
    assert all(spark.conf.get("spark.checkpoint.dir") in f for f in stored.inputFiles())
    assert new_path(spark, "x") != new_path(spark, "x")
    assert [d.count() for d in stage_all(a=df, b=df.limit(3))] == [10, 3]

    with staged(df, "short") as short:
        (file, *_) = short.inputFiles()
        assert short.count() == 10
    assert not Path(file.removeprefix("file://")).exists()
    with dropping_staged(spark):
        gone = [f.removeprefix("file://") for d in (stage(df, "a"), stage(df, "b")) for f in d.inputFiles()]
        assert all(Path(f).exists() for f in gone)
    assert not any(Path(f).exists() for f in gone)
    with pytest.raises(ValueError, match="not a staged table"):
        staging.drop_path(spark, str(tmp_path))


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Session:
        conf = Conf({"spark.master": "local-cluster[2,1,512]"})

    with pytest.raises(ValueError, match="checkpoint.dir"):
        staging.shared_folder(Session())
    Session.conf["spark.master"] = "local[2]"
    assert staging.shared_folder(Session()) == staging.shared_folder(Session())
