import json
from pathlib import Path

from pyspark.sql import functions as F

from shelfcast import jobs
from shelfcast.catalog.fixtures import Fixtures
from shelfcast.plans.dataset import model_dataset
from shelfcast.schemas import DATASET_COLUMNS, FEATURES
from shelfcast.sinks import audit
from shelfcast.sinks.tables import write_table
from shelfcast.sources.tables import RetailTables, read_model_dataset


def test_pipeline_from_csv_files_to_predictions(spark, tmp_path, rows):
    at = lambda name: str(tmp_path / name)
    tables = Fixtures(spark, "/root/testdata/sf0.001").tables
    # decimals, and columns in another order than the schema has
    halves = tables.ventas.withColumn("unidades_vendidas", F.col("unidades_vendidas") + 0.5)
    tables = RetailTables(halves, tables.promociones, tables.clima, tables.productos)
    for name, df in tables.map(lambda _, df: df.select(*reversed(df.columns))).as_dict().items():
        write_table(df, f"{at('raw')}/{name}.csv", fmt="csv")

    staged = Path(spark.conf.get("spark.checkpoint.dir")) / "shelfcast"
    expected = model_dataset(tables)
    before = set(staged.glob("*"))
    jobs.main(["clean", "--raw", at("raw"), "--out", at("clean")])
    jobs.main(["features", "--clean", at("clean"), "--out", at("dataset")])
    dataset = read_model_dataset(spark, at("dataset")).select(*DATASET_COLUMNS)
    units = dataset.unidades_vendidas.cast("double")
    assert rows(dataset.select("fecha", "id_tienda", "id_producto", units, "media_movil_7")) == (
        rows(expected.select("fecha", "id_tienda", "id_producto", "unidades_vendidas", "media_movil_7"))
    )

    jobs.main(
        ["train", "--dataset-path", at("dataset"), "--model-path", at("model"), "--metrics-path",
         at("metrics"), "--audit-root", at("audit"), "--run-id", "r", "--trees", "2"]
    )
    jobs.main(["audit", "--dataset", at("dataset"), "--root", at("audit"), "--run-id", "r"])
    assert audit.read_audit(spark, at("audit"), "dataset_modelo").count() == expected.count()

    (tmp_path / "requests").mkdir()
    good = {name: 1 for name in FEATURES}
    lines = [good, {**good, "mes": "x"}]
    (tmp_path / "requests" / "a.json").write_text("\n".join(map(json.dumps, lines)))
    scoring = ["--requests", at("requests"), "--model", at("model"), "--run-id", "p"]
    jobs.main(["score", *scoring, "--root", at("audit"), "--rejected", at("bad")])
    jobs.main(
        ["stream", *scoring, "--root", at("audit"), "--rejected", at("live-bad"), "--checkpoint",
         at("marks")]
    )
    stored = audit.read_audit(spark, at("audit"), "predicciones")
    by_run = {r.run_id: r.prediccion_unidades for r in stored.collect()}
    assert set(by_run) == {"p", "p-0"} and by_run["p"] == by_run["p-0"]
    assert spark.read.parquet(at("bad")).count() == spark.read.parquet(at("live-bad")).count() == 1

    # a second run keeps the quarantine of the first, a repeated one adds nothing
    again = ["score", *scoring[:-1], "p2", "--root", at("audit"), "--rejected", at("bad")]
    for _ in range(2):
        jobs.main(again)
    bad = spark.read.parquet(at("bad"))
    assert sorted(r.lote for r in bad.collect()) == ["p", "p2"]
    jobs.main(["compact", "--root", at("audit")])
    assert len(audit.read_audit(spark, at("audit"), "predicciones").inputFiles()) == 1

    jobs.main(["refresh", "--clean", at("clean"), "--store", at("store"), "--out", at("kept")])
    kept = read_model_dataset(spark, at("kept")).select(*DATASET_COLUMNS)
    assert rows(kept) == rows(dataset)

    jobs.main(["reports", "--root", at("audit"), "--out", at("reports"), "--rows", "3"])
    counts = {n: spark.read.parquet(f"{at('reports')}/{n}").count() for n in audit.TABLES}
    assert counts == {"dataset_modelo": 3, "predicciones": 3, "metricas_modelo": 1}
    # nothing that the jobs staged is left
    assert set(staged.glob("*")) == before
