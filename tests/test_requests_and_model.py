import datetime
import json

import pytest
from pyspark.sql import functions as F

from shelfcast.catalog import QUERIES, models
from shelfcast.catalog.fixtures import Fixtures
from shelfcast.operators.requests import (
    check_requests,
    model_input,
    rejected_requests,
    select_features,
    valid_requests,
)
from shelfcast.plans import training
from shelfcast.plans.dataset import model_dataset
from shelfcast.plans.scoring import predict, predict_one, response, score_requests
from shelfcast.plans.training import (
    _megabytes,
    evaluate,
    load_model,
    model_features,
    node_statistics_mb,
    save_model,
    split_by_key,
    split_by_time,
    train_forest,
    train_job,
)
from shelfcast.schemas import FEATURES, RAW_REQUEST_SCHEMA, TARGET
from shelfcast.sinks import audit
from shelfcast.sinks.tables import write_dataset
from shelfcast.sources.staging import stage
from shelfcast.streaming.requests import read_requests, score_stream

REQUEST = {
    "id_tienda": 7,
    "id_producto": 23,
    "precio_unitario": 913.2,
    "promocion_activa": 0,
    "descuento_pct": 2.5,
    "temperatura_media": -1.25,
    "lluvia_mm": 6,
    "anio": 1996,
    "mes": 11,
    "dia": 2,
    "dia_semana": 7,
    "es_fin_de_semana": 1,
    "lag_1": 12,
    "lag_7": 41,
    "media_movil_7": 22.75,
}


@pytest.fixture(scope="module")
def dataset(spark):
    return stage(model_dataset(Fixtures(spark, "/root/testdata/sf0.001").tables), "test-dataset")


@pytest.fixture(scope="module")
def model(dataset):
    train, _ = split_by_key(dataset)
    return train_forest(train, trees=5, depth=4)


def raw_requests(spark, changes):
    rows = [{**{k: str(v) for k, v in REQUEST.items()}, **change} for change in changes]
    return spark.createDataFrame([tuple(r[f] for f in FEATURES) for r in rows], RAW_REQUEST_SCHEMA)


def test_request_checks(spark):
    raw = raw_requests(
        spark,
        [
            {},
            {"id_tienda": "3.0"},
            {"id_tienda": "3.5"},
            {"mes": "abril", "lag_1": None},
            {"dia": "99999999999"},
            {"id_producto": "NaN"},
            {"precio_unitario": ""},
            {"lluvia_mm": "NaN"},
            {"lluvia_mm": "Infinity"},
            {"lluvia_mm": "-inf"},
            {"lluvia_mm": "10f"},
            {"lluvia_mm": "1e999"},
            {"lluvia_mm": "1e3", "lag_7": " .5 ", "mes": "1.1e1"},
        ],
    )
    checked = check_requests(raw)
    assert valid_requests(checked).count() == 3
    assert valid_requests(checked).where("lluvia_mm = 1000 AND lag_7 = 0.5").count() == 1
    assert sorted(r.motivos for r in rejected_requests(checked).collect()) == [
        ["dia"],
        ["id_producto"],
        ["id_tienda"],
        *[["lluvia_mm"]] * 5,
        ["mes", "lag_1"],
        ["precio_unitario"],
    ]


def test_absent_field_is_a_fault_of_every_request(spark):
    checked = check_requests(raw_requests(spark, [{}]).drop("mes"))
    assert [r.motivos for r in checked.collect()] == [["mes"]]


def test_feature_selection(dataset):
    assert select_features(dataset).columns == [*FEATURES, TARGET]
    assert select_features(dataset.drop("lag_1", "mes")).columns == [
        *(c for c in FEATURES if c not in ("lag_1", "mes")),
        TARGET,
    ]
    with pytest.raises(ValueError, match=TARGET):
        select_features(dataset.drop(TARGET))
    with pytest.raises(ValueError, match=r"\['mes', 'lag_7'\]"):
        model_input(dataset.drop("lag_7", "mes"))


def test_splits(dataset):
    train, test = split_by_key(dataset)
    total = dataset.count()
    assert train.count() + test.count() == total
    assert 0.76 < train.count() / total < 0.84
    assert train.intersect(test).isEmpty()
    assert split_by_key(dataset.repartition(7))[0].exceptAll(train).isEmpty()
    before, after = split_by_time(dataset)
    assert before.count() + after.count() == total
    assert before.agg(F.max("fecha")).first()[0] < after.agg(F.min("fecha")).first()[0]
    assert before.count() >= 0.8 * total


def test_memory_settings(spark):
    sizes = {"512m": 512, "8g": 8192, "1024k": 1, "2GB": 2048, "1t": 1024**2, str(2**30): 1024}
    assert {size: _megabytes(size) for size in sizes} == sizes
    assert node_statistics_mb(spark) == 256  # 8 GB for four tasks


def test_forest_beats_the_mean(dataset, model):
    _, test = split_by_key(dataset)
    metrics = evaluate(model, test).first()
    assert metrics.r2 > 0
    assert model.stages[-1].getNumTrees == 5
    assert model_features(model) == list(FEATURES)


def test_model_survives_storage(spark, dataset, model, tmp_path, rows):
    path = str(tmp_path / "model")
    save_model(model, path)
    save_model(model, path)  # a second save replaces the first
    assert rows(predict(load_model(path), dataset)) == rows(predict(model, dataset))


def test_training_on_fewer_features(dataset):
    train, test = split_by_key(dataset.drop("lluvia_mm"))
    small = train_forest(train, trees=2, depth=2)
    assert "lluvia_mm" not in model_features(small)
    assert evaluate(small, test).count() == 1


def test_single_prediction_equals_batch(spark, model):
    single = predict_one(spark, model, REQUEST)
    batch = predict(model, valid_requests(check_requests(raw_requests(spark, [{}, {}]))))
    assert [r.prediction for r in batch.collect()] == [single, single]
    assert response(batch).first().prediccion_unidades_vendidas == round(single, 2)
    assert predict_one(spark, model, {**REQUEST, "mes": 11.0}) == single
    with pytest.raises(ValueError, match=r"invalid.*\['mes'\]"):
        predict_one(spark, model, {**REQUEST, "mes": "abril"})
    with pytest.raises(ValueError, match="lag_1"):
        predict_one(spark, model, {k: v for k, v in REQUEST.items() if k != "lag_1"})


def test_batch_scoring_is_audited(spark, model, tmp_path):
    root = str(tmp_path)
    audit.create_tables(spark, root)
    raw = raw_requests(spark, [{}, {}, {"mes": "2", "dia": "30"}, {"lag_7": "x"}])
    for _ in range(2):
        scored, rejected = score_requests(model, raw, root, run_id="a")
    score_requests(model, raw, root, run_id="b")
    assert (scored.count(), rejected.count()) == (3, 1)
    stored = audit.read_audit(spark, root, "predicciones")
    assert stored.groupBy("run_id").count().orderBy("run_id").collect() == [("a", 3), ("b", 3)]
    assert stored.select("id").distinct().count() == 6
    dates = {r.fecha_objetivo for r in stored.collect()}
    assert dates == {datetime.date(1996, 11, 2), None}
    assert stored.where("fecha_prediccion is null").isEmpty()


def test_training_job(spark, dataset, tmp_path):
    paths = {n: str(tmp_path / n) for n in ("dataset", "model", "metrics", "audit")}
    write_dataset(dataset, paths["dataset"])
    metrics = train_job(
        spark,
        dataset_path=paths["dataset"],
        model_path=paths["model"],
        metrics_path=paths["metrics"],
        audit_root=paths["audit"],
        run_id="r",
        trees=3,
        depth=3,
    ).first()
    (file,) = (tmp_path / "metrics").glob("*.json")
    stored = json.loads(file.read_text())
    assert stored == {"MAE": metrics.mae, "RMSE": metrics.rmse, "R2": metrics.r2}
    row = audit.read_audit(spark, paths["audit"], "metricas_modelo").first()
    assert (row.algoritmo, row.mae) == ("RandomForestRegressor", metrics.mae)
    assert load_model(paths["model"]).stages[-1].getNumTrees == 3


def test_train_job_query_trains_one_forest(spark, monkeypatch):
    fits = []

    def counted(train, **options):
        fits.append(train)
        return train_forest(train, trees=2, depth=2)

    for module in (models, training):
        monkeypatch.setattr(module, "train_forest", counted)
    monkeypatch.setattr(models, "_TRAINED", {})
    row = QUERIES["train_job"](spark, "/root/testdata/sf0.001").first()
    assert row.archivo_igual and row.auditoria_igual
    assert len(fits) == 1


def write_requests(directory, name, requests):
    directory.mkdir(exist_ok=True)
    (directory / name).write_text("\n".join(json.dumps(r) for r in requests))


def test_predictions_keep_what_identifies_a_request(spark, model):
    raw = raw_requests(spark, [{}, {"lag_1": "3"}]).withColumn("cliente", F.col("lag_1"))
    got = predict(model, valid_requests(check_requests(raw)))
    assert sorted(r.cliente for r in got.collect()) == ["12", "3"]
    assert response(got).columns[0] == "cliente"
    with pytest.raises(ValueError, match="reserved"):
        predict(model, got)


def test_forest_does_not_depend_on_input_partitions(dataset):
    train, test = split_by_key(dataset)
    trees = [
        train_forest(train.repartition(n), trees=3, depth=3).stages[-1].toDebugString.split("\n", 1)[1]
        for n in (4, 8)
    ]
    assert trees[0] == trees[1]


def test_stream_equals_batch_and_restarts_add_nothing(spark, model, tmp_path):
    source, root, bad = tmp_path / "in", str(tmp_path / "audit"), str(tmp_path / "bad")
    audit.create_tables(spark, root)
    score_requests(model, raw_requests(spark, [{}, {}, {}]), root, run_id="batch")
    first = [{**REQUEST, "lag_1": i} for i in range(20)] + [{**REQUEST, "mes": "x"}]
    write_requests(source, "a.json", [*first, {**REQUEST, "lluvia_mm": "NaN"}])

    def run(marks="c1"):
        checked = read_requests(spark, str(source), max_files=1)
        where = str(tmp_path / marks)
        score_stream(checked, model, root, bad, where, run_id="s").awaitTermination()
        stored = audit.read_audit(spark, root, "predicciones")
        return stored.where("run_id <> 'batch'"), stored, spark.read.parquet(bad)

    for _ in range(2):
        scored, stored, rejected = run()
        assert (scored.count(), rejected.count(), stored.count()) == (20, 2, 23)
    write_requests(source, "b.json", [{**REQUEST, "lag_1": 99}])
    scored, stored, rejected = run()
    assert (scored.count(), rejected.count(), stored.count()) == (21, 2, 24)
    # a stream that has lost its marks writes the same batches again
    scored, stored, rejected = run("c2")
    assert (scored.count(), rejected.count(), stored.count()) == (21, 2, 24)

    raw = spark.read.schema(RAW_REQUEST_SCHEMA).json(str(source))
    batch = predict(model, valid_requests(check_requests(raw)))
    expected = sorted((r.lag_1, r.prediction) for r in batch.collect())
    assert sorted((r.lag_1, r.prediccion_unidades) for r in scored.collect()) == expected
