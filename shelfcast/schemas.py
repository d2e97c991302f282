"""Column contracts of every table the library reads or writes.

The names and types below are fixed values: they are what existing files,
requests and audit tables use.
"""

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

STRING, INT, DOUBLE = StringType(), IntegerType(), DoubleType()
DATE, TIMESTAMP = DateType(), TimestampType()


def _struct(**columns) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


# Dates of raw files stay text until cleaning, so that a bad date loses one row, not the job.
# Units and discounts may have decimals.
RAW_SCHEMAS = {
    "ventas": _struct(
        fecha=STRING,
        id_tienda=INT,
        id_producto=INT,
        unidades_vendidas=DOUBLE,
        precio_unitario=DOUBLE,
    ),
    "promociones": _struct(
        fecha=STRING, id_tienda=INT, id_producto=INT, promocion_activa=INT, descuento_pct=DOUBLE
    ),
    "clima": _struct(fecha=STRING, temperatura_media=DOUBLE, lluvia_mm=DOUBLE),
    "productos": _struct(id_producto=INT, nombre_producto=STRING, categoria=STRING),
}

# Cleaned tables keep the columns; their dates are dates.
CLEAN_SCHEMAS = {
    name: StructType([StructField(f.name, DATE if f.name == "fecha" else f.dataType) for f in raw])
    for name, raw in RAW_SCHEMAS.items()
}

GROUP_KEYS = ("id_tienda", "id_producto")
SALE_KEYS = ("fecha", "id_tienda", "id_producto")
TARGET = "unidades_vendidas"
SALE_COLUMNS = (*SALE_KEYS, TARGET, "precio_unitario", "promocion_activa", "descuento_pct")
LAG_COLUMNS = ("lag_1", "lag_7", "media_movil_7")

DATASET_COLUMNS = (
    "id_producto",
    "fecha",
    "id_tienda",
    "unidades_vendidas",
    "precio_unitario",
    "promocion_activa",
    "descuento_pct",
    "temperatura_media",
    "lluvia_mm",
    "nombre_producto",
    "categoria",
    "anio",
    "mes",
    "dia",
    "dia_semana",
    "es_fin_de_semana",
    "lag_1",
    "lag_7",
    "media_movil_7",
)

REQUEST_SCHEMA = _struct(
    id_tienda=INT,
    id_producto=INT,
    precio_unitario=DOUBLE,
    promocion_activa=INT,
    descuento_pct=DOUBLE,
    temperatura_media=DOUBLE,
    lluvia_mm=DOUBLE,
    anio=INT,
    mes=INT,
    dia=INT,
    dia_semana=INT,
    es_fin_de_semana=INT,
    lag_1=DOUBLE,
    lag_7=DOUBLE,
    media_movil_7=DOUBLE,
)
FEATURES = tuple(REQUEST_SCHEMA.names)

# Requests as they arrive: any value may be missing or of the wrong type.
RAW_REQUEST_SCHEMA = _struct(**{name: STRING for name in FEATURES})

AUDIT_DATASET = _struct(
    id=STRING,
    fecha=DATE,
    id_tienda=INT,
    id_producto=INT,
    unidades_vendidas=DOUBLE,
    precio_unitario=DOUBLE,
    promocion_activa=INT,
    descuento_pct=DOUBLE,
    temperatura_media=DOUBLE,
    lluvia_mm=DOUBLE,
    nombre_producto=STRING,
    categoria=STRING,
    anio=INT,
    mes=INT,
    dia=INT,
    dia_semana=INT,
    es_fin_de_semana=INT,
    lag_1=DOUBLE,
    lag_7=DOUBLE,
    media_movil_7=DOUBLE,
    run_id=STRING,
)

AUDIT_PREDICTIONS = _struct(
    id=STRING,
    fecha_prediccion=TIMESTAMP,
    fecha_objetivo=DATE,
    id_tienda=INT,
    id_producto=INT,
    prediccion_unidades=DOUBLE,
    precio_unitario=DOUBLE,
    promocion_activa=INT,
    descuento_pct=DOUBLE,
    temperatura_media=DOUBLE,
    lluvia_mm=DOUBLE,
    anio=INT,
    mes=INT,
    dia=INT,
    dia_semana=INT,
    es_fin_de_semana=INT,
    lag_1=DOUBLE,
    lag_7=DOUBLE,
    media_movil_7=DOUBLE,
    run_id=STRING,
)

AUDIT_METRICS = _struct(
    id=STRING,
    fecha_entrenamiento=TIMESTAMP,
    algoritmo=STRING,
    mae=DOUBLE,
    rmse=DOUBLE,
    r2=DOUBLE,
    run_id=STRING,
)
