"""Cleaning, predicates, projections and duplicate removal on soiled tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.catalog.registry import query
from shelfcast.catalog.sql_parts import (
    clean_products,
    clean_promotions,
    clean_sales,
    clean_weather,
    with_history_only,
)
from shelfcast.functions.dates import parse_date
from shelfcast.operators.cleaning import (
    RULES,
    clean_table,
    fill_defaults,
    keep_in_bounds,
    promotion_slice,
    require_values,
)
from shelfcast.operators.dedup import (
    append_rows,
    append_unique,
    drop_identical_rows,
    first_per_key,
    repeated_keys,
)
from shelfcast.operators.lags import add_row_lags, drop_short_history
from shelfcast.operators.requests import (
    REASONS,
    check_requests,
    model_input,
    rejected_requests,
    select_features,
    valid_requests,
)
from shelfcast.plans.dataset import model_dataset
from shelfcast.schemas import FEATURES, SALE_KEYS

FEATURE_LIST = ", ".join(FEATURES)


@query("clean_sales", clean_sales("{ventas_sucias}"))
def _(fx):
    return clean_table("ventas", fx["ventas_sucias"])


@query("clean_promotions", clean_promotions("{promociones_sucias}"))
def _(fx):
    return clean_table("promociones", fx["promociones_sucias"])


@query("clean_weather", clean_weather("{clima_sucio}"))
def _(fx):
    return clean_table("clima", fx["clima_sucio"])


@query("clean_products", clean_products("{productos_sucios}"))
def _(fx):
    return clean_table("productos", fx["productos_sucios"])


@query(
    "parse_dates",
    """SELECT TRY_CAST(fecha AS DATE) AS fecha, id_tienda, id_producto, unidades_vendidas,
       precio_unitario FROM {ventas_sucias}""",
)
def _(fx):
    return parse_date(fx["ventas_sucias"])


@query(
    "require_keys",
    """SELECT * FROM {ventas_sucias} WHERE fecha IS NOT NULL AND id_tienda IS NOT NULL
  AND id_producto IS NOT NULL AND unidades_vendidas IS NOT NULL""",
)
def _(fx):
    return require_values(fx["ventas_sucias"], RULES["ventas"].required)


@query("units_not_negative", "SELECT * FROM {ventas_sucias} WHERE unidades_vendidas >= 0")
def _(fx):
    return keep_in_bounds(fx["ventas_sucias"], {"unidades_vendidas": (0, None)})


@query("price_not_negative", "SELECT * FROM {ventas_sucias} WHERE precio_unitario >= 0")
def _(fx):
    return keep_in_bounds(fx["ventas_sucias"], {"precio_unitario": (0, None)})


@query(
    "discount_default",
    "SELECT * REPLACE (coalesce(descuento_pct, 0) AS descuento_pct) FROM {promociones_sucias}",
)
def _(fx):
    return fill_defaults(fx["promociones_sucias"], RULES["promociones"].defaults)


@query(
    "discount_in_range",
    "SELECT * FROM {promociones_sucias} WHERE descuento_pct BETWEEN 0 AND 100",
)
def _(fx):
    return keep_in_bounds(fx["promociones_sucias"], RULES["promociones"].bounds)


@query(
    "rain_default",
    "SELECT * REPLACE (coalesce(lluvia_mm, 0) AS lluvia_mm) FROM {clima_sucio}",
)
def _(fx):
    return fill_defaults(fx["clima_sucio"], RULES["clima"].defaults)


@query("rain_not_negative", "SELECT * FROM {clima_sucio} WHERE lluvia_mm >= 0")
def _(fx):
    return keep_in_bounds(fx["clima_sucio"], RULES["clima"].bounds)


@query(
    "product_name_default",
    """SELECT * REPLACE (coalesce(nombre_producto, 'Desconocido') AS nombre_producto)
FROM {productos_sucios}""",
)
def _(fx):
    return fill_defaults(fx["productos_sucios"], {"nombre_producto": "Desconocido"})


@query(
    "product_category_default",
    "SELECT * REPLACE (coalesce(categoria, 'Sin categoria') AS categoria) FROM {productos_sucios}",
)
def _(fx):
    return fill_defaults(fx["productos_sucios"], {"categoria": "Sin categoria"})


@query(
    "clean_without_optional_columns",
    """SELECT * FROM (SELECT DISTINCT TRY_CAST(fecha AS DATE) AS fecha, id_tienda, id_producto,
                     unidades_vendidas FROM {ventas_sucias})
WHERE fecha IS NOT NULL AND id_tienda IS NOT NULL AND id_producto IS NOT NULL
  AND unidades_vendidas >= 0""",
)
def _(fx):
    return clean_table("ventas", fx["ventas_sucias"].drop("precio_unitario"))


@query("drop_identical_rows", "SELECT DISTINCT * FROM {ventas_sucias}")
def _(fx):
    return drop_identical_rows(fx["ventas_sucias"])


@query(
    "first_per_key",
    """SELECT fecha, id_tienda, id_producto, promocion_activa, descuento_pct FROM (
  SELECT *, row_number() OVER (PARTITION BY fecha, id_tienda, id_producto
                               ORDER BY descuento_pct, promocion_activa) AS rn
  FROM {promociones_repetidas}) WHERE rn = 1""",
)
def _(fx):
    return first_per_key(fx["promociones_repetidas"], SALE_KEYS, ["descuento_pct"])


@query(
    "repeated_keys",
    """SELECT fecha, id_tienda, id_producto, count(*) AS filas FROM {promociones_repetidas}
GROUP BY 1, 2, 3 HAVING count(*) > 1""",
)
def _(fx):
    return repeated_keys(fx["promociones_repetidas"], SALE_KEYS)


@query(
    "append_rows",
    "SELECT * FROM {productos} UNION ALL SELECT * FROM {productos_nuevos}",
)
def _(fx):
    return append_rows(fx["productos"], fx["productos_nuevos"])


@query(
    "append_unique",
    """SELECT * FROM {productos} UNION ALL SELECT * FROM {productos_nuevos}
WHERE id_producto NOT IN (SELECT id_producto FROM {productos})""",
)
def _(fx):
    return append_unique(fx["productos"], fx["productos_nuevos"], ["id_producto"])


@query("drop_short_history", with_history_only("{historia_densa}"))
def _(fx):
    return drop_short_history(add_row_lags(fx["ventas_densas"]))


@query("promotion_slice", "SELECT * FROM {rellenas_promocion} WHERE promocion_activa = 1")
def _(fx):
    return promotion_slice(_with_flag(fx), True)


@query("no_promotion_slice", "SELECT * FROM {rellenas_promocion} WHERE promocion_activa = 0")
def _(fx):
    return promotion_slice(_with_flag(fx), False)


def _with_flag(fx):
    flags = fx["promociones"].select(*SALE_KEYS, "promocion_activa")
    return fx["ventas"].join(flags, list(SALE_KEYS), "left").withColumn(
        "promocion_activa", F.coalesce("promocion_activa", F.lit(0))
    )


@query("select_features", f"SELECT {FEATURE_LIST}, unidades_vendidas FROM {{dataset}}")
def _(fx):
    return select_features(model_dataset(fx.tables))


@query(
    "select_available_features",
    "SELECT id_tienda, id_producto, precio_unitario, unidades_vendidas FROM {ventas}",
)
def _(fx):
    return select_features(fx["ventas"])


@query("model_input", f"SELECT {FEATURE_LIST} FROM {{dataset}}")
def _(fx):
    return model_input(model_dataset(fx.tables))


@query("valid_requests", f"SELECT {FEATURE_LIST} FROM {{peticiones_revisadas}} WHERE motivos = ''")
def _(fx):
    return valid_requests(check_requests(fx["peticiones"]))


@query(
    "rejected_requests",
    f"SELECT {FEATURE_LIST}, motivos FROM {{peticiones_revisadas}} WHERE motivos <> ''",
)
def _(fx):
    rejected = rejected_requests(check_requests(fx["peticiones"]))
    return rejected.withColumn(REASONS, F.concat_ws(",", REASONS))
