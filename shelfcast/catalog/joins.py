"""Joins, look-ups, the day grid and the fills after the joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.catalog.registry import query
from shelfcast.operators.cleaning import clean_tables
from shelfcast.operators.fills import fill_missing, fill_temperature, fill_zeros
from shelfcast.operators.joins import (
    attach_products,
    attach_promotions,
    attach_weather,
    day_grid,
    lookup_base_price,
    lookup_category,
    lookup_discount,
    merge_tables,
    products_without_price,
)
from shelfcast.sources.staging import stage


@query(
    "join_promotions",
    "SELECT * FROM {ventas} LEFT JOIN {promociones} USING (fecha, id_tienda, id_producto)",
)
def _(fx):
    return attach_promotions(fx["ventas"], fx["promociones"])


@query(
    "join_promotions_repeated_keys",
    """SELECT * FROM {ventas}
LEFT JOIN {promociones_repetidas} USING (fecha, id_tienda, id_producto)""",
)
def _(fx):
    return attach_promotions(fx["ventas"], fx["promociones_repetidas"])


@query("join_weather", "SELECT * FROM {ventas} LEFT JOIN {clima} USING (fecha)")
def _(fx):
    return attach_weather(fx["ventas"], fx["clima"])


@query("join_weather_shuffled", "SELECT * FROM {ventas} LEFT JOIN {clima} USING (fecha)")
def _(fx):
    """The path for a weather table too large to broadcast."""
    return attach_weather(fx["ventas"], fx["clima"].hint("merge"), limit=-1)


@query("join_products", "SELECT * FROM {ventas} LEFT JOIN {productos} USING (id_producto)")
def _(fx):
    return attach_products(fx["ventas"], fx["productos"])


@query("merge_tables", "SELECT * FROM {unidas}")
def _(fx):
    return merge_tables(clean_tables(fx.tables))


@query(
    "lookup_discount",
    """SELECT v.*, coalesce(p.descuento_pct, 0) AS descuento_pct FROM {ventas} v
LEFT JOIN (SELECT fecha, id_tienda, id_producto, min(descuento_pct) AS descuento_pct
           FROM {promociones_repetidas} GROUP BY 1, 2, 3) p
  USING (fecha, id_tienda, id_producto)""",
)
def _(fx):
    return lookup_discount(fx["ventas"], fx["promociones_repetidas"])


@query(
    "lookup_category",
    "SELECT v.*, p.categoria FROM {ventas} v JOIN {productos} p USING (id_producto)",
)
def _(fx):
    return lookup_category(fx["ventas"], fx["productos"])


@query(
    "day_grid",
    """SELECT CAST(d.fecha AS DATE) AS fecha, CAST(t.id_tienda AS INTEGER) AS id_tienda, p.id_producto
FROM {productos} p, range(1, 4) t(id_tienda),
  (SELECT unnest(generate_series(min(fecha), max(fecha), INTERVAL 1 DAY)) AS fecha
   FROM {ventas}) d""",
)
def _(fx):
    first = fx["ventas"].agg(F.min("fecha")).scalar()
    last = fx["ventas"].agg(F.max("fecha")).scalar()
    return day_grid(fx["productos"], first, last, stores=3)


@query(
    "lookup_base_price",
    "SELECT v.*, p.precio_base FROM {ventas} v LEFT JOIN {precios} p USING (id_producto)",
)
def _(fx):
    return lookup_base_price(fx["ventas"], fx["precios"])


@query(
    "products_without_price",
    """SELECT DISTINCT id_producto FROM {ventas}
WHERE id_producto NOT IN (SELECT id_producto FROM {precios})""",
)
def _(fx):
    return products_without_price(fx["ventas"], fx["precios"])


@query(
    "fill_zeros",
    """SELECT * REPLACE (coalesce(promocion_activa, 0) AS promocion_activa,
                  coalesce(descuento_pct, 0) AS descuento_pct, coalesce(lluvia_mm, 0) AS lluvia_mm)
FROM {unidas}""",
)
def _(fx):
    return fill_zeros(merge_tables(clean_tables(fx.tables)))


@query(
    "fill_temperature",
    """SELECT * REPLACE (coalesce(temperatura_media, (SELECT m FROM {mediana}))
                  AS temperatura_media) FROM {unidas}""",
)
def _(fx):
    return fill_temperature(merge_tables(clean_tables(fx.tables)))


@query("fill_missing", "SELECT * FROM {rellenas}")
def _(fx):
    return fill_missing(stage(merge_tables(clean_tables(fx.tables)), "joined"))
