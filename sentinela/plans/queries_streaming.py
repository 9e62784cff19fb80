"""Registered query: the incremental (Structured Streaming) line-list counter
run over files written from the orders table; its result must equal the
batch counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from sentinela.plans.registry import query
from sentinela.session import scratch_path
from sentinela.sources.testdata import Tables
from sentinela.streaming.incremental import read_counts, start_counts

# Binding: orders below this price carry a pending diagnosis date (the
# sentinel), so their month comes from the update date (end of the same month).
PENDING_BELOW = 100000.0

STREAM_SQL = f"""
WITH ll AS (
  SELECT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS ENTIDAD_RES,
         CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'P' THEN 3 WHEN 'O' THEN 0 END AS dx,
         CASE WHEN o_totalprice >= 250000.0 THEN 1 ELSE 2 END AS vac,
         CASE WHEN o_totalprice >= 400000.0 THEN 1 ELSE 2 END AS comp,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS anio_mes_dt
  FROM orders),
g AS (SELECT ENTIDAD_RES, anio_mes_dt, count_if(dx = 1) AS casos_confirmados, count_if(dx = 3) AS casos_sospechosos,
             count_if(dx = 0) AS casos_descartados, count(dx) AS total_registros, count_if(vac = 1) AS vacunados,
             count_if(comp = 1) AS con_complicaciones
      FROM ll GROUP BY 1, 2)
SELECT strftime(anio_mes_dt, '%Y-%m') AS anio_mes, *,
       coalesce(CAST(casos_confirmados AS DOUBLE) / nullif(total_registros, 0), 0.0) AS tasa_confirmacion
FROM g
"""


@query("streaming_counts", STREAM_SQL)
def streaming_counts(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    d = F.col("o_orderdate").cast("date")
    files = o.select(
        F.substring("o_orderpriority", 1, 1).alias("ENTIDAD_RES"),
        F.when(F.col("o_orderstatus") == "F", "1").when(F.col("o_orderstatus") == "P", "3")
         .when(F.col("o_orderstatus") == "O", "0").alias("DIAGNOSTICO"),
        F.when(F.col("o_totalprice") >= 250000.0, "1").otherwise("2").alias("VACUNACION"),
        F.when(F.col("o_totalprice") >= 400000.0, "1").otherwise("2").alias("COMPLICACIONES"),
        F.when(F.col("o_totalprice") < PENDING_BELOW, F.lit("9999-99-99"))
         .otherwise(F.date_format(d, "yyyy-MM-dd")).alias("FECHA_DIAGNOSTICO"),
        F.date_format(F.last_day(d), "yyyy-MM-dd").alias("FECHA_ACTUALIZACION"))
    landing, out, ckpt = (scratch_path(spark, n) for n in ("landing", "counts", "stream-ckpt"))
    # several files land in the folder; the stream picks up each exactly once
    files.write.option("header", True).csv(landing)
    start_counts(spark, landing, out, ckpt).awaitTermination()
    return read_counts(spark, out)
