"""Registered queries: line-list counts (AGG1-2)."""

from __future__ import annotations

from sentinela.operators.counts import case_counts
from sentinela.plans.bindings import ORDERS_LINELIST_SQL, orders_linelist
from sentinela.plans.registry import query
from sentinela.sources.testdata import Tables

CASE_COUNTS_SQL = f"""
WITH ll AS ({ORDERS_LINELIST_SQL}),
g AS (
  SELECT entidad, CAST(date_trunc('month', fecha) AS DATE) AS anio_mes_dt,
         count_if(DIAGNOSTICO = 1) AS casos_confirmados,
         count_if(DIAGNOSTICO = 3) AS casos_sospechosos,
         count_if(DIAGNOSTICO = 0) AS casos_descartados,
         count(DIAGNOSTICO) AS total_registros,
         count_if(VACUNACION = 1) AS vacunados,
         count_if(COMPLICACIONES = 1) AS con_complicaciones
  FROM ll WHERE entidad IS NOT NULL AND fecha IS NOT NULL GROUP BY 1, 2)
SELECT strftime(anio_mes_dt, '%Y-%m') AS anio_mes, *,
       coalesce(CAST(casos_confirmados AS DOUBLE) / nullif(total_registros, 0), 0.0) AS tasa_confirmacion
FROM g
"""


def monthly_counts(spark, sf_dir):
    ll = orders_linelist(Tables(spark, sf_dir))
    return case_counts(ll, "entidad", "fecha", "DIAGNOSTICO", "VACUNACION", "COMPLICACIONES")


@query("case_counts_monthly", CASE_COUNTS_SQL)
def case_counts_monthly(spark, sf_dir):
    return monthly_counts(spark, sf_dir)
