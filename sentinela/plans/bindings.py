"""How the test tables stand in for the surveillance inputs.

* ``orders`` is the case line-list: entity = ``o_orderpriority``, event date =
  ``o_orderdate``, diagnosis from ``o_orderstatus`` (F confirmed, P suspect,
  O discarded); vaccinated / complications flags from price bands.
* ``lineitem`` gives the mobility (passenger) series and the weekly
  cumulative bulletin counts (disease = return flag, sex = line status).
* ``events`` gives daily series per event type for the anomaly detectors.
* ``nation`` / ``region`` / ``customer`` give country and city dimensions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentinela.functions.calendar import month_start
from sentinela.sources.testdata import Tables

# Fixed values for the bindings (price bands that stand for the yes/no flags).
VACCINATED_MIN_PRICE = 250000.0
COMPLICATION_MIN_PRICE = 400000.0


def orders_linelist(t: Tables) -> DataFrame:
    o = t.orders
    return o.select(
        F.col("o_orderpriority").alias("entidad"),
        F.col("o_orderdate").cast("date").alias("fecha"),
        F.when(F.col("o_orderstatus") == "F", 1)
        .when(F.col("o_orderstatus") == "P", 3)
        .when(F.col("o_orderstatus") == "O", 0)
        .alias("DIAGNOSTICO"),
        F.when(F.col("o_totalprice") >= VACCINATED_MIN_PRICE, 1).otherwise(2).alias("VACUNACION"),
        F.when(F.col("o_totalprice") >= COMPLICATION_MIN_PRICE, 1).otherwise(2).alias("COMPLICACIONES"),
    )


ORDERS_LINELIST_SQL = f"""
SELECT o_orderpriority AS entidad, CAST(o_orderdate AS DATE) AS fecha,
       CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'P' THEN 3 WHEN 'O' THEN 0 END AS DIAGNOSTICO,
       CASE WHEN o_totalprice >= {VACCINATED_MIN_PRICE} THEN 1 ELSE 2 END AS VACUNACION,
       CASE WHEN o_totalprice >= {COMPLICATION_MIN_PRICE} THEN 1 ELSE 2 END AS COMPLICACIONES
FROM orders
"""


def monthly_quantity(t: Tables) -> DataFrame:
    """National mobility series: total shipped quantity per month."""
    li = t.lineitem
    return li.groupBy(month_start("l_shipdate").alias("fecha")).agg(F.sum("l_quantity").alias("pasajeros"))


MONTHLY_QUANTITY_SQL = """
SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS fecha, sum(l_quantity) AS pasajeros
FROM lineitem GROUP BY 1
"""
