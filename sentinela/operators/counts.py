"""Entity x month case counts from a line-list (AGG1, AGG2)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentinela.functions.calendar import month_start, year_month_label
from sentinela.functions.numeric import safe_ratio


@dataclass(frozen=True)
class DiagnosisCodes:
    # Line-list diagnosis codes (confirmed, suspect, discarded) and the "yes" flag.
    confirmed: int = 1
    suspect: int = 3
    discarded: int = 0
    yes: int = 1


def case_counts(
    df: DataFrame,
    entity: str,
    date: str | Column,
    diagnosis: str,
    vaccinated: str | None = None,
    complications: str | None = None,
    codes: DiagnosisCodes = DiagnosisCodes(),
    entity_label: Column | None = None,
) -> DataFrame:
    """Counts per (entity, month) with the confirmation rate.

    Rows with a NULL entity or date are dropped first (pandas groupby drops
    NULL keys). ``total_registros`` counts non-NULL diagnoses. The rate is
    confirmed / total, 0 when total is 0. One hash aggregate: partial
    aggregation runs map-side, so a hot entity is combined before the shuffle.
    """
    month = month_start(date)
    dx = F.col(diagnosis)
    base = df.filter(F.col(entity).isNotNull() & month.isNotNull())
    aggs = [
        F.count_if(dx == codes.confirmed).alias("casos_confirmados"),
        F.count_if(dx == codes.suspect).alias("casos_sospechosos"),
        F.count_if(dx == codes.discarded).alias("casos_descartados"),
        F.count(dx).alias("total_registros"),
    ]
    if vaccinated:
        aggs.append(F.count_if(F.col(vaccinated) == codes.yes).alias("vacunados"))
    if complications:
        aggs.append(F.count_if(F.col(complications) == codes.yes).alias("con_complicaciones"))
    keys = [F.col(entity), month.alias("anio_mes_dt")]
    if entity_label is not None:
        keys.append(entity_label.alias("sede"))
    out = base.groupBy(*keys).agg(*aggs)
    return out.select(
        year_month_label("anio_mes_dt").alias("anio_mes"),
        "*",
        safe_ratio("casos_confirmados", "total_registros", 0.0).alias("tasa_confirmacion"),
    )
