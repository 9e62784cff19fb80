"""Isolation forest as tables (ANO1).

Every random choice is a draw: a number in (0, 1) from the MD5 of the seed and
what it is for, the same on every engine and in every retry. The model is a table
of boxes, one row a leaf: tree, lower and upper bound of each feature, path
length. All levels of all trees are split by windows over (group, tree, node)
after one shuffle on (group, tree); no tree sees more than about
OVERSAMPLE * max_samples rows. Rows are scored by a range join with the boxes of
their group and an average. Nothing is collected.

Splits are uniform over a feature's range, so features need no scaling.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentinela.operators.scaling import attach, quantile
from sentinela.sinks.writers import checkpoint_parquet

#: Rows offered to a tree for each row it takes.
OVERSAMPLE = 4
#: Digits of a score: ties do not depend on the order of summation.
DIGITS = 9
EULER = 0.5772156649015329


def draw(*parts: Column) -> Column:
    """A number strictly between 0 and 1: 52 bits of the MD5 of the parts, joined by ``|``."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(2.0**52)


def _draw_sql(*parts: str) -> str:
    """``draw`` as an expression string."""
    text = ", ".join(f"coalesce(CAST({p} AS STRING), '')" for p in parts)
    return f"((CAST(conv(substring(md5(concat_ws('|', {text})), 1, 13), 16, 10) AS DOUBLE) + 0.5D) / 4503599627370496D)"


def mean_path(n: Column) -> Column:
    """Average path of an unsuccessful search among n points."""
    more = 2 * (F.log(n - 1.0) + EULER) - 2 * (n - 1.0) / n
    return F.when(n <= 1, 0.0).when(n == 2, 1.0).otherwise(more)


def _joined(df: DataFrame, stats: DataFrame, group: list[str]) -> DataFrame:
    """``df`` with a written table of its groups; null keys are a group."""
    keys = _keys(group)
    return df.join(stats.withColumnsRenamed(keys), [F.col(c).eqNullSafe(F.col(k)) for c, k in keys.items()], "left").drop(*keys.values())


def _keys(group: list[str]) -> dict[str, str]:
    return {c: f"_key_{c}" for c in group}


def forest_boxes(df: DataFrame, group: list[str], features: list[str], row_id: str, n_trees: int = 100, max_samples: int = 256, seed: int = 42) -> DataFrame:
    """The fitted model: (group, tree, psi, depth, size, path, lo_i, hi_i for the
    i-th feature), one row a leaf, a null bound is open.

    A row's place is a draw of its id; tree t takes the psi = min(max_samples, n)
    rows of the group that come next after t / n_trees on the unit circle. A node
    splits a feature that varies, at a draw between its least and largest value,
    until ceil(log2(psi)) levels, one row, or no feature that varies. Null features
    count as 0; null keys are a group; an empty table gives no boxes."""
    d = len(features)
    values = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"_x{i}") for i, c in enumerate(features)]
    rows = df.select(*group, F.col(row_id).cast("string").alias("_rid"), *values)
    sizes = checkpoint_parquet(rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")), "forest-groups")
    known = _joined(rows, sizes, group)
    psi = F.least(F.col("_n"), F.lit(max_samples))
    known = known.select("*", psi.alias("_psi"), F.least(F.lit(1.0), OVERSAMPLE * psi / F.col("_n")).alias("_share"),
                         draw(F.lit(seed), F.lit("row"), *[F.col(c) for c in group], F.col("_rid")).alias("_u"))
    steps = F.sequence(F.lit(0), F.least(F.lit(n_trees - 1), F.ceil(F.col("_share") * n_trees).cast("int")))
    offered = known.select("*", F.explode(steps).alias("_step"))
    offered = offered.withColumn("_tree", F.pmod(F.floor(F.col("_u") * n_trees).cast("int") - F.col("_step"), F.lit(n_trees)))
    behind = F.col("_u") - F.col("_tree") / F.lit(float(n_trees))
    offered = offered.withColumn("_place", F.when(behind < 0, behind + 1.0).otherwise(behind)).where(F.col("_place") < F.col("_share"))
    offered = offered.drop("_step", "_u", "_share", "_n").repartition(*group, "_tree")
    first = F.row_number().over(Window.partitionBy(*group, "_tree").orderBy("_place", "_rid"))
    now = offered.withColumn("_taken", first).where(F.col("_taken") <= F.col("_psi")).drop("_taken", "_place", "_rid")
    bounds = F.array(*[F.lit(None).cast("double")] * d)
    now = now.withColumns({"_node": F.lit(1).cast("bigint"), "_depth": F.lit(0), "_done": F.lit(False), "_lo": bounds, "_hi": bounds})
    most = min(sizes.agg(F.max("_n")).first()[0] or 0, max_samples)  # one number: no more levels than the largest sample needs
    every = lambda form: [form.format(i=i) for i in range(d)]
    node = f"OVER (PARTITION BY {', '.join(f'`{c}`' for c in group)}, _tree, _node)"
    varies = f"filter(array({', '.join(every('IF(_max{i} > _min{i}, {i}, NULL)'))}), i -> i IS NOT NULL)"
    one = lambda kind: f"element_at(array({', '.join(every(f'_{kind}{{i}}'))}), _feature + 1)"
    drawn = lambda what: _draw_sql(f"'{seed}'", f"'{what}'", *[f"`{c}`" for c in group], "_tree", "_node")
    kept = [*[f"`{c}`" for c in group], "_tree", "_psi", *every("_x{i}")]
    level = 0
    while 2**level < max(most, 2):
        seen = now.selectExpr("*", f"count(1) {node} AS _size", *every(f"min(_x{{i}}) {node} AS _min{{i}}"), *every(f"max(_x{{i}}) {node} AS _max{{i}}"))
        seen = seen.selectExpr("*", f"{varies} AS _varies")
        splits = f"NOT _done AND _size > 1 AND size(_varies) > 0 AND greatest(_psi, 2) > {2**level}"
        seen = seen.selectExpr("*", f"CASE WHEN {splits} THEN element_at(_varies, CAST(floor({drawn('feature')} * size(_varies)) AS INT) + 1) END AS _feature")
        seen = seen.selectExpr("*", f"{one('min')} + {drawn('cut')} * ({one('max')} - {one('min')}) AS _cut")
        seen = seen.selectExpr(*kept, "_node", "_depth", "_lo", "_hi", "_feature", "_cut", f"{one('x')} >= _cut AS _right")
        now = seen.selectExpr(*kept, "CASE WHEN _feature IS NULL THEN _node ELSE _node * 2 + CAST(_right AS INT) END AS _node",
                              "_depth + IF(_feature IS NULL, 0, 1) AS _depth", "_feature IS NULL AS _done",
                              "transform(_lo, (v, i) -> IF(_right AND i = _feature, _cut, v)) AS _lo",
                              "transform(_hi, (v, i) -> IF(NOT _right AND i = _feature, _cut, v)) AS _hi")
        level += 1
    leaves = now.groupBy(*group, "_tree", "_node").agg(F.max("_psi").alias("psi"), F.max("_depth").alias("depth"), F.count(F.lit(1)).alias("size"),
                                                       F.max("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
    return leaves.select(*group, F.col("_tree").alias("tree"), "psi", "depth", "size", (F.col("depth") + mean_path(F.col("size"))).alias("path"),
                         *[F.col(f"_{k}")[i].alias(f"{k}_{i}") for k in ("lo", "hi") for i in range(d)])


def forest_scores(df: DataFrame, boxes: DataFrame, group: list[str], features: list[str], row_id: str) -> DataFrame:
    """(group, row_id, ``score``): -2^(-E / c(psi)) of the mean path E over the boxes
    that hold the row, one of each tree; higher is more normal. The averages
    are summed where the join makes its rows."""
    keys = _keys(group)
    model = boxes.withColumnsRenamed(keys)
    rows = df.select(*group, F.col(row_id).alias("_rid"), *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"_x{i}") for i, c in enumerate(features)])
    inside = [F.col(c).eqNullSafe(F.col(k)) for c, k in keys.items()]
    for i in range(len(features)):
        inside += [F.col(f"lo_{i}").isNull() | (F.col(f"_x{i}") >= F.col(f"lo_{i}")), F.col(f"hi_{i}").isNull() | (F.col(f"_x{i}") < F.col(f"hi_{i}"))]
    paths = rows.join(model, inside).groupBy(*group, "_rid").agg(F.avg("path").alias("_e"), F.max("psi").alias("_psi"))
    norm = mean_path(F.col("_psi"))
    return paths.select(*group, F.col("_rid").alias(row_id), F.bround(-F.pow(F.lit(2.0), -F.col("_e") / F.when(norm > 0, norm).otherwise(1.0)), DIGITS).alias("score"))


def isolation_forest(df: DataFrame, group: list[str], features: list[str], row_id: str, n_trees: int = 100, max_samples: int = 256,
                     contamination: float = 0.10, seed: int = 42) -> DataFrame:
    """``df`` with ``if_score`` (score less the group's ``contamination`` quantile,
    exact and interpolated) and ``anomalia_if`` (score below it). ``row_id`` must be
    unique within a group. A group of one row is not anomalous."""
    boxes = checkpoint_parquet(forest_boxes(df, group, features, row_id, n_trees, max_samples, seed), "forest-boxes")
    scores = checkpoint_parquet(forest_scores(df, boxes, group, features, row_id), "forest-scores")
    scores = attach(scores, quantile(scores, "score", contamination, group, "_threshold"), group)
    keys = _keys([*group, row_id])
    known = scores.select(*[F.col(c).alias(k) for c, k in keys.items()], (F.col("score") - F.col("_threshold")).alias("if_score"))
    out = df.join(known, [F.col(c).eqNullSafe(F.col(k)) for c, k in keys.items()], "left").drop(*keys.values())
    return out.withColumn("anomalia_if", F.col("if_score") < 0)


def forest_sql(rows: str, group: str, row_id: str, features: list[str], n_trees: int = 100, max_samples: int = 256, seed: int = 42) -> str:
    """The same forest as DuckDB common table expressions, from a table ``rows``
    with one group column: ``boxes`` as the model, ``scored`` (group, row_id, score)."""
    d = range(len(features))
    every = lambda form, sep=", ": sep.join(form.format(i=i) for i in d)
    chance = lambda *parts: ("((CAST('0x' || substr(md5(concat_ws('|', " + ", ".join(f"coalesce(CAST({p} AS VARCHAR), '')" for p in parts)
                             + ")), 1, 13) AS BIGINT) + CAST(0.5 AS DOUBLE)) / 4503599627370496)")
    path = lambda n: f"(CASE WHEN {n} <= 1 THEN 0.0 WHEN {n} = 2 THEN 1.0 ELSE 2 * (ln({n} - CAST(1 AS DOUBLE)) + {EULER}) - 2 * ({n} - CAST(1 AS DOUBLE)) / {n} END)"
    values = ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0) AS x{i}" for i, c in enumerate(features))
    ctes = [f"base AS (SELECT {group} AS g, CAST({row_id} AS VARCHAR) AS rid, {values}, count(*) OVER (PARTITION BY {group}) AS n FROM {rows})",
            f"placed AS (SELECT *, least(n, {max_samples}) AS psi, least(CAST(1 AS DOUBLE), {OVERSAMPLE} * least(n, {max_samples}) / CAST(n AS DOUBLE)) AS share, "
            f"tree, {chance(seed, repr('row'), 'g', 'rid')} - tree / CAST({n_trees} AS DOUBLE) AS behind FROM base, range({n_trees}) t(tree))",
            "offered AS (SELECT *, CASE WHEN behind < 0 THEN behind + 1 ELSE behind END AS place FROM placed WHERE CASE WHEN behind < 0 THEN behind + 1 ELSE behind END < share)",
            f"l0 AS (SELECT g, tree, psi, {every('x{i}')}, CAST(1 AS BIGINT) AS node, 0 AS depth, false AS done, {every('CAST(NULL AS DOUBLE) AS lo{i}')}, "
            f"{every('CAST(NULL AS DOUBLE) AS hi{i}')} FROM offered QUALIFY row_number() OVER (PARTITION BY g, tree ORDER BY place, rid) <= psi)"]
    level = 0
    while 2**level < max(max_samples, 2):
        varies = "list_concat(" * (len(features) - 1) + f"CASE WHEN b0 > a0 THEN [0] ELSE [] END" + "".join(f", CASE WHEN b{i} > a{i} THEN [{i}] ELSE [] END)" for i in d if i)
        of = lambda form: "CASE f " + every("WHEN {i} THEN " + form, " ") + " END"
        ctes += [f"s{level} AS (SELECT *, count(*) OVER w AS size, {every('min(x{i}) OVER w AS a{i}')}, {every('max(x{i}) OVER w AS b{i}')} FROM l{level} WINDOW w AS (PARTITION BY g, tree, node))",
                 f"v{level} AS (SELECT *, {varies} AS varies FROM s{level})",
                 f"f{level} AS (SELECT *, CASE WHEN NOT done AND size > 1 AND len(varies) > 0 AND greatest(psi, 2) > {2**level} "
                 f"THEN varies[CAST(floor({chance(seed, repr('feature'), 'g', 'tree', 'node')} * len(varies)) AS INTEGER) + 1] END AS f FROM v{level})",
                 f"c{level} AS (SELECT *, {of('a{i}')} + {chance(seed, repr('cut'), 'g', 'tree', 'node')} * ({of('b{i}')} - {of('a{i}')}) AS cut FROM f{level})",
                 f"r{level} AS (SELECT *, {of('x{i}')} >= cut AS r FROM c{level})",
                 f"l{level + 1} AS (SELECT g, tree, psi, {every('x{i}')}, CASE WHEN f IS NULL THEN node ELSE node * 2 + CAST(r AS BIGINT) END AS node, "
                 f"depth + CASE WHEN f IS NULL THEN 0 ELSE 1 END AS depth, f IS NULL AS done, {every('CASE WHEN r AND f = {i} THEN cut ELSE lo{i} END AS lo{i}')}, "
                 f"{every('CASE WHEN NOT r AND f = {i} THEN cut ELSE hi{i} END AS hi{i}')} FROM r{level})"]
        level += 1
    inside = every("(lo{i} IS NULL OR x{i} >= lo{i}) AND (hi{i} IS NULL OR x{i} < hi{i})", " AND ")
    ctes += [f"boxes AS (SELECT g, tree, node, any_value(psi) AS psi, any_value(depth) AS depth, count(*) AS size, any_value(depth) + {path('count(*)')} AS path, "
             f"{every('any_value(lo{i}) AS lo{i}')}, {every('any_value(hi{i}) AS hi{i}')} FROM l{level} GROUP BY g, tree, node)",
             f"paths AS (SELECT base.g, base.rid, avg(path) AS e, max(psi) AS psi FROM base JOIN boxes ON base.g IS NOT DISTINCT FROM boxes.g AND {inside} GROUP BY ALL)",
             f"scored AS (SELECT g, rid, round_even(-pow(2.0, -e / CASE WHEN {path('psi')} > 0 THEN {path('psi')} ELSE 1 END), {DIGITS}) AS score FROM paths)"]
    return ",\n".join(ctes)
