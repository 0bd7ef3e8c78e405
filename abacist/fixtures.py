"""Question, preference and rollout views derived from the given tables.

The given text columns hold no equations or answer lines, so they are written
from order keys. Every view exists as DataFrame and as SQL text for the check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from abacist.sources.tables import read_spread

# prediction sources of the evaluation queries, by rollout number
MODELS = ("base", "north", "south", "west")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_spread(spark, f"{sf_dir}/{name}.parquet")


def _text(*parts: Column | str) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def _cases(selector: Column, *values: Column) -> Column:
    chosen = F.when(selector == 0, values[0])
    for number, value in enumerate(values[1:-1], start=1):
        chosen = chosen.when(selector == number, value)
    return chosen.otherwise(values[-1])


def _numbers() -> list[Column]:
    return [F.col(name) for name in ("a", "b", "c", "ab", "ans")]


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return (
        spread_table(spark, sf_dir, "orders")
        .select(
            key.alias("id"),
            (F.col("o_custkey") % 8 + 2).alias("a"),
            (key % 90 + 10).alias("b"),
            (key * 7 % 50 + 1).alias("c"),
        )
        .withColumn("ab", F.col("a") * F.col("b"))
        .withColumn("ans", F.col("ab") - F.col("c"))
    )


def _question() -> Column:
    a, b, c, _, _ = _numbers()
    return _text("仓库进了", a, "卷电缆，一卷长", b, "米，施工用掉", c, "米，现存几米？")


def problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base(spark, sf_dir).select(
        "id", _question().alias("question"), F.col("ans").cast("string").alias("answer")
    )


def preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b, c, ab, ans = _numbers()
    chosen = _cases(
        F.col("id") % 6,
        _text("步骤：", a, "×", b, "=", ab, "，", ab, "-", c, "=", ans, "\n答案：", ans),
        _text("步骤：", a, "×", b, "=", ab, "，", ab, "-", c, "=", ans),
        _text("先得全长", a, "x", b, "=", ab, "，再去掉", c, "\n答案:", ans, " 米"),
        _text("步骤：", ab, "-", c, "=", ans + 1, "\n答案：", ans + 1, "\n重算\n答案：", ans),
        F.lit("  "),
        F.lit(None),
    )
    rejected = _cases(
        F.col("id") % 4,
        _text("步骤：", a, "+", b, "=", a + b, "\n答案：", a + b),
        _text("步骤：", a, "+", b, "=", a + b),
        _text("答案：", ans - 3, " 米"),
        F.lit("不会做\n答案："),
    )
    return base(spark, sf_dir).select(
        "id",
        _question().alias("question"),
        ans.cast("string").alias("answer"),
        chosen.alias("chosen"),
        rejected.alias("rejected"),
    )


def _per_rollout(rows: DataFrame) -> DataFrame:
    return rows.withColumn("rollout", F.explode(F.sequence(F.lit(0), F.lit(3))))


def rollouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b, _, ab, ans = _numbers()
    response = _cases(
        (F.col("id") * 3 + F.col("rollout") * 5) % 6,
        _text("步骤：", a, "×", b, "=", ab, "\n答案：", ans),
        _text("步骤：", a, "+", b, "=", a + b, "\n答案：", a + b),
        _text("剩", ans),
        F.lit("不会"),
        _text("所以答案：", ans, ".0"),
        F.lit(""),
    )
    return _per_rollout(base(spark, sf_dir)).select(
        "id", "rollout", ans.cast("string").alias("answer"), response.alias("response")
    )


def _vector(length: str, factor: int, modulus: int) -> Column:
    def token(j: Column) -> Column:
        return -((F.col("id") * factor + F.col("rollout") + j) % modulus + 1) / F.lit(10.0)

    full = F.transform(F.sequence(F.lit(1).cast("bigint"), F.greatest(length, F.lit(1))), token)
    return F.slice(full, 1, F.col(length).cast("int"))


def log_probs(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    keys = _per_rollout(spread_table(spark, sf_dir, "orders")).select(
        key.alias("id"),
        "rollout",
        ((key + F.col("rollout")) % 4).alias("n_cur"),
        ((key * 3 + F.col("rollout")) % 4).alias("n_old"),
        (((key + F.col("rollout") * 2) % 5 - 2).cast("double") / 2).alias("adv"),
    )
    return keys.withColumns(
        {
            "current_log_probs": _vector("n_cur", 1, 7),
            "old_log_probs": _vector("n_old", 2, 5),
        }
    )


def model_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rollouts as responses of one model each."""
    names = F.array(*map(F.lit, MODELS))
    return rollouts(spark, sf_dir).select(
        "id",
        F.get(names, F.col("rollout")).alias("model"),
        F.col("rollout").alias("variant"),
        "response",
    )


BASE_SQL = """
SELECT o_orderkey AS id, o_custkey % 8 + 2 AS a, o_orderkey % 90 + 10 AS b,
       o_orderkey * 7 % 50 + 1 AS c,
       (o_custkey % 8 + 2) * (o_orderkey % 90 + 10) AS ab,
       (o_custkey % 8 + 2) * (o_orderkey % 90 + 10) - (o_orderkey * 7 % 50 + 1) AS ans
FROM orders
"""

PROBLEMS_SQL = """
SELECT id, concat('仓库进了', a, '卷电缆，一卷长', b, '米，施工用掉', c, '米，现存几米？') AS question,
       CAST(ans AS STRING) AS answer FROM base
"""

PREFERENCES_SQL = """
SELECT id, concat('仓库进了', a, '卷电缆，一卷长', b, '米，施工用掉', c, '米，现存几米？') AS question,
  CAST(ans AS STRING) AS answer,
  CASE id % 6
    WHEN 0 THEN concat('步骤：', a, '×', b, '=', ab, '，', ab, '-', c, '=', ans, chr(10), '答案：', ans)
    WHEN 1 THEN concat('步骤：', a, '×', b, '=', ab, '，', ab, '-', c, '=', ans)
    WHEN 2 THEN concat('先得全长', a, 'x', b, '=', ab, '，再去掉', c, chr(10), '答案:', ans, ' 米')
    WHEN 3 THEN concat('步骤：', ab, '-', c, '=', ans + 1, chr(10), '答案：', ans + 1, chr(10),
                       '重算', chr(10), '答案：', ans)
    WHEN 4 THEN '  ' ELSE NULL END AS chosen,
  CASE id % 4
    WHEN 0 THEN concat('步骤：', a, '+', b, '=', a + b, chr(10), '答案：', a + b)
    WHEN 1 THEN concat('步骤：', a, '+', b, '=', a + b)
    WHEN 2 THEN concat('答案：', ans - 3, ' 米')
    ELSE concat('不会做', chr(10), '答案：') END AS rejected
FROM base
"""

ROLLOUTS_SQL = """
SELECT id, r.i AS rollout, CAST(ans AS STRING) AS answer,
  CASE (id * 3 + r.i * 5) % 6
    WHEN 0 THEN concat('步骤：', a, '×', b, '=', ab, chr(10), '答案：', ans)
    WHEN 1 THEN concat('步骤：', a, '+', b, '=', a + b, chr(10), '答案：', a + b)
    WHEN 2 THEN concat('剩', ans)
    WHEN 3 THEN '不会'
    WHEN 4 THEN concat('所以答案：', ans, '.0')
    ELSE '' END AS response
FROM base CROSS JOIN (VALUES (0), (1), (2), (3)) AS r(i)
"""

LOG_PROBS_SQL = """
SELECT o_orderkey AS id, r.i AS rollout, (o_orderkey + r.i) % 4 AS n_cur,
       (o_orderkey * 3 + r.i) % 4 AS n_old,
       CAST((o_orderkey + r.i * 2) % 5 - 2 AS DOUBLE) / 2 AS adv,
       list_transform(range(1, (o_orderkey + r.i) % 4 + 1),
         lambda j: CAST(-((o_orderkey + r.i + j) % 7 + 1) AS DOUBLE) / 10) AS cur,
       list_transform(range(1, (o_orderkey * 3 + r.i) % 4 + 1),
         lambda j: CAST(-((o_orderkey * 2 + r.i + j) % 5 + 1) AS DOUBLE) / 10) AS old
FROM orders CROSS JOIN (VALUES (0), (1), (2), (3)) AS r(i)
"""

RESPONSES_SQL = """
SELECT id, ['base', 'north', 'south', 'west'][rollout + 1] AS model, rollout AS variant, response
FROM rollouts
"""

VIEWS = {
    "base": ((), BASE_SQL),
    "problems": (("base",), PROBLEMS_SQL),
    "preferences": (("base",), PREFERENCES_SQL),
    "rollouts": (("base",), ROLLOUTS_SQL),
    "log_probs": ((), LOG_PROBS_SQL),
    "responses": (("rollouts",), RESPONSES_SQL),
}


def with_views(body: str, *names: str, **more: str) -> str:
    """SQL text with the named views, and then ``more``, as CTEs before it."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in VIEWS[name][0]:
            add(needed)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    parts = [f"{name} AS ({VIEWS[name][1].strip()})" for name in order]
    parts += [f"{name} AS ({text.strip()})" for name, text in more.items()]
    return f"WITH {', '.join(parts)}\n{body.strip()}" if parts else body.strip()
