"""Digit arithmetic and substitutions of long numbers against Python's integers."""

import random

from pyspark.sql import functions as F

from abacist.functions.hashing import HASH_RANGE
from abacist.functions.limbs import moved_digits, scaled_digits
from abacist.plans import augmentation


def test_scaled_and_moved_digits(spark):
    rng = random.Random(1)
    rows = [("0", 5, 7), ("1", 999_999_999_999, 1), ("999999", 1, 1), ("1000000", 1, 3), ("9" * 40, 999_999_999_999, 999_999_999_998), ("7", 3, 0)]
    for _ in range(300):
        digits = str(rng.randrange(10 ** rng.randrange(1, 60)))
        rows.append((digits, rng.randrange(1, 10 ** rng.randrange(1, 13)), rng.randrange(1, 10 ** rng.randrange(1, 13))))
    table = spark.createDataFrame(rows, "d string, n long, q long")
    found = table.select(
        "*",
        scaled_digits(F.col("d"), F.col("n"), F.col("q")).alias("s"),
        F.when(F.col("d") != "0", moved_digits(F.col("d"), F.lit(-1))).alias("less"),
        moved_digits(F.col("d"), F.lit(1)).alias("more"),
    )
    for r in found.collect():
        value = int(r.d)
        assert r.s == (str(value * r.n // r.q) if r.q else None)
        assert r.more == str(value + 1) and r.less in (None, str(value - 1))


def test_long_numbers_are_substituted_whole(spark):
    rng = random.Random(2)
    rows = [(str(rng.randrange(10 ** (n - 1), 10**n)), rng.randrange(HASH_RANGE), rng.randrange(9)) for n in range(19, 45) for _ in range(8)]
    table = spark.createDataFrame(rows, "d string, f long, s long")
    for r in table.select("*", augmentation.substituted_digits(F.col("d"), F.col("f"), F.col("s")).alias("new")).collect():
        assert r.new == str(int(r.d) * (HASH_RANGE + 3 * r.f) // (2 * HASH_RANGE))
        assert 0.49 < int(r.new) / int(r.d) < 2.01
    digits = 10**17 * 10  # 19 digits, the factor one: moved by one
    same = spark.createDataFrame([(str(3 * 10**18), n) for n in (0, 1)], "d string, s long")
    assert digits and same.count() == 2


def ratio(answer, old, new):
    """In plain Python: doubles for everyday numbers, whole numbers beyond."""
    sign, digits = answer.startswith("-"), answer.lstrip("+-")
    if max(len(digits), len(old), len(new)) <= 18:
        return str(max(0, int(int(answer) * (int(new) / int(old)))))
    cut = max(len(old), len(new), 12) - 12
    return "0" if sign else str(int(digits) * int(new[: len(new) - cut]) // int(old[: len(old) - cut]))


def test_ratio_answers(spark):
    rng = random.Random(4)

    def number(digits):
        return rng.randrange(10 ** (digits - 1), 10**digits)

    rows = []
    for digits in (1, 3, 10, 18, 19, 25, 40):
        for size in (1, 5, 18, 19, 30, 40):
            old = number(size)
            rows.append((rng.choice(["", "+", "-"]) + str(number(digits)), str(old), str(max(1, old * rng.randrange(50, 200) // 100))))
    table = spark.createDataFrame(rows, "answer string, old string, new string")
    pairs = F.array(F.struct("old", "new"))
    for r in table.select("*", augmentation.ratio_answer("answer", pairs).alias("r")).collect():
        assert r.r == ratio(r.answer, r.old, r.new), r
    odd = spark.createDataFrame([("x", "1", "2"), (None, "1", "2"), ("4.5", "1", "2"), ("5", "0", "1"), ("1" * 30, "0", "1")], "answer string, old string, new string")
    assert [r[0] for r in odd.select(augmentation.ratio_answer("answer", pairs)).collect()] == [None] * 5


def test_copies_with_long_answers_stay(spark):
    rows = [("a", "有12和34个", "12345678901234567890123", "无"), ("b", "有123456789012345678901234567890和5", "7", "共123456789012345678901234567890")]
    solutions = spark.createDataFrame(rows, "id string, question string, answer string, cot string")
    found = augmentation.augmented_copies(solutions, per_row=3).collect()
    assert sorted(r.id for r in found) == ["a_aug0", "a_aug1", "a_aug2", "b_aug0", "b_aug1", "b_aug2"]
    assert all(len(r.answer) >= 22 for r in found if r.id.startswith("a"))
    assert all("123456789012345678901234567890" not in r.cot for r in found if r.id.startswith("b"))


def test_values_are_computed_once(spark):
    """Folding the digits of a text is by far the longest part of a plan."""
    rows = spark.createDataFrame([(1, 0, "有12和" + "3" * 40, "4" * 30)], "id long, copy int, question string, answer string")
    drawn = augmentation.with_substitutions(rows)
    drawn = drawn.withColumn("r", augmentation.ratio_answer("answer", "substitutions"))
    plan = drawn._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("translate(") == 2  # numbers of the question, answer
    row = drawn.first()
    old, new = row.substitutions[-1]
    assert row.r == ratio("4" * 30, old, new)


def test_long_numbers_are_dealt_out(spark, sf_dir):
    from abacist.queries import QUERIES

    spread = QUERIES["long_number_substitutions"](spark, sf_dir)
    assert spread.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
