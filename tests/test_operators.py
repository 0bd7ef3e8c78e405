"""Skew-safe operators against plain windows, orders against Python."""

import hashlib

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from abacist.operators import keyed, metrics, ordering, tables, training_rows
from abacist.functions import features
from abacist.plans import augmentation, evaluation, rollouts


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


@pytest.fixture(scope="module")
def skewed(spark):
    """Key 0 holds most rows; one group has a null key."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 97 == 1, None)
        .otherwise(F.col("id") % 41).alias("k"),
        F.col("id").alias("n"),
        (F.col("id") % 7).cast("double").alias("v"),
    )


def test_group_stats_equal_window(skewed):
    stats = {"total": F.sum("v"), "rows": F.count(F.lit(1))}
    found = keyed.with_group_stats(skewed, ["k"], stats)
    group = W.partitionBy("k")
    wanted = skewed.withColumn("total", F.sum("v").over(group)).withColumn(
        "rows", F.count(F.lit(1)).over(group)
    )
    assert rows_of(found) == rows_of(wanted)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookup_join_is_the_same_either_way(spark, skewed, how):
    lookup = spark.range(0, 41, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    wanted = rows_of(skewed.join(lookup, ["k"], how))
    assert rows_of(keyed.lookup_join(skewed, lookup, ["k"], how)) == wanted
    assert rows_of(keyed.lookup_join(skewed, lookup, ["k"], how, max_rows=3)) == wanted


def test_fits_broadcast(spark):
    small = spark.range(10)
    assert keyed.fits_broadcast(small)
    assert not keyed.fits_broadcast(small, max_rows=9)
    assert not keyed.fits_broadcast(small, max_bytes=20)


def test_last_by_key(spark):
    frame = spark.createDataFrame(
        [("a", 1, "x"), ("a", 3, None), ("b", 2, "y")], "id string, seq int, t string"
    )
    assert rows_of(keyed.last_by_key(frame, ["id"], "seq")) == [("a", 3, None), ("b", 2, "y")]


def test_rows_to_do_twice_is_empty(spark):
    rows = spark.range(5).select("id")
    done = spark.createDataFrame([("1",), ("1",), ("3",)], "id string")
    todo = keyed.rows_to_do(rows, done)
    assert rows_of(todo) == [(0,), (2,), (4,)]
    assert keyed.rows_to_do(todo, done.union(todo.select(F.col("id").cast("string")))).count() == 0


@pytest.mark.parametrize("span", [1, 5, 19, 20, 64, 100_000])
@pytest.mark.parametrize("statistic", ["avg", "sum"])
def test_trailing_equals_window(spark, span, statistic):
    steps = spark.range(400).where("id % 5 <> 2 and (id < 90 or id > 210)").select(
        (F.col("id") % 2).alias("epoch"), F.col("id").alias("step"), (F.col("id") * 1.0).alias("v")
    )
    found = metrics.trailing(steps, ["v"], statistic=statistic, rows_per_span=span)
    frame = W.partitionBy("epoch").orderBy("step").rowsBetween(-19, 0)
    wanted = steps.withColumn("t", getattr(F, statistic)("v").over(frame))
    assert rows_of(found.select(F.round("trailing_v", 6), "epoch", "step")) == rows_of(
        wanted.select(F.round("t", 6), "epoch", "step")
    )


def _order(ids, seed=42):
    def place(i):
        return int(hashlib.md5(f"{i}||{seed}".encode()).hexdigest()[:8], 16), i

    return sorted(ids, key=place)


@pytest.mark.parametrize("done", [0, 1, 137, 999, 1000, 5000])
def test_skip_shuffled(spark, done):
    found = [r.id for r in ordering.skip_shuffled(spark.range(1000), done).collect()]
    assert found == _order(range(1000))[done:]


def test_rows_without_id_stay_in_the_order(spark):
    rows = spark.range(40).select(F.when(F.col("id") > 3, F.col("id")).alias("id"))
    assert ordering.skip_shuffled(rows, 10).count() == 30
    assert ordering.seeded_sample(rows, 30).count() == 30


@pytest.mark.parametrize("partitions", [1, 7])
def test_order_does_not_depend_on_partitions(spark, partitions):
    rows = spark.range(500).repartition(partitions)
    assert [r.id for r in ordering.seeded_sample(rows, 50).collect()] == _order(range(500))[:50]
    assert [r.id for r in ordering.seeded_shuffle(rows).collect()] == _order(range(500))
    assert ordering.seeded_sample(rows, 9000).count() == 500


@pytest.mark.parametrize("n", [3, 137, 999, 1000, 5000])
def test_large_samples_are_cut_by_slices(spark, n):
    found = [r.id for r in ordering.seeded_sample(spark.range(1000), n).collect()]
    assert found == _order(range(1000))[:n]


@pytest.mark.parametrize("drop", [True, False])
def test_epoch_slices(spark, drop):
    rows = ordering.epoch_slices(
        spark.range(60), 3, 30, max_samples=10, drop_boundary=drop
    ).collect()
    order, block = _order(range(60)), 11 if drop else 10
    wanted = [(e, s, order[e * block + s]) for e in range(3) for s in range(10)]
    assert sorted((r.epoch, r.step, r.id) for r in rows) == wanted


def test_epoch_averages_without_values(spark):
    steps = spark.createDataFrame([(0, None, 1.0), (0, None, 3.0)], "epoch int, loss double, reward double")
    assert metrics.epoch_averages(steps, ["loss", "reward"]).first()[:] == (0, 0.0, 2.0, 2)


def test_advantages_sum_to_zero(spark, sf_dir):
    from abacist.queries.scoring import _slim_rewards

    weighed = rollouts.with_advantages(_slim_rewards(spark, sf_dir))
    groups = weighed.groupBy("id").agg(
        F.abs(F.sum("advantage")).alias("s"), F.var_pop("advantage").alias("v")
    )
    assert groups.where("s > 1e-9 or not (abs(v - 1) < 1e-9 or v = 0)").count() == 0


def test_single_and_constant_groups_have_no_advantage(spark):
    frame = spark.createDataFrame(
        [(1, 0, 1.0), (2, 0, 0.1), (2, 1, 0.1), (3, 0, 0.0), (3, 1, 1.0)], "id int, rollout int, reward double"
    )
    found = {(r.id, r.rollout): r.advantage for r in rollouts.with_advantages(frame).collect()}
    assert found == {(1, 0): 0.0, (2, 0): 0.0, (2, 1): 0.0, (3, 0): -1.0, (3, 1): 1.0}


def test_batches_of_one_length_are_numbered_in_slices(spark):
    rows = spark.range(1000).select("id", F.array_repeat(F.lit(7), 5).alias("input_ids"))
    found = training_rows.assigned_batches(rows, 8, rows_per_slice=100)
    sizes = found.groupBy("bucket", "slice", "batch").count()
    assert found.count() == 1000 and found.select("slice").distinct().count() == 10
    assert sizes.agg(F.max("count")).first()[0] == 8
    assert sizes.where("count < 8").count() <= 10


def test_trailing_of_sparse_steps_is_spread(spark):
    """Steps ten thousand apart: spans still hold many rows each."""
    rows = spark.range(600).select(F.lit(1).alias("epoch"), (F.col("id") * 10_000 + 7).alias("step"), (F.col("id") % 13).cast("double").alias("v"))
    found = metrics.trailing(rows, ["v"], rows_per_span=100)
    frame = W.partitionBy("epoch").orderBy("step").rowsBetween(-19, 0)
    assert rows_of(found) == rows_of(rows.withColumn("trailing_v", F.avg("v").over(frame)))


def test_step_loss_is_per_item(spark):
    """Two items, one without a current vector: the sum is divided by both."""
    rows = spark.createDataFrame(
        [(1, 0, 1.0, [-0.5], [-0.5]), (1, 1, -1.0, [], [-0.5]), (2, 0, 0.0, [-0.5], [-0.5]), (3, 0, 1.0, [-0.5], [])],
        "id int, rollout int, advantage double, current_log_probs array<double>, old_log_probs array<double>",
    )
    (found,) = rollouts.with_step_losses(rollouts.group_losses(rollouts.rollout_losses(rows)), accumulation=1).collect()
    assert (found.id, found.n_active, found.n_items) == (1, 1, 2)
    assert (found.total_loss, found.scaled_loss, found.loss) == (-1.0, -0.5, -1.0)


def test_last_by_key_keeps_rows_without_a_sequence(spark):
    rows = spark.createDataFrame([(1, None, "a"), (2, None, "b"), (2, 3, "c"), (2, 1, "d")], "k int, n int, t string")
    assert rows_of(keyed.last_by_key(rows, ["k"], "n")) == rows_of(rows.where("t in ('a', 'c')"))


@pytest.mark.parametrize("count", [3, 1500, 5000])
def test_fan_out_of_a_table(spark, count):
    variants = spark.range(count).select(F.col("id").alias("variant"), F.concat(F.lit("m"), "id").alias("model"))
    found = tables.fan_out(spark.range(3), variants)
    assert found.count() == 3 * count and found.distinct().count() == 3 * count
    assert tables.fan_out(spark.range(3), variants.limit(0)).count() == 0
    assert found.columns == ["id", "variant", "model"]
    assert "CartesianProduct" not in found._jdf.queryExecution().executedPlan().toString()


def test_statistics_need_one_pass_over_the_texts(spark, sf_dir):
    from abacist.queries.scoring import advantages, rollout_chain

    for query, exchanges in ((advantages, 3), (rollout_chain, 6)):
        result = query(spark, sf_dir)
        result.collect()
        plan = result._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        shuffles = [x for x in plan.splitlines() if " Exchange " in x and "Reused" not in x and "RoundRobin" not in x]
        assert len(shuffles) <= exchanges, plan


def test_objectives_of_one_large_group(spark):
    """All rollouts share one id; both ways give the same sums."""
    texts = F.array(*map(F.lit, ("答案：5", "先算 5", "不会", "步骤 答案：6")))
    rows = spark.range(2000).select(
        F.lit(1).alias("id"), F.col("id").alias("rollout"), F.lit("5").alias("answer"),
        F.get(texts, (F.col("id") % 4).cast("int")).alias("response"),
        F.array(*((-(F.col("id") + j) % 3 - 1).cast("double") for j in range(3))).alias("current_log_probs"),
        F.slice(F.array(*((-(F.col("id") * 2 + j) % 4 - 1).cast("double") for j in range(4))), 1,
                (F.col("id") % 5).cast("int")).alias("old_log_probs"),
    )
    direct = rollouts.group_objectives(rows).first()
    weighed = rollouts.with_advantages(
        rollouts.scored(rows), keep=rollouts.VECTORS
    )
    chain = rollouts.group_losses(rollouts.rollout_losses(weighed)).first()
    assert direct.n_active == chain.n_active > 0 and direct.n_items == chain.n_items
    assert abs(direct.total_loss - chain.total_loss) < 1e-6
    assert abs(direct.total_kl - chain.total_kl) < 1e-6


def test_evaluation_ties_and_missing_base(spark):
    table = spark.createDataFrame(
        [("a", 1, 0.5), ("b", 0, 0.5), ("c", 2, 0.75)], "model string, variant int, accuracy double"
    )
    placed = evaluation.ranked(table).sort("place").collect()
    assert [r.model for r in placed] == ["c", "b", "a"]
    assert evaluation.best(table.where("model <> 'c'")).first().model == "b"
    assert evaluation.with_gain(table, "base").where("gain is not null").count() == 0
    assert evaluation.first_available(table, ["x", "b", "a"]).first().model == "b"


def test_availability_by_list(spark):
    rows = spark.createDataFrame([("a",), ("b",)], "model string")
    assert rows_of(evaluation.only_available(rows, ["b", "z"])) == [("b",)]


def test_catalogue_size_is_checked(spark):
    with pytest.raises(ValueError):
        tables.fan_out(spark.range(1), [{"m": str(i)} for i in range(1001)])


def test_optional_columns(spark):
    rows = spark.createDataFrame([(1, "q", "5", "c"), (None, "q", "6", " ")], "id int, question string, answer string, chosen string")
    assert rows_of(tables.solutions_from_preferences(rows, "do")) == [("1", "q", "5", "c", "do")]
    assert not tables.has_ground_truth(rows.drop("answer"))
    assert rows_of(tables.column_types(rows.select("id"))) == [("id", "int")]
    ids = [r.id for r in tables.row_id(rows).collect()]
    assert ids[0] == "1" and len(ids[1]) == 64


def test_fully_masked_rows(spark):
    rows = spark.createDataFrame([(1, "问题", "5", "c")], "id int, question string, answer string, cot string")
    short = training_rows.solution_features(rows, max_length=10).first()
    assert short.fully_masked and set(short.labels) == {-100} and len(short.input_ids) == 10
    full = training_rows.solution_features(rows).first()
    assert not full.fully_masked and len(full.labels) == len(full.input_ids) == len(full.attention_mask)
    target = [x for x in full.labels if x != -100]
    assert "".join(map(chr, target)) == "c\n答案：5<|im_end|>\n"


def test_user_tokenizer(spark):
    def load():
        return lambda texts: [[len(t)] for t in texts]

    rows = spark.createDataFrame([("ab",), ("",)], "t string")
    tokenizer = features.batch_tokenizer(load)
    assert rows_of(rows.select(tokenizer(F.col("t")))) == [([0],), ([2],)]
    solved = spark.createDataFrame([(1, "问题", "5", "c")], "id int, question string, answer string, cot string")
    found = training_rows.solution_features(solved, tokenizer=tokenizer).first()
    assert found.labels == [-100] * 7 + [6, 11]


@pytest.fixture(scope="module")
def solved(spark):
    return spark.createDataFrame(
        [
            ("1", "有5个和55个", "60", "5+55=60\n答案：60", False),
            ("2", "只有7个", "7", "7", False),
            ("3", "3和4", "12", "三四一十二", None),
            ("4", "0和4", "半", "没有", False),
            ("5", "8和9", "17", "8+9=17", True),
        ],
        "id string, question string, answer string, cot string, augmented boolean",
    )


def test_augmentation_rules(solved):
    copies = augmentation.augmented_copies(solved, per_row=3).collect()
    assert {r.original_id for r in copies} == {"1", "3"}
    assert sorted(r.id for r in copies if r.original_id == "1") == ["1_aug0", "1_aug1", "1_aug2"]
    assert all(r.augmented and r.question != "有5个和55个" for r in copies if r.original_id == "1")


def test_very_long_numbers_change_too(spark):
    one, two = "1234567890" * 2, "9" * 45
    rows = spark.createDataFrame(
        [("1", f"{one}和{two}", "5", f"{one}×1={two}"), ("2", f"{one}和{two}", "5", "无")],
        "id string, question string, answer string, cot string",
    )
    found = augmentation.augmented_copies(rows, per_row=3).collect()
    assert len(found) == 6
    for row in found:
        first, second = row.question.split("和")
        assert first != one and second != two
        assert 0.49 < int(first) / int(one) < 2.01 and 0.49 < int(second) / int(two) < 2.01
        assert row.answer != "5"


def test_substituted_values_by_hand(spark):
    top = 2**32 - 1
    cases = [(10, 0, 0, 5), (10, top, 0, 19), (7, 2**31, 0, 8), (1, 0, 0, 1), (1, 0, 1, 2), (3, 1431655766, 1, 4)]
    frame = spark.createDataFrame(cases, "v long, factor long, sign long, wanted long")
    new = augmentation.substituted_value(F.col("v"), F.col("factor"), F.col("sign"))
    assert [r[0] for r in frame.select(new).collect()] == [c[3] for c in cases]


def test_questions_of_fewer_than_two_numbers_have_no_substitutions(spark):
    rows = spark.createDataFrame([("1", "没有", 0), ("2", "有7个", 0), ("3", None, 0)], "id string, question string, copy int")
    assert [r.substitutions for r in augmentation.with_substitutions(rows).collect()] == [[], [], []]


def test_augmentation_does_not_depend_on_partitions(solved):
    one, seven = (
        rows_of(augmentation.augmented_copies(solved.repartition(n))) for n in (1, 7)
    )
    assert one == seven


def test_copies_apply_their_substitutions_in_question_and_solution(spark, solved):
    drawn = augmentation.with_substitutions(tables.copies(solved, 2))
    pairs = {(r.id, r.copy): [(p.old, p.new) for p in r.substitutions] for r in drawn.collect()}
    texts = {r.id: (r.question, r.cot) for r in solved.collect()}
    for row in augmentation.augmented_copies(solved).collect():
        question, cot = texts[row.original_id]
        for old, new in pairs[row.original_id, int(row.id[-1])]:
            assert 0.5 * int(old) - 1 <= int(new) <= max(2 * int(old), 2) and old != new
            question, cot = question.replace(old, new, 1), cot.replace(old, new, 1)
        assert (row.question, row.cot) == (question, cot)




def test_last_rows_are_neither_sorted_nor_aggregated(spark):
    rows = spark.range(1000).select((F.col("id") % 50).alias("k"), F.col("id").alias("n"), F.repeat(F.lit("x"), 100).alias("t"))
    found = keyed.last_by_key(rows, ["k"], "n")
    assert rows_of(found.select("n")) == [(n,) for n in range(950, 1000)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHash" not in plan and "Sort [" not in plan


@pytest.mark.parametrize("n", [10_001, 12_000, 20_000, 25_000])
def test_many_first_rows(spark, n):
    rows = spark.range(20_000).select(F.when(F.col("id") % 7 > 0, F.floor(F.col("id") / 3)).alias("s"), F.col("id").alias("t"))
    found = ordering.first_rows(rows.repartition(6), n, "s")
    assert "TakeOrdered" not in found._jdf.queryExecution().executedPlan().toString()
    rank = lambda s: (s is not None, s or 0)
    wanted = sorted((r.s for r in rows.collect()), key=rank)[:n]
    found = found.collect()
    assert sorted((r.s for r in found), key=rank) == wanted and len({r.t for r in found}) == len(wanted)


def test_many_first_rows_of_one_value(spark):
    rows = spark.range(30_000).select(F.lit(None).cast("string").alias("s"), "id")
    assert ordering.first_rows(rows, 15_000, "s").count() == 15_000
    assert ordering.first_rows(rows.fillna("x"), 15_000, "s").distinct().count() == 15_000


def test_no_window_has_a_whole_run(spark):
    steps = spark.range(3000).select(F.lit(1).alias("epoch"), F.col("id").alias("step"), F.lit(1.0).alias("v"))
    found = metrics.trailing(steps, ["v"], statistic="sum", rows_per_span=100)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "windowspecdefinition(" in line]
    assert windows and all("_span" in w or "_part" in w for w in windows)
    assert found.where("trailing_v <> least(step + 1, 20)").count() == 0
