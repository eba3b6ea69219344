import random

from kinograph.llm.topn import top_n_per_group


def brute(data, n, descending):
    best = {}
    for g, i, v in data:
        if i is None or v is None or v != v:
            continue
        k = (g, i)
        best[k] = v if k not in best else (max if descending else min)(best[k], v)
    out = []
    for g in {g for g, _ in best}:
        members = sorted(((v, i) for (h, i), v in best.items() if h == g), key=lambda x: (-x[0] if descending else x[0], x[1]))
        out += [(g, i, v, r + 1) for r, (v, i) in enumerate(members[:n])]
    return sorted(out, key=repr)


def test_against_brute_force(spark, rows):
    rng = random.Random(4)
    data = [(rng.choice(["a", "a", "a", "b", "c", None]), rng.choice([f"i{k}" for k in range(30)] + [None]), rng.choice([None, float("nan"), -0.0, 0.0, 1.0, 2.0, float("inf"), rng.random()])) for _ in range(2000)]
    df = spark.createDataFrame([(*x, "r", 1) for x in data], "g string, i string, v double, r string, g0 int")  # clashing names beside
    for descending in (True, False):
        got = rows(top_n_per_group(df, ["g"], "i", "v", 10, descending))
        assert [(g, i, abs(v) if v == 0 else v, r) for g, i, v, r in got] == [(g, i, abs(v) if v == 0 else v, r) for g, i, v, r in brute(data, 10, descending)]


def test_plan_prunes_on_both_sides_of_the_shuffle(spark):
    df = spark.createDataFrame([("a", "i", 1.0)], "g string, i string, v double")
    plan = top_n_per_group(df, ["g"], "i", "v")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_empty(spark):
    df = spark.createDataFrame([], "g string, i string, v double")
    assert top_n_per_group(df, ["g"], "i", "v").count() == 0
    assert top_n_per_group(df.unionByName(spark.createDataFrame([("a", None, 1.0)], df.schema)), ["g"], "i", "v").count() == 0
