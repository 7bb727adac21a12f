import random

import pytest
from pyspark.sql import functions as F

from loadbay.operators import anonymize as N
from loadbay.operators.ordinals import ordinals
from loadbay.operators.terms import anchors, candidates, find_terms


def pairs(df):
    return {r.real: r.fake for r in df.collect()}


def logs(spark, workers, inputs):
    p = spark.createDataFrame([(x,) for x in workers], "worker string")
    w = spark.createDataFrame(inputs, "employee_name string, employee_id string, equipment string,"
                                      " screen_heading string, json_text string")
    return p, w


def test_ordinals_number_in_sort_order(spark):
    names = [f"n{i:05d}" for i in range(3000)]
    random.Random(1).shuffle(names)
    df = spark.createDataFrame([(x,) for x in names], "name string").repartition(16)
    got = {r.name: r.position for r in ordinals(df, "name").collect()}
    assert got == {x: i for i, x in enumerate(sorted(names))}


def test_names_are_consistent_and_systems_stay(spark):
    p, w = logs(spark, ["Ann", "SYSTEM", "USER12", None, "Ann Smith", "Ann"],
                [("Ann", "I1", "x", None, None), ("Bo", "I2", "x", None, None)])
    m = N.name_map(p, w, pool=["f0", "f1"])
    assert pairs(m) == {"Ann": "f0", "Ann Smith": "f1", "Bo": "f0", "SYSTEM": "SYSTEM", "USER12": "USER12"}
    assert pairs(N.name_map(p, w, pool=["f0", "f1"], unique=True))["Bo"] == "f0 2"
    out = [r.worker for r in N.anonymize_products(p.coalesce(1), m).collect()]
    assert sorted(x or "" for x in out) == ["", "SYSTEM", "USER12", "f0", "f0", "f1"]
    lost = {r.table_name: r.unmapped for r in N.unmapped_counts(p, w, m).collect()}
    assert lost == {"products": 1, "workers": 0}


def test_seventh_employee_shares_an_id_unless_unique(spark):
    _, w = logs(spark, [], [("n", f"I{i}", None, None, None) for i in range(7)])
    plain = pairs(N.employee_id_map(w))
    assert plain["I0"] == plain["I6"] == "EMP_A" and plain["I5"] == "EMP_F"
    assert len(set(pairs(N.employee_id_map(w, unique=True)).values())) == 7


def test_equipment_takes_the_first_contained_id(spark):
    _, w = logs(spark, [], [("n", i, e, None, None) for i, e in
                            [("AB", "FAABAB"), ("B", "xB"), ("ABC", "zABC"), (None, "none"), ("B", None)]])
    got = pairs(N.equipment_map(w, N.employee_id_map(w)))
    # sorted ids: AB -> EMP_A, ABC -> EMP_B, B -> EMP_C
    assert got == {"FAABAB": "FAEMP_AEMP_A", "xB": "xEMP_C", "zABC": "zEMP_AC", "none": "none"}


def test_find_terms_equals_brute_force(spark):
    rng = random.Random(2)
    word = lambda k: "".join(rng.choice("aab") for _ in range(k))
    texts = sorted({word(rng.randrange(0, 25)) for _ in range(150)})
    terms = sorted({word(rng.randrange(1, 12)) for _ in range(80)})
    for chosen in (terms, [t for t in terms if len(t) >= 9], ["zz"]):
        got = find_terms(spark.createDataFrame([(t,) for t in texts], "t string"),
                         spark.createDataFrame([(t,) for t in chosen], "r string"), "t", "t", "r")
        assert {tuple(r) for r in got.collect()} == {(t, x) for t in texts for x in chosen if x in t}


def test_scrubbing_equals_replacing_in_order(spark):
    """Short names inside long ones, replacements that create later names, blanks."""
    people = {"Ann": "Bo", "Ann Smith": "Cy", "Bo": "Di", "Di x": "Ed", "Zoe": "Ann"}
    mapping = spark.createDataFrame(
        [(r, f, i, False) for i, (r, f) in enumerate(sorted(people.items()))] + [("SYSTEM", "SYSTEM", None, True)],
        "real string, fake string, position bigint, is_system boolean")
    texts = ["Ann Smith and Ann", "Ann x", "Zoe", "", "SYSTEM", None, "Bo Bo", "nobody", "ZoeAnnBo x"]
    df = spark.createDataFrame([(i, t, t) for i, t in enumerate(texts)],
                               "n int, screen_heading string, json_text string")

    def expected(t):
        for real in sorted(people):
            t = t and t.replace(real, people[real])
        return t or None

    got = N.scrub_text(df, mapping)
    assert got.columns == df.columns
    for r in got.collect():
        assert r.screen_heading == r.json_text == expected(texts[r.n]), texts[r.n]


@pytest.mark.parametrize("names", [1, 12])
def test_jobs_do_not_grow_with_the_names_of_a_text(spark, names):
    mapping = spark.createDataFrame([(f"Person {i:03d}.", f"Alias {i:03d}.", i, False) for i in range(600)],
                                    "real string, fake string, position bigint, is_system boolean")
    text = " ".join(f"Person {i:03d}." for i in range(names))
    df = spark.createDataFrame([(text,)], "screen_heading string")
    group = f"scrub-{names}"
    spark.sparkContext.setJobGroup(group, "scrub")
    got = N.scrub_text(df, mapping).first()[0]
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got == text.replace("Person", "Alias") and jobs < 40


def test_no_personal_names_leaves_text_alone(spark):
    mapping = spark.createDataFrame([("SYSTEM", "SYSTEM", None, True)],
                                    "real string, fake string, position bigint, is_system boolean")
    df = spark.createDataFrame([("SYSTEM",)], "screen_heading string")
    assert N.scrub_text(df, mapping).first()[0] == "SYSTEM"


def test_pool_is_large_distinct_and_stable():
    pool = N.default_pool()
    assert len(pool) == len(set(pool)) == 10_816 and pool == N.default_pool()


def test_no_real_name_survives(spark):
    inputs = [(f"Person {i}", f"ID{i}", f"FAID{i}", f"Hi Person {i}", '{"u": "Person %d"}' % i)
              for i in range(30)]
    p, w = logs(spark, [f"Person {i}" for i in range(40)], inputs)
    m, ids = N.name_map(p, w), N.employee_id_map(w)
    out = N.anonymize_workers(w, m, ids, N.equipment_map(w, ids))
    assert out.columns == w.columns and out.count() == 30
    seen = " ".join(" ".join(map(str, r)) for r in out.collect())
    assert "Person" not in seen and "ID1" not in seen
    row = N.report(m, ids, N.equipment_map(w, ids)).first()
    assert tuple(row) == (40, 0, 30, 30)
    assert N.sample_names(m).count() == 15
    assert out.where(F.col("screen_heading").startswith("Hi ")).count() == 30


def test_common_prefix_names_make_few_candidates(spark):
    """10 000 names of one form: only positions of names that occur are looked at."""
    names = spark.range(10_000).selectExpr("concat('Employee#', lpad(cast(id AS string), 6, '0')) AS term")
    texts = spark.range(2_000).selectExpr(
        "id", "concat('Welcome Employee#', lpad(cast(id * 7 % 3000 AS string), 6, '0'), ', see Employee#',"
              " lpad(cast(id * 11 % 12000 AS string), 6, '0')) AS t")
    true = find_terms(texts, names, "id", "t", "term").count()
    assert true == sum((i * 7 % 3000 < 10_000) + (i * 11 % 12000 < 10_000) - (i * 7 % 3000 == i * 11 % 12000)
                       for i in range(2_000))
    assert true <= candidates(texts, names).count() <= 3 * true


def test_rarest_substring_is_the_anchor(spark):
    texts = spark.createDataFrame([(1, "prefix-xyzzyx-1 prefix-plover12 prefix-")], "id long, t string")
    terms = spark.createDataFrame([("prefix-plover12",), ("prefix-absent12",), ("12",)], "term string")
    sizes = F.array(F.lit(2), F.lit(8))
    got = {r.term: (r.gram, r.shift) for r in anchors(texts, terms, sizes).collect()}
    assert got == {"prefix-plover12": ("prefix-p", 0), "12": ("12", 0)}


def test_names_in_texts_never_pass_the_driver(spark, tmp_path):
    """Compressed files say little about the rows exploded from them, however small they look."""
    spark.range(300).selectExpr("concat('Welcome Employee#', lpad(id, 6, '0')) text").write.parquet(f"{tmp_path}/texts")
    spark.range(200).selectExpr("concat('Employee#', lpad(id, 6, '0')) real").write.parquet(f"{tmp_path}/names")
    found = find_terms(spark.read.parquet(f"{tmp_path}/texts"), spark.read.parquet(f"{tmp_path}/names"),
                       "text", "text", "real")
    assert found.count() == 200
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
