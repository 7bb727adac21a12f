"""Consistent pseudonyms for people across both logs."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadbay import schemas as S
from loadbay.functions import columns as C
from loadbay.operators.ordinals import ordinals
from loadbay.operators.terms import find_terms
from loadbay.session import cut

# Parts of the default pseudonyms: every stem with every ending gives 104 given
# names and 104 family names.
STEMS = ("Al", "Be", "Ca", "Do", "El", "Fa", "Gi", "Ha", "Il", "Jo", "Ka", "Lu", "Ma",
         "No", "Ol", "Pe", "Qui", "Ro", "Sa", "Te", "Ur", "Vi", "Wa", "Xe", "Yo", "Za")
GIVEN_ENDINGS = ("da", "len", "ris", "vio")
FAMILY_ENDINGS = ("berg", "ford", "mont", "wick")


def make_pool(given: Sequence[str], family: Sequence[str]) -> list[str]:
    """Every given name with every family name, ordered by MD5 of the full name."""
    names = {f"{g} {f}" for g in given for f in family}
    return sorted(names, key=lambda n: hashlib.md5(n.encode()).hexdigest())


def default_pool() -> list[str]:
    return make_pool([s + e for s in STEMS for e in GIVEN_ENDINGS],
                     [s + e for s in STEMS for e in FAMILY_ENDINGS])


def _pool_frame(spark: SparkSession, pool: Sequence[str]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(pool)), "slot bigint, fake string")


def _assign(real: DataFrame, column: str, pool: Sequence[str], unique: bool) -> DataFrame:
    """(real, fake, position): the i-th value in sort order takes pool[i mod n].

    With ``unique`` a second round through the pool appends its number, so that no
    two values share a pseudonym.
    """
    n = len(pool)
    numbered = (ordinals(real.select(F.col(column).alias("real")), "real")
                .withColumn("slot", F.col("position") % n)
                .join(_pool_frame(real.sparkSession, pool), "slot"))
    lap = F.floor(F.col("position") / n) + 1
    fake = F.when(lap > 1, F.concat_ws(" ", "fake", lap.cast("string"))).otherwise(F.col("fake"))
    return numbered.select("real", (fake if unique else F.col("fake")).alias("fake"), "position")


def all_names(products: DataFrame, workers: DataFrame) -> DataFrame:
    """Distinct non-NULL names of both logs with the system flag."""
    names = (products.select(F.col("worker").alias("name"))
             .unionAll(workers.select("employee_name")).distinct())
    return (names.where(F.col("name").isNotNull())
                 .withColumn("is_system", C.is_system_name("name")))


def name_map(products: DataFrame, workers: DataFrame, pool: Sequence[str] | None = None,
             unique: bool = False) -> DataFrame:
    """(real, fake, position, is_system); system names keep their own name."""
    names = all_names(products, workers)
    people = _assign(names.where(~F.col("is_system")), "name",
                     default_pool() if pool is None else pool, unique)
    machines = names.where("is_system").select(
        F.col("name").alias("real"), F.col("name").alias("fake"),
        F.lit(None).cast("bigint").alias("position"), F.lit(True).alias("is_system"))
    return people.withColumn("is_system", F.lit(False)).unionByName(machines)


def employee_id_map(workers: DataFrame, pool: Sequence[str] = S.EMPLOYEE_ID_POOL,
                    unique: bool = False) -> DataFrame:
    """(real, fake, position); beyond six ids the default pool repeats."""
    ids = workers.select("employee_id").where(F.col("employee_id").isNotNull()).distinct()
    return _assign(ids, "employee_id", pool, unique)


def equipment_map(workers: DataFrame, ids: DataFrame) -> DataFrame:
    """(real, fake): the first id (in map order) inside a code is replaced in it."""
    codes = (workers.select(F.col("equipment").alias("code"))
                    .where(F.col("equipment").isNotNull()).distinct())
    hits = find_terms(codes, ids, "code", "code", "real").join(ids, "real")
    first = (hits.groupBy("code")
                 .agg(F.min_by(F.struct("real", "fake"), "position").alias("id")))
    swapped = F.replace("code", F.col("id.real"), F.col("id.fake"))
    return (codes.join(first, "code", "left")
                 .select(F.col("code").alias("real"),
                         F.coalesce(swapped, F.col("code")).alias("fake")))


def replace_by_map(df: DataFrame, column: str, mapping: DataFrame) -> DataFrame:
    """Swap a column's values through (real, fake); unknown and NULL become NULL."""
    pairs = mapping.select(F.col("real").alias(column), F.col("fake").alias("__fake"))
    order = df.columns
    return (df.join(pairs, column, "left").drop(column)
              .withColumnRenamed("__fake", column).select(*order))


# --- names inside free text ---------------------------------------------------

def _fold(book: DataFrame) -> DataFrame:
    """(text, names) with ``states``: the text after each replacement, in map order."""
    start = F.array(F.struct(F.lit(-1).cast("bigint").alias("position"), F.col("text").alias("now")))

    def step(states, m):
        now = F.replace(F.element_at(states, -1)["now"], m["real"], m["fake"])
        return F.array_append(states, F.struct(m["position"].alias("position"), now.alias("now")))

    return book.withColumn("states", F.aggregate("names", start, step))


def _rewrite(texts: DataFrame, people: DataFrame) -> DataFrame:
    """(text, scrubbed) of the texts that hold a name, for any number of names.

    A text's names are found once and replaced one after another in a single expression. A
    replacement can create a name that comes later in map order; the states in between are
    searched for such names, and only texts where one appears are folded again with it. Rounds
    are as many as created names create others in turn, however many names a text holds.

    A merge join, as in ``terms``, where both sides grow with the texts.
    """
    found = cut(find_terms(texts, people, "text", "text", "real").join(people, "real"))
    due, done = found, None
    while True:
        # a text's own names: no more than it has letters
        book = cut(_fold(due.groupBy("text").agg(
            F.sort_array(F.collect_list(F.struct("position", "real", "fake"))).alias("names"))))
        between = (book.select("text", F.explode("states").alias("s")).where("s.position >= 0")
                       .select(F.struct("text", "s.position").alias("at"), F.col("s.now").alias("now")))
        later = (find_terms(between, people, "at", "now", "real").join(people, "real")
                 .where(F.col("position") > F.col("at.position"))
                 .select("at.text", "real", "position", "fake").distinct())
        created = cut(later.join(due.select("text", "real").hint("merge"), ["text", "real"], "left_anti"))
        settled = (book.join(created.select("text").distinct(), "text", "left_anti")
                       .select("text", F.element_at("states", -1)["now"].alias("scrubbed")))
        done = settled if done is None else done.unionAll(settled)
        if created.isEmpty():
            return done
        again = due.join(created.select("text").distinct(), "text", "left_semi")
        due = cut(again.unionByName(created))


def scrub_text(df: DataFrame, mapping: DataFrame,
               columns: Sequence[str] = ("screen_heading", "json_text")) -> DataFrame:
    """Replace every personal name inside free text; empty text becomes NULL.

    Names are literal, replaced one after another in sort order. The distinct texts are
    rewritten once, see ``_rewrite``, and joined back.
    """
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return df
    people = cut(mapping.where(~F.col("is_system")).select("real", "fake", "position"))
    order = df.columns
    texts = None
    for c in columns:
        one = df.select(F.col(c).alias("text"))
        texts = one if texts is None else texts.unionAll(one)
    book = cut(_rewrite(texts.where(F.length("text") > 0).distinct(), people))
    for c in columns:
        pairs = book.select(F.col("text").alias(c), F.col("scrubbed").alias("__new"))
        df = (df.join(pairs, c, "left")
                .withColumn(c, F.nullif(F.coalesce("__new", c), F.lit(""))).drop("__new"))
    return df.select(*order)


# --- whole tables -------------------------------------------------------------

def anonymize_products(products: DataFrame, names: DataFrame) -> DataFrame:
    return replace_by_map(products, "worker", names)


def anonymize_workers(workers: DataFrame, names: DataFrame, ids: DataFrame,
                      equipment: DataFrame) -> DataFrame:
    out = workers
    for column, mapping in (("employee_name", names), ("employee_id", ids),
                            ("equipment", equipment)):
        out = replace_by_map(out, column, mapping)
    return scrub_text(out, names)


def unmapped_counts(products: DataFrame, workers: DataFrame, names: DataFrame) -> DataFrame:
    """Rows that end up without a name, per table."""
    def lost(df, column, label):
        return replace_by_map(df.select(column), column, names).agg(
            F.lit(label).alias("table_name"),
            F.count_if(F.col(column).isNull()).alias("unmapped"))
    return lost(products, "worker", "products").unionAll(lost(workers, "employee_name", "workers"))


def report(names: DataFrame, ids: DataFrame, equipment: DataFrame) -> DataFrame:
    """Counts of personal and system names, ids and changed equipment codes."""
    return names.agg(F.count_if(~F.col("is_system")).alias("personal_names"),
                     F.count_if("is_system").alias("system_names")).select(
        "personal_names", "system_names",
        ids.agg(F.count("*")).scalar().alias("employee_ids"),
        equipment.agg(F.count_if(F.col("real") != F.col("fake"))).scalar().alias("equipment_changed"))


def sample_names(names: DataFrame, top: int = 15) -> DataFrame:
    """The first personal names in sort order with their pseudonyms."""
    return names.where(~F.col("is_system")).select("real", "fake").orderBy("real").limit(top)
