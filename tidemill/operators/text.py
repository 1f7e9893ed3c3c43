"""Names, questions and settlement texts: normalisation, similarity, classification, clocks, schedules."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.clean import half_up, rounded
from tidemill.plans.registry import query
from tidemill.sources import views as V

c = F.col
# Words that say nothing about which club a name means, beside numbers of two to four digits.
GENERIC = "fc cf sc ac as afc cd ca sv fk bk if sk us ss ssc rc rcd sd ud cs club calcio balompie futbol fussball de di da del la le el los and".split()


@F.pandas_udf(T.StringType())
def decomposed(name: pd.Series) -> pd.Series:
    """Compatibility decomposition without combining marks, for the few names that aren't ASCII."""
    return name.map(lambda x: None if x is None else "".join(ch for ch in unicodedata.normalize("NFKD", x) if not unicodedata.combining(ch)))


def words(name: Column, generic: list[str] = GENERIC) -> Column:
    """FN-23: a name's words in lower case, accents folded, generic words and numbers left out, each once, sorted."""
    ascii_ = F.lower(F.regexp_replace(name, "[^A-Za-z0-9 ]+", " "))
    plain = F.when(name.rlike(r"[^\x00-\x7F]"), F.regexp_replace(F.lower(decomposed(F.when(name.rlike(r"[^\x00-\x7F]"), name))), "[^a-z0-9 ]+", " ")).otherwise(ascii_)
    own = F.filter(F.split(plain, " +"), lambda w: (w != "") & ~w.isin(*generic) & ~w.rlike(r"^[0-9]{2,4}$"))
    return F.array_sort(F.array_distinct(own))


def overlap(a: Column, b: Column) -> Column:
    """FN-24, its part that needs no alignment: 100 times the shared words over the fewer words, and 10 for each shared one;
    0 where a name has no words."""
    n, least = F.size(F.array_intersect(a, b)), F.least(F.size(a), F.size(b))
    return F.when(a.isNull() | b.isNull(), None).when(least > 0, 100 * n / least + 10 * n).otherwise(0.0)


@F.pandas_udf(T.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """FN-24: ratio of matching runs of two strings; an Arrow UDF, for pairs that a join has already narrowed down."""
    known = {(x, y): SequenceMatcher(None, x, y).ratio() for x, y in set(zip(a, b)) if x is not None and y is not None}
    return pd.Series([known.get(pair) for pair in zip(a, b)], dtype="float64")


def similarity(a: Column, b: Column) -> Column:
    """FN-24: overlap plus the matching-run ratio of the sorted words; 0 where a name has no words."""
    return similarity_of_words(words(a), words(b))


def similarity_of_words(wa: Column, wb: Column) -> Column:
    """The same of the names' words, as words() gives them."""
    return F.when(F.least(F.size(wa), F.size(wb)) > 0, overlap(wa, wb) + sequence_ratio(F.array_join(wa, " "), F.array_join(wb, " "))).otherwise(overlap(wa, wb))


def settlement(outcomes: Column, prices: Column, closed: Column, status: Column) -> Column:
    """FN-27: struct(y, status) of a two-outcome question from its JSON lists: resolved with y 1 or 0 if Yes and No pay 1 and 0,
    non_binary_resolution for other payouts, NULL while open or where the lists are not a Yes and a No."""
    o, p = F.from_json(outcomes, "array<string>"), F.transform(F.from_json(prices, "array<string>"), lambda x: x.try_cast("double"))
    known = closed & (status == "resolved") & (F.size(o) == 2) & (F.size(p) == 2) & F.array_contains(o, "Yes") & F.array_contains(o, "No")
    yes = F.when(F.get(o, F.lit(0)) == "Yes", F.get(p, F.lit(0))).otherwise(F.get(p, F.lit(1)))
    no = F.when(F.get(o, F.lit(0)) == "Yes", F.get(p, F.lit(1))).otherwise(F.get(p, F.lit(0)))
    binary = ((yes == 1) & (no == 0)) | ((yes == 0) & (no == 1))
    of = lambda y, why: F.struct(y.cast("int").alias("y"), F.lit(why).alias("status"))
    return F.when(known & binary, of(yes, "resolved")).when(known & yes.isNotNull() & no.isNotNull(), of(F.lit(None), "non_binary_resolution"))


def level(price: Column, size: Column) -> Column:
    """FN-28: struct(price, size, deletion) of a book level's texts; NULL unless 0 <= price <= 1 and size >= 0. Size 0 deletes."""
    p, q = price.try_cast("decimal(20,6)"), size.try_cast("decimal(20,6)")
    return F.when(p.between(0, 1) & (q >= 0), F.struct(p.alias("price"), q.alias("size"), (q == 0).alias("deletion")))


def match_minute(period: Column, start_s: Column, status: Column, at_ms: Column) -> Column:
    """FN-18: minutes played at a time, 45 and on in the second period; NULL unless in progress in one of the two."""
    elapsed = (at_ms / 1000 - start_s) / 60
    return F.when(period.isin(1, 2) & (status == "inprogress") & (elapsed >= 0), F.when(period == 1, 0).otherwise(45) + elapsed)


def minute_hint(clock: Column) -> Column:
    """FN-19: the minute that a display clock states. Added time stays within its period, so 45+2 is 45; other texts and minutes
    over 120 are unknown."""
    minute = F.regexp_extract(F.trim(clock), "^([0-9]{1,3})(?:[+][0-9]{1,2})?['\u2032]?$", 1).try_cast("int")
    return F.when(minute <= 120, minute)


def all_known(*checks: Column) -> Column:
    """Three-valued: false if one is false, else unknown if one is unknown, else true. SQL's AND."""
    out = checks[0]
    for x in checks[1:]:
        out = out & x
    return out


GENERIC_SQL = "[" + ", ".join(f"'{w}'" for w in GENERIC) + "]"


def words_sql(x: str) -> str:
    return f"list_sort(list_distinct(list_filter(string_split(regexp_replace(lower(strip_accents({x})), '[^a-z0-9 ]+', ' ', 'g'), ' '), lambda w: w <> '' AND NOT list_contains({GENERIC_SQL}, w) AND NOT regexp_full_match(w, '[0-9]{{2,4}}'))))"


@query("fn23_name_words", f"SELECT p_partkey, array_to_string({words_sql('p_name')}, ' ') AS words FROM part")
def fn23(spark: SparkSession, d: str) -> DataFrame:
    return V.table(spark, d, "part").select("p_partkey", F.array_join(words(c("p_name")), " ").alias("words"))


PAIRS = f"""t AS (SELECT DISTINCT p_brand, p_type, {words_sql('p_type')} AS w FROM part), m AS (SELECT a.p_brand, a.p_type AS ta, b.p_type AS tb, len(list_intersect(a.w, b.w)) AS n, least(len(a.w), len(b.w)) AS k FROM t a JOIN t b ON a.p_brand = b.p_brand),
q AS (SELECT a.p_partkey AS a, b.p_partkey AS b, CASE WHEN k > 0 THEN 100.0 * n / k + 10 * n ELSE 0 END AS o FROM m JOIN part a ON a.p_brand = m.p_brand AND a.p_type = ta JOIN part b ON b.p_brand = m.p_brand AND b.p_type = tb AND a.p_partkey < b.p_partkey)"""


def brand_pairs(spark: SparkSession, d: str, measure: Callable[[Column, Column], Column], name: str, run: int = 256) -> DataFrame:
    """All pairs of parts of the same brand with the measure of their types, which is taken once for two different types (in
    either order, as it may not be symmetric) and then given to the parts that have them.

    The keys of a brand and type are cut into sorted runs of `run` parts. Runs are paired, but for those whose pairs would all be
    the wrong way round, and dealt evenly to the tasks, which hold the pairs of two runs at a time."""
    p = V.table(spark, d, "part").select(c("p_partkey").alias("key"), c("p_brand").alias("brand"), c("p_type").alias("type")).where("key IS NOT NULL AND brand IS NOT NULL")
    at = F.floor((F.row_number().over(Window.partitionBy("brand", "type").orderBy("key")) - 1) / run)
    runs = p.withColumn("run", at).groupBy("brand", "type", "run").agg(F.collect_list("key").alias("keys"), F.min("key").alias("least"), F.max("key").alias("most"))
    one = p.select("brand", c("type").alias("ta")).distinct()
    types = one.join(one.withColumnRenamed("ta", "tb"), "brand").withColumn(name, measure(c("ta"), c("tb")))
    a, b = (runs.select(*[c(x).alias(f"{x}_{side}") for x in runs.columns]) for side in "ab")
    left = types.join(a, (c("brand") == c("brand_a")) & c("ta").eqNullSafe(c("type_a")))
    both = left.join(b, (c("brand") == c("brand_b")) & c("tb").eqNullSafe(c("type_b")) & (c("least_a") < c("most_b")))
    dealt = both.select("brand", "ta", "tb", "run_a", "run_b", "keys_a", "keys_b", name).repartition("brand", "ta", "tb", "run_a", "run_b")
    return dealt.select(F.explode("keys_a").alias("a"), "keys_b", name).select("a", F.explode("keys_b").alias("b"), name).where("a < b")


@query("fn24_name_overlap", f"WITH {PAIRS} SELECT a, b, round(o, 6) AS overlap FROM q")
def fn24(spark: SparkSession, d: str) -> DataFrame:
    """Shared words of the names of all pairs of a brand."""
    return brand_pairs(spark, d, lambda a, b: half_up(overlap(words(a), words(b)), 6), "overlap")


@query("fn24_sequence_ratio")
def fn24_ratio(spark: SparkSession, d: str) -> DataFrame:
    """The whole similarity, matching-run ratio included, of the same pairs; no SQL has it."""
    return brand_pairs(spark, d, lambda a, b: F.round(similarity(a, b), 6), "ratio")


@query("fn27_settlement", """WITH m AS (SELECT o_orderkey, o_orderstatus <> 'O' AS closed, CASE WHEN o_orderkey % 5 = 0 THEN 'proposed' ELSE 'resolved' END AS status,
CASE WHEN o_orderkey % 7 = 0 THEN ['Up', 'Down'] WHEN o_orderkey % 2 = 0 THEN ['Yes', 'No'] ELSE ['No', 'Yes'] END AS o, CASE o_orderkey % 4 WHEN 0 THEN [1.0, 0.0] WHEN 1 THEN [0.0, 1.0] WHEN 2 THEN [0.5, 0.5] ELSE [1.0] END AS p FROM orders),
y AS (SELECT *, closed AND status = 'resolved' AND len(p) = 2 AND list_contains(o, 'Yes') AS known, p[list_position(o, 'Yes')] AS yes FROM m)
SELECT o_orderkey, CAST(CASE WHEN known AND yes IN (0, 1) THEN yes END AS INT) AS y, CASE WHEN known AND yes IN (0, 1) THEN 'resolved' WHEN known THEN 'non_binary_resolution' END AS status FROM y""")
def fn27(spark: SparkSession, d: str) -> DataFrame:
    k = c("o_orderkey")
    outcomes = F.when(k % 7 == 0, '["Up", "Down"]').when(k % 2 == 0, '["Yes", "No"]').otherwise('["No", "Yes"]')
    prices = F.when(k % 4 == 0, '["1", "0"]').when(k % 4 == 1, '["0", "1"]').when(k % 4 == 2, '["0.5", "0.5"]').otherwise('["1"]')
    s = settlement(outcomes, prices, c("o_orderstatus") != "O", F.when(k % 5 == 0, "proposed").otherwise("resolved"))
    return V.table(spark, d, "orders").select(k, s.alias("s")).select("o_orderkey", "s.y", "s.status")


@query("fn28_level_validation", """WITH t AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 7 THEN 'NaN' ELSE CAST(CAST(l_discount * 12 AS DECIMAL(10,2)) AS VARCHAR) END AS p, CASE l_orderkey % 3 WHEN 0 THEN '0' WHEN 1 THEN '-1.5' ELSE CAST(CAST(l_quantity AS DECIMAL(10,2)) AS VARCHAR) END AS q FROM lineitem),
v AS (SELECT *, TRY_CAST(p AS DECIMAL(20,6)) AS price, TRY_CAST(q AS DECIMAL(20,6)) AS size FROM t), w AS (SELECT *, coalesce(price BETWEEN 0 AND 1 AND size >= 0, false) AS valid FROM v)
SELECT l_orderkey, l_linenumber, valid, CAST(CASE WHEN valid THEN price END AS DOUBLE) AS price, CAST(CASE WHEN valid THEN size END AS DOUBLE) AS size, CASE WHEN valid THEN size = 0 END AS deletion FROM w""")
def fn28(spark: SparkSession, d: str) -> DataFrame:
    text = lambda x: x.cast("decimal(10,2)").cast("string")
    price = F.when(c("l_linenumber") == 7, "NaN").otherwise(text(c("l_discount") * 12))
    size = F.when(c("l_orderkey") % 3 == 0, "0").when(c("l_orderkey") % 3 == 1, "-1.5").otherwise(text(c("l_quantity")))
    rows = V.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", level(price, size).alias("v"))
    return rows.select("l_orderkey", "l_linenumber", c("v").isNotNull().alias("valid"), c("v.price").cast("double").alias("price"), c("v.size").cast("double").alias("size"), "v.deletion")


@query("fn18_match_minute", """SELECT event_id, round(CASE WHEN k % 4 IN (1, 2) AND event_type <> 'signup' AND e >= 0 THEN CASE WHEN k % 4 = 1 THEN 0 ELSE 45 END + e END, 6) AS minute
FROM (SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS INT) AS k, (epoch_us(ts) // 1000 / 1000.0 - (epoch_us(ts) // 1000000 // 3600 * 3600 + 600)) / 60 AS e FROM events)""")
def fn18(spark: SparkSession, d: str) -> DataFrame:
    k = F.from_json("props", "k int")["k"]
    start = F.floor(V.epoch("ts") / 3600) * 3600 + 600
    status = F.when(c("event_type") == "signup", "halftime").otherwise("inprogress")
    return rounded(V.events(spark, d).select("event_id", match_minute(k % 4, start, status, V.millis("ts")).alias("minute")))


CLOCKS = ("45+2'", "90'", "HT", "121", "7\u2032", " 12 ", "45+123", "90+4")


CLOCK_SQL = "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in CLOCKS) + "]"


@query("fn19_clock", f"WITH t AS (SELECT event_id, trim({CLOCK_SQL}[event_id % 9 + 1]) AS t FROM events), m AS (SELECT event_id, TRY_CAST(regexp_extract(t, '^([0-9]{{1,3}})(?:[+][0-9]{{1,2}})?[''\u2032]?$', 1) AS INT) AS m FROM t) SELECT event_id, CASE WHEN m <= 120 THEN m END AS minute FROM m")
def fn19(spark: SparkSession, d: str) -> DataFrame:
    clock = F.try_element_at(F.array(*[F.lit(x) for x in CLOCKS]), (c("event_id") % 9 + 1).cast("int"))
    return V.events(spark, d).select("event_id", minute_hint(clock).alias("minute"))


def next_hour_of_day(ts: Column, hour: int = 6) -> Column:
    """FN-34: the first time of that hour after ts."""
    at = F.date_trunc("day", ts).cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(hour))
    return F.when(ts >= at, at + F.expr("INTERVAL 1 DAY")).otherwise(at)


def best_artifacts(artifacts: DataFrame, today: Column, key: str, day: str) -> DataFrame:
    """PRJ-19: each key's artifact of today, else the latest before."""
    return artifacts.where(c(day) <= today).groupBy(key).agg(F.max(day).alias("best"))


def backfill_plan(spark: SparkSession, first: str, last: str, built: DataFrame) -> DataFrame:
    """PRJ-20: the days of a range that are not in built(day)."""
    days = spark.sql(f"SELECT explode(sequence(date'{first}', date'{last}')) AS day")
    return days.join(built.select("day").distinct(), "day", "left_anti")


def in_scope(sec: Column, config: Column, least_s: int, configs: list[str]) -> Column:
    """PRJ-08: from a second of the window on, for some configurations."""
    return (sec >= least_s) & config.isin(*configs)


def under_configs(rows: DataFrame, configs: list[tuple[int, float]]) -> DataFrame:
    """JN-24: every row under every configuration (id, threshold), the configurations as an array on the row."""
    one = F.array(*[F.struct(F.lit(i).alias("config_id"), F.lit(t).alias("thr")) for i, t in configs])
    return rows.select("*", F.explode(one).alias("_k")).select(*rows.columns, "_k.*")


def strike_violations(prices: DataFrame, group: str, strike: str, price: str) -> DataFrame:
    """PRJ-12: each strike's price with that of the next strike; a lower strike that costs no less is a violation, NULL where one is
    missing (0). Equal prices count."""
    b = prices.withColumn("nxt", F.lead(price).over(Window.partitionBy(group).orderBy(strike))).where("nxt IS NOT NULL")
    return b.withColumn("violation", F.when((c(price) != 0) & (c("nxt") != 0), c(price) >= c("nxt")))


@query("fn34_daily_schedule", "SELECT o_orderkey, date_trunc('day', o_orderdate) + INTERVAL 6 HOUR + CASE WHEN o_orderdate >= date_trunc('day', o_orderdate) + INTERVAL 6 HOUR THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END AS settle_at FROM orders")
def fn34(spark: SparkSession, d: str) -> DataFrame:
    o = V.table(spark, d, "orders").withColumn("ts", c("o_orderdate").cast("timestamp_ntz"))
    return o.select("o_orderkey", next_hour_of_day(c("ts")).alias("settle_at"))


@query("prj08_scope", "SELECT event_id FROM events WHERE extract(minute FROM ts) * 60 + floor(extract(second FROM ts)) >= 720 AND event_type IN ('click', 'view')")
def prj08(spark: SparkSession, d: str) -> DataFrame:
    return V.events(spark, d).where(in_scope(F.minute("ts") * 60 + F.floor(F.second("ts")), c("event_type"), 720, ["click", "view"])).select("event_id")


@query("prj19_best_artifact", "SELECT o_custkey, max(o_orderdate) AS best FROM orders WHERE o_orderdate <= TIMESTAMP '1996-06-01' GROUP BY o_custkey")
def prj19(spark: SparkSession, d: str) -> DataFrame:
    o = V.table(spark, d, "orders").withColumn("o_orderdate", c("o_orderdate").cast("timestamp_ntz"))
    return best_artifacts(o, F.lit("1996-06-01").cast("timestamp_ntz"), "o_custkey", "o_orderdate")


@query("prj20_backfill_plan", "SELECT strftime(d, '%Y-%m-%d') AS day FROM (SELECT unnest(generate_series(TIMESTAMP '2023-12-25', TIMESTAMP '2024-02-05', INTERVAL 1 DAY)) AS d) WHERE CAST(d AS DATE) NOT IN (SELECT CAST(ts AS DATE) FROM events)")
def prj20(spark: SparkSession, d: str) -> DataFrame:
    built = V.events(spark, d).select(F.to_date("ts").alias("day"))
    return backfill_plan(spark, "2023-12-25", "2024-02-05", built).select(c("day").cast("string").alias("day"))


@query("jn24_configs", "SELECT e.event_id, k.id AS config_id, e.value > k.thr AS hit FROM events e, (VALUES (1, 100.0), (2, 250.0), (3, 400.0)) k(id, thr)")
def jn24(spark: SparkSession, d: str) -> DataFrame:
    k = under_configs(V.events(spark, d).select("event_id", "value"), [(1, 100.0), (2, 250.0), (3, 400.0)])
    return k.select("event_id", "config_id", (c("value") > c("thr")).alias("hit"))


@query("prj12_strike_monotonic", "WITH a AS (SELECT l_orderkey, l_linenumber AS k, max(l_discount) AS p FROM lineitem GROUP BY ALL), b AS (SELECT *, lead(p) OVER (PARTITION BY l_orderkey ORDER BY k) AS nxt FROM a) SELECT l_orderkey, k, p, nxt, CASE WHEN p = 0 OR nxt = 0 THEN NULL ELSE p >= nxt END AS violation FROM b WHERE nxt IS NOT NULL")
def prj12(spark: SparkSession, d: str) -> DataFrame:
    a = V.table(spark, d, "lineitem").groupBy("l_orderkey", c("l_linenumber").alias("k")).agg(F.max("l_discount").alias("p"))
    return strike_violations(a, "l_orderkey", "k", "p")


@query("str24_poll_schedule", V.sql("fires mids", "WITH s AS (SELECT token, seq, unnest(range(0, 8)) AS i, t FROM fires), p AS (SELECT token, seq, CAST(i AS INT) AS poll, t + i * 600000 AS t FROM s) SELECT p.token, p.seq, p.poll, m.mid FROM p ASOF LEFT JOIN (SELECT token, t, arg_max(mid, seq) AS mid FROM mids GROUP BY ALL) m ON m.token = p.token AND m.t <= p.t"))
def str24(spark: SparkSession, d: str) -> DataFrame:
    """STR-24: each signal's polls at a fixed spacing, with what they see."""
    from tidemill.operators.asof import asof

    p = V.fires(spark, d).withColumn("poll", F.explode(F.sequence(F.lit(0), F.lit(7)))).withColumn("t", c("t") + c("poll") * 600_000)
    return asof(p, V.mids(spark, d), ["mid"]).select("token", "seq", "poll", "mid")
