"""Names against many names by an index, and the roles of a match's questions.

Two names can reach a score only if they share enough words, how many follows from their numbers of words; so of each only the
rarest words, all but that many less one, need be looked up (prefix filter), and a word that most names have is looked up last or
not at all. Every pair that reaches the score is found, and no other is measured than those that share such a word.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.functions.clean import rounded
from tidemill.operators.text import overlap, sequence_ratio, similarity_of_words, words, words_sql
from tidemill.plans.registry import query
from tidemill.sources import views as V

c = F.col


def _by_rarity(names: DataFrame, name: str, counts: DataFrame) -> DataFrame:
    """Distinct names with their words, the rarest first."""
    each = names.select(name, F.explode("_w").alias("word")).join(counts, "word")
    return each.groupBy(name).agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "word"))), lambda x: x["word"]).alias("_w"))


def best_matches(names: DataFrame, candidates: DataFrame, least: float = 100.0, measure: Callable[[Column, Column], Column] = similarity_of_words, slack: float = 1.0) -> DataFrame:
    """FN-24, JN-17: for each of names(name) the candidates(candidate) of the greatest measure, of at least `least`: name, candidate,
    score, margin (over the runner-up that reaches `least`; NULL without one). Ties go to the candidate that comes first.

    measure, of two names' words, is overlap's share and count of common words, plus at most `slack`. Names without words, and those
    that no candidate reaches, have no row; repeated names have one."""
    a = names.select("name").distinct().withColumn("_w", words(c("name"))).where(F.size("_w") > 0)
    b = candidates.select("candidate").distinct().withColumn("_w", words(c("candidate"))).where(F.size("_w") > 0)
    counts = a.select(F.explode("_w").alias("word")).unionByName(b.select(F.explode("_w").alias("word"))).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    sizes = [[r[0] for r in x.select(F.size("_w")).distinct().collect()] for x in (a, b)]  # at most as many as the longest name has words

    def indexed(x: DataFrame, name: str, own: str, other: str, others: list[int]) -> DataFrame:
        y = _by_rarity(x, name, counts).withColumn(own, F.size("_w")).withColumn(other, F.explode(F.array(*map(F.lit, others))) if others else F.lit(0))
        fewer = F.least(own, other)
        need = F.greatest(F.ceil((F.lit(least) - slack) / (100 / fewer + 10)), F.lit(1)).cast("int")
        return y.where(need <= fewer).select(name, F.array_sort("_w").alias(f"{own}w"), own, other, F.explode(F.slice("_w", F.lit(1), c(own) - need + 1)).alias("word"))

    pairs = indexed(a, "name", "_ka", "_kb", sizes[1]).join(indexed(b, "candidate", "_kb", "_ka", sizes[0]), ["word", "_ka", "_kb"]).select("name", "candidate", "_kaw", "_kbw").dropDuplicates(["name", "candidate"])
    scored = pairs.withColumn("score", measure(c("_kaw"), c("_kbw"))).where(c("score") >= least)
    w = Window.partitionBy("name").orderBy(F.desc("score"), "candidate")
    top = scored.withColumn("_at", F.row_number().over(w)).withColumn("_next", F.lead("score").over(w)).where("_at = 1")
    return top.select("name", "candidate", "score", (c("score") - c("_next")).alias("margin"))


MARKET = "array<struct<kind: string, question: string, outcomes: string, tokens: string, start_ms: bigint>>"
MONEYLINE = ("moneyline", "child_moneyline")


def nearer_team(asked: DataFrame, least: float) -> DataFrame:
    """asked(who, home, away), distinct, with near: home or away, to which who is more similar, if that reaches `least`; else NULL.

    Each name is cut into words once. A similarity is the overlap of words and a ratio of 1 at most, so strings are only aligned
    where the ratio can decide: where the overlaps are that near to each other, or to `least`."""
    names = asked.select(F.explode(F.array("who", "home", "away")).alias("name")).distinct().withColumn("_w", words(c("name")))
    for x in ("who", "home", "away"):
        asked = asked.join(names.select(c("name").alias(x), c("_w").alias(f"_{x}")), x)
    h, a = overlap(c("_who"), c("_home")), overlap(c("_who"), c("_away"))
    most = F.greatest(h, a)
    open_ = (most + 1 >= least) & ((F.abs(h - a) <= 1) | (most < least))
    text = lambda w: F.array_join(w, " ")
    more = lambda w: F.coalesce(sequence_ratio(F.when(open_ & (F.size("_who") > 0) & (F.size(w) > 0), text("_who")), text(w)), F.lit(0.0))
    x = asked.select("who", "home", "away", (h + more("_home")).alias("to_home"), (a + more("_away")).alias("to_away"))
    near = F.when((c("to_home") != c("to_away")) & (F.greatest("to_home", "to_away") >= least), F.when(c("to_home") > c("to_away"), "home").otherwise("away"))
    return x.select("who", "home", "away", near.alias("near"))


def event_roles(events: DataFrame, least: float = 100.0) -> DataFrame:
    """FN-25: of events(event_id, title, slug, markets as MARKET, whose outcomes and tokens are JSON lists) those with one question for
    each of home, draw and away, all of one start: event_id, slug, home, away, kickoff_ms, roles (role -> its Yes and No token).

    The title names the teams ("A vs B"); a question "Will X win on ..." is of the team that X is more similar to, if that reaches
    `least`; one that two questions claim, or that has no start, leaves the event out."""
    teams = F.split("title", r"(?i)\s+vs\.?\s+", 2)
    good = events.where((F.size(teams) == 2) & c("slug").rlike(r"^[A-Za-z0-9_-]+$")).select("event_id", "slug", teams[0].alias("home"), teams[1].alias("away"), F.explode("markets").alias("m"))
    who = F.regexp_extract("m.question", r"(?i)^Will\s+(.*?)\s+win on\b", 1)
    x = good.where(c("m.kind").isin(*MONEYLINE)).select("event_id", "slug", "home", "away", "m.*", F.lower("m.question").contains("end in a draw").alias("draw"), who.alias("who"))
    x = x.where(c("draw") | (c("who") != ""))
    asked = ["who", "home", "away"]
    x = x.join(nearer_team(x.where(~c("draw")).select(*asked).distinct(), least), asked, "left")
    texts = lambda n: F.from_json(n, "array<string>")
    x = x.withColumns({"role": F.when(c("draw"), "draw").otherwise(c("near")), "o": texts("outcomes"), "k": texts("tokens")})
    x = x.where(c("role").isNotNull() & (F.size("k") == 2) & (F.array_sort(F.array_distinct("o")) == F.array(F.lit("No"), F.lit("Yes"))))
    token = lambda side: F.get("k", F.array_position("o", side) - 1)
    one = x.select("event_id", "slug", "home", "away", "role", "start_ms", F.struct(token("Yes").alias("yes"), token("No").alias("no")).alias("pair"))
    role = one.groupBy("event_id", "slug", "home", "away", "role").agg(F.count(F.lit(1)).alias("n"), F.min("start_ms").alias("lo"), F.max("start_ms").alias("hi"), F.first("pair").alias("pair"))
    whole = role.groupBy("event_id", "slug", "home", "away").agg(F.count(F.lit(1)).alias("roles_n"), F.max("n").alias("n"), F.count("lo").alias("starts"), F.min("lo").alias("kickoff_ms"), F.max("hi").alias("hi"), F.map_from_entries(F.collect_list(F.struct("role", "pair"))).alias("roles"))
    return whole.where("roles_n = 3 AND n = 1 AND starts = 3 AND kickoff_ms = hi").select("event_id", "slug", "home", "away", "kickoff_ms", "roles")


@query("fn24_best_match", f"""WITH a AS (SELECT DISTINCT p_brand || ' ' || p_name || ' ' || p_type AS name FROM part), b AS (SELECT DISTINCT p_name || ' ' || p_type AS candidate FROM part),
x AS (SELECT name, {words_sql('name')} AS w FROM a), y AS (SELECT candidate, {words_sql('candidate')} AS v FROM b),
s AS (SELECT name, candidate, 100.0 * len(list_intersect(w, v)) / least(len(w), len(v)) + 10 * len(list_intersect(w, v)) AS score FROM x, y WHERE len(w) > 0 AND len(v) > 0),
r AS (SELECT *, row_number() OVER q AS i, lead(score) OVER q AS nxt FROM s WHERE score >= 80 WINDOW q AS (PARTITION BY name ORDER BY score DESC, candidate))
SELECT name, candidate, round(score, 6) AS score, round(score - nxt, 6) AS margin FROM r WHERE i = 1""")
def fn24_best(spark: SparkSession, d: str) -> DataFrame:
    """Every part's full name against all names without a brand, by shared words."""
    p = V.table(spark, d, "part")
    full, short = F.concat_ws(" ", "p_brand", "p_name", "p_type"), F.concat_ws(" ", "p_name", "p_type")
    return rounded(best_matches(p.select(full.alias("name")), p.select(short.alias("candidate")), 80.0, overlap, 0.0))


@query("fn25_event_roles", """WITH o AS (SELECT o_orderkey AS k, 'Alpha' || (o_custkey % 50) AS h, 'Beta' || (o_orderkey % 50) AS w, o_orderkey * 1000 AS t FROM orders)
SELECT k AS event_id, 'm-' || k AS slug, h || ' United' AS home, w || ' City' AS away, t AS kickoff_ms, 'y' || k || 'h' AS home_yes, 'n' || k || 'd' AS draw_no, 'n' || k || 'a' AS away_no
FROM o WHERE k % 7 <> 0 AND k % 11 <> 0 AND k % 13 <> 0 AND k % 17 <> 0 AND k % 19 <> 0 AND k % 23 <> 0""")
def fn25_roles(spark: SparkSession, d: str) -> DataFrame:
    """Orders as matches; some lack their draw, claim a role twice, have a bad slug, two starts, a stranger's question or a torn list."""
    k = c("o_orderkey")
    s = k.cast("string")
    h, a = F.concat(F.lit("Alpha"), (c("o_custkey") % 50).cast("string")), F.concat(F.lit("Beta"), (k % 50).cast("string"))
    pair = lambda x: F.to_json(F.array(F.concat(F.lit("y"), s, F.lit(x)), F.concat(F.lit("n"), s, F.lit(x))))
    one = lambda kind, q, x, start, outcomes='["Yes", "No"]': F.struct(F.lit(kind).alias("kind"), q.alias("question"), (outcomes if isinstance(outcomes, Column) else F.lit(outcomes)).alias("outcomes"), pair(x).alias("tokens"), start.alias("start_ms"))
    t = k * 1000
    win = lambda who: F.concat(F.lit("Will "), who, F.lit(" win on 2024-01-02?"))
    home = one("moneyline", win(F.when(k % 19 == 0, "Gamma").otherwise(h)), "h", t)
    away = one("child_moneyline", win(a), "a", F.when(k % 17 == 0, t + 1).otherwise(t), F.when(k % 23 == 0, '["Yes"').otherwise('["Yes", "No"]'))
    draw = one("moneyline", F.lit("Will the match End in a Draw?"), "d", t)
    total = one("totals", win(h), "x", t)
    markets = F.concat(F.array(home, away, total), F.when(k % 7 != 0, F.array(draw)).otherwise(F.array().cast(MARKET)), F.when(k % 11 == 0, F.array(home)).otherwise(F.array().cast(MARKET)))
    orders = V.table(spark, d, "orders").select("o_orderkey", "o_custkey").repartition(spark.sparkContext.defaultParallelism, "o_orderkey")  # the table is one file
    ev = orders.select(k.alias("event_id"), F.concat(h, F.lit(" United vs. "), a, F.lit(" City")).alias("title"), F.concat(F.when(k % 13 == 0, "m ").otherwise("m-"), s).alias("slug"), markets.alias("markets"))
    r = event_roles(ev)
    of = lambda role, side: F.try_element_at("roles", F.lit(role))[side].alias(f"{role}_{side}")
    return r.select("event_id", "slug", "home", "away", "kickoff_ms", of("home", "yes"), of("draw", "no"), of("away", "no"))
