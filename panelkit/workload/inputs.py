"""Inputs of the checked queries, derived from the given tables (see FIXTURES.md), and the same in SQL.

Money is kept in whole cents, so that sums are exact in any order and both engines agree to the last bit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.operators.labels import SHORT_FLAGS
from panelkit.operators.ordered import POS, Layout, measure, number_rows, running
from panelkit.plans.series_pipeline import prepare_series

FIRST_MONDAY = "1995-01-02"
WEEKS = 358
# A panel is grouped by (entity, week), so an entity has at most one row per calendar week.
PANEL_LAYOUT = Layout(("inn_id",), ("week",), WEEKS)
TARGET_CODES = ["en", "de", "es", "fr"]
FOLDS = 5
# Rounding only serves the comparison of engines; the benchmark turns it off.
ROUNDING = True


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def cents(c: str):
    return F.rint(F.col(c) * 100)


def whole(c):
    """Nearest whole number, halves up, as a double."""
    return F.floor(c + 0.5).cast("double")


def panel(spark: SparkSession, sf: str) -> DataFrame:
    week = F.floor(F.datediff(F.to_date("l_shipdate"), F.lit(FIRST_MONDAY).cast("date")) / 7).cast("int")
    # One exchange: the distinct count would send nearly all rows twice, by the keys with the part and by the keys. The rows are kept
    # short: the flags as places in a text (0 for others and NULL), and the discount, of which the amount is worked out behind.
    rows = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("inn_id"),
        week.alias("week"),
        "l_partkey",
        (_place("l_returnflag", "ANR") * 4 + _place("l_linestatus", "FO")).cast("byte").alias("_flags"),
        cents("l_extendedprice").alias("_price"),
        cents("l_discount").alias("_discount"),
    )
    flag, state = F.floor(F.col("_flags") / 4), F.col("_flags") % 4
    classes = [F.sum(F.when(flag == i, F.col("_price")).otherwise(0.0)).alias(f"trn_ce_{f}") for i, f in enumerate("ANR", 1)]
    states = [F.count_if(state == i).alias(f"tvect_{s}") for i, s in enumerate("FO", 1)]
    return (
        rows.repartition("inn_id", "week")
        .groupBy("inn_id", "week")
        .agg(
            F.sum("_price").alias("target"),
            F.sum(whole(F.col("_price") * (100 - F.col("_discount")) / 100)).alias("trns_amount_inp"),
            F.count(F.lit(1)).alias("trns_count_inp"),
            F.count_distinct("l_partkey").alias("cnt_inn_inp"),
            *classes,
            *states,
        )
    )


def _place(c: str, values: str):
    """The place of a one-letter text in ``values`` from 1, 0 for any other and NULL."""
    found = F.lit(0)
    for i, v in enumerate(values, 1):
        found = F.when(F.col(c) == v, i).otherwise(found)
    return found


def days(spark: SparkSession) -> DataFrame:
    start = F.lit(FIRST_MONDAY).cast("date")
    n = spark.range(WEEKS * 7).select(F.col("id").cast("int").alias("n"))
    return n.select(F.date_add(start, F.col("n")).alias("date"), F.floor(F.col("n") / 7).cast("int").alias("week"))


def holidays(spark: SparkSession) -> DataFrame:
    """1 to 8 January, 1 May and 9 May."""
    d, m = F.dayofmonth("date"), F.month("date")
    return days(spark).where(((m == 1) & (d <= 8)) | ((m == 5) & d.isin(1, 9))).select("date")


def order_days(spark: SparkSession, sf: str) -> DataFrame:
    """Days on which something was shipped, with their week."""
    d = F.to_date("l_shipdate").alias("date")
    week = F.floor(F.datediff("date", F.lit(FIRST_MONDAY).cast("date")) / 7).cast("int").alias("week")
    return table(spark, sf, "lineitem").select(d).distinct().select("date", week)


def profiles(spark: SparkSession, sf: str) -> DataFrame:
    s, n, r = (table(spark, sf, t) for t in ("supplier", "nation", "region"))
    bal = F.col("s_acctbal")
    age = (
        F.when(bal < 0, "unknown")
        .when(bal < 1000, "1m")
        .when(bal < 2500, "6_12m")
        .when(bal < 5000, "2_4y")
        .when(bal < 7500, "8_12y")
        .when(bal < 9500, "more_12y")
    )
    form = F.when(F.length("n_name") > 6, "ul").when(bal > 9000, "other").otherwise("ip")
    base = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    base = base.select(
        F.col("s_suppkey").alias("inn_id"),
        form.alias("ipul"),
        F.when(F.col("r_name") != "ASIA", F.col("r_name")).alias("id_region"),
        F.when(F.col("n_name") != "FRANCE", F.col("n_name")).alias("main_okved_group"),
        age.alias("diff_datopen_report_date_flg"),
    )
    old = base.withColumn("report_date", F.lit("2001-01-01").cast("date")).withColumn("ipul", F.lit("ip"))
    return base.withColumn("report_date", F.lit("2001-10-01").cast("date")).unionByName(old)


def template(spark: SparkSession, sf: str) -> DataFrame:
    """Entities with a positive balance, for the week after the last one."""
    return table(spark, sf, "supplier").where("s_acctbal > 0").select(
        F.col("s_suppkey").alias("inn_id"), F.lit(WEEKS - 1).alias("week"), F.lit(0.0).alias("predict")
    )


def _micros(ts):
    return F.unix_micros(ts.cast("timestamp"))


def raw_series(spark: SparkSession, sf: str) -> DataFrame:
    """Events of a user as a series: hours since 2024, running sum and value in cents."""
    rows = table(spark, sf, "events").select(
        F.col("user_id").alias("file_name"),
        "ts",
        "event_id",
        ((_micros(F.col("ts")) - _micros(F.lit("2024-01-01 00:00:00"))) / 3.6e9).alias("time"),
        cents("value").alias("Pder"),
    )
    layout = measure(rows, "file_name", ("ts", "event_id"))
    numbered = number_rows(rows, layout)
    summed = running(numbered, layout.by(POS), {"dP": ("sum", F.col("Pder"))})
    return summed.select("file_name", "ts", "event_id", "time", "dP", "Pder")


def series(spark: SparkSession, sf: str) -> tuple[DataFrame, Layout]:
    """Numbered series in logs with their raw columns."""
    return prepare_series(raw_series(spark, sf), ("ts", "event_id"))


def flag_table(spark: SparkSession, sf: str) -> DataFrame:
    """Eight flags per labelled document."""
    n = F.col("n_chars")
    rows = table(spark, sf, "labels").join(table(spark, sf, "documents"), "doc_id")
    flags = {
        "bq": F.col("quality") == 1,
        "wb": F.col("toxic") == 1,
        "ra": F.col("lang") == "en",
        "li": F.col("lang") == "de",
        "bi": n < 500,
        "sp": n.between(500, 1500),
        "pc": n > 5000,
        "im": F.col("source") == "src0",
    }
    return rows.select(
        F.col("doc_id").alias("file_name"), n.alias("size"), *[f.cast("int").alias(k) for k, f in flags.items()]
    )


def checked_flags(spark: SparkSession, sf: str) -> DataFrame:
    """The second label source: long documents, looked at again."""
    return flag_table(spark, sf).where("size >= 2400").withColumn("wb", F.lit(1))


def long_flags(spark: SparkSession, sf: str) -> DataFrame:
    """(file_name, target, y, proba): a made score per document and flag that leans towards the flag."""
    t = flag_table(spark, sf)
    rows = F.array(
        *[F.struct(F.lit(c).alias("target"), F.lit(i).alias("i"), F.col(c).alias("y")) for i, c in enumerate(SHORT_FLAGS)]
    )
    long = t.select("file_name", "size", F.explode(rows).alias("_r")).select("file_name", "size", "_r.*")
    score = (F.col("file_name") * 31 + F.col("size") * 17 + F.col("i") * 7) % 80 + 20 * F.col("y")
    return long.select("file_name", "target", "i", "y", (score / 100.0).alias("proba"))


def folds(spark: SparkSession, sf: str) -> DataFrame:
    """Five fold predictions of each of two runs for every labelled document."""
    t = flag_table(spark, sf).select("file_name", "size", *SHORT_FLAGS)
    runs = F.explode(F.array(F.lit(40), F.lit(41))).alias("run")
    t = t.select("*", runs).select("*", F.explode(F.sequence(F.lit(1), F.lit(FOLDS))).alias("fold"))
    made = [_fold_score(c, i) for i, c in enumerate(SHORT_FLAGS)]
    return t.select("file_name", "run", "fold", *made)


def _fold_score(c: str, i: int):
    score = (F.col("size") * 13 + F.col("file_name") * 7 + F.col("fold") * 29 + F.col("run") * 3 + i * 11) % 60 + 40 * F.col(c)
    return (score / 100.0).alias(c)


def fold_labels(spark: SparkSession, sf: str) -> DataFrame:
    return folds(spark, sf).withColumns({c: (F.col(c) > 0.5).cast("int") for c in SHORT_FLAGS})


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Panel target with a made prediction."""
    p = panel(spark, sf)
    factor = F.lit(0.9) + ((F.col("inn_id") * 7 + F.col("week")) % 21) / 100.0
    return p.select("inn_id", "week", F.col("target").alias("y"), (F.col("target") * factor).alias("pred"))


def multi_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Three numeric targets per panel row, some marked missing by -99."""
    p = panel(spark, sf)
    shift = ((F.col("inn_id") * 7 + F.col("week")) % 21) / 10.0 - 1.0
    parts = [("target", 1e6), ("trns_amount_inp", 1e6), ("trns_count_inp", 1.0)]
    rows = [
        F.struct(
            F.lit(n).alias("target"),
            F.when(F.col("week") < 10, -99.0).otherwise(F.col(n) / s).alias("y"),
            F.when(F.col("week") < 5, -99.0).otherwise(F.col(n) / s + shift).alias("pred"),
        )
        for n, s in parts
    ]
    return p.select("inn_id", "week", F.explode(F.array(*rows)).alias("_r")).select("inn_id", "week", "_r.*")


def run_predictions(spark: SparkSession, sf: str) -> list[DataFrame]:
    """Three runs of panel predictions; the later ones lack some rows."""
    p = predictions(spark, sf)
    made = []
    for i, lost in enumerate(("false", "week > 300", "y < 2000000")):
        pred = whole(F.col("pred") * (1 + i) / 2)
        made.append(p.where(f"NOT ({lost})").select("inn_id", "week", pred.alias("predict")))
    return made


def host_parts(spark: SparkSession, sf: str) -> list[DataFrame]:
    """Document counts per source, language and document in two parts; the documents are the users."""
    d = table(spark, sf, "documents")
    parts = []
    for cond in ("n_chars < 1500", "n_chars >= 1000"):
        g = d.where(cond).groupBy(F.col("source").alias("url_host"), F.col("lang").alias("code"), F.col("doc_id").alias("users"))
        parts.append(g.agg(F.count(F.lit(1)).alias("rq_count")))
    return parts


def page_hosts(spark: SparkSession, sf: str) -> DataFrame:
    """Page counts per host and first path segment."""
    p = table(spark, sf, "pages")
    host = F.regexp_extract("url", "https?://([^/]+)", 1).alias("url_host")
    code = F.regexp_extract("url", "https?://[^/]+/([^/?#]*)", 1).alias("code")
    return p.groupBy(host, code).agg(F.count(F.lit(1)).alias("rq_count"))


# ---------------------------------------------------------------------------------------------- SQL

_FLAG_LIST = ", ".join(SHORT_FLAGS)


def _fold_sql(c, i):
    return (
        f"((size * 13 + file_name * 7 + fold * 29 + run * 3 + {i * 11}) % 60 + 40 * {c}) / 100.0::DOUBLE AS {c}"
    )


CTE: dict[str, tuple[tuple[str, ...], str]] = {
    "panel": (
        (),
        """SELECT l_suppkey AS inn_id,
  CAST(floor(datediff('day', DATE '1995-01-02', CAST(l_shipdate AS DATE)) / 7.0) AS INTEGER) AS week,
  CAST(sum(round(l_extendedprice * 100)) AS DOUBLE) AS target,
  CAST(sum(floor(round(l_extendedprice * 100) * (100 - round(l_discount * 100)) / 100 + 0.5)) AS DOUBLE) AS trns_amount_inp,
  count(*) AS trns_count_inp, count(DISTINCT l_partkey) AS cnt_inn_inp,
  CAST(sum(CASE WHEN l_returnflag = 'A' THEN round(l_extendedprice * 100) ELSE 0 END) AS DOUBLE) AS trn_ce_A,
  CAST(sum(CASE WHEN l_returnflag = 'N' THEN round(l_extendedprice * 100) ELSE 0 END) AS DOUBLE) AS trn_ce_N,
  CAST(sum(CASE WHEN l_returnflag = 'R' THEN round(l_extendedprice * 100) ELSE 0 END) AS DOUBLE) AS trn_ce_R,
  count(*) FILTER (l_linestatus = 'F') AS tvect_F, count(*) FILTER (l_linestatus = 'O') AS tvect_O
FROM lineitem GROUP BY 1, 2""",
    ),
    "days": (
        (),
        """SELECT CAST(DATE '1995-01-02' + CAST(n AS INTEGER) AS DATE) AS date, CAST(n // 7 AS INTEGER) AS week
FROM range(358 * 7) t(n)""",
    ),
    "holidays": (
        ("days",),
        """SELECT date FROM days WHERE (month(date) = 1 AND day(date) <= 8) OR (month(date) = 5 AND day(date) IN (1, 9))""",
    ),
    "order_days": (
        (),
        """SELECT DISTINCT CAST(l_shipdate AS DATE) AS date,
  CAST(floor(datediff('day', DATE '1995-01-02', CAST(l_shipdate AS DATE)) / 7.0) AS INTEGER) AS week FROM lineitem""",
    ),
    "calendar": (
        ("days", "holidays"),
        """SELECT date, week, CAST(isodow(date) AS INTEGER) AS day_of_week,
  date NOT IN (SELECT date FROM holidays) AS is_workday FROM days""",
    ),
    "weeks": (
        ("calendar",),
        """SELECT week, d1, d2, workdays, weekends,
  CAST(year(d1) - 2021 AS INTEGER) AS year1, CAST(month(d1) AS INTEGER) AS month1, CAST(day(d1) AS INTEGER) AS day1,
  CAST(dayofyear(d1) - CASE WHEN month(d1) > 2 AND year(d1) % 4 = 0 THEN 1 ELSE 0 END AS INTEGER) AS dy1,
  CAST(year(d2) - 2021 AS INTEGER) AS year2, CAST(month(d2) AS INTEGER) AS month2, CAST(day(d2) AS INTEGER) AS day2,
  CAST(dayofyear(d2) - CASE WHEN month(d2) > 2 AND year(d2) % 4 = 0 THEN 1 ELSE 0 END AS INTEGER) AS dy2,
  CAST((month(d2) - month(d1) + 12) % 12 AS INTEGER) AS m, CAST(year(d2) - year(d1) AS INTEGER) AS y,
  (SELECT CAST(quarter(x) AS INTEGER) FROM (SELECT unnest(range(d1, d1 + INTERVAL 7 DAY, INTERVAL 1 DAY)) AS x)
    GROUP BY quarter(x) ORDER BY count(*) DESC, quarter(x) LIMIT 1) AS q
FROM (SELECT week, min(date) AS d1, max(date) AS d2, count(*) FILTER (is_workday) AS workdays,
  count(*) FILTER (NOT is_workday) AS weekends FROM calendar GROUP BY week)""",
    ),
    "profiles": (
        (),
        """SELECT s_suppkey AS inn_id, CASE WHEN k = 0 THEN 'ip' ELSE form END AS ipul,
  CASE WHEN r_name <> 'ASIA' THEN r_name END AS id_region,
  CASE WHEN n_name <> 'FRANCE' THEN n_name END AS main_okved_group, age AS diff_datopen_report_date_flg,
  CASE WHEN k = 0 THEN DATE '2001-01-01' ELSE DATE '2001-10-01' END AS report_date
FROM (SELECT *, CASE WHEN s_acctbal < 0 THEN 'unknown' WHEN s_acctbal < 1000 THEN '1m' WHEN s_acctbal < 2500 THEN '6_12m'
    WHEN s_acctbal < 5000 THEN '2_4y' WHEN s_acctbal < 7500 THEN '8_12y' WHEN s_acctbal < 9500 THEN 'more_12y' END AS age,
    CASE WHEN length(n_name) > 6 THEN 'ul' WHEN s_acctbal > 9000 THEN 'other' ELSE 'ip' END AS form
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
CROSS JOIN (VALUES (0), (1)) v(k)""",
    ),
    "template": (
        (),
        "SELECT s_suppkey AS inn_id, 357 AS week, 0.0::DOUBLE AS predict FROM supplier WHERE s_acctbal > 0",
    ),
    "recoded": (
        ("profiles", "template"),
        """SELECT inn_id, report_date,
  CASE diff_datopen_report_date_flg WHEN '1m' THEN 1 WHEN '2_3m' THEN 3 WHEN '3_6m' THEN 6 WHEN '6_12m' THEN 12
    WHEN '1_2y' THEN 24 WHEN '2_4y' THEN 48 WHEN '4_8y' THEN 96 WHEN '8_12y' THEN 144 WHEN 'more_12y' THEN 192
    ELSE 0 END AS diff_datopen_report_date_flg,
  CASE ipul WHEN 'ip' THEN '0' WHEN 'ul' THEN '1' ELSE ipul END AS ipul,
  coalesce(id_region, '-') AS id_region, coalesce(main_okved_group, '-') AS main_okved_group
FROM profiles WHERE inn_id IN (SELECT inn_id FROM template)""",
    ),
    "latest": (
        ("recoded",),
        """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY inn_id ORDER BY report_date DESC) AS rn
FROM recoded) WHERE rn = 1""",
    ),
    "raw_series": (
        (),
        """SELECT user_id AS file_name, ts, event_id, (epoch_us(ts) - 1704067200000000) / 3.6e9::DOUBLE AS T,
  CAST(sum(round(value * 100)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS P,
  round(value * 100) AS D,
  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos,
  count(*) OVER (PARTITION BY user_id) AS n_rows
FROM events""",
    ),
    "series": (
        ("raw_series",),
        """SELECT *, CASE WHEN T > 0 THEN log10(T) WHEN T = 0 THEN '-inf'::DOUBLE END AS time,
  CASE WHEN P > 0 THEN log10(P) WHEN P = 0 THEN '-inf'::DOUBLE END AS dP,
  CASE WHEN D > 0 THEN log10(D) WHEN D = 0 THEN '-inf'::DOUBLE END AS Pder
FROM raw_series WHERE T >= 0""",
    ),
    "flags": (
        (),
        """SELECT doc_id AS file_name, n_chars AS size, quality AS bq, toxic AS wb,
  CAST(lang = 'en' AS INTEGER) AS ra, CAST(lang = 'de' AS INTEGER) AS li, CAST(n_chars < 500 AS INTEGER) AS bi,
  CAST(n_chars BETWEEN 500 AND 1500 AS INTEGER) AS sp, CAST(n_chars > 5000 AS INTEGER) AS pc,
  CAST(source = 'src0' AS INTEGER) AS im
FROM labels JOIN documents USING (doc_id)""",
    ),
    "checked": (("flags",), "SELECT * REPLACE (1 AS wb) FROM flags WHERE size >= 2400"),
    "long_flags": (
        ("flags",),
        " UNION ALL ".join(
            f"SELECT file_name, '{c}' AS target, {i} AS i, {c} AS y, "
            f"((file_name * 31 + size * 17 + {i * 7}) % 80 + 20 * {c}) / 100.0::DOUBLE AS proba FROM flags"
            for i, c in enumerate(SHORT_FLAGS)
        ),
    ),
    "folds": (
        ("flags",),
        "SELECT file_name, run, fold, "
        + ", ".join(_fold_sql(c, i) for i, c in enumerate(SHORT_FLAGS))
        + " FROM flags CROSS JOIN (VALUES (40), (41)) r(run) CROSS JOIN (VALUES (1), (2), (3), (4), (5)) f(fold)",
    ),
    "fold_labels": (
        ("folds",),
        "SELECT file_name, run, fold, " + ", ".join(f"CAST({c} > 0.5 AS INTEGER) AS {c}" for c in SHORT_FLAGS) + " FROM folds",
    ),
    "predictions": (
        ("panel",),
        """SELECT inn_id, week, target AS y, target * (0.9::DOUBLE + ((inn_id * 7 + week) % 21) / 100.0::DOUBLE) AS pred
FROM panel""",
    ),
    "multi": (
        ("panel",),
        " UNION ALL ".join(
            f"SELECT inn_id, week, '{n}' AS target, CASE WHEN week < 10 THEN -99.0::DOUBLE ELSE {n} / {s}::DOUBLE END AS y, "
            f"CASE WHEN week < 5 THEN -99.0::DOUBLE ELSE {n} / {s}::DOUBLE + (((inn_id * 7 + week) % 21) / 10.0::DOUBLE - 1.0) "
            "END AS pred FROM panel"
            for n, s in (("target", "1e6"), ("trns_amount_inp", "1e6"), ("trns_count_inp", "1.0"))
        ),
    ),
    "runs": (
        ("predictions",),
        " UNION ALL ".join(
            f"SELECT {i} AS run, inn_id, week, floor(pred * {i} / 2 + 0.5) AS predict FROM predictions WHERE NOT ({lost})"
            for i, lost in enumerate(("false", "week > 300", "y < 2000000"), 1)
        ),
    ),
    "parts": (
        (),
        """SELECT 1 AS part, source AS url_host, lang AS code, doc_id FROM documents WHERE n_chars < 1500
UNION ALL SELECT 2, source, lang, doc_id FROM documents WHERE n_chars >= 1000""",
    ),
    "page_hosts": (
        (),
        """SELECT regexp_extract(url, 'https?://([^/]+)', 1) AS url_host,
  regexp_extract(url, 'https?://[^/]+/([^/?#]*)', 1) AS code, count(*) AS rq_count FROM pages GROUP BY 1, 2""",
    ),
}


def with_inputs(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """``body`` behind the CTEs it needs, in order; ``extra`` CTEs follow the named ones."""
    done: dict[str, str] = {}

    def add(n):
        for d in CTE[n][0]:
            add(d)
        done.setdefault(n, CTE[n][1])

    for n in names:
        add(n)
    done |= extra or {}
    return "WITH " + ",\n".join(f"{n} AS ({s})" for n, s in done.items()) + "\n" + body


def rounded(x: str, places: int) -> str:
    """``round(x, places)`` of a double. That function goes through decimals and took longer than windows of hundreds of columns, so
    it only gets values whose scaled fraction lies too near a half to be sure of; the others give the same double without it."""
    scaled = f"({x} * 1e{places}D)"
    clear = f"abs({scaled} - rint({scaled})) + abs({scaled}) * 1e-15D < 0.5D"  # two roundings: off by 2.3e-16 of itself at most
    return f"CASE WHEN {clear} THEN rint({scaled}) / 1e{places}D WHEN {x} = rint({x}) THEN {x} ELSE round({x}, {places}) END"


def tidy(df: DataFrame, places: int = 6, coarse: dict[str, int] | None = None) -> DataFrame:
    """Round doubles so that engines agree; -0.0 becomes 0.0. ``coarse`` gives other places by end of the name."""
    if not ROUNDING:
        return df
    special = {c: n for c in df.columns for end, n in (coarse or {}).items() if c.endswith(end)}
    kinds = (T.DoubleType, T.FloatType)
    cols = [
        f"{rounded(f'cast(`{f.name}` as double)', special.get(f.name, places))} + 0D AS `{f.name}`" if isinstance(f.dataType, kinds) else f"`{f.name}`"
        for f in df.schema
    ]
    return df.selectExpr(*cols)


def r(expr: str, name: str, places: int = 6) -> str:
    """The same in SQL."""
    return f'round(CAST({expr} AS DOUBLE), {places}) + 0.0::DOUBLE AS "{name}"'


