"""Checked queries over labels, names, types, counts and shares."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from panelkit.functions import scalars as S
from panelkit.operators import features as A
from panelkit.operators import labels as B
from panelkit.operators import ratios as X
from panelkit.operators import schema as H
from panelkit.operators.labels import SHORT_FLAGS
from panelkit.plans import series_pipeline as L
from panelkit.session import shared_dir
from panelkit.sources.tables import write_parquet
from panelkit.workload import inputs as I
from panelkit.workload.inputs import r, tidy, with_inputs
from panelkit.workload.series_cases import COLUMNS, PLACES, STATS, matrix_sql

FLAGS = ", ".join(SHORT_FLAGS)
# All features of the series that have rows.
HAND_FEATURES = """SELECT c.*, summary.* EXCLUDE (file_name), growth.* EXCLUDE (file_name), bins.* EXCLUDE (file_name), wb_value
FROM (SELECT file_name, count(*) AS count_rows FROM series GROUP BY 1) c LEFT JOIN summary USING (file_name)
LEFT JOIN growth USING (file_name) LEFT JOIN bins USING (file_name) LEFT JOIN unit USING (file_name)"""
CODES = I.TARGET_CODES


# -------------------------------------------------------------------------------------------- queries


def prefer_checked(spark, sf):
    return B.prefer(I.flag_table(spark, sf), I.checked_flags(spark, sf))


def not_checked(spark, sf):
    return B.not_in(I.flag_table(spark, sf), I.checked_flags(spark, sf)).select("file_name", *SHORT_FLAGS)


def flag_labels(spark, sf):
    d = I.table(spark, sf, "documents").select(F.col("doc_id").alias("file_name"))
    rows = d.join(I.flag_table(spark, sf), "file_name", "left")
    return rows.select("file_name", S.flags_label(SHORT_FLAGS).alias("labels"))


def labels_seen_once(spark, sf):
    return B.seen_once(_host_labels(spark, sf), "labels")


def _host_labels(spark, sf):
    """Page hosts as labels: some occur once, and shortened ones meet."""
    p = I.table(spark, sf, "pages")
    return p.select("page_id", F.regexp_extract("url", "https?://([^/]+)", 1).alias("labels"))


def rare_label_backoff(spark, sf):
    return B.back_off(_host_labels(spark, sf))


def label_table(spark, sf):
    return B.label_table(I.flag_table(spark, sf), I.checked_flags(spark, sf), SHORT_FLAGS)


def exact_sample(spark, sf):
    return B.sample_rows(I.flag_table(spark, sf), 50, "file_name")


def sampled_keys(spark, sf):
    return B.sample_keys(I.panel(spark, sf), 20, "inn_id")


def labels_with_features(spark, sf):
    """Labels joined to the features of their series; most labels have no series."""
    s, layout = I.series(spark, sf)
    labels = B.label_table(I.flag_table(spark, sf), I.checked_flags(spark, sf), SHORT_FLAGS)
    return tidy(L.labelled_series_features(labels, s, layout))


def scoring_with_flags(spark, sf):
    s, layout = I.series(spark, sf)
    predicted = I.flag_table(spark, sf)
    return tidy(L.scoring_features(s, layout, s.select("file_name"), predicted, SHORT_FLAGS))


def matrix_with_features(spark, sf):
    """All general features of all columns beside a feature table; one of its columns is replaced."""
    s, layout = I.series(spark, sf)
    table = s.groupBy("file_name").agg(F.lit(-1).alias("Pder_length"), F.max("T").alias("T_last"))
    return tidy(L.series_feature_matrix(table, s, layout), coarse=PLACES)


def override_join(spark, sf):
    left = I.flag_table(spark, sf)
    right = I.checked_flags(spark, sf).select("file_name", "wb", F.lit(2).alias("level"))
    return A.override_join(left, right, "file_name")


def constant_columns(spark, sf):
    t = I.table(spark, sf, "region").select("r_regionkey", "r_name")
    n = I.table(spark, sf, "nation").join(t, F.col("n_regionkey") == F.col("r_regionkey"))
    made = n.select(
        "n_nationkey",
        F.length("n_name").alias("size"),
        F.lit("x").alias("same"),
        F.when(F.col("n_nationkey") > 3, 1).alias("same_or_null"),
        F.lit(None).cast("int").alias("empty"),
    )
    return H.drop_constant_columns(made)


def column_ranges(spark, sf):
    li = I.table(spark, sf, "lineitem")
    names = ["l_quantity", "l_extendedprice", "l_discount"]
    ranges = H.column_ranges(li, names)
    rows = [F.struct(F.lit(c).alias("name"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi")) for c, (lo, hi) in ranges.items()]
    return tidy(li.limit(1).select(F.explode(F.array(*rows)).alias("c")).select("c.*"))


def _types(spark, sf, profile):
    li = I.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", (F.col("l_linenumber") - 3).alias("shifted"), "l_returnflag"
    )
    out = H.narrow_types(li, profile)
    pairs = [F.struct(F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type")) for f in out.schema]
    sums = out.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("l_orderkey").cast("bigint")).alias("total"))
    return sums.select("n", "total", F.explode(F.array(*pairs)).alias("c")).select("c.*", "n", "total")


def narrow_unsigned(spark, sf):
    return _types(spark, sf, "unsigned")


def narrow_signed(spark, sf):
    return _types(spark, sf, "signed")


def category_codes(spark, sf):
    o = I.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    o = o.withColumn("o_orderstatus", F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")))
    return H.category_codes(o, ["o_orderpriority", "o_orderstatus", "not_there"])


def indexed_categories(spark, sf):
    c = I.table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    _, out = H.fit_transform(c, category=["c_mktsegment"])
    return out.select("c_custkey", "c_mktsegment", F.col("c_mktsegment_code").cast("int").alias("code"))


def clean_names(spark, sf):
    li = I.table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.sum("l_quantity"), F.max("l_linenumber"))
    return H.rename_columns(li, H.clean_name)


def joined_digits(spark, sf):
    """Names of years and months with and without underscores between digits."""
    o = I.table(spark, sf, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    made = o.select("o_orderstatus", F.col("n").alias("Sum.1996_01(x)"), (F.col("n") + 1).alias("Max_2_3_b"))
    kept = H.rename_columns(made.drop("Max_2_3_b"), lambda c: H.clean_name(c, join_digits=False))
    return H.rename_columns(made, H.clean_name).join(kept, "o_orderstatus")


def renamed(spark, sf):
    return I.table(spark, sf, "nation").withColumnsRenamed({"n_name": "name_1", "n_nationkey": "key"}).select("key", "name_1")


def filled(spark, sf):
    d = I.table(spark, sf, "documents").join(I.table(spark, sf, "labels"), "doc_id", "left")
    out = S.fill(S.fill(d.select("doc_id", "quality", F.when(F.col("lang") != "en", F.col("lang")).alias("lang")), 0), "-", ["lang"])
    return out


def age_buckets(spark, sf):
    p = I.table(spark, sf, "part")
    return p.select("p_partkey", S.edges_below(F.col("p_size") + 18).alias("bucket"), S.edges_below(F.col("p_retailprice") / 20).alias("b2"))


def lookalike_fold(spark, sf):
    """Latin capitals of names written in Cyrillic, folded back."""
    c = I.table(spark, sf, "customer")
    cyrillic = F.translate(F.upper("c_mktsegment"), S.LATIN, S.CYRILLIC)
    return c.select(
        "c_custkey",
        S.fold_lookalikes(cyrillic).alias("folded"),
        S.lookalike_pattern(F.col("c_mktsegment")).alias("pattern"),
    )


def union_parts(spark, sf):
    return X.union_parts([X.merge_counts(p, "code", "rq") for p in I.host_parts(spark, sf)])


def merged_counts(spark, sf):
    return X.merge_counts(X.union_parts(I.host_parts(spark, sf)), "code", "rq")


def merged_users(spark, sf):
    return X.merge_counts(X.union_parts(I.host_parts(spark, sf)), "code", "rq", users="users")


def user_estimates(spark, sf):
    """Sketches stored per part and merged per host and code, and per host, beside the exact numbers: five standard errors at most."""
    folder = f"{shared_dir(spark)}/sketches-{uuid.uuid4().hex}"
    parts = I.host_parts(spark, sf)
    paths = [write_parquet(X.user_sketches(p, "code", "users"), f"{folder}/{i}") for i, p in enumerate(parts)]
    stored = spark.read.parquet(*paths)
    exact = X.merge_counts(X.union_parts(parts), "code", "rq", users="users")
    by_code = exact.join(X.merge_sketches(stored, ["url_host", "code"], "rq"), ["url_host", "code"], "left")
    people = X.union_parts(parts).where("url_host IS NOT NULL AND code IS NOT NULL").select("url_host", "users").distinct()
    hosts = people.groupBy("url_host").agg(F.count("users").alias("rq_user_count"))
    by_host = hosts.join(X.merge_sketches(stored, ["url_host"], "rq"), "url_host", "left").withColumn("code", F.lit("*"))
    both = by_code.drop("rq_count").unionByName(by_host)
    error = F.abs(F.col("rq_user_estimate") - F.col("rq_user_count"))
    bound = 5 * 1.04 / 2 ** (X.SKETCH_PRECISION / 2)
    return both.select("url_host", "code", "rq_user_count", (error <= F.col("rq_user_count") * bound).alias("within"))


def ratio_groups(spark, sf):
    hosts = I.page_hosts(spark, sf)
    return tidy(X.ratio_groups(hosts, "code", "rq", ["en", "de", "fr"]))


def counts_and_ratio(spark, sf):
    return tidy(X.merge_counts_and_ratio(I.host_parts(spark, sf), "code", "rq", CODES, users="users"))


# -------------------------------------------------------------------------------------------- SQL

PREFER = {
    "prefer": """SELECT *, 0 AS hq FROM flags WHERE file_name NOT IN (SELECT file_name FROM checked)
UNION ALL SELECT *, 1 FROM checked"""
}


def _backoff_sql(source):
    steps = {"b5": source}
    for prev, length, name in (("b5", 5, "b3"), ("b3", 3, "b1"), ("b1", 1, "b0")):
        steps[name] = (
            f"SELECT * REPLACE (CASE WHEN count(*) OVER (PARTITION BY labels) = 1 THEN substr(labels, 1, {length}) "
            f"ELSE labels END AS labels) FROM {prev}"
        )
    return steps


HOSTS = "SELECT page_id, regexp_extract(url, 'https?://([^/]+)', 1) AS labels FROM pages"
TABLE_LABELS = "SELECT *, concat(hq, " + ", ".join(SHORT_FLAGS) + ") AS labels FROM prefer"


def _type_sql(profile):
    def ladder(c, own):
        lo, hi = f"min({c})", f"max({c})"
        spare = 1
        cases = []
        for bound, t in ((128, "tinyint"), (32768, "smallint"), (2147483648, "int")):
            if profile == "unsigned":
                cases.append(f"WHEN {lo} >= 0 AND {hi} < {bound} THEN '{t}'")
            cases.append(f"WHEN {lo} > -{bound} AND {hi} < {bound - spare} THEN '{t}'")
        return f"CASE {' '.join(cases)} ELSE '{own}' END"

    cols = {
        "l_orderkey": ladder("l_orderkey", "bigint"),
        "l_partkey": ladder("l_partkey", "bigint"),
        "l_suppkey": ladder("l_suppkey", "bigint"),
        "l_linenumber": ladder("l_linenumber", "int"),
        "l_quantity": "'float'",
        "shifted": ladder("l_linenumber - 3", "int"),
        "l_returnflag": "'string'",
    }
    return " UNION ALL ".join(
        f"SELECT '{c}' AS name, {e} AS type, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS total FROM lineitem" for c, e in cols.items()
    )


MERGED = "SELECT url_host, code, count(*) AS rq_count, count(DISTINCT doc_id) AS rq_user_count FROM parts GROUP BY 1, 2"


def _ratio_sql(source, prefixes, codes, names, extra=None):
    sums, out, avg = [], [], []
    for p in prefixes:
        for c in codes:
            sums.append(f"CAST(coalesce(sum({p}_count) FILTER (code = '{c}'), 0) AS BIGINT) AS {p}_{c}_count")
        total = " + ".join(f"{p}_{c}_count" for c in codes)
        for c in codes:
            out.append(f"coalesce({p}_{c}_count::DOUBLE / nullif({total}, 0), 0) AS {p}_prs_{c}")
    for c in codes:
        mean = " + ".join(f"{p}_prs_{c}" for p in prefixes)
        avg.append(r(f"({mean}) / {len(prefixes)}", f"{prefixes[0]}_avg_prs_{c}"))
    counts = [f"{p}_{c}_count" for p in prefixes for c in codes]
    shares = [r(f"{p}_prs_{c}", f"{p}_prs_{c}") for p in prefixes for c in codes]
    inner = f"SELECT url_host, {', '.join(sums)} FROM {source} GROUP BY 1"
    mid = f"SELECT *, {', '.join(out)} FROM ({inner})"
    return with_inputs(f"SELECT url_host, {', '.join(counts + shares + avg)} FROM ({mid})", *names, extra=extra)


LATIN_TO_CYRILLIC = "translate(upper(c_mktsegment), 'AEKMHOPCTYXB', 'АЕКМНОРСТУХВ')"


def _pattern_sql():
    e = "c_mktsegment"
    for ru, en in zip("АЕКМНОРСТУХВ", "AEKMHOPCTYXB"):
        e = f"regexp_replace({e}, '[{ru}{ru.lower()}{en}{en.lower()}]', '[{ru}{en}]', 'g')"
    return e


CASES = {
    "prefer_checked": (prefer_checked, with_inputs("SELECT * FROM prefer", "flags", "checked", extra=PREFER)),
    "not_checked": (
        not_checked,
        with_inputs(f"SELECT file_name, {FLAGS} FROM flags WHERE file_name NOT IN (SELECT file_name FROM checked)", "flags", "checked"),
    ),
    "flag_labels": (
        flag_labels,
        with_inputs(
            "SELECT doc_id AS file_name, concat("
            + ", ".join(f"coalesce(CAST({c} AS VARCHAR), 'nan')" for c in SHORT_FLAGS)
            + ") AS labels FROM documents LEFT JOIN flags ON doc_id = file_name",
            "flags",
        ),
    ),
    "labels_seen_once": (labels_seen_once, f"SELECT labels FROM ({HOSTS}) GROUP BY labels HAVING count(*) = 1"),
    "rare_label_backoff": (rare_label_backoff, with_inputs("SELECT * FROM b0", extra=_backoff_sql(HOSTS))),
    "label_table": (
        label_table,
        with_inputs("SELECT * FROM b0", "flags", "checked", extra=PREFER | _backoff_sql(TABLE_LABELS)),
    ),
    "exact_sample": (
        exact_sample,
        with_inputs("SELECT * FROM flags ORDER BY md5(CAST(file_name AS VARCHAR) || ':127'), file_name LIMIT 50", "flags"),
    ),
    "sampled_keys": (
        sampled_keys,
        with_inputs(
            "SELECT inn_id FROM (SELECT DISTINCT inn_id FROM panel) ORDER BY md5(CAST(inn_id AS VARCHAR)), inn_id LIMIT 20", "panel"
        ),
    ),
    "labels_with_features": (
        labels_with_features,
        with_inputs(
            f"""SELECT file_name, labels, coalesce(COLUMNS(* EXCLUDE (file_name, labels)), 0)
FROM (SELECT b0.*, f.* EXCLUDE (file_name) FROM b0 LEFT JOIN ({HAND_FEATURES}) f USING (file_name))""",
            "series",
            "flags",
            "checked",
            extra=STATS | PREFER | _backoff_sql(TABLE_LABELS),
        ),
    ),
    "scoring_with_flags": (
        scoring_with_flags,
        with_inputs(
            f"""SELECT file_name, {FLAGS}, f.* EXCLUDE (file_name) FROM flags LEFT JOIN (
SELECT file_name, coalesce(COLUMNS(* EXCLUDE (file_name)), 0) FROM ({HAND_FEATURES})) f USING (file_name)""",
            "series",
            "flags",
            extra=STATS,
        ),
    ),
    "matrix_with_features": (
        matrix_with_features,
        "SELECT m.*, t.T_last FROM ("
        + matrix_sql(COLUMNS, rename=H.clean_feature_name)
        + f") m JOIN ({with_inputs('SELECT file_name, ' + r('coalesce(max(T), 0)', 'T_last') + ' FROM series GROUP BY 1', 'series')}) t USING (file_name)",
    ),
    "override_join": (
        override_join,
        with_inputs(
            "SELECT f.* REPLACE (c.wb AS wb), CASE WHEN c.file_name IS NOT NULL THEN 2 END AS level FROM flags f LEFT JOIN checked c USING (file_name)",
            "flags",
            "checked",
        ),
    ),
    "constant_columns": (
        constant_columns,
        "SELECT n_nationkey, CAST(length(n_name) AS INTEGER) AS size, CAST(NULL AS INTEGER) AS empty FROM nation",
    ),
    "column_ranges": (
        column_ranges,
        " UNION ALL ".join(
            f"SELECT '{c}' AS name, {r(f'min({c})', 'lo')}, {r(f'max({c})', 'hi')} FROM lineitem"
            for c in ("l_quantity", "l_extendedprice", "l_discount")
        ),
    ),
    "narrow_unsigned": (narrow_unsigned, _type_sql("unsigned")),
    "narrow_signed": (narrow_signed, _type_sql("signed")),
    "category_codes": (
        category_codes,
        """SELECT o_orderkey, o_orderpriority, nullif(o_orderstatus, 'F') AS o_orderstatus,
dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS o_orderpriority_code,
CASE WHEN o_orderstatus = 'F' THEN -1 ELSE dense_rank() OVER (PARTITION BY o_orderstatus = 'F' ORDER BY o_orderstatus) - 1 END
  AS o_orderstatus_code FROM orders""",
    ),
    "indexed_categories": (
        indexed_categories,
        """SELECT c_custkey, c_mktsegment, CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER) AS code FROM customer""",
    ),
    "clean_names": (
        clean_names,
        "SELECT l_returnflag, sum(l_quantity) AS sum_l_quantity, max(l_linenumber) AS max_l_linenumber FROM lineitem GROUP BY 1",
    ),
    "joined_digits": (
        joined_digits,
        """SELECT o_orderstatus, count(*) AS "sum_199601_x", count(*) + 1 AS max_23_b, count(*) AS "sum_1996_01_x" FROM orders GROUP BY 1""",
    ),
    "renamed": (renamed, "SELECT n_nationkey AS key, n_name AS name_1 FROM nation"),
    "filled": (
        filled,
        """SELECT doc_id, coalesce(quality, 0) AS quality, coalesce(nullif(lang, 'en'), '-') AS lang
FROM documents LEFT JOIN labels USING (doc_id)""",
    ),
    "age_buckets": (
        age_buckets,
        "SELECT p_partkey, CAST("
        + " + ".join(f"CAST(p_size + 18 > {e} AS INTEGER)" for e in (18, 25, 35, 45, 55, 65))
        + " AS INTEGER) AS bucket, CAST("
        + " + ".join(f"CAST(p_retailprice / 20 > {e} AS INTEGER)" for e in (18, 25, 35, 45, 55, 65))
        + " AS INTEGER) AS b2 FROM part",
    ),
    "lookalike_fold": (
        lookalike_fold,
        f"SELECT c_custkey, upper(c_mktsegment) AS folded, {_pattern_sql()} AS pattern FROM customer",
    ),
    "union_parts": (
        union_parts,
        with_inputs("SELECT url_host, code, count(*) AS rq_count FROM parts GROUP BY part, url_host, code", "parts"),
    ),
    "merged_counts": (merged_counts, with_inputs("SELECT url_host, code, count(*) AS rq_count FROM parts GROUP BY 1, 2", "parts")),
    "merged_users": (merged_users, with_inputs(MERGED, "parts")),
    "user_estimates": (
        user_estimates,
        with_inputs(
            f"""SELECT url_host, code, rq_user_count, true AS within FROM ({MERGED}) UNION ALL
SELECT url_host, '*', count(DISTINCT doc_id), true FROM parts WHERE url_host IS NOT NULL AND code IS NOT NULL GROUP BY 1""",
            "parts",
        ),
    ),
    "ratio_groups": (ratio_groups, _ratio_sql("page_hosts", ["rq"], ["en", "de", "fr"], ["page_hosts"])),
    "counts_and_ratio": (counts_and_ratio, _ratio_sql("merged", ["rq", "rq_user"], CODES, ["parts"], {"merged": MERGED})),
}
