"""Queries for profiling aggregates (section 2.6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattline.operators import profiling as pr
from wattline.plans import sqlgen as S
from wattline.plans.q_cleaning import CLEAN, TYPED, clean, typed
from wattline.plans.registry import register
from wattline.schema import CATEGORICAL_COLUMNS, NUMERIC_COLUMNS, SNAKE_COLUMNS
from wattline.sources.readings import readings

NUM = NUMERIC_COLUMNS
CAT = CATEGORICAL_COLUMNS
TYPED_COLS = ["reading_id"] + SNAKE_COLUMNS
SPARK_TYPES = {"reading_id": "bigint", "date": "timestamp_ntz", "nsm": "bigint",
               **{c: "double" for c in NUM if c != "nsm"}, **{c: "string" for c in CAT}}


def U(cols, tmpl):
    return " UNION ALL ".join(tmpl(c) for c in cols)


def vtext(c):
    """SQL text of a value, as :func:`wattline.operators.profiling.value_text`."""
    if SPARK_TYPES.get(c) == "double":
        return f"rtrim(rtrim(CAST(CAST(CAST({c} AS VARCHAR) AS DECIMAL(38,28)) AS VARCHAR), '0'), '.')"
    return f"CAST({c} AS VARCHAR)"


def vnum(c):
    return f"CAST({c} AS DOUBLE)" if SPARK_TYPES.get(c) in ("double", "bigint") else "CAST(NULL AS DOUBLE)"


@register("g1_shape", S.with_(CLEAN, "SELECT count(*) AS n_rows, CAST(12 AS BIGINT) AS n_cols FROM readings_clean"))
def g1_shape(spark, sf_dir):
    return pr.shape(clean(spark, sf_dir))


@register("g2_missing_pct", S.with_(TYPED, U(TYPED_COLS, lambda c: (
    f"SELECT '{c}' AS column_name, {S.r(f'avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) * 100.0')} "
    "AS pct_missing FROM typed"))))
def g2_missing_pct(spark, sf_dir):
    return pr.missing_pct(typed(spark, sf_dir), TYPED_COLS)


@register("g3_null_counts", S.with_(TYPED + ["nc AS (" + U(TYPED_COLS, lambda c: (
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_null FROM typed")) + ")"],
    "SELECT column_name, n_null FROM nc UNION ALL SELECT '__total__', CAST(sum(n_null) AS BIGINT) FROM nc"))
def g3_null_counts(spark, sf_dir):
    return pr.null_counts(typed(spark, sf_dir), TYPED_COLS)


@register("g4_structure", S.with_(TYPED, U(TYPED_COLS, lambda c: (
    f"SELECT '{c}' AS column_name, '{SPARK_TYPES[c]}' AS data_type, count({c}) AS non_null FROM typed"))))
def g4_structure(spark, sf_dir):
    return pr.structure(typed(spark, sf_dir).select(*TYPED_COLS))


def _describe_sql(c, src="readings_clean", extended=False):
    x = f"CAST({c} AS DOUBLE)"
    parts = [f"'{c}' AS column_name", f"count({c}) AS count", f"{S.r(f'avg({x})', 9)} AS mean",
             f"{S.r(f'stddev_samp({x})')} AS std", f"{S.r(f'min({x})', 9)} AS min",
             f"{S.r(f'quantile_cont({x}, 0.25)', 9)} AS q25", f"{S.r(f'quantile_cont({x}, 0.5)', 9)} AS q50",
             f"{S.r(f'quantile_cont({x}, 0.75)', 9)} AS q75", f"{S.r(f'max({x})', 9)} AS max"]
    if extended:
        parts += [f"{S.r(f'skewness({x})')} AS skew", f"{S.r(f'kurtosis({x})')} AS kurt"]
    return f"SELECT {', '.join(parts)} FROM {src}"


@register("g5_describe", S.with_(CLEAN, U(NUM, _describe_sql)))
def g5_describe(spark, sf_dir):
    return pr.describe(clean(spark, sf_dir), NUM)


def _vc_cte(cols, src, name="vc", dropna=True):
    body = U(cols, lambda c: f"SELECT '{c}' AS column_name, {vtext(c)} AS value, {vnum(c)} AS num FROM {src}")
    where = "WHERE value IS NOT NULL " if dropna else ""
    return (f"{name} AS (SELECT column_name, value, num, count(*) AS n FROM ({body}) {where}"
            "GROUP BY column_name, value, num)")


MODES_CTES = [_vc_cte(NUM, "readings_clean"),
              "modes AS (SELECT vc.* FROM vc JOIN (SELECT column_name, max(n) AS m FROM vc GROUP BY 1) t "
              "ON vc.column_name = t.column_name AND vc.n = t.m)"]


@register("g6_describe_extended", S.with_(CLEAN + MODES_CTES + [
    "d AS (" + U(NUM, lambda c: _describe_sql(c, extended=True)) + ")"],
    "SELECT d.*, modes.value AS mode FROM d LEFT JOIN modes USING (column_name)"))
def g6_describe_extended(spark, sf_dir):
    return pr.describe(clean(spark, sf_dir), NUM, extended=True)


MODE_COLS = NUM + CAT
G7_CTES = [_vc_cte(MODE_COLS, "readings_clean"),
           "modes AS (SELECT vc.* FROM vc JOIN (SELECT column_name, max(n) AS m FROM vc GROUP BY 1) t "
           "ON vc.column_name = t.column_name AND vc.n = t.m)"]


@register("g7_modes", S.with_(CLEAN + G7_CTES, "SELECT column_name, value, n FROM modes"))
def g7_modes(spark, sf_dir):
    return pr.modes_table(clean(spark, sf_dir), MODE_COLS)


@register("g8_categorical_summary", S.with_(CLEAN + [_vc_cte(CAT, "readings_clean")],
    "SELECT column_name, CAST(sum(n) AS BIGINT) AS count, count(*) AS unique, "
    "arg_min(value, (-n, value)) AS top, max(n) AS freq FROM vc GROUP BY column_name"))
def g8_categorical_summary(spark, sf_dir):
    return pr.categorical_summary(clean(spark, sf_dir), CAT)


@register("g9_value_counts", S.with_(TYPED + [_vc_cte(CAT, "typed", dropna=False)],
                                     "SELECT column_name, value, n FROM vc"))
def g9_value_counts(spark, sf_dir):
    return pr.value_counts(typed(spark, sf_dir), CAT).drop("num")


@register("g10_value_share", S.with_(TYPED + [_vc_cte(CAT, "typed")],
    "SELECT column_name, value, " + S.r("n * 1.0 / sum(n) OVER (PARTITION BY column_name)", 9)
    + " AS share FROM vc"))
def g10_value_share(spark, sf_dir):
    return pr.value_share(typed(spark, sf_dir), CAT)


@register("g11_baseline_profile", S.with_(CLEAN, U(NUM, lambda c: (
    f"SELECT '{c}' AS column_name, {S.r(f'avg({c})', 9)} AS mean, {S.r(f'stddev_pop({c})')} AS std, "
    f"{S.r(f'min({c})', 9)} AS min, {S.r(f'max({c})', 9)} AS max FROM readings_clean HAVING count({c}) > 0"))))
def g11_baseline_profile(spark, sf_dir):
    return pr.baseline_profile(clean(spark, sf_dir), NUM)


def _corr_sql(src, digits=6, fn="round"):
    pairs = [(a, b) for a in NUM for b in NUM]
    def rnd(e):
        return S.r(e, digits) if fn == "round" else f"{fn}(CAST({e} AS DOUBLE), {digits}) + 0.0"
    return " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, "
        f"{rnd(f'CASE WHEN isnan(corr({a}, {b})) THEN NULL ELSE corr({a}, {b}) END')} AS corr FROM {src}"
        for a, b in pairs)


LISTWISE = "listwise AS (SELECT * FROM typed WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in NUM) + ")"


@register("g12_corr_listwise", S.with_(TYPED + [LISTWISE], _corr_sql("listwise")))
def g12_corr_listwise(spark, sf_dir):
    return pr.corr_matrix(typed(spark, sf_dir), NUM, listwise=True)


@register("g13_corr_pairwise", S.with_(TYPED, _corr_sql("typed", 2, "round_even")))
def g13_corr_pairwise(spark, sf_dir):
    return pr.corr_matrix(typed(spark, sf_dir), NUM, listwise=False, digits=2, half_even=True)


@register("g14_cov_mean", S.with_(CLEAN, " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, {S.r(f'covar_samp({a}, {b})')} AS cov, "
    f"{S.r(f'avg({a})', 9)} AS mean_a FROM readings_clean" for a in NUM for b in NUM)))
def g14_cov_mean(spark, sf_dir):
    return pr.cov_matrix(clean(spark, sf_dir), NUM)


@register("g15_quartiles", S.with_(CLEAN, U(NUM, lambda c: (
    f"SELECT '{c}' AS column_name, {S.r(f'quantile_cont({c}, 0.25)', 9)} AS q25, "
    f"{S.r(f'quantile_cont({c}, 0.5)', 9)} AS q50, {S.r(f'quantile_cont({c}, 0.75)', 9)} AS q75 "
    "FROM readings_clean"))))
def g15_quartiles(spark, sf_dir):
    return pr.quartiles(clean(spark, sf_dir), NUM)


DUP_COLS = NUM[1:] + CAT


@register("g16_duplicate_count", S.with_(CLEAN, f"SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS n_duplicates, "
                                                f"count(*) AS n_distinct FROM (SELECT count(*) AS n FROM "
                                                f"readings_clean GROUP BY {', '.join(DUP_COLS)})"))
def g16_duplicate_count(spark, sf_dir):
    return pr.duplicate_count(clean(spark, sf_dir), DUP_COLS)


def _hist_ctes(cols, src, bins, tag=""):
    rng = U(cols, lambda c: (
        f"SELECT '{c}' AS column_name, CASE WHEN min({c}) = max({c}) THEN min({c}) - 0.5 ELSE min({c}) END AS lo, "
        f"CASE WHEN min({c}) = max({c}) THEN max({c}) + 0.5 ELSE max({c}) END AS hi, count({c}) AS n FROM {src}"))
    lv = U(cols, lambda c: f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS x FROM {src}")
    return [f"rng{tag} AS ({rng})",
            f"cnt{tag} AS (SELECT lv.column_name, least(CAST(floor((x - lo) * {float(bins)!r} / (hi - lo)) AS BIGINT), "
            f"{bins - 1}) AS bin, count(*) AS count FROM ({lv}) lv JOIN rng{tag} r ON lv.column_name = r.column_name "
            "WHERE x IS NOT NULL GROUP BY 1, 2)",
            f"hist{tag} AS (SELECT g.column_name, g.bin, {S.r(f'lo + g.bin * ((hi - lo) / {float(bins)!r})', 9)} AS lo_edge, "
            f"{S.r(f'lo + (g.bin + 1) * ((hi - lo) / {float(bins)!r})', 9)} AS hi_edge, "
            f"CAST(coalesce(c.count, 0) AS BIGINT) AS count, n, ((hi - lo) / {float(bins)!r}) AS w FROM "
            f"(SELECT column_name, lo, hi, n, CAST(b AS BIGINT) AS bin FROM rng{tag}, range({bins}) t(b)) g "
            f"LEFT JOIN cnt{tag} c ON g.column_name = c.column_name AND g.bin = c.bin)"]


@register("g17_histogram", S.with_(CLEAN + _hist_ctes(NUM, "readings_clean", 30),
                                   "SELECT column_name, bin, lo_edge, hi_edge, count FROM hist"))
def g17_histogram(spark, sf_dir):
    return pr.histogram(clean(spark, sf_dir), NUM, bins=30)


@register("g18_log_histogram", S.with_(CLEAN + _hist_ctes(NUM, "readings_clean", 50),
    "SELECT column_name, bin, lo_edge, hi_edge, count, "
    + S.r("CASE WHEN count > 0 THEN log10(count) END", 9) + " AS log10_count FROM hist"))
def g18_log_histogram(spark, sf_dir):
    return pr.histogram(clean(spark, sf_dir), NUM, bins=50, log_counts=True)


G19_BODY = ("SELECT 'original' AS dataset, column_name, bin, lo_edge, hi_edge, count, "
            + S.r("count / (n * w)", 9) + " AS density FROM hist_o UNION ALL "
            "SELECT 'cleaned', column_name, bin, lo_edge, hi_edge, count, "
            + S.r("count / (n * w)", 9) + " AS density FROM hist_c")


@register("g19_density_histogram", S.with_(CLEAN + _hist_ctes(NUM, "readings", 30, "_o")
                                           + _hist_ctes(NUM, "readings_clean", 30, "_c"), G19_BODY))
def g19_density_histogram(spark, sf_dir):
    a = pr.histogram(readings(spark, sf_dir), NUM, bins=30, density=True).withColumn("dataset", F.lit("original"))
    b = pr.histogram(clean(spark, sf_dir), NUM, bins=30, density=True).withColumn("dataset", F.lit("cleaned"))
    return a.unionByName(b)


def _box_sql(value, src, keys):
    kl = ", ".join(keys)
    sel_k = (kl + ", ") if keys else ""
    grp = f"GROUP BY {kl}" if keys else ""
    join = f"JOIN q USING ({kl})" if keys else "CROSS JOIN q"
    x = f"CAST(t.{value} AS DOUBLE)"
    inside = f"{x} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)"
    return (f"WITH q AS (SELECT {sel_k}quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.5) AS median, "
            f"quantile_cont({value}, 0.75) AS q3 FROM {src} {grp}) "
            f"SELECT {sel_k}{S.r('q1', 9)} AS q1, {S.r('median', 9)} AS median, {S.r('q3', 9)} AS q3, "
            f"{S.r(f'min(CASE WHEN {inside} THEN {x} END)', 9)} AS whisker_lo, "
            f"{S.r(f'max(CASE WHEN {inside} THEN {x} END)', 9)} AS whisker_hi, "
            f"count(CASE WHEN {x} IS NOT NULL AND NOT ({inside}) THEN 1 END) AS n_outliers, count({x}) AS n "
            f"FROM {src} t {join} GROUP BY {sel_k}q1, median, q3")


@register("g20_box_stats", S.with_(CLEAN, U(NUM, lambda c: (
    f"SELECT '{c}' AS column_name, * FROM ({_box_sql(c, 'readings_clean', [])})"))))
def g20_box_stats(spark, sf_dir):
    return pr.box_stats_columns(clean(spark, sf_dir), NUM)


BOX_GROUPS = [("week_status", ["week_status"]), ("day_week", ["day_of_week", "week_status"]),
              ("load_type", ["load_type"])]


def _gkey_sql(keys):
    return " || '|' || ".join(keys)


@register("g21_box_by_group", S.with_(CLEAN, " UNION ALL ".join(
    f"SELECT '{name}' AS grouping, {_gkey_sql(keys)} AS group_key, q1, median, q3, whisker_lo, whisker_hi, "
    f"n_outliers, n FROM ({_box_sql('usage_kwh', 'readings_clean', keys)})" for name, keys in BOX_GROUPS)))
def g21_box_by_group(spark, sf_dir):
    df = clean(spark, sf_dir)
    out = None
    for name, keys in BOX_GROUPS:
        b = pr.box_stats(df, "usage_kwh", keys).select(
            F.lit(name).alias("grouping"), F.concat_ws("|", *keys).alias("group_key"),
            "q1", "median", "q3", "whisker_lo", "whisker_hi", "n_outliers", "n")
        out = b if out is None else out.unionByName(b)
    return out


G22_KEYS = [("day", "strftime(date, '%Y-%m-%d')", lambda: F.date_format("date", "yyyy-MM-dd")),
            ("hour", "CAST(hour(date) AS VARCHAR)", lambda: F.hour("date").cast("string")),
            ("month", "CAST(month(date) AS VARCHAR)", lambda: F.month("date").cast("string"))]


def _g22_sql(replicates=200, seed=42):
    hashes = -(-replicates // pr.PER_HASH)
    u = f"('0x' || substr(md5('{seed}:boot.' || h || ':' || reading_id), 3 * j + 1, 3))::INT"
    weight = " + ".join(f"(u >= {t})::INT" for t in pr.POISSON_STEPS)
    parts = []
    for g, k, _ in G22_KEYS:
        parts.append(
            f"SELECT '{g}' AS grain, a.key, a.n, {S.r('a.mean', 9)} AS mean, {S.r('c.lo')} AS ci_lo, {S.r('c.hi')} AS ci_hi FROM "
            f"(SELECT {k} AS key, count(usage_kwh) AS n, avg(usage_kwh) AS mean FROM readings_clean WHERE usage_kwh IS NOT NULL GROUP BY 1) a JOIN "
            f"(SELECT key, quantile_cont(m, 0.025) AS lo, quantile_cont(m, 0.975) AS hi FROM (SELECT {k} AS key, b, sum(w * usage_kwh) / sum(w) AS m "
            "FROM drawn WHERE w > 0 GROUP BY 1, 2) GROUP BY key) c ON c.key = a.key")
    return S.with_(CLEAN + [
        f"bits AS (SELECT date, usage_kwh, h * {pr.PER_HASH} + j AS b, {u} AS u FROM readings_clean, range({hashes}) x(h), range({pr.PER_HASH}) y(j) "
        f"WHERE usage_kwh IS NOT NULL AND h * {pr.PER_HASH} + j < {replicates})",
        f"drawn AS (SELECT *, {weight} AS w FROM bits)"], " UNION ALL ".join(parts))


@register("g22_mean_ci", _g22_sql())
def g22_mean_ci(spark, sf_dir):
    out = pr.mean_ci_by(clean(spark, sf_dir), "usage_kwh", {g: key() for g, _, key in G22_KEYS}, "reading_id")
    return out.select("key", "n", "mean", "ci_lo", "ci_hi", "grain")


G23_KEYS = [("hour_month", "CAST(hour(date) AS VARCHAR)", "CAST(month(date) AS VARCHAR)",
             lambda: (F.hour("date").cast("string"), F.month("date").cast("string"))),
            ("hour_day_of_week", "CAST(hour(date) AS VARCHAR)", "day_of_week",
             lambda: (F.hour("date").cast("string"), F.col("day_of_week"))),
            ("day_month", "CAST(day(date) AS VARCHAR)", "CAST(month(date) AS VARCHAR)",
             lambda: (F.dayofmonth("date").cast("string"), F.month("date").cast("string")))]


@register("g23_mean_two_keys", S.with_(CLEAN, " UNION ALL ".join(
    f"SELECT '{g}' AS grain, {a} AS key_a, {b} AS key_b, count(*) AS n, {S.r('avg(usage_kwh)', 9)} AS mean "
    "FROM readings_clean GROUP BY 2, 3" for g, a, b, _ in G23_KEYS)))
def g23_mean_two_keys(spark, sf_dir):
    df = clean(spark, sf_dir)
    out = None
    for g, _, _, keys in G23_KEYS:
        ka, kb = keys()
        part = (df.groupBy(ka.alias("key_a"), kb.alias("key_b"))
                  .agg(F.count(F.lit(1)).alias("n"), (F.round(F.avg("usage_kwh"), 9) + F.lit(0.0)).alias("mean"))
                  .withColumn("grain", F.lit(g)))
        out = part if out is None else out.unionByName(part)
    return out


G24_SQL = S.with_(CLEAN + [
    "v AS (SELECT load_type AS grp, usage_kwh AS x FROM readings_clean WHERE usage_kwh IS NOT NULL)",
    "st AS (SELECT *, bw / 64.0 AS fine, lo - 3.0 * bw AS g0, (hi - lo + 2 * 3.0 * bw) / 199.0 AS gs FROM (SELECT grp, count(x) AS n, "
    "stddev_samp(x) * pow(CAST(count(x) AS DOUBLE), -0.2) AS bw, min(x) AS lo, max(x) AS hi FROM v GROUP BY 1) WHERE bw > 0)",
    "cell AS (SELECT v.grp, floor((x - lo) / fine) AS j, (x - lo) / fine - floor((x - lo) / fine) AS f FROM v JOIN st ON v.grp = st.grp)",
    "fine AS (SELECT grp, j, sum(w) AS w FROM (SELECT grp, j, 1 - f AS w FROM cell UNION ALL SELECT grp, j + 1, f FROM cell) GROUP BY 1, 2)",
    "grid AS (SELECT grp, n, bw, lo, fine AS h, CAST(gi AS BIGINT) AS gi, g0 + gi * gs AS gx FROM st, range(200) t(gi))"],
    "SELECT g.grp AS load_type, g.gi AS grid_index, " + S.r("g.gx", 9) + " AS x, "
    + S.r("sum(w * exp(-0.5 * ((gx - (lo + j * h)) / bw) * ((gx - (lo + j * h)) / bw))) / (n * bw * sqrt(2 * pi()))", 9)
    + " AS density FROM grid g JOIN fine f ON f.grp = g.grp GROUP BY g.grp, gi, gx, bw, n")


@register("g24_kde", G24_SQL)
def g24_kde(spark, sf_dir):
    return pr.kde(clean(spark, sf_dir), "usage_kwh", "load_type")


PAIR_COLS = NUM


def _pair_sql():
    rng = U(PAIR_COLS, lambda c: (
        f"SELECT '{c}' AS column_name, CASE WHEN min({c}) = max({c}) THEN min({c}) - 0.5 ELSE min({c}) END AS lo, "
        f"CASE WHEN min({c}) = max({c}) THEN max({c}) + 0.5 ELSE max({c}) END AS hi FROM readings_clean"))
    parts = []
    for i, a in enumerate(PAIR_COLS):
        for b in PAIR_COLS[i + 1:]:
            parts.append(
                f"SELECT '{a}' AS col_a, '{b}' AS col_b, least(CAST(floor((t.{a} - ra.lo) * 10.0 / (ra.hi - ra.lo)) AS BIGINT), 9) AS bin_a, "
                f"least(CAST(floor((t.{b} - rb.lo) * 10.0 / (rb.hi - rb.lo)) AS BIGINT), 9) AS bin_b "
                f"FROM readings_clean t, rng ra, rng rb WHERE ra.column_name = '{a}' AND rb.column_name = '{b}' "
                f"AND t.{a} IS NOT NULL AND t.{b} IS NOT NULL")
    return S.with_(CLEAN + [f"rng AS ({rng})"],
                   "SELECT col_a, col_b, bin_a, bin_b, count(*) AS n FROM (" + " UNION ALL ".join(parts) + ") GROUP BY 1, 2, 3, 4")


@register("g25_pair_bins", _pair_sql())
def g25_pair_bins(spark, sf_dir):
    return pr.pair_bins(clean(spark, sf_dir), PAIR_COLS, bins=10)


@register("g26_retention", S.with_(CLEAN, "SELECT (SELECT count(*) FROM readings) AS rows_before, "
                                          "(SELECT count(*) FROM readings_clean) AS rows_after, "
                                          "round_even((SELECT count(*) FROM readings_clean) * 100.0 / "
                                          "(SELECT count(*) FROM readings), 2) + 0.0 AS retention_pct"))
def g26_retention(spark, sf_dir):
    return pr.retention(readings(spark, sf_dir), clean(spark, sf_dir))


@register("g27_class_counts", S.with_(CLEAN, "SELECT load_type, count(*) AS n FROM readings_clean GROUP BY 1"))
def g27_class_counts(spark, sf_dir):
    return pr.class_counts(clean(spark, sf_dir), "load_type")
