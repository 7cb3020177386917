"""Registered queries over the driver tables, each with its DuckDB oracle.

Every query reads the given tables (whole tables, whole texts) and returns a
DataFrame whose column names equal the oracle's. Computed doubles are rounded
to 6 decimals on both sides (summation order differs between engines).

The reference's data (11 numeric features + an integer quality label) is not available, so the
column-parametric operators run on the driver tables:
events (value, user_id; label event_type), documents (n_chars, word count),
labels (quality), lineitem (quantity, price, discount, tax; label
l_linenumber), part (range rules), embeddings (logit slices as given model
probabilities). Nulls are injected where an operator needs them
(value null when event_id % 10 = 0, user_id null when event_id % 7 = 0).
Pseudo predictions on lineitem stand in for a given prediction table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievekit.functions import features as fx
from sievekit.functions.vectors import argmax_first
from sievekit.operators import cleaning, evaluation, profile, selection, splitting, voting
from sievekit.sources.tables import load_table, read_split, table, write_split
from sievekit.session import work_dir

R = 6  # decimals for computed doubles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def rnd(c):
    return F.round(F.col(c) if isinstance(c, str) else c, R)


# ---------------------------------------------------------------- inputs
def events_with_gaps(spark, d) -> DataFrame:
    ev = table(spark, d, "events")
    return ev.select(
        "event_id", "event_type",
        F.when(F.col("event_id") % 10 == 0, F.lit(None)).otherwise(F.col("value")).alias("value"),
        F.when(F.col("event_id") % 7 == 0, F.lit(None)).otherwise(F.col("user_id")).alias("user_id"))


EV_GAPS_SQL = """ev AS (SELECT event_id, event_type,
  CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END AS value,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE user_id END AS user_id FROM events)"""


def docs_words(spark, d) -> DataFrame:
    return table(spark, d, "documents").select(
        "doc_id", F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split("text", " ")).cast("double").alias("words"))


DOCS_SQL = """d AS (SELECT doc_id, n_chars::DOUBLE AS n_chars,
  len(string_split(text, ' '))::DOUBLE AS words FROM documents)"""


def lineitem_features(spark, d) -> DataFrame:
    li = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    return fx.rename_features(li, {"l_quantity": "quantity", "l_extendedprice": "price",
                                   "l_discount": "discount", "l_tax": "tax"})


LI_SQL = """li AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity AS quantity,
  l_extendedprice AS price, l_discount AS discount, l_tax AS tax FROM lineitem)"""

N_PSEUDO_MODELS = 3


def li_row_id():
    """Unique lineitem row id: (orderkey, partkey, suppkey, linenumber) as text."""
    return F.concat_ws("-", *[F.col(c).cast("string") for c in
                              ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")])


def pseudo_predictions(spark, d, li: DataFrame | None = None, keep: tuple = ()) -> DataFrame:
    """A given prediction table: (row_id, y, model, position, pred) for 3 pseudo models.

    Model m replaces the true class when (l_orderkey + l_partkey*m) % (m+2) = 0.
    One scan; the models' rows come from exploding an array of structs, so
    anything computed upstream (``li`` with ``keep`` columns) is computed once."""
    li = li if li is not None else table(spark, d, "lineitem")
    per_model = [F.struct(F.lit(f"model_{m}").alias("model"), F.lit(m).alias("position"),
                          _pseudo_prediction(m).alias("pred")) for m in range(1, N_PSEUDO_MODELS + 1)]
    return li.select(li_row_id().alias("row_id"), F.col("l_linenumber").alias("y"), *keep,
                     F.explode(F.array(*per_model)).alias("_m")) \
             .select("row_id", "y", "_m.model", "_m.position", "_m.pred", *keep)


PRED_SQL = """pp AS (
  SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS row_id, l_linenumber AS y, 'model_' || m AS model,
         m AS position,
         CAST(CASE WHEN (l_orderkey + l_partkey * m) % (m + 2) = 0
              THEN ((l_linenumber + l_suppkey % 3) % 7) + 1 ELSE l_linenumber END AS INTEGER) AS pred
  FROM lineitem, (SELECT unnest([1, 2, 3]) AS m))"""


def _pseudo_prediction(m: int):
    wrong = ((F.col("l_linenumber") + F.col("l_suppkey") % 3) % 7) + 1
    return F.when((F.col("l_orderkey") + F.col("l_partkey") * m) % (m + 2) == 0, wrong) \
            .otherwise(F.col("l_linenumber")).cast("int")


def model1(spark, d) -> DataFrame:
    """The first model's rows alone; no other model's are made."""
    return table(spark, d, "lineitem").select(li_row_id().alias("row_id"), F.col("l_linenumber").alias("y"),
                                              F.lit("model_1").alias("model"), F.lit(1).alias("position"),
                                              _pseudo_prediction(1).alias("pred"))


N_CLASSES = 10


def given_probabilities(emb, m: int):
    """Given model m's probabilities: softmax over 10 classes; the logit of
    class c is the sum of all embedding elements i with (i + m) mod 10 = c."""
    values = F.col(emb).cast("array<double>") if isinstance(emb, str) else emb.cast("array<double>")
    logits = F.transform(F.sequence(F.lit(0), F.lit(N_CLASSES - 1)), lambda c: F.aggregate(
        F.filter(values, lambda x, i: (i + m) % N_CLASSES == c), F.lit(0.0), lambda acc, x: acc + x))
    z = F.transform(logits, F.exp)
    # one evaluation of z, bound to a lambda variable
    return F.get(F.transform(F.array(z), lambda e: F.transform(
        e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda acc, y: acc + y))), F.lit(0))


PROBS_SQL = """zi AS (SELECT vec_id, label, embedding, unnest(range(0, 64)) AS i FROM embeddings),
zm AS (SELECT vec_id, label, m, (i + m) % 10 AS c, sum(embedding[i + 1]::DOUBLE) AS l
  FROM zi, (SELECT unnest([0, 1, 2]) AS m) GROUP BY ALL),
z AS (SELECT vec_id, label, m, c, exp(l) AS z FROM zm),
probs AS (SELECT vec_id, label, m, c, z / sum(z) OVER (PARTITION BY vec_id, m) AS p FROM z)"""


def x1_sql(base: str, id_col: str, label: str, extra: str = "") -> str:
    """Oracle for the exact stratified 80/20 split of ``base``."""
    return f"""base AS ({base}),
cnt AS (SELECT {label} AS lab, count(*) AS c FROM base GROUP BY 1),
tot AS (SELECT sum(c) AS n, (sum(c) + 4) // 5 AS n_test FROM cnt),
fl AS (SELECT lab, c, (n_test * c) // n AS f, (n_test * c) % n AS rem, n_test FROM cnt, tot),
al AS (SELECT lab, f + CASE WHEN row_number() OVER (ORDER BY rem DESC, lab) <=
             n_test - sum(f) OVER () THEN 1 ELSE 0 END AS t FROM fl),
rk AS (SELECT base.*, row_number() OVER (PARTITION BY {label}
         ORDER BY md5(CAST({id_col} AS VARCHAR) || '|42'), {id_col}) - 1 AS rnk FROM base),
sp AS (SELECT rk.* EXCLUDE (rnk), CASE WHEN rnk < t THEN 'test' ELSE 'train' END AS split
       FROM rk JOIN al ON rk.{label} = al.lab){extra}"""


def x2_sql(base: str, id_col: str, label: str, k: int = 5) -> str:
    return f"""base AS ({base}),
fo AS (SELECT base.*, CAST((row_number() OVER (PARTITION BY {label}
         ORDER BY md5(CAST({id_col} AS VARCHAR) || '|42'), {id_col}) - 1) % {k} AS INTEGER) AS fold
       FROM base)"""


# ---------------------------------------------------------------- flagship
@register("flagship", "WITH " + """b AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
  FROM events),
kept AS (SELECT event_id, event_type, value, ln(1 + value) AS log_value
  FROM events, b WHERE value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1)), """
          + x1_sql("SELECT * FROM kept", "event_id", "event_type") + """
SELECT split, event_type, count(*) AS n, round(avg(value), 6) AS mean_value,
       round(avg(log_value), 6) AS mean_log_value FROM sp GROUP BY split, event_type""")
def q_flagship(spark, d):
    """events -> IQR filter on value (C3) -> log1p (F5) -> stratified split
    -> per (split, class) counts and means."""
    ev = table(spark, d, "events").select("event_id", "event_type", "value")
    kept, _ = cleaning.filter_outliers(ev, ["value"], count_outliers=False)
    feat = kept.withColumn("log_value", fx.log1p("value"))
    sp = splitting.stratified_holdout(feat, "event_type", "event_id", 0.2, 42)
    return sp.groupBy("split", "event_type").agg(
        F.count(F.lit(1)).alias("n"), rnd(F.avg("value")).alias("mean_value"),
        rnd(F.avg("log_value")).alias("mean_log_value"))


# ---------------------------------------------------------------- sources
@register("s1_load_csv", "SELECT event_id, event_type, value FROM events")
def q_s1(spark, d):
    """CSV with header round trip through the shared folder, explicit schema."""
    path = work_dir(spark, "s1csv")
    table(spark, d, "events").select("event_id", "event_type", "value") \
        .write.mode("overwrite").option("header", True).csv(path)
    return load_table(spark, path, "event_id bigint, event_type string, value double", fmt="csv")


@register("s2_normalise_missing", """SELECT event_type,
  count(*) FILTER (WHERE v IS NULL OR isnan(v)) AS n_missing,
  round(avg(CASE WHEN isnan(v) THEN NULL ELSE v END), 6) AS mean_value
FROM (SELECT event_type, CASE WHEN event_id % 10 = 0 THEN 'NaN'::DOUBLE ELSE value END AS v
      FROM events) GROUP BY event_type""")
def q_s2(spark, d):
    ev = table(spark, d, "events").select(
        "event_type", F.when(F.col("event_id") % 10 == 0, F.lit(float("nan")))
                       .otherwise(F.col("value")).alias("v"))
    ev = cleaning.normalise_missing(ev, ["v"])
    return ev.groupBy("event_type").agg(F.count_if(F.col("v").isNull()).alias("n_missing"),
                                        rnd(F.avg("v")).alias("mean_value"))


@register("s3_attach_label", """SELECT d.doc_id, d.n_chars, d.lang, l.quality, l.toxic
FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def q_s3(spark, d):
    from sievekit.sources.tables import attach_label
    docs = table(spark, d, "documents").select("doc_id", "n_chars", "lang")
    return attach_label(docs, table(spark, d, "labels"), "doc_id")


@register("s4_s5_split_roundtrip", "WITH " + x1_sql(
    "SELECT d.doc_id, d.n_chars, l.quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id",
    "doc_id", "quality") + "\nSELECT doc_id, n_chars, quality, split FROM sp WHERE split = 'test'")
def q_s4_s5(spark, d):
    """S4 write one table partitioned by split, S5 read back the test partition."""
    base = table(spark, d, "documents").select("doc_id", "n_chars").join(
        table(spark, d, "labels").select("doc_id", "quality"), "doc_id")
    sp = splitting.stratified_holdout(base, "quality", "doc_id")
    path = write_split(sp, work_dir(spark, "split"))
    return read_split(spark, path, "test").select("doc_id", "n_chars", "quality", "split")


# ---------------------------------------------------------------- profiling
@register("p1_shape", "SELECT count(*) AS n_rows, 6::BIGINT AS n_cols FROM events")
def q_p1(spark, d):
    return profile.shape(table(spark, d, "events"))


@register("p2_missing_per_column", "WITH " + EV_GAPS_SQL + """
SELECT * FROM (
  SELECT 'event_id' AS column_name, count(*) FILTER (WHERE event_id IS NULL) AS n_missing FROM ev
  UNION ALL SELECT 'event_type', count(*) FILTER (WHERE event_type IS NULL) FROM ev
  UNION ALL SELECT 'value', count(*) FILTER (WHERE value IS NULL) FROM ev
  UNION ALL SELECT 'user_id', count(*) FILTER (WHERE user_id IS NULL) FROM ev) WHERE n_missing > 0""")
def q_p2(spark, d):
    return profile.missing_per_column(events_with_gaps(spark, d))


@register("p3_missing_total", "WITH " + EV_GAPS_SQL + """
SELECT (count(*) FILTER (WHERE value IS NULL) + count(*) FILTER (WHERE user_id IS NULL))::BIGINT
  AS n_missing FROM ev""")
def q_p3(spark, d):
    return profile.missing_total(events_with_gaps(spark, d))


@register("p4_duplicate_count", """SELECT (count(*) - (SELECT count(*) FROM
  (SELECT DISTINCT text, lang, source, n_chars FROM documents)))::BIGINT AS n_duplicates FROM documents""")
def q_p4(spark, d):
    return profile.duplicate_count(table(spark, d, "documents").drop("doc_id"))


@register("p5_label_distribution",
          "SELECT event_type, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY 1")
def q_p5(spark, d):
    return profile.label_distribution(table(spark, d, "events"), "event_type")


@register("p6_label_moments", """SELECT round(avg(l_linenumber::DOUBLE), 6) AS label_mean,
  round(stddev_samp(l_linenumber::DOUBLE), 6) AS label_std FROM lineitem""")
def q_p6(spark, d):
    m = profile.label_moments(table(spark, d, "lineitem"), "l_linenumber")
    return m.select(rnd("label_mean").alias("label_mean"), rnd("label_std").alias("label_std"))


@register("p7_class_count", "SELECT count(DISTINCT l_linenumber) AS n_classes FROM lineitem")
def q_p7(spark, d):
    return profile.class_count(table(spark, d, "lineitem"), "l_linenumber")


_LI_NUM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
           "l_extendedprice", "l_discount", "l_tax"]


@register("p8_numeric_columns", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL"
    + (f" OR isnan({c})" if c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax") else "")
    + ") AS n_missing FROM lineitem" for c in _LI_NUM))
def q_p8(spark, d):
    li = table(spark, d, "lineitem")
    return profile.missing_per_column(li, profile.numeric_columns(li), only_positive=False)


# ---------------------------------------------------------------- cleaning
@register("c1_impute_median", "WITH " + EV_GAPS_SQL + """
SELECT event_id, coalesce(value, (SELECT median(value) FROM ev)) AS value,
  coalesce(user_id::DOUBLE, (SELECT median(user_id::DOUBLE) FROM ev)) AS user_id FROM ev""")
def q_c1(spark, d):
    ev = events_with_gaps(spark, d).withColumn("user_id", F.col("user_id").cast("double"))
    filled, _ = cleaning.impute_median(ev, ["value", "user_id"])
    return filled.select("event_id", "value", "user_id")


@register("c1_impute_integer", """WITH ev AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE user_id END AS user_id FROM events),
m AS (SELECT quantile_cont(user_id::DOUBLE, 0.5) AS mu FROM ev)
SELECT event_id, coalesce(user_id::DOUBLE, mu) AS user_id FROM ev, m""")
def q_c1_int(spark, d):
    """C1 on an integer column as it is: filled values may lie between integers."""
    ev = table(spark, d, "events").select(
        "event_id", F.when(F.col("event_id") % 7 == 0, F.lit(None)).otherwise(F.col("user_id")).alias("user_id"))
    filled, _ = cleaning.impute_median(ev, ["user_id"])
    return filled


@register("c2_iqr_bounds", """SELECT column_name, round(q1, 6) AS q1, round(q3, 6) AS q3,
  round(q1 - 1.5 * (q3 - q1), 6) AS lower, round(q3 + 1.5 * (q3 - q1), 6) AS upper FROM (
  SELECT 'value' AS column_name, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
  FROM events
  UNION ALL SELECT 'user_id', quantile_cont(user_id::DOUBLE, 0.25), quantile_cont(user_id::DOUBLE, 0.75)
  FROM events)""")
def q_c2(spark, d):
    ev = table(spark, d, "events")
    b = cleaning.iqr_bounds(ev, ["value", "user_id"])
    return _bounds_frame(spark, ev, b)


def _bounds_frame(spark, src: DataFrame, bounds: dict) -> DataFrame:
    """Bounds (a few scalars per column, computed from the table) as a frame."""
    rows = [(c, *v) for c, v in bounds.items()]
    df = spark.createDataFrame(rows, "column_name string, q1 double, q3 double, "
                                     "lower double, upper double")
    return df.select("column_name", *[rnd(c).alias(c) for c in ("q1", "q3", "lower", "upper")])


def _seq_sql(first: str, second: str, final: str) -> str:
    return "WITH " + DOCS_SQL + f""",
b1 AS (SELECT quantile_cont({first}, 0.25) AS q1, quantile_cont({first}, 0.75) AS q3 FROM d),
s1 AS (SELECT d.* FROM d, b1 WHERE {first} >= q1 - 1.5 * (q3 - q1) AND {first} <= q3 + 1.5 * (q3 - q1)),
b2 AS (SELECT quantile_cont({second}, 0.25) AS q1, quantile_cont({second}, 0.75) AS q3 FROM s1),
s2 AS (SELECT s1.* FROM s1, b2 WHERE {second} >= q1 - 1.5 * (q3 - q1) AND {second} <= q3 + 1.5 * (q3 - q1))
{final}"""


@register("c3_sequential_outliers",
          _seq_sql("n_chars", "words", "SELECT doc_id, n_chars, words FROM s2"))
def q_c3(spark, d):
    kept, _ = cleaning.filter_outliers(docs_words(spark, d), ["n_chars", "words"],
                                       count_outliers=False, checkpoint=True)
    return kept.select("doc_id", "n_chars", "words")


@register("c3_sequential_outliers_reversed",
          _seq_sql("words", "n_chars", "SELECT doc_id, n_chars, words FROM s2"))
def q_c3r(spark, d):
    kept, _ = cleaning.filter_outliers(docs_words(spark, d), ["words", "n_chars"],
                                       count_outliers=False, checkpoint=True)
    return kept.select("doc_id", "n_chars", "words")


@register("c3_simultaneous_outliers", """WITH b AS (SELECT
  quantile_cont(value, 0.25) AS v1, quantile_cont(value, 0.75) AS v3,
  quantile_cont(user_id::DOUBLE, 0.25) AS u1, quantile_cont(user_id::DOUBLE, 0.75) AS u3 FROM events)
SELECT event_id, value, user_id FROM events, b
WHERE value >= v1 - 1.5 * (v3 - v1) AND value <= v3 + 1.5 * (v3 - v1)
  AND user_id >= u1 - 1.5 * (u3 - u1) AND user_id <= u3 + 1.5 * (u3 - u1)""")
def q_c3s(spark, d):
    ev = table(spark, d, "events").select("event_id", "value", "user_id")
    kept, _ = cleaning.filter_outliers(ev, ["value", "user_id"], mode="simultaneous",
                                       count_outliers=False)
    return kept


@register("c4_outlier_counts", _seq_sql("n_chars", "words", """
SELECT 'n_chars' AS column_name, round(q1 - 1.5 * (q3 - q1), 6) AS lower,
  round(q3 + 1.5 * (q3 - q1), 6) AS upper,
  (SELECT count(*) FROM d WHERE n_chars < q1 - 1.5 * (q3 - q1) OR n_chars > q3 + 1.5 * (q3 - q1))
  AS n_outliers FROM b1
UNION ALL
SELECT 'words', round(q1 - 1.5 * (q3 - q1), 6), round(q3 + 1.5 * (q3 - q1), 6),
  (SELECT count(*) FROM s1 WHERE words < q1 - 1.5 * (q3 - q1) OR words > q3 + 1.5 * (q3 - q1))
FROM b2"""))
def q_c4(spark, d):
    _, report = cleaning.filter_outliers(docs_words(spark, d), ["n_chars", "words"], checkpoint=True)
    rows = [(r["column_name"], r["lower"], r["upper"], r["n_outliers"]) for r in report]
    df = spark.createDataFrame(rows, "column_name string, lower double, upper double, n_outliers bigint")
    return df.select("column_name", rnd("lower").alias("lower"), rnd("upper").alias("upper"),
                     "n_outliers")


@register("c5_drop_duplicates", "SELECT DISTINCT text, lang, source, n_chars FROM documents")
def q_c5(spark, d):
    return cleaning.drop_exact_duplicates(table(spark, d, "documents").drop("doc_id"))


@register("c5_first_per_text", """SELECT text, doc_id, lang, source, n_chars FROM documents
QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1""")
def q_c5k(spark, d):
    docs = table(spark, d, "documents")
    out = cleaning.drop_exact_duplicates(docs, subset=["text"], order_by="doc_id")
    return out.select("text", "doc_id", "lang", "source", "n_chars")


PART_RULES = [("p_size", 1, 40, 25), ("p_retailprice", 920.0, 990.0, 950.0)]


@register("c5_repeats_under_unique_ids", """SELECT min(doc_id) AS doc_id, text, lang, n_chars FROM documents
GROUP BY text, lang, n_chars""")
def q_c5_ids(spark, d):
    """Rows that agree in everything but the id; the lowest id stays."""
    docs = table(spark, d, "documents").select("doc_id", "text", "lang", "n_chars")
    return cleaning.drop_exact_duplicates(docs, id_col="doc_id")


@register("c6_validate_ranges", """SELECT p_partkey,
  concat_ws(',', CASE WHEN NOT (p_size BETWEEN 1 AND 40) THEN 'p_size' END,
                 CASE WHEN NOT (p_retailprice BETWEEN 920.0 AND 990.0) THEN 'p_retailprice' END)
    AS violations,
  (p_size BETWEEN 1 AND 40) AND (p_retailprice BETWEEN 920.0 AND 990.0) AS is_valid FROM part""")
def q_c6(spark, d):
    checked = cleaning.validate_ranges(table(spark, d, "part"), PART_RULES)
    return checked.select("p_partkey", F.concat_ws(",", "violations").alias("violations"), "is_valid")


@register("c7_apply_defaults", "WITH " + EV_GAPS_SQL + """
SELECT event_id, coalesce(value, 7.0) AS value, coalesce(user_id, 0) AS user_id FROM ev""")
def q_c7(spark, d):
    out = cleaning.apply_defaults(events_with_gaps(spark, d), {"value": 7.0, "user_id": 0})
    return out.select("event_id", "value", "user_id")


@register("c8_require_complete", """SELECT event_id,
  CASE WHEN event_id % 13 = 0 THEN NULL ELSE value END AS value_txt,
  CASE WHEN event_id % 17 = 0 THEN NULL ELSE user_id::DOUBLE END AS user_txt,
  concat_ws(',', CASE WHEN event_id % 13 = 0 THEN 'value_txt' END,
                 CASE WHEN event_id % 17 = 0 THEN 'user_txt' END) AS missing_fields,
  NOT (event_id % 13 = 0 OR event_id % 17 = 0) AS accepted FROM events""")
def q_c8(spark, d):
    raw = table(spark, d, "events").select(
        "event_id",
        F.when(F.col("event_id") % 13 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string"))
         .alias("value_txt"),
        F.when(F.col("event_id") % 17 == 0, F.lit("")).otherwise(F.col("user_id").cast("string"))
         .alias("user_txt"))
    out = cleaning.require_complete(raw, ["value_txt", "user_txt"])
    return out.select("event_id", "value_txt", "user_txt",
                      F.concat_ws(",", "missing_fields").alias("missing_fields"), "accepted")


# ---------------------------------------------------------------- features
@register("f1_rename", "WITH " + LI_SQL + "\nSELECT l_orderkey, l_linenumber, quantity, price, discount, tax FROM li")
def q_f1(spark, d):
    return lineitem_features(spark, d).select("l_orderkey", "l_linenumber", "quantity", "price",
                                              "discount", "tax")


@register("f2_split_label", "WITH " + LI_SQL + "\nSELECT l_orderkey, quantity, price, discount, tax FROM li")
def q_f2(spark, d):
    x, _ = fx.split_label(lineitem_features(spark, d).select(
        "l_orderkey", "l_linenumber", "quantity", "price", "discount", "tax"), "l_linenumber")
    return x


@register("f3_ratio_eps", "WITH " + LI_SQL + """
SELECT l_orderkey, l_linenumber, round(price / (quantity + 1e-8), 6) AS price_per_qty,
  round(discount / (tax + 1e-8), 6) AS discount_tax_ratio FROM li""")
def q_f3(spark, d):
    li = lineitem_features(spark, d)
    return li.select("l_orderkey", "l_linenumber",
                     rnd(fx.ratio("price", "quantity", 1e-8)).alias("price_per_qty"),
                     rnd(fx.ratio("discount", "tax", 1e-8)).alias("discount_tax_ratio"))


@register("f4_ratio_plain", "WITH " + LI_SQL + """
SELECT l_orderkey, l_linenumber,
  round(CASE WHEN tax = 0 THEN NULL ELSE price / tax END, 6) AS price_tax_ratio FROM li""")
def q_f4(spark, d):
    li = lineitem_features(spark, d)
    return li.select("l_orderkey", "l_linenumber", rnd(fx.ratio("price", "tax")).alias("price_tax_ratio"))


@register("f5_log1p", "WITH " + LI_SQL + """
SELECT l_orderkey, l_linenumber, round(ln(1 + discount), 6) AS log_discount,
  round(CASE WHEN tax - 1.0 > -1 THEN ln(1 + (tax - 1.0)) END, 6) AS log_tax_shift FROM li""")
def q_f5(spark, d):
    li = lineitem_features(spark, d)
    return li.select("l_orderkey", "l_linenumber", rnd(fx.log1p("discount")).alias("log_discount"),
                     rnd(fx.log1p(F.col("tax") - 1.0)).alias("log_tax_shift"))


@register("f6_square", "WITH " + LI_SQL + """
SELECT l_orderkey, l_linenumber, round(quantity * quantity, 6) AS quantity_squared,
  round(price * price, 2) AS price_squared FROM li""")
def q_f6(spark, d):
    li = lineitem_features(spark, d)
    return li.select("l_orderkey", "l_linenumber", rnd(fx.square("quantity")).alias("quantity_squared"),
                     F.round(fx.square("price"), 2).alias("price_squared"))


BAND_SQL = """CASE WHEN quantity > 0 AND quantity <= 10 THEN 'low'
  WHEN quantity > 10 AND quantity <= 12 THEN 'medium'
  WHEN quantity > 12 AND quantity <= 15 THEN 'high' END"""


@register("f7_bins", "WITH " + LI_SQL + f"\nSELECT l_orderkey, l_linenumber, {BAND_SQL} AS quantity_band FROM li")
def q_f7(spark, d):
    li = lineitem_features(spark, d)
    return li.select("l_orderkey", "l_linenumber", fx.bin_right_closed(
        "quantity", fx.ALCOHOL_EDGES, fx.ALCOHOL_LEVELS).alias("quantity_band"))


@register("f8_one_hot", "WITH " + LI_SQL + f""", b AS (SELECT l_orderkey, l_linenumber, {BAND_SQL} AS band FROM li)
SELECT l_orderkey, l_linenumber, coalesce(band = 'low', false)::INTEGER AS qty_low,
  coalesce(band = 'medium', false)::INTEGER AS qty_medium,
  coalesce(band = 'high', false)::INTEGER AS qty_high FROM b""")
def q_f8(spark, d):
    li = lineitem_features(spark, d).select(
        "l_orderkey", "l_linenumber",
        fx.bin_right_closed("quantity", fx.ALCOHOL_EDGES, fx.ALCOHOL_LEVELS).alias("band"))
    return fx.one_hot(li, "band", fx.ALCOHOL_LEVELS, prefix="qty")


@register("f9_encode_label", """SELECT l_orderkey, l_linenumber,
  CAST(dense_rank() OVER (ORDER BY l_linenumber) - 1 AS INTEGER) AS label_idx FROM lineitem""")
def q_f9(spark, d):
    from sievekit.plans.training import fit_label_map
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    lm = fit_label_map(li, "l_linenumber", "label_idx")
    return lm.encode(li)


@register("f11_quality_tier", """SELECT l_orderkey, l_linenumber,
  CASE WHEN l_linenumber >= 7 THEN 'excellent' WHEN l_linenumber >= 5 THEN 'good'
       ELSE 'needs improvement' END AS tier FROM lineitem""")
def q_f11(spark, d):
    """F11 on an integer prediction column (l_linenumber 1..7)."""
    li = table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", fx.quality_tier("l_linenumber").alias("tier"))


@register("f12_confidence_pct", "WITH " + PROBS_SQL + """
SELECT vec_id, round(max(p) * 100, 1) AS confidence_pct FROM probs WHERE m = 0 GROUP BY vec_id""")
def q_f12(spark, d):
    """F12 on the max class probability of a given probability table (embedding softmax)."""
    emb = table(spark, d, "embeddings")
    return emb.select("vec_id", fx.confidence_pct(F.array_max(given_probabilities("embedding", 0)))
                      .alias("confidence_pct"))


@register("f10_assemble", "WITH " + LI_SQL + """
SELECT l_orderkey, l_linenumber, [quantity, price, discount, tax] AS features FROM li""")
def q_f10(spark, d):
    from pyspark.ml.functions import vector_to_array
    li = lineitem_features(spark, d)
    v = fx.assemble_columns(li, ["quantity", "price", "discount", "tax"])
    return v.select("l_orderkey", "l_linenumber", vector_to_array("features").alias("features"))


# the canonical 11 columns, given by expressions over lineitem
_CANONICAL = {
    "fixed_acidity": "l_quantity", "volatile_acidity": "l_discount", "citric_acid": "l_tax",
    "residual_sugar": "l_quantity * 0.1", "chlorides": "l_discount * 0.5", "free_sulfur_dioxide": "l_linenumber * 3.0",
    "total_sulfur_dioxide": "l_quantity * 2.0", "density": "0.99 + l_tax * 0.1", "ph": "3.0 + l_discount",
    "sulphates": "l_tax * 2.0", "alcohol": "8.0 + l_linenumber"}
_CANONICAL_SQL = ", ".join(f"({e})::DOUBLE AS {c}" for c, e in _CANONICAL.items())


def canonical_table(spark, d) -> DataFrame:
    return table(spark, d, "lineitem").select(
        li_row_id().alias("row_id"), *[F.expr(e).cast("double").alias(c) for c, e in _CANONICAL.items()])


_ENGINEERED = {
    "acid_ratio": "fixed_acidity / (volatile_acidity + 1e-8)",
    "sulfur_ratio": "free_sulfur_dioxide / (total_sulfur_dioxide + 1e-8)",
    "alcohol_density_ratio": "alcohol / density", "log_residual_sugar": "ln(1 + residual_sugar)",
    "log_chlorides": "ln(1 + chlorides)", "alcohol_squared": "alcohol * alcohol", "ph_squared": "ph * ph"}


@register("engineered_features", f"""WITH c AS (SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS row_id,
  {_CANONICAL_SQL} FROM lineitem)
SELECT row_id, """ + ", ".join(f"round({c}, 6) AS {c}" for c in _CANONICAL) + ", "
    + ", ".join(f"round({e}, 4) AS {c}" for c, e in _ENGINEERED.items()) + """,
  (alcohol > 0 AND alcohol <= 10)::INTEGER AS alcohol_low, (alcohol > 10 AND alcohol <= 12)::INTEGER AS alcohol_medium,
  (alcohol > 12 AND alcohol <= 15)::INTEGER AS alcohol_high FROM c""")
def q_engineered(spark, d):
    """The 21-feature table: 11 canonical columns, 7 derived, 3 flags."""
    df = fx.engineered_features(canonical_table(spark, d))
    return df.select("row_id", *[rnd(c).alias(c) for c in _CANONICAL],
                     *[F.round(c, 4).alias(c) for c in _ENGINEERED], "alcohol_low", "alcohol_medium", "alcohol_high")


class _GivenModel:
    """A given probability model for scoring requests: softmax over 3 classes of
    class-wise multiples of the features' mean."""

    def transform(self, df: DataFrame) -> DataFrame:
        from pyspark.ml.functions import vector_to_array
        mean = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, x: a + x) / 13
        return df.withColumn("_m", mean).withColumn("probability", F.array(
            *[F.exp(F.col("_m") * w) / (F.exp(F.col("_m") * 0.01) + F.exp(F.col("_m") * 0.02) + F.exp(F.col("_m") * -0.01))
              for w in (0.01, 0.02, -0.01)]))


@register("scoring_flow", f"""WITH c AS (SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS row_id,
  {_CANONICAL_SQL} FROM lineitem WHERE l_orderkey % 10 <> 0),
m AS (SELECT row_id, (""" + " + ".join([*_CANONICAL, "ln(1 + residual_sugar)", "ln(1 + chlorides)"]) + """) / 13 AS m FROM c),
p AS (SELECT row_id, exp(m * 0.01) AS z0, exp(m * 0.02) AS z1, exp(m * -0.01) AS z2 FROM m),
q AS (SELECT row_id, z0 / (z0 + z1 + z2) AS p0, z1 / (z0 + z1 + z2) AS p1, z2 / (z0 + z1 + z2) AS p2 FROM p),
b AS (SELECT row_id, CASE WHEN p0 >= p1 AND p0 >= p2 THEN 4 WHEN p1 >= p2 THEN 6 ELSE 7 END AS prediction,
  greatest(p0, p1, p2) AS conf FROM q)
SELECT row_id, prediction, round(conf, 6) AS confidence,
  CASE WHEN prediction >= 7 THEN 'excellent' WHEN prediction >= 5 THEN 'good' ELSE 'needs improvement' END AS tier,
  round(conf * 100, 1) AS confidence_pct FROM b""")
def q_scoring_flow(spark, d):
    """C8 -> F1 -> F5 -> F10 -> I1 -> F11 -> F12 on requests with dotted names, a
    tenth of them incomplete."""
    from sievekit.plans.experiment import score_requests
    rows = table(spark, d, "lineitem").select(li_row_id().alias("row_id"), "l_orderkey", *[
        F.expr(e).cast("double").cast("string").alias(c.replace("_", ".")) for c, e in _CANONICAL.items()])
    rows = rows.withColumn("alcohol", F.when(F.col("l_orderkey") % 10 != 0, F.col("alcohol")))
    out = score_requests(rows, {c.replace("_", "."): c for c in _CANONICAL}, ["residual_sugar", "chlorides"],
                         _GivenModel(), [4, 6, 7], keep=["row_id"])
    return out.withColumn("confidence", rnd("confidence"))


# ---------------------------------------------------------------- selection
_E_FEATS = ["quantity", "price", "discount", "tax"]
_ANOVA_SQL = "WITH " + LI_SQL + """,
long AS (""" + " UNION ALL ".join(
    f"SELECT l_linenumber AS y, '{f}' AS feature, {i} AS position, {f}::DOUBLE AS x FROM li"
    for i, f in enumerate(_E_FEATS)) + """),
pc AS (SELECT feature, position, y, count(x) AS n_c, avg(x) AS m_c, var_pop(x) AS v_c
       FROM long GROUP BY feature, position, y),
tot AS (SELECT feature, position, sum(n_c) AS n, count(*) AS k, sum(n_c * m_c) / sum(n_c) AS m
        FROM pc GROUP BY feature, position),
fv AS (SELECT pc.feature, pc.position,
  (sum(n_c * (m_c - m) * (m_c - m)) / (max(k) - 1)) / (sum(n_c * v_c) / (max(n) - max(k))) AS f_value
  FROM pc JOIN tot USING (feature, position) GROUP BY pc.feature, pc.position)"""


@register("e1_anova_f", _ANOVA_SQL + "\nSELECT feature, position::INTEGER AS position, round(f_value, 6) AS f_value FROM fv")
def q_e1(spark, d):
    f = selection.anova_f(lineitem_features(spark, d), _E_FEATS, "l_linenumber")
    return f.select("feature", "position", rnd("f_value").alias("f_value"))


@register("e2_select_k_best", _ANOVA_SQL + """
SELECT feature, position::INTEGER AS position FROM fv
QUALIFY row_number() OVER (ORDER BY f_value DESC, position DESC) <= 2""")
def q_e2(spark, d):
    li = lineitem_features(spark, d)
    names = selection.select_k_best(li, _E_FEATS, "l_linenumber", 2)
    return spark.createDataFrame([(n, _E_FEATS.index(n)) for n in names], "feature string, position int")


# a feature that separates the classes, a constant, and two in between
_EDGE_SQL = _ANOVA_SQL.replace(LI_SQL, """li AS (SELECT l_linenumber, l_linenumber * 10.0::DOUBLE AS quantity,
  1.0::DOUBLE AS price, l_discount AS discount, l_tax AS tax FROM lineitem)""").replace(
    "(sum(n_c * (m_c - m) * (m_c - m)) / (max(k) - 1)) / (sum(n_c * v_c) / (max(n) - max(k))) AS f_value",
    "CASE WHEN feature = 'quantity' THEN 'Infinity'::DOUBLE WHEN feature = 'price' THEN NULL ELSE "
    "(sum(n_c * (m_c - m) * (m_c - m)) / (max(k) - 1)) / (sum(n_c * v_c) / (max(n) - max(k))) END AS f_value")


def _edge_features(spark, d) -> DataFrame:
    return table(spark, d, "lineitem").select(
        "l_linenumber", (F.col("l_linenumber") * 10.0).alias("quantity"), F.lit(1.0).alias("price"),
        F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"))


@register("e1_anova_separating_feature", _EDGE_SQL + """
SELECT feature, position::INTEGER AS position, round(f_value, 6) AS f_value FROM fv""")
def q_e1_edge(spark, d):
    """No variance inside the classes is infinity, a constant is null."""
    f = selection.anova_f(_edge_features(spark, d), _E_FEATS, "l_linenumber")
    return f.select("feature", "position", rnd("f_value").alias("f_value"))


@register("e2_best_is_separating_feature", "SELECT 'quantity' AS feature, count(*) AS n FROM lineitem")
def q_e2_edge(spark, d):
    df = _edge_features(spark, d)
    best = selection.select_k_best(df, _E_FEATS, "l_linenumber", 1)
    return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(best[0]).alias("feature"), "n")


@register("e3_robust_scale", "WITH " + x1_sql(
    "SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS row_id, l_linenumber, l_quantity AS quantity, "
    "l_extendedprice AS price, l_discount AS discount, l_tax AS tax FROM lineitem",
    "row_id", "l_linenumber", extra=""",
st AS (SELECT """ + ", ".join(
        f"quantile_cont({f}, 0.5) AS {f}_med, "
        f"CASE WHEN quantile_cont({f}, 0.75) - quantile_cont({f}, 0.25) = 0 THEN 1.0 "
        f"ELSE quantile_cont({f}, 0.75) - quantile_cont({f}, 0.25) END AS {f}_iqr" for f in _E_FEATS)
    + " FROM sp WHERE split = 'train')") + "\nSELECT row_id, " + ", ".join(
        f"round(({f} - {f}_med) / {f}_iqr, 6) AS {f}_scaled" for f in _E_FEATS)
    + " FROM sp, st WHERE split = 'test'")
def q_e3(spark, d):
    li = table(spark, d, "lineitem").select(
        li_row_id().alias("row_id"), "l_linenumber",
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"))
    sp = splitting.stratified_holdout(li, "l_linenumber", "row_id")
    # materialise the split once (S4) so the scaler's passes read a table, not the split plan
    path = write_split(sp, work_dir(spark, "e3split"))
    scaler = selection.fit_robust_scaler(read_split(spark, path, "train"), _E_FEATS)
    test = scaler.transform(read_split(spark, path, "test"), suffix="_scaled")
    return test.select("row_id", *[rnd(f"{f}_scaled").alias(f"{f}_scaled") for f in _E_FEATS])


# ---------------------------------------------------------------- splitting
@register("x1_stratified_holdout", "WITH " + x1_sql(
    "SELECT doc_id, quality FROM labels", "doc_id", "quality") + "\nSELECT doc_id, quality, split FROM sp")
def q_x1(spark, d):
    lab = table(spark, d, "labels").select("doc_id", "quality")
    return splitting.stratified_holdout(lab, "quality", "doc_id")


@register("x1_holdout_events", "WITH " + x1_sql(
    "SELECT event_id, event_type FROM events", "event_id", "event_type")
    + "\nSELECT event_id, event_type, split FROM sp")
def q_x1e(spark, d):
    ev = table(spark, d, "events").select("event_id", "event_type")
    return splitting.stratified_holdout(ev, "event_type", "event_id")


@register("x1_holdout_events_select", "WITH " + x1_sql(
    "SELECT event_id, event_type FROM events", "event_id", "event_type")
    + "\nSELECT event_id, event_type, split FROM sp")
def q_x1es(spark, d):
    """X1 with boundary sub-buckets counted again on finer digits before they are ranked."""
    ev = table(spark, d, "events").select("event_id", "event_type")
    return splitting.stratified_holdout(ev, "event_type", "event_id", target_rows=2)


@register("x2_stratified_kfold", "WITH " + x2_sql(
    "SELECT event_id, event_type FROM events", "event_id", "event_type")
    + "\nSELECT event_id, event_type, fold FROM fo")
def q_x2(spark, d):
    ev = table(spark, d, "events").select("event_id", "event_type")
    return splitting.stratified_kfold(ev, "event_type", "event_id", 5)


# ---------------------------------------------------------------- voting / scoring
@register("m8_soft_vote", "WITH " + PROBS_SQL + """,
avgp AS (SELECT vec_id, c, avg(p) AS ap FROM probs GROUP BY vec_id, c)
SELECT vec_id, c::INTEGER AS prediction, round(ap, 6) AS confidence FROM avgp
QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY ap DESC, c) = 1""")
def q_m8(spark, d):
    emb = table(spark, d, "embeddings")
    df = emb.select("vec_id", *[given_probabilities("embedding", m).alias(f"p{m}") for m in range(3)])
    voted = voting.soft_vote_arrays(df, ["p0", "p1", "p2"])
    return voted.select("vec_id", F.col("pred_index").alias("prediction"),
                        rnd("confidence").alias("confidence"))


@register("m8_soft_vote_long", "WITH " + PRED_SQL + """,
pl AS (SELECT row_id, model, c AS class, CASE WHEN c = pred THEN 0.625 ELSE 0.0625 END AS p
       FROM pp, (SELECT unnest(range(1, 8)) AS c)),
avgp AS (SELECT row_id, class, avg(p) AS ap FROM pl GROUP BY row_id, class)
SELECT row_id, class::INTEGER AS prediction, round(ap, 6) AS confidence FROM avgp
QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY ap DESC, class) = 1""")
def q_m8l(spark, d):
    """Soft vote over a long (id, model, class, p) table from three pseudo models."""
    pp = pseudo_predictions(spark, d)
    long = pp.select("row_id", "model", F.explode(F.sequence(F.lit(1), F.lit(7))).alias("class"),
                     "pred")
    # dyadic probabilities: sums are exact in any order, so ties are real ties
    long = long.withColumn("p", F.when(F.col("class") == F.col("pred"), F.lit(0.625))
                           .otherwise(F.lit(0.0625)))
    v = voting.soft_vote_long(long, "row_id", "class", "p")
    return v.select("row_id", F.col("prediction").cast("int").alias("prediction"),
                    rnd("confidence").alias("confidence"))


@register("i1_score", "WITH " + PROBS_SQL + """,
lm AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS idx FROM (SELECT DISTINCT label FROM embeddings)),
best AS (SELECT vec_id, c, p FROM probs WHERE m = 0
         QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, c) = 1)
SELECT vec_id, lm.label AS prediction, round(p, 6) AS confidence,
  CASE WHEN lm.label >= 7 THEN 'excellent' WHEN lm.label >= 5 THEN 'good' ELSE 'needs improvement' END
    AS tier,
  round(p * 100, 1) AS confidence_pct FROM best JOIN lm ON best.c = lm.idx""")
def q_i1(spark, d):
    from sievekit.plans.training import fit_label_map
    emb = table(spark, d, "embeddings")
    lm = fit_label_map(emb, "label", "label_idx")
    scored = emb.select("vec_id", given_probabilities("embedding", 0).alias("probs"))
    idx, mx = argmax_first("probs")
    scored = lm.decode(scored.select("vec_id", idx.alias("label_idx"), mx.alias("confidence")),
                       "label_idx", "prediction")
    return scored.select("vec_id", "prediction", rnd("confidence").alias("confidence"),
                         fx.quality_tier("prediction").alias("tier"),
                         fx.confidence_pct("confidence").alias("confidence_pct"))


# ---------------------------------------------------------------- evaluation
@register("v1_accuracy", "WITH " + PRED_SQL + """
SELECT round(avg(CASE WHEN y = pred THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM pp WHERE model = 'model_1'""")
def q_v1(spark, d):
    a = evaluation.accuracy(model1(spark, d), "y", "pred")
    return a.select(rnd("accuracy").alias("accuracy"))


_CM_SQL = "WITH " + PRED_SQL + """,
m1 AS (SELECT * FROM pp WHERE model = 'model_1'),
cls AS (SELECT y AS c FROM m1 UNION SELECT pred FROM m1),
pc AS (SELECT y, pred, count(*) AS n FROM m1 GROUP BY y, pred),
cm AS (SELECT a.c AS true_label, b.c AS pred_label, coalesce(pc.n, 0)::BIGINT AS n
       FROM cls a CROSS JOIN cls b LEFT JOIN pc ON pc.y = a.c AND pc.pred = b.c)"""


@register("v2_confusion_matrix", _CM_SQL + "\nSELECT true_label, pred_label, n FROM cm")
def q_v2(spark, d):
    return evaluation.confusion_long(model1(spark, d), "y", "pred")


@register("s7_confusion_wide", _CM_SQL + """,
pos AS (SELECT c, row_number() OVER (ORDER BY c) - 1 AS i FROM cls)
SELECT 'true_' || tp.i AS label, """ + ", ".join(
    f"sum(CASE WHEN pp_.i = {i} THEN n END) AS pred_{i}" for i in range(7)) + """
FROM cm JOIN pos tp ON cm.true_label = tp.c JOIN pos pp_ ON cm.pred_label = pp_.c GROUP BY tp.i""")
def q_s7(spark, d):
    from sievekit.sources.tables import write_confusion
    wide = evaluation.confusion_matrix(model1(spark, d), "y", "pred")
    path = write_confusion(wide, work_dir(spark, "confusion"))
    schema = "label string, " + ", ".join(f"pred_{i} bigint" for i in range(len(wide.columns) - 1))
    return spark.read.schema(schema).option("header", True).csv(path)


_REPORT_SQL = "WITH " + PRED_SQL + """,
m1 AS (SELECT * FROM pp WHERE model = 'model_1'),
cls AS (SELECT y AS c FROM m1 UNION SELECT pred FROM m1),
per AS (SELECT c,
  (SELECT count(*) FROM m1 WHERE y = c AND pred = c) AS tp,
  (SELECT count(*) FROM m1 WHERE y = c) AS support,
  (SELECT count(*) FROM m1 WHERE pred = c) AS npred FROM cls),
pr AS (SELECT c, support, tp,
  CASE WHEN npred = 0 THEN 0.0 ELSE tp::DOUBLE / npred END AS precision,
  CASE WHEN support = 0 THEN 0.0 ELSE tp::DOUBLE / support END AS recall FROM per),
f AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0
  ELSE 2 * precision * recall / (precision + recall) END AS f1_score FROM pr),
rep AS (
  SELECT c::VARCHAR AS class, precision, recall, f1_score, support::BIGINT AS support FROM f
  UNION ALL SELECT 'accuracy', NULL, NULL, sum(tp)::DOUBLE / sum(support), sum(support)::BIGINT FROM f
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1_score), sum(support)::BIGINT FROM f
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support),
    sum(recall * support) / sum(support), sum(f1_score * support) / sum(support), sum(support)::BIGINT
  FROM f)"""


@register("v3_classification_report", _REPORT_SQL + """
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall,
  round(f1_score, 6) AS f1_score, support FROM rep""")
def q_v3(spark, d):
    rep = evaluation.classification_report(model1(spark, d), "y", "pred")
    return rep.select("class", *[rnd(c).alias(c) for c in ("precision", "recall", "f1_score")], "support")


@register("v4_flatten_report", _REPORT_SQL + """
SELECT class || '_' || metric AS metric_name, round(value, 6) AS value FROM (
  SELECT class, 'precision' AS metric, precision AS value FROM rep WHERE class <> 'accuracy'
  UNION ALL SELECT class, 'recall', recall FROM rep WHERE class <> 'accuracy'
  UNION ALL SELECT class, 'f1-score', f1_score FROM rep WHERE class <> 'accuracy')""")
def q_v4(spark, d):
    flat = evaluation.flatten_report(evaluation.classification_report(model1(spark, d), "y", "pred"))
    return flat.select("metric_name", rnd("value").alias("value"))


@register("v5_weighted_f1", _REPORT_SQL + "\nSELECT round(f1_score, 6) AS weighted_f1 FROM rep WHERE class = 'weighted avg'")
def q_v5(spark, d):
    w = evaluation.weighted_f1(model1(spark, d), "y", "pred")
    return w.select(rnd("weighted_f1").alias("weighted_f1"))


@register("v6_log_loss", "WITH " + PROBS_SQL + """,
lm AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS idx FROM (SELECT DISTINCT label FROM embeddings))
SELECT round(avg(-ln(least(greatest(p, 1e-15), 1 - 1e-15))), 6) AS log_loss
FROM probs JOIN lm ON probs.label = lm.label AND probs.c = lm.idx WHERE m = 0""")
def q_v6(spark, d):
    from sievekit.plans.training import fit_label_map
    emb = table(spark, d, "embeddings")
    lm = fit_label_map(emb, "label", "label_idx")
    df = lm.encode(emb).select("label_idx", given_probabilities("embedding", 0).alias("probs"))
    ll = evaluation.log_loss(df, "label_idx", "probs")
    return ll.select(rnd("log_loss").alias("log_loss"))


def _fold_scores(spark, d) -> DataFrame:
    """Per (model, fold) weighted F1. Folds depend only on the row, so they are
    assigned once on lineitem and carried into every model's rows (no join)."""
    li = table(spark, d, "lineitem").withColumn("row_id", li_row_id())
    folded = splitting.stratified_kfold(li, "l_linenumber", "row_id", 5)
    pp = pseudo_predictions(spark, d, folded, keep=("fold",))
    scores = evaluation.per_model_scores(pp, "model", "y", "pred", keys=["fold"])
    return scores.select("model", "fold", F.col("f1_score").alias("score"))


@register("v7_cv_summary", "WITH " + PRED_SQL + ", " + x2_sql(
    "SELECT row_id, y FROM pp WHERE model = 'model_1'", "row_id", "y") + """,
pf AS (SELECT pp.model, fo.fold, pp.y, pp.pred FROM pp JOIN fo USING (row_id)),
cc AS (SELECT model, fold, c, sum(s) AS support, sum(t) AS tp, sum(q) AS npred FROM (
  SELECT model, fold, y AS c, 1 AS s, CASE WHEN y = pred THEN 1 ELSE 0 END AS t, 0 AS q FROM pf
  UNION ALL SELECT model, fold, pred, 0, 0, 1 FROM pf) GROUP BY model, fold, c),
cr AS (SELECT *, CASE WHEN npred = 0 THEN 0.0 ELSE tp::DOUBLE / npred END AS p,
  CASE WHEN support = 0 THEN 0.0 ELSE tp::DOUBLE / support END AS r FROM cc),
sc AS (SELECT model, fold, sum(CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END * support) / sum(support)
         AS score FROM cr GROUP BY model, fold)
SELECT model, round(avg(score), 6) AS cv_mean, round(2 * stddev_pop(score), 6) AS cv_two_std
FROM sc GROUP BY model""")
def q_v7(spark, d):
    s = evaluation.cv_summary(_fold_scores(spark, d), "model", "score")
    return s.select("model", rnd("cv_mean").alias("cv_mean"), rnd("cv_two_std").alias("cv_two_std"))


def _model_results(spark, d) -> DataFrame:
    """Per pseudo model: accuracy and weighted F1 from one pair-count pass."""
    pp = pseudo_predictions(spark, d)
    scores = evaluation.per_model_scores(pp, "model", "y", "pred", keys=["position"])
    return scores.select("model", "position", "accuracy", "f1_score")


_RESULTS_SQL = "WITH " + PRED_SQL + """,
pc AS (SELECT model, position, y, pred, count(*) AS n FROM pp GROUP BY ALL),
cls AS (SELECT DISTINCT model, position, c FROM (SELECT model, position, y AS c FROM pc
        UNION SELECT model, position, pred FROM pc)),
per AS (SELECT cls.model, cls.position, cls.c,
  coalesce((SELECT sum(n) FROM pc WHERE pc.model = cls.model AND y = c AND pred = c), 0) AS tp,
  coalesce((SELECT sum(n) FROM pc WHERE pc.model = cls.model AND y = c), 0) AS support,
  coalesce((SELECT sum(n) FROM pc WHERE pc.model = cls.model AND pred = c), 0) AS npred FROM cls),
pr AS (SELECT *, CASE WHEN npred = 0 THEN 0.0 ELSE tp::DOUBLE / npred END AS p,
  CASE WHEN support = 0 THEN 0.0 ELSE tp::DOUBLE / support END AS r FROM per),
f AS (SELECT *, CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END AS f FROM pr),
res AS (SELECT model, position, sum(tp) / sum(support) AS accuracy,
  sum(f * support) / sum(support) AS f1_score FROM f GROUP BY model, position)"""


@register("v8_leaderboard", _RESULTS_SQL + """
SELECT model, position, round(f1_score, 6) AS f1_score,
  CAST(row_number() OVER (ORDER BY f1_score DESC, position) AS INTEGER) AS rank FROM res""")
def q_v8(spark, d):
    lb = evaluation.leaderboard(_model_results(spark, d), "f1_score", "position")
    return lb.select("model", "position", rnd("f1_score").alias("f1_score"), "rank")


@register("v8_best_model", _RESULTS_SQL + """
SELECT model, round(f1_score, 6) AS f1_score FROM res ORDER BY f1_score DESC, position LIMIT 1""")
def q_v8b(spark, d):
    b = evaluation.best_model(_model_results(spark, d), "f1_score", "position")
    return b.select("model", rnd("f1_score").alias("f1_score"))


@register("v10_improvement_pct", _RESULTS_SQL + """
SELECT model, round(accuracy, 6) AS accuracy,
  round((accuracy - 0.6454) / 0.6454 * 100, 6) AS improvement_pct FROM res""")
def q_v10(spark, d):
    r = _model_results(spark, d)
    return r.select("model", rnd("accuracy").alias("accuracy"),
                    rnd(evaluation.improvement_pct("accuracy")).alias("improvement_pct"))
