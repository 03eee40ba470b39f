"""Jobs over the original input layouts: one function per reference program.

Each job reads files in the layout its program reads (quoted world lines,
world JSON, the CSV files of the ML labs, delimited Hive tables, a socket line
stream) and composes the library's operators. Results are returned as named
DataFrames (or written to a sink); nothing is collected to the driver beyond
bounded values (a header line, fitted means, model parameters).

These jobs need those input files; the named queries in ``queries.py`` run
the same operators over the test tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sinks, streaming
from ..functions import (assemble, impute_sentinel, indicators, numeric_columns, recode_binary,
                         remove_char)
from ..operators import evaluate, features, models, profile, relational, trees
from ..sources import (drop_lines_containing, drop_lines_equal, first_line_of_files, labelled_messages,
                       quoted_fields, read_declared, read_json, read_lines, schema_rows, typed_split)

SEED = 42

# Fixed values that must equal the programs' own for the same results:
# header tokens, recode words, the horsepower fill value, the key of the
# distinct line, and the model settings of each program.
CONTINENTS_KEY = "continents"
MPG_HEADER_TOKEN = "CYLINDERS"
HORSEPOWER_FILL = 80.0
MPG_SPLIT = [0.9, 0.1]
MPG_MAX_ITER = 200
IRIS_HEADER_TOKEN = "Sepal"
IRIS_SPLIT = [0.9, 0.1]
IRIS_MAX_DEPTH = 2
AUTO_DOORS_ONE = "two"
AUTO_BODY_ONE = "sedan"
AUTO_K = 5
AUTO_SEED = 1
SMS_NEGATIVE = "ham"
SMS_MIN_PARTITIONS = 2
SMS_SPLIT = [0.9, 0.1]
BANK_NO = "no"
BANK_MARITAL = {"SINGLE": "single", "MARRIED": "married", "DIVORCED": "divorced"}
BANK_EDUCATION = {"PRIMARY": "primary", "SECONDARY": "secondary", "TERTIARY": "tertiary"}
BANK_PCA_K = 3
BANK_SPLIT = [0.7, 0.3]
ALS_RANK = 10
ALS_MAX_ITER = 5
TURKEY_CODE = "TUR"

# ---------------------------------------------------------------- MapReduce jobs


def word_count_job(spark: SparkSession, in_path: str, out_path: str) -> DataFrame:
    """StringTokenizer word count, written as sorted ``word<TAB>count``."""
    counts = relational.word_count(read_lines(spark, in_path))
    sinks.write_key_value_text(counts, out_path, "word", "n")
    return counts


def continent_countries_job(spark: SparkSession, in_path: str, out_path: str) -> DataFrame:
    """Rows per continent (field 2 of the quoted world lines)."""
    fields = quoted_fields(read_lines(spark, in_path), {"continent": 2})
    counts = relational.count_by_key(fields, "continent")
    sinks.write_key_value_text(counts, out_path, "continent", "n")
    return counts


def continent_population_job(spark: SparkSession, in_path: str, out_path: str) -> DataFrame:
    """Population per continent: field 6 parsed as an integer, 0 when it does
    not parse; a continent with only bad values is still listed, with 0."""
    fields = quoted_fields(read_lines(spark, in_path), {"continent": 2, "population": 6})
    sums = relational.sum_by_key_or_zero(fields, "continent", "population")
    sinks.write_key_value_text(sums, out_path, "continent", "total")
    return sums


def continents_job(spark: SparkSession, in_path: str, out_path: str) -> DataFrame:
    """One line ``continents<TAB>A,B,...``: the sorted distinct continents."""
    fields = quoted_fields(read_lines(spark, in_path), {"continent": 2})
    line = relational.distinct_set_line(fields, "continent", out="values").select(
        F.lit(CONTINENTS_KEY).alias("key"), "values")
    sinks.write_key_value_text(line, out_path, "key", "values", sort=False)
    return line


# ---------------------------------------------------------------- DataFrame / SQL lab


def world_json_lab(spark: SparkSession, path: str, min_population: int = 10_000_000
                   ) -> dict[str, DataFrame]:
    """JSON scan, schema, projections, threshold filter, group count and the
    same filter in SQL over a view."""
    df = read_json(spark, path)
    df.createOrReplaceTempView("countries")
    return {
        "data": df,
        "schema": schema_rows(spark, df),
        "names": df.select("name"),
        "population_plus_one": df.select(df["name"], (df["population"] + 1)
                                         .alias("population_plus_one")),
        "populous": df.filter(df["population"] > min_population),
        "per_continent": relational.count_by_key(df, "continent", count="count"),
        "populous_sql": spark.sql(
            f"SELECT name FROM countries WHERE population > {min_population}"),
    }


# ---------------------------------------------------------------- streaming lab


def network_word_count(spark: SparkSession, host: str = "localhost",
                       port: int = streaming.SOCKET_PORT, checkpoint: str | None = None,
                       interval: str = streaming.BATCH_INTERVAL,
                       seconds: float = streaming.RUN_SECONDS,
                       lines: DataFrame | None = None) -> None:
    """Per-batch word count of a socket line stream, first ten counts of each
    batch printed, run for a bounded time. ``lines`` replaces the socket (for
    a file stream)."""
    from ..session import scratch_path
    src = lines if lines is not None else streaming.socket_lines(spark, host, port)
    q = streaming.console_first_rows(src, checkpoint or scratch_path(spark, "net_wc"),
                                     streaming.FIRST_ROWS, interval)
    streaming.run_for(q, seconds)


# ---------------------------------------------------------------- ML labs

# Column layouts of the lab inputs (by position).
MPG_FIELDS = ["MPG", "CYLINDERS", "DISPLACEMENT", "HORSEPOWER", "WEIGHT", "ACCELERATION",
              "MODELYEAR", "NAME"]
MPG_FEATURES = ["ACCELERATION", "DISPLACEMENT", "WEIGHT"]
IRIS_FIELDS = ["SEPAL_LENGTH", "SEPAL_WIDTH", "PETAL_LENGTH", "PETAL_WIDTH", "SPECIES"]
BANK_FEATURES = ["AGE", "BALANCE", "DEFAULT", "DIVORCED", "LOAN", "MARRIED", "PRIMARY",
                 "SECONDARY", "SINGLE", "TERTIARY"]


def mpg_regression(spark: SparkSession, path: str, sentinel_value: float = HORSEPOWER_FILL,
                   seed: int = SEED) -> dict[str, DataFrame]:
    """Clean (header by token, '?' horsepower imputed), correlate every numeric
    column with MPG, fit least squares on 90%, report and evaluate on 10%."""
    lines = drop_lines_containing(read_lines(spark, path), MPG_HEADER_TOKEN)
    parts = F.split("value", ",", -1)
    cols = []
    for i, name in enumerate(MPG_FIELDS):
        if name == "NAME":
            cols.append(parts.getItem(i).alias(name))
        elif name == "HORSEPOWER":
            cols.append(impute_sentinel(parts.getItem(i), sentinel_value).alias(name))
        else:
            cols.append(parts.getItem(i).cast("double").alias(name))
    data = lines.select(*cols)
    corr = profile.corr_with_target(data, "MPG", numeric_columns(data))
    lp = assemble(data, MPG_FEATURES).select(F.col("MPG").alias("label"), "features")
    train, test = relational.random_split(lp, MPG_SPLIT, seed)
    model = models.linear_regression(train, max_iter=MPG_MAX_ITER)
    pred = model.transform(test)
    return {"data": data, "corr": corr,
            "coefficients": models.regression_report(spark, model, MPG_FEATURES),
            "predictions": pred.select("prediction", "label", "features"),
            "r2": evaluate.r2(pred)}


def iris_tree(spark: SparkSession, path: str, seed: int = SEED) -> dict[str, DataFrame]:
    """Index the species, profile, correlate, depth-2 tree on 90%, accuracy and
    confusion on 10%."""
    lines = drop_lines_containing(read_lines(spark, path), IRIS_HEADER_TOKEN)
    data = typed_split(lines, ",", [(n, i, "string" if n == "SPECIES" else "double")
                                    for i, n in enumerate(IRIS_FIELDS)])
    indexed, _ = features.string_index(data, "SPECIES", "IND_SPECIES")
    num = numeric_columns(indexed)
    lp = assemble(indexed, IRIS_FIELDS[:4]).select(
        F.col("SPECIES").alias("species"), F.col("IND_SPECIES").alias("label"), "features")
    train, test = relational.random_split(lp, IRIS_SPLIT, seed)
    model = models.decision_tree(train, max_depth=IRIS_MAX_DEPTH, seed=seed)
    pred = model.transform(test)
    return {"data": indexed,
            "species_index": relational.distinct_rows(indexed, "SPECIES", "IND_SPECIES"),
            "summary": profile.summary_stats(indexed, num),
            "corr": profile.corr_with_target(indexed, "IND_SPECIES", num),
            "tree": models.tree_report(spark, model), "nodes": trees.tree_nodes(spark, model),
            "predictions": pred.select("prediction", "species", "label"),
            "accuracy": evaluate.accuracy(pred), "confusion": evaluate.confusion(pred)}


def auto_clusters(spark: SparkSession, path: str,
                  scaled: tuple[str, ...] = ("DOORS", "BODY", "HP", "RPM"), k: int = AUTO_K,
                  seed: int = AUTO_SEED) -> dict[str, DataFrame]:
    """Drop the header line, recode doors/body, centre and scale the chosen
    columns, k-means, and the (cluster, x, y) table behind the scatter plot."""
    lines = drop_lines_equal(read_lines(spark, path), first_line_of_files(spark, path))
    parts = F.split("value", ",", -1)
    data = lines.select(recode_binary(parts.getItem(3), AUTO_DOORS_ONE, 1.0, 2.0).alias("DOORS"),
                        recode_binary(parts.getItem(4), AUTO_BODY_ONE, 1.0, 2.0).alias("BODY"),
                        parts.getItem(7).cast("double").alias("HP"),
                        parts.getItem(8).cast("double").alias("RPM"),
                        parts.getItem(9).cast("double").alias("MPG"))
    cols = list(scaled)
    cs = profile.center_scale(data, cols)
    vec = assemble(cs, cols)
    model = models.kmeans(vec, k=k, seed=seed)
    pred = model.transform(vec)
    return {"data": data, "summary": profile.summary_stats(data, data.columns),
            "scaled": cs, "predictions": pred,
            "scatter": models.cluster_scatter(pred)}


def sms_naive_bayes(spark: SparkSession, path: str, truncate_at_comma: bool = False,
                    seed: int = SEED) -> dict[str, DataFrame]:
    """ham/spam lines, 90/10 split, Tokenizer -> HashingTF -> IDF -> NaiveBayes
    pipeline, accuracy and confusion."""
    msgs = labelled_messages(read_lines(spark, path, min_partitions=SMS_MIN_PARTITIONS),
                             positive=SMS_NEGATIVE, truncate_at_comma=truncate_at_comma)
    train, test = relational.random_split(msgs, SMS_SPLIT, seed)
    model = features.fit_pipeline(features.tfidf_stages("message")
                                  + [models.naive_bayes()], train)
    pred = model.transform(test)
    return {"data": msgs, "predictions": pred.select("label", "message", "prediction"),
            "accuracy": evaluate.accuracy(pred), "confusion": evaluate.confusion(pred)}


def bank_forest(spark: SparkSession, path: str, seed: int = SEED) -> dict[str, DataFrame]:
    """Semicolon lines with quotes removed: recodes and indicator flags, profile,
    correlation with the outcome, PCA(3), indexed label, 70/30 random forest."""
    lines = drop_lines_equal(read_lines(spark, path), first_line_of_files(spark, path))
    parts = F.split(remove_char("value", '"'), ";", -1)
    data = lines.select(
        recode_binary(parts.getItem(16), BANK_NO, 0.0, 1.0).alias("OUTCOME"),
        parts.getItem(0).cast("double").alias("AGE"),
        *indicators(parts.getItem(2), BANK_MARITAL),
        *indicators(parts.getItem(3), BANK_EDUCATION),
        recode_binary(parts.getItem(4), BANK_NO, 0.0, 1.0).alias("DEFAULT"),
        parts.getItem(5).cast("double").alias("BALANCE"),
        recode_binary(parts.getItem(7), BANK_NO, 0.0, 1.0).alias("LOAN"))
    lp = assemble(data, BANK_FEATURES).select(F.col("OUTCOME").alias("label"), "features")
    with sinks.persisted(lp) as kept:
        pca = features.fit_pca(kept, "features", BANK_PCA_K)
        pc = pca.transform(kept).select("label", F.col("__pca").alias("pcaFeatures"))
        td, _ = features.string_index(pc, "label", "indexed")
        train, test = relational.random_split(td, BANK_SPLIT, seed)
        model = models.random_forest(train, features="pcaFeatures", label="indexed", seed=seed)
    pred = model.transform(test)
    return {"data": data, "summary": profile.summary_stats(data, data.columns),
            "corr": profile.corr_with_target(data, "OUTCOME", data.columns),
            "pca": pc, "predictions": pred.select("prediction", "indexed", "label",
                                                  "pcaFeatures"),
            "accuracy": evaluate.accuracy(pred, label="indexed"),
            "confusion": evaluate.confusion(pred, label="indexed")}


def ratings_als(spark: SparkSession, path: str, pairs: DataFrame, rank: int = ALS_RANK,
                max_iter: int = ALS_MAX_ITER, seed: int = SEED) -> dict[str, DataFrame]:
    """``user,item,rating`` lines, ALS, user factors by id, predicted ratings
    for the given (user, item) pairs (unseen ids give NaN)."""
    ratings = typed_split(read_lines(spark, path), ",", [("user", 0, "int"), ("item", 1, "int"),
                                                         ("rating", 2, "float")])
    model = models.als(ratings, rank=rank, max_iter=max_iter, seed=seed)
    return {"user_factors": models.factors(model, "user"),
            "predictions": model.transform(pairs)}


# ---------------------------------------------------------------- Hive tables

# The declared columns of the two Hive tables.
COUNTRIES_DDL = ("code string, name string, continent string, region string, "
                 "surfaceArea float, indepYear int, population int, lifeExpectancy float, "
                 "gnp float, gnpOld float, localName string, govermentForm string, "
                 "headOfState string, capital int, code2 string")
CITIES_DDL = "id int, name string, countryCode string, district string, population int"


def hive_lab(spark: SparkSession, countries_path: str, cities_path: str,
             country_code: str = TURKEY_CODE) -> dict[str, DataFrame]:
    """Declared comma tables and the four queries of the notes, in SQL."""
    read_declared(spark, countries_path, COUNTRIES_DDL).createOrReplaceTempView("countries")
    read_declared(spark, cities_path, CITIES_DDL).createOrReplaceTempView("cities")
    return {
        "city_population": spark.sql(
            f"SELECT sum(population) AS population FROM cities "
            f"WHERE countrycode = '{country_code}'"),
        "continents": spark.sql("SELECT DISTINCT continent FROM countries"),
        "continent_population": spark.sql(
            "SELECT continent, sum(population) AS population FROM countries "
            "GROUP BY continent"),
        "capitals": spark.sql(
            "SELECT ci.name, co.population FROM countries co, cities ci "
            "WHERE ci.id = co.capital"),
    }


__all__ = ["word_count_job", "continent_countries_job", "continent_population_job",
           "continents_job", "world_json_lab", "network_word_count", "mpg_regression",
           "iris_tree", "auto_clusters", "sms_naive_bayes", "bank_forest", "ratings_als",
           "hive_lab"]
