"""The per-program jobs on small files in the original layouts (own rows)."""

from __future__ import annotations

import math
import os

from pyspark.sql import functions as F

from tablekit.plans import labs

from conftest import write_lines


def world_lines():
    rows = [("AFG", "Asia", "22720000"), ("NLD", "Europe", "15864000"),
            ("TUR", "Asia", "66591000"), ("ATA", "Antarctica", ""),
            ("ATF", "Antarctica", "NULL"), ("FRA", "Europe", "12.5"), ("EGY", "Africa", "+5")]
    return [f'"{c}","Name {c}","{cont}","Region","1000","1900","{pop}","70.5"'
            for c, cont, pop in rows]


def read_kv(spark, path):
    return [r.value for r in spark.read.text(path).collect()]


def test_mapreduce_jobs(spark, tmp_dir):
    src = write_lines(tmp_dir, "world.csv", world_lines())
    counts = labs.continent_countries_job(spark, src, tmp_dir + "/c")
    assert {r.continent: r.n for r in counts.collect()} == {
        "Asia": 2, "Europe": 2, "Antarctica": 2, "Africa": 1}
    labs.continent_population_job(spark, src, tmp_dir + "/p")
    assert read_kv(spark, tmp_dir + "/p") == [
        "Africa\t5", "Antarctica\t0", "Asia\t89311000", "Europe\t15864000"]
    labs.continents_job(spark, src, tmp_dir + "/s")
    assert read_kv(spark, tmp_dir + "/s") == ["continents\tAfrica,Antarctica,Asia,Europe"]
    words = write_lines(tmp_dir, "words.txt", ["elma kiraz", "muz  elma\t", "", "kiraz"])
    labs.word_count_job(spark, words, tmp_dir + "/w")
    assert read_kv(spark, tmp_dir + "/w") == ["elma\t2", "kiraz\t2", "muz\t1"]


def test_world_json_lab(spark, tmp_dir):
    path = write_lines(tmp_dir, "world.json", [
        '{"name":"Turkey","population":66591000,"continent":"Asia"}',
        '{"name":"Malta","population":380200,"continent":"Europe"}',
        '{"name":"Japan","population":126714000,"continent":"Asia"}'])
    out = labs.world_json_lab(spark, path)
    assert sorted(r.name for r in out["populous_sql"].collect()) == ["Japan", "Turkey"]
    assert sorted(r.name for r in out["populous"].collect()) == ["Japan", "Turkey"]
    assert {r.continent: r["count"] for r in out["per_continent"].collect()} == {
        "Asia": 2, "Europe": 1}
    assert out["population_plus_one"].where(F.col("name") == "Malta").first()[1] == 380201


def test_hive_lab(spark, tmp_dir):
    countries = write_lines(tmp_dir, "countries.csv", [
        "TUR,Turkey,Asia,Middle East,774815,1923,66591000,71,210721,189122,Turkiye,Republic,X,3358,TR",
        "NLD,Netherlands,Europe,Western Europe,41526,1581,15864000,78.3,371362,360478,"
        "Nederland,Monarchy,Y,5,NL",
        "ATA,Antarctica,Antarctica,Antarctica,13120000,,0,,0,,-,-,,,AQ"])
    cities = write_lines(tmp_dir, "cities.csv", [
        "3358,Ankara,TUR,Ankara,3038159", "3357,Istanbul,TUR,Istanbul,8787958",
        "5,Amsterdam,NLD,Noord-Holland,731200"])
    out = labs.hive_lab(spark, countries, cities)
    assert out["city_population"].first().population == 3038159 + 8787958
    assert sorted(r.continent for r in out["continents"].collect()) == [
        "Antarctica", "Asia", "Europe"]
    caps = {r.name: r.population for r in out["capitals"].collect()}
    assert caps == {"Ankara": 66591000, "Amsterdam": 15864000}


def test_mpg_regression(spark, tmp_dir):
    header = "MPG,CYLINDERS,DISPLACEMENT,HORSEPOWER,WEIGHT,ACCELERATION,MODELYEAR,NAME"
    rows = [header]
    for i in range(60):
        w = 2000 + 37 * i
        hp = "?" if i % 13 == 0 else str(60 + (i * 7) % 90)
        rows.append(f"{45 - w / 150:.1f},{4 + 2 * (i % 3)},{100 + 3 * i},{hp},{w},"
                    f"{12 + i % 9},{70 + i % 12},car {i}")
    out = labs.mpg_regression(spark, write_lines(tmp_dir, "mpg.csv", rows))
    data = out["data"]
    assert data.count() == 60
    assert data.where(F.col("HORSEPOWER") == 80.0).count() >= 5
    corr = {r.column: r.corr for r in out["corr"].collect()}
    assert math.isclose(corr["MPG"], 1.0) and corr["WEIGHT"] < -0.99
    assert {r.term for r in out["coefficients"].collect()} == {
        "ACCELERATION", "DISPLACEMENT", "WEIGHT", "intercept"}


def test_iris_tree(spark, tmp_dir):
    rows = ["Sepal.Length,Sepal.Width,Petal.Length,Petal.Width,Species"]
    for i in range(30):
        rows.append(f"5.{i % 9},3.{i % 7},1.{i % 5},0.{1 + i % 3},setosa")
        rows.append(f"6.{i % 9},2.{i % 7},4.{i % 5},1.{1 + i % 3},versicolor")
        rows.append(f"7.{i % 9},3.{i % 7},6.{i % 5},2.{1 + i % 3},virginica")
    out = labs.iris_tree(spark, write_lines(tmp_dir, "iris.csv", rows))
    assert out["species_index"].count() == 3
    t = out["tree"].first()
    assert t.depth <= 2 and t.num_nodes <= 7
    nodes = out["nodes"].collect()
    assert len(nodes) == t.num_nodes and sum(r.n for r in nodes if r.feature is None) == nodes[0].n
    acc = out["accuracy"].first().accuracy
    assert 0.0 <= acc <= 1.0


def test_auto_clusters(spark, tmp_dir):
    rows = ["MAKE,FUELTYPE,ASPIRE,DOORS,BODY,DRIVE,CYLINDERS,HP,RPM,MPG-CITY,MPG-HWY,PRICE"]
    for i in range(40):
        rows.append(f"m{i},gas,std,{'two' if i % 2 else 'four'},"
                    f"{'sedan' if i % 3 else 'hatchback'},fwd,four,{60 + i * 3},"
                    f"{4500 + (i % 7) * 100},{20 + i % 10},{25 + i % 10},{5000 + 10 * i}")
    out = labs.auto_clusters(spark, write_lines(tmp_dir, "auto.csv", rows), k=3)
    assert out["data"].count() == 40
    means = {r.column: r.mean for r in profile_of(out["scaled"])}
    assert all(abs(m) < 1e-9 for m in means.values())
    assert out["scatter"].select("cluster").distinct().count() <= 3


def profile_of(df):
    from tablekit.operators.profile import summary_stats
    return summary_stats(df, df.columns).collect()


def test_sms_naive_bayes(spark, tmp_dir):
    rows = []
    for i in range(40):
        rows.append(f"ham,see you at {i} tonight, ok")
        rows.append(f"spam,win cash prize now {i} claim free")
    out = labs.sms_naive_bayes(spark, write_lines(tmp_dir, "sms.csv", rows))
    assert out["data"].where(F.col("message").contains(", ok")).count() == 40
    acc = out["accuracy"].first().accuracy
    assert acc >= 0.9


def test_bank_forest(spark, tmp_dir):
    head = ";".join(f'"f{i}"' for i in range(17))
    rows = [head]
    marital = ["married", "single", "divorced", "widowed"]
    edu = ["primary", "secondary", "tertiary", "unknown"]
    for i in range(80):
        f = [str(20 + i % 50), "job", marital[i % 4], edu[(i // 2) % 4],
             "no" if i % 5 else "yes", str(100 * (i % 17) - 300), "yes",
             "no" if i % 3 else "yes"] + ["x"] * 8 + ["yes" if i % 4 == 0 else "no"]
        rows.append(";".join(f'"{v}"' for v in f))
    out = labs.bank_forest(spark, write_lines(tmp_dir, "bank.csv", rows))
    data = out["data"]
    assert data.count() == 80
    widowed_unknown = data.where((F.col("SINGLE") + F.col("MARRIED") + F.col("DIVORCED")) == 0)
    assert widowed_unknown.count() == 20
    assert len(out["pca"].first().pcaFeatures) == 3
    assert out["predictions"].count() > 0


def test_ratings_als(spark, tmp_dir):
    rows = [f"{1000 + u},{9000 + i},{(u * i) % 10 + 1}" for u in range(1, 7)
            for i in range(1, 14) if (u + i) % 2]
    pairs = spark.createDataFrame([(1001, 9002), (7777, 9002)], "user int, item int")
    out = labs.ratings_als(spark, write_lines(tmp_dir, "ratings.txt", rows), pairs)
    assert [r.id for r in out["user_factors"].collect()] == sorted(1000 + u for u in range(1, 7))
    pred = {r.user: r.prediction for r in out["predictions"].collect()}
    assert math.isnan(pred[7777]) and not math.isnan(pred[1001])


def test_network_word_count_on_a_file_stream(spark, tmp_dir, capsys):
    from tablekit import streaming
    feed = os.path.join(tmp_dir, "feed")
    os.makedirs(feed)
    write_lines(feed, "a.txt", ["to be or not to be"])
    labs.network_word_count(spark, lines=streaming.file_lines(spark, feed),
                            checkpoint=os.path.join(tmp_dir, "ck"), interval="1 second",
                            seconds=4)
    out = capsys.readouterr().out
    assert "|  to|  2|" in out and "|  be|  2|" in out
