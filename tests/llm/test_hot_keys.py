"""A key with a third of all rows is split over tasks, whatever the session may broadcast."""

from pyspark.sql import functions as F

from subtide.llm import components, simhash, url_rules
from tests.test_scale import conf, final_plan, shuffled  # noqa: F401


def a_third_alike(spark, n, hot, other):
    return spark.range(n).select("id", F.when(F.col("id") % 3 == 0, hot).otherwise(F.concat(F.lit(other), F.col("id"))).alias("value"), F.sha2(F.col("id").cast("string"), 256).alias("pad")).repartition(8)


def test_one_fingerprint_of_many_documents(spark, conf, monkeypatch):  # noqa: F811
    shuffled(conf)
    conf(spark__sql__shuffle__partitions="64")  # equal rows are few bytes, so partitions must be small
    # only the join matters here: the classes are those of equal fingerprints
    monkeypatch.setattr(simhash, "near_links", lambda reps, radius: spark.createDataFrame([], "a long, b long"))
    docs = a_third_alike(spark, 24_000, "one text of many copies", "a text of its own number ").selectExpr("id AS doc_id", "value AS text")
    df = simhash.near_duplicates(docs)
    assert "skew=true" in final_plan(df)
    assert df.count() == 24_000
    assert df.filter("component_id = 0").count() == 8000


def test_one_node_with_many_neighbours(spark, conf):  # noqa: F811
    shuffled(conf)
    edges = spark.range(20_000).selectExpr("IF(id % 3 = 0, 1, id + 7) AS a", "id * 1000003 + 100000 AS b").repartition(8)
    assert "skew=true" in final_plan(components._large_star(edges))
    found = components.connected_components(edges.filter("id < 3000") if "id" in edges.columns else edges.limit(3000))
    assert found.count() > 3000


def test_one_url_of_many_pages(spark, conf):  # noqa: F811
    shuffled(conf)
    pages = a_third_alike(spark, 24_000, None, "http://example.net/en/").selectExpr("id AS page_id", "value AS url")
    df = url_rules.judge_urls(pages, url_rules.rules_table(spark))
    assert "skew=true" in final_plan(df)
    assert df.filter("host = '' AND verdict = 'allow' AND rule IS NULL").count() == 8000
    assert df.filter("rule = 'example.net/en/'").count() == 16_000
