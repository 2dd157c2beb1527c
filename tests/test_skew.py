from statistics import median

import pytest
from pyspark.sql import functions as F

from postlode.operators.marts import attach_dimension, dim_company
from postlode.operators.skew import hot_keys, split_join

N = 60_000


@pytest.fixture
def shuffled(spark):
    """Joins that shuffle both sides, over partitions that stay as they are."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def postings(spark):
    """A third of the rows on one company, a sixth without any, the rest on some thousand."""
    name = F.when(F.col("id") % 3 == 0, "Tern").when(F.col("id") % 6 == 1, None).otherwise(F.concat(F.lit("c"), F.col("id") % 2000))
    return spark.range(0, N, 1, 4).select(F.col("id").cast("string").alias("job_id"), name.alias("company_name"))


def sizes(df) -> list[int]:
    """Rows of each partition; the key is asked for too, as a join that adds no column asked for is left out."""
    counted = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"), F.max("company_id"))
    return [r.n for r in counted.collect()]


def test_only_keys_above_half_a_partition_are_hot(shuffled):
    found = {r.hot_key: r.pieces for r in hot_keys(postings(shuffled), "company_name").collect()}
    assert found.keys() == {"Tern"} and abs(found["Tern"] - 16 * 16 / 3) < 2


def test_no_partition_holds_twice_the_median(shuffled):
    rows = postings(shuffled)
    dim = dim_company(rows)
    even = sizes(attach_dimension(rows, dim, "company_name", split_by="job_id"))
    plain = sizes(attach_dimension(rows, dim, "company_name"))
    assert sum(even) == sum(plain) == N
    assert max(even) <= 2 * median(even) and max(plain) > 5 * median(plain)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_rows_equal_the_plain_join(shuffled, how):
    rows = postings(shuffled)
    dim = dim_company(rows).where("company_name <> 'c8'")
    dim = dim.unionByName(dim.where("company_name in ('Tern', 'c10')"))  # repeated names give a row each
    split, plain = split_join(rows, dim, "company_name", "job_id", how), rows.join(dim, "company_name", how)
    assert split.columns == plain.columns
    assert split.exceptAll(plain).isEmpty() and plain.exceptAll(split).isEmpty() and not plain.isEmpty()


def test_empty_tables_and_other_joins(spark):
    rows = postings(spark)
    dim = dim_company(rows)
    assert split_join(rows.limit(0), dim, "company_name", "job_id").count() == 0
    assert split_join(rows, dim.limit(0), "company_name", "job_id").where("company_id is null").count() == N
    with pytest.raises(ValueError):
        split_join(rows, dim, "company_name", "job_id", "full")
